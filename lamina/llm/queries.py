"""The operators as queries over the given tables, and their SQL where it can state them.

Each query runs its operator over the whole table and derives the columns asked for from the result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.llm import decontaminate, langid, lexical, licenses, line_dedup, minhash, mixing, ordinal, pii, pst, simhash, spelling, topk
from lamina.llm.common import checkpointed, in_fold

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


LINE_DEDUP_SQL = r"""
WITH split AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents),
lines AS (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS no FROM split),
said AS (
  SELECT doc_id, no, line, row_number() OVER (PARTITION BY doc_id ORDER BY no) AS pos
  FROM lines WHERE regexp_matches(line, '[^ \t\n\v\f\r]')
), runs AS (
  SELECT doc_id, pos, line AS a, lead(line) OVER w AS b, lead(line, 2) OVER w AS c, words, lead(words) OVER w AS more
  FROM (SELECT *, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words FROM said) WINDOW w AS (PARTITION BY doc_id ORDER BY pos)
), later AS (
  SELECT doc_id, pos, 3 AS n FROM runs WHERE c IS NOT NULL QUALIFY row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, pos) > 1
  UNION ALL
  SELECT doc_id, pos, 2 FROM runs WHERE b IS NOT NULL AND words + more >= 50 QUALIFY row_number() OVER (PARTITION BY a, b ORDER BY doc_id, pos) > 1
  UNION ALL
  SELECT doc_id, pos, 1 FROM runs WHERE words >= 50 QUALIFY row_number() OVER (PARTITION BY a ORDER BY doc_id, pos) > 1
), gone AS (
  SELECT DISTINCT doc_id, no FROM (SELECT doc_id, unnest(range(pos, pos + n)) AS pos FROM later) JOIN said USING (doc_id, pos)
), kept AS (
  SELECT doc_id, string_agg(line, chr(10) ORDER BY no) AS text FROM lines ANTI JOIN gone USING (doc_id, no) GROUP BY doc_id
), removed AS (SELECT doc_id, count(*) AS n, string_agg(no::VARCHAR, ',' ORDER BY no) AS nos FROM gone GROUP BY doc_id)
SELECT doc_id, CASE WHEN ls IS NOT NULL THEN coalesce(kept.text, '') END AS text, coalesce(len(ls), 0)::BIGINT AS n_lines,
  coalesce(n, 0)::BIGINT AS n_removed, coalesce(nos, '') AS removed_lines
FROM split LEFT JOIN kept USING (doc_id) LEFT JOIN removed USING (doc_id)
"""


@query("op1_line_dedup", LINE_DEDUP_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.drop_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    n_removed = F.size("removed_lines").cast("long").alias("n_removed")
    return found.select("doc_id", "text", "n_lines", n_removed, F.array_join("removed_lines", ",").alias("removed_lines"))


TOP_K_SQL = """
WITH clean AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i]))::BIGINT AS score
  FROM clean q, clean c WHERE q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
FROM scored QUALIFY rank <= 10
"""


@query("op2_exact_top_k", TOP_K_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", topk.scaled(F.col("embedding")).alias("embedding"))
    return topk.top_k(rows, F.col("vec_id") % 100 == 0)


@query("op3_suffix_tree_scoring")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = in_fold("doc_id", 5, 1)
    tree, counts = pst.train(docs.where(~held_out).select("text"))
    return pst.score(docs.select("doc_id", held_out.alias("held_out"), "text"), tree, counts)


DECONTAMINATION_SQL = r"""
WITH item_words AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i:i + 9], ' ') AS p
  FROM item_words, LATERAL (SELECT unnest(range(1, greatest(2, len(w) - 8))) AS i) WHERE len(w) > 0
), doc_words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), places AS (
  SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS p
  FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM doc_words), (SELECT DISTINCT n FROM windows) WHERE i + n - 1 <= len(w)
), matches AS (SELECT doc_id, i, n, item_id FROM places JOIN windows USING (n, p)),
hits AS (
  SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM matches) GROUP BY doc_id
), found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM matches) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN hits USING (doc_id) LEFT JOIN found USING (doc_id)
"""


@query("op4_benchmark_decontamination", DECONTAMINATION_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hit_items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def template_rows() -> str:
    quoted = [(i, name, text.replace("'", "''")) for i, (name, text) in enumerate(licenses.TEMPLATES)]
    return ", ".join(f"({i}, '{name}', '{text}')" for i, name, text in quoted)


LICENSE_SQL = rf"""
WITH files AS (
  SELECT doc_id, text, source || '/' || (doc_id // 2000) || CASE WHEN doc_id % 2000 = 0 THEN '/LICENSE'
    WHEN doc_id % 100 = 0 THEN '/' || (doc_id // 100) || '/LICENSE' ELSE '/' || (doc_id // 100) || '/' || doc_id || '.txt' END AS path
  FROM documents
), placed AS (SELECT doc_id, text, path, regexp_replace(path, '/?[^/]*$', '') AS dir FROM files),
templates(number, license, said) AS (VALUES {template_rows()}),
template_words AS (
  SELECT number, license, word, count(*) AS c
  FROM (SELECT number, license, unnest(regexp_extract_all(lower(said), '[a-z0-9]+')) AS word FROM templates) GROUP BY ALL
), total AS (SELECT count(*) AS n FROM files),
held AS (SELECT word, count(*) AS df FROM (SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS word FROM files) GROUP BY word),
weights AS (
  SELECT word, ln((1 + n) / (1 + coalesce(df, 0))) + 1 AS weight
  FROM (SELECT DISTINCT word FROM template_words) LEFT JOIN held USING (word), total
), shares AS (
  SELECT number, license, word, c * weight / sqrt(sum((c * weight) ** 2) OVER (PARTITION BY number)) AS share FROM template_words JOIN weights USING (word)
), units AS (
  SELECT doc_id, -1 AS unit, text AS said FROM files
  UNION ALL SELECT doc_id, unnest(range(len(ls)))::INTEGER, unnest(ls) FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM files)
), unit_words AS (
  SELECT doc_id, unit, word, count(*) AS c
  FROM (SELECT doc_id, unit, unnest(regexp_extract_all(lower(said), '[a-z0-9]+')) AS word FROM units) GROUP BY ALL
), lengths AS (
  SELECT doc_id, unit, sqrt(sum(CASE WHEN weight IS NULL THEN c * (ln(1 + n) + 1) ** 2 ELSE (c * weight) ** 2 END)) AS length
  FROM unit_words LEFT JOIN weights USING (word), total GROUP BY doc_id, unit
), products AS (
  SELECT doc_id, unit, number, license, sum(u.c * weight * share) AS product
  FROM unit_words u JOIN weights USING (word) JOIN shares USING (word) GROUP BY ALL
), scored AS (
  SELECT doc_id, unit, license, round(product / length, 6) AS score FROM products JOIN lengths USING (doc_id, unit) WHERE round(product / length, 6) >= 0.7
), own AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, license, unit) = 1),
owners AS (
  SELECT dir, license FROM placed JOIN own USING (doc_id) WHERE path LIKE '%/LICENSE'
  QUALIFY row_number() OVER (PARTITION BY dir ORDER BY score DESC, license) = 1
), above AS (
  SELECT p.doc_id, o.license, o.dir FROM placed p JOIN owners o ON p.dir = o.dir OR starts_with(p.dir, o.dir || '/')
  QUALIFY row_number() OVER (PARTITION BY p.doc_id ORDER BY length(o.dir) DESC) = 1
)
SELECT doc_id, path, own.license AS own_license, score, unit, coalesce(own.license, above.license) AS license,
  CASE WHEN own.license IS NULL THEN above.dir END AS from_dir
FROM files LEFT JOIN own USING (doc_id) LEFT JOIN above USING (doc_id)
"""


def stand_in_path() -> Column:
    """Documents have no path: they stand as files in directories of a hundred, those in directories of their source.

    Every hundredth is its directory's license file.
    """
    number = F.col("doc_id")
    outer, inner = F.expr("doc_id div 2000").cast("string"), F.expr("doc_id div 100").cast("string")
    named = F.when(number % 2000 == 0, F.lit("LICENSE")).when(number % 100 == 0, F.concat(inner, F.lit("/LICENSE")))
    return F.concat_ws("/", "source", outer, named.otherwise(F.concat(inner, F.lit("/"), number, F.lit(".txt"))))


@query("op5_license_scan", LICENSE_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"), stand_in_path())


@query("op6_personal_data")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.personal_data(table(spark, sf_dir, "documents"))
    counts = [pii.of_kind(F.col("base"), kind).alias(f"n_{kind}") for kind in pii.KINDS]
    written = pii.written(F.col("base")).cast("binary")
    return found.select("doc_id", *counts, F.sha2(written, 256).alias("base_sha256"), pii.written(F.col("spans")).alias("spans"))


MIXING_SQL = r"""
WITH RECURSIVE described AS (
  SELECT doc_id, source, lang, CASE WHEN contains(text, '|') THEN 'table' WHEN contains(text, '!!') THEN 'shouting'
    WHEN length(text) < 500 THEN 'note' ELSE 'prose' END AS topic,
    coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS n_tokens
  FROM documents
), cells AS (SELECT source, lang, topic, sum(n_tokens)::DOUBLE AS t FROM described GROUP BY ALL),
shares AS (
  SELECT 0 AS dim, source AS name, sqrt(sum(t)) AS s FROM cells GROUP BY source
  UNION ALL SELECT 1, lang, sqrt(sum(t)) FROM cells GROUP BY lang
  UNION ALL SELECT 2, topic, sqrt(sum(t)) FROM cells GROUP BY topic
), targets AS (SELECT dim, name, s / sum(s) OVER (PARTITION BY dim) * (SELECT sum(t) FROM cells) AS goal FROM shares),
goals AS (
  SELECT source, lang, topic, t, a.goal AS g0, b.goal AS g1, c.goal AS g2 FROM cells
  JOIN targets a ON a.dim = 0 AND a.name IS NOT DISTINCT FROM source
  JOIN targets b ON b.dim = 1 AND b.name IS NOT DISTINCT FROM lang
  JOIN targets c ON c.dim = 2 AND c.name IS NOT DISTINCT FROM topic
), raked AS (
  SELECT source, lang, topic, t, g0, g1, g2, 1.0::DOUBLE AS w, 0 AS step FROM goals
  UNION ALL
  SELECT source, lang, topic, t, g0, g1, g2, w * CASE step % 3
      WHEN 0 THEN g0 / nullif(sum(w * t) OVER (PARTITION BY source), 0)
      WHEN 1 THEN g1 / nullif(sum(w * t) OVER (PARTITION BY lang), 0)
      ELSE g2 / nullif(sum(w * t) OVER (PARTITION BY topic), 0) END, step + 1
  FROM raked WHERE step < 150
), final AS (SELECT source, lang, topic, t, w FROM raked WHERE step = 150),
scales AS (
  SELECT w, (0.5 * sum(t) OVER () - coalesce(sum(t) OVER (ORDER BY w DESC, source, lang, topic ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(w * t) OVER (ORDER BY w DESC, source, lang, topic ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS s
  FROM final
), scale AS (SELECT max_by(s, w) AS s FROM scales WHERE s * w <= 1)
SELECT doc_id, source, lang, topic, n_tokens, round(least(1, s * w), 6) AS probability,
  ('0x' || substr(md5('7:' || coalesce(doc_id::VARCHAR, '')), 1, 12))::BIGINT / 281474976710656.0::DOUBLE < least(1, s * w) AS sampled
FROM described JOIN final f USING (source, lang, topic), scale
"""


@query("op7_source_mixing", MIXING_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    docs = table(spark, sf_dir, "documents")
    slim = docs.select("doc_id", "source", "lang", mixing.topic_of(text).alias("topic"), mixing.n_tokens(text).alias("n_tokens"))
    found = mixing.mix(checkpointed(slim))
    return found.select("doc_id", "source", "lang", "topic", "n_tokens", F.round("probability", 6).alias("probability"), "sampled")


@query("op8_ordinal_quality")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels")
    ratings = labels.select("doc_id", ordinal.graded(F.col("quality"), F.col("toxic")).alias("grade"))
    return ordinal.grade(docs, ordinal.train(docs, ratings)).drop("text")


@query("op9_simhash_near_dedup")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    printed = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return found.select("doc_id", printed.alias("fingerprint"), "component_id")


@query("op10_language_id")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = in_fold("doc_id", 3, 1)
    profiles = langid.train(docs, ~held_out)
    found = langid.predict(docs.select("doc_id", held_out.alias("held_out"), "text"), profiles)
    return found.select("doc_id", "held_out", "lang_pred", "score")


# crc32 of the bytes of '<doc_id>:<run>', bit by bit; words at distance 1 meet in what is left of them without one
# code point, at the same place (one replaced) or as the other word itself (one more or less).
SPELLING_SQL = r"""
WITH RECURSIVE runs AS (
  SELECT doc_id, run, count(*) AS c FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{C0}-\x{FF}]+')) AS run
    FROM documents
  ) WHERE length(run) >= 6 GROUP BY ALL
), steps AS (
  SELECT i AS byte, list_reduce(list_concat([i], range(8)), lambda c, b: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS step FROM range(256) r(i)
), crc AS (SELECT list(step ORDER BY byte) AS steps FROM steps),
checked AS (
  SELECT run, c, xor(4294967295, list_reduce(list_concat([4294967295], list_transform(range(length(hex(encode(doc_id || ':' || run))) // 2),
      lambda i: ('0x' || substr(hex(encode(doc_id || ':' || run)), 2 * i + 1, 2))::BIGINT)),
    lambda s, b: xor(s >> 8, steps[xor(s, b) % 256 + 1]))) AS h
  FROM runs, crc
), words AS (
  SELECT word, sum(c)::BIGINT AS n FROM (
    SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, c FROM checked
  ) WHERE length(word) >= 6 GROUP BY word HAVING sum(c) >= 5
), less AS (
  SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)
), shorter AS (SELECT DISTINCT a.word AS long, b.word AS short, a.n AS long_n, b.n AS short_n FROM less a JOIN words b ON a.rest = b.word),
near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM less a JOIN less b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION ALL SELECT long, short, short_n FROM shorter UNION ALL SELECT short, long, long_n FROM shorter
), told AS (
  SELECT word, n, (SELECT count(*) FROM near WHERE near.word = words.word) AS n_near,
    (SELECT first(other ORDER BY other_n DESC, encode(other)) FROM near WHERE near.word = words.word) AS other,
    (SELECT max(other_n) FROM near WHERE near.word = words.word) AS other_n
  FROM words
), formed AS (
  SELECT word, n, n_near, CASE WHEN other_n >= 5 * n THEN other END AS form, CASE WHEN other_n >= 5 * n THEN other_n END AS form_n FROM told
), chains AS (
  SELECT word, word AS at FROM formed UNION ALL SELECT chains.word, f.form FROM chains JOIN formed f ON f.word = chains.at WHERE f.form IS NOT NULL
)
SELECT f.word, f.n, f.n_near, f.form, f.form_n, c.at AS root
FROM formed f JOIN chains c USING (word) JOIN formed e ON e.word = c.at WHERE e.form IS NULL
"""


@query("op11_spelling_variants", SPELLING_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spelling.group_variants(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("word", "n", "n_near", "form", "form_n", "root")


LEXICAL_SQL = r"""
WITH said AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents
), counts AS (SELECT doc_id, term, count(*) AS tf FROM said GROUP BY ALL),
lengths AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM counts GROUP BY doc_id),
totals AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM lengths),
weights AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM counts, totals GROUP BY term, n_docs),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), scored AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM asked JOIN counts USING (term) JOIN weights USING (term) JOIN lengths USING (doc_id), totals GROUP BY ALL
)
SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 10
"""


@query("op12_lexical_search", LEXICAL_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


MINHASH_SQL = r"""
WITH RECURSIVE said AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 1))) AS i FROM said WHERE len(w) > 0)
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingles a JOIN shingles b USING (s) WHERE a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)
), ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached AS (SELECT doc_id AS a, doc_id AS b FROM said UNION SELECT reached.a, ways.b FROM reached JOIN ways ON ways.a = reached.b)
SELECT a AS doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(b) AS component_id, min(b) = a AS kept
FROM reached LEFT JOIN sizes ON sizes.doc_id = a GROUP BY a
"""


@query("op13_minhash_near_dedup", MINHASH_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))
