"""Line dedup: later copies of runs of lines go.

A document is the sequence of its lines that are not blank, and a line is its id (a 128-bit hash). The
suffixes of all sequences are sorted by distributed prefix doubling: ranks of prefixes of one line are
joined to ranks of two, of four, and so on, each an order-preserving number from a distributed sort. A
suffix whose prefix is unique is left out of the next round, as no longer prefix of it can repeat. Suffixes of
equal rank form an interval of the suffix array in which the longest common prefix is at least as many lines as the
ranks are deep; in each interval every suffix but the earliest begins a copy.

A run is worth deleting if it has `min_lines` lines, or fewer lines of `min_words` words together. The sort stops at
the depth that decides, `min_lines`: a longer copy is made of copies of that length, each of which begins with a
suffix in such an interval, and copies that overlap add up to maximal runs (see `maximal_runs`). For shorter
ones every length on the way is looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lamina.llm.common import checkpointed

MIN_LINES, MIN_WORDS = 3, 50
WORD = r"[^\x20\x09-\x0D]+"


def lines_of(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """One row per line that is not blank: document (id, d), place among such lines, line id (a, b), and lines: its number and words."""
    numbered = F.transform(F.split("t", "\n", -1), lambda line, i: F.struct(i.alias("no"), line.alias("line")))
    said = F.filter(numbered, lambda x: x["line"].rlike(r"\S"))
    hashed = F.transform(
        said,
        lambda x: F.struct(
            F.struct(x["no"].alias("no"), F.regexp_count(x["line"], F.lit(WORD)).alias("words")).alias("line"),
            F.xxhash64(x["line"]).alias("a"),
            F.xxhash64(F.lit(1), x["line"]).alias("b"),
        ),
    )
    rows = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").cast("string").alias("t"))
    rows = rows.select("id", F.xxhash64("t").alias("d"), F.posexplode(hashed).alias("pos", "x"))
    return rows.select("id", "d", "pos", F.array("x.line").alias("lines"), "x.a", "x.b")


def place() -> Column:
    return F.struct("id", "d", "pos")


def ranked(prefixes: DataFrame) -> DataFrame:
    """Prefixes named by a pair (a, b) -> those that occur more than once, with their rank and whether an earlier one exists.

    The rank is the pair's number in sorted order: a range-partitioned sort, and the number of the partition
    and of the row in it.
    """
    found = prefixes.groupBy("a", "b").agg(F.min(place()).alias("first"), F.max(place()).alias("last"))
    found = found.where("first != last").select("a", "b", "first").sort("a", "b")
    names = checkpointed(found.withColumn("rank", F.monotonically_increasing_id()))
    return prefixes.join(names, ["a", "b"]).select("id", "d", "pos", "lines", "rank", "first", (place() > F.col("first")).alias("later"))


def longer(ranks: DataFrame, shift: int) -> DataFrame:
    """Each prefix with the one that begins `shift` lines later in its document: a prefix of `shift` lines more."""
    ahead = ranks.select(
        F.col("id").alias("id2"), F.col("d").alias("d2"), (F.col("pos") - shift).alias("pos2"),
        F.col("lines").alias("lines2"), F.col("rank").alias("b"),
    )
    same = F.col("id").eqNullSafe(F.col("id2")) & (F.col("d") == F.col("d2")) & (F.col("pos") == F.col("pos2"))
    # A repeated row has every place twice.
    pairs = ranks.withColumnRenamed("rank", "a").join(ahead, same)
    return pairs.select("id", "d", "pos", F.array_union("lines", "lines2").alias("lines"), "a", "b").dropDuplicates(["id", "d", "pos"])


def intervals(docs: DataFrame, doc_id: str, text: str, min_lines: int, every_length: bool) -> list[DataFrame]:
    """The suffix array at growing depths, the last of which is `min_lines`: rows (id, d, pos, lines, rank, first, later) each.

    Rows of equal rank share their first lines, so many as the depth; `first` is the earliest of them, by document
    id, then text hash, then place, and `later` says that a row is not that one. Depths double, or go line by line.
    """
    ranks, length = ranked(checkpointed(lines_of(docs, doc_id, text))), 1
    found = []
    while length < min_lines:
        ranks = checkpointed(ranks)
        found.append(ranks)
        shift = 1 if every_length else min(length, min_lines - length)
        ranks = ranked(checkpointed(longer(ranks, shift)))
        length += shift
    return [*found, ranks]


def repeated_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_lines: int = MIN_LINES) -> DataFrame:
    """The suffix array to the depth of `min_lines`; see `intervals`."""
    return intervals(docs, doc_id, text, min_lines, False)[-1]


def maximal_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_lines: int = MIN_LINES) -> DataFrame:
    """Later copies of runs of at least `min_lines` lines, as long as they go on like their first copy.

    Rows (id, first_line, last_line, n_lines, source_id, source_line): numbers of lines as they stand in the text, blank
    ones counted but not in n_lines, and where the first copy begins. A copy whose parts were first said in different
    places is a run for each.
    """
    runs = repeated_runs(docs, doc_id, text, min_lines)
    later = runs.where("later")
    source = F.struct(F.col("first.id").alias("id"), F.col("first.d").alias("d"), (F.col("pos") - F.col("first.pos")).alias("apart"))
    later = later.select("id", "d", "pos", "lines", "first", source.alias("source")).dropDuplicates(["id", "d", "pos"])
    nth = F.row_number().over(Window.partitionBy("id", "d", "source").orderBy("pos"))
    run = later.withColumn("run", F.col("pos") - nth).groupBy("id", "d", "source", "run")
    numbers = F.flatten(F.collect_list("lines.no"))
    found = run.agg(
        F.array_min(numbers).alias("first_line"), F.array_max(numbers).alias("last_line"), F.size(F.array_distinct(numbers)).alias("n_lines"), F.min("first.pos").alias("source_pos")
    )
    starts = runs.where("NOT later").select(
        F.col("id").alias("i"), F.col("d").alias("e"), F.col("pos").alias("p"), F.array_min("lines.no").alias("source_line")
    )
    same = F.col("source.id").eqNullSafe(F.col("i")) & (F.col("source.d") == F.col("e")) & (F.col("source_pos") == F.col("p"))
    joined = found.join(starts.dropDuplicates(["i", "e", "p"]), same)
    return joined.select("id", "first_line", "last_line", "n_lines", F.col("source.id").alias("source_id"), "source_line")


def drop_repeated_lines(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_lines: int = MIN_LINES, min_words: int | None = MIN_WORDS
) -> DataFrame:
    """The documents without later copies of runs of lines; adds n_lines and removed_lines.

    A line goes if it lies in a run of `min_lines` lines, or of fewer lines with `min_words` words (None: no such runs),
    that also begins earlier, in the order of document ids (null first) and places, in another document or the
    same. So the first copy of every run stays, but for the lines that a copy of it covers which begins
    inside it (of A A A A, the first A A A is followed by a copy, and one A stays), the lines of a whole repeated
    document all go (its text is then empty), and runs may not span documents. Blank lines are kept and not counted
    between the lines of a run. removed_lines holds the numbers (from 0) of lines that went. Null texts stay null, with
    no lines; rows that share id and text are one document and get the same result; other columns are kept, whatever their
    names, and columns named like the two added ones are replaced.
    """
    depths = intervals(docs, doc_id, text, min_lines, min_words is not None)
    runs = depths[-1].where("later")
    if min_words is not None:
        words = F.aggregate("lines", F.lit(0), lambda n, x: n + x["words"])
        for shorter in depths[:-1]:
            runs = runs.union(shorter.where("later").where(words >= min_words))
    gone = runs.groupBy("id", "d").agg(F.array_distinct(F.flatten(F.collect_set("lines.no"))).alias("gone"))
    given = [c for c in docs.columns if c not in ("n_lines", "removed_lines")]
    place_of = {c: f"c{i}" for i, c in enumerate(given)}
    source = F.col(f"`{text}`").cast("string")
    split = docs.select(
        *[F.col(f"`{c}`").alias(place_of[c]) for c in given if c != text], F.split(source, "\n", -1).alias("said"), F.xxhash64(source).alias("hash")
    )
    joined = split.join(gone, F.col(place_of[doc_id]).eqNullSafe(F.col("id")) & (F.col("hash") == F.col("d")), "left")
    n_lines = F.size("said")
    stay = F.array_except(F.sequence(F.lit(0), n_lines - 1), "gone")
    rest = F.when(F.col("gone").isNull(), F.array_join("said", "\n")).otherwise(
        F.array_join(F.transform(stay, lambda i: F.get("said", i)), "\n")
    )
    removed = F.when(F.col("gone").isNull(), F.array().cast("array<int>")).otherwise(F.sort_array("gone"))
    return joined.select(
        *[rest.alias(text) if c == text else F.col(place_of[c]).alias(c) for c in given],
        F.when(F.col("said").isNull(), 0).otherwise(n_lines).cast("long").alias("n_lines"),
        removed.alias("removed_lines"),
    )
