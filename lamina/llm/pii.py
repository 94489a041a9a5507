"""Personal data: generators propose overlapping spans, boosted trees choose among them.

Strict patterns give the base spans: they are certain and always stay. Loose generators propose further
spans of a kind, with high recall. Gradient-boosted trees score each proposal by its format and by the
text around it; what defines a base span by its spelling alone (a plus sign, an at sign) is hidden from
them, so that they learn what surrounds and shapes such data. They are trained on the proposals of all documents
but a held-out fold, labelled by whether a base span of the kind lies there; on all proposals of that fold is
chosen, per kind, the lowest threshold that is precise enough. What scores above it is added.

Only DataFrame functions and Spark's own JVM trees are used. A pattern's matches and the gaps between them
are taken in one projection over the texts; positions are running sums of their lengths.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lamina.llm.common import checkpointed, in_fold

KINDS = ("email", "ip", "card", "phone")
TREES, DEPTH = 20, 3
PRECISION = 0.98
# A threshold rests on so many held-out proposals at least.
LEAST_HELD_OUT = 20
AROUND = 24

# The strict patterns. A run of characters that a pattern begins with is entered at its
# first one (or where the match before ended), and runs are not given back: the same matches, in linear time.
LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:(?<!{LOCAL})|\G){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "email_like": (
        rf"(?:(?<!{LOCAL})|\G){LOCAL}++(?:@| ?[(\[]at[)\]] ?| at )[A-Za-z0-9-]++"
        r"(?:(?:\.| ?[(\[]dot[)\]] ?| dot )[A-Za-z0-9-]++)++"
    ),
    "number_like": r"(?<![0-9A-Za-z])[+(]{0,2}[0-9](?:[\x20().\-/]{0,2}[0-9]){6,22}(?![0-9A-Za-z])",
}
# What a text must hold for a pattern to be tried.
NEEDS = {"email": "@", "ip": "[0-9]", "card": "[0-9]", "phone": "[+][0-9]", "email_like": "(?:@|at[)\\]]?) ?[A-Za-z0-9]", "number_like": "[0-9]"}
CUES = {
    "says_phone": r"(?i)tel|phone|call|fone|mobil|cell|fax|whatsapp|sms",
    "says_card": r"(?i)card|visa|credit|master|amex|pay|karte|carte|tarjeta",
    "says_mail": r"(?i)mail|contact|write|reach|courriel|correo",
}


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def located(docs: DataFrame, doc_id: str, text: str) -> tuple[DataFrame, DataFrame]:
    """(rows, matches): the rows as (row, id), and every match as (row, pattern, match, start, end, before, after)."""
    t = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{doc_id}`").alias("id"), t.alias("t"))

    def pieces(name: str) -> Column:
        # Between n matches lie n + 1 gaps; the last gap has no match.
        zipped = F.arrays_zip(F.split("t", PATTERNS[name], -1).alias("gap"), F.regexp_extract_all("t", F.lit(PATTERNS[name]), F.lit(0)).alias("match"))
        cut = F.transform(
            zipped,
            lambda z: F.struct(
                z["match"].alias("match"),
                F.length(z["gap"]).alias("gap"),
                F.when(F.length(z["gap"]) > AROUND, F.substring(z["gap"], -AROUND, AROUND)).otherwise(z["gap"]).alias("before"),
                F.substring(z["gap"], 1, AROUND).alias("after"),
            ),
        )
        return F.when(F.col("t").rlike(NEEDS[name]), cut)

    found = rows.select("row", "id", *[pieces(p).alias(p) for p in PATTERNS])
    some = [F.struct(F.lit(p).alias("pattern"), F.when(F.size(p) > 1, F.col(p)).alias("pieces")) for p in PATTERNS]
    found = checkpointed(found.select("row", "id", F.filter(F.array(*some), lambda x: x["pieces"].isNotNull()).alias("found")))
    each = found.select("row", F.explode("found").alias("x")).select("row", "x.pattern", F.posexplode("x.pieces").alias("i", "p"))
    each = each.select("row", "pattern", "i", "p.*")
    of_pattern = Window.partitionBy("row", "pattern").orderBy("i")
    length = F.coalesce(F.length("match"), F.lit(0))
    end = F.sum(F.col("gap") + length).over(of_pattern.rowsBetween(Window.unboundedPreceding, 0))
    matches = each.select(
        "row", "pattern", "match", "before", F.lead("after").over(of_pattern).alias("after"), (end - length).alias("start"), end.alias("end")
    ).where("match IS NOT NULL")
    return found.select("row", "id"), matches


def passes() -> Column:
    """Whether a strict match meets what its kind demands beyond its pattern."""
    n, kind = F.length(digits(F.col("match"))), F.col("pattern")
    byte = F.forall(F.split("match", r"\."), lambda x: x.cast("double") <= 255)
    return (
        (kind == "email")
        | ((kind == "ip") & byte)
        | ((kind == "card") & n.between(14, 19) & F.call_function("luhn_check", digits(F.col("match"))))
        | ((kind == "phone") & n.between(10, 15))
    )


def proposals(matches: DataFrame, base: DataFrame) -> DataFrame:
    """Spans of the loose generators, a row for each kind that they may be; `known` if a base span of the kind is there.

    Columns: row, kind, start, end, free (no base span of any kind is there), known, and the features.
    """
    number, n = F.col("pattern") == "number_like", F.length(digits(F.col("match")))
    kinds = F.filter(
        F.array(
            F.when(~number, "email"), F.when(number & n.between(13, 19), "card"), F.when(number & n.between(7, 15), "phone")
        ),
        lambda x: x.isNotNull(),
    )
    loose = matches.where(F.col("pattern").isin("email_like", "number_like")).withColumn("kind", F.explode(kinds))
    spans = base.groupBy("row").agg(F.collect_list(F.struct("kind", "start", "end")).alias("base"))
    met = loose.join(spans, "row", "left")
    there = F.filter(F.coalesce("base", F.array().cast("array<struct<kind:string,start:bigint,end:bigint>>")), lambda s: (s["start"] < F.col("end")) & (s["end"] > F.col("start")))
    counted = {
        "n_digits": "[^0-9]", "n_letters": "[^A-Za-z]", "n_dots": "[^.]", "n_blanks": "[^ ]", "n_dashes": "[^-]", "n_brackets": "[^()]",
    }
    features = {name: F.length(F.regexp_replace("match", rest, "")) for name, rest in counted.items()}
    features |= {
        "is_email": (F.col("kind") == "email").cast("int"),
        "is_card": (F.col("kind") == "card").cast("int"),
        "checksum": ((F.col("kind") == "card") & F.call_function("luhn_check", digits(F.col("match")))).cast("int"),
        "first_digit": F.coalesce(F.substring(digits(F.col("match")), 1, 1).try_cast("int"), F.lit(-1)),
        "digits_around": F.length(digits(F.concat("before", "after"))),
        "letters_before": F.length(F.regexp_extract("before", r"\p{L}+\W*$", 0)),
        "blank_before": F.col("before").rlike(r"(^|\s)$").cast("int"),
        "blank_after": F.col("after").rlike(r"^(\s|$)").cast("int"),
    }
    features |= {name: (F.col("before").rlike(cue) | F.col("after").rlike(cue)).cast("int") for name, cue in CUES.items()}
    return met.select(
        "row", "kind", "start", "end",
        (F.size(there) == 0).alias("free"),
        F.exists(there, lambda s: s["kind"] == F.col("kind")).alias("known"),
        F.array(*[F.coalesce(f.cast("double"), F.lit(0.0)) for f in features.values()]).alias("features"),
    )


def n_features() -> int:
    return 14 + len(CUES)


def assembled(proposed: DataFrame) -> DataFrame:
    names = [f"f{i}" for i in range(n_features())]
    wide = proposed.select("*", *[F.get("features", F.lit(i)).alias(name) for i, name in enumerate(names)])
    return VectorAssembler(inputCols=names, outputCol="vector").transform(wide).drop(*names)


def chosen(proposed: DataFrame, ids: DataFrame, precision: float = PRECISION) -> DataFrame | None:
    """The proposals that the trees select, as (row, kind, start, end); None if there is nothing to learn from."""
    fold = proposed.join(ids.select("row", in_fold("id", 5, 3).alias("held")), "row")
    # In one order, so that the trees are the same on every run.
    sample = checkpointed(fold.orderBy(F.xxhash64("row", "start", "kind"), "row", "start", "kind"))
    known = {r.known for r in sample.where("NOT held").select("known").distinct().collect()}
    if known != {True, False}:
        return None
    training = assembled(sample).withColumn("label", F.col("known").cast("double"))
    trees = GBTClassifier(
        featuresCol="vector", labelCol="label", maxIter=TREES, maxDepth=DEPTH, minInstancesPerNode=5, seed=1, cacheNodeIds=False
    ).fit(training.where("NOT held"))

    def scored(df: DataFrame) -> DataFrame:
        return trees.transform(df).withColumn("p", F.get(vector_to_array("probability"), F.lit(1)))

    bins = scored(training.where("held")).groupBy("kind", F.floor(F.col("p") * 100).alias("bin"))
    counts = bins.agg(F.count("*").alias("n"), F.sum("label").alias("good")).collect()
    limits = {}
    for kind in KINDS:
        n = good = 0
        for r in sorted((r for r in counts if r.kind == kind), key=lambda r: -r.bin):
            n, good = n + r.n, good + r.good
            if n >= LEAST_HELD_OUT and good >= precision * n:
                limits[kind] = r.bin / 100
    if not limits:
        return None
    above = reduce(lambda a, b: a | b, [(F.col("kind") == k) & (F.col("p") >= limit) for k, limit in limits.items()])
    return scored(assembled(proposed.where("free"))).where(above).select("row", "kind", "start", "end")


def personal_data(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", precision: float = PRECISION) -> DataFrame:
    """Per row: doc_id, base and spans, arrays of (start, kind, end) by start, then kind in the order of KINDS.

    Positions are code points, end exclusive. Base matches are the leftmost that do not overlap, per kind, and
    those that fail a kind's test are dropped. spans holds them and what the trees add where no base span is.
    Null and empty texts have none, repeated rows get a row each, and a corpus that shows only one kind of label
    adds none. Whole texts are read, however long. Only the id and text columns are read.
    """
    ids, matches = located(docs, doc_id, text)
    base = matches.where(passes()).select("row", F.col("pattern").alias("kind"), "start", "end")
    added = chosen(checkpointed(proposals(matches, base)), ids, precision)
    every = base.withColumn("strict", F.lit(True))
    if added is not None:
        every = every.union(added.distinct().withColumn("strict", F.lit(False)))
    number = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind")).cast("int")
    span = F.struct(F.col("start"), number.alias("number"), F.col("kind"), F.col("end"))
    found = every.groupBy("row").agg(F.sort_array(F.collect_list(F.struct(span.alias("span"), F.col("strict")))).alias("x"))
    joined = ids.join(found, "row", "left").withColumn("x", F.coalesce("x", F.array().cast(found.schema["x"].dataType)))

    def listed(column: Column) -> Column:
        return F.transform(column, lambda s: F.struct(s["span"]["start"].alias("start"), s["span"]["kind"].alias("kind"), s["span"]["end"].alias("end")))

    return joined.select(
        F.col("id").alias(doc_id), listed(F.filter("x", lambda s: s["strict"])).alias("base"), listed(F.col("x")).alias("spans")
    )


def of_kind(spans: Column, kind: str) -> Column:
    """How many spans are of a kind."""
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def written(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
