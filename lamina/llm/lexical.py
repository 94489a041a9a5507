"""Ranked lexical search by norm buckets, in the manner of LEMP.

A document is the sparse vector of its terms' impacts, and an item the vector of its terms' weights; the score is
their inner product. Both are scaled by the square root of the weight, which leaves products as they are and makes
lengths tell more. Only terms that some item of the block has can count, so vectors hold those and no others.

Vectors are ordered by length, longest first, by a range-partitioned sort, and consecutive ones form buckets. By
Cauchy-Schwarz no document of a bucket scores more than its longest length times the item's: buckets that cannot
reach the item's k-th best so far are skipped. Inside a bucket the item's heaviest coordinates are added up, and
with the lengths of what is left of document and item they bound the score: documents that cannot reach are left
out. The survivors are scored anew, exactly, in integers. Thresholds come from the longest vectors first: shares
of all documents, longest first, are searched in rounds, each with the k-th best scores of those before it.

Nothing is cut off: every bound only leaves out what cannot be among the k best.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from lamina.llm.common import checkpointed, drop_folder, shared_folder

K = 10
# Terms of items that a pass over the documents serves; more items take more passes.
TERMS_PER_BLOCK = 1_000_000
# Shares of the documents, longest vectors first, after which thresholds are taken anew.
ROUNDS = (1 / 64, 1 / 8)
BUCKET = 4096
# Coordinates of an item, heaviest first, that bound a score before it is computed.
FOCUS = 6
# What rounding can add to a bound, relative to it.
SLACK = 1 + 1e-9

# Bytes that separate terms become blanks, A-Z become a-z; bytes over 127 belong to letters of more than one byte.
AS_TERMS = bytes(
    c + 32 if 65 <= c <= 90 else c if c > 127 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)


def terms_of(text: bytes | None) -> list[bytes]:
    """The terms of UTF-8 text, with repeats."""
    return (text or b"").translate(AS_TERMS).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impacts_of(tfs: np.ndarray, n: int, n_docs: int, n_terms: int) -> np.ndarray:
    m = 10 + 90 * n * n_docs // n_terms
    return 1_000_000_000 * tfs // (1000 * tfs + 8 * m)


def lists(offsets: list[int], flat: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat))


def item_terms(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """Distinct (item_id, term) of items; an item's id may be null."""
    rows = items.select(F.col(f"`{item_id}`").alias("item_id"), F.col(f"`{text}`").cast("string").cast("binary").alias("t"))
    schema = T.StructType([rows.schema["item_id"], T.StructField("term", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                found = sorted(set(terms_of(batch.column(1)[i].as_py())))
                ids = batch.column(0).take(pa.array([i] * len(found), pa.int64()))
                yield pa.RecordBatch.from_arrays([ids, pa.array(found, pa.binary())], names=["item_id", "term"])

    return rows.mapInArrow(run, schema).distinct()


def vectors(docs: DataFrame, doc_id: str, text: str, number: dict[bytes, int]) -> DataFrame:
    """Documents with terms: id, n of all terms, and numbers and counts of those that have a number."""
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").cast("binary").alias("t"))
    numbers = docs.sparkSession.sparkContext.broadcast(number)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = numbers.value.get
        for batch in batches:
            taken, sizes, offsets, terms, tfs = [], [], [0], [], []
            for i in range(batch.num_rows):
                words = terms_of(batch.column(1)[i].as_py())
                if not words:
                    continue
                counts = Counter(map(get, words))
                counts.pop(None, None)
                taken.append(i)
                sizes.append(len(words))
                terms += counts.keys()
                tfs += counts.values()
                offsets.append(len(terms))
            columns = [batch.column(0).take(pa.array(taken, pa.int64())), pa.array(sizes, pa.int64())]
            columns += [lists(offsets, np.array(x, np.int32)) for x in (terms, tfs)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "terms", "tfs"])

    return rows.mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<int>")


def with_impacts(found: DataFrame, weights: np.ndarray, n_docs: int, n_terms: int) -> DataFrame:
    """Vectors of counts -> vectors of impacts, with their lengths; without those that no item can reach."""
    roots = found.sparkSession.sparkContext.broadcast(np.sqrt(weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, n, terms, tfs = (batch.column(i) for i in range(4))
            ends = np.r_[0, np.cumsum(terms.value_lengths().to_numpy())]
            flat_terms, flat_tfs = terms.flatten().to_numpy(), tfs.flatten().to_numpy().astype(np.int64)
            impacts = np.zeros(len(flat_tfs), np.int32)
            lengths = np.zeros(len(ids))
            for i, size in enumerate(n.to_pylist()):
                at = slice(ends[i], ends[i + 1])
                impacts[at] = impacts_of(flat_tfs[at], size, n_docs, n_terms)
                lengths[i] = math.sqrt(((impacts[at] * roots.value[flat_terms[at]]) ** 2).sum())
            columns = [ids, pa.array(lengths), terms, lists(ends, impacts)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "length", "terms", "impacts"])

    made = found.where("doc_id IS NOT NULL AND size(terms) > 0").mapInArrow(
        run, "doc_id long, length double, terms array<int>, impacts array<int>"
    )
    return made.where("length > 0")


class Bucket:
    """Consecutive vectors, with a list of documents and impacts for each term."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray, ends: np.ndarray, terms: np.ndarray, impacts: np.ndarray):
        self.ids, self.lengths, self.ends, self.terms, self.impacts = ids, lengths, ends, terms, impacts
        self.longest = lengths.max()
        owner = np.repeat(np.arange(len(ids)), np.diff(ends))
        order = np.argsort(terms, kind="stable")
        self.sorted, self.docs, self.of_docs = terms[order], owner[order], impacts[order]

    def survivors(self, terms: np.ndarray, weights: np.ndarray, least: float) -> np.ndarray:
        """Documents whose bound after the heaviest coordinates reaches `least`. The terms come heaviest first."""
        focus = terms[:FOCUS]
        starts, stops = np.searchsorted(self.sorted, focus), np.searchsorted(self.sorted, focus, "right")
        product, square = np.zeros(len(self.ids)), np.zeros(len(self.ids))
        for start, stop, w in zip(starts, stops, weights):
            part = w * self.of_docs[start:stop].astype(np.float64)
            product[self.docs[start:stop]] += part
            square[self.docs[start:stop]] += part * self.of_docs[start:stop]
        left = math.sqrt(weights[FOCUS:].sum())
        bound = product + left * np.sqrt(np.maximum(self.lengths**2 * SLACK - square, 0))
        return np.flatnonzero((bound * SLACK >= least) & (bound > 0))

    def scores(self, rows: np.ndarray, dense: np.ndarray) -> np.ndarray:
        """Exact scores; `dense` has the item's weight of each term, and zeros."""
        sizes = self.ends[rows + 1] - self.ends[rows]
        begins = np.r_[0, np.cumsum(sizes)[:-1]]
        flat = np.arange(sizes.sum()) + np.repeat(self.ends[rows] - begins, sizes)
        return np.add.reduceat(dense[self.terms[flat]] * self.impacts[flat], begins)


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


def searched(table: DataFrame, asked: list[tuple[np.ndarray, float]], weights: np.ndarray, k: int) -> DataFrame:
    """Per task and item its k best among the rows: (item int, doc_id, score). `asked`: terms and threshold of each item."""
    shared = table.sparkSession.sparkContext.broadcast((asked, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, weights = shared.value
        dense = np.zeros(len(weights), np.int64)
        least = [limit for _, limit in asked]
        items = []
        for terms, _ in asked:
            terms = terms[np.lexsort((terms, -weights[terms]))]
            items.append((terms, weights[terms], math.sqrt(weights[terms].sum())))
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(asked)
        for batch in batches:
            for start in range(0, batch.num_rows, BUCKET):
                part = batch.slice(start, BUCKET)
                terms, impacts = part.column(2), part.column(3)
                ends = np.r_[0, np.cumsum(terms.value_lengths().to_numpy())]
                bucket = Bucket(
                    part.column(0).to_numpy(), part.column(1).to_numpy(), ends, terms.flatten().to_numpy(), impacts.flatten().to_numpy().astype(np.int64)
                )
                for i, (terms, ws, length) in enumerate(items):
                    if length * bucket.longest * SLACK < least[i]:
                        continue
                    rows = bucket.survivors(terms, ws, least[i])
                    if not len(rows):
                        continue
                    dense[terms] = ws
                    scores = bucket.scores(rows, dense)
                    dense[terms] = 0
                    good = (scores >= least[i]) & (scores > 0)
                    ids, scores = (np.concatenate(x) for x in zip(found[i], (bucket.ids[rows[good]], scores[good])))
                    found[i] = best(ids, scores, k)
                    if len(found[i][0]) == k:
                        least[i] = max(least[i], int(found[i][1][-1]))
        for i, (ids, scores) in enumerate(found):
            if len(ids):
                yield pa.RecordBatch.from_pydict({"item": np.full(len(ids), i, np.int32), "doc_id": ids, "score": scores})

    return table.mapInArrow(run, "item int, doc_id long, score long")


def top_rows(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), "doc_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search_block(docs: DataFrame, terms: DataFrame, k: int, doc_id: str, text: str) -> DataFrame:
    """The k best documents of the items of a block: (item_id, rank, doc_id, score)."""
    spark = docs.sparkSession
    number: dict[bytes, int] = {}
    items: dict = {}
    for item, term in terms.collect():
        items.setdefault(item, []).append(number.setdefault(bytes(term), len(number)))
    folder = f"{shared_folder(spark)}/lexical-{uuid.uuid4()}"
    counted = checkpointed(vectors(docs, doc_id, text, number))
    n_docs, n_terms = counted.agg(F.count("*"), F.sum("n")).first()
    weights = np.zeros(len(number), np.int64)
    for term, df in counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        weights[term] = weight(n_docs, df)
    # Equal lengths, as those of copies, are dealt out by id.
    order = [F.desc("length"), F.xxhash64("doc_id")]
    made = with_impacts(counted, weights, n_docs, n_terms or 1)
    made.repartitionByRange(*order).sortWithinPartitions(*order).write.parquet(folder)
    table = spark.read.parquet(folder)
    cuts = table.agg(F.percentile_approx("length", [1 - share for share in ROUNDS])).first()[0] or []
    asked = [np.array(sorted(t), np.int64) for t in items.values()]
    limits = [0.0] * len(asked)
    found = spark.createDataFrame([], "item int, doc_id long, score long, rank int")
    above = math.inf
    for cut in [*cuts, -1.0]:
        part = table.where((F.col("length") >= cut) & (F.col("length") < above))
        hits = searched(part, list(zip(asked, limits)), weights, k)
        found = checkpointed(top_rows(found.drop("rank").union(hits), k))
        for item, score in found.where(F.col("rank") == k).select("item", "score").collect():
            limits[item] = score
        above = cut
    drop_folder(spark, folder)
    schema = T.StructType([T.StructField("item", T.IntegerType()), T.StructField("item_id", terms.schema["item_id"].dataType)])
    names = spark.createDataFrame(list(enumerate(items)), schema)
    return found.join(names, "item").select("item_id", "rank", "doc_id", "score")


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = K,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    terms_per_block: int = TERMS_PER_BLOCK,
) -> DataFrame:
    """Per item its k documents of highest score, if above 0: item_id, rank (from 1), doc_id, score.

    Ties go to the smaller id. Null texts, and texts without a term, have no terms: such items find nothing, and
    such documents are not counted. Rows that share an item id are one item with the terms of all; a null item id is
    an id. Every row of documents is a document, so repeated rows count, and rank, once each; rows with a null
    id count in the statistics but cannot be named, and are not returned. No items or no documents give no rows.
    Only ids and texts are read, so other columns don't matter.

    Items are dealt to blocks of about `terms_per_block` (item, term) rows; the driver and the tasks hold the
    terms of one block, and each block takes one pass over the texts.
    """
    spark = docs.sparkSession
    terms = checkpointed(item_terms(items, item_id, item_text))
    blocks = -(-terms.count() // terms_per_block)
    block = F.pmod(F.xxhash64("item_id"), F.lit(max(blocks, 1)))
    schema = T.StructType().add("item_id", terms.schema["item_id"].dataType).add("rank", "integer").add("doc_id", "long").add("score", "long")
    out = spark.createDataFrame([], schema)
    for i in range(blocks):
        out = out.union(search_block(docs, terms.where(block == i), k, doc_id, text))
    return out
