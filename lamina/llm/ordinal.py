"""Quality classifier: ordinal cumulative-link regression on graded ratings.

A text has one score w.x, from weights shared by all grades over its hashed words, and ordered thresholds
cut the score's line into grades: P(grade <= k) = logistic(threshold_k - w.x). The expected grade and the
probability of the highest grades follow, and documents are selected by the latter.

The model is fitted in numpy on a bounded sample of rated documents; all documents are scored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.llm.common import checkpointed, in_fold, with_text_columns

BITS = 18
PUNCTUATION = b".,;:!?\"'()[]|"
# The bound of the sample that the model is fitted on, and of which a fifth is held out to calibrate.
MAX_RATED = 20_000
ROUNDS = 200
PENALTY = 3e-3
# Hashed words that a step of the fit looks at once.
BLOCK_WORDS = 1 << 17
# Words in fewer rated documents have no weight.
LEAST_DOCUMENTS = 10
# Of held-out documents with a grade to keep, at most this share may fall below the cut.
LOST = 0.01


@dataclass(frozen=True)
class Model:
    """grades in rising order, thresholds between them, weights by hashed word, and the cut for selection."""

    grades: list[float]
    thresholds: np.ndarray
    weights: np.ndarray
    cut: float

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= each grade but the lowest) -> (n, grades - 1)."""
        return logistic(scores[:, None] - self.thresholds[None, :])


def logistic(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def features(text: str | None) -> np.ndarray:
    """Hashed distinct words of a text without case and outer punctuation, and what shows its style.

    The latter are the last two bytes of words that end in punctuation, and that (short) words are in capitals.
    """
    words = set((text or "").encode("utf-8", "replace").split())
    plain = {w.lower().strip(PUNCTUATION) for w in words}
    ends = {b"\x02" + w[-2:] for w in words if not w[-1:].isalnum()}
    capitals = {b"\x01" + (w if len(w) < 3 else b"") for w in words if w.isupper()}
    mask = (1 << BITS) - 1
    return np.unique(np.fromiter((crc32(w) & mask for w in plain | ends | capitals), np.int64))


def blocks(rows: list[np.ndarray]) -> Iterator[tuple[int, int]]:
    """The bounds of consecutive documents that have about BLOCK_WORDS words together, at least one document."""
    start = held = 0
    for i, row in enumerate(rows):
        held += len(row)
        if held >= BLOCK_WORDS or i + 1 == len(rows):
            yield start, i + 1
            start, held = i + 1, 0


def fit(rows: list[np.ndarray], ratings: np.ndarray, rounds: int = ROUNDS, penalty: float = PENALTY) -> tuple[list, np.ndarray, np.ndarray]:
    """(grades, thresholds, weights) by Adam on the mean log-likelihood with an L2 penalty, summed block by block."""
    grades = sorted(set(ratings.tolist()))
    y = np.searchsorted(grades, ratings)
    spread = np.zeros(1 << BITS, np.int64)
    for a, b in blocks(rows):
        spread += np.bincount(np.concatenate(rows[a:b]), minlength=1 << BITS)
    used = np.flatnonzero(spread >= LEAST_DOCUMENTS)
    place = np.full(1 << BITS, -1, np.int32)
    place[used] = np.arange(len(used))
    # Of each block, its documents, and by word the document's place among these and the weight's.
    parts = []
    for a, b in blocks(rows):
        column = place[np.concatenate(rows[a:b])]
        row = np.repeat(np.arange(b - a, dtype=np.int32), [len(r) for r in rows[a:b]])
        parts.append((a, b, row[column >= 0], column[column >= 0]))
    top, n = len(grades) - 1, len(rows)
    below = np.clip(np.cumsum(np.bincount(y, minlength=top + 1))[:-1] / n, 1e-6, 1 - 1e-6)
    cuts = np.log(below / (1 - below))
    # Free parameters: the first threshold, logarithms of the gaps to the next ones, the weights.
    state = np.concatenate([cuts[:1], np.log(np.maximum(np.diff(cuts), 1e-3)), np.zeros(len(used))])
    first, second = np.zeros_like(state), np.zeros_like(state)
    for step in range(1, rounds + 1):
        gaps = np.exp(state[1:top])
        theta = state[0] + np.concatenate([[0], np.cumsum(gaps)])
        scores = np.concatenate([np.bincount(row, state[top:][column], minlength=b - a) for a, b, row, column in parts])
        # Each row lies between two thresholds, those at the ends being infinite.
        high = np.where(y < top, logistic(theta[np.minimum(y, top - 1)] - scores), 1)
        low = np.where(y > 0, logistic(theta[np.maximum(y - 1, 0)] - scores), 0)
        p = np.maximum(high - low, 1e-12)
        up, down = high * (1 - high) / p, low * (1 - low) / p
        of_theta = np.zeros(top)
        np.add.at(of_theta, np.minimum(y, top - 1), -np.where(y < top, up, 0))
        np.add.at(of_theta, np.maximum(y - 1, 0), np.where(y > 0, down, 0))
        rising = np.cumsum(of_theta[::-1])[::-1]
        of_weights = np.zeros(len(used))
        for a, b, row, column in parts:
            np.add.at(of_weights, column, (up - down)[a:b][row])
        of_weights = of_weights / n + penalty * state[top:]
        slope = np.concatenate([rising[:1] / n, gaps * rising[1:] / n, of_weights])
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope**2
        state = state - 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    weights = np.zeros(1 << BITS)
    weights[used] = state[top:]
    return grades, state[0] + np.concatenate([[0], np.cumsum(np.exp(state[1:top]))]), weights


def train(docs: DataFrame, ratings: DataFrame, doc_id: str = "doc_id", text: str = "text", grade: str = "grade", max_rated: int = MAX_RATED) -> Model | None:
    """A model from the rated documents, or None if they have no two different grades.

    Ratings (doc_id, grade) with a null are left out, several of a document count as the lowest, and a document
    that repeats is one, its first row. The sample is the `max_rated` ratings with the smallest hashes of their ids.
    Of these the driver gets one row each, with the words as 32-bit numbers.
    """
    rated = ratings.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{grade}`").cast("double").alias("grade")).dropna()
    rated = rated.groupBy("id").agg(F.min("grade").alias("grade"))
    sample = checkpointed(rated.orderBy(F.xxhash64("id"), "id").limit(max_rated))
    source = docs.select(F.col(f"`{doc_id}`").alias("id"), F.monotonically_increasing_id().alias("place"), F.col(f"`{text}`").cast("string").alias("t"))
    # At most `max_rated` ids.
    met = source.join(F.broadcast(sample), "id").select("grade", in_fold("id", 5, 2).alias("held"), "id", "place", "t")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = pa.array([features(t).astype(np.int32).tobytes() for t in batch.column(4).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], words], names=schema.names)

    schema = met.drop("t").schema.add("words", "binary")
    found = met.mapInArrow(hashed, schema).groupBy("id").agg(F.min_by(F.struct("grade", "held", "words"), "place").alias("x"))
    found = found.select("id", "x.*").toArrow()
    ids = found.column("id").to_pylist()
    order = sorted(range(len(ids)), key=ids.__getitem__)
    grades, held = found.column("grade").to_numpy()[order], found.column("held").to_numpy()[order]
    each = [np.frombuffer(w.as_buffer(), np.int32) for w in found.column("words")]
    rows = [each[i] for i in order]
    if len(set(grades[~held].tolist())) < 2:
        return None
    names, thresholds, weights = fit([r for r, h in zip(rows, held) if not h], grades[~held])
    model = Model(names, thresholds, weights, 0.5)
    best = [r for r, g, h in zip(rows, grades, held) if h and g == names[-1]]
    if not best:
        return model
    tails = model.tails(np.array([weights[r].sum() for r in best]))[:, -1]
    return Model(names, thresholds, weights, min(0.5, float(np.quantile(tails, LOST))))


def grade(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """The rows with expected_grade, top_probability (of the highest grade) and selected.

    Null and empty texts have no words and so the score of none. Without a model both figures are null and
    everything is selected. Other columns and repeated rows are kept; columns named like results are replaced.
    """
    added = T.StructType().add("expected_grade", "double").add("top_probability", "double").add("selected", "boolean")
    if model is None:
        kept = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in added.names])
        return kept.withColumns({"expected_grade": F.lit(None).cast("double"), "top_probability": F.lit(None).cast("double"), "selected": F.lit(True)})
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def compute(texts: list[str | None]) -> list[list]:
        m = shared.value
        tails = m.tails(np.array([m.weights[f].sum() for f in map(features, texts)]))
        expected = m.grades[0] + tails @ np.diff(m.grades)
        return [expected.tolist(), tails[:, -1].tolist(), (tails[:, -1] >= m.cut).tolist()]

    return with_text_columns(docs, text, added, compute)


def graded(quality: Column, toxic: Column) -> Column:
    """Ratings 0/1 of quality and toxicity as one grade: 0 toxic, 1 poor, 2 good; null if either is."""
    return F.when(quality.isNull() | toxic.isNull(), None).when(toxic == 1, 0).when(quality == 0, 1).otherwise(2)
