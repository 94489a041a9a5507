"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. A letter n-gram binds the vectors of its letters,
each rotated by its place, by multiplying them; a text is the sum (bundle) of its n-grams, and a
language the bundle of its training texts. The language of a text is the one whose prototype has
the highest cosine with the text's bundle.

Bundles are linear in the n-gram counts, so a task counts n-grams and multiplies the counts with
the vectors of the n-grams that occur: two numpy operations a slice of texts. Prototypes are sums
over tasks; only they (languages x dimensions) reach the driver and go back to the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.llm.common import slices, with_text_columns

UNKNOWN = "und"
N = 3
# Bounds of a task's arrays: cells of a count matrix, and n-grams whose vectors are built at once.
COUNT_CELLS = 1 << 22
GRAM_BLOCK = 1 << 13


@dataclass(frozen=True)
class Profiles:
    """Languages, their prototypes (a row each), and the seed of the letter vectors."""

    languages: list[str]
    prototypes: np.ndarray
    seed: int

    @property
    def dimensions(self) -> int:
        return self.prototypes.shape[1]


@cache
def letter_table() -> np.ndarray:
    """By code point: is it a letter?"""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


@cache
def letter_vector(code: int, dimensions: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, code]).choice(np.array([-1, 1], np.int8), dimensions)


def grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, number of the n-gram) per occurrence, and the letters of each distinct n-gram.

    Letters are lower-cased, what lies between words counts as one gap, and an n-gram spans no gap:
    its middle is a letter, so every text with a letter has one.
    """
    coded = [np.frombuffer((t or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
    ends = np.cumsum([len(c) + 1 for c in coded])
    symbols = np.concatenate([np.zeros(1, np.uint32), *[x for c in coded for x in (c, np.zeros(1, np.uint32))]])
    symbols[~letter_table()[symbols]] = 0
    kept = np.flatnonzero((symbols[1:] != 0) | (symbols[:-1] != 0)) + 1
    symbols = np.concatenate([symbols[:1], symbols[kept]])
    middle = np.flatnonzero(symbols[1:-1] != 0) + 1
    owner = np.searchsorted(ends, kept[middle - 1], side="left")
    seen = np.zeros(0x110000, bool)
    seen[symbols] = True
    alphabet = np.flatnonzero(seen)
    number = np.zeros(0x110000, np.int64)
    number[alphabet] = np.arange(len(alphabet))
    letters, size = number[symbols], len(alphabet)
    code = (letters[middle - 1] * size + letters[middle]) * size + letters[middle + 1]
    if size**N <= COUNT_CELLS:
        present = np.zeros(size**N, bool)
        present[code] = True
        distinct = np.flatnonzero(present)
        index = np.zeros(size**N, np.int64)
        index[distinct] = np.arange(len(distinct))
        which = index[code]
    else:
        distinct, which = np.unique(code, return_inverse=True)
    spelled = np.stack([alphabet[distinct // size**2], alphabet[distinct // size % size], alphabet[distinct % size]], axis=1)
    return owner, which, spelled


def bind(spelled: np.ndarray, dimensions: int, seed: int) -> np.ndarray:
    """Vectors of n-grams: the product of their letters' vectors, each rotated by its place."""
    codes, place = np.unique(spelled, return_inverse=True)
    vectors = np.stack([letter_vector(int(c), dimensions, seed) for c in codes])
    place = place.reshape(spelled.shape)
    bound = np.ones((len(spelled), dimensions), np.int8)
    for i in range(N):
        bound *= np.roll(vectors, N - 1 - i, axis=1)[place[:, i]]
    return bound.astype(np.float32)


def bundle(texts: list[str | None], groups: np.ndarray | None, count: int, dimensions: int, seed: int) -> np.ndarray:
    """One bundle per group of texts (per text, without groups)."""
    out = np.zeros((count, dimensions))
    owner, which, spelled = grams(texts)
    if not len(owner):
        return out
    if groups is not None:
        owner = groups[owner]
        order = np.argsort(owner, kind="stable")
        owner, which = owner[order], which[order]
    for low in range(0, len(spelled), GRAM_BLOCK):
        block = spelled[low : low + GRAM_BLOCK]
        vectors = bind(block, dimensions, seed)
        if len(spelled) > GRAM_BLOCK:
            mine = (which >= low) & (which < low + len(block))
            own, gram = owner[mine], which[mine] - low
        else:
            own, gram = owner, which
        rows = max(1, COUNT_CELLS // len(block))
        for first in range(0, count, rows):
            a, b = np.searchsorted(own, [first, first + rows])
            if a == b:
                continue
            height = min(rows, count - first)
            cells = np.bincount((own[a:b] - first) * len(block) + gram[a:b], minlength=height * len(block))
            out[first : first + height] += cells.reshape(height, -1).astype(np.float32) @ vectors
    return out


def train(
    docs: DataFrame,
    where: Column,
    text: str = "text",
    lang: str = "lang",
    dimensions: int = 1024,
    seed: int = 1,
    max_languages: int = 1000,
) -> Profiles:
    """Prototypes from all rows of `docs` that meet `where` and have a language.

    Rows without a language teach nothing, texts that are null or hold no letter add nothing, repeated
    rows count as often as they occur, and a language all of whose texts lack letters is not learned. No
    row at all gives profiles without a language. More than `max_languages` languages raise: the
    prototypes (8 bytes x languages x dimensions) are gathered on the driver.
    """
    rows = docs.where(where).select(F.col(f"`{lang}`").cast("string").alias("l"), F.col(f"`{text}`").cast("string").alias("t"))
    rows = rows.where("l IS NOT NULL")
    names = sorted(r.l for r in rows.select("l").distinct().limit(max_languages + 1).collect())
    if len(names) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    place = {name: i for i, name in enumerate(names)}

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(names), dimensions))
        for batch in batches:
            langs, texts, done = batch.column(0).to_pylist(), batch.column(1).to_pylist(), 0
            for piece in slices(texts):
                groups = np.array([place[x] for x in langs[done : done + len(piece)]])
                done += len(piece)
                total += bundle(piece, groups, len(names), dimensions, seed)
        for i in np.flatnonzero(np.any(total != 0, axis=1)):
            yield pa.RecordBatch.from_pydict({"l": [names[i]] * dimensions, "d": range(dimensions), "x": total[i]})

    summed = rows.mapInArrow(sums, "l string, d long, x double").groupBy("l", "d").agg(F.sum("x").alias("x")).toPandas()
    wide = summed.pivot(index="l", columns="d", values="x").sort_index()
    prototypes = wide.to_numpy(float) if len(wide) else np.zeros((0, dimensions))
    norms = np.linalg.norm(prototypes, axis=1)
    learned = norms > 0
    return Profiles([x for x, y in zip(wide.index, learned) if y], prototypes[learned] / norms[learned, None], seed)


def predict(docs: DataFrame, profiles: Profiles, text: str = "text") -> DataFrame:
    """The rows with `lang_pred` and `score`, the cosine with the chosen prototype (0 where it is negative).

    Ties go to the language that comes first in the alphabet. Null texts, texts without a letter, and all
    texts if no language was learned, get `und` and 0. Whole texts are used, whatever their length. Other
    columns, and repeated rows, are passed on; columns named like the two results are replaced.
    """
    languages, dimensions, seed = profiles.languages, profiles.dimensions, profiles.seed
    prototypes = profiles.prototypes.astype(np.float64)

    def compute(texts: list[str | None]) -> list[list]:
        if not languages:
            return [[UNKNOWN] * len(texts), [0.0] * len(texts)]
        bundles = bundle(texts, None, len(texts), dimensions, seed)
        norms = np.linalg.norm(bundles, axis=1)
        table = letter_table()
        letters = [n > 0 or any(table[ord(c)] for c in t or "") for n, t in zip(norms, texts)]
        cosines = (bundles @ prototypes.T) / np.where(norms > 0, norms, 1)[:, None]
        best = cosines.argmax(axis=1)
        score = np.clip(cosines[np.arange(len(texts)), best], 0, 1)
        found = [languages[b] if has else UNKNOWN for b, has in zip(best, letters)]
        return [found, [float(s) if has else 0.0 for s, has in zip(score, letters)]]

    added = T.StructType().add("lang_pred", "string").add("score", "double")
    return with_text_columns(docs, text, added, compute)
