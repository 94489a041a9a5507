"""Benchmark decontamination: one Aho-Corasick automaton over the windows of all benchmark items.

Texts are normalised to lower-case words joined by single spaces. An item gives every run of `window`
consecutive words (the whole item, if it is shorter) as a pattern, with a space on either side so that
a pattern meets whole words only. Each document is normalised and scanned once; a match is mapped to
word numbers, and the words to their places in the original text.
"""

from __future__ import annotations

import re
from functools import lru_cache

import ahocorasick
import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.llm.common import with_text_columns

WINDOW = 10
# A word as it stands in the text, before A-Z are lower-cased.
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
# By byte of UTF-8 text: what a word may hold (lower-cased) stays, anything else is a gap.
KEEP = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 or 48 <= b <= 57 else 32 for b in range(256)
)

ADDED = (
    T.StructType()
    .add("n_words", "long")
    .add("n_hit", "long")
    .add("hit_items", T.ArrayType(T.StringType()))
    .add("hit_spans", T.ArrayType(T.StructType().add("start", "long").add("end", "long")))
)


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(KEEP).split()


def windows(items: list[tuple[str | None, str | None]], window: int) -> dict[bytes, tuple[int, list[str]]]:
    """Pattern -> (number of words, ids of the items that hold it)."""
    found: dict[bytes, tuple[int, set[str]]] = {}
    for item_id, text in items:
        item = words(text)
        for i in range(max(1, len(item) - window + 1) if item else 0):
            part = item[i : i + window]
            found.setdefault(b" %b " % b" ".join(part), (len(part), set()))[1].add("" if item_id is None else item_id)
    return {k: (n, sorted(ids)) for k, (n, ids) in found.items()}


@lru_cache(maxsize=2)
def automaton(patterns: tuple[tuple[bytes, int], ...]) -> ahocorasick.Automaton:
    """Built once per worker. Bytes go in as the characters of the same number."""
    built = ahocorasick.Automaton()
    for number, (pattern, length) in enumerate(patterns):
        built.add_word(pattern.decode("latin-1"), (number, length))
    built.make_automaton()
    return built


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    max_pattern_bytes: int = 8_000_000,
) -> DataFrame:
    """The documents with n_words, n_hit, hit_items and hit_spans.

    n_hit counts the words inside any occurrence of a pattern; hit_items holds the ids (as text, distinct,
    sorted) of the items with an occurring pattern; hit_spans are the hit stretches of the original text,
    in code points, end exclusive. Null and empty texts have no words, and items without words no patterns;
    a null item id counts as the empty id, repeated items count once, and without items nothing is hit.
    Documents keep their other columns and repetitions; columns named like the results are replaced.

    The patterns go to every task. A benchmark is fixed in size while the corpus grows; that it is small is
    checked before its texts are fetched, and patterns over `max_pattern_bytes` raise an error.
    """
    items = benchmark.select(F.col(f"`{item_id}`").cast("string").alias("i"), F.col(f"`{item_text}`").alias("t"))
    items = items.where("t IS NOT NULL").distinct()
    size = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    if size > max_pattern_bytes:
        raise ValueError(f"benchmark of {size} bytes exceeds {max_pattern_bytes}")
    found = windows([tuple(r) for r in items.collect()], window)
    if sum(map(len, found)) > max_pattern_bytes:
        raise ValueError(f"benchmark patterns exceed {max_pattern_bytes} bytes")
    shared = docs.sparkSession.sparkContext.broadcast(
        (tuple((k, n) for k, (n, _) in found.items()), [ids for _, ids in found.values()])
    )

    def scan(content: str | None, built: ahocorasick.Automaton, ids: list[list[str]]) -> tuple[int, int, list, list]:
        normal = words(content)
        joined = f" {b' '.join(normal).decode('latin-1')} "
        matches = list(built.iter(joined)) if len(built) else []
        if not matches:
            return len(normal), 0, [], []
        # A match ends with the gap after its last word, so the gaps up to there tell that word's number.
        gaps = np.flatnonzero(np.frombuffer(joined.encode("latin-1"), np.uint8) == 32)
        change = np.zeros(len(normal) + 1, np.int64)
        after = np.searchsorted(gaps, [end for end, _ in matches])
        np.add.at(change, after - [length for _, (_, length) in matches], 1)
        np.add.at(change, after, -1)
        hit = np.cumsum(change[:-1]) > 0
        edges = np.flatnonzero(np.diff(np.concatenate([[0], hit, [0]])))
        places = [m.span() for m in WORD.finditer(content)]
        spans = [{"start": places[a][0], "end": places[b - 1][1]} for a, b in zip(edges[::2], edges[1::2])]
        return len(normal), int(hit.sum()), sorted({x for _, (n, _) in matches for x in ids[n]}), spans

    def compute(texts: list[str | None]) -> list[list]:
        patterns, ids = shared.value
        built = automaton(patterns)
        return [list(c) for c in zip(*(scan(t, built, ids) for t in texts))]

    return with_text_columns(docs, text, ADDED, compute)
