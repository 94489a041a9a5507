"""SimHash near-dedup: tiled exact comparison of fingerprints.

Fingerprints are 64 bits; two are linked if they differ in at most `radius`. Every pair of distinct
fingerprints that can be linked is compared: a fingerprint's tile is the population counts of its four
16-bit blocks, and two tiles are skipped when these counts differ by more than the radius in sum (one
differing bit changes one count by one, so nothing is lost). A tile is held in a task in chunks, and the
fingerprints of the tiles near it stream past it; blocks of both are compared by numpy exclusive-or and
bit counts. A task reports, for each fingerprint, one link and not all: what its links connect, those
connect too. Equal fingerprints are one from the start, so thousands of copies are one fingerprint.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.llm.common import checkpointed, components, with_text_columns
from lamina.operators.dedup import dedup

SHINGLE = 3
RADIUS = 3
SEED = 42
BLOCKS = 4
# A task's bounds: shingles whose bits are counted at once, and fingerprints compared at once.
SHINGLES_AT_ONCE = 1 << 16
HOME_ROWS, GUEST_ROWS = 1 << 9, 1 << 12


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """SimHash of the word shingles as a signed 64-bit number; 0 for no words."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        joined = [b" ".join(words)]
    else:
        joined = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    hashes = np.frombuffer(b"".join(map(xxhash.xxh64_digest, joined, repeat(SEED))), np.uint8).reshape(-1, 8)
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), SHINGLES_AT_ONCE):
        counts += np.unpackbits(hashes[i : i + SHINGLES_AT_ONCE], axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes)).view(">i8")[0])


def with_fingerprint(docs: DataFrame, text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """The rows with `fingerprint` (long); a column of that name is replaced."""
    added = T.StructType().add("fingerprint", "long")
    return with_text_columns(docs, text, added, lambda texts: [[fingerprint(t, shingle) for t in texts]])


def tile_of(prints: np.ndarray) -> np.ndarray:
    """Population counts of the four blocks -> (n, 4)."""
    return np.bitwise_count(np.ascontiguousarray(prints).view(np.uint16).reshape(-1, BLOCKS)).astype(np.int64)


def neighbours(radius: int) -> np.ndarray:
    """Differences of counts within the radius, one of each pair of opposites, none of no difference."""
    steps = [d for d in product(range(-radius, radius + 1), repeat=BLOCKS) if sum(map(abs, d)) <= radius]
    return np.array([d for d in steps if d > (0,) * BLOCKS], np.int64).reshape(-1, BLOCKS)


def number_of(tiles: np.ndarray) -> np.ndarray:
    return ((tiles[:, 0] * 17 + tiles[:, 1]) * 17 + tiles[:, 2]) * 17 + tiles[:, 3]


class Forest:
    """Which members of a chunk are connected: the smallest index of each member's component."""

    def __init__(self, size: int):
        self.root = np.arange(size)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            ra, rb = self.root[a], self.root[b]
            apart = ra != rb
            if not apart.any():
                return
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            np.minimum.at(self.root, np.maximum(ra, rb), np.minimum(ra, rb))
            while (up := self.root[self.root]).tobytes() != self.root.tobytes():
                self.root = up


def near(a: np.ndarray, b: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    # Unsigned: of a negative number, numpy counts the bits of the absolute value.
    return np.nonzero(np.bitwise_count(a.view(np.uint64)[:, None] ^ b.view(np.uint64)[None, :]) <= radius)


def links_of_chunk(home: np.ndarray, guests: Iterator[np.ndarray], radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (a, b) of linked fingerprints that connect what all links inside `home`, and between it and the guests, connect."""
    forest = Forest(len(home))
    for i in range(0, len(home), HOME_ROWS):
        part = home[i : i + HOME_ROWS]
        for j in range(i, len(home), GUEST_ROWS):
            forest.join(*(x + start for x, start in zip(near(part, home[j : j + GUEST_ROWS], radius), (i, j))))
    for guest in guests:
        for j in range(0, len(guest), GUEST_ROWS):
            block = guest[j : j + GUEST_ROWS]
            first = np.full(len(block), -1)
            for i in range(0, len(home), HOME_ROWS):
                g, h = near(block, home[i : i + HOME_ROWS], radius)
                h = h + i
                fresh = first[g] < 0
                first[g[fresh][::-1]] = h[fresh][::-1]
                forest.join(first[g], h)
            met = first >= 0
            yield block[met], home[first[met]]
    inner = forest.root != np.arange(len(home))
    yield home[inner], home[forest.root[inner]]


def fingerprint_links(prints: DataFrame, radius: int = RADIUS, chunk: int = 1 << 16) -> DataFrame:
    """Distinct fingerprints (column fingerprint) -> (a, b) links that connect whatever all links connect.

    A tile of more than `chunk` fingerprints is split over several tasks, and its guests go to each of them.
    What is shuffled is each fingerprint 65 times (its own tile and, of each pair of near tiles, one), packed
    into one binary value per task and tile.
    """
    spark = prints.sparkSession
    steps = neighbours(radius)

    def tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers, counts = np.unique(number_of(tile_of(batch.column(0).to_numpy())), return_counts=True)
            yield pa.RecordBatch.from_pydict({"tile": numbers, "n": counts})

    # At most 17**4 tiles, of which those over the chunk's size have to be known everywhere.
    large = prints.mapInArrow(tiles, "tile long, n long").groupBy("tile").agg(F.sum("n").alias("n")).where(F.col("n") > chunk)
    chunks = {r.tile: -(-r.n // chunk) for r in large.collect()}

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = np.ascontiguousarray(batch.column(0).to_numpy())
            counts = tile_of(own)
            at = np.concatenate([counts] + [counts + d for d in steps])
            role = np.repeat([0] + [1] * len(steps), len(own))
            prints_ = np.tile(own, 1 + len(steps))
            inside = ((at >= 0) & (at <= 16)).all(axis=1)
            tile, role, prints_ = number_of(at[inside]), role[inside], prints_[inside]
            parts = np.array([chunks.get(t, 1) for t in tile]) if chunks else np.ones(len(tile), np.int64)
            whole = parts == 1
            keys = [(tile[whole], np.zeros(whole.sum(), np.int64), role[whole], prints_[whole])]
            for t in np.unique(tile[~whole]):
                of_tile = tile == t
                own_part = (prints_.view(np.uint64) % np.uint64(n := chunks[t])).astype(np.int64)
                for part in range(n):
                    # Guests come to every part; of the tile's own, one part is held, and those before it are guests.
                    mine = of_tile & ((role == 1) | (own_part <= part))
                    guest = np.where(own_part[mine] == part, role[mine], 1)
                    keys.append((tile[mine], np.full(mine.sum(), part), guest, prints_[mine]))
            tile, part, role, prints_ = (np.concatenate(c) for c in zip(*keys))
            order = np.lexsort((role, part, tile))
            tile, part, role, prints_ = tile[order], part[order], role[order], prints_[order]
            starts = np.flatnonzero(np.r_[True, (np.diff(tile) != 0) | (np.diff(part) != 0) | (np.diff(role) != 0)])
            ends = np.r_[starts[1:], len(tile)]
            for i in range(0, len(starts), 10_000):
                a, b = starts[i : i + 10_000], ends[i : i + 10_000]
                packed = [prints_[x:y].tobytes() for x, y in zip(a, b)]
                yield pa.RecordBatch.from_pydict({"tile": tile[a], "part": part[a], "role": role[a], "packed": packed})

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                yield from zip(*(c.to_pylist() for c in batch.columns))

        stream = rows()
        row = next(stream, None)
        while row is not None:
            key, home = row[:2], []
            while row is not None and row[:2] == key and row[2] == 0:
                home.append(np.frombuffer(row[3], np.int64))
                row = next(stream, None)

            def guests():
                nonlocal row
                while row is not None and row[:2] == key:
                    yield np.frombuffer(row[3], np.int64)
                    row = next(stream, None)

            if not home:
                for _ in guests():
                    pass
                continue
            for a, b in links_of_chunk(np.unique(np.concatenate(home)), guests(), radius):
                if len(a):
                    yield pa.RecordBatch.from_pydict({"a": a, "b": b})

    dealt = prints.mapInArrow(deal, "tile long, part long, role long, packed binary")
    # So many partitions that those with the most probable tiles are worth a task each.
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sorted_ = dealt.repartition(width, "tile", "part").sortWithinPartitions("tile", "part", "role")
    return sorted_.mapInArrow(compare, "a long, b long")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """Per row: doc_id, fingerprint (long), component_id, the smallest id that its links reach.

    Null and empty texts, and texts of blanks, have fingerprint 0, and link like any other; a text of fewer
    words than a shingle is one shingle. Repeated rows, and rows that share an id, each give a row. A null id
    is never a component's id, unless the component has no other. No rows give no rows. Only the id and text
    columns are read, so others don't matter.
    """
    return grouped(docs, doc_id, text, shingle, radius).select("doc_id", "fingerprint", "component_id")


def grouped(docs: DataFrame, doc_id: str, text: str, shingle: int, radius: int) -> DataFrame:
    """Per row: doc_id, t (a hash of the text), fingerprint, root (one fingerprint for each component), component_id."""
    source = F.col(f"`{text}`")
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.xxhash64(source).alias("t"), source.alias("text"))
    marked = checkpointed(with_fingerprint(rows, "text", shingle).drop("text"))
    prints = checkpointed(marked.groupBy("fingerprint").agg(F.min("doc_id").alias("least")))
    roots = components(fingerprint_links(prints.select("fingerprint"), radius)).withColumnRenamed("node", "fingerprint")
    own = prints.join(roots, "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))
    least = own.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = own.join(least, "root").select("fingerprint", "root", "component_id")
    return marked.join(labels, "fingerprint")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row of each component: that with the smallest id, of such that with the smallest hash of its text.

    Rows may share an id and differ in their text: each is in its own text's component. A row without an id stays only
    where no row of its component has one. Of rows that repeat id and text, the first by the other columns stays,
    so that the same rows stay whenever a task is run again.
    """
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "t")
    kept = grouped(docs, doc_id, text, shingle, radius).groupBy("root").agg(F.min(order).alias("first"))
    given = docs.columns
    named = docs.toDF(*[f"c{i}" for i in range(len(given))])
    at = {c: f"c{i}" for i, c in enumerate(given)}
    rows = named.withColumn("t", F.xxhash64(at[text]))
    kept = kept.select(F.col("first.doc_id").alias("kept_id"), F.col("first.t").alias("kept_t"))
    chosen = rows.join(kept, F.col(at[doc_id]).eqNullSafe(F.col("kept_id")) & (F.col("t") == F.col("kept_t")), "left_semi")
    return dedup(chosen, [at[doc_id], "t"]).drop("t").toDF(*given)
