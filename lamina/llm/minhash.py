"""MinHash near-dedup with tensored banding, verified on full sets.

A document is the set of its word shingles. Two small collections of band hashes are computed, each band from a few
minhashes, and table keys are formed by combining every band of the first with every band of the second: with 14
and 14 bands of three minhashes, 196 tables of six from 84 minhashes, where tables of their own would take 1,176.
Two sets meet in a table exactly if they agree in a band of each collection, so keys are formed only of bands in
which a set agrees with some other one. At a similarity of 0.85 two sets fail to meet once in 150,000 times.

Documents with equal sets are one class. Classes that meet are verified on full sets, in three steps, each of which
only looks at what the first has left apart:

1. Each class is compared with two others: of the classes that lead a band (the one that shares bands with most others
   leads), the one with which it agrees in most bands, and the leader above all. A group of copies of one text so
   costs two comparisons a copy.
2. Following the leader above all gives clusters. Where a cluster is not yet one component, its sets are compared in
   full, in tasks that hold a part of the cluster and let the parts after it pass by; a cluster of any size is split into
   parts of bounded size, and a task reports only what connects.
3. Classes of different clusters that agree in a band are joined on a shingle of their prefixes: with shingles in
   order of their frequency, rarest first, two similar enough sets share one among the first n - ceil(0.85 n) + 1.
   Only pairs that meet in a table are verified.

So no link between different sets that meet is lost, and no pairs of a group are listed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.llm.common import checkpointed, components

SHINGLE = 3
# Similarity in hundredths.
LEAST = 85
BANDS, ROWS = 14, 3
SEED = 13
# Shingles whose minhashes are computed at once.
SHINGLES_AT_ONCE = 1 << 14
# A task's part of a cluster, and how many sets pass by at once.
TOKENS_AT_ONCE, SETS_AT_ONCE, GUESTS_AT_ONCE = 1 << 21, 1 << 11, 1 << 10
# A token is counted in a matrix if this many times the pairs that have it are all pairs; and what is done at once.
DENSE_FROM, PAIRS_AT_ONCE, COLUMNS_AT_ONCE = 64, 1 << 22, 512
SLOTS = 1 << 20
# Rows of a few numbers that may be sent to all tasks: some 20 MB.
ROWS_SENT = 250_000


def shingles(text: bytes | None, size: int = SHINGLE) -> set[bytes]:
    """The distinct shingles of UTF-8 text; of fewer words than a shingle, all in one; of none, none."""
    words = (text or b"").lower().split()
    if len(words) < size:
        return {b" ".join(words)} if words else set()
    return set(map(b" ".join, zip(*(words[i:] for i in range(size)))))


def similar(a: set[bytes], b: set[bytes], least: int = LEAST) -> bool:
    common = len(a & b)
    return 100 * common >= least * (len(a) + len(b) - common) > 0


class Sketcher:
    """The bands of a set: `bands` of the first collection, then as many of the second."""

    def __init__(self, bands: int = BANDS, rows: int = ROWS):
        self.bands, self.rows = bands, rows
        draw = np.random.default_rng(SEED)
        self.factors = draw.integers(0, 2**63, 2 * bands * rows, np.uint64) * np.uint64(2) + np.uint64(1)
        self.offsets = draw.integers(0, 2**64 - 1, 2 * bands * rows, np.uint64)

    def of(self, hashes: np.ndarray) -> np.ndarray:
        least = np.full(len(self.factors), 2**64 - 1, np.uint64)
        for i in range(0, len(hashes), SHINGLES_AT_ONCE):
            part = hashes[i : i + SHINGLES_AT_ONCE, None] * self.factors + self.offsets
            np.minimum(least, part.min(axis=0), out=least)
        of_bands = least.reshape(2 * self.bands, self.rows)
        return np.array([xxhash.xxh64_intdigest(b.tobytes(), i) for i, b in enumerate(of_bands)], np.uint64).view(np.int64)


def sketched(docs: DataFrame, size: int, bands: int, rows: int) -> DataFrame:
    """Rows (doc_id, t: hash of the text, text) -> doc_id, t, n, set_id (128 bits, null for an empty set), bands."""
    sketcher = Sketcher(bands, rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, names, sketches = [], [], []
            for text in batch.column(2):
                found = shingles(text.as_py(), size)
                sizes.append(len(found))
                if not found:
                    names.append(None)
                    sketches.append(None)
                    continue
                hashes = hashes_of(found)
                names.append(xxhash.xxh3_128_digest(b"\n".join(sorted(found))))
                sketches.append(sketcher.of(hashes))
            columns = [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(names, pa.binary()), pa.array(sketches, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "t", "n", "set_id", "bands"])

    return docs.mapInArrow(run, "doc_id long, t long, n long, set_id binary, bands array<long>")


def verified(pairs: DataFrame, texts: DataFrame, size: int, least: int) -> DataFrame:
    """Of pairs (a, b) of classes those whose full sets are similar enough."""
    # Pairs with one a come together, so that its set is built once.
    both = pairs.join(texts.select(F.col("rep").alias("b"), F.col("text").alias("y")), "b")
    both = both.join(texts.select(F.col("rep").alias("a"), F.col("text").alias("x")), "a").select("a", "b", "x", "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, mine = None, set()
        for batch in batches:
            found = []
            for i in range(batch.num_rows):
                a, b = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                if a != held:
                    held, mine = a, shingles(batch.column(2)[i].as_py(), size)
                if similar(mine, shingles(batch.column(3)[i].as_py(), size), least):
                    found.append((a, b))
            yield pa.RecordBatch.from_pydict({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})

    return both.mapInArrow(run, "a long, b long")


def close_in_size(m: str | Column, n: str | Column, least: int) -> Column:
    """Whether sets of these sizes can be similar enough."""
    return 100 * F.least(m, n) >= least * F.greatest(m, n)


def common_counts(g_tokens: np.ndarray, g_own: np.ndarray, g: int, h_tokens: np.ndarray, h_own: np.ndarray, h: int) -> np.ndarray:
    """How many tokens each of g sets has in common with each of h; a set's tokens are distinct, `own` says whose they are.

    Tokens that many sets have are counted by products of matrices of zeros and ones, others pair by pair.
    """
    known = np.intersect1d(g_tokens, h_tokens)
    counts = np.zeros(g * h, np.int64)
    if not len(known):
        return counts.reshape(g, h)

    def by_column(tokens, own):
        at = np.minimum(np.searchsorted(known, tokens), len(known) - 1)
        held = known[at] == tokens
        order = np.argsort(at[held], kind="stable")
        return at[held][order], own[held][order]

    (g_col, g_own), (h_col, h_own) = by_column(g_tokens, g_own), by_column(h_tokens, h_own)
    g_n, h_n = np.bincount(g_col, minlength=len(known)), np.bincount(h_col, minlength=len(known))
    dense = g_n * h_n * DENSE_FROM > g * h
    h_start = np.r_[0, np.cumsum(h_n)]
    few = ~dense[g_col]
    col, own = g_col[few], g_own[few]
    ends = np.cumsum(h_n[col])
    first = 0
    while first < len(col):
        done = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, done + PAIRS_AT_ONCE, "right")))
        times = h_n[col[first:last]]
        inside = np.arange(times.sum()) - np.repeat(np.r_[0, np.cumsum(times)[:-1]], times)
        met = h_own[np.repeat(h_start[col[first:last]], times) + inside]
        counts += np.bincount(np.repeat(own[first:last], times) * h + met, minlength=g * h)
        first = last
    counts = counts.reshape(g, h)
    place = np.cumsum(dense) - 1
    for start in range(0, int(dense.sum()), COLUMNS_AT_ONCE):
        sides = []
        for col, own, n in ((g_col, g_own, g), (h_col, h_own, h)):
            at = dense[col] & (place[col] >= start) & (place[col] < start + COLUMNS_AT_ONCE)
            side = np.zeros((n, COLUMNS_AT_ONCE), np.float32)
            side[own[at], place[col[at]] - start] = 1
            sides.append(side)
        counts += (sides[0] @ sides[1].T).astype(np.int64)
    return counts


class Part:
    """Sets of a cluster that a task holds: their classes, components and tokens."""

    def __init__(self, rows: list[tuple]):
        self.reps = np.array([r[0] for r in rows], np.int64)
        self.labels = np.array([r[1] for r in rows], np.int64)
        sets = [np.frombuffer(r[2], np.int64) for r in rows]
        self.sizes = np.array([len(x) for x in sets], np.int64)
        self.tokens = np.concatenate(sets)
        self.own = np.repeat(np.arange(len(rows)), self.sizes)


def connecting(home: Part, guests: Iterator[Part], least: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (a, b) of classes, linked and of different components, that connect what all such pairs connect."""
    root: dict[int, int] = {}

    def up(x: int) -> int:
        while x in root:
            x = root[x]
        return x

    for guest in guests:
        common = common_counts(guest.tokens, guest.own, len(guest.reps), home.tokens, home.own, len(home.reps))
        apart = guest.labels[:, None] != home.labels[None, :]
        i, j = np.nonzero(apart & (100 * common >= least * (guest.sizes[:, None] + home.sizes[None, :] - common)))
        found = []
        # One link for each pair of components, and of these those that connect.
        _, first = np.unique(np.stack([guest.labels[i], home.labels[j]]), axis=1, return_index=True)
        for x, y in zip(i[first], j[first]):
            p, q = up(int(guest.labels[x])), up(int(home.labels[y]))
            if p != q:
                root[max(p, q)] = min(p, q)
                found.append((x, y))
        if found:
            x, y = (np.array(k) for k in zip(*found))
            yield guest.reps[x], home.reps[y]


def links_in_clusters(members: DataFrame, size: int, least: int) -> DataFrame:
    """Members (cluster, parts, rep, label, text) -> links (a, b) between components of one cluster.

    Shingles are told apart by 64-bit hashes here, whole sets of them.
    """
    spark = members.sparkSession

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cluster, parts, rep, label, text in zip(*(c.to_pylist() for c in batch.columns)):
                tokens = np.sort(hashes_of(shingles(text, size)).view(np.int64)).tobytes()
                own = rep * 0x9E3779B97F4A7C15 % (1 << 64) * parts >> 64
                # Held in its own part, and passing by the parts before it.
                at = list(range(own + 1))
                same = [[x] * len(at) for x in (cluster, rep, label, tokens)]
                columns = [same[0], at, [int(p < own) for p in at], *same[1:]]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, TYPES)], names=NAMES)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
        row = next(rows, None)
        while row is not None:
            key, home = row[:2], []
            while row is not None and row[:2] == key and row[2] == 0:
                home.append(row[3:])
                row = next(rows, None)

            def guests():
                nonlocal row
                for i in range(0, len(home), GUESTS_AT_ONCE):
                    yield Part(home[i : i + GUESTS_AT_ONCE])
                block = []
                while row is not None and row[:2] == key:
                    block.append(row[3:])
                    row = next(rows, None)
                    if len(block) == GUESTS_AT_ONCE:
                        yield Part(block)
                        block = []
                if block:
                    yield Part(block)

            if not home:
                while row is not None and row[:2] == key:
                    row = next(rows, None)
                continue
            for a, b in connecting(Part(home), guests(), least):
                yield pa.RecordBatch.from_pydict({"a": a, "b": b})

    dealt = members.select("cluster", "parts", "rep", "label", "text").mapInArrow(
        deal, "cluster long, part long, role long, rep long, label long, tokens binary"
    )
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    together = dealt.repartition(width, "cluster", "part").sortWithinPartitions("cluster", "part", "role")
    return together.mapInArrow(compare, "a long, b long")


NAMES = ["cluster", "part", "role", "rep", "label", "tokens"]
TYPES = [pa.int64()] * 5 + [pa.binary()]


def hashes_of(found: set[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(map(xxhash.xxh64_digest, found)), ">u8").astype(np.uint64)


def prefixes(texts: DataFrame, size: int, least: int) -> DataFrame:
    """Texts (rep, text) -> (rep, token): the rarest shingles of each set, enough that similar sets share one.

    Frequencies are counted in 2**20 slots, which is a bound on what is collected; they decide the order only, and
    any order is right.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slots = [hashes_of(shingles(t.as_py(), size)) & np.uint64(SLOTS - 1) for t in batch.column(1)]
            held, n = np.unique(np.concatenate(slots), return_counts=True)
            yield pa.RecordBatch.from_pydict({"slot": held.astype(np.int64), "n": n})

    counted = texts.select("rep", "text").mapInArrow(count, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    seen = np.zeros(SLOTS, np.int64)
    seen[counted["slot"].to_numpy()] = counted["n"].to_numpy()
    shared = texts.sparkSession.sparkContext.broadcast(seen)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            reps, tokens = [], []
            for rep, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                hashes = hashes_of(shingles(text.as_py(), size))
                order = np.lexsort((hashes, shared.value[hashes & np.uint64(SLOTS - 1)]))
                length = len(hashes) - -(-least * len(hashes) // 100) + 1
                tokens.append(hashes[order[:length]].view(np.int64))
                reps.append(np.full(len(tokens[-1]), rep, np.int64))
            yield pa.RecordBatch.from_pydict({"rep": np.concatenate(reps), "token": np.concatenate(tokens)})

    return texts.select("rep", "text").mapInArrow(choose, "rep long, token long")


def small(rows: DataFrame) -> DataFrame:
    """The rows, to be sent to all tasks if they are few, which is counted; else to be joined like any others."""
    return F.broadcast(rows) if rows.count() <= ROWS_SENT else rows


def to_the_top(points: DataFrame) -> DataFrame:
    """(rep, top) -> the same with the end of each chain, by joining chains to chains."""
    now = checkpointed(points)
    while True:
        ahead = now.select(F.col("rep").alias("top"), F.col("top").alias("next"))
        following = checkpointed(now.join(ahead, "top").select("rep", F.col("next").alias("top"), (F.col("next") != F.col("top")).alias("moved")))
        if following.where("moved").isEmpty():
            return now
        now = following.drop("moved")


def labelled(rows: DataFrame, links: DataFrame) -> DataFrame:
    """The rows (with rep) with the smallest class of their component."""
    roots = components(links).select(F.col("node").alias("rep"), F.col("root").alias("label"))
    return rows.join(roots, "rep", "left").withColumn("label", F.coalesce("label", "rep"))


def undecided(rows: DataFrame, key: str, of: str = "label") -> DataFrame:
    """The rows under keys that hold more than one value."""
    mixed = rows.groupBy(key).agg(F.min(of).alias("lo"), F.max(of).alias("hi")).where("lo < hi")
    return rows.join(mixed.select(key), key, "left_semi")


def linked(classes: DataFrame, docs: DataFrame, size: int, least: int, bands: int) -> DataFrame:
    """Classes (rep, n, bands, chosen) -> (node, root) of those that have a link."""
    single = classes.select("rep", F.explode("bands").alias("h"))
    shared = single.groupBy("h").agg(F.count("*").alias("held")).where("held > 1")
    met = checkpointed(single.join(shared, "h"))
    weights = checkpointed(met.groupBy("rep").agg(F.sum("held").alias("weight")))
    key = [F.coalesce("doc_id", F.lit(0)).alias("d"), F.col("doc_id").isNull().alias("unnamed"), "t"]
    wanted = weights.join(classes, "rep").select("rep", "chosen.*").select("rep", *key)
    # Rows that repeat an id and its text: one of them.
    texts = docs.select(*key, "text").groupBy("d", "unnamed", "t").agg(F.first("text").alias("text"))
    texts = checkpointed(texts.join(wanted, ["d", "unnamed", "t"]).select("rep", "text"))

    # 1. The leaders of bands.
    weighed = met.join(weights, "rep").select("rep", "h", "weight")
    lead = F.struct("weight", (-F.col("rep")).alias("less"))
    led = weighed.join(weighed.groupBy("h").agg(F.max(lead).alias("lead")), "h")
    by_leader = checkpointed(led.groupBy("rep", F.col("lead.weight").alias("weight"), F.col("lead.less").alias("less")).agg(F.count("*").alias("agreed")))
    lead = F.struct("weight", "less")
    tops = to_the_top(by_leader.groupBy("rep").agg((-F.max(lead)["less"]).alias("top")))
    sizes = classes.select("rep", "n")
    others = by_leader.where("rep <> -less").join(sizes, "rep").join(sizes.select((-F.col("rep")).alias("less"), F.col("n").alias("m")), "less")
    others = others.where(close_in_size("n", "m", least)).withColumn("lead", lead)
    chosen = others.groupBy("rep").agg(F.max(F.struct("agreed", "lead")).alias("most"), F.max("lead").alias("above"))
    pairs = chosen.select(F.col("rep").alias("b"), F.explode(F.array_distinct(F.array(-F.col("most.lead.less"), -F.col("above.less")))).alias("a"))
    links = checkpointed(verified(pairs, texts, size, least))

    # 2. Inside clusters.
    members = checkpointed(labelled(tops.withColumnRenamed("top", "cluster").join(classes.select("rep", "n"), "rep"), links))
    load = members.groupBy("cluster").agg(F.greatest(F.ceil(F.sum("n") / TOKENS_AT_ONCE), F.ceil(F.count("*") / SETS_AT_ONCE)).alias("parts"))
    mixed = checkpointed(undecided(members, "cluster").join(load, "cluster"))
    links = links.union(checkpointed(links_in_clusters(texts.join(small(mixed), "rep"), size, least)))

    # 3. Between clusters.
    placed = met.select("rep", "h").join(members, "rep").select("rep", "h", "cluster", "label")
    crossing = checkpointed(undecided(undecided(placed, "h", "cluster"), "h").select("rep").distinct())
    tokens = prefixes(texts.join(small(crossing), "rep"), size, least).join(members, "rep")
    tokens = checkpointed(undecided(undecided(tokens, "token", "cluster"), "token"))
    other = tokens.select("token", *[F.col(c).alias(f"{c}2") for c in ("rep", "n", "cluster", "label")])
    joined = tokens.join(other, "token").where("rep < rep2 AND cluster <> cluster2 AND label <> label2").where(close_in_size("n", "n2", least))
    pairs = joined.select(F.col("rep").alias("a"), F.col("rep2").alias("b")).distinct()
    for side in ("a", "b"):
        pairs = pairs.join(classes.select(F.col("rep").alias(side), F.col("bands").alias(f"{side}_bands")), side)
    for half in (1, bands + 1):
        pairs = pairs.where(F.arrays_overlap(F.slice("a_bands", half, bands), F.slice("b_bands", half, bands)))
    pairs = checkpointed(pairs.select("a", "b"))
    ends = checkpointed(pairs.select(F.explode(F.array("a", "b")).alias("rep")).distinct())
    links = links.union(checkpointed(verified(pairs, texts.join(small(ends), "rep"), size, least)))
    return components(links)


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SHINGLE, least: int = LEAST, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (the smallest id that its links reach), kept.

    Documents are linked if 100 * intersection >= least * union of their sets of shingles. A text of fewer words
    than a shingle is one shingle; null and empty texts, and texts of blanks, have no shingle and no link, each row
    for itself. Repeated rows, and rows that share an id, each give a row. A null id is no component's id unless
    the component has no other; kept says that a row has its component's id. Copies of one set are one class,
    so a group of any size costs a row each. No rows give no rows; only the id and text columns are read.
    """
    source = F.col(f"`{text}`").cast("string")
    read = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.xxhash64(source).alias("t"), source.cast("binary").alias("text"))
    marked = checkpointed(sketched(read, size, bands, rows))
    named = marked.where("set_id IS NOT NULL").groupBy("set_id")
    classes = named.agg(F.min("doc_id").alias("least"), F.min(F.struct("doc_id", "t")).alias("chosen"), F.first("n").alias("n"), F.first("bands").alias("bands"))
    classes = checkpointed(classes.withColumn("rep", F.monotonically_increasing_id()))
    roots = linked(classes, read, size, least, bands).withColumnRenamed("node", "rep")
    rooted = classes.select("set_id", "rep", "least").join(roots, "rep", "left").withColumn("root", F.coalesce("root", "rep"))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = rooted.join(smallest, "root").select("set_id", "component_id")
    out = marked.join(labels, "set_id", "left")
    component = F.when(F.col("set_id").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
    )
