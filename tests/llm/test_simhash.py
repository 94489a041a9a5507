import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from lamina.llm import simhash
from lamina.llm.common import components
from tests.llm.conftest import ODD


def plain_fingerprint(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in lowered).split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    value = sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))
    return value - (1 << 64) if value >> 63 else value


def roots(nodes, links):
    root = {n: n for n in nodes}

    def up(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = up(a), up(b)
        root[max(a, b)] = min(a, b)
    return {n: up(n) for n in nodes}


def test_fingerprint_by_hand(prose):
    texts = [None, "", " \t", "One", "a B", "a b c", "Ünï CÓDE a b x\x1fy z", *(prose(i, n) for i, n in enumerate((3, 4, 50, 999)))]
    assert [simhash.fingerprint(t) for t in texts] == [plain_fingerprint(t) for t in texts]


def test_spark_hashes_the_same(spark, prose):
    text = prose(1, 3)
    spark_hash = spark.range(1).select(F.xxhash64(F.lit(text))).first()[0]
    assert spark_hash & (2**64 - 1) == xxhash.xxh64_intdigest(text.encode(), 42)


@pytest.mark.parametrize("chunk", [5, 1 << 16])
def test_links_connect_what_all_links_connect(spark, chunk):
    draw = random.Random(5)
    prints = {draw.getrandbits(64) for _ in range(200)} | {0, 2**64 - 1, 7}
    for p in list(prints)[:120]:
        for _ in range(draw.randint(1, 4)):
            p ^= sum(1 << b for b in draw.sample(range(64), draw.randint(1, 4)))
            prints.add(p)
    prints = np.array(sorted(prints), np.uint64).view(np.int64).tolist()
    near = [(a, b) for i, a in enumerate(prints) for b in prints[:i] if ((a ^ b) & (2**64 - 1)).bit_count() <= 3]
    frame = spark.createDataFrame([(p,) for p in prints], "fingerprint long").repartition(3)
    found = {r.node: r.root for r in components(simhash.fingerprint_links(frame, chunk=chunk)).collect()}
    expected = roots(prints, near)
    assert {p: found.get(p, p) for p in prints} == expected and len(set(expected.values())) < len(prints) - 100


@pytest.mark.parametrize("shape", ["chain", "star", "random", "loops"])
def test_components(spark, shape):
    draw = random.Random(1)
    edges = {
        "chain": [(i, i + 1) for i in range(300)],
        "star": [(0, i) for i in range(1, 300)] + [(300, 299)],
        "random": [(draw.randrange(400), draw.randrange(400)) for _ in range(220)],
        "loops": [(1, 1), (2, 3), (3, 2), (2, 3)],
    }[shape]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert found == roots(linked, [(a, b) for a, b in edges if a != b])


def test_no_edges(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_documents(make_docs, prose):
    base = prose(1, 400).split()
    near = base[:200] + ["another"] + base[200:]
    docs = make_docs([(8, " ".join(base)), (3, " ".join(near)), (5, " ".join(base)), (1, prose(2, 400)), (9, None), (7, "")])
    expected = {i: simhash.fingerprint(t) for i, t in docs.select("doc_id", "text").collect()}
    linked = [(a, b) for a in expected for b in expected if ((expected[a] ^ expected[b]) & (2**64 - 1)).bit_count() <= 3]
    rows = {r.doc_id: r for r in simhash.near_duplicates(docs).collect()}
    assert {i: r.fingerprint for i, r in rows.items()} == expected
    assert {i: r.component_id for i, r in rows.items()} == roots(expected, linked)
    assert sorted(r.doc_id for r in simhash.keep_one(docs).collect()) == sorted(set(roots(expected, linked).values()))


def test_odd_rows_and_clashing_columns(odd):
    clash = odd.withColumn("fingerprint", F.lit("x")).withColumn("root", F.lit(1)).withColumn("component_id", F.lit(2))
    rows = simhash.near_duplicates(clash).collect()
    assert len(rows) == len(ODD)
    assert {r.component_id for r in rows if r.fingerprint == 0} == {1}
    kept = simhash.keep_one(clash)
    assert kept.columns == clash.columns
    # Of ids 1, 2, 3 and null (no words) the first stays, of the repeated row one, and a row without an id that is alone.
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "4", "6", "7", "None"]
    assert simhash.near_duplicates(odd.limit(0)).count() == 0


def test_keep_one_is_by_row_and_not_by_id(spark, make_docs, prose):
    a, b, c = prose(1), prose(2), prose(3)
    rows = [(3, a), (7, a), (7, b), (7, b), (None, c), (None, a), (9, None), (8, "")]
    found = simhash.keep_one(make_docs(rows).withColumn("t", F.lit("x")))
    assert sorted(((r.doc_id, r.text) for r in found.collect()), key=repr) == sorted([(3, a), (7, b), (None, c), (8, "")], key=repr)
    assert found.columns[-1] == "t"
