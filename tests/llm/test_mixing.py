import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lamina.llm import mixing
from tests.llm.conftest import ODD


def described(docs):
    return docs.withColumn("topic", mixing.topic_of(F.col("text"))).withColumn("n_tokens", mixing.n_tokens(F.col("text")))


def test_raked_marginals_are_the_targets():
    draw = np.random.default_rng(1)
    keys = [(a, b, c) for a in "xyz" for b in "pq" for c in "mn"]
    tokens = draw.integers(1, 1000, len(keys)).astype(float)
    targets = [{"x": 0.2, "y": 0.3, "z": 0.5}, {"p": 0.6, "q": 0.4}, {"m": 0.9, "n": 0.1}]
    weights = mixing.rake(keys, tokens, targets)
    for i, target in enumerate(targets):
        for name, share in target.items():
            got = sum(w * t for k, w, t in zip(keys, weights, tokens) if k[i] == name) / tokens.sum()
            assert got == pytest.approx(share, abs=1e-9)


@pytest.mark.parametrize("budget", [0.01, 0.3, 0.5, 0.9, 1.0])
def test_probabilities_meet_the_budget_in_proportion(budget):
    draw = np.random.default_rng(2)
    weights, tokens = draw.exponential(1, 40), draw.integers(1, 100, 40).astype(float)
    p = mixing.calibrate(weights, tokens, budget)
    assert (p <= 1).all() and (p * tokens).sum() == pytest.approx(budget * tokens.sum())
    below = p < 1
    if below.any():
        assert np.ptp(p[below] / weights[below]) < 1e-9 and (p[below].max() / weights[below][p[below].argmax()] * weights[~below] >= 1 - 1e-9).all()


def test_the_draw_is_a_plain_hash(spark):
    rows = spark.createDataFrame([(i,) for i in range(200)] + [(None,)], "doc_id long").select("doc_id", mixing.draw(F.col("doc_id"), 3).alias("u")).collect()
    for r in rows:
        text = f"3:{'' if r.doc_id is None else r.doc_id}"
        assert r.u == int(hashlib.md5(text.encode()).hexdigest()[:12], 16) / 2**48


def test_documents_follow_their_cells(make_docs, prose):
    rows = [(i, prose(i, 20 + i % 30), ["en", "de"][i % 2], f"s{min(i % 7, 3)}", 0) for i in range(300)]
    docs = described(make_docs(rows))
    found = mixing.mix(docs, targets={"lang": {"en": 0.5, "de": 0.5}}, budget=0.4).collect()
    cells = {}
    for r in found:
        key = (r.source, r.lang, r.topic)
        assert cells.setdefault(key, r.probability) == r.probability
        assert r.n_tokens == len(r.text.split())
        assert r.sampled == (int(hashlib.md5(f"7:{r.doc_id}".encode()).hexdigest()[:12], 16) / 2**48 < r.probability)
    total = sum(r.n_tokens for r in found)
    assert sum(r.n_tokens * r.probability for r in found) == pytest.approx(0.4 * total)
    assert sum(r.n_tokens * r.weight for r in found if r.lang == "de") == pytest.approx(0.5 * total, rel=1e-6)


def test_odd_rows_null_categories_and_clashing_columns(odd):
    clash = described(odd).withColumn("source", F.lit(None).cast("string")).withColumn("weight", F.lit("x")).withColumn("sampled", F.lit("y"))
    rows = mixing.mix(clash).collect()
    assert len(rows) == len(ODD) and all(0 <= r.probability <= 1 and r.weight >= 0 for r in rows)
    assert len({r.sampled for r in rows if r.doc_id == 7}) == 1
    assert mixing.mix(described(odd).limit(0)).count() == 0


def test_too_many_cells_raise(odd):
    with pytest.raises(ValueError, match="cells"):
        mixing.mix(described(odd), max_cells=1)
