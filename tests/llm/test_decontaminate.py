import random

import pytest
from pyspark.sql import functions as F

from lamina.llm import decontaminate as d
from tests.llm.conftest import ODD


def plain_words(text):
    out, word = [], ""
    for c in text or "":
        if "A" <= c <= "Z":
            c = c.lower()
        if c.isascii() and not (c.isdigit() or "a" <= c <= "z"):
            out, word = out + [word] * bool(word), ""
        else:
            word += c
    return out + [word] * bool(word)


def brute(text, items, window):
    doc, hit, found = plain_words(text), set(), set()
    for item_id, item in items:
        words = plain_words(item)
        for i in range(max(1, len(words) - window + 1) if words else 0):
            part = words[i : i + window]
            for j in range(len(doc) - len(part) + 1):
                if doc[j : j + len(part)] == part:
                    hit.update(range(j, j + len(part)))
                    found.add(str(item_id))
    return len(doc), len(hit), sorted(found)


@pytest.mark.parametrize("window", [1, 3, 10])
def test_equals_brute_force(spark, make_docs, window):
    draw = random.Random(window)
    word = lambda: draw.choice(["a", "B", "c9", "É", "d_e"])
    text = lambda n: "".join(word() + draw.choice([" ", "-", "\n", "..", "\t"]) for _ in range(n))
    items = [(i, text(draw.choice([0, 1, 2, 5, 12]))) for i in range(12)]
    docs = [(i, text(draw.randint(0, 40))) for i in range(30)]
    found = d.decontaminate(make_docs(docs), spark.createDataFrame(items, "item_id long, text string"), window=window).collect()
    assert {r.doc_id: (r.n_words, r.n_hit, r.hit_items) for r in found} == {i: brute(t, items, window) for i, t in docs}


def test_spans_point_into_the_original(spark, make_docs, prose):
    item = prose(1, 12, "es")
    text = f"ÑAN, {prose(2, 5)}: ({item.upper().replace('Ó', 'ó').replace('Ñ', 'ñ').replace(' ', '  - ')}!) {prose(3, 9)}"
    row = d.decontaminate(make_docs([text]), spark.createDataFrame([(1, item)], "item_id long, text string")).first()
    assert row.n_hit == 12 and len(row.hit_spans) == 1
    start, end = row.hit_spans[0]
    assert d.words(text[start:end]) == d.words(item)


def test_odd_rows_items_and_columns(spark, odd):
    items = [(1, None), (2, ""), (None, "er"), (3, "the an ing tion er wh"), (3, "the an ing tion er wh"), (4, "!!!")]
    clash = odd.withColumn("n_words", F.lit("x")).withColumn("hit_items", F.lit(1)).withColumn("start", F.lit(2))
    rows = d.decontaminate(clash, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert len(rows) == len(ODD)
    assert [(r.n_hit, r.hit_items) for r in rows if r.doc_id == 7] == [(6, ["", "3"])] * 2
    assert {r.n_words for r in rows if r.text is None} == {0} and {r.n_words for r in rows if r.doc_id == 4} == {1}


def test_no_items_and_no_rows(spark, odd):
    none = spark.createDataFrame([], "item_id long, text string")
    assert {r.n_hit for r in d.decontaminate(odd, none).collect()} == {0}
    assert d.decontaminate(odd.limit(0), none).count() == 0


def test_a_benchmark_beyond_the_bound_raises(spark, odd):
    with pytest.raises(ValueError, match="exceed"):
        d.decontaminate(odd, spark.createDataFrame([(1, "a b c d e")], "item_id long, text string"), max_pattern_bytes=5)
