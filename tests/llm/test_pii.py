import random
import re

import pytest
from pyspark.sql import functions as F

from lamina.llm import pii
from tests.llm.conftest import ODD

# As the contract states them.
STRICT = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(x - 9 * (x > 9) for x in doubled) % 10 == 0


def brute(text):
    spans = []
    for number, (kind, pattern) in enumerate(STRICT.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            passes = {
                "email": lambda: True,
                "ip": lambda: all(int(p) <= 255 for p in m[0].split(".")),
                "card": lambda: 14 <= len(digits) <= 19 and luhn(digits),
                "phone": lambda: 10 <= len(digits) <= 15,
            }[kind]
            if passes():
                spans.append((m.start(), number, kind, m.end()))
    return [f"{k}:{a}:{b}" for a, _, k, b in sorted(spans)]


def base(docs):
    return [(r.doc_id, [x for x in r.base.split(",") if x]) for r in pii.personal_data(docs).select("doc_id", pii.written(F.col("base")).alias("base")).collect()]


def test_base_spans_equal_the_contract(make_docs):
    draw = random.Random(4)
    parts = ["a@b.c", "x.y@d-e.f.g", "@", ".", "..", "_", "1.2.3.4", "256.1.1.1", "007.00255.1.2", "4111 1111-1111 1111", "4111111111111111", "+1 (668) 555-2281",
             "+", "(", "-", " ", "  ", "é", "漢", "𝒳", "12", "5", "0", "a", "B", "\n", "+49.30.123456", "--", "@c.d", "%"]
    texts = ["".join(draw.choice(parts) for _ in range(draw.randint(1, 25))) for _ in range(400)]
    texts += ["a@b.c_x@d.ef", "a@b.c@d.e", "a@b.c..d@e.f", "1.2.3.4.5.6.7.8", "+1 2+3 4567890123", "é" * 50 + "+1 (668) 555-2281", "4111111111111111-"]
    assert dict(base(make_docs(texts))) == {i: brute(t) for i, t in enumerate(texts)}


def test_long_runs_take_linear_time_and_little_stack(make_docs):
    long = [
        "a" * 300_000, "1" * 300_000, "1 " * 150_000, "a@b" + ".c" * 100_000, "1." * 150_000, "+1" + " (" * 100_000, "a.b+" * 80_000, "(1" * 100_000,
    ]
    rows = dict(base(make_docs(long)))
    assert rows[3] == ["email:0:200003"] and not rows[0] and not rows[2]


def corpus(prose, n=300):
    rows = []
    for i in range(n):
        card = "4" + f"{i * 7919:014d}"
        card += next(c for c in "0123456789" if luhn(card + c))
        wrong = card[:-1] + str((int(card[-1]) + 5) % 10)
        rows.append(f"{prose(i, 5)} call +1 ({200 + i}) 555-{1000 + i} {prose(i + 1, 5)} ref {wrong} {prose(i + 2, 4)} pay {card} {10 + i % 90}/{20 + i % 70}/{i:05d}-77 {prose(i, 4)}")
    return rows


def test_trees_add_what_looks_alike_and_keep_the_base(make_docs, prose):
    texts = corpus(prose) + [f"{prose(7, 5)} call 1 (668) 555-2281 {prose(8, 5)}", prose(9, 60), "4111 1111 1111 1111 5500 0000 0000 0004"]
    rows = {r.doc_id: r for r in pii.personal_data(make_docs(texts)).collect()}
    for i, text in enumerate(texts):
        found = [f"{s.kind}:{s.start}:{s.end}" for s in rows[i].base]
        assert found == brute(text) and {*found} <= {f"{s.kind}:{s.start}:{s.end}" for s in rows[i].spans}
    phone = texts[300].index("1 (668)")
    assert [(s.kind, s.start, s.end) for s in rows[300].spans] == [("phone", phone, phone + 16)]
    assert rows[301].spans == []


def test_odd_rows_and_clashing_columns(odd):
    clash = odd.withColumn("row", F.lit("x")).withColumn("t", F.lit("a@b.cd")).withColumn("base", F.lit("z"))
    rows = pii.personal_data(clash).collect()
    assert len(rows) == len(ODD) and all(r.base == r.spans == [] for r in rows)
    assert pii.personal_data(odd.limit(0)).count() == 0


def test_repeated_rows_and_nulls_get_a_row_each(make_docs):
    rows = base(make_docs([(1, "a@b.cd"), (1, "a@b.cd"), (None, "+1 234 567 8901"), (2, None)]))
    assert sorted(map(str, rows)) == sorted(map(str, [(1, ["email:0:6"])] * 2 + [(None, ["phone:0:15"]), (2, [])]))


def test_the_native_path_runs_no_python(odd):
    plan = pii.personal_data(odd)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|ArrowEval", plan)


@pytest.mark.parametrize("kind", pii.KINDS)
def test_kinds_are_counted(make_docs, kind):
    text = "a@b.cd 1.2.3.4, 4111111111111111, +1 (668) 555-2281"
    assert pii.personal_data(make_docs([text])).select(pii.of_kind(F.col("base"), kind)).first()[0] == 1


def test_trees_and_thresholds_are_learned_from_all_proposals(spark, monkeypatch):
    n, seen = 30_000, {}

    class Stop(Exception):
        pass

    class Trees:
        def __init__(self, **_):
            pass

        def fit(self, training):
            seen["n"] = training.count()
            raise Stop

    features = F.array(*[F.lit(0.0)] * pii.n_features())
    rows = spark.range(n).select(F.col("id").alias("row"), F.lit("phone").alias("kind"), F.lit(0).alias("start"), F.lit(9).alias("end"))
    proposed = rows.select("*", F.lit(True).alias("free"), (F.col("row") % 2 == 0).alias("known"), features.alias("features"))
    ids = spark.range(n).select(F.col("id").alias("row"), "id")
    monkeypatch.setattr(pii, "GBTClassifier", Trees)
    with pytest.raises(Stop):
        pii.chosen(proposed, ids)
    assert seen["n"] == ids.where(~pii.in_fold("id", 5, 3)).count()
