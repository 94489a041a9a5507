import random

import pytest
from pyspark.sql import functions as F

from lamina.llm import line_dedup
from tests.llm.conftest import ODD


def brute(rows, least, words=None):
    """Delete every line of a window of `least` said lines, or of fewer with so many words, that began earlier, by (id, place)."""
    said = {d: [(no, line) for no, line in enumerate(t.split("\n")) if line.strip()] for d, t in rows}
    seen, gone = set(), {d: set() for d, _ in rows}
    for d in sorted(said):
        for i in range(len(said[d])):
            for n in range(1, least + 1):
                window = said[d][i : i + n]
                key = tuple(line for _, line in window)
                if len(window) == n and key in seen and (n == least or words and len(" ".join(key).split()) >= words):
                    gone[d].update(no for no, _ in window)
                seen.add(key)
    return {d: "\n".join(line for no, line in enumerate(t.split("\n")) if no not in gone[d]) for d, t in rows}


@pytest.mark.parametrize("least, words", [(1, None), (2, None), (3, 4), (4, 3), (5, 6), (5, None), (3, 2)])
def test_equals_brute_force(make_docs, least, words):
    draw = random.Random(least)
    rows = [(i, "\n".join(draw.choice(["a", "b", "c", "", "d e", "f g h", "i j k l"]) for _ in range(draw.randint(1, 25)))) for i in range(40)]
    found = {r.doc_id: r.text for r in line_dedup.drop_repeated_lines(make_docs(rows), min_lines=least, min_words=words).collect()}
    assert found == brute(rows, least, words)


def test_documents_of_one_long_line(make_docs, prose):
    long, short = prose(1, 60), prose(2, 49)
    rows = {r.doc_id: r for r in line_dedup.drop_repeated_lines(make_docs([long, long, short, short, f"x\n{short}\ny z"])).collect()}
    assert [rows[i].text for i in range(4)] == [long, "", short, short] and rows[4].removed_lines == []


def test_maximal_runs(make_docs):
    docs = make_docs([(1, "a\nb\n\nc\nd\ne"), (2, "x\na\nb\nc\nd\ny\nc\nd\ne"), (3, "q\nr\ns"), (4, "c\nd\ne\nq\n\nr\ns"), (5, "z\nz\nz\nz\nz")])
    found = sorted(tuple(r) for r in line_dedup.maximal_runs(docs).collect())
    assert found == [(2, 1, 4, 4, 1, 0), (2, 6, 8, 3, 1, 3), (4, 0, 2, 3, 1, 3), (4, 3, 6, 3, 3, 0), (5, 1, 3, 3, 5, 0), (5, 2, 4, 3, 5, 0)]


def test_a_run_that_follows_itself(make_docs):
    rows = line_dedup.drop_repeated_lines(make_docs(["a\na\na\na\na", "b\nb\nb"])).collect()
    assert [r.text for r in sorted(rows)] == ["a", "b\nb\nb"]


def test_any_names_may_clash_and_no_python_is_run(make_docs):
    names = ["__gone", "__lines", "__hash", "__id", "__d", "gone", "said", "hash", "id", "d", "c0", "C1", "lines", "first"]
    docs = make_docs([(1, "a\nb\nc"), (2, "a\nb\nc")]).select("*", *[F.lit(n).alias(n) for n in names])
    found = line_dedup.drop_repeated_lines(docs)
    assert sorted((r.doc_id, r.text, r["__gone"], r["C1"]) for r in found.collect()) == [(1, "a\nb\nc", "__gone", "C1"), (2, "", "__gone", "C1")]
    plan = found._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_later_copies_of_a_run_go_and_the_first_stays(make_docs):
    passage = "one one\ntwo two\nthree three\nfour four"
    docs = make_docs([(5, f"x\n{passage}\ny"), (9, f"{passage}"), (7, f"z\n\n{passage}\nw"), (8, "one one\ntwo two")])
    rows = {r.doc_id: r for r in line_dedup.drop_repeated_lines(docs).collect()}
    assert rows[5].text == f"x\n{passage}\ny" and rows[5].removed_lines == []
    assert rows[7].text == "z\n\nw" and rows[7].removed_lines == [2, 3, 4, 5] and rows[7].n_lines == 7
    assert rows[9].text == "" and rows[8].text == "one one\ntwo two"


def test_ranks_follow_the_order_of_pairs(make_docs):
    docs = make_docs(["a\nb\nc", "b\nc", "a\nb\nc\nd", "c\nd"])
    ranks = line_dedup.ranked(line_dedup.lines_of(docs, "doc_id", "text"))
    pairs = line_dedup.longer(ranks, 1)
    ordered = [(r.a, r.b) for r in line_dedup.ranked(pairs).join(pairs.select("id", "pos", "a", "b"), ["id", "pos"]).orderBy("rank").collect()]
    assert ordered == sorted(ordered) and len(set(ordered)) == 3


def test_odd_rows_repeated_rows_and_clashing_columns(make_docs, odd):
    clash = odd.withColumn("n_lines", F.lit("x")).withColumn("id", F.lit("y")).withColumn("d", F.lit(1)).withColumn("pos", F.lit(2))
    rows = line_dedup.drop_repeated_lines(clash).collect()
    assert len(rows) == len(ODD)
    assert sorted((str(r.doc_id), str(r.text)) for r in rows) == sorted((str(d), str(t)) for d, t in ODD)
    assert {r.n_lines for r in rows if r.text is None} == {0} and {r.id for r in rows} == {"y"}


def test_rows_that_share_id_and_text_are_one_document(make_docs):
    text = "a a\nb b\nc c"
    rows = line_dedup.drop_repeated_lines(make_docs([(1, text), (1, text), (None, text), (2, text)])).collect()
    assert sorted((str(r.doc_id), r.text) for r in rows) == [("1", ""), ("1", ""), ("2", ""), ("None", text)]


def test_no_rows(odd):
    assert line_dedup.drop_repeated_lines(odd.limit(0)).count() == 0
