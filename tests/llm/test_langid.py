from pyspark.sql import functions as F

from lamina.llm import langid
from tests.llm.conftest import ODD


def labelled(make_docs, prose, count=20):
    rows = [(i, prose(i, 40, lang), lang, "s", 0) for i, lang in enumerate(["en", "de", "es"] * count)]
    return make_docs(rows)


def test_held_out_texts_are_told_apart(make_docs, prose):
    docs = labelled(make_docs, prose)
    profiles = langid.train(docs, F.col("doc_id") < 30)
    assert profiles.languages == ["de", "en", "es"]
    wrong = langid.predict(docs, profiles).where("lang_pred != lang OR score NOT BETWEEN 0 AND 1").count()
    assert wrong == 0


def test_bundles_equal_a_plain_sum_of_bound_vectors(prose):
    import numpy as np

    text = prose(3, 12) + " Ñandú x"
    clean = "".join(c if c.isalpha() else " " for c in text.lower())
    clean = " " + " ".join(clean.split()) + " "
    expected = np.zeros(64)
    for a, b, c in zip(clean, clean[1:], clean[2:]):
        if b != " ":
            vectors = [langid.letter_vector(0 if x == " " else ord(x), 64, 1).astype(int) for x in (a, b, c)]
            expected += np.roll(vectors[0], 2) * np.roll(vectors[1], 1) * vectors[2]
    found = langid.bundle(["", text, None, "." * 9], None, 4, 64, 1)
    assert (found[1] == expected).all() and not found[[0, 2, 3]].any()


def test_many_letters_take_the_sorted_path_with_the_same_result(monkeypatch, prose):
    texts = [prose(i, 30, lang) for i, lang in enumerate(["en", "de", "es"])] + ["漢字 かな 한글"]
    usual = langid.bundle(texts, None, 4, 32, 1)
    monkeypatch.setattr(langid, "COUNT_CELLS", 50)
    monkeypatch.setattr(langid, "GRAM_BLOCK", 7)
    assert (langid.bundle(texts, None, 4, 32, 1) == usual).all()


def test_odd_rows_and_clashing_columns(make_docs, prose, odd):
    profiles = langid.train(labelled(make_docs, prose), F.lit(True))
    clash = odd.withColumn("lang_pred", F.lit("x")).withColumn("__text", F.lit("y")).withColumn("score", F.lit("z"))
    rows = langid.predict(clash, profiles).collect()
    assert len(rows) == len(ODD)
    for r in rows:
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in r.text or "")), r
    assert {r.lang_pred for r in rows if r.doc_id == 6} == {"de"}
    assert len({(r.lang_pred, r.score) for r in rows if r.doc_id == 7}) == 1


def test_nothing_learned(spark, odd):
    profiles = langid.train(odd.withColumn("lang", F.lit(None).cast("string")), F.lit(True))
    assert profiles.languages == [] and {r.lang_pred for r in langid.predict(odd, profiles).collect()} == {"und"}
    assert langid.predict(odd.limit(0), profiles).count() == 0


def test_ties_go_to_the_first_language(make_docs):
    docs = make_docs([(1, "abc abd", "zz", "s", 0), (2, "abc abd", "aa", "s", 0)])
    assert {r.lang_pred for r in langid.predict(docs, langid.train(docs, F.lit(True))).collect()} == {"aa"}
