import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lamina.llm import licenses
from tests.llm.conftest import ODD

SCHEMA = "doc_id long, path string, text string"
MIT, APACHE = "Released under the MIT License.", "Licensed under the Apache License, Version 2.0."


def run(spark, rows):
    return {r.doc_id: r for r in licenses.scan(spark.createDataFrame(rows, SCHEMA), F.col("path")).collect()}


def brute(texts):
    """Best (license, score, unit) of every text, from the definition, over all units."""
    words = lambda t: Counter(re.findall("[a-z0-9]+", (t or "").lower()))
    templates = [(name, words(t)) for name, t in licenses.TEMPLATES]
    n = len(texts)
    df = Counter(w for t in texts for w in words(t))
    weight = {w: math.log((1 + n) / (1 + df[w])) + 1 for _, t in templates for w in t}
    out = []
    for text in texts:
        best = None
        units = [(-1, text or "")] + list(enumerate((text or "").split("\n") if text is not None else []))
        for unit, said in units:
            v = words(said)
            length = math.sqrt(sum((c * weight[w]) ** 2 if w in weight else c * (math.log(1 + n) + 1) ** 2 for w, c in v.items()))
            for name, t in templates:
                norm = math.sqrt(sum((c * weight[w]) ** 2 for w, c in t.items()))
                score = round(sum(v[w] * c * weight[w] ** 2 for w, c in t.items()) / norm / length, 6) if length else 0
                if score >= licenses.LEAST_COSINE and (best is None or (-score, name, unit) < best):
                    best = (-score, name, unit)
        out.append(best)
    return out


def test_equals_brute_force_over_all_units(spark, prose):
    texts = [prose(1, 30), f"{prose(2, 9)}\n{MIT}\n{prose(3, 9)}", APACHE.upper(), f"{MIT} {prose(4, 2)}", f"{MIT} {prose(5, 9)}", None, ""]
    texts += [t for _, t in licenses.TEMPLATES] + ["license", "the work is under this license", "license license mit", f"{MIT}\n{APACHE}"]
    found = run(spark, [(i, f"a/{i}", t) for i, t in enumerate(texts)])
    for i, expected in enumerate(brute(texts)):
        row = found[i]
        assert ((-row.score, row.own_license, row.unit) if row.own_license else None) == (
            (pytest.approx(expected[0], abs=2e-6), *expected[1:]) if expected else None
        ), texts[i]


def test_the_nearest_directory_above_counts(spark):
    rows = [
        (1, "LICENSE", MIT), (2, "a/b/LICENSE.txt", APACHE), (3, "a/b/c/d.py", "x"), (4, "a/x.py", "x"), (5, "top", "x"),
        (6, "a/b/own.py", f"# {MIT}"), (7, "ab/c/COPYING", "nothing"), (8, "ab/c/d", "y"), (9, None, "z"), (10, "a/bc/d", "x"),
    ]
    found = {i: (r.license, r.from_dir) for i, r in run(spark, rows).items()}
    assert found[3] == ("Apache-2.0", "a/b") and found[4] == ("MIT", "") and found[5] == ("MIT", "")
    assert found[6] == ("MIT", None) and found[8] == ("MIT", "") and found[9] == (None, None) and found[10] == ("MIT", "")


def test_of_several_license_files_the_best_counts(spark):
    rows = [(1, "a/LICENSE", f"{MIT} some more"), (2, "a/COPYING", APACHE), (3, "a/x", ""), (4, "b/LICENSE", MIT), (5, "b/COPYING", MIT), (6, "b/x", None)]
    found = run(spark, rows)
    assert found[3].license == "Apache-2.0" and found[6].license == "MIT"


def test_odd_rows_and_clashing_columns(odd):
    clash = odd.withColumn("row", F.lit("x")).withColumn("license", F.lit("y")).withColumn("path", F.lit("z"))
    rows = licenses.scan(clash, F.concat(F.lit("d/"), "doc_id")).collect()
    assert len(rows) == len(ODD) and {r.license for r in rows} == {None}
    assert licenses.scan(odd.limit(0), F.lit("a")).count() == 0


def test_the_native_path_runs_no_python(spark, odd):
    plan = licenses.scan(odd, F.lit("a/b"))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
