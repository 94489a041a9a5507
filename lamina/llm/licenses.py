"""License scan: TF-IDF cosine of lines and whole files to license templates, then inheritance by directory.

Every line of a text (a header) and every text as a whole (a license file) is a vector of its words, weighted
by their rarity in the corpus, and is compared with the templates. Only words of templates have a coordinate
of their own; every other word of a unit lengthens its vector as an unseen word would. A file takes the
license of its best unit from `LEAST_COSINE` on; a file without one takes that of the license file in the
nearest directory above it.

Only DataFrame functions are used. A text cannot reach the cosine if what it shares with each template is too
short a part of it (by the Cauchy-Schwarz inequality), so only the others are taken apart, and nothing is lost.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.llm.common import checkpointed

LEAST_COSINE = 0.7
LICENSE_FILE = r"(?i)^(licen[cs]e|copying|unlicense)([.-].*)?$"
WORD = "[a-z0-9]+"

# How public licenses name themselves in headers and notices.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
)


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def template_words(text: str) -> Counter:
    return Counter(re.findall(WORD, text.lower()))


def present(text: Column) -> Column:
    """The distinct words of a text that a template has."""
    vocabulary = sorted({w for _, said in TEMPLATES for w in template_words(said)})
    return F.array_intersect(words_of(F.coalesce(text, F.lit(""))), F.array(*[F.lit(w) for w in vocabulary]))


def word_weights(files: DataFrame) -> tuple[dict[str, float], float]:
    """Weight of each word of the templates by its rarity among all texts, and that of an unseen word."""
    # As many rows as the templates have words, and one for all texts.
    held = files.select(F.explode(F.concat(F.array(F.lit("")), present(F.col("text")))).alias("word"))
    counts = {r.word: r.n for r in held.groupBy("word").agg(F.count("*").alias("n")).collect()}
    n = counts.get("", 0)
    words = {w for _, said in TEMPLATES for w in template_words(said)}
    return {w: math.log((1 + n) / (1 + counts.get(w, 0))) + 1 for w in sorted(words)}, math.log(1 + n) + 1


def may_reach(words: Column, weights: dict[str, float], least: float) -> Column:
    """Whether a unit with these words of templates can reach the cosine `least` with one of them.

    The product is at most the unit's length times that of the part of the template which it shares.
    """
    found = F.lit(False)
    for _, said in TEMPLATES:
        parts = {w: (n * weights[w]) ** 2 for w, n in template_words(said).items()}
        shared = reduce(lambda a, b: a + b, [F.when(F.array_contains(words, w), v).otherwise(0.0) for w, v in parts.items()])
        # Scores are rounded to six places.
        found |= shared >= F.lit((least - 1e-6) ** 2 * sum(parts.values()))
    return found


def best_licenses(units: DataFrame, weights: dict[str, float], unseen: float, least: float) -> DataFrame:
    """Units (row, unit, said) -> (row, license, score, unit) of the rows whose best unit reaches `least`.

    Ties go to the license that comes first in the alphabet, then to the first unit.
    """
    spark = units.sparkSession
    terms = []
    for number, (name, said) in enumerate(TEMPLATES):
        words = template_words(said)
        norm = math.sqrt(sum((c * weights[w]) ** 2 for w, c in words.items()))
        terms += [(w, number, name, c * weights[w] / norm) for w, c in words.items()]
    each = units.select("row", "unit", F.explode(words_of(F.col("said"))).alias("word")).groupBy("row", "unit", "word").count()
    # Both tables are as large as the templates.
    rarity = F.broadcast(spark.createDataFrame(list(weights.items()), "word string, weight double"))
    weighed = each.join(rarity, "word", "left")
    # An unseen word counts once for each time it occurs, as if it were another each time.
    square = F.when(F.col("weight").isNull(), F.col("count") * F.lit(unseen**2)).otherwise((F.col("count") * F.col("weight")) ** 2)
    lengths = weighed.groupBy("row", "unit").agg(F.sqrt(F.sum(square)).alias("length"))
    templates = F.broadcast(spark.createDataFrame(terms, "word string, template int, license string, share double"))
    shared = weighed.join(templates, "word")
    products = shared.groupBy("row", "unit", "template", "license").agg(F.sum(F.col("count") * F.col("weight") * F.col("share")).alias("product"))
    scored = products.join(lengths, ["row", "unit"]).withColumn("score", F.round(F.col("product") / F.col("length"), 6)).where(F.col("score") >= least)
    best = scored.groupBy("row").agg(F.min(F.struct((-F.col("score")).alias("down"), "license", "unit")).alias("best"))
    return best.select("row", "best.license", (-F.col("best.down")).alias("score"), "best.unit")


def directory(path: Column) -> Column:
    """What stands before the last slash; the empty directory for none."""
    return F.regexp_replace(path, "/?[^/]*$", "")


def nearest_above(directories: DataFrame, owners: DataFrame) -> DataFrame:
    """(dir, license, from_dir) of the nearest directory above or at each that owns a license."""
    steps = F.split("dir", "/", -1)
    above = F.transform(F.sequence(F.lit(1), F.size(steps)), lambda n: F.array_join(F.slice(steps, 1, n), "/"))
    above = F.array_distinct(F.concat(F.array(F.lit("")), above))
    met = directories.select("dir", F.posexplode(above).alias("depth", "from_dir")).join(owners, "from_dir")
    nearest = met.groupBy("dir").agg(F.max(F.struct("depth", "license", "from_dir")).alias("x"))
    return nearest.select("dir", "x.license", "x.from_dir")


def scan(files: DataFrame, path: Column, doc_id: str = "doc_id", text: str = "text", least: float = LEAST_COSINE) -> DataFrame:
    """Per row: doc_id, path, own_license, score, unit, license, from_dir.

    license is the file's own, or that of the nearest directory (from_dir) at or above its own which has a license file
    (named LICENSE, COPYING or so) with a license; of several in a directory the best score counts, then the
    first in the alphabet. Without either it is null, as for null and empty texts outside such a directory. A null path has
    no directory to inherit from. Repeated rows get a row each. Only id, text and path are read; whole texts are.
    """
    rows = files.select(
        F.monotonically_increasing_id().alias("row"), F.col(f"`{doc_id}`").alias("id"), path.cast("string").alias("path"), F.col(f"`{text}`").cast("string").alias("text")
    )
    weights, unseen = word_weights(rows)
    # One pass gives every row its number and, to the few texts that can state a license, their units.
    whole = F.struct(F.lit(-1).alias("unit"), F.col("text").alias("said"))
    lines = F.transform(F.split("text", "\n", -1), lambda line, i: F.struct(i.alias("unit"), line.alias("said")))
    units = F.when(may_reach(F.col("words"), weights, least), F.concat(F.array(whole), lines))
    marked = rows.select("row", "id", "path", directory(F.col("path")).alias("dir"), "text", present(F.col("text")).alias("words"))
    marked = checkpointed(marked.select("row", "id", "path", "dir", units.alias("units")))
    known = marked.drop("units")
    own = checkpointed(best_licenses(marked.select("row", F.inline("units")), weights, unseen, least))
    named = F.regexp_extract("path", "[^/]*$", 0).rlike(LICENSE_FILE)
    owners = known.where(named).join(own, "row").groupBy("dir").agg(F.min(F.struct((-F.col("score")).alias("down"), "license")).alias("x"))
    owners = owners.select(F.col("dir").alias("from_dir"), "x.license")
    above = nearest_above(known.select("dir").where("dir IS NOT NULL").distinct(), owners).withColumnRenamed("license", "inherited")
    joined = known.join(own, "row", "left").join(above, "dir", "left")
    return joined.select(
        F.col("id").alias(doc_id), "path", F.col("license").alias("own_license"), "score", "unit",
        F.coalesce("license", "inherited").alias("license"), F.when(F.col("license").isNull(), F.col("from_dir")).alias("from_dir"),
    )
