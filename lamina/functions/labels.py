"""Code -> label lookup."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def label(name: str, labels: Mapping) -> Column:
    """Label of a code by a literal map; null for an unknown or null code.

    For a handful of labels. A table of labels is a dimension: see operators.enrich.
    """
    entries = [F.lit(item) for pair in labels.items() for item in pair]
    return F.create_map(*entries)[F.col(name)]
