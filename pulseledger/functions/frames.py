"""Small DataFrame verbs over expression text."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def aggregate(df: DataFrame, keys: Sequence[str], *measures: str) -> DataFrame:
    """``GROUP BY keys``; each measure reads like ``sum(x) AS total``."""
    return df.groupBy(*keys).agg(*[F.expr(m) for m in measures])


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
