"""Grouped aggregation (A1, A2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def group_agg(df: DataFrame, by: list[str], aggs: dict[str, str]) -> DataFrame:
    """``groupBy(by).agg`` with each result named after its input column.

    ``aggs`` maps column -> any Spark aggregate name (sum, avg, mean, max, min, count, ...).
    ``{"*": "count"}`` yields a column named ``count``. For algebraic aggregates (sum, avg,
    min, max, count, ...) Spark plans a partial (map-side) aggregate before the shuffle, so a
    hot key is combined per task before it moves. Holistic ones (``collect_list``,
    ``percentile``) gather a whole group in one task and belong only on bounded groups.
    """
    exprs = []
    for col, fn in aggs.items():
        if col == "*":
            exprs.append(F.expr(f"{fn}(1)").alias(fn))
        else:
            if col not in df.columns:
                raise ValueError(f"unknown column {col!r}")
            exprs.append(F.expr(f"{fn}(`{col}`)").alias(col))
    return df.groupBy(*by).agg(*exprs)
