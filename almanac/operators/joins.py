"""Joins (J1-J3) and a join that salts hot keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def hot_keys(df: DataFrame, keys: list[str], share: float) -> DataFrame:
    """Keys that hold more than ``share`` of the rows: at most ``1 / share`` of them."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("_total"))
    # the total is one row, so its broadcast is bounded
    return counts.join(F.broadcast(total), F.col("_n") > share * F.col("_total")).select(*keys)


def salted_join(big: DataFrame, small: DataFrame, keys: list[str], buckets: int,
                how: str = "inner", share: float = 0.01) -> DataFrame:
    """Equi-join that spreads the hot keys of ``big`` over ``buckets`` tasks.

    Only keys with more than ``share`` of the rows are salted, and only their partners in ``small``
    are replicated. ``big`` is checkpointed first: the salt is taken from a row's place in the
    checkpoint, so identical copies of one row spread too and a rerun task draws the same salts.
    Prefer AQE's skew join where Spark can split the partition by itself. ``how`` is ``inner`` or
    ``left`` (``big`` on the left).
    """
    from almanac.session import cut_lineage  # local import: session depends on nothing here
    if how not in ("inner", "left"):
        raise ValueError("salted_join supports inner and left joins")
    big = cut_lineage(big)
    hot = F.broadcast(hot_keys(big, keys, share).withColumn("_hot", F.lit(True)))  # at most 1 / share rows
    place = F.pmod(F.monotonically_increasing_id(), F.lit(buckets)).cast("int")
    b = big.withColumn("_place", place).join(hot, keys, "left").withColumn(
        "_salt", F.when(F.col("_hot"), F.col("_place")).otherwise(0)).drop("_place", "_hot")
    salts = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(buckets - 1))).otherwise(F.array(F.lit(0)))
    s = small.join(hot, keys, "left").withColumn("_salt", F.explode(salts)).drop("_hot")
    columns = list(keys) + [c for c in big.columns if c not in keys] + [c for c in small.columns if c not in keys]
    return b.join(s, list(keys) + ["_salt"], how).select(*columns)


def join(df1: DataFrame, df2: DataFrame, on: str | list[str] | dict | Column,
         how: str = "inner", salt_buckets: int | None = None) -> DataFrame:
    """Join with the key given in one of three forms.

    * ``str`` / ``list[str]``: USING join, one key column in the output.
    * ``dict`` ``{"df1_col": a, "df2_col": b}``: equi-join, both keys kept.
    * ``Column``: any boolean condition (equi or theta).
    Missing key columns raise at analysis time. ``salt_buckets`` (USING form, inner/left)
    routes the join through :func:`salted_join` for a skewed ``df1``.
    """
    if isinstance(on, dict):
        left, right = on["df1_col"], on["df2_col"]
        for frame, name in ((df1, left), (df2, right)):
            if name not in frame.columns:
                raise ValueError(f"unknown join column {name!r}")
        on = df1[left] == df2[right]
    elif isinstance(on, (str, list)):
        keys = [on] if isinstance(on, str) else list(on)
        for k in keys:
            if k not in df1.columns or k not in df2.columns:
                raise ValueError(f"join column {k!r} missing on one side")
        if salt_buckets:
            return salted_join(df1, df2, keys, salt_buckets, how)
    return df1.join(df2, on, how)
