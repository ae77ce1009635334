"""Lag features."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def lag_names(input_col: str, lags) -> list[str]:
    return [f"lag_{input_col}_{k}" for k in lags]


def lag_features(df: DataFrame, input_col: str, part_cols: list[str], order_cols: list[str],
                 lags, cast: str | None = None) -> DataFrame:
    """Add ``lag_{input_col}_{k}``: the value k rows earlier in the partition, null at the start.

    One select over one window spec: Catalyst plans a single Window node and a single sort.
    Lags count rows, not calendar months (a gap in the series is not filled).
    """
    w = Window.partitionBy(*part_cols).orderBy(*order_cols)
    src = F.col(input_col).cast(cast) if cast else F.col(input_col)
    cols = [F.lag(src, int(k)).over(w).alias(name) for k, name in zip(lags, lag_names(input_col, lags))]
    return df.select("*", *cols)


def lag_features_ranged(df: DataFrame, input_col: str, part_cols: list[str], order_cols: list[str], lags,
                        ranges: int) -> DataFrame:
    """:func:`lag_features` where one key may hold very many rows: the same columns, in ``ranges`` tasks per key.

    Rows are range-partitioned by (key, order) and written once, so every range knows its number. Each range hands
    its last ``max(lags)`` rows to the ranges after it, as far as these need them, and the window runs per (range,
    key). What is handed over is ``ranges * max(lags)`` rows, whatever the number of rows; only the number of rows
    handed on by each range, one number a range, reaches the driver. Rows of equal key and order stay in one range;
    their order among each other is left open, as in :func:`lag_features`.
    """
    from almanac.session import cut_lineage  # local import: session depends on nothing here
    reach = max(int(k) for k in lags)
    key, order = [F.col(c) for c in part_cols], [F.col(c) for c in order_cols]
    placed = cut_lineage(df.repartitionByRange(max(1, ranges), *key, *order).withColumn("_range", F.spark_partition_id()))
    last = Window.partitionBy("_range").orderBy(*[F.desc(c) for c in (*part_cols, *order_cols)])
    tails = placed.withColumn("_back", F.row_number().over(last)).filter(F.col("_back") <= reach)
    tails = cut_lineage(tails.select(*df.columns, "_range", "_back"))
    handed = {r["_range"]: r["n"] for r in tails.groupBy("_range").agg(F.count(F.lit(1)).alias("n")).collect()}
    # a range's tail goes to the next ranges until they have been handed as many rows as the longest lag needs
    targets, numbers = [], sorted(handed)
    for i, r in enumerate(numbers):
        between = 0  # rows that ranges in between hand on
        for later in numbers[i + 1:]:
            if between >= reach:
                break
            targets.append((r, later, reach - between))
            between += handed[later]
    goes = df.sparkSession.createDataFrame(targets, "_range int, _to int, _most int")
    halo = tails.join(F.broadcast(goes), "_range").filter(F.col("_back") <= F.col("_most")).select(
        *df.columns, F.col("_to").alias("_range"), F.lit(False).alias("_own"))
    rows = placed.withColumn("_own", F.lit(True)).unionByName(halo)
    w = Window.partitionBy("_range", *part_cols).orderBy(*order_cols)
    out = rows.select("*", *[F.lag(F.col(input_col), int(k)).over(w).alias(n) for k, n in zip(lags, lag_names(input_col, lags))])
    return out.filter("_own").drop("_own", "_range")


def fill_month_gaps(df: DataFrame, keys: list[str], year_col: str = "year",
                    month_col: str = "month") -> DataFrame:
    """Add the missing calendar months of each group's span (other columns null), so that
    :func:`lag_features` afterwards counts months instead of rows.

    Every row is followed by the months up to the next row of its group (``lead`` over the month
    index), exploded on the executors: one pass over ``df`` and no join. Rows with a null key, year
    or month are kept as they are.
    """
    keys = list(keys)
    idx = F.col(year_col) * 12 + F.col(month_col) - 1
    placed = F.lit(True)
    for c in keys + [year_col, month_col]:
        placed = placed & F.col(c).isNotNull()
    # unplaced rows form groups of their own and get no gap
    after = F.lead(idx).over(Window.partitionBy(*keys, placed).orderBy(idx))
    steps = F.when(placed & (after > idx), F.sequence(F.lit(0), (after - idx - 1).cast("int"))).otherwise(F.array(F.lit(0)))
    spread = df.withColumn("_steps", steps).withColumn("_i", idx).withColumn("_k", F.explode("_steps"))
    at = F.col("_i") + F.col("_k")
    kinds = {f.name: f.dataType for f in df.schema.fields}
    cols = []
    for c in df.columns:
        if c == year_col:
            cols.append(F.when(F.col("_k") > 0, F.floor(at / 12)).otherwise(F.col(c)).cast(kinds[c]).alias(c))
        elif c == month_col:
            cols.append(F.when(F.col("_k") > 0, at % 12 + 1).otherwise(F.col(c)).cast(kinds[c]).alias(c))
        else:
            cols.append(F.col(c) if c in keys else F.when(F.col("_k") == 0, F.col(c)).alias(c))
    return spread.select(*cols)
