"""Feature plans: monthly store series and the wide-daily (pivot -> unpivot) path.

Forecasting notions mapped onto the star-schema tables:

* store        = ``nation.n_name`` reached through ``l_suppkey -> s_nationkey``
* department   = ``l_returnflag``
* sales        = ``sum(l_quantity)`` per month of ``l_shipdate``
* wide daily   = ``events`` summed per (user, type, day) and pivoted to ``d_1..d_N``
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from almanac.functions.scalar import date_stamp, log_cols
from almanac.operators.filters import lag_complete, split_label, fill_missing
from almanac.operators.reshape import unpivot
from almanac.operators.window import fill_month_gaps, lag_features, lag_names
from almanac.sources.config import RunConfig
from almanac.sources.csv import read_csv
from almanac.sources.tables import read_table

def store_map(supplier: DataFrame, nation: DataFrame) -> DataFrame:
    """``(s_suppkey, store_id)``: every supplier with the name of its nation.

    No hint on the nation side: the planner broadcasts it by its own size threshold (file
    statistics), and AQE re-checks at run time; a count job here would add nothing."""
    nat = nation.select("n_nationkey", F.col("n_name").alias("store_id"))
    sup = supplier.select("s_suppkey", "s_nationkey")
    return sup.join(nat, sup.s_nationkey == nat.n_nationkey).select("s_suppkey", "store_id")


def monthly_store_sales(lineitem: DataFrame, supplier: DataFrame, nation: DataFrame,
                        dept: str = "R") -> DataFrame:
    """``(store_id, year int, month int, sales double)``: department sales per store and month.

    The department filter and the column projection reach the parquet scan. Line items are summed
    per (supplier, year, month) first, so a hot supplier becomes at most one row per month and task;
    the store map meets those sums in a join whose form Spark picks from the sizes.
    """
    items = (lineitem.filter(F.col("l_returnflag") == F.lit(dept))
             .select("l_suppkey",
                     F.year("l_shipdate").alias("year"),
                     F.month("l_shipdate").alias("month"),
                     "l_quantity"))
    pre = (items.groupBy("l_suppkey", "year", "month")
           .agg(F.sum("l_quantity").alias("qty")))
    stores = store_map(supplier, nation)
    joined = pre.join(stores, pre.l_suppkey == stores.s_suppkey)
    return joined.groupBy("store_id", "year", "month").agg(F.sum("qty").alias("sales"))


def monthly_features(monthly: DataFrame, cfg: RunConfig = RunConfig(),
                     drop_incomplete: bool = True) -> DataFrame:
    """log sales, lags over (year, month) per group, drop the start of each series, date stamp, label.

    ``monthly`` holds ``cfg.keys, year, month, sales``. Output: those (sales as ln),
    ``lag_sales_1..k, ds, train_test_val_indicator``. Lags are taken over the whole series before
    labelling, so test rows see actual earlier months (one-step-ahead features), as the surveyed
    design does. They count rows, and rows whose longest lag is null go, unless ``cfg.calendar_lags``:
    then the missing months are inserted first (null sales) and only the first ``max(lags)`` months of
    a group go; a later month stays even if a month it looks back to is missing.
    """
    keys = list(cfg.keys)
    if cfg.calendar_lags:
        monthly = fill_month_gaps(monthly, keys)
    df = log_cols(monthly, ["sales"])
    df = lag_features(df, "sales", keys, ["year", "month"], cfg.lags)
    if drop_incomplete and cfg.calendar_lags:
        place = F.row_number().over(Window.partitionBy(*keys).orderBy("year", "month"))
        df = df.withColumn("_place", place).filter(F.col("_place") > max(cfg.lags)).drop("_place")
    elif drop_incomplete:
        df = lag_complete(df, lag_names("sales", cfg.lags)[-1])
    df = date_stamp(df, ("year", "month"), "ds")
    return split_label(df, cfg.split["train_before"], cfg.split["test_after"])


def load_monthly_features(spark: SparkSession, sf_dir: str, cfg: RunConfig = RunConfig()) -> DataFrame:
    monthly = monthly_store_sales(read_table(spark, sf_dir, "lineitem"),
                                  read_table(spark, sf_dir, "supplier"),
                                  read_table(spark, sf_dir, "nation"), cfg.dept)
    return monthly_features(monthly, cfg)


# ---------------------------------------------------------------- wide daily (events) path

def day_range(events: DataFrame, ts_col: str = "ts"):
    """(first date, number of days) of the event stream: one aggregated row to the driver."""
    row = events.agg(F.min(F.to_date(ts_col)).alias("d0"),
                     F.max(F.to_date(ts_col)).alias("d1")).first()
    if row.d0 is None:
        return None, 0
    return row.d0, (row.d1 - row.d0).days + 1


def day_names(n_days: int) -> list[str]:
    return [f"d_{k}" for k in range(1, n_days + 1)]


def calendar(spark: SparkSession, start, n_days: int) -> DataFrame:
    """``(d, date, year, month)`` for ``d_1..d_n`` starting at ``start``; built by ``range``
    on the executors, sized by the data's own day span."""
    first = F.lit(start) if start is not None else F.lit(None).cast("date")
    return (spark.range(n_days)
            .select(F.concat(F.lit("d_"), (F.col("id") + 1).cast("string")).alias("d"),
                    F.date_add(first, F.col("id").cast("int")).alias("date"))
            .select("d", "date", F.year("date").alias("year"), F.month("date").alias("month")))


def wide_daily(events: DataFrame, start, n_days: int, ids=("user_id", "event_type"),
               value_col: str = "value") -> DataFrame:
    """``ids + d_1..d_n``: per id the daily sum of ``value``, zero for days without events.

    The pivot values are given, so Spark does not run a distinct job; the pivot is a
    partial/final aggregate, safe for hot ids.
    """
    names = day_names(n_days)
    daily = events.select(*ids,
                          F.concat(F.lit("d_"),
                                   (F.datediff(F.to_date("ts"), F.lit(start)) + 1).cast("string")).alias("day"),
                          F.col(value_col).alias("v"))
    wide = daily.groupBy(*ids).pivot("day", names).agg(F.sum("v"))
    return fill_missing(wide, 0.0, names)


def load_long_daily(spark: SparkSession, sf_dir: str, dept: str | None = None):
    """:func:`long_daily` over the ``events`` table."""
    return long_daily(spark, read_table(spark, sf_dir, "events"), dept)


def long_daily(spark: SparkSession, events: DataFrame, dept: str | None = None):
    """Wide daily events -> optional department filter -> unpivot to ``(ids, day, sales)``.
    Returns ``(long, calendar, n_days)``; an empty stream gives an empty long frame."""
    start, n = day_range(events)
    if n == 0:
        empty = events.select("user_id", "event_type", F.lit(None).cast("string").alias("day"),
                              F.lit(None).cast("double").alias("sales")).limit(0)
        return empty, calendar(spark, None, 0), 0
    wide = wide_daily(events, start, n)
    if dept is not None:
        wide = wide.filter(F.col("event_type") == F.lit(dept))
    long = unpivot(wide, ["user_id", "event_type"], var_name="day", value_name="sales")
    return long, calendar(spark, start, n), n


def daily_monthly(long: DataFrame, cal: DataFrame, key: str | list[str] = "user_id") -> DataFrame:
    """Join the calendar on ``day = d`` and sum sales per (key, year, month).

    The calendar is one row per day; the form of the join is left to Spark's own size check."""
    keys = [key] if isinstance(key, str) else list(key)
    cal = cal.select("d", "year", "month")
    joined = long.join(cal, long.day == cal.d)
    return joined.groupBy(*keys, "year", "month").agg(F.sum("sales").alias("sales"))


# ---------------------------------------------------------------- wide daily tables, end to end

def wide_monthly(wide: DataFrame, cal: DataFrame, keys: list[str], day_prefix: str = "d_",
                 where: str | None = None) -> DataFrame:
    """Wide daily table + calendar table -> ``keys, year, month, sales``.

    ``wide`` has one column per day (``d_1, d_2, ...``) beside its id columns; ``cal`` has ``d``, and
    either ``year`` and ``month`` or a ``date``. ``where`` filters the wide rows (a department, say) and
    reaches the scan. Columns that are neither keys nor days are not read.
    """
    if where:
        wide = wide.filter(where)
    days = [c for c in wide.columns if c.startswith(day_prefix) and c not in keys]
    if "year" not in cal.columns or "month" not in cal.columns:
        cal = cal.withColumns({"year": F.year("date"), "month": F.month("date")})
    cal = cal.select("d", F.col("year").cast("int").alias("year"), F.col("month").cast("int").alias("month"))
    return fold_months(wide, cal, keys, days)


def fold_months(wide: DataFrame, cal: DataFrame, keys: list[str], days: list[str]) -> DataFrame:
    """``keys, year, month, sales``: the unpivot, the calendar join and the monthly sum in one, folded below the
    explosion: a row's day columns are added up by calendar month inside the row, so a row becomes one per month
    instead of one per day, and only those are grouped.

    The calendar rows of the table's own day columns come to the driver (at most one per column and calendar row
    of its name); a day that the calendar lists twice counts twice and one that it lacks not at all, as in a join.
    A month whose days are all null has a null sum.
    """
    if not days:
        raise ValueError("nothing to unpivot")
    names = cal.sparkSession.createDataFrame([(c, i) for i, c in enumerate(days)], "d string, at int")
    months: dict[tuple, list[int]] = {}
    for r in cal.join(F.broadcast(names), "d").select("year", "month", "at").collect():
        months.setdefault((r["year"], r["month"]), []).append(r["at"])
    plan = json.dumps([{"year": y, "month": m, "at": sorted(at)} for (y, m), at in sorted(months.items(), key=str)])
    held = wide.selectExpr(*[f"`{k}`" for k in keys],
                           "array(" + ", ".join(f"CAST(`{c}` AS DOUBLE)" for c in days) + ") AS _days")
    folded = held.selectExpr(*[f"`{k}`" for k in keys], f"""inline(transform(
        from_json('{plan}', 'array<struct<year:int,month:int,at:array<int>>>'), m -> struct(m.year AS year, m.month AS month,
            aggregate(m.at, CAST(NULL AS DOUBLE), (s, i) -> CASE WHEN _days[i] IS NULL THEN s ELSE coalesce(s, 0D) + _days[i] END) AS v)))""")
    return folded.groupBy(*keys, "year", "month").agg(F.sum("v").alias("sales"))


def load_wide_features(spark: SparkSession, wide_path: str, calendar_path: str, cfg: RunConfig = RunConfig(),
                       where: str | None = None) -> DataFrame:
    """Monthly features from a wide daily table and a calendar table, CSV (with header) or parquet."""
    def read(path: str) -> DataFrame:
        if path.rstrip("/").endswith(".csv"):
            return read_csv(spark, path)
        return spark.read.parquet(path)
    return monthly_features(wide_monthly(read(wide_path), read(calendar_path), list(cfg.keys), where=where), cfg)


def wide_store_daily(lineitem: DataFrame, supplier: DataFrame, nation: DataFrame):
    """``(wide, calendar)`` from the line items: one row per store and department (``store_id, dept_id``),
    one zero-filled column per day of the ship dates' own span."""
    span = lineitem.agg(F.min(F.to_date("l_shipdate")).alias("d0"), F.max(F.to_date("l_shipdate")).alias("d1")).first()
    n = 0 if span.d0 is None else (span.d1 - span.d0).days + 1
    daily = lineitem.groupBy("l_suppkey", F.col("l_returnflag").alias("dept_id"),
                             F.to_date("l_shipdate").alias("date")).agg(F.sum("l_quantity").alias("v"))
    stores = store_map(supplier, nation)
    named = daily.join(stores, daily.l_suppkey == stores.s_suppkey)
    start = F.lit(span.d0) if n else F.lit(None).cast("date")
    day = F.concat(F.lit("d_"), (F.datediff("date", start) + 1).cast("string"))
    names = day_names(n)
    wide = named.withColumn("day", day).groupBy("store_id", "dept_id").pivot("day", names).agg(F.sum("v"))
    return fill_missing(wide, 0.0, names) if names else wide, calendar(lineitem.sparkSession, span.d0, n)
