"""Registered queries: each a Spark plan over the test tables plus, where SQL can express it,
the equivalent DuckDB SQL used as the correctness oracle.

Every query reads whole tables. Floating results are rounded to ``PLACES`` in both the Spark
plan and the SQL so that last-bit differences between engines do not show; integer-typed
outputs are cast to the same width on both sides.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.sources.config import RunConfig

PLACES = 8
CFG = RunConfig()


@dataclass
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        REGISTRY[name] = Query(name, fn, sql)
        return fn
    return deco


def rounded(df: DataFrame, places: int = PLACES) -> DataFrame:
    """Round every double column (comparison hygiene only; applied after the real work)."""
    return df.select(*[F.round(F.col(c), places).alias(c) if t == "double" else F.col(c)
                       for c, t in df.dtypes])


# ------------------------------------------------------------------ SQL building blocks

def _lag_sql(col: str, lags, part: str, order: str) -> str:
    return ", ".join(f"lag({col}, {k}) OVER (PARTITION BY {part} ORDER BY {order}) AS lag_{col}_{k}"
                     for k in lags)


def _round_list(cols, places: int = PLACES) -> str:
    return ", ".join(f"round({c}, {places}) AS {c}" for c in cols)


SQL_MONTHLY = f"""
SELECT n.n_name AS store_id,
       CAST(year(l.l_shipdate) AS INTEGER) AS year,
       CAST(month(l.l_shipdate) AS INTEGER) AS month,
       sum(l.l_quantity) AS sales
FROM lineitem l
JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN nation n ON s.s_nationkey = n.n_nationkey
WHERE l.l_returnflag = '{CFG.dept}'
GROUP BY 1, 2, 3
"""


def _label_sql(cfg: RunConfig = CFG) -> str:
    (ty, tm), (sy, sm) = cfg.train_before, cfg.test_after
    return (f"CAST(CASE WHEN year < {ty} OR (year = {ty} AND month < {tm}) THEN 0 "
            f"WHEN year > {sy} OR (year = {sy} AND month > {sm}) THEN 2 ELSE 1 END AS INTEGER)")


LAGS = list(CFG.lags)
LAG_COLS = [f"lag_sales_{k}" for k in LAGS]

# monthly features without rounding: (store_id, year, month, sales=ln, lag_sales_*, ds, label)
SQL_FEATURES_RAW = f"""
WITH m AS ({SQL_MONTHLY}),
f AS (SELECT store_id, year, month, CASE WHEN sales > 0 THEN ln(sales) END AS sales FROM m),
g AS (SELECT store_id, year, month, sales, {_lag_sql('sales', LAGS, 'store_id', 'year, month')} FROM f)
SELECT store_id, year, month, sales, {', '.join(LAG_COLS)},
       make_date(year, month, 1) AS ds,
       {_label_sql()} AS train_test_val_indicator
FROM g WHERE lag_sales_{LAGS[-1]} IS NOT NULL
"""


def features_sql_rounded() -> str:
    return f"""
SELECT store_id, year, month, {_round_list(['sales'] + LAG_COLS)}, ds, train_test_val_indicator
FROM ({SQL_FEATURES_RAW}) x
"""


# ------------------------------------------------------------------ query registrations

def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    from almanac.plans.features import load_monthly_features
    return load_monthly_features(spark, sf_dir, CFG)


@register("monthly_features", features_sql_rounded())
def q_monthly_features(spark, sf_dir):
    return rounded(_features(spark, sf_dir))


# ---------------------------------------------------------------- shared Spark inputs

def _tables(spark, sf_dir, *names):
    from almanac.sources.tables import read_table
    return [read_table(spark, sf_dir, n) for n in names]


def _monthly(spark, sf_dir):
    from almanac.plans.features import monthly_store_sales
    li, su, na = _tables(spark, sf_dir, "lineitem", "supplier", "nation")
    return monthly_store_sales(li, su, na, CFG.dept)


# ---------------------------------------------------------------- filters and splits (F1-F8)

@register("filter_rows", """
SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem
WHERE l_quantity < 10 AND l_returnflag = 'R'
""")
def q_filter_rows(spark, sf_dir):
    from almanac.operators import filter_rows
    (li,) = _tables(spark, sf_dir, "lineitem")
    return filter_rows(li, "l_quantity < 10 AND l_returnflag = 'R'").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")


@register("monthly_sales", f"SELECT store_id, year, month, round(sales, {PLACES}) AS sales FROM ({SQL_MONTHLY}) m")
def q_monthly_sales(spark, sf_dir):
    return rounded(_monthly(spark, sf_dir))


SPLIT_YM = {"year": 2000, "month": 5}


@register("month_split_before", f"""
SELECT store_id, year, month, round(sales, {PLACES}) AS sales FROM ({SQL_MONTHLY}) m
WHERE year < {SPLIT_YM['year']} OR (year = {SPLIT_YM['year']} AND month <= {SPLIT_YM['month']})
""")
def q_month_split_before(spark, sf_dir):
    from almanac.operators import month_split
    return rounded(month_split(_monthly(spark, sf_dir), SPLIT_YM, "before"))


@register("month_split_after", f"""
SELECT store_id, year, month, round(sales, {PLACES}) AS sales FROM ({SQL_MONTHLY}) m
WHERE year > {SPLIT_YM['year']} OR (year = {SPLIT_YM['year']} AND month > {SPLIT_YM['month']})
""")
def q_month_split_after(spark, sf_dir):
    from almanac.operators import month_split
    return rounded(month_split(_monthly(spark, sf_dir), SPLIT_YM, "after"))


@register("split_label", f"""
SELECT store_id, year, month, round(sales, {PLACES}) AS sales, {_label_sql()} AS train_test_val_indicator
FROM ({SQL_MONTHLY}) m
""")
def q_split_label(spark, sf_dir):
    from almanac.operators import split_label
    s = CFG.split
    return rounded(split_label(_monthly(spark, sf_dir), s["train_before"], s["test_after"]))


@register("lag_complete", f"""
WITH f AS (SELECT store_id, year, month, CASE WHEN sales > 0 THEN ln(sales) END AS sales FROM ({SQL_MONTHLY}) m),
g AS (SELECT *, {_lag_sql('sales', [LAGS[-1]], 'store_id', 'year, month')} FROM f)
SELECT store_id, year, month, {_round_list(['sales', f'lag_sales_{LAGS[-1]}'])}
FROM g WHERE lag_sales_{LAGS[-1]} IS NOT NULL
""")
def q_lag_complete(spark, sf_dir):
    from almanac.functions import log_cols
    from almanac.operators import lag_complete, lag_features
    df = lag_features(log_cols(_monthly(spark, sf_dir), ["sales"]), "sales", ["store_id"],
                      ["year", "month"], [LAGS[-1]])
    return rounded(lag_complete(df, f"lag_sales_{LAGS[-1]}"))


@register("fill_missing", f"""
WITH f AS (SELECT store_id, year, month, CASE WHEN sales > 0 THEN ln(sales) END AS sales FROM ({SQL_MONTHLY}) m),
g AS (SELECT *, {_lag_sql('sales', [1, 2, 3], 'store_id', 'year, month')} FROM f)
SELECT store_id, year, month, round(sales, {PLACES}) AS sales,
       {', '.join(f'round(coalesce(lag_sales_{k}, 0.0), {PLACES}) AS lag_sales_{k}' for k in (1, 2, 3))}
FROM g
""")
def q_fill_missing(spark, sf_dir):
    from almanac.functions import log_cols
    from almanac.operators import fill_missing, lag_features
    df = lag_features(log_cols(_monthly(spark, sf_dir), ["sales"]), "sales", ["store_id"],
                      ["year", "month"], [1, 2, 3])
    return rounded(fill_missing(df, 0.0, ["lag_sales_1", "lag_sales_2", "lag_sales_3"]))


# ---------------------------------------------------------------- reshape

MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("unpivot_measures", " UNION ALL ".join(
    f"SELECT l_orderkey, l_linenumber, '{m}' AS measure, {m} AS value FROM lineitem" for m in MEASURES))
def q_unpivot_measures(spark, sf_dir):
    from almanac.operators import unpivot
    (li,) = _tables(spark, sf_dir, "lineitem")
    return unpivot(li.select("l_orderkey", "l_linenumber", *MEASURES), ["l_orderkey", "l_linenumber"],
                   var_name="measure", value_name="value")


SQL_DAY_BOUNDS = "SELECT min(CAST(ts AS DATE)) AS d0, max(CAST(ts AS DATE)) AS d1 FROM events"
SQL_DAYS = f"SELECT unnest(generate_series(1, date_diff('day', d0, d1) + 1)) AS k FROM ({SQL_DAY_BOUNDS}) b"
SQL_DAILY = f"""SELECT user_id, event_type,
       date_diff('day', (SELECT d0 FROM ({SQL_DAY_BOUNDS}) b), CAST(ts AS DATE)) + 1 AS k,
       sum(value) AS v
FROM events GROUP BY 1, 2, 3"""


@register("unpivot_days", f"""
WITH g AS (SELECT DISTINCT user_id, event_type FROM events),
days AS ({SQL_DAYS}),
s AS ({SQL_DAILY})
SELECT g.user_id, g.event_type, 'd_' || CAST(days.k AS VARCHAR) AS day,
       round(coalesce(s.v, 0.0), {PLACES}) AS sales
FROM g CROSS JOIN days
LEFT JOIN s ON s.user_id = g.user_id AND s.event_type = g.event_type AND s.k = days.k
""")
def q_unpivot_days(spark, sf_dir):
    from almanac.plans.features import load_long_daily
    long, _, _ = load_long_daily(spark, sf_dir)
    return rounded(long)


DAILY_DEPT = "purchase"


@register("unpivot_days_monthly", f"""
WITH b AS ({SQL_DAY_BOUNDS}),
g AS (SELECT DISTINCT user_id FROM events WHERE event_type = '{DAILY_DEPT}'),
months AS (SELECT DISTINCT CAST(year(dt) AS INTEGER) AS year, CAST(month(dt) AS INTEGER) AS month
           FROM (SELECT unnest(generate_series(d0, d1, INTERVAL 1 DAY)) AS dt FROM b) c),
s AS (SELECT user_id, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, sum(value) AS v
      FROM events WHERE event_type = '{DAILY_DEPT}' GROUP BY 1, 2, 3)
SELECT g.user_id, months.year, months.month, round(coalesce(s.v, 0.0), {PLACES}) AS sales
FROM g CROSS JOIN months
LEFT JOIN s ON s.user_id = g.user_id AND s.year = months.year AND s.month = months.month
""")
def q_unpivot_days_monthly(spark, sf_dir):
    from almanac.plans.features import daily_monthly, load_long_daily
    long, cal, _ = load_long_daily(spark, sf_dir, DAILY_DEPT)
    return rounded(daily_monthly(long, cal, "user_id"))


# ---------------------------------------------------------------- joins

@register("join_diff_keys", """
SELECT l.l_orderkey, l.l_linenumber, l.l_suppkey, s.s_suppkey, s.s_name
FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
""")
def q_join_diff_keys(spark, sf_dir):
    from almanac.operators import join
    li, su = _tables(spark, sf_dir, "lineitem", "supplier")
    out = join(li.select("l_orderkey", "l_linenumber", "l_suppkey"), su.select("s_suppkey", "s_name"),
               {"df1_col": "l_suppkey", "df2_col": "s_suppkey"})
    return out


@register("join_using", """
SELECT o.o_custkey AS custkey, o.o_orderkey, o.o_totalprice, c.c_name, c.c_mktsegment
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
""")
def q_join_using(spark, sf_dir):
    from almanac.operators import join
    o, c = _tables(spark, sf_dir, "orders", "customer")
    left = o.select(F.col("o_custkey").alias("custkey"), "o_orderkey", "o_totalprice")
    right = c.select(F.col("c_custkey").alias("custkey"), "c_name", "c_mktsegment")
    return join(left, right, "custkey")


@register("join_salted", """
SELECT o.o_custkey AS custkey, o.o_orderkey, o.o_totalprice, c.c_name, c.c_mktsegment
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
""")
def q_join_salted(spark, sf_dir):
    """The USING join with the order side salted over 16 buckets (skew-safe shape)."""
    from almanac.operators import join
    o, c = _tables(spark, sf_dir, "orders", "customer")
    left = o.select(F.col("o_custkey").alias("custkey"), "o_orderkey", "o_totalprice")
    right = c.select(F.col("c_custkey").alias("custkey"), "c_name", "c_mktsegment")
    return join(left, right, "custkey", salt_buckets=16)


@register("join_condition", """
SELECT o.o_orderkey, o.o_custkey, c.c_custkey, o.o_totalprice, c.c_acctbal
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey AND o.o_totalprice > 50 * c.c_acctbal
""")
def q_join_condition(spark, sf_dir):
    from almanac.operators import join
    o, c = _tables(spark, sf_dir, "orders", "customer")
    o = o.select("o_orderkey", "o_custkey", "o_totalprice")
    c = c.select("c_custkey", "c_acctbal")
    return join(o, c, (o.o_custkey == c.c_custkey) & (o.o_totalprice > 50 * c.c_acctbal))


# ---------------------------------------------------------------- aggregation (A1)

GROUP_KEYS = ["l_returnflag", "l_linestatus"]


def _group(spark, sf_dir, aggs, places):
    from almanac.operators import group_agg
    (li,) = _tables(spark, sf_dir, "lineitem")
    return rounded(group_agg(li, GROUP_KEYS, aggs), places)


@register("group_sum", """
SELECT l_returnflag, l_linestatus, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS l_quantity,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS l_extendedprice
FROM lineitem GROUP BY 1, 2
""")
def q_group_sum(spark, sf_dir):
    """Money is summed as decimals, so the result does not depend on the order of the rows."""
    from almanac.operators import group_agg
    (li,) = _tables(spark, sf_dir, "lineitem")
    money = {c: F.col(c).cast("decimal(18,2)") for c in ("l_quantity", "l_extendedprice")}
    sums = group_agg(li.withColumns(money), GROUP_KEYS, dict.fromkeys(money, "sum"))
    return sums.withColumns({c: F.col(c).cast("double") for c in money})


@register("group_avg", f"""
SELECT l_returnflag, l_linestatus, round(avg(l_quantity), {PLACES}) AS l_quantity,
       round(avg(l_discount), {PLACES}) AS l_discount
FROM lineitem GROUP BY 1, 2
""")
def q_group_avg(spark, sf_dir):
    return _group(spark, sf_dir, {"l_quantity": "avg", "l_discount": "mean"}, PLACES)


@register("group_max", """
SELECT l_returnflag, l_linestatus, max(l_extendedprice) AS l_extendedprice, max(l_quantity) AS l_quantity
FROM lineitem GROUP BY 1, 2
""")
def q_group_max(spark, sf_dir):
    return _group(spark, sf_dir, {"l_extendedprice": "max", "l_quantity": "max"}, PLACES)


@register("group_count", """
SELECT l_returnflag, l_linestatus, count(*) AS count FROM lineitem GROUP BY 1, 2
""")
def q_group_count(spark, sf_dir):
    return _group(spark, sf_dir, {"*": "count"}, PLACES)


# ---------------------------------------------------------------- window, scalar

@register("lag_features", f"""
WITH f AS (SELECT store_id, year, month, CASE WHEN sales > 0 THEN ln(sales) END AS sales FROM ({SQL_MONTHLY}) m),
g AS (SELECT *, {_lag_sql('sales', LAGS, 'store_id', 'year, month')} FROM f)
SELECT store_id, year, month, {_round_list(['sales'] + LAG_COLS)} FROM g
""")
def q_lag_features(spark, sf_dir):
    from almanac.functions import log_cols
    from almanac.operators import lag_features
    return rounded(lag_features(log_cols(_monthly(spark, sf_dir), ["sales"]), "sales", ["store_id"],
                                ["year", "month"], LAGS))


EVENT_LAGS = (1, 2, 7, 30)


@register("lag_features_ranged", f"""
SELECT event_id, event_type, value, {', '.join(f'lag(value, {k}) OVER w AS lag_value_{k}' for k in EVENT_LAGS)} FROM events
WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id)
""")
def q_lag_features_ranged(spark, sf_dir):
    """Few keys with very many rows: each key's series is cut into ranges that hand their last rows on."""
    from almanac.operators import lag_features_ranged
    (ev,) = _tables(spark, sf_dir, "events")
    out = lag_features_ranged(ev.select("event_id", "event_type", "ts", "value"), "value", ["event_type"], ["ts", "event_id"],
                              EVENT_LAGS, max(16, spark.sparkContext.defaultParallelism))
    return out.drop("ts")


@register("log_cols", f"""
SELECT store_id, year, month, round(sales, {PLACES}) AS sales,
       round(CASE WHEN sales > 0 THEN ln(sales) END, {PLACES}) AS log_sales
FROM ({SQL_MONTHLY}) m
""")
def q_log_cols(spark, sf_dir):
    from almanac.functions import log_cols
    return rounded(log_cols(_monthly(spark, sf_dir), ["sales"], ["log_sales"]))


@register("antilog_cols", f"""
SELECT store_id, year, month, round(exp(sales), 6) AS sales, round(exp(lag_sales_1), 6) AS lag_sales_1
FROM ({SQL_FEATURES_RAW}) x
""")
def q_antilog_cols(spark, sf_dir):
    from almanac.functions import antilog_cols
    df = _features(spark, sf_dir).select("store_id", "year", "month", "sales", "lag_sales_1")
    return rounded(antilog_cols(df, ["sales", "lag_sales_1"]), 6)


@register("date_stamp", f"""
SELECT store_id, year, month, round(sales, {PLACES}) AS sales, make_date(year, month, 1) AS ds
FROM ({SQL_MONTHLY}) m
""")
def q_date_stamp(spark, sf_dir):
    from almanac.functions import date_stamp
    return rounded(date_stamp(_monthly(spark, sf_dir), ("year", "month"), "ds"))


# ---------------------------------------------------------------- encoding

SQL_STORE_INDEX = f"""
SELECT store_id, CAST(row_number() OVER (ORDER BY n DESC, store_id) - 1 AS DOUBLE) AS store_id_index
FROM (SELECT store_id, count(*) AS n FROM ({SQL_FEATURES_RAW}) x GROUP BY 1) c
"""


@register("category_index", f"""
SELECT f.store_id, f.year, f.month, r.store_id_index
FROM ({SQL_FEATURES_RAW}) f JOIN ({SQL_STORE_INDEX}) r ON f.store_id = r.store_id
""")
def q_category_index(spark, sf_dir):
    from almanac.operators import category_index
    f = _model_features(spark, sf_dir).select("store_id", "year", "month")
    return category_index(f, "store_id", "store_id_index")


FEATURE_COLS = ["store_id_index", "month", "year"] + LAG_COLS


@register("feature_array", f"""
SELECT f.store_id, f.year, f.month,
       [{', '.join(f'round(CAST({c} AS DOUBLE), {PLACES})' for c in FEATURE_COLS)}] AS features
FROM ({SQL_FEATURES_RAW}) f JOIN ({SQL_STORE_INDEX}) r ON f.store_id = r.store_id
""")
def q_feature_array(spark, sf_dir):
    from almanac.operators import category_index, feature_array
    f = category_index(_model_features(spark, sf_dir), "store_id", "store_id_index")
    f = feature_array(f, FEATURE_COLS)
    return f.select("store_id", "year", "month",
                    F.transform("features", lambda x: F.round(x, PLACES)).alias("features"))


# ---------------------------------------------------------------- metric (A4, M9)

SQL_APE = "abs((sales - lag_sales_1) / nullif(sales, 0))"


@register("mape", f"SELECT round(100 * avg({SQL_APE}), {PLACES}) AS mape FROM ({SQL_FEATURES_RAW}) x")
def q_mape(spark, sf_dir):
    from almanac.functions import mape_frame
    return rounded(mape_frame(_features(spark, sf_dir), "sales", "lag_sales_1"))


@register("mape_by_group", f"""
SELECT store_id, train_test_val_indicator, round(100 * avg({SQL_APE}), {PLACES}) AS mape
FROM ({SQL_FEATURES_RAW}) x GROUP BY 1, 2
""")
def q_mape_by_group(spark, sf_dir):
    from almanac.functions import mape_frame
    return rounded(mape_frame(_features(spark, sf_dir), "sales", "lag_sales_1",
                              ["store_id", "train_test_val_indicator"]))



# ---------------------------------------------------------------- per-group model (M4-M6, A5)

def _cands():
    from almanac.plans.group_model import candidates
    return candidates(CFG)


def _cand_values_sql(cands=None) -> str:
    rows = ", ".join(f"({i}, CAST({c['seasonality_prior_scale']!r} AS DOUBLE))" for i, c in enumerate(cands or _cands()))
    return f"SELECT * FROM (VALUES {rows}) v(cand_id, scale)"


def _group_sql_ctes(features: str = SQL_FEATURES_RAW, keys: tuple[str, ...] = ("store_id",), cands=None) -> str:
    """CTEs s, tr, rs, c, losses, w, tr2, rs2, eff, fc, sc, lng, ml, mls, best shared by the group-model
    oracles. A null value (zero-sales month) counts for nothing in trend, effects and losses; models are
    compared on the rows that all of them scored."""
    k = ", ".join(keys)

    def of(alias: str) -> str:
        return ", ".join(f"{alias}.{x}" for x in keys)

    def on(x: str, y: str, *more: str) -> str:
        return " AND ".join(f"{x}.{c} = {y}.{c}" for c in (*keys, *more))

    return f"""
f AS ({features}),
s AS (SELECT {k}, year, month, sales AS y,
             CAST((year - {CFG.base_year}) * 12 + month - 1 AS DOUBLE) AS t,
             train_test_val_indicator AS ind, lag_sales_1, lag_sales_{LAGS[-1]} AS lag_last FROM f),
tr AS (SELECT {k}, regr_intercept(y, t) AS a, regr_slope(y, t) AS b FROM s WHERE ind = 0 GROUP BY ALL),
rs AS (SELECT {of('s')}, s.month, sum(s.y - (tr.a + tr.b * s.t)) AS rsum, count(s.y) AS n
       FROM s JOIN tr ON {on('s', 'tr')} WHERE s.ind = 0 GROUP BY ALL),
c AS ({_cand_values_sql(cands)}),
v AS (SELECT {of('s')}, c.cand_id, c.scale, s.y,
             tr.a + tr.b * s.t + coalesce(rs.rsum / (rs.n + 1.0 / (c.scale * c.scale)), 0.0) AS p
      FROM s JOIN tr ON {on('s', 'tr')}
      LEFT JOIN rs ON {on('rs', 's', 'month')}
      CROSS JOIN c WHERE s.ind = 1),
losses AS (SELECT {k}, cand_id, scale AS seasonality_prior_scale,
                  round(100 * avg(abs((y - p) / nullif(y, 0))), {PLACES}) AS loss
           FROM v GROUP BY {k}, cand_id, scale),
w AS (SELECT {k}, cand_id, seasonality_prior_scale, loss FROM (
        SELECT *, row_number() OVER (PARTITION BY {k} ORDER BY loss NULLS LAST, cand_id) AS rn
        FROM losses) x WHERE rn = 1),
tr2 AS (SELECT {k}, regr_intercept(y, t) AS a, regr_slope(y, t) AS b FROM s WHERE ind <= 1 GROUP BY ALL),
rs2 AS (SELECT {of('s')}, s.month, sum(s.y - (tr2.a + tr2.b * s.t)) AS rsum, count(s.y) AS n
        FROM s JOIN tr2 ON {on('s', 'tr2')} WHERE s.ind <= 1 GROUP BY ALL),
eff AS (SELECT {of('rs2')}, rs2.month,
               rs2.rsum / (rs2.n + 1.0 / (w.seasonality_prior_scale * w.seasonality_prior_scale)) AS effect
        FROM rs2 JOIN w ON {on('rs2', 'w')}),
fc AS (SELECT {of('s')}, s.year, s.month, s.ind, s.y,
              tr2.a + tr2.b * s.t + coalesce(eff.effect, 0.0) AS TS_prediction
       FROM s LEFT JOIN tr2 ON {on('s', 'tr2')}
       LEFT JOIN eff ON {on('eff', 's', 'month')}),
sc AS (SELECT {of('s')}, s.year, s.month, s.ind, s.y, fc.TS_prediction,
              s.lag_sales_1 AS LAST_MONTH_prediction, s.lag_last AS LAST_YEAR_prediction
       FROM s JOIN fc ON {on('fc', 's', 'year', 'month')}),
cm AS (SELECT *, TS_prediction IS NOT NULL AND LAST_MONTH_prediction IS NOT NULL
              AND LAST_YEAR_prediction IS NOT NULL AS common FROM sc),
lng AS (SELECT {k}, year, month, ind, y, common, 0 AS position, 'TS' AS model_name, TS_prediction AS prediction FROM cm
        UNION ALL SELECT {k}, year, month, ind, y, common, 1, 'LAST_MONTH', LAST_MONTH_prediction FROM cm
        UNION ALL SELECT {k}, year, month, ind, y, common, 2, 'LAST_YEAR', LAST_YEAR_prediction FROM cm),
spl AS (SELECT *, 'train' AS split FROM lng WHERE ind IN (0, 1)
        UNION ALL SELECT *, 'validation' FROM lng WHERE ind = 1
        UNION ALL SELECT *, 'test' FROM lng WHERE ind = 2),
ml AS (SELECT model_name, position, split,
              round(100 * avg(abs((y - prediction) / nullif(y, 0))) FILTER (common), {PLACES}) AS loss,
              count(prediction) AS scored_rows, count(*) - count(prediction) AS unscored_rows
       FROM spl GROUP BY 1, 2, 3),
mls AS (SELECT model_name, position, split, {k},
               round(100 * avg(abs((y - prediction) / nullif(y, 0))) FILTER (common), {PLACES}) AS loss,
               count(prediction) AS scored_rows, count(*) - count(prediction) AS unscored_rows
        FROM spl GROUP BY ALL),
best AS (SELECT model_name, position, loss FROM ml WHERE split = 'test'
         ORDER BY unscored_rows, loss NULLS LAST, position LIMIT 1)"""


def _model_features(spark, sf_dir):
    """Feature frame for the model queries, checkpointed once: every tuning, fitting and scoring
    step then reads the small materialised frame instead of re-running the fact-table scan."""
    from almanac.session import cut_lineage
    return cut_lineage(_features(spark, sf_dir))


def _group_losses(spark, sf_dir, feats=None):
    from almanac.plans.group_model import tune_group_losses
    feats = _model_features(spark, sf_dir) if feats is None else feats
    return tune_group_losses(feats, _cands(), ["store_id"], CFG)


@register("tune_group_losses", f"WITH {_group_sql_ctes()} SELECT * FROM losses")
def q_tune_group_losses(spark, sf_dir):
    return _group_losses(spark, sf_dir)


@register("tune_group_argmin", f"WITH {_group_sql_ctes()} SELECT * FROM w")
def q_tune_group_argmin(spark, sf_dir):
    from almanac.plans.group_model import group_argmin
    return group_argmin(_group_losses(spark, sf_dir), ["store_id"])


@register("tune_mean_loss", f"""WITH {_group_sql_ctes()}
SELECT cand_id, seasonality_prior_scale, round(avg(loss), {PLACES}) AS mean_loss FROM losses GROUP BY 1, 2""")
def q_tune_mean_loss(spark, sf_dir):
    from almanac.plans.group_model import tune_mean_loss
    return rounded(tune_mean_loss(_group_losses(spark, sf_dir)))


# ---------------------------------------------------------------- Parzen search over the trial table (M1)

PARZEN_SPACE = {"seasonality_prior_scale": ["quniform", "float", 0.25, 8.0, 0.25]}
PARZEN = {"share": 0.3, "batch": 3, "seed": 7, "draws": 16}


def _parzen_cands():
    from almanac.plans.tuning import candidate_grid
    return candidate_grid(PARZEN_SPACE, 9, "random", 5)


def _parzen_ctes() -> str:
    """CTEs t (trials), de (densities) and pr (proposals of the next round) of every store."""
    m, pr = 32, PARZEN
    u = (f"CAST('0x' || substr(md5(store_id || '|{pr['seed']}|1|' || draw || '|0'), 1, 8) AS BIGINT) / {2.0 ** 32!r}")
    return f"""{_group_sql_ctes(cands=_parzen_cands())},
t AS (SELECT store_id, cand_id AS trial, loss, CAST(round(seasonality_prior_scale / 0.25) - 1 AS INTEGER) AS here FROM losses),
rk AS (SELECT *, row_number() OVER (PARTITION BY store_id ORDER BY loss NULLS LAST, trial) <= ceil({pr['share']} * count(*) OVER (PARTITION BY store_id)) AS ok FROM t),
mm AS (SELECT *, count(*) OVER (PARTITION BY store_id, ok) AS m FROM rk),
pl AS (SELECT unnest(range(0, {m})) AS place),
ke AS (SELECT store_id, ok, trial, m, place, exp(-0.5 * power((place - here) / greatest(1.0, {m} / (3 * sqrt(m))), 2)) AS v FROM mm CROSS JOIN pl),
we AS (SELECT store_id, ok, m, place, sum(v / total) AS w FROM (SELECT *, sum(v) OVER (PARTITION BY store_id, ok, trial) AS total FROM ke) x GROUP BY ALL),
de AS (SELECT store_id, CAST(place AS INTEGER) AS place, (1.0 / {m} + coalesce(sum(w) FILTER (ok), 0)) / (1.0 + coalesce(max(m) FILTER (ok), 0)) AS good,
              (1.0 / {m} + coalesce(sum(w) FILTER (NOT ok), 0)) / (1.0 + coalesce(max(m) FILTER (NOT ok), 0)) AS bad FROM we GROUP BY store_id, place),
cu AS (SELECT *, round(sum(good) OVER (PARTITION BY store_id ORDER BY place), 12) AS upto FROM de),
dr AS (SELECT store_id, draw, min(place) AS place FROM cu CROSS JOIN (SELECT unnest(range(0, {pr['draws']})) AS draw) d
       WHERE upto > {u} OR place = {m - 1} GROUP BY ALL),
on_ AS (SELECT store_id, place, min(draw) AS draw FROM dr WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.store_id = dr.store_id AND t.here = dr.place) GROUP BY ALL),
he AS (SELECT *, row_number() OVER (PARTITION BY store_id, draw % {pr['batch']} ORDER BY round(ln(good / bad), 8) DESC, draw) AS heat
       FROM on_ JOIN de USING (store_id, place)),
pr AS (SELECT store_id, CAST(row_number() OVER (PARTITION BY store_id ORDER BY heat, round(ln(good / bad), 8) DESC, draw) AS INTEGER) AS rank,
              CAST((place + 1) * 0.25 AS DOUBLE) AS seasonality_prior_scale, round(round(ln(good / bad), 8), 6) AS score
       FROM he QUALIFY rank <= {pr['batch']})"""


def _parzen_trials(spark, sf_dir):
    from almanac.plans.group_model import tune_group_losses
    from almanac.plans.parzen import places_of
    losses = tune_group_losses(_model_features(spark, sf_dir), _parzen_cands(), ["store_id"], CFG)
    return losses.select("store_id", F.col("cand_id").alias("trial"), "loss", places_of(PARZEN_SPACE, {}).alias("at"))


def _parzen_density(spark, sf_dir):
    from almanac.plans.parzen import densities
    from almanac.session import cut_lineage
    trials = cut_lineage(_parzen_trials(spark, sf_dir))
    return trials, densities(trials, trials.select("store_id").distinct(), PARZEN_SPACE, ["store_id"], PARZEN["share"])


@register("parzen_densities", f"""WITH {_parzen_ctes()}
SELECT store_id, place, round(good, 6) AS good, round(bad, 6) AS bad FROM de""")
def q_parzen_densities(spark, sf_dir):
    """Every store's two densities over the prior scales, from its own trial losses."""
    return rounded(_parzen_density(spark, sf_dir)[1].select("store_id", "place", "good", "bad"), 6)


@register("parzen_proposals", f"WITH {_parzen_ctes()} SELECT * FROM pr")
def q_parzen_proposals(spark, sf_dir):
    """The next round's candidates of every store, best density ratio first."""
    from almanac.plans.parzen import proposals
    trials, density = _parzen_density(spark, sf_dir)
    found = proposals(density, trials, ["store_id"], PARZEN["batch"], PARZEN["seed"], 1, PARZEN["draws"])
    scale = ((F.element_at("at", 1) + 1) * 0.25).alias("seasonality_prior_scale")
    return rounded(found.select("store_id", "rank", scale, "score"), 6)


SEARCH_SPACE = {"seasonality_prior_scale": ["quniform", "float", 0.5, 4.0, 0.5]}


def _search_cands():
    from almanac.plans.tuning import full_grid
    return full_grid(SEARCH_SPACE)


@register("tune_group_search", f"""WITH {_group_sql_ctes(cands=_search_cands())}
SELECT store_id, count(*) AS trials, min(loss) AS loss, CAST(min(seasonality_prior_scale) FILTER (loss = least) AS DOUBLE) AS seasonality_prior_scale
FROM (SELECT *, min(loss) OVER (PARTITION BY store_id) AS least FROM losses) x GROUP BY store_id""")
def q_tune_group_search(spark, sf_dir):
    """Every store searches its own prior scale in rounds of three; with as many trials as the axis has values the
    best must be the least loss of all."""
    from dataclasses import replace
    from almanac.plans.group_model import search_scale, tune_group_search
    cfg = replace(CFG, hp_space_group=SEARCH_SPACE)
    table = tune_group_search(_model_features(spark, sf_dir), cfg, ["store_id"], trials=8, batch=3, draws=400)
    # stores whose losses tie are compared at their least scale
    scaled = table.select("store_id", "loss", search_scale(cfg).alias("scale"))
    return scaled.groupBy("store_id").agg(F.count(F.lit(1)).alias("trials"), F.min("loss").alias("loss"),
                                          F.min(F.struct("loss", "scale"))["scale"].alias("seasonality_prior_scale"))


def _group_fit(spark, sf_dir):
    from almanac.plans.group_model import fit_group_model, group_argmin
    feats = _model_features(spark, sf_dir)
    winners = group_argmin(_group_losses(spark, sf_dir, feats), ["store_id"])
    return feats, fit_group_model(feats, winners, ["store_id"], CFG)


@register("group_fit", f"""WITH {_group_sql_ctes()}
SELECT tr2.store_id, w.cand_id, w.seasonality_prior_scale, round(tr2.a, {PLACES}) AS intercept,
       round(tr2.b, {PLACES}) AS slope, eff.month, round(eff.effect, {PLACES}) AS effect
FROM tr2 LEFT JOIN w ON tr2.store_id = w.store_id JOIN eff ON eff.store_id = tr2.store_id
""")
def q_group_fit(spark, sf_dir):
    from almanac.plans.group_model import model_effects
    _, model = _group_fit(spark, sf_dir)
    return rounded(model_effects(model, keep=["cand_id", "seasonality_prior_scale", "intercept", "slope"]))


@register("group_forecast", f"""WITH {_group_sql_ctes()}
SELECT store_id, year, month, round(y, {PLACES}) AS sales, round(TS_prediction, {PLACES}) AS TS_prediction
FROM fc WHERE ind = 2
""")
def q_group_forecast(spark, sf_dir):
    from almanac.plans.group_model import group_forecast
    feats, model = _group_fit(spark, sf_dir)
    out = group_forecast(feats.filter(F.col("train_test_val_indicator") == 2), model,
                         ["store_id"], "TS_prediction", CFG)
    return rounded(out.select("store_id", "year", "month", "sales", "TS_prediction"))



# ---------------------------------------------------------------- scoring and selection

def _scored(spark, sf_dir, models):
    from almanac.plans import runner, selection
    frame = runner.prepare(spark, sf_dir, CFG, checkpoint=True, vectors=runner.needs_vectors(models))
    scorers = runner.fit_all(frame, models, CFG)
    names = [n for n, _ in scorers]
    return selection.score_all(frame, scorers), names


def _sql_selection(spark, sf_dir):
    from almanac.plans import runner, selection
    from almanac.session import cut_lineage
    scored, names = _scored(spark, sf_dir, runner.SQL_MODELS)
    scored = cut_lineage(scored)  # losses, winner and export read it: no model runs twice
    losses = selection.model_losses(scored, names)
    best = selection.best_model(losses, "test")
    return scored, names, losses, best


@register("model_losses", f"WITH {_group_sql_ctes()} SELECT * FROM ml")
def q_model_losses(spark, sf_dir):
    _, _, losses, _ = _sql_selection(spark, sf_dir)
    return losses


@register("model_losses_by_store", f"WITH {_group_sql_ctes()} SELECT * FROM mls")
def q_model_losses_by_store(spark, sf_dir):
    from almanac.plans import runner, selection
    scored, names = _scored(spark, sf_dir, runner.SQL_MODELS)
    return selection.model_losses(scored, names, by=["store_id"])


@register("best_model", f"WITH {_group_sql_ctes()} SELECT * FROM best")
def q_best_model(spark, sf_dir):
    _, _, _, best = _sql_selection(spark, sf_dir)
    return best


@register("best_predictions", f"""WITH {_group_sql_ctes()}
SELECT lng.store_id, lng.year, lng.month, lng.ind AS train_test_val_indicator, round(lng.y, {PLACES}) AS sales,
       lng.model_name, round(lng.prediction, {PLACES}) AS prediction
FROM lng JOIN best ON lng.model_name = best.model_name
""")
def q_best_predictions(spark, sf_dir):
    from almanac.plans import selection
    scored, names, _, best = _sql_selection(spark, sf_dir)
    return rounded(selection.best_predictions(scored, names, best))


@register("forecast_export", f"""WITH {_group_sql_ctes()}
SELECT lng.store_id, lng.year, lng.month, round(exp(lng.y), 6) AS sales, lng.model_name,
       round(exp(lng.prediction), 6) AS prediction
FROM lng JOIN best ON lng.model_name = best.model_name
WHERE lng.ind = 2 ORDER BY 1, 2, 3
""")
def q_forecast_export(spark, sf_dir):
    from almanac.plans import selection
    scored, names, _, best = _sql_selection(spark, sf_dir)
    return rounded(selection.forecast_export(selection.best_predictions(scored, names, best)), 6)


@register("best_model_validation", f"""WITH {_group_sql_ctes()}
SELECT model_name, position, loss FROM ml WHERE split = 'validation'
ORDER BY unscored_rows, loss NULLS LAST, position LIMIT 1
""")
def q_best_model_validation(spark, sf_dir):
    """Selection on the validation slice: the test slice stays unseen by the choice."""
    from almanac.plans import selection
    _, _, losses, _ = _sql_selection(spark, sf_dir)
    return selection.best_model(losses, "validation")


def _tree_forecast(spark, sf_dir, kind):
    scored, _ = _scored(spark, sf_dir, (kind,))
    return rounded(scored.filter(F.col("train_test_val_indicator") == 2)
                   .select("store_id", "year", "month", "sales", f"{kind}_prediction"))


@register("rf_forecast")
def q_rf_forecast(spark, sf_dir):
    return _tree_forecast(spark, sf_dir, "RF")


@register("gbt_forecast")
def q_gbt_forecast(spark, sf_dir):
    return _tree_forecast(spark, sf_dir, "GBT")


@register("score_all_models")
def q_score_all_models(spark, sf_dir):
    from almanac.plans import runner
    scored, names = _scored(spark, sf_dir, runner.ALL_MODELS)
    return rounded(scored.select("store_id", "year", "month", "train_test_val_indicator", "sales",
                                 *[f"{n}_prediction" for n in names]))


@register("best_model_all")
def q_best_model_all(spark, sf_dir):
    from almanac.plans import runner, selection
    scored, names = _scored(spark, sf_dir, runner.ALL_MODELS)
    return selection.best_model(selection.model_losses(scored, names), "test")



# ---------------------------------------------------------------- grouped-map model

SPARSE_SPACE = {"changepoint_prior_scale": ["choice", 0.1, 0.5, 2.0, 10.0], "seasonality_prior_scale": ["choice", 0.5, 2.0, 8.0],
                "seasonality_mode": ["choice", "additive", "multiplicative"]}
SPARSE = {"n_changepoints": 4, "order": 2, "sweeps": 40}


def _sparse_ctes() -> str:
    """CTEs of the sparse piecewise fit: per phase (a: training months, b: also validation) statistics st, Gram
    matrices, sweeps, coordinate descent and coefficients be; wi holds every store's best candidate."""
    from almanac.plans.sparse_trend import SINGULAR, places_of
    from almanac.plans.tuning import candidate_grid
    cands = candidate_grid(SPARSE_SPACE, CFG.max_evals, "random", CFG.seed)
    c, order, sweeps = SPARSE["n_changepoints"], SPARSE["order"], SPARSE["sweeps"]
    p = 2 + c + 2 * order
    rows = ", ".join(f"({i}, CAST({x['changepoint_prior_scale']} AS DOUBLE), CAST({x['seasonality_prior_scale']} AS DOUBLE), "
                     f"{int(x['seasonality_mode'] == 'multiplicative')})" for i, x in enumerate(cands))
    tau = "(CASE WHEN t1 > t0 THEN (t - t0) / (t1 - t0) ELSE 0.0 END)"
    level = "(CASE WHEN mode = 1 THEN icpt + line * t ELSE 1.0 END)"
    x = ["CAST(1.0 AS DOUBLE)", tau, *[f"(CASE WHEN n >= 3 THEN greatest({tau} - CAST({v!r} AS DOUBLE), 0) ELSE 0 END)" for v in places_of(c)],
         *[f"{level} * {fn}(CAST({2 * math.pi * k / 12!r} AS DOUBLE) * m)" for k in range(1, order + 1) for fn in ("sin", "cos")]]
    steps = [f"f AS ({SQL_FEATURES_RAW})", f"""r AS (SELECT store_id, year, month AS mon, sales AS y, CAST(month AS DOUBLE) AS m,
    CAST((year - {CFG.base_year}) * 12 + month - 1 AS DOUBLE) AS t, train_test_val_indicator AS ind FROM f WHERE sales IS NOT NULL)""",
             f"ca AS (SELECT * FROM (VALUES {rows}) v(id, cps, sps, mode))", "mo AS (SELECT DISTINCT mode FROM ca)"]
    for ph, fit, source in (("a", "ind = 0", "ca"), ("b", "ind <= 1", "ch")):
        if ph == "b":  # the candidate of least loss, else the first
            steps.append("ch AS (SELECT s.store_id, ca.* FROM st_b s LEFT JOIN wi ON s.store_id = wi.store_id JOIN ca ON ca.id = coalesce(wi.id, 0))")
        at = f"SELECT r.store_id, mode, [{', '.join(x)}, y] AS z FROM r JOIN st_{ph} USING (store_id) CROSS JOIN mo WHERE {fit}"
        own = " AND s.store_id = g.store_id" if ph == "b" else ""
        if ph == "b":
            steps.insert(len(steps) - 1, f"""st_b AS (SELECT store_id, count(*) AS n, min(t) AS t0, max(t) AS t1, CASE WHEN max(t) > min(t) THEN
    regr_intercept(y, t) ELSE avg(y) END AS icpt, CASE WHEN max(t) > min(t) THEN regr_slope(y, t) ELSE 0 END AS line FROM r WHERE {fit}
    GROUP BY 1 HAVING count(*) >= 2)""")
        else:
            steps.append(f"""st_a AS (SELECT store_id, count(*) AS n, min(t) AS t0, max(t) AS t1, CASE WHEN max(t) > min(t) THEN
    regr_intercept(y, t) ELSE avg(y) END AS icpt, CASE WHEN max(t) > min(t) THEN regr_slope(y, t) ELSE 0 END AS line FROM r WHERE {fit}
    GROUP BY 1 HAVING count(*) >= 2)""")
        steps.append(f"""z_{ph} AS ({at}),
g_{ph} AS (SELECT store_id, mode, i, j, sum(z[i] * z[j]) AS v FROM z_{ph} CROSS JOIN (SELECT unnest(range(1, {p + 1})) AS i) a
    CROSS JOIN (SELECT unnest(range(1, {p + 2})) AS j) b GROUP BY ALL),
w_{ph} AS (SELECT g.store_id, s.id, g.mode, cps, i, list(v + CASE WHEN i = j AND i > {2 + c} THEN 1 / greatest(sps * sps, 1e-12) ELSE 0 END
    ORDER BY j) AS row FROM g_{ph} g JOIN {source} s ON s.mode = g.mode{own} GROUP BY ALL),
s_{ph}0 AS (SELECT store_id, id, mode, cps, list(row ORDER BY i) AS M, list(row ORDER BY i) AS A FROM w_{ph} GROUP BY ALL)""")
        pivots = [1, 2, *range(3 + c, p + 1)]
        for n, q in enumerate(pivots):
            steps.append(f"""s_{ph}{n + 1} AS (SELECT * REPLACE (CASE WHEN A[{q}][{q}] > {SINGULAR!r} * M[{q}][{q}] THEN
    list_transform(A, lambda row, i: CASE WHEN i = {q} THEN list_transform(row, lambda v: v / A[{q}][{q}])
        ELSE list_transform(row, lambda v, j: v - row[{q}] / A[{q}][{q}] * A[{q}][j]) END)
    ELSE list_transform(A, lambda row, i: CASE WHEN i = {q} THEN list_transform(row, lambda v: CAST(0 AS DOUBLE)) ELSE row END) END AS A) FROM s_{ph}{n})""")
        last = f"s_{ph}{len(pivots)}"
        # one step of the descent: the coordinate whose turn it is
        diag = " ".join(f"WHEN {j} THEN A[{2 + j}][{2 + j}]" for j in range(1, c + 1))
        first = " ".join(f"WHEN {j} THEN M[{2 + j}][{2 + j}]" for j in range(1, c + 1))
        rho = " ".join(f"WHEN {j} THEN A[{2 + j}][{p + 1}] - (" + " + ".join(
            f"A[{2 + j}][{2 + i}] * d[{i}]" for i in range(1, c + 1) if i != j) + ")" for j in range(1, c + 1))
        steps.append(f"""d_{ph} AS (SELECT store_id, id, M, A, cps, 0 AS s, list_transform(range({c}), lambda v: CAST(0 AS DOUBLE)) AS d FROM {last}
    UNION ALL SELECT store_id, id, M, A, cps, s + 1, list_transform(d, lambda v, j: CASE WHEN j <> k THEN v
        WHEN own <= {SINGULAR!r} * base THEN 0 ELSE sign(rho) * greatest(abs(rho) - 1 / cps, 0) / own + 0 END)
    FROM (SELECT *, s % {c} + 1 AS k, CASE s % {c} + 1 {diag} END AS own, CASE s % {c} + 1 {first} END AS base,
                 CASE s % {c} + 1 {rho} END AS rho FROM d_{ph} WHERE s < {sweeps * c}) o),
be_{ph} AS (SELECT store_id, id, [{', '.join(f'd[{i - 2}]' if 2 < i <= 2 + c else f'A[{i}][{p + 1}] - (' + ' + '.join(f'A[{i}][{2 + j}] * d[{j}]' for j in range(1, c + 1)) + ')' for i in range(1, p + 1))}] AS beta
    FROM d_{ph} WHERE s = {sweeps * c})""")
        if ph == "a":
            steps.append(f"""pr AS (SELECT store_id, id, y, list_sum(list_transform(range(1, {p + 1}), lambda i: xs[i] * beta[i])) AS p FROM (
    SELECT r.store_id, ca.id, y, [{', '.join(x)}] AS xs, beta FROM r JOIN st_a USING (store_id) JOIN be_a USING (store_id) JOIN ca ON ca.id = be_a.id WHERE ind = 1) u),
lo AS (SELECT store_id, id, round(100 * avg(abs((y - p) / nullif(y, 0))), {PLACES}) AS loss FROM pr GROUP BY ALL),
wi AS (SELECT store_id, id, loss FROM lo WHERE loss IS NOT NULL QUALIFY row_number() OVER (PARTITION BY store_id ORDER BY loss, id) = 1)""")
    def each(e):
        return f"[{', '.join(e(i) for i in range(1, c + 1))}]"
    steps.append(f"""model AS (SELECT g.store_id, coalesce(wi.id, -1) AS cand_id, round(wi.loss, 6) AS validation_loss,
    CASE WHEN t1 > t0 THEN beta[1] - beta[2] * t0 / (t1 - t0) ELSE beta[1] END AS intercept,
    CASE WHEN t1 > t0 THEN beta[2] / (t1 - t0) ELSE beta[2] * 0 END AS slope,
    CASE WHEN beta IS NOT NULL THEN [{', '.join(f't0 + CAST({v!r} AS DOUBLE) * (t1 - t0)' for v in places_of(c))}] END AS changepoints,
    CASE WHEN beta IS NOT NULL THEN {each(lambda i: f'CASE WHEN t1 > t0 THEN beta[{2 + i}] / (t1 - t0) ELSE 0 END')} END AS deltas,
    beta[{3 + c}:{p}] AS seasonal, CASE WHEN beta IS NULL THEN NULL WHEN ca.mode = 1 THEN [icpt, line] ELSE [CAST(1 AS DOUBLE), CAST(0 AS DOUBLE)] END AS season_level
    FROM (SELECT DISTINCT store_id FROM f) g LEFT JOIN wi USING (store_id) LEFT JOIN st_b USING (store_id) LEFT JOIN be_b USING (store_id)
    LEFT JOIN ca ON ca.id = be_b.id)""")
    return ",\n".join(steps)


SPARSE_ARRAYS = ("changepoints", "deltas", "seasonal", "season_level")


def _fit_sparse(spark, sf_dir):
    from almanac.plans.sparse_trend import fit_sparse
    feats = _model_features(spark, sf_dir)
    return feats, fit_sparse(feats, CFG, space=SPARSE_SPACE, **SPARSE)


@register("group_fit_fourier", f"""WITH RECURSIVE {_sparse_ctes()}
SELECT store_id, cand_id, validation_loss, round(intercept, 5) AS intercept, round(slope, 6) AS slope,
       {', '.join(f'list_transform({c}, lambda v: round(v, 5)) AS {c}' for c in SPARSE_ARRAYS)} FROM model""")
def q_group_fit_fourier(spark, sf_dir):
    """The sparse piecewise trend and Fourier model: one row of coefficients per store."""
    model = _fit_sparse(spark, sf_dir)[1]
    return model.withColumns({"validation_loss": F.round("validation_loss", 6), "intercept": F.round("intercept", 5),
                              "slope": F.round("slope", 6),
                              **{c: F.transform(c, lambda v: F.round(v, 5)) for c in SPARSE_ARRAYS}})


@register("group_forecast_fourier", f"""WITH RECURSIVE {_sparse_ctes()}
SELECT store_id, year, month, train_test_val_indicator, round(sales, 6) AS sales,
       round(intercept + slope * t + list_sum(list_transform(range(1, {SPARSE['n_changepoints'] + 1}), lambda i: deltas[i] * greatest(t - changepoints[i], 0)))
           + (season_level[1] + season_level[2] * t) * list_sum(list_transform(range(1, {2 * SPARSE['order'] + 1}), lambda i: seasonal[i] *
             CASE WHEN i % 2 = 1 THEN sin({2 * math.pi / 12!r} * month * ((i + 1) // 2)) ELSE cos({2 * math.pi / 12!r} * month * (i // 2)) END)), 6) AS FOURIER_prediction
FROM (SELECT *, CAST((year - {CFG.base_year}) * 12 + month - 1 AS DOUBLE) AS t FROM f) f LEFT JOIN model USING (store_id)""")
def q_group_forecast_fourier(spark, sf_dir):
    """Every month of every store scored with the fitted model."""
    from almanac.plans.fourier import score_fourier
    feats, model = _fit_sparse(spark, sf_dir)
    out = score_fourier(feats.select("store_id", "year", "month", "train_test_val_indicator", "sales"), model, CFG)
    return rounded(out, 6)


@register("fourier_trend_only", f"""WITH {_group_sql_ctes()}
SELECT s.store_id, s.year, s.month, round(tr2.a + tr2.b * s.t, 6) AS FOURIER_prediction
FROM s LEFT JOIN tr2 ON s.store_id = tr2.store_id
""")
def q_fourier_trend_only(spark, sf_dir):
    """Without changepoints and harmonics the grouped-map model is the least-squares line."""
    from almanac.plans.fourier import fourier_forecast
    out = fourier_forecast(_model_features(spark, sf_dir), CFG, n_changepoints=0, order=0)
    return rounded(out.select("store_id", "year", "month", "FOURIER_prediction"), 6)


# ---------------------------------------------------------------- learners with an exact SQL form

SQL_STUMP = f"""WITH {_group_sql_ctes()},
d AS (SELECT t, count(*) AS n, sum(y) AS sy FROM s WHERE ind <= 1 AND y IS NOT NULL GROUP BY t),
cs AS (SELECT t, lead(t) OVER (ORDER BY t) AS nt, sum(n) OVER (ORDER BY t) AS ln, sum(sy) OVER (ORDER BY t) AS ls,
              sum(n) OVER () AS alln, sum(sy) OVER () AS alls FROM d),
cut AS (SELECT (t + nt) / 2 AS edge, ls / ln AS below, (alls - ls) / (alln - ln) AS above FROM cs WHERE nt IS NOT NULL
        ORDER BY ls * ls / ln + (alls - ls) * (alls - ls) / (alln - ln) DESC, t LIMIT 1)
SELECT store_id, year, month, round(CASE WHEN t <= edge THEN below ELSE above END, 6) AS prediction FROM s CROSS JOIN cut
"""


def _stump(spark, sf_dir, kind, **params):
    """One tree of depth 1 on the month axis, fitted on every usable row: the best single threshold."""
    from almanac.functions.scalar import month_index
    from almanac.operators import assemble, drop_vectors
    from almanac.plans.trees import make_estimator
    f = _model_features(spark, sf_dir).withColumn("t", month_index(F.col("year"), F.col("month"), CFG.base_year))
    f = assemble(f.select("store_id", "year", "month", "sales", "t", "train_test_val_indicator"), ["t"], "features")
    est = make_estimator(kind, "sales", "prediction", CFG.seed)
    est = est.copy({est.getParam(k): v for k, v in dict(maxDepth=1, maxBins=512, featureSubsetStrategy="all", **params).items()})
    model = est.fit(f.filter("train_test_val_indicator <= 1 AND sales IS NOT NULL"))
    return rounded(drop_vectors(model.transform(f)).select("store_id", "year", "month", "prediction"), 6)


@register("rf_stump", SQL_STUMP)
def q_rf_stump(spark, sf_dir):
    return _stump(spark, sf_dir, "RF", numTrees=1, bootstrap=False)


@register("gbt_stump", SQL_STUMP)
def q_gbt_stump(spark, sf_dir):
    return _stump(spark, sf_dir, "GBT", maxIter=1)


SQL_SUBSET = f"""WITH {_group_sql_ctes()},
d AS (SELECT store_id, count(*) AS n, sum(y) AS sy FROM s WHERE ind <= 1 AND y IS NOT NULL GROUP BY store_id),
cs AS (SELECT store_id, sy / n AS mean, sum(n) OVER w AS ln, sum(sy) OVER w AS ls, sum(n) OVER () AS alln, sum(sy) OVER () AS alls
       FROM d WINDOW w AS (ORDER BY sy / n, store_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
cut AS (SELECT mean AS edge, ls / ln AS below, (alls - ls) / (alln - ln) AS above FROM cs WHERE ln < alln
        ORDER BY ls * ls / ln + (alls - ls) * (alls - ls) / (alln - ln) DESC, mean LIMIT 1)
SELECT s.store_id, year, month, round(CASE WHEN cs.mean <= edge THEN below ELSE above END, 6) AS prediction
FROM s JOIN cs ON s.store_id = cs.store_id CROSS JOIN cut
"""


@register("rf_store_subset", SQL_SUBSET)
def q_rf_store_subset(spark, sf_dir):
    """One tree of depth 1 over the store as a category: the best split of the stores into two subsets."""
    from almanac.operators import assemble, category_index, drop_vectors
    from almanac.plans.trees import check_bins, make_estimator
    f = category_index(_model_features(spark, sf_dir), "store_id", "store_id_index").select(
        "store_id", "year", "month", "sales", "store_id_index", "train_test_val_indicator")
    f = assemble(f, ["store_id_index"], "features")
    check_bins(f, 512, "this tree")
    est = make_estimator("RF", "sales", "prediction", CFG.seed)
    params = {"maxDepth": 1, "maxBins": 512, "featureSubsetStrategy": "all", "numTrees": 1, "bootstrap": False}
    model = est.copy({est.getParam(k): v for k, v in params.items()}).fit(f.filter("train_test_val_indicator <= 1 AND sales IS NOT NULL"))
    return rounded(drop_vectors(model.transform(f)).select("store_id", "year", "month", "prediction"), 6)


# ---------------------------------------------------------------- second-order boosting (M3)

# features with few values, so that every value is a bin; one of them has missing values
BOOST_FEATURES = {"month": "month", "year": "year", "last": "round(lag_sales_1, 1)",
                  "before": "CASE WHEN month % 5 = 0 THEN NULL ELSE round(lag_sales_2, 1) END",
                  "season": f"round(lag_sales_{LAGS[-1]}, 1)"}
BOOST = {"n_trees": 2, "max_depth": 2, "learning_rate": 0.5, "reg_lambda": 2.0, "gamma": 0.001, "min_child_weight": 5.0,
         "subsample": 0.8, "colsample": 0.6, "max_bins": 256}


def _boost_ctes() -> str:
    """CTEs p0..pT (rows with their margins) and best{t}_{level} (chosen splits) of the first trees."""
    from almanac.plans.boosting import BoostParams, sampled_columns
    par, names = BoostParams(**BOOST), list(BOOST_FEATURES)
    lam, lr, seed = par.reg_lambda, par.learning_rate, par.seed
    steps = [f"f AS ({SQL_FEATURES_RAW})",
             "b AS (SELECT store_id, year AS y_, month AS m_, sales AS y, train_test_val_indicator AS ind, "
             + ", ".join(f"CAST({e} AS DOUBLE) AS f{j}" for j, e in enumerate(BOOST_FEATURES.values())) + " FROM f)",
             "p0 AS (SELECT *, (SELECT avg(y) FROM b WHERE ind <= 1) AS margin FROM b)"]
    for t in range(par.n_trees):
        steps.append(f"""n{t}_0 AS (SELECT *, 0 AS node, ind <= 1 AND y IS NOT NULL AND CAST('0x' || substr(md5(store_id || '|' || y_ || '|' || m_
    || '|{seed}|{t}'), 1, 8) AS BIGINT) < {par.subsample * 2.0 ** 32!r} AS used FROM p{t})""")
        for level in range(par.max_depth):
            at = f"{t}_{level}"
            long = " UNION ALL ".join(f"SELECT node, {j} AS f, f{j} AS x, margin - y AS g FROM n{at} WHERE used AND node >= {2 ** level - 1}"
                                      for j in sampled_columns(len(names), par, t))
            steps.append(f"""h{at} AS (SELECT node, f, x, sum(g) AS g, count(*) AS h FROM ({long}) u GROUP BY node, f, x),
s{at} AS (SELECT node, f, sum(g) AS ga, sum(h) AS ha, coalesce(sum(g) FILTER (x IS NULL), 0) AS gm,
          coalesce(sum(h) FILTER (x IS NULL), 0) AS hm FROM h{at} GROUP BY node, f),
c{at} AS (SELECT node, f, x, sum(g) OVER w AS gl, sum(h) OVER w AS hl FROM h{at} WHERE x IS NOT NULL
          WINDOW w AS (PARTITION BY node, f ORDER BY x ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
d{at} AS (SELECT s.node, s.f, x, ml, ga, ha, coalesce(gl, 0) + CASE WHEN ml THEN gm ELSE 0 END AS gl,
          coalesce(hl, 0) + CASE WHEN ml THEN hm ELSE 0 END AS hl
          FROM c{at} c JOIN s{at} s ON c.node = s.node AND c.f = s.f CROSS JOIN (VALUES (false), (true)) v(ml)
          WHERE c.hl IS NOT NULL),
best{at} AS (SELECT * FROM (SELECT *, round(0.5 * (gl * gl / (hl + {lam}) + (ga - gl) * (ga - gl) / (ha - hl + {lam})
             - ga * ga / (ha + {lam})) - {par.gamma}, {PLACES}) AS gain FROM d{at}
             WHERE hl >= {par.min_child_weight} AND ha - hl >= {par.min_child_weight}) z WHERE gain > 0
             QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, f, x, ml) = 1),
n{t}_{level + 1} AS (SELECT n.* REPLACE (CASE WHEN k.f IS NULL THEN n.node ELSE 2 * n.node + CASE WHEN
    CASE WHEN v{level} IS NULL THEN k.ml ELSE v{level} < k.x END THEN 1 ELSE 2 END END AS node) FROM (
    SELECT n.*, CASE k.f {' '.join(f'WHEN {j} THEN f{j}' for j in range(len(names)))} END AS v{level} FROM n{at} n LEFT JOIN best{at} k ON n.node = k.node) n
    LEFT JOIN best{at} k ON n.node = k.node)""")
        sides = " UNION ALL ".join(
            f"SELECT 2 * node + 1 AS node, -gl / (hl + {lam}) AS weight FROM best{t}_{i} UNION ALL "
            f"SELECT 2 * node + 2, -(ga - gl) / (ha - hl + {lam}) FROM best{t}_{i}" for i in range(par.max_depth))
        steps.append(f"""w{t} AS (SELECT 0 AS node, -sum(margin - y) / (count(*) + {lam}) AS weight FROM n{t}_0 WHERE used UNION ALL {sides}),
p{t + 1} AS (SELECT n.store_id, y_, m_, y, ind, {', '.join(f'f{j}' for j in range(len(names)))},
             margin + {lr} * w.weight AS margin FROM n{t}_{par.max_depth} n JOIN w{t} w ON n.node = w.node)""")
    return ",\n".join(steps)


def _boost_nodes_sql() -> str:
    names, depth, trees = list(BOOST_FEATURES), BOOST["max_depth"], BOOST["n_trees"]
    feature = f"CASE b.f {' '.join(f'WHEN {j} THEN {chr(39)}{n}{chr(39)}' for j, n in enumerate(names))} END"
    parts = [f"""SELECT CAST({t} AS INTEGER) AS tree, CAST(w.node AS INTEGER) AS node, {feature} AS feature, b.x AS cut,
       b.ml AS missing_left, round(b.gain, 6) AS gain, round(w.weight, 6) AS weight
FROM w{t} w LEFT JOIN ({' UNION ALL '.join(f'SELECT * FROM best{t}_{i}' for i in range(depth))}) b ON w.node = b.node"""
             for t in range(trees)]
    return f"WITH {_boost_ctes()} " + " UNION ALL ".join(parts)


def _boosted(spark, sf_dir):
    from almanac.plans.boosting import BoostParams, fit_boosted
    f = _model_features(spark, sf_dir)
    own = f.select("store_id", "year", "month", "sales", "train_test_val_indicator",
                   *[F.expr(e).cast("double").alias(f"x_{n}") for n, e in BOOST_FEATURES.items()])
    model = fit_boosted(own.filter("train_test_val_indicator <= 1"), [f"x_{n}" for n in BOOST_FEATURES], "sales",
                        ["store_id", "year", "month"], BoostParams(**BOOST))
    return own, model


@register("boost_two_trees", f"""WITH {_boost_ctes()}
SELECT store_id, y_ AS year, m_ AS month, round(margin, 6) AS prediction FROM p{BOOST['n_trees']}
""")
def q_boost_two_trees(spark, sf_dir):
    """Two boosted trees with row and column samples and learned sides for missing values, on every row."""
    own, model = _boosted(spark, sf_dir)
    return rounded(model.transform(own).select("store_id", "year", "month", "prediction"), 6)


@register("boost_tree_nodes", _boost_nodes_sql())
def q_boost_tree_nodes(spark, sf_dir):
    """The same two trees as data: one row a node."""
    own, model = _boosted(spark, sf_dir)
    nodes = model.nodes(spark).withColumn("feature", F.substring("feature", 3, 100))
    return nodes.withColumns({"gain": F.round("gain", 6), "weight": F.round("weight", 6)})


@register("boost_forecast")
def q_boost_forecast(spark, sf_dir):
    return _tree_forecast(spark, sf_dir, "BOOST")


@register("score_sql_models", f"""WITH {_group_sql_ctes()}
SELECT store_id, year, month, ind AS train_test_val_indicator, round(y, {PLACES}) AS sales,
       {_round_list(['TS_prediction', 'LAST_MONTH_prediction', 'LAST_YEAR_prediction'])}
FROM sc
""")
def q_score_sql_models(spark, sf_dir):
    from almanac.plans import runner
    scored, names = _scored(spark, sf_dir, runner.SQL_MODELS)
    return rounded(scored.select("store_id", "year", "month", "train_test_val_indicator", "sales",
                                 *[f"{n}_prediction" for n in names]))


@register("drop_vectors", features_sql_rounded())
def q_drop_vectors(spark, sf_dir):
    """the feature frame with its assembled vector removed again."""
    from almanac.operators import assemble, drop_vectors
    return rounded(drop_vectors(assemble(_features(spark, sf_dir), ["month", "year"] + LAG_COLS, "features")))


# ---------------------------------------------------------------- calendar lags

SQL_FEATURES_CALENDAR = f"""
WITH m AS ({SQL_MONTHLY}),
b AS (SELECT store_id, min(year * 12 + month - 1) AS lo, max(year * 12 + month - 1) AS hi FROM m GROUP BY 1),
sp AS (SELECT store_id, unnest(generate_series(lo, hi)) AS i FROM b),
f AS (SELECT sp.store_id, CAST(sp.i // 12 AS INTEGER) AS year, CAST(sp.i % 12 + 1 AS INTEGER) AS month,
             CASE WHEN m.sales > 0 THEN ln(m.sales) END AS sales
      FROM sp LEFT JOIN m ON m.store_id = sp.store_id AND m.year = CAST(sp.i // 12 AS INTEGER)
                          AND m.month = CAST(sp.i % 12 + 1 AS INTEGER)),
g AS (SELECT *, {_lag_sql('sales', LAGS, 'store_id', 'year, month')},
             row_number() OVER (PARTITION BY store_id ORDER BY year, month) AS place FROM f)
SELECT store_id, year, month, sales, {', '.join(LAG_COLS)}, make_date(year, month, 1) AS ds,
       {_label_sql()} AS train_test_val_indicator
FROM g WHERE place > {max(LAGS)}
"""


@register("tune_group_losses_calendar", f"WITH {_group_sql_ctes(SQL_FEATURES_CALENDAR)} SELECT * FROM losses")
def q_tune_group_losses_calendar(spark, sf_dir):
    """Candidate losses on series whose missing months are filled in (null values)."""
    from dataclasses import replace
    from almanac.plans.features import load_monthly_features
    from almanac.session import cut_lineage
    feats = cut_lineage(load_monthly_features(spark, sf_dir, replace(CFG, calendar_lags=True)))
    return _group_losses(spark, sf_dir, feats)


# ---------------------------------------------------------------- wide daily tables end to end

@register("csv_round_trip", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def q_csv_round_trip(spark, sf_dir):
    """A table written as CSV with a header and read back with its schema."""
    from almanac.sources import read_csv, write_forecasts
    (su,) = _tables(spark, sf_dir, "supplier")
    su = su.select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    path = _folder(spark, "supplier.csv")
    write_forecasts(su, path, "csv")
    return read_csv(spark, path, su.schema)


def _folder(spark, name):
    import uuid
    from almanac.session import ensure_checkpoint_dir
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/almanac-{uuid.uuid4().hex}-{name}"


WIDE_KEYS = ("store_id", "dept_id")
SQL_FEATURES_WIDE = f"""
WITH x AS (SELECT n.n_name AS store_id, l.l_returnflag AS dept_id, CAST(year(l.l_shipdate) AS INTEGER) AS year,
                  CAST(month(l.l_shipdate) AS INTEGER) AS month, l.l_quantity AS q
           FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN nation n ON s.s_nationkey = n.n_nationkey),
sp AS (SELECT min(CAST(l_shipdate AS DATE)) AS d0, max(CAST(l_shipdate AS DATE)) AS d1 FROM lineitem),
mo AS (SELECT DISTINCT CAST(year(dt) AS INTEGER) AS year, CAST(month(dt) AS INTEGER) AS month
       FROM (SELECT unnest(generate_series(d0, d1, INTERVAL 1 DAY)) AS dt FROM sp) c),
gr AS (SELECT DISTINCT store_id, dept_id FROM x),
su AS (SELECT store_id, dept_id, year, month, sum(q) AS sales FROM x GROUP BY ALL),
f AS (SELECT gr.store_id, gr.dept_id, mo.year, mo.month, CASE WHEN su.sales > 0 THEN ln(su.sales) END AS sales
      FROM gr CROSS JOIN mo LEFT JOIN su ON su.store_id = gr.store_id AND su.dept_id = gr.dept_id
                                         AND su.year = mo.year AND su.month = mo.month),
g AS (SELECT *, {_lag_sql('sales', LAGS, 'store_id, dept_id', 'year, month')} FROM f)
SELECT store_id, dept_id, year, month, sales, {', '.join(LAG_COLS)}, make_date(year, month, 1) AS ds,
       {_label_sql()} AS train_test_val_indicator
FROM g WHERE lag_sales_{LAGS[-1]} IS NOT NULL
"""


@register("wide_daily_forecast", f"""WITH {_group_sql_ctes(SQL_FEATURES_WIDE, WIDE_KEYS)}
SELECT store_id, dept_id, year, month, ind AS train_test_val_indicator, round(y, 6) AS sales,
       round(TS_prediction, 6) AS TS_prediction FROM fc
""")
def q_wide_daily_forecast(spark, sf_dir):
    """A wide daily table (one column a day) and a calendar table, both CSV, to monthly forecasts per
    store and department."""
    from dataclasses import replace
    from almanac.plans import group_model
    from almanac.plans.features import load_wide_features, wide_store_daily
    from almanac.session import cut_lineage
    from almanac.sources import write_forecasts
    cfg = replace(CFG, keys=WIDE_KEYS)
    wide, cal = wide_store_daily(*_tables(spark, sf_dir, "lineitem", "supplier", "nation"))
    paths = _folder(spark, "wide.csv"), _folder(spark, "calendar.csv")
    write_forecasts(wide, paths[0], "csv")
    write_forecasts(cal, paths[1], "csv")
    feats = cut_lineage(load_wide_features(spark, *paths, cfg))
    out = group_model.tune_fit_forecast(feats, cfg, WIDE_KEYS)
    return rounded(out.select(*WIDE_KEYS, "year", "month", "train_test_val_indicator", "sales", "TS_prediction"), 6)


@register("month_spine", f"""
WITH m AS ({SQL_MONTHLY}),
b AS (SELECT store_id, min(year * 12 + month - 1) AS lo, max(year * 12 + month - 1) AS hi FROM m GROUP BY 1),
sp AS (SELECT store_id, unnest(generate_series(lo, hi)) AS i FROM b),
g AS (SELECT sp.store_id, CAST(sp.i // 12 AS INTEGER) AS year, CAST(sp.i % 12 + 1 AS INTEGER) AS month,
             CASE WHEN m.sales > 0 THEN ln(m.sales) END AS sales
      FROM sp LEFT JOIN m ON m.store_id = sp.store_id AND m.year = CAST(sp.i // 12 AS INTEGER)
                          AND m.month = CAST(sp.i % 12 + 1 AS INTEGER)),
l AS (SELECT *, {_lag_sql('sales', [1, LAGS[-1]], 'store_id', 'year, month')} FROM g)
SELECT store_id, year, month, {_round_list(['sales', 'lag_sales_1', f'lag_sales_{LAGS[-1]}'])} FROM l
""")
def q_month_spine(spark, sf_dir):
    from almanac.functions import log_cols
    from almanac.operators import fill_month_gaps, lag_features
    full = fill_month_gaps(log_cols(_monthly(spark, sf_dir), ["sales"]), ["store_id"])
    return rounded(lag_features(full, "sales", ["store_id"], ["year", "month"], [1, LAGS[-1]]))


@register("feature_vector", f"""
SELECT f.store_id, f.year, f.month,
       [{', '.join(f'round(CAST({c} AS DOUBLE), {PLACES})' for c in FEATURE_COLS)}] AS features
FROM ({SQL_FEATURES_RAW}) f JOIN ({SQL_STORE_INDEX}) r ON f.store_id = r.store_id
""")
def q_feature_vector(spark, sf_dir):
    """E2 + E3: the MLlib vector the tree learners see, turned back into an array."""
    from almanac.operators import assemble, category_index, vector_as_array
    f = assemble(category_index(_model_features(spark, sf_dir), "store_id", "store_id_index"), FEATURE_COLS)
    f = vector_as_array(f, "features")
    return f.select("store_id", "year", "month",
                    F.transform("features", lambda x: F.round(x, PLACES)).alias("features"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: q.build for name, q in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {name: q.sql for name, q in REGISTRY.items() if q.sql}
