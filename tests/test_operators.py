"""Behavioural cases for the feature operators (fixtures of the surveyed project + edge cases)."""

import math

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from almanac.functions import antilog_cols, date_stamp, log_cols
from almanac.operators import (fill_missing, filter_rows, group_agg, join, lag_features,
                               month_split, split_label, unpivot, drop_vectors, assemble,
                               category_index, feature_array, vector_as_array, lag_complete)


def test_filter(spark):
    df = spark.createDataFrame([("ulm", 40, None), ("bern", 7, "x"), (None, 12, "y")], "town string, size int, tag string")
    assertDataFrameEqual(filter_rows(df, "size between 7 and 12"), [Row(town="bern", size=7, tag="x"), Row(town=None, size=12, tag="y")])
    assertDataFrameEqual(filter_rows(df, F.col("tag").isNull()), [Row(town="ulm", size=40, tag=None)])
    assert filter_rows(df, "tag = 'z'").count() == 0


def test_filter_bad_column(spark):
    with pytest.raises(Exception):
        filter_rows(spark.range(3), "nowhere > 1").collect()


def _wide(spark):
    return spark.createDataFrame([("north", "oil", 3.0, 0.0, 8.5), ("south", "gas", 1.0, None, -2.0)],
                                 "site string, kind string, d_1 double, d_2 double, d_3 double")


def test_unpivot(spark):
    out = unpivot(_wide(spark), ["site", "kind"])
    assert out.columns == ["site", "kind", "day", "sales"]
    assertDataFrameEqual(out, [Row(site="north", kind="oil", day="d_1", sales=3.0), Row(site="north", kind="oil", day="d_2", sales=0.0),
                               Row(site="north", kind="oil", day="d_3", sales=8.5), Row(site="south", kind="gas", day="d_1", sales=1.0),
                               Row(site="south", kind="gas", day="d_2", sales=None), Row(site="south", kind="gas", day="d_3", sales=-2.0)])
    some = unpivot(_wide(spark), ["kind"], ["d_3", "d_1"], "when", "amount")
    assert some.columns == ["kind", "when", "amount"] and some.count() == 4


def test_unpivot_clashing_names_and_many_columns(spark):
    df = spark.createDataFrame([("a", "p", 1, 2)], "_pos string, pos string, `d.1` int, d_2 int")
    out = sorted(tuple(r) for r in unpivot(df.withColumnRenamed("_pos", "id"), ["id", "pos"]).collect())
    assert out == [("a", "p", "d.1", 1), ("a", "p", "d_2", 2)]
    wide = spark.range(3).select("id", *[(F.col("id") * k).alias(f"d_{k}") for k in range(1, 1901)])
    long = unpivot(wide, ["id"])
    assert long.count() == 3 * 1900 and long.filter("id = 2 AND day = 'd_700'").first().sales == 1400


def test_unpivot_bad_id(spark):
    with pytest.raises(ValueError):
        unpivot(_wide(spark), [""])
    with pytest.raises(ValueError):
        unpivot(_wide(spark), ["place"])


def test_unpivot_mixed_types_raises(spark):
    df = spark.createDataFrame([("a", 1, 2.0)], "site string, d_1 bigint, d_2 double")
    with pytest.raises(TypeError):
        unpivot(df, ["site"])


def _ym(spark, names=("year", "month")):
    return spark.createDataFrame([(1998, 3), (1999, 1), (1999, 6), (1999, 7), (2001, 12)],
                                 f"{names[0]} bigint, {names[1]} bigint")


def test_month_split_is_inclusive_before(spark):
    out = month_split(_ym(spark), {"year": 1999, "month": 6}, "before")
    assertDataFrameEqual(out, [Row(year=1998, month=3), Row(year=1999, month=1), Row(year=1999, month=6)])


def test_month_split_after(spark):
    out = month_split(_ym(spark), {"year": 1999, "month": 6}, "after")
    assertDataFrameEqual(out, [Row(year=1999, month=7), Row(year=2001, month=12)])


def test_month_split_wrong_names(spark):
    with pytest.raises(Exception):
        month_split(_ym(spark, ("y", "m")), {"year": 1999, "month": 6}).collect()


def test_month_split_null_year_neither_side(spark):
    df = spark.createDataFrame([(None, 8), (1999, None)], "year bigint, month bigint")
    for side in ("before", "after"):
        assert month_split(df, {"year": 1999, "month": 6}, side).count() == 0


def _series(spark):
    rows = [(g, k, float(k * k) if g == "u" else float(10 - k)) for g in "uv" for k in range(1, 5)]
    return spark.createDataFrame(rows, "grp string, step int, v double")


def test_lag(spark):
    out = lag_features(_series(spark), "v", ["grp"], ["step"], [1, 3])
    assert out.columns == ["grp", "step", "v", "lag_v_1", "lag_v_3"]
    got = {(r.grp, r.step): (r.lag_v_1, r.lag_v_3) for r in out.collect()}
    assert got == {("u", 1): (None, None), ("u", 2): (1.0, None), ("u", 3): (4.0, None), ("u", 4): (9.0, 1.0),
                   ("v", 1): (None, None), ("v", 2): (9.0, None), ("v", 3): (8.0, None), ("v", 4): (7.0, 9.0)}


def test_lag_complete(spark):
    out = lag_complete(lag_features(_series(spark), "v", ["grp"], ["step"], [1, 3]), "lag_v_3")
    assert sorted((r.grp, r.step) for r in out.collect()) == [("u", 4), ("v", 4)]


def _joinable(spark, right_key="code"):
    a = spark.createDataFrame([("k1", 10), ("k2", 20), ("k2", 21), (None, 30)], "key string, qty int")
    b = spark.createDataFrame([("k2", "two"), ("k3", "three"), (None, "none")], f"{right_key} string, label string")
    return a, b


def test_join_column_different_names(spark):
    a, b = _joinable(spark)
    out = join(a, b, (a.key == b.code) & (a.qty > 20))
    assert out.columns == ["key", "qty", "code", "label"] and [r.qty for r in out.collect()] == [21]


def test_join_column_same_name(spark):
    a, b = _joinable(spark, "key")
    out = join(a, b, a.key == b.key)
    assert out.columns == ["key", "qty", "key", "label"] and out.count() == 2


def test_join_string(spark):
    a, b = _joinable(spark, "key")
    assertDataFrameEqual(join(a, b, "key"), [Row(key="k2", qty=20, label="two"), Row(key="k2", qty=21, label="two")])
    assert join(a, b, ["key"], "left").count() == 4


def test_join_dict(spark):
    a, b = _joinable(spark)
    out = join(a, b, {"df1_col": "key", "df2_col": "code"}, "full")
    assert out.columns == ["key", "qty", "code", "label"] and out.count() == 6


def test_join_missing_column(spark):
    a, b = _joinable(spark)
    for on in ("code", ["key", "code"], {"df1_col": "key", "df2_col": "nowhere"}):
        with pytest.raises(ValueError):
            join(a, b, on)


def _grp(spark):
    return spark.createDataFrame([("p", 3.0), ("p", None), ("p", 9.0), ("q", -1.0), (None, 5.0)], "part string, v double")


@pytest.mark.parametrize("fn,expected", [("sum", {"p": 12.0, "q": -1.0, None: 5.0}), ("avg", {"p": 6.0, "q": -1.0, None: 5.0}),
                                         ("max", {"p": 9.0, "q": -1.0, None: 5.0}), ("count", {"p": 2, "q": 1, None: 1}),
                                         ("mean", {"p": 6.0, "q": -1.0, None: 5.0})])
def test_group_agg(spark, fn, expected):
    out = group_agg(_grp(spark), ["part"], {"v": fn})
    assert out.columns == ["part", "v"] and {r.part: r.v for r in out.collect()} == expected


def test_group_count_star(spark):
    out = group_agg(_grp(spark), ["part"], {"*": "count"})
    assert {r.part: r["count"] for r in out.collect()} == {"p": 3, "q": 1, None: 1}
    with pytest.raises(ValueError):
        group_agg(_grp(spark), ["part"], {"w": "sum"})


def test_log(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([2.0, 0.0, -3.0, None, 1e-300])], "i int, v double")
    got = [r.v for r in log_cols(df, ["v"]).orderBy("i").collect()]
    assert got[1:4] == [None, None, None]
    assert abs(got[0] - math.log(2)) < 1e-15 and abs(got[4] - math.log(1e-300)) < 1e-9


def test_log_output_cols(spark):
    df = spark.createDataFrame([(3.0, 4.0)], "a double, b double")
    out = log_cols(df, ["a", "b"], ["ln_a", "ln_b"]).first()
    assert (out.a, out.b) == (3.0, 4.0) and abs(out.ln_a + out.ln_b - math.log(12)) < 1e-12


def test_antilog(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([0.5, -0.5, None])], "i int, v double")
    back = antilog_cols(df, ["v"]).orderBy("i").collect()
    assert abs(back[0].v * back[1].v - 1.0) < 1e-12 and back[2].v is None
    again = log_cols(antilog_cols(df, ["v"], ["w"]), ["w"]).orderBy("i").collect()
    assert all(r.v is None and r.w is None or abs(r.v - r.w) < 1e-12 for r in again)


def test_antilog_empty_name(spark):
    with pytest.raises(ValueError):
        antilog_cols(spark.range(1), [""])


def test_date_stamp(spark):
    import datetime as dt
    df = spark.createDataFrame([(1, 2004, 2), (2, 1970, 1), (3, 1999, 0)], "i int, year bigint, month bigint")
    assert [r.ds for r in date_stamp(df, ("year", "month"), "ds").orderBy("i").collect()] == [
        dt.date(2004, 2, 1), dt.date(1970, 1, 1), None]


def test_date_stamp_null_parts(spark):
    df = spark.createDataFrame([(None, 3), (2020, None), (2020, 13)], "year bigint, month bigint")
    assert [r.ds for r in date_stamp(df).collect()] == [None, None, None]


def test_split_label(spark):
    """Strict on both sides: the two split months themselves are validation."""
    months = [(1997, 12), (1998, 3), (1998, 4), (1998, 5), (1998, 9), (1998, 10), (1998, 11), (2000, 1)]
    df = spark.createDataFrame([(i, y, m) for i, (y, m) in enumerate(months)], "i int, year bigint, month bigint")
    out = split_label(df, {"year": 1998, "month": 4}, {"year": 1998, "month": 10}, output_col="slice")
    assert dict(out.dtypes)["slice"] == "int"
    assert [r.slice for r in out.orderBy("i").collect()] == [0, 0, 1, 1, 1, 1, 2, 2]


def test_split_label_null_year_is_validation(spark):
    df = spark.createDataFrame([(None, 3)], "year bigint, month bigint")
    out = split_label(df, {"year": 2015, "month": 0}, {"year": 2015, "month": 5})
    assert out.first().train_test_val_indicator == 1


def test_fill_missing_subset(spark):
    df = spark.createDataFrame([(None, None, None)], "a double, b double, s string")
    r = fill_missing(df, 0.0, ["a"]).first()
    assert r.a == 0.0 and r.b is None and r.s is None
    r = fill_missing(df, 0.0).first()
    assert r.a == 0.0 and r.b == 0.0 and r.s is None


def test_fill_missing_nan(spark):
    df = spark.createDataFrame([(float("nan"),)], "a double")
    assert fill_missing(df, 0.0, ["a"]).first().a == 0.0


def test_encode_and_drop_vectors(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", 2.0), ("b", 3.0), ("c", 0.0)], "s string, x double")
    idx = category_index(df, "s")
    got = {r.s: r.s_index for r in idx.collect()}
    assert got == {"b": 0.0, "a": 1.0, "c": 2.0}
    vec = assemble(idx, ["s_index", "x"])
    arr = vector_as_array(vec, "features", "arr")
    assert [r.arr for r in arr.orderBy("x").collect()][0] == [2.0, 0.0]
    assert "features" not in drop_vectors(vec).columns
    fa = feature_array(idx, ["s_index", "x"])
    assert dict(fa.dtypes)["features"] == "array<double>"


def test_fill_month_gaps_then_calendar_lag(spark):
    from almanac.operators import fill_month_gaps
    df = spark.createDataFrame([("a", 2000, 11, 1.0), ("a", 2001, 2, 4.0), ("b", 2000, 1, 7.0)],
                               "k string, year int, month int, v double")
    full = fill_month_gaps(df, ["k"])
    rows = sorted((r.k, r.year, r.month, r.v) for r in full.collect())
    assert rows == [("a", 2000, 11, 1.0), ("a", 2000, 12, None), ("a", 2001, 1, None),
                    ("a", 2001, 2, 4.0), ("b", 2000, 1, 7.0)]
    lagged = lag_features(full, "v", ["k"], ["year", "month"], [3])
    got = {(r.k, r.year, r.month): r.lag_v_3 for r in lagged.collect()}
    assert got[("a", 2001, 2)] == 1.0


def test_stages_in_ml_pipeline(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import StringIndexer
    from almanac.stages import Stage
    wide = spark.createDataFrame([("s1", "F", 1, 2, 3), ("s2", "F", 4, 5, 6), ("s3", "X", 7, 8, 9)],
                                 "store_id string, dept_id string, d_1 bigint, d_2 bigint, d_3 bigint")
    cal = spark.createDataFrame([("d_1", 2020, 1), ("d_2", 2020, 1), ("d_3", 2020, 2)],
                                "d string, year int, month int")
    model = Pipeline(stages=[
        Stage(filter_rows, "dept_id = 'F'"),
        Stage(unpivot, ["store_id", "dept_id"]),
        Stage(join, cal, {"df1_col": "day", "df2_col": "d"}),
        Stage(group_agg, ["store_id", "year", "month"], {"sales": "sum"}),
        Stage(log_cols, ["sales"]),
        Stage(lag_features, "sales", ["store_id"], ["year", "month"], [1]),
        StringIndexer(inputCol="store_id", outputCol="store_id_index"),
    ]).fit(wide)
    out = {(r.store_id, r.month): (round(r.sales, 9), r.lag_sales_1) for r in model.transform(wide).collect()}
    assert set(out) == {("s1", 1), ("s1", 2), ("s2", 1), ("s2", 2)}
    assert out[("s1", 1)][0] == round(math.log(3), 9) and out[("s1", 1)][1] is None
    assert round(out[("s2", 2)][1], 9) == round(math.log(9), 9)


def test_salted_join_equals_plain_join_under_copies(spark):
    from almanac.operators import hot_keys, salted_join
    # a third of the big side is one repeated row of a hot key
    big = spark.createDataFrame([("hot", 1)] * 300 + [(f"k{i % 20}", i) for i in range(600)],
                                "k string, v bigint")
    small = spark.createDataFrame([("hot", "H")] + [(f"k{i}", f"K{i}") for i in range(15)],
                                  "k string, name string")
    for how in ("inner", "left"):
        plain = sorted(tuple(r) for r in big.join(small, "k", how).collect())
        salted = sorted(tuple(r) for r in join(big, small, "k", how, salt_buckets=8).collect())
        assert plain == salted
    assert {r.k for r in hot_keys(big, ["k"], 0.1).collect()} == {"hot"}
    with pytest.raises(ValueError):
        salted_join(big, small, ["k"], 4, "full")


def test_fill_month_gaps_keeps_rows_without_full_key(spark):
    from almanac.operators import fill_month_gaps
    df = spark.createDataFrame([("a", 2000, 1, 1.0), ("a", 2000, 3, 3.0), ("a", None, 5, 9.0),
                                (None, 2000, 2, 7.0), ("b", 2001, None, 4.0)],
                               "k string, year int, month int, v double")
    out = sorted((r.k or "", r.year or 0, r.month or 0, r.v) for r in fill_month_gaps(df, ["k"]).collect())
    assert out == [("", 2000, 2, 7.0), ("a", 0, 5, 9.0), ("a", 2000, 1, 1.0), ("a", 2000, 2, None),
                   ("a", 2000, 3, 3.0), ("b", 2001, 0, 4.0)]


def test_category_index_matches_string_indexer(spark):
    from pyspark.ml.feature import StringIndexer
    rows = [(f"L{i % 37}",) for i in range(2000)] + [(f"L{i}",) for i in range(37, 60)] + [(None,)]
    df = spark.createDataFrame(rows, "s string").repartition(7)
    mllib = StringIndexer(inputCol="s", outputCol="i", handleInvalid="skip").fit(df).transform(df)
    want = {r.s: r.i for r in mllib.collect()}
    # keep several range partitions so the per-partition offsets are exercised
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r.s: r.s_index for r in category_index(df, "s").collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got.pop(None) is None  # a null label has no index
    assert got == want and sorted(got.values()) == [float(i) for i in range(60)]
    few = df.filter("s < 'L2'")
    assert {r.s_index for r in category_index(df.filter("s = 'L5'"), "s", fit_on=few).collect()} == {None}  # unseen


def test_checkpoint_folder_is_needed_on_a_cluster(monkeypatch):
    from types import SimpleNamespace
    from almanac.session import ensure_checkpoint_dir
    set_dirs = []
    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: set_dirs[-1] if set_dirs else None,
                              setCheckpointDir=set_dirs.append)
    conf = {}
    session = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=conf.get, set=conf.__setitem__))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(session)
    conf["spark.checkpoint.dir"] = "hdfs:///shared"
    assert ensure_checkpoint_dir(session) == "hdfs:///shared"
