"""Published exports, checked CSV scans and lags over ranges of a series."""

import os
import random

import pytest
from pyspark.sql import functions as F

from almanac.operators import lag_features, lag_features_ranged
from almanac.sources import publish_forecasts, read_csv_checked, read_published
from almanac.sources import sinks

SCHEMA = "store_id string, month int, prediction double, dept_id string"


def export(spark, depts, value):
    return spark.createDataFrame([(f"s{i}", m, value + i, d) for d in depts for i in range(3) for m in (1, 2)], SCHEMA)


def shown(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_one_department_is_replaced_alone(spark, tmp_path, fmt):
    path = str(tmp_path / "out")
    first = export(spark, ["R", "A/B", "007"], 10.0)
    assert publish_forecasts(first, path, fmt=fmt)["number"] == 1
    assert shown(read_published(spark, path)) == shown(first)
    again = export(spark, ["R"], 50.0)
    now = publish_forecasts(again, path, fmt=fmt)
    assert now["number"] == 2 and len(set(now["parts"].values())) == 2
    assert shown(read_published(spark, path)) == shown(again.unionByName(first.filter("dept_id <> 'R'")))
    assert read_published(spark, path).columns == first.columns
    assert shown(read_published(spark, path, ["007"])) == shown(first.filter("dept_id = '007'"))


def test_readers_never_see_half_an_export(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "out")
    with pytest.raises(FileNotFoundError):
        read_published(spark, path)
    first = export(spark, ["R", "N"], 1.0)
    publish_forecasts(first, path)

    class Stop(Exception):
        pass

    def dies(*a):
        raise Stop
    # dies after the rows are written, before the manifest is
    monkeypatch.setattr(sinks, "latest_manifest", dies)
    with pytest.raises(Stop):
        publish_forecasts(export(spark, ["R"], 9.0), path)
    monkeypatch.undo()
    assert len(os.listdir(f"{path}/data")) == 2
    assert shown(read_published(spark, path)) == shown(first)
    # two exports that end at once: the second does not take the first one's number
    old = sinks.latest_manifest(spark, path)
    publish_forecasts(export(spark, ["N"], 5.0), path)
    monkeypatch.setattr(sinks, "latest_manifest", lambda *a: old)
    with pytest.raises(RuntimeError, match="number 2"):
        publish_forecasts(export(spark, ["R"], 7.0), path)
    monkeypatch.undo()
    assert {r["prediction"] for r in read_published(spark, path, ["N"]).collect()} == {5.0, 6.0, 7.0}
    with pytest.raises(ValueError):
        publish_forecasts(export(spark, ["R"], 7.0).drop("month"), path)


def test_bad_lines_are_returned(spark, tmp_path):
    lines = ["id,d_1,d_2,name,odd name", "1,2,3.5,a,x", "2,x,3.5,b,x", "3,,,,", "4,5,6.0", "5,6,7.0,c,x,9", "6,1,no,e,x", "seven,1,1.0,\"q, r\",x",
             "8,2147483648,1.0,d,x", "9,-4,1e3,\"q, s\",x"]
    for k in range(2):
        (tmp_path / f"part{k}.csv").write_text("\n".join(lines) + "\n")
    good, bad = read_csv_checked(spark, str(tmp_path), "id int, d_1 int, d_2 double, name string, `odd name` string")
    rows = shown(good.fillna(-1).fillna("-"))
    assert good.select("id").count() == 6 and good.count() == 6  # also where one column, or none, is asked for
    assert rows == sorted(2 * [(1, 2, 3.5, "a", "x"), (3, -1, -1.0, "-", "-"), (9, -4, 1000.0, "q, s", "x")])
    found = {r["line"]: r["reason"] for r in bad.collect()}
    assert found == {"2,x,3.5,b,x": "d_1: 'x' is no int", "4,5,6.0": "not 5 fields", "5,6,7.0,c,x,9": "not 5 fields",
                     "6,1,no,e,x": "d_2: 'no' is no double", "seven,1,1.0,\"q, r\",x": "id: 'seven' is no int",
                     "8,2147483648,1.0,d,x": "d_1: '2147483648' is no int"}
    assert bad.count() == 12 and {os.path.basename(r["file"]) for r in bad.collect()} == {"part0.csv", "part1.csv"}


@pytest.mark.parametrize("ranges, n", [(7, 600), (40, 90), (1, 50), (5, 0)])
def test_lags_over_ranges_equal_the_window(spark, ranges, n):
    rng = random.Random(4)
    rows = [("hot" if i % 10 else f"k{i % 4}", i // 3, i, rng.choice([None, 1.0, 2.5, 7.0])) for i in range(n)]
    rows += [(None, 1, -1, 3.0), (None, 2, -2, 4.0), ("hot", None, -3, 5.0)] if n else []
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, t int, id int, v double").repartition(3)
    lags = (1, 2, 12)
    want = lag_features(df, "v", ["g"], ["t", "id"], lags)
    got = lag_features_ranged(df, "v", ["g"], ["t", "id"], lags, ranges)
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_a_single_key_is_many_tasks(spark):
    df = spark.range(5000).select(F.lit("one").alias("g"), F.col("id").alias("t"), (F.col("id") * 2.0).alias("v"))
    got = lag_features_ranged(df, "v", ["g"], ["t"], (1, 30), 8)
    assert got.filter("lag_v_1 = v - 2 AND (lag_v_30 = v - 60 OR t < 30)").count() == 4999
    assert got.filter("lag_v_30 IS NULL").count() == 30
