import pytest

from almanac.functions import MAPE, mape, mape_frame


ROWS = [(4.0, 5.0), (-8.0, -6.0), (0.5, 0.0), (10.0, 10.0)]


def test_mape(spark):
    df = spark.createDataFrame(ROWS, "y double, p double")
    want = 100 * sum(abs((y - p) / y) for y, p in ROWS) / len(ROWS)  # 25, 25, 100 and 0 percent
    assert abs(want - 37.5) < 1e-12 and abs(mape(df, "y", "p") - want) < 1e-12
    ev = MAPE(labelCol="y", predictionCol="p")
    assert abs(ev.evaluate(df) - want) < 1e-12 and ev.isLargerBetter() is False


def test_mape_missing_column(spark):
    df = spark.createDataFrame(ROWS, "y double, p double")
    with pytest.raises(ValueError):
        MAPE(labelCol="label", predictionCol="p").evaluate(df)


def test_mape_zero_label_skipped(spark):
    df = spark.createDataFrame([(0.0, 1.0), (2.0, 1.0)], "y double, p double")
    assert mape(df, "y", "p") == 50.0


def test_mape_empty_is_none(spark):
    df = spark.createDataFrame([], "y double, p double")
    assert mape(df, "y", "p") is None


def test_mape_grouped(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0), ("a", 2.0, 2.0), ("b", 4.0, 2.0)], "g string, y double, p double")
    got = {r.g: r.mape for r in mape_frame(df, "y", "p", ["g"]).collect()}
    assert got == {"a": 50.0, "b": 50.0}
