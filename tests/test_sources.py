from almanac.sources import TABLES, read_table, read_tables, write_forecasts

from conftest import SF_SMALL


def test_read_tables_and_projection(spark):
    frames = read_tables(spark, SF_SMALL, ["nation", "region"])
    assert set(frames) == {"nation", "region"} and frames["nation"].count() == 25
    li = read_table(spark, SF_SMALL, "lineitem", ["l_orderkey", "l_quantity"])
    assert li.columns == ["l_orderkey", "l_quantity"]
    assert "lineitem" in TABLES and "events" in TABLES


def test_write_forecasts_parquet_partitioned_and_csv(spark, tmp_path):
    df = spark.createDataFrame([("A", 2001, 1, 10.0, 11.0), ("B", 2001, 2, 5.0, 4.0)],
                               "store_id string, year int, month int, sales double, TS_prediction double")
    write_forecasts(df, str(tmp_path / "pq"), "parquet", partition_by=["store_id"])
    back = spark.read.parquet(str(tmp_path / "pq"))
    assert back.count() == 2 and "store_id" in back.columns
    assert sorted(p.name for p in (tmp_path / "pq").iterdir() if p.is_dir()) == ["store_id=A", "store_id=B"]
    write_forecasts(df, str(tmp_path / "csv"), "csv")
    csv = spark.read.option("header", "true").csv(str(tmp_path / "csv"))
    assert csv.columns == df.columns and csv.count() == 2
