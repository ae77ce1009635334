import uuid

from almanac.plans.features import monthly_store_sales
from almanac.sources.tables import read_table, table_path
from almanac.streaming import monthly_sales_stream, start

from conftest import SF_SMALL


def test_stream_rollup_matches_batch(spark):
    su, na = read_table(spark, SF_SMALL, "supplier"), read_table(spark, SF_SMALL, "nation")
    # a file stream watches a folder or glob; here the glob matches the one lineitem file
    stream = monthly_sales_stream(spark, table_path(SF_SMALL, "lineitem*"), su, na, "R")
    name = f"rollup_{uuid.uuid4().hex[:8]}"
    q = start(stream, name, sink="memory", output_mode="update", available_now=True)
    q.awaitTermination(300)
    got = {(r.store_id, r.year, r.month): r.sales
           for r in spark.sql(f"SELECT * FROM {name}").collect()}
    li = read_table(spark, SF_SMALL, "lineitem")
    want = {(r.store_id, r.year, r.month): r.sales for r in monthly_store_sales(li, su, na, "R").collect()}
    assert got == want and len(want) > 0


def test_stream_append_emits_months_once_final(spark, tmp_path):
    """Append mode: a month is written once, after the watermark (45 days behind the newest
    month start) has passed it; later months stay in state."""
    import datetime as dt
    src = tmp_path / "lineitem"
    src.mkdir()
    schema = "l_suppkey bigint, l_quantity double, l_returnflag string, l_shipdate timestamp_ntz"
    first = [(1, 1.0, "R", dt.datetime(1996, m, d)) for m in (1, 2, 3) for d in (3, 17)]
    second = [(1, 5.0, "R", dt.datetime(1996, 6, 2)), (1, 2.0, "R", dt.datetime(1996, 3, 20))]
    spark.createDataFrame(first, schema).coalesce(1).write.parquet(str(src / "b1"))
    spark.createDataFrame(second, schema).coalesce(1).write.parquet(str(src / "b2"))
    su = spark.createDataFrame([(1, 0)], "s_suppkey bigint, s_nationkey int")
    na = spark.createDataFrame([(0, "N0")], "n_nationkey int, n_name string")
    stream = monthly_sales_stream(spark, str(src / "*"), su, na, "R", max_files_per_trigger=1)
    name = f"append_{uuid.uuid4().hex[:8]}"
    q = start(stream, name, sink="memory", output_mode="append", available_now=True)
    q.awaitTermination(300)
    got = sorted((r.month, r.sales) for r in spark.sql(f"SELECT * FROM {name}").collect())
    # January..March are final (March includes the late row of the second file); June is not
    assert got == [(1, 2.0), (2, 2.0), (3, 4.0)]
