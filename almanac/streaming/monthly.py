"""Monthly store roll-up over a file stream of line items (Structured Streaming).

The same operator as the batch ``monthly_store_sales`` (department filter, store map join,
sum per store and month) applied incrementally as new parquet files land:

* the stream schema is taken from the existing files (no inference per micro-batch);
* the store map is the static side of a stream-static join;
* the month start is the event-time column: with a watermark, a (store, month) group is
  final once data two months later has arrived, and its state is dropped in append mode;
* progress and state live under the session's ``spark.checkpoint.dir`` (shared storage),
  so a restarted query resumes where it stopped.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from almanac.plans.features import store_map
from almanac.session import ensure_checkpoint_dir


def monthly_sales_stream(spark: SparkSession, lineitem_path: str, supplier: DataFrame,
                         nation: DataFrame, dept: str = "R", watermark: str = "45 days",
                         max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming ``(store_id, month_start, year, month, sales)``."""
    schema = spark.read.parquet(lineitem_path).schema
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    items = (reader.parquet(lineitem_path)
             .filter(F.col("l_returnflag") == F.lit(dept))
             .select("l_suppkey", "l_quantity",
                     F.date_trunc("month", F.col("l_shipdate").cast("timestamp")).alias("month_start"))
             .withWatermark("month_start", watermark))
    stores = store_map(supplier, nation)
    joined = items.join(stores, items.l_suppkey == stores.s_suppkey)
    return (joined.groupBy("store_id", "month_start")
            .agg(F.sum("l_quantity").alias("sales"))
            .select("store_id", "month_start", F.year("month_start").alias("year"),
                    F.month("month_start").alias("month"), "sales"))


def start(stream: DataFrame, name: str, sink: str = "parquet", path: str | None = None,
          output_mode: str = "append", available_now: bool = False) -> StreamingQuery:
    """Start the roll-up. The checkpoint goes under ``spark.checkpoint.dir/<name>``."""
    ckpt = os.path.join(ensure_checkpoint_dir(stream.sparkSession), "streams", name)
    writer = (stream.writeStream.queryName(name).outputMode(output_mode)
              .option("checkpointLocation", ckpt))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    if sink == "memory":
        return writer.format("memory").start()
    return writer.format(sink).option("path", path).start()
