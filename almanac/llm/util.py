"""Helpers shared by the training-data operators: tables, shared folders, safe column names."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

from almanac.session import ensure_checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one whole input table through Spark (any store Spark can open)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_folder(spark: SparkSession, what: str) -> str:
    """A new folder name under the shared checkpoint folder the session names."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/almanac-{what}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, what: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Cuts lineage like a reliable checkpoint, but compressed and column-pruned on reread. Spark's
    commit protocol keeps only files of committed task attempts, so lost executors are harmless.
    """
    spark = df.sparkSession
    path = shared_folder(spark, what)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def slices(batch, max_bytes: int = 4 << 20) -> Iterator:
    """An Arrow batch in slices of a few MB (at least one row), so that what a task makes of it stays small."""
    rows = max(1, int(batch.num_rows * max_bytes / max(batch.nbytes, 1)))
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


#: Rows of text an Arrow batch should hold; Spark's own default is meant for narrow rows.
BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batches from Spark's default to ``BATCH_ROWS``; a value set by the cluster stays.

    A batch is held off the heap by the JVM and again by the Python worker, for every running task.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, str(BATCH_ROWS))
