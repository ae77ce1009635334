"""Spark session defaults and checkpoint handling.

Cluster runs keep whatever the submitter configured; ``get_session`` only fills in
settings that are missing, so a shared ``spark.checkpoint.dir`` set by the cluster
is always respected.
"""

from __future__ import annotations

import tempfile
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import SparkConf
from pyspark.sql import DataFrame, SparkSession
from pyspark.util import inheritable_thread_target

# SQL defaults that hold from local[8] up to a large cluster: AQE re-plans joins from runtime
# sizes, coalesces small shuffle partitions and splits skewed ones. Applied only where the
# submitter (spark-submit --conf, spark-defaults.conf, the builder) did not set a value.
_SQL_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}
# Static settings for sessions this module launches: no web UI, no console progress bars.
_STATIC = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "almanac", driver_memory: str | None = None) -> SparkSession:
    """Get or create the session, then fill in missing SQL defaults.

    ``master``, ``shuffle_partitions`` and ``driver_memory`` are for local runs and tests;
    ``driver_memory`` only takes effect when this call launches the JVM (local mode: the driver
    heap is the whole cluster's memory). Values the cluster configured are never overridden.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if driver_memory:
        builder = builder.config("spark.driver.memory", driver_memory)
    for key, value in _STATIC.items():
        builder = builder.config(key, value)
    if SparkConf().get("spark.scheduler.mode", None) is None:
        builder = builder.config("spark.scheduler.mode", "FAIR")  # learners that are fitted side by side share the cores
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    configured = spark.sparkContext.getConf()
    for key, value in _SQL_DEFAULTS.items():
        if not configured.contains(key):
            spark.conf.set(key, value)
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder named by the session.

    A cluster names a shared folder in ``spark.checkpoint.dir``; it is used as is. Only a local
    master (unit tests, a laptop) may go without: it gets a private folder. On a cluster such a
    folder would lie on each executor's own disk, so a missing setting raises.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(configured)
        return spark.sparkContext.getCheckpointDir() or configured
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError(f"set spark.checkpoint.dir to a shared folder (master is {master})")
    local = tempfile.mkdtemp(prefix="almanac-ckpt-")
    spark.conf.set("spark.checkpoint.dir", local)
    spark.sparkContext.setCheckpointDir(local)
    return local


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def side_by_side(spark: SparkSession, fn: Callable, items: list, parallelism: int) -> list:
    """``[fn(x) for x in items]`` with up to ``parallelism`` calls at a time, each in a thread that submits its own
    Spark jobs. Every call starts with a copy of the caller's local properties (its scheduler pool, say) of its own."""
    with ThreadPoolExecutor(max_workers=max(1, min(parallelism, len(items)))) as pool:
        # wrapped once per call: the copy is made when a function is wrapped
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(fn), x) for x in items]]
