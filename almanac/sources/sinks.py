"""Forecast sink: written by the executors, never collected to the driver."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def write_forecasts(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                    partition_by: list[str] | None = None) -> None:
    """Write a forecast frame (one file per task; ordered frames keep their range order).

    ``fmt='csv'`` writes a header CSV (one file per task); parquet is the default.
    """
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer.option("header", "true").csv(path)
    else:
        writer.format(fmt).save(path)


# ------------------------------------------------------------------------------ published exports

MANIFEST = "_manifests"


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path


def _read_text(fs, at) -> str:
    stream = fs.open(at)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def latest_manifest(spark: SparkSession, path: str) -> dict | None:
    """The published state of ``path``: its number, the frame's schema and every part's folder."""
    fs, Path = _fs(spark, path)
    folder = Path(f"{path}/{MANIFEST}")
    if not fs.exists(folder):
        return None
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    numbers = [int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit()]
    return json.loads(_read_text(fs, Path(f"{path}/{MANIFEST}/{max(numbers)}.json"))) if numbers else None


def publish_forecasts(df: DataFrame, path: str, part_col: str = "dept_id", fmt: str = "parquet") -> dict:
    """Publish the parts (departments) of ``df`` under ``path`` and return the new manifest.

    The rows go to a new folder, partitioned by ``part_col``; a manifest that names the folder of every part is
    written last, under the next number, by a rename. Readers follow the latest manifest, so they see all of an export
    or none of it, a rerun of one part replaces that part alone, and a run that dies leaves only files that no
    manifest names. Of two runs that end at once one fails to take the number and raises; run it again.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    folder = f"data/{uuid.uuid4().hex}"
    writer = df.write.partitionBy(part_col)
    (writer.option("header", "true").csv if fmt == "csv" else writer.format(fmt).save)(f"{path}/{folder}")
    fs, Path = _fs(spark, path)
    found = [s.getPath().getName() for s in fs.listStatus(Path(f"{path}/{folder}")) if s.isDirectory()]
    parts = [n for n in found if n.startswith(f"{part_col}=")]
    old = latest_manifest(spark, path)
    schema = json.loads(df.schema.json())
    if old and (old["schema"] != schema or old["part_col"] != part_col or old["format"] != fmt):
        raise ValueError("the frame does not have the columns and format of what is published here")
    new = {"number": old["number"] + 1 if old else 1, "part_col": part_col, "format": fmt, "schema": schema,
           "parts": (old["parts"] if old else {}) | {p: folder for p in parts}}
    draft, final = Path(f"{path}/{MANIFEST}/.{uuid.uuid4().hex}"), Path(f"{path}/{MANIFEST}/{new['number']}.json")
    stream = fs.create(draft)
    stream.write(bytearray(json.dumps(new).encode()))
    stream.close()
    if fs.exists(final) or not fs.rename(draft, final):
        fs.delete(draft, False)
        raise RuntimeError(f"another export took number {new['number']} of {path}")
    return new


def read_published(spark: SparkSession, path: str, parts: list | None = None) -> DataFrame:
    """The published rows, or those of some parts (values of the partition column); nothing else is scanned."""
    path, now = path.rstrip("/"), latest_manifest(spark, path.rstrip("/"))
    if now is None:
        raise FileNotFoundError(f"nothing is published under {path}")
    schema = StructType.fromJson(now["schema"])
    by_folder: dict[str, list[str]] = {}
    for part, folder in now["parts"].items():
        by_folder.setdefault(folder, []).append(part)
    out = spark.createDataFrame([], schema)
    for folder, own in sorted(by_folder.items()):  # an export each
        reader = spark.read.schema(schema).option("basePath", f"{path}/{folder}")
        if now["format"] == "csv":
            reader = reader.option("header", "true")
        out = out.unionByName(reader.format(now["format"]).load([f"{path}/{folder}/{p}" for p in own]).select(*schema.names))
    return out if parts is None else out.filter(F.col(now["part_col"]).isin(parts))
