"""CSV scan (header line + schema)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None,
             header: bool = True) -> DataFrame:
    """Read a header CSV.

    Give ``schema`` for production reads: inference costs a full extra pass over the
    files, which at scale is a whole job per table. Without it types are inferred,
    matching the behaviour of a plain ``inferSchema`` read.
    """
    reader = spark.read.option("header", str(header).lower())
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", "true")
    return reader.csv(path)


def read_csv_checked(spark: SparkSession, path: str, schema: StructType | str, header: bool = True) -> tuple[DataFrame, DataFrame]:
    """``(rows, rejected)`` of a typed CSV: rows that fit the schema, and ``file, line, reason`` of those that do not.

    A field that is no value of its type, or a line with another number of fields, rejects its line as a whole
    instead of becoming a silent null; an empty field is a null and no fault. Both frames are lazy scans of the files.
    """
    wanted = spark.createDataFrame([], schema).schema
    kept = StructType([*wanted.fields, StructField("_line", StringType())])
    scan = spark.read.schema(kept).option("header", str(header).lower()).option("mode", "PERMISSIVE").option(
        "columnNameOfCorruptRecord", "_line").csv(path)
    # true of every row, and needs every column: a scan that reads fewer would not see the faults in the others
    scan = scan.filter(F.concat_ws("", *[F.col(f"`{c}`").cast("string") for c in wanted.names]) >= "")
    good = scan.filter("_line IS NULL").select(*[F.col(f"`{c}`") for c in wanted.names])
    said = [F.when(F.col(f"`{f.name}`").isNull() & (F.col("_texts")[f.name] != ""),
                   F.concat(F.lit(f"{f.name}: '"), F.col("_texts")[f.name], F.lit(f"' is no {f.dataType.simpleString()}"))) for f in wanted]
    bad = scan.withColumn("_file", F.col("_metadata.file_path")).filter("_line IS NOT NULL").withColumn(
        "_texts", F.from_csv("_line", ", ".join(f"`{c}` STRING" for c in wanted.names)))
    faults = F.concat_ws("; ", *said)
    rejected = bad.select(F.col("_file").alias("file"), F.col("_line").alias("line"),
                          F.when(faults == "", F.lit(f"not {len(wanted)} fields")).otherwise(faults).alias("reason"))
    return good, rejected
