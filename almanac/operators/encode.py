"""Feature encoding."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def nominal(col: Column, name: str, labels: int) -> Column:
    """``col`` as ``name`` with the ML attribute of a category of ``labels`` values: an assembler carries it into the
    feature vector, and tree learners then split its values into subsets instead of at a threshold."""
    if labels <= 0:
        return col.alias(name)
    return col.alias(name, metadata={"ml_attr": {"type": "nominal", "name": name, "num_vals": labels}})


def nominal_sizes(df: DataFrame, vector_col: str = "features") -> dict[str, int]:
    """Number of values of every category in an assembled vector, by name."""
    attrs = df.schema[vector_col].metadata.get("ml_attr", {}).get("attrs", {})
    return {a.get("name", str(a["idx"])): a.get("num_vals", len(a.get("vals", ()))) for a in attrs.get("nominal", ())}


def category_index(df: DataFrame, input_col: str, output_col: str | None = None,
                   fit_on: DataFrame | None = None) -> DataFrame:
    """Index a string column, most frequent label first (ties alphabetical); result double, marked as a category
    (see :func:`nominal`) of as many values as there are labels.

    The labels are counted in one aggregate, sorted on the executors and joined back; no label list
    reaches the driver. Null labels and labels unseen in ``fit_on`` get a null index. ``df`` is read
    twice (counts, join): give a checkpointed frame where it stands on a large scan.
    """
    output_col = output_col or f"{input_col}_index"
    index = label_index(fit_on if fit_on is not None else df, input_col, output_col)
    # of a checkpointed frame: one number reaches the driver
    return df.join(index, input_col, "left").select(*df.columns, nominal(F.col(output_col), output_col, index.count()))


def label_index(src: DataFrame, input_col: str, output_col: str) -> DataFrame:
    """``input_col, output_col``: rank of each non-null label by (count desc, label asc), 0-based.

    The label counts are sorted globally (range partitioning), each row is tagged with its
    partition and position, and the frame is checkpointed so the tags are fixed. Per-partition
    sizes (one row per partition) give each partition's offset; index = offset + position.
    """
    from almanac.session import cut_lineage  # local import: session depends on nothing here
    counts = (src.filter(F.col(input_col).isNotNull())
              .groupBy(input_col).agg(F.count(F.lit(1)).alias("_n")))
    ranked = counts.orderBy(F.desc("_n"), F.asc(input_col))
    tagged = cut_lineage(ranked.select(
        input_col, F.spark_partition_id().alias("_p"),
        (F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("long"), 33)).alias("_pos")))
    sizes = tagged.groupBy("_p").agg(F.count(F.lit(1)).alias("_size"))
    # one row per partition: a global window over them is bounded by the partition count
    offsets = sizes.select("_p", (F.sum("_size").over(Window.orderBy("_p")) - F.col("_size")).alias("_off"))
    return (tagged.join(F.broadcast(offsets), "_p")
            .select(input_col, (F.col("_off") + F.col("_pos")).cast("double").alias(output_col)))


def assemble(df: DataFrame, cols: list[str], output_col: str = "features",
             handle_invalid: str = "error") -> DataFrame:
    """ML vector of ``cols`` (for MLlib learners). Nulls raise unless ``handle_invalid='skip'``."""
    return VectorAssembler(inputCols=cols, outputCol=output_col,
                           handleInvalid=handle_invalid).transform(df)


def feature_array(df: DataFrame, cols: list[str], output_col: str = "features") -> DataFrame:
    """Same features as an ``array<double>`` column, built JVM-side (no vector type)."""
    return df.withColumn(output_col, F.array(*[F.col(c).cast("double") for c in cols]))


def vector_as_array(df: DataFrame, col: str, output_col: str | None = None) -> DataFrame:
    """Dense ``array<double>`` from an ML vector; sparse vectors keep their zeros."""
    return df.withColumn(output_col or col, vector_to_array(F.col(col)))
