"""Wide-to-long reshape."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unpivot(df: DataFrame, ids: list[str], values: list[str] | None = None,
            var_name: str = "day", value_name: str = "sales") -> DataFrame:
    """Turn every non-id column (or ``values``) into rows ``(ids..., var_name, value_name)``.

    All value columns must share one type: Spark would silently widen int + double, so a
    mixed set raises instead. Null values are kept. The values of a row are exploded from one array
    by position and named by looking the position up, so the plan stays one ``Generate`` (no
    shuffle) however many columns there are; filters on id columns reach the scan.
    """
    ids = list(ids)
    bad = [c for c in ids if not c or c not in df.columns]
    if bad:
        raise ValueError(f"unknown id columns: {bad!r}")
    values = [c for c in df.columns if c not in ids] if values is None else list(values)
    if not values:
        raise ValueError("nothing to unpivot")
    types = {t for c, t in df.dtypes if c in values}
    if len(types) != 1:
        raise TypeError(f"all unpivoted columns must have one type, found {sorted(types)}")
    names = F.array(*[F.lit(c) for c in values])
    long = df.select(*ids, F.posexplode(F.array(*[F.col(f"`{c}`") for c in values])).alias("_pos", value_name))
    return long.select(*ids, F.element_at(names, F.col("_pos") + 1).alias(var_name), value_name)
