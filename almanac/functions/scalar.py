"""Column functions (C1-C4): log / antilog, month date stamp, percentage error, month index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _check_names(cols) -> list[str]:
    cols = list(cols)
    if not cols or any(not c for c in cols):
        raise ValueError(f"column names must be non-empty, got {cols!r}")
    return cols


def _apply(df: DataFrame, fn, input_cols, output_cols) -> DataFrame:
    input_cols = _check_names(input_cols)
    output_cols = input_cols if output_cols is None else _check_names(output_cols)
    if len(output_cols) != len(input_cols):
        raise ValueError("input_cols and output_cols differ in length")
    missing = [c for c in input_cols if c not in df.columns]
    if missing:
        raise ValueError(f"unknown columns {missing!r}")
    return df.withColumns({o: fn(F.col(i)) for i, o in zip(input_cols, output_cols)})


def log_cols(df: DataFrame, input_cols, output_cols=None) -> DataFrame:
    """Natural log, in place unless ``output_cols`` is given. ``ln`` of 0 or a negative is null."""
    return _apply(df, F.ln, input_cols, output_cols)


def antilog_cols(df: DataFrame, input_cols, output_cols=None) -> DataFrame:
    """``exp``, in place unless ``output_cols`` is given."""
    return _apply(df, F.exp, input_cols, output_cols)


def month_start(year: Column, month: Column) -> Column:
    """First day of the month as a date; null when the month is not 1..12 or a part is null.

    ``make_date`` raises on month 0 under ANSI mode, so it only runs inside the guard.
    """
    ok = month.between(1, 12) & year.isNotNull()
    return F.when(ok, F.make_date(year, month, F.lit(1)))


def date_stamp(df: DataFrame, input_cols=("year", "month"), output_col: str = "ds") -> DataFrame:
    year_col, month_col = _check_names(input_cols)
    return df.withColumn(output_col, month_start(F.col(year_col), F.col(month_col)))


def month_index(year: Column, month: Column, base_year: int) -> Column:
    """Months since January of ``base_year`` as a double (the trend time axis)."""
    return ((year - F.lit(base_year)) * 12 + month - 1).cast("double")


def ape(label: Column, prediction: Column) -> Column:
    """Absolute percentage error ``|(y - p) / y|``; null where ``y`` is 0 (no ANSI error)."""
    return F.abs(F.try_divide(label - prediction, label))
