"""Row filters, month splits and the split label (F1-F8)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TRAIN, VALIDATION, TEST = 0, 1, 2


def filter_rows(df: DataFrame, cond: str | Column) -> DataFrame:
    """Keep rows matching a SQL predicate string or boolean Column.

    Analysis is eager, so an unknown column raises here, not at the first action."""
    return df.filter(cond)


def lag_complete(df: DataFrame, lag_col: str) -> DataFrame:
    """Drop rows whose longest lag is still null (the start of each series)."""
    return df.filter(F.col(lag_col).isNotNull())


def _ym(df: DataFrame, year_col: str, month_col: str) -> tuple[Column, Column]:
    return df[year_col], df[month_col]


def before_month(df: DataFrame, year: int, month: int, year_col: str = "year",
                 month_col: str = "month") -> Column:
    """``year < Y or (year = Y and month <= M)``: inclusive of the split month."""
    y, m = _ym(df, year_col, month_col)
    return (y < year) | ((y == year) & (m <= month))


def after_month(df: DataFrame, year: int, month: int, year_col: str = "year",
                month_col: str = "month") -> Column:
    y, m = _ym(df, year_col, month_col)
    return (y > year) | ((y == year) & (m > month))


def month_split(df: DataFrame, ym: dict, side: str = "before", year_col: str = "year",
                month_col: str = "month") -> DataFrame:
    """One side of a month split. Rows with a null year or month belong to neither side."""
    year, month = int(ym["year"]), int(ym["month"])
    if side == "before":
        return df.filter(before_month(df, year, month, year_col, month_col))
    if side == "after":
        return df.filter(after_month(df, year, month, year_col, month_col))
    raise ValueError(f"side must be 'before' or 'after', got {side!r}")


def split_on_month(df: DataFrame, ym: dict, year_col: str = "year",
                   month_col: str = "month") -> tuple[DataFrame, DataFrame]:
    """Both sides of :func:`month_split` (two filters over one plan; nothing is cached)."""
    return (month_split(df, ym, "before", year_col, month_col),
            month_split(df, ym, "after", year_col, month_col))


def split_label(df: DataFrame, train_before: dict, test_after: dict,
                output_col: str = "train_test_val_indicator", year_col: str = "year",
                month_col: str = "month") -> DataFrame:
    """0 strictly before ``train_before``, 2 strictly after ``test_after``, else 1.

    Unlike :func:`month_split` both comparisons are strict; a null year or month lands in 1.
    """
    if not output_col:
        raise ValueError("output_col must be a non-empty column name")
    y, m = _ym(df, year_col, month_col)
    ty, tm = int(train_before["year"]), int(train_before["month"])
    sy, sm = int(test_after["year"]), int(test_after["month"])
    is_train = (y < ty) | ((y == ty) & (m < tm))
    is_test = (y > sy) | ((y == sy) & (m > sm))
    label = F.when(is_train, F.lit(TRAIN)).when(is_test, F.lit(TEST)).otherwise(F.lit(VALIDATION))
    return df.withColumn(output_col, label.cast("int"))


def fill_missing(df: DataFrame, value=0, subset: list[str] | None = None) -> DataFrame:
    """Replace null (and NaN in floating columns) with ``value`` in ``subset`` (default: all
    columns of a matching type; strings are left alone for a numeric value)."""
    return df.fillna(value, subset=subset) if subset else df.fillna(value)


def drop_vectors(df: DataFrame) -> DataFrame:
    """Remove ML vector columns, e.g. before handing rows to pandas."""
    return df.drop(*[c for c, t in df.dtypes if t == "vector"])
