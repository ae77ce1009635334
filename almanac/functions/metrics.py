"""MAPE (M9): scalar, grouped, and as an MLlib Evaluator."""

from __future__ import annotations

from pyspark.ml.evaluation import Evaluator
from pyspark.ml.param.shared import HasLabelCol, HasPredictionCol
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almanac.functions.scalar import ape


def mape_col(label: Column, prediction: Column) -> Column:
    """Aggregate expression ``100 * avg(|(y - p) / y|)``. Rows with y = 0 are skipped."""
    return F.avg(ape(label, prediction)) * F.lit(100.0)


def _check(df: DataFrame, *cols: str) -> None:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"unknown columns {missing!r}")


def mape_frame(df: DataFrame, label_col: str, prediction_col: str, by: list[str] | None = None,
               output_col: str = "mape") -> DataFrame:
    """MAPE as a DataFrame: one row, or one row per ``by`` group (partial aggregation first)."""
    _check(df, label_col, prediction_col, *(by or []))
    agg = mape_col(F.col(label_col), F.col(prediction_col)).alias(output_col)
    return df.groupBy(*by).agg(agg) if by else df.agg(agg)


def mape(df: DataFrame, label_col: str, prediction_col: str) -> float | None:
    """MAPE as a Python float (one aggregated row reaches the driver); None for no rows."""
    return mape_frame(df, label_col, prediction_col).first()[0]


class MAPE(Evaluator, HasLabelCol, HasPredictionCol):
    """MLlib evaluator: lower is better."""

    def __init__(self, labelCol: str = "label", predictionCol: str = "prediction"):
        super().__init__()
        self._set(labelCol=labelCol, predictionCol=predictionCol)

    def _evaluate(self, dataset: DataFrame) -> float:
        return mape(dataset, self.getLabelCol(), self.getPredictionCol())

    def isLargerBetter(self) -> bool:
        return False
