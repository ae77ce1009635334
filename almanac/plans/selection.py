"""Multi-model fit, scoring, loss table, best-model selection and forecast export
(M7, M8, P1, P2, P3).

Every model adds one ``{name}_prediction`` column to the same rows, so scoring all models
is a chain of column additions, not a join per model. Losses for every (model, split) come
from ONE aggregation over an exploded (model, prediction) view; the winner is
``min(struct(loss, position))`` — the first model wins a tie.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almanac.functions.metrics import mape_col
from almanac.functions.scalar import antilog_cols

LABEL = "train_test_val_indicator"
PLACES = 8

# split name -> label values it covers ("train" is everything before the test period)
SPLITS = {"train": (0, 1), "validation": (1,), "test": (2,)}

Scorer = Callable[[DataFrame], DataFrame]


def score_all(df: DataFrame, scorers: list[tuple[str, Scorer]]) -> DataFrame:
    """Apply each scorer in turn; scorer ``name`` must add ``{name}_prediction``."""
    for name, scorer in scorers:
        df = scorer(df)
        if f"{name}_prediction" not in df.columns:
            raise ValueError(f"scorer {name!r} did not add {name}_prediction")
    return df


def _long(scored: DataFrame, names: list[str], keep: list[str]) -> DataFrame:
    """One row per (row, model): ``keep..., position, model_name, prediction``."""
    per_model = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(n).alias("model_name"),
                                   F.col(f"{n}_prediction").cast("double").alias("prediction"))
                          for i, n in enumerate(names)])
    return scored.select(*keep, F.explode(per_model).alias("m")).select(*keep, "m.*")


def _split_col() -> F.Column:
    ind = F.col(LABEL)
    names = list(SPLITS)
    arr = [F.when(ind.isin(*SPLITS[s]), F.lit(s)) for s in names]
    return F.explode(F.filter(F.array(*arr), lambda x: x.isNotNull())).alias("split")


def unscored(scored: DataFrame, names: list[str], keys: list[str] = ("store_id",)) -> DataFrame:
    """``model_name, keys..., rows``: rows each model left without a prediction (a group with
    no training rows, a row with an incomplete feature vector), counted per group."""
    keys = list(keys)
    long = _long(scored, names, keys)
    return (long.filter(F.col("prediction").isNull())
            .groupBy("model_name", *keys).agg(F.count(F.lit(1)).alias("rows")))


def model_losses(scored: DataFrame, names: list[str], label_col: str = "sales",
                 by: list[str] = ()) -> DataFrame:
    """``model_name, position, split, [by...], loss, scored_rows, unscored_rows``: MAPE per model on train
    (labels 0-1), validation (1) and test (2), optionally per group ``by``, from one aggregate.

    All models are compared on the rows that every model scored; ``scored_rows`` and ``unscored_rows``
    count the rows of the split with and without a prediction of the model.
    """
    by = list(by)
    common = F.lit(True)
    for n in names:
        common = common & F.col(f"{n}_prediction").isNotNull()
    long = _long(scored.withColumn("_common", common), names, [label_col, LABEL, "_common"] + by)
    known = F.when(F.col("_common"), F.col("prediction"))
    return (long.select("*", _split_col())
            .groupBy("model_name", "position", "split", *by)
            .agg(F.round(mape_col(F.col(label_col), known), PLACES).alias("loss"),
                 F.count("prediction").alias("scored_rows"),
                 F.count(F.when(F.col("prediction").isNull(), 1)).alias("unscored_rows")))


def best_model(losses: DataFrame, split: str = "test") -> DataFrame:
    """One row ``model_name, position, loss``: fewest unscored rows first, then lowest loss on ``split``;
    the first model wins ties. An empty slice, or one without a comparable row, raises when evaluated.

    ``split='test'`` is the surveyed rule (optimistic: the test slice also picks the
    model); ``split='validation'`` selects on validation and leaves the test slice unseen.
    """
    w = F.min(F.struct(F.col("unscored_rows"), F.col("loss").isNull().alias("missing"), "loss", "position",
                       "model_name")).alias("w")
    message = F.lit(f"no row of the {split} slice was scored by every model")
    picked = losses.filter(F.col("split") == split).agg(w)
    name = F.when(F.col("w").isNull() | F.col("w.missing"), F.raise_error(message).cast("string")).otherwise(
        F.col("w.model_name"))
    return picked.select(name.alias("model_name"), "w.position", "w.loss")


def best_predictions(scored: DataFrame, names: list[str], best: DataFrame,
                     keys: list[str] = ("store_id", "year", "month"), label_col: str = "sales") -> DataFrame:
    """Rows with the winning model's prediction: ``keys, label, sales, model_name, prediction``.

    ``best`` is a global aggregate, exactly one row, so broadcasting it is bounded by construction.
    """
    long = _long(scored, names, list(keys) + [LABEL, label_col])
    return (long.join(F.broadcast(best.select("model_name")), "model_name")
            .select(*keys, LABEL, label_col, "model_name", "prediction"))


def forecast_export(best_preds: DataFrame, keys: list[str] = ("store_id", "year", "month"),
                    label_col: str = "sales") -> DataFrame:
    """Test-period rows, label and prediction back on the unit scale (``exp``), ordered by key."""
    out = best_preds.filter(F.col(LABEL) == 2).select(*keys, label_col, "model_name", "prediction")
    out = antilog_cols(out, [label_col, "prediction"])
    return out.orderBy(*keys)
