"""End-to-end forecasting run: features -> fit every model -> score -> losses -> select -> export.

The monthly feature frame is the only input every model reads. It is small (one row per
store and month) but sits on top of a full line-item scan, so it is checkpointed once into
the session's checkpoint folder: models and scoring reuse it, and a lost executor never
forces the large scan again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.operators.filters import month_split
from almanac.plans import group_model, scorers, selection, trees
from almanac.plans.features import load_monthly_features
from almanac.plans.tuning import candidate_grid
from almanac.session import cut_lineage, side_by_side
from almanac.sources.config import RunConfig
from almanac.sources.sinks import write_forecasts

# Models whose predictions SQL can reproduce (used by the oracle-checked selection queries).
SQL_MODELS = ("TS", "LAST_MONTH", "LAST_YEAR")
ALL_MODELS = ("RF", "GBT", "TS", "FOURIER")


def naive_scorer(name: str, lag_col: str):
    """Baseline forecaster: the lagged actual value (last month / same month last year)."""
    return name, scorers.Lagged(name, lag_col)


def fit_group_scorer(features: DataFrame, cfg: RunConfig, name: str = "TS"):
    keys = list(cfg.keys)
    # fitted once: one row per group is written, and every scoring reads it
    model = cut_lineage(group_model.fit_group_model(features, group_model.tuned_winners(features, cfg, keys), keys, cfg))
    return name, scorers.TrendAndMonths(name, model, cfg)


def fit_fourier_scorer(features: DataFrame, cfg: RunConfig, name: str = "FOURIER"):
    """Piecewise trend with sparse changes and Fourier terms: one row of coefficients per group, joined onto any
    rows to score them."""
    from almanac.plans.sparse_trend import fit_sparse
    return name, scorers.PiecewiseFourier(name, cut_lineage(fit_sparse(features, cfg)), cfg)


def fit_tree_scorer(frame: DataFrame, kind: str, cfg: RunConfig):
    model, _, _ = trees.tune_tree(frame, kind, cfg)
    return kind, scorers.Forest(kind, model)


def fit_boost_scorer(frame: DataFrame, cfg: RunConfig, name: str = "BOOST"):
    """Second-order boosting on the plain feature columns; a missing feature has a side of its own, so every row
    gets a forecast."""
    from almanac.plans.boosting import BoostParams, tune_boosted
    candidates = candidate_grid(cfg.hp_space_boost, cfg.max_evals, "random", cfg.seed)
    model, _, _ = tune_boosted(frame, trees.feature_cols(cfg), [*cfg.keys, "year", "month"], candidates,
                               BoostParams(seed=cfg.seed))
    return name, scorers.Boosted(name, model)


def fit_all(frame: DataFrame, models=ALL_MODELS, cfg: RunConfig = RunConfig(),
            concurrent: bool = True, cutoff: dict | None = None) -> list[tuple[str, object]]:
    """Fit every requested model (M7); each fit submits its own Spark jobs, run side by side. The jobs of a model,
    those of its tuning threads included, are in a scheduler pool named ``fit-<model>``: under
    ``spark.scheduler.mode=FAIR`` a learner of many small jobs does not wait behind one of long stages.

    Learners only ever fit on labels 0-1. ``cutoff={"year": y, "month": m}`` additionally
    hides every row after that month from fitting (the scorers still apply to all rows)."""
    if cutoff is not None:
        frame = month_split(frame, cutoff, "before")
    def fit(name):
        if name in trees.ESTIMATORS:
            return fit_tree_scorer(frame, name, cfg)
        if name == "BOOST":
            return fit_boost_scorer(frame, cfg)
        if name == "TS":
            return fit_group_scorer(frame, cfg)
        if name == "FOURIER":
            return fit_fourier_scorer(frame, cfg)
        if name == "LAST_MONTH":
            return naive_scorer(name, "lag_sales_1")
        if name == "LAST_YEAR":
            if 12 not in cfg.lags:
                raise ValueError("LAST_YEAR needs lag 12 among the configured lags")
            return naive_scorer(name, "lag_sales_12")
        raise ValueError(f"unknown model {name!r}")

    if not concurrent:
        return [fit(m) for m in models]
    context = frame.sparkSession.sparkContext

    def in_pool(name):
        context.setLocalProperty("spark.scheduler.pool", f"fit-{name}")
        return fit(name)

    return side_by_side(frame.sparkSession, in_pool, list(models), len(models))


def needs_vectors(models) -> bool:
    return any(m in trees.ESTIMATORS or m == "BOOST" for m in models)


def prepare(spark: SparkSession, sf_dir: str, cfg: RunConfig = RunConfig(),
            checkpoint: bool = True, vectors: bool = True) -> DataFrame:
    """Monthly feature frame of the tables, see :func:`prepare_features`."""
    return prepare_features(load_monthly_features(spark, sf_dir, cfg), cfg, checkpoint, vectors)


def prepare_features(features: DataFrame, cfg: RunConfig = RunConfig(), checkpoint: bool = True,
                     vectors: bool = True) -> DataFrame:
    """A monthly feature frame (of any source), lineage cut if asked; with ``vectors`` also the key
    indexes and feature vector the tree learners need (SQL-form models do without)."""
    if checkpoint:
        features = cut_lineage(features)
    return trees.model_frame(features, cfg) if vectors else features


def run(spark: SparkSession, sf_dir: str | None, cfg: RunConfig = RunConfig(), models=ALL_MODELS,
        select_on: str = "test", out_path: str | None = None, fmt: str = "csv",
        features: DataFrame | None = None, allow_unscored: bool = False) -> dict:
    """Fit, score, select and export. ``features`` (see ``features.load_wide_features``) replaces the
    tables in ``sf_dir``. A winner that leaves test rows without a forecast raises unless
    ``allow_unscored``; such rows are then exported with a null forecast."""
    frame = prepare(spark, sf_dir, cfg, vectors=needs_vectors(models)) if features is None else \
        prepare_features(features, cfg, vectors=needs_vectors(models))
    fitted = fit_all(frame, models, cfg)
    names = [n for n, _ in fitted]
    # one materialisation of every prediction: the loss table, the winner, the export and the
    # report all read it, so no model (e.g. the grouped-map fit) runs more than once
    scored = cut_lineage(selection.score_all(frame, fitted))
    keys = [*cfg.keys, "year", "month"]
    losses = cut_lineage(selection.model_losses(scored, names))
    best = selection.best_model(losses, select_on)
    winner = best.first().model_name  # one aggregated row; raises on an empty slice
    open_rows = losses.filter((F.col("model_name") == winner) & (F.col("split") == "test")).first()
    if open_rows is not None and open_rows.unscored_rows and not allow_unscored:
        raise ValueError(f"{winner} leaves {open_rows.unscored_rows} test rows without a forecast")
    export = selection.forecast_export(selection.best_predictions(scored, names, best, keys), keys)
    result = {"losses": losses, "best": best, "forecasts": export, "scored": scored,
              "selected_on": select_on,
              # rows a model could not score (null prediction), per model: lazy, for reporting
              "unscored": selection.unscored(scored, names, cfg.keys)}
    if out_path:
        out = export.withColumnRenamed("prediction", f"{winner}_prediction").drop("model_name")
        write_forecasts(out, f"{out_path}/{winner}_{cfg.dept}_forecasts", fmt)
    return result
