"""Per-group trend + seasonality model (M4, M4b, M5, M6), closed form in Spark SQL operators.

For each group (store) on its monthly log series ``y`` over a month axis ``t``:

* trend: ordinary least squares ``y ~ a + b t`` (``regr_intercept`` / ``regr_slope``);
* yearly seasonality: one shrunken effect per calendar month,
  ``e_m = sum(y - (a + b t)) / (n_m + lam)`` with ``lam = 1 / seasonality_prior_scale**2``
  (a larger prior scale shrinks less, as the prior scale does for seasonal terms);
* prediction: ``a + b t + e_month`` (0 for a calendar month never seen in training).

Tuning evaluates every candidate for every group in ONE job: validation rows are expanded
by the (config-bounded) candidate list, losses are aggregated per (group, candidate), the
winner per group is ``min(struct(loss, cand_id))``. Every step is a window, aggregate or
join on the group key, so the series is shuffled once by that key and each later stage reuses
the partitioning; a group is at most one row per month, so no task holds an unbounded group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from almanac.functions.scalar import ape, month_index
from almanac.plans import parzen
from almanac.plans.tuning import _axis, candidate_grid
from almanac.session import cut_lineage
from almanac.sources.config import RunConfig

LABEL = "train_test_val_indicator"
PLACES = 8


def candidates(cfg: RunConfig = RunConfig(), method: str = "random") -> list[dict]:
    """Candidate parameter sets for the group model (additive seasonality only)."""
    grid = candidate_grid(cfg.hp_space_group, cfg.max_evals, method, cfg.seed)
    for c in grid:
        mode = c.get("seasonality_mode", "additive")
        if mode != "additive":
            raise ValueError(f"seasonality_mode {mode!r} is not supported (log-additive model)")
    return grid


def _cand_array(cands: list[dict]) -> Column:
    return F.array(*[F.struct(F.lit(i).alias("cand_id"),
                              F.lit(float(c["seasonality_prior_scale"])).alias("scale"))
                     for i, c in enumerate(cands)])


def _lam(scale: Column) -> Column:
    """Shrinkage ``1 / scale**2``; a scale of 0 gives null, i.e. no month effect at all."""
    return F.try_divide(F.lit(1.0), scale * scale)


def series(features: DataFrame, keys: list[str], cfg: RunConfig = RunConfig(),
           label_col: str = "sales") -> DataFrame:
    """``keys, year, month, y, t, ind`` projected from a monthly feature frame."""
    return features.select(*keys, "year", "month", F.col(label_col).alias("y"),
                           month_index(F.col("year"), F.col("month"), cfg.base_year).alias("t"),
                           F.col(LABEL).alias("ind"))


def fit_columns(s: DataFrame, keys: list[str], fit: Column) -> DataFrame:
    """Add the fit of each group on its ``fit`` rows as window columns:

    ``n_fit`` (fit rows in the group), ``intercept`` / ``slope`` (least squares on the fit
    rows) and, per group and calendar month, ``rsum`` (sum of trend residuals) and ``n``
    (fit rows with a value in that month; a zero-sales month has a null log and counts for nothing).

    Both windows are partitioned by the group key first, so the frame is shuffled at most
    once (not at all when it is already hash-partitioned by the key); the (key, month)
    window reuses that partitioning and only sorts.
    """
    wg = Window.partitionBy(*keys)
    wgm = Window.partitionBy(*keys, "month")
    y_fit, t_fit = F.when(fit, F.col("y")), F.when(fit, F.col("t"))
    s = s.select("*", F.count(F.when(fit, 1)).over(wg).alias("n_fit"),
                 F.regr_intercept(y_fit, t_fit).over(wg).alias("intercept"),
                 F.regr_slope(y_fit, t_fit).over(wg).alias("slope"))
    resid = F.when(fit, F.col("y") - (F.col("intercept") + F.col("slope") * F.col("t")))
    return s.select("*", F.sum(resid).over(wgm).alias("rsum"),
                    F.count(resid).over(wgm).alias("n"))


def tune_group_losses(features: DataFrame, cands: list[dict], keys: list[str] = ("store_id",),
                      cfg: RunConfig = RunConfig()) -> DataFrame:
    """``keys, cand_id, seasonality_prior_scale, loss``: validation MAPE (log scale, rounded to
    8 places before any ranking) of every candidate fitted on the training rows of every
    group. Groups without training rows get no loss row."""
    keys = list(keys)
    s = fit_columns(series(features, keys, cfg), keys, F.col("ind") == 0)
    v = (s.filter((F.col("ind") == 1) & (F.col("n_fit") > 0))
         .select(*keys, "y", "t", "intercept", "slope", "rsum", "n",
                 F.explode(_cand_array(cands)).alias("c")))
    pred = (F.col("intercept") + F.col("slope") * F.col("t")
            + F.coalesce(F.col("rsum") / (F.col("n") + _lam(F.col("c.scale"))), F.lit(0.0)))
    return (v.groupBy(*keys, F.col("c.cand_id").alias("cand_id"),
                      F.col("c.scale").alias("seasonality_prior_scale"))
            .agg(F.round(F.avg(ape(F.col("y"), pred)) * 100.0, PLACES).alias("loss")))


def tune_group_search(features: DataFrame, cfg: RunConfig = RunConfig(), keys: list[str] = ("store_id",), trials: int | None = None,
                      batch: int | None = None, draws: int = 24, path: str | None = None) -> DataFrame:
    """``keys, trial, loss, at``: every group searches its own prior scale, round by round.

    A round proposes a batch of candidates for each group from that group's losses so far (see
    :mod:`almanac.plans.parzen`) and scores all of them in one job. With ``path`` every whole round is kept there
    and a tuning that was stopped goes on after the last one. ``at`` holds places on the axes of
    ``cfg.hp_space_group``; a group without training rows has null losses.
    """
    keys = list(keys)
    s = fit_columns(series(features, keys, cfg), keys, F.col("ind") == 0)
    valid = cut_lineage(s.filter((F.col("ind") == 1) & (F.col("n_fit") > 0)).select(
        *keys, "y", "t", "intercept", "slope", "rsum", "n"))

    def evaluate(asked: DataFrame) -> DataFrame:
        v = valid.join(asked.select(*keys, "trial", search_scale(cfg).alias("scale")), keys)
        pred = (F.col("intercept") + F.col("slope") * F.col("t")
                + F.coalesce(F.col("rsum") / (F.col("n") + _lam(F.col("scale"))), F.lit(0.0)))
        return v.groupBy(*keys, "trial").agg(F.round(F.avg(ape(F.col("y"), pred)) * 100.0, PLACES).alias("loss"))

    return parzen.search(features, cfg.hp_space_group, evaluate, keys, trials or cfg.max_evals, batch or cfg.search_batch, cfg.seed,
                         draws=draws, path=path)


def search_scale(cfg: RunConfig = RunConfig()) -> Column:
    """The prior scale of a searched candidate, from its places ``at``."""
    names = list(cfg.hp_space_group)
    scales = F.array(*[F.lit(float(v)) for v in _axis(cfg.hp_space_group["seasonality_prior_scale"])])
    return F.element_at(scales, F.element_at("at", names.index("seasonality_prior_scale") + 1) + 1)


def search_winners(table: DataFrame, keys: list[str] = ("store_id",), cfg: RunConfig = RunConfig()) -> DataFrame:
    """``keys, cand_id, seasonality_prior_scale, loss``: every group's best trial, as :func:`group_argmin` has it."""
    best = parzen.best_so_far(table, list(keys))
    return best.select(*keys, F.col("trial").alias("cand_id"), search_scale(cfg).alias("seasonality_prior_scale"), "loss")


def tune_mean_loss(losses: DataFrame) -> DataFrame:
    """Tuning objective per candidate: mean of the per-group losses."""
    return (losses.groupBy("cand_id", "seasonality_prior_scale")
            .agg(F.avg("loss").alias("mean_loss")))


def group_argmin(losses: DataFrame, keys: list[str] = ("store_id",)) -> DataFrame:
    """Lowest loss per group; ties go to the lowest ``cand_id``; null losses rank last."""
    keys = list(keys)
    best = F.min(F.struct(F.col("loss").isNull().alias("missing"), "loss", "cand_id",
                          "seasonality_prior_scale")).alias("w")
    return losses.groupBy(*keys).agg(best).select(*keys, "w.cand_id", "w.seasonality_prior_scale", "w.loss")


def fit_group_model(features: DataFrame, winners: DataFrame, keys: list[str] = ("store_id",),
                    cfg: RunConfig = RunConfig(), max_label: int = 1) -> DataFrame:
    """Refit each group on rows with label <= ``max_label`` with its winning parameters.

    The model is data, one row per group: ``keys, cand_id, seasonality_prior_scale,
    intercept, slope, effects`` where ``effects[m-1]`` is the effect of calendar month m
    (null for a month the group never had). A group without a winner keeps its trend and
    gets no month effects.
    """
    keys = list(keys)
    s = fit_columns(series(features, keys, cfg), keys, F.col("ind") <= max_label)
    s = s.filter(F.col("ind") <= max_label).join(
        winners.select(*keys, "cand_id", "seasonality_prior_scale"), keys, "left")
    effect = F.col("rsum") / (F.col("n") + _lam(F.col("seasonality_prior_scale")))
    return (s.groupBy(*keys)
            .agg(F.max("cand_id").alias("cand_id"),
                 F.max("seasonality_prior_scale").alias("seasonality_prior_scale"),
                 F.max("intercept").alias("intercept"), F.max("slope").alias("slope"),
                 F.array(*[F.max(F.when(F.col("month") == m, effect)) for m in range(1, 13)]).alias("effects")))


def model_effects(model: DataFrame, keys: list[str] = ("store_id",), keep: list[str] = ()) -> DataFrame:
    """Long form of the month effects: ``keys, keep, month, effect`` for the months a group has."""
    cols = [*keys, *keep]
    return (model.select(*cols, F.posexplode("effects").alias("pos", "effect"))
            .filter(F.col("effect").isNotNull())
            .select(*cols, (F.col("pos") + 1).alias("month"), "effect"))


def group_forecast(features: DataFrame, model: DataFrame, keys: list[str] = ("store_id",),
                   prediction_col: str = "TS_prediction", cfg: RunConfig = RunConfig()) -> DataFrame:
    """Add ``prediction_col`` to every feature row (null where the group has no model).

    One left join on the group key against a one-row-per-group model: rows are neither
    dropped nor duplicated, and both sides share the key partitioning.
    """
    keys = list(keys)
    t = month_index(F.col("year"), F.col("month"), cfg.base_year)
    out = features.join(model.select(*keys, F.col("intercept").alias("_a"), F.col("slope").alias("_b"),
                                     F.col("effects").alias("_e")), keys, "left")
    # the month effect only for a valid calendar month (element_at errors on index 0)
    effect = F.when(F.col("month").between(1, 12), F.element_at("_e", F.col("month")))
    pred = F.col("_a") + F.col("_b") * t + F.coalesce(effect, F.lit(0.0))
    return out.withColumn(prediction_col, pred).drop("_a", "_b", "_e")


def tuned_winners(features: DataFrame, cfg: RunConfig = RunConfig(), keys=("store_id",)) -> DataFrame:
    """Every group's parameters by the search that ``cfg.search`` names."""
    if cfg.search == "parzen":
        candidates(cfg)  # the space must be the model's own
        return search_winners(tune_group_search(features, cfg, keys), keys, cfg)
    return group_argmin(tune_group_losses(features, candidates(cfg), keys, cfg), keys)


def tune_fit_forecast(features: DataFrame, cfg: RunConfig = RunConfig(), keys=("store_id",),
                      prediction_col: str = "TS_prediction") -> DataFrame:
    """Tune, refit on train + validation, and score every row."""
    model = fit_group_model(features, tuned_winners(features, cfg, keys), keys, cfg)
    return group_forecast(features, model, keys, prediction_col, cfg)
