"""Per-group piecewise-linear trend + Fourier seasonality, fitted in a grouped pandas map.

Model per group on the monthly log series (Taylor & Letham 2018 form), fitted by ridge regression:

    y(t) = a + b t + sum_j d_j (t - c_j)+ + g(t) sum_k [u_k sin(2 pi k m / 12) + v_k cos(2 pi k m / 12)]

* changepoints ``c_j``: evenly spaced over the first 80 % of the training span;
* ridge penalties ``1 / changepoint_prior_scale**2`` on ``d`` and
  ``1 / seasonality_prior_scale**2`` on ``u, v``; ``a, b`` are not penalised;
* ``g(t)`` is 1 for additive seasonality and the group's least-squares line for multiplicative.

One ``applyInPandas`` call fits a group: every candidate is fitted on label 0 and scored on label 1
(MAPE), the best candidate (ties: lowest id) is refitted on labels 0-1, and the group's model comes
back as one row of coefficients. Scoring is column expressions over any rows, so the model also
forecasts rows it was not fitted with. The frame is aggregated to one row per group and month before
the call, so a group is bounded by the number of months, never by raw rows. :mod:`almanac.plans.sparse_trend` fits
the same model without Python workers and with sparse changepoints.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almanac.functions.scalar import month_index
from almanac.plans.tuning import candidate_grid
from almanac.sources.config import RunConfig

LABEL = "train_test_val_indicator"
ADDITIVE, MULTIPLICATIVE = "additive", "multiplicative"


def design(t: np.ndarray, m: np.ndarray, changepoints: np.ndarray, order: int, level=1.0) -> np.ndarray:
    """Columns of the model; ``level`` is g(t), what the seasonal terms are multiplied by."""
    cols = [np.ones_like(t), t]
    cols += [np.maximum(t - c, 0.0) for c in changepoints]
    for k in range(1, order + 1):
        ang = 2.0 * np.pi * k * m / 12.0
        cols += [level * np.sin(ang), level * np.cos(ang)]
    return np.column_stack(cols)


def changepoints_for(t_train: np.ndarray, n: int) -> np.ndarray:
    if len(t_train) < 3 or n <= 0:
        return np.empty(0)
    lo, hi = t_train.min(), t_train.min() + 0.8 * (t_train.max() - t_train.min())
    return np.linspace(lo, hi, n + 2)[1:-1]


def fit_ridge(X: np.ndarray, y: np.ndarray, n_cp: int, cps: float, sps: float) -> np.ndarray:
    pen = np.zeros(X.shape[1])
    # a prior scale of 0 pins those terms to 0: a very large, finite penalty
    pen[2:2 + n_cp] = 1.0 / max(cps * cps, 1e-12)
    pen[2 + n_cp:] = 1.0 / max(sps * sps, 1e-12)
    A = X.T @ X + np.diag(pen)
    return np.linalg.lstsq(A, X.T @ y, rcond=None)[0]


def _mape(y: np.ndarray, p: np.ndarray) -> float:
    ok = y != 0
    return float(np.mean(np.abs((y[ok] - p[ok]) / y[ok])) * 100.0) if ok.any() else float("nan")


def _fit(t, m, y, cand: dict, n_changepoints: int, order: int):
    """(changepoints, coefficients, line) of one candidate on the rows given."""
    cp = changepoints_for(t, n_changepoints)
    line = (1.0, 0.0)
    if cand.get("seasonality_mode", ADDITIVE) == MULTIPLICATIVE:
        slope, intercept = np.polyfit(t, y, 1) if len(np.unique(t)) > 1 else (0.0, float(np.mean(y)))
        line = (float(intercept), float(slope))
    X = design(t, m, cp, order, line[0] + line[1] * t)
    beta = fit_ridge(X, y, len(cp), cand.get("changepoint_prior_scale", 0.0), cand["seasonality_prior_scale"])
    return cp, beta, line


def make_group_fn(cands: list[dict], keys: list[str], n_changepoints: int, order: int):
    def per_group(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("t")
        t = pdf["t"].to_numpy(float)
        m = pdf["month"].to_numpy(float)
        y = pdf["y"].to_numpy(float)
        ind = pdf[LABEL].to_numpy()
        finite = np.isfinite(y) & np.isfinite(t) & np.isfinite(m)
        tr, va, fit_rows = (ind == 0) & finite, (ind == 1) & finite, (ind <= 1) & finite
        best_id, best_loss = None, None
        if tr.sum() >= 2 and va.any():
            for i, c in enumerate(cands):
                cp, beta, line = _fit(t[tr], m[tr], y[tr], c, n_changepoints, order)
                p = design(t[va], m[va], cp, order, line[0] + line[1] * t[va]) @ beta
                loss = _mape(y[va], p)
                if not np.isnan(loss) and (best_loss is None or loss < best_loss):
                    best_id, best_loss = i, loss
        out = pdf[keys].iloc[:1].copy()
        out["cand_id"] = -1 if best_id is None else best_id
        out["validation_loss"] = np.nan if best_loss is None else best_loss
        model = [None] * 6
        if fit_rows.sum() >= 2:
            cp, beta, line = _fit(t[fit_rows], m[fit_rows], y[fit_rows], cands[best_id or 0], n_changepoints, order)
            n = 2 + len(cp)
            model = [float(beta[0]), float(beta[1]), cp.tolist(), beta[2:n].tolist(), beta[n:].tolist(), list(line)]
        for name, value in zip(MODEL_COLUMNS, model):
            out[name] = pd.Series([value], index=out.index, dtype=object)
        return out
    return per_group


MODEL_COLUMNS = ("intercept", "slope", "changepoints", "deltas", "seasonal", "season_level")


def fit_fourier(features: DataFrame, cfg: RunConfig = RunConfig(), keys=None, space: dict | None = None,
                n_changepoints: int = 5, order: int = 3) -> DataFrame:
    """The model as data, one row per group: ``keys, cand_id, validation_loss, intercept, slope,
    changepoints, deltas, seasonal, season_level``; the coefficients are null for a group with fewer than two
    usable training rows. The space comes from ``cfg.hp_space_fourier`` unless given."""
    keys = list(keys or cfg.keys)
    cands = candidate_grid(space or cfg.hp_space_fourier, cfg.max_evals, "random", cfg.seed)
    slim = features.select(*keys, "year", "month", LABEL, F.col("sales").alias("y"),
                           month_index(F.col("year"), F.col("month"), cfg.base_year).alias("t"))
    key_types = dict(features.dtypes)
    schema = (", ".join(f"{k} {key_types[k]}" for k in keys)
              + ", cand_id int, validation_loss double, intercept double, slope double, changepoints array<double>,"
              " deltas array<double>, seasonal array<double>, season_level array<double>")
    return slim.groupBy(*keys).applyInPandas(make_group_fn(cands, keys, n_changepoints, order), schema)


def score_fourier(df: DataFrame, model: DataFrame, cfg: RunConfig = RunConfig(), keys=None,
                  prediction_col: str = "FOURIER_prediction") -> DataFrame:
    """Add ``prediction_col`` to every row of ``df`` (null where its group has no model): one left join
    on the group key and column expressions; rows are neither dropped nor duplicated."""
    keys = list(keys or cfg.keys)
    own = model.select(*keys, *[F.col(c).alias(f"_{c}") for c in MODEL_COLUMNS])
    out = df.join(own, keys, "left")
    t = month_index(F.col("year"), F.col("month"), cfg.base_year)
    angle = F.col("month").cast("double") * (2.0 * np.pi / 12.0)

    def total(terms):
        return F.aggregate(terms, F.lit(0.0), lambda a, x: a + x)

    bends = total(F.zip_with("_changepoints", "_deltas", lambda c, d: d * F.greatest(t - c, F.lit(0.0))))
    # coefficients alternate sin, cos of harmonics 1, 1, 2, 2, ...
    waves = total(F.transform("_seasonal", lambda u, i: u * F.when(
        i % 2 == 0, F.sin(angle * (F.floor(i / 2) + 1))).otherwise(F.cos(angle * (F.floor(i / 2) + 1)))))
    level = F.element_at("_season_level", 1) + F.element_at("_season_level", 2) * t
    pred = F.col("_intercept") + F.col("_slope") * t + bends + level * waves
    return out.withColumn(prediction_col, pred).drop(*[f"_{c}" for c in MODEL_COLUMNS])


def fourier_forecast(features: DataFrame, cfg: RunConfig = RunConfig(), keys=None, space: dict | None = None,
                     n_changepoints: int = 5, order: int = 3,
                     prediction_col: str = "FOURIER_prediction") -> DataFrame:
    """Fit and score in one: ``keys, year, month, train_test_val_indicator, sales, prediction_col``."""
    keys = list(keys or cfg.keys)
    model = fit_fourier(features, cfg, keys, space, n_changepoints, order)
    return score_fourier(features.select(*keys, "year", "month", LABEL, "sales"), model, cfg, keys, prediction_col)
