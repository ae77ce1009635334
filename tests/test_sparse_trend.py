"""The native piecewise fit against a plain numpy coordinate descent, on known series and on edge rows."""

import math
from dataclasses import replace

import numpy as np
import pytest

from almanac.plans.fourier import design, score_fourier
from almanac.plans.sparse_trend import fit_sparse, places_of
from almanac.sources.config import RunConfig

LABEL = "train_test_val_indicator"
CFG = replace(RunConfig(), max_evals=9)
SCHEMA = f"store_id string, year int, month int, sales double, {LABEL} int, best int, n int"


def rows_of(store, value, months=72):
    """Labels 0 up to month 47, 1 up to 59, then 2."""
    return [(store, 1995 + t // 12, 1 + t % 12, value(t), 0 if t < 48 else 1 if t < 60 else 2, 1, 2) for t in range(months)]


def plain(rows, cand, fit, n_cp=5, order=3, steps=20_000):
    """Coefficients of the scaled problem by plain coordinate descent over all of them."""
    t = np.array([(r[1] - 1995) * 12.0 + r[2] - 1 for r in rows if fit(r)])
    m = np.array([float(r[2]) for r in rows if fit(r)])
    y = np.array([r[3] for r in rows if fit(r)])
    slope, icpt = np.polyfit(t, y, 1)
    level = icpt + slope * t if cand["seasonality_mode"] == "multiplicative" else 1.0
    span = t.max() - t.min()
    tau = (t - t.min()) / span
    X = design(tau, m, np.array(places_of(n_cp)), order, level)
    G, b = X.T @ X, X.T @ y
    ridge = np.zeros(len(b))
    ridge[2 + n_cp:] = 1 / cand["seasonality_prior_scale"] ** 2
    pen = np.zeros(len(b))
    pen[2:2 + n_cp] = 1 / cand["changepoint_prior_scale"]
    free = [i for i in range(len(b)) if not 2 <= i < 2 + n_cp]
    beta = np.zeros(len(b))
    for _ in range(steps // 10):
        c = slice(2, 2 + n_cp)
        beta[free] = np.linalg.solve((G + np.diag(ridge))[np.ix_(free, free)], b[free] - G[free, c] @ beta[c])
        for j in range(2, 2 + n_cp):
            rho = b[j] - G[j] @ beta + G[j, j] * beta[j]
            beta[j] = np.sign(rho) * max(abs(rho) - pen[j], 0) / G[j, j]
    return {"slope": beta[1] / span, "intercept": beta[0] - beta[1] * t.min() / span, "deltas": beta[2:2 + n_cp] / span,
            "seasonal": beta[2 + n_cp:]}


@pytest.mark.parametrize("mode", ["additive", "multiplicative"])
@pytest.mark.parametrize("scale", [0.2, 5.0])
def test_against_plain_descent(spark, mode, scale):
    rng = np.random.default_rng(3)
    noise = rng.normal(size=72) / 5
    rows = rows_of("a", lambda t: float(5 + 0.05 * t - 0.09 * max(t - 26, 0) + math.sin(2 * math.pi * (t % 12) / 12) + noise[t]))
    cand = {"changepoint_prior_scale": scale, "seasonality_prior_scale": 2.0, "seasonality_mode": mode}
    space = {k: ["choice", v] for k, v in cand.items()}
    got = fit_sparse(spark.createDataFrame(rows, SCHEMA).repartition(4), CFG, space=space, sweeps=600).collect()
    want = plain(rows, cand, lambda r: r[4] <= 1)
    assert len(got) == 1 and got[0]["cand_id"] == 0
    assert np.allclose(got[0]["deltas"], want["deltas"], atol=1e-6) and np.allclose(got[0]["seasonal"], want["seasonal"], atol=1e-6)
    assert math.isclose(got[0]["slope"], want["slope"], abs_tol=1e-6) and math.isclose(got[0]["intercept"], want["intercept"], abs_tol=1e-5)
    assert len(got[0]["changepoints"]) == 5 and got[0]["changepoints"][0] == pytest.approx(59 * 0.8 / 6)
    if scale == 0.2:  # a tight prior leaves changes out altogether
        assert sum(d == 0.0 for d in got[0]["deltas"]) >= 3


def test_known_series_and_edge_groups(spark):
    rows = rows_of("line", lambda t: 2.0 + 0.25 * t) + rows_of("wave", lambda t: 8.0 + math.cos(2 * math.pi * (1 + t % 12) / 12))
    rows += rows_of("flat", lambda t: 3.0) + rows_of("two", lambda t: 1.0 * t, 2) + rows_of("one", lambda t: 1.0, 1)
    rows += [("none", 1999, 1, None, 0, 1, 2), ("none", 1999, 2, float("nan"), 1, 1, 2), ("late", 2000, 12, 4.0, 2, 1, 2)]
    rows += [("line", 1999, 3, None, 0, 1, 2)]
    space = {"changepoint_prior_scale": ["choice", 0.5], "seasonality_prior_scale": ["choice", 0.01, 50.0],
             "seasonality_mode": ["choice", "additive", "multiplicative"]}
    frame = spark.createDataFrame(rows, SCHEMA)
    model = fit_sparse(frame, CFG, space=space)
    found = {r["store_id"]: r for r in model.collect()}
    assert set(found) == {"line", "wave", "flat", "two", "one", "none", "late"}
    assert found["line"]["slope"] == pytest.approx(0.25) and found["line"]["intercept"] == pytest.approx(2.0)
    assert found["line"]["deltas"] == pytest.approx([0] * 5, abs=1e-9) and found["flat"]["slope"] == pytest.approx(0, abs=1e-9)
    assert found["wave"]["cand_id"] >= 2 and found["wave"]["validation_loss"] < 0.1  # the loose seasonal prior
    for name in ("one", "none", "late"):
        r = found[name]
        assert (r["cand_id"], r["validation_loss"], r["slope"], r["deltas"], r["season_level"]) == (-1, None, None, None, None)
    assert found["two"]["cand_id"] == -1 and found["two"]["intercept"] is not None
    scored = score_fourier(frame, model, CFG).collect()
    assert len(scored) == len(rows)
    assert max(abs(r["FOURIER_prediction"] - r["sales"]) for r in scored if r["store_id"] in ("line", "flat", "wave") and r["sales"] is not None) < 0.05
    empty = fit_sparse(frame.limit(0), CFG, space=space)
    assert empty.collect() == [] and empty.columns == model.columns


def test_repeated_rows_weigh_twice_and_keys_may_be_several(spark):
    rows = rows_of("a", lambda t: 5 + 0.01 * t + (t % 12) / 12)
    space = {"changepoint_prior_scale": ["choice", 1.0], "seasonality_prior_scale": ["choice", 1e6], "seasonality_mode": ["choice", "additive"]}
    one = fit_sparse(spark.createDataFrame(rows, SCHEMA), CFG, space=space, n_changepoints=0).collect()[0]
    two = fit_sparse(spark.createDataFrame(rows + rows, SCHEMA), CFG, ["store_id", "n"], space, n_changepoints=0).collect()[0]
    assert one["slope"] == pytest.approx(two["slope"], abs=1e-9) and one["seasonal"] == pytest.approx(two["seasonal"], abs=1e-6)
    assert one["changepoints"] == one["deltas"] == [] and two["n"] == 2
