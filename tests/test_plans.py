"""Plan-level cases: group model vs brute force, tie rules, physical-path equivalence,
selection, grouped-map model, end-to-end export."""

import json
import math
import os
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from almanac.plans import group_model, selection
from almanac.plans.tuning import candidate_grid, full_grid
from almanac.sources.config import RunConfig, load_config

from conftest import SF_SMALL

CFG = RunConfig()
LABEL = "train_test_val_indicator"


def test_candidate_grid_axes():
    space = {"a": ["quniform", "int", 2, 4, 1], "b": ["quniform", "float", 0.0, 0.3, 0.1], "c": ["choice", "x", "y"]}
    grid = full_grid(space)
    assert len(grid) == 3 * 4 * 2
    assert grid[0] == {"a": 2, "b": 0.0, "c": "x"} and grid[-1] == {"a": 4, "b": 0.3, "c": "y"}
    assert candidate_grid(space, 100) == grid
    spread = candidate_grid(space, 4, "spread")
    assert spread == [grid[0], grid[6], grid[12], grid[18]]
    r1, r2 = candidate_grid(space, 5, "random", 7), candidate_grid(space, 5, "random", 7)
    assert r1 == r2 and len(r1) == 5 and all(c in grid for c in r1)


def _series_rows():
    """Store A: exact trend + month effect over 4 years; store B: only test rows."""
    rows = []
    for year in range(1996, 2000):
        for month in range(1, 13):
            t = (year - CFG.base_year) * 12 + month - 1
            y = 2.0 + 0.01 * t + 0.1 * math.sin(month)
            label = 0 if year < 1998 else (1 if year == 1998 else 2)
            rows.append(("A", year, month, y, label))
    rows += [("B", 1999, m, 3.0, 2) for m in range(1, 4)]
    return rows


def _series(spark):
    return spark.createDataFrame(_series_rows(), f"store_id string, year int, month int, sales double, {LABEL} int")


def _brute_losses(rows, cands):
    out = {}
    for store in sorted({r[0] for r in rows}):
        g = [r for r in rows if r[0] == store]
        tr = [(r[2], (r[1] - CFG.base_year) * 12 + r[2] - 1, r[3]) for r in g if r[4] == 0]
        va = [(r[2], (r[1] - CFG.base_year) * 12 + r[2] - 1, r[3]) for r in g if r[4] == 1]
        if len(tr) < 2 or not va:
            continue
        t = np.array([x[1] for x in tr], float); y = np.array([x[2] for x in tr])
        b, a = np.polyfit(t, y, 1)
        for i, c in enumerate(cands):
            lam = 1.0 / c["seasonality_prior_scale"] ** 2
            eff = {}
            for m in range(1, 13):
                res = [yy - (a + b * tt) for mm, tt, yy in tr if mm == m]
                if res:
                    eff[m] = sum(res) / (len(res) + lam)
            ape = [abs((yy - (a + b * tt + eff.get(mm, 0.0))) / yy) for mm, tt, yy in va]
            out[(store, i)] = 100 * sum(ape) / len(ape)
    return out


def test_group_losses_match_brute_force(spark):
    cands = [{"seasonality_prior_scale": s} for s in (0.1, 1.0, 10.0)]
    got = {(r.store_id, r.cand_id): r.loss
           for r in group_model.tune_group_losses(_series(spark), cands, ["store_id"], CFG).collect()}
    want = _brute_losses(_series_rows(), cands)
    assert set(got) == set(want)
    for k in want:
        assert abs(got[k] - want[k]) < 1e-6


def test_group_argmin_tie_lowest_candidate_and_missing_group(spark):
    cands = [{"seasonality_prior_scale": 1.0}, {"seasonality_prior_scale": 1.0}]
    losses = group_model.tune_group_losses(_series(spark), cands, ["store_id"], CFG)
    winners = {r.store_id: r.cand_id for r in group_model.group_argmin(losses).collect()}
    assert winners == {"A": 0}          # B has no training rows: no loss, no winner
    model = group_model.fit_group_model(_series(spark), group_model.group_argmin(losses))
    fc = group_model.group_forecast(_series(spark), model)
    assert fc.count() == len(_series_rows())          # rows are neither dropped nor duplicated
    b = fc.filter("store_id = 'B'").collect()
    assert all(r.TS_prediction is None for r in b)
    a = fc.filter(f"store_id = 'A' AND {LABEL} = 2").collect()
    assert all(abs(r.TS_prediction - r.sales) < 0.05 for r in a)


def _scored(spark):
    rows = [("s", 2000, m, 10.0, 0 if m < 6 else 2, 11.0, 9.0, 12.0) for m in range(1, 11)]
    return spark.createDataFrame(rows, f"store_id string, year int, month int, sales double, {LABEL} int, "
                                        "A_prediction double, B_prediction double, C_prediction double")


def test_selection_first_model_wins_tie(spark):
    losses = selection.model_losses(_scored(spark), ["A", "B", "C"])
    got = {(r.model_name, r.split): r.loss for r in losses.collect()}
    assert got[("A", "test")] == got[("B", "test")] == 10.0 and got[("C", "test")] == 20.0
    best = selection.best_model(losses, "test").first()
    assert best.model_name == "A" and best.position == 0
    best_b = selection.best_model(selection.model_losses(_scored(spark), ["B", "A"]), "test").first()
    assert best_b.model_name == "B"


def test_best_predictions_and_export(spark):
    sc = _scored(spark)
    best = selection.best_model(selection.model_losses(sc, ["C", "B"]), "test")
    preds = selection.best_predictions(sc, ["C", "B"], best)
    assert preds.count() == 10 and {r.model_name for r in preds.collect()} == {"B"}
    exp = selection.forecast_export(preds).collect()
    assert len(exp) == 5 and [r.month for r in exp] == [6, 7, 8, 9, 10]
    assert abs(exp[0].sales - math.exp(10.0)) < 1e-6 and abs(exp[0].prediction - math.exp(9.0)) < 1e-6


def test_store_sales_match_a_plain_join(spark):
    from almanac.plans.features import monthly_store_sales
    from almanac.sources.tables import read_table
    li, su, na = (read_table(spark, SF_SMALL, n) for n in ("lineitem", "supplier", "nation"))
    got = {tuple(r) for r in monthly_store_sales(li, su, na, "R").collect()}
    plain = (li.filter("l_returnflag = 'R'").join(su, li.l_suppkey == su.s_suppkey)
             .join(na, su.s_nationkey == na.n_nationkey)
             .groupBy("n_name", F.year("l_shipdate"), F.month("l_shipdate")).agg(F.sum("l_quantity")))
    assert got == {tuple(r) for r in plain.collect()} and len(got) > 0


def _waves(mode):
    rows = []
    for year in range(1996, 2001):
        for month in range(1, 13):
            t = (year - CFG.base_year) * 12 + month - 1
            line, wave = 3.0 + 0.02 * t, 0.2 * math.sin(2 * math.pi * month / 12)
            y = line * (1 + wave) if mode == "multiplicative" else line + wave
            rows.append(("A", year, month, y, 0 if year < 1999 else (1 if year == 1999 else 2)))
    return rows


@pytest.mark.parametrize("mode", ["additive", "multiplicative"])
def test_fourier_recovers_seasonal_series(spark, mode):
    from almanac.plans.fourier import fit_fourier, score_fourier
    rows = _waves(mode)
    df = spark.createDataFrame(rows, f"store_id string, year int, month int, sales double, {LABEL} int")
    space = {"changepoint_prior_scale": ["choice", 0.01, 0.02], "seasonality_prior_scale": ["choice", 10, 20],
             "seasonality_mode": ["choice", mode]}
    model = fit_fourier(df, CFG, space=space)
    assert model.count() == 1
    out = score_fourier(df, model, CFG).collect()
    assert len(out) == len(rows)
    assert max(abs(r.FOURIER_prediction - r.sales) for r in out) < (1e-2 if mode == "additive" else 6e-2)
    # rows the model was not fitted with, and a group it does not know
    later = spark.createDataFrame([("A", 2003, 5, None, 2), ("Z", 2003, 5, None, 2)], df.schema)
    new = {r.store_id: r.FOURIER_prediction for r in score_fourier(later, model, CFG).collect()}
    assert new["Z"] is None and abs(new["A"] - (3.0 + 0.02 * ((2003 - CFG.base_year) * 12 + 4))) < 2.0


def test_tree_tuning_deterministic(spark):
    from almanac.plans import runner, trees
    cfg = RunConfig(max_evals=2, hp_space_rf={"maxDepth": ["quniform", "int", 3, 4, 1],
                                              "numTrees": ["quniform", "int", 4, 5, 1]})
    frame = runner.prepare(spark, SF_SMALL, cfg).cache()
    _, l1, b1 = trees.tune_tree(frame, "RF", cfg)
    _, l2, b2 = trees.tune_tree(frame, "RF", cfg)
    assert l1 == l2 and b1 == b2 and len(l1) == 2


def test_run_writes_forecasts(spark):
    from almanac.plans import runner
    out = tempfile.mkdtemp(prefix="almanac-out-")
    res = runner.run(spark, SF_SMALL, CFG, models=runner.SQL_MODELS, out_path=out)
    winner = res["best"].first().model_name
    path = os.path.join(out, f"{winner}_{CFG.dept}_forecasts")
    back = spark.read.option("header", "true").csv(path)
    assert back.columns == ["store_id", "year", "month", "sales", f"{winner}_prediction"]
    assert back.count() == res["forecasts"].count() > 0


def test_load_config(tmp_path):
    p = tmp_path / "c.json"
    p.write_text(json.dumps({"dept": "A", "lags": [1, 2], "train_before": {"year": 1999, "month": 0},
                             "test_after": {"year": 2000, "month": 6}, "max_evals": 3}))
    cfg = load_config(str(p))
    assert cfg.dept == "A" and cfg.lags == (1, 2) and cfg.train_before == (1999, 0) and cfg.max_evals == 3
    assert cfg.split["test_after"] == {"year": 2000, "month": 6}


def test_read_csv_schema_and_inferred(spark, tmp_path):
    from almanac.sources import read_csv
    p = tmp_path / "s.csv"
    p.write_text("id,d_1,d_2\na,1,2\nb,3,4\n")
    inferred = read_csv(spark, str(p))
    assert inferred.dtypes == [("id", "string"), ("d_1", "int"), ("d_2", "int")]
    typed = read_csv(spark, str(p), "id string, d_1 double, d_2 double")
    assert typed.dtypes[1] == ("d_1", "double") and typed.count() == 2


def test_group_model_composite_keys(spark):
    cands = [{"seasonality_prior_scale": s} for s in (0.5, 2.0)]
    one = group_model.tune_group_losses(_series(spark), cands, ["store_id"], CFG)
    two = group_model.tune_group_losses(_series(spark).withColumn("dept", F.lit("D1")), cands,
                                        ["store_id", "dept"], CFG)
    a = {(r.store_id, r.cand_id): r.loss for r in one.collect()}
    b = {(r.store_id, r.cand_id): r.loss for r in two.collect() if r.dept == "D1"}
    assert a == b and len(a) == 2


def test_mape_negative_labels(spark):
    from almanac.functions import mape
    df = spark.createDataFrame([(-2.0, -1.0), (-4.0, -5.0)], "y double, p double")
    assert abs(mape(df, "y", "p") - 37.5) < 1e-12


def test_fit_all_cutoff_hides_later_rows(spark):
    from almanac.plans import runner
    frame = runner.prepare(spark, SF_SMALL, CFG, vectors=False)
    full = dict(runner.fit_all(frame, ("TS",), CFG, concurrent=False))["TS"](frame)
    cut = dict(runner.fit_all(frame, ("TS",), CFG, concurrent=False,
                              cutoff={"year": 1999, "month": 6}))["TS"](frame)
    assert full.count() == cut.count() == frame.count()
    a = {(r.store_id, r.year, r.month): r.TS_prediction for r in full.collect()}
    b = {(r.store_id, r.year, r.month): r.TS_prediction for r in cut.collect()}
    assert a != b          # later training / validation months no longer shape the model


def test_daily_path_calendar(spark):
    from almanac.plans.features import daily_monthly, load_long_daily
    long, cal, n = load_long_daily(spark, SF_SMALL, "purchase")
    assert cal.count() == n and long.select("day").distinct().count() == n
    a = {tuple(r) for r in daily_monthly(long, cal, "user_id").collect()}
    b = {tuple(r) for r in daily_monthly(long, cal, ["user_id"]).collect()}
    assert a == b and len(a) > 0


def test_tree_rows_with_null_features_kept_unpredicted(spark):
    from almanac.plans import runner, trees
    cfg = RunConfig(max_evals=1, hp_space_rf={"maxDepth": ["quniform", "int", 3, 3, 1],
                                              "numTrees": ["quniform", "int", 3, 3, 1]})
    feats = runner.prepare(spark, SF_SMALL, cfg, vectors=False)
    # blank one feature on a few rows: they must stay in the output with a null prediction
    holed = feats.withColumn("lag_sales_3", F.when(F.col("month") == 7, F.lit(None)).otherwise(F.col("lag_sales_3")))
    frame = trees.model_frame(holed, cfg)
    model, _, _ = trees.tune_tree(frame, "RF", cfg)
    out = trees.scorer(model, "RF_prediction")(frame)
    assert out.count() == feats.count()
    assert all(r.RF_prediction is None for r in out.filter("month = 7").collect())
    assert all(r.RF_prediction is not None for r in out.filter("month != 7").collect())


def test_tree_tuning_matches_independent_fits(spark):
    """Brute force: refit every candidate on its own and score the validation slice."""
    from pyspark.ml.regression import RandomForestRegressor
    from almanac.functions import mape
    from almanac.plans import runner, trees
    cfg = RunConfig(max_evals=3, hp_space_rf={"maxDepth": ["quniform", "int", 2, 6, 1],
                                              "numTrees": ["quniform", "int", 3, 6, 1]})
    frame = runner.prepare(spark, SF_SMALL, cfg).cache()
    _, losses, best = trees.tune_tree(frame, "RF", cfg)
    usable = frame.filter("features_ok AND sales IS NOT NULL")
    train = trees.spread_for_fit(usable.filter(f"{LABEL} = 0"), trees.MIN_FIT_PARTITIONS["RF"])
    valid = usable.filter(f"{LABEL} = 1")
    for cand_id, params, loss in losses:
        m = RandomForestRegressor(featuresCol="features", labelCol="sales", predictionCol="p",
                                  seed=cfg.seed, **params).fit(train)
        assert abs(mape(m.transform(valid), "sales", "p") - loss) < 1e-9
    assert best == min(losses, key=lambda x: (x[2], x[0]))[0]


def test_command_line_run(spark, tmp_path, capsys):
    from almanac.__main__ import main
    cfg_path = tmp_path / "run.json"
    cfg_path.write_text(json.dumps({"dept": "R", "max_evals": 2}))
    out = tmp_path / "out"
    main(["--data", SF_SMALL, "--out", str(out), "--config", str(cfg_path),
          "--models", "TS,LAST_MONTH", "--select-on", "validation", "--format", "parquet"])
    written = [p.name for p in out.iterdir()]
    assert len(written) == 1 and written[0].endswith("_R_forecasts")
    back = spark.read.parquet(str(out / written[0]))
    assert back.count() > 0 and back.columns[:4] == ["store_id", "year", "month", "sales"]
    printed = capsys.readouterr().out
    assert "model_name" in printed and "selected on the validation slice" in printed


def test_unscored_report(spark):
    sc = _scored(spark).withColumn("B_prediction", F.when(F.col("month") <= 2, F.lit(None)).otherwise(F.col("B_prediction")))
    rows = {(r.model_name, r.store_id): r.rows for r in selection.unscored(sc, ["A", "B"]).collect()}
    assert rows == {("B", "s"): 2}


def test_store_sales_hot_supplier(spark):
    """One supplier holds a third of the line items: they are summed per (supplier, month) before the join."""
    import datetime as dt
    from almanac.plans.features import monthly_store_sales
    rows = []
    for i in range(3000):
        supp = 1 if i % 3 == 0 else 2 + (i % 50)
        rows.append((supp, float(1 + i % 7), "R", dt.datetime(1996 + i % 3, 1 + i % 12, 1 + i % 28)))
    li = spark.createDataFrame(rows, "l_suppkey bigint, l_quantity double, l_returnflag string, l_shipdate timestamp_ntz")
    su = spark.createDataFrame([(k, k % 5) for k in range(1, 60)], "s_suppkey bigint, s_nationkey int")
    na = spark.createDataFrame([(k, f"N{k}") for k in range(5)], "n_nationkey int, n_name string")
    sales = monthly_store_sales(li, su, na, "R")
    plan = sales._jdf.queryExecution().executedPlan().toString()
    join_at = min(i for i in (plan.find("SortMergeJoin"), plan.find("BroadcastHashJoin"), plan.find("ShuffledHashJoin")) if i >= 0)
    assert plan.rfind("partial_sum") > join_at   # the pre-aggregation sits below (after, in text) the join
    total = sum(r[1] for r in rows)
    assert abs(sum(r.sales for r in sales.collect()) - total) < 1e-6


def test_daily_path_empty_events(spark):
    from almanac.plans.features import daily_monthly, long_daily
    from almanac.sources.tables import read_table
    events = read_table(spark, SF_SMALL, "events").limit(0)
    long, cal, n = long_daily(spark, events, "purchase")
    assert n == 0 and long.count() == 0 and cal.count() == 0
    assert long.columns == ["user_id", "event_type", "day", "sales"]
    assert daily_monthly(long, cal, "user_id").count() == 0


def test_example_config_is_the_default():
    here = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    assert load_config(os.path.join(here, "examples", "run.json")) == RunConfig()


def test_calendar_lags_run(spark):
    from almanac.plans import runner
    from almanac.plans.features import load_monthly_features
    from almanac.plans.features import monthly_store_sales
    from almanac.sources.tables import read_table
    cfg = RunConfig(calendar_lags=True, lags=(1, 2, 3))
    rows = load_monthly_features(spark, SF_SMALL, cfg).collect()
    li, su, na = (read_table(spark, SF_SMALL, n) for n in ("lineitem", "supplier", "nation"))
    actual = {(r.store_id, r.year * 12 + r.month - 1): math.log(r.sales)
              for r in monthly_store_sales(li, su, na, "R").collect()}
    for r in rows:
        i = r.year * 12 + r.month - 1
        for k in (1, 2, 3):
            want = actual.get((r.store_id, i - k))
            got = r[f"lag_sales_{k}"]
            assert (got is None and want is None) or abs(got - want) < 1e-9
    assert len(rows) > 0
    res = runner.run(spark, SF_SMALL, cfg, models=("TS", "LAST_MONTH"))
    assert res["best"].count() == 1


def test_tree_speculative_refit_same_result(spark):
    from almanac.plans import runner, trees
    cfg = RunConfig(max_evals=2, hp_space_rf={"maxDepth": ["quniform", "int", 3, 4, 1],
                                              "numTrees": ["quniform", "int", 4, 5, 1]})
    frame = runner.prepare(spark, SF_SMALL, cfg).cache()
    m1, l1, b1 = trees.tune_tree(frame, "RF", cfg)
    m2, l2, b2 = trees.tune_tree(frame, "RF", cfg, refit="speculative")
    assert l1 == l2 and b1 == b2
    p1 = [r.RF_prediction for r in m1.transform(frame).orderBy("store_id", "year", "month").collect()]
    p2 = [r.RF_prediction for r in m2.transform(frame).orderBy("store_id", "year", "month").collect()]
    assert p1 == p2


def test_fourier_scoring_matches_the_design_matrix(spark):
    """Column expressions over the coefficients equal the fit's own matrix product, store by store."""
    import pandas as pd  # noqa: F401
    from almanac.functions.scalar import month_index
    from almanac.plans import fourier
    from almanac.plans.features import load_monthly_features
    feats = load_monthly_features(spark, SF_SMALL, CFG).cache()
    got = {(r.store_id, r.year, r.month): r.FOURIER_prediction for r in fourier.fourier_forecast(feats, CFG).collect()}
    cands = candidate_grid(CFG.hp_space_fourier, CFG.max_evals, "random", CFG.seed)
    fn = fourier.make_group_fn(cands, ["store_id"], 5, 3)
    pdf = feats.select("store_id", "year", "month", LABEL, F.col("sales").alias("y"),
                       month_index(F.col("year"), F.col("month"), CFG.base_year).alias("t")).toPandas()
    assert len(got) == len(pdf) > 0
    for _, g in pdf.groupby("store_id"):
        m = fn(g.reset_index(drop=True)).iloc[0]
        t, mo = g["t"].to_numpy(float), g["month"].to_numpy(float)
        X = fourier.design(t, mo, np.array(m["changepoints"]), 3, m["season_level"][0] + m["season_level"][1] * t)
        want = X @ np.array([m["intercept"], m["slope"], *m["deltas"], *m["seasonal"]])
        for key, w in zip(zip(g["store_id"], g["year"], g["month"]), want):
            assert abs(got[key] - w) < 1e-9


def test_group_forecast_invalid_month_gets_trend_only(spark):
    cands = [{"seasonality_prior_scale": 1.0}]
    losses = group_model.tune_group_losses(_series(spark), cands, ["store_id"], CFG)
    model = group_model.fit_group_model(_series(spark), group_model.group_argmin(losses))
    odd = spark.createDataFrame([("A", 1999, 0, 1.0, 2), ("A", 1999, 13, 1.0, 2), ("A", 1999, None, 1.0, 2)],
                                f"store_id string, year int, month int, sales double, {LABEL} int")
    out = group_model.group_forecast(odd, model).collect()
    assert len(out) == 3
    assert all(r.TS_prediction is not None for r in out if r.month is not None)


def test_null_labels_count_for_nothing(spark):
    """One observed January among three: its effect is that of one month, not a third of it."""
    rows = [("A", y, m, None if m == 1 and y in (1996, 1997) else 1.0 + (m == 1), 0 if y < 1999 else 1)
            for y in range(1996, 2000) for m in range(1, 13)]
    df = spark.createDataFrame(rows, f"store_id string, year int, month int, sales double, {LABEL} int")
    winners = spark.createDataFrame([("A", 0, 1e6, 0.0)], "store_id string, cand_id int, seasonality_prior_scale double, loss double")
    row = group_model.fit_group_model(df, winners, max_label=0).first()
    t = (1998 - CFG.base_year) * 12
    assert abs(row.effects[0] - (2.0 - (row.intercept + row.slope * t))) < 1e-6


def _with_zero_months(spark):
    from almanac.plans.features import monthly_features, monthly_store_sales
    from almanac.sources.tables import read_table
    li, su, na = (read_table(spark, SF_SMALL, n) for n in ("lineitem", "supplier", "nation"))
    monthly = monthly_store_sales(li, su, na, "R")
    return monthly.withColumn("sales", F.when((F.col("year") == 1998) & (F.col("month") == 3), 0.0).otherwise(F.col("sales")))


SMALL_TREES = {"hp_space_rf": {"maxDepth": ["choice", 3], "numTrees": ["choice", 3]},
               "hp_space_gbt": {"maxDepth": ["choice", 2], "maxIter": ["choice", 3]}}


@pytest.mark.parametrize("calendar", [False, True])
def test_zero_sales_months_fit_every_model(spark, calendar):
    from almanac.plans import runner
    from almanac.plans.features import monthly_features
    cfg = RunConfig(max_evals=1, calendar_lags=calendar, **SMALL_TREES)
    feats = monthly_features(_with_zero_months(spark), cfg)
    assert feats.filter("sales IS NULL").count() > 0
    res = runner.run(spark, None, cfg, features=feats, allow_unscored=True)
    assert res["losses"].count() == 12 and res["scored"].count() == feats.count()


def test_forest_does_not_depend_on_cores(tmp_path):
    """The same candidate on the same data: equal losses under local[2] and local[4]."""
    import subprocess
    import sys
    code = (
        "import sys; sys.path.insert(0, %r)\n"
        "from almanac.session import get_session\n"
        "from almanac.plans import runner, trees\n"
        "from almanac.sources.config import RunConfig\n"
        "spark = get_session(sys.argv[1], 4)\n"
        "cfg = RunConfig(max_evals=1, hp_space_rf={'maxDepth': ['choice', 6], 'numTrees': ['choice', 6]})\n"
        "print('LOSS', trees.tune_tree(runner.prepare(spark, %r, cfg), 'RF', cfg)[1])\n"
    ) % (os.path.dirname(os.path.dirname(os.path.abspath(__file__))), SF_SMALL)
    out = [subprocess.run([sys.executable, "-c", code, master], capture_output=True, text=True, timeout=300).stdout
           for master in ("local[2]", "local[4]")]
    assert "LOSS" in out[0] and out[0] == out[1]


def test_cutoff_scores_every_row_with_fourier(spark):
    from almanac.plans import runner
    frame = runner.prepare(spark, SF_SMALL, CFG, vectors=False)
    cut = dict(runner.fit_all(frame, ("FOURIER",), CFG, cutoff={"year": 1999, "month": 6}))["FOURIER"](frame)
    assert cut.filter(f"{LABEL} = 2 AND FOURIER_prediction IS NULL").count() == 0 < cut.count() == frame.count()


def test_partial_model_does_not_win(spark):
    sc = _scored(spark).withColumn("A_prediction", F.when(F.col("month") == 7, F.col("sales")))
    losses = selection.model_losses(sc, ["A", "B"])
    rows = {(r.model_name, r.split): r for r in losses.collect()}
    assert rows[("A", "test")].scored_rows == 1 and rows[("A", "test")].unscored_rows == 4
    assert rows[("A", "test")].loss == 0.0 and rows[("B", "test")].loss == 10.0  # both on the one common row
    assert selection.best_model(losses).first().model_name == "B"


def test_empty_slice_raises(spark):
    losses = selection.model_losses(_scored(spark).filter(f"{LABEL} = 0"), ["A", "B"])
    with pytest.raises(Exception, match="no row of the test slice"):
        selection.best_model(losses).collect()


def test_unscored_winner_raises(spark):
    from almanac.plans import runner
    from almanac.plans.features import load_monthly_features
    feats = load_monthly_features(spark, SF_SMALL, CFG).withColumn(
        "lag_sales_1", F.when((F.col(LABEL) < 2) | (F.col("month") > 3), F.col("lag_sales_1")))
    with pytest.raises(ValueError, match="without a forecast"):
        runner.run(spark, None, CFG, models=("LAST_MONTH",), features=feats)
    assert runner.run(spark, None, CFG, models=("LAST_MONTH",), features=feats, allow_unscored=True)["forecasts"].count() > 0


def test_wide_tables_with_two_keys(spark, tmp_path):
    """CSV in, forecasts out: wide daily table and calendar, keys (shop, line)."""
    from almanac.plans import runner
    from almanac.plans.features import load_wide_features
    import datetime as dt
    days = [dt.date(1997, 1, 1) + dt.timedelta(k) for k in range(4 * 365)]
    with open(tmp_path / "wide.csv", "w") as f:
        f.write("shop,line,note," + ",".join(f"d_{k + 1}" for k in range(len(days))) + "\n")
        for shop in ("x", "y"):
            for line in ("p", "q"):
                f.write(f"{shop},{line},n," + ",".join(str(2 + (d.month + len(shop + line)) % 5) for d in days) + "\n")
    (tmp_path / "cal.csv").write_text("d,date\n" + "".join(f"d_{k + 1},{d}\n" for k, d in enumerate(days)))
    cfg = RunConfig(keys=("shop", "line"), lags=(1, 2, 12), train_before=(1999, 7), test_after=(2000, 3), max_evals=1, **SMALL_TREES)
    feats = load_wide_features(spark, str(tmp_path / "wide.csv"), str(tmp_path / "cal.csv"), cfg, where="line = 'p'")
    assert feats.select("shop", "line").distinct().count() == 2 and feats.count() == 2 * 36
    first = feats.orderBy("shop", "year", "month").first()
    assert abs(first.sales - math.log(31 * (2 + (1 + 2) % 5))) < 1e-9
    res = runner.run(spark, None, cfg, features=feats, out_path=str(tmp_path / "out"))
    assert res["forecasts"].columns[:4] == ["shop", "line", "year", "month"] and res["forecasts"].count() == 18


def test_pipeline_fits_and_selects(spark):
    from pyspark.ml import Pipeline
    from almanac.plans import runner
    from almanac.stages import FitModels, SelectBest, Stage
    feats = runner.prepare(spark, SF_SMALL, CFG, vectors=False)
    fitted = Pipeline(stages=[Stage(lambda df: df.filter("month > 0")), FitModels(), SelectBest(split="validation")]).fit(feats)
    out = fitted.transform(feats)
    assert out.count() == feats.count() and out.select("model_name").distinct().count() == 1
    assert fitted.stages[-1].losses.count() == 9


def test_candidates_of_a_huge_space():
    space = {f"p{i}": ["quniform", "float", 0, 1, 0.001] for i in range(12)}
    picks = candidate_grid(space, 5, "random", 3)
    assert len(picks) == 5 and all(set(p) == set(space) for p in picks)


def test_zero_prior_scale_means_no_month_effect(spark):
    cands = [{"seasonality_prior_scale": 0.0}]
    losses = group_model.tune_group_losses(_series(spark), cands, ["store_id"], CFG)
    assert losses.count() == 1
    model = group_model.fit_group_model(_series(spark), group_model.group_argmin(losses))
    row = model.filter("store_id = 'A'").first()
    assert all(e is None for e in row.effects)
