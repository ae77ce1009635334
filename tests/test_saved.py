"""Pipelines and fitted learners saved and loaded again; learners fitted side by side in their own pools."""

from dataclasses import replace

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from almanac import operators as ops
from almanac.operators import assemble
from almanac.plans import boosting, runner, scorers, trees
from almanac.sources.config import RunConfig
from almanac.stages import FitModels, SelectBest, Stage

CFG = replace(RunConfig(), max_evals=2, lags=(1, 12))
LABEL = "train_test_val_indicator"


@pytest.fixture(scope="module")
def feats(spark):
    rows = [(f"s{i}", 1998 + t // 12, 1 + t % 12, 4 + 0.02 * t + (t % 12) * (i + 1) / 30 + ((t * 7 + i) % 5) / 10,
             0 if t < 24 else 1 if t < 33 else 2) for i in range(4) for t in range(44)]
    df = spark.createDataFrame(rows, f"store_id string, year int, month int, sales double, {LABEL} int")
    return ops.lag_features(df, "sales", ["store_id"], ["year", "month"], [1, 12]).filter("lag_sales_12 IS NOT NULL").checkpoint()


def shown(df):
    cols = [c for c, t in df.dtypes if t != "vector"]
    return sorted(map(str, df.select(*cols).collect()))


def test_a_fitted_pipeline_forecasts_the_same_after_loading(spark, feats, tmp_path):
    calendar = spark.createDataFrame([(m, m % 3) for m in range(1, 13)], "month int, season int")
    pipeline = Pipeline(stages=[Stage(ops.filter_rows, "month > 0"), Stage(ops.join, calendar, "month"),
                                Stage(ops.fill_missing, 0.0, ["lag_sales_1"]),
                                FitModels(("TS", "FOURIER", "LAST_MONTH"), CFG), SelectBest(("TS", "FOURIER", "LAST_MONTH"), "validation", CFG)])
    fitted = pipeline.fit(feats)
    want = shown(fitted.transform(feats))
    fitted.write().save(str(tmp_path / "fitted"))
    loaded = PipelineModel.load(str(tmp_path / "fitted"))
    assert shown(loaded.transform(feats)) == want and len(want) == feats.count()
    assert [s.uid for s in loaded.stages] == [s.uid for s in fitted.stages]
    assert shown(loaded.stages[-1].losses) == shown(fitted.stages[-1].losses)
    pipeline.write().save(str(tmp_path / "plan"))
    again = Pipeline.load(str(tmp_path / "plan"))
    def to_nine(df):  # a second fit adds its sums up in another order
        return shown(df.withColumns({c: F.round(c, 9) for c in ("sales", "prediction")}))
    assert to_nine(again.fit(feats).transform(feats)) == to_nine(fitted.transform(feats))
    with pytest.raises(Exception, match="already exists"):
        fitted.save(str(tmp_path / "fitted"))


def test_tree_scorers_are_saved(spark, feats, tmp_path):
    frame = assemble(feats.withColumn("features_ok", F.col("lag_sales_1").isNotNull()), ["month", "lag_sales_1", "lag_sales_12"])
    cfg = replace(CFG, hp_space_rf={"maxDepth": ["choice", 2, 3], "numTrees": ["choice", 3]})
    forest, _, _ = trees.tune_tree(frame, "RF", cfg)
    boosted = boosting.fit_boosted(frame, ["month", "lag_sales_1"], "sales", ["store_id", "year", "month"], boosting.BoostParams(n_trees=2, max_depth=2))
    own = [("RF", scorers.Forest("RF", forest)), ("BOOST", scorers.Boosted("BOOST", boosted)), ("LAST_YEAR", scorers.Lagged("LAST_YEAR", "lag_sales_12"))]
    kept = scorers.save_scorers(own, str(tmp_path))
    for (name, a), (other, b) in zip(own, scorers.load_scorers(spark, kept, str(tmp_path)), strict=True):
        assert name == other and shown(a(frame)) == shown(b(frame)) and f"{name}_prediction" in b(frame).columns
    with pytest.raises(TypeError, match="cannot be saved"):
        scorers.save_scorers([("x", lambda df: df)], str(tmp_path / "x"))


def test_what_cannot_be_saved_says_so(spark, tmp_path):
    with pytest.raises(TypeError, match="no importable name"):
        Stage(lambda df: df).write().save(str(tmp_path / "a"))
    with pytest.raises(TypeError, match="Column cannot be saved"):
        Stage(ops.filter_rows, F.col("x") > 1).write().save(str(tmp_path / "b"))


def test_arguments_come_back_with_their_types(spark, tmp_path):
    df = spark.range(3).selectExpr("id", "'a' AS k")
    stage = Stage(ops.lag_features, "id", ["k"], ["id"], range(1, 3), cast=None)
    stage.save(str(tmp_path / "s"))
    back = Stage.load(str(tmp_path / "s"))
    assert back._args == ("id", ["k"], ["id"], range(1, 3)) and back._kwargs == {"cast": None}
    assert shown(back.transform(df)) == shown(stage.transform(df))
    cfg = scorers.config_from_json(__import__("json").loads(__import__("json").dumps(scorers.config_to_json(CFG))))
    assert cfg == CFG


def test_learners_have_their_own_pools(spark, feats):
    assert spark.sparkContext.getConf().get("spark.scheduler.mode") == "FAIR"
    runner.fit_all(feats, ("TS", "LAST_MONTH"), replace(CFG, search="parzen", search_batch=1))[0][1](feats).count()
    pools = spark.sparkContext._jsc.sc().getAllPools()
    assert "fit-TS" in {pools.apply(i).name() for i in range(pools.size())}
    assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None
