"""Parzen search: densities by hand, better than random at the same number of trials, reproducible, resumable."""

import math
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from almanac.plans import parzen, trees
from almanac.sources.config import RunConfig

SPACE = {"a": ["quniform", "float", 0, 10, 0.25], "b": ["quniform", "int", 0, 40, 1]}


def quadratic(asked):
    return asked.selectExpr("s", "trial", "power((at[0] * 0.25 - 7.25) / 10, 2) + power((at[1] - 11) / 40D, 2) AS loss")


@pytest.fixture(scope="module")
def groups(spark):
    return spark.range(24).withColumnRenamed("id", "s")


def losses_of(table):
    return {r["s"]: r["loss"] for r in parzen.best_so_far(table, ["s"]).collect()}


def test_beats_random_and_is_reproducible(groups):
    """24 searches of 20 trials on a fixed quadratic, as one job a round, against 20 random candidates each."""
    table = parzen.search(groups, SPACE, quadratic, ["s"], 20, 5, seed=3)
    assert table.groupBy("s").agg(F.countDistinct("at").alias("n"), F.max("trial").alias("t")).select("n", "t").distinct().collect() == [(20, 19)]
    found = losses_of(table)
    drawn = losses_of(parzen.search(groups, SPACE, quadratic, ["s"], 20, 20, seed=3, draws=40))
    assert sum(found.values()) < 0.6 * sum(drawn.values())
    assert sum(found[s] <= drawn[s] for s in found) >= 16
    few = groups.filter("s < 3").repartition(3)
    again = parzen.search(few, SPACE, quadratic, ["s"], 20, 5, seed=3)
    assert sorted(map(str, again.collect())) == sorted(map(str, table.filter("s < 3").collect()))


def test_stopped_search_goes_on(spark, tmp_path, groups):
    few, ran = groups.filter("s < 2"), []

    def counted(asked):
        ran.append(sorted(r["trial"] for r in asked.filter("s = 0").collect()))
        if len(ran) == 3:
            raise KeyboardInterrupt
        return quadratic(asked)
    whole = sorted(map(str, parzen.search(few, SPACE, quadratic, ["s"], 10, 3, seed=5).collect()))
    with pytest.raises(KeyboardInterrupt):
        parzen.search(few, SPACE, counted, ["s"], 10, 3, seed=5, path=str(tmp_path))
    table = parzen.search(few, SPACE, counted, ["s"], 10, 3, seed=5, path=str(tmp_path))
    assert sorted(map(str, table.collect())) == whole
    assert ran == [[0, 1, 2], [3, 4, 5], [6, 7, 8], [6, 7, 8], [9]]


def test_densities_by_hand(spark):
    space = {"x": ["quniform", "int", 1, 4, 1], "c": ["choice", "u", "v"]}
    rows = [("k", 0, 3.0, [0, 0]), ("k", 1, 1.0, [2, 1]), ("k", 2, None, [3, 0]), ("k", 3, float("nan"), [3, 0])]
    trials = spark.createDataFrame(rows, "g string, trial int, loss double, at array<int>")
    known = spark.createDataFrame([("k",), ("new",)], "g string")
    got = {(r["g"], r["p"], r["place"]): (r["good"], r["bad"]) for r in parzen.densities(trials, known, space, ["g"], 0.25).collect()}
    assert len(got) == 12 and got["new", 0, 2] == (0.25, 0.25) and got["new", 1, 0] == (0.5, 0.5)
    for (g, p) in {(g, p) for g, p, _ in got}:  # densities sum to one
        for side in (0, 1):
            assert math.isclose(sum(v[side] for (h, q, _), v in got.items() if (h, q) == (g, p)), 1.0)

    def kernel(at, m, place):
        h = max(1.0, 4 / (3 * math.sqrt(m)))
        return math.exp(-0.5 * ((place - at) / h) ** 2) / sum(math.exp(-0.5 * ((i - at) / h) ** 2) for i in range(4))
    for place in range(4):
        assert math.isclose(got["k", 0, place][0], (0.25 + kernel(2, 1, place)) / 2)
        assert math.isclose(got["k", 0, place][1], (0.25 + sum(kernel(a, 3, place) for a in (0, 3, 3))) / 4)
    assert got["k", 1, 1] == (1.5 / 2, 0.5 / 4) and got["k", 1, 0] == (0.5 / 2, 3.5 / 4)


def test_proposals_skip_tried_candidates(spark):
    space = {"x": ["choice", 1, 2, 3]}
    trials = spark.createDataFrame([("k", 0, 1.0, [1]), ("k", 1, 2.0, [0])], "g string, trial int, loss double, at array<int>")
    density = parzen.densities(trials, trials.select("g").distinct(), space, ["g"])
    got = parzen.proposals(density, trials, ["g"], 5, draws=40).collect()
    assert [(r["g"], r["rank"], list(r["at"])) for r in got] == [("k", 1, [2])]


def test_places_and_candidates(spark):
    space = {"x": ["quniform", "float", 0.5, 2.0, 0.5], "m": ["choice", "it's", "b"]}
    frame = spark.createDataFrame([(1.5, "b"), (0.5, "it's")], "x double, m string")
    assert [list(r["at"]) for r in frame.select(parzen.places_of(space, {}).alias("at")).collect()] == [[2, 1], [0, 0]]
    assert parzen.decode(space, [3, 0]) == {"x": 2.0, "m": "it's"}
    off = spark.createDataFrame([(0.7, "b")], "x double, m string")
    with pytest.raises(Exception, match="not on its axis"):
        off.select(parzen.places_of(space, {}).alias("at")).collect()


def test_trees_are_tuned_by_it(spark):
    rows = [(f"s{i % 3}", 2000, 1 + i % 12, float(i % 7 + i % 3), float(i % 7), i % 2, True) for i in range(60)]
    frame = spark.createDataFrame(rows, "store_id string, year int, month int, sales double, x double, train_test_val_indicator int, features_ok boolean")
    from almanac.operators import assemble
    cfg = replace(RunConfig(), search="parzen", search_batch=2, max_evals=4,
                  hp_space_rf={"maxDepth": ["quniform", "int", 1, 4, 1], "numTrees": ["choice", 2, 3]})
    model, losses, best = trees.tune_tree(assemble(frame, ["x", "month"]), "RF", cfg)
    assert [i for i, _, _ in losses] == [0, 1, 2, 3] and len({str(c) for _, c, _ in losses}) == 4
    assert losses[best][2] == min(v for _, _, v in losses) and model.getNumTrees == losses[best][1]["numTrees"]
    with pytest.raises(ValueError):
        trees.tune_tree(frame, "RF", replace(cfg, search="other"))


def test_every_store_searches_on_its_own(spark, tmp_path):
    """Losses are those of the same scales in one job; a tuning that was stopped ends with the same table."""
    from almanac.plans import group_model
    rows = [(f"s{i}", 1999 + t // 12, 1 + t % 12, 4 + 0.01 * t + (t % 12) * i / 20 + ((t * 7 + i) % 5) / 10, 0 if t < 30 else 1 if t < 42 else 2)
            for i in range(3) for t in range(48)] + [("late", 2002, 1, 3.0, 1)]
    feats = spark.createDataFrame(rows, "store_id string, year int, month int, sales double, train_test_val_indicator int")
    cfg = replace(RunConfig(), search="parzen", search_batch=2, hp_space_group={"seasonality_prior_scale": ["quniform", "float", 0.25, 8, 0.25]})
    whole = group_model.tune_group_search(feats, cfg, trials=6)
    scaled = whole.withColumn("scale", group_model.search_scale(cfg)).collect()
    every = [{"seasonality_prior_scale": s} for s in sorted({r["scale"] for r in scaled})]
    known = {(r["store_id"], r["seasonality_prior_scale"]): r["loss"] for r in group_model.tune_group_losses(feats, every).collect()}
    assert len(scaled) == 4 * 6
    assert all(r["loss"] == known.get((r["store_id"], r["scale"])) for r in scaled)
    assert {r["loss"] for r in scaled if r["store_id"] == "late"} == {None}
    group_model.tune_group_search(feats, cfg, trials=4, path=str(tmp_path))
    resumed = group_model.tune_group_search(feats, cfg, trials=6, path=str(tmp_path))
    assert sorted(map(str, resumed.collect())) == sorted(map(str, whole.collect()))
    winners = {r["store_id"]: r for r in group_model.search_winners(whole, cfg=cfg).collect()}
    for store in ("s0", "s1", "s2"):
        assert winners[store]["loss"] == min(r["loss"] for r in scaled if r["store_id"] == store)
    out = group_model.tune_fit_forecast(feats, replace(cfg, max_evals=4))
    assert out.filter("TS_prediction IS NULL AND store_id <> 'late'").count() == 0 < out.count() == len(rows)
