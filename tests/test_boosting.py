"""Second-order boosting against a plain Python grower on the same rows."""

import math
import random

import pytest
from pyspark.sql import functions as F

from almanac.plans import boosting
from almanac.plans.boosting import BoostParams, Tree, bin_edges, binned, fit_boosted, tune_boosted

SCHEMA = "id int, y double, a double, b double, c double, train_test_val_indicator int, node int, g double"


def rows_of(n=240, seed=2):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        a, b, c = rng.randrange(9), rng.randrange(5) / 2, rng.choice([None, float("nan"), 1.0, 2.0, 7.0])
        y = 3.0 * (a > 4) - 2.0 * (b > 1) + (1.5 if c is None or c != c else 0.1 * c) + rng.random()
        rows.append((i, None if i % 40 == 7 else y, float(a), b, c, i % 3, 5, 6.0))
    return rows


def gone(x):
    return x is None or x != x


def plain_fit(rows, params):
    """The same trees grown row by row."""
    rows = [(r[0], r[1], r[2:5]) for r in rows if r[1] is not None]
    mean = sum(y for _, y, _ in rows) / len(rows)
    margin, lam, trees = [mean] * len(rows), params.reg_lambda, []
    for _ in range(params.n_trees):
        nodes, at = {}, [0] * len(rows)
        for node in range(2 ** (params.max_depth + 1) - 1):
            own = [i for i in range(len(rows)) if at[i] == node]
            G, H = sum(margin[i] - rows[i][1] for i in own), len(own)
            if not own:
                continue
            best = None
            for f in range(3):
                for cut in sorted({rows[i][2][f] for i in own if not gone(rows[i][2][f])})[1:]:
                    for ml in (False, True):
                        left = [i for i in own if (ml if gone(rows[i][2][f]) else rows[i][2][f] < cut)]
                        gl, hl = sum(margin[i] - rows[i][1] for i in left), len(left)
                        if hl < params.min_child_weight or H - hl < params.min_child_weight:
                            continue
                        gain = round(0.5 * (gl * gl / (hl + lam) + (G - gl) ** 2 / (H - hl + lam) - G * G / (H + lam)) - params.gamma, 8)
                        if gain > 0 and (best is None or (-gain, f, cut, ml) < best):
                            best = (-gain, f, cut, ml)
            deep = node >= 2 ** params.max_depth - 1
            nodes[node] = (None if deep or best is None else best, -G / (H + lam))
            if nodes[node][0]:
                _, f, cut, ml = best
                for i in own:
                    at[i] = 2 * node + (1 if (ml if gone(rows[i][2][f]) else rows[i][2][f] < cut) else 2)
        for i in range(len(rows)):
            margin[i] += params.learning_rate * nodes[at[i]][1]
        trees.append(nodes)
    return trees, {r[0]: m for r, m in zip(rows, margin)}


@pytest.mark.parametrize("params", [
    BoostParams(n_trees=3, max_depth=2, learning_rate=0.5),
    BoostParams(n_trees=2, max_depth=3, reg_lambda=0.5, gamma=0.2, min_child_weight=12),
])
def test_trees_match_a_plain_grower(spark, monkeypatch, params):
    monkeypatch.setattr(boosting, "TREES_PER_CHECKPOINT", 2)
    frame = spark.createDataFrame(rows_of(), SCHEMA).repartition(3)
    model = fit_boosted(frame, ["a", "b", "c"], "y", ["id"], params)
    trees, margins = plain_fit(rows_of(), params)
    found = [{} for _ in range(params.n_trees)]
    for r in model.nodes(spark).collect():
        found[r["tree"]][r["node"]] = r
    for got, want in zip(found, trees):
        assert got.keys() == want.keys()
        for node, (split, weight) in want.items():
            assert math.isclose(got[node]["weight"], weight, abs_tol=1e-9)
            if split is None:
                assert got[node]["feature"] is None
            else:
                assert (got[node]["feature"], got[node]["cut"], got[node]["missing_left"]) == ("abc"[split[1]], split[2], split[3])
    scored = {r["id"]: r["p"] for r in model.transform(frame, "p").collect()}
    assert len(scored) == 240 and all(math.isclose(scored[i], m, abs_tol=1e-9) for i, m in margins.items())
    gains = {r["feature"]: r["gain"] for r in model.importance(spark).collect()}
    assert max(gains, key=gains.get) == "a"


def test_samples_follow_keys_not_partitions(spark):
    frame = spark.createDataFrame(rows_of(), SCHEMA)
    params = BoostParams(n_trees=2, max_depth=2, subsample=0.5, colsample=0.5)
    a = fit_boosted(frame, ["a", "b", "c"], "y", ["id"], params)
    b = fit_boosted(frame.repartition(7).sortWithinPartitions(F.desc("id")), ["a", "b", "c"], "y", ["id"], params)
    assert [(t.feature, t.bin, t.missing_left) for t in a.trees] == [(t.feature, t.bin, t.missing_left) for t in b.trees]
    drawn = frame.filter(boosting.in_sample(["id"], params, 0)).count()
    assert 80 < drawn < 160
    columns = [boosting.sampled_columns(10, BoostParams(colsample=0.3), t) for t in range(20)]
    assert all(len(c) == 3 for c in columns) and len({tuple(c) for c in columns}) > 5
    for t in a.trees:
        assert len({f for f in t.feature if f >= 0}) <= 2


def test_bins(spark):
    frame = spark.createDataFrame(rows_of(), SCHEMA).withColumn("many", F.col("id") * 1.0).withColumn("one", F.lit(4))
    edges = bin_edges(frame, ["b", "c", "many", "one"], 16)
    assert edges[0] == [0.5, 1.0, 1.5, 2.0] and edges[1] == [2.0, 7.0] and edges[3] == []
    assert 10 <= len(edges[2]) <= 15 and edges[2] == sorted(edges[2])
    for r in binned(frame, ["b", "c", "many", "one"], edges).collect():
        for j, x in enumerate((r["b"], r["c"], r["many"], r["one"])):
            assert r["_bins"][j] == (-1 if gone(x) else sum(e <= x for e in edges[j]))


def test_no_rows_and_constant_features(spark):
    frame = spark.createDataFrame(rows_of(), SCHEMA)
    empty = fit_boosted(frame.limit(0), ["a"], "y", ["id"])
    assert {r["p"] for r in empty.transform(frame, "p").collect()} == {0.0} and empty.nodes(spark).count() == 0
    flat = fit_boosted(frame.withColumn("k", F.lit(1.0)), ["k"], "y", ["id"], BoostParams(n_trees=2))
    assert [t.depth() for t in flat.trees] == [0, 0]
    mean = frame.agg(F.avg("y")).first()[0]
    assert all(math.isclose(r["prediction"], mean, abs_tol=1e-9) for r in flat.transform(frame.withColumn("k", F.lit(1.0))).collect())
    assert Tree.of_depth(2).depth() == 0


def test_tuning_keeps_the_least_loss(spark):
    frame = spark.createDataFrame(rows_of(), SCHEMA)
    tries = [{"n_trees": 1, "max_depth": 1, "learning_rate": 0.01}, {"n_trees": 6, "max_depth": 2}]
    model, losses, best = tune_boosted(frame, ["a", "b", "c"], ["id"], tries, label_col="y")
    assert best == 1 and losses[1][2] < losses[0][2] and len(model.trees) == 6
