"""Categories in feature vectors, and months folded below the unpivot."""

import math
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from almanac.operators import assemble, category_index, nominal_sizes, unpivot
from almanac.plans import features, trees
from almanac.sources.config import RunConfig

LABEL = "train_test_val_indicator"


def stores(spark, n=6):
    """Every other store (by index) is high: no threshold on the index separates them."""
    rows = [(f"s{i:02d}", 2000 + j // 12, 1 + j % 12, 10.0 if i % 2 else 1.0, (j % 3) // 2) for i in range(n) for j in range(24)]
    return spark.createDataFrame(rows, f"store_id string, year int, month int, sales double, {LABEL} int")


def test_a_tree_splits_labels_into_subsets(spark):
    f = assemble(category_index(stores(spark), "store_id"), ["store_id_index"], "features")
    assert nominal_sizes(f) == {"store_id_index": 6}
    est = trees.make_estimator("RF", "sales", "p", 1)
    est = est.copy({est.maxDepth: 1, est.numTrees: 1, est.bootstrap: False})
    model = est.fit(f)
    assert {(r["sales"], r["p"]) for r in model.transform(f).collect()} == {(1.0, 1.0), (10.0, 10.0)}
    # the same index as a number cannot be cut into the two sets
    number = assemble(category_index(stores(spark), "store_id").withColumn("x", F.col("store_id_index") + 0), ["x"], "features")
    assert nominal_sizes(number) == {}
    assert len({r["p"] for r in est.fit(number).transform(number).collect()} & {1.0, 10.0}) < 2


def test_metadata_survives_the_frame_and_can_be_left_out(spark):
    cfg = replace(RunConfig(), lags=(1,))
    f = stores(spark).withColumn("lag_sales_1", F.col("sales"))
    assert nominal_sizes(trees.model_frame(f, cfg)) == {"store_id_index": 6}
    plain = trees.model_frame(f, replace(cfg, nominal_keys=False))
    assert nominal_sizes(plain) == {} and plain.count() == 144
    none = category_index(stores(spark).withColumn("store_id", F.lit(None).cast("string")), "store_id")
    assert {r["store_id_index"] for r in none.collect()} == {None}


def test_too_many_labels_are_an_error(spark):
    cfg = replace(RunConfig(), lags=(1,), hp_space_rf={"maxBins": ["choice", 4, 64], "maxDepth": ["choice", 2]})
    f = stores(spark).withColumn("lag_sales_1", F.col("sales"))
    with pytest.raises(ValueError, match="store_id_index has 6 labels"):
        trees.tune_tree(trees.model_frame(f, cfg), "RF", cfg)
    number = replace(cfg, nominal_keys=False)
    model, losses, _ = trees.tune_tree(trees.model_frame(f, number), "RF", number)
    assert len(losses) == 2 and model is not None


def test_months_folded_in_the_row_equal_the_unpivot(spark):
    days = [f"d_{k}" for k in range(1, 41)]
    rows = [(f"k{i % 3}", i % 2, *[None if (i * k) % 7 == 3 or (i == 4 and k < 32) else float(i * k % 11) for k in range(1, 41)]) for i in range(9)]
    wide = spark.createDataFrame(rows, "store string, `we ird` int, " + ", ".join(f"{d} double" for d in days))
    cal = features.calendar(spark, __import__("datetime").date(2024, 1, 1), 39)  # d_40 is not in the calendar
    twice = cal.unionByName(cal.filter("d = 'd_5'")).unionByName(cal.limit(1).withColumn("d", F.lit("d_99")))
    for keys in (["store"], ["store", "we ird"]):
        long = unpivot(wide.select(*keys, *days), keys, days)
        want = features.daily_monthly(long, twice, keys)
        got = features.fold_months(wide, twice.select("d", "year", "month"), keys, days)
        assert got.columns == want.columns

        def taken(df):
            return sorted(((*[r[k] for k in keys], r["year"], r["month"]), r["sales"]) for r in df.collect())
        a, b = taken(got), taken(want)
        assert [k for k, _ in a] == [k for k, _ in b] and len(a) == len(b) > 0
        assert all(x is y is None or math.isclose(x, y) for (_, x), (_, y) in zip(a, b))
    alone = wide.filter("d_1 IS NULL").limit(1).select("store", *[F.lit(None).cast("double").alias(d) for d in days])
    assert {r["sales"] for r in features.fold_months(alone, cal, ["store"], days).collect()} == {None}
    assert features.fold_months(wide, cal.limit(0), ["store"], days).collect() == []
    with pytest.raises(ValueError):
        features.fold_months(wide, cal, ["store"], [])
