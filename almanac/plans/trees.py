"""Tree regressors with time-ordered tuning (M2 random forest, M3 gradient-boosted trees).

Trees are fitted by MLlib (distributed over the executors). Tuning follows the split label,
not a random split: fit on label 0, score MAPE on label 1, refit the best parameters on
labels 0 and 1. Candidate fits are submitted from a small thread pool so several Spark jobs
run at once; only one scalar loss per candidate returns to the driver.
"""

from __future__ import annotations

from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almanac.functions.metrics import mape
from almanac.operators.encode import assemble, category_index, nominal_sizes
from almanac.operators.window import lag_names
from almanac.plans.parzen import search_one
from almanac.plans.tuning import _axis, candidate_grid
from almanac.session import ensure_checkpoint_dir, side_by_side
from almanac.sources.config import RunConfig

LABEL = "train_test_val_indicator"


def feature_cols(cfg: RunConfig = RunConfig()) -> list[str]:
    return [f"{k}_index" for k in cfg.keys] + ["month", "year"] + lag_names("sales", cfg.lags)


def model_frame(features: DataFrame, cfg: RunConfig = RunConfig()) -> DataFrame:
    """Index the key columns, assemble the feature vector, flag complete rows.

    Every row is kept. ``features_ok`` is false where a feature is null (the month after a zero-sales
    month has a null lag): such rows are left out of fitting and get a null tree prediction. A row
    whose own label is null is left out of fitting only.
    """
    df = features
    for k in cfg.keys:
        df = category_index(df, k, f"{k}_index")
        if not cfg.nominal_keys:  # a plain number, split at thresholds
            df = df.withColumn(f"{k}_index", F.col(f"{k}_index").alias(f"{k}_index", metadata={}))
    cols = feature_cols(cfg)
    ok = F.lit(True)
    for c in cols:
        ok = ok & F.col(c).isNotNull()
    df = df.withColumn("features_ok", ok)
    return assemble(df, cols, "features", handle_invalid="keep")


def scorer(model, prediction_col: str):
    """Model transform that leaves rows with incomplete features unpredicted (null)."""
    def apply(df: DataFrame) -> DataFrame:
        out = model.transform(df)
        return out.withColumn(prediction_col, F.when(F.col("features_ok"), F.col(prediction_col)))
    return apply


def check_bins(frame: DataFrame, bins: int, what: str) -> None:
    """Raise where a category of the feature vector has more values than a learner may have bins."""
    for name, labels in nominal_sizes(frame).items():
        if labels > bins:
            raise ValueError(f"{name} has {labels} labels but {what} allows {bins} (maxBins): raise maxBins, or set "
                             "nominal_keys=False to split the index as a number")


ESTIMATORS = {"RF": RandomForestRegressor, "GBT": GBTRegressor}


# Node-id caching pays off for deep forests (21.6 s -> 7.8 s per depth-20 fit) and costs
# time for shallow boosted trees (9.4 s vs 11.8 s), measured on the monthly frame.
CACHE_NODE_IDS = {"RF": True, "GBT": False}


def make_estimator(kind: str, label_col: str, prediction_col: str, seed: int):
    """Execution settings (not model parameters): for deep forests node ids are cached in an
    RDD checkpointed every 10 iterations to the checkpoint folder, so the growing trees are not
    shipped in every task closure. The per-task split-statistics budget stays at Spark's
    default (256 MB): with fits spread over several partitions a larger one gained nothing
    (19.6 s vs 18.9 s) and would multiply per-task memory. The fitted trees are unchanged."""
    return ESTIMATORS[kind](featuresCol="features", labelCol=label_col,
                            predictionCol=prediction_col, seed=seed,
                            cacheNodeIds=CACHE_NODE_IDS.get(kind, False), checkpointInterval=10)


def space_for(kind: str, cfg: RunConfig) -> dict:
    return cfg.hp_space_rf if kind == "RF" else cfg.hp_space_gbt


ROWS_PER_PARTITION = 50_000


# Fewest input partitions per learner: deep forests gain from spreading the per-level split
# statistics; shallow boosted trees run many small jobs and gain nothing on small frames.
MIN_FIT_PARTITIONS = {"RF": 4, "GBT": 1}


def spread_for_fit(frame: DataFrame, min_partitions: int = 1, keys: list[str] = ("store_id", "year", "month")) -> DataFrame:
    """Hash-partition the (small, reused) training frame by its row key and sort within
    partitions. Tree learners aggregate per-node split statistics through the input
    partitions; one partition would push every level through a single task. The number of
    partitions follows from the row count alone and the rows of a partition are sorted, so
    per-partition bootstrap sampling, and so the fitted trees, are the same on any cluster.
    """
    n = max(min_partitions, -(-frame.count() // ROWS_PER_PARTITION))
    return frame.repartition(n, *keys).sortWithinPartitions(*keys)


def tune_tree(frame: DataFrame, kind: str = "RF", cfg: RunConfig = RunConfig(),
              label_col: str = "sales", parallelism: int = 8, refit_max_label: int = 1,
              refit: str | None = None):
    """Returns ``(model refitted on labels <= refit_max_label, [(cand_id, params, validation
    MAPE)], best id)``. ``refit_max_label=0`` refits on the training slice only.

    ``refit="after"`` fits the winner again once the validation losses are known.
    ``refit="speculative"`` fits every candidate on the refit slice alongside the tuning fits
    and keeps the winner's: about 25 % less wall time for twice the fitting work (on the small
    monthly frame, never the fact table).

    Candidates are a seeded sample of the space (``cfg.search="random"``) or proposed batch by batch from the losses
    of those before (``"parzen"``, ``cfg.search_batch`` at a time).

    ``frame`` should be small and reused (the monthly feature frame); the slices are cached for
    the duration of the tuning and released afterwards.
    """
    refit = refit or cfg.tree_refit
    if refit not in ("after", "speculative"):
        raise ValueError("refit must be 'after' or 'speculative'")
    ensure_checkpoint_dir(frame.sparkSession)  # node-id cache checkpoints go to shared storage
    pred = f"{kind}_prediction"
    est = make_estimator(kind, label_col, pred, cfg.seed)
    if cfg.search not in ("random", "parzen"):
        raise ValueError("search must be 'random' or 'parzen'")
    if cfg.search == "parzen" and refit == "speculative":
        raise ValueError("a sequential search has no candidates to refit ahead")

    axis = _axis(space_for(kind, cfg)["maxBins"]) if "maxBins" in space_for(kind, cfg) else [est.getMaxBins()]
    check_bins(frame, min(axis), f"the {kind} search space")

    def params_of(cand):
        return {est.getParam(k): v for k, v in cand.items()}

    # the log of a zero-sales month is null: MLlib cannot fit such a label
    usable = frame.filter(F.col("features_ok") & F.col(label_col).isNotNull())
    spread, keys = MIN_FIT_PARTITIONS.get(kind, 1), [*cfg.keys, "year", "month"]
    train = spread_for_fit(usable.filter(F.col(LABEL) == 0), spread, keys).persist()
    valid = usable.filter(F.col(LABEL) == 1).persist()
    full = spread_for_fit(usable.filter(F.col(LABEL) <= refit_max_label), spread, keys)

    def loss_of(cand):
        return mape(est.copy(params_of(cand)).fit(train).transform(valid), label_col, pred)

    spark = frame.sparkSession
    try:
        models = {}
        if cfg.search == "parzen":
            losses = search_one(spark, space_for(kind, cfg), lambda cands: side_by_side(spark, loss_of, cands, parallelism),
                                cfg.max_evals, cfg.search_batch, cfg.seed)
        else:
            grid = candidate_grid(space_for(kind, cfg), cfg.max_evals, "random", cfg.seed)
            jobs = [(loss_of, c) for c in grid]
            if refit == "speculative":
                full = full.persist()
                jobs += [(lambda c: est.copy(params_of(c)).fit(full), c) for c in grid]
            done = side_by_side(spark, lambda job: job[0](job[1]), jobs, parallelism)
            losses = [(i, c, done[i]) for i, c in enumerate(grid)]
            models = dict(enumerate(done[len(grid):]))
        best = min(losses, key=lambda x: (x[2] is None, x[2] if x[2] is not None else 0.0, x[0]))[0]
        model = models[best] if best in models else est.copy(params_of(dict((i, c) for i, c, _ in losses)[best])).fit(full)
    finally:
        train.unpersist()
        valid.unpersist()
        full.unpersist()
    return model, losses, best
