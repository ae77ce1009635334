"""Run configuration: split points, lags, department and search spaces (control data)."""

from __future__ import annotations

import json
from dataclasses import dataclass, field


@dataclass(frozen=True)
class RunConfig:
    dept: str = "R"
    # group key columns of the monthly series
    keys: tuple[str, ...] = ("store_id",)
    lags: tuple[int, ...] = tuple(range(1, 13))
    # label 0 strictly before train_before, 2 strictly after test_after, else 1
    train_before: tuple[int, int] = (2000, 0)
    test_after: tuple[int, int] = (2000, 11)
    base_year: int = 1995
    # True: fill missing months (null sales) before the lags, so lag k is k calendar months
    calendar_lags: bool = False
    # tree learners split the indexed keys as categories (subsets of labels); False: as numbers (thresholds)
    nominal_keys: bool = True
    max_evals: int = 5
    seed: int = 42
    # how candidates are found: "random" (a seeded sample) or "parzen" (proposed from earlier losses, a batch at a time)
    search: str = "random"
    search_batch: int = 5
    # tree refit: "after" (winner only, once losses are known) or "speculative"
    tree_refit: str = "after"
    hp_space_rf: dict = field(default_factory=lambda: {
        "maxDepth": ["quniform", "int", 4, 10, 2],
        "maxBins": ["choice", 32, 64, 128],
        "numTrees": ["quniform", "int", 16, 48, 16],
        "minInstancesPerNode": ["choice", 1, 2, 4],
    })
    # Spark GBT limits depth to 30 and fits trees one after another, so the boosted-tree
    # space is expressed directly in Spark's parameters rather than a foreign library's.
    hp_space_gbt: dict = field(default_factory=lambda: {
        "maxIter": ["quniform", "int", 20, 40, 5],
        "maxDepth": ["quniform", "int", 3, 6, 1],
        "subsamplingRate": ["quniform", "float", 0.7, 0.9, 0.1],
        "stepSize": ["quniform", "float", 0.1, 0.3, 0.1],
        # column fraction per split (the per-node counterpart of a per-tree column sample)
        "featureSubsetStrategy": ["choice", "0.8", "0.9", "1.0"],
    })
    # second-order boosting: row and column samples are drawn per tree
    hp_space_boost: dict = field(default_factory=lambda: {
        "n_trees": ["quniform", "int", 8, 16, 4],
        "max_depth": ["quniform", "int", 2, 3, 1],
        "learning_rate": ["quniform", "float", 0.2, 0.4, 0.1],
        "subsample": ["quniform", "float", 0.7, 0.9, 0.1],
        "colsample": ["quniform", "float", 0.8, 1.0, 0.1],
    })
    hp_space_group: dict = field(default_factory=lambda: {
        "seasonality_prior_scale": ["choice", 0.25, 0.5, 1.0, 2.0, 4.0, 8.0],
    })
    hp_space_fourier: dict = field(default_factory=lambda: {
        "changepoint_prior_scale": ["choice", 0.1, 0.5, 2.0, 10.0],
        "seasonality_prior_scale": ["choice", 0.25, 0.5, 1.0, 2.0, 4.0, 8.0],
        "seasonality_mode": ["choice", "additive", "multiplicative"],
    })

    @property
    def split(self) -> dict:
        return {"train_before": {"year": self.train_before[0], "month": self.train_before[1]},
                "test_after": {"year": self.test_after[0], "month": self.test_after[1]}}


def load_config(path: str) -> RunConfig:
    """Load a JSON run config. Keys follow the dataclass fields; split points may be given
    as ``{"year": y, "month": m}``."""
    with open(path) as fh:
        raw = json.load(fh)
    kw = {}
    for key, value in raw.items():
        if isinstance(value, dict) and set(value) == {"year", "month"}:
            value = (int(value["year"]), int(value["month"]))
        elif isinstance(value, list) and key == "lags":
            value = tuple(int(v) for v in value)
        elif isinstance(value, list) and key == "keys":
            value = tuple(value)
        kw[key] = value
    return RunConfig(**kw)
