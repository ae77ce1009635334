"""Fitted learners as values that can be called on a frame, saved and loaded.

Every scorer adds ``{name}_prediction``. Per-group models are saved as parquet tables of their coefficients, MLlib
models by their own writer, boosted trees and settings as JSON: nothing is pickled, and a saved scorer needs only a
store that Spark can write to.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, fields

from pyspark.ml.util import DefaultParamsReader
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.plans import boosting, group_model, trees
from almanac.plans.fourier import score_fourier
from almanac.sources.config import RunConfig


def config_to_json(cfg: RunConfig) -> dict:
    return asdict(cfg)


def config_from_json(raw: dict) -> RunConfig:
    """The configuration; JSON has turned its tuples into lists."""
    kinds = {f.name: getattr(RunConfig(), f.name) for f in fields(RunConfig)}
    return RunConfig(**{k: tuple(v) if isinstance(kinds[k], tuple) else v for k, v in raw.items()})


@dataclass
class Lagged:
    """Baseline: a lagged actual value."""
    name: str
    lag_col: str

    def __call__(self, df: DataFrame) -> DataFrame:
        return df.withColumn(f"{self.name}_prediction", F.col(self.lag_col))

    def save(self, path: str) -> dict:
        return {"lag_col": self.lag_col}

    @classmethod
    def load(cls, spark: SparkSession, path: str, name: str, said: dict) -> Lagged:
        return cls(name, said["lag_col"])


@dataclass
class PerGroup:
    """A table with one row of coefficients per group."""
    name: str
    model: DataFrame
    cfg: RunConfig

    def save(self, path: str) -> dict:
        self.model.write.parquet(f"{path}/model")
        return {"cfg": config_to_json(self.cfg)}

    @classmethod
    def load(cls, spark: SparkSession, path: str, name: str, said: dict):
        return cls(name, spark.read.parquet(f"{path}/model"), config_from_json(said["cfg"]))


class TrendAndMonths(PerGroup):
    """The trend and month effects of :mod:`almanac.plans.group_model`."""

    def __call__(self, df: DataFrame) -> DataFrame:
        return group_model.group_forecast(df, self.model, list(self.cfg.keys), f"{self.name}_prediction", self.cfg)


class PiecewiseFourier(PerGroup):
    """The piecewise trend and Fourier terms of :mod:`almanac.plans.fourier`."""

    def __call__(self, df: DataFrame) -> DataFrame:
        return score_fourier(df, self.model, self.cfg, prediction_col=f"{self.name}_prediction")


@dataclass
class Forest:
    """An MLlib tree ensemble; rows with incomplete features stay unpredicted."""
    name: str
    model: object

    def __call__(self, df: DataFrame) -> DataFrame:
        return trees.scorer(self.model, f"{self.name}_prediction")(df)

    def save(self, path: str) -> dict:
        self.model.write().save(f"{path}/model")
        return {}

    @classmethod
    def load(cls, spark: SparkSession, path: str, name: str, said: dict) -> Forest:
        return cls(name, DefaultParamsReader.loadParamsInstance(f"{path}/model", spark))


@dataclass
class Boosted:
    """Second-order boosted trees."""
    name: str
    model: boosting.BoostedModel

    def __call__(self, df: DataFrame) -> DataFrame:
        return self.model.transform(df, f"{self.name}_prediction")

    def save(self, path: str) -> dict:
        return {"model": asdict(self.model)}

    @classmethod
    def load(cls, spark: SparkSession, path: str, name: str, said: dict) -> Boosted:
        raw = dict(said["model"])
        raw["params"] = boosting.BoostParams(**raw["params"])
        raw["trees"] = [boosting.Tree(**t) for t in raw["trees"]]
        return cls(name, boosting.BoostedModel(**raw))


KINDS = {c.__name__: c for c in (Lagged, TrendAndMonths, PiecewiseFourier, Forest, Boosted)}


def save_scorers(scorers: list[tuple[str, object]], path: str) -> list[dict]:
    """Write every scorer's data under ``path``; returns what to keep as text beside it."""
    kept = []
    for i, (name, scorer) in enumerate(scorers):
        if type(scorer).__name__ not in KINDS:
            raise TypeError(f"scorer {name!r} ({type(scorer).__name__}) cannot be saved")
        kept.append({"name": name, "kind": type(scorer).__name__, "said": json.dumps(scorer.save(f"{path}/scorer-{i}"))})
    return kept


def load_scorers(spark: SparkSession, kept: list[dict], path: str) -> list[tuple[str, object]]:
    return [(k["name"], KINDS[k["kind"]].load(spark, f"{path}/scorer-{i}", k["name"], json.loads(k["said"]))) for i, k in enumerate(kept)]
