"""Pipeline stages: any ``DataFrame -> DataFrame`` operator as a ``pyspark.ml`` Transformer.

    from pyspark.ml import Pipeline
    from pyspark.ml.feature import StringIndexer
    from almanac.stages import Stage
    from almanac import operators as ops, functions as fn

    model = Pipeline(stages=[
        Stage(ops.filter_rows, "dept_id = 'D1'"),
        Stage(ops.unpivot, ["item_id", "dept_id", "store_id"]),
        Stage(ops.join, calendar, {"df1_col": "day", "df2_col": "d"}),
        Stage(ops.group_agg, ["store_id", "year", "month"], {"sales": "sum"}),
        Stage(fn.log_cols, ["sales"]),
        Stage(ops.lag_features, "sales", ["store_id"], ["year", "month"], range(1, 13)),
        StringIndexer(inputCol="store_id", outputCol="store_id_index"),
    ]).fit(sales)

``FitModels`` is the Estimator that fits several learners side by side; the model it returns adds one
prediction column per learner. ``SelectBest`` is the Estimator that picks the learner of least loss; its
model turns scored rows into the winner's forecasts.

Every stage only adds to the lazy plan that Catalyst optimises whole, and pipelines of them, fitted or not, are saved
and loaded by the ML API's own ``write().save(path)`` and ``load(path)``: functions by module and name, frames and
per-group coefficients as parquet, MLlib models by their own writer, settings as JSON. A stage whose function has
no importable name (a lambda, say) or whose arguments are no plain values, frames or run configurations cannot be
saved and says so.
"""

from __future__ import annotations

import importlib
import json
from collections.abc import Callable

from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession

from almanac.plans import runner, selection
from almanac.plans.scorers import config_from_json, config_to_json, load_scorers, save_scorers
from almanac.session import cut_lineage
from almanac.sources.config import RunConfig


class _Writer(MLWriter):
    def __init__(self, instance):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        said = self.instance._said(path)
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession, extraMetadata={"said": json.dumps(said)})


class _Reader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str):
        found = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        instance = self.cls._of(self.sparkSession, json.loads(found["said"]), path)
        instance._resetUid(found["uid"])
        return instance


class Saved(MLWritable, MLReadable):
    """Persistence of a stage: ``_said(path)`` writes its data and returns its settings, ``_of`` makes it from both."""

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls)


def _pack(value, path: str, frames: list):
    """A value as JSON; frames are written beside it."""
    if value is None or isinstance(value, (bool, int, float, str)):
        return value
    if isinstance(value, DataFrame):
        frames.append(value)
        value.write.parquet(f"{path}/frame-{len(frames) - 1}")
        return {"frame": len(frames) - 1}
    if isinstance(value, RunConfig):
        return {"config": config_to_json(value)}
    if isinstance(value, range):
        return {"range": [value.start, value.stop, value.step]}
    if isinstance(value, (list, tuple)):
        return {"tuple" if isinstance(value, tuple) else "list": [_pack(v, path, frames) for v in value]}
    if isinstance(value, dict) and all(isinstance(k, str) for k in value):
        return {"dict": {k: _pack(v, path, frames) for k, v in value.items()}}
    raise TypeError(f"an argument of type {type(value).__name__} cannot be saved")


def _unpack(value, path: str, spark: SparkSession):
    if not isinstance(value, dict):
        return value
    (kind, inner), = value.items()
    if kind == "frame":
        return spark.read.parquet(f"{path}/frame-{inner}")
    if kind == "config":
        return config_from_json(inner)
    if kind == "range":
        return range(*inner)
    if kind == "dict":
        return {k: _unpack(v, path, spark) for k, v in inner.items()}
    found = [_unpack(v, path, spark) for v in inner]
    return tuple(found) if kind == "tuple" else found


def _named(fn: Callable) -> tuple[str, str]:
    """Module and name a function can be imported by."""
    module, name = getattr(fn, "__module__", None), getattr(fn, "__qualname__", "")
    if not module or module == "__main__" or getattr(importlib.import_module(module), name, None) is not fn:
        raise TypeError(f"{fn!r} cannot be saved: it has no importable name")
    return module, name


class Stage(Transformer, Saved):
    """Transformer calling ``fn(df, *args, **kwargs)``."""

    def __init__(self, fn: Callable[..., DataFrame], *args, **kwargs):
        super().__init__()
        self._fn, self._args, self._kwargs = fn, args, kwargs

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self._fn(dataset, *self._args, **self._kwargs)

    def _said(self, path: str) -> dict:
        module, name = _named(self._fn)
        frames: list = []
        return {"module": module, "name": name, "args": _pack(list(self._args), path, frames),
                "kwargs": _pack(self._kwargs, path, frames)}

    @classmethod
    def _of(cls, spark: SparkSession, said: dict, path: str) -> Stage:
        fn = getattr(importlib.import_module(said["module"]), said["name"])
        return cls(fn, *_unpack(said["args"], path, spark), **_unpack(said["kwargs"], path, spark))

    def __repr__(self) -> str:
        return f"Stage({getattr(self._fn, '__name__', self._fn)!r})"


class FitModels(Estimator, Saved):
    """Fits ``models`` on a monthly feature frame (vectors included where tree learners need them)."""

    def __init__(self, models=runner.SQL_MODELS, cfg: RunConfig = RunConfig(), cutoff: dict | None = None):
        super().__init__()
        self._models, self._cfg, self._cutoff = tuple(models), cfg, cutoff

    def _fit(self, dataset: DataFrame) -> Model:
        return FittedModels(runner.fit_all(dataset, self._models, self._cfg, cutoff=self._cutoff))

    def _said(self, path: str) -> dict:
        return {"models": list(self._models), "cfg": config_to_json(self._cfg), "cutoff": self._cutoff}

    @classmethod
    def _of(cls, spark: SparkSession, said: dict, path: str) -> FitModels:
        return cls(said["models"], config_from_json(said["cfg"]), said["cutoff"])


class FittedModels(Model, Saved):
    """Adds ``{name}_prediction`` for every fitted learner."""

    def __init__(self, scorers):
        super().__init__()
        self.scorers = scorers

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return selection.score_all(dataset, self.scorers)

    def _said(self, path: str) -> dict:
        return {"scorers": save_scorers(self.scorers, path)}

    @classmethod
    def _of(cls, spark: SparkSession, said: dict, path: str) -> FittedModels:
        return cls(load_scorers(spark, said["scorers"], path))


class SelectBest(Estimator, Saved):
    """Chooses the learner of least loss on a split of a scored frame."""

    def __init__(self, models=runner.SQL_MODELS, split: str = "test", cfg: RunConfig = RunConfig()):
        super().__init__()
        self._models, self._split, self._cfg = list(models), split, cfg

    def _fit(self, dataset: DataFrame) -> Model:
        losses = cut_lineage(selection.model_losses(dataset, self._models))
        return SelectedModel(self._models, losses, selection.best_model(losses, self._split), self._cfg)

    def _said(self, path: str) -> dict:
        return {"models": self._models, "split": self._split, "cfg": config_to_json(self._cfg)}

    @classmethod
    def _of(cls, spark: SparkSession, said: dict, path: str) -> SelectBest:
        return cls(said["models"], said["split"], config_from_json(said["cfg"]))


class SelectedModel(Model, Saved):
    """The winner's predictions of the rows given: ``keys, year, month, label, sales, model_name, prediction``."""

    def __init__(self, models, losses: DataFrame, best: DataFrame, cfg: RunConfig):
        super().__init__()
        self.models, self.losses, self.best, self._cfg = models, losses, best, cfg

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return selection.best_predictions(dataset, self.models, self.best, [*self._cfg.keys, "year", "month"])

    def _said(self, path: str) -> dict:
        self.losses.write.parquet(f"{path}/losses")
        self.best.write.parquet(f"{path}/best")
        return {"models": self.models, "cfg": config_to_json(self._cfg)}

    @classmethod
    def _of(cls, spark: SparkSession, said: dict, path: str) -> SelectedModel:
        return cls(said["models"], spark.read.parquet(f"{path}/losses"), spark.read.parquet(f"{path}/best"),
                   config_from_json(said["cfg"]))
