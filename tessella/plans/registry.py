"""Extension points: dataset modes, models and image loaders by name.

A dataset mode is a function (spark, config) -> DataFrame of samples; a model is a function that scores batches of them in
Arrow. Names are matched as in configuration files: without underscores, and without regard to case.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from .config import Config

Dataset = Callable[[SparkSession, Config], DataFrame]
Model = Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]

_datasets: dict[str, tuple[Dataset, dict]] = {}
_models: dict[str, tuple[Model, str, tuple[dict, dict]]] = {}


def _key(name: str, suffix: str) -> str:
    plain = name.replace("_", "").lower()
    return plain if plain.endswith(suffix) else plain + suffix


def register_dataset(name: str, options: dict | None = None):
    """Decorator: a dataset mode, and the options that it adds or changes."""

    def add(f: Dataset) -> Dataset:
        _datasets[_key(name, "dataset")] = f, options or {}
        return f

    return add


def register_model(name: str, schema: str, options: dict | None = None, training: dict | None = None):
    """Decorator: a model that maps batches of samples to rows of ``schema``."""

    def add(f: Model) -> Model:
        _models[_key(name, "model")] = f, schema, (options or {}, training or {})
        return f

    return add


def dataset(name: str) -> Dataset:
    try:
        return _datasets[_key(name, "dataset")][0]
    except KeyError:
        raise NotImplementedError(f"no dataset mode named {name}") from None


def scored(samples: DataFrame, name: str) -> DataFrame:
    """Samples through a registered model."""
    if _key(name, "model") not in _models:
        raise NotImplementedError(f"no model named {name}")
    f, schema, _ = _models[_key(name, "model")]
    return samples.mapInPandas(f, schema)


def option_layers() -> dict[str, dict]:
    """Layers of what is registered, for ``resolve(**option_layers())``."""
    short = lambda key, suffix: key.removesuffix(suffix)
    return {
        "models": {short(k, "model"): layers for k, (_, _, layers) in _models.items()},
        "datasets": {short(k, "dataset"): options for k, (_, options) in _datasets.items()},
    }
