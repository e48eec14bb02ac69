"""Models for the executors."""

from __future__ import annotations

import pickle
from collections.abc import Callable
from typing import TypeVar

from pyspark import cloudpickle
from pyspark.sql import SparkSession

Model = TypeVar("Model")


def send(spark: SparkSession, model: Model, keep: bool = True) -> Callable[[], Model]:
    """Broadcast a model of bounded size; tasks get it by calling what is returned.

    It is packed with the code of its classes, so executors need no copy of the package.
    Without ``keep`` a task reads the executor's file at each call and holds no packed copy.
    """
    packed = spark.sparkContext.broadcast(cloudpickle.dumps(model))

    def load() -> Model:
        path = None if keep else getattr(packed, "_path", None)
        return pickle.loads(packed.load_from_path(path) if path else packed.value)

    return load
