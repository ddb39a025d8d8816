"""Learning rates by epoch, as closed forms or folds over a sequence of epochs."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def linear_factor(epoch: Column, n_epochs: int, n_decay: int, epoch_count: int = 1) -> Column:
    late = F.greatest(F.lit(0), epoch + epoch_count - n_epochs)
    return 1.0 - late / float(n_decay + 1)


def step_factor(epoch: Column, every: int, gamma: float = 0.1) -> Column:
    return F.pow(F.lit(gamma), F.floor(epoch / every))


def cosine_factor(epoch: Column, n_epochs: int) -> Column:
    """Falls to 0 at n_epochs and rises again after."""
    return (1 + F.cos(F.lit(math.pi) * epoch / n_epochs)) / 2


def plateau_rate(epoch: Column, lr: float, factor: float = 0.2, patience: int = 5) -> Column:
    """Rate after ``epoch`` steps on a metric that never improves after the first: it falls every patience + 1 steps."""
    start = F.struct(F.lit(float(lr)).alias("lr"), F.lit(0).alias("bad"))

    def step(state: Column, k: Column) -> Column:
        bad = F.when(k == 1, 0).otherwise(state["bad"] + 1)
        over = bad > patience
        return F.struct(F.when(over, state["lr"] * factor).otherwise(state["lr"]).alias("lr"), F.when(over, 0).otherwise(bad).alias("bad"))

    steps = F.when(epoch > 0, F.sequence(F.lit(1), epoch.cast("int"))).otherwise(F.array().cast("array<int>"))
    return F.aggregate(steps, start, step, lambda s: s["lr"])


def learning_rates(spark: SparkSession, policy: str, epochs: int, lr: float = 0.0002, n_epochs: int = 100, n_decay: int = 100, decay_iters: int = 50, epoch_count: int = 1) -> DataFrame:
    """(epoch, lr) for scheduler steps 0 .. epochs - 1; an unknown policy raises."""
    e = F.col("epoch")
    rates = {
        "linear": lr * linear_factor(e, n_epochs, n_decay, epoch_count),
        "step": lr * step_factor(e, decay_iters),
        "cosine": lr * cosine_factor(e, n_epochs),
        "plateau": plateau_rate(e, lr),
    }
    if policy not in rates:
        raise NotImplementedError(f"learning rate policy {policy}")
    return spark.range(epochs).select(F.col("id").cast("int").alias("epoch")).withColumn("lr", rates[policy])
