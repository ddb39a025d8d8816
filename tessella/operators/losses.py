"""Loss reductions over tensor columns (arrays) and loss columns, all native.

A mean is taken over all elements of all rows, which differs from the mean of row means if sizes differ.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def element_mean(values: Column) -> Column:
    """Aggregate: mean over all elements of an array column."""
    return F.sum(_total(values)) / F.sum(F.size(values))


def _doubles(name: str) -> Column:
    return F.transform(F.col(name), lambda x: x.cast("double"))


def l1(a: str, b: str, weight: float = 1.0) -> Column:
    return element_mean(F.zip_with(_doubles(a), _doubles(b), lambda x, y: F.abs(x - y))) * weight


def lsgan(prediction: str, real: bool) -> Column:
    target = 1.0 if real else 0.0
    return element_mean(F.transform(_doubles(prediction), lambda p: (p - target) * (p - target)))


def bce_with_logits(prediction: str, real: bool) -> Column:
    """The stable form: max(x, 0) - x * t + log1p(exp(-|x|))."""
    target = 1.0 if real else 0.0
    return element_mean(F.transform(_doubles(prediction), lambda x: F.greatest(x, F.lit(0.0)) - x * target + F.log1p(F.exp(-F.abs(x)))))


def wgan(prediction: str, real: bool) -> Column:
    mean = element_mean(_doubles(prediction))
    return -mean if real else mean


def gan_loss(mode: str, prediction: str, real: bool) -> Column:
    """The adversarial loss by its mode's name."""
    found = {"lsgan": lsgan, "vanilla": bce_with_logits, "wgangp": wgan}
    if mode not in found:
        raise NotImplementedError(f"gan mode {mode}")
    return found[mode](prediction, real)


def gradient_penalty(gradient: str, constant: float = 1.0, weight: float = 10.0) -> Column:
    """Aggregate over rows of given gradients: mean of (norm - constant) ** 2; the norm is of the gradient plus 1e-16."""
    shifted = F.transform(_doubles(gradient), lambda g: (g + 1e-16) * (g + 1e-16))
    norm = F.sqrt(_total(shifted))
    return F.avg((norm - constant) * (norm - constant)) * weight


def discriminator_loss(real: Column, fake: Column) -> Column:
    return (real + fake) * 0.5


def identity_loss(l1_loss: Column, weight_other: float, weight_identity: float) -> Column:
    """Identity loss of one direction: weighed by the other direction's cycle weight; 0 without identity weight."""
    return l1_loss * weight_other * weight_identity if weight_identity > 0 else F.lit(0.0)


def generator_loss(*parts: Column) -> Column:
    total = parts[0]
    for p in parts[1:]:
        total = total + p
    return total


def array_stats(df: DataFrame, value: str, *by: str) -> DataFrame:
    """Mean, min, max, median and population deviation."""
    v = F.col(value)
    return df.groupBy(*by).agg(F.avg(v).alias("mean"), F.min(v).alias("min"), F.max(v).alias("max"), F.median(v).alias("median"), F.stddev_pop(v).alias("std"))


def mean_gradient(df: DataFrame, gradient: str) -> DataFrame:
    """Mean over parameters (rows) of the mean absolute gradient: unweighted, whatever the parameters' sizes."""
    per = _total(F.transform(_doubles(gradient), lambda g: F.abs(g))) / F.size(gradient)
    return df.agg(F.coalesce(F.avg(per), F.lit(0.0)).alias("mean_gradient"))


def parameter_millions(df: DataFrame, numel: str, *by: str) -> DataFrame:
    return df.groupBy(*by).agg(F.format_string("%.3f", F.sum(numel) / 1e6).alias("millions"))
