"""Dense positions, truncation and caps over ordered lists.

A list's position is its identity in the data model, so ranks must be dense, global and cheap. A window without
partitions would sort everything in one task; instead, keys are dealt into ranges by boundaries from a sample, ranked
within their range, and shifted by the number of rows in the ranges before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Boundaries are drawn from about this many sampled keys.
SAMPLE_KEYS = 4096


def _range_of(key: Column, bounds: list, first: int = 0) -> Column:
    """The number of bounds that a key reaches: a balanced tree of comparisons."""
    if not bounds:
        return F.lit(first)
    mid = len(bounds) // 2
    return F.when(key >= F.lit(bounds[mid]), _range_of(key, bounds[mid + 1 :], first + mid + 1)).otherwise(_range_of(key, bounds[:mid], first))


def dense_index(df: DataFrame, key: str, name: str = "idx", range_rows: int = 500_000, most_ranges: int = 512) -> DataFrame:
    """``df`` with its 0-based rank by ``key``; equal keys get different ranks in no particular order.

    Ranges hold about ``range_rows`` rows, up to ``most_ranges`` ranges; beyond that they grow, and sorting them spills.
    """
    rows = df.count()
    ranges = max(32, min(most_ranges, rows // range_rows))
    every = max(1, rows // SAMPLE_KEYS)
    sampled = df.select(key).filter(F.pmod(F.xxhash64(key), F.lit(every)) == 0).distinct().limit(4 * SAMPLE_KEYS)
    keys = sorted(r[0] for r in sampled.collect() if r[0] is not None)
    bounds = sorted({keys[len(keys) * i // ranges] for i in range(1, ranges)}) if len(keys) >= ranges else []
    dealt = df.withColumn("_range", _range_of(F.col(key), bounds))
    sizes = {r["_range"]: r["count"] for r in dealt.groupBy("_range").count().collect()}  # at most ``ranges`` rows
    before = [0]
    for n in range(len(bounds)):
        before.append(before[-1] + sizes.get(n, 0))
    shift = F.get(F.array(*[F.lit(n).cast("long") for n in before]), F.col("_range"))
    rank = F.row_number().over(Window.partitionBy("_range").orderBy(F.col(key).asc_nulls_first())) - 1
    return dealt.withColumn(name, (rank + shift).cast("long")).drop("_range")


def path_key(path: str) -> Column:
    """The order in which the scan sorts paths: by components, not as strings ('a/x' before 'a-b/x')."""
    return F.split(F.col(path), "/")


def truncated(df: DataFrame, path: str, max_size: int | None) -> DataFrame:
    """The first ``max_size`` rows in component order, as the scan keeps them; None keeps all."""
    return df if max_size is None else df.orderBy(path_key(path)).limit(max_size)


def capped_batches(batches: DataFrame, batch_size: int, max_size: int | None) -> DataFrame:
    """Batches that an epoch yields: those with batch_id * batch_size below the cap."""
    return batches if max_size is None else batches.filter(F.col("batch_id") * batch_size < max_size)


def first_samples(df: DataFrame, num_test: int) -> DataFrame:
    """The first ``num_test`` samples by position."""
    return df.filter(F.col("idx") < num_test)
