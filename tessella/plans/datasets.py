"""The built-in dataset modes: from folders to paired, drawn and decoded samples. Paths are paired and cut first, decoded last.

A side of a sample is a struct: the transformed image (width, height, n_channels, pixels), its ``tensor`` (CHW floats in [-1, 1])
and its draws crop_x, crop_y and flip. An ``extra`` entry ``first`` of the configuration keeps the first samples by position.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import pixels
from ..operators.epochs import crop_and_flip
from ..operators.pairing import cyclic_pairs, random_pairs
from ..operators.ranking import first_samples
from ..sources.images import decoded
from ..sources.listing import list_images, phase_images
from .config import INF, Config
from .registry import register_dataset
from .transforms import sampled, steps, transformed


def _cap(config: Config) -> int | None:
    return None if config.max_dataset_size == INF else int(config.max_dataset_size)


def _first(rows: DataFrame, config: Config) -> DataFrame:
    return first_samples(rows, config.extra["first"]) if "first" in config.extra else rows


def _drawn(rows: DataFrame, config: Config, width=None, salt: int = 0) -> DataFrame:
    at = rows if "epoch" in rows.columns else rows.withColumn("epoch", F.lit(0))
    size = F.col("width") if width is None else width
    return crop_and_flip(at, size, F.col("height"), config.preprocess, config.load_size, config.crop_size, not config.no_flip, salt)


def _channels(config: Config) -> tuple[int, int]:
    """Channels of domains A and B: those of input and output, as the direction has it."""
    both = config.input_nc, config.output_nc
    return both if config.direction == "AtoB" else both[::-1]


def _plan(config: Config, channels: int, shared: bool = False) -> list[tuple]:
    return steps(config.preprocess, config.load_size, config.crop_size, not config.no_flip, channels == 1, shared)


@register_dataset("aligned")
def aligned(spark: SparkSession, config: Config) -> DataFrame:
    """(idx, path, a, b): both halves of each image, input and target by direction, with the same draws; one pass over the images."""
    folder = f"{config.dataroot}/{config.phase}"
    listing = _first(phase_images(spark, config.dataroot, config.phase, "AB", _cap(config)), config)
    whole = _drawn(decoded(spark, listing, folder), config, F.floor(F.col("width") / 2).cast("int"))
    names = ("a", "b") if config.direction == "AtoB" else ("b", "a")
    halves = [(lambda image, k=k: pixels.split_pair(image)[k], _plan(config, n, shared=True)) for k, n in enumerate(_channels(config))]
    return sampled(whole, dict(sorted(zip(names, halves, strict=True))), ["idx", "path"])


@register_dataset("unaligned")
def unaligned(spark: SparkSession, config: Config) -> DataFrame:
    """(idx, a_path, b_path, a, b): cyclic pairs, or random partners; each side has draws of its own."""
    listed = [phase_images(spark, config.dataroot, config.phase, d, _cap(config)).select("idx", "path") for d in "AB"]
    pairs = out = _first((cyclic_pairs if config.serial_batches else random_pairs)(*listed), config)
    for salt, (d, channels) in enumerate(zip("ab", _channels(config), strict=True)):
        listing = pairs.select("idx", F.col(f"{d}_path").alias("path"))
        side = decoded(spark, listing, f"{config.dataroot}/{config.phase}{d.upper()}")
        done = sampled(_drawn(side, config, salt=1000 + salt), {d: (None, _plan(config, channels))}, ["idx"])
        out = out.join(done, "idx")
    return out.select("idx", "a_path", "b_path", "a", "b")


@register_dataset("single")
def single(spark: SparkSession, config: Config) -> DataFrame:
    """(idx, path, a): one side only."""
    rows = decoded(spark, _first(list_images(spark, config.dataroot, _cap(config)), config), config.dataroot)
    return sampled(_drawn(rows, config), {"a": (None, _plan(config, _channels(config)[0]))}, ["idx", "path"])


@register_dataset("template", {"new_dataset_option": 2.0, "max_dataset_size": 10})
def template(spark: SparkSession, config: Config) -> DataFrame:
    """(idx, path, data_a, data_b): an example to start from, which gives each image as both sides."""
    rows = decoded(spark, _first(list_images(spark, config.dataroot, _cap(config)), config), config.dataroot)
    both = {name: (None, _plan(config, n)) for name, n in zip(("data_a", "data_b"), _channels(config), strict=True)}
    return sampled(_drawn(rows, config), both, ["idx", "path"])


@register_dataset("colorization")
def colorization(spark: SparkSession, config: Config) -> DataFrame:
    """(idx, path, light, colour): L and ab tensors of each image, CHW."""
    if (config.input_nc, config.output_nc, config.direction) != (1, 2, "AtoB"):
        raise ValueError("colorization is from 1 to 2 channels, A to B")
    listing = _first(phase_images(spark, config.dataroot, config.phase, "AB", _cap(config)), config)
    rows = decoded(spark, listing, f"{config.dataroot}/{config.phase}")
    done = transformed(_drawn(rows, config), config, shared=False)

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            light, colour = [], []
            for w, h, c, data in zip(*(b.column(k).to_pylist() for k in range(2, 6)), strict=True):
                x, y = pixels.lab_pair(np.frombuffer(data, np.uint8).reshape(h, w, c))
                light.append(x.ravel().tolist())
                colour.append(y.ravel().tolist())
            kind = pa.list_(pa.float32())
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in range(4)), pa.array(light, kind), pa.array(colour, kind)], ["idx", "path", "width", "height", "light", "colour"])

    kept = done.select("idx", "path", "width", "height", "n_channels", "pixels")
    return kept.mapInArrow(run, "idx long, path string, width int, height int, light array<float>, colour array<float>")
