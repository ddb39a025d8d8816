"""Transform pipelines from a preprocessing string, as a plan of steps over image rows."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ..functions import pixels
from .config import Config

SIDE = "struct<width:int,height:int,n_channels:int,pixels:binary,tensor:array<float>,crop_x:int,crop_y:int,flip:boolean>"
SIDE_TYPES = (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.float32()), pa.int32(), pa.int32(), pa.bool_())
SIDE_NAMES = ("width", "height", "n_channels", "pixels", "tensor", "crop_x", "crop_y", "flip")


def steps(preprocess: str, load: int, crop: int, flip: bool = True, gray: bool = False, shared: bool = True) -> list[tuple]:
    """The steps in order: gray, resize or scale width, crop, multiple of four, flip.

    The string is searched: 'resize' wins over 'scale_width', 'crop' stands for itself, only 'none' alone rounds sizes.
    With ``shared`` draws (crop_x, crop_y, flip columns of the row) a crop beyond the image is padded; without, it raises.
    """
    found: list[tuple] = [("gray",)] if gray else []
    if "resize" in preprocess:
        found.append(("resize", load, load))
    elif "scale_width" in preprocess:
        found.append(("scale_width", load, crop))
    if "crop" in preprocess:
        found.append(("crop" if shared else "crop_strictly", crop))
    if preprocess == "none":
        found.append(("four",))
    if flip:
        found.append(("flip",))
    return found


def applied(image, plan: list[tuple], row: dict):
    """An image after the plan's steps, with the row's draws."""
    for name, *args in plan:
        if name == "gray":
            image = pixels.luma(image)
        elif name == "resize":
            image = pixels.resized(image, *args)
        elif name == "scale_width":
            image = pixels.scaled_width(image, *args)
        elif name == "crop":
            image = pixels.cut(image, row["crop_x"], row["crop_y"], *args)
        elif name == "crop_strictly":
            image = pixels.cut_strictly(image, row["crop_x"], row["crop_y"], *args)
        elif name == "four":
            image = pixels.sized_by_four(image)
        elif name == "flip" and row["flip"]:
            image = pixels.mirrored(image)
    return image


def transformed(images: DataFrame, config: Config, gray: bool = False, shared: bool = True) -> DataFrame:
    """Image rows with crop_x, crop_y and flip columns, after the configuration's steps."""
    plan = steps(config.preprocess, config.load_size, config.crop_size, not config.no_flip, gray, shared)
    return pixels.over_images(images, lambda image, row: applied(image, plan, row), ("crop_x", "crop_y", "flip"))


def sampled(images: DataFrame, sides: dict[str, tuple[Callable | None, list[tuple]]], keep: list[str]) -> DataFrame:
    """Image rows with draws as samples: the columns to keep, and for each side what its steps make of (a part of) the image.

    All sides of a row are made in one pass: the last steps, tensor and normalisation, follow the plan's.
    """

    def run(batches):
        for b in batches:
            columns = [b.column(k).to_pylist() for k in range(7)]
            found: dict[str, list[list]] = {name: [[] for _ in SIDE_TYPES] for name in sides}
            for w, h, c, data, x, y, flip in zip(*columns, strict=True):
                whole = np.frombuffer(data, np.uint8).reshape(h, w, c)
                for name, (part, plan) in sides.items():
                    image = applied(part(whole) if part else whole, plan, {"crop_x": x, "crop_y": y, "flip": flip})
                    values = image.shape[1], image.shape[0], image.shape[2], np.ascontiguousarray(image).tobytes(), pixels.tensor(image).ravel(), x, y, flip
                    for column, value in zip(found[name], values, strict=True):
                        column.append(value)
            structs = [
                pa.StructArray.from_arrays([pa.array(v, t) for v, t in zip(found[name], SIDE_TYPES, strict=True)], list(SIDE_NAMES)) for name in sides
            ]
            yield pa.RecordBatch.from_arrays([*(b.column(7 + k) for k in range(len(keep))), *structs], [*keep, *sides])

    read = images.select("width", "height", "n_channels", "pixels", "crop_x", "crop_y", "flip", *keep)
    kept = ", ".join(f"`{c}` {images.schema[c].dataType.simpleString()}" for c in keep)
    return read.mapInArrow(run, f"{kept}, " + ", ".join(f"{name} {SIDE}" for name in sides))


def step_rows(spark, cases: dict[str, Config | tuple]) -> DataFrame:
    """(name, position, step): the pipelines that preprocessing strings stand for, one row for each step, tensor and normalise last."""
    rows = []
    for name, arguments in cases.items():
        plan = [step[0] for step in steps(*arguments)] + ["tensor", "normalise"]
        rows += [(name, k, step) for k, step in enumerate(plan)]
    return spark.createDataFrame(rows, "name string, position int, step string")
