"""Decoding to RGB rows (path, width, height, n_channels, pixels).

PNG, JPEG, BMP and TIFF go through Spark's image source, whose channel order is turned; PPM, which it does not know, is
parsed here. A file that cannot be decoded raises instead of vanishing.
"""

from __future__ import annotations

import re
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROW = "path string, width int, height int, n_channels int, pixels binary"
HEADER = re.compile(rb"P6(?:\s|#[^\n]*\n)+(\d+)(?:\s|#[^\n]*\n)+(\d+)(?:\s|#[^\n]*\n)+(\d+)\s")


def _row(path, image: np.ndarray):
    return path, image.shape[1], image.shape[0], 3, np.ascontiguousarray(image).tobytes()


def _batch(rows) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.binary())
    columns = list(zip(*rows, strict=True)) or [()] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["path", "width", "height", "n_channels", "pixels"])


def parse_ppm(content: bytes) -> np.ndarray:
    """RGB of a binary PPM with one byte for each sample."""
    m = HEADER.match(content)
    if not m or int(m[3]) != 255:
        raise ValueError("not a binary PPM of depth 255")
    w, h = int(m[1]), int(m[2])
    return np.frombuffer(content, np.uint8, w * h * 3, m.end()).reshape(h, w, 3)


def _from_source(batches):
    for b in batches:
        rows = []
        for path, w, h, c, data in zip(*(b.column(k).to_pylist() for k in range(5)), strict=True):
            if w is None or w < 0:
                raise ValueError(f"cannot decode {path}")
            image = np.frombuffer(data, np.uint8).reshape(h, w, c)
            rows.append(_row(path, np.repeat(image, 3, axis=2) if c == 1 else image[..., 2::-1]))
        yield _batch(rows)


def _from_ppm(batches):
    for b in batches:
        yield _batch([_row(p, parse_ppm(c)) for p, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)])


def read_images(spark: SparkSession, root: str | list[str], recursive: bool = True) -> DataFrame:
    """All images below a root, or those of a list of paths, decoded."""
    look = str(recursive).lower()
    names = "*.{jpg,JPG,jpeg,JPEG,png,PNG,bmp,BMP,tif,TIF,tiff,TIFF}"
    is_ppm = lambda path: path.endswith((".ppm", ".PPM"))
    common = root if isinstance(root, str) else [p for p in root if not is_ppm(p)]
    ppm = root if isinstance(root, str) else [p for p in root if is_ppm(p)]
    parts = []
    if common:
        found = spark.read.format("image").option("recursiveFileLookup", look).option("pathGlobFilter", names).load(common)
        parts.append(found.select("image.origin", "image.width", "image.height", "image.nChannels", "image.data").mapInArrow(_from_source, ROW))
    if ppm:
        found = spark.read.format("binaryFile").option("recursiveFileLookup", look).option("pathGlobFilter", "*.{ppm,PPM}").load(ppm)
        parts.append(found.select("path", "content").mapInArrow(_from_ppm, ROW))
    both = reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], ROW)
    return both.withColumn("path", F.regexp_replace("path", "^file:/+", "file:/"))  # as listings spell it


def decoded(spark: SparkSession, listing: DataFrame, root: str, by_name: int = 10_000) -> DataFrame:
    """A (possibly cut and paired) listing with its images. Of at most ``by_name`` listed files only these are opened, by name, and
    pixels are not shuffled; a longer list is joined to all images below its root."""
    paths = [r.path for r in listing.select("path").distinct().limit(by_name + 1).collect()]
    if len(paths) > by_name:
        return listing.join(read_images(spark, root), "path")
    literal = [re.sub(r"([\\\[\]{}*?])", r"\\\1", p) for p in paths]
    return read_images(spark, literal).join(F.broadcast(listing), "path").select(*listing.columns, "width", "height", "n_channels", "pixels")


def labels(images: DataFrame, mapping: dict[int, int] | None = None) -> DataFrame:
    """Long form (path, y, x, label) of label images (first channel), relabelled in the map's order, as bytes."""

    def run(batches):
        for b in batches:
            for path, w, h, c, data in zip(*(b.column(k).to_pylist() for k in range(5)), strict=True):
                v = np.frombuffer(data, np.uint8).reshape(h, w, c)[..., 0].astype(np.int64)
                for k, to in (mapping or {}).items():
                    v[v == k] = to
                y, x = np.divmod(np.arange(w * h), w)
                columns = [pa.array([path] * (w * h)), pa.array(y.astype(np.int32)), pa.array(x.astype(np.int32)), pa.array((v.ravel() % 256).astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, ["path", "y", "x", "label"])

    return images.select("path", "width", "height", "n_channels", "pixels").mapInArrow(run, "path string, y int, x int, label int")
