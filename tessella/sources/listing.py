"""Listing of image folders: paths only, so a plan ranks, pairs and cuts before anything is decoded."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import IMAGE_EXTENSIONS, base_name, frame_of, is_image, padded
from ..operators.ranking import dense_index, truncated


def require_directory(spark: SparkSession, path: str) -> None:
    """Raises unless the path is a directory, in any file system that Spark reads."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not system.exists(where) or not system.getFileStatus(where).isDirectory():
        raise NotADirectoryError(f"{path} is not a valid directory")


def files(spark: SparkSession, path: str, recursive: bool = True, glob: str | None = None) -> DataFrame:
    """(path) of regular files; the binary source without its content column opens none."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select("path")


def list_images(spark: SparkSession, root: str, max_size: int | None = None) -> DataFrame:
    """(idx, path) of images at any depth. The list is cut in component order and then ranked in string order."""
    require_directory(spark, root)
    found = files(spark, root).filter(is_image(base_name(F.col("path"))))
    return dense_index(truncated(found, "path", max_size), "path").select("idx", "path")


def image_folder(spark: SparkSession, root: str, loader: Callable[[SparkSession, str], DataFrame] | None = None) -> DataFrame:
    """As ``list_images``, but an empty folder raises; a loader (such as ``read_images``) adds what it reads by path."""
    found = list_images(spark, root)
    if found.isEmpty():
        raise RuntimeError(f"Found 0 images in: {root}; supported extensions are {', '.join(IMAGE_EXTENSIONS)}")
    return found if loader is None else found.join(loader(spark, root), "path")


def phase_images(spark: SparkSession, root: str, phase: str, domain: str = "AB", max_size: int | None = None) -> DataFrame:
    """(idx, path, phase, domain): a phase folder; unpaired data has one for each domain (trainA, trainB)."""
    folder = f"{root}/{phase}" + (domain if domain in ("A", "B") else "")
    return list_images(spark, folder, max_size).withColumns({"phase": F.lit(phase), "domain": F.lit(domain)})


def list_flat(spark: SparkSession, folder: str) -> DataFrame:
    """(idx, path) of .png and .jpg files (lower case) directly in a folder, by name."""
    require_directory(spark, folder)
    name = base_name(F.col("path"))
    found = files(spark, folder, recursive=False).filter(F.endswith(name, F.lit(".png")) | F.endswith(name, F.lit(".jpg")))
    return dense_index(found, "path").select("idx", "path")


def list_two_levels(spark: SparkSession, root: str, phase: str, suffix: str) -> DataFrame:
    """(idx, path) of {root}/{phase}/*/*{suffix}, sorted."""
    return dense_index(files(spark, f"{root}/{phase}/*/*{suffix}", recursive=False), "path").select("idx", "path")


def label_frames(spark: SparkSession, root: str, split: str) -> DataFrame:
    """(idx, city, frame) of label images, by city and file."""
    found = files(spark, f"{root}/gtFine/{split}/*/*labelIds.png", recursive=False)
    city = F.element_at(F.split("path", "/"), -2)
    return dense_index(found, "path").select("idx", city.alias("city"), frame_of(F.col("path")).alias("frame"))


def split_list(spark: SparkSession, root: str, split: str) -> DataFrame:
    """(city, id) of a split's text file; any split but train reads the validation list."""
    name = "train" if split == "train" else "val"
    lines = spark.read.text(f"{root}/ImageSets/segFine/{name}.txt").filter("value <> ''")
    part = F.split("value", "/")
    return lines.select(F.get(part, F.lit(0)).alias("city"), F.get(part, F.lit(1)).alias("id"))


def frame_path(root: str, split: str, city, idx):
    """Path of a frame by template."""
    return F.format_string(f"{root}/leftImg8bit_sequence/{split}/%s/%s_leftImg8bit.png", city, idx)


def frame_sequence(frames: DataFrame, root: str, length: int, frame: str = "frame") -> DataFrame:
    """Each labelled frame with it and the ``length`` frames before, in order: (frame, step, path)."""
    part = F.split(F.col(frame), "_")
    number = F.get(part, F.lit(2)).cast("int")
    rows = frames.withColumn("_at", F.explode(F.sequence(number - length, number)))
    city, shot = F.get(part, F.lit(0)), F.get(part, F.lit(1))
    path = F.concat_ws("", F.lit(f"{root}/leftImg8bit_sequence/val/"), city, F.lit("/"), city, F.lit("_"), shot, F.lit("_"), padded(F.col("_at"), 6), F.lit("_leftImg8bit.png"))
    return rows.select(frame, (F.col("_at") - number + length).alias("step"), path.alias("path"))
