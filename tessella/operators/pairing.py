"""The pairing disciplines, as joins on positions or names. Inputs carry dense positions ``idx`` (see ranking)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .draws import mixed


def _renamed(df: DataFrame, prefix: str) -> DataFrame:
    return df.select([F.col(c).alias(f"{prefix}_{c}") for c in df.columns])


def cyclic_pairs(a: DataFrame, b: DataFrame) -> DataFrame:
    """Row i of max(|A|, |B|) pairs A[i mod |A|] with B[i mod |B|]."""
    n_a, n_b = a.count(), b.count()
    if not n_a or not n_b:
        raise ValueError("cyclic pairing needs rows on both sides")
    epoch = a.sparkSession.range(max(n_a, n_b)).withColumnRenamed("id", "idx")
    at = epoch.withColumn("a_idx", F.pmod("idx", F.lit(n_a))).withColumn("b_idx", F.pmod("idx", F.lit(n_b)))
    return at.join(_renamed(a, "a"), "a_idx").join(_renamed(b, "b"), "b_idx")


def drawn(idx: Column, epoch: int, n: int, salt: int = 0) -> Column:
    """An index below n for each position and epoch."""
    return F.pmod(mixed(idx, epoch, 1000 + salt), F.lit(n))


def random_pairs(a: DataFrame, b: DataFrame, epoch: int = 0) -> DataFrame:
    """As cyclic pairs, but B is drawn for each row, with replacement."""
    n_a, n_b = a.count(), b.count()
    if not n_a or not n_b:
        raise ValueError("random pairing needs rows on both sides")
    rows = a.sparkSession.range(max(n_a, n_b)).withColumnRenamed("id", "idx")
    at = rows.withColumn("a_idx", F.pmod("idx", F.lit(n_a))).withColumn("b_idx", drawn(F.col("idx"), epoch, n_b))
    return at.join(_renamed(a, "a"), "a_idx").join(_renamed(b, "b"), "b_idx")


def positional_pairs(a: DataFrame, b: DataFrame) -> DataFrame:
    """A[i] with B[i]; both sides must have as many rows. The pair's file name is the position on four digits."""
    n_a, n_b = a.count(), b.count()
    if n_a != n_b:
        raise ValueError(f"positional pairing needs equal counts, not {n_a} and {n_b}")
    pairs = _renamed(a, "a").join(_renamed(b, "b"), F.col("a_idx") == F.col("b_idx"))
    return pairs.withColumn("idx", F.col("a_idx")).withColumn("name", F.format_string("%04d.jpg", "idx")).drop("a_idx", "b_idx")


def same_size(pairs: DataFrame) -> DataFrame:
    """Pairs whose images have the same size; another pair raises when it is read."""
    equal = (F.col("a_width") == F.col("b_width")) & (F.col("a_height") == F.col("b_height"))
    checked = F.when(equal, F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("sizes differ at "), F.col("idx").cast("string"))).cast("boolean"))
    return pairs.filter(checked)


def name_pairs(a: DataFrame, b: DataFrame, suffixed: bool = True, max_images: int | None = None) -> DataFrame:
    """Rows (split, name) of A with the row of B of the same split and derived name; those without partner go.

    ``suffixed`` names end in _A. and _B. and the pair's name in neither. The cut by ``max_images`` comes first, for each
    split, in name order (a directory has no order of its own).
    """
    left = a.filter(F.col("name").contains("_A.")) if suffixed else a
    if max_images is not None:
        from pyspark.sql import Window

        rank = F.row_number().over(Window.partitionBy("split").orderBy("name"))
        left = left.withColumn("_n", rank).filter(F.col("_n") <= max_images).drop("_n")
    name_b = F.replace(F.col("name"), F.lit("_A."), F.lit("_B.")) if suffixed else F.col("name")
    pair = F.replace(F.col("name"), F.lit("_A."), F.lit(".")) if suffixed else F.col("name")
    keyed = left.withColumn("b_name", name_b).withColumn("pair_name", pair)
    right = b.select("split", F.col("name").alias("b_name"))
    return keyed.join(right, ["split", "b_name"], "left_semi").select("split", F.col("name").alias("a_name"), "b_name", "pair_name")


def frame_id(path: Column, suffix: str) -> Column:
    """Base name of a path without the suffix of its kind."""
    base = F.element_at(F.split(path, "/"), -1)
    return F.replace(F.regexp_replace(base, r"\.[^.]*$", ""), F.lit(suffix), F.lit(""))


def checked_pairs(maps: DataFrame, photos: DataFrame, map_suffix: str = "_gtFine_color", photo_suffix: str = "_leftImg8bit") -> DataFrame:
    """Positional pairs (idx, path on each side) whose identifiers must agree; one that doesn't raises when it is read."""
    pairs = positional_pairs(maps.select("idx", "path"), photos.select("idx", "path"))
    a, b = frame_id(F.col("a_path"), map_suffix), frame_id(F.col("b_path"), photo_suffix)
    wrong = F.raise_error(F.concat(F.lit("no pair: "), F.col("a_path"), F.lit(" and "), F.col("b_path"))).cast("string")
    return pairs.withColumn("frame", F.when(a == b, a).otherwise(wrong)).drop("name")


def gather(rows: DataFrame, samples: DataFrame) -> DataFrame:
    """Samples in the order of an epoch plan: its rows joined to samples by ``idx``."""
    return rows.join(samples, "idx")


def looked_up(df: DataFrame, column: str, mapping: dict[int, int], name: str) -> DataFrame:
    """``df`` with the value that a small map has for ``column``; null where it has none."""
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    return df.withColumn(name, F.element_at(F.create_map(*pairs), F.col(column)) if pairs else F.lit(None).cast("int"))


def predictions_for(truth: DataFrame, predictions: DataFrame, frame: str = "frame") -> DataFrame:
    """Truth with its prediction by frame; a frame without one raises when it is read."""
    other = [c for c in predictions.columns if c != frame]
    found = truth.join(predictions.withColumn("_found", F.lit(True)), frame, "left")
    missing = F.raise_error(F.concat(F.lit("no prediction for "), F.col(frame).cast("string"))).cast("boolean")
    return found.filter(F.coalesce(F.col("_found"), missing)).select(*truth.columns, *[c for c in other if c not in truth.columns])
