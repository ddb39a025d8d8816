"""Segmentation evaluation: confusion counts and the scores derived from them, all native.

Counts are in long form (frame, gt, pred, cnt). A truth outside [0, n) is void and dropped; a prediction is not checked, so
one of n or more counts in a later row of the matrix, and a frame in which a count would fall behind the matrix counts for
nothing. ``strict`` drops predictions out of range instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

EPSILON = 1e-12


def frame_confusion(pixels: DataFrame, n: int, frame: str = "frame", gt: str = "gt", pred: str = "pred", strict: bool = False) -> DataFrame:
    """(frame, gt, pred, cnt) of pixel pairs."""
    valid = pixels.filter((F.col(gt) >= 0) & (F.col(gt) < n))
    if strict:
        valid = valid.filter((F.col(pred) >= 0) & (F.col(pred) < n))
    counted = valid.groupBy(F.col(frame).alias("frame"), (F.col(gt).cast("long") * n + F.col(pred)).alias("cell")).agg(F.count("*").alias("cnt"))
    behind = counted.groupBy("frame").agg(F.max("cell").alias("top")).filter(F.col("top") < n * n).select("frame")
    whole = counted.join(behind, "frame", "left_semi")
    cell = F.col("cell")
    return whole.select("frame", F.floor(cell / n).cast("int").alias("gt"), F.pmod(cell, F.lit(n)).cast("int").alias("pred"), "cnt")


def accumulate(counts: DataFrame) -> DataFrame:
    """(gt, pred, cnt) over all frames."""
    return counts.groupBy("gt", "pred").agg(F.sum("cnt").alias("cnt"))


def _class_sums(counts: DataFrame, n: int) -> DataFrame:
    """(cls, diag, rows, cols, acc, iou) of each of the n classes."""
    none = F.lit(None).cast("long")
    hit = F.when(F.col("gt") == F.col("pred"), F.col("cnt"))
    as_truth = F.struct(F.col("gt").alias("cls"), hit.alias("diag"), F.col("cnt").alias("rows"), none.alias("cols"))
    as_prediction = F.struct(F.col("pred").alias("cls"), none.alias("diag"), none.alias("rows"), F.col("cnt").alias("cols"))
    sides = counts.select(F.explode(F.array(as_truth, as_prediction)).alias("x")).select("x.*")
    sums = sides.groupBy("cls").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("diag", "rows", "cols")])
    classes = counts.sparkSession.range(n).select(F.col("id").cast("int").alias("cls"))
    full = classes.join(sums, "cls", "left").fillna(0, ["diag", "rows", "cols"])
    union = F.col("rows") + F.col("cols") - F.col("diag")
    return full.select("*", (F.col("diag") / (F.col("rows") + EPSILON)).alias("acc"), (F.col("diag") / (union + EPSILON)).alias("iou"))


def class_scores(counts: DataFrame, n: int) -> DataFrame:
    """(cls, acc, iou) of each of the n classes; a class that never occurs scores 0."""
    return _class_sums(counts, n).select("cls", "acc", "iou")


def scores(counts: DataFrame, n: int) -> DataFrame:
    """One row (pixel_acc, mean_class_acc, mean_class_iou)."""
    return _class_sums(counts, n).agg(
        (F.sum("diag") / (F.sum("rows") + EPSILON)).alias("pixel_acc"), F.avg("acc").alias("mean_class_acc"), F.avg("iou").alias("mean_class_iou")
    )


def report_lines(counts: DataFrame, classes: list[str]) -> DataFrame:
    """(line_no, line) of the evaluation report."""
    n = len(classes)
    head = scores(counts, n).select(
        F.explode(
            F.array(
                F.struct(F.lit(0).alias("line_no"), F.format_string("Mean pixel accuracy: %f", "pixel_acc").alias("line")),
                F.struct(F.lit(1).alias("line_no"), F.format_string("Mean class accuracy: %f", "mean_class_acc").alias("line")),
                F.struct(F.lit(2).alias("line_no"), F.format_string("Mean class IoU: %f", "mean_class_iou").alias("line")),
                F.struct(F.lit(3).alias("line_no"), F.lit("************ Per class numbers below ************").alias("line")),
            )
        ).alias("x")
    ).select("x.*")
    names = F.element_at(F.array(*[F.lit(c.ljust(15)) for c in classes]), F.col("cls") + 1)
    rows = class_scores(counts, n).select((F.col("cls") + 4).alias("line_no"), F.format_string("%s: acc = %f, iou = %f", names, "acc", "iou").alias("line"))
    return head.unionByName(rows)
