"""Epoch plans: shuffling, batches, ranks, counters and triggers, over positions only (samples are joined last)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .draws import mixed
from .ranking import dense_index


def shuffle_key(idx: Column, epoch: int, seed: int = 0) -> Column:
    """A pseudo-random order of positions, another one for each epoch; the position itself breaks ties."""
    return mixed(idx, epoch, seed) * F.lit(4294967296) + idx


def epoch_order(spark: SparkSession, n: int, epoch: int, serial: bool = False, seed: int = 0) -> DataFrame:
    """(epoch, pos, idx): every position once."""
    rows = spark.range(n).withColumnRenamed("id", "idx")
    if serial:
        placed = rows.withColumn("pos", F.col("idx"))
    else:
        placed = dense_index(rows.withColumn("_key", shuffle_key(F.col("idx"), epoch, seed)), "_key", "pos").drop("_key")
    return placed.select(F.lit(epoch).alias("epoch"), "pos", "idx")


def batched(rows: DataFrame, batch_size: int) -> DataFrame:
    """Rows with batch_id; the last batch may be short."""
    return rows.withColumn("batch_id", F.floor(F.col("pos") / batch_size).cast("long"))


def sharded(rows: DataFrame, n: int, world: int) -> DataFrame:
    """Rows dealt to ranks in turn; the head is repeated so that all ranks get as many."""
    total = -(-n // world) * world
    repeats = F.sequence(F.lit(0), F.floor((F.lit(total - 1) - F.col("pos")) / F.lit(n)))
    padded = rows.withColumn("_k", F.explode(repeats)).withColumn("pos", F.col("pos") + F.col("_k") * n).drop("_k")
    return padded.withColumn("rank", F.pmod("pos", F.lit(world)).cast("int"))


def counters(spark: SparkSession, epochs: int, n: int, batch_size: int, epoch_count: int = 1) -> DataFrame:
    """(epoch, epoch_iter, total_iters) after each batch; a short last batch counts in full."""
    per = -(-n // batch_size)
    rows = spark.range(epochs * per)
    epoch, k = F.floor(F.col("id") / per), F.pmod("id", F.lit(per))
    return rows.select(
        (epoch + epoch_count).cast("int").alias("epoch"), ((k + 1) * batch_size).alias("epoch_iter"), ((F.col("id") + 1) * batch_size).alias("total_iters")
    )


def triggers(steps: DataFrame, display: int = 400, html: int = 1000, log: int = 100, save: int = 5000) -> DataFrame:
    """Steps at which something is due; a trigger fires only at multiples of its frequency that are reached exactly."""
    due = lambda freq: F.pmod("total_iters", F.lit(freq)) == 0
    out = steps.select("*", due(display).alias("show"), (due(display) & due(html)).alias("save_html"), due(log).alias("print"), due(save).alias("save"))
    return out.filter("show OR print OR save")


def global_step(epoch: Column, epoch_iter: Column, dataset_size: int) -> Column:
    return (epoch - 1) * dataset_size + epoch_iter


def report_order(spark: SparkSession, epoch: int, labels: list[str]) -> DataFrame:
    """(row, epoch, label, file): report rows from the current epoch down to 1, labels in their order."""
    names = F.array(*[F.lit(x) for x in labels])
    rows = spark.range(1, epoch + 1).select(F.col("id").cast("int").alias("epoch"), F.posexplode(names).alias("k", "label"))
    file = F.format_string("epoch%03d_%s.png", "epoch", "label")
    return rows.select(((F.lit(epoch) - F.col("epoch")) * len(labels) + F.col("k")).alias("row"), "epoch", "label", file.alias("file"))


def crop_and_flip(rows: DataFrame, width: Column, height: Column, preprocess: str = "resize_and_crop", load: int = 286, crop: int = 256, flip: bool = True, salt: int = 0) -> DataFrame:
    """Rows with the sample's shared draws crop_x, crop_y and flip, from integer arithmetic on ``idx`` and ``epoch``."""
    if preprocess == "resize_and_crop":
        new_w = new_h = F.lit(load)
    elif preprocess == "scale_width_and_crop":
        new_w, new_h = F.lit(load), F.floor(F.lit(load) * height / width).cast("int")
    else:
        new_w, new_h = width, height

    draw = lambda n, kind: F.pmod(mixed(F.col("idx"), F.col("epoch"), 4 * salt + kind), n)
    room = lambda size: F.greatest(F.lit(0), size - crop) + 1
    return rows.select(
        "*",
        draw(room(new_w), 1).cast("int").alias("crop_x"),
        draw(room(new_h), 2).cast("int").alias("crop_y"),
        ((draw(F.lit(1000), 3) >= 500) & F.lit(flip)).alias("flip"),
    )
