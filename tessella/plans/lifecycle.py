"""The three runs end to end: what a training run does over its epochs, a test run with its report, an evaluation.

Networks are out of scope: training plans which samples, batches, rates and triggers an epoch has; a test run scores samples
with a registered model; an evaluation takes predicted label maps.
"""

from __future__ import annotations

from dataclasses import replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import pixels
from ..functions.schedules import learning_rates
from ..operators import confusion
from ..operators.epochs import batched, counters, epoch_order, sharded, triggers
from ..operators.ranking import capped_batches, first_samples
from ..sources import sinks
from . import registry
from .config import INF, Config, options_file, options_text, results_folder, test_run


def write_options(spark: SparkSession, config: Config) -> str:
    """Writes the options dump and returns its path."""
    folder, _, name = options_file(config).rpartition("/")
    sinks.write_files(spark.createDataFrame([(name, options_text(config).encode())], "name string, content binary"), folder)
    return f"{folder}/{name}"


def training_epoch(spark: SparkSession, config: Config, n: int, epoch: int, world: int = 1, seed: int = 0) -> DataFrame:
    """(epoch, pos, idx, rank, batch_id): the samples of an epoch in order, cut by the dataset's cap."""
    order = epoch_order(spark, n, epoch, config.serial_batches, seed)
    rows = sharded(order, n, world) if world > 1 else order.withColumn("rank", F.lit(0))
    own = rows.withColumn("pos", F.floor(F.col("pos") / world).cast("long")) if world > 1 else rows
    cap = None if config.max_dataset_size == INF else int(config.max_dataset_size)
    return capped_batches(batched(own, config.batch_size), config.batch_size, cap)


def training_steps(spark: SparkSession, config: Config, n: int) -> DataFrame:
    """Steps of all epochs at which something is shown, logged or saved."""
    epochs = config.n_epochs + config.n_epochs_decay - config.epoch_count + 1
    steps = counters(spark, epochs, n, config.batch_size, config.epoch_count)
    return triggers(steps, config.display_freq, config.update_html_freq, config.print_freq, config.save_latest_freq)


def training_rates(spark: SparkSession, config: Config) -> DataFrame:
    """(epoch, lr) from the configured first epoch on."""
    epochs = config.n_epochs + config.n_epochs_decay - config.epoch_count + 1
    rates = learning_rates(spark, config.lr_policy, epochs, config.lr, config.n_epochs, config.n_epochs_decay, config.lr_decay_iters, config.epoch_count)
    return rates.withColumn("epoch", F.col("epoch") + config.epoch_count)


def test_samples(spark: SparkSession, config: Config) -> DataFrame:
    """The first samples of a test run's dataset mode, with what a test run fixes; the built-in modes decode only these."""
    fixed = test_run(config)
    fixed = replace(fixed, extra=fixed.extra | {"first": fixed.num_test})
    return first_samples(registry.dataset(fixed.dataset_mode)(spark, fixed), fixed.num_test)


def write_pairs(a: DataFrame, b: DataFrame, folder: str) -> None:
    """Writes the images of two tables of image rows with a ``name`` side by side, as {folder}/{name}; both sides need the same height."""

    def beside(batches):
        for batch in batches:
            columns = [batch.column(k).to_pylist() for k in range(9)]
            out = []
            for row in zip(*columns, strict=True):
                left, right = (np.frombuffer(row[k + 3], np.uint8).reshape(row[k + 1], row[k], row[k + 2]) for k in (1, 5))
                out.append((row[0], pixels.beside(left, right)))
            arrays = [[n for n, _ in out], [x.shape[1] for _, x in out], [x.shape[0] for _, x in out], [x.shape[2] for _, x in out], [x.tobytes() for _, x in out]]
            kinds = [pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(arrays, kinds, strict=True)], ["name", "width", "height", "n_channels", "pixels"])

    side = lambda df, k: df.select("name", *[F.col(c).alias(f"{k}_{c}") for c in ("width", "height", "n_channels", "pixels")])
    both = side(a, "a").join(side(b, "b"), "name")
    sinks.write_files(sinks.encoded(both.mapInArrow(beside, "name string, width int, height int, n_channels int, pixels binary")), folder)


def test_report(spark: SparkSession, config: Config, visuals: DataFrame) -> str:
    """Writes images and report of (idx, name, k, label, width, height, n_channels, pixels) rows; returns the folder."""
    folder = results_folder(config)
    named = visuals.withColumn("file", F.format_string("%s_%s.png", "name", "label"))
    sinks.write_files(sinks.encoded(named, "file", config.aspect_ratio), f"{folder}/images")
    rows = sinks.report_rows(named.select("name", "k", "label", "file"), config.display_winsize)
    order = named.groupBy("name").agg(F.min("idx").alias("position"))
    sinks.write_report(spark, rows.join(order, "name"), folder, f"Experiment = {config.name}, Phase = {config.phase}, Epoch = {config.epoch}")
    return folder


def evaluate(truth: DataFrame, predictions: DataFrame, classes: list[str], strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """(scores, report lines) of truth (frame, y, x, label) against predictions (frame, y, x, pred).

    Pixels are matched by position; one without a prediction, and so a frame without one, raises when it is read.
    """
    missing = F.raise_error(F.concat(F.lit("no prediction for "), F.col("frame").cast("string"))).cast("int")
    both = truth.join(predictions, ["frame", "y", "x"], "left")
    matched = both.select("frame", F.col("label").alias("gt"), F.coalesce("pred", missing).alias("pred"))
    counts = confusion.accumulate(confusion.frame_confusion(matched, len(classes), strict=strict))
    return confusion.scores(counts, len(classes)), confusion.report_lines(counts, classes)
