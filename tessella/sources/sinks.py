"""Sinks: PNG files, an HTML report, the loss log, the options dump.

Files are written by tasks through the file system of their target URI. Text sinks are native writes of line tables.
"""

from __future__ import annotations

import html
import struct
import zlib
from datetime import datetime

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.pixels import aspect_size, resized
from ..functions.scalars import loss_line, stem


def png(image: np.ndarray) -> bytes:
    """An 8-bit RGB or gray PNG."""
    h, w, c = image.shape
    kind = {1: 0, 3: 2}[c]
    raw = b"".join(b"\x00" + np.ascontiguousarray(image[y]).tobytes() for y in range(h))
    chunk = lambda tag, body: struct.pack(">I", len(body)) + tag + body + struct.pack(">I", zlib.crc32(tag + body))
    head = struct.pack(">IIBBBBB", w, h, 8, kind, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(raw, 6)) + chunk(b"IEND", b"")


def encoded(images: DataFrame, name: str = "name", ratio: float = 1.0) -> DataFrame:
    """(name, content): PNG bytes of image rows; a ratio other than 1 resizes."""

    def run(batches):
        import pyarrow as pa

        for b in batches:
            out = []
            for w, h, c, data in zip(*(b.column(k).to_pylist() for k in range(1, 5)), strict=True):
                image = np.frombuffer(data, np.uint8).reshape(h, w, c)
                out.append(png(resized(image, *aspect_size(w, h, ratio)) if ratio != 1.0 else image))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], ["name", "content"])

    return images.select(F.col(name).alias("name"), "width", "height", "n_channels", "pixels").mapInArrow(run, "name string, content binary")


def write_files(files: DataFrame, folder: str) -> None:
    """Writes (name, content) rows as files below a folder, from the executors.

    A path without a scheme belongs to the session's default file system, as for Spark's own writers; a folder of the local one
    must be shared by the executors.
    """
    spark = files.sparkSession
    where = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    full = where.makeQualified(system.getUri(), system.getWorkingDirectory()).toString()

    def write(rows):
        from pyarrow import fs

        local = full.startswith("file:")
        system, base = (fs.LocalFileSystem(), full.removeprefix("file:")) if local else fs.FileSystem.from_uri(full)
        system.create_dir(base, recursive=True)
        for r in rows:
            with system.open_output_stream(f"{base}/{r['name']}") as f:
                f.write(bytes(r["content"]))

    files.foreachPartition(write)


def visual_names(samples: DataFrame, labels: list[str], path: str = "path") -> DataFrame:
    """(name, label, file) for every visual of a sample: {stem}_{label}.png."""
    names = F.explode(F.array(*[F.lit(x) for x in labels])).alias("label")
    rows = samples.select(stem(F.col(path)).alias("name"), names)
    return rows.withColumn("file", F.format_string("%s_%s.png", "name", "label"))


def report_rows(visuals: DataFrame, width: int = 256) -> DataFrame:
    """(name, html): a heading and a table row of linked images for each sample, labels in the order of ``k``."""
    cell = F.format_string(
        '<td halign="center" style="word-wrap: break-word;" valign="top"><p><a href="images/%s"><img src="images/%s" style="width:%dpx"></a><br><p>%s</p></p></td>',
        "file", "file", F.lit(width), "label",
    )
    cells = F.array_sort(F.collect_list(F.struct("k", cell.alias("cell"))))
    row = F.array_join(F.transform(cells, lambda c: c["cell"]), "")
    table = F.concat(F.lit("<h3>"), "name", F.lit('</h3><table border="1" style="table-layout: fixed;"><tr>'), F.col("row"), F.lit("</tr></table>"))
    return visuals.groupBy("name").agg(row.alias("row")).select("name", table.alias("html"))


def write_report(spark: SparkSession, rows: DataFrame, folder: str, title: str, refresh: int = 0) -> None:
    """Writes index.html from (position, html) rows; a report is read by people, so it fits the driver."""
    meta = f'<meta content="{refresh}" http-equiv="refresh">' if refresh > 0 else ""
    body = "\n".join(r["html"] for r in rows.orderBy("position").toLocalIterator())
    page = f"<!DOCTYPE html>\n<html><head><title>{html.escape(title)}</title>{meta}</head><body>\n{body}\n</body></html>"
    write_files(spark.createDataFrame([("index.html", page.encode())], "name string, content binary"), folder)


def log_header(now: datetime) -> str:
    return f"================ Training Loss ({now:%c}) ================"


def log_lines(records: DataFrame) -> DataFrame:
    """(value): the log's lines of rank 0 in order; a blank line follows each record."""
    line = loss_line(F.col("rank"), F.col("epoch"), F.col("iters"), F.col("t_comp"), F.col("t_data"), F.col("losses"))
    rows = records.filter("rank = 0").select("epoch", "iters", F.explode(F.array(line, F.lit(""))).alias("value"))
    return rows.select("value")


def start_log(spark: SparkSession, folder: str, now: datetime) -> None:
    """Writes the header with which a run's log begins."""
    spark.createDataFrame([(log_header(now),)], "value string").coalesce(1).write.mode("append").text(folder)


def append_log(records: DataFrame, folder: str) -> None:
    """Appends a log's lines; ``start_log`` comes first."""
    log_lines(records.orderBy("epoch", "iters")).write.mode("append").text(folder)
