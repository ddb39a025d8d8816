"""Shared pieces: words, document keys, scratch tables."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are runs of anything but ASCII white space (a fixed value of the data contract).
WORD = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]+"
#: ASCII-only lower casing of UTF-8 bytes; bytes.split() splits at exactly the white space that WORD excludes.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))

#: Keys of a join that are broadcast at most.
BROADCAST_KEYS = 250_000


def words(text: bytes) -> list[bytes]:
    """Lower-cased (A-Z only) words of a UTF-8 text."""
    return text.translate(LOWER).split()


def slices(batches, rows: int = 256):
    """Arrow batches cut into small ones, so that a Python worker holds few texts at once."""
    for b in batches:
        for k in range(0, b.num_rows, rows):
            yield b.slice(k, rows)


def text_bytes(name: str = "text") -> Column:
    """The text as UTF-8 bytes; null counts as empty."""
    return F.coalesce(F.col(name).cast("string").cast("binary"), F.lit(b""))


def doc_key() -> Column:
    """A 64-bit key of a document row; rows that repeat doc_id and text share it."""
    return F.xxhash64(F.col("doc_id"), F.coalesce(F.col("text"), F.lit("")))


def word_count(name: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(name), F.lit(WORD)), F.lit(0)).cast("long")


def few(keys: DataFrame) -> DataFrame:
    """A written table of keys (and a number for each), to be broadcast if it is small; otherwise the join is a shuffle."""
    return F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; only in local mode (tests), a temporary one does where none is configured."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not path and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    return (path or _own_dir()).rstrip("/")


@cache
def _own_dir() -> str:
    return tempfile.mkdtemp(prefix="tessella-")


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(target, True)


class Scratch:
    """Tables written to the shared folder: they cut lineage and outlive lost executors.

    ``clear()`` deletes the tables that no returned DataFrame reads; ``keep=True`` tables stay until the process ends.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def table(self, df: DataFrame, keep: bool = False) -> DataFrame:
        path = f"{shared_dir(self.spark)}/tessella/{uuid.uuid4().hex}"
        df.write.parquet(path)
        if keep:
            atexit.register(_at_exit, self.spark, path)
        else:
            self.paths.append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def keep_last(self) -> None:
        """From now on, the table written last stays until the process ends."""
        atexit.register(_at_exit, self.spark, self.paths.pop())

    def clear(self) -> None:
        for path in self.paths:
            _delete(self.spark, path)
        self.paths.clear()


def _at_exit(spark: SparkSession, path: str) -> None:
    try:
        _delete(spark, path)
    except Exception:  # the session is gone: the folder's owner cleans up
        return
