"""SimHash near-duplicates by pigeonhole blocks.

A fingerprint bit is 1 if it is set in over half of the hashes of a text's shingles. Fingerprints that differ in at most
d bits agree in at least b - d of b blocks of bits, so for every choice of b - d blocks equal blocks make a bucket, and
close fingerprints share one. Only distinct fingerprints are compared (copies share theirs), the Hamming distance of
candidates is verified, and each bucket gives a spanning forest of its links, not all its pairs: a found fingerprint is
never compared again. Components then come from the forest.

A bucket of more than ``bucket_rows`` fingerprints is dealt into chunks and every pair of chunks is searched in a task of
its own, so that no task holds more than two chunks; this is exact.

Defined results: null and empty texts have fingerprint 0 and are linked like any other; texts with fewer words than a
shingle are one shingle; repeated rows share their component; rows with a null doc_id take part, and a component of only
such rows has a null id; an empty table gives an empty one.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, text_bytes, words
from .components import connected_components
from .jaccard import similar_links

U64 = np.uint64
#: Seed of the shingle hashes (a fixed value of the data contract).
SEED = 42
CHUNK = 1 << 16


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """64-bit SimHash of a text's word shingles, repeats included."""
    own = words(text)
    if not own:
        return 0
    joined = b" ".join(own)
    if len(own) <= shingle:
        return xxhash.xxh64_intdigest(joined, seed=SEED)
    gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts = [0, *(gaps[: len(own) - shingle] + 1).tolist()]
    ends = [*gaps[shingle - 1 :].tolist(), len(joined)]
    digest, n = xxhash.xxh64_intdigest, len(starts)
    counts = np.zeros(64, np.int64)
    for at in range(0, n, CHUNK):
        some = [digest(joined[a:b], SEED) for a, b in zip(starts[at : at + CHUNK], ends[at : at + CHUNK], strict=True)]
        bits = np.unpackbits(np.array(some, U64).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view(U64)[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """``docs`` (only its doc_id and text) as (doc_id, key, fp): fp as a signed long, key of the row's text."""

    def run(batches):
        for b in batches:
            fp = np.array([fingerprint(t, shingle) for t in b.column(2).to_pylist()], U64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fp, pa.int64())], ["doc_id", "key", "fp"])

    read = docs.select("doc_id", F.xxhash64("text").alias("key"), text_bytes().alias("t"))
    return read.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, key long, fp long")


def block_keys(distance: int, blocks: int) -> list[Column]:
    """Keys of the buckets of a fingerprint ``fp``: one for each choice of blocks - distance blocks."""
    edges = [round(64 * k / blocks) for k in range(blocks + 1)]
    keys = []
    for k, pick in enumerate(combinations(range(blocks), blocks - distance)):
        mask = sum(((1 << edges[p + 1]) - 1) ^ ((1 << edges[p]) - 1) for p in pick)
        signed = mask - (1 << 64) if mask >> 63 else mask
        keys.append(F.xxhash64(F.lit(k), F.col("fp").bitwiseAND(F.lit(signed))))
    return keys


def forest(values: np.ndarray, distance: int):
    """Links (from, to) of a spanning forest over distinct fingerprints that differ in at most ``distance`` bits."""
    rest = values.astype(U64)
    while len(rest) > 1:
        front, rest = [rest[0]], rest[1:]
        while front and len(rest):
            f = front.pop()
            near = np.bitwise_count(rest ^ f) <= distance
            if near.any():
                for x in rest[near]:
                    yield int(f), int(x)
                front.extend(rest[near])
                rest = rest[~near]


def _links(distance: int):
    def run(batches):
        """Rows come sorted by bucket; a bucket may go on in the next batch."""
        open_key, held = None, []

        def close():
            return list(forest(np.unique(np.concatenate(held)), distance)) if held else []

        for b in batches:
            keys, fps = b.column(0).to_numpy(), b.column(1).to_numpy().view(U64)
            cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
            found = []
            for s, e in zip(cuts[:-1], cuts[1:], strict=True):
                if e > s:
                    if keys[s] != open_key:
                        found += close()
                        open_key, held = keys[s], []
                    held.append(fps[s:e])
            yield _pairs(found)
        yield _pairs(close())

    return run


def _pairs(found) -> pa.RecordBatch:
    both = np.array(found, U64).reshape(-1, 2).view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(both[:, 0], pa.int64()), pa.array(both[:, 1], pa.int64())], ["a", "b"])


def close_pairs(prints: DataFrame, distance: int = 3, blocks: int = 5, bucket_rows: int = 20_000) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp``: a spanning forest of each bucket's links."""
    dealt = prints.select("fp", F.explode(F.array(*block_keys(distance, blocks))).alias("bucket"))
    # Counted with partial sums; the join may split a hot bucket, so buckets are dealt out anew before they are searched.
    counted = dealt.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
    sized = dealt.join(counted, "bucket")
    usual = sized.filter(F.col("n") <= bucket_rows).select("bucket", "fp").repartition("bucket").sortWithinPartitions("bucket")
    chunks = F.ceil(F.col("n") * 2 / bucket_rows).cast("int")
    own = F.pmod(F.xxhash64("fp", F.lit(1)), chunks).cast("int")
    large = (
        sized.filter(F.col("n") > bucket_rows)
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), chunks - 1)))
        .select(F.xxhash64("bucket", F.least("own", "other"), F.greatest("own", "other")).alias("bucket"), "fp")
        .repartition("bucket")
        .sortWithinPartitions("bucket")
    )
    find = lambda rows: rows.mapInArrow(_links(distance), "a long, b long")
    return find(usual).unionByName(find(large))


def near_duplicates(docs: DataFrame, shingle: int = 3, distance: int = 3, blocks: int = 5, similarity: float | None = None) -> DataFrame:
    """(doc_id, key, fp, component_id): the smallest doc_id among all documents that links reach from this one.

    With a ``similarity``, texts whose sets of shingles have that Jaccard similarity are linked too, at any distance.
    """
    scratch = Scratch(docs.sparkSession)
    rows = scratch.table(fingerprints(docs, shingle), keep=True)
    prints = scratch.table(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), keep=True)
    links = close_pairs(prints.select("fp"), distance, blocks)
    if similarity is not None:
        links = similar_links(docs, rows.select("key", "fp"), links, shingle, similarity)
    roots = connected_components(links)
    rooted = prints.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = rooted.join(ids, "root").select("fp", "component_id")
    return rows.join(classes, "fp").select("doc_id", "key", "fp", "component_id")


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one document of each group: the one with the smallest doc_id (of rows that share it, one row).

    Rows with a null doc_id are kept apart from groups and stay.
    """
    classes = near_duplicates(docs, **options)
    kept = classes.filter("doc_id = component_id").groupBy(F.col("doc_id").alias("_id")).agg(F.min("key").alias("_key"))
    keyed = docs.withColumn("_row_key", F.xxhash64("text"))
    first = keyed.join(kept, (F.col("doc_id") == F.col("_id")) & (F.col("_row_key") == F.col("_key")), "left_semi")
    # By the columns of the join, so that texts move once.
    return first.dropDuplicates(["doc_id", "_row_key"]).drop("_row_key").unionByName(docs.filter("doc_id IS NULL"))
