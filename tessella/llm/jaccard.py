"""Links of texts whose sets of word shingles have a Jaccard similarity of at least ``similarity``.

Of two such sets, each of n shingles in one common order, the first n - ceil(similarity * n) + 1 of each share a shingle. So
these prefixes are emitted as tokens, and texts that share one are candidates. The order puts shingles that are common in a
sample of the texts last: the sample decides what the search costs, not what it finds. Before texts are compared, a candidate
pair must fit in size; bitmaps of 128 bits, the parities of the shingles that fall on each bit, may differ in no more bits than
similar sets have shingles that are not in both, which is exact and tells short texts apart; and 64-bit SimHashes of the
sets may differ in at most FAR bits (sets of similarity 0.8 differ in 10 on average, with a deviation of 3), which tells long ones
apart.

Groups of near copies are not paired up. First every text is compared with one leader of each of its tokens, and
components are built; then only texts of different components that share a token are compared. What is left out
is linked already, so the components are those of all pairs. Leaders are minima, aggregated with partial sums; a token that
more than ``bucket_rows`` texts share is dealt into chunks, every pair of which is compared in a task of its own.

Defined results: texts without words have no shingle and no link; texts with fewer words than a shingle are one shingle;
repeats of a shingle count once; an empty table gives no links. Shingles and texts are told apart by 64-bit hashes.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, few, slices, text_bytes, words
from .components import connected_components

U64 = np.uint64
MULTIPLIER = 0x9E3779B97F4A7C15
ROWS_AT_ONCE = 100_000
#: One text of SHARE is in the sample; texts of it that make a shingle common; common shingles at most.
SHARE, COMMON, MOST = 8, 3, 200_000
#: Bits in which SimHashes of similar sets may differ: four deviations above the mean.
FAR = 22


def _runs(batches, width: int):
    """Columns of rows that come sorted by the first, cut into blocks at its changes; the first as a group number."""
    held, total = [], 0

    def block(columns):
        new = np.concatenate([[True], columns[0][1:] != columns[0][:-1]])
        return np.cumsum(new), columns

    for b in slices(batches, ROWS_AT_ONCE):
        held.append([b.column(k).to_numpy(zero_copy_only=False) for k in range(width)])
        total += b.num_rows
        if total >= ROWS_AT_ONCE:
            columns = [np.concatenate(x) for x in zip(*held, strict=True)]
            change = np.flatnonzero(columns[0][1:] != columns[0][:-1])
            cut = int(change[-1]) + 1 if len(change) else 0
            if cut:
                yield block([c[:cut] for c in columns])
            held, total = [[c[cut:] for c in columns]], total - cut
    if total:
        yield block([np.concatenate(x) for x in zip(*held, strict=True)])


def shingle_set(text: bytes, shingle: int) -> np.ndarray:
    """Sorted distinct hashes of a text's word shingles."""
    own = words(text)
    h = np.fromiter(map(xxhash.xxh64_intdigest, own), U64, len(own))
    if not len(h):
        return h
    width = min(shingle, len(h))
    total = np.zeros(len(h) - width + 1, U64)
    for k in range(width):
        total = total * U64(MULTIPLIER) + h[k : len(h) - width + 1 + k]
    return np.unique((total ^ (total >> U64(32))) * U64(0xD6E8FEB86659FD93) ^ U64(width))


def prefix(own: np.ndarray, common: np.ndarray, similarity: float) -> np.ndarray:
    """The shingles of a set that a set of at least this similarity cannot all miss."""
    n = len(own)
    if len(common) and n:
        hot = common[np.minimum(np.searchsorted(common, own), len(common) - 1)] == own
        own = np.concatenate([own[~hot], own[hot]])
    return own[: n - math.ceil(similarity * n - 1e-9) + 1] if n else own


def similar(a: np.ndarray, b: np.ndarray, similarity: float) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both >= similarity * (len(a) + len(b) - both) - 1e-9


def sketch(own: np.ndarray) -> list[int]:
    """SimHash of a set of shingles, and the two halves of its parity bitmap."""
    if not len(own):
        return [0, 0, 0]
    bits = np.unpackbits(own.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    parity = np.bincount((own & U64(127)).astype(np.int64), minlength=128) & 1
    return np.packbits(np.concatenate([2 * bits > len(own), parity.astype(bool)]), bitorder="little").view(np.int64).tolist()


def unlike(n, similarity: float):
    """Shingles that are in one of two similar sets only, at most, if the sets have n shingles in all."""
    return n - 2 * np.ceil(similarity / (1 + similarity) * n - 1e-9)


#: What is carried with a text's tokens.
SKETCH = ["n", "print", "low", "high"]


def common_shingles(texts: DataFrame, shingle: int) -> np.ndarray:
    """Shingles of at least COMMON texts of a sample, the most frequent MOST of them, sorted."""

    def run(batches):
        for b in slices(batches):
            found = [shingle_set(t, shingle).view(np.int64) for t in b.column(0).to_pylist()]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found))], ["s"])

    some = texts.filter(F.pmod(F.xxhash64("key", F.lit(7)), F.lit(SHARE)) == 0).select("t")
    counted = some.mapInArrow(run, "s long").groupBy("s").agg(F.count("*").alias("n")).filter(F.col("n") >= COMMON)
    found = counted.orderBy(F.desc("n"), "s").limit(MOST).toPandas()
    return np.sort(found.s.to_numpy(np.int64).view(U64))


def _tokens(shingle: int, similarity: float, common):
    def run(batches):
        hot, done = common.value, set()
        for b in slices(batches):
            token, rows = [], []
            for k, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if k in done:
                    continue
                done.add(k)
                own = shingle_set(t, shingle)
                some = prefix(own, hot, similarity)
                token.append(some.view(np.int64))
                rows.append(np.tile(np.array([[k, len(own), *sketch(own)]], np.int64), (len(some), 1)))
            if token:
                columns = [np.concatenate(token), *np.concatenate(rows).T]
                yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(x)) for x in columns], ["token", "key", *SKETCH])

    return run


def _across(similarity: float):
    def run(batches):
        """From (bucket, root, key, n, print, low, high) sorted by bucket: pairs of different roots that may have the similarity."""
        a, b, total = [], [], 0

        def flush():
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (a, b)], ["a", "b"])

        for block, (_, root, key, n, *bits) in _runs(batches, 7):
            by = np.lexsort((root, block))
            block, root, key, n = (x[by] for x in (block, root, key, n))
            prints, low, high = (x.view(U64)[by] for x in bits)
            end = np.searchsorted(block, block, "right")
            change = np.concatenate([np.flatnonzero((root[1:] != root[:-1]) | (block[1:] != block[:-1])) + 1, [len(root)]])
            own_end = change[np.searchsorted(change, np.arange(len(root)), "right")]
            for i in np.flatnonzero(own_end < end).tolist():
                s, e = own_end[i], end[i]
                fits = np.minimum(n[i], n[s:e]) >= similarity * np.maximum(n[i], n[s:e]) - 1e-9
                fits &= np.bitwise_count(prints[i] ^ prints[s:e]) <= FAR
                differ = np.bitwise_count(low[i] ^ low[s:e]).astype(np.int64) + np.bitwise_count(high[i] ^ high[s:e])
                fits &= differ <= unlike(n[i] + n[s:e], similarity)
                other = key[s:e][fits]
                a.append(np.maximum(key[i], other))
                b.append(np.minimum(key[i], other))
                total += len(other)
                if total > ROWS_AT_ONCE:
                    yield flush()
                    a, b, total = [], [], 0
        if a:
            yield flush()

    return run


def _verified(pairs: DataFrame, texts: DataFrame, scratch: Scratch, shingle: int, similarity: float) -> DataFrame:
    """(a, b): the pairs that have the similarity; ``texts`` is read once, and only texts of pairs are moved."""

    def run(batches):
        for b in slices(batches):
            known: dict[int, np.ndarray] = {}
            ok = []
            for x, y, s, t in zip(*(b.column(k).to_pylist() for k in range(4)), strict=True):
                for k, v in ((x, s), (y, t)):
                    if k not in known:
                        known[k] = shingle_set(v, shingle)
                ok.append(similar(known[x], known[y], similarity))
            mask = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column(0).filter(mask), b.column(1).filter(mask)], ["a", "b"])

    asked = scratch.table(pairs.select(F.col("a").alias("key")).unionByName(pairs.select(F.col("b").alias("key"))).distinct())
    held = scratch.table(texts.join(few(asked), "key", "left_semi").dropDuplicates(["key"]))
    rows = pairs.join(held.select(F.col("key").alias("a"), F.col("t").alias("s")), "a").join(held.select(F.col("key").alias("b"), "t"), "b")
    return scratch.table(rows.select("a", "b", "s", "t").mapInArrow(run, "a long, b long"))


def _dealt(rows: DataFrame, bucket_rows: int, scratch: Scratch) -> DataFrame:
    """Rows of tokens that several roots share, as (bucket, root, key, sketch): a bucket for each token, or for each pair of
    chunks of a large one."""
    counted = rows.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("texts"))
    asked = few(scratch.table(counted.filter("low <> high").select("token", "texts")))
    met = rows.join(asked, "token").withColumn("chunks", F.ceil(F.col("texts") * 2 / bucket_rows).cast("int"))
    own = F.pmod(F.xxhash64("key", F.lit(1)), F.col("chunks")).cast("int")
    usual = met.filter(F.col("texts") <= bucket_rows).select(F.col("token").alias("bucket"), "root", "key", *SKETCH)
    large = met.filter(F.col("texts") > bucket_rows).withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    pair = F.xxhash64("token", F.least("own", "other"), F.greatest("own", "other")).alias("bucket")
    return usual.unionByName(large.select(pair, "root", "key", *SKETCH)).repartition("bucket").sortWithinPartitions("bucket")


def similar_links(docs: DataFrame, prints: DataFrame, near: DataFrame, shingle: int, similarity: float, bucket_rows: int = 20_000) -> DataFrame:
    """``near`` (links a, b of fingerprints) and links of the fingerprints of similar texts.

    ``prints``: (key, fp) by text of ``docs``, key its 64-bit hash. Pairs that the links connect anyway may be left out.
    """
    scratch = Scratch(docs.sparkSession)
    texts = docs.select(F.xxhash64("text").alias("key"), text_bytes().alias("t"))
    prints = scratch.table(prints.distinct())
    near = scratch.table(near, keep=True)
    common = docs.sparkSession.sparkContext.broadcast(common_shingles(texts, shingle))
    tokens = scratch.table(texts.mapInArrow(_tokens(shingle, similarity, common), "token long, key long, n long, print long, low long, high long"))
    several = tokens.groupBy("token").agg(F.min("key").alias("low"), F.max("key").alias("high")).filter("low <> high").select("token")
    shared = scratch.table(tokens.join(few(scratch.table(several)), "token", "left_semi").distinct())

    def linked(pairs):
        fp = lambda name: prints.select(F.col("key").alias(name), F.col("fp").alias(f"fp_{name}"))
        return pairs.join(fp("a"), "a").join(fp("b"), "b").select(F.col("fp_a").alias("a"), F.col("fp_b").alias("b")).filter("a <> b").distinct()

    leaders = shared.groupBy("token").agg(F.min(F.struct("key", *SKETCH)).alias("lead"))
    fits = F.least("n", "lead.n") >= F.lit(similarity) * F.greatest("n", "lead.n") - F.lit(1e-9)
    apart = lambda c: F.bit_count(F.col(c).bitwiseXOR(F.col(f"lead.{c}")))
    both = F.col("n") + F.col("lead.n")
    close = (apart("print") <= FAR) & (apart("low") + apart("high") <= both - 2 * F.ceil(F.lit(similarity / (1 + similarity)) * both - F.lit(1e-9)))
    led = shared.join(leaders, "token").filter((F.col("key") != F.col("lead.key")) & fits & close)
    led = scratch.table(led.select(F.col("key").alias("a"), F.col("lead.key").alias("b")).distinct())
    links = scratch.table(near.unionByName(linked(_verified(led, texts, scratch, shingle, similarity))), keep=True)
    roots = connected_components(links).withColumnRenamed("node", "fp")
    rooted = scratch.table(prints.join(roots, "fp", "left").select("key", F.coalesce("root", "fp").alias("root")))
    sides = scratch.table(shared.join(rooted, "key").select("token", "root", "key", *SKETCH))
    crossing = _dealt(sides, bucket_rows, scratch).mapInArrow(_across(similarity), "a long, b long").distinct()
    rest = scratch.table(crossing.join(led, ["a", "b"], "left_anti"))
    found = scratch.table(linked(_verified(rest, texts, scratch, shingle, similarity)), keep=True)
    scratch.clear()
    return links.unionByName(found)
