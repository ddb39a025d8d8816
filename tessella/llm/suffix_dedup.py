"""Removal of repeated byte strings with suffix arrays.

A byte is removed if a ``window``-byte string that covers it starts at two places or more in all texts. Suffix arrays of
all text would have to be merged over machines, so the strings are first narrowed down, without losing any:

1. *Anchors.* In each window the ``seed``-byte string with the smallest hash is its anchor (leftmost of equal ones). Equal
   windows have equal anchors at equal offsets, so only occurrences of anchors that stand elsewhere too matter. Each
   anchor occurrence goes with its context, the bytes of the windows it is the anchor of; texts send one 32-byte row for
   each (about every 75 bytes), copies of a text only once.
2. *Equal contexts* of an anchor are repeated as a whole. Anchors whose contexts differ are left: near copies, and the
   ends of repeated passages. For these, one text for each distinct context is read again. Places that a task itself finds to
   be repeated are merged to byte intervals before they leave it, so a long run of one character is a few rows.
3. *Suffix arrays.* Contexts of an anchor are cut into blocks of ``block`` bytes that line up at the anchor; over the
   blocks, the linear grouping construction sorts all suffixes of many contexts at once. Neighbours in the suffix array
   that share window / block - 2 or so blocks form classes, within which windows can only differ at both edges, by less
   than a block. Edges are compared by hash of the whole window.

An anchor with more than ``hot_contexts`` distinct contexts does not go to one task: its windows are counted by hash in a
grouped aggregation instead, with the same result. Text reaches a task row by row; long texts are handled in segments
that overlap by a window.

Defined results: null texts are empty, texts shorter than the window stay whole and repeat nothing; rows with equal texts
repeat each other wholly, repeated rows included; a null doc_id is carried along; an empty table gives an empty one.
64-bit hashes stand for byte strings.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, few, slices, text_bytes
from .grouping_sa import suffix_array

U64 = np.uint64
BASE = 0x9E3779B97F4A7C15
SEGMENT = 1 << 19
PLACE_BITS = U64(20)
#: Rows that a Python worker holds at once.
ANCHORS_AT_ONCE = 100_000
CONTEXTS_AT_ONCE = 4_000


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of BASE and of its inverse modulo 2 ** 64."""
    out = []
    for b in (BASE, pow(BASE, -1, 1 << 64)):
        p = np.full(n, U64(b))
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U64(33))) * U64(0xFF51AFD7ED558CCD)
    return x ^ (x >> U64(29))


class Hashes:
    """Hashes of any substrings of a byte string, from prefix sums."""

    def __init__(self, text: bytes):
        a = np.frombuffer(text, np.uint8)
        size = 1 << max(12, len(a).bit_length())
        self.up, down = _powers(size)
        self.sums = np.zeros(len(a) + 1, U64)
        np.cumsum((a.astype(U64) + U64(1)) * down[: len(a)], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return (self.sums[ends] - self.sums[starts]) * self.up[starts]


def _sliding_min(a: np.ndarray, width: int) -> np.ndarray:
    pad = np.concatenate([a, np.full(-len(a) % width, U64(2**64 - 1))]).reshape(-1, width)
    ahead = np.minimum.accumulate(pad, axis=1).ravel()
    back = np.minimum.accumulate(pad[:, ::-1], axis=1)[:, ::-1].ravel()
    m = len(a) - width + 1
    return np.minimum(back[:m], ahead[width - 1 : width - 1 + m])


def anchors_by_segment(text: bytes, window: int, seed: int):
    """Anchor occurrences of each segment of a text: (key, context hash, position, first and last start of its windows)."""
    for at in range(0, max(1, len(text) - window + 1), SEGMENT):
        part = text[at : at + SEGMENT + window - 1] if len(text) > SEGMENT else text
        if len(part) < window:
            break
        h = Hashes(part)
        starts = np.arange(len(part) - seed + 1)
        keys = h.of(starts, starts + seed)
        order = (_mix(keys) >> PLACE_BITS << PLACE_BITS) | starts.astype(U64)
        chosen = (_sliding_min(order, window - seed + 1) & ((U64(1) << PLACE_BITS) - U64(1))).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], chosen[1:] != chosen[:-1]]))
        last = np.append(first[1:], len(chosen)) - 1
        pos = chosen[first]
        context = _mix(h.of(first, last + window) ^ _mix(((pos - first) * 4096 + (last - first) + 11).astype(U64)))
        yield _mix(keys[pos]), context, pos + at, first + at, last + at


def anchors(text: bytes, window: int, seed: int) -> list[np.ndarray]:
    return [np.concatenate(x) for x in zip(*anchors_by_segment(text, window, seed), strict=True)]


def pack(pos, first, last):
    """Position and how far the windows' starts lie before it, in one long."""
    return (pos << 16) | ((pos - first) << 8) | (pos - last)


def unpack(x):
    pos = x >> 16
    return pos, pos - ((x >> 8) & 255), pos - (x & 255)


def repeated_windows(groups: np.ndarray, packs: np.ndarray, contexts: list[bytes], window: int, seed: int, block: int):
    """(index of a context, offset in it) of every window that two contexts of the same group share.

    ``packs`` say where the anchor and the windows lie in each context.
    """
    n, per = len(contexts), (window - seed) // block
    pos, first, last = unpack(packs)
    anchor, most = pos - first, pos - last  # bytes before the anchor; the least left part of a window
    text = b"".join(contexts)
    h = Hashes(text)
    base = np.concatenate([[0], np.cumsum([len(c) for c in contexts])])
    size = np.diff(base)
    left, right = anchor // block, (size - anchor - seed) // block
    count = left + right + 2  # blocks, anchor, separator
    at = np.concatenate([[0], np.cumsum(count)])
    owner = np.repeat(np.arange(n), count)
    k = np.arange(at[-1]) - at[:-1][owner] - left[owner]  # block number relative to the anchor, which is 0
    sep = k > right[owner]
    start = base[:-1][owner] + anchor[owner] + np.where(k <= 0, k * block, seed + (k - 1) * block)
    start = np.where(sep, 0, start)
    end = np.where(sep, 0, start + np.where(k == 0, seed, block))
    symbol = _mix(h.of(start, end) ^ _mix(groups[owner].astype(U64) + U64(97) * (k == 0)))
    symbol[sep] = np.arange(n, dtype=U64)  # each its own
    ranks = np.unique(symbol, return_inverse=True)[1]
    sa = suffix_array(ranks)
    # Neighbours that share per blocks (the anchor among them) from a start at most per - 1 blocks before the anchor.
    need = per
    padded = np.concatenate([ranks, -np.arange(1, need + 1)])
    same = np.ones(len(sa) - 1, bool)
    for d in range(need):
        same &= padded[sa[1:] + d] == padded[sa[:-1] + d]
    klass = np.concatenate([[0], np.cumsum(~same)])
    used = (k[sa] <= 0) & (-k[sa] <= per - 1)
    in_class = np.zeros(len(sa), bool)
    in_class[1:] |= same
    in_class[:-1] |= same
    chosen = np.flatnonzero(used & in_class)
    who, q, klass = owner[sa[chosen]], -k[sa[chosen]], klass[chosen]
    # All windows whose left part has q whole blocks and x bytes, x = 0 .. block - 1 (block too for the last q).
    x = np.arange(block + 1)
    who, q, klass, x = (v.ravel() for v in np.broadcast_arrays(who[:, None], q[:, None], klass[:, None], x[None, :]))
    l = q * block + x  # noqa: E741
    ok = (l >= most[who]) & (l <= anchor[who]) & ((x < block) | (q == per - 1))
    who, klass, l = who[ok], klass[ok], l[ok]  # noqa: E741
    offset = anchor[who] - l
    whole = _mix(h.of(base[who] + offset, base[who] + offset + window) ^ _mix(klass.astype(U64) * U64(4096) + l.astype(U64)))
    times = np.unique(whole, return_inverse=True, return_counts=True)
    repeated = times[2][times[1]] > 1
    return who[repeated], offset[repeated]


def _intervals(doc: np.ndarray, start: np.ndarray, window: int):
    """Runs of window starts as byte intervals (doc, start, end)."""
    order = np.lexsort((start, doc))
    doc, start = doc[order], start[order]
    new = np.concatenate([[True], (doc[1:] != doc[:-1]) | (start[1:] > start[:-1] + window)]) if len(doc) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(doc)) - 1 if len(doc) else first
    return doc[first], start[first], start[last] + window


def _batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v) if isinstance(v, np.ndarray) else v for v in columns.values()], list(columns))


def merged(dk: np.ndarray, packs: np.ndarray, window: int):
    """The bytes of windows as disjoint intervals, by text: (index of the first row of each interval, where it ends)."""
    _, first, last = unpack(packs)
    texts = np.unique(dk, return_inverse=True)[1].astype(np.int64) << 40  # texts one after the other, each far from the next
    order = np.argsort(texts + first, kind="stable")
    start, end = (texts + first)[order], np.maximum.accumulate((texts + last + window)[order])
    new = np.flatnonzero(np.concatenate([[True], start[1:] > end[:-1]]))
    return order[new], (end - texts[order])[np.append(new[1:], len(order)) - 1]


def _anchor_rows(window: int, seed: int):
    """(key, ctx, dk, pack, known, more) of all anchors, pre-aggregated.

    Places of the same context that a task sees together are repeated for sure: the first of them stands for all where
    the key is looked up. The others are settled: merged to intervals, the windows of ``pack`` and ``more`` bytes after them,
    they go on under a key of their own, marked as known, so that they don't pile up.
    """

    def flush(rows):
        key, ctx, dk, packs = map(np.concatenate, zip(*rows, strict=True))
        order = np.lexsort((packs, dk, ctx, key))
        key, ctx, dk, packs = key[order], ctx[order], dk[order], packs[order]
        new = np.concatenate([[True], (key[1:] != key[:-1]) | (ctx[1:] != ctx[:-1])])
        known = ~new | ~np.append(new[1:], True)
        more = np.zeros(len(key), np.int64)
        if not new.all():
            later = np.flatnonzero(~new)
            kept, ends = merged(dk[later], packs[later], window)
            kept = later[kept]
            more[kept] = ends - unpack(packs[kept])[2] - window
            key[kept] = _mix(dk[kept].view(U64) ^ _mix(packs[kept].astype(U64) + U64(BASE))).view(np.int64)
            stay = np.sort(np.concatenate([np.flatnonzero(new), kept]))
            key, ctx, dk, packs, known, more = (x[stay] for x in (key, ctx, dk, packs, known, more))
        return _batch(key=key, ctx=ctx, dk=dk, pack=packs, known=known, more=more)

    def run(batches):
        done: set[int] = set()
        rows, total = [], 0
        for b in slices(batches):
            for dk, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if dk in done:
                    continue
                done.add(dk)
                for key, context, *where in anchors_by_segment(text, window, seed):
                    rows.append((key.view(np.int64), context.view(np.int64), np.full(len(key), dk), pack(*where)))
                    total += len(key)
                    if total > ANCHORS_AT_ONCE:
                        yield flush(rows)
                        rows, total = [], 0
        if rows:
            yield flush(rows)

    return run


def _context_rows(window: int):
    """From (dk, t, found): contexts of usual anchors as they are, windows of hot ones by hash (context null)."""

    def run(batches):
        for b in slices(batches):
            for dk, text, found in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                key, packs, contexts = [], [], []
                for x in found:
                    pos, first, last = unpack(x["pack"])
                    own = text[first : last + window]
                    if x["hot"]:
                        for s in range(first, last + 1):
                            key.append(xxhash.xxh64_intdigest(own[s - first : s - first + window]) - (1 << 63))
                            packs.append(s)
                            contexts.append(None)
                    else:
                        key.append(x["key"])
                        packs.append(x["pack"])
                        contexts.append(own)
                yield _batch(key=np.array(key, np.int64), dk=np.full(len(key), dk), pack=np.array(packs, np.int64), context=pa.array(contexts, pa.binary()))

    return run


def _search(window: int, seed: int, block: int):
    """From contexts sorted by key: byte intervals of repeated windows."""

    def solve(key, dk, packs, contexts):
        who, offset = repeated_windows(key, packs, contexts, window, seed, block)
        first = unpack(packs)[1]
        d, s, e = _intervals(dk[who], first[who] + offset, window)
        return _batch(dk=d.astype(np.int64), s=s.astype(np.int64), e=e.astype(np.int64))

    def run(batches):
        held: list[tuple] = []
        total = 0
        for b in slices(batches, CONTEXTS_AT_ONCE):
            key, dk, packs = (b.column(i).to_numpy() for i in range(3))
            held.append((key, dk, packs, b.column(3).to_pylist()))
            total += len(key)
            if total >= CONTEXTS_AT_ONCE:
                key, dk, packs = (np.concatenate([h[i] for h in held]) for i in range(3))
                contexts = [c for h in held for c in h[3]]
                cuts = np.flatnonzero(key[1:] != key[:-1]) + 1  # the last key may go on
                at = 0
                while len(cuts) and cuts[-1] > at:
                    to = int(cuts[min(np.searchsorted(cuts, at + CONTEXTS_AT_ONCE), len(cuts) - 1)])
                    yield solve(key[at:to], dk[at:to], packs[at:to], contexts[at:to])
                    at = to
                held, total = [(key[at:], dk[at:], packs[at:], contexts[at:])], len(key) - at
        if total:
            key, dk, packs = (np.concatenate([h[i] for h in held]) for i in range(3))
            yield solve(key, dk, packs, [c for h in held for c in h[3]])

    return run


def repeats(docs: DataFrame, window: int = 200, seed: int = 48, block: int = 19, hot_contexts: int = 50_000) -> DataFrame:
    """(dk, s, e): byte intervals to remove from each distinct text (dk is the hash of the text); they may overlap."""
    if (window - seed) % block or window - seed > 255:
        raise ValueError("window - seed must be a multiple of block and below 256")
    scratch = Scratch(docs.sparkSession)
    texts = docs.select(F.xxhash64("text").alias("dk"), text_bytes().alias("t"))
    rows = texts.filter(F.length("t") >= window).mapInArrow(_anchor_rows(window, seed), "key long, ctx long, dk long, pack long, known boolean, more long")
    by_context = Window.partitionBy("key", "ctx").orderBy("dk", "pack")
    whole = by_context.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_key = Window.partitionBy("key")
    # Copies of a text in other tasks send the same rows: a context is repeated if any two of its places differ.
    place = F.struct("dk", "pack")
    classed = (
        rows.repartition("key")
        .withColumn("again", F.max("known").over(whole) | (F.min(place).over(whole) != F.max(place).over(whole)))
        .withColumn("lead", F.row_number().over(by_context) == 1)
        .withColumn("contexts", F.sum(F.col("lead").cast("int")).over(by_key))
        .withColumn("open", F.max((~F.col("again")).cast("int")).over(by_key) == 1)
        .filter("again OR contexts > 1")
        .withColumn("ask", F.col("lead") & F.col("open") & (F.col("contexts") > 1))
        .select("key", "dk", "pack", "more", "again", "ask", (F.col("contexts") > hot_contexts).alias("hot"))
    )
    shared = scratch.table(classed)
    pos = F.shiftright("pack", 16)
    first, last = pos - F.shiftright("pack", 8).bitwiseAND(255), pos - F.col("pack").bitwiseAND(255)
    equal = shared.filter("again").select("dk", first.alias("s"), (last + window + F.col("more")).alias("e"))
    asked = shared.filter("ask").groupBy("dk").agg(F.collect_list(F.struct("key", "pack", "hot")).alias("found"))
    asked = scratch.table(asked)
    one_text = texts.join(few(asked.select("dk")), "dk", "left_semi").groupBy("dk").agg(F.first("t").alias("t"))
    contexts = asked.join(one_text, "dk").select("dk", "t", "found").mapInArrow(_context_rows(window), "key long, dk long, pack long, context binary")
    contexts = scratch.table(contexts)
    usual = contexts.filter("context IS NOT NULL").repartition("key").sortWithinPartitions("key")
    found = usual.mapInArrow(_search(window, seed, block), "dk long, s long, e long")
    hot = contexts.filter("context IS NULL").select("key", "dk", F.col("pack").alias("s"))
    twice = hot.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    counted = hot.join(twice, "key").select("dk", "s", (F.col("s") + window).alias("e"))
    copies = texts.select("dk", F.length("t").cast("long").alias("e")).groupBy("dk").agg(F.count("*").alias("n"), F.max("e").alias("e"))
    whole_texts = copies.filter((F.col("n") > 1) & (F.col("e") >= window)).select("dk", F.lit(0).cast("long").alias("s"), "e")
    out = scratch.table(equal.unionByName(found).unionByName(counted).unionByName(whole_texts), keep=True)
    scratch.clear()
    return out


def kept(text: bytes, intervals: list[tuple[int, int]]):
    """(remaining bytes, removed bytes, maximal removed runs)."""
    parts, at, removed, runs = [], 0, 0, 0
    end = -1
    for s, e in sorted(intervals):
        if s > end:
            runs += 1
            parts.append(text[at:s])
            removed += e - s
            end = at = e
        elif e > end:
            removed += e - end
            end = at = e
    return b"".join([*parts, text[at:]]), removed, runs


def remove_repeats(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept) of every document; ``kept`` holds the remaining bytes."""

    def run(batches):
        for b in slices(batches):
            out = [
                (len(t), *kept(t, [(x["s"], x["e"]) for x in found or ()]))
                for t, found in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)
            ]
            size, rest, removed, runs = zip(*out, strict=True) if out else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(x, pa.int64()) for x in (size, removed, runs)), pa.array(rest, pa.binary())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    by_text = repeats(docs, **options).groupBy("dk").agg(F.collect_list(F.struct("s", "e")).alias("found"))
    rows = docs.select("doc_id", F.xxhash64("text").alias("dk"), text_bytes().alias("t")).join(by_text, "dk", "left")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return rows.select("doc_id", "t", "found").mapInArrow(run, f"doc_id {id_type}, n_bytes long, n_removed long, n_spans long, kept binary")


def digest(found: DataFrame) -> DataFrame:
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def brute_force(texts: list[bytes], window: int) -> list[tuple[int, int, int, str]]:
    """The digest columns by definition, for small tables."""
    count: dict[bytes, int] = {}
    for t in texts:
        for i in range(len(t) - window + 1):
            count[t[i : i + window]] = count.get(t[i : i + window], 0) + 1
    out = []
    for t in texts:
        spans = [(i, i + window) for i in range(len(t) - window + 1) if count[t[i : i + window]] > 1]
        rest, removed, runs = kept(t, spans)
        out.append((len(t), removed, runs, hashlib.sha256(rest).hexdigest()))
    return out
