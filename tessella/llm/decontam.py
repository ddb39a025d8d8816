"""Benchmark decontamination with spaced seeds.

Texts and benchmark items are lower-cased (A-Z), ASCII punctuation becomes white space, and words are compared as 64-bit
ids. A window of ``span`` words may differ in ``floor((1 - similarity) * span)`` = e positions. The positions are dealt
into e + 2 groups and a mask ignores e of them, for every choice of e: whichever e positions differ, some mask looks only
at others, so the masks lose no window. A mask's hash is a sum of its groups' sums, which all windows of a block of texts
get at once. Document windows that share a mask hash with an item window are verified word by word at the same offset,
then extended in both directions while the similarity holds.

The benchmark's hashes are joined in slices of about ``slice_words`` words, each broadcast as a sorted index. One slice does
for usual benchmarks, and documents are neither shuffled nor joined then. A larger benchmark takes one pass for each slice:
its hits (row key, item, words) are written to the shared folder and its index is given up before the next one is built,
so driver and workers hold one index at a time; in the end the hits are joined to the documents. An item beyond a slice
is indexed in overlapping pieces, which loses no window.

Defined results: items with fewer than ``min_words`` words never match; items shorter than ``span`` must match whole (in
that similarity); null and empty texts are clean; repeated rows each get their own, equal results; an empty benchmark leaves
every document clean; ids of items may be of any type. No text is cut: very long documents are one block of windows of their
own; the overlap with an item beyond a slice is measured within a piece of it.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import LOWER, Scratch, doc_key, slices, text_bytes

#: ASCII punctuation to space, A-Z to a-z.
FOLD = bytes(32 if b < 128 and not chr(b).isalnum() else LOWER[b] for b in range(256))
U64 = np.uint64
#: Words whose windows a Python worker hashes at once.
BLOCK_WORDS = 1 << 18


def tokens(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(FOLD).split()


def masks(span: int, errors: int) -> tuple[list[list[int]], list[tuple[int, ...]]]:
    """Position groups of a window, and the sets of groups that the masks look at."""
    n = min(errors + 2, span)
    groups = [list(range(g, span, n)) for g in range(n)]
    return groups, list(combinations(range(n), n - errors))


def coefficients(span: int) -> np.ndarray:
    """Odd multipliers, one for each window position."""
    return np.random.default_rng(span).integers(1, 2**63, span, dtype=U64) * U64(2) + U64(1)


def mask_hashes(ids: np.ndarray, span: int, errors: int):
    """For each mask, the hashes of all windows of ``ids``."""
    if len(ids) < span:
        return
    groups, chosen = masks(span, errors)
    mult, m = coefficients(span), len(ids) - span + 1
    sums = []
    for g in groups:
        total = np.zeros(m, U64)
        for o in g:
            total += ids[o : o + m] * mult[o]
        sums.append(total)
    for k, pick in enumerate(chosen):
        h = np.full(m, U64((k + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        for g in pick:
            h += sums[g]
        yield h ^ (h >> U64(31))


class SeedIndex:
    """Mask hashes of a slice of the benchmark, sorted, with the item and place of each: about 32 bytes for a word and mask."""

    def __init__(self, items: list[tuple], span: int, similarity: float, min_words: int):
        self.similarity, self.vocabulary, self.items, self.ids = similarity, {}, [], []
        by_span: dict[int, list[int]] = {}
        for item_id, text in items:
            own = tokens(text)
            if len(own) >= min_words:
                by_span.setdefault(min(span, len(own)), []).append(len(self.items))
                self.items.append(item_id)
                self.ids.append(own)
        rng = np.random.default_rng(7)
        for w in sorted({w for own in self.ids for w in own}):
            self.vocabulary[w] = int(rng.integers(1, 2**63))
        self.ids = [np.array([self.vocabulary[w] for w in own], U64) for own in self.ids]
        self.spans = []
        for n, members in sorted(by_span.items()):
            errors = int((1 - similarity) * n + 1e-9)
            hashes, item, place = [], [], []
            for k in members:
                for h in mask_hashes(self.ids[k], n, errors):
                    hashes.append(h)
                    item.append(np.full(len(h), k, np.int32))
                    place.append(np.arange(len(h), dtype=np.int32))
            keys = np.concatenate(hashes)
            order = np.argsort(keys, kind="stable")
            keys = keys[order]
            bits = max(10, int(8 * len(keys)).bit_length())
            seen = np.zeros(1 << bits, bool)
            seen[keys >> U64(64 - bits)] = True
            self.spans.append((n, errors, keys, np.concatenate(item)[order], np.concatenate(place)[order], seen, bits))

    def hits(self, ids: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        """Verified overlaps (document, item, words) in texts that stand one after the other in ``ids``."""
        done = set()
        for span, errors, keys, item, place, seen, bits in self.spans:
            for h in mask_hashes(ids, span, errors):
                at = np.flatnonzero(seen[h >> U64(64 - bits)])
                low, high = np.searchsorted(keys, h[at], "left"), np.searchsorted(keys, h[at], "right")
                doc = np.searchsorted(ends, at, side="right")
                ok = (high > low) & (at + span <= ends[np.minimum(doc, len(ends) - 1)])
                for p, d, a, b in zip(at[ok].tolist(), doc[ok].tolist(), low[ok].tolist(), high[ok].tolist(), strict=True):
                    for k, q in zip(item[a:b].tolist(), place[a:b].tolist(), strict=True):
                        if (d, k, p - q) in done:
                            continue
                        words = self.extend(ids, int(starts[d]), int(ends[d]), k, p, q, span, errors)
                        if words:
                            done.add((d, k, p - q))
                            yield d, self.items[k], words

    def extend(self, ids, start: int, end: int, k: int, p: int, q: int, span: int, errors: int) -> int:
        """Words of the overlap around a hit, or 0 if its window differs in too many words."""
        item = self.ids[k]
        if int((ids[p : p + span] != item[q : q + span]).sum()) > errors:
            return 0
        left, right = min(p - start, q), min(end - p, len(item) - q)
        same = ids[p - left : p + right] == item[q - left : q + right]
        good, total, best = int(same[left : left + span].sum()), span, span
        for side in (range(left + span, left + right), range(left - 1, -1, -1)):
            more_good, more = good, total
            for x in side:
                more_good, more = more_good + int(same[x]), more + 1
                if same[x] and more_good >= self.similarity * more:
                    good, total = more_good, more
            best = total
        return best


def _blocks(sizes: list[int]):
    """Runs of texts of at most BLOCK_WORDS words in all (a longer text is a run of its own)."""
    at = total = 0
    for k, n in enumerate(sizes):
        if total + n > BLOCK_WORDS and k > at:
            yield at, k
            at, total = k, 0
        total += n
    if at < len(sizes):
        yield at, len(sizes)


def _pieces(span: int, most: int):
    """From (item_id, t): (item_id, t, n) with n words; texts beyond ``most`` words in pieces that overlap by span - 1 words."""

    def run(batches):
        for b in slices(batches, 64):
            at, texts, sizes = [], [], []
            for k, t in enumerate(b.column(1).to_pylist()):
                own = tokens(t)
                whole = len(own) <= most
                for s in [0] if whole else range(0, len(own) - span + 1, most - span + 1):
                    part = own if whole else own[s : s + most]
                    at.append(k)
                    texts.append(b" ".join(part))
                    sizes.append(len(part))
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int32())), pa.array(texts, pa.binary()), pa.array(sizes, pa.int64())], ["item_id", "t", "n"])

    return run


def _hits(texts: list[list[bytes]], seeds: SeedIndex):
    """(number of the text, item, words) of the verified overlaps of texts."""
    get = seeds.vocabulary.get
    for a, b in _blocks([len(t) for t in texts]):
        ends = np.cumsum([len(t) for t in texts[a:b]])
        ids = np.array([get(w, 0) for t in texts[a:b] for w in t], U64)
        for d, item, n in seeds.hits(ids, ends - np.diff(ends, prepend=0), ends):
            yield a + d, item, n


def find_leaks(docs: DataFrame, benchmark: DataFrame, span: int = 13, similarity: float = 0.8, min_words: int = 5, slice_words: int = 200_000) -> DataFrame:
    """``docs`` with contaminated (boolean), n_items, overlap_words (longest overlap) and item_ids of what they hold."""
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession)
    id_type = benchmark.schema["item_id"].dataType.simpleString()
    plain = docs.drop("contaminated", "n_items", "overlap_words", "item_ids")
    read = benchmark.select("item_id", text_bytes().alias("t"))
    items = scratch.table(read.mapInArrow(_pieces(span, max(2 * span, slice_words)), f"item_id {id_type}, t binary, n long").filter(F.col("n") >= min_words))
    total = items.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    n_slices = max(1, -(-total // slice_words))

    def index(k: int):
        part = items.filter(F.pmod(F.xxhash64("item_id", "t"), F.lit(n_slices)) == k)
        return spark.sparkContext.broadcast(SeedIndex([(r[0], bytes(r[1])) for r in part.orderBy("item_id", "t").collect()], span, similarity, min_words))

    hit = f"struct<item:{id_type},words:long>"
    if n_slices == 1:
        only = index(0)

        def scan(batches):
            for batch in slices(batches, 1024):
                column = batch.schema.get_field_index("_t")
                rows: list[list] = [[] for _ in range(batch.num_rows)]
                for d, item, n in _hits([tokens(t) for t in batch.column(column).to_pylist()], only.value):
                    rows[d].append({"item": item, "words": n})
                at = batch.schema.get_field_index("_hits")
                yield batch.set_column(at, "_hits", pa.array(rows, batch.schema.field("_hits").type)).drop_columns(["_t"])

        out = plain.withColumn("_hits", F.array().cast(f"array<{hit}>"))
        out = out.withColumn("_t", text_bytes()).mapInArrow(scan, out.schema)
    else:
        id_arrow = to_arrow_type(benchmark.schema["item_id"].dataType)
        keyed = plain.select(doc_key().alias("_key"), text_bytes().alias("_t"))
        parts = []
        for k in range(n_slices):
            shared = index(k)

            def emit(batches, shared=shared):
                for batch in slices(batches, 1024):
                    found = list(_hits([tokens(t) for t in batch.column(1).to_pylist()], shared.value))
                    keys = batch.column(0).take(pa.array([d for d, _, _ in found], pa.int32()))
                    columns = [keys, pa.array([x[1] for x in found], id_arrow), pa.array([x[2] for x in found], pa.int64())]
                    yield pa.RecordBatch.from_arrays(columns, ["_key", "item", "words"])

            # One table for each slice: its index is not needed again, whatever executors are lost later.
            parts.append(scratch.table(keyed.mapInArrow(emit, f"_key long, item {id_type}, words long").distinct(), keep=True))
            shared.destroy()
        hits = parts[0]
        for part in parts[1:]:
            hits = hits.unionByName(part)
        by_row = hits.groupBy("_key").agg(F.collect_set(F.struct("item", "words")).alias("_hits"))  # at most the benchmark's items
        out = plain.withColumn("_key", doc_key()).join(by_row, "_key", "left").drop("_key")
        out = out.withColumn("_hits", F.coalesce("_hits", F.array().cast(f"array<{hit}>")))
    scratch.clear()
    return out.select(
        *plain.columns,
        (F.size("_hits") > 0).alias("contaminated"),
        F.size(F.array_distinct("_hits.item")).cast("long").alias("n_items"),
        F.coalesce(F.array_max("_hits.words"), F.lit(0)).cast("long").alias("overlap_words"),
        F.array_sort(F.array_distinct("_hits.item")).alias("item_ids"),
    )
