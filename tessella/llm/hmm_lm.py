"""A hidden Markov language model of documents.

A text is its lower-cased (A-Z) words and one end token. Words fall into ``buckets`` hash buckets, the model's symbols, so
its size does not grow with the vocabulary; a word's probability is its bucket's times its smoothed share of the bucket,
and every bucket keeps a share for unseen words, so the probabilities of all texts sum to one.

Training: token counts of all training documents are gathered by hash (map-side, then one shuffle). Baum-Welch rounds run
the scaled forward and backward recursions over every training document; each task adds up its expected counts and sends
them once, and a grouped sum over tasks gives the next model. Scoring is the scaled forward recursion over the whole
text, so the likelihood is exact. Documents advance together, sorted by length: step t is one small matrix product over
all documents that still have a token t.

The vocabulary may be large: only its most frequent part (the types from the least count on that at most ``head`` types
reach) is broadcast; occurrences of the other types, none of which is more than one in ``head`` of all tokens, are joined to
their counts by hash. Counts and vocabulary grow with the corpus; the chain's tables have a fixed size. Intermediate tables
go to the shared folder.

Defined results: null and empty texts are the end token alone; repeated rows count as often as they occur and score the
same; a null doc_id counts as the empty text in the hold-out rule; with no training documents every base score is 0; an
empty table gives an empty one. Very long texts are learned and scored whole: the backward recursion recomputes the forward
one segment by segment from kept entry points, so memory holds a segment of steps, not a text's.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, text_bytes, words

U64 = np.uint64
#: Additive smoothing of token counts (a fixed value of the data contract).
ADD = 0.1
#: What a Python worker holds at once: types counted, bytes of text split into words, tokens run through the model.
FLUSH_TYPES = 200_000
BLOCK_BYTES = 1 << 20
BLOCK_TOKENS = 300_000


def held_out() -> Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 10 == 0


def hashes(types: list[bytes]) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(w) for w in types), U64, len(types))


def token_counts(docs: DataFrame) -> DataFrame:
    """(h, c): how often each word occurs, by hash."""

    def run(batches):
        counts: dict[bytes, int] = {}

        def flush():
            h = hashes(list(counts)).view(np.int64)
            c = np.fromiter(counts.values(), np.int64, len(counts))
            counts.clear()
            return pa.RecordBatch.from_arrays([pa.array(h), pa.array(c)], ["h", "c"])

        get = counts.get
        for b in batches:
            for text in b.column(0).to_pylist():
                for w in words(text):
                    counts[w] = get(w, 0) + 1
                if len(counts) > FLUSH_TYPES:
                    yield flush()
        yield flush()

    parts = docs.select(text_bytes().alias("t")).mapInArrow(run, "h long, c long")
    return parts.groupBy("h").agg(F.sum("c").alias("c"))


@dataclass
class Head:
    """The most frequent types, by hash."""

    h: np.ndarray
    log: np.ndarray


def _blocks(sizes: list[int], limit: int):
    at = total = 0
    for k, n in enumerate(sizes):
        if total + n > limit and k > at:
            yield at, k
            at, total = k, 0
        total += n
    if at < len(sizes):
        yield at, len(sizes)


def tokenise(docs: DataFrame, head: Head, buckets: int) -> DataFrame:
    """One row per document: bucket ids of its tokens, sums over its head types, and its other types with their counts."""
    shared = docs.sparkSession.sparkContext.broadcast(head)

    def run(batches):
        top = shared.value
        for b in batches:
            texts = b.column(3).to_pylist()
            for s, e in _blocks([len(t) for t in texts], BLOCK_BYTES):
                yield _tokenised(b.slice(s, e - s), [words(t) for t in texts[s:e]], top, buckets)

    id_type = docs.schema["doc_id"].dataType.simpleString()
    read = docs.select(F.monotonically_increasing_id().alias("uid"), "doc_id", held_out().alias("held_out"), text_bytes().alias("t"))
    schema = f"uid long, doc_id {id_type}, held_out boolean, n_tokens long, ids binary, head_log double, head_known long, th array<long>, tn array<long>"
    return read.mapInArrow(run, schema)


def _tokenised(batch, texts: list[list[bytes]], top: Head, buckets: int) -> pa.RecordBatch:
    n = len(texts)
    flat = [w for t in texts for w in t]
    types = list(dict.fromkeys(flat))
    index = {w: i for i, w in enumerate(types)}
    at = np.fromiter(map(index.__getitem__, flat), np.int64, len(flat))
    h = hashes(types)
    slot = np.minimum(np.searchsorted(top.h, h), max(0, len(top.h) - 1))
    known = top.h[slot] == h if len(top.h) else np.zeros(len(h), bool)
    log = np.where(known, top.log[slot], 0.0) if len(top.h) else np.zeros(len(h))
    doc = np.repeat(np.arange(n), [len(t) for t in texts])
    rest = ~known[at]
    pair, times = np.unique(doc[rest] * max(1, len(types)) + at[rest], return_counts=True)
    d, k = np.divmod(pair, max(1, len(types)))
    offsets = pa.array(np.searchsorted(d, np.arange(n + 1)).astype(np.int32))
    bucket = (h % U64(buckets)).astype("<u2")[at]
    cuts = np.cumsum([0, *map(len, texts)])
    end = np.array([buckets], "<u2").tobytes()
    return pa.RecordBatch.from_arrays(
        [
            batch.column(0), batch.column(1), batch.column(2),
            pa.array([len(t) + 1 for t in texts], pa.int64()),
            pa.array([bucket[a:b].tobytes() + end for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary()),
            pa.array(np.bincount(doc, log[at], n)),
            pa.array(np.bincount(doc, known[at], n).astype(np.int64)),
            pa.ListArray.from_arrays(offsets, pa.array(h.view(np.int64)[k])),
            pa.ListArray.from_arrays(offsets, pa.array(times.astype(np.int64))),
        ],
        ["uid", "doc_id", "held_out", "n_tokens", "ids", "head_log", "head_known", "th", "tn"],
    )


@dataclass
class Model:
    """start (K), move (K, K) and, by symbol, emit (symbols, K)."""

    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray

    @classmethod
    def random(cls, states: int, symbols: np.ndarray, seed: int = 5) -> Model:
        rng = np.random.default_rng(seed)
        emit = symbols[:, None] * np.exp(rng.normal(0, 0.7, (len(symbols), states)))
        move = np.full((states, states), 0.3 / states) + 0.7 * np.eye(states)
        return cls(np.full(states, 1 / states), move, emit / emit.sum(0))

    @classmethod
    def from_counts(cls, counts: np.ndarray, states: int, symbols: np.ndarray, prior: float = 20.0) -> Model:
        k = states
        start = counts[:k] + 1 / k
        move = counts[k : k + k * k].reshape(k, k) + 1 / k
        emit = counts[k + k * k :].reshape(len(symbols), k) + prior * symbols[:, None]
        return cls(start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(0))


class Packed:
    """Sequences of symbols by step: the tokens number t of all sequences that have one stand together."""

    def __init__(self, sequences: list[np.ndarray]):
        sizes = np.array([len(s) for s in sequences])
        self.order = np.argsort(-sizes, kind="stable")
        sizes = sizes[self.order]
        self.steps = int(sizes[0])
        self.active = np.searchsorted(-sizes, -np.arange(self.steps), side="left")
        self.offset = np.concatenate([[0], np.cumsum(self.active)])
        self.symbols = np.empty(int(self.offset[-1]), np.uint16)
        for i, k in enumerate(self.order):
            s = sequences[k]
            self.symbols[self.offset[: len(s)] + i] = s

    def rows(self, t: int) -> slice:
        return slice(self.offset[t], self.offset[t + 1])


def log_likelihoods(sequences: list[np.ndarray], model: Model) -> np.ndarray:
    """Natural log probability of each sequence of symbols, by the scaled forward recursion."""
    packed = Packed(sequences)
    total = np.zeros(len(sequences))
    a = None
    for t in range(packed.steps):
        n = packed.active[t]
        e = model.emit[packed.symbols[packed.rows(t)]]
        a = e * model.start if a is None else (a[:n] @ model.move) * e
        scale = a.sum(1)
        a /= scale[:, None]
        total[:n] += np.log(scale)
    out = np.empty(len(sequences))
    out[packed.order] = total
    return out


def _segments(packed: Packed) -> list[tuple[int, int]]:
    """Runs of steps of at most BLOCK_TOKENS tokens (or a single step)."""
    cuts = [0]
    while cuts[-1] < packed.steps:
        fits = int(np.searchsorted(packed.offset, packed.offset[cuts[-1]] + BLOCK_TOKENS, "right")) - 1
        cuts.append(max(cuts[-1] + 1, fits))
    return list(zip(cuts[:-1], cuts[1:], strict=True))


def _forward(packed: Packed, model: Model, entry: np.ndarray | None, first: int, stop: int):
    """Emissions, scaled forward variables and scales of some steps; ``entry`` are the variables of the step before."""
    base = packed.offset[first]
    emit = model.emit[packed.symbols[base : packed.offset[stop]]]
    alpha, scale = np.empty_like(emit), np.empty(len(emit))
    a = entry
    for t in range(first, stop):
        at = slice(packed.offset[t] - base, packed.offset[t + 1] - base)
        a = emit[at] * model.start if a is None else (a[: packed.active[t]] @ model.move) * emit[at]
        c = a.sum(1)
        a /= c[:, None]
        alpha[at], scale[at] = a, c
    return emit, alpha, scale


def expected_counts(sequences: list[np.ndarray], model: Model, counts: np.ndarray) -> None:
    """Adds Baum-Welch counts of the sequences to ``counts`` (start, move, emit, flat)."""
    k, symbols = len(model.start), len(model.emit)
    packed = Packed(sequences)
    segments = _segments(packed)
    entries: list[np.ndarray | None] = [None]
    for first, stop in segments[:-1]:
        alpha = _forward(packed, model, entries[-1], first, stop)[1]
        entries.append(alpha[packed.offset[stop - 1] - packed.offset[first] :].copy())
    moves, back = np.zeros((k, k)), model.move.T.copy()
    table = counts[k + k * k :].reshape(symbols, k)
    beta = np.ones((packed.active[-1], k))
    for (first, stop), entry in zip(reversed(segments), reversed(entries), strict=True):
        emit, alpha, scale = _forward(packed, model, entry, first, stop)
        emit /= scale[:, None]
        base = packed.offset[first]
        for t in range(stop - 1, first - 1, -1):
            at, n = slice(packed.offset[t] - base, packed.offset[t + 1] - base), packed.active[t]
            weighed = emit[at] * beta
            if t:
                before = alpha[packed.offset[t - 1] - base :] if t > first else entry
                moves += before[:n].T @ weighed
            alpha[at] *= beta
            if t:
                beta = np.ones((packed.active[t - 1], k))
                beta[:n] = weighed @ back
        own = packed.symbols[base : packed.offset[stop]]
        for j in range(k):
            table[:, j] += np.bincount(own, alpha[:, j], symbols)
        if not first:
            counts[:k] += alpha[: packed.active[0]].sum(0)
    counts[k : k + k * k] += (moves * model.move).ravel()


def _sequences(column) -> list[np.ndarray]:
    return [np.frombuffer(x, "<u2") for x in column.to_pylist()]


def baum_welch(tokens: DataFrame, symbols: np.ndarray, states: int, rounds: int) -> Model:
    """Trains on all rows of ``tokens`` (ids); what a task sends is bounded by the model's size."""
    spark, model = tokens.sparkSession, Model.random(states, symbols)
    size = states + states * states + len(symbols) * states
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(model)

        def run(batches, shared=shared):
            now, counts = shared.value, np.zeros(size)
            for b in batches:
                own = sorted(_sequences(b.column(0)), key=len, reverse=True)
                for x, y in _blocks([len(s) for s in own], BLOCK_TOKENS):
                    expected_counts(own[x:y], now, counts)
            k = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(counts[k])], ["k", "v"])

        sums = tokens.select("ids").mapInArrow(run, "k long, v double").groupBy("k").agg(F.sum("v").alias("v")).toPandas()
        counts = np.zeros(size)
        counts[sums.k.to_numpy()] = sums.v.to_numpy()
        model = Model.from_counts(counts, states, symbols)
        shared.unpersist()
    return model


def least_count(counts: DataFrame, head: int) -> int:
    """The least count that at most ``head`` types of (h, c) reach, by histograms of 1,024 bins, each within one bin of the last."""
    most = counts.agg(F.max("c")).first()[0] or 0
    shift, low, above = max(0, (most.bit_length() - 1) // 10 * 10), 0, 0
    while True:
        within = counts.filter((F.col("c") >= low) & (F.col("c") < low + (1 << shift + 10)))
        bins = within.groupBy(F.shiftright(F.col("c") - low, shift).alias("bin")).count().collect()
        for r in sorted(bins, reverse=True):
            if above + r["count"] > head:
                low += r["bin"] << shift
                break
            above += r["count"]
        else:
            return low
        if not shift:
            return low + 1
        shift -= 10


def score_documents(docs: DataFrame, states: int = 8, buckets: int = 8192, rounds: int = 4, head: int = 200_000) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every document; logs to base 10."""
    spark = docs.sparkSession
    scratch = Scratch(spark)
    trained = docs.filter(~held_out())
    counts = scratch.table(token_counts(trained), keep=True)
    # The signed hash gives the same bucket as the unsigned one, as buckets is a power of two.
    by_bucket = counts.groupBy(F.pmod("h", F.lit(buckets)).alias("b")).agg(F.sum("c").alias("c"), F.count("*").alias("v")).toPandas()
    n_docs = trained.count()
    n, v = int(by_bucket.c.sum()) + n_docs, int(by_bucket.v.sum()) + (n_docs > 0)
    mass = np.full(buckets, ADD)
    mass[by_bucket.b.to_numpy(int)] += by_bucket.c.to_numpy(float) + ADD * by_bucket.v.to_numpy(float)
    symbols = np.append(mass, n_docs + ADD)
    symbols /= symbols.sum()
    # Logs are of shares of this total, so that sums over long texts don't grow large before they cancel.
    total = float(n + ADD * (v + 1))
    log_mass = np.append(np.log10(mass / total), 0.0)

    least = least_count(counts, head)
    top = counts.filter(F.col("c") >= least).toPandas()
    h = top.h.to_numpy(np.int64).view(U64)
    order = np.argsort(h)
    frequent = Head(h[order], np.log10((top.c.to_numpy(float)[order] + ADD) / total))

    rows = scratch.table(tokenise(docs, frequent, buckets), keep=True)
    tail = rows.select("uid", F.explode(F.arrays_zip("th", "tn")).alias("x")).select("uid", F.col("x.th").alias("h"), F.col("x.tn").alias("n"))
    joined = tail.join(counts.filter(F.col("c") < least), "h")
    found = joined.groupBy("uid").agg(F.sum("n").alias("tail_known"), F.sum(F.col("n") * F.log10((F.col("c") + ADD) / total)).alias("tail_log"))
    model = baum_welch(rows.filter("NOT held_out"), symbols, states, rounds)
    shared = spark.sparkContext.broadcast((model, log_mass))

    def forward(batches):
        now, logs = shared.value
        for b in batches:
            own = _sequences(b.column(b.schema.get_field_index("ids")))
            out = np.zeros(len(own))
            by_size = np.argsort([-len(s) for s in own], kind="stable")
            for x, y in _blocks([len(own[i]) for i in by_size], BLOCK_TOKENS):
                part = [own[i] for i in by_size[x:y]]
                spent = [float(logs[s].sum()) for s in part]
                out[by_size[x:y]] = log_likelihoods(part, now) / np.log(10) - np.array(spent)
            yield b.drop_columns(["ids"]).append_column("chain", pa.array(out))

    kept = rows.select("uid", "doc_id", "held_out", "n_tokens", "head_log", "head_known", "ids")
    chained = kept.mapInArrow(forward, kept.drop("ids").withColumn("chain", F.lit(0.0)).schema)
    end_log, end_known = float(np.log10((n_docs + ADD) / total)), int(n_docs > 0)
    known = F.col("head_known") + F.coalesce("tail_known", F.lit(0))
    unseen = F.col("n_tokens") - 1 - known
    word_log = F.col("head_log") + F.coalesce("tail_log", F.lit(0.0)) + unseen * float(np.log10(ADD / total))
    return chained.join(found, "uid", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (known + end_known).cast("long").alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (word_log + end_log).alias("base_score"),
        (word_log + F.col("chain")).alias("score"),
    )
