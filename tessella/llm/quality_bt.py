"""Quality scores by Bradley-Terry pairwise ranking.

A text's score is linear in features of the whole text (length, word and line statistics, repetition, symbols, capitals).
Of two labelled texts the one of quality 1 is preferred; the weights minimise the logistic loss of preference pairs on
the difference of their features (Newton's method, L2 penalty). Pair scores have no zero point, so the cut is a quantile
of the training scores: the quantile level at which cutting agrees best with the training labels. The published score is
the logistic function of the distance to the cut, moved so that the cut lies at ``cut_score``.

The classifier is fitted on at most ``max_labelled`` labelled documents, those with the smallest seeded hash, and on all of
their pairs, or on a seeded sample of ``max_pairs`` of them if there are more; both are parameters. Scoring reads every text
whole, one pass, without a shuffle.

Defined results: null and empty texts get the score of an empty text; repeated rows get equal scores; labels that are
null, or of documents not in the table, are ignored; a doc_id with several labels counts once with each different one, and
one with several texts with that of the smallest features; a null doc_id counts as the empty text in the hold-out rule; with
no labels of one of the classes every text scores ``cut_score`` and is predicted 1; an empty table gives an empty one.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_bytes

SYMBOLS = b"#*$%&|<>@^~=+_\\{}[]"
UPPER, LOWER, DIGITS = bytes(range(65, 91)), bytes(range(97, 123)), b"0123456789"
FEATURES = (
    "log_words", "mean_word", "symbols", "symbol_words", "capitals", "digits", "marks", "stops", "distinct", "log_distinct",
    "top_word", "repeat_pairs", "repeat_windows", "dup_lines", "short_lines", "log_line", "bars", "long_words", "same_next",
)


def count_of(text: bytes, chars: bytes) -> int:
    return len(text) - len(text.translate(None, chars))


def features(text: bytes) -> list[float]:
    """Numbers that describe a whole text, in the order of FEATURES."""
    own = text.split()
    n, size = max(1, len(own)), max(1, len(text))
    h = np.fromiter(map(hash, own), np.int64, len(own))
    counts = np.unique(h, return_counts=True)[1] if len(own) else np.zeros(1, int)

    def repeats(k: int) -> float:
        m = len(h) - k + 1
        if m < 2:
            return 0.0
        mixed = np.zeros(m, np.int64)
        for o in range(k):
            mixed = mixed * np.int64(1000003) + h[o : o + m]
        return 1 - len(np.unique(mixed)) / m

    lines = [x for x in text.split(b"\n") if x.strip()]
    n_lines = max(1, len(lines))
    symbols, upper, lower = count_of(text, SYMBOLS), count_of(text, UPPER), count_of(text, LOWER)
    lengths = np.fromiter(map(len, own), np.int64, len(own)) if own else np.zeros(1)
    return [
        np.log1p(len(own)), lengths.mean(), symbols / size, min(symbols / n, 4.0), upper / max(1, upper + lower), count_of(text, DIGITS) / size,
        min(count_of(text, b"!?") / n, 3.0), count_of(text, b".,;") / n, len(counts) / n, np.log1p(len(counts)),
        counts.max() / n, repeats(2), repeats(5), 1 - len(set(lines)) / n_lines, sum(len(x) < 20 for x in lines) / n_lines, np.log1p(size / n_lines),
        min(text.count(b"|") / n, 2.0), (lengths > 20).mean(), float((h[1:] == h[:-1]).mean()) if len(h) > 1 else 0.0,
    ]


@dataclass
class Ranking:
    """Standardised linear scores, the cut and where the cut lies among published scores."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float
    cut_score: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -6, 6) @ self.weights

    def scores(self, x: np.ndarray) -> np.ndarray:
        at = np.clip(self.raw(x) - self.cut, -30, 30) + np.log(self.cut_score / (1 - self.cut_score))
        return 1 / (1 + np.exp(-at))


def fit_ranking(x: np.ndarray, y: np.ndarray, max_pairs: int = 100_000, penalty: float = 1e-2, cut_score: float = 0.3, seed: int = 11) -> Ranking:
    """Bradley-Terry weights from features ``x`` and labels ``y`` (0 or 1)."""
    d = len(FEATURES)
    x = x.reshape(-1, d)
    if not (0 < y.sum() < len(y)):
        return Ranking(np.zeros(d), np.ones(d), np.zeros(d), 0.0, cut_score)
    model = Ranking(x.mean(0), np.maximum(x.std(0), 1e-6), np.zeros(d), 0.0, cut_score)
    z = np.clip((x - model.mean) / model.scale, -6, 6)
    rng = np.random.default_rng(seed)
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if len(good) * len(bad) <= max_pairs:
        diff = (z[good][:, None] - z[bad][None, :]).reshape(-1, d)
    else:
        diff = z[rng.choice(good, max_pairs)] - z[rng.choice(bad, max_pairs)]
    n = len(diff)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(diff @ model.weights, -30, 30)))
        slope = diff.T @ (1 - p) / n - penalty * model.weights
        bend = (diff * (p * (1 - p))[:, None]).T @ diff / n + penalty * np.eye(d)
        step = np.linalg.solve(bend, slope)
        model.weights = model.weights + step
        if np.abs(step).max() < 1e-8:
            break
    raw = z @ model.weights
    order = np.argsort(raw, kind="stable")
    # Cutting at the quantile k / n calls the k lowest scores bad; agreement with the labels for every k.
    agree = np.concatenate([[0], np.cumsum(y[order] == 0)]) + (y.sum() - np.concatenate([[0], np.cumsum(y[order] == 1)]))
    k = int(np.flatnonzero(agree == agree.max()).mean())
    edge = np.concatenate([[raw[order[0]] - 1], raw[order], [raw[order[-1]] + 1]])
    model.cut = float((edge[k] + edge[k + 1]) / 2)
    return model


def held_out() -> Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, max_labelled: int = 20_000, **options) -> Ranking:
    """Fits on labelled rows whose crc32(doc_id) mod 5 is not 0."""
    usable = labels.select("doc_id", F.col("quality").cast("int").alias("quality")).filter("quality IN (0, 1) AND doc_id IS NOT NULL")
    sample = usable.distinct().filter(~held_out()).orderBy(F.xxhash64("doc_id", F.lit(3)), "doc_id", "quality").limit(max_labelled)
    rows = docs.select("doc_id", text_bytes().alias("t")).join(F.broadcast(sample), "doc_id").select("t", "quality", "doc_id")

    def run(batches):
        for b in batches:
            x = [features(t) for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(2), b.column(1), pa.array(x, pa.list_(pa.float64()))], ["doc_id", "quality", "x"])

    measured = rows.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, quality int, x array<double>")
    # One row for each sampled label, however often a document is repeated: at most ``max_labelled`` rows.
    found = measured.groupBy("doc_id", "quality").agg(F.min("x").alias("x")).toPandas().sort_values(["doc_id", "quality"], kind="stable")
    x = np.array(found.x.tolist(), float)
    return fit_ranking(x, found.quality.to_numpy(), **options)


def score(docs: DataFrame, model: Ranking) -> DataFrame:
    """``docs`` with held_out, score and predicted."""
    plain = docs.drop("held_out", "score", "predicted")
    read = plain.withColumn("held_out", held_out()).withColumn("score", F.lit(0.0)).withColumn("_t", text_bytes())

    def run(batches):
        for b in batches:
            t = b.column(b.schema.get_field_index("_t")).to_pylist()
            x = np.array([features(v) for v in t], float).reshape(-1, len(FEATURES))
            b = b.set_column(b.schema.get_field_index("score"), "score", pa.array(model.scores(x)))
            yield b.drop_columns(["_t"])

    kept = read.drop("_t").schema
    return read.mapInArrow(run, kept).withColumn("predicted", (F.col("score") >= model.cut_score).cast("int"))
