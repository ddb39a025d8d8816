"""Line dedup by a deletion-neighbourhood join.

Of lines that are equal up to one word (substituted, inserted or left out) the earliest stays, in the order of doc_id and
line number. Lines are compared as words; white space does not matter, case does. Two lines are within one edit if and
only if they have a common variant: both without the word at the same position (a substitution), or one as it is and
the other without some word (an insertion). So variants are emitted as hashed keys, one for each position, and equal keys
are joined; the join needs minima of the order only, so groups of many lines are never paired up. What it proposes,
earlier lines for a line, is verified on the words.

Emitting the variants of every line would multiply the text. Lines within one edit have the first or the last half in
common, so a first join on hashes of halves, exact and cheap, leaves the lines that share one with a different line, and
only these emit variants, for the positions outside the shared half.

A half, a variant or a line that very many lines have is no task of its own: what is asked of a key are minima and maxima,
aggregated with partial sums, and joins back to them are open to skew splitting.

Lines of fewer than ``min_words`` words are compared exactly only (one edit in five words is a similarity of 0.8); lines
without a word are no lines and always stay.

Defined results: null and empty texts have no lines and stay; repeated rows (equal doc_id and text) stand at the same
place and get the same result; rows with a null doc_id come last; ids that are not integers are ordered as strings; an empty
table gives an empty one. A line is dropped if any earlier line is within the bound, also one that is dropped itself. Very
long lines emit one variant for each word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from .common import Scratch, doc_key, few, slices, text_bytes

U64 = np.uint64
MULTIPLIER = 0x9E3779B97F4A7C15
#: Rows that a Python worker holds at once.
ROWS_AT_ONCE = 100_000


def _line_rows(min_words: int, place_type: pa.DataType):
    """(key, place, no, h, later, halves) of every line with a word.

    A line is ``later`` if the task has met the same line at an earlier place: it repeats for sure, so hot lines are
    looked up once for each task. ``halves`` are hashes of the first and the last m words, m being half of the words,
    rounded down, and half of one fewer; hashes of first halves are odd, those of last halves even.
    """
    digest = xxhash.xxh64_intdigest

    def half(words: list, seed: int) -> int:
        return (digest(b" ".join(words), seed) >> 1 << 1 | seed) - (1 << 63)

    def flush(place, key, no, h, halves):
        key, no, h = (np.array(x, np.int64) for x in (key, no, h))
        order = np.lexsort((no, key, np.unique(np.array(place), return_inverse=True)[1], h))
        later = np.zeros(len(h), bool)
        later[order[1:]] = h[order[1:]] == h[order[:-1]]
        halves = [None if x else y for x, y in zip(later.tolist(), halves, strict=True)]
        columns = [pa.array(key), pa.array(place, place_type), *(pa.array(x) for x in (no, h, later))]
        return pa.RecordBatch.from_arrays([*columns, pa.array(halves, pa.list_(pa.int64()))], ["key", "place", "no", "h", "later", "halves"])

    def run(batches):
        rows = [], [], [], [], []
        place, key, no, h, halves = rows
        done: set[tuple[int, int]] = set()
        for b in slices(batches):
            for k, d, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                if (k, d) in done:  # a row that is repeated as a whole
                    continue
                done.add((k, d))
                for n, line in enumerate(text.split(b"\n")):
                    w = line.split()
                    if not w:
                        continue
                    place.append(d)
                    key.append(k)
                    no.append(n)
                    h.append(digest(b" ".join(w)) - (1 << 63))
                    m = len(w)
                    if m < min_words:
                        halves.append(None)
                    else:
                        sizes = {m // 2, (m - 1) // 2}
                        halves.append([half(w[:x], 1) for x in sizes] + [half(w[m - x :], 0) for x in sizes])
            if len(h) > ROWS_AT_ONCE:
                yield flush(*rows)
                for x in rows:
                    x.clear()
        if h:
            yield flush(*rows)

    return run


def place_type(docs: DataFrame) -> str:
    return "long" if isinstance(docs.schema["doc_id"].dataType, IntegralType) else "string"


def place(docs: DataFrame) -> Column:
    """Where a document stands: its id, or what is above all ids for null."""
    last = F.lit((1 << 63) - 1) if place_type(docs) == "long" else F.lit(chr(0x10FFFF) * 8)
    return F.coalesce(F.col("doc_id").cast(place_type(docs)), last)


def line_rows(docs: DataFrame, min_words: int) -> DataFrame:
    kind = place_type(docs)
    read = docs.select(doc_key().alias("key"), place(docs).alias("place"), text_bytes().alias("t"))
    run = _line_rows(min_words, pa.int64() if kind == "long" else pa.string())
    return read.mapInArrow(run, f"key long, place {kind}, no long, h long, later boolean, halves array<long>")


def _asked_lines(batches):
    """From (key, t, found): the lines asked for, with their texts."""
    done: set[int] = set()
    for b in slices(batches):
        out = []
        for key, text, found in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True):
            if key in done:  # a row that is repeated as a whole
                continue
            done.add(key)
            lines = text.split(b"\n")
            out += [(x["h"], x["first"], x["last"], b" ".join(lines[x["no"]].split())) for x in found]
        kinds = [pa.int64(), pa.bool_(), pa.bool_(), pa.binary()]
        columns = list(zip(*out, strict=True)) or [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["h", "first", "last", "line"])


def _word_hashes(line: bytes) -> np.ndarray:
    own = line.split()
    return np.fromiter(map(xxhash.xxh64_intdigest, own), U64, len(own))


def variants(line: bytes, first: bool, last: bool) -> tuple[int, np.ndarray, np.ndarray]:
    """Hash of a line; positions, and hashes of the line without the word there.

    ``first`` / ``last``: whether it shares its first / last half with another line; positions in a half that it need
    not share are left out.
    """
    h = _word_hashes(line)
    n = len(h)
    power = np.multiply.accumulate(np.concatenate([[U64(1)], np.full(n, U64(MULTIPLIER))]))
    # Sums of word hash times power of its position: exact modulo 2 ** 64.
    ahead = np.concatenate([[U64(0)], np.cumsum(h * power[:n])])
    behind = np.concatenate([[U64(0)], np.cumsum(h[1:] * power[: n - 1])]) if n else ahead
    low = (n - 1) // 2
    at = np.arange(low if first and not last else 0, n - low if last and not first else n)
    without = ahead[at] + (behind[-1] - behind[at])
    mix = lambda x, k: (x ^ (x >> U64(32))) * U64(0xD6E8FEB86659FD93) ^ U64(k)
    return int(mix(ahead[n : n + 1], n)[0]), at, mix(without, n - 1)


def within_one_edit(a: list, b: list) -> bool:
    """Whether two sequences differ by at most one substitution, insertion or deletion."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    k = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[k:] == b[k + 1 :] or (len(a) == len(b) and a[k + 1 :] == b[k + 1 :])


def _variant_rows(batches):
    """(v, p, h): variants of lines; p is the position left out, -1 for the line as it is."""
    for b in slices(batches):
        v, p, h = [], [], []
        for own, first, last, line in zip(*(b.column(k).to_pylist() for k in range(4)), strict=True):
            whole, at, without = variants(line, first, last)
            v += [np.array([whole], U64), without]
            p += [np.array([-1]), at]
            h.append(np.full(len(at) + 1, own))
        if h:
            columns = np.concatenate(v).view(np.int64), np.concatenate(p).astype(np.int32), np.concatenate(h).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["v", "p", "h"])


def earlier_lines(met: DataFrame) -> DataFrame:
    """From variants (v, p, h) with the places of their lines (struct ``at``): (h, g), lines and earlier ones that share a variant.

    The earliest line that lacks the word at the same position, the earliest that is the variant itself, and the earliest of
    those that are it without some word.
    """
    line = F.struct("at", "h")
    same = met.filter("p >= 0").groupBy("v", "p").agg(F.min(line).alias("same"))
    either = met.groupBy("v").agg(F.min(F.when(F.col("p") < 0, line)).alias("whole"), F.min(F.when(F.col("p") >= 0, line)).alias("shorter"))
    both = met.join(same, ["v", "p"], "left").join(either, "v")
    found = both.withColumn("other", F.explode(F.when(F.col("p") < 0, F.array("shorter")).otherwise(F.array("same", "whole"))))
    return found.filter("other.at < at").select("h", F.col("other.h").alias("g")).distinct()


def _verified(batches):
    for b in batches:
        ok = [within_one_edit(x.split(), y.split()) for x, y in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([b.column(0).filter(pa.array(ok, pa.bool_()))], ["h"])


def near_lines(docs: DataFrame, firsts: DataFrame) -> DataFrame:
    """(h): hashes of lines that have an earlier line within one edit, but not equal; ``firsts`` has one row for each line."""
    scratch = Scratch(docs.sparkSession)
    halves = firsts.select(F.explode("halves").alias("half"), "h", "key", "no")
    mixed = halves.groupBy("half").agg(F.min("h").alias("a"), F.max("h").alias("b")).filter("a <> b").select("half")
    first = (F.col("half") % 2 != 0).alias("first")
    sharing = halves.join(few(scratch.table(mixed)), "half", "left_semi").select("key", "no", "h", first)
    by_line = sharing.groupBy("key", "no", "h").agg(F.max("first").alias("first"), F.max(~F.col("first")).alias("last"))
    by_doc = by_line.groupBy("key").agg(F.collect_list(F.struct("h", "no", "first", "last")).alias("found"))  # at most a text's lines
    texts = docs.select(doc_key().alias("key"), text_bytes().alias("t")).join(by_doc, "key").select("key", "t", "found")
    asked = scratch.table(texts.mapInArrow(_asked_lines, "h long, first boolean, last boolean, line binary"))
    rows = scratch.table(asked.mapInArrow(_variant_rows, "v long, p int, h long"))
    common = rows.groupBy("v").agg(F.min("h").alias("a"), F.max("h").alias("b")).filter("a <> b").select("v")
    met = scratch.table(rows.join(few(scratch.table(common)), "v", "left_semi"))
    placed = met.join(firsts.select("h", F.struct("place", "key", "no").alias("at")), "h")
    pairs = scratch.table(earlier_lines(placed))
    ids = pairs.select("h").unionByName(pairs.select(F.col("g").alias("h"))).distinct()
    line = asked.select("h", "line").join(few(scratch.table(ids)), "h", "left_semi").groupBy("h").agg(F.first("line").alias("line"))
    line = scratch.table(line)
    both = pairs.join(line, "h").join(line.select(F.col("h").alias("g"), F.col("line").alias("other")), "g").select("h", "line", "other")
    found = scratch.table(both.mapInArrow(_verified, "h long").distinct(), keep=True)
    scratch.clear()
    return found


def line_decisions(docs: DataFrame, min_words: int = 5) -> DataFrame:
    """(key, n_lines, n_exact, n_near, dropped): by document row key, the lines that go and why."""
    scratch = Scratch(docs.sparkSession)
    rows = scratch.table(line_rows(docs, min_words), keep=True)
    early = rows.filter("NOT later")
    # Rows that stand at the same place are whole repeats of a document row: each is as early as the other.
    lead = F.min(F.struct("place", "key", "no", "halves")).alias("x")
    firsts = scratch.table(early.groupBy("h").agg(lead).select("h", "x.*"), keep=True)
    near = near_lines(docs, firsts.filter("halves IS NOT NULL")).withColumn("near", F.lit(True))
    lines = firsts.select("h", F.struct("place", "key", "no").alias("first")).join(near, "h", "left")
    found = early.join(lines, "h").withColumn("exact", F.struct("place", "key", "no") != F.col("first"))
    judged = found.select("key", "no", "exact", (F.col("near").isNotNull() & ~F.col("exact")).alias("near"))
    settled = rows.filter("later").select("key", "no", F.lit(True).alias("exact"), F.lit(False).alias("near"))
    # At most a text's lines; repeats of a row say the same.
    by_doc = settled.unionByName(judged).groupBy("key").agg(F.collect_set(F.struct(F.col("no").cast("int").alias("no"), "exact", "near")).alias("x"))
    n = lambda test: F.size(F.filter("x", test)).cast("long")
    gone = F.filter("x", lambda r: r["exact"] | r["near"])
    return by_doc.select(
        "key",
        F.size("x").cast("long").alias("n_lines"),
        n(lambda r: r["exact"]).alias("n_exact"),
        n(lambda r: r["near"]).alias("n_near"),
        F.array_sort(F.transform(gone, lambda r: r["no"])).alias("dropped"),
    )


def dedup_report(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, n_lines, n_exact, n_near, dropped) of every document; ``dropped`` are line numbers from 0."""
    found = line_decisions(docs, **options)
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    none = F.array().cast("array<int>")
    rows = docs.select("doc_id", doc_key().alias("key")).join(found, "key", "left")
    return rows.select("doc_id", zero("n_lines"), zero("n_exact"), zero("n_near"), F.coalesce("dropped", none).alias("dropped"))


def dedup_lines(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with the lines that stay in ``text``; documents of which no line stays go."""
    found = line_decisions(docs, **options).select(F.col("key").alias("_key"), "n_lines", "dropped")
    names = docs.columns
    rows = docs.withColumn("_key", doc_key()).join(found.select("_key", F.col("n_lines").alias("_n"), F.col("dropped").alias("_dropped")), "_key", "left")
    parts = F.split("text", "\n")
    stay = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col("_dropped"))
    text = F.when(F.size("_dropped") > 0, F.array_join(F.transform(stay, lambda i: F.get(parts, i)), "\n")).otherwise(F.col("text"))
    left = rows.filter("_n IS NULL OR _n > size(_dropped)")
    return left.withColumn("text", text).select(*names)
