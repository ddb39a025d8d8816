"""Mixing sources to target weights by capped water-filling.

Each source gets a share of all words in proportion to its weight; a source that would have to be repeated more than
``max_epochs`` times is clamped there, and the excess goes to the others by weight until none is above. The clamped set
is a prefix of the sources ordered by cap / weight, so the fixed point is found with running sums instead of rounds.

A source's target is then met by whole repetitions of all its documents plus one fractional pass over its documents in a
seeded order, the last of them cut. The order is a hash of doc_id, so reruns agree; the running sum it needs is taken in
two levels (bins of the hash, then the documents of the single bin in which the target falls), so that no task sorts a
whole source.

Defined results: a null text has size 0; a null source is a source of its own, ranked last; documents of size 0 take 0;
rows that repeat a doc_id tie and are ordered by size; an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, word_count

BINS = 4096
HASH_BITS = 52


def seeded_hash(doc_id: Column, seed: int) -> Column:
    """52 bits of an MD5 over the seed and doc_id, the same in any SQL engine."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("long")


def source_targets(totals: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = 3) -> DataFrame:
    """Water-filled targets of ``totals`` (source, source_size): one row per source, so global windows are small."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = totals.withColumn("k", F.row_number().over(by_name) - 1)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("k") % len(weights) + 1).cast("int"))
    ranked = ranked.withColumn("weight", weight.cast("long")).withColumn("cap", F.col("source_size") * max_epochs)
    order = Window.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("k")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    filled = (
        ranked.withColumn("all_size", F.sum("source_size").over(everything))
        .withColumn("left_words", F.col("all_size") - (F.sum("cap").over(order) - F.col("cap")))
        .withColumn("left_weight", F.sum("weight").over(everything) - (F.sum("weight").over(order) - F.col("weight")))
        .withColumn("open", F.col("left_words") * F.col("weight") <= F.col("cap") * F.col("left_weight"))
    )
    level = F.first(F.when(F.col("open"), F.struct("left_words", "left_weight")), ignorenulls=True)
    at = Window.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("k")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    share = F.col("level.left_words").cast("double") * F.col("weight") / F.col("level.left_weight")
    return (
        filled.withColumn("level", level.over(at))
        .withColumn("target", F.coalesce(F.least(F.col("cap").cast("double"), share), F.lit(0.0)))
        .select("source", "source_size", "target")
    )


def sized_rows(docs: DataFrame, seed: int) -> DataFrame:
    """``docs`` with no_source and source_key, size, u (seeded hash of doc_id) and the bin of u."""
    named = {
        "no_source": F.col("source").isNull(),
        "source_key": F.coalesce(F.col("source").cast("string"), F.lit("")),
        "size": word_count(),
        "u": seeded_hash(F.col("doc_id"), seed),
    }
    return docs.withColumns(named).withColumn("bin", F.shiftright("u", HASH_BITS - BINS.bit_length() + 1))


SOURCE = ["no_source", "source_key"]


def source_plan(sized: DataFrame, weights: tuple[int, ...], max_epochs: int) -> DataFrame:
    """By source: source_size, target, whole passes, the last bin that the fractional pass enters (null: none), whether it ends
    within that bin, and how many words of that bin it takes."""
    bins = sized.groupBy(*SOURCE, "bin").agg(F.sum("size").alias("bin_size"))
    totals = bins.groupBy(*SOURCE).agg(F.sum("bin_size").alias("source_size"))
    named = totals.withColumn("source", F.when(~F.col("no_source"), F.col("source_key"))).select("source", "source_size")
    targets = source_targets(named, weights, max_epochs).select(
        F.col("source").isNull().alias("no_source"), F.coalesce("source", F.lit("")).alias("source_key"), "source_size", "target"
    )
    whole = F.when(F.col("source_size") > 0, F.floor(F.floor(F.col("target") + 0.5) / F.col("source_size"))).otherwise(0).cast("long")
    below = Window.partitionBy(*SOURCE).orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    entered = F.when(F.col("before") < F.col("need"), F.struct("bin", "bin_size", (F.col("need") - F.col("before")).alias("left")))
    return (
        bins.withColumn("before", F.sum("bin_size").over(below) - F.col("bin_size"))
        .join(targets, SOURCE)
        .withColumn("whole", whole)
        .withColumn("need", F.floor(F.col("target") + 0.5).cast("long") - F.col("whole") * F.col("source_size"))
        .groupBy(*SOURCE, "source_size", "target", "whole")
        .agg(F.max(entered).alias("x"))
        .select(*SOURCE, "source_size", "target", "whole", F.col("x.bin").alias("edge"), (F.col("x.left") < F.col("x.bin_size")).alias("ends_within"), "x.left")
    )


def in_cut_bin() -> Column:
    return F.coalesce(F.col("ends_within") & (F.col("bin") == F.col("edge")), F.lit(False))


def plain_extra() -> Column:
    """Words of the fractional pass that a row outside of the cut bin gives."""
    return F.when(F.col("bin") <= F.col("edge"), F.col("size")).otherwise(F.lit(0).cast("long"))


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = 3, seed: int = 20240229) -> DataFrame:
    """Rows of ``docs`` as (doc_id, size, source_size, target, taken): the words of each document that the mix takes."""
    scratch = Scratch(docs.sparkSession)
    sized = scratch.table(sized_rows(docs.select("doc_id", "text", "source"), seed).select("doc_id", *SOURCE, "size", "u", "bin"), keep=True)
    rows = sized.join(scratch.table(source_plan(sized, weights, max_epochs), keep=True), SOURCE)
    within = Window.partitionBy(*SOURCE).orderBy("u", "doc_id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    left = F.col("left") - (F.sum("size").over(within) - F.col("size"))
    plain = rows.filter(~in_cut_bin()).withColumn("extra", plain_extra())
    cut = rows.filter(in_cut_bin()).withColumn("extra", F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), left)))
    taken = (F.col("whole") * F.col("size") + F.col("extra")).cast("long").alias("taken")
    out = ["doc_id", "size", "source_size", "target", taken]
    return plain.select(*out).unionByName(cut.select(*out))


def mix_documents(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = 3, seed: int = 20240229) -> DataFrame:
    """Documents that the mix takes, with ``taken`` words and the number of ``copies`` begun: the last pipeline stage.

    Every row is judged by its own source, so rows may share a doc_id. Texts are not shuffled, but for the one bin of each
    source in which the fractional pass ends. Rows equal in every column there form a group: the first of them are taken
    whole, one in part.
    """
    scratch = Scratch(docs.sparkSession)
    plain = docs.drop("taken", "copies")
    names = plain.columns
    sized = scratch.table(sized_rows(plain.select("doc_id", "text", "source"), seed).select("doc_id", *SOURCE, "size", "u", "bin"))
    plan = scratch.table(source_plan(sized, weights, max_epochs), keep=True)
    scratch.clear()
    own = F.struct(*[F.col(f"`{c}`") for c in names]).alias("row")
    keyed = plain.select(own, F.xxhash64(*[F.col(f"`{c}`") for c in names]).alias("key"), "doc_id", "text", "source")
    rows = sized_rows(keyed, seed).select("row", "key", *SOURCE, "size", "u", "bin").join(plan, SOURCE)
    usual = rows.filter(~in_cut_bin()).select("row", "size", (F.col("whole") * F.col("size") + plain_extra()).alias("taken"))
    same = [*SOURCE, "u", "size", "key", "whole", "left"]
    groups = rows.filter(in_cut_bin()).groupBy(*same).agg(F.first("row").alias("row"), F.count("*").alias("n"))
    within = Window.partitionBy(*SOURCE).orderBy("u", "size", "key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    spread = scratch.table(groups.drop("row").withColumn("words", F.col("n") * F.col("size")), keep=True)
    spread = spread.withColumn("left", F.col("left") - (F.sum("words").over(within) - F.col("words"))).drop("words", "n")
    ends = groups.drop("left").join(spread, [c for c in same if c != "left"])
    # Words that the k-th of a group's equal rows gives.
    each = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("k")
    ended = ends.select("row", "size", "whole", "left", each).select(
        "row", "size", (F.col("whole") * F.col("size") + F.greatest(F.lit(0).cast("long"), F.least("size", F.col("left") - F.col("k") * F.col("size")))).alias("taken")
    )
    copies = F.when(F.col("size") > 0, F.ceil(F.col("taken") / F.col("size"))).otherwise(0)
    return usual.unionByName(ended).filter("taken > 0").select("row.*", F.col("taken").cast("long").alias("taken"), copies.alias("copies"))


#: The same rows in DuckDB: running sums over whole sources, in the same order.
ORACLE_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5('20240229:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT AS u
  FROM documents),
totals AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
ranked AS (
  SELECT *, 3 * source_size AS cap,
         (row_number() OVER (ORDER BY source COLLATE "C" ASC NULLS LAST) - 1) AS k FROM totals),
weighted AS (SELECT *, (k % 3 + 1)::BIGINT AS weight FROM ranked),
filled AS (
  SELECT *, ((sum(source_size) OVER ()) - (sum(cap) OVER o - cap))::BIGINT AS left_words,
         ((sum(weight) OVER ()) - (sum(weight) OVER o - weight))::BIGINT AS left_weight
  FROM weighted WINDOW o AS (ORDER BY cap / weight, k ROWS UNBOUNDED PRECEDING)),
level AS (
  SELECT left_words, left_weight FROM filled WHERE left_words * weight <= cap * left_weight
  ORDER BY cap / weight, k LIMIT 1),
targets AS (
  SELECT f.source, f.source_size,
         coalesce(least(f.cap::DOUBLE, l.left_words::DOUBLE * f.weight / l.left_weight), 0.0) AS target
  FROM filled f LEFT JOIN level l ON true),
planned AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(floor(target + 0.5) / source_size) ELSE 0 END::BIGINT AS whole FROM targets),
running AS (
  SELECT s.doc_id, s.size, p.source_size, p.target, p.whole,
         floor(p.target + 0.5)::BIGINT - p.whole * p.source_size
           - (sum(s.size) OVER (PARTITION BY s.source ORDER BY s.u, s.doc_id, s.size ROWS UNBOUNDED PRECEDING) - s.size) AS left_over
  FROM sized s JOIN planned p ON s.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target,
       (whole * size + greatest(0, least(size, left_over)))::BIGINT AS taken
FROM running
"""
