"""Queries over the tables for the operators of the data plane, and the same in DuckDB SQL.

The tables hold no images, so the operators run on columns with the right shape: labels as truth and prediction,
embeddings as tensors, names and URLs as paths. Random choices come from integer arithmetic on ids.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import pixels
from .functions import scalars as S
from .functions.schedules import learning_rates
from .operators import confusion, epochs, losses, pairing
from .operators.draws import mixed_sql
from .operators.ranking import capped_batches, dense_index, first_samples, truncated
from .plans.config import checkpoint_name
from .sources import listing, sinks
from .streaming import replay

Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}
_sql: dict[str, str] = {}


def query(sql: str | None = None):
    """Decorator: registers a query under its name, with its SQL."""

    def add(f: Query) -> Query:
        _queries[f.__name__] = f
        if sql:
            _sql[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def elements(df: DataFrame, key: str, array: str, name: str, kind: str) -> DataFrame:
    """One row (key, k, value) for each element of an array column."""
    return df.select(key, F.posexplode(array).alias("k", "x")).select(key, "k", F.col("x").cast(kind).alias(name))


def elements_sql(select: str, key: str, array: str, name: str, kind: str, n: int) -> str:
    return f"SELECT {key}, k::INT AS k, {array}[k + 1]::{kind} AS {name} FROM ({select}), range({n}) t(k)"


# Evaluation -------------------------------------------------------------------------------------------------------

LABEL_CELLS = "SELECT quality * 2 + toxic AS cell, count(*) AS cnt FROM labels WHERE quality BETWEEN 0 AND 1 GROUP BY 1"


def _label_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = table(spark, sf_dir, "labels").select(F.lit(0).alias("frame"), F.col("quality").alias("gt"), F.col("toxic").alias("pred"))
    return confusion.frame_confusion(cells, 2)


@query(f"SELECT 0 AS frame, (cell // 2)::INT AS gt, (cell % 2)::INT AS pred, cnt FROM ({LABEL_CELLS})")
def a1_confusion(spark, sf_dir):
    return _label_counts(spark, sf_dir)


SPILL_SQL = """
WITH p AS (SELECT vec_id % 7 AS frame, label AS gt, label + (vec_id % 97 = 0)::INT * 2 AS pred FROM embeddings),
c AS (SELECT frame, gt * 10 + pred AS cell, count(*) AS cnt FROM p WHERE gt >= 0 AND gt < 10 GROUP BY ALL)
"""


def _spilled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions beyond the classes: most spill into the next row of the matrix, the last row's drop their frame."""
    e = table(spark, sf_dir, "embeddings")
    pred = F.col("label") + F.when(F.col("vec_id") % 97 == 0, 2).otherwise(0)
    return confusion.frame_confusion(e.select((F.col("vec_id") % 7).alias("frame"), F.col("label").alias("gt"), pred.alias("pred")), 10)


@query(SPILL_SQL + "SELECT frame, (cell // 10)::INT AS gt, (cell % 10)::INT AS pred, cnt FROM c WHERE frame IN (SELECT frame FROM c GROUP BY 1 HAVING max(cell) < 100)")
def a1_spill_drop(spark, sf_dir):
    return _spilled(spark, sf_dir)


@query(SPILL_SQL + "SELECT (cell // 10)::INT AS gt, (cell % 10)::INT AS pred, sum(cnt)::BIGINT AS cnt FROM c WHERE frame IN (SELECT frame FROM c GROUP BY 1 HAVING max(cell) < 100) GROUP BY 1, 2")
def a2_accumulate(spark, sf_dir):
    return confusion.accumulate(_spilled(spark, sf_dir))


CLASS_SQL = f"""
WITH c AS (SELECT (cell // 2)::INT AS gt, (cell % 2)::INT AS pred, cnt FROM ({LABEL_CELLS})),
k AS (SELECT n::INT AS cls FROM range(2) t(n)),
s AS (SELECT cls, coalesce((SELECT sum(cnt) FROM c WHERE gt = cls AND pred = cls), 0)::DOUBLE AS diag,
             coalesce((SELECT sum(cnt) FROM c WHERE gt = cls), 0)::DOUBLE AS r,
             coalesce((SELECT sum(cnt) FROM c WHERE pred = cls), 0)::DOUBLE AS p FROM k),
m AS (SELECT cls, diag / (r + 1e-12) AS acc, diag / (r + p - diag + 1e-12) AS iou FROM s),
h AS (SELECT coalesce(sum(cnt) FILTER (gt = pred), 0)::DOUBLE / (coalesce(sum(cnt), 0)::DOUBLE + 1e-12) AS pixel_acc FROM c)
"""


@query(CLASS_SQL + "SELECT pixel_acc, (SELECT avg(acc) FROM m) AS mean_class_acc, (SELECT avg(iou) FROM m) AS mean_class_iou FROM h")
def a3_a6_scores(spark, sf_dir):
    return confusion.scores(confusion.accumulate(_label_counts(spark, sf_dir)), 2)


@query(CLASS_SQL + "SELECT cls, acc, iou FROM m")
def a4_a5_class_scores(spark, sf_dir):
    return confusion.class_scores(confusion.accumulate(_label_counts(spark, sf_dir)), 2)


@query(
    CLASS_SQL
    + """
SELECT 0 AS line_no, printf('Mean pixel accuracy: %.6f', pixel_acc) AS line FROM h
UNION ALL SELECT 1, printf('Mean class accuracy: %.6f', (SELECT avg(acc) FROM m))
UNION ALL SELECT 2, printf('Mean class IoU: %.6f', (SELECT avg(iou) FROM m))
UNION ALL SELECT 3, '************ Per class numbers below ************'
UNION ALL SELECT cls + 4, printf('%s: acc = %.6f, iou = %.6f', rpad(CASE cls WHEN 0 THEN 'low' ELSE 'high' END, 15, ' '), acc, iou) FROM m
"""
)
def s19_report(spark, sf_dir):
    return confusion.report_lines(confusion.accumulate(_label_counts(spark, sf_dir)), ["low", "high"])


@query(
    """
WITH t AS (SELECT doc_id, quality FROM labels),
p AS (SELECT doc_id, max(toxic) AS toxic FROM labels GROUP BY 1)
SELECT t.doc_id, t.quality, p.toxic FROM t JOIN p USING (doc_id)"""
)
def j8_predictions(spark, sf_dir):
    labels = table(spark, sf_dir, "labels")
    return pairing.predictions_for(labels.select("doc_id", "quality"), labels.groupBy("doc_id").agg(F.max("toxic").alias("toxic")), "doc_id")


# Positions and pairs ------------------------------------------------------------------------------------------------

DOC_RANK = "(SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS idx FROM documents)"
ITEM_RANK = "(SELECT item_id, row_number() OVER (ORDER BY item_id) - 1 AS idx FROM benchmark)"


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dense_index(table(spark, sf_dir, "documents").select("doc_id"), "doc_id").select("idx", "doc_id")


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dense_index(table(spark, sf_dir, "benchmark").select("item_id"), "item_id").select("idx", "item_id")


@query(f"SELECT idx, doc_id FROM {DOC_RANK}")
def w1_dense_index(spark, sf_dir):
    return _docs(spark, sf_dir)


PAIRED = f"""
WITH a AS {DOC_RANK}, b AS {ITEM_RANK}, n AS (SELECT (SELECT count(*) FROM a) AS na, (SELECT count(*) FROM b) AS nb),
e AS (SELECT i AS idx, i % na AS a_idx, {{b_idx}} AS b_idx FROM n, range((SELECT greatest(na, nb) FROM n)) t(i))
SELECT e.idx, e.a_idx, e.b_idx, a.doc_id AS a_doc_id, b.item_id AS b_item_id
FROM e JOIN a ON a.idx = e.a_idx JOIN b ON b.idx = e.b_idx
"""


@query(PAIRED.format(b_idx="i % nb"))
def j1_cyclic_pair(spark, sf_dir):
    return pairing.cyclic_pairs(_docs(spark, sf_dir), _items(spark, sf_dir)).select("idx", "a_idx", "b_idx", "a_doc_id", "b_item_id")


@query(PAIRED.format(b_idx=f"{mixed_sql('i', 3, 1000)} % nb"))
def j2_random_pair(spark, sf_dir):
    return pairing.random_pairs(_docs(spark, sf_dir), _items(spark, sf_dir), epoch=3).select("idx", "a_idx", "b_idx", "a_doc_id", "b_item_id")


@query(
    """
WITH a AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS idx FROM labels),
b AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS idx FROM documents WHERE doc_id IN (SELECT doc_id FROM labels))
SELECT a.idx, printf('%04d.jpg', a.idx) AS name, a.doc_id AS a_doc_id, b.doc_id AS b_doc_id FROM a JOIN b USING (idx)"""
)
def j3_positional_zip(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").select("doc_id")
    docs = table(spark, sf_dir, "documents").select("doc_id").join(labels, "doc_id", "left_semi")
    pairs = pairing.positional_pairs(dense_index(labels, "doc_id"), dense_index(docs, "doc_id"))
    return pairs.select("idx", "name", "a_doc_id", "b_doc_id")


@query(
    """
WITH a AS (SELECT r_name AS split, n_name || '_A.png' AS name FROM nation JOIN region ON n_regionkey = r_regionkey),
b AS (SELECT r_name AS split, n_name || '_B.png' AS b_name FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey IN (SELECT s_nationkey FROM supplier WHERE s_acctbal < 0))
SELECT split, name AS a_name, b_name, replace(name, '_A.', '.') AS pair_name
FROM a JOIN b USING (split) WHERE replace(name, '_A.', '_B.') = b_name"""
)
def j4_name_equi_pair(spark, sf_dir):
    """Side B has files only for nations with a supplier in debt, so some names have no partner."""
    rows = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    a = rows.select(F.col("r_name").alias("split"), F.concat("n_name", F.lit("_A.png")).alias("name"))
    low = table(spark, sf_dir, "supplier").filter("s_acctbal < 0").select(F.col("s_nationkey").alias("n_nationkey"))
    b = rows.join(low, "n_nationkey", "left_semi").select(F.col("r_name").alias("split"), F.concat("n_name", F.lit("_B.png")).alias("name"))
    return pairing.name_pairs(a, b)


@query(
    """
WITH a AS (SELECT row_number() OVER (ORDER BY p) - 1 AS idx, p FROM (SELECT printf('maps/%06d_gtFine_color.png', item_id) AS p FROM benchmark))
SELECT idx, p AS a_path, replace(replace(p, 'maps/', 'photos/'), '_gtFine_color', '_leftImg8bit') AS b_path,
       replace(replace(replace(p, 'maps/', ''), '_gtFine_color', ''), '.png', '') AS frame FROM a"""
)
def j5_checked_pairs(spark, sf_dir):
    items = table(spark, sf_dir, "benchmark")
    maps = dense_index(items.select(F.format_string("maps/%06d_gtFine_color.png", "item_id").alias("path")), "path")
    photos = dense_index(items.select(F.format_string("photos/%06d_leftImg8bit.png", "item_id").alias("path")), "path")
    return pairing.checked_pairs(maps, photos).select("idx", "a_path", "b_path", "frame")


EPOCH_KEY = f"{mixed_sql('i', 2, 0)} * 4294967296 + i"
EPOCH_SQL = f"(SELECT i AS idx, row_number() OVER (ORDER BY {EPOCH_KEY}) - 1 AS pos FROM range((SELECT count(*) FROM documents)) t(i))"


@query(f"SELECT 2 AS epoch, pos, idx, doc_id FROM {EPOCH_SQL} JOIN {DOC_RANK} USING (idx)")
def j6_gather(spark, sf_dir):
    docs = _docs(spark, sf_dir)
    return pairing.gather(epochs.epoch_order(spark, docs.count(), 2), docs).select("epoch", "pos", "idx", "doc_id")


@query("SELECT vec_id, label, CASE label WHEN 0 THEN 7 WHEN 1 THEN 8 WHEN 2 THEN 11 WHEN 5 THEN 255 ELSE -1 END::INT AS train_id FROM embeddings")
def j7_lookup(spark, sf_dir):
    found = pairing.looked_up(table(spark, sf_dir, "embeddings").select("vec_id", "label"), "label", {0: 7, 1: 8, 2: 11, 5: 255}, "train_id")
    return found.fillna(-1, "train_id")


@query("SELECT url FROM pages ORDER BY string_split(url, '/'), url LIMIT 37")
def w2_w3_truncate(spark, sf_dir):
    return truncated(table(spark, sf_dir, "pages").select("url"), "url", 37)


# Epochs -------------------------------------------------------------------------------------------------------------


@query(f"SELECT 2 AS epoch, pos, idx FROM {EPOCH_SQL}")
def b1_shuffle(spark, sf_dir):
    return epochs.epoch_order(spark, table(spark, sf_dir, "documents").count(), 2)


@query(
    """
WITH n AS (SELECT count(*) AS n FROM documents)
SELECT 0 AS epoch, pos, pos % n AS idx, pos // 16 AS batch_id, (pos % 3)::INT AS rank
FROM n, range((SELECT (n + 2) // 3 * 3 FROM n)) t(pos)"""
)
def b2_b3_epoch_plan(spark, sf_dir):
    n = table(spark, sf_dir, "documents").count()
    return epochs.batched(epochs.sharded(epochs.epoch_order(spark, n, 0, serial=True), n, 3), 16)


@query("SELECT 0 AS epoch, i AS pos, i AS idx, i // 16 AS batch_id FROM range((SELECT count(*) FROM documents)) t(i) WHERE i // 16 * 16 < 100")
def w4_batch_cap(spark, sf_dir):
    n = table(spark, sf_dir, "documents").count()
    return capped_batches(epochs.batched(epochs.epoch_order(spark, n, 0, serial=True), 16), 16, 100)


@query(f"SELECT idx, doc_id FROM {DOC_RANK} WHERE idx < 50")
def w5_first_samples(spark, sf_dir):
    return first_samples(_docs(spark, sf_dir), 50)


@query(
    """
WITH n AS (SELECT (count(*) + 15) // 16 AS per FROM documents),
s AS (SELECT (i // per + 1)::INT AS epoch, (i % per + 1) * 16 AS epoch_iter, (i + 1) * 16 AS total_iters FROM n, range((SELECT 3 * per FROM n)) t(i))
SELECT *, total_iters % 400 = 0 AS show, total_iters % 400 = 0 AND total_iters % 1000 = 0 AS save_html,
       total_iters % 100 = 0 AS print, total_iters % 5000 = 0 AS save
FROM s WHERE total_iters % 400 = 0 OR total_iters % 100 = 0 OR total_iters % 5000 = 0"""
)
def w7_w8_triggers(spark, sf_dir):
    n = table(spark, sf_dir, "documents").count()
    return epochs.triggers(epochs.counters(spark, 3, n, 16))


@query("SELECT (epoch - 1) * (SELECT count(*) FROM documents) + epoch_iter AS step, epoch, epoch_iter FROM (SELECT (i // 5 + 1)::INT AS epoch, (i % 5 + 1) * 16 AS epoch_iter FROM range(20) t(i))")
def w6_global_step(spark, sf_dir):
    n = table(spark, sf_dir, "documents").count()
    rows = epochs.counters(spark, 4, 80, 16)
    return rows.select(epochs.global_step(F.col("epoch"), F.col("epoch_iter"), n).alias("step"), "epoch", "epoch_iter")


@query(
    """
SELECT (4 - e) * 3 + k AS row, e::INT AS epoch, label, printf('epoch%03d_%s.png', e, label) AS file
FROM range(1, 5) t(e), (VALUES (0, 'real_A'), (1, 'fake_B'), (2, 'rec_A')) v(k, label)"""
)
def w9_report_order(spark, sf_dir):
    return epochs.report_order(spark, 4, ["real_A", "fake_B", "rec_A"])


@query("SELECT (SELECT count(*) FROM documents) AS n_a, (SELECT count(*) FROM benchmark) AS n_b, greatest((SELECT count(*) FROM documents), (SELECT count(*) FROM benchmark)) AS length, least((SELECT count(*) FROM documents), 100) AS capped")
def a17_lengths(spark, sf_dir):
    side = lambda name, a: table(spark, sf_dir, name).select(F.lit(a).alias("a"))
    counts = side("documents", 1).unionByName(side("benchmark", 0)).agg(F.sum("a").alias("n_a"), F.sum(1 - F.col("a")).alias("n_b"))
    return counts.select("n_a", "n_b", F.greatest("n_a", "n_b").alias("length"), F.least("n_a", F.lit(100)).cast("long").alias("capped"))


@query(
    f"""
WITH r AS (SELECT row_number() OVER (ORDER BY p_partkey) - 1 AS idx, 300 + p_size * 7 AS width, 280 + p_size * 3 AS height FROM part)
SELECT idx, 0 AS epoch, width, height, ({mixed_sql('idx', 0, 1)} % (greatest(0, 286 - 256) + 1))::INT AS crop_x,
       ({mixed_sql('idx', 0, 2)} % (greatest(0, 286 * height // width - 256) + 1))::INT AS crop_y,
       {mixed_sql('idx', 0, 3)} % 1000 >= 500 AS flip FROM r"""
)
def p3_crop_and_flip(spark, sf_dir):
    parts = dense_index(table(spark, sf_dir, "part").select("p_partkey", "p_size"), "p_partkey")
    rows = parts.select("idx", F.lit(0).alias("epoch"), (300 + F.col("p_size") * 7).alias("width"), (280 + F.col("p_size") * 3).alias("height"))
    return epochs.crop_and_flip(rows, F.col("width"), F.col("height"), "scale_width_and_crop")


# Pixels and tensors ---------------------------------------------------------------------------------------------------

GRID = "(SELECT vec_id, (p // 8)::INT AS y, (p % 8)::INT AS x, floor((embedding[p + 1]::DOUBLE + 1) * 127.5)::INT AS v FROM embeddings, range(64) t(p))"


def _grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as 8 x 8 pixels in long form (vec_id, y, x, v), v scaled to bytes."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", F.posexplode("embedding").alias("p", "f"))
    v = F.floor((F.col("f").cast("double") + 1) * 127.5).cast("int")
    return e.select("vec_id", F.floor(F.col("p") / 8).cast("int").alias("y"), (F.col("p") % 8).alias("x"), v.alias("v"))


@query("SELECT p_partkey, p_size, CASE WHEN p_size = 20 AND p_size + 5 >= 16 THEN p_size ELSE 20 END AS width, CASE WHEN p_size = 20 AND p_size + 5 >= 16 THEN p_size + 5 ELSE floor(greatest(20 * (p_size + 5) / p_size, 16.0))::INT END AS height FROM part")
def p6_scaled_size(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", "p_size")
    return part.select("*", S.scaled_size(F.col("p_size"), F.col("p_size") + 5, 20, 16).alias("s")).select("p_partkey", "p_size", "s.width", "s.height")


@query("SELECT p_partkey, p_size, (round_even(p_size / 4, 0) * 4)::INT AS size FROM part")
def p7_multiple_of_four(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", "p_size", S.multiple_of_four(F.col("p_size")).alias("size"))


@query(elements_sql("SELECT vec_id, list_transform(embedding, lambda f: ((floor((f::DOUBLE + 1) * 127.5)::INT::FLOAT / 255::FLOAT)::FLOAT - 0.5::FLOAT) / 0.5::FLOAT) AS tensor FROM embeddings", "vec_id", "tensor", "v", "DOUBLE", 64))
def p11_normalise(spark, sf_dir):
    scaled = F.transform("embedding", lambda f: F.floor((f.cast("double") + 1) * 127.5).cast("int"))
    return elements(table(spark, sf_dir, "embeddings").select("vec_id", S.normalised(scaled).alias("tensor")), "vec_id", "tensor", "v", "double")


@query(elements_sql("SELECT vec_id, list_transform(embedding, lambda f: trunc((f::DOUBLE + 1) / 2 * 255)::INT) AS pixels FROM embeddings", "vec_id", "pixels", "v", "INT", 64))
def p13_denormalise(spark, sf_dir):
    return elements(table(spark, sf_dir, "embeddings").select("vec_id", S.denormalised(F.col("embedding")).alias("pixels")), "vec_id", "pixels", "v", "int")


@query(elements_sql("SELECT p_partkey, [(p_partkey % 256)::FLOAT - 72.78044::FLOAT, (p_size * 5 % 256)::FLOAT - 83.21195::FLOAT, (p_size % 256)::FLOAT - 73.45286::FLOAT] AS bgr FROM part", "p_partkey", "bgr", "v", "DOUBLE", 3))
def p16_bgr_minus_mean(spark, sf_dir):
    r, g, b = F.col("p_size") % 256, F.col("p_size") * 5 % 256, F.col("p_partkey") % 256
    bgr = table(spark, sf_dir, "part").select("p_partkey", S.bgr_minus_mean(r, g, b).alias("bgr"))
    return elements(bgr, "p_partkey", "bgr", "v", "double")


@query(elements_sql("SELECT vec_id, CASE label WHEN 0 THEN [128, 64, 128] WHEN 1 THEN [244, 35, 232] WHEN 8 THEN [107, 142, 35] ELSE [0, 0, 0] END AS colour FROM embeddings", "vec_id", "colour", "v", "INT", 3))
def p22_palette(spark, sf_dir):
    palette = {0: (128, 64, 128), 1: (244, 35, 232), 8: (107, 142, 35)}
    return elements(table(spark, sf_dir, "embeddings").select("vec_id", S.coloured(F.col("label"), palette).alias("colour")), "vec_id", "colour", "v", "int")


@query("SELECT vec_id, (list_position(embedding, list_max(embedding)) - 1)::INT AS pred FROM embeddings")
def p24_argmax(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select("vec_id", S.argmax(F.col("embedding")).alias("pred"))


@query("SELECT vec_id, CASE WHEN vec_id % 2 = 0 THEN label ELSE label + 10 END AS input, CASE WHEN vec_id % 2 = 0 THEN label + 10 ELSE label END AS target FROM embeddings")
def p26_direction(spark, sf_dir):
    direction = F.when(F.col("vec_id") % 2 == 0, "AtoB").otherwise("BtoA")
    s = S.swapped(direction, F.col("label"), F.col("label") + 10)
    return table(spark, sf_dir, "embeddings").select("vec_id", s.alias("s")).select("vec_id", "s.input", "s.target")


@query(elements_sql("SELECT vec_id, list_concat(embedding, list_reverse(embedding)) AS joined FROM embeddings", "vec_id", "joined", "v", "DOUBLE", 128))
def p27_channels(spark, sf_dir):
    joined = F.concat("embedding", F.reverse("embedding"))
    return elements(table(spark, sf_dir, "embeddings").select("vec_id", joined.alias("joined")), "vec_id", "joined", "v", "double")


@query("SELECT event_id, value, event_type FROM events")
def p28_projection(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", *["value", "event_type"])


@query(elements_sql("SELECT vec_id, list_transform(range(64), lambda k: embedding[((k % 32) * 2 + k // 32)::INT + 1]) AS chw FROM embeddings", "vec_id", "chw", "v", "DOUBLE", 64))
def f15_transpose(spark, sf_dir):
    return elements(table(spark, sf_dir, "embeddings").select("vec_id", S.transposed(F.col("embedding"), 2).alias("chw")), "vec_id", "chw", "v", "double")


RGB = """(SELECT vec_id, y, x, v AS r, (v * 3 + x) % 256 AS g, (v * 7 + y * 11) % 256 AS b FROM
  (SELECT vec_id, (p // 8)::INT AS y, (p % 8)::INT AS x, floor((embedding[p + 1]::DOUBLE + 1) * 127.5)::INT AS v FROM embeddings, range(64) t(p)))"""


def _images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as 8 x 8 RGB image rows."""
    grid = _grid(spark, sf_dir)
    pixel = F.array(F.col("v"), (F.col("v") * 3 + F.col("x")) % 256, (F.col("v") * 7 + F.col("y") * 11) % 256)
    ordered = F.array_sort(F.collect_list(F.struct("y", "x", pixel.alias("rgb"))))
    flat = F.flatten(F.transform(ordered, lambda p: p["rgb"]))
    text = F.array_join(F.transform(flat, lambda c: F.lpad(F.hex(c), 2, "0")), "")
    sizes = [F.lit(n).alias(c) for c, n in (("width", 8), ("height", 8), ("n_channels", 3))]
    return grid.groupBy("vec_id").agg(F.unhex(text).alias("pixels")).select("vec_id", *sizes, "pixels")


def _channels(images: DataFrame) -> DataFrame:
    """(vec_id, y, x, c, v) of image rows."""
    digits = F.regexp_extract_all(F.hex("pixels"), F.lit("(..)"), F.lit(1))
    rows = images.select("vec_id", "width", "n_channels", F.posexplode(digits).alias("k", "digit"))
    at = F.floor(F.col("k") / F.col("n_channels"))
    return rows.select(
        "vec_id", F.floor(at / F.col("width")).cast("int").alias("y"), (at % F.col("width")).cast("int").alias("x"),
        (F.col("k") % F.col("n_channels")).cast("int").alias("c"), F.conv("digit", 16, 10).cast("int").alias("v"),
    )


@query(f"SELECT vec_id, y, x, 0 AS c, ((r * 19595 + g * 38470 + b * 7471 + 32768) >> 16)::INT AS v FROM {RGB}")
def p4_luma(spark, sf_dir):
    return _channels(pixels.over_images(_images(spark, sf_dir), lambda image, _: pixels.luma(image)))


@query(
    f"""
SELECT e.vec_id, y::INT AS y, x::INT AS x, c::INT AS c, coalesce(CASE c WHEN 0 THEN r WHEN 1 THEN g ELSE b END, 0)::INT AS v
FROM (SELECT DISTINCT vec_id FROM embeddings) e, range(6) t(y), range(6) u(x), range(3) w(c)
LEFT JOIN (SELECT vec_id AS id, y - 1 AS py, x - 4 AS px, r, g, b FROM {RGB}) i ON i.id = e.vec_id AND py = y AND px = x"""
)
def p8_padded_crop(spark, sf_dir):
    """A 6 x 6 square from (4, 1): columns beyond the image are zero."""
    return _channels(pixels.over_images(_images(spark, sf_dir), lambda image, _: pixels.cut(image, 4, 1, 6)))


@query(f"SELECT vec_id, CASE WHEN x < 4 THEN 'A' ELSE 'B' END AS side, y, x % 4 AS x, c::INT AS c, CASE c WHEN 0 THEN r WHEN 1 THEN g ELSE b END::INT AS v FROM {RGB}, range(3) t(c)")
def p1_split_pair(spark, sf_dir):
    halves = [_channels(pixels.over_images(_images(spark, sf_dir), lambda image, _, k=k: pixels.split_pair(image)[k])) for k in (0, 1)]
    a, b = (half.withColumn("side", F.lit(name)) for half, name in zip(halves, "AB", strict=True))
    return a.unionByName(b).select("vec_id", "side", "y", "x", "c", "v")


@query(f"SELECT vec_id, y, CASE WHEN vec_id % 2 = 0 THEN 7 - x ELSE x END AS x, c::INT AS c, CASE c WHEN 0 THEN r WHEN 1 THEN g ELSE b END::INT AS v FROM {RGB}, range(3) t(c)")
def p10_flip(spark, sf_dir):
    rows = _images(spark, sf_dir).withColumn("flip", F.col("vec_id") % 2 == 0)
    return _channels(pixels.over_images(rows, lambda image, row: pixels.mirrored(image) if row["flip"] else image, ("flip",)))


@query(f"SELECT vec_id, y, x + 8 * k::INT AS x, c::INT AS c, CASE c WHEN 0 THEN r WHEN 1 THEN g ELSE b END::INT AS v FROM (SELECT vec_id, y, x, k, CASE k WHEN 0 THEN r ELSE 255 - r END AS r, CASE k WHEN 0 THEN g ELSE 255 - g END AS g, CASE k WHEN 0 THEN b ELSE 255 - b END AS b FROM {RGB}, range(2) s(k)), range(3) t(c)")
def p19_side_by_side(spark, sf_dir):
    """Each image beside its negative."""
    return _channels(pixels.over_images(_images(spark, sf_dir), lambda image, _: pixels.beside(image, 255 - image)))


LAB_SQL = f"""
WITH s AS (SELECT vec_id, y, x, r / 255 AS r, g / 255 AS g, b / 255 AS b FROM {RGB}),
l AS (SELECT vec_id, y, x, CASE WHEN r > 0.04045 THEN pow((r + 0.055) / 1.055, 2.4) ELSE r / 12.92 END AS r,
             CASE WHEN g > 0.04045 THEN pow((g + 0.055) / 1.055, 2.4) ELSE g / 12.92 END AS g,
             CASE WHEN b > 0.04045 THEN pow((b + 0.055) / 1.055, 2.4) ELSE b / 12.92 END AS b FROM s),
t AS (SELECT vec_id, y, x, (0.412453 * r + 0.357580 * g + 0.180423 * b) / 0.95047 AS tx, 0.212671 * r + 0.715160 * g + 0.072169 * b AS ty,
             (0.019334 * r + 0.119193 * g + 0.950227 * b) / 1.08883 AS tz FROM l),
f AS (SELECT vec_id, y, x, CASE WHEN tx > 0.008856 THEN cbrt(tx) ELSE 7.787 * tx + 16 / 116 END AS fx,
             CASE WHEN ty > 0.008856 THEN cbrt(ty) ELSE 7.787 * ty + 16 / 116 END AS fy,
             CASE WHEN tz > 0.008856 THEN cbrt(tz) ELSE 7.787 * tz + 16 / 116 END AS fz FROM t)
SELECT vec_id, y, x, round((116 * fy - 16) / 50 - 1, 6) + 0 AS light, round(500 * (fx - fy) / 110, 6) + 0 AS a, round(200 * (fy - fz) / 110, 6) + 0 AS b FROM f
"""


@query(LAB_SQL)
def p14_lab(spark, sf_dir):
    """Lightness and colour of every pixel, scaled as the colour mode's tensors are."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for vec_id, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                v = pixels.lab(np.frombuffer(data, np.uint8).reshape(8, 8, 3)).reshape(-1, 3)
                y, x = np.divmod(np.arange(64, dtype=np.int32), 8)
                columns = [np.full(64, vec_id), y.astype(np.int32), x.astype(np.int32), v[:, 0] / 50 - 1, v[:, 1] / 110, v[:, 2] / 110]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["vec_id", "y", "x", "light", "a", "b"])

    found = _images(spark, sf_dir).select("vec_id", "pixels").mapInArrow(run, "vec_id long, y int, x int, light double, a double, b double")
    return found.select("vec_id", "y", "x", *[(F.round(c, 6) + 0).alias(c) for c in ("light", "a", "b")])


# Losses -----------------------------------------------------------------------------------------------------------------

ELEMENTS = "(SELECT embedding[p + 1]::DOUBLE AS a, embedding[64 - p]::DOUBLE AS b FROM embeddings, range(64) t(p))"


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("a"), F.reverse("embedding").alias("b"))


@query(f"SELECT round(avg(abs(a - b)) * 10.0, 9) AS l1 FROM {ELEMENTS}")
def a7_l1(spark, sf_dir):
    return _vectors(spark, sf_dir).agg(F.round(losses.l1("a", "b", 10.0), 9).alias("l1"))


@query(f"SELECT round(avg((a - 1) * (a - 1)), 9) AS real, round(avg(b * b), 9) AS fake FROM {ELEMENTS}")
def a8_lsgan(spark, sf_dir):
    return _vectors(spark, sf_dir).agg(F.round(losses.gan_loss("lsgan", "a", True), 9).alias("real"), F.round(losses.gan_loss("lsgan", "b", False), 9).alias("fake"))


@query(f"SELECT round(avg(greatest(a, 0.0) - a + ln(1 + exp(-abs(a)))), 9) AS real, round(avg(greatest(b, 0.0) + ln(1 + exp(-abs(b)))), 9) AS fake FROM {ELEMENTS}")
def a9_bce(spark, sf_dir):
    return _vectors(spark, sf_dir).agg(F.round(losses.gan_loss("vanilla", "a", True), 9).alias("real"), F.round(losses.gan_loss("vanilla", "b", False), 9).alias("fake"))


@query(f"SELECT round(-avg(a), 9) + 0 AS real, round(avg(b), 9) + 0 AS fake FROM {ELEMENTS}")
def a10_wgan(spark, sf_dir):
    row = _vectors(spark, sf_dir).agg(F.round(losses.gan_loss("wgangp", "a", True), 9).alias("real"), F.round(losses.gan_loss("wgangp", "b", False), 9).alias("fake"))
    return row.select((F.col("real") + 0).alias("real"), (F.col("fake") + 0).alias("fake"))


@query("SELECT round(avg((norm - 1) * (norm - 1)) * 10.0, 9) AS penalty FROM (SELECT sqrt(list_sum(list_transform(embedding, lambda g: (g::DOUBLE + 1e-16) * (g::DOUBLE + 1e-16)))) AS norm FROM embeddings)")
def a11_gradient_penalty(spark, sf_dir):
    return _vectors(spark, sf_dir).agg(F.round(losses.gradient_penalty("a"), 9).alias("penalty"))


@query(
    f"""
WITH l AS (SELECT avg(abs(a - b)) AS l1, avg((a - 1) * (a - 1)) AS r, avg(b * b) AS f FROM {ELEMENTS})
SELECT round((r + f) * 0.5, 9) AS d, round(l1 * 10.0 * 0.5, 9) AS idt, round(r + l1 * 100.0 + l1 * 10.0 * 0.5, 9) AS g FROM l"""
)
def a12_a13_totals(spark, sf_dir):
    parts = _vectors(spark, sf_dir).agg(losses.l1("a", "b").alias("l1"), losses.lsgan("a", True).alias("r"), losses.lsgan("b", False).alias("f"))
    identity = losses.identity_loss(F.col("l1"), 10.0, 0.5)
    return parts.select(
        F.round(losses.discriminator_loss(F.col("r"), F.col("f")), 9).alias("d"),
        F.round(identity, 9).alias("idt"),
        F.round(losses.generator_loss(F.col("r"), F.col("l1") * 100.0, identity), 9).alias("g"),
    )


@query("SELECT event_type, round(avg(value), 9) AS mean, min(value) AS min, max(value) AS max, median(value) AS median, round(stddev_pop(value), 9) AS std FROM events GROUP BY 1")
def a14_stats(spark, sf_dir):
    rows = losses.array_stats(table(spark, sf_dir, "events"), "value", "event_type")
    return rows.withColumns({c: F.round(c, 9) for c in ("mean", "std")})


@query("SELECT round(avg(m), 9) AS mean_gradient FROM (SELECT list_avg(list_transform(embedding, lambda g: abs(g::DOUBLE))) AS m FROM embeddings)")
def a15_mean_gradient(spark, sf_dir):
    return losses.mean_gradient(table(spark, sf_dir, "embeddings"), "embedding").select(F.round("mean_gradient", 9).alias("mean_gradient"))


@query("SELECT p_brand, printf('%.3f', sum(p_size * 1013) / 1e6) AS millions FROM part GROUP BY 1")
def a16_parameters(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select("p_brand", (F.col("p_size") * 1013).alias("numel"))
    return losses.parameter_millions(rows, "numel", "p_brand")


# Scalars, schedules, logs -------------------------------------------------------------------------------------------


@query("SELECT url, url LIKE '%.png' OR url LIKE '%.jpg' OR url LIKE '%.jpeg' OR url LIKE '%.PNG' AS image FROM (SELECT url || CASE page_id % 5 WHEN 0 THEN '.png' WHEN 1 THEN '.Jpg' WHEN 2 THEN '.jpeg' WHEN 3 THEN '.PNG' ELSE '.txt' END AS url FROM pages)")
def s2_extension(spark, sf_dir):
    kinds = F.element_at(F.array(*[F.lit(x) for x in (".png", ".Jpg", ".jpeg", ".PNG", ".txt")]), (F.col("page_id") % 5 + 1).cast("int"))
    return table(spark, sf_dir, "pages").select(F.concat("url", kinds).alias("url")).select("url", S.is_image(F.col("url")).alias("image"))


@query(
    """
WITH f AS (SELECT replace(n_name, '_', '-') || '_' || printf('%06d', n_regionkey) || '_' || printf('%06d', n_nationkey + 30) AS frame, replace(n_name, '_', '-') AS city, n_regionkey, n_nationkey + 30 AS num FROM nation)
SELECT frame, s::INT AS step, '/d/leftImg8bit_sequence/val/' || city || '/' || city || '_' || printf('%06d', n_regionkey) || '_' || printf('%06d', num - 3 + s) || '_leftImg8bit.png' AS path
FROM f, range(4) t(s)"""
)
def s11_frame_sequence(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    frames = n.select(F.concat_ws("_", F.replace("n_name", F.lit("_"), F.lit("-")), S.padded(F.col("n_regionkey"), 6), S.padded(F.col("n_nationkey") + 30, 6)).alias("frame"))
    return listing.frame_sequence(frames, "/d", 3)


@query("SELECT n_name, '/d/leftImg8bit_sequence/val/' || n_name || '/' || n_nationkey || '_leftImg8bit.png' AS path FROM nation")
def s10_frame_path(spark, sf_dir):
    return table(spark, sf_dir, "nation").select("n_name", listing.frame_path("/d", "val", F.col("n_name"), F.col("n_nationkey").cast("string")).alias("path"))


@query(
    """
SELECT printf('%04d', vec_id) AS name, v.label, printf('%04d_%s.png', vec_id, v.label) AS file
FROM embeddings, (VALUES ('real_A'), ('fake_B')) v(label)"""
)
def s15_visual_names(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").select(F.concat(F.lit("test/"), S.padded(F.col("vec_id"), 4), F.lit(".jpg")).alias("path"))
    return sinks.visual_names(rows, ["real_A", "fake_B"])


@query(
    """
WITH c AS (SELECT n_name AS name, k, '<td halign="center" style="word-wrap: break-word;" valign="top"><p><a href="images/' || n_name || '_' || label || '.png"><img src="images/' || n_name || '_' || label || '.png" style="width:256px"></a><br><p>' || label || '</p></p></td>' AS cell
           FROM nation, (VALUES (0, 'real_A'), (1, 'fake_B')) v(k, label))
SELECT name, '<h3>' || name || '</h3><table border="1" style="table-layout: fixed;"><tr>' || string_agg(cell, '' ORDER BY k) || '</tr></table>' AS html FROM c GROUP BY name"""
)
def s16_report_rows(spark, sf_dir):
    names = table(spark, sf_dir, "nation").select(F.col("n_name").alias("name"), F.posexplode(F.array(F.lit("real_A"), F.lit("fake_B"))).alias("k", "label"))
    return sinks.report_rows(names.withColumn("file", F.format_string("%s_%s.png", "name", "label")))


@query("SELECT page_id, regexp_extract(url, '[^/]*$') AS base, regexp_replace(regexp_extract(url, '[^/]*$'), '(.)\\.[^.]*$', '\\1') AS stem, 'results/' || page_id || '/images' AS folder FROM pages")
def f3_path_parts(spark, sf_dir):
    folder = S.joined_path(F.lit("results"), F.col("page_id").cast("string"), F.lit("images"))
    return table(spark, sf_dir, "pages").select("page_id", S.base_name(F.col("url")).alias("base"), S.stem(F.col("url")).alias("stem"), folder.alias("folder"))


@query("SELECT p_partkey, printf('%04d', p_partkey) AS four, printf('epoch%03d', p_size) AS epoch, printf('%06d', p_size) AS six FROM part")
def f4_formats(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", S.padded(F.col("p_partkey"), 4).alias("four"), F.format_string("epoch%03d", "p_size").alias("epoch"), S.padded(F.col("p_size"), 6).alias("six"))


LOG_SQL = """(SELECT event_id, (event_id % 2)::INT AS rank, (event_id // 100 + 1)::INT AS epoch, event_id % 100 * 16 AS iters,
  (event_id % 1000) / 1000 AS t_comp, (event_id % 7) / 1000 AS t_data, (event_id % 5000) / 1000 AS g, (event_id % 300) / 100 AS d FROM events)"""


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loss records; values have at most three decimals, so that no rounding rule matters."""
    i = F.col("event_id")
    pair = lambda name, v: F.struct(F.lit(name).alias("name"), v.alias("value"))
    return table(spark, sf_dir, "events").select(
        "event_id", (i % 2).cast("int").alias("rank"), (F.floor(i / 100) + 1).cast("int").alias("epoch"), (i % 100 * 16).alias("iters"),
        ((i % 1000) / 1000).alias("t_comp"), ((i % 7) / 1000).alias("t_data"),
        F.array(pair("G_GAN", (i % 5000) / 1000), pair("D_real", (i % 300) / 100)).alias("losses"),
    )


LINE_SQL = "printf('[Rank %d] (epoch: %d, iters: %d, time: %.3f, data: %.3f) , G_GAN: %.3f, D_real: %.3f', rank, epoch, iters, t_comp, t_data, g, d)"


@query(f"SELECT event_id, {LINE_SQL} AS line FROM {LOG_SQL}")
def f6_log_render(spark, sf_dir):
    line = S.loss_line(F.col("rank"), F.col("epoch"), F.col("iters"), F.col("t_comp"), F.col("t_data"), F.col("losses"))
    return _records(spark, sf_dir).select("event_id", line.alias("line"))


@query(f"SELECT event_id, rank, epoch, iters, t_comp, t_data, g AS g_gan, d AS d_real FROM {LOG_SQL}")
def f6_log_roundtrip(spark, sf_dir):
    x = f6_log_render(spark, sf_dir).select("event_id", S.parsed_line(F.col("line")).alias("x"))
    value = lambda k: F.get("x.losses", F.lit(k))["value"]
    return x.select("event_id", "x.rank", "x.epoch", "x.iters", "x.t_comp", "x.t_data", value(0).alias("g_gan"), value(1).alias("d_real"))


@query(f"SELECT unnest([{LINE_SQL}, '']) AS value FROM {LOG_SQL} WHERE rank = 0")
def s17_log_lines(spark, sf_dir):
    return sinks.log_lines(_records(spark, sf_dir))


@query("SELECT vec_id, label, CASE label WHEN 0 THEN 255 WHEN 1 THEN 3 WHEN 2 THEN 3 WHEN 9 THEN 0 ELSE label END::INT AS train_id FROM embeddings")
def f7_relabel(spark, sf_dir):
    """1 becomes 2 and then 3; 0 becomes -1, which a byte holds as 255."""
    return table(spark, sf_dir, "embeddings").select("vec_id", "label", S.relabelled(F.col("label"), {0: -1, 1: 2, 2: 3, 9: 0}).alias("train_id"))


@query("""SELECT page_id, array_to_string(list_filter(regexp_extract_all(html, '<a\\b[^>]*?\\bhref\\s*=\\s*["'']([^"'']*)["'']', 1), lambda x: x LIKE '%ing' OR x LIKE '%.'), ' ') AS links FROM pages""")
def f9_archive_links(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.array_join(S.archive_links(F.col("html"), ("ing", ".")), " ").alias("links"))


@query("SELECT i::INT AS epoch, round(0.0002 * (1.0 - greatest(0, i + 1 - 100) / 101.0), 12) AS lr FROM range(200) t(i)")
def f10_linear_rate(spark, sf_dir):
    return learning_rates(spark, "linear", 200).withColumn("lr", F.round("lr", 12))


@query("SELECT i::INT AS epoch, round(0.0002 * pow(0.1, i // 50), 12) AS lr FROM range(200) t(i)")
def f11_step_rate(spark, sf_dir):
    return learning_rates(spark, "step", 200).withColumn("lr", F.round("lr", 12))


@query(f"SELECT i::INT AS epoch, round(0.0002 * (1 + cos({math.pi} * i / 100)) / 2, 12) AS lr FROM range(200) t(i)")
def f12_cosine_rate(spark, sf_dir):
    return learning_rates(spark, "cosine", 200).withColumn("lr", F.round("lr", 12))


@query("SELECT i::INT AS epoch, round(0.0002 * pow(0.2, CASE WHEN i = 0 THEN 0 ELSE (i - 1) // 6 END), 15) AS lr FROM range(40) t(i)")
def f13_plateau_rate(spark, sf_dir):
    return learning_rates(spark, "plateau", 40).withColumn("lr", F.round("lr", 15))


@query("SELECT p_partkey, CASE WHEN p_size > 25 THEN 'iter_' || p_size ELSE 'latest' END || '_net_G.pth' AS file FROM part")
def e7_checkpoint_names(spark, sf_dir):
    """Names by the naming rule, over a table of saved steps."""
    rows = table(spark, sf_dir, "part")
    names = F.create_map(*[x for k in range(1, 51) for x in (F.lit(k), F.lit(checkpoint_name("latest", "G", k if k > 25 else 0)))])
    return rows.select("p_partkey", F.element_at(names, F.col("p_size")).alias("file"))


# Replay ---------------------------------------------------------------------------------------------------------------

POOL_SQL = """
WITH i AS (SELECT row_number() OVER (ORDER BY event_id) - 1 AS seq, event_id AS item FROM events),
d AS (SELECT *, ((seq * 48271 + 11) % 1000) / 1000 AS p, (seq * 16807 + 5) % 50 AS slot FROM i),
w AS (SELECT seq, CASE WHEN seq < 50 THEN item ELSE lag(item) OVER (PARTITION BY CASE WHEN seq < 50 THEN seq ELSE slot END ORDER BY seq) END AS returned FROM d WHERE seq < 50 OR p > 0.5)
SELECT d.seq, d.item, coalesce(w.returned, d.item) AS returned FROM d LEFT JOIN w USING (seq)
"""


@query(POOL_SQL)
def m1_replay_pool(spark, sf_dir):
    items = dense_index(table(spark, sf_dir, "events").select("event_id"), "event_id", "seq").withColumnRenamed("event_id", "item")
    drawn = items.withColumn("p", ((F.col("seq") * 48271 + 11) % 1000) / 1000).withColumn("slot", (F.col("seq") * 16807 + 5) % 50)
    return replay.replay(drawn, 50).select("seq", "item", "returned")


@query(
    """
WITH n AS (SELECT (count(*) + 15) // 16 AS per FROM documents),
s AS (SELECT (i // per + 1)::INT AS epoch, (i % per + 1) * 16 AS epoch_iter, (i + 1) * 16 AS total_iters FROM n, range((SELECT 3 * per FROM n)) t(i))
SELECT *, row_number() OVER (PARTITION BY epoch ORDER BY total_iters) > 1 AS saved FROM s"""
)
def m2_epoch_reset(spark, sf_dir):
    return replay.first_in_epoch(epochs.counters(spark, 3, table(spark, sf_dir, "documents").count(), 16))


def queries() -> dict[str, Query]:
    from . import query_folders  # noqa: F401  (registers its queries)

    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    return {name: _sql[name] for name in queries() if name in _sql}
