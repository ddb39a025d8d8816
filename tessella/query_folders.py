"""Queries over image folders, pixel steps and configurations, and the same in DuckDB SQL.

The tables hold no files, so the folder queries write one small image for each nation first, into the shared folder that
``spark.checkpoint.dir`` names, and delete it when the process ends. Pixels are integer arithmetic on keys, so SQL can tell
what must be read back.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid
from datetime import datetime

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import pixels
from .functions import scalars as S
from .functions.schedules import learning_rates
from .operators.epochs import batched, epoch_order, sharded
from .plans import lifecycle, registry
from .plans import datasets as _modes  # noqa: F401  (registers the built-in modes)
from .plans.config import COMMON, TEST, TRAIN, Config, from_arguments, options_file, options_text, resolve, results_folder, test_run
from .plans.transforms import step_rows
from .queries import GRID, RGB, _channels, _images, query, table
from .sources import images, listing, sinks

ROW = "name string, width int, height int, n_channels int, pixels binary"


# Folders --------------------------------------------------------------------------------------------------------------


def _folder(spark: SparkSession) -> str:
    """A new folder that is deleted in the end; in local mode (tests), a temporary one does where no shared one is configured."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not shared and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    path = f"{(shared or tempfile.gettempdir()).rstrip('/')}/tessella/{uuid.uuid4().hex}"
    atexit.register(_delete, spark, path)
    return path


def _delete(spark: SparkSession, path: str) -> None:
    try:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(where, True)
    except Exception:  # the session is gone: the folder's owner cleans up
        return


def _pictures(spark: SparkSession, sf_dir: str, name: str, salt: int = 0) -> DataFrame:
    """One 4 x 3 image for each nation, named by an expression; the pixel at (y, x), channel c is a function of the key."""
    rows = table(spark, sf_dir, "nation").withColumn("name", F.expr(name)).withColumn("ks", F.sequence(F.lit(0), F.lit(35)))
    text = F.array_join(F.transform("ks", lambda k: F.lpad(F.hex((F.col("n_nationkey") * 7 + k * 5 + salt) % 256), 2, "0")), "")
    sizes = [F.lit(n).alias(c) for c, n in (("width", 4), ("height", 3), ("n_channels", 3))]
    return rows.select("name", *sizes, F.unhex(text).alias("pixels"))


def _written(spark: SparkSession, sf_dir: str, name: str, salt: int = 0, folder: str | None = None) -> str:
    """The folder with the images as PNG files."""
    folder = folder or _folder(spark)
    pictures = _pictures(spark, sf_dir, name, salt)
    parts = pictures.select("name").distinct().collect()  # one name for each nation
    for sub in sorted({r.name.rpartition("/")[0] for r in parts}):
        here = pictures.filter(F.regexp_extract("name", "^(.*)/", 1) == sub).withColumn("name", S.base_name(F.col("name")))
        sinks.write_files(sinks.encoded(here), f"{folder}/{sub}".rstrip("/"))
    return folder


def _below(folder: str):
    return F.substring_index("path", f"{folder.rsplit('/', 1)[1]}/", -1)


def _values(rows: DataFrame, *keys: str) -> DataFrame:
    """(keys, y, x, c, v) of image rows."""
    digits = F.regexp_extract_all(F.hex("pixels"), F.lit("(..)"), F.lit(1))
    at = F.floor(F.col("k") / F.col("n_channels"))
    return rows.select(*keys, "width", "n_channels", F.posexplode(digits).alias("k", "digit")).select(
        *keys, F.floor(at / F.col("width")).cast("int").alias("y"), (at % F.col("width")).cast("int").alias("x"),
        (F.col("k") % F.col("n_channels")).cast("int").alias("c"), F.conv("digit", 16, 10).cast("int").alias("v"),
    )


PICTURE = "(SELECT n_nationkey, n_name, n_regionkey, (i // 12)::INT AS y, (i // 3 % 4)::INT AS x, (i % 3)::INT AS c, ((n_nationkey * 7 + i * 5 + {salt}) % 256)::INT AS v FROM nation, range(36) t(i))"
NAMED = "'r' || n_regionkey || CASE WHEN n_nationkey % 2 = 0 THEN '-x/' ELSE '/x/' END || n_nationkey || CASE n_nationkey % 3 WHEN 0 THEN '.png' WHEN 1 THEN '.PNG' ELSE '.Png' END"


@query(f"SELECT row_number() OVER (ORDER BY p) - 1 AS idx, p AS path FROM (SELECT {NAMED} AS p FROM nation) WHERE p NOT LIKE '%.Png'")
def s1_scan(spark, sf_dir):
    """All depths, known extensions, ranked as strings."""
    folder = _written(spark, sf_dir, NAMED)
    return listing.list_images(spark, folder).select("idx", _below(folder).alias("path"))


@query(f"SELECT row_number() OVER (ORDER BY p) - 1 AS idx, p AS path FROM (SELECT p FROM (SELECT {NAMED} AS p FROM nation) WHERE p NOT LIKE '%.Png' ORDER BY string_split(p, '/') LIMIT 7)")
def s1_truncated_scan(spark, sf_dir):
    """Cut in component order, then ranked as strings."""
    folder = _written(spark, sf_dir, NAMED)
    return listing.list_images(spark, folder, 7).select("idx", _below(folder).alias("path"))


@query(f"SELECT n_nationkey::VARCHAR || '.png' AS path, y, x, c, v FROM {PICTURE.format(salt=0)}")
def s3_decode(spark, sf_dir):
    """What the PNG sink writes is read back as RGB."""
    folder = _written(spark, sf_dir, "n_nationkey || '.png'")
    return _values(images.read_images(spark, folder).withColumn("path", _below(folder)), "path")


@query("SELECT n_nationkey::VARCHAR || '.png' AS path, 4 AS width, 3 AS height, (SELECT count(*) FROM nation) AS n FROM nation")
def s4_u5_image_folder(spark, sf_dir):
    """The generic folder with a loader of the caller's."""
    folder = _written(spark, sf_dir, "n_nationkey || '.png'")
    found = listing.image_folder(spark, folder, images.read_images)
    return found.select(_below(folder).alias("path"), "width", "height", F.lit(found.count()).alias("n"))


@query("SELECT row_number() OVER (ORDER BY p) - 1 AS idx, p AS path FROM (SELECT n_nationkey::VARCHAR || '.png' AS p FROM nation WHERE n_nationkey % 3 = 0)")
def s5_flat_listing(spark, sf_dir):
    """Lower-case .png and .jpg directly in the folder."""
    folder = _written(spark, sf_dir, "CASE n_nationkey % 3 WHEN 0 THEN n_nationkey || '.png' WHEN 1 THEN n_nationkey || '.PNG' ELSE 'deep/' || n_nationkey || '.png' END")
    return listing.list_flat(spark, folder).select("idx", _below(folder).alias("path"))


FRAMES = "'gtFine/val/c' || n_regionkey || '/c' || n_regionkey || '_' || lpad({key}, 6, '0') || '_000019_gtFine_' || CASE WHEN n_nationkey % 4 = 3 THEN 'color' ELSE 'labelIds' END || '.png'"
FRAME_NAMES, FRAME_SQL = FRAMES.format(key="n_nationkey"), FRAMES.format(key="n_nationkey::VARCHAR")


@query(f"SELECT row_number() OVER (ORDER BY p) - 1 AS idx, p AS path FROM (SELECT {FRAME_SQL} AS p FROM nation) WHERE p LIKE '%\\_color.png' ESCAPE '\\'")
def s6_two_levels(spark, sf_dir):
    folder = _written(spark, sf_dir, FRAME_NAMES)
    return listing.list_two_levels(spark, f"{folder}/gtFine", "val", "_color.png").select("idx", _below(folder).alias("path"))


@query("SELECT row_number() OVER (ORDER BY city, frame) - 1 AS idx, city, frame FROM (SELECT 'c' || n_regionkey AS city, 'c' || n_regionkey || '_' || lpad(n_nationkey::VARCHAR, 6, '0') || '_000019' AS frame FROM nation WHERE n_nationkey % 4 <> 3)")
def s7_label_frames(spark, sf_dir):
    return listing.label_frames(spark, _written(spark, sf_dir, FRAME_NAMES), "val")


@query("SELECT 'c' || n_regionkey AS city, n_name AS id FROM nation")
def s8_split_list(spark, sf_dir):
    """Any split but train reads the validation list."""
    folder = _folder(spark)
    lines = table(spark, sf_dir, "nation").selectExpr("concat('c', n_regionkey, '/', n_name) AS value")
    lines.coalesce(1).write.text(f"{folder}/ImageSets/segFine/val.txt")
    return listing.split_list(spark, folder, "test")


@query(f"SELECT n_nationkey::VARCHAR || '.png' AS path, y, x, CASE WHEN v % 4 = 1 THEN 255 ELSE v END::INT AS label FROM {PICTURE.format(salt=0)} WHERE c = 0")
def s9_labels(spark, sf_dir):
    """Label images are relabelled as bytes: -1 becomes 255."""
    folder = _written(spark, sf_dir, "n_nationkey || '.png'")
    return images.labels(images.read_images(spark, folder), {k: -1 for k in range(1, 256, 4)}).withColumn("path", _below(folder))


@query(f"SELECT n_nationkey::VARCHAR || '.png' AS path, y, x, c, v FROM {PICTURE.format(salt=0)} UNION ALL SELECT n_nationkey::VARCHAR || '.png', y, x + 4, c, v FROM {PICTURE.format(salt=90)}")
def s20_b6_pairs(spark, sf_dir):
    """Two folders side by side, written by tasks; errors would surface."""
    folder = _folder(spark)
    sides = [_pictures(spark, sf_dir, "n_nationkey || '.png'", salt) for salt in (0, 90)]
    lifecycle.write_pairs(*sides, folder)
    return _values(images.read_images(spark, folder).withColumn("path", _below(folder)), "path")


@query("SELECT n_nationkey::VARCHAR || '.png' AS path, 8 AS width, 3 AS height FROM nation")
def s14_wide_sink(spark, sf_dir):
    """A ratio of 2 stores images twice as wide."""
    folder = _folder(spark)
    sinks.write_files(sinks.encoded(_pictures(spark, sf_dir, "n_nationkey || '.png'"), ratio=2.0), folder)
    return images.read_images(spark, folder).select(_below(folder).alias("path"), "width", "height")


SAMPLE_SQL = """SELECT idx, side, y, x, c, round((v / 255.0 - 0.5) / 0.5, 4) AS v FROM (
  SELECT (row_number() OVER (PARTITION BY y, x, c ORDER BY n_nationkey::VARCHAR || '.png') - 1) AS idx, CASE WHEN x < 2 THEN 'b' ELSE 'a' END AS side, y, x % 2 AS x, c, v FROM {pictures}) WHERE {where}"""


def _tensors(samples: DataFrame, *sides: str) -> DataFrame:
    one = lambda s: samples.select("idx", F.lit(s).alias("side"), f"{s}.width", f"{s}.height", F.posexplode(f"{s}.tensor").alias("k", "f"))
    rows = one(sides[0]) if len(sides) == 1 else one(sides[0]).unionByName(one(sides[1]))
    area = F.col("width") * F.col("height")
    return rows.select(
        "idx", "side", F.floor(F.col("k") % area / F.col("width")).cast("int").alias("y"), (F.col("k") % F.col("width")).cast("int").alias("x"),
        F.floor(F.col("k") / area).cast("int").alias("c"), F.round(F.col("f").cast("double"), 4).alias("v"),
    )


@query(SAMPLE_SQL.format(pictures=PICTURE.format(salt=0), where="true"))
def u1_aligned_mode(spark, sf_dir):
    """The paired mode from the registry, from right to left: tensors of both halves."""
    folder = _folder(spark)
    _written(spark, sf_dir, "n_nationkey || '.png'", folder=f"{folder}/train")
    config = resolve({"dataroot": folder, "model": "paired", "preprocess": "none_", "no_flip": True, "direction": "BtoA"})
    return _tensors(registry.dataset("aligned")(spark, config), "a", "b")


@query("SELECT idx, 'a' AS side, y, x, 0 AS c, round((((r * 19595 + g * 38470 + b * 7471 + 32768) >> 16) / 255.0 - 0.5) / 0.5, 4) AS v FROM (SELECT (row_number() OVER (PARTITION BY y, x ORDER BY n_nationkey::VARCHAR || '.png') - 1) AS idx, y, x, max(v) FILTER (c = 0) AS r, max(v) FILTER (c = 1) AS g, max(v) FILTER (c = 2) AS b FROM " + PICTURE.format(salt=0) + " GROUP BY n_nationkey, y, x) WHERE idx < 5")
def w5_u2_test_samples(spark, sf_dir):
    """A test run's first samples, gray because the direction makes the output's one channel the input's."""
    folder = _written(spark, sf_dir, "n_nationkey || '.png'")
    given = {"dataroot": folder, "preprocess": "none_", "direction": "BtoA", "output_nc": 1, "num_test": 5}
    return _tensors(lifecycle.test_samples(spark, resolve(given, is_train=False)), "a")


# Pixels ---------------------------------------------------------------------------------------------------------------


def _maps(spark: SparkSession, sf_dir: str, function) -> DataFrame:
    """(vec_id, c, y, x, v) of what a function makes of each image (HWC bytes): an array HW or CHW."""

    def run(batches):
        for b in batches:
            for vec_id, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                out = np.asarray(function(np.frombuffer(data, np.uint8).reshape(8, 8, 3)), float)
                c, y, x = np.indices(out.shape if out.ndim == 3 else (1, *out.shape), np.int32).reshape(3, -1)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(out.size, vec_id)), pa.array(c), pa.array(y), pa.array(x), pa.array(out.ravel())], ["vec_id", "c", "y", "x", "v"])

    return _images(spark, sf_dir).select("vec_id", "pixels").mapInArrow(run, "vec_id long, c int, y int, x int, v double")


def resize_sql(width: int, height: int) -> str:
    """Bicubic resampling of the 8 x 8 images by its formula: columns first, then rows, each rounded to bytes."""

    def axis(to: int) -> str:
        wide, scale = max(8 / to, 1.0), 8 / to
        return f"""(SELECT k, i, w / sum(w) OVER (PARTITION BY k) AS w FROM (
  SELECT k, i, CASE WHEN d < 1 THEN (1.5 * d - 2.5) * d * d + 1 WHEN d < 2 THEN (((d - 5) * d + 8) * d - 4) * -0.5 ELSE 0 END AS w
  FROM (SELECT k, i, abs((i - (k + 0.5) * {scale!r}::DOUBLE + 0.5) / {wide!r}::DOUBLE) AS d FROM range({to}) a(k), range(8) b(i)
        WHERE i >= greatest(0, trunc((k + 0.5) * {scale!r}::DOUBLE - {2 * wide!r}::DOUBLE + 0.5)) AND i < least(8, trunc((k + 0.5) * {scale!r}::DOUBLE + {2 * wide!r}::DOUBLE + 0.5)))))"""

    return f"""
WITH p AS (SELECT vec_id, y, x, c, CASE c WHEN 0 THEN r WHEN 1 THEN g ELSE b END::DOUBLE AS v FROM {RGB}, range(3) t(c)),
h AS (SELECT vec_id, y, k AS x, c, greatest(0, least(255, floor(sum(v * w) + 0.5))) AS v FROM p JOIN {axis(width)} ON i = x GROUP BY ALL),
o AS (SELECT vec_id, k AS y, x, c, greatest(0, least(255, floor(sum(v * w) + 0.5))) AS v FROM h JOIN {axis(height)} ON i = y GROUP BY ALL)
SELECT vec_id, y::INT AS y, x::INT AS x, c::INT AS c, v::INT AS v FROM o"""


@query(resize_sql(5, 3))
def p5_resize(spark, sf_dir):
    return _channels(pixels.over_images(_images(spark, sf_dir), lambda image, _: pixels.resized(image, 5, 3)))


@query(resize_sql(16, 16))
def p20_fixed_size(spark, sf_dir):
    return _channels(pixels.over_images(_images(spark, sf_dir), lambda image, _: pixels.resized(image, 16, 16)))


@query(f"SELECT vec_id, y - 2 AS y, x - 1 AS x, c::INT AS c, CASE c WHEN 0 THEN r WHEN 1 THEN g ELSE b END::INT AS v FROM {RGB}, range(3) t(c) WHERE x BETWEEN 1 AND 6 AND y BETWEEN 2 AND 7")
def p9_strict_crop(spark, sf_dir):
    return _channels(pixels.over_images(_images(spark, sf_dir), lambda image, _: pixels.cut_strictly(image, 1, 2, 6)))


@query("SELECT * FROM (VALUES ('bicubic', 2.0::DOUBLE), ('bilinear', 1.0::DOUBLE), ('lanczos', 3.0::DOUBLE)) t(method, half_width)")
def p12_methods(spark, sf_dir):
    """Interpolation methods with a kernel, and how far it reaches."""
    return spark.createDataFrame([(k, float(w)) for k, (_, w) in pixels.KERNELS.items()], "method string, half_width double")


@query(f"SELECT vec_id, c::INT AS c, y, x, CASE c WHEN 0 THEN r WHEN 1 THEN g ELSE b END::DOUBLE AS v FROM {RGB}, range(3) t(c)")
def p15_lab_inverse(spark, sf_dir):
    """From colour tensors back to the image they came from."""
    found = _maps(spark, sf_dir, lambda image: pixels.from_lab_pair(*pixels.lab_pair(image)).transpose(2, 0, 1))
    return found.withColumn("v", F.round("v", 0) + 0)


@query(
    f"""
WITH e AS (SELECT vec_id, c::INT AS c, yy::INT AS y, xx::INT AS x, CASE WHEN yy < 2 THEN 2 - yy WHEN yy > 9 THEN 16 - yy ELSE yy - 2 END AS sy, CASE WHEN xx < 2 THEN 2 - xx WHEN xx > 9 THEN 16 - xx ELSE xx - 2 END AS sx
           FROM (SELECT DISTINCT vec_id FROM embeddings), range(3) t(c), range(12) a(yy), range(12) b(xx))
SELECT e.vec_id, e.c, e.y, e.x, round(CASE c WHEN 0 THEN b - 104.00698793 WHEN 1 THEN g - 116.66876762 ELSE r - 122.67891434 END, 3) AS v
FROM e JOIN {RGB} i ON i.vec_id = e.vec_id AND i.y = sy AND i.x = sx"""
)
def p17_edge_input(spark, sf_dir):
    return _maps(spark, sf_dir, lambda image: pixels.edge_input(image, 2)).withColumn("v", F.round("v", 3))


@query(f"SELECT vec_id, 0 AS c, y - 4 AS y, x - 4 AS x, r::DOUBLE AS v FROM {RGB} WHERE y BETWEEN 4 AND 5 AND x BETWEEN 4 AND 5")
def p18_without_border(spark, sf_dir):
    return _maps(spark, sf_dir, lambda image: pixels.without_border(image[..., 0], 3, 1))


@query(
    f"""
WITH m AS (SELECT vec_id, y, x, r % 3 > 0 AND r % 3 <> 2 AS m FROM {RGB}),
n AS (SELECT a.vec_id, a.y, a.x, bool_or(b.m) AS grown, bool_and(b.m) AS shrunk FROM m a JOIN m b ON a.vec_id = b.vec_id AND abs(a.y - b.y) + abs(a.x - b.x) <= 1 GROUP BY ALL)
SELECT vec_id, 0 AS c, y, x, (grown <> shrunk)::INT::DOUBLE AS v FROM n"""
)
def p23_boundaries(spark, sf_dir):
    """Labels 0, 1 and, as void, 2."""
    return _maps(spark, sf_dir, lambda image: pixels.boundaries(image[..., 0] % 3, 1, void=2).astype(float))


@query(f"SELECT vec_id, 0 AS c, y, x, (1 - v / 255.0::DOUBLE >= 0.4)::INT::DOUBLE AS v FROM {GRID}")
def p25_binary_edges(spark, sf_dir):
    return _maps(spark, sf_dir, lambda image: pixels.binary_edges(image[..., 0] / 255, 0.4).astype(float))


@query(
    """SELECT * FROM (VALUES ('resize_and_crop', 0, 'resize'), ('resize_and_crop', 1, 'crop'), ('resize_and_crop', 2, 'flip'), ('resize_and_crop', 3, 'tensor'), ('resize_and_crop', 4, 'normalise'),
  ('scale_width_and_crop', 0, 'scale_width'), ('scale_width_and_crop', 1, 'crop'), ('scale_width_and_crop', 2, 'tensor'), ('scale_width_and_crop', 3, 'normalise'),
  ('none, gray', 0, 'gray'), ('none, gray', 1, 'four'), ('none, gray', 2, 'flip'), ('none, gray', 3, 'tensor'), ('none, gray', 4, 'normalise'),
  ('unpaired crop', 0, 'crop_strictly'), ('unpaired crop', 1, 'flip'), ('unpaired crop', 2, 'tensor'), ('unpaired crop', 3, 'normalise')) t(name, position, step)"""
)
def p2_pipelines(spark, sf_dir):
    cases = {
        "resize_and_crop": ("resize_and_crop", 286, 256),
        "scale_width_and_crop": ("scale_width_and_crop", 286, 256, False),
        "none, gray": ("none", 286, 256, True, True),
        "unpaired crop": ("crop", 286, 256, True, False, False),
    }
    return step_rows(spark, cases)


# Configuration ----------------------------------------------------------------------------------------------------------


def _options(spark: SparkSession, cases: dict[str, Config], names: tuple[str, ...]) -> DataFrame:
    rows = [(case, name, str(config.values[name])) for case, config in cases.items() for name in names if name in config.values]
    return spark.createDataFrame(rows, "run string, option string, value string")


def rows_sql(columns: str, *rows: tuple) -> str:
    """A table of fixed rows."""
    texts = (", ".join("NULL" if v is None else "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v) for v in r) for r in rows)
    return f"SELECT * FROM (VALUES {', '.join(f'({t})' for t in texts)}) t({columns})"


def _defaults(spark: SparkSession, options: dict) -> DataFrame:
    return spark.createDataFrame([(k, None if v is None else str(v)) for k, v in options.items()], "option string, value string")


#: Options of every run and their defaults (fixed values; model names and the tracker's project have names of their own here).
COMMON_ROWS = (
    ("dataroot", None), ("name", "experiment_name"), ("checkpoints_dir", "./checkpoints"), ("model", "unpaired"), ("input_nc", "3"), ("output_nc", "3"),
    ("ngf", "64"), ("ndf", "64"), ("netD", "basic"), ("netG", "resnet_9blocks"), ("n_layers_D", "3"), ("norm", "instance"), ("init_type", "normal"),
    ("init_gain", "0.02"), ("no_dropout", "False"), ("dataset_mode", "unaligned"), ("direction", "AtoB"), ("serial_batches", "False"), ("num_threads", "4"),
    ("batch_size", "1"), ("load_size", "286"), ("crop_size", "256"), ("max_dataset_size", "inf"), ("preprocess", "resize_and_crop"), ("no_flip", "False"),
    ("display_winsize", "256"), ("epoch", "latest"), ("load_iter", "0"), ("verbose", "False"), ("suffix", ""), ("use_wandb", "False"),
    ("wandb_project_name", "image-translation"),
)
#: Options of training runs, and of test runs (marked), and their defaults (fixed values).
PHASE_ROWS = (
    ("train", "display_freq", "400"), ("train", "update_html_freq", "1000"), ("train", "print_freq", "100"), ("train", "no_html", "False"),
    ("train", "save_latest_freq", "5000"), ("train", "save_epoch_freq", "5"), ("train", "save_by_iter", "False"), ("train", "continue_train", "False"),
    ("train", "epoch_count", "1"), ("train", "phase", "train"), ("train", "n_epochs", "100"), ("train", "n_epochs_decay", "100"), ("train", "beta1", "0.5"),
    ("train", "lr", "0.0002"), ("train", "gan_mode", "lsgan"), ("train", "pool_size", "50"), ("train", "lr_policy", "linear"), ("train", "lr_decay_iters", "50"),
    ("test", "results_dir", "./results/"), ("test", "aspect_ratio", "1.0"), ("test", "phase", "test"), ("test", "eval", "False"), ("test", "num_test", "50"),
)


@query(rows_sql("option, value", *COMMON_ROWS))
def e1_common_options(spark, sf_dir):
    return _defaults(spark, COMMON)


@query(rows_sql("phase, option, value", *PHASE_ROWS))
def e2_phase_options(spark, sf_dir):
    rows = [(phase, k, str(v)) for phase, options in (("train", TRAIN), ("test", TEST)) for k, v in options.items()]
    return spark.createDataFrame(rows, "phase string, option string, value string")


LAYERED = ("model", "dataset_mode", "norm", "netG", "no_dropout", "pool_size", "gan_mode", "lambda_L1", "lambda_A", "lambda_identity", "input_nc", "output_nc", "max_dataset_size", "load_size", "phase")


@query(
    rows_sql(
        "run, option, value",
        *(("given norm", k, v) for k, v in (("model", "paired"), ("dataset_mode", "unaligned"), ("norm", "instance"), ("netG", "unet_256"), ("no_dropout", "False"), ("pool_size", "0"), ("gan_mode", "vanilla"), ("lambda_L1", "100.0"), ("input_nc", "3"), ("output_nc", "3"), ("max_dataset_size", "inf"), ("load_size", "286"), ("phase", "train"))),
        *(("test defaults", k, v) for k, v in (("model", "test"), ("dataset_mode", "single"), ("norm", "instance"), ("netG", "resnet_9blocks"), ("no_dropout", "False"), ("input_nc", "3"), ("output_nc", "3"), ("max_dataset_size", "inf"), ("load_size", "256"), ("phase", "test"))),
    )
)
def e3_layers(spark, sf_dir):
    """What the user gives wins over what the model changes; test runs have defaults of their own."""
    cases = {
        "given norm": resolve({"dataroot": "d", "model": "paired", "norm": "instance", "dataset_mode": "unaligned"}),
        "test defaults": resolve({"dataroot": "d"}, is_train=False),
    }
    return _options(spark, cases, LAYERED)


@query(
    rows_sql(
        "run, option, value",
        *(("paired, training", k, v) for k, v in (("norm", "batch"), ("netG", "unet_256"), ("dataset_mode", "aligned"), ("pool_size", "0"), ("gan_mode", "vanilla"), ("lambda_L1", "100.0"))),
        *(("paired, test", k, v) for k, v in (("norm", "batch"), ("netG", "unet_256"), ("dataset_mode", "aligned"))),
    )
)
def e4_paired_defaults(spark, sf_dir):
    cases = {"paired, training": resolve({"dataroot": "d", "model": "paired"}), "paired, test": resolve({"dataroot": "d", "model": "paired"}, is_train=False)}
    return _options(spark, cases, ("norm", "netG", "dataset_mode", "pool_size", "gan_mode", "lambda_L1"))


@query(
    rows_sql(
        "run, option, value",
        *(("unpaired, training", k, v) for k, v in (("no_dropout", "True"), ("lambda_A", "10.0"), ("lambda_B", "10.0"), ("lambda_identity", "0.5"))),
        ("unpaired, test", "no_dropout", "True"),
    )
)
def e5_unpaired_defaults(spark, sf_dir):
    given = {"dataroot": "d", "model": "unpaired"}
    return _options(spark, {"unpaired, training": resolve(given), "unpaired, test": resolve(given, is_train=False)}, ("no_dropout", "lambda_A", "lambda_B", "lambda_identity"))


@query(
    rows_sql(
        "run, option, value",
        *(("colour", k, v) for k, v in (("dataset_mode", "colorization"), ("input_nc", "1"), ("output_nc", "2"), ("direction", "AtoB"), ("max_dataset_size", "inf"), ("lambda_L1", "100.0"))),
        *(("template", k, v) for k, v in (("dataset_mode", "template"), ("input_nc", "3"), ("output_nc", "3"), ("direction", "AtoB"), ("max_dataset_size", "10"), ("new_dataset_option", "2.0"), ("lambda_regression", "1.0"))),
    )
)
def e6_mode_defaults(spark, sf_dir):
    cases = {"colour": resolve({"dataroot": "d", "model": "colorization"}), "template": resolve({"dataroot": "d", "model": "template", "dataset_mode": "template"})}
    return _options(spark, cases, ("dataset_mode", "input_nc", "output_nc", "direction", "max_dataset_size", "new_dataset_option", "lambda_L1", "lambda_regression"))


@query("SELECT p_partkey, './results//run/test_' || CASE WHEN p_size > 25 THEN 'latest_iter' || p_size ELSE 'latest' END AS folder FROM part")
def e8_results_folders(spark, sf_dir):
    """Folders by the naming rule, over a table of saved steps."""
    folder = lambda k: results_folder(resolve({"dataroot": "d", "name": "run", "load_iter": k if k > 25 else 0}, is_train=False))
    names = F.create_map(*[x for k in range(1, 51) for x in (F.lit(k), F.lit(folder(k)))])
    return table(spark, sf_dir, "part").select("p_partkey", F.element_at(names, F.col("p_size")).alias("folder"))


DUMPED = (
    ("run/train_opt.txt", "batch_size", f"{'batch_size':>25}: {'4':<30}\t[default: 1]"),
    ("run/train_opt.txt", "beta1", f"{'beta1':>25}: {'0.5':<30}"),
    ("run/train_opt.txt", "name", f"{'name':>25}: {'run':<30}\t[default: experiment_name]"),
)


@query(rows_sql("file, option, line", *DUMPED) + " UNION ALL SELECT 'run/train_opt.txt', 'lines', (32 + 18 + 3 + 2)::VARCHAR")
def s18_e10_options_dump(spark, sf_dir):
    """The dump is written to a folder that need not exist, twice, and read back."""
    config = resolve({"dataroot": "d", "name": "run", "batch_size": 4, "checkpoints_dir": _folder(spark)})
    for _ in range(2):
        path = lifecycle.write_options(spark, config)
    lines = spark.read.text(path).withColumn("option", F.trim(F.split("value", ":")[0]))
    asked = lines.filter(F.col("option").isin("batch_size", "beta1", "name")).select("option", F.col("value").alias("line"))
    counted = lines.select(F.lit("lines").alias("option"), "value").groupBy("option").agg(F.count("*").cast("string").alias("line"))
    name = "/".join(options_file(config).rsplit("/", 2)[1:])
    return asked.unionByName(counted).select(F.lit(name).alias("file"), "option", "line")


@query("SELECT n_name, 'run_resnet_9blocks_' || n_nationkey AS name FROM nation")
def f2_suffix(spark, sf_dir):
    """Names with a suffix from options, over a table of batch sizes."""
    name = lambda k: from_arguments(f"--dataroot d --name run --suffix {{netG}}_{{batch_size}} --batch_size {k}".split()).name
    names = F.create_map(*[x for k in range(25) for x in (F.lit(k), F.lit(name(k)))])
    return table(spark, sf_dir, "nation").select("n_name", F.element_at(names, F.col("n_nationkey").cast("int")).alias("name"))


@query(rows_sql("name, found", ("Aligned", "aligned"), ("un_aligned", "unaligned"), ("SINGLE", "single"), ("Color_ization", "colorization"), ("template", "template"), ("nothing", "no dataset mode named nothing")))
def f1_names(spark, sf_dir):
    """Dataset modes by name, without regard to case and underscores; an unknown one raises."""

    def found(name: str) -> str:
        try:
            return registry.dataset(name).__name__
        except NotImplementedError as e:
            return str(e)

    return spark.createDataFrame([(n, found(n)) for n in ("Aligned", "un_aligned", "SINGLE", "Color_ization", "template", "nothing")], "name string, found string")


@query(rows_sql("policy, found", ("linear", "3 rates"), ("step", "3 rates"), ("cosine", "3 rates"), ("plateau", "3 rates"), ("other", "learning rate policy other")))
def f14_policies(spark, sf_dir):
    """An unknown policy raises."""

    def found(policy: str) -> str:
        try:
            return f"{learning_rates(spark, policy, 3).count()} rates"
        except NotImplementedError as e:
            return str(e)

    return spark.createDataFrame([(p, found(p)) for p in ("linear", "step", "cosine", "plateau", "other")], "policy string, found string")


@query("SELECT 0 AS line_no, '================ Training Loss (Tue Jan  2 03:04:05 2024) ================' AS line")
def f8_log_header(spark, sf_dir):
    """The header with which a run's log begins, written and read back."""
    folder = _folder(spark)
    sinks.start_log(spark, folder, datetime(2024, 1, 2, 3, 4, 5))
    return spark.read.text(folder).select(F.lit(0).alias("line_no"), F.col("value").alias("line"))


@query(rows_sql("option, value", ("num_threads", "0"), ("batch_size", "1"), ("serial_batches", "True"), ("no_flip", "True"), ("num_test", "7")))
def b5_test_overrides(spark, sf_dir):
    """What a test run fixes, whatever was given."""
    config = test_run(resolve({"dataroot": "d", "batch_size": 8, "num_threads": 3, "num_test": 7}, is_train=False))
    return _options(spark, {"": config}, ("num_threads", "batch_size", "serial_batches", "no_flip", "num_test")).drop("run")


@query("SELECT rank, count(*) AS samples, count(DISTINCT idx) AS different FROM (SELECT (pos % 4)::INT AS rank, pos % n AS idx FROM (SELECT count(*) AS n FROM documents), range((SELECT (count(*) + 3) // 4 * 4 FROM documents)) t(pos)) GROUP BY rank")
def b4_workers(spark, sf_dir):
    """An epoch dealt to four workers, as Spark tasks do the loading."""
    n = table(spark, sf_dir, "documents").count()
    rows = batched(sharded(epoch_order(spark, n, 0, serial=True), n, 4), 16)
    return rows.groupBy("rank").agg(F.count("*").alias("samples"), F.countDistinct("idx").alias("different"))


@query("SELECT id, id * 3 + 2 AS score FROM (SELECT p_partkey AS id FROM part)")
def u2_u3_plugged_model(spark, sf_dir):
    """A registered model with options of its own scores a table in Arrow batches."""

    @registry.register_model("affine", "id long, score long", {"times": 3}, {"plus": 1})
    def affine(batches):
        for b in batches:
            b["score"] = b["id"] * config.times + config.plus
            yield b[["id", "score"]]

    config = resolve({"dataroot": "d", "model": "affine", "plus": 2}, **registry.option_layers())
    return registry.scored(table(spark, sf_dir, "part").select(F.col("p_partkey").cast("long").alias("id")), "Affine")


@query(f"SELECT vec_id, y, x, 255 - v AS v FROM {GRID}")
def u4_inline_transform(spark, sf_dir):
    """A function of the caller's over image rows."""
    found = _channels(pixels.over_images(_images(spark, sf_dir), lambda image, _: 255 - image)).filter("c = 0")
    return found.select("vec_id", "y", "x", "v")
