from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessella.operators import confusion
from tessella.plans import registry
from tessella.plans.config import checkpoint_name, from_arguments, options_text, resolve, results_folder, test_run
from tessella.plans.datasets import aligned  # noqa: F401  (registers the built-in modes)
from tessella.sources import images, listing, sinks

test_run.__test__ = False


def picture(seed, h=6, w=8):
    return np.random.default_rng(seed).integers(0, 256, (h, w, 3), dtype=np.uint8)


def write(path, content):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(content)


@pytest.fixture
def tree(tmp_path):
    for k, name in enumerate(["a/1.png", "a-b/1.png", "x.PNG", "x.Png", "x.txt", "a/b/c/2.png"]):
        write(tmp_path / name, sinks.png(picture(k)))
    write(tmp_path / "p.ppm", b"P6 8 6 255\n" + picture(9).tobytes())
    return tmp_path


def names(df, root):
    return [r.path.split(f"{root}/")[1] for r in df.orderBy("idx").collect()]


def test_listing(spark, tree):
    assert names(listing.list_images(spark, str(tree)), tree) == ["a-b/1.png", "a/1.png", "a/b/c/2.png", "p.ppm", "x.PNG"]
    assert names(listing.list_images(spark, str(tree), 2), tree) == ["a/1.png", "a/b/c/2.png"]
    assert names(listing.list_flat(spark, str(tree)), tree) == []
    with pytest.raises(NotADirectoryError):
        listing.list_images(spark, str(tree / "none"))
    (tree / "empty").mkdir()
    with pytest.raises(RuntimeError, match="Found 0 images"):
        listing.image_folder(spark, str(tree / "empty"))


def test_decoding(spark, tree):
    rows = {r.path.split(f"{tree}/")[1]: r for r in images.read_images(spark, str(tree)).collect()}
    assert set(rows) == {"a/1.png", "a-b/1.png", "x.PNG", "a/b/c/2.png", "p.ppm"}
    for k, name in enumerate(["a/1.png", "a-b/1.png", "x.PNG"]):
        assert bytes(rows[name].pixels) == picture(k).tobytes() and (rows[name].width, rows[name].height) == (8, 6)
    assert bytes(rows["p.ppm"].pixels) == picture(9).tobytes()
    write(tree / "bad" / "z.png", b"nothing")
    with pytest.raises(Exception, match="cannot decode"):
        images.read_images(spark, str(tree / "bad")).collect()


def test_city_frames(spark, tmp_path):
    label = np.array([[[0] * 3, [7] * 3], [[8] * 3, [255] * 3]], np.uint8)
    for name in ("aachen_000000_000019", "aachen_000001_000019", "bonn_000000_000000"):
        city = name.split("_")[0]
        write(tmp_path / "gtFine/val" / city / f"{name}_gtFine_labelIds.png", sinks.png(label))
        write(tmp_path / "gtFine/val" / city / f"{name}_gtFine_color.png", sinks.png(label))
    got = listing.label_frames(spark, str(tmp_path), "val").orderBy("idx").collect()
    assert [(r.city, r.frame) for r in got] == [("aachen", "aachen_000000_000019"), ("aachen", "aachen_000001_000019"), ("bonn", "bonn_000000_000000")]
    assert listing.list_two_levels(spark, f"{tmp_path}/gtFine", "val", "_color.png").count() == 3
    write(tmp_path / "ImageSets/segFine/val.txt", b"aachen/x\nbonn/y\n")
    assert [tuple(r) for r in listing.split_list(spark, str(tmp_path), "test").collect()] == [("aachen", "x"), ("bonn", "y")]
    truth = images.labels(images.read_images(spark, f"{tmp_path}/gtFine/val/bonn").filter(F.col("path").contains("labelIds")), {7: 0, 8: -1})
    assert [r.label for r in truth.orderBy("y", "x").collect()] == [0, 0, 255, 255]
    pixels = truth.select(F.lit("f").alias("frame"), F.col("label").alias("gt"), F.lit(0).alias("pred"))
    assert [tuple(r) for r in confusion.frame_confusion(pixels, 2).collect()] == [("f", 0, 0, 2)]


def test_png_sink_and_report(spark, tree, tmp_path):
    out = tmp_path / "web"
    rows = images.read_images(spark, f"{tree}/a").withColumn("name", F.concat(F.monotonically_increasing_id().cast("string"), F.lit(".png")))
    sinks.write_files(sinks.encoded(rows), str(out / "images"))
    back = images.read_images(spark, str(out / "images")).select("pixels").collect()
    assert {bytes(r.pixels) for r in back} == {picture(0).tobytes(), picture(5).tobytes()}
    wide = sinks.encoded(rows, ratio=2.0).first().content
    assert bytes(wide)[16:20] == (16).to_bytes(4, "big")
    report = spark.createDataFrame([(1, "<p>two</p>"), (0, "<p>one</p>")], "position int, html string")
    sinks.write_report(spark, report, str(out), "A & B", refresh=1)
    page = (out / "index.html").read_text()
    assert page.index("one") < page.index("two") and "A &amp; B" in page and "refresh" in page


def test_log_sink(spark, tmp_path):
    record = [(0, 1, 100, 0.5, 0.25, [("G", 1.5)]), (1, 1, 100, 0.5, 0.25, [("G", 9.0)])]
    df = spark.createDataFrame(record, "rank int, epoch int, iters long, t_comp double, t_data double, losses array<struct<name:string,value:double>>")
    for _ in range(2):
        sinks.append_log(df, str(tmp_path / "log"))
    lines = [r.value for r in spark.read.text(str(tmp_path / "log")).collect()]
    assert lines.count("[Rank 0] (epoch: 1, iters: 100, time: 0.500, data: 0.250) , G: 1.500") == 2 and lines.count("") == 2
    assert sinks.log_header(datetime(2024, 1, 2)).startswith("================ Training Loss (")


def test_aligned_samples(spark, tmp_path):
    wide = picture(3, 4, 8)
    write(tmp_path / "train/1.png", sinks.png(wide))
    config = resolve({"dataroot": str(tmp_path), "model": "paired", "preprocess": "none", "no_flip": True, "direction": "BtoA"})
    row = registry.dataset("aligned")(spark, config).first()
    assert bytes(row.b.pixels) == wide[:, :4].tobytes() and bytes(row.a.pixels) == wide[:, 4:].tobytes()


def test_other_modes(spark, tmp_path):
    for k, name in enumerate(["trainA/1.png", "trainA/2.png", "trainA/3.png", "trainB/1.png", "trainB/2.png"]):
        write(tmp_path / name, sinks.png(picture(k, 8, 8)))
    given = {"dataroot": str(tmp_path), "load_size": 8, "crop_size": 4}
    rows = registry.dataset("unaligned")(spark, resolve(given | {"serial_batches": True})).orderBy("idx").collect()
    assert len(rows) == 3 and [r.b_path.split("/")[-1] for r in rows] == ["1.png", "2.png", "1.png"] and rows[0].a.width == 4
    one = registry.dataset("single")(spark, resolve(given | {"dataroot": f"{tmp_path}/trainA", "crop_size": 8}, is_train=False)).collect()
    assert len(one) == 3
    lab = registry.dataset("colorization")(spark, resolve(given | {"model": "colorization", "phase": "trainA"})).first()
    assert len(lab.light) == 16 and len(lab.colour) == 32


@pytest.mark.parametrize("mode", ["aligned", "unaligned", "single", "template"])
def test_samples_are_tensors_with_draws(spark, tmp_path, mode):
    """Gray by the channels of each domain, as the direction has them; normalised tensors; only listed files are opened."""
    shape = (8, 16) if mode == "aligned" else (8, 8)
    for k in range(4):
        for folder in ("train", "trainA", "trainB"):
            write(tmp_path / folder / f"{k}.png", sinks.png(picture(10 * k + len(folder), *shape)))
    for folder in ("train", "trainA", "trainB"):
        write(tmp_path / folder / "9.png", b"not an image")
    root = str(tmp_path / "train") if mode in ("single", "template") else str(tmp_path)
    for direction in ("AtoB", "BtoA"):
        given = {"dataroot": root, "dataset_mode": mode, "load_size": 8, "crop_size": 4, "preprocess": "crop", "input_nc": 1, "max_dataset_size": 4, "serial_batches": True, "direction": direction}
        rows = registry.dataset(mode)(spark, resolve(given)).orderBy("idx").collect()
        assert len(rows) == 4
        sides = [r[x] for r in rows for x in ("a", "b", "data_a", "data_b") if x in r]
        assert all(len(s.tensor) == 16 * s.n_channels and (s.width, s.height) == (4, 4) and 0 <= s.crop_x <= 4 and 0 <= s.crop_y <= 4 for s in sides)
        assert all(np.allclose(np.frombuffer(s.pixels, np.uint8).reshape(4, 4, -1).transpose(2, 0, 1).ravel() / 127.5 - 1, s.tensor, atol=1e-6) for s in sides)
        # Domain A has the channels of the input, or going back those of the output.
        gray = {name: {r[name].n_channels for r in rows} for name in rows[0].asDict() if name in ("a", "b", "data_a", "data_b")}
        first, second = ({1}, {3}) if direction == "AtoB" or mode == "aligned" else ({3}, {1})
        assert gray == {"aligned": {"a": first, "b": second}, "unaligned": {"a": first, "b": second}, "single": {"a": first}, "template": {"data_a": first, "data_b": second}}[mode]
    if mode == "aligned":
        for r in rows:
            both = picture(10 * r.idx + 5, 8, 16)
            left = both[:, :8][r.b.crop_y : r.b.crop_y + 4, r.b.crop_x : r.b.crop_x + 4]
            assert (r.a.crop_x, r.a.crop_y, r.a.flip) == (r.b.crop_x, r.b.crop_y, r.b.flip)
            assert bytes(r.b.pixels) == (left[:, ::-1] if r.b.flip else left).tobytes()


def test_pairs_are_written(spark, tmp_path):
    from tessella.plans import lifecycle

    rows = [spark.createDataFrame([(f"{k}.png", 8, 6, 3, bytearray(picture(k + side).tobytes())) for k in range(3)], "name string, width int, height int, n_channels int, pixels binary") for side in (0, 50)]
    lifecycle.write_pairs(*rows, str(tmp_path / "pairs"))
    back = {r.path.rsplit("/")[-1]: r for r in images.read_images(spark, str(tmp_path / "pairs")).collect()}
    assert all(bytes(back[f"{k}.png"].pixels) == np.concatenate([picture(k), picture(k + 50)], axis=1).tobytes() for k in range(3))


def test_layers():
    config = resolve({"dataroot": "d", "model": "paired"})
    assert (config.norm, config.netG, config.dataset_mode, config.pool_size, config.gan_mode, config.lambda_L1) == ("batch", "unet_256", "aligned", 0, "vanilla", 100.0)
    assert resolve({"dataroot": "d", "model": "paired", "norm": "none"}).norm == "none"
    assert resolve({"dataroot": "d", "model": "colorization"}).input_nc == 1
    assert resolve({"dataroot": "d", "model": "template", "dataset_mode": "template"}).max_dataset_size == 10
    test = resolve({"dataroot": "d"}, is_train=False)
    assert (test.model, test.load_size, test.dataset_mode, test.phase) == ("test", 256, "single", "test")
    assert (test_run(test).batch_size, test_run(test).serial_batches) == (1, True)
    for wrong in ({"dataroot": "d", "nope": 1}, {}, {"dataroot": "d", "model": "test"}, {"dataroot": "d", "model": "x"}):
        with pytest.raises(ValueError):
            resolve(wrong)
    with pytest.raises(ValueError, match="load_size"):
        resolve({"dataroot": "d", "model": "paired", "load_size": 100})


def test_arguments_and_names():
    config = from_arguments("--dataroot d --name run --suffix {netG}_{batch_size} --batch_size 4 --lr 0.01 --no_flip".split())
    assert config.name == "run_resnet_9blocks_4" and config.lr == 0.01 and config.no_flip and config.no_dropout
    text = options_text(config)
    assert f"{'batch_size':>25}: {'4':<30}\t[default: 1]" in text and f"{'beta1':>25}: {'0.5':<30}\n" in text
    assert checkpoint_name("latest", "G") == "latest_net_G.pth" and checkpoint_name("latest", "D", 30) == "iter_30_net_D.pth"
    test = resolve({"dataroot": "d", "load_iter": 5}, is_train=False)
    assert results_folder(test).endswith("experiment_name/test_latest_iter5")
    with pytest.raises(ValueError):
        from_arguments(["--wrong", "1"])


def test_extensions(spark):
    @registry.register_dataset("my_rows", {"max_dataset_size": 3})
    def my_rows(session, config):
        return session.range(config.max_dataset_size)

    @registry.register_model("plus_one", "id long", {"n": 1}, {"m": 2})
    def plus_one(batches):
        for b in batches:
            yield b + 1

    config = resolve({"dataroot": "d", "model": "plusone", "dataset_mode": "myrows"}, **registry.option_layers())
    rows = registry.dataset("My_Rows")(spark, config)
    assert [r.id for r in registry.scored(rows, "plusone").orderBy("id").collect()] == [1, 2, 3] and config.m == 2
    with pytest.raises(NotImplementedError):
        registry.dataset("none")
