import numpy as np
import pytest
from pyspark.sql import functions as F

from tessella.plans import lifecycle, registry
from tessella.plans import datasets as _modes  # noqa: F401  (registers the built-in modes)
from tessella.plans.config import resolve
from tessella.sources import images, listing, sinks


def test_training_plan(spark):
    config = resolve({"dataroot": "d", "batch_size": 4, "n_epochs": 2, "n_epochs_decay": 1, "print_freq": 8, "max_dataset_size": 9})
    rows = lifecycle.training_epoch(spark, config, 20, 1).collect()
    assert {r.batch_id for r in rows} == {0, 1, 2} and len({r.idx for r in rows}) == 12
    shards = lifecycle.training_epoch(spark, resolve({"dataroot": "d", "batch_size": 4}), 10, 0, world=3).collect()
    assert {k: sum(r.rank == k for r in shards) for k in range(3)} == {0: 4, 1: 4, 2: 4} and {r.idx for r in shards} == set(range(10))
    steps = lifecycle.training_steps(spark, config, 20).orderBy("total_iters").collect()
    assert [(r.epoch, r.total_iters) for r in steps] == [(1, 8), (1, 16), (2, 24), (2, 32), (2, 40), (3, 48), (3, 56)]
    rates = [r.lr for r in lifecycle.training_rates(spark, config).orderBy("epoch").collect()]
    assert rates == pytest.approx([0.0002, 0.0002, 0.0001])


def test_test_run(spark, tmp_path):
    for k in range(3):
        path = tmp_path / "data" / f"{k}.png"
        path.parent.mkdir(exist_ok=True)
        path.write_bytes(sinks.png(np.full((4, 4, 3), k * 40, np.uint8)))
    given = {"dataroot": str(tmp_path / "data"), "preprocess": "none", "results_dir": str(tmp_path / "out"), "checkpoints_dir": str(tmp_path / "ck"), "num_test": 2}
    config = resolve(given, is_train=False)
    samples = lifecycle.test_samples(spark, config).cache()
    assert sorted(r.idx for r in samples.collect()) == [0, 1]

    @registry.register_model("negative", "idx long, name string, k int, label string, width int, height int, n_channels int, pixels binary")
    def negative(batches):
        for b in batches:
            for label, k in (("real", 0), ("fake", 1)):
                out = b.assign(k=k, label=label)
                out["pixels"] = [bytes(255 - v for v in p) if k else bytes(p) for p in b["pixels"]]
                yield out[["idx", "name", "k", "label", "width", "height", "n_channels", "pixels"]]

    flat = samples.select("idx", F.format_string("%03d", "idx").alias("name"), "a.*")
    folder = lifecycle.test_report(spark, config, registry.scored(flat, "negative"))
    page = (tmp_path / folder / "index.html").read_text()
    assert page.index("000_real.png") < page.index("000_fake.png") < page.index("001_real.png") and "Phase = test" in page
    back = {r.path.split("/")[-1]: bytes(r.pixels) for r in images.read_images(spark, f"{folder}/images").collect()}
    assert back["001_fake.png"] == bytes([215]) * 48 and len(back) == 4
    with open(lifecycle.write_options(spark, config)) as f:
        assert "num_test: 2" in f.read()
    assert listing.image_folder(spark, given["dataroot"], images.read_images).count() == 3


def test_evaluation(spark):
    truth = spark.createDataFrame([("f", 0, 0, 0), ("f", 0, 1, 1), ("f", 1, 0, 255), ("f", 1, 1, 1)], "frame string, y int, x int, label int")
    predicted = spark.createDataFrame([("f", 0, 0, 0), ("f", 0, 1, 0), ("f", 1, 0, 1), ("f", 1, 1, 1)], "frame string, y int, x int, pred int")
    scores, lines = lifecycle.evaluate(truth, predicted, ["road", "sky"])
    row = scores.first()
    assert (row.pixel_acc, row.mean_class_acc, row.mean_class_iou) == pytest.approx((2 / 3, 0.75, 0.5))
    assert [r.line for r in lines.orderBy("line_no").collect()][4:] == ["road           : acc = 1.000000, iou = 0.500000", "sky            : acc = 0.500000, iou = 0.500000"]
    with pytest.raises(Exception, match="no prediction for f"):
        lifecycle.evaluate(truth, predicted.limit(0), ["road", "sky"])[0].collect()
