import random

import pytest
from pyspark.sql import functions as F

from tessella.operators import confusion, epochs, losses, pairing
from tessella.operators.ranking import dense_index, truncated
from tessella.streaming import replay


def test_dense_index_over_many_ranges(spark):
    df = spark.createDataFrame([(f"p{(k * 7919) % 5000:05d}",) for k in range(5000)], "path string").repartition(4)
    got = dense_index(df, "path").collect()
    assert sorted(r.idx for r in got) == list(range(5000))
    assert [r.path for r in sorted(got, key=lambda r: r.idx)] == sorted(r.path for r in got)


def test_dense_index_with_ties_nulls_and_no_rows(spark):
    df = spark.createDataFrame([("a",)] * 3 + [(None,)] * 2 + [("b",)], "path string")
    got = sorted((r.idx, r.path) for r in dense_index(df, "path").collect())
    assert [p for _, p in got] == [None, None, "a", "a", "a", "b"]
    assert dense_index(df.limit(0), "path").count() == 0


def test_truncation_is_by_components(spark):
    df = spark.createDataFrame([("a-b/1.png",), ("a/1.png",), ("a/0/z.png",)], "path string")
    assert {r.path for r in truncated(df, "path", 2).collect()} == {"a/1.png", "a/0/z.png"}


def sequential_confusion(frames, n):
    total = {}
    for gt, pred in frames:
        cells = [n * g + p for g, p in zip(gt, pred, strict=True) if 0 <= g < n]
        if cells and max(cells) >= n * n:
            continue
        for c in cells:
            total[c // n, c % n] = total.get((c // n, c % n), 0) + 1
    return total


def test_confusion_spills_and_drops(spark):
    frames = [([0, 1, 2, 255], [0, 1, 1, 2]), ([0, 0, 1], [3, 0, 1]), ([2, 0], [3, 0]), ([255], [1])]
    pixels = [(k, g, p) for k, (gt, pred) in enumerate(frames) for g, p in zip(gt, pred, strict=True)]
    df = spark.createDataFrame(pixels, "frame int, gt int, pred int")
    got = {(r.gt, r.pred): r.cnt for r in confusion.accumulate(confusion.frame_confusion(df, 3)).collect()}
    assert got == sequential_confusion(frames, 3)
    strict = confusion.accumulate(confusion.frame_confusion(df, 3, strict=True))
    assert sum(r.cnt for r in strict.collect()) == 6


def test_absent_class_counts_as_zero(spark):
    counts = spark.createDataFrame([(0, 0, 4), (1, 1, 4)], "gt int, pred int, cnt long")
    row = confusion.scores(counts, 4).first()
    assert row.pixel_acc == pytest.approx(1) and row.mean_class_acc == pytest.approx(0.5) and row.mean_class_iou == pytest.approx(0.5)
    empty = confusion.scores(counts.limit(0), 2).first()
    assert (empty.pixel_acc, empty.mean_class_acc) == (0, 0)


def test_pairs_cover_both_sides(spark):
    a, b = (dense_index(spark.range(n).withColumnRenamed("id", "k"), "k") for n in (7, 3))
    got = pairing.cyclic_pairs(a, b).collect()
    assert len(got) == 7 and {r.a_k for r in got} == set(range(7)) and {r.b_k for r in got} == {0, 1, 2}
    drawn = pairing.random_pairs(a, b, epoch=1).collect()
    assert {r.a_k for r in drawn} == set(range(7)) and {r.b_k for r in drawn} <= {0, 1, 2}
    assert pairing.random_pairs(a, b, epoch=1).orderBy("idx").collect() == sorted(drawn, key=lambda r: r.idx)


def test_guards_raise(spark):
    a, b = (dense_index(spark.range(n).withColumnRenamed("id", "k"), "k") for n in (3, 2))
    with pytest.raises(ValueError, match="equal counts"):
        pairing.positional_pairs(a, b)
    maps = spark.createDataFrame([(0, "m/x_1_gtFine_color.png")], "idx long, path string")
    photos = spark.createDataFrame([(0, "p/x_2_leftImg8bit.png")], "idx long, path string")
    with pytest.raises(Exception, match="no pair"):
        pairing.checked_pairs(maps, photos).collect()
    truth = spark.createDataFrame([("f1",), ("f2",)], "frame string")
    with pytest.raises(Exception, match="no prediction for f2"):
        pairing.predictions_for(truth, spark.createDataFrame([("f1", 1)], "frame string, pred int")).collect()
    sizes = spark.createDataFrame([(0, 1, 1, 1, 2)], "idx long, a_width int, a_height int, b_width int, b_height int")
    with pytest.raises(Exception, match="sizes differ"):
        pairing.same_size(sizes).collect()


def test_name_pairs_with_gaps(spark):
    a = spark.createDataFrame([("train", "1_A.png"), ("train", "2_A.png"), ("train", "x.png"), ("val", "1_A.png")], "split string, name string")
    b = spark.createDataFrame([("train", "1_B.png"), ("val", "2_B.png")], "split string, name string")
    assert [tuple(r) for r in pairing.name_pairs(a, b).collect()] == [("train", "1_A.png", "1_B.png", "1.png")]
    assert pairing.name_pairs(a, b.limit(0)).count() == 0
    plain = pairing.name_pairs(a, a, suffixed=False, max_images=1).orderBy("split").collect()
    assert [(r.split, r.a_name) for r in plain] == [("train", "1_A.png"), ("val", "1_A.png")]


def test_epochs_are_permutations(spark):
    orders = [[r.idx for r in epochs.epoch_order(spark, 100, e).orderBy("pos").collect()] for e in (0, 1)]
    assert all(sorted(o) == list(range(100)) for o in orders) and orders[0] != orders[1] != list(range(100))
    shards = epochs.sharded(epochs.epoch_order(spark, 10, 0, serial=True), 10, 4).collect()
    by_rank = {k: sorted(r.idx for r in shards if r.rank == k) for k in range(4)}
    assert {len(v) for v in by_rank.values()} == {3} and sorted(x for v in by_rank.values() for x in v)[:4] == [0, 0, 1, 1]


def test_l1_weighs_elements_not_rows(spark):
    df = spark.createDataFrame([([1.0, 1.0, 1.0], [0.0, 0.0, 0.0]), ([5.0], [0.0])], "a array<double>, b array<double>")
    assert df.agg(losses.l1("a", "b").alias("x")).first().x == pytest.approx(2.0)
    with pytest.raises(NotImplementedError):
        losses.gan_loss("other", "a", True)
    assert df.select(losses.identity_loss(F.lit(3.0), 10.0, 0.0)).first()[0] == 0


def sequential_pool(items, size):
    pool, out = [], []
    for item, p, slot in items:
        if size == 0 or len(pool) < size:
            if size:
                pool.append(item)
            out.append(item)
        elif p > 0.5:
            out.append(pool[slot])
            pool[slot] = item
        else:
            out.append(item)
    return out


@pytest.mark.parametrize("size", [0, 1, 5])
def test_replay_equals_sequential(spark, size):
    rng = random.Random(size)
    items = [(k * 10, rng.random(), rng.randrange(max(1, size))) for k in range(60)]
    df = spark.createDataFrame([(k, *x) for k, x in enumerate(items)], "seq long, item long, p double, slot long")
    got = [r.returned for r in replay.replay(df, size).orderBy("seq").collect()]
    assert got == sequential_pool(items, size)


def test_replay_stream(spark, tmp_path):
    rng = random.Random(1)
    items = [(k * 10, rng.random(), rng.randrange(4)) for k in range(40)]
    df = spark.createDataFrame([("k", n, *x) for n, x in enumerate(items)], "key string, seq long, item long, p double, slot long")
    live = tmp_path / "live"
    live.mkdir()
    stream = replay.replay_stream(spark.readStream.schema(df.schema).parquet(str(live)), 4, "key")
    query = stream.writeStream.format("memory").queryName("pool").option("checkpointLocation", f"{tmp_path}/state").start()
    for part, where in enumerate(("seq < 20", "seq >= 20")):  # a batch for each part, in order
        df.filter(where).coalesce(1).write.parquet(f"{tmp_path}/in/{part}")
        for f in (tmp_path / "in" / str(part)).glob("part-*.parquet"):
            f.rename(live / f"{part}-{f.name}")
        query.processAllAvailable()
    query.stop()
    out = [r.returned for r in spark.table("pool").orderBy("seq").collect()]
    assert out == sequential_pool(items, 4)
