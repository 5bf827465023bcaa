"""Manifest preparation, settings and small curve functions."""

from __future__ import annotations

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from framelens import config
from framelens.functions.segments import share_inside
from framelens.operators import manifest, solutions, tuning


def splits(spark, train=9, test=1):
    rows = [(f"{i}.jpg", "train") for i in range(1, train + 1)] + [(f"{train + i}.jpg", "test") for i in range(1, test + 1)]
    return spark.createDataFrame(rows, "file string, split string")


def counts(df):
    return {r["split"]: r["count"] for r in df.groupBy("split").count().collect()}


def test_validation_and_sampling(spark):
    carved = manifest.carve_validation(splits(spark), 0)
    assert counts(carved) == {"train": 8, "val": 1, "test": 1}
    sampled = manifest.sample_splits(carved, [0.25, 1])
    assert counts(sampled) == {"train": 2, "val": 1, "test": 1}
    names = sorted(r.file for r in carved.where("split = 'train'").collect())
    assert sorted(r.file for r in sampled.where("split = 'train'").collect()) == [names[0], names[-1]]
    assert counts(manifest.sample_splits(carved, [0.25, 1, 0])) == {"train": 2, "val": 1}
    assert counts(manifest.carve_validation(splits(spark, 1, 0))) == {"train": 1}
    with pytest.raises(ValueError):
        manifest.split_fractions([0.0])


def test_class_table(spark):
    rows = {r.id: r.cls for r in manifest.class_table_91_to_80(spark).collect()}
    assert rows[1] == 0 and rows[12] is None and rows[13] == 11 and rows[90] == 79 and sum(v is not None for v in rows.values()) == 80


def test_windows(spark):
    objects = spark.createDataFrame([("p", [90.0, 10.0, 110.0, 10.0, 110.0, 30.0, 90.0, 30.0], 90.0, 10.0, 110.0, 30.0)], "image string, polygon array<double>, x1 double, y1 double, x2 double, y2 double")
    windows = spark.createDataFrame([("p", 0, 0, 100, 100), ("p", 80, 0, 180, 100)], "image string, tx1 int, ty1 int, tx2 int, ty2 int")
    [row] = manifest.rebase(manifest.assign_to_windows(objects, windows)).collect()
    assert row.polygon[:2] == [10.0, 10.0] and row.tile == "p__100__80___0"


def _many_objects(spark, n):
    """Upright boxes of ten images' hundreds of objects, each with its polygon."""
    sides = {"x1": F.col("id") % 20, "y1": F.col("id") % 17, "x2": F.col("id") % 20 + 14, "y2": F.col("id") % 17 + 11}
    rows = spark.range(0, n, 1, 4).withColumns({c: v.cast("double") for c, v in sides.items()})
    return rows.select((F.col("id") % 10).alias("image"), "id", F.array("x1", "y1", "x2", "y1", "x2", "y2", "x1", "y2").alias("polygon"), *sides)


def test_windows_of_many_objects(spark):
    """Polygons are cut together: one by one these took over 30 seconds. Shares of boxes are exact."""
    windows = spark.createDataFrame([(i, x, x, x + 24, x + 24) for i in range(10) for x in (0, 24)], "image long, tx1 int, ty1 int, tx2 int, ty2 int")
    inside = "greatest(0, least(x2, tx2) - greatest(x1, tx1)) * greatest(0, least(y2, ty2) - greatest(y1, ty1))"
    found = manifest.assign_to_windows(_many_objects(spark, 600_000), windows, 0.0).withColumn("wrong", F.abs(F.col("share") - F.expr(inside) / 154.0) > 1e-12)
    start = time.monotonic()
    n, wrong = found.agg(F.count("*"), F.count_if("wrong")).first()
    assert n > 600_000 and wrong == 0 and time.monotonic() - start < 30


def test_windows_are_not_broadcast(spark):
    """Estimates don't count what an explode adds: 36,000,000 windows were broadcast as a small table."""
    windows = spark.range(10).select(F.col("id").alias("image"), *[F.lit(v).alias(c) for c, v in (("tx1", 0), ("ty1", 0), ("tx2", 24), ("ty2", 24))])
    plan = manifest.assign_to_windows(_many_objects(spark, 100), windows, 0.3)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_shares_of_odd_polygons(spark):
    """Turned, hollow, of different length, missing: against areas by hand."""
    polygons = [[0.0, 5.0, 5.0, 0.0, 10.0, 5.0, 5.0, 10.0], [0.0, 0.0, 10.0, 0.0, 10.0, 10.0, 8.0, 10.0, 8.0, 2.0, 0.0, 2.0], [0.0, 0.0, 10.0, 0.0, 0.0, 10.0], [1.0, 1.0, 2.0, 2.0], [], None, [1.0, None, 2.0, 2.0, 3.0, 1.0]]
    rows = spark.createDataFrame(list(enumerate(polygons)), "i int, p array<double>")
    both = rows.select("i", *[share_inside("p", *[F.lit(float(v)) for v in w]).alias(n) for n, w in (("a", (0, 0, 5, 5)), ("b", (5, 0, 10, 10)))])
    got = {r.i: (r.a, r.b) for r in both.collect()}
    assert got[0] == pytest.approx((0.25, 0.5)) and got[1] == pytest.approx((10 / 36, 26 / 36)) and got[2] == pytest.approx((0.5, 0.25))
    assert got[3] == got[4] == (0.0, 0.0) and got[5] == got[6] == (None, None)


def test_label_sampling(spark):
    rows = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "z")], "image string, label string")
    words = spark.createDataFrame([(w,) for w in "uvwxyz"], "label string")
    got = manifest.sample_labels(rows, words, 4).collect()
    assert {r.image: sum(r.present for r in got if r.image == r.image) for r in got}
    for image, own in (("a", {"x", "y"}), ("b", {"z"})):
        mine = [r for r in got if r.image == image]
        assert sorted(r.number for r in mine) == [0, 1, 2, 3] and {r.label for r in mine if r.present} == own
    assert {r.label: r.number for r in manifest.merge_vocabularies(rows, "image", "label").where("image = 'a'").collect()} == {"x": 0, "y": 1}


def test_small_expressions(spark):
    one = lambda c: spark.range(1).select(c.alias("v")).first().v
    assert [one(manifest.area_bucket(F.lit(a))) for a in (1023, 1024, 9216)] == ["small", "medium", "large"]
    assert one(manifest.clamp(F.lit(2.5), 0, 10, whole=True)) == 2 and one(manifest.clamp(F.lit(12.0), 0, 10)) == 10
    assert one(manifest.like_aspect(F.lit(4.0), F.lit(3.0), F.lit(8.0), F.lit(6.0)))
    assert manifest.crop_layers(100, 100, 1, 0.0)[1:] == [(0, 0, 50, 50, 1), (0, 50, 50, 100, 1), (50, 0, 100, 50, 1), (50, 50, 100, 100, 1)]


def test_gaussian_smoothing(spark):
    y = np.array([0.0, 0, 0, 10, 0, 0, 0, 5])
    rows = manifest.gaussian_smooth(spark.createDataFrame(list(enumerate(y.tolist())), "x int, y double"), "x", "y", 1.0, 2.0).orderBy("x").collect()
    w = np.exp(-0.5 * np.arange(-2, 3) ** 2.0)
    assert [r.smooth_y for r in rows] == pytest.approx(np.convolve(np.r_[[y[0]] * 2, y, [y[-1]] * 2], w / w.sum(), "valid").tolist())


def test_settings():
    defaults = {"conf": 0.25, "classes": None, "name": "x", "show": False}
    assert config.from_words(defaults, ["conf", "=", "0.5", "classes=[1,", "2]", "show=true"]) == {"conf": 0.5, "classes": [1, 2], "name": "x", "show": True}
    with pytest.raises(KeyError, match="conf"):
        config.from_words(defaults, ["cnf=1"])
    with pytest.raises(TypeError):
        config.merged(defaults, {"show": 3})
    with pytest.raises(ValueError):
        config.merged(defaults, {"conf": 2}, bounds={"conf": (0, 1)})


def test_mutations_are_new_and_within_bounds():
    space, whole = {"lr0": (1e-4, 0.1), "epochs": (1.5, 6.9), "fixed": (3.0, 3.0)}, ("epochs",)
    defaults = {"lr0": 0.2, "epochs": 9, "fixed": 3.0}
    rng = np.random.default_rng(1)
    assert tuning.mutate([], space, defaults, rng, whole) == {"lr0": 0.1, "epochs": 6, "fixed": 3.0}
    history = [(0.1 * i, {"lr0": 0.01 * i, "epochs": 2 + i % 5, "fixed": 3.0}) for i in range(1, 9)]
    for _ in range(50):
        child = tuning.mutate(history, space, defaults, rng, whole)
        assert 1e-4 <= child["lr0"] <= 0.1 and child["epochs"] in range(2, 7) and child["fixed"] == 3.0
        assert child not in [h for _, h in history]
        history.append((rng.random(), child))
    with pytest.raises(ValueError):
        tuning.mutate([(1.0, {"a": 1})], {"a": (1, 1)}, {"a": 1}, rng)
    with pytest.raises(RuntimeError):
        tuning.mutate([(1.0, {"a": 1}), (1.0, {"a": 2})], {"a": (1, 2)}, {"a": 1}, rng, ("a",))


def test_solutions_by_name(spark):
    rows = [(0, t, f, 10.0 * f + t, 30.0, "car") for t in range(3) for f in range(6)]
    points = spark.createDataFrame(rows, "stream long, track long, frame long, cx double, cy double, cls string")
    total = solutions.run_solution(points, ["count", "region=[[25, -100], [25, 100]]"]).collect()
    assert [(r.cls, r.n_in, r.n_out) for r in total] == [("car", 3, 0)]
    assert solutions.run_solution(points, ["nothing", "region=[[25, -100], [25, 100]]"]).collect() == total
    assert [(r.stream, r.frame) for r in solutions.run_solution(points, ["security", "records=3"]).collect()] == [(0, 0)]
    assert solutions.run_solution(points, ["trackzone", "region=[[0, 0], [15, 0], [15, 50], [0, 50]]"]).count() == 6
    assert {r.frame for r in solutions.run_solution(points, ["distance", "first=0", "second=2"]).collect()} == set(range(6))
    with pytest.raises(KeyError):
        solutions.run_solution(points, ["queue", "regoin=1"])
