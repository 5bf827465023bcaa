"""Operators against hand-made cases and brute-force versions."""

from __future__ import annotations

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from framelens.functions import boxes as bx
from framelens.functions import polygons
from framelens.functions.strings import clean_name, label_path, six_digits
from framelens.functions.vectors import joint_angle
from framelens.operators import assignment, augment, curves, etl, manifest, matching, metrics, search, suppression, trajectories

BOX = "x1 double, y1 double, x2 double, y2 double"


def iou(a, b, eps=1e-7):
    w, h = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
    inter = max(0, w) * max(0, h)
    return inter / ((a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - inter + eps)


def random_scene(seed, images=12, boxes=9):
    rng = random.Random(seed)
    dets, truth = [], []
    for image in range(images):
        for i in range(rng.randint(0, boxes)):
            x, y = rng.randint(0, 15), rng.randint(0, 15)
            truth.append((image, rng.choice("ab"), i, float(x), float(y), float(x + rng.randint(8, 14)), float(y + rng.randint(8, 14))))
        for i in range(rng.randint(0, boxes)):
            x, y = rng.randint(0, 15), rng.randint(0, 15)
            dets.append((image, rng.choice("ab"), i, round(1 - i / 20, 3), float(x), float(y), float(x + rng.randint(8, 14)), float(y + rng.randint(8, 14))))
    return dets, truth


def frames_of(spark, dets, truth):
    dets, truth = [(*d[:3], *map(float, d[3:])) for d in dets], [(*g[:3], *map(float, g[3:])) for g in truth]
    return spark.createDataFrame(dets, f"image long, cls string, det long, conf double, {BOX}"), spark.createDataFrame(truth, f"image long, cls string, gt long, {BOX}")


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def literal_box(*v):
    return bx.Box(*[F.lit(float(x)) for x in v])


def test_iou_of_two_squares(spark):
    assert value(spark, bx.iou(literal_box(0, 0, 10, 10), literal_box(5, 5, 15, 15))) == pytest.approx(25 / 175, abs=1e-6)


def test_conversions_round_trip(spark):
    b = literal_box(3, 4, 13, 10)
    back = bx.from_center(*bx.to_center(b))
    assert [value(spark, c) for c in back] == [3, 4, 13, 10]
    back = bx.from_top_left(*bx.to_top_left(b))
    assert [value(spark, c) for c in back] == [3, 4, 13, 10]
    shares = bx.to_normalised(b, F.lit(100.0), F.lit(50.0))
    back = bx.from_normalised(*shares, F.lit(100.0), F.lit(50.0))
    assert [value(spark, c) for c in back] == pytest.approx([3, 4, 13, 10])


def test_rotated_box_similarity_with_itself(spark):
    r = bx.RotatedBox(*[F.lit(float(v)) for v in (5, 6, 8, 3, 0.4)])
    assert value(spark, bx.gaussian_similarity(r, r)) == pytest.approx(1, abs=2e-3)
    assert len(value(spark, bx.rotated_corners(r))) == 4


def test_keypoint_similarity_counts_visible_points(spark):
    points = lambda v: F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y"), F.lit(s).alias("v")) for x, y, s in v])
    same = value(spark, bx.keypoint_similarity(points([(1, 1, 1), (5, 5, 0)]), points([(1, 1, 1), (90, 90, 1)]), F.lit(100.0), [0.1, 0.1]))
    assert same == pytest.approx(1, abs=1e-6)


def test_polygon_containment_on_and_off_the_outline(spark):
    square = [(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0)]
    inside = lambda x, y, edge: value(spark, polygons.contains(F.lit(float(x)), F.lit(float(y)), square, edge))
    assert inside(5, 5, False) and inside(5, 5, True)
    assert not inside(10, 5, False) and inside(10, 5, True)
    assert not inside(11, 5, True)
    assert value(spark, polygons.area(polygons.literal(square))) == 100


def test_strings(spark):
    assert value(spark, label_path(F.lit("/a/images/b/images/c.d.jpg"))) == "/a/images/b/labels/c.d.txt"
    for v in (0.0, 1.5, 0.123456789, 123456.7, 0.00001234, -2.0, 1234567.0):
        assert value(spark, six_digits(F.lit(v))) == f"{v:g}"
    assert value(spark, joint_angle(*[F.lit(float(v)) for v in (1, 0, 0, 0, 0, 1)])) == pytest.approx(90)


def test_matching_is_not_greedy(spark):
    dets, truth = frames_of(spark, [(1, "a", 0, 0.9, 0, 0, 10, 10.0), (1, "a", 1, 0.8, 0, 0, 10, 9.0)], [(1, "a", 0, 0, 0, 10, 10.0), (1, "a", 1, 0, 0, 10, 5.5)])
    assert [(r.det, r.gt) for r in matching.match_at_thresholds(dets, truth, [0.5]).collect()] == [(0, 0)]


def test_matching_and_confusion_break_ties_differently(spark):
    dets, truth = frames_of(spark, [(1, "a", 0, 0.9, 0, 0, 10, 6.5), (1, "a", 1, 0.8, 0, 0, 10, 9.0)], [(1, "a", 0, 0, 0, 10, 10.0)])
    assert [r.det for r in matching.match_at_thresholds(dets, truth, [0.5]).collect()] == [0]
    assert [r.det for r in matching.match_any_class(dets, truth).collect()] == [1]


def brute_matches(dets, truth, t):
    out = []
    for image in {d[0] for d in dets}:
        best = {}
        for d in (d for d in dets if d[0] == image):
            options = sorted((-iou(d[4:], g[3:]), g[2], g) for g in truth if g[0] == image and g[1] == d[1] and iou(d[4:], g[3:]) >= t)
            if options:
                best[d[2]] = options[0][1]
        taken = set()
        for det in sorted(best):
            if best[det] not in taken:
                taken.add(best[det])
                out.append((image, det, best[det]))
    return sorted(out)


@pytest.mark.parametrize("seed", range(3))
def test_matches_against_brute_force(spark, seed):
    dets, truth = random_scene(seed)
    found = matching.match_at_thresholds(*frames_of(spark, dets, truth), [0.3, 0.6]).collect()
    for t in (0.3, 0.6):
        assert sorted((r.image, r.det, r.gt) for r in found if r.threshold == t) == brute_matches(dets, truth, t)


def numpy_ap(flags, n):
    """Average precision from hit flags in order of confidence, by interpolation on 101 recalls."""
    hits = np.cumsum(flags)
    recall, precision = hits / n, hits / (np.arange(len(flags)) + 1)
    r = np.concatenate(([0.0], recall, [recall[-1] if len(recall) else 1.0, 1.0]))
    p = np.concatenate(([1.0], precision, [0.0, 0.0]))
    p = np.flip(np.maximum.accumulate(np.flip(p)))
    x = np.linspace(0, 1, 101)
    y = np.interp(x, r, p)
    return float(((y[1:] + y[:-1]) / 2 * np.diff(x)).sum())


@pytest.mark.parametrize("seed", range(3))
def test_average_precision_against_numpy(spark, seed):
    dets, truth = random_scene(seed + 20, images=20)
    d, g = frames_of(spark, dets, truth)
    got = {(r.cls, r.threshold): r.ap for r in curves.average_precision(d, g, matching.match_at_thresholds(d, g, [0.3, 0.5]), [0.3, 0.5]).collect()}
    for t in (0.3, 0.5):
        hits = {(i, det) for i, det, _ in brute_matches(dets, truth, t)}
        for cls in "ab":
            rows = sorted((x for x in dets if x[1] == cls), key=lambda x: (-x[3], x[0], x[2]))
            assert got[cls, t] == pytest.approx(numpy_ap([(x[0], x[2]) in hits for x in rows], sum(x[1] == cls for x in truth)), abs=1e-9)


def test_best_f1_against_numpy(spark):
    dets, truth = random_scene(50, images=25)
    d, g = frames_of(spark, dets, truth)
    got = {r.cls: r for r in curves.best_f1(curves.confidence_curves(d, g, matching.match_at_thresholds(d, g, [0.5]))).collect()}
    hits = {(i, det) for i, det, _ in brute_matches(dets, truth, 0.5)}
    x = np.linspace(0, 1, 1000)
    p, r = {}, {}
    for cls in "ab":
        rows = sorted((v for v in dets if v[1] == cls), key=lambda v: (-v[3], v[0], v[2]))
        conf, flags = np.array([v[3] for v in rows]), np.cumsum([(v[0], v[2]) in hits for v in rows])
        last = np.r_[conf[1:] != conf[:-1], True]
        recall, precision = flags / (sum(v[1] == cls for v in truth) + 1e-16), flags / (np.arange(len(flags)) + 1)
        r[cls] = np.interp(-x, -conf[last], recall[last], left=0)
        p[cls] = np.interp(-x, -conf[last], precision[last], left=1)
    f1 = {c: 2 * p[c] * r[c] / (p[c] + r[c] + 1e-16) for c in "ab"}
    mean = np.mean(list(f1.values()), axis=0)
    smooth = np.convolve(np.r_[[mean[0]] * 50, mean, [mean[-1]] * 50], np.ones(101) / 101, "valid")
    at = got["a"].point
    assert smooth[at] == pytest.approx(smooth.max(), abs=5e-3)
    for c in "ab":
        assert got[c].recall == pytest.approx(r[c][at], abs=2e-2)


def test_nms_at_the_limit(spark):
    d, _ = frames_of(spark, [(1, "a", 0, 0.9, 0, 0, 10, 10.0), (1, "a", 1, 0.8, 0, 0, 10, 5.0)], [])
    assert suppression.greedy_nms(d, 0.5).count() == 2
    assert suppression.matrix_nms(d, 0.5).count() == 1


@pytest.mark.parametrize("seed", range(3))
def test_greedy_nms_against_a_loop(spark, seed):
    dets, truth = random_scene(seed + 70, images=10, boxes=20)
    d, _ = frames_of(spark, dets, truth)
    want = []
    for image in {x[0] for x in dets}:
        for cls in "ab":
            kept = []
            for x in sorted((x for x in dets if x[:2] == (image, cls)), key=lambda x: (-x[3], x[2])):
                if all(iou(k[4:], x[4:], 0) <= 0.4 for k in kept):
                    kept.append(x)
            want += [(image, cls, x[2]) for x in kept]
    assert sorted((r.image, r.cls, r.det) for r in suppression.greedy_nms(d, 0.4).collect()) == sorted(want)


def test_decoded_filter_keeps_order_of_steps(spark):
    conf = {"A": [(0.9, "5"), (0.8, "0"), (0.7, "0"), (0.6, "0")], "B": [(0.9, "0"), (0.8, "5"), (0.7, "5"), (0.6, "0")]}
    rows = [(i, c, n, v, 0.0, 0.0, 1.0, 1.0) for i, name in enumerate("AB") for n, (v, c) in enumerate(conf[name])]
    d = spark.createDataFrame(rows, f"image long, cls string, det long, conf double, {BOX}")
    assert sorted((r.image, r.det) for r in suppression.filter_decoded(d, 0.25, ["0"], 2).collect()) == [(0, 1), (0, 2), (1, 0), (1, 3)]
    assert sorted(r.conf for r in suppression.filter_decoded(d.where("image = 0"), 0.25, None, 2).collect()) == [0.8, 0.9]


def test_empty_image_scores_one(spark):
    d, g = frames_of(spark, [(1, "a", 0, 0.9, 0, 0, 10, 10.0)], [(1, "a", 0, 0, 0, 10, 10.0)])
    rows = curves.image_scores(d, g, matching.match_at_thresholds(d, g, [0.5]), 0.5).collect()
    assert [(r.tp, r.fp, r.fn, r.f1) for r in rows] == [(1, 0, 0, 1.0)]


def test_allocation(spark):
    strata = spark.createDataFrame([("a", 90), ("b", 9), ("c", 1)], "signature string, n long")
    assert {r.signature: r["take"] for r in etl.allocate(strata, 10).collect()} == {"a": 8, "b": 1, "c": 1}


@pytest.mark.parametrize("seed", range(6))
def test_allocation_against_rounds(spark, seed):
    rng = random.Random(seed)
    counts = {s: rng.randint(1, 60) for s in "abcdefgh"}
    total = rng.randint(8, sum(counts.values()))
    take = {s: min(max(1, round(n * total / sum(counts.values()))), n) for s, n in counts.items()}
    order, i = sorted(counts, key=lambda s: (-counts[s], s)), 0
    while (left := total - sum(take.values())) != 0:
        s = order[i % len(order)]
        take[s] += 1 if left > 0 and take[s] < counts[s] else -1 if left < 0 and take[s] > 1 else 0
        i += 1
    strata = spark.createDataFrame(list(counts.items()), "signature string, n long")
    assert {r.signature: r["take"] for r in etl.allocate(strata, total).collect()} == take


def test_evenly_spaced(spark):
    rows = spark.range(8)
    assert sorted(r.id for r in etl.evenly_spaced(rows, ["id"], 2).collect()) == [0, 7]
    assert sorted(r.id for r in etl.evenly_spaced(rows, ["id"], 1).collect()) == [0]
    for n, count in ((17, 5), (100, 33), (9, 9), (5, 9)):
        got = sorted(r.id for r in etl.evenly_spaced(spark.range(n), ["id"], count).collect())
        c = min(count, n)
        assert got == [math.trunc(i * (n - 1) / (c - 1)) for i in range(c)]


def test_dense_numbers_of_text(spark):
    words = [(w,) for w in "pear apple fig kiwi fig2 zoo éclair apple pie".split()] + [(None,)]
    rows = spark.createDataFrame([(w, i) for i, (w,) in enumerate(words)], "w string, i int")
    got = sorted((r.n, r.w, r.i) for r in etl.dense_numbers(rows, ["w", "i"], "n", 5).collect())
    assert [g[0] for g in got] == list(range(5, 5 + len(words)))
    assert [g[1] for g in got] == [None, *sorted(w for (w,) in words if w)]


def test_score_bands(spark):
    rows = spark.createDataFrame([(0, 0.9, 5.0, 5.0), (1, 0.9, 5.0, 0.0), (2, 0.15, 5.0, 5.0), (3, 0.15, 5.0, -1.0), (4, 0.9, -1.0, 5.0)], "i int, c double, w double, h double")
    bands = {r.i: r.b for r in rows.select("i", etl.score_band(F.col("c"), F.col("w"), F.col("h")).alias("b")).collect()}
    assert bands == {0: "high", 1: None, 2: "low", 3: None, 4: None}


def test_require_empty(spark):
    etl.require_empty(spark.range(0), "nothing")
    with pytest.raises(ValueError, match="orphans"):
        etl.require_empty(spark.range(1), "orphans")


def test_batches_go_to_ranks_in_order(spark):
    rows = spark.range(10).select("id", etl.rank_of_batch(F.col("id"), 10, 2, 3).alias("r")).collect()
    assert [r.r for r in sorted(rows)] == [0, 0, 0, 0, 1, 1, 1, 1, 2, 2]


POINTS = "stream long, track long, frame long, cx double, cy double, cls string"
SQUARE = [(220.0, 140.0), (420.0, 140.0), (420.0, 340.0), (220.0, 340.0)]


def steps(spark, places):
    return spark.createDataFrame([(0, 1, i, float(x), float(y), "a") for i, (x, y) in enumerate(places)], POINTS)


@pytest.mark.parametrize("step,want", [((8, 0), "IN"), ((-8, 0), "OUT"), ((0, 8), "IN"), ((0, -8), "OUT")])
def test_polygon_direction(spark, step, want):
    places = [(320 - step[0] * 20 * (5 - k), 240 - step[1] * 20 * (5 - k)) for k in range(6)]
    assert [r.direction for r in trajectories.polygon_entries(steps(spark, places), SQUARE).collect()] == [want]


def test_polygon_reversal_and_reentry(spark):
    reversal = [(x, 240) for x in (428, 436, 444, 436, 428, 420, 412)]
    assert [r.direction for r in trajectories.polygon_entries(steps(spark, reversal), SQUARE).collect()] == ["OUT"]
    inside = [(230, 240), (210, 240), (230, 240)]
    assert [r.direction for r in trajectories.polygon_entries(steps(spark, inside), SQUARE).collect()] == ["IN"]


def test_speed_uses_frames_between(spark):
    rows = spark.createDataFrame([(0, 1, f, 6.0 * i + (6 if i == 4 else 0), 0.0, "a") for i, f in enumerate(range(5))], POINTS)
    assert [r.speed for r in trajectories.speeds(rows, 5, 30.0, 0.05, 120).collect()] == [40]
    gap = spark.createDataFrame([(0, 1, f, 7.5 * i, 0.0, "a") for i, f in enumerate((0, 1, 2, 3, 8))], POINTS)
    assert [r.speed for r in trajectories.speeds(gap, 5, 30.0, 0.05, 120).collect()] == [20]


def test_hysteresis(spark):
    rows = steps(spark, [(a, 0) for a in (150, 80, 150, 80)])
    last = trajectories.hysteresis_counts(rows, "cx", 145.0, 90.0).orderBy(F.desc("frame")).first()
    assert (last["count"], last["stage"]) == (2, "down")


def test_outline_counts_for_slots_only(spark):
    on_edge = steps(spark, [(420, 240)])
    assert trajectories.slot_occupancy(on_edge, [SQUARE]).first().occupied == 1
    assert trajectories.region_counts(on_edge, {"r": SQUARE}).first().n == 0
    with pytest.raises(ValueError):
        trajectories.region_counts(on_edge, {"r": SQUARE[:2]})


def test_search_cuts_to_k_before_the_threshold(spark):
    rows = spark.createDataFrame([(i, [math.cos(a), math.sin(a)]) for i, a in enumerate((0.0, 0.5, 1.4))], "vec_id long, embedding array<double>")
    assert [r.vec_id for r in search.search(rows, [1.0, 0.0], k=2, least=0.9).collect()] == [0]
    assert search.search_many(rows, rows.where("vec_id = 0").select(F.col("vec_id").alias("query"), "embedding"), k=2, least=0.1).count() == 2


def test_depth_needs_ten_pixels_and_takes_the_lower_median(spark):
    rows = [("a", 1.0, 2.0)] * 9 + [("b", float(i), 2.0 * i) for i in range(1, 11)]
    got = metrics.depth_metrics(spark.createDataFrame(rows, "image string, p double, g double"), "p", "g").collect()
    assert [(r.image, r.d1, r.rmse) for r in got] == [("b", 1.0, 0.0)]


def test_offset_choice(spark):
    rows = spark.createDataFrame([(i, 0.0, 0.5) for i in range(6) for _ in range(3)], "image long, lp double, lg double")
    assert metrics.choose_offset(rows).first().shift is True
    same = spark.createDataFrame([(i, 0.5, 0.5) for i in range(6)], "image long, lp double, lg double")
    assert metrics.choose_offset(same).first().shift is False


def test_sigma_clip(spark):
    rows = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 2, 1, 2, 100]], "v double")
    assert metrics.sigma_clip(rows, "v").agg(F.max("v")).first()[0] == 3


def test_greedy_pairs(spark):
    pairs = spark.createDataFrame([(1, 0.9, 1, 1), (1, 0.8, 1, 2), (1, 0.7, 2, 1), (1, 0.6, 2, 2)], "view int, iou double, g long, p long")
    assert sorted((r.g, r.p) for r in matching.greedy_pairs(pairs, ["view"], "iou", "g", "p").collect()) == [(1, 1), (2, 2)]


def test_mosaic_and_flip(spark):
    ann = spark.createDataFrame([("a", 0, 0.0, 0.0, 10.0, 10.0), ("b", 1, 5.0, 5.0, 20.0, 20.0)], f"image string, cls int, {BOX}")
    layout = spark.createDataFrame([("m", "a", 0.0, 0.0, 1.0), ("m", "b", 25.0, 25.0, 1.0)], "mosaic string, image string, dx double, dy double, gain double")
    got = {r.image: (r.x1, r.y1, r.x2, r.y2) for r in augment.mosaic(ann, layout, 20.0).collect()}
    assert got == {"a": (0, 0, 10, 10), "b": (30, 30, 40, 40)}
    twice = augment.flip(augment.flip(ann, F.lit(50.0)), F.lit(50.0))
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, ann.collect()))


def test_tile_merge(spark):
    rows = [("p__1__0___0", "a", 0, 0.9, 90.0, 10.0, 110.0, 30.0), ("p__1__80___0", "a", 1, 0.8, 10.0, 10.0, 30.0, 30.0)]
    d = spark.createDataFrame(rows, f"tile string, cls string, det long, conf double, {BOX}")
    assert [(r.image, r.det, r.x1) for r in suppression.merge_tiles(d).collect()] == [("p", 0, 90.0)]


def test_confusion_sums_equal_the_inputs(spark):
    dets, truth = random_scene(5)
    d, g = frames_of(spark, dets, truth)
    cells = metrics.detection_confusion(d, g).collect()
    assert sum(c.n for c in cells if c.actual != "background") == len(truth)
    assert sum(c.n for c in cells if c.predicted != "background") == sum(x[3] > 0.25 for x in dets)


def brute_allocate(sizes, total):
    """Strata dealt one by one, by falling size and then name, in rounds."""
    n = sum(sizes.values())
    take = {s: max(1, min(k, round(k * total / n))) for s, k in sizes.items()}
    order = sorted(sizes, key=lambda s: (-sizes[s], s))
    while (left := total - sum(take.values())) != 0:
        step = 1 if left > 0 else -1
        open_ = [s for s in order if (take[s] < sizes[s] if step > 0 else take[s] > 1)]
        if not open_:
            break
        for s in open_[: abs(left)]:
            take[s] += step
    return take


@pytest.mark.parametrize("total", [0, 1, 7, 30, 31, 100, 333, 5000])
def test_allocation_against_dealing_one_by_one(spark, total):
    rng = random.Random(total)
    sizes = {f"s{i}": rng.choice((1, 1, 2, 3, 9, 40)) for i in range(30)}
    rows = etl.allocate(spark.createDataFrame(list(sizes.items()), "signature string, n long"), total).collect()
    assert {r.signature: r["take"] for r in rows} == brute_allocate(sizes, total)


def test_copies_of_one_content_are_numbered_by_name(spark):
    rows = [(f"n{i:03}", "") for i in range(60)] + [("a", "x"), ("b", "x"), ("c", "only")]
    out = etl.exact_duplicates(spark.createDataFrame(rows[::-1], "name string, body string"), F.col("body"), "name").collect()
    assert {(r.name, r["copy"]) for r in out} == {(f"n{i:03}", i) for i in range(1, 60)} | {("b", 1)}


def test_numbers_of_a_composite_order(spark):
    """One value of the first column for all rows, names that share their start, nulls first."""
    rows = [(0, f"a long common start {i:04}") for i in range(300)] + [(0, None), (None, "z")]
    out = etl.dense_numbers(spark.createDataFrame(rows[::-1], "part int, name string"), ["part", "name"], "n").collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    assert {(r.part, r.name): r.n for r in out} == {r: i + 1 for i, r in enumerate(order)}


def test_search_of_many_against_all_scores(spark):
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(300, 6)).round(1)
    vectors[50:60] = vectors[40]
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    index = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)] + [(300, None), (301, [1.0])], "vec_id long, embedding array<double>")
    queries = spark.createDataFrame([(i, (vectors[i] * 3).tolist()) for i in range(0, 300, 20)] + [(999, None)], "query long, embedding array<double>")
    got = {}
    for r in search.search_many(index, queries, k=12, least=0.2).collect():
        got.setdefault(r.query, {})[r.vec_id] = r.score
    for q in range(0, 300, 20):
        scores = (vectors * vectors[q]).sum(axis=1).round(12)
        best = sorted(range(300), key=lambda i: (-scores[i], i))[:12]
        assert {k: round(v, 9) for k, v in got.pop(q).items()} == {i: pytest.approx(scores[i]) for i in best if scores[i] >= 0.2}
    assert not got
    assert search.search_many(index, queries.limit(0)).count() == 0


def test_marks_of_names(spark):
    marks = "|@#!¡·$€%&()=?¿^*;:,¨`><+"
    row = spark.createDataFrame([(f"a{marks}b´-_.~",)], "s string").select(clean_name(F.col("s")).alias("c")).first()
    assert row.c == "a" + "_" * len(marks) + "b´-_.~"


def test_orphans_have_no_parent(spark):
    child = spark.createDataFrame([(1, 10), (2, 11), (3, None)], "c long, key long")
    assert [r.c for r in etl.orphans(child, spark.createDataFrame([(10,)], "p long"), "key", "p").orderBy("c").collect()] == [2, 3]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_least_cost_pairs_against_all_permutations(spark, seed):
    rng = random.Random(seed)
    rows, want = [], {}
    for image in range(6):
        n, m = rng.randint(1, 4), rng.randint(1, 4)
        cost = [[rng.uniform(-5, 50) for _ in range(m)] for _ in range(n)]
        rows += [(image, i, j, cost[i][j]) for i in range(n) for j in range(m)]
        wide = cost if n <= m else [list(c) for c in zip(*cost)]
        want[image] = min(sum(wide[i][j] for i, j in enumerate(p)) for p in itertools.permutations(range(len(wide[0])), len(wide)))
    out = assignment.least_cost_pairs(spark.createDataFrame(rows, "image long, i long, j long, cost double"), ["image"], "i", "j", "cost").collect()
    for image, total in want.items():
        own = [r for r in out if r.image == image]
        assert sum(r.cost for r in own) == pytest.approx(total)
        assert len({r.i for r in own}) == len({r.j for r in own}) == len(own)


def test_label_mappings(spark):
    assert manifest.label_mapping(None) == {} and manifest.label_mapping({"7": " 3 ", 0: None, -1: "ignore_label"}) == {7: 3, 0: 255, -1: 255}
    with pytest.raises(TypeError):
        manifest.label_mapping([1])
    assert manifest.smoothed_targets(0.1) == (0.95, 0.05)


def test_next_free_name(spark):
    names = lambda *x: spark.createDataFrame([(v,) for v in x], "n string")
    assert manifest.next_free_name(names("other", "run2"), "n", "run") == "run"
    assert manifest.next_free_name(names("run", "run2", "run4", "runs", "run02x"), "n", "run") == "run3"
