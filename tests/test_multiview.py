"""Multi-view operators and polygon functions on small cases."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from framelens.functions import segments
from framelens.operators import matching, multiview
from framelens.operators.components import connected_components

CAMERA = {"K": [[100.0, 0, 50], [0, 100.0, 50], [0, 0, 1]], "pose": np.eye(4).tolist(), "size": (100, 100)}


def test_lift_and_project_are_inverse(spark):
    pixels = spark.createDataFrame([(10, 20, 500.0), (50, 50, 1000.0), (1, 1, 0.0)], "u int, v int, depth_mm double")
    rows = multiview.project(multiview.lift(pixels, CAMERA), CAMERA).collect()
    assert sorted((r.pu, r.pv, r.pz) for r in rows) == [(10, 20, 500.0), (50, 50, 1000.0)]


def test_fragments_cluster_across_views(spark):
    pixels = spark.createDataFrame([(f, u, 10, 500.0) for f, us in ((1, range(5)), (2, range(20, 25))) for u in us], "fragment int, u int, v int, depth_mm double")
    other = spark.createDataFrame([(7, u, 10, 501.0) for u in range(4)], "fragment int, u int, v int, depth_mm double")
    scores = multiview.consistency(multiview.lift(pixels, CAMERA), other, CAMERA, 5.0)
    assert [(r.fragment, r.other, r.score) for r in scores.collect()] == [(1, 7, 0.8)]
    fragments = spark.createDataFrame([(1, 5), (2, 5), (7, 4)], "fragment int, n int")
    assert {r.fragment: r.cluster for r in multiview.cluster_fragments(fragments, scores).collect()} == {1: 1, 7: 1, 2: 2}


def test_z_buffer_keeps_the_nearest(spark):
    points = spark.createDataFrame([(0.0, 0.0, 500.0, 1), (0.0, 0.0, 400.0, 2), (1.0, 0.0, 100.0, 3)], "wx double, wy double, wz double, cluster int")
    assert sorted((r.pu, r.pv, r.cluster) for r in multiview.z_buffer(points, CAMERA).collect()) == [(50, 50, 2), (51, 50, 3)]


def test_voxels_and_neighbours(spark):
    points = spark.createDataFrame([(-5.0, 0.0, 0.0), (5.0, 0.0, 0.0), (6.0, 0.0, 0.0), (55.0, 0.0, 0.0)], "wx double, wy double, wz double")
    cells = multiview.voxelize(points, 10.0)
    assert sorted({r.gx for r in cells.collect()}) == [0, 1, 6]
    assert {r.gx: r.n for r in multiview.neighbour_counts(cells).collect()} == {0: 1, 1: 1, 6: 0}


def test_peel_splits_at_depth_jumps(spark):
    rows = spark.createDataFrame([(0, u, 0, 1, 100.0 if u < 3 else 300.0) for u in range(6)], "view int, u int, v int, label int, depth_mm double")
    assert len({r.part for r in multiview.peel(rows, 10.0).collect()}) == 2


def test_components(spark):
    nodes = spark.range(12).withColumnRenamed("id", "node")
    edges = spark.createDataFrame([(i, i + 1) for i in range(6)] + [(9, 8)], "a long, b long")
    assert {r.node: r.component for r in connected_components(nodes, edges).collect()} == {**{i: 0 for i in range(7)}, 7: 7, 8: 8, 9: 8, 10: 10, 11: 11}


def test_polygon_functions(spark):
    square = [0.0, 0.0, 10.0, 0.0, 10.0, 10.0, 0.0, 10.0]
    df = spark.createDataFrame([(square,)], "p array<double>")
    row = df.select(segments.share_inside("p", F.lit(5.0), F.lit(0.0), F.lit(20.0), F.lit(20.0)).alias("s"), segments.resample(50)("p").alias("r"), segments.mask_pixels(20, 20)("p").alias("m"), segments.rotated_box("p").alias("b")).first()
    assert row.s == pytest.approx(0.5) and len(row.r) >= 80 and len(row.m) == 100
    assert (row.b.cx, row.b.cy, row.b.w, row.b.h) == pytest.approx((5, 5, 10, 10))
    outline = segments.stitch([square, [20.0, 0.0, 30.0, 0.0, 30.0, 10.0]])
    assert {tuple(p) for p in np.array(outline).reshape(-1, 2)} >= {(0, 0), (10, 0), (20, 0), (30, 10)}
    assert segments.stitch([square]) == square


def test_mask_iou(spark):
    left = spark.createDataFrame([(0, 1, p) for p in range(10)], "image int, mask int, pixel long")
    right = spark.createDataFrame([(0, 5, p) for p in range(5, 15)], "image int, mask int, pixel long")
    assert matching.mask_iou(left, right).first().iou == pytest.approx(5 / 15)
