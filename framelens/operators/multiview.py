"""Multi-view fusion over pixel tables: lifting, reprojection, voxels and fragment clustering.

A pixel row has view, u, v, depth_mm and a fragment; a camera has a 3 x 3 matrix K and a 4 x 4 camera-to-world pose.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .components import connected_components

Camera = dict  # {"K": 3 x 3, "pose": 4 x 4, "size": (width, height)}


def _linear(row, x: Column, y: Column, z: Column) -> Column:
    return x * float(row[0]) + y * float(row[1]) + z * float(row[2]) + (float(row[3]) if len(row) > 3 else 0.0)


def lift(pixels: DataFrame, camera: Camera) -> DataFrame:
    """Adds world coordinates wx, wy, wz of pixels with depth."""
    inverse = np.linalg.inv(np.array(camera["K"], float))
    u, v, one = F.col("u").cast("double"), F.col("v").cast("double"), F.lit(1.0)
    ray = [_linear(inverse[i], u, v, one) * F.col("depth_mm") for i in range(3)]
    pose = np.array(camera["pose"], float)
    return pixels.where("depth_mm > 0").withColumns({c: _linear(pose[i], *ray) for i, c in enumerate(("wx", "wy", "wz"))})


def project(points: DataFrame, camera: Camera) -> DataFrame:
    """Adds pu, pv (rounded half to even) and pz of world points in front of a camera and inside its image."""
    back = np.linalg.inv(np.array(camera["pose"], float))
    x, y, z = (_linear(back[i], F.col("wx"), F.col("wy"), F.col("wz")) for i in range(3))
    k = np.array(camera["K"], float)
    seen = points.withColumns({"_x": x, "_y": y, "pz": z}).where("pz > 0")
    w = _linear(k[2], F.col("_x"), F.col("_y"), F.col("pz"))
    placed = seen.withColumn("pu", F.rint(_linear(k[0], F.col("_x"), F.col("_y"), F.col("pz")) / w).cast("int")).withColumn("pv", F.rint(_linear(k[1], F.col("_x"), F.col("_y"), F.col("pz")) / w).cast("int"))
    width, height = camera["size"]
    return placed.where(F.col("pu").between(0, width - 1) & F.col("pv").between(0, height - 1)).drop("_x", "_y")


def consistency(points: DataFrame, target: DataFrame, camera: Camera, tolerance_mm: float) -> DataFrame:
    """fragment, other, score: the share of a fragment's points that land on another's pixels at a like depth.

    ``points`` has fragment and world coordinates; ``target`` fragment, u, v and depth_mm of the camera's view.
    """
    sizes = points.groupBy("fragment").agg(F.count("*").alias("_n"))
    landed = project(points, camera).select("fragment", "pu", "pv", "pz")
    hit = landed.join(target.select(F.col("fragment").alias("other"), F.col("u").alias("pu"), F.col("v").alias("pv"), "depth_mm"), ["pu", "pv"]).where(F.abs(F.col("pz") - F.col("depth_mm")) < tolerance_mm)
    return hit.groupBy("fragment", "other").agg(F.count("*").alias("_h")).join(sizes, "fragment").select("fragment", "other", (F.col("_h") / F.col("_n")).alias("score"))


def cluster_fragments(fragments: DataFrame, scores: DataFrame, least: float = 0.3, min_points: int = 1) -> DataFrame:
    """fragment, cluster: components of pairs whose score in either direction reaches ``least``; small ones go.

    ``fragments`` has fragment and n. Clusters are numbered from 1 in order of their smallest fragment.
    """
    edges = scores.where(F.col("score") >= least).select(F.col("fragment").alias("a"), F.col("other").alias("b"))
    found = connected_components(fragments.select(F.col("fragment").alias("node")), edges).withColumnRenamed("node", "fragment")
    sized = found.join(fragments, "fragment").groupBy("component").agg(F.sum("n").alias("_n")).where(F.col("_n") >= min_points)
    # A row for each cluster.
    numbered = sized.withColumn("cluster", F.row_number().over(Window.orderBy("component")))
    return found.join(numbered, "component").select("fragment", "cluster")


def z_buffer(points: DataFrame, camera: Camera, min_pixels: int = 1) -> DataFrame:
    """pu, pv, cluster: at each pixel the nearest point's cluster (ties to the smaller); clusters with few pixels go."""
    nearest = project(points, camera).groupBy("pu", "pv").agg(F.min(F.struct("pz", "cluster")).alias("_m")).select("pu", "pv", F.col("_m.cluster").alias("cluster"))
    big = nearest.groupBy("cluster").agg(F.count("*").alias("n")).where(F.col("n") >= min_pixels)
    return nearest.join(big.select("cluster"), "cluster", "left_semi").select("pu", "pv", "cluster")


def voxelize(points: DataFrame, size_mm: float) -> DataFrame:
    """Adds grid cells gx, gy, gz from zero."""
    cells = points.withColumns({g: F.floor(F.col(w) / size_mm) for g, w in (("gx", "wx"), ("gy", "wy"), ("gz", "wz"))})
    low = cells.agg(*[F.min(g) for g in ("gx", "gy", "gz")]).first()
    return cells.withColumns({g: F.col(g) - (low[i] or 0) for i, g in enumerate(("gx", "gy", "gz"))})


def neighbour_counts(cells: DataFrame) -> DataFrame:
    """gx, gy, gz, n: how many of a cell's 26 neighbours are taken. Each cell tells its neighbours of itself."""
    taken = cells.select("gx", "gy", "gz").distinct()
    steps = F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y"), F.lit(z).alias("z")) for x in (-1, 0, 1) for y in (-1, 0, 1) for z in (-1, 0, 1) if (x, y, z) != (0, 0, 0)])
    told = taken.withColumn("_s", F.explode(steps)).select((F.col("gx") + F.col("_s.x")).alias("gx"), (F.col("gy") + F.col("_s.y")).alias("gy"), (F.col("gz") + F.col("_s.z")).alias("gz"))
    counts = told.groupBy("gx", "gy", "gz").agg(F.count("*").alias("n"))
    return taken.join(counts, ["gx", "gy", "gz"], "left").na.fill(0, ["n"])


def peel(pixels: DataFrame, max_step_mm: float, min_pixels: int = 1) -> DataFrame:
    """view, u, v, part: pixels of a label that touch (four ways) without a jump in depth; small parts go."""
    at = F.concat_ws(":", "view", F.lpad(F.col("v").cast("string"), 6, "0"), F.lpad(F.col("u").cast("string"), 6, "0"))
    rows = pixels.withColumn("node", at)
    pairs = []
    for dx, dy in ((1, 0), (0, 1)):
        moved = rows.select("view", "label", (F.col("u") - dx).alias("u"), (F.col("v") - dy).alias("v"), F.col("node").alias("b"), F.col("depth_mm").alias("_d"))
        pairs.append(rows.join(moved, ["view", "label", "u", "v"]).where(F.abs(F.col("depth_mm") - F.col("_d")) <= max_step_mm).select(F.col("node").alias("a"), "b"))
    parts = connected_components(rows.select("node"), pairs[0].union(pairs[1]))
    big = parts.groupBy("component").agg(F.count("*").alias("n")).where(F.col("n") >= min_pixels)
    return rows.join(parts.join(big.select("component"), "component", "left_semi"), "node").select("view", "u", "v", "label", F.col("component").alias("part"))
