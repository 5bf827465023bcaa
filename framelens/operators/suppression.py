"""Suppression of overlapping boxes, and top-k."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framelens.functions.boxes import Box, box, iou, overlaps

BOX = "struct<conf:double,det:long,x1:double,y1:double,x2:double,y2:double>"


def _of(s: Column) -> Box:
    return Box(s["x1"], s["y1"], s["x2"], s["y2"])


def expand_classes(predictions: DataFrame, scores: str, min_conf: float = 0.25, multi_label: bool = False, classes: list[int] | None = None) -> DataFrame:
    """Rows with a score for each class to rows with ``cls`` and ``conf``: the best class, or all above the limit."""
    ranked = F.transform(F.col(scores), lambda v, i: F.struct(v.cast("double").alias("conf"), i.alias("cls")))
    good = F.filter(ranked, lambda s: s["conf"] > min_conf)
    if not multi_label:
        best = F.aggregate(good, F.lit(None).cast("struct<conf:double,cls:int>"), lambda a, s: F.when(a.isNull() | (s["conf"] > a["conf"]), s).otherwise(a))
        good = F.when(best.isNotNull(), F.array(best))
    out = predictions.withColumn("_s", F.explode(good)).withColumn("cls", F.col("_s.cls")).withColumn("conf", F.col("_s.conf")).drop("_s", scores)
    return out.where(F.col("cls").isin(classes)) if classes is not None else out


def filter_decoded(dets: DataFrame, min_conf: float = 0.25, classes: list | None = None, max_det: int = 300) -> DataFrame:
    """Finished predictions: confidence, then classes, then the first ``max_det`` of an image by confidence."""
    kept = dets.where(F.col("conf") > min_conf)
    kept = kept.where(F.col("cls").isin(classes)) if classes is not None else kept
    return top_per_group(kept, ["image"], [F.desc("conf"), F.col("det")], max_det)


def top_per_group(df: DataFrame, keys: list[str], order: list[Column], k: int) -> DataFrame:
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("_r") <= k).drop("_r")


def greedy_nms(dets: DataFrame, limit: float = 0.45, by_class: bool = True, max_boxes: int = 30_000, max_det: int = 300) -> DataFrame:
    """The kept detections: by falling confidence, one stays if no kept box overlaps it by more than ``limit``.

    A fold over the sorted boxes of an image (and class); images with many boxes are cut to the ``max_boxes`` best
    first and to ``max_det`` after, which is what the operator is defined to do.
    """
    keys = ["image", "cls"] if by_class else ["image"]
    pool = top_per_group(dets, ["image"], [F.desc("conf"), F.col("det")], max_boxes)
    entry = F.struct((-F.col("conf")).alias("o"), F.col("det").alias("i"), F.struct(F.col("conf").cast("double").alias("conf"), F.col("det").cast("long").alias("det"), *[F.col(c).cast("double").alias(c) for c in ("x1", "y1", "x2", "y2")]).alias("b"))
    grouped = pool.groupBy(*keys).agg(F.array_sort(F.collect_list(entry)).alias("_b"))
    clear = lambda kept, s: ~F.exists(kept, lambda k: iou(_of(k), _of(s), 0.0) > limit)
    kept = F.aggregate(F.transform("_b", lambda e: e["b"]), F.array().cast(f"array<{BOX}>"), lambda acc, s: F.when(clear(acc, s), F.concat(acc, F.array(s))).otherwise(acc))
    rows = grouped.select(*keys, F.explode(kept).alias("_k")).select(*keys, "_k.*")
    return top_per_group(rows, ["image"], [F.desc("conf"), F.col("det")], max_det)


def matrix_nms(dets: DataFrame, limit: float = 0.45, by_class: bool = True) -> DataFrame:
    """Drops a box that any box of higher confidence, kept or not, overlaps by ``limit`` or more: an anti join."""
    keys = ["image", "cls"] if by_class else ["image"]
    a, b = dets.alias("a"), dets.alias("b")
    above = (F.col("b.conf") > F.col("a.conf")) | ((F.col("b.conf") == F.col("a.conf")) & (F.col("b.det") < F.col("a.det")))
    same = [F.col(f"a.{k}") == F.col(f"b.{k}") for k in keys]
    return a.join(b, [*same, above, overlaps(box("a."), box("b.")), iou(box("a."), box("b."), 0.0) >= limit], "left_anti")


def merge_tiles(tiles: DataFrame, limit: float = 0.3) -> DataFrame:
    """Detections of tiles called <image>__<size>__<x>___<y> in the image's own pixels, with matrix NMS over all."""
    parts = F.split("tile", "__", 2)
    place = lambda i: F.regexp_extract("tile", r"__(\d+)__(-?\d+)___(-?\d+)$", i).cast("double")
    moved = tiles.withColumn("image", F.get(parts, F.lit(0)))
    for c, i in (("x1", 2), ("x2", 2), ("y1", 3), ("y2", 3)):
        moved = moved.withColumn(c, F.col(c) + place(i))
    return matrix_nms(moved, limit)
