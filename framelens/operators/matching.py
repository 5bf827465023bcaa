"""Matching of detections and ground truth, image by image.

Detections have ``image, cls, det, conf, x1, y1, x2, y2``; ground truth ``image, cls, gt, x1, y1, x2, y2``. Both are
joined on the image, so a pair never leaves its image and the windows that follow reuse the join's partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from framelens.functions.boxes import Box, box, iou, overlaps

THRESHOLDS = [0.5 + 0.05 * i for i in range(10)]


def box_pairs(dets: DataFrame, truth: DataFrame, same_class: bool = True, keys: tuple[str, ...] = ("image",), eps: float = 1e-7) -> DataFrame:
    """All overlapping (det, gt) pairs of an image with their IoU."""
    on = [*keys, "cls"] if same_class else list(keys)
    left = dets.select(*on, "det", "conf", *([] if same_class else [F.col("cls").alias("det_cls")]), F.struct("x1", "y1", "x2", "y2").alias("_d"))
    right = truth.select(*on, "gt", *([] if same_class else [F.col("cls").alias("gt_cls")]), F.struct("x1", "y1", "x2", "y2").alias("_g"))
    d, g = (Box(*[F.col(f"{s}.{c}") for c in ("x1", "y1", "x2", "y2")]) for s in ("_d", "_g"))
    return left.join(right, on).where(overlaps(d, g)).withColumn("iou", iou(d, g, eps)).drop("_d", "_g")


def match_at_thresholds(dets: DataFrame, truth: DataFrame, thresholds: list[float] | None = None) -> DataFrame:
    """One-to-one matches for each IoU threshold: image, cls, threshold, det, gt, iou.

    In two passes: each detection keeps its best ground truth of its class, then each ground truth the detection that
    comes first. A detection whose best ground truth goes to another gets none.
    """
    return match_pairs(box_pairs(dets, truth), thresholds)


def match_pairs(pairs: DataFrame, thresholds: list[float] | None = None) -> DataFrame:
    """The same from pairs (image, cls, det, gt, iou) of any likeness: of masks, keypoints or rotated boxes."""
    levels = F.array(*[F.lit(float(t)) for t in thresholds or THRESHOLDS])
    at = pairs.withColumn("threshold", F.explode(F.filter(levels, lambda t: F.col("iou") >= t)))
    # Both windows contain the join keys, so rows stay where the join put them.
    best = Window.partitionBy("image", "cls", "threshold", "det").orderBy(F.desc("iou"), "gt")
    first = Window.partitionBy("image", "cls", "threshold", "gt").orderBy("det")
    once = at.withColumn("_r", F.row_number().over(best)).where("_r = 1")
    return once.withColumn("_r", F.row_number().over(first)).where("_r = 1").select("image", "cls", "threshold", "det", "gt", "iou")


def match_any_class(dets: DataFrame, truth: DataFrame, min_iou: float = 0.45, min_conf: float = 0.25) -> DataFrame:
    """Matches without regard to class, for the confusion matrix: image, det, gt, det_cls, gt_cls, iou.

    Both limits are strict. Each detection keeps its best ground truth, then each ground truth its best detection.
    """
    pairs = box_pairs(dets.where(F.col("conf") > min_conf), truth, same_class=False).where(F.col("iou") > min_iou)
    best = Window.partitionBy("image", "det").orderBy(F.desc("iou"), "gt")
    won = Window.partitionBy("image", "gt").orderBy(F.desc("iou"), "det")
    once = pairs.withColumn("_r", F.row_number().over(best)).where("_r = 1")
    return once.withColumn("_r", F.row_number().over(won)).where("_r = 1").drop("_r", "conf")


def mask_iou(left: DataFrame, right: DataFrame, eps: float = 1e-7) -> DataFrame:
    """IoU of all overlapping masks given as pixels: (image, mask, pixel) on both sides."""
    shared = left.withColumnRenamed("mask", "left_mask").join(right.withColumnRenamed("mask", "right_mask"), ["image", "pixel"]).groupBy("image", "left_mask", "right_mask").agg(F.count("*").alias("shared"))
    own = lambda df, name: df.groupBy("image", F.col("mask").alias(f"{name}_mask")).agg(F.count("*").alias(f"{name}_size"))
    sized = shared.join(own(left, "left"), ["image", "left_mask"]).join(own(right, "right"), ["image", "right_mask"])
    return sized.select("image", "left_mask", "right_mask", (F.col("shared") / (F.col("left_size") + F.col("right_size") - F.col("shared") + eps)).alias("iou"))


def greedy_pairs(pairs: DataFrame, keys: list[str], score: str, left: str, right: str) -> DataFrame:
    """One-to-one pairs taken greedily by descending score, ties by larger left and then larger right.

    A fold over the sorted pairs of each group; a group is one view or frame.
    """
    order = F.reverse(F.array_sort(F.collect_list(F.struct(score, left, right))))
    kind = f"array<struct<{score}:double,{left}:long,{right}:long>>"
    rows = pairs.groupBy(*keys).agg(order.cast(kind).alias("_p"))
    free = lambda taken, p: ~F.exists(taken, lambda t: (t[left] == p[left]) | (t[right] == p[right]))
    chosen = F.aggregate("_p", F.array().cast(kind), lambda taken, p: F.when(free(taken, p), F.concat(taken, F.array(p))).otherwise(taken))
    return rows.select(*keys, F.explode(chosen).alias("_c")).select(*keys, "_c.*")


def unmatched(rows: DataFrame, matches: DataFrame, keys: list[str]) -> DataFrame:
    return rows.join(matches.select(*keys), keys, "left_anti")


def union_by_key(first: DataFrame, second: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of both, where a key is in both those of the first."""
    return first.unionByName(second.join(first.select(*keys).distinct(), keys, "left_anti"))


def rows_with_box_overlap(rows: DataFrame, others: DataFrame, limit: float, keys: tuple[str, ...] = ("image",)) -> DataFrame:
    """Rows that overlap some other row by more than ``limit``."""
    a, b = rows.alias("a"), others.alias("b")
    same = [F.col(f"a.{k}") == F.col(f"b.{k}") for k in keys]
    return a.join(b, [*same, overlaps(box("a."), box("b.")), iou(box("a."), box("b.")) > limit], "left_semi")
