"""Precision-recall curves and average precision.

Everything is derived from the true positives' ranks: between two of them recall stands still and precision only
falls, so the precision envelope and its interpolation need no other row. Ranks come from two-level running sums, so
a class with most of the detections is spread over tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .matching import THRESHOLDS
from .ordered import following, highest_from_here, running_sums, step_of

#: Grid of the interpolation, and of the confidence curves.
RECALL_POINTS, CONFIDENCE_POINTS = 101, 1000


def ranked_hits(dets: DataFrame, matches: DataFrame, thresholds: list[float] | None = None) -> DataFrame:
    """cls, threshold, image, det, conf, tp, rank (n_det) and running hits of every detection at every threshold."""
    levels = thresholds or THRESHOLDS
    hits = matches.select("image", "cls", "det", "threshold").groupBy("image", "cls", "det").agg(F.collect_set("threshold").alias("_hit"))
    rows = dets.select("image", "cls", "det", "conf").join(hits, ["image", "cls", "det"], "left")
    # Ranks are the same at every threshold, so one order serves them all, with a running count for each.
    tps = {f"_tp{i}": F.coalesce(F.array_contains("_hit", F.lit(float(t))), F.lit(False)).cast("int") for i, t in enumerate(levels)}
    marked = rows.withColumns({**tps, "one": F.lit(1), "_step": step_of(F.col("conf"))}).drop("_hit")
    order = [F.desc("conf"), F.col("image"), F.col("det")]
    summed = running_sums(marked, ["cls"], order, {"rank": "one", **{f"_hits{i}": f"_tp{i}" for i in range(len(levels))}})
    at = [F.struct(F.lit(float(t)).alias("threshold"), F.col(f"_tp{i}").alias("tp"), F.col(f"_hits{i}").alias("hits")) for i, t in enumerate(levels)]
    return summed.select("image", "cls", "det", "conf", "_step", "rank", F.inline(F.array(*at)))


def average_precision(dets: DataFrame, truth: DataFrame, matches: DataFrame, thresholds: list[float] | None = None) -> DataFrame:
    """cls, threshold, n_truth, ap for each class in the ground truth; classes without a hit have 0.

    The envelope is the highest precision at a recall or beyond, starting from (0, 1) and ending at 0 after the last
    recall; it is interpolated at 101 recalls and integrated by trapezoids.
    """
    levels = thresholds or THRESHOLDS
    n = truth.groupBy("cls").agg(F.count("*").alias("n_truth"))
    ranked = ranked_hits(dets, matches, levels).where("tp = 1").withColumn("precision", F.col("hits") / F.col("rank"))
    order = [F.desc("conf"), F.col("image"), F.col("det")]
    enveloped = highest_from_here(ranked, ["cls", "threshold"], order, "precision", "right").join(n, "cls")
    # The row before this hit has one hit less; if there is none at all, the curve starts at (0, 1).
    before = F.when(F.col("rank") == 1, 1.0).otherwise((F.col("hits") - 1) / F.greatest(F.col("rank") - 1, F.lit(1)))
    low, high = (F.col("hits") - 1) / F.col("n_truth"), F.col("hits") / F.col("n_truth")
    points = F.filter(F.transform(F.sequence(F.lit(0), F.lit(RECALL_POINTS - 1)), lambda i: i * 0.01), lambda x: (x >= low) & (x < high))
    left = F.greatest(before, F.col("right"))
    value = lambda x: left + (F.col("right") - left) / (high - low) * (x - low)
    weight = lambda x: F.when((x == 0.0) | (x == 1.0), 0.005).otherwise(0.01)
    summed = enveloped.withColumn("_part", F.aggregate(F.transform(points, lambda x: value(x) * weight(x)), F.lit(0.0), lambda a, v: a + v)).groupBy("cls", "threshold").agg(F.sum("_part").alias("ap"))
    every = n.withColumn("threshold", F.explode(F.array(*[F.lit(float(t)) for t in levels])))
    return every.join(summed, ["cls", "threshold"], "left").select("cls", "threshold", "n_truth", F.coalesce("ap", F.lit(0.0)).alias("ap"))


def confidence_curves(dets: DataFrame, truth: DataFrame, matches: DataFrame, threshold: float = 0.5, eps: float = 1e-16) -> DataFrame:
    """cls, point (0 to 999), precision, recall and f1 at confidence point / 999, interpolated between detections.

    Above the highest confidence recall is 0 and precision 1; below the lowest both keep their last value.
    """
    n = truth.groupBy("cls").agg(F.count("*").alias("n_truth"))
    ranked = ranked_hits(dets, matches, [threshold]).drop("threshold")
    order = [F.desc("conf"), F.col("image"), F.col("det")]
    shaped = ranked.join(n, "cls").withColumn("recall", F.col("hits") / (F.col("n_truth") + eps)).withColumn("precision", F.col("hits") / F.col("rank"))
    linked = following(shaped, ["cls"], order, ["conf", "recall", "precision"], "after")
    step = 1.0 / (CONFIDENCE_POINTS - 1)
    # Point i belongs to the last detection with at least its confidence.
    first = F.when(F.col("after").isNull(), F.lit(0)).otherwise(F.floor(F.col("after.conf") / step).cast("int") + 1)
    top = F.least(F.floor(F.col("conf") / step + 1e-9).cast("int"), F.lit(CONFIDENCE_POINTS - 1))
    spread = linked.where(first <= top).withColumn("point", F.explode(F.sequence(first, top)))
    at = F.col("point") * step
    blend = lambda c: F.when(F.col("after").isNull() | (F.col("conf") == F.col("after.conf")), F.col(c)).otherwise(F.col(c) + (F.col(f"after.{c}") - F.col(c)) * ((F.col("conf") - at) / (F.col("conf") - F.col("after.conf"))))
    found = spread.select("cls", "point", F.greatest(blend("precision"), F.lit(0.0)).alias("precision"), F.greatest(blend("recall"), F.lit(0.0)).alias("recall"))
    every = n.select("cls", F.explode(F.sequence(F.lit(0), F.lit(CONFIDENCE_POINTS - 1))).alias("point"))
    predicted = dets.select("cls").distinct().withColumn("_seen", F.lit(1.0))
    filled = every.join(found, ["cls", "point"], "left").join(predicted, "cls", "left").select("cls", "point", F.coalesce("precision", "_seen", F.lit(0.0)).alias("precision"), F.coalesce("recall", F.lit(0.0)).alias("recall"))
    return filled.withColumn("f1", 2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall") + eps))


def smooth_curve(points: DataFrame, x: str, y: str, n: int, share: float = 0.1) -> DataFrame:
    """A centred box filter over a curve of ``n`` points, with its ends held; ``n`` bounds the window's rows."""
    half = round(n * share * 2) // 2 // 2
    ends = F.when(F.col(x) == 0, half + 1).when(F.col(x) == n - 1, half + 1).otherwise(1)
    copies = points.withColumn("_k", F.explode(F.sequence(F.lit(0), ends - 1))).withColumn("_at", F.when(F.col(x) == 0, -F.col("_k")).otherwise(F.col(x) + F.col("_k")))
    span = Window.orderBy("_at").rangeBetween(-half, half)
    return copies.withColumn(f"smooth_{y}", F.avg(y).over(span)).where("_k = 0").drop("_k", "_at")


def best_f1(curves: DataFrame) -> DataFrame:
    """Precision, recall and F1 of each class at the one point where the smoothed mean F1 is highest."""
    mean = curves.groupBy("point").agg(F.avg("f1").alias("mean_f1"))
    top = smooth_curve(mean, "point", "mean_f1", CONFIDENCE_POINTS).orderBy(F.desc("smooth_mean_f1"), "point").limit(1)
    return curves.join(F.broadcast(top.select("point")), "point").select("cls", "point", "precision", "recall", "f1")


def detection_summary(ap: DataFrame, at_best: DataFrame, truth: DataFrame) -> DataFrame:
    """One row for each class: images, instances, P, R, F1, mAP50, mAP75, mAP50-95."""
    sizes = truth.groupBy("cls").agg(F.count_distinct("image").alias("images"), F.count("*").alias("instances"))
    at = lambda t: F.max(F.when(F.abs(F.col("threshold") - t) < 1e-9, F.col("ap")))
    means = ap.groupBy("cls").agg(at(0.5).alias("map50"), at(0.75).alias("map75"), F.avg("ap").alias("map"))
    return sizes.join(means, "cls").join(at_best, "cls").select("cls", "images", "instances", *[F.bround(c, 5).alias(c) for c in ("precision", "recall", "f1", "map50", "map75", "map")])


def image_scores(dets: DataFrame, truth: DataFrame, matches: DataFrame, threshold: float = 0.5) -> DataFrame:
    """tp, fp, fn, precision, recall and f1 of each image; one with neither boxes nor truth scores 1."""
    counted = lambda df, c: df.groupBy("image").agg(F.count("*").alias(c))
    tp = counted(matches.where(F.abs(F.col("threshold") - threshold) < 1e-9), "tp")
    rows = counted(dets, "n_det").join(counted(truth, "n_gt"), "image", "full").join(tp, "image", "left").na.fill(0)
    p = F.when(F.col("n_det") > 0, F.col("tp") / F.col("n_det")).otherwise(F.when(F.col("n_gt") > 0, 0.0).otherwise(1.0))
    r = F.when(F.col("n_gt") > 0, F.col("tp") / F.col("n_gt")).otherwise(F.when(F.col("n_det") > 0, 0.0).otherwise(1.0))
    scored = rows.withColumn("fp", F.col("n_det") - F.col("tp")).withColumn("fn", F.col("n_gt") - F.col("tp")).withColumn("precision", p).withColumn("recall", r)
    return scored.withColumn("f1", F.when(F.col("precision") + F.col("recall") > 0, 2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))).otherwise(0.0)).drop("n_det", "n_gt")
