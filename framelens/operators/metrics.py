"""Confusion counts, classification, semantic and depth metrics, and small statistics."""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .matching import match_any_class, unmatched

BACKGROUND = "background"


def detection_confusion(dets: DataFrame, truth: DataFrame, min_conf: float = 0.25, min_iou: float = 0.45) -> DataFrame:
    """predicted, actual, n over matched pairs; what has no partner pairs with the background."""
    pairs = match_any_class(dets, truth, min_iou, min_conf)
    of_truth = truth.select("image", "gt", F.col("cls").cast("string").alias("actual")).join(pairs.select("image", "gt", F.col("det_cls").cast("string").alias("_p")), ["image", "gt"], "left")
    extra = unmatched(dets.where(F.col("conf") > min_conf), pairs, ["image", "det"]).select(F.col("cls").cast("string").alias("predicted"), F.lit(BACKGROUND).alias("actual"))
    cells = of_truth.select(F.coalesce("_p", F.lit(BACKGROUND)).alias("predicted"), "actual").unionByName(extra)
    return cells.groupBy("predicted", "actual").agg(F.count("*").alias("n"))


def class_confusion(rows: DataFrame, predicted: str, actual: str) -> DataFrame:
    return rows.groupBy(F.col(predicted).alias("predicted"), F.col(actual).alias("actual")).agg(F.count("*").alias("n"))


def normalise_columns(confusion: DataFrame, eps: float = 1e-9) -> DataFrame:
    """Shares of each actual class. The table has a row for each pair of classes."""
    return confusion.withColumn("share", F.col("n") / (F.sum("n").over(Window.partitionBy("actual")) + eps))


def hits_and_false(confusion: DataFrame, with_background: bool = True) -> DataFrame:
    """tp and fp of each predicted class."""
    rows = confusion.where(F.col("predicted") != BACKGROUND) if with_background else confusion
    same = F.col("predicted") == F.col("actual")
    return rows.groupBy(F.col("predicted").alias("cls")).agg(F.sum(F.when(same, F.col("n")).otherwise(0)).alias("tp"), F.sum(F.when(same, 0).otherwise(F.col("n"))).alias("fp"))


def unique_names(names: DataFrame, clean: Column) -> DataFrame:
    """Clean names; those equal but for case get _2, _3, ... in order of class."""
    same = Window.partitionBy(F.lower("clean")).orderBy("cls")
    ranked = names.withColumn("clean", clean).withColumn("_r", F.row_number().over(same))
    return ranked.withColumn("clean", F.when(F.col("_r") > 1, F.concat_ws("_", "clean", F.col("_r").cast("string"))).otherwise(F.col("clean"))).drop("_r")


def topk_accuracy(rows: DataFrame, target: str, ranked: str, k: int = 5) -> DataFrame:
    """One row: top1 and topk, the shares of rows whose target is first or among the first k of the ranked classes."""
    first = (F.get(ranked, F.lit(0)) == F.col(target)).cast("double")
    among = F.array_contains(F.slice(ranked, 1, k), F.col(target)).cast("double")
    return rows.agg(F.avg(first).alias("top1"), F.avg(among).alias(f"top{k}"))


def semantic_iou(pixels: DataFrame, predicted: str, actual: str, n_classes: int, ignore: int = 255) -> DataFrame:
    """cls, iou and whether the class is present in the ground truth; out-of-range labels don't count."""
    valid = pixels.where(F.col(actual).between(0, n_classes - 1) & (F.col(actual) != ignore) & F.col(predicted).between(0, n_classes - 1))
    counts = class_confusion(valid, predicted, actual)
    rows = counts.groupBy(F.col("predicted").alias("cls")).agg(F.sum("n").alias("row"))
    columns = counts.groupBy(F.col("actual").alias("cls")).agg(F.sum("n").alias("col"), F.sum(F.when(F.col("predicted") == F.col("actual"), F.col("n")).otherwise(0)).alias("hit"))
    joined = rows.join(columns, "cls", "full").na.fill(0)
    return joined.select("cls", (F.col("hit") / (F.col("row") + F.col("col") - F.col("hit"))).alias("iou"), (F.col("col") > 0).alias("present"), "hit", "col")


def semantic_summary(ious: DataFrame, eps: float = 1e-10) -> DataFrame:
    """Mean IoU over the classes present, and pixel accuracy."""
    return ious.agg(F.avg(F.when(F.col("present"), F.col("iou"))).alias("miou"), (F.sum("hit") / (F.sum("col") + eps)).alias("pixel_accuracy"))


def lower_median(c: str) -> Column:
    """The lower of two middle values."""
    return F.expr(f"percentile_disc(0.5) WITHIN GROUP (ORDER BY {c})")


def depth_metrics(pixels: DataFrame, predicted: str, actual: str, low: float = 1e-3, high: float = 80.0, least: int = 10, align: bool = True) -> DataFrame:
    """Metrics of each image with at least ``least`` valid pixels: image, n, d1, d2, d3, abs_rel, rmse, silog.

    Predictions are scaled by the ratio of lower medians and clamped to the range. The tables of ratios are joined by
    image, so an image's pixels meet only in aggregates.
    """
    valid = pixels.where((F.col(actual) > low) & (F.col(actual) < high) & (F.col(predicted) > 0))
    sizes = valid.groupBy("image").agg(F.count("*").alias("n"), (lower_median(actual) / lower_median(predicted)).alias("ratio")).where(F.col("n") >= least)
    scaled = valid.join(sizes, "image").withColumn("_p", F.least(F.greatest(F.col(predicted) * (F.col("ratio") if align else F.lit(1.0)), F.lit(low)), F.lit(high))).withColumn("_g", F.col(actual))
    worse = F.greatest(F.col("_p") / F.col("_g"), F.col("_g") / F.col("_p"))
    gap, logs = F.col("_p") - F.col("_g"), F.ln("_p") - F.ln("_g")
    share = lambda power: F.avg((worse < 1.25**power).cast("double"))
    return scaled.groupBy("image").agg(
        F.count("*").alias("n"), share(1).alias("d1"), share(2).alias("d2"), share(3).alias("d3"), F.avg(F.abs(gap) / F.col("_g")).alias("abs_rel"),
        F.sqrt(F.avg(gap * gap)).alias("rmse"), F.sqrt(F.greatest(F.lit(0.0), F.avg(logs * logs) - F.avg(logs) * F.avg(logs))).alias("silog"),
    )


def depth_summary(per_image: DataFrame) -> DataFrame:
    return per_image.agg(F.count("*").alias("images"), *[F.avg(c).alias(c) for c in ("d1", "d2", "d3", "abs_rel", "rmse", "silog")])


def choose_offset(pairs: DataFrame, folds: int = 2, margin: float = 0.0) -> DataFrame:
    """Whether shifting log predictions by their mean error beats leaving them, by cross-validation on ``image``.

    ``pairs`` has image (a running number), lp and lg. An image is in fold image mod ``folds``; its offset comes from
    the others. Returns plain, shifted (mean shares within a factor 1.25) and whether to shift.
    """
    near = log(1.25)
    rows = pairs.withColumn("fold", F.pmod("image", F.lit(folds)))
    sums = rows.groupBy("fold").agg(F.sum(F.col("lg") - F.col("lp")).alias("s"), F.count("*").alias("n"))
    # A row for each fold.
    others = sums.withColumn("offset", (F.sum("s").over(Window.partitionBy()) - F.col("s")) / (F.sum("n").over(Window.partitionBy()) - F.col("n"))).select("fold", "offset")
    scored = rows.join(F.broadcast(others), "fold").groupBy("image").agg(
        F.avg((F.abs(F.col("lp") - F.col("lg")) < near).cast("double")).alias("plain"),
        F.avg((F.abs(F.col("lp") + F.col("offset") - F.col("lg")) < near).cast("double")).alias("shifted"),
    )
    return scored.agg(F.avg("plain").alias("plain"), F.avg("shifted").alias("shifted")).withColumn("shift", F.col("shifted") > F.col("plain") + margin)


def class_weights(rows: DataFrame, cls: str, power: float = 1.0, classes: DataFrame | None = None) -> DataFrame:
    """cls, n and the weight n ** -power over its mean; classes without rows count as one."""
    counts = rows.groupBy(F.col(cls).alias("cls")).agg(F.count("*").alias("n"))
    counts = counts if classes is None else classes.select("cls").join(counts, "cls", "left").na.fill(0, ["n"])
    raw = counts.withColumn("_w", F.pow(1.0 / F.greatest(F.col("n"), F.lit(1)), F.lit(power)))
    return raw.withColumn("weight", F.col("_w") / F.avg("_w").over(Window.partitionBy())).drop("_w")


def histogram_2d(rows: DataFrame, x: Column, y: Column, x_range: tuple[float, float], y_range: tuple[float, float], bins: int = 50) -> DataFrame:
    """bx, by, n over ``bins`` equal cells each way; the upper bounds belong to the last cell, others outside don't count."""
    cell = lambda v, r: F.least(F.floor((v - r[0]) / ((r[1] - r[0]) / bins)), F.lit(bins - 1)).cast("int")
    return rows.where(x.between(*x_range) & y.between(*y_range)).groupBy(cell(x, x_range).alias("bx"), cell(y, y_range).alias("by")).agg(F.count("*").alias("n"))


def sigma_clip(rows: DataFrame, value: str, sigma: float = 2.0, rounds: int = 3, low_only: bool = False) -> DataFrame:
    """Rows within ``sigma`` population deviations of the mean, found again up to ``rounds`` times.

    Each round brings one row of two numbers to the driver; what it filters is bounded by constants.
    """
    kept, before = rows, None
    for _ in range(rounds):
        n, mean, spread = kept.agg(F.count(value), F.avg(value), F.stddev_pop(value)).first()
        if not n or n == before:
            break
        before = n
        low, high = mean - sigma * spread, mean + sigma * spread
        kept = kept.where((F.col(value) >= low) if low_only else F.col(value).between(low, high))
    return kept


def linear_fit(rows: DataFrame, x: str, y: str, keys: list[str] | None = None) -> DataFrame:
    """slope, intercept and n of a least-squares line for each group."""
    fits = [F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), F.regr_count(y, x).alias("n")]
    return rows.groupBy(*keys).agg(*fits) if keys else rows.agg(*fits)


def rising_samples(rows: DataFrame, x: str, y: str, keys: list[str]) -> DataFrame:
    """Samples whose y is above that of the sample before, in the order of x."""
    w = Window.partitionBy(*keys).orderBy(x)
    return rows.withColumn("_before", F.lag(y).over(w)).where(F.col("_before").isNull() | (F.col(y) > F.col("_before"))).drop("_before")


def best_trial(trials: DataFrame, fitness: str, has_metrics: Column, order: str) -> DataFrame:
    """The first trial with the highest fitness among those with metrics, or among all if none has."""
    return trials.orderBy(F.desc(has_metrics.cast("int")), F.desc(fitness), order).limit(1)


def running_best(trials: DataFrame, fitness: str, order: str, keys: list[str]) -> DataFrame:
    return trials.withColumn("best", F.max(fitness).over(Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)))


def stability(values: DataFrame, value: str, threshold: float, offset: float, keys: list[str]) -> DataFrame:
    """IoU of a mask cut above and below its threshold."""
    above, below = F.count_if(F.col(value) > threshold + offset), F.count_if(F.col(value) > threshold - offset)
    return values.groupBy(*keys).agg((above / F.nullif(below, F.lit(0))).alias("stability"))
