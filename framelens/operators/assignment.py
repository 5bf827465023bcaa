"""Assignment of ground truth to predictions: by a task-aligned measure, or one to one at least cost."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from framelens.functions.boxes import Box, complete_iou


def task_aligned(preds: DataFrame, truth: DataFrame, k: int = 13, alpha: float = 1.0, beta: float = 6.0, eps: float = 1e-9) -> DataFrame:
    """image, anchor, gt, cls and weight of each anchor that some ground truth takes.

    ``preds`` has image, anchor, its point (ax, ay), a box and a map ``scores`` from class to score; ``truth`` image, gt,
    cls and a box. An anchor inside a box is measured by score ** alpha * overlap ** beta (complete IoU, not below zero);
    each box takes its ``k`` best, ties to the smaller anchor. An anchor that several take goes to the box it overlaps
    most. The weight is the measure, scaled so that each box's best has the box's largest overlap. All windows are
    over an image's rows, where the join put them.
    """
    left = preds.select("image", "anchor", "ax", "ay", "scores", F.struct("x1", "y1", "x2", "y2").alias("_p"))
    right = truth.select("image", "gt", "cls", F.struct("x1", "y1", "x2", "y2").alias("_g"))
    p, g = (Box(*[F.col(f"{s}.{c}") for c in ("x1", "y1", "x2", "y2")]) for s in ("_p", "_g"))
    inside = F.least(F.col("ax") - g.x1, F.col("ay") - g.y1, g.x2 - F.col("ax"), g.y2 - F.col("ay")) > eps
    pairs = left.join(right, "image").where(inside).withColumn("_overlap", F.greatest(F.lit(0.0), complete_iou(g, p)))
    measured = pairs.withColumn("_measure", F.pow(F.coalesce(F.col("scores")[F.col("cls")], F.lit(0.0)), F.lit(alpha)) * F.pow("_overlap", F.lit(beta)))
    of_anchor = Window.partitionBy("image", "anchor")
    best = Window.partitionBy("image", "gt").orderBy(F.desc("_measure"), "anchor")
    picked = measured.withColumn("_pick", F.row_number().over(best) <= k).withColumn("_picks", F.sum(F.col("_pick").cast("int")).over(of_anchor))
    most = F.row_number().over(of_anchor.orderBy(F.desc("_overlap"), "gt")) == 1
    mine = picked.withColumn("_most", most).where(F.when(F.col("_picks") > 1, F.col("_most")).otherwise(F.col("_pick")))
    of_box = Window.partitionBy("image", "gt")
    weight = F.col("_measure") * F.max("_overlap").over(of_box) / (F.max("_measure").over(of_box) + eps)
    return mine.select("image", "anchor", "gt", "cls", weight.alias("weight"))


def least_cost_pairs(costs: DataFrame, keys: list[str], left: str, right: str, cost: str) -> DataFrame:
    """One-to-one pairs of each group, as many as can be and of the least total cost: keys, left, right and cost.

    A pair that is not given, or whose cost is null, can't be taken. A group is an image's candidates and one call.
    """
    from framelens.streaming.tracker import assign

    rows = costs.where(F.col(cost).isNotNull()).select(*keys, F.col(left).cast("long").alias(left), F.col(right).cast("long").alias(right), F.col(cost).cast("double").alias(cost))
    schema = rows.schema

    def run(group: pd.DataFrame) -> pd.DataFrame:
        table = group.pivot_table(index=left, columns=right, values=cost, aggfunc="min")
        values = table.to_numpy()
        # Costs from zero, and a limit that every real pair keeps and leaving a row out never beats.
        low = np.nanmin(values)
        span = max(1.0, float(np.nanmax(values) - low)) * (min(values.shape) + 1)
        pairs = assign(np.where(np.isnan(values), np.inf, (values - low) / span), 1.0)
        first = [group[k].iloc[0] for k in keys]
        return pd.DataFrame([(*first, table.index[i], table.columns[j], values[i, j]) for i, j in pairs], columns=[*keys, left, right, cost])

    return rows.groupBy(*keys).applyInPandas(run, schema)
