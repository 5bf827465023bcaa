"""The annotation side of image augmentations, and tilings and grids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framelens.functions.boxes import Box, affine_box, box, candidate, clip, ioa, overlaps


def with_box(rows: DataFrame, b: Box) -> DataFrame:
    return rows.withColumns(dict(zip(("x1", "y1", "x2", "y2"), b)))


def flip(rows: DataFrame, width: Column | None = None, height: Column | None = None) -> DataFrame:
    """Mirrors boxes left to right (``width``) and top to bottom (``height``)."""
    b = box()
    if width is not None:
        b = Box(width - b.x2, b.y1, width - b.x1, b.y2)
    if height is not None:
        b = Box(b.x1, height - b.y2, b.x2, height - b.y1)
    return with_box(rows, b)


def shift(rows: DataFrame, dx: Column, dy: Column, gain_x: Column | float = 1.0, gain_y: Column | float = 1.0) -> DataFrame:
    b = box()
    return with_box(rows, Box(b.x1 * gain_x + dx, b.y1 * gain_y + dy, b.x2 * gain_x + dx, b.y2 * gain_y + dy))


def clip_to(rows: DataFrame, width: Column, height: Column, drop_empty: bool = True) -> DataFrame:
    out = with_box(rows, clip(box(), width, height))
    return out.where((F.col("x2") > F.col("x1")) & (F.col("y2") > F.col("y1"))) if drop_empty else out


def affine(rows: DataFrame, matrix: list[list[float]], width: float, height: float, scale: float = 1.0, min_area: float = 0.1) -> DataFrame:
    """Boxes under a 3 x 3 matrix, clipped, less those that are no longer worth keeping."""
    old, new = box(), clip(affine_box(box(), matrix), F.lit(width), F.lit(height))
    scaled = Box(*[c * scale for c in old])
    kept = rows.withColumn("_ok", candidate(scaled, new, min_area=min_area)).withColumns(dict(zip(("_x1", "_y1", "_x2", "_y2"), new))).where("_ok")
    return kept.withColumns({c: F.col(f"_{c}") for c in ("x1", "y1", "x2", "y2")}).drop("_ok", "_x1", "_y1", "_x2", "_y2")


def mosaic(annotations: DataFrame, layout: DataFrame, size: float) -> DataFrame:
    """Annotations of several images in one: ``layout`` has mosaic, image, dx, dy, gain. Clipped to the mosaic."""
    placed = annotations.join(layout, "image")
    moved = shift(placed, F.col("dx"), F.col("dy"), F.col("gain"), F.col("gain"))
    return clip_to(moved, F.lit(2.0 * size), F.lit(2.0 * size)).drop("dx", "dy", "gain")


def mix_up(annotations: DataFrame, pairs: DataFrame) -> DataFrame:
    """Annotations of both images of each pair (mixed, image, other)."""
    each = pairs.select("mixed", F.explode(F.array("image", "other")).alias("image"))
    return annotations.join(each, "image")


def cut_mix(annotations: DataFrame, pastes: DataFrame, min_shown: float = 0.1) -> DataFrame:
    """Pastes a rectangle (image, donor, rx1, ry1, rx2, ry2) of a donor: its boxes that show enough, clipped to it.

    Boxes of the image stay unless the rectangle covers them almost wholly.
    """
    area = Box(*[F.col(c).cast("double") for c in ("rx1", "ry1", "rx2", "ry2")])
    own = annotations.join(pastes.select("image", "rx1", "ry1", "rx2", "ry2"), "image").where(ioa(area, box()) < 1 - min_shown)
    given = annotations.withColumnRenamed("image", "donor").join(pastes, "donor").where(overlaps(area, box()) & (ioa(area, box()) >= min_shown))
    cut = with_box(given, Box(F.greatest("x1", area.x1), F.greatest("y1", area.y1), F.least("x2", area.x2), F.least("y2", area.y2)))
    columns = annotations.columns
    return own.select(*columns).unionByName(cut.select(*columns))


def paste_candidates(candidates: DataFrame, existing: DataFrame, share: float, limit: float = 0.3) -> DataFrame:
    """Of candidates that no existing box of the image covers by ``limit``, the least covered share."""
    pairs = candidates.select("image", "candidate", F.struct("x1", "y1", "x2", "y2").alias("_c")).join(existing.select("image", F.struct("x1", "y1", "x2", "y2").alias("_e")), "image", "left")
    c, e = (Box(*[F.col(f"{s}.{n}") for n in ("x1", "y1", "x2", "y2")]) for s in ("_c", "_e"))
    worst = pairs.groupBy("image", "candidate").agg(F.coalesce(F.max(ioa(e, c)), F.lit(0.0)).alias("covered")).where(F.col("covered") < limit)
    ranked = worst.withColumn("_r", F.row_number().over(Window.partitionBy("image").orderBy("covered", "candidate"))).withColumn("_n", F.count("*").over(Window.partitionBy("image")))
    return ranked.where(F.col("_r") <= F.bround(F.col("_n") * share)).drop("_r", "_n")


def tiles(images: DataFrame, size: int = 1024, gap: int = 200, width: str = "width", height: str = "height", min_share: float = 0.6) -> DataFrame:
    """tx1, ty1, tx2, ty2 for each tile: steps of size - gap, the last flush with the edge; those that lie on the image
    by more than ``min_share``, or else the best."""
    step = size - gap

    def starts(length: Column) -> Column:
        n = F.when(length <= size, 1).otherwise(F.ceil((length - size) / step) + 1)
        raw = F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: i * step)
        return F.transform(raw, lambda x: F.when((x > 0) & (x + size > length), length - size).otherwise(x))

    out = images.withColumn("tx1", F.explode(F.array_distinct(starts(F.col(width).cast("long"))))).withColumn("ty1", F.explode(F.array_distinct(starts(F.col(height).cast("long")))))
    out = out.withColumn("tx2", F.col("tx1") + size).withColumn("ty2", F.col("ty1") + size)
    shown = (F.least("tx2", width) - F.col("tx1")) * (F.least("ty2", height) - F.col("ty1")) / float(size * size)
    best = F.max("_shown").over(Window.partitionBy(*images.columns))
    rated = out.withColumn("_shown", shown).withColumn("_best", best)
    return rated.where((F.col("_shown") > min_share) | ((F.col("_best") <= min_share) & (F.col("_shown") == F.col("_best")))).drop("_shown", "_best")


def point_grid(n: int) -> list[tuple[float, float]]:
    """n x n points in the middle of equal cells of the unit square."""
    places = [(i + 0.5) / n for i in range(n)]
    return [(x, y) for y in places for x in places]


def anchor_points(levels: DataFrame, offset: float = 0.5) -> DataFrame:
    """Anchors of feature maps (level, rows, cols, stride): ax, ay."""
    ys = levels.withColumn("_y", F.explode(F.sequence(F.lit(0), F.col("rows") - 1)))
    return ys.withColumn("_x", F.explode(F.sequence(F.lit(0), F.col("cols") - 1))).withColumn("ax", F.col("_x") + offset).withColumn("ay", F.col("_y") + offset).drop("_x", "_y")


def batch_rows(annotations: DataFrame, order: DataFrame) -> DataFrame:
    """Annotations with the place of their image in the batch (image, batch_index)."""
    return annotations.join(order, "image")
