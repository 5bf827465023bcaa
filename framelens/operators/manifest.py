"""Preparing manifests: validation splits, sampling, class tables, vocabularies and windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framelens.functions.segments import share_inside

from .etl import evenly_spaced, hash_order

#: Ids of the 91-class numbering that the 80-class one leaves out.
UNUSED_OF_91 = (12, 26, 29, 30, 45, 66, 68, 69, 71, 83, 91)


def carve_validation(images: DataFrame, seed: int = 0, key: str = "file") -> DataFrame:
    """Where no image is in the val split, moves a tenth of train there (at least one), if train has two or more."""
    counts = {r["split"]: r["count"] for r in images.groupBy("split").count().collect()}
    n = counts.get("train", 0)
    if counts.get("val") or n < 2:
        return images
    take = max(1, n // 10)
    chosen = images.where("split = 'train'").orderBy(hash_order(seed, key), key).limit(take).select(key)
    # A tenth of one split's keys: left to Catalyst, which measures it.
    marked = images.join(chosen.withColumn("_val", F.lit(True)), key, "left")
    return marked.withColumn("split", F.when(F.col("_val"), "val").otherwise(F.col("split"))).drop("_val")


def split_fractions(fraction: float | list[float]) -> dict[str, float]:
    """Shares or counts for train, val and test: one number is for train alone; 0 is allowed for test only."""
    values = fraction if isinstance(fraction, list) else [fraction]
    named = dict(zip(("train", "val", "test"), [*values, *[1.0] * (3 - len(values))]))
    for name, v in named.items():
        if v < 0 or (v == 0 and name != "test"):
            raise ValueError(f"{name}: {v} is no fraction")
    return named


def sample_splits(images: DataFrame, fraction: float | list[float], key: str = "file") -> DataFrame:
    """Of each split a share (up to 1) or a count of its images, at equal distances over the sorted keys."""
    out = None
    for name, v in split_fractions(fraction).items():
        rows = images.where(F.col("split") == name)
        if v != 1:
            n = rows.count()
            take = 0 if v == 0 else min(n, int(v)) if v > 1 else max(1, round(n * v)) if n else 0
            rows = evenly_spaced(rows, [key], take) if take else rows.limit(0)
        out = rows if out is None else out.unionByName(rows)
    return out


def class_table_91_to_80(spark) -> DataFrame:
    """id (1 to 91) and cls (0 to 79, null for the ids that are not used)."""
    used = [i for i in range(1, 92) if i not in UNUSED_OF_91]
    return spark.createDataFrame([(i, used.index(i) if i in used else None) for i in range(1, 92)], "id int, cls int")


def area_bucket(area: Column) -> Column:
    """Small below 32 x 32, large from 96 x 96 on."""
    return F.when(area < 32 * 32, "small").when(area < 96 * 96, "medium").otherwise("large")


def assign_to_windows(objects: DataFrame, windows: DataFrame, least: float = 0.7) -> DataFrame:
    """Each object with every window of its image that holds at least ``least`` of its polygon.

    ``objects`` has image, polygon (flat numbers) and its box; ``windows`` image, tx1, ty1, tx2, ty2. Boxes are
    compared first, so polygons are cut only where they can meet. Windows are several rows an image and made by an
    explode that size estimates don't count, so they are never broadcast.
    """
    near = objects.join(windows.hint("merge"), "image").where("x1 < tx2 AND tx1 < x2 AND y1 < ty2 AND ty1 < y2")
    return near.withColumn("share", share_inside(F.col("polygon"), *[F.col(c).cast("double") for c in ("tx1", "ty1", "tx2", "ty2")])).where(F.col("share") >= least)


def rebase(objects: DataFrame) -> DataFrame:
    """Assigned objects in their window's own coordinates, with the window's name."""
    moved = F.transform("polygon", lambda v, i: v - F.when(i % 2 == 0, F.col("tx1")).otherwise(F.col("ty1")))
    name = F.concat_ws("__", F.col("image").cast("string"), (F.col("tx2") - F.col("tx1")).cast("string"), F.concat_ws("___", F.col("tx1").cast("string"), F.col("ty1").cast("string")))
    return objects.withColumn("polygon", moved).withColumn("tile", name)


def sample_labels(rows: DataFrame, vocabulary: DataFrame, most: int, seed: int = 0) -> DataFrame:
    """image and its labels, at most ``most``: first its own in hash order, then others; numbered densely from 0.

    ``rows`` has image and label, ``vocabulary`` label. The vocabulary's first ``most`` words by hash are the
    negatives that all images share, a bounded list.
    """
    own = rows.select("image", "label").distinct().withColumn("_k", hash_order(seed, "label"))
    [(words,)] = vocabulary.orderBy(hash_order(seed + 1, "label"), "label").limit(2 * most).agg(F.collect_list("label")).collect()
    others = own.select("image").distinct().select("image", F.explode(F.array(*[F.lit(w) for w in words]) if words else F.array().cast("array<string>")).alias("label")).join(own.select("image", "label"), ["image", "label"], "left_anti")
    every = own.select("image", "label", F.lit(0).alias("_g"), "_k").unionByName(others.select("image", "label", F.lit(1).alias("_g"), hash_order(seed + 1, "label").alias("_k")))
    order = Window.partitionBy("image").orderBy("_g", "_k", "label")
    ranked = every.withColumn("number", F.row_number().over(order) - 1).where(F.col("number") < most)
    return ranked.select("image", "label", "number", (F.col("_g") == 0).alias("present"))


def merge_vocabularies(rows: DataFrame, group: str, label: str) -> DataFrame:
    """group, label and its dense number in the group, in alphabetical order."""
    return rows.select(group, label).distinct().withColumn("number", F.row_number().over(Window.partitionBy(group).orderBy(label)) - 1)


def mask_boxes(pixels: DataFrame, keys: list[str]) -> DataFrame:
    """The tight box of each mask's pixels (u, v)."""
    return pixels.groupBy(*keys).agg(F.min("u").alias("x1"), F.min("v").alias("y1"), F.max("u").alias("x2"), F.max("v").alias("y2"))


def pixel_shares(pixels: DataFrame, image: str, cls: str) -> DataFrame:
    counts = pixels.groupBy(image, cls).agg(F.count("*").alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(image)))


def clamp(value: Column, low: float, high: float, whole: bool = False) -> Column:
    """A parameter within its bounds: rounded to a whole number, or to five places."""
    bounded = F.least(F.greatest(value, F.lit(float(low))), F.lit(float(high)))
    return F.bround(bounded) if whole else F.bround(bounded, 5)


def like_aspect(width: Column, height: Column, other_width: Column, other_height: Column, within: float = 0.02) -> Column:
    """Whether two sizes have nearly the same aspect ratio."""
    return F.abs(F.ln((other_width / other_height) / (width / height))) <= within


def gaussian_smooth(points: DataFrame, x: str, y: str, sigma: float = 3.0, truncate: float = 4.0) -> DataFrame:
    """A curve of a row for each whole x, smoothed by a Gaussian whose ends repeat. The curve is a small table."""
    from math import exp

    half = int(truncate * sigma + 0.5)
    weights = [exp(-0.5 * (k / sigma) ** 2) for k in range(-half, half + 1)]
    order = Window.orderBy(x)
    first, last = F.first(y).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)), F.last(y).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    total = F.lit(0.0)
    for k, w in zip(range(-half, half + 1), weights):
        near = F.lag(y, -k).over(order) if k < 0 else F.lead(y, k).over(order)
        total = total + F.coalesce(near, first if k < 0 else last) * (w / sum(weights))
    return points.withColumn(f"smooth_{y}", total)


def crop_layers(width: int, height: int, layers: int, overlap: float) -> list[tuple[int, int, int, int, int]]:
    """x1, y1, x2, y2 and layer of overlapping crops: layer i cuts each side into 2 ** i parts."""
    out = [(0, 0, width, height, 0)]
    for layer in range(1, layers + 1):
        n = 2**layer
        shared = int(overlap * min(width, height) * 2 / n)
        side = lambda length: -(-(shared * (n - 1) + length) // n)
        w, h = side(width), side(height)
        out += [(x := (w - shared) * i, y := (h - shared) * j, min(x + w, width), min(y + h, height), layer) for i in range(n) for j in range(n)]
    return out


#: Fixed value: the class of pixels that don't count.
IGNORED = 255


def label_mapping(given: dict | None) -> dict[int, int]:
    """Numbers to numbers from a mapping of a settings file, where null and 'ignore_label' stand for pixels that don't count."""
    if given is None:
        return {}
    if not isinstance(given, dict):
        raise TypeError(f"label_mapping takes a mapping, not {given!r}")
    plain = lambda v: v.strip() if isinstance(v, str) else v
    return {int(k): IGNORED if plain(v) in (None, "ignore_label") else int(v) for k, v in given.items()}


def map_labels(label: Column, mapping: dict[int, int], inverse: bool = False) -> Column:
    """Classes of pixels (0 to 255) under a mapping; those it doesn't name stay. Of several with one target the last is
    its inverse, as a number of eight bits."""
    table = {v: k & 0xFF for k, v in mapping.items()} if inverse else mapping
    known = {k: v for k, v in table.items() if 0 <= k < 256}
    if not known:
        return label
    pairs = F.create_map(*[F.lit(x) for kv in known.items() for x in kv])
    return F.coalesce(pairs[label.cast("int")], label.cast("int"))


#: Endings of images that are read.
IMAGE_FORMATS = ("avif", "bmp", "dng", "heic", "heif", "jp2", "jpeg", "jpg", "mpo", "png", "tif", "tiff", "webp")


def image_fault(path: Column, width: Column, height: Column) -> Column:
    """Why an image can't be used: its format, or a side under ten pixels; null for a sound one."""
    ending = F.lower(F.regexp_extract(path, r"\.([^./]*)$", 1))
    return F.when(width.isNull() | height.isNull(), "not readable").when((width < 10) | (height < 10), "too small").when(~ending.isin(*IMAGE_FORMATS), "unknown format")


def depth_fault(path: Column, form: Column, width: Column, height: Column, depth_width: Column, depth_height: Column, within: float = 0.02) -> Column:
    """Why a depth map can't be used: none there, no grid of floating numbers (npy) or integers (png16), or another aspect."""
    alike = like_aspect(width, height, depth_width, depth_height, within)
    return F.when(path.isNull(), "missing").when(~form.isin("npy", "png16"), "not a grid of numbers").when(~alike, "other shape")


def mask_fault(path: Column, width: Column, height: Column, mask_width: Column, mask_height: Column, top: Column, n_classes: int) -> Column:
    """Why a mask of classes can't be used: none there, another size, or a class (its largest but the ignored one) too high."""
    return F.when(path.isNull(), "missing").when((mask_width != width) | (mask_height != height), "other size").when(top >= n_classes, "class out of range")


def inside_boxes(pixels: DataFrame, boxes: DataFrame, keys: list[str]) -> DataFrame:
    """Pixels (u, v) of each mask inside its own box: from its left and top sides to before the others."""
    joined = pixels.join(boxes.select(*keys, "x1", "y1", "x2", "y2"), keys)
    return joined.where("u >= x1 AND u < x2 AND v >= y1 AND v < y2").select(*pixels.columns)


def topmost(pixels: DataFrame, mask: str = "mask") -> DataFrame:
    """image, pixel and the number (from 1, by falling size) of the smallest mask that holds it, where masks overlap."""
    sizes = pixels.groupBy("image", mask).agg(F.count("*").alias("_n"))
    numbered = sizes.withColumn("number", F.row_number().over(Window.partitionBy("image").orderBy(F.desc("_n"), mask)))
    return pixels.join(numbered, ["image", mask]).groupBy("image", "pixel").agg(F.max("number").alias("number"))


def smoothed_targets(eps: float = 0.1) -> tuple[float, float]:
    """What a positive and a negative label become."""
    return 1.0 - 0.5 * eps, 0.5 * eps


def next_free_name(names: DataFrame, name: str, base: str) -> str:
    """``base`` if no row has it, else that with the smallest free number from 2 on behind it."""
    number = F.expr("try_cast(_n AS int)")
    taken = names.select(F.col(name).alias("_x")).where(F.col("_x").startswith(base)).withColumn("_n", F.when(F.col("_x") == base, "1").otherwise(F.substring("_x", len(base) + 1, 1 << 20)))
    used = taken.where(number > 0).select(number.alias("k")).distinct()
    # The first number whose predecessor is used and that is not.
    free = used.select((F.col("k") + 1).alias("k")).join(used, "k", "left_anti").agg(F.min("k")).first()[0]
    return base if used.where("k = 1").isEmpty() else f"{base}{free}"
