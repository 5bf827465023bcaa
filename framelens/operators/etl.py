"""Annotation ETL: validation, duplicates, splits, sampling, merging and renumbering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordered import running_sums
from .shared import written


def hash_order(seed: str | int, *keys: str) -> Column:
    """A pseudo-random order that any engine reproduces: md5 of seed and keys."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))


def hash_unit(seed: str | int, *keys: str) -> Column:
    """A number in [0, 1) from the first seven hex digits of the hash order."""
    return F.conv(F.substring(hash_order(seed, *keys), 1, 7), 16, 10).cast("long") / F.lit(float(16**7))


def in_ranges(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``_step``, the number of a range of the whole order, which is cut into as many as the shuffle has
    partitions. Spark samples the bounds, so the rows are written before anyone relies on them. Nulls come first."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return written(rows.repartitionByRange(n, *[F.col(c) for c in order]).withColumn("_step", F.spark_partition_id()))


def dense_numbers(rows: DataFrame, order: list[str], into: str, start: int = 1) -> DataFrame:
    """Numbers rows from ``start`` in the order of the columns, which must be total, without one task for all.

    Each range of the order is numbered alone and starts where those before it end. Nulls come first.
    """
    marked = in_ranges(rows, order).withColumns({"_one": F.lit(1), "_all": F.lit(0)})
    numbered = running_sums(marked, ["_all"], [F.col(c) for c in order], {into: "_one"})
    return numbered.withColumn(into, F.col(into) + (start - 1)).drop("_step", "_one", "_all")


def exact_duplicates(rows: DataFrame, content: Column, name: str) -> DataFrame:
    """Rows whose content another row with a smaller name has: size first, then sha256.

    ``copy`` numbers the copies of a content by name. A content that very many rows share, such as the empty one, is
    numbered range by range of the names, and what is unique doesn't come that far.
    """
    told = rows.withColumn("size", F.octet_length(content)).withColumn("digest", F.sha2(content.cast("binary"), 256))
    shared = told.groupBy("size", "digest").agg(F.count("*").alias("_n")).where("_n > 1").drop("_n")
    copies = in_ranges(told.join(shared, ["size", "digest"]), [name]).withColumn("_one", F.lit(1))
    ranked = running_sums(copies, ["size", "digest"], [F.col(name)], {"_r": "_one"})
    return ranked.where("_r > 1").withColumn("copy", (F.col("_r") - 1).cast("int")).select(*told.columns, "copy")


def class_signature(annotations: DataFrame, image: str = "image", cls: str = "cls") -> DataFrame:
    """image and its sorted distinct classes, comma-joined."""
    return annotations.groupBy(image).agg(F.array_join(F.array_sort(F.collect_set(F.col(cls).cast("string"))), ",").alias("signature"))


def allocate(strata: DataFrame, total: int, stratum: str = "signature", size: str = "n") -> DataFrame:
    """Adds ``take``: a proportional share of ``total``, at least 1 and at most the stratum, that sums to ``total``.

    What rounding leaves is dealt one by one over the strata by falling size, in rounds, to those that have room
    (or more than one). In closed form: with r rounds a stratum can take min(r, room), which sums to a line with a bend
    at each distinct room; the last, partial round goes to the first that still have room. Class signatures may be very
    many, so no task sees them all: rooms meet as a histogram, which has at most the root of twice the images in rows.
    """
    strata = written(strata)
    n = strata.agg(F.sum(size)).first()[0] or 0
    base = strata.withColumn("_base", F.least(F.greatest(F.lit(1), F.bround(F.col(size) * total / F.lit(n or 1))), F.col(size)).cast("long"))
    left = total - (base.agg(F.sum("_base")).first()[0] or 0)
    room = base.withColumn("_room", F.col(size) - F.col("_base") if left >= 0 else F.col("_base") - 1)
    upto, above = Window.orderBy("_room").rowsBetween(Window.unboundedPreceding, 0), Window.orderBy("_room").rowsBetween(1, Window.unboundedFollowing)
    bends = room.where("_room > 0").groupBy("_room").agg(F.count("*").alias("_k"))
    line = bends.select("_room", F.coalesce(F.sum("_k").over(above), F.lit(0)).alias("_above"), F.sum(F.col("_room") * F.col("_k")).over(upto).alias("_spent"))
    spent = line.withColumn("_cost", F.col("_spent") + F.col("_room") * F.col("_above")).where(F.col("_cost") <= abs(left))
    last = spent.orderBy(F.desc("_room")).first()
    rounds, cost, open_ = (last["_room"], last["_cost"], last["_above"]) if last else (0, 0, bends.agg(F.sum("_k")).first()[0] or 0)
    more = (abs(left) - cost) // open_ if open_ else 0
    rounds, more = rounds + more, abs(left) - cost - more * open_
    whole = room.withColumn("take", F.col("_base") + (1 if left >= 0 else -1) * F.least(F.col("_room"), F.lit(rounds))).drop("_base")
    if not more or not open_:
        return whole.drop("_room")
    turns = dense_numbers(whole.where(F.col("_room") > rounds).withColumn("_falling", -F.col(size)), ["_falling", stratum], "_turn")
    extra = turns.where(F.col("_turn") <= more).select(stratum, F.lit(1 if left >= 0 else -1).alias("_extra"))
    return whole.join(extra, stratum, "left").withColumn("take", F.col("take") + F.coalesce("_extra", F.lit(0))).select(*strata.columns, "take")


def stratified_sample(images: DataFrame, total: int, seed: int, image: str = "image", signature: str = "signature") -> DataFrame:
    """The images that a stratified allocation picks, in hash order inside each signature.

    The hash is the order, so ranks are running counts in two levels and a dominant signature is spread over tasks.
    """
    sizes = images.groupBy(signature).agg(F.count("*").alias("n"))
    plan = allocate(sizes, total, signature).select(signature, "take")
    ordered = images.withColumn("_h", hash_order(seed, image)).withColumn("_step", F.conv(F.substring("_h", 1, 3), 16, 10).cast("int")).withColumn("_one", F.lit(1))
    ranked = running_sums(ordered, [signature], [F.col("_h"), F.col(image)], {"_r": "_one"})
    return ranked.join(plan, signature).where(F.col("_r") <= F.col("take")).select(*images.columns)


def hash_split(rows: DataFrame, key: str, shares: dict[str, float], seed: int = 0) -> DataFrame:
    """Adds ``split`` by an independent weighted draw for each key."""
    u, at, out = hash_unit(seed, key), 0.0, F.lit(list(shares)[-1])
    bounds = []
    for name, share in shares.items():
        at += share
        bounds.append((name, at))
    for name, bound in reversed(bounds[:-1]):
        out = F.when(u < bound, name).otherwise(out)
    return rows.withColumn("split", out)


def split_by_class(rows: DataFrame, cls: str, key: str, ratio: float = 0.8, seed: int = 0) -> DataFrame:
    """Adds ``split``: the first int(n * ratio) rows of each class in hash order are train.

    The hash is the order, so the running counts are taken in two levels and a large class is spread over tasks.
    """
    sized = rows.groupBy(cls).agg(F.count("*").alias("_n"))
    ordered = rows.withColumn("_h", hash_order(seed, key)).withColumn("_step", F.conv(F.substring("_h", 1, 2), 16, 10).cast("int")).withColumn("_one", F.lit(1))
    ranked = running_sums(ordered, [cls], [F.col("_h"), F.col(key)], {"_r": "_one"})
    return ranked.join(sized, cls).withColumn("split", F.when(F.col("_r") <= F.floor(F.col("_n") * ratio), "train").otherwise("val")).drop("_h", "_step", "_one", "_r", "_n")


def ranked_split(rows: DataFrame, key: str, shares: dict[str, float], seed: int = 0) -> DataFrame:
    """Adds ``split`` by contiguous parts of the hash order; counts are rounded half to even, the last takes the rest."""
    ordered = rows.withColumn("_h", hash_order(seed, key))
    ranked = dense_numbers(ordered, ["_h", key], "_r")
    total = rows.count()
    out, at, names = F.lit(list(shares)[-1]), 0, list(shares)
    bounds = []
    for name in names[:-1]:
        at += round(total * shares[name] / sum(shares.values()))
        bounds.append((name, at))
    for name, bound in reversed(bounds):
        out = F.when(F.col("_r") <= bound, name).otherwise(out)
    return ranked.withColumn("split", out).drop("_h", "_r")


def evenly_spaced(rows: DataFrame, order: list[str], count: int) -> DataFrame:
    """``count`` rows at equal distances over the sorted rows, the first and last included (one: the first)."""
    n = rows.count()
    count = min(count, n)
    numbered = dense_numbers(rows, order, "_r", 0)
    if count < 2:
        return numbered.where(F.col("_r") < count).drop("_r")
    # Index i(n-1)/(count-1), truncated: r is hit if some i falls in [r, r + 1).
    i = F.ceil(F.col("_r") * (count - 1) / F.lit(float(n - 1)))
    return numbered.where((i < count) & (F.floor(i * (n - 1) / F.lit(float(count - 1))) == F.col("_r"))).drop("_r")


def renumber(parts: list[DataFrame], order: list[str], old_id: str, new_id: str = "new_id", start: int = 1) -> DataFrame:
    """Rows of all parts, part by part and sorted, with dense new numbers; ``part`` tells where a row is from."""
    tagged = [p.withColumn("part", F.lit(i)) for i, p in enumerate(parts)]
    merged = tagged[0]
    for p in tagged[1:]:
        merged = merged.unionByName(p)
    return dense_numbers(merged, ["part", *order], new_id, start)


def append_renumbered(existing: DataFrame, new: DataFrame, id_col: str, order: list[str]) -> DataFrame:
    """Existing rows and new ones, whose ids go on after the largest."""
    top = existing.agg(F.coalesce(F.max(id_col), F.lit(0))).first()[0]
    numbered = dense_numbers(new.withColumn("_old", F.col(id_col)), [*order, "_old"] if order else ["_old"], id_col + "_new", top + 1)
    return existing.unionByName(numbered.withColumn(id_col, F.col(id_col + "_new")).select(*existing.columns))


def padded_names(rows: DataFrame, stem: str, start: int, width: int = 4) -> DataFrame:
    """New zero-padded names in numeric order of the stems."""
    numbered = dense_numbers(rows.withColumn("_k", F.col(stem).cast("long")), ["_k", stem], "_n", start)
    return numbered.withColumn("new_stem", F.lpad(F.col("_n").cast("string"), width, "0")).drop("_k", "_n")


def with_numeric_key(rows: DataFrame, stem: str) -> DataFrame:
    """Adds ``not_a_number`` and ``number``: in their order and that of the stem numeric stems come first, by number."""
    number = F.expr(f"try_cast(`{stem}` AS bigint)")
    return rows.withColumns({"not_a_number": number.isNull(), "number": number})


def numeric_first(rows: DataFrame, stem: str) -> DataFrame:
    """Numeric stems by number, then the others by name."""
    return with_numeric_key(rows, stem).orderBy("not_a_number", "number", stem).drop("not_a_number", "number")


def batch_shapes(images: DataFrame, width: str, height: str, key: str, batch: int, size: int = 640, stride: int = 32, pad: float = 0.5) -> DataFrame:
    """batch, n, low, high and the padded batch shape (bh, bw) of images sorted by aspect ratio (h / w)."""
    ratio = images.withColumn("_ar", F.col(height) / F.col(width))
    grouped = dense_numbers(ratio, ["_ar", key], "_r", 0).groupBy(F.floor(F.col("_r") / batch).alias("batch")).agg(F.count("*").alias("n"), F.min("_ar").alias("low"), F.max("_ar").alias("high"))
    sh = F.when(F.col("high") < 1, F.col("high")).otherwise(1.0)
    sw = F.when(F.col("high") < 1, 1.0).when(F.col("low") > 1, 1.0 / F.col("low")).otherwise(1.0)
    padded = lambda s: (F.ceil(s * size / stride + pad) * stride).cast("int")
    return grouped.withColumn("bh", padded(sh)).withColumn("bw", padded(sw))


def rank_of_batch(index: Column, total: int, batch: int, ranks: int) -> Column:
    """The rank whose contiguous, batch-aligned range holds an index; low ranks take the remainder."""
    batches = -(-total // batch)
    each, more = divmod(batches, ranks)
    number = F.floor(index / batch)
    wide = more * (each + 1)
    return F.when(number < wide, F.floor(number / (each + 1))).otherwise(more + F.floor((number - wide) / max(1, each))).cast("int")


def unlabelled(images: DataFrame, annotations: DataFrame, key: str = "image") -> DataFrame:
    return images.join(annotations.select(key), key, "left_anti")


def orphans(child: DataFrame, parent: DataFrame, key: str, parent_key: str) -> DataFrame:
    """Child rows whose key no parent has."""
    return child.join(parent.select(F.col(parent_key).alias(key)), key, "left_anti")


def conflicts(rows: DataFrame, key: str, value: str) -> DataFrame:
    """Keys with several distinct values, and how many."""
    return rows.groupBy(key).agg(F.count_distinct(value).alias("n_values")).where("n_values > 1")


def repeated(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def require_empty(rows: DataFrame, what: str) -> None:
    """Raises with the first offending row if there is one."""
    found = rows.limit(1).collect()
    if found:
        raise ValueError(f"{what}: {found[0].asDict()}")


def valid_labels(rows: DataFrame, cls: str, coords: str, n_classes: int, columns: int | None = None) -> Column:
    """Whether a parsed label line is sound: its width, coordinates in [-0.01, 1.01] and its class in range."""
    width = F.size(coords) == columns if columns else F.size(coords) >= 4
    return width & F.forall(coords, lambda v: (v <= 1.01) & (v >= -0.01)) & F.col(cls).between(0, n_classes - 1)


def keep_classes(rows: DataFrame, classes: list | None = None, single: bool = False, cls: str = "cls") -> DataFrame:
    rows = rows.where(F.col(cls).isin(classes)) if classes is not None else rows
    return rows.withColumn(cls, F.lit(0).cast(dict(rows.dtypes)[cls])) if single else rows


def score_band(conf: Column, width: Column, height: Column, high: float = 0.25, low: float = 0.1) -> Column:
    """'high', 'low' or null for a detection that a tracker wouldn't use."""
    sound = (width > 0) & (height > 0)
    return F.when(sound & (conf >= high), "high").when(sound & (conf > low) & (conf < high), "low")


def share_of(fraction: float, n: Column) -> Column:
    """A share (up to 1: at least one row) or a count of n rows."""
    return F.when(F.lit(fraction <= 1), F.greatest(F.lit(1), F.bround(n * min(fraction, 1.0)))).otherwise(F.least(F.lit(int(fraction)), n)).cast("int")


def digest_of_files(files: DataFrame, path: str, size: str) -> DataFrame:
    """One row: sha256 over the total size and the paths in order. Lists are joined; use on manifests."""
    return files.agg(F.sha2(F.concat(F.sum(size).cast("string"), F.array_join(F.array_sort(F.collect_list(path)), "")), 256).alias("digest"))
