"""Dataset reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def category_report(images: DataFrame, annotations: DataFrame, image: str, cls: str) -> DataFrame:
    """Of each category: instances, images and both shares, over annotations whose image exists."""
    known = annotations.join(images.select(image), image, "left_semi")
    counts = known.groupBy(F.col(cls).alias("category")).agg(F.count("*").alias("instances"), F.count_distinct(image).alias("images"))
    whole = Window.partitionBy()
    total = images.count()
    return counts.withColumn("instance_share", F.col("instances") / F.sum("instances").over(whole)).withColumn("image_share", F.col("images") / F.lit(float(max(total, 1))))


def top_and_other(rows: DataFrame, keys: list[str], k: int = 10) -> DataFrame:
    """The k most frequent kinds and one row for all others: rank, kind, n, kinds, share."""
    counts = rows.groupBy(F.concat_ws("x", *[F.col(c).cast("string") for c in keys]).alias("kind")).agg(F.count("*").alias("n"))
    top = counts.orderBy(F.desc("n"), "kind").limit(k).withColumn("rank", F.row_number().over(Window.orderBy(F.desc("n"), "kind")))
    rest = counts.join(F.broadcast(top.select("kind")), "kind", "left_anti").agg(F.sum("n").alias("n"), F.count("*").alias("kinds")).where("kinds > 0").select(F.lit(k + 1).alias("rank"), F.lit("other").alias("kind"), "n", "kinds")
    return top.select("rank", "kind", "n", F.lit(1).cast("long").alias("kinds")).unionByName(rest).withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()))


def split_composition(rows: DataFrame, split: str, image: str, cls: str) -> DataFrame:
    """split, category, images, instances and the category's share of the split's images."""
    sizes = rows.groupBy(split).agg(F.count_distinct(image).alias("_n"))
    counts = rows.groupBy(split, F.col(cls).alias("category")).agg(F.count_distinct(image).alias("images"), F.count("*").alias("instances"))
    return counts.join(sizes, split).withColumn("share", F.col("images") / F.col("_n")).drop("_n")


def class_totals(dets: DataFrame) -> DataFrame:
    """Counts by image and class with subtotals: null stands for all."""
    return dets.rollup("cls", "image").agg(F.count("*").alias("n"))


def describe_images(dets: DataFrame, names: Column) -> DataFrame:
    """'2 persons, 1 car' for each image, in order of class."""
    counts = dets.groupBy("image", "cls").agg(F.count("*").alias("n")).withColumn("name", names)
    word = F.concat(F.col("n").cast("string"), F.lit(" "), F.col("name"), F.when(F.col("n") > 1, "s").otherwise(""))
    parts = F.array_sort(F.collect_list(F.struct("cls", word.alias("w"))))
    return counts.groupBy("image").agg(F.array_join(F.transform(parts, lambda p: p["w"]), ", ").alias("summary"))


def most_objects(annotations: DataFrame, split: str, image: str) -> DataFrame:
    per = annotations.groupBy(split, image).agg(F.count("*").alias("n"))
    return per.groupBy(split).agg(F.max("n").alias("most"))


def detection_limits(annotations: DataFrame, split: str, image: str, max_det: int = 300) -> DataFrame:
    """split and the number of detections an image may need: ``max_det``, or the most objects of an image where that is more."""
    return most_objects(annotations, split, image).select(split, F.greatest(F.lit(max_det), "most").alias("max_det"))


def synonym_counts(rows: DataFrame, name: str) -> DataFrame:
    """Instances of each synonym of names that are joined by slashes."""
    return rows.select(F.explode(F.split(name, "/")).alias("synonym")).groupBy(F.trim("synonym").alias("synonym")).agg(F.count("*").alias("n"))


def metric_means(runs: DataFrame, keys: list[str]) -> DataFrame:
    """The mean of each metric over the runs that report it; ``runs`` has run, metric, value."""
    return runs.groupBy(*keys, "metric").agg(F.avg("value").alias("mean"))
