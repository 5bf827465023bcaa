"""Deterministic views of the driver's tables as annotations and tracks, in Spark and in SQL.

``annotations``: line items are boxes of an image (their order); of an image's boxes, those with an odd number are
ground truth and the others detections. ``frames``: events are positions of a track (their user) in one of four
streams. Both use integer arithmetic on the columns only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def annotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem")
    order = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    x1, y1 = (F.col("l_partkey") % 20).cast("double"), (F.col("l_suppkey") % 20).cast("double")
    mixed = (F.col("l_partkey") * 7919 + F.col("l_suppkey") * 104729 + F.col("l_linenumber") * 1299709) % 10007
    return rows.select(
        F.col("l_orderkey").alias("image"), F.col("l_returnflag").alias("cls"), F.row_number().over(order).alias("i"), x1.alias("x1"), y1.alias("y1"),
        (x1 + 10 + F.floor("l_quantity")).alias("x2"), (y1 + 10 + F.col("l_linenumber") * 5).alias("y2"), (mixed / F.lit(10007.0)).alias("conf"),
    )


def detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return annotations(spark, sf_dir).where("i % 2 = 0").withColumnRenamed("i", "det")


def ground_truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return annotations(spark, sf_dir).where("i % 2 = 1").withColumnRenamed("i", "gt").drop("conf")


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events")
    order = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return rows.select(
        (F.col("user_id") % 4).alias("stream"), F.col("user_id").alias("track"), F.row_number().over(order).alias("frame"), F.col("value").alias("cx"),
        ((F.col("event_id") * 37) % 200).cast("double").alias("cy"), F.col("event_type").alias("cls"),
    )


ANN = """ann AS (
  SELECT l_orderkey AS image, l_returnflag AS cls,
    row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice)::INT AS i,
    (l_partkey % 20)::DOUBLE AS x1, (l_suppkey % 20)::DOUBLE AS y1,
    (l_partkey % 20)::DOUBLE + 10 + floor(l_quantity) AS x2, (l_suppkey % 20)::DOUBLE + 10 + l_linenumber * 5 AS y2,
    ((l_partkey * 7919 + l_suppkey * 104729 + l_linenumber::BIGINT * 1299709) % 10007)::DOUBLE / 10007.0::DOUBLE AS conf
  FROM lineitem),
det AS (SELECT image, cls, i AS det, x1, y1, x2, y2, conf FROM ann WHERE i % 2 = 0),
gt AS (SELECT image, cls, i AS gt, x1, y1, x2, y2 FROM ann WHERE i % 2 = 1)"""

FRAMES = """frames AS (
  SELECT user_id % 4 AS stream, user_id AS track, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id)::INT AS frame,
    value AS cx, ((event_id * 37) % 200)::DOUBLE AS cy, event_type AS cls FROM events)"""


def sql_inter(a: str, b: str) -> str:
    return f"greatest(0.0::DOUBLE, least({a}.x2, {b}.x2) - greatest({a}.x1, {b}.x1)) * greatest(0.0::DOUBLE, least({a}.y2, {b}.y2) - greatest({a}.y1, {b}.y1))"


def sql_area(a: str) -> str:
    return f"(({a}.x2 - {a}.x1) * ({a}.y2 - {a}.y1))"


def sql_iou(a: str, b: str, eps: str = "1e-7::DOUBLE") -> str:
    inter = f"({sql_inter(a, b)})"
    return f"({inter} / ({sql_area(a)} + {sql_area(b)} - {inter} + {eps}))"
