"""Writers: rows as tables, label text, prediction records and documents."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framelens.functions.strings import six_digits

from .files import write_lists, write_texts


def detection_records(dets: DataFrame, decimals: int = 5, width: Column | None = None, height: Column | None = None) -> DataFrame:
    """image, name, class, confidence and box of each detection, rounded half to even; in shares if sizes are given."""
    sx, sy = (1 / width if width is not None else F.lit(1.0)), (1 / height if height is not None else F.lit(1.0))
    places = F.struct(*[F.bround(F.col(c) * s, decimals).alias(c) for c, s in (("x1", sx), ("y1", sy), ("x2", sx), ("y2", sy))])
    return dets.select("image", F.col("name") if "name" in dets.columns else F.col("cls").cast("string").alias("name"), F.col("cls").alias("class"), F.bround("conf", decimals).alias("confidence"), places.alias("box"), *(["track_id"] if "track_id" in dets.columns else []))


def flat(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text, so that CSV can hold them."""
    nested = [f.name for f in df.schema.fields if f.dataType.typeName() in ("struct", "array", "map")]
    return df.withColumns({c: F.to_json(c) for c in nested})


def write_csv(df: DataFrame, path: str, mode: str = "error") -> None:
    flat(df).write.mode(mode).csv(path, header=True)


def write_json(df: DataFrame, path: str, mode: str = "error") -> None:
    df.write.mode(mode).json(path)


def write_documents(docs: DataFrame, path: str, mode: str = "error") -> None:
    """Each row as a JSON document in a file of its own, since readers take a file for one document."""
    docs.write.mode(mode).option("maxRecordsPerFile", 1).json(path)


def write_sections(sections: dict[str, DataFrame], part: str, path: str, mode: str = "error") -> None:
    """A JSON document in a file of its own for each value of the column ``part``: under a section's name its rows of that
    value, without the column; a section that has none is an empty list. Documents may be of any size, since rows are
    never gathered."""
    rows = [df.select(F.col(part).cast("string").alias("part"), F.lit(i).alias("section"), F.to_json(F.struct(*[c for c in df.columns if c != part])).alias("record")) for i, df in enumerate(sections.values())]
    write_lists(reduce(DataFrame.union, rows), list(sections), path, mode)


def coco_predictions(dets: DataFrame) -> DataFrame:
    """image_id (numeric stems without leading zeros), category_id, bbox (left, top, width, height) and score."""
    number = F.expr("try_cast(image AS bigint)").cast("string")
    sides = ("x1", "y1", "x2", "y2")
    x1, y1, x2, y2 = (F.col(c) for c in sides)
    return dets.select(F.coalesce(number, F.col("image").cast("string")).alias("image_id"), F.col("cls").alias("category_id"), F.array(*[F.bround(v, 3) for v in (x1, y1, x2 - x1, y2 - y1)]).alias("bbox"), F.bround("conf", 5).alias("score"))


def label_lines(rows: DataFrame, numbers: list[str], with_conf: bool = False, with_id: bool = False) -> DataFrame:
    """image and a line of class, numbers with six digits, and confidence and track id if asked for."""
    fields = [F.col("cls").cast("string"), *[six_digits(F.col(c)) for c in numbers]]
    fields += [six_digits(F.col("conf"))] if with_conf else []
    fields += [F.col("track_id").cast("string")] if with_id else []
    return rows.select("image", F.concat_ws(" ", *fields).alias("value"))


def write_label_files(lines: DataFrame, path: str, mode: str = "error") -> None:
    """A text file ``image=<image>.txt`` for each image."""
    write_texts(lines, "image", path, mode)


def image_documents(dets: DataFrame) -> DataFrame:
    """A JSON document of shapes for each image."""
    shape = F.struct(F.col("cls").cast("string").alias("label"), F.array(F.array("x1", "y1"), F.array("x2", "y2")).alias("points"), F.round("conf", 5).alias("score"))
    return dets.groupBy("image").agg(F.to_json(F.struct(F.array_sort(F.collect_list(F.struct("det", shape.alias("shape")))).alias("shapes"))).alias("document"))


def append_trial(trial: DataFrame, path: str) -> None:
    trial.write.mode("append").json(path)


def save_snapshot(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)
