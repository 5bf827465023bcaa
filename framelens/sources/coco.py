"""Readers of annotation files. Schemas are given, so nothing is read twice to infer them."""

from __future__ import annotations

import codecs
import json
from collections.abc import Callable, Iterator
from itertools import batched

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from framelens import schemas
from framelens.functions.strings import stem
from framelens.operators.manifest import IMAGE_FORMATS

from .files import read_texts, store_of


def read_coco(spark: SparkSession, path: str | list[str]) -> dict[str, DataFrame]:
    """images, annotations and categories of JSON documents, each with its ``source`` file. A file is one task's work and
    one document: what stands behind its first is not read, so files of several are for :func:`read_large_coco`."""
    doc = spark.read.option("multiLine", True).schema(schemas.COCO).json(path).withColumn("source", F.col("_metadata.file_path"))
    return {n: doc.select("source", F.explode(n).alias("_x")).select("source", "_x.*") for n in ("images", "annotations", "categories")}


class _JsonText:
    """A JSON text that is read piece by piece: only the value at hand stands in memory."""

    def __init__(self, stream, piece: int = 1 << 20) -> None:
        self.stream, self.piece, self.decode, self.scan = stream, piece, codecs.getincrementaldecoder("utf-8-sig")().decode, json.JSONDecoder().raw_decode
        self.text, self.at, self.ended = "", 0, False

    def _more(self, size: int) -> None:
        data = self.stream.read(size)
        self.ended = not data
        self.text, self.at = self.text[self.at :] + self.decode(data, not data), 0

    def mark(self, skip: str = "") -> str:
        """The next character that is neither white space nor one to skip; empty at the end."""
        while True:
            while self.at < len(self.text):
                if self.text[self.at] not in " \t\r\n" + skip:
                    return self.text[self.at]
                self.at += 1
            if self.ended:
                return ""
            self._more(self.piece)

    def value(self) -> tuple[object, str]:
        """The next value and its text. A value that isn't whole yet takes as much again."""
        self.mark()
        while True:
            try:
                found, end = self.scan(self.text, self.at)
                if end < len(self.text) or self.ended:
                    text, self.at = self.text[self.at : end], end
                    return found, text
            except json.JSONDecodeError:
                if self.ended:
                    raise
            self._more(max(self.piece, len(self.text) - self.at))


def json_records(stream, keys: tuple[str, ...], piece: int = 1 << 20) -> Iterator[tuple[str, str]]:
    """Key and text of each element of the arrays that stand under top-level keys, in order; other keys are passed over,
    their arrays an element at a time too.

    Documents may follow one another, as in files of one a line.
    """
    text, first = _JsonText(stream, piece), True
    while (mark := text.mark()) or first:
        if mark != "{":
            raise ValueError("the document is no object")
        text.at, first = text.at + 1, False
        while text.mark(",") not in ("}", ""):
            key = text.value()[0]
            if text.mark() != ":":
                raise ValueError(f"no value behind {key!r}")
            text.at += 1
            if text.mark() == "[":
                text.at += 1
                while text.mark(",") not in ("]", ""):
                    record = text.value()[1]
                    if key in keys:
                        yield key, record
                text.at += 1
            else:
                text.value()
        text.at += 1


def read_large_coco(spark: SparkSession, path: str | list[str], piece: int = 1 << 20) -> dict[str, DataFrame]:
    """Like :func:`read_coco` for documents of any size, several in a file too: a task reads a file as a stream and holds a
    record at a time.

    Files are opened by Arrow's file systems, so the path is one that they know. The scan deals them to tasks by their sizes.
    Their names are not shuffled: adaptive execution would take the names' size for the records' and broadcast them.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "length")

    def reader(section: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for name in batch.column(0).to_pylist():
                    store, place, _ = store_of(name)
                    with store.open_input_stream(place) as stream:
                        for rows in batched(json_records(stream, (section,), piece), 10_000):
                            yield pa.RecordBatch.from_arrays([pa.array([name] * len(rows)), pa.array(text for _, text in rows)], names=["source", "record"])

        return read

    kinds = {"images": schemas.COCO_IMAGES, "annotations": schemas.COCO_ANNOTATIONS, "categories": schemas.COCO_CATEGORIES}
    part = lambda name, kind: files.mapInArrow(reader(name), "source string, record string").select("source", F.from_json("record", kind.removeprefix("array<").removesuffix(">")).alias("_x")).select("source", "_x.*")
    return {name: part(name, kind) for name, kind in kinds.items()}


#: Endings of videos that are read.
VIDEO_FORMATS = ("asf", "avi", "gif", "m4v", "mkv", "mov", "mp4", "mpeg", "mpg", "ts", "wmv", "webm")


def list_media(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """path, length and kind (image or video) of the files below a folder whose ending is known; contents aren't read."""
    ending = F.lower(F.regexp_extract("path", r"\.([^./]*)$", 1))
    kind = F.when(ending.isin(*IMAGE_FORMATS), "image").when(ending.isin(*VIDEO_FORMATS), "video")
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length", kind.alias("kind")).where("kind IS NOT NULL")


def coco_labels(images: DataFrame, annotations: DataFrame, classes: DataFrame | None = None) -> DataFrame:
    """image_id, cls and a centre box in shares of the image, in order of annotation.

    Crowds and boxes without area go, and of boxes of an image that equal in class and place the first stays.
    ``classes`` maps category_id to cls; without it cls is category_id - 1.
    """
    rows = annotations.where((F.coalesce("iscrowd", F.lit(0)) == 0) & (F.size("bbox") == 4)).join(images.select(F.col("id").alias("image_id"), "width", "height"), "image_id")
    at = lambda i: F.get("bbox", F.lit(i))
    boxes = rows.select("id", "image_id", "category_id", ((at(0) + at(2) / 2) / F.col("width")).alias("cx"), ((at(1) + at(3) / 2) / F.col("height")).alias("cy"), (at(2) / F.col("width")).alias("w"), (at(3) / F.col("height")).alias("h")).where("w > 0 AND h > 0")
    named = boxes.withColumn("cls", F.col("category_id") - 1) if classes is None else boxes.join(classes, "category_id")
    same = Window.partitionBy("image_id", "cls", "cx", "cy", "w", "h").orderBy("id")
    return named.withColumn("_r", F.row_number().over(same)).where("_r = 1").select("image_id", "id", "cls", "cx", "cy", "w", "h")


def read_manifest(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The dataset record and the image records of an NDJSON manifest, in whatever order the lines stand."""
    rows = spark.read.schema(schemas.MANIFEST).json(path)
    return rows.where("type = 'dataset'").select("task", "depth_scale", "class_names", "kpt_shape"), rows.where("type = 'image'").select("file", "url", "split", "annotations", "depth")


def manifest_annotations(images: DataFrame) -> DataFrame:
    """file, kind, cls and coords: of each image the first kind of annotation it has."""
    first = F.get(F.map_entries("annotations"), F.lit(0))
    rows = images.where(F.size("annotations") > 0).select("file", first.alias("_e")).select("file", F.col("_e.key").alias("kind"), F.posexplode("_e.value").alias("i", "row"))
    return rows.select("file", "kind", "i", F.get("row", F.lit(0)).cast("int").alias("cls"), F.slice("row", 2, 1_000_000).alias("coords"))


def keypoint_shape(rows: DataFrame, coords: str = "coords", sample: int = 50) -> DataFrame:
    """One row (points, dims) if up to ``sample`` pose rows agree: three values a point where every third is 0, 1 or 2."""
    some = rows.limit(sample).select(F.slice(coords, 5, 1_000_000).alias("k"))
    n = F.size("k")
    third = F.forall(F.filter("k", lambda v, i: i % 3 == 2), lambda v: v.isin(0.0, 1.0, 2.0)) & (n % 3 == 0)
    agreed = some.agg(F.min(n).alias("lo"), F.max(n).alias("hi"), F.bool_and(third).alias("three")).where("lo = hi")
    return agreed.select(F.when(F.col("three"), F.col("lo") / 3).otherwise(F.col("lo") / 2).cast("int").alias("points"), F.when(F.col("three"), 3).otherwise(2).alias("dims"))


def fill_names(images: DataFrame, dataset: DataFrame) -> DataFrame:
    """cls and name for every class up to the largest: missing names are class<i> where some are given."""
    top = manifest_annotations(images).agg(F.coalesce(F.max("cls"), F.lit(-1)).alias("top"))
    named = dataset.select(F.explode(F.coalesce("class_names", F.create_map().cast("map<string,string>")))).select(F.col("key").cast("int").alias("cls"), F.col("value").alias("name"))
    most = named.agg(F.coalesce(F.max("cls"), F.lit(-1)).alias("named"))
    [(t,)], [(n,)] = top.collect(), most.collect()
    every = images.sparkSession.range(max(t, n) + 1).select(F.col("id").cast("int").alias("cls"))
    return every.join(named, "cls", "left").select("cls", F.coalesce("name", F.concat(F.lit("class"), F.col("cls").cast("string"))).alias("name"))


def read_label_files(spark: SparkSession, path: str, keypoints: tuple[int, int] | None = None, n_classes: int = 1 << 30) -> DataFrame:
    """One row for each label file: path, lines (distinct), kind, n_repeated and a fault, null if the file is sound.

    Lines are class and box (5 fields), class and polygon (more than 6), or class, box and keypoints.
    """
    files = read_texts(spark, path)
    lines = F.filter(F.split("value", r"\r?\n"), lambda s: F.trim(s) != "")
    numbers = F.transform(lines, lambda s: F.transform(F.split(F.trim(s), r"\s+"), lambda v: v.try_cast("double")))
    rows = files.select("path", numbers.alias("rows"))
    width = 5 + keypoints[0] * keypoints[1] if keypoints else 5
    polygons = F.exists("rows", lambda r: F.size(r) > 6) if keypoints is None else F.lit(False)
    mixed = polygons & F.exists("rows", lambda r: F.size(r) <= 6)
    bad_width = ~polygons & F.exists("rows", lambda r: F.size(r) != width)
    coords = lambda r: F.slice(r, 2, 1_000_000)
    fault = (
        F.when(F.exists("rows", lambda r: F.exists(r, lambda v: v.isNull())), "not a number")
        .when(mixed, "boxes and polygons mixed")
        .when(bad_width, "wrong number of fields")
        .when(F.exists("rows", lambda r: F.exists(coords(r), lambda v: v > 1.01)), "coordinate above 1")
        .when(F.exists("rows", lambda r: F.exists(r, lambda v: v < -0.01)), "negative value")
        .when(F.exists("rows", lambda r: F.get(r, F.lit(0)) >= n_classes), "class out of range")
    )
    return rows.select("path", F.array_distinct("rows").alias("lines"), F.when(polygons, "polygon").when(F.lit(keypoints is not None), "pose").otherwise("box").alias("kind"), (F.size("rows") - F.size(F.array_distinct("rows"))).alias("n_repeated"), fault.alias("fault"))


def label_rows(files: DataFrame) -> DataFrame:
    """path, cls and coords of the sound files."""
    each = files.where("fault IS NULL").select("path", "kind", F.explode("lines").alias("l"))
    return each.select("path", "kind", F.get("l", F.lit(0)).cast("int").alias("cls"), F.slice("l", 2, 1_000_000).alias("coords"))


def scan_counts(images: DataFrame, files: DataFrame) -> DataFrame:
    """One row: missing, found, empty and corrupt label files of images (image path in ``path``)."""
    keyed = images.select(stem(F.col("path")).alias("stem")).join(files.select(stem(F.col("path")).alias("stem"), "fault", F.size("lines").alias("n")), "stem", "left")
    return keyed.agg(F.count_if(F.col("n").isNull()).alias("missing"), F.count_if(F.col("n").isNotNull()).alias("found"), F.count_if(F.col("n") == 0).alias("empty"), F.count_if(F.col("fault").isNotNull()).alias("corrupt"))


def read_results_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, inferSchema=True, ignoreLeadingWhiteSpace=True)


def read_trials(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.TRIALS).json(path)


def read_rotated_text(spark: SparkSession, path: str, images: DataFrame, classes: DataFrame) -> DataFrame:
    """Files of eight coordinates and a class name a line to stem, cls and coords in shares of the image."""
    lines = spark.read.text(path).select(stem(F.col("_metadata.file_path")).alias("stem"), F.split(F.trim("value"), r"\s+").alias("f")).where(F.size("f") >= 9)
    joined = lines.withColumn("name", F.get("f", F.lit(8))).join(classes, "name").join(images, "stem")
    coords = F.transform(F.slice("f", 1, 8), lambda v, i: v.cast("double") / F.when(i % 2 == 0, F.col("width")).otherwise(F.col("height")))
    return joined.select("stem", "cls", coords.alias("coords"))


def pair_by_stem(labels: DataFrame, images: DataFrame, extensions: list[str]) -> DataFrame:
    """Each label with its image: of images with its stem the one whose extension is listed first."""
    suffix = F.lower(F.regexp_extract("path", r"\.([^.]*)$", 1))
    rank = F.array_position(F.array(*[F.lit(e) for e in extensions]), suffix)
    ranked = images.select(stem(F.col("path")).alias("stem"), F.col("path").alias("image_path"), rank.alias("_k")).where("_k > 0")
    first = ranked.withColumn("_r", F.row_number().over(Window.partitionBy("stem").orderBy("_k", "image_path"))).where("_r = 1")
    return labels.withColumn("stem", stem(F.col("path"))).join(first.select("stem", "image_path"), "stem", "left")


def grounding_phrases(images: DataFrame, annotations: DataFrame) -> DataFrame:
    """image_id, id, phrase and its number in the image (by first use).

    ``annotations`` has tokens_positive, [start, end) spans of the image's caption; crowds, empty boxes and blank
    phrases go.
    """
    sound = annotations.where((F.coalesce("iscrowd", F.lit(0)) == 0) & (F.get("bbox", F.lit(2)) > 0) & (F.get("bbox", F.lit(3)) > 0))
    joined = sound.join(images.select(F.col("id").alias("image_id"), "caption"), "image_id")
    words = F.transform("tokens_positive", lambda t: F.substring(F.col("caption"), F.get(t, F.lit(0)).cast("int") + 1, (F.get(t, F.lit(1)) - F.get(t, F.lit(0))).cast("int")))
    phrases = joined.withColumn("phrase", F.lower(F.trim(F.array_join(words, " ")))).where("phrase <> ''")
    firsts = phrases.groupBy("image_id", "phrase").agg(F.min("id").alias("_first"))
    numbered = firsts.withColumn("number", F.row_number().over(Window.partitionBy("image_id").orderBy("_first")) - 1)
    return phrases.join(numbered, ["image_id", "phrase"]).select("image_id", "id", "phrase", "number")


def read_labels_json(rows: DataFrame, column: str, key: str) -> DataFrame:
    """key, name and value of each field of a JSON object column."""
    return rows.select(key, F.explode(F.from_json(column, "map<string,string>")).alias("name", "value"))


def polygon_points(segmentation: Column) -> Column:
    """How many points a JSON list of flat polygons has."""
    return F.coalesce(F.aggregate(F.from_json(segmentation, "array<array<double>>"), F.lit(0), lambda n, p: n + (F.size(p) / 2).cast("int")), F.lit(0))
