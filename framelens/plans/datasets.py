"""Registered queries over annotation files, label text, manifests, curves and small reports, each beside its statement."""

from __future__ import annotations

from math import exp

from pyspark.sql import functions as F

from framelens.functions.strings import count_phrase, folder_class, label_path, stem
from framelens.operators import augment, curves, etl, manifest, matching, metrics, reports, trajectories
from framelens.operators.shared import scratch
from framelens.sources import coco, sinks

from .registry import Entries
from .views import ANN, FRAMES, annotations, frames, sql_iou, table

entries = Entries()
entry = entries.add


def six(c: str) -> F.Column:
    return F.round(c, 6).alias(c)


# Files


def _coco_images(spark, sf):
    return table(spark, sf, "orders").select(F.col("o_orderkey").cast("long").alias("id"), (F.col("o_orderkey") % 7 * 10 + 100).cast("int").alias("width"), F.lit(80).alias("height"), F.concat(F.lit("img"), F.col("o_orderkey").cast("string"), F.lit(".jpg")).alias("file_name"))


def _coco_annotations(spark, sf):
    rows = table(spark, sf, "lineitem")
    bbox = F.array((F.col("l_partkey") % 4).cast("double"), (F.col("l_suppkey") % 3).cast("double"), (F.col("l_quantity") % 5).cast("double"), F.lit(10.0))
    return rows.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("long").alias("id"), F.col("l_orderkey").cast("long").alias("image_id"), (F.col("l_linenumber") % 2 + 1).cast("int").alias("category_id"), F.lit(1.0).alias("area"), bbox.alias("bbox"), (F.col("l_partkey") % 10 == 0).cast("int").alias("iscrowd"), F.lit("[[1, 2, 3, 4, 5, 6], [0, 0, 1, 1]]").alias("segmentation"))


_COCO = """
WITH a AS (SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey AS image_id, l_linenumber % 2 AS cls, (l_partkey % 4)::DOUBLE AS x, (l_suppkey % 3)::DOUBLE AS y, (l_quantity % 5)::DOUBLE AS w, l_partkey % 10 = 0 AS crowd FROM lineitem),
b AS (SELECT image_id, id, cls, (x + w / 2) / (image_id % 7 * 10 + 100) AS cx, (y + 10.0::DOUBLE / 2) / 80 AS cy, w / (image_id % 7 * 10 + 100) AS w, 10.0::DOUBLE / 80 AS h FROM a WHERE NOT crowd AND w > 0)
SELECT image_id, id, cls, round(cx, 6) AS cx, round(cy, 6) AS cy, round(w, 6) AS w, round(h, 6) AS h FROM b
QUALIFY row_number() OVER (PARTITION BY image_id, cls, cx, cy, w, h ORDER BY id) = 1"""


@entry(_COCO)
def coco_labels(spark, sf):
    return coco.coco_labels(_coco_images(spark, sf), _coco_annotations(spark, sf)).select("image_id", "id", F.col("cls").cast("long").alias("cls"), *[six(c) for c in ("cx", "cy", "w", "h")])


#: Images of a document.
_DOCUMENT_IMAGES = 2_000


def _coco_documents(spark, sf):
    """Documents on disk, each a file with the images and annotations of its part; their number grows with the images."""
    path = scratch(spark, "documents")
    parts = max(4, -(-table(spark, sf, "orders").count() // _DOCUMENT_IMAGES))
    part = lambda df, key: df.withColumn("part", F.pmod(F.xxhash64(key), F.lit(parts)))
    categories = spark.range(parts).select(F.col("id").alias("part"), F.lit(1).alias("id"), F.lit("one").alias("name"))
    sinks.write_sections({"images": part(_coco_images(spark, sf), "id"), "annotations": part(_coco_annotations(spark, sf), "image_id"), "categories": categories}, "part", path)
    return path


@entry(_COCO)
def coco_documents(spark, sf):
    """The same from documents on disk."""
    read = coco.read_coco(spark, _coco_documents(spark, sf))
    return coco.coco_labels(read["images"], read["annotations"]).select("image_id", "id", F.col("cls").cast("long").alias("cls"), *[six(c) for c in ("cx", "cy", "w", "h")])


@entry(_COCO)
def coco_streams(spark, sf):
    """The same from documents that are read record by record."""
    read = coco.read_large_coco(spark, _coco_documents(spark, sf))
    return coco.coco_labels(read["images"], read["annotations"]).select("image_id", "id", F.col("cls").cast("long").alias("cls"), *[six(c) for c in ("cx", "cy", "w", "h")])


@entry("SELECT l_orderkey * 10 + l_linenumber AS id, 5 AS points FROM lineitem")
def polygon_points(spark, sf):
    return _coco_annotations(spark, sf).select("id", coco.polygon_points(F.col("segmentation")).alias("points"))


@entry("""SELECT DISTINCT l_orderkey AS image, l_linenumber AS cls, round(l_quantity::DOUBLE / 64, 6) AS cx, round(l_discount::DOUBLE, 6) AS cy, 0.25::DOUBLE AS w, round(l_tax::DOUBLE, 6) AS h FROM lineitem WHERE l_orderkey % 20 = 0""")
def label_text(spark, sf):
    """Label lines written as text, a file for each image, and read back with their checks; repeated lines count once."""
    path = scratch(spark, "labels")
    rows = table(spark, sf, "lineitem").where("l_orderkey % 20 = 0").select(F.col("l_orderkey").alias("image"), F.col("l_linenumber").alias("cls"), (F.col("l_quantity") / 64).cast("double").alias("cx"), F.col("l_discount").cast("double").alias("cy"), F.lit(0.25).alias("w"), F.col("l_tax").cast("double").alias("h"))
    sinks.write_label_files(sinks.label_lines(rows, ["cx", "cy", "w", "h"]), path)
    found = coco.label_rows(coco.read_label_files(spark, path))
    image = F.regexp_extract("path", r"image=(\d+)", 1).cast("long")
    return found.select(image.alias("image"), "cls", *[F.round(F.get("coords", F.lit(i)), 6).alias(c) for i, c in enumerate(("cx", "cy", "w", "h"))])


@entry("SELECT n_nationkey, n_name, {'k': n_regionkey}::JSON::VARCHAR AS nested FROM nation")
def csv_round_trip(spark, sf):
    """A table with a nested column written as CSV, which holds it as JSON text, and read back."""
    path = scratch(spark, "csv")
    sinks.write_csv(table(spark, sf, "nation").select("n_nationkey", "n_name", F.struct(F.col("n_regionkey").alias("k")).alias("nested")), path)
    return spark.read.csv(path, header=True, schema="n_nationkey int, n_name string, nested string")


@entry("SELECT p_partkey::BIGINT AS iteration, round(p_retailprice::DOUBLE, 2) AS fitness, round(p_size::DOUBLE / 10, 6) AS lr0 FROM part")
def trial_log(spark, sf):
    """Trials appended to a log in two goes and read with its schema."""
    path = scratch(spark, "trials")
    rows = table(spark, sf, "part").select(F.col("p_partkey").cast("long").alias("iteration"), F.col("p_retailprice").cast("double").alias("fitness"), F.create_map(F.lit("lr0"), F.col("p_size") / 10).alias("hyperparameters"))
    for odd in (0, 1):
        coco_part = rows.where(F.col("iteration") % 2 == odd)
        sinks.append_trial(coco_part, path)
    return coco.read_trials(spark, path).select("iteration", F.round("fitness", 2).alias("fitness"), F.round(F.col("hyperparameters")["lr0"], 6).alias("lr0"))


@entry("SELECT s_suppkey AS epoch, round(s_acctbal::DOUBLE, 2) AS loss FROM supplier")
def results_csv(spark, sf):
    path = scratch(spark, "results")
    sinks.write_csv(table(spark, sf, "supplier").select(F.col("s_suppkey").alias("epoch"), F.col("s_acctbal").cast("double").alias("loss")), path)
    return coco.read_results_csv(spark, path).select(F.col("epoch").cast("long").alias("epoch"), F.round("loss", 2).alias("loss"))


def _image_records(spark, sf):
    row = lambda c: F.array(c.cast("double"), F.lit(0.5), F.lit(0.25))
    boxes = F.transform(F.sequence(F.lit(0), (F.col("p_size") % 3).cast("int")), lambda i: row((F.col("p_partkey") + i) % 6))
    kinds = F.when(F.col("p_partkey") % 5 == 0, F.create_map().cast("map<string,array<array<double>>>")).otherwise(F.create_map(F.lit("boxes"), boxes))
    return table(spark, sf, "part").select(F.col("p_name").alias("file"), F.when(F.col("p_partkey") % 4 == 0, "test").otherwise("train").alias("split"), kinds.alias("annotations"), "p_partkey")


@entry("SELECT p_name AS file, 'boxes' AS kind, k::INT AS i, ((p_partkey + k) % 6)::INT AS cls, 2 AS n_coords FROM part, unnest(range(0, p_size % 3 + 1)) AS t(k) WHERE p_partkey % 5 <> 0")
def manifest_rows(spark, sf):
    return coco.manifest_annotations(_image_records(spark, sf)).select("file", "kind", "i", "cls", F.size("coords").alias("n_coords"))


@entry("SELECT c::INT AS cls, CASE c WHEN 1 THEN 'one' WHEN 7 THEN 'seven' ELSE 'class' || c END AS name FROM unnest(range(0, 8)) AS t(c)")
def filled_names(spark, sf):
    dataset = spark.range(1).select(F.create_map(F.lit("1"), F.lit("one"), F.lit("7"), F.lit("seven")).alias("class_names"))
    return coco.fill_names(_image_records(spark, sf), dataset)


@entry("""
WITH t AS (SELECT p_name AS file, p_partkey % 4 = 0 AS test, row_number() OVER (PARTITION BY p_partkey % 4 = 0 ORDER BY md5('3|' || p_name), p_name) AS r, count(*) OVER (PARTITION BY p_partkey % 4 = 0) AS n FROM (SELECT DISTINCT ON (p_name) p_name, p_partkey FROM part ORDER BY p_name, p_partkey))
SELECT file, CASE WHEN test THEN 'test' WHEN r <= greatest(1, n // 10) THEN 'val' ELSE 'train' END AS split FROM t""")
def carved_validation(spark, sf):
    rows = table(spark, sf, "part").groupBy(F.col("p_name").alias("file")).agg(F.min("p_partkey").alias("k")).select("file", F.when(F.col("k") % 4 == 0, "test").otherwise("train").alias("split"))
    return manifest.carve_validation(rows, 3)


@entry("""
WITH t AS (SELECT o_orderkey AS file, ['train', 'val', 'test'][o_orderkey % 3 + 1] AS split FROM orders),
n AS (SELECT *, row_number() OVER (PARTITION BY split ORDER BY file) - 1 AS r, count(*) OVER (PARTITION BY split) AS n FROM t),
k AS (SELECT *, CASE split WHEN 'train' THEN greatest(1, round_even(n * 0.3::DOUBLE, 0))::INT WHEN 'val' THEN least(n, 11)::INT ELSE 0 END AS take FROM n)
SELECT file, split FROM k WHERE take > 0 AND CASE WHEN take = 1 THEN r = 0 ELSE ceil(r * (take - 1) / (n - 1)::DOUBLE) < take AND floor(ceil(r * (take - 1) / (n - 1)::DOUBLE) * (n - 1) / (take - 1)::DOUBLE) = r END""")
def sampled_splits(spark, sf):
    """Of each split a share, a count or nothing, at equal distances."""
    rows = table(spark, sf, "orders").select(F.col("o_orderkey").alias("file"), F.element_at(F.array(F.lit("train"), F.lit("val"), F.lit("test")), (F.col("o_orderkey") % 3 + 1).cast("int")).alias("split"))
    return manifest.sample_splits(rows, [0.3, 11, 0])


@entry("""
WITH i AS (SELECT n_nationkey AS k, '/d/images/' || n_name || e AS path, r FROM nation, (VALUES ('.png', 2), ('.jpg', 1), ('.txt', 9)) AS v(e, r) WHERE n_nationkey % 3 <> 0 OR e <> '.jpg')
SELECT n_name AS stem, (SELECT arg_min(path, r) FROM i WHERE k = n_nationkey AND r < 9) AS image_path FROM nation""")
def paired_images(spark, sf):
    nations = table(spark, sf, "nation")
    suffix = F.explode(F.array(F.lit(".PNG"), F.lit(".jpg"), F.lit(".txt")))
    images = nations.select("n_nationkey", "n_name", suffix.alias("e")).where("n_nationkey % 3 <> 0 OR e <> '.jpg'").select(F.concat(F.lit("/d/images/"), F.col("n_name"), F.lower("e")).alias("path"))
    return coco.pair_by_stem(nations.select(F.concat(F.lit("/d/labels/"), F.col("n_name"), F.lit(".txt")).alias("path")), images, ["jpg", "png"]).select("stem", "image_path")


@entry("""
WITH a AS (SELECT l_orderkey AS image_id, l_orderkey * 10 + l_linenumber AS id, lower(trim(substring(s, l_linenumber::INT, 4) || ' ' || substring(s, 1, 2))) AS phrase FROM lineitem JOIN (SELECT o_orderkey, o_orderpriority || ' caption' AS s FROM orders) ON o_orderkey = l_orderkey WHERE l_partkey % 10 <> 0 AND l_quantity % 5 > 0),
f AS (SELECT image_id, phrase, row_number() OVER (PARTITION BY image_id ORDER BY min(id)) - 1 AS number FROM a WHERE phrase <> '' GROUP BY image_id, phrase)
SELECT a.image_id, a.id, phrase, number::INT AS number FROM a JOIN f USING (image_id, phrase)""")
def grounding_phrases(spark, sf):
    images = table(spark, sf, "orders").select(F.col("o_orderkey").cast("long").alias("id"), F.concat("o_orderpriority", F.lit(" caption")).alias("caption"))
    line, zero = F.col("id") % 10, F.lit(0).cast("long")
    spans = F.array(F.array(line - 1, line + 3), F.array(zero, zero + 2))
    return coco.grounding_phrases(images, _coco_annotations(spark, sf).withColumn("tokens_positive", spans))


@entry("SELECT sha256(sum(p_size)::VARCHAR || string_agg(p_name, '' ORDER BY p_name)) AS digest FROM part")
def digest_of_files(spark, sf):
    return etl.digest_of_files(table(spark, sf, "part"), "p_name", "p_size")


@entry("""SELECT p_partkey, '/data/labels/' || p_brand || '/' || p_partkey || '.txt' AS label, p_brand AS folder, p_partkey::VARCHAR AS stem, p_size || ' ' || p_type || CASE WHEN p_size > 1 THEN 's' ELSE '' END AS phrase FROM part""")
def paths_and_phrases(spark, sf):
    path = F.concat(F.lit("/data/images/"), F.col("p_brand"), F.lit("/"), F.col("p_partkey").cast("string"), F.lit(".jpeg"))
    return table(spark, sf, "part").select("p_partkey", label_path(path).alias("label"), folder_class(path).alias("folder"), stem(path).alias("stem"), count_phrase(F.col("p_size"), F.col("p_type")).alias("phrase"))


@entry(f"""WITH {ANN} SELECT image, cls || ' ' || printf('%g', conf) || ' ' || printf('%g', x2) || ' ' || printf('%g', x2 / 3) AS value FROM ann""")
def label_lines(spark, sf):
    rows = annotations(spark, sf).withColumns({"a": F.col("conf"), "b": F.col("x2"), "c": F.col("x2") / 3})
    return sinks.label_lines(rows, ["a", "b", "c"])


@entry(f"WITH {ANN} SELECT image::VARCHAR AS image_id, cls AS category_id, x1 AS left_, y1 AS top, x2 - x1 AS width, y2 - y1 AS height, round_even(conf, 5) AS score FROM ann")
def coco_predictions(spark, sf):
    rows = annotations(spark, sf).withColumn("image", F.lpad(F.col("image").cast("string"), 12, "0"))
    return sinks.coco_predictions(rows).select("image_id", "category_id", *[F.get("bbox", F.lit(i)).alias(n) for i, n in enumerate(("left_", "top", "width", "height"))], "score")


@entry(f"WITH {ANN} SELECT image, cls AS name, round_even(conf, 5) AS confidence, round_even(x1 / 640, 5) AS x1, round_even(y2 / 480, 5) AS y2 FROM ann")
def detection_records(spark, sf):
    rows = sinks.detection_records(annotations(spark, sf), width=F.lit(640.0), height=F.lit(480.0))
    return rows.select("image", "name", "confidence", "box.x1", "box.y2")


@entry(f"""WITH {ANN}, b AS (SELECT image, i, conf, x1, y1, x2, y2, [conf, x1 / 60 - 0.05::DOUBLE, y2 / 55] AS c FROM ann)
SELECT image, i, (list_max(c) <= 1.01::DOUBLE AND list_min(c) >= -0.01::DOUBLE AND i BETWEEN 0 AND 5) AS sound FROM b""")
def valid_labels(spark, sf):
    rows = annotations(spark, sf).withColumn("coords", F.array("conf", F.col("x1") / 60 - 0.05, F.col("y2") / 55))
    return rows.select("image", "i", etl.valid_labels(rows, "i", "coords", 6, 3).alias("sound"))


# Sets of rows


@entry(f"WITH {ANN}, a AS (SELECT image, i, cls, 1 AS side FROM ann WHERE i % 2 = 0), b AS (SELECT image, i, cls, 2 AS side FROM ann WHERE i % 3 = 0) SELECT * FROM a UNION ALL SELECT * FROM b WHERE i % 2 <> 0")
def union_by_key(spark, sf):
    rows = annotations(spark, sf).select("image", "i", "cls")
    first, second = (rows.where(F.col("i") % n == 0).withColumn("side", F.lit(k)) for k, n in ((1, 2), (2, 3)))
    return matching.union_by_key(first, second, ["image", "i"])


@entry(f"WITH {ANN} SELECT image, i FROM ann WHERE i % 3 <> 0 OR image % 2 = 0")
def left_over(spark, sf):
    rows = annotations(spark, sf).select("image", "i")
    return matching.unmatched(rows, rows.where("i % 3 = 0 AND image % 2 <> 0"), ["image", "i"])


@entry(f"WITH {ANN} SELECT image % 16 AS place, image, i, cls FROM ann WHERE image % 3 = 0")
def collated(spark, sf):
    order = table(spark, sf, "orders").where("o_orderkey % 3 = 0").select(F.col("o_orderkey").alias("image"), (F.col("o_orderkey") % 16).alias("place"))
    return augment.batch_rows(annotations(spark, sf).select("image", "i", "cls"), order).select("place", "image", "i", "cls")


@entry("SELECT p_partkey, row_number() OVER (ORDER BY TRY_CAST(s AS BIGINT) IS NULL, TRY_CAST(s AS BIGINT), s) AS place FROM (SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN p_name || p_partkey ELSE (p_partkey * 37 % 1009 + p_partkey * 1010)::VARCHAR END AS s FROM part)")
def numeric_names_first(spark, sf):
    """Places in the order of names: numeric ones by number, then the others."""
    name = F.when(F.col("p_partkey") % 3 == 0, F.concat("p_name", F.col("p_partkey").cast("string"))).otherwise((F.col("p_partkey") * 37 % 1009 + F.col("p_partkey") * 1010).cast("string"))
    rows = etl.with_numeric_key(table(spark, sf, "part").select("p_partkey", name.alias("s")), "s")
    return etl.dense_numbers(rows, ["not_a_number", "number", "s"], "place").select("p_partkey", F.col("place").cast("long").alias("place"))


_BATCHES = "(SELECT ceil(count(*) / 8.0::DOUBLE)::INT FROM orders)"


@entry(f"""
WITH b AS (SELECT o_orderkey, ((row_number() OVER (ORDER BY o_orderkey) - 1) // 8)::INT AS n, {_BATCHES} // 3 AS each_, {_BATCHES} % 3 AS more FROM orders)
SELECT o_orderkey, (CASE WHEN n < more * (each_ + 1) THEN n // (each_ + 1) ELSE more + (n - more * (each_ + 1)) // greatest(1, each_) END)::INT AS rank FROM b""")
def rank_of_rows(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey")
    return etl.dense_numbers(rows, ["o_orderkey"], "r", 0).select("o_orderkey", etl.rank_of_batch(F.col("r"), rows.count(), 8, 3).alias("rank"))


@entry("""
WITH w AS (SELECT DISTINCT p_type AS label FROM part), own AS (SELECT DISTINCT p_size AS image, p_type AS label FROM part),
neg AS (SELECT label FROM w ORDER BY md5('6|' || label), label LIMIT 12),
every AS (SELECT image, label, 0 AS g, md5('5|' || label) AS k FROM own UNION ALL SELECT image, label, 1, md5('6|' || label) FROM (SELECT DISTINCT image FROM own), neg WHERE (image, label) NOT IN (SELECT image, label FROM own))
SELECT image, label, (row_number() OVER (PARTITION BY image ORDER BY g, k, label) - 1)::INT AS number, g = 0 AS present FROM every QUALIFY number < 6""")
def sampled_labels(spark, sf):
    parts = table(spark, sf, "part").select(F.col("p_size").alias("image"), F.col("p_type").alias("label"))
    return manifest.sample_labels(parts, parts.select("label").distinct(), 6, 5)


@entry("""SELECT k::INT AS id, CASE WHEN k IN (12, 26, 29, 30, 45, 66, 68, 69, 71, 83, 91) THEN NULL
  ELSE (k - 1 - len(list_filter([12, 26, 29, 30, 45, 66, 68, 69, 71, 83, 91], lambda u: u < k)))::INT END AS cls FROM unnest(range(1, 92)) AS t(k)""")
def class_table(spark, sf):
    return manifest.class_table_91_to_80(spark)


@entry("SELECT trim(s) AS synonym, count(*) AS n FROM (SELECT unnest(string_split(p_type || ' / ' || p_brand, '/')) AS s FROM part) GROUP BY 1")
def synonym_counts(spark, sf):
    return reports.synonym_counts(table(spark, sf, "part").select(F.concat("p_type", F.lit(" / "), "p_brand").alias("name")), "name")


@entry(f"WITH {ANN}, n AS (SELECT cls, image, count(*) AS n FROM ann GROUP BY 1, 2) SELECT cls, max(n) AS most FROM n GROUP BY 1")
def most_objects(spark, sf):
    return reports.most_objects(annotations(spark, sf), "cls", "image")


@entry(f"WITH {ANN}, n AS (SELECT cls, image, count(*) AS n FROM ann GROUP BY 1, 2) SELECT cls, greatest(3, max(n)) AS max_det FROM n GROUP BY 1")
def detection_limits(spark, sf):
    return reports.detection_limits(annotations(spark, sf), "cls", "image", 3)


@entry(f"WITH {ANN} SELECT image, i FROM (SELECT image, i, count(*) AS n FROM (SELECT image, i FROM ann UNION ALL SELECT image, i FROM ann WHERE i % 4 = 1) GROUP BY 1, 2) WHERE n > 1")
def repeated_keys(spark, sf):
    rows = annotations(spark, sf).select("image", "i")
    return etl.repeated(rows.unionAll(rows.where("i % 4 = 1")), ["image", "i"]).select("image", "i")


@entry("""
SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN 'missing' WHEN p_size % 4 <> 1 AND p_size % 4 <> 2 THEN 'not a grid of numbers' WHEN abs(ln((p_size / 10.0::DOUBLE) / 2)) > 0.5::DOUBLE THEN 'other shape' END AS depth_fault,
  CASE WHEN p_size % 3 = 0 THEN 'missing' WHEN p_size <> 20 THEN 'other size' WHEN p_partkey % 4 > 1 THEN 'class out of range' END AS mask_fault FROM part""")
def companion_faults(spark, sf):
    """Why a depth map or a mask beside an image can't be used."""
    rows = table(spark, sf, "part")
    there = F.when(F.col("p_size") % 3 != 0, F.lit("x"))
    form = F.element_at(F.array(F.lit("png8"), F.lit("npy"), F.lit("png16"), F.lit("jpg")), (F.col("p_size") % 4 + 1).cast("int"))
    depth = manifest.depth_fault(there, form, F.lit(20.0), F.lit(10.0), F.col("p_size").cast("double"), F.lit(10.0), 0.5)
    mask = manifest.mask_fault(there, F.lit(20), F.lit(10), F.col("p_size"), F.lit(10), (F.col("p_partkey") % 4).cast("int"), 2)
    return rows.select("p_partkey", depth.alias("depth_fault"), mask.alias("mask_fault"))


# Curves and statistics


@entry("""
WITH c AS (SELECT event_id % 40 AS x, avg(value) AS y FROM events GROUP BY 1), p AS (SELECT x AS spot, y FROM c UNION ALL SELECT -k, y FROM c, unnest(range(1, 6)) AS t(k) WHERE x = 0 UNION ALL SELECT 39 + k, y FROM c, unnest(range(1, 6)) AS t(k) WHERE x = 39)
SELECT x, round((SELECT avg(y) FROM p WHERE spot BETWEEN x - 2 AND x + 2), 6) AS smooth_y FROM c""")
def smoothed_curve(spark, sf):
    points = table(spark, sf, "events").groupBy((F.col("event_id") % 40).alias("x")).agg(F.avg("value").alias("y"))
    return curves.smooth_curve(points, "x", "y", 40, 0.12).select("x", six("smooth_y"))


_WEIGHTS = [exp(-0.5 * (k / 1.5) ** 2) for k in range(-6, 7)]


@entry(f"""
WITH c AS (SELECT event_id % 30 AS x, avg(value) AS y FROM events GROUP BY 1), w AS (SELECT * FROM (VALUES {', '.join(f'({k}, {v / sum(_WEIGHTS)!r}::DOUBLE)' for k, v in zip(range(-6, 7), _WEIGHTS))}) AS v(k, g))
SELECT c.x, round(sum(g * o.y), 6) AS smooth_y FROM c, w JOIN c o ON o.x = least(greatest(c.x + k, 0), 29) GROUP BY c.x""")
def gaussian_curve(spark, sf):
    points = table(spark, sf, "events").groupBy((F.col("event_id") % 30).alias("x")).agg(F.avg("value").alias("y"))
    return manifest.gaussian_smooth(points, "x", "y", 1.5).select("x", six("smooth_y"))


@entry("SELECT p_partkey, round_even(least(greatest(p_retailprice::DOUBLE / 7, 150.0::DOUBLE), 190.0::DOUBLE), 5) AS bounded, round_even(least(greatest(p_size * 1.5::DOUBLE, 3.0::DOUBLE), 40.0::DOUBLE), 0) AS whole, abs(ln((p_size + 10.0::DOUBLE) / 20 / (30.0::DOUBLE / 20))) <= 0.2::DOUBLE AS alike FROM part")
def bounded_parameters(spark, sf):
    """Parameters within their bounds, and sizes of nearly the same aspect."""
    alike = manifest.like_aspect(F.lit(30.0), F.lit(20.0), F.col("p_size") + 10.0, F.lit(20.0), 0.2)
    return table(spark, sf, "part").select("p_partkey", manifest.clamp(F.col("p_retailprice").cast("double") / 7, 150, 190).alias("bounded"), manifest.clamp(F.col("p_size") * 1.5, 3, 40, whole=True).alias("whole"), alike.alias("alike"))


_PIXELS = "px AS (SELECT o_custkey AS image, ln(o_totalprice::DOUBLE) AS lg, ln(o_totalprice::DOUBLE * 1.3 + o_orderkey % 50 * 1000) AS lp FROM orders)"


@entry(f"""
WITH {_PIXELS}, f AS (SELECT image % 2 AS fold, sum(lg - lp) AS s, count(*) AS n FROM px GROUP BY 1), o AS (SELECT fold, (sum(s) OVER () - s) / (sum(n) OVER () - n) AS shift FROM f),
i AS (SELECT image, avg((abs(lp - lg) < ln(1.25::DOUBLE))::INT::DOUBLE) AS plain, avg((abs(lp + shift - lg) < ln(1.25::DOUBLE))::INT::DOUBLE) AS shifted FROM px JOIN o ON fold = image % 2 GROUP BY 1)
SELECT round(avg(plain), 6) AS plain, round(avg(shifted), 6) AS shifted, avg(shifted) > avg(plain) + 0.02::DOUBLE AS shift FROM i""")
def chosen_offset(spark, sf):
    pairs = table(spark, sf, "orders").select(F.col("o_custkey").alias("image"), F.ln(F.col("o_totalprice").cast("double")).alias("lg"), F.ln(F.col("o_totalprice").cast("double") * 1.3 + F.col("o_orderkey") % 50 * 1000).alias("lp"))
    return metrics.choose_offset(pairs, 2, 0.02).select(six("plain"), six("shifted"), "shift")


@entry("SELECT l_orderkey, round(count(*) FILTER (l_quantity > 28)::DOUBLE / nullif(count(*) FILTER (l_quantity > 22), 0), 6) AS stability FROM lineitem GROUP BY 1")
def mask_stability(spark, sf):
    return metrics.stability(table(spark, sf, "lineitem"), "l_quantity", 25, 3, ["l_orderkey"]).select("l_orderkey", six("stability"))


@entry("""
WITH v AS (SELECT toxic AS p, quality AS a FROM labels WHERE toxic IN (0, 1) AND quality IN (0, 1)),
c AS (SELECT k AS cls, (SELECT count(*) FROM v WHERE p = k) AS r, (SELECT count(*) FROM v WHERE a = k) AS col, (SELECT count(*) FROM v WHERE a = k AND p = k) AS hit FROM (VALUES (0), (1)) AS t(k))
SELECT round(avg(CASE WHEN col > 0 THEN hit::DOUBLE / (r + col - hit) END), 6) AS miou, round(sum(hit) / (sum(col) + 1e-10::DOUBLE), 6) AS pixel_accuracy FROM c""")
def semantic_summary(spark, sf):
    return metrics.semantic_summary(metrics.semantic_iou(table(spark, sf, "labels"), "toxic", "quality", 2)).select(six("miou"), six("pixel_accuracy"))


@entry(f"""
WITH {FRAMES}, h AS (SELECT floor(cx)::INT AS px, count(*) AS heat FROM frames GROUP BY 1), b AS (SELECT min(heat) AS lo, max(heat) AS hi FROM h)
SELECT px, heat, round((heat - lo)::DOUBLE / greatest(hi - lo, 1) * 255, 6) AS level FROM h, b""")
def heat_levels(spark, sf):
    cells = frames(spark, sf).groupBy(F.floor("cx").cast("int").alias("px")).agg(F.count("*").alias("heat"))
    return trajectories.normalised_heat(cells).select("px", "heat", six("level"))


@entry(f"WITH {FRAMES} SELECT track, frame FROM frames WHERE frame % 4 = 0")
def every_fourth_frame(spark, sf):
    return trajectories.stride(frames(spark, sf), 4).select("track", "frame")


@entry("SELECT p_brand, p_partkey, p_retailprice::DOUBLE AS y FROM (SELECT *, lag(p_retailprice) OVER (PARTITION BY p_brand ORDER BY p_partkey) AS b FROM part) WHERE b IS NULL OR p_retailprice > b")
def rising_samples(spark, sf):
    rows = table(spark, sf, "part").withColumn("y", F.col("p_retailprice").cast("double"))
    return metrics.rising_samples(rows, "p_partkey", "y", ["p_brand"]).select("p_brand", "p_partkey", "y")


@entry("SELECT event_id, value FROM events ORDER BY (event_type = 'click')::INT DESC, value DESC, event_id LIMIT 1")
def best_trial(spark, sf):
    """The report of the best trial: one row is the feature."""
    return metrics.best_trial(table(spark, sf, "events"), "value", F.col("event_type") == "click", "event_id").select("event_id", "value")


_RANKED = f"""{ANN}, cand AS (SELECT d.image, d.cls, det, gt, conf, {sql_iou('d', 'g')} AS iou FROM det d JOIN gt g ON d.image = g.image AND d.cls = g.cls),
once AS (SELECT *, row_number() OVER (PARTITION BY image, cls, det ORDER BY iou DESC, gt) AS r FROM cand WHERE iou >= 0.5::DOUBLE),
hit AS (SELECT image, cls, det FROM (SELECT *, row_number() OVER (PARTITION BY image, cls, gt ORDER BY det) AS q FROM once WHERE r = 1) WHERE q = 1),
n AS (SELECT cls, count(*) AS n_truth FROM gt GROUP BY cls),
ranked AS (SELECT d.cls, d.image, d.det, conf, h.det IS NOT NULL AS tp, row_number() OVER o AS rank, sum((h.det IS NOT NULL)::INT) OVER (PARTITION BY d.cls ORDER BY conf DESC, d.image, d.det ROWS UNBOUNDED PRECEDING) AS hits
  FROM det d LEFT JOIN hit h USING (image, cls, det) WINDOW o AS (PARTITION BY d.cls ORDER BY conf DESC, d.image, d.det))"""
#: Precision and recall at each of 1,000 confidences: between the last detection at least as sure and the one after it.
CURVES = f"""{_RANKED}, shaped AS (SELECT cls, rank, conf, hits / (n_truth + 1e-16::DOUBLE) AS recall, hits::DOUBLE / rank AS precision FROM ranked JOIN n USING (cls)),
grid AS (SELECT cls, k AS point, k * (1.0::DOUBLE / 999) AS spot FROM n, unnest(range(0, 1000)) AS t(k)),
last AS (SELECT grid.cls, point, spot, (SELECT max(rank) FROM shaped s WHERE s.cls = grid.cls AND s.conf >= spot - 1e-9::DOUBLE / 999) AS rank FROM grid),
pr AS (SELECT l.cls, point, s.rank IS NULL AS above,
  CASE WHEN b.conf IS NULL OR b.conf = s.conf THEN s.precision ELSE s.precision + (b.precision - s.precision) * (s.conf - spot) / (s.conf - b.conf) END AS p,
  CASE WHEN b.conf IS NULL OR b.conf = s.conf THEN s.recall ELSE s.recall + (b.recall - s.recall) * (s.conf - spot) / (s.conf - b.conf) END AS r
  FROM last l LEFT JOIN shaped s ON s.cls = l.cls AND s.rank = l.rank LEFT JOIN shaped b ON b.cls = l.cls AND b.rank = l.rank + 1),
curves AS (SELECT cls, point, CASE WHEN above THEN 1.0::DOUBLE ELSE greatest(p, 0.0::DOUBLE) END AS precision, CASE WHEN above THEN 0.0::DOUBLE ELSE greatest(r, 0.0::DOUBLE) END AS recall FROM pr),
f1 AS (SELECT *, 2 * precision * recall / (precision + recall + 1e-16::DOUBLE) AS f1 FROM curves)"""
BEST_F1 = f"""{CURVES}, mean AS (SELECT point, avg(f1) AS y FROM f1 GROUP BY point),
wide AS (SELECT point AS spot, y FROM mean UNION ALL SELECT -k, y FROM mean, unnest(range(1, 51)) AS t(k) WHERE point = 0 UNION ALL SELECT 999 + k, y FROM mean, unnest(range(1, 51)) AS t(k) WHERE point = 999),
smooth AS (SELECT spot AS point, avg(y) OVER (ORDER BY spot RANGE BETWEEN 50 PRECEDING AND 50 FOLLOWING) AS s FROM wide),
top AS (SELECT point FROM smooth WHERE point BETWEEN 0 AND 999 ORDER BY round(s, 12) DESC, point LIMIT 1)"""


@entry(f"WITH {CURVES} SELECT cls, point, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1 FROM f1")
def confidence_curves(spark, sf):
    from .views import detections, ground_truth

    d, g = detections(spark, sf), ground_truth(spark, sf)
    return curves.confidence_curves(d, g, matching.match_at_thresholds(d, g, [0.5])).select("cls", "point", six("precision"), six("recall"), six("f1"))
