"""Readers and writers on small files."""

from __future__ import annotations

import io
import json

import pytest
from pyspark.sql import functions as F

from framelens.sources import coco, sinks


def test_coco_labels(spark, tmp_path):
    doc = {
        "images": [{"id": 1, "width": 100, "height": 50, "file_name": "a.jpg"}],
        "annotations": [
            {"id": i, "image_id": 1, "category_id": c, "bbox": b, "iscrowd": crowd, "segmentation": [[1, 2, 3, 4, 5, 6]]}
            for i, c, b, crowd in ((1, 1, [10, 10, 20, 20], 0), (2, 1, [10, 10, 20, 20], 0), (3, 2, [10, 10, 0, 20], 0), (4, 2, [0, 0, 10, 10], 1), (5, 3, [0, 0, 50, 50], 0))
        ],
        "categories": [{"id": 1, "name": "x"}],
    }
    (tmp_path / "c.json").write_text(json.dumps(doc))
    tables = coco.read_coco(spark, str(tmp_path / "c.json"))
    assert tables["annotations"].select(coco.polygon_points(F.col("segmentation"))).first()[0] == 3
    rows = coco.coco_labels(tables["images"], tables["annotations"]).orderBy("id").collect()
    assert [(r.id, r.cls, r.cx, r.cy, r.w, r.h) for r in rows] == [(1, 0, 0.2, 0.4, 0.2, 0.4), (5, 2, 0.25, 0.5, 0.5, 1.0)]


def test_manifest(spark, tmp_path):
    lines = [{"type": "image", "file": "a.jpg", "split": "train", "annotations": {"boxes": [[2, 0.5, 0.5, 0.1, 0.1]], "other": [[0, 1, 1, 1, 1]]}}, {"type": "dataset", "task": "detect", "class_names": {"0": "cat"}}, {"type": "image", "file": "b.jpg", "split": "val"}]
    (tmp_path / "m.ndjson").write_text("\n".join(map(json.dumps, lines)))
    dataset, images = coco.read_manifest(spark, str(tmp_path / "m.ndjson"))
    assert (dataset.count(), images.count()) == (1, 2)
    assert [(r.file, r.kind, r.cls, r.coords) for r in coco.manifest_annotations(images).collect()] == [("a.jpg", "boxes", 2, [0.5, 0.5, 0.1, 0.1])]
    assert [(r.cls, r.name) for r in coco.fill_names(images, dataset).orderBy("cls").collect()] == [(0, "cat"), (1, "class1"), (2, "class2")]


def test_label_files(spark, tmp_path):
    files = {"good": "0 .5 .5 .1 .1\n0 .5 .5 .1 .1\n", "empty": "\n", "six": "0 1 1 1 1 1\n", "poly": "0 .1 .1 .2 .2 .3 .3\n", "mixed": "0 .5 .5 .1 .1\n0 .1 .1 .2 .2 .3 .3\n", "far": "0 1.5 .5 .1 .1\n", "minus": "0 -.5 .5 .1 .1\n", "text": "0 a b c d\n", "cls": "9 .5 .5 .1 .1\n"}
    for name, text in files.items():
        (tmp_path / f"{name}.txt").write_text(text)
    read = coco.read_label_files(spark, str(tmp_path), n_classes=3)
    got = {r.path.rsplit("/", 1)[1][:-4]: (len(r.lines), r.n_repeated, r.fault) for r in read.collect()}
    assert got["good"] == (1, 1, None) and got["empty"] == (0, 0, None) and got["poly"][2] is None
    assert {n: got[n][2] is not None for n in files} == {n: n not in ("good", "empty", "poly") for n in files}
    images = spark.createDataFrame([(f"/x/images/{n}.jpg",) for n in (*files, "none")], "path string")
    assert tuple(coco.scan_counts(images, read).first()) == (1, len(files), 1, 6)
    assert {r.cls for r in coco.label_rows(read).collect()} == {0}


def test_keypoint_shape(spark):
    three = spark.createDataFrame([([0.5] * 4 + [0.1, 0.2, 2.0, 0.3, 0.4, 0.0],)], "coords array<double>")
    two = spark.createDataFrame([([0.5] * 4 + [0.1, 0.2, 0.3, 0.4],)], "coords array<double>")
    assert tuple(coco.keypoint_shape(three).first()) == (2, 3)
    assert tuple(coco.keypoint_shape(two).first()) == (2, 2)


def test_phrases(spark):
    images = spark.createDataFrame([(1, "a red car and a man")], "id long, caption string")
    ann = spark.createDataFrame([(7, 1, [0.0, 0.0, 5.0, 5.0], 0, [[2, 9]]), (8, 1, [0.0, 0.0, 5.0, 5.0], 0, [[16, 19]]), (9, 1, [0.0, 0.0, 5.0, 5.0], 0, [[2, 9]]), (10, 1, [0.0, 0.0, 0.0, 5.0], 0, [[2, 9]])], "id long, image_id long, bbox array<double>, iscrowd int, tokens_positive array<array<int>>")
    assert [(r.id, r.phrase, r.number) for r in coco.grounding_phrases(images, ann).orderBy("id").collect()] == [(7, "red car", 0), (8, "man", 1), (9, "red car", 0)]


def test_pair_by_stem(spark):
    labels = spark.createDataFrame([("/l/a.txt",), ("/l/b.txt",)], "path string")
    images = spark.createDataFrame([("/i/a.png",), ("/i/a.jpg",)], "path string")
    assert {r.stem: r.image_path for r in coco.pair_by_stem(labels, images, ["jpg", "png"]).collect()} == {"a": "/i/a.jpg", "b": None}


def test_writers(spark, tmp_path):
    dets = spark.createDataFrame([("007", 0, 1, 0.123456, 1.0, 2.0, 4.5, 8.25)], "image string, det long, cls int, conf double, x1 double, y1 double, x2 double, y2 double")
    row = sinks.coco_predictions(dets).first()
    assert (row.image_id, row.bbox, row.score) == ("7", [1.0, 2.0, 3.5, 6.25], 0.12346)
    sinks.write_label_files(sinks.label_lines(dets, ["x1", "y1"], with_conf=True), str(tmp_path / "labels"))
    assert spark.read.text(str(tmp_path / "labels")).first().value == "1 1 2 0.123456"
    sinks.write_csv(sinks.detection_records(dets), str(tmp_path / "csv"))
    assert json.loads(spark.read.csv(str(tmp_path / "csv"), header=True, quote='"', escape="\\").first().box)["x2"] == 4.5
    assert json.loads(sinks.image_documents(dets).first().document)["shapes"]


@pytest.mark.parametrize("piece", [1, 7, 64, 1 << 20])
def test_records_of_a_document_in_pieces(piece):
    doc = {"info": {"images": [1, 2]}, "images": [{"id": 1, "t": "é\"]},[{"}, {"id": 2}], "n": 12, "annotations": [], "categories": [3, [4, "x"], None, "end"]}
    for text in (json.dumps(doc, ensure_ascii=False), json.dumps(doc, indent=2)):
        found = list(coco.json_records(io.BytesIO(text.encode()), ("images", "annotations", "categories"), piece))
        assert [(k, json.loads(v)) for k, v in found] == [("images", x) for x in doc["images"]] + [("categories", x) for x in doc["categories"]]
    with pytest.raises(ValueError):
        list(coco.json_records(io.BytesIO(b"[1]"), ("images",)))
    with pytest.raises(ValueError):
        list(coco.json_records(io.BytesIO(b'{"images": [{"id": 1'), ("images",)))


def test_a_label_file_for_each_image(spark, tmp_path):
    """A folder and a commit's move for each image took most of the time: there are folders for partitions only."""
    rows = spark.range(3_000).select(F.concat(F.lit("a b/"), F.col("id").cast("string")).alias("image"), F.explode(F.sequence(F.lit(0), F.lit(1))).alias("cls"), *[F.lit(v).alias(c) for c, v in (("cx", 0.5), ("cy", 0.25), ("w", 0.1), ("h", 0.125))])
    lines = sinks.label_lines(rows, ["cx", "cy", "w", "h"])
    path = str(tmp_path / "labels")
    sinks.write_label_files(lines, path)
    assert sum(p.is_dir() for p in (tmp_path / "labels").rglob("*")) <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    files = [p.name for p in (tmp_path / "labels").rglob("*") if p.is_file()]
    assert len(files) == len(set(files)) == 3_000 and "image=a b%2F7.txt" in files
    read = coco.read_label_files(spark, path).collect()
    assert len(read) == 3_000 and all(r.fault is None and r.lines == [[0.0, 0.5, 0.25, 0.1, 0.125], [1.0, 0.5, 0.25, 0.1, 0.125]] for r in read)
    with pytest.raises(FileExistsError):
        sinks.write_label_files(lines, path)
    sinks.write_label_files(lines.limit(0), path, "ignore")
    sinks.write_label_files(lines.where("image = 'a b/7'"), path, "append")
    assert coco.label_rows(coco.read_label_files(spark, path)).count() == 6_002
    sinks.write_label_files(lines.where("image = 'a b/7'").withColumn("image", F.lit(None).cast("string")), path, "overwrite")
    assert [(r.path.rsplit("/", 1)[1], len(r.lines)) for r in coco.read_label_files(spark, f"file://{path}").collect()] == [("image=__HIVE_DEFAULT_PARTITION__.txt", 2)]


def test_label_files_in_folders(spark, tmp_path):
    """Names as Spark gives them, hidden files left out, empty folders, wildcards and several paths."""
    for name in ("a/x y.txt", "a/b/é.txt", "top.txt", "_SUCCESS", ".x.txt.crc", "a/_temporary/z.txt"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text("0 .5 .5 .1 .1\n")
    (tmp_path / "none").mkdir()
    spark_names = {r.p for r in spark.read.text(str(tmp_path), wholetext=True, recursiveFileLookup=True).select(F.col("_metadata.file_path").alias("p")).collect()}
    assert len(spark_names) == 3
    names = lambda path: {r.path for r in coco.read_label_files(spark, path).collect()}
    assert names(str(tmp_path)) == spark_names
    assert names(str(tmp_path / "*.txt")) == names(str(tmp_path / "top.txt")) == {n for n in spark_names if n.endswith("top.txt")}
    assert names([str(tmp_path / "a"), str(tmp_path / "top.txt")]) == spark_names and names(str(tmp_path / "none")) == set()


def test_all_documents_of_a_file(spark, tmp_path):
    docs = [{"images": [{"id": i, "width": 10, "height": 10}], "annotations": [{"id": 10 * i + k, "image_id": i} for k in range(3)]} for i in range(4)]
    (tmp_path / "c.json").write_text("\n".join(map(json.dumps, docs)))
    read = coco.read_large_coco(spark, str(tmp_path / "c.json"), 16)
    assert sorted(r.id for r in read["annotations"].collect()) == [10 * i + k for i in range(4) for k in range(3)]
    assert sorted(r.id for r in read["images"].collect()) == [0, 1, 2, 3]


def test_a_file_for_each_document(spark):
    """The documents' rows come from several partitions, as on larger tables."""
    from framelens.plans import datasets

    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        path = datasets._coco_documents(spark, "/root/testdata/sf0.001")
    finally:
        spark.conf.set(key, before)
    files = spark.read.text(path, wholetext=True).collect()
    assert len(files) >= 4 and all(len(r.value.strip().split("\n")) == 1 for r in files)
    images = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").count()
    assert coco.read_coco(spark, path)["images"].count() == coco.read_large_coco(spark, path)["images"].count() == images


def test_records_are_not_broadcast_by_the_size_of_file_names(spark, tmp_path):
    """Names of a few files are small where their records aren't."""
    images = spark.range(20_000).select(F.col("id"), F.lit(10).alias("width"), F.lit(10).alias("height"), (F.col("id") % 4).alias("part"))
    boxes = spark.range(20_000).select(F.col("id"), F.col("id").alias("image_id"), F.lit(1).alias("category_id"), F.array(*[F.lit(v) for v in (0.0, 0.0, 2.0, 2.0)]).alias("bbox"), (F.col("id") % 4).alias("part"))
    sinks.write_sections({"images": images, "annotations": boxes}, "part", str(tmp_path / "d"))
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "64k")
    try:
        read = coco.read_large_coco(spark, str(tmp_path / "d"))
        labels = coco.coco_labels(read["images"], read["annotations"])
        assert len(labels.collect()) == 20_000
        assert "BroadcastHashJoin" not in labels._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(key, before)


def test_documents_of_sections(spark, tmp_path):
    """Rows of a document pass one by one; sections that a document lacks are empty lists."""
    path = str(tmp_path / "d")
    a = spark.createDataFrame([("x/1", 1, 'é"\n'), ("x/1", 2, None), ("y", 3, "t"), (None, 4, "n")], "p string, id long, t string")
    b = spark.createDataFrame([("x/1", 7), ("z", 8)], "p string, id long")
    sinks.write_sections({"images": a, "annotations": b.limit(0), "categories": b}, "p", path)
    files = {f.name.rsplit("-", 1)[0]: f.read_text() for f in (tmp_path / "d").iterdir() if not f.name.startswith(".")}
    docs = {k: json.loads(v) for k, v in files.items()}
    assert set(docs) == {"part=x%2F1", "part=y", "part=z", "part=__HIVE_DEFAULT_PARTITION__"} and all(v.count("\n") == 1 for v in files.values())
    assert sorted(docs["part=x%2F1"]["images"], key=lambda r: r["id"]) == [{"id": 1, "t": 'é"\n'}, {"id": 2}]
    assert docs["part=x%2F1"]["categories"] == [{"id": 7}] and docs["part=z"] == {"images": [], "annotations": [], "categories": [{"id": 8}]}
    assert docs["part=y"] == {"images": [{"id": 3, "t": "t"}], "annotations": [], "categories": []}
    with pytest.raises(FileExistsError):
        sinks.write_sections({"images": a}, "p", path)
    sinks.write_sections({"images": a}, "p", path, "append")
    assert coco.read_coco(spark, path)["images"].count() == coco.read_large_coco(spark, path)["images"].count() == 8
    sinks.write_sections({"images": a.limit(0)}, "p", path, "overwrite")
    assert not [f for f in (tmp_path / "d").iterdir() if not f.name.startswith(".")]


def test_arrays_that_are_passed_over_are_not_held(monkeypatch):
    seen = []

    class Text(coco._JsonText):
        def value(self):
            found = super().value()
            seen.append(len(found[1]))
            return found

    monkeypatch.setattr(coco, "_JsonText", Text)
    doc = {"other": [{"id": i} for i in range(1_000)], "images": [{"id": 1}]}
    assert list(coco.json_records(io.BytesIO(json.dumps(doc).encode()), ("images",), 64)) == [("images", '{"id": 1}')]
    assert max(seen) < 20


def test_media_are_listed_by_ending(spark, tmp_path):
    (tmp_path / "a").mkdir()
    for name in ("x.JPG", "a/y.webp", "a/z.mp4", "notes.txt", "plain"):
        (tmp_path / name).write_bytes(b"123")
    rows = coco.list_media(spark, str(tmp_path)).collect()
    assert sorted((r.path.rsplit("/", 1)[1], r.kind, r.length) for r in rows) == [("x.JPG", "image", 3), ("y.webp", "image", 3), ("z.mp4", "video", 3)]


def test_dataset_settings():
    from framelens.config import dataset_settings

    out = dataset_settings({"train": "a", "validation": "b", "nc": "2"})
    assert (out["val"], out["names"], out["nc"], out["channels"]) == ("b", {0: "class_0", 1: "class_1"}, 2, 3)
    assert dataset_settings({"train": "a", "val": "b", "names": {0: "x"}, "nc": 1.0}, "val")["names"] == {0: "x"}
    for bad, error in (({"val": "b", "nc": 1}, KeyError), ({"train": "a", "val": "b"}, KeyError), ({"train": "a", "val": "b", "nc": 1.5}, ValueError), ({"train": "a", "val": "b", "nc": 2, "names": ["x"]}, ValueError), ({"train": "a", "val": "b", "names": {3: "x"}}, ValueError)):
        with pytest.raises(error):
            dataset_settings(bad)
    with pytest.raises(KeyError):
        dataset_settings({"train": "a", "val": "b", "nc": 1, "test": None}, "test")
