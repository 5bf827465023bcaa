"""The registered queries: each applies an operator to whole tables; SQL stands beside it in ``statements``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framelens.functions import boxes as bx
from framelens.functions import vectors
from framelens.functions.strings import clean_name
from framelens.operators import augment, curves, etl, manifest, matching, metrics, multiview, reports, search, suppression, trajectories
from framelens.sources.coco import read_labels_json
from framelens.streaming.tracker import track_batch

from . import datasets, geometry
from .views import annotations, detections, frames, ground_truth, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

LINE = ((50.0, -1e4), (50.0, 1e4))
ZONE = [(30.0, 50.0), (80.0, 50.0), (80.0, 150.0), (30.0, 150.0)]
CONCAVE = [(10.0, 20.0), (90.0, 20.0), (90.0, 160.0), (50.0, 90.0), (10.0, 160.0)]
LEVELS = [0.3, 0.5, 0.75]


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def six(c: str) -> F.Column:
    return F.round(c, 6).alias(c)


@query
def dataset_stats_category(spark, sf):
    out = reports.category_report(table(spark, sf, "orders").withColumnRenamed("o_orderkey", "l_orderkey"), table(spark, sf, "lineitem"), "l_orderkey", "l_returnflag")
    return out.select("category", "instances", "images", six("instance_share"), six("image_share"))


@query
def unannotated_images(spark, sf):
    return etl.unlabelled(table(spark, sf, "orders").withColumnRenamed("o_orderkey", "l_orderkey"), table(spark, sf, "lineitem"), "l_orderkey").select(F.col("l_orderkey").alias("image"))


@query
def top_resolutions_other(spark, sf):
    return reports.top_and_other(table(spark, sf, "part"), ["p_size", "p_type"]).select("rank", "kind", "n", "kinds", six("share"))


@query
def split_composition(spark, sf):
    rows = table(spark, sf, "lineitem").join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return reports.split_composition(rows, "o_orderstatus", "l_orderkey", "l_returnflag").select(F.col("o_orderstatus").alias("split"), "category", "images", "instances", six("share"))


@query
def detection_totals(spark, sf):
    return detections(spark, sf).rollup("cls").agg(F.count("*").alias("n"), F.count_distinct("image").alias("images"))


@query
def describe_images(spark, sf):
    return reports.describe_images(annotations(spark, sf), F.lower("cls"))


@query
def class_signature(spark, sf):
    return etl.class_signature(annotations(spark, sf))


@query
def stratified_allocation(spark, sf):
    sizes = etl.class_signature(annotations(spark, sf)).groupBy("signature").agg(F.count("*").alias("n"))
    return etl.allocate(sizes, 500)


@query
def stratified_sample(spark, sf):
    return etl.stratified_sample(etl.class_signature(annotations(spark, sf)), 500, 7)


@query
def hash_split(spark, sf):
    return etl.hash_split(table(spark, sf, "documents").select("doc_id"), "doc_id", {"train": 0.9, "val": 0.1, "test": 0.0}, 3)


@query
def per_class_split(spark, sf):
    return etl.split_by_class(table(spark, sf, "documents").select("doc_id", "lang"), "lang", "doc_id", 0.8, 3)


@query
def ranked_split(spark, sf):
    return etl.ranked_split(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", {"train": 0.8, "val": 0.1, "test": 0.1}, 5)


@query
def linspace_sample(spark, sf):
    return etl.evenly_spaced(table(spark, sf, "documents").select("doc_id", "source"), ["doc_id"], 37)


@query
def exact_dedup(spark, sf):
    return etl.exact_duplicates(table(spark, sf, "documents").select("doc_id", "text"), F.col("text"), "doc_id").select("doc_id", "digest", "copy")


@query
def merge_renumber(spark, sf):
    nations = table(spark, sf, "nation").select(F.col("n_nationkey").alias("old_id"), F.col("n_name").alias("name"))
    regions = table(spark, sf, "region").select(F.col("r_regionkey").alias("old_id"), F.col("r_name").alias("name"))
    return etl.renumber([nations, regions], ["name", "old_id"], "old_id")


@query
def append_renumbered(spark, sf):
    suppliers = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    return etl.append_renumbered(suppliers, customers, "id", ["name"])


@query
def padded_names(spark, sf):
    return etl.padded_names(table(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("stem")), "stem", 100, 6)


@query
def orphan_check(spark, sf):
    return etl.orphans(table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("key")), table(spark, sf, "customer"), "key", "c_custkey")


@query
def category_conflict(spark, sf):
    return etl.conflicts(table(spark, sf, "part"), "p_size", "p_type")


@query
def batch_shapes(spark, sf):
    return etl.batch_shapes(table(spark, sf, "part").withColumn("w", F.col("p_size") + 5).withColumn("h", F.col("p_partkey") % 40 + 10), "w", "h", "p_partkey", 16).select("batch", "n", six("low"), six("high"), "bh", "bw")


@query
def json_explode(spark, sf):
    return read_labels_json(table(spark, sf, "events"), "props", "event_id")


@query
def box_convert(spark, sf):
    rows = annotations(spark, sf)
    cx, cy, w, h = bx.to_center(bx.box())
    nx, ny, nw, nh = bx.to_normalised(bx.box(), F.lit(640.0), F.lit(480.0), 0.0)
    return rows.select("image", "i", cx.alias("cx"), cy.alias("cy"), w.alias("w"), h.alias("h"), nx.alias("nx"), ny.alias("ny"), nw.alias("nw"), nh.alias("nh"))


@query
def scale_clip(spark, sf):
    b = bx.undo_letterbox(bx.Box(*[F.col(c) * 8 for c in ("x1", "y1", "x2", "y2")]), F.lit(640.0), F.lit(640.0), F.lit(320.0), F.lit(200.0))
    return annotations(spark, sf).select("image", "i", *[F.round(v, 6).alias(n) for n, v in zip(("x1", "y1", "x2", "y2"), b)])


def _own_pairs(spark, sf):
    rows = annotations(spark, sf)
    return rows.alias("a").join(rows.alias("b"), (F.col("a.image") == F.col("b.image")) & (F.col("a.i") < F.col("b.i")))


@query
def pairwise_iou(spark, sf):
    a, b = bx.box("a."), bx.box("b.")
    return _own_pairs(spark, sf).select(F.col("a.image").alias("image"), F.col("a.i").alias("i"), F.col("b.i").alias("j"), F.round(bx.iou(a, b), 6).alias("iou"), F.round(bx.ioa(a, b), 6).alias("ioa")).where("iou > 0")


@query
def giou_diou_ciou(spark, sf):
    a, b = bx.box("a."), bx.box("b.")
    pick = {"giou": bx.generalised_iou, "diou": bx.distance_iou, "ciou": bx.complete_iou}
    return _own_pairs(spark, sf).select(F.col("a.image").alias("image"), F.col("a.i").alias("i"), F.col("b.i").alias("j"), *[(F.round(f(a, b), 6) + 0.0).alias(n) for n, f in pick.items()])


@query
def rotated_similarity(spark, sf):
    turned = lambda s: bx.RotatedBox((F.col(f"{s}.x1") + F.col(f"{s}.x2")) / 2, (F.col(f"{s}.y1") + F.col(f"{s}.y2")) / 2, F.col(f"{s}.x2") - F.col(f"{s}.x1"), F.col(f"{s}.y2") - F.col(f"{s}.y1"), F.col(f"{s}.conf"))
    return _own_pairs(spark, sf).select(F.col("a.image").alias("image"), F.col("a.i").alias("i"), F.col("b.i").alias("j"), F.round(bx.gaussian_similarity(turned("a"), turned("b")), 6).alias("similarity"))


@query
def matrix_nms(spark, sf):
    return suppression.matrix_nms(annotations(spark, sf).withColumnRenamed("i", "det"), 0.5).select("image", "cls", "det")


@query
def greedy_nms(spark, sf):
    return suppression.greedy_nms(annotations(spark, sf).withColumnRenamed("i", "det"), 0.5).select("image", "cls", "det")


@query
def filter_decoded(spark, sf):
    return suppression.filter_decoded(annotations(spark, sf).withColumnRenamed("i", "det"), 0.25, ["A", "R"], 2).select("image", "cls", "det", six("conf"))


@query
def match_at_thresholds(spark, sf):
    return matching.match_at_thresholds(detections(spark, sf), ground_truth(spark, sf), LEVELS).select("image", "cls", "threshold", "det", "gt", six("iou"))


@query
def confusion_matrix(spark, sf):
    return metrics.detection_confusion(detections(spark, sf), ground_truth(spark, sf))


@query
def confusion_norm(spark, sf):
    counts = metrics.class_confusion(table(spark, sf, "labels"), "toxic", "quality")
    return metrics.normalise_columns(counts).select("predicted", "actual", "n", six("share"))


@query
def hits_and_false(spark, sf):
    return metrics.hits_and_false(metrics.detection_confusion(detections(spark, sf), ground_truth(spark, sf)))


@query
def average_precision(spark, sf):
    d, g = detections(spark, sf), ground_truth(spark, sf)
    return curves.average_precision(d, g, matching.match_at_thresholds(d, g, LEVELS), LEVELS).select("cls", "threshold", "n_truth", six("ap"))


@query
def pr_best_f1(spark, sf):
    d, g = detections(spark, sf), ground_truth(spark, sf)
    return curves.best_f1(curves.confidence_curves(d, g, matching.match_at_thresholds(d, g, [0.5]))).select("cls", "point", six("precision"), six("recall"), six("f1"))


@query
def image_scores(spark, sf):
    d, g = detections(spark, sf), ground_truth(spark, sf)
    return curves.image_scores(d, g, matching.match_at_thresholds(d, g, [0.5])).select("image", "tp", "fp", "fn", six("precision"), six("recall"), six("f1"))


@query
def topk_accuracy(spark, sf):
    rows = table(spark, sf, "embeddings").withColumn("ranked", search.top_classes(F.slice("embedding", 1, 10)))
    return metrics.topk_accuracy(rows, "label", "ranked").select(six("top1"), six("top5"))


@query
def semantic_iou(spark, sf):
    return metrics.semantic_iou(table(spark, sf, "labels"), "toxic", "quality", 2).select("cls", six("iou"), "present")


@query
def depth_metrics(spark, sf):
    sums = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.sum("l_quantity").alias("predicted"))
    rows = table(spark, sf, "orders").join(sums, F.col("o_orderkey") == F.col("l_orderkey")).select(F.col("o_custkey").alias("image"), F.col("predicted"), (F.col("o_totalprice") / 5000).alias("actual"))
    return metrics.depth_metrics(rows, "predicted", "actual", high=120.0, least=5).select("image", "n", *[six(c) for c in ("d1", "d2", "d3", "abs_rel", "rmse", "silog")])


@query
def class_weights(spark, sf):
    return metrics.class_weights(table(spark, sf, "events"), "event_type", 0.5).select("cls", "n", six("weight"))


@query
def hist2d(spark, sf):
    return metrics.histogram_2d(table(spark, sf, "lineitem"), F.col("l_quantity"), F.col("l_extendedprice"), (0.0, 50.0), (0.0, 100000.0))


@query
def sigma_clip(spark, sf):
    return metrics.sigma_clip(table(spark, sf, "events"), "value").agg(F.count("*").alias("n"), F.round(F.avg("value"), 6).alias("mean"))


@query
def linear_fit(spark, sf):
    return metrics.linear_fit(table(spark, sf, "part"), "p_size", "p_retailprice", ["p_brand"]).select("p_brand", six("slope"), six("intercept"), "n")


@query
def running_best(spark, sf):
    rows = table(spark, sf, "events").select("event_type", "event_id", "value")
    return metrics.running_best(rows, "value", "event_id", ["event_type"])


@query
def cosine_topk(spark, sf):
    rows = table(spark, sf, "embeddings")
    queries = rows.where("vec_id % 100 = 0").select(F.col("vec_id").alias("query"), "embedding")
    return search.search_many(rows, queries, k=10, least=0.1).select("query", "vec_id", six("score"))


@query
def unit_vectors(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", F.round(vectors.norm(vectors.unit(F.col("embedding"))), 6).alias("norm"))


@query
def track_history(spark, sf):
    out = trajectories.track_history(frames(spark, sf), 5)
    return out.select("track", "frame", F.size("history").alias("length"), F.get("history", F.lit(0))["x"].alias("oldest_x"))


@query
def line_count(spark, sf):
    return trajectories.crossing_totals(trajectories.line_crossings(frames(spark, sf), *LINE), ["stream", "cls"])


@query
def polygon_count(spark, sf):
    return trajectories.polygon_entries(frames(spark, sf), ZONE).select("stream", "track", "frame", "direction")


@query
def region_count(spark, sf):
    return trajectories.region_counts(frames(spark, sf), {"zone": ZONE, "concave": CONCAVE})


@query
def queue_count(spark, sf):
    return trajectories.queue_counts(frames(spark, sf), ZONE)


@query
def occupancy(spark, sf):
    return trajectories.slot_occupancy(frames(spark, sf), [ZONE, [(0.0, 0.0), (30.0, 0.0), (30.0, 50.0), (0.0, 50.0)]])


@query
def speed(spark, sf):
    return trajectories.speeds(frames(spark, sf), 5, 30.0, 0.05, 120)


@query
def heatmap(spark, sf):
    points = frames(spark, sf)
    r = 4
    return trajectories.heat(points.select((F.col("cx") - r).alias("x1"), (F.col("cy") - r).alias("y1"), (F.col("cx") + r).alias("x2"), (F.col("cy") + r).alias("y2")), 160, 200)


@query
def tumbling_counts(spark, sf):
    return trajectories.refresh_counts(frames(spark, sf), 10)


@query
def class_shares(spark, sf):
    return trajectories.class_shares(frames(spark, sf)).select("stream", "frame", "cls", "n", six("share"))


@query
def last45(spark, sf):
    return trajectories.last_points(frames(spark, sf), ["track"], "frame").select("track", "frame", "cx")


@query
def fsm_count(spark, sf):
    return trajectories.hysteresis_counts(frames(spark, sf), "cx", 60.0, 20.0).select("track", "frame", "stage", "count")


@query
def alarm_first_frame(spark, sf):
    return trajectories.first_alarm(frames(spark, sf), 30)


@query
def track_zone(spark, sf):
    return trajectories.zone(frames(spark, sf), CONCAVE).select("track", "frame", "cx", "cy")


@query
def track_distance(spark, sf):
    return trajectories.track_distance(frames(spark, sf), 1, 5).select("stream", "frame", six("distance"))


@query
def flip_clip(spark, sf):
    return augment.clip_to(augment.flip(annotations(spark, sf), F.lit(50.0), F.lit(60.0)), F.lit(50.0), F.lit(60.0)).select("image", "i", "x1", "y1", "x2", "y2")


@query
def affine_boxes(spark, sf):
    return augment.affine(annotations(spark, sf), [[0.8, 0.1, 2.0], [-0.1, 0.9, 3.0], [0.0, 0.0, 1.0]], 60.0, 50.0).select("image", "i", *[six(c) for c in ("x1", "y1", "x2", "y2")])


@query
def tile_windows(spark, sf):
    images = table(spark, sf, "part").select("p_partkey", (F.col("p_partkey") * 13 % 3000 + 200).alias("width"), (F.col("p_partkey") * 7 % 2500 + 200).alias("height"))
    return augment.tiles(images)


@query
def clean_names(spark, sf):
    return table(spark, sf, "part").select("p_partkey", clean_name(F.concat("p_name", F.lit("#(+)"))).alias("name"))


@query
def track_assign(spark, sf):
    rows = annotations(spark, sf).withColumn("stream", F.col("image") % 8).withColumnRenamed("image", "frame").withColumnRenamed("i", "idx")
    return track_batch(rows.select("stream", "frame", "idx", "cls", "conf", "x1", "y1", "x2", "y2"))


@query
def area_buckets(spark, sf):
    return annotations(spark, sf).groupBy("cls", manifest.area_bucket(bx.box().area).alias("bucket")).agg(F.count("*").alias("n"))


@query
def score_bands(spark, sf):
    band = etl.score_band(F.col("conf"), F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"))
    return annotations(spark, sf).groupBy(F.coalesce(band, F.lit("none")).alias("band")).agg(F.count("*").alias("n"))


@query
def keep_classes(spark, sf):
    return etl.keep_classes(annotations(spark, sf), ["A", "N"]).groupBy("cls").agg(F.count("*").alias("n"))


def _points(spark, sf):
    return table(spark, sf, "events").select(F.col("value").alias("wx"), ((F.col("event_id") * 37) % 200).cast("double").alias("wy"), (F.col("user_id") % 50).cast("double").alias("wz"))


@query
def voxel_counts(spark, sf):
    return multiview.voxelize(_points(spark, sf), 20.0).groupBy("gx", "gy", "gz").agg(F.count("*").alias("n"))


@query
def voxel_neighbours(spark, sf):
    return multiview.neighbour_counts(multiview.voxelize(_points(spark, sf), 20.0))


def _masks(spark, sf, odd):
    rows = table(spark, sf, "lineitem").where(F.col("l_linenumber") % 2 == odd)
    return rows.select((F.col("l_orderkey") % 500).alias("image"), F.col("l_linenumber").cast("long").alias("mask"), (F.col("l_partkey") % 60).alias("pixel")).distinct()


@query
def mask_iou(spark, sf):
    return matching.mask_iou(_masks(spark, sf, 1), _masks(spark, sf, 0)).select("image", "left_mask", "right_mask", six("iou"))


@query
def mask_boxes(spark, sf):
    pixels = table(spark, sf, "lineitem").select((F.col("l_orderkey") % 500).alias("image"), F.col("l_linenumber").alias("mask"), (F.col("l_partkey") % 60).alias("u"), (F.col("l_suppkey") % 40).alias("v"))
    return manifest.mask_boxes(pixels, ["image", "mask"])


@query
def pixel_shares(spark, sf):
    return manifest.pixel_shares(table(spark, sf, "lineitem"), "l_linestatus", "l_returnflag").select(F.col("l_linestatus").alias("image"), F.col("l_returnflag").alias("cls"), "n", six("share"))


@query
def metric_means(spark, sf):
    runs = table(spark, sf, "events").select((F.col("user_id") % 5).alias("dataset"), F.col("event_type").alias("metric"), "value")
    return reports.metric_means(runs, ["dataset"]).select("dataset", "metric", six("mean"))


@query
def mosaic_boxes(spark, sf):
    rows = annotations(spark, sf)
    quarter = F.col("o_orderkey") % 4
    layout = table(spark, sf, "orders").select(F.col("o_orderkey").alias("image"), F.floor(F.col("o_orderkey") / 4).alias("mosaic"), ((quarter % 2) * 40).cast("double").alias("dx"), (F.floor(quarter / 2) * 40).cast("double").alias("dy"), F.lit(1.0).alias("gain"))
    return augment.mosaic(rows, layout, 40.0).select("mosaic", "image", "i", "x1", "y1", "x2", "y2")


@query
def paste_candidates(spark, sf):
    return augment.paste_candidates(detections(spark, sf).withColumnRenamed("det", "candidate"), ground_truth(spark, sf), 0.5).select("image", "candidate", six("covered"))


@query
def nearly_same_dropped(spark, sf):
    """Loose detections that no strict one overlaps by more than the limit."""
    rows = annotations(spark, sf)
    loose, strict = rows.where("conf > 0.1"), rows.where("conf > 0.7")
    hit = matching.rows_with_box_overlap(loose, strict, 0.6)
    return matching.unmatched(loose, hit, ["image", "i"]).select("image", "i")


@query
def vocabulary_numbers(spark, sf):
    return manifest.merge_vocabularies(table(spark, sf, "part"), "p_brand", "p_type")


@query
def letterbox_gain(spark, sf):
    w, h = (F.col("p_size") * 10 + 5).cast("double"), (F.col("p_partkey") % 37 * 10 + 8).cast("double")
    gain, px, py = bx.letterbox(w, h, F.lit(640.0), F.lit(480.0))
    return table(spark, sf, "part").select("p_partkey", F.round(gain, 6).alias("gain"), px.alias("pad_x"), py.alias("pad_y"))


for part in (geometry, datasets):
    QUERIES.update(part.entries.queries)
