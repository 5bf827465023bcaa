"""Registered queries over boxes, polygons, points, masks and views, each beside its DuckDB statement."""

from __future__ import annotations

from math import pi

from pyspark.sql import functions as F

from framelens.functions import boxes as bx
from framelens.functions import polygons, segments, vectors
from framelens.operators import assignment, augment, curves, manifest, matching, multiview, search

from .registry import Entries
from .precision import average_precision
from .views import ANN, FRAMES, annotations, detections, frames, ground_truth, sql_area, sql_iou, table

entries = Entries()
entry = entries.add

PI = f"{pi!r}::DOUBLE"
#: An annotation as a turned box, in SQL.
TURNED = f"{ANN}, t AS (SELECT image, i, (x1 + x2) / 2 AS cx, (y1 + y2) / 2 AS cy, x2 - x1 AS w, y2 - y1 AS h, conf * 6 - 3 AS a FROM ann)"
#: Four corners of a polygon around an annotation, in SQL.
POLYGON = [("x1", "y1"), ("x2", "(y1 + 2)"), ("(x2 + 3)", "y2"), ("(x1 - 1)", "(y2 - 4)")]
CAMERA = {"K": [[100.0, 0.0, 50.0], [0.0, 80.0, 40.0], [0.0, 0.0, 1.0]], "pose": [[1.0, 0, 0, 10], [0, 1, 0, 20], [0, 0, 1, 30], [0, 0, 0, 1]], "size": (100, 80)}


def rounded(**columns):
    return [(F.round(v, 6) + 0.0).alias(n) for n, v in columns.items()]


def sql_rounded(**columns: str) -> str:
    return ", ".join(f"round({v}, 6) + 0.0::DOUBLE AS {n}" for n, v in columns.items())


def turned():
    return bx.RotatedBox((F.col("x1") + F.col("x2")) / 2, (F.col("y1") + F.col("y2")) / 2, F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"), F.col("conf") * 6 - 3)


def _far(ax: str, ay: str, x: str, y: str, sigma: str) -> str:
    return f"exp(-(power(a.{ax} - b.{x}, 2) + power(a.{ay} - b.{y}, 2)) / (power(2 * {sigma}::DOUBLE, 2) * ({sql_area('a')} + 1e-7::DOUBLE) * 2))"


@entry(f"""
WITH {ANN} SELECT a.image, a.i, b.i AS j, round(({_far('x1', 'y1', 'x1', 'y1', '0.05')} + CASE WHEN a.i % 3 <> 0 THEN {_far('x2', 'y2', 'x2', 'y2', '0.1')} ELSE 0.0::DOUBLE END)
  / (1 + (a.i % 3 <> 0)::INT + 1e-7::DOUBLE), 6) AS similarity
FROM ann a JOIN ann b ON a.image = b.image AND a.i % 2 = 1 AND b.i % 2 = 0""")
def keypoint_similarity(spark, sf):
    rows = annotations(spark, sf)
    point = lambda s, x, y, v: F.struct(F.col(f"{s}.{x}").alias("x"), F.col(f"{s}.{y}").alias("y"), v.alias("v"))
    truth = F.array(point("a", "x1", "y1", F.lit(1)), point("a", "x2", "y2", (F.col("a.i") % 3).cast("int")))
    found = F.array(point("b", "x1", "y1", F.lit(1)), point("b", "x2", "y2", F.lit(1)))
    pairs = rows.where("i % 2 = 1").alias("a").join(rows.where("i % 2 = 0").alias("b"), F.col("a.image") == F.col("b.image"))
    return pairs.select(F.col("a.image").alias("image"), F.col("a.i").alias("i"), F.col("b.i").alias("j"), F.round(bx.keypoint_similarity(truth, found, bx.box("a.").area, [0.05, 0.1]), 6).alias("similarity"))


@entry(f"""
WITH {TURNED}, s AS (SELECT * FROM (VALUES (0, 1, 1), (1, 1, -1), (2, -1, -1), (3, -1, 1)) AS v(k, u, v))
SELECT image, i, k, {sql_rounded(x="cx + u * w / 2 * cos(a) - v * h / 2 * sin(a)", y="cy + u * w / 2 * sin(a) + v * h / 2 * cos(a)")} FROM t, s""")
def rotated_corners(spark, sf):
    rows = annotations(spark, sf).select("image", "i", F.posexplode(bx.rotated_corners(turned())).alias("k", "p"))
    return rows.select("image", "i", "k", *rounded(x=F.col("p.x"), y=F.col("p.y")))


@entry(f"""
WITH {TURNED}, m AS (SELECT *, ((a % {PI}) + {PI}) % {PI} AS full_turn, ((a % ({PI} / 2)) + {PI} / 2) % ({PI} / 2) AS quarter FROM t)
SELECT image, i, CASE WHEN full_turn >= {PI} / 2 THEN h ELSE w END AS w, CASE WHEN full_turn >= {PI} / 2 THEN w ELSE h END AS h, round(quarter, 6) AS angle FROM m""")
def regular_angle(spark, sf):
    r = bx.regular_angle(turned())
    return annotations(spark, sf).select("image", "i", r.w.alias("w"), r.h.alias("h"), F.round(r.angle, 6).alias("angle"))


@entry(f"""
WITH {TURNED}, m AS (SELECT *, a - {PI} / 2 + {PI} / 4 AS s FROM t)
SELECT image, i, {sql_rounded(cx="cx", cy="cy", w="h", h="w", angle=f"((s % {PI}) + {PI}) % {PI} - {PI} / 4")} FROM m""")
def box_of_corners(spark, sf):
    """The rotated box of four corners: its first side is the one from the first corner to the second."""
    flat = F.flatten(F.transform(bx.rotated_corners(turned()), lambda p: F.array(p["x"], p["y"])))
    rows = annotations(spark, sf).select("image", "i", segments.rotated_box(flat).alias("r"))
    return rows.select("image", "i", *rounded(**{c: F.col(f"r.{c}") for c in ("cx", "cy", "w", "h", "angle")}))


@entry(f"""WITH {FRAMES} SELECT track, frame, {sql_rounded(x="least(greatest(cx * 4 / 2, 0.0::DOUBLE), 320.0::DOUBLE)", y="least(greatest((cy * 4 - 120) / 2, 0.0::DOUBLE), 200.0::DOUBLE)")} FROM frames""")
def scaled_points(spark, sf):
    x, y = F.col("cx") * 4, F.col("cy") * 4
    b = bx.undo_letterbox(bx.Box(x, y, x, y), F.lit(640.0), F.lit(640.0), F.lit(320.0), F.lit(200.0))
    return frames(spark, sf).select("track", "frame", *rounded(x=b.x1, y=b.y1))


def _polygon():
    return F.array(*[F.struct(F.expr(x).alias("x"), F.expr(y).alias("y")) for x, y in POLYGON])


def _shoelace(points: list[tuple[str, str]]) -> str:
    return "abs(" + " + ".join(f"({ax} * {by} - {bx_} * {ay})" for (ax, ay), (bx_, by) in zip(points, [*points[1:], points[0]])) + ") / 2"


_CLIPPED = [(f"least(greatest({x}, 0.0::DOUBLE), 30.0::DOUBLE)", f"least(greatest({y}, 0.0::DOUBLE), 25.0::DOUBLE)") for x, y in POLYGON]


@entry(f"""WITH {ANN} SELECT image, i, {sql_rounded(area=_shoelace(POLYGON), clipped=_shoelace(_CLIPPED), left_="least(" + ", ".join(x for x, _ in POLYGON) + ")", bottom="greatest(" + ", ".join(y for _, y in POLYGON) + ")")} FROM ann""")
def polygon_areas(spark, sf):
    rows = annotations(spark, sf).withColumn("p", _polygon())
    left, _, _, bottom = polygons.hull_box(F.col("p"))
    clipped = polygons.clip_points(F.col("p"), F.lit(30.0), F.lit(25.0))
    return rows.select("image", "i", *rounded(area=polygons.area(F.col("p")), clipped=polygons.area(clipped), left_=left, bottom=bottom))


@entry(f"""
WITH {ANN} SELECT image, i, {sql_rounded(x="0.8::DOUBLE * x1 + 0.1::DOUBLE * y1 + 2", y="0.9::DOUBLE * y1 - 0.1::DOUBLE * x1 + 3", area="abs(0.8::DOUBLE * 0.9::DOUBLE + 0.1::DOUBLE * 0.1::DOUBLE) * " + _shoelace(POLYGON))} FROM ann""")
def affine_polygons(spark, sf):
    """The map of a polygon's points, and its area, which grows by the determinant."""
    moved = polygons.map_points(_polygon(), lambda x, y: x * 0.8 + y * 0.1 + 2, lambda x, y: y * 0.9 - x * 0.1 + 3)
    rows = annotations(spark, sf).withColumn("p", moved)
    first = F.get("p", F.lit(0))
    return rows.select("image", "i", *rounded(x=first["x"], y=first["y"], area=polygons.area(F.col("p"))))


_WINDOWS = [(x, y, x + 24, y + 24) for x in (0, 24) for y in (0, 24)]
_ASSIGNED = f"""WITH {ANN}, win AS (SELECT * FROM (VALUES {', '.join(map(str, _WINDOWS))}) AS v(tx1, ty1, tx2, ty2)),
hit AS (SELECT image, i, tx1, ty1, tx2, ty2, x1, y1, {sql_area('ann')} AS size, greatest(0.0::DOUBLE, least(x2, tx2) - greatest(x1, tx1)) * greatest(0.0::DOUBLE, least(y2, ty2) - greatest(y1, ty1)) / greatest({sql_area('ann')}, 1e-6::DOUBLE) AS share FROM ann, win)"""


def _assigned(spark, sf):
    rows = annotations(spark, sf).withColumn("polygon", F.array("x1", "y1", "x2", "y1", "x2", "y2", "x1", "y2"))
    windows = table(spark, sf, "orders").select(F.col("o_orderkey").alias("image"), F.explode(F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(("tx1", "ty1", "tx2", "ty2"), w)]) for w in _WINDOWS])).alias("w")).select("image", "w.*")
    return manifest.assign_to_windows(rows, windows, 0.3)


@entry(f"{_ASSIGNED} SELECT image, i, tx1, ty1, round(share * size, 3) AS covered FROM hit WHERE share >= 0.3::DOUBLE")
def window_objects(spark, sf):
    """The area of each object in each window that holds enough of it: whole numbers here, so no rounding decides."""
    return _assigned(spark, sf).select("image", "i", "tx1", "ty1", F.round(F.col("share") * bx.box().area, 3).alias("covered"))


@entry(f"{_ASSIGNED} SELECT image || '__24__' || tx1 || '___' || ty1 AS tile, i, x1 - tx1 AS x, y1 - ty1 AS y FROM hit WHERE share >= 0.3::DOUBLE")
def rebased_objects(spark, sf):
    return manifest.rebase(_assigned(spark, sf)).select("tile", "i", F.get("polygon", F.lit(0)).alias("x"), F.get("polygon", F.lit(1)).alias("y"))


_ANGLE = "abs(degrees(atan2(y2 - y1, x2 + conf - x2) - atan2(y1 - y1, x1 - x2)))"


@entry(f"WITH {ANN} SELECT image, i, round(CASE WHEN {_ANGLE} > 180 THEN 360 - {_ANGLE} ELSE {_ANGLE} END, 6) AS angle FROM ann")
def joint_angles(spark, sf):
    angle = vectors.joint_angle(F.col("x1"), F.col("y1"), F.col("x2"), F.col("y1"), F.col("x2") + F.col("conf"), F.col("y2"))
    return annotations(spark, sf).select("image", "i", F.round(angle, 6).alias("angle"))


@entry("""
SELECT a.vec_id, round(coalesce(greatest(0.0::DOUBLE, 1 - list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) / (greatest(sqrt(list_dot_product(a.embedding::DOUBLE[], a.embedding::DOUBLE[])), 1e-12::DOUBLE) * greatest(sqrt(list_dot_product(b.embedding::DOUBLE[], b.embedding::DOUBLE[])), 1e-12::DOUBLE))), 2.0::DOUBLE), 6) AS distance
FROM embeddings a LEFT JOIN embeddings b ON b.vec_id = a.vec_id + 1""")
def cosine_distances(spark, sf):
    rows = table(spark, sf, "embeddings")
    after = rows.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other"))
    return rows.join(after, "vec_id", "left").select("vec_id", F.round(vectors.cosine_distance(F.col("embedding"), F.col("other")), 6).alias("distance"))


@entry("""
WITH r AS (SELECT vec_id, list_sort(list_transform(range(0, 10), lambda k: {'s': -embedding[k + 1], 'c': k})) AS l FROM embeddings)
SELECT vec_id, l[1].c::INT AS c1, l[2].c::INT AS c2, l[3].c::INT AS c3, l[4].c::INT AS c4, l[5].c::INT AS c5 FROM r""")
def top_classes(spark, sf):
    rows = table(spark, sf, "embeddings").withColumn("top", search.top_classes(F.slice("embedding", 1, 10)))
    return rows.select("vec_id", *[F.get("top", F.lit(k)).alias(f"c{k + 1}") for k in range(5)])


_EDGE = " OR ".join(f"(abs({s} + {o} - {c}) <= 6 AND abs({s} + {o} - {i}) > 6)" for s, o, c, i in (("x1", 10, 10, 0), ("y1", 5, 5, 0), ("x2", 10, 50, 90), ("y2", 5, 45, 80)))


@entry(f"""WITH {ANN} SELECT image, i, CASE WHEN x1 < 5 THEN 0.0::DOUBLE ELSE x1 END AS x1, CASE WHEN y1 < 5 THEN 0.0::DOUBLE ELSE y1 END AS y1,
  CASE WHEN x2 > 55 THEN 60.0::DOUBLE ELSE x2 END AS x2, CASE WHEN y2 > 45 THEN 50.0::DOUBLE ELSE y2 END AS y2, ({_EDGE}) AS at_edge FROM ann""")
def border_boxes(spark, sf):
    """Boxes snapped to the border, and whether they end at the edge of a crop that is not the image's."""
    b = bx.snap_to_border(bx.box(), F.lit(60.0), F.lit(50.0), 5)
    literal = lambda *v: bx.Box(*[F.lit(float(x)) for x in v])
    edge = bx.near_crop_edge(bx.box(), literal(10, 5, 50, 45), literal(0, 0, 90, 80), 6)
    return annotations(spark, sf).select("image", "i", *[c.alias(n) for n, c in zip(("x1", "y1", "x2", "y2"), b)], edge.alias("at_edge"))


def _kept(v: str) -> str:
    return f"least(greatest({v}, 0.0::DOUBLE), 15.99::DOUBLE)"


@entry(f"""
WITH {ANN}, d AS (SELECT image, i, conf, {_kept('20 - x1')} AS l, {_kept('20 - y1')} AS t, {_kept('x2 - 20')} AS r, {_kept('y2 - 20')} AS b FROM ann)
SELECT image, i, {sql_rounded(l="l", t="t", r="r", b="b", x1="20 - l", y2="20 + b", cx="20 + (r - l) / 2 * cos(conf) - (b - t) / 2 * sin(conf)", cy="20 + (r - l) / 2 * sin(conf) + (b - t) / 2 * cos(conf)", w="l + r", h="t + b")} FROM d""")
def anchor_distances(spark, sf):
    """Distances of an anchor to the sides, capped, and the upright and the turned box they give back."""
    at = F.lit(20.0)
    rows = annotations(spark, sf)
    rows = rows.withColumns(dict(zip("ltrb", bx.to_distances(at, at, bx.box(), 16))))
    sides = [F.col(c) for c in "ltrb"]
    upright, tilted = bx.from_distances(at, at, *sides), bx.rotated_from_distances(at, at, *sides, F.col("conf"))
    return rows.select("image", "i", *rounded(l=sides[0], t=sides[1], r=sides[2], b=sides[3], x1=upright.x1, y2=upright.y2, cx=tilted.cx, cy=tilted.cy, w=tilted.w, h=tilted.h))


@entry(f"""
WITH {TURNED}, d AS (SELECT *, (20 - cx) * cos(a) + (20 - cy) * sin(a) AS u, -(20 - cx) * sin(a) + (20 - cy) * cos(a) AS v FROM t)
SELECT image, i, {sql_rounded(**{n: f"least(greatest({v}, 0.0::DOUBLE), 15.99::DOUBLE)" for n, v in (("l", "u + w / 2"), ("t", "v + h / 2"), ("r", "w / 2 - u"), ("b", "h / 2 - v"))})} FROM d""")
def rotated_distances(spark, sf):
    """Distances of an anchor to the sides of a turned box, along the box's own axes."""
    names = dict(zip("ltrb", bx.rotated_to_distances(F.lit(20.0), F.lit(20.0), turned(), 16)))
    return annotations(spark, sf).select("image", "i", *rounded(**names))


@entry(f"""
WITH {ANN}, a AS (SELECT *, (x2 - x1) * conf AS w, (y2 - y1) * conf * conf AS h FROM ann)
SELECT image, i, w > 2 AND h > 2 AND w * h / ((x2 - x1) * (y2 - y1) + 1e-16::DOUBLE) > 0.1::DOUBLE AND greatest(w / (h + 1e-16::DOUBLE), h / (w + 1e-16::DOUBLE)) < 3 AS kept FROM a""")
def box_candidates(spark, sf):
    b = bx.box()
    after = bx.Box(F.lit(0.0), F.lit(0.0), b.width * F.col("conf"), b.height * F.col("conf") * F.col("conf"))
    return annotations(spark, sf).select("image", "i", bx.candidate(b, after, max_aspect=3).alias("kept"))


@entry("SELECT r_regionkey AS level, x + 0.5::DOUBLE AS ax, y + 0.5::DOUBLE AS ay FROM region, unnest(range(0, r_regionkey + 2)) AS a(y), unnest(range(0, r_regionkey + 3)) AS b(x)")
def anchor_points(spark, sf):
    levels = table(spark, sf, "region").select(F.col("r_regionkey").alias("level"), (F.col("r_regionkey") + 2).alias("rows"), (F.col("r_regionkey") + 3).alias("cols"), F.lit(8).alias("stride"))
    return augment.anchor_points(levels).select("level", "ax", "ay")


@entry(f"WITH {ANN} SELECT image, i, x1 * 2 + 7 AS x1, y1 * 3 + 9 AS y1, x2 * 2 + 7 AS x2, y2 * 3 + 9 AS y2 FROM ann")
def padded_boxes(spark, sf):
    return augment.shift(annotations(spark, sf), F.lit(7.0), F.lit(9.0), 2.0, 3.0).select("image", "i", "x1", "y1", "x2", "y2")


@entry(f"WITH {ANN}, p AS (SELECT o_orderkey AS mixed, unnest([o_orderkey, o_orderkey + 1]) AS image FROM orders) SELECT mixed, p.image, i, cls, x1 FROM p JOIN ann USING (image)")
def mix_up(spark, sf):
    pairs = table(spark, sf, "orders").select(F.col("o_orderkey").alias("mixed"), F.col("o_orderkey").alias("image"), (F.col("o_orderkey") + 1).alias("other"))
    return augment.mix_up(annotations(spark, sf), pairs).select("mixed", "image", "i", "cls", "x1")


_SHOWN = "greatest(0.0::DOUBLE, least(x2, 30) - greatest(x1, 8)) * greatest(0.0::DOUBLE, least(y2, 28) - greatest(y1, 6)) / ((x2 - x1) * (y2 - y1) + 1e-7::DOUBLE)"


@entry(f"""
WITH {ANN}, s AS (SELECT *, {_SHOWN} AS shown FROM ann),
own AS (SELECT image, i, x1, y1, x2, y2, false AS pasted FROM s JOIN orders ON image = o_orderkey WHERE shown < 0.9::DOUBLE),
cut AS (SELECT o_orderkey AS image, i, greatest(x1, 8.0::DOUBLE) AS x1, greatest(y1, 6.0::DOUBLE) AS y1, least(x2, 30.0::DOUBLE) AS x2, least(y2, 28.0::DOUBLE) AS y2, true AS pasted FROM s JOIN orders ON image = o_orderkey + 1 WHERE shown >= 0.1::DOUBLE AND x1 < 30 AND x2 > 8 AND y1 < 28 AND y2 > 6)
SELECT image, i, x1, y1, x2, y2 FROM own UNION ALL SELECT image, i, x1, y1, x2, y2 FROM cut""")
def cut_mix(spark, sf):
    pastes = table(spark, sf, "orders").select(F.col("o_orderkey").alias("image"), (F.col("o_orderkey") + 1).alias("donor"), *[F.lit(v).alias(n) for n, v in zip(("rx1", "ry1", "rx2", "ry2"), (8, 6, 30, 28))])
    return augment.cut_mix(annotations(spark, sf), pastes).select("image", "i", "x1", "y1", "x2", "y2")


@entry("SELECT (x + 0.5::DOUBLE) / 7 AS x, (y + 0.5::DOUBLE) / 7 AS y FROM unnest(range(0, 7)) AS a(x), unnest(range(0, 7)) AS b(y)")
def point_grid(spark, sf):
    return spark.createDataFrame(augment.point_grid(7), "x double, y double")


@entry("""
WITH l AS (SELECT k, 1 << k AS n, floor(0.3::DOUBLE * 480 * 2 / (1 << k))::INT AS o FROM unnest(range(1, 3)) AS t(k)),
s AS (SELECT k, n, o, ceil((o * (n - 1) + 640)::DOUBLE / n)::INT AS w, ceil((o * (n - 1) + 480)::DOUBLE / n)::INT AS h FROM l)
SELECT 0 AS x1, 0 AS y1, 640 AS x2, 480 AS y2, 0 AS layer
UNION ALL SELECT ((w - o) * i)::INT, ((h - o) * j)::INT, least((w - o) * i + w, 640)::INT, least((h - o) * j + h, 480)::INT, k::INT FROM s, unnest(range(0, n)) AS a(i), unnest(range(0, n)) AS b(j)""")
def crop_layers(spark, sf):
    return spark.createDataFrame(manifest.crop_layers(640, 480, 2, 0.3), "x1 int, y1 int, x2 int, y2 int, layer int")


_TRIANGLE = [("(p_partkey % 7)", "(p_partkey % 5)"), ("(20 + p_partkey % 9)", "(3 + p_size % 6)"), ("(p_size % 13)", "(18 + p_partkey % 8)")]


def _crossed(x: str, y: str) -> str:
    return " + ".join(f"(CASE WHEN ({ay} > {y}) <> ({by} > {y}) AND {ax} + ({y} - {ay}) / ({by} - {ay})::DOUBLE * ({bx_} - {ax}) <= {x} THEN 1 ELSE 0 END)" for (ax, ay), (bx_, by) in zip(_TRIANGLE, [*_TRIANGLE[1:], _TRIANGLE[0]]))


@entry(f"SELECT p_partkey AS image, py * 30 + px AS pixel FROM part, unnest(range(0, 30)) AS a(px), unnest(range(0, 24)) AS b(py) WHERE ({_crossed('(px + 0.5::DOUBLE)', '(py + 0.5::DOUBLE)')}) % 2 = 1")
def polygon_pixels(spark, sf):
    corners = F.array(*[F.expr(v).cast("double") for p in _TRIANGLE for v in p])
    return table(spark, sf, "part").select(F.col("p_partkey").alias("image"), F.explode(segments.mask_pixels(30, 24)(corners)).alias("pixel"))


def _pixels(spark, sf):
    rows = table(spark, sf, "lineitem")
    return rows.select(F.col("l_orderkey").alias("view"), (F.col("l_partkey") % 100).cast("int").alias("u"), (F.col("l_suppkey") % 80).cast("int").alias("v"), (F.col("l_quantity") * 10).cast("double").alias("depth_mm"), F.col("l_linenumber").cast("long").alias("cluster"), (F.col("l_suppkey") % 10).cast("long").alias("fragment"))


_PIXELS = "pixels AS (SELECT l_orderkey AS view, l_partkey % 100 AS u, l_suppkey % 80 AS v, l_quantity::DOUBLE * 10 AS d, l_linenumber::BIGINT AS cluster, (l_suppkey % 10)::BIGINT AS fragment FROM lineitem)"


@entry(f"WITH {_PIXELS} SELECT view, cluster, {sql_rounded(wx='(u - 50) * 0.01::DOUBLE * d + 10', wy='(v - 40) * 0.0125::DOUBLE * d + 20', wz='d + 30')} FROM pixels WHERE d > 0")
def lifted_pixels(spark, sf):
    return multiview.lift(_pixels(spark, sf), CAMERA).select("view", "cluster", *rounded(wx=F.col("wx"), wy=F.col("wy"), wz=F.col("wz")))


@entry(f"WITH {_PIXELS} SELECT u AS pu, v AS pv, arg_min(cluster, d * 100 + cluster) AS cluster FROM pixels WHERE d > 0 GROUP BY 1, 2")
def nearest_clusters(spark, sf):
    """Lifted pixels fall back on their places; at each the nearest cluster is seen."""
    out = multiview.z_buffer(multiview.lift(_pixels(spark, sf), CAMERA), CAMERA)
    return out.select("pu", "pv", "cluster")


_SCORES = f"""{_PIXELS}, a AS (SELECT * FROM pixels WHERE view % 2 = 0 AND d > 0), b AS (SELECT DISTINCT fragment AS other, u, v, d FROM pixels WHERE view % 2 = 1 AND d > 0),
hits AS (SELECT a.fragment, other, count(*) AS h FROM a JOIN b ON a.u = b.u AND a.v = b.v AND abs(a.d - b.d) < 50 GROUP BY 1, 2), sizes AS (SELECT fragment, count(*) AS n FROM a GROUP BY 1)"""


def _scores(spark, sf):
    rows = _pixels(spark, sf).where("depth_mm > 0")
    target = rows.where("view % 2 = 1").select("fragment", "u", "v", "depth_mm").distinct()
    return multiview.consistency(multiview.lift(rows.where("view % 2 = 0"), CAMERA), target, CAMERA, 50.0)


@entry(f"WITH {_SCORES} SELECT fragment, other, round(h::DOUBLE / n, 6) AS score FROM hits JOIN sizes USING (fragment)")
def view_consistency(spark, sf):
    return _scores(spark, sf).select("fragment", "other", F.round("score", 6).alias("score"))


@entry("""
WITH RECURSIVE n AS (SELECT s_suppkey::BIGINT AS node, (s_suppkey * 7) % 41 AS other FROM supplier),
e AS (SELECT node AS a, other AS b FROM n WHERE node % 3 <> 0 AND other IN (SELECT node FROM n) UNION SELECT other, node FROM n WHERE node % 3 <> 0 AND other IN (SELECT node FROM n)),
r AS (SELECT node, node AS low FROM n UNION SELECT r.node, e.b FROM r JOIN e ON r.low = e.a),
c AS (SELECT node, min(low) AS root FROM r GROUP BY node), big AS (SELECT root, row_number() OVER (ORDER BY root)::INT AS cluster FROM c GROUP BY root HAVING count(*) >= 2)
SELECT node AS fragment, cluster FROM c JOIN big USING (root)""")
def fragment_clusters(spark, sf):
    rows = table(spark, sf, "supplier").select(F.col("s_suppkey").cast("long").alias("fragment"), F.lit(1).alias("n"))
    scores = rows.select("fragment", ((F.col("fragment") * 7) % 41).alias("other"), F.when(F.col("fragment") % 3 != 0, 0.5).otherwise(0.1).alias("score")).join(rows.select(F.col("fragment").alias("other")), "other", "left_semi")
    return multiview.cluster_fragments(rows, scores, 0.3, 2)


@entry("""
WITH RECURSIVE p AS (SELECT DISTINCT p_size % 3 AS view, p_partkey % 25 AS u, (p_partkey // 25) % 20 AS v, 1 AS label, (p_partkey * 13) % 40 AS d FROM part),
g AS (SELECT view, u, v, min(d) AS d FROM p GROUP BY 1, 2, 3),
e AS (SELECT a.view, a.u, a.v, b.u AS u2, b.v AS v2 FROM g a JOIN g b ON a.view = b.view AND abs(a.u - b.u) + abs(a.v - b.v) = 1 AND abs(a.d - b.d) <= 20),
r AS (SELECT view, u, v, u AS lu, v AS lv FROM g UNION SELECT r.view, r.u, r.v, e.u2, e.v2 FROM r JOIN e ON e.view = r.view AND e.u = r.lu AND e.v = r.lv),
c AS (SELECT view, u, v, min(lv * 1000 + lu) AS root FROM r GROUP BY 1, 2, 3), s AS (SELECT view, root, count(*) AS n FROM c GROUP BY 1, 2 HAVING count(*) >= 3)
SELECT view::BIGINT AS view, n, count(*) AS parts FROM s GROUP BY 1, 2""")
def peeled_parts(spark, sf):
    """How many parts of each size a view has after a cut at jumps in depth."""
    rows = table(spark, sf, "part").select((F.col("p_size") % 3).cast("long").alias("view"), (F.col("p_partkey") % 25).cast("int").alias("u"), (F.floor(F.col("p_partkey") / 25) % 20).cast("int").alias("v"), F.lit(1).alias("label"), ((F.col("p_partkey") * 13) % 40).cast("double").alias("depth_mm"))
    grid = rows.groupBy("view", "u", "v", "label").agg(F.min("depth_mm").alias("depth_mm"))
    parts = multiview.peel(grid, 20.0, 3).groupBy("view", "part").agg(F.count("*").alias("n"))
    return parts.groupBy("view", "n").agg(F.count("*").alias("parts"))


_TALL = "greatest(0.0::DOUBLE, (least(a.y2, b.y2) - greatest(a.y1, b.y1)) / (greatest(a.y2, b.y2) - least(a.y1, b.y1) + 1e-7::DOUBLE))"


@entry(f"""WITH {ANN} SELECT a.image, a.i, b.i AS j, {sql_rounded(apart=f"1 - {sql_iou('a', 'b')}", fused=f"1 - {sql_iou('a', 'b')} * b.conf", tall=f"1 - {sql_iou('a', 'b')} * {_TALL}", unlike="abs(a.conf - b.conf)")}
FROM ann a JOIN ann b ON a.image = b.image AND a.i % 2 = 1 AND b.i % 2 = 0""")
def association_costs(spark, sf):
    rows = annotations(spark, sf)
    pairs = rows.where("i % 2 = 1").alias("a").join(rows.where("i % 2 = 0").alias("b"), F.col("a.image") == F.col("b.image"))
    costs = bx.association_costs(bx.box("a."), bx.box("b."), F.col("a.conf"), F.col("b.conf"))
    return pairs.select(F.col("a.image").alias("image"), F.col("a.i").alias("i"), F.col("b.i").alias("j"), *rounded(**costs))


# Average precision over other likenesses, and assignment

LEVELS = [0.3, 0.5, 0.75]


def _joined(spark, sf):
    return detections(spark, sf).alias("a").join(ground_truth(spark, sf).alias("b"), (F.col("a.image") == F.col("b.image")) & (F.col("a.cls") == F.col("b.cls")))


def _precision(spark, sf, pairs):
    out = curves.average_precision(detections(spark, sf), ground_truth(spark, sf), matching.match_pairs(pairs, LEVELS), LEVELS)
    return out.select("cls", "threshold", "n_truth", F.round("ap", 6).alias("ap"))


_KEYPOINT_PAIRS = f"""{ANN}, pairs AS (SELECT a.image, a.cls, a.det, a.conf, b.gt, ({_far('x1', 'y1', 'x1', 'y1', '0.15').replace(sql_area('a'), sql_area('b'))} + {_far('x2', 'y2', 'x2', 'y2', '0.25').replace(sql_area('a'), sql_area('b'))}) / (2 + 1e-7::DOUBLE) AS iou
  FROM det a JOIN gt b ON a.image = b.image AND a.cls = b.cls)"""


@entry(average_precision(_KEYPOINT_PAIRS))
def keypoint_average_precision(spark, sf):
    point = lambda s, x, y: F.struct(F.col(f"{s}.{x}").alias("x"), F.col(f"{s}.{y}").alias("y"), F.lit(1).alias("v"))
    truth, found = (F.array(point(s, "x1", "y1"), point(s, "x2", "y2")) for s in ("b", "a"))
    likeness = bx.keypoint_similarity(truth, found, bx.box("b.").area, [0.15, 0.25])
    return _precision(spark, sf, _joined(spark, sf).select("a.image", "a.cls", "a.det", "b.gt", likeness.alias("iou")))


_ROTATED_PAIRS = f"""{ANN},
c AS (SELECT a.image, a.cls, a.det, a.conf, b.gt, pow(a.x2 - a.x1, 2) / 12 AS pa, pow(a.y2 - a.y1, 2) / 12 AS pb, pow(b.x2 - b.x1, 2) / 12 AS qa, pow(b.y2 - b.y1, 2) / 12 AS qb, a.x1 / 20 AS pt, b.x1 / 20 AS qt,
  (a.x1 + a.x2) / 2 - (b.x1 + b.x2) / 2 AS dx, (a.y1 + a.y2) / 2 - (b.y1 + b.y2) / 2 AS dy FROM det a JOIN gt b ON a.image = b.image AND a.cls = b.cls),
k AS (SELECT *, pa * cos(pt) * cos(pt) + pb * sin(pt) * sin(pt) AS a1, pa * sin(pt) * sin(pt) + pb * cos(pt) * cos(pt) AS b1, (pa - pb) * cos(pt) * sin(pt) AS c1,
  qa * cos(qt) * cos(qt) + qb * sin(qt) * sin(qt) AS a2, qa * sin(qt) * sin(qt) + qb * cos(qt) * cos(qt) AS b2, (qa - qb) * cos(qt) * sin(qt) AS c2 FROM c),
dt AS (SELECT *, (a1 + a2) * (b1 + b2) - (c1 + c2) * (c1 + c2) AS dd FROM k),
bd AS (SELECT *, ((a1 + a2) * dy * dy + (b1 + b2) * dx * dx) / (dd + 1e-7::DOUBLE) * 0.25::DOUBLE + (c1 + c2) * -dx * dy / (dd + 1e-7::DOUBLE) * 0.5::DOUBLE
  + ln(dd / (4 * sqrt(greatest(0, a1 * b1 - c1 * c1) * greatest(0, a2 * b2 - c2 * c2)) + 1e-7::DOUBLE) + 1e-7::DOUBLE) * 0.5::DOUBLE AS far FROM dt),
pairs AS (SELECT image, cls, det, conf, gt, 1 - sqrt(1.0::DOUBLE - exp(-least(greatest(far, 1e-7::DOUBLE), 100)) + 1e-7::DOUBLE) AS iou FROM bd)"""


@entry(average_precision(_ROTATED_PAIRS))
def rotated_average_precision(spark, sf):
    tilted = lambda s: bx.RotatedBox((F.col(f"{s}.x1") + F.col(f"{s}.x2")) / 2, (F.col(f"{s}.y1") + F.col(f"{s}.y2")) / 2, F.col(f"{s}.x2") - F.col(f"{s}.x1"), F.col(f"{s}.y2") - F.col(f"{s}.y1"), F.col(f"{s}.x1") / 20)
    return _precision(spark, sf, _joined(spark, sf).select("a.image", "a.cls", "a.det", "b.gt", bx.gaussian_similarity(tilted("a"), tilted("b")).alias("iou")))


_FLOORED = _ROTATED_PAIRS.replace("/ 12 AS", "/ 12 + 0.5::DOUBLE AS").replace("AS dy FROM det a", "AS dy, a.x2 - a.x1 AS aw, a.y2 - a.y1 AS ah, b.x2 - b.x1 AS bw, b.y2 - b.y1 AS bh FROM det a").replace("conf, gt, 1 - sqrt", "conf, gt, aw, ah, bw, bh, 1 - sqrt")


@entry(f"""WITH {_FLOORED}, v AS (SELECT *, power(atan(bw / bh) - atan(aw / ah), 2) * (4 / ({PI} * {PI})) AS v FROM pairs)
SELECT image, det, gt, round(iou - v * v / (v - iou + (1 + 1e-7::DOUBLE)), 6) + 0.0::DOUBLE AS similarity FROM v""")
def rotated_similarity_with_aspect(spark, sf):
    tilted = lambda s: bx.RotatedBox((F.col(f"{s}.x1") + F.col(f"{s}.x2")) / 2, (F.col(f"{s}.y1") + F.col(f"{s}.y2")) / 2, F.col(f"{s}.x2") - F.col(f"{s}.x1"), F.col(f"{s}.y2") - F.col(f"{s}.y1"), F.col(f"{s}.x1") / 20)
    return _joined(spark, sf).select("a.image", "a.det", "b.gt", *rounded(similarity=bx.gaussian_similarity(tilted("a"), tilted("b"), aspect=True, floor=0.5)))


_MASKS = """mk AS (SELECT DISTINCT l_orderkey % 500 AS image, l_linenumber % 2 AS odd, l_linenumber::BIGINT AS mask, l_partkey % 60 AS pixel FROM lineitem),
size AS (SELECT image, odd, mask, count(*) AS n FROM mk GROUP BY 1, 2, 3),
det AS (SELECT image, 'm' AS cls, mask AS det, (mask * 7 + image * 13) % 101 / 101.0::DOUBLE AS conf FROM size WHERE odd = 1), gt AS (SELECT image, 'm' AS cls, mask AS gt FROM size WHERE odd = 0),
both_ AS (SELECT a.image, a.mask AS det, b.mask AS gt, count(*) AS n FROM mk a JOIN mk b ON a.image = b.image AND a.pixel = b.pixel AND a.odd = 1 AND b.odd = 0 GROUP BY 1, 2, 3),
pairs AS (SELECT x.image, 'm' AS cls, x.det, conf, x.gt, x.n / (p.n + q.n - x.n + 1e-7::DOUBLE) AS iou FROM both_ x JOIN size p ON p.image = x.image AND p.mask = x.det JOIN size q ON q.image = x.image AND q.mask = x.gt JOIN det ON det.image = x.image AND det.det = x.det)"""


@entry(average_precision(_MASKS))
def mask_average_precision(spark, sf):
    rows = table(spark, sf, "lineitem")
    pixels = rows.select((F.col("l_orderkey") % 500).alias("image"), F.col("l_linenumber").cast("long").alias("mask"), (F.col("l_partkey") % 60).alias("pixel")).distinct()
    found, truth = pixels.where("mask % 2 = 1"), pixels.where("mask % 2 = 0")
    conf = (F.col("mask") * 7 + F.col("image") * 13) % 101 / F.lit(101.0)
    dets = found.select("image", "mask").distinct().select("image", F.lit("m").alias("cls"), F.col("mask").alias("det"), conf.alias("conf"))
    gts = truth.select("image", "mask").distinct().select("image", F.lit("m").alias("cls"), F.col("mask").alias("gt"))
    pairs = matching.mask_iou(found, truth).select("image", F.lit("m").alias("cls"), F.col("left_mask").alias("det"), F.col("right_mask").alias("gt"), "iou")
    return curves.average_precision(dets, gts, matching.match_pairs(pairs, LEVELS), LEVELS).select("cls", "threshold", "n_truth", F.round("ap", 6).alias("ap"))


_TASK = f"""{ANN}, base AS (SELECT a.image, a.det AS anchor, b.gt, b.cls, CASE WHEN a.cls = b.cls THEN a.conf ELSE a.conf / 2 END AS score,
  greatest(0.0::DOUBLE, least(a.x2, b.x2) - greatest(a.x1, b.x1)) * greatest(0.0::DOUBLE, least(a.y2, b.y2) - greatest(a.y1, b.y1)) AS inter, {sql_area('a')} + {sql_area('b')} AS areas,
  greatest(a.x2, b.x2) - least(a.x1, b.x1) AS hw, greatest(a.y2, b.y2) - least(a.y1, b.y1) AS hh, a.x1 + a.x2 - b.x1 - b.x2 AS dx, a.y1 + a.y2 - b.y1 - b.y2 AS dy,
  atan((a.x2 - a.x1) / (a.y2 - a.y1 + 1e-7::DOUBLE)) - atan((b.x2 - b.x1) / (b.y2 - b.y1 + 1e-7::DOUBLE)) AS turn
  FROM det a JOIN gt b ON a.image = b.image AND least((a.x1 + a.x2) / 2 - b.x1, (a.y1 + a.y2) / 2 - b.y1, b.x2 - (a.x1 + a.x2) / 2, b.y2 - (a.y1 + a.y2) / 2) > 1e-9::DOUBLE),
io AS (SELECT *, inter / (areas - inter + 1e-7::DOUBLE) AS iou, turn * turn * (4 / ({PI} * {PI})) AS v FROM base),
ov AS (SELECT *, greatest(0.0::DOUBLE, iou - ((dx * dx + dy * dy) / 4) / (hw * hw + hh * hh + 1e-7::DOUBLE) - v * v / (v - iou + (1 + 1e-7::DOUBLE))) AS overlap FROM io),
ms AS (SELECT *, score * power(overlap, 6.0::DOUBLE) AS measure FROM ov),
pk AS (SELECT *, row_number() OVER (PARTITION BY image, gt ORDER BY measure DESC, anchor) <= 2 AS pick, row_number() OVER (PARTITION BY image, anchor ORDER BY overlap DESC, gt) = 1 AS most FROM ms),
ct AS (SELECT *, sum(pick::INT) OVER (PARTITION BY image, anchor) AS picks FROM pk),
mine AS (SELECT * FROM ct WHERE CASE WHEN picks > 1 THEN most ELSE pick END)"""


@entry(f"WITH {_TASK} SELECT image, anchor, gt, cls, round(measure * max(overlap) OVER w / (max(measure) OVER w + 1e-9::DOUBLE), 6) AS weight FROM mine WINDOW w AS (PARTITION BY image, gt)")
def task_aligned(spark, sf):
    b = bx.box()
    kinds = F.create_map(*[x for c in "ANR" for x in (F.lit(c), F.when(F.col("cls") == c, F.col("conf")).otherwise(F.col("conf") / 2))])
    preds = detections(spark, sf).withColumns({"anchor": F.col("det"), "ax": (b.x1 + b.x2) / 2, "ay": (b.y1 + b.y2) / 2, "scores": kinds})
    return assignment.task_aligned(preds, ground_truth(spark, sf), 2).select("image", "anchor", "gt", "cls", F.round("weight", 6).alias("weight"))


@entry("SELECT l_orderkey AS image, l_linenumber AS mask, l_partkey % 60 AS u, l_suppkey % 40 AS v FROM lineitem WHERE l_partkey % 60 >= 10 AND l_partkey % 60 < 10 + l_linenumber * 5 AND l_suppkey % 40 >= 4 AND l_suppkey % 40 < 30")
def cropped_masks(spark, sf):
    rows = table(spark, sf, "lineitem")
    pixels = rows.select(F.col("l_orderkey").alias("image"), F.col("l_linenumber").alias("mask"), (F.col("l_partkey") % 60).alias("u"), (F.col("l_suppkey") % 40).alias("v"))
    boxes = pixels.select("image", "mask").distinct().select("image", "mask", F.lit(10).alias("x1"), F.lit(4).alias("y1"), (F.col("mask") * 5 + 10).alias("x2"), F.lit(30).alias("y2"))
    return manifest.inside_boxes(pixels, boxes, ["image", "mask"])


@entry("""
WITH px AS (SELECT DISTINCT l_orderkey % 300 AS image, l_linenumber AS mask, l_partkey % 40 AS pixel FROM lineitem), s AS (SELECT image, mask, row_number() OVER (PARTITION BY image ORDER BY count(*) DESC, mask) AS number FROM px GROUP BY 1, 2)
SELECT image, pixel, max(number)::INT AS number FROM px JOIN s USING (image, mask) GROUP BY 1, 2""")
def topmost_masks(spark, sf):
    pixels = table(spark, sf, "lineitem").select((F.col("l_orderkey") % 300).alias("image"), F.col("l_linenumber").alias("mask"), (F.col("l_partkey") % 40).alias("pixel")).distinct()
    return manifest.topmost(pixels)


@entry("SELECT l_orderkey, l_linenumber, CASE l_partkey % 7 WHEN 0 THEN 255 WHEN 1 THEN 0 WHEN 2 THEN 255 WHEN 5 THEN 1 ELSE l_partkey % 7 END::INT AS mapped, CASE l_suppkey % 5 WHEN 0 THEN 1 WHEN 1 THEN 5 ELSE l_suppkey % 5 END::INT AS back FROM lineitem")
def mapped_labels(spark, sf):
    mapping = manifest.label_mapping({0: "ignore_label", 1: 0, "2": None, 5: " 1 "})
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", manifest.map_labels(F.col("l_partkey") % 7, mapping).alias("mapped"), manifest.map_labels(F.col("l_suppkey") % 5, mapping, inverse=True).alias("back"))


@entry("SELECT p_partkey, CASE WHEN p_size % 4 = 0 THEN 'not readable' WHEN p_size < 10 OR p_partkey % 50 < 10 THEN 'too small' WHEN p_partkey % 3 = 0 THEN 'unknown format' END AS fault FROM part")
def image_faults(spark, sf):
    path = F.concat("p_name", F.when(F.col("p_partkey") % 3 == 0, ".gif").otherwise(".JPG"))
    return table(spark, sf, "part").select("p_partkey", manifest.image_fault(path, F.when(F.col("p_size") % 4 != 0, F.col("p_size")), (F.col("p_partkey") % 50).cast("int")).alias("fault"))
