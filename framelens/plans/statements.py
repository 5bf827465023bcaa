"""DuckDB statements that give the rows of the registered queries."""

from __future__ import annotations

from . import datasets, geometry
from .precision import MATCHES, average_precision
from .views import ANN, FRAMES, sql_area, sql_inter, sql_iou

ZONE_IN = "(cx > 30 AND cx < 80 AND cy > 50 AND cy < 150)"


def _crossings(points: list[tuple[float, float]], x: str, y: str) -> str:
    parts = []
    for (ax, ay), (bx, by) in zip(points, [*points[1:], points[0]]):
        if ay != by:
            parts.append(f"CASE WHEN ({ay} > {y}) <> ({by} > {y}) AND {x} < ({bx} - {ax})::DOUBLE * ({y} - {ay}) / ({by} - {ay})::DOUBLE + {ax} THEN 1 ELSE 0 END")
    return " + ".join(parts)


def _on_edge(points: list[tuple[float, float]], x: str, y: str) -> str:
    parts = []
    for (ax, ay), (bx, by) in zip(points, [*points[1:], points[0]]):
        parts.append(f"(({x} - {ax}) * ({by} - {ay}) = ({y} - {ay}) * ({bx} - {ax}) AND {x} BETWEEN {min(ax, bx)} AND {max(ax, bx)} AND {y} BETWEEN {min(ay, by)} AND {max(ay, by)})")
    return "(" + " OR ".join(parts) + ")"


def _inside(points: list[tuple[float, float]], x: str = "cx", y: str = "cy", edge: bool = False) -> str:
    odd = f"(({_crossings(points, x, y)}) % 2 = 1)"
    return f"({odd} OR {_on_edge(points, x, y)})" if edge else f"({odd} AND NOT {_on_edge(points, x, y)})"


ZONE = [(30, 50), (80, 50), (80, 150), (30, 150)]
CONCAVE = [(10, 20), (90, 20), (90, 160), (50, 90), (10, 160)]
HULL = [(10, 20), (90, 20), (90, 160), (10, 160)]
SLOT = [(0, 0), (30, 0), (30, 50), (0, 50)]

def _side(ax: str, ay: str, bx: str, by: str, x: str, y: str) -> str:
    return f"(({bx} - {ax}) * ({y} - {ay}) - ({by} - {ay}) * ({x} - {ax}))"


def _meets(points: list[tuple[float, float]]) -> str:
    """Whether the step (px, py) to (cx, cy) touches an edge."""
    parts = []
    for (ax, ay), (bx, by) in zip(points, [*points[1:], points[0]]):
        d1, d2 = _side(ax, ay, bx, by, "px", "py"), _side(ax, ay, bx, by, "cx", "cy")
        d3, d4 = _side("px", "py", "cx", "cy", ax, ay), _side("px", "py", "cx", "cy", bx, by)
        low = lambda u, v: (min(u, v), max(u, v))
        on = lambda x, y: f"{x} BETWEEN {low(ax, bx)[0]} AND {low(ax, bx)[1]} AND {y} BETWEEN {low(ay, by)[0]} AND {low(ay, by)[1]}"
        step = lambda x, y: f"{x} BETWEEN least(px, cx) AND greatest(px, cx) AND {y} BETWEEN least(py, cy) AND greatest(py, cy)"
        parts.append(f"(sign({d1}) * sign({d2}) < 0 AND sign({d3}) * sign({d4}) < 0) OR ({d1} = 0 AND {on('px', 'py')}) OR ({d2} = 0 AND {on('cx', 'cy')}) OR ({d3} = 0 AND {step(ax, ay)}) OR ({d4} = 0 AND {step(bx, by)})")
    return "(" + " OR ".join(parts) + ")"


PAIRS = f"""{ANN},
pairs AS (SELECT d.image, d.cls, d.det, d.conf, g.gt, {sql_iou('d', 'g')} AS iou FROM det d JOIN gt g ON d.image = g.image AND d.cls = g.cls
  WHERE d.x1 < g.x2 AND g.x1 < d.x2 AND d.y1 < g.y2 AND g.y1 < d.y2),
{MATCHES}"""

CONFUSION = f"""{ANN},
pairs AS (SELECT d.image, d.det, g.gt, d.cls AS dc, g.cls AS gc, {sql_iou('d', 'g')} AS iou FROM det d JOIN gt g ON d.image = g.image WHERE d.conf > 0.25),
once AS (SELECT * FROM pairs WHERE iou > 0.45 QUALIFY row_number() OVER (PARTITION BY image, det ORDER BY iou DESC, gt) = 1),
matches AS (SELECT * FROM once QUALIFY row_number() OVER (PARTITION BY image, gt ORDER BY iou DESC, det) = 1),
cells AS (
  SELECT dc AS predicted, gc AS actual FROM matches
  UNION ALL SELECT 'background', cls FROM gt ANTI JOIN matches USING (image, gt)
  UNION ALL SELECT cls, 'background' FROM (SELECT * FROM det WHERE conf > 0.25) ANTI JOIN matches USING (image, det))"""

OWN_PAIRS = f"WITH {ANN}, p AS (SELECT a.image, a.i, b.i AS j, a AS a, b AS b FROM ann a JOIN ann b ON a.image = b.image AND a.i < b.i)"


def _hash(seed: int, key: str) -> str:
    return f"md5('{seed}|' || {key}::VARCHAR)"


SIGNATURES = f"WITH {ANN}, sig AS (SELECT image, array_to_string(list_sort(list(DISTINCT cls)), ',') AS signature FROM ann GROUP BY image), sizes AS (SELECT signature, count(*) AS n FROM sig GROUP BY signature)"
# Whole rounds: 0 to 40 are enough for the strata of these tables; the last round goes by falling size.
ALLOCATED = """, base AS (SELECT signature, n, least(greatest(1, round_even(n * 500.0::DOUBLE / sum(n) OVER (), 0)), n)::BIGINT AS b FROM sizes),
room AS (SELECT *, 500 - sum(b) OVER () AS rest, CASE WHEN 500 - sum(b) OVER () >= 0 THEN n - b ELSE b - 1 END AS room FROM base),
paid AS (SELECT r, (SELECT sum(least(room, r)) FROM room) AS cost FROM range(0, 2000) t(r)),
whole AS (SELECT max(r) AS r, max(cost) AS cost FROM paid WHERE cost <= (SELECT abs(max(rest)) FROM room)),
turn AS (SELECT room.*, whole.r AS r, CASE WHEN room > whole.r AND sum(CASE WHEN room > whole.r THEN 1 ELSE 0 END) OVER (ORDER BY n DESC, signature) <= abs(rest) - whole.cost THEN 1 ELSE 0 END AS extra FROM room, whole),
taken AS (SELECT signature, n, (b + sign(rest) * (least(room, r) + extra))::BIGINT AS take FROM turn)"""

VOXELS = """WITH p AS (SELECT floor(value / 20.0::DOUBLE)::BIGINT AS a, floor((event_id * 37) % 200 / 20.0::DOUBLE)::BIGINT AS b, floor(user_id % 50 / 20.0::DOUBLE)::BIGINT AS c FROM events),
v AS (SELECT a - (SELECT min(a) FROM p) AS gx, b - (SELECT min(b) FROM p) AS gy, c - (SELECT min(c) FROM p) AS gz FROM p)"""

ORACLE_SQL: dict[str, str] = {
    "dataset_stats_category": """
SELECT l_returnflag AS category, count(*) AS instances, count(DISTINCT l_orderkey) AS images,
  round(count(*)::DOUBLE / sum(count(*)) OVER (), 6) AS instance_share, round(count(DISTINCT l_orderkey)::DOUBLE / (SELECT count(*) FROM orders), 6) AS image_share
FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders) GROUP BY l_returnflag""",
    "unannotated_images": "SELECT o_orderkey AS image FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)",
    "top_resolutions_other": """
WITH c AS (SELECT p_size::VARCHAR || 'x' || p_type AS kind, count(*) AS n FROM part GROUP BY 1), r AS (SELECT *, row_number() OVER (ORDER BY n DESC, kind) AS rank FROM c),
u AS (SELECT rank::INT AS rank, kind, n, 1::BIGINT AS kinds FROM r WHERE rank <= 10 UNION ALL SELECT 11, 'other', sum(n)::BIGINT, count(*) FROM r WHERE rank > 10 HAVING count(*) > 0)
SELECT rank, kind, n, kinds, round(n::DOUBLE / sum(n) OVER (), 6) AS share FROM u""",
    "split_composition": """
WITH j AS (SELECT * FROM lineitem JOIN orders ON l_orderkey = o_orderkey), s AS (SELECT o_orderstatus, count(DISTINCT l_orderkey) AS n FROM j GROUP BY 1)
SELECT o_orderstatus AS split, l_returnflag AS category, count(DISTINCT l_orderkey) AS images, count(*) AS instances, round(count(DISTINCT l_orderkey)::DOUBLE / max(n), 6) AS share
FROM j JOIN s USING (o_orderstatus) GROUP BY 1, 2""",
    "detection_totals": f"WITH {ANN} SELECT cls, count(*) AS n, count(DISTINCT image) AS images FROM det GROUP BY ROLLUP (cls)",
    "describe_images": f"""
WITH {ANN}, c AS (SELECT image, cls, count(*) AS n FROM ann GROUP BY 1, 2)
SELECT image, string_agg(n::VARCHAR || ' ' || lower(cls) || CASE WHEN n > 1 THEN 's' ELSE '' END, ', ' ORDER BY cls) AS summary FROM c GROUP BY image""",
    "class_signature": f"{SIGNATURES} SELECT image, signature FROM sig",
    "stratified_allocation": f"{SIGNATURES}{ALLOCATED} SELECT signature, n, take FROM taken",
    "stratified_sample": f"""{SIGNATURES}{ALLOCATED},
ranked AS (SELECT *, row_number() OVER (PARTITION BY signature ORDER BY {_hash(7, 'image')}, image) AS r FROM sig)
SELECT image, signature FROM ranked JOIN taken USING (signature) WHERE r <= take""",
    "hash_split": f"""
SELECT doc_id, CASE WHEN u < 0.9::DOUBLE THEN 'train' WHEN u < 1.0::DOUBLE THEN 'val' ELSE 'test' END AS split
FROM (SELECT doc_id, ('0x' || substr({_hash(3, 'doc_id')}, 1, 7))::BIGINT / 268435456.0::DOUBLE AS u FROM documents)""",
    "per_class_split": f"""
SELECT doc_id, lang, CASE WHEN row_number() OVER (PARTITION BY lang ORDER BY {_hash(3, 'doc_id')}, doc_id) <= floor(count(*) OVER (PARTITION BY lang) * 0.8::DOUBLE) THEN 'train' ELSE 'val' END AS split FROM documents""",
    "ranked_split": f"""
WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY {_hash(5, 'o_orderkey')}, o_orderkey) AS r, count(*) OVER () AS n FROM orders)
SELECT o_orderkey, CASE WHEN r <= round_even(n * 0.8::DOUBLE, 0) THEN 'train' WHEN r <= round_even(n * 0.8::DOUBLE, 0) + round_even(n * 0.1::DOUBLE, 0) THEN 'val' ELSE 'test' END AS split FROM r""",
    "linspace_sample": """
WITH r AS (SELECT doc_id, source, row_number() OVER (ORDER BY doc_id) - 1 AS r, count(*) OVER () AS n FROM documents)
SELECT doc_id, source FROM r WHERE r IN (SELECT (i * (SELECT max(n) - 1 FROM r)) // 36 FROM range(0, 37) t(i))""",
    "exact_dedup": """
SELECT doc_id, digest, copy::INT AS copy FROM (SELECT doc_id, sha256(text) AS digest, row_number() OVER (PARTITION BY sha256(text) ORDER BY doc_id) - 1 AS copy FROM documents) WHERE copy > 0""",
    "merge_renumber": """
WITH u AS (SELECT 0 AS part, n_nationkey AS old_id, n_name AS name FROM nation UNION ALL SELECT 1, r_regionkey, r_name FROM region)
SELECT old_id, name, part, row_number() OVER (ORDER BY part, name, old_id) AS new_id FROM u""",
    "append_renumbered": """
SELECT s_suppkey AS id, s_name AS name FROM supplier
UNION ALL SELECT (SELECT max(s_suppkey) FROM supplier) + row_number() OVER (ORDER BY c_name, c_custkey), c_name FROM customer""",
    "padded_names": "SELECT p_partkey::VARCHAR AS stem, lpad((99 + row_number() OVER (ORDER BY p_partkey))::VARCHAR, 6, '0') AS new_stem FROM part",
    "orphan_check": "SELECT o_custkey AS key, o_orderkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)",
    "category_conflict": "SELECT p_size, count(DISTINCT p_type) AS n_values FROM part GROUP BY p_size HAVING count(DISTINCT p_type) > 1",
    "batch_shapes": """
WITH r AS (SELECT p_partkey, (p_partkey % 40 + 10)::DOUBLE / (p_size + 5) AS ar FROM part), n AS (SELECT *, (row_number() OVER (ORDER BY ar, p_partkey) - 1) // 16 AS batch FROM r),
b AS (SELECT batch, count(*) AS n, min(ar) AS low, max(ar) AS high FROM n GROUP BY batch)
SELECT batch, n, round(low, 6) AS low, round(high, 6) AS high, (ceil(CASE WHEN high < 1 THEN high ELSE 1.0::DOUBLE END * 640 / 32 + 0.5::DOUBLE) * 32)::INT AS bh,
  (ceil(CASE WHEN high < 1 THEN 1.0::DOUBLE WHEN low > 1 THEN 1.0::DOUBLE / low ELSE 1.0::DOUBLE END * 640 / 32 + 0.5::DOUBLE) * 32)::INT AS bw FROM b""",
    "json_explode": """
SELECT event_id, k AS name, json_extract_string(props, '$.' || k) AS value FROM (SELECT event_id, props, unnest(json_keys(props)) AS k FROM events)""",
    "box_convert": f"""
WITH {ANN}, c AS (SELECT *, greatest(0, least(x1, 640)) AS a1, greatest(0, least(y1, 480)) AS b1, greatest(0, least(x2, 640)) AS a2, greatest(0, least(y2, 480)) AS b2 FROM ann)
SELECT image, i, (x1 + x2) / 2 AS cx, (y1 + y2) / 2 AS cy, x2 - x1 AS w, y2 - y1 AS h,
  (a1 + a2) / 2 / 640 AS nx, (b1 + b2) / 2 / 480 AS ny, (a2 - a1) / 640 AS nw, (b2 - b1) / 480 AS nh FROM c""",
    "scale_clip": f"""
WITH {ANN} SELECT image, i, round(least(greatest(x1 * 8 / 2, 0), 320), 6) AS x1, round(least(greatest((y1 * 8 - 120) / 2, 0), 200), 6) AS y1,
  round(least(greatest(x2 * 8 / 2, 0), 320), 6) AS x2, round(least(greatest((y2 * 8 - 120) / 2, 0), 200), 6) AS y2 FROM ann""",
    "pairwise_iou": f"{OWN_PAIRS}, v AS (SELECT image, i, j, round({sql_iou('a', 'b')}, 6) AS iou, round({sql_inter('a', 'b')} / ({sql_area('b')} + 1e-7::DOUBLE), 6) AS ioa FROM p) SELECT * FROM v WHERE iou > 0",
    "giou_diou_ciou": f"""{OWN_PAIRS},
m AS (SELECT *, {sql_inter('a', 'b')} AS inter, greatest(a.x2, b.x2) - least(a.x1, b.x1) AS hw, greatest(a.y2, b.y2) - least(a.y1, b.y1) AS hh,
  atan((b.x2 - b.x1) / (b.y2 - b.y1 + 1e-7::DOUBLE)) - atan((a.x2 - a.x1) / (a.y2 - a.y1 + 1e-7::DOUBLE)) AS turn FROM p),
u AS (SELECT *, {sql_area('a')} + {sql_area('b')} - inter + 1e-7::DOUBLE AS un, hw * hh + 1e-7::DOUBLE AS hull, turn * turn * (4 / (pi() * pi())) AS v,
  ((b.x1 + b.x2 - a.x1 - a.x2) * (b.x1 + b.x2 - a.x1 - a.x2) + (b.y1 + b.y2 - a.y1 - a.y2) * (b.y1 + b.y2 - a.y1 - a.y2)) / 4 / (hw * hw + hh * hh + 1e-7::DOUBLE) AS far FROM m)
SELECT image, i, j, round(inter / un - (hull - un) / hull, 6) + 0.0::DOUBLE AS giou, round(inter / un - far, 6) + 0.0::DOUBLE AS diou, round(inter / un - far - v * v / (v - inter / un + (1 + 1e-7::DOUBLE)), 6) + 0.0::DOUBLE AS ciou FROM u""",
    "rotated_similarity": f"""{OWN_PAIRS},
c AS (SELECT image, i, j, pow(a.x2 - a.x1, 2) / 12 AS pa, pow(a.y2 - a.y1, 2) / 12 AS pb, pow(b.x2 - b.x1, 2) / 12 AS qa, pow(b.y2 - b.y1, 2) / 12 AS qb, a.conf AS pt, b.conf AS qt,
  (a.x1 + a.x2) / 2 - (b.x1 + b.x2) / 2 AS dx, (a.y1 + a.y2) / 2 - (b.y1 + b.y2) / 2 AS dy FROM p),
k AS (SELECT *, pa * cos(pt) * cos(pt) + pb * sin(pt) * sin(pt) AS a1, pa * sin(pt) * sin(pt) + pb * cos(pt) * cos(pt) AS b1, (pa - pb) * cos(pt) * sin(pt) AS c1,
  qa * cos(qt) * cos(qt) + qb * sin(qt) * sin(qt) AS a2, qa * sin(qt) * sin(qt) + qb * cos(qt) * cos(qt) AS b2, (qa - qb) * cos(qt) * sin(qt) AS c2 FROM c),
d AS (SELECT *, (a1 + a2) * (b1 + b2) - (c1 + c2) * (c1 + c2) AS det FROM k),
t AS (SELECT image, i, j, ((a1 + a2) * dy * dy + (b1 + b2) * dx * dx) / (det + 1e-7::DOUBLE) * 0.25::DOUBLE + (c1 + c2) * -dx * dy / (det + 1e-7::DOUBLE) * 0.5::DOUBLE
  + ln(det / (4 * sqrt(greatest(0, a1 * b1 - c1 * c1) * greatest(0, a2 * b2 - c2 * c2)) + 1e-7::DOUBLE) + 1e-7::DOUBLE) * 0.5::DOUBLE AS bd FROM d)
SELECT image, i, j, round(1 - sqrt(1.0::DOUBLE - exp(-least(greatest(bd, 1e-7::DOUBLE), 100)) + 1e-7::DOUBLE), 6) AS similarity FROM t""",
    "matrix_nms": f"""
WITH {ANN} SELECT image, cls, i AS det FROM ann a WHERE NOT EXISTS (SELECT 1 FROM ann b WHERE a.image = b.image AND a.cls = b.cls AND (b.conf > a.conf OR (b.conf = a.conf AND b.i < a.i))
  AND {sql_iou('a', 'b', '0.0::DOUBLE')} >= 0.5)""",
    "greedy_nms": f"""
WITH RECURSIVE {ANN}, o AS (SELECT *, row_number() OVER (PARTITION BY image, cls ORDER BY conf DESC, i) AS r FROM ann),
fold AS (
  SELECT image, cls, r, [i] AS kept FROM o WHERE r = 1
  UNION ALL
  SELECT f.image, f.cls, o.r, CASE WHEN EXISTS (SELECT 1 FROM ann b WHERE b.image = o.image AND list_contains(f.kept, b.i) AND {sql_iou('b', 'o', '0.0::DOUBLE')} > 0.5) THEN f.kept ELSE list_append(f.kept, o.i) END
  FROM fold f JOIN o ON o.image = f.image AND o.cls = f.cls AND o.r = f.r + 1)
SELECT image, cls, unnest(kept)::BIGINT AS det FROM (SELECT * FROM fold QUALIFY row_number() OVER (PARTITION BY image, cls ORDER BY r DESC) = 1)""",
    "filter_decoded": f"""
WITH {ANN} SELECT image, cls, i AS det, round(conf, 6) AS conf FROM ann WHERE conf > 0.25 AND cls IN ('A', 'R') QUALIFY row_number() OVER (PARTITION BY image ORDER BY conf DESC, i) <= 2""",
    "match_at_thresholds": f"WITH {PAIRS} SELECT image, cls, threshold, det, gt, round(iou, 6) AS iou FROM matches",
    "confusion_matrix": f"WITH {CONFUSION} SELECT predicted, actual, count(*) AS n FROM cells GROUP BY 1, 2",
    "confusion_norm": "SELECT toxic AS predicted, quality AS actual, count(*) AS n, round(count(*) / (sum(count(*)) OVER (PARTITION BY quality) + 1e-9::DOUBLE), 6) AS share FROM labels GROUP BY 1, 2",
    "hits_and_false": f"""
WITH {CONFUSION} SELECT predicted AS cls, sum((predicted = actual)::INT)::BIGINT AS tp, sum((predicted <> actual)::INT)::BIGINT AS fp FROM cells WHERE predicted <> 'background' GROUP BY 1""",
    "average_precision": average_precision(PAIRS[: -len(MATCHES)].rstrip().rstrip(",")),
    "image_scores": f"""
WITH {PAIRS}, d AS (SELECT image, count(*) AS nd FROM det GROUP BY 1), g AS (SELECT image, count(*) AS ng FROM gt GROUP BY 1), m AS (SELECT image, count(*) AS tp FROM matches WHERE threshold = 0.5 GROUP BY 1),
s AS (SELECT coalesce(d.image, g.image) AS image, coalesce(nd, 0) AS nd, coalesce(ng, 0) AS ng FROM d FULL JOIN g ON d.image = g.image),
t AS (SELECT s.*, coalesce(tp, 0) AS tp FROM s LEFT JOIN m USING (image)),
r AS (SELECT *, CASE WHEN nd > 0 THEN tp::DOUBLE / nd WHEN ng > 0 THEN 0 ELSE 1 END AS p, CASE WHEN ng > 0 THEN tp::DOUBLE / ng WHEN nd > 0 THEN 0 ELSE 1 END AS q FROM t)
SELECT image, tp, nd - tp AS fp, ng - tp AS fn, round(p, 6) AS precision, round(q, 6) AS recall, round(CASE WHEN p + q > 0 THEN 2 * p * q / (p + q) ELSE 0 END, 6) AS f1 FROM r""",
    "topk_accuracy": """
WITH v AS (SELECT vec_id, label, generate_subscripts(embedding[1:10], 1) - 1 AS c, unnest(embedding[1:10]) AS s FROM embeddings), r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY s DESC, c) AS k FROM v),
h AS (SELECT vec_id, max((k = 1 AND c = label)::INT) AS a, max((k <= 5 AND c = label)::INT) AS b FROM r GROUP BY vec_id)
SELECT round(avg(a), 6) AS top1, round(avg(b), 6) AS top5 FROM h""",
    "semantic_iou": """
WITH c(cls) AS (VALUES (0), (1)) SELECT cls::INT AS cls, round((SELECT count(*) FROM labels WHERE toxic = cls AND quality = cls)::DOUBLE / (SELECT count(*) FROM labels WHERE toxic = cls OR quality = cls), 6) AS iou,
  (SELECT count(*) FROM labels WHERE quality = cls) > 0 AS present FROM c""",
    "depth_metrics": """
WITH s AS (SELECT l_orderkey, sum(l_quantity) AS predicted FROM lineitem GROUP BY 1),
v AS (SELECT o_custkey AS image, predicted, o_totalprice / 5000 AS actual FROM orders JOIN s ON o_orderkey = l_orderkey WHERE o_totalprice / 5000 > 1e-3 AND o_totalprice / 5000 < 120 AND predicted > 0),
z AS (SELECT image, count(*) AS n, quantile_disc(actual, 0.5) / quantile_disc(predicted, 0.5) AS ratio FROM v GROUP BY 1 HAVING count(*) >= 5),
p AS (SELECT image, least(greatest(predicted * ratio, 1e-3), 120) AS p, actual AS g FROM v JOIN z USING (image))
SELECT image, count(*) AS n, round(avg((greatest(p / g, g / p) < 1.25)::INT), 6) AS d1, round(avg((greatest(p / g, g / p) < 1.5625)::INT), 6) AS d2, round(avg((greatest(p / g, g / p) < 1.953125)::INT), 6) AS d3,
  round(avg(abs(p - g) / g), 6) AS abs_rel, round(sqrt(avg((p - g) * (p - g))), 6) AS rmse,
  round(sqrt(greatest(0, avg((ln(p) - ln(g)) * (ln(p) - ln(g))) - avg(ln(p) - ln(g)) * avg(ln(p) - ln(g)))), 6) AS silog FROM p GROUP BY image""",
    "class_weights": "WITH c AS (SELECT event_type AS cls, count(*) AS n FROM events GROUP BY 1) SELECT cls, n, round(pow(1.0::DOUBLE / n, 0.5) / avg(pow(1.0::DOUBLE / n, 0.5)) OVER (), 6) AS weight FROM c",
    "hist2d": """
SELECT least(floor(l_quantity / 1.0::DOUBLE), 49)::INT AS bx, least(floor(l_extendedprice / 2000.0::DOUBLE), 49)::INT AS by, count(*) AS n FROM lineitem
WHERE l_quantity BETWEEN 0 AND 50 AND l_extendedprice BETWEEN 0 AND 100000 GROUP BY 1, 2""",
    "sigma_clip": """
WITH a AS (SELECT value FROM events), s1 AS (SELECT avg(value) m, stddev_pop(value) s FROM a), b AS (SELECT value FROM a, s1 WHERE value BETWEEN m - 2 * s AND m + 2 * s),
s2 AS (SELECT avg(value) m, stddev_pop(value) s FROM b), c AS (SELECT value FROM b, s2 WHERE value BETWEEN m - 2 * s AND m + 2 * s),
s3 AS (SELECT avg(value) m, stddev_pop(value) s FROM c), d AS (SELECT value FROM c, s3 WHERE value BETWEEN m - 2 * s AND m + 2 * s)
SELECT count(*) AS n, round(avg(value), 6) AS mean FROM d""",
    "linear_fit": "SELECT p_brand, round(regr_slope(p_retailprice, p_size), 6) AS slope, round(regr_intercept(p_retailprice, p_size), 6) AS intercept, regr_count(p_retailprice, p_size)::BIGINT AS n FROM part GROUP BY p_brand",
    "running_best": "SELECT event_type, event_id, value, max(value) OVER (PARTITION BY event_type ORDER BY event_id) AS best FROM events",
    "cosine_topk": """
WITH s AS (SELECT q.vec_id AS query, e.vec_id, list_dot_product(e.embedding::DOUBLE[], q.embedding::DOUBLE[]) / sqrt(list_dot_product(q.embedding::DOUBLE[], q.embedding::DOUBLE[])) AS score FROM embeddings e, embeddings q WHERE q.vec_id % 100 = 0)
SELECT query, vec_id, round(score, 6) AS score FROM (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY query ORDER BY score DESC, vec_id) <= 10) WHERE score >= 0.1""",
    "unit_vectors": "SELECT vec_id, 1.0::DOUBLE AS norm FROM embeddings",
    "track_history": f"""
WITH {FRAMES} SELECT track, frame, count(*) OVER w::INT AS length, first_value(cx) OVER w AS oldest_x FROM frames WINDOW w AS (PARTITION BY track ORDER BY frame ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)""",
    "line_count": f"""
WITH {FRAMES}, s AS (SELECT *, lag(cx) OVER (PARTITION BY track ORDER BY frame) AS px FROM frames), m AS (SELECT * FROM s WHERE px IS NOT NULL AND (px - 50) * (cx - 50) <= 0 QUALIFY row_number() OVER (PARTITION BY track ORDER BY frame) = 1)
SELECT stream, cls, sum((cx > px)::INT)::BIGINT AS n_in, sum((NOT cx > px)::INT)::BIGINT AS n_out FROM m GROUP BY 1, 2""",
    "polygon_count": f"""
WITH {FRAMES}, i AS (SELECT *, {_inside(ZONE)} AS inn FROM frames),
s AS (SELECT *, lag(cx) OVER w AS px, lag(cy) OVER w AS py, lag(inn) OVER w AS was, list({{'x': cx, 'y': cy, 'i': inn}}) OVER (PARTITION BY track ORDER BY frame ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS five
  FROM i WINDOW w AS (PARTITION BY track ORDER BY frame)),
h AS (SELECT * FROM s WHERE px IS NOT NULL AND (inn OR (NOT was AND {_meets(ZONE)})) QUALIFY row_number() OVER (PARTITION BY track ORDER BY frame) = 1),
b AS (SELECT *, coalesce(list_filter(five, lambda p: NOT p.i)[1], five[1]) AS o FROM h)
SELECT stream, track, frame, CASE WHEN CASE WHEN abs(cx - o.x) > abs(cy - o.y) THEN cx > o.x ELSE cy > o.y END THEN 'IN' ELSE 'OUT' END AS direction FROM b""",
    "region_count": f"""
WITH {FRAMES} SELECT stream, frame, 'zone' AS region, sum({ZONE_IN}::INT)::BIGINT AS n FROM frames GROUP BY 1, 2
UNION ALL SELECT stream, frame, 'concave', sum({_inside(CONCAVE)}::INT)::BIGINT FROM frames GROUP BY 1, 2""",
    "queue_count": f"WITH {FRAMES} SELECT stream, frame, sum(({ZONE_IN} AND frame > 1)::INT)::BIGINT AS n FROM frames GROUP BY 1, 2",
    "occupancy": f"""
WITH {FRAMES}, o AS (SELECT stream, frame, max((floor(cx) BETWEEN 30 AND 80 AND floor(cy) BETWEEN 50 AND 150)::INT) + max((floor(cx) BETWEEN 0 AND 30 AND floor(cy) BETWEEN 0 AND 50)::INT) AS occupied FROM frames GROUP BY 1, 2)
SELECT stream, frame, occupied, 2 - occupied AS available FROM o""",
    "speed": f"""
WITH {FRAMES}, e AS (SELECT a.stream, a.track, sqrt((b.cx - a.cx) * (b.cx - a.cx) + (b.cy - a.cy) * (b.cy - a.cy)) AS px, (b.frame - a.frame) / 30.0::DOUBLE AS dt FROM frames a JOIN frames b ON a.track = b.track AND a.frame = 1 AND b.frame = 5)
SELECT stream, track, floor(least(px * 0.05::DOUBLE / dt * 3.6::DOUBLE, 120))::INT AS speed FROM e""",
    "heatmap": f"""
WITH {FRAMES}, b AS (SELECT floor(cx - 4)::BIGINT AS x0, floor(cy - 4)::BIGINT AS y0, floor(cx + 4)::BIGINT AS x1, floor(cy + 4)::BIGINT AS y1 FROM frames),
k AS (SELECT *, least(x1 - x0, y1 - y0) // 2 AS r, floor((x0 + x1) / 2)::BIGINT AS mx, floor((y0 + y1) / 2)::BIGINT AS my FROM b),
c AS (SELECT *, unnest(range(greatest(x0, 0), least(x1, 160))) AS px FROM k), d AS (SELECT *, unnest(range(greatest(y0, 0), least(y1, 200))) AS py FROM c)
SELECT px, py, (count(*) * 2)::BIGINT AS heat FROM d WHERE (px - mx) * (px - mx) + (py - my) * (py - my) <= r * r GROUP BY 1, 2""",
    "tumbling_counts": f"WITH {FRAMES} SELECT stream, CASE WHEN frame <= 1 THEN 0 ELSE ceil(frame / 10.0::DOUBLE)::BIGINT END AS refresh, count(*) AS n FROM frames GROUP BY 1, 2",
    "class_shares": f"WITH {FRAMES} SELECT stream, frame, cls, count(*) AS n, round(count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY stream, frame), 6) AS share FROM frames GROUP BY 1, 2, 3",
    "last45": f"WITH {FRAMES} SELECT track, frame, cx FROM frames QUALIFY row_number() OVER (PARTITION BY track ORDER BY frame DESC) <= 45",
    "fsm_count": f"""
WITH {FRAMES}, n AS (SELECT *, CASE WHEN cx < 20 THEN 'down' WHEN cx > 60 THEN 'up' END AS now FROM frames),
s AS (SELECT *, last_value(now IGNORE NULLS) OVER (PARTITION BY track ORDER BY frame) AS stage FROM n), b AS (SELECT *, lag(stage) OVER (PARTITION BY track ORDER BY frame) AS before FROM s)
SELECT track, frame, stage, (sum(CASE WHEN now = 'down' AND before = 'up' THEN 1 ELSE 0 END) OVER (PARTITION BY track ORDER BY frame))::BIGINT AS count FROM b""",
    "alarm_first_frame": f"WITH {FRAMES}, c AS (SELECT stream, frame, count(*) AS n FROM frames GROUP BY 1, 2) SELECT stream, min(frame) AS frame FROM c WHERE n >= 30 GROUP BY 1",
    "track_zone": f"WITH {FRAMES} SELECT track, frame, cx, cy FROM frames WHERE {_inside(HULL, edge=True)}",
    "track_distance": f"""
WITH {FRAMES} SELECT a.stream, a.frame, round(sqrt(pow(floor(b.cx) - floor(a.cx), 2) + pow(floor(b.cy) - floor(a.cy), 2)), 6) AS distance FROM frames a JOIN frames b ON a.stream = b.stream AND a.frame = b.frame AND a.track = 1 AND b.track = 5""",
    "flip_clip": f"""
WITH {ANN}, f AS (SELECT image, i, least(greatest(50 - x2, 0), 50) AS x1, least(greatest(60 - y2, 0), 60) AS y1, least(greatest(50 - x1, 0), 50) AS x2, least(greatest(60 - y1, 0), 60) AS y2 FROM ann)
SELECT * FROM f WHERE x2 > x1 AND y2 > y1""",
    "affine_boxes": f"""
WITH {ANN}, c AS (SELECT image, i, x1, y1, x2, y2, unnest([{{'x': x1, 'y': y1}}, {{'x': x2, 'y': y2}}, {{'x': x1, 'y': y2}}, {{'x': x2, 'y': y1}}]) AS p FROM ann),
t AS (SELECT image, i, any_value((x2 - x1) * (y2 - y1)) AS old, min(p.x * 0.8::DOUBLE + p.y * 0.1::DOUBLE + 2) AS ax, min(p.x * -0.1::DOUBLE + p.y * 0.9::DOUBLE + 3) AS ay, max(p.x * 0.8::DOUBLE + p.y * 0.1::DOUBLE + 2) AS bx, max(p.x * -0.1::DOUBLE + p.y * 0.9::DOUBLE + 3) AS dy FROM c GROUP BY 1, 2),
k AS (SELECT image, i, old, least(greatest(ax, 0), 60) AS x1, least(greatest(ay, 0), 50) AS y1, least(greatest(bx, 0), 60) AS x2, least(greatest(dy, 0), 50) AS y2 FROM t)
SELECT image, i, round(x1, 6) AS x1, round(y1, 6) AS y1, round(x2, 6) AS x2, round(y2, 6) AS y2 FROM k WHERE x2 - x1 > 2 AND y2 - y1 > 2 AND (x2 - x1) * (y2 - y1) / (old + 1e-16::DOUBLE) > 0.1 AND greatest((x2 - x1) / (y2 - y1), (y2 - y1) / (x2 - x1)) < 100""",
    "tile_windows": """
WITH p AS (SELECT p_partkey, p_partkey * 13 % 3000 + 200 AS width, p_partkey * 7 % 2500 + 200 AS height FROM part),
x AS (SELECT DISTINCT p.*, CASE WHEN i > 0 AND i * 824 + 1024 > width THEN width - 1024 ELSE i * 824 END AS tx1 FROM p, range(0, 10) t(i) WHERE i < CASE WHEN width <= 1024 THEN 1 ELSE ceil((width - 1024) / 824.0::DOUBLE) + 1 END),
y AS (SELECT DISTINCT x.*, CASE WHEN i > 0 AND i * 824 + 1024 > height THEN height - 1024 ELSE i * 824 END AS ty1 FROM x, range(0, 10) t(i) WHERE i < CASE WHEN height <= 1024 THEN 1 ELSE ceil((height - 1024) / 824.0::DOUBLE) + 1 END),
s AS (SELECT *, (least(tx1 + 1024, width) - tx1) * (least(ty1 + 1024, height) - ty1) / 1048576.0::DOUBLE AS shown FROM y), b AS (SELECT *, max(shown) OVER (PARTITION BY p_partkey) AS best FROM s)
SELECT p_partkey, width, height, tx1, ty1, tx1 + 1024 AS tx2, ty1 + 1024 AS ty2 FROM b WHERE shown > 0.6 OR (best <= 0.6 AND shown = best)""",
    "clean_names": "SELECT p_partkey, regexp_replace(p_name || '#(+)', '[|@#!¡·$€%&()=?¿^*;:,¨`><+]', '_', 'g') AS name FROM part",
    "area_buckets": f"""
WITH {ANN}, a AS (SELECT cls, (x2 - x1) * (y2 - y1) AS area FROM ann)
SELECT cls, CASE WHEN area < 1024 THEN 'small' WHEN area < 9216 THEN 'medium' ELSE 'large' END AS bucket, count(*) AS n FROM a GROUP BY 1, 2""",
    "score_bands": f"WITH {ANN} SELECT CASE WHEN conf >= 0.25 THEN 'high' WHEN conf > 0.1 THEN 'low' ELSE 'none' END AS band, count(*) AS n FROM ann GROUP BY 1",
    "keep_classes": "SELECT l_returnflag AS cls, count(*) AS n FROM lineitem WHERE l_returnflag IN ('A', 'N') GROUP BY 1",
    "voxel_counts": f"{VOXELS} SELECT gx, gy, gz, count(*) AS n FROM v GROUP BY 1, 2, 3",
    "voxel_neighbours": f"""{VOXELS}, c AS (SELECT DISTINCT gx, gy, gz FROM v)
SELECT a.gx, a.gy, a.gz, count(b.gx) AS n FROM c a LEFT JOIN c b ON abs(a.gx - b.gx) <= 1 AND abs(a.gy - b.gy) <= 1 AND abs(a.gz - b.gz) <= 1 AND (a.gx <> b.gx OR a.gy <> b.gy OR a.gz <> b.gz) GROUP BY 1, 2, 3""",
    "mask_iou": """
WITH m AS (SELECT DISTINCT l_orderkey % 500 AS image, l_linenumber::BIGINT AS mask, l_partkey % 60 AS pixel FROM lineitem), s AS (SELECT image, mask, count(*) AS n FROM m GROUP BY 1, 2),
x AS (SELECT a.image, a.mask AS left_mask, b.mask AS right_mask, count(*) AS k FROM m a JOIN m b ON a.image = b.image AND a.pixel = b.pixel AND a.mask % 2 = 1 AND b.mask % 2 = 0 GROUP BY 1, 2, 3)
SELECT x.image, left_mask, right_mask, round(k / (p.n + q.n - k + 1e-7::DOUBLE), 6) AS iou FROM x JOIN s p ON p.image = x.image AND p.mask = left_mask JOIN s q ON q.image = x.image AND q.mask = right_mask""",
    "mask_boxes": "SELECT l_orderkey % 500 AS image, l_linenumber AS mask, min(l_partkey % 60) AS x1, min(l_suppkey % 40) AS y1, max(l_partkey % 60) AS x2, max(l_suppkey % 40) AS y2 FROM lineitem GROUP BY 1, 2",
    "pixel_shares": "SELECT l_linestatus AS image, l_returnflag AS cls, count(*) AS n, round(count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY l_linestatus), 6) AS share FROM lineitem GROUP BY 1, 2",
    "metric_means": "SELECT user_id % 5 AS dataset, event_type AS metric, round(avg(value), 6) AS mean FROM events GROUP BY 1, 2",
    "mosaic_boxes": f"""
WITH {ANN}, p AS (SELECT o_orderkey // 4 AS mosaic, image, i, x1 + (o_orderkey % 4 % 2) * 40 AS x1, y1 + (o_orderkey % 4 // 2) * 40 AS y1, x2 + (o_orderkey % 4 % 2) * 40 AS x2, y2 + (o_orderkey % 4 // 2) * 40 AS y2 FROM ann JOIN orders ON o_orderkey = image),
c AS (SELECT mosaic, image, i, least(greatest(x1, 0), 80) AS x1, least(greatest(y1, 0), 80) AS y1, least(greatest(x2, 0), 80) AS x2, least(greatest(y2, 0), 80) AS y2 FROM p)
SELECT * FROM c WHERE x2 > x1 AND y2 > y1""",
    "paste_candidates": f"""
WITH {ANN}, c AS (SELECT d.image, d.det AS candidate, coalesce(max({sql_inter('g', 'd')} / ({sql_area('d')} + 1e-7::DOUBLE)), 0) AS covered FROM det d LEFT JOIN gt g ON d.image = g.image GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY image ORDER BY covered, candidate) AS r, count(*) OVER (PARTITION BY image) AS n FROM c WHERE covered < 0.3)
SELECT image, candidate, round(covered, 6) AS covered FROM r WHERE r <= round_even(n * 0.5::DOUBLE, 0)""",
    "nearly_same_dropped": f"""
WITH {ANN} SELECT image, i FROM ann a WHERE conf > 0.1 AND NOT EXISTS (SELECT 1 FROM ann b WHERE a.image = b.image AND b.conf > 0.7 AND {sql_iou('a', 'b')} > 0.6)""",
    "vocabulary_numbers": "SELECT p_brand, p_type, (row_number() OVER (PARTITION BY p_brand ORDER BY p_type) - 1)::INT AS number FROM (SELECT DISTINCT p_brand, p_type FROM part)",
    "letterbox_gain": """
WITH s AS (SELECT p_partkey, (p_size * 10 + 5)::DOUBLE AS w, (p_partkey % 37 * 10 + 8)::DOUBLE AS h FROM part), g AS (SELECT *, least(480 / h, 640 / w) AS gain FROM s)
SELECT p_partkey, round(gain, 6) AS gain, round_even((640 - round_even(w * gain, 0)) / 2 - 0.1::DOUBLE, 0) AS pad_x, round_even((480 - round_even(h * gain, 0)) / 2 - 0.1::DOUBLE, 0) AS pad_y FROM g""",
}

ORACLE_SQL["pr_best_f1"] = f"WITH {datasets.BEST_F1} SELECT cls, point::INT AS point, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1 FROM f1 JOIN top USING (point)"
for part in (geometry, datasets):
    ORACLE_SQL.update(part.entries.statements)
