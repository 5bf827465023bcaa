"""Polygon and segment predicates over arrays of (x, y), as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

Points = list[tuple[float, float]]


def literal(points: Points) -> Column:
    return F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in points])


def _edges(points: Points) -> list[tuple[float, float, float, float]]:
    return [(*a, *b) for a, b in zip(points, [*points[1:], points[0]])]


def on_edge(x: Column, y: Column, points: Points) -> Column:
    """Whether a point lies on the outline of a literal polygon."""
    hit = F.lit(False)
    for ax, ay, bx, by in _edges(points):
        along = (x - ax) * (by - ay) == (y - ay) * (bx - ax)
        hit |= along & x.between(min(ax, bx), max(ax, bx)) & y.between(min(ay, by), max(ay, by))
    return hit


def contains(x: Column, y: Column, points: Points, boundary: bool = False) -> Column:
    """Whether a literal polygon holds a point: parity of the edges crossed by a ray; ``boundary`` counts the outline in."""
    crossed = F.lit(0)
    for ax, ay, bx, by in _edges(points):
        if ay != by:
            spans = (F.lit(ay) > y) != (F.lit(by) > y)
            crossed += F.when(spans & (x < (bx - ax) * (y - ay) / (by - ay) + ax), 1).otherwise(0)
    inside, edge = crossed % 2 == 1, on_edge(x, y, points)
    return inside | edge if boundary else inside & ~edge


def contains_dynamic(x: Column, y: Column, polygon: Column) -> Column:
    """Ray parity against a polygon column (outline not decided)."""
    n = F.size(polygon)
    edges = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(F.get(polygon, i).alias("a"), F.get(polygon, (i + 1) % n).alias("b")))
    crossed = F.filter(edges, lambda e: ((e["a"]["y"] > y) != (e["b"]["y"] > y)) & (x < (e["b"]["x"] - e["a"]["x"]) * (y - e["a"]["y"]) / F.nullif(e["b"]["y"] - e["a"]["y"], F.lit(0.0)) + e["a"]["x"]))
    return F.size(crossed) % 2 == 1


def _side(ax, ay, bx, by, px, py):
    return (bx - ax) * (py - ay) - (by - ay) * (px - ax)


def segments_meet(px: Column, py: Column, qx: Column, qy: Column, a: tuple[float, float], b: tuple[float, float]) -> Column:
    """Whether the step p-q touches the literal segment a-b, end points included."""
    ax, ay = map(F.lit, map(float, a))
    bx, by = map(F.lit, map(float, b))
    d1, d2 = _side(ax, ay, bx, by, px, py), _side(ax, ay, bx, by, qx, qy)
    d3, d4 = _side(px, py, qx, qy, ax, ay), _side(px, py, qx, qy, bx, by)
    split = (F.signum(d1) * F.signum(d2) < 0) & (F.signum(d3) * F.signum(d4) < 0)
    within = lambda ux, uy, vx, vy, x, y: x.between(F.least(ux, vx), F.greatest(ux, vx)) & y.between(F.least(uy, vy), F.greatest(uy, vy))
    touch = ((d1 == 0) & within(ax, ay, bx, by, px, py)) | ((d2 == 0) & within(ax, ay, bx, by, qx, qy)) | ((d3 == 0) & within(px, py, qx, qy, ax, ay)) | ((d4 == 0) & within(px, py, qx, qy, bx, by))
    return split | touch


def crosses_outline(px: Column, py: Column, qx: Column, qy: Column, points: Points) -> Column:
    hit = F.lit(False)
    for ax, ay, bx, by in _edges(points):
        hit |= segments_meet(px, py, qx, qy, (ax, ay), (bx, by))
    return hit


def hull_box(polygon: Column) -> tuple[Column, Column, Column, Column]:
    xs, ys = F.transform(polygon, lambda p: p["x"]), F.transform(polygon, lambda p: p["y"])
    return F.array_min(xs), F.array_min(ys), F.array_max(xs), F.array_max(ys)


def area(polygon: Column) -> Column:
    """Shoelace area."""
    n = F.size(polygon)
    terms = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(polygon, i)["x"] * F.get(polygon, (i + 1) % n)["y"] - F.get(polygon, (i + 1) % n)["x"] * F.get(polygon, i)["y"])
    return F.abs(F.aggregate(terms, F.lit(0.0), lambda a, v: a + v)) / 2


def map_points(polygon: Column, fx, fy) -> Column:
    """The polygon with functions of (x, y) applied to its coordinates."""
    return F.transform(polygon, lambda p: F.struct(fx(p["x"], p["y"]).alias("x"), fy(p["x"], p["y"]).alias("y")))


def clip_points(polygon: Column, width: Column, height: Column) -> Column:
    inside = lambda v, top: F.least(F.greatest(v, F.lit(0.0)), top)
    return map_points(polygon, lambda x, y: inside(x, width), lambda x, y: inside(y, height))


def convex_hull(points: Points) -> Points:
    """The hull of a small literal point set, counter-clockwise (on the driver)."""
    ordered = sorted(set(points))
    if len(ordered) < 3:
        return ordered
    chains = []
    for run in (ordered, ordered[::-1]):
        chain: Points = []
        for p in run:
            while len(chain) > 1 and _side(*chain[-2], *chain[-1], *p) <= 0:
                chain.pop()
            chain.append(p)
        chains.append(chain[:-1])
    return chains[0] + chains[1]
