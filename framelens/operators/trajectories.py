"""Trajectory analytics over tracked detections: ``stream, track, frame, cx, cy`` and what an operator adds.

A track is one object in one stream; windows run over a track, whose rows are bounded by its life.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framelens.functions.polygons import Points, contains, convex_hull, crosses_outline, segments_meet

TRACK = ["stream", "track"]


def _by_frame(keys: list[str] | None = None):
    return Window.partitionBy(*(keys or TRACK)).orderBy("frame")


def track_history(points: DataFrame, length: int = 30) -> DataFrame:
    """Adds ``history``: the last positions of the track, this one included."""
    recent = _by_frame().rowsBetween(-(length - 1), 0)
    return points.withColumn("history", F.collect_list(F.struct(F.col("cx").alias("x"), F.col("cy").alias("y"))).over(recent))


def _first_of_track(rows: DataFrame) -> DataFrame:
    return rows.withColumn("_r", F.row_number().over(_by_frame())).where("_r = 1").drop("_r")


def line_crossings(points: DataFrame, a: tuple[float, float], b: tuple[float, float]) -> DataFrame:
    """The first crossing of each track with ``direction``: rightward (steep line) or downward is IN."""
    steps = points.withColumn("px", F.lag("cx").over(_by_frame())).withColumn("py", F.lag("cy").over(_by_frame()))
    met = steps.where(F.col("px").isNotNull() & segments_meet(F.col("px"), F.col("py"), F.col("cx"), F.col("cy"), a, b))
    steep = abs(a[0] - b[0]) < abs(a[1] - b[1])
    forward = F.col("cx") > F.col("px") if steep else F.col("cy") > F.col("py")
    return _first_of_track(met).withColumn("direction", F.when(forward, "IN").otherwise("OUT")).drop("px", "py")


def polygon_entries(points: DataFrame, polygon: Points) -> DataFrame:
    """The first time each track is inside, or steps through from outside, with ``direction``.

    The direction is that of the larger displacement since the oldest of the last five points that is outside (or the
    oldest at all): rightward or downward is IN. A track needs a previous position.
    """
    inside = contains(F.col("cx"), F.col("cy"), polygon)
    rows = points.withColumn("_in", inside)
    recent = _by_frame().rowsBetween(-4, 0)
    rows = rows.withColumn("px", F.lag("cx").over(_by_frame())).withColumn("py", F.lag("cy").over(_by_frame())).withColumn("_was", F.lag("_in").over(_by_frame()))
    rows = rows.withColumn("_five", F.collect_list(F.struct(F.col("cx").alias("x"), F.col("cy").alias("y"), F.col("_in").alias("i"))).over(recent))
    through = ~F.col("_was") & crosses_outline(F.col("px"), F.col("py"), F.col("cx"), F.col("cy"), polygon)
    hits = _first_of_track(rows.where(F.col("px").isNotNull() & (F.col("_in") | through)))
    base = F.coalesce(F.get(F.filter("_five", lambda p: ~p["i"]), F.lit(0)), F.get("_five", F.lit(0)))
    dx, dy = F.col("cx") - base["x"], F.col("cy") - base["y"]
    forward = F.when(F.abs(dx) > F.abs(dy), dx > 0).otherwise(dy > 0)
    return hits.withColumn("direction", F.when(forward, "IN").otherwise("OUT")).drop("px", "py", "_in", "_was", "_five")


def crossing_totals(crossings: DataFrame, keys: list[str]) -> DataFrame:
    """IN and OUT counts for each key."""
    return crossings.groupBy(*keys).agg(F.count_if(F.col("direction") == "IN").alias("n_in"), F.count_if(F.col("direction") == "OUT").alias("n_out"))


def region_counts(points: DataFrame, regions: dict[str, Points]) -> DataFrame:
    """stream, frame, region, n: objects strictly inside each region, zeros included."""
    for name, polygon in regions.items():
        if len(polygon) < 3:
            raise ValueError(f"region {name} needs three points")
    names = list(regions)
    counts = [F.count_if(contains(F.col("cx"), F.col("cy"), regions[n])).alias(f"_c{i}") for i, n in enumerate(names)]
    wide = points.groupBy("stream", "frame").agg(*counts)
    pairs = F.array(*[F.struct(F.lit(n).alias("region"), F.col(f"_c{i}").alias("n")) for i, n in enumerate(names)])
    return wide.select("stream", "frame", F.inline(pairs))


def queue_counts(points: DataFrame, polygon: Points) -> DataFrame:
    """stream, frame, n: tracks inside that have been seen before."""
    seen = points.withColumn("_r", F.row_number().over(_by_frame()))
    inside = contains(F.col("cx"), F.col("cy"), polygon) & (F.col("_r") > 1)
    return seen.groupBy("stream", "frame").agg(F.count_if(inside).alias("n"))


def slot_occupancy(points: DataFrame, slots: list[Points]) -> DataFrame:
    """stream, frame, occupied, available: a slot is taken by a truncated centre inside or on its outline."""
    taken = [F.max(contains(F.floor("cx").cast("double"), F.floor("cy").cast("double"), s, boundary=True).cast("int")) for s in slots]
    total = taken[0]
    for t in taken[1:]:
        total = total + t
    return points.groupBy("stream", "frame").agg(total.alias("occupied")).withColumn("available", F.lit(len(slots)) - F.col("occupied"))


def speeds(points: DataFrame, length: int, fps: float, metres_per_pixel: float, top: int) -> DataFrame:
    """stream, track, speed (km/h, truncated): over the first ``length`` observations and the frames they span."""
    rows = points.withColumn("_r", F.row_number().over(_by_frame())).where(F.col("_r").isin(1, length))
    at = lambda r, c: F.max(F.when(F.col("_r") == r, F.col(c)))
    ends = rows.groupBy(*TRACK).agg(*[at(r, c).alias(f"{c}{i}") for i, r in enumerate((1, length)) for c in ("frame", "cx", "cy")]).where("frame1 > frame0")
    dx, dy = F.col("cx1") - F.col("cx0"), F.col("cy1") - F.col("cy0")
    dt = (F.col("frame1") - F.col("frame0")) / F.lit(float(fps))
    return ends.select(*TRACK, F.floor(F.least(F.sqrt(dx * dx + dy * dy) * metres_per_pixel / dt * 3.6, F.lit(float(top)))).cast("int").alias("speed"))


def heat(boxes: DataFrame, width: int, height: int, weight: int = 2) -> DataFrame:
    """px, py, heat: each box adds ``weight`` to the pixels of its inscribed circle, clipped to the frame."""
    x0, y0 = (F.greatest(F.floor(c), F.lit(0)) for c in ("x1", "y1"))
    x1, y1 = F.least(F.floor("x2"), F.lit(width)), F.least(F.floor("y2"), F.lit(height))
    radius = F.floor(F.least(F.floor("x2") - F.floor("x1"), F.floor("y2") - F.floor("y1")) / 2)
    mid_x, mid_y = F.floor((F.floor("x1") + F.floor("x2")) / 2), F.floor((F.floor("y1") + F.floor("y2")) / 2)
    shaped = boxes.select(x0.alias("x0"), y0.alias("y0"), x1.alias("x1"), y1.alias("y1"), radius.alias("r"), mid_x.alias("mx"), mid_y.alias("my")).where("x1 > x0 AND y1 > y0")
    # Equal circles are counted first, so a busy place is multiplied by its pixels once.
    kinds = shaped.groupBy(*shaped.columns).agg(F.count("*").alias("n"))
    columns = kinds.withColumn("px", F.explode(F.sequence("x0", F.col("x1") - 1)))
    cells = columns.withColumn("py", F.explode(F.sequence("y0", F.col("y1") - 1)))
    dx, dy = F.col("px") - F.col("mx"), F.col("py") - F.col("my")
    return cells.where(dx * dx + dy * dy <= F.col("r") * F.col("r")).groupBy("px", "py").agg((F.sum("n") * weight).alias("heat"))


def normalised_heat(cells: DataFrame) -> DataFrame:
    """Heat on a scale of 0 to 255."""
    low, high = cells.agg(F.min("heat"), F.max("heat")).first()
    span = float(max((high or 0) - (low or 0), 1))
    return cells.withColumn("level", (F.col("heat") - (low or 0)) / span * 255)


def refresh_counts(points: DataFrame, every: int) -> DataFrame:
    """stream, refresh, n: detections since the refresh before; the first comes with frame 1, then each ``every``."""
    window = F.when(F.col("frame") <= 1, 0).otherwise(F.ceil(F.col("frame") / every))
    return points.groupBy("stream", window.cast("long").alias("refresh")).agg(F.count("*").alias("n"))


def last_points(rows: DataFrame, keys: list[str], order: str, n: int = 45) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(F.desc(order))
    return rows.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n).drop("_r")


def class_shares(points: DataFrame) -> DataFrame:
    """stream, frame, cls, n and the share of the frame's detections."""
    counts = points.groupBy("stream", "frame", "cls").agg(F.count("*").alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("stream", "frame")))


def hysteresis_counts(values: DataFrame, angle: str, up: float, down: float) -> DataFrame:
    """Adds ``stage`` and ``count``: a repetition counts when the angle falls below ``down`` after it was above ``up``."""
    now = F.when(F.col(angle) < down, "down").when(F.col(angle) > up, "up")
    staged = values.withColumn("_now", now).withColumn("stage", F.last("_now", ignorenulls=True).over(_by_frame().rowsBetween(Window.unboundedPreceding, 0)))
    before = F.lag("stage").over(_by_frame())
    hit = staged.withColumn("_hit", F.when((F.col("_now") == "down") & (before == "up"), 1).otherwise(0))
    return hit.withColumn("count", F.sum("_hit").over(_by_frame().rowsBetween(Window.unboundedPreceding, 0))).drop("_now", "_hit")


def first_alarm(points: DataFrame, records: int) -> DataFrame:
    """stream, frame: the first frame with at least ``records`` detections."""
    counts = points.groupBy("stream", "frame").agg(F.count("*").alias("n")).where(F.col("n") >= records)
    return counts.groupBy("stream").agg(F.min("frame").alias("frame"))


def zone(points: DataFrame, polygon: Points) -> DataFrame:
    """Detections whose centre is in the convex hull of a region."""
    return points.where(contains(F.col("cx"), F.col("cy"), convex_hull(polygon), boundary=True))


def track_distance(points: DataFrame, first, second) -> DataFrame:
    """stream, frame, distance of two tracks' truncated centres."""
    floor = lambda c: F.floor(c).cast("double")
    pick = lambda t, s: points.where(F.col("track") == t).select("stream", "frame", floor(F.col("cx")).alias(f"x{s}"), floor(F.col("cy")).alias(f"y{s}"))
    joined = pick(first, 0).join(pick(second, 1), ["stream", "frame"])
    dx, dy = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    return joined.select("stream", "frame", F.sqrt(dx * dx + dy * dy).alias("distance"))


def stride(points: DataFrame, every: int) -> DataFrame:
    return points.where(F.col("frame") % every == 0)
