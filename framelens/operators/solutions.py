"""Trajectory analytics by name, with layered settings: what a command line asks for."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame

from framelens.config import from_words

from . import trajectories

#: Settings of all solutions: a region is a list of points, two for a line.
DEFAULTS = {
    "region": [[20.0, 400.0], [1080.0, 400.0]], "fps": 30.0, "meter_per_pixel": 0.05, "max_speed": 120, "max_hist": 5, "up_angle": 145.0, "down_angle": 90.0,
    "angle": "angle", "records": 5, "width": 640, "height": 480, "first": None, "second": None,
}


def _points(settings: dict) -> list[tuple[float, float]]:
    return [(float(x), float(y)) for x, y in settings["region"]]


def _count(points: DataFrame, s: dict) -> DataFrame:
    region = _points(s)
    crossed = trajectories.line_crossings(points, *region) if len(region) == 2 else trajectories.polygon_entries(points, region)
    return trajectories.crossing_totals(crossed, ["stream", "cls"])


SOLUTIONS: dict[str, Callable[[DataFrame, dict], DataFrame]] = {
    "count": _count,
    "region": lambda points, s: trajectories.region_counts(points, {"region": _points(s)}),
    "queue": lambda points, s: trajectories.queue_counts(points, _points(s)),
    "parking": lambda points, s: trajectories.slot_occupancy(points, [_points(s)]),
    "speed": lambda points, s: trajectories.speeds(points, s["max_hist"], s["fps"], s["meter_per_pixel"], s["max_speed"]),
    "heatmap": lambda points, s: trajectories.heat(points, s["width"], s["height"]),
    "analytics": lambda points, s: trajectories.class_shares(points),
    "workout": lambda points, s: trajectories.hysteresis_counts(points, s["angle"], s["up_angle"], s["down_angle"]),
    "security": lambda points, s: trajectories.first_alarm(points, s["records"]),
    "trackzone": lambda points, s: trajectories.zone(points, _points(s)),
    "distance": lambda points, s: trajectories.track_distance(points, s["first"], s["second"]),
}


def run_solution(points: DataFrame, words: Iterable[str] = ()) -> DataFrame:
    """The solution that the first word names (none, or one that there isn't: ``count``) under settings like ``records=3``."""
    name, *rest = [*words] or ["count"]
    if "=" in name:
        name, rest = "count", [name, *rest]
    return SOLUTIONS.get(name, SOLUTIONS["count"])(points, from_words(DEFAULTS, rest))
