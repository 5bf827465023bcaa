"""Box geometry as column expressions: they stay inside whole-stage code generation."""

from __future__ import annotations

from math import pi
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

EPS = 1e-7


class Box(NamedTuple):
    """Corner columns of an axis-aligned box."""

    x1: Column
    y1: Column
    x2: Column
    y2: Column

    @property
    def width(self) -> Column:
        return self.x2 - self.x1

    @property
    def height(self) -> Column:
        return self.y2 - self.y1

    @property
    def area(self) -> Column:
        return self.width * self.height


def box(prefix: str = "", names: tuple[str, str, str, str] = ("x1", "y1", "x2", "y2")) -> Box:
    return Box(*[F.col(prefix + n) for n in names])


def from_center(cx: Column, cy: Column, w: Column, h: Column) -> Box:
    return Box(cx - w / 2, cy - h / 2, cx + w / 2, cy + h / 2)


def from_top_left(x: Column, y: Column, w: Column, h: Column) -> Box:
    return Box(x, y, x + w, y + h)


def to_center(b: Box) -> tuple[Column, Column, Column, Column]:
    return (b.x1 + b.x2) / 2, (b.y1 + b.y2) / 2, b.width, b.height


def to_top_left(b: Box) -> tuple[Column, Column, Column, Column]:
    return b.x1, b.y1, b.width, b.height


def center_to_top_left(cx: Column, cy: Column, w: Column, h: Column) -> tuple[Column, Column, Column, Column]:
    return cx - w / 2, cy - h / 2, w, h


def top_left_to_center(x: Column, y: Column, w: Column, h: Column) -> tuple[Column, Column, Column, Column]:
    return x + w / 2, y + h / 2, w, h


def from_normalised(cx: Column, cy: Column, w: Column, h: Column, width: Column, height: Column, pad_x: float = 0.0, pad_y: float = 0.0) -> Box:
    """Pixel corners of a centre box given in shares of the image."""
    b = from_center(cx * width, cy * height, w * width, h * height)
    return Box(b.x1 + pad_x, b.y1 + pad_y, b.x2 + pad_x, b.y2 + pad_y)


def to_normalised(b: Box, width: Column, height: Column, eps: float | None = None) -> tuple[Column, Column, Column, Column]:
    """Centre box in shares of the image; ``eps`` clips first, that far inside the far edges."""
    if eps is not None:
        b = clip(b, width - eps, height - eps)
    cx, cy, w, h = to_center(b)
    return cx / width, cy / height, w / width, h / height


def _clamp(v: Column, top: Column) -> Column:
    return F.least(F.greatest(v, F.lit(0.0)), top)


def clip(b: Box, width: Column, height: Column) -> Box:
    return Box(_clamp(b.x1, width), _clamp(b.y1, height), _clamp(b.x2, width), _clamp(b.y2, height))


def letterbox(from_w: Column, from_h: Column, to_w: Column, to_h: Column) -> tuple[Column, Column, Column]:
    """Gain and paddings (x, y) that fit an image into a frame with bars on both sides."""
    gain = F.least(to_h / from_h, to_w / from_w)
    pad = lambda to, own: F.rint((to - F.rint(own * gain)) / 2 - 0.1)
    return gain, pad(to_w, from_w), pad(to_h, from_h)


def undo_letterbox(b: Box, shown_w: Column, shown_h: Column, width: Column, height: Column) -> Box:
    """Boxes on the fitted frame back to the image's own pixels, clipped to it."""
    gain, px, py = letterbox(width, height, shown_w, shown_h)
    return clip(Box((b.x1 - px) / gain, (b.y1 - py) / gain, (b.x2 - px) / gain, (b.y2 - py) / gain), width, height)


def intersection(a: Box, b: Box) -> Column:
    zero = F.lit(0.0)
    w = F.greatest(zero, F.least(a.x2, b.x2) - F.greatest(a.x1, b.x1))
    h = F.greatest(zero, F.least(a.y2, b.y2) - F.greatest(a.y1, b.y1))
    return w * h


def iou(a: Box, b: Box, eps: float = EPS) -> Column:
    inter = intersection(a, b)
    return inter / (a.area + b.area - inter + eps)


def ioa(a: Box, b: Box, eps: float = EPS) -> Column:
    """The share of ``b`` that ``a`` covers."""
    return intersection(a, b) / (b.area + eps)


def overlaps(a: Box, b: Box) -> Column:
    """A cheap necessary condition for a positive intersection."""
    return (a.x1 < b.x2) & (b.x1 < a.x2) & (a.y1 < b.y2) & (b.y1 < a.y2)


def vertical_iou(a: Box, b: Box, eps: float = EPS) -> Column:
    """Overlap of the vertical extents over their hull."""
    return (F.least(a.y2, b.y2) - F.greatest(a.y1, b.y1)) / (F.greatest(a.y2, b.y2) - F.least(a.y1, b.y1) + eps)


def association_costs(track: Box, det: Box, track_score: Column, det_score: Column, eps: float = EPS) -> dict[str, Column]:
    """What it costs to give a detection to a track: ``apart`` by overlap, ``fused`` with the detection's score, ``tall``
    by overlap and common height, and ``unlike`` by their scores."""
    near = iou(track, det, eps)
    tall = near * F.greatest(vertical_iou(track, det, eps), F.lit(0.0))
    return {"apart": 1 - near, "fused": 1 - near * det_score, "tall": 1 - tall, "unlike": F.abs(track_score - det_score)}


def _hull(a: Box, b: Box) -> tuple[Column, Column]:
    return F.greatest(a.x2, b.x2) - F.least(a.x1, b.x1), F.greatest(a.y2, b.y2) - F.least(a.y1, b.y1)


def generalised_iou(a: Box, b: Box, eps: float = EPS) -> Column:
    """IoU less the share of the hull that neither box covers."""
    inter = intersection(a, b)
    union = a.area + b.area - inter + eps
    w, h = _hull(a, b)
    hull = w * h + eps
    return inter / union - (hull - union) / hull


def distance_iou(a: Box, b: Box, eps: float = EPS) -> Column:
    """IoU less the squared centre distance over the squared hull diagonal."""
    w, h = _hull(a, b)
    dx, dy = b.x1 + b.x2 - a.x1 - a.x2, b.y1 + b.y2 - a.y1 - a.y2
    return iou(a, b, eps) - ((dx * dx + dy * dy) / 4) / (w * w + h * h + eps)


def complete_iou(a: Box, b: Box, eps: float = EPS) -> Column:
    """Distance IoU less a weighted term for unlike aspect ratios."""
    turn = F.atan(b.width / (b.height + eps)) - F.atan(a.width / (a.height + eps))
    v = turn * turn * (4 / pi**2)
    return distance_iou(a, b, eps) - v * v / (v - iou(a, b, eps) + (1 + eps))


class RotatedBox(NamedTuple):
    """Centre, size and angle (radians)."""

    cx: Column
    cy: Column
    w: Column
    h: Column
    angle: Column


def rotated_corners(r: RotatedBox) -> Column:
    """The four corners as an array of (x, y), going round."""
    cos, sin = F.cos(r.angle), F.sin(r.angle)
    ux, uy, vx, vy = r.w / 2 * cos, r.w / 2 * sin, -r.h / 2 * sin, r.h / 2 * cos
    at = lambda su, sv: F.struct((r.cx + su * ux + sv * vx).alias("x"), (r.cy + su * uy + sv * vy).alias("y"))
    return F.array(at(1, 1), at(1, -1), at(-1, -1), at(-1, 1))


def regular_angle(r: RotatedBox) -> RotatedBox:
    """The same box with its angle in [0, pi / 2), sides swapped where needed."""
    turned = F.pmod(r.angle, F.lit(pi)) >= pi / 2
    return RotatedBox(r.cx, r.cy, F.when(turned, r.h).otherwise(r.w), F.when(turned, r.w).otherwise(r.h), F.pmod(r.angle, F.lit(pi / 2)))


def _covariance(r: RotatedBox, floor: float = 0.0) -> tuple[Column, Column, Column]:
    a, b = r.w * r.w / 12 + floor, r.h * r.h / 12 + floor
    cos, sin = F.cos(r.angle), F.sin(r.angle)
    return a * cos * cos + b * sin * sin, a * sin * sin + b * cos * cos, (a - b) * cos * sin


def gaussian_similarity(p: RotatedBox, q: RotatedBox, eps: float = EPS, aspect: bool = False, floor: float = 0.0) -> Column:
    """One less the Hellinger distance of the boxes taken as normal distributions.

    ``floor`` is added to the variances; ``aspect`` takes off a weighted term for unlike aspect ratios.
    """
    a1, b1, c1 = _covariance(p, floor)
    a2, b2, c2 = _covariance(q, floor)
    a, b, c = a1 + a2, b1 + b2, c1 + c2
    dx, dy = p.cx - q.cx, p.cy - q.cy
    det = a * b - c * c
    near = (a * dy * dy + b * dx * dx) / (det + eps) * 0.25 + (c * -dx * dy) / (det + eps) * 0.5
    own = F.sqrt(F.greatest(F.lit(0.0), a1 * b1 - c1 * c1) * F.greatest(F.lit(0.0), a2 * b2 - c2 * c2))
    spread = F.log(det / (4 * own + eps) + eps) * 0.5
    coefficient = F.least(F.greatest(near + spread, F.lit(eps)), F.lit(100.0))
    likeness = 1 - F.sqrt(1.0 - F.exp(-coefficient) + eps)
    if not aspect:
        return likeness
    turn = F.atan(q.w / q.h) - F.atan(p.w / p.h)
    v = turn * turn * (4 / pi**2)
    return likeness - v * v / (v - likeness + (1 + eps))


def keypoint_similarity(truth: Column, found: Column, area: Column, sigmas: list[float], eps: float = EPS) -> Column:
    """Mean over the visible true points of exp(-d^2 / (2 area (2 sigma)^2)); arrays of (x, y, v)."""
    sigma = F.array(*[F.lit(float(s)) for s in sigmas])
    terms = F.transform(
        F.arrays_zip(truth.alias("t"), found.alias("f"), sigma.alias("s")),
        lambda z: F.when(
            z["t"]["v"] != 0,
            F.exp(-(F.pow(z["t"]["x"] - z["f"]["x"], 2) + F.pow(z["t"]["y"] - z["f"]["y"], 2)) / (F.pow(2 * z["s"], 2) * (area + eps) * 2)),
        ).otherwise(0.0),
    )
    seen = F.size(F.filter(truth, lambda t: t["v"] != 0))
    return F.aggregate(terms, F.lit(0.0), lambda a, x: a + x) / (seen + eps)


def snap_to_border(b: Box, width: Column, height: Column, within: float = 20) -> Box:
    """Moves edges that lie near the image's border onto it."""
    near, far = lambda v: F.when(v < within, F.lit(0.0)).otherwise(v), lambda v, m: F.when(v > m - within, m).otherwise(v)
    return Box(near(b.x1), near(b.y1), far(b.x2, width), far(b.y2, height))


def near_crop_edge(b: Box, crop: Box, image: Box, within: float = 20) -> Column:
    """Whether a side lies on the crop's edge but not on the image's; boxes are relative to the crop."""
    shifted = Box(b.x1 + crop.x1, b.y1 + crop.y1, b.x2 + crop.x1, b.y2 + crop.y1)
    checks = [(F.abs(s - c) <= within) & (F.abs(s - i) > within) for s, c, i in zip(shifted, crop, image)]
    return checks[0] | checks[1] | checks[2] | checks[3]


def to_distances(anchor_x: Column, anchor_y: Column, b: Box, top: float | None = None) -> tuple[Column, ...]:
    """Distances from an anchor to left, top, right, bottom, kept below ``top`` if given."""
    d = (anchor_x - b.x1, anchor_y - b.y1, b.x2 - anchor_x, b.y2 - anchor_y)
    return d if top is None else tuple(F.least(F.greatest(x, F.lit(0.0)), F.lit(top - 0.01)) for x in d)


def from_distances(anchor_x: Column, anchor_y: Column, left: Column, top: Column, right: Column, bottom: Column) -> Box:
    return Box(anchor_x - left, anchor_y - top, anchor_x + right, anchor_y + bottom)


def rotated_from_distances(anchor_x: Column, anchor_y: Column, left: Column, top: Column, right: Column, bottom: Column, angle: Column) -> RotatedBox:
    """A rotated box from distances along its own axes."""
    dx, dy = (right - left) / 2, (bottom - top) / 2
    return RotatedBox(anchor_x + dx * F.cos(angle) - dy * F.sin(angle), anchor_y + dx * F.sin(angle) + dy * F.cos(angle), left + right, top + bottom, angle)


def rotated_to_distances(anchor_x: Column, anchor_y: Column, r: RotatedBox, top: float | None = None) -> tuple[Column, ...]:
    """Distances from an anchor to a rotated box's sides along its own axes, kept below ``top`` if given."""
    cos, sin = F.cos(r.angle), F.sin(r.angle)
    dx, dy = anchor_x - r.cx, anchor_y - r.cy
    along, across = dx * cos + dy * sin, dy * cos - dx * sin
    d = (r.w / 2 + along, r.h / 2 + across, r.w / 2 - along, r.h / 2 - across)
    return d if top is None else tuple(F.least(F.greatest(x, F.lit(0.0)), F.lit(top - 0.01)) for x in d)


def candidate(before: Box, after: Box, min_side: float = 2, max_aspect: float = 100, min_area: float = 0.1, eps: float = 1e-16) -> Column:
    """Whether a transformed box is still worth keeping."""
    aspect = F.greatest(after.width / (after.height + eps), after.height / (after.width + eps))
    return (after.width > min_side) & (after.height > min_side) & (after.area / (before.area + eps) > min_area) & (aspect < max_aspect)


def affine_box(b: Box, m: list[list[float]]) -> Box:
    """The upright hull of the box's four corners under a 3 x 3 matrix."""
    xs, ys = [], []
    for x, y in ((b.x1, b.y1), (b.x2, b.y2), (b.x1, b.y2), (b.x2, b.y1)):
        w = x * m[2][0] + y * m[2][1] + m[2][2]
        xs.append((x * m[0][0] + y * m[0][1] + m[0][2]) / w)
        ys.append((x * m[1][0] + y * m[1][1] + m[1][2]) / w)
    return Box(F.least(*xs), F.least(*ys), F.greatest(*xs), F.greatest(*ys))
