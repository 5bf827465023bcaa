"""Other trackers over the same step: motion direction, appearance, occlusion, and one pool for all detections."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from .tracker import Detection, SizeState, Track, Tracker, TrackerConfig, boxes_of, iou_cost, predict_all, unit


def _centre(box: np.ndarray) -> np.ndarray:
    return (box[:2] + box[2:]) / 2


@dataclass(frozen=True)
class MotionConfig(TrackerConfig):
    """Fixed defaults: frames back that a direction is taken from, and its weight."""

    low_pass: bool = False
    delta: int = 3
    inertia: float = 0.2


class MotionTracker(Tracker):
    """Adds the turn from a track's direction to the cost, a second try at its last place, and repair after a gap."""

    def direction(self, track: Track) -> np.ndarray | None:
        """The unit step from the newest observation at least ``delta`` frames back (or the oldest) to the last."""
        if len(track.seen) < 2:
            return None
        last, box = track.seen[-1]
        old = next((b for f, b in reversed(track.seen[:-1]) if last - f >= self.config.delta), track.seen[0][1])
        step = _centre(box) - _centre(old)
        size = np.linalg.norm(step)
        return step / size if size > 1e-6 else None

    def turns(self, tracks: list[Track], dets: list[Detection]) -> np.ndarray:
        cost = np.zeros((len(tracks), len(dets)))
        places = np.array([_centre(d.box) for d in dets])
        for i, t in enumerate(tracks):
            way = self.direction(t)
            if way is not None:
                to = places - _centre(t.seen[-1][1])
                size = np.linalg.norm(to, axis=1)
                far = size > 1e-6
                cost[i, far] = np.arccos(np.clip(to[far] @ way / size[far], -1, 1)) / np.pi
        return cost

    def cost(self, tracks: list[Track], dets: list[Detection], fuse: bool) -> np.ndarray:
        return super().cost(tracks, dets, fuse) + getattr(self.config, "inertia", 0.2) * self.turns(tracks, dets)

    def recover(self, tracks: list[Track], dets: list[Detection]) -> tuple[list[Track], list[Detection]]:
        from .tracker import assign

        left: list[Track] = []
        for lost in (False, True):
            some = [t for t in tracks if t.lost == lost]
            if some and dets:
                boxes = np.array([d.box for d in dets])
                cost = iou_cost(np.array([t.seen[-1][1] for t in some]), boxes)
                if self.config.fuse:
                    cost = 1 - (1 - cost) * np.array([d.conf for d in dets])[None, :]
                pairs = assign(cost, self.config.match)
                for i, j in pairs:
                    self.give(some[i], dets[j])
                some = [t for i, t in enumerate(some) if i not in {x for x, _ in pairs}]
                dets = [d for j, d in enumerate(dets) if j not in {y for _, y in pairs}]
            left += some
        return left, dets

    def give(self, track: Track, det: Detection) -> None:
        """A track that was lost first takes the places on the straight way across its gap."""
        if track.lost and track.seen:
            frame, box = track.seen[-1]
            gap = self.steps - frame
            for k in range(1, gap):
                track.correct(box + (det.box - box) * k / gap)
                if k < gap - 1:
                    predict_all([track])
        super().give(track, det)


@dataclass(frozen=True)
class AppearanceConfig(TrackerConfig):
    """Fixed defaults: least overlap and likeness for appearance to count, and the share of the old look."""

    proximity: float = 0.5
    appearance: float = 0.8
    keep: float = 0.9


class AppearanceTracker(Tracker):
    """Takes the lesser of overlap cost and half the cosine distance of looks, where both are near enough."""

    state = SizeState

    def cost(self, tracks: list[Track], dets: list[Detection], fuse: bool) -> np.ndarray:
        base = super().cost(tracks, dets, fuse)
        apart = super().cost(tracks, dets, False)
        looks = np.ones_like(base)
        for i, t in enumerate(tracks):
            for j, d in enumerate(dets):
                if t.feat is not None and d.feat is not None:
                    looks[i, j] = max(0.0, 1 - float(t.feat @ unit(d.feat))) / 2
        looks[(looks > 1 - self.config.appearance) | (apart > 1 - self.config.proximity)] = 1.0
        return np.minimum(base, looks)

    def give(self, track: Track, det: Detection) -> None:
        super().give(track, det)
        look = unit(det.feat)
        if look is not None:
            track.feat = look if track.feat is None else unit(self.config.keep * track.feat + (1 - self.config.keep) * look)


@dataclass(frozen=True)
class MotionAppearanceConfig(AppearanceConfig):
    high: float = 0.3
    new: float = 0.3
    low_pass: bool = False
    delta: int = 3
    inertia: float = 0.2
    appearance: float = 0.9


class MotionAppearanceTracker(MotionTracker, AppearanceTracker):
    """Direction and appearance together."""


@dataclass(frozen=True)
class OcclusionConfig(TrackerConfig):
    """Fixed defaults: cover that counts as hidden, frames hidden before a track is lost, and those a track may go
    unmatched otherwise; states back that speed and place are taken from; growth of the height and damping of the speed;
    frames that a lost track may still come back after it was hidden; and the overlap that bars births (1: none)."""

    cover: float = 0.7
    patience: int = 10
    unmatched: int = 2
    speed_back: int = 5
    place_back: int = 3
    grow: float = 1.1
    damp: float = 0.5
    reappear: int = 40
    bar: float = 0.7


@dataclass
class Hiding:
    """What a track went through: its last states, frames unmatched and hidden, and when it was last found hidden."""

    states: list[tuple[np.ndarray, np.ndarray]]
    unmatched: int = 0
    hidden: int = 0
    since: int | None = None


class OcclusionTracker(Tracker):
    """An unmatched track that a matched one covers is hidden: its state goes back to before, grows and slows down once,
    and it waits longer before it is lost and, once lost, before it is forgotten."""

    def __init__(self, config: OcclusionConfig | None = None) -> None:
        super().__init__(config or OcclusionConfig())
        self.hiding: dict[int, Hiding] = {}
        self.met: list[Track] = []

    def _remember(self, track: Track) -> Hiding:
        past = self.hiding.setdefault(track.track_id, Hiding([]))
        keep = max(self.config.speed_back, self.config.place_back) + 4
        past.states = [*past.states[1 - keep :], (track.mean.copy(), track.cov.copy())]
        return past

    def give(self, track: Track, det: Detection) -> None:
        found = track.lost
        super().give(track, det)
        past = self._remember(track)
        past.unmatched = past.hidden = 0
        if found:
            past.since = None
        else:
            self.met.append(track)

    def birth(self, det: Detection) -> None:
        super().birth(det)
        self._remember(self.tracks[-1])

    def _covers(self, tracks: list[Track]) -> np.ndarray:
        """The largest share of each track that one matched in this frame covers."""
        own, others = boxes_of(tracks), [t.box for t in self.met if t.sure]
        if not others:
            return np.zeros(len(tracks))
        over = np.array(others)
        inter = np.clip(np.minimum(own[:, None, 2:], over[None, :, 2:]) - np.maximum(own[:, None, :2], over[None, :, :2]), 0, None).prod(axis=2)
        return (inter / ((own[:, 2:] - own[:, :2]).prod(axis=1)[:, None] + 1e-7)).max(axis=1)

    def _hide(self, track: Track, past: Hiding) -> None:
        c = self.config
        past.hidden, past.since = 1, self.steps
        if len(past.states) >= c.speed_back:
            track.mean[4:] = past.states[-c.speed_back][0][4:]
        if len(past.states) >= c.place_back:
            mean, cov = past.states[-c.place_back]
            track.mean[:4], track.cov = mean[:4], cov.copy()
        track.mean[3] *= c.grow
        track.mean[4:] *= c.damp

    def lose(self, tracks: list[Track]) -> None:
        for track, cover in zip(tracks, self._covers(tracks) if tracks else []):
            past = self.hiding[track.track_id]
            past.unmatched += 1
            if past.hidden:
                past.hidden += 1
            elif cover > self.config.cover:
                self._hide(track, past)
            if past.since is not None and self.steps - past.since > self.config.reappear:
                past.since = None
            track.lost = past.unmatched > self.config.unmatched and not 0 < past.hidden <= self.config.patience

    def stale(self, track: Track) -> bool:
        since = self.hiding[track.track_id].since
        return super().stale(track) and (since is None or self.steps - since > self.config.reappear)

    def may_start(self, det: Detection) -> bool:
        live = [t.box for t in self.tracks if not t.lost]
        barred = self.config.bar < 1 and live and (1 - iou_cost(np.array(live), det.box[None])).max() >= self.config.bar
        return super().may_start(det) and not barred

    def step(self, dets: list[Detection]) -> list[Track]:
        self.met = []
        out = [t for t in super().step(dets) if t.frame == self.steps]
        ids = {t.track_id for t in self.tracks}
        self.hiding = {k: v for k, v in self.hiding.items() if k in ids}
        return out


def mutual_nearest(cost: np.ndarray, limit: float, shrink: float = 0.05) -> list[tuple[int, int]]:
    """Pairs that are each other's best below a limit that tightens every round, until a round finds none."""
    cost, pairs = cost.copy(), []
    while cost.size and limit > 0:
        best_row, best_column = cost.argmin(axis=1), cost.argmin(axis=0)
        found = [(i, int(j)) for i, j in enumerate(best_row) if best_column[j] == i and cost[i, j] < limit]
        if not found:
            break
        for i, j in found:
            cost[i, :], cost[:, j] = np.inf, np.inf
        pairs += found
        limit -= shrink
    return pairs


@dataclass(frozen=True)
class PoolConfig(TrackerConfig):
    """Fixed defaults of the weights, penalties and limits."""

    high: float = 0.6
    low: float = 0.25
    new: float = 0.7
    match: float = 0.7
    overlap_weight: float = 0.5
    score_weight: float = 0.1
    low_penalty: float = 0.2
    shrink: float = 0.05
    birth_overlap: float = 0.55
    min_length: int = 3


class PoolTracker(Tracker):
    """All detections at once, those of low score at a penalty, by mutual nearest pairs; births away from all tracks."""

    state = SizeState

    def cost(self, tracks: list[Track], dets: list[Detection], fuse: bool) -> np.ndarray:
        c = self.config
        apart = super().cost(tracks, dets, False)
        a, b = boxes_of(tracks), np.array([d.box for d in dets])
        tall = np.clip(np.minimum(a[:, None, 3], b[None, :, 3]) - np.maximum(a[:, None, 1], b[None, :, 1]), 0, None) / (np.maximum(a[:, None, 3], b[None, :, 3]) - np.minimum(a[:, None, 1], b[None, :, 1]) + 1e-7)
        scores = np.array([d.conf for d in dets])
        unlike = np.abs(np.array([t.score for t in tracks])[:, None] - scores[None, :])
        total = c.overlap_weight * 2 * (1 - tall * (1 - apart)) / 2 + 0.5 * apart + c.score_weight * unlike + c.low_penalty * (scores < c.high)[None, :]
        total = np.clip(total, 0, 1)
        total[apart >= 0.9] = 1.0
        return total

    def match(self, tracks: list[Track], dets: list[Detection], limit: float, fuse: bool) -> list[tuple[int, int]]:
        return mutual_nearest(self.cost(tracks, dets, fuse), limit, self.config.shrink) if tracks and dets else []

    def step(self, dets: list[Detection]) -> list[Track]:
        self.steps += 1
        c = self.config
        sound = [d for d in dets if d.box[2] > d.box[0] and d.box[3] > d.box[1] and d.conf > c.low]
        pool, fresh = [t for t in self.tracks if t.sure or t.lost], [t for t in self.tracks if not t.sure and not t.lost]
        predict_all([*pool, *fresh])
        left, rest = self.take(pool, sound, c.match, False)
        for t in left:
            t.lost = True
        high = [d for d in rest if d.conf >= c.high]
        dropped, high = self.take(fresh, high, c.match, False)
        for t in fresh:
            t.sure = len(t.seen) >= c.min_length or self.steps <= c.min_length
        gone = {id(t) for t in dropped} | {id(t) for t in pool if t.lost and self.steps - t.frame > c.buffer}
        self.tracks = [t for t in self.tracks if id(t) not in gone]
        for d in sorted((d for d in high if d.conf >= c.new), key=lambda d: -d.conf):
            taken = [t.box for t in self.tracks if t.frame == self.steps]
            if not taken or (1 - iou_cost(np.array(taken), d.box[None])).max() <= c.birth_overlap:
                self.birth(d)
        self.merge()
        return [t for t in self.tracks if t.sure and not t.lost and t.frame == self.steps]


def warp_all(tracks: list[Track], warp: np.ndarray) -> None:
    """Moves states by a given 2 x 3 camera motion: places by the map, sizes and speeds by its linear part."""
    linear, shift = np.asarray(warp)[:, :2], np.asarray(warp)[:, 2]
    scale = float(np.sqrt(abs(np.linalg.det(linear))))
    for t in tracks:
        t.mean[:2] = linear @ t.mean[:2] + shift
        t.mean[4:6] = linear @ t.mean[4:6]
        grown = np.ones(8)
        t.state.scale(grown, scale)
        t.mean *= grown
        turn = np.diag(grown)
        turn[:2, :2] = turn[4:6, 4:6] = linear
        t.cov = turn @ t.cov @ turn.T
