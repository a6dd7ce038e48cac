"""Following objects by where they should be next and by what they look like.

A constant-velocity Kalman filter per track foretells the center, shape and
height of its box. Detections are given to tracks by least total cost, age
after age: tracks seen last go first. A pair must lie inside the filter's gate;
its cost is the cosine distance to the nearest of the track's own embeddings,
or, without embeddings, the squared distance in units of the filter's own
uncertainty. What is left, and tracks not confirmed yet, are matched by overlap
with the foretold box.

A track remembers its last ``memory`` detections, with their embeddings. The
filter's state is that of a filter started on the oldest of them, so a track of
any length has a state of bounded size, and two trackers that have seen the same
last detections go on alike. That is what lets segments of one camera run in
parallel and still agree (see ``operators.track``).
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import accumulate

import numpy as np

from camlytics.operators.track import Settings, Tracker, _Track

# Noise as shares of the box height, and as absolute amounts for the shape; the 95 % point of
# the chi-squared distribution with four degrees of freedom.
POSITION_NOISE, VELOCITY_NOISE = 1 / 20, 1 / 160
SHAPE_NOISE = {"measured": 1e-1, "first": 1e-2, "moved": 1e-2, "first_velocity": 1e-5, "velocity": 1e-5}
GATE = 9.4877
_REJECTED = 1e-5
# What an update without a detection adds: for the value and for the velocity.
_SHARES = np.array([POSITION_NOISE, VELOCITY_NOISE])[:, None, None] * np.ones((1, 4, 1))
_SHAPES = np.square([[SHAPE_NOISE["moved"]], [SHAPE_NOISE["velocity"]]])


@dataclass(frozen=True)
class Motion(Settings):
    """``memory`` detections make a track's filter and gallery; ``gate`` bounds the squared distance from the foretold box."""

    memory: int = 30
    gate: float = GATE

    def tracker(self, state: str | None = None) -> Tracker:
        return MotionTracker.load(self, state)


@dataclass
class _Moving(_Track):
    # id, updates since the one before, x, y, shape and height of each remembered detection; their embeddings.
    trail: list = field(default_factory=list)
    gallery: list = field(default_factory=list)
    # Filters started on each remembered detection, the oldest first: value, velocity, variances of both and their covariance.
    filters: np.ndarray | None = None
    oldest: np.ndarray | None = None  # the first of them, in one row
    looks: list = field(default_factory=list)  # the embeddings with their lengths, as far as they were needed

    @property
    def state(self) -> np.ndarray | None:
        return None if self.filters is None else self.filters[:, :, 0]


def _measured(box) -> list[float]:
    """Center, width per height, and height of a box given by corners."""
    x1, y1, x2, y2 = map(float, box)
    height = max(y2 - y1, 1e-9)
    return [(x1 + x2) / 2, (y1 + y2) / 2, (x2 - x1) / height, y2 - y1]


def _scaled(heights: np.ndarray, share: float, shape: float) -> np.ndarray:
    """Variances for center, shape and height, by track."""
    out = np.empty((4, len(heights)))
    out[:] = np.square(share * heights)
    out[2] = shape * shape
    return out


def _first(z: np.ndarray) -> np.ndarray:
    """Filter state on the first detection of each track."""
    zero = np.zeros_like(z)
    value = _scaled(z[3], 2 * POSITION_NOISE, SHAPE_NOISE["first"])
    velocity = _scaled(z[3], 10 * VELOCITY_NOISE, SHAPE_NOISE["first_velocity"])
    return np.stack([z, zero, value, velocity, zero])


def _noise(heights: np.ndarray) -> np.ndarray:
    """Variances that an update adds to value and velocity, by track."""
    out = np.square(_SHARES * heights)
    out[:, 2] = _SHAPES
    return out


def _ahead(state: np.ndarray, n: np.ndarray, noise: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Value and its variance after ``n`` updates without a detection, for each track at once.

    Noise follows the height at the last detection, so that many updates are one
    formula: the velocity's noise grows with their number, the value's with its
    cube.
    """
    x, v, p, q, c = state
    value, velocity = noise
    return x + n * v, p + 2 * n * c + n * n * q + n * value + velocity * (n - 1) * n * (2 * n - 1) / 6


def _foretold(state: np.ndarray, updates: np.ndarray) -> np.ndarray:
    """The whole state after a number of updates without a detection."""
    x, v, p, q, c = state
    n = updates.astype(float)
    noise = _noise(x[3])
    velocity = noise[1]
    out = np.empty(state.shape)
    out[0], out[2] = _ahead(state, n, noise)
    out[1] = v
    out[3] = q + n * velocity
    out[4] = c + n * q + velocity * n * (n - 1) / 2
    return out


def _spread(x: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Variance of what a detection would measure, from value and variance."""
    return p + _scaled(x[3], POSITION_NOISE, SHAPE_NOISE["measured"])


def _corrected(state: np.ndarray, z: np.ndarray) -> np.ndarray:
    x, v, p, q, c = state
    spread = _spread(x, p)
    off = z - x
    out = np.empty(state.shape)
    out[0], out[1] = x + p / spread * off, v + c / spread * off
    out[2], out[3], out[4] = p - p * p / spread, q - c * c / spread, c - p * c / spread
    return out


def _settled(trails: list[list]) -> np.ndarray:
    """States of filters run over whole trails; shorter ones start later."""
    longest = max(map(len, trails))
    state = np.zeros((5, 4, len(trails)))
    for step in range(longest):
        at = [(k, t[step - longest + len(t)]) for k, t in enumerate(trails) if step >= longest - len(t)]
        which = np.array([k for k, _ in at])
        z = np.array([seen[2:] for _, seen in at]).T
        begins = np.array([step == longest - len(trails[k]) for k in which])
        some = state[:, :, which]
        moved = _corrected(_foretold(np.where(begins, 1.0, some), np.array([seen[1] for _, seen in at])), z)
        state[:, :, which] = np.where(begins, _first(z), moved)
    return state


def _look(vector) -> tuple[np.ndarray, float] | None:
    """The vector and its length; None for one that is missing or zero."""
    if vector is None:
        return None
    out = np.asarray(vector, dtype=float)
    norm = np.linalg.norm(out)
    return (out, norm) if norm > 0 else None


_PLACE = np.ones((5, 4, 1))


def _advanced(tracks: list[_Moving], memory: int) -> None:
    """Moves the tracks' filters on to their last detection, which starts one more; filters of forgotten detections end."""
    seen = np.array([t.trail[-1] for t in tracks], dtype=float)
    new = _first(seen[:, 2:].T)
    # Each track's filters and a place for the one that starts.
    held, sizes = [], []
    for t in tracks:
        size = 0
        if t.filters is not None:
            held.append(t.filters if t.filters.shape[2] < memory else t.filters[:, :, 1:])
            size = held[-1].shape[2]
        held.append(_PLACE)
        sizes.append(size + 1)
    edges = list(accumulate(sizes, initial=0))
    if edges[-1] > len(tracks):
        of = np.repeat(seen, sizes, axis=0).T
        out = _corrected(_foretold(np.concatenate(held, axis=2), of[1]), of[2:])
        out[:, :, [e - 1 for e in edges[1:]]] = new
    else:
        out = new
    oldest = out[:, :, edges[:-1]].reshape(20, -1).T.copy()
    for t, low, high, row in zip(tracks, edges, edges[1:], oldest):
        t.filters, t.oldest = out[:, :, low:high], row


def assign(costs: np.ndarray) -> list[tuple[int, int]]:
    """Pairs (row, column) of least total cost that use up all rows or all columns.

    Rows are added one by one; each takes the cheapest path of exchanges with
    the rows before it, found from reduced costs.
    """
    rows, columns = costs.shape
    if rows > columns:
        return sorted((r, c) for c, r in assign(costs.T))
    if rows * columns <= _FEW:
        return _assign_few(costs.tolist(), columns)
    row_price, column_price = np.zeros(rows + 1), np.zeros(columns + 1)
    owner = np.zeros(columns + 1, dtype=int)
    for row in range(1, rows + 1):
        owner[0], at = row, 0
        least = np.full(columns + 1, np.inf)
        came = np.zeros(columns + 1, dtype=int)
        done = np.zeros(columns + 1, dtype=bool)
        while owner[at]:
            done[at] = True
            reduced = costs[owner[at] - 1] - row_price[owner[at]] - column_price[1:]
            closer = ~done[1:] & (reduced < least[1:])
            least[1:][closer] = reduced[closer]
            came[1:][closer] = at
            to = 1 + int(np.argmin(np.where(done[1:], np.inf, least[1:])))
            by = least[to]
            row_price[owner[done]] += by
            column_price[done] -= by
            least[~done] -= by
            at = to
        while at:
            owner[at], at = owner[came[at]], came[at]
    return sorted((int(owner[c]) - 1, c - 1) for c in range(1, columns + 1) if owner[c])


#: Below this many costs, lists are quicker than arrays.
_FEW = 256


def _assign_few(costs: list[list[float]], columns: int) -> list[tuple[int, int]]:
    """``assign`` for at most as many rows as columns, number by number."""
    row_price, column_price = [0.0] * (len(costs) + 1), [0.0] * (columns + 1)
    owner = [0] * (columns + 1)
    for row in range(1, len(costs) + 1):
        owner[0], at = row, 0
        least, came = [np.inf] * (columns + 1), [0] * (columns + 1)
        done, left = [], list(range(1, columns + 1))
        while owner[at]:
            done.append(at)
            mine, price = costs[owner[at] - 1], row_price[owner[at]]
            if at:
                left.remove(at)
            to = left[0]
            for c in left:
                reduced = mine[c - 1] - price - column_price[c]
                if reduced < least[c]:
                    least[c], came[c] = reduced, at
                if least[c] < least[to]:
                    to = c
            by = least[to]
            for c in done:
                row_price[owner[c]] += by
                column_price[c] -= by
            for c in left:
                least[c] -= by
            at = to
        while at:
            owner[at], at = owner[came[at]], came[at]
    return sorted((owner[c] - 1, c - 1) for c in range(1, columns + 1) if owner[c])


def _near(costs: np.ndarray, most: float) -> list[tuple[int, int, float]]:
    """Row, column and cost of what costs at most ``most``, row by row."""
    r, c = np.nonzero(costs <= most)
    return list(zip(r.tolist(), c.tolist(), costs[r, c].tolist()))


def _chosen(near: list[tuple[int, int, float]], rows: list[int], columns: list[int], most: float) -> list[tuple[int, int]]:
    """The assignment's pairs among those that are ``near``, given row by row; others all count as a little more than ``most``."""
    by_row, by_column = sorted({r for r, _, _ in near}), sorted({c for _, c, _ in near})
    if len(by_row) == len(by_column) == len(near):
        # No two compete.
        return [(r, c) for r, c, _ in near]
    if len({cost for _, _, cost in near}) == len(near):
        # Rows and columns without a pair to take change nothing.
        rows, columns = by_row, by_column
    # With equal costs, which of equal totals is found depends on all rows and columns.
    if len(rows) == 1 or len(columns) == 1:
        return [min(near, key=lambda pair: pair[2])[:2]]
    row_at, column_at = {r: k for k, r in enumerate(rows)}, {c: k for k, c in enumerate(columns)}
    dear = np.full((len(rows), len(columns)), most + _REJECTED)
    pairs = set()
    for r, c, cost in near:
        dear[row_at[r], column_at[c]] = cost
        pairs.add((r, c))
    found = [(rows[r], columns[c]) for r, c in assign(dear)]
    return [pair for pair in found if pair in pairs]


def _matched(costs: np.ndarray, most: float) -> list[tuple[int, int]]:
    """The assignment's pairs that cost at most ``most``; dearer ones all count as a little more than that."""
    return _chosen(_near(costs, most), list(range(costs.shape[0])), list(range(costs.shape[1])), most)


class MotionTracker(Tracker):
    """``Tracker`` with foretold boxes, galleries and assignment; see the module."""

    kind = _Moving

    def _pairs(self, boxes: np.ndarray, embeddings):
        free = [at for at, t in enumerate(self.tracks) if t.missed > 0]
        if not free or not len(boxes):
            return
        z = np.array([_measured(b) for b in boxes.tolist()]).T
        tracks = [self.tracks[t] for t in free]
        state = np.concatenate([t.oldest for t in tracks]).reshape(len(tracks), 5, 4).transpose(1, 2, 0)
        state = np.ascontiguousarray(state)
        x, p = _ahead(state, np.array([float(t.missed) for t in tracks]), _noise(state[0][3]))
        ages = [t.missed if self._confirmed(t) else 0 for t in tracks]
        costs = (np.square(z[:, None, :] - x[:, :, None]) / _spread(x, p)[:, :, None]).sum(axis=0)
        most = self.settings.gate
        if embeddings is not None:
            near = (costs <= most) & (np.array(ages) > 0)[:, None]
            most = self.settings.max_cosine_distance
            costs = self._unlike(tracks, embeddings, near)
        open_ = set(range(len(boxes)))
        matched = set()

        def taken(near: list, rows: list[int], limit: float):
            for r, c in _chosen(near, rows, sorted(open_), limit):
                open_.discard(c)
                matched.add(r)
                yield free[r], c

        hopeful: dict[int, list] = {}
        for pair in _near(costs, most):
            if ages[pair[0]] > 0:
                hopeful.setdefault(ages[pair[0]], []).append(pair)
        for age in sorted(hopeful):
            some = [pair for pair in hopeful[age] if pair[1] in open_]
            if some:
                yield from taken(some, [r for r, a in enumerate(ages) if a == age], most)
        rest = [r for r, a in enumerate(ages) if a <= 1 and r not in matched]
        if rest and open_:
            columns = sorted(open_)
            limit = 1 - self.settings.min_iou
            some = _near(1 - self._overlap(x[:, rest], boxes[columns]), limit)
            if some:
                yield from taken([(rest[r], columns[c], cost) for r, c, cost in some], rest, limit)

    @staticmethod
    def _overlap(x: np.ndarray, boxes: np.ndarray) -> np.ndarray:
        """Overlap of foretold boxes with detections."""
        half = x[2:] / 2
        half[0] = x[2] * x[3] / 2
        low, high = (x[:2] - half)[:, :, None], (x[:2] + half)[:, :, None]
        b_low, b_high = boxes[:, :2].T[:, None, :], boxes[:, 2:].T[:, None, :]
        shared = np.maximum(np.minimum(high, b_high) - np.maximum(low, b_low), 0)
        shared = shared[0] * shared[1]
        size, b_size = high - low, b_high - b_low
        union = size[0] * size[1] + b_size[0] * b_size[1] - shared
        return np.divide(shared, union, out=np.zeros_like(shared), where=union > 0)

    @staticmethod
    def _unlike(tracks: list[_Moving], embeddings, near: np.ndarray) -> np.ndarray:
        """Cosine distance of each detection to the nearest embedding of each track, of the pairs marked as ``near``; infinite for others.

        One without an embedding, or with a zero one, may be anything: distance 0.
        Products are formed pair by pair, so that equal embeddings are equally far wherever they stand.
        """
        out = np.full(near.shape, np.inf)
        here = [_look(e) if wanted else None for e, wanted in zip(embeddings, near.any(axis=0))]
        for t in np.flatnonzero(near.any(axis=1)):
            track = tracks[t]
            track.looks += [_look(e) for e in track.gallery[len(track.looks):]]
            out[t, near[t]] = 0.0
            known = [d for d in np.flatnonzero(near[t]).tolist() if here[d] is not None]
            if known and None not in track.looks:
                seen, own = np.stack([v for v, _ in track.looks]), np.stack([here[d][0] for d in known])
                like = np.vecdot(seen[:, None, :], own[None]) / np.array([n for _, n in track.looks])[:, None]
                out[t, known] = 1 - (like / np.array([here[d][1] for d in known])).max(axis=0)
        return out

    def _observe(self, track: _Moving, name: int, box, embedding) -> None:
        super()._observe(track, name, box, None)
        memory = self.settings.memory
        track.trail.append([name, track.gap, *_measured(box)])
        track.gallery.append(embedding)
        if len(track.trail) > memory:
            del track.trail[0]
        if len(track.gallery) > memory:
            del track.gallery[0], track.looks[:1]

    def _observed(self, tracks: list[_Moving]) -> None:
        """Filters of the tracks that were just seen, all at once."""
        if tracks:
            _advanced(tracks, self.settings.memory)

    def signature(self) -> str:
        self._close()
        last = self.last_frame if self.settings.advance_on_empty else None
        # The updates before the oldest remembered detection are forgotten.
        rows = [[t.hits, t.missed, t.trail[0][0], [seen[:2] for seen in t.trail[1:]]] for t in self.tracks]
        return json.dumps([last, rows])

    def _saved(self, track: _Moving) -> list:
        gallery = [None if e is None else [float(v) for v in e] for e in track.gallery]
        return [*super()._saved(track), track.trail, gallery]

    @classmethod
    def load(cls, settings: Settings, state: str | None) -> Tracker:
        tracker = super().load(settings, state)
        # Only the last ones are looked at again: a trail is remembered from its oldest detection on.
        trails = [t.trail for t in tracker.tracks]
        for step in range(max(map(len, trails), default=0)):
            some = [t for t, trail in zip(tracker.tracks, trails) if step < len(trail)]
            for t, trail in zip(tracker.tracks, trails):
                t.trail = trail[: step + 1]
            _advanced(some, settings.memory)
        for t, trail in zip(tracker.tracks, trails):
            t.trail = trail
        return tracker
