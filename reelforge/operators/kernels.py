"""Kernels that go step by step through a group: tracking, assignment, hulls, similarity fits.

They run as grouped Arrow/pandas functions; the group key (video and scene) bounds what a task holds.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _half(points: list[list[float]]) -> list[list[float]]:
    """One side of a hull over sorted points, without its last one."""
    h: list[list[float]] = []
    for q in points:
        while len(h) > 1 and (h[-1][0] - h[-2][0]) * (q[1] - h[-2][1]) - (h[-1][1] - h[-2][1]) * (q[0] - h[-2][0]) <= 0:
            h.pop()
        h.append(q)
    return h[:-1]


def convex_hull(points: np.ndarray) -> np.ndarray:
    """Monotone chain, counter-clockwise from the lowest x; fewer than three points give none."""
    p = np.unique(points, axis=0)
    if len(p) < 3:
        return p[:0]
    return np.array(_half(p.tolist()) + _half(p[::-1].tolist()))


def _below(group: np.ndarray, x: np.ndarray, y: np.ndarray, rounds: int = 8) -> np.ndarray:
    """Marks points, sorted by group and x, that may be corners of their group's lower hull. Those on or above a chord of two neighbours never are."""
    at = np.arange(len(x))
    for _ in range(rounds):
        a, b, c = at[:-2], at[1:-1], at[2:]
        out = (group[a] == group[c]) & ((x[b] - x[a]) * (y[c] - y[a]) - (y[b] - y[a]) * (x[c] - x[a]) <= 0)
        if not out.any():
            break
        at = np.delete(at, np.flatnonzero(out) + 1)
    return np.isin(np.arange(len(x)), at, assume_unique=True)


def hulls(df: DataFrame, keys: list[str], x: str, y: str, schema: str) -> DataFrame:
    """Per key the hull's size and area. Of a column of points only the ends can be corners: those are taken in the JVM, then tasks drop
    what lies between neighbours, all keys of a batch at once, and the rest is dealt by key."""
    rows = df.select(*keys, F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y")).where(F.col("_x").isNotNull() & F.col("_y").isNotNull())
    columns = rows.distinct().groupBy(*keys, "_x").agg(F.min("_y").alias("_lo"), F.max("_y").alias("_hi"), F.count("*").alias("_n"))

    def reduced(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            group = pdf.groupby(keys, dropna=False, sort=False).ngroup().to_numpy()
            order = np.lexsort((pdf["_x"].to_numpy(), group))
            pdf, group = pdf.iloc[order], group[order]
            at = pdf["_x"].to_numpy()
            n = np.zeros(len(pdf), np.int64)  # a key's first row, which stays, carries the number of its points
            n[np.flatnonzero(np.diff(group, prepend=-1))] = np.bincount(group, pdf["_n"]).astype(np.int64)
            yield pdf.assign(_n=n)[_below(group, at, pdf["_lo"].to_numpy()) | _below(group, at, -pdf["_hi"].to_numpy())]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            lists = batch.column("p")
            at, flat = lists.offsets.to_numpy() - lists.offsets[0].as_py(), lists.flatten()
            xs, los, his, ns = (flat.field(i).to_numpy() for i in range(4))
            out = []
            for i, j in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                ends = [q for x, lo, hi in zip(xs[i:j].tolist(), los[i:j].tolist(), his[i:j].tolist(), strict=True) for q in ([[x, lo]] if lo == hi else [[x, lo], [x, hi]])]
                h = _half(ends) + _half(ends[::-1]) if ns[i:j].sum() > 2 else []
                out.append((len(h), 0.5 * abs(sum(p[0] * q[1] - q[0] * p[1] for p, q in zip(h, h[1:] + h[:1], strict=True))) if h else 0.0))
            n, area = zip(*out) if out else ((), ())
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keys), pa.array(n, pa.int64()), pa.array(area, pa.float64())], [*keys, "n_hull", "area"])

    # a key's row holds what the tasks left of it
    held = columns.mapInPandas(reduced, columns.schema).groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("_x", "_lo", "_hi", "_n"))).alias("p"))
    return held.mapInArrow(run, schema)


#: Cells of an assignment below which lists are faster than arrays.
SMALL = 400


def _small(part: list[list[float]], limit: float) -> list[tuple[int, int]]:
    """The paths of assigned() over lists: the same steps in the same order."""
    inf, n, m = float("inf"), len(part), len(part[0])
    full = [[c - limit / 2 if c < limit else inf for c in row] + [inf] * n for row in part]
    for i, row in enumerate(full):
        row[m + i] = limit / 2
    u, v, row_of, every = [0.0] * n, [0.0] * (m + n), [-1] * (m + n), range(m + n)
    for i in range(n):
        slack, came, used = [inf] * (m + n), [-1] * (m + n), [False] * (m + n)
        r, at, path = i, -1, []
        while True:
            row, ur, j, step = full[r], u[r], -1, inf
            for k in every:
                if not used[k]:
                    c = row[k] - ur - v[k]
                    if c < slack[k]:
                        slack[k], came[k] = c, at
                    if slack[k] < step:
                        j, step = k, slack[k]
            u[i] += step
            for k in path:
                u[row_of[k]] += step
                v[k] -= step
            for k in every:
                if not used[k]:
                    slack[k] -= step
            if row_of[j] < 0:
                break
            used[j] = True
            path.append(j)
            r, at = row_of[j], j
        while j >= 0:
            k = came[j]
            row_of[j] = i if k < 0 else row_of[k]
            j = k
    return [(row_of[j], j) for j in range(m) if row_of[j] >= 0]


def assigned(cost: np.ndarray, limit: float) -> list[tuple[int, int]]:
    """The assignment of rows to columns of least cost, where leaving a row or a column alone costs half the limit.

    So a pair is taken only below the limit. Where every row has a column of its own that is its cheapest, that is it; else shortest
    augmenting paths, over columns and one partner more for every row that stands for being alone.
    """
    rows = np.flatnonzero((cost < limit).any(axis=1))
    best = cost[rows].argmin(axis=1)
    if len(set(best.tolist())) == len(rows):
        return list(zip(rows.tolist(), best.tolist(), strict=True))
    columns = np.flatnonzero((cost < limit).any(axis=0))
    part = cost[np.ix_(rows, columns)]
    n, m = part.shape
    if n * (n + m) <= SMALL:
        return sorted((int(rows[i]), int(columns[j])) for i, j in _small(part.tolist(), limit))
    full = np.full((n, m + n), np.inf)
    full[:, :m] = np.where(part < limit, part - limit / 2, np.inf)
    full[np.arange(n), m + np.arange(n)] = limit / 2
    u, v = [0.0] * n, np.zeros(m + n)  # prices of rows and columns
    row_of = [-1] * (m + n)
    for i in range(n):
        slack, came, used = np.full(m + n, np.inf), np.full(m + n, -1), np.zeros(m + n, bool)
        r, at, path = i, -1, []
        while True:
            reduced = full[r] - u[r] - v
            better = ~used & (reduced < slack)
            slack[better], came[better] = reduced[better], at
            j = int(np.where(used, np.inf, slack).argmin())
            step = float(slack[j])
            u[i] += step
            for k in path:
                u[row_of[k]] += step
            v[used] -= step
            slack[~used] -= step
            if row_of[j] < 0:
                break
            used[j] = True
            path.append(j)
            r, at = row_of[j], j
        while j >= 0:
            k = int(came[j])
            row_of[j] = i if k < 0 else row_of[k]
            j = k
    return sorted((int(rows[row_of[j]]), int(columns[j])) for j in range(m) if row_of[j] >= 0)


def iou_matrix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    lo, hi = np.maximum(a[:, None, :2], b[None, :, :2]), np.minimum(a[:, None, 2:], b[None, :, 2:])
    both = np.clip(hi - lo, 0, None).prod(-1)
    area = lambda v: np.clip(v[:, 2:] - v[:, :2], 0, None).prod(-1)
    union = area(a)[:, None] + area(b)[None] - both
    return np.where(union > 0, both / np.where(union > 0, union, 1), 0.0)


class _Track:
    """Middle, size and their velocities; axes share one covariance of value and velocity, as nothing ties them to each other."""

    __slots__ = ("id", "x", "v", "p", "p0", "last", "start", "seen", "velocity")

    def predict(self) -> None:
        (x, y, w, h), (dx, dy, dw, dh), (a, b, c, d) = self.x, self.v, self.p
        self.x, self.p = (x + dx, y + dy, w + dw, h + dh), ((a + c) + (b + d) + 1.0, b + d, c + d, d + 0.01)

    def update(self, z: tuple) -> None:
        a, b, c, d = self.p
        s = a + 1.0
        k, g = a / s, b / s
        miss = [p - q for p, q in zip(z, self.x)]
        self.x, self.v = tuple([q + k * e for q, e in zip(self.x, miss)]), tuple([q + g * e for q, e in zip(self.v, miss)])
        self.p = (a - k * a, b - k * b, c - g * a, d - g * b)


def _measured(box: list[float]) -> tuple[float, float, float, float]:
    w, h = box[2] - box[0], box[3] - box[1]
    return box[0] + w / 2, box[1] + h / 2, w, h


class Tracker:
    """Boxes followed over frames: constant-velocity Kalman filter, matched by overlap and by direction of motion.

    Tracks seen in the last frame are matched first, then lost ones; a found track's filter is run anew over the
    straight line between its last and its new box. Tracks unseen for more than max_lost frames end. A frame has few
    boxes, so all is done on plain numbers: calls of array functions took eight times as long.
    """

    def __init__(self, min_iou: float = 0.3, max_lost: int = 30, min_hits: int = 2, inertia: float = 0.2):
        self.min_iou, self.max_lost, self.min_hits, self.inertia = min_iou, max_lost, min_hits, inertia
        self.tracks: list[_Track] = []
        self.next = 1

    def _match(self, tracks: list[_Track], boxes: list[list[float]], measured: list[tuple], free: list[int]) -> list[tuple[_Track, int]]:
        if not tracks or not free:
            return []
        # a pair that does not overlap enough costs the limit and more, so it is never taken
        most = 1 - self.min_iou + self.inertia + 1e-9
        near, areas = [], [max(measured[j][2], 0.0) * max(measured[j][3], 0.0) for j in free]
        for t in tracks:
            x, y, w, h = t.x
            w, h = max(w, 1e-6) / 2, max(h, 1e-6) / 2
            x1, y1, x2, y2 = x - w, y - h, x + w, y + h
            area, ok = max(x2 - x1, 0.0) * max(y2 - y1, 0.0), {}
            for k, j in enumerate(free):
                b = boxes[j]
                w, h = (x2 if x2 < b[2] else b[2]) - (x1 if x1 > b[0] else b[0]), (y2 if y2 < b[3] else b[3]) - (y1 if y1 > b[1] else b[1])
                both = w * h if w > 0 and h > 0 else 0.0
                union = area + areas[k] - both
                score = both / union if union > 0 else 0.0
                if score >= self.min_iou:
                    if t.velocity is not None:
                        last, z = t.last, measured[j]
                        to, up = z[0] - last[0], z[1] - last[1]
                        n = math.sqrt(to * to + up * up)
                        score += self.inertia * (to * t.velocity[0] + up * t.velocity[1]) / (n if n > 0 else 1)
                    ok[k] = min(1 - score, most - 1e-9)
            if ok:
                near.append((t, ok))
        best = [min(ok, key=ok.get) for _, ok in near]  # the first of equal ones
        if len(set(best)) < len(best):
            cost = np.full((len(near), len(free)), most + 1)
            for i, (_, ok) in enumerate(near):
                for k, c in ok.items():
                    cost[i, k] = c
            return [(near[i][0], free[k]) for i, k in assigned(cost, most)]
        return [(t, free[k]) for (t, _), k in zip(near, best)]

    def step(self, frame: int, boxes: np.ndarray | list[list[float]]) -> list[tuple[int, int]]:
        """(number of box, track) of tracks that are old enough to be shown."""
        boxes = boxes.tolist() if isinstance(boxes, np.ndarray) else boxes
        for t in self.tracks:
            t.predict()
        measured, free, out = [_measured(b) for b in boxes], list(range(len(boxes))), []
        for group in ([t for t in self.tracks if t.seen == frame - 1], [t for t in self.tracks if t.seen < frame - 1]):
            for t, j in self._match(group, boxes, measured, free):
                free.remove(j)
                z, old, gap = measured[j], t.last, frame - t.seen
                if gap > 1:
                    t.x, t.v, t.p = old, tuple([(p - q) / gap for p, q in zip(z, old)]), t.p0
                    for k in range(1, gap):
                        t.predict()
                        t.update(tuple([q + (p - q) * k / gap for p, q in zip(z, old)]))
                    t.predict()
                to, up = z[0] - old[0], z[1] - old[1]
                n = math.sqrt(to * to + up * up)
                t.update(z)
                t.last, t.seen, t.p0 = z, frame, t.p
                if n > 0:
                    t.velocity = (to / n, up / n)
                if frame - t.start >= self.min_hits:
                    out.append((j, t.id))
        for j in free:
            t = _Track()
            t.id, t.x, t.v, t.p, t.p0, t.last, t.start, t.seen, t.velocity = self.next, measured[j], (0.0,) * 4, (10.0, 0.0, 0.0, 100.0), (10.0, 0.0, 0.0, 100.0), measured[j], frame, frame, None
            self.tracks.append(t)
            self.next += 1
        self.tracks = [t for t in self.tracks if frame - t.seen <= self.max_lost]
        return sorted(out)

    def follow(self, frames: np.ndarray, boxes: np.ndarray) -> np.ndarray:
        """The track of each box, -1 without one; rows are sorted by frame, and those without a frame have none."""
        ids, rows = np.full(len(frames), -1), boxes.tolist()
        ends = [*(np.flatnonzero(frames[1:] != frames[:-1]) + 1).tolist(), len(frames)] if len(frames) else []
        for i, j, f in zip([0, *ends], ends, frames[[0, *ends[:-1]]].tolist() if ends else []):
            if f == f:
                for k, t in self.step(int(f), rows[i:j]):
                    ids[i + k] = t
        return ids


def in_order(pdf: pd.DataFrame, frame: str, box: list[str]) -> pd.DataFrame:
    """Rows by frame, then by box."""
    return pdf.iloc[np.lexsort([pdf[c].to_numpy(float) if c != frame else pdf[c].to_numpy() for c in (*box[::-1], frame)])].reset_index(drop=True)


def track(df: DataFrame, keys: list[str], frame: str, box: list[str], make: Callable[[], Tracker] = Tracker) -> DataFrame:
    """Adds track_id (null while a track is too young) to detections; keys are video and scene."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = in_order(pdf, frame, box)
        ids = make().follow(pdf[frame].to_numpy(), pdf[box].to_numpy(float))
        pdf["track_id"] = pd.arrays.IntegerArray(ids, ids < 0)
        return pdf

    return df.groupBy(*keys).applyInPandas(run, f"{', '.join(f'{x.name} {x.dataType.simpleString()}' for x in df.schema.fields)}, track_id long")


def similarity_fit(src: np.ndarray, dst: np.ndarray) -> np.ndarray:
    """Least-squares similarity transform (2 x 3) from points to points."""
    ms, md = src.mean(0), dst.mean(0)
    s, d = src - ms, dst - md
    u, sv, vt = np.linalg.svd(d.T @ s / len(src))
    sign = np.array([1.0, np.sign(np.linalg.det(u @ vt)) or 1.0])
    r = u @ np.diag(sign) @ vt
    scale = (sv * sign).sum() / max(s.var(0).sum(), 1e-12)
    return np.column_stack([scale * r, md - scale * r @ ms])
