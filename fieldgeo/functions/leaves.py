"""Leaves of a set of points, by quantiles, and the search among their boxes."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Boxes:
    """Boxes and row counts of leaves, grouped into strips: what a search needs to know of the points."""

    def __init__(self, leaf: np.ndarray, strip: np.ndarray, box: np.ndarray, count: np.ndarray):
        """Of each leaf: its number, its strip, (xmin, ymin, xmax, ymax), and how many points it holds."""
        self.n_leaves = len(leaf)
        names, place = np.unique(strip, return_inverse=True)
        across = int(np.bincount(place).max()) if len(names) else 0
        self.leaf = np.full((len(names), across), -1)
        self.count = np.zeros((len(names), across), np.int64)
        self.box = np.full((len(names), across, 4), np.nan)
        column = np.zeros(len(names), int)
        for i, s in enumerate(place.tolist()):
            c = column[s]
            self.leaf[s, c], self.count[s, c], self.box[s, c] = leaf[i], count[i], box[i]
            column[s] += 1
        if len(names):
            self.strip_box = np.concatenate([np.nanmin(self.box[:, :, :2], axis=1), np.nanmax(self.box[:, :, 2:], axis=1)], axis=1)
            self.strip_count = self.count.sum(axis=1)

    @staticmethod
    def _reach(box: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Squared distances from points to a box's nearest and farthest place; infinite where there is no box."""
        with np.errstate(invalid="ignore"):
            near = np.maximum(np.maximum(box[..., 0] - x, x - box[..., 2]), 0) ** 2 + np.maximum(np.maximum(box[..., 1] - y, y - box[..., 3]), 0) ** 2
            far = np.maximum(np.abs(x - box[..., 0]), np.abs(x - box[..., 2])) ** 2 + np.maximum(np.abs(y - box[..., 1]), np.abs(y - box[..., 3])) ** 2
        return np.where(np.isnan(near), np.inf, near), np.where(np.isnan(far), np.inf, far)

    @staticmethod
    def _bound(far: np.ndarray, count: np.ndarray, k: int) -> np.ndarray:
        """A squared distance within which each point has k rows: that of the farthest place of its nearest boxes that hold so many."""
        if k == 1:
            return far.min(axis=1)
        order = np.argsort(far, axis=1)
        enough = np.cumsum(np.take_along_axis(np.broadcast_to(count, far.shape), order, 1), axis=1) >= k
        at = enough.argmax(axis=1)
        return np.where(enough.any(axis=1), np.take_along_axis(far, np.take_along_axis(order, at[:, None], 1), 1)[:, 0], np.inf)

    def near(self, x: np.ndarray, y: np.ndarray, k: int, max_dist: float | None) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) of every leaf that may hold one of the k nearest rows of each point."""
        if not self.n_leaves or not len(x):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        near, far = self._reach(self.strip_box[None], x[:, None], y[:, None])
        bound = self._bound(far, self.strip_count[None], k)
        if max_dist is not None:
            bound = np.minimum(bound, max_dist**2)
        own = np.argmin(near + far * 1e-9, axis=1)  # the leaves of one strip give a closer bound
        _, far = self._reach(self.box[own], x[:, None], y[:, None])
        bound = np.minimum(bound, self._bound(far, self.count[own], k)) * (1 + 1e-12)
        rows, strips = np.nonzero(near <= bound[:, None])
        near, _ = self._reach(self.box[strips], x[rows][:, None], y[rows][:, None])
        at, column = np.nonzero((near <= bound[rows][:, None]) & (self.leaf[strips] >= 0))
        return rows[at], self.leaf[strips[at], column]


@dataclass
class Leaves:
    boxes: Boxes
    number: Callable[[Column, Column], Column]  # a point's leaf


def _place(value: Column, bounds: Column) -> Column:
    """How many of the bounds lie below value."""
    return F.size(F.filter(bounds, lambda b: b < value))


def build(points: DataFrame, x: str, y: str, rows: int, strips: int) -> Leaves:
    """Leaves of about `rows` points: strips by quantiles of x, each cut by quantiles of its y; at most strips * strips.

    Quantiles may be approximate, as boxes and counts are then taken of the leaves as they are. The driver gets strips and
    bounds alone. Points at one place are in one leaf however many they are.
    """
    shares = [i / strips for i in range(1, strips)]
    n, xs = points.agg(F.count("*"), F.percentile_approx(F.col(x).cast("double"), shares, 10_000)).first()
    across = min(strips, max(1, round((n / rows) ** 0.5)))
    x_bounds = sorted({xs[round(i * strips / across) - 1] for i in range(1, across)}) if n else []
    cuts = F.lit(np.array(x_bounds or [np.inf]))  # one literal, not one for each bound
    strip = _place(F.col(x).cast("double"), cuts)
    table = np.full((len(x_bounds) + 1, max(1, across - 1)), np.inf)
    if across > 1 and n:
        parts = [i / across for i in range(1, across)]
        for s, bounds in points.groupBy(strip).agg(F.percentile_approx(F.col(y).cast("double"), parts, 10_000)).collect():
            table[s, : len(set(bounds))] = sorted(set(bounds))
    width, flat = table.shape[1], F.lit(table.ravel())

    def number(px: Column, py: Column) -> Column:
        s = _place(px.cast("double"), cuts)
        return s * (strips + 1) + _place(py.cast("double"), F.slice(flat, s * width + 1, width))

    stats = points.groupBy(number(F.col(x), F.col(y)).alias("leaf")).agg(*[f(F.col(c).cast("double")) for f in (F.min, F.max) for c in (x, y)], F.count("*")).collect()
    data = np.array([[r[0], r[0] // (strips + 1), *r[1:5], r[5]] for r in stats], float).reshape(-1, 7)
    return Leaves(Boxes(data[:, 0].astype(int), data[:, 1].astype(int), data[:, 2:6], data[:, 6].astype(np.int64)), number)
