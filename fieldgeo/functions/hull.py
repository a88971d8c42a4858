"""Convex hulls of arrays of points, for the Arrow-batched aggregate of operators/summary.py."""

from __future__ import annotations

import numpy as np

#: Directions whose outermost points rule out what lies inside them.
DIRECTIONS = np.array([[np.cos(a), np.sin(a)] for a in np.arange(16) * np.pi / 8])


def _outer(points: np.ndarray) -> np.ndarray:
    """points without those well inside the polygon of the outermost ones in sixteen directions."""
    corners = points[np.unique((points @ DIRECTIONS.T).argmax(axis=0))]
    middle = corners.mean(axis=0)
    corners = corners[np.argsort(np.arctan2(*(corners - middle).T[::-1]))]
    ends = np.roll(corners, -1, axis=0)
    inside = np.ones(len(points), bool)
    scale = np.ptp(points, axis=0).prod()
    for (ax, ay), (bx, by) in zip(corners, ends, strict=True):
        inside &= (bx - ax) * (points[:, 1] - ay) - (by - ay) * (points[:, 0] - ax) > 1e-9 * scale
    return points[~inside]


def hull(points: np.ndarray, on_edges: bool = False) -> np.ndarray:
    """Corners of the convex hull of (n, 2) points, counter-clockwise from the leftmost lowest, without points on its edges, or with them.

    Andrew's monotone chain: after sorting, each point goes onto a stack once and off it at most once. Of fewer than three different
    points, and of points on one line, the hull is the different ones, or the line's two ends (with on_edges all of them).
    """
    if len(points) > 64:
        points = _outer(points)
    points = points[np.lexsort(points.T[::-1])]  # by x, then y
    points = points[np.append(True, (points[1:] != points[:-1]).any(axis=1))] if len(points) else points
    if len(points) < 3:
        return points

    def half(ordered: list[list[float]]) -> list[list[float]]:
        chain: list[list[float]] = []
        for x, y in ordered:
            while len(chain) > 1:
                (ox, oy), (ax, ay) = chain[-2], chain[-1]
                turn = (ax - ox) * (y - oy) - (ay - oy) * (x - ox)
                if turn > 0 or on_edges and turn == 0:
                    break
                chain.pop()
            chain.append([x, y])
        return chain

    ordered = points.tolist()
    low = half(ordered)
    if len(low) == len(points) and on_edges and low == half(ordered[::-1])[::-1]:
        return points
    return np.array(low[:-1] + half(ordered[::-1])[:-1])
