"""Balanced cells of a point set, and distance bounds to them.  Small array helpers for the neighbour search.

Points are rows of doubles in which NaN marks a missing coordinate.  The distance of two points is
Euclidean over the coordinates both have, scaled up by the share of those coordinates.
"""

from __future__ import annotations

import numpy as np


def build_tree(sample: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Split coordinate and cut of every inner node of a full binary tree, halving the sample at each."""
    inner = 2**depth - 1
    dims, cuts = np.zeros(inner, dtype=np.int64), np.full(inner, np.inf)
    members = {0: sample}
    for node in range(inner):
        rows = members.pop(node)
        left = right = rows
        if len(rows):
            spread = rows.max(axis=0) - rows.min(axis=0)
            dims[node] = int(np.argmax(spread))
            column = rows[:, dims[node]]
            cuts[node] = np.median(column)
            if cuts[node] >= column.max():  # more than half sit on the largest value
                lower = column[column < column.max()]
                cuts[node] = lower.max() if len(lower) else cuts[node]
            below = column <= cuts[node]
            left, right = rows[below], rows[~below]
        members[2 * node + 1], members[2 * node + 2] = left, right
    return dims, cuts


def leaf_of(points: np.ndarray, dims: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Leaf number of every point."""
    node = np.zeros(len(points), dtype=np.int64)
    inner = len(dims)
    rows = np.arange(len(points))
    while inner and (node < inner).any():
        node = 2 * node + 1 + (points[rows, dims[node]] > cuts[node])
        if (node >= inner).all():
            break
    return node - inner


def distances(queries: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Distance matrix; NaN where two points share no coordinate."""
    width = queries.shape[1]
    total = np.zeros((len(queries), len(points)))
    shared = np.zeros((len(queries), len(points)))
    for j in range(width):
        gap = queries[:, j, None] - points[None, :, j]
        both = ~np.isnan(gap)
        total += np.where(both, gap * gap, 0.0)
        shared += both
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(shared > 0, np.sqrt(total * (width / shared)), np.nan)


def box_bounds(queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Smallest possible distance from every query to any point of every box; inf if nothing is shared.

    All points of a box miss the same coordinates, so a bound is exact for what they share.
    """
    width = queries.shape[1]
    total = np.zeros((len(queries), len(low)))
    shared = np.zeros((len(queries), len(low)))
    for j in range(width):
        q = queries[:, j, None]
        gap = np.maximum(np.maximum(low[None, :, j] - q, q - high[None, :, j]), 0.0)
        both = ~np.isnan(gap)
        total += np.where(both, gap * gap, 0.0)
        shared += both
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(shared > 0, np.sqrt(total * (width / shared)), np.inf)
