"""Points on the sphere in nested boxes, for the tasks that meet discs with the points of a tile.

The points are halved again and again along the longest side of their box. A box beyond a disc is dropped, one wholly
inside adds its sum, and only those on the rim are opened, so a disc looks at about as many boxes as lie on its rim.
What is looked at at a time has a fixed size, however many discs and points there are.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np

#: Pairs of a disc and a box, or a disc and a point, that are looked at at a time.
AT_ONCE = 1 << 16
#: Far above the rounding of a distance: boxes so close to the rim are opened, and points decide by themselves.
SLACK = 1e-13
#: Chord within which two separations can have the same nine decimals of a degree.
TIE = 4e-11


def squared(a: np.ndarray, at_a: np.ndarray, b: np.ndarray, at_b: np.ndarray) -> np.ndarray:
    """Squared chords between rows of ``a`` and ``b``, given by coordinate, summed in the order of the expression ``chord_squared``."""
    x, y, z = (p[at_a] - q[at_b] for p, q in zip(a, b))
    x *= x
    y *= y
    z *= z
    x += y
    x += z
    return x


class PointTree:
    """At least one point (unit vectors) with whole-number weights; ``leaf`` is the most points of a last box."""

    def __init__(self, points: np.ndarray, weight: np.ndarray, leaf: float = 4.0) -> None:
        n = len(points)
        self.depth = max(0, math.ceil(math.log2(n / max(1.0, leaf))))
        self.size = -(-n // (1 << self.depth))
        # the last point again, without weight, where boxes are not full
        self.row = np.minimum(np.arange(self.size << self.depth), n - 1)
        self.points = points[self.row]
        self.weight = np.where(np.arange(len(self.row)) < n, weight[self.row], 0)
        for level in range(self.depth):
            boxes = self.points.reshape(1 << level, -1, 3)
            axis = (boxes.max(axis=1) - boxes.min(axis=1)).argmax(axis=1)
            along = np.take_along_axis(boxes, axis[:, None, None], axis=2)[:, :, 0]
            width = along.shape[1]
            order = np.argpartition(along, width // 2, axis=1) + (np.arange(1 << level) * width)[:, None]
            order = order.ravel()
            self.row, self.points, self.weight = self.row[order], self.points[order], self.weight[order]
        self.levels = []
        for level in range(self.depth + 1):
            boxes = self.points.reshape(1 << level, -1, 3)
            middle = (boxes.max(axis=1) + boxes.min(axis=1)) / 2
            radius = np.sqrt(((boxes - middle[:, None]) ** 2).sum(axis=2).max(axis=1))
            self.levels.append((np.ascontiguousarray(middle.T), radius, self.weight.reshape(1 << level, -1).sum(axis=1)))
        self.points = np.ascontiguousarray(self.points.T)

    def _descend(self, centers: np.ndarray, reach: np.ndarray, whole: bool, bound: bool = False) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
        """(disc, weight, True) for boxes wholly inside, if ``whole``, and (disc, place in ``points``, False) for the others' points.

        With ``bound`` the reach, an array that is written to, shrinks to what the nearest point can be away at most.
        Discs are ascending in each answer.
        """
        todo = [(0, np.arange(centers.shape[1]), np.zeros(centers.shape[1], np.int64))]
        while todo:
            level, disc, box = todo.pop()
            if len(disc) > AT_ONCE:
                todo += [(level, disc[i : i + AT_ONCE], box[i : i + AT_ONCE]) for i in range(0, len(disc), AT_ONCE)]
                continue
            middle, radius, weight = self.levels[level]
            away, size = np.sqrt(squared(middle, box, centers, disc)), radius[box]
            if bound:
                np.minimum.at(reach, disc, away + size + SLACK)
            met = away <= reach[disc] + size + SLACK
            if whole:
                inside = away <= reach[disc] - size - SLACK
                if inside.any():
                    yield disc[inside], weight[box[inside]], True
                met &= ~inside
            disc, box = disc[met], box[met]
            if level < self.depth:
                todo.append((level + 1, np.repeat(disc, 2), (box[:, None] * 2 + np.arange(2)).ravel()))
                continue
            step = max(1, AT_ONCE // self.size)
            for i in range(0, len(disc), step):
                place = box[i : i + step, None] * self.size + np.arange(self.size)
                yield np.repeat(disc[i : i + step], self.size), place.ravel(), False

    def count(self, centers: np.ndarray, reach: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """For each centre the weight of all points with a squared chord of at most ``limit``; ``reach`` is its root."""
        centers, total = np.ascontiguousarray(centers.T), np.zeros(len(centers), np.int64)
        for disc, other, inside in self._descend(centers, reach, whole=True):
            if not inside:
                near = squared(self.points, other, centers, disc) <= limit[disc]
                disc, other = disc[near], self.weight[other[near]]
            if len(disc):
                starts = np.flatnonzero(np.diff(disc, prepend=-1))
                total[disc[starts]] += np.add.reduceat(other, starts)
        return total

    def nearest(self, centers: np.ndarray, rings: list[float], limit: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(centre, row of a point, ring it was found in) for the nearest point and all those as near to nine decimals.

        Rings are ascending chords. A centre leaves with the first ring that holds a point; the others wait for the next.
        """
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        waiting = np.arange(len(centers))
        for ring, chord in enumerate(rings):
            best = np.full(len(waiting), np.inf)
            at = np.ascontiguousarray(centers[waiting].T)
            for disc, place, _ in self._descend(at, np.full(len(waiting), chord), whole=False, bound=True):
                away = squared(self.points, place, at, disc)
                near = (away <= limit) & (away <= chord * chord)
                np.minimum.at(best, disc[near], away[near])
            has = np.flatnonzero(np.isfinite(best))
            at, edge = np.ascontiguousarray(at[:, has]), np.sqrt(best[has]) + TIE
            for disc, place, _ in self._descend(at, edge.copy(), whole=False):
                away = squared(self.points, place, at, disc)
                near = (away <= limit) & (np.sqrt(away) <= edge[disc])
                found.append((waiting[has[disc[near]]], self.row[place[near]], np.full(int(near.sum()), ring)))
            waiting = np.delete(waiting, has)
            if not len(waiting):
                break
        if not found:
            return (np.zeros(0, np.int64),) * 3
        return tuple(np.concatenate(c) for c in zip(*found))
