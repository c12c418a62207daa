"""Scan runs, connected areas by union-find over runs, borders and simplified polygons of a mask."""

from __future__ import annotations

import numpy as np


def scan_runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(line, start, stop) of the true stretches of each line."""
    edges = np.diff(np.pad(mask, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    line, start = np.nonzero(edges == 1)
    return line, start, np.nonzero(edges == -1)[1]


class Areas:
    """Runs with the number of their connected area; areas count from 0 in the order of their first runs."""

    def __init__(self, line: np.ndarray, start: np.ndarray, stop: np.ndarray, area: np.ndarray):
        self.line, self.start, self.stop, self.area = line, start, stop, area
        self.count = int(area.max(initial=-1)) + 1
        self.pixels = np.bincount(area, weights=stop - start, minlength=self.count).astype(np.int64)

    def bounds(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Least column, least line, and greatest of both, of each area."""
        out = []
        for values, fold, first in ((self.start, np.minimum, 1 << 60), (self.line, np.minimum, 1 << 60), (self.stop - 1, np.maximum, -1), (self.line, np.maximum, -1)):
            own = np.full(self.count, first, dtype=np.int64)
            fold.at(own, self.area, values)
            out.append(own)
        return tuple(out)

    def centres(self) -> np.ndarray:
        size = self.stop - self.start
        x = np.bincount(self.area, weights=(self.start + self.stop - 1) / 2 * size, minlength=self.count)
        y = np.bincount(self.area, weights=self.line * size, minlength=self.count)
        return np.stack([x, y], axis=1) / np.maximum(self.pixels, 1)[:, None]

    def image(self, shape: tuple[int, int]) -> np.ndarray:
        """Area numbers by pixel, -1 outside."""
        out = np.full(shape, -1, dtype=np.int64)
        for line, start, stop, area in zip(self.line, self.start, self.stop, self.area, strict=True):
            out[line, start:stop] = area
        return out


def components(mask: np.ndarray, corners: bool = True) -> Areas:
    """Connected areas; with ``corners`` pixels that touch by a corner are connected."""
    line, start, stop = scan_runs(mask)
    reach = 1 if corners else 0
    parent = list(range(len(line)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    firsts = np.searchsorted(line, np.arange(mask.shape[0] + 1)).tolist()
    starts, stops = start.tolist(), stop.tolist()
    for y in range(1, mask.shape[0]):
        i, end = firsts[y - 1], firsts[y]
        for j in range(firsts[y], firsts[y + 1]):
            while i < end and stops[i] + reach <= starts[j]:
                i += 1
            k = i
            while k < end and starts[k] < stops[j] + reach:
                a, b = root(k), root(j)
                if a != b:
                    parent[max(a, b)] = min(a, b)
                k += 1
    roots = np.array([root(i) for i in range(len(parent))], dtype=np.int64)
    return Areas(line, start, stop, np.unique(roots, return_inverse=True)[1] if len(roots) else roots)


#: The eight neighbours, clockwise from the right.
_AROUND = [(0, 1), (1, 1), (1, 0), (1, -1), (0, -1), (-1, -1), (-1, 0), (-1, 1)]


def borders(mask: np.ndarray) -> list[list[tuple[int, int]]]:
    """Outer borders and borders of holes, each as its pixels (line, column) in order.

    A scan starts an outer border where a pixel not yet followed comes after the outside, and a hole's where the
    outside comes after a pixel whose right side was not followed yet.
    """
    padded = np.pad(mask.astype(np.int64), 1)
    width = padded.shape[1]
    marks = padded.ravel().tolist()  # single marks are read far faster from a list
    found = []
    for at in np.flatnonzero(padded).tolist():
        if marks[at] == 1 and marks[at - 1] == 0:
            found.append(_followed(marks, width, at, 4, len(found) + 2))
        elif marks[at] >= 1 and marks[at + 1] == 0:
            found.append(_followed(marks, width, at, 0, len(found) + 2))
    return found


def _followed(marks: list[int], width: int, start: int, outside: int, number: int) -> list[tuple[int, int]]:
    """The border through a place, whose neighbour in direction ``outside`` is not in the mask; marks it as it goes."""
    steps = [dy * width + dx for dy, dx in _AROUND]
    first = next((d % 8 for d in range(outside, outside + 8) if marks[start + steps[d % 8]]), None)
    if first is None:
        marks[start] = -number
        return [(start // width - 1, start % width - 1)]
    last = start + steps[first]
    out, here, came = [], start, first
    while True:
        right_free = False
        for k in range(1, 9):  # counter-clockwise from where the border came
            d = (came - k) % 8
            after = here + steps[d]
            if marks[after]:
                break
            right_free |= d == 0
        if right_free:
            marks[here] = -number
        elif marks[here] == 1:
            marks[here] = number
        out.append((here // width - 1, here % width - 1))
        if after == start and here == last:
            return out
        here, came = after, (d + 4) % 8


def simplified(points: list[tuple[int, int]], tolerance: float) -> np.ndarray:
    """Vertices of a closed border's polygon: points farther than ``tolerance`` from the chord of their part stay."""
    p = np.array(points, dtype=np.float64)
    if len(p) < 3:
        return np.unique(p, axis=0)
    # the chords' ends: the point farthest from the first, and the one farthest from that
    a = int(((p - p[0]) ** 2).sum(axis=1).argmax())
    b = int(((p - p[a]) ** 2).sum(axis=1).argmax())
    a, b = sorted((a, b))
    ring = np.concatenate([p[a:], p[: a + 1]])
    keep = np.zeros(len(ring), dtype=bool)
    keep[[0, b - a]] = True
    parts = [(0, b - a), (b - a, len(ring) - 1)]
    while parts:
        i, j = parts.pop()
        if j - i < 2:
            continue
        chord, own = ring[j] - ring[i], ring[i + 1 : j] - ring[i]
        length = np.hypot(*chord)
        away = abs(own[:, 0] * chord[1] - own[:, 1] * chord[0]) / length if length else np.hypot(own[:, 0], own[:, 1])
        k = int(away.argmax())
        if away[k] > tolerance:
            keep[i + 1 + k] = True
            parts += [(i, i + 1 + k), (i + 1 + k, j)]
    keep[-1] = False  # the first point again
    return ring[keep]


def length(points: list[tuple[int, int]]) -> float:
    """Length of a closed border."""
    p = np.array(points, dtype=np.float64)
    return float(np.hypot(*(p - np.roll(p, 1, axis=0)).T).sum())
