"""Main colours of an image: k-means over saturated, mid-bright pixels."""

from __future__ import annotations

import numpy as np

#: Least saturation and bounds of brightness (of 255), least pixels, sample of a preview.
SATURATION, BRIGHTNESS, LEAST, SAMPLE = 30, (40, 240), 100, 5000
#: Side of a cell of colours.
CELL = 8


def coloured(rgb: np.ndarray) -> np.ndarray:
    """Pixels that are neither grey nor near black or white, as rows."""
    flat = rgb.reshape(-1, 3).astype(np.int64)
    high, low = flat.max(axis=1), flat.min(axis=1)
    saturation = np.rint(np.where(high > 0, (high - low) * 255 / np.maximum(high, 1), 0))
    return flat[(saturation > SATURATION) & (high > BRIGHTNESS[0]) & (high < BRIGHTNESS[1])]


def palette(rgb: np.ndarray, n: int = 5, seed: int = 42, starts: int = 10, turns: int = 50, sample: int | None = SAMPLE) -> list[tuple[str, int]]:
    """(hex colour, pixels) of the centres, most pixels first; none for under ``LEAST`` coloured pixels.

    With ``sample`` None, as in every query, all coloured pixels count; else more than ``sample`` are drawn by a seed,
    for previews. The best of ``starts`` runs from spread-out centres counts. Equal pixels are weighed, not repeated;
    as many colours as centres or fewer are their own centres.
    """
    pixels = coloured(rgb)
    if len(pixels) < LEAST:
        return []
    draw = np.random.default_rng(seed)
    if sample is not None and len(pixels) > sample:
        pixels = pixels[draw.choice(len(pixels), sample, replace=False)]
    colours, weights = np.unique(pixels @ (1 << 16, 1 << 8, 1), return_counts=True)
    del pixels
    held = _Cells(np.stack([colours >> 16, colours >> 8 & 255, colours & 255]).astype(np.float64), weights)
    best, least = None, np.inf
    for _ in range(starts if len(colours) > n else 1):
        centres, owner, cost = _clustered(held, min(n, len(colours)), draw, turns)
        if cost < least:
            best, least = (centres, owner), cost
    sizes = np.bincount(best[1], weights=weights, minlength=len(best[0])).astype(int)
    rows = [("#%02x%02x%02x" % tuple(int(v) for v in c), int(s)) for c, s in zip(best[0], sizes, strict=True) if s]
    return sorted(rows, key=lambda r: (-r[1], r[0]))


def _away(points: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """Squared distances of points (3, ..) from a centre, or each from its own."""
    return (points[0] - centre[0]) ** 2 + (points[1] - centre[1]) ** 2 + (points[2] - centre[2]) ** 2


def _nearest(points: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centre of each point, the first of equals, and squared distances from all (centres, points)."""
    far = np.stack([_away(points, c) for c in centres])
    owner, least = np.zeros(points.shape[1], dtype=np.int64), far[0]
    for k in range(1, len(far)):
        owner[far[k] < least] = k
        least = np.minimum(least, far[k])
    return owner, far


class _Cells:
    """Colours (3, ..) with their pixels. Those of a cell go to a centre at once where no other can be as near to any of them."""

    def __init__(self, points: np.ndarray, weights: np.ndarray):
        self.points, self.weights = points, weights
        key = np.zeros(len(weights), dtype=np.int64)
        for row in points:
            key = key * 256 + row.astype(np.int64) // CELL
        self.order = np.argsort(key, kind="stable")
        first = np.flatnonzero(np.diff(key[self.order], prepend=-1))
        self.counts = np.diff(first, append=len(key))
        self.middles = points[:, self.order[first]] // CELL * CELL + (CELL - 1) / 2
        self.pixels = np.add.reduceat(weights[self.order], first)
        self.sums = np.stack([np.add.reduceat((weights * row)[self.order], first) for row in points])

    def met(self, centres: np.ndarray):
        """Owners of cells, which cells are split, their colours' places and owners; pixels and sums of colours a centre."""
        owner, far = _nearest(self.middles, centres)
        # over a cell, the difference of two centres' distances is off its middle's by at most this
        reach = (CELL - 1) * abs(centres[:, None] - centres[None]).sum(axis=2) + 1e-6
        np.fill_diagonal(reach, -1)
        split = ~(far - np.take_along_axis(far, owner[None], axis=0) > reach[:, owner]).all(axis=0)
        apart = self.order[np.repeat(split, self.counts)]
        points, weights = self.points[:, apart], self.weights[apart]
        own, _ = _nearest(points, centres)
        n = len(centres)
        added = lambda cells, colours: np.bincount(owner[~split], weights=cells[~split], minlength=n) + np.bincount(own, weights=colours, minlength=n)
        sums = np.stack([added(a, b * weights) for a, b in zip(self.sums, points, strict=True)], axis=1)
        return (owner, apart, own), added(self.pixels, weights), sums

    def owners(self, owner: np.ndarray, apart: np.ndarray, own: np.ndarray) -> np.ndarray:
        """Owners of colours by what ``met`` gave."""
        out = np.empty(len(self.weights), dtype=np.int64)
        out[self.order] = np.repeat(owner, self.counts)
        out[apart] = own
        return out


def _clustered(held: _Cells, n: int, draw: np.random.Generator, turns: int):
    points, weights = held.points, held.weights
    chosen = [int(draw.choice(len(weights), p=weights / weights.sum()))]
    away = _away(points, points[:, chosen[0]])
    while len(chosen) < n:
        share = away * weights
        chosen.append(int(draw.choice(len(weights), p=share / share.sum())))
        away = np.minimum(away, _away(points, points[:, chosen[-1]]))
    centres = points[:, chosen].T
    for _ in range(turns):
        found, pixels, sums = held.met(centres)
        moved = np.where(pixels[:, None] > 0, sums / np.maximum(pixels, 1)[:, None], centres)
        if (moved == centres).all():
            break
        centres = moved
    owner = held.owners(*found)
    cost = float((_away(points, centres[owner].T) * weights).sum())
    return centres, owner, cost
