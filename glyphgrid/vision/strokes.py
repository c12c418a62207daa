"""Line segments and circles of an edge map, by voting."""

from __future__ import annotations

import functools

import numpy as np


@functools.lru_cache(maxsize=8)
def _angles(n: int = 180) -> tuple[np.ndarray, np.ndarray]:
    theta = np.arange(n) * np.pi / n
    return np.cos(theta), np.sin(theta)


def segments(edges: np.ndarray, votes: int = 50, least: int = 30, gap: int = 10, seed: int = 7) -> list[tuple[int, int, int, int]]:
    """Segments (x0, y0, x1, y1): pixels vote one by one, in a seeded order, for lines by angle and distance.

    Once a line has ``votes``, its pixels are followed both ways over holes of up to ``gap``; they leave the map, and
    if the stretch spans ``least`` in either direction it is a segment and their votes leave the count too.
    """
    height, width = edges.shape
    cos, sin = _angles()
    ys, xs = np.nonzero(edges)
    cells = _cells(xs, ys, cos, sin, width + height)
    if not len(xs):
        return []
    # a cell that all pixels together give less than ``votes`` never counts: only the others are kept count of
    busy = np.bincount(cells.ravel()) >= votes
    if not busy.any():
        return []
    hot = busy[cells]
    flat, stops = cells[hot].tolist(), np.cumsum(hot.sum(axis=1)).tolist()
    own_cells = [flat[a:b] for a, b in zip([0, *stops], stops, strict=False)]  # of a pixel, by angle
    span = 2 * (width + height) + 1
    place = {(y, x): k for k, (y, x) in enumerate(zip(ys.tolist(), xs.tolist(), strict=True))}
    spots = list(place)
    live, voted = [True] * len(spots), [False] * len(spots)
    count = dict.fromkeys(flat, 0)
    found = []
    for k in np.random.default_rng(seed).permutation(len(spots)).tolist():
        if not live[k]:
            continue
        voted[k] = True
        most, best = votes - 1, -1
        for cell in own_cells[k]:
            n = count[cell] = count[cell] + 1
            if n > most:
                most, best = n, cell
        if best < 0:
            continue
        y, x = spots[k]
        # one step a pixel along the longer direction
        dx, dy = -float(sin[best // span]), float(cos[best // span])
        long = max(abs(dx), abs(dy))
        dx, dy = dx / long, dy / long
        ends, path = [], [k]
        for way in (1, -1):
            end, empty, step = (y, x), 0, 0
            while True:
                step += 1
                px, py = round(x + way * step * dx), round(y + way * step * dy)
                if not (0 <= px < width and 0 <= py < height):
                    break
                at = place.get((py, px))
                if at is not None and live[at]:
                    end, empty = (py, px), 0
                    path.append(at)
                else:
                    empty += 1
                    if empty > gap:
                        break
            ends.append(end)
        (y1, x1), (y0, x0) = ends
        good = abs(x1 - x0) >= least or abs(y1 - y0) >= least
        for at in path:
            if good and voted[at]:
                for cell in own_cells[at]:
                    count[cell] -= 1
                voted[at] = False
            live[at] = False
        if good:
            found.append((x0, y0, x1, y1))
    return found


def _cells(xs: np.ndarray, ys: np.ndarray, cos: np.ndarray, sin: np.ndarray, middle: int) -> np.ndarray:
    """The cell of each pixel (rows) at each angle."""
    away = np.rint(xs[:, None] * cos + ys[:, None] * sin).astype(np.int64) + middle
    return away + np.arange(len(cos)) * (2 * middle + 1)


def circles(edges: np.ndarray, gx: np.ndarray, gy: np.ndarray, least: int, most: int, votes: int = 50, apart: float = 1.0) -> list[tuple[int, int, int, int]]:
    """Circles (x, y, radius, support), best first: edge pixels vote for centres along their gradient, both ways."""
    height, width = edges.shape
    ys, xs = np.nonzero(edges)
    size = np.hypot(gx[ys, xs], gy[ys, xs])
    keep = size > 0
    ys, xs, size = ys[keep], xs[keep], size[keep]
    if not len(ys) or most < least:
        return []
    ux, uy = gx[ys, xs] / size, gy[ys, xs] / size
    radii = np.concatenate([np.arange(least, most + 1), -np.arange(least, most + 1)])
    cx = np.rint(xs[:, None] + ux[:, None] * radii).astype(np.int64)
    cy = np.rint(ys[:, None] + uy[:, None] * radii).astype(np.int64)
    inside = (cx >= 0) & (cx < width) & (cy >= 0) & (cy < height)
    heat = np.bincount((cy * width + cx)[inside], minlength=width * height).reshape(height, width)
    # votes of a centre and its neighbours count together
    soft = sum(np.pad(heat, 1)[1 + dy : height + 1 + dy, 1 + dx : width + 1 + dx] for dy in (-1, 0, 1) for dx in (-1, 0, 1))
    order = np.flatnonzero(soft >= votes)
    order = order[np.argsort(-soft.ravel()[order], kind="stable")]
    found: list[tuple[int, int, int, int]] = []
    rims: dict[tuple[int, int], tuple[int, int]] = {}  # neighbours share most of their centres
    for at in order.tolist():
        y, x = divmod(at, width)
        if any((x - a) ** 2 + (y - b) ** 2 < apart * apart for a, b, *_ in found):
            continue
        # directions are coarse, so the centre is the one nearby with most pixels at one distance
        near = [(a, b) for a in range(x - 4, x + 5) for b in range(y - 4, y + 5)]
        fresh = [c for c in near if c not in rims]
        if fresh:
            rims.update(zip(fresh, _rims(xs, ys, fresh, least, most), strict=True))
        best = max((rims[c] + c for c in near), key=lambda r: r[0])
        support, radius, x, y = best
        if support >= votes and not any((x - a) ** 2 + (y - b) ** 2 < apart * apart for a, b, *_ in found):
            found.append((x, y, radius, support))
    return found


def _rims(xs: np.ndarray, ys: np.ndarray, centres: list[tuple[int, int]], least: int, most: int) -> list[tuple[int, int]]:
    """Of each centre, most pixels at one distance (give or take one) of those allowed, and that distance."""
    at = np.array(centres)
    size = most + 2
    away = np.rint(np.hypot(xs - at[:, :1], ys - at[:, 1:])).astype(np.int64)
    away = np.where(away < size, away, size) + np.arange(len(at))[:, None] * (size + 1)
    counts = np.bincount(away.ravel(), minlength=len(at) * (size + 1)).reshape(len(at), size + 1)[:, :size]
    counts[:, : max(least - 1, 0)] = 0
    near = counts[:, :-2] + counts[:, 1:-1] + counts[:, 2:]
    radius = near.argmax(axis=1)
    return list(zip(near[np.arange(len(at)), radius].tolist(), (radius + 1).tolist(), strict=True))
