"""Edge maps: gradients, thinning along the gradient, and hysteresis over connected weak edges."""

from __future__ import annotations

import numpy as np

from .areas import components

#: Fixed value: the tangent of 22.5 degrees in 32768ths, which parts the directions of a gradient.
TANGENT = 13573


def gradients(grey: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Horizontal and vertical Sobel gradients; border pixels are repeated outwards."""
    p = np.pad(grey.astype(np.int64), 1, mode="edge")
    down, across = p[:-2] + 2 * p[1:-1] + p[2:], p[:, :-2] + 2 * p[:, 1:-1] + p[:, 2:]
    return down[:, 2:] - down[:, :-2], across[2:] - across[:-2]


def edge_map(grey: np.ndarray, low: int = 50, high: int = 150) -> np.ndarray:
    """Thin edges over ``low`` that are connected to one over ``high``; strength is the sum of both gradients' sizes."""
    gx, gy = gradients(grey)
    strength = abs(gx) + abs(gy)
    m = np.pad(strength, 1)
    at = lambda dy, dx: m[1 + dy : m.shape[0] - 1 + dy, 1 + dx : m.shape[1] - 1 + dx]
    near, up = abs(gx) * TANGENT, abs(gy) << 15
    flat, steep = up < near, up > near + (abs(gx) << 16)
    along = np.where((gx ^ gy) < 0, (strength > at(-1, 1)) & (strength > at(1, -1)), (strength > at(-1, -1)) & (strength > at(1, 1)))
    crest = np.where(flat, (strength > at(0, -1)) & (strength >= at(0, 1)), np.where(steep, (strength > at(-1, 0)) & (strength >= at(1, 0)), along))
    weak = crest & (strength > low)
    strong = weak & (strength > high)
    if not strong.any() or (strong == weak).all():
        return strong
    labels = components(weak).image(weak.shape)
    return weak & np.isin(labels, np.unique(labels[strong]))
