"""Rasters of page regions: painting shapes, PNG files in and out, grey values."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable

import numpy as np

#: Weights of red, green and blue in a grey value, of 65536.
LUMA = (19595, 38470, 7471)
_SIGNATURE = b"\x89PNG\r\n\x1a\n"
_CHANNELS = {0: 1, 2: 3, 4: 2, 6: 4}


def paint(shapes: Iterable[tuple], width: int, height: int, left: float = 0.0, top: float = 0.0, scale: float = 1.0) -> np.ndarray:
    """RGB pixels of shapes (form, x0, y0, x1, y1, colour) over white, later ones on top, clipped to the region.

    A ``rect`` is filled with both corners inside, a ``disc`` has its centre and the radius as ``x1``, a ``line`` is
    about two pixels wide. ``left`` and ``top`` are the region's corner on the page, ``scale`` the pixels of a unit.
    """
    out = np.full((height, width, 3), 255, dtype=np.uint8)
    for form, *place, colour in shapes:
        x0, y0, x1, y1 = (round((v - o) * scale) for v, o in zip(place, (left, top, left, top), strict=True))
        radius = round(place[2] * scale) if form == "disc" else 0
        around = (x0 - abs(radius), y0 - abs(radius), x0 + abs(radius), y0 + abs(radius)) if form == "disc" else (min(x0, x1), min(y0, y1), max(x0, x1), max(y0, y1))
        # only pixels of the shape's box are looked at
        l, t, r, b = max(around[0], 0), max(around[1], 0), min(around[2], width - 1) + 1, min(around[3], height - 1) + 1
        if l >= r or t >= b:
            continue
        box = out[t:b, l:r]
        y, x = np.arange(t, b)[:, None], np.arange(l, r)
        held = slice(None)
        if form == "disc":
            held = (x - x0) ** 2 + (y - y0) ** 2 <= radius * radius
        elif form == "line":
            dx, dy = x1 - x0, y1 - y0
            held = abs((y - y0) * dx - (x - x0) * dy) <= max(abs(dx), abs(dy))
        box[held] = (colour >> 16 & 255, colour >> 8 & 255, colour & 255)
    return out


def grey(rgb: np.ndarray) -> np.ndarray:
    """8-bit grey values."""
    r, g, b = (rgb[..., k].astype(np.uint32) * w for k, w in enumerate(LUMA))
    return ((r + g + b + 0x8000) >> 16).astype(np.uint8)


def write_png(pixels: np.ndarray) -> bytes:
    """A PNG file of grey (2-d) or RGB (3-d) pixels."""
    height, width = pixels.shape[:2]
    rows = pixels.reshape(height, -1)
    lines = np.concatenate([np.zeros((height, 1), dtype=np.uint8), rows], axis=1).tobytes()

    def chunk(kind: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    head = struct.pack(">IIBBBBB", width, height, 8, 0 if pixels.ndim == 2 else 2, 0, 0, 0)
    return _SIGNATURE + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(lines, 6)) + chunk(b"IEND", b"")


def read_png(data: bytes) -> np.ndarray:
    """RGB pixels of an 8-bit PNG without interlacing; alpha is dropped."""
    if not data.startswith(_SIGNATURE):
        raise ValueError("not a PNG file")
    at, packed, header = len(_SIGNATURE), [], None
    while at + 8 <= len(data):
        (size,), kind = struct.unpack(">I", data[at : at + 4]), data[at + 4 : at + 8]
        body = data[at + 8 : at + 8 + size]
        if struct.unpack(">I", data[at + 8 + size : at + 12 + size])[0] != zlib.crc32(kind + body):
            raise ValueError("a chunk's checksum differs")
        if kind == b"IHDR":
            header = struct.unpack(">IIBBBBB", body)
        elif kind == b"IDAT":
            packed.append(body)
        at += 12 + size
    if header is None or header[2] != 8 or header[3] not in _CHANNELS or header[6]:
        raise ValueError("only 8-bit grey and colour without interlacing")
    width, height, channels = header[0], header[1], _CHANNELS[header[3]]
    lines = np.frombuffer(zlib.decompress(b"".join(packed)), dtype=np.uint8).reshape(height, 1 + width * channels)
    out = np.zeros((height, width * channels), dtype=np.uint8)
    above = np.zeros(width * channels, dtype=np.uint8)
    for row, (kind, *_) in enumerate(lines):
        out[row] = above = _unfiltered(int(kind), lines[row, 1:], above, channels)
    pixels = out.reshape(height, width, channels)
    return np.repeat(pixels[..., :1], 3, axis=2) if channels < 3 else np.ascontiguousarray(pixels[..., :3])


def _unfiltered(kind: int, line: np.ndarray, above: np.ndarray, step: int) -> np.ndarray:
    if kind == 0:
        return line
    if kind == 2:
        return line + above
    if kind == 1:
        return np.cumsum(line.reshape(-1, step), axis=0, dtype=np.uint8).reshape(-1)
    out = [0] * step + line.tolist()
    over = [0] * step + above.tolist()
    for i in range(step, len(out)):
        a, b, c = out[i - step], over[i], over[i - step]
        if kind == 3:
            guess = (a + b) // 2
        else:
            guess = min((a, b, c), key=lambda v: abs(a + b - c - v))
        out[i] = (out[i] + guess) & 255
    return np.array(out[step:], dtype=np.uint8)
