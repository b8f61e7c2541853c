"""PNG images, 8- and 16-bit grey and 8-bit RGB, without an imaging library."""

from __future__ import annotations

import struct
import zlib

import numpy as np

SIGNATURE = b"\x89PNG\r\n\x1a\n"


def _chunk(name: bytes, body: bytes) -> bytes:
    return struct.pack(">I", len(body)) + name + body + struct.pack(">I", zlib.crc32(name + body))


def encode(image: np.ndarray) -> bytes:
    """uint8 or uint16 grey (h, w), or uint8 RGB (h, w, 3)."""
    if image.ndim == 2 and image.dtype == np.uint16:
        depth, colour, rows = 16, 0, image.astype(">u2").view(np.uint8).reshape(image.shape[0], -1)
    elif image.dtype == np.uint8 and (image.ndim == 2 or image.shape[2] == 3):
        depth, colour, rows = 8, 0 if image.ndim == 2 else 2, image.reshape(image.shape[0], -1)
    else:
        raise ValueError("only uint8 and uint16 grey and uint8 RGB images can be written")
    raw = np.concatenate([np.zeros((len(rows), 1), np.uint8), rows], axis=1).tobytes()
    head = struct.pack(">IIBBBBB", image.shape[1], image.shape[0], depth, colour, 0, 0, 0)
    return SIGNATURE + _chunk(b"IHDR", head) + _chunk(b"IDAT", zlib.compress(raw)) + _chunk(b"IEND", b"")


def header(data: bytes) -> tuple[int, int, int, int]:
    """Width, height, bit depth, colour type."""
    if data[:8] != SIGNATURE or data[12:16] != b"IHDR":
        raise ValueError("not a PNG image")
    return struct.unpack(">IIBB", data[16:26])


def decode(data: bytes) -> np.ndarray:
    width, height, depth, colour = header(data)
    if (depth, colour) not in ((8, 0), (16, 0), (8, 2)) or data[28]:
        raise ValueError("only non-interlaced 8- and 16-bit grey and 8-bit RGB images can be read")
    at, parts = 8, []
    while at + 8 <= len(data):
        size, name = struct.unpack_from(">I4s", data, at)
        if name == b"IDAT":
            parts.append(data[at + 8 : at + 8 + size])
        at += 12 + size
    try:
        raw = zlib.decompress(b"".join(parts))
    except zlib.error as e:
        raise ValueError("the image data is damaged") from e
    step = depth // 8 * (3 if colour == 2 else 1)
    line = width * step
    if len(raw) < height * (line + 1):
        raise ValueError("the image data is cut short")
    rows = np.frombuffer(raw, np.uint8, height * (line + 1)).reshape(height, line + 1)
    out = np.zeros((height, line), np.uint8)
    above = np.zeros(line, np.uint8)
    for y in range(height):
        kind, row = rows[y, 0], rows[y, 1:]
        if kind == 0:
            now = row.copy()
        elif kind == 1:
            now = row.reshape(-1, step).cumsum(0, dtype=np.uint8).reshape(-1)
        elif kind == 2:
            now = row + above
        elif kind in (3, 4):
            now = row.copy()
            values, up = now.tolist(), above.tolist()
            for i in range(line):
                left = values[i - step] if i >= step else 0
                if kind == 3:
                    guess = (left + up[i]) // 2
                else:
                    corner = up[i - step] if i >= step else 0
                    p = left + up[i] - corner
                    a, b, c = abs(p - left), abs(p - up[i]), abs(p - corner)
                    guess = left if a <= b and a <= c else up[i] if b <= c else corner
                values[i] = (values[i] + guess) & 255
            now = np.array(values, np.uint8)
        else:
            raise ValueError("unknown row filter")
        out[y] = above = now
    if depth == 16:
        return out.view(">u2").astype(np.uint16).reshape(height, width)
    return out.reshape(height, width) if colour == 0 else out.reshape(height, width, 3)
