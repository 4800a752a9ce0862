"""A small PNG writer for gray pages and thumbnails (SNK2, SNK22)."""

from __future__ import annotations

import base64
import struct
import zlib

import numpy as np


def png(image: np.ndarray) -> bytes:
    """Eight-bit gray, or RGB from BGR, as PNG."""
    kind = 0 if image.ndim == 2 else 2
    pixels = image if kind == 0 else image[:, :, ::-1]
    rows = np.ascontiguousarray(pixels, np.uint8).reshape(len(image), -1)
    raw = np.concatenate([np.zeros((len(rows), 1), np.uint8), rows], axis=1).tobytes()

    def chunk(name: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + name + data + struct.pack(">I", zlib.crc32(name + data))

    head = struct.pack(">IIBBBBB", image.shape[1], image.shape[0], 8, kind, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(raw, 6)) + chunk(b"IEND", b"")


def data_url(image: np.ndarray) -> str:
    """SNK22: a thumbnail for HTML."""
    return "data:image/png;base64," + base64.b64encode(png(image)).decode()
