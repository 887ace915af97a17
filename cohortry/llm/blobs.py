"""Sorted cell numbers and counts as bytes that compress well."""

from __future__ import annotations

import numpy as np


def planes(values: np.ndarray) -> bytes:
    """Unsigned 32-bit values, byte plane after byte plane: the high planes are mostly zeros."""
    return np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def from_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").ravel()


def pack_cells(cells: np.ndarray) -> bytes:
    """Ascending cell numbers as differences."""
    return planes(np.diff(cells, prepend=0))


def unpack_cells(data: bytes) -> np.ndarray:
    return np.cumsum(from_planes(data), dtype=np.int64)
