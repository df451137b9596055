"""Content-chosen anchors: places that two equal stretches of text are bound to share."""

from __future__ import annotations

import numpy as np

BASE = 0x9E3779B97F4A7C15
MIX = np.uint64(0xD6E8FEB86659FD93)
_SERIES: dict[int, np.ndarray] = {}


def _series(base: int, n: int) -> np.ndarray:
    """Powers of ``base`` modulo 2^64; short ones are kept."""
    held = _SERIES.get(base)
    if held is None or len(held) < n:
        steps = np.full(max(n, 1 << 16), base, np.uint64)
        steps[0] = 1
        held = np.cumprod(steps)
        if len(held) <= 1 << 22:
            _SERIES[base] = held
    return held[:n]


def mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * MIX
    return values ^ (values >> np.uint64(29))


def sums(values: np.ndarray, base: int = BASE) -> np.ndarray:
    """Running polynomial sums, of which :func:`stretches` takes differences."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _series(base, len(values)), out=out[1:])
    return out


def stretches(running: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = BASE) -> np.ndarray:
    """Hash of each stretch of the values, the same wherever it stands."""
    inverse = _series(pow(base, -1, 1 << 64), len(running))
    return mixed((running[ends] - running[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def windowed(running: np.ndarray, size: int, base: int = BASE) -> np.ndarray:
    """Hash of every stretch of ``size`` values."""
    n = len(running) - size
    if n <= 0:
        return np.empty(0, np.uint64)
    return mixed((running[size:] - running[:n]) * _series(pow(base, -1, 1 << 64), n))


PLACE_BITS = 24
CHUNK = 1 << (PLACE_BITS - 1)


def _chunk(hashes: np.ndarray, width: int) -> np.ndarray:
    """Of each window of ``width`` hashes, the place of the smallest, the leftmost of equal ones."""
    n = len(hashes) - width + 1
    low = np.uint64((1 << PLACE_BITS) - 1)
    keys = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
    full = np.concatenate((keys, np.full(-len(keys) % width, ~np.uint64(0)))).reshape(-1, width)
    ahead = np.minimum.accumulate(full, axis=1).ravel()
    back = np.minimum.accumulate(full[:, ::-1], axis=1)[:, ::-1].ravel()
    return (np.minimum(back[:n], ahead[width - 1 : width - 1 + n]) & low).astype(np.int64)


def minimizers(hashes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of all windows of ``width`` hashes: their places, and the first and last window of each.

    A window's anchor is its smallest hash (of the upper 40 bits), the leftmost of equal ones. It depends on the window alone,
    so equal windows have it at the same place in them, and each window belongs to one anchor. Long inputs are worked
    through in chunks that overlap by a window.
    """
    n = len(hashes) - width + 1
    if n <= 0:
        return (np.empty(0, np.int64),) * 3
    owner = np.concatenate([_chunk(hashes[k : k + CHUNK + width - 1], width) + k for k in range(0, n, CHUNK)])
    first = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
    return owner[first], first, np.append(first[1:], n) - 1
