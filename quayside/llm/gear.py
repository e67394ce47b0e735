"""Content-defined boundaries by a rolling gear hash, over many texts at once.

The gear hash of a byte depends on the 32 bytes up to it, so equal passages get equal boundaries
wherever they stand. Chunking is normalised: up to the usual size a boundary must meet a strict
mask, beyond it a loose one, and at the greatest size one is set anyway.
"""

from __future__ import annotations

import numpy as np

_GEAR = np.random.Generator(np.random.PCG64(32)).integers(0, 2**32, 256, dtype=np.uint32)


def gear_hash(data: np.ndarray) -> np.ndarray:
    """Sum over the last 32 bytes of gear[byte] << age, by doubling the window five times."""
    h = _GEAR[data]
    for k in (1, 2, 4, 8, 16):
        h[k:] += h[:-k] << np.uint32(k)
    return h


def boundaries(
    data: np.ndarray, offsets: np.ndarray, least: int, usual: int, most: int
) -> tuple[np.ndarray, np.ndarray]:
    """Chunk starts of all rows, ascending, and each row's first chunk number (rows + 1 values).

    Every row is hashed as if it stood alone: within 32 bytes of a row's start no boundary is set
    unless ``least`` is below 32, so ``least`` must be at least 32 or rows would see each other.
    """
    if least < 32:
        raise ValueError("a chunk must be longer than the window of the gear hash")
    bits = int(usual).bit_length() - 1
    h = gear_hash(data)
    strict = np.flatnonzero(h >> np.uint32(32 - bits - 1) == 0) + 1
    loose = np.flatnonzero(h >> np.uint32(32 - max(bits - 2, 1)) == 0) + 1
    at, stop = offsets[:-1].copy(), offsets[1:]
    rows = np.flatnonzero(at < stop)
    at, stop = at[rows], stop[rows]
    found_at, found_row = [at], [rows]
    strict = np.append(strict, np.iinfo(np.int64).max)
    loose = np.append(loose, np.iinfo(np.int64).max)
    while len(at):
        a = strict[np.searchsorted(strict, at + least)]
        b = loose[np.searchsorted(loose, at + usual)]
        cut = np.where(a <= at + usual, a, np.minimum(b, at + most))
        go = cut < stop
        rows, at, stop = rows[go], cut[go], stop[go]
        found_at.append(at)
        found_row.append(rows)
    starts, row = np.concatenate(found_at), np.concatenate(found_row)
    starts.sort()
    firsts = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(offsets) - 1))])
    return starts, firsts
