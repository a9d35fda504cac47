"""Places on a Hilbert curve, for many points at once (Skilling's transform, 2004)."""

from __future__ import annotations

import numpy as np


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place along the curve of each row of cells, whose columns are coordinates of so many bits (63 bits in all)."""
    x = cells.T.astype(np.int64).copy()
    axes = len(x)
    if axes * bits > 63:
        raise ValueError("a key has 63 bits")
    top = 1 << (bits - 1)
    q = top
    while q > 1:
        low = q - 1
        for i in range(axes):
            turned = (x[i] & q) != 0
            swap = np.where(turned, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(turned, low, swap)
            if i:
                x[i] ^= swap
        q >>= 1
    for i in range(1, axes):
        x[i] ^= x[i - 1]
    last = np.zeros_like(x[0])
    q = top
    while q > 1:
        last ^= np.where(x[axes - 1] & q, q - 1, 0)
        q >>= 1
    x ^= last
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(axes):
            key = key << 1 | (x[i] >> bit & 1)
    return key
