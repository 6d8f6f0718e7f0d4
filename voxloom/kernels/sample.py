"""Values of an image between its voxels, seen through an affine map."""

from __future__ import annotations

import numpy as np

#: Places this near to a voxel or to an image's edge are on it.
NEAR = 1e-6


def places(back: np.ndarray, z: int, y: np.ndarray, x: np.ndarray) -> list[np.ndarray]:
    """Where an output plane's voxels lie in a tile; whole places are whole. Axes that a coordinate does not depend on are left narrow."""
    out = []
    for r in back[:3]:
        s = np.full((1, 1), r[0] * z + r[3])
        if r[1]:
            s = s + r[1] * y[:, None]
        if r[2]:
            s = s + r[2] * x[None]
        whole = np.rint(s)
        out.append(np.where(np.abs(s - whole) < NEAR, whole, s))
    return out


def between(a: np.ndarray, origin: np.ndarray, size: np.ndarray, at: list[np.ndarray]) -> np.ndarray:
    """Values at places of a tile of `size`, of its voxels `a` from `origin` on, which hold what the places need."""
    below, rest = [], []
    for s, o, n, m in zip(at, origin, size, a.shape, strict=True):
        i = np.floor(np.clip(s, 0, n - 1)).astype(np.int64)
        rest.append(np.clip(s, 0, n - 1) - i)
        below.append((np.clip(i - o, 0, m - 1), np.clip(np.minimum(i + 1, n - 1) - o, 0, m - 1)))
    out = np.zeros(())
    for corner in np.ndindex(2, 2, 2):
        w = np.ones(())
        for f, up in zip(rest, corner, strict=True):
            w = w * (f if up else 1 - f)
        if w.any():
            out = out + w * a[tuple(i[up] for i, up in zip(below, corner, strict=True))]
    return out


def inside(at: list[np.ndarray], size: np.ndarray) -> np.ndarray:
    """1 where places lie between the first and the last voxel of every axis, else 0."""
    out = np.ones(())
    for s, n in zip(at, size, strict=True):
        out = out * ((s >= -NEAR) & (s <= n - 1 + NEAR))
    return out
