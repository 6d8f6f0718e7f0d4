"""Cosine transforms, resizing and smoothing of small arrays."""

from __future__ import annotations

import numpy as np


def cosine_matrix(n: int) -> np.ndarray:
    """Orthonormal DCT-II matrix: rows are frequencies."""
    k, i = np.mgrid[:n, :n]
    m = np.sqrt(2 / n) * np.cos(np.pi * (2 * i + 1) * k / (2 * n))
    m[0] /= np.sqrt(2)
    return m


def dct(a: np.ndarray, inverse: bool = False) -> np.ndarray:
    """Orthonormal cosine transform along all axes."""
    for axis, n in enumerate(a.shape):
        m = cosine_matrix(n)
        a = np.moveaxis(np.tensordot(m.T if inverse else m, a, (1, axis)), 0, axis)
    return a


def _spline(t: np.ndarray) -> np.ndarray:
    """Weights of the four neighbours' spline coefficients at fraction t."""
    return np.stack([(1 - t) ** 3, (3 * t - 6) * t * t + 4, ((-3 * t + 3) * t + 3) * t + 1, t**3]) / 6


def spline_coefficients(a: np.ndarray, axis: int) -> np.ndarray:
    """Coefficients of the cubic spline through a along an axis, mirrored past its ends."""
    n = a.shape[axis]
    if n == 1:
        return a
    m = np.diag(np.full(n, 4.0)) + np.diag(np.ones(n - 1), 1) + np.diag(np.ones(n - 1), -1)
    m[0, 1] = m[-1, -2] = 2.0
    return np.moveaxis(np.linalg.solve(m / 6, np.moveaxis(a, axis, 0).reshape(n, -1)).reshape(n, *np.delete(a.shape, axis)), 0, axis)


def resized(a: np.ndarray, shape: tuple[int, ...], order: int = 1) -> np.ndarray:
    """a at another size, corners on corners: linear (1) or cubic spline (3) interpolation."""
    out = np.asarray(a, float)
    for axis, n in enumerate(shape):
        m = out.shape[axis]
        at = np.linspace(0, m - 1, n) if n > 1 else np.zeros(1)
        i = np.minimum(np.floor(at).astype(int), max(m - 2, 0))
        t = at - i
        side = [-1 if k == axis else 1 for k in range(out.ndim)]
        if order == 1 or m == 1:
            take = lambda k: np.take(out, np.clip(i + k, 0, m - 1), axis)  # noqa: E731, B023
            out = take(0) * (1 - t).reshape(side) + take(1) * t.reshape(side)
        else:
            c, w = spline_coefficients(out, axis), _spline(t)
            mirrored = lambda k: m - 1 - np.abs(m - 1 - np.abs(i + k))  # noqa: E731, B023
            out = sum(np.take(c, mirrored(k - 1), axis) * w[k].reshape(side) for k in range(4))
    return out


def resampled_profile(flat: np.ndarray, shape: tuple[int, int], order: int = 3) -> np.ndarray:
    """A profile at another size, not below 0."""
    return np.maximum(resized(flat, shape, order), 0)


def gaussian_2d(a: np.ndarray, sigma: float = 1.0, radius: int = 4) -> np.ndarray:
    """a smoothed along both axes; past an edge it is mirrored, the edge counting twice."""
    k = np.arange(-radius, radius + 1)
    w = np.exp(-0.5 * (k / sigma) ** 2)
    w /= w.sum()
    for axis in (0, 1):
        p = np.pad(a, [(radius, radius) if axis == d else (0, 0) for d in (0, 1)], mode="symmetric")
        a = sum(x * np.take(p, range(i, i + a.shape[axis]), axis) for i, x in enumerate(w))
    return a


def otsu(values: np.ndarray, bins: int = 256) -> float:
    """Threshold with the greatest variance between classes."""
    h, e = np.histogram(values, bins)
    mid = (e[1:] + e[:-1]) / 2
    n0, s0 = np.cumsum(h), np.cumsum(h * mid)
    n1, s1 = n0[-1] - n0, s0[-1] - s0
    with np.errstate(all="ignore"):
        b = np.where((n0 > 0) & (n1 > 0), n0 * n1 * (s0 / n0 - s1 / n1) ** 2, -1)
    return float(mid[b.argmax()])


def eroded(mask: np.ndarray, radius: int) -> np.ndarray:
    """Mask without what lies within a ball of the radius of its outside."""
    out = mask.copy()
    pad = np.pad(mask, radius, constant_values=True)
    for d in np.ndindex(*(2 * radius + 1,) * mask.ndim):
        if sum((k - radius) ** 2 for k in d) <= radius**2:
            out &= pad[tuple(slice(k, k + n) for k, n in zip(d, mask.shape, strict=True))]
    return out
