"""Flatfield and darkfield from a stack of planes by a low-rank and sparse split.

Planes are modelled as b_k * flat + dark + residual: flat is smooth (its cosine
coefficients are shrunk), residuals are sparse (objects), b_k >= 0. The split
is found by an augmented Lagrangian with a growing penalty and repeated with
weights that count down pixels with large residuals, until the flatfield moves
no more.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from voxloom.kernels.transforms import dct, eroded, otsu, resized


@dataclass(frozen=True)
class BasicParams:
    smoothness: float = 1.0
    sparsity: float = 0.01
    dark: bool = False
    working_size: tuple[int, int] | int | None = 128
    most_rounds: int = 10
    most_steps: int = 200
    tolerance: float = 1e-3
    moved: float = 1e-2
    grow: float = 1.5
    segment: bool = False
    margin: int = 3
    approximate: bool = False


def shrunk(x: np.ndarray, t: np.ndarray | float) -> np.ndarray:
    return np.sign(x) * np.maximum(np.abs(x) - t, 0)


def _split(d: np.ndarray, w: np.ndarray, p: BasicParams, smooth: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(flat, dark, b, residual) of planes d with weights w."""
    n = len(d)
    dark, y = np.zeros(d.shape[1:]), np.zeros_like(d)
    norm = np.linalg.norm(d.reshape(n, -1), 2) or 1.0
    mu, top, scale = 12.5 / norm, 12.5 / norm * 1e7, np.linalg.norm(d) or 1.0
    # medians start the split near the background, so that objects begin in the residual
    b = np.median(d, axis=(1, 2))
    b = np.where(b > 0, b, d.mean(axis=(1, 2)))
    flat = np.median(d / np.where(b > 0, b, 1)[:, None, None], axis=0)
    if not flat.any():  # mostly zeros
        flat = d.mean(axis=0)
    flat /= flat.mean() or 1.0
    r = shrunk(d - b[:, None, None] * flat, w * p.sparsity / mu)
    for _ in range(p.most_steps):
        target = d - r - dark + y / mu
        bb = float((b**2).sum()) or 1.0
        flat = dct(shrunk(dct((b[:, None, None] * target).sum(0) / bb), smooth / (mu * bb)), inverse=True)
        r = shrunk(d - b[:, None, None] * flat - dark + y / mu, w * p.sparsity / mu)
        left = d - r + y / mu
        b = np.maximum(((left - dark) * flat).sum((1, 2)) / max((flat**2).sum(), 1e-12), 0)
        m = flat.mean()
        if m > 0:
            flat, b = flat / m, b * m
        if p.dark:
            dark = np.maximum((left - b[:, None, None] * flat).mean(0), 0)
            dark = np.minimum(dark, d.min(axis=0).clip(min=0))
        gap = d - b[:, None, None] * flat - dark - r
        y += mu * gap
        mu = min(mu * p.grow, top)
        if np.linalg.norm(gap) < p.tolerance * scale:
            break
    return flat, dark, b, r


def _approximate(d: np.ndarray, w: np.ndarray, p: BasicParams, smooth: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Like `_split`, but planes are brought to one brightness and the flatfield is their shrunk median: no inner loop."""
    dark = np.zeros(d.shape[1:])
    b = np.median(d, axis=(1, 2))
    live = b > 0
    flat = np.median(d[live] / b[live, None, None], axis=0) if live.any() else np.ones(d.shape[1:])
    c = dct(flat)
    keep = c[0, 0]
    c = shrunk(c, smooth / max(float((b**2).sum()), 1e-12) * p.sparsity)
    c[0, 0] = keep
    flat = dct(c, inverse=True)
    flat = flat / (flat.mean() or 1.0)
    b = brightness(d, flat, dark, w)
    if p.dark:
        dark = np.minimum(np.maximum(np.median(d - b[:, None, None] * flat, axis=0), 0), d.min(axis=0).clip(min=0))
        b = brightness(d, flat, dark, w)
    return flat, dark, b, d - b[:, None, None] * flat - dark


def brightness(planes: np.ndarray, flat: np.ndarray, dark: np.ndarray | float = 0.0, weights: np.ndarray | None = None, rounds: int = 3) -> np.ndarray:
    """The brightness alone of planes whose flatfield and darkfield are known: weighted least squares, pixels with large residuals counted down, not below 0."""
    d, w = planes - dark, np.ones_like(planes) if weights is None else weights
    for _ in range(rounds):
        b = np.maximum((w * d * flat).sum((1, 2)) / np.maximum((w * flat**2).sum((1, 2)), 1e-12), 0)
        r = np.abs(d - b[:, None, None] * flat)
        w = 1 / (r / (np.median(r) + 1e-9) + 1) * (1 if weights is None else weights)
    return b


def fit_basic(planes: np.ndarray, params: BasicParams | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(flatfield of mean 1, darkfield, brightness of each plane) from planes (n, y, x), at the planes' size."""
    p = params or BasicParams()
    shape = planes.shape[1:]
    work = p.working_size
    size = shape if work is None else tuple(min(s, k) for s, k in zip(shape, (work, work) if isinstance(work, int) else work, strict=True))
    d = np.stack([resized(x, size) for x in planes]) if size != shape else planes.astype(float)
    scale = d.mean() or 1.0
    d = d / scale
    w = np.ones_like(d)
    if p.segment:
        w *= np.stack([eroded(x < otsu(x), p.margin) for x in d])
    smooth = p.smoothness * 0.05 * float(np.abs(dct(d.mean(0))).sum()) / max(d.shape[1:])
    base, last, flat, dark, b = w.copy(), None, None, None, None
    step = _approximate if p.approximate else _split
    for _ in range(p.most_rounds):
        flat, dark, b, r = step(d, w, p, smooth)
        w = base / (np.abs(r) / (np.abs(d - r).mean() + 1e-6) + 0.1)
        w *= w.size / max(w.sum(), 1e-9)
        if last is not None and np.abs(flat - last).sum() / max(np.abs(last).sum(), 1e-6) < p.moved:
            break
        last = flat
    flat = resized(flat, shape, 3)
    flat = flat / flat.mean() if flat.mean() > 0 else np.ones(shape)
    return flat, resized(dark, shape) * scale, b * scale
