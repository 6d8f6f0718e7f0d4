"""Shift between two images by phase correlation."""

from __future__ import annotations

import numpy as np


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Structural similarity of two images over their whole area, -1 to 1."""
    if a.size < 2:
        return -1.0
    ma, mb, va, vb = a.mean(), b.mean(), a.var(), b.var()
    r = max(a.max() - a.min(), b.max() - b.min(), 1e-9)
    c1, c2 = (0.01 * r) ** 2, (0.03 * r) ** 2
    cov = ((a - ma) * (b - mb)).mean()
    return float((2 * ma * mb + c1) * (2 * cov + c2) / ((ma**2 + mb**2 + c1) * (va + vb + c2)))


def window_means(x: np.ndarray, window: int) -> np.ndarray:
    """Means over all windows that lie inside x; along an axis that is shorter than a window, over all of it. From running sums, whatever the window."""
    for axis, n in enumerate(x.shape):
        w = min(window, n)
        s = np.concatenate([np.zeros_like(x[(slice(None),) * axis + (slice(0, 1),)]), np.cumsum(x, axis=axis)], axis=axis)
        x = (np.take(s, range(w, n + 1), axis) - np.take(s, range(n + 1 - w), axis)) / w
    return x


def structure(a: np.ndarray, b: np.ndarray, window: int = 7) -> float:
    """Structural similarity of two images, -1 to 1: the mean over all windows, so that what is alike all over (a slope, a lit half) does not hide what differs in places. Windows without a voxel above 0 in either do not count."""
    if a.size < 2:
        return -1.0
    r = max(a.max(), b.max()) - min(a.min(), b.min())
    if r <= 0:
        return -1.0
    c1, c2 = (0.01 * r) ** 2, (0.03 * r) ** 2
    ma, mb = window_means(a, window), window_means(b, window)
    va, vb, cov = window_means(a * a, window) - ma * ma, window_means(b * b, window) - mb * mb, window_means(a * b, window) - ma * mb
    each = (2 * ma * mb + c1) * (2 * cov + c2) / ((ma**2 + mb**2 + c1) * (np.maximum(va, 0) + np.maximum(vb, 0) + c2))
    some = window_means(((a > 0) | (b > 0)).astype(float), window) > 1e-9
    return float(each[some].mean()) if some.any() else -1.0


def ranks(x: np.ndarray) -> np.ndarray:
    """Places in order, equal values at the mean of theirs."""
    _, which, n = np.unique(x, return_inverse=True, return_counts=True)
    return (np.cumsum(n) - (n - 1) / 2)[which.ravel()]


def rank_correlation(a: np.ndarray, b: np.ndarray) -> float:
    """Correlation of the ranks of two images' voxels, -1 to 1, where either is above 0: a quality that neither brightness nor outliers change."""
    some = (a > 0) | (b > 0)
    if some.sum() < 2:
        return -1.0
    x, y = ranks(a[some]), ranks(b[some])
    spread = x.std() * y.std()
    return float(((x - x.mean()) * (y - y.mean())).mean() / spread) if spread > 0 else -1.0


def overlap(a: np.ndarray, b: np.ndarray, d: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """The parts of a and of b moved by d that lie on each other."""
    sa = tuple(slice(max(0, k), min(n, n + k)) for k, n in zip(d, a.shape, strict=True))
    sb = tuple(slice(max(0, -k), min(n, n - k)) for k, n in zip(d, a.shape, strict=True))
    return a[sa], b[sb]


def candidates(a: np.ndarray, b: np.ndarray) -> list[tuple[int, ...]]:
    """Shifts worth trying: peaks of the plain and of the normalised correlation, each as it is and wrapped round."""
    fa, fb = np.fft.fftn(a - a.mean()), np.fft.fftn(b - b.mean())
    cross = fa * fb.conj()
    out: set[tuple[int, ...]] = {(0,) * a.ndim}
    for x in (cross, cross / np.maximum(np.abs(cross), 1e-12)):
        peak = np.unravel_index(int(np.fft.ifftn(x).real.argmax()), a.shape)
        for wrap in np.ndindex(*(2,) * a.ndim):
            out.add(tuple(int(p) - n * k for p, n, k in zip(peak, a.shape, wrap, strict=True)))
    least = min(a.shape)
    return sorted(d for d in out if all(abs(k) < least for k in d))


def refined(a: np.ndarray, b: np.ndarray, shift: tuple[int, ...], upsample: int) -> tuple[float, ...]:
    """The shift to 1 / upsample: the peak of the correlation's Fourier series at points up to one voxel around."""
    x = np.fft.fftn(a - a.mean()) * np.fft.fftn(b - b.mean()).conj()
    k = np.arange(-upsample, upsample + 1) / upsample
    for axis, (n, s) in enumerate(zip(a.shape, shift, strict=True)):
        turn = np.exp(2j * np.pi * np.outer(s + k, np.fft.fftfreq(n)))
        x = np.moveaxis(np.tensordot(turn, x, axes=(1, axis)), 0, axis)
    at = np.unravel_index(int(x.real.argmax()), x.shape)
    return tuple(float(s + k[i]) for s, i in zip(shift, at, strict=True))


def shift_between(a: np.ndarray, b: np.ndarray, upsample: int = 1) -> tuple:
    """(shift of b along each axis..., quality): the candidate whose overlap is most alike window by window, to 1 / upsample; small overlaps count for less, those below a tenth not at all. Quality is the correlation of ranks.

    Zeros in both images are taken for unstored background: only the box that
    holds all that is above 0 is compared.
    """
    some = (a > 0) | (b > 0)
    if some.any() and not some.all():
        box = tuple(slice(int(w.min()), int(w.max()) + 1) for w in np.nonzero(some))
        if all(s.stop - s.start > 1 or n == 1 for s, n in zip(box, a.shape, strict=True)):
            a, b = a[box], b[box]
    def alike(d: tuple[int, ...]) -> float:
        x, y = overlap(a, b, d)
        return structure(x, y) * (x.size / a.size) ** 0.25 if x.size >= 0.1 * a.size else -1.0

    best = max(candidates(a, b), key=lambda d: (alike(d), [-abs(k) for k in d]))
    quality = rank_correlation(*overlap(a, b, best))
    return (*(refined(a, b, best, upsample) if upsample > 1 else best), quality)
