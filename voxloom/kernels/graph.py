"""Places and maps of tiles from measurements between neighbours: sparse least squares that throws out what does not fit.

Edges are pairs of neighbouring tiles, a few per tile; all arrays here are as
long as the edges or the tiles.
"""

from __future__ import annotations

from collections import deque

import numpy as np

KINDS = ("translation", "rigid", "similarity", "affine")


def components(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest member of each node's connected group."""
    top = np.arange(n)
    while True:
        low = np.minimum(top[i], top[j])
        new = top.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == top).all():
            return top
        top = new


def solved(n: int, i: np.ndarray, j: np.ndarray, d: np.ndarray, w: np.ndarray, start: np.ndarray | None = None, tolerance: float = 1e-10) -> np.ndarray:
    """x (n, axes) of the weighted least squares of x[j] - x[i] = d, by conjugate gradients over the edges; the smallest node of each connected group is at 0."""
    group = components(n, i, j)
    x = spanned(n, i, j, d, w) if start is None else start.copy()
    degree = np.maximum(np.bincount(i, w, n) + np.bincount(j, w, n), 1e-300)[:, None]

    def spread(e: np.ndarray) -> np.ndarray:
        out = np.empty((n, e.shape[1]))
        for k in range(e.shape[1]):
            out[:, k] = np.bincount(j, e[:, k], n) - np.bincount(i, e[:, k], n)
        return out

    w_ = w[:, None]
    r = spread(w_ * (d - (x[j] - x[i])))
    p = z = r / degree
    rz, first = (r * z).sum(axis=0), None
    for _ in range(20 * int(n**0.5) + 100):
        size = np.abs(r).max(initial=0.0)
        first = first or max(size, np.abs(w_ * d).max(initial=0.0), 1e-300)
        if size <= tolerance * first:
            break
        q = spread(w_ * (p[j] - p[i]))
        step = rz / np.maximum((p * q).sum(axis=0), 1e-300)
        x, r = x + step * p, r - step * q
        z = r / degree
        new = (r * z).sum(axis=0)
        p, rz = z + new / np.maximum(rz, 1e-300) * p, new
    return x - x[group]


def neighbours(n: int, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, other, edge): the edges of node k are at starts[k] : starts[k + 1]."""
    ends, edge = np.concatenate([i, j]), np.tile(np.arange(len(i)), 2)
    by = np.argsort(ends, kind="stable")
    return np.concatenate([[0], np.cumsum(np.bincount(ends, minlength=n))]), np.concatenate([j, i])[by], edge[by]


def walk(n: int, i: np.ndarray, j: np.ndarray) -> list[tuple[int, int, int]]:
    """(node, the node it was reached from, by which edge), breadth-first from the smallest node of each connected group, which has -1 for both."""
    starts, other, edge = neighbours(n, i, j)
    seen, out = np.zeros(n, bool), []
    for root in range(n):
        if seen[root]:
            continue
        seen[root] = True
        todo = deque([(root, -1, -1)])
        while todo:
            k, *by = todo.popleft()
            out.append((k, *by))
            for a in range(starts[k], starts[k + 1]):
                if not seen[other[a]]:
                    seen[other[a]] = True
                    todo.append((int(other[a]), k, int(edge[a])))
    return out


def spanned(n: int, i: np.ndarray, j: np.ndarray, d: np.ndarray, w: np.ndarray) -> np.ndarray:
    """x by a walk along edges alone: exact where all edges agree."""
    x = np.zeros((n, d.shape[1]))
    for k, by, e in walk(n, i, j):
        if e >= 0:
            x[k] = x[by] + (d[e] if i[e] == by else -d[e])
    return x


def worst(n: int, i: np.ndarray, j: np.ndarray, misfit: np.ndarray, least: float) -> np.ndarray:
    """Edges that are above `least`, at least half as far off as the worst of all (a wrong edge bends those around it), and the worst at both their ends."""
    least = max(least, misfit.max(initial=0.0) / 2)
    peak = np.zeros(n)
    np.maximum.at(peak, i, misfit)
    np.maximum.at(peak, j, misfit)
    return np.flatnonzero((misfit > least) & (misfit >= peak[i]) & (misfit >= peak[j]))


def robust(n: int, i: np.ndarray, j: np.ndarray, d: np.ndarray, w: np.ndarray, most: float) -> tuple[np.ndarray, np.ndarray]:
    """(x, kept): as `solved`, without edges that miss it by more than `most`.

    The worst edge of each neighbourhood goes, then all is solved anew, until
    no edge is off. An edge that holds two groups together always fits, so it
    stays; where those chosen together would part a group, only the worst goes.
    """
    kept = np.ones(len(i), bool)
    x = None
    while True:
        at = np.flatnonzero(kept)
        x = solved(n, i[at], j[at], d[at], w[at], x)
        off = np.sqrt((((x[j] - x[i] - d)[at]) ** 2).sum(axis=1))
        bad = worst(n, i[at], j[at], off, most)
        if not len(bad):
            return x, kept
        trial = kept.copy()
        trial[at[bad]] = False
        if len(set(components(n, i[trial], j[trial]).tolist())) > len(set(components(n, i[at], j[at]).tolist())):
            trial = kept.copy()
            trial[at[off.argmax()]] = False
        kept = trial


def fit(p: np.ndarray, q: np.ndarray, w: np.ndarray, kind: str) -> np.ndarray:
    """The 4 by 4 map of a kind that best takes points p to q (n, 3), weighted. Axes along which p does not reach beyond one place are only shifted."""
    if kind not in KINDS:
        raise ValueError(f"transform must be one of {KINDS}")
    w = w / w.sum()
    mp, mq = w @ p, w @ q
    a, b = p - mp, q - mq
    use = np.flatnonzero(np.ptp(p, axis=0) > 1e-9)
    m = np.eye(3)
    if kind != "translation" and len(use):
        x, y = a[:, use], b[:, use]
        if kind == "affine":
            s = (x * w[:, None]).T @ x
            m[np.ix_(use, use)] = np.linalg.lstsq(s, (x * w[:, None]).T @ y, rcond=1e-12)[0].T
        else:
            u, k, vt = np.linalg.svd((y * w[:, None]).T @ x)
            sign = np.ones(len(use))
            sign[-1] = np.sign(np.linalg.det(u @ vt)) or 1
            zoom = (k * sign).sum() / max((w[:, None] * x * x).sum(), 1e-300) if kind == "similarity" else 1.0
            m[np.ix_(use, use)] = zoom * (u * sign) @ vt
    out = np.eye(4)
    out[:3, :3], out[:3, 3] = m, mq - m @ mp
    return out


def moved(m: np.ndarray, p: np.ndarray) -> np.ndarray:
    return p @ m[:3, :3].T + m[:3, 3]


def generators(kind: str, use: np.ndarray) -> np.ndarray:
    """The matrices (k, 3, 3) that the linear part of a map of a kind may change by, along the axes `use`."""
    one = lambda a, b: np.eye(3)[:, [a]] @ np.eye(3)[[b]]
    if kind == "affine":
        out = [one(a, b) for a in use for b in use]
    else:
        out = [one(a, b) - one(b, a) for n, a in enumerate(use) for b in use[n + 1 :]] if kind in ("rigid", "similarity") else []
        out += [np.diag(np.isin(range(3), use).astype(float))] if kind == "similarity" else []
    return np.array(out).reshape(-1, 3, 3)


def of_kind(linear: np.ndarray, kind: str, use: np.ndarray) -> np.ndarray:
    """The nearest linear parts (n, 3, 3) of a kind."""
    if kind not in ("rigid", "similarity") or len(use) < 2:
        return linear
    out, at = linear.copy(), np.ix_(range(len(linear)), use, use)
    u, k, vt = np.linalg.svd(out[at])
    out[at] = u @ vt * (k.mean(axis=1)[:, None, None] if kind == "similarity" else 1.0)
    return out


def relaxed(maps: np.ndarray, i: np.ndarray, j: np.ndarray, points: np.ndarray, others: np.ndarray, w: np.ndarray, kind: str, still: np.ndarray, rounds: int = 20, tolerance: float = 1e-4) -> np.ndarray:
    """Maps of a kind, changed until matching points are as near as they can be: steps of least squares over all tiles at once, each by conjugate gradients over the edges. Tiles in `still` keep theirs."""
    n, maps = len(maps), maps.copy()
    use = np.flatnonzero(np.ptp(points.reshape(-1, 3), axis=0) > 1e-9)
    gens = generators(kind, use) if kind != "translation" else np.zeros((0, 3, 3))
    g = len(gens)
    many = np.maximum(np.bincount(i, minlength=n) + np.bincount(j, minlength=n), 1) * points.shape[1]
    add = lambda x, y: np.stack([np.bincount(i, x[:, k], n) + np.bincount(j, y[:, k], n) for k in range(x.shape[1])], axis=1)
    middle = add(points.sum(axis=1), others.sum(axis=1)) / many[:, None]
    size = max(float(np.abs(points - middle[i][:, None]).max()), float(np.abs(others - middle[j][:, None]).max()), 1.0)
    x, y, free = (points - middle[i][:, None]) / size, (others - middle[j][:, None]) / size, ~still
    weight = w[:, None, None]
    for _ in range(rounds):
        linear, shift = maps[:, :3, :3], maps[:, :3, 3]
        li, lj = linear[i], linear[j]
        to = lambda l, p, t: np.einsum("eab,epb->epa", l, p) + t[:, None]
        r = to(li, points, shift[i]) - to(lj, others, shift[j])

        def forth(d: np.ndarray) -> np.ndarray:
            m = np.tensordot(d[:, :g], gens, axes=(1, 0)) if g else np.zeros((n, 3, 3))
            return to(li @ m[i], x, d[i, g:]) - to(lj @ m[j], y, d[j, g:])  # noqa: B023

        def back(e: np.ndarray) -> np.ndarray:
            parts = []
            for l, p, s in ((li, x, 1), (lj, y, -1)):  # noqa: B023
                o = np.einsum("epa,epb->eab", np.einsum("eba,epb->epa", l, e), p)
                parts.append(s * np.concatenate([np.tensordot(o, gens, axes=([1, 2], [1, 2])) if g else np.zeros((len(e), 0)), e.sum(axis=1)], axis=1))
            return add(*parts) * free[:, None]

        own = np.ones((n, g + 3))
        for k, m in enumerate(gens):
            own[:, k] = add(*(((w[:, None, None] * np.einsum("eab,epb->epa", l @ m, p) ** 2).sum(axis=(1, 2)))[:, None] for l, p in ((li, x), (lj, y))))[:, 0]
        own[:, g:] = add(w[:, None], w[:, None]) * points.shape[1]
        own = np.maximum(own, 1e-9 * own.max())
        step, b = np.zeros((n, g + 3)), -back(weight * r)
        rest, z = b, b / own
        p, rz = z, float((b * z).sum())
        least = 1e-16 * rz
        for _ in range(20 * int(n**0.5) + 100):
            if rz <= max(least, 1e-300):
                break
            q = back(weight * forth(p))
            a = rz / max(float((p * q).sum()), 1e-300)
            step, rest = step + a * p, rest - a * q
            z = rest / own
            new = float((rest * z).sum())
            p, rz = z + new / rz * p, new
        turn = np.tensordot(step[:, :g], gens, axes=(1, 0)) / size if g else np.zeros((n, 3, 3))
        after = of_kind(linear @ (np.eye(3) + turn), kind, use)
        after[still] = linear[still]
        maps[:, :3, 3] = shift + step[:, g:] + np.einsum("nab,nb->na", linear - after, middle)
        maps[:, :3, :3] = after
        if np.abs(step[:, g:]).max(initial=0) <= tolerance and np.abs(turn).max(initial=0) * size <= tolerance:
            break
    return maps


def resolved_maps(n: int, i: np.ndarray, j: np.ndarray, points: np.ndarray, others: np.ndarray, w: np.ndarray, kind: str, first: np.ndarray, most: float = np.inf) -> tuple[np.ndarray, np.ndarray]:
    """(maps (n, 4, 4), kept): a map of a kind for every tile, such that the points (edge, point, axis) of tile i land where the matching ones of tile j do.

    first: maps of tiles on their own; the smallest tile of each group keeps
    its own. Tiles are laid on those placed before, breadth-first, and then all
    are relaxed. Edges whose points are apart by more than `most` on average go
    as in `robust`.
    """
    if kind not in KINDS:
        raise ValueError(f"transform must be one of {KINDS}")
    kept = np.ones(len(i), bool)
    while True:
        at = np.flatnonzero(kept)
        order = walk(n, i[at], j[at])
        maps, still = first.copy(), np.zeros(n, bool)
        own = lambda k, e: points[at[e]] if i[at[e]] == k else others[at[e]]
        for k, by, e in order:
            still[k] = e < 0
            if e >= 0:
                maps[k] = fit(own(k, e), moved(maps[by], own(by, e)), np.ones(points.shape[1]), kind)
        maps = relaxed(maps, i[at], j[at], points[at], others[at], w[at], kind, still)
        to = lambda k, p: np.einsum("eab,epb->epa", maps[k][:, :3, :3], p) + maps[k][:, None, :3, 3]
        off = np.sqrt(((to(i[at], points[at]) - to(j[at], others[at])) ** 2).sum(axis=2)).mean(axis=1)
        bad = worst(n, i[at], j[at], off, most)
        if not len(bad):
            return maps, kept
        trial = kept.copy()
        trial[at[bad]] = False
        if len(set(components(n, i[trial], j[trial]).tolist())) > len(set(components(n, i[at], j[at]).tolist())):
            trial = kept.copy()
            trial[at[off.argmax()]] = False
        kept = trial
