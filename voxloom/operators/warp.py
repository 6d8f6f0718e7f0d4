"""Fusion of tiles under affine maps and shifts by parts of a voxel.

A tile's map takes its voxels (z, y, x) to the output's. Every output chunk is
made by going back through the maps of the tiles whose moved boxes meet it:
parts of tiles go, once, to the output chunks that they can be seen in, with
the voxel beside them that interpolation asks for, and values lie between the
eight (four, two) voxels around a place, linearly. A place belongs to a tile if
it lies between the tile's first and last voxel along every axis. Voxels that
are not stored are zeros and weigh like others.

Maps and sizes (a row per tile, MOST_TILES at most) reach the tasks with the
kernel; which tiles meet a chunk is told by their moved boxes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from voxloom.kernels.sample import NEAR, between, inside, places
from voxloom.operators.blocks import MOST_TILES, PARTS, _mapped
from voxloom.operators.storage import _rows, block
from voxloom.schemas import CHUNKS, U16_MAX

Map = np.ndarray


def shifted(shift: tuple[float, ...]) -> Map:
    """The map that moves by a shift (z, y, x)."""
    out = np.eye(4)
    out[:3, 3] = shift
    return out


def moved_box(m: Map, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least and largest coordinates of a box (ends included) after a map."""
    centre, half = (np.asarray(lo) + hi) / 2, (np.asarray(hi) - lo) / 2
    c, r = m[:3, :3] @ centre + m[:3, 3], np.abs(m[:3, :3]) @ half
    return c - r, c + r


class Moves:
    """The maps of all tiles, their inverses, and the boxes that tiles take up in the output."""

    def __init__(self, maps: dict[int, Map], sizes: dict[int, tuple[int, int, int]]):
        if len(maps) > MOST_TILES:
            raise ValueError(f"more than {MOST_TILES} tiles")
        self.at = {t: k for k, t in enumerate(maps)}
        self.maps = np.array([np.asarray(m, float) for m in maps.values()]).reshape(-1, 4, 4)
        self.sizes = np.array([sizes[t] for t in maps], np.int64).reshape(-1, 3)
        flat = [t for t, k in self.at.items() if abs(np.linalg.det(self.maps[k][:3, :3])) < 1e-9]
        if flat:
            raise ValueError(f"the maps of tiles {flat[:5]} cannot be inverted")
        self.back = np.linalg.inv(self.maps)
        boxes = [moved_box(m, np.zeros(3), n - 1) for m, n in zip(self.maps, self.sizes, strict=True)]
        self.lo, self.hi = (np.array([b[i] for b in boxes]).reshape(-1, 3) for i in (0, 1))

    def extent(self) -> tuple[np.ndarray, np.ndarray]:
        """First and last whole voxel that some tile reaches."""
        return np.ceil(self.lo.min(axis=0) - NEAR).astype(int), np.floor(self.hi.max(axis=0) + NEAR).astype(int)

    def meeting(self, lo: np.ndarray, hi: np.ndarray) -> list[int]:
        """Tiles whose moved box meets an output box (ends included)."""
        return np.flatnonzero(((self.lo <= hi + NEAR) & (self.hi >= lo - NEAR)).all(axis=1)).tolist()

    def source(self, k: int, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The voxels of tile k (half-open) that an output box (ends included) can ask for."""
        a, b = moved_box(self.back[k], lo, hi)
        return np.clip(np.floor(a - NEAR), 0, self.sizes[k]).astype(int), np.clip(np.floor(b + NEAR) + 2, 0, self.sizes[k]).astype(int)


def _weight(at: list[np.ndarray], size: np.ndarray, blend: bool) -> np.ndarray:
    """0 outside the tile; else 1, or the distance past the nearer edges in y and x."""
    w = inside(at, size)
    if blend:
        for s, n in zip(at[1:], size[1:], strict=True):
            w = w * np.minimum(s + 1, n - s)
    return w


def warped(parts: DataFrame, maps: dict[int, Map], sizes: dict[int, tuple[int, int, int]], size: tuple[int, int, int], shape: dict[str, int], how: str = "mean") -> DataFrame:
    """One image of tile parts (PARTS, in the tiles' coordinates), tile k mapped by maps[k] (4 by 4, z y x): chunks of `size` of an image of `shape`.

    how: `mean` of the tiles that cover a voxel, `blend` (weights fall off
    linearly to a tile's edges in y and x) or `max`. Values are cut to whole
    numbers, after a millionth is added for rounding. A task holds one output
    chunk, as sums and weights, and one tile's part of it at a time.
    """
    if how not in ("mean", "blend", "max"):
        raise ValueError("how must be mean, blend or max")
    moves, full = Moves(maps, sizes), np.array([shape[a] for a in "zyx"])
    step = np.array(size)

    def chunk_box(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return key * step, np.minimum((key + 1) * step, full) - 1

    def move(r: dict, a: np.ndarray) -> list[tuple]:
        k, lo = moves.at[r["tile_id"]], np.array([r["z0"], r["y0"], r["x0"]])
        hi = lo + a.shape
        first, last = moved_box(moves.maps[k], lo - 1, hi)  # an output voxel uses voxels less than 1 away
        first, last = np.maximum(np.ceil(first - NEAR), 0).astype(int) // step, np.minimum(np.floor(last + NEAR), full - 1).astype(int) // step
        out = []
        for key in np.ndindex(*np.maximum(last - first + 1, 0)):
            to = first + key
            s_lo, s_hi = moves.source(k, *chunk_box(to))
            s_lo, s_hi = np.maximum(s_lo, lo), np.minimum(s_hi, hi)
            if (s_lo < s_hi).all():
                p = a[tuple(slice(i, j) for i, j in zip(s_lo - lo, s_hi - lo, strict=True))]
                if p.any():
                    out.append((r["tile_id"], r["image"], 0, r["c"], *map(int, to), *map(int, s_lo), *p.shape, p.astype("<u2").tobytes()))
        return out

    def whole(key: tuple, held: dict[int, list]) -> tuple | None:
        c, *to = key
        o, last = chunk_box(np.array(to))
        dims = last - o + 1
        top, low = np.zeros(dims), np.zeros(dims)
        y, x = np.arange(o[1], last[1] + 1), np.arange(o[2], last[2] + 1)
        for k in moves.meeting(o, last):
            n, own = moves.sizes[k], held.get(k, ())
            if not own and how == "max":
                continue
            s_lo, s_hi = moves.source(k, o, last)
            a = np.zeros(np.maximum(s_hi - s_lo, 0), np.uint16)
            for corner, p in own:
                a[tuple(slice(i, i + m) for i, m in zip(np.array(corner) - s_lo, p.shape, strict=True))] = p
            for z in range(dims[0]):
                at = places(moves.back[k], int(o[0]) + z, y, x)
                w = _weight(at, n, how == "blend")
                if not w.any():
                    continue
                v = between(a, s_lo, n, at) if own else 0.0
                if how == "max":
                    np.maximum(top[z], v * w, out=top[z])
                else:
                    top[z] += v * w
                    low[z] += w
        if how != "max":
            top /= np.where(low > 0, low, 1)
        top = np.floor(np.clip(top + NEAR, 0, U16_MAX)).astype("<u2")
        return ("image", 0, c, *to, *map(int, o), *map(int, dims), top.tobytes()) if top.any() else None

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, {}
        for b in batches:
            for r in b.to_pylist():
                key = (r["c"], r["cz"], r["cy"], r["cx"])
                if key != now:
                    if now is not None and (row := whole(now, held)):
                        yield _rows([row])
                    now, held = key, {}
                held.setdefault(moves.at[r["tile_id"]], []).append(((r["z0"], r["y0"], r["x0"]), block(r)))
        if now is not None and (row := whole(now, held)):
            yield _rows([row])

    keys = ["c", "cz", "cy", "cx"]
    return _mapped(parts, move, PARTS).repartition(*keys).sortWithinPartitions(*keys, "tile_id").mapInArrow(gather, CHUNKS)
