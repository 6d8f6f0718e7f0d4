"""Image operators on whole chunks: corrections, overlaps, pyramids, crops and fusion without a row per voxel.

A chunk is worked on where it lies; only parts of chunks that belong to another
chunk of the result are shuffled, and sums, histograms and projections leave a
chunk already added up. An absent chunk is all zeros and stays absent, but its
voxels count: in means, percentiles and in the weights of fusion.

Tile tables, gains and profiles reach the tasks with the kernel. Their size is
checked (`Tiles.of`, MOST_TILES) or known: a profile has one tile's pixels.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.operators.storage import _rows, assembled, block, cut, rechunked
from voxloom.schemas import CHUNKS, U16_MAX

#: Tiles that a kernel is given at most; a mosaic has hundreds.
MOST_TILES = 200_000
#: Chunk parts of a tile, corner in the tile's coordinates.
PARTS = "tile_id int, " + CHUNKS


@dataclass
class Tiles:
    """Boxes of tiles in pixels, y and x."""

    ids: np.ndarray
    y0: np.ndarray
    y1: np.ndarray
    x0: np.ndarray
    x1: np.ndarray

    @classmethod
    def of(cls, boxes: DataFrame) -> Tiles:
        """Of a table (tile_id, y0, y1, x0, x1) with MOST_TILES rows at most; more are an error."""
        rows = sorted(tuple(r) for r in boxes.select("tile_id", "y0", "y1", "x0", "x1").limit(MOST_TILES + 1).collect())
        if len(rows) > MOST_TILES:
            raise ValueError(f"more than {MOST_TILES} tiles")
        return cls(*np.array(rows, np.int64).reshape(-1, 5).T)

    def meeting(self, y: int, x: int, ny: int, nx: int) -> Iterator[tuple[int, int, int, int, int]]:
        """(which tile, y0, y1, x0, x1): the parts of tiles in a box, in the image's coordinates."""
        for k in np.flatnonzero((self.y0 < y + ny) & (self.y1 > y) & (self.x0 < x + nx) & (self.x1 > x)).tolist():
            yield k, max(y, int(self.y0[k])), min(y + ny, int(self.y1[k])), max(x, int(self.x0[k])), min(x + nx, int(self.x1[k]))


def _mapped(chunks: DataFrame, f: Callable[[dict, np.ndarray], list[tuple]], schema: str = CHUNKS) -> DataFrame:
    """Rows of f(chunk row, its voxels) for every chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in schema.split(", ")]
        kinds = [{"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "double": pa.float64()}[x.split()[1]] for x in schema.split(", ")]
        for b in batches:
            for r in b.to_pylist():
                rows = f(r, block(r))
                for i in range(0, len(rows), 64):
                    some = rows[i : i + 64]
                    yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in some], t) for k, t in enumerate(kinds)], names=names)

    return chunks.mapInArrow(run, schema)


def corrected(chunks: DataFrame, boxes: DataFrame, value: Callable[[int, int, slice, slice, slice, np.ndarray], np.ndarray]) -> DataFrame:
    """Chunks with value(c, tile_id, z, y, x, voxels) in the place of each tile's voxels (y and x in the tile's coordinates), clipped and cut to 16 bits; 0 outside all tiles. Nothing is shuffled."""
    tiles = Tiles.of(boxes)

    def one(r: dict, a: np.ndarray) -> list[tuple]:
        out = np.zeros(a.shape, "<u2")
        for k, y0, y1, x0, x1 in tiles.meeting(r["y0"], r["x0"], r["ny"], r["nx"]):
            at = (slice(None), slice(y0 - r["y0"], y1 - r["y0"]), slice(x0 - r["x0"], x1 - r["x0"]))
            ty, tx = slice(y0 - int(tiles.y0[k]), y1 - int(tiles.y0[k])), slice(x0 - int(tiles.x0[k]), x1 - int(tiles.x0[k]))
            v = value(r["c"], int(tiles.ids[k]), slice(r["z0"], r["z0"] + r["nz"]), ty, tx, a[at].astype(float))
            out[at] = np.floor(np.clip(v, 0, U16_MAX))
        return [(*(r[x.split()[0]] for x in CHUNKS.split(", ")[:-1]), out.tobytes())] if out.any() else []

    return _mapped(chunks, one)


def apply_flatfield(chunks: DataFrame, boxes: DataFrame, profiles: dict[int, tuple[np.ndarray, np.ndarray | None, float]]) -> DataFrame:
    """Every tile's voxels by its channel's (flat, dark, baseline), which have a tile's pixels: (v - dark) / (flat + 1e-6) less the baseline, 0 where not above it."""
    shared = chunks.sparkSession.sparkContext.broadcast(profiles)

    def value(c: int, tile: int, z: slice, y: slice, x: slice, v: np.ndarray) -> np.ndarray:
        flat, dark, baseline = shared.value[c]
        q = (v - (0.0 if dark is None else dark[y, x])) / (flat[y, x] + 1e-6)
        return np.where(q > baseline, q - baseline, 0.0)

    return corrected(chunks, boxes, value)


def apply_illumination(chunks: DataFrame, boxes: DataFrame, gains: dict[tuple[int, int], float], profile: dict[tuple[int, int], float] | None = None) -> DataFrame:
    """Every voxel times its tile's gain (c, tile_id) and its plane's profile (c, z); 1 where there is none."""

    def value(c: int, tile: int, z: slice, y: slice, x: slice, v: np.ndarray) -> np.ndarray:
        p = np.array([(profile or {}).get((c, k), 1.0) for k in range(z.start, z.stop)])
        return v * gains.get((c, tile), 1.0) * p[:, None, None]

    return corrected(chunks, boxes, value)


def overlap_sums(chunks: DataFrame, boxes: DataFrame, sides: DataFrame) -> DataFrame:
    """(c, i, j, side, s, n): sum and count of the voxels above 0 of every side's rectangle.

    sides (i, j, side, tile_id, y0, y1, x0, x1): a pair's overlap in one of its
    tiles, in the tile's coordinates; neighbours only, so a few rows a tile.
    """
    tiles = Tiles.of(boxes)
    of: dict[int, list[tuple]] = {}
    for r in sides.collect():  # a few rows a tile, whose number Tiles.of has checked
        of.setdefault(r["tile_id"], []).append((r["i"], r["j"], r["side"], r["y0"], r["y1"], r["x0"], r["x1"]))

    def one(r: dict, a: np.ndarray) -> list[tuple]:
        out = []
        for k, y0, y1, x0, x1 in tiles.meeting(r["y0"], r["x0"], r["ny"], r["nx"]):
            oy, ox = int(tiles.y0[k]), int(tiles.x0[k])
            for i, j, side, sy0, sy1, sx0, sx1 in of.get(int(tiles.ids[k]), ()):
                lo, hi, le, ri = max(y0, oy + sy0), min(y1, oy + sy1), max(x0, ox + sx0), min(x1, ox + sx1)
                if lo < hi and le < ri:
                    p = a[:, lo - r["y0"] : hi - r["y0"], le - r["x0"] : ri - r["x0"]]
                    if n := int(np.count_nonzero(p)):
                        out.append((r["c"], i, j, side, int(p.sum(dtype=np.int64)), n))
        return out

    g = _mapped(chunks, one, "c int, i int, j int, side int, s long, n long")
    return g.groupBy("c", "i", "j", "side").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))


def coarsened(chunks: DataFrame, size: tuple[int, int, int], shape: dict[str, int], factor: dict[str, int], how: str = "mean") -> DataFrame:
    """The next level's chunks: block means cut to whole numbers, or block maxima (labels), edges repeated to whole blocks. Blocks lie within chunks, so only finished values move."""
    f = [factor.get(a, 1) for a in "zyx"]
    if any(s % k and s < shape[a] for s, k, a in zip(size, f, "zyx", strict=True)):
        whole = tuple(-(-s // k) * k for s, k in zip(size, f, strict=True))
        chunks = rechunked(chunks, whole, shape)
    new = {a: -(-shape[a] // k) for a, k in zip("zyx", f, strict=True)}

    def one(r: dict, a: np.ndarray) -> list[tuple]:
        a = np.pad(a, [(0, -n % k) for n, k in zip(a.shape, f, strict=True)], mode="edge").astype(np.int64)
        z, y, x = a.shape
        a = a.reshape(z // f[0], f[0], y // f[1], f[1], x // f[2], f[2])
        m = a.max(axis=(1, 3, 5)) if how == "max" else a.sum(axis=(1, 3, 5)) // (f[0] * f[1] * f[2])
        return list(cut(r["image"], r["level"] + 1, r["c"], (r["z0"] // f[0], r["y0"] // f[1], r["x0"] // f[2]), m, size))

    return assembled(_mapped(chunks, one), size, new)


def histogram(chunks: DataFrame, step: int = 2) -> DataFrame:
    """(c, v, n): counts of the values above 0 at every step-th voxel along each axis; 65,535 rows a channel at most."""

    def one(r: dict, a: np.ndarray) -> list[tuple]:
        n = np.bincount(a[-r["z0"] % step :: step, -r["y0"] % step :: step, -r["x0"] % step :: step].ravel())
        return [(r["c"], int(v), int(n[v])) for v in np.flatnonzero(n).tolist() if v]

    return _mapped(chunks, one, "c int, v int, n long").groupBy("c", "v").agg(F.sum("n").alias("n"))


def _percentile(v: np.ndarray, n: np.ndarray, p: float) -> float:
    """Percentile of values v (ascending) that occur n times, between ranks linearly."""
    at = p * (n.sum() - 1)
    upto = np.cumsum(n)
    lo, hi = (float(v[np.searchsorted(upto, k, side="right")]) for k in (np.floor(at), np.ceil(at)))
    return lo + (hi - lo) * (at - np.floor(at))


def contrast(chunks: DataFrame, shape: dict[str, int], channels: int, segment: bool = False, step: int = 2, low: float = 0.001, high: float = 0.999) -> dict[int, tuple[int, int]]:
    """channel -> (start, end) from exact percentiles of every step-th voxel, zeros that are not stored included; segment: of those above the median. 0 and 65535 where there are none."""
    total = int(np.prod([-(-shape[a] // step) for a in "zyx"]))
    got: dict[int, list] = {}
    for r in histogram(chunks, step).collect():  # 65,535 rows a channel at most
        got.setdefault(r["c"], []).append((r["v"], r["n"]))
    out = {}
    for c in range(channels):
        v, n = np.array(sorted([*got.get(c, []), (0, total - sum(k for _, k in got.get(c, [])))])).reshape(-1, 2).T
        if segment:
            keep = v > _percentile(v, n, 0.5)
            v, n = v[keep], n[keep]
        out[c] = (int(_percentile(v, n, low)), int(_percentile(v, n, high))) if n.sum() else (0, U16_MAX)
    return out


def cropped(chunks: DataFrame, box: dict[str, tuple[int, int]], size: tuple[int, int, int]) -> DataFrame:
    """The chunks of a box (half-open, z y x), its corner moved to 0. Chunks outside are not read."""
    for a in "zyx":
        chunks = chunks.where((F.col(f"{a}0") < box[a][1]) & (F.col(f"{a}0") + F.col(f"n{a}") > box[a][0]))

    def one(r: dict, a: np.ndarray) -> list[tuple]:
        lo = [max(r[f"{x}0"], box[x][0]) for x in "zyx"]
        hi = [min(r[f"{x}0"] + r[f"n{x}"], box[x][1]) for x in "zyx"]
        p = a[tuple(slice(i - r[f"{x}0"], j - r[f"{x}0"]) for i, j, x in zip(lo, hi, "zyx", strict=True))]
        return list(cut(r["image"], r["level"], r["c"], tuple(i - box[x][0] for i, x in zip(lo, "zyx", strict=True)), p, size))

    return assembled(_mapped(chunks, one), size, {a: box[a][1] - box[a][0] for a in "zyx"})


def near(chunks: DataFrame, rects: DataFrame, size: tuple[int, int, int], planes: list[int] | None = None) -> DataFrame:
    """The chunks (of a grid of `size`) that rectangles (y0, y1, x0, x1; half-open) meet, and, where they are given, planes: the others leave the scan before any kernel.

    Rectangles are a few per tile, whose number is checked where tiles are
    read; there is a row for each chunk column that they meet. Ranges of
    corners reach the scan as well, so files and row groups outside are not read.
    """
    at = [F.explode(F.sequence(F.floor(F.col(f"{a}0") / n), F.floor((F.col(f"{a}1") - 1) / n))).alias(f"k{a}") for a, n in zip("yx", size[1:], strict=True)]
    cells = rects.where("y0 < y1 AND x0 < x1").select("x0", "x1", at[0]).select("ky", at[1]).distinct()
    rows = [(r["ky"] * size[1], r["kx"] * size[2]) for r in cells.limit(16 * MOST_TILES + 1).collect()]
    if len(rows) > 16 * MOST_TILES:
        raise ValueError(f"rectangles meet more than {16 * MOST_TILES} chunk columns")
    if not rows:
        return chunks.where("false")
    for a, k in (("y0", 0), ("x0", 1)):
        chunks = chunks.where(F.col(a).between(min(r[k] for r in rows), max(r[k] for r in rows)))
    if planes is not None:
        layers = sorted({z // size[0] * size[0] for z in planes})
        chunks = chunks.where(F.col("z0").isin(layers) & F.col("z0").between(min(layers, default=0), max(layers, default=-1)))
    found = chunks.sparkSession.createDataFrame(rows, "y0 int, x0 int")
    return chunks.join(F.broadcast(found), ["y0", "x0"], "left_semi")  # two numbers a row, their count just checked


def tile_parts(chunks: DataFrame, boxes: DataFrame) -> DataFrame:
    """PARTS: chunks cut at tile borders, corners in the tile's coordinates; one part for each tile and chunk that meet."""
    tiles = Tiles.of(boxes)

    def one(r: dict, a: np.ndarray) -> list[tuple]:
        out = []
        for k, y0, y1, x0, x1 in tiles.meeting(r["y0"], r["x0"], r["ny"], r["nx"]):
            p = a[:, y0 - r["y0"] : y1 - r["y0"], x0 - r["x0"] : x1 - r["x0"]]
            if p.any():
                out.append((int(tiles.ids[k]), r["image"], r["level"], r["c"], 0, 0, 0, r["z0"], y0 - int(tiles.y0[k]), x0 - int(tiles.x0[k]), *p.shape, p.astype("<u2").tobytes()))
        return out

    return _mapped(chunks, one, PARTS)


def _ramp(n: int) -> np.ndarray:
    """Distance from the nearer end, from 1 on."""
    k = np.arange(n, dtype=np.int64)
    return np.minimum(k + 1, n - k)


def fused(parts: DataFrame, places: dict[int, tuple[int, int, int]], sizes: dict[int, tuple[int, int, int]], size: tuple[int, int, int], shape: dict[str, int], how: str = "mean") -> DataFrame:
    """One image of tile parts: tile k, of size sizes[k], with its corner at places[k] (z, y, x).

    how: `mean` of all tiles that cover a voxel, `blend` (weights fall off
    linearly to a tile's edges in y and x) or `max`. Voxels that are not stored
    are zeros and weigh like any others: the divisor comes from the tiles'
    boxes, not from the parts that are there. Parts move to the output chunks
    they fall into, once.
    """
    if how not in ("mean", "blend", "max"):
        raise ValueError("how must be mean, blend or max")

    def move(r: dict, a: np.ndarray) -> list[tuple]:
        k = r["tile_id"]
        at = tuple(r[f"{x}0"] + s for x, s in zip("zyx", places[k], strict=True))
        skip = [max(0, -o) for o in at]  # what lies before the output's corner or past its end is cut off
        a = a[tuple(slice(s, max(s, shape[x] - o)) for s, o, x in zip(skip, at, "zyx", strict=True))]
        return [(k, *p) for p in cut(r["image"], 0, r["c"], tuple(o + s for o, s in zip(at, skip, strict=True)), a, size)] if a.size else []

    ids = list(places)
    first = np.array([places[k] for k in ids], np.int64).reshape(-1, 3)
    past = first + np.array([sizes[k] for k in ids], np.int64).reshape(-1, 3)

    def weights(k: int, lo: list[int], hi: list[int]) -> np.ndarray:
        """Of tile k over an output box inside its own."""
        (_, ny, nx), (_, sy, sx) = sizes[k], places[k]
        if how != "blend":
            return np.ones((1, hi[1] - lo[1], hi[2] - lo[2]), np.int64)
        return (_ramp(ny)[lo[1] - sy : hi[1] - sy, None] * _ramp(nx)[lo[2] - sx : hi[2] - sx])[None]

    def whole(key: tuple, held: list[tuple]) -> tuple | None:
        c, *to = key
        o = [t * s for t, s in zip(to, size, strict=True)]
        dims = [min(s, shape[x] - i) for s, x, i in zip(size, "zyx", o, strict=True)]
        top, low = np.zeros(dims, np.int64), np.zeros(dims, np.int64)
        for k, lo, a in held:
            at = tuple(slice(i - j, i - j + n) for i, j, n in zip(lo, o, a.shape, strict=True))
            if how == "max":
                top[at] = np.maximum(top[at], a)
            else:
                top[at] += a.astype(np.int64) * weights(k, lo, [i + n for i, n in zip(lo, a.shape, strict=True)])
        if how != "max":
            end = np.add(o, dims)
            for i in np.flatnonzero(((first < end) & (past > o)).all(axis=1)).tolist():  # tiles that meet the chunk
                lo, hi = np.maximum(first[i], o).tolist(), np.minimum(past[i], end).tolist()
                low[tuple(slice(a - x, b - x) for a, b, x in zip(lo, hi, o, strict=True))] += weights(ids[i], lo, hi)
            top = np.floor(top / np.maximum(low, 1)).astype(np.int64)
        return ("image", 0, c, *to, *o, *dims, np.minimum(top, U16_MAX).astype("<u2").tobytes()) if top.any() else None

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for b in batches:
            for r in b.to_pylist():
                key = (r["c"], r["cz"], r["cy"], r["cx"])
                if key != now:
                    if now is not None and (row := whole(now, held)):
                        yield _rows([row])
                    now, held = key, []
                held.append((r["tile_id"], [r["z0"], r["y0"], r["x0"]], block(r)))
        if now is not None and (row := whole(now, held)):
            yield _rows([row])

    keys = ["c", "cz", "cy", "cx"]
    return _mapped(parts, move, PARTS).repartition(*keys).sortWithinPartitions(*keys, "tile_id").mapInArrow(gather, CHUNKS)


def planes(parts: DataFrame, wanted: set[tuple[int, int]], height: int, width: int, work: tuple[int, int]) -> DataFrame:
    """(c, tile_id, z, plane): wanted planes (tile_id, z; a sample) of tiles, resized to `work`; plane holds little-endian doubles. Only they leave their chunks; a group is one plane."""
    from voxloom.kernels.transforms import resized

    def cut_planes(r: dict, a: np.ndarray) -> list[tuple]:
        return [(r["tile_id"], r["c"], r["z0"] + k, r["y0"], r["x0"], r["ny"], r["nx"], p.astype("<u2").tobytes()) for k, p in enumerate(a) if (r["tile_id"], r["z0"] + k) in wanted]

    flat = _mapped(parts, cut_planes, "tile_id int, c int, z int, y0 int, x0 int, ny int, nx int, data binary")
    some = flat.select("c", "tile_id", "z", "y0", "x0", "ny", "nx", "data")
    keys = ["c", "tile_id", "z"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, None
        out = lambda: pa.RecordBatch.from_arrays([*(pa.array([k], pa.int32()) for k in now), pa.array([resized(held, work).astype("<f8").tobytes()], pa.binary())], names=[*keys, "plane"])
        for b in batches:
            for r in b.to_pylist():
                if (key := (r["c"], r["tile_id"], r["z"])) != now:
                    if now is not None:
                        yield out()
                    now, held = key, np.zeros((height, width))
                held[r["y0"] : r["y0"] + r["ny"], r["x0"] : r["x0"] + r["nx"]] = np.frombuffer(r["data"], "<u2").reshape(r["ny"], r["nx"])
        if now is not None:
            yield out()

    return some.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "c int, tile_id int, z int, plane binary")


def plane_median(found: DataFrame, n: int, work: tuple[int, int], rows: int = 64) -> dict[int, np.ndarray]:
    """channel -> median over n planes of `planes`; those that are not there are zeros. A task holds n bands of `rows` rows."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for c, _, _, plane in zip(*(x.to_pylist() for x in b.columns), strict=True):
                a = np.frombuffer(plane, "<f8").reshape(work)
                bands = [a[i : i + rows].astype("<f8").tobytes() for i in range(0, work[0], rows)]
                yield pa.RecordBatch.from_arrays([pa.array([c] * len(bands), pa.int32()), pa.array(range(len(bands)), pa.int32()), pa.array(bands, pa.binary())], names=["c", "band", "data"])

    def middle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []

        def out() -> pa.RecordBatch:
            stack = np.stack([np.frombuffer(x, "<f8") for x in held] + [np.zeros(len(held[0]) // 8)] * (n - len(held)))
            return pa.RecordBatch.from_arrays([pa.array([now[0]], pa.int32()), pa.array([now[1]], pa.int32()), pa.array([np.median(stack, axis=0).astype("<f8").tobytes()], pa.binary())], names=["c", "band", "data"])

        for b in batches:
            for c, band, x in zip(*(k.to_pylist() for k in b.columns), strict=True):
                if (c, band) != now:
                    if now is not None:
                        yield out()
                    now, held = (c, band), []
                held.append(x)
        if now is not None:
            yield out()

    schema = "c int, band int, data binary"
    got = found.mapInArrow(split, schema).repartition("c", "band").sortWithinPartitions("c", "band").mapInArrow(middle, schema).collect()  # one plane a channel
    out: dict[int, np.ndarray] = {}
    for r in got:
        a = np.frombuffer(r["data"], "<f8").reshape(-1, work[1])
        out.setdefault(r["c"], np.zeros(work))[r["band"] * rows : r["band"] * rows + len(a)] = a
    return out


def low_percentile(found: DataFrame, n: int, work: tuple[int, int], flats: dict[int, np.ndarray], p: float = 0.01, step: int = 4, fine: int = 16) -> dict[int, float]:
    """channel -> percentile p, to a whole number, of n planes over their flatfield at every step-th pixel; from counts of values to 1 / fine, summed map-side."""
    shared = found.sparkSession.sparkContext.broadcast(flats)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for c, _, _, plane in zip(*(x.to_pylist() for x in b.columns), strict=True):
                v = np.frombuffer(plane, "<f8").reshape(work)[::step, ::step] / (shared.value[c][::step, ::step] + 1e-6)
                k, m = np.unique(np.rint(v * fine).astype(np.int64), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k), c, np.int32)), pa.array(k), pa.array(m)], names=["c", "v", "n"])

    got: dict[int, list] = {}
    for r in found.mapInArrow(count, "c int, v long, n long").groupBy("c", "v").agg(F.sum("n").alias("n")).toLocalIterator():  # a row per value of 16 bits and its sixteenths
        got.setdefault(r["c"], []).append((r["v"], r["n"]))
    out = {}
    pixels = -(-work[0] // step) * -(-work[1] // step)
    for c, rows in got.items():
        v, m = np.array(sorted([*rows, (0, n * pixels - sum(k for _, k in rows))])).reshape(-1, 2).T
        out[c] = float(np.round(_percentile(v, m, p) / fine))
    return out


def overlap_images(parts: DataFrame, sides: DataFrame, depth: int, project: bool = True) -> DataFrame:
    """(i, j, side, z, y, x, nz, ny, nx, data): parts of both sides of each pair's overlap, in the overlap's coordinates; project: largest values over z.

    sides (i, j, side, tile_id, y0, y1, x0, x1) as for `overlap_sums`.
    """
    of: dict[int, list[tuple]] = {}
    for r in sides.collect():  # a few rows a tile
        of.setdefault(r["tile_id"], []).append((r["i"], r["j"], r["side"], r["y0"], r["y1"], r["x0"], r["x1"]))

    def one(r: dict, a: np.ndarray) -> list[tuple]:
        out = []
        for i, j, side, y0, y1, x0, x1 in of.get(r["tile_id"], ()):
            lo, hi, le, ri = max(y0, r["y0"]), min(y1, r["y0"] + r["ny"]), max(x0, r["x0"]), min(x1, r["x0"] + r["nx"])
            if lo < hi and le < ri:
                p = a[:, lo - r["y0"] : hi - r["y0"], le - r["x0"] : ri - r["x0"]]
                p, z = (p.max(axis=0, keepdims=True), 0) if project else (p, r["z0"])
                out.append((i, j, side, z, lo - y0, le - x0, *p.shape, p.astype("<u2").tobytes()))
        return out

    return _mapped(parts, one, "i int, j int, side int, z int, y int, x int, nz int, ny int, nx int, data binary")


def pair_shifts(images: DataFrame, sides: DataFrame, depth: int = 1, upsample: int = 1) -> DataFrame:
    """(i, j, dz, dy, dx, quality) of `overlap_images`: how far side 2 has to move to lie on side 1, by phase correlation, to 1 / upsample of a voxel. A group is one pair's overlap."""
    from voxloom.kernels.phasecorr import shift_between

    box = sides.where("side = 1").select(F.col("i").alias("b_i"), F.col("j").alias("b_j"), (F.col("y1") - F.col("y0")).alias("h"), (F.col("x1") - F.col("x0")).alias("w"))
    t = images.join(box, (F.col("i") == F.col("b_i")) & (F.col("j") == F.col("b_j"))).drop("b_i", "b_j").repartition("i", "j").sortWithinPartitions("i", "j")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, pair = None, None

        def out() -> pa.RecordBatch:
            a, b = (x[0] if depth == 1 else x for x in pair)
            *d, q = shift_between(a, b, upsample)
            d = [0.0] * (3 - len(d)) + [float(x) for x in d]
            return pa.RecordBatch.from_arrays([*(pa.array([k], pa.int32()) for k in now), *(pa.array([x]) for x in d), pa.array([float(q)])], names=["i", "j", "dz", "dy", "dx", "quality"])

        for b in batches:
            for r in b.to_pylist():
                if (key := (r["i"], r["j"])) != now:
                    if now is not None:
                        yield out()
                    now, pair = key, np.zeros((2, depth, r["h"], r["w"]))
                at = tuple(slice(r[k], r[k] + r[f"n{k}"]) for k in "zyx")
                place = pair[r["side"] - 1][at]
                np.maximum(place, block(r), out=place)
        if now is not None:
            yield out()

    return t.mapInArrow(run, "i int, j int, dz double, dy double, dx double, quality double")


def pair_maps(images: DataFrame, sides: DataFrame, depth: dict[int, int], kind: str) -> DataFrame:
    """(i, j, m, quality) of `overlap_images`: the map of a kind from places in side 1 to places in side 2 (12 numbers, row by row) and how alike they then are. depth: planes of each tile's images. A group is one pair's overlap."""
    from voxloom.kernels.register import map_between

    boxes = {(r["i"], r["j"], r["side"]): (depth[r["tile_id"]], r["y1"] - r["y0"], r["x1"] - r["x0"]) for r in sides.collect()}  # two rows a pair
    schema = "i int, j int, m array<double>, quality double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, pair = None, None

        def out() -> pa.RecordBatch:
            m, q = map_between(*pair, kind)
            return pa.RecordBatch.from_arrays([*(pa.array([k], pa.int32()) for k in now), pa.array([m[:3].ravel().tolist()]), pa.array([q])], names=["i", "j", "m", "quality"])

        for b in batches:
            for r in b.to_pylist():
                if (key := (r["i"], r["j"])) != now:
                    if now is not None:
                        yield out()
                    now, pair = key, [np.zeros(boxes[(*key, side)], np.uint16) for side in (1, 2)]
                at = tuple(slice(r[k], r[k] + r[f"n{k}"]) for k in "zyx")
                place = pair[r["side"] - 1][at]
                np.maximum(place, block(r), out=place)
        if now is not None:
            yield out()

    return images.repartition("i", "j").sortWithinPartitions("i", "j").mapInArrow(run, schema)


def box_mask(spark: SparkSession, boxes: list[dict[str, tuple[int, int]]], size: tuple[int, int, int], shape: dict[str, int]) -> DataFrame:
    """Label chunks: 1 inside any of the boxes (half-open, z y x), which are few. Only chunks that meet a box are made, each in its task."""
    cells = sorted({(z, y, x) for b in boxes for z in _span(b["z"], size[0]) for y in _span(b["y"], size[1]) for x in _span(b["x"], size[2])})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cell in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                o = [k * s for k, s in zip(cell, size, strict=True)]
                dims = [min(s, shape[a] - i) for s, a, i in zip(size, "zyx", o, strict=True)]
                m = np.zeros(dims, "<u2")
                for b in boxes:
                    m[tuple(slice(max(0, b[a][0] - i), max(0, b[a][1] - i)) for a, i in zip("zyx", o, strict=True))] = 1
                if m.any():
                    yield _rows([("image", 0, 0, *cell, *o, *dims, m.tobytes())])

    return spark.createDataFrame(cells, "cz int, cy int, cx int").mapInArrow(run, CHUNKS)


def _span(ends: tuple[int, int], size: int) -> range:
    return range(ends[0] // size, -(-ends[1] // size))


def plane_medians(chunks: DataFrame, shape: dict[str, int], channels: int) -> DataFrame:
    """(c, z, raw): median over x of the medians over y, plus 1, of every plane of a low level; a task holds one plane. A plane that is not stored has 1."""

    def cut_planes(r: dict, a: np.ndarray) -> list[tuple]:
        return [(r["c"], r["z0"] + k, r["y0"], r["x0"], r["ny"], r["nx"], p.tobytes()) for k, p in enumerate(a) if p.any()]

    keys = ["c", "z"]
    flat = _mapped(chunks, cut_planes, "c int, z int, y0 int, x0 int, ny int, nx int, data binary").repartition(*keys).sortWithinPartitions(*keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, None
        out = lambda: pa.RecordBatch.from_arrays([pa.array([now[0]], pa.int32()), pa.array([now[1]], pa.int32()), pa.array([float(np.median(np.median(held, axis=0)) + 1)])], names=["c", "z", "raw"])
        for b in batches:
            for r in b.to_pylist():
                if (key := (r["c"], r["z"])) != now:
                    if now is not None:
                        yield out()
                    now, held = key, np.zeros((shape["y"], shape["x"]))
                held[r["y0"] : r["y0"] + r["ny"], r["x0"] : r["x0"] + r["nx"]] = np.frombuffer(r["data"], "<u2").reshape(r["ny"], r["nx"])
        if now is not None:
            yield out()

    every = chunks.sparkSession.range(channels * shape["z"]).selectExpr(f"CAST(id DIV {shape['z']} AS INT) AS c", f"CAST(id % {shape['z']} AS INT) AS z")
    return every.join(flat.mapInArrow(run, "c int, z int, raw double"), keys, "left").fillna(1.0, ["raw"])


def profile_arrays(profile: DataFrame, height: int, width: int, value: str = "flat") -> dict[int, np.ndarray]:
    """channel -> array of a profile table (c, y, x, value), which has one tile's pixels a channel."""
    t = profile.select("c", "y", "x", value).toArrow()
    c, y, x, v = (t.column(k).to_numpy() for k in range(4))
    out = {int(k): np.ones((height, width)) for k in np.unique(c)}
    for k, a in out.items():
        at = c == k
        a[y[at], x[at]] = v[at]
    return out
