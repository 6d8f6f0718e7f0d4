"""Placing and fusing tiles: pair registration, global shifts, weighted fusion."""

from __future__ import annotations


import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.functions.numeric import truncated
from voxloom.kernels import graph
from voxloom.kernels.phasecorr import shift_between


def placed(tile_voxels: DataFrame, shifts: DataFrame) -> DataFrame:
    """Tile voxels at mosaic coordinates; shifts (tile_id, sz, sy, sx) has a row per tile and is broadcast."""
    j = tile_voxels.join(F.broadcast(shifts), "tile_id")
    return j.select("tile_id", "c", *[(F.col(a) + F.col(f"s{a}")).cast("int").alias(a) for a in "zyx"], F.col("y").alias("ty"), F.col("x").alias("tx"), "v")


def fused_mean(voxels: DataFrame, height: int | None = None, width: int | None = None) -> DataFrame:
    """Mean of all tiles that cover a voxel. With the tiles' size, each weighs by its distance from its tile's edge (linear blending). Summed map-side."""
    w = F.lit(1) if height is None else F.least(F.col("ty") + 1, height - F.col("ty")) * F.least(F.col("tx") + 1, width - F.col("tx"))
    g = voxels.select("c", "z", "y", "x", (F.col("v").cast("long") * w).alias("wv"), w.cast("long").alias("w")).groupBy("c", "z", "y", "x")
    return g.agg((F.sum("wv") / F.sum("w")).alias("m")).select("c", "z", "y", "x", truncated(F.col("m")).alias("v"))


def fused_max(voxels: DataFrame) -> DataFrame:
    return voxels.groupBy("c", "z", "y", "x").agg(F.max("v").alias("v"))


def pair_shifts(tile_images: DataFrame, pairs: DataFrame, height: int, width: int) -> DataFrame:
    """(i, j, dy, dx, quality): the shift that best lays tile j on tile i, by phase correlation of their overlap.

    tile_images (tile_id, y, x, v) are projections at a low level: a pair's two
    overlaps are one small group. pairs: (i, j, oy, ox).
    """
    left = tile_images.join(pairs, F.col("tile_id") == F.col("i")).where((F.col("y") >= height - F.col("oy")) & (F.col("x") >= width - F.col("ox"))).select("i", "j", "oy", "ox", F.lit(0).alias("side"), (F.col("y") - height + F.col("oy")).alias("y"), (F.col("x") - width + F.col("ox")).alias("x"), "v")
    right = tile_images.join(pairs, F.col("tile_id") == F.col("j")).where((F.col("y") < F.col("oy")) & (F.col("x") < F.col("ox"))).select("i", "j", "oy", "ox", F.lit(1).alias("side"), "y", "x", "v")

    def one(g: pd.DataFrame) -> pd.DataFrame:
        h, w = int(g["oy"].iloc[0]), int(g["ox"].iloc[0])
        a, b = np.zeros((h, w)), np.zeros((h, w))
        for side, m in ((0, a), (1, b)):
            p = g[g["side"] == side]
            m[p["y"], p["x"]] = p["v"]
        dy, dx, q = shift_between(a, b)
        return pd.DataFrame({"i": [g["i"].iloc[0]], "j": [g["j"].iloc[0]], "dy": [dy], "dx": [dx], "quality": [q]})

    return left.union(right).groupBy("i", "j").applyInPandas(one, "i int, j int, dy int, dx int, quality double")


def resolve_shifts(edges: list[tuple[int, int, tuple[float, ...], float]], tiles: list[int], axes: int = 3, most: float = float("inf")) -> dict[int, tuple[float, ...]]:
    """Shift of each tile from pair shifts (i, j, shift, weight): sparse weighted least squares, the first tile of each connected group fixed at 0; pairs that miss it by more than `most` are left out, worst first."""
    if not edges:
        return dict.fromkeys(tiles, (0.0,) * axes)
    at = {t: k for k, t in enumerate(tiles)}
    i, j = (np.array([at[e[k]] for e in edges]) for k in (0, 1))
    x, _ = graph.robust(len(tiles), i, j, np.array([e[2] for e in edges], float), np.maximum([e[3] for e in edges], 1e-6), most)
    return {t: tuple((x[k] + 0.0).tolist()) for t, k in at.items()}


def resolve_maps(edges: list[tuple[int, int, np.ndarray, np.ndarray, float]], first: dict[int, np.ndarray], kind: str, most: float = float("inf")) -> dict[int, np.ndarray]:
    """A map of a kind for each tile from pairs (i, j, points in i, the same points in j, weight); `first` are the maps to start from, and the first tile of each connected group keeps its own."""
    tiles = list(first)
    if not edges:
        return dict(first)
    at = {t: k for k, t in enumerate(tiles)}
    i, j = (np.array([at[e[k]] for e in edges]) for k in (0, 1))
    maps, _ = graph.resolved_maps(len(tiles), i, j, np.array([e[2] for e in edges]), np.array([e[3] for e in edges]), np.maximum([e[4] for e in edges], 1e-6), kind, np.array([first[t] for t in tiles]), most)
    return {t: maps[k] for t, k in at.items()}


def lifted(affine: np.ndarray) -> np.ndarray:
    """A 2-d affine (y, x; homogeneous or 2 by 3), as found on projections along z, as a 3-d one (z, y, x) that leaves z alone."""
    out = np.eye(4)
    out[1:3, 1:] = np.asarray(affine, float)[:2]
    return out


def physical(affine: np.ndarray, scale: tuple[float, ...]) -> np.ndarray:
    """An affine over voxels as one over lengths, for voxels of these sides."""
    s = np.diag([*scale, 1.0])
    return s @ affine @ np.linalg.inv(s)


def affine_fused(tile_voxels: DataFrame, affine: dict[int, np.ndarray], shape: tuple[int, int], tile: tuple[int, int], block: int = 256) -> DataFrame:
    """(c, z, y, x, v): plane-wise fusion under a 2-d affine per tile (output = A @ (y, x, 1)), linear interpolation, mean where tiles overlap.

    Output is made in blocks; each voxel goes to the blocks it can touch, and
    a block is one bounded group. Tiles are of size `tile` (height, width); voxels
    that are not there are zeros.
    """
    maps = {t: np.vstack([a, [0, 0, 1]]) for t, a in affine.items()}
    rows = [(t, *map(float, a.ravel())) for t, a in affine.items()]
    m = tile_voxels.sparkSession.createDataFrame(rows, "tile_id int, a double, b double, c0 double, d double, e double, f0 double")
    v = tile_voxels.join(F.broadcast(m), "tile_id").withColumn("oy", F.expr("a * y + b * x + c0")).withColumn("ox", F.expr("d * y + e * x + f0"))
    reach = 1 + max(float(np.abs(a[:, :2]).sum(axis=1).max()) for a in affine.values())  # an output voxel uses input voxels this far away at most
    near = lambda o: F.sequence(F.floor((F.col(o) - reach) / block), F.floor((F.col(o) + reach) / block))
    v = v.withColumn("by", F.explode(near("oy"))).withColumn("bx", F.explode(near("ox")))

    def one(g: pd.DataFrame) -> pd.DataFrame:
        y0, x0 = int(g["by"].iloc[0]) * block, int(g["bx"].iloc[0]) * block
        h, w = min(block, shape[0] - y0), min(block, shape[1] - x0)
        if h <= 0 or w <= 0 or y0 < 0 or x0 < 0:
            return pd.DataFrame({"c": [], "z": [], "y": [], "x": [], "v": []})
        total, count = np.zeros((h, w)), np.zeros((h, w))
        gy, gx = np.mgrid[y0 : y0 + h, x0 : x0 + w]
        own = dict(list(g.groupby("tile_id")))
        for t in maps:  # a tile without a stored voxel here still covers what it covers
            img = np.zeros(tile)
            if t in own:
                img[own[t]["y"], own[t]["x"]] = own[t]["v"]
            inv = np.linalg.inv(maps[t])
            sy, sx = inv[0, 0] * gy + inv[0, 1] * gx + inv[0, 2], inv[1, 0] * gy + inv[1, 1] * gx + inv[1, 2]
            iy, ix = np.floor(sy + 1e-9).astype(int), np.floor(sx + 1e-9).astype(int)
            fy, fx = np.clip(sy - iy, 0, 1), np.clip(sx - ix, 0, 1)
            ok = (iy >= 0) & (ix >= 0) & (iy < img.shape[0]) & (ix < img.shape[1])
            iy, ix = np.where(ok, iy, 0), np.where(ok, ix, 0)
            jy, jx = np.minimum(iy + 1, img.shape[0] - 1), np.minimum(ix + 1, img.shape[1] - 1)
            val = (1 - fy) * ((1 - fx) * img[iy, ix] + fx * img[iy, jx]) + fy * ((1 - fx) * img[jy, ix] + fx * img[jy, jx])
            total[ok] += val[ok]
            count[ok] += 1
        yy, xx = np.nonzero(count)
        return pd.DataFrame({"c": g["c"].iloc[0], "z": g["z"].iloc[0], "y": (yy + y0).astype("int32"), "x": (xx + x0).astype("int32"), "v": np.clip(total[yy, xx] / count[yy, xx] + 1e-9, 0, 65535).astype("int32")})

    return v.groupBy("c", "z", "by", "bx").applyInPandas(one, "c int, z int, y int, x int, v int")


def channels_alike(views: DataFrame) -> DataFrame:
    """(view, channel) that some view has and this one lacks; empty when views can be fused. views: (view, channel)."""
    want = views.select("view").distinct().join(F.broadcast(views.select("channel").distinct()), F.lit(True))
    return want.join(views, ["view", "channel"], "left_anti")
