"""Gains between overlapping tiles and brightness along z."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.functions.numeric import gained_value
from voxloom.kernels import graph
from voxloom.operators.layout import overlap_pairs, overlap_sides

SIGMA, RADIUS = 15.0, 60


def overlap_stats(tile_voxels: DataFrame, tiles: DataFrame, pixel: float, channels: int | None = None) -> DataFrame:
    """(c, i, j, s1, n1, s2, n2, area): sums and counts of voxels above 0 in each pair's overlap, seen in either tile.

    tile_voxels: (tile_id, c, z, y, x, v), coordinates within the tile. The
    pair table is small and known to be (pairs of neighbours), so it is
    broadcast; voxels are summed map-side by (c, pair, side). Give the number of
    channels where it is known: else the voxels are scanned for it.
    """
    s = overlap_sides(tiles, pixel).withColumnRenamed("tile_id", "s_tile").withColumnsRenamed({c: f"s_{c}" for c in ("y0", "y1", "x0", "x1")})
    inside = (F.col("tile_id") == F.col("s_tile")) & F.expr("y >= s_y0 AND y < s_y1 AND x >= s_x0 AND x < s_x1")
    j = tile_voxels.where("v > 0").join(F.broadcast(s), inside)
    g = j.groupBy("c", "i", "j", "side").agg(F.sum(F.col("v").cast("long")).alias("s"), F.count("*").alias("n"))
    known = tile_voxels.select("c").distinct() if channels is None else tiles.sparkSession.range(channels).select(F.col("id").cast("int").alias("c"))
    return both_sides(g, tiles, pixel, known)


def both_sides(sums: DataFrame, tiles: DataFrame, pixel: float, channels: DataFrame) -> DataFrame:
    """(c, i, j, s1, n1, s2, n2, area), for every pair and channel (c), of sums (c, i, j, side, s, n)."""
    pick = lambda c, k: F.coalesce(F.max(F.when(F.col("side") == k, F.col(c))), F.lit(0)).alias(f"{c}{k}")
    g = sums.groupBy("c", "i", "j").agg(pick("s", 1), pick("n", 1), pick("s", 2), pick("n", 2))
    every = channels.join(overlap_pairs(tiles, pixel).select("i", "j", (F.col("oy") * F.col("ox")).alias("area")), F.lit(True))
    return every.join(g, ["c", "i", "j"], "left").fillna(0, ["s1", "n1", "s2", "n2"])


def gain_edges(stats: DataFrame, planes: int, least: float = 0.1) -> DataFrame:
    """(c, i, j, gain): mean of the second over mean of the first; 1 where a side has too few voxels above 0 or no mean."""
    m1, m2 = F.col("s1") / F.greatest(F.col("n1"), F.lit(1)), F.col("s2") / F.greatest(F.col("n2"), F.lit(1))
    few = F.least("n1", "n2") < F.col("area") * planes * least
    return stats.select("c", "i", "j", F.when(few | (m1 <= 0), F.lit(1.0)).otherwise(m2 / F.greatest(m1, F.lit(1e-12))).alias("gain"))


def solve_gains(edges: list[tuple[int, int, float]], tiles: list[int]) -> dict[int, float]:
    """Multiplier of each tile: least squares of log g_i - log g_j - log gain_ij, largest 1 in every connected group.

    Linear in the logarithms, so solved over the edges alone; a tile without neighbours has 1.
    """
    at = {t: k for k, t in enumerate(tiles)}
    if not edges:
        return dict.fromkeys(tiles, 1.0)
    i, j = (np.array([at[e[k]] for e in edges]) for k in (0, 1))
    g = graph.solved(len(tiles), i, j, -np.log([[e[2]] for e in edges]), np.ones(len(edges)))[:, 0]
    group = graph.components(len(tiles), i, j)
    peak = np.full(len(tiles), -np.inf)
    np.maximum.at(peak, group, g)
    return {t: float(np.exp(g[k] - peak[group[k]])) for t, k in at.items()}


def gains(edges: DataFrame, tiles: DataFrame) -> DataFrame:
    """(c, tile_id, gain). Edges between neighbouring tiles are few and go to the driver."""
    ids = sorted(r[0] for r in tiles.select("tile_id").collect())
    by_c: dict[int, list] = {}
    for r in edges.orderBy("c", "i", "j").collect():
        by_c.setdefault(r["c"], []).append((r["i"], r["j"], r["gain"]))
    rows = [(c, t, g) for c, e in by_c.items() for t, g in solve_gains(e, ids).items()]
    return edges.sparkSession.createDataFrame(rows, "c int, tile_id int, gain double")


def z_profile(lowest: DataFrame) -> DataFrame:
    """(c, z, raw): median over x of the medians over y, plus 1."""
    m = lowest.groupBy("c", "z", "x").agg(F.median("v").alias("m"))
    return m.groupBy("c", "z").agg((F.median("m") + 1).alias("raw"))


def gaussian(sigma: float, radius: int) -> list[float]:
    w = [math.exp(-0.5 * (k / sigma) ** 2) for k in range(-radius, radius + 1)]
    return [x / sum(w) for x in w]


def smoothed_profile(raw: DataFrame, sigma: float = SIGMA, radius: int = RADIUS) -> DataFrame:
    """(c, z, profile): the Gaussian-smoothed profile over the raw one, edges repeated. Offsets meet planes in an equality join."""
    ends = raw.groupBy("c").agg(F.max("z").alias("zmax"))
    w = raw.sparkSession.createDataFrame([(k - radius, x) for k, x in enumerate(gaussian(sigma, radius))], "k int, w double")
    at = F.greatest(F.lit(0), F.least(F.col("zmax"), F.col("z") + F.col("k")))
    need = raw.join(F.broadcast(ends), "c").join(F.broadcast(w), F.lit(True)).select("c", "z", "raw", at.alias("from_z"), "w")
    other = raw.select("c", F.col("z").alias("from_z"), F.col("raw").alias("other"))
    s = need.join(other, ["c", "from_z"]).groupBy("c", "z", "raw").agg(F.sum(F.col("w") * F.col("other")).alias("s"))
    return s.select("c", "z", (F.col("s") / F.col("raw")).alias("profile"))


def apply_illumination(tile_voxels: DataFrame, gain: DataFrame, profile: DataFrame | None = None) -> DataFrame:
    """Voxels times their tile's gain and their plane's profile. Gains and profiles have a row per tile or plane and channel and are broadcast."""
    j = tile_voxels.join(F.broadcast(gain), ["c", "tile_id"], "left")
    p = F.lit(1.0)
    if profile is not None:
        j, p = j.join(F.broadcast(profile), ["c", "z"], "left"), F.coalesce("profile", F.lit(1.0))
    return j.withColumn("v", gained_value(F.col("v"), F.coalesce("gain", F.lit(1.0)), p)).select(*tile_voxels.columns)
