"""Resolution pyramids: block means, label maxima, plans and structure."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F



def _weight(axis: str, size: int, factor: int):
    """1, and for the last index of an axis that the factor does not divide, 1 more for each copy that pads it."""
    pad = -size % factor
    return F.when(F.col(axis) == size - 1, F.lit(1 + pad)).otherwise(F.lit(1))


def coarsened(voxels: DataFrame, shape: dict[str, int], factor: dict[str, int]) -> DataFrame:
    """Block means, cut to whole numbers; edges are repeated to whole blocks. One shuffle, summed map-side, whole numbers until the last division."""
    w = F.lit(1)
    for a, f in factor.items():
        w = w * _weight(a, shape[a], f)
    at = [F.floor(F.col(a) / factor[a]).cast("int").alias(a) if factor.get(a, 1) > 1 else F.col(a) for a in "zyx"]
    g = voxels.select("c", *at, (F.col("v").cast("long") * w).alias("wv"), w.cast("long").alias("w")).groupBy("c", "z", "y", "x")
    return g.agg(F.floor(F.sum("wv") / F.sum("w")).cast("int").alias("v"))


def next_shape(shape: dict[str, int], factor: dict[str, int]) -> dict[str, int]:
    return {a: -(-n // factor.get(a, 1)) for a, n in shape.items()}


def pyramid(voxels: DataFrame, shape: dict[str, int], factors: list[dict[str, int]]) -> list[tuple[DataFrame, dict[str, int]]]:
    """Every level from the one before: [(level 0, shape), ...]. Store a level before the next is built when levels are large."""
    out = [(voxels, shape)]
    for f in factors:
        voxels, shape = coarsened(voxels, shape, f), next_shape(shape, f)
        out.append((voxels, shape))
    return out


def pyramid_plan(spark: SparkSession, shape: dict[str, int], scale: dict[str, float], levels: int | None = None, most_bytes: int = 1 << 30, channels: int = 1) -> DataFrame:
    """(level, scale_z, scale_y, scale_x, factor_z, factor_yx, nz, ny, nx); the factors lead from this level to the next.

    y and x halve at each level, z too while it is finer than y. Without
    `levels`, levels are added until one has at most most_bytes over all channels at 2 bytes a voxel.
    """
    rows, level, s, sc = [], 0, dict(shape), dict(scale)
    while True:
        fz = 2 if sc["z"] < sc["y"] and s["z"] > 1 else 1
        last = level + 1 >= levels if levels else 2 * channels * math.prod(s.values()) <= most_bytes
        rows.append((level, sc["z"], sc["y"], sc["x"], 1 if last else fz, 1 if last else 2, s["z"], s["y"], s["x"]))
        if last:
            break
        f = {"z": fz, "y": 2, "x": 2}
        s, sc, level = next_shape(s, f), {a: sc[a] * f[a] for a in "zyx"}, level + 1
    return spark.createDataFrame(rows, "level int, scale_z double, scale_y double, scale_x double, factor_z int, factor_yx int, nz int, ny int, nx int")


def structure(levels: DataFrame) -> DataFrame:
    """(level, factor_z, factor_yx) from scales alone: floor(next scale / scale), 1 at the last level."""
    from pyspark.sql.window import Window

    w = Window.orderBy("level")  # a row per level
    f = lambda a: F.coalesce(F.floor(F.lead(f"scale_{a}").over(w) / F.col(f"scale_{a}")), F.lit(1)).cast("int")
    return levels.select("level", f("z").alias("factor_z"), f("y").alias("factor_yx"))


def label_downscale(labels: DataFrame, factor: dict[str, int]) -> DataFrame:
    at = [F.floor(F.col(a) / factor.get(a, 1)).cast("int").alias(a) for a in "zyx"]
    return labels.groupBy(*at).agg(F.max("v").alias("v"))


def label_upscale(labels: DataFrame, factor: dict[str, int], shape: dict[str, int]) -> DataFrame:
    """Every voxel repeated factor times along each axis; cut or edge-padded to `shape`."""
    out = labels
    for a in "zyx":
        f = factor.get(a, 1)
        size = F.lit(shape[a])
        top = labels.agg(F.max(a)).first()[0] or 0
        last = F.when(F.col(a) == top, F.greatest(F.col(a) * f + f - 1, size - 1)).otherwise(F.col(a) * f + f - 1)
        out = out.withColumn(a, F.explode(F.sequence(F.col(a) * f, F.least(last, size - 1))))
    return out

