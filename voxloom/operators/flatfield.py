"""Flatfield profiles, baselines and their application."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from voxloom.functions.numeric import flatfield_value, half_even
from voxloom.operators.illumination import gaussian


def sampled_planes(tile_planes: DataFrame, total: int, seed: int = 1) -> DataFrame:
    """(tile_id, z) of about total planes: ceil(total / tiles) per tile by seeded arithmetic hash order, total at most."""
    n = tile_planes.select("tile_id").distinct().count()
    h = (F.col("tile_id") * 7919 + F.col("z") * 104729 + seed) * F.lit(2654435761).cast("long") % F.lit(2147483647)
    t = tile_planes.withColumn("h", h)
    t = t.withColumn("k", F.row_number().over(Window.partitionBy("tile_id").orderBy("h", "z"))).where(F.col("k") <= -(-total // max(n, 1)))
    return t.orderBy("k", "tile_id").limit(total).select("tile_id", "z")


def bottom_top_planes(tile_planes: DataFrame, planes: int, bottom: int, top: int) -> DataFrame:
    """The first `bottom` and last `top` planes of every tile."""
    return tile_planes.where((F.col("z") < bottom) | (F.col("z") >= planes - top))


def median_profile(planes: DataFrame) -> DataFrame:
    """(c, y, x, m): median over the planes given."""
    return planes.groupBy("c", "y", "x").agg(F.median("v").alias("m"))


def smoothed_2d(image: DataFrame, value: str, height: int, width: int, sigma: float = 1.0, radius: int = 4) -> DataFrame:
    """image (c, y, x, value) smoothed along y, then x; past an edge the image is mirrored, the edge pixel counting twice.

    Each pass sends a pixel to the 2 * radius + 1 places that use it and sums there, so it is one shuffle and no join.
    """
    w = gaussian(sigma, radius)
    weights = F.array(*[F.struct(F.lit(k - radius).alias("k"), F.lit(x).alias("w")) for k, x in enumerate(w)])
    for axis, size in (("y", height), ("x", width)):
        other = "x" if axis == "y" else "y"
        # the place p uses index reflect(p + k); so an index i serves p = i - k and its mirror images
        s = image.select("c", "y", "x", value, F.explode(weights).alias("o"))
        to = F.array(F.col(axis) - F.col("o.k"), -F.col(axis) - 1 - F.col("o.k"), F.lit(2 * size - 1) - F.col(axis) - F.col("o.k"))
        s = s.select("c", F.col(other), F.explode(to).alias(axis), (F.col(value) * F.col("o.w")).alias("p")).where((F.col(axis) >= 0) & (F.col(axis) < size))
        image = s.groupBy("c", "y", "x").agg(F.sum("p").alias(value))
    return image


def normalised(profile: DataFrame, value: str = "m") -> DataFrame:
    """The profile over its channel's mean."""
    mean = profile.groupBy("c").agg(F.avg(value).alias("mean"))
    return profile.join(F.broadcast(mean), "c").select("c", "y", "x", (F.col(value) / F.col("mean")).alias("flat"))  # a row per channel


def baseline(voxels: DataFrame, profile: DataFrame) -> DataFrame:
    """(c, baseline): whole percentile 1 of the corrected values at every fourth pixel along y and x."""
    s = voxels.where("y % 4 = 0 AND x % 4 = 0").join(profile, ["c", "y", "x"])
    return s.groupBy("c").agg(half_even(F.percentile(F.col("v") / (F.col("flat") + F.lit(1e-6)), F.lit(0.01))).alias("baseline"))


def apply_flatfield(tile_voxels: DataFrame, profile: DataFrame, base: DataFrame | None = None) -> DataFrame:
    """Voxels corrected by the profile at their place in the tile; profile (c, y, x, flat[, dark]). Profiles have one tile's pixels and are joined on them."""
    j = tile_voxels.join(profile, ["c", "y", "x"])
    b = F.lit(0.0)
    if base is not None:
        j, b = j.join(F.broadcast(base), "c"), F.col("baseline")
    dark = F.col("dark") if "dark" in profile.columns else F.lit(0.0)
    return j.withColumn("v", flatfield_value(F.col("v"), F.col("flat"), dark, b)).select(*tile_voxels.columns)


def otsu_threshold(image: DataFrame) -> DataFrame:
    """(threshold): the least grey value that splits the histogram with the greatest variance between classes.

    The histogram has 65,536 rows at most, so its running sums are one small window.
    """
    h = image.groupBy("v").agg(F.count("*").alias("n"))
    w = Window.orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    all_ = Window.partitionBy()
    h = h.select("v", F.sum("n").over(w).alias("n0"), F.sum(F.col("n") * F.col("v")).over(w).alias("s0"), F.sum("n").over(all_).alias("n"), F.sum(F.col("n") * F.col("v")).over(all_).alias("s"))
    m0, m1 = F.col("s0") / F.col("n0"), (F.col("s") - F.col("s0")) / (F.col("n") - F.col("n0"))
    h = h.where("n0 < n").select("v", F.round(F.col("n0") * (F.col("n") - F.col("n0")) * (m0 - m1) * (m0 - m1), 2).alias("b"))
    top = h.agg(F.max(F.struct("b", (-F.col("v")).alias("v"))).alias("t"))
    return top.select((-F.col("t.v")).alias("threshold"))
