"""Boxes, strides, regions of interest and projections of voxel tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.functions.numeric import half_even

#: (axis, start, end) of a half-open box.
Box = dict[str, tuple[int, int]]


def box_slice(voxels: DataFrame, box: Box) -> DataFrame:
    """Voxels in the half-open box; plain comparisons, so they reach the scan."""
    for axis, (a, b) in box.items():
        voxels = voxels.where((F.col(axis) >= a) & (F.col(axis) < b))
    return voxels


def chunk_slice(chunks: DataFrame, box: Box) -> DataFrame:
    """Chunks that meet the box, by their stored corners: row groups outside it are skipped."""
    for axis, (a, b) in box.items():
        if axis == "c":
            chunks = chunks.where((F.col("c") >= a) & (F.col("c") < b))
        else:
            chunks = chunks.where((F.col(f"{axis}0") < b) & (F.col(f"{axis}0") + F.col(f"n{axis}") > a))
    return chunks


def stride_sample(voxels: DataFrame, steps: dict[str, int], origin: dict[str, int] | None = None) -> DataFrame:
    """Every steps[axis]-th voxel from the origin on."""
    for axis, s in steps.items():
        voxels = voxels.where(F.pmod(F.col(axis) - (origin or {}).get(axis, 0), F.lit(s)) == 0)
    return voxels


def roi_to_pixels(tiles: DataFrame, pixel: dict[str, float]) -> DataFrame:
    """(tile_id, z0, z1, y0, y1, x0, x1): boxes in whole pixels, halves to even; a negative start is an error."""
    cols = ["tile_id"]
    for a in "zyx":
        start, length = F.col(f"{a}_um"), F.col(f"len_{a}_um")
        first = half_even(start / pixel[a]).cast("int")
        cols += [F.when(first < 0, F.raise_error(F.lit(f"negative start on axis {a}"))).otherwise(first).cast("int").alias(f"{a}0"), half_even((start + length) / pixel[a]).cast("int").alias(f"{a}1")]
    return tiles.select(*cols)


def with_tile(voxels: DataFrame, boxes: DataFrame, side: tuple[int, int]) -> DataFrame:
    """voxels joined with each box (y0, y1, x0, x1) that holds them.

    An equality join on buckets of `side` pixels: a box is repeated for the
    buckets it meets, a voxel has one bucket, so no nested loop is needed.
    """
    sy, sx = side
    b = boxes.select("*", F.explode(F.sequence(F.floor(F.col("y0") / sy), F.floor((F.col("y1") - 1) / sy))).alias("by")).select("*", F.explode(F.sequence(F.floor(F.col("x0") / sx), F.floor((F.col("x1") - 1) / sx))).alias("bx"))
    v = voxels.withColumn("by", F.floor(F.col("y") / sy)).withColumn("bx", F.floor(F.col("x") / sx))
    return v.join(b, ["by", "bx"]).where("y >= y0 AND y < y1 AND x >= x0 AND x < x1").drop("by", "bx")


def zmax_projection(voxels: DataFrame) -> DataFrame:
    return voxels.groupBy("c", "y", "x").agg(F.max("v").alias("v"))


def tile_views(voxels: DataFrame, boxes: DataFrame, side: tuple[int, int], least: int = 5) -> DataFrame:
    """(tile_id, c, z, y, x, v) with coordinates from each tile's corner; tiles with a side below `least` pixels are left out."""
    big = boxes.where((F.col("y1") - F.col("y0") >= least) & (F.col("x1") - F.col("x0") >= least))
    t = with_tile(voxels, big, side)
    return t.select("tile_id", "c", "z", (F.col("y") - F.col("y0")).alias("y"), (F.col("x") - F.col("x0")).alias("x"), "v")
