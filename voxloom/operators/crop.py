"""Crop boxes: snapping to tiles, whole blocks, tile tables of the crop, masks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from voxloom.functions.numeric import shrunk_interval


def ordered_ends(crops: DataFrame) -> DataFrame:
    """Crops (roi, <axis>_start, <axis>_end) with each pair of ends in order."""
    for a in "zyx":
        s, e = F.least(f"{a}_start", f"{a}_end"), F.greatest(f"{a}_start", f"{a}_end")
        crops = crops.select(*[F.col(c) for c in crops.columns if c not in (f"{a}_start", f"{a}_end")], s.alias(f"{a}_start"), e.alias(f"{a}_end"))
    return crops


def snapped_to_tiles(crops: DataFrame, tiles: DataFrame) -> DataFrame:
    """Crop ends moved to the next tile edge inside where what is cut of a tile is less than the tiles' overlap: its length less step_y (step_x) where that is given, else less the first step between original places.

    The tile table is small (stage positions); it is broadcast against the crops.
    """
    crops = ordered_ends(crops)
    for a in "yx":
        length, step = F.col(f"len_{a}_um"), F.col(f"step_{a}") if f"step_{a}" in tiles.columns else F.lit(None)
        t = tiles.select(F.col(f"{a}_um").alias("t"), length.alias("len"), step.cast("double").alias("step"), *([f"{a}_orig_um"] if f"{a}_orig_um" in tiles.columns else []))
        if f"{a}_orig_um" in tiles.columns:  # tiles of a row (column) are as far apart as its first two
            places = tiles.select(F.array_sort(F.collect_set(f"{a}_orig_um")).alias("p")).select((F.try_element_at("p", F.lit(2)) - F.col("p")[0]).alias("second"))
            t = t.join(F.broadcast(places), F.lit(True)).withColumn("step", F.coalesce("step", "second"))  # one row
        starts = t.select("t", "len", (F.col("len") - F.coalesce("step", "len")).alias("lap")).distinct()
        j = crops.join(F.broadcast(starts), F.lit(True))
        keep = crops.columns
        s = F.min(F.when((F.col("t") > F.col(f"{a}_start")) & (F.col("t") - F.col(f"{a}_start") < F.col("lap")), F.col("t")))
        e = F.max(F.when((F.col("t") + F.col("len") < F.col(f"{a}_end")) & (F.col(f"{a}_end") - F.col("t") - F.col("len") < F.col("lap")), F.col("t") + F.col("len")))
        crops = j.groupBy(*keep).agg(s.alias("s"), e.alias("e")).select(*[c for c in keep if c not in (f"{a}_start", f"{a}_end")], F.coalesce("s", F.col(f"{a}_start")).alias(f"{a}_start"), F.coalesce("e", F.col(f"{a}_end")).alias(f"{a}_end"))
    return crops


def whole_blocks(boxes: DataFrame, axes: str = "yx", power: int = 3, compat: bool = False) -> DataFrame:
    """Pixel boxes (<axis>0, <axis>1) shrunk evenly to multiples of 2 ** power."""
    for a in axes:
        s, e = shrunk_interval(F.col(f"{a}0"), F.col(f"{a}1"), power, compat)
        boxes = boxes.withColumn("s_", s).withColumn("e_", e).drop(f"{a}0", f"{a}1").withColumnsRenamed({"s_": f"{a}0", "e_": f"{a}1"})
    return boxes


def rebased_tiles(tiles: DataFrame, crop: dict[str, tuple[float, float]]) -> DataFrame:
    """Tiles of a crop (axis -> start, end in um): the tile that holds the crop's start begins there, tiles inside stay, origin moves to the crop, lengths run to the next tile or the crop's end; original places move along."""
    t = tiles
    for a in "yx":
        s, e = crop[a]
        t = t.where((F.col(f"{a}_um") + F.col(f"len_{a}_um") > s) & (F.col(f"{a}_um") < e))
        t = t.withColumn(f"n_{a}", F.greatest(F.col(f"{a}_um"), F.lit(float(s))))
    out = t
    for a in "yx":
        s, e = crop[a]
        w = Window.orderBy(f"n_{a}")
        steps = out.select(f"n_{a}").distinct().withColumn(f"next_{a}", F.coalesce(F.lead(f"n_{a}").over(w), F.lit(float(e))))  # a row per tile row or column
        out = out.join(F.broadcast(steps), f"n_{a}")
    cols = [F.col("tile_id")]
    for a in "yx":
        s, _ = crop[a]
        cols += [(F.col(f"n_{a}") - s).alias(f"{a}_um"), (F.col(f"next_{a}") - F.col(f"n_{a}")).alias(f"len_{a}_um"), (F.col(f"{a}_orig_um") + F.col(f"n_{a}") - F.col(f"{a}_um") - s).alias(f"{a}_orig_um")]
    return out.select(*cols)


def roi_mask(grid: DataFrame, rois: DataFrame) -> DataFrame:
    """(z, y, x, v): 1 in the box of any region (z0, z1, y0, y1, x0, x1), else 0. Regions are few and broadcast; a voxel needs to meet one only."""
    hit = F.expr("z >= z0 AND z < z1 AND y >= y0 AND y < y1 AND x >= x0 AND x < x1")
    inside = grid.join(F.broadcast(rois), hit, "left_semi").withColumn("v", F.lit(1))
    return grid.join(inside, ["z", "y", "x"], "left").select("z", "y", "x", F.coalesce("v", F.lit(0)).alias("v"))


def unique_name(taken: list[str], stem: str = "roi", digits: int = 2) -> str:
    """stem_NN with the least number that is not taken."""
    k = 0
    while f"{stem}_{k:0{digits}d}" in set(taken):
        k += 1
    return f"{stem}_{k:0{digits}d}"
