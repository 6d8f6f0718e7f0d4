"""Display limits from exact percentiles of a low level."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LOW, HIGH = 0.001, 0.999


def contrast(lowest: DataFrame, segment: bool = False) -> DataFrame:
    """(c, start, end) from every second voxel along each axis of the lowest level; segment: of those above the channel's median. 0 and 65535 where there are none.

    Percentiles are exact: their state is a count per distinct value (65,536 at
    most), summed map-side.
    """
    s = lowest.where("z % 2 = 0 AND y % 2 = 0 AND x % 2 = 0")
    channels = lowest.groupBy("c").agg(F.lit(0).alias("k"))
    if segment:
        m = s.groupBy("c").agg(F.percentile("v", F.lit(0.5)).alias("m"))
        s = s.join(F.broadcast(m), "c").where("v > m")  # a row per channel
    q = s.groupBy("c").agg(F.percentile("v", F.lit(LOW)).alias("lo"), F.percentile("v", F.lit(HIGH)).alias("hi"))
    j = channels.join(q, "c", "left")
    return j.select("c", F.coalesce(F.floor("lo"), F.lit(0)).cast("int").alias("start"), F.coalesce(F.floor("hi"), F.lit(65535)).cast("int").alias("end"))


def window_of(limits: DataFrame) -> DataFrame:
    """limits with the display window's min and max: max is ten times the end, 65535 at most."""
    return limits.select("c", F.lit(0).alias("min"), F.least(F.col("end") * 10, F.lit(65535)).alias("max"), "start", "end")
