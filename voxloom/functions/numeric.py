"""Scalar functions with the rounding and clipping that image arithmetic needs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from voxloom.schemas import U16_MAX


def truncated(c: Column, low: float = 0, high: float = U16_MAX) -> Column:
    """c clipped to [low, high] and cut to a whole number, as a cast to an unsigned type cuts it."""
    return F.floor(F.least(F.lit(high), F.greatest(F.lit(low), c))).cast("int")


def half_even(c: Column) -> Column:
    """Nearest whole number, halves to the even one."""
    return F.bround(c, 0)


def soft_threshold(c: Column, t: Column | float) -> Column:
    """sign(c) * max(|c| - t, 0)."""
    return F.signum(c) * F.greatest(F.abs(c) - t, F.lit(0.0))


def flatfield_value(v: Column, flat: Column, dark: Column | float = 0.0, baseline: Column | float = 0.0) -> Column:
    """(v - dark) / (flat + 1e-6) less the baseline, 0 where not above it, clipped and cut to 16 bits."""
    q = (v - dark) / (flat + F.lit(1e-6))
    return truncated(F.when(q > baseline, q - baseline).otherwise(F.lit(0.0)))


def gained_value(v: Column, gain: Column, profile: Column | float = 1.0) -> Column:
    """v times a tile's gain and a plane's profile, clipped and cut to 16 bits."""
    return truncated(v * gain * profile)


def shrunk_interval(start: Column, end: Column, power: int, compat: bool = False) -> tuple[Column, Column]:
    """The interval cut evenly at both ends to a length that is a multiple of 2 ** power (compat: cut by 2 ** power less the remainder instead)."""
    m = F.pmod(end - start, F.lit(1 << power))
    cut = F.when(m == 0, F.lit(0)).otherwise(F.lit(1 << power) - m) if compat else m
    low = F.floor(cut / 2).cast("int")
    return start + low, end - (cut - low)
