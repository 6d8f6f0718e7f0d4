"""String functions of the metadata grammar and of file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def cleaned(line: Column) -> Column:
    """A metadata line in lower case without brackets and units."""
    c = F.lower(F.trim(line))
    c = F.regexp_replace(c, r"[\[\]\n\r]", "")
    return F.regexp_replace(F.regexp_replace(c, r" \(%\)", ""), " in um", "")


def key_of(line: Column) -> Column:
    return F.replace(F.element_at(F.split(line, " "), 1), F.lit(":"), F.lit(""))


def value_of(line: Column) -> Column:
    """Second word of a line, or null."""
    return F.try_element_at(F.split(line, " "), F.lit(2))


def rest_of(line: Column) -> Column:
    """All words after the first."""
    return F.regexp_extract(line, r"^\S+ (.*)$", 1)


def common_name(name: Column) -> Column:
    """A view's or channel's name without the suffix that numbers it (_sh1, _ch2, _view3, _a)."""
    return F.regexp_replace(F.regexp_replace(name, r"(_?(sh|ch|view)_?)?\d+$", ""), r"_[a-zA-Z]$", "")


def tile_of(path: Column) -> Column:
    return F.regexp_extract(path, r"Tile(\d+)_", 1).cast("int")


def channel_of(path: Column) -> Column:
    return F.regexp_extract(path, r"_Ch(\d+)_", 1).cast("int")


def view_of(path: Column) -> Column:
    """Number after _sh, 0 where there is none."""
    return F.coalesce(F.nullif(F.regexp_extract(path, r"_sh(\d)", 1), F.lit("")).cast("int"), F.lit(0))


def under_any(path: Column, prefixes: list[str]) -> Column:
    """Whether the path is one of the prefixes or below one."""
    p = F.regexp_replace(path, r"^/+|/+$", "")
    hit = F.lit(False)
    for x in (q.strip("/") for q in prefixes):
        hit = hit | (p == x) | F.startswith(p, F.lit(x + "/")) | F.lit(x == "")
    return hit
