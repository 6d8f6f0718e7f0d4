"""Scans of metadata text, file lists, regions and settings; all through Spark's own readers."""

from __future__ import annotations

import json
import re
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom.functions.text import channel_of, tile_of, view_of
from voxloom.operators.metadata import acquisition_table

#: Fixed value: the place of a tile's number in the name of its metadata file.
TILE_NAME = re.compile(r"_s(\d+)-t\d+_meta\.txt$")
EXTENSIONS = {"h5": ["h5"], "tif": ["tif", "tiff"], "tiff": ["tif", "tiff"], "raw": ["raw"]}


def raw_files(spark: SparkSession, folder: str, pattern: str = "", extension: str = "h5") -> list[str]:
    """Paths of image files by name pattern; one at least, and one at most for h5."""
    if extension not in EXTENSIONS:
        raise ValueError(f"extension must be one of {sorted(EXTENSIONS)}")
    found: set[str] = set()
    for e in EXTENSIONS[extension]:
        f = spark.read.format("binaryFile").option("pathGlobFilter", f"*{pattern}*.{e}").option("recursiveFileLookup", "false").load(folder)
        found |= {r[0] for r in f.select("path").collect()}  # only names are read
    if not found:
        raise FileNotFoundError(f"no *{pattern}*.{extension} in {folder}")
    if extension == "h5" and len(found) > 1:
        raise FileNotFoundError(f"more than one h5 file in {folder}")
    return sorted(found)


def metadata_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(path, line_no, line) of text files, each read whole."""
    t = spark.read.text(paths, wholetext=True).select(F.input_file_name().alias("path"), "value")
    return t.select("path", F.posexplode(F.split("value", "\r?\n")).alias("line_no", "line"))


def read_metadata(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Typed table of all blocks of the files, files in name order."""
    return acquisition_table(metadata_lines(spark, paths))


def image_metadata(spark: SparkSession, folder: str, files: list[str], extension: str) -> DataFrame:
    """The metadata table of image files: of the one file named after them, else of all that are, in name order; h5 tiles in the order of their numbers, without gaps."""
    stem = Path(files[0]).stem.split("_Mag")[0]
    ends = EXTENSIONS[extension]
    names = sorted(r[0] for r in spark.read.format("binaryFile").option("pathGlobFilter", "*_meta.txt").load(folder).select("path").collect())  # only names are read
    base = lambda p: p.rpartition("/")[2]
    one = [p for p in names if base(p).startswith(stem) and any(base(p).endswith(f".{e}_meta.txt") for e in ends)]
    if len(one) == 1:
        return read_metadata(spark, one)
    some = [p for p in names if base(p).startswith(stem) and any(e in base(p)[len(stem) :] for e in ends)] or names
    if not some:
        raise FileNotFoundError(f"no metadata of {stem} in {folder}")
    if extension != "h5":
        return read_metadata(spark, some)
    at = {int(m[1]): p for p in some if (m := TILE_NAME.search(base(p)))}
    if gaps := tile_index_gaps([base(p) for p in some]):
        raise FileNotFoundError(f"no metadata of tiles {gaps}")
    if not at:
        raise FileNotFoundError(f"no metadata of {stem} in {folder}")
    order = spark.createDataFrame([(f"{k:09d}", p) for k, p in at.items()], "place string, o_path string")
    plain = lambda c: F.regexp_replace(c, "^file:/+", "/")
    lines = metadata_lines(spark, list(at.values()))
    j = lines.join(F.broadcast(order), plain(F.col("path")) == plain(F.col("o_path")))  # a row per tile
    return acquisition_table(j.select(F.col("place").alias("path"), "line_no", "line"))


def tile_index_gaps(names: list[str]) -> list[int]:
    """Tile numbers of `..._s<k>-t<n>_meta.txt` names that are missing from 0 on."""
    at = {int(m[1]) for n in names if (m := TILE_NAME.search(n))}
    return [k for k in range(max(at, default=-1) + 1) if k not in at]


def per_tile_stores(spark: SparkSession, folder: str, stores: list[str] | None = None) -> DataFrame:
    """Metadata of per-tile stores with tile, file channel and view from their names, a row per block.

    Names and metadata have to agree on the channel; with the names of the
    stores that are there, as many files as stores have to be.
    """
    t = acquisition_table(metadata_lines(spark, f"{folder}/*.ome.zarr_meta.txt"), with_path=True)
    t = t.where(F.col("path").rlike(r"Tile\d+_Ch\d+_")).select("*", tile_of(F.col("path")).alias("tile_id"), channel_of(F.col("path")).alias("file_channel"), view_of(F.col("path")).alias("view"))
    laser = F.regexp_extract("channel", r"(\d+)", 1).cast("int")
    found = t.agg(F.count_distinct("path"), F.count_if(laser != F.col("file_channel"))).first()
    if not found[0]:
        raise FileNotFoundError(f"no metadata of tile stores in {folder}")
    if found[1]:
        raise ValueError(f"{found[1]} stores whose name and metadata disagree on the channel")
    if stores is not None and found[0] != len(stores):
        raise ValueError(f"metadata of {found[0]} stores, but {len(stores)} stores")
    return t


def crop_table(spark: SparkSession, path: str) -> DataFrame:
    """Regions of interest from CSV: roi and start and end in um along z, y and x."""
    return spark.read.csv(path, header=True, schema="roi string, z_start double, z_end double, y_start double, y_end double, x_start double, x_end double")


def find_crop_table(image: str, name: str) -> str:
    """Where a region file is: beside the image, in it, or the only one of that name below its folder."""
    p = Path(image)
    for x in (p.parent / name, p / name):
        if x.exists():
            return str(x)
    found = sorted(p.parent.rglob(name))
    if len(found) != 1:
        raise FileNotFoundError(f"{len(found)} files named {name} below {p.parent}")
    return str(found[0])


def channel_settings(spark: SparkSession, path: str) -> DataFrame:
    """(wavelength, label, laser_wavelength, color) from a JSON map."""
    text = spark.read.text(path, wholetext=True)
    kind = "map<string,struct<label:string,laser_wavelength:string,color:string>>"
    m = text.select(F.from_json("value", kind).alias("m"))
    return m.select(F.explode("m").alias("wavelength", "s")).select("wavelength", "s.label", "s.laser_wavelength", "s.color")


def checked_settings(text: str) -> dict:
    """A channel settings map; every entry needs label, laser_wavelength and color as strings."""
    m = json.loads(text)
    for k, v in m.items():
        if not isinstance(v, dict):
            raise ValueError(f"channel {k} must be a map")
        bad = [f for f in ("label", "laser_wavelength", "color") if not isinstance(v.get(f), str)]
        if bad:
            raise ValueError(f"channel {k}: {', '.join(bad)} must be a string")
    return m
