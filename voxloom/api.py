"""The tasks of the engine: ingest, prepare, correct, crop, stitch, fuse, restructure, archive.

An image is a folder with `chunks` (see `operators.storage`), `tiles`, `pyramid`
and `meta` tables. Every task writes a new image or new levels and returns the
image's folder; sources are only removed after everything is written.
"""

from __future__ import annotations

import json
import shutil
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom.functions.text import common_name
from voxloom.kernels.basic import BasicParams, fit_basic
from voxloom.kernels.graph import KINDS
from voxloom.kernels.transforms import gaussian_2d, resampled_profile
from voxloom.operators import blocks, crop, flatfield, fuse, illumination, layout, metadata, pyramid, slicing, storage, warp
from voxloom.settings import find as find_settings
from voxloom.sources import arrays, metafiles, planes
from voxloom.sources.files import Store

VERSION = "0.1"


@dataclass(frozen=True)
class Channel:
    """A channel chosen by wavelength or by label, not both."""

    wavelength_id: str | None = None
    label: str | None = None

    def __post_init__(self):
        if (self.wavelength_id is None) == (self.label is None):
            raise ValueError("give either wavelength_id or label")


@dataclass(frozen=True)
class Size:
    """Lengths along z, y, x."""

    z: int
    y: int
    x: int

    def __post_init__(self):
        if min(self.z, self.y, self.x) < 1:
            raise ValueError("lengths must be positive")

    def as_dict(self) -> dict[str, int]:
        return {"z": self.z, "y": self.y, "x": self.x}


@dataclass
class Profiles:
    """Illumination of a channel: flatfield, darkfield and baseline."""

    flat: np.ndarray
    dark: np.ndarray | None = None
    baseline: float = 0.0

    def save(self, path: str) -> None:
        arrays = {"flatfield": self.flat, "baseline": np.array(self.baseline)}
        if self.dark is not None:
            arrays["darkfield"] = self.dark
        np.savez(path, **arrays)

    @classmethod
    def load(cls, path: str) -> Profiles:
        with np.load(path) as f:
            if "flatfield" not in f:
                raise ValueError(f"{path} has no flatfield")
            return cls(f["flatfield"], f["darkfield"] if "darkfield" in f else None, float(f["baseline"]) if "baseline" in f else 0.0)

    def resampled(self, shape: tuple[int, int]) -> Profiles:
        if self.flat.shape == shape:
            return self
        return Profiles(resampled_profile(self.flat, shape), None if self.dark is None else resampled_profile(self.dark, shape), self.baseline)


@dataclass
class Image:
    """An image folder."""

    spark: SparkSession
    path: str
    attrs: dict = field(default_factory=dict)

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> Image:
        store = Store(spark)
        store.settle(f"{path}/chunks")
        img = cls(spark, path, store.read(f"{path}/attrs.json"))
        img.settle_levels()
        return img

    @property
    def store(self) -> Store:
        return Store(self.spark)

    def save_attrs(self) -> None:
        self.store.folder(self.path)
        self.store.write(f"{self.path}/attrs.json", self.attrs)

    @property
    def shape(self) -> dict[str, int]:
        return self.attrs["shape"]

    @property
    def chunk(self) -> tuple[int, int, int]:
        return tuple(self.attrs["chunk"])

    @property
    def levels(self) -> list[dict]:
        return self.attrs["levels"]

    def chunks(self, level: int | None = None) -> DataFrame:
        """Chunks of a level, or of all; a virtual mosaic's are put together from its tiles' as they are read."""
        if "manifest" in self.attrs:
            if level is None:
                return reduce(DataFrame.unionByName, (self.chunks(s["level"]) for s in self.levels))
            return self._mosaic(level)
        c = storage.read_chunks(self.spark, f"{self.path}/chunks")
        return c if level is None else c.where(F.col("level") == level)

    def _mosaic(self, level: int) -> DataFrame:
        m = self.attrs["manifest"]
        have = min(level, len(m["levels"]) - 1)
        s, t = self.levels[have], m["levels"][have]
        n = len(m["tiles"][0]["paths"])
        of = [storage.read_tiles(self.spark, {x["tile_id"]: x["paths"][k] for x in m["tiles"]}, have) for k in range(n)]
        parts = reduce(DataFrame.unionByName, (p.withColumn("c", F.lit(k)) for k, p in enumerate(of))) if n > 1 else of[0]
        places = {x["tile_id"]: (0, x["row"] * t["ny"], x["col"] * t["nx"]) for x in m["tiles"]}
        shape = {a: s[f"n{a}"] for a in "zyx"}
        if t["ny"] % self.chunk[1] == t["nx"] % self.chunk[2] == 0 and self.attrs["manifest"].get("chunk") == list(self.chunk):
            c = layout.moved_chunks(parts, places, self.chunk).withColumn("image", F.lit("image"))
        else:
            c = blocks.fused(parts, places, dict.fromkeys(places, (t["nz"], t["ny"], t["nx"])), self.chunk, shape, "max")
        c = c.withColumn("level", F.lit(have))
        plan = pyramid.pyramid_plan(self.spark, shape, {a: s[f"scale_{a}"] for a in "zyx"}, level - have + 1).orderBy("level").collect()
        for p in plan[:-1]:  # levels that no tile has
            c = blocks.coarsened(c, self.chunk, {a: p[f"n{a}"] for a in "zyx"}, {"z": p["factor_z"], "y": p["factor_yx"], "x": p["factor_yx"]})
        return c

    def voxels(self, level: int = 0, zeros: bool = False) -> DataFrame:
        return storage.to_voxels(self.chunks(level), zeros).select("c", "z", "y", "x", "v")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}")

    def tiles(self) -> DataFrame:
        return self.table("tiles")

    def boxes(self, level: int = 0) -> DataFrame:
        """(tile_id, y0, y1, x0, x1) of the tiles in a level's pixels."""
        scale = {"z": 1.0, "y": self.levels[level]["scale_y"], "x": self.levels[level]["scale_x"]} if level else self.attrs["scale"]
        return slicing.roi_to_pixels(self.tiles(), scale).drop("z0", "z1")

    def sample(self, level: int, **box: tuple[int, int]) -> DataFrame:
        """Voxels of a box (axis=(start, end)) with physical coordinates z_um, y_um, x_um; only chunks that meet the box are read."""
        s = self.levels[level]
        v = slicing.box_slice(storage.to_voxels(slicing.chunk_slice(self.chunks(level), box)).select("c", "z", "y", "x", "v"), box)
        return v.select("*", *[(F.col(a) * s[f"scale_{a}"]).alias(f"{a}_um") for a in "zyx"])

    def write_level(self, chunks: DataFrame, level: int) -> None:
        """Store a level in the place of what was there of it, channels that are all zeros now included. What was there goes when the new level is whole."""
        new = f"{self.path}/chunks.level"
        self.store.delete(new)
        storage.write_chunks(chunks.withColumn("image", F.lit("image")).withColumn("level", F.lit(level)), new)
        made, to, old = f"{new}/image=image/level={level}", f"{self.path}/chunks/image=image/level={level}", f"{self.path}/chunks.replaced/level={level}"
        self.store.folder(made)  # a level of zeros has no files
        self.store.folder(f"{self.path}/chunks/image=image")
        self.store.folder(f"{self.path}/chunks.replaced")
        self.store.delete(old)
        if self.store.exists(to):
            self.store.move(to, old)
        self.store.move(made, to)
        self.settle_levels()
        self.store.delete(new)

    def settle_levels(self) -> None:
        """Drop levels that new ones have replaced; put one back whose new one did not come."""
        replaced = f"{self.path}/chunks.replaced"
        for name in self.store.names(replaced):
            if not self.store.exists(to := f"{self.path}/chunks/image=image/{name}"):
                self.store.move(f"{replaced}/{name}", to)
        self.store.delete(replaced)

    def drop_levels(self, count: int) -> None:
        """Delete levels from `count` on."""
        for image in self.store.names(f"{self.path}/chunks"):
            for name in self.store.names(f"{self.path}/chunks/{image}") if image.startswith("image=") else []:
                if name.startswith("level=") and int(name[6:]) >= count:
                    self.store.delete(f"{self.path}/chunks/{image}/{name}")

    def build(self, levels: int | None = None, start: int = 1) -> None:
        """Pyramid from level start - 1 on, a level at a time from the one before, display limits and attributes; deeper levels go."""
        plan = [r.asDict() for r in pyramid.pyramid_plan(self.spark, self.shape, self.attrs["scale"], levels, channels=len(self.attrs["channels"])).orderBy("level").collect()]
        self.attrs["levels"] = plan
        for k in range(start, len(plan)):
            p = plan[k - 1]
            up = {"z": p["factor_z"], "y": p["factor_yx"], "x": p["factor_yx"]}
            self.write_level(blocks.coarsened(self.chunks(k - 1), self.chunk, {"z": p["nz"], "y": p["ny"], "x": p["nx"]}, up), k)
        self.drop_levels(len(plan))
        top = plan[-1]
        limits = blocks.contrast(self.chunks(len(plan) - 1), {"z": top["nz"], "y": top["ny"], "x": top["nx"]}, len(self.attrs["channels"]), segment=True)
        for c, (start_, end) in limits.items():
            self.attrs["channels"][c]["window"] = {"min": 0, "max": min(65535, 10 * end), "start": start_, "end": end}
        self.save_attrs()

    def ngff(self) -> dict:
        """The image's metadata in the layout of multiscale image attributes: axes, a scale (and a place, where it is known) per level, channels with display windows."""
        move = [{"type": "translation", "translation": [0.0, *self.attrs["translation"]]}] if "translation" in self.attrs else []
        sets = [{"path": str(s["level"]), "coordinateTransformations": [{"type": "scale", "scale": [1.0, s["scale_z"], s["scale_y"], s["scale_x"]]}, *move]} for s in self.levels]
        axes = [{"name": "c", "type": "channel"}, *({"name": a, "type": "space", "unit": "micrometer"} for a in "zyx")]
        channels = [{"active": True, "index": k, **c} for k, c in enumerate(self.attrs["channels"])]
        return {"multiscales": [{"name": self.attrs.get("name", self.path.rstrip("/").rpartition("/")[2]), "axes": axes, "datasets": sets}], "omero": {"channels": channels}, "tasks": self.attrs.get("tasks", {}), **({"acquisition_metadata": self.attrs["acquisition_metadata"]} if "acquisition_metadata" in self.attrs else {})}

    def record(self, task: str, parameters: dict) -> None:
        self.attrs.setdefault("tasks", {})[task] = {"version": VERSION, "parameters": {k: str(v) for k, v in parameters.items()}}
        self.save_attrs()

    def channel(self, which: Channel) -> int:
        for k, c in enumerate(self.attrs["channels"]):
            if which.label == c["label"]:
                return k
        for k, c in enumerate(self.attrs["channels"]):
            if which.wavelength_id is not None and c["wavelength_id"] == which.wavelength_id or which.label is not None and which.label.lower() in c["label"].lower():
                return k
        raise ValueError(f"no channel {which}")

    def like(self, path: str, **changes) -> Image:
        new = Image(self.spark, path, json.loads(json.dumps({k: v for k, v in self.attrs.items() if k != "manifest"})) | changes)
        new.save_attrs()
        return new


TILE_TABLE = "tile_id int, x_um double, y_um double, z_um double, x_orig_um double, y_orig_um double, len_x_um double, len_y_um double, len_z_um double"


def _one_tile(spark: SparkSession, shape: dict[str, int], scale: dict[str, float]) -> DataFrame:
    """A tile table with one tile, the whole image."""
    return spark.createDataFrame([(0, 0.0, 0.0, 0.0, 0.0, 0.0, *(shape[a] * scale[a] for a in "xyz"))], TILE_TABLE)


def _grid_tiles(cursor: DataFrame, positions: DataFrame, scale: dict[str, float], nz: int) -> DataFrame:
    """The tile table of a mosaic by its cursor."""
    size = [(F.col(f"{a}_n_pixels") * scale[a]).alias(f"len_{a}_um") for a in "xy"]
    origin = [(F.col(f"{a}_px") * scale[a]).alias(f"{a}_um") for a in "xy"]
    return cursor.join(positions, "tile_id").select("tile_id", *origin, F.lit(0.0).alias("z_um"), F.col("x_orig").cast("double").alias("x_orig_um"), F.col("y_orig").cast("double").alias("y_orig_um"), *size, F.lit(nz * scale["z"]).alias("len_z_um"))


def _acquisition(r) -> dict[str, str]:
    """How a channel was taken, by its first row of metadata."""
    laser = "".join(x for x in r["channel"] if x.isdigit()) or r["channel"]
    return {"label": r["label"], "excitation_wavelength": laser, "emission_wavelength": str(r["filter"]), "shutter": str(r["shutter"]), "zoom": str(r["zoom"]), "laser_intensity": str(r["intensity"])}


def _with_acquisition(new: Image, sources: list[Image]) -> None:
    """Give a new image what its sources know of how its channels were taken, one entry a label."""
    known = {c["label"]: c for i in reversed(sources) for c in i.attrs.get("acquisition_metadata", {}).get("channels", [])}
    if found := [known[c["label"]] for c in new.attrs["channels"] if c["label"] in known]:
        new.attrs["acquisition_metadata"] = {"channels": json.loads(json.dumps(found))}


def stacks_of(files: list[str], channels: list[str]) -> list[str]:
    """The file of each channel, by the channel's digits in the file's name; as many files as channels, else a ValueError."""
    if len(files) != len(channels):
        raise ValueError(f"{len(files)} image files for {len(channels)} rows of metadata")
    out = []
    for ch in channels:
        digits = "".join(x for x in ch if x.isdigit()) or ch
        named = [f for f in files if digits in Path(f).stem and f not in out]
        if not named:
            raise ValueError(f"no image file of channel {ch}")
        out.append(named[0])
    return out


def ingest(spark: SparkSession, folder: str, out: str, pattern: str = "", extension: str = "raw", settings: str | None = None, excluded: dict[str, list[int]] | None = None, chunk: Size = Size(64, 1024, 1024), levels: int | None = None, overwrite: bool = False, name: str | None = None) -> str:  # noqa: B008
    """Stacks and their metadata files to an image: one stack per channel (raw, tif), or all tiles of all channels in one file (h5).

    With a name, `out` is a group and the image is added to it as out/name;
    other images of the group are left alone. Only an image that is there
    already needs overwrite.
    """
    store, path = Store(spark), f"{out}/{name}" if name else out
    if store.exists(path):
        if not overwrite:
            raise FileExistsError(path)
        store.delete(path)
    planes.register(spark)
    files = metafiles.raw_files(spark, folder, pattern, extension)
    meta = metadata.require(metafiles.image_metadata(spark, folder, files, extension))
    known = {r[0]: r[1] for r in meta.groupBy("channel").count().collect()}
    for ch, at in (excluded or {}).items():
        if ch not in known or [k for k in at if not 0 <= k < known[ch]]:
            raise ValueError(f"excluded tiles {at} of channel {ch} are not in the metadata")
    meta = metadata.checked_pixels(metadata.flagged(meta, excluded or {}))
    if settings:
        meta = metadata.with_channel_settings(meta.withColumn("wave", F.regexp_extract("channel", r"(\d+)", 1)).withColumn("laser", F.col("channel")).withColumn("channel", F.col("wave")), metafiles.channel_settings(spark, settings if "://" in settings else str(find_settings(settings))).drop("laser_wavelength")).withColumn("channel", F.col("laser")).drop("wave", "laser")
    else:
        meta = meta.withColumn("label", F.col("channel")).withColumn("color", F.lit("FFFFFF"))
    rows = meta.orderBy("row").collect()  # a row per tile and channel
    first = rows[0]
    scale = {a: first[f"{a}_scale"] for a in "zyx"}
    shape = {a: first[f"{a}_n_pixels"] for a in "zyx"}
    names = list(dict.fromkeys(r["channel"] for r in rows))
    by = {r["channel"]: r for r in reversed(rows)}
    img = Image(spark, path, {"shape": shape, "scale": scale, "chunk": [chunk.z, chunk.y, chunk.x], "channels": [{"wavelength_id": n, "label": by[n]["label"], "color": by[n]["color"]} for n in names]})
    img.attrs["acquisition_metadata"] = {"channels": [_acquisition(by[n]) for n in names]}
    local = lambda f: f.removeprefix("file:")
    if extension == "h5":
        if not planes.h5_available():
            raise NotImplementedError("h5 stacks need h5py, which is not installed")
        kept = [(c, k, d, r) for (c, k, d), r in zip(planes.h5_layout(len(rows), len(names)), sorted(rows, key=lambda r: (names.index(r["channel"]), r["row"])), strict=True) if not r["ignore"]]
        order = {c: sorted((x for x in kept if x[0] == c), key=lambda x: (-x[3]["x_pos"], -x[3]["y_pos"])) for c in range(len(names))}
        positions = spark.createDataFrame([(k, x[3]["x_pos"], x[3]["y_pos"], x[3]["x_n_pixels"], x[3]["y_n_pixels"]) for k, x in enumerate(order[0])], "tile_id int, x_pos double, y_pos double, x_n_pixels int, y_n_pixels int")
        cursor, ext = layout.layout_cursor(positions), layout.mosaic_extent(positions).first()
        img.attrs["shape"] = {"z": shape["z"], "y": int(ext["ny"]), "x": int(ext["nx"])}
        sets = [[c, k, x[2]] for c in order for k, x in enumerate(order[c])]
        parts = spark.read.format("voxh5").option("path", local(files[0])).option("datasets", json.dumps(sets)).option("chunk_y", chunk.y).option("chunk_x", chunk.x).load()
        places = {r["tile_id"]: (0, r["y_px"], r["x_px"]) for r in cursor.collect()}
        chunks = blocks.fused(parts.withColumn("tile_id", F.col("image").cast("int")), places, dict.fromkeys(places, (shape["z"], shape["y"], shape["x"])), img.chunk, img.shape, "max")
        tile = _grid_tiles(cursor, positions, scale, shape["z"])
    else:
        rows = [r for r in rows if not r["ignore"]]
        kind, parts = {"raw": "voxraw", "tif": "voxtiff", "tiff": "voxtiff"}[extension], None
        for c, f in enumerate(stacks_of(files, [r["channel"] for r in rows])):
            s = spark.read.format(kind).option("path", local(f)).option("channel", c).option("nz", shape["z"]).option("ny", shape["y"]).option("nx", shape["x"]).option("chunk_y", chunk.y).option("chunk_x", chunk.x).load()
            parts = s if parts is None else parts.unionByName(s)
        chunks = storage.rechunked(parts.withColumn("image", F.lit("image")), img.chunk, shape)
        tile = _one_tile(spark, shape, scale)
    img.save_attrs()
    img.write_level(chunks, 0)
    tile.write.mode("overwrite").parquet(f"{path}/tiles")
    img.build(levels)
    img.record("ingest", {"folder": folder, "pattern": pattern, "extension": extension})
    if name:
        group = store.read(f"{out}/group.json") if store.exists(f"{out}/group.json") else {"images": []}
        store.write(f"{out}/group.json", {"images": [*(i for i in group["images"] if i != name), name]})
    return path


def images_of(spark: SparkSession, group: str) -> list[str]:
    """Names of a group's images, in the order they were added."""
    return Store(spark).read(f"{group}/group.json")["images"]


def sibling_images(spark: SparkSession, folder: str) -> dict[str, list[str]]:
    """Paths of the images in a folder by what their names have in common: views and channels of one object are siblings."""
    store = Store(spark)
    names = [n for n in store.names(folder) if store.exists(f"{folder}/{n}/attrs.json")]
    if not names:
        return {}
    t = spark.createDataFrame([(n,) for n in names], "name string").groupBy(common_name(F.col("name")).alias("common")).agg(F.sort_array(F.collect_list("name")).alias("names"))
    return {r["common"]: [f"{folder}/{n}" for n in r["names"]] for r in t.collect()}  # names of one folder


def from_chunks(spark: SparkSession, chunks: DataFrame, tiles: DataFrame, out: str, shape: dict[str, int], scale: dict[str, float], channels: list[dict], chunk: Size, levels: int | None = None) -> Image:
    """An image from level-0 chunks of the given size and a tile table."""
    img = Image(spark, out, {"shape": shape, "scale": scale, "chunk": [chunk.z, chunk.y, chunk.x], "channels": json.loads(json.dumps(channels))})
    img.save_attrs()
    img.write_level(chunks, 0)
    tiles.write.mode("overwrite").parquet(f"{out}/tiles")
    img.build(levels)
    return img


def from_voxels(spark: SparkSession, voxels: DataFrame, tiles: DataFrame, out: str, shape: dict[str, int], scale: dict[str, float], channels: list[dict], chunk: Size = Size(64, 256, 256), levels: int | None = None) -> Image:  # noqa: B008
    """An image from a voxel table (c, z, y, x, v) and a tile table."""
    return from_chunks(spark, storage.to_chunks(voxels, (chunk.z, chunk.y, chunk.x), shape), tiles, out, shape, scale, channels, chunk, levels)


def prepare_mosaic(spark: SparkSession, stores: dict[int, str | list[str]], positions: DataFrame, out: str) -> Image:
    """A virtual mosaic over per-tile images by their stage positions (tile_id, x_pos, y_pos, x_n_pixels, y_n_pixels): a manifest and a tile table, no voxels.

    A tile is one image with all channels, or a list of images with one channel
    each. Tiles go down columns first. Its levels are the tiles'; a deeper one
    is made of the deepest when it is read. The tiles' own images are told
    where they lie.
    """
    store = Store(spark)
    paths = {t: [p] if isinstance(p, str) else list(p) for t, p in sorted(stores.items())}
    images = {t: [Image.open(spark, p) for p in ps] for t, ps in paths.items()}
    one = next(iter(images.values()))[0]
    if len({len(ps) for ps in paths.values()}) != 1:
        raise ValueError("tiles have different numbers of channels")
    channels = [c for i in next(iter(images.values())) for c in i.attrs["channels"]]
    if any([c["label"] for i in x for c in i.attrs["channels"]] != [c["label"] for c in channels] for x in images.values()):
        raise ValueError("tiles have different channels")
    s, n_rows = one.attrs["scale"], positions.select("y_pos").distinct().count()
    if len(images) != n_rows * positions.select("x_pos").distinct().count():
        raise ValueError("the tiles do not fill a grid")
    n_cols = len(images) // n_rows
    grid = [{"tile_id": t, "paths": paths[t], "row": t % n_rows, "col": t // n_rows} for t in images]
    levels = [{**x, "ny": x["ny"] * n_rows, "nx": x["nx"] * n_cols} for x in one.levels]
    shape = {"z": one.shape["z"], "y": one.shape["y"] * n_rows, "x": one.shape["x"] * n_cols}
    img = Image(spark, out, {"shape": shape, "scale": s, "chunk": list(one.chunk), "channels": json.loads(json.dumps(channels)), "levels": levels, "manifest": {"tiles": grid, "levels": one.levels, "chunk": list(one.chunk) if all(i.chunk == one.chunk for x in images.values() for i in x) else None}})
    store.folder(out)
    _with_acquisition(img, next(iter(images.values())))
    img.save_attrs()
    _grid_tiles(layout.layout_cursor(positions), positions, s, shape["z"]).write.mode("overwrite").parquet(f"{out}/tiles")
    place = {r["tile_id"]: (r["y_um"], r["x_um"]) for r in img.tiles().select("tile_id", "y_um", "x_um").collect()}
    for t, x in images.items():
        for i in x:
            i.attrs["translation"] = [0.0, *place[t]]
            i.save_attrs()
    return img


def prepare_folder(spark: SparkSession, folder: str, stores: str, out: str) -> Image:
    """A virtual mosaic of the tile images in `stores`, named `<...>Tile<t>_Ch<c>_<...>`, by the metadata files of `folder` that are named after them (`<image>.ome.zarr_meta.txt`)."""
    names = Store(spark).names(stores)
    meta = metafiles.per_tile_stores(spark, folder, names).withColumn("name", F.regexp_extract("path", r"([^/]+)\.ome\.zarr_meta\.txt$", 1))
    rows = sorted(metadata.checked_pixels(metadata.require(meta)).collect(), key=lambda r: (r["tile_id"], r["file_channel"]))  # a row per tile and channel
    if missing := {r["name"] for r in rows} - set(names):
        raise FileNotFoundError(f"no images {sorted(missing)} in {stores}")
    of: dict[int, list[str]] = {}
    for r in rows:
        of.setdefault(r["tile_id"], []).append(f"{stores}/{r['name']}")
    first = {r["tile_id"]: (r["tile_id"], r["x_pos"], r["y_pos"], r["x_n_pixels"], r["y_n_pixels"]) for r in reversed(rows)}
    positions = spark.createDataFrame(sorted(first.values()), "tile_id int, x_pos double, y_pos double, x_n_pixels int, y_n_pixels int")
    return prepare_mosaic(spark, of, positions, out)


def _parts(img: Image, level: int = 0) -> DataFrame:
    return blocks.tile_parts(img.chunks(level), img.boxes(level))


def _near_overlaps(img: Image, sides: DataFrame, level: int = 0) -> DataFrame:
    """A level's chunks that overlaps of tiles (`layout.overlap_sides`) lie in."""
    b = img.boxes(level).select(F.col("tile_id").alias("b_tile"), F.col("y0").alias("b_y"), F.col("x0").alias("b_x"))
    rects = sides.join(b, F.col("tile_id") == F.col("b_tile")).select(*[(F.col(f"{a}{k}") + F.col(f"b_{a}")).alias(f"{a}{k}") for a in "yx" for k in "01"])
    return blocks.near(img.chunks(level), rects, img.chunk)


def _tile_size(img: Image, level: int = 0) -> tuple[int, int]:
    """(height, width) of the largest tile."""
    return tuple(img.boxes(level).agg(F.max(F.col("y1") - F.col("y0")), F.max(F.col("x1") - F.col("x0"))).first())


def _finish(img: Image, out: str, chunks: DataFrame, task: str, parameters: dict, erase: bool, levels: int | None = None) -> str:
    """A new image of img's kind with these level-0 chunks; the source only goes when all is written."""
    new = img.like(out)
    new.write_level(chunks, 0)
    img.tiles().write.mode("overwrite").parquet(f"{out}/tiles")
    new.build(levels or len(img.levels))
    new.record(task, parameters)
    if erase:
        img.store.delete(img.path)
    return out


def fit_profiles(img: Image, tiles: list[int] | None = None, z_levels: tuple[int, int] | None = None, n_planes: int = 200, params: BasicParams | None = None, empty_tiles: bool = False, level: int = 0) -> dict[int, Profiles]:
    """A profile per channel, fitted to sampled planes of a level, or their median where tiles are empty.

    Planes are put together and resized in the tasks; a channel's fit gets
    n_planes planes of the working size.
    """
    (h, w), nz = _tile_size(img, level), img.levels[level]["nz"]
    ids = tiles or [r[0] for r in (layout.corner_tiles(img.tiles()) if empty_tiles else img.tiles()).select("tile_id").collect()]
    known = {r[0] for r in img.tiles().select("tile_id").collect()}
    if set(ids) - known:
        raise ValueError(f"no tiles {sorted(set(ids) - known)}")
    every = img.tiles().where(F.col("tile_id").isin(ids)).select("tile_id", F.explode(F.sequence(F.lit(0), F.lit(nz - 1))).alias("z"))
    drawn = flatfield.sampled_planes(flatfield.bottom_top_planes(every, nz, *z_levels) if z_levels else every, n_planes)
    wanted = {tuple(r) for r in drawn.collect()}  # n_planes rows at most
    n = len(wanted)
    p = params or BasicParams()
    side = (p.working_size,) * 2 if isinstance(p.working_size, int) else p.working_size
    work = (h, w) if empty_tiles or side is None else (min(h, side[0]), min(w, side[1]))
    boxes, drawn_tiles = img.boxes(level), sorted({t for t, _ in wanted})
    some = blocks.near(img.chunks(level), boxes.where(F.col("tile_id").isin(drawn_tiles)), img.chunk, [z for _, z in wanted])
    found = blocks.planes(blocks.tile_parts(some, boxes), wanted, h, w, work)
    channels = range(len(img.attrs["channels"]))
    if empty_tiles:
        out = {}
        for c, m in blocks.plane_median(found, n, work).items():
            f = gaussian_2d(m)
            out[c] = f / f.mean() if f.mean() else np.ones(work)
        low = blocks.low_percentile(found, n, work, out)
        return {c: Profiles(out[c], None, low.get(c, 0.0)) if c in out else Profiles(np.ones(work)) for c in channels}

    def one(batches):
        import pyarrow as pa

        def fitted() -> pa.RecordBatch:
            stack = np.concatenate([np.stack(held), np.zeros((n - len(held), *work))])  # planes that are not stored are zeros
            f, d, _ = fit_basic(stack, p)
            return pa.RecordBatch.from_arrays([pa.array([c], pa.int32()), pa.array([f.astype("<f8").tobytes()]), pa.array([d.astype("<f8").tobytes() if p.dark else None], pa.binary())], names=["c", "flat", "dark"])

        c, held = None, []
        for b in batches:
            for k, _, _, plane in zip(*(x.to_pylist() for x in b.columns), strict=True):
                if c is not None and k != c:
                    yield fitted()
                    held = []
                c = k
                held.append(np.frombuffer(plane, "<f8").reshape(work))
        if held:
            yield fitted()

    fits = found.repartition("c").sortWithinPartitions("c", "tile_id", "z").mapInArrow(one, "c int, flat binary, dark binary").collect()  # a row per channel
    arr = lambda b: None if b is None else np.frombuffer(b, "<f8").reshape(work)
    out = {r["c"]: Profiles(arr(r["flat"]), arr(r["dark"])) for r in fits}
    return {c: out.get(c, Profiles(np.ones(work))) for c in channels}


def correct_flatfield(spark: SparkSession, path: str, out: str, tiles: list[int] | None = None, z_levels: tuple[int, int] | None = None, n_planes: int = 200, params: BasicParams | None = None, empty_tiles: bool = False, profiles: dict[int, Profiles] | None = None, save: str | None = None, levels: int | None = None, erase: bool = False, level: int = 0) -> str:
    """Correct every tile by a profile per channel: given, the median of empty tiles, or fitted to sampled planes of a level.

    `tiles` defaults to all for the fit and to the corners for empty tiles.
    """
    img = Image.open(spark, path)
    found = dict(profiles) if profiles else fit_profiles(img, tiles, z_levels, n_planes, params, empty_tiles, level)
    h, w = _tile_size(img)
    at = {c: p.resampled((h, w)) for c, p in found.items()}
    if save:
        Path(save).mkdir(parents=True, exist_ok=True)
        for c, p in at.items():
            p.save(f"{save}/{img.attrs['channels'][c]['wavelength_id']}.npz")
    chunks = blocks.apply_flatfield(img.chunks(0), img.boxes(), {c: (p.flat, p.dark, p.baseline) for c, p in at.items()})
    return _finish(img, out, chunks, "correct_flatfield", {"tiles": tiles, "n_planes": n_planes, "empty_tiles": empty_tiles, **changed_parameters(params or BasicParams(), BasicParams())}, erase, levels)


def correct_illumination(spark: SparkSession, path: str, out: str, z_correction: bool = False, erase: bool = False) -> str:
    """Equalise tiles by their overlaps and, if asked, planes by the smoothed z profile; statistics come from the full level's overlaps and the lowest level's planes."""
    img = Image.open(spark, path)
    n, pixel = len(img.attrs["channels"]), img.attrs["scale"]["y"]
    sides = layout.overlap_sides(img.tiles(), pixel)
    sums = blocks.overlap_sums(_near_overlaps(img, sides), img.boxes(), sides)
    stats = illumination.both_sides(sums, img.tiles(), pixel, spark.range(n).select(F.col("id").cast("int").alias("c")))
    gain = {(r["c"], r["tile_id"]): r["gain"] for r in illumination.gains(illumination.gain_edges(stats, img.shape["z"]), img.tiles()).collect()}  # a row per tile and channel
    profile = None
    if z_correction:
        low = img.levels[-1]
        raw = blocks.plane_medians(img.chunks(len(img.levels) - 1), {"z": low["nz"], "y": low["ny"], "x": low["nx"]}, n)
        f = img.shape["z"] / low["nz"]
        at = {(r["c"], r["z"]): r["profile"] for r in illumination.smoothed_profile(raw).collect()}  # a row per plane of the lowest level
        profile = {(c, z): at[c, int(z // f)] for c in range(n) for z in range(img.shape["z"])}
    return _finish(img, out, blocks.apply_illumination(img.chunks(0), img.boxes(), gain, profile), "correct_illumination", {"z_correction": z_correction}, erase)


def crop_regions(spark: SparkSession, path: str, regions: DataFrame, out: str, power: int = 0, levels: int | None = None) -> list[str]:
    """An image per region (roi, <axis>_start, <axis>_end in um): ends in order, snapped to tiles, in whole pixels, shrunk to multiples of 2 ** power."""
    img, made = Image.open(spark, path), []
    s = img.attrs["scale"]
    for r in crop.snapped_to_tiles(regions, img.tiles()).orderBy("roi").collect():  # a row per region asked for
        box = _pixels(r, s, img.shape, power)
        name = r["roi"] or crop.unique_name([Path(m).name for m in made])
        tiles = crop.rebased_tiles(img.tiles(), {a: (box[a][0] * s[a], box[a][1] * s[a]) for a in "yx"})
        tiles = tiles.withColumn("z_um", F.lit(0.0)).withColumn("len_z_um", F.lit((box["z"][1] - box["z"][0]) * s["z"]))
        new = from_chunks(spark, blocks.cropped(img.chunks(0), box, img.chunk), tiles, f"{out}/{name}", {a: box[a][1] - box[a][0] for a in "zyx"}, s, img.attrs["channels"], Size(*img.chunk), levels)
        new.attrs["crop"] = {a: list(box[a]) for a in "zyx"}
        _with_acquisition(new, [img])
        new.record("crop_regions", {"roi": name})
        made.append(new.path)
    return made


def _pixels(r, scale: dict[str, float], shape: dict[str, int], power: int = 0) -> dict[str, tuple[int, int]]:
    """A region's box in whole pixels."""
    box = {}
    for a in "zyx":
        lo, hi = sorted((round(r[f"{a}_start"] / scale[a]), round(r[f"{a}_end"] / scale[a])))
        lo, hi = max(0, lo), min(shape[a], hi)
        extra = (hi - lo) % (1 << power) if a != "z" else 0
        box[a] = (lo + extra // 2, hi - (extra - extra // 2))
    return box


def mask_regions(spark: SparkSession, path: str, regions: DataFrame, name: str = "regions", power: int = 0) -> str:
    """Store the regions (as for `crop_regions`) as a label image of the image: 1 inside any, 0 outside, with a level for each of the image's by block maxima. Its path is returned."""
    img = Image.open(spark, path)
    rows = crop.ordered_ends(regions).collect()  # a row per region asked for
    if not rows:
        raise ValueError("no regions")
    boxes = [_pixels(r, img.attrs["scale"], img.shape, power) for r in rows]
    return write_label(img, name, blocks.box_mask(spark, boxes, img.chunk, img.shape))


def write_label(img: Image, name: str, chunks: DataFrame, color: tuple[int, int, int, int] = (255, 0, 0, 128)) -> str:
    """Store level-0 label chunks (c = 0) below labels/<name> of the image, with the image's levels by block maxima and its own metadata."""
    at = f"{img.path}/labels/{name}"
    if img.store.exists(at):
        raise FileExistsError(at)
    label = Image(img.spark, at, {"shape": img.shape, "scale": img.attrs["scale"], "chunk": list(img.chunk), "channels": [], "levels": img.levels, "label": {"name": name, "colors": [{"value": 1, "rgba": list(color)}], "source": {"image": "../../"}}})
    label.save_attrs()
    label.write_level(chunks, 0)
    for k in range(1, len(img.levels)):
        p = img.levels[k - 1]
        up = {"z": p["factor_z"], "y": p["factor_yx"], "x": p["factor_yx"]}
        label.write_level(blocks.coarsened(label.chunks(k - 1), img.chunk, {"z": p["nz"], "y": p["ny"], "x": p["nx"]}, up, how="max"), k)
    labels = f"{img.path}/labels/labels.json"
    img.store.write(labels, {"labels": [*(img.store.read(labels)["labels"] if img.store.exists(labels) else []), name]})
    return at


PRUNING = (None, "axis_aligned", "alternating", "shortest_paths", "large_overlaps")


def pruned(tiles: DataFrame, pixel: float, how: str | None) -> list[tuple[int, int]]:
    """Pairs of neighbouring tiles that are registered."""
    if how not in PRUNING:
        raise ValueError(f"pruning must be one of {[k for k in PRUNING if k]}")
    pairs = layout.overlap_pairs(tiles, pixel)
    if how == "axis_aligned":
        return [tuple(r) for r in layout.axis_aligned(pairs, tiles).collect()]
    if how == "alternating":
        return [tuple(r) for r in layout.without_every_other(pairs, tiles, pixel).collect()]
    rows = sorted(tuple(r) for r in pairs.collect())  # pairs of neighbours
    return layout.shortest_paths(rows) if how == "shortest_paths" else layout.large_overlaps(rows) if how else [r[:2] for r in rows]


def register_tiles(img: Image, c: int, pruning: str | None = None, level: int = 0, least_quality: float = 0.0, on_projection: bool = True, upsample: int = 1, most: float = float("inf")) -> dict[int, tuple[float, float, float]]:
    """Shift (z, y, x) of every tile from its original place, in full-resolution voxels, by phase correlation of neighbours' overlaps at a level."""
    spark, s = img.spark, img.levels[level]
    ids = sorted(r[0] for r in img.tiles().select("tile_id").collect())
    pairs = pruned(img.tiles(), img.attrs["scale"]["y"], pruning)
    if not pairs:
        return dict.fromkeys(ids, (0.0, 0.0, 0.0))
    keep = spark.createDataFrame(pairs, "i int, j int")
    sides = spark.createDataFrame(layout.overlap_sides(img.tiles(), s["scale_y"]).join(keep, ["i", "j"]).select("i", "j", "side", "tile_id", "y0", "y1", "x0", "x1").collect(), "i int, j int, side int, tile_id int, y0 int, y1 int, x0 int, x1 int")  # two rows a pair
    depth = 1 if on_projection else s["nz"]
    parts = blocks.tile_parts(_near_overlaps(img, sides, level).where(F.col("c") == c), img.boxes(level))
    images = blocks.overlap_images(parts, sides, depth, on_projection)
    found = blocks.pair_shifts(images, sides, depth, upsample).where(F.col("quality") >= least_quality).collect()  # a row per pair
    up = [s[f"scale_{a}"] / img.attrs["scale"][a] for a in "zyx"]
    edges = [(r["i"], r["j"], tuple(r[f"d{a}"] * u for a, u in zip("zyx", up, strict=True)), max(r["quality"], 1e-3)) for r in found]
    return fuse.resolve_shifts(edges, ids, most=most)


def _edges(found: list, corners: dict[tuple[int, int], tuple[np.ndarray, np.ndarray, np.ndarray]], up: np.ndarray) -> list[tuple[int, int, np.ndarray, np.ndarray, float]]:
    """(i, j, points in i, in j, weight) in full-resolution voxels: the corners of each pair's overlap, and where the pair's map puts them. Voxels of a lower level lie in the middle of those they are made of."""
    out = []
    for r in found:
        p, at_i, at_j = corners[r["i"], r["j"]]
        m = np.array(r["m"]).reshape(3, 4)
        q = p @ m[:, :3].T + m[:, 3]
        out.append((r["i"], r["j"], (p + at_i) * up + (up - 1) / 2, (q + at_j) * up + (up - 1) / 2, max(r["quality"], 1e-3)))
    return out


def _corners(nz: int, ny: int, nx: int) -> np.ndarray:
    return np.stack(np.meshgrid(*([0.0, n - 1.0] for n in (nz, ny, nx)), indexing="ij"), axis=-1).reshape(-1, 3)


def register_maps(img: Image, c: int, transform: str, pruning: str | None = None, level: int = 0, least_quality: float = 0.0, on_projection: bool = True, most: float = float("inf")) -> dict[int, np.ndarray]:
    """A rigid, similarity or affine map (4 by 4) from every tile's voxels to the stage's, in full-resolution voxels: neighbours' overlaps are mapped on each other at a level, and all tiles' maps follow from the corners of these overlaps, without pairs that are off by more than `most` voxels."""
    spark, s, scale = img.spark, img.levels[level], img.attrs["scale"]
    first = {r["tile_id"]: warp.shifted((0, r["y_orig_um"] / scale["y"], r["x_orig_um"] / scale["x"])) for r in img.tiles().orderBy("tile_id").select("tile_id", "y_orig_um", "x_orig_um").collect()}
    pairs = pruned(img.tiles(), scale["y"], pruning)
    if not pairs:
        return first
    keep = spark.createDataFrame(pairs, "i int, j int")
    rows = layout.overlap_sides(img.tiles(), s["scale_y"]).join(keep, ["i", "j"]).select("i", "j", "side", "tile_id", "y0", "y1", "x0", "x1").collect()  # two rows a pair
    sides = spark.createDataFrame(rows, "i int, j int, side int, tile_id int, y0 int, y1 int, x0 int, x1 int")
    depth = 1 if on_projection else s["nz"]
    parts = blocks.tile_parts(_near_overlaps(img, sides, level).where(F.col("c") == c), img.boxes(level))
    images = blocks.overlap_images(parts, sides, depth, on_projection)
    found = blocks.pair_maps(images, sides, dict.fromkeys(first, depth), transform).where(F.col("quality") >= least_quality).collect()  # a row per pair
    up = np.array([s[f"scale_{a}"] / scale[a] for a in "zyx"])
    at: dict[tuple, dict[int, tuple]] = {}
    for r in rows:
        at.setdefault((r["i"], r["j"]), {})[r["side"]] = r
    corners = {k: (_corners(depth, x[1]["y1"] - x[1]["y0"], x[1]["x1"] - x[1]["x0"]), *(np.array([0, x[n]["y0"], x[n]["x0"]]) for n in (1, 2))) for k, x in at.items()}
    return fuse.resolve_maps(_edges(found, corners, up), first, transform, most)


def _placed(maps: dict[int, np.ndarray], sizes: dict[int, tuple[int, int, int]]) -> tuple[dict[int, np.ndarray], dict[str, int]]:
    """Maps moved so that what they cover begins at 0, and the size of it."""
    moves = warp.Moves(maps, sizes)
    low = moves.lo.min(axis=0)
    size = np.floor(moves.hi.max(axis=0) - low + 1e-6).astype(int) + 1
    return {t: warp.shifted(tuple(-low)) @ m for t, m in maps.items()}, dict(zip("zyx", size.tolist(), strict=True))


def _fused(parts: DataFrame, maps: dict[int, np.ndarray], sizes: dict[int, tuple[int, int, int]], chunk: tuple[int, int, int], shape: dict[str, int], how: str) -> DataFrame:
    """Fusion by maps; those that shift by whole voxels need no interpolation."""
    if all(np.array_equal(m, warp.shifted(tuple(np.rint(m[:3, 3])))) for m in maps.values()):
        return blocks.fused(parts, {t: tuple(int(k) for k in np.rint(m[:3, 3])) for t, m in maps.items()}, sizes, chunk, shape, how)
    return warp.warped(parts, maps, sizes, chunk, shape, how)


def stitch(spark: SparkSession, path: str, out: str, channel: Channel, pruning: str | None = None, level: int = 0, least_quality: float = 0.0, blend: bool = True, erase: bool = False, on_projection: bool = True, upsample: int = 1, transform: str = "translation", most: float = float("inf")) -> str:
    """Register tiles by their overlaps (or the overlaps' projections along z) at a level and fuse them where they belong, between voxels where that is not whole.

    transform: `translation` by phase correlation, to 1 / upsample of a voxel of
    that level; `rigid`, `similarity` and `affine` maps by least squares from
    there. Pairs that are off by more than `most` voxels from what all others
    say are left out.
    """
    if transform not in KINDS:
        raise ValueError(f"transform must be one of {KINDS}")
    img = Image.open(spark, path)
    scale, c = img.attrs["scale"], img.channel(channel)
    sizes = {r["tile_id"]: (img.shape["z"], r["y1"] - r["y0"], r["x1"] - r["x0"]) for r in img.boxes().collect()}
    if transform == "translation":
        solved = register_tiles(img, c, pruning, level, least_quality, on_projection, upsample, most)
        rows = img.tiles().select("tile_id", F.bround(F.col("y_orig_um") / scale["y"]).cast("int").alias("oy"), F.bround(F.col("x_orig_um") / scale["x"]).cast("int").alias("ox")).collect()
        maps = {r["tile_id"]: warp.shifted(tuple(o + d for o, d in zip((0, r["oy"], r["ox"]), solved[r["tile_id"]], strict=True))) for r in rows}
        if upsample == 1 and level == 0:  # shifts are means of whole ones
            maps = {t: warp.shifted(tuple(np.rint(m[:3, 3]))) for t, m in maps.items()}
    else:
        maps = register_maps(img, c, transform, pruning, level, least_quality, on_projection, most)
    maps, shape = _placed(maps, sizes)
    chunks = _fused(_parts(img), maps, sizes, img.chunk, shape, "blend" if blend else "mean")
    new = from_chunks(spark, chunks, _one_tile(spark, shape, scale), out, shape, scale, img.attrs["channels"], Size(*img.chunk), len(img.levels))
    if transform == "translation":
        new.attrs["shifts"] = {str(t): list(d) for t, d in solved.items()}
    new.attrs["maps"] = {str(t): m[:3].tolist() for t, m in maps.items()}
    _with_acquisition(new, [img])
    new.record("stitch", {"channel": channel, "pruning": pruning, "level": level, "transform": transform})
    if erase:
        img.store.delete(path)
    return out


def register_views(images: list[Image], channel: Channel, level: int | None = None, transform: str = "translation", least_quality: float = 0.0, most: float = float("inf"), upsample: int = 1) -> list[np.ndarray]:
    """A map (4 by 4) from each view's voxels to the first's: all pairs of views are laid on each other at a level (the deepest that all have, unless given), and all views' maps follow from the graph of these pairs.

    A task holds the volumes of one pair at that level.
    """
    first, spark = images[0], images[0].spark
    level = min(len(i.levels) for i in images) - 1 if level is None else level
    if any(len(i.levels) <= level for i in images):
        raise ValueError("views have different levels")
    start = {k: np.eye(4) for k in range(len(images))}
    if len(images) < 2:
        return [start[0]]
    size = {k: tuple(i.levels[level][f"n{a}"] for a in "zyx") for k, i in enumerate(images)}
    if transform == "translation":  # images of one size
        size = dict.fromkeys(size, tuple(max(n[k] for n in size.values()) for k in range(3)))
    parts = reduce(DataFrame.unionByName, (i.chunks(level).where(F.col("c") == i.channel(channel)).withColumn("tile_id", F.lit(k)) for k, i in enumerate(images)))
    pairs = [(i, j) for i in range(len(images)) for j in range(i + 1, len(images))]  # of the images that were named
    sides = spark.createDataFrame([(i, j, side, t, 0, size[t][1], 0, size[t][2]) for i, j in pairs for side, t in ((1, i), (2, j))], "i int, j int, side int, tile_id int, y0 int, y1 int, x0 int, x1 int")
    overlaps = blocks.overlap_images(parts, sides, 0, project=False)
    good = F.col("quality") >= least_quality
    up = np.array([first.levels[level][f"scale_{a}"] / first.attrs["scale"][a] for a in "zyx"])
    if transform == "translation":
        found = blocks.pair_shifts(overlaps, sides, size[0][0], upsample).where(good).collect()  # a row per pair
        edges = [(r["i"], r["j"], tuple(np.array([r["dz"], r["dy"], r["dx"]]) * up), max(r["quality"], 1e-3)) for r in found]
        shifts = fuse.resolve_shifts(edges, list(start), most=most)
        return [warp.shifted(tuple(np.rint(shifts[k])) if upsample == 1 and not level else shifts[k]) for k in start]
    found = blocks.pair_maps(overlaps, sides, {k: n[0] for k, n in size.items()}, transform).where(good).collect()  # a row per pair
    corners = {(i, j): (_corners(*size[i]), np.zeros(3), np.zeros(3)) for i, j in pairs}
    solved = fuse.resolve_maps(_edges(found, corners, up), start, transform, most)
    return [solved[k] for k in range(len(images))]


def fuse_images(spark: SparkSession, paths: list[str], out: str, shifts: dict[str, tuple[int, int, int]] | None = None, registration_channel: Channel | None = None, overwrite: bool = False, level: int | None = None, transform: str = "translation", least_quality: float = 0.0, most: float = float("inf"), upsample: int = 1) -> str:
    """Several images into one: with a registration channel as views of one object (mean where they overlap), else as channels, one label each.

    Views lie where `shifts` says (by path); without it they are registered on
    the channel (see `register_views`).
    """
    if transform not in KINDS:
        raise ValueError(f"transform must be one of {KINDS}")
    store = Store(spark)
    if store.exists(out):
        if not overwrite:
            raise FileExistsError(out)
        store.delete(out)
    images = [Image.open(spark, p) for p in paths]
    first, views = images[0], registration_channel is not None
    if views:
        labels = [sorted(c["label"] for c in i.attrs["channels"]) for i in images]
        if any(x != labels[0] for x in labels):
            raise ValueError("views have different channels")
    if views and shifts is None:
        moves = register_views(images, registration_channel, level, transform, least_quality, most, upsample)
    else:
        moves = [warp.shifted((shifts or {}).get(p, (0, 0, 0))) for p in paths]
    sizes = {k: tuple(i.shape[a] for a in "zyx") for k, i in enumerate(images)}
    maps, shape = _placed(dict(enumerate(moves)), sizes)
    parts, channels = None, []
    for k, i in enumerate(images):
        if views:
            to = {j: first.channel(Channel(label=c["label"])) for j, c in enumerate(i.attrs["channels"])} if k else {j: j for j in range(len(i.attrs["channels"]))}
            channels = first.attrs["channels"]
        else:
            new = [(j, c) for j, c in enumerate(i.attrs["channels"]) if c["label"] not in {x["label"] for x in channels}]
            to = {j: len(channels) + n for n, (j, _) in enumerate(new)}
            channels = [*channels, *(c for _, c in new)]
        if not to:  # every label is there already
            continue
        p = i.chunks(0).where(F.col("c").isin(list(to))).withColumn("c", F.create_map(*[F.lit(x) for kv in to.items() for x in kv])[F.col("c")]).withColumn("tile_id", F.lit(k))
        parts = p if parts is None else parts.unionByName(p)
    chunks = _fused(parts, maps, sizes, first.chunk, shape, "mean" if views else "max")
    img = from_chunks(spark, chunks, first.tiles(), out, shape, first.attrs["scale"], channels, Size(*first.chunk), len(first.levels))
    img.attrs["places"] = [maps[k][:3, 3].tolist() for k in range(len(images))]
    img.attrs["maps"] = [maps[k][:3].tolist() for k in range(len(images))]
    _with_acquisition(img, images)
    img.record("fuse_images", {"paths": paths})
    return out


def modify_structure(spark: SparkSession, path: str, name: str | None = None, chunk: Size | None = None, levels: int | None = None, channels: list[dict] | None = None) -> str:
    """Re-chunk, rebuild the levels that are absent or incomplete, drop levels beyond those asked for, rename, replace channel labels and colours."""
    img = Image.open(spark, path)
    if chunk and (chunk.z, chunk.y, chunk.x) != img.chunk:
        new = f"{path}/chunks.new"
        img.store.delete(new)
        for s in img.levels:
            c = storage.rechunked(img.chunks(s["level"]), (chunk.z, chunk.y, chunk.x), {"z": s["nz"], "y": s["ny"], "x": s["nx"]})
            storage.write_chunks(c, new)
        img.store.swap(new, f"{path}/chunks")  # only when all levels are written
        img.attrs["chunk"] = [chunk.z, chunk.y, chunk.x]
        img.save_attrs()
    want = levels or len(img.levels)
    plan = pyramid.pyramid_plan(spark, img.shape, img.attrs["scale"], want)
    bad = sorted(r["level"] for r in storage.missing_levels(img.chunks(), plan).select("level").collect())
    if want != len(img.levels) or bad:
        img.build(want, start=max(1, min(bad, default=want)))
    for k, c in enumerate(channels or []):
        for taken in img.attrs.get("acquisition_metadata", {}).get("channels", []):
            if taken["label"] == img.attrs["channels"][k]["label"]:
                taken["label"] = c.get("label", taken["label"])
        img.attrs["channels"][k] |= {x: c[x] for x in ("label", "color", "wavelength_id") if x in c}
    if name:
        img.attrs["name"] = name
    img.record("modify_structure", {"chunk": chunk, "levels": levels})
    return path


def export_arrays(img: Image, out: str, compression_level: int = 3) -> str:
    """The image as a folder of chunked arrays that other viewers open: an array a level, with the multiscale attributes. A level is there whole or not at all."""
    planes.register(img.spark)
    store = Store(img.spark)
    store.folder(out)
    for s in img.levels:
        shape = [len(img.attrs["channels"]), *(s[f"n{a}"] for a in "zyx")]
        w = img.chunks(s["level"]).write.format("voxzarr").mode("overwrite").option("path", out).option("level", s["level"])
        w.option("shape", json.dumps(shape)).option("chunks", json.dumps([1, *img.chunk])).option("compression_level", compression_level).save()
    attrs = img.ngff()
    attrs["multiscales"][0]["version"] = "0.4"
    store.write(f"{out}/.zgroup", {"zarr_format": 2})
    store.write(f"{out}/.zattrs", attrs)
    return out


def import_arrays(spark: SparkSession, path: str, out: str, chunk: Size | None = None, levels: int | None = None, tiles: DataFrame | None = None) -> Image:
    """An image from a folder of chunked arrays with multiscale attributes: its full level is read chunk by chunk, lower ones are made anew. Without a tile table it is one tile."""
    planes.register(spark)
    attrs = Store(spark).read(f"{path}/.zattrs")
    one = attrs["multiscales"][0]
    full = one["datasets"][0]
    scale = dict(zip("zyx", next(t["scale"] for t in full["coordinateTransformations"] if t["type"] == "scale")[-3:], strict=True))
    layout_ = arrays.Layout.read(*arrays.located(f"{path}/{full['path']}"))
    shape, size = dict(zip("zyx", layout_.shape[1:], strict=True)), chunk or Size(*layout_.chunks[1:])
    known = attrs.get("omero", {}).get("channels", [])
    channels = [{"wavelength_id": c.get("wavelength_id", str(k)), "label": c.get("label", str(k)), "color": c.get("color", "FFFFFF")} for k, c in enumerate(known)] or [{"wavelength_id": str(k), "label": str(k), "color": "FFFFFF"} for k in range(layout_.shape[0])]
    parts = spark.read.format("voxzarr").option("path", path).option("level", full["path"]).option("image", "image").load()
    img = from_chunks(spark, storage.rechunked(parts, (size.z, size.y, size.x), shape), tiles or _one_tile(spark, shape, scale), out, shape, scale, channels, size, levels or len(one["datasets"]))
    if "acquisition_metadata" in attrs:
        img.attrs["acquisition_metadata"] = attrs["acquisition_metadata"]
    img.record("import_arrays", {"path": path})
    return img


def archive(spark: SparkSession, path: str, into: str, compression: str = "zstd", preview: bool = True, level: int | None = None) -> str:
    """The image with other compression (at a level of it, where the codec has levels) in one tar; beside it, if asked, a preview image of its deepest level. Tars are made on the driver's file system."""
    src, name = Path(path), Path(path).name
    work = Path(into) / name
    for p in src.iterdir():
        if p.name != "chunks":
            work.mkdir(parents=True, exist_ok=True)
            (shutil.copytree if p.is_dir() else shutil.copy)(p, work / p.name)
    storage.recompressed(spark, f"{path}/chunks", f"{work}/chunks", compression, level)
    tar = storage.archive(str(work), f"{work}.tar")
    if preview:
        img = Image.open(spark, path)
        top = img.levels[-1]
        small = img.like(f"{into}/{name}_preview", shape={"z": top["nz"], "y": top["ny"], "x": top["nx"]}, scale={a: top[f"scale_{a}"] for a in "zyx"}, levels=[top | {"level": 0}])
        storage.write_chunks(img.chunks(len(img.levels) - 1).withColumn("level", F.lit(0)), f"{small.path}/chunks")
    shutil.rmtree(work)
    return tar


def restore(spark: SparkSession, tar: str, into: str, compression: str = "lz4", keep_tar: bool = True) -> str:
    """An archived image unpacked, with compression for fast reading."""
    path = storage.restore(tar, into)
    storage.recompressed(spark, f"{path}/chunks", f"{path}/chunks.new", compression)
    Store(spark).swap(f"{path}/chunks.new", f"{path}/chunks")
    if not keep_tar:
        Path(tar).unlink()
    return path


def changed_parameters(given: object, default: object) -> dict:
    """Fields in which a parameter object differs from its default."""
    return {k: v for k, v in vars(given).items() if v != vars(default)[k]}


def map_tiles(img: Image, f: Callable[[int, int, slice, slice, slice, np.ndarray], np.ndarray]) -> DataFrame:
    """Level-0 chunks with f(c, tile_id, z, y, x, voxels) in place of each tile's voxels, chunk by chunk."""
    return blocks.corrected(img.chunks(0), img.boxes(), f)
