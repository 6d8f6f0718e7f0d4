"""Chunked images as tables: packing voxels into chunks, re-chunking, completeness, previews, archives."""

from __future__ import annotations

import tarfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom.schemas import CHUNKS, U16_MAX
from voxloom.sources.files import Store


def to_chunks(voxels: DataFrame, size: tuple[int, int, int], shape: dict[str, int], image: str = "image", level: int = 0) -> DataFrame:
    """Chunk rows of voxels: one shuffle by chunk, then each chunk is filled as its voxels stream by; chunks of zeros are left out.

    Values outside 16 bits, and two different values above 0 for one voxel, are errors.
    """
    cz, cy, cx = size
    nz, ny, nx = shape["z"], shape["y"], shape["x"]
    at = [F.floor(F.col(a) / s).cast("int").alias(f"c{a}") for a, s in zip("zyx", size, strict=True)]
    v = voxels.where("v <> 0").select("c", *at, "z", "y", "x", "v").repartition("c", "cz", "cy", "cx").sortWithinPartitions("c", "cz", "cy", "cx")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, block, done = None, None, []

        def row() -> tuple:
            c, z, y, x = key
            dims = [min(s, n - k * s) for k, s, n in zip((z, y, x), size, (nz, ny, nx), strict=True)]
            return (image, level, c, z, y, x, z * cz, y * cy, x * cx, *dims, block[: dims[0], : dims[1], : dims[2]].astype("<u2").tobytes())

        for b in batches:
            cols = [b.column(i).to_numpy() for i in range(8)]
            keys = np.stack(cols[:4])
            cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1), b.num_rows]
            for i, j in zip(cuts, cuts[1:], strict=False):
                if i == j:
                    continue
                now = tuple(int(k) for k in keys[:, i])
                if now != key:
                    if key is not None:
                        done.append(row())
                    key, block = now, np.zeros(size, np.uint16)
                v, at = cols[7][i:j], (cols[4][i:j] - now[1] * cz, cols[5][i:j] - now[2] * cy, cols[6][i:j] - now[3] * cx)
                if v.min() < 0 or v.max() > U16_MAX:
                    raise ValueError(f"voxels outside 0 to {U16_MAX}: {v.min()} to {v.max()}")
                before = block[at]
                block[at] = v
                if ((before != 0) & (before != v)).any() or (block[at] != v).any():
                    raise ValueError(f"a voxel of chunk {now} has more than one value")
            if done:
                yield _rows(done)
                done = []
        if key is not None:
            yield _rows([row()])

    return v.mapInArrow(run, CHUNKS)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    names = ["image", "level", "c", "cz", "cy", "cx", "z0", "y0", "x0", "nz", "ny", "nx", "data"]
    kinds = [pa.string(), *[pa.int32()] * 11, pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)


def to_voxels(chunks: DataFrame, zeros: bool = False) -> DataFrame:
    """(image, level, c, z, y, x, v) of chunk rows, a chunk at a time; zeros are left out unless asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                a = np.frombuffer(r["data"], "<u2").reshape(r["nz"], r["ny"], r["nx"])
                z, y, x = np.nonzero(a) if not zeros else (i.ravel() for i in np.indices(a.shape))
                n = len(z)
                fill = lambda v, k=n: np.full(k, v, np.int32)
                cols = [pa.array([r["image"]] * n, pa.string()), fill(r["level"]), fill(r["c"]), (z + r["z0"]).astype(np.int32), (y + r["y0"]).astype(np.int32), (x + r["x0"]).astype(np.int32), a[z, y, x].astype(np.int32)]
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in cols], names=["image", "level", "c", "z", "y", "x", "v"])

    return chunks.mapInArrow(run, "image string, level int, c int, z int, y int, x int, v int")


def cut(image: str, level: int, c: int, at: tuple[int, int, int], a: np.ndarray, size: tuple[int, int, int]) -> Iterator[tuple]:
    """Chunk rows of the parts of a block (its corner at `at`) that fall into chunks of `size`; each part keeps its own corner. Parts of zeros are left out."""
    first = [o // s for o, s in zip(at, size, strict=True)]
    last = [(o + n - 1) // s for o, n, s in zip(at, a.shape, size, strict=True)]
    for k in np.ndindex(*(j - i + 1 for i, j in zip(first, last, strict=True))):
        to = [i + d for i, d in zip(first, k, strict=True)]
        lo = [max(o, t * s) for o, t, s in zip(at, to, size, strict=True)]
        hi = [min(o + n, (t + 1) * s) for o, n, t, s in zip(at, a.shape, to, size, strict=True)]
        p = a[tuple(slice(i - o, j - o) for i, j, o in zip(lo, hi, at, strict=True))]
        if p.any():
            yield (image, level, c, *map(int, to), *map(int, lo), *p.shape, p.astype("<u2").tobytes())


def block(row: dict) -> np.ndarray:
    """The voxels of a chunk row."""
    return np.frombuffer(row["data"], "<u2").reshape(row["nz"], row["ny"], row["nx"])


def assembled(parts: DataFrame, size: tuple[int, int, int], shape: dict[str, int]) -> DataFrame:
    """Whole chunks of parts (chunk rows of `cut`): one shuffle of parts by chunk, a chunk at a time."""
    cz, cy, cx = size

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, None

        def row() -> tuple:
            image, level, c, z, y, x = key
            dims = [min(s, n - k * s) for k, s, n in zip((z, y, x), size, (shape["z"], shape["y"], shape["x"]), strict=True)]
            return (*key, z * cz, y * cy, x * cx, *dims, held[: dims[0], : dims[1], : dims[2]].astype("<u2").tobytes())

        for b in batches:
            for r in b.to_pylist():
                now = (r["image"], r["level"], r["c"], r["cz"], r["cy"], r["cx"])
                if now != key:
                    if key is not None:
                        yield _rows([row()])
                    key, held = now, np.zeros(size, np.uint16)
                o = [r["z0"] - r["cz"] * cz, r["y0"] - r["cy"] * cy, r["x0"] - r["cx"] * cx]
                held[tuple(slice(i, i + n) for i, n in zip(o, (r["nz"], r["ny"], r["nx"]), strict=True))] = block(r)
        if key is not None:
            yield _rows([row()])

    keys = ["image", "level", "c", "cz", "cy", "cx"]
    return parts.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(join, CHUNKS)


def rechunked(chunks: DataFrame, size: tuple[int, int, int], shape: dict[str, int]) -> DataFrame:
    """The same image in chunks of another size. Parts of chunks move, not voxels: a chunk is cut at the new borders and each new chunk is put together from its parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                yield _rows(list(cut(r["image"], r["level"], r["c"], (r["z0"], r["y0"], r["x0"]), block(r), size)))

    return assembled(chunks.mapInArrow(run, CHUNKS), size, shape)


def write_chunks(chunks: DataFrame, path: str, mode: str = "overwrite", compression: str = "zstd") -> None:
    """Chunk table partitioned by image, level and channel, sorted by corner so that boxes skip row groups; only partitions in `chunks` are replaced."""
    out = chunks.sortWithinPartitions("image", "level", "c", "z0", "y0", "x0")
    out.write.mode(mode).option("compression", compression).option("partitionOverwriteMode", "dynamic").partitionBy("image", "level", "c").parquet(path)


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    names = [f.split()[0] for f in CHUNKS.split(", ")]
    return spark.read.schema(CHUNKS).parquet(path).select(*names)


def read_tiles(spark: SparkSession, paths: dict[int, str], level: int) -> DataFrame:
    """(tile_id, chunk columns) of a level of several images, in one scan; which image a row is of is told by its file's path."""
    names = [f.split()[0] for f in CHUNKS.split(", ")]
    inside = ", ".join(f for f in CHUNKS.split(", ") if f.split()[0] not in ("image", "level", "c"))
    plain = lambda c: F.regexp_replace(c, "^file:/+", "/")
    root = spark.createDataFrame([(k, p.rstrip("/")) for k, p in paths.items()], "tile_id int, r_path string").withColumn("r_path", plain(F.col("r_path")))
    store = Store(spark)
    there = [f"{p.rstrip('/')}/chunks/image=image/level={level}" for p in paths.values()]
    there = [p for p in there if store.exists(p)]  # an image of zeros has no chunk
    if not there:
        return spark.createDataFrame([], "tile_id int, " + CHUNKS)
    d = spark.read.schema(inside).option("recursiveFileLookup", "true").parquet(*there)
    at = F.col("_metadata.file_path")
    d = d.select("*", F.regexp_extract(plain(at), "^(.*)/chunks/image=", 1).alias("f_path"), F.lit("image").alias("image"), F.lit(level).alias("level"), F.regexp_extract(at, "/c=([0-9]+)/", 1).cast("int").alias("c"))
    return d.join(root, F.col("f_path") == F.col("r_path")).select("tile_id", *names)


def level_completeness(chunks: DataFrame) -> DataFrame:
    """(image, level, stored, bad, complete): a level is complete when every stored chunk has as many bytes as voxels need; chunks not stored are zeros."""
    bad = F.length("data") != F.col("nz") * F.col("ny") * F.col("nx") * 2
    g = chunks.groupBy("image", "level").agg(F.count("*").alias("stored"), F.count_if(bad | F.col("data").isNull()).alias("bad"))
    return g.withColumn("complete", F.col("bad") == 0)


def missing_levels(chunks: DataFrame, plan: DataFrame) -> DataFrame:
    """Levels of the plan that are absent or incomplete: what a rebuild has to make."""
    ok = level_completeness(chunks).where("complete").select("level").distinct()
    return plan.join(F.broadcast(ok), "level", "left_anti")


def preview(chunks: DataFrame) -> DataFrame:
    """The deepest level of each image as its level 0."""
    top = chunks.groupBy("image").agg(F.max("level").alias("deepest"))
    return chunks.join(F.broadcast(top), "image").where("level = deepest").withColumn("level", F.lit(0)).drop("deepest")


def recompressed(spark: SparkSession, path: str, out: str, compression: str, level: int | None = None) -> None:
    """The chunk table with another compression; the same partitions. level: of zstd."""
    conf, key = spark._jsc.hadoopConfiguration(), "parquet.compression.codec.zstd.level"
    before = conf.get(key)
    if level is not None:
        conf.set(key, str(level))
    try:
        write_chunks(read_chunks(spark, path), out, compression=compression)
    finally:
        if level is not None:
            conf.set(key, before) if before is not None else conf.unset(key)


def archive(folder: str, tar: str) -> str:
    with tarfile.open(tar, "w") as t:
        t.add(folder, arcname=Path(folder).name)
    return tar


def restore(tar: str, into: str) -> str:
    """Unpack a tar with exactly one top-level entry; members that would leave the folder are refused."""
    with tarfile.open(tar) as t:
        tops = {m.name.split("/")[0] for m in t.getmembers()}
        if len(tops) != 1:
            raise ValueError(f"expected one top-level entry, found {len(tops)}")
        t.extractall(into, filter="data")
    return str(Path(into) / tops.pop())
