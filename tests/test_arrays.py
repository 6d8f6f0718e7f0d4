"""Chunked-array folders: frames made by hand, reads of both byte orders, writes that are whole or not there."""

import json
import struct
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from voxloom import api
from voxloom.operators import storage
from voxloom.sources import arrays, planes


def blosc(data: bytes, width: int, how: str, block: int, shuffle: int, split: bool) -> bytes:
    """A frame as its format describes it."""
    import zstandard

    pack = {"lz4": lambda x: pa.compress(x, "lz4_raw", asbytes=True), "zlib": zlib.compress, "zstd": zstandard.ZstdCompressor().compress}[how]
    blocks = []
    for i in range(0, len(data), block):
        b = data[i : i + block]
        n = len(b) // width
        if shuffle == 1:
            b = b"".join(b[k : n * width : width] for k in range(width)) + b[n * width :]
        elif shuffle == 4 and n % 8 == 0:
            bits = [[(b[e * width + k] >> j) & 1 for e in range(n)] for k in range(width) for j in range(8)]
            b = bytes(sum(row[g + m] << m for m in range(8)) for row in bits for g in range(0, n, 8)) + b[n * width :]
        parts = [b]
        if split and len(b) == block:
            parts = [b[k * block // width : (k + 1) * block // width] for k in range(width)]
        out = b""
        for p in parts:
            c = pack(p)
            c = p if len(c) >= len(p) else c
            out += struct.pack("<i", len(c)) + c
        blocks.append(out)
    starts, at = [], 16 + 4 * len(blocks)
    for b in blocks:
        starts.append(at)
        at += len(b)
    flags = shuffle | (0 if split else 16) | {"lz4": 1, "zlib": 3, "zstd": 4}[how] << 5
    return struct.pack("<BBBBIII", 2, 1, flags, width, len(data), block, at) + struct.pack(f"<{len(starts)}i", *starts) + b"".join(blocks)


@pytest.mark.parametrize("how", ["lz4", "zlib", "zstd"])
@pytest.mark.parametrize("shuffle", [0, 1, 4])
@pytest.mark.parametrize("split", [True, False])
def test_frames(how, shuffle, split):
    rng = np.random.default_rng(1)
    for n, width, block in ((3000, 2, 1024), (2048, 2, 2048), (1024, 4, 1600 if shuffle == 1 else 1024), (5, 2, 10)):
        data = (rng.integers(0, 9, n) * 257).astype(f"<u{width}").tobytes() + (b"x" if width == 4 and shuffle == 1 else b"")
        if split and block // width < 128:
            continue
        assert arrays.frame(blosc(data, width, how, block, shuffle, split)) == data
    raw = bytes(range(100))
    assert arrays.frame(struct.pack("<BBBBIII", 2, 1, 2, 2, 100, 100, 116) + raw) == raw
    with pytest.raises(ValueError, match="ends after"):
        arrays.frame(struct.pack("<BBBBIII", 2, 1, 2, 2, 100, 100, 116) + raw[:50])
    with pytest.raises(NotImplementedError, match="blosclz"):
        arrays.frame(struct.pack("<BBBBIII", 2, 1, 16, 2, 8, 8, 27) + struct.pack("<ii", 20, 3) + b"abc")


@pytest.mark.parametrize("dtype, separator, axes", [("<u2", ".", 4), (">u2", "/", 5), ("|u1", ".", 3), ("<i4", "/", 4)])
def test_reads(spark, tmp_path, dtype, separator, axes):
    a = np.random.default_rng(2).integers(0, 200, (2 if axes > 3 else 1, 5, 9, 7))
    a[:, :2] = 0
    size = [1 if axes != 5 else 2, 2, 4, 4]
    more = [1] if axes == 5 else []
    cut = max(0, 4 - axes)
    level = tmp_path / "z" / "0"
    level.mkdir(parents=True)
    meta = {"zarr_format": 2, "shape": [*more, *a.shape[cut:]], "chunks": [*more, *size[cut:]], "dtype": dtype, "compressor": {"id": "blosc", "cname": "lz4"}, "fill_value": 0, "order": "C", "filters": None, "dimension_separator": separator}
    (level / ".zarray").write_text(json.dumps(meta))
    for at in np.ndindex(*(-(-n // k) for n, k in zip(a.shape, size, strict=True))):
        full = np.zeros(size, dtype)
        p = a[tuple(slice(i * k, (i + 1) * k) for i, k in zip(at, size, strict=True))]
        full[tuple(map(slice, p.shape))] = p
        if p.any():
            f = level / separator.join(map(str, [*([0] if more else []), *at[cut:]]))
            f.parent.mkdir(parents=True, exist_ok=True)
            f.write_bytes(blosc(full.tobytes(), full.itemsize, "lz4", full.nbytes, 1, False))
    planes.register(spark)
    for path in (str(tmp_path / "z"), f"file://{tmp_path}/z"):
        got = np.zeros(a.shape)
        for r in storage.to_voxels(spark.read.format("voxzarr").option("path", path).load()).collect():
            got[r["c"], r["z"], r["y"], r["x"]] = r["v"]
        assert np.array_equal(got, a)


def test_reads_need_whole_numbers_of_16_bits(spark, tmp_path):
    planes.register(spark)
    for k, (dtype, value, say) in enumerate((("<f4", 1.5, "not whole numbers"), ("<i4", 70_000, "outside 0 to"), ("<i2", -3, "outside 0 to"))):
        level = tmp_path / str(k) / "0"
        level.mkdir(parents=True)
        (level / ".zarray").write_text(json.dumps({"shape": [1, 1, 1, 2], "chunks": [1, 1, 1, 2], "dtype": dtype, "compressor": None, "fill_value": 0, "order": "C", "filters": None}))
        (level / "0.0.0.0").write_bytes(np.array([value] * 2, dtype).tobytes())
        with pytest.raises(Exception, match=say):
            spark.read.format("voxzarr").option("path", str(tmp_path / str(k))).load().collect()


def test_round_trip(spark, tmp_path):
    rng = np.random.default_rng(3)
    a = rng.integers(0, 65536, (2, 5, 21, 18))
    a[:, :, :8, :8] = 0
    c, z, y, x = np.nonzero(a)
    v = spark.createDataFrame(list(zip(c.tolist(), z.tolist(), y.tolist(), x.tolist(), a[c, z, y, x].tolist(), strict=True)), "c int, z int, y int, x int, v int")
    tiles = spark.createDataFrame([(0, 0.0, 0.0, 0.0, 0.0, 0.0, 18.0, 21.0, 5.0)], api.TILE_TABLE)
    channels = [{"wavelength_id": "488", "label": "red", "color": "FF0000"}, {"wavelength_id": "561", "label": "far", "color": "00FF00"}]
    img = api.from_voxels(spark, v, tiles, str(tmp_path / "i"), {"z": 5, "y": 21, "x": 18}, {"z": 4.0, "y": 1.0, "x": 1.0}, channels, api.Size(2, 8, 8), 2)
    out = api.export_arrays(img, str(tmp_path / "out"))
    names = {str(p.relative_to(out)) for p in Path(out).rglob("*") if p.is_file() and not p.name.startswith("..")}
    assert "0/0/0/0/0" not in names and "0/0/0/1/1" in names and {".zattrs", ".zgroup", "0/.zarray", "1/.zarray"} <= names
    attrs = json.loads((Path(out) / ".zattrs").read_text())
    assert [s["path"] for s in attrs["multiscales"][0]["datasets"]] == ["0", "1"] and [c["label"] for c in attrs["omero"]["channels"]] == ["red", "far"]
    back = api.import_arrays(spark, out, str(tmp_path / "back"), api.Size(3, 16, 16))
    got = np.zeros(a.shape, int)
    for r in back.voxels().collect():
        got[r["c"], r["z"], r["y"], r["x"]] = r["v"]
    assert np.array_equal(got, a) and back.attrs["scale"] == img.attrs["scale"] and len(back.levels) == 2
    low = lambda i: sorted(map(tuple, i.voxels(1).collect()))
    assert low(back) == low(img)


def test_a_failed_write_leaves_what_was_there(spark, tmp_path):
    from pyspark.sql import functions as F

    planes.register(spark)
    ones = storage.to_chunks(spark.createDataFrame([(0, z, 0, 0, 5) for z in range(6)], "c int, z int, y int, x int, v int"), (2, 4, 4), {"z": 6, "y": 4, "x": 4}).repartition(3)
    to = lambda df, mode="overwrite", chunks="[1, 2, 4, 4]": df.write.format("voxzarr").mode(mode).option("path", str(tmp_path / "w")).option("shape", "[1, 6, 4, 4]").option("chunks", chunks).save()
    to(ones)
    assert sorted(p.name for p in (tmp_path / "w").iterdir()) == ["0"]
    with pytest.raises(Exception, match="lost"):
        to(ones.withColumn("data", F.when(F.col("cz") == 2, F.raise_error(F.lit("lost"))).otherwise(F.col("data")).cast("binary")))
    with pytest.raises(Exception, match="no whole chunk"):
        to(ones, chunks="[1, 3, 4, 4]")
    assert sorted(p.name for p in (tmp_path / "w").iterdir()) == ["0"]
    assert spark.read.format("voxzarr").option("path", str(tmp_path / "w")).load().count() == 3
    with pytest.raises(Exception, match="w/0"):
        to(ones, "append")


def test_chunks_take_16_bits_only(spark):
    for v in (70_000, -1):
        with pytest.raises(Exception, match="outside 0 to 65535"):
            storage.to_chunks(spark.createDataFrame([(0, 0, 0, 0, v)], "c int, z int, y int, x int, v int"), (2, 4, 4), {"z": 2, "y": 4, "x": 4}).collect()
    with pytest.raises(Exception, match="more than one value"):
        storage.to_chunks(spark.createDataFrame([(0, 0, 1, 1, 5), (0, 0, 1, 1, 6)], "c int, z int, y int, x int, v int"), (2, 4, 4), {"z": 2, "y": 4, "x": 4}).collect()
    same = storage.to_chunks(spark.createDataFrame([(0, 0, 1, 1, 5), (0, 0, 1, 1, 5)], "c int, z int, y int, x int, v int"), (2, 4, 4), {"z": 2, "y": 4, "x": 4})
    assert [r["v"] for r in storage.to_voxels(same).collect()] == [5]
