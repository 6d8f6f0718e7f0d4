"""Chunked-array folders (version 2) as a Spark data source that reads and writes: one level of an image, (c, z, y, x) or fewer axes.

Reading goes chunk by chunk along all axes, from any store that pyarrow.fs
knows. Writing puts chunks into a folder beside the level, under names that a
second attempt of a task writes again, and moves that folder into place once
all tasks are done; chunks of zeros are not stored.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from voxloom.schemas import CHUNKS, U16_MAX
from voxloom.sources.planes import Planes, _batches

#: Bytes of voxels that a partition of a read holds, about.
PARTITION = 1 << 27
#: The bits of a frame's flags, its compressors by number, and when a block is split by bytes.
SHUFFLED, COPIED, BITS_SHUFFLED, WHOLE = 1, 2, 4, 16
INNER = {0: "blosclz", 1: "lz4", 2: "snappy", 3: "zlib", 4: "zstd"}
MOST_SPLITS, LEAST_SPLIT = 16, 128


def located(path: str) -> tuple[fs.FileSystem, str]:
    """The store of a path, and its path there."""
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path.removeprefix("file:"))


def loaded(store: fs.FileSystem, path: str) -> bytes | None:
    """A file's bytes; None where it is not there."""
    if store.get_file_info(path).type != fs.FileType.File:
        return None
    with store.open_input_stream(path) as f:
        return f.read()


def saved(store: fs.FileSystem, path: str, data: bytes) -> None:
    store.create_dir(path.rpartition("/")[0], recursive=True)
    with store.open_output_stream(path) as f:
        f.write(data)


def inflated(raw: bytes, how: str, size: int) -> bytes:
    """`size` bytes from one compressed block."""
    if how == "zlib":
        return zlib.decompress(raw, 47)
    if how == "zstd":
        import zstandard

        return zstandard.ZstdDecompressor().decompress(raw, size)
    if how in ("lz4", "snappy"):
        return pa.decompress(raw, size, "lz4_raw" if how == "lz4" else how, asbytes=True)
    raise NotImplementedError(f"blocks compressed by {how}")


def unshuffled(data: bytes, width: int, flags: int) -> bytes:
    """A block whose elements' bytes, or bits, were stored one plane after the other; what is left of an element at the end is as it was."""
    n = len(data) // width
    body, rest = np.frombuffer(data, np.uint8, n * width), data[n * width :]
    if flags & BITS_SHUFFLED:
        if n % 8 or not n:
            return data
        bits = np.unpackbits(body.reshape(8 * width, n // 8), axis=1, bitorder="little")
        return np.packbits(bits.T, axis=1, bitorder="little").tobytes() + rest
    if flags & SHUFFLED and width > 1:
        return body.reshape(width, n).T.tobytes() + rest
    return data


def frame(raw: bytes) -> bytes:
    """What a Blosc (version 1) frame holds: blocks that begin where the table behind the header says, in one stream or one per byte of an element."""
    if len(raw) < 16:
        raise ValueError("a frame ends within its header")
    _, _, flags, width, size, block, stored = struct.unpack("<BBBBIII", raw[:16])
    if stored > len(raw):
        raise ValueError(f"a frame of {stored} bytes ends after {len(raw)}")
    if flags & COPIED:
        return raw[16 : 16 + size]
    how, out = INNER.get(flags >> 5, f"compressor {flags >> 5}"), []
    count = -(-size // block) if block else 0
    for k, at in enumerate(struct.unpack(f"<{count}i", raw[16 : 16 + 4 * count])):
        own = min(block, size - k * block)
        split = not flags & WHOLE and width <= MOST_SPLITS and block // width >= LEAST_SPLIT and own == block
        parts = []
        for _ in range(width if split else 1):
            (n,) = struct.unpack("<i", raw[at : at + 4])
            piece, want = raw[at + 4 : at + 4 + n], own // width if split else own
            parts.append(piece if n == want else inflated(piece, how, want))
            at += 4 + n
        out.append(unshuffled(b"".join(parts), width, flags) if flags & (SHUFFLED | BITS_SHUFFLED) else b"".join(parts))
    data = b"".join(out)
    if len(data) != size:
        raise ValueError(f"a frame of {size} bytes held {len(data)}")
    return data


def decoded(raw: bytes, codec: str | None, size: int) -> bytes:
    """A chunk's bytes."""
    if codec is None:
        return raw
    if codec == "blosc":
        return frame(raw)
    if codec == "lz4":
        return inflated(raw[4:], "lz4", struct.unpack("<I", raw[:4])[0])
    if codec in ("zlib", "gzip", "zstd"):
        return inflated(raw, "zlib" if codec == "gzip" else codec, size)
    raise ValueError(f"compressor {codec} is not supported")


@dataclass
class Layout:
    """How a level's folder is laid out, with four axes (c, z, y, x)."""

    shape: list[int]
    chunks: list[int]
    more: int  # axes of length 1 before, or (negative) axes that are not there
    dtype: np.dtype
    codec: str | None
    separator: str
    order: str

    @classmethod
    def read(cls, store: fs.FileSystem, folder: str) -> Layout:
        raw = loaded(store, f"{folder}/.zarray")
        if raw is None:
            raise FileNotFoundError(f"{folder}/.zarray")
        m = json.loads(raw)
        more = len(m["shape"]) - 4
        if len(m["shape"]) < 3 or any(n != 1 for n in m["shape"][: max(0, more)]):
            raise ValueError(f"{folder} has axes {m['shape']}, not (c, z, y, x)")
        if m.get("filters") or m.get("fill_value") not in (0, None, False):
            raise ValueError(f"{folder} has filters, or voxels other than 0 that are not stored")
        dtype = np.dtype(m["dtype"])
        if dtype.kind not in "uib":
            raise ValueError(f"{folder} holds {dtype}, not whole numbers")
        ones = [1] * max(0, -more)
        return cls([*ones, *m["shape"][max(0, more) :]], [*ones, *m["chunks"][max(0, more) :]], more, dtype, (m.get("compressor") or {}).get("id"), m.get("dimension_separator", "."), m.get("order", "C"))

    @property
    def grid(self) -> list[int]:
        return [-(-n // k) for n, k in zip(self.shape, self.chunks, strict=True)]

    def key(self, at: tuple[int, ...]) -> str:
        return self.separator.join(map(str, [*[0] * max(0, self.more), *at[max(0, -self.more) :]]))


class ArrayReader(DataSourceReader):
    def __init__(self, options: dict):
        o = {k.lower(): v for k, v in options.items()}
        self.level, self.image = int(o.get("level", 0)), o.get("image", o["path"].rstrip("/").rpartition("/")[2])
        self.dir = f"{o['path'].rstrip('/')}/{self.level}"

    def partitions(self) -> list[InputPartition]:
        store, at = located(self.dir)
        layout = Layout.read(store, at)
        n, per = int(np.prod(layout.grid)), max(1, PARTITION // max(1, 2 * int(np.prod(layout.chunks))))
        return [Planes(i, min(n, i + per), layout) for i in range(0, n, per)]

    def read(self, partition: Planes) -> Iterator[pa.RecordBatch]:
        layout: Layout = partition.more
        store, folder = located(self.dir)

        def rows() -> Iterator[tuple]:
            for k in range(partition.first, partition.last):
                at = tuple(int(i) for i in np.unravel_index(k, layout.grid))
                if (raw := loaded(store, f"{folder}/{layout.key(at)}")) is None:
                    continue
                a = np.frombuffer(decoded(raw, layout.codec, layout.dtype.itemsize * int(np.prod(layout.chunks))), layout.dtype).reshape(layout.chunks, order=layout.order)
                o = [i * n for i, n in zip(at, layout.chunks, strict=True)]
                a = a[tuple(slice(0, s - i) for i, s in zip(o, layout.shape, strict=True))]
                if a.size and (a.min() < 0 or a.max() > U16_MAX):
                    raise ValueError(f"{self.dir} has voxels outside 0 to {U16_MAX}")
                for c, p in enumerate(a, o[0]):
                    if p.any():
                        yield (self.image, self.level, c, *at[1:], *o[1:], *p.shape, np.ascontiguousarray(p).astype("<u2").tobytes())

        return _batches(rows(), 4)


@dataclass
class Written(WriterCommitMessage):
    chunks: int


class ArrayWriter(DataSourceArrowWriter):
    """Options: path, level, shape and chunks as JSON lists (c, z, y, x), and the level of zstd compression. Rows are whole chunks of these sizes."""

    def __init__(self, options: dict, overwrite: bool):
        o = {k.lower(): v for k, v in options.items()}
        self.shape, self.chunks, self.zstd = json.loads(o["shape"]), json.loads(o["chunks"]), int(o.get("compression_level", 3))
        self.dir, self.overwrite = f"{o['path'].rstrip('/')}/{int(o.get('level', 0))}", overwrite
        self.made = f"{self.dir}.new-{uuid.uuid4().hex}"
        store, at = located(self.dir)
        if not overwrite and store.get_file_info(at).type != fs.FileType.NotFound:
            raise FileExistsError(self.dir)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        import zstandard

        (store, at), n = located(self.made), 0
        packed = zstandard.ZstdCompressor(level=self.zstd)
        for b in iterator:
            for r in b.to_pylist():
                a = np.frombuffer(r["data"], "<u2").reshape(r["nz"], r["ny"], r["nx"])
                corner = [r[f"c{k}"] * s for k, s in zip("zyx", self.chunks[1:], strict=True)]
                if corner != [r["z0"], r["y0"], r["x0"]] or any(i > j for i, j in zip(a.shape, self.chunks[1:], strict=True)):
                    raise ValueError(f"a chunk at {[r['z0'], r['y0'], r['x0']]} of {a.shape} is no whole chunk of {self.chunks[1:]}")
                if not a.any():
                    continue
                full = np.zeros(self.chunks[1:], "<u2")
                full[tuple(map(slice, a.shape))] = a
                saved(store, f"{at}/{r['c']}/{r['cz']}/{r['cy']}/{r['cx']}", packed.compress(full.tobytes()))
                n += 1
        return Written(n)

    def commit(self, messages: list) -> None:
        store, new = located(self.made)
        meta = {"zarr_format": 2, "shape": self.shape, "chunks": self.chunks, "dtype": "<u2", "compressor": {"id": "zstd", "level": self.zstd}, "fill_value": 0, "order": "C", "filters": None, "dimension_separator": "/"}
        saved(store, f"{new}/.zarray", json.dumps(meta).encode())
        _, to = located(self.dir)
        if store.get_file_info(to).type != fs.FileType.NotFound:
            store.delete_dir(to)
        store.move(new, to)

    def abort(self, messages: list) -> None:
        store, new = located(self.made)
        if store.get_file_info(new).type != fs.FileType.NotFound:
            store.delete_dir(new)


class ArraySource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "voxzarr"

    def schema(self) -> str:
        return CHUNKS

    def reader(self, schema) -> DataSourceReader:
        return ArrayReader(self.options)

    def writer(self, schema, overwrite: bool) -> ArrayWriter:
        return ArrayWriter(self.options, overwrite)
