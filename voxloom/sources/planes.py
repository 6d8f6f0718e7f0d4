"""Image files as Spark data sources: raw 16-bit stacks, TIFF, h5. Chunked-array folders are in `arrays`."""

from __future__ import annotations

import json
import re
import struct
import zlib
from collections.abc import Iterator
from pathlib import Path
from typing import BinaryIO

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from voxloom.schemas import CHUNKS


class Planes(InputPartition):
    """A range of planes; more says what else a reader needs to find them."""

    def __init__(self, first: int, last: int, more: object = None):
        self.first, self.last, self.more = first, last, more


def opened(path: str) -> BinaryIO:
    """A file to read from and seek in: local, or in a store that pyarrow.fs knows where the path has a scheme."""
    if "://" not in path:
        return open(path, "rb")
    from pyarrow import fs

    store, at = fs.FileSystem.from_uri(path)
    return store.open_input_file(at)


def _at(f: BinaryIO, where: int, size: int) -> bytes:
    f.seek(where)
    return f.read(size)


def _row(image: str, c: int, z: int, plane: np.ndarray, size: tuple[int, int]) -> Iterator[tuple]:
    """Chunks one plane deep."""
    for y in range(0, plane.shape[0], size[0]):
        for x in range(0, plane.shape[1], size[1]):
            p = plane[y : y + size[0], x : x + size[1]]
            if p.any():
                yield (image, 0, c, z, y // size[0], x // size[1], z, y, x, 1, *p.shape, p.astype("<u2").tobytes())


def _batches(rows: Iterator[tuple], step: int = 32) -> Iterator[pa.RecordBatch]:
    names = [f.split()[0] for f in CHUNKS.split(", ")]
    kinds = [pa.string(), *[pa.int32()] * 11, pa.binary()]
    held: list[tuple] = []
    for r in rows:
        held.append(r)
        if len(held) == step:
            yield pa.RecordBatch.from_arrays([pa.array([h[i] for h in held], k) for i, k in enumerate(kinds)], names=names)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array([h[i] for h in held], k) for i, k in enumerate(kinds)], names=names)


class _StackReader(DataSourceReader):
    """Planes of a stack in ranges, each a partition."""

    def __init__(self, options: dict):
        self.o = {k.lower(): v for k, v in options.items()}
        self.path, self.c, self.image = self.o["path"], int(self.o.get("channel", 0)), self.o.get("image", Path(self.o["path"]).stem)
        self.size, self.per = (int(self.o.get("chunk_y", 1024)), int(self.o.get("chunk_x", 1024))), int(self.o.get("planes", 16))

    def planes(self, p: Planes) -> Iterator[np.ndarray]:
        raise NotImplementedError

    def read(self, partition: Planes) -> Iterator[pa.RecordBatch]:
        return _batches(r for z, p in enumerate(self.planes(partition), partition.first) for r in _row(self.image, self.c, z, p, self.size))


class RawReader(_StackReader):
    """Little-endian unsigned 16-bit (z, y, x); options nz, ny, nx. A partition reads its planes only, one at a time."""

    def partitions(self) -> list[InputPartition]:
        n = int(self.o["nz"])
        return [Planes(i, min(n, i + self.per)) for i in range(0, n, self.per)]

    def planes(self, p: Planes) -> Iterator[np.ndarray]:
        ny, nx = int(self.o["ny"]), int(self.o["nx"])
        with opened(self.path) as f:
            for z in range(p.first, p.last):
                raw = _at(f, z * ny * nx * 2, ny * nx * 2)
                if len(raw) < ny * nx * 2:
                    raise ValueError(f"{self.path} ends within plane {z}")
                yield np.frombuffer(raw, "<u2").reshape(ny, nx)


#: Forms of a field's values by type, for counts, offsets and text.
FORMS = {1: "B", 2: "B", 3: "H", 4: "I", 13: "I", 16: "Q", 18: "Q"}


def tiff_pages(f: BinaryIO) -> tuple[str, list[dict[int, list[int]]]]:
    """Byte order and the tags of each page (number -> values) of a TIFF, with offsets of 32 or 64 bits; only the directories are read.

    A single directory whose description tells of more images stands for that
    many planes, one behind the other, as stacks above 4 GB are written too.
    """
    head = _at(f, 0, 16)
    e = "<" if head[:2] == b"II" else ">"
    magic = struct.unpack(e + "H", head[2:4])[0] if head[:2] in (b"II", b"MM") else 0
    if magic not in (42, 43):
        raise ValueError("not a TIFF")
    word, count, lead = ("I", "H", 4) if magic == 42 else ("Q", "Q", 8)  # offsets, number of fields, and where the first offset is
    size, room = struct.calcsize(word), 4 if magic == 42 else 8
    at, pages, seen = struct.unpack(e + word, head[lead : lead + size])[0], [], set()
    while at:
        if at in seen:
            raise ValueError("directories go round in a circle")
        seen.add(at)
        (n,) = struct.unpack(e + count, _at(f, at, struct.calcsize(count)))
        step = 4 + 2 * room
        raw, tags = _at(f, at + struct.calcsize(count), step * n + size), {}
        for k in range(n):
            field = raw[step * k : step * (k + 1)]
            tag, kind, many = struct.unpack(f"{e}HH{word}", field[: 4 + room])
            if kind in FORMS:
                form = f"{e}{many}{FORMS[kind]}"
                long = struct.calcsize(form)
                value = field[4 + room : 4 + room + long] if long <= room else _at(f, struct.unpack(e + word, field[4 + room :])[0], long)
                tags[tag] = list(struct.unpack(form, value))
        pages.append(tags)
        (at,) = struct.unpack(e + word, raw[step * n :])
    told = re.search(rb"(?:^|\n)images=(\d+)", bytes(pages[0].get(270, []))) if len(pages) == 1 else None
    if told and int(told[1]) > 1 and pages[0].get(259, [1])[0] == 1 and 273 in pages[0]:
        t = pages[0]
        plane = t[256][0] * t[257][0] * t.get(258, [1])[0] // 8
        pages = [{**t, 273: [t[273][0] + k * plane], 279: [plane], 278: [t[257][0]]} for k in range(int(told[1]))]
    return e, pages


def lzw(raw: bytes) -> bytes:
    """TIFF's LZW: codes of 9 to 12 bits, high bit first, that grow one code early; 256 starts over and 257 ends."""
    out, table, before = bytearray(), [], b""
    bits = held = 0
    width = 9
    for byte in raw:
        held, bits = held << 8 | byte, bits + 8
        if bits < width:
            continue
        bits -= width
        code, held = held >> bits, held & (1 << bits) - 1
        if code == 257:
            break
        if code == 256:
            table, before, width = [], b"", 9
            continue
        if code < 256:
            word = bytes([code])
        elif code - 258 < len(table):
            word = table[code - 258]
        elif before and code - 258 == len(table):
            word = before + before[:1]
        else:
            raise ValueError("an LZW code that is not there")
        if before:
            table.append(before + word[:1])
        out += word
        before = word
        width = min(12, max(9, (259 + len(table)).bit_length()))
    return bytes(out)


def packbits(raw: bytes) -> bytes:
    """Runs: a byte below 128 says that one more than so many follow, one above 128 how often the next is repeated."""
    out, k = bytearray(), 0
    while k < len(raw):
        n = raw[k]
        if n < 128:
            out += raw[k + 1 : k + 2 + n]
            k += 2 + n
        else:
            out += raw[k + 1 : k + 2] * (257 - n) if n > 128 else b""
            k += 2 if n > 128 else 1
    return bytes(out)


def _zstd(raw: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdDecompressor().decompressobj().decompress(raw)


#: Compressions by number.
COMPRESSIONS = {1: bytes, 5: lzw, 8: zlib.decompress, 32946: zlib.decompress, 32773: packbits, 50000: _zstd}


def tiff_plane(f: BinaryIO, e: str, tags: dict[int, list[int]]) -> np.ndarray:
    """Page of 8- or 16-bit grey strips or tiles, compressed or not, with or without horizontal differences; only they are read."""
    width, height, bits, how, ahead = tags[256][0], tags[257][0], tags.get(258, [1])[0], tags.get(259, [1])[0], tags.get(317, [1])[0]
    if bits not in (8, 16) or how not in COMPRESSIONS or ahead not in (1, 2) or tags.get(277, [1])[0] != 1:
        raise ValueError(f"TIFF with {bits} bits, {tags.get(277, [1])[0]} samples, compression {how} and predictor {ahead} is not supported")
    tiled = 324 in tags
    across, down = (tags[322][0], tags[323][0]) if tiled else (width, min(height, tags.get(278, [height])[0]))
    places, sizes = (tags[324], tags[325]) if tiled else (tags[273], tags[279])
    out, row = np.zeros((height, width), np.uint16), -(-width // across)
    for k, (at, n) in enumerate(zip(places, sizes, strict=True)):
        y, x = k // row * down, k % row * across
        rows = down if tiled else min(down, height - y)
        a = np.frombuffer(COMPRESSIONS[how](_at(f, at, n)), f"{e}u{bits // 8}", rows * across).reshape(rows, across)
        if ahead == 2:
            a = np.cumsum(a, axis=1, dtype=a.dtype.newbyteorder("="))
        p = a[: height - y, : width - x]
        out[y : y + p.shape[0], x : x + p.shape[1]] = p
    return out


class TiffReader(_StackReader):
    """A page per plane. The driver goes along the directories once; a partition gets those of its pages."""

    def partitions(self) -> list[InputPartition]:
        with opened(self.path) as f:
            e, pages = tiff_pages(f)
        return [Planes(i, min(len(pages), i + self.per), (e, pages[i : i + self.per])) for i in range(0, len(pages), self.per)]

    def planes(self, p: Planes) -> Iterator[np.ndarray]:
        e, pages = p.more
        with opened(self.path) as f:
            for tags in pages:
                yield tiff_plane(f, e, tags)


def _source(label: str, kind: type) -> type[DataSource]:
    class Source(DataSource):
        @classmethod
        def name(cls) -> str:
            return label

        def schema(self) -> str:
            return CHUNKS

        def reader(self, schema) -> DataSourceReader:
            return kind(self.options)

    return Source


def register(spark: SparkSession) -> None:
    """Make the formats voxraw, voxtiff, voxzarr and voxh5 known to spark.read.format(), and voxzarr to write.format()."""
    from voxloom.sources.arrays import ArraySource

    for label, kind in (("voxraw", RawReader), ("voxtiff", TiffReader), ("voxh5", H5Reader)):
        spark.dataSource.register(_source(label, kind))
    spark.dataSource.register(ArraySource)


def h5_available() -> bool:
    try:
        import h5py  # noqa: F401
    except ImportError:
        return False
    return True


def h5_layout(n_tiles: int, n_channels: int) -> list[tuple[int, int, str]]:
    """(channel, tile, dataset) of a multi-tile h5 file: tiles are split evenly by channel."""
    if n_tiles % n_channels:
        raise ValueError(f"{n_tiles} tiles can't be split over {n_channels} channels")
    per = n_tiles // n_channels
    return [(k // per, k % per, f"t00000/s{k:02}/0/cells") for k in range(n_tiles)]


class H5Reader(_StackReader):
    """Datasets (z, y, x) of one h5 file, option `datasets`: JSON rows [channel, tile, dataset]; a chunk's image is its tile. Needs h5py."""

    def partitions(self) -> list[InputPartition]:
        import h5py

        out: list[InputPartition] = []
        with h5py.File(self.path, "r") as f:
            for c, tile, name in json.loads(self.o["datasets"]):
                n = f[name].shape[0]
                out += [Planes(i, min(n, i + self.per), (c, tile, name)) for i in range(0, n, self.per)]
        return out

    def read(self, partition: Planes) -> Iterator[pa.RecordBatch]:
        import h5py

        c, tile, name = partition.more

        def rows() -> Iterator[tuple]:
            with h5py.File(self.path, "r") as f:
                for z in range(partition.first, partition.last):
                    yield from _row(str(tile), c, z, np.asarray(f[name][z]).astype(np.uint16), self.size)

        return _batches(rows())
