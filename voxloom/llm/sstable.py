"""Token ids in sorted-string-table shards.

Documents are range-sorted by identifier; every partition becomes one shard
file in a shared folder. A shard is

    magic | blocks | block index | Bloom filter | footer

A block holds entries in key order, each key without the prefix it shares with
the key before it, and is compressed on its own. The block index holds each
block's first key, place and size (one entry per block, so it is sparse); the
Bloom filter answers for absent keys; the footer, of fixed size, says where
index and filter are and how many documents and ids the shard has. A lookup
reads footer, filter and index, finds the block by binary search and decodes
that block only.

Tasks name their files after their attempt and return one manifest row each;
only files in the stored manifest count, so lost executors and repeated
attempts leave no wrong shard behind.

Edge cases: a null or empty text has the end id alone; a null identifier sorts
first; documents that share an identifier stay separate entries, ordered by a
hash of their text; an id that does not fit in the bytes given to each is an
error; an empty table gives no shard; other columns are ignored.
"""

from __future__ import annotations

import struct
import uuid
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from voxloom.llm.common import materialise, shared_dir
from voxloom.llm.tokens import encode_column

MAGIC = b"VXSST001"
FOOTER = struct.Struct("<QQQQQQQI4x8s")  # index at, index size, filter at, filter size, documents, ids, blocks, bytes per id, magic
BLOCK_BYTES = 1 << 16
BLOOM_BITS, BLOOM_HASHES = 10, 7

MANIFEST = "shard int, path string, n_docs long, n_ids long, first binary, last binary"


def encode_key(key: int | str | None) -> bytes:
    """Bytes that sort like the keys: null, then whole numbers, then strings by code point."""
    if key is None:
        return b"\x00"
    return b"\x01" + (key + (1 << 63)).to_bytes(8, "big") if isinstance(key, int) else b"\x02" + key.encode()


def decode_key(raw: bytes) -> int | str | None:
    return None if raw[0] == 0 else int.from_bytes(raw[1:], "big") - (1 << 63) if raw[0] == 1 else raw[1:].decode()


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _read_varint(raw: bytes, at: int) -> tuple[int, int]:
    n = shift = 0
    while True:
        b = raw[at]
        at += 1
        n |= (b & 127) << shift
        if b < 128:
            return n, at
        shift += 7


def _places(key: bytes, bits: int) -> list[int]:
    import xxhash

    h = xxhash.xxh3_128_intdigest(key)
    a, b = h & (1 << 64) - 1, h >> 64 | 1
    return [(a + i * b) % bits for i in range(BLOOM_HASHES)]


class ShardWriter:
    """Writes one shard to a stream; add() takes keys in ascending order."""

    def __init__(self, stream, id_bytes: int = 2):
        import zstandard

        self.stream, self.id_bytes, self.compress = stream, id_bytes, zstandard.ZstdCompressor(level=1).compress
        self.block, self.index, self.keys = [], [], []
        self.raw = self.n_docs = self.n_ids = 0
        self.at, self.last = len(MAGIC), b""
        stream.write(MAGIC)

    def add(self, key: bytes, ids: bytes) -> None:
        """ids: little-endian unsigned 32-bit; stored in id_bytes bytes each."""
        value = np.frombuffer(ids, "<u4")
        if len(value) and int(value.max()) >> 8 * self.id_bytes:
            raise ValueError(f"id {value.max()} needs more than {self.id_bytes} bytes")
        self.n_docs += 1
        self.n_ids += len(value)
        if not self.block:
            self.first, shared = key, 0
        else:
            shared = next((i for i, (a, b) in enumerate(zip(key, self.last, strict=False)) if a != b), min(len(key), len(self.last)))
        value = value.astype(f"<u{self.id_bytes}").tobytes()
        self.block += [_varint(shared), _varint(len(key) - shared), key[shared:], _varint(len(value)), value]
        self.raw += len(value)
        self.last = key
        self.keys.append(key)
        if self.raw >= BLOCK_BYTES:
            self.flush()

    def flush(self) -> None:
        if self.block:
            x = self.compress(b"".join(self.block))
            self.stream.write(x)
            self.index.append((self.first, self.at, len(x)))
            self.at += len(x)
            self.block, self.raw = [], 0

    def close(self) -> None:
        self.flush()
        index = b"".join(_varint(len(k)) + k + _varint(at) + _varint(n) for k, at, n in self.index)
        bits = max(64, BLOOM_BITS * len(self.keys) + 7 & ~7)
        bloom = bytearray(bits // 8)
        for k in self.keys:
            for p in _places(k, bits):
                bloom[p >> 3] |= 1 << (p & 7)
        self.stream.write(index + bytes(bloom))
        self.stream.write(FOOTER.pack(self.at, len(index), self.at + len(index), len(bloom), self.n_docs, self.n_ids, len(self.index), self.id_bytes, MAGIC))


class Shard:
    """Reads a shard from a random-access file."""

    def __init__(self, file, size: int):
        import zstandard

        self.file, self.decompress = file, zstandard.ZstdDecompressor().decompress
        file.seek(size - FOOTER.size)
        at, n, self.bloom_at, self.bloom_n, self.n_docs, self.n_ids, blocks, self.id_bytes, magic = FOOTER.unpack(file.read(FOOTER.size))
        if magic != MAGIC:
            raise ValueError("not a shard, or cut short")
        raw, i, self.index = self._read(at, n), 0, []
        for _ in range(blocks):
            k, i = _read_varint(raw, i)
            key, i = raw[i : i + k], i + k
            where, i = _read_varint(raw, i)
            long, i = _read_varint(raw, i)
            self.index.append((key, where, long))

    def _read(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        return self.file.read(n)

    def entries(self, block: int) -> Iterator[tuple[bytes, bytes]]:
        _, at, n = self.index[block]
        raw, i, key = self.decompress(self._read(at, n)), 0, b""
        while i < len(raw):
            shared, i = _read_varint(raw, i)
            k, i = _read_varint(raw, i)
            key, i = key[:shared] + raw[i : i + k], i + k
            v, i = _read_varint(raw, i)
            yield key, np.frombuffer(raw, f"<u{self.id_bytes}", v // self.id_bytes, i).astype("<u4").tobytes()
            i += v

    def __iter__(self) -> Iterator[tuple[bytes, bytes]]:
        for b in range(len(self.index)):
            yield from self.entries(b)

    def may_hold(self, key: bytes) -> bool:
        bloom = self._read(self.bloom_at, self.bloom_n)
        return all(bloom[p >> 3] >> (p & 7) & 1 for p in _places(key, len(bloom) * 8))

    def get(self, key: bytes) -> list[bytes]:
        """Ids of all documents with this key."""
        if not self.index or not self.may_hold(key):
            return []
        firsts, out = [x[0] for x in self.index], []
        b = max(0, bisect_right(firsts, key) - 1)
        while b and firsts[b] == key:  # the key may have begun in the block before
            b -= 1
        while b < len(firsts) and firsts[b] <= key:
            out += [v for k, v in self.entries(b) if k == key]
            b += 1
        return out


def _open(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def open_shard(uri: str) -> Shard:
    store, path = _open(uri)
    f = store.open_input_file(path)
    return Shard(f, f.size())


def write(docs: DataFrame, tokenizer: str, folder: str | None = None, text: str = "text", key: str = "doc_id", id_bytes: int = 2) -> DataFrame:
    """Write all documents as shards in a shared folder; the stored manifest: one row per shard, in key order."""
    folder = folder or f"{shared_dir(docs.sparkSession)}/shards"
    d = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")).withColumn("h", F.xxhash64("text"))
    dealt = d.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h").drop("h")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, writer, first = TaskContext.get().partitionId(), None, None
        for b in batches:
            keys, at = b.column(0).to_pylist(), 0
            for ids in encode_column(tokenizer, b.column(1)):
                for k, x in zip(keys[at : at + len(ids)], ids, strict=True):
                    if writer is None:
                        store, path = _open(folder)
                        store.create_dir(path, recursive=True)
                        name = f"shard-{part:06d}-{uuid.uuid4().hex[:8]}.vxsst"
                        stream = store.open_output_stream(f"{path}/{name}")
                        writer, first = ShardWriter(stream, id_bytes), encode_key(k)
                    writer.add(encode_key(k), x)
                at += len(ids)
        if writer is not None:
            writer.close()
            stream.close()
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([f"{folder}/{name}"]), pa.array([writer.n_docs], pa.int64()), pa.array([writer.n_ids], pa.int64()), pa.array([first], pa.binary()), pa.array([writer.last], pa.binary())], names=["shard", "path", "n_docs", "n_ids", "first", "last"])

    return materialise(dealt.mapInArrow(run, MANIFEST))


def read(spark: SparkSession, manifest: DataFrame, kind=LongType()) -> DataFrame:
    """(doc_id, start, ids) of all shards in the manifest; start counts the ids before the document. A task per shard."""
    shards, start = [], 0
    for r in sorted(manifest.collect(), key=lambda r: r["shard"]):  # one row per shard
        shards.append((r["path"], start))
        start += r["n_ids"]
    schema = StructType([StructField("doc_id", kind), StructField("start", LongType()), StructField("ids", BinaryType())])
    if not shards:
        return spark.createDataFrame([], schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in b.column(0).to_pylist():
                path, at = shards[i]
                shard, rows = open_shard(path), []
                for n in range(len(shard.index)):
                    for k, ids in shard.entries(n):
                        rows.append((decode_key(k), at, ids))
                        at += len(ids) // 4
                    if len(rows) >= 2_000 or n == len(shard.index) - 1 or sum(len(r[2]) for r in rows[-8:]) > 1 << 22:
                        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64() if isinstance(kind, LongType) else pa.string()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.binary())], names=["doc_id", "start", "ids"])
                        rows = []

    return spark.range(0, len(shards), 1, len(shards)).mapInArrow(run, schema)


def lookup(manifest: DataFrame, doc_id: int | str | None) -> list[bytes]:
    """Ids of all documents with this identifier, by binary search over shards and blocks."""
    key, out = encode_key(doc_id), []
    for r in manifest.where((F.col("first") <= F.lit(key)) & (F.col("last") >= F.lit(key))).collect():
        out += open_shard(r["path"]).get(key)
    return out
