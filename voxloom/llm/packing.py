"""Best-fit packing of tokenised documents into sequences of a fixed capacity.

Lengths are whole numbers up to the capacity, so the plan is made on the counts
of lengths alone (at most `capacity` numbers, however many documents there
are): pieces above a third of the capacity are matched greedily, at most two
to a sequence, longest first with the longest partner that fits; shorter ones
then go, longest first, into the smallest gap that takes them, and into new
sequences where none does. The plan says, for each length, which ranks go to
which sequences and at what offset; every piece finds its place by its rank
among pieces of its length, counted range by range of rows.

Edge cases: a null or empty text is one piece, its end id; longer documents
are cut into pieces of the capacity; repeated rows are packed as often as they
occur; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from voxloom.llm.common import materialise, ranged_total
from voxloom.llm.tokens import encode_column

CAPACITY = 4096


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Rows (length, first rank, first sequence, per sequence, offset) that cover the ranks 0 to counts[length] - 1 of every length.

    A row holds up to the next row's first rank of that length: rank r goes to
    sequence first + (r - first rank) // per, at offset + ((r - first rank) % per) * length.
    """
    left = {n: c for n, c in counts.items() if c > 0}
    used: dict[int, int] = dict.fromkeys(left, 0)
    rows: list[tuple[int, int, int, int, int]] = []
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap -> (first sequence, how many), all alike
    sizes: list[int] = []  # gaps there are, ascending
    n_seq = 0

    def put(n: int, seq: int, many: int, per: int, offset: int) -> None:
        """many sequences from seq on take per pieces of length n each."""
        rows.append((n, used[n], seq, per, offset))
        used[n] += many * per
        left[n] -= many * per

    def keep(gap: int, seq: int, many: int) -> None:
        if many and gap:
            if gap not in gaps:
                bisect.insort(sizes, gap)
                gaps[gap] = []
            gaps[gap].append((seq, many))

    large = sorted(n for n in left if 3 * n > capacity)
    for n in reversed(large):  # longest first
        while left[n]:
            i = bisect.bisect_right(large, min(n, capacity - n)) - 1
            while i >= 0 and not left[large[i]]:
                i -= 1
            if i < 0 or large[i] == n and left[n] == 1:
                j = i - 1 if i >= 0 else -1  # a single one can't be its own partner
                while j >= 0 and not left[large[j]]:
                    j -= 1
                i = j
            if i < 0:
                many = left[n]
                put(n, n_seq, many, 1, 0)
                keep(capacity - n, n_seq, many)
            elif large[i] == n:
                many = left[n] // 2
                put(n, n_seq, many, 2, 0)
                keep(capacity - 2 * n, n_seq, many)
            else:
                p = large[i]
                many = min(left[n], left[p])
                put(n, n_seq, many, 1, 0)
                put(p, n_seq, many, 1, n)
                keep(capacity - n - p, n_seq, many)
            n_seq += many
    for n in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        while left[n]:
            i = bisect.bisect_left(sizes, n)
            if i == len(sizes):
                per = min(capacity // n, left[n])
                many = left[n] // per
                put(n, n_seq, many, per, 0)
                keep(capacity - per * n, n_seq, many)
                n_seq += many
                continue
            gap = sizes[i]
            seq, there = gaps[gap].pop()
            per = min(gap // n, left[n])
            many = min(there, left[n] // per)
            put(n, seq, many, per, capacity - gap)
            keep(gap - per * n, seq, many)
            keep(gap, seq + many, there - many)
            if not gaps[gap]:
                del gaps[gap], sizes[bisect.bisect_left(sizes, gap)]
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def pieces(docs: DataFrame, tokenizer: str, text: str = "text", key: str = "doc_id", capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids): every document's ids with the end id, cut at multiples of the capacity; ids as little-endian unsigned 32-bit numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = 4 * capacity
        for b in batches:
            keys, at = b.column(0), 0
            for part in encode_column(tokenizer, b.column(1)):
                rows = [(at + i, k // step, k // 4, ids[k : k + step]) for i, ids in enumerate(part) for k in range(0, len(ids), step)]
                at += len(part)
                cols = [keys.take(pa.array([r[0] for r in rows], pa.int64())), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.int64())]
                yield pa.RecordBatch.from_arrays([*cols, pa.array([len(r[3]) // 4 for r in rows], pa.int64()), pa.array([r[3] for r in rows], pa.binary())], names=["doc_id", "piece", "start", "length", "ids"])

    d = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    schema = StructType([StructField("doc_id", d.schema["doc_id"].dataType), *StructType.fromDDL("piece int, start long, length long").fields, StructField("ids", BinaryType())])
    return d.mapInArrow(run, schema)


def place(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """cut (doc_id, piece, start, length and more, stored) with sequence_id and offset."""
    counts = {r[0]: r[1] for r in cut.groupBy("length").count().collect()}  # at most `capacity` rows
    table = plan(counts, capacity)
    others = [x for x in cut.columns if x not in ("length", "doc_id", "piece", "ids")]
    c = cut.withColumn("p_mixed", F.xxhash64("doc_id", "piece")).withColumn("p_one", F.lit(1).cast("long"))
    c = ranged_total(c, ["length"], ["length", "p_mixed", "doc_id", "piece", *others], "p_one", "p_rank")
    names = list(cut.columns)
    key, rest = table[:, 0] * (1 << 48) + table[:, 1], table[:, 1:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, r = b.column("length").to_numpy(), b.column("p_rank").to_numpy() - 1
            first, seq, per, off = rest[np.searchsorted(key, n * (1 << 48) + r, side="right") - 1].T
            cols = [*(b.column(x) for x in names), pa.array(seq + (r - first) // per, pa.int64()), pa.array(off + (r - first) % per * n, pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, names=[*names, "sequence_id", "offset"])

    return c.drop("p_mixed", "p_one").mapInArrow(run, StructType([*cut.schema.fields, StructField("sequence_id", LongType()), StructField("offset", LongType())]))


def pack(docs: DataFrame, tokenizer: str, text: str = "text", key: str = "doc_id", capacity: int = CAPACITY, ids: bool = True) -> DataFrame:
    """The placed pieces of all documents. ids=False keeps the pieces' crc32 (ids_crc32) in place of their ids, which makes what is stored and shuffled small."""
    cut = pieces(docs, tokenizer, text, key, capacity)
    if not ids:
        cut = cut.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return place(materialise(cut), capacity)


def sequences(placed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the ids of each sequence's pieces one after the other; a group holds at most `capacity` ids."""
    g = placed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("p"))
    return g.select("sequence_id", F.unhex(F.array_join(F.transform("p", lambda x: F.hex(x["ids"])), "")).alias("ids"))
