"""Alignment of two tokenizers' tokens over the same bytes.

Every byte of a text gets the number of the A token and of the B token that
holds it (byte-owner arrays, by np.repeat of token numbers over their lengths).
Consecutive distinct pairs of owners are the overlaps (links); where both
owners change at once the text is cut into groups. Documents are aligned in
blocks, stored once with each block's distinct pairs of ids and how often they
are linked; the counts of pairs over the whole corpus come from these, and go
back to the blocks by a join on the pair, so what is shuffled is a row per
block and pair, not per token.

Edge cases: texts that are null or empty, and those whose tokens do not spell
them (U+2581, which B takes for a space), have no tokens: zeros and ''; special
strings in texts are plain text; texts of any length are aligned whole (a long
one is a block of its own); repeated rows and ids count as often as they occur;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from struct import pack

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StringType, StructField, StructType

from voxloom.llm import bpe
from voxloom.llm.common import kept_in_worker, materialise

#: Bytes of text of a block; one longer text is a block of its own.
BLOCK = 1 << 24
#: Pieces between spaces that a Python worker remembers, and the letters of the longest one.
CACHE, CACHE_LETTERS = 400_000, 64
PIECES = re.compile(" +[^ ]*")
#: Fixed value: the letter that stands for a space in piece vocabularies.
SPACE = "▁"
BYTE = re.compile("<0x([0-9A-F]{2})>")


class PieceEncoder:
    """Ids of texts by a piece model, through a memory of pieces of text between spaces."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = m = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [m.id_to_piece(i) for i in range(m.get_piece_size())]
        if any(SPACE in p.lstrip(SPACE) for p in names) or m.encode(" a  b ") != [*m.encode(" a"), *m.encode(" b"), m.piece_to_id(SPACE)]:
            raise ValueError(f"{path} has pieces that go on after a space, or drops spaces")
        self.bytes_of = [bytes([int(x[1], 16)]) if m.is_byte(i) and (x := BYTE.fullmatch(p)) else p.replace(SPACE, " ").encode() for i, p in enumerate(names)]
        self.known: dict[str, bytes | None] = {" ": np.array([m.piece_to_id(SPACE)], "<i4").tobytes()}

    def encode(self, texts: list[str | None]) -> list[np.ndarray | None]:
        """Ids of each text; none where they do not spell it."""
        cut = [PIECES.findall(" " + t) if t else [] for t in texts]
        there = set().union(*cut)
        new = there.difference(self.known)
        if len(self.known) + len(new) > CACHE:  # those that are in use stay
            self.known = {p: self.known[p] for p in {*there.difference(new), " "}}
        known, order, spell = self.known, list(new), self.bytes_of.__getitem__
        for p, ids in zip(order, self.model.encode([p[1:] for p in order], num_threads=1), strict=True):
            known[p] = pack(f"<{len(ids)}i", *ids) if b"".join(map(spell, ids)) == p.encode() else None
        out = []
        for ps in cut:
            ids = [known[p] for p in ps]
            out.append(None if None in ids else np.frombuffer(b"".join(ids), "<i4"))
        for p in [p for p in new if len(p) > CACHE_LETTERS]:
            del known[p]
        return out


@dataclass
class Alignment:
    """Of several texts, one after the other: ids, bytes of each token, links as numbers of tokens, first tokens of the groups, and where each text ends in all of these."""

    a: np.ndarray
    b: np.ndarray
    links_a: np.ndarray
    links_b: np.ndarray
    groups_a: np.ndarray
    groups_b: np.ndarray
    groups_at: np.ndarray  # first byte of each group
    ends: dict[str, np.ndarray]  # by part, with a 0 before: "a", "b", "links", "groups", "bytes"


class Aligner:
    """Aligns texts by a byte-level BPE file (A; a space is put before the text) and a piece model (B)."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = bpe.Encoder(path_a, special=False), PieceEncoder(path_b)
        sizes = self.a.merges.size_of
        self.size_a = np.array([sizes.get(i, 0) for i in range(max(sizes) + 1)])
        self.size_b = np.array([len(x) for x in self.b.bytes_of])
        if max(len(self.size_a), len(self.size_b)) > 1 << 18:
            raise ValueError("vocabularies of more than 2 ** 18 ids")

    def align(self, texts: list[str | None]) -> Alignment:
        none = np.zeros(0, np.int32)
        ids_b = [none if x is None else x for x in self.b.encode(texts)]
        ids_a = [x if len(y) else none for x, y in zip(self.a.encode([" " + t if t and len(y) else None for t, y in zip(texts, ids_b, strict=True)]), ids_b, strict=True)]
        a, b = np.concatenate([*ids_a, none]), np.concatenate([*ids_b, none])
        size_a, size_b = self.size_a[a], self.size_b[b]
        owner_a, owner_b = np.repeat(np.arange(len(a), dtype=np.int32), size_a), np.repeat(np.arange(len(b), dtype=np.int32), size_b)
        if len(owner_a) != len(owner_b):
            raise ValueError("tokens of the two vocabularies spell different texts")
        new_a, new_b = (np.concatenate([np.ones(min(1, len(x)), bool), x[1:] != x[:-1]]) for x in (owner_a, owner_b))
        link, group = np.flatnonzero(new_a | new_b), np.flatnonzero(new_a & new_b)
        ends = {"a": np.cumsum([0, *map(len, ids_a)]), "b": np.cumsum([0, *map(len, ids_b)])}
        ends["bytes"] = np.concatenate([[0], np.cumsum(size_a)])[ends["a"]]
        ends |= {"links": np.searchsorted(link, ends["bytes"]), "groups": np.searchsorted(group, ends["bytes"])}
        return Alignment(a, b, owner_a[link], owner_b[link], owner_a[group], owner_b[group], group, ends)


def aligner(path_a: str, path_b: str) -> Aligner:
    """This worker's aligner, kept from task to task."""
    return kept_in_worker(f"align {path_a} {path_b}", lambda: Aligner(path_a, path_b))


@cache
def _decimals(width: int) -> tuple[np.ndarray, np.ndarray]:
    """The digits of all numbers of up to `width` digits with room for a mark behind, and which of these places a number uses."""
    n = np.arange(10**width)
    tens = [10**k for k in reversed(range(width))]
    digits = np.stack([*((n // t % 10 + ord("0")) for t in tens), 0 * n], axis=1).astype(np.uint8)
    return digits, np.stack([*((n >= t) | (t == 1) for t in tens), n >= 0], axis=1)


def spelled(x: Alignment) -> list[bytes]:
    """Each text's groups as `a1,a2|b1;a3|b2,b3`, without a Python object per token."""
    n, m = len(x.a), len(x.b)
    if not n:
        return [b""] * (len(x.ends["a"]) - 1)
    of_a, of_b = (np.repeat(np.arange(len(g)), np.diff(np.append(g, k))) for g, k in ((x.groups_a, n), (x.groups_b, m)))
    key = np.concatenate([2 * of_a, 2 * of_b + 1])
    order = np.argsort(key, kind="stable")
    key, number = key[order], np.concatenate([x.a, x.b])[order].astype(np.int64)
    mark = np.where(np.append(key[1:] == key[:-1], False), ord(","), np.where(key % 2 == 0, ord("|"), ord(";"))).astype(np.uint8)
    digits, shown = _decimals(len(str(int(number.max()))))
    chars, used = digits[number], shown[number]
    chars[:, -1] = mark
    data, ends = chars[used].tobytes(), np.concatenate([[0], np.cumsum(used.sum(axis=1))])[x.ends["a"] + x.ends["b"]]
    return [data[i : max(i, j - 1)] for i, j in zip(ends[:-1], ends[1:], strict=True)]


def groups(docs: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, groups): each document's groups in order as (first byte, A ids, B ids); bytes are those of a space and the text."""
    item = StructType([StructField("at", LongType()), StructField("a", ArrayType(IntegerType())), StructField("b", ArrayType(IntegerType()))])
    d = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        it = aligner(path_a, path_b)
        for batch in batches:
            for i, texts in bpe.text_steps(batch.column("text"), 1 << 18):
                x = it.align(texts)
                lists = [pa.ListArray.from_arrays(pa.array(np.append(g, len(ids)), pa.int32()), pa.array(ids, pa.int32())) for g, ids in ((x.groups_a, x.a), (x.groups_b, x.b))]
                start = x.groups_at - np.repeat(x.ends["bytes"][:-1], np.diff(x.ends["groups"]))
                rows = pa.StructArray.from_arrays([pa.array(start, pa.int64()), *lists], names=["at", "a", "b"])
                yield pa.RecordBatch.from_arrays([batch.column("key").slice(i, len(texts)), pa.ListArray.from_arrays(pa.array(x.ends["groups"], pa.int32()), rows)], names=["key", "groups"])

    return d.mapInArrow(run, StructType([StructField("key", d.schema["key"].dataType), StructField("groups", ArrayType(item))])).withColumnRenamed("key", key)


COUNTS = ("n_a", "n_b", "n_groups", "n_links")


def blocks(docs: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text", size: int = BLOCK) -> DataFrame:
    """A row for every block of documents: their keys, counts and digests of groups; which pairs of ids each one links how often; the block's distinct pairs (a, b, n)."""
    d = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    longs, ints = ArrayType(LongType()), ArrayType(IntegerType())
    schema = StructType([StructField("block", LongType()), StructField("keys", ArrayType(d.schema["key"].dataType)), *(StructField(c, longs) for c in COUNTS), StructField("digests", ArrayType(StringType())), *(StructField(c, BinaryType()) for c in ("ends", "which", "times")), StructField("a", ints), StructField("b", ints), StructField("n", longs)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        it, part = aligner(path_a, path_b), TaskContext.get().partitionId()
        wide = np.int64(len(it.size_b))
        keys, counts, digests, ends, pairs, times, held, made = [], [], [], [], [], [], 0, 0

        def row() -> pa.RecordBatch:
            distinct, which = np.unique(np.concatenate(pairs), return_inverse=True)
            many = np.concatenate(times)
            one = lambda x, t: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x, t) if not isinstance(x, pa.Array) else x)
            cols = [pa.array([part << 32 | made], pa.int64()), one(pa.concat_arrays(keys), None), *(one(c, pa.int64()) for c in np.concatenate(counts, axis=1)), one(digests, pa.string())]
            cols += [pa.array([x.astype("<i4").tobytes()], pa.binary()) for x in (np.cumsum(np.concatenate(ends)), which, many)]
            cols += [one((distinct // wide).astype(np.int32), pa.int32()), one((distinct % wide).astype(np.int32), pa.int32()), one(np.bincount(which, many, len(distinct)).astype(np.int64), pa.int64())]
            return pa.RecordBatch.from_arrays(cols, names=schema.names)

        for batch in batches:
            for i, texts in bpe.text_steps(batch.column("text"), 1 << 21):
                x = it.align(texts)
                n = {k: np.diff(e) for k, e in x.ends.items()}
                keys.append(batch.column("key").slice(i, len(texts)))
                counts.append(np.stack([n["a"], n["b"], n["groups"], n["links"]]))
                digests += [hashlib.sha256(s).hexdigest() if k else "" for s, k in zip(spelled(x), n["a"], strict=True)]
                pair = x.a[x.links_a] * wide + x.b[x.links_b]
                of = np.repeat(np.arange(len(texts)), n["links"])
                both = of << np.int64(36) | pair  # pairs of ids stay below 2 ** 36, texts of a step below 2 ** 27
                both.sort()
                first = np.flatnonzero(np.concatenate([np.ones(min(1, len(both)), bool), both[1:] != both[:-1]]))
                pairs.append(both[first] & ((1 << 36) - 1))
                times.append(np.diff(np.append(first, len(both))))
                ends.append(np.bincount(both[first] >> np.int64(36), minlength=len(texts)))
                held += int(n["bytes"].sum())
                if held >= size:
                    yield row()
                    keys, counts, digests, ends, pairs, times, held, made = [], [], [], [], [], [], 0, made + 1
        if keys:
            yield row()

    return d.mapInArrow(run, schema)


def pair_rows(stored: DataFrame) -> DataFrame:
    """(block, place, a, b, n) of stored blocks: a row for every block and pair of ids linked in it."""
    return stored.select("block", F.posexplode(F.arrays_zip("a", "b", "n")).alias("place", "p")).select("block", "place", "p.a", "p.b", "p.n")


def pair_counts(stored: DataFrame) -> DataFrame:
    """(a, b, count, best): how often the corpus links a pair of ids, and whether no other pair of this b is linked more often."""
    counts = pair_rows(stored).groupBy("a", "b").agg(F.sum("n").alias("count"))
    most = counts.groupBy("b").agg(F.max("count").alias("most"))  # a row per B id: never more than its vocabulary
    return counts.join(F.broadcast(most), "b").select("a", "b", "count", (F.col("count") == F.col("most")).alias("best"))


def linked(docs: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text", size: int = BLOCK) -> DataFrame:
    """(key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every document, with counts of pairs over all of them."""
    stored = materialise(blocks(docs, path_a, path_b, key, text, size))
    counts = pair_counts(stored)
    found = pair_rows(stored).select("block", "place", "a", "b").join(counts, ["a", "b"])
    back = found.groupBy(F.col("block").alias("of")).agg(F.array_sort(F.collect_list(F.struct("place", "count", "best"))).alias("p"))  # a block's distinct pairs
    t = stored.drop("a", "b", "n").join(back, F.col("block") == F.col("of"), "left")
    t = t.select("keys", *COUNTS, "digests", "ends", "which", "times", F.col("p.count").alias("count"), F.col("p.best").alias("best"))
    names = ["key", *COUNTS, "n_best", "count_sum", "groups_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                r = b.slice(i, 1)
                ends, which, times = (np.frombuffer(r.column(c)[0].as_py(), "<i4").astype(np.int64) for c in ("ends", "which", "times"))
                flat = lambda c, r=r: r.column(c).flatten()
                sums = []
                for c in ("best", "count"):
                    v = flat(c).cast(pa.int64()).to_numpy(zero_copy_only=False)
                    upto = np.concatenate([[0], np.cumsum(v[which] * times if len(which) else which)])
                    sums.append(np.diff(upto[np.concatenate([[0], ends])]))
                yield pa.RecordBatch.from_arrays([flat("keys"), *(flat(c) for c in COUNTS), *map(pa.array, sums), flat("digests")], names=names)

    kind = stored.schema["keys"].dataType.elementType
    out = StructType([StructField("key", kind), *(StructField(c, LongType()) for c in names[1:-1]), StructField(names[-1], StringType())])
    return t.mapInArrow(run, out).withColumnRenamed("key", key)
