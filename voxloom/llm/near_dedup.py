"""Near-duplicate groups by MinHash in an LSH forest, with every link confirmed on full shingle sets.

1. Each text becomes its set of distinct word shingles, a digest of the set, a
   MinHash signature and a sketch of one bit per signature value. Texts with
   equal sets collapse to one class; only classes go on, so exact copies cost
   one comparison however many they are.
2. The signature is dealt into TREES orders of DEPTH values each. Every order is
   range-sorted. Rows that share LEAST_DEPTH leading values are a region; a
   row's neighbours in it are those with the longest common prefix, so in a
   crowded region the depth that counts grows by itself. Each row names the
   likeliest of its neighbours; order borders between partitions are compared
   too. A pair counts only if its sketches agree in enough bits (`least_bits`).
3. Each class's best pair is confirmed on whole sets and links become
   components. Then every region that still holds more than one component is
   gone through whole, in blocks, by sketches: each component names its best
   pair with another one, these are confirmed and linked as well.
4. At last the regions are gone through whole once more: all rows that are like
   a row of another component, grouped into clusters, are compared on whole
   sets, all pairs of different components, however many they are.
5. Classes linked into components keep their smallest doc_id.

A pair at similarity 0.8 shares LEAST_DEPTH leading values in none of the TREES
orders with probability (1 - 0.8 ** 4) ** 24, about 3 in a million; its
sketches agree in too few bits in one case of a million. Nothing else is left
to chance and nothing is capped.

Whole texts are shuffled only for classes with a likely partner: which texts
those are goes to the scan of the texts as a set of BUCKETS hash values at most.

Edge cases: a null or empty text has no shingles and is linked with nothing; a
text with fewer words than a shingle is one shingle; rows with the same doc_id
and text fall into one class; rows with the same doc_id and different texts are
rows of their own; a null doc_id is compared like any other and becomes a
component's id only where no other is there; an empty table gives an empty
result; columns besides text and doc_id are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from voxloom.llm.common import SALTS, forget_kept, materialise, release, texts_in
from voxloom.llm.components import connected

TREES, DEPTH, LEAST_DEPTH = 24, 7, 4
#: 64-bit numbers of a sketch; rows to either side that a row is compared with in the sweep, and at the borders of partitions.
SKETCH, REACH, BORDER = -(-TREES * DEPTH // 64), 64, 4
#: Bytes of a signature value and of a sketch, and shingles that one unit of a stored size stands for.
VALUE, BITS, UNIT = 3, -(-TREES * DEPTH // 8), 16
#: Shingles to a block of a region, and the least that a row counts there (rows compare by sketches too).
BLOCK, LEAST_WEIGHT = 200_000, 100
#: Hash values of texts that are told to a scan at most: the bound of what is broadcast.
BUCKETS = 1 << 21
#: Texts that a task holds against one base text, and digests that a task remembers having given a signature.
CELL, REMEMBERED = 256, 100_000
PERCENT = 80
_C = np.array([pow(0xD1342543DE82EF95, 2 * j + 1, 2**64) | 1 for j in range(16)], np.uint64)
_A = (np.array([pow(0x9E3779B1, k + 1, 2**32) for k in range(TREES * DEPTH)], np.uint64) | np.uint64(1)).astype(np.uint32)
_B = np.array([pow(0x85EBCA6B, k + 1, 2**32) for k in range(TREES * DEPTH)], np.uint64).astype(np.uint32)


def shingles(text: bytes | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit values of the text's shingles of `words` words, A-Z lower-cased."""
    import xxhash

    w = (text or b"").lower().split()
    if not w:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, w), np.uint64, len(w))
    k = min(words, len(w))
    n = len(w) - k + 1
    s = np.full(n, len(w) if len(w) < words else 0, np.uint64)  # a short text equals none of another length
    for j in range(k):
        s += h[j : j + n] * _C[j]
    s ^= s >> np.uint64(32)
    s *= np.uint64(0xD6E8FEB86659FD93)
    s ^= s >> np.uint64(32)
    return np.unique(s)


def signature(s: np.ndarray) -> np.ndarray:
    """TREES * DEPTH least values."""
    low = np.full(len(_A), 0xFFFFFFFF, np.uint32)
    x = (s >> np.uint64(16)).astype(np.uint32)
    for i in range(0, len(x), 512):
        np.minimum(low, (x[i : i + 512, None] * _A + _B).min(axis=0), out=low)
    return low


def packed(low: np.ndarray, size: int) -> bytes:
    """Signature values in VALUE bytes each, the sketch (one bit of each value) and the size in units, in 2 bytes."""
    values = low.astype(">u4").view(np.uint8).reshape(-1, 4)[:, 4 - VALUE :]
    bits = np.packbits(((low * np.uint32(0x9E3779B1)) >> np.uint32(31)).astype(np.uint8))
    return values.tobytes() + bits.tobytes() + min(-(-size // UNIT), 0xFFFF).to_bytes(2, "big")


def least_bits(percent: int, lost: float = 1e-6) -> int:
    """Most bits that may be asked to agree, so that sketches of sets `percent` alike agree in fewer with probability `lost` at most."""
    n, p = TREES * DEPTH, (100 + percent) / 200
    total, k = 0.0, 0
    while True:
        total += comb(n, k) * p**k * (1 - p) ** (n - k)
        if total > lost:
            return k
        k += 1


def text_keys(text: Column) -> list[Column]:
    """Two hashes that stand for a text."""
    return [F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2")]


def digests(docs: DataFrame, words: int, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, h1, h2, n_shingles, digest, sig): hashes of the text, digest of the shingle set, null for an empty one.

    sig is what `packed` makes of the signature; a set that a task has met
    before (as far as it remembers) gets none.
    """
    import xxhash

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_kept()
        met: set[bytes] = set()
        for b in batches:
            n, dig, sig = [], [], []
            for t in chain.from_iterable(texts_in(b.column(3))):
                s = shingles(t, words)
                n.append(len(s))
                d = xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None
                dig.append(d)
                if d is None or d in met:
                    sig.append(None)
                    continue
                if len(met) >= REMEMBERED:
                    met.clear()
                met.add(d)
                sig.append(packed(signature(s), len(s)))
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(3)), pa.array(n, pa.int64()), pa.array(dig, pa.binary()), pa.array(sig, pa.binary())], names=["doc_id", "h1", "h2", "n_shingles", "digest", "sig"])
        met.clear()
        forget_kept()

    d = docs.select(F.col(key).alias("doc_id"), *text_keys(F.col(text)), F.col(text).alias("text"))
    return d.mapInArrow(run, StructType([d.schema["doc_id"], *StructType.fromDDL("h1 long, h2 long, n_shingles long, digest binary, sig binary").fields]))


# A row of an order, as bytes that sort like (tree, values, digest): tree 1, values VALUE * DEPTH, digest 16, sketch BITS, size 2.
_KEY = slice(1, 1 + VALUE * DEPTH)
_NODE = slice(_KEY.stop, _KEY.stop + 16)
_BITS = slice(_NODE.stop, _NODE.stop + BITS)
_WIDTH = _BITS.stop + 2
_REGION = 1 + VALUE * LEAST_DEPTH
FOUND = "kind int, r binary, o binary, agree int, part int, nth int"
_ROW, _HEAD, _TAIL = range(3)


def orders(rows: DataFrame) -> DataFrame:
    """(r): every set in each of the forest's orders; a set that several tasks have met is there more than once."""
    width = VALUE * DEPTH
    each = F.array(*[F.concat(F.unhex(F.lit(f"{t:02x}")), F.substring("sig", t * width + 1, width), "digest", F.substring("sig", TREES * width + 1, BITS + 2)) for t in range(TREES)])
    return rows.where("sig is not null").select(F.explode(each).alias("r"))


def _words(bits: np.ndarray) -> np.ndarray:
    """Sketches (n, BITS bytes) as 64-bit numbers."""
    return np.pad(bits, [(0, 0), (0, 8 * SKETCH - BITS)]).view(np.uint64)


def _binary(x: np.ndarray) -> pa.Array:
    """Rows of bytes as binary values."""
    return pa.Array.from_buffers(pa.binary(x.shape[1]), len(x), [None, pa.py_buffer(np.ascontiguousarray(x).tobytes())]).cast(pa.binary())


def _bytes(column: pa.Array, width: int) -> np.ndarray:
    """A binary column of one width, without nulls, as rows of bytes."""
    column = column.cast(pa.binary())
    at = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[at[0] : at[-1]].reshape(-1, width) if len(column) else np.zeros((0, width), np.uint8)


def _agree(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Bits of sketches (last axis) that agree."""
    return TREES * DEPTH - np.bitwise_count(x ^ y).sum(axis=-1, dtype=np.int32)


def _once(r: np.ndarray) -> np.ndarray:
    """Sorted rows without repeated ones."""
    return r[np.concatenate([[True], (r[1:] != r[:-1]).any(axis=1)])]


def _regions(r: np.ndarray) -> np.ndarray:
    """Number of each sorted row's region."""
    return np.concatenate([[0], np.cumsum((r[1:, :_REGION] != r[:-1, :_REGION]).any(axis=1))])


def _likeliest(r: np.ndarray, region: np.ndarray, least: int, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """For each sorted row the row up to reach apart in its region whose sketch agrees best (-1: in `least` bits with none), and in how many bits."""
    n = len(r)
    bits = _words(r[:, _BITS])
    best, agree = np.full(n, -1), np.full(n, least - 1, np.int32)
    j = np.arange(n)
    for d in range(1, min(reach, n - 1) + 1):
        j = j[j >= d]
        j = j[region[j] == region[j - d]]
        if not len(j):
            break
        got = _agree(bits[j], bits[j - d])
        for x, y in ((j, j - d), (j - d, j)):  # no row is twice in x
            more = got > agree[x]
            best[x[more]], agree[x[more]] = y[more], got[more]
    return best, agree


def _found(kind: int, r: np.ndarray, **cols: pa.Array) -> pa.RecordBatch:
    kinds = {"o": pa.binary(), "agree": pa.int32(), "part": pa.int32(), "nth": pa.int32()}
    rest = [cols[c].cast(t) if c in cols else pa.nulls(len(r), t) for c, t in kinds.items()]
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(r), kind, np.int32)), _binary(r), *rest], names=["kind", "r", *kinds])


def sweep(rows: DataFrame, percent: int) -> DataFrame:
    """FOUND rows over range-sorted orders: rows that are alike some row of their region, each with its likeliest neighbour o.

    A row without a likely neighbour comes back too (o null) where its region
    is longer than REACH rows or goes up to a border of its partition. The
    BORDER rows at each end of a partition come back as well and are compared
    here; their number goes with the partitions only.
    """
    spread = rows.repartitionByRange("r").sortWithinPartitions("r")
    least = least_bits(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        some = [_bytes(b.column(0), _WIDTH) for b in batches if b.num_rows]
        if not some:
            return
        r, part = np.concatenate(some), TaskContext.get().partitionId()
        r = _once(r)
        n, region = len(r), _regions(r)
        best, agree = _likeliest(r, region, least, REACH)
        size = np.bincount(region)[region]
        at = np.flatnonzero((best >= 0) | (size > REACH) | (region == 0) | (region == region[-1]))
        for k in range(0, len(at), 50_000):
            x = at[k : k + 50_000]
            there = best[x] >= 0
            o = pa.array([v if ok else None for v, ok in zip(_binary(r[best[x], _NODE]).to_pylist(), there.tolist(), strict=True)], pa.binary())
            yield _found(_ROW, r[x], o=o, agree=pa.array(agree[x]))
        for kind, x in ((_HEAD, np.arange(min(BORDER, n))), (_TAIL, np.arange(max(0, n - BORDER), n))):
            yield _found(kind, r[x], part=pa.array(np.full(len(x), part)), nth=pa.array(x))

    found = materialise(spread.mapInArrow(run, FOUND))
    edge: dict[int, dict[int, list]] = {}
    for x in found.where(F.col("kind") != _ROW).select("part", "kind", "nth", "r").collect():  # 2 * BORDER rows of a partition at most
        edge.setdefault(x["part"], {_HEAD: [], _TAIL: []})[x["kind"]].append((x["nth"], bytes(x["r"])))
    parts, more = sorted(edge), []
    for k, p in enumerate(parts[:-1]):
        left, right = sorted(edge[p][_TAIL]), sorted(edge[parts[k + 1]][_HEAD])
        r = _once(np.frombuffer(b"".join(x for _, x in left + right), np.uint8).reshape(-1, _WIDTH))
        best, agree = _likeliest(r, _regions(r), least, 2 * BORDER)
        more += [(bytearray(r[i, _NODE].tobytes()), bytearray(r[b, _NODE].tobytes()), int(agree[i])) for i, b in enumerate(best.tolist()) if b >= 0]
    if more:
        # without r: a pair alone, its rows are there already
        extra = found.sparkSession.createDataFrame([(_ROW, None, x, y, d) for x, y, d in more], "kind int, r binary, a binary, o binary, agree int")
        found = found.withColumn("a", node_of("r")).unionByName(extra, allowMissingColumns=True)
        return found
    return found.withColumn("a", node_of("r"))


def node_of(r: str) -> Column:
    return F.substring(r, _NODE.start + 1, 16)


def pairs_of(named: DataFrame) -> DataFrame:
    """(a, b), stored, each pair once: of named (who, agree, a, b) the pair that agrees best for each `who`."""
    best = named.groupBy("who").agg(F.max(F.struct("agree", "b", "a")).alias("m")).select("m.a", "m.b")
    u = best.groupBy(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).agg(F.max("b").alias("b"))
    return materialise(u.select(F.col("b").alias("a"), F.when(F.col("b") == F.col("lo"), F.col("hi")).otherwise(F.col("lo")).alias("b")))  # the one that was named is the base


def in_buckets(key: Column) -> Column:
    return F.pmod(key, F.lit(BUCKETS))


def told(keys: DataFrame, key: Column) -> DataFrame:
    """(n_bucket): the BUCKETS hash values of keys at most that a scan is told, so broadcasting them is bounded."""
    return F.broadcast(keys.select(in_buckets(key).alias("n_bucket")).distinct())


def texts_of(members: DataFrame, pool: DataFrame) -> DataFrame:
    """members (m, ...) with their texts as d_text; of the pool only what may be asked for is shuffled."""
    some = pool.join(told(members, F.xxhash64("m")), in_buckets(F.xxhash64("digest")) == F.col("n_bucket"), "left_semi")
    return members.join(some.select(F.col("digest").alias("m"), F.col("text").alias("d_text")), "m")


def candidate_texts(found: DataFrame, classes: DataFrame, docs: DataFrame, text: str = "text") -> DataFrame:
    """(digest, text) of the classes that are alike some other, stored: later steps never go through all texts again."""
    like = found.where((F.col("kind") == _ROW) & F.col("r").isNotNull()).select(F.col("a").alias("digest")).distinct()
    need = materialise(classes.join(like, "digest", "left_semi").select("digest", "h.h1", "h.h2"))
    d = docs.select(F.col(text).alias("text")).where("text is not null").select(*text_keys(F.col("text")), "text")
    near = d.join(told(need, F.col("h1")), in_buckets(F.col("h1")) == F.col("n_bucket"), "left_semi")
    one = near.groupBy("h1", "h2").agg(F.first("text").alias("text"))  # copies go before the shuffle
    out = materialise(one.join(need, ["h1", "h2"]).select("digest", "text"))
    release(need)
    return out


def confirmed(pairs: DataFrame, pool: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough; pool has the texts.

    Each a is the base of a group; the texts of its b's stream past it. A base
    with more than CELL partners is dealt over more groups.
    """
    hot = pairs.groupBy("a").agg(F.ceil(F.count("*") / CELL).alias("salts")).where("salts > 1")
    p = pairs.join(hot, "a", "left").select("a", "b", F.pmod(F.xxhash64("b"), F.coalesce("salts", F.lit(1))).alias("salt"))
    members = p.select("a", "salt", F.col("a").alias("m"), F.lit(0).alias("nth")).distinct().union(p.select("a", "salt", F.col("b").alias("m"), F.lit(1).alias("nth")))
    texts = texts_of(members, pool).select("a", "salt", "nth", "m", "d_text")
    dealt = texts.repartition("a", "salt").sortWithinPartitions("a", "salt", "nth", "m")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        now, base = None, None
        for b in batches:
            out_a, out_b = [], []
            for a, salt, nth, m, t in zip(*(c.to_pylist() for c in b.columns), strict=True):
                s = shingles(t.encode(), words)
                if xxhash.xxh3_128_digest(s.tobytes()) != m:
                    continue
                if not nth:
                    now, base = (a, salt), s
                elif now == (a, salt):
                    small, large = sorted((len(s), len(base)))
                    both = int(np.isin(s, base, assume_unique=True).sum()) if small * 100 >= percent * large else 0
                    if 100 * both >= percent * (small + large - both):
                        out_a.append(a), out_b.append(m)
            yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.binary()), pa.array(out_b, pa.binary())], names=["a", "b"])

    return materialise(dealt.mapInArrow(run, "a binary, b binary"))


def links_between(sets: list[np.ndarray], label: np.ndarray, side: np.ndarray | None, percent: int) -> list[tuple[int, int]]:
    """(i, j) of sets similar enough that join all components (label) which any such pair joins; with side only pairs of different sides count.

    For a set, the sets that share each of its values are counted at once, so
    all its pairs cost one pass over the postings of its values.
    """
    n, size, label, found = len(sets), np.array([len(s) for s in sets]), np.unique(label, return_inverse=True)[1], []
    dominant = np.bincount(label).argmax() if n else 0
    turn = np.flatnonzero(label != dominant)  # two rows of one component need no comparison, so none of the largest has a turn
    if not len(turn):
        return found
    values, row = np.concatenate(sets), np.repeat(np.arange(n), size)
    order = np.argsort(values, kind="stable")
    by_value, sorted_values = row[order], values[order]
    start = np.flatnonzero(np.concatenate([[True], sorted_values[1:] != sorted_values[:-1]]))
    count = np.diff(np.append(start, len(values)))
    group = np.empty(len(values), np.int64)
    group[order] = np.repeat(np.arange(len(start)), count)
    at = np.concatenate([[0], np.cumsum(size)])
    todo = np.ones(n, bool)
    for j in turn.tolist():
        todo[j] = False
        open_ = todo & (label != label[j])
        if side is not None:
            open_ &= side != side[j]
        if not open_.any():
            continue
        g = group[at[j] : at[j + 1]]
        g = g[count[g] > 1]
        c = count[g]
        both = np.bincount(by_value[np.repeat(start[g] - np.cumsum(c) + c, c) + np.arange(c.sum())], minlength=n)
        for i in np.flatnonzero(open_ & (100 * both >= percent * (size + size[j] - both))).tolist():
            if label[i] != label[j]:
                found.append((i, j))
                label[label == label[i]] = label[j]
    return found


def mixed_regions(crowd: DataFrame, labels: DataFrame, block: int = BLOCK) -> DataFrame:
    """(region, digest, label, bits, blocks, side), stored: crowd's rows (r, a) in regions that hold more than one component. A region is dealt into blocks of about `block` shingles."""
    rows = crowd.join(labels, F.col("a") == F.col("node"), "left")
    size = F.greatest(F.conv(F.hex(F.substring("r", _BITS.stop + 1, 2)), 16, 10).cast("long") * UNIT, F.lit(LEAST_WEIGHT))
    rows = materialise(rows.select(F.substring("r", 1, _REGION).alias("region"), F.col("a").alias("digest"), F.coalesce("label", "a").alias("label"), F.substring("r", _BITS.start + 1, BITS).alias("bits"), size.alias("n")))
    mark = F.xxhash64("label")
    mixed = rows.groupBy("region").agg(F.min(mark).alias("lo"), F.max(mark).alias("hi"), F.ceil(F.sum("n") / block).alias("blocks")).where("lo <> hi").select("region", "blocks")
    out = materialise(rows.join(mixed, "region").select("region", "digest", "label", "bits", "blocks", F.pmod(F.xxhash64("digest"), F.col("blocks")).alias("side")))
    release(rows)
    return out


def cells(mixed: DataFrame) -> DataFrame:
    """(region, x, y, digest, label, side, bits): mixed rows once for each pair of blocks, a pair's rows together and sorted."""
    d = mixed.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    d = d.select("region", F.least("side", "other").alias("x"), F.greatest("side", "other").alias("y"), "digest", "label", "side", "bits")
    return d.repartition("region", "x", "y").sortWithinPartitions("region", "x", "y", "digest")


class _Cell:
    """A cell's rows and which of them are alike: rows of different components, and of different sides where there are two."""

    def __init__(self, rows: list[tuple], least: int):
        self.digest = [r[0] for r in rows]
        self.label, self.number = [r[1] for r in rows], np.unique([r[1] for r in rows], return_inverse=True)[1]
        self.side = np.array([r[2] for r in rows])
        bits = _words(np.frombuffer(b"".join(r[3] for r in rows), np.uint8).reshape(-1, BITS))
        two, n = self.side.min() != self.side.max(), len(rows)
        self.agree = np.zeros((n, n), np.uint8)
        for i in range(0, n, 64):
            got = _agree(bits[i : i + 64, None], bits[None])
            off = self.number[i : i + 64, None] == self.number[None]
            if two:
                off |= self.side[i : i + 64, None] == self.side[None]
            self.agree[i : i + 64] = np.where((got < least) | off, 0, got)

    def best(self) -> dict[bytes, tuple[int, bytes, bytes]]:
        """label -> (agree, a, b): its row's best pair with another component."""
        out: dict[bytes, tuple[int, bytes, bytes]] = {}
        to = self.agree.argmax(axis=1)
        for i, j in enumerate(to.tolist()):
            if self.agree[i, j]:
                out[self.label[i]] = max(out.get(self.label[i], (0, b"", b"")), (int(self.agree[i, j]), self.digest[i], self.digest[j]))
        return out

    def clusters(self) -> Iterator[np.ndarray]:
        """Rows joined by likeness."""
        todo = self.agree.any(axis=1)
        while todo.any():
            front = reached = np.eye(1, len(todo), int(todo.argmax()), dtype=bool)[0]
            while front.any():
                front = self.agree[front].any(axis=0) & ~reached
                reached = reached | front
            todo &= ~reached
            yield np.flatnonzero(reached)


def _by_cell(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[_Cell]:
    now, held = None, []
    for b in batches:
        for *at, digest, label, side, bits in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if at != now:
                if len(held) > 1:
                    yield _Cell(held, least)
                now, held = at, []
            held.append((digest, label, side, bits))
    if len(held) > 1:
        yield _Cell(held, least)


def best_between(mixed: DataFrame, percent: int) -> DataFrame:
    """(a, b), stored: every component's likeliest pair with another one over whole regions."""
    least = least_bits(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in _by_cell(batches, least):
            got = [(who, *x) for who, x in cell.best().items()]
            yield pa.RecordBatch.from_arrays([pa.array([g[k] for g in got], pa.int32() if k == 1 else pa.binary()) for k in range(4)], names=["who", "agree", "a", "b"])

    return pairs_of(cells(mixed).mapInArrow(run, "who binary, agree int, a binary, b binary"))


def clusters_of(mixed: DataFrame, tried: DataFrame, percent: int) -> DataFrame:
    """(cluster, digest, label, side), stored: rows of whole regions that may be linked with another component.

    Clusters that several regions hold are there once; a cluster of two rows
    that were compared already, a pair (a, b) of tried, is left out.
    """
    least = least_bits(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from hashlib import md5

        for cell in _by_cell(batches, least):
            two = cell.side.min() != cell.side.max()
            for at in cell.clusters():
                digest, side = [cell.digest[i] for i in at], [int(cell.side[i]) if two and len(at) > 2 else 0 for i in at]
                name = md5(b"".join(digest) + np.array(side, "<i8").tobytes()).digest()
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.binary()), pa.array(digest, pa.binary()), pa.array([cell.label[i] for i in at], pa.binary()), pa.array(side, pa.int64())], names=["cluster", "digest", "label", "side"])

    found = cells(mixed).mapInArrow(run, "cluster binary, digest binary, label binary, side long").dropDuplicates(["cluster", "digest"])
    done = tried.select(F.unhex(F.md5(F.concat(F.least("a", "b"), F.greatest("a", "b"), F.unhex(F.lit("00" * 16))))).alias("cluster")).distinct()
    return materialise(found.join(done, "cluster", "left_anti"))


def crossing(clusters: DataFrame, pool: DataFrame, words: int, percent: int) -> DataFrame:
    """Links (a, b) between components over all pairs of the clusters' rows, on whole sets; a cluster is two blocks of a region at most."""
    spread = texts_of(clusters.withColumnRenamed("digest", "m"), pool).select("cluster", "m", "label", "side", "d_text").repartition("cluster").sortWithinPartitions("cluster", "m")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        def linked(rows: list[tuple]) -> pa.RecordBatch:
            label = np.unique([x[1] for x in rows], return_inverse=True)[1]
            sides = np.array([x[2] for x in rows])
            pairs = links_between([x[3] for x in rows], label, sides if sides.min() != sides.max() else None, percent)
            return pa.RecordBatch.from_arrays([pa.array([rows[p[k]][0] for p in pairs], pa.binary()) for k in range(2)], names=["a", "b"])

        now, held = None, []
        for b in batches:
            for at, digest, label, side, t in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if at != now:
                    if len(held) > 1:
                        yield linked(held)
                    now, held = at, []
                s = shingles(t.encode(), words)
                if xxhash.xxh3_128_digest(s.tobytes()) == digest:
                    held.append((digest, label, side, s))
        if len(held) > 1:
            yield linked(held)

    return materialise(spread.mapInArrow(run, "a binary, b binary"))


def grouped(docs: DataFrame, words: int, percent: int, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, h1, h2, n_shingles, digest, label, component), a row per row of docs: label names the group, null where it is the row's class alone; component is its smallest doc_id."""
    rows = materialise(digests(docs, words, text, key))
    classes = materialise(rows.where("digest is not null").groupBy("digest").agg(F.min("doc_id").alias("rep"), F.min(F.struct("h1", "h2")).alias("h"), F.count("*").alias("n_rows")))
    found = sweep(orders(rows), percent)
    pool = candidate_texts(found, classes, docs, text)
    named = found.where((F.col("kind") == _ROW) & F.col("o").isNotNull()).select(F.col("a").alias("who"), "agree", "a", F.col("o").alias("b"))
    first = pairs_of(named)
    links = confirmed(first, pool, words, percent)
    labels = connected(links)
    crowd = found.where((F.col("kind") == _ROW) & F.col("r").isNotNull()).select("r", "a")
    mixed = mixed_regions(crowd, labels)
    second = best_between(mixed, percent)
    more = confirmed(second, pool, words, percent)
    if not more.isEmpty():
        links = materialise(links.union(more))
        labels = connected(links)
        release(mixed)
        mixed = mixed_regions(crowd, labels)
    clusters = clusters_of(mixed, first.union(second), percent)
    more = crossing(clusters, pool, words, percent)
    if not more.isEmpty():
        labels = connected(materialise(links.union(more)))
    member = materialise(classes.join(labels, F.col("digest") == F.col("node"), "left").where("n_rows > 1 or label is not null").select("digest", "rep", "label"))
    smallest = member.where("label is not null").groupBy("label").agg(F.min("rep").alias("component"))
    smallest = smallest.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = member.withColumn("salt", F.pmod(F.xxhash64("digest"), F.lit(SALTS)).cast("int"))
    known = materialise(salted.join(smallest, ["label", "salt"], "left").select("digest", F.col("label").alias("k_label"), F.when(F.col("label").isNull(), F.col("rep")).otherwise(F.col("component")).alias("k_component"), F.lit(True).alias("there")))
    out = rows.drop("sig").join(known, "digest", "left")
    component = F.when(F.col("there"), F.col("k_component")).otherwise(F.col("doc_id"))
    out = materialise(out.select("doc_id", "h1", "h2", "n_shingles", "digest", F.coalesce("k_label", "digest").alias("label"), component.alias("component")))
    release(rows, classes, found, pool, first, second, links, mixed, clusters, more, member, known)
    return out


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = PERCENT, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), a row per row of docs; component_id is the smallest doc_id of its group."""
    g = grouped(docs, words, percent, text, key)
    return g.select("doc_id", "n_shingles", F.col("component").alias("component_id"), F.col("doc_id").eqNullSafe(F.col("component")).alias("kept"))


def one_of_each(docs: DataFrame, words: int = 5, percent: int = PERCENT, text: str = "text", key: str = "doc_id") -> DataFrame:
    """docs with one row per group: a row whose doc_id names the group. Rows without words are no copies of each other and all stay.

    Only rows whose text has the hash of a row that goes are shuffled with
    their texts; the scan is told BUCKETS hash values at most.
    """
    g = grouped(docs, words, percent, text, key)
    ident = g.where("digest is not null").groupBy("doc_id", "h1", "h2", "digest", "label", "component").agg(F.count("*").alias("n_rows"))
    ident = materialise(ident)
    winner = ident.where(F.col("doc_id").eqNullSafe(F.col("component"))).groupBy("label").agg(F.min(F.struct("digest", "h1", "h2")).alias("w"))
    winner = winner.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    stays = F.col("doc_id").eqNullSafe(F.col("component")) & (F.struct("digest", "h1", "h2") == F.col("w"))
    judged = ident.withColumn("salt", F.pmod(F.xxhash64("digest", "h1", "doc_id"), F.lit(SALTS)).cast("int")).join(winner, ["label", "salt"])
    judged = materialise(judged.select(F.col("doc_id").alias("v_id"), F.col("h1").alias("v_h1"), F.col("h2").alias("v_h2"), stays.alias("stays"), "n_rows").where("NOT stays OR n_rows > 1"))
    release(g, ident)
    d = docs.select(F.struct("*").alias("row"), F.col(key).alias("v_key"), *text_keys(F.col(text)))
    some, at = told(judged, F.col("v_h1")), in_buckets(F.col("h1")) == F.col("n_bucket")
    free = d.join(some, at, "left_anti").select("row.*")
    hit = d.join(some, at, "left_semi").join(judged, (F.col("h1") == F.col("v_h1")) & (F.col("h2") == F.col("v_h2")) & F.col("v_key").eqNullSafe(F.col("v_id")), "left")
    once = hit.where("stays IS NULL").select("row.*")
    again = hit.where("stays").groupBy("v_id", "h1", "h2").agg(F.first("row").alias("row")).select("row.*")
    return free.unionByName(once).unionByName(again)
