"""Lloyd's clustering of integer vectors by two trees.

Vectors are put into blocks, each with a cover tree of its own, stored once.
Every round makes a cover tree over the centroids and goes down both trees
together: a pair of nodes whose vectors cannot be nearer to those centroids
than to another one is pruned by the distance of the nodes' centres and their
radii, a node that is left with one centroid goes to it whole, and leaves that
are left with several are compared exactly, in whole numbers. A task gives
back a sum and a count for each centroid. Only centroids (k of them) pass
through the driver.

Edge cases: vectors that are null, of another length, or hold a null or a
number that is not finite are left out; one with a component beyond LARGEST,
whose squares do not fit 64 bits, is an error that says so; null and repeated
ids are vectors like others (null ids are drawn last as first centroids); with
fewer vectors than k there are as many centroids; of equal centroids the
smallest number is nearest and the others stay empty and where they are; sums
of distances beyond 64 bits are null; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, StructField, StructType

from voxloom.llm.common import materialise, release

#: Largest magnitude of a component: 64 squared differences of such fit 64 bits.
LARGEST = 1 << 27
#: Vectors of a block, and of a leaf.
BLOCK, LEAF = 2048, 16
#: Pairs of a vector and a centroid that are compared at a time.
STEP = 1 << 15
LONG = (1 << 63) - 1


@dataclass
class Tree:
    """A cover tree: node k holds points[lo[k] : hi[k]], all within radius[k] of points[centre[k]]; its children are nodes first[k] to first[k] + count[k] - 1."""

    points: np.ndarray  # int64, in the tree's order
    order: np.ndarray  # which of the points given each one is
    lo: np.ndarray
    hi: np.ndarray
    centre: np.ndarray
    first: np.ndarray
    count: np.ndarray
    radius: np.ndarray

    @classmethod
    def of(cls, points: np.ndarray, leaf: int = LEAF) -> Tree:
        """Children lie within half their parent's radius of their own centre, and their centres farther from each other than that."""
        p = np.asarray(points, np.int64)
        f = p.astype(float)
        squares = (f * f).sum(axis=1)
        apart = np.sqrt(np.maximum(squares[:, None] + squares - 2 * (f @ f.T), 0)).astype(np.float32)
        np.fill_diagonal(apart, 0)
        order, rows, todo = np.zeros(len(p), np.int64), [], [(0, np.arange(len(p)), 0)]
        at = 0
        while at < len(todo):  # breadth first, so children stand side by side
            lo, idx, c = todo[at]
            at += 1
            far = np.sqrt(((p[idx] - p[c]) ** 2).sum(axis=1).max().astype(float))
            first, count = len(todo), 0
            if len(idx) > leaf and far > 0:
                rest, start, centre, half = idx, lo, c, float(apart[c, idx].max()) / 2
                while len(rest):
                    near = apart[centre, rest] <= half
                    own = rest[near]
                    if len(own) == len(idx):  # rounding: cannot be told apart
                        break
                    todo.append((start, own, centre))
                    start += len(own)
                    rest = rest[~near]
                    centre = rest[0] if len(rest) else c
                    count += 1
            if not count:
                order[lo : lo + len(idx)] = np.concatenate([[c], idx[idx != c]])
            rows.append((lo, lo + len(idx), c, first, count, far))
        lo, hi, centre, first, count, radius = map(np.array, zip(*rows, strict=True))
        place = np.empty(len(p), np.int64)
        place[order] = np.arange(len(p))
        return cls(p[order], order, lo, hi, place[centre], first, count, radius * (1 + 1e-12))

    def row(self) -> tuple[bytes, bytes, bytes]:
        """(points, nodes, radii) to store."""
        nodes = np.stack([self.lo, self.hi, self.centre, self.first, self.count]).astype("<i4")
        return self.points.astype("<i4").tobytes(), nodes.tobytes(), self.radius.astype("<f8").tobytes()

    @classmethod
    def stored(cls, points: bytes, nodes: bytes, radii: bytes, dim: int) -> Tree:
        p = np.frombuffer(points, "<i4").reshape(-1, dim).astype(np.int64)
        return cls(p, np.arange(len(p)), *np.frombuffer(nodes, "<i4").reshape(5, -1).astype(np.int64), np.frombuffer(radii, "<f8"))


def _children(tree: Tree, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which of `nodes`, child) for all children of nodes."""
    n = tree.count[nodes]
    which = np.repeat(np.arange(len(nodes)), n)
    return which, tree.first[nodes][which] + np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)


def nearest(tree: Tree, centroids: Tree) -> np.ndarray:
    """The number of each vector's nearest centroid, in the tree's order; of several the smallest."""
    owner = np.full(len(tree.points), -1, np.int64)
    v, c = np.zeros(1, np.int64), np.zeros(1, np.int64)  # pairs of nodes, by v
    leaves: list[tuple[np.ndarray, np.ndarray]] = []
    while len(v):
        diff = tree.points[tree.centre[v]] - centroids.points[centroids.centre[c]]
        d = np.sqrt((diff * diff).sum(axis=1).astype(float))
        rv, rc = tree.radius[v], centroids.radius[c]
        starts = np.flatnonzero(np.concatenate([[True], v[1:] != v[:-1]]))
        group = np.cumsum(np.concatenate([[False], v[1:] != v[:-1]]))
        most = np.minimum.reduceat(d + rv, starts)[group]  # some centroid is that near to all of v
        keep = d - rv - rc <= most + 1e-9 * (d + rv + rc) + 1e-6
        v, c = v[keep], c[keep]
        starts = np.flatnonzero(np.concatenate([[True], v[1:] != v[:-1]]))
        many = np.diff(np.append(starts, len(v)))
        one = starts[(many == 1) & (centroids.hi - centroids.lo == 1)[c[starts]]]
        for k in one:
            owner[tree.lo[v[k]] : tree.hi[v[k]]] = centroids.order[centroids.lo[c[k]]]
        left = np.ones(len(v), bool)
        left[one] = False
        v, c = v[left], c[left]
        if not len(v):
            break
        # of each v: go down on the side of the centroids while theirs is the larger radius, or v is a leaf
        starts = np.flatnonzero(np.concatenate([[True], v[1:] != v[:-1]]))
        group = np.cumsum(np.concatenate([[False], v[1:] != v[:-1]]))
        inner = centroids.count[c] > 0
        widest = np.maximum.reduceat(np.where(inner, centroids.radius[c], -1.0), starts)[group]
        leaf = tree.count[v] == 0
        down = (widest >= 0) & (leaf | (widest >= tree.radius[v]))
        done = leaf & ~down
        leaves.append((v[done], c[done]))
        stay, open_c, open_v = down & ~inner, down & inner, ~down & ~leaf
        wc, kids_c = _children(centroids, c[open_c])
        wv, kids_v = _children(tree, v[open_v])
        v, c = np.concatenate([v[stay], v[open_c][wc], kids_v]), np.concatenate([c[stay], kids_c, c[open_v][wv]])
        by = np.argsort(v, kind="stable")
        v, c = v[by], c[by]
    for v, c in leaves:
        _compare(tree, centroids, v, c, owner)
    return owner


def _compare(tree: Tree, centroids: Tree, v: np.ndarray, c: np.ndarray, owner: np.ndarray) -> None:
    """Exact comparison of the vectors of leaves v with the centroids of leaves c (pairs, by v)."""
    size = (tree.hi - tree.lo)[v] * (centroids.hi - centroids.lo)[c]
    ends = np.flatnonzero(np.append(v[1:] != v[:-1], True)) + 1 if len(v) else []
    start = 0
    for k, end in enumerate(ends):
        if k + 1 < len(ends) and size[start : ends[k + 1]].sum() <= STEP:
            continue
        point, number = [], []
        for a, b in zip(v[start:end], c[start:end], strict=True):
            p, q = np.arange(tree.lo[a], tree.hi[a]), np.arange(centroids.lo[b], centroids.hi[b])
            point.append(np.repeat(p, len(q)))
            number.append(np.tile(q, len(p)))
        p, q = np.concatenate(point), np.concatenate(number)
        diff = tree.points[p] - centroids.points[q]
        by = np.lexsort((centroids.order[q], (diff * diff).sum(axis=1), p))
        first = by[np.concatenate([[True], p[by][1:] != p[by][:-1]])]
        owner[p[first]] = centroids.order[q[first]]
        start = end


def vectors(table: DataFrame, key: str = "vec_id", vector: str = "embedding", dim: int = 64, scale: int = 1024) -> DataFrame:
    """(key, v): vectors of dim finite components, each as floor(scale * x)."""
    e = F.col(vector)
    # both sides of a comparison with the largest finite double are false for NaN and the infinities in Spark's order of numbers
    fine = lambda x: x.isNotNull() & (F.abs(x.cast("double")) <= 1.7976931348623157e308)
    t = table.where(e.isNotNull() & (F.size(e) == dim)).where(F.forall(e, lambda x: F.coalesce(fine(x), F.lit(False))))
    large = F.exists(e, lambda x: F.abs(x.cast("double") * scale) > LARGEST)
    bad = F.raise_error(F.lit(f"a component is beyond {LARGEST / scale} and its squares do not fit 64 bits")).cast("array<int>")
    return t.select(F.col(key).alias("key"), F.when(large, bad).otherwise(F.transform(e, lambda x: F.floor(x.cast("double") * scale).cast("int"))).alias("v"))


def trees(t: DataFrame, dim: int, block: int = BLOCK) -> DataFrame:
    """(keys, points, nodes, radii): a row for every block of vectors (key, v), as they come; nothing is shuffled."""
    schema = StructType([StructField("keys", ArrayType(t.schema["key"].dataType)), *(StructField(n, BinaryType()) for n in ("points", "nodes", "radii"))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row(keys: list[pa.Array], held: list[np.ndarray]) -> pa.RecordBatch:
            tree = Tree.of(np.concatenate(held))
            own = pa.concat_arrays(keys).take(pa.array(tree.order))
            lists = pa.ListArray.from_arrays(pa.array([0, len(own)], pa.int32()), own)
            return pa.RecordBatch.from_arrays([lists, *(pa.array([x], pa.binary()) for x in tree.row())], names=schema.names)

        keys, held, n = [], [], 0
        for b in batches:
            points = b.column("v").flatten().to_numpy().reshape(-1, dim)
            i = 0
            while i < len(points):
                take = min(block - n, len(points) - i)
                keys.append(b.column("key").slice(i, take))
                held.append(points[i : i + take])
                n, i = n + take, i + take
                if n == block:
                    yield row(keys, held)
                    keys, held, n = [], [], 0
        if n:
            yield row(keys, held)

    return t.mapInArrow(run, schema)


def first_centroids(t: DataFrame, k: int, salt: str) -> list[list[int]]:
    """The k vectors with the smallest sha256 of salt and key."""
    h = F.sha2(F.concat(F.lit(salt), F.col("key").cast("string")).cast("binary"), 256)
    return [list(r["v"]) for r in t.select(h.alias("h"), "v").orderBy(F.asc_nulls_last("h"), "v").limit(k).collect()]  # k rows


def moved(stored: DataFrame, centroids: list[list[int]], dim: int) -> list[list[int]]:
    """The centroids after a round: the floor of each one's mean; empty ones stay."""
    k = len(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = Tree.of(np.array(centroids, np.int64), leaf=1)
        total, n = np.zeros((k, dim), np.int64), np.zeros(k, np.int64)
        for b in batches:
            for r in b.to_pylist():
                own = Tree.stored(r["points"], r["nodes"], r["radii"], dim)
                to = nearest(own, tree)
                upto = np.concatenate([np.zeros((1, dim), np.int64), own.points.cumsum(axis=0)])
                cuts = np.concatenate([[0], np.flatnonzero(to[1:] != to[:-1]) + 1, [len(to)]])
                np.add.at(total, to[cuts[:-1]], upto[cuts[1:]] - upto[cuts[:-1]])
                n += np.bincount(to, minlength=k)
        some = np.flatnonzero(n)
        ends = pa.array(np.arange(len(some) + 1) * dim, pa.int32())
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(n[some]), pa.ListArray.from_arrays(ends, pa.array(total[some].ravel()))], names=["cluster", "n", "s"])

    part = stored.select("points", "nodes", "radii").mapInArrow(run, "cluster int, n long, s array<long>")
    sums = [F.sum(F.col("s")[j].cast("decimal(20,0)")).alias(f"s{j}") for j in range(dim)]
    out = [list(c) for c in centroids]
    for r in part.groupBy("cluster").agg(F.sum("n").alias("n"), *sums).collect():  # k rows
        out[r["cluster"]] = [int(r[f"s{j}"]) // r["n"] for j in range(dim)]
    return out


def assigned(stored: DataFrame, centroids: list[list[int]], dim: int) -> DataFrame:
    """(key, cluster, distance) of every vector; squared distances."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = np.array(centroids, np.int64)
        tree = Tree.of(at, leaf=1)
        for b in batches:
            for i, r in enumerate(b.select(["points", "nodes", "radii"]).to_pylist()):
                own = Tree.stored(r["points"], r["nodes"], r["radii"], dim)
                to = nearest(own, tree)
                d = ((own.points - at[to]) ** 2).sum(axis=1)
                yield pa.RecordBatch.from_arrays([b.column("keys").slice(i, 1).flatten(), pa.array(to.astype(np.int32)), pa.array(d)], names=["key", "cluster", "distance"])

    key = stored.schema["keys"].dataType.elementType
    return stored.mapInArrow(run, StructType([StructField("key", key), *StructType.fromDDL("cluster int, distance long").fields]))


def clustered(table: DataFrame, k: int = 8, rounds: int = 10, salt: str = "3:", key: str = "vec_id", vector: str = "embedding", dim: int = 64, scale: int = 1024) -> DataFrame:
    """(key, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every vector after `rounds` rounds; the tables stored on the way are deleted."""
    t = vectors(table, key, vector, dim, scale)
    centroids = first_centroids(t, k, salt)
    if not centroids:
        return t.selectExpr(f"key AS `{key}`", "0 AS cluster", "0L AS distance", "0L AS cluster_inertia", "0L AS inertia", "'' AS centroid_sha256").where("false")
    stored = materialise(trees(t, dim))
    for _ in range(rounds):
        if (new := moved(stored, centroids, dim)) == centroids:
            break  # it would stay so
        centroids = new
    out = materialise(assigned(stored, centroids, dim))
    release(stored)
    sums = {r[0]: int(r[1]) for r in out.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)"))).collect()}  # k rows
    total = sum(sums.values())
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    rows = [(c, s if s <= LONG else None, total if total <= LONG else None, sha[c]) for c, s in sums.items()]
    side = table.sparkSession.createDataFrame(rows, "r_cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return out.join(F.broadcast(side), F.col("cluster") == F.col("r_cluster")).select(F.col("key").alias(key), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")  # k rows
