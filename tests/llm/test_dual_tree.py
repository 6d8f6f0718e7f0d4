"""Dual-tree Lloyd against every vector with every centroid."""

import hashlib

import numpy as np
import pytest

from voxloom.llm import dual_tree as d


def plain(points: np.ndarray, at: np.ndarray, rounds: int):
    for _ in range(rounds):
        to = ((points[:, None] - at) ** 2).sum(axis=2).argmin(axis=1)
        at = np.array([points[to == k].sum(axis=0) // (to == k).sum() if (to == k).any() else at[k] for k in range(len(at))])
    all_ = ((points[:, None] - at) ** 2).sum(axis=2)
    return all_.argmin(axis=1), all_.min(axis=1), at


def test_trees_and_nearest():
    rng = np.random.default_rng(0)
    for _ in range(200):
        n, dim, k = int(rng.integers(1, 400)), int(rng.integers(1, 6)), int(rng.integers(1, 20))
        p = rng.integers(-5, 6, (n, dim)) * int(rng.choice([1, 1000, 10**7]))
        c = p[rng.integers(0, n, k)] + rng.integers(-1, 2, (k, dim))
        t, ct = d.Tree.of(p, leaf=int(rng.integers(1, 8))), d.Tree.of(c, leaf=int(rng.integers(1, 3)))
        assert (t.points == p[t.order]).all() and sorted(t.order.tolist()) == list(range(n))
        for a in range(len(t.lo)):
            inside = np.arange(t.lo[a], t.hi[a])
            assert np.sqrt(((t.points[inside] - t.points[t.centre[a]]) ** 2).sum(axis=1)).max() <= t.radius[a] + 1e-6
            kids = range(t.first[a], t.first[a] + t.count[a])
            assert not kids or [i for b in kids for i in range(t.lo[b], t.hi[b])] == inside.tolist()
        assert (d.nearest(t, ct) == ((t.points[:, None] - c) ** 2).sum(axis=2).argmin(axis=1)).all()


def test_whole_nodes_are_assigned_without_their_vectors(monkeypatch):
    """Far groups of vectors need no comparison of leaves at all."""
    rng = np.random.default_rng(1)
    centres = rng.integers(-(10**6), 10**6, (8, 64))
    p = np.concatenate([c + rng.integers(-50, 50, (250, 64)) for c in centres])
    monkeypatch.setattr(d, "_compare", lambda *a: pytest.fail("compared") if len(a[2]) else None)
    t = d.Tree.of(rng.permutation(p))
    assert sorted(np.bincount(d.nearest(t, d.Tree.of(centres, leaf=1))).tolist()) == [250] * 8


def test_clustered(spark):
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(size=(600, 4)), np.repeat(rng.normal(size=(1, 4)), 300, axis=0)]).astype("f4")
    good = [(int(i), row.tolist(), "z") for i, row in enumerate(x)]
    odd = [(5000, None, "z"), (5001, [1.0] * 3, "z"), (5002, [1.0, None, 1.0, 1.0], "z"), (5003, [float("nan")] * 4, "z"), (5004, [float("inf"), 0.0, 0.0, 0.0], "z"), (5005, [0.0, float("-inf"), 0.0, 0.0], "z")]
    df = spark.createDataFrame(good + odd + [(None, [0.5] * 4, None), (7, x[7].tolist(), None)], "vec_id long, embedding array<float>, cluster string").repartition(3)
    got = d.clustered(df, k=5, rounds=4, dim=4)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    q = np.floor(1024 * np.concatenate([x, [[0.5] * 4], x[7:8]]).astype(float)).astype(int)
    ids = [*range(len(x)), None, 7]
    first = sorted((hashlib.sha256(f"3:{i}".encode()).hexdigest(), q[k].tolist()) for k, i in enumerate(ids) if i is not None)[:5]
    to, dist, at = plain(q, np.array([r[1] for r in first]), 4)
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in at.tolist()]
    want = [(i, int(k), int(e), int(dist[to == k].sum()), int(dist.sum()), sha[k]) for i, k, e in zip(ids, to, dist, strict=True)]
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted(want, key=key)


def test_few_equal_and_large(spark):
    three = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, [1.0, 2.0])], "vec_id int, embedding array<double>")
    assert {tuple(r)[1:5] for r in d.clustered(three, dim=2).collect()} == {(0, 0, 0, 0)}
    assert d.clustered(three.where("false"), dim=2).collect() == []
    with pytest.raises(Exception, match="do not fit 64 bits"):
        d.clustered(spark.createDataFrame([(1, [1e9, 0.0])], "vec_id int, embedding array<double>"), dim=2).collect()
    edge = spark.createDataFrame([(1, [131072.0] * 64), (2, [-131072.0] * 64)], "vec_id int, embedding array<double>")
    assert {tuple(r)[2:5] for r in d.clustered(edge, k=1, rounds=1).collect()} == {(1 << 60, 1 << 61, 1 << 61)}
