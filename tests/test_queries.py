"""Every registered image query against its SQL in DuckDB on the same tables."""

from pathlib import Path

import duckdb
import pytest

from voxloom.plans.queries import QUERIES, SQL

DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(DIR).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for p in Path(DIR).glob("*.parquet"):
        c.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return c


def norm(v):
    return repr(round(v, 6) + 0.0) if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, duck, name):
    df = QUERIES[name](spark, DIR)
    want = duck.sql(SQL[name])
    cols = sorted(df.columns)
    assert cols == sorted(want.columns)
    at = [want.columns.index(c) for c in cols]
    got = sorted(tuple(norm(r[c]) for c in cols) for r in df.collect())
    assert got == sorted(tuple(norm(r[i]) for i in at) for r in want.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_has_rows(spark, name):
    assert QUERIES[name](spark, DIR).count() > 0


def test_image2d_has_every_embedding(spark):
    from voxloom import derive

    want = spark.read.parquet(f"{DIR}/embeddings.parquet").count()
    assert derive.image2d(spark, DIR).select("y").distinct().count() == want > 64


def test_fuse_affine_has_every_channel(spark):
    assert {r["c"] for r in QUERIES["fuse_affine"](spark, DIR).select("c").distinct().collect()} == {0, 1, 2}


def test_basic_fit_takes_every_plane(spark, monkeypatch):
    from voxloom.operators import flatfield
    from voxloom.plans import queries

    taken = []
    monkeypatch.setattr(queries.flatfield, "sampled_planes", lambda *a, f=flatfield.sampled_planes, **k: taken.append(f(*a, **k)) or taken[-1])
    QUERIES["basic_fit"](spark, DIR)
    assert taken[0].select("tile_id", "z").distinct().count() == 175


def cells(spark, name):
    """(c, y, x) -> voxels of the tile view of a query's image, as arrays by (tile, c, z)."""
    import numpy as np

    from voxloom.plans import queries

    out = np.zeros((25, 3, 7, 10, 10))
    for r in queries.tile_voxels(spark, DIR).collect():
        out[r["tile_id"], r["c"], r["z"], r["y"], r["x"]] = r["v"]
    return out


def test_gain_solve_is_least_squares(spark):
    import numpy as np

    edges = {}
    for r in QUERIES["gain_edges"](spark, DIR).collect():
        edges.setdefault(r["c"], []).append((r["i"], r["j"], r["gain"]))
    got = {(r["c"], r["tile_id"]): r["gain"] for r in QUERIES["gain_solve"](spark, DIR).collect()}
    for c, e in edges.items():
        log = lambda t: np.log([got[c, k] for k in t])
        left = lambda x: sum((x[i] - x[j] - np.log(g)) ** 2 for i, j, g in e)
        x = log(range(25))
        best = left(x)
        assert abs(max(got[c, t] for t in range(25)) - 1) < 1e-9
        for t in range(25):
            for d in (-1e-3, 1e-3):
                y = x.copy()
                y[t] += d
                assert left(y) > best - 1e-9


def test_phase_corr_and_basic_fit_are_their_kernels(spark):
    import numpy as np

    from voxloom.kernels.basic import fit_basic
    from voxloom.kernels.phasecorr import shift_between

    v = cells(spark, "")
    got = {(r["i"], r["j"]): (r["dy"], r["dx"]) for r in QUERIES["phase_corr"](spark, DIR).collect()}
    for i, j, oy, ox in (tuple(r) for r in QUERIES["overlap_pairs"](spark, DIR).collect()):
        a, b = v[i, 0].max(axis=0)[10 - oy :, 10 - ox :], v[j, 0].max(axis=0)[:oy, :ox]
        assert got[i, j] == shift_between(a, b)[:2]
    fit = {(r["c"], r["y"], r["x"]): r["flat"] for r in QUERIES["basic_fit"](spark, DIR).collect()}
    for c in range(3):
        flat = fit_basic(v[:, c].reshape(-1, 10, 10))[0]
        assert np.allclose([[fit[c, y, x] for x in range(10)] for y in range(10)], flat)


def test_fuse_affine_is_the_mean_of_moved_tiles(spark):
    import numpy as np

    v = cells(spark, "")
    top, low = np.zeros((3, 7, 42, 42)), np.zeros((42, 42))
    for t in range(25):
        y, x = 8 * (t % 5), 8 * (t // 5)
        top[:, :, y : y + 10, x : x + 10] += v[t]
        low[y : y + 10, x : x + 10] += 1
    got = np.zeros(top.shape)
    for r in QUERIES["fuse_affine"](spark, DIR).collect():
        got[r["c"], r["z"], r["y"], r["x"]] = r["v"]
    assert (got == np.floor(top / low + 1e-9)).all()


@pytest.mark.parametrize("zoom", [1.0, 2.5])
def test_affines_leave_no_holes(spark, zoom):
    import numpy as np

    from voxloom.operators import fuse

    rows = [(0, 0, 0, y, x, 100) for y in range(20) for x in range(20) if not (5 <= y < 12 and x < 4)]
    df = spark.createDataFrame(rows, "tile_id int, c int, z int, y int, x int, v int")
    a = np.array([[zoom, 0, 0], [0, zoom, 0]])
    side = int(20 * zoom)
    out = fuse.affine_fused(df, {0: a}, (side, side), (20, 20), block=8).collect()
    assert len({(r["y"], r["x"]) for r in out}) == len(out) == side * side and {r["v"] for r in out} >= {0, 100}
