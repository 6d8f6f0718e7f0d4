"""Interpolating fusion against NumPy resampling of whole images."""

import numpy as np
import pytest

from voxloom.operators import blocks, storage, warp


def resampled(tiles, maps, shape, how):
    """Every output voxel of every tile, one after the other."""
    top, low = np.zeros(shape), np.zeros(shape)
    for t, a in tiles.items():
        back = np.linalg.inv(maps[t])
        for p in np.ndindex(*shape):
            s = back[:3, :3] @ p + back[:3, 3]
            s = np.where(np.abs(s - np.rint(s)) < 1e-6, np.rint(s), s)
            if (s < 0).any() or (s > np.array(a.shape) - 1).any():
                continue
            i = np.floor(s).astype(int)
            v = sum(np.prod([f if k else 1 - f for f, k in zip(s - i, c, strict=True)]) * a[tuple(np.minimum(i + c, np.array(a.shape) - 1))] for c in np.ndindex(2, 2, 2))
            w = np.prod([min(x + 1, n - x) for x, n in zip(s[1:], a.shape[1:], strict=True)]) if how == "blend" else 1
            if how == "max":
                top[p] = max(top[p], v)
            else:
                top[p] += w * v
                low[p] += w
    return np.floor((top if how == "max" else top / np.where(low > 0, low, 1)) + 1e-6)


def turned(angle, zoom=1.0, shift=(0, 0, 0)):
    m = np.eye(4)
    c, s = np.cos(angle) * zoom, np.sin(angle) * zoom
    m[1:3, 1:3] = [[c, -s], [s, c]]
    m[:3, 3] = shift
    return m


@pytest.mark.parametrize("how", ["mean", "blend", "max"])
@pytest.mark.parametrize("size", [(2, 5, 7), (4, 32, 32)])
def test_warped(spark, how, size):
    rng = np.random.default_rng(5)
    shapes = {3: (4, 12, 11), 8: (3, 9, 14), 9: (4, 6, 6)}
    tiles = {t: rng.integers(0, 60_000, n) for t, n in shapes.items()}
    tiles[8][:, :4] = 0
    tiles[9][:] = 0  # not stored at all, but it weighs
    lean = np.array([[1, 0.1, 0, -0.4], [0, 1, 0.2, 3], [0.3, 0, 0.9, 5], [0, 0, 0, 1]])
    maps = {3: turned(0.3, 1.1, (0.25, 2.5, 1.0)), 8: lean, 9: warp.shifted((0, 4, 4))}
    shape = {"z": 5, "y": 17, "x": 19}
    parts = [(t, *row) for t, a in tiles.items() for c in (0, 1) for row in storage.cut("image", 0, c, (0, 0, 0), a // (c + 1), (2, 4, 5))]
    df = spark.createDataFrame(parts, blocks.PARTS)
    got = np.zeros((2, 5, 17, 19))
    for r in storage.to_voxels(warp.warped(df, maps, shapes, size, shape, how)).collect():
        got[r["c"], r["z"], r["y"], r["x"]] = r["v"]
    for c in (0, 1):
        assert np.array_equal(got[c], resampled({t: a // (c + 1) for t, a in tiles.items()}, maps, (5, 17, 19), how))


def test_moves():
    m = warp.Moves({0: warp.shifted((0, 0.5, -2)), 1: np.diag([1.0, 2, 2, 1])}, {0: (1, 4, 4), 1: (1, 3, 3)})
    assert [x.tolist() for x in m.extent()] == [[0, 0, -2], [0, 4, 4]]
    assert m.meeting(np.array([0, 4, 2]), np.array([0, 9, 9])) == [1]
    with pytest.raises(ValueError, match="inverted"):
        warp.Moves({0: np.zeros((4, 4))}, {0: (1, 1, 1)})
    with pytest.raises(ValueError, match="how"):
        warp.warped(None, {}, {}, (1, 1, 1), {}, "least")


def test_whole_shifts_are_as_fused_without_interpolation(spark):
    rng = np.random.default_rng(6)
    a = rng.integers(0, 9999, (3, 8, 8))
    df = spark.createDataFrame([(k, *row) for k in (0, 1) for row in storage.cut("image", 0, 0, (0, 0, 0), a + k, (2, 3, 8))], blocks.PARTS)
    places, sizes, shape = {0: (0, 0, 0), 1: (1, 5, 6)}, {0: (3, 8, 8), 1: (3, 8, 8)}, {"z": 4, "y": 13, "x": 14}
    for how in ("mean", "blend", "max"):
        one, two = (sorted(tuple(r) for r in storage.to_voxels(x).collect()) for x in (blocks.fused(df, places, sizes, (2, 4, 4), shape, how), warp.warped(df, {k: warp.shifted(p) for k, p in places.items()}, sizes, (2, 4, 4), shape, how)))
        assert one == two
