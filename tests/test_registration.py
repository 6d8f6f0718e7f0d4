"""Registration and fusion through the tasks: planted maps are found, wrong pairs thrown out, size makes no difference."""

import resource

import numpy as np
import pytest

from voxloom import api
from voxloom.kernels import graph, register
from voxloom.operators import crop, fuse, illumination, layout, storage, warp

SCALE = {"z": 1.0, "y": 1.0, "x": 1.0}
RED = [{"wavelength_id": "488", "label": "red", "color": "FF0000"}]
TILES = api.TILE_TABLE


def texture(rng, *shape):
    a = register.smoothed(rng.normal(size=shape), 5)
    return (a - a.min()) * 6000


def turned(angle, zoom=1.0, middle=(0, 0), shift=(0, 0)):
    m = np.eye(4)
    c, s = np.cos(angle) * zoom, np.sin(angle) * zoom
    m[1:3, 1:3] = [[c, -s], [s, c]]
    m[1:3, 3] = np.array(middle) + shift - m[1:3, 1:3] @ middle
    return m


def corners(shape):
    return api._corners(*shape)


def image(spark, path, a, tiles, levels=1):
    """An image of voxels (z, y, x)."""
    z, y, x = np.nonzero(a)
    v = spark.createDataFrame(list(zip([0] * len(z), z.tolist(), y.tolist(), x.tolist(), a[z, y, x].tolist(), strict=True)), "c int, z int, y int, x int, v int")
    t = spark.createDataFrame([(k, float(x0), float(y0), 0.0, float(ox), float(oy), float(n), float(n), float(len(a))) for k, y0, x0, oy, ox, n in tiles], TILES)
    return api.from_voxels(spark, v, t, path, dict(zip("zyx", a.shape, strict=True)), SCALE, RED, api.Size(2, 40, 40), levels)


@pytest.mark.parametrize("kind, angle, zoom", [("rigid", 0.05, 1.0), ("rigid", 0.4, 1.0), ("similarity", -0.2, 1.07), ("affine", 0.03, 0.98)])
def test_a_planted_map_is_found(kind, angle, zoom):
    w = texture(np.random.default_rng(0), 1, 300, 300)
    m = turned(angle, zoom, (59.5, 59.5), (3.2, -2.4))
    if kind == "affine":
        m[1, 2] += 0.03
    b = register.warped(w, warp.shifted((0, 90, 90)) @ np.linalg.inv(m), (1, 120, 120)) * 1.2 + 30
    got, quality = register.map_between(w[:, 90:210, 90:210], b, kind)
    assert np.abs(graph.moved(got, corners((1, 120, 120))) - graph.moved(m, corners((1, 120, 120)))).max() < 0.1 and quality > 0.98


def test_flat_images_have_no_quality():
    m, q = register.map_between(np.zeros((1, 20, 20)), np.ones((1, 20, 20)), "rigid")
    assert q == -1 and np.array_equal(m, np.eye(4))
    with pytest.raises(ValueError, match="transform"):
        register.map_between(np.ones((1, 9, 9)), np.ones((1, 9, 9)), "bent")


def test_stitch_turns_tiles_back(spark, tmp_path):
    """Two by two tiles of one scene, three of them turned a little: the fused image is the scene again."""
    rng = np.random.default_rng(3)
    w = texture(rng, 1, 260, 260)
    n, step, lo = 100, 64, 40
    true, mosaic, rows = {}, np.zeros((1, 2 * n, 2 * n), int), []
    for k in range(4):
        oy, ox = step * (k % 2), step * (k // 2)
        m = warp.shifted((0, oy, ox)) @ (turned([0, 0.03, -0.02, 0.025][k], 1.0, (49.5, 49.5), [(0, 0), (1.3, -0.6), (-0.8, 1.1), (0.7, 0.9)][k]))
        true[k] = m
        y0, x0 = n * (k % 2), n * (k // 2)
        mosaic[:, y0 : y0 + n, x0 : x0 + n] = np.rint(register.warped(w, warp.shifted((0, lo, lo)) @ m, (1, n, n)))
        rows.append((k, y0, x0, oy, ox, n))
    img = image(spark, str(tmp_path / "m"), mosaic, rows)
    maps = api.register_maps(img, 0, "rigid")
    for k, m in true.items():
        assert np.abs(graph.moved(maps[k], corners((1, n, n))) - graph.moved(m, corners((1, n, n)))).max() < 0.35, k
    out = api.Image.open(spark, api.stitch(spark, img.path, str(tmp_path / "s"), api.Channel(label="red"), transform="rigid"))
    got = np.zeros((out.shape["y"], out.shape["x"]))
    for r in out.voxels().collect():
        got[r["y"], r["x"]] = r["v"]
    m = np.array(out.attrs["maps"]["0"])  # tile 0 was not turned
    want = register.warped(w, warp.shifted((0, lo, lo)) @ warp.shifted(tuple(-m[:, 3])), (1, *got.shape))[0]
    inner = (slice(15, -15),) * 2
    assert np.corrcoef(got[inner].ravel(), want[inner].ravel())[0, 1] > 0.995
    with pytest.raises(ValueError, match="transform"):
        api.stitch(spark, img.path, str(tmp_path / "x"), api.Channel(label="red"), transform="bent")


def test_stitch_keeps_parts_of_voxels(spark, tmp_path):
    rng = np.random.default_rng(4)
    w = texture(rng, 1, 120, 200)
    a, b = w[:, 20:80, 20:80], register.warped(w, warp.shifted((0, 20.5, 60.25)), (1, 60, 60))
    mosaic = np.rint(np.concatenate([a, b], axis=2)).astype(int)
    img = image(spark, str(tmp_path / "m"), mosaic, [(0, 0, 0, 0, 0, 60), (1, 0, 60, 0, 40, 60)])
    out = api.Image.open(spark, api.stitch(spark, img.path, str(tmp_path / "s"), api.Channel(label="red"), upsample=20))
    m = {k: np.array(v)[:, 3] for k, v in out.attrs["maps"].items()}
    assert np.abs(m["1"] - m["0"] - [0, 0.5, 40.25]).max() < 0.15
    assert any(k != round(k) for k in m["1"] - m["0"])


def test_views_follow_the_graph_and_turn(spark, tmp_path):
    w = texture(np.random.default_rng(5), 6, 110, 110)
    m = turned(0.15, 1.0, (34.5, 34.5), (2.0, 1.0))
    a = np.rint(w[:, 20:90, 20:90]).astype(int)
    b = np.rint(register.warped(w, warp.shifted((0, 20, 20)) @ m, a.shape)).astype(int)
    views = [image(spark, str(tmp_path / f"v{k}"), v, [(0, 0, 0, 0, 0, 70)]) for k, v in enumerate((a, b))]
    got = api.register_views(views, api.Channel(label="red"), transform="rigid")
    assert np.array_equal(got[0], np.eye(4))
    assert np.abs(graph.moved(got[1], corners(a.shape)) - graph.moved(m, corners(a.shape))).max() < 0.2


def test_sparse_solver_is_least_squares():
    rng = np.random.default_rng(6)
    n = 30
    i, j = np.array([(a, b) for a in range(n) for b in range(a + 1, n) if rng.random() < 0.15 and (a < 20) == (b < 20)]).T
    d, w = rng.normal(size=(len(i), 2)), rng.uniform(0.1, 2, len(i))
    a = np.zeros((len(i), n))
    a[np.arange(len(i)), j], a[np.arange(len(i)), i] = 1, -1
    x = np.linalg.lstsq(a * w[:, None] ** 0.5, d * w[:, None] ** 0.5, rcond=None)[0]
    group = graph.components(n, i, j)
    assert np.allclose(graph.solved(n, i, j, d, w), x - x[group], atol=1e-6)


def test_wrong_pairs_are_thrown_out():
    side = 12
    place = {t: (0.0, 50.0 * (t % side), 50.0 * (t // side)) for t in range(side * side)}
    pairs = [(t, t + 1) for t in place if (t + 1) % side] + [(t, t + side) for t in place if t + side in place]
    edges = [(i, j, tuple(np.subtract(place[j], place[i])), 1.0) for i, j in pairs]
    edges[40] = (*edges[40][:2], (3.0, 90.0, -70.0), 1.0)
    edges[41] = (*edges[41][:2], (0.0, -20.0, 10.0), 1.0)
    off = fuse.resolve_shifts(edges, list(place))
    assert max(np.abs(np.subtract(off[t], place[t])).max() for t in place) > 1
    got = fuse.resolve_shifts(edges, list(place), most=5.0)
    assert max(np.abs(np.subtract(got[t], place[t])).max() for t in place) < 1e-4
    points = corners((1, 9, 9))
    maps = [(i, j, points + (0, 40, 0), points + (0, 40, 0) - np.subtract(place[j], place[i]), 1.0) for i, j in pairs]
    maps[17] = (*maps[17][:3], maps[17][3] + 60.0, 1.0)
    first = {t: warp.shifted(p) for t, p in place.items()}
    for kind in ("rigid", "affine"):
        solved = fuse.resolve_maps(maps, first, kind, most=5.0)
        assert max(np.abs(solved[t] - first[t])[:3, 3].max() for t in place) < 0.01, kind


def test_a_hundred_thousand_tiles():
    side = 316
    n = side * side
    t = np.arange(n)
    right, down = t[(t + 1) % side > 0], t[t + side < n]
    i, j = np.concatenate([right, down]), np.concatenate([right + 1, down + side])
    place = np.stack([t % side, t // side], axis=1) * 50.0
    d = place[j] - place[i]
    d[1000] += 400
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    x, kept = graph.robust(n, i, j, d, np.ones(len(i)), 5.0)
    assert np.abs(x - place).max() < 1e-2 and np.flatnonzero(~kept).tolist() == [1000]
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 1 << 20  # KB
    g = illumination.solve_gains([(int(a), int(b), 1.0) for a, b in zip(i[:5000], j[:5000], strict=True)], list(range(n)))
    assert len(g) == n and set(g.values()) == {1.0}


@pytest.mark.parametrize("side", [22, 23])
def test_shortest_paths_have_the_same_shape_at_any_size(side):
    """484 and 529 tiles: the tree starts in the middle, so no path is longer than to the corners and back."""
    at = {(r, c): side * c + r for r in range(side) for c in range(side)}
    pairs = [(at[r, c], at[r + a, c + b], 20, 2) if a else (at[r, c], at[r + a, c + b], 2, 20) for r, c in at for a, b in ((1, 0), (0, 1)) if (r + a, c + b) in at]
    tree = layout.shortest_paths(pairs)
    assert len(tree) == side * side - 1
    near = {}
    for a, b in tree:
        near.setdefault(a, []).append(b)
        near.setdefault(b, []).append(a)

    def far(start):
        seen, now = {start: 0}, [start]
        for k in now:
            for o in near[k]:
                if o not in seen:
                    seen[o] = seen[k] + 1
                    now.append(o)
        return max(seen.values())

    assert min(map(far, near)) <= side + 1
    one = [(0, 1, 10, 1), (1, 2, 10, 1), (2, 3, 10, 1), (3, 4, 10, 1), (2, 9, 10, 1)]
    assert layout.shortest_paths(one) == sorted(p[:2] for p in one)


def test_crops_snap_in_their_task(spark, tmp_path):
    """Tiles of 20, 16 apart on the stage: a crop from 18 begins at 20, one from 14 stays."""
    a = np.ones((1, 40, 40), int)
    img = image(spark, str(tmp_path / "m"), a, [(2 * c + r, 20 * r, 20 * c, 16 * r, 16 * c, 20) for r in range(2) for c in range(2)])
    regions = spark.createDataFrame([("one", 0.0, 1.0, 18.0, 40.0, 14.0, 40.0)], "roi string, z_start double, z_end double, y_start double, y_end double, x_start double, x_end double")
    out = api.Image.open(spark, api.crop_regions(spark, img.path, regions, str(tmp_path / "c"))[0])
    assert out.attrs["crop"] == {"z": [0, 1], "y": [20, 40], "x": [14, 40]}
    single = spark.createDataFrame([(0, 0.0, 0.0, 20.0, 20.0, 0.0, 0.0)], "tile_id int, y_um double, x_um double, len_y_um double, len_x_um double, y_orig_um double, x_orig_um double")
    assert crop.snapped_to_tiles(regions, single).first()["y_start"] == 18.0


def test_display_limits_are_those_of_the_foreground(spark, tmp_path):
    a = np.full((1, 40, 40), 10)
    a[0, :20, ::2] = np.arange(20)[:, None] * 100 + 1000
    img = image(spark, str(tmp_path / "m"), a, [(0, 0, 0, 0, 0, 40)])
    v = a[0, ::2, ::2].ravel()
    v = v[v > np.median(v)]
    w = img.attrs["channels"][0]["window"]
    assert (w["start"], w["end"]) == (int(np.percentile(v, 0.1)), int(np.percentile(v, 99.9)))


def test_a_failed_write_leaves_the_old_level(spark, tmp_path):
    from pyspark.sql import functions as F

    a = np.arange(1, 1601).reshape(1, 40, 40)
    img = image(spark, str(tmp_path / "m"), a, [(0, 0, 0, 0, 0, 40)])
    bad = img.chunks(0).withColumn("data", F.when(F.col("cy") >= 0, F.raise_error(F.lit("lost"))).cast("binary"))
    with pytest.raises(Exception, match="lost"):
        img.write_level(bad, 0)
    again = api.Image.open(spark, img.path)
    assert again.voxels().count() == 1600
    again.write_level(img.chunks(0).where("false"), 0)
    assert again.voxels().count() == 0
    store = again.store  # broken off between the two moves
    again.write_level(storage.to_chunks(spark.createDataFrame([(0, 0, 1, 1, 7)], "c int, z int, y int, x int, v int"), again.chunk, again.shape), 0)
    store.folder(f"{img.path}/chunks.replaced")
    store.move(f"{img.path}/chunks/image=image/level=0", f"{img.path}/chunks.replaced/level=0")
    assert [r["v"] for r in api.Image.open(spark, img.path).voxels().collect()] == [7]


def test_only_chunks_that_are_needed_leave_the_scan(spark, tmp_path):
    from voxloom.operators import blocks

    a = np.ones((8, 80, 80), int)
    img = image(spark, str(tmp_path / "m"), a, [(2 * c + r, 40 * r, 40 * c, 36 * r, 36 * c, 40) for r in range(2) for c in range(2)])
    assert img.chunks(0).count() == 16  # of 2 by 40 by 40
    rects = spark.createDataFrame([(0, 3, 41, 60), (5, 5, 0, 9)], "y0 int, y1 int, x0 int, x1 int")
    got = blocks.near(img.chunks(0), rects, img.chunk, [3, 7])
    assert sorted((r["z0"], r["y0"], r["x0"]) for r in got.collect()) == [(2, 0, 40), (6, 0, 40)]
    plan = got._sc._jvm.PythonSQLUtils.explainString(got._jdf.queryExecution(), "formatted")
    assert any("PushedFilters" in line and "x0,40)" in line and "In(z0, [2,6])" in line for line in plan.splitlines()), plan
    assert blocks.near(img.chunks(0), rects.where("y0 > 99"), img.chunk).count() == 0
    profiles = api.fit_profiles(img, n_planes=3, params=api.BasicParams(working_size=20))
    assert profiles[0].flat.shape == (20, 20)


def test_tasks_tell_what_was_changed_and_tiles_are_mapped(spark, tmp_path):
    a = np.arange(1, 1601).reshape(1, 40, 40)
    img = image(spark, str(tmp_path / "m"), a, [(0, 0, 0, 0, 0, 20), (1, 0, 20, 0, 16, 20)])
    out = api.map_tiles(img, lambda c, tile, z, y, x, v: v * (tile + 1) + np.arange(y.start, y.stop)[:, None])
    got = np.zeros((40, 40), int)
    for r in storage.to_voxels(out).collect():
        got[r["y"], r["x"]] = r["v"]
    rows = np.arange(20)[:, None]
    assert np.array_equal(got[:20, :20], a[0, :20, :20] + rows) and np.array_equal(got[:20, 20:], 2 * a[0, :20, 20:] + rows) and not got[20:].any()
    flat = api.Profiles(np.ones((20, 20)))
    new = api.Image.open(spark, api.correct_flatfield(spark, img.path, str(tmp_path / "f"), profiles={0: flat}, params=api.BasicParams(working_size=64)))
    told = new.attrs["tasks"]["correct_flatfield"]["parameters"]
    assert told["working_size"] == "64" and "dark" not in told


@pytest.mark.parametrize("side, shuffles", [(40, False), (36, True)])
def test_mosaics_of_whole_chunks_are_read_without_a_shuffle(spark, tmp_path, side, shuffles):
    rng = np.random.default_rng(8)
    a = {k: rng.integers(1, 999, (2, side, side)) for k in range(4)}
    paths = {k: image(spark, str(tmp_path / f"t{k}"), v, [(0, 0, 0, 0, 0, side)]).path for k, v in a.items()}
    positions = spark.createDataFrame([(k, 100.0 - 30 * (k // 2), 100.0 - 30 * (k % 2), side, side) for k in range(4)], "tile_id int, x_pos double, y_pos double, x_n_pixels int, y_n_pixels int")
    img = api.prepare_mosaic(spark, paths, positions, str(tmp_path / "m"))
    chunks = img.chunks(0)
    assert ("Exchange hashpartitioning" in chunks._jdf.queryExecution().executedPlan().toString()) == shuffles
    got = np.zeros((2, 2 * side, 2 * side), int)
    for r in storage.to_voxels(chunks).collect():
        got[r["z"], r["y"], r["x"]] = r["v"]
    want = np.concatenate([np.concatenate([a[0], a[1]], axis=1), np.concatenate([a[2], a[3]], axis=1)], axis=2)
    assert np.array_equal(got, want)
    keys = {(r["cz"], r["cy"], r["cx"], r["z0"], r["y0"], r["x0"]) for r in chunks.collect()}
    assert all((z * 2, y * 40, x * 40) == at for z, y, x, *at in keys for at in [tuple(at)])
