import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxloom import api
from voxloom.operators import metadata, pyramid, slicing, storage
from voxloom.sources import metafiles, planes
from voxloom.streaming import ingest

SCALE = {"z": 1.0, "y": 1.0, "x": 1.0}
CHANNELS = [{"wavelength_id": "561", "label": "red", "color": "00FF00"}, {"wavelength_id": "640", "label": "far red", "color": "FF0000"}]


def frame(spark, a):
    at = np.argwhere(a >= 0)
    return spark.createDataFrame([(*map(int, p), int(a[tuple(p)])) for p in at], "c int, z int, y int, x int, v int")


def array(df, shape):
    a = np.zeros(shape, int)
    for r in df.collect():
        a[r["c"], r["z"], r["y"], r["x"]] = r["v"]
    return a


def tiles(spark, rows):
    return spark.createDataFrame([(k, float(x), float(y), 0.0, float(ox), float(oy), float(w), float(h), 4.0) for k, y, x, oy, ox, h, w in rows], "tile_id int, x_um double, y_um double, z_um double, x_orig_um double, y_orig_um double, len_x_um double, len_y_um double, len_z_um double")


@pytest.fixture(scope="module")
def image(spark, tmp_path_factory):
    a = np.random.default_rng(5).integers(1, 60000, (2, 4, 16, 16))
    t = tiles(spark, [(5 * 0 + 2 * (x // 8) + y // 8, y, x, y * 6 // 8, x * 6 // 8, 8, 8) for x in (0, 8) for y in (0, 8)])
    path = str(tmp_path_factory.mktemp("img") / "a")
    img = api.from_voxels(spark, frame(spark, a), t, path, {"z": 4, "y": 16, "x": 16}, SCALE, CHANNELS, api.Size(2, 8, 8), levels=3)
    return img, a


def test_stored_levels_equal_padded_block_means(image):
    img, a = image
    assert (array(img.voxels(), a.shape) == a).all()
    f = img.levels[0]
    assert (f["factor_z"], f["factor_yx"]) == (1, 2)
    want = a.reshape(2, 4, 8, 2, 8, 2).mean(axis=(3, 5)).astype(int)
    assert (array(img.voxels(1), want.shape) == want).all()
    assert img.attrs["channels"][0]["window"]["end"] > 0


def test_box_reads_only_chunks_that_meet_it(image):
    img, _ = image
    c = slicing.chunk_slice(img.chunks(0), {"y": (9, 11), "x": (0, 3)})
    assert {(r["cy"], r["cx"]) for r in c.collect()} == {(1, 0)}


def test_odd_edges_are_padded(spark):
    a = np.random.default_rng(6).integers(0, 999, (1, 3, 5, 7))
    got = array(pyramid.coarsened(frame(spark, a), {"z": 3, "y": 5, "x": 7}, {"z": 2, "y": 2, "x": 2}), (1, 2, 3, 4))
    p = np.pad(a, [(0, 0), (0, 1), (0, 1), (0, 1)], mode="edge")
    assert (got == p.reshape(1, 2, 2, 3, 2, 4, 2).mean(axis=(2, 4, 6)).astype(int)).all()


def test_unit_profile_and_gain_change_nothing(spark, image, tmp_path):
    img, a = image
    one = {c: api.Profiles(np.ones((8, 8)) - 1e-6) for c in range(2)}
    out = api.correct_flatfield(spark, img.path, str(tmp_path / "flat"), profiles=one)
    assert (array(api.Image.open(spark, out).voxels(), a.shape) == a).all()


def test_flatfield_golden_number(spark):
    from voxloom.functions.numeric import flatfield_value

    df = spark.createDataFrame([(100, 10.0)], "v int, f double")
    assert df.select(flatfield_value(F.col("v"), F.col("f"))).first()[0] == 9


def test_illumination_evens_out_a_dim_tile(spark, tmp_path):
    a = np.full((1, 4, 8, 16), 1000)
    a[..., 8:] = 500
    t = tiles(spark, [(0, 0, 0, 0, 0, 8, 8), (1, 0, 8, 0, 4, 8, 8)])
    img = api.from_voxels(spark, frame(spark, a), t, str(tmp_path / "i"), {"z": 4, "y": 8, "x": 16}, SCALE, CHANNELS[:1], api.Size(4, 8, 8), levels=1)
    out = api.Image.open(spark, api.correct_illumination(spark, img.path, str(tmp_path / "o")))
    got = array(out.voxels(), a.shape)
    assert abs(got[..., :8].mean() - got[..., 8:].mean()) < 2


def test_crop_is_a_slice(spark, image, tmp_path):
    img, a = image
    r = spark.createDataFrame([("r1", 0.0, 3.0, 5.0, 13.0, 14.0, 2.0)], "roi string, z_start double, z_end double, y_start double, y_end double, x_start double, x_end double")
    (path,) = api.crop_regions(spark, img.path, r, str(tmp_path), levels=2)
    assert (array(api.Image.open(spark, path).voxels(), (2, 3, 8, 12)) == a[:, :3, 5:13, 2:14]).all()


def test_stitch_puts_tiles_back(spark, tmp_path):
    scene = np.random.default_rng(7).integers(1, 50000, (20, 36))
    h, w, lap = 20, 20, 4
    a = np.concatenate([scene[:, :w], scene[:, w - lap : 2 * w - lap]], axis=1)[None, None]
    t = tiles(spark, [(0, 0, 0, 0, 0, h, w), (1, 0, w, 0, w - lap, h, w)])
    img = api.from_voxels(spark, frame(spark, a), t, str(tmp_path / "s"), {"z": 1, "y": h, "x": 2 * w}, SCALE, CHANNELS[:1], api.Size(1, 32, 32), levels=1)
    out = api.Image.open(spark, api.stitch(spark, img.path, str(tmp_path / "t"), api.Channel(label="RED")))
    assert (array(out.voxels(), (1, 1, *scene.shape))[0, 0] == scene).all()


def test_fuse_as_channels_and_views(spark, image, tmp_path):
    img, a = image
    out = api.Image.open(spark, api.fuse_images(spark, [img.path, img.path], str(tmp_path / "c")))
    assert len(out.attrs["channels"]) == 2 and (array(out.voxels(), a.shape) == a).all()
    out = api.Image.open(spark, api.fuse_images(spark, [img.path, img.path], str(tmp_path / "v"), registration_channel=api.Channel(wavelength_id="640")))
    assert (array(out.voxels(), a.shape) == a).all()


def test_restructure_archive_restore(spark, image, tmp_path):
    img, a = image
    api.shutil.copytree(img.path, tmp_path / "m")
    m = api.modify_structure(spark, str(tmp_path / "m"), name="new", chunk=api.Size(4, 4, 16), levels=2, channels=[{"label": "crimson"}])
    got = api.Image.open(spark, m)
    assert (array(got.voxels(), a.shape) == a).all() and got.attrs["channels"][0]["label"] == "crimson" and len(got.levels) == 2
    (tmp_path / "ar").mkdir(), (tmp_path / "re").mkdir()
    tar = api.archive(spark, img.path, str(tmp_path / "ar"))
    back = api.Image.open(spark, api.restore(spark, tar, str(tmp_path / "re")))
    assert (array(back.voxels(), a.shape) == a).all()
    small = api.Image.open(spark, str(tmp_path / "ar" / "a_preview"))
    assert small.shape == {"z": 2, "y": 4, "x": 4} and small.voxels().count() > 0


META = "[Metadata for file] {f}\n[Laser] {l} nm\n[Intensity (%)] 55\n[Zoom] 20x\n[Pixelsize in um] 1\n[Filter] 647LP\n[Shutter] Right\n[x_pos] 4\n[y_pos] 3\n[z_stepsize] 1\n[z_planes] 2\n[x_pixels] 3\n[y_pixels] 4\n\n"


def tiff(plane):
    h, w = plane.shape
    data = plane.astype("<u2").tobytes()
    tags = [(256, 3, w), (257, 3, h), (258, 3, 16), (259, 3, 1), (273, 4, 8), (279, 4, len(data))]
    ifd = struct.pack("<H", len(tags)) + b"".join(struct.pack("<HHI", t, k, 1) + (struct.pack("<HH", v, 0) if k == 3 else struct.pack("<I", v)) for t, k, v in tags) + struct.pack("<I", 0)
    return b"II" + struct.pack("<HI", 42, 8 + len(data)) + data + ifd


def test_raw_ingest_golden(spark, tmp_path):
    gold = np.arange(24).reshape(2, 3, 4)
    for laser in (561, 640):
        (gold + (laser == 640)).astype("<u2").tofile(tmp_path / f"s_{laser}.raw")
    (tmp_path / "s.raw_meta.txt").write_text("".join(META.format(f=f, l=f) for f in (561, 640)))
    out = api.ingest(spark, str(tmp_path), str(tmp_path / "img"), extension="raw", chunk=api.Size(1, 2, 2), levels=1)
    img = api.Image.open(spark, out)
    assert img.shape == {"z": 2, "y": 3, "x": 4}  # pixel counts of one row or column of tiles are swapped
    got = array(img.voxels(), (2, 2, 3, 4))
    assert (got[0] == gold).all() and (got[1] == gold + 1).all()


def test_tiff_and_chunked_folder_sources(spark, tmp_path):
    gold = np.arange(12).reshape(3, 4)
    (tmp_path / "a.tiff").write_bytes(tiff(gold))
    planes.register(spark)
    got = storage.to_voxels(spark.read.format("voxtiff").option("path", str(tmp_path / "a.tiff")).load(), zeros=True)
    assert (array(got, (1, 1, 3, 4))[0, 0] == gold).all()
    import json
    import zlib

    d = tmp_path / "z" / "0"
    d.mkdir(parents=True)
    (d / ".zarray").write_text(json.dumps({"shape": [1, 2, 3, 4], "chunks": [1, 1, 2, 4], "dtype": "<u2", "compressor": {"id": "zlib"}}))
    vol = np.arange(24).reshape(1, 2, 3, 4)
    for z in range(2):
        for y in range(2):
            b = np.zeros((1, 1, 2, 4), "<u2")
            part = vol[:, z : z + 1, 2 * y : 2 * y + 2]
            b[:, :, : part.shape[2]] = part
            (d / f"0.{z}.{y}.0").write_bytes(zlib.compress(b.tobytes()))
    got = storage.to_voxels(spark.read.format("voxzarr").option("path", str(tmp_path / "z")).load())
    assert (array(got, vol.shape) == vol).all()


def test_file_contracts(spark, tmp_path):
    with pytest.raises(ValueError):
        metafiles.raw_files(spark, str(tmp_path), extension="png")
    (tmp_path / "x.txt").write_text("")
    with pytest.raises(FileNotFoundError):
        metafiles.raw_files(spark, str(tmp_path), extension="h5")
    assert metafiles.tile_index_gaps(["a_s0-t0_meta.txt", "a_s2-t0_meta.txt"]) == [1]
    with pytest.raises(ValueError):
        metafiles.checked_settings('{"640": {"label": "x"}}')
    with pytest.raises(ValueError):
        metadata.require(spark.createDataFrame([(None, 1.0)], "channel string, x_scale double"), ["channel", "x_scale"])
    with pytest.raises(ValueError):
        api.Channel()


def test_streaming_ingest_takes_each_file_once(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a_meta.txt").write_text(META.format(f="a", l=561))
    args = (spark, str(src), str(tmp_path / "out"), str(tmp_path / "ck"))
    ingest.ingest(*args)
    (src / "b_meta.txt").write_text(META.format(f="b", l=640))
    ingest.ingest(*args)
    ingest.ingest(*args)
    assert sorted(r[0] for r in spark.read.parquet(str(tmp_path / "out")).select("channel").collect()) == ["561", "640"]


def test_zeros_that_are_not_stored_weigh_in_fusion(spark, tmp_path):
    a = np.zeros((1, 2, 8, 16), int)
    a[..., :8] = 100
    t = tiles(spark, [(0, 0, 0, 0, 0, 8, 8), (1, 0, 8, 0, 4, 8, 8)])
    img = api.from_voxels(spark, frame(spark, a), t, str(tmp_path / "z"), {"z": 2, "y": 8, "x": 16}, SCALE, CHANNELS[:1], api.Size(1, 8, 8), levels=1)
    out = api.Image.open(spark, api.stitch(spark, img.path, str(tmp_path / "f"), api.Channel(label="red"), blend=False, least_quality=2.0))
    got = array(out.voxels(), (1, 2, 8, 12))
    assert (got[..., :4] == 100).all() and (got[..., 4:8] == 50).all() and (got[..., 8:] == 0).all()
    two = api.from_voxels(spark, frame(spark, a[..., ::-1].copy()), t, str(tmp_path / "y"), {"z": 2, "y": 8, "x": 16}, SCALE, CHANNELS[:1], api.Size(1, 8, 8), levels=1)
    out = api.Image.open(spark, api.fuse_images(spark, [img.path, two.path], str(tmp_path / "v"), shifts={}, registration_channel=api.Channel(label="red")))
    assert (array(out.voxels(), a.shape) == 50).all()


def test_fewer_levels_leave_none_behind(spark, image, tmp_path):
    img, _ = image
    api.shutil.copytree(img.path, tmp_path / "p")
    api.modify_structure(spark, str(tmp_path / "p"), levels=2)
    p = api.Image.open(spark, str(tmp_path / "p"))
    assert {r[0] for r in p.chunks().select("level").distinct().collect()} == {0, 1}
    (tmp_path / "to").mkdir()
    api.archive(spark, p.path, str(tmp_path / "to"))
    small = api.Image.open(spark, str(tmp_path / "to" / "p_preview"))
    assert small.shape == {"z": 4, "y": 8, "x": 8}
    assert (array(small.voxels(), (2, 4, 8, 8)) == array(p.voxels(1), (2, 4, 8, 8))).all()


def test_a_level_that_became_zero_is_replaced(spark, image, tmp_path):
    img, a = image
    api.shutil.copytree(img.path, tmp_path / "q")
    q = api.Image.open(spark, str(tmp_path / "q"))
    q.write_level(storage.to_chunks(frame(spark, a[:1]), q.chunk, q.shape), 0)
    q.build(3)
    assert {r[0] for r in q.chunks().select("c").distinct().collect()} == {0}


def test_files_have_to_match_the_metadata(spark, tmp_path):
    np.zeros(24, "<u2").tofile(tmp_path / "s_561.raw")
    (tmp_path / "s_561.raw_meta.txt").write_text("".join(META.format(f=f, l=f) for f in (561, 640)))
    with pytest.raises(ValueError, match="1 image files for 2"):
        api.ingest(spark, str(tmp_path), str(tmp_path / "img"), extension="raw")
    np.zeros(24, "<u2").tofile(tmp_path / "s_405.raw")
    with pytest.raises(ValueError):
        api.ingest(spark, str(tmp_path), str(tmp_path / "img"), pattern="s_", extension="raw")
    with pytest.raises(ValueError, match="excluded"):
        api.ingest(spark, str(tmp_path), str(tmp_path / "img"), extension="raw", excluded={"640": [4]})
    assert api.stacks_of(["b_640.raw", "a_561.raw"], ["561", "640"]) == ["a_561.raw", "b_640.raw"]


def test_pixel_counts_go_by_the_first_step(spark):
    row = lambda k, x, y: (k, float(x), float(y), 30, 12, 1.0, 1.0)
    schema = "row long, x_pos double, y_pos double, x_n_pixels int, y_n_pixels int, x_scale double, y_scale double"
    at = [(0, 0), (10, 0), (0, 25), (10, 25)]
    got = metadata.checked_pixels(spark.createDataFrame([row(k, *p) for k, p in enumerate(at)], schema)).collect()
    assert {(r["x_n_pixels"], r["y_n_pixels"]) for r in got} == {(12, 30)}  # 12 - 25 < 0, swapped 30 - 25 and 12 - 10 are not
    at = [(0, 0), (10, 0), (0, 12.4), (10, 12.4)]
    got = metadata.checked_pixels(spark.createDataFrame([row(k, *p) for k, p in enumerate(at)], schema)).collect()
    assert {(r["x_n_pixels"], r["y_n_pixels"]) for r in got} == {(30, 12)}  # 12.4 is 12 whole pixels: the tiles meet


def raw_folder(path, lasers=(561,)):
    path.mkdir()
    for k, laser in enumerate(lasers):
        (np.arange(24) + k).astype("<u2").tofile(path / f"s_{laser}.raw")
    (path / "s.raw_meta.txt").write_text("".join(META.format(f=f, l=f) for f in lasers))
    return str(path)


def test_a_group_takes_more_images(spark, tmp_path):
    src, out = raw_folder(tmp_path / "in"), str(tmp_path / "group")
    one = api.ingest(spark, src, out, name="one", chunk=api.Size(1, 2, 2), levels=1)
    before = api.Image.open(spark, one).attrs
    api.ingest(spark, src, out, name="two", chunk=api.Size(1, 2, 2), levels=1)
    assert api.images_of(spark, out) == ["one", "two"] and api.Image.open(spark, one).attrs == before
    with pytest.raises(FileExistsError):
        api.ingest(spark, src, out, name="two")
    api.ingest(spark, src, out, name="two", overwrite=True, chunk=api.Size(2, 3, 4), levels=1)
    assert api.images_of(spark, out) == ["one", "two"] and api.Image.open(spark, f"{out}/two").chunk == (2, 3, 4)


def test_a_group_of_labels(spark, image):
    img, _ = image
    r = spark.createDataFrame([("a", 0.0, 2.0, 3.0, 9.0, 1.0, 7.0), ("b", 1.0, 4.0, 6.0, 16.0, 8.0, 16.0)], "roi string, z_start double, z_end double, y_start double, y_end double, x_start double, x_end double")
    path = api.mask_regions(spark, img.path, r, "both")
    want = np.zeros((1, 4, 16, 16), int)
    want[:, 0:2, 3:9, 1:7] = 1
    want[:, 1:4, 6:16, 8:16] = 1
    label = api.Image.open(spark, path)
    assert (array(label.voxels(), want.shape) == want).all() and label.attrs["label"]["name"] == "both"
    assert (array(label.voxels(1), (1, 4, 8, 8)) == want.reshape(1, 4, 8, 2, 8, 2).max(axis=(3, 5))).all()
    assert img.store.read(f"{img.path}/labels/labels.json") == {"labels": ["both"]}
    with pytest.raises(FileExistsError):
        api.mask_regions(spark, img.path, r, "both")


def test_a_virtual_mosaic_and_its_missing_level(spark, tmp_path):
    rng = np.random.default_rng(9)
    whole = rng.integers(0, 999, (1, 2, 16, 24))
    whole[..., :8, :8] = 0  # a tile of zeros
    stores = {}
    for t in range(6):  # two rows, three columns, down columns first
        r, c = t % 2, t // 2
        tile = whole[..., 8 * r : 8 * r + 8, 8 * c : 8 * c + 8]
        stores[t] = api.from_voxels(spark, frame(spark, tile), tiles(spark, [(0, 0, 0, 0, 0, 8, 8)]), str(tmp_path / f"t{t}"), {"z": 2, "y": 8, "x": 8}, SCALE, CHANNELS[:1], api.Size(2, 4, 4), levels=2).path
    pos = spark.createDataFrame([(t, 100.0 - 8 * (t // 2), 50.0 - 8 * (t % 2), 8, 8) for t in range(6)], "tile_id int, x_pos double, y_pos double, x_n_pixels int, y_n_pixels int")
    api.prepare_mosaic(spark, stores, pos, str(tmp_path / "m"))
    m = api.Image.open(spark, str(tmp_path / "m"))
    assert m.shape == {"z": 2, "y": 16, "x": 24} and (array(m.voxels(), whole.shape) == whole).all()
    half = whole.reshape(1, 2, 8, 2, 12, 2).sum(axis=(3, 5)) // 4
    assert (array(storage.to_voxels(m.chunks(1)).select("c", "z", "y", "x", "v"), half.shape) == half).all()
    quarter = half.reshape(1, 1, 2, 4, 2, 6, 2).sum(axis=(2, 4, 6)) // 8  # z is finer than y by now
    assert (array(storage.to_voxels(m.chunks(2)).select("c", "z", "y", "x", "v"), quarter.shape) == quarter).all()
    assert api.Image.open(spark, stores[5]).attrs["translation"] == [0.0, 8.0, 16.0]
    n = m.ngff()["multiscales"][0]
    assert [d["coordinateTransformations"][0]["scale"] for d in n["datasets"]] == [[1.0, 1.0, 1.0, 1.0], [1.0, 1.0, 2.0, 2.0]] and n["name"] == "m"
    assert api.Image.open(spark, stores[5]).ngff()["multiscales"][0]["datasets"][0]["coordinateTransformations"][1]["translation"] == [0.0, 0.0, 8.0, 16.0]
    flat = api.correct_flatfield(spark, m.path, str(tmp_path / "mf"), profiles={0: api.Profiles(np.ones((8, 8)) - 1e-6)})
    assert (array(api.Image.open(spark, flat).voxels(), whole.shape) == whole).all()


def test_views_are_registered(spark, tmp_path):
    scene = np.random.default_rng(11).integers(1, 50000, (6, 24, 24))
    a, b = scene[None, :5, :20, :20], scene[None, 1:6, 3:23, 2:22]
    paths = []
    for k, v in enumerate((a, b)):
        paths.append(api.from_voxels(spark, frame(spark, v), tiles(spark, [(0, 0, 0, 0, 0, 20, 20)]), str(tmp_path / f"v{k}"), {"z": 5, "y": 20, "x": 20}, SCALE, CHANNELS[:1], api.Size(2, 8, 8), levels=1).path)
    for k in (0, 1):
        api.shutil.copytree(paths[k], tmp_path / "sib" / f"obj_sh{k}")
    api.shutil.copytree(paths[0], tmp_path / "sib" / "other")
    assert api.sibling_images(spark, str(tmp_path / "sib")) == {"obj": [f"{tmp_path}/sib/obj_sh{k}" for k in (0, 1)], "other": [f"{tmp_path}/sib/other"]}
    out = api.Image.open(spark, api.fuse_images(spark, paths, str(tmp_path / "w"), registration_channel=api.Channel(label="red")))
    assert out.attrs["places"] == [[0, 0, 0], [1, 3, 2]]
    got = array(out.voxels(), (1, 6, 23, 22))
    assert (got[0, :5, :20, :20] == a[0]).all() and (got[0, 1:, 3:, 2:] == b[0]).all()


@pytest.mark.parametrize("pruning", [None, "axis_aligned", "shortest_paths", "large_overlaps"])
def test_tiles_shifted_along_z_are_put_back(spark, tmp_path, pruning):
    scene = np.random.default_rng(12).integers(1, 50000, (8, 34, 34))
    h, lap = 20, 6
    step, moved = h - lap, {0: (1, 0, 0), 1: (0, 0, 0), 2: (2, 0, 0), 3: (1, 0, 0)}
    a = np.zeros((1, 6, 2 * h, 2 * h), int)
    rows = []
    for t in range(4):
        r, c = t % 2, t // 2
        z = moved[t][0]
        a[0, :, h * r : h * r + h, h * c : h * c + h] = scene[z : z + 6, step * r : step * r + h, step * c : step * c + h]
        rows.append((t, h * r, h * c, step * r, step * c, h, h))
    img = api.from_voxels(spark, frame(spark, a), tiles(spark, rows), str(tmp_path / "s"), {"z": 6, "y": 2 * h, "x": 2 * h}, SCALE, CHANNELS[:1], api.Size(3, 16, 16), levels=1)
    out = api.Image.open(spark, api.stitch(spark, img.path, str(tmp_path / "t"), api.Channel(label="red"), pruning=pruning, on_projection=False))
    z = {int(t): d[0] - out.attrs["shifts"]["0"][0] for t, d in out.attrs["shifts"].items()}
    assert {t: round(v) for t, v in z.items()} == {t: moved[t][0] - moved[0][0] for t in range(4)}
    assert (array(out.voxels(), (1, 8, 34, 34))[0, 2:6] == scene[2:6]).all()


def test_profiles_are_fitted_from_chunks(spark, tmp_path):
    rng = np.random.default_rng(13)
    shade = 0.6 + 0.4 * np.outer(np.hanning(18)[1:-1], np.hanning(18)[1:-1])
    shade /= shade.mean()
    a = np.zeros((1, 40, 32, 32), int)
    for z in range(40):
        for r in (0, 16):
            for c in (0, 16):
                a[0, z, r : r + 16, c : c + 16] = 1000 * rng.uniform(0.8, 1.2) * shade
    t = tiles(spark, [(2 * (c // 16) + r // 16, r, c, r, c, 16, 16) for c in (0, 16) for r in (0, 16)])
    img = api.from_voxels(spark, frame(spark, a), t, str(tmp_path / "b"), {"z": 40, "y": 32, "x": 32}, SCALE, CHANNELS[:1], api.Size(16, 20, 20), levels=1)
    for how in ({"empty_tiles": True}, {"n_planes": 60}, {"n_planes": 60, "params": api.BasicParams(approximate=True)}):
        p = api.fit_profiles(img, **how)[0]
        assert np.abs(p.flat / p.flat.mean() - shade).max() < (0.25 if "empty_tiles" in how else 0.12), how
    with pytest.raises(ValueError, match="no tiles"):
        api.fit_profiles(img, tiles=[9])


def test_settings(tmp_path, capsys):
    from voxloom import settings

    at = str(tmp_path / "set")
    (tmp_path / "mine.json").write_text('{"640": {"label": "far", "laser_wavelength": "640", "color": "FF0000"}}')
    assert settings.main(["--folder", at, "add", str(tmp_path / "mine.json"), "lectin"]) == 0
    assert settings.names(at) == ["default", "lectin"] and settings.load("lect", at)["640"]["label"] == "far"
    settings.main(["--folder", at, "list"])
    settings.main(["--folder", at, "show", "lectin"])
    assert "lectin" in capsys.readouterr().out
    with pytest.raises(FileNotFoundError):
        settings.find("none", at)
    (tmp_path / "bad.json").write_text('{"640": {"label": "far"}}')
    with pytest.raises(ValueError):
        settings.add(str(tmp_path / "bad.json"), "x", at)


FAKE_H5 = '''
import numpy as np


class File(dict):
    """Stands in for an h5 file: an npz under its name."""

    def __init__(self, path, mode="r"):
        with open(path, "rb") as f:
            super().__init__(np.load(f))

    def __enter__(self):
        return self

    def __exit__(self, *_):
        pass
'''


def test_h5_tiles_are_laid_out(spark, tmp_path, monkeypatch):
    (tmp_path / "h5py.py").write_text(FAKE_H5)
    monkeypatch.syspath_prepend(str(tmp_path))
    spark.sparkContext.addPyFile(str(tmp_path / "h5py.py"))
    src = tmp_path / "in"
    src.mkdir()
    gold = np.arange(24).reshape(2, 3, 4)
    place = [(9, 5), (9, 2), (5, 5), (5, 2)]  # x and y positions; larger ones come first
    with open(src / "a_Mag1.h5", "wb") as f:
        np.savez(f, **{f"t00000/s{k:02}/0/cells": gold + 100 * k for k in range(8)})
    block = META.replace("[x_pos] 4", "[x_pos] {x}").replace("[y_pos] 3", "[y_pos] {y}").replace("[x_pixels] 3", "[x_pixels] 4").replace("[y_pixels] 4", "[y_pixels] 3")
    for k in range(8):
        x, y = place[k % 4]
        (src / f"a_Mag1.h5_s{k}-t0_meta.txt").write_text(block.format(f=k, l=561 if k < 4 else 640, x=x, y=y))
    out = api.Image.open(spark, api.ingest(spark, str(src), str(tmp_path / "img"), extension="h5", chunk=api.Size(1, 2, 3), levels=1))
    got = array(out.voxels(), (2, 2, 6, 8))
    for c in range(2):
        want = np.block([[[gold + 100 * (4 * c), gold + 100 * (4 * c + 2)], [gold + 100 * (4 * c + 1), gold + 100 * (4 * c + 3)]]])
        assert (got[c] == want).all()
    t = {r["tile_id"]: r for r in out.tiles().collect()}
    assert [(t[k]["y_um"], t[k]["x_um"], t[k]["y_orig_um"], t[k]["x_orig_um"]) for k in range(4)] == [(0, 0, 0, 0), (3, 0, 3, 0), (0, 4, 0, 4), (3, 4, 3, 4)]
    (src / "a_Mag1.h5_s3-t0_meta.txt").unlink()
    with pytest.raises(FileNotFoundError, match="3"):
        api.ingest(spark, str(src), str(tmp_path / "img2"), extension="h5")


def test_tiff_ingest_golden(spark, tmp_path):
    gold = np.arange(24).reshape(2, 3, 4)
    h, w = 3, 4
    body, pages = b"II" + struct.pack("<HI", 42, 0), []
    for p in gold:
        pages.append(len(body))
        body += p.astype("<u2").tobytes()
    for k, at in enumerate(pages):
        here = len(body)
        body = body[:4] + struct.pack("<I", here) + body[8:] if k == 0 else body[:last] + struct.pack("<I", here) + body[last + 4 :]
        tags = [(256, 3, w), (257, 3, h), (258, 3, 16), (259, 3, 1), (273, 4, at), (279, 4, h * w * 2)]
        body += struct.pack("<H", len(tags)) + b"".join(struct.pack("<HHI", t, n, 1) + (struct.pack("<HH", v, 0) if n == 3 else struct.pack("<I", v)) for t, n, v in tags)
        last = len(body)
        body += struct.pack("<I", 0)
    (tmp_path / "s_561.tiff").write_bytes(body)
    (tmp_path / "s_561.tiff_meta.txt").write_text(META.format(f=561, l=561))
    img = api.Image.open(spark, api.ingest(spark, str(tmp_path), str(tmp_path / "img"), extension="tiff", chunk=api.Size(1, 2, 2), levels=1))
    assert (array(img.voxels(), (1, 2, 3, 4))[0] == gold).all()


def test_tile_stores_have_to_match(spark, tmp_path):
    for t in range(2):
        (tmp_path / f"a_Tile{t}_Ch561_x.ome.zarr_meta.txt").write_text(META.format(f="a", l=561) * (2 if t else 1))
    got = metafiles.per_tile_stores(spark, str(tmp_path)).collect()
    assert sorted(r["tile_id"] for r in got) == [0, 1, 1]
    with pytest.raises(ValueError, match="2 stores, but 3"):
        metafiles.per_tile_stores(spark, str(tmp_path), ["a", "b", "c"])
    (tmp_path / "a_Tile2_Ch640_x.ome.zarr_meta.txt").write_text(META.format(f="a", l=561))
    with pytest.raises(ValueError, match="disagree"):
        metafiles.per_tile_stores(spark, str(tmp_path))


def test_arrivals_are_counted_by_minute(spark, tmp_path):
    src, out = str(tmp_path / "s"), str(tmp_path / "o")
    rows = [("2024-01-01 00:00:10", 0, b"ab"), ("2024-01-01 00:00:50", 0, b"c"), ("2024-01-01 00:01:10", 1, b"defg")]
    spark.createDataFrame(rows, "t string, c int, data binary").select(F.to_timestamp("t").alias("seen"), "c", "data").write.parquet(src)
    q = ingest.arrivals(spark.readStream.schema("seen timestamp, c int, data binary").parquet(src)).writeStream.outputMode("complete").format("memory").queryName("arrived").option("checkpointLocation", out).trigger(availableNow=True).start()
    q.awaitTermination()
    got = sorted((r["window"]["start"].minute, r["c"], r["chunks"], r["bytes"]) for r in spark.table("arrived").collect())
    assert got == [(0, 0, 2, 3), (1, 1, 1, 4)]


def test_a_folder_of_tile_images_is_a_mosaic(spark, tmp_path):
    (tmp_path / "st").mkdir(), (tmp_path / "meta").mkdir()
    whole = np.random.default_rng(14).integers(1, 999, (2, 1, 8, 8))
    block = META.replace("[x_pos] 4", "[x_pos] {x}").replace("[y_pos] 3", "[y_pos] {y}").replace("[x_pixels] 3", "[x_pixels] 4").replace("[z_planes] 2", "[z_planes] 1")
    for t in range(4):
        for k, c in enumerate((561, 640)):
            r, q = t % 2, t // 2
            tile = whole[k : k + 1, :, 4 * r : 4 * r + 4, 4 * q : 4 * q + 4]
            name = f"a_Tile{t}_Ch{c}_Sh0"
            api.from_voxels(spark, frame(spark, tile), tiles(spark, [(0, 0, 0, 0, 0, 4, 4)]), str(tmp_path / "st" / name), {"z": 1, "y": 4, "x": 4}, SCALE, [CHANNELS[k]], api.Size(1, 4, 4), levels=1)
            (tmp_path / "meta" / f"{name}.ome.zarr_meta.txt").write_text(block.format(f="a", l=c, x=50 - 3 * q, y=40 - 3 * r))
    m = api.prepare_folder(spark, str(tmp_path / "meta"), str(tmp_path / "st"), str(tmp_path / "m"))
    assert (array(m.voxels() if "manifest" not in m.attrs else storage.to_voxels(m.chunks(0)).select("c", "z", "y", "x", "v"), whole.shape) == whole).all()
    assert [c["label"] for c in m.attrs["channels"]] == ["red", "far red"]
    t = {r["tile_id"]: (r["y_um"], r["x_um"], r["y_orig_um"], r["x_orig_um"]) for r in m.tiles().collect()}
    assert t == {0: (0, 0, 0, 0), 1: (4, 0, 3, 0), 2: (0, 4, 0, 3), 3: (4, 4, 3, 3)}
    (tmp_path / "meta" / "a_Tile3_Ch640_Sh0.ome.zarr_meta.txt").unlink()
    with pytest.raises(ValueError):
        api.prepare_folder(spark, str(tmp_path / "meta"), str(tmp_path / "st"), str(tmp_path / "m2"))
