"""Registered queries over the derived views, each beside the SQL that gives the same rows."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom import derive
from voxloom.derive import DUCK, NC, NX, NY, NZ
from voxloom.functions import text as tx
from voxloom.functions.numeric import soft_threshold, truncated
from voxloom.operators import blocks, contrast, crop, flatfield, fuse, illumination, layout, metadata, pyramid, slicing, storage, warp

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

PIXEL, SIDE = 2.0, 10
SHAPE = {"z": NZ, "y": NY, "x": NX}
HALVE = {"z": 2, "y": 2, "x": 2}


def query(sql: str | None = None, views: bool = True) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = f"{DUCK}{', ' + sql.lstrip()[5:] if sql.lstrip().startswith('WITH ') else sql}" if views else sql
        return f

    return add


def tile_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where tiles lie in the derived image, in pixels: a 5 by 5 grid of 10 by 10."""
    t = derive.tiles(spark, sf_dir)
    return t.select("tile_id", *[e for a in "yx" for e in ((F.col(f"{a}_um") / PIXEL).cast("int").alias(f"{a}0"), ((F.col(f"{a}_um") + F.col(f"len_{a}_um")) / PIXEL).cast("int").alias(f"{a}1"))])


def tile_voxels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return slicing.tile_views(derive.voxels(spark, sf_dir), tile_boxes(spark, sf_dir), (SIDE, SIDE))


TILE_VOXELS = """WITH tile_voxels AS (SELECT CAST(5 * (x // 10) + y // 10 AS INT) AS tile_id, c, z, CAST(y % 10 AS INT) AS y, CAST(x % 10 AS INT) AS x, v FROM voxels)"""


# --- the images themselves


@query("SELECT * FROM voxels")
def voxels_dense(spark, d):
    return derive.voxels(spark, d)


@query("SELECT * FROM voxels_sparse")
def voxels_sparse(spark, d):
    return derive.voxels_sparse(spark, d)


@query("SELECT * FROM tiles")
def tiles_layout(spark, d):
    return derive.tiles(spark, d)


@query(TILE_VOXELS + " SELECT * FROM tile_voxels")
def tile_extraction(spark, d):
    return tile_voxels(spark, d)


# --- slicing and layout


@query("SELECT * FROM voxels WHERE c = 1 AND z >= 2 AND z < 5 AND y >= 7 AND y < 31 AND x >= 11 AND x < 44")
def box_slice(spark, d):
    return slicing.box_slice(derive.voxels(spark, d), {"c": (1, 2), "z": (2, 5), "y": (7, 31), "x": (11, 44)})


@query("SELECT * FROM voxels WHERE z % 2 = 0 AND y % 2 = 0 AND x % 2 = 0")
def stride_sample(spark, d):
    return slicing.stride_sample(derive.voxels(spark, d), HALVE)


@query("SELECT c, count(*) AS n, sum(v)::BIGINT AS s FROM voxels WHERE v > 0 GROUP BY c")
def foreground(spark, d):
    return derive.voxels(spark, d).where("v > 0").groupBy("c").agg(F.count("*").alias("n"), F.sum("v").alias("s"))


@query("""SELECT tile_id, CAST(round_even(z_um / 1.0, 0) AS INT) AS z0, CAST(round_even((z_um + len_z_um) / 1.0, 0) AS INT) AS z1,
CAST(round_even(y_um / 1.5, 0) AS INT) AS y0, CAST(round_even((y_um + len_y_um) / 1.5, 0) AS INT) AS y1,
CAST(round_even(x_um / 1.5, 0) AS INT) AS x0, CAST(round_even((x_um + len_x_um) / 1.5, 0) AS INT) AS x1 FROM tiles""")
def roi_to_pixels(spark, d):
    return slicing.roi_to_pixels(derive.tiles(spark, d), {"z": 1.0, "y": 1.5, "x": 1.5})


@query("SELECT c, y, x, max(v) AS v FROM voxels GROUP BY c, y, x")
def zmax_projection(spark, d):
    return slicing.zmax_projection(derive.voxels(spark, d))


@query("SELECT (SELECT sum(n)::BIGINT FROM (SELECT y_pos, min(y_n_pixels) AS n FROM acq_positions GROUP BY 1)) AS ny, (SELECT sum(n)::BIGINT FROM (SELECT x_pos, min(x_n_pixels) AS n FROM acq_positions GROUP BY 1)) AS nx")
def mosaic_extent(spark, d):
    return layout.mosaic_extent(derive.acq_positions(spark, d))


@query("""WITH m AS (SELECT *, coalesce(CAST(y_pos <> lag(y_pos) OVER (ORDER BY tile_id) AS INT), 0) * y_n_pixels AS my, coalesce(CAST(x_pos <> lag(x_pos) OVER (ORDER BY tile_id) AS INT), 0) * x_n_pixels AS mx FROM acq_positions)
SELECT tile_id, CAST(sum(my) OVER (ORDER BY tile_id) % 50 AS INT) AS y_px, CAST(sum(mx) OVER (ORDER BY tile_id) % 50 AS INT) AS x_px,
abs(y_pos - first(y_pos) OVER (ORDER BY tile_id)) AS y_orig, abs(x_pos - first(x_pos) OVER (ORDER BY tile_id)) AS x_orig FROM m""")
def layout_cursor(spark, d):
    return layout.layout_cursor(derive.acq_positions(spark, d))


@query("SELECT tile_id, y_um, x_um FROM tiles WHERE y_um IN (0, (SELECT max(y_um) FROM tiles)) AND x_um IN (0, (SELECT max(x_um) FROM tiles))")
def corner_tiles(spark, d):
    return layout.corner_tiles(derive.tiles(spark, d))


@query("SELECT c, z, y, x, v FROM voxels")
def proxy_mosaic(spark, d):
    return layout.proxy_mosaic(tile_voxels(spark, d), 5, SIDE, SIDE)


# --- pyramids and contrast


def level_sql(source: str, shape: dict[str, int]) -> str:
    w = " * ".join(f"(1 + CAST({a} = {n - 1} AS INT) * {-n % 2})" for a, n in shape.items())
    return f"SELECT c, CAST(z // 2 AS INT) AS z, CAST(y // 2 AS INT) AS y, CAST(x // 2 AS INT) AS x, CAST(floor(sum(v * {w})::DOUBLE / sum({w})) AS INT) AS v FROM {source} GROUP BY 1, 2, 3, 4"


L1 = level_sql("voxels", SHAPE)
L1_SHAPE = pyramid.next_shape(SHAPE, HALVE)
L2 = level_sql("level1", L1_SHAPE)


@query(L1)
def pyramid_l1(spark, d):
    return pyramid.coarsened(derive.voxels(spark, d), SHAPE, HALVE)


@query(f"WITH level1 AS ({L1}) {L2}")
def pyramid_l2(spark, d):
    return pyramid.pyramid(derive.voxels(spark, d), SHAPE, [HALVE, HALVE])[2][0]


#: An image with as many planes as suppliers, and as many rows and columns as orders.
PLAN = """WITH RECURSIVE p AS (SELECT 0 AS level, 1.0e0 AS scale_z, 4.0e0 AS scale_yx, (SELECT count(*) FROM supplier) AS nz, (SELECT count(*) FROM orders) AS nyx UNION ALL
SELECT level + 1, CASE WHEN scale_z < scale_yx THEN scale_z * 2 ELSE scale_z END, scale_yx * 2, CASE WHEN scale_z < scale_yx THEN (nz + 1) // 2 ELSE nz END, (nyx + 1) // 2 FROM p WHERE level < 4)"""


@query(PLAN + """ SELECT level, scale_z, scale_yx AS scale_y, scale_yx AS scale_x, CASE WHEN level < 4 AND scale_z < scale_yx THEN 2 ELSE 1 END AS factor_z, CASE WHEN level < 4 THEN 2 ELSE 1 END AS factor_yx, CAST(nz AS INT) AS nz, CAST(nyx AS INT) AS ny, CAST(nyx AS INT) AS nx FROM p""", views=False)
def pyramid_plan(spark, d):
    side = derive.table(spark, d, "orders").count()
    return pyramid.pyramid_plan(spark, {"z": derive.table(spark, d, "supplier").count(), "y": side, "x": side}, {"z": 1.0, "y": 4.0, "x": 4.0}, 5)


@query(PLAN + """, l AS (SELECT level, scale_z, scale_yx AS scale_y FROM p)
SELECT level, CAST(coalesce(floor(lead(scale_z) OVER (ORDER BY level) / scale_z), 1) AS INT) AS factor_z, CAST(coalesce(floor(lead(scale_y) OVER (ORDER BY level) / scale_y), 1) AS INT) AS factor_yx FROM l""", views=False)
def pyramid_structure(spark, d):
    return pyramid.structure(pyramid_plan(spark, d).select("level", "scale_z", "scale_y"))


def contrast_sql(extra: str) -> str:
    return f"""WITH level1 AS ({L1}), s AS (SELECT * FROM level1 WHERE z % 2 = 0 AND y % 2 = 0 AND x % 2 = 0), q AS (SELECT c, quantile_cont(v, 0.001) AS lo, quantile_cont(v, 0.999) AS hi FROM s {extra} GROUP BY c)
SELECT c, CAST(coalesce(floor(lo), 0) AS INT) AS start, CAST(coalesce(floor(hi), 65535) AS INT) AS "end" FROM (SELECT DISTINCT c FROM level1) LEFT JOIN q USING (c)"""


@query(contrast_sql(""))
def contrast_plain(spark, d):
    return contrast.contrast(pyramid_l1(spark, d))


@query(contrast_sql("JOIN (SELECT c, median(v) AS m FROM s GROUP BY c) USING (c) WHERE v > m"))
def contrast_segmented(spark, d):
    return contrast.contrast(pyramid_l1(spark, d), segment=True)


@query("WITH w AS (SELECT c, CAST(least(65535, 10 * floor(quantile_cont(v, 0.999))) AS INT) AS \"max\" FROM voxels WHERE z % 2 = 0 AND y % 2 = 0 AND x % 2 = 0 GROUP BY c) SELECT c, 0 AS \"min\", \"max\" FROM w")
def display_window(spark, d):
    return contrast.window_of(contrast.contrast(derive.voxels(spark, d))).select("c", "min", "max")


#: Labels of all channels, one after the other along z.
LABELS = f"labels_ AS (SELECT z + {NZ} * c AS z, y, x, CAST(v % 7 AS INT) AS v FROM voxels)"


def labels_(spark: SparkSession, d: str) -> DataFrame:
    return derive.voxels(spark, d).select((F.col("z") + NZ * F.col("c")).alias("z"), "y", "x", (F.col("v") % 7).cast("int").alias("v"))


@query(f"WITH {LABELS} SELECT CAST(z AS INT) AS z, CAST(y // 2 AS INT) AS y, CAST(x // 2 AS INT) AS x, max(v) AS v FROM labels_ GROUP BY 1, 2, 3")
def label_downscale_max(spark, d):
    return pyramid.label_downscale(labels_(spark, d), {"y": 2, "x": 2})


@query(f"WITH {LABELS} SELECT CAST(z AS INT) AS z, CAST(y * 2 + a AS INT) AS y, CAST(x * 2 + b AS INT) AS x, v FROM labels_, range(2) r(a), range(2) q(b)")
def label_upscale(spark, d):
    return pyramid.label_upscale(labels_(spark, d), {"y": 2, "x": 2}, {"z": NC * NZ, "y": 2 * NY, "x": 2 * NX})


# --- illumination

PAIRS = """pairs AS (SELECT i, j, oy, ox, sy1, sx1, sy2, sx2 FROM (SELECT a.tile_id AS i, b.tile_id AS j, CAST((a.y_orig_um - b.y_orig_um) / 2 + 10 AS INT) AS oy, CAST((a.x_orig_um - b.x_orig_um) / 2 + 10 AS INT) AS ox,
CAST(a.y_orig_um / 2 AS INT) AS sy1, CAST(a.x_orig_um / 2 AS INT) AS sx1, CAST(b.y_orig_um / 2 AS INT) AS sy2, CAST(b.x_orig_um / 2 AS INT) AS sx2
FROM tiles a JOIN tiles b ON a.tile_id < b.tile_id) WHERE oy > 0 AND ox > 0 AND oy <= 10 AND ox <= 10)"""
STATS = TILE_VOXELS + f""", {PAIRS}, ov AS (SELECT t.c, p.i, p.j, k.side, t.v FROM pairs p, (VALUES (1), (2)) k(side), tile_voxels t
WHERE t.v > 0 AND t.tile_id = CASE k.side WHEN 1 THEN p.i ELSE p.j END
AND t.y + CASE k.side WHEN 1 THEN sy1 ELSE sy2 END >= greatest(sy1, sy2) AND t.y + CASE k.side WHEN 1 THEN sy1 ELSE sy2 END < least(sy1, sy2) + 10
AND t.x + CASE k.side WHEN 1 THEN sx1 ELSE sx2 END >= greatest(sx1, sx2) AND t.x + CASE k.side WHEN 1 THEN sx1 ELSE sx2 END < least(sx1, sx2) + 10),
stats AS (SELECT e.c, p.i, p.j, p.oy * p.ox AS area, CAST(coalesce(sum(v) FILTER (side = 1), 0) AS BIGINT) AS s1, count(v) FILTER (side = 1) AS n1, CAST(coalesce(sum(v) FILTER (side = 2), 0) AS BIGINT) AS s2, count(v) FILTER (side = 2) AS n2
FROM pairs p CROSS JOIN (SELECT DISTINCT c FROM voxels) e LEFT JOIN ov ON ov.c = e.c AND ov.i = p.i AND ov.j = p.j GROUP BY e.c, p.i, p.j, p.oy, p.ox)"""
EDGES = STATS + ", edges AS (SELECT c, i, j, CASE WHEN least(n1, n2) < area * 7 * 0.1 OR s1 = 0 THEN 1.0 ELSE (s2::DOUBLE / greatest(n2, 1)) / (s1::DOUBLE / greatest(n1, 1)) END AS gain FROM stats)"


@query(f"WITH {PAIRS} SELECT i, j, oy, ox FROM pairs")
def overlap_pairs(spark, d):
    return layout.overlap_pairs(derive.tiles(spark, d), PIXEL)


@query(f"WITH {PAIRS} SELECT i, j FROM pairs WHERE (sy1 <> sy2) <> (sx1 <> sx2)")
def pair_prune_axis_aligned(spark, d):
    t = derive.tiles(spark, d)
    return layout.axis_aligned(layout.overlap_pairs(t, PIXEL), t)


@query(f"WITH {PAIRS} SELECT i, j FROM pairs WHERE (sy1 // 8 + sx1 // 8 + sy2 // 8 + sx2 // 8) % 2 = 1")
def pair_prune_alternating(spark, d):
    t = derive.tiles(spark, d)
    return layout.without_every_other(layout.overlap_pairs(t, PIXEL), t, PIXEL)


@query(STATS + " SELECT c, i, j, s1, n1, s2, n2 FROM stats")
def overlap_stats(spark, d):
    return illumination.overlap_stats(tile_voxels(spark, d), derive.tiles(spark, d), PIXEL, NC).drop("area")


@query(EDGES + " SELECT c, i, j, round(gain, 6) AS gain FROM edges")
def gain_edges(spark, d):
    e = illumination.gain_edges(illumination.overlap_stats(tile_voxels(spark, d), derive.tiles(spark, d), PIXEL, NC), NZ)
    return e.withColumn("gain", F.round("gain", 6))


@query()
def gain_solve(spark, d):
    e = illumination.gain_edges(illumination.overlap_stats(tile_voxels(spark, d), derive.tiles(spark, d), PIXEL, NC), NZ)
    return illumination.gains(e, derive.tiles(spark, d))


RAW = "raw_ AS (SELECT c, z, median(m) + 1 AS raw FROM (SELECT c, z, x, median(v) AS m FROM voxels GROUP BY 1, 2, 3) GROUP BY 1, 2)"
_WSUM = sum(math.exp(-0.5 * (k / 15) ** 2) for k in range(-60, 61))
SMOOTH = RAW + f", prof AS (SELECT a.c, a.z, sum(exp(-0.5 * (k / 15.0) ** 2) / {_WSUM!r} * b.raw) / any_value(a.raw) AS profile FROM raw_ a, range(-60, 61) t(k), raw_ b WHERE b.c = a.c AND b.z = greatest(0, least({NZ - 1}, a.z + k)) GROUP BY a.c, a.z)"


@query(f"WITH {RAW} SELECT c, z, raw FROM raw_")
def z_profile_raw(spark, d):
    return illumination.z_profile(derive.voxels(spark, d))


@query(f"WITH {SMOOTH} SELECT c, z, round(profile, 6) AS profile FROM prof")
def z_profile_smooth(spark, d):
    return illumination.smoothed_profile(illumination.z_profile(derive.voxels(spark, d))).withColumn("profile", F.round("profile", 6))


@query(TILE_VOXELS + f", {SMOOTH}, g AS (SELECT c, tile_id, 1.0 / (1 + (c + tile_id) % 4) AS gain FROM (SELECT DISTINCT c, tile_id FROM tile_voxels)) SELECT t.tile_id, t.c, t.z, t.y, t.x, CAST(floor(least(65535, greatest(0, t.v * gain * round(profile, 6)))) AS INT) AS v FROM tile_voxels t JOIN g USING (c, tile_id) JOIN prof USING (c, z)")
def illum_apply(spark, d):
    t = tile_voxels(spark, d)
    gain = t.select("c", "tile_id").distinct().withColumn("gain", F.lit(1.0) / (1 + (F.col("c") + F.col("tile_id")) % 4))
    return illumination.apply_illumination(t, gain, z_profile_smooth(spark, d))


# --- flatfield

MEDIAN = TILE_VOXELS + ", med AS (SELECT c, y, x, median(v) AS m FROM tile_voxels GROUP BY 1, 2, 3)"
FLAT = MEDIAN + ", flat AS (SELECT c, y, x, (m + 1) / avg(m + 1) OVER (PARTITION BY c) AS flat FROM med)"
BASE = FLAT + ", base AS (SELECT c, round_even(quantile_cont(v / (round(flat, 6) + 1e-6), 0.01), 0) AS baseline FROM tile_voxels JOIN flat USING (c, y, x) WHERE y % 4 = 0 AND x % 4 = 0 GROUP BY c)"
_G1 = illumination.gaussian(1.0, 4)


def gauss_sql(source: str, axis: str, other: str, size: int) -> str:
    w = f"[{', '.join(map(repr, _G1))}]"
    at = f"CASE WHEN a.{axis} + k - 4 < 0 THEN -1 - (a.{axis} + k - 4) WHEN a.{axis} + k - 4 >= {size} THEN {2 * size - 1} - (a.{axis} + k - 4) ELSE a.{axis} + k - 4 END"
    return f"SELECT a.c, a.y, a.x, sum({w}[k + 1] * b.m) AS m FROM {source} a, range(9) t(k), {source} b WHERE b.c = a.c AND b.{other} = a.{other} AND b.{axis} = {at} GROUP BY 1, 2, 3"


def profile(spark: SparkSession, d: str) -> DataFrame:
    m = flatfield.median_profile(tile_voxels(spark, d)).withColumn("m", F.col("m") + 1)
    return flatfield.normalised(m).withColumn("flat", F.round("flat", 6))


@query("""WITH p AS (SELECT t.tile_id, CAST(z AS INT) AS z, (t.tile_id * 7919 + z * 104729 + 1) * 2654435761 % 2147483647 AS h FROM tiles t, range(7) r(z)), k AS (SELECT *, row_number() OVER (PARTITION BY tile_id ORDER BY h, z) AS k FROM p)
SELECT tile_id, z FROM k WHERE k <= 3 ORDER BY k, tile_id LIMIT 60""")
def fov_sample_hash(spark, d):
    planes = derive.tiles(spark, d).select("tile_id", F.explode(F.sequence(F.lit(0), F.lit(NZ - 1))).alias("z"))
    return flatfield.sampled_planes(planes, 60)


@query("SELECT tile_id, CAST(z AS INT) AS z FROM tiles, range(7) r(z) WHERE z < 2 OR z >= 6")
def fov_sample_ends(spark, d):
    planes = derive.tiles(spark, d).select("tile_id", F.explode(F.sequence(F.lit(0), F.lit(NZ - 1))).alias("z"))
    return flatfield.bottom_top_planes(planes, NZ, 2, 1)


@query(MEDIAN + " SELECT c, y, x, m FROM med")
def flat_median(spark, d):
    return flatfield.median_profile(tile_voxels(spark, d))


@query(MEDIAN + f", gy AS ({gauss_sql('med', 'y', 'x', SIDE)}), gx AS ({gauss_sql('gy', 'x', 'y', SIDE)}) SELECT c, y, x, round(m, 4) AS m FROM gx")
def flat_gauss(spark, d):
    return flatfield.smoothed_2d(flat_median(spark, d), "m", SIDE, SIDE).withColumn("m", F.round("m", 4))


@query(FLAT + " SELECT c, y, x, round(flat, 6) AS flat FROM flat")
def flat_normalised(spark, d):
    return profile(spark, d)


@query(BASE + " SELECT c, baseline FROM base")
def baseline_pct(spark, d):
    return flatfield.baseline(tile_voxels(spark, d), profile(spark, d))


@query(BASE + " SELECT tile_id, c, z, y, x, CAST(floor(least(65535, greatest(0, CASE WHEN v / (round(flat, 6) + 1e-6) > 100 THEN v / (round(flat, 6) + 1e-6) - 100 ELSE 0 END))) AS INT) AS v FROM tile_voxels JOIN flat USING (c, y, x)")
def flatfield_apply(spark, d):
    base = spark.createDataFrame([(c, 100.0) for c in range(3)], "c int, baseline double")
    return flatfield.apply_flatfield(tile_voxels(spark, d), profile(spark, d), base)


@query("""WITH h AS (SELECT v, count(*) AS n FROM image2d GROUP BY v), w AS (SELECT v, sum(n) OVER (ORDER BY v) AS n0, sum(n * v) OVER (ORDER BY v) AS s0, sum(n) OVER () AS n, sum(n * v) OVER () AS s FROM h),
b AS (SELECT v, round(n0::DOUBLE * (n - n0) * (s0::DOUBLE / n0 - (s - s0)::DOUBLE / (n - n0)) * (s0::DOUBLE / n0 - (s - s0)::DOUBLE / (n - n0)), 2) AS b FROM w WHERE n0 < n) SELECT v AS threshold FROM b ORDER BY b DESC, v LIMIT 1""")
def otsu_threshold(spark, d):
    return flatfield.otsu_threshold(derive.image2d(spark, d))


@query()
def basic_fit(spark, d):
    import numpy as np
    import pandas as pd

    from voxloom.kernels.basic import fit_basic

    def one(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values(["tile_id", "z", "y", "x"])
        flat, dark, _ = fit_basic(g["v"].to_numpy(float).reshape(-1, SIDE, SIDE))
        y, x = np.indices(flat.shape)
        return pd.DataFrame({"c": int(g["c"].iloc[0]), "y": y.ravel().astype("int32"), "x": x.ravel().astype("int32"), "flat": flat.ravel(), "dark": dark.ravel()})

    t = tile_voxels(spark, d)
    planes = flatfield.sampled_planes(t.select("tile_id", "z").distinct(), 200)  # bounds the group that is fitted in one task
    return t.join(F.broadcast(planes), ["tile_id", "z"]).groupBy("c").applyInPandas(one, "c int, y int, x int, flat double, dark double")


# --- metadata

#: A block of lines for every supplier, a file for every nation of suppliers; expressions that both engines read.
BLOCK = [
    "'[Metadata for file] /data/' || s_name || '.tiff'", "'[Laser] ' || CASE s_suppkey % 2 WHEN 0 THEN '640' ELSE '561' END || ' nm'", "'[Intensity (%)] ' || (5 + s_suppkey % 90)", "'[Zoom] 20x_' || s_suppkey",
    "'[Pixelsize in um] 1.5'", "'[Filter] ' || CASE s_suppkey % 2 WHEN 0 THEN '647LP' ELSE '562LP' END || ' wide'", "'[Shutter] ' || CASE s_suppkey % 3 WHEN 0 THEN 'Left' ELSE 'Right' END", "'[x_pos] ' || (4 + s_suppkey)", "'[y_pos] 3'",
    "'[f_start] 1'", "'[z_stepsize] 2'", "'[z_planes] ' || (12 + s_suppkey % 5)", "'[x_pixels] 4'", "'[y_pixels] 3'", "''",
]
META = " UNION ALL ".join(f"SELECT 'n' || s_nationkey || '_meta.txt' AS path, CAST({len(BLOCK)} * s_suppkey + {k} AS INT) AS line_no, {x} AS line FROM supplier" for k, x in enumerate(BLOCK))
META_SQL = f"meta AS ({META})"


def meta_lines(spark: SparkSession, d: str) -> DataFrame:
    return spark.sql(META.replace("FROM supplier", "FROM {t}"), t=derive.table(spark, d, "supplier"))


@query(f"""WITH {META_SQL}, k AS (SELECT path, line_no, replace(replace(replace(replace(lower(trim(line)), '[', ''), ']', ''), ' (%)', ''), ' in um', '') AS l FROM meta WHERE line <> ''),
s AS (SELECT path, line_no, replace(split_part(l, ' ', 1), ':', '') AS key, CASE WHEN l LIKE 'filter %' THEN substr(l, 8) ELSE split_part(l, ' ', 2) END AS value FROM k),
b AS (SELECT *, sum(CAST(key = 'metadata' AS INT)) OVER (PARTITION BY path ORDER BY line_no) - 1 AS block FROM s),
t AS (SELECT path, block, max(value) FILTER (key = 'laser') AS channel, max(value) FILTER (key = 'intensity')::DOUBLE AS intensity, split_part(max(value) FILTER (key = 'zoom'), '_', 1) AS zoom, max(value) FILTER (key = 'filter') AS filter, max(value) FILTER (key = 'shutter') AS shutter,
max(value) FILTER (key = 'pixelsize')::DOUBLE AS x_scale, max(value) FILTER (key = 'z_stepsize')::DOUBLE AS z_scale, max(value) FILTER (key = 'x_pos')::DOUBLE AS x_pos, max(value) FILTER (key = 'y_pos')::DOUBLE AS y_pos,
max(value) FILTER (key = 'x_pixels')::INT AS x_n_pixels, max(value) FILTER (key = 'y_pixels')::INT AS y_n_pixels, max(value) FILTER (key = 'z_planes')::INT AS z_n_pixels FROM b GROUP BY 1, 2)
SELECT CAST(row_number() OVER (ORDER BY path, block) - 1 AS INT) AS row, channel, CASE WHEN first(intensity) OVER (ORDER BY path, block) > 1 THEN intensity / 100 ELSE intensity END AS intensity, zoom, filter, shutter, x_scale, x_scale AS y_scale, z_scale, x_pos, y_pos, z_n_pixels, y_n_pixels AS x_n_pixels, x_n_pixels AS y_n_pixels FROM t""", views=False)
def meta_parse(spark, d):
    return metadata.checked_pixels(metadata.require(metadata.acquisition_table(meta_lines(spark, d)))).withColumn("row", F.col("row").cast("int"))


SETTINGS = [("640", "far red", "640", "FF0000"), ("561", "red", "561", "00FF00"), ("488", "green", "488", "0000FF")]


@query("""WITH s(wavelength, label, color) AS (VALUES ('640', 'far red', 'FF0000'), ('561', 'red', '00FF00'), ('488', 'green', '0000FF')), t AS (SELECT tile_id, ['640', '561', '488'][tile_id % 3 + 1] AS channel FROM tiles)
SELECT tile_id, channel, label, color FROM t JOIN s ON channel = wavelength""")
def channel_join(spark, d):
    t = derive.tiles(spark, d).select("tile_id", F.element_at(F.array(*map(F.lit, ("640", "561", "488"))), (F.col("tile_id") % 3 + 1).cast("int")).alias("channel"))
    s = spark.createDataFrame([(a, b, e) for a, b, _, e in SETTINGS], "wavelength string, label string, color string")
    return metadata.with_channel_settings(t, s)


@query("""WITH t AS (SELECT tile_id, tile_id % 3 AS k FROM tiles), c AS (SELECT k, ['640', '561', '488'][k + 1] AS wavelength, ['far red', 'red', 'green'][k + 1] AS label, min(tile_id) AS r FROM t GROUP BY k)
SELECT CAST(row_number() OVER (ORDER BY r) - 1 AS INT) AS index, label, wavelength AS wavelength_id, CAST(least(65535, 10 * (100 + 3000 * (row_number() OVER (ORDER BY r) - 1))) AS INT) AS "max" FROM c""")
def omero_meta(spark, d):
    t = channel_join(spark, d).select(F.lit("a").alias("image"), F.col("tile_id").alias("row"), "channel", "label", "color")
    limits = spark.createDataFrame([(k, 0, 100 + 3000 * k) for k in range(3)], "index int, start int, end int")
    c = metadata.display_channels(t, limits).select(F.explode("channels").alias("c"))
    return c.select(F.col("c.index").cast("int").alias("index"), "c.label", "c.wavelength_id", F.col("c.window.max").alias("max"))


#: Suppliers as acquisitions, an image for every nation.
SHOWN = """WITH s AS (SELECT 'n' || s_nationkey AS image, s_suppkey AS row, s_suppkey % 3 AS k FROM supplier),
ch AS (SELECT image, ['640', '561', '488'][k + 1] AS wavelength_id, ['far red', 'red', 'green'][k + 1] AS label, CAST(row_number() OVER (PARTITION BY image ORDER BY min(row)) - 1 AS INT) AS index FROM s GROUP BY image, k)"""


def shown(spark: SparkSession, d: str) -> DataFrame:
    """(image, channels) of every nation's suppliers."""
    s = derive.table(spark, d, "supplier").selectExpr("'n' || s_nationkey AS image", "s_suppkey AS row", "element_at(array('640', '561', '488'), CAST(s_suppkey % 3 + 1 AS INT)) AS channel")
    return metadata.display_channels(metadata.with_channel_settings(s, spark.createDataFrame([(a, b, e) for a, b, _, e in SETTINGS], "wavelength string, label string, color string")))


@query(SHOWN + " SELECT image, index AS position, label, index FROM ch", views=False)
def channel_jobs(spark, d):
    return metadata.jobs_by_channel(shown(spark, d)).withColumn("index", F.col("index").cast("int"))


@query(SHOWN + " SELECT 'label' AS by, image, index, label FROM ch WHERE label LIKE '%red%' UNION ALL SELECT 'wavelength', image, index, label FROM ch WHERE wavelength_id = '488'", views=False)
def channel_lookup(spark, d):
    c = shown(spark, d).select("image", F.inline("channels")).select("image", F.col("index").cast("int").alias("index"), "label", "wavelength_id")
    found = {"label": metadata.channel_index(c, label="RED"), "wavelength": metadata.channel_index(c, wavelength="488")}
    one, two = (t.select(F.lit(k).alias("by"), "image", "index", "label") for k, t in found.items())
    return one.union(two)


@query(SHOWN + """ SELECT image, index, label, CASE index WHEN 1 THEN 7 ELSE 0 END AS start, CASE index WHEN 1 THEN 900 ELSE 65535 END AS "end", CASE index WHEN 1 THEN 9000 ELSE 65535 END AS "max" FROM ch""", views=False)
def window_update(spark, d):
    c = metadata.updated_windows(shown(spark, d), {1: (7, 900)}).select("image", F.inline("channels"))
    return c.select("image", F.col("index").cast("int").alias("index"), "label", "window.start", "window.end", "window.max")


@query(SHOWN + " SELECT DISTINCT image, 2 AS tasks, '2' AS planes, '0.2' AS version FROM ch", views=False)
def provenance(spark, d):
    m = metadata.with_provenance(metadata.with_provenance(shown(spark, d), "crop", {"planes": "1"}, "0.1"), "fuse", {}, "0.2")
    m = metadata.with_provenance(m, "crop", {"planes": "2"}, "0.1")  # a task that ran again tells of its last run
    return m.select("image", F.size("tasks").alias("tasks"), F.col("tasks")["crop"]["parameters"]["planes"].alias("planes"), F.col("tasks")["fuse"]["version"].alias("version"))


@query("""SELECT tile_id, CAST(regexp_extract(p, 'Tile([0-9]+)_', 1) AS INT) AS tile, CAST(regexp_extract(p, '_Ch([0-9]+)_', 1) AS INT) AS ch, CAST(coalesce(nullif(regexp_extract(p, '_sh([0-9])', 1), ''), '0') AS INT) AS view
FROM (SELECT tile_id, 'x/Tile' || tile_id || '_Ch' || (tile_id % 3 * 100 + 388) || CASE WHEN tile_id % 2 = 0 THEN '_sh1' ELSE '_' END || '_meta.txt' AS p FROM tiles)""")
def tile_store_regex(spark, d):
    p = F.concat(F.lit("x/Tile"), "tile_id", F.lit("_Ch"), F.col("tile_id") % 3 * 100 + 388, F.when(F.col("tile_id") % 2 == 0, "_sh1").otherwise("_"), F.lit("_meta.txt"))
    t = derive.tiles(spark, d).select("tile_id", p.alias("p"))
    return t.select("tile_id", tx.tile_of(F.col("p")).alias("tile"), tx.channel_of(F.col("p")).alias("ch"), tx.view_of(F.col("p")).alias("view"))


@query("""WITH t AS (SELECT CAST(tile_id AS INT) AS row, ['640', '561', '488'][tile_id % 3 + 1] AS channel FROM tiles)
SELECT row, channel, (channel = '640' AND k IN (0, 2)) OR (channel = '488' AND k = 1) AS ignore FROM (SELECT *, row_number() OVER (PARTITION BY channel ORDER BY row) - 1 AS k FROM t)""")
def exclusion_flags(spark, d):
    t = channel_join(spark, d).select(F.col("tile_id").alias("row"), "channel")
    return metadata.flagged(t, {"640": [0, 2], "488": [1]})


@query("SELECT CAST(row_number() OVER (ORDER BY s, i) - 1 AS INT) AS index, label, w AS wavelength_id FROM (SELECT label, min(s) AS s, arg_min(i, s * 1000000000000 + i) AS i, arg_min(w, s * 1000000000000 + i) AS w FROM (SELECT p_size % 5 AS s, p_partkey AS i, p_name || ' ' || p_type AS label, p_brand AS w FROM part) GROUP BY label)", views=False)
def channel_merge(spark, d):
    """Parts as channels of five sources, a label for every name and type."""
    m = metadata.merged_channels(derive.table(spark, d, "part").selectExpr("p_size % 5 AS source", "p_partkey AS index", "p_name || ' ' || p_type AS label", "p_brand AS wavelength_id"))
    return m.withColumn("index", F.col("index").cast("int"))


@query("SELECT v.view, k.channel FROM (SELECT DISTINCT l_orderkey AS view FROM lineitem) v CROSS JOIN (SELECT DISTINCT l_returnflag AS channel FROM lineitem) k WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = v.view AND l.l_returnflag = k.channel)", views=False)
def channel_alignment(spark, d):
    """Orders as views, their lines' flags as channels."""
    return fuse.channels_alike(derive.table(spark, d, "lineitem").selectExpr("l_orderkey AS view", "l_returnflag AS channel"))


@query("""SELECT event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k, count(*) AS n FROM events GROUP BY 1, 2""", views=False)
def json_attributes(spark, d):
    e = derive.table(spark, d, "events").select("event_type", F.from_json("props", "k bigint").alias("p"))
    return e.groupBy("event_type", F.col("p.k").alias("k")).agg(F.count("*").alias("n"))


# --- crops

CROP = {"y": (25.0, 77.0), "x": (30.0, 95.0)}


@query("""WITH b AS (SELECT tile_id, 3 * tile_id AS y0, 3 * tile_id + 40 + tile_id AS y1, tile_id AS x0, tile_id + 24 AS x1 FROM tiles)
SELECT tile_id, CAST(y0 + ((y1 - y0) % 8) // 2 AS INT) AS y0, CAST(y1 - ((y1 - y0) % 8 - ((y1 - y0) % 8) // 2) AS INT) AS y1, CAST(x0 + ((x1 - x0) % 8) // 2 AS INT) AS x0, CAST(x1 - ((x1 - x0) % 8 - ((x1 - x0) % 8) // 2) AS INT) AS x1 FROM b""")
def crop_bounds(spark, d):
    b = derive.tiles(spark, d).select("tile_id", F.expr("3 * tile_id AS y0"), F.expr("3 * tile_id + 40 + tile_id AS y1"), F.expr("tile_id AS x0"), F.expr("tile_id + 24 AS x1"))
    return crop.whole_blocks(b)


@query("""WITH t AS (SELECT tile_id, greatest(y_um, 25) AS ny, greatest(x_um, 30) AS nx, y_um, x_um, y_orig_um, x_orig_um FROM tiles WHERE y_um + 20 > 25 AND y_um < 77 AND x_um + 20 > 30 AND x_um < 95),
sy AS (SELECT ny, coalesce(lead(ny) OVER (ORDER BY ny), 77) AS ey FROM (SELECT DISTINCT ny FROM t)), sx AS (SELECT nx, coalesce(lead(nx) OVER (ORDER BY nx), 95) AS ex FROM (SELECT DISTINCT nx FROM t))
SELECT tile_id, ny - 25 AS y_um, ey - ny AS len_y_um, y_orig_um + ny - y_um - 25 AS y_orig_um, nx - 30 AS x_um, ex - nx AS len_x_um, x_orig_um + nx - x_um - 30 AS x_orig_um FROM t JOIN sy USING (ny) JOIN sx USING (nx)""")
def crop_tiles_rebase(spark, d):
    return crop.rebased_tiles(derive.tiles(spark, d), CROP)


@query("""WITH c(roi, ys, ye, xs, xe) AS (VALUES ('a', 77e0, 18e0, 3e0, 50e0), ('b', 1e0, 39e0, 41e0, 99e0)), t AS (SELECT DISTINCT y_um AS t FROM tiles)
SELECT roi, coalesce((SELECT min(t) FROM t WHERE t > least(ys, ye) AND t - least(ys, ye) < 4), least(ys, ye)) AS y_start, coalesce((SELECT max(t + 20) FROM t WHERE t + 20 < greatest(ys, ye) AND greatest(ys, ye) - t - 20 < 4), greatest(ys, ye)) AS y_end,
coalesce((SELECT min(t) FROM t WHERE t > least(xs, xe) AND t - least(xs, xe) < 4), least(xs, xe)) AS x_start, coalesce((SELECT max(t + 20) FROM t WHERE t + 20 < greatest(xs, xe) AND greatest(xs, xe) - t - 20 < 4), greatest(xs, xe)) AS x_end FROM c""")
def crop_snap(spark, d):
    rows = [("a", 0.0, 7.0, 77.0, 18.0, 3.0, 50.0), ("b", 0.0, 7.0, 1.0, 39.0, 41.0, 99.0)]
    c = spark.createDataFrame(rows, "roi string, z_start double, z_end double, y_start double, y_end double, x_start double, x_end double")
    t = derive.tiles(spark, d).withColumn("step_y", F.lit(16.0)).withColumn("step_x", F.lit(16.0))
    return crop.snapped_to_tiles(c, t).drop("z_start", "z_end")


ROIS = "SELECT tile_id % 5 AS z0, tile_id % 5 + 2 AS z1, CAST(y_um / 2 AS INT) + tile_id % 3 AS y0, CAST(y_um / 2 AS INT) + 6 AS y1, CAST(x_um / 2 AS INT) + 1 AS x0, CAST(x_um / 2 AS INT) + 4 + tile_id % 4 AS x1 FROM tiles"


@query(f"WITH rois AS ({ROIS}) SELECT z, y, x, CAST(EXISTS (SELECT 1 FROM rois r WHERE g.z >= z0 AND g.z < z1 AND g.y >= y0 AND g.y < y1 AND g.x >= x0 AND g.x < x1) AS INT) AS v FROM grid g WHERE c = 0")
def roi_mask(spark, d):
    """A region in every tile."""
    rois = spark.sql(ROIS.replace("FROM tiles", "FROM {t}"), t=derive.tiles(spark, d))
    return crop.roi_mask(derive.grid(spark, 1).drop("c"), rois)


# --- registration and fusion


def shifts(spark: SparkSession, d: str) -> DataFrame:
    return derive.tiles(spark, d).select("tile_id", F.lit(0).alias("sz"), (F.col("y_orig_um") / PIXEL).cast("int").alias("sy"), (F.col("x_orig_um") / PIXEL).cast("int").alias("sx"))


MOVED = TILE_VOXELS + ", moved AS (SELECT c, z, CAST(t.y + 8 * (tile_id % 5) AS INT) AS y, CAST(t.x + 8 * (tile_id // 5) AS INT) AS x, t.y AS ty, t.x AS tx, v FROM tile_voxels t)"


@query(MOVED + " SELECT c, z, y, x, CAST(floor(sum(v)::DOUBLE / count(*)) AS INT) AS v FROM moved GROUP BY 1, 2, 3, 4")
def fuse_translation_mean(spark, d):
    return fuse.fused_mean(fuse.placed(tile_voxels(spark, d), shifts(spark, d)))


@query(MOVED + " SELECT c, z, y, x, CAST(floor(sum(v * least(ty + 1, 10 - ty) * least(tx + 1, 10 - tx))::DOUBLE / sum(least(ty + 1, 10 - ty) * least(tx + 1, 10 - tx))) AS INT) AS v FROM moved GROUP BY 1, 2, 3, 4")
def fuse_blended(spark, d):
    return fuse.fused_mean(fuse.placed(tile_voxels(spark, d), shifts(spark, d)), SIDE, SIDE)


@query(MOVED + " SELECT c, z, y, x, max(v) AS v FROM moved GROUP BY 1, 2, 3, 4")
def fuse_max(spark, d):
    return fuse.fused_max(fuse.placed(tile_voxels(spark, d), shifts(spark, d)))


@query()
def phase_corr(spark, d):
    t = slicing.zmax_projection(tile_voxels(spark, d).where("c = 0").withColumn("c", F.col("tile_id"))).withColumnRenamed("c", "tile_id")
    return fuse.pair_shifts(t, overlap_pairs(spark, d), SIDE, SIDE)


# --- structure


@query("SELECT CAST(c AS INT) AS c, z, y, x, v FROM voxels WHERE v <> 0")
def rechunk_roundtrip(spark, d):
    c = storage.to_chunks(derive.voxels_sparse(spark, d), (4, 16, 16), SHAPE)
    return storage.to_voxels(storage.rechunked(c, (2, 32, 8), SHAPE)).select("c", "z", "y", "x", "v")


@query("SELECT c, z // 4 AS cz, y // 16 AS cy, x // 16 AS cx, sum(v)::BIGINT AS s FROM voxels WHERE v <> 0 GROUP BY 1, 2, 3, 4")
def chunk_sums(spark, d):
    v = storage.to_voxels(storage.to_chunks(derive.voxels_sparse(spark, d), (4, 16, 16), SHAPE))
    g = v.groupBy("c", *[F.floor(F.col(a) / s).cast("int").alias(f"c{a}") for a, s in (("z", 4), ("y", 16), ("x", 16))])
    return g.agg(F.sum("v").alias("s"))


@query("SELECT 'image' AS image, 0 AS level, count(*) AS stored, CAST(0 AS BIGINT) AS bad, true AS complete FROM (SELECT DISTINCT c, z // 4, y // 16, x // 16 FROM voxels WHERE v <> 0)")
def level_completeness(spark, d):
    return storage.level_completeness(storage.to_chunks(derive.voxels_sparse(spark, d), (4, 16, 16), SHAPE))


@query(f"WITH level1 AS ({L1}) SELECT 0 AS level, c, z, y, x, v FROM level1 WHERE v <> 0")
def preview_level(spark, d):
    v = derive.voxels_sparse(spark, d)
    both = storage.to_chunks(v, (4, 16, 16), SHAPE).union(storage.to_chunks(pyramid_l1(spark, d), (4, 16, 16), L1_SHAPE, level=1))
    return storage.to_voxels(storage.preview(both)).select("level", "c", "z", "y", "x", "v")


@query("SELECT 2 AS level UNION ALL SELECT 3", views=False)
def levels_to_rebuild(spark, d):
    v = derive.voxels_sparse(spark, d)
    c = storage.to_chunks(v, (4, 16, 16), SHAPE)
    broken = c.withColumn("level", F.lit(2)).withColumn("data", F.expr("substring(data, 1, 10)"))
    have = c.union(c.withColumn("level", F.lit(1))).union(broken)
    return storage.missing_levels(have, spark.range(4).select(F.col("id").cast("int").alias("level")))


@query("SELECT page_id, CAST(trim(name, '/') IN ('es', 'en', 'de/1') OR starts_with(trim(name, '/'), 'es/') OR starts_with(trim(name, '/'), 'en/') OR starts_with(trim(name, '/'), 'de/1/') AS BOOLEAN) AS under FROM (SELECT page_id, regexp_replace(url, '^https?://[^/]*', '') AS name FROM pages)", views=False)
def path_prefixes(spark, d):
    p = derive.table(spark, d, "pages").select("page_id", F.regexp_replace("url", "^https?://[^/]*", "").alias("name"))
    return p.select("page_id", tx.under_any(F.col("name"), ["es", "/en/", "de/1"]).alias("under"))


#: Parts as images whose names end as views' and channels' do.
NAMES = "SELECT p_partkey, replace(p_name, ' ', '_') || CASE p_partkey % 5 WHEN 0 THEN '_sh1' WHEN 1 THEN '_ch2' WHEN 2 THEN '_view_3' WHEN 3 THEN '_a' ELSE '' END AS name FROM part"


@query(f"SELECT p_partkey, name, regexp_replace(regexp_replace(name, '(_?(sh|ch|view)_?)?[0-9]+$', ''), '_[a-zA-Z]$', '') AS common FROM ({NAMES})", views=False)
def common_names(spark, d):
    return spark.sql(NAMES.replace("FROM part", "FROM {t}"), t=derive.table(spark, d, "part")).select("p_partkey", "name", tx.common_name(F.col("name")).alias("common"))


@query("SELECT c, z, y, x, CAST(floor(least(65535, greatest(0, v * 3.7e0 - 1000))) AS INT) AS v FROM voxels")
def clip_cast(spark, d):
    return derive.voxels(spark, d).withColumn("v", truncated(F.col("v") * F.lit(3.7) - 1000))


@query("SELECT c, z, y, x, CAST(sign(v - 3000) * greatest(abs(v - 3000) - 500, 0) AS DOUBLE) AS v FROM voxels")
def shrunk_values(spark, d):
    return derive.voxels(spark, d).withColumn("v", soft_threshold(F.col("v") - 3000, 500.0))


# --- the same operators on chunks: the image is stored sparse, in chunks whose borders are not the tiles'

CHUNK = (4, 16, 16)


def chunked(spark: SparkSession, d: str) -> DataFrame:
    return storage.to_chunks(derive.voxels_sparse(spark, d), CHUNK, SHAPE)


def unchunked(chunks: DataFrame) -> DataFrame:
    return storage.to_voxels(chunks).select("c", "z", "y", "x", "v")


def placed_sql(tiled: str) -> str:
    """Tile voxels of a query back in the image, without zeros."""
    return f"SELECT c, z, CAST(y + 10 * (tile_id % 5) AS INT) AS y, CAST(x + 10 * (tile_id // 5) AS INT) AS x, v FROM ({tiled}) WHERE v <> 0"


def parts_of(name: str, select: str) -> tuple[str, str]:
    """A query's SQL as (its WITH list after the derived views, its last SELECT, which begins so)."""
    body = SQL[name].removeprefix(DUCK).lstrip(", ")
    return body[: body.rindex(select)], body[body.rindex(select) :]


_FLAT, _ILLUM = parts_of("flatfield_apply", "SELECT tile_id"), parts_of("illum_apply", "SELECT t.tile_id")


@query(f"WITH {_FLAT[0]} {placed_sql(_FLAT[1])}")
def flatfield_apply_chunks(spark, d):
    p = blocks.profile_arrays(profile(spark, d), SIDE, SIDE)
    return unchunked(blocks.apply_flatfield(chunked(spark, d), tile_boxes(spark, d), {c: (f, None, 100.0) for c, f in p.items()}))


@query(f"WITH {_ILLUM[0]} {placed_sql(_ILLUM[1])}")
def illum_apply_chunks(spark, d):
    gains = {(c, t): 1.0 / (1 + (c + t) % 4) for c in range(NC) for t in range(25)}
    prof = {(r["c"], r["z"]): r["profile"] for r in z_profile_smooth(spark, d).collect()}  # a row per plane
    return unchunked(blocks.apply_illumination(chunked(spark, d), tile_boxes(spark, d), gains, prof))


@query(STATS + " SELECT c, i, j, s1, n1, s2, n2 FROM stats")
def overlap_stats_chunks(spark, d):
    t = derive.tiles(spark, d)
    sums = blocks.overlap_sums(chunked(spark, d), tile_boxes(spark, d), layout.overlap_sides(t, PIXEL))
    return illumination.both_sides(sums, t, PIXEL, spark.range(NC).select(F.col("id").cast("int").alias("c"))).drop("area")


@query(f"WITH level1 AS ({L1}), level2 AS ({L2}) SELECT * FROM (SELECT 1 AS level, * FROM level1 UNION ALL SELECT 2, * FROM level2) WHERE v <> 0")
def pyramid_chunks(spark, d):
    one = blocks.coarsened(chunked(spark, d), CHUNK, SHAPE, HALVE)
    two = blocks.coarsened(one, CHUNK, L1_SHAPE, HALVE)
    return storage.to_voxels(one.union(two)).select("level", "c", "z", "y", "x", "v")


@query(contrast_sql(""))
def contrast_chunks(spark, d):
    got = blocks.contrast(blocks.coarsened(chunked(spark, d), CHUNK, SHAPE, HALVE), L1_SHAPE, NC)
    return spark.createDataFrame([(c, *e) for c, e in got.items()], "c int, start int, end int")


@query("SELECT c, CAST(z - 1 AS INT) AS z, CAST(y - 7 AS INT) AS y, CAST(x - 11 AS INT) AS x, v FROM voxels WHERE z >= 1 AND z < 6 AND y >= 7 AND y < 31 AND x >= 11 AND x < 44 AND v <> 0")
def crop_chunks(spark, d):
    return unchunked(blocks.cropped(chunked(spark, d), {"z": (1, 6), "y": (7, 31), "x": (11, 44)}, CHUNK))


FUSED_SHAPE = {"z": NZ, "y": 42, "x": 42}


def fused_sparse(spark: SparkSession, d: str, how: str) -> DataFrame:
    parts = blocks.tile_parts(chunked(spark, d), tile_boxes(spark, d))
    return unchunked(blocks.fused(parts, {k: (0, 8 * (k % 5), 8 * (k // 5)) for k in range(25)}, dict.fromkeys(range(25), (NZ, SIDE, SIDE)), CHUNK, FUSED_SHAPE, how))


def without_zeros(name: str) -> str:
    head, select = parts_of(name, "SELECT c, z")
    return f"WITH {head} SELECT * FROM ({select}) WHERE v <> 0"


@query(without_zeros("fuse_translation_mean"))
def fuse_sparse_mean(spark, d):
    return fused_sparse(spark, d, "mean")


@query(without_zeros("fuse_blended"))
def fuse_sparse_blended(spark, d):
    return fused_sparse(spark, d, "blend")


@query(without_zeros("fuse_max"))
def fuse_sparse_max(spark, d):
    return fused_sparse(spark, d, "max")


WARPED_SHAPE = {"z": NZ, "y": 44, "x": 44}
#: Backward maps of the tiles, (z, y, x) rows: place in the tile = rows @ (place in the output less the tile's corner); z of odd tiles is half a voxel off where there is a third number.
PLANEWISE = (((1, 0, 0), (0, 1, -0.25), (0, 0.5, 1)), 0.0)
SHEARED = (((1, 0.125, 0), (0, 1, -0.25), (0.25, 0.5, 1)), 0.5)
BETWEEN_VOXELS = (((1, 0, 0), (0, 1, 0), (0, 0, 1)), 0.5)


def warp_sql(back: tuple, how: str, part: float = 0.0) -> str:
    """Tiles at 8 (+ part) voxels from each other, seen through `back`, between voxels linearly."""
    rows, odd = back
    at = (f"z - {odd} * (t % 2)", f"y - {8 + part} * (t % 5)", f"x - {8 + part} * (t // 5)")
    s = ", ".join(" + ".join(f"{k}::DOUBLE * ({e})" for k, e in zip(r, at) if k) + f" AS s{a}" for r, a in zip(rows, "zyx"))
    weight = "least(sy + 1, 10 - sy) * least(sx + 1, 10 - sx)" if how == "blend" else "1"
    near = " * ".join(f"CASE d{a} WHEN 0 THEN 1 - (s{a} - floor(s{a})) ELSE s{a} - floor(s{a}) END" for a in "zyx")
    i = ", ".join(f"CAST(floor(s{a}) AS INT) + d{a} AS i{a}" for a in "zyx")
    value = "max(m)" if how == "max" else "sum(m * g) / any_value(low)"
    return TILE_VOXELS + f""", places AS (SELECT z, y, x, t, {s} FROM range({NZ}) a(z), range(44) b(y), range(44) e(x), range(25) f(t)),
seen AS (SELECT *, {weight} AS g FROM places WHERE sz BETWEEN 0 AND {NZ - 1} AND sy BETWEEN 0 AND 9 AND sx BETWEEN 0 AND 9),
low AS (SELECT z, y, x, sum(g) AS low FROM seen GROUP BY 1, 2, 3),
corners AS (SELECT z, y, x, t, g, {i}, {near} AS w FROM seen, range(2) k(dz), range(2) l(dy), range(2) m(dx)),
each AS (SELECT v.c, q.z, q.y, q.x, q.t, any_value(q.g) AS g, sum(q.w * v.v) AS m FROM corners q JOIN tile_voxels v ON v.tile_id = q.t AND v.z = q.iz AND v.y = q.iy AND v.x = q.ix WHERE q.w > 0 GROUP BY 1, 2, 3, 4, 5)
SELECT * FROM (SELECT c, CAST(z AS INT) AS z, CAST(y AS INT) AS y, CAST(x AS INT) AS x, CAST(floor({value} + 1e-6) AS INT) AS v FROM each JOIN low USING (z, y, x) GROUP BY 1, 2, 3, 4) WHERE v <> 0"""


def fused_warped(spark: SparkSession, d: str, back: tuple, how: str, part: float = 0.0) -> DataFrame:
    import numpy as np

    rows, odd = back
    maps = {}
    for k in range(25):
        m = np.eye(4)
        m[:3, :3] = rows
        maps[k] = warp.shifted((odd * (k % 2), (8 + part) * (k % 5), (8 + part) * (k // 5))) @ np.linalg.inv(m)
    parts = blocks.tile_parts(chunked(spark, d), tile_boxes(spark, d))
    return unchunked(warp.warped(parts, maps, dict.fromkeys(range(25), (NZ, SIDE, SIDE)), CHUNK, WARPED_SHAPE, how))


@query(without_zeros("fuse_translation_mean"))
def fuse_affine(spark, d):
    parts = blocks.tile_parts(chunked(spark, d), tile_boxes(spark, d))
    maps = {k: warp.shifted((0, 8 * (k % 5), 8 * (k // 5))) for k in range(25)}
    return unchunked(warp.warped(parts, maps, dict.fromkeys(range(25), (NZ, SIDE, SIDE)), CHUNK, FUSED_SHAPE))


@query(warp_sql(PLANEWISE, "mean"))
def fuse_affine_planewise(spark, d):
    return fused_warped(spark, d, PLANEWISE, "mean")


@query(warp_sql(SHEARED, "blend"))
def fuse_affine_chunks(spark, d):
    return fused_warped(spark, d, SHEARED, "blend")


@query(warp_sql(SHEARED, "max"))
def fuse_affine_max(spark, d):
    return fused_warped(spark, d, SHEARED, "max")


@query(warp_sql(BETWEEN_VOXELS, "blend", 0.25))
def fuse_subvoxel(spark, d):
    return fused_warped(spark, d, BETWEEN_VOXELS, "blend", 0.25)


@query(f"WITH {RAW} SELECT c, z, raw FROM raw_")
def z_profile_chunks(spark, d):
    return blocks.plane_medians(chunked(spark, d), SHAPE, NC)


# --- a wider image, 128 by 128 voxels to a tile, that grows with the tables

WIDE_SHAPE = {"z": NZ, "y": derive.WIDE, "x": derive.WIDE}
WIDE_CHUNK = (8, 256, 256)
WIDE_TILE = 128


def wide_boxes(spark: SparkSession) -> DataFrame:
    n = derive.WIDE // WIDE_TILE
    t = spark.range(n * n).selectExpr("CAST(id AS INT) AS tile_id", f"CAST(id % {n} AS INT) * {WIDE_TILE} AS y0", f"CAST(id DIV {n} AS INT) * {WIDE_TILE} AS x0")
    return t.withColumn("y1", F.col("y0") + WIDE_TILE).withColumn("x1", F.col("x0") + WIDE_TILE)


def wide_chunks(spark: SparkSession, d: str) -> DataFrame:
    return storage.to_chunks(derive.voxels_wide(spark, d), WIDE_CHUNK, WIDE_SHAPE)


@query("""SELECT * FROM (SELECT c, CAST(z // 2 AS INT) AS z, CAST(y // 2 AS INT) AS y, CAST(x // 2 AS INT) AS x, CAST(floor(sum(v * CASE WHEN z = 6 THEN 2 ELSE 1 END)::DOUBLE / 8) AS INT) AS v
FROM voxels_wide GROUP BY 1, 2, 3, 4) WHERE v <> 0""")
def pyramid_wide(spark, d):
    return unchunked(blocks.coarsened(wide_chunks(spark, d), WIDE_CHUNK, WIDE_SHAPE, HALVE))


@query(f"""SELECT * FROM (SELECT c, z, y, x, CAST(floor(least(65535, greatest(0, v * (1.0e0 / (1 + (c + (x // {WIDE_TILE}) * {derive.WIDE // WIDE_TILE} + y // {WIDE_TILE}) % 4))))) AS INT) AS v FROM voxels_wide) WHERE v <> 0""")
def illum_wide(spark, d):
    gains = {(c, t): 1.0 / (1 + (c + t) % 4) for c in range(NC) for t in range((derive.WIDE // WIDE_TILE) ** 2)}
    return unchunked(blocks.apply_illumination(wide_chunks(spark, d), wide_boxes(spark), gains))


@query(f"""SELECT * FROM (SELECT c, z, y, x, CAST(floor(sum(v)::DOUBLE / any_value(cy.n * cx.n)) AS INT) AS v FROM
(SELECT c, z, CAST(y - 32 * (y // {WIDE_TILE}) AS INT) AS y, CAST(x - 32 * (x // {WIDE_TILE}) AS INT) AS x, v FROM voxels_wide) m
JOIN (SELECT p, count(*) AS n FROM range(8) t(k), range(1024) r(p) WHERE p >= 96 * k AND p < 96 * k + {WIDE_TILE} GROUP BY p) cy ON cy.p = m.y
JOIN (SELECT p, count(*) AS n FROM range(8) t(k), range(1024) r(p) WHERE p >= 96 * k AND p < 96 * k + {WIDE_TILE} GROUP BY p) cx ON cx.p = m.x GROUP BY 1, 2, 3, 4) WHERE v <> 0""")
def fuse_wide(spark, d):
    n, side = derive.WIDE // WIDE_TILE, 96 * (derive.WIDE // WIDE_TILE - 1) + WIDE_TILE
    parts = blocks.tile_parts(wide_chunks(spark, d), wide_boxes(spark))
    places = {t: (0, 96 * (t % n), 96 * (t // n)) for t in range(n * n)}
    return unchunked(blocks.fused(parts, places, dict.fromkeys(places, (NZ, WIDE_TILE, WIDE_TILE)), WIDE_CHUNK, {"z": NZ, "y": side, "x": side}))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gain_edges(spark, sf_dir)
