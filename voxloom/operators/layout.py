"""Where tiles lie: mosaic cursor, extents, corner tiles, virtual mosaics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# tile tables have a row per stage position (thousands at most), so their windows need no partition


def mosaic_extent(positions: DataFrame) -> DataFrame:
    """(ny, nx): pixels summed over distinct positions of each axis, one row."""
    one = lambda p, n: positions.groupBy(p).agg(F.min(n).alias("n")).agg(F.sum("n").alias(n[0]))
    y, x = one("y_pos", "y_n_pixels"), one("x_pos", "x_n_pixels")
    return y.select(F.lit(1).alias("k"), F.col("y").alias("ny")).join(x.select(F.lit(1).alias("k"), F.col("x").alias("nx")), "k").drop("k")


def layout_cursor(positions: DataFrame) -> DataFrame:
    """(tile_id, y_px, x_px, y_orig, x_orig): walk the tiles in order; a new y (x) position moves the cursor on by the tile's height (width), and past the mosaic it starts over."""
    ext = mosaic_extent(positions)
    w = Window.orderBy("tile_id")
    t = positions.crossJoin(F.broadcast(ext))  # one row
    for a in "yx":
        moved = (F.col(f"{a}_pos") != F.lag(f"{a}_pos").over(w)).cast("int")
        t = t.withColumn(f"m_{a}", F.coalesce(moved, F.lit(0)) * F.col(f"{a}_n_pixels"))
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    for a in "yx":
        t = t.withColumn(f"{a}_px", (F.sum(f"m_{a}").over(run) % F.col(f"n{a}")).cast("int"))
        t = t.withColumn(f"{a}_orig", F.abs(F.col(f"{a}_pos") - F.first(f"{a}_pos").over(run)))
    return t.select("tile_id", "y_px", "x_px", "y_orig", "x_orig")


def corner_tiles(tiles: DataFrame) -> DataFrame:
    """Tiles whose x and y are each first or last."""
    top = tiles.agg(F.max("x_um").alias("mx"), F.max("y_um").alias("my"))
    t = tiles.crossJoin(F.broadcast(top))  # one row
    return t.where("(x_um = 0 OR x_um = mx) AND (y_um = 0 OR y_um = my)").select("tile_id", "y_um", "x_um")


def proxy_mosaic(tile_voxels: DataFrame, n_rows: int, height: int, width: int) -> DataFrame:
    """One image from tile images (tile_id, c, z, y, x, v): tiles go down columns first. A view: nothing is copied."""
    row, col = F.col("tile_id") % n_rows, F.floor(F.col("tile_id") / n_rows)
    return tile_voxels.select("c", "z", (F.col("y") + row * height).cast("int").alias("y"), (F.col("x") + col * width).cast("int").alias("x"), "v")


def moved_chunks(parts: DataFrame, places: dict[int, tuple[int, int, int]], size: tuple[int, int, int]) -> DataFrame:
    """Chunks of tiles as the mosaic's, where tiles begin at whole chunks (of `size`): numbers and corners of chunks are moved, no voxel is touched and nothing is shuffled. places: a row per tile, of which a mosaic has hundreds."""
    if any(k % n for p in places.values() for k, n in zip(p, size, strict=True)):
        raise ValueError("tiles do not begin at whole chunks")
    rows = [(t, *p, *(k // n for k, n in zip(p, size, strict=True))) for t, p in places.items()]
    at = parts.sparkSession.createDataFrame(rows, "tile_id int, pz int, py int, px int, kz int, ky int, kx int")
    j = parts.join(F.broadcast(at), "tile_id")
    moved = {f"c{a}": F.col(f"c{a}") + F.col(f"k{a}") for a in "zyx"} | {f"{a}0": F.col(f"{a}0") + F.col(f"p{a}") for a in "zyx"}
    return j.withColumns(moved).select(*[c for c in parts.columns if c != "tile_id"])


def overlap_pairs(tiles: DataFrame, pixel: float) -> DataFrame:
    """(i, j, oy, ox): pairs i < j whose original boxes overlap down, right or down-right, by at most a tile's side.

    Tiles are bucketed by side, so neighbours meet in an equality join.
    """
    t = tiles.select("tile_id", F.bround(F.col("y_orig_um") / pixel).cast("int").alias("sy"), F.bround(F.col("x_orig_um") / pixel).cast("int").alias("sx"), F.bround(F.col("len_y_um") / pixel).cast("int").alias("hy"), F.bround(F.col("len_x_um") / pixel).cast("int").alias("hx"))
    side = t.agg(F.max("hy"), F.max("hx")).first()
    sy, sx = (side[0] or 1), (side[1] or 1)
    a = t.select(*[F.col(c).alias(f"{c}1") for c in t.columns], F.floor(F.col("sy") / sy).alias("by"), F.floor(F.col("sx") / sx).alias("bx"))
    a = a.withColumn("by", F.explode(F.array(F.col("by"), F.col("by") + 1, F.col("by") - 1))).withColumn("bx", F.explode(F.array(F.col("bx"), F.col("bx") + 1, F.col("bx") - 1)))
    b = t.select(*[F.col(c).alias(f"{c}2") for c in t.columns], F.floor(F.col("sy") / sy).alias("by"), F.floor(F.col("sx") / sx).alias("bx"))
    p = a.join(b, ["by", "bx"]).where("tile_id1 < tile_id2").select("*", F.expr("sy1 + hy1 - sy2").alias("oy"), F.expr("sx1 + hx1 - sx2").alias("ox"))
    return p.where("oy > 0 AND ox > 0 AND oy <= hy1 AND ox <= hx1").select(F.col("tile_id1").alias("i"), F.col("tile_id2").alias("j"), "oy", "ox")


def overlap_sides(tiles: DataFrame, pixel: float) -> DataFrame:
    """(i, j, side, tile_id, y0, y1, x0, x1): each pair's overlap seen in either tile (side 1 is tile i), in the tile's pixels; two rows a pair."""
    px = lambda c, n: F.bround(F.col(c) / pixel).cast("int").alias(n)
    t = tiles.select("tile_id", px("y_orig_um", "sy"), px("x_orig_um", "sx"), px("len_y_um", "hy"), px("len_x_um", "hx"))
    a, b = (t.select(*[F.col(c).alias(f"{c}{k}") for c in t.columns]) for k in "12")
    p = overlap_pairs(tiles, pixel).join(a, F.col("i") == F.col("tile_id1")).join(b, F.col("j") == F.col("tile_id2"))
    ends = lambda k: [e for n in "yx" for e in (f"greatest(s{n}1, s{n}2) - s{n}{k} AS {n}0", f"least(s{n}1 + h{n}1, s{n}2 + h{n}2) - s{n}{k} AS {n}1")]
    one, two = (p.selectExpr("i", "j", f"{k} AS side", f"tile_id{k} AS tile_id", *ends(k)) for k in (1, 2))
    return one.union(two)


def axis_aligned(pairs: DataFrame, tiles: DataFrame) -> DataFrame:
    """Pairs that differ along exactly one axis."""
    t = tiles.select("tile_id", "y_orig_um", "x_orig_um")
    a, b = (t.select(*[F.col(c).alias(f"{c}{k}") for c in t.columns]) for k in "12")
    p = pairs.join(a, F.col("i") == F.col("tile_id1")).join(b, F.col("j") == F.col("tile_id2"))
    return p.where("(y_orig_um1 <> y_orig_um2) <> (x_orig_um1 <> x_orig_um2)").select("i", "j")


def shortest_paths(pairs: list[tuple[int, int, int, int]]) -> list[tuple[int, int]]:
    """Pairs (i, j) that lie on the shortest paths from a reference tile to all others, of pairs (i, j, oy, ox); a step costs less the more its tiles overlap.

    The reference is a tile whose farthest tile is nearest (of several, the one
    met first), found by bounds: a tile is as far from its farthest one as from
    any other, so a few walks rule out nearly all. Each connected group has one
    of its own. Pairs are neighbours, so they are few.
    """
    import heapq

    near: dict[int, list[tuple[int, float]]] = {}
    for i, j, oy, ox in pairs:
        cost = 1.0 / max(1, oy * ox)
        near.setdefault(i, []).append((j, cost))
        near.setdefault(j, []).append((i, cost))

    def tree(start: int) -> tuple[dict[int, float], dict[int, int]]:
        """(length of the shortest path, the tile before) of each tile that start reaches, nearest first."""
        far, by, todo = {}, {}, [(0.0, start, start)]
        while todo:
            d, t, before = heapq.heappop(todo)
            if t in by:
                continue
            far[t], by[t] = d, before
            for k, c in near[t]:
                if k not in by:
                    heapq.heappush(todo, (d + c, k, t))
        return far, by

    def centre(group: list[int]) -> dict[int, int]:
        """The tree of the group's reference."""
        low, best, found, done = dict.fromkeys(group, 0.0), float("inf"), {}, set()

        def look(t: int) -> int:
            """Walk from t, raise all bounds; its farthest tile."""
            nonlocal best, found
            far, by = tree(t)
            done.add(t)
            end = max(far, key=lambda k: (far[k], -k))
            if far[end] < best:
                best, found = far[end], by
            for k, d in far.items():
                low[k] = max(low[k], d, far[end] - d)
            return end

        while len(done) < len(group):
            t = min((k for k in group if k not in done), key=lambda k: (low[k], k))
            if low[t] >= best * (1 - 1e-12):
                break
            end = look(t)
            if end not in done:
                look(end)
        return found

    left, out = set(near), []
    while left:
        by = centre(sorted(tree(min(left))[0]))
        out += [(min(t, p), max(t, p)) for t, p in by.items() if t != p]
        left -= set(by)
    return sorted(out)


def large_overlaps(pairs: list[tuple[int, int, int, int]]) -> list[tuple[int, int]]:
    """Pairs whose overlap's area is above the threshold that best splits all areas in two; all of them where they are alike."""
    from voxloom.kernels.transforms import otsu

    import numpy as np

    area = np.array([oy * ox for _, _, oy, ox in pairs], float)
    if len(set(area.tolist())) < 2:
        return [(i, j) for i, j, *_ in pairs]
    least = otsu(area)
    return [(i, j) for (i, j, *_), a in zip(pairs, area, strict=True) if a >= least]


def without_every_other(pairs: DataFrame, tiles: DataFrame, pixel: float) -> DataFrame:
    """Pruning that keeps pairs of neighbours of different parity of (row + column)."""
    t = tiles.select("tile_id", (F.dense_rank().over(Window.orderBy("y_orig_um")) + F.dense_rank().over(Window.orderBy("x_orig_um"))).alias("p"))
    a, b = (t.select(F.col("tile_id").alias(f"t{k}"), F.col("p").alias(f"p{k}")) for k in "12")
    return pairs.join(a, F.col("i") == F.col("t1")).join(b, F.col("j") == F.col("t2")).where("(p1 + p2) % 2 = 1").select("i", "j")
