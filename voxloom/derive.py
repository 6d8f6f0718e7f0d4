"""Images, tiles and positions derived from the star-schema test tables, the same in every SQL engine."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

NC, NZ, NY, NX = 3, 7, 50, 50

#: Each view as portable SQL; `{range(n)}` is spelled per engine below.
VOXELS_SPARSE = """
SELECT CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS c, CAST(l_linenumber - 1 AS INT) AS z,
       CAST(l_partkey % 50 AS INT) AS y, CAST(l_orderkey % 50 AS INT) AS x,
       CAST(least(65535, sum(CAST(l_quantity AS BIGINT)) * 100) AS INT) AS v
FROM lineitem GROUP BY 1, 2, 3, 4
"""
#: A wider image, whose stored voxels grow with the tables.
WIDE = 1024
VOXELS_WIDE = f"""
SELECT CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS c, CAST(l_linenumber - 1 AS INT) AS z,
       CAST(l_partkey % {WIDE} AS INT) AS y, CAST(l_orderkey % {WIDE} AS INT) AS x,
       CAST(least(65535, sum(CAST(l_quantity AS BIGINT)) * 100) AS INT) AS v
FROM lineitem GROUP BY 1, 2, 3, 4
"""
TILES = """
SELECT CAST(n_nationkey AS INT) AS tile_id,
       20.0e0 * floor(n_nationkey / 5.0e0) AS x_um, 20.0e0 * (n_nationkey % 5) AS y_um, 0.0e0 AS z_um,
       16.0e0 * floor(n_nationkey / 5.0e0) AS x_orig_um, 16.0e0 * (n_nationkey % 5) AS y_orig_um,
       20.0e0 AS len_x_um, 20.0e0 AS len_y_um, 7.0e0 AS len_z_um
FROM nation
"""
POSITIONS = """
SELECT CAST(n_nationkey AS INT) AS tile_id, 100.0e0 - 16.0e0 * floor(n_nationkey / 5.0e0) AS x_pos, 100.0e0 - 16.0e0 * (n_nationkey % 5) AS y_pos,
       10 AS x_n_pixels, 10 AS y_n_pixels
FROM nation
"""
#: Prefix of oracle queries: the same views for DuckDB.
DUCK = f"""
WITH voxels_sparse AS ({VOXELS_SPARSE}),
voxels_wide AS ({VOXELS_WIDE}),
grid AS (SELECT CAST(a.c AS INT) AS c, CAST(b.z AS INT) AS z, CAST(d.y AS INT) AS y, CAST(e.x AS INT) AS x
         FROM range({NC}) a(c), range({NZ}) b(z), range({NY}) d(y), range({NX}) e(x)),
voxels AS (SELECT g.c, g.z, g.y, g.x, coalesce(s.v, 0) AS v FROM grid g LEFT JOIN voxels_sparse s USING (c, z, y, x)),
tiles AS ({TILES}),
acq_positions AS ({POSITIONS}),
image2d AS (SELECT CAST(vec_id AS INT) AS y, CAST(i AS INT) AS x, CAST(floor((embedding[i + 1] + 4) * 1000) AS INT) AS v
            FROM embeddings, range(64) t(i))
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _sql(spark: SparkSession, sf_dir: str, name: str, text: str) -> DataFrame:
    return spark.sql(text.replace(f"FROM {name}", "FROM {t}"), t=table(spark, sf_dir, name))


def voxels_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored voxels only; an absent one is 0."""
    return _sql(spark, sf_dir, "lineitem", VOXELS_SPARSE)


def voxels_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored voxels of the wider image."""
    return _sql(spark, sf_dir, "lineitem", VOXELS_WIDE)


def grid(spark: SparkSession, nc: int = NC, nz: int = NZ, ny: int = NY, nx: int = NX) -> DataFrame:
    """All (c, z, y, x) of a box, generated in parallel from one number range."""
    i = spark.range(nc * nz * ny * nx)
    at = lambda div, n: F.expr(f"CAST(id DIV {div} % {n} AS INT)")
    return i.select(at(nz * ny * nx, nc).alias("c"), at(ny * nx, nz).alias("z"), at(nx, ny).alias("y"), at(1, nx).alias("x"))


def densify(sparse: DataFrame, nc: int = NC, nz: int = NZ, ny: int = NY, nx: int = NX) -> DataFrame:
    """Sparse voxels with the zeros that are not stored."""
    g = grid(sparse.sparkSession, nc, nz, ny, nx)
    return g.join(sparse, ["c", "z", "y", "x"], "left").withColumn("v", F.coalesce("v", F.lit(0)))


def voxels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return densify(voxels_sparse(spark, sf_dir))


def tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(spark, sf_dir, "nation", TILES)


def acq_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(spark, sf_dir, "nation", POSITIONS)


def image2d(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An image with a row per embedding."""
    e = table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("int").alias("y"), F.posexplode("embedding").alias("x", "e"))
    return e.select("y", "x", F.floor((F.col("e") + 4) * 1000).cast("int").alias("v"))
