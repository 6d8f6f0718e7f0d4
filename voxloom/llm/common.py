"""Helpers shared by the corpus operators: shared scratch tables, size-checked joins, distributed running totals."""

from __future__ import annotations

import contextlib
import ctypes
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

#: Characters that separate words everywhere in this subpackage: space and U+0009 to U+000D.
WORD = r"[^\x20\x09-\x0D]+"

#: Rows up to which a keyed side table is broadcast; beyond it the join is salted and shuffled.
BROADCAST_ROWS = 50_000

#: Copies of a side table's rows, and salts of the other side, in a salted join.
SALTS = 32


def shared_dir(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir, which driver and executors share; a temporary one where that is unset (local runs)."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir is not set: it must name a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="voxloom-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/voxloom-{uuid.uuid4().hex}"


#: Folders of the tables stored by this driver, in order.
_STORED: list[str] = []


def materialise(df: DataFrame) -> DataFrame:
    """Write df once as Parquet to the shared folder and read it back: cuts lineage and survives lost executors."""
    path = shared_dir(df.sparkSession)
    df.write.parquet(path)
    _STORED.append(path)
    return df.sparkSession.read.schema(StructType(df.schema.fields)).parquet(path)


def stored_alone(make: Callable[[], DataFrame]) -> DataFrame:
    """What make() gives, stored; the tables that were stored on the way to it are deleted."""
    start = len(_STORED)
    out = materialise(make())
    for path in _STORED[start:-1]:
        _delete(out.sparkSession, path)
    del _STORED[start:-1]
    return out


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def release(*stored: DataFrame) -> None:
    """Delete the tables behind DataFrames that only read what `materialise` wrote; nothing may read them afterwards."""
    for df in stored:
        for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
            if re.search(r"/voxloom-[0-9a-f]{32}$", folder):
                _delete(df.sparkSession, folder)


def same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Null-safe equality of all keys; right has them under the names r_<key>."""
    return reduce(lambda a, b: a & b, (left[k].eqNullSafe(right[f"r_{k}"]) for k in keys))


def keyed_join(left: DataFrame, right: DataFrame, keys: Sequence[str], rows: int, bound: int = BROADCAST_ROWS, how: str = "left") -> DataFrame:
    """left joined with right, which has one row per key and `rows` rows.

    Up to `bound` rows the right side is broadcast. Beyond that both sides are
    shuffled with a salt, so a key with a third of all rows is dealt over
    SALTS tasks. Nulls equal nulls.
    """
    right = right.select(*[F.col(k).alias(f"r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    drop = [f"r_{k}" for k in keys]
    if rows <= bound:
        return left.join(F.broadcast(right), same(left, right, keys), how).drop(*drop)
    left = left.withColumn("salt", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in left.columns]), F.lit(SALTS)).cast("int"))
    right = right.withColumn("r_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return left.join(right, same(left, right, [*keys, "salt"]), how).drop(*drop, "salt", "r_salt")


def running_total(df: DataFrame, part: Sequence[str], bucket: str, order: Sequence[str], value: str, out: str, span: int = 512) -> DataFrame:
    """df with `out`: the sum of `value` over the rows of the same `part` up to and including this one.

    Rows are ordered by (bucket, *order); `bucket` must be a long that rises
    with the order wanted. No window holds more than one bucket: bucket sums
    are summed again per `span` buckets, so what any task sorts stays small
    however large a part is. `order` has to be total but for equal rows.
    """
    coarse = F.floor(F.col(bucket) / span).cast("long")
    sums = df.groupBy(*part, bucket).agg(F.sum(value).alias("rt_sum")).withColumn("rt_coarse", coarse)
    tops = sums.groupBy(*part, "rt_coarse").agg(F.sum("rt_sum").alias("rt_top"))
    by = lambda *c: Window.partitionBy(*c) if c else Window.partitionBy()
    tops = tops.withColumn("rt_base", F.coalesce(F.sum("rt_top").over(by(*part).orderBy("rt_coarse").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("rt_top")
    sums = sums.join(tops, [*part, "rt_coarse"])
    sums = sums.withColumn("rt_off", F.col("rt_base") + F.coalesce(F.sum("rt_sum").over(by(*part, "rt_coarse").orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    inside = F.sum(value).over(by(*part, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    rows = df.withColumn("rt_in", inside)
    return rows.join(sums.select(*part, bucket, "rt_off"), [*part, bucket]).withColumn(out, F.col("rt_in") + F.col("rt_off")).drop("rt_in", "rt_off")


def ranged_total(df: DataFrame, part: Sequence[str], order: Sequence[str], value: str, out: str) -> DataFrame:
    """df with `out`: the sum of `value` over the rows of the same `part` up to and including this one, in `order` (which begins with `part`, or part is empty).

    Rows are range-partitioned by the whole order, and equal ones by their place
    in df (which has to be stored, so that it is the same each time), so ranges
    hold about as many rows each whatever the keys; a range's rows are summed by
    a window of its own and the sums of the ranges before it are added. Which
    range a row is in is stored before it is used, so a lost executor changes
    nothing. `order` has to be total but for equal rows.
    """
    order = [*order, "rt_tie"]
    numbered = df.withColumn("rt_tie", F.monotonically_increasing_id())
    dealt = materialise(numbered.repartitionByRange(*order).withColumn("rt_range", F.spark_partition_id()))
    sums = dealt.groupBy(*part, "rt_range").agg(F.sum(value).alias("rt_sum"))
    w = Window.partitionBy(*part) if part else Window.partitionBy()  # a row per range, and per part in it
    sums = sums.withColumn("rt_off", F.coalesce(F.sum("rt_sum").over(w.orderBy("rt_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    inside = F.sum(value).over(Window.partitionBy(*part, "rt_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    rows = dealt.withColumn("rt_in", inside)
    return rows.join(sums.select(*part, "rt_range", "rt_off"), [*part, "rt_range"]).withColumn(out, F.col("rt_in") + F.col("rt_off")).drop("rt_in", "rt_off", "rt_range", "rt_tie")


_KEPT: dict[str, object] = {}


def forget_kept() -> None:
    """Give the memory of what this Python worker keeps back, and what it has freed; operators call it where they are done with much of it.

    Where the C library has such calls, arrays of a megabyte or more are from
    then on given back as soon as they are freed.
    """
    _KEPT.clear()
    with contextlib.suppress(OSError, AttributeError):
        libc = ctypes.CDLL(None)
        libc.mallopt(-3, 1 << 20)  # M_MMAP_THRESHOLD
        libc.malloc_trim(0)


def keep_freed(mb: int) -> None:
    """Let this Python worker keep `mb` megabytes that it has freed, for loops over arrays of up to that size; until `forget_kept`."""
    with contextlib.suppress(OSError, AttributeError):
        libc = ctypes.CDLL(None)
        libc.mallopt(-3, mb << 20)  # M_MMAP_THRESHOLD
        libc.mallopt(-1, mb << 20)  # M_TRIM_THRESHOLD


def kept_in_worker(key: str, make: Callable[[], object]) -> object:
    """make(), kept by this Python worker from task to task. Only the last key is kept: a worker that goes on to another operator gives its memory back."""
    if key not in _KEPT:
        forget_kept()
        _KEPT[key] = make()
    return _KEPT[key]


def texts_in(column: pa.Array, step: int = 512) -> Iterator[list[bytes | None]]:
    """A text column as UTF-8, a few rows at a time."""
    for i in range(0, len(column), step):
        yield column.slice(i, step).cast(pa.binary()).to_pylist()


def numbered(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """docs with its columns named d0, d1, ... and the new name of each: names that no operator uses. Their order is kept."""
    new = {c: f"d{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*new.values()), new


def crc_mod(doc_id: str | Column, m: int) -> Column:
    """crc32 of doc_id as text, modulo m; null for a null doc_id."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.pmod(F.crc32(c.cast("string").cast("binary")), F.lit(m))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
