"""Chat formatting of logged conversations; DataFrame operations only.

A conversation that was logged again and again as it grew is there in many
snapshots. Every turn gets a rolling hash of all turns up to it (128 bits: two
running exclusive-ors of position-salted hashes). A snapshot is dropped when
its whole hash is the hash of some other conversation's proper prefix (an
anti-join); of equal conversations the least conv_id stays. What remains is
rendered, SEGMENT turns to a row, so that a conversation of any length takes
bounded rows.

Positions and rolling hashes are counted bucket by bucket, so a conversation
with a third of all turns is spread over many tasks; prefixes and whole
conversations are reduced to distinct hashes before they meet, so a popular
first turn is one row.

Edge cases: turns are ordered by turn (nulls first), equal ones by the md5 of
role and text; a null role renders as `unknown` and a null text as empty, and
both compare so; a null conv_id is a conversation of its own; repeated rows
are turns of their own; an empty table gives an empty result; a turn is its
role and its text, wherever line breaks are in them; other columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from voxloom.llm.common import materialise, running_total

#: Turns in a rendered row.
SEGMENT = 64
#: Turn numbers in a bucket.
BUCKET = 64


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, position, role, text, digest): turns numbered from 1 in each conversation."""
    role, text = F.coalesce("role", F.lit("unknown")), F.coalesce("text", F.lit(""))
    t = conversations.select("conv_id", F.coalesce(F.col("turn").cast("long"), F.lit(-1)).alias("turn"), role.alias("role"), text.alias("text"))
    t = t.withColumn("digest", F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary")))  # the length tells where the role ends
    # a null conv_id can't be joined on: it goes by a flag and a stand-in
    t = t.withColumn("c_null", F.col("conv_id").isNull()).withColumn("conv_id", F.coalesce("conv_id", F.lit(0)))
    # turns without a number all have one turn: they are bucketed by digest, in which order they are
    within = F.when(F.col("turn") == -1, 65536 + F.conv(F.substring("digest", 1, 4), 16, 10).cast("long")).otherwise(0)
    t = t.withColumn("c_bucket", F.floor(F.col("turn") / BUCKET) * 131072 + within).withColumn("c_one", F.lit(1).cast("long"))
    t = running_total(t, ["c_null", "conv_id"], "c_bucket", ["turn", "digest"], "c_one", "position")
    return t.select("c_null", "conv_id", "position", "role", "text", "digest")


def _running_xor(rows: DataFrame, part: list[str], values: list[str]) -> DataFrame:
    """rows with p_<value>: the exclusive-or of value over the part up to this position, counted in buckets of positions."""
    inner = Window.partitionBy(*part, "x_bucket").orderBy("position").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*part).orderBy("x_bucket").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("x_bucket", F.floor(F.col("position") / BUCKET))
    sums = rows.groupBy(*part, "x_bucket").agg(*[F.bit_xor(v).alias(f"s_{v}") for v in values])
    sums = sums.select(*part, "x_bucket", *[F.coalesce(F.bit_xor(f"s_{v}").over(before), F.lit(0)).alias(f"o_{v}") for v in values])
    rows = rows.select("*", *[F.bit_xor(v).over(inner).alias(f"i_{v}") for v in values]).join(sums, [*part, "x_bucket"])
    return rows.select(*part, "position", *values, *[F.col(f"i_{v}").bitwiseXOR(F.col(f"o_{v}")).alias(f"p_{v}") for v in values])


def maximal(numbered: DataFrame) -> DataFrame:
    """(c_null, conv_id) of conversations that are no proper prefix of another; of equal ones the least, null last."""
    part = ["c_null", "conv_id"]
    h = numbered.select(*part, "position", F.xxhash64(F.lit(1), "position", "digest").alias("h1"), F.xxhash64(F.lit(2), "position", "digest").alias("h2"))
    rolled = materialise(_running_xor(h, part, ["h1", "h2"]))
    whole = rolled.groupBy(*part).agg(F.max("position").alias("n"), F.bit_xor("h1").alias("w1"), F.bit_xor("h2").alias("w2"))
    whole = whole.groupBy("n", "w1", "w2").agg(F.min(F.struct(*part)).alias("c"))
    prefix = rolled.where("position > 1").select((F.col("position") - 1).alias("n"), F.col("p_h1").bitwiseXOR(F.col("h1")).alias("w1"), F.col("p_h2").bitwiseXOR(F.col("h2")).alias("w2")).distinct()
    return whole.join(prefix, ["n", "w1", "w2"], "left_anti").select("c.*", "n")


def rendered(role: Column, text: Column) -> Column:
    return F.concat(F.lit("<|"), role, F.lit("|>\n"), text, F.lit("<|end|>\n"))


def format_chats(conversations: DataFrame) -> DataFrame:
    """(conv_id, segment, n_turns, text): maximal conversations; n_turns counts the turns of the segment."""
    numbered = materialise(turns(conversations))
    # a row per segment of what stays, so that no conversation's turns meet in one task
    keep = maximal(numbered).withColumn("segment", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / SEGMENT)))).drop("n")
    kept = numbered.withColumn("segment", F.floor((F.col("position") - 1) / SEGMENT)).join(keep, ["c_null", "conv_id", "segment"], "left_semi")
    g = kept.groupBy("c_null", "conv_id", "segment").agg(F.count("*").alias("n_turns"), F.array_sort(F.collect_list(F.struct("position", rendered(F.col("role"), F.col("text")).alias("t")))).alias("ts"))
    return g.select(F.when(~F.col("c_null"), F.col("conv_id")).alias("conv_id"), "segment", "n_turns", F.array_join(F.transform("ts", lambda x: x["t"]), "").alias("text"))


SQL = f"""
WITH t AS (
    SELECT conv_id, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY coalesce(turn, -1), md5(length(coalesce(role, 'unknown')) || ':' || coalesce(role, 'unknown') || coalesce(text, ''))) AS position
    FROM conversations
), p AS (
    SELECT conv_id, position, role, text,
           string_agg(md5(length(role) || ':' || role || text), ',') OVER (PARTITION BY conv_id ORDER BY position) AS prefix
    FROM t
), w AS (
    SELECT conv_id, max(position) AS n, arg_max(prefix, position) AS whole FROM p GROUP BY conv_id
), m AS (
    SELECT min(conv_id) AS conv_id FROM w
    WHERE NOT EXISTS (SELECT 1 FROM p JOIN w AS v USING (conv_id) WHERE p.position = w.n AND p.prefix = w.whole AND v.n > w.n)
    GROUP BY whole
)
SELECT conv_id, CAST((position - 1) // {SEGMENT} AS BIGINT) AS segment, count(*) AS n_turns,
       string_agg('<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10), '' ORDER BY position) AS text
FROM p WHERE conv_id IN (SELECT conv_id FROM m) GROUP BY 1, 2
"""
