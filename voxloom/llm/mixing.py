"""Mixing sources to target weights by weighted fair queueing; DataFrame operations only.

Every source shuffles its documents by a seeded hash, up to three times over
(passes), and gives each copy a virtual finish time: the source's words so far
divided by its weight. All copies are then range-sorted by finish time and cut
at the total budget. A source that has given all its passes stops, and the
others go on at their weights, so the cut falls where the targets, filled like
water up to three times each source's size, meet the budget.

Nothing is sorted in one task: both orders, that of a source's documents and
that of all copies, are dealt by range over rows of the whole sort key, which
no two different rows share. So a source with a third of all rows, or rows that
all finish at one time, are spread like any others, and running totals go
range by range (see `common.ranged_total`).

What is taken of a source is, pass by pass, the documents up to one place in
its shuffled order. These cuts, a row per source, are all that the documents
themselves are joined with, so mixing them moves no text.

Edge cases: null text has size 0; sizes of 0 are taken with no words; a null
source is a source, last in order; equal rows (same id, source and size) are
taken together; ties in the hash order go by id (null first), then size; an
empty table gives an empty mix; other columns are untouched, whatever their
names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from voxloom.llm.common import WORD, keyed_join, materialise, numbered, ranged_total

#: Weights of the sources in code-point order, repeating.
WEIGHTS = (5, 2, 1)
#: Times that a document is taken at most.
PASSES = 3
#: Seed of the shuffle within sources.
SEED = 17


@dataclass
class Mix:
    """cuts: a row per source, with the last place taken in each pass (m_cuts); n_sources: their number;
    order: the taken copies with virtual finish time and the running total of words;
    taken: (doc_id, source, size, rows, source_size, target, copies), one row per different document row, and how often it is taken."""

    cuts: DataFrame
    n_sources: int
    order: DataFrame
    taken: DataFrame


def _size(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def sized(docs: DataFrame, text: str = "text", key: str = "doc_id", source: str = "source") -> DataFrame:
    """(doc_id, source, size, rows): equal rows together; size counts words."""
    return docs.select(F.col(key).alias("doc_id"), F.col(source).alias("source"), _size(F.col(text)).alias("size")).groupBy("doc_id", "source", "size").agg(F.count("*").alias("rows"))


def targets(units: DataFrame, weights: tuple[int, ...] = WEIGHTS, passes: int = PASSES) -> DataFrame:
    """(source, m_rank, m_weight, source_size, target): targets share all words by weight, none above passes times its source's size.

    Water-filling: sources sorted by passes * size / weight fill up one after
    the other; the first whose share of the rest fits sets the level. One row
    per source, so its windows are small.
    """
    s = units.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())).cast("long")
    s = s.withColumn("m_rank", rank).withColumn("m_weight", F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.col("m_rank") - 1, F.lit(len(weights))) + 1).cast("int")).cast("long"))
    everyone, w = Window.partitionBy(), Window.orderBy((F.col("source_size") / F.col("m_weight")), "m_rank")
    full = F.col("source_size") * passes
    s = s.withColumn("m_all", F.sum("source_size").over(everyone))
    s = s.withColumn("m_filled", F.coalesce(F.sum(full).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    s = s.withColumn("m_left", F.sum("m_weight").over(w.rowsBetween(0, Window.unboundedFollowing)))
    level = (F.col("m_all") - F.col("m_filled")).cast("double") / F.col("m_left")
    s = s.withColumn("m_level", F.when(level * F.col("m_weight") <= full, level)).withColumn("m_level", F.coalesce(F.max("m_level").over(everyone), F.lit(0.0)))
    return s.select("source", "m_rank", "m_weight", "source_size", "m_level", F.least(full.cast("double"), F.col("m_level") * F.col("m_weight")).alias("target"))


def _place(key: Column, size: Column, seed: int) -> Column:
    """A document's place in its source's shuffled order."""
    return F.struct(F.shiftrightunsigned(F.xxhash64(F.lit(seed), key, size), 1).alias("m_hash"), key.alias("doc_id"), size.alias("size"))


def mix(docs: DataFrame, text: str = "text", key: str = "doc_id", source: str = "source", weights: tuple[int, ...] = WEIGHTS, passes: int = PASSES, seed: int = SEED) -> Mix:
    """Mix all documents; the total budget is their total size."""
    units = materialise(sized(docs, text, key, source))
    goal = materialise(targets(units, weights, passes))
    n_sources = goal.count()
    u = keyed_join(units, goal, ["source"], n_sources)
    u = u.withColumn("m_place", _place(F.col("doc_id"), F.col("size"), seed)).withColumn("m_words", F.col("size") * F.col("rows"))
    u = materialise(ranged_total(u, ["m_rank"], ["m_rank", "m_place"], "m_words", "m_upto"))
    # virtual time of a copy: words of the source up to it, over all passes, divided by the weight
    c = u.withColumn("m_pass", F.explode(F.sequence(F.lit(0), F.lit(passes - 1))))
    c = c.withColumn("finish", (F.col("m_pass") * F.col("source_size") + F.col("m_upto")).cast("double") / F.col("m_weight"))
    c = materialise(ranged_total(c, [], ["finish", "m_rank", "m_pass", "m_place"], "m_words", "total"))
    budget = goal.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    order = c.where(F.col("total") <= F.lit(budget))
    last = order.groupBy("m_rank", "m_pass").agg(F.max("m_place").alias("m_last"))
    cuts = last.groupBy("m_rank").agg(F.collect_list("m_last").alias("m_cuts"))  # `passes` places at most
    cuts = materialise(goal.join(cuts, "m_rank", "left"))
    copies = F.size(F.filter(F.coalesce("m_cuts", F.array()), lambda x: x >= F.col("m_place"))).cast("long")
    taken = keyed_join(u, cuts.select("source", "m_cuts"), ["source"], n_sources).withColumn("copies", copies)
    return Mix(
        cuts,
        n_sources,
        order.select("doc_id", "source", "size", "rows", F.col("m_pass").alias("pass"), "finish", "total"),
        taken.select("doc_id", "source", "size", "rows", "source_size", "target", "copies"),
    )


def in_mixing_order(m: Mix) -> DataFrame:
    """The mix as a globally range-sorted table of copies."""
    return m.order.orderBy("total", "finish")


def mix_documents(docs: DataFrame, text: str = "text", key: str = "doc_id", source: str = "source", seed: int = SEED) -> DataFrame:
    """The rows of docs as often as the mix takes them (0 to 3 times), with the columns of docs; a scan of docs beside the cuts."""
    m = mix(docs, text, key, source, seed=seed)
    d, new = numbered(docs)
    d = d.withColumn("m_place", _place(F.col(new[key]), _size(F.col(new[text])), seed)).withColumn("source", F.col(new[source]))
    j = keyed_join(d, m.cuts.select("source", "m_cuts"), ["source"], m.n_sources)
    copies = F.filter(F.coalesce("m_cuts", F.array()), lambda x: x >= F.col("m_place"))
    return j.select(*new.values(), F.explode(copies)).select(*new.values()).toDF(*docs.columns)
