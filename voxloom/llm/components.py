"""Connected components of a table of links, by contraction to least neighbours."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from voxloom.llm.common import materialise

#: Up to so many links one task joins them up in memory; beyond, they are contracted in rounds of joins. Both give the same labels.
FEW_LINKS = 50_000


def _in_one_task(links: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        up: dict = {}

        def top(x):
            while up[x] != x:
                up[x] = up[up[x]]
                x = up[x]
            return x

        kind = None
        for b in batches:
            kind = b.schema.field(0).type
            for x, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                up.setdefault(x, x)
                up.setdefault(y, y)
                p, q = top(x), top(y)
                up[max(p, q)] = min(p, q)
        if up:
            yield pa.RecordBatch.from_arrays([pa.array(list(up), kind), pa.array([top(x) for x in up], kind)], names=["node", "label"])

    kind = links.schema["a"].dataType
    return links.select("a", "b").repartition(1).mapInArrow(run, StructType([StructField("node", kind), StructField("label", kind)]))


def connected(links: DataFrame, few: int = FEW_LINKS) -> DataFrame:
    """(node, label): label is the least node reachable; only nodes with a link have rows. links: (a, b), either way round, stored.

    Each round every node of the contracted graph hooks to its least neighbour
    if that is smaller, chains of hooks are followed by pointer jumping, and
    the graph is contracted to the nodes hooked to. A node that hooks to none
    has only neighbours that hook, so each round at least halves the nodes.
    All tables are stored in the shared folder; only whether something moved
    reaches the driver.
    """
    ends = links.where(F.col("a") != F.col("b"))
    if links.count() <= few:
        return materialise(_in_one_task(ends))
    edges = materialise(ends.select(F.col("a").alias("u"), F.col("b").alias("v")).union(ends.select(F.col("b").alias("u"), F.col("a").alias("v"))).distinct())
    labels = edges.select(F.col("u").alias("node"), F.col("u").alias("label")).distinct()
    while not edges.isEmpty():
        hooks = materialise(edges.groupBy("u").agg(F.min(F.least("u", "v")).alias("p")))
        moved = True
        while moved:
            far = hooks.select(F.col("u").alias("f_u"), F.col("p").alias("f_p"))
            new = materialise(hooks.join(far, F.col("p") == F.col("f_u")).select("u", F.col("f_p").alias("p"), (F.col("f_p") != F.col("p")).alias("moved")))
            hooks, moved = new.drop("moved"), not new.where("moved").isEmpty()
        labels = materialise(labels.join(hooks, F.col("label") == F.col("u"), "left").select("node", F.coalesce("p", "label").alias("label")))
        to = hooks.select(F.col("u").alias("t_u"), F.col("p").alias("t_p"))
        one = edges.join(hooks, "u").select(F.col("p").alias("u"), "v")
        edges = materialise(one.join(to, F.col("v") == F.col("t_u")).select("u", F.col("t_p").alias("v")).where("u <> v").distinct())
    return labels
