"""Connected components by alternating large-star and small-star joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakespan.llm.scratch import Scratch
from lakespan.llm.skew import few, hot_from, join_hot

#: Up to so many edges the least neighbours, two numbers a node, are sent to all tasks rather than shuffled.
SENT = 100_000


def _least(e: DataFrame, n: int) -> DataFrame:
    """The n edges e (u, v) with m, the least v of u. A node with very many edges isn't gathered in one task."""
    low = e.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("k"))
    if n <= SENT:
        return e.join(F.broadcast(few(low.drop("k"), n)), "u")
    return join_hot(e, low.drop("k"), "u", low.where(F.col("k") > hot_from(n)))


def _large(e: DataFrame, n: int) -> DataFrame:
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _least(both, 2 * n).where("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v"))


def _small(e: DataFrame, n: int) -> DataFrame:
    """e has u > v. Each u's least neighbour takes u and u's other neighbours."""
    return _least(e, n).select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")).distinct()


def components(edges: DataFrame, scratch: Scratch, name: str, most: int | None = None) -> DataFrame:
    """(u, v): every node that is not the least of its component, with the least. edges: (u, v), u <> v; most rows at most.

    Each round is written to the shared folder, so a lost executor costs one round at most.
    """
    e = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    e = scratch.cut(e if most is None else few(e, most), f"{name}-0")
    was, i = None, 0
    while True:
        n = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if not n[0] or n == was:
            return e
        was, i = n, i + 1
        e = scratch.cut(few(_small(_large(e, n[0]), n[0]), n[0]), f"{name}-{i}")
        scratch.drop(f"{name}-{i - 1}")
