"""Connected components by alternating large and small stars.

Each round rewrites the edges so that they point to smaller nodes, until every edge leads to the
smallest node of its component. A node with very many neighbours is a skewed join key, which
adaptive execution splits; its smallest neighbour is combined on the map side. Each round is
written to the shared folder, so its lineage is one table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewinds.llm._shared import delete, tables, written


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy(F.col("u").alias("of")).agg(F.min("v").alias("low"))
    moved = both.where("v > u").join(least, F.col("u") == F.col("of")).select(F.col("v").alias("u"), F.least("u", "low").alias("v"))
    return moved.where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy(F.col("u").alias("of")).agg(F.min("v").alias("low"))
    moved = down.join(least, F.col("u") == F.col("of")).select(F.col("v").alias("u"), F.col("low").alias("v"))
    return moved.unionByName(least.select(F.col("of").alias("u"), F.col("low").alias("v"))).where("u <> v").distinct()


def components(edges: DataFrame, files: int | None = None) -> DataFrame:
    """``node, component``: the smallest node that each node of ``u, v`` edges can reach, where it is another.

    Each round is written as ``files`` files.
    """
    state = written(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "star", files)
    own, mark = tables()[-1:], None
    while True:
        now = tuple(state.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == mark or not now[0]:
            return state.select(F.col("u").alias("node"), F.col("v").alias("component"))
        mark = now
        state = written(_small_star(_large_star(state)), "star", files)
        delete(edges.sparkSession, own)  # the round before
        own = tables()[-1:]
