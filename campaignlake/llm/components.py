"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from campaignlake.llm.common import materialize


def _lowest(edges: DataFrame) -> DataFrame:
    """Per ``u``, the lowest of itself and its neighbours."""
    return edges.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v"), F.col("u"))).toDF("u", "v")
    joined = both.join(_lowest(both), "u").where("v > u")
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    lowest = _lowest(down)
    moved = down.join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(lowest.toDF("u", "v")).where("u <> v").distinct()


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node with an edge; the label is the component's lowest node.

    ``edges`` has long columns ``u`` and ``v``. Edges move in joins on their end
    and minima are pre-aggregated, so a hub with many edges is no single task's
    list. Rounds grow with the logarithm of the nodes; each is written to the
    shared folder.
    """
    now = materialize(edges.select("u", "v").where("u <> v").distinct(), "edges")
    mark = _mark(now)
    while mark[0]:
        now = materialize(_small_star(_large_star(now)), "edges")
        last, mark = mark, _mark(now)
        if last == mark:
            break
    labels = now.select(F.col("u").alias("node"), F.col("v").alias("label"))
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    return labels.union(roots)
