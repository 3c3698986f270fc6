"""Connected components of an edge table, without collecting it anywhere.

Alternating star contraction: each step hangs a node's neighbours on the smallest of them, with
one minimum by key (combined before the shuffle) and one join, so a node with very many
neighbours is never gathered in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._spark import cut

#: Edges in one partition, about: what few edges in very many partitions cost is tasks, which the driver keeps account of.
EDGES = 1 << 16


def _step(edges: DataFrame, large: bool, parts: int) -> DataFrame:
    turned = F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    both = edges.select(F.explode(turned).alias("e")).select("e.a", "e.b") if large else edges
    low = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
    hung = both.join(low, "a")
    if large:
        out = hung.where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).coalesce(parts)
    else:
        out = hung.select(F.col("b").alias("a"), F.col("low").alias("b")).coalesce(parts).union(low.select("a", F.col("low").alias("b")).coalesce(parts))
    return out.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct().coalesce(parts)


def components(edges: DataFrame) -> DataFrame:
    """(id, component): the smallest id that each id of an edge (a, b) reaches.

    Ids may be of any type with an order. Ids without an edge, null ends and loops are not in
    the result.
    """
    edges = edges.where("a is not null and b is not null and a <> b")
    edges = cut(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    parts = -(-edges.count() // EDGES) or 1
    while True:
        edges = edges.coalesce(parts)
        # a star forest: each id hangs on one root, and no root hangs on another id
        n, ids = edges.groupBy("a").agg(F.count("*").alias("n")).coalesce(parts).agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
        parts = -(-n // EDGES) or 1
        if n == ids and edges.join(edges.select(F.col("a").alias("b")), "b", "left_semi").coalesce(parts).limit(1).count() == 0:
            break
        edges = cut(_step(_step(edges, True, parts), False, parts))
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).union(edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct().coalesce(parts))
