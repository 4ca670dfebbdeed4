"""Connected components of an edge table, by alternating large and small stars.

Every step is a grouped minimum and a join on the edges; nothing comes to the driver but
two sums per round, by which the end is seen.  The edges shrink to a star per component.
A round over few edges, as counted, takes one task: it would cost a thousand tiny tasks, whose
reports the driver holds, to deal them out by each of its keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import few, stored


def _star(edges: DataFrame, large: bool, rows: int) -> DataFrame:
    """Link the neighbours of each node to the least of them and itself: the larger
    neighbours (``large``), or the node and its smaller ones; ``rows``: about the edges."""
    both = edges.select("u", "v")
    if large:
        both = both.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = both.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    both = few(both, rows)
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    linked = both.join(least.withColumnRenamed("u", "w"), F.col("u") == F.col("w"))
    if large:
        out = linked.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = linked.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            least.select("u", F.col("m").alias("v"))
        )
    return few(out.where("u <> v"), rows).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for each node of ``edges`` (u, v), the component being its least
    node.  Self links and repeated edges are allowed; an edge with a null is none."""
    edges = stored(
        edges.where("u IS NOT NULL AND v IS NOT NULL AND u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges",
    )
    before = None
    while True:
        state = edges.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if state == before or not state[0]:
            break
        before = state
        edges = stored(_star(_star(edges, True, state[0]), False, state[0]), "edges")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
