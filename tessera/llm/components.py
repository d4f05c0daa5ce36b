"""Connected components of an edge table by alternating star contractions.

Each round points the larger neighbours of every node at its smallest one
(large star), then joins the nodes at or below it the same way (small star).
Edges never grow in number, the rounds needed grow with the logarithm of the
longest chain, and every round is a grouped minimum and an equi-join of edges
of two numbers: no component is gathered as a list, but the edges of one node
meet in one join key, which adaptive execution may split. Rounds are cut with
tables in the shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators.staging import stage_table


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One contraction of ``edges`` (u > v, distinct)."""
    if large:
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        out = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        low = edges.groupBy("u").agg(F.min("v").alias("m"))
        hang = edges.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        out = hang.unionByName(low.select("u", F.col("m").alias("v")))
    return out.filter("u <> v").distinct()


def connected_components(edges: DataFrame, a: str, b: str, name: str = "components") -> DataFrame:
    """(node, component): the smallest node reachable from every node that has
    an edge to another one. Null ends, loops and repeated edges change nothing;
    no edges give no rows."""
    x, y = F.col(a), F.col(b)
    edges = edges.filter(x.isNotNull() & y.isNotNull() & (x != y))
    edges = stage_table(edges.select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v")).distinct(), name)
    seen = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long")), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == seen or state[0] == 0:
            break
        seen = state
        edges = stage_table(_star(_star(edges, large=True), large=False), name)
    leaves = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return leaves.unionByName(roots)
