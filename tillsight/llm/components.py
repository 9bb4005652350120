"""Connected components of an edge table, by alternating stars.

Each round points every node at the smallest node it can see, in two steps that never make more
edges than there were. Minima are aggregated before they are joined back, so a node with a third of
all edges is one row of partial sums per task. Rounds are written to the shared folder, so lineage
stays short and a lost executor re-reads files; the write itself tells how many edges there are and
whether any has changed. Minima of few enough edges are broadcast, so the edges are not shuffled to them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tillsight.workspace import Workspace

# A table of minima has at most two rows per edge, of two longs.
BROADCAST_EDGES = 1 << 18


def _least(pairs: DataFrame, few: bool) -> DataFrame:
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    return F.broadcast(least) if few else least


def _large_star(edges: DataFrame, few: bool) -> DataFrame:
    """Every larger neighbour of a node is joined to the smallest of its neighbours and itself."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    joined = both.where("v > u").join(_least(both, few), "u")
    return joined.select(F.col("v").alias("u"), F.least("u", "m").alias("v"))


def _small_star(edges: DataFrame, few: bool) -> DataFrame:
    """Every node and its smaller neighbours are joined to the smallest of these."""
    rest = edges.join(_least(edges, few), "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = edges.groupBy("u").agg(F.min("v").alias("v"))
    return rest.union(own).where("u != v").distinct()


def _saved(edges: DataFrame, name: str, ws: Workspace) -> tuple[DataFrame, dict]:
    """Edges written, and what changes when they do."""
    seen = Observation()
    marks = [
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("one"),
        F.sum(F.xxhash64("v", "u").bitwiseXOR(F.xxhash64("u")).cast("decimal(38,0)")).alias("two"),
    ]
    written = ws.save(edges.observe(seen, *marks), name)
    return written, seen.get


def components(edges: DataFrame, ws: Workspace) -> DataFrame:
    """(node, root) of every node that has an edge (a, b) to another; the root is the smallest node."""
    edges = edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges, mark = _saved(edges.distinct(), "edges", ws)
    while mark.get("rows"):
        few = mark["rows"] <= BROADCAST_EDGES
        edges, now = _saved(_small_star(_large_star(edges, few), few), "stars", ws)
        if now == mark:
            break
        mark = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
