"""Connected components by alternating large-star and small-star rounds.

Each round is two grouped minima joined back to the edges, so a hub with very
many links is combined map-side and its join can be split by adaptive
execution. Once every node has one link to a smaller node at most, a round is
one join that doubles these pointers, and rounds end when no pointer leads to
another. Every round is checkpointed, its shuffle files go; only two flags per round reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nightledger.llm.common import checkpointed, released


def _edges(*ends: tuple[str, str]):
    """A row (u, v) for each of ``ends`` of a row."""
    return F.inline(F.array(*[F.struct(F.col(u).alias("u"), F.col(v).alias("v")) for u, v in ends]))


def _star(edges: DataFrame) -> DataFrame:
    """(u, v) with v among u's neighbours -> every u with the least of them and itself."""
    return edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))


def _large(edges: DataFrame) -> DataFrame:
    both = edges.select(_edges(("u", "v"), ("v", "u")))
    return both.join(_star(both), "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small(edges: DataFrame) -> DataFrame:
    """Edges have the larger end first."""
    return edges.join(_star(edges), "u").select(_edges(("v", "m"), ("u", "m"))).where(F.col("u") != F.col("v")).distinct()


def _doubled(edges: DataFrame) -> DataFrame:
    """One edge a node: it leads to where the edge of its end leads."""
    then = edges.select(F.col("u").alias("v"), F.col("v").alias("w"))
    return edges.join(then, "v", "left").select("u", F.coalesce("w", "v").alias("v"))


def _shape(edges: DataFrame) -> tuple[bool, bool]:
    """Whether a node has edges to several smaller ones, and whether the end of an edge has an edge to a smaller one."""
    ends = edges.select(F.inline(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("up")), F.struct(F.col("v").alias("node"), F.lit(0).alias("up")))))
    each = ends.groupBy("node").agg(F.sum("up").alias("ups"), F.min("up").alias("least"))
    with released(edges.sparkSession):
        several, deep = each.agg(F.max(F.col("ups") > 1), F.max((F.col("ups") > 0) & (F.col("least") == 0))).first()
    return bool(several), bool(deep)


def components(edges: DataFrame) -> DataFrame:
    """(u, v) links of long ids -> (node, component) for every node with a link.

    ``component`` is the least node reachable. Loops and repeated links are
    ignored; no links give an empty result.
    """
    e = checkpointed(edges.where(F.col("u") != F.col("v"))
                     .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    while True:
        several, deep = _shape(e)
        if not several and not deep:
            break
        e = checkpointed(_small(_large(e)) if several else _doubled(e))
    return (e.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .union(e.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct())


def joined(part: DataFrame, links: DataFrame) -> DataFrame:
    """``part`` (node, component) with further ``links`` (u, v): components of components, then one join."""
    if links.isEmpty():
        return part
    ends = checkpointed(links.select(F.explode(F.array("u", "v")).alias("node")).distinct().join(part, "node", "left")
                        .select("node", F.coalesce("component", "node").alias("component"), F.col("component").isNull().alias("alone")))
    edges = (links.join(ends.select(F.col("node").alias("u"), F.col("component").alias("a")), "u")
             .join(ends.select(F.col("node").alias("v"), F.col("component").alias("b")), "v")
             .select(F.col("a").alias("u"), F.col("b").alias("v")))
    roots = components(edges).select(F.col("node").alias("component"), F.col("component").alias("root"))
    alone = ends.where("alone").select("node", "component")
    return checkpointed(part.unionByName(alone).join(roots, "component", "left")
                        .select("node", F.coalesce("root", "component").alias("component")))
