"""Connected components of a link table, as alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coverledger.llm.common import cut


def _least(edges: DataFrame) -> DataFrame:
    """The smallest partner of each node, stored: both sides of the join that follows are then
    plain shuffles, whose large keys Spark can split."""
    return cut(edges.groupBy("u").agg(F.min("v").alias("least")), "least")


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the node's smallest neighbour or itself."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    root = F.least("u", "least")
    return (
        both.join(_least(both), "u")
        .filter(F.col("v") > F.col("u"))
        .select(F.col("v").alias("u"), root.alias("v"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node's smaller neighbours, and the node, to the smallest of them."""
    joined = edges.join(_least(edges), "u")
    node = F.when(F.col("v") == F.col("least"), F.col("u")).otherwise(F.col("v"))
    return joined.select(node.alias("u"), F.col("least").alias("v")).distinct()


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return row["n"], row["x"]


def connected_components(links: DataFrame) -> DataFrame:
    """``links`` has node pairs ``a``, ``b`` of one orderable type; returns ``node``, ``root``.

    ``root`` is the smallest node reachable. Only nodes with a link to another node are returned;
    links of a node to itself and repeats count for nothing, pairs with a null are skipped.
    Alternating large-star and small-star steps (Kiveris et al., 2014) keep the number of links
    from growing and end after a logarithmic number of rounds; each is cut from its lineage.
    """
    edges = cut(
        links.filter(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "links",
    )
    state = _state(edges)
    while state[0]:
        edges = cut(_small_star(cut(_large_star(edges), "large")), "links")
        before, state = state, _state(edges)
        if before == state:
            break
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
