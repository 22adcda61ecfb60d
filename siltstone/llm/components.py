"""Connected components of a graph given as an edge table, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.session import written

MAX_ROUNDS = 100


def _min_of_neighbours(pairs: DataFrame) -> DataFrame:
    """(u, v) pairs with the least v of each u beside them, as (u, v, m).

    The minimum is combined before its shuffle, and the join back to the pairs has one row per key on
    one side, so that adaptive execution can split a hub's rows.
    """
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    return pairs.join(least, "u")


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node on the least of the node and its neighbours."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    seen = _min_of_neighbours(both).select("u", "v", F.least("m", "u").alias("m"))
    return seen.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours on the least of them. Edges point from large to small."""
    seen = _min_of_neighbours(edges)
    hung = seen.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.union(seen.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame, first: str, second: str) -> DataFrame:
    """(node, component) of every node that has an edge to another; component is its least node.

    Alternates large-star and small-star steps until no edge changes, which takes a number of rounds that
    grows with the logarithm of the longest path. Each round is written to the shared folder, so lineage
    stays short and a lost executor costs one round. Edges with a NULL end and loops are ignored; repeated
    edges count once; no edge gives no row.
    """
    a, b = F.col(first), F.col(second)
    links = (
        edges.where(a.isNotNull() & b.isNotNull() & (a != b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct()
    )
    state = written(links, "components")
    mark = _fingerprint(state)
    for _ in range(MAX_ROUNDS):
        if not mark[0]:
            break
        state = written(_small_star(_large_star(state)), "components")
        now = _fingerprint(state)
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    roots = state.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return state.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)


def _fingerprint(edges: DataFrame) -> tuple:
    """Count and order-free digest of the edges: equal for two rounds only if nothing changed."""
    row = edges.agg(
        F.count("*"),
        F.bit_xor(F.xxhash64("u", "v")),
        F.sum(F.pmod(F.xxhash64("v", "u"), F.lit(1 << 31))),
    ).first()
    return tuple(row)
