"""Connected components of an undirected graph by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import drop_stored, materialize_at


def _state(e: DataFrame) -> tuple:
    r = e.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return r.n, r.x


def star_components(edges: DataFrame, a: str, b: str, rounds: list | None = None) -> DataFrame:
    """(node, component) for every node with an edge to another node; component is
    the smallest node reachable. Loops and null ends are ignored, repeated
    edges count once. ``rounds`` collects a mark per round.

    Large-star links each node's larger neighbours to its smallest neighbour,
    small-star its smaller ones; the two alternate until the edges no longer change,
    in a number of rounds logarithmic in the longest path. Minima and edges are
    joined from stored tables, so a hub's edges can be split over tasks;
    superseded tables are removed.
    """
    spark = edges.sparkSession
    e, at = materialize_at(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                           .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") > F.col("v"))).distinct(), "cc-edges")
    state = _state(e)
    while state[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low, low_at = materialize_at(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), "cc-large")
        big, big_at = materialize_at(both.where("v > u").join(low, on="u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                                     .distinct(), "cc-star")
        low2, low2_at = materialize_at(big.groupBy("u").agg(F.min("v").alias("m")), "cc-small")
        small = (big.join(low2, on="u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low2.withColumnRenamed("m", "v")).distinct())
        new, new_at = materialize_at(small, "cc-edges")
        drop_stored(spark, at, low_at, big_at, low2_at)
        e, at, last, state = new, new_at, state, _state(new)
        if rounds is not None:
            rounds.append(state)
        if state == last:
            break
    stars = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())
