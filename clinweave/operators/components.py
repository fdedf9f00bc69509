"""Connected components by alternating large-star and small-star rounds, as joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinweave.plans.scratch import materialize, release
from clinweave.plans.skew import hot_rows, join_by_key_stats


def _star(edges: DataFrame, total: int, large: bool) -> DataFrame:
    """``edges`` (u, v) with u > v. Large-star links larger neighbours to the least neighbour, small-star smaller ones."""
    around = edges.select("u", "v")
    if large:
        around = around.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    large_input = 2 * total > hot_rows(2 * total)  # only then are both sides read twice
    around = materialize(around, "star") if large_input else around
    least = around.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).withColumn("m", F.least("m", "u"))
    told = join_by_key_stats(around, materialize(least, "star-least") if large_input else least, ["u"], "n", 2 * total)
    if large:
        new = told.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        new = told.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(told.select("u", F.col("m").alias("v")))
    return new.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def connected_components(links: DataFrame, most_rounds: int = 40) -> DataFrame:
    """(node, component) of every node of ``links`` (a, b); the component is its least node. Null ends and self-links are ignored."""
    edges = links.filter("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = materialize(edges, "edges")

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    before = state(edges)
    for _ in range(most_rounds):
        half = materialize(_star(edges, before[0], True), "edges")
        release(edges)
        edges = materialize(_star(half, before[0], False), "edges")
        release(half)
        after = state(edges)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
