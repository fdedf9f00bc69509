"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: No more keys than this can be hot, whatever the input's size; so their table may be broadcast.
MOST_HOT_KEYS = 50_000
#: A key with fewer rows than this is never treated as hot.
LEAST_HOT_ROWS = 20_000


def hot_rows(total: int) -> int:
    """Rows above which a key counts as hot: at most ``total / hot_rows`` <= MOST_HOT_KEYS keys can pass it."""
    return max(LEAST_HOT_ROWS, -(-total // MOST_HOT_KEYS))


def join_by_key_stats(rows: DataFrame, stats: DataFrame, keys: list[str], n: str, total: int) -> DataFrame:
    """Inner join of ``rows`` with ``stats``, which has one row per key and the key's row count in ``n``.

    Hot keys are joined map-side through a broadcast whose row count is bounded by MOST_HOT_KEYS, so their rows
    are never gathered in one task; all other keys are shuffled. ``total`` is the row count of ``rows``.
    Null keys match nothing. Give materialized inputs: both are read twice.
    """
    limit = hot_rows(total)
    if total <= limit:
        return rows.join(stats, keys)
    hot = F.broadcast(stats.filter(F.col(n) > limit))
    cold = stats.filter(F.col(n) <= limit)
    rest = rows.join(F.broadcast(stats.filter(F.col(n) > limit).select(*keys)), keys, "left_anti")
    return rows.join(hot, keys).unionByName(rest.join(cold, keys))


def join_in_blocks(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join of two materialized tables in which a key may have many rows on both sides.

    Where one side has more rows of a key than ``hot_rows`` allows, both sides of that key are cut into blocks of that
    size, and each pair of blocks meets in a task of its own. Other columns of the two tables have different names.
    """
    def counted(rows: DataFrame, n: str) -> DataFrame:
        return rows.groupBy(*keys).agg(F.count("*").alias(n))

    limit = max(hot_rows(left.count()), hot_rows(right.count()))
    hot = counted(left, "_nl").join(counted(right, "_nr"), keys).filter((F.col("_nl") > limit) | (F.col("_nr") > limit))
    hot = [r.asDict() for r in hot.collect()]  # at most MOST_HOT_KEYS on either side
    if not hot:
        return left.join(right, keys)
    types = ", ".join(f"`{k}` {left.schema[k].dataType.simpleString()}" for k in keys)
    sized = F.broadcast(left.sparkSession.createDataFrame([(*[r[k] for k in keys], -(-r["_nl"] // limit), -(-r["_nr"] // limit)) for r in hot], f"{types}, _bl long, _br long"))

    def blocks(rows: DataFrame, own: str, other: str) -> DataFrame:
        place = F.pmod(F.xxhash64(*rows.columns), F.col(own)).alias(f"{own}_at")
        return rows.join(sized, keys).select(*rows.columns, place, F.explode(F.sequence(F.lit(0).cast("long"), F.col(other) - 1)).alias(f"{other}_at"))

    met = blocks(left, "_bl", "_br").join(blocks(right, "_br", "_bl"), [*keys, "_bl_at", "_br_at"]).drop("_bl_at", "_br_at")
    rest = left.join(sized.select(*keys), keys, "left_anti").join(right, keys)
    return met.unionByName(rest)
