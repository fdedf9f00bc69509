"""Exact duplicates: the first record in canonical order is kept, with a trace of what was dropped."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinweave.plans.scratch import materialize
from clinweave.plans.skew import join_by_key_stats


def canonical_order() -> Column:
    """Path, question id, pair id, record id, compared as strings; the file's number decides last."""
    blank = F.lit("")
    return F.struct(
        F.coalesce("source.relative_path", blank).alias("a"), F.coalesce("source.upstream_question_id", blank).alias("b"), F.coalesce("source.upstream_pair_id", blank).alias("c"),
        F.col("record_id").alias("d"), F.col("file_id").alias("e"),
    )


def _with_first(records: DataFrame) -> DataFrame:
    """Each record with the order key and ids of the first one of its content. Hot contents are never sorted in one task."""
    rows = records.withColumn("_order", canonical_order())
    firsts = rows.groupBy("content_sha256").agg(
        F.min(F.struct(F.col("_order").alias("o"), F.col("record_id").alias("r"), F.col("document_id").alias("d"))).alias("_first"), F.count("*").alias("_n")
    )
    return join_by_key_stats(rows, materialize(firsts, "first-of-content"), ["content_sha256"], "_n", rows.count()).drop("_n")


def keep_first(records: DataFrame) -> DataFrame:
    """One record per content hash: the first in canonical order. Ties in every key keep one row.

    One shuffle: each task keeps the first row of each of its contents, so a hot content sends a row a task.
    """
    first = records.groupBy(F.col("content_sha256").alias("_content")).agg(F.min_by(F.struct(*[F.col(f"`{c}`") for c in records.columns]), canonical_order()).alias("_row"))
    return first.select("_row.*")


def removals(records: DataFrame) -> DataFrame:
    """Each dropped record with the ids of the one that was kept."""
    dropped = _with_first(records).filter(F.col("_order") != F.col("_first.o"))
    return dropped.select(
        "content_sha256", F.col("_first.r").alias("kept_record_id"), F.col("_first.d").alias("kept_document_id"),
        F.col("record_id").alias("dropped_record_id"), F.col("document_id").alias("dropped_document_id"),
    )


def first_records(records: DataFrame, limit: int) -> DataFrame:
    """The first ``limit`` records in canonical order."""
    return records.orderBy(canonical_order()).limit(limit)
