"""Splits by component: documents that share a question stay together."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinweave.config import SPLITS, SplitConfig
from clinweave.functions.ids import split_name, split_position
from clinweave.functions.text import normalized_question
from clinweave.operators.components import connected_components
from clinweave.plans.scratch import materialize
from clinweave.plans.skew import join_by_key_stats


def document_components(records: DataFrame) -> DataFrame:
    """(document_id, component) of every document: linked by a common normalised question; the component is the least document_id.

    Give deduplicated records. Documents without a shared question are their own component.
    """
    asked = records.select("document_id", normalized_question(F.col("question")).alias("q")).distinct()
    asked = materialize(asked, "asked")
    hubs = materialize(asked.groupBy("q").agg(F.min("document_id").alias("a"), F.count("*").alias("n")).filter("n > 1"), "question-hubs")
    links = join_by_key_stats(asked, hubs, ["q"], "n", asked.count()).select("a", F.col("document_id").alias("b"))
    found = connected_components(links).withColumnRenamed("node", "document_id")
    documents = asked.select("document_id").distinct()
    return documents.join(found, "document_id", "left").select("document_id", F.coalesce("component", "document_id").alias("component"))


def assign(records: DataFrame, config: SplitConfig | None = None) -> DataFrame:
    """Adds ``component`` and ``split`` to deduplicated records."""
    config = config or SplitConfig()
    homes = document_components(records)
    homes = homes.withColumn("split", split_name(split_position(F.col("component"), config.seed), config))
    sized = materialize(homes.join(records.groupBy("document_id").agg(F.count("*").alias("_n")), "document_id"), "homes")
    return join_by_key_stats(records, sized, ["document_id"], "_n", records.count()).drop("_n")


def split_counts(assigned: DataFrame) -> DataFrame:
    """Records and documents per split, always all three."""
    names = assigned.sparkSession.createDataFrame([(s,) for s in SPLITS], "split string")
    found = assigned.groupBy("split").agg(F.count("*").alias("records"), F.countDistinct("document_id").alias("documents"))
    return names.join(found, "split", "left").select("split", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("records", "documents")])


def collection_counts(assigned: DataFrame) -> DataFrame:
    return assigned.groupBy("split", F.col("source.collection").alias("collection")).agg(F.count("*").alias("records"))


def leakage_report(assigned: DataFrame) -> DataFrame:
    """(kind, overlap): distinct documents, records, contents and questions that occur in two splits or more."""
    values = {"document_id": F.col("document_id"), "record_id": F.col("record_id"), "content_sha256": F.col("content_sha256"), "normalized_question": normalized_question(F.col("question"))}
    rows = assigned.select("split", F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), v.alias("value")) for k, v in values.items()])).alias("x"))
    # the least and greatest split of a value are combined before the shuffle, so a hot value costs one row a task
    spread = rows.groupBy("x.kind", "x.value").agg(F.min("split").alias("lo"), F.max("split").alias("hi"))
    return spread.groupBy("kind").agg(F.count_if(F.col("lo") < F.col("hi")).alias("overlap"))
