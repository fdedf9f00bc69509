"""Keeping a vector collection current from a stream of chunk files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.window import Window

from clinweave.operators.collection import Collection
from clinweave.operators.embedding import Embed, embed_texts


def stream_into(spark: SparkSession, folder: str, schema: T.StructType, collection: Collection, embed: Embed, checkpoint: str) -> StreamingQuery:
    """Reads parquet files as they arrive and upserts their chunks: record_id, text and an ``ingested_at`` timestamp.

    Within a batch the latest row of an id wins. A batch that is tried again writes the same rows, so restarts are safe.
    """

    def write(batch: DataFrame, _: int) -> None:
        order = Window.partitionBy("record_id").orderBy(F.desc("ingested_at"), F.desc("text"))
        latest = batch.filter("record_id is not null and trim(text) <> ''").withColumn("_n", F.row_number().over(order)).filter("_n = 1").drop("_n")
        collection.upsert(embed_texts(latest, "text", embed, collection.dimension))

    files = spark.readStream.schema(schema).parquet(folder)
    return files.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def late_aware_counts(events: DataFrame, delay: str = "1 day", window: str = "1 day") -> DataFrame:
    """Deliveries per collection and window of ``ingested_at``; later rows than ``delay`` are left out by the watermark."""
    return events.withWatermark("ingested_at", delay).groupBy(F.window("ingested_at", window), "collection").agg(F.count("*").alias("n_rows"))
