"""The quality scan: counters, histograms, duplicates and rejections of raw documents and pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinweave.functions.text import null_if_empty, scan_fingerprint
from clinweave.operators.canonical import accepted

COUNTERS = (
    "xml_files_discovered", "xml_files_parsed", "malformed_files", "qa_pairs_total", "qa_pairs_accepted", "qa_pairs_rejected",
    "missing_question", "missing_answer", "duplicate_question_occurrences", "duplicate_pair_occurrences",
)


def _firsts(pairs: DataFrame, *texts: str) -> DataFrame:
    """Collections of the first occurrence of each fingerprint, in the order of path, file and position."""
    key = scan_fingerprint(*[F.col(t) for t in texts])
    first = F.min(F.struct("relative_path", "file_id", "position", "collection"))
    return pairs.groupBy(key.alias("fp")).agg(first.alias("f")).groupBy(F.col("f.collection").alias("collection")).agg(F.count("*").alias("n"))


def collection_stats(files: DataFrame, pairs: DataFrame) -> DataFrame:
    """The ten counters per collection.

    ``files`` has collection and parse_error (null for a parsed file). Repeated occurrences are the accepted pairs
    less the first ones, so no window over a hot question is needed.
    """
    good = accepted(pairs)
    by_file = files.groupBy("collection").agg(
        F.count("*").alias("xml_files_discovered"), F.count_if(F.col("parse_error").isNull()).alias("xml_files_parsed"), F.count_if(F.col("parse_error").isNotNull()).alias("malformed_files")
    )
    no_q, no_a = F.col("question") == "", F.col("answer") == ""
    by_pair = pairs.groupBy("collection").agg(
        F.count("*").alias("qa_pairs_total"), F.count_if(~no_q & ~no_a).alias("qa_pairs_accepted"), F.count_if(no_q | no_a).alias("qa_pairs_rejected"),
        F.count_if(no_q).alias("missing_question"), F.count_if(no_a).alias("missing_answer"),
    )
    first_q = _firsts(good, "question").withColumnRenamed("n", "_q")
    first_p = _firsts(good, "question", "answer").withColumnRenamed("n", "_p")
    rows = by_file.join(by_pair, "collection", "full").join(first_q, "collection", "left").join(first_p, "collection", "left")
    repeated = {f"duplicate_{k}_occurrences": F.col("qa_pairs_accepted") - F.coalesce(c, F.lit(0)) for k, c in (("question", "_q"), ("pair", "_p"))}
    return rows.withColumns(repeated).select("collection", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in COUNTERS])


def summary(stats: DataFrame) -> DataFrame:
    """Counters per collection and, under ``(all)``, their sums; one pass."""
    return stats.rollup("collection").agg(*[F.sum(c).alias(c) for c in COUNTERS]).withColumn("collection", F.coalesce("collection", F.lit("(all)")))


def question_type_histogram(pairs: DataFrame) -> DataFrame:
    """Accepted pairs per collection and question type; ``unknown`` for none."""
    return accepted(pairs).groupBy("collection", F.coalesce("question_type", F.lit("unknown")).alias("question_type")).agg(F.count("*").alias("n_pairs"))


def category_histogram(files: DataFrame) -> DataFrame:
    """Parsed files per collection and category; ``unknown`` for none."""
    return files.filter("parse_error is null").groupBy("collection", F.coalesce("category", F.lit("unknown")).alias("category")).agg(F.count("*").alias("n_files"))


def rejections(files: DataFrame, pairs: DataFrame) -> DataFrame:
    """Rejected files and pairs with their reasons; a pair can have both reasons and is still one row."""
    none = F.lit(None).cast("string")
    by_file = files.filter("parse_error is not null").select(
        F.lit("file").alias("record_type"), "file_id", F.lit(0).cast("long").alias("position"), "relative_path", "collection", none.alias("document_id"), none.alias("question_id"),
        none.alias("pair_id"), none.alias("question"), F.array(F.lit("malformed_xml")).alias("reasons"), F.col("parse_error").alias("error"),
    )
    reasons = F.array_compact(F.array(F.when(F.col("question") == "", "missing_question"), F.when(F.col("answer") == "", "missing_answer")))
    by_pair = pairs.select(
        F.lit("qa_pair").alias("record_type"), "file_id", "position", "relative_path", "collection", "document_id", "question_id", "pair_id",
        null_if_empty(F.col("question")).alias("question"), reasons.alias("reasons"), none.alias("error"),
    ).filter(F.size("reasons") > 0)
    return by_file.unionByName(by_pair)
