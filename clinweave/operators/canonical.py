"""From raw documents with nested pairs to canonical records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinweave.functions.ids import DATASET, document_id, record_id
from clinweave.functions.text import content_hash, normalize_text, null_if_empty
from clinweave.operators.redaction import detected_types, redact, redact_columns

#: Fixed values of the record contract.
SCHEMA_VERSION, LANGUAGE, LICENSE = "1.1", "en", "CC-BY-4.0"
LISTS = ("synonyms", "umls_cuis", "umls_semantic_types", "umls_semantic_groups")


def collection_of(path: Column) -> Column:
    """The first folder of a relative path; ``root`` for a file without one."""
    return F.when(F.instr(path, "/") > 0, F.substring_index(path, "/", 1)).otherwise("root")


def unique_texts(values: Column) -> Column:
    """Normalised elements in first-seen order, without blanks and repetitions; null becomes []."""
    cleaned = F.transform(F.coalesce(values, F.array().cast("array<string>")), normalize_text)
    return F.array_distinct(F.filter(cleaned, lambda v: v != ""))


def raw_documents(documents: DataFrame) -> DataFrame:
    """Delivered documents with normalised texts; blank optional texts become null."""
    texts = {c: null_if_empty(normalize_text(F.col(c))) for c in ("document_id", "publisher", "source_url", "focus", "category")}
    return documents.withColumns(texts | {c: unique_texts(F.col(c)) for c in LISTS} | {"collection": collection_of(F.col("relative_path"))})


def raw_pairs(documents: DataFrame) -> DataFrame:
    """One row per pair with its 1-based position; null and invalid pairs count too. Documents without pairs give none."""
    rows = raw_documents(documents).select("*", F.posexplode("pairs").alias("_at", "_pair")).drop("pairs")
    optional = {c: null_if_empty(normalize_text(F.col(f"_pair.{c}"))) for c in ("pair_id", "question_id", "question_type")}
    texts = {c: normalize_text(F.col(f"_pair.{c}")) for c in ("question", "answer")}
    return rows.withColumns({"position": (F.col("_at") + 1).cast("long")} | optional | texts).drop("_at", "_pair")


def accepted(pairs: DataFrame) -> DataFrame:
    return pairs.filter("question <> '' and answer <> ''")


def canonicalize(pairs: DataFrame, repository: str | None = None, revision: str | None = None) -> DataFrame:
    """Canonical records of the accepted pairs, redacted before hashing. ``file_id`` is kept as the last order key."""
    rows = redact_columns(accepted(pairs), ["focus", "question", "answer"])
    # each synonym beside its redaction, so that the rules stand in the plan once
    rows = rows.select("*", F.transform("synonyms", lambda s: F.struct(s.alias("s"), redact(s).alias("r"))).alias("_synonyms"))
    types = F.flatten(F.transform("_synonyms", lambda x: detected_types(x["s"], x["r"])))
    found = F.array_distinct(F.concat("focus_types", "question_types", "answer_types", types))
    rows = rows.withColumns({"synonyms": F.col("_synonyms.r"), "pii_types": found})
    some = F.size("pii_types") > 0
    path = F.col("relative_path")
    return rows.select(
        "file_id",
        F.lit(SCHEMA_VERSION).alias("schema_version"),
        record_id(path, F.col("position"), F.col("pair_id"), F.col("question_id")).alias("record_id"),
        document_id(path).alias("document_id"),
        content_hash(F.col("question"), F.col("answer")).alias("content_sha256"),
        F.lit(LANGUAGE).alias("language"),
        "focus", "category", "question_type", "question", "answer", *LISTS,
        F.struct(
            F.lit(DATASET).alias("dataset"), "collection", "relative_path", F.lit(repository).cast("string").alias("upstream_repository"), F.lit(revision).cast("string").alias("upstream_revision"),
            F.col("document_id").alias("upstream_document_id"), F.col("pair_id").alias("upstream_pair_id"), F.col("question_id").alias("upstream_question_id"), "publisher",
            F.col("source_url").alias("url"), F.lit(LICENSE).alias("license"),
        ).alias("source"),
        F.struct(
            F.lit("accepted").alias("status"), F.when(some, "redacted").otherwise("not_detected").alias("pii_status"), "pii_types",
            F.when(some, F.array(F.lit("whitespace_normalized"), F.lit("pii_redacted"))).otherwise(F.array(F.lit("whitespace_normalized"))).alias("transformations"),
            F.array().cast("array<string>").alias("quality_flags"),
        ).alias("curation"),
    )


def index_text(focus: Column, question: Column, answer: Column) -> Column:
    """The text that is indexed: topic (if any), question and answer on lines of their own."""
    topic = F.when(focus != "", F.concat(F.lit("Medical topic: "), focus))
    return F.concat_ws("\n", topic, F.concat(F.lit("Question: "), question), F.concat(F.lit("Answer: "), answer))


def base_metadata(split: Column) -> Column:
    """Flat metadata of a record; fields that are null are absent."""
    own = ["schema_version", "document_id", "content_sha256", "language", "focus", "category", "question_type"]
    return F.struct(*own, "source.dataset", "source.collection", "source.relative_path", "source.upstream_revision", "source.publisher", F.col("source.url").alias("source_url"), "source.license", split.alias("split"))


def constraint_violations(records: DataFrame) -> DataFrame:
    """(rule, n_violations) of the record contract, for every rule; null counts as a violation where a value is required."""
    uuid = r"^[0-9a-f]{8}-[0-9a-f]{4}-5[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$"
    n_types = F.size(F.coalesce("curation.pii_types", F.array().cast("array<string>")))
    status = F.col("curation.pii_status")
    rules = {
        "redacted_has_types": (status != "redacted") | (n_types > 0),
        "not_detected_has_no_types": (status != "not_detected") | (n_types == 0),
        "question_not_blank": normalize_text(F.col("question")) != "",
        "answer_not_blank": normalize_text(F.col("answer")) != "",
        "schema_version": F.col("schema_version") == SCHEMA_VERSION,
        "language": F.col("language") == LANGUAGE,
        "dataset": F.col("source.dataset") == DATASET,
        "license": F.col("source.license") == LICENSE,
        "status": F.col("curation.status") == "accepted",
        "record_id_format": F.col("record_id").rlike(uuid),
        "document_id_format": F.col("document_id").rlike(uuid),
        "content_sha256_format": F.col("content_sha256").rlike("^[0-9a-f]{64}$"),
        **{f"{c}_unique": F.size(F.array_distinct(c)) == F.size(c) for c in LISTS},
        **{f"{c}_no_blanks": F.forall(c, lambda v: F.length(v) > 0) for c in LISTS},
    }
    counts = records.agg(*[F.count_if(~F.coalesce(ok, F.lit(False))).alias(name) for name, ok in rules.items()])
    return counts.select(F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.col(n).alias("n_violations")) for n in rules])).alias("r")).select("r.*")
