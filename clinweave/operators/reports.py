"""The scan report and the dataset manifest: small dictionaries from small aggregates."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinweave.config import SPLITS, SplitConfig
from clinweave.errors import DatasetPreparationError
from clinweave.functions.ids import DATASET
from clinweave.operators import dedup, quality, redaction, splits
from clinweave.operators.canonical import SCHEMA_VERSION, canonicalize, raw_documents, raw_pairs
from clinweave.plans.scratch import materialize

Provenance = tuple[str | None, str | None]


def _dataset(source: str, provenance: Provenance) -> dict:
    return {"name": DATASET, "source_root": source, "upstream_repository": provenance[0], "upstream_revision": provenance[1]}


def scan_report(files: DataFrame, pairs: DataFrame, source: str, provenance: Provenance = (None, None)) -> dict:
    """Counters and histograms of every collection, and their sums; the number of collections is small."""
    stats = {r.collection: r.asDict() for r in quality.collection_stats(files, pairs).collect()}
    for row in stats.values():
        del row["collection"]
    total = {c: sum(s[c] for s in stats.values()) for c in quality.COUNTERS}
    for name, rows, key, n in (
        ("question_types", quality.question_type_histogram(pairs), "question_type", "n_pairs"),
        ("categories", quality.category_histogram(files), "category", "n_files"),
    ):
        for s in stats.values():
            s[name] = {}
        for r in rows.collect():
            stats[r.collection][name][r[key]] = r[n]
    summary = total | {"collections_discovered": len(stats), "rejection_records": total["malformed_files"] + total["qa_pairs_rejected"]}
    return {"schema_version": "1.0", "generated_at": datetime.now(UTC).isoformat(), "dataset": _dataset(source, provenance), "summary": summary, "collections": stats}


@dataclass
class Prepared:
    """The prepared dataset; tables are written once and read back."""

    before: DataFrame
    records: DataFrame
    removals: DataFrame
    findings: DataFrame


def prepare(documents: DataFrame, config: SplitConfig | None = None, provenance: Provenance = (None, None)) -> Prepared:
    """Canonical, deduplicated records with component and split. Unresolved personal details or any leakage raise."""
    before = materialize(canonicalize(raw_pairs(documents), *provenance), "canonical")
    if redaction.pii_audit(before).first().unresolved:
        raise DatasetPreparationError("records with unresolved personal details")
    kept = materialize(dedup.keep_first(before), "kept")
    records = materialize(splits.assign(kept, config), "assigned")
    if splits.leakage_report(records).filter("overlap > 0").first():
        raise DatasetPreparationError("a document, record, content or question occurs in several splits")
    return Prepared(before, records, dedup.removals(before), redaction.pii_findings(before))


def manifest(prepared: Prepared, config: SplitConfig, n_files: int, source: str, provenance: Provenance = (None, None)) -> dict:
    """Versions, configuration, counts, audit and validation of a prepared dataset."""
    audit = redaction.pii_audit(prepared.before).first().asDict()
    final = redaction.pii_audit(prepared.records).first()
    counts = {r.split: r for r in splits.split_counts(prepared.records).collect()}
    by_collection: dict[str, dict[str, int]] = {s: {} for s in SPLITS}
    for r in splits.collection_counts(prepared.records).collect():
        by_collection[r.split][r.collection] = r.records
    totals = prepared.records.agg(F.count("*").alias("n"), F.countDistinct("document_id").alias("d"), F.countDistinct("component").alias("c")).first()
    summary = {
        "xml_files": n_files,
        "canonical_records_before_deduplication": audit["records_scanned"],
        "canonical_records": totals.n,
        "exact_duplicates_removed": audit["records_scanned"] - totals.n,
        "documents": totals.d,
        "split_components": totals.c,
        "pii_records_redacted_before_deduplication": audit["status_redacted"],
        "pii_records_redacted": final.status_redacted,
        "records_by_split": {s: counts[s].records for s in SPLITS},
        "documents_by_split": {s: counts[s].documents for s in SPLITS},
    }
    # The names that the manifest's contract has for the strategies.
    strategies = {
        "split_unit": "document_question_component",
        "assignment_strategy": "sha256_seeded_component_threshold",
        "question_normalization": "unicode_nfkc_casefold_whitespace_punctuation",
        "deduplication_strategy": "content_sha256_keep_first_by_source",
    }
    return {
        "schema_version": "1.0",
        "canonical_schema_version": SCHEMA_VERSION,
        "generated_at": datetime.now(UTC).isoformat(),
        "dataset": _dataset(source, provenance),
        "configuration": config.as_dict() | strategies,
        "summary": summary,
        "records_by_collection_and_split": by_collection,
        "pii_audit": audit | {"final_records_scanned": totals.n, "final_records_redacted": final.status_redacted},
        "validation": {f"{r.kind}_overlap": r.overlap for r in splits.leakage_report(prepared.records).collect()},
    }


def typed_files(documents: DataFrame) -> DataFrame:
    """Files for the scan counters from already parsed documents."""
    return raw_documents(documents).withColumn("parse_error", F.lit(None).cast("string"))
