"""Commands: scan, prepare, index, search, health.

Where a command has no option for it, the store and the embedding provider come from the environment: STORE_MODE,
STORE_PATH, STORE_COLLECTION, STORE_READ_ONLY, EMBEDDING_PROVIDER, EMBEDDING_DIMENSION and EMBEDDING_BATCH_SIZE.
"""

from __future__ import annotations

import argparse
import importlib
import json
import os
import sys
from collections.abc import Mapping
from dataclasses import replace

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from clinweave.config import SPLITS, EmbeddingSettings, SplitConfig, StoreSettings, positive
from clinweave.errors import ConfigurationError, DatasetPreparationError, EmbeddingError, KnowledgeIndexError, KnowledgeStoreError, ScanError

DOMAIN = (ScanError, DatasetPreparationError, ConfigurationError, EmbeddingError, KnowledgeStoreError, KnowledgeIndexError)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="clinweave")
    commands = p.add_subparsers(dest="command", required=True)
    for name in ("scan", "prepare"):
        c = commands.add_parser(name)
        c.add_argument("--source", required=True)
        c.add_argument("--output", required=True)
        if name == "prepare":
            for split, share in (("train", 0.8), ("validation", 0.1), ("test", 0.1)):
                c.add_argument(f"--{split}-ratio", type=float, default=share)
            c.add_argument("--seed", type=int, default=42)
    c = commands.add_parser("index", help="indexes a prepared dataset")
    c.add_argument("--prepared", required=True)
    c.add_argument("--split", choices=SPLITS, default="train")
    c.add_argument("--batch-size", type=positive)
    c.add_argument("--limit", type=positive)
    s = commands.add_parser("search")
    s.add_argument("query")
    s.add_argument("--limit", type=positive, default=5)
    h = commands.add_parser("health")
    for x in (c, s, h):
        x.add_argument("--store")
        x.add_argument("--collection")
        x.add_argument("--dimension", type=positive)
    return p


def settings(args: argparse.Namespace, env: Mapping[str, str]) -> tuple[StoreSettings, EmbeddingSettings]:
    """The environment's settings with the options that were given in their place."""

    def given(**options: object) -> dict:
        return {name: value for name, value in options.items() if value is not None}

    store = replace(StoreSettings.of(env), **given(path=args.store, collection=args.collection))
    if store.mode == "cloud":
        raise ConfigurationError("there is no client for a hosted store; give STORE_PATH as a folder that Spark can reach")
    return store, replace(EmbeddingSettings.of(env), **given(dimension=args.dimension, batch_size=getattr(args, "batch_size", None)))


def open_store(spark: SparkSession, store: StoreSettings, dimension: int):  # noqa: ANN201
    """The collection alone; no provider is loaded."""
    from clinweave.operators.collection import Collection

    return Collection(spark, store.path, store.collection, dimension, store.read_only)


def provider(chosen: EmbeddingSettings):  # noqa: ANN201
    """The embedding function that the settings name."""
    from clinweave.operators.embedding import hashing_embedder

    if chosen.provider == "hashing":
        return hashing_embedder(chosen.dimension)
    module, _, function = chosen.provider.partition(":")
    try:
        return getattr(importlib.import_module(module), function)(chosen.dimension)
    except (ImportError, AttributeError, ValueError) as e:
        raise ConfigurationError(f"EMBEDDING_PROVIDER names no function: {chosen.provider}") from e


def run(args: argparse.Namespace, env: Mapping[str, str] | None = None) -> dict | list:
    from clinweave.operators import canonical, chunking, collection, dedup, quality, reports
    from clinweave.plans.scratch import materialize
    from clinweave.session import local_session
    from clinweave.sinks.json_files import write_json, write_jsonl
    from clinweave.sources.medquad_xml import read_documents
    from clinweave.sources.provenance import read_provenance

    if args.command not in ("scan", "prepare"):
        store_settings, embedding = settings(args, os.environ if env is None else env)
    spark = local_session()
    if args.command == "scan":
        files = materialize(read_documents(spark, args.source).withColumn("file_id", F.xxhash64("relative_path")), "files")
        pairs = materialize(canonical.raw_pairs(files), "pairs")
        report = reports.scan_report(files, pairs, args.source, read_provenance(args.source))
        write_json(spark, f"{args.output}/report.json", report)
        write_jsonl(quality.rejections(files, pairs), f"{args.output}/rejected.jsonl", ["relative_path", "position"])
        return report["summary"]
    if args.command == "prepare":
        config = SplitConfig(args.train_ratio, args.validation_ratio, args.test_ratio, args.seed)
        files = materialize(read_documents(spark, args.source, strict=True).withColumn("file_id", F.xxhash64("relative_path")), "files")
        origin = read_provenance(args.source)
        done = reports.prepare(files, config, origin)
        final = reports.manifest(done, config, files.count(), args.source, origin)
        order = dedup.canonical_order()
        for name in ("canonical", *SPLITS):
            part = done.records if name == "canonical" else done.records.filter(F.col("split") == name)
            write_jsonl(part, f"{args.output}/{name}.jsonl", [order], leave_out=("file_id", "component", "split"))
        write_jsonl(done.removals, f"{args.output}/duplicates.jsonl", ["content_sha256", "dropped_record_id"])
        write_jsonl(done.findings, f"{args.output}/pii-audit.jsonl", ["source_relative_path", "upstream_pair_id", "record_id"])
        done.records.write.mode("overwrite").partitionBy("split").parquet(f"{args.output}/records.parquet")
        write_json(spark, f"{args.output}/manifest.json", final)
        return final["summary"]
    store = open_store(spark, store_settings, embedding.dimension)
    if args.command == "health":
        return {"status": "ok", "collection_records": store.count()}
    embed = provider(embedding)
    if args.command == "search":
        return [json.loads(r) for r in store.search(args.query, embed, args.limit).toJSON().collect()]
    records = spark.read.parquet(f"{args.prepared}/records.parquet").filter(F.col("split") == args.split)
    if args.limit:
        records = dedup.first_records(records, args.limit)
    return collection.index_chunks(chunking.chunk_records(records), store, embed, embedding.batch_size).first().asDict()


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    try:
        print(json.dumps(run(args), ensure_ascii=False, indent=2, sort_keys=True))
    except DOMAIN as e:
        print(e, file=sys.stderr)
        return 2
    return 0


if __name__ == "__main__":
    sys.exit(main())
