"""A vector collection kept as versioned parquet, with upsert, count and exact nearest neighbours."""

from __future__ import annotations

import json
import time
from collections.abc import Iterator
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from clinweave.errors import KnowledgeIndexError, KnowledgeStoreError
from clinweave.functions.vectors import cosine_distance
from clinweave.operators.embedding import Embed, checked
from clinweave.plans.scratch import materialize, release

#: Queries and vectors that are compared at once, in one task.
QUERY_BLOCK = 10_000
VECTOR_BLOCK = 50_000


def upserted(existing: DataFrame, new: DataFrame, key: str = "record_id") -> DataFrame:
    """``existing`` with rows of ``new`` replacing those of the same id. Ids in ``new`` are unique, as in a batch."""
    return existing.join(new.select(key), key, "left_anti").unionByName(new)


def top_k(queries: DataFrame, vectors: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` nearest vectors of each query by cosine distance: query_id, vec_id, distance, rank; ties go by id.

    ``queries`` has query_id and embedding, ``vectors`` vec_id and embedding. Exact: queries and vectors are numbered
    into blocks of about QUERY_BLOCK and VECTOR_BLOCK, and each pair of blocks meets in one task, which compares them by
    matrix products and keeps k per query. The best k of all blocks are chosen by rank, cut to k before the shuffle.
    Zero vectors and null embeddings have no distance and are left out; distances are rounded to six digits.
    """
    spark = queries.sparkSession
    across = max(1, -(-queries.count() // QUERY_BLOCK))
    down = max(spark.sparkContext.defaultParallelism, -(-vectors.count() // VECTOR_BLOCK))

    def blocked(rows: DataFrame, key: str, own: str, n: int, other: str, others: int) -> DataFrame:
        kept = rows.filter("embedding is not null").select(F.col(key).cast("long").alias("id"), F.col("embedding").cast("array<double>").alias("embedding"), F.pmod(F.xxhash64(key), F.lit(n)).alias(own))
        return kept.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(others - 1))))

    left = blocked(queries, "query_id", "across", across, "down", down).groupBy("across", "down")
    right = blocked(vectors, "vec_id", "down", down, "across", across).groupBy("across", "down")

    def nearest(asked: pa.Table, held: pa.Table) -> pa.Table:
        return _nearest(asked, held, k)

    near = left.cogroup(right).applyInArrow(nearest, "query_id long, vec_id long, distance double")
    order = Window.partitionBy("query_id").orderBy("distance", "vec_id")
    return near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "vec_id", "distance", "rank")


def _units(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Ids and unit vectors of a block in the order of ids, without zero vectors."""
    ids = table.column("id").to_numpy()
    values = table.column("embedding").combine_chunks()
    v = np.asarray(values.flatten() if isinstance(values, pa.ListArray) else [], np.float64).reshape(len(ids), -1)
    norms = np.linalg.norm(v, axis=1)
    order = np.argsort(ids, kind="stable")
    order = order[norms[order] > 0]
    return ids[order], v[order] / norms[order, None]


def _nearest(asked: pa.Table, held: pa.Table, k: int) -> pa.Table:
    """The best k of a block of vectors for each query of a block, by distance to six digits, then id."""
    found: list[list[np.ndarray]] = [[np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]]
    if len(asked) and len(held):
        (q_ids, q), (own, v) = _units(asked), _units(held)
        take = min(k, len(own))
        for s in range(0, len(q_ids) if take else 0, 256):
            micro = np.rint((1.0 - q[s : s + 256] @ v.T) * 1e6).astype(np.int64)
            best = np.argpartition(micro * len(own) + np.arange(len(own)), take - 1, axis=1)[:, :take]
            for column, x in zip(found, (np.repeat(q_ids[s : s + 256], take), own[best.ravel()], np.take_along_axis(micro, best, 1).ravel() / 1e6), strict=True):
                column.append(x)
    return pa.table([pa.array(np.concatenate(x)) for x in found], names=["query_id", "vec_id", "distance"])


class VectorStore(Protocol):
    """What indexing and searching need of a store."""

    dimension: int

    def upsert(self, rows: DataFrame) -> None: ...

    def count(self) -> int: ...

    def search(self, query: str, embed: Embed, k: int = 5) -> DataFrame: ...


class Collection:
    """A named collection under a folder: rows in BUCKETS buckets by a hash of their id, and numbered manifests.

    A manifest names the folder of each bucket. An upsert writes the buckets that it touches to a new folder and then
    publishes the next manifest under its final name; the one with the greatest number holds. So readers see the old
    rows or the new ones, also if a writer ends halfway, and a second writer with the same number fails.
    """

    BUCKETS = 64

    def __init__(self, spark: SparkSession, folder: str, name: str, dimension: int, read_only: bool = False) -> None:
        self.spark, self.root, self.dimension, self.read_only = spark, f"{folder.rstrip('/')}/{name}", dimension, read_only
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _manifest(self) -> dict | None:
        folder = self._path(f"{self.root}/manifests")
        numbers = [f.getPath().getName() for f in self._fs.listStatus(folder)] if self._fs.exists(folder) else []
        numbers = sorted(n for n in numbers if n.endswith(".json"))
        if not numbers:
            return None
        found = json.loads(self.spark.read.text(f"{self.root}/manifests/{numbers[-1]}", wholetext=True).first().value)
        if found["dimension"] != self.dimension:
            raise KnowledgeStoreError(f"the collection has vectors of {found['dimension']} dimensions")
        return found

    def _publish(self, manifest: dict) -> None:
        number = f"{manifest['number']:012d}"
        temporary = self._path(f"{self.root}/.{number}-{time.time_ns()}")
        out = self._fs.create(temporary, False)
        out.write(bytearray(json.dumps(manifest, sort_keys=True).encode()))
        out.close()
        self._fs.mkdirs(self._path(f"{self.root}/manifests"))
        final = self._path(f"{self.root}/manifests/{number}.json")
        if self._fs.exists(final) or not self._fs.rename(temporary, final):
            raise KnowledgeStoreError("another writer published first")

    def _rows(self, manifest: dict, buckets: set[int] | None = None) -> DataFrame | None:
        paths = [path for bucket, path in sorted(manifest["buckets"].items()) if buckets is None or int(bucket) in buckets]
        if not paths:
            return None
        try:
            rows = self.spark.read.parquet(*[f"{self.root}/{p}" for p in paths])
        except AnalysisException as e:
            raise KnowledgeStoreError("the collection cannot be read") from e
        types = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
        if types.get("record_id") != "string" or types.get("text") != "string" or not types.get("embedding", "").startswith("array<"):
            raise KnowledgeStoreError("the collection's rows have other columns than record_id, text and embedding")
        return rows

    def read(self) -> DataFrame | None:
        """The rows, or None before the first write."""
        manifest = self._manifest()
        return None if manifest is None else self._rows(manifest)

    def upsert(self, rows: DataFrame) -> None:
        """Replaces rows of the same record_id and adds the others; rows are computed once. No rows change nothing. Ids are unique."""
        if self.read_only:
            raise KnowledgeStoreError("the collection may only be read")
        bucket = F.pmod(F.xxhash64("record_id"), F.lit(self.BUCKETS))
        rows = materialize(rows.withColumn("bucket", bucket), "embedded")
        seen = rows.agg(F.collect_set("bucket"), F.count_if(F.col("embedding").isNull() | (F.size("embedding") != self.dimension) | F.col("record_id").isNull())).first()
        if seen[1]:
            raise KnowledgeStoreError(f"rows need a record_id and vectors of {self.dimension} dimensions")
        touched = set(seen[0])
        manifest = self._manifest() or {"number": 0, "metric": "cosine", "dimension": self.dimension, "buckets": {}}
        if touched:
            old = self._rows(manifest, touched)
            whole = rows if old is None else upserted(old.withColumn("bucket", bucket), rows)
            folder = f"data/{manifest['number'] + 1:012d}-{time.time_ns()}"
            whole.repartition("bucket").write.partitionBy("bucket").parquet(f"{self.root}/{folder}")
            places = {str(b): f"{folder}/bucket={b}" for b in touched}
            self._publish(manifest | {"number": manifest["number"] + 1, "buckets": manifest["buckets"] | places})
        release(rows)

    def count(self) -> int:
        rows = self.read()
        return 0 if rows is None else rows.count()

    def search(self, query: str, embed: Embed, k: int = 5) -> DataFrame:
        """The k nearest rows of a text: record_id, text, distance."""
        if not query or not query.strip():
            raise KnowledgeIndexError("the query is blank")
        if k <= 0:
            raise KnowledgeIndexError("the number of results must be above zero")
        vector = checked([query.strip()], embed, self.dimension)[0]
        rows = self.read()
        if rows is None:
            raise KnowledgeStoreError("the collection is empty")
        literal = F.array(*[F.lit(x) for x in vector])
        hits = rows.withColumn("distance", cosine_distance(F.col("embedding"), literal))
        return hits.filter("distance is not null").orderBy("distance", "record_id").limit(k).select("record_id", "text", "metadata", "distance")


def index_chunks(chunks: DataFrame, collection: VectorStore, embed: Embed, batch_size: int = 100) -> DataFrame:
    """Embeds chunks, upserts them and gives the summary row with the collection's count."""
    from clinweave.operators.chunking import index_summary
    from clinweave.operators.embedding import embed_texts

    chunks = materialize(chunks, "chunks")
    collection.upsert(embed_texts(chunks, "text", embed, collection.dimension, batch_size))
    return index_summary(chunks, batch_size).withColumn("collection_records", F.lit(collection.count()))
