import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clinweave.errors import EmbeddingError, KnowledgeIndexError, KnowledgeStoreError
from clinweave.functions.vectors import cosine_distance
from clinweave.operators import chunking as C
from clinweave.operators import collection as V
from clinweave.operators import embedding as E
from clinweave.sinks.json_files import write_json, write_jsonl
from clinweave.streaming.collection_stream import late_aware_counts, stream_into


def test_short_texts_are_whole_and_limits_are_exact(spark):
    rows = []
    for n in (1000, 1001):
        head = len("Question: q\nAnswer: ")
        rows.append((f"r{n}", None, "q", "a" * (n - head)))
    df = spark.createDataFrame(rows, "record_id string, focus string, question string, answer string")
    empty = F.lit(None).cast("string")
    df = df.withColumns({c: empty for c in ("schema_version", "document_id", "content_sha256", "language", "category", "question_type")})
    source = F.struct(*[empty.alias(c) for c in ("dataset", "collection", "relative_path", "upstream_revision", "publisher", "url", "license")])
    got = C.chunk_records(df.withColumns({"source": source, "split": F.lit("train")})).orderBy("record_id").collect()
    assert [(r.record_id, r.chunk_index, r.chunk_count) for r in got] == [("r1000", 0, 1), ("r1001", 0, 2), ("r1001::chunk::0001", 1, 2)]
    assert all(r.chunk_utf8_bytes == len(r.text.encode()) for r in got)


def test_header_room():
    just = C.ChunkPolicy().chars - C.ChunkPolicy().overlap
    for room, repeated in ((180, False), (181, True)):
        question = "q" * (C.ChunkPolicy().chars - room - len("Question: \nAnswer: "))
        parts = C.chunk_record(None, question, "word " * 400)
        assert all(p.startswith("Question: ") for p in parts) is repeated
    assert just == 820


def test_sentence_breaks_and_overlap():
    text = " ".join(f"Sentence number {i} ends here." for i in range(120))
    parts = C.split_text(text, 1000, 12_288, 180)
    assert all(p.endswith(".") and len(p) <= 1000 for p in parts)
    assert all(p.startswith("Sentence") for p in parts)
    for a, b in zip(parts, parts[1:], strict=False):
        assert b[:20] in a


def test_unbroken_and_multibyte():
    assert all(len(p) <= 1000 for p in C.split_text("x" * 5000, 1000, 12_288, 180))
    parts = C.split_text("😀" * 5000, 1000, 400, 180)
    assert all(len(p.encode()) <= 400 for p in parts)
    assert C.split_text(" \n ", 10, 10, 2) == []
    with pytest.raises(ValueError):
        C.split_text("😀", 10, 3, 2)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab .!?\n\té", max_size=400), st.integers(5, 60), st.integers(8, 80))
def test_chunks_cover_the_text(text, chars, size):
    parts = C.split_text(text, chars, size, chars // 3)
    assert all(len(p) <= chars and len(p.encode()) <= size for p in parts)
    letters = "".join("".join(parts).split())
    stripped = text.strip()
    if stripped:
        assert stripped.startswith(parts[0]) and stripped.endswith(parts[-1])
        assert all(p in stripped for p in parts) and len(letters) >= len("".join(stripped.split()))


def test_distance(spark):
    rows = spark.createDataFrame([([1.0, 0.0], [0.0, 2.0]), ([1.0, 1.0], [2.0, 2.0]), ([0.0, 0.0], [1.0, 1.0]), (None, [1.0])], "a array<float>, b array<float>")
    got = [r.d for r in rows.select(F.round(cosine_distance(F.col("a"), F.col("b")), 9).alias("d")).collect()]
    assert got == [1.0, 0.0, None, None]


def test_top_k_equals_brute_force_with_ties_and_copies(spark, monkeypatch):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(60, 8))
    vectors = np.concatenate([base, np.repeat(base[:1], 200, axis=0), np.zeros((1, 8))])
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>").repartition(4)
    monkeypatch.setattr(V, "QUERY_BLOCK", 7)
    monkeypatch.setattr(V, "VECTOR_BLOCK", 30)
    df = df.unionByName(spark.createDataFrame([(9999, None)], df.schema))
    queries = df.filter("vec_id % 5 = 0 and vec_id < 9999").select(F.col("vec_id").alias("query_id"), "embedding")
    got = {(r.query_id, r["rank"]): r.vec_id for r in V.top_k(queries, df, 3).collect()}
    expected = {}
    for q in range(0, len(vectors) - 1, 5):
        d = [(round(1 - vectors[q] @ v / np.linalg.norm(vectors[q]) / np.linalg.norm(v), 6) + 0.0, i) for i, v in enumerate(vectors[:-1])]
        expected |= {(q, k): i for k, (_, i) in enumerate(sorted(d)[:3], 1)}
    assert got == expected
    assert V.top_k(queries.limit(0), df, 3).count() == 0


def test_collection(spark, tmp_path):
    store = V.Collection(spark, str(tmp_path), "c", 16)
    embed = E.hashing_embedder(16)
    assert store.count() == 0

    def rows(*texts):
        df = spark.createDataFrame([(f"r{i}", t) for i, t in enumerate(texts)], "record_id string, text string").withColumn("metadata", F.lit("m"))
        return E.embed_texts(df, "text", embed, 16, 2)

    store.upsert(rows("one two", "three four", "five"))
    store.upsert(rows("one changed"))
    assert store.count() == 3
    assert store.search(" three four ", embed, 1).first().record_id == "r1"
    store.upsert(rows("x").limit(0))
    assert store.count() == 3
    with pytest.raises(KnowledgeStoreError):
        store.upsert(E.embed_texts(spark.createDataFrame([("r", "t", "m")], "record_id string, text string, metadata string"), "text", E.hashing_embedder(3), 3))
    for bad in (("", 5), ("x", 0)):
        with pytest.raises(KnowledgeIndexError):
            store.search(bad[0], embed, bad[1])


def test_upserts_are_atomic_and_touch_their_buckets(spark, tmp_path):
    embed = E.hashing_embedder(4)

    def rows(*ids):
        return E.embed_texts(spark.createDataFrame([(i, f"text {i}") for i in ids], "record_id string, text string"), "text", embed, 4)

    store = V.Collection(spark, str(tmp_path), "c", 4)
    store.upsert(rows(*[f"r{i}" for i in range(300)]))
    first = store._manifest()
    store.upsert(rows("r7", "new"))
    second = store._manifest()
    changed = [b for b in second["buckets"] if second["buckets"][b] != first["buckets"].get(b)]
    assert store.count() == 301 and 1 <= len(changed) <= 2 and second["number"] == 2
    # a writer that ended before it published leaves files that nobody sees
    (tmp_path / "c" / "data" / "000000000003-1").mkdir()
    (tmp_path / "c" / ".000000000003-1").write_text("{")
    assert store.count() == 301
    with pytest.raises(KnowledgeStoreError):
        store._publish(second)
    with pytest.raises(KnowledgeStoreError):
        V.Collection(spark, str(tmp_path), "c", 4, read_only=True).upsert(rows("x"))
    with pytest.raises(KnowledgeStoreError):
        V.Collection(spark, str(tmp_path), "c", 5).count()


def test_embedding_checks():
    assert E.checked([], E.hashing_embedder(4), 4) == []
    for texts, embed in ((["a", " "], E.hashing_embedder(4)), (["a"], lambda t: [[1.0]]), (["a", "b"], lambda t: [[1.0] * 4]), (["a"], lambda t: 1 / 0)):
        with pytest.raises(EmbeddingError):
            E.checked(texts, embed, 4)


def test_stream(spark, tmp_path):
    store = V.Collection(spark, str(tmp_path / "store"), "c", 8)
    arriving = str(tmp_path / "in")
    make = lambda rows: spark.createDataFrame(rows, "record_id string, text string, ingested_at timestamp")
    import datetime as dt

    day = dt.datetime(2024, 1, 1)
    first = make([("a", "one", day), ("a", "two", day + dt.timedelta(1)), ("b", " ", day), (None, "x", day)])
    for batch in (first, make([("b", "three", day)])):
        batch.write.mode("append").parquet(arriving)
        stream_into(spark, arriving, first.schema, store, E.hashing_embedder(8), str(tmp_path / "ck")).awaitTermination(120)
    assert {r.record_id: r.text for r in store.read().collect()} == {"a": "two", "b": "three"}
    events = spark.readStream.schema("collection string, ingested_at timestamp").parquet(arriving)
    assert late_aware_counts(events).isStreaming


def test_json(spark, tmp_path):
    write_json(spark, str(tmp_path / "x" / "y.json"), {"b": "ü", "a": None})
    assert (tmp_path / "x" / "y.json").read_bytes() == '{\n  "a": null,\n  "b": "ü"\n}\n'.encode()


def test_json_lines(spark, tmp_path):
    rows = spark.sql("select id, map('b', 1, 'a', struct(2 as y, null as x).y) as m, array(named_struct('z', 1, 'k', map('q', 1, 'p', 2))) as l, null as n from range(50)").repartition(3)
    write_jsonl(rows, str(tmp_path / "l"), [F.desc("id")], leave_out=("id",))
    lines = [x for p in sorted((tmp_path / "l").glob("part-*.json")) for x in p.read_text().splitlines()]
    assert len(lines) == 50 and set(lines) == {'{"l":[{"k":{"p":2,"q":1},"z":1}],"m":{"a":2,"b":1},"n":null}'}
