"""Registered queries of the core, and the same in SQL for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinweave.config import EmbeddingSettings, SplitConfig
from clinweave.functions import ids, text, vectors
from clinweave.operators import canonical, chunking, collection, dedup, dewey, embedding, quality, redaction, reports, splits
from clinweave.plans.scratch import materialize, scratch_path
from clinweave.sinks.json_files import write_jsonl
from clinweave.sources import medquad_xml

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def _query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _records(spark: SparkSession, folder: str) -> DataFrame:
    """canonical_records as delivered, with hashes made anew; a row without a document stands for itself."""
    rows = _table(spark, folder, "canonical_records")
    blank = F.lit("")
    return rows.withColumns(
        {
            "file_id": F.col("row_id"),
            "document_id": F.coalesce("document_id", "record_id"),
            "content_sha256": text.content_hash(F.coalesce("question", blank), F.coalesce("answer", blank)),
        }
    )


def _pairs(spark: SparkSession, folder: str) -> DataFrame:
    return canonical.raw_pairs(_table(spark, folder, "medquad_documents"))


def _files(spark: SparkSession, folder: str) -> DataFrame:
    return reports.typed_files(_table(spark, folder, "medquad_documents"))


def _kept(spark: SparkSession, folder: str) -> DataFrame:
    """The first record of each content, with what splitting needs: ids, hash, question and place of origin."""
    place = F.struct(*[f"source.{c}" for c in ("collection", "relative_path", "upstream_question_id", "upstream_pair_id")])
    rows = _records(spark, folder).select("row_id", "file_id", "record_id", "document_id", "content_sha256", "question", place.alias("source"))
    return materialize(dedup.keep_first(rows), "kept")


def _assigned(spark: SparkSession, folder: str) -> DataFrame:
    return materialize(splits.assign(_kept(spark, folder), SplitConfig()), "assigned")


# Sources and text functions


@_query
def normalize_text(spark: SparkSession, folder: str) -> DataFrame:
    rows = _table(spark, folder, "documents").withColumn("normalized", text.normalize_text(F.col("text")))
    return rows.select("doc_id", "normalized", F.length("normalized").cast("long").alias("chars"), F.octet_length("normalized").cast("long").alias("utf8_bytes"), F.sha2("normalized", 256).alias("sha256"))


@_query
def content_hash(spark: SparkSession, folder: str) -> DataFrame:
    return _records(spark, folder).select("row_id", "content_sha256")


@_query
def scan_fingerprint(spark: SparkSession, folder: str) -> DataFrame:
    return _pairs(spark, folder).select("file_id", "position", text.scan_fingerprint(F.col("question")).alias("question_fp"), text.scan_fingerprint(F.col("question"), F.col("answer")).alias("pair_fp"))


@_query
def normalized_question(spark: SparkSession, folder: str) -> DataFrame:
    return _table(spark, folder, "canonical_records").select("row_id", text.normalized_question(F.col("question")).alias("normalized"))


@_query
def raw_pairs(spark: SparkSession, folder: str) -> DataFrame:
    return _pairs(spark, folder).select("file_id", "position", "relative_path", "collection", "document_id", "publisher", "focus", "category", "pair_id", "question_id", "question_type", "question", "answer")


@_query
def unique_synonyms(spark: SparkSession, folder: str) -> DataFrame:
    rows = canonical.raw_documents(_table(spark, folder, "medquad_documents"))
    return rows.select("file_id", F.posexplode("synonyms").alias("place", "synonym"))


@_query
def stable_ids(spark: SparkSession, folder: str) -> DataFrame:
    path = F.col("relative_path")
    record = ids.record_id(path, F.col("position"), F.col("pair_id"), F.col("question_id"))
    return _pairs(spark, folder).select("file_id", "position", ids.document_id(path).alias("document_id"), record.alias("record_id"))


def _xml(*pieces: str | F.Column) -> F.Column:
    """Markup and, escaped, texts in one string; null texts are empty. Characters that XML 1.0 has no way to write become blanks."""

    def safe(c: F.Column) -> F.Column:
        c = F.regexp_replace(F.coalesce(c, F.lit("")), r"[\x{0}-\x{8}\x{b}\x{c}\x{e}-\x{1f}\x{fffe}\x{ffff}]", " ")
        for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
            c = F.replace(c, F.lit(char), F.lit(entity))
        return c

    return F.concat(*[F.lit(p) if isinstance(p, str) else safe(p) for p in pieces])


def _xml_files(rows: DataFrame) -> DataFrame:
    """(file_id, content): documents with pairs as files of the current layout."""
    pair = _xml('<QAPair pid="', F.col("pair_id"), '"><Question qid="', F.col("question_id"), '" qtype="', F.col("question_type"), '">', F.col("question"), "</Question><Answer>", F.col("answer"), "</Answer></QAPair>")
    grouped = rows.groupBy("file_id", "document_id", "publisher", "focus").agg(F.array_sort(F.collect_list(F.struct("position", pair.alias("xml")))).alias("p"))
    body = F.array_join(F.transform("p", lambda x: x["xml"]), "")
    head = _xml('<Document id="', F.col("document_id"), '" source="', F.col("publisher"), '"><Focus>', F.col("focus"), "</Focus><QAPairs>")
    return grouped.select("file_id", F.encode(F.concat(head, body, F.lit("</QAPairs></Document>")), "UTF-8").alias("content"))


@_query
def xml_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Each delivered document written as XML of the current layout and parsed again."""
    parsed = medquad_xml.parse_files(_xml_files(canonical.raw_pairs(_table(spark, folder, "medquad_documents"))), "file_id")
    return parsed.select("file_id", "document_id", "publisher", "focus", "parse_error", F.explode("pairs").alias("p")).select(
        "file_id", "document_id", "publisher", "focus", "parse_error", F.col("p.position").cast("long").alias("position"), "p.pair_id", "p.question_id", "p.question_type", "p.question", "p.answer"
    )


@_query
def xml_legacy_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Each delivered document written as XML of the legacy layout, with questions of mixed content and lists of texts as delivered, and parsed again."""
    rows = _table(spark, folder, "medquad_documents")
    word = r"^\s*(\S+)(.*)$"
    lists = {"synonyms": "synonym", "umls_cuis": "cui", "umls_semantic_types": "semanticType", "umls_semantic_groups": "semanticGroup"}

    def joined(items: F.Column, of) -> F.Column:  # noqa: ANN001
        return F.array_join(F.transform(F.coalesce(items, F.array().cast(rows_type(items))), of), "")

    def rows_type(items: F.Column) -> str:
        return rows.select(items).schema[0].dataType.simpleString()

    def pair(p: F.Column) -> F.Column:
        question = F.regexp_replace(F.coalesce(p["question"], F.lit("")), r"\s+", " ")
        first, rest = F.regexp_extract(question, word, 1), F.regexp_extract(question, word, 2)
        return _xml('<pair pid="', p["pair_id"], '"><question qid="', p["question_id"], '">', first, "<i>", rest, "</i></question><answer>", p["answer"], "</answer></pair>")

    def element(tag: str):  # noqa: ANN202
        return lambda v: _xml(f"<{tag}>", v, f"</{tag}>")

    texts = [joined(F.col(c), element(tag)) for c, tag in lists.items()]
    head = _xml('<doc docid="" fid="', F.col("document_id"), '" corpus="', F.col("publisher"), '"><doctitle-focus>', F.col("focus"), "</doctitle-focus><umls>")
    content = F.concat(head, *texts, F.lit("</umls><qaPairs>"), joined(F.col("pairs"), pair), F.lit("</qaPairs></doc>"))
    parsed = medquad_xml.parse_files(rows.select("file_id", F.encode(content, "UTF-8").alias("content")), "file_id")
    flat = {c: F.array_join(c, "|") for c in lists}
    questions = F.array_join(F.transform("pairs", lambda p: F.concat_ws("|", p["position"].cast("string"), F.coalesce(p["pair_id"], F.lit("")), p["question"])), "\n")
    return parsed.select("file_id", "document_id", "publisher", "focus", *[c.alias(n) for n, c in flat.items()], questions.alias("questions"), "parse_error")


@_query
def malformed_files(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as XML beside payloads that are none: each of the latter is reported without stopping the others."""
    good = _xml_files(_pairs(spark, folder))
    files = good.unionByName(_table(spark, folder, "medquad_payloads").select("file_id", F.encode("payload", "UTF-8").alias("content")))
    return medquad_xml.parse_files(files, "file_id").select("file_id", F.col("parse_error").isNotNull().alias("malformed"))


@_query
def jsonl_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Records written as JSON lines to the shared folder and read back."""
    rows = _table(spark, folder, "canonical_records").select("row_id", "language", "question", "answer", "synonyms", "source")
    path = scratch_path(spark, "jsonl")
    write_jsonl(rows, path)
    back = spark.read.schema(rows.schema).json(path)
    return back.select("row_id", "language", "question", "answer", F.array_join("synonyms", "|", "(null)").alias("synonyms"), F.col("source.relative_path").alias("relative_path"), F.col("source.license").alias("license"))


@_query
def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return dewey.file_children(_table(spark, folder, "medquad_documents"), _table(spark, folder, "medquad_payloads"))


@_query
def p5_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """The table of pairs with their links, from the typed deliveries and the payloads of every layout."""
    return _dotted(dewey.pair_rows(_table(spark, folder, "medquad_documents"), _table(spark, folder, "medquad_payloads")))


def _dotted(table: DataFrame) -> DataFrame:
    dotted = {c: F.array_join(F.col(c).cast("array<string>"), ".") for c in ("label", "parent")}
    return table.withColumns(dotted).withColumn("place", F.col("place").cast("long"))


# Quality scan


@_query
def rejections(spark: SparkSession, folder: str) -> DataFrame:
    rows = quality.rejections(_files(spark, folder), _pairs(spark, folder))
    return rows.select("record_type", "file_id", "position", "relative_path", "collection", "document_id", "question_id", "pair_id", "question", F.array_join("reasons", ",").alias("reasons"), "error")


@_query
def collection_stats(spark: SparkSession, folder: str) -> DataFrame:
    return quality.collection_stats(_files(spark, folder), _pairs(spark, folder))


@_query
def summary_rollup(spark: SparkSession, folder: str) -> DataFrame:
    return quality.summary(quality.collection_stats(_files(spark, folder), _pairs(spark, folder)))


@_query
def question_type_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return quality.question_type_histogram(_pairs(spark, folder))


@_query
def category_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return quality.category_histogram(_files(spark, folder))


# Redaction and canonical records


@_query
def pii_redact(spark: SparkSession, folder: str) -> DataFrame:
    rows = redaction.redact_columns(_table(spark, folder, "canonical_records").select("row_id", "focus", "question", "answer"), ["focus", "question", "answer"])
    return rows.select("row_id", "focus", "question", "answer", F.array_join(F.array_distinct(F.concat("focus_types", "question_types", "answer_types")), ",").alias("types"))


@_query
def canonicalize(spark: SparkSession, folder: str) -> DataFrame:
    rows = canonical.canonicalize(_pairs(spark, folder))
    return rows.select("file_id", "record_id", "document_id", "content_sha256", "focus", "question", "answer", "source.collection", "curation.pii_status", F.array_join("curation.pii_types", ",").alias("pii_types"))


@_query
def pii_audit(spark: SparkSession, folder: str) -> DataFrame:
    return redaction.pii_audit(_table(spark, folder, "canonical_records"))


@_query
def pii_findings(spark: SparkSession, folder: str) -> DataFrame:
    found = redaction.pii_findings(_table(spark, folder, "canonical_records"))
    return found.withColumn("detected_types", F.array_join("detected_types", ","))


@_query
def constraint_violations(spark: SparkSession, folder: str) -> DataFrame:
    return canonical.constraint_violations(_table(spark, folder, "canonical_records"))


# Duplicates, components and splits


@_query
def keep_first(spark: SparkSession, folder: str) -> DataFrame:
    return dedup.keep_first(_records(spark, folder)).select("row_id", "content_sha256", "record_id")


@_query
def duplicate_trace(spark: SparkSession, folder: str) -> DataFrame:
    return dedup.removals(materialize(_records(spark, folder), "records"))


@_query
def first_records(spark: SparkSession, folder: str) -> DataFrame:
    """The first 100 parents in canonical order: the limit of the index command."""
    return dedup.first_records(_records(spark, folder), 100).select("row_id", "record_id")


@_query
def components(spark: SparkSession, folder: str) -> DataFrame:
    return splits.document_components(_kept(spark, folder))


@_query
def component_split(spark: SparkSession, folder: str) -> DataFrame:
    return _assigned(spark, folder).select("row_id", "document_id", "component", F.round(ids.split_position(F.col("component"), 42), 9).alias("position"), "split")


@_query
def split_counts(spark: SparkSession, folder: str) -> DataFrame:
    return splits.split_counts(_assigned(spark, folder))


@_query
def collection_split_counts(spark: SparkSession, folder: str) -> DataFrame:
    return splits.collection_counts(_assigned(spark, folder))


@_query
def leakage_report(spark: SparkSession, folder: str) -> DataFrame:
    return splits.leakage_report(_assigned(spark, folder))


@_query
def prepare_summary(spark: SparkSession, folder: str) -> DataFrame:
    """The whole preparation from raw documents: records and documents per split."""
    return splits.split_counts(reports.prepare(_table(spark, folder, "medquad_documents")).records)


@_query
def manifest_counts(spark: SparkSession, folder: str) -> DataFrame:
    """The counts and the validation of a prepared dataset's manifest."""
    documents = _table(spark, folder, "medquad_documents")
    made = reports.manifest(reports.prepare(documents), SplitConfig(), documents.count(), folder)
    return _numbers(spark, made["summary"] | made["validation"])


@_query
def scan_counts(spark: SparkSession, folder: str) -> DataFrame:
    """The summary of a scan's report."""
    return _numbers(spark, reports.scan_report(_files(spark, folder), _pairs(spark, folder), folder)["summary"])


def _numbers(spark: SparkSession, found: dict) -> DataFrame:
    return spark.createDataFrame([(k, v) for k, v in sorted(found.items()) if isinstance(v, int)], "name string, value long")


# Chunks, embeddings and the vector collection


def _chunks(spark: SparkSession, folder: str) -> DataFrame:
    return chunking.chunk_records(_records(spark, folder).withColumn("split", F.lit("train")))


@_query
def index_text(spark: SparkSession, folder: str) -> DataFrame:
    blank = F.lit("")
    return _table(spark, folder, "canonical_records").select("row_id", canonical.index_text(F.col("focus"), F.coalesce("question", blank), F.coalesce("answer", blank)).alias("index_text"))


@_query
def chunk_documents(spark: SparkSession, folder: str) -> DataFrame:
    return _chunks(spark, folder).select("record_id", "parent_record_id", "chunk_index", "chunk_count", "chunk_sha256", "chunk_utf8_bytes", "text")


@_query
def index_summary(spark: SparkSession, folder: str) -> DataFrame:
    return chunking.index_summary(_chunks(spark, folder))


@_query
def embed_chunks(spark: SparkSession, folder: str) -> DataFrame:
    """Chunks with hashed embeddings: their length is 1, so the squares sum to 1."""
    n = EmbeddingSettings.dimension
    rows = embedding.embed_texts(_chunks(spark, folder).select("record_id", "chunk_sha256", "text"), "text", embedding.hashing_embedder(n), n)
    return rows.select("record_id", "chunk_sha256", F.size("embedding").alias("dimension"), F.round(vectors.dot(F.col("embedding"), F.col("embedding")), 4).alias("squares"))


@_query
def cosine_distance(spark: SparkSession, folder: str) -> DataFrame:
    """Distance of every vector to the first one."""
    rows = _table(spark, folder, "embeddings")
    first = rows.orderBy("vec_id").select("embedding").first()
    reference = F.lit([float(x) for x in first.embedding] if first else [])
    return rows.select("vec_id", F.round(vectors.cosine_distance(F.col("embedding"), reference), 6).alias("distance"))


@_query
def vector_top_k(spark: SparkSession, folder: str) -> DataFrame:
    """The five nearest of each vector whose id is divisible by 50, among all vectors."""
    rows = _table(spark, folder, "embeddings")
    return collection.top_k(rows.filter("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), "embedding"), rows, 5)


def _vector_store(spark: SparkSession, folder: str) -> collection.Collection:
    """A collection of all vectors, which then are all delivered again under another label, and once more under new ids."""
    rows = _table(spark, folder, "embeddings").select("vec_id", "label", "embedding")
    first = rows.select("embedding").first()
    store = collection.Collection(spark, scratch_path(spark, "collections"), "vectors", len(first.embedding) if first else 1)
    again = rows.select("vec_id", (F.col("label") + 1).alias("label"), "embedding").unionByName(rows.withColumn("vec_id", -F.col("vec_id") - 1))
    for delivery in (rows, again):
        store.upsert(delivery.select(F.col("vec_id").cast("string").alias("record_id"), F.col("label").cast("string").alias("text"), "embedding"))
    return store


@_query
def vector_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """What a collection holds after all vectors came twice, the second time with other labels and with as many new ids."""
    rows = _vector_store(spark, folder).read()
    return rows.select(F.col("record_id").cast("long").alias("vec_id"), F.col("text").cast("long").alias("label"), F.size("embedding").alias("dimension"))


@_query
def collection_count(spark: SparkSession, folder: str) -> DataFrame:
    """The number of rows that the collection counts, beside the table's."""
    n = _vector_store(spark, folder).count()
    return _table(spark, folder, "embeddings").agg(F.count("*").alias("delivered"), F.lit(n).cast("long").alias("collection_records"))


# The same in SQL


def _norm(x: str) -> str:
    return rf"trim(regexp_replace(coalesce({x}, ''), '[\s\x0b\x{{1c}}-\x{{1f}}\x{{85}}\p{{Z}}]+', ' ', 'g'))"


def _unique(column: str) -> str:
    """Normalised elements without blanks and repetitions, in first-seen order."""
    tidy = f"list_filter(list_transform(coalesce({column}, []), lambda x: {_norm('x')}), lambda x: x <> '')"
    return f"list_filter({tidy}, lambda x, i: list_position({tidy}, x) = i)"


def _uuid(kind: str, *parts: str) -> str:
    name = " || ".join([f"'medquad:{kind}'", *[f"':' || coalesce({p}::VARCHAR, '')" for p in parts]])
    h = f"sha1(unhex('{ids.NAMESPACE.replace('-', '')}') || encode({name}))"
    return (
        f"(substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-5' || substr({h}, 14, 3) || '-' || substr('89ab', ('0x' || substr({h}, 17, 1))::INT % 4 + 1, 1)"
        f" || substr({h}, 18, 3) || '-' || substr({h}, 21, 12))"
    )


_COLLECTION = "CASE WHEN contains(relative_path, '/') THEN split_part(relative_path, '/', 1) ELSE 'root' END"
_RAW = f"""
    pr AS (SELECT file_id, relative_path, {_COLLECTION} AS collection, nullif({_norm("document_id")}, '') AS document_id, nullif({_norm("publisher")}, '') AS publisher,
        nullif({_norm("focus")}, '') AS focus, nullif({_norm("category")}, '') AS category, i AS position, nullif({_norm("p.pair_id")}, '') AS pair_id,
        nullif({_norm("p.question_id")}, '') AS question_id, nullif({_norm("p.question_type")}, '') AS question_type, {_norm("p.question")} AS question, {_norm("p.answer")} AS answer
        FROM (SELECT *, unnest(pairs) AS p, generate_subscripts(pairs, 1) AS i FROM medquad_documents))
"""
_FOLD = "replace(lower({0}), 'ß', 'ss')"
_GOOD = "good AS (SELECT * FROM pr WHERE question <> '' AND answer <> '')"
_STATS = f"""
    WITH {_RAW}, {_GOOD},
    f AS (SELECT {_COLLECTION} AS collection, count(*) AS n FROM medquad_documents GROUP BY 1),
    c AS (SELECT collection, count(*) AS total, count(*) FILTER (question <> '' AND answer <> '') AS ok, count(*) FILTER (question = '') AS no_q, count(*) FILTER (answer = '') AS no_a FROM pr GROUP BY 1),
    o AS (SELECT collection, row_number() OVER (PARTITION BY {_FOLD.format("question")} ORDER BY relative_path, file_id, position) AS q,
        row_number() OVER (PARTITION BY {_FOLD.format("question")}, {_FOLD.format("answer")} ORDER BY relative_path, file_id, position) AS p FROM good),
    d AS (SELECT collection, count(*) FILTER (q > 1) AS dq, count(*) FILTER (p > 1) AS dp FROM o GROUP BY 1),
    stats AS (SELECT f.collection, f.n AS xml_files_discovered, f.n AS xml_files_parsed, 0::BIGINT AS malformed_files, coalesce(total, 0) AS qa_pairs_total, coalesce(ok, 0) AS qa_pairs_accepted,
        coalesce(total - ok, 0) AS qa_pairs_rejected, coalesce(no_q, 0) AS missing_question, coalesce(no_a, 0) AS missing_answer, coalesce(dq, 0) AS duplicate_question_occurrences,
        coalesce(dp, 0) AS duplicate_pair_occurrences FROM f LEFT JOIN c USING (collection) LEFT JOIN d USING (collection))
"""
_REC = """
    rec AS (SELECT row_id, record_id, coalesce(document_id, record_id) AS document_id, question, source, sha256(coalesce(question, '') || '␟' || coalesce(answer, '')) AS sha FROM canonical_records),
    ranked AS (SELECT *, row_number() OVER w AS rn, first_value(record_id) OVER w AS kept_record_id, first_value(document_id) OVER w AS kept_document_id FROM rec
        WINDOW w AS (PARTITION BY sha ORDER BY coalesce(source.relative_path, ''), coalesce(source.upstream_question_id, ''), coalesce(source.upstream_pair_id, ''), record_id, row_id))
"""
# compatibility forms that occur in the tables: full-width letters by rule, and single characters
_WIDE, _NARROW = "".join(chr(0xFF01 + i) for i in range(94)), "".join(chr(0x21 + i) for i in range(94)).replace("'", "''")
_COMPAT = f"translate(replace(replace(replace(question, 'ﬁ', 'fi'), 'ﬂ', 'fl'), '…', '...'), '{_WIDE}º²³¹‑', '{_NARROW}o231‐')"
_EQ3 = rf"regexp_replace({_norm(f"replace(lower({_COMPAT}), 'ß', 'ss')")}, ' ([?!.,;:])', '\1', 'g')"
_LINKED = f"""
    kept AS (SELECT *, {_EQ3} AS q FROM ranked WHERE rn = 1),
    asked AS (SELECT DISTINCT document_id AS d, q FROM kept),
    links AS (SELECT DISTINCT x.d AS a, y.m AS b FROM asked x JOIN (SELECT q, min(d) AS m FROM asked GROUP BY q) y USING (q)),
    edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
    reach AS (SELECT a, b FROM edges UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a),
    comp AS (SELECT a AS document_id, min(b) AS component FROM reach GROUP BY a),
    placed AS (SELECT k.*, c.component, ('0x' || substr(sha256('42:' || c.component), 1, 16))::UBIGINT::DOUBLE / 18446744073709551616 AS position FROM kept k JOIN comp c USING (document_id)),
    assigned AS (SELECT *, CASE WHEN position < 0.8 THEN 'train' WHEN position < 0.8 + 0.1 THEN 'validation' ELSE 'test' END AS split FROM placed)
"""
_COMPONENTS = f"WITH RECURSIVE {_REC}, {_LINKED}"


# The rules of redaction for an engine without lookaround: what stands beside a match is captured and put back, and
# each rule runs twice, since a match takes the neighbour that the next one needs.
_SP, _NOT_WORD, _NOT_DIGIT = r"[\s\p{Z}]", r"[^\p{L}\p{N}_]", r"[^\p{Nd}]"
_UP, _ANY = "A-ZÀ-ÖØ-Þ", "A-Za-zÀ-ÖØ-öø-ÿ'\\-"
_TOLL_FREE = "(?:800|833|844|855|866|877|888)"
_MONTHS = "(?:Jan(?:uary)?|Feb(?:ruary)?|Mar(?:ch)?|Apr(?:il)?|May|Jun(?:e)?|Jul(?:y)?|Aug(?:ust)?|Sep(?:tember)?|Oct(?:ober)?|Nov(?:ember)?|Dec(?:ember)?)"
_REDACTIONS = [
    ("email_address", rf"(?i)(^|[^\p{{L}}\p{{N}}_.+\-])[A-Z0-9._%+\-İ]+@[A-Z0-9.\-İ]+\.[A-Zİ]{{2,63}}($|[^\p{{L}}\p{{N}}_\-])"),
    ("us_ssn", rf"(^|{_NOT_DIGIT})(?:00[1-9]|0[1-9]\d|[1-578]\d\d|6[0-57-9]\d|66[0-57-9])-(?:0[1-9]|[1-9]\d)-(?:000[1-9]|00[1-9]\d|0[1-9]\d\d|[1-9]\d\d\d)($|{_NOT_DIGIT})"),
    ("brazilian_cpf", rf"(^|{_NOT_DIGIT})\d{{3}}\.\d{{3}}\.\d{{3}}-\d\d($|{_NOT_DIGIT})"),
    ("medical_record_number", rf"(?i)(\b(?:medical{_SP}+record(?:{_SP}+(?:number|no\.?|#))?|mrn|patient{_SP}+(?:id|identifier)){_SP}*(?::|=|#|\bis\b){_SP}*)[A-Z0-9İ][A-Z0-9\-İ]{{3,31}}()"),
    ("patient_name", rf"((?i:\b(?:patient{_SP}+name|name{_SP}+of{_SP}+(?:the{_SP}+)?patient){_SP}*[:=\-]{_SP}*))[{_UP}][{_ANY}]+(?:{_SP}+[{_UP}][{_ANY}]+){{1,5}}({_SP}*(?:[;,|]|\b(?i:DOB|date{_SP}+of{_SP}+birth|MRN|medical{_SP}+record)\b|$))"),
    ("date_of_birth", rf"(?i)(\b(?:date{_SP}+of{_SP}+birth|dob){_SP}*[:=\-]{_SP}*)(?:\d{{4}}-\d\d-\d\d|\d{{1,2}}[/\-]\d{{1,2}}[/\-]\d{{2,4}}|{_MONTHS}\.?{_SP}+\d{{1,2}},?{_SP}+\d{{4}})()"),
    ("phone_number", rf"(^|{_NOT_WORD})(?:\+?1(?:{_SP}|[.\-])?)?(?:\(\d{{3}}\)|\d{{3}})(?:{_SP}|[.\-])\d{{3}}(?:{_SP}|[.\-])\d{{4}}($|{_NOT_WORD})"),
    ("phone_number", rf"(?i)(^|{_NOT_WORD})1(?:{_SP}|[.\-])?{_TOLL_FREE}(?:(?:{_SP}|[.\-])?[A-Z0-9İ]){{7,11}}($|{_NOT_WORD})"),
    ("phone_number", rf"(^|{_NOT_DIGIT})1{_TOLL_FREE}\d{{7}}($|{_NOT_DIGIT})"),
    ("phone_number", rf"(^|{_NOT_DIGIT})1?[2-9]\d\d[2-9]\d{{6}}($|{_NOT_DIGIT})"),
    ("phone_number", rf"(?i)(\b(?:phone|telephone|tel|mobile|cell|fax|tty){_SP}*:?[ \t]*)\+?\d{{7,15}}($|{_NOT_DIGIT})"),
    ("phone_number", rf"(?i)(\bcall(?:ing)?{_SP}+)\+?\d{{10,15}}($|{_NOT_DIGIT})"),
]


def _redacted(value: str) -> str:
    for kind, pattern in _REDACTIONS:
        for _ in range(2):
            value = f"regexp_replace({value}, '{pattern.replace(chr(39), chr(39) * 2)}', '\\1{redaction.PLACEHOLDER[kind]}\\2', 'g')"
    return value


def _found_types(value: str, redacted: str) -> str:
    def times(x: str, kind: str) -> str:
        return f"length({x}) - length(replace({x}, '{redaction.PLACEHOLDER[kind]}', '{redaction.PLACEHOLDER[kind][1:]}'))"

    each = ", ".join(f"CASE WHEN {times(redacted, k)} > {times(value, k)} THEN '{k}' END" for k in redaction.TYPE_ORDER)
    return f"list_filter([{each}], lambda x: x IS NOT NULL)"


def _in_order(types: str) -> str:
    return f"array_to_string(list_filter({types}, lambda x, i: list_position({types}, x) = i), ',')"


_CANONICAL = f"""
    {_RAW}, {_GOOD},
    syn AS (SELECT file_id, v, min(i) AS i FROM (SELECT file_id, {_norm("v")} AS v, i FROM (SELECT file_id, unnest(synonyms) AS v, generate_subscripts(synonyms, 1) AS i FROM medquad_documents)) WHERE v <> '' GROUP BY 1, 2),
    syn_types AS (SELECT file_id, flatten(list({_found_types("v", "r")} ORDER BY i)) AS t FROM (SELECT *, {_redacted("v")} AS r FROM syn) GROUP BY 1),
    red AS (SELECT *, {_redacted("focus")} AS rf, {_redacted("question")} AS rq, {_redacted("answer")} AS ra FROM good),
    canon AS (SELECT file_id, {_uuid('record', 'relative_path', 'position', 'pair_id', 'question_id')} AS record_id, {_uuid('document', 'relative_path')} AS document_id,
        sha256(rq || '␟' || ra) AS content_sha256, rf AS focus, rq AS question, ra AS answer, collection, relative_path, question_id, pair_id,
        {_found_types("coalesce(focus, '')", "coalesce(rf, '')")} || {_found_types("question", "rq")} || {_found_types("answer", "ra")} || coalesce(t, []) AS types
        FROM red LEFT JOIN syn_types USING (file_id))
"""
_UUID_FORMAT = "'^[0-9a-f]{8}-[0-9a-f]{4}-5[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$'"
_RULES = {
    "redacted_has_types": "curation.pii_status <> 'redacted' OR len(coalesce(curation.pii_types, [])) > 0",
    "not_detected_has_no_types": "curation.pii_status <> 'not_detected' OR len(coalesce(curation.pii_types, [])) = 0",
    "question_not_blank": f"{_norm('question')} <> ''",
    "answer_not_blank": f"{_norm('answer')} <> ''",
    "schema_version": "schema_version = '1.1'",
    "language": "language = 'en'",
    "dataset": "source.dataset = 'MedQuAD'",
    "license": "source.license = 'CC-BY-4.0'",
    "status": "curation.status = 'accepted'",
    "record_id_format": f"regexp_matches(record_id, {_UUID_FORMAT})",
    "document_id_format": f"regexp_matches(document_id, {_UUID_FORMAT})",
    "content_sha256_format": "regexp_matches(content_sha256, '^[0-9a-f]{64}$')",
    # list_distinct leaves nulls out, so they are counted by themselves
    **{f"{c}_unique": f"len(list_distinct({c})) + CASE WHEN len({c}) > list_count({c}) THEN 1 ELSE 0 END = len({c})" for c in canonical.LISTS},
    **{f"{c}_no_blanks": f"len(list_filter({c}, lambda v: v IS NULL OR v = '')) = 0" for c in canonical.LISTS},
}
_TYPES = redaction.TYPE_ORDER


def _elements(value: str, path: str) -> str:
    """The elements of a JSON list, a bare one as a list of one, nothing as none."""
    kind = f"json_type({value}, '{path}')"
    return f"(CASE WHEN {kind} = 'ARRAY' THEN json_extract({value}, '{path}[*]') WHEN {kind} IS NULL OR {kind} = 'NULL' THEN []::JSON[] ELSE [json_extract({value}, '{path}')] END)"


def _texts(lists: str, *fields: str) -> str:
    """Text of each element: of the first of its fields if it is an object."""
    inner = ", ".join(f"json_extract_string(e, '$.\"{f}\"')" for f in fields)
    return f"list_transform({lists}, lambda e: CASE WHEN json_type(e) = 'OBJECT' THEN coalesce({inner}) ELSE json_extract_string(e, '$') END)"


def _ordinal(value: str, path: str, name: str) -> str:
    """The 1-based place of a name among an object's names."""
    return f"list_position(json_keys({value}, '{path}'), '{name}')::BIGINT"


def _leaf(*paths: str) -> str:
    """The text of an element's first field that is a leaf."""
    return "coalesce(" + ", ".join(f"CASE WHEN json_type(e, '$.{p}') NOT IN ('OBJECT', 'ARRAY', 'NULL') THEN json_extract_string(e, '$.{p}') END" for p in paths) + ")"


_XML_PAIRS = f"list_concat({_elements('j', '$.Document.QAPairs.QAPair')}, {_elements('j', '$.doc.qaPairs.pair')})"
_PLAIN_PAIRS = f"list_concat({_elements('j', '$.pairs')}, flatten(list_transform({_elements('j', '$.sections')}, lambda s: {_elements('s', '$.pairs')})))"
_SYNONYMS = " || ".join(_elements("j", p) for p in ("$.synonyms", "$.meta.focus.synonyms", "$.Document.FocusAnnotations.Synonyms.Synonym", "$.doc.synonym"))
_CUIS = " || ".join(_elements("j", p) for p in ("$.umls_cuis", "$.meta.focus.umls_cuis", "$.Document.FocusAnnotations.UMLS.CUIs.CUI", "$.doc.umls.cui"))

_WHITE = r"[\s\x0b\x{1c}-\x{1f}\x{85}\p{Z}]"


def _breaks(text: str, first: str) -> str:
    """0-based places, from ``first`` on, where a break begins in a text: white space after a sentence, line ends outside of such."""
    c, before = f"substr({text}, i + 1, 1)", f"substr({text}, i, 1)"
    run = f"length(regexp_replace(substr({text}, 1, i), '{_WHITE}+$', ''))"  # where the white space around i begins
    stop = f"i > 0 AND {before} IN ('.', '!', '?') AND {c} <> chr(10) AND regexp_full_match({c}, '{_WHITE}')"
    inside = f"{run} < i AND {run} > 0 AND substr({text}, {run}, 1) IN ('.', '!', '?') AND substr({text}, {run} + 1, 1) <> chr(10)"
    return f"list_filter(range({first}, length({text})), lambda i: ({stop}) OR ({c} = chr(10) AND (i = 0 OR {before} <> chr(10)) AND NOT ({inside})))"


def _strip(text: str) -> str:
    return f"regexp_replace({text}, '^{_WHITE}+|{_WHITE}+$', '', 'g')"


_CHUNKS = f"""
    WITH RECURSIVE base AS (SELECT row_id, record_id, coalesce(answer, '') AS a, CASE WHEN focus <> '' THEN 'Medical topic: ' || focus || chr(10) ELSE '' END || 'Question: ' || coalesce(question, '') || chr(10) || 'Answer: ' AS header FROM canonical_records),
    lead AS (SELECT row_id, a, header || a AS whole, CASE WHEN length(header) + 180 >= 1000 THEN '' ELSE header END AS lead FROM base WHERE length(header) + length(a) > 1000),
    body AS (SELECT row_id, lead, {_strip("CASE WHEN lead = '' THEN whole ELSE a END")} AS x, 1000 - length(lead) AS chars, least(180, (1000 - length(lead)) // 5) AS overlap FROM lead),
    step AS (
        SELECT row_id, lead, x, chars, overlap, -1::BIGINT AS k, 0::BIGINT AS s, 0::BIGINT AS e FROM body WHERE x <> ''
        UNION ALL
        SELECT row_id, lead, x, chars, overlap, k + 1, s,
            CASE WHEN s + chars >= length(x) THEN length(x) WHEN soft IS NULL OR {_strip("substr(part, 1, soft)")} = '' THEN s + chars ELSE s + soft END
        FROM (SELECT *, coalesce(list_max({_breaks("part", "floor")}), list_max(list_filter(range(floor, length(part)), lambda i: substr(part, i + 1, 1) = ' '))) AS soft
            FROM (SELECT *, substr(x, s + 1, chars) AS part, greatest(1, (chars * 11) // 20) AS floor
                FROM (SELECT row_id, lead, x, chars, overlap, k, CASE WHEN k < 0 THEN 0 ELSE edge + coalesce(
                        list_filter(list_transform({_breaks("region", "0")}, lambda i: length(region) - length(regexp_replace(substr(region, i + 1), CASE WHEN substr(region, i + 1, 1) = chr(10) THEN '^\n+' ELSE '^{_WHITE}+' END, ''))), lambda y: y < length(region))[1],
                        list_filter(range(0, length(region)), lambda i: NOT regexp_full_match(substr(region, i + 1, 1), '{_WHITE}') AND regexp_full_match(substr(x, edge + i, 1), '{_WHITE}'))[1],
                        0) END AS s
                    FROM (SELECT *, greatest(s + 1, e - overlap) AS edge, substr(x, greatest(s + 1, e - overlap) + 1, e - greatest(s + 1, e - overlap)) AS region FROM step WHERE e < length(x)))))),
    pieces AS (SELECT row_id, k, lead || {_strip("substr(x, s + 1, e - s)")} AS text FROM step WHERE k >= 0 UNION ALL SELECT row_id, 0, header || a FROM base WHERE length(header) + length(a) <= 1000),
    chunks AS (SELECT CASE WHEN k = 0 THEN record_id ELSE record_id || '::chunk::' || printf('%04d', k) END AS record_id, record_id AS parent_record_id, k AS chunk_index,
        count(*) OVER (PARTITION BY row_id) AS chunk_count, sha256(text) AS chunk_sha256, strlen(text) AS chunk_utf8_bytes, text FROM pieces JOIN base USING (row_id))
"""

SQL: dict[str, str] = {
    "chunk_documents": _CHUNKS + "SELECT * FROM chunks",
    "index_summary": _CHUNKS + "SELECT count(*) FILTER (chunk_index = 0) AS indexed_records, count(*) AS indexed_documents, count(*) FILTER (chunk_index = 0 AND chunk_count > 1) AS chunked_records, (count(*) + 99) // 100 AS batches FROM chunks",
    "embed_chunks": _CHUNKS + "SELECT record_id, chunk_sha256, 384 AS dimension, CASE WHEN trim(text) <> '' THEN 1.0 ELSE 0.0 END AS squares FROM chunks",
    "normalize_text": f"WITH n AS (SELECT doc_id, {_norm('text')} AS normalized FROM documents) SELECT doc_id, normalized, length(normalized) AS chars, strlen(normalized) AS utf8_bytes, sha256(normalized) AS sha256 FROM n",
    "content_hash": "SELECT row_id, sha256(coalesce(question, '') || '␟' || coalesce(answer, '')) AS content_sha256 FROM canonical_records",
    "scan_fingerprint": f"WITH {_RAW} SELECT file_id, position, sha256({_FOLD.format('question')}) AS question_fp, sha256({_FOLD.format('question')} || '␟' || {_FOLD.format('answer')}) AS pair_fp FROM pr",
    "normalized_question": f"SELECT row_id, {_EQ3} AS normalized FROM canonical_records",
    "raw_pairs": f"WITH {_RAW} SELECT * FROM pr",
    "unique_synonyms": f"""
        WITH s AS (SELECT file_id, {_norm("v")} AS synonym, i FROM (SELECT file_id, unnest(synonyms) AS v, generate_subscripts(synonyms, 1) AS i FROM medquad_documents)),
        f AS (SELECT file_id, synonym, min(i) AS i FROM s WHERE synonym <> '' GROUP BY ALL)
        SELECT file_id, synonym, row_number() OVER (PARTITION BY file_id ORDER BY i) - 1 AS place FROM f
    """,
    "stable_ids": f"WITH {_RAW} SELECT file_id, position, {_uuid('document', 'relative_path')} AS document_id, {_uuid('record', 'relative_path', 'position', 'pair_id', 'question_id')} AS record_id FROM pr",
    "xml_round_trip": f"WITH {_RAW} SELECT file_id, document_id, publisher, focus, NULL::VARCHAR AS parse_error, position, pair_id, question_id, question_type, question, answer FROM pr",
    "malformed_files": "SELECT file_id, true AS malformed FROM medquad_payloads UNION ALL SELECT file_id, false FROM medquad_documents WHERE len(pairs) > 0",
    "xml_legacy_round_trip": f"""
        SELECT file_id, nullif({_norm("document_id")}, '') AS document_id, nullif({_norm("publisher")}, '') AS publisher, nullif({_norm("focus")}, '') AS focus,
        {", ".join(f"array_to_string({_unique(c)}, '|') AS {c}" for c in canonical.LISTS)},
        array_to_string(list_transform(coalesce(pairs, []), lambda p, i: i || '|' || coalesce({_norm("p.pair_id")}, '') || '|' || {_norm("p.question")}), chr(10)) AS questions, NULL::VARCHAR AS parse_error
        FROM medquad_documents
    """,
    "jsonl_round_trip": "SELECT row_id, language, question, answer, array_to_string(list_transform(synonyms, lambda x: coalesce(x, '(null)')), '|') AS synonyms, source.relative_path AS relative_path, source.license AS license FROM canonical_records",
    "p5_found": f"""
        WITH whole AS (SELECT file_id, payload::JSON AS j FROM medquad_payloads WHERE json_valid(payload)),
        p AS (SELECT file_id, {_XML_PAIRS} || {_PLAIN_PAIRS} AS l FROM whole),
        pairs AS (
            SELECT file_id, i AS child_pos, coalesce(json_extract_string(e, '$.pair_id'), json_extract_string(e, '$."@pid"'), '') AS child_key
            FROM (SELECT file_id, unnest(l) AS e, generate_subscripts(l, 1) AS i FROM p) WHERE e IS NOT NULL AND json_type(e) <> 'NULL'
            UNION ALL SELECT file_id, i, coalesce(p.pair_id, '') FROM (SELECT file_id, unnest(pairs) AS p, generate_subscripts(pairs, 1) AS i FROM medquad_documents) WHERE p IS NOT NULL),
        lists AS (
            SELECT file_id, 'synonym' AS child_kind, {_texts(_SYNONYMS, "#text", "text")} AS l FROM whole UNION ALL SELECT file_id, 'cui', {_texts(_CUIS, "#text", "cui", "text")} FROM whole
            UNION ALL SELECT file_id, 'synonym', synonyms FROM medquad_documents UNION ALL SELECT file_id, 'cui', umls_cuis FROM medquad_documents),
        texts AS (SELECT file_id, child_kind, i AS child_pos, regexp_replace(e, '^[\\s\\p{{Z}}]+|[\\s\\p{{Z}}]+$', '', 'g') AS child_key
            FROM (SELECT file_id, child_kind, unnest(l) AS e, generate_subscripts(l, 1) AS i FROM lists))
        SELECT file_id, 'pair' AS child_kind, child_pos, child_key FROM pairs UNION ALL SELECT file_id, child_kind, child_pos, child_key FROM texts WHERE child_key <> ''
    """,
    "p5_pairs": f"""
        WITH whole AS (SELECT file_id, payload::JSON AS j FROM medquad_payloads WHERE json_valid(payload)),
        sections AS (SELECT file_id, [{_ordinal('j', '$', 'sections')}] || CASE WHEN json_type(j, '$.sections') = 'ARRAY' THEN [i] ELSE []::BIGINT[] END AS spot, s
            FROM (SELECT file_id, j, unnest({_elements('j', '$.sections')}) AS s, generate_subscripts({_elements('j', '$.sections')}, 1) AS i FROM whole)),
        lists AS (
            SELECT file_id, [{_ordinal('j', '$', 'pairs')}] AS spot, json_extract(j, '$.pairs') AS v FROM whole
            UNION ALL SELECT file_id, spot || [{_ordinal('s', '$', 'pairs')}], json_extract(s, '$.pairs') FROM sections
            UNION ALL SELECT file_id, [{_ordinal('j', '$', 'Document')}, {_ordinal('j', '$.Document', 'QAPairs')}, {_ordinal('j', '$.Document.QAPairs', 'QAPair')}], json_extract(j, '$.Document.QAPairs.QAPair') FROM whole
            UNION ALL SELECT file_id, [{_ordinal('j', '$', 'doc')}, {_ordinal('j', '$.doc', 'qaPairs')}, {_ordinal('j', '$.doc.qaPairs', 'pair')}], json_extract(j, '$.doc.qaPairs.pair') FROM whole),
        named AS (SELECT file_id, unnest({_elements('v', '$')}) AS e, spot || unnest(CASE WHEN json_type(v) = 'ARRAY' THEN list_transform(range(1, json_array_length(v)::BIGINT + 1), lambda i: [i]) ELSE [[]::BIGINT[]] END) AS spot
            FROM lists WHERE v IS NOT NULL AND json_type(v) <> 'NULL'),
        placed AS (SELECT file_id, e, spot, row_number() OVER (PARTITION BY file_id ORDER BY spot) AS place FROM named)
        SELECT file_id, array_to_string(spot, '.') AS label, array_to_string(spot[:-2], '.') AS parent, place, {_leaf('pair_id', '"@pid"')} AS pair_id,
            {_leaf('question_id', 'Question."@qid"', 'question."@qid"')} AS question_id, {_leaf('question_type', 'Question."@qtype"', 'question."@qtype"')} AS question_type,
            {_leaf('question', 'question."#text"', 'Question', 'Question."#text"')} AS question, {_leaf('answer', 'answer."#text"', 'Answer', 'Answer."#text"')} AS answer
        FROM placed WHERE json_type(e) <> 'NULL'
        UNION ALL SELECT file_id, '1.' || i, '1', i, p.pair_id, p.question_id, p.question_type, p.question, p.answer
        FROM (SELECT file_id, unnest(pairs) AS p, generate_subscripts(pairs, 1) AS i FROM medquad_documents) WHERE p IS NOT NULL
    """,
    "pii_redact": f"""
        WITH r AS (SELECT row_id, focus AS f, question AS q, answer AS a, {_redacted("focus")} AS focus, {_redacted("question")} AS question, {_redacted("answer")} AS answer FROM canonical_records),
        t AS (SELECT *, {" || ".join(_found_types(f"coalesce({x}, '')", f"coalesce({y}, '')") for x, y in (("f", "focus"), ("q", "question"), ("a", "answer")))} AS l FROM r)
        SELECT row_id, focus, question, answer, {_in_order("l")} AS types FROM t
    """,
    "canonicalize": f"WITH {_CANONICAL} SELECT file_id, record_id, document_id, content_sha256, focus, question, answer, collection, CASE WHEN len(types) > 0 THEN 'redacted' ELSE 'not_detected' END AS pii_status, {_in_order('types')} AS pii_types FROM canon",
    "prepare_summary": f"""
        WITH RECURSIVE {_CANONICAL},
        ranked AS (SELECT *, file_id AS row_id, row_number() OVER (PARTITION BY content_sha256 ORDER BY relative_path, coalesce(question_id, ''), coalesce(pair_id, ''), record_id, file_id) AS rn FROM canon),
        {_LINKED}
        SELECT s.split, count(a.row_id) AS records, count(DISTINCT a.document_id) AS documents FROM (VALUES ('train'), ('validation'), ('test')) s(split) LEFT JOIN assigned a USING (split) GROUP BY 1
    """,
    "manifest_counts": f"""
        WITH RECURSIVE {_CANONICAL},
        ranked AS (SELECT *, file_id AS row_id, row_number() OVER (PARTITION BY content_sha256 ORDER BY relative_path, coalesce(question_id, ''), coalesce(pair_id, ''), record_id, file_id) AS rn FROM canon),
        {_LINKED}
        SELECT 'xml_files' AS name, count(*) AS value FROM medquad_documents
        UNION ALL SELECT 'canonical_records_before_deduplication', count(*) FROM canon UNION ALL SELECT 'canonical_records', count(*) FROM assigned
        UNION ALL SELECT 'exact_duplicates_removed', (SELECT count(*) FROM canon) - (SELECT count(*) FROM assigned)
        UNION ALL SELECT 'documents', count(DISTINCT document_id) FROM assigned UNION ALL SELECT 'split_components', count(DISTINCT component) FROM assigned
        UNION ALL SELECT 'pii_records_redacted_before_deduplication', count(*) FROM canon WHERE len(types) > 0 UNION ALL SELECT 'pii_records_redacted', count(*) FROM assigned WHERE len(types) > 0
        {" ".join(f"UNION ALL SELECT '{k}_overlap', (SELECT count(*) FROM (SELECT {v} FROM assigned GROUP BY 1 HAVING count(DISTINCT split) > 1))" for k, v in (("document_id", "document_id"), ("record_id", "record_id"), ("content_sha256", "content_sha256"), ("normalized_question", "q")))}
    """,
    "scan_counts": _STATS + " UNION ALL ".join([*(f"SELECT '{c}' AS name, sum({c})::BIGINT AS value FROM stats" for c in quality.COUNTERS), "SELECT 'collections_discovered', count(*) FROM stats", "SELECT 'rejection_records', sum(malformed_files + qa_pairs_rejected)::BIGINT FROM stats"]),
    "rejections": f"""
        WITH {_RAW} SELECT 'qa_pair' AS record_type, file_id, position, relative_path, collection, document_id, question_id, pair_id, nullif(question, '') AS question,
        concat_ws(',', CASE WHEN question = '' THEN 'missing_question' END, CASE WHEN answer = '' THEN 'missing_answer' END) AS reasons, NULL::VARCHAR AS error
        FROM pr WHERE question = '' OR answer = ''
    """,
    "collection_stats": _STATS + "SELECT * FROM stats",
    "summary_rollup": _STATS + f"SELECT coalesce(collection, '(all)') AS collection, {', '.join(f'sum({c})::BIGINT AS {c}' for c in quality.COUNTERS)} FROM stats GROUP BY ROLLUP (collection)",
    "question_type_histogram": f"WITH {_RAW}, {_GOOD} SELECT collection, coalesce(question_type, 'unknown') AS question_type, count(*) AS n_pairs FROM good GROUP BY ALL",
    "category_histogram": f"SELECT {_COLLECTION} AS collection, coalesce(nullif({_norm('category')}, ''), 'unknown') AS category, count(*) AS n_files FROM medquad_documents GROUP BY 1, 2",
    "pii_audit": f"""
        SELECT '1.0' AS policy_version, count(*) AS records_scanned, {", ".join(f"count(*) FILTER (curation.pii_status = '{s}') AS status_{s}" for s in ("not_evaluated", "not_detected", "detected", "redacted"))},
        {", ".join(f"count(*) FILTER (list_contains(curation.pii_types, '{t}')) AS type_{t}" for t in _TYPES)}, count(*) FILTER (curation.pii_status IN ('not_evaluated', 'detected')) AS unresolved FROM canonical_records
    """,
    "pii_findings": """
        SELECT record_id, document_id, source.relative_path AS source_relative_path, source.upstream_pair_id AS upstream_pair_id, array_to_string(curation.pii_types, ',') AS detected_types, 'redacted' AS action
        FROM canonical_records WHERE curation.pii_status = 'redacted'
    """,
    "constraint_violations": " UNION ALL ".join(f"SELECT '{name}' AS rule, count(*) FILTER (NOT coalesce({ok}, false)) AS n_violations FROM canonical_records" for name, ok in _RULES.items()),
    "keep_first": f"WITH {_REC} SELECT row_id, sha AS content_sha256, record_id FROM ranked WHERE rn = 1",
    "duplicate_trace": f"WITH {_REC} SELECT sha AS content_sha256, kept_record_id, kept_document_id, record_id AS dropped_record_id, document_id AS dropped_document_id FROM ranked WHERE rn > 1",
    "first_records": """
        SELECT row_id, record_id FROM canonical_records
        ORDER BY coalesce(source.relative_path, ''), coalesce(source.upstream_question_id, ''), coalesce(source.upstream_pair_id, ''), record_id, row_id LIMIT 100
    """,
    "components": _COMPONENTS + "SELECT document_id, component FROM comp",
    "component_split": _COMPONENTS + "SELECT row_id, document_id, component, round(position, 9) AS position, split FROM assigned",
    "split_counts": _COMPONENTS + "SELECT s.split, count(a.row_id) AS records, count(DISTINCT a.document_id) AS documents FROM (VALUES ('train'), ('validation'), ('test')) s(split) LEFT JOIN assigned a USING (split) GROUP BY 1",
    "collection_split_counts": _COMPONENTS + "SELECT split, source.collection AS collection, count(*) AS records FROM assigned GROUP BY 1, 2",
    "leakage_report": _COMPONENTS
    + " UNION ALL ".join(
        f"SELECT '{k}' AS kind, (SELECT count(*) FROM (SELECT {v} FROM assigned GROUP BY 1 HAVING count(DISTINCT split) > 1)) AS overlap"
        for k, v in (("document_id", "document_id"), ("record_id", "record_id"), ("content_sha256", "sha"), ("normalized_question", "q"))
    ),
    "index_text": "SELECT row_id, CASE WHEN focus <> '' THEN 'Medical topic: ' || focus || chr(10) ELSE '' END || 'Question: ' || coalesce(question, '') || chr(10) || 'Answer: ' || coalesce(answer, '') AS index_text FROM canonical_records",
    "cosine_distance": "WITH r AS (SELECT CAST(embedding AS DOUBLE[]) AS v FROM embeddings ORDER BY vec_id LIMIT 1) SELECT vec_id, round(list_cosine_distance(CAST(embedding AS DOUBLE[]), r.v), 6) AS distance FROM embeddings, r",
    "vector_top_k": """
        WITH d AS (SELECT q.vec_id AS query_id, v.vec_id, round(list_cosine_distance(CAST(q.embedding AS DOUBLE[]), CAST(v.embedding AS DOUBLE[])), 6) AS distance
            FROM embeddings q, embeddings v WHERE q.vec_id % 50 = 0),
        k AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS rank FROM d)
        SELECT query_id, vec_id, distance, rank FROM k WHERE rank <= 5
    """,
    "vector_upsert": "SELECT vec_id, label + 1 AS label, len(embedding) AS dimension FROM embeddings UNION ALL SELECT -vec_id - 1, label, len(embedding) FROM embeddings",
    "collection_count": "SELECT count(*) AS delivered, 2 * count(*) AS collection_records FROM embeddings",
}
