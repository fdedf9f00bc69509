"""The registered queries of this subpackage and, where SQL can say it, the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinweave.llm import copies, groups, leaks, overlap, pairs, pii, spans, tokens
from clinweave.plans.scratch import materialize

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return pairs.defective_pairs(_table(spark, folder, "canonical_records"))


def p1_counts(spark: SparkSession, folder: str) -> DataFrame:
    return pairs.defect_counts(_table(spark, folder, "canonical_records"))


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return groups.linked_documents(_table(spark, folder, "canonical_records"))


def p2_splits(spark: SparkSession, folder: str) -> DataFrame:
    return groups.assign_splits(_table(spark, folder, "canonical_records"), _table(spark, folder, "split_config"))


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    return overlap.cross_split_pairs(_table(spark, folder, "canonical_records"), _table(spark, folder, "record_splits"))


def p3_report(spark: SparkSession, folder: str) -> DataFrame:
    return overlap.overlap_report(_table(spark, folder, "canonical_records"), _table(spark, folder, "record_splits"))


def p3_classes(spark: SparkSession, folder: str) -> DataFrame:
    """Each assigned row with the class of its question and the number of its links across the splits."""
    return overlap.row_classes(_table(spark, folder, "canonical_records"), _table(spark, folder, "record_splits"))


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    return pii.found_types(_table(spark, folder, "canonical_records"))


def p4_redacted(spark: SparkSession, folder: str) -> DataFrame:
    return pii.redact(_table(spark, folder, "canonical_records"))


def p4_report(spark: SparkSession, folder: str) -> DataFrame:
    return pii.redaction_report(_table(spark, folder, "canonical_records"))


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    return copies.find_copies(_table(spark, folder, "canonical_records"))


def p6_collapsed(spark: SparkSession, folder: str) -> DataFrame:
    return copies.collapse_copies(_table(spark, folder, "canonical_records"))


def p7_ids(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.encode_corpus(_table(spark, folder, "documents"))


def p7_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Per document: number of ids, and whether decoding them gives the text again."""
    documents = _table(spark, folder, "documents")
    encoded = materialize(tokens.encode_corpus(documents), "encoded")
    decoded = tokens.decode_corpus(encoded).withColumnRenamed("text", "decoded")
    both = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(decoded, "doc_id").join(encoded, "doc_id")
    return both.select("doc_id", F.size("ids").alias("n_ids"), (F.col("text") == F.col("decoded")).alias("same_text"))


def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    return leaks.leaked_items(_table(spark, folder, "documents"), _table(spark, folder, "eval_items"))


def p8_report(spark: SparkSession, folder: str) -> DataFrame:
    return leaks.leak_report(_table(spark, folder, "documents"), _table(spark, folder, "eval_items"))


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    return spans.shared_spans(_table(spark, folder, "documents"))


def p9_share(spark: SparkSession, folder: str) -> DataFrame:
    return spans.shared_share(_table(spark, folder, "documents"))


def p9_removed(spark: SparkSession, folder: str) -> DataFrame:
    """The sentences that a repeated run of sentences covers which is not the first of its kind."""
    return spans.removable(_table(spark, folder, "documents"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (p1_found, p1_counts, p2_found, p2_splits, p3_found, p3_report, p3_classes, p4_found, p4_redacted, p4_report, p6_found, p6_collapsed, p7_ids, p7_round_trip, p8_found, p8_report, p9_found, p9_share, p9_removed)
}

_PLAIN_ID = r"nullif(regexp_replace(lower({0}), '^[{{}}\s]+|[{{}}\s]+$', '', 'g'), '')"
_BARE = "lower(regexp_replace(coalesce({0}, ''), '[^\\p{{L}}\\p{{N}}]', '', 'g'))"
_COPIES = f"""
    WITH k AS (SELECT row_id, {_BARE.format("question")} AS q, {_BARE.format("answer")} AS a FROM canonical_records),
    g AS (SELECT row_id, min(row_id) OVER (PARTITION BY least(q, a), greatest(q, a)) AS first_row_id FROM k)
"""
_SPANS = """
    WITH w AS (SELECT doc_id, i, substr(text, i, 200) AS s FROM documents, unnest(range(1, length(text) - 198)) AS r(i) WHERE length(text) >= 200),
    shared AS (SELECT s FROM w GROUP BY s HAVING min(doc_id) < max(doc_id)),
    hit AS (SELECT doc_id, i, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 200 THEN 0 ELSE 1 END AS fresh FROM w SEMI JOIN shared USING (s)),
    part AS (SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS n FROM hit),
    found AS (SELECT doc_id, min(i) - 1 AS span_start, max(i) + 199 AS span_end FROM part GROUP BY doc_id, n)
"""

_LINKED = f"""
    WITH RECURSIVE plain AS (SELECT row_id, {_PLAIN_ID.format("record_id")} AS r, {_PLAIN_ID.format("document_id")} AS d FROM canonical_records), ids AS (SELECT DISTINCT r, d FROM plain),
    links AS (SELECT DISTINCT x.d AS a, y.d AS b FROM ids x JOIN ids y ON x.r = y.r AND x.d <> y.d),
    reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
"""


def _draws(left: str) -> str:
    """Splits in the order of their draws, with the list ``left`` as weights."""
    u = "(('0x' || substr(md5(c.seed_value || ':' || c.split_name || ':' || g.group_key), 1, 13))::UBIGINT::DOUBLE + 0.5) / 4503599627370496"
    return f"(SELECT list({{'d': -ln({u}) / greatest({left}[c.nth], 1e-9), 'nth': c.nth}} ORDER BY -ln({u}) / greatest({left}[c.nth], 1e-9), c.nth) FROM conf c)"


SQL: dict[str, str] = {
    "p2_splits": f"""
        {_LINKED}, root AS (SELECT a AS d, min(b) AS root FROM reach GROUP BY a),
        home AS (SELECT m.r, coalesce(root, m.d) AS home FROM (SELECT r, min(d) AS d FROM ids WHERE r IS NOT NULL AND d IS NOT NULL GROUP BY r) m LEFT JOIN root USING (d)),
        grouped AS (SELECT row_id, CASE WHEN p.d IS NOT NULL THEN coalesce(root, p.d) WHEN p.r IS NOT NULL THEN coalesce(home, 'record:' || p.r) ELSE 'row:' || row_id END AS group_key
            FROM plain p LEFT JOIN root ON p.d = root.d LEFT JOIN home ON p.r = home.r),
        conf AS (SELECT *, row_number() OVER (ORDER BY split_name) AS nth FROM (SELECT DISTINCT split_name, ratio, seed_value FROM split_config)),
        share AS (SELECT list(ratio ORDER BY nth) AS ratios, list(ratio / (SELECT sum(ratio) FROM conf) * (SELECT count(*) FROM plain) ORDER BY nth) AS room FROM conf),
        sized AS (SELECT group_key, count(*) AS n FROM grouped GROUP BY 1),
        large AS (SELECT *, row_number() OVER (ORDER BY n DESC, group_key) AS k FROM (SELECT group_key, n, {_draws("(SELECT ratios FROM share)")} AS draws FROM sized g WHERE n >= greatest(2, 0.002 * (SELECT count(*) FROM plain)))),
        fill AS (
            SELECT 0::BIGINT AS k, NULL::VARCHAR AS group_key, NULL::BIGINT AS nth, room AS l FROM share
            UNION ALL SELECT k, group_key, nth, list_transform(l, lambda x, i: CASE WHEN i = nth THEN x - n ELSE x END)
            FROM (SELECT x.k, x.group_key, x.n, f.l, coalesce(list_filter(x.draws, lambda y: f.l[y.nth] >= x.n)[1].nth, list_position(f.l, list_max(f.l)))::BIGINT AS nth FROM fill f JOIN large x ON x.k = f.k + 1)),
        rest AS (SELECT l FROM fill ORDER BY k DESC LIMIT 1),
        drawn AS (SELECT group_key, {_draws("(SELECT l FROM rest)")}[1].nth AS nth FROM sized g)
        SELECT row_id, group_key, split_name FROM grouped JOIN drawn d USING (group_key) LEFT JOIN fill f USING (group_key) JOIN conf ON conf.nth = coalesce(f.nth, d.nth)
    """,
    "p2_found": f"""
        {_LINKED} SELECT min(b) AS group_document_id, a AS document_id FROM reach GROUP BY a HAVING min(b) < a
    """,
    "p6_found": _COPIES + "SELECT first_row_id, row_id FROM g WHERE row_id <> first_row_id",
    "p6_collapsed": _COPIES + "SELECT first_row_id, count(*) AS n_copies FROM g GROUP BY first_row_id",
    "p8_found": r"""
        WITH d AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM documents WHERE text IS NOT NULL),
        t AS (SELECT item_id, regexp_extract_all(lower(item_text), '[\p{L}\p{N}]+') AS w FROM eval_items),
        dw AS (SELECT doc_id, array_to_string(w[i:i + 11], ' ') AS s FROM d, unnest(range(1, len(w) - 10)) AS r(i)),
        tw AS (SELECT item_id, array_to_string(w[i:i + 11], ' ') AS s FROM t, unnest(range(1, len(w) - 10)) AS r(i))
        SELECT DISTINCT doc_id, item_id FROM dw JOIN tw USING (s)
    """,
    "p9_found": _SPANS + "SELECT * FROM found",
    "p9_share": _SPANS
    + """
        SELECT d.doc_id, coalesce(length(d.text), 0) AS n_chars, coalesce(x.c, 0)::BIGINT AS shared_chars,
               round(CASE WHEN coalesce(length(d.text), 0) > 0 THEN coalesce(x.c, 0) / length(d.text) ELSE 0 END, 6) AS shared_fraction
        FROM documents d LEFT JOIN (SELECT doc_id, sum(span_end - span_start) AS c FROM found GROUP BY doc_id) x USING (doc_id)
    """,
}
