import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinweave.cli import main
from clinweave.config import EmbeddingSettings, SplitConfig, StoreSettings
from clinweave.errors import ConfigurationError
from clinweave.operators import canonical, dedup, quality, reports, splits
from clinweave.operators.components import connected_components
from clinweave.plans import skew
from clinweave.plans.scratch import materialize

PAIR = "struct<position:int,pair_id:string,question_id:string,question_type:string,question:string,answer:string>"
DOC = (
    "file_id long, relative_path string, document_id string, publisher string, source_url string, focus string, category string, synonyms array<string>,"
    f" umls_cuis array<string>, umls_semantic_types array<string>, umls_semantic_groups array<string>, pairs array<{PAIR}>"
)


def documents(spark, files):
    rows = [(i, path, None, None, None, focus, None, None, None, None, None, pairs) for i, (path, focus, pairs) in enumerate(files)]
    return spark.createDataFrame(rows, DOC)


def pair(n, q, a, pid=None):
    return (n, str(n) if pid is None else pid, f"q{n}", None, q, a)


def test_prepare_keeps_the_first_and_links_documents(spark):
    docs = documents(
        spark,
        [
            ("s/a.xml", "x", [pair(1, "What is A?", "One."), pair(2, "What  is B?", "Two.")]),
            ("s/b.xml", None, [pair(1, "What is A?", "One."), pair(2, "what is c ?", "Three.")]),
            ("s/c.xml", " ", [pair(1, "What is C?", "Four."), pair(2, "", "no question"), None]),
            ("s/d.xml", "x", [pair(1, "Alone?", "mail a@b.co")]),
            ("s/e.xml", "x", None),
            ("s/f.xml", "x", []),
        ],
    )
    done = reports.prepare(docs)
    assert done.before.count() == 6 and done.records.count() == 5 and done.removals.count() == 1
    homes = {r.source.relative_path: r.component for r in done.records.collect()}
    # after the duplicate of a.xml is gone, b.xml is linked to c.xml only
    assert homes["s/b.xml"] == homes["s/c.xml"] != homes["s/a.xml"] and len(set(homes.values())) == 3
    assert done.findings.count() == 1 and all(r.overlap == 0 for r in splits.leakage_report(done.records).collect())
    made = reports.manifest(done, SplitConfig(), 6, "here")
    assert made["summary"]["exact_duplicates_removed"] == 1 and made["summary"]["split_components"] == 3
    assert sum(made["summary"]["records_by_split"].values()) == 5 and set(made["validation"].values()) == {0}
    json.dumps(made)


def test_lexical_order_decides(spark):
    docs = documents(spark, [("p/x.xml", None, [pair(1, "Q?", "A.", "2"), pair(2, "Q?", "A.", "10")])])
    docs = docs.withColumn("pairs", F.transform("pairs", lambda p: p.withField("question_id", F.lit("same"))))
    before = materialize(canonical.canonicalize(canonical.raw_pairs(docs)))
    assert dedup.keep_first(before).first().source.upstream_pair_id == "10"
    gone = dedup.removals(before).first()
    assert gone.kept_record_id == dedup.keep_first(before).first().record_id != gone.dropped_record_id


def test_seed_changes_and_repeats(spark):
    docs = documents(spark, [(f"p/{i}.xml", None, [pair(1, f"Question {i}?", "A.")]) for i in range(60)])
    kept = materialize(canonical.canonicalize(canonical.raw_pairs(docs)))

    def run(seed):
        return sorted((r.record_id, r.split) for r in splits.assign(kept, SplitConfig(seed=seed)).collect())

    assert run(1) == run(1) != run(2)


def test_types_in_order_of_appearance_and_synonyms(spark):
    docs = documents(spark, [("p/x.xml", "SSN 541-72-3306", [pair(1, "mail a@b.co?", "fine")])]).withColumn("synonyms", F.array(F.lit(" s "), F.lit("s"), F.lit(""), F.lit("DOB: 1980-01-01")))
    r = canonical.canonicalize(canonical.raw_pairs(docs)).first()
    assert r.curation.pii_types == ["us_ssn", "email_address", "date_of_birth"] and r.synonyms == ["s", "DOB: [REDACTED_DATE_OF_BIRTH]"]
    assert r.curation.transformations == ["whitespace_normalized", "pii_redacted"]


def test_empty_tables(spark):
    none = documents(spark, []).limit(0)
    done = reports.prepare(none)
    assert done.records.count() == 0 and [r.records for r in splits.split_counts(done.records).collect()] == [0, 0, 0]
    assert quality.summary(quality.collection_stats(reports.typed_files(none), canonical.raw_pairs(none))).filter("qa_pairs_total > 0").count() == 0


def test_extra_columns_do_not_clash(spark):
    docs = documents(spark, [("p/x.xml", None, [pair(1, "Q?", "A.")])]).withColumns({"n": F.lit(1), "u": F.lit(2), "rank": F.lit(3)})
    assert reports.prepare(docs).records.count() == 1


@pytest.mark.parametrize("seed", range(3))
def test_components_equal_union_find(spark, seed):
    rng = random.Random(seed)
    chain = [(f"n{i:03}", f"n{i + 1:03}") for i in range(40)]
    links = chain + [(f"m{rng.randrange(60):02}", f"m{rng.randrange(60):02}") for _ in range(45)] + [("h", f"h{i}") for i in range(30)] + [(None, "x"), ("y", "y")]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        if a and b and a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a string, b string")).collect()}
    assert got == {x: find(x) for x in parent}


def test_hot_keys_are_joined_apart(spark, monkeypatch):
    monkeypatch.setattr(skew, "LEAST_HOT_ROWS", 10)
    monkeypatch.setattr(skew, "MOST_HOT_KEYS", 3)
    rows = materialize(spark.range(90).select(F.when(F.col("id") < 60, 0).when(F.col("id") < 85, F.col("id")).alias("k"), F.col("id").alias("v")))
    stats = rows.groupBy("k").agg(F.count("*").alias("n"), F.max("v").alias("top")).filter("k is null or k <> 70")
    got = skew.join_by_key_stats(rows, materialize(stats), ["k"], "n", 90)
    assert got.count() == 60 + 24 and got.filter("k = 0").agg(F.max("top")).first()[0] == 59


def test_hot_keys_meet_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(skew, "LEAST_HOT_ROWS", 10)
    left = materialize(spark.range(100).select(F.when(F.col("id") < 60, "hot").when(F.col("id") < 95, F.col("id").cast("string")).alias("k"), F.col("id").alias("x")))
    right = materialize(spark.range(80).select(F.when(F.col("id") < 35, "hot").otherwise((F.col("id") + 20).cast("string")).alias("k"), F.col("id").alias("y")))
    got = [tuple(r) for r in skew.join_in_blocks(left, right, ["k"]).select("x", "y").collect()]
    assert len(got) == len(set(got)) and set(got) == {(x, y) for x in range(60) for y in range(35)} | {(x, x - 20) for x in range(60, 95)}
    assert skew.join_in_blocks(left.limit(0), right, ["k"]).count() == 0


def test_constraints_count_nulls(spark):
    schema = "schema_version string, record_id string, document_id string, content_sha256 string, language string, question string, answer string"
    row = ("1.1", None, "no", "A" * 64, "en", " ", "x")
    df = spark.createDataFrame([row], schema).withColumns(
        {c: F.array(F.lit("a"), F.lit("a")) for c in canonical.LISTS}
        | {
            "source": F.struct(F.lit("MedQuAD").alias("dataset"), F.lit(None).cast("string").alias("license")),
            "curation": F.struct(F.lit("accepted").alias("status"), F.lit("redacted").alias("pii_status"), F.lit(None).cast(T.ArrayType(T.StringType())).alias("pii_types")),
        }
    )
    bad = {r.rule for r in canonical.constraint_violations(df).collect() if r.n_violations}
    assert bad == {"redacted_has_types", "question_not_blank", "license", "record_id_format", "document_id_format", "content_sha256_format", *(f"{c}_unique" for c in canonical.LISTS)}


def test_settings():
    assert EmbeddingSettings.of({"EMBEDDING_DIMENSION": " 3 "}).dimension == 3 and EmbeddingSettings.of({}).dimension == 384
    for text, on in ((" Yes ", True), ("1", True), ("ON", True), ("off", False), ("0", False), ("", False)):
        assert StoreSettings.of({"STORE_READ_ONLY": text}).read_only is on
    for env in ({"EMBEDDING_DIMENSION": "0"}, {"EMBEDDING_DIMENSION": "x"}, {"EMBEDDING_BATCH_SIZE": "-1"}):
        with pytest.raises(ConfigurationError, match="whole number above zero"):
            EmbeddingSettings.of(env)
    for env in ({"STORE_READ_ONLY": "maybe"}, {"STORE_MODE": "elsewhere"}):
        with pytest.raises(ConfigurationError):
            StoreSettings.of(env)
    with pytest.raises(ConfigurationError, match="STORE_TENANT, STORE_API_KEY"):
        StoreSettings.of({"STORE_MODE": "cloud", "STORE_DATABASE": "d"})
    shown = repr(StoreSettings.of({"STORE_MODE": "Cloud", "STORE_TENANT": "t", "STORE_DATABASE": "d", "STORE_API_KEY": "secret"}))
    assert "secret" not in shown and "mode='cloud'" in shown


def test_commands_read_the_environment(spark, tmp_path, capsys, monkeypatch):
    monkeypatch.setenv("STORE_PATH", str(tmp_path / "s"))
    monkeypatch.setenv("STORE_COLLECTION", "mine")
    monkeypatch.setenv("EMBEDDING_DIMENSION", "8")
    assert main(["health"]) == 0 and json.loads(capsys.readouterr().out) == {"status": "ok", "collection_records": 0}
    monkeypatch.setenv("EMBEDDING_PROVIDER", "nowhere:nothing")
    assert main(["health"]) == 0 and main(["search", "x"]) == 2
    monkeypatch.setenv("EMBEDDING_PROVIDER", "clinweave.operators.embedding:hashing_embedder")
    assert main(["search", "x"]) == 2 and "empty" in capsys.readouterr().err
    monkeypatch.setenv("STORE_MODE", "cloud")
    assert main(["health"]) == 2


def test_commands(spark, tmp_path, capsys):
    from tests.test_sources import CURRENT, LEGACY

    (tmp_path / "in" / "c").mkdir(parents=True)
    (tmp_path / "in" / "c" / "a.xml").write_text(CURRENT)
    (tmp_path / "in" / "c" / "b.xml").write_text(LEGACY)
    out = tmp_path / "out"
    assert main(["scan", "--source", str(tmp_path / "in"), "--output", str(out)]) == 0
    assert json.loads((out / "report.json").read_text())["summary"]["qa_pairs_accepted"] == 3
    assert main(["prepare", "--source", str(tmp_path / "in"), "--output", str(out)]) == 0
    assert json.loads((out / "manifest.json").read_text())["summary"]["canonical_records"] == 2
    lines = [json.loads(x) for p in (out / "canonical.jsonl").glob("part-*.json") for x in p.read_text().splitlines()]
    assert len(lines) == 2 and list(lines[0]) == sorted(lines[0]) and "upstream_revision" in lines[0]["source"]
    store = ["--store", str(tmp_path / "store"), "--dimension", "32"]
    for split in ("train", "validation", "test"):
        assert main(["index", "--prepared", str(out), "--split", split, *store]) == 0
    capsys.readouterr()
    assert main(["health", *store]) == 0
    assert json.loads(capsys.readouterr().out)["collection_records"] == 2
    assert main(["search", "What is flu?", "--limit", "1", *store]) == 0
    assert "flu" in json.loads(capsys.readouterr().out)[0]["text"]
    assert main(["search", "  ", *store]) == 2
    assert main(["scan", "--source", str(tmp_path / "none"), "--output", str(out)]) == 2
