import pytest

from clinweave.errors import DatasetPreparationError, ScanError
from clinweave.operators import canonical, quality, reports
from clinweave.sources import medquad_xml as X
from clinweave.sources.provenance import read_provenance

CURRENT = """<Document id="d1" source="S" url="u"><Focus>Flu</Focus><FocusAnnotations><UMLS><CUIs><CUI>C1</CUI><CUI> C1 </CUI><CUI>C2</CUI></CUIs>
<SemanticTypes><SemanticType>T1</SemanticType></SemanticTypes><SemanticGroup>Disorders</SemanticGroup></UMLS><Synonyms><Synonym>Grippe</Synonym></Synonyms><Category>Disease</Category></FocusAnnotations>
<QAPairs><QAPair pid="1"><Question qid="q1" qtype="information">What <i>is</i> flu?</Question><Answer>A  viral\ninfection.</Answer></QAPair>
<QAPair pid="2"><Question qid="q2">What is flu?</Question><Answer> A viral infection. </Answer></QAPair>
<QAPair pid="3"><Question qid="q3">Empty?</Question><Answer>  </Answer></QAPair><QAPair pid="4"><Answer>No question.</Answer></QAPair></QAPairs></Document>"""
LEGACY = """<doc docid="d2" corpus="C"><doctitle-focus>Cold</doctitle-focus><umls><cui>C9</cui></umls><qaPairs><pair pid="7"><question qid="x" qtype="y">What is a cold?</question><answer>Mild.</answer></pair></qaPairs></doc>"""


@pytest.fixture()
def tree(tmp_path):
    (tmp_path / "1_A" / "deep").mkdir(parents=True)
    (tmp_path / "1_A" / "a b%+.xml").write_text(CURRENT)
    (tmp_path / "1_A" / "deep" / "bad.xml").write_text("<Document>")
    (tmp_path / "top.xml").write_text(LEGACY)
    (tmp_path / "note.txt").write_text("no")
    return tmp_path


def test_both_layouts():
    d = X.parse_document(CURRENT.encode())
    assert (d["document_id"], d["publisher"], d["source_url"], d["focus"], d["category"]) == ("d1", "S", "u", "Flu", "Disease")
    assert d["umls_cuis"] == ["C1", "C2"] and d["synonyms"] == ["Grippe"]
    assert [(p["position"], p["question"], p["answer"]) for p in d["pairs"]] == [(1, "What is flu?", "A viral infection."), (2, "What is flu?", "A viral infection."), (3, "Empty?", ""), (4, "", "No question.")]
    e = X.parse_document(LEGACY.encode())
    assert (e["document_id"], e["publisher"], e["focus"], e["pairs"][0]["question_type"]) == ("d2", "C", "Cold", "y")


def test_shadowing_and_order():
    both = b"<doc><Focus></Focus><doctitle-focus>x</doctitle-focus><pair><question>b</question></pair><QAPair><Question>a</Question></QAPair></doc>"
    d = X.parse_document(both)
    assert d["focus"] is None and [p["question"] for p in d["pairs"]] == ["a", "b"]


@pytest.mark.parametrize("bad", [b"", b"<a>", b"<!DOCTYPE a [<!ENTITY x 'y'>]><a>&x;</a>", b"\xff\xfe\x00", "<?xml version='1.0' encoding='utf-16'?><!DOCTYPE a [<!ENTITY x 'y'>]><a>&x;</a>".encode("utf-16")])
def test_malformed(bad):
    with pytest.raises(ValueError):
        X.parse_document(bad)


def test_only_declared_entities_are_refused():
    d = X.parse_document("<?xml version='1.0' encoding='utf-16'?><doc id=' x '><!-- <!ENTITY no 'y'> --><Synonym>a &amp; b</Synonym><synonym>c</synonym><Synonym> a  &amp; b</Synonym></doc>".encode("utf-16"))
    assert (d["document_id"], d["synonyms"], d["pairs"], d["category"]) == ("x", ["a & b", "c"], [], None)
    assert X.parse_document(b"<doc><FocusAnnotations/><FocusAnnotations><Category>x</Category></FocusAnnotations><Category>y</Category></doc>")["category"] == "x"


def test_scan_counts(spark, tree):
    files = X.read_documents(spark, str(tree))
    from pyspark.sql import functions as F

    files = files.withColumn("file_id", F.xxhash64("relative_path"))
    assert {r.relative_path for r in files.collect()} == {"1_A/a b%+.xml", "1_A/deep/bad.xml", "top.xml"}
    pairs = canonical.raw_pairs(files)
    report = reports.scan_report(files, pairs, str(tree))
    one = report["collections"]["1_A"]
    assert (one["xml_files_discovered"], one["xml_files_parsed"], one["malformed_files"], one["qa_pairs_total"], one["qa_pairs_accepted"], one["qa_pairs_rejected"]) == (2, 1, 1, 4, 2, 2)
    assert (one["missing_question"], one["missing_answer"], one["duplicate_question_occurrences"], one["duplicate_pair_occurrences"]) == (1, 1, 1, 1)
    assert one["categories"] == {"Disease": 1} and one["question_types"] == {"information": 1, "unknown": 1}
    assert report["summary"]["rejection_records"] == 3 and set(report["collections"]) == {"1_A", "root"}
    assert sorted(r.record_type for r in quality.rejections(files, pairs).collect()) == ["file", "qa_pair", "qa_pair"]


def test_strict_reading_and_source_errors(spark, tree, tmp_path_factory):
    with pytest.raises(DatasetPreparationError, match="bad.xml"):
        X.read_documents(spark, str(tree), strict=True)
    empty = tmp_path_factory.mktemp("empty")
    for source in (str(empty), str(empty / "none"), str(tree / "top.xml")):
        with pytest.raises(ScanError):
            X.discover(spark, source)


def test_provenance(tmp_path):
    git = tmp_path / ".git"
    assert read_provenance(str(tmp_path)) == (None, None)
    (git / "refs" / "heads").mkdir(parents=True)
    (git / "config").write_text('[remote "origin"]\n\turl = https://host.example/x.git\n')
    sha = "a" * 40
    (git / "HEAD").write_text(sha + "\n")
    assert read_provenance(str(tmp_path)) == ("https://host.example/x.git", sha)
    (git / "HEAD").write_text("ref: refs/heads/main\n")
    assert read_provenance(str(tmp_path))[1] is None
    (git / "packed-refs").write_text(f"# pack\n{sha} refs/heads/main\n")
    assert read_provenance(str(tmp_path))[1] == sha
    (git / "refs" / "heads" / "main").write_text("b" * 40)
    assert read_provenance(str(tmp_path))[1] == "b" * 40
    (git / "HEAD").write_text("AbC0" * 10)
    assert read_provenance(str(tmp_path))[1] == "AbC0" * 10
    (git / "HEAD").write_text("nonsense")
    assert read_provenance(str(tmp_path))[1] is None
