"""Question-answer documents from XML files of both layouts, as raw documents with nested pairs."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from xml.etree import ElementTree
from xml.parsers import expat

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinweave.errors import DatasetPreparationError, ScanError
from clinweave.operators.canonical import collection_of

PAIR = pa.struct([("position", pa.int32()), *((n, pa.string()) for n in ("pair_id", "question_id", "question_type", "question", "answer"))])
_TEXTS = ("document_id", "publisher", "source_url", "focus", "category")
_LISTS = ("synonyms", "umls_cuis", "umls_semantic_types", "umls_semantic_groups")
PARSED = ", ".join([*(f"{n} string" for n in _TEXTS), *(f"{n} array<string>" for n in _LISTS), "pairs array<struct<position:int,pair_id:string,question_id:string,question_type:string,question:string,answer:string>>", "parse_error string"])

# Where the two layouts keep each field. Names that come first win.
ATTRIBUTES = {"document_id": ("id", "docid", "fid"), "publisher": ("source", "corpus"), "source_url": ("url",)}
CHILDREN = {"focus": (("Focus",), ("doctitle-focus",)), "category": (("FocusAnnotations", "Category"), ("Category",))}
DESCENDANTS = {
    "synonyms": ("Synonym", "synonym"), "umls_cuis": ("CUI", "cui"),
    "umls_semantic_types": ("SemanticType", "semanticType"), "umls_semantic_groups": ("SemanticGroup", "semanticGroup"),
}
PAIRS = ("QAPair", "pair")
QUESTIONS, ANSWERS = (("Question",), ("question",)), (("Answer",), ("answer",))


def _tidy(*pieces: str | None) -> str:
    """Pieces of text joined by a blank, with runs of white space as one blank."""
    return " ".join(word for piece in pieces if piece for word in piece.split())


def _text(node: ElementTree.Element | None) -> str:
    return _tidy(*node.itertext()) if node is not None else ""


def _named(node: ElementTree.Element | None, names: tuple[str, ...]) -> str | None:
    """The first attribute of that name that says something."""
    said = [_tidy(node.get(name)) for name in names] if node is not None else []
    return next(filter(None, said), None)


def _below(node: ElementTree.Element, ways: tuple[tuple[str, ...], ...]) -> ElementTree.Element | None:
    """The element at the end of the first way down that exists, empty or not."""
    for way in ways:
        level = [node]
        for tag in way:
            level = [child for parent in level for child in parent if child.tag == tag]
        if level:
            return level[0]
    return None


def _tree(data: bytes) -> ElementTree.Element:
    """The root of a well-formed file; the parser itself refuses entity declarations, in any encoding."""

    def refuse(*_: object) -> None:
        raise ValueError("entity declarations are not allowed")

    guard = expat.ParserCreate()
    guard.EntityDeclHandler = refuse
    try:
        guard.Parse(data, True)
        return ElementTree.fromstring(data)
    except (expat.ExpatError, ElementTree.ParseError, LookupError, UnicodeError) as e:
        raise ValueError(str(e)) from e


def parse_document(data: bytes) -> dict:
    """The fields of one file; raises ValueError for what is not well-formed or declares entities."""
    root = _tree(data)
    by_tag: dict[str, list[ElementTree.Element]] = {}
    for node in root.iter():  # one walk, in document order
        by_tag.setdefault(node.tag, []).append(node)
    found: dict = {name: _named(root, names) for name, names in ATTRIBUTES.items()}
    found |= {name: _text(_below(root, ways)) or None for name, ways in CHILDREN.items()}
    for name, tags in DESCENDANTS.items():
        texts = (_text(node) for tag in tags for node in by_tag.get(tag, ()) if node is not root)
        found[name] = list(dict.fromkeys(filter(None, texts)))
    found["pairs"] = []
    for node in (node for tag in PAIRS for node in by_tag.get(tag, ())):
        question = _below(node, QUESTIONS)
        texts = {"question": _text(question), "answer": _text(_below(node, ANSWERS))}
        ids = {"pair_id": _named(node, ("pid",)), "question_id": _named(question, ("qid",)), "question_type": _named(question, ("qtype",))}
        found["pairs"].append({"position": len(found["pairs"]) + 1} | ids | texts)
    return found


def parse_files(files: DataFrame, key: str = "relative_path") -> DataFrame:
    """Raw documents from (key, content binary); a malformed file has ``parse_error`` and nulls."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, errors = [], []
            for data in b.column(1).to_pylist():
                try:
                    rows.append(parse_document(data or b""))
                    errors.append(None)
                except ValueError as e:
                    rows.append({})
                    errors.append(str(e))
            columns = [pa.array([r.get(n) for r in rows], pa.string()) for n in _TEXTS] + [pa.array([r.get(n) for r in rows], pa.list_(pa.string())) for n in _LISTS]
            yield pa.RecordBatch.from_arrays([b.column(0), *columns, pa.array([r.get("pairs") for r in rows], pa.list_(PAIR)), pa.array(errors, pa.string())], names=[key, *_TEXTS, *_LISTS, "pairs", "parse_error"])

    return files.select(key, "content").mapInArrow(run, f"{key} {files.schema[key].dataType.simpleString()}, {PARSED}")


def discover(spark: SparkSession, root: str) -> DataFrame:
    """(relative_path, content) of every .xml file below ``root``. Spark skips names that begin with a dot or underscore."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        raise ScanError("the source does not exist")
    if not fs.getFileStatus(path).isDirectory():
        raise ScanError("the source is not a folder")
    base = fs.resolvePath(path).toUri().getPath().rstrip("/")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.xml").load(root)
    full = F.regexp_replace("path", r"^[a-z0-9]+:(//[^/]*)?", "")
    files = files.select(F.substring(full, F.lit(len(base) + 2), F.length(full)).alias("relative_path"), "content")
    if files.isEmpty():
        raise ScanError("the source has no XML file")
    return files


def read_documents(spark: SparkSession, root: str, strict: bool = False) -> DataFrame:
    """Parsed files with collection and parse_error; ``strict`` raises at the first malformed file in path order."""
    parsed = parse_files(discover(spark, root)).withColumn("collection", collection_of(F.col("relative_path")))
    if strict:
        bad = parsed.filter("parse_error is not null").orderBy("relative_path").select("relative_path").first()
        if bad:
            raise DatasetPreparationError(f"malformed file: {bad.relative_path}")
    return parsed
