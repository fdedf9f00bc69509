"""Deeply nested records as related flat tables, by Dewey labelling.

Every node of a record gets an ordinal path, its Dewey label: ``[3, 1, 2]`` is the second child of the first child of
the record's third field. A node's parent is its label without the last number, and nodes with the same schema path
(field names, ``[]`` for list elements) form one table.

Node tables have the record's key, ``label`` array<int>, ``path`` string, ``kind`` (object, array, string, number,
boolean, null) and ``value`` (text of a leaf; null for objects, arrays and nulls).
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from json.decoder import scanstring

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NODE = "label array<int>, path string, kind string, value string"
_NODE_ARRAY = f"array<struct<label:array<int>,path:string,kind:string,value:string>>"


class _Number(str):
    """A number as it was written."""


class _Object(list):
    """The (name, value) pairs of an object, repeated names too."""


def _no_number(text: str) -> None:
    raise ValueError(f"{text} is no JSON")


_BLANKS = re.compile(r"[ \t\n\r]*")
_SCALAR = re.compile(r"(-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?)|true|false|null")
_WORDS = {"true": True, "false": False, "null": None}


def _parse_deep(text: str) -> object:
    """What the standard parser gives, for any depth: open containers stand on a list instead of the call stack."""
    out: list = []
    stack: list[tuple[list, str | None]] = [(out, None)]  # open containers, each with the name that waits for a value
    at = _BLANKS.match(text).end()

    def skip(at: int) -> int:
        return _BLANKS.match(text, at).end()

    def name(at: int) -> tuple[str, int]:
        if text[at : at + 1] != '"':
            raise ValueError("a name was expected")
        found, at = scanstring(text, at + 1, True)
        at = skip(at)
        if text[at : at + 1] != ":":
            raise ValueError("a colon was expected")
        return found, skip(at + 1)

    while True:
        inside, key = stack[-1]
        first = text[at : at + 1]
        if first == '"':
            value, at = scanstring(text, at + 1, True)
        elif first in ("{", "["):
            value, at = (_Object() if first == "{" else []), at + 1
        else:
            m = _SCALAR.match(text, at)
            if m is None:
                raise ValueError("a value was expected")
            value, at = _Number(m.group()) if m.group(1) else _WORDS[m.group()], m.end()
        inside.append(value if key is None else (key, value))
        at = skip(at)
        if first in ("{", "["):
            stack.append((value, None))
            if text[at : at + 1] != ("}" if first == "{" else "]"):
                if first == "{":
                    key, at = name(at)
                    stack[-1] = (value, key)
                continue
        while len(stack) > 1:  # after a value: the container goes on or ends
            inside = stack[-1][0]
            mark, at = text[at : at + 1], skip(at + 1)
            if mark == ",":
                if isinstance(inside, _Object):
                    key, at = name(at)
                    stack[-1] = (inside, key)
                break
            if mark != ("}" if isinstance(inside, _Object) else "]"):
                raise ValueError("a comma or an end was expected")
            stack.pop()
        else:
            if at < len(text):
                raise ValueError("something follows the value")
            return out[0]


def parse_json(text: str) -> object:
    """Objects as lists of pairs, numbers as written; ValueError for anything that is not one complete JSON value. Any depth."""
    try:
        return json.loads(text, object_pairs_hook=_Object, parse_float=_Number, parse_int=_Number, parse_constant=_no_number)
    except RecursionError:
        return _parse_deep(text)


def _json_nodes(value: object, wanted: frozenset[str] | None) -> list[tuple[list[int], str, str, str | None]]:
    """Nodes of a parsed record in document order, without recursion; only those at ``wanted`` schema paths, if given."""
    above = None
    if wanted is not None:
        above = {path[:i] for path in wanted for i in range(len(path) + 1)}
    out: list[tuple[list[int], str, str, str | None]] = []
    stack: list[tuple[object, list[int], str]] = [(value, [], "")]
    while stack:
        x, label, path = stack.pop()
        if isinstance(x, _Object):
            kind, children = "object", [(v, i, f"{path}.{k}" if path else k) for i, (k, v) in enumerate(x, 1)]
        elif isinstance(x, list):
            kind, children = "array", [(v, i, f"{path}[]") for i, v in enumerate(x, 1)]
        else:
            kind, children = "null" if x is None else "boolean" if isinstance(x, bool) else "number" if isinstance(x, _Number) else "string", []
        if wanted is None or path in wanted:
            text = None if x is None or isinstance(x, list) else str(x) if not isinstance(x, bool) else json.dumps(x)
            out.append((label, path, kind, text))
        stack += [(v, [*label, i], below) for v, i, below in reversed(children) if above is None or below in above]
    return out


def nodes_of_json(records: DataFrame, key: str, column: str, paths: Iterable[str] | None = None) -> DataFrame:
    """Nodes of the JSON text in ``column``; texts that are null or not complete JSON have none. Number literals keep their digits.

    With ``paths`` only the nodes at these schema paths are given. Labels grow with depth, so very deep records want that.
    """
    wanted = None if paths is None else frozenset(paths)

    def parse(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, labels, found, kinds, values = [], [], [], [], []
            for k, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                try:
                    nodes = _json_nodes(parse_json(text), wanted) if text else []
                except ValueError:
                    nodes = []
                for label, path, kind, value in nodes:
                    keys.append(k)
                    labels.append(label)
                    found.append(path)
                    kinds.append(kind)
                    values.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(labels, pa.list_(pa.int32())), pa.array(found, pa.string()), pa.array(kinds, pa.string()), pa.array(values, pa.string())],
                names=[key, "label", "path", "kind", "value"],
            )

    return records.select(F.col(key).cast("long").alias(key), column).mapInArrow(parse, f"{key} bigint, {NODE}")


def _node(label: Column, path: str, kind: Column, value: Column) -> Column:
    return F.array(F.struct(label.alias("label"), F.lit(path).alias("path"), kind.alias("kind"), value.cast("string").alias("value"))).cast(_NODE_ARRAY)


def _typed(value: Column, kind: T.DataType, label: Column, path: str, depth: int = 0) -> Column:
    """The nodes of a typed column as one array expression."""
    none = F.lit(None).cast("string")
    if isinstance(kind, T.ArrayType):
        inner = F.flatten(F.transform(value, lambda x, i: _typed(x, kind.elementType, F.concat(label, F.array((i + 1).cast("int"))), f"{path}[]", depth + 1)))
        here = _node(label, path, F.when(value.isNull(), "null").otherwise("array"), none)
        return F.when(value.isNull(), here).otherwise(F.concat(here, inner))
    if isinstance(kind, T.StructType):
        parts = [_typed(value[f.name], f.dataType, F.concat(label, F.array(F.lit(i).cast("int"))), f"{path}.{f.name}", depth + 1) for i, f in enumerate(kind.fields, 1)]
        here = _node(label, path, F.when(value.isNull(), "null").otherwise("object"), none)
        return F.when(value.isNull(), here).otherwise(F.concat(here, *parts))
    leaf = "number" if isinstance(kind, T.NumericType) else "boolean" if isinstance(kind, T.BooleanType) else "string"
    return _node(label, path, F.when(value.isNull(), "null").otherwise(leaf), value)


def nodes_of_columns(records: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Nodes of typed nested columns, by built-in expressions and one explode; no shuffle."""
    types = {f.name: f.dataType for f in records.schema.fields}
    parts = [_typed(F.col(c), types[c], F.array(F.lit(i).cast("int")), c) for i, c in enumerate(columns, 1)]
    return records.select(F.col(key).cast("long").alias(key), F.explode(F.concat(*parts)).alias("n")).select(key, "n.*")


def parent_label(label: Column) -> Column:
    """A label without its last number; null for a record's root."""
    return F.when(F.size(label) > 0, F.slice(label, 1, F.greatest(F.size(label) - 1, F.lit(0))))


def with_parents(nodes: DataFrame) -> DataFrame:
    """Adds ``parent`` (label) and ``place``, the node's 1-based place among its siblings."""
    return nodes.withColumn("parent", parent_label(F.col("label"))).withColumn("place", F.try_element_at("label", F.lit(-1)))


def flat_table(nodes: DataFrame, key: str, path: str, fields: list[str]) -> DataFrame:
    """The nodes at one schema path as a table: key, label, parent, place and the named scalar children as columns.

    One shuffle, by record and element. Fields that a node lacks are null; a repeated field keeps its first value.
    """
    tree = with_parents(nodes)
    own = tree.filter((F.col("path") == path) & (F.col("kind") != "null")).select(key, "label", "parent", "place")
    wanted = tree.filter(F.col("path").isin([f"{path}.{f}" for f in fields])).select(key, F.col("parent").alias("label"), F.substring_index("path", ".", -1).alias("f"), "value")
    picked = wanted.groupBy(key, "label").agg(*[F.first(F.when(F.col("f") == f, F.col("value")), ignorenulls=True).alias(f) for f in fields])
    return own.join(picked, [key, "label"], "left")


# The schema paths under which the known layouts keep their lists; sections are counted through.
LISTS = {
    "pair": ("pairs", "sections[].pairs", "sections.pairs", "Document.QAPairs.QAPair", "doc.qaPairs.pair"),
    "synonym": ("synonyms", "meta.focus.synonyms", "Document.FocusAnnotations.Synonyms.Synonym", "doc.synonym", "doc.synonyms.synonym"),
    "cui": ("umls_cuis", "meta.focus.umls_cuis", "Document.FocusAnnotations.UMLS.CUIs.CUI", "doc.umls.cui"),
}
KEYS = {"pair": ("pair_id", "@pid"), "synonym": ("#text", "text"), "cui": ("#text", "cui", "text")}


def _ends(fields: Iterable[str]) -> list[str]:
    """What follows a list's path at the nodes of its elements and their fields, in a list or bare."""
    return ["", "[]", *(f"{one}.{field}" for one in ("", "[]") for field in fields)]


def child_rows(nodes: DataFrame, key: str = "file_id") -> DataFrame:
    """(key, child_kind, child_pos, child_key) of the elements of the known lists.

    ``child_pos`` counts every delivered element, null and blank ones too; a list of one may stand bare. Pairs that
    are not null are kept with their id, or '' without one; synonyms and codes with their trimmed text unless blank.
    """
    element, place_of = [], F.lit(None).cast("string")
    for kind, paths in LISTS.items():
        for p in paths:
            element.append(((F.col("path") == f"{p}[]") | ((F.col("path") == p) & ~F.col("kind").isin("array", "null")), kind))
            for k in KEYS[kind]:
                place_of = F.when(F.col("path").isin(f"{p}[].{k}", f"{p}.{k}"), F.lit(f"{kind} {KEYS[kind].index(k)}")).otherwise(place_of)
    child_kind = F.coalesce(*[F.when(c, F.lit(k)) for c, k in element])
    tagged = nodes.select(key, "label", "kind", "value", child_kind.alias("child_kind"), place_of.alias("id_of")).filter("child_kind is not null or id_of is not null")
    own = F.col("child_kind").isNotNull()
    of_kind = F.coalesce("child_kind", F.substring_index("id_of", " ", 1))
    tagged = tagged.select(key, of_kind.alias("child_kind"), F.when(own, F.col("label")).otherwise(parent_label(F.col("label"))).alias("of"), own.alias("own"), "kind", "value", F.substring_index("id_of", " ", -1).alias("rank"))
    # one shuffle, by file and kind, serves both groupings; only ids and short texts of one file meet
    elements = tagged.repartition(key, "child_kind").groupBy(key, "child_kind", "of").agg(
        F.max(F.when(F.col("own"), F.col("kind"))).alias("kind"),
        F.max(F.when(F.col("own"), F.col("value"))).alias("value"),
        F.min(F.when(~F.col("own") & F.col("value").isNotNull(), F.struct("rank", "value")))["value"].alias("id"),
    )
    rows = elements.filter("kind is not null").groupBy(key, "child_kind").agg(F.array_sort(F.collect_list(F.struct("of", "kind", "value", "id"))).alias("elements"))
    rows = rows.select(key, "child_kind", F.posexplode("elements").alias("pos", "e"))
    text = F.coalesce(F.when(F.col("e.kind").isin("string", "number", "boolean"), F.col("e.value")), F.col("e.id"))
    bare = F.regexp_replace(text, r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")
    rows = rows.select(
        key, "child_kind", (F.col("pos") + 1).cast("long").alias("child_pos"), F.col("e.kind").alias("kind"),
        F.when(F.col("child_kind") == "pair", F.coalesce(text, F.lit(""))).otherwise(bare).alias("child_key"),
    )
    return rows.filter("kind <> 'null' and (child_kind = 'pair' or child_key <> '')").drop("kind")


def file_children(documents: DataFrame, payloads: DataFrame) -> DataFrame:
    """Children of the files of both deliveries: typed nested columns and raw JSON in several layouts."""
    pairs = F.transform("pairs", lambda p: F.when(p.isNotNull(), F.struct(p["pair_id"].alias("pair_id"))))
    typed = nodes_of_columns(documents.select("file_id", pairs.alias("pairs"), "synonyms", "umls_cuis"), "file_id", ["pairs", "synonyms", "umls_cuis"])
    raw = nodes_of_json(payloads, "file_id", "payload", [f"{p}{end}" for kind, paths in LISTS.items() for p in paths for end in _ends(KEYS[kind])])
    return child_rows(typed.unionByName(raw))


# The names under which the known layouts keep the fields of a pair.
PAIR_FIELDS = {
    "pair_id": ("pair_id", "@pid"),
    "question_id": ("question_id", "Question.@qid", "question.@qid"),
    "question_type": ("question_type", "Question.@qtype", "question.@qtype"),
    "question": ("question", "question.#text", "Question", "Question.#text"),
    "answer": ("answer", "answer.#text", "Answer", "Answer.#text"),
}


def pair_rows(documents: DataFrame, payloads: DataFrame, key: str = "file_id") -> DataFrame:
    """The pairs of the files of both deliveries: key, label, parent, place and the fields of PAIR_FIELDS.

    Every pair that is not null has a row, also one that stands bare. ``place`` counts the delivered elements, null ones too,
    through sections, as in ``child_rows``. Fields that a layout lacks are null.
    """
    nodes = nodes_of_columns(documents, key, ["pairs"]).unionByName(
        nodes_of_json(payloads, key, "payload", [f"{p}{end}" for p in LISTS["pair"] for end in _ends([way for ways in PAIR_FIELDS.values() for way in ways])])
    )
    none = F.lit(None).cast("string")
    element, field, depth = F.lit(False), none, F.lit(0)
    for p in LISTS["pair"]:
        element = element | (F.col("path") == f"{p}[]") | ((F.col("path") == p) & ~F.col("kind").isin("array", "null"))
        for name, ways in PAIR_FIELDS.items():
            for way in ways:
                here = F.col("path").isin(f"{p}[].{way}", f"{p}.{way}")
                field, depth = F.when(here, F.lit(name)).otherwise(field), F.when(here, F.lit(1 + way.count("."))).otherwise(depth)
    leaf = F.col("kind").isin("string", "number", "boolean")
    tagged = nodes.select(key, "label", "kind", "value", element.alias("element"), F.when(leaf, field).alias("field"), depth.alias("depth"))
    tagged = tagged.filter("element or field is not null")
    of = F.when(F.col("element"), F.col("label")).otherwise(F.slice("label", 1, F.size("label") - F.col("depth")))
    # one shuffle by file and element, one by file; only labels are gathered per file
    picked = tagged.groupBy(key, of.alias("label")).agg(
        F.max(F.when(F.col("element"), F.col("kind"))).alias("kind"),
        F.max(F.when(F.col("element") & leaf, F.col("value"))).alias("bare"),
        *[F.first(F.when(F.col("field") == name, F.col("value")), ignorenulls=True).alias(name) for name in PAIR_FIELDS],
    )
    places = tagged.filter("element").groupBy(key).agg(F.array_sort(F.collect_list("label")).alias("labels")).select(key, F.posexplode("labels").alias("pos", "label"))
    rows = picked.filter("kind <> 'null'").join(places, [key, "label"])
    return rows.select(key, "label", parent_label(F.col("label")).alias("parent"), (F.col("pos") + 1).alias("place"), F.coalesce("bare", "pair_id").alias("pair_id"), *[f for f in PAIR_FIELDS if f != "pair_id"])
