import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clinweave.operators import dewey as D

PAYLOADS = [
    {"pairs": [{"pair_id": "1"}, None, {"pair_id": None}, {"question": "q"}], "synonyms": ["a", None, " ", " b "], "umls_cuis": "C1"},
    {"Document": {"QAPairs": {"QAPair": {"@pid": 7}}, "FocusAnnotations": {"Synonyms": {"Synonym": "x"}, "UMLS": {"CUIs": {"CUI": ["C1", "C1"]}}}}},
    {"doc": {"qaPairs": {"pair": [{"@pid": "a"}, {"@pid": 2}]}, "synonym": [{"#text": "s"}], "umls": {"cui": []}}},
    {"meta": {"focus": {"synonyms": [{"text": "t"}, None, {"text": None}], "umls_cuis": [{"cui": "C3", "score": 0.1}]}}, "sections": [{"pairs": [{"pair_id": "1"}, None]}, {"title": "empty"}, {"pairs": {"pair_id": "2"}}]},
    {"pairs": None, "synonyms": None},
    [],
]


def test_children_of_every_layout(spark):
    texts = [json.dumps(p) for p in PAYLOADS] + ['{"pairs": [{"pair_id": "1"}', "", None]
    raw = spark.createDataFrame([(i, t, "extra") for i, t in enumerate(texts)], "file_id long, payload string, label string")
    typed = spark.createDataFrame(
        [(100, [("1", "q"), None, (None, "r")], ["a", "", None, "a"], None), (101, None, [], ["C"])],
        "file_id long, pairs array<struct<pair_id:string,question:string>>, synonyms array<string>, umls_cuis array<string>",
    )
    got = {tuple(r) for r in D.file_children(typed, raw).collect()}
    assert got == {
        (0, "pair", 1, "1"), (0, "pair", 3, ""), (0, "pair", 4, ""), (0, "synonym", 1, "a"), (0, "synonym", 4, "b"), (0, "cui", 1, "C1"),
        (1, "pair", 1, "7"), (1, "synonym", 1, "x"), (1, "cui", 1, "C1"), (1, "cui", 2, "C1"),
        (2, "pair", 1, "a"), (2, "pair", 2, "2"), (2, "synonym", 1, "s"),
        (3, "pair", 1, "1"), (3, "pair", 3, "2"), (3, "synonym", 1, "t"), (3, "cui", 1, "C3"),
        (100, "pair", 1, "1"), (100, "pair", 3, ""), (100, "synonym", 1, "a"), (100, "synonym", 4, "a"), (101, "cui", 1, "C"),
    }
    assert D.file_children(typed.limit(0), raw.limit(0)).count() == 0


def rebuilt(nodes):
    """The record again from labels alone."""
    tree = {}
    for label, path, kind, value in nodes:
        if kind in ("object", "array"):
            here = {} if kind == "object" else []
        else:
            here = None if kind == "null" else value if kind == "string" else json.loads(value)
        tree[tuple(label)] = here
        if label:
            parent = tree[tuple(label[:-1])]
            if isinstance(parent, list):
                parent.append(here)
            else:
                parent[path.rsplit(".", 1)[-1]] = here
    return tree[()]


values = st.recursive(st.none() | st.booleans() | st.integers(-9, 9) | st.text("xy ", max_size=3), lambda c: st.lists(c, max_size=3) | st.dictionaries(st.text("abc", min_size=1, max_size=2), c, max_size=3), max_leaves=12)


@settings(max_examples=100, deadline=None)
@given(values)
def test_round_trip(value):
    assert rebuilt(D._json_nodes(D.parse_json(json.dumps(value)), None)) == value


def test_typed_columns_have_the_nodes_of_their_json(spark):
    schema = "k long, a array<struct<x:string,y:array<int>>>, b struct<z:boolean,s:string>"
    rows = [(1, [("p", [1, None]), None, (None, None)], (True, None)), (2, None, None), (3, [], (None, "t"))]
    df = spark.createDataFrame(rows, schema)
    typed = {(r.k, tuple(r.label), r.path, r.kind, r.value) for r in D.nodes_of_columns(df, "k", ["a", "b"]).collect()}
    texts = df.select("k", F.to_json(F.struct("a", "b"), {"ignoreNullFields": "false"}).alias("j"))
    parsed = {(r.k, tuple(r.label), r.path, r.kind, r.value) for r in D.nodes_of_json(texts, "k", "j").filter("path <> ''").collect()}
    assert typed == parsed


def test_flat_table_and_parents(spark):
    df = spark.createDataFrame([(1, [("p", "q"), None, ("r", None)])], "k long, pairs array<struct<x:string,y:string>>")
    nodes = D.nodes_of_columns(df, "k", ["pairs"])
    rows = sorted((r.label, r.parent, r.place, r.x, r.y) for r in D.flat_table(nodes, "k", "pairs[]", ["x", "y"]).collect())
    assert rows == [([1, 1], [1], 1, "p", "q"), ([1, 3], [1], 3, "r", None)]
    links = D.with_parents(nodes)
    assert links.alias("c").join(links.alias("p"), F.expr("c.parent = p.label")).count() == nodes.count() - 1


def test_pairs_of_every_layout_with_their_fields(spark):
    texts = {
        1: {"pairs": [{"pair_id": "a", "question_id": "q", "question_type": "t", "question": "Q", "answer": "A"}, None, {"question": "R", "answer": None}]},
        2: {"Document": {"QAPairs": {"QAPair": [{"@pid": 7, "Question": {"@qid": "q", "@qtype": "t", "#text": "Q"}, "Answer": "A"}]}}},
        3: {"doc": {"qaPairs": {"pair": {"@pid": "b", "question": {"@qid": "q", "@qtype": None, "#text": "Q"}, "answer": {"#text": "A"}}}}},
        4: {"sections": [{"title": "s", "pairs": [{"pair_id": "c", "question": "Q"}, None]}, {"pairs": {"pair_id": "d", "answer": "A"}}]},
        5: {"pairs": None},
    }
    raw = spark.createDataFrame([*((i, json.dumps(t)) for i, t in texts.items()), (6, '{"pairs": [{"pair_id": "1"}'), (7, None)], "file_id long, payload string")
    schema = "file_id long, pairs array<struct<position:int,pair_id:string,question_id:string,question_type:string,question:string,answer:string>>"
    typed = spark.createDataFrame([(100, [None, (1, "a", "q", "t", "Q", "A")]), (101, None)], schema)
    got = {tuple(tuple(v) if isinstance(v, list) else v for v in r) for r in D.pair_rows(typed, raw).collect()}
    assert got == {
        (1, (1, 1), (1,), 1, "a", "q", "t", "Q", "A"), (1, (1, 3), (1,), 3, None, None, None, "R", None),
        (2, (1, 1, 1, 1), (1, 1, 1), 1, "7", "q", "t", "Q", "A"), (3, (1, 1, 1), (1, 1), 1, "b", "q", None, "Q", "A"),
        (4, (1, 1, 2, 1), (1, 1, 2), 1, "c", None, None, "Q", None), (4, (1, 2, 1), (1, 2), 3, "d", None, None, None, "A"),
        (100, (1, 2), (1,), 2, "a", "q", "t", "Q", "A"),
    }


def test_any_depth_and_digits_as_written(spark):
    deep = 100_000
    rows = [
        (1, '{"pairs": [{"pair_id": 1.10}, {"pair_id": 1e5}, {"pair_id": 12345678901234567890}], "x": ' + "[" * deep + "1" + "]" * deep + "}"),
        (2, '{"x": ' + '{"y":' * deep + '{"z": [true, null, "a\\"b", {}, []]}' + "}" * deep + ', "synonyms": [" s ", "s"]}'),
        (3, '{"synonyms": [NaN]}'),
        (4, '{"x": ' + "[" * deep + "]" * (deep - 1) + "}"),
        (5, '{"x": ' + "[" * deep + "]" * deep + '}, "synonyms": ["s"]'),
    ]
    payloads = spark.createDataFrame(rows, "file_id long, payload string")
    got = sorted(tuple(r) for r in D.file_children(DOCS(spark), payloads).select("file_id", "child_kind", "child_pos", "child_key").collect())
    assert got == [(1, "pair", 1, "1.10"), (1, "pair", 2, "1e5"), (1, "pair", 3, "12345678901234567890"), (2, "synonym", 1, "s"), (2, "synonym", 2, "s")]


def DOCS(spark):
    pair = "struct<position:int,pair_id:string,question_id:string,question_type:string,question:string,answer:string>"
    return spark.createDataFrame([], f"file_id long, pairs array<{pair}>, synonyms array<string>, umls_cuis array<string>")


@pytest.mark.parametrize("text", ['{"a": [1, -2.50e+3, "x\\u00e9\\n", true, null, {}, [], {"a": 1, "a": 2}]}', "[]", " 3 ", '"s"', "[[],[[]]]", "{}"])
def test_the_deep_parser_agrees_with_the_standard_one(text):
    assert D._parse_deep(text) == D.parse_json(text)


@pytest.mark.parametrize("text", ["", "[", "[1,]", "{,}", '{"a"}', '{"a":}', "[1 2]", "nan", "01", "[1]]", '"x', "{1:2}", "tru", '{"a":1,}', "[}", "-"])
def test_incomplete_json_is_refused(text):
    for parse in (D._parse_deep, D.parse_json):
        with pytest.raises(ValueError):
            parse(text)


def test_many_elements_in_one_file(spark):
    rows = [(1, json.dumps({"doc": {"qaPairs": {"pair": [{"@pid": i} for i in range(4000)]}}}))]
    payloads = spark.createDataFrame(rows, "file_id long, payload string")
    got = {r.child_pos: r.child_key for r in D.file_children(DOCS(spark), payloads).collect()}
    assert got == {i + 1: str(i) for i in range(4000)}
