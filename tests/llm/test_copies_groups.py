import random

import pytest
from pyspark.sql import functions as F

from clinweave.llm import copies, groups
from clinweave.llm.rolling import FoldTable
from clinweave.plans import skew

TEXTS = [None, "", " .,!", "Heart failure?", "heart-FAILURE", "Hèart failure", "Straße 5", "STRASSE 5!", "Strasse 6", "ﬁne", "FINE", "日本 語", "日本語", "İ", "a" * 5000, "A " * 5000, "é", "é", "x​y", "xy"]


def canonical(t):
    return "".join(x for c in t or "" for x in c.lower() if x.isalnum())


def expected_copies(rows):
    first, out = {}, set()
    for i, q, a in sorted(rows):
        key = tuple(sorted((canonical(q), canonical(a))))
        if key in first:
            out.add((first[key], i))
        first.setdefault(key, i)
    return out


def test_copies_equal_brute_force(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice(TEXTS), rng.choice(TEXTS)) for i in range(400)]
    df = spark.createDataFrame(rows, "row_id long, question string, answer string").withColumns({"k1": F.lit("clash"), "n": F.lit(1)}).repartition(5)
    assert {tuple(r) for r in copies.find_copies(df).collect()} == expected_copies(rows)
    counts = {r.first_row_id: r.n_copies for r in copies.collapse_copies(df).collect()}
    assert sum(counts.values()) == 400 and len(counts) == 400 - len(expected_copies(rows))


def test_hot_group_of_copies(spark, monkeypatch):
    monkeypatch.setattr(skew, "LEAST_HOT_ROWS", 20)
    rows = [(i, "Same. " if i % 3 else f"other {i}", "x") for i in range(300)]
    df = spark.createDataFrame(rows, "row_id long, question string, answer string")
    assert {tuple(r) for r in copies.find_copies(df).collect()} == expected_copies(rows)


def test_colliding_rows_are_compared(spark, monkeypatch):
    """With a hash that sees only the number of symbols, the comparison and further rounds still separate the texts."""
    rows = [(0, "abc", "x"), (1, "a b c", "x"), (2, "xyz", "x"), (3, "X-Y-Z", "x"), (4, "q", "x")]
    df = spark.createDataFrame(rows, "row_id long, question string, answer string")
    real = copies.pair_keys

    def weak(batches, salt=0):
        import pyarrow as pa

        for b in real(batches, salt):
            yield b if salt else pa.RecordBatch.from_arrays([b.column(0), pa.array([0] * b.num_rows, pa.int64()), pa.array([0] * b.num_rows, pa.int64())], names=b.schema.names)

    monkeypatch.setattr(copies, "pair_keys", weak)
    assert {tuple(r) for r in copies.find_copies(df).collect()} == {(0, 1), (2, 3)}


def test_empty_table(spark):
    df = spark.createDataFrame([], "row_id long, question string, answer string")
    assert copies.find_copies(df).count() == 0 and copies.collapse_copies(df).count() == 0


@pytest.mark.parametrize(("a", "b", "same"), [("ab", "A-b", True), ("ab", "abc", False), ("", "--", True), ("ß", "SS", False), ("ß", "ẞ", True), ("ﬁ", "fi", False), ("İ", "i", True), ("a1", "a2", False)])
def test_two_pointers(a, b, same):
    assert copies.same_when_skipping(a, b) is same


def test_fold_table_widths():
    import numpy as np

    table = FoldTable(lambda c: "".join(x for x in c.casefold() if x.isalnum()), 3)
    _, width = table.look_up(np.array([ord(c) for c in "aß-é"], np.uint32))
    assert width.tolist() == [1, 2, 0, 1]
    value, width = FoldTable(copies.counting, 3).look_up(np.array([ord(c) for c in "ßẞİiﬁ"], np.uint32))
    assert width.tolist() == [1] * 5 and value[0] == value[1] and value[2] == value[3] != value[4]


def components(rows):
    import re

    def plain(s):
        s = re.sub(r"^[{}\s]+|[{}\s]+$", "", (s or "").lower())
        return s or None

    parent, by = {}, {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for _, r, d in rows:
        r, d = plain(r), plain(d)
        if d:
            find(d)
            if r:
                x, y = find(by.setdefault(r, d)), find(d)
                parent[max(x, y)] = min(x, y)
    return {x: find(x) for x in parent}


def records(spark, rows):
    return spark.createDataFrame(rows, "row_id long, record_id string, document_id string")


@pytest.mark.parametrize("seed", range(3))
def test_components_equal_union_find(spark, seed, monkeypatch):
    monkeypatch.setattr(skew, "LEAST_HOT_ROWS", 15)
    rng = random.Random(seed)
    rows = [(i, f"r{i}", f"d{i:03}") for i in range(30)] + [(100 + i, f"r{i}", f"d{i + 1:03}") for i in range(29)]  # a long chain
    rows += [(200 + i, rng.choice(["R{}", "{{r{}}}", " r{} "]).format(rng.randrange(80)), rng.choice(["D{}", "d{} ", "{{D{}}}"]).format(f"x{rng.randrange(60)}")) for i in range(90)]
    rows += [(400 + i, "hub", f"h{i}") for i in range(40)] + [(500, None, "d000"), (501, "r1", None), (502, None, None), (503, " ", "{}"), (504, "r1", "d001")]
    got = {r.document_id: r.group_document_id for r in groups.linked_documents(records(spark, rows)).collect()}
    assert got == {x: c for x, c in components(rows).items() if x != c}


def test_splits_keep_groups_and_shares(spark):
    rng = random.Random(9)
    rows = [(i, f"r{i % 2900}", "hot" if i % 10 == 0 else f"d{rng.randrange(900)}" if i % 50 else None) for i in range(3000)]
    config = spark.createDataFrame([("train", 0.8, 42), ("validation", 0.1, 42), ("test", 0.1, 42)], "split_name string, ratio double, seed_value long")
    got = groups.assign_splits(records(spark, rows), config).collect()
    assert len(got) == 3000 and len({r.row_id for r in got}) == 3000
    where, home = {r.row_id: r.split_name for r in got}, components(rows)
    by_group = {}
    for i, r, d in rows:
        if d:
            by_group.setdefault(home[d], set()).add(where[i])
        by_group.setdefault(("r", r), set()).add(where[i])
    assert all(len(s) == 1 for s in by_group.values())
    for name, ratio in (("train", 0.8), ("validation", 0.1), ("test", 0.1)):
        assert abs(sum(s == name for s in where.values()) / 3000 - ratio) < 0.03
    again = groups.assign_splits(records(spark, rows), config).collect()
    assert {r.row_id: r.split_name for r in again} == where
    assert groups.assign_splits(records(spark, rows).limit(0), config).count() == 0
