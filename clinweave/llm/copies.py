"""Duplicates hidden by formatting: one representative and a copy count for each text pair.

Method: the characters of both fields stream through a skip-and-fold table into rolling polynomial hashes;
no canonical string is built. Rows whose hashes collide are then compared with their representative by two
pointers that skip what does not count.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinweave.llm import rolling as R
from clinweave.plans.scratch import materialize, release
from clinweave.plans.skew import join_by_key_stats

KEYS = T.StructType([T.StructField(n, T.LongType(), False) for n in ("row_id", "k1", "k2")])


def counting(char: str) -> str:
    """What a character contributes: its letters and digits in lower case; '' for anything else. Ligatures and sharp s stay what they are."""
    return "".join(x for x in char.lower() if x.isalnum())


def _field_hashes(texts: list[str], tables: list[R.FoldTable], powers: list[R.Powers]) -> list[np.ndarray]:
    codes, ends = R.code_points(texts)
    out = []
    for table, power in zip(tables, powers, strict=True):
        values, width = table.look_up(codes)
        before = np.zeros(len(codes) + 1, np.int64)
        np.cumsum(width, out=before[1:])
        places = before[:-1] - np.repeat(before[ends[:-1]], np.diff(ends))
        out.append(R.stretch_hashes(values, places, ends[:-1], ends[1:], power))
    return out


def pair_keys(batches: Iterable[pa.RecordBatch], salt: int = 0) -> Iterator[pa.RecordBatch]:
    """row_id and a 128-bit key of the unordered pair (question, answer) for each row."""
    bases = [b + 2 * salt for b in R.BASES]
    tables = [R.FoldTable(counting, b, seed) for seed, b in enumerate(bases)]
    powers = [R.Powers(b) for b in bases]
    for batch in R.slices(batches, 1, 2):
        one, two = ([t or "" for t in batch.column(i).to_pylist()] for i in (1, 2))
        (q1, q2), (a1, a2) = _field_hashes(one, tables, powers), _field_hashes(two, tables, powers)
        swap = (q1 > a1) | ((q1 == a1) & (q2 > a2))
        lo1, hi1, lo2, hi2 = np.where(swap, a1, q1), np.where(swap, q1, a1), np.where(swap, a2, q2), np.where(swap, q2, a2)
        with np.errstate(over="ignore"):
            k1, k2 = R.mix(lo1) * np.uint64(3) + R.mix(hi1, 7), R.mix(lo2, 1) * np.uint64(5) + R.mix(hi2, 9)
        yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(R.signed(k1)), pa.array(R.signed(k2))], names=["row_id", "k1", "k2"])


def _advance(text: str) -> Iterator[str]:
    for char in text:
        if char.isalnum() or not char.isascii():
            yield from counting(char)


def same_when_skipping(a: str, b: str) -> bool:
    """Two pointers walk both texts, each skipping characters that do not count, until they differ or both end."""
    if a == b:
        return True
    left, right = _advance(a), _advance(b)
    while True:
        x, y = next(left, None), next(right, None)
        if x != y:
            return False
        if x is None:
            return True


def same_pair(q: str, a: str, rq: str, ra: str) -> bool:
    return (same_when_skipping(q, rq) and same_when_skipping(a, ra)) or (same_when_skipping(q, ra) and same_when_skipping(a, rq))


def _compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = [[t or "" for t in b.column(i).to_pylist()] for i in range(2, 6)]
        same = [same_pair(*x) for x in zip(*texts, strict=True)]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(same, pa.bool_())], names=["first_row_id", "row_id", "same"])


def _groups(texts: DataFrame, salt: int) -> DataFrame:
    """Members (first_row_id, row_id, same) of each key with more than one row."""
    keys = materialize(texts.mapInArrow(lambda it: pair_keys(it, salt), KEYS), "copy-keys")
    total = keys.count()
    sizes = materialize(keys.groupBy("k1", "k2").agg(F.min("row_id").alias("first_row_id"), F.count("*").alias("n")).filter("n > 1"), "copy-sizes")
    members = join_by_key_stats(keys, sizes, ["k1", "k2"], "n", total).filter("row_id <> first_row_id").select("first_row_id", "row_id")
    members = materialize(members, "copy-members")
    mine = members.join(texts, "row_id")
    reps = sizes.join(texts.withColumnsRenamed({"row_id": "first_row_id", "question": "rq", "answer": "ra"}), "first_row_id").select("first_row_id", "n", "rq", "ra")
    mine, reps = materialize(mine, "copy-texts"), materialize(reps, "copy-reps")
    both = join_by_key_stats(mine, reps, ["first_row_id"], "n", total)
    checked = both.select("first_row_id", "row_id", "question", "answer", "rq", "ra").mapInArrow(_compare, "first_row_id bigint, row_id bigint, same boolean")
    checked = materialize(checked, "copy-checked")
    release(keys, sizes, members, mine, reps)
    return checked


def find_copies(records: DataFrame) -> DataFrame:
    """(first_row_id, row_id) for each row that repeats an earlier one up to spacing, case, punctuation or field order.

    ``records`` needs ``row_id``, ``question`` and ``answer``; other columns are ignored. Null texts count as
    empty; rows with nothing that counts in either field are copies of one another. Row ids are unique. An
    empty table gives an empty result. Rows that share a key but not the text (a collision of 128 bits) are
    grouped again under other multipliers until none is left; each round settles the first row of every such group.
    """
    texts = records.select(F.col("row_id").cast("long").alias("row_id"), "question", "answer")
    checked = _groups(texts, 0)
    out = checked.filter("same").select("first_row_id", "row_id")
    for salt in itertools.count(1):
        rest = checked.filter("not same").select("row_id")
        if rest.isEmpty():
            break
        checked = _groups(texts.join(rest, "row_id", "left_semi"), salt)
        out = out.unionByName(checked.filter("same").select("first_row_id", "row_id"))
    return out


def collapse_copies(records: DataFrame) -> DataFrame:
    """One row for each distinct record: first_row_id and n_copies, the number of rows it stands for."""
    found = find_copies(records)
    counts = found.groupBy("first_row_id").agg((F.count("*") + 1).alias("n_copies"))
    heads = records.select(F.col("row_id").cast("long").alias("row_id")).join(found.select("row_id"), "row_id", "left_anti")
    return heads.join(counts, heads.row_id == counts.first_row_id, "left").select(
        heads.row_id.alias("first_row_id"), F.coalesce("n_copies", F.lit(1).cast("long")).alias("n_copies")
    )
