"""Evaluation texts that leak into training text.

Method: word n-grams of the test items are seeds that join them to training texts; a Smith-Waterman alignment then
scores each candidate, so edited and paraphrased copies are ranked as well. Where only unbroken runs are asked for,
the rarest n-gram of each stretch is seed enough.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinweave.llm import rolling as R
from clinweave.llm.words import WordHasher
from clinweave.plans.scratch import materialize
from clinweave.plans.skew import join_by_key_stats

#: Words in a seed.
GRAM = 5
#: Distinct item n-grams up to which their hashes are sent to every executor (16 MB); beyond it they are joined.
MOST_SENT_GRAMS = 2_000_000
#: Bytes of item texts up to which they are sent to every executor; beyond it they are joined to the documents.
MOST_SENT_TEXT = 64 << 20
#: Alignment scores of a matching word, a differing word and a gap.
MATCH, MISMATCH, GAP = 2, -1, -1


def _grams(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, gram, place) of every word n-gram."""
    words, powers = WordHasher(), R.Powers(R.BASES[1])
    for b in R.slices(batches, 1):
        texts = [t or "" for t in b.column(1).to_pylist()]
        hashes, ends = words(texts)
        grams = R.window_hashes(hashes, GRAM, R.BASES[1], powers)
        doc = np.repeat(np.arange(len(texts)), np.diff(ends))[: len(grams)]
        inside = np.arange(len(grams)) + GRAM <= ends[1:][doc]
        at = np.flatnonzero(inside)
        ids = b.column(0).to_numpy(zero_copy_only=False)
        yield pa.RecordBatch.from_arrays([pa.array(ids[doc[at]], pa.int64()), pa.array(R.signed(grams[at])), pa.array((at - ends[:-1][doc[at]]).astype(np.int32))], names=["id", "gram", "place"])


def _texts_with_grams(batches: Iterable[pa.RecordBatch], wanted: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Texts that hold a wanted gram, with their distinct wanted grams."""
    words, powers = WordHasher(), R.Powers(R.BASES[1])
    for b in R.slices(batches, 1):
        texts = [t or "" for t in b.column(1).to_pylist()]
        hashes, ends = words(texts)
        grams = R.signed(R.window_hashes(hashes, GRAM, R.BASES[1], powers))
        slot = np.minimum(np.searchsorted(wanted, grams), len(wanted) - 1)
        at = np.flatnonzero(wanted[slot] == grams)
        doc = np.searchsorted(ends, at, side="right") - 1
        keep = at + GRAM <= ends[1:][doc]
        at, doc = at[keep], doc[keep]
        out = [(i, np.unique(grams[at[doc == i]])) for i in np.unique(doc).tolist()]
        ids = b.column(0).to_pylist()
        yield pa.RecordBatch.from_arrays(
            [pa.array([ids[i] for i, _ in out], pa.int64()), pa.array([texts[i] for i, _ in out], pa.string()), pa.array([g for _, g in out], pa.list_(pa.int64()))],
            names=["doc_id", "text", "grams"],
        )


def align(items: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Smith-Waterman over words for many pairs at once: best scores, starts and ends of their passages, longest runs of equal words.

    ``items`` and ``texts`` have a row of word hashes per pair, padded with 0 and 1, which equal nothing. The score row
    over the item is computed at once; a gap along it costs GAP a word, so a running maximum of
    ``score - GAP * place`` gives the best gap into each place.
    """
    pairs, n = items.shape
    steps = np.arange(n + 1) * -GAP
    rows, places = np.arange(pairs), np.arange(n + 1)
    row, run, origin = (np.zeros((pairs, n + 1), np.int32) for _ in range(3))
    best, start, end, longest = (np.zeros(pairs, np.int32) for _ in range(4))
    for i in range(texts.shape[1]):
        equal = items == texts[:, i : i + 1]
        fresh = np.zeros_like(row)
        fresh[:, 1:] = row[:, :-1] + np.where(equal, MATCH, MISMATCH)
        came = np.full_like(origin, i)
        came[:, 1:] = np.where(row[:, :-1] > 0, origin[:, :-1], i)
        came = np.where(row + GAP > fresh, origin, came)
        lifted = np.maximum(np.maximum(fresh, row + GAP), 0) + steps
        top = np.maximum.accumulate(lifted, axis=1)
        leader = np.maximum.accumulate(np.where(lifted == top, places, 0), axis=1)
        row = np.maximum(top - steps, 0).astype(np.int32)
        origin = np.where(row > 0, np.take_along_axis(came, leader, 1), i + 1).astype(np.int32)
        grown = np.zeros_like(run)
        grown[:, 1:] = np.where(equal, run[:, :-1] + 1, 0)
        run = grown
        longest = np.maximum(longest, run.max(axis=1))
        at = row.argmax(axis=1)
        better = row[rows, at] > best
        best = np.where(better, row[rows, at], best)
        end = np.where(better, i + 1, end)
        start = np.where(better, origin[rows, at], start)
    return best, start, end, longest


def _passages(item: np.ndarray, text: np.ndarray, powers: R.Powers) -> list[tuple[int, int]]:
    """Stretches of the text around the n-grams it shares with the item, twice the item's length to each side."""
    own = np.unique(R.window_hashes(item, GRAM, R.BASES[1], powers))
    at = np.flatnonzero(np.isin(R.window_hashes(text, GRAM, R.BASES[1], powers), own))
    out: list[tuple[int, int]] = []
    for p in at.tolist():
        lo, hi = max(0, p - 2 * len(item)), min(len(text), p + GRAM + 2 * len(item))
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], hi)
        else:
            out.append((lo, hi))
    return out


#: Words of padded text that are aligned at once.
ALIGNED_AT_ONCE = 1 << 15


def _align_all(batches: Iterable[pa.RecordBatch], sent: dict[int, str] | None) -> Iterator[pa.RecordBatch]:
    """Aligns each text (column 1) with its items: ids in column 2, whose texts are sent along or stand in column 3."""
    words, powers = WordHasher(), R.Powers(R.BASES[1])
    known: dict[int, np.ndarray] = {}

    def hashed(texts: list[str]) -> list[np.ndarray]:
        hashes, ends = words(texts)
        return [hashes[s:e] for s, e in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]

    for b in R.slices(batches, 1):
        texts = hashed(b.column(1).to_pylist())
        lists = b.column(2).to_pylist()
        if sent is None:
            known = {i: t for row, own in zip(lists, b.column(3).to_pylist(), strict=True) for i, t in zip(row, own, strict=True) if i not in known} | known
            fresh = [i for i, t in known.items() if isinstance(t, str)]
            known |= dict(zip(fresh, hashed([known[i] for i in fresh]), strict=True))
        else:
            fresh = sorted({i for row in lists for i in row} - known.keys())
            known |= dict(zip(fresh, hashed([sent[i] for i in fresh]), strict=True))
        rows = [(d, i) for d, row in enumerate(lists) for i in row]
        items = [known[i] for _, i in rows]
        jobs = sorted((hi - lo, r, lo) for r, (d, _) in enumerate(rows) for lo, hi in _passages(items[r], texts[d], powers))
        score, start, end, longest = (np.zeros(len(rows), np.int32) for _ in range(4))
        while jobs:
            width = jobs[-1][0]
            take, jobs = jobs[-max(1, ALIGNED_AT_ONCE // width) :], jobs[: -max(1, ALIGNED_AT_ONCE // width)]
            left = np.zeros((len(take), max(len(items[r]) for _, r, _ in take)), np.uint64)
            right = np.ones((len(take), width), np.uint64)
            for k, (size, r, lo) in enumerate(take):
                left[k, : len(items[r])] = items[r]
                right[k, :size] = texts[rows[r][0]][lo : lo + size]
            for (_, r, lo), s, f, t, n in zip(take, *align(left, right), strict=True):
                longest[r] = max(longest[r], n)
                if s > score[r]:
                    score[r], start[r], end[r] = s, lo + f, lo + t
        most = MATCH * np.maximum([len(item) for item in items], 1)
        ids = b.column(0).to_pylist()
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([ids[d] for d, _ in rows], pa.int64()), pa.array([i for _, i in rows], pa.int64()),
                *(pa.array(x, t) for x, t in ((score, pa.int32()), (score / most, pa.float64()), (start, pa.int32()), (end, pa.int32()), (longest, pa.int32()))),
            ],
            names=["doc_id", "item_id", "score", "share", "word_start", "word_end", "run_words"],
        )


ALIGNED = "doc_id bigint, item_id bigint, score int, share double, word_start int, word_end int, run_words int"


def alignments(documents: DataFrame, items: DataFrame, run: int = 12, edited: bool = True) -> DataFrame:
    """Scored candidates: doc_id, item_id, score, share (of the item's best score), word_start, word_end, run_words.

    ``documents`` needs doc_id and text, ``items`` item_id and item_text; other columns are ignored. Every pair that
    shares an n-gram is among the candidates. Without ``edited`` only each pair that shares ``run`` consecutive words is
    sure to be: each stretch of ``run`` words of an item has one seed in it, the n-gram of the stretch that fewest texts
    hold, and copies with edits in every stretch are left out. A candidate is aligned around every n-gram it shares with the item.
    Words are runs of letters and digits in lower case. Null or short texts on either side give no candidate.
    """
    if run < GRAM:
        raise ValueError(f"run must be at least {GRAM}")
    spark = documents.sparkSession
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter("text is not null")
    tests = items.select(F.col("item_id").cast("long").alias("item_id"), "item_text").filter("item_text is not null")
    grams = materialize(tests.mapInArrow(_grams, "id bigint, gram bigint, place int"), "item-grams")
    distinct = grams.select("gram").distinct()
    size = distinct.count()
    if size == 0:
        holding = texts.limit(0).select("doc_id", "text", F.array().cast("array<bigint>").alias("grams"))
    elif size <= MOST_SENT_GRAMS:
        wanted = spark.sparkContext.broadcast(np.sort(distinct.toArrow().column(0).to_numpy()))
        holding = texts.mapInArrow(lambda it: _texts_with_grams(it, wanted.value), "doc_id bigint, text string, grams array<bigint>")
    else:
        found = texts.mapInArrow(_grams, "id bigint, gram bigint, place int").join(distinct, "gram")
        holding = texts.join(found.groupBy(F.col("id").alias("doc_id")).agg(F.collect_set("gram").alias("grams")), "doc_id")
    holding = materialize(holding, "texts-with-grams")
    hits = holding.select("doc_id", F.explode("grams").alias("gram"))
    texts_with = materialize(hits.groupBy("gram").agg(F.count("*").alias("n")), "gram-counts")
    if edited:
        seeds = grams.select(F.col("id").alias("item_id"), "gram").distinct()
    else:
        last = run - GRAM
        ranked = grams.join(texts_with, "gram", "left").select("id", "place", "gram", F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram").alias("rank"))
        windows = ranked.select("id", F.explode(F.sequence(F.greatest(F.col("place") - last, F.lit(0)), F.col("place"))).alias("window"), "rank")
        seeds = windows.groupBy("id", "window").agg(F.min("rank").alias("rank"), F.count("*").alias("k")).filter(F.col("k") == last + 1)
        seeds = seeds.select(F.col("id").alias("item_id"), F.col("rank.gram").alias("gram")).distinct()
    # one row a seed, with the items that have it, so that a seed that many texts hold is joined map-side
    seeds = materialize(seeds.groupBy("gram").agg(F.collect_list("item_id").alias("items")).join(texts_with, "gram"), "seeds")
    total = texts_with.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    found = join_by_key_stats(hits, seeds, ["gram"], "n", total).select("doc_id", F.explode("items").alias("item_id"))
    size = tests.agg(F.coalesce(F.sum(F.octet_length("item_text")), F.lit(0))).first()[0]
    if size <= MOST_SENT_TEXT:
        sent = spark.sparkContext.broadcast({r.item_id: r.item_text for r in tests.collect()})
        own = found.groupBy("doc_id").agg(F.collect_set("item_id").alias("item_ids"))
        pairs = holding.select("doc_id", "text").join(own, "doc_id")
        return pairs.mapInArrow(lambda it: _align_all(it, sent.value), ALIGNED)
    own = found.distinct().join(tests, "item_id").groupBy("doc_id").agg(F.collect_list(F.struct("item_id", "item_text")).alias("own"))
    pairs = holding.select("doc_id", "text").join(own, "doc_id").select("doc_id", "text", "own.item_id", "own.item_text")
    return pairs.mapInArrow(lambda it: _align_all(it, None), ALIGNED)


def leaked_items(documents: DataFrame, items: DataFrame, run: int = 12) -> DataFrame:
    """(doc_id, item_id) of each text that shares at least ``run`` consecutive words with an item; see ``alignments``."""
    return alignments(documents, items, run, edited=False).filter(F.col("run_words") >= run).select("doc_id", "item_id")


def leak_report(documents: DataFrame, items: DataFrame, run: int = 12, share: float = 0.8) -> DataFrame:
    """Per item: documents holding a run of it, documents holding a close copy (alignment share), and the best share."""
    found = alignments(documents, items, run)
    return found.groupBy("item_id").agg(
        F.sum((F.col("run_words") >= run).cast("long")).alias("docs_with_run"),
        F.sum((F.col("share") >= share).cast("long")).alias("docs_with_copy"),
        F.round(F.max("share"), 6).alias("best_share"),
    )
