"""Long exact spans shared between records.

Method: sliding sentence spans. From every sentence start the shortest run of several consecutive sentences with at
least ``least`` characters is hashed, and the hashes are joined globally: a run found in two documents is shared from
end to end, which settles most shared text at one row a sentence. ``removable`` gives the sentences that a non-first
repeated run covers, ``without_repeats`` the texts without them.

Runs of whole sentences alone cannot find every shared stretch, since one may begin and end inside long sentences.
What they leave is searched exactly. Spans of SEED characters are hashed from every sentence start and, where
``least - SEED`` characters hold none, from the place whose span has the smallest hash. Both choices depend only on
the characters of the stretch itself, so two texts that share ``least`` characters share at least one such span in
them. Each window of ``least`` characters around a span also holds one of two longer stretches, its cores. Where a
core is repeated, the windows of ``least`` characters around its occurrences are hashed and joined, from the first to
the last that has a character which no run covers in any of them. This gives the shared characters exactly.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinweave.llm import rolling as R
from clinweave.plans.scratch import materialize, release
from clinweave.plans.skew import join_by_key_stats

SEED = 100
#: Characters that end a sentence when white space follows, those that end a line, and white space.
ENDERS, LINE_ENDS, SPACES = ".!?\n\r。！？", "\n\r", "\t\n\r \xa0"
_ENDER, _LINE_END, _SPACE = 1, 2, 4
_KINDS = np.zeros(0x110000, np.uint8)
for _chars, _kind in ((ENDERS, _ENDER), (LINE_ENDS, _LINE_END), (SPACES, _SPACE)):
    _KINDS[[ord(c) for c in _chars]] |= _kind


def _sentence_starts(codes: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Mask of places that follow an ender and white space, or a line end; the first two places of a text never count."""
    kinds = _KINDS[codes]
    ender, line_end, other = (kinds & _ENDER) > 0, (kinds & _LINE_END) > 0, (kinds & _SPACE) == 0
    out = np.zeros(len(codes), bool)
    out[2:] = other[2:] & (line_end[1:-1] | (ender[:-2] & ~other[1:-1]))
    out[cuts[:-1]] = False
    out[cuts[:-1] + 1] = False
    return out


def _window_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each window of ``w`` values, by doubling."""
    size, out = 1, x
    while size < w:
        step = min(size, w - size)
        out = np.minimum(out[: len(out) - step], out[step:])
        size += step
    return out


def span_starts(codes: np.ndarray, cuts: np.ndarray, hashes: np.ndarray, window: int) -> np.ndarray:
    """Chosen starts in the texts between ``cuts``, none shorter than SEED: at least one in every ``window`` consecutive places of a text.

    ``hashes`` has the hash of SEED characters from each place. Only places from which SEED characters of the same
    text follow are chosen. A start at a text's first two places would depend on what stands before, so sentences
    are not taken to start there.
    """
    n = len(hashes)
    ahead = np.repeat(cuts[1:], np.diff(cuts))[:n] - np.arange(n)  # characters from each place to its text's end
    chosen = _sentence_starts(codes, cuts)[:n] & (ahead >= SEED)
    if n < window:
        return np.flatnonzero(chosen)
    before = np.zeros(n + 1, np.int64)
    np.cumsum(chosen, out=before[1:])
    empty = (before[window:] == before[:-window]) & (ahead[: n - window + 1] >= SEED + window - 1)
    if empty.any():
        # A place is chosen if an empty window that covers it has its hash as the smallest. No window's smallest hash
        # is above that of a place it covers, so comparing with the largest over the covering windows is enough.
        low = np.where(empty, _window_min(hashes, window), np.uint64(0))
        pad = np.zeros(window - 1, np.uint64)
        covered = np.zeros(n + 1, np.int32)
        covered[: n - window + 1] += empty
        covered[window:] -= empty
        chosen |= (hashes == ~_window_min(~np.concatenate([pad, low, pad]), window)) & (np.cumsum(covered[:-1]) > 0)
    return np.flatnonzero(chosen)


def cores(least: int) -> tuple[int, int]:
    """(length, reach): a window of ``least`` characters around a span at p holds the ``length`` characters from p or those from p - reach."""
    half = (least - SEED + 1) // 2
    return least - half, least - SEED - half


SPANS = "doc_id bigint, p int, h bigint, ahead int, around int, run bigint, len int, last boolean"


def sentence_runs(starts: np.ndarray, cuts: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of the shortest run of two sentences or more with ``least`` characters from each sentence start, and of the last such run of each text."""
    edges = np.union1d(starts, cuts)
    text = np.searchsorted(cuts, edges, "right") - 1
    final = np.searchsorted(edges, cuts[1:])  # each text's end among the edges
    at = np.arange(len(edges) - 1)
    to = np.maximum(at + 2, np.searchsorted(edges, edges[:-1] + least))
    whole = to <= final[np.minimum(text[:-1], len(final) - 1)]
    back = np.minimum(final - 2, np.searchsorted(edges, cuts[1:] - least, "right") - 1)
    fits = (back >= 0) & (edges[np.maximum(back, 0)] >= cuts[:-1])
    both = np.unique(np.stack([np.concatenate([at[whole], back[fits]]), np.concatenate([to[whole], final[fits]])]), axis=1)
    return edges[both[0]], edges[both[1]]


def _run_columns(codes: np.ndarray, cuts: np.ndarray, least: int, sums: list[R.Sums]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends, hashes and the texts' numbers of the sentence runs of one slice."""
    start, end = sentence_runs(np.flatnonzero(_sentence_starts(codes, cuts)), cuts, least)
    with np.errstate(over="ignore"):
        key = R.signed(sums[0].stretches(start, end) * np.uint64(3) + sums[1].stretches(start, end))
    return start, end, key, np.searchsorted(cuts, start, "right") - 1


def _sums(codes: np.ndarray, powers: list[R.Powers]) -> list[R.Sums]:
    return [R.Sums(R.character_values(codes, seed), base, power) for seed, (base, power) in enumerate(zip(R.BASES, powers, strict=True))]


def _hashed_spans(batches: Iterable[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Seeds (h, and a hash for each of their cores) and sentence runs (run, len, and whether they end the text) of the texts."""
    powers = [R.Powers(b) for b in R.BASES]
    length, reach = cores(least)
    for b in R.slices(batches, 1):
        codes, cuts = R.code_points(b.column(1).to_pylist())
        ids = b.column(0).to_numpy()
        sums = _sums(codes, powers)
        hashes = sums[0].windows(SEED)
        at = span_starts(codes, cuts, hashes, least - SEED - 1)
        text = np.searchsorted(cuts, at, "right") - 1
        start, end, key, of = _run_columns(codes, cuts, least, sums)
        seeds, runs = len(at), len(start)
        columns = [pa.array(np.concatenate([ids[text], ids[of]])), pa.array(np.concatenate([at - cuts[text], start - cuts[of]]).astype(np.int32)), _padded(R.signed(hashes[at]), 0, runs)]
        for begin in (at, at - reach):
            outside = (begin < cuts[text]) | (begin + length > cuts[text + 1])
            begin = np.where(outside, 0, begin)
            near = sums[0].stretches(begin, np.minimum(begin + length, len(codes)))
            columns.append(_padded((near >> np.uint64(32)).astype(np.uint32).view(np.int32), 0, runs, outside))
        columns += [_padded(key, seeds, 0), _padded((end - start).astype(np.int32), seeds, 0), _padded(end == cuts[of + 1], seeds, 0)]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "p", "h", "ahead", "around", "run", "len", "last"])


def _padded(values: np.ndarray, before: int, after: int, null: np.ndarray | None = None) -> pa.Array:
    """The values with nulls before and after them."""
    mask = np.ones(before + len(values) + after, bool)
    mask[before : before + len(values)] = False if null is None else null
    return pa.array(np.concatenate([np.zeros(before, values.dtype), values, np.zeros(after, values.dtype)]), mask=mask)


def _only_runs(batches: Iterable[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    powers = [R.Powers(b) for b in R.BASES]
    for b in R.slices(batches, 1):
        codes, cuts = R.code_points(b.column(1).to_pylist())
        start, end, key, of = _run_columns(codes, cuts, least, _sums(codes, powers))
        yield pa.RecordBatch.from_arrays(
            [pa.array(b.column(0).to_numpy()[of]), pa.array((start - cuts[of]).astype(np.int32)), pa.array(key), pa.array((end - start).astype(np.int32))], names=["doc_id", "p", "run", "len"]
        )


#: The end of a covered stretch that reaches its text's end.
OPEN_END = 2**31 - 1


def _uncovered(batches: Iterable[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """The cores of each document, with the first and last window around them (counted from the core) that has a character outside the covered stretches."""
    length, _ = cores(least)
    steps = np.arange(length - least, 1)
    for b in batches:
        out: list[list[np.ndarray]] = [[], [], [], [], [], []]
        for i, found, covered in zip(b.column(0).to_pylist(), b.column(1), b.column(2), strict=True):
            at, seed, core = (found.values.field(c).to_numpy() for c in ("at", "h", "core"))
            begin, end = _merged(*(covered.values.field(c).to_numpy().astype(np.int64) for c in ("s", "e"))) if covered.is_valid else (np.zeros(0, np.int64),) * 2
            windows = at.astype(np.int64)[:, None] + steps
            needed = windows >= 0
            if len(begin):
                slot = np.searchsorted(begin, windows, "right") - 1
                needed &= (slot < 0) | (end[slot] < windows + least)
            some = needed.any(axis=1)
            first, last = steps[needed.argmax(axis=1)], steps[::-1][needed[:, ::-1].argmax(axis=1)]
            for k, x in enumerate((np.full(len(at), i, np.int64), at, seed, core, np.where(some, first, 1).astype(np.int32), np.where(some, last, -least).astype(np.int32))):
                out[k].append(x)
        if out[0]:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in out], names=["doc_id", "at", "h", "core", "first", "final"])


def _merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The maximal stretches of the union of [start, end)."""
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order]) if len(ends) else ends
    cut = np.flatnonzero(starts[1:] > reach[:-1])
    return np.concatenate([starts[:1], starts[cut + 1]]), np.concatenate([reach[cut], reach[-1:]])


def _candidate_windows(batches: Iterable[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    powers = [R.Powers(b) for b in R.BASES]
    for b in R.slices(batches, 1):
        out: list[list[np.ndarray]] = [[], [], [], []]
        for i, text, wanted in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
            codes, _ = R.code_points([text])
            n = len(codes) - least + 1
            want = np.zeros(n + 1, np.int64)
            np.add.at(want, np.clip(wanted.values.field("s").to_numpy(), 0, n), 1)
            np.add.at(want, np.clip(wanted.values.field("e").to_numpy(), 0, n), -1)
            at = np.flatnonzero(np.cumsum(want[:-1]) > 0)
            hs = [s.stretches(at, at + least) for s in _sums(codes, powers)]
            for k, x in enumerate((np.full(len(at), i, np.int64), R.signed(hs[0]), (hs[1] >> np.uint64(32)).astype(np.uint32).view(np.int32), at.astype(np.int32))):
                out[k].append(x)
        if out[0]:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in out], names=["doc_id", "h", "g", "p"])


def _stretches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out: list[list[np.ndarray]] = [[], [], []]
        for i, found in zip(b.column(0).to_pylist(), b.column(1), strict=True):
            first, last = _merged(*(found.values.field(c).to_numpy().astype(np.int64) for c in ("s", "e")))
            for k, x in enumerate((np.full(len(first), i, np.int64), first, last)):
                out[k].append(x)
        if out[0]:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in out], names=["doc_id", "span_start", "span_end"])


def _repeated(rows: DataFrame, keys: list[str], name: str, stats: dict[str, Column] | None = None, where: str = "true") -> DataFrame:
    """The rows whose key occurs in more than one document, with further ``stats`` of their key."""
    more = stats or {}
    found = rows.groupBy(*keys).agg(F.count("*").alias("n"), F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), *[c.alias(k) for k, c in more.items()])
    return join_by_key_stats(rows, materialize(found.filter("lo < hi").filter(where).select(*keys, "n", *more), name), keys, "n", rows.count())


def _long_texts(documents: DataFrame, least: int) -> DataFrame:
    if least <= SEED + 2:
        raise ValueError(f"least must be above {SEED + 2}")
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter((F.length("text") >= least) & F.col("doc_id").isNotNull())


def _maximal(stretches: DataFrame) -> DataFrame:
    """The maximal stretches of each document's (doc_id, s, e)."""
    grouped = stretches.groupBy("doc_id").agg(F.collect_list(F.struct("s", "e")).alias("found"))
    return grouped.mapInArrow(_stretches, "doc_id bigint, span_start bigint, span_end bigint")


def shared_spans(documents: DataFrame, least: int = 200) -> DataFrame:
    """(doc_id, span_start, span_end): maximal stretches of characters that lie in ``least`` consecutive ones found in another document.

    Characters are code points, compared unchanged; a repetition inside one document does not count. ``documents``
    needs ``doc_id`` and ``text``; other columns are ignored. Null and short texts, rows without ``doc_id`` and an empty table give no rows.
    Documents with equal texts are shared from end to end and are searched once, through their smallest doc_id.
    """
    texts = _long_texts(documents, least)
    whole = materialize(texts.select("doc_id", F.xxhash64("text").alias("h"), F.xxhash64(F.lit(1), "text", F.lit(2)).alias("g"), F.length("text").alias("len")), "whole-texts")
    equal = materialize(whole.groupBy("h", "g", "len").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n")).filter("n > 1"), "equal-texts")
    copies = materialize(join_by_key_stats(whole, equal, ["h", "g", "len"], "n", whole.count()).select("doc_id", "rep", "len"), "copies")
    ends = copies.select("doc_id", F.lit(0).cast("long").alias("span_start"), F.col("len").cast("long").alias("span_end"))
    distinct = texts.join(copies.filter("doc_id <> rep").select("doc_id"), "doc_id", "left_anti")

    spans = materialize(distinct.mapInArrow(lambda it: _hashed_spans(it, least), SPANS), "spans")
    runs = _repeated(spans.filter("run is not null").select("doc_id", "p", "run", "len", "last"), ["run", "len"], "run-hashes")
    runs = materialize(runs.select("doc_id", F.col("p").alias("s"), (F.col("p") + F.col("len")).alias("e"), "last"), "repeated-runs")
    known = runs.select("doc_id", "s", F.when(F.col("last"), F.lit(OPEN_END)).otherwise(F.col("e")).alias("e"))
    known = known.unionByName(copies.filter("doc_id = rep").select("doc_id", F.lit(0).alias("s"), F.lit(OPEN_END).alias("e")))

    near = _repeated(spans.filter("h is not null").select("doc_id", "p", "h", "ahead", "around"), ["h"], "span-hashes")
    sides = F.explode(F.array(F.struct(F.col("ahead").alias("core"), F.col("p").alias("at")), F.struct(F.col("around").alias("core"), (F.col("p") - cores(least)[1]).alias("at"))))
    near = near.select("doc_id", "h", sides.alias("c")).filter("c.core IS NOT NULL").groupBy("doc_id").agg(F.collect_list(F.struct("c.at", "h", "c.core")).alias("cores"))
    near = near.join(known.groupBy("doc_id").agg(F.collect_list(F.struct("s", "e")).alias("covered")), "doc_id", "left")
    near = materialize(near.mapInArrow(lambda it: _uncovered(it, least), "doc_id bigint, at int, h bigint, core int, first int, final int"), "cores")
    # the part of a core beyond its seed is hashed to 32 bits; a chance agreement only adds windows to compare
    reach = {"lo_window": F.min("first"), "hi_window": F.max("final")}
    places = _repeated(near, ["h", "core"], "core-hashes", reach, "lo_window <= hi_window")
    wanted = _maximal(places.select("doc_id", (F.col("at") + F.col("lo_window")).alias("s"), (F.col("at") + F.col("hi_window") + 1).alias("e")))
    wanted = wanted.groupBy("doc_id").agg(F.collect_list(F.struct(F.col("span_start").cast("int").alias("s"), F.col("span_end").cast("int").alias("e"))).alias("wanted"))
    searched = texts.join(materialize(wanted, "core-places"), "doc_id").select("doc_id", "text", "wanted")
    windows = materialize(searched.mapInArrow(lambda it: _candidate_windows(it, least), "doc_id bigint, h bigint, g int, p int"), "windows")
    # 96 bits tell windows apart: a chance agreement is out of reach also for 10 ** 13 of them
    exact = _repeated(windows, ["h", "g"], "window-hashes").select("doc_id", F.col("p").alias("s"), (F.col("p") + least).alias("e"))
    found = exact.unionByName(runs.select("doc_id", "s", "e")).join(copies.select("doc_id"), "doc_id", "left_anti")
    found = materialize(_maximal(found), "stretches")
    release(spans, runs, near, windows)
    return ends.unionByName(found)


def removable(documents: DataFrame, least: int = 200) -> DataFrame:
    """(doc_id, span_start, span_end): the sentences covered by a repeated run of sentences that is not the first of its kind.

    Runs have two sentences or more and at least ``least`` characters; the first is the one with the smallest doc_id
    and start. A run said twice in one document counts too. Adjoining sentences come as one stretch. Null and short
    texts, rows without ``doc_id`` and an empty table give no rows.
    """
    runs = materialize(_long_texts(documents, least).mapInArrow(lambda it: _only_runs(it, least), "doc_id bigint, p int, run bigint, len int"), "sentence-runs")
    stats = runs.groupBy("run", "len").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "p")).alias("first")).filter("n > 1")
    again = join_by_key_stats(runs, materialize(stats, "run-hashes"), ["run", "len"], "n", runs.count()).filter(F.struct("doc_id", "p") != F.col("first"))
    return _maximal(again.select("doc_id", F.col("p").alias("s"), (F.col("p") + F.col("len")).alias("e")))


def without_repeats(documents: DataFrame, least: int = 200) -> DataFrame:
    """(doc_id, text) without the sentences of ``removable``; null and short texts stay as they are."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).to_pylist()
            for k, found in enumerate(b.column(2).to_pylist()):
                for x in sorted(found or (), key=lambda x: -x["span_start"]):
                    texts[k] = texts[k][: x["span_start"]] + texts[k][x["span_end"] :]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    gone = removable(documents, least).groupBy("doc_id").agg(F.collect_list(F.struct("span_start", "span_end")).alias("gone"))
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(gone, "doc_id", "left")
    return rows.mapInArrow(cut, "doc_id bigint, text string")


def shared_share(documents: DataFrame, least: int = 200) -> DataFrame:
    """How much of each document is shared: doc_id, n_chars, shared_chars and shared_fraction (0 for null and empty texts)."""
    spans = shared_spans(documents, least).groupBy("doc_id").agg(F.sum(F.col("span_end") - F.col("span_start")).alias("shared_chars"))
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n_chars"))
    shared = F.coalesce("shared_chars", F.lit(0)).cast("long")
    return docs.join(spans, "doc_id", "left").select("doc_id", "n_chars", shared.alias("shared_chars"), F.round(F.when(F.col("n_chars") > 0, shared / F.col("n_chars")).otherwise(0.0), 6).alias("shared_fraction"))
