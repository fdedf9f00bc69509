"""Same or near-same records across splits.

Method: normalised texts are cut into content-defined chunks, chunk digests are joined across splits, and the
lengths of shared chunks are summed into overlap fractions.

Chunks are cut at two grains by hashes that roll over the words. The coarse grain cuts after a word where the hash
of the last two words has its low bits zero (about COARSE words a chunk); its digests give each evaluation record's
overlap fraction with the training split. One edited word in ten would touch every coarse chunk of a short question,
so pairs are found at the fine grain: there a chunk runs on while the hash of the last word stays in the same of
PHASES classes, and takes in the word at which the class changes. That is the same as cutting the text in PHASES
ways, each of which cuts after every word but those of one class, and keeping the chunks of two words or more. A
digest does not depend on the order of the words in its chunk, so exchanged neighbours keep it.

An edit changes two fine chunks, seldom three. Chunks are ordered by how many texts hold them; two texts within
reach share one of the 2 k + 1 rarest chunks of each, so only those are joined across splits. A chunk that many texts
hold is joined together with the rarest that follow it. Candidates are kept if their shared chunks cover a large
enough fraction of the longer text, and decided by a word edit distance. No bucket is capped.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinweave.llm import rolling as R
from clinweave.llm.words import WordHasher, lower_counting, plain
from clinweave.plans.scratch import materialize, release
from clinweave.plans.skew import join_by_key_stats, join_in_blocks

#: Words of a coarse chunk on average (a power of two), and words that one edit in TOLERANCE allows.
COARSE = 4
TOLERANCE = 10
#: Classes of words of the fine grain (a power of two), and the least part of the longer text that shared fine chunks cover: an edit touches two chunks, three now and then, of little more than one word each.
PHASES = 256
LEAST_SHARED = 1 - 5 / TOLERANCE
#: Texts per fine chunk above which it is joined with 2 and with 4 following chunks.
OFTEN, VERY_OFTEN = 32, 1024
#: Condition head words up to which they are sent to every executor; the rarer ones beyond it are joined to the texts that hold them.
MOST_SENT_HEADS = 100_000

# Words before a condition that are no part of its name.
SMALL_WORDS = frozenset("of with to about the a an and or is in for from said has have make confirm explain getting signs think".split())

FINGERPRINT = "row_id bigint, split_name string, collection string, k1 bigint, k2 bigint, kw bigint, n_words int, tokens array<bigint>, chunks array<bigint>, sizes array<int>"
#: Bits of a fine chunk's digest that hold its length in words, without the one at which the class changes.
_LENGTH = 15


def _lists(of_text: np.ndarray, values: np.ndarray, texts: int, kind: pa.DataType) -> pa.Array:
    """One list a text from values that come in the order of texts."""
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(of_text, np.arange(texts + 1)).astype(np.int32)), pa.array(values, kind))


def fine_chunks(hashes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, digest) of the fine chunks of texts given by their word hashes; a chunk's length stands in its low bits, equal chunks of a text are numbered."""
    n, sums = len(hashes), np.zeros(len(hashes) + 1, np.uint64)
    text = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
    kind = R.mix(hashes, 9) % np.uint64(PHASES)
    begin = np.ones(n, bool)
    begin[1:] = (kind[1:] != kind[:-1]) | (text[1:] != text[:-1])
    start = np.flatnonzero(begin)
    stop = np.append(start[1:], n)[: len(start)]
    of = text[start]
    whole = np.minimum(stop + 1, ends[1:][of])
    keep = whole - start >= 2
    start, stop, whole, of = start[keep], stop[keep], whole[keep], of[keep]
    with np.errstate(over="ignore"):
        np.cumsum(R.mix(hashes, 13), out=sums[1:])
        digest = R.mix(sums[whole] - sums[start] + (whole - start).astype(np.uint64))
        order = np.lexsort((digest, of))
        same = np.zeros(len(order), bool)
        same[1:] = (digest[order][1:] == digest[order][:-1]) & (of[order][1:] == of[order][:-1])
        place = np.arange(len(order))
        nth = np.zeros(len(order), np.uint64)
        nth[order] = (place - np.maximum.accumulate(np.where(same, 0, place))).astype(np.uint64)
        digest = R.mix(digest + nth * np.uint64(0x9E3779B97F4A7C15))
    return of, (digest & ~np.uint64(_LENGTH)) | np.minimum(stop - start, _LENGTH).astype(np.uint64)


def coarse_chunks(hashes: np.ndarray, ends: np.ndarray, powers: R.Powers) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, digest, words) of the coarse chunks of texts given by their word hashes."""
    n = len(hashes)
    text = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
    cut = np.zeros(n, bool)
    pair = R.window_hashes(hashes, 2, R.BASES[1], powers)
    cut[1:] = (pair & np.uint64(COARSE - 1)) == 0
    begin = np.ones(n, bool)
    begin[1:] = cut[:-1] | (text[1:] != text[:-1])
    begin[1:] &= ~((text[1:] == text[:-1]) & np.append(True, text[1:-1] != text[:-2])) if n > 1 else True  # no cut after a text's first word
    start = np.flatnonzero(begin)
    stop = np.append(start[1:], n)[: len(start)]
    return text[start], R.mix(R.Sums(hashes, R.BASES[1], powers).stretches(start, stop), 3), (stop - start).astype(np.int32)


def _fingerprints(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per row: a key of its letters and digits alone, one of its words in order, the number of words, fine chunks, coarse chunks and their words."""
    hasher, powers = WordHasher(), R.Powers(R.BASES[1])
    folds = [R.FoldTable(lower_counting, b, seed + 11) for seed, b in enumerate(R.BASES)]
    fold_powers = [R.Powers(b) for b in R.BASES]
    for b in R.slices(batches, 1):
        texts = [plain(t) for t in b.column(1).to_pylist()]
        codes, cuts = R.code_points(texts)
        keys = []
        for fold, power in zip(folds, fold_powers, strict=True):
            values, width = fold.look_up(codes)
            before = np.zeros(len(codes) + 1, np.int64)
            np.cumsum(width, out=before[1:])
            keys.append(R.stretch_hashes(values, before[:-1] - np.repeat(before[cuts[:-1]], np.diff(cuts)), cuts[:-1], cuts[1:], power))
        hashes, ends = hasher(texts)
        order = R.stretch_hashes(hashes, np.arange(len(hashes)) - np.repeat(ends[:-1], np.diff(ends)), ends[:-1], ends[1:], powers)
        keys.append(R.mix(order, 5))
        fine_of, fine = fine_chunks(hashes, ends)
        of, chunks, sizes = coarse_chunks(hashes, ends, powers)
        columns = [b.column(0), b.column(2), b.column(3), *(pa.array(R.signed(R.mix(k))) for k in keys), pa.array(np.diff(ends).astype(np.int32))]
        lists = [_lists(fine_of, R.signed(fine), len(texts), pa.int64()), _lists(of, R.signed(chunks), len(texts), pa.int64()), _lists(of, sizes, len(texts), pa.int32())]
        yield pa.RecordBatch.from_arrays([*columns, *lists], names=["row_id", "split_name", "collection", "k1", "k2", "kw", "n_words", "tokens", "chunks", "sizes"])


def most_edits(words: int) -> int:
    """Words that may differ when the longer of two texts decides and the other has ``words`` of them."""
    longer = words
    while longer + 1 - (longer + 1) // TOLERANCE <= words:
        longer += 1
    return longer // TOLERANCE


def join_keys(ranked: list[tuple[int, int]], words: int) -> Iterator[list[int]]:
    """Keys of a text of ``words`` words from its (text count, chunk) list in ascending order; texts within reach share at least one.

    If the first shared chunk stands at place p, p of the 2 k chunks that edits may touch are used up, so the next
    shared one stands among the following 2 k - p + 1, and so on: a frequent chunk can be joined with shared successors.
    """
    touched = 2 * most_edits(words)
    if not touched:
        return
    for p in range(min(touched + 1, len(ranked))):
        count, chunk = ranked[p]
        more = 0 if count <= OFTEN else 2 if count <= VERY_OFTEN else 4
        for rest in itertools.combinations(range(p + 1, min(touched + more + 1, len(ranked))), more):
            yield [chunk, *(ranked[q][1] for q in rest)]


def _keys(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rep, key = [], []
        for i, words, found in zip(*(b.column(c).to_pylist() for c in range(3)), strict=True):
            for chunks in join_keys([(x["n"], x["token"]) for x in found], words):
                total = len(chunks)
                for c in chunks:
                    total = (total * 0x9E3779B97F4A7C15 + c) % 2**64
                rep.append(i)
                key.append(total - 2**64 if total >= 2**63 else total)
        yield pa.RecordBatch.from_arrays([pa.array(rep, pa.int64()), pa.array(key, pa.int64())], names=["rep", "key"])


def word_distance(a: list, b: list, most: int) -> int:
    """Words changed, added, dropped or exchanged with their neighbour; ``most + 1`` if more than ``most``."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    far = most + 1
    last: list[int] = []
    row = [min(j, far) for j in range(len(b) + 1)]
    for i in range(1, len(a) + 1):
        lo, hi = max(1, i - most), min(len(b), i + most)
        new = [far] * (len(b) + 1)
        if i <= most:
            new[0] = i
        for j in range(lo, hi + 1):
            d = min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d = min(d, last[j - 2] + 1)
            new[j] = min(d, far)
        last, row = row, new
        if min(new) >= far:
            return far
    return row[len(b)]


def _alike(a: str, b: str) -> bool:
    """The same name, perhaps with one letter changed, added, dropped or exchanged."""
    return word_distance(list(a), list(b), 1) <= 1


def _condition_names(words: list[str], heads: frozenset[str]) -> list[tuple[str, list[str]]]:
    return [(w, [x for x in words[max(0, i - 2) : i] if x not in SMALL_WORDS]) for i, w in enumerate(words) if w in heads]


def other_conditions(a: list[str], b: list[str], heads: frozenset[str]) -> bool:
    """Whether both texts name conditions but none in common: each name then has a head or a word that the other text lacks."""

    def same(head: str, names: list[str], head2: str, names2: list[str]) -> bool:
        lacks = (all(any(_alike(x, y) for y in text) for x in words) for words, text in ((names, b), (names2, a)))
        return head == head2 and any(lacks)

    one, two = _condition_names(a, heads), _condition_names(b, heads)
    return bool(one and two) and not any(same(h, n, h2, n2) for h, n in one for h2, n2 in two)


WORD = re.compile(r"[^\W_]+")


def _words(text: str | None) -> list[str]:
    return WORD.findall(plain(text).lower())


def _near(batches: Iterable[pa.RecordBatch], heads: frozenset[str]) -> Iterator[pa.RecordBatch]:
    """The pairs (a, b) whose texts in columns 2 and 3 are close; further heads of the pair stand in column 4, if there is one."""
    for b in batches:
        keep = []
        more = b.column(4).to_pylist() if b.num_columns > 4 else [None] * b.num_rows
        for x, y, own in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), more, strict=True):
            one, two = _words(x), _words(y)
            most = max(len(one), len(two)) // TOLERANCE
            keep.append(word_distance(one, two, most) <= most and not other_conditions(one, two, heads | frozenset(own) if own else heads))
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))


def condition_heads(records: DataFrame) -> DataFrame:
    """(head, n) of the words that conditions are named by: the last words of ``focus`` before any comma, bracket or dash, in two rows or more."""
    name = F.regexp_extract(F.lower(F.trim("focus")), r"^(?:(?!\s[-–—]\s)[^,;:(\[])*", 0)
    head = F.regexp_extract(name, r"([\p{L}\p{N}]+)[^\p{L}\p{N}]*$", 1)
    return records.select(head.alias("head")).filter("head <> ''").groupBy("head").agg(F.count("*").alias("n")).filter("n >= 2")


def latest_assignments(splits: DataFrame) -> DataFrame:
    """(row_id, split_name): the latest assignment of each row; repeated rows count once, equal times go by name."""
    name = F.lower(F.trim("split_name"))
    best = F.max(F.struct("assigned_at", name.alias("split_name")))
    return splits.filter("row_id is not null and split_name is not null").groupBy(F.col("row_id").cast("long").alias("row_id")).agg(best.alias("b")).select("row_id", "b.split_name")


@dataclass
class Compared:
    """Questions of assigned rows: fingerprints, the class of each row (equal words in order), and links between classes across splits."""

    prints: DataFrame  # row_id, split_name, collection, k1, k2, kw, n_words, tokens, chunks, sizes; null questions have no words
    members: DataFrame  # rep, row_id, train
    links: DataFrame  # a (with a train row), b (with an evaluation row): the same or nearly so; a class with itself if it has both


def _fingerprinted(records: DataFrame, splits: DataFrame) -> DataFrame:
    rows = records.select(F.col("row_id").cast("long").alias("row_id"), F.coalesce("question", F.lit("")).alias("question"), F.col("source.collection").alias("collection"))
    rows = rows.join(latest_assignments(splits), "row_id").select("row_id", "question", "split_name", "collection")
    return materialize(rows.mapInArrow(_fingerprints, FINGERPRINT), "fingerprints")


def compare(records: DataFrame, splits: DataFrame) -> Compared:
    """Classes of questions and their links across splits; see ``cross_split_pairs`` for what counts as the same or nearly so."""
    prints = _fingerprinted(records, splits)
    keyed = prints.filter("n_words > 0").select("row_id", "k1", "k2", "kw", "n_words", "tokens", (F.col("split_name") == "train").alias("train"))
    total = keyed.count()
    sizes = keyed.groupBy("k1", "k2", "kw").agg(
        F.min("row_id").alias("rep"), F.count("*").alias("n"), F.bool_or("train").alias("has_train"), F.bool_or(~F.col("train")).alias("has_eval")
    )
    sizes = materialize(sizes, "question-classes")
    members = join_by_key_stats(keyed.select("row_id", "k1", "k2", "kw", "train"), sizes.select("k1", "k2", "kw", "rep", "n"), ["k1", "k2", "kw"], "n", total)
    members = materialize(members.select("rep", "row_id", "train"), "question-members")
    classes = keyed.select(F.col("row_id").alias("rep"), "n_words", "tokens").join(sizes.select("rep", "has_train", "has_eval"), "rep")
    classes = materialize(classes, "class-chunks")

    tokens = materialize(classes.select("rep", "n_words", F.explode("tokens").alias("token")), "fine-chunks")
    counts = materialize(tokens.groupBy("token").agg(F.count("*").alias("n")), "chunk-counts")
    ranked = join_by_key_stats(tokens, counts, ["token"], "n", tokens.count()).groupBy("rep", "n_words").agg(F.sort_array(F.collect_list(F.struct("n", "token"))).alias("ranked"))
    keys = ranked.mapInArrow(_keys, "rep bigint, key bigint").join(classes.select("rep", "has_train", "has_eval"), "rep")
    keys = materialize(keys, "chunk-keys")
    met = join_in_blocks(keys.filter("has_train").select("key", F.col("rep").alias("a")), keys.filter("has_eval").select("key", F.col("rep").alias("b")), ["key"])
    met = met.filter("a <> b").select("a", "b").distinct()
    # overlap fraction: words of shared chunks over those of the longer text
    shared = F.aggregate(F.array_intersect("ta", "tb"), F.lit(0).cast("long"), lambda s, x: s + x.bitwiseAND(F.lit(_LENGTH).cast("long")))
    longer = F.greatest("na", "nb")
    candidates = (
        met.join(classes.select(F.col("rep").alias("a"), F.col("n_words").alias("na"), F.col("tokens").alias("ta")), "a")
        .join(classes.select(F.col("rep").alias("b"), F.col("n_words").alias("nb"), F.col("tokens").alias("tb")), "b")
        .filter((F.abs(F.col("na") - F.col("nb")) <= F.floor(longer / TOLERANCE)) & (shared >= LEAST_SHARED * longer))
        .select("a", "b")
    )
    close = _verified(records, materialize(candidates, "question-candidates"))
    # classes with the same letters and digits in other words, each class with itself among them
    own = sizes.select("k1", "k2", "rep", "has_train", "has_eval")
    both = join_in_blocks(own.filter("has_train").select("k1", "k2", F.col("rep").alias("a")), own.filter("has_eval").select("k1", "k2", F.col("rep").alias("b")), ["k1", "k2"]).select("a", "b")
    links = materialize(close.unionByName(both).distinct(), "question-links")
    release(sizes, classes, tokens, counts, keys)
    return Compared(prints, members, links)


def _verified(records: DataFrame, candidates: DataFrame) -> DataFrame:
    """The candidates (a, b) whose questions are close and do not name different conditions."""
    heads = materialize(condition_heads(records), "condition-heads")
    order = [F.desc("n"), F.asc("head")]
    sent = frozenset(r["head"] for r in heads.orderBy(*order).limit(MOST_SENT_HEADS).collect())
    texts = records.select(F.col("row_id").cast("long").alias("row_id"), "question")
    pairs = candidates.join(texts.withColumnsRenamed({"row_id": "a", "question": "qa"}), "a").join(texts.withColumnsRenamed({"row_id": "b", "question": "qb"}), "b").select("a", "b", "qa", "qb")
    if heads.count() > MOST_SENT_HEADS:
        rest = heads.join(heads.orderBy(*order).limit(MOST_SENT_HEADS).select("head"), "head", "left_anti").select("head")
        said = F.array_distinct(F.regexp_extract_all(F.lower(F.concat_ws(" ", "qa", "qb")), F.lit(r"[\p{L}\p{N}]+"), F.lit(0)))
        held = pairs.select("a", "b", F.explode(said).alias("head")).join(rest, "head").groupBy("a", "b").agg(F.collect_set("head").alias("more"))
        pairs = pairs.join(held, ["a", "b"], "left")
    return pairs.mapInArrow(lambda it: _near(it, sent), "a bigint, b bigint")


def cross_split_pairs(records: DataFrame, splits: DataFrame) -> DataFrame:
    """(row_id_a, row_id_b): a train row and a validation or test row whose questions are the same or nearly so.

    Same: equal letters and digits once case, punctuation, spacing and compatibility forms are gone. Nearly: at
    most one word in TOLERANCE of the longer question changed, added, dropped or exchanged with its neighbour, and
    the conditions named are not different ones. The smaller row id comes first. Rows without an assignment, and
    questions that are null or without any letter or digit, take no part. Questions of the same words are compared
    once, as one class; only here are its rows made into pairs, in blocks. Empty tables give no pairs.
    """
    found = compare(records, splits)
    left = materialize(found.members.filter("train").select(F.col("rep").alias("a"), F.col("row_id").alias("t")), "train-members")
    right = materialize(found.members.filter("not train").select(F.col("rep").alias("b"), F.col("row_id").alias("e")), "held-members")
    half = materialize(join_in_blocks(found.links, left, ["a"]).select("b", "t"), "train-links")
    release(found.prints)
    return join_in_blocks(half, right, ["b"]).select(F.least("t", "e").alias("row_id_a"), F.greatest("t", "e").alias("row_id_b"))


def row_classes(records: DataFrame, splits: DataFrame, found: Compared | None = None) -> DataFrame:
    """(row_id, class_id, train, n_links): each assigned row with words, the class of its question (its smallest row) and the number of rows across the splits with the same or nearly the same question."""
    found = found or compare(records, splits)
    sizes = materialize(found.members.groupBy("rep").agg(F.count("*").alias("n"), F.count_if("train").alias("n_train")), "class-sizes")
    of_train = found.links.join(sizes.select(F.col("rep").alias("b"), (F.col("n") - F.col("n_train")).alias("m")), "b").groupBy(F.col("a").alias("rep")).agg(F.sum("m").alias("train_links"))
    of_held = found.links.join(sizes.select(F.col("rep").alias("a"), F.col("n_train").alias("m")), "a").groupBy(F.col("b").alias("rep")).agg(F.sum("m").alias("held_links"))
    sizes = materialize(sizes.join(of_train, "rep", "left").join(of_held, "rep", "left").select("rep", "n", "train_links", "held_links"), "class-links")
    rows = join_by_key_stats(found.members, sizes, ["rep"], "n", found.members.count())
    return rows.select("row_id", F.col("rep").alias("class_id"), "train", F.coalesce(F.when(F.col("train"), F.col("train_links")).otherwise(F.col("held_links")), F.lit(0)).cast("long").alias("n_links"))


def overlap_fractions(records: DataFrame, splits: DataFrame, prints: DataFrame | None = None) -> DataFrame:
    """(row_id, split_name, collection, n_words, shared_words, overlap): of each validation and test row, the words in coarse chunks that also occur in train.

    Null and wordless questions have 0 words and an overlap of 0.
    """
    prints = _fingerprinted(records, splits) if prints is None else prints
    chunks = prints.select("row_id", "split_name", F.explode(F.arrays_zip("chunks", "sizes")).alias("c"))
    chunks = materialize(chunks.select("row_id", "split_name", F.col("c.chunks").alias("chunk"), F.col("c.sizes").alias("words")), "chunks")
    held = chunks.filter("split_name <> 'train'")
    known = held.groupBy("chunk").agg(F.count("*").alias("n")).join(chunks.filter("split_name = 'train'").select("chunk").distinct(), "chunk")
    known = join_by_key_stats(held, materialize(known, "shared-chunks"), ["chunk"], "n", held.count()).groupBy("row_id").agg(F.sum("words").alias("shared_words"))
    n, s = F.col("n_words").cast("long"), F.coalesce("shared_words", F.lit(0)).cast("long")
    out = prints.filter("split_name <> 'train'").select("row_id", "split_name", "collection", "n_words").join(known, "row_id", "left")
    return out.select("row_id", "split_name", "collection", n.alias("n_words"), s.alias("shared_words"), F.round(F.when(n > 0, s / n).otherwise(0.0), 6).alias("overlap"))


def overlap_report(records: DataFrame, splits: DataFrame) -> DataFrame:
    """Per split and collection: rows, rows with the same or nearly the same question in train, and mean chunk overlap."""
    found = compare(records, splits)
    hit = row_classes(records, splits, found).filter("not train and n_links > 0").select("row_id", F.lit(1).alias("hit"))
    rows = overlap_fractions(records, splits, found.prints).join(hit, "row_id", "left")
    return rows.groupBy("split_name", "collection").agg(
        F.count("*").alias("n_rows"), F.coalesce(F.sum("hit"), F.lit(0)).alias("overlapping_rows"), F.round(F.avg("overlap"), 6).alias("mean_overlap")
    )
