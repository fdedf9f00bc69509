"""Encoding of a corpus with a public byte-level BPE tokenizer, and decoding.

Method: a distinct-word table. Spark splits the texts into words, each distinct word is encoded once, and the ids
go back to the words' places. Texts are split once. Frequent words (a table of at most MOST_WORDS rows) are looked up
map-side; all others come back through a shuffled join by word and by their place among the ids.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinweave.plans.scratch import materialize

#: Rows of the word table that is sent to every executor, and bytes of a word in it: 50 MB at the very most.
MOST_WORDS = 200_000
MOST_WORD_BYTES = 256
#: Fixed value: the tokenizer's published word pattern, with white space spelled out as Unicode's property for Java.
WORD_PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\p{IsWhite_Space}\p{L}\p{N}]+|\p{IsWhite_Space}+(?!\P{IsWhite_Space})|\p{IsWhite_Space}+"
PLAIN_PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def read_ranks(path: str | None = None) -> dict[bytes, int]:
    """Pieces and their ids; about 50,000 of them, a size fixed by the published file."""
    with open(path or default_ranks(), "rb") as lines:
        return {base64.b64decode(piece): int(rank) for piece, rank in (line.split() for line in lines if line.strip())}


_ENCODERS: dict[str, object] = {}


def _content(ranks: dict[bytes, int]) -> str:
    """A key of a table of pieces by what it holds."""
    digest = hashlib.sha256()
    for piece, rank in sorted(ranks.items()):
        digest.update(b"%d:%d:" % (rank, len(piece)) + piece)
    return digest.hexdigest()


def _encoder(ranks: dict[bytes, int], key: str):  # noqa: ANN202
    if key not in _ENCODERS:
        import tiktoken

        _ENCODERS[key] = tiktoken.Encoding("words", pat_str=PLAIN_PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _ENCODERS[key]


def _count_words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        counts = pc.value_counts(b.column(0).flatten())
        yield pa.RecordBatch.from_arrays([counts.field(0).cast(pa.string()), counts.field(1).cast(pa.int64())], names=["word", "n"])


def _int_lists(lists: list) -> pa.Array:
    return pa.array(lists, pa.list_(pa.int32()))


def _list_ends(lists: pa.Array) -> np.ndarray:
    ends = np.zeros(len(lists) + 1, np.int64)
    np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False), out=ends[1:])
    return ends


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each stretch, one after the other."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))


def _look_up(batches: Iterable[pa.RecordBatch], words: pa.Array, ids: pa.ListArray) -> Iterator[pa.RecordBatch]:
    """ids of the words of each text that the table knows, and the other words, each with the number of ids before it."""
    id_ends = ids.offsets.to_numpy()
    id_values = ids.values.to_numpy(zero_copy_only=False)
    # one more entry, without ids, for words that the table lacks
    id_starts, id_sizes = np.append(id_ends[:-1], 0).astype(np.int64), np.append(np.diff(id_ends), 0).astype(np.int64)
    for b in batches:
        lists = b.column(1)
        flat = lists.flatten()
        ends = _list_ends(lists)
        at = pc.fill_null(pc.index_in(flat, value_set=words), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        sizes = id_sizes[at]
        after = np.zeros(len(sizes) + 1, np.int64)
        np.cumsum(sizes, out=after[1:])
        missing = np.flatnonzero(at < 0)
        doc_of = np.searchsorted(ends, missing, side="right") - 1
        n_missing = np.zeros(len(lists) + 1, np.int64)
        np.cumsum(np.bincount(doc_of, minlength=len(lists)), out=n_missing[1:])
        yield pa.RecordBatch.from_arrays(
            [
                b.column(0),
                pa.ListArray.from_arrays(pa.array(after[ends], pa.int32()), pa.array(id_values[_ranges(id_starts[at], sizes)], pa.int32())),
                pa.ListArray.from_arrays(pa.array(n_missing, pa.int32()), pa.array((after[missing] - after[ends[doc_of]]).astype(np.int32))),
                pa.ListArray.from_arrays(pa.array(n_missing, pa.int32()), flat.take(pa.array(missing)).cast(pa.string())),
            ],
            names=["doc_id", "ids", "places", "words"],
        )


def _fill_in(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Puts the ids of the joined words between the others."""
    for b in batches:
        known, known_ends, late_ends = b.column(1).flatten(), _list_ends(b.column(1)), _list_ends(b.column(2))
        late = b.column(2).flatten()
        doc = np.repeat(np.arange(b.num_rows), np.diff(late_ends))
        nth, place = (late.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("nth", "place"))
        order = np.lexsort((nth, doc))
        doc, place = doc[order], place[order]
        starts, size = _list_ends(late.field("ids"))[:-1][order], np.diff(_list_ends(late.field("ids")))[order]
        # ids put in before each known id; every text has one more slot, for what comes after its last
        slots = np.zeros(len(known) + b.num_rows, np.int64)
        np.add.at(slots, known_ends[doc] + doc + place, size)
        text = np.repeat(np.arange(b.num_rows), np.diff(known_ends))
        out = np.zeros(len(known) + int(size.sum()), np.int32)
        out[np.arange(len(known)) + np.cumsum(slots)[np.arange(len(known)) + text]] = known.to_numpy(zero_copy_only=False)
        put = known_ends[doc] + place + np.cumsum(size) - size
        out[_ranges(put, size)] = late.field("ids").flatten().to_numpy(zero_copy_only=False)[_ranges(starts, size)]
        ends = known_ends + np.concatenate([[0], np.cumsum(np.bincount(doc, weights=size, minlength=b.num_rows))]).astype(np.int64)
        yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(out))], names=["doc_id", "ids"])


def encode_corpus(documents: DataFrame, ranks: dict[bytes, int] | None = None) -> DataFrame:
    """(doc_id, ids) of each row of ``documents`` (doc_id, text; other columns are ignored); doc_id is unique.

    Null and empty texts give an empty list. The strings of special tokens are ordinary text. Texts with
    characters that this Java does not know yet are split and encoded by the tokenizer itself. No text is cut.
    """
    spark = documents.sparkSession
    pieces = ranks or read_ranks()
    table = spark.sparkContext.broadcast((pieces, _content(pieces)))
    strange = F.coalesce(F.col("text").rlike(r"\p{Cn}"), F.lit(False))
    words = F.when(~strange & (F.col("text") != ""), F.regexp_extract_all("text", F.lit(WORD_PATTERN), F.lit(0)))
    split = materialize(documents.select(F.col("doc_id").cast("long").alias("doc_id"), words.alias("split"), F.when(strange, F.col("text")).alias("strange")), "split-texts")

    def encode_words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _encoder(*table.value)
        for b in batches:
            ids = [coder.encode_ordinary(w) for w in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), _int_lists(ids)], names=["word", "n", "ids"])

    def encode_texts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _encoder(*table.value)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), _int_lists([coder.encode_ordinary(t) for t in b.column(1).to_pylist()])], names=["doc_id", "ids"])

    counts = split.filter("split is not null").select("split").mapInArrow(_count_words, "word string, n bigint")
    counts = counts.groupBy("word").agg(F.sum("n").alias("n"))
    vocabulary = materialize(counts.mapInArrow(encode_words, "word string, n bigint, ids array<int>"), "words")
    distinct, total = vocabulary.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    least = 1 if distinct <= MOST_WORDS else total // MOST_WORDS + 1  # at most MOST_WORDS words occur so often
    frequent = (F.col("n") >= least) & (F.octet_length("word") <= MOST_WORD_BYTES)
    near = vocabulary.filter(frequent).select("word", "ids").toArrow()
    sent = spark.sparkContext.broadcast((near.column("word").combine_chunks().cast(pa.string()), near.column("ids").combine_chunks().cast(pa.list_(pa.int32()))))
    looked = split.filter("strange is null").select("doc_id", "split").mapInArrow(lambda it: _look_up(it, *sent.value), "doc_id bigint, ids array<int>, places array<int>, words array<string>")
    whole = split.filter("strange is not null").select("doc_id", "strange").mapInArrow(encode_texts, "doc_id bigint, ids array<int>")
    if near.num_rows == distinct:
        return looked.select("doc_id", "ids").unionByName(whole)
    looked = materialize(looked, "looked-up")
    rare = looked.filter(F.size("places") > 0).select("doc_id", F.posexplode(F.arrays_zip("places", "words")).alias("nth", "m"))
    rare = rare.select("doc_id", "nth", F.col("m.places").alias("place"), F.col("m.words").alias("word"))
    late = rare.join(vocabulary.filter(~frequent).select("word", "ids"), "word")
    late = late.groupBy("doc_id").agg(F.collect_list(F.struct("nth", "place", "ids")).alias("found"))
    filled = looked.filter(F.size("places") > 0).select("doc_id", "ids").join(late, "doc_id").mapInArrow(_fill_in, "doc_id bigint, ids array<int>")
    return looked.filter(F.size("places") == 0).select("doc_id", "ids").unionByName(filled).unionByName(whole)


def decode_corpus(encoded: DataFrame, ranks: dict[bytes, int] | None = None) -> DataFrame:
    """(doc_id, text) from (doc_id, ids), by looking each id up in the id-to-piece table; an empty list gives ''."""
    table = ranks or read_ranks()
    pieces: list[bytes] = [b""] * (max(table.values()) + 1)
    for piece, rank in table.items():
        pieces[rank] = piece
    shared = encoded.sparkSession.sparkContext.broadcast(pa.array(pieces, pa.binary()))

    def decode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ends = _list_ends(b.column(1))
            found = pa.LargeListArray.from_arrays(pa.array(ends), shared.value.take(b.column(1).flatten()))
            joined = [b"".join(x).decode("utf-8", "replace") for x in found.to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(joined, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(decode, "doc_id bigint, text string")
