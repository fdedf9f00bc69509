"""Words of texts (runs of letters and digits in lower case) as hashes, for whole Arrow batches at once."""

from __future__ import annotations

import unicodedata

import numpy as np

from clinweave.llm import rolling as R


def lower_counting(char: str) -> str:
    """A letter's or digit's lower case; '' for what ends a word."""
    return "".join(x for x in char.lower() if x.isalnum())


class WordHasher:
    """Hashes each word of each text; equal words have equal hashes in every batch and process."""

    def __init__(self, base: int = R.BASES[0]) -> None:
        self.table = R.FoldTable(lower_counting, base)
        self.powers = R.Powers(base)

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(hashes of all words in order, offsets of the texts into them)."""
        codes, ends = R.code_points(texts)
        values, width = self.table.look_up(codes)
        inside = np.zeros(len(codes) + 2, np.int8)
        inside[1:-1] = width > 0
        # a word also ends where a text ends
        step = np.diff(inside)
        start = step[:-1] == 1
        firsts = ends[:-1][ends[:-1] < len(codes)]
        start[firsts] |= inside[1:-1][firsts] == 1
        starts = np.flatnonzero(start)
        stop = step[1:] == -1
        lasts = ends[1:][ends[1:] > 0] - 1
        stop[lasts] |= inside[1:-1][lasts] == 1
        stops = np.flatnonzero(stop) + 1
        before = np.zeros(len(codes) + 1, np.int64)
        np.cumsum(width, out=before[1:])
        base = np.concatenate([np.zeros(1, np.int64), before[starts]])[np.cumsum(start)]
        places = before[:-1] - base
        hashes = R.stretch_hashes(values, places, starts, stops, self.powers) if len(starts) else np.zeros(0, np.uint64)
        return R.mix(hashes), np.searchsorted(starts, ends)


def plain(text: str | None) -> str:
    """Compatibility forms resolved, joiners and other invisible format characters dropped."""
    if not text:
        return ""
    if text.isascii():
        return text
    return "".join(c for c in unicodedata.normalize("NFKC", text) if unicodedata.category(c) != "Cf")
