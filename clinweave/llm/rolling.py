"""Polynomial hashes over whole Arrow batches of text, in numpy.

A batch's texts become one array of code points. Each code point has a value and a width (how many symbols it
folds to: none for what is skipped, two for a letter such as sharp s under case folding). With running sums of
``value * B**place`` modulo 2**64 the hash of any stretch is a subtraction, so no folded text is ever built.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
#: Odd multipliers of the two hash families.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


#: Bytes of text that are turned into arrays at once; a longer text is taken alone, as a whole.
SLICE_BYTES = 1 << 20


def slices(batches: Iterable[pa.RecordBatch], *columns: int) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about SLICE_BYTES in the given text columns, so that arrays over characters stay small."""
    for b in batches:
        if not b.num_rows:
            continue
        size = sum(pc.fill_null(pc.binary_length(b.column(c)), 0).to_numpy(zero_copy_only=False).astype(np.int64) for c in columns)
        group = (np.cumsum(size) - size) // SLICE_BYTES
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), b.num_rows]
        for s, e in zip(cuts[:-1], cuts[1:], strict=True):
            yield b.slice(s, e - s)


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser: spreads small code points over all bits."""
    with np.errstate(over="ignore"):
        z = x.astype(U64) + U64(0x9E3779B97F4A7C15 + seed)
        z = (z ^ (z >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> U64(27))) * U64(0x94D049BB133111EB)
        return z ^ (z >> U64(31))


@lru_cache(maxsize=4)
def _character_values(seed: int) -> np.ndarray:
    return mix(np.arange(0x110000, dtype=np.uint32), seed)


def character_values(codes: np.ndarray, seed: int = 0) -> np.ndarray:
    """``mix`` of each code point, looked up in a table."""
    return _character_values(seed)[codes]


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All code points of the batch and the offsets of its texts (one more than texts)."""
    raw = "".join(texts).encode("utf-32-le", "surrogatepass")
    ends = np.zeros(len(texts) + 1, np.int64)
    np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)), out=ends[1:])
    return np.frombuffer(raw, np.uint32), ends


class Powers:
    """B**0, B**1, ... modulo 2**64, lengthened on demand."""

    def __init__(self, base: int) -> None:
        self.base = base
        self.have = np.ones(1, U64)

    def upto(self, n: int) -> np.ndarray:
        if len(self.have) <= n:
            size = max(n + 1, 2 * len(self.have), 4096)
            steps = np.full(size, self.base, U64)
            steps[0] = 1
            with np.errstate(over="ignore"):
                self.have = np.multiply.accumulate(steps)
        return self.have


class FoldTable:
    """Skip-and-fold lookup: ``fold(char)`` gives the symbols that count, '' to skip. Filled as characters occur."""

    def __init__(self, fold: Callable[[str], str], base: int, seed: int = 0) -> None:
        self.fold, self.seed, self.base = fold, seed, base
        self.value = np.zeros(0x110000, U64)
        self.width = np.full(0x110000, -1, np.int8)

    def look_up(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        width = self.width[codes]
        if len(width) and width.min() < 0:
            for c in np.unique(codes[width < 0]).tolist():
                out = self.fold(chr(c))
                total, power = 0, 1
                for s in mix(np.array([ord(x) for x in out], np.uint32), self.seed).tolist():
                    total = (total + s * power) % 2**64
                    power = power * self.base % 2**64
                self.value[c], self.width[c] = total, len(out)
            width = self.width[codes]
        return self.value[codes], width


def stretch_hashes(values: np.ndarray, places: np.ndarray, starts: np.ndarray, ends: np.ndarray, powers: Powers) -> np.ndarray:
    """Hash of each [start, end) of one array; ``places`` says which power each value takes, counted in its stretch's text."""
    with np.errstate(over="ignore"):
        terms = values * powers.upto(int(places.max()) if len(places) else 0)[places]
        sums = np.zeros(len(values) + 1, U64)
        np.cumsum(terms, out=sums[1:])
        return sums[ends] - sums[starts]


def window_hashes(values: np.ndarray, k: int, base: int, powers: Powers) -> np.ndarray:
    """Hash of every window of ``k`` values; len(values) - k + 1 of them, equal for equal windows wherever they stand."""
    return Sums(values, base, powers).windows(k)


class Sums:
    """Running sums over one array of values, from which the hash of any stretch is a subtraction; equal stretches have equal hashes wherever they stand."""

    def __init__(self, values: np.ndarray, base: int, powers: Powers) -> None:
        self.inverse = _inverse_powers(base, len(values))
        self.sums = np.zeros(len(values) + 1, U64)
        with np.errstate(over="ignore"):
            np.cumsum(values * powers.upto(len(values))[: len(values)], out=self.sums[1:])

    def windows(self, k: int) -> np.ndarray:
        """Hashes of all stretches of ``k`` values."""
        n = max(0, len(self.sums) - k)
        with np.errstate(over="ignore"):
            return mix((self.sums[k:] - self.sums[:n]) * self.inverse[:n])

    def stretches(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of the stretches [start, end)."""
        with np.errstate(over="ignore"):
            return mix((self.sums[ends] - self.sums[starts]) * self.inverse[starts])


_INVERSES: dict[int, Powers] = {}


def _inverse_powers(base: int, n: int) -> np.ndarray:
    if base not in _INVERSES:
        _INVERSES[base] = Powers(pow(base, -1, 2**64))
    return _INVERSES[base].upto(n)


def signed(x: np.ndarray) -> np.ndarray:
    """The same bits as int64, which Arrow and Spark carry."""
    return x.astype(U64).view(np.int64)
