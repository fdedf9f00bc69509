"""Text normalisation. Three notions of equal texts are kept apart: fingerprints, content hashes, normalised questions."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Unicode white space as Python's ``\\s`` has it, for Java's expressions.
SPACE = r"[\s\x{1c}-\x{1f}\x{85}\p{Z}]+"
#: U+241F, which separates fields before hashing.
SEPARATOR = "␟"


def normalize_text(c: Column) -> Column:
    """Runs of Unicode white space as one blank, none outside; null becomes ''."""
    return F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), SPACE, " "))


def null_if_empty(c: Column) -> Column:
    return F.when(c != "", c)


@F.pandas_udf(T.StringType())
def _fold(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else t.casefold())


def casefold(c: Column) -> Column:
    """Full case folding. ASCII stays in the JVM; only other texts visit Python."""
    ascii_only = F.octet_length(c) == F.length(c)
    return F.when(ascii_only, F.lower(c)).otherwise(_fold(F.when(~ascii_only, c)))


@F.pandas_udf(T.StringType())
def _question(texts: pd.Series) -> pd.Series:
    gap = re.compile(r"\s+([?!.,;:])")
    return texts.map(lambda t: None if t is None else gap.sub(r"\1", " ".join(unicodedata.normalize("NFKC", t).casefold().split())))


def normalized_question(c: Column) -> Column:
    """NFKC, full case folding, single blanks, none before closing punctuation. ASCII stays in the JVM."""
    ascii_only = F.octet_length(c) == F.length(c)
    plain = F.regexp_replace(normalize_text(F.lower(c)), r"\s+([?!.,;:])", "$1")
    return F.when(ascii_only, plain).otherwise(_question(F.when(~ascii_only, c)))


def content_hash(question: Column, answer: Column) -> Column:
    """SHA-256 of both texts as they are."""
    return F.sha2(F.concat(question, F.lit(SEPARATOR), answer), 256)


def scan_fingerprint(*texts: Column) -> Column:
    """SHA-256 of the folded, normalised texts."""
    return F.sha2(F.concat_ws(SEPARATOR, *[casefold(normalize_text(t)) for t in texts]), 256)
