"""Identifiers that depend on content alone, and the hashed split position."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clinweave.config import SplitConfig

#: Fixed values of the id scheme.
NAMESPACE = "e76a4554-385b-5bfd-9ba8-11f043b3633c"
DATASET = "MedQuAD"


def stable_id(kind: str, *parts: Column) -> Column:
    """UUID version 5 of ``dataset:kind:parts``; null parts count as ''. Built from SHA-1 without Python."""
    name = F.concat(F.lit(f"{DATASET.casefold()}:{kind}"), *[F.concat(F.lit(":"), F.coalesce(p.cast("string"), F.lit(""))) for p in parts])
    digest = F.sha1(F.concat(F.unhex(F.lit(NAMESPACE.replace("-", ""))), F.encode(name, "UTF-8")))
    variant = F.element_at(F.array(*[F.lit(x) for x in "89ab"]), (F.conv(F.substring(digest, 17, 1), 16, 10).cast("int") % 4) + 1)
    return F.concat_ws("-", F.substring(digest, 1, 8), F.substring(digest, 9, 4), F.concat(F.lit("5"), F.substring(digest, 14, 3)), F.concat(variant, F.substring(digest, 18, 3)), F.substring(digest, 21, 12))


def document_id(relative_path: Column) -> Column:
    return stable_id("document", relative_path)


def record_id(relative_path: Column, position: Column, pair_id: Column, question_id: Column) -> Column:
    return stable_id("record", relative_path, position, pair_id, question_id)


def split_position(component: Column, seed: int) -> Column:
    """A number in [0, 1): the first 8 bytes of SHA-256("seed:component") over 2**64."""
    head = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), component), 256), 1, 16)
    return F.conv(head, 16, 10).cast("decimal(20,0)").cast("double") / F.lit(float(2**64))


def split_name(position: Column, config: SplitConfig) -> Column:
    return F.when(position < config.train, "train").when(position < config.train + config.validation, "validation").otherwise("test")


def chunk_id(parent: Column, index: Column) -> Column:
    """The parent's id for its first chunk, else ``parent::chunk::0001`` with at least four digits."""
    return F.when(index == 0, parent).otherwise(F.format_string("%s::chunk::%04d", parent, index))
