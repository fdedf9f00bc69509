"""Embedding texts in Arrow batches, by any provider."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from clinweave.errors import EmbeddingError

Embed = Callable[[Sequence[str]], Sequence[Sequence[float]]]


def hashing_embedder(dimension: int = 384) -> Embed:
    """A deterministic provider without a model: signed hashed words, scaled to length 1."""

    def embed(texts: Sequence[str]) -> list[list[float]]:
        out = []
        for text in texts:
            v = np.zeros(dimension)
            for word in text.lower().split():
                h = zlib.crc32(word.encode())
                v[h % dimension] += 1.0 if h & 0x8000_0000 else -1.0
            norm = np.linalg.norm(v)
            out.append((v / norm if norm else v).astype(np.float32).tolist())
        return out

    return embed


def checked(texts: Sequence[str], embed: Embed, dimension: int) -> list[list[float]]:
    """Embeds and checks: no blank text, as many vectors as texts, each of the dimension. No texts give no vectors."""
    if not texts:
        return []
    if any(t is None or not t.strip() for t in texts):
        raise EmbeddingError("a text to embed is blank")
    try:
        vectors = [list(map(float, v)) for v in embed(texts)]
    except Exception as e:
        raise EmbeddingError("the embedding provider failed") from e
    if len(vectors) != len(texts) or any(len(v) != dimension for v in vectors):
        raise EmbeddingError("the provider gave vectors of another number or dimension")
    return vectors


def embed_texts(df: DataFrame, column: str, embed: Embed, dimension: int, batch_size: int = 100) -> DataFrame:
    """Adds ``embedding`` array<float>; the provider sees at most ``batch_size`` texts at a time."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(b.schema.get_field_index(column)).to_pylist()
            vectors = [v for i in range(0, len(texts), batch_size) for v in checked(texts[i : i + batch_size], embed, dimension)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(vectors, pa.list_(pa.float32()))], names=[*b.schema.names, "embedding"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInArrow(run, f"{fields}, embedding array<float>")
