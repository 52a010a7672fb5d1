"""Embedding hooks.

An embedder is a function from a text column to an ``array<float>`` column. A
hosted model plugs in as an Arrow pandas UDF of that shape, marked with
``asNondeterministic`` so that each row is sent once; the default below
needs no service: every token adds +1 or -1 to one of ``dims`` cells, chosen by
its MD5 digest, and the sum is scaled to length 1. It works on Arrow batches
inside the task, so embedding causes no shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from tidemark.functions.memory import give_back

# Vector lengths of the hosted text and image models.
TEXT_DIMS = 768
IMAGE_DIMS = 512

Embedder = Callable[[Column], Column]
#: Rows and bytes of text that are cut into tokens at once: what bounds a task's memory.
_ROWS_AT_ONCE, _BYTES_AT_ONCE = 1024, 2 << 20


def token_cell(token: str, dims: int) -> int:
    """Signed cell number: cell * 2, plus 1 when the token counts negatively."""
    digest = hashlib.md5(token.encode("utf-8")).hexdigest()
    return (int(digest[:8], 16) % dims) * 2 + (int(digest[8], 16) >= 8)


def _cells(tokens: pa.Array, dims: int) -> np.ndarray:
    """``token_cell`` of many tokens, -1 for the empty one."""
    digests = np.frombuffer(b"".join([hashlib.md5(t).digest() for t in tokens.cast(pa.binary()).to_pylist()]), np.uint8).reshape(-1, 16)
    cell = np.ascontiguousarray(digests[:, :4]).view(">u4")[:, 0].astype(np.int64) % dims
    return np.where(pc.binary_length(tokens).to_numpy(zero_copy_only=False) > 0, cell * 2 + (digests[:, 4] >= 128), -1)


def _parts(texts: pa.Array) -> Iterator[pa.Array]:
    """Texts in slices of at most _ROWS_AT_ONCE rows and _BYTES_AT_ONCE bytes, or of one row."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    low = 0
    while low < len(texts):
        before = ends[low - 1] if low else 0
        high = min(low + _ROWS_AT_ONCE, max(low + 1, int(np.searchsorted(ends, before + _BYTES_AT_ONCE, side="right"))))
        yield texts.slice(low, high - low)
        low = high


def _embedded(texts: pa.Array, dims: int) -> np.ndarray:
    """(texts, dims) vectors: texts are cut at white space, and each distinct token is hashed once."""
    tokens = pc.ascii_split_whitespace(texts)
    rows = np.repeat(np.arange(len(texts)), pc.list_value_length(tokens).to_numpy(zero_copy_only=False))
    named = pc.list_flatten(tokens).dictionary_encode()
    codes = _cells(named.dictionary, dims)[named.indices.to_numpy(zero_copy_only=False)]
    rows, codes = rows[codes >= 0], codes[codes >= 0]
    sums = np.bincount(rows * dims + codes // 2, weights=1.0 - 2.0 * (codes % 2), minlength=len(texts) * dims)
    matrix = sums.astype(np.float64, copy=False).reshape(len(texts), dims)
    lengths = np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))
    return np.divide(matrix, lengths, out=np.zeros_like(matrix), where=lengths > 0).astype(np.float32)


def hashed_embedder(dims: int = TEXT_DIMS) -> Embedder:
    """The default embedder with vectors of ``dims`` cells."""

    @F.arrow_udf(ArrayType(FloatType()))
    def embed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            out, at = np.empty((len(texts), dims), np.float32), 0
            for part in _parts(texts):
                out[at:at + len(part)] = _embedded(part, dims)
                at += len(part)
            yield pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1) * dims, pa.int32()), pa.array(out.reshape(-1)))
            give_back()

    # Without this mark the optimizer may copy the call into inferred filters and run it twice.
    once = embed.asNondeterministic()
    return lambda text: once(F.lower(F.coalesce(text, F.lit(""))))


def embed_text(df: DataFrame, text: str, embedder: Embedder | None = None, out: str = "embedding") -> DataFrame:
    """Add an embedding column computed from a text column."""
    return df.withColumn(out, (embedder or hashed_embedder())(F.col(text)))


def embedding_of_payload(df: DataFrame, nested: str = "embeddings", flat: str = "values", out: str = "embedding",
                         error: str = "error") -> DataFrame:
    """Read the vector from either response shape; a row with neither gets an error text."""
    vector = F.coalesce(F.col(nested)["values"], F.col(flat))
    return (df.withColumn(out, vector)
            .withColumn(error, F.when(vector.isNull(), F.lit("Unknown embedding response format"))))
