"""Text helpers: trimming, whitespace tokens and overlapping chunks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Chunk settings in tokens, (size, overlap).
IMPORT_CHUNKING = (512, 100)
METHOD_DEFAULT_CHUNKING = (1024, 256)

SPACE = r"[ \t\n\r\f\x0b]+"


def strip(c: Column) -> Column:
    """Remove leading and trailing whitespace of every kind (``trim`` removes spaces only)."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def tokens(c: Column) -> Column:
    """Whitespace-separated tokens; a null or blank text has none."""
    parts = F.split(F.coalesce(c, F.lit("")), SPACE)
    return F.filter(parts, lambda t: t != "")


def check_chunking(size: int, overlap: int) -> None:
    if not 0 <= overlap < size:
        raise ValueError("chunking needs 0 <= overlap < size")


def chunk_count(n: Column, size: int, overlap: int) -> Column:
    """Number of chunks for a text of n tokens."""
    needed = F.ceil((n - overlap) / F.lit(size - overlap)).cast("int")
    return F.when(n > 0, F.greatest(F.lit(1), needed)).otherwise(F.lit(0))


def chunks(toks: Column, size: int, overlap: int) -> Column:
    """Array of (start_token, n_tokens, text) for a token array."""
    check_chunking(size, overlap)
    step = size - overlap
    numbers = F.when(F.size(toks) > 0, F.sequence(F.lit(0), chunk_count(F.size(toks), size, overlap) - 1))

    def one(i: Column) -> Column:
        start = i * step
        return F.struct(start.alias("start_token"), F.least(F.lit(size), F.size(toks) - start).alias("n_tokens"),
                        F.array_join(F.slice(toks, start + 1, F.lit(size)), " ").alias("text"))

    return F.transform(numbers, one)
