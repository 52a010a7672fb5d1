"""Product-quantised codes of vectors: one byte for each group of numbers, scored by table look-up.

What is left of a vector after its leaf's centroid is cut into groups of four numbers. Each group has a code book of up
to 256 entries; a code names the nearest entry of every group, so codes of float vectors take a sixteenth of their size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

#: Numbers of a group, entries of its code book, and rounds of training it.
GROUP, ENTRIES, ROUNDS = 4, 256, 12
#: Rows that code books are fitted on, at most: chosen by a hash of the vector.
MOST_TRAINED = 1 << 16


def groups(dims: int) -> int:
    return -(-dims // GROUP)


def grouped(vectors: np.ndarray) -> np.ndarray:
    """(rows, groups, GROUP), with zeros behind a vector whose length is no multiple of the group."""
    rows, dims = vectors.shape
    out = np.zeros((rows, groups(dims) * GROUP), np.float32)
    out[:, :dims] = vectors
    return out.reshape(rows, -1, GROUP)


def _nearest_entries(points: np.ndarray, book: np.ndarray) -> np.ndarray:
    half = 0.5 * (book ** 2).sum(axis=1)
    return np.concatenate([(points[low:low + 8192] @ book.T - half).argmax(axis=1) for low in range(0, len(points), 8192)] or [np.zeros(0, int)])


def train_book(points: np.ndarray, seed: int) -> np.ndarray:
    """(ENTRIES, GROUP) entries by Lloyd's rounds from distinct points; spare entries repeat the first."""
    distinct = np.unique(points, axis=0)
    rng = np.random.default_rng(seed)
    book = distinct[rng.permutation(len(distinct))[:ENTRIES]].astype(np.float32)
    if len(distinct) > ENTRIES:
        for _ in range(ROUNDS):
            at = _nearest_entries(points, book)
            size = np.bincount(at, minlength=len(book))
            sums = np.stack([np.bincount(at, points[:, j], len(book)) for j in range(GROUP)], axis=1)
            used = size > 0
            book[used] = (sums[used] / size[used, None]).astype(np.float32)
            # An entry nobody uses starts again at a point that is badly off.
            if not used.all():
                off = ((points - book[at]) ** 2).sum(axis=1)
                book[~used] = points[np.argsort(-off, kind="stable")[:int((~used).sum())]]
    return np.concatenate([book, np.repeat(book[:1], ENTRIES - len(book), axis=0)])


def train_books(rests: DataFrame, column: str, dims: int, path: str, seed: int = 42) -> None:
    """Fit a code book for each group, one task a group, and write them: (part, entries as bytes).

    ``rests`` has at most some MOST_TRAINED rows; what a task holds of them is one group's numbers.
    """
    n = groups(dims)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                matrix = pc.list_flatten(batch.column(0)).to_numpy(zero_copy_only=False).astype(np.float32, copy=False).reshape(batch.num_rows, -1)
                parts = grouped(matrix)
                yield pa.record_batch({"part": pa.array(range(n), pa.int32()),
                                       "points": pa.array([np.ascontiguousarray(parts[:, g]).tobytes() for g in range(n)], pa.binary())})

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        part = int(rows["part"].iloc[0])
        points = np.frombuffer(b"".join(rows["points"]), np.float32).reshape(-1, GROUP)
        return pd.DataFrame({"part": [part], "entries": [train_book(points, seed + part).astype("<f4").tobytes()]})

    cuts = rests.select(column).mapInArrow(cut, "part int, points binary")
    cuts.groupBy("part").applyInPandas(fit, "part int, entries binary").write.mode("overwrite").parquet(path)


def read_books(spark: SparkSession, path: str) -> np.ndarray:
    """(groups, ENTRIES, GROUP). Their size is 1,024 times that of a vector, whatever the number of rows."""
    rows = sorted(spark.read.parquet(path).collect(), key=lambda r: r["part"])
    return np.stack([np.frombuffer(r["entries"], "<f4").reshape(ENTRIES, GROUP) for r in rows])


def encode(vectors: np.ndarray, books: np.ndarray) -> np.ndarray:
    """(rows, groups) bytes."""
    parts = grouped(vectors)
    return np.stack([_nearest_entries(parts[:, g], books[g]) for g in range(len(books))], axis=1).astype(np.uint8)


def look_up_tables(queries: np.ndarray, books: np.ndarray) -> np.ndarray:
    """(groups, queries, ENTRIES): each query's product with every entry."""
    return np.einsum("qgj,gej->gqe", grouped(queries), books, optimize=True)


def products(tables: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """(queries, rows): the queries' products with the rests that codes stand for, added up from the tables."""
    out = np.zeros((tables.shape[1], len(codes)), np.float32)
    for g in range(len(tables)):
        out += tables[g][:, codes[:, g]]
    return out
