"""Top-k vector search on blocks of vectors.

Both sides are packed, inside their own tasks, into blocks of a few hundred
vectors. Blocks meet through an equi-join and a task scores one block pair with
a matrix product, keeping only the best k per query. What leaves the task is
therefore k rows per query and block, never the scored pairs.

* A query side whose measured size is below ``broadcast_limit`` is broadcast,
  and the corpus is scanned once without a shuffle.
* A larger query side is cut into lanes of at most that size; corpus blocks are
  spread over lanes of their own and every lane pair is one join key, so work
  stays even whatever the ids look like.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DoubleType, StructField, StructType

from tidemark.functions.memory import give_back
from tidemark.operators.ordered import top_k

# Retrieval defaults.
TOP_K = 5
DISTANCE_THRESHOLD = 0.5
MAX_IMAGE_NEIGHBOURS = 10

BLOCK_BYTES = 1 << 20
BROADCAST_LIMIT = 64 << 20
#: Blocks that leave a task at once hold about so many bytes.
PACKED_BYTES = 4 << 20
MEASURES = ("dot", "euclidean", "cosine")
# Distances are compared at this many decimals so that the last bits of a
# matrix product cannot change the order of equal rows.
DISTANCE_DECIMALS = 9


@dataclass(frozen=True)
class VectorColumns:
    """Names of the id and vector columns of one side."""

    id: str
    vector: str


def rows_per_block(dims: int) -> int:
    return max(16, min(1024, BLOCK_BYTES // (4 * max(1, dims))))


def row_bytes(dims: int, dtype: str = "float32") -> int:
    """Size of one packed vector with room for its id."""
    return np.dtype(dtype).itemsize * dims + 64


def common_dtype(*sides: tuple[DataFrame, VectorColumns]) -> str:
    """``float64`` when a side holds doubles, so that no digit is lost in packing, else ``float32``."""
    wide = any(isinstance(df.schema[c.vector].dataType.elementType, DoubleType) for df, c in sides)
    return "float64" if wide else "float32"


def matrix_of(vectors: pa.Array, dtype: str) -> np.ndarray:
    """Vectors of one length as rows of a matrix, without an object for each number."""
    return pc.list_flatten(vectors).to_numpy(zero_copy_only=False).astype(dtype, copy=False).reshape(len(vectors), -1)


def unusable_vectors(df: DataFrame, columns: VectorColumns, dims: int) -> DataFrame:
    """Ids whose vector can't be searched with ``dims`` numbers, with the reason: (id, reason)."""
    size = F.size(columns.vector)
    reason = (F.when(F.col(columns.vector).isNull(), F.lit("no vector")).when(size == 0, F.lit("empty vector"))
              .when(size != dims, F.concat(size.cast("string"), F.lit(f" numbers instead of {dims}"))))
    return df.select(F.col(columns.id).alias("id"), reason.alias("reason")).filter("reason is not null")


def usual_length(df: DataFrame, vector: str) -> int:
    """The most common vector length (the smaller one among equals), 1 without vectors."""
    sizes = df.groupBy(F.size(vector).alias("dims")).count().filter("dims > 0")
    row = sizes.orderBy(F.desc("count"), "dims").first()
    return row["dims"] if row else 1


def pack_vectors(df: DataFrame, columns: VectorColumns, key: Column | None = None, prefix: str = "", dtype: str = "float32") -> DataFrame:
    """Pack rows into (key, ids, vectors) blocks without a shuffle.

    The key defaults to the vector's length, so that vectors meet those of their own length; with
    another key all vectors must have one length. Null and empty vectors are left out.
    """
    key = F.size(columns.vector) if key is None else key
    source = df.filter(F.size(columns.vector) > 0).select(
        key.cast("int").alias("key"), F.col(columns.id).alias("id"),
        F.col(columns.vector).cast("array<double>" if dtype == "float64" else "array<float>").alias("vector"))
    id_type = source.schema["id"].dataType
    key_name, ids_name, vectors_name = prefix + "key", prefix + "ids", prefix + "vectors"
    schema = StructType([
        StructField(key_name, source.schema["key"].dataType),
        StructField(ids_name, ArrayType(id_type)),
        StructField(vectors_name, BinaryType())])

    def blocks(batch: pa.RecordBatch, order: np.ndarray, edges: list[int]) -> pa.RecordBatch:
        """One block for each stretch of ``order`` between two edges."""
        rows = batch.take(pa.array(order[edges[0]:edges[-1]]))
        at = np.array(edges) - edges[0]
        column = rows.column("vector")
        packed = [pc.list_flatten(column.slice(a, b - a)).to_numpy(zero_copy_only=False).astype(dtype, copy=False).tobytes() for a, b in zip(at[:-1], at[1:])]
        return pa.RecordBatch.from_arrays(
            [rows.column("key").take(pa.array(at[:-1])), pa.ListArray.from_arrays(pa.array(at, pa.int32()), rows.column("id")), pa.array(packed, pa.binary())],
            names=[key_name, ids_name, vectors_name])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column("key").to_numpy(zero_copy_only=False)
            order = np.argsort(keys, kind="stable")
            starts = np.flatnonzero(np.r_[True, np.diff(keys[order]) != 0])
            ends = np.r_[starts[1:], len(order)]
            lengths = pc.list_value_length(batch.column("vector")).to_numpy(zero_copy_only=False)
            edges, size = [0], 0
            for start, end in zip(starts.tolist(), ends.tolist()):
                dims = int(lengths[order[start]])
                step = rows_per_block(dims)
                for low in range(start, end, step):
                    edges.append(min(low + step, end))
                    size += (edges[-1] - low) * row_bytes(dims, dtype)
                    if size >= PACKED_BYTES:
                        yield blocks(batch, order, edges)
                        edges, size = edges[-1:], 0
            if len(edges) > 1:
                yield blocks(batch, order, edges)
            give_back()

    return source.mapInArrow(pack, schema)


def _distances(queries: np.ndarray, corpus: np.ndarray, measure: str) -> np.ndarray:
    queries, corpus = queries.astype(np.float64), corpus.astype(np.float64)
    if measure == "euclidean":
        out = np.empty((len(queries), len(corpus)))
        for i, query in enumerate(queries):
            out[i] = np.sqrt(((corpus - query) ** 2).sum(axis=1))
        return out
    if measure == "cosine":
        for side in (queries, corpus):
            lengths = np.sqrt((side ** 2).sum(axis=1, keepdims=True))
            np.divide(side, lengths, out=side, where=lengths > 0)
    return 1.0 - queries @ corpus.T


def id_order(ids: pa.Array) -> np.ndarray:
    """Places of ids in ascending order."""
    names = ids.to_numpy(zero_copy_only=False)
    return np.argsort(names.astype(str) if names.dtype == object else names, kind="stable")


def best_places(distances: np.ndarray, k: int, threshold: float | None) -> tuple[np.ndarray, np.ndarray]:
    """Positions (row, column) of the k smallest distances per row, the lower column first among equals.

    Rows are only ever cut to k: with many copies in a block most distances are
    equal, so ties are counted off column by column instead of being sorted.
    """
    usable = np.isfinite(distances)
    if threshold is not None:
        usable &= distances < threshold
    distances = np.where(usable, distances, np.inf)
    keep = usable
    if distances.shape[1] > k:
        limit = np.partition(distances, k - 1, axis=1)[:, k - 1:k]
        keep = usable & (distances <= limit)
        if keep.sum() > k * len(keep):
            below = usable & (distances < limit)
            ties = usable & (distances == limit)
            places = k - below.sum(axis=1, keepdims=True)
            keep = below | (ties & (np.cumsum(ties, axis=1) <= places))
    return np.nonzero(keep)


def score_blocks(pairs: DataFrame, k: int, measure: str, threshold: float | None,
                 query_id: str, corpus_id: str, dtype: str = "float32") -> DataFrame:
    """Best k corpus rows per query for each joined pair of blocks."""
    schema = StructType([
        StructField(query_id, pairs.schema["q_ids"].dataType.elementType),
        StructField(corpus_id, pairs.schema["c_ids"].dataType.elementType),
        StructField("distance", DoubleType())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            q_ids, c_ids = batch.column("q_ids"), batch.column("c_ids")
            q_vectors, c_vectors = batch.column("q_vectors"), batch.column("c_vectors")
            for i in range(batch.num_rows):
                left, right = q_ids[i].values, c_ids[i].values
                q = np.frombuffer(q_vectors[i].as_buffer(), dtype=dtype).reshape(len(left), -1)
                c = np.frombuffer(c_vectors[i].as_buffer(), dtype=dtype).reshape(len(right), -1)
                by_id = id_order(right)
                d = np.round(_distances(q, c[by_id], measure), DISTANCE_DECIMALS)
                rows, columns = best_places(d, k, threshold)
                if len(rows):
                    yield pa.RecordBatch.from_arrays(
                        [left.take(pa.array(rows)), right.take(pa.array(by_id[columns])), pa.array(d[rows, columns])],
                        names=[query_id, corpus_id, "distance"])
            give_back()

    return pairs.select("q_ids", "q_vectors", "c_ids", "c_vectors").mapInArrow(score, schema)


def paired_distances(pairs: DataFrame, measure: str, dtype: str = "float32") -> DataFrame:
    """Add the distance of each row's two vectors. The columns are (query id, doc id, query vector, doc vector)."""
    schema = StructType([*pairs.schema.fields[:2], StructField("distance", DoubleType())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            q, c = (matrix_of(batch.column(i), dtype).astype(np.float64) for i in (2, 3))
            if measure == "euclidean":
                d = np.sqrt(((q - c) ** 2).sum(axis=1))
            else:
                if measure == "cosine":
                    for side in (q, c):
                        lengths = np.sqrt((side ** 2).sum(axis=1, keepdims=True))
                        np.divide(side, lengths, out=side, where=lengths > 0)
                d = 1.0 - (q * c).sum(axis=1)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.round(d, DISTANCE_DECIMALS))], names=schema.names)

    return pairs.mapInArrow(score, schema)


def query_side(queries: DataFrame, columns: VectorColumns) -> tuple[int, int]:
    """(row count, largest vector length) of the query side, measured in one small job."""
    row = queries.agg(F.count(F.lit(1)).alias("n"), F.max(F.size(columns.vector)).alias("dims")).first()
    return row["n"], max(row["dims"] or 0, 1)


def nearest(queries: DataFrame, corpus: DataFrame, k: int = TOP_K, measure: str = "dot",
            threshold: float | None = None, query: VectorColumns = VectorColumns("query_id", "embedding"),
            doc: VectorColumns = VectorColumns("doc_id", "embedding"),
            broadcast_limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Exact k nearest corpus rows per query: (query id, corpus id, distance, rank).

    ``dot`` uses 1 - dot product as distance, meant for unit vectors. With a
    threshold only rows with a smaller distance count, before the k is applied.
    Query ids must be unique. Vectors are compared with those of their own length; see
    ``unusable_vectors`` for the others. A query side beyond the broadcast limit is copied to every part of the
    corpus, which moves once; for very many queries use the index.
    """
    if measure not in MEASURES:
        raise ValueError(f"measure must be one of {MEASURES}")
    if k < 1:
        raise ValueError("k must be at least 1")
    n, dims = query_side(queries, query)
    dtype = common_dtype((queries, query), (corpus, doc))
    q_blocks = pack_vectors(queries, query, prefix="q_", dtype=dtype)
    c_blocks = pack_vectors(corpus, doc, prefix="c_", dtype=dtype)
    same = F.col("c_key") == F.col("q_key")
    if n * row_bytes(dims, dtype) <= broadcast_limit:
        pairs = c_blocks.join(F.broadcast(q_blocks), same)
    else:
        # Each corpus block goes to one part, the queries to every part.
        parts = int(queries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        q_dealt = q_blocks.withColumn("q_part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
        c_dealt = c_blocks.withColumn("c_part", F.pmod(F.xxhash64("c_ids"), F.lit(parts)).cast("int"))
        pairs = c_dealt.join(q_dealt, same & (F.col("c_part") == F.col("q_part")))
    scored = score_blocks(pairs, k, measure, threshold, query.id, doc.id, dtype)
    return top_k(scored, [query.id], ["distance", doc.id], k)


def image_neighbours(queries: DataFrame, documents: DataFrame, k: int = TOP_K, require_path: bool = True,
                     query: VectorColumns = VectorColumns("query_id", "embedding")) -> DataFrame:
    """Nearest image documents with their paths, by Euclidean distance.

    ``documents`` has (id, embedding_field, path). Ids can repeat when an import
    ran twice; the lookup takes one document per id, the one with the lowest
    path. Neighbours whose document has no path are dropped unless
    ``require_path`` is off.
    """
    if not 1 <= k <= MAX_IMAGE_NEIGHBOURS:
        raise ValueError(f"k must lie between 1 and {MAX_IMAGE_NEIGHBOURS}")
    found = nearest(queries, documents, k, "euclidean", query=query, doc=VectorColumns("id", "embedding_field"))
    one_per_id = documents.groupBy("id").agg(F.min("path").alias("path"))
    joined = found.join(one_per_id, "id", "left")
    return joined.filter(F.col("path").isNotNull()) if require_path else joined
