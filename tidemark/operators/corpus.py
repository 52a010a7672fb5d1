"""Corpus import and retrieval: chunk, embed, store, search, build requests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import prompts
from tidemark.functions.embed import Embedder, embed_text
from tidemark.functions.text import IMPORT_CHUNKING, chunks, strip, tokens
from tidemark.operators.vector_index import Searched, VectorIndex, search_within
from tidemark.operators.vector_search import DISTANCE_THRESHOLD, TOP_K, VectorColumns, nearest
from tidemark.session import checkpointed


def chunk_documents(docs: DataFrame, text: str = "text", size: int = IMPORT_CHUNKING[0],
                    overlap: int = IMPORT_CHUNKING[1]) -> DataFrame:
    """Split documents into overlapping chunks of whitespace tokens.

    Keeps the other columns and adds (chunk_id, start_token, n_tokens, text).
    A document without tokens has no chunks. Narrow: rows stay in their task.
    """
    keep = [c for c in docs.columns if c != text]
    split = docs.select(*keep, tokens(F.col(text)).alias("_tokens"))
    exploded = split.select(*keep, F.posexplode(chunks(F.col("_tokens"), size, overlap)).alias("chunk_id", "_chunk"))
    return exploded.select(*keep, "chunk_id", "_chunk.start_token", "_chunk.n_tokens", "_chunk.text")


def import_documents(docs: DataFrame, corpus: str, path: str, embedder: Embedder | None = None,
                     size: int = IMPORT_CHUNKING[0], overlap: int = IMPORT_CHUNKING[1],
                     batch_id: int = 0) -> DataFrame:
    """Chunk, embed and store documents (file_uri, text); returns the imported file count.

    One batch overwrites itself only, so a repeated run of the same batch adds
    nothing twice.
    """
    embedded = embed_text(chunk_documents(docs, size=size, overlap=overlap), "text", embedder)
    (embedded.withColumn("corpus", F.lit(corpus)).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("corpus", "batch_id").parquet(path))
    return imported_files(docs)


def imported_files(docs: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """Count of distinct imported files, optionally per group."""
    return docs.groupBy(*group).agg(F.countDistinct("file_uri").alias("imported_files_count"))


def retrieve(queries: DataFrame, chunk_table: DataFrame, k: int = TOP_K, threshold: float | None = DISTANCE_THRESHOLD,
             embedder: Embedder | None = None, chunk_key: str = "chunk_key") -> DataFrame:
    """Top-k chunks per query text within a distance threshold.

    ``queries`` has (query_id, text); ``chunk_table`` has a unique ``chunk_key``
    and an embedding. Text is not carried through the search: join it back on
    the key for the few rows that remain. The query vectors are written once, so
    a hosted embedder sees every query once.
    """
    asked = checkpointed(embed_text(queries.select("query_id", "text"), "text", embedder).select("query_id", "embedding"))
    return nearest(asked, chunk_table, k, "dot", threshold, doc=VectorColumns(chunk_key, "embedding"))


def retrieve_within(queries: DataFrame, index: VectorIndex, k: int = TOP_K, threshold: float | None = DISTANCE_THRESHOLD,
                    embedder: Embedder | None = None, chunk_key: str = "chunk_key") -> Searched:
    """``retrieve`` through an index of the chunks: the same rows, read from the leaves that can hold chunks within the threshold
    and the k-th distance, and how many leaves that were."""
    asked = checkpointed(embed_text(queries.select("query_id", "text"), "text", embedder).select("query_id", "embedding"))
    return search_within(asked, index, k, "dot", threshold, doc=VectorColumns(chunk_key, "embedding"))


def guard_queries(queries: DataFrame, text: str = "text") -> DataFrame:
    """Add (accepted, status): blank queries are rejected with a message."""
    accepted = F.length(strip(F.coalesce(F.col(text), F.lit("")))) > 0
    return queries.withColumn("accepted", accepted).withColumn(
        "status", F.when(~accepted, F.lit(prompts.BLANK_QUERY_STATUS)))


def generation_requests(queries: DataFrame, contexts: DataFrame | None = None,
                        instruction: Column | str = prompts.CORPUS_INSTRUCTION,
                        settings: dict[str, float] | None = None) -> DataFrame:
    """One request per query: instruction, query text, contexts, settings and safety settings.

    ``contexts`` has (query_id, rank, text) with at most k rows per query.
    """
    out = queries
    if contexts is not None:
        listed = contexts.groupBy("query_id").agg(F.sort_array(F.collect_list(F.struct("rank", "text"))).alias("_rows"))
        out = queries.join(listed.select("query_id", F.col("_rows.text").alias("contexts")), "query_id", "left")
    else:
        out = out.withColumn("contexts", F.lit(None).cast("array<string>"))
    return out.select(
        "query_id", F.lit(instruction).alias("system_instruction") if isinstance(instruction, str)
        else instruction.alias("system_instruction"),
        F.col("text").alias("query_text"),
        F.coalesce("contexts", F.array().cast("array<string>")).alias("contexts"),
        prompts.generation_settings(settings).alias("generation_config"),
        prompts.safety_settings().alias("safety_settings"))
