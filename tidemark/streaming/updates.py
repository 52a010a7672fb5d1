"""Streams that keep derived tables current: the vector index and the customer table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.embed import Embedder, embed_text
from tidemark.functions.text import IMPORT_CHUNKING
from tidemark.operators.corpus import chunk_documents
from tidemark.operators.customers import (apply_patches, as_records, joined_fields, latest_fields, latest_patches, patches_with_fields,
                                          rejected_patches)
from tidemark.operators.vector_index import VectorIndex, append_to_index
from tidemark.session import checkpointed
from tidemark.sources.bucketed import BUCKETS, BucketedTable
from tidemark.sources.readers import CUSTOMER_TYPE
from tidemark.sources.writers import has_version, read_version, write_version


def start_index_updates(docs: DataFrame, index: VectorIndex, checkpoint: str, embedder: Embedder | None = None,
                        size: int = IMPORT_CHUNKING[0], overlap: int = IMPORT_CHUNKING[1],
                        available_now: bool = True) -> StreamingQuery:
    """New documents (doc_id, text) are chunked, embedded and added to their nearest leaves."""

    def run(batch: DataFrame, batch_id: int) -> None:
        embedded = embed_text(chunk_documents(batch, size=size, overlap=overlap), "text", embedder)
        append_to_index(embedded.select("doc_id", "chunk_id", "embedding"), index, batch_id)

    writer = docs.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def start_vector_updates(vectors: DataFrame, index: VectorIndex, checkpoint: str, vector: str = "embedding",
                         available_now: bool = True) -> StreamingQuery:
    """Ready-made vectors are added to their nearest leaves."""

    def run(batch: DataFrame, batch_id: int) -> None:
        append_to_index(batch, index, batch_id, vector)

    writer = vectors.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def start_customer_updates(patches: DataFrame, table: str, checkpoint: str, order: list[str],
                           available_now: bool = True) -> StreamingQuery:
    """Patches are merged into the latest table version; each batch writes a new one.

    The latest patch of each customer and field stays in a table beside it (``<table>-patches``), so a patch that comes
    late but is older by ``order`` changes nothing. Applying a batch a second time changes nothing either, so replays are harmless.
    Patches that are no JSON objects go to ``<table>-rejected``, keyed by batch. Each batch rewrites the whole table: see
    ``start_customer_merges`` for one that rewrites what it touches.
    """
    kept = f"{table}-patches"

    def run(batch: DataFrame, batch_id: int) -> None:
        _write_rejected(batch, f"{table}-rejected", batch_id)
        current = read_version(batch.sparkSession, table)
        current = current.withColumn("fields", F.from_json("fields", "map<string,variant>"))
        fresh = batch.select("customer_id", "patch", *order)
        if has_version(batch.sparkSession, kept):
            fresh = fresh.unionByName(read_version(batch.sparkSession, kept))
        write_version(latest_fields(fresh, order), kept)
        last = read_version(batch.sparkSession, kept)
        merged = as_records(apply_patches(current, latest_patches(last, order)), CUSTOMER_TYPE)
        write_version(merged.withColumn("fields", F.to_json("fields")), table)

    writer = patches.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def _write_rejected(batch: DataFrame, path: str, batch_id: int) -> None:
    rejected_patches(batch).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


@dataclass(frozen=True)
class CustomerTable:
    """Customer records in hash buckets (``pos``, ``key``, ``customer``, ``fields`` as JSON), and beside them the latest patch of
    each customer and field, in as many buckets."""

    path: str

    @property
    def records(self) -> BucketedTable:
        return BucketedTable(f"{self.path}/records", "customer.customer_id")

    @property
    def patches(self) -> BucketedTable:
        return BucketedTable(f"{self.path}/patches", "customer_id")

    def create(self, records: DataFrame, order: list[tuple[str, str]], buckets: int = BUCKETS) -> None:
        """``order`` names the columns that order patches, with their types."""
        schema = ", ".join(["customer_id bigint", "patch string", *(f"{name} {kind}" for name, kind in order)])
        self.records.create(records, buckets)
        self.patches.create(records.sparkSession.createDataFrame([], schema), buckets)

    def merge(self, patches: DataFrame, order: list[str]) -> int:
        """Merge patches into the buckets they touch; returns the version of the records.

        First the latest patch of each field is brought up to date, then the records of the same buckets are made from those.
        Either change is made again where another writer changed one of these buckets, so no patch is lost; merging a patch twice
        changes nothing. Patches are folded once, together with what the buckets hold.
        """
        spark = patches.sparkSession
        fresh = checkpointed(patches_with_fields(patches.select("customer_id", "patch", *order)))
        touched = self.patches.touched(fresh, "customer_id")
        self.patches.change(spark, touched, lambda old: latest_fields(old.unionByName(fresh), order))

        def merged(old: DataFrame) -> DataFrame:
            last = joined_fields(self.patches.read(spark, buckets=touched))
            parsed = old.withColumn("fields", F.from_json("fields", "map<string,variant>"))
            return as_records(apply_patches(parsed, last), CUSTOMER_TYPE).withColumn("fields", F.to_json("fields", {"ignoreNullFields": "false"}))

        return self.records.change(spark, touched, merged)


def start_customer_merges(patches: DataFrame, table: CustomerTable, checkpoint: str, order: list[str],
                          available_now: bool = True) -> StreamingQuery:
    """Patches are merged into a bucketed table; each batch rewrites the buckets it touches.

    A patch that comes late but is older by ``order`` changes nothing, and neither does a batch that is merged again. Patches
    that are no JSON objects go to ``<table>/rejected``, keyed by batch.
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        _write_rejected(batch, f"{table.path}/rejected", batch_id)
        table.merge(batch, order)

    writer = patches.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
