"""Event-driven corpus import as a Structured Streaming job."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.embed import Embedder
from tidemark.functions.text import IMPORT_CHUNKING
from tidemark.functions.uris import decode_event, object_uri
from tidemark.operators.corpus import import_documents

Loader = Callable[[DataFrame], DataFrame]

# Fixed value: the end of the status message of an imported file.
IMPORTED = " imported to RAG corpus successfully"
NOT_FOUND = " was not found"


def object_loader(read_text: Callable[[str], str]) -> Loader:
    """A loader that reads each named object inside the tasks through a client function.

    A failing read fails the batch, which the checkpoint then repeats.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(text=[read_text(uri) for uri in batch["file_uri"]])

    return lambda uris: uris.mapInPandas(run, "file_uri string, text string")


def decode_events(envelopes: DataFrame) -> DataFrame:
    """Envelopes to (data, name, bucket, file_uri, problem). Works on batches and streams."""
    event = envelopes.select(F.col("message.data").alias("data"), decode_event(F.col("message.data")).alias("e"))
    usable = F.col("e.problem").isNull()
    return event.select("data", F.when(usable, F.col("e.name")).alias("name"),
                        F.when(usable, F.col("e.bucket")).alias("bucket"),
                        F.when(usable, object_uri(F.col("e.bucket"), F.col("e.name"))).alias("file_uri"),
                        F.coalesce(F.when(F.col("data").isNull(), F.lit("no data")), F.col("e.problem")).alias("problem"))


def status_rows(events: DataFrame, loaded: DataFrame, corpus: str) -> DataFrame:
    """One status row per event: success with one imported file, or error where the object was not found."""
    found = loaded.select("file_uri").distinct().withColumn("_found", F.lit(1).cast("bigint"))
    joined = events.join(found, "file_uri", "left")
    there = F.col("_found").isNotNull()
    return joined.select(
        F.when(there, F.lit("success")).otherwise(F.lit("error")).alias("status"),
        F.when(there, F.concat(F.lit("File "), "name", F.lit(IMPORTED))).otherwise(F.concat(F.lit("File "), "name", F.lit(NOT_FOUND))).alias("message"),
        F.coalesce("_found", F.lit(0).cast("bigint")).alias("imported_files_count"),
        F.lit(corpus).alias("corpus_name"), "file_uri")


def _write(df: DataFrame, path: str, batch_id: int) -> None:
    (df.withColumn("batch_id", F.lit(batch_id).cast("bigint")).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path))


def start_import(envelopes: DataFrame, loader: Loader, corpus: str, out: str, embedder: Embedder | None = None,
                 size: int = IMPORT_CHUNKING[0], overlap: int = IMPORT_CHUNKING[1], on_malformed: str = "quarantine",
                 dedup_within: str | None = None, available_now: bool = True) -> StreamingQuery:
    """Start the import stream: chunks, status and quarantine tables below ``out``.

    ``loader`` turns events (file_uri) into documents (file_uri, text); repeated
    events import again unless ``dedup_within`` gives a time span. All three
    outputs are keyed by batch, so a replayed batch replaces itself. With
    ``on_malformed='fail'`` a bad event stops the stream with its payload.
    """
    if on_malformed not in ("quarantine", "fail"):
        raise ValueError("on_malformed must be quarantine or fail")
    if dedup_within:
        timed = envelopes.withColumn("_seen", F.current_timestamp()).withWatermark("_seen", dedup_within)
        envelopes = timed.withColumn("_data", F.col("message.data")).dropDuplicatesWithinWatermark(["_data"]).drop("_data", "_seen")

    def run(batch: DataFrame, batch_id: int) -> None:
        events = decode_events(batch).persist()
        try:
            bad = events.filter(F.col("problem").isNotNull()).select("data", "problem")
            if on_malformed == "fail":
                first = bad.take(1)
                if first:
                    raise ValueError(f"Missing or malformed event {first[0]['data']}: {first[0]['problem']}")
            _write(bad, f"{out}/quarantine", batch_id)
            good = events.filter(F.col("problem").isNull()).select("name", "bucket", "file_uri")
            # Loaded once into a table of the batch; chunks and status both read that.
            loaded = f"{out}/loaded/batch-{batch_id}"
            loader(good.select("file_uri").distinct()).select("file_uri", "text").write.mode("overwrite").parquet(loaded)
            docs = batch.sparkSession.read.schema("file_uri string, text string").parquet(loaded)
            import_documents(docs, corpus, f"{out}/chunks", embedder, size, overlap, batch_id)
            _write(status_rows(good, docs.select("file_uri"), corpus), f"{out}/status", batch_id)
        finally:
            events.unpersist()

    writer = envelopes.writeStream.foreachBatch(run).option("checkpointLocation", f"{out}/offsets")
    return (writer.trigger(availableNow=True) if available_now else writer).start()
