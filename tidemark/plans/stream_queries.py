"""Queries that run a stream to its end and show what it wrote."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.embed import hashed_embedder
from tidemark.functions.uris import uri_bucket
from tidemark.plans.tables import customer_patches, customer_records, documents_as_files, table
from tidemark.session import scratch_path
from tidemark.sources.readers import read_upload_events
from tidemark.streaming.imports import start_import
from tidemark.streaming.updates import CustomerTable, start_customer_merges

CORPUS = "stream-check"
DIMS = 768
PATCH_RUNS = 3


def _run_import(spark, sf_dir):
    """Write one event per document as JSON lines and import them.

    The language decides how the event is damaged: German ones are not base64,
    Spanish ones not JSON, French ones lack the bucket. Objects of one source are not there.
    """
    events, out = scratch_path(spark, "events"), scratch_path(spark, "import")
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang")
    name = F.concat(F.lit("doc-"), F.col("doc_id").cast("string"), F.lit(".txt"))
    whole = F.to_json(F.struct(name.alias("name"), F.col("source").alias("bucket")))
    part = F.to_json(F.struct(name.alias("name")))
    payload = F.when(F.col("lang") == "es", name).when(F.col("lang") == "fr", part).otherwise(whole)
    data = F.when(F.col("lang") == "de", F.concat(F.lit("!!"), name)).otherwise(F.base64(F.encode(payload, "UTF-8")))
    docs.select(F.struct(data.alias("data")).alias("message")).write.json(events)
    files = documents_as_files(spark, sf_dir).filter("source <> 'src0'").select("file_uri", "text")
    query = start_import(read_upload_events(spark, events), lambda uris: uris.join(files, "file_uri"), CORPUS, out,
                         hashed_embedder(DIMS))
    query.awaitTermination()
    return out


def stream_import(spark, sf_dir):
    out = _run_import(spark, sf_dir)
    return spark.read.parquet(f"{out}/status").select("status", "message", "imported_files_count", "corpus_name", "file_uri")


def stream_quarantine(spark, sf_dir):
    out = _run_import(spark, sf_dir)
    return spark.read.parquet(f"{out}/quarantine").select("data", "problem")


def stream_chunks(spark, sf_dir):
    """Chunks stored by the import stream, per source."""
    out = _run_import(spark, sf_dir)
    stored = spark.read.parquet(f"{out}/chunks")
    return stored.groupBy(uri_bucket(F.col("file_uri")).alias("source")).agg(
        F.countDistinct("file_uri").alias("files"), F.sum("n_tokens").alias("tokens"))


def customer_feed(spark, sf_dir):
    """The customer table after the patch feed has been streamed in, in several batches that each rewrite what they touch.
    Every tenth order sends a patch that is no JSON beside it: those are told as rows without a customer."""
    table, landing = CustomerTable(scratch_path(spark, "customers")), scratch_path(spark, "patches")
    options = {"ignoreNullFields": "false"}
    table.create(customer_records(spark, sf_dir).withColumn("fields", F.to_json("fields", options)),
                 [("event_ts", "timestamp_ntz"), ("event_no", "bigint")])
    patches, offsets = customer_patches(spark, sf_dir), scratch_path(spark, "offsets")
    broken = patches.filter("event_no % 10 = 0").withColumn("patch", F.concat(F.lit("no JSON "), F.col("event_no").cast("string")))
    sent = patches.unionByName(broken)
    for run in range(PATCH_RUNS):  # patches of all times arrive in each batch, so older ones come late
        sent.filter(F.pmod(F.xxhash64("event_no"), F.lit(PATCH_RUNS)) == run).write.mode("append").parquet(landing)
        feed = spark.readStream.schema("customer_id bigint, patch string, event_ts timestamp_ntz, event_no bigint").parquet(landing)
        start_customer_merges(feed, table, offsets, ["event_ts", "event_no"]).awaitTermination()

    def field(name):
        return F.get_json_object("fields", f"$.{name}")

    stored = table.records.read(spark).select(
        F.col("customer.customer_id").alias("customer_id"), field("lastOrder").alias("last_order"),
        field("lastPriority").alias("last_priority"), field("address.street").alias("street"))
    told = spark.read.parquet(f"{table.path}/rejected").select(F.col("patch").alias("street"))
    return stored.unionByName(told, allowMissingColumns=True)


QUERIES = {f.__name__: f for f in (stream_import, stream_quarantine, stream_chunks, customer_feed)}

SQL = {
    "stream_import": f"""
        SELECT CASE WHEN source = 'src0' THEN 'error' ELSE 'success' END AS status,
               'File doc-' || doc_id || CASE WHEN source = 'src0' THEN '.txt was not found' ELSE '.txt imported to RAG corpus successfully' END AS message,
               CASE WHEN source = 'src0' THEN 0 ELSE 1 END::bigint AS imported_files_count, '{CORPUS}' AS corpus_name, 'gs://' || source || '/doc-' || doc_id || '.txt' AS file_uri
        FROM documents WHERE lang = 'en'""",
    "stream_quarantine": """
        SELECT CASE lang WHEN 'de' THEN '!!doc-' || doc_id || '.txt' WHEN 'es' THEN base64(('doc-' || doc_id || '.txt')::blob)
                         ELSE base64(('{"name":"doc-' || doc_id || '.txt"}')::blob) END AS data,
               CASE lang WHEN 'de' THEN 'not base64' WHEN 'es' THEN 'not JSON' ELSE 'missing bucket' END AS problem
        FROM documents WHERE lang <> 'en'""",
    "stream_chunks": """
        WITH w AS (SELECT source, doc_id, len(list_filter(regexp_split_to_array(text, '[ \\t\\n\\r\\f\\x0b]+'), lambda x: x <> '')) AS n
                   FROM documents WHERE lang = 'en' AND source <> 'src0'),
             c AS (SELECT *, greatest(1, ceil((n - 100) / 412.0))::int AS k FROM w WHERE n > 0)
        SELECT source, count(*) AS files, sum(n + (k - 1) * 100)::bigint AS tokens FROM c GROUP BY source""",
    "customer_feed": """
        WITH f AS (SELECT o_custkey AS id, arg_max(o_orderpriority, (o_orderdate, o_orderkey)) AS prio FROM orders WHERE o_orderstatus = 'F' GROUP BY 1),
             o AS (SELECT o_custkey AS id, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS ord FROM orders WHERE o_orderstatus = 'O' GROUP BY 1)
        SELECT c_custkey AS customer_id, ord::varchar AS last_order, prio AS last_priority,
               coalesce(prio, split_part(c_name, '#', 2) || ' Main Street') AS street
        FROM customer LEFT JOIN f ON f.id = c_custkey LEFT JOIN o ON o.id = c_custkey
        UNION ALL SELECT NULL, NULL, NULL, 'no JSON ' || o_orderkey FROM orders WHERE o_orderkey % 10 = 0""",
}
