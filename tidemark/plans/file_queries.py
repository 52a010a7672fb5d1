"""Queries that write the given tables as files and read them through the file sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import tuning
from tidemark.operators.corpus import chunk_documents
from tidemark.plans.tables import customer_records, table
from tidemark.session import scratch_path
from tidemark.sources import readers

#: Customers in one keyed JSON file.
FILE_CUSTOMERS = 500


def text_files(spark, sf_dir):
    """Each benchmark text as a file of its own, read back and chunked."""
    path = scratch_path(spark, "texts")
    table(spark, sf_dir, "benchmark").select("item_id", "text").write.partitionBy("item_id").text(path)
    files = readers.read_text_files(spark, path)
    item = F.regexp_extract("file_uri", "item_id=([0-9]+)/", 1).cast("bigint")
    return chunk_documents(files).select(item.alias("item_id"), "chunk_id", "n_tokens")


def summary_csv(spark, sf_dir):
    """Documents as a summary CSV with quoted line breaks, and the statistics of what is read back."""
    path = scratch_path(spark, "tests")
    docs = table(spark, sf_dir, "documents").select(F.col("source").alias("input_text"), F.col("text").alias("output_text"))
    docs.write.option("header", True).option("quoteAll", True).option("escape", '"').csv(path)
    stats = tuning.length_statistics(readers.read_summary_tests(spark, path))
    return stats.select("metric", "count", *[F.round(c, 6).alias(c) for c in ("mean", "std", "min", "p25", "p50", "p75", "max")], "token_budget")


def keyed_customers(spark, sf_dir):
    """Customers as keyed JSON objects in several files, read back with one count of positions through all of them."""
    path = scratch_path(spark, "customers")
    rows = customer_records(spark, sf_dir).select("pos", "key", F.to_json("fields", {"ignoreNullFields": "false"}).alias("record"))
    lines = rows.withColumn("file", F.floor(F.col("pos") / FILE_CUSTOMERS)).groupBy("file").agg(
        F.sort_array(F.collect_list(F.struct("pos", "key", "record"))).alias("rows"))
    entry = F.transform("rows", lambda r: F.concat(F.lit('"'), r["key"], F.lit('": '), r["record"]))
    whole = lines.select(F.lpad(F.col("file").cast("string"), 9, "0").alias("file"), F.concat(F.lit("{"), F.array_join(entry, ", "), F.lit("}")).alias("value"))
    whole.write.partitionBy("file").text(path)
    found = readers.read_keyed_customers(spark, path)
    return found.select("pos", "key", F.col("customer.email").alias("email"), F.col("customer.address.country").alias("country"))


def object_listing(spark, sf_dir):
    """Pages written below one folder for each language, and the folders that the listing shows."""
    path = scratch_path(spark, "objects")
    language = F.regexp_extract("url", "^https?://[^/]+/([a-z]+)/", 1)
    table(spark, sf_dir, "pages").select(language.alias("lang"), F.col("url").alias("value")).write.partitionBy("lang").text(path)
    listed = readers.list_objects(spark, path, "*.txt")
    return listed.select(F.regexp_extract("path", "lang=([a-z]+)/", 1).alias("folder")).distinct()


QUERIES = {f.__name__: f for f in (text_files, summary_csv, keyed_customers, object_listing)}

SQL = {
    "text_files": """
        WITH w AS (SELECT item_id, len(list_filter(regexp_split_to_array(text, '[ \\t\\n\\r\\f\\x0b]+'), lambda x: x <> '')) AS n FROM benchmark),
             c AS (SELECT item_id, n, unnest(range(greatest(1, ceil((n - 100) / 412.0))::int)) AS i FROM w WHERE n > 0)
        SELECT item_id, i::int AS chunk_id, least(512, n - i * 412)::int AS n_tokens FROM c""",
    "summary_csv": """
        WITH d AS (SELECT length(text)::double AS c FROM documents)
        SELECT 'length' AS metric, count(c) AS count, round(avg(c), 6) AS mean, round(stddev_samp(c), 6) AS std, min(c) AS min,
               round(quantile_cont(c, 0.25), 6) AS p25, round(quantile_cont(c, 0.5), 6) AS p50, round(quantile_cont(c, 0.75), 6) AS p75,
               max(c) AS max, ceil(max(c) / 4)::bigint AS token_budget FROM d""",
    "keyed_customers": """
        SELECT row_number() OVER (ORDER BY c_custkey) - 1 AS pos, c_custkey::varchar AS key, lower(c_mktsegment) || '@mail.example' AS email,
               n_name AS country FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey""",
    "object_listing": "SELECT DISTINCT regexp_extract(url, '^https?://[^/]+/([a-z]+)/', 1) AS folder FROM pages",
}
