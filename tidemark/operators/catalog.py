"""Product catalog: raw rows to embedding-ready documents and numbered batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import catalog as rules
from tidemark.operators.ordered import global_row_number

# Fixed value: documents per output file.
BATCH_ROWS = 5000


def clean_catalog(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Catalog rows to (id, text_for_embedding, metadata) and any columns to keep. One narrow pass."""
    category = rules.category_path(F.col("product_category_tree"))
    specs = rules.specification_text(F.col("product_specifications"))
    return raw.select(
        *keep, F.col("uniq_id").alias("id"),
        rules.embedding_text(F.col("product_name"), F.col("brand"), category, F.col("description"),
                             specs).alias("text_for_embedding"),
        F.struct(
            "product_name", "brand",
            rules.price_number(F.col("retail_price")).alias("retail_price_number"),
            F.col("retail_price").alias("retail_price_raw"),
            rules.price_number(F.col("discounted_price")).alias("discounted_price_number"),
            F.col("discounted_price").alias("discounted_price_raw"),
            rules.image_urls(F.col("image")).alias("image_urls"),
            "product_url").alias("metadata"))


def unusable_specifications(raw: DataFrame) -> DataFrame:
    """Number of rows whose specification holds a bare value and was read as empty."""
    return raw.agg(F.count_if(rules.specification_unusable(F.col("product_specifications"))).alias("unusable"))


def as_json_documents(cleaned: DataFrame) -> DataFrame:
    """Cleaned rows with one price field each, ready for the JSON sink."""
    m = F.col("metadata")
    return cleaned.select(
        "id", "text_for_embedding",
        F.struct(
            m["product_name"].alias("product_name"), m["brand"].alias("brand"),
            rules.price_variant(m["retail_price_number"], m["retail_price_raw"]).alias("retail_price"),
            rules.price_variant(m["discounted_price_number"], m["discounted_price_raw"]).alias("discounted_price"),
            m["image_urls"].alias("image_urls"), m["product_url"].alias("product_url")).alias("metadata"))


def number_batches(df: DataFrame, order: list[str], batch_rows: int = BATCH_ROWS) -> DataFrame:
    """Add ``row_no`` (from 1, in the given order) and ``batch`` (from 1)."""
    numbered = global_row_number(df, order, "row_no")
    return numbered.withColumn("batch", F.ceil(F.col("row_no") / F.lit(batch_rows)).cast("bigint"))
