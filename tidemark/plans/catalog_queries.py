"""Queries over the product catalog."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import catalog as rules
from tidemark.operators.catalog import clean_catalog, number_batches
from tidemark.plans.tables import raw_catalog
from tidemark.session import scratch_path
from tidemark.sources.readers import read_catalog
from tidemark.sources.writers import write_numbered_batches

BATCH = 500

# Expected pieces, written directly from the part columns.
_SPECS = """CASE p_type WHEN 'ECONOMY' THEN 'Type: ECONOMY, size ' || p_size WHEN 'PROMO' THEN 'Type: PROMO'
            WHEN 'SMALL' THEN 'Size: ' || p_size WHEN 'LARGE' THEN 'Size: ' || p_size ELSE '' END"""
_TREE = """CASE p_type WHEN 'SMALL' THEN p_type || ', ' || replace(p_name, ' ', ', ')
           WHEN 'LARGE' THEN '[]' ELSE p_type || ', ' || p_brand || ', ' || replace(p_name, ' ', ', ') || ', a' END"""
_BRAND = "CASE WHEN p_type = 'MEDIUM' THEN '' ELSE p_brand END"
_DESCRIPTION = "CASE WHEN p_type = 'PROMO' THEN '' ELSE 'Size ' || p_size || '.' END"
_TEXT = f"""p_name || '. Brand: ' || {_BRAND} || '. Category: ' || {_TREE} || '.'
            || CASE WHEN {_DESCRIPTION} <> '' THEN ' ' || {_DESCRIPTION} ELSE '' END
            || CASE WHEN {_SPECS} <> '' THEN ' ' || {_SPECS} ELSE '' END"""
_URL = "'http://img.example/' || p_partkey"
_IMAGES = f"""CASE p_type WHEN 'SMALL' THEN {_URL} || '.jpg' WHEN 'LARGE' THEN ''
              ELSE {_URL} || '-1.jpg|' || {_URL} || '-2.jpg' END"""


def catalog_clean(spark, sf_dir):
    cleaned = clean_catalog(raw_catalog(spark, sf_dir))
    m = F.col("metadata")
    return cleaned.select("id", "text_for_embedding", m["product_name"].alias("product_name"), m["brand"].alias("brand"),
                          m["retail_price_number"].alias("retail_price_number"), m["product_url"].alias("product_url"),
                          F.size(m["image_urls"]).cast("bigint").alias("images"))


def catalog_specs(spark, sf_dir):
    return raw_catalog(spark, sf_dir).select("uniq_id", rules.specification_text(F.col("product_specifications")).alias("specs"))


def catalog_category(spark, sf_dir):
    return raw_catalog(spark, sf_dir).select("uniq_id", rules.category_path(F.col("product_category_tree")).alias("category"))


def catalog_images(spark, sf_dir):
    urls = rules.image_urls(F.col("image"))
    return raw_catalog(spark, sf_dir).select("uniq_id", F.size(urls).cast("bigint").alias("images"),
                                             F.array_join(urls, "|").alias("urls"))


def catalog_prices(spark, sf_dir):
    return raw_catalog(spark, sf_dir).select(
        "uniq_id", "retail_price", rules.price_number(F.col("retail_price")).alias("retail_number"),
        "discounted_price", rules.price_number(F.col("discounted_price")).alias("discounted_number"))


def catalog_batches(spark, sf_dir):
    numbered = number_batches(raw_catalog(spark, sf_dir).select(F.col("uniq_id").cast("bigint").alias("part"), "product_name"),
                              ["part"], BATCH)
    return numbered.select("part", "row_no", "batch")


def catalog_files(spark, sf_dir):
    """Raw rows to CSV, scan, clean, numbered JSONL batches, and what the files then hold."""
    source, out = scratch_path(spark, "catalog-csv"), scratch_path(spark, "catalog-jsonl")
    raw_catalog(spark, sf_dir).write.option("header", True).option("escape", '"').csv(source)
    raw = read_catalog(spark, source).withColumn("part", F.col("uniq_id").cast("bigint"))
    cleaned = clean_catalog(number_batches(raw, ["part"], BATCH), ["part", "row_no", "batch"])
    write_numbered_batches(cleaned.select("part", "text_for_embedding", "row_no", "batch"), out)
    rows = spark.read.schema("part bigint, text_for_embedding string, batch bigint").json(out)
    return rows.groupBy("batch").agg(F.count(F.lit(1)).alias("n"), F.min("part").alias("first_part"),
                                     F.max("part").alias("last_part"),
                                     F.sum(F.length("text_for_embedding")).alias("chars"))


QUERIES = {f.__name__: f for f in (catalog_clean, catalog_specs, catalog_category, catalog_images, catalog_prices,
                                   catalog_batches, catalog_files)}

SQL = {
    "catalog_clean": f"""
        SELECT p_partkey::varchar AS id, {_TEXT} AS text_for_embedding, p_name AS product_name, {_BRAND} AS brand,
               CASE WHEN p_retailprice = floor(p_retailprice) THEN p_retailprice::bigint END AS retail_price_number,
               'http://shop.example/' || p_partkey AS product_url,
               CASE p_type WHEN 'SMALL' THEN 1 WHEN 'LARGE' THEN 0 ELSE 2 END::bigint AS images
        FROM part""",
    "catalog_specs": f"SELECT p_partkey::varchar AS uniq_id, {_SPECS} AS specs FROM part",
    "catalog_category": f"SELECT p_partkey::varchar AS uniq_id, {_TREE} AS category FROM part",
    "catalog_images": f"""
        SELECT p_partkey::varchar AS uniq_id, CASE p_type WHEN 'SMALL' THEN 1 WHEN 'LARGE' THEN 0 ELSE 2 END::bigint AS images,
               {_IMAGES} AS urls FROM part""",
    "catalog_prices": """
        SELECT p_partkey::varchar AS uniq_id,
               CASE WHEN p_retailprice = floor(p_retailprice) THEN p_retailprice::bigint::varchar
                    ELSE printf('%.2f', p_retailprice) END AS retail_price,
               CASE WHEN p_retailprice = floor(p_retailprice) THEN p_retailprice::bigint END AS retail_number,
               CASE WHEN p_type = 'PROMO' THEN '' ELSE '0' || floor(p_retailprice)::bigint END AS discounted_price,
               CASE WHEN p_type <> 'PROMO' THEN floor(p_retailprice)::bigint END AS discounted_number
        FROM part""",
    "catalog_batches": f"""
        SELECT p_partkey AS part, row_number() OVER (ORDER BY p_partkey) AS row_no,
               ((row_number() OVER (ORDER BY p_partkey) - 1) // {BATCH} + 1)::bigint AS batch FROM part""",
    "catalog_files": f"""
        WITH t AS (SELECT p_partkey, length({_TEXT}) AS chars,
                          ((row_number() OVER (ORDER BY p_partkey) - 1) // {BATCH} + 1)::bigint AS batch FROM part)
        SELECT batch, count(*) AS n, min(p_partkey) AS first_part, max(p_partkey) AS last_part,
               sum(chars)::bigint AS chars FROM t GROUP BY batch""",
}
