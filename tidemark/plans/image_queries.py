"""Queries over the image listing."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import images
from tidemark.plans.tables import OBJECT_PREFIX, image_objects
from tidemark.session import scratch_path
from tidemark.sources.writers import append_valid

BUCKET = "gallery"
PUBLIC = "https://files.example/gallery/pictures/"
DIMS = 512


def byte_histogram(data: bytes, context: str) -> list[float] | None:
    """Stand-in image embedder: byte counts in 512 places. Spanish folders fail, to exercise the error path."""
    if context == "es":
        raise ValueError("unreadable")
    counts = [0.0] * DIMS
    for byte in data:
        counts[2 * byte] += 1.0
    return counts


def image_catalog(spark, sf_dir):
    return images.catalog_images(image_objects(spark, sf_dir), OBJECT_PREFIX, BUCKET, PUBLIC)


def image_folders(spark, sf_dir):
    return images.image_folders(image_objects(spark, sf_dir), OBJECT_PREFIX)


def image_import(spark, sf_dir):
    """Number, embed and append the images; failed ones go to the errors table and keep their id."""
    out, errors = scratch_path(spark, "images"), scratch_path(spark, "image-errors")
    listed = images.catalog_images(image_objects(spark, sf_dir), OBJECT_PREFIX, BUCKET, PUBLIC)
    with_bytes = listed.withColumn("content", F.encode("path", "UTF-8"))
    embedded = images.embed_images(with_bytes, byte_histogram)
    append_valid(embedded, F.size("embedding_field") > 0, out, errors)
    stored = images.image_documents(spark.read.parquet(out)).select(
        "id", F.col("embedding_field").isNotNull().alias("stored"),
        F.round(F.aggregate("embedding_field", F.lit(0.0), lambda a, x: a + x.cast("double")), 1).alias("bytes"))
    failed = spark.read.parquet(errors).select("id", F.lit(False).alias("stored"), F.lit(None).cast("double").alias("bytes"))
    return stored.unionByName(failed)


QUERIES = {f.__name__: f for f in (image_catalog, image_folders, image_import)}

_OBJECTS = f"""
    o AS (SELECT '{OBJECT_PREFIX}' || regexp_replace(regexp_extract(url, '^https?://[^/]+/([^?#]*)', 1), '/$', '')
                 || CASE WHEN contains(url, '#') THEN '.JPG' ELSE '.jpg' END AS path FROM pages),
    i AS (SELECT path, split_part(path, '/', 2) AS folder FROM o
          WHERE ends_with(path, '.jpg') AND len(string_split(path, '/')) >= 3),
    n AS (SELECT *, row_number() OVER (ORDER BY folder, path) AS no FROM i)"""

SQL = {
    "image_catalog": f"""WITH {_OBJECTS}
        SELECT no::varchar AS id, folder, path, 'gs://{BUCKET}/' || path AS gcs_uri,
               '{PUBLIC}' || folder || '/' || string_split(path, '/')[-1] AS public_url FROM n""",
    "image_folders": f"WITH {_OBJECTS} SELECT DISTINCT folder FROM i ORDER BY folder",
    "image_import": f"""WITH {_OBJECTS}
        SELECT no::varchar AS id, folder <> 'es' AS stored,
               CASE WHEN folder <> 'es' THEN strlen(path)::double END AS bytes FROM n""",
}
