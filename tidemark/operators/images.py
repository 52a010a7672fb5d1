"""Image catalog: object listing to numbered image documents."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.uris import object_uri, public_url
from tidemark.operators.ordered import global_row_number

# Suffix and least number of path parts of an image object.
SUFFIX = ".jpg"
MIN_PARTS = 3


def image_objects(objects: DataFrame, prefix: str) -> DataFrame:
    """Objects that count as images, with their folder: (path, folder).

    The folder is the second path part, found in the same pass as the listing.
    """
    parts = F.split("path", "/")
    return (objects.filter(F.startswith("path", F.lit(prefix)) & F.endswith("path", F.lit(SUFFIX)))
            .filter(F.size(parts) >= MIN_PARTS)
            .select("path", F.element_at(parts, 2).alias("folder")))


def image_folders(objects: DataFrame, prefix: str) -> DataFrame:
    """Distinct folders in order."""
    return image_objects(objects, prefix).select("folder").distinct().orderBy("folder")


def catalog_images(objects: DataFrame, prefix: str, bucket: str, public_prefix: str) -> DataFrame:
    """Numbered images: (id, folder, path, gcs_uri, public_url).

    Ids count from 1 over (folder, path) before any embedding is made, so an
    image whose embedding fails still uses up its id.
    """
    numbered = global_row_number(image_objects(objects, prefix), ["folder", "path"], "n")
    return numbered.select(
        F.col("n").cast("string").alias("id"), "folder", "path",
        object_uri(F.lit(bucket), F.col("path")).alias("gcs_uri"),
        public_url(public_prefix, F.col("folder"), F.col("path")).alias("public_url"))


def embed_images(images: DataFrame, embed: Callable[[bytes, str], list[float] | None], content: str = "content",
                 context: str = "folder", out: str = "embedding_field") -> DataFrame:
    """Call an image embedder per row with its folder as context text; a failed call gives null.

    ``embed`` is the hook for a hosted or local model and runs inside the tasks.
    """
    schema = images.drop(content).withColumn(out, F.lit(None).cast("array<float>")).schema

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            vectors = []
            for data, text in zip(batch[content], batch[context]):
                try:
                    vectors.append(embed(data, text))
                except Exception:  # noqa: BLE001 - a failing image must not stop the import
                    vectors.append(None)
            yield batch.drop(columns=[content]).assign(**{out: vectors})

    return images.mapInPandas(run, schema)


def image_documents(images: DataFrame, vector: str = "embedding_field") -> DataFrame:
    """Documents for the image collection: rows with an embedding, path = public URL."""
    return (images.filter(F.size(vector) > 0)
            .select("id", F.col(vector).alias("embedding_field"), F.col("public_url").alias("path")))
