"""Object URIs, public URLs and upload-event payloads."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: scheme of object URIs.
SCHEME = "gs://"


def object_uri(bucket: Column, name: Column) -> Column:
    return F.concat(F.lit(SCHEME), bucket, F.lit("/"), name)


def uri_bucket(uri: Column) -> Column:
    """Bucket of an object URI, null when the URI is not valid."""
    return F.when(uri_valid(uri), F.regexp_extract(uri, r"(?s)^gs://([^/]*)/(.*)$", 1))


def uri_object(uri: Column) -> Column:
    """Object name of an object URI: all after the first slash that ends the bucket."""
    return F.when(uri_valid(uri), F.regexp_extract(uri, r"(?s)^gs://([^/]*)/(.*)$", 2))


def uri_valid(uri: Column) -> Column:
    return F.coalesce(F.startswith(uri, F.lit(SCHEME)) & F.substring(uri, 6, 1 << 30).contains("/"), F.lit(False))


def public_url(prefix: str, folder: Column, path: Column) -> Column:
    """Public address: prefix, folder and last path part; folders in between are dropped."""
    return F.concat(F.lit(prefix), folder, F.lit("/"), F.element_at(F.split(path, "/"), -1))


def decode_event(data: Column) -> Column:
    """Struct (name, bucket, problem) of a base64 JSON upload event.

    ``problem`` is null for a usable event and says what is wrong otherwise.
    """
    raw = F.try_to_binary(data, F.lit("base64"))
    text = F.decode(raw, "UTF-8")
    root = F.try_parse_json(text)
    name = F.try_variant_get(root, "$.name", "string")
    bucket = F.try_variant_get(root, "$.bucket", "string")
    problem = (F.when(raw.isNull(), F.lit("not base64"))
               .when(root.isNull(), F.lit("not JSON"))
               .when(name.isNull(), F.lit("missing name"))
               .when(bucket.isNull(), F.lit("missing bucket")))
    return F.struct(name.alias("name"), bucket.alias("bucket"), problem.alias("problem"))
