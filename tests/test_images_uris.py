import base64
import json

import pytest
from pyspark.sql import functions as F

from tidemark.functions import uris
from tidemark.operators import images
from tidemark.session import scratch_path
from tidemark.sources.readers import list_objects, read_image_bytes
from tidemark.sources.writers import append_valid

PATHS = ["pre/dog/z.jpg", "pre/cat/a.jpg", "pre/cat/sub/b.jpg", "pre/c.jpg", "pre/dog/d.JPG", "pre/dog/e.png", "other/cat/x.jpg"]


@pytest.fixture
def objects(fixed):
    return fixed("path string", *[(p,) for p in PATHS])


def test_catalog_ids_follow_folder_and_name(objects):
    got = images.catalog_images(objects, "pre/", "bucket", "https://host/pre/").collect()
    assert {(r.id, r.path, r.public_url, r.gcs_uri) for r in got} == {
        ("1", "pre/cat/a.jpg", "https://host/pre/cat/a.jpg", "gs://bucket/pre/cat/a.jpg"),
        ("2", "pre/cat/sub/b.jpg", "https://host/pre/cat/b.jpg", "gs://bucket/pre/cat/sub/b.jpg"),
        ("3", "pre/dog/z.jpg", "https://host/pre/dog/z.jpg", "gs://bucket/pre/dog/z.jpg")}


def test_folders(objects):
    assert [r.folder for r in images.image_folders(objects, "pre/").collect()] == ["cat", "dog"]


def test_failed_embedding_uses_up_its_id(spark, objects):
    def embed(data, context):
        if b"sub" in data:
            raise ValueError("bad image")
        return [float(len(data)), float(len(context))]

    listed = images.catalog_images(objects, "pre/", "b", "p/").withColumn("content", F.encode("path", "UTF-8"))
    embedded = images.embed_images(listed, embed)
    good, bad = scratch_path(spark, "good"), scratch_path(spark, "bad")
    append_valid(embedded, F.col("embedding_field").isNotNull(), good, bad)
    stored = images.image_documents(spark.read.parquet(good)).collect()
    assert {(r.id, tuple(r.embedding_field)) for r in stored} == {("1", (13.0, 3.0)), ("3", (13.0, 3.0))}
    assert [r.id for r in spark.read.parquet(bad).collect()] == ["2"]


def test_listing_finds_nested_lower_case_jpg_only(spark, tmp_path):
    for name in ("cat/a.jpg", "cat/sub/b.jpg", "dog/d.JPG", "dog/e.png"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(b"x" * 3)
    assert {r.path.rsplit("/", 1)[1] for r in list_objects(spark, str(tmp_path)).collect()} == {"a.jpg", "b.jpg"}
    assert {len(r.content) for r in read_image_bytes(spark, str(tmp_path)).collect()} == {3}


def test_uri_parts(fixed):
    df = fixed("u string", ("gs://b/a/c.txt",), ("gs://b",), ("http://b/a",), ("gs:///a",), (None,))
    got = df.select(uris.uri_valid(F.col("u")), uris.uri_bucket(F.col("u")), uris.uri_object(F.col("u"))).collect()
    assert [tuple(r) for r in got] == [(True, "b", "a/c.txt"), (False, None, None), (False, None, None), (True, "", "a"),
                                       (False, None, None)]


def test_event_decoding(fixed):
    def b64(value):
        return base64.b64encode(value.encode()).decode()

    df = fixed("data string", (b64(json.dumps({"name": "n", "bucket": "b", "x": 1})),), (b64('{"name": "n"}'),), (b64("[1]"),),
               (b64("no json"),), ("!!!",), (b64('{"bucket": "b"}'),))
    got = [r.e.problem for r in df.select(uris.decode_event(F.col("data")).alias("e")).collect()]
    assert got == [None, "missing bucket", "missing name", "not JSON", "not base64", "missing name"]
