"""Work that must be done once, and patches that arrive late."""

from pyspark.sql import functions as F

from tidemark.operators import customers, images
from tidemark.session import scratch_path
from tidemark.sources.writers import append_valid, read_version, write_version
from tidemark.streaming import imports
from tidemark.streaming.updates import start_customer_updates


def test_each_image_is_embedded_once(spark, tmp_path):
    log = str(tmp_path / "calls")

    def embed(data: bytes, _: str):
        with open(log, "ab") as f:
            f.write(data + b"\n")
        return None if data == b"3" else [] if data == b"4" else [1.0]

    df = spark.range(10).selectExpr("CAST(id AS STRING) AS id", "'f' AS folder", "CAST(CAST(id AS STRING) AS BINARY) AS content")
    out, errors = scratch_path(spark, "ok"), scratch_path(spark, "bad")
    append_valid(images.embed_images(df, embed), F.size("embedding_field") > 0, out, errors)
    assert len(open(log).read().split()) == 10
    assert spark.read.parquet(out).count() == 8 and {r.id for r in spark.read.parquet(errors).collect()} == {"3", "4"}


def test_each_object_is_read_once_and_missing_ones_are_errors(spark, tmp_path):
    events, out, log = scratch_path(spark, "events"), scratch_path(spark, "import"), str(tmp_path / "reads")
    rows = [(f'{{"name":"{n}","bucket":"b"}}',) for n in ("one", "two", "gone")]
    df = spark.createDataFrame(rows, "j string")
    df.select(F.struct(F.base64(F.encode("j", "UTF-8")).alias("data")).alias("message")).write.json(events)

    def read(uri: str):
        with open(log, "a") as f:
            f.write(uri + "\n")
        return None if uri.endswith("gone") else "some text"

    loader = imports.object_loader(read)
    stream = spark.readStream.schema("message struct<data:string>").json(events)
    imports.start_import(stream, lambda uris: loader(uris).filter("text IS NOT NULL"), "c", out).awaitTermination()
    assert sorted(open(log).read().split()) == ["gs://b/gone", "gs://b/one", "gs://b/two"]
    status = {r.message: (r.status, r.imported_files_count) for r in spark.read.parquet(f"{out}/status").collect()}
    assert status["File gone was not found"] == ("error", 0) and status["File one imported to RAG corpus successfully"] == ("success", 1)


def test_an_older_patch_that_comes_late_changes_nothing(spark, fixed):
    table, landing, offsets = (scratch_path(spark, n) for n in ("table", "landing", "offsets"))
    record = '{"customer_id":1,"email":"first","phone":"0"}'
    base = spark.createDataFrame([(0, "1", record)], "pos int, key string, j string")
    write_version(base.selectExpr("pos", "key", "from_json(j, 'customer_id bigint, email string, phone string') AS customer", "j AS fields"), table)
    for patch in ((1, '{"email":"new"}', 2), (1, '{"email":"old","phone":null}', 1), (1, '{"email":"newest"}', 3), (1, 'no json', 9)):
        fixed("customer_id bigint, patch string, ts int", patch).write.mode("append").parquet(landing)
        feed = spark.readStream.schema("customer_id bigint, patch string, ts int").parquet(landing)
        start_customer_updates(feed, table, offsets, ["ts"]).awaitTermination()
    import json
    assert json.loads(read_version(spark, table).first().fields) == {"customer_id": 1, "email": "newest", "phone": None}
    bad = customers.rejected_patches(fixed("customer_id bigint, patch string", (1, "no json"), (2, "{}")))
    assert [r.customer_id for r in bad.collect()] == [1]
