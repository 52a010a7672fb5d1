import base64
import json

import pytest

from tidemark.functions.embed import hashed_embedder
from tidemark.operators.vector_index import build_index, read_leaves
from tidemark.session import scratch_path
from tidemark.sources.readers import read_upload_events
from tidemark.streaming.imports import object_loader, start_import
from tidemark.streaming.updates import start_index_updates


def envelope(payload):
    return json.dumps({"message": {"data": payload}})


def b64(value):
    return base64.b64encode(value.encode()).decode()


GOOD = envelope(b64('{"name": "a.txt", "bucket": "b"}'))
OTHER = envelope(b64('{"name": "gone.txt", "bucket": "b"}'))
BAD = [envelope(b64('{"name": "n"}')), envelope(b64("no json")), envelope("!!!"), json.dumps({"message": {}})]


@pytest.fixture
def run(spark, tmp_path, fixed):
    files = fixed("file_uri string, text string", ("gs://b/a.txt", "one two three"))
    events = tmp_path / "events"
    events.mkdir()

    def start(lines, out, name="1.json", **options):
        (events / name).write_text("\n".join(lines), encoding="utf-8")
        query = start_import(read_upload_events(spark, str(events)), lambda uris: uris.join(files, "file_uri"), "corpus", out,
                             hashed_embedder(8), **options)
        query.awaitTermination()

    return start


def test_import_status_chunks_and_quarantine(spark, run):
    out = scratch_path(spark, "import")
    run([GOOD, OTHER, *BAD], out)
    status = {r.file_uri: r for r in spark.read.parquet(f"{out}/status").collect()}
    assert status["gs://b/a.txt"].imported_files_count == 1 and status["gs://b/gone.txt"].imported_files_count == 0
    assert status["gs://b/a.txt"].message == "File a.txt imported to RAG corpus successfully"
    assert sorted(r.problem for r in spark.read.parquet(f"{out}/quarantine").collect()) == sorted(["missing bucket", "no data", "not JSON", "not base64"])
    chunk = spark.read.parquet(f"{out}/chunks").first()
    assert (chunk.text, chunk.corpus, len(chunk.embedding)) == ("one two three", "corpus", 8)


def test_later_events_continue_from_the_offsets(spark, run):
    out = scratch_path(spark, "import")
    run([GOOD], out)
    run([GOOD, GOOD], out, "2.json")  # a redelivered event is imported again
    assert spark.read.parquet(f"{out}/status").count() == 3
    assert spark.read.parquet(f"{out}/chunks").count() == 2


def test_repeated_events_can_be_dropped(spark, run):
    out = scratch_path(spark, "import")
    run([GOOD, GOOD, OTHER], out, dedup_within="1 hour")
    assert spark.read.parquet(f"{out}/status").count() == 2


def test_malformed_event_can_stop_the_stream(spark, run):
    with pytest.raises(Exception, match="malformed"):
        run([GOOD, BAD[2]], scratch_path(spark, "import"), on_malformed="fail")


def test_object_loader_reads_inside_tasks(fixed):
    docs = object_loader(lambda uri: f"text of {uri}")(fixed("file_uri string", ("gs://b/a",), ("gs://b/c",)))
    assert {tuple(r) for r in docs.collect()} == {("gs://b/a", "text of gs://b/a"), ("gs://b/c", "text of gs://b/c")}


def test_index_follows_new_documents(spark, fixed, tmp_path):
    from tidemark.functions.embed import embed_text
    embedder = hashed_embedder(8)
    start = embed_text(fixed("doc_id bigint, chunk_id int, text string", *[(i, 0, f"w{i} x{i % 3}") for i in range(40)]), "text", embedder)
    index = build_index(start.select("doc_id", "chunk_id", "embedding"), scratch_path(spark, "index"), leaf_size=10)
    landing = str(tmp_path / "docs")
    fixed("doc_id bigint, text string", (100, "new words"), (101, "more new words")).write.json(landing)
    docs = spark.readStream.schema("doc_id bigint, text string").json(landing)
    start_index_updates(docs, index, scratch_path(spark, "offsets"), embedder).awaitTermination()
    stored = read_leaves(spark, index)
    assert stored.count() == 42 and {r.doc_id for r in stored.filter("batch_id = 0").collect()} == {100, 101}
