import pytest
from pyspark.sql import functions as F

from tidemark.functions import prompts
from tidemark.functions.embed import hashed_embedder
from tidemark.operators import corpus
from tidemark.session import scratch_path
from tidemark.sources.readers import read_text_files


def words(n):
    return " ".join(f"w{i}" for i in range(n))


@pytest.mark.parametrize("size,overlap,counts", [
    (512, 100, {0: 0, 1: 1, 512: 1, 513: 2, 924: 2, 925: 3}), (1024, 256, {0: 0, 1024: 1, 1025: 2, 1792: 2, 1793: 3})])
def test_chunk_counts(fixed, size, overlap, counts):
    df = fixed("n int, text string", *[(n, words(n)) for n in counts])
    got = {r.n: r["count"] for r in corpus.chunk_documents(df, size=size, overlap=overlap).groupBy("n").count().collect()}
    assert got == {n: c for n, c in counts.items() if c}


def test_chunks_rejoin_to_all_tokens(fixed):
    text = "  " + words(37).replace("w5 ", "w5\n\t ") + "\n"
    rows = corpus.chunk_documents(fixed("doc int, text string", (1, text)), size=10, overlap=3).orderBy("chunk_id").collect()
    tokens = []
    for r in rows:
        part = r.text.split(" ")
        assert len(part) == r.n_tokens and tokens[r.start_token:] == part[:len(tokens) - r.start_token]
        tokens[r.start_token:] = part
    assert tokens == text.split()


def test_chunk_settings_are_checked(fixed):
    with pytest.raises(ValueError):
        corpus.chunk_documents(fixed("text string", ("a",)), size=5, overlap=5)


def test_blank_and_null_documents_have_no_chunks(fixed):
    assert corpus.chunk_documents(fixed("text string", (" \n",), ("",), (None,))).count() == 0


def test_import_of_a_text_folder_counts_files_and_replaces_itself(spark, tmp_path):
    (tmp_path / "in" / "sub").mkdir(parents=True)
    (tmp_path / "in" / "a.txt").write_text("Title\n\n- Rose: a red flower.\n", encoding="utf-8")
    (tmp_path / "in" / "sub" / "b.txt").write_text("Lys: é", encoding="utf-8")
    docs = read_text_files(spark, str(tmp_path / "in"))
    out = scratch_path(spark, "import")
    for _ in range(2):
        counted = corpus.import_documents(docs, "plants", out, hashed_embedder(8), batch_id=3)
    assert counted.first().imported_files_count == 2
    stored = spark.read.parquet(out)
    assert stored.count() == 2 and {r.corpus for r in stored.collect()} == {"plants"}
    assert {r.file_uri.rsplit("/", 1)[1] for r in stored.collect()} == {"a.txt", "b.txt"}


def test_retrieve_keeps_the_threshold(fixed):
    from tidemark.functions.embed import embed_text
    embedder = hashed_embedder(256)
    docs = embed_text(fixed("chunk_key string, text string", ("a", "red rose garden"), ("b", "red rose"), ("c", "blue sea")),
                      "text", embedder)
    queries = fixed("query_id int, text string", (1, "Red rose"), (2, "mountain"))
    got = corpus.retrieve(queries, docs, embedder=embedder).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.chunk_key) for r in got] == [(1, "b"), (1, "a")]
    assert got[0].distance == pytest.approx(0.0, abs=1e-6)


def test_query_guard(fixed):
    got = corpus.guard_queries(fixed("text string", ("q",), (" \n",), ("",), (None,))).collect()
    assert [(r.accepted, r.status) for r in got] == [(True, None)] + [(False, prompts.BLANK_QUERY_STATUS)] * 3


def test_generation_requests(fixed):
    queries = fixed("query_id int, text string", (1, "q1"), (2, "q2"))
    contexts = fixed("query_id int, rank int, text string", (1, 2, "second"), (1, 1, "first"))
    got = {r.query_id: r for r in corpus.generation_requests(queries, contexts).collect()}
    assert got[1].contexts == ["first", "second"] and got[2].contexts == []
    assert got[1].generation_config == {"max_output_tokens": 8192.0, "temperature": 1.0, "top_p": 0.95, "seed": 0.0}
    assert set(got[1].safety_settings) == set(prompts.SAFETY_CATEGORIES)
    bare = corpus.generation_requests(queries, instruction="Be short", settings=prompts.CHAT_GENERATION_SETTINGS).first()
    assert bare.system_instruction == "Be short" and bare.generation_config["temperature"] == 0.9


def test_rendering_leaves_slot_like_values_alone(fixed):
    df = fixed("a string, b string", ("{y}", "B"), (None, "B"))
    got = [r[0] for r in df.select(prompts.render("1 {x} 2 {y} {x}", x=F.col("a"), y=F.col("b"))).collect()]
    assert got == ["1 {y} 2 B {y}", "1  2 B "]
    full = df.select(prompts.render(prompts.FACT_CHECK_TEMPLATE, query=F.col("b"), retrieved_context=F.col("b"),
                                    generated_answer=F.col("b"))).first()[0]
    assert "{" not in full
