"""The pipeline against a plain Python version, and the registered queries against their SQL."""

import duckdb
import pyarrow as pa
import pytest

import __spark_entry__ as contract
import corpus_pipeline
from tests.llm.data import prose
from tests.llm.test_dedup import brute_components, brute_print, words_of
from tidemark.llm import queries, toxicity

DIR = "/root/testdata/sf0.001"


def test_pipeline_matches_brute_force(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    labels = spark.read.parquet(f"{DIR}/labels.parquet")
    toxic = {r.doc_id for r in toxicity.classify(docs, labels).filter("toxic").collect()}
    rows = {r.doc_id: r.text for r in docs.collect() if r.doc_id not in toxic}
    best = {}
    for d, t in rows.items():
        key = "".join(t.split())
        if key not in best or (-len(t), d) < (-len(rows[best[key]]), best[key]):
            best[key] = d
    rows = {d: rows[d] for d in best.values()}
    names = brute_components({d: brute_print(t) for d, t in rows.items()}, 2)
    rows = {d: t for d, t in rows.items() if names[d] == d}
    windows = set()
    for r in spark.read.parquet(f"{DIR}/benchmark.parquet").collect():
        w = words_of(r.text)
        windows |= {tuple(w[i:i + 10]) for i in range(len(w) - 9)} if len(w) >= 10 else {tuple(w)} - {()}
    clean = {d for d, t in rows.items() if not any(
        tuple(w[i:i + n]) in windows for w in [words_of(t)] for n in {len(x) for x in windows} for i in range(len(w) - n + 1))}
    got = corpus_pipeline.run(spark, DIR).collect()
    assert {r.doc_id for r in got} == clean and len(got) == len(clean)


def test_stages_return_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(0), DIR).columns == list(corpus_pipeline.COLUMNS)


def odd_rows(spark, texts):
    """Rows with null and repeated ids, and columns whose names the stages use inside."""
    rows = [(i, t, "en", None, 1, 7, "x") for i, t in texts]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, row_number bigint, component_id string")


def test_decontamination_judges_each_row_by_its_own_text(spark):
    leak = spark.read.parquet(f"{DIR}/benchmark.parquet").orderBy("item_id").first().text
    texts = [(None, leak), (None, "clean one"), (None, None), (5, leak), (5, "clean two"), (5, ""), (6, "x " + leak)]
    got = corpus_pipeline.drop_contaminated(spark, odd_rows(spark, texts), DIR)
    assert got.columns == list(corpus_pipeline.COLUMNS)
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=repr) == sorted(
        [(None, "clean one"), (None, None), (5, "clean two"), (5, "")], key=repr)


def test_one_row_of_each_near_group_stays(spark):
    long = prose(8, 80)
    texts = [(None, long), (None, long), (5, long), (5, prose(9, 90)), (None, prose(10, 90)), (7, None), (8, " "), (5, long)]
    got = corpus_pipeline.drop_near_copies(spark, odd_rows(spark, texts), DIR).collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=repr) == sorted(
        [(5, long), (5, prose(9, 90)), (None, prose(10, 90)), (7, None)], key=repr)


def test_exact_copies_and_toxic_rows_with_odd_ids(spark):
    texts = [(None, "a b"), (None, "a  b"), (5, "ab"), (5, "c"), (None, "c"), (6, None), (7, " ")]
    got = corpus_pipeline.drop_exact_copies(spark, odd_rows(spark, texts), DIR).collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=repr) == sorted([(None, "a  b"), (5, "c"), (7, " ")], key=repr)
    docs, labels = (spark.read.parquet(f"{DIR}/{t}.parquet") for t in ("documents", "labels"))
    toxic = toxicity.classify(docs, labels).filter("toxic").select("doc_id")
    bad = docs.join(toxic, "doc_id").first().text
    mixed = docs.select("doc_id", "text", "lang", "source", "n_chars").unionByName(
        odd_rows(spark, [(None, bad), (None, None), (-1, bad), (-1, "")]).select(*corpus_pipeline.COLUMNS))
    got = corpus_pipeline.drop_toxic(spark, mixed, DIR).filter("doc_id is null or doc_id = -1").collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=repr) == [(-1, ""), (None, None)]


def test_encoding_keeps_rows_with_odd_ids(spark):
    got = corpus_pipeline.encode_bytes(spark, odd_rows(spark, [(None, "a"), (5, "b c d"), (5, None)]), DIR).collect()
    assert sorted(((r.doc_id, r.n_tokens > 0) for r in got), key=repr) == [(5, False), (5, True), (None, True)]


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_matches_its_sql(spark, name):
    from tools.check_queries import rows_of
    db = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        db.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    df, want = contract.queries()[name](spark, DIR), db.sql(contract.oracle_sql()[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(want.columns, want.fetchall())


def test_all_operators_are_registered():
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{k}" for k in range(1, 14)} and "pipeline" in contract.queries()


@pytest.mark.parametrize("before, after", [("10000", 1000), ("0", 1000), ("300", 300)])
def test_a_stage_hands_few_rows_at_once_to_python(spark, before, after):
    name, default = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000"
    spark.conf.set(name, before)
    try:
        corpus_pipeline.encode_bytes(spark, spark.createDataFrame([(1, "a")], "doc_id bigint, text string"), "")
        sizes = spark.range(0, 5000, 1, 1).mapInArrow(lambda batches: (pa.record_batch({"id": [b.num_rows]}) for b in batches), "id bigint")
        assert max(r.id for r in sizes.collect()) == after
    finally:
        spark.conf.set(name, default)
