import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions import vectors
from tidemark.functions.embed import embed_text, embedding_of_payload, hashed_embedder, token_cell
from tidemark.operators import vector_search
from tidemark.operators.evaluation import align_embeddings, pair_similarity
from tidemark.operators.vector_index import append_to_index, build_index, compact_index, leaf_centroids, read_leaves, recall, search_index
from tidemark.session import scratch_path

Q = vector_search.VectorColumns("query_id", "embedding")
D = vector_search.VectorColumns("doc_id", "embedding")


def brute(queries, docs, k, distance, threshold=None):
    out = set()
    for q, x in queries:
        ranked = sorted((round(distance(np.array(x), np.array(y)), 9), d) for d, y in docs)
        if threshold is not None:
            ranked = [r for r in ranked if r[0] < threshold]
        out |= {(q, d, rank) for rank, (_, d) in enumerate(ranked[:k], 1)}
    return out


@pytest.fixture(scope="module")
def points():
    rng = np.random.default_rng(3)
    rows = rng.normal(size=(300, 8))
    rows = (rows / np.linalg.norm(rows, axis=1, keepdims=True)).astype(np.float32)
    rows[100:200] = rows[0]  # a third of all rows are copies of one vector
    return [(i, [float(x) for x in r]) for i, r in enumerate(rows)]


DISTANCES = {
    "dot": lambda a, b: 1 - float(a @ b),
    "euclidean": lambda a, b: float(np.linalg.norm(a - b)),
    "cosine": lambda a, b: 1 - float(a @ b / (np.linalg.norm(a) * np.linalg.norm(b))),
}


@pytest.mark.parametrize("measure", list(DISTANCES))
@pytest.mark.parametrize("limit", [1 << 20, 2000])
def test_nearest_matches_brute_force(spark, points, measure, limit):
    queries = spark.createDataFrame(points[:60], "query_id int, embedding array<float>")
    docs = spark.createDataFrame(points, "doc_id int, embedding array<float>").repartition(5)
    got = vector_search.nearest(queries, docs, 4, measure, broadcast_limit=limit)
    want = brute(points[:60], points, 4, DISTANCES[measure])
    assert {(r.query_id, r.doc_id, r["rank"]) for r in got.collect()} == want


def test_nearest_with_threshold_and_text_ids(spark, points):
    named = [(f"id{i:03d}", v) for i, v in points]
    queries = spark.createDataFrame(named[:20], "query_id string, embedding array<float>")
    docs = spark.createDataFrame(named, "doc_id string, embedding array<float>")
    got = vector_search.nearest(queries, docs, 5, threshold=0.5)
    assert {(r.query_id, r.doc_id, r["rank"]) for r in got.collect()} == brute(named[:20], named, 5, DISTANCES["dot"], 0.5)


def test_nearest_leaves_out_unusable_vectors(fixed):
    queries = fixed("query_id int, embedding array<float>", (1, [1.0, 0.0]))
    docs = fixed("doc_id int, embedding array<float>", (1, [1.0, 0.0]), (2, []), (3, None), (4, [1.0]), (5, [0.0, 0.0]))
    assert [r.doc_id for r in vector_search.nearest(queries, docs).orderBy("rank").collect()] == [1, 5]


def test_double_vectors_keep_all_digits(fixed):
    docs = fixed("doc_id int, embedding array<double>", (1, [1.0 + 3e-8, 0.0]), (2, [1.0 + 1e-8, 0.0]), (3, [1.0, 0.0]))
    query = fixed("query_id int, embedding array<double>", (7, [1.0 + 3e-8, 0.0]))
    assert [r.doc_id for r in vector_search.nearest(query, docs, measure="euclidean").orderBy("rank").collect()] == [1, 2, 3]


def test_nearest_rejects_bad_arguments(fixed):
    df = fixed("query_id int, doc_id int, embedding array<float>", (1, 1, [1.0]))
    with pytest.raises(ValueError):
        vector_search.nearest(df, df, 0)
    with pytest.raises(ValueError):
        vector_search.nearest(df, df, 1, "manhattan")


def test_corpus_is_not_shuffled_for_a_small_query_side(spark, points):
    queries = spark.createDataFrame(points[:5], "query_id int, embedding array<float>")
    docs = spark.createDataFrame(points, "doc_id int, embedding array<float>")
    plan = vector_search.nearest(queries, docs)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert plan.count("Exchange hashpartitioning") == 1  # only the final ranking


def test_image_neighbours_deduplicate_and_need_a_path(fixed):
    docs = fixed("id string, embedding_field array<float>, path string",
                 ("1", [0.0, 0.0], "b.jpg"), ("1", [0.0, 0.0], "a.jpg"), ("2", [1.0, 0.0], None), ("3", [2.0, 0.0], "c.jpg"))
    queries = fixed("query_id int, embedding array<float>", (7, [0.0, 0.0]))
    got = vector_search.image_neighbours(queries, docs, 4).collect()
    assert {(r.id, r.path) for r in got} == {("1", "a.jpg"), ("3", "c.jpg")}
    kept = vector_search.image_neighbours(queries, docs, 4, require_path=False).collect()
    assert {r.id for r in kept} == {"1", "2", "3"}
    with pytest.raises(ValueError):
        vector_search.image_neighbours(queries, docs, 11)


def test_index_probing_all_leaves_is_exact_and_few_leaves_recall_most(spark, points):
    docs = spark.createDataFrame(points, "doc_id int, embedding array<float>")
    queries = spark.createDataFrame(points, "query_id int, embedding array<float>")
    index = build_index(docs, scratch_path(spark, "index"), leaf_size=30)
    exact = {tuple(r) for r in vector_search.nearest(queries, docs).select("query_id", "doc_id", "rank").collect()}
    full = search_index(queries, index, leaves_to_search=1.0)
    assert {tuple(r) for r in full.select("query_id", "doc_id", "rank").collect()} == exact
    routed = search_index(queries, index, leaves_to_search=1.0, broadcast_limit=1000)
    assert {tuple(r) for r in routed.select("query_id", "doc_id", "rank").collect()} == exact
    some = {(r.query_id, r.doc_id) for r in search_index(queries, index, leaves_to_search=0.4).collect()}
    recall = len(some & {(q, d) for q, d, _ in exact}) / len(exact)
    assert recall > 0.7


@pytest.mark.parametrize("measure", vector_search.MEASURES)
def test_index_finds_nine_tenths_at_its_own_settings(spark, measure):
    rng = np.random.default_rng(9)
    rows = [(i, [float(x) for x in v / np.linalg.norm(v) * rng.uniform(0.8, 1.2)]) for i, v in enumerate(rng.normal(size=(1200, 16)))]
    docs = spark.createDataFrame(rows, "doc_id int, embedding array<float>")
    index = build_index(docs, scratch_path(spark, "index"), leaf_size=60)
    stored = docs.filter("doc_id % 50 = 0").withColumnRenamed("doc_id", "query_id")
    means = spark.createDataFrame([(i, [float(x) for x in np.mean([v for _, v in rows[i::40]], axis=0)]) for i in range(40)], stored.schema)
    # Only stored vectors are asked for euclidean: a mean is nearly as far from all of them, and its length counts.
    for queries in (stored,) if measure == "euclidean" else (stored, means):
        assert recall(search_index(queries, index, measure=measure), vector_search.nearest(queries, docs, measure=measure)) >= 0.9
    few = search_index(stored, index, measure=measure, leaves_to_search=0.07)
    assert recall(few, vector_search.nearest(stored, docs, measure=measure)) < 0.9


def test_index_append_is_repeatable(spark, points):
    docs = spark.createDataFrame(points, "doc_id int, embedding array<float>")
    index = build_index(docs.filter("doc_id < 250"), scratch_path(spark, "index"), leaf_size=50)
    for _ in range(2):  # the second run is a replay of the same batch
        append_to_index(docs.filter("doc_id >= 250"), index, batch_id=4)
    assert sorted(r.doc_id for r in read_leaves(spark, index).select("doc_id").collect()) == list(range(300))
    merged = compact_index(spark, index, scratch_path(spark, "index"))
    assert {r.batch_id for r in read_leaves(spark, merged).select("batch_id").distinct().collect()} == {-1}
    queries = docs.withColumnRenamed("doc_id", "query_id")
    assert set(search_index(queries, merged).collect()) == set(search_index(queries, index).collect())


def test_copies_do_not_use_up_the_leaves(spark):
    rows = [(i, [1.0, 0.0] if i % 3 else [float(i % 7), float(i % 11)]) for i in range(400)]
    index = build_index(spark.createDataFrame(rows, "doc_id int, embedding array<float>"), scratch_path(spark, "index"), leaf_size=20)
    assert 10 <= leaf_centroids(spark, index).count() <= 25


def test_ragged_vectors_meet_their_own_length_and_are_told(spark, fixed):
    docs = fixed("doc_id int, embedding array<float>", *[(i, [float(i), 1.0]) for i in range(9)], (20, [1.0, 2.0, 3.0]), (21, []), (22, None))
    queries = fixed("query_id int, embedding array<float>", (1, [1.0, 0.0, 0.0]), (2, [0.0, 1.0]))
    for limit in (1 << 20, 1):
        got = {(r.query_id, r.doc_id) for r in vector_search.nearest(queries, docs, 2, "euclidean", broadcast_limit=limit).collect()}
        assert got == {(1, 20), (2, 0), (2, 1)}
    told = {r.id: r.reason for r in vector_search.unusable_vectors(docs, D, 2).collect()}
    assert told == {20: "3 numbers instead of 2", 21: "empty vector", 22: "no vector"}
    index = build_index(docs, scratch_path(spark, "index"), leaf_size=3)
    assert sorted(r.doc_id for r in read_leaves(spark, index).collect()) == list(range(9))


def test_index_does_not_need_arrow_conversion(spark, points):
    spark.conf.set("spark.sql.execution.arrow.pyspark.enabled", "false")
    try:
        index = build_index(spark.createDataFrame(points, "doc_id int, embedding array<float>"), scratch_path(spark, "index"), leaf_size=50)
        assert search_index(spark.createDataFrame(points[:3], "query_id int, embedding array<float>"), index).count() == 15
    finally:
        spark.conf.set("spark.sql.execution.arrow.pyspark.enabled", "true")


def test_similarity_functions(fixed):
    df = fixed("a array<double>, b array<double>", ([1.0, 2.0], [2.0, 4.0]), ([1.0, 0.0], [0.0, 1.0]), ([0.0, 0.0], [1.0, 1.0]),
               ([], [1.0]), (None, [1.0]), ([1.0, 2.0], [-1.0, -2.0]))
    got = [r[0] for r in df.select(vectors.cosine(F.col("a"), F.col("b"))).collect()]
    assert got == pytest.approx([1.0, 0.0, 0.0, -2.0, -2.0, -1.0])
    back = [r[0] for r in df.select(vectors.cosine(F.col("b"), F.col("a"))).collect()]
    assert back == pytest.approx(got)
    row = df.select(vectors.dot(F.col("a"), F.col("b")), vectors.euclidean(F.col("a"), F.col("b"))).first()
    assert tuple(row) == pytest.approx((10.0, math.sqrt(5)))
    assert df.select(vectors.unit(F.col("b"))).first()[0] == pytest.approx([1 / math.sqrt(5), 2 / math.sqrt(5)])


def test_pair_similarity_of_named_sentences(fixed):
    keys = fixed("pos int, key string", (0, "en"), (1, "zh"), (2, "void"))
    values = fixed("pos int, embedding array<double>", (0, [1.0, 1.0]), (1, [1.0, 0.0]), (2, []))
    pairs = fixed("left_key string, right_key string, label string", ("en", "zh", "same"), ("en", "en", "identical"),
                  ("en", "void", "empty"), ("en", "gone", "missing"))
    got = {r.label: r.similarity for r in pair_similarity(align_embeddings(keys, values), pairs).collect()}
    assert got == pytest.approx({"same": 1 / math.sqrt(2), "identical": 1.0, "empty": -2.0, "missing": -2.0})


def test_hashed_embedding(spark, fixed):
    df = fixed("text string", ("Alpha beta  alpha\n",), ("",), (None,), ("gamma",))
    rows = [r.embedding for r in embed_text(df, "text", hashed_embedder(32)).collect()]
    want = np.zeros(32)
    for token in ("alpha", "beta", "alpha"):
        code = token_cell(token, 32)
        want[code // 2] += 1 - 2 * (code % 2)
    assert rows[0] == pytest.approx(want / np.linalg.norm(want), abs=1e-6)
    assert not any(rows[1]) and not any(rows[2])
    assert np.linalg.norm(rows[3]) == pytest.approx(1.0)


def test_embedding_runs_once_per_row(spark, fixed):
    df = embed_text(fixed("text string", ("a b",)), "text", hashed_embedder(4))
    shown = df.filter(F.size("embedding") == 4).select(F.posexplode("embedding"))
    assert shown._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1


def test_embedding_payload_shapes(fixed):
    df = fixed("embeddings struct<values:array<double>>, values array<double>", (([1.0],), None), (None, [2.0]), (None, None))
    got = [(r.embedding, r.error) for r in embedding_of_payload(df).collect()]
    assert got == [([1.0], None), ([2.0], None), (None, "Unknown embedding response format")]


def test_embedder_works_on_bounded_parts_and_odd_texts(spark, monkeypatch):
    import pyarrow as pa
    from tidemark.functions import embed

    texts = ["", "a  b\ta", "\x0bé  x\n", "long " * 400, None, "z", "  y\x1fy"]
    monkeypatch.setattr(embed, "_BYTES_AT_ONCE", 30)
    parts = list(embed._parts(pa.array([t or "" for t in texts])))
    assert sum(map(len, parts)) == len(texts) and all(len(p) == 1 or sum(len(t.as_py().encode()) for t in p) <= 30 for p in parts)
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = {r.i: r.e for r in rows.repartition(2).select("i", hashed_embedder(16)(F.col("t")).alias("e")).collect()}
    for i, text in enumerate(texts):
        want = np.zeros(16)
        for token in (t for t in __import__("re").split(r"[ \t\n\r\f\x0b]+", (text or "").lower()) if t):
            code = token_cell(token, 16)
            want[code // 2] += -1 if code % 2 else 1
        want = (want / (np.linalg.norm(want) or 1)).astype(np.float32)
        assert np.allclose(got[i], want, atol=1e-7)
