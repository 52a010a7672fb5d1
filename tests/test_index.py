"""The vector index: codes, balls, exact search within bounds, cut leaves and generations."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import residual_codes, vector_index, vector_search
from tidemark.operators.leaf_bounds import least_distances
from tidemark.operators.vector_index import (append_to_index, build_index, current_generation, leaf_table, read_leaves, recall, remove_old,
                                             search_by_codes, search_index, search_within)
from tidemark.session import scratch_path


def frame(spark, matrix, name="doc_id"):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(matrix)], f"{name} int, embedding array<float>")


def same(a, b):
    return {tuple(r) for r in a.select("query_id", "doc_id", "distance", "rank").collect()} == {
        tuple(r) for r in b.select("query_id", "doc_id", "distance", "rank").collect()}


@pytest.fixture(scope="module")
def clustered(spark):
    """Points around eight centers, a third of them copies of one; an index of them, and queries."""
    rng = np.random.default_rng(5)
    centers = rng.normal(size=(8, 10)) * 4
    points = centers[rng.integers(0, 8, 900)] + rng.normal(size=(900, 10)) * 0.3
    points[300:600] = points[0]
    docs = frame(spark, points).cache()
    queries = frame(spark, np.concatenate([points[::30] + 0.05, centers, [np.zeros(10)]]), "query_id").cache()
    return docs, queries, build_index(docs, scratch_path(spark, "index"), leaf_size=30)


@pytest.mark.parametrize("measure", vector_search.MEASURES)
def test_balls_bound_all_distances(measure):
    rng = np.random.default_rng(1)
    for trial in range(200):
        dims, n = rng.integers(1, 6), rng.integers(1, 30)
        x = (rng.normal(size=(n, dims)) * rng.uniform(0, 2, size=(n, 1))).astype(np.float32)
        x[0] *= trial % 5 > 0
        q = rng.normal(size=(4, dims)) * rng.uniform(0, 3)
        q[0] *= trial % 7 > 0
        center, length = x.mean(axis=0), np.linalg.norm(x.astype(float), axis=1)
        radius = np.linalg.norm(x.astype(float) - center, axis=1).max()
        bound = least_distances(q, center[None], *(np.array([v]) for v in (radius, length.min(), length.max())), measure)[:, 0]
        assert (bound <= vector_search._distances(q, x, measure).min(axis=1) + 1e-9).all()


def test_codes_are_a_sixteenth_and_products_come_from_tables():
    rng = np.random.default_rng(2)
    x, q = rng.normal(size=(3000, 30)).astype(np.float32), rng.normal(size=(5, 30)).astype(np.float32)
    parts = residual_codes.grouped(x)
    books = np.stack([residual_codes.train_book(parts[:, g], g) for g in range(parts.shape[1])])
    codes = residual_codes.encode(x, books)
    assert codes.nbytes * 16 == parts.nbytes
    shown = np.stack([books[g][codes[:, g]] for g in range(len(books))], axis=1).reshape(len(x), -1)[:, :30]
    assert np.allclose(residual_codes.products(residual_codes.look_up_tables(q, books), codes), q @ shown.T, atol=1e-4)
    assert ((x - shown) ** 2).mean() < 0.2 * (x ** 2).mean()
    few = residual_codes.train_book(np.ones((9, 4), np.float32), 0)
    assert few.shape == (256, 4) and (few == 1).all()


@pytest.mark.parametrize("measure", vector_search.MEASURES)
def test_search_within_is_exact_and_reads_few_leaves_of_clusters(spark, clustered, measure):
    docs, queries, index = clustered
    searched = search_within(queries, index, measure=measure)
    assert same(searched.found, vector_search.nearest(queries, docs, measure=measure))
    read = {r.query_id: r.read / r.of for r in searched.leaves.collect()}
    assert len(read) == queries.count() and all(0 < s <= 1 for s in read.values())
    if measure == "euclidean":
        assert np.median(list(read.values())) < 0.5
    narrow = search_within(queries, index, measure=measure, threshold=0.2)
    assert same(narrow.found, vector_search.nearest(queries, docs, measure=measure, threshold=0.2))


def test_a_large_query_side_is_not_broadcast(spark, clustered):
    docs, queries, index = clustered
    want = vector_search.nearest(queries, docs, measure="euclidean")
    assert same(search_within(queries, index, measure="euclidean", broadcast_limit=100).found, want)
    assert recall(search_by_codes(queries, index, measure="euclidean", broadcast_limit=100).found, want) >= 0.9


@pytest.mark.parametrize("measure", ["dot", "euclidean"])
def test_codes_find_nine_tenths_and_few_rows_are_compared(spark, measure):
    rng = np.random.default_rng(9)
    points = rng.normal(size=(2000, 24))
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    docs, stored = frame(spark, points), frame(spark, points[::50], "query_id")
    index = build_index(docs, scratch_path(spark, "index"), leaf_size=100)
    means = frame(spark, [points[i::40].mean(axis=0) for i in range(40)], "query_id")
    for queries in (stored, means) if measure == "dot" else (stored,):
        searched = search_by_codes(queries, index, measure=measure)
        assert recall(searched.found, vector_search.nearest(queries, docs, measure=measure)) >= 0.9
        assert searched.exact.agg(F.max("rows")).first()[0] <= 0.2 * 2000
    codes = read_leaves(spark, index).agg(F.sum(F.octet_length("code"))).first()[0]
    assert codes * 16 == 2000 * 24 * 4


def test_streamed_rows_leave_no_leaf_overfull(spark, clustered):
    docs, queries, _ = clustered
    index = build_index(docs.filter("doc_id % 10 = 0"), scratch_path(spark, "index"), leaf_size=30)
    for batch in range(3):
        append_to_index(docs.filter(f"doc_id % 10 > 0 and doc_id % 3 = {batch}"), index, batch)
        assert leaf_table(spark, index).agg(F.max("rows")).first()[0] <= 60
    assert sorted(r.doc_id for r in read_leaves(spark, index).select("doc_id").collect()) == list(range(900))
    held = read_leaves(spark, index).groupBy(*vector_index.UNIT).count().agg(F.max("count")).first()[0]
    assert held <= 60
    for measure in ("dot", "euclidean"):
        assert same(search_within(queries, index, measure=measure).found, vector_search.nearest(queries, docs, measure=measure))


def test_a_reader_stays_on_its_generation(spark, clustered):
    docs, queries, _ = clustered
    index = build_index(docs.filter("doc_id < 100"), scratch_path(spark, "index"), leaf_size=500)
    before = current_generation(spark, index)
    append_to_index(docs.filter("doc_id >= 100"), index, 0)
    append_to_index(docs.filter("doc_id >= 100"), index, 0)
    assert read_leaves(spark, index, before).count() == 100 and read_leaves(spark, index).count() == 900
    vector_index.append_to_index(docs.limit(0), index, 1)
    assert read_leaves(spark, index).count() == 900
    spark.createDataFrame([(20,)], "leaf_size int").crossJoin(spark.read.parquet(index.facts_path).drop("leaf_size")).write.parquet(f"{index.path}/new")
    spark.read.parquet(f"{index.path}/new").write.mode("overwrite").parquet(index.facts_path)
    assert vector_index.cut_overfull(spark, index) > 0 and vector_index.cut_overfull(spark, index) == 0
    assert read_leaves(spark, index, before).count() == 100
    assert remove_old(spark, index) and read_leaves(spark, index).count() == 900
    assert same(search_within(queries, index).found, vector_search.nearest(queries, docs))


def test_a_cut_is_made_again_after_another_commit(spark, clustered, monkeypatch):
    docs, _, _ = clustered
    index = build_index(docs.filter("doc_id < 40"), scratch_path(spark, "index"), leaf_size=500)
    monkeypatch.setattr(vector_index, "OVERFULL", 0.01)
    original, calls = vector_index._replace_cells, []

    def overtaken(log, seen, folder, cells):
        if not calls:
            calls.append(1)
            rows = vector_index.assign_leaves(docs.filter("doc_id = 800"), index, "embedding")
            vector_index.write_leaves(rows, index, 77)
        return original(log, seen, folder, cells)

    monkeypatch.setattr(vector_index, "_replace_cells", overtaken)
    assert vector_index.cut_overfull(spark, index) > 0
    assert sorted(r.doc_id for r in read_leaves(spark, index).collect()) == [*range(40), 800]


def test_index_search_rejects_bad_arguments(clustered):
    _, queries, index = clustered
    for arguments in ({"k": 0}, {"measure": "manhattan"}, {"k": 200}):
        with pytest.raises(ValueError):
            search_index(queries, index, **arguments)


def test_candidates_leave_a_task_in_bounded_batches():
    """A task's batch holds hundreds of block pairs, each with many candidates: they must not pile up."""
    import pyarrow as pa
    from pyspark.sql.types import ArrayType, LongType, StructType

    from tidemark.operators import residual_codes, vector_index

    class Pairs:
        schema = StructType().add("q_ids", ArrayType(LongType())).add("c_ids", ArrayType(LongType()))

        def select(self, *_):
            return self

        def mapInArrow(self, run, _):
            return run

    rng = np.random.default_rng(1)
    books = rng.normal(size=(2, residual_codes.ENTRIES, residual_codes.GROUP)).astype(np.float32)
    n, rows, pairs = 300, 90, 6
    q, codes = rng.normal(size=(n, 8)).astype(np.float32), rng.integers(0, 256, (pairs, rows, 2)).astype(np.uint8)
    ids = list(range(n))
    batch = pa.record_batch({
        "q_ids": pa.array([ids] * pairs), "q_vector": pa.array([q.tobytes()] * pairs), "q_shift": pa.array([np.zeros(n).tobytes()] * pairs),
        "q_own": pa.array([np.ones(n).tobytes()] * pairs), "c_coarse": pa.array(range(pairs), pa.int32()), "c_folder": pa.array(["f"] * pairs),
        "c_row_no": pa.array([list(range(rows))] * pairs), "c_ids": pa.array([list(range(rows))] * pairs),
        "c_code": pa.array([c.tobytes() for c in codes]), "c_length": pa.array([np.ones(rows).tobytes()] * pairs)})
    run = vector_index._code_candidates(Pairs(), books, 80, "dot", "query_id")
    out = list(run(iter([batch])))
    assert max(b.num_rows for b in out) <= 1 << 16 and sum(b.num_rows for b in out) == n * 80 * pairs
    table = pa.Table.from_batches(out).to_pylist()
    near = 1 - np.einsum("qgj,rgj->qr", q.reshape(n, 2, 4), np.stack([books[g][codes[3][:, g]] for g in range(2)], axis=1))
    best = sorted((r["near"], r["doc"]) for r in table if r["query_id"] == 7 and r["coarse"] == 3)
    assert np.allclose([b[0] for b in best], np.sort(near[7])[:80], atol=1e-5)


def test_rows_meet_all_centroids_in_one_pass(spark, clustered):
    docs, _, index = clustered
    rows = vector_index.assign_leaves(docs.unionByName(docs.limit(0)), index, "embedding")
    assert "Join" not in rows._jdf.queryExecution().executedPlan().toString()
    centers = [np.array([r.embedding for r in spark.read.parquet(path).sort("centroid").collect()]) for path in (index.coarse_path, index.fine_path)]
    books = residual_codes.read_books(spark, index.books_path)
    for row in rows.collect()[::30]:
        own = np.array(row.embedding)
        coarse = int(((own - centers[0]) ** 2).sum(axis=1).argmin())
        first = own - centers[0][coarse]
        fine = int(((first - centers[1]) ** 2).sum(axis=1).argmin())
        rest = first - centers[1][fine]
        assert (row.coarse, row.centroid, row.part) == (coarse, coarse * len(centers[1]) + fine, -1)
        assert np.allclose([row.length, row.off, row.off_cell], [np.linalg.norm(v) for v in (own, rest, first)], atol=1e-5)
        assert row.code == residual_codes.encode(rest[None].astype(np.float32), books).tobytes()
