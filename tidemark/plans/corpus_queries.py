"""Queries over documents, chunks and embeddings."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import prompts
from tidemark.functions.embed import embed_text, embedding_of_payload, hashed_embedder
from tidemark.functions.uris import uri_bucket, uri_object, uri_valid
from tidemark.operators import corpus
from tidemark.operators.evaluation import align_embeddings, pair_similarity
from tidemark.operators.vector_index import (FIRST_RANKED, LEAST_RECALL, MOST_EXACT, OVERFULL, TOP_K, build_index, leaf_table, recall, search_by_codes,
                                             search_within)
from tidemark.operators.vector_search import image_neighbours, nearest
from tidemark.plans.tables import documents_as_files, image_collection, table
from tidemark.session import checkpointed, scratch_path
from tidemark.streaming.updates import start_vector_updates

DIMS = 768
#: Leaf size of the index that vectors are streamed into: small, so that leaves get overfull.
APPEND_LEAF = 50
NARROW_THRESHOLD, WIDE_THRESHOLD = 0.95, 0.97

_WORDS = "list_filter(regexp_split_to_array({text}, '[ \\t\\n\\r\\f\\x0b]+'), lambda x: x <> '')"
_CHUNKS = f"""
    words AS (SELECT doc_id, {_WORDS.format(text='text')} AS w FROM documents),
    counted AS (SELECT doc_id, w, CASE WHEN len(w) = 0 THEN 0 ELSE greatest(1, ceil((len(w) - 100) / 412.0))::int END AS n FROM words),
    chunk AS (SELECT doc_id, i::int AS chunk_id, (i * 412)::int AS start_token, w[i * 412 + 1:i * 412 + 512] AS part
              FROM (SELECT doc_id, w, unnest(range(n)) AS i FROM counted))"""


def _embedding_sql(source: str, key: str, text: str, dims: int) -> str:
    """Token cells, their signed sums and the norm, per key."""
    return f"""
    tok_{source} AS (SELECT {key} AS key, md5(unnest({_WORDS.format(text=f'lower({text})')})) AS h FROM {source}),
    cell_{source} AS (SELECT key, ('0x' || substr(h, 1, 8))::ubigint % {dims} AS dim,
                      sum(CASE WHEN substr(h, 9, 1) < '8' THEN 1 ELSE -1 END)::double AS v FROM tok_{source} GROUP BY ALL),
    norm_{source} AS (SELECT key, sqrt(sum(v * v)) AS norm FROM cell_{source} GROUP BY key),
    full_{source} AS (SELECT k.key, d.dim, coalesce(CASE WHEN norm > 0 THEN c.v / norm END, 0)::float AS v
                      FROM (SELECT DISTINCT {key} AS key FROM {source}) k CROSS JOIN (SELECT unnest(range({dims})) AS dim) d
                      LEFT JOIN cell_{source} c ON c.key = k.key AND c.dim = d.dim LEFT JOIN norm_{source} n ON n.key = k.key),
    vec_{source} AS (SELECT key, list(v ORDER BY dim)::double[] AS e FROM full_{source} GROUP BY key)"""


def chunk_documents(spark, sf_dir):
    return _chunks(spark, sf_dir)


def embed_documents(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    embedded = embed_text(docs, "text", hashed_embedder(DIMS)).select("doc_id", "embedding")
    return embedded.select("doc_id", F.posexplode("embedding").alias("dim", "v")).select(
        "doc_id", "dim", F.round(F.col("v").cast("double"), 6).alias("value"))


def corpus_import(spark, sf_dir):
    """Import per source as a file group, then count what the stored table holds."""
    out = scratch_path(spark, "corpus")
    docs = documents_as_files(spark, sf_dir).select("source", "file_uri", "text")
    corpus.import_documents(docs, "check", out, hashed_embedder(DIMS))
    return spark.read.parquet(out).groupBy("source").agg(
        F.countDistinct("file_uri").alias("imported_files_count"), F.count(F.lit(1)).alias("chunks"),
        F.sum("n_tokens").alias("tokens"))


def _label_means(vectors, label, vector):
    """The mean vector of each label: a few queries that every row has a part in."""
    each = vectors.select(F.col(label).alias("query_id"), F.posexplode(vector).alias("dim", "x"))
    means = each.groupBy("query_id", "dim").agg(F.avg(F.col("x").cast("double")).alias("x"))
    listed = means.groupBy("query_id").agg(F.sort_array(F.collect_list(F.struct("dim", "x"))).alias("rows"))
    return listed.select("query_id", F.col("rows.x").alias("embedding"))


def _sides(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return _label_means(vectors, "label", "embedding"), vectors.select(F.col("vec_id").alias("doc_id"), "embedding")


def _shown(found):
    return found.withColumn("distance", F.round("distance", 6))


def vector_topk(spark, sf_dir):
    return _shown(nearest(*_sides(spark, sf_dir)))


def vector_topk_threshold(spark, sf_dir):
    queries, docs = _sides(spark, sf_dir)
    runs = [nearest(queries, docs, threshold=t).withColumn("threshold", F.lit(t))
            for t in (NARROW_THRESHOLD, WIDE_THRESHOLD)]
    return _shown(runs[0].unionByName(runs[1]))


def image_neighbors(spark, sf_dir):
    docs = image_collection(spark, sf_dir)
    found = image_neighbours(_label_means(table(spark, sf_dir, "embeddings"), "label", "embedding"), docs)
    return _shown(found).select("query_id", "id", "rank", "distance", "path")


def ann_topk(spark, sf_dir):
    """Index search per label mean: how many rows it found, whether their distances are the vectors' own, and whether it keeps what
    it promises: with the same settings it finds LEAST_RECALL of the exact neighbours, of the means and of the vectors whose id
    is divisible by 50, and compares few rows by their vectors (at most MOST_EXACT of all, but four for each row asked for, and as
    many again for a first bound)."""
    queries, docs = _sides(spark, sf_dir)
    queries = checkpointed(queries)
    index = build_index(docs, scratch_path(spark, "index"))
    searched = search_by_codes(queries, index)
    found = checkpointed(searched.found)
    asked = checkpointed(docs.filter("doc_id % 50 = 0").select(F.col("doc_id").alias("query_id"), "embedding"))
    again = search_by_codes(asked, index)
    enough = recall(again.found, nearest(asked, docs)) >= LEAST_RECALL and recall(found, nearest(queries, docs)) >= LEAST_RECALL
    most = FIRST_RANKED * TOP_K + max(FIRST_RANKED * TOP_K, MOST_EXACT * docs.count())
    few = searched.exact.unionByName(again.exact).agg(F.max("rows")).first()[0] <= most
    with_vectors = found.join(docs, "doc_id").join(queries.withColumnRenamed("embedding", "asked"), "query_id")
    own = F.aggregate(F.zip_with("embedding", "asked", lambda x, y: x.cast("double") * y), F.lit(0.0), lambda a, x: a + x)
    checked = with_vectors.withColumn("holds", F.abs(1 - own - F.col("distance")) < 1e-6)
    return checked.groupBy("query_id").agg(F.count("*").alias("found"), F.bool_and("holds").alias("distances_hold")).withColumns(
        {"recall_holds": F.lit(enough), "few_compared": F.lit(few)})


def index_append(spark, sf_dir):
    """Build on the labelled classes below 5, stream in all other vectors, then search within bounds: the rows of an exact search,
    whether no leaf is larger than it may be, and whether every query was told how many leaves it read."""
    vectors = table(spark, sf_dir, "embeddings")
    queries, docs = _sides(spark, sf_dir)
    index = build_index(vectors.filter("label < 5").select(F.col("vec_id").alias("doc_id"), "embedding"), scratch_path(spark, "index"), leaf_size=APPEND_LEAF)
    landing = scratch_path(spark, "vectors")
    vectors.filter("label >= 5").select(F.col("vec_id").alias("doc_id"), "embedding").write.parquet(landing)
    arriving = spark.readStream.schema("doc_id bigint, embedding array<float>").parquet(landing)
    start_vector_updates(arriving, index, scratch_path(spark, "offsets")).awaitTermination()
    searched = search_within(queries, index)
    small = leaf_table(spark, index).agg(F.max("rows")).first()[0] <= OVERFULL * APPEND_LEAF
    told = searched.leaves.select("query_id", F.col("read").between(1, F.col("of")).alias("leaves_told"))
    return _shown(searched.found).join(told, "query_id").withColumn("leaves_small", F.lit(small))


def _chunk_key():
    return F.concat_ws(":", F.col("doc_id").cast("string"), F.col("chunk_id").cast("string")).alias("chunk_key")


def _chunks(spark, sf_dir):
    return corpus.chunk_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))


def _benchmark_queries(spark, sf_dir):
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")


def _retrieved(spark, sf_dir):
    """The best chunks per benchmark text, from all documents."""
    embedder = hashed_embedder(DIMS)
    stored = embed_text(_chunks(spark, sf_dir), "text", embedder).select(_chunk_key(), "embedding")
    return corpus.retrieve(_benchmark_queries(spark, sf_dir), stored, embedder=embedder)


def _ranked_chunks(found):
    return found.select(
        "query_id", F.col("rank").cast("bigint").alias("rank"), F.split_part("chunk_key", F.lit(":"), F.lit(1)).cast("bigint").alias("doc_id"),
        F.split_part("chunk_key", F.lit(":"), F.lit(2)).cast("bigint").alias("chunk_id"), F.round("distance", 6).alias("distance"))


def retrieve(spark, sf_dir):
    return _ranked_chunks(_retrieved(spark, sf_dir))


def retrieve_indexed(spark, sf_dir):
    """As ``retrieve``, through an index of all chunks, with the share of its leaves that the queries read."""
    embedder = hashed_embedder(DIMS)
    stored = checkpointed(embed_text(_chunks(spark, sf_dir), "text", embedder).select(_chunk_key(), "embedding"))
    index = build_index(stored, scratch_path(spark, "chunk-index"))
    searched = corpus.retrieve_within(_benchmark_queries(spark, sf_dir), index, embedder=embedder)
    told = searched.leaves.select("query_id", (F.col("read") / F.col("of")).between(0, 1).alias("share_told"))
    return _ranked_chunks(searched.found).join(told, "query_id")


def retrieved_contexts(spark, sf_dir):
    """(query_id, rank, text): the retrieved chunks' texts, joined back on their keys."""
    texts = _chunks(spark, sf_dir).select(_chunk_key(), "text")
    return _retrieved(spark, sf_dir).join(texts, "chunk_key").select("query_id", "rank", "text")


def _turn_queries(spark, sf_dir):
    """Conversation turns as queries; a system turn stands for a blank query."""
    return table(spark, sf_dir, "conversations").select(
        F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("query_id"),
        F.when(F.col("role") == "system", F.lit(" \n\t")).otherwise(F.col("text")).alias("text"))


def query_guard(spark, sf_dir):
    return corpus.guard_queries(_turn_queries(spark, sf_dir)).select("query_id", "accepted", "status")


def generation_requests(spark, sf_dir):
    """Every benchmark text as a query with the chunks retrieved for it as contexts."""
    made = corpus.generation_requests(_benchmark_queries(spark, sf_dir), retrieved_contexts(spark, sf_dir))
    return made.select("query_id", "system_instruction", "query_text", F.array_join("contexts", "\n").alias("contexts"),
                       F.col("generation_config")["temperature"].alias("temperature"),
                       F.col("generation_config")["max_output_tokens"].alias("max_output_tokens"),
                       F.size("safety_settings").cast("bigint").alias("safety_rules"))


def prompt_render(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    return turns.select("conv_id", "turn", prompts.render(
        prompts.RELEVANCE_TEMPLATE, prompt=F.col("role"), response=F.col("text")).alias("rendered"))


def pair_similarities(spark, sf_dir):
    """Each vector with the first of its label; label 9 pairs with a key that has no vector."""
    vectors = table(spark, sf_dir, "embeddings")
    first = vectors.groupBy("label").agg(F.min("vec_id").alias("right_key"))
    pairs = vectors.select("label", F.col("vec_id").alias("left_key")).join(first, "label").select(
        "left_key", F.when(F.col("label") == 9, F.lit(-1)).otherwise(F.col("right_key")).cast("bigint").alias("right_key"),
        F.col("label").cast("string").alias("label"))
    keyed = align_embeddings(vectors.select(F.col("vec_id").alias("pos"), F.col("vec_id").alias("key")),
                             vectors.select(F.col("vec_id").alias("pos"), "embedding"))
    return pair_similarity(keyed, pairs).withColumn("similarity", F.round("similarity", 6))


def uri_parts(spark, sf_dir):
    uri = F.replace(F.replace("url", F.lit("https://"), F.lit("gs://")), F.lit("#top"), F.lit("/"))
    pages = table(spark, sf_dir, "pages").select("page_id", uri.alias("uri"))
    return pages.select("page_id", "uri", uri_valid(F.col("uri")).alias("valid"),
                        uri_bucket(F.col("uri")).alias("bucket"), uri_object(F.col("uri")).alias("object"))


def embedding_payload(spark, sf_dir):
    """Vectors wrapped in both response shapes, and in neither."""
    label, vector = F.col("label"), F.col("embedding")
    wrapped = table(spark, sf_dir, "embeddings").select(
        "vec_id", F.when(label < 4, F.struct(vector.alias("values"))).alias("embeddings"),
        F.when((label >= 3) & (label < 8), vector).alias("values"))
    return embedding_of_payload(wrapped).select(
        "vec_id", F.size("embedding").cast("bigint").alias("dims"),
        F.round(F.element_at("embedding", 1).cast("double"), 6).alias("first_value"), "error")


QUERIES = {f.__name__: f for f in (
    chunk_documents, corpus_import, vector_topk, vector_topk_threshold, image_neighbors, ann_topk,
    index_append, retrieve, retrieve_indexed, query_guard, generation_requests, prompt_render, uri_parts, embedding_payload)}
QUERIES["embed_text"] = embed_documents
QUERIES["pair_similarity"] = pair_similarities

_MEANS = """
    means AS (SELECT query_id, list(v ORDER BY dim) AS e FROM (
        SELECT label AS query_id, dim, avg(embedding[dim]::double) AS v FROM embeddings, (SELECT unnest(range(1, 65)) AS dim) GROUP BY ALL)
        GROUP BY query_id)"""
_ALL_PAIRS = f"""{_MEANS},
    pairs AS (SELECT query_id, c.vec_id AS doc_id, round(1 - list_dot_product(q.e, c.embedding::double[]), 9) AS distance
              FROM means q CROSS JOIN embeddings c)"""

_RANKED = """SELECT query_id, doc_id, round(distance, 6) AS distance, rank::int AS rank{extra} FROM (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, doc_id) AS rank FROM {source}{where}) WHERE rank <= 5"""

#: The rows of ``retrieve`` in SQL, also for queries over the contexts it finds.
RETRIEVED_SQL = f"""{_CHUNKS},
    texts AS (SELECT doc_id || ':' || chunk_id AS id, array_to_string(part, ' ') AS text FROM chunk),
    {_embedding_sql('texts', 'id', 'text', DIMS)}, {_embedding_sql('benchmark', 'item_id', 'text', DIMS)},
    pairs AS (SELECT q.key AS query_id, c.key AS chunk_key, round(1 - list_dot_product(q.e, c.e), 9) AS distance
              FROM vec_benchmark q CROSS JOIN vec_texts c),
    found AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, chunk_key) AS rank
              FROM pairs WHERE distance < 0.5) WHERE rank <= 5)"""

SQL = {
    "chunk_documents": f"""WITH {_CHUNKS}
        SELECT doc_id, chunk_id, start_token, len(part)::int AS n_tokens, array_to_string(part, ' ') AS text FROM chunk""",
    "embed_text": f"""WITH {_embedding_sql('documents', 'doc_id', 'text', DIMS)}
        SELECT key AS doc_id, dim::int AS dim, round(v::double, 6) AS value FROM full_documents""",
    "corpus_import": f"""WITH {_CHUNKS}
        SELECT d.source, count(DISTINCT c.doc_id) AS imported_files_count, count(*) AS chunks, sum(len(part))::bigint AS tokens
        FROM chunk c JOIN documents d USING (doc_id) GROUP BY d.source""",
    "vector_topk": f"WITH {_ALL_PAIRS} " + _RANKED.format(extra="", source="pairs", where=""),
    "vector_topk_threshold": f"WITH {_ALL_PAIRS} "
        + _RANKED.format(extra=", 0.95::double AS threshold", source="pairs", where=" WHERE distance < 0.95")
        + " UNION ALL " + _RANKED.format(extra=", 0.97::double AS threshold", source="pairs", where=" WHERE distance < 0.97"),
    "ann_topk": "SELECT DISTINCT label AS query_id, 5::bigint AS found, true AS distances_hold, true AS recall_holds, true AS few_compared FROM embeddings",
    "image_neighbors": f"""
        WITH {_MEANS}, d AS (SELECT vec_id::varchar AS id, embedding::double[] AS e,
                          CASE WHEN label <> 9 THEN 'img/' || label || '/' || vec_id || '.jpg' END AS path FROM embeddings),
             pairs AS (SELECT q.query_id, c.id AS id, round(list_distance(q.e, c.e), 9) AS distance, c.path
                       FROM means q CROSS JOIN d c)
        SELECT query_id, id, rank::int AS rank, round(distance, 6) AS distance, path FROM (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, id) AS rank FROM pairs)
        WHERE rank <= 5 AND path IS NOT NULL""",
    "index_append": f"WITH {_ALL_PAIRS} " + _RANKED.format(extra=", true AS leaves_told, true AS leaves_small", source="pairs", where=""),
    "retrieve": f"""WITH {RETRIEVED_SQL}
        SELECT query_id, rank, split_part(chunk_key, ':', 1)::bigint AS doc_id, split_part(chunk_key, ':', 2)::bigint AS chunk_id,
               round(distance, 6) AS distance FROM found""",
    "retrieve_indexed": f"""WITH {RETRIEVED_SQL}
        SELECT query_id, rank, split_part(chunk_key, ':', 1)::bigint AS doc_id, split_part(chunk_key, ':', 2)::bigint AS chunk_id,
               round(distance, 6) AS distance, true AS share_told FROM found""",
    "query_guard": f"""
        SELECT conv_id || ':' || turn AS query_id, role <> 'system' AS accepted,
               CASE WHEN role = 'system' THEN '{prompts.BLANK_QUERY_STATUS}' END AS status FROM conversations""",
    "generation_requests": f"""WITH {RETRIEVED_SQL},
        listed AS (SELECT query_id, string_agg(t.text, chr(10) ORDER BY rank) AS contexts FROM found f JOIN texts t ON t.id = f.chunk_key GROUP BY query_id)
        SELECT b.item_id AS query_id, '{prompts.CORPUS_INSTRUCTION}' AS system_instruction, b.text AS query_text,
               coalesce(contexts, '') AS contexts, 1.0::double AS temperature, 8192.0::double AS max_output_tokens,
               4::bigint AS safety_rules
        FROM benchmark b LEFT JOIN listed ON query_id = item_id""",
    "prompt_render": f"""
        SELECT conv_id, turn, replace(replace('{prompts.RELEVANCE_TEMPLATE}', '{{prompt}}', role), '{{response}}', text) AS rendered
        FROM conversations""",
    "pair_similarity": """
        WITH p AS (SELECT e.vec_id AS left_key, e.label, min(e.vec_id) OVER (PARTITION BY e.label) AS first FROM embeddings e)
        SELECT p.left_key, CASE WHEN p.label = 9 THEN -1 ELSE p.first END::bigint AS right_key, p.label::varchar AS label,
               CASE WHEN p.label = 9 THEN -2.0
                    ELSE round(list_cosine_similarity(a.embedding::double[], b.embedding::double[]), 6) END AS similarity
        FROM p JOIN embeddings a ON a.vec_id = p.left_key JOIN embeddings b ON b.vec_id = p.first""",
    "uri_parts": """
        WITH u AS (SELECT page_id, replace(replace(url, 'https://', 'gs://'), '#top', '/') AS uri FROM pages)
        SELECT page_id, uri, starts_with(uri, 'gs://') AS valid,
               CASE WHEN starts_with(uri, 'gs://') THEN split_part(substr(uri, 6), '/', 1) END AS bucket,
               CASE WHEN starts_with(uri, 'gs://')
                    THEN substr(uri, 7 + length(split_part(substr(uri, 6), '/', 1))) END AS object
        FROM u""",
    "embedding_payload": """
        SELECT vec_id, CASE WHEN label < 8 THEN 64 END::bigint AS dims,
               CASE WHEN label < 8 THEN round(embedding[1]::double, 6) END AS first_value,
               CASE WHEN label >= 8 THEN 'Unknown embedding response format' END AS error
        FROM embeddings""",
}
