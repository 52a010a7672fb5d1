"""Inverted-file vector index: two levels of k-means, leaves stored as a sorted table.

The leaf count follows the rows. A leaf is a pair of a coarse centroid and a centroid of what is left
after it, so leaves need only about twice the square root of their number in centroids. Each row has a short code of what is
left after both centroids (``residual_codes``), and each leaf a ball that holds its rows (``leaf_bounds``).

* ``search_index`` looks at the codes of the nearest leaves, ranks the best candidates exactly, and then looks at every other
  leaf whose ball may hold something nearer. Vectors are read for the candidates only.
* ``search_within`` does the same with the vectors themselves, so its result is the exact one.

Rows lie in folders that a commit log lists. A reader stays on one generation of them, whatever writers do meanwhile. A leaf
that gets too large is cut into parts, each with its own ball, and the folders of its cell are merged into one.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BinaryType, DoubleType, FloatType, IntegerType, LongType, StringType, StructField,
                               StructType)

from tidemark.functions.memory import give_back
from tidemark.operators import residual_codes
from tidemark.operators.leaf_bounds import least_distances
from tidemark.operators.ordered import global_row_number, top_k
from tidemark.operators.vector_search import (BROADCAST_LIMIT, MEASURES, TOP_K, VectorColumns, best_places, common_dtype, id_order,
                                              matrix_of, nearest, pack_vectors, paired_distances, query_side, row_bytes, score_blocks,
                                              usual_length)
from tidemark.session import checkpointed
from tidemark.sources.commits import CommitLog, Conflict

# Index settings.
LEAF_SIZE = 500
LEAVES_TO_SEARCH = 0.07
CANDIDATES = 150

#: The share of the true neighbours that a search must find.
LEAST_RECALL = 0.9
#: Candidates are at most this share of all rows, but four for each row that is asked for. As many are ranked at first, for a bound.
MOST_EXACT, FIRST_RANKED = 0.2, 4
#: Centroids of a level, at most, and distinct rows that both levels are fitted on, at most: chosen by a hash of the vector.
MOST_CENTROIDS, MOST_TRAINED = 1 << 14, 1 << 18
#: A leaf is cut once it holds more than this many times its size.
OVERFULL = 2

#: What a task holds at once: bytes of look-up tables, candidates that leave it, and queries that meet a block of balls.
TABLE_BYTES, ROWS_AT_ONCE, BOUNDED_AT_ONCE = 16 << 20, 1 << 16, 128
#: Rows that a task places among the centroids at once.
PLACED_AT_ONCE = 1024
#: A leaf in a broadcast list of leaves, and a candidate.
LEAF_BYTES, CANDIDATE_BYTES = 32, 128

_CENTROIDS = StructType([StructField("centroid", IntegerType()), StructField("embedding", ArrayType(FloatType()))])
#: What names a leaf's part: rows that were never cut have part -1.
UNIT = ["coarse", "centroid", "part"]
CANDIDATE_ORDER = ["near", "doc", "folder", "row_no"]


@dataclass(frozen=True)
class VectorIndex:
    path: str

    @property
    def coarse_path(self) -> str:
        return f"{self.path}/coarse"

    @property
    def fine_path(self) -> str:
        return f"{self.path}/fine"

    @property
    def leaves_path(self) -> str:
        return f"{self.path}/leaves"

    @property
    def balls_path(self) -> str:
        return f"{self.path}/balls"

    @property
    def books_path(self) -> str:
        return f"{self.path}/books"

    @property
    def facts_path(self) -> str:
        return f"{self.path}/facts"

    def log(self, spark: SparkSession) -> CommitLog:
        return CommitLog(spark, f"{self.path}/log")


@dataclass(frozen=True)
class Generation:
    """The folders that make up the index at one commit: ``since`` says, for cells that were rewritten, which folder is the
    first that counts."""

    number: int
    folders: dict[str, int]
    since: dict[str, int]
    batches: list[int]

    @staticmethod
    def of(number: int, state: dict | None) -> Generation:
        state = state or {"folders": {}, "since": {}, "batches": []}
        return Generation(number, state["folders"], state["since"], state["batches"])


def current_generation(spark: SparkSession, index: VectorIndex) -> Generation:
    return Generation.of(*index.log(spark).latest())


def _folder_rows(spark: SparkSession, base: str, generation: Generation) -> DataFrame:
    """Rows of the generation's folders; those of rewritten cells from their new folder on."""
    paths = [f"{base}/folder={name}" for name in generation.folders]
    rows = spark.read.option("basePath", base).parquet(*paths)
    if generation.since:
        turn = F.create_map(*(F.lit(x) for pair in generation.folders.items() for x in pair))[F.col("folder")]
        first = F.create_map(*(F.lit(x) for cell, n in generation.since.items() for x in (int(cell), n)))[F.col("coarse")]
        rows = rows.filter(turn >= F.coalesce(first, F.lit(0)))
    return rows


def _centers(spark: SparkSession, path: str, key: str, vector: str) -> DataFrame:
    """A level's centroids: at most MOST_CENTROIDS, 48 MB of vectors with 768 numbers."""
    return F.broadcast(spark.read.schema(_CENTROIDS).parquet(path).select(F.col("centroid").alias(key), F.col("embedding").alias(vector)))


def _nearest_center(df: DataFrame, model: KMeansModel, vector: str, key: str) -> DataFrame:
    """Add the number of the nearest centroid; one pass, no shuffle."""
    featured = df.withColumn("_features", array_to_vector(F.col(vector)))
    return model.setFeaturesCol("_features").setPredictionCol(key).transform(featured).drop("_features")


def _without_center(df: DataFrame, path: str, key: str, vector: str, out: str) -> DataFrame:
    """Add a vector less its centroid of one level."""
    centers = _centers(df.sparkSession, path, "_c", "_center")
    rest = F.zip_with(vector, "_center", lambda x, y: x.cast("float") - y)
    return df.join(centers, F.col(key) == F.col("_c")).withColumn(out, rest).drop("_c", "_center")


def _save_centers(model: KMeansModel, spark: SparkSession, path: str) -> None:
    rows = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    spark.createDataFrame(rows, _CENTROIDS).write.mode("overwrite").parquet(path)


def _center_matrix(spark: SparkSession, path: str) -> np.ndarray:
    """A level's centroids as a matrix: at most MOST_CENTROIDS rows."""
    rows = sorted(spark.read.schema(_CENTROIDS).parquet(path).collect(), key=lambda r: r["centroid"])
    return np.array([r["embedding"] for r in rows], np.float32)


def _nearest_rows(points: np.ndarray, centers: np.ndarray) -> np.ndarray:
    own = centers.astype(np.float64)
    return (points.astype(np.float64) @ own.T - 0.5 * (own ** 2).sum(axis=1)).argmax(axis=1)


def _lengths(matrix: np.ndarray, known: np.ndarray) -> pa.Array:
    return pa.array(np.sqrt((matrix.astype(np.float64) ** 2).sum(axis=1)), mask=~known)


def _placed(vectors: DataFrame, index: VectorIndex, vector: str, codes: bool) -> Column:
    """A struct: ``coarse``, ``centroid`` (the leaf's number), and with ``codes`` the row's ``code``, its ``length`` and how far it is
    ``off`` its leaf's centroid and ``off_cell`` its coarse one; otherwise ``rest``, what is left after both centroids.

    Rows meet all centroids of a level as matrices, PLACED_AT_ONCE at a time: the centroids grow with the square root of the rows.
    """
    spark = vectors.sparkSession
    coarse, fine = (_center_matrix(spark, path) for path in (index.coarse_path, index.fine_path))
    books = residual_codes.read_books(spark, index.books_path) if codes else None
    names = ["coarse", "centroid", *(["code", "length", "off", "off_cell"] if codes else ["rest"])]
    dims = coarse.shape[1]

    @F.arrow_udf("coarse int, centroid int, " + ("code binary, length double, off double, off_cell double" if codes else "rest array<float>"))
    def placed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            parts = [batch.slice(low, PLACED_AT_ONCE) for low in range(0, len(batch), PLACED_AT_ONCE)] or [batch]
            yield pa.concat_arrays([_place(part) for part in parts])
            give_back()

    def _place(part: pa.Array) -> pa.Array:
        flat = part.flatten()
        matrix = flat.to_numpy(zero_copy_only=False).reshape(-1, dims)
        holes = flat.is_null().to_numpy(zero_copy_only=False).reshape(-1, dims)
        known = ~holes.any(axis=1)
        single = matrix.astype(np.float32)
        first_at = _nearest_rows(np.where(holes, 0, matrix), coarse)
        first = single - coarse[first_at]
        fine_at = _nearest_rows(np.where(holes, 0, first), fine)
        rest = first - fine[fine_at]
        at = [pa.array(first_at.astype(np.int32)), pa.array((first_at * len(fine) + fine_at).astype(np.int32))]
        if not codes:
            ends = pa.array(np.arange(len(rest) + 1) * dims, pa.int32())
            return pa.StructArray.from_arrays([*at, pa.ListArray.from_arrays(ends, pa.array(rest.reshape(-1)))], names=names)
        code = pa.array([row.tobytes() for row in residual_codes.encode(rest, books)], pa.binary())
        return pa.StructArray.from_arrays([*at, code, _lengths(matrix, known), _lengths(rest, known), _lengths(first, known)], names=names)

    return placed.asNondeterministic()(F.col(vector))  # else the optimizer may run it once for each field


def assign_leaves(vectors: DataFrame, index: VectorIndex, vector: str) -> DataFrame:
    """Add ``coarse``, ``centroid`` (the leaf's number), ``part``, the row's ``code``, its ``length`` and how far it is ``off`` its
    leaf's centroid and ``off_cell`` its coarse one; one pass, no shuffle."""
    own = vectors.withColumn("_placed", _placed(vectors, index, vector, True))
    return own.select("*", "_placed.coarse", "_placed.centroid", F.lit(-1).alias("part"), "_placed.code", "_placed.length", "_placed.off",
                      "_placed.off_cell").drop("_placed")


def _write_folder(rows: DataFrame, index: VectorIndex) -> str | None:
    """Write rows below their cells, sorted by leaf, in a new folder that no commit names yet; returns it (None without rows)."""
    spark, folder = rows.sparkSession, uuid.uuid4().hex
    (rows.withColumn("row_no", F.monotonically_increasing_id()).hint("rebalance", "coarse").sortWithinPartitions(*UNIT)
     .write.partitionBy("coarse").parquet(f"{index.leaves_path}/folder={folder}"))
    if not spark.read.schema("row_no bigint, coarse int").parquet(f"{index.leaves_path}/folder={folder}").limit(1).count():
        return None
    return folder


def _balls(rows: DataFrame, index: VectorIndex) -> DataFrame:
    """(coarse, centroid, part, rows, radius, least, most, reach, center, base) of leaves that were never cut: ``center`` is the
    ball's, ``base`` what codes are left from."""
    spark = rows.sparkSession
    sums = rows.groupBy(*UNIT).agg(F.count("*").alias("rows"), F.max("off").alias("radius"), F.min("length").alias("least"),
                                   F.max("length").alias("most"), F.max("off_cell").alias("reach"))
    centers = leaf_vectors(spark, index, sums.select("coarse", "centroid").distinct())
    return sums.join(centers, ["coarse", "centroid"]).withColumn("base", F.col("center"))


def _commit_rows(index: VectorIndex, rows: DataFrame, batch_id: int | None) -> None:
    """Write rows as a folder and commit it as a batch, unless that batch is there already."""
    spark, log = rows.sparkSession, index.log(rows.sparkSession)
    folder = _write_folder(rows, index)
    if folder:
        written = spark.read.parquet(f"{index.leaves_path}/folder={folder}")
        _balls(written, index).write.partitionBy("coarse").parquet(f"{index.balls_path}/folder={folder}")

    def add(state: dict | None) -> dict:
        now = Generation.of(0, state)
        if batch_id in now.batches:
            return {"folders": now.folders, "since": now.since, "batches": now.batches}
        folders = now.folders | ({folder: max(now.folders.values(), default=0) + 1} if folder else {})
        return {"folders": folders, "since": now.since, "batches": [*now.batches, batch_id]}

    log.update(add)


def write_leaves(assigned: DataFrame, index: VectorIndex, batch_id: int) -> None:
    """Add one batch of assigned rows. A batch that is there already is not added again, so a replay after a lost executor
    or driver changes nothing."""
    if batch_id not in current_generation(assigned.sparkSession, index).batches:
        _commit_rows(index, assigned.withColumn("batch_id", F.lit(batch_id).cast("bigint")), batch_id)


def _hash_share(vector: str, rows: int, most: int) -> Column:
    """True for about ``most`` of all distinct vectors, for copies alike."""
    return F.pmod(F.xxhash64(vector), F.lit(max(1, math.ceil(rows / most)))) == 0


def build_index(vectors: DataFrame, path: str, vector: str = "embedding", leaf_size: int = LEAF_SIZE, seed: int = 42) -> VectorIndex:
    """Train both levels and the code books on a bounded sample of distinct vectors, and write every vector to its leaf.

    Copies count once in training: otherwise a vector repeated in a third of all
    rows would take a third of the centroids. Vectors of another than the most common
    length are left out; ``unusable_vectors`` tells which and why. Leaves that are overfull are cut at once.
    """
    spark, index = vectors.sparkSession, VectorIndex(path)
    dims = usual_length(vectors, vector)
    usable = vectors.filter(F.size(vector) == dims)
    rows = usable.count()
    leaves = max(1, math.ceil(rows / leaf_size))
    per_level = min(MOST_CENTROIDS, max(2, math.ceil(math.sqrt(leaves))))
    sampled = usable.select(F.col(vector).cast("array<double>").alias("v")).filter(_hash_share("v", rows, MOST_TRAINED)).dropDuplicates()
    # In an order of its own, so that training doesn't depend on how rows were dealt.
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    distinct = checkpointed(sampled.repartition(width, "v").sortWithinPartitions("v"))

    def fit(df: DataFrame, column: str, name: str) -> None:
        features = df.select(array_to_vector(F.col(column)).alias("_features"))
        model = KMeans(k=per_level, seed=seed, maxIter=10, featuresCol="_features").fit(features)
        model.write().overwrite().save(f"{path}/{name}-model")
        _save_centers(model, spark, f"{path}/{name}")

    fit(distinct, "v", "coarse")
    coarse = KMeansModel.load(f"{path}/coarse-model")
    fit(_without_center(_nearest_center(distinct, coarse, "v", "coarse"), index.coarse_path, "coarse", "v", "_first"), "_first", "fine")
    some = distinct.filter(_hash_share("v", distinct.count(), residual_codes.MOST_TRAINED))
    rests = some.select(_placed(some, index, "v", False).alias("_placed")).select("_placed.rest")
    residual_codes.train_books(rests, "rest", dims, index.books_path, seed)
    usual = distinct.agg(F.sqrt(F.avg(_length("v") ** 2))).first()[0] or 1.0
    facts = [(dims, leaf_size, float(usual), vector)]
    spark.createDataFrame(facts, "dims int, leaf_size int, usual double, vector string").write.mode("overwrite").parquet(index.facts_path)
    write_leaves(assign_leaves(usable, index, vector), index, batch_id=-1)
    cut_overfull(spark, index)
    return index


def _length(vector: str) -> Column:
    return F.sqrt(F.aggregate(vector, F.lit(0.0), lambda a, x: a + x.cast("double") * x))


def _aimed(queries: DataFrame, vector: str, measure: str, length: float) -> DataFrame:
    """Queries as they meet the centroids. Only ``euclidean`` depends on a query's length; for the others it gets the stored vectors'
    usual one, as short queries (means, for one) would otherwise be nearest to the centroids of least length."""
    if measure == "euclidean":
        return queries
    scaled = F.transform(vector, lambda x: x.cast("double") * (F.lit(length) / _length(vector)))
    return queries.withColumn(vector, F.when(_length(vector) > 0, scaled).otherwise(F.col(vector).cast("array<double>")))


def recall(found: DataFrame, exact: DataFrame, query_id: str = "query_id") -> float:
    """The share of the exact results that a search found; a row counts if it's as near as the last exact one, whichever of equals it is."""
    last = exact.groupBy(query_id).agg(F.max("distance").alias("last"), F.count("*").alias("n"))
    hits = found.join(last.select(query_id, "last"), query_id).filter(F.col("distance") <= F.col("last") + 1e-6)
    total = last.agg(F.sum("n")).first()[0]
    return hits.count() / total if total else 1.0


def append_to_index(vectors: DataFrame, index: VectorIndex, batch_id: int, vector: str = "embedding") -> None:
    """Assign new vectors to the existing centroids and add them; those of another length than the index's are left out.

    Leaves that got overfull are cut afterwards, in a commit of its own.
    """
    spark = vectors.sparkSession
    dims = spark.read.parquet(index.facts_path).first()["dims"]
    write_leaves(assign_leaves(vectors.filter(F.size(vector) == dims), index, vector), index, batch_id)
    cut_overfull(spark, index)


def cut_overfull(spark: SparkSession, index: VectorIndex, tries: int = 5) -> int:
    """Cut leaves whose uncut rows are more than OVERFULL times the leaf size; returns how many.

    The rows of such a leaf are ordered along the line from its centroid to its farthest row and dealt to parts of the
    leaf size, each with a ball of its own. The order is made by ranges over all these rows, so one leaf that holds a third
    of them (copies, say) is no task of its own. The cells of these leaves are written anew into one folder, which also
    merges their small files; readers of earlier generations still find the old ones. If another writer commits
    meanwhile, the cut is made again.
    """
    for _ in range(tries):
        generation = current_generation(spark, index)
        if not generation.folders:
            return 0
        facts = spark.read.parquet(index.facts_path).first()
        size, vector = facts["leaf_size"], facts["vector"]
        known = leaf_table(spark, index, generation)
        over = checkpointed(known.filter((F.col("part") == -1) & (F.col("rows") > OVERFULL * size)).select(
            "coarse", "centroid", F.col("center").alias("_center")))
        cells = [r["coarse"] for r in over.select("coarse").distinct().collect()]  # at most MOST_CENTROIDS
        if not cells:
            return 0
        rows = read_leaves(spark, index, generation).filter(F.col("coarse").isin(cells)).drop("folder", "row_no")
        last = known.groupBy("coarse", "centroid").agg(F.max("part").alias("_last"))
        uncut = rows.filter("part = -1").join(over, ["coarse", "centroid"])
        far = uncut.groupBy("coarse", "centroid").agg(F.max_by(F.col(vector), F.col("off")).alias("_far"))
        along = F.aggregate(F.zip_with(vector, F.zip_with("_far", "_center", lambda x, y: x.cast("double") - y), lambda x, y: x * y),
                            F.lit(0.0), lambda a, x: a + x)
        lined = uncut.join(far, ["coarse", "centroid"]).withColumn("_along", along).drop("_far")
        numbered = checkpointed(global_row_number(lined, ["coarse", "centroid", "_along"], "_no"))
        first = numbered.groupBy("coarse", "centroid").agg(F.min("_no").alias("_least")).join(last, ["coarse", "centroid"])
        cut = checkpointed(numbered.join(first, ["coarse", "centroid"]).withColumn(
            "part", (F.col("_last") + 1 + F.floor((F.col("_no") - F.col("_least")) / size)).cast("int")).select(*rows.columns))
        kept = rows.join(over.select("coarse", "centroid", F.lit(-1).alias("part")), UNIT, "left_anti")
        folder = _write_folder(kept.unionByName(cut), index)
        fine = known.filter(F.col("coarse").isin(cells)).join(over.select("coarse", "centroid", F.lit(-1).alias("part")), UNIT, "left_anti")
        bases = known.select("coarse", "centroid", "base").dropDuplicates(["coarse", "centroid"])
        parts = _part_balls(cut, vector).join(bases, ["coarse", "centroid"])
        fine.unionByName(parts).write.partitionBy("coarse").parquet(f"{index.balls_path}/folder={folder}")
        if _replace_cells(index.log(spark), generation, folder, cells):
            return over.count()
    raise Conflict(f"other writers were faster {tries} times")


def _replace_cells(log: CommitLog, seen: Generation, folder: str, cells: list[int]) -> bool:
    def replace(state: dict | None) -> dict:
        now = Generation.of(0, state)
        if now.folders != seen.folders:
            raise Conflict("folders were added meanwhile")
        turn = max(now.folders.values()) + 1
        return {"folders": now.folders | {folder: turn}, "since": now.since | {str(c): turn for c in cells}, "batches": now.batches}

    try:
        log.update(replace)
        return True
    except Conflict:
        return False


def _part_balls(cut: DataFrame, vector: str) -> DataFrame:
    """Balls around the parts' mean vectors. A part has at most the leaf size of rows."""
    def ball(table: pa.Table) -> pa.Table:
        matrix = matrix_of(table.column(vector).combine_chunks(), "float64")
        center = matrix.mean(axis=0)
        off = np.sqrt(((matrix - center) ** 2).sum(axis=1)).max()
        length = table.column("length").to_numpy()
        return pa.table({**{c: table.column(c).slice(0, 1) for c in UNIT}, "rows": pa.array([len(matrix)], pa.int64()), "radius": pa.array([off]),
                         "least": pa.array([length.min()]), "most": pa.array([length.max()]),
                         "reach": pa.array([table.column("off_cell").to_numpy().max()]), "center": pa.array([center.tolist()], pa.list_(pa.float64()))})

    return cut.select(*UNIT, vector, "length", "off_cell").groupBy(*UNIT).applyInArrow(ball, (
        "coarse int, centroid int, part int, rows bigint, radius double, least double, most double, reach double, center array<double>"))


def remove_old(spark: SparkSession, index: VectorIndex) -> list[str]:
    """Forget all generations but the latest, and remove the folders that only they named. Call it where no one reads them."""
    log = index.log(spark)
    log.expire(1)
    generation = current_generation(spark, index)
    named = {f"folder={name}" for name in generation.folders}
    log.remove_folders(index.balls_path, named)
    return log.remove_folders(index.leaves_path, named)


def compact_index(spark: SparkSession, index: VectorIndex, path: str) -> VectorIndex:
    """A copy of the index with all batches merged, for an index that many small appends have split into small files."""
    merged = VectorIndex(path)
    for name in ("coarse", "fine"):
        KMeansModel.load(f"{index.path}/{name}-model").write().overwrite().save(f"{path}/{name}-model")
    for name in ("coarse", "fine", "books", "facts"):
        spark.read.parquet(f"{index.path}/{name}").write.mode("overwrite").parquet(f"{path}/{name}")
    rows = read_leaves(spark, index).drop("batch_id", "folder", "row_no").withColumn("part", F.lit(-1))
    write_leaves(rows, merged, batch_id=-1)
    cut_overfull(spark, merged)
    return merged


def leaf_vectors(spark: SparkSession, index: VectorIndex, leaves: DataFrame) -> DataFrame:
    """(coarse, centroid, center): the sum of both levels' centroids."""
    width = spark.read.parquet(index.fine_path).count()
    first = leaves.join(_centers(spark, index.coarse_path, "_c", "_coarse"), F.col("coarse") == F.col("_c"))
    both = first.join(_centers(spark, index.fine_path, "_f", "_fine"), F.col("centroid") % width == F.col("_f"))
    return both.select("coarse", "centroid", F.zip_with("_coarse", "_fine", lambda x, y: x.cast("double") + y.cast("double")).alias("center"))


def leaf_table(spark: SparkSession, index: VectorIndex, generation: Generation | None = None) -> DataFrame:
    """One row for each leaf's part in use: (coarse, centroid, part, rows, radius, least, most, reach, center, base)."""
    rows = _folder_rows(spark, index.balls_path, generation or current_generation(spark, index))
    return rows.groupBy(*UNIT).agg(
        F.sum("rows").alias("rows"), F.max("radius").alias("radius"), F.min("least").alias("least"), F.max("most").alias("most"),
        F.max("reach").alias("reach"), F.first("center").alias("center"), F.first("base").alias("base"))


def leaf_centroids(spark: SparkSession, index: VectorIndex, generation: Generation | None = None) -> DataFrame:
    """(coarse, centroid, embedding) of the leaves in use."""
    used = leaf_table(spark, index, generation).select("coarse", "centroid", F.col("base").alias("embedding"))
    return used.dropDuplicates(["coarse", "centroid"])


def read_leaves(spark: SparkSession, index: VectorIndex, generation: Generation | None = None) -> DataFrame:
    return _folder_rows(spark, index.leaves_path, generation or current_generation(spark, index))


# ------------------------------------------------------------------------------------------------ search

def _probe_share(queries: DataFrame, index: VectorIndex, k: int, measure: str, threshold: float | None, share: float, query: VectorColumns,
                 doc: VectorColumns, broadcast_limit: int) -> DataFrame:
    """Probe the given share of the leaves and rank their rows exactly."""
    spark, generation = queries.sparkSession, current_generation(queries.sparkSession, index)
    centroids = checkpointed(leaf_centroids(spark, index, generation))
    count = centroids.count()
    aimed = _aimed(queries, query.vector, measure, spark.read.parquet(index.facts_path).first()["usual"])
    probes_per_query = max(1, math.ceil(share * count))
    probes = checkpointed(nearest(aimed, centroids, probes_per_query, "euclidean", query=query,
                                  doc=VectorColumns("centroid", "embedding"),
                                  broadcast_limit=broadcast_limit).select(query.id, "centroid"))
    leaves = read_leaves(spark, index, generation)
    if probes_per_query < count:
        # Probed leaves prune coarse folders while the scan starts, and other leaves' rows before they are packed.
        probed = centroids.join(probes.select("centroid").distinct(), "centroid", "left_semi").select("coarse", "centroid")
        small = count * LEAF_BYTES <= broadcast_limit
        leaves = leaves.join(F.broadcast(probed) if small else probed, ["coarse", "centroid"], "left_semi")
    n, dims = query_side(queries, query)
    routed = queries.join(probes, query.id).hint("rebalance", "centroid")
    dtype = common_dtype((queries, query), (leaves, doc))
    q_blocks = pack_vectors(routed, query, F.col("centroid"), "q_", dtype)
    c_blocks = pack_vectors(leaves, doc, F.col("centroid"), "c_", dtype)
    if n * probes_per_query * row_bytes(dims, dtype) <= broadcast_limit:
        q_blocks = F.broadcast(q_blocks)
    pairs = c_blocks.join(q_blocks, F.col("c_key") == F.col("q_key"))
    scored = score_blocks(pairs, k, measure, threshold, query.id, doc.id, dtype)
    return top_k(scored, [query.id], ["distance", doc.id], k)


def _passing(queries: DataFrame, query: VectorColumns, balls: DataFrame, ball_id: Column, radius: str, key: Column | None, measure: str,
             broadcast_limit: int) -> DataFrame:
    """(query id, ball): which balls may hold a vector no farther than the query's ``limit``. Both sides meet on ``key``."""
    asked = queries.withColumn("_with", F.concat(F.col(query.vector).cast("array<double>"), F.array("limit")))
    held = balls.select(ball_id.alias("ball"), F.concat("center", F.array(radius, "least", "most")).alias("_with"), *(["coarse"] if key is not None else []))
    key = F.lit(0) if key is None else key
    q_blocks = pack_vectors(asked, VectorColumns(query.id, "_with"), key, "q_", "float64")
    c_blocks = pack_vectors(held, VectorColumns("ball", "_with"), key, "c_", "float64")
    n, dims = query_side(asked, VectorColumns(query.id, "_with"))
    if n * row_bytes(dims, "float64") <= broadcast_limit:
        q_blocks = F.broadcast(q_blocks)
    pairs = c_blocks.join(q_blocks, F.col("c_key") == F.col("q_key")).select("q_ids", "q_vectors", "c_ids", "c_vectors")

    def passing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                left, right = (batch.column(c)[i].values for c in (0, 2))
                q, c = (np.frombuffer(batch.column(j)[i].as_buffer(), np.float64).reshape(len(ids), -1) for j, ids in ((1, left), (3, right)))
                for low in range(0, len(q), BOUNDED_AT_ONCE):
                    part = q[low:low + BOUNDED_AT_ONCE]
                    bound = least_distances(part[:, :-1], c[:, :-3], c[:, -3], c[:, -2], c[:, -1], measure)
                    rows, columns = np.nonzero(bound <= part[:, -1:])
                    if len(rows):
                        yield pa.RecordBatch.from_arrays([left.take(pa.array(low + rows)), right.take(pa.array(columns))], names=[query.id, "ball"])
            give_back()

    schema = StructType([StructField(query.id, pairs.schema["q_ids"].dataType.elementType), StructField("ball", pairs.schema["c_ids"].dataType.elementType)])
    return pairs.mapInArrow(passing, schema)


def _by_unit(rows: DataFrame, unit: list[str], lists: list[str], blobs: dict[str, str], prefix: str) -> DataFrame:
    """Rows packed by unit in their tasks: values as lists, and numbers or bytes side by side as binary (``blobs``: numpy types).

    A block has at most 1,024 rows.
    """
    source = rows.select(*unit, *lists, *blobs)
    fields = [source.schema[c] for c in unit]
    schema = StructType([StructField(prefix + f.name, f.dataType) for f in fields]
                        + [StructField(prefix + c, ArrayType(source.schema[c].dataType)) for c in lists])
    schema = StructType(schema.fields + [StructField(prefix + c, BinaryType()) for c in blobs])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch]).sort_by([(c, "ascending") for c in unit]).combine_chunks().to_batches()[0]
            change = np.zeros(table.num_rows, bool)
            change[0] = True
            for c in range(len(unit)):
                own = table.column(c).to_numpy(zero_copy_only=False)
                change[1:] |= own[1:] != own[:-1]
            starts = np.flatnonzero(change)
            ends = np.append(starts[1:], table.num_rows)
            cuts = [low for a, b in zip(starts, ends) for low in range(int(a), int(b), 1024)]
            edges = cuts + [table.num_rows]
            columns = [table.column(c).take(pa.array(cuts)) for c in range(len(unit))]
            columns += [pa.ListArray.from_arrays(pa.array(edges, pa.int32()), table.column(len(unit) + k)) for k in range(len(lists))]
            for k, kind in enumerate(blobs.values(), len(unit) + len(lists)):
                column, out = table.column(k), []
                for a, b in zip(edges[:-1], edges[1:]):
                    own = column.slice(a, b - a)
                    if kind == "bytes":
                        out.append(b"".join(own.to_pylist()))
                    else:
                        flat = own.flatten() if pa.types.is_list(own.type) else own
                        out.append(flat.to_numpy(zero_copy_only=False).astype(kind).tobytes())
                columns.append(pa.array(out, pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return source.mapInArrow(pack, schema)


def _met(c_blocks: DataFrame, q_blocks: DataFrame, small: bool) -> DataFrame:
    same = [F.col(f"c_{u}") == F.col(f"q_{u}") for u in UNIT]
    return c_blocks.join(F.broadcast(q_blocks) if small else q_blocks, same)


def _code_candidates(pairs: DataFrame, books: np.ndarray, keep: int, measure: str, query_id: str) -> DataFrame:
    """(query id, coarse, folder, row_no, doc, near): each query's best rows of each block by their codes, ``keep`` at most; among
    equals the smaller doc id comes first."""
    schema = StructType([StructField(query_id, pairs.schema["q_ids"].dataType.elementType), StructField("coarse", IntegerType()),
                         StructField("folder", StringType()), StructField("row_no", LongType()),
                         StructField("doc", pairs.schema["c_ids"].dataType.elementType), StructField("near", DoubleType())])
    source = pairs.select("q_ids", "q_vector", "q_shift", "q_own", "c_coarse", "c_folder", "c_row_no", "c_ids", "c_code", "c_length")

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, np.ndarray] = {}
        at_once = max(1, TABLE_BYTES // (4 * residual_codes.ENTRIES * len(books)))
        for batch in batches:
            held: list[pa.RecordBatch] = []
            for i in range(batch.num_rows):
                asked, row_no, docs = (batch.column(c)[i].values for c in (0, 6, 7))
                vectors, shift, own, code, length = (batch.column(c)[i].as_buffer() for c in (1, 2, 3, 8, 9))
                by_id = id_order(docs)
                codes = np.frombuffer(code, np.uint8).reshape(len(row_no), -1)[by_id]
                other = np.frombuffer(length, np.float64)[by_id]
                all_q = np.frombuffer(vectors, np.float32).reshape(len(asked), -1)
                for low in range(0, len(asked), at_once):
                    ids, q = asked.slice(low, at_once), all_q[low:low + at_once]
                    # Queries come in the same groups again and again: their tables are kept, four times TABLE_BYTES at most.
                    name = q.tobytes()
                    tables = known.get(name)
                    if tables is None:
                        tables = residual_codes.look_up_tables(q, books)
                        if sum(t.nbytes for t in known.values()) + tables.nbytes > 4 * TABLE_BYTES:
                            known.clear()
                        known[name] = tables
                    inner = residual_codes.products(tables, codes) + np.frombuffer(shift, np.float64)[low:low + at_once, None]
                    mine = np.frombuffer(own, np.float64)[low:low + at_once, None]
                    if measure == "euclidean":
                        near = np.sqrt(np.maximum(mine ** 2 + other ** 2 - 2 * inner, 0))
                    elif measure == "cosine":
                        near = 1 - inner / np.where(mine * other > 0, mine * other, 1)
                    else:
                        near = 1 - inner
                    rows, columns = best_places(near, keep, None)
                    place = pa.array(by_id[columns])
                    held.append(pa.RecordBatch.from_arrays([
                        ids.take(pa.array(rows)), pa.array(np.full(len(rows), batch.column(4)[i].as_py(), np.int32)),
                        pa.repeat(pa.scalar(batch.column(5)[i].as_py(), pa.string()), len(rows)), row_no.take(place), docs.take(place),
                        pa.array(near[rows, columns])], names=schema.names))
                    if sum(h.num_rows for h in held) >= ROWS_AT_ONCE:
                        yield from pa.Table.from_batches(held).combine_chunks().to_batches(ROWS_AT_ONCE)
                        held = []
            if held:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches(ROWS_AT_ONCE)
            give_back()

    return source.mapInArrow(best, schema)


@dataclass(frozen=True)
class Searched:
    """``found``: (query id, doc id, distance, rank). ``leaves``: (query id, read, of): how many leaves' parts were looked at.
    ``exact``: (query id, rows): how many rows were compared by their vectors."""

    found: DataFrame
    leaves: DataFrame
    exact: DataFrame


class _Search:
    """One search: the generation it reads, and its queries, written once."""

    def __init__(self, queries: DataFrame, index: VectorIndex, k: int, measure: str, threshold: float | None, query: VectorColumns,
                 doc: VectorColumns, candidates: int, coded: bool, broadcast_limit: int):
        spark = queries.sparkSession
        self.spark, self.index, self.k, self.measure, self.threshold = spark, index, k, measure, threshold
        self.query, self.doc, self.coded, self.limit = query, doc, coded, broadcast_limit
        self.generation = current_generation(spark, index)
        facts = spark.read.parquet(index.facts_path).first()
        self.queries = queries.filter(F.size(query.vector) == facts["dims"])
        self.units = checkpointed(leaf_table(spark, index, self.generation))
        total = self.units.agg(F.count("*").alias("units"), F.sum("rows").alias("rows")).first()
        self.unit_count, rows = total["units"], total["rows"] or 0
        self.candidates = min(candidates, max(FIRST_RANKED * k, int(MOST_EXACT * rows)))
        self.cells = checkpointed(self.units.groupBy("coarse").agg(
            F.max("reach").alias("reach"), F.min("least").alias("least"), F.max("most").alias("most")).join(
                _centers(spark, index.coarse_path, "_c", "_v"), F.col("coarse") == F.col("_c")).select(
                    "coarse", "reach", "least", "most", F.col("_v").cast("array<double>").alias("center")))
        self.rows = read_leaves(spark, index, self.generation)
        self.dtype = common_dtype((self.queries, query), (self.rows, doc))
        self.n, self.dims = query_side(self.queries, query)
        self.books = residual_codes.read_books(spark, index.books_path) if coded else None

    def first_look(self) -> DataFrame:
        """(query id, unit): the leaves of the nearest cells, LEAVES_TO_SEARCH of all cells."""
        most = max(1, math.ceil(LEAVES_TO_SEARCH * self.cells.count()))
        cells = nearest(self.queries, self.cells.select("coarse", F.col("center").alias("_v")), most, self.measure, query=self.query,
                        doc=VectorColumns("coarse", "_v"), broadcast_limit=self.limit).select(self.query.id, "coarse")
        return cells.join(self.units.select(*UNIT), "coarse").select(self.query.id, *UNIT)

    def second_look(self, seen: DataFrame, found: DataFrame) -> DataFrame:
        """(query id, unit): other leaves whose balls may hold something as near as the k-th row found, and within the threshold."""
        last = found.groupBy(F.col(self.query.id).alias("_id")).agg(F.count("*").alias("n"), F.max("distance").alias("far"))
        reach = F.when(F.col("n") >= self.k, F.col("far")).otherwise(F.lit(math.inf))
        bound = F.lit(math.inf if self.threshold is None else self.threshold)
        limited = checkpointed(self.queries.join(last, F.col(self.query.id) == F.col("_id"), "left").withColumn(
            "limit", F.least(F.coalesce(reach, F.lit(math.inf)), bound)).select(self.query.id, self.query.vector, "limit"))
        cells = _passing(limited, self.query, self.cells, F.col("coarse"), "reach", None, self.measure, self.limit)
        routed = limited.join(cells.withColumnRenamed("ball", "coarse"), self.query.id)
        passing = _passing(routed, self.query, self.units, F.struct(*UNIT), "radius", F.col("coarse"), self.measure, self.limit)
        return passing.select(self.query.id, "ball.*").join(seen, [self.query.id, *UNIT], "left_anti")

    def _routed(self, probes: DataFrame) -> tuple[DataFrame, bool]:
        routed = self.queries.join(probes, self.query.id)
        return routed, probes.count() * row_bytes(self.dims, self.dtype) <= self.limit

    def _probed_rows(self, probes: DataFrame) -> DataFrame:
        wanted = probes.select(*UNIT).distinct()
        small = self.unit_count * LEAF_BYTES <= self.limit
        return self.rows.join(F.broadcast(wanted) if small else wanted, UNIT, "left_semi")

    def exact(self, probes: DataFrame) -> DataFrame:
        """(query id, doc id, distance): the best k of the probed leaves by their vectors."""
        routed, small = self._routed(probes)
        kind = "array<double>" if self.dtype == "float64" else "array<float>"
        q = routed.select(*UNIT, F.col(self.query.id).alias("ids"), F.col(self.query.vector).cast(kind).alias("vectors"))
        c = self._probed_rows(probes).select(*UNIT, F.col(self.doc.id).alias("ids"), F.col(self.doc.vector).cast(kind).alias("vectors"))
        blocks = [_by_unit(side, UNIT, ["ids"], {"vectors": self.dtype}, p) for side, p in ((c, "c_"), (q.hint("rebalance", *UNIT), "q_"))]
        scored = score_blocks(_met(*blocks, small), self.k, self.measure, self.threshold, self.query.id, self.doc.id, self.dtype)
        return top_k(scored, [self.query.id], ["distance", self.doc.id], self.k).drop("rank")

    def by_codes(self, probes: DataFrame) -> DataFrame:
        """(query id, coarse, folder, row_no, doc, near): the best candidates of the probed leaves by their codes."""
        routed, small = self._routed(probes)
        base = routed.join(self.units.select(*UNIT, "base"), UNIT)
        shift = F.aggregate(F.zip_with(self.query.vector, "base", lambda x, y: x.cast("double") * y), F.lit(0.0), lambda a, x: a + x)
        q = base.select(*UNIT, F.col(self.query.id).alias("ids"), F.col(self.query.vector).cast("array<float>").alias("vector"), shift.alias("shift"),
                        _length(self.query.vector).alias("own"))
        q_blocks = _by_unit(q.hint("rebalance", *UNIT), UNIT, ["ids"], {"vector": "float32", "shift": "float64", "own": "float64"}, "q_")
        c = self._probed_rows(probes).select(*UNIT, "folder", "row_no", F.col(self.doc.id).alias("ids"), "code", "length")
        c_blocks = _by_unit(c, [*UNIT, "folder"], ["row_no", "ids"], {"code": "bytes", "length": "float64"}, "c_")
        scored = _code_candidates(_met(c_blocks, q_blocks, small), self.books, self.candidates, self.measure, self.query.id)
        return top_k(scored, [self.query.id], CANDIDATE_ORDER, self.candidates).drop("rank")

    def ranked(self, candidates: DataFrame) -> DataFrame:
        """(query id, doc id, distance) of the candidates by their vectors, best k."""
        few = candidates.count() * CANDIDATE_BYTES <= self.limit
        wanted = candidates.select(F.col(self.query.id).alias("_query"), "coarse", "folder", "row_no")
        rows = self.rows.select("coarse", "folder", "row_no", F.col(self.doc.id).alias("_doc"), F.col(self.doc.vector).alias("_vector"))
        met = rows.join(F.broadcast(wanted) if few else wanted, ["coarse", "folder", "row_no"])
        both = met.join(self.queries.select(F.col(self.query.id).alias("_own"), F.col(self.query.vector).alias("_asked")), F.col("_query") == F.col("_own"))
        scored = paired_distances(both.select("_query", "_doc", "_asked", "_vector"), self.measure, self.dtype).select(
            F.col("_query").alias(self.query.id), F.col("_doc").alias(self.doc.id), "distance")
        near = scored if self.threshold is None else scored.filter(F.col("distance") < self.threshold)
        return top_k(near, [self.query.id], ["distance", self.doc.id], self.k)

    def run(self) -> Searched:
        probes = checkpointed(self.first_look())
        if self.coded:
            some = checkpointed(self.by_codes(probes))
            # A few are enough for the bound on the k-th distance.
            first = checkpointed(top_k(some, [self.query.id], CANDIDATE_ORDER, FIRST_RANKED * self.k).drop("rank"))
            more = checkpointed(self.second_look(probes, self.ranked(first)))
            both = some.unionByName(self.by_codes(more))
            final = checkpointed(top_k(both, [self.query.id], CANDIDATE_ORDER, self.candidates).drop("rank"))
            found, exact = self.ranked(final), first.unionByName(final).select(self.query.id, "coarse", "folder", "row_no").distinct()
            compared = exact.groupBy(self.query.id).agg(F.count("*").alias("rows"))
        else:
            some = checkpointed(self.exact(probes))
            more = checkpointed(self.second_look(probes, some))
            found = top_k(some.unionByName(self.exact(more)), [self.query.id], ["distance", self.doc.id], self.k)
            compared = probes.unionByName(more).join(self.units, UNIT).groupBy(self.query.id).agg(F.sum("rows").alias("rows"))
        leaves = probes.unionByName(more).groupBy(self.query.id).agg(F.count("*").alias("read")).withColumn("of", F.lit(self.unit_count))
        return Searched(found, leaves, compared)


def _checked(k: int, candidates: int, measure: str) -> None:
    if not 1 <= k <= candidates:
        raise ValueError("k must lie between 1 and the number of candidates")
    if measure not in MEASURES:
        raise ValueError(f"measure must be one of {MEASURES}")


def search_index(queries: DataFrame, index: VectorIndex, k: int = TOP_K, measure: str = "dot",
                 threshold: float | None = None, leaves_to_search: float | None = None,
                 candidates: int = CANDIDATES, query: VectorColumns = VectorColumns("query_id", "embedding"),
                 doc: VectorColumns = VectorColumns("doc_id", "embedding"),
                 broadcast_limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Approximate k nearest rows: (query id, doc id, distance, rank).

    Without ``leaves_to_search``, codes choose ``candidates`` rows a query (at most a fifth of all rows, but four for each of
    the k), which are ranked by their vectors; see ``search_by_codes``. With it, that share of the leaves is probed by their
    centroids, and all of their rows are ranked by their vectors.
    """
    _checked(k, candidates, measure)
    queries = checkpointed(queries.select(query.id, query.vector))  # used several times, embedded once
    if leaves_to_search is not None:
        return _probe_share(queries, index, k, measure, threshold, leaves_to_search, query, doc, broadcast_limit)
    return _Search(queries, index, k, measure, threshold, query, doc, candidates, True, broadcast_limit).run().found


def search_by_codes(queries: DataFrame, index: VectorIndex, k: int = TOP_K, measure: str = "dot", threshold: float | None = None,
                    candidates: int = CANDIDATES, query: VectorColumns = VectorColumns("query_id", "embedding"),
                    doc: VectorColumns = VectorColumns("doc_id", "embedding"), broadcast_limit: int = BROADCAST_LIMIT) -> Searched:
    """Candidates by codes, then their exact ranks.

    First the leaves of the nearest cells are looked at. The k-th distance among their candidates bounds the rest: every other
    leaf whose ball may hold something nearer is looked at too, so a row is only missed if its code misplaces it behind all
    candidates. Codes take a sixteenth of the vectors; those are read for candidates only.
    """
    _checked(k, candidates, measure)
    queries = checkpointed(queries.select(query.id, query.vector))
    return _Search(queries, index, k, measure, threshold, query, doc, candidates, True, broadcast_limit).run()


def search_within(queries: DataFrame, index: VectorIndex, k: int = TOP_K, measure: str = "dot", threshold: float | None = None,
                  query: VectorColumns = VectorColumns("query_id", "embedding"), doc: VectorColumns = VectorColumns("doc_id", "embedding"),
                  broadcast_limit: int = BROADCAST_LIMIT) -> Searched:
    """The exact k nearest rows, as ``nearest`` finds them, from those leaves that can hold them.

    The nearest cells come first; then each leaf whose ball reaches within the k-th distance found and the threshold. How many
    leaves were read is told for each query: few where vectors cluster or the threshold is narrow, all in the worst case.
    """
    _checked(k, k, measure)
    queries = checkpointed(queries.select(query.id, query.vector))
    return _Search(queries, index, k, measure, threshold, query, doc, k, False, broadcast_limit).run()
