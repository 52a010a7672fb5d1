"""Retrieval-evaluation tables: aligned datasets, contexts and metric summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.prompts import decimals, question_prompt
from tidemark.functions.vectors import cosine

# Fixed value: rows kept as a sample of the metrics table.
SAMPLE_ROWS = 5


def evaluation_dataset(questions: DataFrame, contexts: DataFrame, answers: DataFrame,
                       validate: bool = True) -> DataFrame:
    """Align three (pos, value) tables by position into (pos, prompt, response).

    Questions and contexts are cut to the shorter of the two; the answers must then stand at the same
    positions, otherwise the call fails. Positions with gaps or repeats are told too, not dropped.
    """
    prompts = (questions.select("pos", F.col("value").alias("q"))
               .join(contexts.select("pos", F.col("value").alias("c")), "pos")
               .select("pos", question_prompt(F.col("q"), F.col("c")).alias("prompt")))
    if validate:
        paired, answered = min(questions.count(), contexts.count()), answers.count()
        met = prompts.join(answers.select("pos"), "pos").count()
        if not paired == answered == met:
            raise ValueError(f"{paired} prompts but {answered} answers, {met} of them at the same positions")
    return prompts.join(answers.select("pos", F.col("value").alias("response")), "pos")


def first_context(queries: DataFrame, contexts: DataFrame) -> DataFrame:
    """Best context per query, an empty text when there is none."""
    best = contexts.filter(F.col("rank") == 1).select("query_id", F.col("text").alias("context"))
    return queries.join(best, "query_id", "left").withColumn("context", F.coalesce("context", F.lit("")))


def joined_contexts(contexts: DataFrame) -> DataFrame:
    """All contexts of a query in rank order, joined by line breaks.

    Meant for retrieval output, which has at most k rows per query.
    """
    listed = contexts.groupBy("query_id").agg(F.sort_array(F.collect_list(F.struct("rank", "text"))).alias("_rows"))
    return listed.select("query_id", F.array_join(F.col("_rows.text"), "\n").alias("retrieved_context"))


def metric_summary(scores: DataFrame) -> DataFrame:
    """Mean and standard deviation per metric as rows (key, value), from (pos, metric, score)."""
    stats = scores.groupBy("metric").agg(F.avg("score").alias("mean"), F.stddev_samp("score").alias("std"))
    return stats.select(F.explode(F.create_map(
        F.concat("metric", F.lit("/mean")), F.col("mean"),
        F.concat("metric", F.lit("/std")), F.col("std"))).alias("key", "value"))


def shown_metrics(summary: DataFrame, part: str = "mean", places: int = 3) -> DataFrame:
    """The summary rows whose key contains a word, with the value as printed."""
    return summary.filter(F.contains("key", F.lit(part))).withColumn("shown", decimals(F.col("value"), places))


def evaluation_result(scores: DataFrame, experiment: str, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row: experiment, dataset size, summary metrics and the first rows of the metrics table."""
    by_metric = metric_summary(scores).agg(
        F.map_from_entries(F.collect_list(F.struct("key", "value"))).alias("summary_metrics"))
    size = scores.agg(F.countDistinct("pos").alias("dataset_size"))
    sample = (scores.orderBy("pos", "metric").limit(sample_rows)
              .agg(F.sort_array(F.collect_list(F.struct("pos", "metric", "score"))).alias("metrics_table_sample")))
    parts = [part.withColumn("_one", F.lit(1)) for part in (size, by_metric, sample)]
    joined = parts[0].join(parts[1], "_one").join(parts[2], "_one")
    return joined.select(F.lit(experiment).alias("experiment"), "dataset_size", "summary_metrics",
                         F.create_map().cast("map<string,string>").alias("metadata"), "metrics_table_sample")


def pair_similarity(vectors: DataFrame, pairs: DataFrame, key: str = "key", vector: str = "embedding") -> DataFrame:
    """Cosine similarity of named pairs: ``pairs`` has (left_key, right_key, label).

    A key without a vector counts as empty.
    """
    left = vectors.select(F.col(key).alias("left_key"), F.col(vector).alias("_left"))
    right = vectors.select(F.col(key).alias("right_key"), F.col(vector).alias("_right"))
    joined = pairs.join(left, "left_key", "left").join(right, "right_key", "left")
    return joined.select("left_key", "right_key", "label",
                         cosine(F.col("_left"), F.col("_right")).alias("similarity"))


def align_embeddings(keys: DataFrame, embeddings: DataFrame) -> DataFrame:
    """Sentence keys and their vectors by position: (pos, key) with (pos, embedding)."""
    return keys.join(embeddings, "pos").select("pos", "key", "embedding")
