"""A cleaning pipeline over ``documents``: each stage applies one operator to what the stage before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, exact, simhash, toxicity
from tidemark.llm.queries import byte_bpe_digests, table
from tidemark.llm.staging import numbered, small_batches, staged, without

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: The name of row numbers inside a stage.
NUMBER = "row_number"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain doesn't call toxic.

    Each row is judged by its own text, so rows with one id or with null id are told apart. Null and empty texts hold no
    feature and are judged by the models' constant parts. An empty table gives no rows, other columns are left out.
    """
    small_batches(spark)
    found = toxicity.classify(docs, table(spark, sf_dir, "labels"), keep=COLUMNS)
    return found.filter("not toxic").select(*COLUMNS)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts that are equal without white space: the longest, then the smallest id.

    A null id is larger than any other; of rows with the same id and text any one stays. Null, empty and blank texts are
    one group. An empty table gives no rows, other columns are left out.
    """
    found = exact.exact_duplicates(docs, carry=COLUMNS[1:])
    return found.filter("kept").select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the smallest id of each SimHash component at op8's settings. Most pairs with a five-word
    similarity of 0.8 differ in more bits and both stay: see the README for figures.

    Rows are numbered first, so those with one id or with null id are told apart; a null id is larger than any other, and
    of rows with one id the first numbered stays. Null and blank texts link like any other. Only the numbers of dropped
    rows move to the texts. An empty table gives no rows, other columns are left out.
    """
    small_batches(spark)
    rows = numbered(docs, COLUMNS, NUMBER, "near-rows")
    found = staged(simhash.near_duplicates(rows, id_col=NUMBER).select(NUMBER, "component_id"), "near-found")
    shared = found.groupBy("component_id").agg(F.count("*").alias("n")).filter("n > 1").select("component_id")
    member = found.join(shared, "component_id", "left_semi").join(rows.select(NUMBER, "doc_id"), NUMBER)
    member = staged(member.select("component_id", F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", NUMBER).alias("rank")), "near-members")
    stays = member.groupBy("component_id").agg(F.min("rank").alias("first")).select(F.col(f"first.{NUMBER}").alias(NUMBER))
    gone = staged(member.select(f"rank.{NUMBER}").join(stays, NUMBER, "left_anti"), "near-gone")
    return without(rows, gone, NUMBER).select(*COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a word inside a benchmark window.

    Rows are numbered first, so each is judged by its own text whatever ids repeat or are null. Null and empty texts have
    no words and stay. An empty table gives no rows, other columns are left out.
    """
    small_batches(spark)
    rows = numbered(docs, COLUMNS, NUMBER, "leak-rows")
    hits = decontaminate.benchmark_hits(rows, table(spark, sf_dir, "benchmark"), id_col=NUMBER)
    gone = staged(hits.filter("n_hit > 0").select(NUMBER), "leak-gone")
    return without(rows, gone, NUMBER).select(*COLUMNS)


def encode_bytes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Counts and digests of each row's byte-level tokens. Null text is empty; ids, null or repeated, are carried as they are."""
    small_batches(spark)
    return byte_bpe_digests(docs)


#: Stages that run Python hand it few rows at once, as the workers and the buffers of all stages add up in an executor.
STAGES = [("toxicity", drop_toxic), ("exact_dedup", drop_exact_copies), ("near_dedup", drop_near_copies),
          ("decontamination", drop_contaminated), ("byte_bpe", encode_bytes)]
#: The classifier, SimHash and BPE stages can't be written in SQL; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; each stage's result is written as Parquet and read back for the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
