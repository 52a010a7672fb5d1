"""Sinks: JSONL, numbered batches, tables, versioned tables and small summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.catalog import number_batches
from tidemark.session import checkpointed
from tidemark.sources.commits import CommitLog


def write_jsonl(df: DataFrame, path: str) -> None:
    """JSON lines at a new path; an existing path is refused, so input is never overwritten."""
    df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value")).write.mode("error").text(path)


def write_numbered_batches(numbered: DataFrame, path: str) -> None:
    """JSONL files from rows that carry ``row_no`` and ``batch`` (see ``number_batches``).

    Batch n is the single file below ``batch=n``, in input order. Rows move once,
    to the task of their batch, and all batches but the last have the same size.
    Number the raw rows first and clean them afterwards: numbering reads its
    input twice, once to find the range bounds.
    """
    columns = [c for c in numbered.columns if c not in ("row_no", "batch")]
    lines = numbered.select("batch", "row_no", F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("value"))
    (lines.repartition(F.col("batch")).sortWithinPartitions("batch", "row_no").drop("row_no")
     .write.mode("error").partitionBy("batch").text(path))


def replace_table(df: DataFrame, table: str, path: str | None = None) -> None:
    """Create or replace a table from a query: managed, or external at a path."""
    writer = df.write.mode("overwrite")
    (writer.option("path", path) if path else writer).saveAsTable(table)


def append_valid(df: DataFrame, valid, path: str, errors_path: str, batch_id: int | None = None) -> None:
    """Append valid rows; rejected rows go to the errors path instead of stopping the run.

    The rows are staged once, so an embedder runs once a row and a row is in exactly one output. With a ``batch_id`` both
    outputs are keyed by it (a partition column of that name), and a repeated call replaces what it wrote before.
    """
    once = checkpointed(df.withColumn("_valid", F.coalesce(valid, F.lit(False))))
    for rows, target in ((once.filter("_valid"), path), (once.filter("not _valid"), errors_path)):
        writer = rows.drop("_valid").write
        if batch_id is None:
            writer.mode("append").parquet(target)
        else:
            writer.mode("overwrite").parquet(f"{target}/batch_id={batch_id}")


# Elements of one JSON array file.
ARRAY_ROWS = 10_000


def write_small_json(summary: DataFrame, path: str) -> None:
    """A one-row summary as a pretty JSON object in one file, non-ASCII kept as it is."""
    rows = summary.select(F.to_json(F.struct("*"), {"pretty": "true", "ignoreNullFields": "false"}).alias("value")).limit(1)
    rows.coalesce(1).write.mode("overwrite").text(path)


def write_json_array(df: DataFrame, order: str, value: str, path: str, file_rows: int = ARRAY_ROWS) -> None:
    """Texts in order as pretty JSON arrays of at most ``file_rows`` elements per file.

    An evaluation set of usual size is one array. A larger one goes to numbered
    folders named by the place of their first element (``first=n``, from 0), which ``read_json_array`` counts on from.
    """
    numbered = number_batches(df.select(order, value), [order], file_rows)
    listed = numbered.groupBy("batch").agg(F.sort_array(F.collect_list(F.struct("row_no", value))).alias("rows"))
    text = listed.select((F.col("rows")[0]["row_no"] - 1).alias("first"),
                         F.to_json(F.col("rows").getField(value), {"pretty": "true"}).alias("value"))
    text.repartition(F.col("first")).write.mode("error").partitionBy("first").text(path)


def _versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the finished versions below a path; a version counts once its _SUCCESS file exists."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/version=*/_SUCCESS")
    found = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(hadoop_path) or []
    return sorted(int(s.getPath().getParent().getName().split("=")[1]) for s in found)


def write_version(df: DataFrame, path: str) -> int:
    """Rewrite a whole table as a new version. Readers switch when the write has finished.

    The number is claimed in a commit log first, so two writers never write to one version.
    """
    spark = df.sparkSession

    def claim(state: dict | None) -> dict:
        return {"version": max((state or {"version": 0})["version"], (_versions(spark, path) or [0])[-1]) + 1}

    version = CommitLog(spark, f"{path}/_claims").update(claim)[1]["version"]
    df.write.mode("overwrite").parquet(f"{path}/version={version}")
    return version


def remove_versions(spark: SparkSession, path: str, keep: int = 1) -> list[int]:
    """Remove all finished versions but the last ``keep``; returns their numbers. Call it where nobody reads them."""
    versions = _versions(spark, path)
    kept = {f"version={v}" for v in versions[-keep:]}
    unfinished = max(versions, default=0)
    CommitLog(spark, f"{path}/_claims").remove_folders(path, kept | {"_claims"} | {f"version={v}" for v in range(unfinished + 1, unfinished + 1000)})
    return versions[:-keep]


def has_version(spark: SparkSession, path: str) -> bool:
    return bool(_versions(spark, path))


def read_version(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The latest finished version of a table, or the one asked for."""
    return spark.read.parquet(f"{path}/version={version or _versions(spark, path)[-1]}")
