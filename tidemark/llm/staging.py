"""Written tables between steps, and batches cut to a bounded size."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.memory import give_back, keep_little
from tidemark.session import scratch_path


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write a frame as Parquet to the shared folder and read it back.

    Cuts the lineage: a lost executor costs the tasks that ran there, not the
    steps before, and a frame that is read twice is computed once.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Give freed memory back to the system, large blocks at once and the rest when a task ends: its Python worker lives on,
    beside those of later stages."""
    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_little()
        yield from run(batches)
        gc.collect()
        give_back()
    return tidied


#: Rows that go to a Python worker at once. Spark's 10,000 documents of 3 to 4 KB fill buffers of 64 MB, on both sides.
ROWS_AT_ONCE = 1_000


def small_batches(spark: SparkSession) -> None:
    """From now on this session hands at most ROWS_AT_ONCE rows at once to Python workers; a lower setting stays."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name, "10000")) <= ROWS_AT_ONCE:
        spark.conf.set(name, str(ROWS_AT_ONCE))


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def id_and_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id bigint, text string): the names that operators use inside, whatever other columns exist."""
    return docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def text_column(batch: pa.RecordBatch, name: str = "text") -> pa.Array:
    """A text column with null as empty text."""
    return _filled(column(batch, name))


def _filled(column: pa.Array) -> pa.Array:
    if pa.types.is_null(column.type):
        column = column.cast(pa.string())
    return column.fill_null("")


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all rows, and where each row begins (one more entry than rows)."""
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind = np.int64 if wide else np.int32
    _, starts, data = column.buffers()
    if not len(column) or starts is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(starts, kind, len(column) + 1, column.offset * kind().itemsize).astype(np.int64)
    body = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return body[at[0]:at[-1]], at - at[0]


def pieces(batch: pa.RecordBatch, name: str = "text", most_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that no part holds more text than most_bytes, or a single row."""
    _, at = utf8(text_column(batch, name))
    low = 0
    while low < batch.num_rows:
        high = max(low + 1, int(np.searchsorted(at, at[low] + most_bytes, side="right")) - 1)
        yield batch.slice(low, high - low)
        low = high


def lists(values: np.ndarray, ends: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """Rows of lists, where ends[i] is the end of row i in values."""
    at = np.concatenate([[0], ends]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(values, kind))


#: A list of numbers is broadcast up to so many counted rows: 16 MB of numbers, some 64 MB in a join's table.
MOST_NUMBERS = 2_000_000


def numbered(df: DataFrame, columns: tuple[str, ...], name: str, label: str) -> DataFrame:
    """The columns with a number of its own for each row, whatever ids repeat or are null; written, so that numbers stay."""
    return staged(df.select(*columns, F.monotonically_increasing_id().alias(name)), label)


def without(rows: DataFrame, gone: DataFrame, name: str, most: int = MOST_NUMBERS) -> DataFrame:
    """Rows whose number isn't in ``gone`` (one column of that name, staged). Few numbers go to the rows, many are shuffled."""
    few = gone.limit(most + 1).count() <= most
    return rows.join(F.broadcast(gone) if few else gone, name, "left_anti")
