"""A table in hash buckets whose changes rewrite touched buckets only, with commits that two writers can't break."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.sources.commits import TRIES, CommitLog, Conflict

BUCKETS = 64


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key.cast("string")), F.lit(buckets)).cast("int")


@dataclass(frozen=True)
class BucketedTable:
    """``key`` is an expression over the rows. A commit names the folder that holds each bucket: a change writes one new folder
    with the buckets it touches and commits a list in which the others keep theirs."""

    path: str
    key: str

    def log(self, spark: SparkSession) -> CommitLog:
        return CommitLog(spark, f"{self.path}/log")

    def _state(self, spark: SparkSession, version: int | None) -> tuple[int, dict]:
        log = self.log(spark)
        number, state = log.latest() if version is None else (version, log.read(version))
        if state is None:
            raise ValueError(f"no table at {self.path}")
        return number, state

    def _write(self, rows: DataFrame, buckets: int) -> tuple[str, set[int]]:
        """Write rows to a new folder that no commit names yet; returns it and the buckets that have rows."""
        folder = uuid.uuid4().hex
        own = rows.withColumn("bucket", bucket_of(F.expr(self.key), buckets))
        own.repartition("bucket").write.partitionBy("bucket").parquet(f"{self.path}/data/folder={folder}")
        written = rows.sparkSession.read.schema("bucket int").parquet(f"{self.path}/data/folder={folder}")
        return folder, {r["bucket"] for r in written.select("bucket").distinct().collect()}  # at most ``buckets``

    def create(self, rows: DataFrame, buckets: int = BUCKETS) -> int:
        """Write the first version; fails if there is a table already."""
        spark = rows.sparkSession
        folder, used = self._write(rows, buckets)
        state = {"count": buckets, "schema": rows.schema.json(), "folders": {str(b): folder for b in sorted(used)}}
        if self.log(spark).latest()[1] is not None or not self.log(spark).put(1, state):
            raise Conflict(f"there is a table at {self.path}")
        return 1

    def exists(self, spark: SparkSession) -> bool:
        return self.log(spark).latest()[1] is not None

    def read(self, spark: SparkSession, version: int | None = None, buckets: list[int] | None = None) -> DataFrame:
        """The rows of a version (the latest by default), or of some of its buckets; other buckets' files are not opened."""
        return self._rows(spark, self._state(spark, version)[1], buckets)

    def _rows(self, spark: SparkSession, state: dict, buckets: list[int] | None = None) -> DataFrame:
        schema = StructType.fromJson(json.loads(state["schema"]))
        chosen = state["folders"] if buckets is None else {str(b): state["folders"][str(b)] for b in buckets if str(b) in state["folders"]}
        if not chosen:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(*(f"{self.path}/data/folder={folder}/bucket={b}" for b, folder in sorted(chosen.items())))

    def touched(self, rows: DataFrame, key: str) -> list[int]:
        """The buckets that keys of other rows lie in: at most as many as there are buckets."""
        count = self._state(rows.sparkSession, None)[1]["count"]
        return sorted(r["b"] for r in rows.select(bucket_of(F.expr(key), count).alias("b")).distinct().collect())

    def change(self, spark: SparkSession, buckets: list[int], make: Callable[[DataFrame], DataFrame], tries: int = TRIES) -> int:
        """Replace the rows of some buckets by ``make(their rows)``; returns the version.

        ``make`` must keep rows in their buckets. If another writer changes one of these buckets meanwhile, the change is made
        again from the new rows; changes of other buckets are taken over.
        """
        log = self.log(spark)
        for _ in range(tries):
            number, seen = self._state(spark, None)
            if not buckets:
                return number
            folder, used = self._write(make(self._rows(spark, seen, buckets)), seen["count"])
            if not used <= set(buckets):
                raise ValueError("changed rows lie in other buckets than those they came from")

            def replace(state: dict | None) -> dict:
                if any(state["folders"].get(str(b)) != seen["folders"].get(str(b)) for b in buckets):
                    raise Conflict("these buckets were changed meanwhile")
                kept = {b: f for b, f in state["folders"].items() if int(b) not in set(buckets)}
                return state | {"folders": kept | {str(b): folder for b in sorted(used)}}

            try:
                return log.update(replace)[0]
            except Conflict:
                continue
        raise Conflict(f"buckets of {self.path} were changed {tries} times meanwhile")

    def remove_old(self, spark: SparkSession, keep: int = 1) -> list[str]:
        """Forget all versions but the last ``keep``, and remove the buckets' folders that only they named. Call it where nobody
        writes."""
        log, used = self.log(spark), {}
        log.expire(keep)
        for number in log.numbers():
            for b, folder in log.read(number)["folders"].items():
                used.setdefault(folder, set()).add(f"bucket={b}")
        gone = log.remove_folders(f"{self.path}/data", {f"folder={f}" for f in used})
        return gone + [f"{f}/{b}" for f, own in sorted(used.items()) for b in log.remove_folders(f"{self.path}/data/folder={f}", own)]
