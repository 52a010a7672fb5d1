"""Connected components by star contraction, with every round written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.staging import staged

#: A node with very many neighbours meets its smallest one in this many tasks.
SALTS = 16


def _least(links: DataFrame) -> DataFrame:
    """(u, v) links with the smallest of u and its neighbours added as ``low``; hubs are added up in the tasks first."""
    low = links.groupBy("u").agg(F.min("v").alias("low")).withColumn("low", F.least("u", "low"))
    sliced = low.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = links.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int"))
    return salted.join(sliced, ["u", "salt"]).select("u", "v", "low")


def _state(links: DataFrame) -> tuple:
    row = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node that has a link to another; root is the smallest node of its component.

    Each round hangs larger neighbours on a node's smallest one, then does the
    same among the smaller ones; the links end as stars. Null ends are ignored.
    The number of rounds grows with the logarithm of the longest chain.
    """
    pairs = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter(
        F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v")))
    now = staged(pairs.distinct(), "links")
    state = _state(now)
    while state[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _least(both).filter("v > u").select(F.col("v").alias("u"), F.col("low").alias("v")).filter("u != v").distinct()
        near = _least(large)
        small = near.select(F.col("v").alias("u"), F.col("low").alias("v")).unionByName(
            near.select("u", F.col("low").alias("v"))).filter("u != v").distinct()
        now = staged(small, "links")
        before, state = state, _state(now)
        if before == state:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
