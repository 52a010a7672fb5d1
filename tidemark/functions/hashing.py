"""Repeatable sampling buckets that do not depend on partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def bucket(key: Column, buckets: int = 100) -> Column:
    """Bucket number from the first 8 hex digits of the key's MD5 digest."""
    return (F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("bigint") % buckets).cast("bigint")
