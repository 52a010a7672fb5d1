"""Row-local similarity measures on two array columns, evaluated in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Results of the similarity function for unusable input.
EMPTY_SIMILARITY = -2.0
ZERO_NORM_SIMILARITY = 0.0


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def euclidean(a: Column, b: Column) -> Column:
    squares = F.zip_with(a, b, lambda x, y: F.pow(x.cast("double") - y.cast("double"), F.lit(2.0)))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda acc, x: acc + x))


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; -2 when a vector is missing or empty, 0 when one has no length."""
    def empty(v: Column) -> Column:
        return v.isNull() | (F.size(v) == 0)

    return (F.when(empty(a) | empty(b), F.lit(EMPTY_SIMILARITY))
            .when((norm(a) == 0) | (norm(b) == 0), F.lit(ZERO_NORM_SIMILARITY))
            .otherwise(dot(a, b) / (norm(a) * norm(b))))


def unit(a: Column) -> Column:
    """The vector scaled to length 1; a zero vector is returned as it is."""
    length = norm(a)
    return F.when(length > 0, F.transform(a, lambda x: (x / length).cast("float"))).otherwise(a)
