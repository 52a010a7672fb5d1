"""Trip fares: features, filters, encodings and exploration."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ordered import percentiles_of_counts, value_counts_long
from tidemark.session import checkpointed

# Bounds of the validity and outlier filters.
FARE_RANGE = (2.5, 100.0)
FIRST_START = "2022-01-01"
MIN_TOTAL = 3.0
MAX_TOTAL = 3000.0
MAX_HOURS = 2.0
MAX_SPEED = 70.0
PAYMENT_CODES = {"Credit Card": 0, "Cash": 1}
WORKING_HOURS = (9, 17)
WHISKER = 1.5


def trip_features(trips: DataFrame, label: str = "target", first_start: str = FIRST_START,
                  fare_range: tuple[float, float] = FARE_RANGE) -> DataFrame:
    """Valid trips as training features: label, miles, seconds, hour, day of week (1 = Sunday), payment, company."""
    start = F.col("trip_start_timestamp")
    valid = trips.filter(
        (F.col("trip_miles") > 0) & (F.col("trip_seconds") > 0) & F.col("fare").between(*fare_range)
        & (start >= F.lit(first_start).cast(trips.schema["trip_start_timestamp"].dataType)))
    return valid.select(
        F.col("fare").alias(label), "trip_miles", "trip_seconds", F.hour(start).alias("trip_start_hour"),
        F.dayofweek(start).alias("trip_day_of_week"), "payment_type", "company")


def with_speed(trips: DataFrame) -> DataFrame:
    """Add trip_hours and trip_speed (miles per hour, null for a trip without duration)."""
    return (trips.withColumn("trip_hours", F.col("trip_seconds") / F.lit(3600.0))
            .withColumn("trip_speed", F.try_divide(F.col("trip_miles"), F.col("trip_hours"))))


def drop_outliers(trips: DataFrame, min_total: float = MIN_TOTAL, max_total: float = MAX_TOTAL,
                  max_hours: float = MAX_HOURS, max_speed: float = MAX_SPEED) -> DataFrame:
    """Trips with a plausible total, duration and speed. Rows without a speed are dropped too."""
    return with_speed(trips).filter(
        (F.col("trip_total") > min_total) & (F.col("trip_total") <= max_total)
        & (F.col("trip_hours") <= max_hours) & (F.col("trip_speed") <= max_speed))


def encode_trips(trips: DataFrame, working_hours: tuple[int, int] = WORKING_HOURS) -> DataFrame:
    """Keep card and cash trips; encode payment (0/1), weekday (1/0) and working hours (1/0)."""
    start = F.col("trip_start_timestamp")

    def flag(condition: Column) -> Column:
        return F.when(condition, F.lit(1)).otherwise(F.lit(0))

    code = None
    for name, number in PAYMENT_CODES.items():
        hit = F.col("payment_type") == name
        code = F.when(hit, F.lit(number)) if code is None else code.when(hit, F.lit(number))
    return (trips.filter(F.col("payment_type").isin(*PAYMENT_CODES))
            .withColumn("payment_code", code)
            .withColumn("weekday", flag(F.dayofweek(start).between(2, 6)))
            .withColumn("working_hours", flag(F.hour(start).between(*working_hours))))


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows (feature, level, n) per level of categorical columns, most frequent first."""
    long = df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot([], list(columns), "feature", "level")
    counted = long.filter(F.col("level").isNotNull()).groupBy("feature", "level").agg(F.count(F.lit(1)).alias("n"))
    return counted.orderBy("feature", F.desc("n"), "level")


def profile(df: DataFrame) -> DataFrame:
    """Rows (column, dtype, row_count, null_count, non_null_count): shape, types and nulls in one pass."""
    counts = df.agg(F.count(F.lit(1)).alias("_rows"),
                    *[F.count_if(F.col(c).isNull()).alias(f"_n{i}") for i, c in enumerate(df.columns)])
    rows = F.array(*[F.struct(F.lit(name).alias("column"), F.lit(dtype).alias("dtype"),
                              F.col("_rows").alias("row_count"), F.col(f"_n{i}").alias("null_count"),
                              (F.col("_rows") - F.col(f"_n{i}")).alias("non_null_count"))
                     for i, (name, dtype) in enumerate(df.dtypes)])
    return counts.select(F.inline(rows))


def histogram(df: DataFrame, columns: Sequence[str], bins: int = 10) -> DataFrame:
    """Equal-width histogram per column: (metric, bin from 1, lower, upper, n). The last bin includes its upper bound.

    The bounds are one row from a first pass over the columns; counting is a
    second pass with map-side aggregation.
    """
    casts = [F.col(c).cast("double").alias(c) for c in columns]
    bounds = df.select(*casts).agg(*[f(c).alias(f"{n}_{c}") for c in columns for n, f in (("min", F.min), ("max", F.max))]).first()
    long = df.select(*casts).unpivot([], list(columns), "metric", "value").filter(F.col("value").isNotNull())
    number, lower, upper = F.lit(None).cast("bigint"), F.lit(None).cast("double"), F.lit(None).cast("double")
    for c in columns:
        low, high = bounds[f"min_{c}"], bounds[f"max_{c}"]
        if low is None:
            continue
        mine = F.col("metric") == c
        width = high - low
        place = F.floor(F.lit(bins) * (F.col("value") - F.lit(low)) / F.lit(width)) if width > 0 else F.lit(0)
        number = F.when(mine, F.least(place + 1, F.lit(bins)).cast("bigint")).otherwise(number)
        lower, upper = F.when(mine, F.lit(low)).otherwise(lower), F.when(mine, F.lit(high)).otherwise(upper)
    counted = long.withColumn("bin", number).groupBy("metric", "bin").agg(F.count(F.lit(1)).alias("n"))
    width = (upper - lower) / F.lit(bins)
    return counted.select("metric", "bin", (lower + (F.col("bin") - 1) * width).alias("lower"),
                          (lower + F.col("bin") * width).alias("upper"), "n")


def box_plot(df: DataFrame, value: str, category: str | None = None, overall: str | None = "(all)") -> DataFrame:
    """Box-plot numbers per category and overall: quartiles, whiskers within 1.5 IQR and the outlier count.

    Everything is read from the table of distinct values and their counts, so hot
    categories are folded before any row moves; the overall row is added up from
    the same table.
    """
    if category is None and overall is None:
        raise ValueError("nothing to describe: give a category or a name for the overall row")
    named = df.select((F.col(category).cast("string") if category else F.lit(overall)).alias("category"), value)
    counts = value_counts_long(named, ["category"], [value])
    if category and overall:
        # One more row per value and category: the counting happens on the folded table.
        both = counts.withColumn("category", F.explode(F.array("category", F.lit(overall))))
        counts = both.groupBy("category", "metric", "value").agg(F.sum("n").alias("n"))
    counts = checkpointed(counts)
    quartiles = percentiles_of_counts(counts, ["category", "metric"], {"q1": 0.25, "median": 0.5, "q3": 0.75}, fixed=True)
    reach = F.lit(WHISKER) * (F.col("q3") - F.col("q1"))
    fences = quartiles.withColumn("_low", F.col("q1") - reach).withColumn("_high", F.col("q3") + reach)
    fences = fences.withColumnsRenamed({"category": "_category", "metric": "_metric"})
    joined = counts.join(fences, F.col("category").eqNullSafe(F.col("_category")))
    inside = F.col("value").between(F.col("_low"), F.col("_high"))
    return joined.groupBy("category").agg(
        F.sum("n").alias("n"), F.max("q1").alias("q1"), F.max("median").alias("median"), F.max("q3").alias("q3"),
        F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
        F.coalesce(F.sum(F.when(~inside, F.col("n"))), F.lit(0)).alias("outliers"))


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of each pair of numeric columns as rows (left, right, corr), in one pass.

    Rows with a null in either column do not count for that pair; a column
    without spread gives null.
    """
    pairs = list(combinations(columns, 2))
    numbers = df.select(*[F.col(c).cast("double").alias(c) for c in columns])

    def pearson(a: str, b: str) -> Column:
        x, y = F.when(F.col(b).isNotNull(), F.col(a)), F.when(F.col(a).isNotNull(), F.col(b))
        return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))

    one = numbers.agg(*[pearson(a, b).alias(f"_c{i}") for i, (a, b) in enumerate(pairs)])
    rows = F.array(*[F.struct(F.lit(a).alias("left"), F.lit(b).alias("right"), F.col(f"_c{i}").alias("corr"))
                     for i, (a, b) in enumerate(pairs)])
    return one.select(F.inline(rows))
