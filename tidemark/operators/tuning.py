"""Tuning data and summary evaluation: chat samples, length statistics, ROUGE, loss series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.rouge import METRICS, rouge
from tidemark.operators.ordered import exact_percentiles, previous_value

# Evaluation batch, characters per token, quartiles.
EVALUATION_ROWS = 100
CHARS_PER_TOKEN = 4
QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}


def to_contents(messages: Column) -> Column:
    """``{role, content}`` messages to ``{role, parts: [{text}]}``; roles are passed on as they are."""
    return F.transform(messages, lambda m: F.struct(
        m["role"].alias("role"), F.array(F.struct(m["content"].alias("text"))).alias("parts")))


def convert_samples(samples: DataFrame) -> DataFrame:
    """Chat samples to tuning samples, row by row: whole nested samples, or one turn a row with its keys.

    Turns need not be gathered, so a conversation of any length is converted where its rows are.
    """
    return samples.withColumn("contents", to_contents(F.col("messages"))).drop("messages")


def role_problems(turns: DataFrame) -> DataFrame:
    """Check the turn order (conv_id, turn, role): user and answer must alternate, a system turn may only lead."""
    seen = previous_value(turns.select("conv_id", "turn", "role"), ["conv_id"], ["turn"], "role", "prev_role")
    role, prev = F.col("role"), F.col("prev_role")
    problem = (F.when((role == "system") & prev.isNotNull(), F.lit("system turn after the start"))
               .when(role == prev, F.lit("repeated role"))
               .when((prev.isNull() | (prev == "system")) & ~role.isin("user", "system"),
                     F.lit("does not start with user")))
    return seen.withColumn("problem", problem)


def describe(df: DataFrame, columns: Sequence[str], drop_incomplete: bool = True,
             accuracy: int | None = None) -> DataFrame:
    """count, mean, sample std, min, quartiles and max per column, one row each.

    Rows with a null in any of the columns are dropped first. Quartiles are exact
    and interpolated, which needs a shuffle of the distinct values; with an
    ``accuracy`` they come from the approximate aggregate in the same single pass
    (rank error at most rows / accuracy).
    """
    whole = df.select(*columns)
    whole = whole.na.drop("any") if drop_incomplete else whole
    numbers = whole.select(*[F.col(c).cast("double").alias(c) for c in columns])
    measures = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    if accuracy:
        for name, p in QUARTILES.items():
            measures[name] = lambda c, p=p: F.percentile_approx(c, p, accuracy)
    one = numbers.agg(*[make(c).alias(f"{name}_{i}") for i, c in enumerate(columns) for name, make in measures.items()])
    rows = F.array(*[F.struct(F.lit(c).alias("metric"), *[F.col(f"{name}_{i}").alias(name) for name in measures])
                     for i, c in enumerate(columns)])
    stats = one.select(F.inline(rows))
    if not accuracy:
        stats = stats.join(exact_percentiles(whole, [], columns, QUARTILES), "metric", "left")
    return stats.select("metric", "count", "mean", "std", "min", *QUARTILES, "max")


def length_statistics(df: DataFrame, text: str = "output_text") -> DataFrame:
    """Statistics of the character length and the output token budget ceil(max / 4)."""
    lengths = df.select(F.length(text).alias("length"))
    return describe(lengths, ["length"]).withColumn(
        "token_budget", F.ceil(F.col("max") / F.lit(CHARS_PER_TOKEN)).cast("bigint"))


def answered(df: DataFrame, response: str = "response") -> Column:
    """True where the model gave a non-empty response."""
    return F.coalesce(F.length(response) > 0, F.lit(False))


def first_tests(tests: DataFrame, order: str = "pos", rows: int = EVALUATION_ROWS) -> DataFrame:
    """The evaluation batch: the first test records."""
    return tests.orderBy(order).limit(rows)


def evaluate_summaries(tests: DataFrame, responses: DataFrame, use_stemmer: bool = True) -> DataFrame:
    """Join tests (pos, input_text, output_text) with responses (pos, response) and score them.

    Blocked (missing or empty) responses are left out, as are tests without one.
    """
    joined = tests.join(responses.select("pos", F.col("response").alias("generated_summary")), "pos")
    kept = joined.filter(answered(joined, "generated_summary"))
    scored = kept.withColumn("_scores", rouge(F.col("output_text"), F.col("generated_summary"), use_stemmer))
    return scored.select("pos", F.col("input_text").alias("document"), F.col("output_text").alias("summary"),
                         "generated_summary", *[F.col(f"_scores.{m}").alias(m) for m in METRICS])


def evaluate_runs(pairs: DataFrame, runs: Sequence[str], use_stemmer: bool = True) -> DataFrame:
    """Score several response columns of one table in one pass: (pos, run, <metrics>).

    ``pairs`` has (pos, output_text) and a column for each run. Blocked responses are left out.
    """
    long = pairs.select("pos", "output_text", *runs).unpivot(["pos", "output_text"], list(runs), "run", "response")
    scored = long.filter(answered(long)).withColumn("_scores", rouge(F.col("output_text"), F.col("response"), use_stemmer))
    return scored.select("pos", "run", *[F.col(f"_scores.{m}").alias(m) for m in METRICS])


def blocked_responses(responses: DataFrame) -> DataFrame:
    """Count of blocked responses, the side output of an evaluation."""
    return responses.agg(F.count_if(~answered(responses)).alias("blocked"))


def improvement(base: DataFrame, tuned: DataFrame, metrics: Sequence[str] = ("rougeL_precision",)) -> DataFrame:
    """Mean of each metric before and after tuning and the change in percent (2 decimals).

    Both runs go through one aggregate; a zero base gives null.
    """
    return change_of_runs(base.select(F.lit("base").alias("run"), *metrics)
                          .unionByName(tuned.select(F.lit("tuned").alias("run"), *metrics)), metrics)


def change_of_runs(scored: DataFrame, metrics: Sequence[str] = ("rougeL_precision",)) -> DataFrame:
    """As ``improvement``, from one table of scores whose ``run`` is base or tuned."""
    long = scored.select("run", *metrics).na.drop("any").unpivot(["run"], list(metrics), "metric", "value")
    means = long.groupBy("metric").agg(
        F.avg(F.when(F.col("run") == "base", F.col("value"))).alias("base_mean"),
        F.avg(F.when(F.col("run") == "tuned", F.col("value"))).alias("tuned_mean"))
    change = F.try_divide(F.col("tuned_mean") - F.col("base_mean"), F.col("base_mean")) * 100
    return means.withColumn("improvement_pct", F.round(change, 2))


def metric_series(series: DataFrame, metric: str) -> DataFrame:
    """(step, value) of one metric in step order."""
    return series.filter(F.col("metric") == metric).select("step", "value").orderBy("step")


def metrics_by_step(series: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Several metrics side by side, one row per step; of repeated points the largest value is shown."""
    return series.groupBy("step").pivot("metric", list(metrics)).agg(F.max("value"))
