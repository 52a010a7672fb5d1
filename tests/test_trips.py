import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import models, trips
from tidemark.operators.ordered import exact_percentiles

SCHEMA = ("id int, fare double, trip_total double, trip_miles double, trip_seconds bigint, trip_start_timestamp timestamp_ntz, "
          "payment_type string, company string")
SUNDAY = dt.datetime(2022, 1, 2, 0, 30)


def trip(i, **over):
    base = {"fare": 10.0, "trip_total": 12.0, "trip_miles": 2.0, "trip_seconds": 600, "trip_start_timestamp": SUNDAY,
            "payment_type": "Cash", "company": "c"} | over
    return (i, *[base[c.split(" ")[0]] for c in SCHEMA.split(", ")[1:]])


def test_feature_bounds(fixed):
    cases = [({}, True), ({"fare": 2.49}, False), ({"fare": 2.5}, True), ({"fare": 100.0}, True), ({"fare": 100.01}, False),
             ({"trip_miles": 0.0}, False), ({"trip_seconds": 0}, False), ({"trip_start_timestamp": dt.datetime(2022, 1, 1)}, True),
             ({"trip_start_timestamp": dt.datetime(2021, 12, 31, 23, 59, 59)}, False), ({"fare": None}, False), ({"payment_type": None}, True)]
    df = fixed(SCHEMA, *[trip(i, **c) for i, (c, _) in enumerate(cases)])
    kept = trips.trip_features(df, label="fare_label")
    assert kept.count() == sum(ok for _, ok in cases)
    assert kept.columns == ["fare_label", "trip_miles", "trip_seconds", "trip_start_hour", "trip_day_of_week", "payment_type", "company"]
    row = trips.trip_features(fixed(SCHEMA, trip(0))).first()
    assert (row.trip_start_hour, row.trip_day_of_week) == (0, 1)


def test_filters_reach_the_scan(spark):
    from tidemark.plans.tables import table
    df = table(spark, "/root/testdata/sf0.001", "lineitem").select(
        F.col("l_extendedprice").alias("fare"), F.col("l_quantity").alias("trip_miles"), F.col("l_linenumber").alias("trip_seconds"),
        F.col("l_shipdate").alias("trip_start_timestamp"), F.col("l_returnflag").alias("payment_type"), F.col("l_linestatus").alias("company"))
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    plan = trips.trip_features(df)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(l_quantity,0.0)" in plan and "GreaterThanOrEqual(l_shipdate" in plan
    assert "l_tax" not in plan


def test_outliers(fixed):
    cases = [({}, True), ({"trip_total": 3.0}, False), ({"trip_total": 3000.01}, False), ({"trip_seconds": 7200}, True),
             ({"trip_seconds": 7201}, False), ({"trip_miles": 70.0, "trip_seconds": 3600}, True), ({"trip_miles": 70.1, "trip_seconds": 3600}, False),
             ({"trip_seconds": 0}, False), ({"trip_miles": None}, False)]
    df = fixed(SCHEMA, *[trip(i, **c) for i, (c, _) in enumerate(cases)])
    assert {r.id for r in trips.drop_outliers(df).collect()} == {i for i, (_, ok) in enumerate(cases) if ok}


def test_encoding(fixed):
    saturday, monday = dt.datetime(2022, 1, 8, 9), dt.datetime(2022, 1, 3, 17, 59)
    df = fixed(SCHEMA, trip(0), trip(1, payment_type="Credit Card", trip_start_timestamp=saturday),
               trip(2, trip_start_timestamp=monday), trip(3, payment_type="Mobile"), trip(4, payment_type=None))
    got = {r.id: (r.payment_code, r.weekday, r.working_hours) for r in trips.encode_trips(df).collect()}
    assert got == {0: (1, 0, 0), 1: (0, 0, 1), 2: (1, 1, 1)}


def test_exploration(fixed):
    values = [float(i) for i in range(20)] + [500.0]
    df = fixed(SCHEMA, *[trip(i, fare=v, payment_type="Cash" if i % 3 else "Credit Card", company=None if i == 0 else "c") for i, v in enumerate(values)])
    counts = [(r.feature, r.level, r.n) for r in trips.value_counts(df, ["payment_type", "company"]).collect()]
    assert counts == [("company", "c", 20), ("payment_type", "Cash", 14), ("payment_type", "Credit Card", 7)]
    shown = {r["column"]: r for r in trips.profile(df).collect()}
    assert shown["company"].null_count == 1 and shown["fare"].row_count == 21 and shown["fare"].dtype == "double"
    bars = {r.bin: r.n for r in trips.histogram(df, ["fare"], 10).collect()}
    want = np.histogram(values, 10)[0]
    assert bars == {i + 1: n for i, n in enumerate(want) if n}
    flat = trips.histogram(df, ["trip_miles"], 4).collect()
    assert [(r.bin, r.n) for r in flat] == [(1, 21)]
    boxes = {r.category: r for r in trips.box_plot(df, "fare", "payment_type").collect()}
    assert set(boxes) == {"Cash", "Credit Card", "(all)"}
    total = boxes["(all)"]
    assert (total.q1, total["median"], total.q3) == tuple(np.quantile(values, [0.25, 0.5, 0.75]))
    assert (total.whisker_low, total.whisker_high, total.outliers, total.n) == (0.0, 19.0, 1, 21)
    alone = trips.box_plot(df, "fare").collect()
    assert [tuple(r) for r in alone] == [tuple(total)]
    corr = trips.correlations(df.withColumn("twice", F.col("fare") * 2), ["fare", "twice", "trip_total"]).collect()
    assert {(r.left, r.right) for r in corr} == {("fare", "twice"), ("fare", "trip_total"), ("twice", "trip_total")}
    assert corr[0].corr == pytest.approx(1.0) and corr[1].corr is None


def test_samples_and_splits(spark):
    df = spark.range(5000).withColumnRenamed("id", "key")
    assert 150 < models.random_sample(df).count() < 350
    assert models.random_sample(df, 0.5, rows=10).count() == 10
    chosen = {r.key for r in models.hash_sample(df, "key").collect()}
    assert chosen == {r.key for r in models.hash_sample(df.repartition(3), "key").collect()} and 20 < len(chosen) < 90
    split = models.hash_split(df, "key").groupBy("split").count()
    sizes = {r.split: r["count"] for r in split.collect()}
    assert sum(sizes.values()) == 5000 and abs(sizes["train"] / 5000 - 0.8) < 0.03
    train, test = models.random_split(df, 75)
    assert train.count() + test.count() == 5000 and train.join(test, "key").count() == 0


def test_capped_samples_have_the_size_asked_for_and_are_even(spark):
    df = spark.range(0, 40_000, 1, 16).withColumn("part", F.spark_partition_id())
    sample = models.random_sample(df, 0.5, 4_000)
    per_part = {r.part: r["count"] for r in sample.groupBy("part").count().collect()}
    assert sum(per_part.values()) == 4_000 == sample.select("id").distinct().count()
    assert len(per_part) == 16 and all(abs(n - 250) < 5 * 250 ** 0.5 for n in per_part.values())
    assert 1_700 < models.random_sample(df, 0.05, 50_000).count() < 2_300  # the share is less than the cap
    assert models.random_sample(df, 1.0, 50_000).count() == 40_000 and models.random_sample(df.limit(0), 0.5, 5).count() == 0
    assert models.random_sample(df, 0.5, 0).count() == 0


@pytest.fixture(scope="module")
def fares(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(400):
        miles, seconds, pay = float(rng.uniform(0, 20)), float(rng.integers(60, 4000)), ("Cash", "Credit Card", "Mobile")[i % 3]
        rows.append((i, 3 + 2 * miles + 0.01 * seconds + (1.5 if pay == "Cash" else 0), miles, seconds, i % 24, i % 7 + 1, pay, f"c{i % 4}"))
    schema = "id int, target double, trip_miles double, trip_seconds double, trip_start_hour int, trip_day_of_week int, payment_type string, company string"
    return spark.createDataFrame(rows, schema)


def test_linear_model_recovers_the_tariff(spark, fares, tmp_path):
    model = models.fit_linear(fares)
    assert list(model.stages[-1].coefficients[:2]) == pytest.approx([2.0, 0.01], abs=1e-6)
    fit = models.regression_metrics(models.predict(model, fares)).first()
    assert fit.n == 400 and fit.rmse == pytest.approx(0, abs=1e-6) and fit.r2 == pytest.approx(1)
    instance = spark.createDataFrame([(5.2, 900.0, 14, 3, "Credit Card", "unseen")], "trip_miles double, trip_seconds double, trip_start_hour int, trip_day_of_week int, payment_type string, company string")
    models.save_model(model, str(tmp_path / "m"))
    assert models.predict(models.load_model(str(tmp_path / "m")), instance).first().prediction == pytest.approx(3 + 10.4 + 9.0, abs=1e-6)


def test_attributions_add_up(fares):
    model = models.fit_linear(fares)
    parts = models.linear_attributions(model, fares, "id").groupBy("id").agg(F.sum("attribution").alias("s"))
    predicted = models.predict(model, fares, ["id"])
    mean = predicted.agg(F.avg("prediction")).first()[0]
    worst = parts.join(predicted, "id").agg(F.max(F.abs(F.col("s") - (F.col("prediction") - mean)))).first()[0]
    assert worst < 1e-6


def test_boosted_trees_fit(fares):
    model = models.fit_boosted_trees(fares, trees=15, rate=0.3)
    assert models.regression_metrics(models.predict(model, fares)).first().r2 > 0.9
    assert "target" not in model.stages[-2].getInputCols()
    defaults = models.fit_boosted_trees.__defaults__
    assert (models.TREES, models.LEARNING_RATE, models.TREE_DEPTH) == (100, 0.1, 5) and 100 in defaults


def test_metrics_of_constant_label(fixed):
    row = models.regression_metrics(fixed("target double, prediction double", (1.0, 2.0), (1.0, 1.0))).first()
    assert row.rmse == pytest.approx(0.5 ** 0.5) and row.r2 is None


def test_percentile_helper_agrees_with_numpy(fares):
    row = exact_percentiles(fares, [], ["target"], {"p": 0.37}).first()
    assert row.p == pytest.approx(np.quantile([r.target for r in fares.select("target").collect()], 0.37))


def test_boosted_trees_pass_over_the_rows_in_as_many_tasks_as_there_are_cores(spark, monkeypatch):
    parts, rows = [], []

    class Watched(models.Pipeline):
        def fit(self, df):
            parts.append(df.rdd.getNumPartitions())
            rows.append(df.count())
            return super().fit(df)

    monkeypatch.setattr(models, "Pipeline", Watched)
    one = spark.range(0, 400, 1, 1).selectExpr("id % 20 AS x", "cast(id % 3 AS string) AS kind", "2.0 * (id % 20) AS y", "id AS unused")
    model = models.fit_boosted_trees(one, "y", ["x"], ["kind"], trees=2)
    assert parts == [spark.sparkContext.defaultParallelism] and parts[0] > 1 and rows == [400]
    assert models.predict(model, one).count() == 400
