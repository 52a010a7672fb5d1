"""Queries over trips: features, exploration, sampling, regression."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import boosting, models, trips
from tidemark.operators.tuning import describe
from tidemark.plans.tables import priced_trips, table, trips as trip_table
from tidemark.session import scratch_path
from tidemark.sources.writers import replace_table

NUMBERS = ("fare", "trip_total", "trip_miles", "trip_seconds")
LEVELS = ("payment_type", "pickup_community_area", "dropoff_community_area")
ITEM_NUMBERS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
BINS = 10
CHECK_TREES = 100
#: Fewer, larger steps: each level of a tree is a Spark job.
SECOND_ORDER_TREES, SECOND_ORDER_RATE = 12, 0.4
#: Rows of the capped sample.
CAPPED_ROWS = 200
LEAST_R2 = 0.9
FEATURE_TABLE = "tidemark_trip_features"


def _round(df, *columns):
    for c in columns:
        df = df.withColumn(c, F.round(c, 6))
    return df


def trip_features(spark, sf_dir):
    return _round(trips.trip_features(trip_table(spark, sf_dir)), "target")


def trip_feature_table(spark, sf_dir):
    """The feature table written with create-or-replace, summed up per hour."""
    replace_table(trips.trip_features(trip_table(spark, sf_dir)), FEATURE_TABLE, scratch_path(spark, "features"))
    return spark.table(FEATURE_TABLE).groupBy("trip_start_hour").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("target"), 6).alias("avg_target"))


def trip_outliers(spark, sf_dir):
    kept = trips.drop_outliers(trip_table(spark, sf_dir))
    return _round(kept.select("event_id", "trip_total", "trip_hours", "trip_speed"), "trip_total", "trip_hours", "trip_speed")


def trip_encode(spark, sf_dir):
    return trips.encode_trips(trip_table(spark, sf_dir)).select("event_id", "payment_code", "weekday", "working_hours")


def trip_value_counts(spark, sf_dir):
    return trips.value_counts(trip_table(spark, sf_dir), LEVELS)


def trip_profile(spark, sf_dir):
    return trips.profile(trip_table(spark, sf_dir))


def trip_describe(spark, sf_dir):
    return _round(describe(trip_table(spark, sf_dir), NUMBERS), "mean", "std", "min", "p25", "p50", "p75", "max")


def trip_histogram(spark, sf_dir):
    return _round(trips.histogram(table(spark, sf_dir, "lineitem"), ITEM_NUMBERS, BINS), "lower", "upper")


def trip_boxplot(spark, sf_dir):
    boxes = trips.box_plot(table(spark, sf_dir, "lineitem"), "l_extendedprice", "l_returnflag")
    return _round(boxes, "q1", "median", "q3", "whisker_low", "whisker_high")


def trip_corr(spark, sf_dir):
    return _round(trips.correlations(priced_trips(spark, sf_dir), NUMBERS), "corr")


def sample_random(spark, sf_dir):
    """What can be said of a random sample: its rows are the table's, once each, and about as many as asked for."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    sample = models.random_sample(orders, rows=None).withColumn("sampled", F.lit(1))
    met = orders.join(sample, ["o_orderkey", "o_totalprice"], "full")
    share = F.sum("sampled") / F.count("*")
    return met.agg(F.count("*").alias("rows"), F.abs(share - models.SAMPLE_SHARE).alias("off")).select(
        "rows", (F.col("off") < models.SAMPLE_SHARE / 4).alias("share_holds"))


def sample_capped(spark, sf_dir):
    """What can be said of a capped sample: exactly as many rows as the cap, the table's own, and as many from its first half as
    from its second, give or take five standard deviations."""
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    sample = models.random_sample(items, rows=CAPPED_ROWS)
    half = items.agg(F.percentile_approx("l_orderkey", 0.5)).first()[0]
    own = sample.join(items, ["l_orderkey", "l_linenumber"], "left_semi").distinct()
    return own.agg(F.count("*").alias("rows"), F.count_if(F.col("l_orderkey") <= half).alias("low")).select(
        "rows", (F.abs(F.col("low") - CAPPED_ROWS / 2) < 5 * CAPPED_ROWS ** 0.5 / 2).alias("even"))


def sample_hash(spark, sf_dir):
    return models.hash_sample(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey")


def split_hash(spark, sf_dir):
    return models.hash_split(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey")


def _split_trips(spark, sf_dir, percent, source=None):
    """Valid priced trips with their split; the features keep the trip key."""
    source = priced_trips(spark, sf_dir) if source is None else source
    valid = source.filter((F.col("trip_miles") > 0) & (F.col("trip_seconds") > 0) & F.col("payment_type").isNotNull())
    start = F.col("trip_start_timestamp")
    shaped = valid.select(
        "event_id", F.col("fare").alias("target"), "trip_miles", F.col("trip_seconds").cast("double").alias("trip_seconds"),
        F.hour(start).alias("trip_start_hour"), F.dayofweek(start).alias("trip_day_of_week"), "payment_type", "company")
    return models.hash_split(shaped, "event_id", percent)


def fare_linear(spark, sf_dir):
    """One-feature least squares: slope, intercept and fit on the training part."""
    train = _split_trips(spark, sf_dir, models.LINEAR_TRAIN_PERCENT).filter("split = 'train'")
    model = models.fit_linear(train, numeric=["trip_miles"], categorical=[])
    line = model.stages[-1]
    fit = models.regression_metrics(models.predict(model, train))
    return fit.select("n", F.round("rmse", 6).alias("rmse"), F.round("r2", 6).alias("r2"),
                      F.round(F.lit(float(line.coefficients[0])), 6).alias("slope"),
                      F.round(F.lit(float(line.intercept)), 6).alias("intercept"))


def regression_metrics(spark, sf_dir):
    """RMSE and R² of a plain distance rule, per split."""
    scored = _split_trips(spark, sf_dir, models.TRAIN_PERCENT).withColumn(
        "prediction", F.lit(3.0) + F.col("trip_miles") * 2.0)
    return _round(models.regression_metrics(scored, group=["split"]), "rmse", "r2")


def fare_model(spark, sf_dir):
    """All-feature least squares, scored on both parts; the made-up tariff is nearly linear, so it must fit."""
    rows = _split_trips(spark, sf_dir, models.LINEAR_TRAIN_PERCENT)
    model = models.fit_linear(rows.filter("split = 'train'"))
    return _fits(models.predict(model, rows))


def _fits(scored):
    """Rows of each split and whether the model explains nine tenths of the variance."""
    return models.regression_metrics(scored, group=["split"]).select("split", "n", (F.col("r2") > LEAST_R2).alias("fits"))


def fare_gbt(spark, sf_dir):
    """Boosted trees, saved, loaded again and scored on both parts."""
    rows = _split_trips(spark, sf_dir, models.TRAIN_PERCENT)
    path = scratch_path(spark, "fare-model")
    models.save_model(models.fit_boosted_trees(rows.filter("split = 'train'"), trees=CHECK_TREES), path)
    return _fits(models.predict(models.load_model(path), rows))


def fare_second_order(spark, sf_dir):
    """Second-order trees, saved, loaded again and scored on both parts; the attributions of every trip must add up to its
    prediction less the expected value."""
    rows = _split_trips(spark, sf_dir, models.TRAIN_PERCENT)
    path = scratch_path(spark, "fare-trees")
    boosting.save_trees(spark, boosting.fit_second_order_trees(rows.filter("split = 'train'"), trees=SECOND_ORDER_TREES, rate=SECOND_ORDER_RATE), path)
    model = boosting.load_trees(spark, path)
    scored = boosting.predict_trees(model, rows, ["event_id", "split", "target"])
    parts = boosting.tree_attributions(model, rows, ["event_id"])
    moved = sum((F.col(c) for c in parts.columns if c.startswith("by_")), F.lit(boosting.expected_value(model)))
    met = scored.join(parts.select("event_id", moved.alias("moved")), "event_id")
    checked = met.groupBy("split").agg((F.max(F.abs(F.col("moved") - F.col("prediction"))) < 1e-6).alias("adds_up"))
    return _fits(scored).join(checked, "split")


def _tariff_trips(spark, sf_dir):
    """Trips whose fare follows distance, time and payment exactly, so the right predictions are known."""
    fare = (F.lit(3.25) + F.col("trip_miles") * 1.8 + F.col("trip_seconds") * 0.004
            + F.when(F.col("payment_type") == "Credit Card", F.lit(0.75)).otherwise(F.lit(0.0)))
    return _split_trips(spark, sf_dir, models.TRAIN_PERCENT, trip_table(spark, sf_dir).withColumn("fare", fare))


def fare_predict(spark, sf_dir):
    """Least squares on the training part, then batch prediction for all trips."""
    rows = _tariff_trips(spark, sf_dir)
    model = models.fit_linear(rows.filter("split = 'train'"))
    return models.predict(model, rows, ["event_id", "split"]).withColumn("prediction", F.round("prediction", 4))


def fare_attributions(spark, sf_dir):
    """Attributions of distance, time and payment for all trips, against the training part's means."""
    rows = _tariff_trips(spark, sf_dir).withColumn("card", (F.col("payment_type") == "Credit Card").cast("int"))
    train = rows.filter("split = 'train'")
    model = models.fit_linear(train, numeric=["trip_miles", "trip_seconds", "card"], categorical=[])
    return models.linear_attributions(model, rows, "event_id", baseline=train).withColumn("attribution", F.round("attribution", 4))


QUERIES = {f.__name__: f for f in (
    trip_features, trip_feature_table, trip_outliers, trip_encode, trip_value_counts, trip_profile, trip_describe,
    trip_histogram, trip_boxplot, trip_corr, sample_random, sample_capped, sample_hash, split_hash, fare_linear, regression_metrics,
    fare_model, fare_gbt, fare_second_order, fare_predict, fare_attributions)}

_TRIPS = """
    t AS (SELECT event_id, value AS fare, value + k * 0.25 AS trip_total, k / 4.0::double AS trip_miles, user_id * 60 AS trip_seconds,
                 ts, CASE WHEN event_type IN ('purchase', 'view') THEN 'Credit Card' WHEN event_type = 'click' THEN 'Cash'
                          WHEN event_type = 'signup' THEN 'Mobile' END AS payment_type,
                 'company ' || right(user_id::varchar, 1) AS company, user_id + 1 AS pickup, k + 1 AS dropoff
          FROM (SELECT *, regexp_extract(props, '[0-9]+')::int AS k FROM events))"""
_BUCKET = "(('0x' || substr(md5({key}::varchar), 1, 8))::ubigint % 100)"
_FEATURES = """
    f AS (SELECT fare AS target, trip_miles, trip_seconds, hour(ts)::int AS trip_start_hour,
                 (dayofweek(ts) + 1)::int AS trip_day_of_week, payment_type, company
          FROM t WHERE trip_miles > 0 AND trip_seconds > 0 AND fare BETWEEN 2.5 AND 100 AND ts >= TIMESTAMP '2022-01-01')"""


def _priced(percent: int) -> str:
    return f"""{_TRIPS},
    x AS (SELECT event_id, 3.25 + trip_miles * 1.8 + trip_seconds * 0.004 + fare * 0.02 AS target, trip_miles, trip_seconds,
                 CASE WHEN {_BUCKET.format(key='event_id')} < {percent} THEN 'train' ELSE 'test' END AS split
          FROM t WHERE trip_miles > 0 AND trip_seconds > 0 AND payment_type IS NOT NULL)"""


def _box(source: str, name: str) -> str:
    return f"""SELECT {name} AS category, count(*) AS n, any_value(q1) AS q1, any_value(median) AS median, any_value(q3) AS q3,
        min(v) FILTER (v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_low,
        max(v) FILTER (v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_high,
        count(*) FILTER (v NOT BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS outliers
        FROM {source} GROUP BY ALL"""


_QUARTILES = ", ".join(f"quantile_cont(l_extendedprice, {p}) AS {n}" for n, p in (("q1", 0.25), ("median", 0.5), ("q3", 0.75)))
_SOURCE = {"trip_start_timestamp": "ts", "pickup_community_area": "pickup", "dropoff_community_area": "dropoff"}
_TYPES = (("event_id", "bigint"), ("fare", "double"), ("trip_total", "double"), ("trip_miles", "double"), ("trip_seconds", "bigint"),
          ("trip_start_timestamp", "timestamp_ntz"), ("payment_type", "string"), ("company", "string"), ("pickup_community_area", "int"), ("dropoff_community_area", "int"))

SQL = {
    "trip_features": f"WITH {_TRIPS}, {_FEATURES} SELECT * REPLACE (round(target, 6) AS target) FROM f",
    "trip_feature_table": f"""WITH {_TRIPS}, {_FEATURES}
        SELECT trip_start_hour, count(*) AS n, round(avg(target), 6) AS avg_target FROM f GROUP BY 1""",
    "trip_outliers": f"""WITH {_TRIPS}, s AS (
            SELECT *, trip_seconds / 3600.0::double AS trip_hours FROM t),
        v AS (SELECT *, CASE WHEN trip_hours <> 0 THEN trip_miles / trip_hours END AS trip_speed FROM s)
        SELECT event_id, round(trip_total, 6) AS trip_total, round(trip_hours, 6) AS trip_hours, round(trip_speed, 6) AS trip_speed
        FROM v WHERE trip_total > 3 AND trip_total <= 3000 AND trip_hours <= 2 AND trip_speed <= 70""",
    "trip_encode": f"""WITH {_TRIPS}
        SELECT event_id, CASE payment_type WHEN 'Credit Card' THEN 0 ELSE 1 END AS payment_code,
               CASE WHEN dayofweek(ts) BETWEEN 1 AND 5 THEN 1 ELSE 0 END AS weekday,
               CASE WHEN hour(ts) BETWEEN 9 AND 17 THEN 1 ELSE 0 END AS working_hours
        FROM t WHERE payment_type IN ('Credit Card', 'Cash')""",
    "trip_value_counts": f"""WITH {_TRIPS}
        SELECT 'payment_type' AS feature, payment_type AS level, count(*) AS n FROM t WHERE payment_type IS NOT NULL GROUP BY ALL
        UNION ALL SELECT 'pickup_community_area', pickup::varchar, count(*) FROM t GROUP BY ALL
        UNION ALL SELECT 'dropoff_community_area', dropoff::varchar, count(*) FROM t GROUP BY ALL""",
    "trip_profile": f"WITH {_TRIPS} " + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", '{d}' AS dtype, count(*) AS row_count,
            count(*) - count({_SOURCE.get(c, c)}) AS null_count,
            count({_SOURCE.get(c, c)}) AS non_null_count FROM t""" for c, d in _TYPES),
    "trip_describe": f"WITH {_TRIPS} " + " UNION ALL ".join(f"""
        SELECT '{c}' AS metric, count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std,
               round(min({c})::double, 6) AS min, round(quantile_cont({c}, 0.25)::double, 6) AS p25,
               round(quantile_cont({c}, 0.5)::double, 6) AS p50, round(quantile_cont({c}, 0.75)::double, 6) AS p75,
               round(max({c})::double, 6) AS max FROM t""" for c in NUMBERS),
    "trip_histogram": " UNION ALL ".join(f"""
        SELECT '{c}' AS metric, bin, round(lo + (bin - 1) * ((hi - lo) / {BINS}), 6) AS lower,
               round(lo + bin * ((hi - lo) / {BINS}), 6) AS upper, count(*) AS n
        FROM (SELECT lo, hi, least(floor({BINS} * ({c} - lo) / (hi - lo)) + 1, {BINS})::bigint AS bin
              FROM lineitem, (SELECT min({c}) AS lo, max({c}) AS hi FROM lineitem)) GROUP BY ALL""" for c in ITEM_NUMBERS),
    "trip_boxplot": f"""
        WITH q AS (SELECT l_returnflag AS f, {_QUARTILES} FROM lineitem GROUP BY 1),
             a AS (SELECT {_QUARTILES} FROM lineitem),
             b AS (SELECT f, l_extendedprice AS v, q1, median, q3 FROM lineitem JOIN q ON f = l_returnflag),
             c AS (SELECT '(all)' AS f, l_extendedprice AS v, q1, median, q3 FROM lineitem, a),
             u AS ({_box('b', 'f')} UNION ALL {_box('c', 'f')})
        SELECT category, n, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
               round(whisker_low, 6) AS whisker_low, round(whisker_high, 6) AS whisker_high, outliers FROM u""",
    "trip_corr": f"""WITH {_TRIPS},
        y AS (SELECT 3.25 + trip_miles * 1.8 + trip_seconds * 0.004 + fare * 0.02 AS fare, trip_total, trip_miles, trip_seconds FROM t) """
        + " UNION ALL ".join(f"SELECT '{a}' AS \"left\", '{b}' AS \"right\", round(corr({a}, {b}), 6) AS corr FROM y"
                             for i, a in enumerate(NUMBERS) for b in NUMBERS[i + 1:]),
    "sample_hash": f"SELECT o_orderkey FROM orders WHERE {_BUCKET.format(key='o_orderkey')} = 1",
    "split_hash": f"""SELECT o_orderkey, CASE WHEN {_BUCKET.format(key='o_orderkey')} < 80 THEN 'train' ELSE 'test' END AS split
        FROM orders""",
    "fare_linear": f"""WITH {_priced(75)},
        p AS (SELECT regr_slope(target, trip_miles) AS s, regr_intercept(target, trip_miles) AS i FROM x WHERE split = 'train')
        SELECT count(*) AS n, round(sqrt(avg(pow(target - s * trip_miles - i, 2))), 6) AS rmse,
               round(regr_r2(target, trip_miles), 6) AS r2, round(any_value(s), 6) AS slope, round(any_value(i), 6) AS intercept
        FROM x, p WHERE split = 'train'""",
    "fare_predict": f"""WITH {_priced(80)}
        SELECT x.event_id, split, round(3.25 + x.trip_miles * 1.8 + x.trip_seconds * 0.004
               + CASE WHEN payment_type = 'Credit Card' THEN 0.75 ELSE 0 END, 4) AS prediction
        FROM x JOIN t USING (event_id)""",
    "fare_attributions": f"""WITH {_priced(80)},
        v AS (SELECT x.event_id, split, x.trip_miles AS m, x.trip_seconds AS s, (payment_type = 'Credit Card')::int AS c FROM x JOIN t USING (event_id)),
        a AS (SELECT avg(m) AS am, avg(s) AS ars, avg(c) AS ac FROM v WHERE split = 'train')
        SELECT event_id, 0 AS feature_no, round(1.8 * (m - am), 4) AS attribution FROM v, a
        UNION ALL SELECT event_id, 1, round(0.004 * (s - ars), 4) FROM v, a
        UNION ALL SELECT event_id, 2, round(0.75 * (c - ac), 4) FROM v, a""",
    "fare_model": f"WITH {_priced(75)} SELECT split, count(*) AS n, true AS fits FROM x GROUP BY split",
    "fare_gbt": f"WITH {_priced(80)} SELECT split, count(*) AS n, true AS fits FROM x GROUP BY split",
    "fare_second_order": f"WITH {_priced(80)} SELECT split, count(*) AS n, true AS fits, true AS adds_up FROM x GROUP BY split",
    "sample_capped": f"""SELECT least(count(*), {CAPPED_ROWS}) AS rows, true AS even
        FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)""",
    "sample_random": "SELECT count(*) AS rows, true AS share_holds FROM orders",
    "regression_metrics": f"""WITH {_priced(80)}
        SELECT split, count(*) AS n, round(sqrt(avg(pow(target - 3 - 2 * trip_miles, 2))), 6) AS rmse,
               round(1 - avg(pow(target - 3 - 2 * trip_miles, 2)) / var_pop(target), 6) AS r2 FROM x GROUP BY split""",
}
