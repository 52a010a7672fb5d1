"""The given tables, and views of them in the shapes the operators expect."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.readers import CUSTOMER_TYPE

OBJECT_PREFIX = "pictures/"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``part`` as raw catalog rows, with every kind of specification, image and price text."""
    kind, size, price = F.col("p_type"), F.col("p_size").cast("string"), F.col("p_retailprice")
    words = F.replace(F.col("p_name"), F.lit(" "), F.lit(" >> "))
    whole = F.floor(price).cast("bigint").cast("string")
    picture = F.concat(F.lit("http://img.example/"), F.col("p_partkey").cast("string"))
    pair = F.concat(F.lit('{"key"=>"Type", "value"=>"'), kind, F.lit('"}'))
    specs = (F.when(kind == "ECONOMY", F.concat(F.lit('{"product_specification"=>['), pair,
                                                F.lit(', {"value"=>"size '), size, F.lit('"}, {"key"=>"none"}]}')))
             .when(kind == "STANDARD", F.concat(F.lit('{"product_specification"=>'), pair, F.lit("}")))
             .when(kind == "PROMO", F.concat(F.lit("["), pair, F.lit("]")))
             .when(kind == "SMALL", F.concat(F.lit("{'product_specification'=>[{'key'=>'Size', 'value'=>'"), size, F.lit("'}]}")))
             .when(kind == "LARGE", F.concat(F.lit('{"product_specification"=>[{"key"=>"Size", "value"=>'), size, F.lit("}]}")))
             .otherwise(F.lit("nil")))
    tree = (F.when(kind == "SMALL", F.concat(kind, F.lit(" >> "), words))
            .when(kind == "LARGE", F.lit("[]"))
            .otherwise(F.concat(F.lit('["'), kind, F.lit(" >> "), F.col("p_brand"), F.lit(" >> "), words,
                                F.lit(' >> a, b >> c"]'))))
    image = (F.when(kind == "SMALL", F.concat(F.lit('"'), picture, F.lit('.jpg"')))
             .when(kind == "LARGE", picture)
             .otherwise(F.concat(F.lit('["'), picture, F.lit('-1.jpg", "'), picture, F.lit('-2.jpg"]'))))
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")
    return parts.select(
        F.col("p_partkey").cast("string").alias("uniq_id"), F.col("p_name").alias("product_name"),
        F.when(kind == "MEDIUM", F.lit("")).otherwise(F.col("p_brand")).alias("brand"),
        tree.alias("product_category_tree"),
        F.when(kind == "PROMO", F.lit("")).otherwise(F.concat(F.lit("  Size "), size, F.lit(". \n"))).alias("description"),
        specs.alias("product_specifications"),
        F.when(price == F.floor(price), whole).otherwise(F.format_string("%.2f", price)).alias("retail_price"),
        F.when(kind == "PROMO", F.lit("")).otherwise(F.concat(F.lit("0"), whole)).alias("discounted_price"),
        image.alias("image"),
        F.concat(F.lit("http://shop.example/"), F.col("p_partkey").cast("string")).alias("product_url"))


def documents_as_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` as files: (doc_id, source, file_uri, text)."""
    return table(spark, sf_dir, "documents").select("doc_id", "source", "text").select(
        "doc_id", "source",
        F.concat(F.lit("gs://"), "source", F.lit("/doc-"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("file_uri"),
        "text")


def image_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pages`` as an object listing; URLs with a fragment get an upper-case suffix."""
    path = F.regexp_replace(F.regexp_extract("url", r"^https?://[^/]+/([^?#]*)", 1), "/$", "")
    suffix = F.when(F.contains("url", F.lit("#")), F.lit(".JPG")).otherwise(F.lit(".jpg"))
    return table(spark, sf_dir, "pages").select(F.concat(F.lit(OBJECT_PREFIX), path, suffix).alias("path"))


def image_collection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``embeddings`` as image documents (id, embedding_field, path); label 9 has no path."""
    vec, label = F.col("vec_id").cast("string"), F.col("label")
    return table(spark, sf_dir, "embeddings").select(
        vec.alias("id"), F.col("embedding").alias("embedding_field"),
        F.when(label != 9, F.concat(F.lit("img/"), label.cast("string"), F.lit("/"), vec, F.lit(".jpg"))).alias("path"))


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as taxi trips."""
    k = F.get_json_object("props", "$.k").cast("int")
    kind = F.col("event_type")
    payment = (F.when(kind.isin("purchase", "view"), F.lit("Credit Card")).when(kind == "click", F.lit("Cash"))
               .when(kind == "signup", F.lit("Mobile")))
    events = table(spark, sf_dir, "events")
    return events.select(
        "event_id", F.col("value").alias("fare"), (F.col("value") + k * F.lit(0.25)).alias("trip_total"),
        (k / F.lit(4.0)).alias("trip_miles"), (F.col("user_id") * 60).alias("trip_seconds"),
        F.col("ts").alias("trip_start_timestamp"), payment.alias("payment_type"),
        F.concat(F.lit("company "), F.substring(F.col("user_id").cast("string"), -1, 1)).alias("company"),
        (F.col("user_id").cast("int") + 1).alias("pickup_community_area"), (k + 1).alias("dropoff_community_area"))


def priced_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips with a fare that follows distance and time, plus a remainder from the event value."""
    fare = F.lit(3.25) + F.col("trip_miles") * 1.8 + F.col("trip_seconds") * 0.004 + F.col("fare") * 0.02
    return trips(spark, sf_dir).withColumn("fare", fare)


def customer_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``customer`` as keyed customer records (pos, key, customer, fields)."""
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name"))
    number = F.substring_index("c_name", "#", -1)
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    c = customers.join(nation, "c_nationkey", "left")
    record = F.struct(
        F.col("c_custkey").alias("customer_id"), F.substring_index("c_name", "#", 1).alias("firstName"),
        F.concat(F.lit("No"), number).alias("lastName"),
        F.concat(F.lower("c_mktsegment"), F.lit("@mail.example")).alias("email"),
        F.concat(F.lit("+33-"), number).alias("phone"),
        F.struct(F.concat(number, F.lit(" Main Street")).alias("street"), F.initcap("c_mktsegment").alias("city"),
                 F.lit("").alias("state"), F.substring(number, -5, 5).alias("postalCode"),
                 F.col("n_name").alias("country")).alias("address"),
        (F.col("c_acctbal") > 0).alias("teletransmission"), (F.col("c_acctbal") > 5000).alias("surcomplementaire"),
        F.when(F.col("c_mktsegment") != "MACHINERY",
               F.date_add(F.lit("2020-01-01").cast("date"), F.col("c_nationkey")).cast("timestamp")).alias("MemberCardIssuanceDate"))
    text = F.to_json(record, {"ignoreNullFields": "false"})
    return c.select(F.col("c_custkey").alias("pos"), F.col("c_custkey").cast("string").alias("key"),
                    record.cast(CUSTOMER_TYPE).alias("customer"),
                    F.from_json(text, "map<string,variant>").alias("fields"))


def customer_patches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` as customer patches; pending orders aim at ids that do not exist."""
    status = F.col("o_orderstatus")
    patch = F.struct(
        F.lit(-1).alias("customer_id"), F.col("o_orderpriority").alias("lastPriority"),
        F.struct(F.col("o_orderpriority").alias("street")).alias("address"), F.lit(None).cast("string").alias("phone"))
    other = F.struct(F.col("o_orderkey").alias("lastOrder"), (F.col("o_totalprice") > 250000).alias("teletransmission"))
    options = {"ignoreNullFields": "false"}
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
                    "o_orderpriority")
    return orders.select(
        (F.col("o_custkey") + F.when(status == "P", F.lit(1_000_000_000)).otherwise(F.lit(0))).alias("customer_id"),
        F.when(status == "F", F.to_json(patch, options)).otherwise(F.to_json(other, options)).alias("patch"),
        F.col("o_orderdate").alias("event_ts"), F.col("o_orderkey").alias("event_no"))


def summary_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``conversations`` as summary tests: each user turn with the next turn (base) and the one after (tuned).

    Turns meet on (conv_id, turn), so a very long conversation is spread out.
    """
    turns = table(spark, sf_dir, "conversations")
    first = turns.filter(F.col("role") == "user")

    def later(step: int, role: str, name: str) -> DataFrame:
        return turns.filter(F.col("role") == role).select(
            "conv_id", (F.col("turn") - step).alias("turn"), F.col("text").alias(name))

    return (first.join(later(1, "assistant", "base"), ["conv_id", "turn"], "left")
            .join(later(2, "user", "tuned"), ["conv_id", "turn"], "left")
            .select(F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("pos"), F.col("text").alias("input_text"),
                    F.col("text").alias("output_text"), "base", "tuned"))


def label_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``labels`` as metric scores (pos, metric, score)."""
    return table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("pos"), F.col("quality").cast("double").alias("quality"),
        F.col("toxic").cast("double").alias("toxic")).unpivot(["pos"], ["quality", "toxic"], "metric", "score")


def positions(df: DataFrame, key: str, value: str) -> DataFrame:
    """A table as an aligned (pos, value) list."""
    return df.select(F.col(key).alias("pos"), F.col(value).alias("value"))
