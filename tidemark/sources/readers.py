"""Sources: CSV, JSONL, JSON arrays, keyed JSON objects, listings and text files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

CATALOG_COLUMNS = ("uniq_id", "product_name", "brand", "product_category_tree", "description",
                   "product_specifications", "retail_price", "discounted_price", "image", "product_url")
CHAT_SCHEMA = "messages array<struct<role:string,content:string>>"
CUSTOMER_TYPE = ("struct<customer_id:bigint,firstName:string,lastName:string,email:string,phone:string,"
                 "address:struct<street:string,city:string,state:string,postalCode:string,country:string>,"
                 "teletransmission:boolean,surcomplementaire:boolean,MemberCardIssuanceDate:timestamp>")


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def _csv(spark: SparkSession, path: str, names: tuple[str, ...]) -> DataFrame:
    schema = StructType([StructField(n, StringType()) for n in names])
    return (spark.read.schema(schema).option("header", True).option("multiLine", True)
            .option("quote", '"').option("escape", '"').option("encoding", "UTF-8")
            .option("enforceSchema", False).csv(path))


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """Catalog CSV; blanks are empty strings, not nulls.

    Quoted line breaks make a single file unsplittable: keep the files of a
    large catalog at some hundred MB each.
    """
    raw = _csv(spark, path, CATALOG_COLUMNS)
    return raw.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in CATALOG_COLUMNS])


def read_summary_tests(spark: SparkSession, path: str) -> DataFrame:
    """Summary test CSV with the columns input_text and output_text."""
    return _csv(spark, path, ("input_text", "output_text"))


def read_chat_samples(spark: SparkSession, path: str, keys: str = "") -> DataFrame:
    """One chat sample per JSONL line, with the key columns named in ``keys`` (a schema) if there are any."""
    return spark.read.schema(f"{keys}, {CHAT_SCHEMA}" if keys else CHAT_SCHEMA).json(path)


def read_json_array(spark: SparkSession, path: str, value: str = "value") -> DataFrame:
    """JSON arrays of strings as rows (pos, value): one file, or folders ``first=n`` named by the place of their first element."""
    text = spark.read.text(path, wholetext=True)
    first = F.col("first").cast("bigint") if "first" in text.columns else F.lit(0).cast("bigint")
    rows = text.select(first.alias("first"), F.posexplode(F.from_json("value", "array<string>")).alias("place", value))
    return rows.select((F.col("first") + F.col("place")).alias("pos"), value)


def read_keyed_customers(spark: SparkSession, path: str) -> DataFrame:
    """One JSON object keyed by string, as rows (pos, key, customer, fields).

    ``pos`` counts through all files in the order of their paths, and ``fields`` keeps every field as VARIANT
    for merge updates. A missing file gives an empty table.
    """
    if not path_exists(spark, path):
        return spark.createDataFrame(
            [], f"pos bigint, key string, customer {CUSTOMER_TYPE}, fields map<string,variant>")
    text = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
    sizes = text.select("file", F.size(F.from_json("value", "map<string,string>")).alias("n"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # one row a file
    offsets = sizes.select(F.col("file").alias("of_file"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    placed = text.join(F.broadcast(offsets), F.col("file") == F.col("of_file"))
    keyed = placed.select("offset", F.posexplode(F.from_json("value", "map<string,variant>")).alias("place", "key", "record"))
    keyed = keyed.select((F.col("offset") + F.col("place")).alias("pos"), "key", "record")
    record = F.to_json("record")
    return keyed.select("pos", "key", F.from_json(record, CUSTOMER_TYPE).alias("customer"),
                        F.from_json(record, "map<string,variant>").alias("fields"))


def list_objects(spark: SparkSession, path: str, glob: str = "*.jpg") -> DataFrame:
    """Paths of the files below a folder. File contents are not read."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", True)
            .option("pathGlobFilter", glob).load(path).select("path"))


def read_image_bytes(spark: SparkSession, path: str, glob: str = "*.jpg") -> DataFrame:
    """Image files as (path, content) for an image embedder."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", True)
            .option("pathGlobFilter", glob).load(path).select("path", "content"))


def read_text_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per text file: (file_uri, text)."""
    return spark.read.text(path, wholetext=True, recursiveFileLookup=True).select(
        F.col("_metadata.file_path").alias("file_uri"), F.col("value").alias("text"))


def read_upload_events(spark: SparkSession, path: str) -> DataFrame:
    """Upload notifications as a stream of envelopes, from JSON-lines files."""
    return spark.readStream.schema("message struct<data:string>").json(path)


def read_table(spark: SparkSession, name_or_path: str, predicate: Column | None = None) -> DataFrame:
    """A catalog table or a parquet path, with an optional pushed-down predicate."""
    is_path = "/" in name_or_path or name_or_path.endswith(".parquet")
    df = spark.read.parquet(name_or_path) if is_path else spark.table(name_or_path)
    return df if predicate is None else df.filter(predicate)
