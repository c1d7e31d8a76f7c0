"""Readers with fixed schemas, for tables and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner.operators.numbering import numbered
from gleaner.sources.writers import ORDER

REVIEW = T.StructType([
    T.StructField("review_id", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("business_id", T.StringType()),
    T.StructField("stars", T.DoubleType()),
    T.StructField("date", T.StringType()),
    T.StructField("text", T.StringType()),
])
BUSINESS = T.StructType([
    T.StructField("business_id", T.StringType()),
    T.StructField("categories", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("city", T.StringType()),
])
PAIR = T.StructType([T.StructField("user_id", T.StringType()), T.StructField("business_id", T.StringType())])
ITEM_MODEL = T.StructType([
    T.StructField("b1", T.StringType()), T.StructField("b2", T.StringType()), T.StructField("sim", T.DoubleType())
])
USER_MODEL = T.StructType([
    T.StructField("u1", T.StringType()), T.StructField("u2", T.StringType()), T.StructField("sim", T.DoubleType())
])
PROFILE = T.StructType([
    T.StructField("description", T.StringType()),
    T.StructField("id", T.StringType()),
    T.StructField("profile", T.ArrayType(T.LongType())),
])
MESSAGE = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()),
    T.StructField("hashtags", T.ArrayType(T.StructType([T.StructField("text", T.StringType())]))),
])
CITY = T.StructType([T.StructField("ts", T.TimestampType()), T.StructField("city", T.StringType())])
DATE_FORMAT = "yyyy-MM-dd HH:mm:ss"


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_reviews(spark: SparkSession, path: str) -> DataFrame:
    """Reviews with the date as a timestamp; a date of another form becomes null."""
    return read_json_lines(spark, path, REVIEW).withColumn("date", F.try_to_timestamp("date", F.lit(DATE_FORMAT)))


def read_business(spark: SparkSession, path: str) -> DataFrame:
    return read_json_lines(spark, path, BUSINESS)


def read_pairs(spark: SparkSession, path: str) -> DataFrame:
    """User-item pairs; the first line of every file is its header."""
    return spark.read.option("header", True).schema(PAIR).csv(path)


def read_stopwords(spark: SparkSession, path: str) -> DataFrame:
    """``word``, one row per distinct word of a white-space separated list."""
    found = spark.read.text(path).select(F.explode(F.split(F.trim("value"), r"\s+")).alias("word"))
    return found.filter(F.col("word") != "").distinct()


def read_baskets(spark: SparkSession, path: str) -> DataFrame:
    """``basket_id, item``, distinct, from one white-space separated basket per line.

    A basket id is the file and the line's place in it, given before any shuffle. No two lines share one, so equal items
    are found within the line.
    """
    lines = spark.read.text(path).select(
        F.concat_ws("#", F.input_file_name(), F.monotonically_increasing_id()).alias("basket_id"), "value"
    )
    items = lines.select("basket_id", F.explode(F.array_distinct(F.split(F.trim("value"), r"\s+"))).alias("item"))
    return items.filter(F.col("item") != "")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, text``: one row per line of plain-text files, so that a long file is split over tasks."""
    return spark.read.text(path).select(F.input_file_name().alias("doc_id"), F.col("value").alias("text"))


def read_ordered(spark: SparkSession, path: str) -> DataFrame:
    """``line_no, line`` of text files written in order: files by the order table, lines by their place in the file.

    A long file is read in several pieces; each knows where in the file it begins.
    """
    order = spark.read.schema("file string, place long").json(f"{path}/{ORDER}")
    lines = spark.read.text(path, pathGlobFilter="part-*").select(
        F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_at"), F.col("value").alias("line"),
    )
    placed = lines.join(order, "file")
    return numbered(placed, ["place", "_block", "_at"], "line_no").select("line_no", "line")


def read_csv_ordered(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """``line_no`` and the columns of ``schema`` from ordered comma-separated lines; line 0 is the header."""
    lines = read_ordered(spark, path).filter(F.col("line_no") > 0)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    return lines.select("line_no", F.from_csv("line", columns).alias("r")).select("line_no", "r.*")


def read_store(spark: SparkSession, path: str, description: str) -> DataFrame:
    """``id, token`` of one kind of profile; only the partition of that kind is listed and read."""
    rows = spark.read.schema("id string, token long, description string").parquet(path)
    return rows.filter(F.col("description") == description).select("id", "token")


def read_averages(spark: SparkSession, path: str) -> DataFrame:
    """``id, avg`` from JSON objects of id to average, the entry ``UNK`` included."""
    objects = spark.read.text(path).select(F.from_json("value", "map<string,double>").alias("m"))
    return objects.select(F.explode("m").alias("id", "avg"))


def read_profiles(spark: SparkSession, path: str, description: str) -> DataFrame:
    """``id, token`` of one kind of profile from JSON lines with token lists."""
    rows = read_json_lines(spark, path, PROFILE).filter(F.col("description") == description)
    return rows.select("id", F.explode("profile").alias("token"))


def read_profile_tokens(spark: SparkSession, path: str, description: str) -> DataFrame:
    """``id, token`` from long rows kept in one folder per kind: only the asked folder is read."""
    rows = spark.read.schema("description string, id string, token long").json(path)
    return rows.filter(F.col("description") == description).select("id", "token")


def read_model(spark: SparkSession, path: str, schema: T.StructType = ITEM_MODEL) -> DataFrame:
    """``k1, k2, sim``"""
    one, two = schema.fieldNames()[:2]
    return read_json_lines(spark, path, schema).select(F.col(one).alias("k1"), F.col(two).alias("k2"), "sim")


def stream_cities(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines ``ts, city`` as they arrive in a folder."""
    return spark.readStream.schema(CITY).json(path)


def stream_messages(spark: SparkSession, path: str) -> DataFrame:
    """Messages as they arrive in a folder, with their tags as ``tags``."""
    return spark.readStream.schema(MESSAGE).json(path).withColumn("tags", F.col("hashtags.text"))
