"""The review data model over the given tables.

Every binding covers its whole table. Training data are the reviews before the last year, test
data those of the last year.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.session import spread, table

# Words that do not count.
STOPWORDS = "the a an and or of to in is with by for that as on it un la le les de et en".split()

YEAR = 1997
TOP = 10
POPULAR_OVER = 35
STATE = "Brand#4"
TEST_FROM = "2001-01-01 00:00:00"
SUPPORT_SHARE = 0.0054
CHUNKS = 4
BLOOM_RATE = 0.01
SIM_HASHES = 1000
SIM_BANDS = 500
MIN_JACCARD = 0.05
WINDOW = "30 minutes"
SLIDE = "10 minutes"
WATERMARK = "10 minutes"
REPLAY_PARTS = 4
AFTER_LAST = "50 minutes"  # window, watermark and slide
TRACKED = ["of", "the"]


def reviews(spark: SparkSession, sf: str) -> DataFrame:
    lines, orders = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    return lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"]).select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("review_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("business_id"),
        (F.floor((F.col("l_quantity") - 1) / 10) + 1).cast("double").alias("stars"),
        F.col("o_orderdate").alias("date"),
    )


def train(spark: SparkSession, sf: str) -> DataFrame:
    return reviews(spark, sf).filter(F.col("date") < F.lit(TEST_FROM).cast("timestamp_ntz"))


def test(spark: SparkSession, sf: str) -> DataFrame:
    return reviews(spark, sf).filter(F.col("date") >= F.lit(TEST_FROM).cast("timestamp_ntz"))


def business(spark: SparkSession, sf: str) -> DataFrame:
    size = F.col("p_size")
    listed = F.concat("p_type", F.lit(", "), F.replace("p_name", F.lit(" "), F.lit(", ")))
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("business_id"),
        F.when(size <= 5, F.lit(None)).when(size <= 10, "").otherwise(listed).alias("categories"),
        F.when(size >= 44, F.lit(None)).otherwise(F.col("p_brand")).alias("state"),
    )


def texts(spark: SparkSession, sf: str) -> DataFrame:
    """Texts with their user and business; one small file is spread over the cores before it is split into words."""
    return spread(table(spark, sf, "documents").select(
        "doc_id", (F.col("doc_id") % 50).alias("user_id"), F.col("source").alias("business_id"), "text"
    ))


def visits(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select(
        (F.col("doc_id") % 50).alias("user_id"), F.col("source").alias("business_id")
    )


def asked(spark: SparkSession, sf: str) -> DataFrame:
    """User and business pairs to score: each text's business against the user of a text further on."""
    return table(spark, sf, "documents").select(
        (F.floor(F.col("doc_id") / 20) % 50).alias("user_id"), F.col("source").alias("business_id")
    )


def pairs(spark: SparkSession, sf: str) -> DataFrame:
    lines, parts = table(spark, sf, "lineitem"), table(spark, sf, "part")
    return lines.join(parts, lines["l_partkey"] == parts["p_partkey"]).select("l_orderkey", "p_brand").distinct()


def bloom_build(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").filter(F.col("c_mktsegment") == "BUILDING").select("c_name")


def bloom_asked(spark: SparkSession, sf: str) -> DataFrame:
    """All customers; those in debt are asked for without a name."""
    named = F.when(F.col("c_acctbal") >= 0, F.col("c_name"))
    return table(spark, sf, "customer").select("c_custkey", named.alias("c_name"))


def order_names(spark: SparkSession, sf: str) -> DataFrame:
    """All orders with a name; open ones of unknown state have none."""
    named = F.when(F.col("o_orderstatus") != "P", F.concat(F.lit("order"), F.col("o_orderkey").cast("string")))
    return table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", named.alias("name"))


def multi_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Orders and brands, as often as an order holds a part of the brand."""
    lines, parts = table(spark, sf, "lineitem"), table(spark, sf, "part")
    return lines.join(parts, lines["l_partkey"] == parts["p_partkey"]).select("l_orderkey", "p_brand")


def cities(events: DataFrame) -> DataFrame:
    """Every event with its city; errors have none."""
    named = F.when(F.col("event_type") != "error", F.concat(F.lit("u"), F.col("user_id").cast("string")))
    return events.select("event_id", F.col("ts").cast("timestamp").alias("ts"), named.alias("city"))


def messages(events: DataFrame) -> DataFrame:
    """Every event as a message; views carry no tags."""
    tags = F.array(F.concat(F.lit("k"), F.get_json_object("props", "$.k")), F.col("event_type"))
    none = F.array().cast("array<string>")
    return events.select("event_id", F.when(F.col("event_type") != "view", tags).otherwise(none).alias("tags"))


def events(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events")


def tracked_messages(spark: SparkSession, sf: str) -> DataFrame:
    """Texts as messages: their language, and their first words as tags."""
    return table(spark, sf, "documents").select(
        F.col("doc_id").alias("id"), "text", "lang", F.slice(F.split("text", " "), 1, 3).alias("tags")
    )
