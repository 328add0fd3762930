"""Canonical tables derived from the provided star-schema test data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A short stop-word list for the test corpus.
STOPWORDS = ["the", "and", "les", "des", "que", "der", "die", "und", "los", "las", "con"]

# Event type -> action.
ACTIONS = {"click": "click", "purchase": "collect", "signup": "share",
           "view": "exposure", "error": "read"}

TASK_ROWS = 8192        # articles a task gets when a scan is dealt anew


def read(spark: SparkSession, sf: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{table}.parquet")


def _log_columns(events: DataFrame) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("long")
    action = F.lit(None).cast("string")
    for event_type, name in ACTIONS.items():
        action = F.when(F.col("event_type") == event_type, name).otherwise(action)
    shown = F.to_json(F.array(k, (k + 1) % 100, (k + 7) % 100))
    return events.select(
        "event_id",
        F.col("ts").alias("actionTime"),
        F.col("value").cast("string").alias("readTime"),
        (k % 25 + 1).cast("int").alias("channelId"),
        F.struct(
            action.alias("action"),
            F.col("user_id").cast("string").alias("userId"),
            F.when(action == "exposure", shown).otherwise(k.cast("string")).alias("articleId"),
            F.lit("C2").alias("algorithmCombine"),
        ).alias("param"),
        F.col("ts").cast("date").alias("dt"),
    )


def action_log(spark: SparkSession, sf: str) -> DataFrame:
    """``events`` as the nested action log; exposures list three articles."""
    return _log_columns(read(spark, sf, "events")).drop("event_id")


def click_messages(events: DataFrame) -> DataFrame:
    """``events`` (batch or stream) as JSON messages of the click topic."""
    log = _log_columns(events)
    body = F.struct(
        F.date_format("actionTime", "yyyy-MM-dd HH:mm:ss").alias("actionTime"),
        F.col("readTime"), F.col("channelId"), F.col("param"))
    return log.select(F.to_json(body).alias("value"))


def new_article_messages(events: DataFrame) -> DataFrame:
    """``events`` (batch or stream) as ``channel,article`` messages with arrival time."""
    k = F.get_json_object("props", "$.k").cast("long")
    return events.select(
        F.concat_ws(",", (k % 25 + 1).cast("string"), k.cast("string")).alias("value"),
        F.col("ts").cast("timestamp").alias("timestamp"))


def spread(df: DataFrame, key: str) -> DataFrame:
    """``df`` dealt by ``key`` to all cores, if fewer tasks of its scan have rows.

    For costly expressions over few or large parts: the text crosses the wire once,
    and a task gets about ``TASK_ROWS`` rows however many there are. A scan with enough
    tasks, as any large table has, stays as it is. Counting the rows of the tasks
    reads no column.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    tasks, rows = df.groupBy(F.spark_partition_id()).count().agg(F.count("*"), F.sum("count")).first()
    return df if tasks >= cores else df.repartition(max(cores, -(-(rows or 0) // TASK_ROWS)), key)


def articles(spark: SparkSession, sf: str) -> DataFrame:
    """``documents`` as (article_id, channel_id, sentence)."""
    return spread(read(spark, sf, "documents"), "doc_id").select(
        F.col("doc_id").alias("article_id"),
        F.regexp_replace("source", "[^0-9]", "").cast("int").alias("channel_id"),
        F.col("text").alias("sentence"))


def vectors(spark: SparkSession, sf: str) -> DataFrame:
    """``embeddings`` as (article_id, channel_id, vector)."""
    return read(spark, sf, "embeddings").select(
        F.col("vec_id").alias("article_id"), F.col("label").alias("channel_id"),
        F.col("embedding").cast("array<double>").alias("vector"))


def users(spark: SparkSession, sf: str) -> DataFrame:
    """``customer`` as (user_id, gender, birthday text); every 11th birthday unknown."""
    born = F.date_add(F.lit("1950-01-01").cast("date"), (F.col("c_custkey") * 37 % 20000).cast("int"))
    return read(spark, sf, "customer").select(
        F.col("c_custkey").alias("user_id"),
        (F.col("c_mktsegment") < "HOUSEHOLD").alias("gender"),
        F.when(F.col("c_custkey") % 11 == 0, "null").otherwise(born.cast("string")).alias("birthday"))


def news(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(basic, content, channels) from orders, customer and nation."""
    orders = read(spark, sf, "orders")
    customer = read(spark, sf, "customer").select("c_custkey", "c_nationkey")
    basic = orders.join(customer, orders.o_custkey == customer.c_custkey).select(
        F.col("o_orderkey").alias("article_id"), F.col("c_nationkey").alias("channel_id"),
        F.col("o_orderpriority").alias("title"), F.col("o_orderdate").alias("review_time"),
        F.when(F.col("o_orderstatus") == "F", 2).otherwise(1).alias("status"))
    content = orders.select(
        F.col("o_orderkey").alias("article_id"),
        F.concat(F.lit("<p>"), F.col("o_orderkey").cast("string"), F.lit("</p>")).alias("content"))
    channels = read(spark, sf, "nation").select(
        F.col("n_nationkey").alias("channel_id"), F.col("n_name").alias("channel_name"))
    return basic, content, channels
