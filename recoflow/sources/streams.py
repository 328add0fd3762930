"""Stream sources: message frames with a string ``value`` -> typed columns.

``kafka_topic`` needs the Kafka connector on the class path; any other stream
with a ``value`` column (files, tests) goes through the same parsers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recoflow import schema as S


def kafka_topic(spark: SparkSession, servers: str, topic: str, starting: str = "latest") -> DataFrame:
    """(value string, timestamp) of a Kafka topic."""
    return (
        spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic).option("startingOffsets", starting).load()
        .select(F.col("value").cast("string").alias("value"), "timestamp")
    )


def click_stream(messages: DataFrame) -> DataFrame:
    """JSON messages of the click topic as flat action columns."""
    m = F.from_json("value", S.USER_ACTION)
    return messages.select(m.alias("m")).select(
        F.to_timestamp("m.actionTime", "yyyy-MM-dd HH:mm:ss").alias("action_time"),
        F.col("m.readTime").alias("read_time"), F.col("m.channelId").alias("channel_id"),
        F.col("m.param.action").alias("action"),
        F.col("m.param.userId").cast("long").alias("user_id"),
        F.col("m.param.articleId").alias("article_ids"),
        F.col("m.param.algorithmCombine").alias("algorithm"))


def new_article_stream(messages: DataFrame) -> DataFrame:
    """``"channel,article"`` messages with their arrival time."""
    part = F.split("value", ",")
    return messages.select(
        part[0].cast("int").alias("channel_id"), part[1].cast("long").alias("article_id"),
        F.col("timestamp").alias("arrived"))
