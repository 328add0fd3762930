"""Action log -> one row per (user, article)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recoflow.session import materialize

FLAGS = ("shared", "clicked", "collected", "exposure")


def actions_scan(log: DataFrame, until: str | None = None) -> DataFrame:
    """Flatten the nested log; ``until`` bounds the ``dt`` partitions read (inclusive)."""
    if until is not None:
        log = log.where(F.col("dt") <= F.lit(until).cast("date"))
    return log.select(
        F.col("param.userId").cast("long").alias("user_id"),
        F.col("actionTime").alias("action_time"),
        F.col("readTime").alias("read_time"),
        F.col("channelId").alias("channel_id"),
        F.col("param.action").alias("action"),
        F.col("param.articleId").alias("article_ids"),
        F.col("param.algorithmCombine").alias("algorithm"),
    )


def action_flags(actions: DataFrame) -> DataFrame:
    """One row per (action, article) with boolean flags.

    An exposure names a JSON list of articles and becomes one row per article;
    every other action names one article. ``exposure`` is true for all: an
    article that was clicked had been shown. ``read_time`` becomes a number
    here, so that later maxima are numeric. Rows without a valid id drop out.
    """
    shown = F.col("action") == "exposure"
    ids = F.when(shown, F.from_json("article_ids", "array<bigint>")).otherwise(
        F.array(F.col("article_ids").try_cast("long")))
    return actions.select(
        "user_id", "action_time", F.explode_outer(ids).alias("article_id"), "channel_id",
        (F.col("action") == "share").alias("shared"),
        (F.col("action") == "click").alias("clicked"),
        (F.col("action") == "collect").alias("collected"),
        F.lit(True).alias("exposure"),
        F.col("read_time").try_cast("double").alias("read_time"),
    ).where(F.col("article_id").isNotNull())


def fold(rows: DataFrame) -> DataFrame:
    """Latest time, highest read time and OR of the flags per (user, article).

    All aggregates are maxima, so partial results combine before the shuffle
    and a hot user or article costs one row per task.
    """
    return rows.groupBy("user_id", "article_id").agg(
        F.max("action_time").alias("action_time"),
        F.max("channel_id").alias("channel_id"),
        *[F.max(f).alias(f) for f in FLAGS],
        F.max("read_time").alias("read_time"),
    )


def fold_actions(actions: DataFrame) -> DataFrame:
    """The user x article table of a scanned log."""
    return fold(action_flags(actions))


def acted_on(table: DataFrame, actions: DataFrame) -> DataFrame:
    """The rows of ``table`` whose article occurs in ``actions``, written once: the planner
    then knows their size, and sends few of them to the actions instead of the reverse."""
    rows = table.join(actions.select("article_id").distinct(), "article_id", "left_semi")
    return materialize(rows.select(*table.columns), "acted-on")


def by_user(rows: DataFrame) -> DataFrame:
    """``rows`` dealt by user, in fixed partitions: what follows makes many rows of each."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), "user_id")


def merge_actions(history: DataFrame, actions: DataFrame) -> DataFrame:
    """Bring an existing user x article table up to date with new actions."""
    return fold(history.unionByName(action_flags(actions)))
