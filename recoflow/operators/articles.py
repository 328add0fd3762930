"""Hourly article merge: metadata + content + channel name -> text to analyse."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recoflow.functions.text import sentence


def previous_hour(now) -> tuple:
    """Bounds [start, end) of the last full hour before the timestamp column ``now``."""
    end = F.date_trunc("hour", now)
    return end - F.expr("INTERVAL 1 HOUR"), end


def merge_articles(basic: DataFrame, content: DataFrame, channels: DataFrame,
                   start, end, status: int = 2) -> DataFrame:
    """Articles reviewed in [start, end) with the given status, text attached.

    The window and status filters reach the scan of ``basic``. The channel
    table is left to the planner, which broadcasts it while it is small.
    """
    reviewed = basic.where(
        (F.col("review_time") >= start) & (F.col("review_time") < end) & (F.col("status") == status)
    ).select("article_id", "channel_id", "title")
    return (
        reviewed.join(content.select("article_id", "content"), "article_id")
        .join(channels.select("channel_id", "channel_name"), "channel_id", "left")
        .select("article_id", "channel_id", "channel_name", "title", "content",
                sentence(F.col("channel_name"), F.col("title"), F.col("content")).alias("sentence"))
    )
