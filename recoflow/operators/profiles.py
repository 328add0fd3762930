"""User interests and basics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recoflow.functions.keys import channel_topic, id_after_prefix
from recoflow.functions.scoring import action_score, age_on, time_decay
from recoflow.operators.actions import acted_on, by_user
from recoflow.session import materialize


def user_interests(actions: DataFrame, topics: DataFrame, now: Column,
                   read_threshold: float = 1000) -> DataFrame:
    """(user_id, channel_id, topic, weight): decayed action scores, summed.

    ``actions`` is the user x article table, ``topics`` has (article_id,
    channel_id, topics). The score of an article counts for each of its topics.
    Scores are dealt by user before they meet the topics, so that the rows of all
    topics are summed where they arise. Only topics of articles in ``actions`` are
    joined; if they are too many to be sent to all, the sum is shuffled again.
    """
    scored = materialize(actions.select(
        "user_id", "article_id",
        (time_decay(F.col("action_time"), now)
         * action_score(F.col("shared"), F.col("clicked"), F.col("collected"),
                        F.col("read_time"), read_threshold)).alias("score")), "scored")
    known = acted_on(topics.select("article_id", "channel_id", "topics"), scored)
    return (
        by_user(scored).join(known, "article_id")
        .select("user_id", "channel_id", F.explode("topics").alias("topic"), "score")
        .groupBy("user_id", "channel_id", "topic").agg(F.sum("score").alias("weight"))
    )


def top_interests(interests: DataFrame, k: int = 10) -> DataFrame:
    """The k strongest interests of each user, with their rank."""
    best = Window.partitionBy("user_id").orderBy(
        F.desc(F.round("weight", 6)), "channel_id", "topic")
    return interests.withColumn("rank", F.row_number().over(best).cast("long")).where(F.col("rank") <= k)


def interest_map(interests: DataFrame) -> DataFrame:
    """(user_id, article_partial map<'channel:topic', weight>): the stored profile form."""
    entry = F.struct(channel_topic(F.col("channel_id"), F.col("topic")).alias("key"), "weight")
    return interests.groupBy("user_id").agg(
        F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("article_partial"))


def user_profile_scan(profile: DataFrame) -> DataFrame:
    """Stored profiles ('user:N' keys, map weights) back to (user_id, channel_id, topic, weight)."""
    key = F.split("key", ":", 2)
    return (
        profile.select(id_after_prefix(F.col("user_id")).alias("user_id"),
                       F.explode("article_partial").alias("key", "weight"))
        .select("user_id", key[0].cast("int").alias("channel_id"), key[1].alias("topic"), "weight")
    )


def user_basics(users: DataFrame, today: Column) -> DataFrame:
    """(user_id, gender, age); the text 'null' is an unknown birthday, age 0."""
    born = F.when(F.col("birthday") != "null", F.col("birthday")).try_cast("date")
    return users.select("user_id", "gender",
                        F.coalesce(age_on(born, today), F.lit(0)).cast("long").alias("age"))
