"""User interests from sums per day, for any day without refolding the log.

A (user, article) row counts for each topic of the article, on the day of its
last action. Sums over (user, channel, topic, day) are whole numbers; the decay
depends on the day alone and is applied when they are read. New actions withdraw
the old rows of the pairs they touch and add the new ones.

Days end at ``clock`` seconds after midnight, the time of day interests are asked
for; for other times of day the decay of an action may be a day off.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recoflow.functions.scoring import action_score
from recoflow.operators.actions import acted_on, action_flags, by_user, fold
from recoflow.session import materialize

KEYS = ["user_id", "channel_id", "topic", "day"]
PAIR = ["user_id", "article_id"]
DAY_US = 86_400_000_000


def ending_day(at: Column, clock: int = 0) -> Column:
    """Number of the day (since 1970) that ends at or after ``at``."""
    micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), at) - F.lit(clock * 1_000_000)
    return ((micros + F.pmod(-micros, F.lit(DAY_US))) / F.lit(DAY_US)).cast("long")


def day_sums(actions: DataFrame, topics: DataFrame, read_threshold: float = 1000, clock: int = 0) -> DataFrame:
    """(user_id, channel_id, topic, day, score) of a user x article table.

    ``topics`` has (article_id, channel_id, topics). Scores are dealt by user before
    they meet the topics, as in ``profiles.user_interests``.
    """
    scored = materialize(actions.select(*PAIR, ending_day(F.col("action_time"), clock).alias("day"), action_score(
        F.col("shared"), F.col("clicked"), F.col("collected"), F.col("read_time"), read_threshold).cast("long").alias("score")), "scored")
    known = acted_on(topics.select("article_id", "channel_id", "topics"), scored)
    return (
        by_user(scored).join(known, "article_id")
        .select("user_id", "channel_id", F.explode("topics").alias("topic"), "day", "score")
        .groupBy(*KEYS).agg(F.sum("score").alias("score"))
    )


def merge_sums(added: list[DataFrame], withdrawn: list[DataFrame] = []) -> DataFrame:
    """The sum of ``added`` less that of ``withdrawn``; what falls to 0 is gone, since no score is."""
    signed = [d.select(*KEYS, "score") for d in added]
    signed += [d.select(*KEYS, (-F.col("score")).alias("score")) for d in withdrawn]
    rows = signed[0]
    for other in signed[1:]:
        rows = rows.unionByName(other)
    return rows.groupBy(*KEYS).agg(F.sum("score").alias("score")).where(F.col("score") != 0)


def changed_pairs(history: DataFrame, actions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(before, after): the user x article rows of the pairs that new scanned actions touch."""
    new = fold(action_flags(actions))
    before = history.join(new.select(*PAIR), PAIR, "left_semi").select(*new.columns)
    return before, fold(before.unionByName(new))


def interests_on(sums: DataFrame, *days: Column) -> DataFrame:
    """(user_id, channel_id, topic, weight) on a day (its number since 1970): 1 / (ln(days + 1) + 1)
    of each day's sum. Days yet to come have no weight. Several days are summed in one
    pass; ``nth`` then tells which of them a row is for, from 0."""
    weight = lambda day: F.sum(F.col("score") * (F.lit(1.0) / (F.log(day - F.col("day") + F.lit(1.0)) + F.lit(1.0))))
    found = sums.groupBy("user_id", "channel_id", "topic").agg(F.array(*[weight(d) for d in days]).alias("weights"))
    found = found.select("user_id", "channel_id", "topic", F.posexplode("weights").alias("nth", "weight"))
    return found if len(days) > 1 else found.drop("nth")
