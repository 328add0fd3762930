import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from recoflow.functions import keys
from recoflow.operators import profiles

NOW = lambda: F.lit("2024-03-01 00:00:00").cast("timestamp")
ACTIONS = ("user_id long, article_id long, action_time timestamp, shared boolean, "
           "clicked boolean, collected boolean, read_time double")


def act(article, day=datetime(2024, 3, 1), shared=False, clicked=True, collected=False, read=None, user=1):
    return (user, article, day, shared, clicked, collected, read)


def weights(spark, actions, topics):
    t = spark.createDataFrame(topics, "article_id long, channel_id int, topics array<string>")
    out = profiles.user_interests(spark.createDataFrame(actions, ACTIONS), t, NOW())
    return {(r["user_id"], r["channel_id"], r["topic"]): r["weight"] for r in out.collect()}


def test_decay_counts_elapsed_days(spark):
    out = weights(spark, [act(1, datetime(2024, 1, 30))], [(1, 9, ["aa"])])
    assert out == {(1, 9, "aa"): pytest.approx(6 / (math.log(32) + 1))}
    out = weights(spark, [act(1, datetime(2024, 2, 29, 0, 0, 1))], [(1, 9, ["aa"])])
    assert out == {(1, 9, "aa"): 6.0}  # not a whole day yet


@pytest.mark.parametrize("kind, score", [
    ({"clicked": False}, 1), ({}, 6), ({"clicked": False, "shared": True}, 4),
    ({"clicked": False, "collected": True}, 3), ({"read": 1000.0}, 6), ({"read": 1000.5}, 7)])
def test_action_scores(spark, kind, score):
    assert weights(spark, [act(1, **kind)], [(1, 9, ["aa"])]) == {(1, 9, "aa"): score}


def test_articles_sharing_a_topic_are_summed(spark):
    out = weights(spark, [act(1), act(2), act(3), act(1, user=2)],
                  [(1, 9, ["aa", "bb"]), (2, 9, ["aa"]), (4, 9, ["aa"])])
    assert out == {(1, 9, "aa"): 12.0, (1, 9, "bb"): 6.0, (2, 9, "aa"): 6.0, (2, 9, "bb"): 6.0}


def test_map_form_and_back(spark, rows):
    data = [(1, 9, "a:b", 1.5), (1, 10, "aa", 2.0), (2, 9, "aa", 3.0)]
    df = spark.createDataFrame(data, "user_id long, channel_id int, topic string, weight double")
    stored = profiles.interest_map(df).withColumn("user_id", F.concat(F.lit("user:"), F.col("user_id")))
    assert set(rows(profiles.user_profile_scan(stored))) == set(data)


def test_top_interests_break_ties(spark, rows):
    df = spark.createDataFrame([(1, 2, "bb", 1.0), (1, 1, "bb", 1.0), (1, 1, "aa", 1.0), (1, 3, "cc", 0.5)],
                               "user_id long, channel_id int, topic string, weight double")
    out = profiles.top_interests(df, 3).select("rank", "channel_id", "topic")
    assert rows(out) == [(1, 1, "aa"), (2, 1, "bb"), (3, 2, "bb")]


@pytest.mark.parametrize("today, age", [("2020-02-28", 19), ("2020-02-29", 20), ("2021-02-28", 20), ("2021-03-01", 21)])
def test_leap_day_birthday(spark, today, age):
    df = spark.createDataFrame([(1, True, "2000-02-29")], "user_id long, gender boolean, birthday string")
    assert profiles.user_basics(df, F.lit(today).cast("date")).collect()[0]["age"] == age


def test_unknown_birthday_has_age_zero(spark, rows):
    df = spark.createDataFrame([(1, True, "null"), (2, False, None)], "user_id long, gender boolean, birthday string")
    assert rows(profiles.user_basics(df, F.lit("2024-01-01").cast("date"))) == [(1, True, 0), (2, False, 0)]


def test_remap_and_prefixed_id(spark, rows):
    df = spark.createDataFrame([(14225, "user:5"), (1, "user:123456789012")], "article_id long, key string")
    out = keys.remap(df, "article_id", {14225: 1}, 10).select("article_id", keys.id_after_prefix(F.col("key")))
    assert rows(out) == [(1, 5), (10, 123456789012)]


def test_topics_are_summed_where_they_arise(spark):
    """Rows of all topics are not shuffled: scores are dealt by user before."""
    t = spark.createDataFrame([(1, 9, ["aa", "bb"]), (2, 9, ["bb"])], "article_id long, channel_id int, topics array<string>")
    out = profiles.user_interests(spark.createDataFrame([act(1), act(2), act(3)], ACTIONS), t, NOW())
    plan = out._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(exchanges) == 1 and "topic" not in exchanges[0] and "channel" not in exchanges[0], plan
    assert {(r.topic, r.weight) for r in out.collect()} == {("aa", 6.0), ("bb", 12.0)}
