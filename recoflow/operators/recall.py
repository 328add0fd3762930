"""Recall sources: collaborative, content, hot, new; history filter and union."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.recommendation import ALS
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recoflow.operators import products
from recoflow.session import materialize

INDEX_BUCKETS = 4096
CHANNEL_SALTS = 32
RECALL_KEYS = ["user_id", "channel_id", "article_id"]


def dense_index(df: DataFrame, col: str, buckets: int = INDEX_BUCKETS) -> DataFrame:
    """(col, idx): distinct ids numbered 0..n-1 without a global sort.

    Ids are numbered inside hash buckets and shifted by the size of the buckets
    before. The only single-task step sees one row per bucket.
    """
    ids = df.select(col).distinct().withColumn(
        "b", F.pmod(F.xxhash64(col), F.lit(buckets)).cast("int"))
    upto = Window.orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ids.groupBy("b").agg(F.count(F.lit(1)).alias("n")).select(
        "b", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("offset"))
    within = Window.partitionBy("b").orderBy(col)
    return (
        ids.withColumn("rn", F.row_number().over(within))
        .join(F.broadcast(offsets), "b")  # at most ``buckets`` rows
        .select(col, (F.col("offset") + F.col("rn") - 1).cast("long").alias("idx"))
    )


def als_factors(interactions: DataFrame, seed: int = 42, als: ALS | None = None) -> tuple[DataFrame, DataFrame]:
    """((user_id, vector), (article_id, vector)): factors of users and articles by ALS.

    ``interactions`` has (user_id, article_id, clicked); the rating is clicked
    as 0/1. Ids of any size are numbered densely first.
    """
    # Read before and after the fit, so written once.
    user_ids = materialize(dense_index(interactions, "user_id").withColumnRenamed("idx", "u"), "users")
    article_ids = materialize(dense_index(interactions, "article_id").withColumnRenamed("idx", "a"), "articles")
    ratings = (
        interactions.join(user_ids, "user_id").join(article_ids, "article_id")
        .select(F.col("u").cast("int"), F.col("a").cast("int"),
                F.col("clicked").cast("int").cast("float").alias("r"))
    )
    als = als or ALS()
    als = als.copy().setUserCol("u").setItemCol("a").setRatingCol("r").setSeed(seed)
    model = als.fit(ratings)

    def named(factors: DataFrame, ids: DataFrame, number: str, key: str) -> DataFrame:
        vector = F.col("features").cast("array<double>").alias("vector")
        return materialize(factors.select(F.col("id").alias(number), vector).join(ids, number).select(key, "vector"), "factors")

    return named(model.userFactors, user_ids, "u", "user_id"), named(model.itemFactors, article_ids, "a", "article_id")


def als_recall(interactions: DataFrame, users: DataFrame, k: int = 100,
               seed: int = 42, als: ALS | None = None) -> DataFrame:
    """(user_id, article_id, score): the k best articles of each user by ALS.

    Scores are inner products of the factors (``als_factors``); the search is
    exact and skips articles whose norm is too small (``products.top_products``).
    The caller names the users to serve.
    """
    user_factors, article_factors = als_factors(interactions, seed, als)
    wanted = user_factors.join(users.select("user_id").distinct(), "user_id", "left_semi")
    return products.top_products(wanted, article_factors, "user_id", "article_id", k).select(
        "user_id", "article_id", "score")


def with_channel(recall: DataFrame, articles: DataFrame) -> DataFrame:
    """Attach the channel of each recalled article (unknown: null)."""
    return recall.join(articles.select("article_id", "channel_id"), "article_id", "left")


def exclude_history(recall: DataFrame, history: DataFrame) -> DataFrame:
    """Drop articles already recalled for the user in the channel."""
    return recall.join(history.select(*RECALL_KEYS), RECALL_KEYS, "left_anti").select(*recall.columns)


def content_recall(clicks: DataFrame, similar: DataFrame, history: DataFrame | None = None,
                   k: int = 10) -> DataFrame:
    """(user_id, channel_id, article_id): the k most similar articles of each clicked one.

    ``clicks`` has (user_id, channel_id, article_id); the channel of the click
    is kept. Each article has at most k similar rows, so a hot article
    multiplies its clicks by k and is split at run time.
    """
    near = similar.where(F.col("rank") <= k).select("article_id", "similar_id")
    found = (
        clicks.select(*RECALL_KEYS).distinct().join(near, "article_id")
        .select("user_id", "channel_id", F.col("similar_id").alias("article_id")).distinct()
    )
    return exclude_history(found, history) if history is not None else found


def hot_scores(actions: DataFrame) -> DataFrame:
    """(channel_id, article_id, score): number of clicks, collects, shares, ..."""
    return (
        actions.where(~F.col("action").isin("exposure", "read"))
        .groupBy("channel_id", F.col("article_ids").try_cast("long").alias("article_id"))
        .agg(F.count(F.lit(1)).alias("score"))
    )


def hot_articles(scores: DataFrame, k: int = 10) -> DataFrame:
    """The k highest scores of each channel. The limit applies before the shuffle,
    so even a channel with most of the articles sends k rows per task."""
    best = Window.partitionBy("channel_id").orderBy(F.desc("score"), "article_id")
    return scores.withColumn("rank", F.row_number().over(best).cast("long")).where(F.col("rank") <= k)


def arrivals(messages: DataFrame) -> DataFrame:
    """(channel_id, article_id, arrived): the last arrival of each new article."""
    return messages.groupBy("channel_id", "article_id").agg(F.max("arrived").alias("arrived"))


def new_articles(latest: DataFrame, k: int | None = None) -> DataFrame:
    """New articles, newest first; all of them, or the first k of each channel."""
    order = Window.partitionBy("channel_id").orderBy(F.desc("arrived"), "article_id")
    if k is None:
        return latest
    return latest.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= k)


def recall_rows(df: DataFrame, source: str) -> DataFrame:
    """Label (user_id, channel_id, article_id) rows with their recall source."""
    return df.select("user_id", F.col("channel_id").cast("int").alias("channel_id"),
                     F.lit(source).alias("recall_type"), F.col("article_id").cast("long").alias("article_id"))


def read_recall(recall: DataFrame, sources: Sequence[str]) -> DataFrame:
    """The stored recall rows of the given sources."""
    return recall.where(F.col("recall_type").isin(list(sources)))


def recall_union(requests: DataFrame, stored: DataFrame, new: DataFrame, hot: DataFrame,
                 strategies: DataFrame) -> DataFrame:
    """(request columns, article_id, sources): every candidate once per request.

    Stored sources (als, content, online) match the user and channel, the new
    and hot lists the channel alone; the strategy of a request says which
    sources it uses. ``sources`` keeps where a candidate came from.

    There are few channels and one may get most requests, so the channel lists
    are copied ``CHANNEL_SALTS`` times and requests spread over the copies.
    """
    keys = ["user_id", "channel_id", "article_num", "time_stamp", "strategy"]
    wanted = requests.join(strategies.select("strategy", F.explode("sources").alias("recall_type")),
                           "strategy").select(*keys, "recall_type")
    personal = wanted.join(stored, ["user_id", "channel_id", "recall_type"]).select(
        *keys, "recall_type", "article_id")
    lists = (
        new.select("channel_id", "article_id", F.lit("new").alias("recall_type"))
        .unionByName(hot.select("channel_id", "article_id", F.lit("hot").alias("recall_type")))
    )
    salted = lists.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(CHANNEL_SALTS - 1))))
    spread = wanted.withColumn(
        "salt", F.pmod(F.xxhash64("user_id", "time_stamp"), F.lit(CHANNEL_SALTS)).cast("int"))
    shared = spread.join(salted, ["channel_id", "recall_type", "salt"]).select(
        *keys, "recall_type", "article_id")
    return personal.unionByName(shared).groupBy(*keys, "article_id").agg(
        F.array_sort(F.collect_set("recall_type")).alias("sources"))
