"""Click-through features, samples, model and ranking.

Feature order, for training and serving alike:
``[channel, article vector (dim), user weights (10), article weights (10)]``.
The stored article features are ``[channel, article weights (10), vector]``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recoflow.functions.vectors import mean_of_slice, pad
from recoflow.operators.actions import acted_on
from recoflow.session import materialize

WEIGHTS = 10


def keyword_features(keywords: Column, k: int = WEIGHTS, largest: bool = False) -> Column:
    """The k smallest (or largest) weights of a keyword map, in that order."""
    return F.slice(F.sort_array(F.map_values(keywords), asc=not largest), 1, k)


def user_features(interests: DataFrame, k: int = WEIGHTS, largest: bool = False) -> DataFrame:
    """(user_id, channel_id, weights): the k smallest (or largest) interest weights.

    The limit applies before the shuffle; the collected array has at most k entries.
    """
    order = F.desc("weight") if largest else F.asc("weight")
    best = Window.partitionBy("user_id", "channel_id").orderBy(order)
    return (
        interests.select("user_id", "channel_id", "weight")
        .withColumn("rn", F.row_number().over(best)).where(F.col("rn") <= k)
        .groupBy("user_id", "channel_id")
        .agg(F.sort_array(F.collect_list("weight"), asc=not largest).alias("weights"))
    )


def article_features(profiles: DataFrame, vectors: DataFrame, k: int = WEIGHTS,
                     largest: bool = False, strict: bool = False) -> DataFrame:
    """(article_id, channel_id, features): channel, k keyword weights, vector.

    Short weight lists are padded with 0.0, or dropped when ``strict``.
    """
    weights = profiles.select("article_id", "channel_id",
                              keyword_features(F.col("keywords"), k, largest).alias("w"))
    if strict:
        weights = weights.where(F.size("w") == k)
    channel = F.array(F.col("channel_id").cast("double"))
    return weights.join(vectors.select("article_id", "vector"), "article_id").select(
        "article_id", "channel_id", F.concat(channel, pad(F.col("w"), k), F.col("vector")).alias("features"))


def training_order(article: Column, user: Column, k: int = WEIGHTS) -> Column:
    """Stored article features and user weights in the order of the model."""
    return F.concat(F.slice(article, 1, 1), F.slice(article, k + 2, F.size(article)), user,
                    F.slice(article, 2, k))


def ctr_samples(actions: DataFrame, users: DataFrame, articles: DataFrame, dims: int = 121,
                strict: bool = False, k: int = WEIGHTS) -> DataFrame:
    """(user_id, article_id, channel_id, features array<double>, clicked 0/1).

    ``users`` and ``articles`` are the two feature tables. Actions on articles
    without features drop out. A user's missing or short weights are padded
    with 0.0; when ``strict``, only users without any profile are padded and
    short lists are dropped. Rows of any other size than ``dims`` are removed.
    Features of articles are the widest part and join last, those in ``actions`` only.
    """
    actions = materialize(actions.select("user_id", "article_id", F.col("clicked").cast("int").alias("clicked")), "acted")
    articles = acted_on(articles.withColumn("row", F.monotonically_increasing_id()), actions)
    rows = (
        actions.join(articles.drop("features"), "article_id")
        .join(users.select("user_id", "channel_id", "weights"), ["user_id", "channel_id"], "left")
    )
    weights = pad(F.col("weights"), k)
    if strict:
        profiled = users.select("user_id").distinct().withColumn("profiled", F.lit(True))
        rows = rows.join(profiled, "user_id", "left")
        empty = F.array().cast("array<double>")
        weights = F.when(F.col("profiled").isNull(), weights).otherwise(F.coalesce("weights", empty))
    features = training_order(F.col("features"), weights, k)
    return (
        rows.join(articles.select("row", "features"), "row").select("user_id", "article_id", "channel_id", features.alias("features"), "clicked")
        .where(F.size("features") == dims)
    )


def feature_means(samples: DataFrame, dim: int = 100, k: int = WEIGHTS) -> DataFrame:
    """Mean of each feature group of a sample: vector, user and article weights."""
    f = F.col("features")
    return samples.select(
        "user_id", "article_id", "channel_id",
        mean_of_slice(f, 2, dim).alias("vector_mean"),
        mean_of_slice(f, dim + 2, k).alias("user_mean"),
        mean_of_slice(f, dim + k + 2, k).alias("article_mean"), "clicked")


def export_samples(samples: DataFrame, path: str) -> None:
    """Training samples as parquet (label, features), written by the executors."""
    samples.select(F.col("clicked").alias("label"), "features").write.mode("overwrite").parquet(path)


def train_ctr(samples: DataFrame, **params) -> LogisticRegressionModel:
    """Logistic regression of ``clicked`` on the features."""
    data = samples.select(array_to_vector("features").alias("features"), "clicked")
    return LogisticRegression(featuresCol="features", labelCol="clicked", **params).fit(data)


def score_ctr(model, samples: DataFrame) -> DataFrame:
    """Add ``score``, the predicted probability of a click."""
    vectors = samples.withColumn("_v", array_to_vector("features"))
    scored = model.copy({model.featuresCol: "_v"}).transform(vectors)
    return scored.withColumn("score", vector_to_array("probability")[1]).drop(
        "_v", "rawPrediction", "probability", "prediction")


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> LogisticRegressionModel:
    return LogisticRegressionModel.load(path)


def rank_candidates(candidates: DataFrame, users: DataFrame, articles: DataFrame,
                    model=None, score: Callable[[Column], Column] | None = None,
                    cap: int | None = None, dim: int = 100, k: int = WEIGHTS) -> DataFrame:
    """Add ``score`` and ``rank`` to (user_id, channel_id, time_stamp, article_id).

    Rank by predicted click probability, best first, ties by id; ``cap`` limits
    a request's candidates if given. Articles without features count as all
    zeros. Users without features in the channel are not scored: their
    candidates keep id order. ``score`` may replace the model by an expression
    over the feature array.
    """
    empty = F.array_repeat(F.lit(0.0), 1 + k + dim)
    article = F.coalesce(F.col("features"), empty)
    rows = (
        candidates.join(users.select("user_id", "channel_id", "weights"), ["user_id", "channel_id"], "left")
        .join(articles.select("article_id", "features"), "article_id", "left")     # the widest part last
        .withColumn("known", F.size(F.coalesce("weights", F.array().cast("array<double>"))) > 0)
        .withColumn("features", training_order(article, pad(F.col("weights"), k), k))
    )
    if model is not None:
        rows = score_ctr(model, rows)
    else:
        rows = rows.withColumn("score", score(F.col("features")))
    order = Window.partitionBy("user_id", "channel_id", "time_stamp").orderBy(
        F.desc_nulls_last("score"), "article_id")
    ranked = (
        rows.withColumn("score", F.when(F.col("known"), F.col("score")))
        .drop("features", "weights", "known")
        .withColumn("rank", F.row_number().over(order).cast("long"))
    )
    return ranked if cap is None else ranked.where(F.col("rank") <= cap)
