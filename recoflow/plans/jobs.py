"""The recurring jobs: each reads tables, runs operators, writes tables.

``root`` is the folder of the tables named below. Every product that a later
step needs is written once and read back, so no step recomputes another's plan.

    article_data, tfidf, textrank, article_profile, article_vector        a partition per hour
    idf                                                                   replaced
    article_similar                                                       keyed store
    vector_index, vector_index_at                                         index of vectors, the folder in use
    user_article, user_interest                                           replaced
    recall, feature_user, feature_article, served, waiting                see jobs
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recoflow.operators import actions, articles, cells, ctr, feed, keywords, profiles, recall, vectors
from recoflow.session import materialize
from recoflow.sources import tables


HOUR = "hour"


exists = tables.exists


def _publish(df: DataFrame, path: str, hour: Column) -> DataFrame:
    """Write ``df`` as the partition of its hour and return these rows, read from a
    single copy. A job that runs again for an hour overwrites what it wrote before."""
    rows = materialize(df, path.rstrip("/").rsplit("/", 1)[-1])
    (rows.withColumn(HOUR, F.date_format(hour, "yyyyMMddHH")).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(HOUR).parquet(path))
    return rows


def current(spark: SparkSession, path: str) -> DataFrame:
    """The rows of each article's newest hour: a republished article counts once."""
    newest = Window.partitionBy("article_id").orderBy(F.desc(F.col(HOUR).cast("string")))
    return (tables.table(spark, path).withColumn("_rank", F.rank().over(newest))
            .where(F.col("_rank") == 1).drop("_rank", HOUR))


def build_idf(docs: DataFrame, root: str, stopwords: Sequence[str] = (), vocab_size: int | None = None) -> None:
    """Rebuild the IDF table from a whole corpus."""
    tokens = keywords.tokenize(docs, stopwords=stopwords)
    tables.replace(keywords.idf_table(tokens, vocab_size), f"{root}/idf")


def update_articles(basic: DataFrame, content: DataFrame, channels: DataFrame, root: str, now: Column,
                    word_vectors: DataFrame, stopwords: Sequence[str] = (), threshold: float = 2.0,
                    k: int = 10, buckets: int = 256) -> None:
    """Hourly: merge the last hour's articles, then keywords, profile, vectors, similar.

    New articles enter the stored index of vectors and are compared, exactly,
    with the articles of their channel there, themselves included; only the cells they
    reach are read. The similar list of an article is one stored row.
    """
    spark = basic.sparkSession
    start, end = articles.previous_hour(now)
    publish = lambda df, name: _publish(df, f"{root}/{name}", start)
    docs = publish(articles.merge_articles(basic, content, channels, start, end), "article_data")
    idf = tables.table(spark, f"{root}/idf")
    tfidf, ranked = keywords.article_labels(docs, idf, stopwords=stopwords)
    tfidf, ranked = publish(tfidf, "tfidf"), publish(ranked, "textrank")
    profile = publish(keywords.article_profile(ranked, tfidf, idf), "article_profile")
    new = publish(vectors.article_vectors(profile, word_vectors), "article_vector")
    if new.isEmpty():
        return
    hour = spark.range(1).select(F.date_format(start, "yyyyMMddHH")).first()[0]
    path = vector_index(spark, root)
    if path is None or hour < cells.newest_hour(spark, path):
        path = rebuild_index(spark, root, hour, buckets)
    else:
        cells.add_to_index(path, new, hour, buckets)
    near = cells.search_index(path, new, threshold, k)
    lists = near.groupBy("article_id").agg(
        F.array_sort(F.collect_list(F.struct("rank", "similar_id", "distance"))).alias("near"))
    _store(lists.withColumn("computed", end.cast("timestamp")), f"{root}/article_similar",
           ["article_id"], "computed", buckets)


def vector_index(spark: SparkSession, root: str) -> str | None:
    """The folder of the index of vectors in use."""
    at = f"{root}/vector_index_at"
    return tables.table(spark, at).first().path if exists(spark, at) else None


def rebuild_index(spark: SparkSession, root: str, hour: str, buckets: int = 256) -> str:
    """Build the index of vectors anew, from every article's newest vector, and use it from now on.

    For a daily job, as centroids go stale, and for an hour that is repeated after
    later ones. The index in use stays until the new one is complete.
    """
    old = vector_index(spark, root)
    hour = max(hour, cells.newest_hour(spark, old) or hour) if old else hour
    known = current(spark, f"{root}/article_vector")
    path = f"{root}/vector_index/{hour}-{uuid.uuid4().hex[:8]}"
    cells.create_index(spark, path, cells.fit_centres(known))
    cells.add_to_index(path, known, hour, buckets)
    tables.replace(spark.createDataFrame([(path,)], "path string"), f"{root}/vector_index_at")
    return path


def _store(rows: DataFrame, path: str, keys: list[str], order: str, buckets: int) -> None:
    if exists(rows.sparkSession, path):
        tables.upsert(rows, path, keys, order)
    else:
        tables.create_store(rows, path, keys, order, buckets)


def similar_rows(spark: SparkSession, root: str) -> DataFrame:
    """The similar store as (article_id, similar_id, distance, rank) rows."""
    return tables.read_store(spark, f"{root}/article_similar").select(
        "article_id", F.explode("near").alias("n")).select("article_id", "n.similar_id", "n.distance", "n.rank")


def update_users(log: DataFrame, root: str, now: Column, read_threshold: float = 1000) -> None:
    """Daily: fold new actions into the user x article table, then interests."""
    spark = log.sparkSession
    new, path = actions.actions_scan(log), f"{root}/user_article"
    if exists(spark, path):
        merged = actions.merge_actions(tables.table(spark, path), new)
    else:
        merged = actions.fold_actions(new)
    tables.replace(merged, path)
    topics = current(spark, f"{root}/article_profile").select("article_id", "channel_id", "topics")
    interests = profiles.user_interests(tables.table(spark, path), topics, now, read_threshold)
    tables.replace(interests, f"{root}/user_interest")


def update_features(spark: SparkSession, root: str) -> None:
    """Daily: the two feature tables of the click model."""
    tables.replace(ctr.user_features(tables.table(spark, f"{root}/user_interest")), f"{root}/feature_user")
    features = ctr.article_features(current(spark, f"{root}/article_profile"),
                                    current(spark, f"{root}/article_vector"))
    tables.replace(features, f"{root}/feature_article")


def update_recall(spark: SparkSession, root: str, users: DataFrame, k: int = 100) -> None:
    """Daily: append collaborative recall of the active ``users`` and content recall, if not had yet."""
    done = tables.table(spark, f"{root}/user_article")
    channels = current(spark, f"{root}/article_data").select("article_id", "channel_id").distinct()
    als = recall.with_channel(recall.als_recall(done, users, k), channels).where(F.col("channel_id").isNotNull())
    content = recall.content_recall(done.where("clicked"), similar_rows(spark, root))
    rows = recall.recall_rows(als, "als").unionByName(recall.recall_rows(content, "content"))
    path = f"{root}/recall"
    if exists(spark, path):
        rows = recall.exclude_history(rows, tables.table(spark, path))
    tables.append(materialize(rows, "recall"), path)


def _table_or(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return tables.table(spark, path) if exists(spark, path) else spark.createDataFrame([], schema)


def serve_feeds(requests: DataFrame, root: str, new: DataFrame, hot: DataFrame, dim: int = 100,
                **ranking) -> DataFrame:
    """Answer requests: (request key, param, recommends, next_ts).

    A request that is not newer than the line's last feed pages through the
    history. Any other is served from the line's leftovers first and gets a
    computed feed only if there are none. Requests of one line are answered in time
    order and share nothing: each goes on where the one before stopped. Both go into the history; served
    leftovers leave the waiting table, those of new feeds enter it. ``next_ts``
    is the time to ask with for the feed before this one (0: none).
    """
    spark = requests.sparkSession
    served_path, waiting_path = f"{root}/served", f"{root}/waiting"
    served = _table_or(spark, served_path, "user_id long, channel_id int, request_ts long, pos long, article_id long")
    waiting = _table_or(spark, waiting_path, "user_id long, channel_id int, pos long, article_id long")
    # What a run that broke between its two writes has served is waiting no more.
    waiting = materialize(feed.exclude_served(waiting, served).select(*waiting.columns), "waiting")
    asks = materialize(feed.route_requests(requests.dropDuplicates(feed.REQUEST_KEY), served), "requests")
    fresh = asks.where(F.col("route") == "refresh")

    leftovers = feed.serve_waiting(fresh, waiting).where(F.col("state") == "served")
    leftovers = materialize(leftovers.withColumnRenamed("time_stamp", "request_ts").select(
        *feed.LINE, "request_ts", "pos", "article_id"), "leftovers")
    # Requests that got none share one computed list per line, asked for with the first of them.
    had = leftovers.select(*feed.LINE, F.col("request_ts").alias("time_stamp")).distinct()
    unmet = materialize(fresh.join(had, feed.REQUEST_KEY, "left_anti").select(*fresh.columns), "unmet")
    in_order = Window.partitionBy(*feed.LINE).orderBy("time_stamp")
    asking = (unmet.withColumn("n", F.row_number().over(in_order)).where(F.col("n") == 1)
              .select(*[c for c in unmet.columns if c not in ("route", "last_ts")]))
    candidates = recall.recall_union(feed.assign_strategy(asking), tables.table(spark, f"{root}/recall"),
                                     new, hot, feed.strategy_table(spark))
    seen = served.select(*feed.LINE, "article_id").unionByName(leftovers.select(*feed.LINE, "article_id"))
    ranked = materialize(ctr.rank_candidates(
        feed.exclude_served(candidates, seen), tables.table(spark, f"{root}/feature_user"),
        tables.table(spark, f"{root}/feature_article"), dim=dim, **ranking), "ranked")
    first, rest = feed.split_feed(ranked, unmet)
    answered = materialize(first.unionByName(leftovers), "answered")

    pages = feed.history_page(asks.where(F.col("route") == "history"), served)
    lists = feed.feed_rows_to_lists(answered).unionByName(pages.drop("next_ts"))
    answers = (asks.join(lists, feed.REQUEST_KEY, "left").join(pages.select(*feed.REQUEST_KEY, "next_ts"), feed.REQUEST_KEY, "left")
               .withColumn("articles", F.coalesce("articles", F.array().cast("array<bigint>")))
               .withColumn("before", F.max(F.when(F.col("route") == "refresh", F.col("time_stamp"))).over(
                   in_order.rowsBetween(Window.unboundedPreceding, -1)))
               .withColumn("next_ts", F.when(F.col("route") == "history", F.col("next_ts"))
                           .otherwise(F.greatest("last_ts", "before"))).drop("before"))
    payload = materialize(feed.track_payload(feed.assign_strategy(answers)), "payload")
    kept = waiting.join(leftovers.select(*feed.LINE, "article_id"), [*feed.LINE, "article_id"], "left_anti")
    tables.append(answered, served_path)
    tables.replace(kept.select(*waiting.columns).unionByName(rest), waiting_path)
    return payload
