"""Feeds for a table of requests: strategy, routing, candidates, split, tracking.

A request is (user_id, channel_id, article_num, time_stamp); (user_id,
channel_id, time_stamp) is its key. ``served`` is the append-only history
(user_id, channel_id, request_ts, pos, article_id), ``waiting`` the leftovers
(user_id, channel_id, pos, article_id). Channel 0 is the mixed feed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recoflow import schema as S
from recoflow.functions.keys import first_md5_digit
from recoflow.operators import history
from recoflow.operators.ctr import rank_candidates
from recoflow.operators.recall import recall_union

REQUEST_KEY = ["user_id", "channel_id", "time_stamp"]
LINE = ["user_id", "channel_id"]
DAY_MS = 86_400_000


def strategy_table(spark: SparkSession) -> DataFrame:
    """(strategy, digits, sources, sort): the experiment set-up, one row per strategy."""
    rows = [(name, S.BUCKETS[name], conf["sources"], conf["sort"]) for name, conf in S.STRATEGIES.items()]
    return spark.createDataFrame(
        rows, "strategy string, digits array<string>, sources array<string>, sort string")


def assign_strategy(requests: DataFrame) -> DataFrame:
    """Add ``bucket`` (first md5 digit of the user id) and ``strategy``."""
    bucket = first_md5_digit(F.col("user_id"))
    strategy = F.when(bucket.isin(S.BUCKETS["Algo-1"]), "Algo-1").otherwise("Algo-2")
    return requests.withColumn("bucket", bucket).withColumn("strategy", strategy)


def last_served(served: DataFrame) -> DataFrame:
    """(user_id, channel_id, last_ts): time of the newest feed."""
    return served.groupBy(*LINE).agg(F.max("request_ts").alias("last_ts"))


def route_requests(requests: DataFrame, served: DataFrame) -> DataFrame:
    """Add ``last_ts`` (0 if none) and ``route``: a request newer than the last
    feed is a 'refresh', any other pages through the 'history'."""
    last = F.coalesce(F.col("last_ts"), F.lit(0)).cast("long")
    return (
        requests.join(last_served(served), LINE, "left").withColumn("last_ts", last)
        .withColumn("route", F.when(F.col("last_ts") < F.col("time_stamp"), "refresh")
                    .otherwise("history"))
    )


def history_page(requests: DataFrame, served: DataFrame) -> DataFrame:
    """(request key, articles, next_ts): the newest feed at or before the request.

    ``next_ts`` is the time of the feed before that, 0 at the end; without any
    feed the page is empty. Requests and feeds are merged in time order within
    a user, channel and day; only the last feeds of each day are then compared
    over days. So a line with most of the history is spread over its days, and
    nothing is joined pairwise. A feed has at most article_num rows, so
    collecting a page is bounded.
    """
    day = F.floor(F.col("ts") / DAY_MS).alias("day")
    pages = served.groupBy(*LINE, F.col("request_ts").alias("ts")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "article_id"))),
                    lambda x: x["article_id"]).alias("articles"))
    in_day = Window.partitionBy(*LINE, "day").orderBy("ts")
    pages = pages.select(*LINE, "ts", day, "articles").withColumn("before", F.lag("ts").over(in_day))
    page = F.struct("ts", "before", "articles").alias("page")
    pages = pages.select(*LINE, "day", "ts", F.lit(0).alias("asks"), page)

    asks = requests.select(*LINE, F.col("time_stamp").alias("ts"), F.lit(1).alias("asks"))
    merged = pages.unionByName(asks.select(*LINE, day, "ts", "asks"), allowMissingColumns=True)

    # The last feed of each day with the feed before it, then that of earlier days.
    earlier = Window.partitionBy(*LINE).orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    last_before = lambda c: F.last(c, ignorenulls=True).over(earlier)
    closing = F.when(F.col("last").isNotNull(), F.struct(
        F.col("last.ts").alias("ts"),
        F.coalesce("last.before", last_before("last")["ts"], F.lit(0)).alias("next"),
        F.col("last.articles").alias("articles")))
    days = (
        merged.groupBy(*LINE, "day").agg(F.max("page").alias("last"))
        .withColumn("closing", closing)
        .select(*LINE, "day", last_before("closing").alias("earlier"))
    )
    upto = Window.partitionBy(*LINE, "day").orderBy("ts", "asks").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    found = (
        merged.withColumn("same", F.last("page", ignorenulls=True).over(upto))
        .where(F.col("asks") == 1).join(days, [*LINE, "day"])
    )
    today = F.col("same").isNotNull()
    none = F.array().cast("array<bigint>")
    return found.select(
        *LINE, F.col("ts").alias("time_stamp"),
        F.coalesce(F.when(today, F.col("same.articles")).otherwise(F.col("earlier.articles")), none).alias("articles"),
        F.coalesce(F.when(today, F.coalesce("same.before", "earlier.ts")).otherwise(F.col("earlier.next")),
                   F.lit(0)).cast("long").alias("next_ts"))


def exclude_served(candidates: DataFrame, served: DataFrame) -> DataFrame:
    """Drop what the user has been served in the channel or in the mixed channel 0."""
    same = served.select(*LINE, "article_id")
    mixed = served.where(F.col("channel_id") == 0).select("user_id", "article_id")
    return candidates.join(same, [*LINE, "article_id"], "left_anti").join(
        mixed, ["user_id", "article_id"], "left_anti")


def request_slices(requests: DataFrame) -> DataFrame:
    """(request key, first, last): the ranks each request takes of its line's list.

    Requests of a line are answered one after the other in time order, so the
    second one goes on where the first one stopped. Equal requests are one.
    """
    in_order = Window.partitionBy(*LINE).orderBy("time_stamp").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = F.sum("article_num").over(in_order)
    return requests.dropDuplicates(REQUEST_KEY).select(
        *REQUEST_KEY, (last - F.col("article_num") + 1).cast("long").alias("first"), last.cast("long").alias("last"))


def _slots(requests: DataFrame, cap: int | None = None) -> DataFrame:
    """(request key, first, n): a row per rank, up to ``cap`` if given, that a request takes."""
    slices = request_slices(requests)
    if cap is not None:
        slices = slices.withColumn("last", F.least("last", F.lit(cap).cast("long")))
    return slices.where(F.col("first") <= F.col("last")).select(
        *REQUEST_KEY, "first", F.explode(F.sequence("first", "last")).alias("n"))


def split_feed(ranked: DataFrame, requests: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(feed, waiting): the first article_num of each request, and the rest.

    With ``requests`` the ranked list is that of a line (of any one request of it)
    and all requests of the line take their slices of it in time order. ``cap`` is
    the length of a ranked list at most.
    """
    if requests is not None:
        ranks = ranked.select(*LINE, F.col("rank").cast("long").alias("n"), "article_id")
        taken = ranks.join(_slots(requests), [*LINE, "n"], "left")
        total = request_slices(requests).groupBy(*LINE).agg(F.max("last").alias("total"))
        feed = taken.where("time_stamp is not null").select(
            *LINE, F.col("time_stamp").alias("request_ts"), (F.col("n") - F.col("first") + 1).alias("pos"), "article_id")
        waiting = taken.where("time_stamp is null").join(total, LINE).select(
            *LINE, (F.col("n") - F.col("total")).alias("pos"), "article_id")
        return feed, waiting
    first = F.col("rank") <= F.col("article_num")
    feed = ranked.where(first).select(
        *LINE, F.col("time_stamp").alias("request_ts"), F.col("rank").alias("pos"), "article_id")
    waiting = ranked.where(~first).select(
        *LINE, (F.col("rank") - F.col("article_num")).alias("pos"), "article_id")
    return feed, waiting


def generate_feed(requests: DataFrame, stored: DataFrame, new: DataFrame, hot: DataFrame,
                  served: DataFrame, users: DataFrame, articles: DataFrame,
                  strategies: DataFrame, seen: DataFrame | None = None, **ranking) -> tuple[DataFrame, DataFrame]:
    """(feed, waiting) of refresh requests: recall, history filter, ranking, split.

    With ``seen``, the history as bitmaps (``history.served_bitmaps``), candidates
    are tested against its bits and ``served`` is not read.
    ``ranking`` goes to :func:`rank_candidates` (model or score, cap, dim). All
    strategies rank with the same model. Both results come from one ranked
    table: materialize it when both are written.
    """
    candidates = recall_union(assign_strategy(requests), stored, new, hot, strategies)
    fresh = exclude_served(candidates, served) if seen is None else history.exclude_seen(candidates, seen)
    return split_feed(rank_candidates(fresh, users, articles, **ranking))


def serve_waiting(requests: DataFrame, waiting: DataFrame, cached: DataFrame | None = None,
                  cap: int = 100) -> DataFrame:
    """(user_id, channel_id, time_stamp, pos, article_id, state) of the leftovers.

    ``pos`` counts within the line. Several requests of a line take one slice
    after the other, in time order; no article is served twice.

    A line (user, channel) with a cache is served from it; otherwise up to
    ``cap`` waiting articles move to the cache first. ``state`` tells what
    becomes of each article: 'served' in the answer, 'cached', or still
    'waiting' (at its stored position). Lines without leftovers do not appear
    and need a computed feed. The first ``cap`` rows of a line are found before
    the shuffle; the rest of a long list is never gathered in one task.
    """
    rows = waiting.select(*LINE, "pos", "article_id", F.lit(1).alias("level"))
    if cached is not None:
        rows = rows.unionByName(cached.select(*LINE, "pos", "article_id", F.lit(0).alias("level")))
    order = Window.partitionBy(*LINE).orderBy("level", "pos", "article_id")
    first = rows.withColumn("n", F.row_number().over(order)).where(F.col("n") <= cap)
    opened = first.withColumn("source", F.min("level").over(Window.partitionBy(*LINE))).where(
        F.col("level") == F.col("source")).drop("source")
    rest = rows.join(opened.drop("n"), [*LINE, "level", "pos", "article_id"], "left_anti").select(
        *LINE, "article_id", F.col("pos").cast("long").alias("pos"),
        F.when(F.col("level") == 0, "cached").otherwise("waiting").alias("state"))
    # An article goes to the one request whose slice it falls into, any other row to the line's last request.
    newest = requests.groupBy(*LINE).agg(F.max("time_stamp").alias("newest"))
    taken = opened.withColumn("n", F.col("n").cast("long")).join(_slots(requests, cap), [*LINE, "n"], "left").join(newest, LINE)
    served = taken.select(
        *LINE, F.coalesce("time_stamp", "newest").alias("time_stamp"), F.col("n").alias("pos"), "article_id",
        F.when(F.col("time_stamp").isNotNull(), "served").otherwise("cached").alias("state"))
    return served.unionByName(rest.join(newest.withColumnRenamed("newest", "time_stamp"), LINE))


def track_payload(feed: DataFrame) -> DataFrame:
    """(user_id, channel_id, time_stamp, param, recommends): what the client sends back.

    ``feed`` has one row per request: its key, ``strategy``, ``articles`` and
    ``route``; its paging cursor ``next_ts``, if there, is kept. ``param`` reports the exposure (empty when paging history),
    ``recommends`` has the click, collect, share and read messages per article.
    """
    def message(action: str, article: Column) -> Column:
        return F.to_json(F.struct(
            F.lit(action).alias("action"), F.col("user_id").cast("string").alias("userId"),
            article.cast("string").alias("articleId"), F.col("strategy").alias("algorithmCombine")))

    def per_article(article: Column) -> Column:
        return F.struct(article.alias("article_id"), F.struct(*[
            message(a, article).alias(a) for a in ("click", "collect", "share", "read")]).alias("param"))

    listed = F.concat(F.lit("["), F.array_join(F.col("articles").cast("array<string>"), ","), F.lit("]"))
    return feed.select(
        *REQUEST_KEY,
        F.when(F.col("route") == "history", "").otherwise(message("exposure", listed)).alias("param"),
        F.to_json(F.transform("articles", per_article)).alias("recommends"),
        *[c for c in feed.columns if c == "next_ts"])


def feed_rows_to_lists(feed: DataFrame) -> DataFrame:
    """One row per request with its ``articles`` in order (at most article_num)."""
    return feed.groupBy(*LINE, F.col("request_ts").alias("time_stamp")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "article_id"))),
                    lambda x: x["article_id"]).alias("articles"))
