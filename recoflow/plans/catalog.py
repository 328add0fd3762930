"""The catalogue: every operator as a query over the provided tables.

Each function takes (spark, sf_dir) and returns a DataFrame; ``oracles`` holds
the same result as SQL. Values are rounded and arrays summarised so that both
engines can be compared exactly.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recoflow.functions import keys as K
from recoflow.functions.text import strip_tags
from recoflow.functions.vectors import total
from recoflow.operators import (actions, articles, asof, cells, ctr, evaluation, feed, frequencies, history, interest_days,
                                keywords, products, profiles, recall, similar, vectors)
from recoflow.plans import inputs as I
from recoflow.session import materialize, scratch_dir
from recoflow.sources import adapters as A
from recoflow.sources import streams, tables
from recoflow.streaming import online

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _r(col: str, places: int = 6):
    return F.round(F.col(col), places).alias(col)


# -- action log ---------------------------------------------------------------

@query
def actions_scan(spark, sf):
    """Partition-bounded scan of the nested log."""
    return actions.actions_scan(A.action_log(spark, sf), "2024-01-20").select(
        "user_id", "action_time", "channel_id", "action",
        F.regexp_replace("article_ids", "[^0-9,]", "").alias("article_ids"), "algorithm")


@query
def exposure_flags(spark, sf):
    """Exposure lists exploded, actions as flags: totals per user and channel."""
    flags = actions.action_flags(I.scanned(spark, sf))
    return flags.groupBy("user_id", "channel_id", "article_id").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(F.col(f).cast("long")).alias(f) for f in actions.FLAGS])


@query
def user_article_basic(spark, sf):
    return I.folded(spark, sf)


@query
def action_merge(spark, sf):
    """Old user x article table on disk, brought up to date and replaced in place."""
    log = I.scanned(spark, sf)
    day = F.lit(I.SPLIT).cast("timestamp_ntz")
    path = scratch_dir(spark, "user-article")
    actions.fold_actions(log.where(F.col("action_time") < day)).write.parquet(path)
    merged = actions.merge_actions(tables.table(spark, path), log.where(F.col("action_time") >= day))
    tables.replace(merged, path)
    return tables.table(spark, path)


# -- users --------------------------------------------------------------------

@query
def interest_weights(spark, sf):
    return I.interests(spark, sf).select("user_id", "channel_id", "topic", _r("weight"))


@query
def interest_top10(spark, sf):
    return profiles.top_interests(I.interests(spark, sf)).select(
        "user_id", "channel_id", "topic", _r("weight"), "rank")


@query
def interest_by_day(spark, sf):
    """Sums by day of the actions before the split, then changed by those after it, read for three days."""
    log, topics = I.scanned(spark, sf), I.tfidf_profile(spark, sf)
    day = F.lit(I.SPLIT).cast("timestamp_ntz")
    old = materialize(actions.fold_actions(log.where(F.col("action_time") < day)), "old")
    before, after = interest_days.changed_pairs(old, log.where(F.col("action_time") >= day))
    sums = lambda table: interest_days.day_sums(table, topics, I.READ_THRESHOLD)
    merged = interest_days.merge_sums([sums(old), sums(after)], [sums(before)])
    number = lambda d: F.date_diff(F.lit(d).cast("date"), F.lit("1970-01-01").cast("date"))
    found = interest_days.interests_on(merged, *map(number, I.INTEREST_DAYS))
    names = F.array(*map(F.lit, I.INTEREST_DAYS))
    return found.select(F.get(names, F.col("nth")).alias("day"), "user_id", "channel_id", "topic", _r("weight"))


@query
def interest_map(spark, sf):
    """The stored map form, and back again through prefixed ids and compound keys."""
    stored = profiles.interest_map(I.interests(spark, sf)).withColumn(
        "user_id", F.concat(F.lit("user:"), F.col("user_id").cast("string")))
    return profiles.user_profile_scan(stored).select("user_id", "channel_id", "topic", _r("weight"))


@query
def profile_basics(spark, sf):
    return profiles.user_basics(A.users(spark, sf), F.lit("2024-02-28").cast("date"))


# -- articles and text --------------------------------------------------------

@query
def window_merge(spark, sf):
    basic, content, channels = A.news(spark, sf)
    bound = lambda d: F.lit(d).cast("timestamp_ntz")
    return articles.merge_articles(basic, content, channels, bound("1995-01-01"), bound("1997-01-01")).select(
        "article_id", "channel_id", "channel_name", "sentence")


@query
def strip_html(spark, sf):
    clean = strip_tags(F.col("html"))
    return A.read(spark, sf, "pages").select(
        "page_id", F.length(clean).cast("long").alias("n_chars"), F.md5(clean.cast("binary")).alias("digest"))


@query
def tokens(spark, sf):
    return I.tokens(spark, sf).select(
        "article_id", "channel_id", F.size("words").cast("long").alias("n"),
        F.md5(F.array_join("words", " ").cast("binary")).alias("digest"))


@query
def term_counts(spark, sf):
    entry = lambda t: F.concat_ws(":", t["term"], t["tf"].cast("string"))
    return keywords.term_counts(I.tokens(spark, sf)).select(
        "article_id", F.size("terms").cast("long").alias("n_terms"),
        F.md5(F.array_join(F.transform("terms", entry), ",").cast("binary")).alias("digest"))


@query
def idf_table(spark, sf):
    return I.idf(spark, sf).select("keyword", _r("idf"), F.col("index").alias("idx"))


@query
def idf_hours(spark, sf):
    """Every article published twice, the first time with other words, in hours that come out of order."""
    tok, path = I.tokens(spark, sf), scratch_dir(spark, "frequencies")
    first = tok.withColumn("words", F.slice(F.concat(F.array(F.lit("first"), F.lit("draft")), "words"), 1, F.size("words") + 1))
    early = F.col("channel_id") <= 12
    hours = [("2024013100", first), ("2024013102", tok.where(~early)), ("2024013101", tok.where(early | early.isNull())),
             ("2024013103", tok.where(~early))]
    for hour, published in hours:
        frequencies.add_hour(published, path, hour, buckets=8)
    return frequencies.idf_table(spark, path).select("keyword", _r("idf"), F.col("index").alias("idx"))


@query
def tfidf_top20(spark, sf):
    return I.tfidf(spark, sf)


@query
def textrank_top20(spark, sf):
    return I.ranked(spark, sf)


@query
def keyword_weights(spark, sf):
    return keywords.keyword_weights(I.ranked(spark, sf), I.idf(spark, sf)).select(
        "article_id", "channel_id", "keyword", _r("weight", 5))


@query
def article_topics(spark, sf):
    return keywords.topics(I.tfidf(spark, sf), I.ranked(spark, sf)).select(
        "article_id", F.array_join("topics", ",").alias("topics"))


@query
def global_topics(spark, sf):
    return keywords.topics(I.tfidf(spark, sf), I.ranked(spark, sf), global_topics=True).select(
        "article_id", F.array_join("topics", ",").alias("topics"))


@query
def article_profile(spark, sf):
    known = I.idf(spark, sf)
    profile = keywords.article_profile(I.ranked(spark, sf), I.tfidf(spark, sf, known), known)
    return profile.select(
        "article_id", "channel_id",
        F.array_join(F.map_keys("keywords"), ",").alias("keywords"),
        F.round(total(F.map_values("keywords")), 4).alias("weight"),
        F.array_join("topics", ",").alias("topics"))


# -- vectors and similar articles ---------------------------------------------

@query
def word2vec_vocabulary(spark, sf):
    """One Word2Vec model per channel; which words got a vector, and its length."""
    tok = materialize(I.tokens(spark, sf), "tokens", ["channel_id"])
    channels = sorted(r[0] for r in tok.select("channel_id").distinct().collect())
    return vectors.stored_word_vectors(tok, channels, by_channel=True).select(
        "channel_id", "keyword", F.size("vector").cast("long").alias("dims"))


@query
def article_vector_mean(spark, sf):
    return I.text_vectors(spark, sf).select("article_id", "channel_id", F.size("vector").cast("long").alias("dims"),
                    F.round(F.get("vector", F.lit(0)), 6).alias("first"),
                    F.round(F.get("vector", F.lit(I.DIM - 1)), 6).alias("last"),
                    F.round(total(F.col("vector")), 5).alias("total"))


@query
def similar_top10(spark, sf):
    return I.similar_table(spark, sf)


@query
def similar_incremental(spark, sf):
    """New article vectors (from text) against the known ones of their channel."""
    return similar.similar_articles(I.text_vectors(spark, sf), A.vectors(spark, sf), **I.LSH_NEW)


@query
def nearest_top10(spark, sf):
    return I.nearest_table(spark, sf)


@query
def nearest_indexed(spark, sf):
    """New article vectors (from text) against a stored index of the known ones."""
    path, known = scratch_dir(spark, "vector-index"), A.vectors(spark, sf)
    cells.create_index(spark, path, cells.fit_centres(known))
    cells.add_to_index(path, known, "2024013100", buckets=8)
    return cells.search_index(path, I.text_vectors(spark, sf), I.LSH_NEW["threshold"])


@query
def similar_topn(spark, sf):
    ids = A.articles(spark, sf).select("article_id")
    return similar.similar_topn(ids, I.nearest_table(spark, sf), 3)


# -- recall -------------------------------------------------------------------

@query
def content_recall(spark, sf):
    clicks = I.folded(spark, sf).where("clicked").select("user_id", "channel_id", "article_id")
    return recall.content_recall(clicks, I.nearest_table(spark, sf), I.lines(spark, sf, True))


@query
def history_anti(spark, sf):
    return recall.exclude_history(I.lines(spark, sf, False), I.lines(spark, sf, True))


@query
def dense_ids(spark, sf):
    """Dense numbering of order and part keys: n ids, n numbers, largest number."""
    items = A.read(spark, sf, "lineitem")
    parts = []
    for col in ("l_orderkey", "l_partkey"):
        parts.append(recall.dense_index(items, col).agg(
            F.lit(col).alias("key"), F.count(F.lit(1)).alias("n"),
            F.countDistinct("idx").alias("n_idx"), F.max("idx").alias("max_idx")))
    return parts[0].unionByName(parts[1])


@query
def als_recall(spark, sf):
    """Collaborative recall per user with its channel, history removed (no SQL twin)."""
    found = recall.als_recall(I.folded(spark, sf), I.folded(spark, sf), k=20)
    channels = I.folded(spark, sf).select("article_id", (F.col("article_id") % 25 + 1).cast("int").alias("channel_id"))
    return recall.exclude_history(
        recall.with_channel(found, channels.distinct()), I.lines(spark, sf, True)).select(
        "user_id", "channel_id", "article_id", _r("score", 4))


@query
def inner_top10(spark, sf):
    """The exact search behind collaborative recall: vectors in whole thousandths as factors of users and articles."""
    factors = A.read(spark, sf, "embeddings").select("vec_id", F.transform(
        "embedding", lambda x: F.floor(x.cast("double") * 1000).cast("double")).alias("vector"))
    return products.top_products(factors.withColumnRenamed("vec_id", "user_id"),
                                 factors.withColumnRenamed("vec_id", "article_id"), "user_id", "article_id", 10)


@query
def als_factor_checks(spark, sf):
    """For every listed user: scores are the products of the factors. Over all pairs: the error is below that of
    no model (all zeros), and clicked pairs score higher than others. The model has no constant term, and its
    error need not be below that of the mean. That nothing better is left out, inner_top10 and the tests check."""
    done = materialize(I.folded(spark, sf), "folded")
    users, articles_ = recall.als_factors(done)
    found = products.top_products(users, articles_, "user_id", "article_id", 20)
    named = lambda pairs: (pairs.join(users.withColumnRenamed("vector", "u"), "user_id")
                           .join(articles_.withColumnRenamed("vector", "a"), "article_id")
                           .withColumn("dot", F.aggregate(F.zip_with("u", "a", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)))
    r = F.col("clicked").cast("double")
    fit = named(done.select("user_id", "article_id", "clicked")).agg(
        (F.avg((r - F.col("dot")) ** 2) < F.avg(r * r)).alias("beats_zeros"),
        (F.avg(F.when(r == 1, F.col("dot"))) > F.avg(F.when(r == 0, F.col("dot")))).alias("clicks_higher"))
    fit = materialize(fit, "fit")
    checks = named(found).groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n"), F.bool_and(F.abs(F.col("score") - F.col("dot")) < 1e-9).alias("products"))
    return checks.withColumn("beats_zeros", fit.select("beats_zeros").scalar()).withColumn(
        "clicks_higher", fit.select("clicks_higher").scalar())


@query
def als_recall_checks(spark, sf):
    """For every user of the log: at most k articles, all of the log, none had before, best first."""
    done = materialize(I.folded(spark, sf), "folded")
    found = materialize(recall.als_recall(done, done, k=20), "found")
    kept = recall.exclude_history(found.withColumn("channel_id", F.lit(0)), done.where("clicked").select(
        "user_id", F.lit(0).alias("channel_id"), "article_id"))
    order = Window.partitionBy("user_id").orderBy(F.desc("score"), "article_id")
    ranked = kept.withColumn("rank", F.row_number().over(order)).withColumn("last", F.lag("score").over(order))
    known = done.select("article_id").distinct().withColumn("known", F.lit(True))
    had = done.where("clicked").select("user_id", "article_id", F.lit(True).alias("had"))
    checks = (ranked.join(known, "article_id", "left").join(had, ["user_id", "article_id"], "left").groupBy("user_id").agg(
        (F.max("rank") <= 20).alias("few"), F.bool_and(F.col("known").isNotNull()).alias("known"),
        F.bool_and(F.col("had").isNull()).alias("fresh"),
        F.bool_and(F.col("last").isNull() | (F.col("last") >= F.col("score"))).alias("falling")))
    users = done.select("user_id").distinct()
    return users.join(checks, "user_id", "left").select("user_id", *[
        F.coalesce(c, F.lit(True)).alias(c) for c in ("few", "known", "fresh", "falling")])


@query
def hot_top10(spark, sf):
    return recall.hot_articles(I.hot(spark, sf))


@query
def hot_parts(spark, sf):
    """Hot ranking of the largest table: parts by order status."""
    items = A.read(spark, sf, "lineitem").select("l_orderkey", "l_partkey")
    orders = A.read(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    scores = items.join(orders, items.l_orderkey == orders.o_orderkey).groupBy(
        F.col("o_orderstatus").alias("channel_id"), F.col("l_partkey").alias("article_id")).agg(
        F.count(F.lit(1)).alias("score"))
    return recall.hot_articles(scores)


@query
def new_articles(spark, sf):
    return recall.new_articles(I.arrived(spark, sf), 10).select(
        "channel_id", "article_id", F.col("arrived").cast("timestamp_ntz").alias("arrived"), "rank")


@query
def read_recall(spark, sf):
    return recall.read_recall(I.stored_recall(spark, sf, every=True), ["als", "online"])


def _recall_union(spark, sf, every):
    return recall.recall_union(
        feed.assign_strategy(I.requests(spark, sf)), I.stored_recall(spark, sf, every), I.arrived(spark, sf),
        recall.hot_articles(I.hot(spark, sf)), feed.strategy_table(spark),
    ).select("user_id", "channel_id", "strategy", "article_id", F.array_join("sources", ",").alias("sources"))


@query
def recall_union(spark, sf):
    """With stored rows since the split, as its SQL has them; recall_union_all takes them all."""
    return _recall_union(spark, sf, every=False)


@query
def recall_union_all(spark, sf):
    return _recall_union(spark, sf, every=True)


# -- served history as bitmaps -------------------------------------------------

@query
def served_bitmaps(spark, sf):
    """Bitmaps of the feeds before the split, brought up to date with those since."""
    rows = materialize(I.served(spark, sf, every=True), "served")
    new = F.col("request_ts") >= I.millis(F.lit(I.SPLIT).cast("date"))
    merged = history.merge_bitmaps(history.served_bitmaps(rows.where(~new)), history.served_bitmaps(rows.where(new)))
    return merged.select("user_id", "channel_id", "part", F.bitmap_count("bits").alias("n_articles"))


@query
def bought_bitmaps(spark, sf):
    """The same on the largest table: distinct parts per customer and order status."""
    orders = A.read(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    items = A.read(spark, sf, "lineitem").select("l_orderkey", "l_partkey")
    rows = items.join(orders, items.l_orderkey == orders.o_orderkey).select(
        F.col("o_custkey").alias("user_id"), F.col("o_orderstatus").alias("channel_id"), F.col("l_partkey").alias("article_id"))
    return history.served_bitmaps(rows).select("user_id", "channel_id", "part", F.bitmap_count("bits").alias("n_articles"))


@query
def unseen_candidates(spark, sf):
    """All recalled candidates that the bitmaps of the whole history do not hold."""
    seen = history.served_bitmaps(I.served(spark, sf, every=True))
    return history.exclude_seen(_recall_union(spark, sf, every=True), seen).select("user_id", "channel_id", "article_id")


# -- click-through features, model, evaluation --------------------------------

@query
def timely_samples(spark, sf):
    """Each action with its user's totals up to the day before."""
    return asof.timely_samples(I.scanned(spark, sf)).select(
        "user_id", "action_time", "channel_id", "clicked", "valid_from", "n_clicks", "n_actions")


@query
def user_features(spark, sf):
    return I.features(spark, sf)[0].select(
        "user_id", "channel_id", F.size("weights").cast("long").alias("n"),
        F.round(total(F.col("weights")), 5).alias("total"))


@query
def article_features(spark, sf):
    f = F.col("features")
    profile = I.tfidf_profile(spark, sf)
    return ctr.article_features(profile, A.vectors(spark, sf)).select(
        "article_id", "channel_id", F.size(f).cast("long").alias("n"),
        F.round(f[0], 6).alias("channel"), F.round(total(F.slice(f, 2, 10)), 4).alias("weights"),
        F.round(total(F.slice(f, 12, I.DIM)), 5).alias("vector"))


def _samples_view(df):
    f = F.col("features")
    return df.select("user_id", "article_id", "channel_id", F.size(f).cast("long").alias("n"),
                     F.round(total(F.slice(f, 2, I.DIM)), 5).alias("vector"),
                     F.round(total(F.slice(f, I.DIM + 2, 10)), 5).alias("user"),
                     F.round(total(F.slice(f, I.DIM + 12, 10)), 4).alias("article"), "clicked")


@query
def ctr_samples(spark, sf):
    return _samples_view(I.samples(spark, sf))


@query
def ctr_samples_strict(spark, sf):
    return _samples_view(I.samples(spark, sf, strict=True))


@query
def feature_means(spark, sf):
    return ctr.feature_means(I.samples(spark, sf), dim=I.DIM).select(
        "user_id", "article_id", "channel_id", _r("vector_mean"), _r("user_mean"),
        _r("article_mean"), "clicked")


@query
def export_samples(spark, sf):
    path = scratch_dir(spark, "samples")
    ctr.export_samples(I.samples(spark, sf), path)
    return spark.read.parquet(path).groupBy("label").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.size("features")).cast("long").alias("n_values"))


@query
def ctr_scores(spark, sf):
    """Fit, save, load and apply the click model (scores have no SQL twin)."""
    samples = materialize(I.samples(spark, sf), "samples")
    path = scratch_dir(spark, "ctr-model")
    ctr.save_model(ctr.train_ctr(samples), path)
    return ctr.score_ctr(ctr.load_model(path), samples).select(
        "user_id", "article_id", "clicked", _r("score"))


@query
def ctr_model_checks(spark, sf):
    """The fitted click model on its rows: at convergence the mean score is the click
    rate; scores are probabilities; the log loss beats the constant; clicks rank higher."""
    scored = materialize(ctr_scores(spark, sf), "scored")
    area = evaluation.auc_accuracy(scored.select("score", F.col("clicked").alias("label"))).select("auc")
    p = F.least(F.greatest(F.col("score"), F.lit(1e-9)), F.lit(1 - 1e-9))
    rate = F.avg("clicked")
    sums = scored.agg(
        F.count(F.lit(1)).alias("n"), F.round(rate, 6).alias("click_rate"),
        (F.abs(F.avg("score") - rate) < 1e-3).alias("calibrated"),
        F.bool_and(F.col("score").between(0, 1)).alias("probabilities"),
        (F.avg(-F.log(F.when(F.col("clicked") == 1, p).otherwise(1 - p)))
         < -(rate * F.log(rate) + (1 - rate) * F.log(1 - rate))).alias("better_than_constant"))
    return sums.withColumn("clicks_rank_higher", area.scalar() > 0.5)


@query
def auc_accuracy(spark, sf):
    return evaluation.auc_accuracy(I.label_scores(spark, sf)).select(_r("auc"), _r("accuracy"), "n")


@query
def roc_curve(spark, sf):
    return evaluation.roc_curve(I.label_scores(spark, sf)).select(
        _r("threshold", 8), _r("fpr"), _r("tpr"))


# -- feeds --------------------------------------------------------------------

@query
def ab_bucket(spark, sf):
    """Bucket, strategy, recall sources and ranking service of every customer."""
    who = A.read(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"))
    return feed.assign_strategy(who).join(feed.strategy_table(spark), "strategy").select(
        "user_id", "bucket", "strategy", F.explode("sources").alias("source"), "sort")


def sigmoid_of_mean(features):
    """A fixed scoring expression that SQL can repeat."""
    return F.round(1.0 / (1.0 + F.exp(-total(features) / 100.0)), 8)


def _feed(spark, sf):
    users, articles_ = I.features(spark, sf)
    return feed.generate_feed(
        I.requests(spark, sf), I.stored_recall(spark, sf), I.arrived(spark, sf),
        recall.hot_articles(I.hot(spark, sf)), I.served(spark, sf), users, articles_,
        feed.strategy_table(spark), history.served_bitmaps(I.served(spark, sf)), score=sigmoid_of_mean, dim=I.DIM)


@query
def feed_split(spark, sf):
    """First articles of every request."""
    return _feed(spark, sf)[0]


@query
def wait_split(spark, sf):
    """What the feeds leave for later."""
    return _feed(spark, sf)[1]


@query
def serve_waiting(spark, sf):
    waiting = I.lines(spark, sf, False).withColumn("pos", F.col("article_id"))
    served = I.served(spark, sf)
    newest = feed.last_served(served).withColumnRenamed("last_ts", "request_ts")
    cached = served.join(newest, ["user_id", "channel_id", "request_ts"]).select(
        "user_id", "channel_id", "pos", "article_id")
    return feed.serve_waiting(I.requests(spark, sf), waiting, cached, cap=3)


@query
def serve_lines(spark, sf):
    """A request per user, channel and day: those of one line share its leftovers."""
    log = I.scanned(spark, sf)
    asked = log.select("user_id", "channel_id", I.millis(F.col("action_time").cast("date")).alias("time_stamp")).distinct()
    waiting = I.lines(spark, sf, True).union(I.lines(spark, sf, False)).distinct().withColumn("pos", F.col("article_id"))
    return feed.serve_waiting(asked.withColumn("article_num", F.lit(I.ARTICLE_NUM)), waiting, cap=5)


@query
def last_served(spark, sf):
    return feed.last_served(I.served(spark, sf, every=True))


@query
def refresh_or_history(spark, sf):
    asks = I.requests(spark, sf).withColumn("time_stamp", F.lit(1704844800000))
    return feed.route_requests(asks, I.served(spark, sf, every=True)).select(
        "user_id", "channel_id", "last_ts", "route")


@query
def history_page(spark, sf):
    """Pages at, after and before every served feed."""
    served = I.served(spark, sf, every=True)
    asks = served.select("user_id", "channel_id", F.explode(F.array(
        F.col("request_ts"), F.col("request_ts") + 3600000, F.lit(1).cast("long"))).alias("time_stamp")).distinct()
    return feed.history_page(asks, served).select(
        "user_id", "channel_id", "time_stamp",
        F.array_join(F.col("articles").cast("array<string>"), ",").alias("articles"), "next_ts")


@query
def track_payload(spark, sf):
    served = I.served(spark, sf, every=True)
    lists = feed.assign_strategy(feed.feed_rows_to_lists(served))
    # the cursor of a feed: the time of the one before it
    pages = feed.history_page(lists.select(*feed.REQUEST_KEY), served)
    lists = lists.join(pages.select(*feed.REQUEST_KEY, "next_ts"), feed.REQUEST_KEY)
    route = F.when(F.col("channel_id") == 0, "history").otherwise("refresh")
    return feed.track_payload(lists.withColumn("route", route))


# -- keyed tables -------------------------------------------------------------

def _orders(spark, sf):
    return A.read(spark, sf, "orders").select("o_custkey", "o_orderdate", "o_orderkey")


@query
def latest_upsert(spark, sf):
    """A keyed store of each customer's last order: created, then upserted."""
    orders, path = _orders(spark, sf), scratch_dir(spark, "store")
    old = F.col("o_orderdate") < F.lit("1997-01-01").cast("timestamp_ntz")
    tables.create_store(orders.where(old), path, ["o_custkey"], "o_orderdate", buckets=8)
    tables.upsert(orders.where(~old), path, ["o_custkey"], "o_orderdate")
    return tables.read_store(spark, path)


@query
def version_read(spark, sf):
    return tables.latest_versions(_orders(spark, sf), ["o_custkey"], "o_orderdate", 3,
                                  before=F.lit("1998-01-01").cast("timestamp_ntz"))


@query
def delete_keys(spark, sf):
    customers = A.read(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    pending = A.read(spark, sf, "orders").where(F.col("o_orderstatus") == "P").select("o_custkey")
    return tables.delete_keys(customers, pending, ["o_custkey"])


@query
def append_read(spark, sf):
    """Two appended halves of a partitioned table read back."""
    path = scratch_dir(spark, "log")
    log = A.action_log(spark, sf).select("dt", "channelId", "param")
    cut = F.lit(I.SPLIT).cast("date")
    tables.append(log.where(F.col("dt") < cut), path, ["dt"])
    tables.append(log.where(F.col("dt") >= cut), path, ["dt"])
    return tables.table(spark, path).groupBy("dt", F.col("channelId").alias("channel_id")).agg(
        F.count(F.lit(1)).alias("n"))


@query
def remap_ids(spark, sf):
    table = {3: 1, 14: 2, 15: 3, 92: 4, 65: 5, 35: 6, 89: 7, 79: 8, 32: 9}
    rows = I.folded(spark, sf).select("user_id", "article_id", "clicked")
    return K.remap(rows, "article_id", table, 10).groupBy("article_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("clicked").cast("long")).alias("clicks"))


# -- streams ------------------------------------------------------------------

def _event_stream(spark, sf):
    schema = A.read(spark, sf, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)


def _run(spark, start, source, *args):
    path, checkpoint = scratch_dir(spark, "sink"), scratch_dir(spark, "progress")
    start(source, *args, path, checkpoint, once=True).awaitTermination()
    return path


@query
def stream_hot(spark, sf):
    clicks = streams.click_stream(A.click_messages(_event_stream(spark, sf)))
    path = _run(spark, lambda s, p, c, once: online.stream_hot(s, p, c, once, buckets=8), clicks)
    return tables.read_store(spark, path).select("channel_id", "article_id", "score")


@query
def stream_new(spark, sf):
    arrived = streams.new_article_stream(A.new_article_messages(_event_stream(spark, sf)))
    path = _run(spark, lambda s, p, c, once: online.stream_new(s, p, c, once, buckets=8), arrived)
    return tables.read_store(spark, path).select(
        "channel_id", "article_id", F.col("arrived").cast("timestamp_ntz").alias("arrived"))


@query
def stream_recall_state(spark, sf):
    """The same recalls with the recalled keys in the state store."""
    clicks = streams.click_stream(A.click_messages(_event_stream(spark, sf)))
    near = materialize(I.nearest_table(spark, sf), "similar")
    found = _run(spark, online.stream_found, clicks, lambda: near)
    path = _run(spark, lambda source, *args, once: online.stream_first_recalls(spark, source, *args, once=once), found)
    return recall.read_recall(spark.read.parquet(path), ["online"]).select("user_id", "channel_id", "article_id")


@query
def stream_recall(spark, sf):
    clicks = streams.click_stream(A.click_messages(_event_stream(spark, sf)))
    near = materialize(I.nearest_table(spark, sf), "similar")
    path = _run(spark, online.stream_content_recall, clicks, lambda: near)
    return recall.read_recall(spark.read.parquet(path), ["online"]).select("user_id", "channel_id", "article_id")
