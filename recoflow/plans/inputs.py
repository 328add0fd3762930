"""Named inputs of the catalogue, each derived from the provided tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recoflow.operators import actions, cells, ctr, keywords, profiles, recall, similar, vectors
from recoflow.session import in_rounds, materialize, round_is
from recoflow.sources import adapters as A

# Parameters of the catalogue; the SQL uses the same values.
NOW = "2024-02-01 00:00:00"
SPLIT = "2024-01-15"
INTEREST_DAYS = ["2024-02-01", "2024-02-15", "2024-06-01"]
READ_THRESHOLD = 100
DIM = 64
LSH = {"tables": 8, "per_table": 2, "bucket_length": 0.25, "threshold": 1.2, "dim": DIM}
LSH_NEW = {"tables": 6, "per_table": 1, "bucket_length": 2.0, "threshold": 6.0, "dim": DIM}
ROUND_ROWS, ROUNDS = 1 << 16, 8         # articles whose terms are ranked at once, in up to so many rounds
REQUEST_MS = 1706745600000
ARTICLE_NUM = 2


def now():
    return F.lit(NOW).cast("timestamp_ntz")


def millis(day):
    """Epoch milliseconds of a date."""
    return F.date_diff(day, F.lit("1970-01-01").cast("date")).cast("long") * 86400000


def scanned(spark, sf) -> DataFrame:
    return actions.actions_scan(A.action_log(spark, sf))


def folded(spark, sf) -> DataFrame:
    return actions.fold_actions(scanned(spark, sf))


def tokens(spark, sf) -> DataFrame:
    return keywords.tokenize(A.articles(spark, sf), stopwords=A.STOPWORDS)


def idf(spark, sf) -> DataFrame:
    """The IDF table, written once: it is small but costs a pass over all text."""
    return materialize(keywords.idf_table(tokens(spark, sf)), "idf")


def tfidf(spark, sf, known=None) -> DataFrame:
    return keywords.tfidf_topk(tokens(spark, sf), idf(spark, sf) if known is None else known)


def ranked(spark, sf) -> DataFrame:
    return keywords.textrank(A.articles(spark, sf), stopwords=A.STOPWORDS)


def tfidf_profile(spark, sf, known=None) -> DataFrame:
    """A profile whose weights are the TF-IDF values and whose topics are all
    keywords; written once, since features and interests both read it. All terms are
    shuffled twice, so this is done in rounds of articles."""
    words, known = tokens(spark, sf), idf(spark, sf) if known is None else known
    rounds = max(1, min(ROUNDS, -(-words.count() // ROUND_ROWS)))

    def part(r):
        return keywords.tfidf_topk(words.where(round_is(r, rounds, "article_id")), known).groupBy("article_id").agg(
            F.min("channel_id").alias("channel_id"),
            F.map_from_entries(F.array_sort(F.collect_list(F.struct("keyword", "tfidf")))).alias("keywords"),
            F.array_sort(F.collect_set("keyword")).alias("topics"))

    return in_rounds(spark, rounds, part, "profile")


def interests(spark, sf, profile=None) -> DataFrame:
    profile = tfidf_profile(spark, sf) if profile is None else profile
    return profiles.user_interests(folded(spark, sf), profile, now(), READ_THRESHOLD)


def keyword_vectors(spark, sf, known) -> tuple[DataFrame, DataFrame]:
    """(keyword, number) and (number, vector): each vocabulary term has the embedding numbered like the term."""
    e = A.vectors(spark, sf)
    n = e.agg(F.count(F.lit(1))).scalar()
    return (known.select("keyword", (F.col("index") % n).alias("number")),
            e.select(F.col("article_id").alias("number"), "vector"))


def text_vectors(spark, sf) -> DataFrame:
    """Article vectors from the profile and the keyword vectors."""
    known = idf(spark, sf)
    return vectors.numbered_vectors(tfidf_profile(spark, sf, known), *keyword_vectors(spark, sf, known))


def similar_table(spark, sf) -> DataFrame:
    return similar.similar_articles(A.vectors(spark, sf), **LSH)


def nearest_table(spark, sf) -> DataFrame:
    """The nearest articles, exactly."""
    return cells.nearest_articles(A.vectors(spark, sf), threshold=LSH["threshold"])


def lines(spark, sf, before: bool) -> DataFrame:
    """Distinct (user_id, channel_id, article_id) before or from the split day."""
    s = scanned(spark, sf)
    day = F.lit(SPLIT).cast("timestamp_ntz")
    part = s.where(F.col("action_time") < day if before else F.col("action_time") >= day)
    return actions.action_flags(part).select(*recall.RECALL_KEYS).distinct()


def served(spark, sf, every: bool = False) -> DataFrame:
    """Served history: one feed per user, channel and day, of all events or those before the split;
    'error' events count for the mixed channel 0."""
    from pyspark.sql import Window
    k = F.get_json_object("props", "$.k").cast("long")
    events = A.read(spark, sf, "events")
    rows = (events if every else events.where(F.col("ts") < F.lit(SPLIT).cast("timestamp_ntz"))).select(
        "event_id", "user_id",
        F.when(F.col("event_type") == "error", 0).otherwise(k % 25 + 1).cast("int").alias("channel_id"),
        millis(F.col("ts").cast("date")).alias("request_ts"), k.alias("article_id"))
    order = Window.partitionBy("user_id", "channel_id", "request_ts").orderBy("event_id")
    return rows.withColumn("pos", F.row_number().over(order).cast("long")).drop("event_id")


def stored_recall(spark, sf, every: bool = False) -> DataFrame:
    """Stored recall rows from all events or those since the split: purchases stand for
    als, clicks for content, signups for online."""
    source = (F.when(F.col("action") == "collect", "als").when(F.col("action") == "click", "content")
              .when(F.col("action") == "share", "online"))
    log = scanned(spark, sf)
    rows = (log if every else log.where(F.col("action_time") >= F.lit(SPLIT).cast("timestamp_ntz"))).select(
        "user_id", "channel_id", source.alias("recall_type"),
        F.col("article_ids").try_cast("long").alias("article_id"))
    return rows.where(F.col("recall_type").isNotNull()).distinct()


def arrived(spark, sf) -> DataFrame:
    from recoflow.sources.streams import new_article_stream
    return recall.arrivals(new_article_stream(A.new_article_messages(A.read(spark, sf, "events"))))


def hot(spark, sf) -> DataFrame:
    return recall.hot_scores(scanned(spark, sf))


def requests(spark, sf) -> DataFrame:
    """One request per user and channel of the log."""
    return scanned(spark, sf).select("user_id", "channel_id").distinct().select(
        "user_id", "channel_id", F.lit(ARTICLE_NUM).alias("article_num"),
        F.lit(REQUEST_MS).cast("long").alias("time_stamp"))


def features(spark, sf) -> tuple[DataFrame, DataFrame]:
    """(user features, article features), both from one profile."""
    profile = tfidf_profile(spark, sf)
    return (materialize(ctr.user_features(interests(spark, sf, profile)), "users"),
            ctr.article_features(profile, A.vectors(spark, sf)))


def samples(spark, sf, strict: bool = False) -> DataFrame:
    users, articles = features(spark, sf)
    return ctr.ctr_samples(folded(spark, sf), users, articles, dims=DIM + 21, strict=strict)


def label_scores(spark, sf) -> DataFrame:
    """(score, label): document length squashed to (0, 1) against its quality label."""
    return A.read(spark, sf, "labels").join(
        A.read(spark, sf, "documents").select("doc_id", "n_chars"), "doc_id").select(
        (F.col("n_chars") / (F.col("n_chars") + 2000)).alias("score"), F.col("quality").alias("label"))
