import pytest

from recoflow.operators import feed, recall


def lines(spark, data):
    return spark.createDataFrame(data, "user_id long, channel_id int, article_id long")


def test_dense_index(spark):
    ids = [10**12 + 7 * i for i in range(500)] * 2
    df = spark.createDataFrame([(i,) for i in ids], "id long")
    out = {r["id"]: r["idx"] for r in recall.dense_index(df, "id", buckets=16).collect()}
    assert set(out) == set(ids) and sorted(out.values()) == list(range(500))


@pytest.fixture(scope="module")
def clicks(spark):
    data = [(10**11 + u, 10**10 + a, (u + a) % 2 == 0) for u in range(12) for a in range(10) if (u * a) % 7 != 3]
    return spark.createDataFrame(data, "user_id long, article_id long, clicked boolean")


def test_als_recall(spark, clicks, rows):
    out = recall.als_recall(clicks, clicks, k=4)
    per_user = out.groupBy("user_id").count().collect()
    assert len(per_user) == 12 and all(r["count"] == 4 for r in per_user)
    assert rows(out) == rows(recall.als_recall(clicks, clicks, k=4))  # same seed, same result
    best = {(r["user_id"], r["article_id"]): r["score"] for r in out.collect()}
    liked = {(r["user_id"], r["article_id"]) for r in clicks.collect() if r["clicked"]}
    hits = [s for key, s in best.items() if key in liked]
    assert sum(hits) / len(hits) > 0.5
    some = recall.als_recall(clicks, k=4, users=clicks.where("user_id < 100000000003"))
    assert rows(some) == [r for r in rows(out) if r[0] < 10**11 + 3]


def test_content_recall_filters_history(spark, rows):
    similar = spark.createDataFrame([(1, 2, 1), (1, 3, 2), (1, 4, 3), (5, 3, 1)],
                                    "article_id long, similar_id long, rank int")
    clicks, history = lines(spark, [(7, 1, 1), (7, 1, 5), (8, 1, 1), (8, 1, 6)]), lines(spark, [(7, 1, 2), (8, 2, 2)])
    out = recall.content_recall(clicks, similar, history, k=2).select("user_id", "channel_id", "article_id")
    assert rows(out) == [(7, 1, 3), (8, 1, 2), (8, 1, 3)]


def test_hot_articles(spark, rows):
    data = [(1, "click", "5")] * 3 + [(1, "share", "6")] * 3 + [(1, "exposure", "[7]")] * 9 + [
        (1, "read", "7")] * 9 + [(2, "collect", "8")]
    df = spark.createDataFrame(data, "channel_id int, action string, article_ids string")
    out = recall.hot_articles(recall.hot_scores(df), 2).select("channel_id", "rank", "article_id", "score")
    assert rows(out) == [(1, 1, 5, 3), (1, 2, 6, 3), (2, 1, 8, 1)]


def test_new_articles_newest_first(spark, rows):
    df = spark.createDataFrame([(1, 5, 10), (1, 5, 30), (1, 6, 20), (1, 7, 5)],
                               "channel_id int, article_id long, arrived long")
    out = recall.new_articles(recall.arrivals(df), 2).select("rank", "article_id", "arrived")
    assert rows(out) == [(1, 5, 30), (2, 6, 20)]


def test_recall_union_of_five_sources(spark, rows):
    requests = feed.assign_strategy(spark.createDataFrame(
        [(1, 4, 2, 99), (2, 4, 2, 99), (1, 5, 2, 99)],
        "user_id long, channel_id int, article_num int, time_stamp long"))
    stored = spark.createDataFrame(
        [(1, 4, "als", 10), (1, 4, "content", 10), (1, 4, "online", 11), (2, 5, "als", 12)],
        "user_id long, channel_id int, recall_type string, article_id long")
    new = spark.createDataFrame([(4, 11), (4, 13)], "channel_id int, article_id long")
    hot = spark.createDataFrame([(4, 13), (6, 14)], "channel_id int, article_id long")
    out = recall.recall_union(requests, stored, new, hot, feed.strategy_table(spark))
    assert rows(out.select("user_id", "channel_id", "article_id", "sources")) == [
        (1, 4, 10, ["als", "content"]), (1, 4, 11, ["new", "online"]), (1, 4, 13, ["hot", "new"]),
        (2, 4, 11, ["new"]), (2, 4, 13, ["hot", "new"])]


def test_read_recall(spark, rows):
    df = recall.recall_rows(lines(spark, [(1, 1, 5)]), "als").unionByName(
        recall.recall_rows(lines(spark, [(1, 1, 6)]), "online"))
    assert rows(recall.read_recall(df, ["online"])) == [(1, 1, "online", 6)]


def test_recall_union_takes_all_stored_rows(spark):
    """Stored rows before the split are recalled too."""
    from conftest import SF
    from recoflow.plans import catalog, inputs
    early = inputs.stored_recall(spark, SF, every=True).subtract(inputs.stored_recall(spark, SF))
    assert early.count() > 0
    got = catalog.QUERIES["recall_union_all"](spark, SF)
    missing = early.join(got, ["user_id", "channel_id", "article_id"], "left")
    assert missing.where("sources IS NULL OR NOT array_contains(split(sources, ','), recall_type)").count() == 0
