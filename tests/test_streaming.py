"""Streams over several arriving files equal their batch results."""

import json

import pytest

from recoflow.operators import recall
from recoflow.sources import streams, tables
from recoflow.streaming import online


KEYS = ["user_id", "channel_id", "article_id"]


def line(action, user, article, channel=18):
    return json.dumps({"actionTime": "2021-06-05 10:20:30", "readTime": "", "channelId": channel,
                       "param": {"action": action, "userId": user, "articleId": article, "algorithmCombine": "C2"}})


@pytest.fixture()
def inbox(spark, tmp_path):
    """Write batches of messages as files; read them as a stream, one file per batch."""
    folder = tmp_path / "inbox"
    folder.mkdir()

    def put(name, lines):
        (folder / name).write_text("\n".join(lines) + "\n")

    def stream():
        return spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(str(folder))

    return put, stream


def test_messages_are_parsed(spark):
    df = spark.createDataFrame([(line("click", "2", "30011"),), ("not json",)], "value string")
    out = streams.click_stream(df).where("action is not null").collect()
    assert len(out) == 1
    assert (out[0]["user_id"], out[0]["article_ids"], out[0]["channel_id"]) == (2, "30011", 18)
    assert str(out[0]["action_time"]) == "2021-06-05 10:20:30"


def test_hot_store_over_restarts(spark, rows, tmp_path, inbox):
    put, stream = inbox
    store, progress = str(tmp_path / "hot"), str(tmp_path / "progress")
    run = lambda: online.stream_hot(streams.click_stream(stream()), store, progress, once=True,
                                    buckets=4).awaitTermination()
    put("a", [line("click", "1", "5"), line("share", "2", "5"), line("read", "2", "5"), line("exposure", "2", "[5,6]")])
    put("b", [line("collect", "3", "6"), line("click", "4", "5")])
    run()
    put("c", [line("click", "9", "6"), line("click", "9", "7", channel=3)])
    run()
    run()  # nothing new: nothing counted again
    out = tables.read_store(spark, store).select("channel_id", "article_id", "score")
    assert rows(out) == [(18, 5, 3), (18, 6, 2), (3, 7, 1)]
    assert rows(recall.hot_articles(out, 1).select("channel_id", "article_id")) == [(18, 5), (3, 7)]


def test_windowed_hot_counts(spark, tmp_path, inbox):
    put, stream = inbox
    put("a", [line("click", "1", "5"), line("click", "2", "5")])
    counts = online.hot_counts(streams.click_stream(stream()), watermark="1 hour", window="1 day")
    q = (counts.writeStream.outputMode("update").format("memory").queryName("hot_window")
         .option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start())
    q.awaitTermination()
    row = spark.table("hot_window").collect()[0]
    assert row["score"] == 2 and str(row["window"]["start"]) == "2021-06-05 00:00:00"


def test_new_articles_last_arrival_wins(spark, rows, tmp_path, inbox):
    put, stream = inbox
    store, progress = str(tmp_path / "new"), str(tmp_path / "progress")

    def run():
        from pyspark.sql import functions as F
        part = F.split("value", ";")
        messages = stream().select(part[0].alias("value"), part[1].cast("timestamp").alias("timestamp"))
        online.stream_new(streams.new_article_stream(messages), store, progress, once=True, buckets=4).awaitTermination()

    put("a", ["18,30011;2024-01-01 00:00:00", "18,5;2024-01-01 00:00:09"])
    run()
    put("b", ["18,30011;2024-01-02 00:00:00", "3,5;2024-01-01 00:00:01"])
    run()
    out = tables.read_store(spark, store).selectExpr("channel_id", "article_id", "string(arrived)")
    assert rows(out) == [(18, 30011, "2024-01-02 00:00:00"), (18, 5, "2024-01-01 00:00:09"),
                         (3, 5, "2024-01-01 00:00:01")]


def test_content_recall_remembers_earlier_batches(spark, rows, tmp_path, inbox):
    put, stream = inbox
    path, progress = str(tmp_path / "recall"), str(tmp_path / "progress")
    similar = spark.createDataFrame([(5, 10 + i, 0.1 * i, i) for i in range(1, 13)] + [(6, 11, 0.1, 1), (6, 40, 0.2, 2)],
                                    "article_id long, similar_id long, distance double, rank int")
    history = spark.createDataFrame([(1, 18, 12), (2, 3, 11)], "user_id long, channel_id int, article_id long")
    run = lambda: online.stream_content_recall(streams.click_stream(stream()), lambda: similar, path, progress,
                                               lambda: history, once=True).awaitTermination()
    put("a", [line("click", "1", "5"), line("share", "1", "5"), line("read", "1", "6"), line("exposure", "1", "[6]")])
    run()
    first = [(1, 18, 11)] + [(1, 18, i) for i in range(13, 21)]  # 12 was recalled elsewhere
    assert rows(spark.read.parquet(path).select(*KEYS)) == first
    put("b", [line("collect", "1", "6"), line("click", "2", "6")])
    run()
    # 11 was emitted to user 1 before
    assert rows(spark.read.parquet(path).select(*KEYS)) == first + [(1, 18, 40), (2, 18, 11), (2, 18, 40)]


def test_recall_sees_a_store_that_was_rewritten_meanwhile(spark, rows, tmp_path, inbox):
    put, stream = inbox
    store, path = str(tmp_path / "similar"), str(tmp_path / "recall")
    near = lambda similar, ts: spark.createDataFrame([(5, similar, 1, ts)], "article_id long, similar_id long, rank int, ts int")
    tables.create_store(near(6, 0), store, ["article_id"], "ts", buckets=2)
    put("a", [line("click", "1", "5")])
    query = online.stream_content_recall(streams.click_stream(stream()), lambda: tables.read_store(spark, store), path,
                                         str(tmp_path / "progress"))
    try:
        query.processAllAvailable()
        tables.upsert(near(8, 1), store, ["article_id"], "ts")
        put("b", [line("click", "1", "5"), line("click", "2", "5")])
        query.processAllAvailable()
    finally:
        query.stop()
    out = spark.read.parquet(path)
    assert rows(out.select(*KEYS)) == [(1, 18, 6), (1, 18, 8), (2, 18, 8)]
    assert rows(recall.read_recall(out, ["online"]).select(*KEYS)) == rows(out.select(*KEYS))


def test_windowed_hot_store_expires(spark, rows, tmp_path, inbox):
    put, stream = inbox
    store = str(tmp_path / "hot")
    put("a", [line("click", "1", "5"), line("click", "2", "5"), line("click", "2", "5").replace("2021-06-05", "2021-06-09")])
    online.stream_hot(streams.click_stream(stream()), store, str(tmp_path / "c"), once=True, buckets=2,
                      watermark="1 hour", window="1 day").awaitTermination()
    kept = lambda: rows(tables.read_store(spark, store).selectExpr("string(window_start)", "article_id", "score"))
    assert kept() == [("2021-06-05 00:00:00", 5, 2), ("2021-06-09 00:00:00", 5, 1)]
    online.drop_windows(spark, store, "2021-06-06")
    assert kept() == [("2021-06-09 00:00:00", 5, 1)]


def test_two_queries_read_one_source(spark, rows, tmp_path, inbox):
    put, stream = inbox
    similar = spark.createDataFrame([(5, 6, 0.1, 1)], "article_id long, similar_id long, distance double, rank int")
    put("a", [line("click", "1", "5"), line("click", "2", "5"), line("read", "2", "5")])
    clicks, at = streams.click_stream(stream()), lambda name: str(tmp_path / name)
    both = [online.stream_hot(clicks, at("hot"), at("c1"), once=True, buckets=2),
            online.stream_content_recall(clicks, lambda: similar, at("recall"), at("c2"), once=True)]
    for q in both:
        q.awaitTermination()
    assert rows(tables.read_store(spark, at("hot")).select("article_id", "score")) == [(5, 2)]
    assert rows(spark.read.parquet(at("recall")).select(*KEYS)) == [(1, 18, 6), (2, 18, 6)]


def test_recall_with_state_over_restarts(spark, rows, tmp_path, inbox):
    """Each key once over batches and restarts; a time to live lets keys go."""
    put, stream = inbox
    at = lambda name: str(tmp_path / name)
    similar = spark.createDataFrame([(5, 6, 1), (5, 7, 2), (5, 8, 11), (9, 7, 1)], "article_id long, similar_id long, rank int")
    history = spark.createDataFrame([(2, 18, 6)], "user_id long, channel_id int, article_id long")

    def run(out="recall", **ttl):
        online.stream_found(streams.click_stream(stream()), lambda: similar, at("found"), at("c1"), lambda: history,
                            once=True).awaitTermination()
        online.stream_first_recalls(spark, at("found"), at(out), at(f"c-{out}"), once=True, **ttl).awaitTermination()
        return rows(spark.read.parquet(at(out)).select(*KEYS))

    put("a", [line("click", "1", "5"), line("share", "1", "5"), line("read", "1", "9"), line("click", "2", "5")])
    assert run() == [(1, 18, 6), (1, 18, 7), (2, 18, 7)]
    put("b", [line("click", "1", "9"), line("collect", "3", "9"), line("click", "1", "5").replace("2021-06-05", "2021-07-05")])
    assert run() == [(1, 18, 6), (1, 18, 7), (2, 18, 7), (3, 18, 7)]
    assert (1, 18, 6) in run("short", ttl="1 day")
