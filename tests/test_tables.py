from datetime import datetime

import pytest
from pyspark.sql import functions as F

from recoflow.operators import articles
from recoflow.sources import tables


def frame(spark, data):
    return spark.createDataFrame(data, "id long, v string, ts int")


def test_replace_may_read_its_own_table(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    tables.append(frame(spark, [(1, "a", 1)]), path)
    tables.append(frame(spark, [(2, "b", 1)]), path)
    tables.replace(tables.table(spark, path).withColumn("ts", F.col("ts") + 1), path)
    assert rows(tables.table(spark, path)) == [(1, "a", 2), (2, "b", 2)]
    assert sorted(p.name for p in tmp_path.iterdir() if not p.name.startswith(".")) == ["t"]


def test_append_matches_columns_by_name(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    tables.append(frame(spark, [(1, "a", 1)]), path)
    tables.append(frame(spark, [(2, "b", 3)]).select("ts", "id", "v"), path)
    assert rows(tables.table(spark, path).select("id", "v", "ts")) == [(1, "a", 1), (2, "b", 3)]


def test_catalogue_table(spark, rows):
    spark.sql("DROP TABLE IF EXISTS recoflow_append")
    tables.append(frame(spark, [(1, "a", 1)]), "recoflow_append")
    tables.append(frame(spark, [(2, "b", 3)]).select("ts", "id", "v"), "recoflow_append")
    assert rows(tables.table(spark, "recoflow_append")) == [(1, "a", 1), (2, "b", 3)]
    spark.sql("DROP TABLE recoflow_append")


def test_upsert_latest_wins_and_is_idempotent(spark, rows, tmp_path):
    path = str(tmp_path / "s")
    tables.create_store(frame(spark, [(i, "old", 5) for i in range(50)]), path, ["id"], "ts", buckets=4)
    new = frame(spark, [(1, "new", 6), (1, "newer", 7), (2, "late", 4), (99, "added", 1)])
    for _ in range(2):
        tables.upsert(new, path, ["id"], "ts")
        out = {r["id"]: r["v"] for r in tables.read_store(spark, path).collect()}
        assert len(out) == 51 and tables.read_store(spark, path).count() == 51
        assert (out[1], out[2], out[99], out[3]) == ("newer", "old", "added", "old")


def test_upsert_rewrites_only_its_buckets(spark, tmp_path):
    path = tmp_path / "s"
    tables.create_store(frame(spark, [(i, "old", 5) for i in range(50)]), str(path), ["id"], "ts", buckets=8)
    files = lambda: {p: p.stat().st_mtime_ns for p in path.rglob("*.parquet")}
    before = files()
    tables.upsert(frame(spark, [(1, "new", 6)]), str(path), ["id"], "ts")
    changed = {p.parent.name for p in set(before) ^ set(files())}
    assert len(changed) == 1


def test_a_rebuilt_store_holds_only_new_rows(spark, rows, tmp_path):
    path = str(tmp_path / "store")
    tables.create_store(frame(spark, [(i, "old", 5) for i in range(20)]), path, ["id"], "ts", buckets=4)
    tables.create_store(frame(spark, [(7, "new", 1)]), path, ["id"], "ts", buckets=8)
    assert rows(tables.read_store(spark, path)) == [(7, "new", 1)] and tables.store_buckets(spark, path) == 8


def test_replace_drops_what_a_broken_run_left(spark, rows, tmp_path):
    path = str(tmp_path / "table")
    frame(spark, [(1, "stale", 1)]).write.partitionBy("ts").parquet(path + ".new")
    tables.replace(frame(spark, [(2, "good", 2)]), path, ["ts"])
    assert rows(tables.table(spark, path).select("id")) == [(2,)]


def test_store_of_maps(spark, tmp_path):
    df = spark.createDataFrame([(1, {"a": 1.0}, 3), (1, {"b": 2.0}, 3), (2, {"c": 1.0}, 1)], "id int, weights map<string, double>, ts int")
    path = str(tmp_path / "store")
    tables.create_store(df, path, ["id"], "ts", buckets=2)
    tables.upsert(df, path, ["id"], "ts")
    assert {r.id: r.weights for r in tables.read_store(spark, path).collect()} == {1: {"b": 2.0}, 2: {"c": 1.0}}


def test_latest_versions(spark, rows):
    df = frame(spark, [(1, "a", 1), (1, "b", 2), (1, "c", 3), (2, "d", 9)])
    out = tables.latest_versions(df, ["id"], "ts", n=1, before=F.lit(3)).select("id", "v", "version")
    assert rows(out) == [(1, "b", 1)]
    assert rows(tables.latest_versions(df, ["id"], "ts", n=2).select("id", "version", "v")) == [
        (1, 1, "c"), (1, 2, "b"), (2, 1, "d")]


def test_delete_keys(spark, rows):
    df = frame(spark, [(1, "a", 1), (2, "b", 1)])
    assert rows(tables.delete_keys(df, frame(spark, [(2, "x", 0)]), ["id"])) == [(1, "a", 1)]


@pytest.fixture()
def news(spark):
    at = lambda h, m=0: datetime(2024, 1, 5, h, m)
    basic = spark.createDataFrame(
        [(1, 3, "first", at(9), 2), (2, 3, "early", at(8, 59), 2), (3, 9, "last", at(9, 59), 2),
         (4, 3, "next hour", at(10), 2), (5, 3, "draft", at(9, 5), 1), (6, 3, "no text", at(9, 5), 2)],
        "article_id long, channel_id int, title string, review_time timestamp, status int")
    content = spark.createDataFrame([(i, f"<p>{i}</p>") for i in range(1, 6)], "article_id long, content string")
    channels = spark.createDataFrame([(3, "ios")], "channel_id int, channel_name string")
    return basic, content, channels


def test_hourly_merge(spark, rows, news):
    start, end = articles.previous_hour(F.lit("2024-01-05 10:42:07").cast("timestamp"))
    out = articles.merge_articles(*news, start, end).select("article_id", "channel_name", "sentence")
    assert rows(out) == [(1, "ios", "ios,first,<p>1</p>"), (3, None, "last,<p>3</p>")]


def test_merge_filter_reaches_the_scan(spark, news, tmp_path, capsys):
    basic, content, channels = news
    path = str(tmp_path / "basic")
    basic.write.parquet(path)
    bounds = [F.lit(t).cast("timestamp") for t in ("2024-01-05 09:00:00", "2024-01-05 10:00:00")]
    plan = articles.merge_articles(spark.read.parquet(path), content, channels, *bounds)
    plan.explain("formatted")
    text = capsys.readouterr().out
    assert "GreaterThanOrEqual(review_time" in text and "EqualTo(status,2)" in text


def test_replace_that_broke_between_its_renames(spark, tmp_path, rows):
    """The old table is put back, by readers that ask for it and by the next replace."""
    for reads in (True, False):
        path = tmp_path / f"t{reads}"
        tables.replace(spark.createDataFrame([(1,)], "a int"), str(path))
        path.rename(f"{path}.old")
        if reads:
            assert tables.exists(spark, str(path)) and rows(tables.table(spark, str(path))) == [(1,)]
        else:
            tables.restore(spark, str(path))
            tables.replace(tables.table(spark, str(path)).unionByName(spark.createDataFrame([(2,)], "a int")), str(path))
            assert rows(tables.table(spark, str(path))) == [(1,), (2,)]
    assert not tables.exists(spark, str(tmp_path / "never"))


def test_lookup_reads_the_buckets_of_its_keys(spark, tmp_path, rows):
    path = str(tmp_path / "store")
    store = spark.createDataFrame([(i, i * 10, 1) for i in range(50)], "k int, v int, t int")
    tables.merge_store(store, path, ["k"], "t", buckets=8)
    tables.merge_store(spark.createDataFrame([(3, 99, 2)], "k int, v int, t int"), path, ["k"], "t", buckets=8)
    wanted = spark.createDataFrame([(3,), (7,), (500,)], "k int")
    assert rows(tables.lookup(wanted, path, ["k"])) == [(3, 99, 2), (7, 70, 1)]
    assert tables.lookup(wanted.limit(0), path, ["k"]).count() == 0
