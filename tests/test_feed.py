import json

import pytest
from pyspark.sql import functions as F

from recoflow.operators import ctr, feed

REQUEST = "user_id long, channel_id int, article_num int, time_stamp long"
SERVED = "user_id long, channel_id int, request_ts long, pos int, article_id long"


def requests(spark, data):
    return spark.createDataFrame(data, REQUEST)


def served(spark, pages):
    return spark.createDataFrame(
        [(u, c, ts, i + 1, a) for u, c, ts, ids in pages for i, a in enumerate(ids)], SERVED)


def test_buckets(spark):
    import hashlib
    df = spark.createDataFrame([(i,) for i in range(200)], "user_id long")
    for r in feed.assign_strategy(df).collect():
        digit = hashlib.md5(str(r["user_id"]).encode()).hexdigest()[0]
        assert r["bucket"] == digit
        assert r["strategy"] == ("Algo-2" if digit in "ef" else "Algo-1")


def test_strategy_table(spark):
    out = {r["strategy"]: r for r in feed.strategy_table(spark).collect()}
    assert len(out["Algo-1"]["digits"]) == 14 and out["Algo-2"]["digits"] == ["e", "f"]
    assert out["Algo-1"]["sources"] == ["als", "content", "online", "new", "hot"]
    assert (out["Algo-1"]["sort"], out["Algo-2"]["sort"]) == ("LR", "WDL")


def test_routing(spark, rows):
    s = served(spark, [(1, 4, 100, [5]), (1, 4, 200, [6])])
    out = feed.route_requests(requests(spark, [(1, 4, 2, 201), (1, 4, 2, 200), (1, 5, 2, 1)]), s)
    assert rows(out.select("channel_id", "time_stamp", "last_ts", "route")) == [
        (4, 200, 200, "history"), (4, 201, 200, "refresh"), (5, 1, 0, "refresh")]


PAGES = [(1, 18, 1559148615353, [15140, 16421, 19494, 14381, 17966]),
         (1, 18, 1558236647437, [18904, 14300, 44412]),
         (1, 18, 1558236629309, [43997, 14299, 17632, 17120])]


@pytest.mark.parametrize("ts, page, next_ts", [
    (1559148615353, 0, 1558236647437), (1558236647437, 1, 1558236629309), (1558236647438, 1, 1558236629309),
    (1558236629309, 2, 0), (1558236629400, 2, 0), (1558236629308, None, 0)])
def test_history_page(spark, rows, ts, page, next_ts):
    out = feed.history_page(requests(spark, [(1, 18, 5, ts)]), served(spark, PAGES))
    assert rows(out) == [(1, 18, ts, PAGES[page][3] if page is not None else [], next_ts)]


def test_history_of_many_requests_at_once(spark):
    asks = requests(spark, [(1, 18, 5, 1558236629309 + i) for i in range(5)] + [(1, 18, 5, 1), (2, 18, 5, 1559148615353)])
    out = {(r["user_id"], r["time_stamp"]): (r["articles"], r["next_ts"])
           for r in feed.history_page(asks, served(spark, PAGES)).collect()}
    assert len(out) == 7
    assert all(out[(1, 1558236629309 + i)] == (PAGES[2][3], 0) for i in range(5))
    assert out[(2, 1559148615353)] == ([], 0)


def test_served_in_channel_or_mixed_feed_is_excluded(spark, rows):
    cands = spark.createDataFrame([(1, 4, 9, a) for a in (1, 2, 3)] + [(2, 4, 9, 2)],
                                  "user_id long, channel_id int, time_stamp long, article_id long")
    s = served(spark, [(1, 4, 5, [1]), (1, 0, 5, [2]), (1, 6, 5, [3])])
    assert rows(feed.exclude_served(cands, s).select("user_id", "article_id")) == [(1, 3), (2, 2)]


def ranked(spark, n):
    return spark.createDataFrame([(1, 4, 5, 9, 100 + i, i) for i in range(1, n + 1)],
                                 "user_id long, channel_id int, article_num int, time_stamp long, article_id long, rank int")


@pytest.mark.parametrize("n, waiting", [(7, [(1, 106), (2, 107)]), (5, []), (3, [])])
def test_split(spark, rows, n, waiting):
    first, rest = feed.split_feed(ranked(spark, n))
    assert rows(first.select("pos", "article_id")) == [(i, 100 + i) for i in range(1, min(n, 5) + 1)]
    assert rows(rest.select("pos", "article_id")) == waiting


def test_generate_feed(spark, rows):
    req = requests(spark, [(1, 4, 2, 99), (2, 4, 2, 99), (3, 5, 2, 99)])
    stored = spark.createDataFrame([(1, 4, "als", 10), (1, 4, "online", 11), (3, 5, "als", 30)],
                                   "user_id long, channel_id int, recall_type string, article_id long")
    new = spark.createDataFrame([(4, 12), (4, 13)], "channel_id int, article_id long")
    hot = spark.createDataFrame([(4, 13)], "channel_id int, article_id long")
    users = spark.createDataFrame([(1, 4, [1.0])], "user_id long, channel_id int, weights array<double>")
    articles = spark.createDataFrame([(a, [4.0] + [0.0] * 10 + [float(a)]) for a in (10, 11, 12, 13)],
                                     "article_id long, features array<double>")
    s = served(spark, [(1, 0, 50, [13]), (3, 5, 50, [30])])
    first, rest = feed.generate_feed(req, stored, new, hot, s, users, articles, feed.strategy_table(spark),
                                     score=lambda f: f[1], dim=1)
    assert rows(first.select("user_id", "pos", "article_id")) == [
        (1, 1, 12), (1, 2, 11), (2, 1, 12), (2, 2, 13)]  # user 3: everything served already
    assert rows(rest.select("user_id", "pos", "article_id")) == [(1, 1, 10)]


def test_serve_waiting(spark, rows):
    req = requests(spark, [(1, 4, 2, 99), (2, 4, 2, 99), (3, 4, 2, 99)])
    wait = spark.createDataFrame([(u, 4, p, 100 * u + p) for u in (1, 2) for p in range(1, 6)],
                                 "user_id long, channel_id int, pos int, article_id long")
    cache = spark.createDataFrame([(2, 4, 1, 901), (2, 4, 2, 902), (2, 4, 3, 903)],
                                  "user_id long, channel_id int, pos int, article_id long")
    out = rows(feed.serve_waiting(req, wait, cache, cap=4).select("user_id", "article_id", "state"))
    assert out == [
        (1, 101, "served"), (1, 102, "served"), (1, 103, "cached"), (1, 104, "cached"), (1, 105, "waiting"),
        (2, 201, "waiting"), (2, 202, "waiting"), (2, 203, "waiting"), (2, 204, "waiting"), (2, 205, "waiting"),
        (2, 901, "served"), (2, 902, "served"), (2, 903, "cached")]


def test_requests_of_a_line_share_its_leftovers(spark, rows):
    req = requests(spark, [(1, 4, 2, 99), (1, 4, 2, 50), (1, 4, 2, 50), (1, 4, 1, 120), (2, 4, 3, 10), (2, 4, 3, 20), (3, 4, 2, 5)])
    wait = spark.createDataFrame([(u, 4, p, 100 * u + p) for u in (1, 2) for p in range(1, 7)],
                                 "user_id long, channel_id int, pos int, article_id long")
    out = sorted(rows(feed.serve_waiting(req, wait, cap=5).select("user_id", "time_stamp", "pos", "article_id", "state")))
    assert out == [
        (1, 50, 1, 101, "served"), (1, 50, 2, 102, "served"), (1, 99, 3, 103, "served"), (1, 99, 4, 104, "served"),
        (1, 120, 5, 105, "served"), (1, 120, 6, 106, "waiting"),
        (2, 10, 1, 201, "served"), (2, 10, 2, 202, "served"), (2, 10, 3, 203, "served"), (2, 20, 4, 204, "served"),
        (2, 20, 5, 205, "served"), (2, 20, 6, 206, "waiting")]


def test_requests_of_a_line_share_a_computed_list(spark, rows):
    req = requests(spark, [(1, 4, 2, 99), (1, 4, 3, 50), (2, 4, 4, 7)])
    ranked = spark.createDataFrame([(1, 4, 50, 3, a, r) for r, a in enumerate((10, 20, 30, 40, 50, 60, 70), 1)] + [(2, 4, 7, 4, 10, 1)],
                                   "user_id long, channel_id int, time_stamp long, article_num int, article_id long, rank long")
    first, rest = feed.split_feed(ranked, req)
    assert sorted(rows(first)) == [(1, 4, 50, 1, 10), (1, 4, 50, 2, 20), (1, 4, 50, 3, 30), (1, 4, 99, 1, 40), (1, 4, 99, 2, 50), (2, 4, 7, 1, 10)]
    assert rows(rest) == [(1, 4, 1, 60), (1, 4, 2, 70)]


def test_track_payload(spark):
    lists = spark.createDataFrame([(7, 4, 99, "Algo-1", [5, 6], "refresh"), (7, 4, 50, "Algo-1", [5], "history")],
                                  "user_id long, channel_id int, time_stamp long, strategy string, "
                                  "articles array<bigint>, route string")
    out = {r["time_stamp"]: r for r in feed.track_payload(lists).collect()}
    assert json.loads(out[99]["param"]) == {"action": "exposure", "userId": "7", "articleId": "[5,6]",
                                            "algorithmCombine": "Algo-1"}
    assert out[50]["param"] == ""
    items = json.loads(out[99]["recommends"])
    assert [i["article_id"] for i in items] == [5, 6]
    assert {a: json.loads(m) for a, m in items[1]["param"].items()} == {
        a: {"action": a, "userId": "7", "articleId": "6", "algorithmCombine": "Algo-1"}
        for a in ("click", "collect", "share", "read")}


def test_payload_is_readable_as_log_lines(spark, rows):
    """What clients send back goes through the ordinary action log."""
    from recoflow.operators import actions
    from recoflow.schema import ACTION_PARAM
    lists = spark.createDataFrame([(7, 4, 99, "Algo-1", [5, 6], "refresh")],
                                  "user_id long, channel_id int, time_stamp long, strategy string, "
                                  "articles array<bigint>, route string")
    log = feed.track_payload(lists).select(
        F.lit("2024-01-01 00:00:00").alias("actionTime"), F.lit("").alias("readTime"),
        F.col("channel_id").alias("channelId"), F.from_json("param", ACTION_PARAM).alias("param"))
    out = actions.action_flags(actions.actions_scan(log)).select("user_id", "article_id", "exposure")
    assert rows(out) == [(7, 5, True), (7, 6, True)]
