"""All jobs in order on a small site."""

from datetime import datetime

from pyspark.sql import functions as F

from recoflow.operators import cells
from recoflow.plans import jobs
from recoflow.schema import USER_ACTION
from recoflow.sources import tables

TEXTS = {
    1: "spark cluster shuffle partition spark executor", 2: "spark executor shuffle cluster spark memory",
    3: "garden flower rose tulip garden soil", 4: "rose garden tulip water flower soil",
    5: "spark streaming cluster watermark spark shuffle",
}


def site(spark, ids, hour):
    basic = spark.createDataFrame([(i, 3, f"title{i}", datetime(2024, 1, 5, hour, 30), 2) for i in ids],
                                  "article_id long, channel_id int, title string, review_time timestamp, status int")
    content = spark.createDataFrame([(i, TEXTS[i]) for i in ids], "article_id long, content string")
    return basic, content, spark.createDataFrame([(3, "ios")], "channel_id int, channel_name string")


def test_jobs_end_to_end(spark, tmp_path, rows):
    root = str(tmp_path)
    at = lambda h: F.lit(f"2024-01-05 {h:02d}:05:00").cast("timestamp")
    docs = spark.createDataFrame([(i, 3, t) for i, t in TEXTS.items()] + [(9, 3, "other words here")],
                                 "article_id long, channel_id int, sentence string")
    jobs.build_idf(docs, root)
    axis = {"spark": 0, "cluster": 0, "shuffle": 0, "executor": 0, "garden": 1, "rose": 1, "flower": 1}
    words = spark.createDataFrame([(w, [float(a == 0), float(a == 1)]) for w, a in axis.items()],
                                  "keyword string, vector array<double>")
    options = {"threshold": 5.0, "buckets": 4}
    jobs.update_articles(*site(spark, [1, 2, 3, 4], 9), root, at(10), words, **options)
    jobs.update_articles(*site(spark, [5], 10), root, at(11), words, **options)
    names = ["article_data", "tfidf", "textrank", "article_profile", "article_vector"]
    state = lambda: [rows(jobs.current(spark, f"{root}/{n}")) for n in names] + [rows(jobs.similar_rows(spark, root))]
    before = state()
    jobs.update_articles(*site(spark, [5], 10), root, at(11), words, **options)
    assert state() == before, "the hour ran twice"
    jobs.update_articles(*site(spark, [1], 11), root, at(12), words, **options)
    assert [len(a) for a in state()[:5]] == [len(b) for b in before[:5]], "article 1 was published again"
    assert jobs.current(spark, f"{root}/article_data").count() == 5
    jobs.update_articles(*site(spark, [5], 10), root, at(11), words, **options)
    held = rows(cells.indexed(spark, jobs.vector_index(spark, root)))
    assert held == rows(jobs.current(spark, f"{root}/article_vector").select("article_id", "channel_id", "vector")), "an old hour again"
    near = {(r["article_id"], r["rank"]): r["similar_id"] for r in jobs.similar_rows(spark, root).collect()}
    assert near[(5, 1)] in (1, 2) and near[(3, 1)] == 4 and near[(4, 1)] == 3

    lines = [("2024-01-05 11:00:00", "", 3, (a, str(u), art, "C2"), datetime(2024, 1, 5).date())
             for u, a, art in [(1, "click", "1"), (1, "exposure", "[1,3]"), (2, "click", "3"), (2, "share", "4")]]
    from pyspark.sql import types as T
    log = spark.createDataFrame(lines, T.StructType([*USER_ACTION.fields, T.StructField("dt", T.DateType())]))
    jobs.update_users(log.limit(2), root, at(12))
    jobs.update_users(log, root, at(12))
    assert tables.table(spark, f"{root}/user_article").count() == 4
    topics = {r["topic"] for r in tables.table(spark, f"{root}/user_interest").where("user_id = 2").collect()}
    assert "garden" in topics and "spark" not in topics

    jobs.update_features(spark, root)
    users = tables.table(spark, f"{root}/user_article").select("user_id")
    jobs.update_recall(spark, root, users, k=2)
    before = rows(tables.table(spark, f"{root}/recall"))
    assert (1, 3, "content", 2) in before
    jobs.update_recall(spark, root, users, k=2)
    assert rows(tables.table(spark, f"{root}/recall")) == before  # nothing recalled twice

    requests = spark.createDataFrame([(1, 3, 2, 1000), (2, 3, 2, 1000)],
                                     "user_id long, channel_id int, article_num int, time_stamp long")
    none = spark.createDataFrame([], "channel_id int, article_id long")
    serve = lambda req: jobs.serve_feeds(req, root, none, none, dim=2, score=lambda f: f[1])
    assert serve(requests).count() == 2
    served = tables.table(spark, f"{root}/served")
    assert served.groupBy("user_id").count().where("count > 2").count() == 0
    first = {tuple(r) for r in served.select("user_id", "article_id").collect()}
    serve(requests)  # same time: not newer than the last feed
    assert tables.table(spark, f"{root}/served").count() == len(first)
    left = {tuple(r) for r in tables.table(spark, f"{root}/waiting").select("user_id", "article_id").collect()}
    at_time = lambda t: {r.user_id: r for r in serve(requests.withColumn("time_stamp", F.lit(t).cast("long"))).collect()}
    newer = at_time(2000)
    assert {r.next_ts for r in newer.values()} == {1000}, "the cursor is the time of the feed before"
    second = tables.table(spark, f"{root}/served").where("request_ts = 2000")
    second = {tuple(r) for r in second.select("user_id", "article_id").collect()}
    assert not first & second
    assert {p for p in second if p[0] in {u for u, _ in left}} <= left, "leftovers come first"
    assert not second & {tuple(r) for r in tables.table(spark, f"{root}/waiting").select("user_id", "article_id").collect()}
    import json
    back = at_time(1000)
    assert {(u, a["article_id"]) for u, r in back.items() for a in json.loads(r.recommends)} == first, "paging back"
    assert {(r.param, r.next_ts) for r in back.values()} == {("", 0)}

    # Three requests of a line in one run: leftovers, then one computed list, nothing twice.
    many = spark.createDataFrame([(1, 3, 1, 3000 + i) for i in range(3)] + [(2, 3, 1, 3000)],
                                 "user_id long, channel_id int, article_num int, time_stamp long")
    answers = {(r.user_id, r.time_stamp): r for r in serve(many).collect()}
    assert len(answers) == 4 and answers[1, 3001].next_ts == 3000 and answers[1, 3002].next_ts == 3001
    history = tables.table(spark, f"{root}/served")
    assert history.count() == history.select("user_id", "channel_id", "article_id").distinct().count()
    # A run that broke after the history was written: what it served is waiting no more.
    waiting = tables.table(spark, f"{root}/waiting")
    gone = history.select("user_id", "channel_id", F.lit(1).cast("long").alias("pos"), "article_id")
    tables.replace(waiting.unionByName(gone.select(*[F.col(c).cast(t) for c, t in waiting.dtypes])), f"{root}/waiting")
    at_time(4000)
    history = tables.table(spark, f"{root}/served")
    assert history.count() == history.select("user_id", "channel_id", "article_id").distinct().count()
