import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from recoflow.operators import ctr, evaluation


def interests(spark, data):
    return spark.createDataFrame(data, "user_id long, channel_id int, topic string, weight double")


def test_user_features_keep_the_smallest(spark, rows):
    data = [(1, 3, f"t{i}", float(i)) for i in range(12, 0, -1)] + [(1, 4, "x", 5.0), (1, 4, "y", 2.0)]
    df = interests(spark, data)
    assert rows(ctr.user_features(df)) == [(1, 3, [float(i) for i in range(1, 11)]), (1, 4, [2.0, 5.0])]
    assert rows(ctr.user_features(df, k=2, largest=True)) == [(1, 3, [12.0, 11.0]), (1, 4, [5.0, 2.0])]


@pytest.fixture(scope="module")
def tables(spark):
    long = {f"w{i}": float(i) for i in range(12)}
    profiles = spark.createDataFrame([(1, 3, {"a": 3.0, "b": 1.0, "c": 2.0}), (2, 3, long), (9, 4, long)],
                                     "article_id long, channel_id int, keywords map<string,double>")
    vectors = spark.createDataFrame([(1, [7.0, 8.0]), (2, [5.0, 6.0]), (8, [0.0, 0.0])],
                                    "article_id long, vector array<double>")
    return profiles, vectors


def test_article_features(tables, rows):
    out = rows(ctr.article_features(*tables))
    assert out[0] == (1, 3, [3.0, 1.0, 2.0, 3.0] + [0.0] * 7 + [7.0, 8.0])
    assert out[1] == (2, 3, [3.0] + [float(i) for i in range(10)] + [5.0, 6.0])
    assert len(out) == 2
    assert [r[0] for r in rows(ctr.article_features(*tables, strict=True))] == [2]


def test_samples(spark, tables, rows):
    users = spark.createDataFrame([(1, 3, [0.5]), (2, 4, [0.1] * 10), (3, 3, [0.1] * 10)],
                                  "user_id long, channel_id int, weights array<double>")
    actions = spark.createDataFrame([(1, 1, True), (2, 1, False), (3, 1, False), (4, 1, True), (1, 77, True)],
                                    "user_id long, article_id long, clicked boolean")
    articles = ctr.article_features(*tables)
    out = rows(ctr.ctr_samples(actions, users, articles, dims=23))
    assert [(r[0], r[4]) for r in out] == [(1, 1), (2, 0), (3, 0), (4, 1)]
    assert out[0][3] == [3.0, 7.0, 8.0, 0.5] + [0.0] * 9 + [1.0, 2.0, 3.0] + [0.0] * 7
    # short weights and a missing channel drop out, a user without profile is padded
    strict = rows(ctr.ctr_samples(actions, users, articles, dims=23, strict=True))
    assert [r[0] for r in strict] == [3, 4]
    assert rows(ctr.ctr_samples(actions, users, articles, dims=121)) == []
    means = rows(ctr.feature_means(ctr.ctr_samples(actions, users, articles, dims=23), dim=2))
    assert means[0] == (1, 1, 3, 7.5, pytest.approx(0.05), pytest.approx(0.6), 1)


def test_train_save_load_score(spark, tmp_path):
    rng = random.Random(3)
    data = []
    for i in range(200):
        x = rng.gauss(0, 1)
        data.append((i, i, [x, rng.gauss(0, 1)], int(x + rng.gauss(0, 0.5) > 0)))
    samples = spark.createDataFrame(data, "user_id long, article_id long, features array<double>, clicked int")
    ctr.save_model(ctr.train_ctr(samples), str(tmp_path / "m"))
    scored = ctr.score_ctr(ctr.load_model(str(tmp_path / "m")), samples)
    out = evaluation.auc_accuracy(scored.select("score", F.col("clicked").alias("label"))).collect()[0]
    assert out["auc"] > 0.9 and out["accuracy"] > 0.8 and out["n"] == 200
    ctr.export_samples(samples, str(tmp_path / "s"))
    assert spark.read.parquet(str(tmp_path / "s")).columns == ["label", "features"]


def test_auc_with_ties_equals_the_evaluator(spark):
    rng = random.Random(5)
    data = [(rng.choice([0.1, 0.5, 0.5, 0.9]) if i % 3 else rng.random(), rng.randint(0, 1)) for i in range(3000)]
    df = spark.createDataFrame(data, "score double, label int")
    expected = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0).evaluate(
        df.withColumn("label", F.col("label").cast("double")))
    row = evaluation.auc_accuracy(df).collect()[0]
    assert row["auc"] == pytest.approx(expected, abs=1e-12)
    assert row["accuracy"] == pytest.approx(sum((s >= 0.5) == bool(y) for s, y in data) / 3000)


def test_auc_of_one_class_is_null(spark):
    df = spark.createDataFrame([(0.3, 1), (0.6, 1)], "score double, label int")
    assert evaluation.auc_accuracy(df).collect()[0]["auc"] is None
    assert evaluation.roc_curve(df).collect()[0]["fpr"] is None


def candidates(spark, data):
    return spark.createDataFrame(data, "user_id long, channel_id int, time_stamp long, article_id long")


def test_rank_candidates(spark, tables, rows):
    users = spark.createDataFrame([(1, 3, [1.0]), (3, 3, [])], "user_id long, channel_id int, weights array<double>")
    articles = ctr.article_features(*tables)
    cands = candidates(spark, [(1, 3, 9, 1), (1, 3, 9, 2), (1, 3, 9, 50), (2, 3, 9, 60), (2, 3, 9, 2), (2, 3, 9, 4),
                               (3, 3, 9, 2), (3, 3, 9, 1)])
    first = lambda f: f[1]  # first entry of the article vector
    out = rows(ctr.rank_candidates(cands, users, articles, score=first, cap=2, dim=2)
               .select("user_id", "rank", "article_id", "score"))
    assert out == [(1, 1, 1, 7.0), (1, 2, 2, 5.0),  # article 50 has no features: zeros, capped
                   (2, 1, 2, None), (2, 2, 4, None),  # no user features: id order
                   (3, 1, 1, None), (3, 2, 2, None)]


def test_rank_by_fitted_model(spark, rows):
    """The click model sees serving features in its training order."""
    rng = random.Random(7)
    data = []
    for i in range(300):
        f = [1.0, rng.gauss(0, 1), rng.gauss(0, 1)] + [0.5] + [0.0] * 9 + [0.1] * 10
        data.append((i, i, f, int(f[2] > 0)))  # the second vector entry decides
    model = ctr.train_ctr(spark.createDataFrame(
        data, "user_id long, article_id long, features array<double>, clicked int"), regParam=0.01)
    users = spark.createDataFrame([(1, 3, [0.5])], "user_id long, channel_id int, weights array<double>")
    articles = spark.createDataFrame(
        [(a, [1.0] + [0.1] * 10 + v) for a, v in ((1, [9.0, -2.0]), (2, [-9.0, 2.0]), (3, [0.0, 0.5]))],
        "article_id long, features array<double>")
    cands = candidates(spark, [(1, 3, 9, a) for a in (1, 2, 3)])
    out = ctr.rank_candidates(cands, users, articles, model=model, dim=2)
    assert rows(out.select("rank", "article_id")) == [(1, 2), (2, 3), (3, 1)]
    assert out.where("score between 0 and 1").count() == 3


def test_samples_move_features_of_their_articles_only(spark, rows, monkeypatch):
    """Copies of an article count each; those without an action are not joined."""
    moved, acted_on = [], ctr.acted_on
    monkeypatch.setattr(ctr, "acted_on", lambda table, actions: moved.append(acted_on(table, actions)) or moved[-1])
    users = spark.createDataFrame([(1, 3, [0.5])], "user_id long, channel_id int, weights array<double>")
    articles = spark.createDataFrame([(i, 3, [3.0] + [float(i)] * 12) for i in [1, 1, 2, *range(10, 60)]],
                                     "article_id long, channel_id int, features array<double>")
    acted = spark.createDataFrame([(1, 1, True), (5, 2, False)], "user_id long, article_id long, clicked boolean")
    out = rows(ctr.ctr_samples(acted, users, articles, dims=23).select("user_id", "article_id", F.get("features", F.lit(3)), "clicked"))
    assert out == [(1, 1, 0.5, 1), (1, 1, 0.5, 1), (5, 2, 0.0, 0)]
    assert moved[0].count() == 3
