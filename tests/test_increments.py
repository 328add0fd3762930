"""Counts by hours, interests by days, as-of joins: each equals doing it all again."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from recoflow.operators import actions, asof, frequencies, interest_days, keywords, profiles

WORDS = ["ant", "bee", "cat", "dog", "elk", "fox"]


def tokens(spark, articles):
    return spark.createDataFrame([(a, 1, w) for a, w in articles], "article_id long, channel_id int, words array<string>")


@pytest.mark.parametrize("seed", [1, 2])
def test_frequencies_equal_a_full_count(spark, rows, tmp_path, seed):
    rng = random.Random(seed)
    path, hours = f"{tmp_path}/df", {}
    # In order, late, repeated, shrunk to fewer articles, and empty.
    for hour in ["01", "03", "02", "03", "01"][: 4 + seed]:
        articles = {rng.randrange(6): [rng.choice(WORDS) for _ in range(rng.randrange(5))] for _ in range(rng.randrange(1, 5))}
        hours[hour] = articles
        frequencies.add_hour(tokens(spark, articles.items()), path, hour, buckets=4)
    newest = {a: w for hour in sorted(hours) for a, w in hours[hour].items()}
    full = keywords.idf_table(tokens(spark, newest.items()))
    assert rows(frequencies.idf_table(spark, path)) == rows(full)
    counted = frequencies.frequencies(spark, path)
    assert counted.where("keyword is null").first().df == len(newest)
    assert counted.where("df < 0 or n < 0").count() == 0


def test_frequencies_of_odd_hours(spark, rows, tmp_path):
    path = f"{tmp_path}/df"
    frequencies.add_hour(tokens(spark, []), path, "01", buckets=2)
    assert frequencies.idf_table(spark, path).count() == 0
    odd = [(1, ["ant"]), (1, ["ant", "bee"]), (None, ["cat"]), (2, None), (3, [])]
    frequencies.add_hour(tokens(spark, odd), path, "02", buckets=2)
    assert [r[:2] for r in rows(frequencies.frequencies(spark, path).where("keyword is not null"))] == [("ant", 1), ("bee", 1)]
    frequencies.add_hour(tokens(spark, []), path, "02", buckets=2)         # the hour is taken back
    assert frequencies.frequencies(spark, path).count() == 0


def test_words_of_versions_are_not_shuffled(spark, rows, tmp_path, capsys):
    """withdrawn versions are marked by place, so their words are read where they lie."""
    path, root = f"{tmp_path}/df", f"{tmp_path}/df/versions"
    first = [(a, ["ant", "bee", f"w{a % 5}"]) for a in range(200)]
    frequencies.add_hour(tokens(spark, first), path, "01", buckets=2)
    frequencies.add_hour(tokens(spark, [(a, ["cat"]) for a in range(0, 200, 3)]), path, "03", buckets=2)
    late = [(a, ["dog", "dog"]) for a in range(0, 200, 2)]
    assert frequencies.add_hour(tokens(spark, late + late[:7]), path, "02", buckets=2) == ["02", "03"]
    newest = {a: w for hour in (first, late, [(a, ["cat"]) for a in range(0, 200, 3)]) for a, w in hour}
    assert rows(frequencies.idf_table(spark, path)) == rows(keywords.idf_table(tokens(spark, newest.items())))
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frequencies._changes(frequencies._read(spark, root, frequencies.VERSIONS), "03", [0, 1]).explain()
        plan = capsys.readouterr().out
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") == 1


ACTION = ("user_id long, action_time timestamp_ntz, read_time string, channel_id int, action string, "
          "article_ids string, algorithm string")


def log(spark, rng, n, days):
    start = dt.datetime(2024, 1, 1)
    pick = lambda: start + dt.timedelta(seconds=rng.choice([0, 86399, 43200]) + 86400 * rng.randrange(*days))
    return spark.createDataFrame([
        (rng.randrange(3), pick(), str(rng.randrange(200)), 1, rng.choice(["click", "share", "collect", "read"]),
         str(rng.randrange(4)), "C") for _ in range(n)], ACTION)


@pytest.mark.parametrize("clock", [0, 43200])
def test_interests_by_day(spark, clock):
    rng = random.Random(9)
    old, new = log(spark, rng, 30, (0, 10)), log(spark, rng, 15, (5, 14))
    topics = spark.createDataFrame([(0, 1, ["a", "b"]), (1, 1, ["b"]), (2, 2, ["a"])],
                                   "article_id long, channel_id int, topics array<string>")
    sums = lambda table: interest_days.day_sums(table, topics, 100, clock)
    history = actions.fold_actions(old)
    before, after = interest_days.changed_pairs(history, new)
    merged = interest_days.merge_sums([sums(history), sums(after)], [sums(before)])
    assert merged.where("score < 0").count() == 0
    whole = actions.fold_actions(old.unionByName(new))
    for day in ("2024-01-16", "2024-01-17", "2024-03-05"):
        now = F.lit(day).cast("timestamp_ntz") + F.expr(f"interval {clock} seconds")
        number = F.date_diff(F.lit(day).cast("date"), F.lit("1970-01-01").cast("date"))
        key = lambda df: sorted((r.user_id, r.channel_id, r.topic, round(r.weight, 9)) for r in df.collect())
        assert key(interest_days.interests_on(merged, number)) == key(profiles.user_interests(whole, topics, now, 100))


def test_as_of_equals_brute_force(spark, rows):
    rng = random.Random(4)
    start = dt.datetime(2024, 1, 1)
    at = lambda: start + dt.timedelta(hours=rng.randrange(24 * 12) // 5 * 5)
    left = [(n, rng.choice([1, 1, 1, 2, 3]), at()) for n in range(60)] + [(90, None, at()), (91, 1, None), (90, None, None)]
    right = [(rng.choice([1, 2, 4]), at(), rng.randrange(9)) for _ in range(40)] + [(None, at(), 1), (1, None, 1)]
    out = asof.as_of(spark.createDataFrame(left, "t int, k long, at timestamp_ntz"),
                     spark.createDataFrame(right, "k long, since timestamp_ntz, v int"), ["k"], "at", "since")
    expected = []
    for n, k, t in left:
        valid = [(s, v) for key, s, v in right if None not in (k, t, key, s) and key == k and s <= t]
        expected.append((n, k, t, *(max(valid) if valid else (None, None))))
    assert out.columns == ["t", "k", "at", "since", "v"]
    assert rows(out) == sorted(expected, key=repr)
    with pytest.raises(ValueError):
        asof.as_of(out, spark.createDataFrame(right, "k long, since timestamp_ntz, v int"), ["k"], "at", "since")


def test_as_of_of_empty_tables(spark):
    left = spark.createDataFrame([(1, dt.datetime(2024, 1, 1))], "k long, at timestamp_ntz")
    right = spark.createDataFrame([], "k long, since timestamp_ntz, v int")
    assert asof.as_of(left, right, ["k"], "at", "since").collect()[0].v is None
    assert asof.as_of(left.limit(0), right, ["k"], "at", "since").count() == 0


def test_sums_by_day_shuffle_no_topics(spark):
    table = actions.fold_actions(log(spark, random.Random(4), 30, (0, 10))).crossJoin(
        spark.range(3000).withColumnRenamed("id", "copy")).withColumn("user_id", F.col("user_id") + 3 * F.col("copy")).drop("copy")
    topics = spark.createDataFrame([(0, 1, ["a", "b"]), (1, 1, ["b"])], "article_id long, channel_id int, topics array<string>")
    sums = interest_days.merge_sums([interest_days.day_sums(table, topics), interest_days.day_sums(table, topics)])
    days = [F.lit(19800), F.lit(19900)]
    both = interest_days.interests_on(sums, *days)
    plan = both._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in plan.splitlines() if "Exchange hashpartitioning" in x and "topic" in x], plan
    key = lambda df: sorted((r.user_id, r.topic, round(r.weight, 9)) for r in df.collect())
    for nth, day in enumerate(days):
        assert key(both.where(F.col("nth") == nth)) == key(interest_days.interests_on(sums, day))
