"""Exact top-k inner products and bitmaps of the served history."""

import random

import numpy as np

from pyspark.sql import functions as F

from recoflow.operators import feed, history, products

SCHEMA = "key long, vector array<double>"


def brute(queries, items, k):
    out = []
    for q, v in queries:
        scored = sorted((-float(np.dot(v, w)), i) for i, w in items)[:k]
        out += [(q, i, -s, n + 1) for n, (s, i) in enumerate(scored)]
    return sorted(out)


def table(spark, data, key):
    return spark.createDataFrame(data, SCHEMA).withColumnRenamed("key", key).repartition(3)


def test_products_equal_brute_force_and_skip_blocks(spark):
    rng = random.Random(3)
    vector = lambda scale: [float(round(rng.gauss(0, 1) * scale)) for _ in range(6)]
    items = [(i, vector(200 / (1 + i))) for i in range(400)] + [(900, [0.0] * 6)]
    items += [(1000 + i, items[i][1]) for i in range(20)]           # ties
    queries = [(q, vector(30)) for q in range(70)] + [(500, [0.0] * 6), (501, [-1.0] * 6)]
    q, i = table(spark, queries, "user_id"), table(spark, items, "article_id")
    out = products.top_products(q, i, "user_id", "article_id", 7, size=16)
    assert out.columns == ["user_id", "article_id", "score", "rank"]
    assert sorted(tuple(r) for r in out.collect()) == brute(queries, items, 7)
    # Zero vectors and queries whose k-th score is not above 0 need every block, so they are left out here.
    _, chunks, blocks, pairs = products.plan(q.where("user_id < 500"), i, "user_id", "article_id", 3, size=16)
    assert pairs.count() < 0.5 * chunks.count() * (blocks.count() - 1)


def test_one_pair_of_blocks_is_multiplied_in_parts(monkeypatch):
    """What a pair needs is bounded, and no score depends on the parts."""
    rng = np.random.default_rng(2)
    asked, items = rng.integers(-3, 4, (50, 5)).astype(float), rng.integers(-3, 4, (40, 5)).astype(float)
    whole = products._best(asked, items, 6)
    monkeypatch.setattr(products, "PRODUCTS", 90)
    monkeypatch.setattr(products, "EXACT", 7)
    parts = products._best(asked, items, 6)
    assert all((a == b).all() for a, b in zip(whole, parts))
    expected = brute(list(enumerate(asked)), list(enumerate(items)), 6)
    assert [(int(q), int(i), s) for q, i, s in zip(*whole)] == [r[:3] for r in sorted(expected, key=lambda r: (r[0], r[3]))]


def test_products_of_few_odd_and_no_rows(spark):
    nan, inf = float("nan"), float("inf")
    items = table(spark, [(1, [1.0, 2.0]), (2, [nan, 1.0]), (3, [inf, 0.0]), (4, None), (5, [None, 1.0]),
                          (None, [1.0, 1.0]), (6, [-1.0, 0.0])], "article_id")
    queries = table(spark, [(1, [1.0, 1.0]), (1, [1.0, 1.0]), (2, None), (3, [nan, 0.0])], "user_id")
    out = products.top_products(queries, items, "user_id", "article_id", 5)
    assert sorted(tuple(r) for r in out.collect()) == [(1, 1, 3.0, 1), (1, 6, -1.0, 2)]
    none = table(spark, [], "article_id")
    assert products.top_products(queries, none, "user_id", "article_id", 5).count() == 0
    assert products.top_products(table(spark, [], "user_id"), items, "user_id", "article_id", 5).count() == 0


def lines(spark, data):
    return spark.createDataFrame(data, "user_id long, channel_id int, article_id long")


def test_bitmaps_equal_the_history(spark, rows):
    rng = random.Random(5)
    ids = [0, 1, 7, 8, 32767, 32768, 32769, 65536, 65537, 10**11, -1, -32768, -32769]
    some = lambda n: [(rng.randrange(4), rng.randrange(3), rng.choice(ids)) for _ in range(n)]
    old, new = some(25) + [(None, 1, 1), (1, None, 1), (1, 1, None)], some(15)
    candidates = lines(spark, [(u, c, a) for u in range(5) for c in (0, 1, 2) for a in ids] + [(1, 1, None), (None, 1, 1)])
    merged = history.merge_bitmaps(history.served_bitmaps(lines(spark, old)), history.served_bitmaps(lines(spark, new)))
    assert merged.count() == merged.select(*history.PLACE).distinct().count()
    left = history.exclude_seen(candidates, merged)
    assert left.columns == candidates.columns
    assert rows(left) == rows(feed.exclude_served(candidates, lines(spark, old + new)).select(*left.columns))
    again = history.merge_bitmaps(merged, history.served_bitmaps(lines(spark, new)))
    assert rows(again) == rows(merged)
    empty = history.served_bitmaps(lines(spark, []))
    assert history.exclude_seen(candidates, empty).count() == candidates.count()


def test_bitmaps_end_with_their_last_article(spark, rows):
    """A line of few articles is a row of few bytes, also after a merge."""
    once = history.served_bitmaps(lines(spark, [(1, 1, 3), (1, 1, 9), (2, 1, 70)]))
    size = lambda df: rows(df.select("user_id", F.octet_length("bits"), F.bitmap_count("bits")))
    assert size(once) == [(1, 2, 2), (2, 9, 1)]
    assert size(history.merge_bitmaps(once, history.served_bitmaps(lines(spark, [(1, 1, 20)])))) == [(1, 3, 3), (2, 9, 1)]
    assert not history.exclude_seen(lines(spark, [(1, 1, 9)]), once).count()
    assert history.exclude_seen(lines(spark, [(1, 1, 8), (1, 1, 500)]), once).count() == 2
