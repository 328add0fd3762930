import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from recoflow.operators import keywords as K


def docs(spark, texts):
    return spark.createDataFrame([(i, 1, t) for i, t in enumerate(texts)],
                                 "article_id long, channel_id int, sentence string")


def test_tokenize_strips_tags_and_short_words(spark, rows):
    df = docs(spark, ["<p class='x'>Spark is THE Engine</p>, an <b>engine</b>!"])
    out = K.tokenize(df, stopwords=["the"]).select("words")
    assert rows(out) == [(["spark", "engine", "engine"],)]


def test_custom_tokenizer(spark, rows):
    df = docs(spark, ["one|two|three"])
    out = K.tokenize(df, tokenizer=lambda c: F.split(c, "[|]")).select("words")
    assert rows(out) == [(["one", "two", "three"],)]


def test_term_counts_of_repeats_and_empty_text(spark):
    df = K.tokenize(docs(spark, ["bbb aaa bbb ccc bbb", ""]))
    out = {r["article_id"]: [tuple(t) for t in r["terms"]] for r in K.term_counts(df).collect()}
    assert out == {0: [("aaa", 1), ("bbb", 3), ("ccc", 1)], 1: []}


def test_idf_and_vocabulary_limit(spark):
    df = K.tokenize(docs(spark, ["aaa bbb", "aaa ccc ccc ccc", "aaa", ""]))
    out = {r["keyword"]: (r["idf"], r["index"]) for r in K.idf_table(df, vocab_size=2).collect()}
    assert out["aaa"] == (pytest.approx(math.log(5 / 4)), 0)
    assert out["ccc"] == (pytest.approx(math.log(5 / 2)), 1)
    assert set(out) == {"aaa", "ccc"}


def test_every_term_is_numbered_by_default(spark):
    texts = [f"word{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]} common" for i in range(300)]
    out = sorted((r["index"], r["keyword"]) for r in K.idf_table(K.tokenize(docs(spark, texts))).collect())
    assert [i for i, _ in out] == list(range(101))
    assert out[0][1] == "common" and [k for _, k in out[1:]] == sorted(k for _, k in out[1:])


def test_tfidf_picks_the_best_term(spark, rows):
    df = K.tokenize(docs(spark, ["aaa bbb bbb", "aaa ccc", "ddd"]))
    assert [r[2] for r in rows(K.tfidf_topk(df, K.idf_table(df), k=1))] == ["bbb", "ccc", "ddd"]


def test_large_idf_is_not_broadcast(spark, capsys):
    idf = spark.range(1_000_000).select(F.col("id").cast("string").alias("keyword"), F.lit(1.0).alias("idf"))
    ranked = spark.createDataFrame([(1, 5, "7", 1.0)], "article_id long, channel_id int, keyword string, textrank double")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        K.keyword_weights(ranked, idf).explain()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "Broadcast" not in capsys.readouterr().out


def test_textrank_needs_no_exchange(spark, capsys):
    K.textrank(docs(spark, ["one two three"])).explain()
    assert "Exchange" not in capsys.readouterr().out


def brute_rank(text, window=5, iters=10, d=0.85):
    words = [w for w in "".join(c if c.isalpha() else " " for c in text.lower()).split(" ")]
    words = [w for w in words if w]
    weight = defaultdict(Counter)
    for i, a in enumerate(words):
        for b in words[i + 1:i + window]:
            if len(a) >= 3 and len(b) >= 3:
                weight[a][b] += 1
                weight[b][a] += 1
    out = {a: sum(c.values()) for a, c in weight.items()}
    r = {a: 1 / len(out) for a in out}
    for _ in range(iters):
        r = {a: 1 - d + d * sum(w / out[b] * r[b] for b, w in weight[a].items()) for a in out}
    lo, hi = min(r.values()), max(r.values())
    return {a: (x - lo / 10) / (hi - lo / 10) for a, x in r.items()}


def test_textrank_equals_brute_force(spark):
    rng = random.Random(1)
    vocabulary = ["of", "an"] + ["".join(rng.choices("abcdefgh", k=4)) for _ in range(12)]
    texts = [" ".join(rng.choices(vocabulary, k=n)) for n in (1, 2, 7, 60, 200)]
    out = defaultdict(dict)
    for r in K.textrank(docs(spark, texts), k=50).collect():
        out[r["article_id"]][r["keyword"]] = r["textrank"]
    for i, text in enumerate(texts):
        expected = brute_rank(text) if len(text.split()) > 1 else {}
        assert out[i] == {w: pytest.approx(x, abs=1e-7) for w, x in expected.items()}


def test_isolated_word_has_no_rank(spark):
    far = "lonely " + "of " * 10 + "near word"
    out = {r["keyword"] for r in K.textrank(docs(spark, [far])).collect()}
    assert out == {"near", "word"}


@pytest.fixture()
def tables(spark):
    ranked = spark.createDataFrame(
        [(1, 5, "aaa", 1.0), (1, 5, "bbb", 0.5), (1, 5, "zzz", 0.4), (2, 5, "ccc", 1.0)],
        "article_id long, channel_id int, keyword string, textrank double")
    tfidf = spark.createDataFrame(
        [(1, 5, "bbb", 3.0), (1, 5, "ccc", 2.0), (2, 5, "ccc", 1.0), (3, 5, "aaa", 1.0)],
        "article_id long, channel_id int, keyword string, tfidf double")
    idf = spark.createDataFrame([("aaa", 2.0), ("bbb", 3.0), ("ccc", 4.0)], "keyword string, idf double")
    return ranked, tfidf, idf


def test_keyword_without_idf_is_dropped(tables):
    ranked, _, idf = tables
    out = {(r["article_id"], r["keyword"]): r["weight"] for r in K.keyword_weights(ranked, idf).collect()}
    assert out == {(1, "aaa"): 2.0, (1, "bbb"): 1.5, (2, "ccc"): 4.0}


def test_topics_per_article_and_global(tables, rows):
    ranked, tfidf, _ = tables
    assert rows(K.topics(tfidf, ranked)) == [(1, ["bbb"]), (2, ["ccc"])]
    assert rows(K.topics(tfidf, ranked, global_topics=True)) == [(1, ["bbb", "ccc"]), (2, ["ccc"]), (3, ["aaa"])]


@pytest.mark.parametrize("global_topics", [False, True])
def test_article_profile(tables, global_topics):
    ranked, tfidf, idf = tables
    again = ranked.union(ranked.limit(1))  # the same keyword twice
    out = {r["article_id"]: (r["keywords"], r["topics"]) for r in
           K.article_profile(again, tfidf, idf, global_topics=global_topics).collect()}
    topics = ["bbb", "ccc"] if global_topics else ["bbb"]
    assert out == {1: ({"aaa": 2.0, "bbb": 1.5}, topics), 2: ({"ccc": 4.0}, ["ccc"])}


def test_ranks_do_not_depend_on_slices(spark, rows, monkeypatch):
    """Graphs are built for many articles at once, not by expressions over each word."""
    rng = random.Random(4)
    texts = [" ".join(rng.choices(["of", "aaa", "bbb", "ccc", "ddd", "éé", "ééé"], k=n)) for n in (0, 1, 9, 50, 3, 200, 30)] + [None]
    whole = K.textrank(docs(spark, texts), k=2)
    plan = whole._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "aggregate(" not in plan
    together = rows(whole)
    real = K.word_graphs.best_ranked

    def by_few(*args):
        def run(batches):
            from recoflow.operators import word_graphs
            word_graphs.SLICE_WORDS = 10
            yield from real(*args)(batches)
        return run

    monkeypatch.setattr(K.word_graphs, "best_ranked", by_few)
    assert rows(K.textrank(docs(spark, texts), k=2)) == together
    assert {r[0] for r in together} == {2, 3, 4, 5, 6}


def test_word_graph_of_repeats_and_gaps(spark):
    out = {r["article_id"]: r["nodes"] for r in
           K.word_graph(docs(spark, ["bbb of aaa bbb", "of", None, "ddd"]), window=3).collect()}
    assert {i: [tuple(n) for n in nodes] for i, nodes in out.items()} == {
        0: [(1, "aaa", [2, 2]), (2, "bbb", [1, 1])], 1: [], 2: [], 3: [(1, "ddd", [])]}


def test_few_large_parts_are_dealt_by_rows(spark, monkeypatch):
    from recoflow.sources import adapters
    monkeypatch.setattr(adapters, "TASK_ROWS", 10, raising=False)
    cores = spark.sparkContext.defaultParallelism
    large, small = spark.range(0, 1000, 1, 1), spark.range(0, 20, 1, 1)
    assert adapters.spread(large, "id").rdd.getNumPartitions() == 100
    assert adapters.spread(small, "id").rdd.getNumPartitions() == cores
    assert adapters.spread(spark.range(0, 0, 1, 1), "id").count() == 0


def test_frequencies_are_counted_by_slices(monkeypatch):
    """a batch sends one row per term and slice, not one per term and article; slices change no sum."""
    import collections

    import pyarrow as pa

    from recoflow.operators import word_counts
    lists = [["ant", "bee", "ant"], None, [], ["bee", None, "bee"], ["cat"] * 5, ["ant", "cat"]]
    batch = pa.RecordBatch.from_arrays([pa.array([["dog"], *lists], pa.list_(pa.string()))], names=["words"]).slice(1)

    def counted():
        parts, sums = list(word_counts.counts(iter([batch]))), collections.Counter()
        for r in (r for part in parts for r in part.to_pylist()):
            sums[r["keyword"], "df"] += r["df"]
            sums[r["keyword"], "n"] += r["n"]
        return sum(p.num_rows for p in parts), sums

    held, whole = counted()
    assert held == 3 and whole == {("ant", "df"): 2, ("ant", "n"): 3, ("bee", "df"): 2, ("bee", "n"): 3,
                                   ("cat", "df"): 2, ("cat", "n"): 6}
    monkeypatch.setattr(word_counts, "SLICE_WORDS", 3)
    more, again = counted()
    assert more > held and again == whole
