"""Article text -> TF-IDF and graph keywords -> article profile.

Scale notes
-----------
* Term counts of a document are computed inside its row; document frequencies are
  counted for a batch of articles at once (``word_counts``) and combined before the shuffle.
* The IDF table holds every term. How it is joined is left to the planner,
  which knows its size.
* The graphs and rank iterations of a batch of articles are array operations
  (``word_graphs``): nothing is shuffled before the ranked terms, and terms that
  cannot be among the best stay in the batch.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recoflow.functions import text as tx
from recoflow.operators import word_counts, word_graphs
from recoflow.operators.ranks import range_rank


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    A derived column that a lambda mentions may be substituted into the lambda
    by the optimizer and then be computed once per element; a lambda variable
    cannot.
    """
    return F.transform(F.array(value), body)[0]


def tokenize(docs: DataFrame, text_col: str = "sentence", min_len: int = 3,
             stopwords: Sequence[str] = (),
             tokenizer: Callable[[Column], Column] | None = None) -> DataFrame:
    """(article_id, channel_id, words): tags removed, keyword candidates kept.

    ``tokenizer`` replaces the built-in word split; it maps a text column to an
    array<string> column and may be a pandas UDF wrapping any segmenter.
    """
    clean = tx.strip_tags(F.col(text_col))
    raw = tokenizer(clean) if tokenizer else tx.split_words(clean)
    words = F.filter(raw, lambda w: tx.is_keyword(w, min_len, stopwords))
    return docs.select("article_id", "channel_id", words.alias("words"))


def term_counts(tokens: DataFrame) -> DataFrame:
    """(article_id, channel_id, terms array<struct<term, tf>>), sorted by term.

    Sort the words, find where each run starts, take the distance to the next
    start: all within the row.
    """
    def runs(w: Column) -> Column:
        first = F.transform(w, lambda x, i: F.when((i == 0) | (x != F.get(w, i - 1)), i))
        return F.filter(first, lambda i: i.isNotNull())

    def count(w: Column, starts: Column) -> Column:
        return F.transform(starts, lambda s, n: F.struct(
            F.get(w, s).alias("term"),
            (F.coalesce(F.get(starts, n + 1), F.size(w)) - s).cast("long").alias("tf")))

    terms = let(F.sort_array("words"), lambda w: let(runs(w), lambda starts: count(w, starts)))
    return tokens.select("article_id", "channel_id", terms.alias("terms"))


def term_rows(tokens: DataFrame) -> DataFrame:
    """(article_id, channel_id, t struct<term, tf>): one row per term of an article.

    The outer form of explode: the inner one is preceded by an inferred
    non-empty filter that would compute the counts a second time.
    """
    return (term_counts(tokens)
            .select("article_id", "channel_id", F.explode_outer("terms").alias("t"))
            .where(F.col("t").isNotNull()))


def idf_table(tokens: DataFrame, vocab_size: int | None = None) -> DataFrame:
    """(keyword, idf, index): every term of the corpus, or the ``vocab_size`` most frequent if asked for.

    idf = ln((m + 1) / (df + 1)) over m documents; the index is the frequency
    rank, ties by term, counted in ranges of terms.
    """
    counted = tokens.select("words").mapInArrow(word_counts.counts, word_counts.COUNTS)
    frequencies = counted.groupBy("keyword").agg(F.sum("df").alias("df"), F.sum("n").alias("n"))
    if vocab_size is not None:
        frequencies = frequencies.orderBy(F.desc("n"), "keyword").limit(vocab_size)
    documents = tokens.agg(F.count(F.lit(1))).scalar()
    idf = frequencies.select("keyword", "n", F.log((documents + 1.0) / (F.col("df") + 1.0)).alias("idf"))
    return range_rank(idf, [F.desc("n"), F.col("keyword")], "index").select("keyword", "idf", "index")


def _join_idf(df: DataFrame, idf: DataFrame) -> DataFrame:
    return df.join(idf.select("keyword", "idf"), "keyword")


def tfidf_topk(tokens: DataFrame, idf: DataFrame, k: int = 20) -> DataFrame:
    """(article_id, channel_id, keyword, tfidf): the k best terms of each article.

    Values are rounded to 4 places; ties go to the smaller term.
    """
    scored = _join_idf(
        term_rows(tokens).select("article_id", "channel_id", F.col("t.term").alias("keyword"), "t.tf"),
        idf,
    ).select("article_id", "channel_id", "keyword",
             F.round(F.col("tf") * F.col("idf"), 4).alias("tfidf"))
    best = Window.partitionBy("article_id").orderBy(F.desc("tfidf"), "keyword")
    return (scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .drop("rank"))


def _candidates(docs: DataFrame, text_col: str, min_len: int, stopwords: Sequence[str],
                tokenizer: Callable[[Column], Column] | None) -> DataFrame:
    """(article_id, channel_id, words): words that are no candidates keep their place as the empty term."""
    split = tokenizer(F.col(text_col)) if tokenizer else tx.split_words(F.col(text_col))
    words = F.transform(split, lambda w: F.when(tx.is_keyword(w, min_len, stopwords), w).otherwise(""))
    return docs.select("article_id", "channel_id", words.alias("words"))


def _schema(docs: DataFrame, rest: str) -> T.StructType:
    fields = [T.StructField(c, docs.schema[c].dataType) for c in ("article_id", "channel_id")]
    return T.StructType([*fields, *T.StructType.fromDDL(rest).fields])


def word_graph(docs: DataFrame, text_col: str = "sentence", window: int = 5, min_len: int = 3,
               stopwords: Sequence[str] = (),
               tokenizer: Callable[[Column], Column] | None = None) -> DataFrame:
    """(article_id, channel_id, nodes): the co-occurrence graph of each article.

    Two keyword candidates are linked when they are less than ``window`` words
    apart, counting every word in between. ``nodes`` is sorted by ``i``, which
    numbers the article's candidates from 1; each node has its term and ``nbrs``,
    the numbers of its neighbours, one entry per common occurrence.
    """
    words = _candidates(docs, text_col, min_len, stopwords, tokenizer)
    return words.mapInArrow(word_graphs.node_lists(window),
                            _schema(words, "nodes array<struct<i: int, term: string, nbrs: array<int>>>"))


def textrank(docs: DataFrame, text_col: str = "sentence", window: int = 5, k: int = 20,
             iters: int = 10, damping: float = 0.85, min_len: int = 3,
             stopwords: Sequence[str] = (),
             tokenizer: Callable[[Column], Column] | None = None) -> DataFrame:
    """(article_id, channel_id, keyword, textrank): the k best-ranked terms.

    Damped rank over the word graph: every iteration sets each node to
    (1 - d) + d * sum(w / weight(neighbour) * rank(neighbour)), all nodes at once.
    Ranks are then scaled as (r - min/10) / (max - min/10). Order is by the
    value rounded to 8 places, ties by term. Tags are not removed first.
    A node without neighbours has no rank.
    """
    words = _candidates(docs, text_col, min_len, stopwords, tokenizer)
    graph = words.mapInArrow(word_graphs.best_ranked(window, k, iters, damping, 8), _schema(
        words, "low double, high double, found array<struct<term: string, r: double>>"))
    lo, hi = F.col("low"), F.col("high")
    best = F.transform("found", lambda x: F.struct(
        (-F.round((x["r"] - lo / 10) / (hi - lo / 10), 8)).alias("neg"), x["term"].alias("term")))
    return graph.select(
        "article_id", "channel_id", F.explode_outer(F.slice(F.sort_array(best), 1, k)).alias("b"),
    ).where(F.col("b").isNotNull()).select(
        "article_id", "channel_id", F.col("b.term").alias("keyword"), (-F.col("b.neg")).alias("textrank"))


def keyword_weights(ranked: DataFrame, idf: DataFrame) -> DataFrame:
    """(article_id, channel_id, keyword, weight = textrank * idf); unknown terms drop out."""
    return _join_idf(ranked, idf).select(
        "article_id", "channel_id", "keyword", (F.col("textrank") * F.col("idf")).alias("weight"))


def topics(tfidf: DataFrame, ranked: DataFrame, global_topics: bool = False) -> DataFrame:
    """(article_id, topics): terms that both rankings chose for the article.

    With ``global_topics`` a TF-IDF term counts as soon as any article ranked
    it. Both inputs hold at most k rows per article, so grouping by article is
    bounded.
    """
    if global_topics:
        both = tfidf.select("article_id", "keyword").join(
            ranked.select("keyword").distinct(), "keyword", "left_semi")
    else:
        both = tfidf.select("article_id", "keyword").join(
            ranked.select("article_id", "keyword"), ["article_id", "keyword"], "left_semi")
    return both.groupBy("article_id").agg(F.array_sort(F.collect_set("keyword")).alias("topics"))


def article_profile(ranked: DataFrame, tfidf: DataFrame, idf: DataFrame,
                    global_topics: bool = False) -> DataFrame:
    """(article_id, channel_id, keywords map<term, weight>, topics array<term>).

    One grouping builds both: each ranked term carries its weight if its idf is
    known and a mark if it is a topic. Articles need at least one of each.
    """
    if global_topics:
        chosen = topics(tfidf, ranked, global_topics=True)
        weights = keyword_weights(ranked, idf).groupBy("article_id", "keyword").agg(
            F.min("channel_id").alias("channel_id"), F.max("weight").alias("weight"))
        return weights.groupBy("article_id").agg(
            F.min("channel_id").alias("channel_id"), _weight_map().alias("keywords"),
        ).join(chosen, "article_id")
    marked = tfidf.select("article_id", "keyword", F.lit(True).alias("topic"))
    known = idf.select("keyword", "idf")
    terms = (
        ranked.join(marked, ["article_id", "keyword"], "left")
        .join(known, "keyword", "left")
        .select("article_id", "channel_id", "keyword", "topic",
                (F.col("textrank") * F.col("idf")).alias("weight"))
        .groupBy("article_id", "keyword")
        .agg(F.min("channel_id").alias("channel_id"), F.max("weight").alias("weight"),
             F.max("topic").alias("topic"))
    )
    return (
        terms.groupBy("article_id").agg(
            F.min("channel_id").alias("channel_id"), _weight_map().alias("keywords"),
            F.array_sort(F.collect_list(F.when(F.col("topic"), F.col("keyword")))).alias("topics"))
        .where((F.size("keywords") > 0) & (F.size("topics") > 0))
    )


def _weight_map() -> Column:
    """keyword -> weight of the grouped rows, terms without a weight left out."""
    known = F.when(F.col("weight").isNotNull(), F.struct("keyword", "weight"))
    return F.map_from_entries(F.array_sort(F.collect_list(known)))


def article_labels(docs: DataFrame, idf: DataFrame, text_col: str = "sentence", k: int = 20,
                   stopwords: Sequence[str] = (), **rank_options) -> tuple[DataFrame, DataFrame]:
    """(tfidf, textrank) keyword tables of new articles under a known IDF table."""
    tokens = tokenize(docs, text_col, stopwords=stopwords)
    return (tfidf_topk(tokens, idf, k),
            textrank(docs, text_col, k=k, stopwords=stopwords, **rank_options))
