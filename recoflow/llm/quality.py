"""Quality rules with cross-document line frequency, in native expressions only.

Base rules come from a document's own text. Then its lines are normalised (white
space collapsed, lower-cased) and hashed, and for each host (``source``) the
documents that have a line are counted. A line is above the limits if at least
``MIN_DOCS`` documents of the host have it and those are more than ``MAX_SHARE``
percent of the host's documents; such lines are taken out (``clean``). A document is depleted, and rejected, if
fewer than ``LEFT_WORDS`` words or less than ``LEFT_SHARE`` percent of its words are left.

All per-text work happens inside the row, so texts are never shuffled: what moves
are line hashes, counted before the shuffle. Lambdas bind each array once.

Defined results: a null text has no words and fails the base rules; a null host is the
host ''; every row counts as a document of its own, repeated rows too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recoflow.llm.common import free_name, read, split_by_ids
from recoflow.session import materialize

MIN_DOCS, MAX_SHARE = 10, 2
LEFT_WORDS, LEFT_SHARE = 10, 30
SPACE = r"[\x20\x09-\x0D]+"
WINDOW = 5


def bind(value, body):
    """``body`` of ``value``, which is evaluated once."""
    return F.transform(F.array(value), body)[0]


def repeated(windows):
    """Words in windows that occur twice or more; ``windows`` are hashes in text order."""
    def covered(at):
        return F.aggregate(F.sequence(F.lit(0), F.size(at) - 1), F.lit(0), lambda total, k: total + F.least(
            F.lit(WINDOW), F.coalesce(F.get(at, k + 1) - F.get(at, k), F.lit(WINDOW))))

    def twins(ordered):
        mine = lambda k: F.get(ordered, k)["h"]
        twin = lambda k: F.coalesce((k > 0) & (F.get(ordered, F.greatest(k - 1, F.lit(0)))["h"] == mine(k)), F.lit(False)) \
            | F.coalesce(F.get(ordered, k + 1)["h"] == mine(k), F.lit(False))
        places = F.transform(F.filter(F.sequence(F.lit(0), F.size(ordered) - 1), twin), lambda k: F.get(ordered, k)["i"])
        return bind(F.array_sort(places), covered)

    ordered = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(bind(ordered, twins))


def base_rules(text):
    """A struct of n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of a text without null."""
    def of_words(w):
        windows = F.transform(F.sequence(F.lit(0), F.size(w) - WINDOW),
                              lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)]))
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.aggregate(w, F.lit(0).cast("long"), lambda total, x: total + F.length(x)).alias("word_chars"),
            F.when(F.size(w) <= WINDOW, F.lit(0)).otherwise(bind(windows, repeated)).cast("long").alias("n_repeat_words"))

    words = F.filter(F.split(text, SPACE), lambda x: x != "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return F.struct(
        bind(words, of_words).alias("w"),
        F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        bind(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"))


def tidy(line):
    """A line as it is counted: lower case, white space collapsed."""
    return F.trim(F.regexp_replace(F.lower(line), SPACE, " "))


def line_hashes(text):
    """(h, words, first) of each line with a word, ordered by h; first: the first line of that hash here."""
    tidied = F.filter(F.transform(F.split(F.lower(text), "\n"), lambda x: F.trim(F.regexp_replace(x, SPACE, " "))), lambda x: x != "")
    pairs = F.array_sort(F.transform(tidied, lambda x: F.struct(
        F.xxhash64(x).alias("h"), (F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit(""))) + 1).alias("words"))))
    return bind(pairs, lambda p: F.transform(p, lambda x, i: F.struct(
        x["h"].alias("h"), x["words"].alias("words"),
        F.when((i > 0) & (F.get(p, F.greatest(i - 1, F.lit(0)))["h"] == x["h"]), 0).otherwise(1).alias("first"))))


def judge(docs: DataFrame, min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE,
          left_words: int = LEFT_WORDS, left_share: float = LEFT_SHARE) -> DataFrame:
    """Base measures and verdict of each row of ``docs`` (doc_id, text, source)."""
    rows = _measures(docs, F.monotonically_increasing_id())
    return _verdicts(rows, _above(rows, min_docs, max_share), left_words, left_share).drop("row")


def _measures(docs: DataFrame, row) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("host"), base_rules(text).alias("b"),
                       line_hashes(text).alias("lines"), row.alias("row"))
    return materialize(rows, "measures")


def _above(rows: DataFrame, min_docs: int, max_share: float) -> DataFrame:
    """(host, h, row, words, first) of the lines above the limits."""
    lines = rows.select("row", "host", F.explode("lines").alias("l")).select("row", "host", "l.*")
    hosts = rows.groupBy("host").agg(F.count("*").alias("docs"))
    often = (lines.groupBy("host", "h").agg(F.sum("first").alias("having")).filter(F.col("having") >= min_docs)
             .join(hosts, "host").filter(100 * F.col("having") > max_share * F.col("docs")).select("host", "h"))
    return lines.join(often, ["host", "h"])


def _verdicts(rows: DataFrame, above: DataFrame, left_words: int, left_share: float) -> DataFrame:
    removed = above.groupBy("row").agg(F.sum("words").alias("removed"))
    out = rows.join(removed, "row", "left").withColumn("removed", F.coalesce("removed", F.lit(0)))
    n = F.col("b.w.n_words")
    left = n - F.col("removed")
    failed = (n < 10) | (100 * F.col("b.w.n_repeat_words") > 20 * n)
    return out.select(
        "row", "doc_id", n.alias("n_words"), "b.w.word_chars", "b.n_symbols", "b.n_dup_lines", "b.w.n_repeat_words",
        failed.alias("base_failed"),
        (~failed & ~((left < left_words) | (100 * left < left_share * n))).alias("kept"),
        F.col("removed").cast("long").alias("n_removed_words"))


def clean(docs: DataFrame, min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE,
          left_words: int = LEFT_WORDS, left_share: float = LEFT_SHARE) -> DataFrame:
    """The rows of ``docs`` that pass, all columns as they were, but without the lines above the limits.

    Lines are judged and measured as in ``judge``. Only rows that lose a line are joined with what they lose.
    """
    row = free_name(docs, "_row")
    docs = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    rows = _measures(docs, F.col(row))
    above = materialize(_above(rows, min_docs, max_share).select("row", "h", "words"), "above")
    failed = _verdicts(rows, above, left_words, left_share).filter(~F.col("kept")).select(F.col("row").alias(row))
    kept = docs.join(materialize(failed, "failed"), row, "left_anti")
    gone = free_name(docs, "_gone")
    lost = materialize(above.groupBy(F.col("row").alias(row)).agg(F.collect_set("h").alias(gone)), "lost")
    maybe, same = split_by_ids(kept, row, lost.select(row))
    stays = lambda line: ~F.coalesce(F.array_contains(F.col(gone), F.xxhash64(tidy(line))) & (tidy(line) != ""), F.lit(False))
    text = F.array_join(F.filter(F.split("text", "\n", -1), stays), "\n")
    changed = maybe.join(lost, row, "left").select(
        *[F.when(F.col(gone).isNull(), F.col("text")).otherwise(text).alias(c) if c == "text" else F.col(c) for c in docs.columns])
    return changed.unionByName(same).drop(row)


def keep(docs: DataFrame, **limits) -> DataFrame:
    """(doc_id) of the rows that pass."""
    return judge(docs, **limits).filter("kept").select("doc_id")


def op7_line_frequency(spark, sf_dir: str) -> DataFrame:
    return judge(read(spark, sf_dir, "documents"))


OP7_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS t FROM documents),
 w AS (SELECT doc_id, host, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, string_split(t, chr(10)) AS ls FROM d),
 g AS (SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM w)),
 rep AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p
         FROM g JOIN (SELECT doc_id, g FROM g GROUP BY 1, 2 HAVING count(*) > 1) USING (doc_id, g)) GROUP BY 1),
 l AS (SELECT doc_id, host, line, trim(regexp_replace(lower(line), '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS tidy
       FROM (SELECT doc_id, host, unnest(ls) AS line FROM w) WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
 dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM l GROUP BY 1),
 hosts AS (SELECT host, count(*) AS docs FROM d GROUP BY 1),
 often AS (SELECT host, tidy FROM (SELECT host, tidy, count(DISTINCT doc_id) AS k FROM l GROUP BY 1, 2) JOIN hosts USING (host)
           WHERE k >= 10 AND 100 * k > 2 * docs),
 gone AS (SELECT doc_id, sum(len(string_split(tidy, ' '))) AS removed FROM l JOIN often USING (host, tidy) GROUP BY 1),
 m AS (SELECT doc_id, len(w)::BIGINT AS n_words, len(array_to_string(w, ''))::BIGINT AS word_chars,
         len(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, coalesce(removed, 0)::BIGINT AS n_removed_words,
         len(w) < 10 OR 100 * coalesce(n_repeat_words, 0) > 20 * len(w) AS base_failed
       FROM w LEFT JOIN rep USING (doc_id) LEFT JOIN dup USING (doc_id) LEFT JOIN gone USING (doc_id))
SELECT *, NOT base_failed AND n_words - n_removed_words >= 10 AND 100 * (n_words - n_removed_words) >= 30 * n_words AS kept FROM m
"""
