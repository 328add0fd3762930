"""Line dedup by an exact set-similarity join of lines.

A line is what stands between line feeds; its set is its distinct runs of five
words (its whole word row if shorter), its words are lower-cased (A-Z) and
separated by white space. Two lines match at a Jaccard similarity of 0.75 or
more. Of lines that match, directly or through others, the first stays (by
doc_id, then place) and all later ones are removed. Lines without words stay.

The runs of a line (its tokens) are ordered by hash, and only its first
n - ceil(0.75 n) + 1 are posted: matching lines share one of those. A length and a
position filter cut candidates, 128 parity bits of each set cut more, and the sets
that are left are intersected. Equal lines are one class from the start, posted once
however many copies there are.

Members of lists of at most ``CROWD`` lines are all compared. Lines of longer lists
(common passages, large groups of near copies) are posted once more among
themselves, their rarest tokens first, so two lines that share a passage alone do
not meet. A pair that meets only in a long list has both lines there, so none is
lost. The lists of this second order are taken in rounds: neighbours, then hubs, and
then all pairs that are still in different components. Rounds decide cost, never the
result.

Only DataFrame operations run. ``_profile`` and its helpers are the Arrow form of the
first step, which the tests still drive.

Defined results: a null text stays null; rows with equal id and text are treated
alike; texts that share an id are told apart by a hash of the text; null ids
come first. Lines are compared by 64-bit hash.
"""

from __future__ import annotations

import string

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recoflow.llm import words
from recoflow.llm.common import components, free_name, read, split_by_ids
from recoflow.llm.jaccard_join import BEST_ROUNDS, SHINGLE, SLICE_BYTES, _apart, _best, _may_reach, _merged, _placed, _to_hubs
from recoflow.session import materialize

CROWD = 256             # members of a list that are all compared with each other at once
MANY = 16               # pairs a line that are left across components before they are taken in rounds
SET_BYTES = 1 << 20     # of text whose sets are built at once; a word takes about a hundred bytes meanwhile


def _line_rows(data, at) -> tuple[np.ndarray, np.ndarray]:
    """Where the lines of rows at[0]..at[-1] begin (n + 1 places, feeds included), and the row of each.

    An empty text is one line.
    """
    low = int(at[0])
    body = data[low:int(at[-1])]
    feeds = np.flatnonzero(body == 10) + low
    owner = np.searchsorted(at, feeds, "right") - 1
    row = np.concatenate([np.arange(len(at) - 1), owner])
    begin = np.concatenate([at[:-1], feeds + 1])
    order = np.lexsort((begin, row))
    return np.append(begin[order], at[-1]), row[order]


def _classes(data, begin) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A hash of each line's words (0: no words), the word hashes, each line's first word."""
    begins, ends, first = words.spans(data, begin, words.SPACED)
    hashed = words.hashes(data, begins, ends)
    whole = np.zeros(len(begin) - 1, np.uint64)
    some = np.flatnonzero(np.diff(first) > 0)
    if len(some):
        place = np.arange(len(hashed)) - np.repeat(first[:-1], np.diff(first))
        whole[some] = np.add.reduceat(words.mix(hashed + words.mix(place.astype(np.uint64))), first[some])
        whole[some] = np.maximum(words.mix(whole[some]), 1)
    return whole.view(np.int64), hashed, first


def _sets(hashed, first):
    grams, start = words.grams(hashed, first, SHINGLE)
    grams = grams.view(np.int64)
    row = np.repeat(np.arange(len(start) - 1), np.diff(start))
    order = np.lexsort((grams, row))
    grams, row = grams[order], row[order]
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (row[1:] != row[:-1])
    grams, row = grams[new], row[new]
    return grams, row, np.searchsorted(row, np.arange(len(start)))


def _profile(batches):
    """A row for each line (doc_id, text_hash, line, id), and (token, times) of repeated tokens."""
    for batch in batches:
        ids, hashes = batch.column("doc_id"), batch.column("text_hash")
        data, at = words.buffers(batch.column("text"))
        seen, tokens = np.zeros(0, np.int64), []
        for low, high in words.slices(at, SET_BYTES):
            begin, row = _line_rows(data, at[low:high + 1])
            whole, hashed, first = _classes(data, begin)
            line = np.arange(len(row)) - np.searchsorted(row, row)
            take = pa.array(row + low)
            yield pa.RecordBatch.from_arrays(
                [ids.take(take), hashes.take(take), pa.array(line), pa.array(whole), pa.nulls(len(row), pa.int64()),
                 pa.nulls(len(row), pa.int64())], names=["doc_id", "text_hash", "line", "id", "token", "times"])
            fresh = np.zeros(len(row), bool)
            fresh[np.unique(whole, return_index=True)[1]] = True
            fresh &= ~np.isin(whole, seen)
            seen = np.union1d(seen, whole)
            grams, owner, _ = _sets(hashed, first)
            tokens.append(grams[fresh[owner]])
        every = np.sort(np.concatenate(tokens)) if tokens else np.zeros(0, np.int64)
        edge = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1], [True]])) if len(every) else np.zeros(1, int)
        times = np.diff(edge)
        often = times > 1
        k = int(often.sum())
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(k, ids.type), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()),
             pa.array(every[edge[:-1]][often]), pa.array(times[often])],
            names=["doc_id", "text_hash", "line", "id", "token", "times"])


def _lines(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, line, words, id) of every line of ``docs`` (doc_id, text_hash, text).

    ``words`` are the line's words with one space between them, ``id`` is their hash (0: no words).
    """
    lines = docs.select("doc_id", "text_hash", F.posexplode(F.split("text", "\n", -1)).alias("line", "words"))
    ascii_only = F.length("words") == F.octet_length("words")
    lines = lines.withColumn("words", F.when(ascii_only, F.lower("words")).otherwise(
        F.translate("words", string.ascii_uppercase, string.ascii_lowercase)))
    text = F.col("words")
    uneven = text.startswith(" ") | text.endswith(" ")
    for space in ("  ", "\t", "\v", "\f", "\r"):
        uneven |= text.contains(space)
    lines = lines.withColumn("words", F.when(uneven, F.trim(F.regexp_replace("words", "[\\t-\\r ]+", " "))).otherwise(text))
    hashed = F.xxhash64("words")
    return lines.withColumn("id", F.when(F.col("words") == "", 0).when(hashed == 0, 1).otherwise(hashed))


def _tokens(lines: DataFrame) -> DataFrame:
    """(id, tokens) of ``lines`` (id, words): the hashes of each line's runs of five words, sorted.

    A shorter line has no tokens: its one run is its words, which only equal lines share.
    There is no filter, for Spark would push it down and compute the words once more for it.
    """
    lines = lines.select("id", F.split("words", " ").alias("w"))
    starts = F.when(F.size("w") >= SHINGLE, F.sequence(F.lit(0), F.size("w") - SHINGLE)).otherwise(F.array().cast("array<int>"))
    runs = F.transform(starts, lambda i: F.xxhash64(*[F.get("w", i + k) for k in range(SHINGLE)]))
    return lines.select("id", F.sort_array(F.array_distinct(runs)).alias("tokens"))


def _prefix(n):
    """How many tokens of a set of n are posted: partners of the set share one of them at least."""
    return n - F.floor((3 * n + 3) / 4).cast("int") + 1


def _listed(postings: DataFrame) -> DataFrame:
    """``postings`` (token, doc_id, n, pos) of the lists with two members or more, with the list's size."""
    whole = _list().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return postings.withColumn("size", F.count("*").over(whole)).filter("size > 1")


def _list():
    return Window.partitionBy("token").orderBy("n", "doc_id")


def _pairs(lists: DataFrame) -> DataFrame:
    """(a, b) of the lines that share a list and may be similar."""
    x, y = lists.alias("x"), lists.alias("y")
    pairs = x.join(y, (F.col("x.token") == F.col("y.token"))
                   & (F.struct("x.n", "x.doc_id") < F.struct("y.n", "y.doc_id")) & _may_reach("x.n", "x.pos", "y.n", "y.pos"))
    return pairs.select(F.col("x.doc_id").alias("a"), F.col("y.doc_id").alias("b")).distinct()


def _by_rarity(sets: DataFrame) -> DataFrame:
    """Postings (token, doc_id, n, pos) of ``sets`` (id, tokens), the tokens that fewest of them have first."""
    tokens = sets.select("id", F.size("tokens").alias("n"), F.explode("tokens").alias("token"))
    tokens = tokens.withColumn("times", F.count("*").over(Window.partitionBy("token")))
    tokens = tokens.withColumn("pos", F.row_number().over(Window.partitionBy("id").orderBy("times", "token")) - 1)
    return tokens.filter(F.col("pos") < _prefix(F.col("n"))).select("token", F.col("id").alias("doc_id"), "n", "pos")


def _linked(docs: DataFrame) -> DataFrame:
    """(node, component) of the classes of lines in ``docs`` (doc_id, text_hash, text) that are linked."""
    tokens = _tokens(_lines(docs).select("id", "words"))
    n = F.size("tokens")
    posted = tokens.select("id", n.alias("n"), F.slice("tokens", F.lit(1), _prefix(n)).alias("tokens")).dropDuplicates(["id"])
    lists = materialize(_listed(posted.select(F.col("id").alias("doc_id"), "n", F.posexplode("tokens").alias("pos", "token"))), "lists")

    pairs = materialize(_pairs(lists.filter(F.col("size") <= CROWD)), "pairs")
    crowd = materialize(lists.filter(F.col("size") > CROWD).select(F.col("doc_id").alias("id")).distinct(), "crowd")
    wanted = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).unionByName(crowd)
    wanted = materialize(wanted.distinct(), "wanted")
    some, _ = split_by_ids(_lines(docs).select("id", "words"), "id", wanted)
    sets = _tokens(some.join(wanted, "id").dropDuplicates(["id"]))
    sets = materialize(sets.select("id", "tokens", F.size("tokens").alias("n"), *[_parity(k).alias(f"parity{k}") for k in (0, 1)]), "sets")
    if crowd.isEmpty():
        return materialize(components(_similar(sets, pairs)), "joined")

    lists = materialize(_listed(_by_rarity(sets.join(crowd, "id", "left_semi"))), "crowd-lists")
    joined = materialize(components(_similar(sets, pairs.unionByName(_nearest(lists)).distinct())), "joined")
    return _linked_across(lists, sets, joined)


def _nearest(lists: DataFrame) -> DataFrame:
    """(a, b): of the entries right before it in its lists, the one a line meets most often."""
    before = {name: F.lag(c).over(_list()) for name, c in (("before", "doc_id"), ("before_n", "n"), ("before_pos", "pos"))}
    near = lists.withColumns(before).filter(F.col("before").isNotNull() & _may_reach("before_n", "before_pos", "n", "pos"))
    return (near.groupBy("doc_id", "before").agg(F.count("*").alias("c"))
            .groupBy("doc_id").agg(F.max_by("before", F.struct("c", "before")).alias("a"))
            .select("a", F.col("doc_id").alias("b")))


def _parity(half: int):
    """Of 64 groups that one half of all hashes fall into: a bit each, whether ``tokens`` holds an odd number of the group."""
    bit = lambda t: F.call_function("shiftleft", F.lit(1).cast("long"), t.bitwiseAND(63).cast("int"))
    mine = lambda t: F.when(t.bitwiseAND(64) == 64 * half, bit(t)).otherwise(0)
    return F.aggregate("tokens", F.lit(0).cast("long"), lambda found, t: found.bitwiseXOR(mine(t)))


def _similar(sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """Of ``pairs`` (a, b) those whose ``sets`` (id, tokens, n, parity0, parity1) are similar."""
    return _verified(sets, _close(sets, pairs))


def _close(sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """Of ``pairs`` (a, b, ...) those that may be similar by their parities.

    Each parity bit that differs stands for a token that only one of them has; similar
    sets differ in a seventh of their tokens at most.
    """
    names = pairs.columns
    for me in "ab":
        marks = sets.select(F.col("id").alias(me), *[F.col(c).alias(f"{me}_{c}") for c in ("n", "parity0", "parity1")])
        pairs = pairs.join(marks, me)
    differ = sum(F.bit_count(F.col(f"a_parity{k}").bitwiseXOR(F.col(f"b_parity{k}"))) for k in (0, 1))
    return materialize(pairs.filter(7 * differ <= F.col("a_n") + F.col("b_n")).select(*names), "close")


def _verified(sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """Of ``pairs`` (a, b) those whose ``sets`` (id, tokens) are similar; only sets of pairs are moved."""
    needed = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id")))
    sets = sets.select("id", "tokens").join(needed, "id", "left_semi")
    found = pairs.select("a", "b")
    for me in "ab":
        found = found.join(sets.toDF(me, f"{me}_tokens"), me)
    both = F.size(F.array_intersect("a_tokens", "b_tokens")).cast("long")
    total = (F.size("a_tokens") + F.size("b_tokens")).cast("long")
    return materialize(found.filter(175 * both >= 75 * total).select("a", "b"), "links")     # 100 i >= 75 (total - i)


def _linked_across(lists: DataFrame, sets: DataFrame, joined: DataFrame) -> DataFrame:
    """``joined`` (node, component) with the links that members of crowded ``lists`` have across components."""
    at = _apart(lists.select("token", "doc_id", "n", "pos"), joined)
    if at.isEmpty():
        return joined
    # each line left apart meets two hubs of its lists: the members in the longest lists, and some by chance
    long = at.join(at.groupBy("token").agg(F.count("*").alias("size")), "token")
    weights = materialize(long.groupBy("doc_id").agg(F.sum("size").alias("weight")), "weights")
    placed = materialize(_placed(at, joined), "placed")
    links = _similar(sets, _to_hubs(placed, weights, 0).unionByName(_to_hubs(placed, weights, 1)).distinct())
    if not links.isEmpty():
        joined = _merged(links, joined)
        placed = _placed(_apart(at, joined), joined)

    # last: whatever is left in one list but not in one component
    x, y = placed.alias("x"), placed.alias("y")
    pairs = x.join(y, (F.col("x.token") == F.col("y.token")) & (F.col("x.component") != F.col("y.component"))
                   & (F.struct("x.n", "x.doc_id") < F.struct("y.n", "y.doc_id"))
                   & _may_reach("x.n", "x.pos", "y.n", "y.pos"))
    pairs = pairs.groupBy(F.col("x.doc_id").alias("a"), F.col("y.doc_id").alias("b")).agg(F.count("*").alias("met"))
    pairs = _close(sets, pairs)
    # most pairs of a large group fall away once each member has met the one it shares most with
    for _ in range(BEST_ROUNDS):
        if pairs.count() <= MANY * weights.count():
            break
        best = materialize(_best(pairs), "best")
        joined = _merged(_verified(sets, best), joined)
        part = lambda side: joined.select(F.col("node").alias(side), F.col("component").alias(f"{side}_in"))
        left = pairs.join(best, ["a", "b"], "left_anti").join(part("a"), "a", "left").join(part("b"), "b", "left")
        left = left.filter(F.coalesce("a_in", "a") != F.coalesce("b_in", "b"))
        pairs = materialize(left.select("a", "b", "met"), "second")
    links = _verified(sets, pairs)
    return joined if links.isEmpty() else _merged(links, joined)


def _numbered(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")


def _firsts(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, text_hash, line, id) of every line, and (id, first) of the classes that match another line: the one that stays."""
    lines = materialize(_lines(docs).select("doc_id", "text_hash", "line", "id"), "lines")
    joined = _linked(docs)
    first = lines.filter("id <> 0").groupBy("id").agg(F.min(F.struct("doc_id", "text_hash", "line")).alias("first"), F.count("*").alias("copies"))
    first = first.join(joined.withColumnRenamed("node", "id"), "id", "left").filter("copies > 1 OR component IS NOT NULL")
    first = materialize(first.select("id", "first", "component"), "firsts")
    whole = first.groupBy("component").agg(F.min("first").alias("of_all"))
    return lines, first.join(whole, "component", "left").select("id", F.coalesce("of_all", "first").alias("first"))


def line_fates(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, line, has_words, stays) of every line of ``docs`` (doc_id, text)."""
    lines, firsts = _firsts(_numbered(docs).filter("text IS NOT NULL"))
    stays = F.col("first").isNull() | F.col("first").eqNullSafe(F.struct("doc_id", "text_hash", "line"))
    return lines.join(firsts, "id", "left").select("doc_id", "text_hash", "line", (F.col("id") != 0).alias("has_words"), stays.alias("stays"))


def remove_lines(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text, ...) with later matches of lines taken out of ``text``, and a column ``n_removed``.

    Only documents that lose a line are moved.
    """
    lost = line_fates(docs).filter(~F.col("stays")).groupBy("doc_id", "text_hash").agg(
        F.collect_set(F.col("line").cast("int")).alias("gone"))
    key, number = free_name(docs, "text_hash"), free_name(docs, "n_removed")
    mine = [free_name(docs, n) for n in ("_lost_id", "_lost_hash", "_lost_gone")]
    lost = materialize(lost.toDF(*mine), "lost")
    lost_id, lost_hash, gone = mine
    maybe, same = split_by_ids(docs.withColumn(key, F.xxhash64("text")), key, lost.select(lost_hash))
    # the outer lambda splits a text once, not once per line
    rest = F.transform(F.array(F.split("text", "\n", -1)), lambda lines: F.array_join(
        F.transform(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone), lambda i: F.get(lines, i)), "\n"))
    text = F.when(F.col(gone).isNull(), F.col("text")).otherwise(rest[0])
    changed = maybe.join(lost, F.col("doc_id").cast("long").eqNullSafe(F.col(lost_id))
                         & (F.col(key) == F.col(lost_hash)), "left")
    changed = changed.select(*[text.alias("text") if c == "text" else F.col(c) for c in docs.columns],
                             F.when(F.col(gone).isNull(), 0).otherwise(F.size(gone)).cast("long").alias(number))
    return changed.unionByName(same.select(*docs.columns, F.lit(0).cast("long").alias(number)))


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` without later matches; documents that lose their last words go, all others stay."""
    number = free_name(docs, "n_removed")
    out = remove_lines(docs)
    empty = ~F.coalesce(F.col("text"), F.lit("")).rlike("[^ \\t-\\r]")
    return out.filter(~((F.col(number) > 0) & empty)).select(*docs.columns)


def op9_line_set_join(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_lines(docs).select(
        "doc_id", "n_removed", F.md5("text").alias("text_md5"),
        F.length("text").cast("long").alias("n_chars"))


OP9_SQL = r"""
WITH RECURSIVE raw AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents),
 l AS (SELECT doc_id, i, ls[i] AS line, string_split(trim(regexp_replace(
         translate(ls[i], 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+', ' ', 'g'), ' '), ' ') AS w
       FROM (SELECT *, unnest(range(1, len(ls) + 1)) AS i FROM raw)),
 c AS MATERIALIZED (SELECT array_to_string(w, ' ') AS k, any_value(w) AS w, min((doc_id, i)) AS first FROM l WHERE w <> [''] GROUP BY 1),
 s AS MATERIALIZED (SELECT DISTINCT k, array_to_string(w[j:j + 4], ' ') AS g
       FROM (SELECT k, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS j FROM c)),
 n AS MATERIALIZED (SELECT k, count(*) AS n FROM s GROUP BY 1),
 e AS MATERIALIZED (SELECT a, b FROM (SELECT x.k AS a, y.k AS b, count(*) AS z FROM s x JOIN s y USING (g) WHERE x.k <> y.k GROUP BY 1, 2)
       JOIN n p ON p.k = a JOIN n q ON q.k = b WHERE 100 * z >= 75 * (p.n + q.n - z)),
 r AS (SELECT k AS a, k AS b FROM c UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
 best AS (SELECT DISTINCT min(c.first) AS first FROM r JOIN c ON c.k = r.b GROUP BY r.a),
 fate AS (SELECT doc_id, i, line, w = [''] OR first IS NOT NULL AS stays FROM l LEFT JOIN best ON first = (doc_id, i)),
 f AS (SELECT doc_id, count(*) FILTER (NOT stays) AS n_removed, coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (stays), '') AS t
       FROM fate GROUP BY 1)
SELECT doc_id, n_removed, md5(t) AS text_md5, len(t)::BIGINT AS n_chars FROM f
"""
