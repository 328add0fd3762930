"""Exact Jaccard join on word shingles: a T-occurrence search in the manner of DivideSkip.

A document's set is its distinct shingles of five words. A partner of a set of n
shares at least T = ceil(0.75 n) of them, so of its n inverted lists the T - 1
longest can be set aside: every partner is in one of the n - T + 1 shortest.
Those short lists are merged by Spark (postings dealt and sorted by shingle),
and the candidates they give are probed in the long lists by bisection, stopping
where T can no longer be reached. Lists are ordered by length through a table of
frequent shingles with at most ``FREQUENT`` entries, ties by hash. The order is
the same for all documents, which is what makes the join exact; how well the
table knows the lengths only decides how many candidates there are.

Groups of copies cost no pairs: equal word sequences become one class first, and
of each short list only neighbours are compared at first. Then each text left
apart from others of its lists meets the hub of a list, the member in the longest
lists: of a group of near copies that is the text they were made from. Lists whose
documents are in one component are done after each round; only pairs across
components are compared at the end, all of them. Rounds decide cost, never the
result. Lists of frequent shingles are dealt to several tasks.

Defined results: null and wordless texts have an empty set and no links; rows
with equal id and text are one document; an id with several texts links each of
them; a null id takes part but is never a component id (null if alone).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recoflow.llm import words
from recoflow.llm.common import components, read, split_by_ids
from recoflow.session import materialize

SHINGLE = 5
FREQUENT = 1 << 21          # shingles with a known list length: 32 MB at most
SPLIT = 512                 # postings of a frequent shingle that one task takes
SLICE_BYTES = 4 << 20
HUB_ROUNDS = 2              # rounds that compare each text with one hub
HUB_GAIN = 64               # a round that links less than this part of the linked texts is the last of them
BEST_ROUNDS = 3             # rounds that try each text's best pair before all that are left


def _sets(column):
    """(first row, word hashes, each row's first word, shingles, each row's first shingle) by slices."""
    data, at = words.buffers(column)
    for low, high in words.slices(at, SLICE_BYTES):
        begins, ends, first = words.spans(data, at[low:high + 1], words.SPACED)
        hashed = words.hashes(data, begins, ends)
        grams, start = words.grams(hashed, first, SHINGLE)
        grams = grams.view(np.int64)
        row = np.repeat(np.arange(high - low), np.diff(start))
        order = np.lexsort((grams, row))
        grams, row = grams[order], row[order]
        new = np.ones(len(grams), bool)
        new[1:] = (grams[1:] != grams[:-1]) | (row[1:] != row[:-1])
        grams, row = grams[new], row[new]
        yield low, hashed, first, grams, np.searchsorted(row, np.arange(high - low + 1))


def _profile(batches):
    """Rows of documents (key, n) and of shingles that several texts of a batch have (token, count)."""
    for batch in batches:
        ids = batch.column("doc_id")
        keys, sizes, tokens, seen = [], [], [], set()
        for low, hashed, first, grams, start in _sets(batch.column("text")):
            raw = memoryview(np.ascontiguousarray(hashed)).cast("B")
            fresh = np.zeros(len(start) - 1, bool)
            for r in range(len(start) - 1):
                key = hashlib.blake2b(raw[8 * first[r]:8 * first[r + 1]], digest_size=16).digest()
                keys.append(key)
                fresh[r] = key not in seen
                seen.add(key)
            n = np.diff(start)
            sizes.append(n)
            tokens.append(grams[np.repeat(fresh, n)])
        n = np.concatenate(sizes) if sizes else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays(
            [ids, pa.array(keys, pa.binary()), pa.array(n), pa.nulls(len(ids), pa.int64()), pa.nulls(len(ids), pa.int64())],
            names=["doc_id", "key", "n", "token", "times"])
        every = np.sort(np.concatenate(tokens)) if tokens else np.zeros(0, np.int64)
        edge = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1], [True]])) if len(every) else np.zeros(1, int)
        times = np.diff(edge)
        often = times > 1
        k = int(often.sum())
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(k, ids.type), pa.nulls(k, pa.binary()), pa.nulls(k, pa.int64()),
             pa.array(every[edge[:-1]][often]), pa.array(times[often])], names=["doc_id", "key", "n", "token", "times"])


class Order:
    """Frequent shingles and about how many documents have each."""

    def __init__(self, tokens: np.ndarray, times: np.ndarray):
        by = np.argsort(tokens)
        self.tokens, self.times = tokens[by], times[by]

    def length(self, tokens: np.ndarray) -> np.ndarray:
        if not len(self.tokens):
            return np.zeros(len(tokens), np.int64)
        at = np.minimum(np.searchsorted(self.tokens, tokens), len(self.tokens) - 1)
        return np.where(self.tokens[at] == tokens, self.times[at], 0)


def _postings(shipped, need):
    """(token, salt, doc_id, n, pos) of each document's shortest lists."""
    def run(batches):
        order = shipped.value
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            for low, _, _, grams, start in _sets(batch.column("text")):
                n = np.diff(start)
                row = np.repeat(np.arange(len(n)), n)
                length = order.length(grams)
                by = np.lexsort((grams, length, row))
                take = n - need(n) + 1
                pos = np.arange(len(grams)) - start[row]
                keep = pos < take[row]
                by, row, pos = by[keep], row[keep], pos[keep]
                doc = ids[low:low + len(n)][row]
                parts = -(-length[by] // SPLIT)
                salt = np.where(parts > 0, words.mix(doc.astype(np.int64).view(np.uint64)) % np.maximum(parts, 1).astype(np.uint64), 0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(grams[by]), pa.array(np.where(parts > 0, salt.astype(np.int64) + 1, 0).astype(np.int32)), pa.array(doc),
                     pa.array(n[row].astype(np.int32)), pa.array(pos.astype(np.int32))],
                    names=["token", "salt", "doc_id", "n", "pos"])
    return run


_LISTS = "token long, salt int, doc_id long, n int, pos int, before long, before_n int, before_pos int"


def _shared(batches):
    """Of sorted postings, those whose list holds another document, each with the entry before it.

    All postings of frequent shingles stay: the rest of their list is in other tasks.
    The last entry of a batch waits for the next batch.
    """
    names = ["token", "salt", "doc_id", "n", "pos"]
    held = None                              # the last two entries so far; the last is not out yet
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in names]
        if held is not None:
            cols = [np.concatenate([h, c]) for h, c in zip(held, cols)]
        yield _entries(cols, 0 if held is None or len(held[0]) < 2 else 1, len(cols[0]) - 1)
        held = [c[-2:] for c in cols]
    if held is not None:
        yield _entries(held, len(held[0]) - 1, len(held[0]))


def _entries(cols: list[np.ndarray], first: int, last: int) -> pa.RecordBatch:
    token, salt = cols[:2]
    same = np.zeros(len(token) + 1, bool)    # whether an entry continues the list of the one before
    same[1:-1] = (token[1:] == token[:-1]) & (salt[1:] == salt[:-1])
    at = np.arange(first, last)
    at = at[same[at] | same[at + 1] | (salt[at] > 0)]
    alone = ~same[at]
    before = [pa.array(c[np.maximum(at - 1, 0)], mask=alone) for c in cols[2:]]
    return pa.RecordBatch.from_arrays([*(pa.array(c[at]) for c in cols), *before],
                                      names=["token", "salt", "doc_id", "n", "pos", "before", "before_n", "before_pos"])


def _needed(n):
    """ceil(0.75 n): what a partner of a set of n must share with it."""
    return (3 * n + 3) // 4


def _probe(shipped):
    """(a, b) of the pairs of texts whose sets are similar."""
    def run(batches):
        order = shipped.value
        for batch in batches:
            left = [g[s:e] for _, _, _, g, st in _sets(batch.column("a_text")) for s, e in zip(st[:-1], st[1:])]
            right = [g[s:e] for _, _, _, g, st in _sets(batch.column("b_text")) for s, e in zip(st[:-1], st[1:])]
            good = np.array([_reaches(order, a, b) for a, b in zip(left, right)], bool)
            kept = batch.filter(pa.array(good))
            yield pa.RecordBatch.from_arrays([kept.column("a"), kept.column("b")], names=["a", "b"])
    return run


def _reaches(order: Order, a: np.ndarray, b: np.ndarray) -> bool:
    """Whether sorted sets a and b share enough: short lists of a first, then its long ones step by step."""
    total = len(a) + len(b)
    need = -(-75 * total // 175)             # 100 i >= 75 (total - i)
    if not len(a) or min(len(a), len(b)) < need:
        return False
    by = np.lexsort((a, order.length(a)))
    short = len(a) - _needed(len(a)) + 1
    found, first, step = 0, 0, short
    while first < len(a):
        part = a[by[first:first + step]]
        at = np.minimum(np.searchsorted(b, part), len(b) - 1)
        found += int((b[at] == part).sum())
        if not found or found + len(a) - first - len(part) < need:
            return False
        first, step = first + step, 256
    return found >= need


def _similar(texts: DataFrame, pairs: DataFrame, shipped) -> DataFrame:
    """Of ``pairs`` (a, b) those whose ``texts`` (doc_id, text) are similar."""
    both = (pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("a_text")), "a")
            .join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("b_text")), "b"))
    return materialize(both.select("a", "a_text", "b", "b_text")
                       .mapInArrow(_probe(shipped), "a long, b long").distinct(), "links")


def frequent(counts: DataFrame):
    """A broadcast ``Order`` from ``counts`` (token, times): of the lists of 4 documents or more, the longest.

    Whole powers of two are taken, as many as fit into ``FREQUENT`` entries.
    """
    often = materialize(counts.groupBy("token").agg(F.sum("times").alias("times")).filter(F.col("times") >= 4), "often")
    sizes = dict(often.groupBy(F.floor(F.log2("times")).alias("k")).count().collect())
    low = min((k for k in sizes if sum(n for j, n in sizes.items() if j >= k) <= FREQUENT), default=62)
    table = often.filter(F.col("times") >= F.lit(1 << low)).toPandas()
    order = Order(table["token"].to_numpy(np.int64), table["times"].to_numpy(np.int64))
    return counts.sparkSession.sparkContext.broadcast(order)


def linked(postings: DataFrame, texts: DataFrame, shipped) -> DataFrame:
    """(node, component) of the linked texts, from their short lists."""
    lists = materialize(postings.repartition("token", "salt").sortWithinPartitions("token", "salt", "n", "doc_id")
                        .mapInArrow(_shared, _LISTS), "lists")
    ids = materialize(lists.select("doc_id").distinct(), "candidates")
    some, _ = split_by_ids(texts, "doc_id", ids)
    some = materialize(some.join(ids, "doc_id").dropDuplicates(["doc_id", "text"]), "texts")

    # first round: of the entries right before it in its lists, the one a text meets most often
    near = lists.filter(F.col("before").isNotNull() & (F.col("before") != F.col("doc_id"))
                        & _may_reach("before_n", "before_pos", "n", "pos"))
    first = (near.groupBy("doc_id", "before").agg(F.count("*").alias("c"))
             .groupBy("doc_id").agg(F.max_by("before", F.struct("c", "before")).alias("a"))
             .select("a", F.col("doc_id").alias("b")))
    joined = materialize(components(_similar(some, first, shipped)), "joined")

    # hub rounds: each text left apart meets the hub of one of its lists, the member in the longest lists
    at = _apart(lists.select("token", "doc_id", "n", "pos"), joined)
    long = at.join(at.groupBy("token").agg(F.count("*").alias("size")), "token")
    weights = materialize(long.groupBy("doc_id").agg(F.sum("size").alias("weight")), "weights")
    for turn in range(HUB_ROUNDS):
        links = _similar(some, _to_hubs(_placed(at, joined), weights, turn), shipped)
        found = links.count()
        if not found:
            break
        joined = _merged(links, joined)
        if found * HUB_GAIN < joined.count():
            break

    # last: whatever is left in one list but not in one component
    at = _placed(_apart(at, joined), joined)
    x, y = at.alias("x"), at.alias("y")
    pairs = x.join(y, (F.col("x.token") == F.col("y.token")) & (F.col("x.component") != F.col("y.component"))
                   & (F.struct("x.n", "x.doc_id") < F.struct("y.n", "y.doc_id"))
                   & _may_reach("x.n", "x.pos", "y.n", "y.pos"))
    pairs = pairs.groupBy(F.col("x.doc_id").alias("a"), F.col("y.doc_id").alias("b")).agg(F.count("*").alias("met"))
    pairs = materialize(pairs, "second")
    # most pairs of a large group fall away once each member has met the one it shares most with
    for last in (*[False] * BEST_ROUNDS, True):
        if pairs.isEmpty():
            break
        now = pairs if last else pairs.join(_best(pairs), ["a", "b"])
        links = _similar(some, now.select("a", "b"), shipped)
        if not links.isEmpty():
            joined = _merged(links, joined)
        if not last:
            part = lambda side: joined.select(F.col("node").alias(side), F.col("component").alias(f"{side}_in"))
            left = pairs.join(now.select("a", "b"), ["a", "b"], "left_anti").join(part("a"), "a", "left").join(part("b"), "b", "left")
            left = left.filter(F.coalesce("a_in", "a") != F.coalesce("b_in", "b"))
            pairs = materialize(left.select("a", "b", "met"), "second")
    return joined


def _merged(links: DataFrame, joined: DataFrame) -> DataFrame:
    known = joined.select(F.col("node").alias("a"), F.col("component").alias("b")).filter("a <> b")
    return materialize(components(links.unionByName(known)), "joined")


def _placed(at: DataFrame, joined: DataFrame) -> DataFrame:
    """Postings ``at`` (token, doc_id, n, pos) with the component of each text."""
    at = at.join(joined.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    return at.withColumn("component", F.coalesce("component", "doc_id"))


def _apart(at: DataFrame, joined: DataFrame) -> DataFrame:
    """Of postings ``at`` those of the lists whose members are not all in one component."""
    mixed = _placed(at, joined).groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo < hi")
    return materialize(at.join(mixed.select("token"), "token"), "apart")


def _to_hubs(at: DataFrame, weights: DataFrame, turn: int) -> DataFrame:
    """(a, b): for each posted text the hub it meets most often; pairs grow with postings, not with their squares.

    A text in the middle of a group of near copies shares more and longer lists than
    the copies around it. Later turns let chance decide as well, so other hubs get their turn.
    """
    chance = F.pmod(F.xxhash64("doc_id", F.lit(turn)), F.lit(1 << 20)) * (turn % 2)
    ranked = at.join(weights, "doc_id").withColumn("rank", F.struct(chance.alias("chance"), "weight", "doc_id"))
    hubs = ranked.groupBy("token").agg(F.max_by(F.struct("doc_id", "n", "pos", "component"), "rank").alias("hub"))
    met = at.join(hubs, "token").filter((F.col("hub.component") != F.col("component"))
                                        & _may_reach("hub.n", "hub.pos", "n", "pos"))
    best = (met.groupBy("doc_id", F.col("hub.doc_id").alias("hub")).agg(F.count("*").alias("met"))
            .groupBy("doc_id").agg(F.max_by("hub", F.struct("met", "hub")).alias("hub")))
    return best.select(F.col("hub").alias("a"), F.col("doc_id").alias("b"))


def _best(pairs: DataFrame) -> DataFrame:
    """For each member of ``pairs`` (a, b, met) its pair with most in common."""
    of = lambda me: pairs.groupBy(F.col(me).alias("me")).agg(F.max_by(F.struct("a", "b"), F.struct("met", "a", "b")).alias("p"))
    return of("a").unionByName(of("b")).select("p.a", "p.b").distinct()


_SURROGATE = 1 << 62         # ids from here on stand for null ids


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of each row of ``docs`` (doc_id, text)."""
    docs = docs.select(
        F.coalesce(F.col("doc_id").cast("long"),
                   F.lit(_SURROGATE) + F.xxhash64("text").bitwiseAND(F.lit(_SURROGATE - 1))).alias("doc_id"), "text")
    profile = materialize(docs.mapInArrow(_profile, "doc_id long, key binary, n long, token long, times long"), "profile")
    rows = profile.filter("key IS NOT NULL").select("doc_id", "key", "n")
    classes = materialize(rows.filter("n > 0").groupBy("key").agg(F.min("doc_id").alias("vid")), "classes")

    shipped = frequent(profile.filter("token IS NOT NULL").select("token", "times"))

    # one document of each class has postings
    others = rows.join(classes, "key").filter("doc_id <> vid").select("doc_id").distinct()
    others = materialize(others.join(classes.select(F.col("vid").alias("doc_id")), "doc_id", "left_anti"), "copies")
    maybe, single = split_by_ids(docs, "doc_id", others)
    single = single.unionByName(maybe.join(others, "doc_id", "left_anti"))
    postings = single.mapInArrow(_postings(shipped, _needed), "token long, salt int, doc_id long, n int, pos int")
    final = linked(postings, docs, shipped)
    out = rows.join(classes, "key", "left").join(final.withColumnRenamed("node", "vid"), "vid", "left")
    component = F.coalesce("component", "vid", "doc_id")
    real = lambda c: F.when(c < _SURROGATE, c)
    return out.select(real(F.col("doc_id")).alias("doc_id"), F.col("n").alias("n_shingles"), real(component).alias("component_id"))


def _may_reach(n: str, pos: str, m: str, at: str):
    """Length and position filter for two sets whose first common token is at these places."""
    n, pos, m, at = (F.col(c).cast("long") for c in (n, pos, m, at))
    bound = F.least(n - pos, m - at)
    return (100 * F.least(n, m) >= 75 * F.greatest(n, m)) & (175 * bound >= 75 * (n + m))


def deduplicate(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each component; rows that repeat an id stay or go together."""
    found = near_duplicates(docs)
    gone = materialize(found.filter("component_id <> doc_id").select("doc_id").distinct(), "gone")
    maybe, kept = split_by_ids(docs, "doc_id", gone)
    return kept.unionByName(maybe.join(gone, "doc_id", "left_anti").select(*docs.columns))


def op8_divide_skip_join(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"))


OP8_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, string_split_regex(trim(regexp_replace(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[ 	-
]+', ' ', 'g'), ' '), ' ') AS w FROM documents),
 s AS MATERIALIZED (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT doc_id, w,
        unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM w WHERE w <> [''])),
 n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
 e AS MATERIALIZED (SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y USING (g)
        WHERE x.doc_id <> y.doc_id GROUP BY 1, 2) JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b
      WHERE 100 * c >= 75 * (p.n + q.n - c)),
 r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(b) AS component_id
FROM documents JOIN r ON r.a = documents.doc_id LEFT JOIN n USING (doc_id) GROUP BY doc_id
"""
