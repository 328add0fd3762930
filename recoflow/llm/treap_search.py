"""Ranked search over compressed quadtrees of a term-document grid (K2-treaps).

Documents are cut into shards. A shard is a grid with a row per term, most
frequent first, and a column per document, documents with the same frequent
terms side by side. Its points are the impacts of terms in documents. The grid
is kept as a quadtree in bands of square cells: a node has four bits for its
children that hold points, and the largest impact inside, rounded up to 16 bits;
a leaf has the term's count, from which the impact is exact. Children are found
by counting bits, so no pointers are stored.

For an item, the cells of all its terms over one range of documents are a state;
the weighted sum of their maxima bounds every score in the range. States are
split best first, each term following its row into one of two cells, and
dropped when their bound is below the k-th best score found so far, in this
shard or in those the task searched before. Scores are integers and exact.

Scale: the index is written once, some MB for each shard, and read back for every
block of items; a block has a bounded number of bytes, so its terms and weights
are broadcast. A task returns at most k rows for each item of a block.

Defined results: null texts and texts without a term are no documents; rows with
equal ids are documents of their own, a null id comes after all others among
equal scores; items with equal ids are one item with the terms of all their
texts, a null id is an item; an item without terms, or none of whose terms occur,
gives no rows, as does an empty table. Other columns are not read. A single text
is held whole, with about ten times its size, by the task that indexes it.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recoflow.llm import words
from recoflow.llm.common import read
from recoflow.session import materialize, scratch_dir, settings

SHARD_BYTES = 8 << 20       # text of a shard
SHARD_DOCS = 4096           # documents of a shard
BLOCK_BYTES = 1 << 20       # text of the items searched together
STEP = 96                   # states split at once
LIKENESS = 16               # frequent terms that decide which documents lie side by side
ROUND = 16                  # maxima of cells are kept in units of this; impacts stay below 10^6
_POP = np.array([bin(i).count("1") for i in range(16)], np.uint8)


def impacts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What a term's count adds to a score of a document with length part m, before the term's weight."""
    return (1_000_000_000 * tf.astype(np.int64)) // (1000 * tf.astype(np.int64) + 8 * m)


def length_part(n: np.ndarray, docs: int, terms: int) -> np.ndarray:
    """m = 100 - 90 + (90 n N) div L; with Python integers where 64 bits would not do."""
    if len(n) and 90 * int(n.max()) * docs >= 1 << 63:
        return np.array([10 + 90 * int(x) * docs // terms for x in n], np.int64)
    return 10 + (90 * n.astype(np.int64) * docs) // max(terms, 1)


def weight(df: int, docs: int) -> int:
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * df + 1)))


# --- the tree ----------------------------------------------------------------

def _spread(x: np.ndarray) -> np.ndarray:
    """The low 24 bits of x at the even places."""
    x = x.astype(np.int64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F),
                        (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | x << shift) & mask
    return x


def build_tree(row: np.ndarray, column: np.ndarray, tf: np.ndarray, m: np.ndarray, height: int) -> bytes:
    """The quadtree of the points (row, column): levels from the band roots down, then the leaves' counts.

    Every band of 2^height rows must hold a point. A level is its nodes' child
    bits, two nodes to a byte, and their maxima.
    """
    low = (1 << height) - 1
    key = (row.astype(np.int64) >> height) << 2 * height | _spread(row & low) << 1 | _spread(column)
    order = np.argsort(key)
    key, tf = key[order], tf[order]
    top = impacts(tf, m[column[order]])
    levels = []
    for _ in range(height):
        parent = key >> 2
        head = np.flatnonzero(np.concatenate([[True], parent[1:] != parent[:-1]]))
        bits = np.bitwise_or.reduceat(np.uint8(1) << (key & 3).astype(np.uint8), head)
        key, top = parent[head], np.maximum.reduceat(top, head)
        even = np.append(bits, np.zeros(len(bits) % 2, np.uint8))
        levels.append((even[::2] | even[1::2] << 4).tobytes() + (-(-top // ROUND)).astype("<u2").tobytes())
    kind = next(t for t in ("<u1", "<u2", "<u4") if tf.max() <= np.iinfo(t).max)
    return bytes([int(kind[2])]) + b"".join(reversed(levels)) + tf.astype(kind).tobytes()


class Tree:
    """A decoded quadtree: all nodes of all levels in one numbering, an empty node last."""

    def __init__(self, blob: bytes, bands: int, height: int, columns_of_leaves_m: np.ndarray):
        at, many, bits, tops, firsts, size = 1, bands, [], [], [], 0
        for _ in range(height):
            packed = np.frombuffer(blob, np.uint8, (many + 1) // 2, at)
            both = np.empty(2 * len(packed), np.uint8)
            both[::2], both[1::2] = packed & 15, packed >> 4
            at += len(packed)
            tops.append(np.frombuffer(blob, "<u2", many, at).astype(np.int32) * ROUND)
            at += 2 * many
            bits.append(both[:many])
            below = _POP[bits[-1]].astype(np.int64)
            size += many
            firsts.append(size + np.cumsum(below) - below)
            many = int(below.sum())
        tf = np.frombuffer(blob, f"<u{blob[0]}", many, at)
        column = self._columns(bits, height)
        self.height, self.leaves = height, size
        self.bits = np.concatenate([*bits, np.zeros(many + 1, np.uint8)])
        self.empty = size + many
        numbers = np.int32 if self.empty < 1 << 31 else np.int64
        self.first = np.concatenate([*firsts, np.zeros(many + 1, np.int64)], dtype=numbers, casting="same_kind")
        self.top = np.concatenate([*tops, impacts(tf, columns_of_leaves_m[column]), [0]], dtype=np.int32, casting="same_kind")

    @staticmethod
    def _columns(bits: list[np.ndarray], height: int) -> np.ndarray:
        """The column of every leaf, by following the child bits downwards."""
        column = np.zeros(len(bits[0]) if bits else 1, np.int64)
        for level in bits:
            node = np.repeat(np.arange(len(level)), _POP[level])
            child = np.flatnonzero((level[:, None] >> np.arange(4, dtype=np.uint8)) & 1) & 3
            column = column[node] << 1 | child & 1
        return column

    def search(self, rows: np.ndarray, weights: np.ndarray, least: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(scores, columns) of documents that may be among the k best: all with a score
        above 0 that is neither below ``least`` nor below the k-th best here."""
        node = (rows >> self.height)[None, :]
        bound = (self.top[node] * weights).sum(1)
        level, column = np.zeros(1, np.int64), np.zeros(1, np.int64)
        scores, columns = np.zeros(0, np.int64), np.zeros(0, np.int64)
        least = max(least, 1)
        while len(bound):
            if len(bound) > STEP:
                cut = np.argpartition(-bound, STEP)
                now, later = cut[:STEP], cut[STEP:]
            else:
                now, later = np.arange(len(bound)), np.zeros(0, np.int64)
            down = self.height - 1 - level[now]
            quadrant = ((rows[None, :] >> down[:, None]) & 1) << 1
            nodes = np.concatenate([self._child(node[now], quadrant), self._child(node[now], quadrant | 1)])
            sums = (self.top[nodes] * weights).sum(1)
            at = np.concatenate([column[now] << 1, column[now] << 1 | 1])
            deep = np.concatenate([level[now], level[now]]) + 1
            done = (deep == self.height) & (sums >= least)
            if done.any():
                scores, columns = np.concatenate([scores, sums[done]]), np.concatenate([columns, at[done]])
                if len(scores) >= k:
                    least = max(least, int(np.partition(scores, len(scores) - k)[len(scores) - k]))
                    scores, columns = scores[scores >= least], columns[scores >= least]
            live, kept = (deep < self.height) & (sums >= least), later[bound[later] >= least]
            node = np.concatenate([node[kept], nodes[live]])
            bound, level, column = (np.concatenate([old[kept], new[live]]) for old, new in
                                    ((bound, sums), (level, deep), (column, at)))
        return scores, columns

    def _child(self, node: np.ndarray, quadrant: np.ndarray) -> np.ndarray:
        bits = self.bits[node].astype(np.int64)
        child = self.first[node] + _POP[bits & (1 << quadrant) - 1]
        return np.where(bits >> quadrant & 1, child, self.empty)


# --- Spark -------------------------------------------------------------------

def statistics(docs: DataFrame, text: str = "text") -> tuple[int, int]:
    """(documents with at least one term, terms with repeats)."""
    def run(batches):
        for batch in batches:
            data, at = words.buffers(batch.column(0))
            n = [np.diff(words.spans(data, at[low:high + 1], words.LETTERS)[2]) for low, high in words.slices(at, SHARD_BYTES)]
            n = np.concatenate(n) if n else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([int((n > 0).sum())]), pa.array([int(n.sum())])], names=["docs", "terms"])

    row = docs.select(text).mapInArrow(run, "docs long, terms long").agg(F.sum("docs"), F.sum("terms")).first()
    return int(row[0] or 0), int(row[1] or 0)


def _shard(data: np.ndarray, at: np.ndarray, docs: int, terms: int):
    """(documents in column order, their sizes, sorted terms, rows, dfs, tree) or None without terms."""
    begins, ends, first = words.spans(data, at, words.LETTERS)
    if not len(begins):
        return None
    size = np.diff(first)
    known, term = np.unique(words.hashes(data, begins, ends), return_inverse=True)
    key, tf = np.unique(term * len(size) + np.repeat(np.arange(len(size)), size), return_counts=True)
    term, doc = key // len(size), key % len(size)
    df = np.bincount(term)
    row_of = np.empty(len(known), np.int64)
    row_of[np.lexsort((known, -df))] = np.arange(len(known))
    row = row_of[term]
    like = np.zeros(len(size), np.int64)
    np.bitwise_or.at(like, doc[row < LIKENESS], 1 << LIKENESS - 1 - row[row < LIKENESS])
    order = np.lexsort((size, like))
    order = order[size[order] > 0]
    column_of = np.full(len(size), -1)
    column_of[order] = np.arange(len(order))
    height = max(1, (len(order) - 1).bit_length())
    m = length_part(size[order], docs, terms)
    return order, size[order], known, row_of, df, build_tree(row, column_of[doc], tf, m, height)


INDEX = ["sizes", "terms", "rows", "dfs", "tree"]
# A row group is a shard: writers and readers hold one of them, not all of a file. Sizes alone are looked at every
# 100 rows only, and the least and greatest values of a row group, whole shards, are kept until its file ends.
ROW_GROUPS = {"parquet.block.row.count.limit": "1", "parquet.column.statistics.enabled": "false",
              "parquet.enable.dictionary": "false"}


def build(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, int, int]:
    """The written index, a row per shard, with the numbers of documents and of terms it holds."""
    n_docs, n_terms = statistics(docs, text)

    def run(batches):
        for batch in batches:
            data, at = words.buffers(batch.column(1))
            for low, high in words.slices(at, SHARD_BYTES):
                for a in range(low, high, SHARD_DOCS):
                    b = min(high, a + SHARD_DOCS)
                    made = _shard(data, at[a:b + 1], n_docs, n_terms)
                    if made is None:
                        continue
                    order, size, known, row_of, df, tree = made
                    ids = batch.column(0).slice(a, b - a).take(pa.array(order))
                    blobs = [size.astype("<u4"), known.astype("<u8"), row_of.astype("<u4"), df.astype("<u4")]
                    yield pa.RecordBatch.from_arrays(
                        [pa.ListArray.from_arrays(pa.array([0, len(order)], pa.int32()), ids),
                         *[pa.array([x.tobytes()], pa.binary()) for x in blobs], pa.array([tree], pa.binary())], names=names)

    source = docs.select(F.col(doc_id), F.col(text))
    schema = T.StructType([T.StructField("ids", T.ArrayType(source.schema[0].dataType)),
                           *[T.StructField(n, T.BinaryType()) for n in INDEX]])
    names = schema.fieldNames()
    path = scratch_dir(docs.sparkSession, "treaps")
    source.mapInArrow(run, schema).write.options(**ROW_GROUPS).parquet(path)
    return docs.sparkSession.read.schema(schema).parquet(path), n_docs, n_terms


class Items:
    """The terms of a block of items: item i has the terms at[i]..at[i + 1] of ``term``, numbers into ``hashes``."""

    def __init__(self, rows: list[tuple[int, str]]):
        data, at = words.buffers(pa.array([t for _, t in rows], pa.string()))
        begins, ends, first = words.spans(data, at, words.LETTERS)
        self.hashes, term = np.unique(words.hashes(data, begins, ends), return_inverse=True)
        self.ids = sorted({i for i, _ in rows}, key=lambda i: (i is None, i))
        number = {i: n for n, i in enumerate(self.ids)}
        item = np.repeat(np.array([number[i] for i, _ in rows], np.int64), np.diff(first))
        key = np.unique(item * max(len(self.hashes), 1) + term) if len(term) else np.zeros(0, np.int64)
        self.term = key % max(len(self.hashes), 1)
        self.at = np.searchsorted(key // max(len(self.hashes), 1), np.arange(len(self.ids) + 1))


def item_blocks(items: DataFrame, item_id: str, text: str, block_bytes: int):
    """One ``Items`` after the other, of about ``block_bytes`` of text; an item's rows are in one block."""
    rows = items.select(F.col(item_id).alias("i"), F.col(text).alias("t")).filter("t is not null")
    total = rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n = max(1, -(-total // block_bytes))
    for k in range(n):
        got = [(r.i, r.t) for r in rows.filter(F.pmod(F.xxhash64("i"), F.lit(n)) == k).collect()]
        if got:
            yield Items(got)


def _frequencies(index: DataFrame, block: Items) -> np.ndarray:
    """In how many documents each term of the block occurs; reads the shards' dictionaries only."""
    shipped = index.sparkSession.sparkContext.broadcast(block.hashes)

    def run(batches):
        wanted = shipped.value
        total = np.zeros(len(wanted), np.int64)
        for batch in batches:
            for terms, dfs in zip(batch.column(0), batch.column(1)):
                known = np.frombuffer(terms.as_buffer(), "<u8")
                at = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
                total += np.where(known[at] == wanted, np.frombuffer(dfs.as_buffer(), "<u4")[at], 0)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["term", "df"])

    counts = index.select("terms", "dfs").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    out = np.zeros(len(block.hashes), np.int64)
    for r in counts.collect():        # at most a row per term of the block
        out[r.term] = r.df
    return out


def _best(ids: list, scores: np.ndarray, k: int) -> list[tuple]:
    """The k best (score, id): higher scores first, then smaller ids, null last."""
    return sorted(zip(scores.tolist(), ids), key=lambda x: (-x[0], x[1] is None, x[1]))[:k]


def _search_block(index: DataFrame, block: Items, n_docs: int, n_terms: int, k: int, item_type, doc_type) -> DataFrame:
    df = _frequencies(index, block)
    weights = np.array([weight(int(d), n_docs) if d else 0 for d in df], np.int64)
    shipped = index.sparkSession.sparkContext.broadcast((block, weights))

    def run(batches):
        block, weights = shipped.value
        best: list[list[tuple]] = [[] for _ in block.ids]
        for batch in batches:
            for ids, sizes, terms, rows, tree in zip(*[batch.column(c) for c in range(5)]):
                size = np.frombuffer(sizes.as_buffer(), "<u4")
                known, row_of = np.frombuffer(terms.as_buffer(), "<u8"), np.frombuffer(rows.as_buffer(), "<u4")
                at = np.minimum(np.searchsorted(known, block.hashes), len(known) - 1)
                row = np.where((known[at] == block.hashes) & (weights > 0), row_of[at].astype(np.int64), -1)
                height = max(1, (len(size) - 1).bit_length())
                grid = Tree(tree.as_py(), -(-len(known) >> height), height, length_part(size, n_docs, n_terms))
                for i in range(len(block.ids)):
                    mine = block.term[block.at[i]:block.at[i + 1]]
                    mine = mine[row[mine] >= 0]
                    if not len(mine):
                        continue
                    least = best[i][-1][0] if len(best[i]) >= k else 0
                    scores, columns = grid.search(row[mine], weights[mine], least, k)
                    if len(scores):
                        found = ids.values.take(pa.array(columns)).to_pylist()
                        old = [d for _, d in best[i]], np.array([s for s, _ in best[i]], np.int64)
                        best[i] = _best(old[0] + found, np.concatenate([old[1], scores]), k)
        flat = [(block.ids[i], d, s) for i, x in enumerate(best) for s, d in x]
        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in flat], t) for c, t in enumerate(types)],
                                         names=["item_id", "doc_id", "score"])

    schema = T.StructType([T.StructField("item_id", item_type), T.StructField("doc_id", doc_type), T.StructField("score", T.LongType())])
    from pyspark.sql.pandas.types import to_arrow_type
    types = [to_arrow_type(f.dataType) for f in schema.fields]
    return index.select("ids", "sizes", "terms", "rows", "tree").mapInArrow(run, schema)


def search(index: DataFrame, n_docs: int, n_terms: int, items: DataFrame, k: int = 10, item_id: str = "item_id",
           text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of every item, from a built index."""
    item_type, doc_type = items.schema[item_id].dataType, index.schema["ids"].dataType.elementType
    found = None
    # A batch that a task reads is a shard, not 64 MB of them.
    with settings(index.sparkSession, {"spark.sql.execution.arrow.maxRecordsPerBatch": "1"}):
        for block in item_blocks(items, item_id, text, block_bytes):
            part = materialize(_search_block(index, block, n_docs, n_terms, k, item_type, doc_type), "found")
            found = part if found is None else found.unionByName(part)
    if found is None:
        found = index.sparkSession.createDataFrame([], T.StructType([
            T.StructField("item_id", item_type), T.StructField("doc_id", doc_type), T.StructField("score", T.LongType())]))
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "item_id", "rank", "doc_id", "score")


def op13_treap_search(spark, sf_dir: str) -> DataFrame:
    index, n_docs, n_terms = build(read(spark, sf_dir, "documents"))
    return search(index, n_docs, n_terms, read(spark, sf_dir, "benchmark"))


OP13_SQL = r"""
WITH item AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
              FROM benchmark),
 doc AS (SELECT row_number() OVER () AS place, doc_id, regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
         FROM documents),
 sized AS (SELECT place, doc_id, w, len(w)::BIGINT AS n FROM doc WHERE len(w) > 0),
 total AS (SELECT count(*)::BIGINT AS nn, sum(n)::BIGINT AS ll FROM sized),
 tf AS (SELECT place, term, count(*)::BIGINT AS tf FROM (SELECT place, unnest(w) AS term FROM sized)
        WHERE term IN (SELECT term FROM item) GROUP BY ALL),
 w AS (SELECT term, floor(1000 * ln((2 * any_value(nn) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tf, total GROUP BY term),
 scored AS (SELECT item_id, place, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * nn) // ll))))::BIGINT AS score
            FROM item JOIN w USING (term) JOIN tf USING (term) JOIN (SELECT place, n FROM sized) USING (place), total GROUP BY ALL),
 ranked AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
            FROM scored JOIN (SELECT place, doc_id FROM sized) USING (place) WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""
