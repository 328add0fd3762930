"""Exact top-k inner products of integer vectors by MaxScore over posting lists.

A vector is an item whose terms are its dimensions. A shard keeps for every
dimension a posting list of the vectors that are not 0 there, with the largest
and the smallest value. For a query, a list's score bound is the larger of 0 and
the query's component times either of these. Lists are ordered by bound; those
whose bounds together stay below the k-th best score found so far are not
essential: a vector in no other list cannot be among the best. The essential
lists are traversed, the others are probed for the vectors met there, by largest
bound first, and only while a vector's score and the bounds left reach the k-th best.

Scale: vectors with the same strongest dimensions are dealt to the same shards,
by ranges, so bounds are tight and a frequent vector is spread. The index is
written once. Queries are taken in blocks of bounded size, which are broadcast; a
task keeps the k best of each query over all its shards and returns those.

Defined results: a vector that is null or holds a null, NaN or infinite component
takes no part, as query or candidate; an empty vector scores 0 with all; missing
components of a shorter vector are 0; a null id is no query, and as a candidate
comes after all others among equal scores; equal rows are one query but candidates
of their own; a row is no candidate for a query with its id. Scores outside 64 bits are
ranked exactly and returned as the nearest 64-bit number. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recoflow.llm.common import read
from recoflow.session import materialize, scratch_dir

SHARD = 4096                # vectors of a shard
BLOCK = 2048                # queries searched together
SAFE = float(1 << 62)       # sums that surely fit 64 bits stay below


class Shard:
    """Posting lists of up to ``SHARD`` vectors."""

    def __init__(self, n: int, starts: np.ndarray, vectors: np.ndarray, values: np.ndarray):
        self.n, self.starts, self.vectors, self.values = n, starts, vectors, values
        self.lists = [(vectors[a:b], values[a:b]) for a, b in zip(starts[:-1].tolist(), starts[1:].tolist())]
        self.high = np.array([v.max(initial=0) for _, v in self.lists], values.dtype)
        self.low = np.array([v.min(initial=0) for _, v in self.lists], values.dtype)
        self.large = np.maximum(np.abs(self.high.astype(float)), np.abs(self.low.astype(float)))

    def add(self, score: np.ndarray, vectors: np.ndarray, d: int, factor) -> None:
        """Add the products of list d to the scores of ``vectors`` (sorted; all of them if None)."""
        members, values = self.lists[d]
        if len(members) == self.n:
            score += factor * (values if vectors is None else values[vectors])
        elif vectors is None:
            score[members] += factor * values
        else:
            at = np.searchsorted(members, vectors)
            hit = np.flatnonzero(members[np.minimum(at, len(members) - 1)] == vectors) if len(members) else []
            score[hit] += factor * values[at[hit]]

    def search(self, query: np.ndarray, least) -> tuple[np.ndarray, np.ndarray]:
        """(vectors, scores) with every vector whose score is at least ``least`` (None: all)."""
        d = np.flatnonzero(query[:len(self.lists)])
        q = query[d]
        exact = np.int64 if float((np.abs(q.astype(float)) * self.large[d]).sum()) < SAFE else object
        q = np.array([int(x) for x in q], exact)
        values = self.high[d].astype(exact), self.low[d].astype(exact)
        bound = np.maximum(np.maximum(q * values[0], q * values[1]), 0) if len(d) else q
        order = np.argsort(bound, kind="stable")
        d, q, left = d[order].tolist(), q[order], np.cumsum(bound[order])
        # No list can be spared as long as a vector in none of them could do.
        spared = 0 if least is None or least <= 0 else int(np.searchsorted(left, least, "left"))
        score = np.zeros(self.n, exact)
        met = np.ones(self.n, bool) if least is None or least <= 0 else np.zeros(self.n, bool)
        for k in range(len(d) - 1, spared - 1, -1):
            self.add(score, None, d[k], q[k])
            met[self.lists[d[k]][0]] = True
        found = np.flatnonzero(met)
        score = score[found]
        for k in range(spared - 1, -1, -1):
            keep = score + left[k] >= least
            found, score = found[keep], score[keep]
            if not len(found):
                break
            self.add(score, found, d[k], q[k])
        keep = np.ones(len(found), bool) if least is None else score >= least
        return found[keep], score[keep]


def _integers(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """(places where rows begin, floor(256 x) of all components, in doubles)."""
    sizes = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    return np.concatenate([[0], np.cumsum(sizes)]), np.floor(256 * values)


def valid(vectors: DataFrame, vector: str) -> Column:
    """Whether a vector has finite components only; false for null."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite, F.lit(False))


def _strongest(vector: Column) -> list[Column]:
    """The two dimensions, with their signs, that are farthest from 0: neighbours often share them."""
    each = F.transform(vector, lambda x, i: F.struct((-F.abs(x)).alias("a"), F.when(x < 0, -i - 1).otherwise(i + 1).alias("i")))
    best = F.slice(F.array_sort(each), 1, 2)
    return [F.try_element_at(best, F.lit(1))["i"], F.try_element_at(best, F.lit(2))["i"]]


INDEX = ["starts", "vectors", "values"]


def build(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The written index: a row per shard with its ids and posting lists."""
    source = vectors.where(valid(vectors, vector)).select(F.col(vec_id).alias("id"), F.col(vector).cast("array<double>").alias("v"))
    first, second = _strongest(F.col("v"))
    near = source.select("id", "v", first.alias("a"), second.alias("b"))
    near = near.repartitionByRange("a", "b", "id").sortWithinPartitions("a", "b").select("id", "v")

    def run(batches):
        for batch in batches:
            for low in range(0, batch.num_rows, SHARD):
                part = batch.slice(low, SHARD)
                at, values = _integers(part.column(1))
                row = np.repeat(np.arange(part.num_rows), np.diff(at))
                dim = np.arange(len(values)) - at[row]
                order = np.lexsort((row, dim))[values[np.lexsort((row, dim))] != 0]
                dims = int(np.diff(at).max(initial=0))
                starts = np.searchsorted(dim[order], np.arange(dims + 1))
                kept = values[order]
                big = float(np.abs(kept).max(initial=0))
                kind = "<i2" if big < 1 << 15 else "<i4" if big < 1 << 31 else "<f8"
                blobs = [starts.astype("<i8"), row[order].astype("<u2"), kept.astype(kind)]
                yield pa.RecordBatch.from_arrays(
                    [pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), part.column(0)),
                     *[pa.array([x.tobytes()], pa.binary()) for x in blobs], pa.array([kind])], names=names)

    schema = T.StructType([T.StructField("ids", T.ArrayType(source.schema["id"].dataType)),
                           *[T.StructField(n, T.BinaryType()) for n in INDEX], T.StructField("kind", T.StringType())])
    names = schema.fieldNames()
    path = scratch_dir(vectors.sparkSession, "postings")
    # Small row groups: a reader holds one of them, not all shards of a file.
    near.mapInArrow(run, schema).write.option("parquet.block.size", 16 << 20).parquet(path)
    return vectors.sparkSession.read.schema(schema).parquet(path)


def _shards(batch: pa.RecordBatch):
    for ids, starts, members, values, kind in zip(*[batch.column(c) for c in range(5)]):
        value = np.frombuffer(values.as_buffer(), kind.as_py())
        if kind.as_py() == "<f8":
            value = np.array([int(x) for x in value], object)
        else:
            value = value.astype(np.int64)
        yield ids.values, Shard(len(ids.values), np.frombuffer(starts.as_buffer(), "<i8"),
                                np.frombuffer(members.as_buffer(), "<u2").astype(np.int64), value)


def _search_block(index: DataFrame, first: int, queries: list[tuple], k: int) -> DataFrame:
    """(query, query_id, vec_id, score as text): the k best of each query in each task."""
    shipped = index.sparkSession.sparkContext.broadcast([(i, np.floor(256 * np.array(v, float))) for i, v in queries])

    def run(batches):
        queries = shipped.value
        best: list[list[tuple]] = [[] for _ in queries]
        for batch in batches:
            for ids, shard in _shards(batch):
                for n, (query_id, query) in enumerate(queries):
                    least = best[n][-1][0] if len(best[n]) >= k else None
                    found, score = shard.search(query, least)
                    other = pc.fill_null(pc.not_equal(ids.take(pa.array(found)), query_id), True)
                    other = other.to_numpy(zero_copy_only=False)
                    found, score = found[other], score[other]
                    if len(found) > k:          # ties with the k-th stay: the smaller id decides
                        level = np.sort(score)[len(score) - k]
                        found, score = found[score >= level], score[score >= level]
                    new = zip(score.tolist(), ids.take(pa.array(found)).to_pylist())
                    best[n] = sorted([*best[n], *new], key=lambda x: (-x[0], x[1] is None, x[1]))[:k]
        flat = [(first + n, queries[n][0], i, s) for n, x in enumerate(best) for s, i in x]
        columns = [[r[c] for r in flat] for c in range(3)] + [[str(r[3]) for r in flat]]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    id_type = index.schema["ids"].dataType.elementType
    schema = T.StructType([T.StructField("query", T.LongType()), T.StructField("query_id", id_type),
                           T.StructField("vec_id", id_type), T.StructField("score", T.StringType())])
    from pyspark.sql.pandas.types import to_arrow_type
    types, names = [to_arrow_type(f.dataType) for f in schema.fields], schema.fieldNames()
    return index.mapInArrow(run, schema)


def search(index: DataFrame, queries: DataFrame, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding",
           block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of every query, from a built index."""
    wanted = materialize(queries.where(valid(queries, vector) & F.col(vec_id).isNotNull()).select(
        F.col(vec_id).alias("id"), F.col(vector).cast("array<double>").alias("v")).distinct(), "queries")
    n = max(1, -(-wanted.count() // block))
    found, first = None, 0
    for b in range(n):
        rows = [(r.id, r.v) for r in wanted.where(F.pmod(F.xxhash64("id", "v"), F.lit(n)) == b).collect()]
        part = materialize(_search_block(index, first, rows, k), "found")
        found, first = part if found is None else found.unionByName(part), first + len(rows)
    # Scores of any size are compared as sign and padded digits; doubles allow for 90 digits.
    number, digits = F.col("score"), F.length(F.regexp_replace("score", "-", ""))
    sign = F.when(number.startswith("-"), -1).otherwise(1)
    padded = F.lpad(F.regexp_replace("score", "-", ""), 100, "0")
    order = Window.partitionBy("query").orderBy(
        F.desc(sign), F.desc(F.when(sign > 0, padded)), F.asc(F.when(sign < 0, padded)), F.asc_nulls_last("vec_id"))
    ends = F.when(sign > 0, F.lit((1 << 63) - 1)).otherwise(F.lit(-(1 << 63)))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", F.coalesce(number.try_cast("long"), ends).alias("score"))


def op11_maxscore(spark, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    return search(build(vectors), vectors.where(F.col("vec_id") % 50 == 0))


OP11_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
 scored AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
            FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0),
 ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""
