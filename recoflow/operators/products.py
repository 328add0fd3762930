"""Exact top-k inner products of two tables of vectors, pruned by norms.

Items lie in blocks of falling norm, ``size`` of them in a row. Every query first
meets the block of the largest norms; its k-th score t divided by its norm is
its cutoff: an item of smaller norm cannot score t (Cauchy-Schwarz). Queries are
then put into chunks by cutoff, and a chunk meets only the blocks that reach it.

How many blocks a chunk needs is its rank among blocks and chunks together, so
nothing is compared pairwise to find out. Chunks and blocks are bounded rows;
work and shuffle go with the pairs of them that are left.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recoflow.operators.ranks import range_rank
from recoflow.session import materialize

SIZE = 8192         # vectors of a block: what is shuffled and sent on goes with vectors times blocks
PRODUCTS = 1 << 21  # scores computed at once
EXACT = 1 << 14     # scores summed exactly at once
SLACK = 1e-9        # relative; far above the rounding of a product of doubles


def _clean(df: DataFrame, key: str) -> DataFrame:
    """(id, vector, norm) of the vectors with finite components only."""
    values = F.col("vector").cast("array<double>")
    norm = F.sqrt(F.aggregate(values, F.lit(0.0), lambda s, x: s + x * x))
    rows = df.select(F.col(key).cast("long").alias("id"), values.alias("vector"), norm.alias("norm"))
    return rows.where(F.col("id").isNotNull() & (F.col("norm") < F.lit(float("inf"))))


def _packed(rows: DataFrame, by: str, size: int) -> DataFrame:
    """(no, ids, vectors, first, last): ``size`` rows in one, numbered by falling ``by``;
    ``first`` and ``last`` are its bounds there."""
    ranked = range_rank(rows, [F.desc(by), F.col("id")], "place")
    entry = F.struct("id", "vector")
    packed = ranked.groupBy(F.floor(F.col("place") / size).alias("no")).agg(
        F.collect_list(entry).alias("rows"), F.max(by).alias("first"), F.min(by).alias("last"))
    return materialize(packed.select(
        "no", F.transform("rows", lambda r: r["id"]).alias("ids"),
        F.flatten(F.transform("rows", lambda r: r["vector"])).alias("vectors"), "first", "last"), "packed")


def _best(asked: np.ndarray, items: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, item, score) of the n best items of each asked vector, best first, ties to the earlier item.

    The last digits of a matrix product depend on its shape. So it only tells who may be
    among the best, and their scores are computed one by one, alike in every block.
    """
    slack = 1e-12 * np.linalg.norm(asked, axis=1) * np.linalg.norm(items, axis=1).max(initial=0.0)
    found = []
    step = max(1, PRODUCTS // len(items))
    for low in range(0, len(asked), step):
        rough = asked[low:low + step] @ items.T
        enough = np.partition(rough, len(items) - n, axis=1)[:, len(items) - n] - slack[low:low + step]
        row, item = np.nonzero(rough >= enough[:, None])
        row += low
        scores = np.concatenate([(items[item[i:i + EXACT]] * asked[row[i:i + EXACT]]).sum(axis=1)
                                 for i in range(0, len(row), EXACT)])
        order = np.lexsort((item, -scores, row))
        row, item, scores = row[order], item[order], scores[order]
        keep = np.arange(len(row)) - np.searchsorted(row, row) < n
        found.append((row[keep], item[keep], scores[keep]))
    return tuple(np.concatenate(x) for x in zip(*found))


def _scorer(k: int):
    def best(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for q_ids, q_flat, ids, flat in zip(batch["q_ids"], batch["q_vectors"], batch["ids"], batch["vectors"]):
                ids, q_ids = np.asarray(ids), np.asarray(q_ids)
                by_id = np.argsort(ids, kind="stable")
                items = np.asarray(flat).reshape(len(ids), -1)[by_id]
                row, item, score = _best(np.asarray(q_flat).reshape(len(q_ids), -1), items, min(k, len(ids)))
                yield pd.DataFrame({"query_id": q_ids[row], "item_id": ids[by_id][item], "score": score})
    return best


def _score(pairs: DataFrame, k: int) -> DataFrame:
    return pairs.select("q_ids", "q_vectors", "ids", "vectors").mapInPandas(
        _scorer(k), "query_id long, item_id long, score double")


def _asking(chunks: DataFrame) -> DataFrame:
    return chunks.select(F.col("no").alias("q_no"), F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors"),
                         "last")


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "item_id")
    return found.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= k)


def reach(chunks: DataFrame, blocks: DataFrame) -> DataFrame:
    """(q_no, no): the blocks after the first that may matter to each chunk.

    Blocks and chunks are ranked together by falling norm and cutoff; a chunk's
    place less its own number is the count of blocks before it.
    """
    ends = blocks.select(F.col("first").alias("at"), F.lit(0).alias("asks"), F.col("no")).unionByName(
        chunks.select(F.col("last").alias("at"), F.lit(1).alias("asks"), F.col("no")))
    placed = range_rank(ends, [F.desc("at"), F.col("asks"), F.col("no")], "place").where("asks = 1")
    count = F.col("place") - F.col("no")
    return placed.where(count > 1).select(
        F.col("no").alias("q_no"), F.explode(F.sequence(F.lit(1).cast("long"), count - 1)).alias("no"))


def plan(queries: DataFrame, items: DataFrame, query_key: str, item_key: str, k: int,
         size: int = SIZE) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(first, chunks, blocks, pairs): scores against the first block, queries packed by
    cutoff, items packed by norm, and the pairs of them that are left to multiply."""
    size = max(size, 4 * k)     # the first block must hold more than k, or its k-th score says little
    asked = materialize(_clean(queries, query_key).dropDuplicates(["id"]), "queries")
    blocks = _packed(_clean(items, item_key), "norm", size)
    start = _asking(_packed(asked, "norm", size)).withColumn("no", F.lit(0).cast("long"))
    first = materialize(_top(_score(start.join(blocks, "no"), k), k), "first")
    kth = first.where(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("t"))
    # No k-th score, none above 0 or a zero vector: norms exclude nothing.
    cutoff = F.when((F.col("t") > 0) & (F.col("norm") > 0), F.col("t") / F.col("norm") * (1 - SLACK))
    bound = asked.join(kth, "id", "left").select("id", "vector", F.coalesce(cutoff, F.lit(0.0)).alias("cutoff"))
    chunks = _packed(bound, "cutoff", size)
    return first, chunks, blocks, reach(chunks, blocks)


def top_products(queries: DataFrame, items: DataFrame, query_key: str, item_key: str, k: int,
                 size: int = SIZE) -> DataFrame:
    """(``query_key``, ``item_key``, score, rank): the k items of highest inner product of
    each query, ties to the smaller item id; all items if there are fewer.

    Both tables have an integer key and ``vector``, of one length throughout.
    Vectors that are null or hold null or non-finite components take no part; of
    queries with equal keys one is answered, items count as often as they appear.
    Empty tables give no rows. Equal to multiplying everything.
    """
    first, chunks, blocks, pairs = plan(queries, items, query_key, item_key, k, size)
    # Each pair of blocks is a product of its own: fixed partitions, not merged by size.
    pairs, each = materialize(pairs, "pairs"), ["q_no", "no"]
    partitions = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    asked = pairs.join(_asking(chunks), "q_no").repartition(partitions, *each)
    held = pairs.join(blocks.select("no", "ids", "vectors"), "no").repartition(partitions, *each)
    rest = _score(asked.join(held, each), k)
    found = _top(first.drop("rank").unionByName(rest), k)
    return found.select(F.col("query_id").alias(query_key), F.col("item_id").alias(item_key), "score", "rank")
