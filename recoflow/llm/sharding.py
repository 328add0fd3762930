"""Shards by balanced label propagation.

Documents are linked through keys they share (equal texts, near-duplicate
groups, hosts, ...). Every round each key takes the shard most of its documents
are in, each document asks for the shard its keys favour, and a shard lets in
those with the largest gain while it has room; then counts are made equal again
by moving the documents that lose least. Rows with most to gain first and ties
by hash, so the result does not depend on partitions. A key moves as a histogram
of at most ``shards`` numbers, never as its documents; ranks are counted in
ranges of rows. State is (doc, shard), written to shared storage each round.

The law is ``rows``: shard sizes differ by one row at most.

Defined results: a null text has size 1, no checksum and no links; repeated rows
are rows of their own and are kept together like copies; an empty table gives
no rows; fewer rows than shards leave shards empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recoflow.llm.common import rank_within, read
from recoflow.session import materialize

SHARDS = 16
ROUNDS = 2


def propagate(rows: DataFrame, members: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """(row, shard) of each of ``rows`` (row: a unique long), linked by ``members`` (row, key)."""
    state = rows.select("row", F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int").alias("shard"))
    # a key of one document links nothing
    shared = members.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1")
    members = materialize(members.join(shared, "key"), "members")
    total = rows.count()
    for _ in range(rounds):
        state = materialize(_quotas(_move(state, members, shards, total), members, shards, total), "shards")
    return state


def _histograms(state: DataFrame, members: DataFrame) -> DataFrame:
    return (members.join(state, "row").groupBy("key", "shard").agg(F.count("*").alias("n"))
            .groupBy("key").agg(F.max_by("shard", F.struct("n", F.xxhash64("key", "shard"))).alias("best"),
                                F.max("n").alias("most"),
                                F.map_from_entries(F.collect_list(F.struct("shard", "n"))).alias("here")))


def _move(state: DataFrame, members: DataFrame, shards: int, total: int) -> DataFrame:
    """One round of requests; shards let in linked rows up to their quota."""
    votes = (members.select("row", "key").join(_histograms(state, members), "key")
             .groupBy("row", F.col("best").alias("want")).agg(F.sum("most").alias("votes"))
             .groupBy("row").agg(F.max_by("want", F.struct("votes", F.xxhash64("row", "want"))).alias("want"), F.max("votes").alias("votes")))
    asks = votes.join(state, "row").filter("want <> shard").select("row", "want", "votes")
    # rows without links give way later, so they take no room; rows that ask to leave neither
    stay = (state.join(members.select("row").distinct(), "row").join(asks.select("row"), "row", "left_anti")
            .groupBy("shard").agg(F.count("*").alias("n")))
    stay = {r.shard: r.n for r in stay.collect()}
    room = [max(0, total // shards - stay.get(s, 0)) for s in range(shards)]
    ranked = rank_within(asks, ["want"], [F.col("votes").desc(), F.xxhash64("row"), F.col("row")], "_rank", "asks")
    allowed = ranked.filter(F.col("_rank") < F.get(F.array(*[F.lit(r) for r in room]), F.col("want")))
    return state.join(allowed.select("row", "want"), "row", "left").select("row", F.coalesce("want", "shard").alias("shard"))


def _quotas(state: DataFrame, members: DataFrame, shards: int, total: int) -> DataFrame:
    """Row counts at most one apart: full shards give the rows that lose least to shards with room."""
    state = materialize(state, "moved")
    counts = {r.shard: r.n for r in state.groupBy("shard").agg(F.count("*").alias("n")).collect()}
    base, extra = divmod(total, shards)
    order = sorted(range(shards), key=lambda s: (-counts.get(s, 0), s))     # the largest keep one more
    quota = {s: base + (i < extra) for i, s in enumerate(order)}
    over = [max(0, counts.get(s, 0) - quota[s]) for s in range(shards)]
    if not any(over):
        return state
    loss = (members.select("row", "key").join(_histograms(state, members), "key").join(state, "row")
            .groupBy("row").agg(F.sum(F.coalesce(F.element_at("here", F.col("shard")), F.lit(0))).alias("loss"), F.min("key").alias("key")))
    rich = state.filter(F.get(F.array(*[F.lit(n) for n in over]), F.col("shard")) > 0)
    ranked = rank_within(rich.join(loss, "row", "left").select("row", "shard", F.coalesce("loss", F.lit(0)).alias("loss"), F.coalesce("key", F.lit(0)).alias("key")),
                         ["shard"], [F.col("loss"), F.xxhash64("key"), F.xxhash64("row"), F.col("row")], "_rank", "leavers")
    start = [sum(over[:s]) for s in range(shards)]
    targets = [(s, max(0, quota[s] - counts.get(s, 0))) for s in range(shards)]
    bounds, to, reached = [], F.lit(None).cast("int"), 0
    nth = F.col("_rank") + F.get(F.array(*[F.lit(n) for n in start]), F.col("shard"))
    for s, n in targets:
        reached += n
        bounds.append((reached, s))
    for reached, s in reversed(bounds):
        to = F.when(nth < reached, F.lit(s)).otherwise(to)
    moved = ranked.filter(F.col("_rank") < F.get(F.array(*[F.lit(n) for n in over]), F.col("shard"))).select("row", to.alias("to"))
    return state.join(moved, "row", "left").select("row", F.coalesce("to", "shard").alias("shard"))


def shard(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """Each row of ``docs`` (doc_id, text) with size, checksum, shard and its place there; equal texts are linked."""
    rows = materialize(docs.select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
        F.when(F.col("text").isNotNull(), F.xxhash64("text", F.octet_length("text"))).alias("key"),
        F.monotonically_increasing_id().alias("row")), "rows")
    placed = propagate(rows.select("row"), rows.filter("key IS NOT NULL").select("row", "key"), shards, rounds)
    out = rows.join(placed, "row").select("doc_id", "size", "text_crc32", "shard", "row")
    return rank_within(out, ["shard"], [F.col("doc_id"), F.col("row")], "slot", "slots")


def op1_label_propagation(spark, sf_dir: str) -> DataFrame:
    return shard(read(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
