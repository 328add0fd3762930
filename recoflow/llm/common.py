"""Helpers of several operators: distributed ranks, id filters, connected components."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recoflow.session import materialize

FILTER_BITS = 24   # ids are pre-filtered through 2^24 bits: 2^18 rows of 64 bits, 4 MB


def read(spark, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores added until no column of ``df`` has that name."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def rank_within(df: DataFrame, groups: list[str], order: list, name: str, label: str = "rank") -> DataFrame:
    """``df`` with a gapless 0-based long rank inside each group.

    Rows are dealt by ranges of (groups, order), so a group of any size spreads
    over tasks; a rank is the row's place in its range plus the group's rows in
    earlier ranges. Groups must be few (shards, lengths): one row per range and
    group is broadcast. Ties get any order, but each rank once. Null is a group.
    """
    keys = [F.col(g) for g in groups]
    df = materialize(df, f"{label}-in")
    at, part, low, before = (free_name(df, n) for n in ("_at", "_part", "_low", "_before"))
    dealt = (df.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
             .withColumn(at, F.monotonically_increasing_id()))
    dealt = materialize(dealt, label).withColumn(part, F.shiftright(at, 33))
    sizes = dealt.groupBy(part, *groups).agg(F.min(at).alias(low), F.count("*").alias("n"))
    earlier = F.sum("n").over(Window.partitionBy(*groups).orderBy(part)) - F.col("n")
    sizes = sizes.select(part, *[F.col(g).alias(f"g{i}") for i, g in enumerate(groups)], low, earlier.alias(before))
    on = [dealt[part] == sizes[part]]
    on += [dealt[g].eqNullSafe(sizes[f"g{i}"]) for i, g in enumerate(groups)]
    joined = dealt.join(F.broadcast(sizes), on)
    return joined.select(*[dealt[c] for c in df.columns], (F.col(at) - F.col(low) + F.col(before)).alias(name))


def _slot(col):
    return F.pmod(F.xxhash64(col), F.lit(1 << FILTER_BITS))


def split_by_ids(df: DataFrame, key: str, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows whose key may be among ``ids``, rows whose key surely is not).

    A fixed-size bit table of the ids is broadcast, so a join that only few rows
    can match moves only those rows. With very many ids all rows may match, and
    the join that follows is an ordinary one. Null keys are surely not.
    """
    slot, word, bits = (free_name(df, n) for n in ("_slot", "_word", "_bits"))
    bit = F.col(slot).bitwiseAND(F.lit(63)).cast("int")
    table = (ids.select(_slot(F.col(ids.columns[0])).alias(slot)).groupBy(F.shiftright(slot, 6).alias(word))
             .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit)).alias(bits)))
    marked = df.withColumn(slot, _slot(F.col(key))).withColumn(word, F.shiftright(slot, 6))
    marked = marked.join(F.broadcast(table), word, "left")
    hit = (F.call_function("shiftright", F.col(bits), bit).bitwiseAND(F.lit(1)) == 1) & F.col(key).isNotNull()
    hit = F.coalesce(hit, F.lit(False))
    return marked.filter(hit).select(*df.columns), marked.filter(~hit).select(*df.columns)


def components(edges: DataFrame) -> DataFrame:
    """(node, component): each node of an edge, and the smallest node it can reach.

    Alternating large-star and small-star steps; a step is an aggregation and a
    join, never a gathered neighbourhood. Every round is written to shared
    storage, so a lost executor costs a round at most.
    """
    a, b = edges.columns[:2]
    now = materialize(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                      .filter("u <> v").distinct(), "edges")
    seen = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .filter("u <> v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).filter("u <> v").distinct())
        now = materialize(small, "stars")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if state == seen:
            break
        seen = state
    own = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(own)
