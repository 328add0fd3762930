"""Online recall as Structured Streaming queries.

Each function starts a query and returns it; ``once=True`` processes what is
available and stops, otherwise batches run every minute.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from recoflow.operators.recall import exclude_history
from recoflow.session import materialize
from recoflow.sources import tables

TRIGGER = "60 seconds"


def _start(writer, checkpoint: str, once: bool) -> StreamingQuery:
    trigger = {"availableNow": True} if once else {"processingTime": TRIGGER}
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def hot_counts(clicks: DataFrame, watermark: str | None = None, window: str | None = None) -> DataFrame:
    """Streaming count per channel and article of everything but exposures and reads.

    Without ``window`` the counts grow for ever; with ``watermark`` and
    ``window`` old counts leave the state.
    """
    scored = clicks.where(~F.col("action").isin("exposure", "read"))
    if watermark:
        scored = scored.withWatermark("action_time", watermark)
    keys = [F.window("action_time", window)] if window else []
    return scored.groupBy(*keys, "channel_id",
                          F.col("article_ids").try_cast("long").alias("article_id")).agg(
        F.count(F.lit(1)).alias("score"))


def stream_hot(clicks: DataFrame, path: str, checkpoint: str, once: bool = False, buckets: int = 256,
               watermark: str | None = None, window: str | None = None) -> StreamingQuery:
    """Keep a keyed store of hot scores at ``path`` up to date.

    Changed counts of a batch replace the stored ones; a repeated batch writes
    the same totals again, so nothing is counted twice. With ``watermark`` and
    ``window`` scores are kept per window (``window_start``) and old ones leave
    the state; the store keeps them until ``drop_windows``.
    """
    keys = [*(["window_start"] if window else []), "channel_id", "article_id"]

    def save(batch: DataFrame, batch_id: int) -> None:
        if window:
            batch = batch.withColumn("window_start", F.col("window.start")).drop("window")
        _merge(batch.withColumn("batch", F.lit(batch_id)), path, keys, "batch", buckets)

    counts = hot_counts(clicks, watermark, window)
    return _start(counts.writeStream.outputMode("update").foreachBatch(save), checkpoint, once)


def drop_windows(spark: SparkSession, path: str, before) -> None:
    """Rewrite a windowed hot store without the windows that start before ``before``."""
    rows = materialize(tables.read_store(spark, path).where(F.col("window_start") >= before), "hot")
    tables.create_store(rows, path, ["window_start", "channel_id", "article_id"], "batch", tables.store_buckets(spark, path))


def stream_new(arrived: DataFrame, path: str, checkpoint: str, once: bool = False,
               buckets: int = 256) -> StreamingQuery:
    """Keep a keyed store of new articles; the last arrival wins."""
    def save(batch: DataFrame, batch_id: int) -> None:
        rows = batch.groupBy("channel_id", "article_id").agg(F.max("arrived").alias("arrived"))
        _merge(rows, path, ["channel_id", "article_id"], "arrived", buckets)

    return _start(arrived.writeStream.outputMode("append").foreachBatch(save), checkpoint, once)


def content_recalls(clicks: DataFrame, similar: DataFrame, k: int = 10) -> DataFrame:
    """(user, channel, article): similar articles of each acted-on one, each once."""
    near = similar.where(F.col("rank") <= k).select("article_id", "similar_id")
    return (
        clicks.where(F.col("action").isin("click", "collect", "share"))
        .select("user_id", "channel_id", F.col("article_ids").try_cast("long").alias("article_id"))
        .join(near, "article_id")
        .select("user_id", "channel_id", F.col("similar_id").alias("article_id")).distinct()
    )


def stream_content_recall(clicks: DataFrame, similar: Callable[[], DataFrame], path: str, checkpoint: str,
                          history: Callable[[], DataFrame] | None = None, once: bool = False,
                          k: int = 10) -> StreamingQuery:
    """Add content recalls to the recall table at ``path``, each user's article once.

    ``similar`` and ``history`` are called for every batch, so a batch sees the
    tables as they are then, also after another job has rewritten them. Rows
    have ``recall_type`` 'online' and lie in the partition of their batch, which
    a repeated batch overwrites; what earlier batches wrote and what ``history``
    holds is not recalled again.
    """
    def save(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        found = content_recalls(batch, similar(), k)
        if history is not None:
            found = exclude_history(found, history())
        if _exists(spark, path):
            found = exclude_history(found, spark.read.parquet(path).where(F.col("batch") < batch_id))
        rows = found.select("user_id", "channel_id", F.lit("online").alias("recall_type"), "article_id",
                            F.lit(batch_id).cast("long").alias("batch"))
        (materialize(rows, "recalls").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch").parquet(path))

    return _start(clicks.writeStream.outputMode("append").foreachBatch(save), checkpoint, once)


FOUND = "user_id long, channel_id int, article_id long, action_time timestamp, batch long"


def stream_found(clicks: DataFrame, similar: Callable[[], DataFrame], path: str, checkpoint: str,
                 history: Callable[[], DataFrame] | None = None, once: bool = False, k: int = 10) -> StreamingQuery:
    """First of two steps of recall with state: similar articles of each batch's clicks.

    (user_id, channel_id, article_id, action_time, batch) rows, each user's
    article once a batch, with its last action. Nothing written before is read, so
    a batch takes the same time however large the table is. ``similar`` and
    ``history`` are called for every batch; a repeated batch overwrites its partition.
    """
    def save(batch: DataFrame, batch_id: int) -> None:
        near = similar().where(F.col("rank") <= k).select("article_id", "similar_id")
        acted = batch.where(F.col("action").isin("click", "collect", "share")).select(
            "user_id", "channel_id", F.col("article_ids").try_cast("long").alias("article_id"), "action_time")
        found = acted.groupBy("user_id", "channel_id", "article_id").agg(F.max("action_time").alias("action_time"))
        found = (found.join(near, "article_id").groupBy("user_id", "channel_id", F.col("similar_id").alias("article_id"))
                 .agg(F.max("action_time").alias("action_time")))
        if history is not None:
            found = exclude_history(found, history())
        found = found.select("user_id", "channel_id", "article_id", "action_time", F.lit(batch_id).cast("long").alias("batch"))
        (materialize(found, "found").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch").parquet(path))

    return _start(clicks.writeStream.outputMode("append").foreachBatch(save), checkpoint, once)


def stream_first_recalls(spark: SparkSession, found: str, path: str, checkpoint: str, once: bool = False,
                         ttl: str | None = None) -> StreamingQuery:
    """Second step: each user's article once, by keys in the state store.

    The state holds a key per user, channel and article, spread over the shuffle
    partitions; with ``ttl`` a key leaves it when event time has moved on by that
    much, and may be recalled again. Rows lie in the partition of their batch.
    """
    # A repeated batch of the first step replaces its files by the same rows.
    rows = spark.readStream.schema(FOUND).option("ignoreMissingFiles", "true").parquet(found)
    keys = ["user_id", "channel_id", "article_id"]
    if ttl:
        rows = rows.withWatermark("action_time", ttl).dropDuplicatesWithinWatermark(keys)
    else:
        rows = rows.dropDuplicates(keys)

    def save(batch: DataFrame, batch_id: int) -> None:
        out = batch.select("user_id", "channel_id", F.lit("online").alias("recall_type"), "article_id",
                           F.lit(batch_id).cast("long").alias("batch"))
        (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path))

    return _start(rows.writeStream.outputMode("append").foreachBatch(save), checkpoint, once)


def _exists(spark, path: str) -> bool:
    fs, to_path = tables._filesystem(spark, path)
    return fs.exists(to_path(path)) and any(
        "=" in s.getPath().getName() for s in fs.listStatus(to_path(path)))


def _merge(rows: DataFrame, path: str, keys: list[str], order: str, buckets: int) -> None:
    if _exists(rows.sparkSession, path):
        tables.upsert(rows, path, keys, order)
    else:
        tables.create_store(rows, path, keys, order, buckets)
