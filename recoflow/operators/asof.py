"""As-of join: for each row the newest version that was valid at its time.

Rows and versions are merged in time order inside a key and a span of time;
the last version of each span is then carried over to later spans. Nothing
is joined pairwise, and a hot key is spread over its spans.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SPAN = "DAY"


def as_of(rows: DataFrame, versions: DataFrame, keys: Sequence[str], at: str, since: str,
          span: str = SPAN) -> DataFrame:
    """``rows`` with the other columns of the newest version whose ``since`` is not after ``at``.

    Every row stays, once; without a version its columns are null. Of versions
    with equal key and time the largest by their columns counts. Rows with a
    null key or time find nothing, such versions are never found. ``span``
    (a unit of ``date_trunc``) should cut a hot key's rows into pieces a task
    can sort. The two tables share no column names but the keys.
    """
    keys = list(keys)
    values = [c for c in versions.columns if c not in keys]
    clash = sorted(set(values) & set(rows.columns))
    if clash:
        raise ValueError(f"columns in both tables: {clash}")
    key = F.struct(*keys).alias("k")
    version = F.struct(since, *[c for c in values if c != since]).alias("v")
    # Windows hold the key, the time and one struct of each side, so no input name matters.
    known = F.lit(True)
    for c in [*keys, at]:
        known = known & F.col(c).isNotNull()
    asked = rows.select(key, F.col(at).alias("t"), F.struct(*rows.columns).alias("r"), known.alias("known"))
    given = versions.where(F.col(since).isNotNull()).dropna(subset=keys).select(key, F.col(since).alias("t"), version)
    merged = (given.withColumn("asks", F.lit(0)).withColumn("r", F.lit(None).cast(asked.schema["r"].dataType))
              .unionByName(asked.where("known").select("k", "t", "r", F.lit(1).alias("asks")), allowMissingColumns=True)
              .withColumn("s", F.date_trunc(span, "t").cast("timestamp_ntz")))
    upto = Window.partitionBy("k", "s").orderBy("t", "asks", "v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = Window.partitionBy("k").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    spans = (merged.groupBy("k", "s").agg(F.max("v").alias("newest"))
             .select("k", "s", F.last("newest", ignorenulls=True).over(earlier).alias("carried")))
    found = (merged.withColumn("here", F.last("v", ignorenulls=True).over(upto)).where("asks = 1")
             .join(spans, ["k", "s"]).select("r", F.coalesce("here", "carried").alias("v")))
    lost = asked.where("not known").select("r", F.lit(None).cast(found.schema["v"].dataType).alias("v"))
    return found.unionByName(lost).select("r.*", *[F.col("v")[c].alias(c) for c in values])


def user_versions(actions: DataFrame) -> DataFrame:
    """(user_id, valid_from, n_clicks, n_actions): a user's totals up to each active day, valid
    from the midnight after it.

    A day's counts combine before the shuffle; the running totals see a row per
    user and day.
    """
    days = actions.where(F.col("user_id").isNotNull() & F.col("action_time").isNotNull()).groupBy(
        "user_id", F.col("action_time").cast("date").alias("day")).agg(
        F.count_if(F.col("action") == "click").alias("c"), F.count(F.lit(1)).alias("a"))
    upto = Window.partitionBy("user_id").orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return days.select("user_id", F.date_add("day", 1).cast("timestamp_ntz").alias("valid_from"),
                       F.sum("c").over(upto).alias("n_clicks"), F.sum("a").over(upto).alias("n_actions"))


def timely_samples(actions: DataFrame, span: str = SPAN) -> DataFrame:
    """Each scanned action with its user's totals as they were known then, and ``clicked`` as label.

    A label never meets counts it is part of, as it does when today's features
    are joined to the log they come from.
    """
    labels = actions.withColumn("clicked", F.coalesce(F.col("action") == "click", F.lit(False)).cast("int"))
    return as_of(labels, user_versions(actions), ["user_id"], "action_time", "valid_from", span)
