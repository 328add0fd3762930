"""Keys: prefixed ids, compound keys, id tables, experiment buckets."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def id_after_prefix(key: Column) -> Column:
    """``'user:5'`` -> 5."""
    return F.split(key, ":")[1].cast("long")


def channel_topic(channel: Column, topic: Column) -> Column:
    return F.concat_ws(":", channel.cast("string"), topic)


def first_md5_digit(user_id: Column) -> Column:
    return F.substring(F.md5(user_id.cast("string").cast("binary")), 1, 1)


def remap(df: DataFrame, col: str, mapping: Mapping[int, int], default: int) -> DataFrame:
    """Replace the ids in ``col`` by a small literal table, else ``default``."""
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    return df.withColumn(col, F.coalesce(F.create_map(*pairs)[F.col(col)], F.lit(default)))
