"""Served history as bitmaps: a row per user, channel and range of articles.

A bitmap holds the articles of 32,768 consecutive numbers and ends with the byte
of its last article, since most lines have few. Bitmaps merge by OR,
so a day's feeds are added without reading feeds again, and a candidate is
tested against a bit instead of being joined with the history's rows. Articles
with scattered ids should be numbered densely first (``recall.dense_index``);
any ids give right results, but far-apart ones lie in a bitmap each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIXED = 0       # the channel that counts for all channels
PLACE = ["user_id", "channel_id", "part"]


def _part(article: Column) -> Column:
    return F.bitmap_bucket_number(article.cast("long"))


def has_bit(bits: Column, article: Column) -> Column:
    """Whether the bitmap of the article's part holds it."""
    at = F.bitmap_bit_position(article.cast("long"))
    byte = F.conv(F.hex(F.substring(bits, (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("long")
    return (F.octet_length(bits) > F.floor(at / 8)) & (F.getbit(F.coalesce(byte, F.lit(0)), (at % 8).cast("int")) == 1)


def served_bitmaps(served: DataFrame) -> DataFrame:
    """(user_id, channel_id, part, bits): the articles of (user_id, channel_id, article_id) rows.

    Rows without user, channel or article are left out; repeated rows count
    once. Numbers are shuffled, not bitmaps, which are 4 KB while they grow: a hot
    line's repeats combine before, and its part has 32,768 numbers at most.
    """
    known = served.where(F.col("user_id").isNotNull() & F.col("channel_id").isNotNull() & F.col("article_id").isNotNull())
    at = known.select("user_id", "channel_id", _part(F.col("article_id")).alias("part"),
                      F.bitmap_bit_position(F.col("article_id").cast("long")).alias("at")).distinct()
    return at.repartition(*PLACE).groupBy(*PLACE).agg(
        F.bitmap_construct_agg("at").alias("bits"), F.max("at").alias("last")).select(
        *PLACE, F.substring("bits", F.lit(1), (F.floor(F.col("last") / 8) + 1).cast("int")).alias("bits"))


def merge_bitmaps(*stores: DataFrame) -> DataFrame:
    """One row per user, channel and part of several bitmap tables."""
    rows = stores[0].select(*PLACE, "bits")
    for other in stores[1:]:
        rows = rows.unionByName(other.select(*PLACE, "bits"))
    return rows.repartition(*PLACE).groupBy(*PLACE).agg(
        F.bitmap_or_agg("bits").alias("bits"), F.max(F.octet_length("bits")).alias("n")).select(
        *PLACE, F.substring("bits", F.lit(1), F.col("n")).alias("bits"))


def exclude_seen(candidates: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """Drop what the bitmaps hold for the user in the channel or in the mixed channel 0.

    One join on user and part: a candidate meets as many bitmaps as its user
    has channels. A hot user's candidates are split at run time. Candidates
    without user or article stay, as does everything of an empty history.
    """
    c, b = candidates.alias("c"), bitmaps.alias("b")
    article = F.col("c.article_id")
    same = ((F.col("c.user_id") == F.col("b.user_id")) & (_part(article) == F.col("b.part"))
            & ((F.col("b.channel_id") == F.col("c.channel_id")) | (F.col("b.channel_id") == MIXED))
            & has_bit(F.col("b.bits"), article))
    return c.join(b, same, "left_anti")
