"""Scores of actions and simple user facts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from recoflow import schema as S


def elapsed_days(since: Column, now: Column) -> Column:
    """Whole elapsed days (24-hour units, not calendar days)."""
    return F.floor(F.timestamp_diff("SECOND", since, now) / F.lit(86400))


def time_decay(since: Column, now: Column) -> Column:
    """1 / (ln(days + 1) + 1): 1 today, falling slowly afterwards."""
    return F.lit(1.0) / (F.log(elapsed_days(since, now) + F.lit(1.0)) + F.lit(1.0))


def read_score(read_time: Column, threshold: float = 1000) -> Column:
    return (F.when(F.coalesce(read_time, F.lit(0.0)) > F.lit(float(threshold)), S.LONG_READ_SCORE)
            .otherwise(S.SHORT_READ_SCORE))


def action_score(shared: Column, clicked: Column, collected: Column, read_time: Column,
                 threshold: float = 1000) -> Column:
    return (shared.cast("int") * S.SHARE_SCORE + clicked.cast("int") * S.CLICK_SCORE
            + collected.cast("int") * S.COLLECT_SCORE + read_score(read_time, threshold))


def age_on(birthday: Column, today: Column) -> Column:
    """Completed years on ``today``; null for an unknown birthday."""
    month_day = lambda d: F.month(d) * 100 + F.dayofmonth(d)
    return F.year(today) - F.year(birthday) - (month_day(today) < month_day(birthday)).cast("int")
