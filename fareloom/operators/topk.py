"""Top-k reports.

Each sort ends with the group keys, so equal measures have one fixed order,
and each plan ends in ``TakeOrderedAndProject``: a task hands on at most k rows.
Grouped measures are combined before the shuffle, so a hot key costs one row
per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fareloom.functions import elapsed, speed
from fareloom.functions.columns import SECONDS_PER_HOUR


def by_measure(measure: str, ties: Sequence[str]) -> list[Column]:
    return [F.desc_nulls_last(measure), *map(F.asc_nulls_last, ties)]


def top_rows(df: DataFrame, measure: str, ties: Sequence[str], k: int = 20) -> DataFrame:
    return df.orderBy(*by_measure(measure, ties)).limit(k)


def _top_measure(df, keys, measure: Column, name: str, k: int, digits: int | None) -> DataFrame:
    if digits is not None:
        measure = F.round(measure, digits)
    return top_rows(df.groupBy(*keys).agg(measure.alias(name)), name, keys, k)


def top_sum(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    k: int = 20,
    digits: int | None = 2,
    name: str = "total",
) -> DataFrame:
    return _top_measure(df, keys, F.sum(value), name, k, digits)


def top_avg(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    k: int = 20,
    digits: int | None = None,
    name: str = "average",
) -> DataFrame:
    return _top_measure(df, keys, F.avg(value), name, k, digits)


def top_count(df: DataFrame, keys: Sequence[str], k: int = 20, name: str = "count") -> DataFrame:
    return _top_measure(df, keys, F.count(F.lit(1)), name, k, None)


def with_speed(
    df: DataFrame,
    start: str,
    end: str,
    distance: str,
    min_hours: float = 0.05,
    hours_name: str = "trip_duration_hours",
    speed_name: str = "avg_speed_mph",
) -> DataFrame:
    """Duration and speed of the rows that took more than ``min_hours`` and moved."""
    timed = df.withColumn(hours_name, elapsed(start, end) / SECONDS_PER_HOUR)
    moving = timed.filter((F.col(hours_name) > min_hours) & (F.col(distance) > 0))
    return moving.withColumn(speed_name, speed(distance, hours_name))


def fastest(
    df: DataFrame,
    start: str,
    end: str,
    distance: str,
    min_hours: float = 0.05,
    max_speed: float = 120,
    k: int = 20,
    keep: Sequence[str] = (),
    speed_name: str = "avg_speed_mph",
) -> DataFrame:
    """The k fastest rows below ``max_speed``, with the ``keep`` columns."""
    timed = with_speed(df, start, end, distance, min_hours, speed_name=speed_name)
    credible = timed.filter(F.col(speed_name) < max_speed).select(*keep, speed_name)
    return top_rows(credible, speed_name, keep, k)


def top_per_group(
    df: DataFrame, group: Sequence[str], measure: str, ties: Sequence[str], k: int
) -> DataFrame:
    """First k rows of each group by ``measure``.

    Spark prunes each task to k rows per group before the shuffle
    (``WindowGroupLimit``), so a large group does not end up in one task.
    """
    place = F.row_number().over(W.partitionBy(*group).orderBy(*by_measure(measure, ties)))
    return df.withColumn("_place", place).filter(F.col("_place") <= k).drop("_place")
