"""Tumbling event-time windows, for static tables and streams alike."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def _per_window(
    df: DataFrame, ts: str, width: str, keys: Sequence[str], measure: Column, name: str
) -> DataFrame:
    """Windows are half-open, aligned to the epoch; rows without a time fall out."""
    grouped = df.groupBy(F.window(ts, width).alias("window"), *keys).agg(measure.alias(name))
    return grouped.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *keys,
        name,
    )


def windowed_count(
    df: DataFrame,
    ts: str,
    width: str,
    keys: Sequence[str],
    min_count: int | None = None,
    name: str = "count",
) -> DataFrame:
    """Rows per window and key; with ``min_count`` only groups strictly above it."""
    counted = _per_window(df, ts, width, keys, F.count(F.lit(1)), name)
    return counted if min_count is None else counted.filter(F.col(name) > min_count)


def _estimated(column: str, rsd: float) -> Column:
    # Hashes, as the sketch takes few types and passes over empty strings.
    lg_k = min(max(math.ceil(2 * math.log2(3 * 1.04 / rsd)), 4), 21)
    hashed = F.when(F.col(column).isNotNull(), F.xxhash64(column))
    return F.hll_sketch_estimate(F.hll_sketch_agg(hashed, lg_k))


def windowed_distinct(
    df: DataFrame,
    ts: str,
    width: str,
    keys: Sequence[str],
    column: str,
    exact: bool = False,
    rsd: float = 0.05,
    min_count: int | None = None,
    name: str = "distinct_count",
) -> DataFrame:
    """Distinct values of ``column`` per window and key.

    The estimate keeps a sketch of bounded size per group, of which ``rsd`` is three
    deviations: a table has many groups, and one of several hundred lies beyond three. A
    group of few values has a small sketch that is all but exact. ``exact`` is for static
    tables; Spark refuses it on a stream.
    """
    measure = F.count_distinct(column) if exact else _estimated(column, rsd)
    counted = _per_window(df, ts, width, keys, measure, name)
    return counted if min_count is None else counted.filter(F.col(name) > min_count)


def first_crossings(df: DataFrame, ts: str, width: str, key: str, min_count: int) -> DataFrame:
    """When each window and ``key`` got more than ``min_count`` rows; only groups that did.

    Columns: window_start, window_end, the key, crossed_at: the time of row number
    ``min_count + 1``. Rows of one moment are counted before they are set in order, so
    a hot key sorts no more rows than its window has moments. For static tables.
    """
    moments = _per_window(df, ts, width, [key, ts], F.count(F.lit(1)), "rows_then")
    group = Window.partitionBy("window_start", "window_end", key)
    so_far = F.sum("rows_then").over(group.orderBy(ts))
    passed = moments.withColumn("rows_so_far", so_far).filter(
        (F.col("rows_so_far") > min_count)
        & (F.col("rows_so_far") - F.col("rows_then") <= min_count)
    )
    return passed.select("window_start", "window_end", key, F.col(ts).alias("crossed_at"))


def pane_sketches(
    df: DataFrame, ts: str, pane: str, keys: Sequence[str], column: str, lg_k: int = 12
) -> DataFrame:
    """(pane_start, keys, sketch): a sketch of the distinct values of ``column`` per pane.

    Write them once: any window made of whole panes follows from them without the
    events. A sketch takes 2**``lg_k`` buckets; its relative deviation is about
    1.04 / 2**(``lg_k`` / 2).
    """
    grouped = df.groupBy(F.window(ts, pane).alias("pane"), *keys)
    sketched = grouped.agg(F.hll_sketch_agg(column, lg_k).alias("sketch"))
    return sketched.select(F.col("pane.start").alias("pane_start"), *keys, "sketch")


def united_distinct(
    panes: DataFrame,
    width: str,
    keys: Sequence[str],
    slide: str | None = None,
    name: str = "distinct_count",
) -> DataFrame:
    """Estimated distinct values per window of ``pane_sketches``; ``width`` and ``slide``
    are multiples of the pane. Sketches are united in each task before the shuffle."""
    grouped = panes.groupBy(F.window("pane_start", width, slide).alias("window"), *keys)
    united = grouped.agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias(name))
    return united.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *keys, name
    )


def session_windows(
    df: DataFrame, ts: str, gap: str, keys: Sequence[str], name: str = "count"
) -> DataFrame:
    """Rows per session of a key: rows no further than ``gap`` from the one before belong
    together. A session ends ``gap`` after its last row.

    On a stream with a watermark, sessions merge in state and leave it when they end.
    """
    grouped = df.groupBy(F.session_window(ts, gap).alias("window"), *keys)
    return grouped.agg(F.count(F.lit(1)).alias(name)).select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *keys, name
    )
