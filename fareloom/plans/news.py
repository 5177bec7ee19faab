"""Windowed queries on news views. Each works on a static table and on a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.operators.topk import by_measure, top_per_group
from fareloom.operators.windows import first_crossings, windowed_count, windowed_distinct
from fareloom.streaming.alerts import threshold_alerts

# Thresholds and window widths.
SPIKE_VIEWS = 250
SPIKE_WIDTH = "10 minutes"
BOT_VIEWS = 20
BOT_WIDTH = "1 minute"
FINANCE_WIDTH = "15 minutes"
DEVICE_WIDTH = "1 minute"
SESSION_WIDTH = "5 minutes"

# Result column names that readers of these results expect.
SPIKE_COLUMN = "articles_with_spike_in_views"
BOT_COLUMN = "suspicius_users"

WINDOW = ["window_start", "window_end"]


def ranked(counted: DataFrame, measure: str = "count") -> DataFrame:
    """Largest first, across all windows. On a stream: complete mode only."""
    ties = [name for name in counted.columns if name != measure]
    return counted.orderBy(*by_measure(measure, ties))


def finance_events(events: DataFrame) -> DataFrame:
    return events.filter(F.col("category") == "finance")


def finance_by_country(events: DataFrame) -> DataFrame:
    return windowed_count(finance_events(events), "timestamp", FINANCE_WIDTH, ["location"])


def top_countries(counted: DataFrame, k: int = 10) -> DataFrame:
    """First k countries of each window of ``finance_by_country``."""
    return top_per_group(counted, WINDOW, "count", ["location"], k)


def device_usage(events: DataFrame) -> DataFrame:
    return windowed_count(events, "timestamp", DEVICE_WIDTH, ["device_type"])


def active_sessions(events: DataFrame, rsd: float = 0.05) -> DataFrame:
    return windowed_distinct(
        events,
        "timestamp",
        SESSION_WIDTH,
        ["location"],
        "session_id",
        rsd=rsd,
        name="active_sessions",
    )


def session_activity(events: DataFrame) -> DataFrame:
    """Views per session: the first of two steps to an exact session count.

    The step is a plain count, so views of one hot session are combined in
    each task before the shuffle; ``dropDuplicates`` would send them all to
    one task.
    """
    keys = ["location", "session_id"]
    return windowed_count(events, "timestamp", SESSION_WIDTH, keys, name="views")


def count_sessions(activity: DataFrame) -> DataFrame:
    """The second step: sessions per window and country."""
    return activity.groupBy(*WINDOW, "location").agg(
        F.count("session_id").alias("active_sessions")
    )


def closed_sessions(events: DataFrame) -> DataFrame:
    """Exact sessions of closed windows, for a stream with a watermark.

    Both steps are windowed, so each drops a window's state once it is closed.
    """
    width = F.window("timestamp", SESSION_WIDTH)
    views = events.groupBy(width, "location", "session_id").agg(F.count("*").alias("views"))
    again = F.window(F.window_time("window"), SESSION_WIDTH).alias("closed")
    counted = views.groupBy(again, "location").agg(F.count("session_id").alias("active_sessions"))
    return counted.select(
        F.col("closed.start").alias("window_start"),
        F.col("closed.end").alias("window_end"),
        "location",
        "active_sessions",
    )


def active_sessions_exact(events: DataFrame) -> DataFrame:
    return count_sessions(session_activity(events))


def article_spikes(events: DataFrame) -> DataFrame:
    counted = windowed_count(events, "timestamp", SPIKE_WIDTH, ["article_id"], SPIKE_VIEWS)
    return counted.withColumnRenamed("article_id", SPIKE_COLUMN)


def bot_users(events: DataFrame) -> DataFrame:
    counted = windowed_count(events, "timestamp", BOT_WIDTH, ["user_id"], BOT_VIEWS)
    return counted.withColumnRenamed("user_id", BOT_COLUMN)


def bot_users_distinct_articles(events: DataFrame) -> DataFrame:
    """Users with more than ``BOT_VIEWS`` different articles; static tables only."""
    counted = windowed_distinct(
        events,
        "timestamp",
        BOT_WIDTH,
        ["user_id"],
        "article_id",
        exact=True,
        min_count=BOT_VIEWS,
        name="articles",
    )
    return counted.withColumnRenamed("user_id", BOT_COLUMN)


def alerts(events: DataFrame, width: str, key: str, min_count: int, name: str) -> DataFrame:
    """When a window's group passed ``min_count``, once; a table or an ordered stream."""
    found = threshold_alerts if events.isStreaming else first_crossings
    return found(events, "timestamp", width, key, min_count).withColumnRenamed(key, name)


def spike_alerts(events: DataFrame) -> DataFrame:
    return alerts(events, SPIKE_WIDTH, "article_id", SPIKE_VIEWS, SPIKE_COLUMN)


def bot_alerts(events: DataFrame) -> DataFrame:
    return alerts(events, BOT_WIDTH, "user_id", BOT_VIEWS, BOT_COLUMN)


# Panes: one count per minute for all of these queries, kept by one stream.

PANE = "1 minute"


def facets(events: DataFrame) -> DataFrame:
    """(timestamp, facet, name): a row for each thing that a view counts for."""
    every = {
        "finance": F.when(F.col("category") == "finance", F.struct(F.col("location").alias("name"))),
        "device": F.struct(F.col("device_type").alias("name")),
        "article": F.struct(F.col("article_id").alias("name")),
        "user": F.struct(F.col("user_id").alias("name")),
    }
    rows = F.array(*(F.struct(F.lit(f).alias("facet"), n.alias("held")) for f, n in every.items()))
    counted = events.select("timestamp", F.inline(rows)).filter("held IS NOT NULL")
    return counted.select("timestamp", "facet", F.col("held.name").alias("name"))


def minute_panes(events: DataFrame) -> DataFrame:
    """Views per minute, facet and name, for a static table or a stream."""
    return windowed_count(facets(events), "timestamp", PANE, ["facet", "name"])


def from_panes(
    panes: DataFrame,
    facet: str,
    width: str,
    name: str,
    slide: str | None = None,
    min_count: int | None = None,
) -> DataFrame:
    """Views per window of whole panes; with ``min_count`` only groups strictly above it."""
    own = panes.filter(F.col("facet") == facet).withColumnRenamed("name", name)
    summed = own.groupBy(F.window("window_start", width, slide).alias("w"), name).agg(
        F.sum("count").alias("count")
    )
    counted = summed.select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), name, "count"
    )
    return counted if min_count is None else counted.filter(F.col("count") > min_count)
