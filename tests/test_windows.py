from __future__ import annotations

from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fareloom.operators import windowed_count, windowed_distinct
from fareloom.plans import news

START = datetime(2024, 1, 1, 10)
SCHEMA = (
    "timestamp TIMESTAMP, user_id STRING, article_id STRING, location STRING, session_id STRING"
)


def view(second, user="u", article="a", country="x", session="s"):
    when = None if second is None else START + timedelta(seconds=second)
    return (when, user, article, country, session)


def views(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_windows_are_half_open_and_aligned(spark):
    df = views(spark, [view(0), view(59), view(60), view(-1)])
    counted = windowed_count(df, "timestamp", "1 minute", ["user_id"])
    rows = counted.orderBy("window_start").collect()
    assert [(row.window_start, row["count"]) for row in rows] == [
        (START - timedelta(minutes=1), 1),
        (START, 2),
        (START + timedelta(minutes=1), 1),
    ]
    assert all(row.window_end - row.window_start == timedelta(minutes=1) for row in rows)


def test_rows_without_time_fall_out_and_null_keys_stay(spark):
    df = views(spark, [view(None), view(1, user=None), view(2, user=None)])
    (row,) = windowed_count(df, "timestamp", "1 minute", ["user_id"]).collect()
    assert (row.user_id, row["count"]) == (None, 2)


@pytest.mark.parametrize(
    "query, limit, field", [(news.bot_users, 20, "user"), (news.article_spikes, 250, "article")]
)
def test_exactly_the_threshold_is_left_out(spark, query, limit, field):
    at = [view(i % 60, **{field: "at"}) for i in range(limit)]
    above = [view(i % 60, **{field: "above"}) for i in range(limit + 1)]
    (row,) = query(views(spark, at + above)).collect()
    assert (row[2], row["count"]) == ("above", limit + 1)


def test_bots_by_distinct_articles(spark):
    same = [view(i % 60, user="one article") for i in range(40)]
    many = [view(i, user="many", article=f"a{i}") for i in range(21)]
    (row,) = news.bot_users_distinct_articles(views(spark, same + many)).collect()
    assert (row.suspicius_users, row.articles) == ("many", 21)


def test_null_sessions_are_not_counted(spark):
    df = views(spark, [view(1), view(2), view(3, session="t"), view(4, session=None)])
    assert news.active_sessions_exact(df).head().active_sessions == 2
    assert news.active_sessions(df).head().active_sessions == 2


def test_exact_sessions_with_one_hot_session(spark):
    """A third of all rows in one session, against brute force."""
    rows = [view(i % 900, session="hot", country="x") for i in range(1000)]
    rows += [view(i % 900, session=f"s{i % 77}", country=f"c{i % 5}") for i in range(2000)]
    expected = defaultdict(set)
    for when, _, _, country, session in rows:
        window = when - timedelta(minutes=when.minute % 5, seconds=when.second)
        expected[window, country].add(session)
    got = news.active_sessions_exact(views(spark, rows).repartition(6)).collect()
    assert {(r.window_start, r.location): r.active_sessions for r in got} == {
        key: len(members) for key, members in expected.items()
    }


def test_estimate_stays_within_its_error(spark):
    df = spark.range(20000).select(
        F.lit(START).cast("timestamp").alias("t"),
        F.lit("k").alias("k"),
        (F.col("id") % 7000).alias("v"),
    )
    exact = windowed_distinct(df, "t", "5 minutes", ["k"], "v", exact=True).head().distinct_count
    assert exact == 7000
    for rsd in (0.05, 0.01):
        estimated = windowed_distinct(df, "t", "5 minutes", ["k"], "v", rsd=rsd)
        assert abs(estimated.head().distinct_count - exact) <= 3 * rsd * exact


def test_estimates_of_many_groups_stay_within_their_error(spark):
    """Groups of 60 to 80 values, as in the news, and of up to 3,000; "" is a value, null none."""
    groups = spark.range(20000).select(
        F.col("id").alias("k"),
        F.when(F.col("id") % 200 == 0, 3000).otherwise(60 + F.col("id") % 21).alias("n"),
    )
    number = F.explode(F.sequence(F.lit(1), F.col("n")))
    df = groups.select("k", "n", number.alias("i")).select(
        F.lit(START).cast("timestamp").alias("t"),
        "k",
        F.when(F.col("i") < F.col("n") - 1, F.concat_ws("_", "k", "i"))
        .when(F.col("i") < F.col("n"), F.lit(""))
        .alias("v"),
    )
    exact = windowed_distinct(df, "t", "5 minutes", ["k"], "v", exact=True, name="known")
    both = exact.join(windowed_distinct(df, "t", "5 minutes", ["k"], "v"), ["k"])
    off = F.abs(F.col("distinct_count") - F.col("known"))
    assert both.filter(off > 3 * 0.05 * F.col("known") + 1).count() == 0
    assert both.filter((F.col("known") < 100) & (off > 0)).count() < 20


@settings(max_examples=8, deadline=None)
@given(
    st.lists(st.tuples(st.integers(0, 3000), st.sampled_from("abc")), min_size=1, max_size=80),
    st.sampled_from([1, 5, 10, 15]),
)
def test_counts_equal_brute_force(spark, rows, minutes):
    expected = defaultdict(int)
    for second, user in rows:
        expected[START + timedelta(minutes=second // 60 // minutes * minutes), user] += 1
    df = views(spark, [view(second, user=user) for second, user in rows])
    got = windowed_count(df, "timestamp", f"{minutes} minutes", ["user_id"]).collect()
    assert {(r.window_start, r.user_id): r["count"] for r in got} == expected


def test_top_countries_per_window(spark):
    rows = [
        view(w * 900, country=f"c{c:02}")
        for w in range(2)
        for c in range(12)
        for _ in range(c + 1)
    ]
    df = views(spark, rows).withColumn("category", F.lit("finance"))
    top = news.top_countries(news.finance_by_country(df)).collect()
    assert sorted(r.location for r in top) == sorted([f"c{c:02}" for c in range(2, 12)] * 2)


def test_sketches_of_panes_unite_without_the_events(spark):
    """Sliding and wide windows, a hot value, nulls; equal to one sketch of the whole."""
    from fareloom.operators.windows import pane_sketches, united_distinct

    rows = [view(i % 3600, session=f"s{i % 900}" if i % 3 else "hot", country=f"c{i % 2}") for i in range(6000)]
    rows += [view(5, session=None)]
    df = views(spark, rows)
    panes = pane_sketches(df, "timestamp", "1 minute", ["location"], "session_id")
    for width, slide in (("15 minutes", "5 minutes"), ("1 hour", None)):
        united = united_distinct(panes, width, ["location"], slide).collect()
        exact = df.groupBy(F.window("timestamp", width, slide), "location").agg(
            F.count_distinct("session_id").alias("n"), F.approx_count_distinct("session_id").alias("a")
        )
        known = {(r.window.start, r.location): r.n for r in exact.collect()}
        assert {(r.window_start, r.location) for r in united} == set(known)
        for r in united:
            n = known[r.window_start, r.location]
            assert abs(r.distinct_count - n) <= 3 * 1.04 / 64 * n + 1


def test_sessions_by_gaps(spark):
    from fareloom.operators.windows import session_windows

    seconds = [0, 10, 20, 31, 100, 100, 110]  # a gap of exactly 10 does not part
    df = views(spark, [view(s) for s in seconds] + [view(5, user="other"), view(None)])
    got = session_windows(df.repartition(5), "timestamp", "10 seconds", ["user_id"]).collect()
    spans = sorted(
        (r.user_id, (r.window_start - START).seconds, (r.window_end - START).seconds, r["count"]) for r in got
    )
    assert spans == [("other", 5, 15, 1), ("u", 0, 30, 3), ("u", 31, 41, 1), ("u", 100, 120, 3)]


def test_panes_equal_the_queries_they_replace(spark):
    rows = [view(i * 7 % 1200, user=f"u{i % 5}", article="hot" if i % 3 else f"a{i % 7}", country=None if i % 9 == 0 else "x") for i in range(3000)]
    df = views(spark, rows).withColumns(
        {"category": F.when(F.col("user_id") != "u1", "finance"), "device_type": F.lit("d")}
    )
    panes = news.minute_panes(df).cache()
    pairs = [
        (news.finance_by_country(df), news.from_panes(panes, "finance", "15 minutes", "location")),
        (news.device_usage(df), news.from_panes(panes, "device", "1 minute", "device_type")),
        (news.article_spikes(df), news.from_panes(panes, "article", "10 minutes", "x", min_count=250)),
        (news.bot_users(df), news.from_panes(panes, "user", "1 minute", "x", min_count=20)),
    ]
    for wanted, got in pairs:
        rows = sorted(map(tuple, wanted.collect()), key=repr)
        assert rows and rows == sorted(map(tuple, got.collect()), key=repr)
