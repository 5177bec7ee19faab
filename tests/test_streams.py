"""Streams over several micro-batches, one file each."""

from __future__ import annotations

import json
import os
import time
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from fareloom.operators import windowed_count
from fareloom.plans import news
from fareloom.session import DISK_STATE
from fareloom.sources import EVENT_SCHEMA, read_events
from fareloom.streaming import run_append, run_complete, run_parts, show_forever
from fareloom.streaming.topic import write_topic

START = datetime(2024, 1, 1, 10)
FIELDS = EVENT_SCHEMA.fieldNames()


def event(second, **fields):
    base = dict(
        user_id="u",
        article_id="a",
        timestamp=(START + timedelta(seconds=second)).strftime("%Y-%m-%dT%H:%M:%SZ"),
        category="finance",
        location="India",
        device_type="mobile",
        session_id="s",
    )
    return {**base, **fields}


def add_file(folder, number, events):
    folder.mkdir(exist_ok=True)
    lines = "\n".join(e if isinstance(e, str) else json.dumps(e) for e in events)
    file = folder / f"part-{number:03}.txt"
    file.write_text(lines)
    # The source takes files by age; make the order certain.
    age = time.time() - 3600 + 10 * number
    os.utime(file, (age, age))


def stream_of(spark, folder):
    return read_events(spark, "text", path=str(folder), maxFilesPerTrigger="1")


def batches(spark, path):
    """Result of every micro-batch, as written."""
    by_batch = defaultdict(list)
    for row in spark.read.parquet(f"{path}/result").collect():
        by_batch[row.batch].append(row)
    return dict(by_batch)


@pytest.fixture()
def topic(tmp_path):
    """Four batches: three countries, windows that close, a hot session."""
    folder = tmp_path / "topic"
    countries = ["India", "Japan", "Spain"]
    for number in range(4):
        add_file(
            folder,
            number,
            [
                event(
                    number * 240 + i,
                    location="India" if i % 3 == 0 else countries[i % 3],
                    session_id="hot" if i % 3 == 0 else f"s{i % 11}",
                    device_type=["mobile", "desktop", "tablet"][i % 3],
                    user_id="bot" if i % 2 else f"u{i}",
                    article_id="hot" if i % 4 else "cold",
                    category="finance" if i % 5 else "sports",
                )
                for i in range(120)
            ],
        )
    return folder


def static_twin(spark, folder):
    return spark.read.schema(EVENT_SCHEMA).json(str(folder))


QUERIES = {
    "finance": (news.finance_by_country, None, "count"),
    "devices": (news.device_usage, None, "count"),
    "sessions": (news.active_sessions, None, "active_sessions"),
    "spikes": (news.article_spikes, None, None),
    "bots": (news.bot_users, None, None),
}


@pytest.mark.parametrize("name", list(QUERIES))
def test_stream_equals_its_batch_twin(spark, topic, tmp_path, name):
    query, post, rank = QUERIES[name]
    result = query(stream_of(spark, topic))
    result = news.ranked(result, rank) if rank else result
    got = run_complete(result, str(tmp_path / "run"), post).collect()
    expected = query(static_twin(spark, topic)).collect()
    assert len(got) > 0
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, expected), key=repr)


def test_steps_after_the_stream(spark, topic, tmp_path):
    """Top countries and exact sessions need a step that Spark allows on static data only."""
    static = static_twin(spark, topic)
    got = run_complete(
        news.session_activity(stream_of(spark, topic)), str(tmp_path / "a"), news.count_sessions
    )
    distinct = static.groupBy(F.window("timestamp", "5 minutes"), "location").agg(
        F.count_distinct("session_id").alias("n")
    )
    assert {(r.window_start, r.location): r.active_sessions for r in got.collect()} == {
        (r.window.start, r.location): r.n for r in distinct.collect()
    }
    got = run_complete(
        news.finance_by_country(stream_of(spark, topic)),
        str(tmp_path / "b"),
        lambda df: news.top_countries(df, 2),
    )
    expected = news.top_countries(news.finance_by_country(static), 2)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))


def test_counts_never_fall_and_closed_windows_stay(spark, topic, tmp_path):
    path = str(tmp_path / "run")
    run_complete(news.device_usage(stream_of(spark, topic)), path, keep=9)
    history = batches(spark, path)
    assert sorted(history) == [0, 1, 2, 3]
    run_complete(news.device_usage(stream_of(spark, topic)), f"{path}-short")
    assert sorted(batches(spark, f"{path}-short")) == [2, 3]
    seen = {}
    for number in sorted(history):
        now = {(r.window_start, r.device_type): r["count"] for r in history[number]}
        assert all(now[key] >= count for key, count in seen.items())
        seen = now
    assert len(history[0]) < len(history[3])
    for row in history[3]:
        assert row.window_end - row.window_start == timedelta(minutes=1)
        assert row.window_start.second == 0


def test_threshold_query_is_empty_until_a_group_passes(spark, tmp_path):
    folder, path = tmp_path / "topic", str(tmp_path / "run")
    add_file(folder, 0, [event(i, user_id="x") for i in range(20)])
    add_file(folder, 1, [event(i, user_id="y") for i in range(3)])
    add_file(folder, 2, [event(30, user_id="x")])
    result = run_complete(news.bot_users(stream_of(spark, folder)), path)
    assert [(r.suspicius_users, r["count"]) for r in result.collect()] == [("x", 21)]
    assert list(batches(spark, path)) == [2]


def test_restart_goes_on_from_the_checkpoint(spark, tmp_path):
    folder, path = tmp_path / "topic", str(tmp_path / "run")
    add_file(folder, 0, [event(i) for i in range(5)])

    def run():
        return run_complete(news.finance_by_country(stream_of(spark, folder)), path).collect()

    assert [r["count"] for r in run()] == [5]
    assert [(r.location, r["count"]) for r in run()] == [("India", 5)]  # nothing new
    add_file(folder, 1, [event(i) for i in range(3)])
    assert [r["count"] for r in run()] == [8]


def test_parts_of_micro_batches_add_up_and_are_written_once(spark, topic, tmp_path):
    """Complete mode wrote every pane again with each micro-batch."""
    path = str(tmp_path / "run")
    parts = run_parts(stream_of(spark, topic), path, news.minute_panes)
    assert len(batches(spark, path)) == len(list(topic.iterdir()))
    views = static_twin(spark, topic).filter("timestamp IS NOT NULL").count()
    assert parts.filter("facet = 'user'").agg(F.sum("count")).first()[0] == views
    got = news.from_panes(parts, "device", "1 minute", "device_type").collect()
    assert sorted(got) == sorted(news.device_usage(static_twin(spark, topic)).collect())

    add_file(topic, 90, [event(5000, device_type="tv"), event(5001, device_type="tv")])
    parts = run_parts(stream_of(spark, topic), path, news.minute_panes)
    again = news.from_panes(parts, "device", "1 minute", "device_type").collect()
    assert sorted(again) == sorted(news.device_usage(static_twin(spark, topic)).collect())
    assert len(again) == len(got) + 1


def test_bad_payloads_do_not_stop_the_stream(spark, tmp_path):
    folder = tmp_path / "topic"
    add_file(folder, 0, ["nope", event(1), '{"location": "India"}', event(2, location=None)])
    result = run_complete(news.device_usage(stream_of(spark, folder)), str(tmp_path / "run"))
    assert [(r.device_type, r["count"]) for r in result.collect()] == [("mobile", 2)]
    kept = run_append(stream_of(spark, folder), str(tmp_path / "all"))
    assert kept.count() == 4


def test_append_emits_closed_windows_once_and_drops_late_events(spark, tmp_path):
    folder = tmp_path / "topic"
    add_file(folder, 0, [event(0), event(10), event(130)])
    add_file(folder, 1, [event(400)])
    add_file(folder, 2, [event(20)])  # its window closed long ago
    stream = stream_of(spark, folder).withWatermark("timestamp", "1 minute")
    counted = windowed_count(stream, "timestamp", "1 minute", ["device_type"])
    rows = run_append(counted, str(tmp_path / "run")).orderBy("window_start").collect()
    assert [((r.window_start - START).seconds, r["count"]) for r in rows] == [(0, 2), (120, 1)]


def test_written_topic_reads_back_whole(spark, topic, tmp_path):
    events, path = static_twin(spark, topic), str(tmp_path / "copy")
    assert write_topic(events, path) >= 4
    back = run_append(
        read_events(spark, "text", path=path, maxFilesPerTrigger="2"), str(tmp_path / "run")
    )
    assert sorted(map(tuple, back.select(*FIELDS).collect())) == sorted(
        map(tuple, events.select(*FIELDS).collect())
    )


@pytest.mark.parametrize("query", [news.device_usage, news.closed_sessions])
def test_no_event_of_a_written_topic_is_late(spark, tmp_path, query):
    """Several partitions out of order in time, over hours: more than two files a slice."""
    n = 30_000
    second = (F.col("id") * 7919) % n
    fields = {name: F.lit("x") for name in FIELDS} | {
        "timestamp": F.timestamp_seconds(F.lit(1_704_067_200) + second),
        "device_type": F.concat(F.lit("d"), F.col("id") % 3),
        "location": F.concat(F.lit("l"), F.col("id") % 5),
        "session_id": F.concat(F.lit("s"), F.col("id") % 77),
    }
    events = spark.range(0, n, 1, 6).select(*(c.alias(name) for name, c in fields.items()))
    path = str(tmp_path / "topic")
    files = write_topic(events, path, max_records_per_file=1_500)
    assert files >= 20
    names = sorted(os.listdir(path), key=lambda f: os.stat(f"{path}/{f}").st_mtime_ns)
    spans = []
    for name in names:
        if name.startswith("part-"):
            with open(f"{path}/{name}") as f:
                times = [json.loads(line)["timestamp"] for line in f]
            spans.append((min(times), max(times)))
    assert len(spans) == files
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:], strict=False))

    stream = read_events(spark, "text", path=path, maxFilesPerTrigger="2")
    got = run_append(query(stream.withWatermark("timestamp", "10 minutes")), str(tmp_path / "run"))
    wanted = {news.closed_sessions: news.active_sessions_exact}.get(query, query)(events)
    last = got.agg(F.max("window_end")).first()[0]
    assert last > datetime(2024, 1, 1, 8)
    wanted = wanted.filter(F.col("window_end") <= F.lit(last))
    assert sorted(map(tuple, got.select(*wanted.columns).collect())) == sorted(
        map(tuple, wanted.collect())
    )


def test_console_stream_keeps_its_state_on_disk(spark, topic, tmp_path):
    before = {key: spark.conf.get(key, None) for key in DISK_STATE}
    ranked = news.ranked(news.device_usage(stream_of(spark, topic)))
    query = show_forever(ranked, str(tmp_path / "checkpoint"), partitions=3)
    try:
        query.processAllAvailable()
        progress = query.lastProgress
    finally:
        query.stop()
    assert "Console" in progress["sink"]["description"]
    assert progress["stateOperators"][0]["numShufflePartitions"] == 3
    assert any("rocksdb" in name for name in progress["stateOperators"][0]["customMetrics"])
    assert {key: spark.conf.get(key, None) for key in DISK_STATE} == before
