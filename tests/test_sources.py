from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.errors import AnalysisException

from fareloom.plans.prepare import ZONE_SCHEMA
from fareloom.session import scratch_path
from fareloom.sources import load_table, parse_events, read_events, save_table

ZONES = [(1, "Queens", "Astoria"), (2, "Bronx", "A, \"quoted\" zone")]


def zones(spark):
    return spark.createDataFrame(ZONES, ZONE_SCHEMA)


def test_csv_round_trip_with_given_and_inferred_types(spark, tmp_path):
    path = str(tmp_path / "zones")
    save_table(zones(spark), path, "csv")
    for schema in (ZONE_SCHEMA, None):
        df = load_table(spark, path, "csv", schema, escape='"')
        assert [kind for _, kind in df.dtypes] == ["int", "string", "string"]
    save_table(zones(spark).limit(1), path, "csv")
    assert [tuple(r) for r in load_table(spark, path, "csv").collect()] == ZONES[:1]


def test_csv_keeps_line_breaks_quotes_empty_texts_and_nulls(spark, tmp_path):
    rows = [(1, "two\nlines", 'a "quoted", part'), (2, "", None), (3, " spaces ", "\\back\\"), (4, None, "")]
    path = str(tmp_path / "texts")
    save_table(spark.createDataFrame(rows, ZONE_SCHEMA), path, "csv")
    for schema in (ZONE_SCHEMA, None):
        assert sorted(map(tuple, load_table(spark, path, "csv", schema).collect())) == rows


def test_any_other_format_means_parquet(spark, tmp_path):
    path = str(tmp_path / "zones")
    save_table(zones(spark), path)
    for fmt in ("parquet", "anything"):
        assert load_table(spark, path, fmt).count() == 2


def test_save_replaces(spark, tmp_path):
    path = str(tmp_path / "t")
    save_table(spark.range(10), path)
    save_table(spark.range(3), path)
    assert load_table(spark, path).count() == 3


def test_bad_payloads_become_nulls(spark):
    payloads = [
        '{"user_id": "u", "timestamp": "2024-01-01T10:00:00Z", "category": "finance", "extra": 1}',
        '{"user_id": "u", "timestamp": "not a time"}',
        "nope",
        None,
        "{}",
    ]
    df = spark.createDataFrame([(p,) for p in payloads], "value STRING")
    rows = parse_events(df).collect()
    assert len(rows) == 5
    assert (rows[0].user_id, rows[0].category, rows[0].location) == ("u", "finance", None)
    assert rows[0].timestamp == datetime(2024, 1, 1, 10)
    assert (rows[1].user_id, rows[1].timestamp) == ("u", None)
    assert all(value is None for row in rows[2:] for value in row)


def test_payload_may_be_bytes(spark):
    df = spark.createDataFrame([(bytearray(b'{"location": "India"}'),)], "value BINARY")
    assert parse_events(df).head().location == "India"


def test_sources_ask_for_what_they_need(spark):
    with pytest.raises(ValueError, match="servers and topic"):
        read_events(spark, "kafka")
    with pytest.raises(ValueError, match="path"):
        read_events(spark, "text")
    with pytest.raises(ValueError, match="unknown"):
        read_events(spark, "socket")


def test_kafka_needs_only_the_connector(spark):
    """Without the package on the class path Spark itself says what is missing."""
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        read_events(spark, "kafka", servers="broker:9092", topic="news_events")


def test_scratch_paths_are_new_and_shared(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    one, two = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert one != two and one.startswith(root) and two.startswith(root)
