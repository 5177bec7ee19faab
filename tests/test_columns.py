from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from fareloom.functions import day_name, elapsed, key_bucket, speed, total
from fareloom.operators import assign_split, train_test
from fareloom.plans.prepare import prepare_trips, with_time_parts


def test_day_names_of_one_week(spark):
    rows = [(datetime(2024, 1, day, 12),) for day in range(1, 8)]
    week = with_time_parts(spark.createDataFrame(rows, "t TIMESTAMP_NTZ"), "t")
    named = week.select(
        F.date_format("t", "EEEE").alias("calendar"), day_name("day_of_week").alias("name")
    ).collect()
    assert [row.name for row in named] == [row.calendar for row in named]
    assert named[0].name == "Monday"


@pytest.mark.parametrize(
    "number, name, legacy",
    [
        (1, "Sunday", "Monday"),
        (2, "Monday", "Tuesday"),
        (7, "Saturday", "Sunday"),
        (0, "Unknown", "Unknown"),
        (8, "Unknown", "Unknown"),
        (None, "Unknown", "Unknown"),
    ],
)
def test_day_number_labels(spark, number, name, legacy):
    df = spark.createDataFrame([(number,)], "d INT")
    row = df.select(day_name("d"), day_name("d", legacy_labels=True)).head()
    assert tuple(row) == (name, legacy)


def test_total_is_null_with_one_null_term(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, None)], "a DOUBLE, b DOUBLE")
    assert [row[0] for row in df.select(total(["a", "b"])).collect()] == [3.0, None]


def test_elapsed_and_speed(spark):
    df = spark.createDataFrame(
        [(datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 3), 6.0, 0.05), (None, None, 1.0, 0.0)],
        "a TIMESTAMP_NTZ, b TIMESTAMP_NTZ, d DOUBLE, h DOUBLE",
    )
    rows = df.select(elapsed("a", "b").alias("s"), speed("d", "h").alias("v")).collect()
    assert (rows[0].s, rows[0].v) == (180, 120.0)
    assert (rows[1].s, rows[1].v) == (None, None)


def test_prepare_drops_invalid_rows_and_ignores_absent_names(spark):
    t = datetime(2024, 1, 1, 5)
    later = datetime(2024, 1, 1, 6)
    df = spark.createDataFrame(
        [
            (1, t, later, 1.0),
            (2, t, t, 1.0),
            (3, later, t, 1.0),
            (4, t, None, 1.0),
            (5, None, t, 1.0),
        ],
        "id INT, s TIMESTAMP_NTZ, e TIMESTAMP_NTZ, fee DOUBLE",
    )
    out = prepare_trips(df, "s", "e", ["fee"], ["fee", "absent"])
    assert out.columns == ["id", "s", "e", "hour", "day_of_week", "extras"]
    (row,) = out.collect()
    assert (row.id, row.hour, row.day_of_week, row.extras) == (1, 5, 2, 1.0)


def test_bucket_does_not_depend_on_partitioning(spark):
    ids = spark.range(2000).select("id", (F.col("id") * 7).alias("other"))
    bucket = key_bucket({"id": 31, "other": 17}, 10)
    few = {row.id: row.b for row in ids.coalesce(1).select("id", bucket.alias("b")).collect()}
    many = {row.id: row.b for row in ids.repartition(7).select("id", bucket.alias("b")).collect()}
    assert few == many
    assert set(few.values()) <= set(range(10))


def test_negative_keys_get_a_valid_bucket(spark):
    df = spark.createDataFrame([(-1,), (-25,)], "id LONG")
    values = [row[0] for row in df.select(key_bucket({"id": 3}, 10, shift=10)).collect()]
    assert all(0 <= value < 10 for value in values)


def test_split_parts_cover_all_rows_once(spark):
    ids = spark.range(1000)
    train, test = train_test(ids, {"id": 1})
    assert train.count() == 800 and test.count() == 200
    assert train.intersect(test).count() == 0
    labelled = assign_split(ids, {"id": 1})
    assert labelled.filter("split = 'train'").count() == 800


def test_random_split_without_key(spark):
    train, test = train_test(spark.range(1000))
    assert train.count() + test.count() == 1000
    assert 700 < train.count() < 900
