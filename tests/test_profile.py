from __future__ import annotations

import numpy as np
import pytest

from fareloom.operators import correlation_matrix, describe_columns, null_counts, numeric_columns

ROWS = [
    (1, 2.0, 10, "b", None),
    (2, 4.5, 10, "a", None),
    (4, None, 10, None, None),
    (7, 1.0, 10, "c", None),
]
SCHEMA = "i INT, d DOUBLE, l LONG, s STRING, b BOOLEAN"


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def test_numeric_columns_by_type(df):
    assert numeric_columns(df) == ["i", "d", "l"]


def test_null_counts(df):
    assert {r.column_name: r.null_count for r in null_counts(df).collect()} == {
        "i": 0, "d": 1, "l": 0, "s": 1, "b": 4,
    }


def test_describe(df):
    rows = {r.column_name: r for r in describe_columns(df).collect()}
    assert set(rows) == {"i", "d", "l", "s"}
    values = [2.0, 4.5, 1.0]
    assert rows["d"].row_count == 3
    assert rows["d"].mean == pytest.approx(np.mean(values))
    assert rows["d"].stddev == pytest.approx(np.std(values, ddof=1))
    assert (rows["i"].min_value, rows["i"].max_value) == (1.0, 7.0)
    assert (rows["s"].row_count, rows["s"].min_text, rows["s"].max_text) == (3, "a", "c")
    assert rows["s"].mean is None and rows["i"].min_text is None


def test_describe_agrees_with_the_built_in(df):
    built_in = {r.summary: r for r in df.select("i", "d", "l").describe().collect()}
    for row in describe_columns(df.select("i", "d", "l")).collect():
        assert float(built_in["mean"][row.column_name]) == pytest.approx(row.mean)
        assert float(built_in["stddev"][row.column_name]) == pytest.approx(row.stddev)


def test_describe_of_an_empty_table(spark):
    rows = describe_columns(spark.createDataFrame([], "i INT, s STRING")).collect()
    assert [(r.row_count, r.mean, r.min_text) for r in rows] == [(0, None, None), (0, None, None)]


def test_correlation_equals_numpy_and_skips_null_rows(df):
    cells = {(r.col_a, r.col_b): r.r for r in correlation_matrix(df).collect()}
    assert len(cells) == 9
    assert cells["i", "d"] == pytest.approx(np.corrcoef([1, 2, 7], [2.0, 4.5, 1.0])[0, 1])
    assert cells["i", "d"] == cells["d", "i"]
    assert cells["i", "i"] == pytest.approx(1.0)
    assert cells["i", "l"] is None  # constant
