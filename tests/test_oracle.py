"""Every registered query against its SQL, and the rest for shape."""

from __future__ import annotations

import math

import duckdb
import pytest

from __spark_entry__ import entry
from checks.oracle import ORACLE
from checks.queries import QUERIES, TUNED
from fareloom.plans import regression

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

ROWS_ONLY = {
    "sample_rows",
    "active_sessions_approx",
    "stream_active_sessions",
    "ml_glr_total",
    "ml_tree_total",
    "ml_forest_total",
    "ml_forest_distance",
    "ml_gbt_total",
    "ml_tip",
    "ml_ridge_cv",
    "ml_duration",
    "ml_cv_forest",
    "ml_cv_gbt",
    "ml_cv_distance",
    "prediction_top100",
}


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def in_name_order(rows, columns):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    cursor = duck.execute(ORACLE[name])
    columns = [column[0] for column in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert in_name_order(df.collect(), df.columns) == in_name_order(cursor.fetchall(), columns)


def test_only_random_or_fitted_queries_lack_sql():
    assert set(QUERIES) - set(ORACLE) == ROWS_ONLY


@pytest.mark.parametrize("name", sorted(n for n in ROWS_ONLY if n.startswith("ml_cv")))
def test_tuning_scores_every_grid_point(spark, sf_dir, name):
    rows = QUERIES[name](spark, sf_dir).collect()
    grid = regression.GRIDS[TUNED[name.removeprefix("ml_")][0]]
    assert len(rows) == math.prod(map(len, grid.values()))
    assert all(0 < row.avg_rmse < 10 and row.std_rmse >= 0 for row in rows)


@pytest.mark.parametrize(
    "name, best_r2",
    [
        ("ml_glr_total", 0.8),
        ("ml_tree_total", 0.85),
        ("ml_forest_total", 0.9),
        ("ml_forest_distance", 0.6),
        ("ml_gbt_total", 0.97),
        ("ml_tip", -0.2),
        ("ml_duration", -0.2),
    ],
)
def test_scores_are_in_bounds(spark, sf_dir, name, best_r2):
    (row,) = QUERIES[name](spark, sf_dir).collect()
    assert row["rows"] > 1000
    assert best_r2 < row.r2 < 1
    assert 0 < row.mae <= row.rmse and math.isfinite(row.rmse)


def test_reloaded_model_predicts_the_same(spark, sf_dir):
    rows = QUERIES["ml_model_roundtrip"](spark, sf_dir).collect()
    assert len(rows) > 1000 and all(row.same for row in rows)


def test_largest_labels_come_first(spark, sf_dir):
    rows = QUERIES["prediction_top100"](spark, sf_dir).collect()
    assert [row["index"] for row in rows] == list(range(100))
    labels = [row.total_amount for row in rows]
    assert labels == sorted(labels, reverse=True)


def test_entry_runs(spark):
    df = entry(spark)
    assert df.columns == ["hour", "PU_Zone", "total_revenue"]
    assert df.count() == 20
