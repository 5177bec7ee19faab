"""Queries of the operators that SQL can express, on the smallest tables."""

from __future__ import annotations

import duckdb
import pytest

from fareloom.llm.oracle import ORACLE
from fareloom.llm.queries import QUERIES


@pytest.mark.parametrize("name", ["op11_spelling_variants", "op13_ranked_search"])
def test_query_equals_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    cursor = con.execute(ORACLE[name])
    columns = [c[0] for c in cursor.description]
    got = QUERIES[name](spark, sf_dir).select(*columns).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(cursor.fetchall(), key=repr)
    assert len(got) > 50
