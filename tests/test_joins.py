from __future__ import annotations

import re

from pyspark.sql import functions as F

from checks.queries import QUERIES
from conftest import plan_of
from fareloom.operators import join_role, small_side
from fareloom.plans.prepare import add_zones


def zones(spark):
    return spark.createDataFrame(
        [(1, "Queens", "Astoria"), (2, "Bronx", "Baychester")],
        "LocationID INT, Borough STRING, Zone STRING",
    )


def test_one_dimension_in_two_roles(spark):
    fact = spark.createDataFrame(
        [(10, 1, 2), (11, 2, 99), (12, None, 1)], "id INT, PULocationID INT, DOLocationID INT"
    )
    rows = add_zones(fact, zones(spark)).orderBy("id").collect()
    assert [(r.PU_Zone, r.DO_Zone) for r in rows] == [
        ("Astoria", "Baychester"),
        ("Baychester", None),
        (None, "Astoria"),
    ]
    assert rows[1].DOLocationID == 99 and rows[1].DO_Borough is None


def test_all_attributes_by_default(spark):
    fact = spark.createDataFrame([(1,)], "k INT")
    assert join_role(fact, zones(spark), "k", "LocationID", "P").columns == [
        "k", "P_Borough", "P_Zone",
    ]


def test_broadcast_only_below_the_checked_size(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact, dim = spark.range(1000), spark.range(50).select("id", F.lit("name").alias("name"))
        for side, broadcast in (
            (small_side(dim), True),
            (small_side(dim, max_rows=49), False),
            (small_side(dim, max_bytes=100), False),
        ):
            joined = join_role(fact, side, "id", "id", "d")
            assert ("BroadcastHashJoin" in plan_of(joined)) is broadcast
            assert joined.filter("d_name IS NOT NULL").count() == 50
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_key_is_split_when_the_dimension_is_large(spark, tmp_path):
    """More than a third of the fact on one key, no broadcast: AQE splits it, no row is lost."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    fact = spark.range(200_000).select(
        F.when(F.col("id") % 5 < 2, 7).otherwise(F.col("id") % 4000).alias("k"),
        F.col("id").alias("row"),
    ).repartition(8)
    dim = spark.range(3500).select("id", F.concat(F.lit("zone "), "id").alias("Zone"))
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        joined = join_role(fact, small_side(dim, max_rows=100), "k", "id", "PU")
        rows = joined.collect()
        assert "skew=true" in plan_of(joined)
    finally:
        for key in settings:
            spark.conf.unset(key)
    assert len(rows) == 200_000
    assert all(r.PU_Zone == (f"zone {r.k}" if r.k < 3500 else None) for r in rows)


def test_zones_reach_the_reports_by_broadcast_even_with_a_low_threshold(spark, sf_dir):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(QUERIES["zone_pair_counts"](spark, sf_dir))
        assert len(re.findall("BroadcastHashJoin .*LeftOuter", plan)) == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_scans_read_only_what_a_report_needs(spark, sf_dir):
    plan = plan_of(QUERIES["avg_tip_by_hour"](spark, sf_dir))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    columns = {field.split(":")[0] for schema in schemas for field in schema.split(",")}
    assert "l_discount" in columns
    assert not columns & {"l_quantity", "l_tax", "l_shipdate", "c_nationkey", "n_name", "c_name"}


def test_no_query_leaves_the_jvm(spark, sf_dir):
    for name, query in QUERIES.items():
        if name.startswith(("ml_", "prediction_", "stream_")):
            continue
        plan = plan_of(query(spark, sf_dir))
        assert "Python" not in plan and "InPandas" not in plan, name
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan, name
