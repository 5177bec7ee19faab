"""The five trip reports and the average-speed form of the third."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fareloom.functions import day_name
from fareloom.operators.topk import fastest, top_avg, top_count, top_sum, with_speed
from fareloom.plans.prepare import DROPOFF, PICKUP, add_zones, prepare_trips
from fareloom.sources import load_table, save_table

# Limits of a credible speed.
MIN_HOURS = 0.05
MAX_SPEED = 120


def revenue_by_hour_zone(prepared: DataFrame, k: int = 20) -> DataFrame:
    return top_sum(prepared, ["hour", "PU_Zone"], "total_amount", k, 2, "total_revenue")


def zone_pair_counts(prepared: DataFrame, k: int = 20) -> DataFrame:
    return top_count(prepared, ["PU_Zone", "DO_Zone"], k)


def fastest_trips(prepared: DataFrame, k: int = 20) -> DataFrame:
    return fastest(
        prepared,
        PICKUP,
        DROPOFF,
        "trip_distance",
        MIN_HOURS,
        MAX_SPEED,
        k,
        keep=["PU_Zone", "DO_Zone"],
    )


def avg_speed_by_pair(prepared: DataFrame, k: int = 20, digits: int | None = None) -> DataFrame:
    timed = with_speed(prepared, PICKUP, DROPOFF, "trip_distance", MIN_HOURS)
    credible = timed.filter(timed["avg_speed_mph"] < MAX_SPEED)
    return top_avg(credible, ["PU_Zone", "DO_Zone"], "avg_speed_mph", k, digits, "average_speed")


def avg_tip_by_hour(prepared: DataFrame, k: int = 20, digits: int | None = None) -> DataFrame:
    return top_avg(prepared, ["hour"], "tip_amount", k, digits, "average_tip")


def trips_by_day_hour(prepared: DataFrame, k: int = 20, legacy_labels: bool = False) -> DataFrame:
    named = prepared.withColumn("day_name", day_name("day_of_week", legacy_labels))
    return top_count(named, ["day_name", "hour"], k)


# Output folder -> report.
REPORTS = {
    "revenue_per_hour_by_zone": revenue_by_hour_zone,
    "most_frequent_pickup_dropoff_pairs": zone_pair_counts,
    "average_speed": fastest_trips,
    "average_speed_by_pair": avg_speed_by_pair,
    "average_tip_by_hour": avg_tip_by_hour,
    "trips_by_day_hour": trips_by_day_hour,
}


def write_prepared(trips: DataFrame, zones: DataFrame, out: str) -> DataFrame:
    """Prepare once and hand over through files, from which every later job reads
    only its own columns."""
    save_table(add_zones(prepare_trips(trips), zones), out)
    return load_table(trips.sparkSession, out)


def write_reports(spark: SparkSession, prepared_path: str, out: str) -> None:
    prepared = load_table(spark, prepared_path)
    for folder, report in REPORTS.items():
        save_table(report(prepared), f"{out.rstrip('/')}/{folder}")
