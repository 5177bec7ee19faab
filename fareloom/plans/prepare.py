"""Preparation of raw trips: the contract between all batch and regression jobs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.functions import elapsed, total
from fareloom.operators.joins import join_role, small_side

# Column names of the trip and zone tables.
PICKUP = "tpep_pickup_datetime"
DROPOFF = "tpep_dropoff_datetime"
FEES = (
    "extra",
    "mta_tax",
    "tolls_amount",
    "improvement_surcharge",
    "congestion_surcharge",
    "airport_fee",
)
UNUSED = ("RatecodeID", "store_and_fwd_flag")
ZONE_ATTRIBUTES = ("Borough", "Zone")
ZONE_SCHEMA = "LocationID INT, Borough STRING, Zone STRING"


def valid_trips(trips: DataFrame, start: str = PICKUP, end: str = DROPOFF) -> DataFrame:
    """Trips that end after they start; a null on either side removes the row."""
    return trips.filter(F.col(end) > F.col(start))


def with_time_parts(trips: DataFrame, start: str = PICKUP) -> DataFrame:
    return trips.withColumns({"hour": F.hour(start), "day_of_week": F.dayofweek(start)})


def prepare_trips(
    trips: DataFrame,
    start: str = PICKUP,
    end: str = DROPOFF,
    fee_cols: Sequence[str] = FEES,
    drop_cols: Sequence[str] = UNUSED + FEES,
) -> DataFrame:
    """Valid trips with hour, weekday and fee total; names absent in ``drop_cols`` are ignored."""
    timed = with_time_parts(valid_trips(trips, start, end), start)
    return timed.withColumn("extras", total(fee_cols)).drop(*drop_cols)


def with_trip_time(trips: DataFrame, start: str = PICKUP, end: str = DROPOFF) -> DataFrame:
    """Adds ``triptime`` in seconds."""
    return trips.withColumn("triptime", elapsed(start, end))


def add_zones(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Borough and zone of both ends; null where the location is unknown."""
    zones = small_side(zones)
    picked_up = join_role(trips, zones, "PULocationID", "LocationID", "PU", ZONE_ATTRIBUTES)
    return join_role(picked_up, zones, "DOLocationID", "LocationID", "DO", ZONE_ATTRIBUTES)
