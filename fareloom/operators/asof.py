"""Joins to the version of a dimension that was valid at a time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fareloom.operators.joins import small_side

SLICE_SECONDS = 30 * 86_400


def _slice(time, seconds: int) -> Column:
    return F.floor(F.unix_timestamp(time) / seconds)


def as_of(
    facts: DataFrame,
    versions: DataFrame,
    key: str,
    ts: str,
    version_key: str,
    valid_from: str,
    attributes: Sequence[str],
    slice_seconds: int = SLICE_SECONDS,
) -> DataFrame:
    """Left join of each fact to the version of its key with the latest ``valid_from`` that
    is not after ``ts``.

    Time is cut into slices, and a version stands in every slice that it is valid in: so
    the join is an equality of key and slice, a fact meets the versions of its own slice
    only, and the facts of a hot key are spread over its slices (AQE splits them
    further). Versions with the same key and time count by their attributes, the largest
    last. A fact without time, key or earlier version keeps nulls; versions without a
    time take no part.
    """
    span = facts.agg(
        F.min(_slice(ts, slice_seconds)).alias("a"), F.max(_slice(ts, slice_seconds)).alias("b")
    ).first()
    order = W.partitionBy("_key").orderBy("_from", *attributes)
    valid = (
        versions.filter(F.col(valid_from).isNotNull() & F.col(version_key).isNotNull())
        .select(F.col(version_key).alias("_key"), F.col(valid_from).alias("_from"), *attributes)
        .withColumn("_until", F.lead("_from").over(order))
    )
    first = F.greatest(_slice("_from", slice_seconds), F.lit(span.a))
    last = F.least(_slice("_until", slice_seconds), F.lit(span.b))
    if span.a is None:  # no fact has a time
        first, last = F.lit(1), F.lit(0)
    placed = (
        valid.withColumns({"_first": first, "_last": last})
        .filter(F.col("_first") <= F.col("_last"))
        .withColumn("_slice", F.explode(F.sequence("_first", "_last")))
        .drop("_first", "_last")
    )
    timed = facts.withColumn("_fact_slice", _slice(ts, slice_seconds))
    on = (
        (timed[key] == placed["_key"])
        & (timed["_fact_slice"] == placed["_slice"])
        & (timed[ts] >= placed["_from"])
        & (placed["_until"].isNull() | (timed[ts] < placed["_until"]))
    )
    joined = timed.join(small_side(placed), on, "left")
    return joined.drop("_key", "_until", "_slice", "_fact_slice").withColumnRenamed("_from", valid_from)
