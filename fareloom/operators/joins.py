"""Fact to dimension joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# A side within both bounds is copied to every executor.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20


def small_side(
    dim: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """``dim`` with a broadcast hint if it is proven small, else as it is.

    The proof is a count that stops after ``max_rows`` + 1 rows. Spark's own
    estimate multiplies the sizes below a join, so it misses a small dimension
    that is itself joined together.
    """
    widths = [F.octet_length(F.col(name).cast("string")) for name in dim.columns]
    width = sum((F.coalesce(each, F.lit(0)) for each in widths), F.lit(0))
    size = dim.limit(max_rows + 1).agg(
        F.count(F.lit(1)).alias("row_count"), F.coalesce(F.sum(width), F.lit(0)).alias("bytes")
    )
    fits = size.select((F.col("row_count") <= max_rows) & (F.col("bytes") <= max_bytes)).head()[0]
    return F.broadcast(dim) if fits else dim


def role_of(
    dim: DataFrame, key: str, dim_key: str, prefix: str, attributes: Sequence[str]
) -> DataFrame:
    """The dimension renamed for one role: its key as ``key``, the rest prefixed."""
    return dim.select(
        F.col(dim_key).alias(key), *(F.col(name).alias(f"{prefix}_{name}") for name in attributes)
    )


def join_role(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    dim_key: str,
    prefix: str,
    attributes: Sequence[str] | None = None,
) -> DataFrame:
    """Left join ``dim`` to ``fact`` in one role; call it once per role.

    Pass ``dim`` through ``small_side`` first, once for all roles. A larger
    one is joined by sort-merge, in which AQE splits the rows of a hot key.
    """
    if attributes is None:
        attributes = [name for name in dim.columns if name != dim_key]
    return fact.join(role_of(dim, key, dim_key, prefix, attributes), on=key, how="left")
