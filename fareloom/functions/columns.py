"""Column expressions, all built-in functions that stay inside generated code."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weekday names, Monday first.
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")

SECONDS_PER_HOUR = 3600.0


def total(columns: Sequence[str]) -> Column:
    """Sum from left to right; null as soon as one term is null."""
    return reduce(add, map(F.col, columns))


def elapsed(start: str, end: str) -> Column:
    """Whole seconds from ``start`` to ``end``."""
    return F.unix_timestamp(end) - F.unix_timestamp(start)


def speed(distance: str, hours: str) -> Column:
    """Distance per hour, null where no time has passed."""
    return F.try_divide(F.col(distance), F.col(hours))


def day_name(day: str, legacy_labels: bool = False) -> Column:
    """Name of a day number of ``F.dayofweek``, where 1 is Sunday.

    ``legacy_labels`` reads 1 as Monday instead, which labels every day one
    too late but matches reports made that way. Other numbers and null are
    "Unknown".
    """
    names = WEEKDAYS if legacy_labels else WEEKDAYS[-1:] + WEEKDAYS[:-1]
    named = F.when(F.col(day) == 1, names[0])
    for number, name in enumerate(names[1:], 2):
        named = named.when(F.col(day) == number, name)
    return named.otherwise("Unknown")


def key_bucket(weights: Mapping[str, int], buckets: int, shift: int = 1) -> Column:
    """Bucket 0 .. ``buckets - 1`` of a row from a weighted sum of its key columns.

    The bucket depends on the key alone, not on partitioning or row order, so
    a retried task or a second run puts each row where it was before. A
    different ``shift`` gives a second, independent bucketing of the same key.
    """
    mixed = reduce(add, (F.col(name).cast("long") * weight for name, weight in weights.items()))
    return F.pmod(F.floor(mixed / shift) if shift > 1 else mixed, F.lit(buckets)).cast("int")
