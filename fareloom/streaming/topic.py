"""A topic on files: events as JSON lines, to be read by the text source."""

from __future__ import annotations

import math
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.session import file_times, set_file_times
from fareloom.sources.events import EVENT_SCHEMA

MAX_RECORDS_PER_FILE = 1_000_000
SLICES = 8
STEP_MS = 1000  # between the ages of two files; some stores keep whole seconds only


def part_order(name: str) -> tuple[int, int]:
    """Place of a written file: its partition, then its number within it."""
    found = re.match(r"part-(\d+)-.*?(?:-c(\d+))?(?:\.\w+)*$", name)
    return int(found[1]), int(found[2] or 0)


def write_topic(
    events: DataFrame,
    path: str,
    slices: int = SLICES,
    max_records_per_file: int = MAX_RECORDS_PER_FILE,
) -> int:
    """Write ``events`` as JSON lines, oldest first; the number of files.

    Events are parted by ranges of time, ``slices`` of them or as many as give one
    file each, and sorted within a range, so that no file holds an event older than
    one of a file before it. All ranges are written at once; then files are given
    ages in the order of their events, as the text source reads by age. However many
    files a micro-batch takes, a watermark behind it closes no window that a later
    file still needs. Events without a time come last.

    Read the topic once it is written. A store that does not keep the ages raises an
    error, as events would be lost there.
    """
    spark, fields = events.sparkSession, EVENT_SCHEMA.fieldNames()
    parts = max(slices, math.ceil(events.count() / max_records_per_file))
    # Events of the same time may go to several ranges.
    order = [F.asc_nulls_last("timestamp"), F.xxhash64(*fields)]
    lines = events.repartitionByRange(parts, *order).sortWithinPartitions(order[0])
    payload = F.to_json(F.struct(*fields)).alias("value")

    before = file_times(spark, path)
    writer = lines.select(payload).write.mode("append")
    writer.option("maxRecordsPerFile", max_records_per_file).text(path)
    after = file_times(spark, path)

    written = sorted(after.keys() - before.keys(), key=part_order)
    if not written:
        return 0
    first = max(after[name] for name in written) - STEP_MS * (len(written) - 1)
    first = max([first, *(t + STEP_MS for t in before.values())])
    wanted = {name: first + STEP_MS * i for i, name in enumerate(written)}
    set_file_times(spark, path, wanted)
    kept = file_times(spark, path)
    ages = [kept[name] for name in written]
    if any(a >= b for a, b in zip(ages, ages[1:], strict=False)):
        raise OSError(f"{path}: the store does not keep the ages of files, which order the topic")
    return len(written)
