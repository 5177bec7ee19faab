"""News-view events: JSON payloads from a topic or from text files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampType

# Field names and types of an event payload.
EVENT_FIELDS = {
    "user_id": StringType(),
    "article_id": StringType(),
    "timestamp": TimestampType(),
    "category": StringType(),
    "location": StringType(),
    "device_type": StringType(),
    "session_id": StringType(),
}
EVENT_SCHEMA = StructType([StructField(name, kind) for name, kind in EVENT_FIELDS.items()])


def parse_events(
    raw: DataFrame, schema: StructType | str = EVENT_SCHEMA, payload: str = "value"
) -> DataFrame:
    """Typed columns from the JSON in ``payload``, which may be bytes or text.

    A payload that is not JSON becomes a row of nulls; it is neither dropped
    nor an error.
    """
    record = F.from_json(F.col(payload).cast("string"), schema)
    return raw.select(record.alias("record")).select("record.*")


def read_events(
    spark: SparkSession,
    source: str,
    schema: StructType | str = EVENT_SCHEMA,
    *,
    path: str | None = None,
    servers: str | None = None,
    topic: str | None = None,
    starting: str = "latest",
    **options: str,
) -> DataFrame:
    """Stream of parsed events from ``source``: ``"kafka"`` or ``"text"``.

    ``options`` go to the source, e.g. ``maxOffsetsPerTrigger`` (kafka) or
    ``maxFilesPerTrigger`` (text) to bound a micro-batch. Kafka needs the
    connector package on the class path.
    """
    reader = spark.readStream.format(source).options(**options)
    if source == "kafka":
        if not (servers and topic):
            raise ValueError("the kafka source needs servers and topic")
        reader = reader.options(
            **{
                "kafka.bootstrap.servers": servers,
                "subscribe": topic,
                "startingOffsets": starting,
            }
        )
        raw = reader.load()
    elif source == "text":
        if not path:
            raise ValueError("the text source needs a path")
        raw = reader.load(path)
    else:
        raise ValueError(f"unknown event source {source!r}")
    return parse_events(raw, schema)
