"""Ways to run a stream.

No result passes the driver: the executors write it. Complete mode keeps every
group for good, so state goes to local disk and the checkpoint.

``partitions`` is the number of state partitions, which a checkpoint keeps for
good and AQE cannot merge; without it ``spark.sql.shuffle.partitions`` counts.
"""

from __future__ import annotations

from collections.abc import Callable
from threading import RLock

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from fareloom.session import DISK_STATE, delete, is_local


# Starts take turns, as each changes the session's settings for a moment.
_starting = RLock()


def _start(
    stream: DataFrame, writer: DataStreamWriter, partitions: int | None
) -> StreamingQuery:
    """Start with ``DISK_STATE``. A query copies its session when it starts, so
    the settings of the caller's session can be put back at once."""
    conf = stream.sparkSession.conf
    with _starting:
        return _start_with(conf, writer, partitions)


def _start_with(conf, writer: DataStreamWriter, partitions: int | None) -> StreamingQuery:
    settings = dict(DISK_STATE)
    if partitions:
        settings["spark.sql.shuffle.partitions"] = str(partitions)
    before = {key: conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            conf.set(key, value)
        return writer.start()
    finally:
        for key, value in before.items():
            conf.unset(key) if value is None else conf.set(key, value)


def run_complete(
    stream: DataFrame,
    path: str,
    post: Callable[[DataFrame], DataFrame] | None = None,
    partitions: int | None = None,
    keep: int = 2,
) -> DataFrame:
    """Process all available input in complete mode; the final result table.

    Every micro-batch writes the whole result to its own ``batch=<n>`` folder
    below ``path``, straight from the executors. A batch that runs again after
    a failure replaces its folder, so results are never doubled; the last ``keep``
    folders stay. ``post`` is
    applied to the result of each batch, for steps that Spark allows on static
    data only.
    """
    done: list[int] = []
    out = f"{path}/result"

    def write_batch(result: DataFrame, number: int) -> None:
        if post is not None:
            result = post(result)
        result.write.mode("overwrite").parquet(f"{out}/batch={number}")
        done.append(number)
        if number >= keep:
            delete(spark, f"{out}/batch={number - keep}")

    spark = stream.sparkSession
    writer = (
        stream.writeStream.outputMode("complete")
        .option("checkpointLocation", f"{path}/checkpoint")
        .trigger(availableNow=True)
        .foreachBatch(write_batch)
    )
    _start(stream, writer, partitions).awaitTermination()
    if done:
        return spark.read.parquet(f"{out}/batch={done[-1]}")
    # A restart without new input runs no batch: the last result still stands.
    history = spark.read.parquet(out)
    newest = history.agg(F.max("batch").alias("batch"))
    return history.join(F.broadcast(newest), "batch").drop("batch")


def run_parts(
    stream: DataFrame, path: str, reduce: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """Process all available input; the table of what ``reduce`` makes of each micro-batch.

    For results that add up: readers combine the rows of a group, of which every
    micro-batch that met it wrote one. No state is kept and nothing is written twice, so
    the work follows the input however many micro-batches there are. Each writes its own
    ``batch=<n>`` folder below ``path``, which it replaces if it runs again.
    """
    spark = stream.sparkSession
    out = f"{path}/result"

    def write_batch(rows: DataFrame, number: int) -> None:
        reduce(rows).write.mode("overwrite").parquet(f"{out}/batch={number}")

    writer = (
        stream.writeStream.option("checkpointLocation", f"{path}/checkpoint")
        .trigger(availableNow=True)
        .foreachBatch(write_batch)
    )
    _start(stream, writer, None).awaitTermination()
    schema = reduce(spark.createDataFrame([], stream.schema)).schema
    return spark.read.schema(schema).parquet(out).select(*schema.names)


def run_append(stream: DataFrame, path: str, partitions: int | None = None) -> DataFrame:
    """Process all available input in append mode into parquet, exactly once."""
    out = f"{path}/result"
    writer = (
        stream.writeStream.outputMode("append")
        .format("parquet")
        .option("path", out)
        .option("checkpointLocation", f"{path}/checkpoint")
        .trigger(availableNow=True)
    )
    _start(stream, writer, partitions).awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(out)


def show_forever(
    stream: DataFrame,
    checkpoint: str | None = None,
    mode: str = "complete",
    partitions: int | None = None,
    rows: int = 1000,
) -> StreamingQuery:
    """Print up to ``rows`` rows of every micro-batch; stop it with ``stop()`` on the
    returned query. Only a local master may do without ``checkpoint``: Spark would
    put it into a folder of the driver's machine."""
    if not checkpoint and not is_local(stream.sparkSession):
        raise ValueError("give a checkpoint folder that all executors share")
    writer = stream.writeStream.outputMode(mode).format("console")
    writer = writer.options(truncate="false", numRows=rows)
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    return _start(stream, writer, partitions)
