"""Helpers that the operators of this package share.

Operators read the columns they name and return only the columns they document,
so further input columns, whatever they are called, never clash.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareloom.session import delete, scratch_path, ship

# Characters that part words; ``bytes.split()`` and this pattern agree on them.
SPACES = " \t\n\v\f\r"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")

# Text handled at once inside a task. Only the longest single text goes beyond it.
CHUNK_BYTES = 4_000_000


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read again: its lineage ends here."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def replaced(df: DataFrame, label: str, old: list[str]) -> DataFrame:
    """``stored``, after which the folders ``old`` are deleted; the new one is put there."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    for folder in old:
        delete(df.sparkSession, folder)
    old[:] = [path]
    return df.sparkSession.read.schema(df.schema).parquet(path)


def by_chunks(batch: pa.RecordBatch, texts: str, limit: int = CHUNK_BYTES) -> Iterator:
    """Slices of ``batch`` whose ``texts`` hold about ``limit`` bytes, one row at least."""
    n = batch.num_rows
    if not n:
        return
    column = batch.column(batch.schema.get_field_index(texts))
    sizes = pc.fill_null(pc.binary_length(column), 0)
    ends = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < n:
        base = ends[start - 1] if start else 0
        stop = int(np.searchsorted(ends, base + limit, side="right"))
        stop = min(n, max(stop, start + 1))
        yield batch.slice(start, stop - start)
        start = stop


def map_texts(
    df: DataFrame,
    per_chunk: Callable[[pa.RecordBatch], pa.RecordBatch],
    schema: str,
    text_col: str = "text",
) -> DataFrame:
    """``per_chunk`` on slices of bounded size; no row leaves its partition."""

    def run(batches):
        for batch in batches:
            for piece in by_chunks(batch, text_col):
                yield per_chunk(piece)

    return df.mapInArrow(run, schema)


def id_and_text(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))


def numbered(df: DataFrame) -> DataFrame:
    """``df`` with columns c0, c1, ... whatever they are called; ``toDF`` gives names back."""
    return df.toDF(*(f"c{i}" for i in range(len(df.columns))))


def number_of(df: DataFrame, name: str) -> str:
    """What ``numbered`` calls a column; the name counts as it is written."""
    return f"c{df.columns.index(name)}"


def splitmix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser on unsigned 64-bit integers."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
