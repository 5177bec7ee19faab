"""Labelled documents for the classifiers: a bounded sample with its texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.llm.common import id_and_text, number_of, numbered, stored

# Bound on the labelled rows that a classifier is fitted on.
MAX_LABELLED = 20_000
# Texts longer than this many characters are left out of the sample, not cut.
MAX_CHARS = 200_000


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    limit: int = MAX_LABELLED,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """At most ``limit`` rows (doc_id, text, label), written to the shared folder.

    The rows with the smallest hash of their id are taken, so the sample follows
    from the data alone. Null ids and null labels are left out; an id that is
    labelled more than once counts with its largest label, and so does a text that
    several documents share; it is taken once.
    """
    chosen = (
        labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label).alias("label"))
        .filter(F.col("doc_id").isNotNull() & F.col("label").isNotNull())
        .groupBy("doc_id")
        .agg(F.max("label").cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(limit)
    )
    own = id_and_text(numbered(docs), number_of(docs, id_col), number_of(docs, text_col))
    own = own.filter(F.length("text") <= MAX_CHARS)
    # The sample is bounded by ``limit`` narrow rows, so it may be sent to all tasks.
    found = own.join(F.broadcast(chosen), "doc_id")
    one = found.groupBy("text").agg(F.min("doc_id").alias("doc_id"), F.max("label").alias("label"))
    return stored(one, f"labelled-{label}")
