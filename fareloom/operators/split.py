"""Train / test splits by row key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fareloom.functions import key_bucket


def in_train(weights: Mapping[str, int], train_tenths: int) -> Column:
    """Whether a row trains; a row with a null in its key tests."""
    return F.coalesce(key_bucket(weights, 10) < train_tenths, F.lit(False))


def sample_by_key(df: DataFrame, weights: Mapping[str, int], buckets: int = 100) -> DataFrame:
    """About one row in ``buckets``, chosen by the row key alone."""
    return df.filter(key_bucket(weights, buckets, shift=7) == 0)


def bottom_k(df: DataFrame, keys: Sequence[str], k: int, strata: Sequence[str] = ()) -> DataFrame:
    """Exactly ``k`` rows (all, if fewer), of each stratum if ``strata`` are given: those
    whose key hashes lowest.

    The sample follows from the keys alone, not from partitions or cores, and the sample
    of a union is a sample of the samples. Every task hands on ``k`` rows a stratum.
    """
    draw = F.md5(F.concat_ws("|", *(F.col(c).cast("string") for c in keys)))
    drawn = df.withColumn("_draw", draw)
    if not strata:
        return drawn.orderBy("_draw", *keys).limit(k).drop("_draw")
    place = F.row_number().over(W.partitionBy(*strata).orderBy("_draw", *keys))
    return drawn.withColumn("_place", place).filter(F.col("_place") <= k).drop("_draw", "_place")


def assign_split(
    df: DataFrame,
    weights: Mapping[str, int],
    train_tenths: int = 8,
    name: str = "split",
) -> DataFrame:
    """Label each row "train" or "test".

    Write the table partitioned by the label and each part is read alone.
    """
    chosen = F.when(in_train(weights, train_tenths), "train").otherwise("test")
    return df.withColumn(name, chosen)


def train_test(
    df: DataFrame,
    weights: Mapping[str, int] | None = None,
    train_tenths: int = 8,
    seed: int = 42,
) -> tuple[DataFrame, DataFrame]:
    """Both parts, each a plain filter on the row key, by the rule of ``assign_split``.

    A table without a key falls back on ``DataFrame.randomSplit``, which sorts
    every partition and still moves rows when the partitioning changes.
    """
    if weights is None:
        train, test = df.randomSplit([train_tenths / 10, 1 - train_tenths / 10], seed=seed)
        return train, test
    trains = in_train(weights, train_tenths)
    return df.filter(trains), df.filter(~trains)
