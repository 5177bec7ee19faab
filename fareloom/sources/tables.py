"""Files in and out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


CSV = {"multiLine": "true", "escape": '"', "nullValue": "\\N"}


def load_table(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    schema: StructType | str | None = None,
    **options: str,
) -> DataFrame:
    """Read ``path``. CSV has a header line; every other name means parquet.

    CSV values may hold line breaks and quotes; a value that is empty or ``\\N`` is
    null, a quoted empty one an empty text. A carriage return comes back as a line
    break.

    Without ``schema`` a CSV file is read twice, the first time to infer its
    types, so give one for anything large.
    """
    if fmt != "csv":
        return spark.read.options(**options).parquet(path)
    reader = spark.read.options(**{"header": "true", **CSV, **options})
    reader = reader.schema(schema) if schema else reader.options(inferSchema="true")
    return reader.csv(path)


def save_table(
    df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()
) -> None:
    """Replace whatever is at ``path``."""
    writer = df.write.mode("overwrite").format(fmt).partitionBy(*partition_by)
    if fmt == "csv":
        writer = writer.options(
            header="true",
            ignoreLeadingWhiteSpace="false",
            ignoreTrailingWhiteSpace="false",
            **CSV,
        )
    writer.save(path)
