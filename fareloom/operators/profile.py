"""Column profiles, each from a single pass and in long form (one row per column)."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, NumericType, StringType


def numeric_columns(df: DataFrame) -> list[str]:
    """Names of the double, int and long columns."""
    wanted = (DoubleType, IntegerType, LongType)
    return [field.name for field in df.schema.fields if isinstance(field.dataType, wanted)]


def _row_per_column(
    df: DataFrame, measures: dict[str, dict[str, Column]], kinds: dict[str, str]
) -> DataFrame:
    """One global aggregate over all columns, then its single row turned on its side.

    ``kinds`` names the result columns and their types; a kind that a column
    does not measure is null.
    """
    flat = [
        measure.alias(f"{i}.{kind}")
        for i, per_kind in enumerate(measures.values())
        for kind, measure in per_kind.items()
    ]
    records = [
        F.struct(
            F.lit(column).alias("column_name"),
            *(
                (F.col(f"`{i}.{kind}`") if kind in per_kind else F.lit(None))
                .cast(type_name)
                .alias(kind)
                for kind, type_name in kinds.items()
            ),
        )
        for i, (column, per_kind) in enumerate(measures.items())
    ]
    return df.agg(*flat).select(F.inline(F.array(*records)))


def null_counts(df: DataFrame) -> DataFrame:
    measures = {c: {"null_count": F.count_if(F.col(f"`{c}`").isNull())} for c in df.columns}
    return _row_per_column(df, measures, {"null_count": "bigint"})


DESCRIPTION = {
    "row_count": "bigint",
    "mean": "double",
    "stddev": "double",
    "min_value": "double",
    "max_value": "double",
    "min_text": "string",
    "max_text": "string",
}


def describe_columns(df: DataFrame, digits: int | None = None) -> DataFrame:
    """Count, mean, sample deviation, minimum and maximum.

    Numbers report ``min_value`` / ``max_value``, strings ``min_text`` /
    ``max_text``; other types are left out, as in ``DataFrame.describe``.
    ``digits`` rounds mean and deviation.
    """

    def settle(measure: Column) -> Column:
        return measure if digits is None else F.round(measure, digits)

    measures = {}
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, NumericType):
            measures[field.name] = {
                "row_count": F.count(column),
                "mean": settle(F.avg(column.cast("double"))),
                "stddev": settle(F.stddev_samp(column.cast("double"))),
                "min_value": F.min(column),
                "max_value": F.max(column),
            }
        elif isinstance(field.dataType, StringType):
            measures[field.name] = {
                "row_count": F.count(column),
                "min_text": F.min(column),
                "max_text": F.max(column),
            }
    return _row_per_column(df, measures, DESCRIPTION)


def correlation_matrix(df: DataFrame, digits: int | None = None) -> DataFrame:
    """Pearson correlation of every pair of numeric columns: col_a, col_b, r.

    Rows with a null in any of them are left out; ``r`` is null for a constant
    column. Only the matrix itself, columns by columns, passes the driver.
    """
    names = numeric_columns(df)
    complete = df.select(*names).na.drop()
    vectors = VectorAssembler(inputCols=names, outputCol="features").transform(complete)
    matrix = Correlation.corr(vectors.select("features"), "features", "pearson").head()[0]
    cells = [
        (a, b, float(matrix[i, j])) for i, a in enumerate(names) for j, b in enumerate(names)
    ]
    r = F.nanvl(F.col("r"), F.lit(None).cast("double"))
    if digits is not None:
        r = F.round(r, digits)
    table = df.sparkSession.createDataFrame(cells, "col_a STRING, col_b STRING, r DOUBLE")
    return table.withColumn("r", r)
