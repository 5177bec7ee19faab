from fareloom.operators.joins import join_role, small_side
from fareloom.operators.profile import (
    correlation_matrix,
    describe_columns,
    null_counts,
    numeric_columns,
)
from fareloom.operators.split import assign_split, train_test
from fareloom.operators.topk import fastest, top_avg, top_count, top_per_group, top_rows, top_sum
from fareloom.operators.windows import first_crossings, windowed_count, windowed_distinct

__all__ = [
    "assign_split",
    "correlation_matrix",
    "describe_columns",
    "fastest",
    "first_crossings",
    "join_role",
    "null_counts",
    "numeric_columns",
    "small_side",
    "top_avg",
    "top_count",
    "top_per_group",
    "top_rows",
    "top_sum",
    "train_test",
    "windowed_count",
    "windowed_distinct",
]
