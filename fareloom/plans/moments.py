"""Linear regression from sums of products.

The sums of all products of two terms of a row (the constant, numbers, one indicator for
each value of a code, and the label) say all that a least-squares fit needs. They are
added up per fold in one aggregate; the sums without a fold are a subtraction, and the
errors on a fold follow from its own sums. So a grid of penalties over all folds costs
one pass over the rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareloom.plans.regression import FeatureSet, complete_rows

CONSTANT, LABEL = "1", "label"
# Terms whose sums are taken to the driver: a square of them.
MAX_TERMS = 2000


def moments(
    df: DataFrame, features: FeatureSet, label: str, fold: Column | None = None
) -> DataFrame:
    """(fold, a, b, total): sums of the products of two terms, ``a`` before ``b`` in the
    order of a row's terms. Rows with a missing value are left out.

    Rows with the same codes are added up first, in each task: what is left does not grow
    with the rows, and only its pairs of terms are taken apart."""
    fold = F.lit(0) if fold is None else fold
    rows = complete_rows(df, features, label).withColumn("_fold", fold)
    numbers = [F.lit(1.0), *(F.col(n).cast("double") for n in (*features.numeric, label))]
    places = range(len(numbers))
    sums = {(i, j): f"_s{i}_{j}" for i in places for j in places if i <= j}
    grouped = rows.groupBy("_fold", *features.codes).agg(
        *(F.sum(numbers[i] * numbers[j]).alias(name) for (i, j), name in sums.items())
    )
    # Terms in order: the number each is, or 0 for an indicator, and its code.
    none = F.lit(None).cast("string")
    terms = [(0, none), *((i, none) for i in range(1, len(features.numeric) + 1))]
    terms += [(0, F.col(c).cast("string")) for c in features.codes]
    terms += [(len(numbers) - 1, none)]
    pairs = [
        F.struct(
            F.lit(p).alias("p"), F.lit(q).alias("q"), x.alias("x"), y.alias("y"),
            F.col(sums[min(i, j), max(i, j)]).alias("product"),
        )
        for p, (i, x) in enumerate(terms)
        for q, (j, y) in enumerate(terms[p:], p)
    ]
    totals = (
        grouped.select(F.col("_fold").alias("fold"), F.inline(F.array(*pairs)))
        .groupBy("fold", "p", "q", "x", "y")
        .agg(F.sum("product").alias("total"))
    )
    names = [CONSTANT, *features.numeric, *(f"{c}=" for c in features.codes), LABEL]
    name = F.array(*map(F.lit, names))

    def named(place: str, code: str) -> Column:
        return F.concat(name[F.col(place)], F.coalesce(code, F.lit("")))

    return totals.select("fold", named("p", "x").alias("a"), named("q", "y").alias("b"), "total")


@dataclass
class Moments:
    """``sums[k]`` is the matrix of fold k; the last term is the label."""

    names: list[str]
    sums: dict[int, np.ndarray]

    @classmethod
    def of(cls, totals: DataFrame, limit: int = MAX_TERMS) -> Moments:
        rows = totals.limit(limit * limit + 1).collect()
        names = {r.a for r in rows} | {r.b for r in rows}
        if len(names) > limit or len(rows) > limit * limit:
            raise ValueError(f"more than {limit} terms")
        names = sorted(names, key=lambda n: (n == LABEL, n != CONSTANT, n))
        at = {name: i for i, name in enumerate(names)}
        sums: dict[int, np.ndarray] = {}
        for r in rows:
            own = sums.setdefault(r.fold, np.zeros((len(names), len(names))))
            own[at[r.a], at[r.b]] = own[at[r.b], at[r.a]] = r.total
        return cls(names, sums)

    def without(self, fold: int | None) -> np.ndarray:
        """The matrix of all rows but those of ``fold``."""
        return sum(m for k, m in self.sums.items() if k != fold)


def ridge(matrix: np.ndarray, penalty: float) -> np.ndarray:
    """Coefficients of all terms but the label, the constant first.

    The penalty is on standardised features and label, and not on the constant, as in
    Spark's generalised linear regression. Terms without variance get 0.
    """
    n = matrix[0, 0]
    mean = matrix[0] / n
    cov = matrix / n - np.outer(mean, mean)
    spread = np.sqrt(np.maximum(np.diag(cov), 0))
    used = np.flatnonzero(spread[:-1] > 1e-12 * (1 + np.abs(mean[:-1])))
    used = used[used > 0]
    out = np.zeros(len(matrix) - 1)
    if len(used) and spread[-1] > 0:
        scale = spread[used]
        inner = cov[np.ix_(used, used)] / np.outer(scale, scale)
        inner += penalty / spread[-1] * np.eye(len(used))
        against = cov[used, -1] / (scale * spread[-1])
        out[used] = np.linalg.lstsq(inner, against, rcond=None)[0] * spread[-1] / scale
    out[0] = mean[-1] - out[1:] @ mean[1:-1]
    return out


def rmse(matrix: np.ndarray, coefficients: np.ndarray) -> float:
    """Error on the rows of ``matrix``."""
    weights = np.append(coefficients, -1.0)
    return float(np.sqrt(max(0.0, weights @ matrix @ weights / matrix[0, 0])))


def ridge_scores(
    totals: DataFrame, penalties: Sequence[float]
) -> list[tuple[float, float, float]]:
    """(penalty, mean and deviation of RMSE over the folds)."""
    known = Moments.of(totals)
    out = []
    for penalty in penalties:
        errors = [
            rmse(own, ridge(known.without(fold), penalty)) for fold, own in sorted(known.sums.items())
        ]
        out.append((penalty, float(np.mean(errors)), float(np.std(errors))))
    return out
