from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fareloom.llm.labelled import labelled_sample
from fareloom.llm.toxicity import (
    SeverityModel,
    fit_cumulative_link,
    fit_severity,
    severity,
    without_toxic,
)


@pytest.fixture(scope="module")
def tables(spark):
    random.seed(11)
    words = ["".join(random.choices("abcdeklmnorst", k=5)) for _ in range(400)]
    bad = ["grubby", "snark", "vexomania", "vexology", "vexarium"]
    docs, labels = [], []
    for i in range(600):
        text = random.choices(words, k=random.randrange(20, 120))
        toxic = i % 6 == 0
        for _ in range(random.randrange(2, 7) if toxic else 0):
            text.insert(random.randrange(len(text)), random.choice(bad).upper() + "!")
        docs.append((i, " ".join(text)))
        labels.append((i, int(toxic)))
    return (
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(labels, "doc_id long, toxic int"),
    )


def test_held_out_documents(spark, tables):
    docs, labels = tables
    model = fit_severity(labelled_sample(docs, labels.filter("doc_id < 400"), "toxic"))
    assert sorted(model.thresholds) == list(model.thresholds)
    rows = severity(docs.filter("doc_id >= 400"), model).collect()
    right = sum(r.rejected == (r.doc_id % 6 == 0) for r in rows)
    assert right / len(rows) > 0.97
    assert not any(r.rejected for r in rows if r.doc_id % 6)
    many = severity(
        spark.createDataFrame([(1, "snark grubby vexology vexomania vexarium")], docs.schema), model
    ).first()
    few = severity(spark.createDataFrame([(1, "snark grubby")], docs.schema), model).first()
    assert many.severity > few.severity and many.n_marked == 5


def test_thresholds_share_the_weights():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 4, 2000)
    grades = np.searchsorted([1.5, 2.5], x + rng.normal(0, 0.3, 2000))
    weights, cuts = fit_cumulative_link(
        x[x > 0].astype(float), np.flatnonzero(x), np.zeros((x > 0).sum(), int), grades,
        np.zeros(1), 2,
    )
    assert cuts[0] < cuts[1]
    assert abs(cuts[0] / weights[0] - 1.5) < 0.15 and abs(cuts[1] / weights[0] - 2.5) < 0.2


def test_fit_has_the_largest_likelihood():
    """Against the likelihood written out: no step away from the fit raises it."""
    rng = np.random.default_rng(7)
    n, width, levels = 300, 3, 2
    x = rng.integers(0, 3, (n, width)).astype(float)
    link = x @ np.array([1.0, 0.5, -0.7]) + rng.logistic(0, 1, n)
    grades = np.searchsorted([0.5, 2.0], link)
    rows, columns = np.nonzero(x)
    prior = np.zeros(width)
    weights, cuts = fit_cumulative_link(x[rows, columns], rows, columns, grades, prior, levels, 3000)

    def likelihood(w, t):
        total = -0.5 * 1e-4 * n * sum(v * v for v in w)
        for features, grade in zip(x, grades):
            above = [1.0, *(1 / (1 + math.exp(c - float(features @ w))) for c in t), 0.0]
            total += math.log(above[grade] - above[grade + 1])
        return total

    best = likelihood(weights, cuts)
    for i in range(width + levels):
        for step in (-0.05, 0.05):
            moved = np.concatenate([weights, cuts])
            moved[i] += step
            assert likelihood(moved[:width], moved[width:]) < best


def test_expected_severity_written_out():
    model = SeverityModel({"bad": 1.2, "awf-": 0.4}, (0.3, 1.0, 2.5))
    link = 1.2
    above = [1 / (1 + math.exp(t - link)) for t in model.thresholds]
    chance = [1 - above[0], above[0] - above[1], above[1] - above[2], above[2]]
    n, p, expected, grade = model.score("Bad, good")
    assert (n, p) == (1, pytest.approx(above[0]))
    assert expected == pytest.approx(sum(g * c for g, c in enumerate(chance)))
    assert grade == sum(a >= 0.5 for a in above)


def test_edge_rows(spark, tables):
    docs, labels = tables
    model = fit_severity(labelled_sample(docs, labels, "toxic"))
    rows = [(None, "snark! grubby vexology"), (1, None), (2, ""), (3, "plain " * 200_000), (3, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("grade", F.lit("x"))
    got = sorted((r.doc_id or 0, r.rejected) for r in severity(df, model).collect())
    assert got == [(0, True), (1, False), (2, False), (3, False), (3, False)]
    kept = without_toxic(df, model)
    assert kept.columns == df.columns and kept.count() == 4
    assert severity(df.limit(0), model).count() == 0
    nothing = fit_severity(labelled_sample(docs, labels.limit(0), "toxic"))
    assert nothing == SeverityModel()
    assert not any(r.rejected for r in severity(df, nothing).collect())


def test_sample_is_bounded_and_repeats(spark, tables):
    docs, labels = tables
    odd = labels.union(labels.limit(5)).union(
        spark.createDataFrame([(None, 1), (7, None)], labels.schema)
    )
    first = sorted(r.doc_id for r in labelled_sample(docs, odd, "toxic", 50).collect())
    again = sorted(r.doc_id for r in labelled_sample(docs.repartition(7), odd, "toxic", 50).collect())
    assert first == again and len(first) == 50
