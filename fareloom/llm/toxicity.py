"""Toxicity by cumulative-link ordinal regression on sparse text features.

A document's features count its different words that carry a mark: a word, or the
first letters of one. Severity grades are 0 for documents not labelled toxic, and
1 to ``GRADES`` for labelled ones by how many of their words are marked. The model
P(grade > k) = sigmoid(w x - t_k) shares the weights ``w`` across the ordered
thresholds t_0 < t_1 < ...; the expected grade is the sum of these probabilities.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.llm.common import WORD, by_chunks, id_and_text, map_texts, number_of, numbered

GRADES = 3
PREFIXES = (4, 5, 6)
MAX_MARKS = 4096  # marks in a model
MIN_DOCUMENTS = 3  # labelled toxic documents that hold a mark
MIN_SHARE = 200
MIN_LIFT = 10  # times as frequent in toxic documents as in others, with 1 added to these
EDGES = ".,;:!?\"'()[]{}<>|#*$%&-_"
WORDS_NEEDED = 3  # marked words that the choice of marks seeks in a toxic document
PRIOR_WEIGHT = 1.5  # of a mark before the fit
MAX_WORDS = 100_000  # word weights kept by a task

SCHEMA = "doc_id long, n_marked long, p_toxic double, severity double, grade int, rejected boolean"


def marks_of(word: str) -> list[str]:
    """A word in lower case without punctuation around it, and its beginnings."""
    bare = word.strip(EDGES).lower()
    if not bare:
        return []
    return [bare, *(f"{bare[:n]}-" for n in PREFIXES if len(bare) > n)]


@dataclass
class SeverityModel:
    weights: dict[str, float] = field(default_factory=dict)
    thresholds: tuple[float, ...] = ()
    _known: dict = field(default_factory=dict, repr=False, compare=False)

    def __getstate__(self):
        return {"weights": self.weights, "thresholds": self.thresholds, "_known": {}}

    def weight(self, word: str) -> tuple[float, bool]:
        """Sum of the weights of a word's marks, and whether it has one above 0."""
        known = self._known.get(word)
        if known is None:
            own = [self.weights[m] for m in marks_of(word) if m in self.weights]
            if len(self._known) > MAX_WORDS:
                self._known.clear()
            known = self._known[word] = (math.fsum(own), math.fsum(own) > 0)
        return known

    def score(self, text: str | None) -> tuple[int, float, float, int]:
        """Marked words, probability of any grade above 0, expected and likeliest grade."""
        found = [self.weight(w) for w in set(WORD.findall(text or ""))]
        if not self.thresholds:
            return 0, 0.0, 0.0, 0
        link = math.fsum(x for x, _ in found)
        above = [1 / (1 + math.exp(min(700.0, t - link))) for t in self.thresholds]
        grade = sum(p >= 0.5 for p in above)
        return sum(marked for _, marked in found), above[0], math.fsum(above), grade


def fit_cumulative_link(
    x: np.ndarray, rows: np.ndarray, columns: np.ndarray, grades: np.ndarray,
    prior: np.ndarray, levels: int, rounds: int = 600, ridge: float = 1e-4,
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds by gradient steps with momentum (Adam).

    ``x`` at (``rows``, ``columns``) is the sparse design matrix. Weights start at
    ``prior`` and are drawn to it. The thresholds are the first one plus positive
    gaps, so they stay in order.
    """
    n, width = len(grades), len(prior)
    weights = prior
    share = np.clip([(grades > k).mean() for k in range(levels)], 1 / (n + 1), 1 - 1 / (n + 1))
    start = np.maximum.accumulate(np.log((1 - share) / share) + 1e-3 * np.arange(levels))
    free = np.concatenate([start[:1], np.log(np.maximum(np.diff(start), 1e-2))])
    params = np.concatenate([weights, free])
    first, second = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, rounds + 1):
        weights, free = params[:width], params[width:]
        gaps = np.exp(free[1:])
        thresholds = free[0] + np.concatenate([[0.0], np.cumsum(gaps)])
        link = np.bincount(rows, x * weights[columns], n)
        above = 1 / (1 + np.exp(np.clip(thresholds - link[:, None], -700, 700)))
        # Likelihood of the grade: P(> g - 1) - P(> g).
        bounded = np.concatenate([np.ones((n, 1)), above, np.zeros((n, 1))], axis=1)
        at = np.arange(n)
        upper, lower = bounded[at, grades], bounded[at, grades + 1]
        mass = np.maximum(upper - lower, 1e-12)
        slope = bounded * (1 - bounded)
        d_link = -(slope[at, grades] - slope[at, grades + 1]) / mass / n
        d_threshold = np.zeros(levels)
        np.add.at(d_threshold, grades[grades > 0] - 1, (slope[at, grades] / mass / n)[grades > 0])
        inner = grades < levels
        np.add.at(d_threshold, grades[inner], -(slope[at, grades + 1] / mass / n)[inner])
        tail = np.cumsum(d_threshold[::-1])[::-1]
        gradient = np.concatenate([
            np.bincount(columns, x * d_link[rows], width) + ridge * (weights - prior),
            tail[:1], tail[1:] * gaps,
        ])
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        params = params - 0.05 * (first / (1 - 0.9**step)) / (
            np.sqrt(second / (1 - 0.999**step)) + 1e-8
        )
    free = params[width:]
    return params[:width], free[0] + np.concatenate([[0.0], np.cumsum(np.exp(free[1:]))])


def covering(rows: np.ndarray, columns: np.ndarray, labels: np.ndarray, width: int) -> list[int]:
    """Marks that together give every toxic document ``WORDS_NEEDED`` marked words.

    The mark that helps most documents still in need comes next, less those that it
    finds in other documents, until none helps ``MIN_DOCUMENTS`` or one in
    ``MIN_SHARE`` of the toxic ones. Words that only
    stand beside a telling one, as in copies of one text, are thus not taken.
    """
    toxic = labels[rows] == 1
    cost = np.bincount(columns[~toxic], minlength=width)
    rows, columns = rows[toxic], columns[toxic]
    order = np.argsort(columns, kind="stable")
    rows, columns = rows[order], columns[order]
    edge = np.searchsorted(columns, np.arange(width + 1))
    need = np.full(len(labels), WORDS_NEEDED)
    least = max(MIN_DOCUMENTS, (labels == 1).sum() / MIN_SHARE)
    chosen: list[int] = []
    while True:
        gain = np.bincount(columns[need[rows] > 0], minlength=width) - cost
        gain[chosen] = 0
        best = int(np.argmax(gain))
        if gain[best] < least:
            return chosen
        chosen.append(best)
        np.subtract.at(need, rows[edge[best] : edge[best + 1]], 1)


def telling_marks(sample: DataFrame, limit: int = MAX_MARKS) -> list[str]:
    """The marks most tied to the label, by their chi-square; at most ``limit``."""

    def per_batch(batches):
        for batch in batches:
            for piece in by_chunks(batch, "text"):
                marks, labels = [], []
                for text, label in zip(
                    piece.column(0).to_pylist(), piece.column(1).to_pylist(), strict=True
                ):
                    own = {m for w in set(WORD.findall(text)) for m in marks_of(w)}
                    marks += own
                    labels += [label] * len(own)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(marks, pa.string()), pa.array(labels, pa.int32())], ["mark", "label"]
                )

    sizes = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not clean:
        return []
    held = (
        sample.select("text", "label")
        .mapInArrow(per_batch, "mark string, label int")
        .groupBy("mark")
        .agg(F.sum("label").alias("a"), F.count("*").alias("n"))
        .filter(F.col("a") >= MIN_DOCUMENTS)
    )
    total = toxic + clean
    a, b = F.col("a").cast("double"), (F.col("n") - F.col("a")).cast("double")
    c, d = toxic - a, clean - b
    chi = total * (a * d - b * c) ** 2 / ((a + b) * (c + d) * toxic * clean + 1e-9)
    best = (
        held.withColumn("chi", chi)
        .filter((F.col("chi") > 20) & (a * clean > MIN_LIFT * (b + 1) * toxic))
        .orderBy(F.desc("chi"), F.desc(F.length("mark")), "mark")
        .limit(limit)
    )
    return [r["mark"] for r in best.select("mark").collect()]


def fit_severity(sample: DataFrame, grades: int = GRADES) -> SeverityModel:
    """Model fitted on ``sample`` (doc_id, text, label 0 or 1), a bounded table.

    Without documents of both labels, or without a telling mark, the model has no
    thresholds and finds nothing toxic.
    """
    marks = telling_marks(sample)
    if not marks:
        return SeverityModel()
    number = {m: i for i, m in enumerate(marks)}

    def per_batch(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in by_chunks(batch, "text"):
                found = []
                for text in piece.column(1).to_pylist():
                    own = set(WORD.findall(text))
                    found.append([number[m] for w in own for m in marks_of(w) if m in number])
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column(0),
                        piece.column(2),
                        pa.array(found, pa.list_(pa.int32())),
                    ],
                    ["doc_id", "label", "found"],
                )

    table = (
        sample.select("doc_id", "text", "label")
        .mapInArrow(per_batch, "doc_id long, label int, found array<int>")
        .toArrow()
        .sort_by("doc_id")
    )
    labels = table["label"].to_numpy()
    found = table["found"].combine_chunks()
    sizes = np.diff(found.offsets.to_numpy())
    rows = np.repeat(np.arange(len(labels)), sizes)
    columns = found.flatten().to_numpy()
    chosen = covering(rows, columns, labels, len(marks))
    place = np.full(len(marks), -1)
    place[chosen] = np.arange(len(chosen))
    marks = [marks[i] for i in chosen]
    columns = place[columns]
    rows, columns = rows[columns >= 0], columns[columns >= 0]
    if not chosen:
        return SeverityModel()
    sizes = np.bincount(rows, minlength=len(labels))
    cuts = np.quantile(sizes[labels == 1], [i / grades for i in range(1, grades)])
    graded = np.where(labels == 1, 1 + np.searchsorted(cuts, sizes, side="left"), 0)
    pairs, counts = np.unique(rows * len(marks) + columns, return_counts=True)
    prior = np.full(len(marks), PRIOR_WEIGHT)
    weights, thresholds = fit_cumulative_link(
        counts.astype(float), pairs // len(marks), pairs % len(marks), graded, prior, grades
    )
    return SeverityModel(dict(zip(marks, weights.tolist(), strict=True)), tuple(thresholds.tolist()))


def severity(
    df: DataFrame, model: SeverityModel, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_marked, p_toxic, severity (expected), grade (likeliest), rejected.

    A row is rejected if grade 0 is less likely than the grades above it. Null and
    empty texts have no features; with a fitted model they get its grade for texts
    without marks. A null id stays null, repeated rows give repeated rows, an empty
    table gives an empty result; columns other than the two named are ignored.
    """

    def per_chunk(piece: pa.RecordBatch) -> pa.RecordBatch:
        rows = [model.score(t) for t in piece.column(1).to_pylist()]
        marked, p, expected, grade = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays(
            [
                piece.column(0),
                pa.array(marked, pa.int64()),
                pa.array(p, pa.float64()),
                pa.array(expected, pa.float64()),
                pa.array(grade, pa.int32()),
                pa.array([g > 0 for g in grade]),
            ],
            ["doc_id", "n_marked", "p_toxic", "severity", "grade", "rejected"],
        )

    return map_texts(id_and_text(df, id_col, text_col), per_chunk, SCHEMA)


def without_toxic(df: DataFrame, model: SeverityModel, text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that ``severity`` does not reject, with all their columns, which
    may have any names. Null and empty texts stay unless the model rejects texts without
    marks; repeated rows are judged one by one; an empty table gives an empty result."""
    rows, text = numbered(df), number_of(df, text_col)

    def run(batches):
        for batch in batches:
            for piece in by_chunks(batch, text):
                at = piece.schema.get_field_index(text)
                keep = [model.score(t)[3] == 0 for t in piece.column(at).to_pylist()]
                yield piece.filter(pa.array(keep, pa.bool_()))

    return rows.mapInArrow(run, rows.schema).toDF(*df.columns)
