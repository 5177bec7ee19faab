"""Quality by hierarchical empirical Bayes: document, path and host.

A logistic regression on the style of a text gives the evidence of a document.
Sites share what their documents show: a host's rate of good documents is drawn
to the global one, a path's rate to its host's, both by beta priors whose strength
is the method-of-moments estimate over all hosts, or over all paths. The posterior
of a document sets its evidence against the rate of the other documents of its
path. Rates come from grouped sums over all documents.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareloom.llm.common import SPACES, by_chunks, number_of, numbered, ship, stored

RIDGE = 1.0
LEAST_STRENGTH, MOST_STRENGTH = 1.0, 1e6  # of a prior, in documents
GROUPS = (  # bytes whose share of a text is a feature
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"!?", b"|", b"#", b"$", b"%", b"&", b"*",
    b"<>", b".", b",", b"\n", b" ", b"@/\\_=+", bytes(range(128, 256)),
)
TABLE = np.zeros((256, len(GROUPS)))
for _i, _group in enumerate(GROUPS):
    TABLE[list(_group), _i] = 1.0

SCHEMA = (
    "doc_id long, p_document double, p_host double, p_path double, p_quality double, kept boolean"
)


def style(text: str | None) -> np.ndarray:
    """Features of a text; all 0 if it has no words."""
    data = (text or "").encode()
    words = data.split()
    n = len(words)
    if not n:
        return np.zeros(len(GROUPS) + 6)
    shares = np.bincount(np.frombuffer(data, np.uint8), minlength=256) @ TABLE / len(data)
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    ends = sum(w[-1:] in b"#$%&*!|" for w in words) / n
    size = sum(map(len, words)) / n
    rest = (
        1.0,
        math.log1p(n),
        len(set(words)) / n,
        1 - len(set(lines)) / len(lines),
        math.sqrt(ends),
        math.log(size),
    )
    return np.concatenate([np.sqrt(shares), rest])


@dataclass
class QualityModel:
    """``weights`` is None without labelled rows of both kinds."""

    weights: np.ndarray | None = None
    prior: float = 0.5  # rate of good documents among the labelled ones

    def score(self, text: str | None) -> float:
        if self.weights is None:
            return 0.5
        link = float(style(text) @ self.weights)
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, link))))


def fit_quality(sample: DataFrame) -> QualityModel:
    """Logistic regression on ``sample`` (doc_id, text, label 0 or 1), a bounded table."""
    ship(sample.sparkSession)

    def run(batches):
        for batch in batches:
            for piece in by_chunks(batch, "text"):
                rows = [style(t) for t in piece.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), piece.column(2), pa.array([x.tolist() for x in rows], pa.list_(pa.float64()))],
                    ["doc_id", "label", "x"],
                )

    table = (
        sample.select("doc_id", "text", "label")
        .mapInArrow(run, "doc_id long, label int, x array<double>")
        .toArrow()
        .sort_by("doc_id")
    )
    y = table["label"].to_numpy().astype(float)
    if not len(y) or y.min() == y.max():
        return QualityModel()
    x = np.array(table["x"].to_pylist())
    spread = x.std(axis=0)
    spread[spread == 0] = 1.0
    z = x / spread
    weights = np.zeros(z.shape[1])
    for _ in range(30):  # Newton steps
        p = 1 / (1 + np.exp(-np.clip(z @ weights, -30, 30)))
        gradient = z.T @ (y - p) - RIDGE * weights
        curve = (z * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ z + RIDGE * np.eye(len(weights))
        step = np.linalg.solve(curve, gradient)
        weights += step * min(1.0, 4 / (1e-12 + np.abs(step).max()))
        if np.abs(step).max() < 1e-8:
            break
    return QualityModel(weights / spread, float(y.mean()))


def site(column: str) -> Column:
    """Null and empty names are one site."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def strength(spread: float, noise: float, mean: float, left: float) -> float:
    """Documents that a beta prior stands for, from the spread of rates around ``mean``."""
    var = max((spread - noise) / max(left, 1e-9), 1e-12)
    return min(MOST_STRENGTH, max(LEAST_STRENGTH, mean * (1 - mean) / var - 1))


def site_rates(scored: DataFrame) -> DataFrame:
    """(host, path, n, good, p_host, k_path) from (host, path, p) of all documents."""
    paths = stored(
        scored.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("p").alias("good")),
        "paths",
    )
    hosts = paths.groupBy("host").agg(F.sum("n").alias("host_n"), F.sum("good").alias("host_good"))
    n, good, host_n, host_good = (F.col(c) for c in ("n", "good", "host_n", "host_good"))
    total = hosts.agg(F.sum("host_n"), F.sum("host_good")).first()
    if not total[0]:
        return paths.select("*", F.lit(0.5).alias("p_host"), F.lit(1.0).alias("k_path"))
    mean = min(1 - 1e-6, max(1e-6, total[1] / total[0]))
    between = hosts.agg(
        F.sum(host_n * (host_good / host_n - mean) ** 2), F.count("*"), F.sum(host_n * host_n)
    ).first()
    k_host = strength(
        between[0] / total[0],
        mean * (1 - mean) * (between[1] - 1) / total[0],
        mean,
        1 - between[2] / total[0] ** 2,
    )
    rated = hosts.withColumn("p_host", (host_good + k_host * mean) / (host_n + k_host))
    known = paths.join(rated, "host")
    within = known.agg(
        F.sum(n * (good / n - host_good / host_n) ** 2),
        F.count("*") - F.count_distinct("host"),
        F.sum(n * n / host_n),
        F.sum(n * host_good / host_n * (1 - host_good / host_n)),
    ).first()
    k_path = strength(
        within[0] / total[0],
        within[3] / total[0] * within[1] / total[0],
        mean,
        1 - within[2] / total[0],
    )
    return known.select("host", "path", "n", "good", "p_host", F.lit(k_path).alias("k_path"))


def posterior(p: Column, model: QualityModel) -> tuple[Column, Column]:
    """Rate of the other documents of the path, and the document's posterior."""
    k = F.col("k_path")
    rate = (F.col("good") - p + k * F.col("p_host")) / (F.col("n") - 1 + k)
    rate = F.least(F.lit(1 - 1e-6), F.greatest(F.lit(1e-6), rate))

    def odds(x):
        return F.log(x / (1 - x))

    prior = math.log(model.prior / (1 - model.prior))
    return rate, 1 / (1 + F.exp(-(odds(p) - prior + odds(rate))))


def scored_documents(df: DataFrame, model: QualityModel, text_col: str, p_col: str) -> DataFrame:
    """``df`` with the document classifier's probability in ``p_col``."""

    def run(batches):
        for batch in batches:
            for piece in by_chunks(batch, text_col):
                at = piece.schema.get_field_index(text_col)
                p = [model.score(t) for t in piece.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*piece.columns, pa.array(p, pa.float64())], [*piece.schema.names, p_col]
                )

    ship(df.sparkSession)
    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return df.mapInArrow(run, f"{names}, `{p_col}` double")


def quality(
    df: DataFrame,
    model: QualityModel,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    path_col: str = "lang",
    cut: float = 0.5,
) -> DataFrame:
    """doc_id, p_document, p_host, p_path, p_quality and kept for every row.

    p_path is the shrunken rate of the other documents of the row's path, p_quality
    the posterior of the row; it is kept from ``cut`` on. Without a fitted model all
    rows are kept. Null and empty texts have no style features and are scored as the
    classifier scores such texts. Null and empty host or path names are one site. A
    null id stays null, repeated rows give repeated rows, an empty table gives an
    empty result; other columns are ignored.
    """
    own = df.select(
        F.col(id_col).cast("long").alias("doc_id"),
        site(host_col).alias("host"),
        site(path_col).alias("path"),
        F.col(text_col).alias("text"),
    )
    scored = stored(scored_documents(own, model, "text", "p").drop("text"), "scored")
    rate, p = posterior(F.col("p"), model)
    return scored.join(site_rates(scored), ["host", "path"]).select(
        "doc_id",
        F.col("p").alias("p_document"),
        "p_host",
        rate.alias("p_path"),
        p.alias("p_quality"),
        (p >= cut if model.weights is not None else F.lit(True)).alias("kept"),
    )


def good_documents(
    df: DataFrame,
    model: QualityModel,
    text_col: str = "text",
    host_col: str = "source",
    path_col: str = "lang",
    cut: float = 0.5,
) -> DataFrame:
    """The rows of ``df`` that ``quality`` keeps, with all their columns, which may have
    any names. Nulls, empty and repeated rows and tables count as there."""
    if model.weights is None:
        return df
    rows, text = numbered(df), number_of(df, text_col)
    rows = rows.select(
        "*",
        site(number_of(df, host_col)).alias("host"),
        site(number_of(df, path_col)).alias("path"),
    )
    own = rows.select(F.col(text).alias("text"), "host", "path")
    scored = scored_documents(own, model, "text", "p").select("host", "path", "p")
    rates = stored(site_rates(scored), "rates")
    _, p = posterior(F.col("p"), model)
    kept = scored_documents(rows, model, text, "p").join(rates, ["host", "path"]).filter(p >= cut)
    return kept.select(*numbered(df).columns).toDF(*df.columns)
