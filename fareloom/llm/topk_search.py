"""Exact top-k search by inner product: columnar branch and bound.

Candidates lie in blocks, each turned into vertical layout (one row per
dimension). For a query the inner product grows one block of dimensions at a
time; what the remaining dimensions can still add is bounded by the product of
the two remaining norms, and candidates that can no longer reach the k-th best
score leave the block. No candidate is skipped without that proof.

Blocks hold vectors of similar norm. Every query searches the block of the largest
norms first; its k-th best score there is a bound that the query takes along, and
blocks whose norms cannot reach it are never sent to it.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fareloom.llm.common import stored

CANDIDATES_PER_BLOCK = 4096
QUERIES_PER_BLOCK = 1024
DIMENSIONS_PER_STEP = 8
BANDS_PER_DOUBLING = 4  # norms within a band differ by 19 % at most
EXACT = 2.0**53  # integers below it are exact as doubles
HIGH = 400  # larger vectors are halved so often that no product overflows
# Scores beyond 64 bits are ordered by their bytes, all positive after this is added.
OFFSET, OFFSET_BYTES = 1 << 2303, 288
LOWEST, HIGHEST = -(1 << 63), (1 << 63) - 1

SCHEMA = "query_id long, query_key long, vec_id long, score long, beyond binary"


def usable(vector: Column) -> Column:
    """Neither null nor with a null, NaN or infinite component."""
    return F.coalesce(
        F.forall(
            vector,
            lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))),
        ),
        F.lit(False),
    )


def matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors as rows of doubles; short ones end in zeros."""
    lists = column.combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(sizes), width))
    out[np.arange(width) < sizes[:, None]] = lists.flatten().to_numpy()
    return out


def lowered(rows: np.ndarray, scale: int) -> tuple[np.ndarray, int]:
    """``floor(scale * x)`` as doubles, halved as often as the second result says."""
    shift = max(0, math.frexp(np.abs(rows).max(initial=0.0))[1] - HIGH)
    with np.errstate(over="ignore"):
        whole = np.floor(rows * scale)
    if shift:
        whole = np.where(
            np.isfinite(whole), np.ldexp(whole, -shift), np.ldexp(rows, -shift) * scale
        )
    return whole, shift


def integers(vector: np.ndarray, scale: int) -> list[int]:
    """``floor(scale * x)`` of every component."""
    return [
        math.floor(x * scale) if math.isfinite(x * scale) else int(x) * scale
        for x in vector.tolist()
    ]


class Block:
    """Candidates in vertical layout, dimensions with most mass first."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, scale: int):
        order = np.argsort(ids, kind="stable")
        self.ids, self.raw, self.scale = ids[order], rows[order], scale
        whole, self.shift = lowered(self.raw, scale)
        self.most = np.abs(whole).max(initial=0.0)
        self.dimensions = np.argsort(-(whole**2).sum(axis=0), kind="stable")
        self.columns = np.ascontiguousarray(whole[:, self.dimensions].T)
        self.steps = list(range(0, len(self.columns), DIMENSIONS_PER_STEP))
        # Norm of what is left after each step, rounded up a little.
        left = np.cumsum(self.columns[::-1] ** 2, axis=0)[::-1]
        zero = np.zeros((1, len(ids)))
        self.left = np.sqrt(np.concatenate([left, zero])) * (1 + 1e-9)

    def search(
        self, vector: np.ndarray, own: int, k: int, least: int | None = None
    ) -> tuple[np.ndarray, list[int]]:
        """Ids and scores of the k best, ties to the smaller id; of those below ``least``,
        which the query has found k times elsewhere, any may be missing."""
        query, shift = lowered(vector[None, :], self.scale)
        query, shift = query[0][self.dimensions], shift + self.shift
        width = len(query)
        exact = not shift and self.most * np.abs(query).max(initial=0.0) * width < EXACT
        rest = np.sqrt(np.concatenate([np.cumsum(query[::-1] ** 2)[::-1], [0.0]])) * (1 + 1e-9)
        floor = -math.inf
        if least is not None and least > LOWEST:
            floor = math.ldexp(math.nextafter(float(least), -math.inf), -shift)
        alive = np.flatnonzero(self.ids != own)
        score = np.zeros(len(alive))
        # What sums of rounded products may be off.
        slack = np.zeros(len(alive))
        if not exact:
            slack = self.left[0][alive] * rest[0] * (width + 8) * 2.0**-52
        for start in [*self.steps, width]:
            stop = min(start + DIMENSIONS_PER_STEP, width)
            if start < stop:
                part = self.columns[start:stop]
                if len(alive) < len(self.ids):
                    part = part[:, alive]
                score += query[start:stop] @ part
            spread = rest[stop] * self.left[stop][alive] + slack
            sure = floor
            if len(alive) > k:
                # The k-th best of what every candidate reaches for sure.
                sure = max(sure, np.partition(score - spread, -k)[-k])
            stay = score + spread >= sure
            if not stay.all():
                alive, score, slack = alive[stay], score[stay], slack[stay]
        if exact:
            best = np.argsort(-score, kind="stable")[:k]  # ids ascend within ties
            return self.ids[alive[best]], [int(x) for x in score[best]]
        asked = integers(vector, self.scale)
        found = [
            sum(a * b for a, b in zip(asked, integers(self.raw[i], self.scale), strict=True))
            for i in alive
        ]
        best = sorted(range(len(alive)), key=lambda i: -found[i])[:k]
        return self.ids[alive[best]], [found[i] for i in best]


def beyond(score: int) -> bytes | None:
    """What orders a score that does not fit 64 bits; null for those that do."""
    if LOWEST < score <= HIGHEST:
        return None
    return (score + OFFSET).to_bytes(OFFSET_BYTES, "big")


def search_pair(k: int, scale: int):
    def run(key, candidates: pa.Table, queries: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], []]
        if candidates.num_rows and queries.num_rows:
            width = max(
                (pc.max(pc.list_value_length(t["vec"])).as_py() or 0) for t in (candidates, queries)
            )
            rows, asked = matrix(candidates["vec"], width), matrix(queries["vec"], width)
            block = Block(candidates["id"].to_numpy(), rows, scale)
            owns, keys = queries["id"].to_pylist(), queries["key"].to_pylist()
            for own, key_, query, least in zip(
                owns, keys, asked, queries["least"].to_pylist(), strict=True
            ):
                ids, scores = block.search(query, own, k, least)
                out[0] += [own] * len(ids)
                out[1] += [key_] * len(ids)
                out[2] += ids.tolist()
                out[3] += scores
        longs = [pa.array(x, pa.int64()) for x in out[:3]]
        fitting = pa.array([min(max(x, LOWEST), HIGHEST) for x in out[3]], pa.int64())
        names = ["query_id", "query_key", "vec_id", "score", "beyond"]
        return pa.table([*longs, fitting, pa.array(map(beyond, out[3]), pa.binary())], names)

    return run


def norm_groups(bands: list[tuple[int, int, float]]) -> list[dict]:
    """Bands (number, rows, largest norm) put together, large norms first, to groups of at
    least a block; a group has blocks ``first`` and so on, ``parts`` of them."""
    groups: list[dict] = []
    for band, rows, norm in sorted(bands, reverse=True):
        if not groups or groups[-1]["rows"] >= CANDIDATES_PER_BLOCK:
            groups.append({"bands": [], "rows": 0, "top": norm})
        groups[-1]["bands"].append(band)
        groups[-1]["rows"] += rows
    first = 0
    for group in groups:
        group["first"] = first
        group["parts"] = math.ceil(group["rows"] / CANDIDATES_PER_BLOCK)
        first += group["parts"]
    return groups


def blocks_to_ask(queries: DataFrame, groups: list[dict]) -> DataFrame:
    """``queries`` with the number c of each block that may reach their bound; the block
    0, which has given the bound, is not among them."""
    listed = F.array(
        *(
            F.struct(
                F.lit(g["top"]).alias("top"),
                F.lit(max(1, g["first"])).alias("first"),
                F.lit(g["first"] + g["parts"] - 1).alias("last"),
            )
            for g in groups
            if g["first"] + g["parts"] > 1
        )
    )
    reach = F.col("norm") * F.col("g.top") * (1 + 1e-9)  # NaN counts as largest
    near = queries.withColumn("g", F.explode(listed)).filter(
        F.col("least").isNull() | (reach >= F.col("least").cast("double"))
    )
    return near.withColumn("c", F.explode(F.sequence("g.first", "g.last"))).drop("g", "norm")


def top_k(
    df: DataFrame,
    is_query: Column,
    k: int = 5,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    scale: int = 256,
) -> DataFrame:
    """The k rows of ``df`` with the largest inner product for each query row.

    Components become ``floor(scale * x)``. ``is_query`` marks the queries; it may
    name columns of ``df``. Candidates are all rows but those with the query's id.
    Columns: query_id, rank (from 1), vec_id, score; ties go to the smaller vec_id.

    Rows with a null id, a null vector or a null or non-finite component take no
    part. Missing components of a shorter vector count as 0, so an empty vector
    scores 0. Repeated candidate rows count one by one; query rows with the
    same id each give k rows if their vectors differ, and one set if they are equal. An
    empty table, or one without queries, gives an empty result. Scores are exact
    integers of any size in the ranking; one that does not fit 64 bits is shown as the
    nearest that does. ``scale`` is a power of two.

    Queries and candidates meet as blocks of bounded size, one task per pair of
    blocks that can hold a result; every pair returns k rows for each of its queries.
    """
    if scale < 1 or scale & (scale - 1):
        raise ValueError("scale must be a power of two")

    def component(x: Column) -> Column:
        # Equal integers become equal doubles; from 2**52 on all doubles are integers.
        x = x.cast("double")
        small = F.abs(x * scale) < 2.0**52
        return F.when(small, F.floor(x * scale).cast("double") / scale).otherwise(x) + F.lit(0.0)

    clean = df.filter(usable(F.col(vec_col)) & F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"),
        F.transform(vec_col, component).alias("vec"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    )
    squares = F.aggregate("vec", F.lit(0.0), lambda total, x: total + (x * scale) * (x * scale))
    clean = clean.withColumn("norm", F.sqrt(squares) * (1 + 1e-9))
    logs = F.coalesce(F.log2(F.least("norm", F.lit(1e300))), F.lit(0.0))
    clean = clean.withColumn("band", F.floor(logs * BANDS_PER_DOUBLING).cast("int"))
    # At most 4,000 bands, whatever the table.
    held = clean.groupBy("band").agg(
        F.count("*").alias("rows"), F.max("norm").alias("top"), F.count_if("asks").alias("asking")
    )
    bands = held.collect()
    asking = sum(r["asking"] for r in bands)
    groups = norm_groups([(r["band"], r["rows"], r["top"]) for r in bands])
    query_parts = max(1, math.ceil(asking / QUERIES_PER_BLOCK))

    layout = [(b, g["first"], g["parts"]) for g in groups for b in g["bands"]]
    layout = df.sparkSession.createDataFrame(layout, "band int, first int, parts int")
    # Repeated ids are spread by their vector as well.
    part = F.col("first") + F.pmod(F.xxhash64("id", "vec"), F.col("parts")).cast("int")
    candidates = clean.join(F.broadcast(layout), "band").select(
        "id", "vec", part.alias("c")
    )
    queries = (
        clean.filter("asks")
        .select("id", "vec", "norm", F.xxhash64("id", "vec").alias("key"))
        .dropDuplicates(["id", "vec"])
        .withColumn("q", F.pmod("key", F.lit(query_parts)).cast("int"))
    )

    def searched(candidates: DataFrame, queries: DataFrame) -> DataFrame:
        # Columns of their own for both sides, which come from one table.
        candidates, queries = (x.toDF(*x.columns) for x in (candidates, queries))
        pairs = candidates.groupBy("c", "q").cogroup(queries.groupBy("c", "q"))
        return pairs.applyInArrow(search_pair(k, scale), SCHEMA)

    order = Window.partitionBy("query_id", "query_key").orderBy(
        F.desc("score"), F.desc_nulls_last("beyond"), "vec_id"
    )

    def best(found: DataFrame) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)

    every_part = F.explode(F.sequence(F.lit(0), F.lit(query_parts - 1)))
    found = searched(
        candidates.filter("c = 0").withColumn("q", every_part),
        queries.select(
            "id", "key", "vec", F.lit(None).cast("long").alias("least"), F.lit(0).alias("c"), "q"
        ),
    )
    if groups and groups[-1]["first"] + groups[-1]["parts"] > 1:
        found = stored(found, "first-block")
        bounds = found.groupBy(F.col("query_id").alias("id"), F.col("query_key").alias("key")).agg(
            F.when(F.count("*") >= k, F.min("score")).alias("least")
        )
        asked = blocks_to_ask(queries.join(bounds, ["id", "key"], "left"), groups)
        wanted = asked.select("c", "q").distinct()
        found = found.unionByName(searched(candidates.join(wanted, "c"), asked))
    return best(found).select("query_id", "rank", "vec_id", "score")
