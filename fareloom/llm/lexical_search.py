"""Ranked lexical search with bags scored once.

The terms of the items are the vocabulary. A document is reduced to its bag: how
often it holds each term of the vocabulary, and the length norm m. Documents with
equal bags and m form a class: they meet under a hash, and their bags are compared.
A class is scored once against all items, and its members are named in ascending order
of their ids, of which only as many are kept as an item can return.

Items are taken in groups that fit a task; a group's vocabulary and postings go to all
tasks. Inside a task, a block of items is a small matrix (terms x items), and the
scores of some classes are sums of its rows.
"""

from __future__ import annotations

import functools
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fareloom.llm.common import LOWER, by_chunks, id_and_text, ship, stored

# Bytes of items that are searched for in one pass over the documents.
GROUP_BYTES = 8_000_000
ITEM_BYTES = 64  # that an item takes besides its text
CELLS = 2_000_000  # of a block's matrix, and of the products held at once
K = 10

# Every byte that is no letter or digit and below 0x80 parts terms.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
PARTS = bytes(b for b in range(128) if not chr(b).isalnum())
FOLD = LOWER.translate(bytes.maketrans(PARTS, b" " * len(PARTS)))


def terms_of(text: str | None) -> list[bytes]:
    """Runs of letters, digits and characters beyond ASCII; A-Z count as lower case."""
    return (text or "").encode().translate(FOLD).split()


@dataclass
class Block:
    """Some items: ``counts[place[term], item]`` says how often an item holds a term."""

    place: np.ndarray  # row of each term of the vocabulary, -1 for others
    counts: np.ndarray
    first: int


@dataclass
class Items:
    ids: list
    vocabulary: dict[bytes, int]
    bags: list[list[tuple[int, int]]]

    @classmethod
    def of(cls, rows: list[tuple]) -> Items:
        vocabulary: dict[bytes, int] = {}
        bags = []
        for _, text in rows:
            bag = Counter(terms_of(text))
            bags.append([(vocabulary.setdefault(t, len(vocabulary)), n) for t, n in bag.items()])
        return cls([item_id for item_id, _ in rows], vocabulary, bags)

    def blocks(self) -> Iterator[Block]:
        first = 0
        while first < len(self.bags):
            terms: dict[int, int] = {}
            stop = first
            while stop < len(self.bags):
                new = [t for t, _ in self.bags[stop] if t not in terms]
                if stop > first and (len(terms) + len(new)) * (stop + 1 - first) > CELLS:
                    break
                terms.update(zip(new, range(len(terms), len(terms) + len(new)), strict=True))
                stop += 1
            counts = np.zeros((len(terms), stop - first), np.int64)
            for i, bag in enumerate(self.bags[first:stop]):
                for term, n in bag:
                    counts[terms[term], i] = n
            place = np.full(len(self.vocabulary), -1)
            place[list(terms)] = list(terms.values())
            yield Block(place, counts, first)
            first = stop


def local_bags(docs: DataFrame, vocabulary: dict[bytes, int], k: int) -> DataFrame:
    """Bags (n, docs, ids, terms, tfs) of documents with terms; equal ones that lie near
    each other are one row with their number and the ``k`` smallest ids."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    ints = pa.list_(pa.int32())

    def run(batches):
        known = shared.value
        width = max(1, len(known))
        for batch in batches:
            for piece in by_chunks(batch, "text"):
                parted = [terms_of(t) for t in piece.column(1).to_pylist()]
                n = np.fromiter(map(len, parted), np.int64, len(parted))
                words = chain.from_iterable(parted)
                number = np.fromiter(map(known.get, words, repeat(-1)), np.int64, n.sum())
                doc = np.repeat(np.arange(len(n)), n)
                hit = number >= 0
                pairs, tf = np.unique(doc[hit] * width + number[hit], return_counts=True)
                terms, tf = (pairs % width).astype(np.int32), tf.astype(np.int32)
                edges = np.searchsorted(pairs, np.arange(len(n) + 1) * width)
                found: dict[tuple, list] = {}
                for i, doc_id in enumerate(piece.column(0).to_pylist()):
                    if n[i]:
                        own = slice(edges[i], edges[i + 1])
                        key = (int(n[i]), terms[own].tobytes(), tf[own].tobytes())
                        found.setdefault(key, []).append(doc_id)
                ids = [sorted(x for x in own if x is not None)[:k] for own in found.values()]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([key[0] for key in found], pa.int64()),
                        pa.array(list(map(len, found.values())), pa.int64()),
                        pa.array(ids, pa.list_(pa.int64())),
                        pa.array([np.frombuffer(key[1], np.int32) for key in found], ints),
                        pa.array([np.frombuffer(key[2], np.int32) for key in found], ints),
                    ],
                    ["n", "docs", "ids", "terms", "tfs"],
                )

    schema = "n long, docs long, ids array<long>, terms array<int>, tfs array<int>"
    return stored(docs.mapInArrow(run, schema), "bags")


def bag_classes(bags: DataFrame, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """(m, terms, tfs, ids): each different bag and m once, with its ``k`` smallest ids."""
    key = ["hash", "m", "terms", "tfs"]
    named = (
        bags.filter((F.size("ids") > 0) & (F.size("terms") > 0))
        .withColumn("m", F.expr(f"25 + (75 * n * {n_docs}L) div {n_terms}L"))
        .withColumn("hash", F.xxhash64("m", "terms", "tfs"))
    )
    # The smallest ids of a class are among the rows with the smallest first ids. Each
    # task hands on ``k`` rows of a class at most.
    place = F.row_number().over(Window.partitionBy(*key).orderBy(F.col("ids")[0]))
    return (
        named.withColumn("place", place)
        .filter(F.col("place") <= k)
        .groupBy(*key)
        .agg(F.slice(F.array_sort(F.flatten(F.collect_list("ids"))), 1, k).alias("ids"))
        .select("m", "terms", "tfs", "ids")
    )


class Best:
    """The ``k`` best (score, document) of each item so far."""

    def __init__(self, n_items: int, k: int):
        self.k = k
        self.rows: list[list[tuple[int, int]]] = [[] for _ in range(n_items)]
        self.least = np.ones(n_items, np.int64)  # a document needs this score

    def take(self, first: int, scores: np.ndarray, members: list[list[int]]) -> None:
        """``scores`` of classes (rows) under items (columns) from ``first`` on."""
        good = scores >= self.least[first : first + scores.shape[1]]
        for column in np.flatnonzero(good.any(axis=0)).tolist():
            own = np.flatnonzero(good[:, column])
            score = scores[own, column]
            if len(own) > self.k:  # every class has a member
                enough = score >= np.partition(score, -self.k)[-self.k]
                own, score = own[enough], score[enough]
            rows = self.rows[first + column]
            for i, s in zip(own.tolist(), score.tolist(), strict=True):
                rows += [(-s, doc_id) for doc_id in members[i]]
            rows.sort()
            del rows[self.k :]
            if len(rows) == self.k:
                self.least[first + column] = -rows[-1][0]


def scored(classes: DataFrame, items: Items, weights: np.ndarray, k: int) -> DataFrame:
    """(item, doc_id, score): the best of each task for each item."""
    shared = classes.sparkSession.sparkContext.broadcast((items, weights))

    def run(batches):
        items, weights = shared.value
        blocks = list(items.blocks())
        best = Best(len(items.ids), k)
        for batch in batches:
            lists = [batch.column(i) for i in (1, 2)]
            edges = lists[0].offsets.to_numpy().astype(np.int64)
            edges, low = edges - edges[0], edges[0]
            terms = lists[0].values.to_numpy()[low : low + edges[-1]]
            first = lists[1].offsets[0].as_py()
            tfs = lists[1].values.to_numpy()[first : first + edges[-1]].astype(np.int64)
            row = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
            m = batch.column(0).to_numpy()[row]
            worth = weights[terms] * (1_000_000_000 * tfs // (1000 * tfs + 8 * m))
            members = batch.column(3).to_pylist()
            for block in blocks:
                place = block.place[terms]
                use = np.flatnonzero(place >= 0)
                own, value, place = row[use], worth[use], place[use]
                step = max(1, CELLS // block.counts.shape[1])
                at = 0
                while at < len(use):
                    # Whole classes, about ``step`` of their terms.
                    stop = len(use)
                    if stop - at > step:
                        stop = max(
                            int(np.searchsorted(own, own[at + step])),
                            int(np.searchsorted(own, own[at], side="right")),
                        )
                    part = slice(at, stop)
                    starts = np.flatnonzero(np.diff(own[part], prepend=-1))
                    sums = np.add.reduceat(block.counts[place[part]] * value[part, None], starts)
                    chosen = own[part][starts].tolist()
                    best.take(block.first, sums, [members[i] for i in chosen])
                    at = stop
        found = [(i, d, -s) for i, rows in enumerate(best.rows) for s, d in rows]
        columns = zip(*found, strict=True) if found else ([], [], [])
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in columns], ["item", "doc_id", "score"]
        )

    return classes.mapInArrow(run, "item long, doc_id long, score long")


def search_group(docs: DataFrame, items: Items, k: int) -> DataFrame | None:
    """(item_id, rank, doc_id, score) for the items of a group."""
    bags = local_bags(docs, items.vocabulary, k)
    n_docs, n_terms = bags.agg(F.sum("docs"), F.sum(F.col("n") * F.col("docs"))).first()
    if not n_docs or not items.vocabulary:
        return None
    df = np.zeros(len(items.vocabulary), np.int64)
    held = bags.select(F.explode("terms").alias("term"), "docs").groupBy("term")
    for term, n in held.agg(F.sum("docs")).collect():  # a row for each term of the items
        df[term] = n
    weights = np.array(
        [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for n in df.tolist()], np.int64
    )
    found = scored(bag_classes(bags, n_docs, n_terms, k), items, weights, k)
    place = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), "doc_id"))
    ranked = found.withColumn("rank", place).filter(F.col("rank") <= k)
    names = docs.sparkSession.createDataFrame(
        list(enumerate(items.ids)), "item long, item_id long"
    )
    return ranked.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


def ranked_search(
    docs: DataFrame,
    items: DataFrame,
    k: int = K,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """item_id, rank (from 1), doc_id and score of the ``k`` best documents of each item.

    With N documents that hold a term, L terms in all, n in a document (with repeats), df
    documents with a term and tf occurrences in one, a term weighs
    floor(1000 ln((2N + 2) / (2 df + 1))), m is 25 + (75 n N) div L, and the score sums
    weight * ((10^9 tf) div (1000 tf + 8 m)) over the terms of the item, repeats
    included. Documents with score 0 are not returned; equal scores go by ascending id.

    Null and empty texts hold no term. A document with a null id counts in N, L and df
    but cannot be returned. Repeated document rows count one by one. An item without
    terms gives no row; items that agree in id and text are one, those that agree in id
    alone each give their rows; a null item id stays null. Empty tables give an empty
    result. Only the named columns are read. Items are collected in groups of about
    ``GROUP_BYTES``, each of which takes a pass over the documents; only a single
    longer item goes beyond.
    """
    spark = docs.sparkSession
    ship(spark)
    own = id_and_text(docs, id_col, text_col)
    asked = items.select(
        F.col(item_id_col).cast("long").alias("item_id"), F.col(item_text_col).alias("text")
    )
    asked = asked.filter(F.col("text").rlike(TERM)).distinct()
    size = asked.agg(F.sum(F.octet_length("text") + ITEM_BYTES)).first()[0] or 0
    groups = max(1, math.ceil(size / GROUP_BYTES))
    group = F.pmod(F.xxhash64("item_id", "text"), F.lit(groups))
    parts = []
    for number in range(groups):
        rows = sorted(map(tuple, asked.filter(group == number).collect()), key=repr)
        part = search_group(own, Items.of(rows), k)
        if part is not None:
            parts.append(part)
    if not parts:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return functools.reduce(DataFrame.union, parts)
