"""Exact Jaccard join of shingle sets by partitions of the universe.

Sets of similar size share a size band. For a band, token hashes are dealt to
segments. Two sets that link differ in at most H tokens, so if the segments'
allowances (1 for a segment that must be equal, 2 for one that may differ in one
token) add up to more than H, one segment keeps within its allowance: it is found
by the hash of its tokens, or of its tokens without one. A cost model chooses the
allowances of each band. Sets with a signature in common are candidates.

A candidate pair is compared by bitmaps first: every bit that is set in one of them only
stands for a token that is in one of the sets only, so pairs with too many such bits
cannot link. What is left is compared exactly, but never all pairs of a group: each set is
compared with the nearest of those before it, what links is one component, and only
sets of one signature in different components are looked at again: each set
with its ``NEAREST`` rivals, and with more as long as there are more, until every pair
of a signature is linked, in one component, or refuted.

Allowances add up to H + 1 + z. A set may then leave out empty segments, which say
nothing, as long as they are z at most: two sets that link have z + 1 segments
within their allowance, so one that both keep is among them. A set with more of
them keeps all.

Two sets differ in no more tokens if some tokens are passed over in both, so any
choice of tokens may be left out of the segments. Those that a sample of texts of
quite different sizes has in common, such as shared lines, are: they would bring
sets together that share nothing else. Comparison always takes all tokens.
"""

from __future__ import annotations

import functools
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fareloom.llm.common import (
    LOWER,
    by_chunks,
    number_of,
    numbered,
    replaced,
    splitmix,
    stored,
)
from fareloom.llm.components import connected_components
from fareloom.session import give_back

COLLISION = 20.0  # cost of a segment with one token at most, in signatures
BLOCK = 1000  # sets of a signature compared in one task, with those of another block
NEAREST, MORE = 4, 16  # rivals of a set compared at first, and times as many next
BITS_PER_TOKEN = 4
SAMPLE = 10_000  # documents in which common tokens are sought
MAX_COMMON = 50_000
SALTS = 16  # keys over which the rows of one set are dealt
MARKS = 1 << 24  # bits that say which texts are wanted again
MAX_WORDS = 150_000  # word hashes kept by a task
A, B, C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


@dataclass(frozen=True)
class Rule:
    """Shingles of ``words`` words; sets link at ``num / den`` or above."""

    words: int = 3
    num: int = 90
    den: int = 100

    def link(self, same: int, a: int, b: int) -> bool:
        return self.den * same >= self.num * (a + b - same)

    @property
    def far_bands(self) -> int:
        """Bands between sizes of which one is about twice the other."""
        return max(3, math.ceil(math.log(2) / math.log(self.den / self.num)))

    def most_different(self, a: int, b: int) -> int:
        """Tokens in one of two linked sets only, at most."""
        return (self.den - self.num) * (a + b) // (self.den + self.num)


@functools.cache
def band_starts(rule: Rule, upto: int) -> tuple[int, ...]:
    """Smallest sizes of the bands: linked sets lie in one band or in neighbours."""
    starts = [1]
    while starts[-1] <= upto:
        starts.append(max(starts[-1] + 1, -(-starts[-1] * rule.den // rule.num)))
    return tuple(starts)


@dataclass(frozen=True)
class Scheme:
    equal: int  # segments that must be equal
    loose: int  # segments that may differ in one token
    spare: int  # weak segments that may be left out


@functools.cache
def scheme(rule: Rule, low: int, high: int) -> Scheme:
    """The cheapest segments for sets of up to ``high`` tokens, ``low`` and more."""
    need = rule.most_different(high, high) + 1
    size = (low + high) / 2
    best = None
    for loose in range(0, min(3, need // 2) + 1):
        exact = need - 2 * loose
        spare = 0
        while exact:
            mean = size / (exact + spare + 2 * loose)
            weak = (exact + spare) * math.exp(-mean)
            if spare >= min(weak + 3 * math.sqrt(weak), need):
                break
            spare += 1
        width = exact + spare + 2 * loose
        mean = size / width
        weak = (exact + spare) * math.exp(-mean) * (1 + mean)
        weak += loose * math.exp(-2 * mean) * (1 + 2 * mean)
        cost = exact + spare + loose * (1 + 2 * mean) + COLLISION * weak / width
        if best is None or cost < best[0]:
            best = (cost, Scheme(exact + spare, loose, spare))
    return best[1]


def band_of(size: int, rule: Rule) -> tuple[int, tuple[int, ...]]:
    starts = band_starts(rule, 1 << max(4, (size * 2).bit_length()))
    return int(np.searchsorted(starts, size, side="right")) - 1, starts


def signatures(tokens: np.ndarray, rule: Rule, common: np.ndarray) -> np.ndarray:
    """Signatures of a set under the schemes of its band and the next larger one.

    ``common`` holds the tokens to pass over, in order."""
    band, starts = band_of(len(tokens), rule)
    if len(common):
        at = np.minimum(np.searchsorted(common, tokens), len(common) - 1)
        tokens = tokens[common[at] != tokens]
    out = []
    for number in (band, band + 1):
        own = scheme(rule, starts[max(number - 1, 0)], starts[number + 1] - 1)
        seed = splitmix(np.array([number], np.uint64))[0]
        mixed = splitmix(tokens ^ seed)
        slot = (mixed >> np.uint64(33)) % np.uint64(own.equal + 2 * own.loose)
        slot = slot.astype(np.int64)
        segment = np.where(slot < own.equal, slot, own.equal + (slot - own.equal) // 2)
        value = splitmix(mixed)
        total = np.zeros(own.equal + own.loose, np.uint64)
        np.add.at(total, segment, value)
        held = np.bincount(segment, minlength=len(total))
        name = splitmix(np.arange(len(total), dtype=np.uint64) + seed)
        keep = np.ones(len(total), bool)
        weak = held[: own.equal] == 0
        if weak.sum() <= own.spare:
            keep[: own.equal] = ~weak
        out.append(splitmix(total + name)[keep])
        inner = segment >= own.equal
        if inner.any():
            out.append(splitmix(total[segment[inner]] - value[inner] + name[segment[inner]]))
    return np.unique(np.concatenate(out)).view(np.int64)


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > MAX_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def shingles(text: str | None, size: int, hashes: WordHashes) -> np.ndarray:
    """The set of a text, as sorted hashes: runs of ``size`` words, or all words if
    there are fewer; empty without words. A-Z count as lower case."""
    words = (text or "").encode().translate(LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    value = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    runs = max(1, len(words) - size + 1)
    total = np.zeros(runs, np.uint64)
    for i in range(min(size, len(words))):
        total = splitmix(total * A + value[i : i + runs] + B)
    if len(words) < size:
        total = splitmix(total + C * np.uint64(len(words)))
    return np.unique(total)


def set_key(tokens: np.ndarray) -> int:
    key = splitmix(splitmix(tokens ^ C).sum(keepdims=True) + np.uint64(len(tokens)))
    return int(key.view(np.int64)[0])


def common_tokens(docs: DataFrame, rule: Rule) -> np.ndarray:
    """At most ``MAX_COMMON`` tokens that texts of quite different sizes share, from
    about ``SAMPLE`` documents chosen by the hash of their text."""
    n = docs.count()
    share = F.pmod(F.xxhash64("text_hash"), F.lit(1 << 20)) * n < SAMPLE * (1 << 20)

    def run(batches):
        hashes = WordHashes()
        for batch in batches:
            for piece in by_chunks(batch, "text"):
                sets = [shingles(t, rule.words, hashes) for t in piece.column(0).to_pylist()]
                bands = [np.full(len(x), band_of(len(x), rule)[0]) for x in sets]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(sets).view(np.int64)), pa.array(np.concatenate(bands))],
                    ["token", "band"],
                )

    rows = (
        docs.filter(share)
        .select("text")
        .mapInArrow(run, "token long, band long")
        .groupBy("token")
        .agg(F.max("band") - F.min("band").alias("spread"), F.count("*").alias("n"))
        .toDF("token", "spread", "n")
        .filter(F.col("spread") >= rule.far_bands)
        .orderBy(F.desc("n"), "token")
        .limit(MAX_COMMON)
        .select("token")
        .toArrow()
    )
    return np.sort(rows["token"].to_numpy().view(np.uint64))


def bitmap(tokens: np.ndarray) -> bytes:
    """Bits that the tokens set, so many that most tokens have one of their own."""
    size = 1 << max(6, (BITS_PER_TOKEN * len(tokens) - 1).bit_length())
    bits = np.zeros(size, bool)
    bits[tokens & np.uint64(size - 1)] = True
    return np.packbits(bits).tobytes()


def folded(bits: bytes, size: int) -> np.ndarray:
    """The bitmap of ``size`` bytes that the same tokens set."""
    return np.bitwise_or.reduce(np.frombuffer(bits, np.uint64).reshape(-1, size // 8))


def signed_sets(df: DataFrame, rule: Rule, common: np.ndarray) -> tuple[DataFrame, str]:
    """doc_id, text_hash, n, key, signatures and bits per row, written to the shared folder,
    and the place there.

    A set's signatures and bitmap are given once per partition, so copies add one row for
    each partition at most.
    """

    def run(batches):
        hashes, seen = WordHashes(), set()
        for batch in batches:
            for piece in by_chunks(batch, "text"):
                sizes, keys, found, bits = [], [], [], []
                for text in piece.column(2).to_pylist():
                    tokens = shingles(text, rule.words, hashes)
                    key = set_key(tokens)
                    sizes.append(len(tokens))
                    keys.append(key)
                    new = len(tokens) > 0 and key not in seen
                    found.append(signatures(tokens, rule, common) if new else np.zeros(0, np.int64))
                    bits.append(bitmap(tokens) if new else None)
                    seen.add(key)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.concatenate(([0], np.cumsum([len(x) for x in found]))), pa.int32()),
                    pa.array(np.concatenate(found)),
                )
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), piece.column(1), pa.array(sizes, pa.int64()),
                     pa.array(keys, pa.int64()), lists, pa.array(bits, pa.binary())],
                    ["doc_id", "text_hash", "n", "key", "signatures", "bits"],
                )

    schema = "doc_id long, text_hash long, n long, key long, signatures array<long>, bits binary"
    folder: list[str] = []
    signed = df.select("doc_id", "text_hash", "text").mapInArrow(run, schema)
    return replaced(signed, "signed", folder), folder[0]


def sharing(signed: DataFrame) -> DataFrame:
    """(s, key, before): sets that share a signature, and the one before in each.

    Signatures that the same sets share are one: ``s`` is a hash of these sets. (Of equal
    hashes by chance the sets are looked at together.)"""
    rows = signed.select(F.explode("signatures").alias("s"), "key")
    ordered = Window.partitionBy("s").orderBy("key")
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    placed = rows.select(
        "s", "key",
        F.lag("key").over(ordered).alias("before"),
        (F.first("key").over(whole) != F.last("key").over(whole)).alias("shared"),
    )
    # A set comes once from every partition that holds it.
    held = placed.filter("shared AND (before IS NULL OR before <> key)")
    of_sets = F.bit_xor(F.xxhash64("key")).over(Window.partitionBy("s"))
    return held.select(of_sets.alias("s"), "key", "before").distinct()


def with_sets(pairs: DataFrame, sets: DataFrame, *columns: str) -> DataFrame:
    """Pairs (a, b) with ``columns`` of both sets, named after the side."""
    for side in ("a", "b"):
        own = sets.select(F.col("key").alias(side), *(F.col(c).alias(f"{c}_{side}") for c in columns))
        pairs = pairs.join(own, side)
    return pairs


def nearest_before(members: DataFrame, bits: DataFrame, rule: Rule) -> DataFrame:
    """(a, b): of the sets before ``a`` in a signature the one that its bitmap is nearest
    to, if the bitmaps let the two link."""

    def run(batches):
        for batch in batches:
            found = []
            for a, b, n, x, m, y in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                size = min(len(x), len(y))
                distance = int(np.bitwise_count(folded(x, size) ^ folded(y, size)).sum())
                if distance <= rule.most_different(n, m):
                    found.append((a, b, distance))
            columns = zip(*found, strict=True) if found else ([], [], [])
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], ["a", "b", "distance"]
            )

    pairs = members.filter("before IS NOT NULL").select(
        F.col("key").alias("a"), F.col("before").alias("b")
    )
    met = with_sets(pairs.distinct(), bits, "n", "bits")
    met = met.select("a", "b", "n_a", "bits_a", "n_b", "bits_b")
    near = met.mapInArrow(run, "a long, b long, distance long")
    return near.groupBy("a").agg(F.min_by("b", F.struct("distance", "b")).alias("b"))


def compared(pairs: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """(a, b, linked) of pairs (a, b), by all tokens; written to the shared folder."""

    def run(batches):
        for batch in batches:
            linked = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                linked.append(rule.link(len(np.intersect1d(x, y, True)), len(x), len(y)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(linked, pa.bool_())],
                ["a", "b", "linked"],
            )

    met = with_sets(pairs, sets, "tokens").select("a", "b", "tokens_a", "tokens_b")
    return stored(met.mapInArrow(run, "a long, b long, linked boolean"), "compared")


def rivals_of(group: list[tuple], i: int, j: int, rule: Rule, limit: int) -> list[tuple]:
    """Pairs (a, b, more) of a group in different components whose bitmaps let them link and
    that are not refuted: for each set those with its ``limit`` nearest, and whether there
    are more pairs. Rows of the group are (key, component, block, n, bits, refuted); with two
    blocks i and j a pair has one set of each.

    What links is contracted before more pairs are asked for, so a group of copies hands
    on a number of pairs that grows with its sets."""
    group.sort(key=lambda row: row[0])
    keys, parts, blocks, sizes, bits, refuted = zip(*group, strict=True)
    width = min(map(len, bits))
    maps = np.array([folded(b, width) for b in bits])
    keys, parts, blocks, sizes = (np.array(x) for x in (keys, parts, blocks, sizes))
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for k in range(len(keys) - 1):
        later = parts[k + 1 :] != parts[k]
        if i != j:
            later &= blocks[k + 1 :] != blocks[k]
        at = k + 1 + np.flatnonzero(later)
        if refuted[k] and len(at):
            at = at[~np.isin(keys[at], np.fromiter(refuted[k], np.int64))]
        if not len(at):
            continue
        distance = np.bitwise_count(maps[at] ^ maps[k]).sum(axis=1, dtype=np.int64)
        near = distance <= (rule.den - rule.num) * (sizes[at] + sizes[k]) // (rule.den + rule.num)
        found.append((np.full(int(near.sum()), k), at[near], distance[near]))
    if not found:
        return []
    first, second, distance = (np.concatenate(x) for x in zip(*found, strict=True))
    kept = np.zeros(len(first), bool)
    # Every pair once for each of its sets, the nearest of a set first.
    pair, own = np.tile(np.arange(len(first)), 2), np.concatenate([first, second])
    order = np.lexsort((pair, distance[pair], own))
    place = np.arange(len(order)) - np.searchsorted(own[order], own[order])
    kept[pair[order[place < limit]]] = True
    more = not kept.all()
    a, b = keys[first[kept]].tolist(), keys[second[kept]].tolist()
    return [(x, y, more) for x, y in zip(a, b, strict=True)]


def crossing(
    members: DataFrame, bits: DataFrame, labels: DataFrame, refuted: DataFrame, rule: Rule, limit: int
) -> DataFrame:
    """Pairs (a, b) of one signature that may link and lie in different components, and
    whether there are more in their group."""
    own = Window.partitionBy("s")
    block = F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")
    mixed = (
        members.join(labels, "key")
        .select(
            "s", "key", "component",
            (F.min("component").over(own) != F.max("component").over(own)).alias("mixed"),
            F.ceil(F.count("*").over(own) / BLOCK).cast("int").alias("blocks"),
        )
        .filter("mixed")
        .withColumn("block", block)
    )
    others = refuted.union(refuted.select("b", "a")).groupBy("a").agg(F.collect_set("b").alias("refuted"))
    dealt = (
        mixed.join(bits, "key")
        .join(others.withColumnRenamed("a", "key"), "key", "left")
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "s", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
            "key", "component", "block", "n", "bits", "refuted",
        )
    )

    def run(batches):
        held, group = None, []

        def pairs():
            found = rivals_of(group, *held[1:], rule, limit) if len(group) > 1 else []
            a, b, more = zip(*found, strict=True) if found else ([], [], [])
            return pa.RecordBatch.from_arrays(
                [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(more, pa.bool_())],
                ["a", "b", "more"],
            )

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[:3] != held:
                    if len(group) > 1:
                        yield pairs()
                    held, group = row[:3], []
                group.append((*row[3:8], frozenset(row[8] or ())))
        if group:
            yield pairs()

    place = ["s", "i", "j"]
    sorted_ = dealt.repartition(*place).sortWithinPartitions(*place)
    pairs_ = sorted_.mapInArrow(run, "a long, b long, more boolean")
    return pairs_.groupBy("a", "b").agg(F.max("more").alias("more"))


def marked(hashes: DataFrame) -> np.ndarray:
    """A bit for each of ``MARKS`` remainders of ``text_hash`` that occurs."""
    place = F.pmod("text_hash", F.lit(MARKS)) + 1  # bitmap functions count from 1
    rows = (
        hashes.groupBy(F.bitmap_bucket_number(place).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
        .collect()  # MARKS bits at most
    )
    bits = np.zeros((MARKS // 32_768, 4096), np.uint8)
    for row in rows:
        bits[row["bucket"] - 1] = np.frombuffer(row["bits"], np.uint8)
    return bits.ravel()


def sets_of(docs: DataFrame, bits: np.ndarray, rule: Rule) -> DataFrame:
    """(key, tokens) of the texts whose hash is marked in ``bits``, and of some more.

    Texts stay where they are: only sets are sent on, once per partition."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches):
        hashes, seen = WordHashes(), set()
        for batch in batches:
            for piece in by_chunks(batch, "text"):
                place = piece.column(0).to_numpy() % MARKS
                wanted = shared.value[place >> 3] >> (place & 7).astype(np.uint8) & 1
                keys, sets = [], []
                for i in np.flatnonzero(wanted).tolist():
                    tokens = shingles(piece.column(1)[i].as_py(), rule.words, hashes)
                    key = set_key(tokens)
                    if key not in seen:
                        seen.add(key)
                        keys.append(key)
                        sets.append(tokens.tobytes())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.int64()), pa.array(sets, pa.binary())], ["key", "tokens"]
                )

    return docs.select("text_hash", "text").mapInArrow(run, "key long, tokens binary")


def linked_sets(
    df: DataFrame, rule: Rule, id_col: str = "doc_id", text_col: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """Signed rows (doc_id, text_hash, n, key) and (node, component) of sets that share a
    signature with another."""
    docs = df.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")
    ).withColumn("text_hash", F.xxhash64("text"))
    spark = df.sparkSession
    common = common_tokens(docs, rule)
    signed, folder = signed_sets(docs, rule, common)
    members = stored(sharing(signed), "members")
    give_back(spark)
    asked = members.select("key").distinct()
    known = (
        signed.filter("bits IS NOT NULL")
        .join(asked, "key", "left_semi")
        .groupBy("key")
        .agg(F.min("n").alias("n"), F.min("bits").alias("bits"), F.min("text_hash").alias("text_hash"))
    )
    known = stored(known, "known")
    signed = replaced(signed.drop("signatures", "bits"), "signed", [folder])
    sets = sets_of(docs, marked(known), rule).groupBy("key").agg(F.min("tokens").alias("tokens"))
    sets = stored(sets.join(known.select("key"), "key", "left_semi"), "sets")
    give_back(spark)
    bits = known.select("key", "n", "bits")
    labels = known.select("key", F.col("key").alias("component"))
    held: list[str] = []
    checked = compared(nearest_before(members, bits, rule), sets, rule)
    refuted, limit = checked.filter("NOT linked").select("a", "b"), NEAREST
    more = True
    while True:
        give_back(spark)
        labels = replaced(merged(labels, checked.filter("linked")), "labels", held)
        if not more:
            return signed, labels.withColumnRenamed("key", "node")
        rivals = stored(crossing(members, bits, labels, refuted, rule, limit), "rivals")
        give_back(spark)
        checked = compared(rivals.select("a", "b"), sets, rule)
        refuted = refuted.union(checked.filter("NOT linked").select("a", "b"))
        more = not rivals.filter("more").isEmpty()
        limit *= MORE


def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (key, component) after ``links`` (a, b) between keys."""
    for side in ("a", "b"):
        own = labels.select(F.col("key").alias(side), F.col("component").alias(f"part_{side}"))
        links = links.join(own, side)
    parts = connected_components(links.select(F.col("part_a").alias("a"), F.col("part_b").alias("b")))
    parts = parts.select(F.col("node").alias("component"), F.col("component").alias("root"))
    return labels.join(parts, "component", "left").select(
        "key", F.coalesce("root", "component").alias("component")
    )


def jaccard_components(
    df: DataFrame, rule: Rule = Rule(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_shingles and component_id for every row of ``df``.

    component_id is the smallest doc_id among the rows that links lead to, the row
    itself included. Texts that are null, empty or without words have an empty set,
    which links with nothing: they are their own component. Repeated rows and rows
    with equal sets are linked. A null id stays null and is passed over for
    component_id, which is null only if all ids of a component are. An empty table
    gives an empty result. Only the two named columns are read. Sets are compared
    as 64-bit hashes of their shingles and known by a 64-bit key.
    """
    signed, components = linked_sets(df, rule, id_col, text_col)
    some, none = signed.filter("n > 0"), signed.filter("n = 0")
    keys = by_component(
        some, components, F.count("*").alias("copies"), F.min("doc_id").alias("least")
    )
    smallest = keys.groupBy("component").agg(F.min("least").alias("component_id"))
    # Rows alone with their set need no look-up; those of a set with many copies are
    # dealt out over SALTS keys.
    shared = (
        keys.join(smallest, "component")
        .filter("copies > 1 OR linked")
        .select("key", "component_id", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
        .withColumn("found", F.lit(True))
    )
    salt = F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(SALTS)).cast("int")
    rows = some.withColumn("salt", salt).join(shared, ["key", "salt"], "left")
    return rows.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("found"), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    ).union(none.select("doc_id", "n", "doc_id"))


def by_component(some: DataFrame, components: DataFrame, *measures) -> DataFrame:
    """A row per key: its component, whether it is linked, and ``measures`` of its rows."""
    keys = some.groupBy("key").agg(*measures)
    found = keys.join(components, keys["key"] == components["node"], "left")
    return found.select(
        *keys.columns,
        F.col("node").isNotNull().alias("linked"),
        F.coalesce("component", "key").alias("component"),
    )


def one_of_each(df: DataFrame, rule: Rule, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` without near copies: of each component the row with the smallest id
    (null ids last), then the smallest text hash, then the smallest hash of all columns.

    Rows without words (null, empty, spaces) all stay, repeated ones too. Of repeated
    rows with words one stays. An empty table gives an empty result. Further columns
    may have any names.
    """
    rows, id_, text = numbered(df), number_of(df, id_col), number_of(df, text_col)
    signed, components = linked_sets(rows, rule, id_, text)
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")
    keys = by_component(signed.filter("n > 0"), components, F.min(order).alias("first"))
    kept = (
        keys.groupBy("component")
        .agg(F.min("first").alias("k"))
        .select(F.col("k.doc_id").alias("kept_id"), F.col("k.text_hash").alias("kept_hash"))
    )
    wordless = ~F.coalesce(F.col(text).rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    worded = rows.filter(~wordless).select(
        F.struct(*rows.columns).alias("row"),
        F.col(id_).cast("long").alias("own_id"),
        F.xxhash64(text).alias("own_hash"),
    )
    match = F.col("own_id").eqNullSafe(F.col("kept_id")) & (F.col("own_hash") == F.col("kept_hash"))
    held = worded.join(kept, match, "left_semi").groupBy("own_id", "own_hash")
    single = held.agg(F.min_by("row", F.xxhash64("row")).alias("row"))
    return single.select("row.*").union(rows.filter(wordless)).toDF(*df.columns)
