"""Language-model scores by online logistic mixing of hashed-context bit predictors.

A text is a sequence of tokens: its words in lower case, then one end. The frequent
words of the training texts and the end have a binary code of their own, short for
frequent ones; any other word is an escape in that code, then its letters (bytes and an
end of the word) in a second code. Every bit of either code is predicted. Predictors
look up how often the bit was 1 under a hashed context: for words the kind of the text,
the word before, the two words before; for letters the kind with the last two letters,
the last four, and all so far. Their log-odds are mixed with
weights that the gate of the bit selects (depth in the code, and how much the two
longest contexts have seen). The weights follow the prediction error through the
training texts in their order, each bit left out of the counts while they learn from
it. A last stage corrects the mixed probability by what was seen where the mixer gave
about that value at that depth.

The probability of an escaped word is that of its letters, mixed with its share in the
training texts by absolute discounting. These counts are never gathered: words that
have no code meet the vocabulary in a join.

The kind of a text is such as its language. Training documents have theirs in a
column, from which the frequent words of each kind are learned; then every token is
given the kind under which the frequent words before it are likeliest, so that nothing
has to be said about the kinds of a scored text and the scores of all texts add up to
no more than 1.
"""

from __future__ import annotations

import heapq
import math
import zlib
from collections import Counter
from dataclasses import dataclass
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareloom.llm.common import CHUNK_BYTES, LOWER, by_chunks, ship, splitmix, stored

FOLDS, HELD_OUT = 5, 1
END = b"\n"
CODED = 65_536  # words that have a code, the most frequent ones
CODED_TIMES = 2  # and at least this often in training texts
MIN_BITS, MAX_BITS = 16, 22  # of a table of slots; between them it grows with the tokens
SEGMENT = 65_536  # counts that travel together
SPREAD = 512  # partitions whose counts are added up first
PART_BYTES = 32_000_000  # text of a partition that counts or learns
BATCH = 8_192  # tokens or letters looked up at once
LEARN = 4_096  # of them between two steps of the weights
PREDICTORS = 3  # of a code
INPUTS = PREDICTORS + 1
DEPTHS, CONFIDENCE = 14, 4
GATES = 2 * DEPTHS * CONFIDENCE**2
RATE, SLOWER = 0.02, 50  # of the weights; it has halved after so many steps
BUCKETS, REACH = 33, 12.0  # of the last stage, over log-odds of -REACH to REACH
PRIOR = 20.0  # bits a bucket counts for itself
MAX_KINDS = 7  # most frequent kinds; the rest is one more
UNTOLD = MAX_KINDS + 1  # in place of a kind, at the first token
FREQUENT = 2_000  # words that tell the kind of a text
WORD_END = 256  # the letter after the last byte of a word
NODE, SPIN = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
FULL = 255  # a slot's larger count; beyond it both shrink alike
SEEN = np.arange(65_536)  # a slot: zeros in the lower byte, ones in the upper
LOG_ODDS = np.log(((SEEN >> 8) + 0.4) / ((SEEN & FULL) + 0.4)).astype(np.float32)
SURE = np.searchsorted([1, 4, 31], (SEEN >> 8) + (SEEN & FULL), side="right").astype(np.int8)


@dataclass
class Code:
    """A binary code: the path of each symbol as nodes and the bits taken there."""

    starts: np.ndarray
    lengths: np.ndarray
    nodes: np.ndarray
    taken: np.ndarray

    @classmethod
    def of_counts(cls, counts: list[int]) -> Code:
        """The shortest code for symbols 0, 1, ... with these counts, two at least."""
        n = len(counts)
        above, side = [0] * (2 * n - 1), [0] * (2 * n - 1)
        heap = [(max(c, 1), i) for i, c in enumerate(counts)]
        heapq.heapify(heap)
        for node in range(n, 2 * n - 1):
            (low, a), (high, b) = heapq.heappop(heap), heapq.heappop(heap)
            above[a] = above[b] = node
            side[b] = 1
            heapq.heappush(heap, (low + high, node))
        lengths, nodes, taken = [], [], []
        for at in range(n):
            path = []
            while at != 2 * n - 2:
                path.append((above[at], side[at]))
                at = above[at]
            lengths.append(len(path))
            nodes += [node for node, _ in path[::-1]]
            taken += [bit for _, bit in path[::-1]]
        sizes = np.array(lengths, np.int64)
        return cls(
            np.cumsum(sizes) - sizes, sizes, np.array(nodes, np.uint64), np.array(taken, np.int64)
        )

    def bits(self, symbols: np.ndarray):
        """(owner, depth, node, bit) of every bit of the symbols in turn."""
        sizes = self.lengths[symbols]
        owner = np.repeat(np.arange(len(symbols)), sizes)
        depth = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        at = self.starts[symbols][owner] + depth
        return owner, depth, self.nodes[at], self.taken[at]


def bits_for(n: int, v: int) -> tuple[int, ...]:
    """Bits of the tables for ``n`` training tokens, ``v`` of them different."""
    pairs, letters = (
        min(MAX_BITS, max(MIN_BITS, math.ceil(math.log2(16 * max(x, 1))))) for x in (n, v)
    )
    return (min(pairs, 20), pairs, pairs, min(letters, 20), letters, letters)


@dataclass
class Run:
    """Symbols of one code with the hashed contexts of each, and how often they occur
    together (None: once each); ``code`` 0 are words."""

    code: int
    symbols: np.ndarray
    contexts: np.ndarray
    times: np.ndarray | None = None

    def batches(self, limit: int):
        for i in range(0, len(self.symbols), limit):
            some = slice(i, i + limit)
            times = None if self.times is None else self.times[some]
            yield Run(self.code, self.symbols[some], self.contexts[:, some], times)

    def weights(self, owner: np.ndarray) -> np.ndarray:
        """How often each bit occurs, given its symbol."""
        return np.ones(len(owner), np.int64) if self.times is None else np.take(self.times, owner)

    def distinct(self) -> tuple[Run, np.ndarray]:
        """Each symbol once under the same contexts, and which of them every symbol is."""
        key = self.symbols.astype(np.uint64)
        for row in self.contexts:
            key = splitmix(key + row)
        _, first, which, times = np.unique(
            key, return_index=True, return_inverse=True, return_counts=True
        )
        order = np.argsort(first)  # as they stand in the texts
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        first = first[order]
        return Run(self.code, self.symbols[first], self.contexts[:, first], times[order]), place[which]


@dataclass
class Mixer:
    """Codes, zeros and ones that every slot saw, weights of gates, the last stage."""

    codes: tuple[Code, Code]
    table_bits: tuple[int, ...]
    counts: np.ndarray  # zeros and 256 times ones of each slot
    weights: np.ndarray
    last: np.ndarray

    @classmethod
    def empty(cls, codes: tuple[Code, Code], table_bits: tuple[int, ...]) -> Mixer:
        weights = np.full((INPUTS, GATES), 0.3, np.float32)
        weights[-1] = 0.0
        centres = np.linspace(-REACH, REACH, BUCKETS)
        last = np.tile(1 / (1 + np.exp(-centres)), 2 * DEPTHS).astype(np.float32)
        slots = sum(1 << b for b in table_bits)
        return cls(codes, table_bits, np.zeros(slots, np.uint16), weights, last)

    def slots(self, run: Run):
        """(slots of each predictor, owner, depth, bit) of the bits of a run."""
        owner, depth, node, bit = self.codes[run.code].bits(run.symbols)
        node = node * NODE
        first = run.code * PREDICTORS
        offsets = np.cumsum([0, *(1 << b for b in self.table_bits)])
        rows = np.empty((PREDICTORS, len(owner)), np.int64)
        for i in range(PREDICTORS):
            mixed = np.take(run.contexts[i], owner)
            mixed ^= node
            mixed *= SPIN
            mixed >>= np.uint64(64 - self.table_bits[first + i])
            np.add(mixed.view(np.int64), offsets[first + i], out=rows[i])
        return rows, owner, depth, bit

    def inputs(self, run: Run, less: int = 0):
        """(inputs, gate, stage, owner, bit); ``less`` 1 leaves each bit out of its counts."""
        slots, owner, depth, bit = self.slots(run)
        seen = np.take(self.counts, slots)
        if less:
            own = np.where(bit == 1, np.uint16(256), np.uint16(1))
            seen -= own * ((seen & (own * np.uint16(FULL))) > 0)
        inputs = np.ones((INPUTS, len(bit)), np.float32)
        np.take(LOG_ODDS, seen, out=inputs[:-1])
        stage = run.code * DEPTHS + np.minimum(depth, DEPTHS - 1)
        gate = stage
        for i in (PREDICTORS - 2, PREDICTORS - 1):
            gate = gate * CONFIDENCE + np.take(SURE, seen[i])
        return inputs, gate, stage, owner, bit

    def mixed(self, inputs: np.ndarray, gate: np.ndarray) -> np.ndarray:
        link = sum(np.take(self.weights[i], gate) * inputs[i] for i in range(INPUTS))
        return np.clip(link, -REACH, REACH, out=link)

    @staticmethod
    def bucket(link: np.ndarray) -> np.ndarray:
        return np.rint((link + REACH) * ((BUCKETS - 1) / (2 * REACH))).astype(np.int64)

    def learn(self, run: Run, rate: float, seen: np.ndarray) -> None:
        """One step of every gate's weights; ``seen`` counts bits and ones per bucket."""
        inputs, gate, stage, owner, bit = self.inputs(run, 1)
        weight = run.weights(owner)
        link = self.mixed(inputs, gate)
        error = weight * (bit - 1 / (1 + np.exp(-link)))
        hits = np.sqrt(np.maximum(np.bincount(gate, weight, GATES), 1))
        for i in range(INPUTS):
            self.weights[i] += rate * np.bincount(gate, error * inputs[i], GATES) / hits
        at = stage * BUCKETS + self.bucket(link)
        seen[0] += np.bincount(at, weight, seen.shape[1])
        seen[1] += np.bincount(at, weight * bit, seen.shape[1])

    def log_prob(self, run: Run) -> np.ndarray:
        """Natural logarithm of the probability of each symbol."""
        out = np.zeros(len(run.symbols))
        for start, part in zip(range(0, len(out), BATCH), run.batches(BATCH), strict=False):
            inputs, gate, stage, owner, bit = self.inputs(part)
            link = self.mixed(inputs, gate)
            p = 1 / (1 + np.exp(-link))
            p += np.take(self.last, stage * BUCKETS + self.bucket(link))
            p /= 2
            each = np.log(np.where(bit == 1, p, 1 - p))
            out[start : start + len(part.symbols)] = np.bincount(owner, each, len(part.symbols))
        return out


@dataclass
class Words:
    """Frequent words: their codes' symbols, base scores, and what they tell of kinds."""

    symbols: dict[bytes, int]
    base: np.ndarray  # log10 by add-one-half counts; the last is the escape's, 0
    known: np.ndarray
    told: np.ndarray  # log probability under each kind, in 2**-20
    prior: np.ndarray
    escaped: int  # training tokens without a code

    def tokens(self, texts: list[bytes | None]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """Tokens of all texts, each text's with its end; their symbols; texts' sizes."""
        flat, sizes = [], []
        for text in texts:
            found = (text or b"").translate(LOWER).split()
            flat += found
            flat.append(END)
            sizes.append(len(found) + 1)
        escape = len(self.symbols)
        get = self.symbols.get
        return flat, np.fromiter((get(w, escape) for w in flat), np.int64, len(flat)), np.array(sizes)

    def kinds(self, symbols: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Likeliest kind at each token, by the frequent words before it in its text."""
        starts = np.cumsum(sizes) - sizes
        held = np.where(symbols < len(self.told), symbols, len(self.told))
        best = np.full(len(symbols), UNTOLD)
        top = None
        for k in range(len(self.prior)):
            own = np.append(self.told[:, k], 0)[held]
            sums = np.cumsum(own) - own
            sums += self.prior[k] - np.repeat(sums[starts], sizes)
            if top is None:
                top, best = sums, np.zeros(len(symbols), np.int64)
            else:
                best[sums > top] = k
                top = np.maximum(sums, top)
        best[starts] = UNTOLD
        return best


def word_run(symbols: np.ndarray, kinds: np.ndarray, sizes: np.ndarray, n_coded: int) -> Run:
    """The words with the contexts of their predictors."""
    place = np.arange(len(symbols)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    one, two = (np.full(len(symbols), n_coded + 1, np.uint64) for _ in range(2))
    one[1:], two[2:] = symbols[:-1], symbols[:-2]
    one[place < 1] = two[place < 2] = n_coded + 1  # the text begins here
    kind = splitmix(kinds.astype(np.uint64))
    after = splitmix(one + np.uint64(1 << 40))
    rows = [kind, after, splitmix(after + two)]
    return Run(0, symbols, np.array(rows))


def letter_run(words: list[bytes], kinds: np.ndarray) -> tuple[Run, np.ndarray]:
    """The letters of the words, a kind for each, with their contexts; words' sizes."""
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(sizes)
    data = np.frombuffer(b"\0".join(words) + b"\0", np.uint8).astype(np.int64)[: int(sizes.sum())]
    data[ends - 1] = WORD_END
    at = np.arange(len(data)) - np.repeat(ends - sizes, sizes)
    kind = splitmix(np.repeat(kinds.astype(np.uint64), sizes))
    rows, value = [], kind
    for back in range(1, 5):
        last = np.zeros(len(data), np.uint64)
        last[back:] = data[:-back] + 1
        last[at < back] = 0  # the word begins here
        value = splitmix(value + last)
        if back in (2, 4):
            rows.append(value)
    power = np.cumprod(np.full(at.max(initial=0) + 1, 0x100000001B3, np.uint64))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[at], out=sums[1:])
    rows.append(splitmix(kind + splitmix(sums[:-1] - np.repeat(sums[ends - sizes], sizes))))
    return Run(1, data, np.array(rows)), sizes


@dataclass
class Passage:
    """Tokens of some texts: the different ones under their contexts, and which of them
    every token is; and the different escaped words under each kind."""

    flat: list[bytes]
    sizes: np.ndarray
    symbols: np.ndarray
    words: Run
    each: np.ndarray
    escaped: dict[tuple[bytes, int], int]
    which: np.ndarray  # number of the escaped word at each escape
    places: np.ndarray  # and its token
    letters: Run
    letter_sizes: np.ndarray

    @classmethod
    def of_texts(cls, texts: list[bytes | None], told: Words, past: set | None = None) -> Passage:
        """With ``past``, the escaped words in it are not spelled again; the rest goes there."""
        flat, symbols, sizes = told.tokens(texts)
        kinds = told.kinds(symbols, sizes)
        places = np.flatnonzero(symbols == len(told.symbols))
        escaped: dict[tuple[bytes, int], int] = {}
        which = [
            escaped.setdefault((flat[i], k), len(escaped))
            for i, k in zip(places.tolist(), kinds[places].tolist(), strict=True)
        ]
        fresh = list(escaped)
        if past is not None:
            fresh = [key for key in fresh if key not in past]
            past.update(fresh)
        letters, letter_sizes = letter_run(
            [w for w, _ in fresh], np.fromiter((k for _, k in fresh), np.int64, len(fresh))
        )
        run, each = word_run(symbols, kinds, sizes, len(told.symbols)).distinct()
        return cls(
            flat, sizes, symbols, run, each,
            escaped, np.array(which, np.int64), places, letters, letter_sizes,
        )


def fold(doc_id: int | None) -> int:
    """crc32 of the id as text, modulo the folds; a null id is in fold 0."""
    return 0 if doc_id is None else zlib.crc32(str(doc_id).encode()) % FOLDS


def held_out(doc_id: Column) -> Column:
    """The same rule as ``fold``."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def texts_of(batches, limit: int = CHUNK_BYTES):
    """Lists of texts as bytes, a chunk of them at a time, with the chunk."""
    for batch in batches:
        for piece in by_chunks(batch, "text", limit):
            yield piece.column("text").cast(pa.binary()).to_pylist(), piece


def with_kind(docs: DataFrame) -> tuple[DataFrame, int]:
    """``docs`` with their kind as a number below the second result."""
    training = docs.filter(~held_out(F.col("doc_id")) & F.col("kind").isNotNull())
    most = training.groupBy("kind").count().orderBy(F.desc("count"), "kind").limit(MAX_KINDS)
    names = [r["kind"] for r in most.collect()]
    number = F.lit(len(names))
    for i, name in enumerate(names):
        number = F.when(F.col("kind") == name, i).otherwise(number)
    return docs.withColumn("kind", number), len(names) + 1


def vocabulary(docs: DataFrame, kinds: int) -> DataFrame:
    """(word, c, c0, c1, ...): tokens of training documents, counted in all of them and
    in those of each kind."""

    def run(batches):
        for texts, piece in texts_of(batches):
            by_kind: dict[int, Counter] = {}
            for text, kind in zip(texts, piece.column("kind").to_pylist(), strict=True):
                counts = by_kind.setdefault(kind, Counter())
                counts.update((text or b"").translate(LOWER).split())
                counts[END] += 1
            for kind, counts in by_kind.items():
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(list(counts), pa.binary()),
                        pa.array(list(counts.values()), pa.int64()),
                        pa.array(np.full(len(counts), kind, np.int32)),
                    ],
                    ["word", "c", "kind"],
                )

    training = docs.filter(~held_out(F.col("doc_id"))).select("text", "kind")
    counted = training.mapInArrow(run, "word binary, c long, kind int")
    own = [
        F.sum(F.when(F.col("kind") == k, F.col("c")).otherwise(0)).alias(f"c{k}") for k in range(kinds)
    ]
    whole = reduce(add, (F.col(f"c{k}") for k in range(kinds)))
    return stored(counted.groupBy("word").agg(*own).withColumn("c", whole), "vocabulary")


def frequent(words: DataFrame, n: int, v: int, sizes: list[int]) -> tuple[Words, tuple[Code, Code]]:
    """The coded words, at most ``CODED`` and the end, and the codes of words and letters."""
    enough = (F.col("c") >= CODED_TIMES) & (F.col("word") != F.lit(END))
    ends = words.filter(F.col("word") == F.lit(END)).collect()
    top = ends + words.filter(enough).orderBy(F.desc("c"), "word").limit(CODED).collect()
    names, counts = [bytes(r["word"]) for r in top], [r["c"] for r in top]
    if not ends:  # no training text
        names, counts = [END], [0]
    base = [math.log10((c + 0.5) / (n + 0.5 * (v + 1))) for c in counts]
    telling = top[:FREQUENT]
    held = np.array([[r[f"c{k}"] for k in range(len(sizes))] for r in telling], float)
    held = held.reshape(len(telling), len(sizes))
    share = np.array([r["c"] for r in telling], float)[:, None] / max(n, 1)
    told = np.log((held + share) / (np.array(sizes) + 1.0))
    prior = np.log((np.array(sizes) + 1.0) / (n + len(sizes)))
    letters = [1] * (WORD_END + 1)
    for name in names[1:]:
        for byte in name:
            letters[byte] += 1
        letters[WORD_END] += 1
    found = Words(
        {w: i for i, w in enumerate(names)},
        np.array([*base, 0.0]),
        np.array([*(int(c > 0) for c in counts), 0]),
        *(np.rint(x * 2**20).astype(np.int64) for x in (told, prior)),
        n - sum(counts),
    )
    return found, (Code.of_counts([*counts, n - sum(counts)]), Code.of_counts(letters))


def dealt(docs: DataFrame, parts: int) -> DataFrame:
    """Training documents in parts and an order that follow from the documents alone."""
    key = F.xxhash64("doc_id", "text")
    training = docs.filter(~held_out(F.col("doc_id"))).select("doc_id", "text")
    return training.repartition(parts, key).sortWithinPartitions(key, "doc_id").select("text")


def slot_of(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Slots that saw so many zeros and ones; where one of them goes beyond ``FULL`` both
    shrink, and none of them to nothing."""
    over = np.maximum(np.maximum(zeros, ones) / FULL, 1)
    zeros, ones = (np.ceil(x / over - 1e-9).astype(np.uint16) for x in (zeros, ones))
    return zeros + (ones << np.uint16(8))


def pressed(counts: np.ndarray) -> bytes:
    """A segment's counts, compressed byte by byte: most have only a low one."""
    planes = counts.astype("<u4").view(np.uint8).reshape(SEGMENT, 4).T
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpressed(data: bytes) -> np.ndarray:
    planes = pa.decompress(data, 4 * SEGMENT, codec="zstd", asbytes=True)
    return np.frombuffer(planes, np.uint8).reshape(4, SEGMENT).T.copy().view("<u4").ravel()


def slot_counts(docs: DataFrame, told: Words, mixer: Mixer, parts: int = 1) -> np.ndarray:
    """Zeros and ones that each slot saw over all tokens of ``docs`` and, for letters,
    over the different escaped words of each part of the texts."""
    shared = docs.sparkSession.sparkContext.broadcast((told, mixer.codes, mixer.table_bits))
    size = 2 * len(mixer.counts)

    def run(batches):
        words, codes, table_bits = shared.value
        model = Mixer(codes, table_bits, np.zeros(0), np.zeros(0), np.zeros(0))
        both = np.zeros(-(-size // SEGMENT) * SEGMENT, np.uint32)
        past: set = set()
        for texts, _ in texts_of(batches):
            passage = Passage.of_texts(texts, words, past)
            for whole in (passage.words, passage.letters):
                for part in whole.batches(BATCH):
                    slots, owner, _, bit = model.slots(part)
                    weight = part.weights(owner).astype(np.uint32)
                    np.add.at(both, (2 * slots + bit).ravel(), np.tile(weight, PREDICTORS))
        both = both.reshape(-1, SEGMENT)
        spread = TaskContext.get().partitionId() // SPREAD
        for i in np.flatnonzero(both.any(axis=1)).tolist():
            yield pa.RecordBatch.from_arrays(
                [pa.array([i], pa.int64()), pa.array([spread], pa.int64()),
                 pa.array([pressed(both[i])], pa.binary())],
                ["segment", "spread", "counts"],
            )

    def total(table: pa.Table) -> pa.Table:
        held = np.zeros(SEGMENT, np.uint64)
        for x in table["counts"]:
            held += unpressed(x.as_py())
        held = np.minimum(held, 2**32 - 1)
        return pa.table(
            {
                "segment": table["segment"][:1],
                "spread": pa.array([0], pa.int64()),
                "counts": pa.array([pressed(held)], pa.binary()),
            }
        )

    schema = "segment long, spread long, counts binary"
    found = docs.mapInArrow(run, schema)
    if parts > SPREAD:
        found = found.groupBy("segment", "spread").applyInArrow(total, schema)
    found = found.groupBy("segment").applyInArrow(total, schema)
    out = np.zeros((-(-size // SEGMENT), SEGMENT // 2), np.uint16)
    for row in found.toLocalIterator():  # at most one row per segment
        pairs = unpressed(row["counts"]).reshape(-1, 2)
        out[row["segment"]] = slot_of(pairs[:, 0], pairs[:, 1])
    shared.unpersist()
    return out.ravel()[: size // 2]


def refined(docs: DataFrame, told: Words, mixer: Mixer) -> tuple[np.ndarray, np.ndarray]:
    """Weights after every part of the texts moved its own copy, averaged, and the last
    stage from what all parts saw."""
    shared = docs.sparkSession.sparkContext.broadcast((told, mixer))

    def run(batches):
        words, start = shared.value
        own = Mixer(start.codes, start.table_bits, start.counts, start.weights.copy(), start.last)
        seen = np.zeros((2, start.last.size))
        steps = n = 0
        past: set = set()
        for texts, _ in texts_of(batches):
            passage = Passage.of_texts(texts, words, past)
            for whole in (passage.words, passage.letters):
                for part in whole.batches(LEARN):
                    own.learn(part, RATE / (1 + steps / SLOWER), seen)
                    steps += 1
            n += len(passage.flat)
        values = np.concatenate([own.weights.ravel() * n, seen.ravel()])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(values))), pa.array(values), pa.array(np.full(len(values), n))],
            ["i", "value", "n"],
        )

    rows = (
        docs.mapInArrow(run, "i long, value double, n long")
        .groupBy("i")
        .agg(F.sum("value").alias("value"), F.sum("n").alias("n"))
        .orderBy("i")
        .collect()  # as many rows as weights and buckets
    )
    shared.unpersist()
    if not rows or not rows[0]["n"]:
        return mixer.weights, mixer.last
    values = np.array([r["value"] for r in rows])
    seen, ones = values[mixer.weights.size :].reshape(2, -1)
    last = (ones + PRIOR * mixer.last) / (seen + PRIOR)
    weights = values[: mixer.weights.size] / rows[0]["n"]
    return weights.reshape(mixer.weights.shape).astype(np.float32), last.astype(np.float32)


def token_rows(docs: DataFrame, told: Words, mixer: Mixer) -> DataFrame:
    """Per document a row without a word: row, doc_id, n_tokens, n_bytes and what its
    coded words and escapes add to n_known, base_score and score. Per different escaped
    word of a document and its kind: row, word, n_tokens (its number), score (of its
    letters, log10, once)."""
    shared = docs.sparkSession.sparkContext.broadcast((told, mixer))
    names = ["row", "word", "doc_id", "n_tokens", "n_bytes", "n_known", "base_score", "score"]
    kinds = "long binary long long long long double double".split()
    schema = ", ".join(map(" ".join, zip(names, kinds, strict=True)))
    types = pa.schema(list(zip(names, (
        pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()
    ), strict=True)))

    def run(batches):
        words, model = shared.value
        number = TaskContext.get().partitionId() << 40
        for texts, piece in texts_of(batches):
            passage = Passage.of_texts(texts, words)
            starts = np.cumsum(passage.sizes) - passage.sizes
            logs = model.log_prob(passage.words)[passage.each] / math.log(10)
            rows = number + np.arange(len(texts))
            number += len(texts)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(rows),
                    pa.nulls(len(texts), pa.binary()),
                    piece.column("doc_id"),
                    pa.array(passage.sizes, pa.int64()),
                    pa.array([len(t or b"") for t in texts], pa.int64()),
                    pa.array(np.add.reduceat(words.known[passage.symbols], starts), pa.int64()),
                    pa.array(np.add.reduceat(words.base[passage.symbols], starts)),
                    pa.array(np.add.reduceat(logs, starts)),
                ],
                schema=types,
            )
            if not len(passage.places):
                continue
            each = model.log_prob(passage.letters) / math.log(10)
            ends = np.cumsum(passage.letter_sizes)
            spelled = np.add.reduceat(each, ends - passage.letter_sizes)
            text = np.searchsorted(starts, passage.places, side="right") - 1
            pairs, times = np.unique(
                text * len(passage.escaped) + passage.which, return_counts=True
            )
            text, which = np.divmod(pairs, len(passage.escaped))
            n = len(pairs)
            found = [w for w, _ in passage.escaped]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(rows[text]),
                    pa.array([found[i] for i in which.tolist()], pa.binary()),
                    pa.nulls(n, pa.int64()),
                    pa.array(times, pa.int64()),
                    *(pa.nulls(n, t) for t in (pa.int64(), pa.int64(), pa.float64())),
                    pa.array(spelled[which]),
                ],
                schema=types,
            )

    return stored(docs.select("doc_id", "text").mapInArrow(run, schema), "token-rows")


def scores(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    kind_col: str | None = "lang",
) -> DataFrame:
    """Scores of every row by a model of the rows that are not held out.

    doc_id, held_out, n_tokens, n_known (tokens seen in training), train_tokens,
    base_score (add-one-half unigrams), score (this model), both log10, and
    bits_per_byte of the text (null for a text without bytes).

    A null text counts as empty: its one token is the end. A row with a null id is
    not held out. Repeated rows train once each and give repeated rows. An empty
    table gives an empty result; other columns are ignored. ``kind_col`` is read from
    training rows only, where null is a kind as well; None does without kinds.
    """
    ship(df.sparkSession)
    kind = F.col(kind_col).cast("string") if kind_col else F.lit(None).cast("string")
    docs = df.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), kind.alias("kind")
    )
    docs, kinds = with_kind(docs)
    words = vocabulary(docs, kinds)
    own = [F.coalesce(F.sum(f"c{k}"), F.lit(0)) for k in range(kinds)]
    n, v, *sizes = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("word"), *own).first()
    told, codes = frequent(words, n, v, sizes)
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = max(1, math.ceil(size / PART_BYTES))
    training = dealt(docs, parts).persist(StorageLevel.DISK_ONLY)
    mixer = Mixer.empty(codes, bits_for(n, v))
    mixer.counts = slot_counts(training, told, mixer, parts)
    mixer.weights, mixer.last = refined(training, told, mixer)
    training.unpersist()

    rows = token_rows(docs, told, mixer)
    rare_v, rare_n = v - int(told.known.sum()), told.escaped
    total, c, tf = F.lit(n + 0.5 * (v + 1)), F.coalesce("c", F.lit(0)), F.col("n_tokens")
    share = math.log10(0.5 * rare_v / rare_n) if rare_n else 0.0
    spelled = F.col("score") + share
    own_share = (c - 0.5) / max(rare_n, 1)
    escaped = (
        rows.filter("word is not null")
        .select("row", "word", "n_tokens", "score")
        .join(words.select("word", "c"), "word", "left")
        .select(
            "row",
            (tf * (c > 0).cast("int")).alias("n_known"),
            (tf * F.log10((c + 0.5) / total)).alias("base_score"),
            (
                tf * F.when(c > 0, F.log10(own_share + F.pow(F.lit(10.0), spelled))).otherwise(spelled)
            ).alias("score"),
        )
        .groupBy("row")
        .agg(*(F.sum(x).alias(x) for x in ("n_known", "base_score", "score")))
    )
    whole = rows.filter("word is null").drop("word").unionByName(escaped, allowMissingColumns=True)
    sums = whole.groupBy("row").agg(
        *(F.max(x).alias(x) for x in ("doc_id", "n_tokens", "n_bytes")),
        *(F.sum(x).alias(x) for x in ("n_known", "base_score", "score")),
    )
    return sums.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(n).cast("long").alias("train_tokens"),
        "base_score",
        "score",
        F.when(
            F.col("n_bytes") > 0, -F.col("score") * math.log2(10) / F.col("n_bytes")
        ).alias("bits_per_byte"),
    )
