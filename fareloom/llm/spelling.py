"""Spelling variants by a dictionary of pairs of trie nodes.

The words of a corpus form two tries, one of the words and one of the reversed words. A
place in a word is a pair of integers: the node of what lies before it and the node of
what lies behind it. Two words that differ in one replaced character have the same pair
around it; a word that lacks a character of another has, between two of its own, the
pair that lies around that character in the other. So a join on pairs finds exactly
the words that are one insertion, deletion or replacement apart.

The first ``SPELLED`` characters of a word number their nodes by themselves, eight bits
each, so no task needs to see all words that begin alike. Deeper nodes are numbered by a
task that goes through the sorted words that share these characters.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fareloom.llm.common import LOWER, by_chunks, id_and_text, ship, stored

LEAST_CHARS, LEAST_COUNT = 5, 3
DROP = 97  # one occurrence in so many loses a character
FACTOR = 2  # a form is so many times as frequent as its variant
SPELLED = 7
NODES_PER_TASK = 1 << 40

# Words are runs of A-Z, a-z and U+00C0 to U+00FF, whose UTF-8 form is 0xC3 and one byte.
LEAD = 0xC3
IS_LETTER = np.zeros(256, bool)
IS_LETTER[[LEAD, *range(65, 91), *range(97, 123)]] = True
LOWERED = np.frombuffer(LOWER, np.uint8)
CHUNK_BYTES = 200_000  # of words whose paths are held at once
SHIFTED_BYTES = 64  # longer words are hashed one by one


def shift_tables() -> np.ndarray:
    """``[n, i, b]``: what n zero bytes make of a crc32 whose byte i is b and others 0.

    The crc32 of a text with a word behind it is the text's, sent through as many zero
    bytes as the word has, xor the word's own.
    """
    byte = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        byte = np.where(byte & 1, byte >> 1 ^ np.uint32(0xEDB88320), byte >> 1)
    state = np.arange(256, dtype=np.uint32) << (8 * np.arange(4, dtype=np.uint32))[:, None]
    out = [state]
    for _ in range(SHIFTED_BYTES):
        state = state >> 8 ^ byte[state & 255]
        out.append(state)
    return np.array(out)


SHIFT = shift_tables()


def crc_behind(before: np.ndarray, own: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """crc32 of words of ``sizes`` bytes and crc32 ``own`` behind texts of crc32 ``before``."""
    out = own.copy()
    for i in range(4):
        out ^= SHIFT[sizes, i, before >> np.uint32(8 * i) & np.uint32(255)]
    return out


def words_of(texts: list[str | None]) -> tuple[list[bytes], np.ndarray]:
    """Words of all texts in lower case (A-Z only), and how many each text has."""
    data = [(t or "").encode() for t in texts]
    raw = np.frombuffer(b"\n".join([*data, b""]), np.uint8)
    keep = IS_LETTER[raw]
    keep[1:] |= raw[:-1] == LEAD
    starts = keep.copy()
    starts[1:] &= ~keep[:-1]
    words = np.where(keep, LOWERED[raw], np.uint8(32)).tobytes().split()
    ends = np.cumsum([len(x) + 1 for x in data])
    return words, np.diff(np.cumsum(starts)[ends - 1], prepend=0)


def chunk_counts(doc_ids: list[int | None], texts: list[str | None]) -> Counter:
    """Occurrences of words, after one in ``DROP`` lost a character."""
    words, per_text = words_of(texts)
    distinct = list(dict.fromkeys(words))
    index = dict(zip(distinct, range(len(distinct)), strict=True))
    number = np.fromiter(map(index.__getitem__, words), np.int64, len(words))
    doc = np.repeat(np.arange(len(texts)), per_text)
    keys = [b"%d:" % d if d is not None else b":" for d in doc_ids]
    before = np.array([zlib.crc32(k) for k in keys], np.uint32)
    own = np.array([zlib.crc32(w) for w in distinct], np.uint32)
    sizes = np.fromiter(map(len, distinct), np.int64, len(distinct))
    crc = crc_behind(before[doc], own[number], np.minimum(sizes, SHIFTED_BYTES)[number])
    for i in np.flatnonzero((sizes > SHIFTED_BYTES)[number]).tolist():
        crc[i] = zlib.crc32(keys[doc[i]] + words[i])
    hit = crc % DROP == 0
    counts = np.bincount(number[~hit], minlength=len(distinct)).tolist()
    found = Counter()
    for word, n in zip(distinct, counts, strict=True):
        if n and len(word) - word.count(LEAD) >= LEAST_CHARS:
            found[word.decode()] = n
    for i in np.flatnonzero(hit).tolist():
        word = words[i].decode()
        at = int(crc[i]) % len(word)
        if len(word) > LEAST_CHARS:
            found[word[:at] + word[at + 1 :]] += 1
    return found


def word_counts(docs: DataFrame) -> DataFrame:
    """(id, word, n) of words frequent enough; ids ascend in code-point order."""

    def run(batches):
        for batch in batches:
            for piece in by_chunks(batch, "text"):
                found = chunk_counts(*(c.to_pylist() for c in piece.columns))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())],
                    ["word", "n"],
                )

    counted = docs.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counted = stored(counted.filter(F.col("n") >= LEAST_COUNT), "word-counts")
    ordered = counted.orderBy("word").withColumn("id", F.monotonically_increasing_id())
    return stored(ordered, "words")


def same_start(a: str, b: str) -> int:
    i, n = 0, min(len(a), len(b))
    while i < n and a[i] == b[i]:
        i += 1
    return i


class Trie:
    """Goes through sorted words and names the nodes on the way to each, the root (0)
    first. Nodes beyond ``SPELLED`` characters get numbers below ``last``."""

    def __init__(self, last: int):
        self.before, self.path, self.last = "", [0], last

    def walk(self, word: str) -> list[int]:
        path = self.path
        del path[same_start(self.before, word) + 1 :]
        for depth in range(len(path) - 1, len(word)):
            if depth < SPELLED:
                path.append(path[-1] << 8 | ord(word[depth]))
            else:
                self.last -= 1
                path.append(self.last)
        self.before = word
        return path[:]


def lists(values: list[list], kind: pa.DataType) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, values)])
    return pa.ListArray.from_arrays(
        pa.array(ends, pa.int32()), pa.array([x for own in values for x in own], kind)
    )


def with_nodes(words: DataFrame) -> DataFrame:
    """(id, n, pre, suf, fresh): for a word of k characters the k + 1 nodes of what lies
    before and of what lies behind each place, and for each character whether it differs
    from the one before it. Written to the shared folder."""

    def forward(batches):
        trie = Trie(-NODES_PER_TASK * TaskContext.get().partitionId())
        for batch in batches:
            for piece in by_chunks(batch, "word", CHUNK_BYTES):
                pre = [trie.walk(w) for w in piece.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*piece.columns, lists(pre, pa.int64())], [*piece.schema.names, "pre"]
                )

    def backward(batches):
        trie = Trie(-NODES_PER_TASK * TaskContext.get().partitionId())
        for batch in batches:
            for piece in by_chunks(batch, "word", CHUNK_BYTES):
                texts = piece.column(2).to_pylist()
                suf = [trie.walk(w[::-1])[::-1] for w in texts]
                fresh = [[True, *(a != b for a, b in zip(w, w[1:]))] for w in texts]
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column(0),
                        piece.column(1),
                        piece.column(3),
                        lists(suf, pa.int64()),
                        lists(fresh, pa.bool_()),
                    ],
                    ["id", "n", "pre", "suf", "fresh"],
                )

    schema = "id long, n long, word string, pre array<long>"
    starts = words.select("id", "n", "word").repartition(F.left("word", F.lit(SPELLED)))
    known = starts.sortWithinPartitions("word").mapInArrow(forward, schema)
    ends = known.repartition(F.right("word", F.lit(SPELLED)))
    schema = "id long, n long, pre array<long>, suf array<long>, fresh array<boolean>"
    return stored(
        ends.sortWithinPartitions(F.reverse("word")).mapInArrow(backward, schema), "nodes"
    )


def near_words(nodes: DataFrame) -> DataFrame:
    """(id, n_near, best_n, best_id) of words that have a near one.

    All words around one pair of nodes differ in the character between them, so there are
    no more of them than letters. An insertion next to equal letters has several places;
    the first of them (``fresh``) counts.
    """
    skips = nodes.select(
        "id", "n", "fresh",
        F.slice("pre", F.lit(1), F.size("fresh")).alias("before"),
        F.slice("suf", F.lit(2), F.size("fresh")).alias("behind"),
    ).select("id", "n", F.inline(F.arrays_zip("before", "behind", "fresh")))
    gaps = nodes.select(
        F.col("id").alias("short_id"), F.col("n").alias("short_n"),
        F.col("pre").alias("before"), F.col("suf").alias("behind"),
    ).select("short_id", "short_n", F.inline(F.arrays_zip("before", "behind")))
    pair = Window.partitionBy("before", "behind")
    best = pair.orderBy(F.desc("n"), "id").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    # Candidates compare by count, then by the smaller id.
    skips = skips.select(
        "id", "n", "before", "behind", "fresh",
        F.count("*").over(pair).alias("words"),
        F.struct("n", (-F.col("id")).alias("id")).alias("own"),
    ).select(
        "*",
        F.first("own").over(best).alias("first"),
        F.nth_value("own", 2).over(best).alias("second"),
    )
    same = (F.col("g.before") == F.col("s.before")) & (F.col("g.behind") == F.col("s.behind"))
    met = skips.alias("s").join(gaps.alias("g"), same & F.col("s.fresh"), "left")
    met = met.filter((F.col("words") > 1) | F.col("short_id").isNotNull())
    other = F.when(F.col("first") == F.col("own"), F.col("second")).otherwise(F.col("first"))
    shorter = F.struct(F.col("short_n").alias("n"), (-F.col("short_id")).alias("id"))
    found = F.when(F.col("short_id").isNotNull(), shorter)
    longer = F.struct(
        F.col("id"),
        (F.col("words") - 1 + F.col("short_id").isNotNull().cast("long")).alias("near"),
        F.greatest(other, found).alias("best"),
    )
    lacking = F.struct(
        F.col("short_id").alias("id"), F.lit(1).cast("long").alias("near"), F.col("own").alias("best")
    )
    return (
        met.select(F.inline(F.array(longer, lacking)))
        .filter("id IS NOT NULL")
        .groupBy("id")
        .agg(F.sum("near").alias("n_near"), F.max("best").alias("best"))
        .select("id", "n_near", F.col("best.n").alias("best_n"), (-F.col("best.id")).alias("best_id"))
    )


def roots_of(links: DataFrame) -> DataFrame:
    """(id, root_id): where ``links`` (id, to) lead in the end.

    Every round doubles the steps. A form is ``FACTOR`` times as frequent, so the paths
    are shorter than the logarithm of the largest count.
    """
    links = stored(links, "links")
    while True:
        on = links.select(F.col("id").alias("to"), F.col("to").alias("further"))
        moved = stored(
            links.join(on, "to", "left").select(
                "id", F.coalesce("further", "to").alias("to"), F.col("further").isNotNull().alias("moved")
            ),
            "links",
        )
        if moved.filter("moved").isEmpty():
            return links.withColumnRenamed("to", "root_id")
        links = moved.select("id", "to")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word, form, root, n, n_near and form_n of every frequent word of ``docs``.

    Words are the runs of letters (A-Z, a-z, U+00C0 to U+00FF) in lower case (A-Z only).
    Where ``DROP`` divides the crc32 of "<doc_id>:<word>", the occurrence has lost the
    character crc32 mod length. Results of at least ``LEAST_CHARS`` characters that occur
    ``LEAST_COUNT`` times count. Words are near if one inserted, deleted or replaced
    character parts them. A word's form is its near word with the largest n (ties: the
    smallest in code-point order) if it is ``FACTOR`` times as frequent, else null; the
    root is where forms lead, the word itself without one.

    Null and empty texts hold no words, a null id is written as nothing before the colon.
    Repeated rows count one by one. An empty table gives an empty result. Only the two
    named columns are read. Words and texts of any length are taken whole.
    """
    ship(docs.sparkSession)
    words = word_counts(id_and_text(docs, id_col, text_col))
    near = stored(near_words(with_nodes(words)), "near")
    linked = words.join(near, "id").filter(F.col("best_n") >= FACTOR * F.col("n"))
    links = stored(linked.select("id", F.col("best_id").alias("to")), "forms")
    forms = words.select(F.col("id").alias("to"), F.col("word").alias("form"), F.col("n").alias("form_n"))
    roots = words.select(F.col("id").alias("root_id"), F.col("word").alias("root"))
    named = links.join(forms, "to").select("id", "form", "form_n")
    ended = roots_of(links).join(roots, "root_id").select("id", "root")
    return (
        words.join(near.select("id", "n_near"), "id", "left")
        .join(named, "id", "left")
        .join(ended, "id", "left")
        .select(
            "word", "form", F.coalesce("root", "word").alias("root"), "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"), "form_n",
        )
    )
