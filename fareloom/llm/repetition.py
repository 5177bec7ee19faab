"""Repetition coverage: how much of a text lies in repeated n-grams and lines.

Rolling hashes of every n-gram length are taken over the word numbers of a text;
every n-gram that equals an earlier one covers the characters of its words, and
characters covered twice count once. Limits compare integers (parts per hundred
of the characters in words), so that no rounding decides.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from fareloom.llm.common import SPACES, WORD, id_and_text, map_texts, splitmix

# Limits in hundredths of the characters in words.
TOP_NGRAM = {2: 20, 3: 18, 4: 16}  # characters in all copies of the most frequent n-gram
DUPLICATED = {5: 15, 6: 14, 7: 13, 8: 12, 9: 11, 10: 10}  # characters in n-grams that equal an earlier one
DUP_LINES = 20  # characters of lines that equal an earlier one
MIN_WORDS = 50
SYMBOLS = "#*$%&|<>"
BASE = np.uint64(0x9E3779B97F4A7C15)

SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
    "n_repeat_words long, base_failed boolean, kept boolean, dup_line_chars long, "
    + ", ".join(f"top{n}_chars long" for n in TOP_NGRAM)
    + ", "
    + ", ".join(f"dup{n}_chars long" for n in DUPLICATED)
)


def covered(same: np.ndarray, n: int, length: int) -> np.ndarray:
    """Words inside the windows of ``n`` words for which ``same`` holds."""
    edge = np.zeros(length + 1, np.int64)
    starts = np.flatnonzero(same)
    edge[starts] += 1
    np.subtract.at(edge, starts + n, 1)
    return np.cumsum(edge[:-1]) > 0


def windows_twice(ids: np.ndarray, kinds: int) -> np.ndarray:
    """Which 3-word windows occur twice or more, from exact keys."""
    again = np.bincount(ids, minlength=kinds)[ids] > 1
    spots = np.flatnonzero(again[:-2] & again[1:-1] & again[2:])
    pair = ids[spots] * kinds + ids[spots + 1]
    if kinds > 2_000_000:  # three word numbers no longer fit in 63 bits
        pair = np.unique(pair, return_inverse=True)[1]
    _, inverse, count = np.unique(
        pair * kinds + ids[spots + 2], return_inverse=True, return_counts=True
    )
    twice = np.zeros(len(ids) - 2, bool)
    twice[spots] = count[inverse] > 1
    return twice


def measure(text: str | None) -> tuple:
    """All columns after ``doc_id`` for one text. Null counts as empty."""
    text = text or ""
    words = WORD.findall(text)
    n = len(words)
    number: dict[str, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    sizes = np.fromiter(map(len, words), np.int64, n)
    chars = int(sizes.sum())
    symbols = sum(text.count(x) for x in SYMBOLS)
    seen: set[str] = set()
    dup_lines = dup_line_chars = 0
    for line in text.split("\n"):
        if line.strip(SPACES):
            if line in seen:
                dup_lines += 1
                dup_line_chars += len(line) - sum(line.count(x) for x in SPACES)
            seen.add(line)
    repeat_words = 0
    if n >= 3 and len(number) < n:
        repeat_words = int(covered(windows_twice(ids, len(number)), 3, n).sum())
    found = {**dict.fromkeys(TOP_NGRAM, 0), **dict.fromkeys(DUPLICATED, 0)}
    value = splitmix(ids.astype(np.uint64))
    rolled = value
    # Only where the two n-grams inside it repeat can a longer one repeat.
    again = np.bincount(ids, minlength=1)[ids] > 1
    for size in range(2, max(found) + 1):
        spots = np.flatnonzero(again[:-1] & again[1:])
        if not len(spots):
            break
        rolled = rolled[:-1] * BASE + value[size - 1 :]
        _, first, inverse, count = np.unique(
            rolled[spots], return_index=True, return_inverse=True, return_counts=True
        )
        again = np.zeros(len(rolled), bool)
        again[spots] = count[inverse] > 1
        if size in DUPLICATED:
            later = np.zeros(len(rolled), bool)
            later[spots] = np.arange(len(spots)) != first[inverse]
            found[size] = int(sizes[covered(later, size, n)].sum())
        elif count.max() > 1:
            # Most frequent n-gram, and of these the one that covers most.
            per_kind = count * window_chars(sizes, size)[spots[first]]
            found[size] = int(per_kind[count == count.max()].max())
    failed = n < MIN_WORDS or 100 * repeat_words > 50 * n
    limits = {**TOP_NGRAM, **DUPLICATED}
    kept = (
        not failed
        and 100 * dup_line_chars <= DUP_LINES * chars
        and all(100 * found[k] <= limits[k] * chars for k in found)
    )
    return (
        n,
        chars,
        symbols,
        dup_lines,
        repeat_words,
        failed,
        kept,
        dup_line_chars,
        *(found[k] for k in TOP_NGRAM),
        *(found[k] for k in DUPLICATED),
    )


def window_chars(sizes: np.ndarray, n: int) -> np.ndarray:
    """Characters in each window of ``n`` words."""
    total = np.concatenate(([0], np.cumsum(sizes)))
    return total[n:] - total[:-n]


def repetition_coverage(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Measures and verdict for every row of ``df``.

    Null and empty texts have no words: all counts are 0, ``base_failed`` is true
    and ``kept`` false. A null id stays null; repeated rows give repeated rows; an
    empty table gives an empty result. Whole texts are read, in tasks of their own
    partition, without a shuffle. Columns other than the two named are ignored.
    """

    names = [x.split()[0] for x in SCHEMA.split(", ")][1:]

    def per_chunk(piece: pa.RecordBatch) -> pa.RecordBatch:
        rows = [measure(text) for text in piece.column(1).to_pylist()]
        columns = zip(*rows, strict=True) if rows else [[] for _ in names]
        arrays = [
            pa.array(c, pa.bool_() if name in ("base_failed", "kept") else pa.int64())
            for name, c in zip(names, columns, strict=True)
        ]
        return pa.RecordBatch.from_arrays([piece.column(0), *arrays], ["doc_id", *names])

    return map_texts(id_and_text(df, id_col, text_col), per_chunk, SCHEMA)
