"""Packing documents into windows of fixed length by the sum of squares.

Documents arrive one after another. Whole windows are cut from a long one; the
rest goes to the fill level that leaves the smallest sum over levels of (number
of windows at that level) squared, full and empty windows not counted. An array
holds the number of windows at each level, so a choice is one look over it.

Every partition packs its own rows and numbers its own sequences. Once it holds
``OPEN_WINDOWS`` partly filled windows, and at its end, the fullest of them are
filled from the emptiest one, of which a document is cut only if it does not fit
whole; the last rest goes to sequences whose length is a power of two, which need no
padding. No row is moved between machines.
"""

from __future__ import annotations

import zlib
from collections import deque

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from fareloom.llm.common import by_chunks, id_and_text, number_of, numbered
from fareloom.llm.word_ids import MAX_WORDS, word_ids

WINDOW = 4096
END_ID = 2
VOCABULARY = "word_bpe_49k.json"
OPEN_WINDOWS = 4096
SEQUENCES_PER_PARTITION = 1 << 40
ROWS_PER_BATCH = 20_000

COLUMNS = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
SCHEMA = ", ".join(f"{name} long" for name in COLUMNS)


class Packer:
    """Windows of one partition. Pieces are (doc_id, start, ids, doc_tokens)."""

    def __init__(self, first_sequence: int, window: int = WINDOW, limit: int = OPEN_WINDOWS):
        self.window, self.limit = window, limit
        self.next_sequence = first_sequence
        self.levels = np.zeros(window + 1, np.int64)
        self.open: dict[int, deque] = {}  # windows by level, oldest first
        self.n_open = 0
        self.done: list[tuple] = []

    def close(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc_id, start, ids, doc_tokens in pieces:
            self.done.append(
                (doc_id, start, len(ids), zlib.crc32(ids), doc_tokens, self.next_sequence, offset)
            )
            offset += len(ids)
        self.next_sequence += 1

    def level_for(self, size: int) -> int:
        """Fill level, 0 for a new window, with the least growth of the sum of squares."""
        if not self.n_open:
            return 0
        top = self.window - size
        from_, to = self.levels[: top + 1], self.levels[size:]
        growth = 2 * (to - from_) + 2
        growth[0] = 2 * to[0] + 1
        growth[top] = -2 * from_[top] + 1  # full windows do not count
        growth[1:][from_[1:] == 0] = np.iinfo(np.int64).max
        return top - int(np.argmin(growth[::-1]))  # the fullest of equals

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        """Place a document; ``ids`` are little-endian unsigned 32-bit integers."""
        total, start = len(ids), 0
        while total - start >= self.window:
            self.close([(doc_id, start, ids[start : start + self.window], total)])
            start += self.window
        if start < total:
            self.place((doc_id, start, ids[start:].copy(), total))
        if self.n_open > self.limit:
            self.fill(self.limit // 2)

    def place(self, piece: tuple) -> None:
        size = len(piece[2])
        level = self.level_for(size)
        pieces = []
        if level:
            pieces = self.open[level].popleft()
            self.levels[level] -= 1
            self.n_open -= 1
        pieces.append(piece)
        self.put(pieces)

    def put(self, pieces: list[tuple]) -> None:
        level = sum(len(p[2]) for p in pieces)
        if level == self.window:
            self.close(pieces)
            return
        self.open.setdefault(level, deque()).append(pieces)
        self.levels[level] += 1
        self.n_open += 1

    def fill(self, keep: int) -> None:
        """Close windows until ``keep`` are open: the fullest takes from the emptiest."""
        windows = deque(w for level in sorted(self.open) for w in self.open[level])
        self.open.clear()
        self.levels[:] = 0
        self.n_open = 0
        while len(windows) > keep:
            target = windows.pop()
            room = self.window - sum(len(p[2]) for p in target)
            while room and windows:
                donor = windows[0]
                doc_id, start, ids, total = donor.pop()
                cut = max(0, len(ids) - room)  # what stays behind
                target.append((doc_id, start + cut, ids[cut:], total))
                room -= len(ids) - cut
                if cut:
                    donor.append((doc_id, start, ids[:cut], total))
                elif not donor:
                    windows.popleft()
            self.put(target)
            if room:
                break
        for pieces in windows:
            self.put(pieces)

    def cut(self, pieces: deque, size: int) -> list[tuple]:
        """Close sequences of ``size`` ids from ``pieces``; what is left over."""
        held, filled = [], 0
        while pieces:
            doc_id, start, ids, total = pieces.popleft()
            room = size - filled
            held.append((doc_id, start, ids[:room], total))
            filled += len(held[-1][2])
            if len(ids) > room:
                pieces.appendleft((doc_id, start + room, ids[room:], total))
            if filled == size:
                self.close(held)
                held, filled = [], 0
        return held

    def finish(self) -> None:
        self.fill(0)
        rest = [p for windows in self.open.values() for w in windows for p in w]
        size = self.window // 2
        while rest and size:
            if sum(len(p[2]) for p in rest) >= size:
                rest = self.cut(deque(rest), size)
            size //= 2
        self.open.clear()


def pack(
    df: DataFrame,
    vocabulary: str = VOCABULARY,
    end_id: int = END_ID,
    window: int = WINDOW,
    table_words: int = MAX_WORDS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document's ids are those of the tokenizers library without special tokens,
    then ``end_id``. Each id lies in exactly one piece; the pieces of a sequence
    follow each other from offset 0 without gaps.

    A null or empty text is ``end_id`` alone. A null id stays null; repeated rows
    are packed one by one; an empty table gives an empty result; columns other
    than the two named are ignored. A text of any length is packed whole.

    A task remembers the ids of ``table_words`` words, which only saves time.

    The result follows from the order of rows within partitions, so read ``df``
    from files: a task that runs again then packs the same rows the same way.
    """

    def run(batches):
        packer = Packer(TaskContext.get().partitionId() * SEQUENCES_PER_PARTITION, window)
        words = word_ids(public_tokenizers.path(vocabulary), table_words)

        def written() -> pa.RecordBatch:
            columns = zip(*packer.done, strict=True) if packer.done else [[] for _ in COLUMNS]
            arrays = [pa.array(c, pa.int64()) for c in columns]
            packer.done = []
            return pa.RecordBatch.from_arrays(arrays, list(COLUMNS))

        for batch in batches:
            for piece in by_chunks(batch, "text"):
                ids, ends = words.encode(piece.column(1).to_pylist(), end_id)
                start = 0
                for doc_id, end in zip(piece.column(0).to_pylist(), ends.tolist(), strict=True):
                    packer.add(doc_id, ids[start:end])
                    start = end
                if len(packer.done) >= ROWS_PER_BATCH:
                    yield written()
        packer.finish()
        yield written()

    rows = id_and_text(numbered(df), number_of(df, id_col), number_of(df, text_col))
    return rows.mapInArrow(run, SCHEMA)
