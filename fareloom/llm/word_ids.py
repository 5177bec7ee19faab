"""Ids of whole texts, for a tokenizer that drops white space before it looks at words.

A text's ids are those of its parts between ASCII spaces, one after the other. All words
of a chunk of texts are hashed at once and looked up in sorted arrays; the bytes of each
are compared with those of the word that was found. Words that a task has not met are
split further into units, which the tokenizer encodes alone, and the library's model
encodes the units that are new. Ids lie in flat arrays, so a chunk is put together by
one gather.
"""

from __future__ import annotations

import functools
import os
import unicodedata

import numpy as np

from fareloom.llm.common import SPACES, splitmix
from fareloom.llm.token_counts import byte_symbols, counter

# Words that a task remembers; beyond it, it begins anew with the next texts.
MAX_WORDS = 1_000_000
# Bytes hashed at once; a longer run without spaces is hashed as a whole.
SLICE = 1_000_000
BASE = 0x9E3779B97F4A7C15

IS_SPACE = np.zeros(256, bool)
IS_SPACE[list(SPACES.encode())] = True
# The characters that stand for the bytes of a unit that is not ASCII.
SPELL = {byte: symbol for symbol, byte in byte_symbols().items()}


def spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Positions of the runs ``starts[i] : starts[i] + sizes[i]``, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(int(sizes.sum())) + np.repeat(starts - ends + sizes, sizes)


class Runs:
    """Runs of values by number."""

    def __init__(self, kind):
        self.values = np.zeros(0, kind)
        self.starts = self.sizes = np.zeros(0, np.int64)

    def add(self, values: np.ndarray, sizes: np.ndarray) -> None:
        starts = len(self.values) + np.cumsum(sizes) - sizes
        self.starts = np.concatenate([self.starts, starts])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.values = np.concatenate([self.values, values])

    def of(self, numbers: np.ndarray) -> np.ndarray:
        """Values of these runs, one after the other."""
        return self.values[spans(self.starts[numbers], self.sizes[numbers])]


class WordTable:
    """Numbers of words by hash, with their bytes and ids."""

    def __init__(self):
        self.keys, self.numbers = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.bytes, self.ids = Runs(np.uint8), Runs(np.uint32)


@functools.lru_cache(maxsize=1)
def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of ``BASE`` and of its inverse, modulo 2**64."""
    out = []
    for base in (BASE, pow(BASE, -1, 1 << 64)):
        factors = np.full(n, base, np.uint64)
        factors[0] = 1
        out.append(np.cumprod(factors))
    return out[0], out[1]


def hashed(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A hash of each word, whatever its place: a polynomial of its bytes, mixed."""
    size = -(-len(data) // SLICE) * SLICE + 1
    up, down = powers(size)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(data * up[: len(data)], out=sums[1:])
    return splitmix((sums[starts + sizes] - sums[starts]) * down[starts] + sizes.astype(np.uint64))


class WordIds:
    def __init__(self, path: str, max_words: int = MAX_WORDS):
        self.max_words = max_words
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.counter = counter(path)
        self.words = WordTable()
        self.units: dict[str, int] = {}
        self.unit_ids = Runs(np.uint32)

    def library_ids(self, text: str) -> np.ndarray:
        return np.array(self.counter.library.encode(text, add_special_tokens=False).ids, np.uint32)

    def learn_units(self, units: list[str]) -> None:
        tokenize = self.counter.library.model.tokenize
        ids, sizes = [], []
        for unit in units:
            if not unit.isascii():
                unit = unit.encode().decode("latin-1").translate(SPELL)
            found = tokenize(unit)
            sizes.append(len(found))
            for token in found:
                ids.append(token.id)
        first = len(self.units)
        self.units.update(zip(units, range(first, first + len(units)), strict=True))
        self.unit_ids.add(np.array(ids, np.uint32), np.array(sizes, np.int64))

    def spell(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words, one after the other, and how many each has."""
        special = [i for i, w in enumerate(words) if b"<|" in w]
        texts = [w.decode() for w in words]
        for i in special:
            texts[i] = ""
        if len(self.units) > self.max_words * 7 // 10:
            self.units, self.unit_ids = {}, Runs(np.uint32)
        normal = unicodedata.is_normalized("NFC", " ".join(texts))
        units, ends = (self.counter.split if normal else self.counter.words_of)(texts)
        self.learn_units(list(set(units).difference(self.units)))
        numbers = np.fromiter(map(self.units.__getitem__, units), np.int64, len(units))
        ids, sizes = self.unit_ids.of(numbers), self.unit_ids.sizes[numbers]
        ends = np.concatenate([[0], np.cumsum(sizes)])[ends]
        sizes = np.diff(ends, prepend=0)
        for i in reversed(special):
            own = self.library_ids(words[i].decode())
            ids = np.insert(ids, ends[i], own)
            sizes[i] = len(own)
        return ids, sizes

    def numbers_of(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of all words of ``data``, and where each begins."""
        is_word = ~IS_SPACE[data]
        edges = np.flatnonzero(np.diff(is_word.view(np.int8), prepend=0, append=0))
        starts, sizes = edges[::2], edges[1::2] - edges[::2]
        if not len(starts):
            return starts, starts
        keys, first, inverse = np.unique(
            hashed(data, starts, sizes), return_index=True, return_inverse=True
        )
        table = self.words
        at = np.searchsorted(table.keys, keys)
        known = np.zeros(len(keys), bool)
        near = at < len(table.keys)
        known[near] = table.keys[at[near]] == keys[near]
        numbers = np.empty(len(keys), np.int64)
        numbers[known] = table.numbers[at[known]]
        new = np.flatnonzero(~known)
        if len(new):
            numbers[new] = len(table.ids.sizes) + np.arange(len(new))
            begins, own = starts[first[new]], sizes[first[new]]
            raw = data.tobytes()
            spans_ = zip(begins.tolist(), (begins + own).tolist(), strict=True)
            table.ids.add(*self.spell([raw[a:b] for a, b in spans_]))
            table.bytes.add(data[spans(begins, own)], own)
            table.keys = np.insert(table.keys, at[new], keys[new])
            table.numbers = np.insert(table.numbers, at[new], numbers[new])
        numbers = numbers[inverse]
        if not (
            np.array_equal(sizes, table.bytes.sizes[numbers])
            and np.array_equal(data[is_word], table.bytes.of(numbers))
        ):
            raise HashCollision
        return numbers, starts

    def encode(
        self, texts: list[str | None], end_id: int | None = None
    ) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each followed by ``end_id`` if given, and where each ends.
        Null counts as empty."""
        try:
            ids, ends = self.by_words([(t or "").encode() for t in texts])
        except HashCollision:  # two words with one hash: exact, but slow
            each = [self.library_ids(t or "") for t in texts]
            ids = np.concatenate(each)
            ends = np.cumsum([len(x) for x in each])
        if end_id is None:
            return ids, ends
        return np.insert(ids, ends, end_id), ends + np.arange(1, len(ends) + 1)

    def by_words(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.words.keys) > self.max_words:
            self.words = WordTable()
        data = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
        text_ends = np.cumsum(np.array([len(t) + 1 for t in texts], np.int64))
        ids, counts = [np.zeros(0, np.uint32)], np.zeros(len(texts), np.int64)
        start = 0
        while start < len(data):
            stop = min(len(data), start + SLICE)
            while not IS_SPACE[data[stop - 1]]:  # the last byte is a space
                stop += 1
            numbers, places = self.numbers_of(data[start:stop])
            sizes = self.words.ids.sizes[numbers]
            ids.append(self.words.ids.of(numbers))
            text = np.searchsorted(text_ends, start + places, side="right")
            counts += np.bincount(text, sizes, len(texts)).astype(np.int64)
            start = stop
        return np.concatenate(ids), np.cumsum(counts)


class HashCollision(Exception):
    pass


@functools.cache
def word_ids(path: str, max_words: int = MAX_WORDS) -> WordIds:
    return WordIds(path, max_words)
