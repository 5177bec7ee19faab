"""Token counts from a tokenizer compiled to finite-state transducers.

Two deterministic transducers run one after the other.

``Splitter`` reads character classes and parts a text into words. It has seven
states, and every transition carries the number of words that begin on it. A
chunk of text is a map from entry state to exit state and count; the maps of all
chunks compose by a parallel prefix scan, so chunks are read at the same time
although each depends on the one before.

``WordTransducer`` reads the bytes of a word. It follows byte-pair encoding: the
last token of every prefix is fixed, and a token may follow another if and only
if the pair encodes to itself. A state holds, for every token that may still be
under way, where it began, the token before it and the count there; a transition
carries the change of the count. States are made when first met.
"""

from __future__ import annotations

import functools
import json
import unicodedata

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from fareloom.llm.common import id_and_text, map_texts

VOCABULARY = "word_bpe_49k.json"
LIMIT = 2048
CHUNK = 64  # characters of a chunk
MAX_STATES = 250_000  # states kept by a task; beyond it they are made anew
MAX_WORDS = 200_000  # word counts kept by a task

SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"

# Character classes. Letters that occur in the contractions have their own.
SPACE, LETTER, NUMBER, OTHER, QUOTE = range(5)
LETTERS = {c: QUOTE + 1 + i for i, c in enumerate("strevmld")}
N_CLASSES = QUOTE + 1 + len(LETTERS)
# States: between words, in letters, in other characters, and after a quote that
# begins a word, alone or followed by the first letter of 're, 've or 'll.
FREE, IN_LETTERS, IN_OTHER, QUOTED, QUOTED_R, QUOTED_V, QUOTED_L = range(7)
N_STATES = 7


def splitter_tables() -> tuple[np.ndarray, np.ndarray]:
    """Next state, and which characters begin words (1 this one, 2 the one before)."""
    follow = np.zeros((N_STATES, N_CLASSES), np.uint8)
    begins = np.zeros((N_STATES, N_CLASSES), np.uint8)
    letters = [LETTER, *LETTERS.values()]

    def put(state, classes, to, begin):
        follow[state, classes] = to
        begins[state, classes] = begin

    for state in range(N_STATES):
        before = 2 if state >= QUOTED_R else 0  # the letter after the quote begins a word
        put(state, SPACE, FREE, before)
        put(state, NUMBER, FREE, before | 1)
        put(state, OTHER, IN_OTHER, before | 1)
        put(state, QUOTE, QUOTED, before | 1)
        put(state, letters, IN_LETTERS, before | 1)
    put(IN_LETTERS, letters, IN_LETTERS, 0)
    for state in (IN_OTHER, QUOTED):
        put(state, [OTHER, QUOTE], IN_OTHER, 0)
    put(QUOTED, [LETTERS[c] for c in "stmd"], FREE, 0)
    for first, second, state in (("r", "e", QUOTED_R), ("v", "e", QUOTED_V), ("l", "l", QUOTED_L)):
        put(QUOTED, LETTERS[first], state, 0)
        put(state, letters, IN_LETTERS, 2)
        put(state, LETTERS[second], FREE, 0)
    return follow, begins


class Splitter:
    """Marks where words begin in texts that were joined to one array of classes."""

    def __init__(self):
        follow, begins = splitter_tables()
        self.follow, self.begins = follow.ravel(), begins.ravel()
        self.counts = (self.begins & 1) + (self.begins >> 1)

    def chunk_maps(self, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Exit state and words begun for each entry state; ``classes`` by position."""
        n = classes.shape[1]
        state = np.repeat(np.arange(N_STATES, dtype=np.uint8)[:, None], n, axis=1)
        count = np.zeros((N_STATES, n), np.int32)
        for row in classes:
            at = state * np.uint8(N_CLASSES) + row
            count += self.counts[at]
            state = self.follow[at]
        return state, count

    @staticmethod
    def scan(state: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Maps from the start through each chunk: composition by doubling steps."""
        state, count = state.copy(), count.astype(np.int64)
        step = 1
        while step < state.shape[1]:
            first, then = state[:, :-step], np.arange(step, state.shape[1])
            count[:, step:] = count[:, :-step] + count[first, then]
            state[:, step:] = state[first, then]
            step *= 2
        return state, count

    def word_starts(self, classes: np.ndarray) -> np.ndarray:
        """One mark per character; the array must end in a space."""
        n = -(-len(classes) // CHUNK)
        padded = np.zeros(n * CHUNK, np.uint8)
        padded[: len(classes)] = classes
        by_position = np.ascontiguousarray(padded.reshape(n, CHUNK).T)
        through, begun = self.scan(*self.chunk_maps(by_position))
        state = np.concatenate(([FREE], through[FREE, :-1])).astype(np.uint8)
        marks = np.empty_like(by_position)
        for i, row in enumerate(by_position):
            at = state * np.uint8(N_CLASSES) + row
            marks[i] = self.begins[at]
            state = self.follow[at]
        flat = marks.T.ravel()
        starts = (flat & 1).astype(bool)
        starts[:-1] |= flat[1:] > 1
        assert starts.sum() == begun[FREE, -1]
        return starts[: len(classes)]


def byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class WordTransducer(dict):
    """Tokens of a word; counts of words seen are kept."""

    END = 256  # added to the last byte of a word

    def __init__(self, vocabulary: dict[str, int], merges: list, suffix: str):
        super().__init__()
        number = byte_symbols()

        def spell(token: str) -> tuple[int, ...]:
            if token.endswith(suffix):
                *head, last = (number[c] for c in token[: -len(suffix)])
                return (*head, last + self.END)
            return tuple(number[c] for c in token)

        self.ranks = {
            (spell(a), spell(b)): rank for rank, (a, b) in enumerate(map(tuple, merges))
        }
        self.children: list[dict[int, int]] = [{}]
        self.token: list[tuple[int, ...] | None] = [None]
        for token in vocabulary:
            node = 0
            for symbol in (spelled := spell(token)):
                node = self.children[node].setdefault(symbol, len(self.children))
                if node == len(self.children):
                    self.children.append({})
                    self.token.append(None)
            self.token[node] = spelled
        self.fit: dict[tuple, bool] = {}
        self.reset()

    def reset(self) -> None:
        self.states: list[tuple] = [((0, None, 0),)]
        self.number = {self.states[0]: 0}
        self.moves: dict[int, tuple[int, int]] = {}
        self.fit.clear()

    def encodes_to_itself(self, a, b) -> bool:
        """Whether the two tokens in a row stay as they are."""
        if a is None:
            return True
        known = self.fit.get((a, b))
        if known is None:
            parts = [(s,) for s in a + b]
            while len(parts) > 1:
                ranked = [self.ranks.get(pair, 1 << 60) for pair in zip(parts, parts[1:])]
                best = min(ranked)
                if best == 1 << 60:
                    break
                i = ranked.index(best)
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
            known = self.fit[a, b] = parts == [a, b]
        return known

    def move(self, state: int, symbol: int) -> tuple[int, int]:
        """Next state and change of the count, made and kept."""
        token, change, under_way = None, 0, []
        for node, before, behind in self.states[state]:
            node = self.children[node].get(symbol)
            if node is None:
                continue
            whole = self.token[node]
            if token is None and whole is not None and self.encodes_to_itself(before, whole):
                token, change = whole, 1 - behind
            if self.children[node]:
                under_way.append((node, before, behind))
        if token is None:
            raise ValueError(f"no token ends with symbol {symbol}")
        if symbol >= self.END:
            found = (0, change)
        else:
            to = (*((n, b, d + change) for n, b, d in under_way), (0, token, 0))
            if to not in self.number:
                self.number[to] = len(self.states)
                self.states.append(to)
            found = (self.number[to], change)
        self.moves[state << 9 | symbol] = found
        return found

    def __missing__(self, word: str) -> int:
        if len(self.states) > MAX_STATES:
            self.reset()
        if len(self) > MAX_WORDS:
            self.clear()
        symbols = word.encode()
        state = count = 0
        moves = self.moves
        for symbol in symbols[:-1]:
            state, change = moves.get(state << 9 | symbol) or self.move(state, symbol)
            count += change
        symbol = symbols[-1] + self.END
        count += (moves.get(state << 9 | symbol) or self.move(state, symbol))[1]
        self[word] = count
        return count


class TokenCounter:
    """The whole tokenizer: special strings, normal form, words, tokens."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        self.library = Tokenizer.from_file(path)
        self.special = [t["content"] for t in described["added_tokens"]]
        self.path = path
        self.splitter = Splitter()
        # Lower case and class of each character, taken from the library when first met.
        self.lower = np.zeros(0x110000, np.uint32)
        self.classes = np.full(0x110000, 255, np.uint8)
        self.expanding: dict[str, str] = {}

    @functools.cached_property
    def words(self) -> WordTransducer:
        """Made when counts are first asked for; those who only split words go without."""
        with open(self.path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        return WordTransducer(model["vocab"], model["merges"], model["end_of_word_suffix"])

    def learn(self, code: int) -> None:
        char = chr(code)
        lower = char.lower() if char.isascii() else self._library_lower(char)
        if len(lower) > 1:
            self.expanding[char] = lower
            lower = lower[0]
        self.lower[code] = ord(lower)
        self.classes[code] = self._class(lower)

    def _library_lower(self, char: str) -> str:
        """Lower case alone: the letters before and after keep it from composing."""
        known = self.library.normalizer.normalize_str(f"x{char}")[1:]
        return known or char

    def _class(self, char: str) -> int:
        if char == "'":
            return QUOTE
        if char in LETTERS:
            return LETTERS[char]
        split = self.library.pre_tokenizer.pre_tokenize_str
        if not split(char):
            return SPACE
        if len(split(f"{char}a")) == 1:
            return LETTER
        return OTHER if len(split(f"{char}!")) == 1 else NUMBER

    def prepare(self, text: str) -> str:
        for special in self.special:
            text = text.replace(special, "\n")
        if not text.isascii() and not unicodedata.is_normalized("NFC", text):
            text = self.library.normalizer[0].normalize_str(text)
        return text

    def words_of(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """The words of all texts in normal form, and how many lie before each text's
        end. Special strings are left out."""
        return self.split([self.prepare(t) for t in texts])

    def split(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """The same of texts in normal form without special strings."""
        codes = self._known_codes(texts)
        if self.expanding and any(c in t for t in texts for c in self.expanding):
            for char, lower in self.expanding.items():
                texts = [t.replace(char, lower) for t in texts]
            codes = self._known_codes(texts)
        classes = self.classes[codes]
        starts = self.splitter.word_starts(classes)
        before = np.cumsum(starts)
        # Every word on its own, parted by spaces.
        spread = np.full(len(codes) + int(before[-1]), 32, np.uint32)
        spread[np.arange(len(codes)) + before] = np.where(classes == SPACE, 32, self.lower[codes])
        words = list(filter(None, spread.tobytes().decode("utf-32-le").split(" ")))
        return words, before[np.cumsum([len(t) + 1 for t in texts]) - 1]

    def count(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text."""
        specials = [sum(t.count(s) for s in self.special) if "<|" in t else 0 for t in texts]
        words, ends = self.words_of(texts)
        counts = np.fromiter(map(self.words.__getitem__, words), np.int64, len(words))
        upto = np.concatenate(([0], np.cumsum(counts)))[ends]
        return np.diff(upto, prepend=0) + specials

    def _known_codes(self, texts: list[str]) -> np.ndarray:
        codes = self._codes(texts)
        for code in np.unique(codes[self.classes[codes] == 255]).tolist():
            self.learn(code)
        return codes

    @staticmethod
    def _codes(texts: list[str]) -> np.ndarray:
        joined = "\n".join(texts) + "\n"
        return np.frombuffer(joined.encode("utf-32-le"), np.uint32)


@functools.cache
def counter(path: str) -> TokenCounter:
    return TokenCounter(path)


def token_counts(
    df: DataFrame,
    vocabulary: str = VOCABULARY,
    limit: int = LIMIT,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (``n_tokens > limit``) per row.

    Counts equal those of the tokenizers library for the file ``vocabulary``,
    without begin or end tokens; a special string inside a text is one token. A
    null text counts as empty: 0 bytes, 0 tokens. A null id stays null, repeated
    rows give repeated rows, an empty table gives an empty result; columns other
    than the two named are ignored. No shuffle.
    """

    def per_chunk(piece: pa.RecordBatch) -> pa.RecordBatch:
        texts = piece.column(1)
        path = public_tokenizers.path(vocabulary)
        tokens = counter(path).count([t or "" for t in texts.to_pylist()])
        size = pc.cast(pc.fill_null(pc.binary_length(texts), 0), pa.int64())
        return pa.RecordBatch.from_arrays(
            [piece.column(0), size, pa.array(tokens, pa.int64()), pa.array(tokens > limit)],
            ["doc_id", "n_bytes", "n_tokens", "over_limit"],
        )

    return map_texts(id_and_text(df, id_col, text_col), per_chunk, SCHEMA)
