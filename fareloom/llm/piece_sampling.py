"""SentencePiece segmentations drawn from the piece lattice, and their decoding.

All ways to write a text as pieces form a lattice. A forward pass sums their
weights up to every position; a backward pass then draws the last piece, the one
before it, and so on, so that every segmentation comes with its exact probability.
Random numbers are hashes of the seed, the row's key and the place in the text:
the same row gives the same pieces on any machine and in any partition.

No piece goes on from another character to a space mark, so the lattice parts
there, and words are filtered once per chunk of texts however often they occur. A
character without a piece is spelled in byte pieces. A literal space mark in a
text is spelled so too, which keeps decoding lossless.
"""

from __future__ import annotations

import functools
import math
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.llm.common import by_chunks, splitmix

MODEL = "piece_bpe_32k.model"
THETA = 0.5  # exponent on the piece probabilities; 0 draws uniformly
SEED = 20_240_501
CHUNK_BYTES = 2_000_000
MARK = "▁"
LITERAL = "\udc81"  # stands for a literal mark; no valid text holds a lone surrogate
WORD = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
UNIT = 2.0**-64
STEP = 0xD1342543DE82EF95
SPREAD = np.uint64(0x9E3779B97F4A7C15)


class PieceLattice:
    """Pieces with probabilities that fall with their rank, as a trie in arrays."""

    def __init__(self, path: str, theta: float = THETA):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.vocab_size()
        normal = [
            i for i in range(n)
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
        ]
        self.byte_id = np.zeros(256, np.int32)
        self.spelling: list[bytes] = [b""] * n
        for i in range(n):
            if model.is_byte(i):
                value = int(model.id_to_piece(i)[3:-1], 16)
                self.byte_id[value] = i
                self.spelling[i] = bytes([value])
        ranked = sorted(normal, key=lambda i: -model.get_score(i))
        weight = 1.0 / (np.arange(len(ranked)) + 10.0)
        log_p = np.log(weight / weight.sum())
        self.log_p = np.full(n + 1, theta * (log_p[-1] - math.log(256)))
        edges: dict[tuple[int, int], int] = {}
        piece_at = [-1]
        self.longest = 1
        for i, p in zip(ranked, log_p, strict=True):
            piece = model.id_to_piece(i)
            if re.search(f"[^{MARK}]{MARK}", piece):
                raise ValueError(f"piece {piece!r} goes on to a space mark")
            self.log_p[i] = theta * p
            self.spelling[i] = piece.replace(MARK, " ").encode()
            self.longest = max(self.longest, len(piece))
            node = 0
            for char in piece:
                node = edges.setdefault((node, ord(char)), len(piece_at))
                if node == len(piece_at):
                    piece_at.append(-1)
            piece_at[node] = i
        self.piece_bytes = np.frombuffer(b"".join(self.spelling), np.uint8)
        self.piece_size = np.array([len(x) for x in self.spelling])
        self.piece_start = np.cumsum(self.piece_size) - self.piece_size
        keys = np.array([a << 21 | c for a, c in edges], np.int64)
        to = np.array(list(edges.values()), np.int64)
        self.piece_at = np.array(piece_at, np.int64)
        self.inner = np.zeros(len(piece_at), bool)  # nodes that go on
        self.inner[keys >> 21] = True
        self.first = np.full(0x110000, -1)  # the node after one character
        at_root = keys < 1 << 21
        self.first[keys[at_root]] = to[at_root]
        # Edges by a hash of their key, in the next free slot; three of four are free.
        self.bits = (4 * len(keys) - 1).bit_length()
        self.slot_key = np.full(1 << self.bits, -1)
        self.slot_to = np.full(1 << self.bits, -1)
        slot = self.slot(keys)
        while len(keys):
            free = np.flatnonzero(self.slot_key[slot] < 0)
            won = free[np.unique(slot[free], return_index=True)[1]]
            self.slot_key[slot[won]], self.slot_to[slot[won]] = keys[won], to[won]
            keys, to, slot = (np.delete(x, won) for x in (keys, to, slot))
            slot = slot + 1 & (1 << self.bits) - 1

    def slot(self, keys: np.ndarray) -> np.ndarray:
        """Where an edge is looked for first."""
        return (keys.view(np.uint64) * SPREAD >> np.uint64(64 - self.bits)).view(np.int64)

    def child(self, node: np.ndarray, code: np.ndarray) -> np.ndarray:
        """The node after ``node`` by a character, -1 if there is none."""
        keys = node << 21 | code
        slot = self.slot(keys)
        held = self.slot_key[slot]
        other = held != keys
        out = self.slot_to[slot]
        out[other] = -1
        again = np.flatnonzero(other & (held >= 0))
        slot = slot[again]
        while len(again):
            slot = slot + 1 & (1 << self.bits) - 1
            held = self.slot_key[slot]
            same = held == keys[again]
            out[again[same]] = self.slot_to[slot[same]]
            on = ~same & (held >= 0)
            again, slot = again[on], slot[on]
        return out

    def arcs(self, codes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
        """(from, to, piece) by position in ``codes``; piece -1 spells one character.

        ``ends`` has, for each position, the end of its word."""
        node = self.first[codes]
        start = np.flatnonzero(node >= 0)
        node = node[start]
        out = []
        for length in range(1, self.longest + 1):
            piece = self.piece_at[node]
            whole = piece >= 0
            out.append((start[whole], start[whole] + length, piece[whole]))
            inside = np.flatnonzero(self.inner[node])
            inside = inside[start[inside] + length < ends[start[inside]]]
            start, node = start[inside], node[inside]
            if not len(start):
                break
            node = self.child(node, codes[start + length])
            found = np.flatnonzero(node >= 0)
            start, node = start[found], node[found]
        lonely = np.ones(len(codes), bool)
        lonely[out[0][0]] = False
        spelled = np.flatnonzero(lonely)
        out.append((spelled, spelled + 1, np.full(len(spelled), -1)))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))

    def draw(
        self, words: list[str], word_of: np.ndarray, keys: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pieces for every occurrence: (ids, pieces per occurrence, log probability).

        ``word_of`` numbers the word of each occurrence, ``keys`` holds its unsigned
        64-bit key. A spelled character is given as -1 - its code."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = codes.astype(np.int64)
        last = np.cumsum(sizes)
        first = last - sizes
        start, end, piece = self.arcs(codes, np.repeat(last, sizes))
        # Position p of word w is node p + w, so that every word has a node at its end.
        word = np.repeat(np.arange(len(words)), sizes)[start]
        depth = end - first[word]
        # By depth, then end, then length: no two arcs are alike.
        order = np.argsort((depth * (len(codes) + 1) + end) * (self.longest + 1) + end - start)
        start, end, piece, word, depth = (x[order] for x in (start, end, piece, word, depth))
        tail, head = start + word, end + word
        new = np.ones(len(head), bool)
        new[1:] = head[1:] != head[:-1]
        group = np.cumsum(new) - 1
        edge = np.append(np.flatnonzero(new), len(head))
        total = np.zeros(len(codes) + len(words))
        share = np.empty(len(head))
        bounds = np.searchsorted(depth, np.arange(1, sizes.max(initial=0) + 2))
        # A spelled character costs one byte piece per byte.
        cost = self.log_p[piece]
        wide = np.flatnonzero(piece < 0)
        code = codes[start[wide]]
        bytes_used = 1 + (code > 0x7F).astype(int) + (code > 0x7FF) + (code > 0xFFFF)
        cost[wide] *= bytes_used
        for low, high in zip(bounds[:-1], bounds[1:], strict=True):
            if low == high:
                continue
            weight = total[tail[low:high]] + cost[low:high]
            cuts = edge[group[low] : group[high - 1] + 1] - low
            most = np.maximum.reduceat(weight, cuts)
            own = group[low:high] - group[low]
            scaled = np.exp(weight - most[own])
            mass = np.add.reduceat(scaled, cuts)
            total[head[low + cuts]] = most + np.log(mass)
            share[low:high] = scaled / mass[own]
        upto = np.cumsum(share)
        upto -= np.concatenate(([0.0], upto))[edge[:-1]][group]  # within each node
        place = group + np.minimum(upto, 1.0)
        group_of = np.full(len(total), -1)
        group_of[head[new]] = group[new]

        # Occurrences of a word walk side by side, through the same few nodes.
        lane = np.argsort(word_of, kind="stable")
        node = (last + np.arange(len(words)))[word_of[lane]]
        stop = first + np.arange(len(words))
        log_p = np.zeros(len(word_of))
        count = np.zeros(len(word_of), np.int64)
        taken = []
        step = 0
        while len(lane):
            mixed = splitmix(keys[lane] + np.uint64(step * STEP & (1 << 64) - 1))
            own = group_of[node]
            aim = own + mixed * UNIT
            arc, final = edge[own], edge[own + 1] - 1
            # The first arc of the node that reaches its aim, else the last; nodes have few.
            open_ = np.flatnonzero(arc < final)
            while len(open_):
                open_ = open_[place[arc[open_]] < aim[open_]]
                arc[open_] += 1
                open_ = open_[arc[open_] < final[open_]]
            log_p[lane] += np.log(share[arc])
            taken.append((lane, np.where(piece[arc] < 0, -1 - codes[start[arc]], piece[arc])))
            count[lane] += 1
            node = tail[arc]
            going = node != stop[word_of[lane]]
            lane, node = lane[going], node[going]
            step += 1
        # The last piece was drawn first.
        behind = np.cumsum(count)
        ids = np.empty(int(behind[-1]) if len(behind) else 0, np.int64)
        for step, (lane, chosen) in enumerate(taken):
            ids[behind[lane] - 1 - step] = chosen
        return ids, count, log_p

    def encode(
        self, texts: list[str | None], keys: list[int | None], seed: int = SEED
    ) -> list[tuple[np.ndarray, float] | None]:
        """Ids and log probability of a drawn segmentation of each text."""
        number: defaultdict[str, int] = defaultdict()
        number.default_factory = number.__len__
        word_of, sizes = [], []
        for text in texts:
            words = []
            if text:
                text = text.replace(MARK, LITERAL).replace(" ", MARK)
                words = WORD.findall(MARK + text)
            word_of.extend(map(number.__getitem__, words))
            sizes.append(len(words))
        # A missing key counts as one of its own.
        rows = np.array([(-1 << 62) if k is None else k for k in keys], np.int64).view(np.uint64)
        rows = splitmix(rows ^ splitmix(np.array([seed], np.uint64)))
        nth = np.concatenate([np.arange(n) for n in sizes]) if sizes else np.zeros(0)
        own = splitmix(np.repeat(rows, sizes) + splitmix(nth.astype(np.uint64)))
        ids, count, log_p = self.draw(list(number), np.array(word_of, np.int64), own)
        piece_ends = np.concatenate(([0], np.cumsum(count)))
        ends = np.cumsum(sizes)
        out = []
        for text, end, n in zip(texts, ends.tolist(), sizes, strict=True):
            own = ids[piece_ends[end - n] : piece_ends[end]]
            spelled = own < 0
            if spelled.any():
                short = spelled & (own >= -128)  # one byte each
                own[short] = self.byte_id[-1 - own[short]]
                if short.sum() < spelled.sum():
                    own = self.spelled(own)
            # Summed row by row, so that the sum does not follow from the chunk.
            total = math.fsum(log_p[end - n : end].tolist())
            out.append(None if text is None else (own.astype(np.int32), total))
        return out

    def spelled(self, ids: np.ndarray) -> np.ndarray:
        out: list[int] = []
        for i in ids.tolist():
            if i >= 0:
                out.append(i)
            else:
                char = chr(-1 - i)
                out += self.byte_id[list((MARK if char == LITERAL else char).encode())].tolist()
        return np.array(out, np.int64)

    def decode(self, ids: list[int]) -> str:
        """The text, exactly, of ids that ``encode`` gave."""
        return b"".join(map(self.spelling.__getitem__, ids))[1:].decode()

    def decode_all(self, ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """UTF-8 of all texts in a row, and where each ends; text i is spelled by the
        ids up to ``ends[i]``."""
        sizes = self.piece_size[ids]
        upto = np.concatenate(([0], np.cumsum(sizes)))
        step = np.ones(int(upto[-1]), np.int64)
        if len(ids):
            first = self.piece_start[ids]
            step[0] = first[0]
            step[upto[1:-1]] = first[1:] - first[:-1] - sizes[:-1] + 1
        data = self.piece_bytes[np.cumsum(step)]
        starts = np.concatenate(([0], ends[:-1]))
        spaces = upto[starts[starts < ends]]  # every text begins with a space of its own
        text_ends = upto[ends] - np.cumsum(starts < ends)
        return np.delete(data, spaces), text_ends


@functools.cache
def lattice(path: str, theta: float) -> PieceLattice:
    return PieceLattice(path, theta)


def encode_sampled(
    df: DataFrame,
    model: str = MODEL,
    theta: float = THETA,
    seed: int = SEED,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, text, ids and log_prob (natural logarithm) for every row.

    The segmentation follows from ``seed``, the id and the text alone, so repeated
    rows give repeated results; rows with a null id share one key. A null text has
    null ids, an empty one none. An empty table gives an empty result; columns other
    than the two named are ignored. Texts are read whole, without a shuffle.
    """

    def run(batches):
        own = lattice(public_tokenizers.path(model), theta)
        for batch in batches:
            for piece in by_chunks(batch, "text", CHUNK_BYTES):
                found = own.encode(piece.column(1).to_pylist(), piece.column(0).to_pylist(), seed)
                ids = pa.array([x and x[0] for x in found], pa.list_(pa.int32()))
                log_prob = pa.array([x and x[1] for x in found], pa.float64())
                yield pa.RecordBatch.from_arrays(
                    [*piece.columns, ids, log_prob], ["doc_id", "text", "ids", "log_prob"]
                )

    own = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return own.mapInArrow(run, "doc_id long, text string, ids array<int>, log_prob double")


def decoded(df: DataFrame, model: str = MODEL, theta: float = THETA) -> DataFrame:
    """``df`` (doc_id, text, ids, log_prob) with decoded and ids_crc32, the checksum
    of the ids as little-endian unsigned 32-bit integers. Null ids give nulls."""

    def run(batches):
        own = lattice(public_tokenizers.path(model), theta)
        for batch in batches:
            for piece in by_chunks(batch, "text", CHUNK_BYTES):
                lists = piece.column(2)
                ids = lists.flatten().to_numpy().astype("<u4")
                valid = lists.is_valid()
                sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy().astype(np.int64)
                ends = np.cumsum(sizes)
                data, text_ends = own.decode_all(ids, ends)
                offsets = np.concatenate(([0], text_ends)).astype(np.int32)
                texts = pa.StringArray.from_buffers(
                    len(sizes), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))
                )
                sums = [zlib.crc32(ids[e - n : e]) for e, n in zip(ends.tolist(), sizes.tolist())]
                nothing = pa.scalar(None)
                yield pa.RecordBatch.from_arrays(
                    [
                        *piece.columns,
                        pc.if_else(valid, texts, nothing.cast(pa.string())),
                        pc.if_else(valid, pa.array(sums, pa.int64()), nothing.cast(pa.int64())),
                    ],
                    [*piece.schema.names, "decoded", "ids_crc32"],
                )

    kinds = "doc_id long, text string, ids array<int>, log_prob double"
    return df.mapInArrow(run, f"{kinds}, decoded string, ids_crc32 long")
