"""A shard of token ids as a wavelet matrix in one compressed file.

Ids are numbers of ``n_planes`` bits. Plane 0 holds the highest bit of every id in
the order of the text; each further plane holds the next bit, after all ids whose bit
was 0 were moved, in their order, before those whose bit was 1. Every plane is cut
into blocks that are compressed one by one, and a directory keeps the ones before
each block. So the place of an id in the next plane is a rank query, which opens one
block, and the way back is a select query:

- ``access`` follows one position down the planes and reads its bits,
- ``count`` follows the two ends of a range down the bits of a token,
- ``positions`` follows the occurrences of a token up again.

File: header, documents (ids and sizes), blocks of all planes, directory, its size.
All integers are little-endian.
"""

from __future__ import annotations

import struct
from collections import OrderedDict
from typing import BinaryIO

import numpy as np
import zstandard

MAGIC = b"flwavlt1"
HEADER = struct.Struct("<8sQQQII")  # magic, ids, documents, bytes of documents, planes, bits of a block
BLOCK_BITS = 1 << 16
LEVEL = 1
CACHED_BLOCKS = 64


def packed(data: bytes) -> bytes:
    """``data`` compressed, or as it is if that is no shorter."""
    small = zstandard.ZstdCompressor(level=LEVEL).compress(data)
    return small if len(small) < len(data) else data


def unpacked(data: bytes, size: int) -> bytes:
    if len(data) == size:
        return data
    return zstandard.ZstdDecompressor().decompress(data, max_output_size=size)


def write_shard(file: BinaryIO, ids: np.ndarray, doc_ids: list[int | None], sizes: np.ndarray) -> None:
    """``ids`` of documents one after the other; a document id may be null."""
    n, block_bytes = len(ids), BLOCK_BITS // 8
    n_planes = max(1, int(ids.max()).bit_length()) if n else 1
    values = ids.astype(np.uint16 if n_planes <= 16 else np.uint32)
    docs = b"".join([
        np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
        np.array([d is None for d in doc_ids], np.uint8).tobytes(),
        sizes.astype("<i8").tobytes(),
    ])
    small = packed(docs)
    file.write(HEADER.pack(MAGIC, n, len(doc_ids), len(small), n_planes, BLOCK_BITS))
    file.write(small)
    ones, lengths = [], []
    for plane in reversed(range(n_planes)):
        bits = (values >> plane) & 1 == 1
        data = np.packbits(bits, bitorder="little").tobytes()
        for start in range(0, len(data), block_bytes):
            raw = data[start : start + block_bytes]
            block = packed(raw)
            file.write(block)
            lengths.append(len(block))
            ones.append(int(np.bitwise_count(np.frombuffer(raw, np.uint8)).sum()))
        if plane:
            values = np.concatenate([values[~bits], values[bits]])
    directory = np.array([ones, lengths], "<u4").tobytes()
    small = packed(directory)
    file.write(small)
    file.write(struct.pack("<Q", len(small)))


class Shard:
    """Reads a shard from a seekable file; blocks are opened when they are needed."""

    def __init__(self, file: BinaryIO):
        self.file = file
        header = HEADER.unpack(self._read(0, HEADER.size))
        magic, self.n, self.n_docs, self._docs_bytes, self.n_planes, self.block_bits = header
        if magic != MAGIC:
            raise ValueError("not a shard of token ids")
        self.block_bytes = self.block_bits // 8
        self.n_blocks = -(-self.n // self.block_bits)
        end = file.seek(0, 2) - 8
        (size,) = struct.unpack("<Q", self._read(end, 8))
        whole = unpacked(self._read(end - size, size), 8 * self.n_planes * self.n_blocks)
        ones, lengths = np.frombuffer(whole, "<u4").astype(np.int64).reshape(2, self.n_planes, -1)
        # Ones before each block of a plane, and those of the whole plane.
        self.ones = np.concatenate([np.zeros((self.n_planes, 1), np.int64), ones.cumsum(axis=1)], axis=1)
        self.zeros = self.n - self.ones[:, -1]
        ends = lengths.ravel().cumsum()
        first = HEADER.size + self._docs_bytes
        self.starts = (first + ends - lengths.ravel()).reshape(self.n_planes, -1)
        self.lengths = lengths
        self._open: OrderedDict[tuple[int, int], bytes] = OrderedDict()

    def _read(self, start: int, size: int) -> bytes:
        self.file.seek(start)
        return self.file.read(size)

    def documents(self) -> tuple[list[int | None], np.ndarray]:
        """Ids of the documents and how many tokens each has."""
        n = self.n_docs
        data = unpacked(self._read(HEADER.size, self._docs_bytes), 17 * n)
        ids = np.frombuffer(data, "<i8", n).tolist()
        null = np.frombuffer(data, np.uint8, n, 8 * n)
        for i in np.flatnonzero(null).tolist():
            ids[i] = None
        return ids, np.frombuffer(data, "<i8", n, 9 * n)

    def _block(self, plane: int, block: int) -> bytes:
        data = self._open.get((plane, block))
        if data is None:
            raw = self._read(int(self.starts[plane, block]), int(self.lengths[plane, block]))
            size = min(self.block_bytes, -(-self.n // 8) - block * self.block_bytes)
            data = self._open[plane, block] = unpacked(raw, size)
            if len(self._open) > CACHED_BLOCKS:
                self._open.popitem(last=False)
        return data

    def _ones_before(self, plane: int, position: int) -> int:
        block, rest = divmod(position, self.block_bits)
        count = int(self.ones[plane, block])
        if rest:
            data = np.frombuffer(self._block(plane, block), np.uint8)
            count += int(np.bitwise_count(data[: rest // 8]).sum())
            if rest % 8:
                count += (int(data[rest // 8]) & ((1 << rest % 8) - 1)).bit_count()
        return count

    def _down(self, plane: int, position: int, bit: int) -> int:
        """Where ids with ``bit`` that lie before ``position`` end in the next plane."""
        ones = self._ones_before(plane, position)
        return int(self.zeros[plane]) + ones if bit else position - ones

    def _up(self, plane: int, places: np.ndarray, bit: int) -> np.ndarray:
        """Positions in ``plane`` of ids with ``bit``, from their places in the next one."""
        if bit:
            ranks, before = places - self.zeros[plane], self.ones[plane]
        else:
            ranks = places
            before = np.arange(self.n_blocks + 1) * self.block_bits - self.ones[plane]
        block = np.searchsorted(before, ranks, side="right") - 1
        out = np.empty_like(ranks)
        for number in np.unique(block).tolist():
            own = block == number
            data = np.frombuffer(self._block(plane, number), np.uint8)
            count = min(self.block_bits, self.n - number * self.block_bits)
            bits = np.unpackbits(data, count=count, bitorder="little")
            found = np.flatnonzero(bits == bit)
            out[own] = number * self.block_bits + found[ranks[own] - before[number]]
        return out

    def _bit(self, token: int, plane: int) -> int:
        return token >> (self.n_planes - 1 - plane) & 1

    def access(self, position: int) -> int:
        """The token at a position."""
        if not 0 <= position < self.n:
            raise IndexError(position)
        token = 0
        for plane in range(self.n_planes):
            block, rest = divmod(position, self.block_bits)
            bit = self._block(plane, block)[rest // 8] >> rest % 8 & 1
            token = token << 1 | bit
            position = self._down(plane, position, bit)
        return token

    def _range(self, token: int, start: int, stop: int) -> tuple[int, int]:
        if not 0 <= token < 1 << self.n_planes:
            return 0, 0
        for plane in range(self.n_planes):
            if start == stop:
                break
            bit = self._bit(token, plane)
            start, stop = self._down(plane, start, bit), self._down(plane, stop, bit)
        return start, stop

    def count(self, token: int, start: int = 0, stop: int | None = None) -> int:
        """Occurrences of a token among positions ``start : stop``."""
        first, last = self._range(token, start, self.n if stop is None else stop)
        return last - first

    def positions(self, token: int, first: int = 0, last: int | None = None) -> np.ndarray:
        """Positions of the occurrences ``first : last`` of a token, counted from 0."""
        start, stop = self._range(token, 0, self.n)
        stop = stop if last is None else min(stop, start + last)
        places = np.arange(start + first, max(stop, start + first))
        for plane in reversed(range(self.n_planes)):
            if not len(places):
                break
            places = self._up(plane, places, self._bit(token, plane))
        return places

    def ids(self) -> np.ndarray:
        """All tokens in order."""
        values = np.zeros(self.n, np.uint16 if self.n_planes <= 16 else np.uint32)
        for plane in reversed(range(self.n_planes)):
            blocks = b"".join(self._block(plane, b) for b in range(self.n_blocks))
            bits = np.unpackbits(
                np.frombuffer(blocks, np.uint8), count=self.n, bitorder="little"
            ).view(bool)
            zeros = int(self.zeros[plane])
            before = np.empty_like(values)
            before[~bits] = values[:zeros]
            before[bits] = values[zeros:] | values.dtype.type(1 << (self.n_planes - 1 - plane))
            values = before
        return values.astype(np.uint32)
