from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fareloom.llm import word_ids
from fareloom.llm.packing import Packer, pack
from fareloom.llm.word_ids import WordIds

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)


def library_ids(text):
    return [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 2]


def check_pieces(rows, wanted, window=4096):
    """``wanted``: ids of each document, by number. Padding of all sequences."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for doc_id, start, length, crc, total, sequence, offset in rows:
        ids = wanted[doc_id]
        assert total == len(ids) and length > 0
        assert zlib.crc32(np.array(ids[start : start + length], "<u4").tobytes()) == crc
        by_doc[doc_id].append((start, length))
        by_sequence[sequence].append((offset, length))
    assert set(by_doc) == set(wanted)
    for pieces in (*((p, len(wanted[d])) for d, p in by_doc.items()),):
        at = 0
        for start, length in sorted(pieces[0]):
            assert start == at
            at += length
        assert at == pieces[1]
    padding = 0
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= window
        padding += 0 if at & (at - 1) == 0 else window - at
    return padding


def test_word_ids_equal_the_library():
    texts = [
        "It's a 'test', we'll see: don't''t <|endoftext|>x <|startoftext|> y<|endoftext|>",
        None,
        "",
        "İstanbul ΣΑΣ é ́x 日本語 \x85 z ​😀",
    ]
    ids, ends = WordIds(PATH).encode(texts)
    assert [x.tolist() for x in np.split(ids, ends)[:-1]] == [library_ids(t)[:-1] for t in texts]
    # Tables that are begun anew again and again give the same.
    words = WordIds(PATH, 5)
    for _ in range(2):
        for text in texts:
            ids, ends = words.encode([text, text], 2)
            assert ids.tolist() == 2 * library_ids(text) and ends[0] == len(ids) // 2
    assert words.encode([], 2)[0].tolist() == []


def test_words_with_one_hash_and_long_texts(monkeypatch):
    texts = ["one two", None, "three " * 50 + "x" * 90, "two one", "one"]
    monkeypatch.setattr(word_ids, "SLICE", 40)  # slices end at spaces
    ids, ends = WordIds(PATH).encode(texts, 2)
    assert [x.tolist() for x in np.split(ids, ends)[:-1]] == [library_ids(t) for t in texts]
    monkeypatch.setattr(word_ids, "hashed", lambda data, starts, sizes: sizes.astype(np.uint64) % 2)
    ids, ends = WordIds(PATH).encode(texts, 2)
    assert [x.tolist() for x in np.split(ids, ends)[:-1]] == [library_ids(t) for t in texts]


def test_packer_keeps_every_id_and_pads_nothing():
    random.seed(2)
    for limit in (4, 64):
        packer, wanted = Packer(7, 64, limit), {}
        for i in range(600):
            n = random.choice([1, 2, 33, 40, 63, 64, 65, 200, random.randrange(1, 64)])
            wanted[i] = [random.randrange(50_000) for _ in range(n)]
            packer.add(i, np.array(wanted[i], np.uint32))
            assert packer.n_open <= limit
            assert packer.levels.sum() == packer.n_open
        packer.finish()
        assert check_pieces(packer.done, wanted, 64) == 0


def test_rest_windows_cut_few_documents():
    """Documents that fit a window and still lie in more than one piece."""
    random.seed(3)
    packer, wanted = Packer(0, 4096), {}
    for i in range(3000):
        wanted[i] = [1] * random.choice([random.randrange(50, 400), random.randrange(400, 4000)])
        packer.add(i, np.array(wanted[i], np.uint32))
    packer.finish()
    assert check_pieces(packer.done, wanted) == 0
    pieces = defaultdict(int)
    for row in packer.done:
        pieces[row[0]] += 1
    assert sum(n > 1 for n in pieces.values()) < 0.02 * len(wanted)


def test_level_with_least_sum_of_squares():
    random.seed(4)
    packer = Packer(0, 32)
    for i in range(300):
        size = random.randrange(1, 32)
        best = {}
        for level in [0, *(k for k in range(1, 33 - size) if packer.levels[k])]:
            after = packer.levels.copy()
            after[level] -= level > 0
            after[level + size] += level + size < 32
            best.setdefault(int((after**2).sum()), []).append(level)
        assert packer.level_for(size) in best[min(best)]
        packer.add(i, np.zeros(size, np.uint32))


def test_pack_edge_rows(spark):
    rows = [(1, None), (2, ""), (3, "word " * 30_000), (4, "a b c"), (5, "short one"), (6, "short one")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("start", F.lit("x"))
    got = [tuple(r) for r in pack(df.coalesce(2)).collect()]
    assert check_pieces(got, {i: library_ids(t) for i, t in rows}) == 0
    twice = spark.createDataFrame([(1, "a"), (1, "a"), (None, "b")], df.select("doc_id", "text").schema)
    got = sorted((r.doc_id or 0, r.length, r.doc_tokens) for r in pack(twice).collect())
    assert got == [(0, 2, 2), (1, 2, 2), (1, 2, 2)]
    assert pack(df.limit(0)).count() == 0


def test_pack_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    wanted = {r.doc_id: library_ids(r.text) for r in docs.select("doc_id", "text").collect()}
    rows = [tuple(r) for r in pack(docs).collect()]
    assert check_pieces(rows, wanted) == 0
