from __future__ import annotations

import io
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fareloom.llm import wavelet
from fareloom.llm.token_files import read_token_files, write_token_files
from fareloom.llm.wavelet import Shard, write_shard

LIBRARY = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def library_ids(text):
    return [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 2]


def shard_of(ids, doc_ids=(None,), sizes=None):
    file = io.BytesIO()
    ids = np.array(ids, np.uint32)
    write_shard(file, ids, list(doc_ids), np.array([len(ids)] if sizes is None else sizes))
    return Shard(file)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 70_000) | st.integers(0, 3), max_size=300))
def test_shard_equals_a_list(ids):
    old = wavelet.BLOCK_BITS
    wavelet.BLOCK_BITS = 64  # many blocks
    try:
        shard = shard_of(ids)
    finally:
        wavelet.BLOCK_BITS = old
    assert shard.ids().tolist() == ids
    assert [shard.access(i) for i in range(len(ids))] == ids
    for token in {*ids[:5], 0, 2, 99_999, 1 << 40}:
        places = [i for i, x in enumerate(ids) if x == token]
        assert shard.positions(token).tolist() == places
        assert shard.positions(token, 1, 3).tolist() == places[1:3]
        assert shard.count(token) == len(places)
        a, b = len(ids) // 3, len(ids) - len(ids) // 4
        assert shard.count(token, a, b) == sum(a <= i < b for i in places)


def test_long_shard_opens_few_blocks():
    rng = np.random.default_rng(1)
    ids = (rng.zipf(1.3, 400_000) % 49_000).astype(np.uint32)
    shard = shard_of(ids, [3, None, -5], [100_000, 0, 300_000])
    assert (shard.ids() == ids).all()
    assert shard.documents()[0] == [3, None, -5] and shard.documents()[1].tolist() == [100_000, 0, 300_000]
    shard._open.clear()
    assert shard.access(123_456) == ids[123_456]
    assert len(shard._open) <= 2 * shard.n_planes
    for token in (1, 2, int(ids[-1])):
        assert (shard.positions(token) == np.flatnonzero(ids == token)).all()
    with pytest.raises(IndexError):
        shard.access(len(ids))
    with pytest.raises(ValueError):
        Shard(io.BytesIO(b"x" * 200))


ROWS = [(5, "a b c"), (1, None), (2, ""), (9, "word " * 30_000), (None, "x <|endoftext|> y")]
ROWS += [(3, "It's Zoë"), (3, "It's Zoë"), (3, "other"), (-4, "日本語 naïve")]


@pytest.mark.parametrize("shard_ids", [1 << 21, 7])
def test_files_read_back_whole(spark, tmp_path, shard_ids):
    df = spark.createDataFrame(ROWS, "doc_id long, text string").withColumn("start", F.lit("x"))
    path = str(tmp_path / "files")
    write_token_files(df.repartition(3), path, shard_ids=shard_ids)
    rows = read_token_files(spark, path).orderBy("start").collect()
    assert [r.doc_id for r in rows] == [None, -4, 1, 2, 3, 3, 3, 5, 9]
    assert sorted((r.doc_id or 0, list(r.ids)) for r in rows) == sorted(
        (d or 0, library_ids(t)) for d, t in ROWS
    )
    at = 0
    for r in rows:
        assert (r.start, r.n_tokens) == (at, len(r.ids))
        at += r.n_tokens
    digest = {r.start: r.ids_crc32 for r in read_token_files(spark, path, "digest").collect()}
    assert digest == {r.start: zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in rows}

    whole = [x for r in rows for x in r.ids]
    word = LIBRARY.encode("word").ids[0]
    counts = {r.token: r.n for r in read_token_files(spark, path, "counts", (2, word, 48_000)).collect()}
    assert counts == {t: whole.count(t) for t in (2, word, 48_000)}
    found = read_token_files(spark, path, "occurrences", (2, word)).collect()
    assert sorted((r.token, r.position) for r in found) == sorted(
        (t, i) for i, t in enumerate(whole) if t in (2, word)
    )
    assert {r.doc_id for r in found if r.token == word} == {9}
    some = (0, 3, len(whole) - 1, len(whole), 20_000)
    got = {r.position: r.token for r in read_token_files(spark, path, "positions", some).collect()}
    assert got == {i: whole[i] for i in some if i < len(whole)}
    with pytest.raises(Exception, match="holds token files already"):
        write_token_files(df, path)


def test_empty_table_and_files_of_other_attempts(spark, tmp_path):
    path = str(tmp_path / "none")
    empty = spark.createDataFrame([], "doc_id long, text string")
    write_token_files(empty, path)
    assert read_token_files(spark, path, "digest").collect() == []
    assert read_token_files(spark, path, "counts", (2,)).collect() == []
    path = tmp_path / "files"
    path.mkdir()
    (path / "shard-00000-00000-lost.wavelet").write_bytes(b"half a file")
    write_token_files(spark.createDataFrame(ROWS, "doc_id long, text string"), str(path))
    assert read_token_files(spark, str(path), "digest").count() == len(ROWS)


def test_documents(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    write_token_files(docs, str(tmp_path / "files"))
    got = {r.doc_id: r for r in read_token_files(spark, str(tmp_path / "files"), "digest").collect()}
    at = 0
    for row in docs.orderBy("doc_id").collect():
        ids = library_ids(row.text)
        digest = zlib.crc32(np.array(ids, "<u4").tobytes())
        assert tuple(got[row.doc_id]) == (row.doc_id, at, len(ids), digest)
        at += len(ids)
