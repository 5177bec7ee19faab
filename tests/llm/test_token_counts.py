from __future__ import annotations

import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fareloom.llm import token_counts as T

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)

HARD = [
    "it's we're they'd I'll 'rx ''s !'s 's' 'l 'v've' don't''t  a'",
    "<|endoftext|>x<|startoftext|><|endoftext|",
    "İstanbul ΣΑΣ ß ǅ é é Å ﬁ ½ ² ٣ 12३",
    "日本語テキスト 한국어 各 한",
    "\x1c\x1d a\x85b c d​e ­x",
    "😀👍🏽 ȩ́ ́x",
    "",
    "a" * 5000,
    "'",
    "'r",
    "'re'",
    "''''s",
    "x'S Y'LL",
]


def library(texts):
    return [len(LIBRARY.encode(t, add_special_tokens=False).ids) for t in texts]


def test_hard_texts():
    assert T.counter(PATH).count(HARD).tolist() == library(HARD)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("abrelsv'’’' .1é9ßΣ\ń中|<>x") | st.characters(), max_size=80)))
def test_any_text(texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts] + ["x"]
    assert T.counter(PATH).count(texts).tolist() == library(texts)


def test_states_are_made_anew(monkeypatch):
    monkeypatch.setattr(T, "MAX_STATES", 50)
    monkeypatch.setattr(T, "MAX_WORDS", 20)
    words = [" ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}ing" for i in range(300))]
    assert T.TokenCounter(PATH).count(words).tolist() == library(words)


def test_scan_equals_reading_in_order():
    splitter = T.Splitter()
    c = T.counter(PATH)
    text = "I'll say 'rx''s 42, don't!'s " * 40
    c.count([text])
    classes = c.classes[c._codes([text])]
    starts, state = [False] * len(classes), T.FREE
    for i, k in enumerate(classes):
        mark = splitter.begins[state * T.N_CLASSES + k]
        starts[i] |= bool(mark & 1)
        if mark & 2:
            starts[i - 1] = True
        state = splitter.follow[state * T.N_CLASSES + k]
    assert splitter.word_starts(classes).tolist() == starts


def test_rows(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    wanted = {r.doc_id: r.text for r in docs.collect()}
    got = {r.doc_id: r for r in T.token_counts(docs).collect()}
    counts = dict(zip(wanted, library(wanted.values())))
    assert {i: r.n_tokens for i, r in got.items()} == counts
    assert all(r.n_bytes == len(wanted[i].encode()) for i, r in got.items())
    assert all(r.over_limit == (r.n_tokens > 2048) for r in got.values())


def test_edge_rows(spark):
    rows = [(None, "a b"), (1, None), (2, ""), (3, "long " * 50_000), (3, "long " * 50_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_tokens", F.lit("x"))
    got = sorted((r.doc_id or 0, r.n_bytes, r.n_tokens, r.over_limit) for r in T.token_counts(df).collect())
    assert got == [
        (0, 3, 2, False),
        (1, 0, 0, False),
        (2, 0, 0, False),
        (3, 250_000, 50_000, True),
        (3, 250_000, 50_000, True),
    ]
    assert T.token_counts(df.limit(0)).count() == 0
