from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from fareloom.llm import context_mixing as M


def brute(rows):
    """The fixed columns of the contract, in plain Python."""

    def toks(text):
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        return [*re.findall(r"[^\x20\x09-\x0D]+", low), "\n"]

    out_fold = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in rows}
    count = Counter(w for i, t in rows if not out_fold[i] for w in toks(t))
    n, v = sum(count.values()), len(count)
    found = {}
    for i, text in rows:
        ws = toks(text)
        base = sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws)
        found[i] = (out_fold[i], len(ws), sum(count[w] > 0 for w in ws), n, base)
    return found


@pytest.fixture(scope="module")
def rows():
    random.seed(8)
    parts = ["tion", "er", "ea", "th", "ing", "Est"]
    texts = [
        " ".join("".join(random.choices(parts, k=random.choice([1, 1, 2, 3]))) for _ in range(random.randrange(60)))
        for _ in range(240)
    ]
    return list(enumerate(texts))


def test_fixed_columns_equal_brute_force(spark, rows):
    df = spark.createDataFrame([(*r, "k") for r in rows], "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in M.scores(df).collect()}
    wanted = brute(rows)
    assert got.keys() == wanted.keys()
    for i, (out, n, known, train, base) in wanted.items():
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (out, n, known, train)
        assert math.isclose(r.base_score, base, rel_tol=1e-9)
        assert r.score < 0 and math.isfinite(r.score)
    again = {r.doc_id: r.score for r in M.scores(df.repartition(5)).collect()}
    assert all(math.isclose(again[i], got[i].score, rel_tol=1e-9) for i in got)
    # Far below what the bytes would cost without a model, also on held-out texts.
    bits = [r.bits_per_byte for r in got.values() if r.held_out and r.bits_per_byte]
    assert sum(bits) / len(bits) < 3


def test_held_out_texts_train_nothing(spark, rows):
    changed = [(i, "entirely different qqq" if brute([(i, t)])[i][0] else t) for i, t in rows]
    schema = "doc_id long, text string"
    first, other = (
        {r.doc_id: r for r in M.scores(spark.createDataFrame(t, schema), kind_col=None).collect()}
        for t in (rows, changed)
    )
    assert all(math.isclose(first[i].score, r.score, rel_tol=1e-9) for i, r in other.items() if not r.held_out)


def filled(n_words: int = 40) -> M.Mixer:
    rng = np.random.default_rng(4)
    codes = (M.Code.of_counts([3 + i * i for i in range(n_words)]), M.Code.of_counts([1 + i % 7 for i in range(257)]))
    mixer = M.Mixer.empty(codes, M.bits_for(500, 100))
    mixer.counts[:] = rng.integers(0, 2**16, len(mixer.counts))
    mixer.weights = rng.normal(0, 0.4, mixer.weights.shape).astype(np.float32)
    mixer.last = rng.uniform(0.01, 0.99, mixer.last.shape).astype(np.float32)
    return mixer


@pytest.mark.parametrize("code", [0, 1])
def test_symbols_are_a_distribution(code):
    mixer = filled()
    n = len(mixer.codes[code].lengths)
    contexts = np.repeat(np.arange(5, 5 + M.PREDICTORS, dtype=np.uint64)[:, None], n, axis=1)
    p = np.exp(mixer.log_prob(M.Run(code, np.arange(n), contexts)))
    assert math.isclose(p.sum(), 1.0, rel_tol=1e-4)


def test_codes_are_free_of_prefixes_and_shortest():
    counts = [50, 20, 15, 10, 5]
    code = M.Code.of_counts(counts)
    assert code.lengths.tolist() == [1, 2, 3, 4, 4]
    owner, depth, node, bit = code.bits(np.array([3, 0, 3]))
    assert owner.tolist() == [0] * 4 + [1] + [2] * 4
    assert depth.tolist() == [0, 1, 2, 3, 0, 0, 1, 2, 3]
    assert node[0] == node[4] == node[5] and bit[0] != bit[4]


def test_probability_of_a_symbol_by_plain_arithmetic():
    mixer = filled()
    symbols = np.array([7, 39, 0, 7])
    run = M.word_run(symbols, np.array([2, 2, 1, 0]), np.array([4]), 38)
    got = mixer.log_prob(run)
    wide, code = 2**64, mixer.codes[0]
    for t, symbol in enumerate(symbols.tolist()):
        total, start = 0.0, code.starts[symbol]
        for depth in range(code.lengths[symbol]):
            node, bit = int(code.nodes[start + depth]), int(code.taken[start + depth])
            offset, odds, sure = 0, [], []
            for i in range(M.PREDICTORS):
                value = (int(run.contexts[i][t]) ^ (node * int(M.NODE) % wide)) * int(M.SPIN) % wide
                slot = int(mixer.counts[offset + (value >> (64 - mixer.table_bits[i]))])
                zeros, ones = slot % 256, slot // 256
                odds.append(math.log((ones + 0.4) / (zeros + 0.4)))
                sure.append(sum(zeros + ones >= x for x in (1, 4, 31)))
                offset += 1 << mixer.table_bits[i]
            stage = min(depth, M.DEPTHS - 1)
            gate = (stage * 4 + sure[-2]) * 4 + sure[-1]
            link = sum(float(w) * x for w, x in zip(mixer.weights[:, gate], [*odds, 1.0], strict=True))
            link = max(-M.REACH, min(M.REACH, link))
            at = round((link + M.REACH) / (2 * M.REACH) * (M.BUCKETS - 1))
            p = (1 / (1 + math.exp(-link)) + float(mixer.last[stage * M.BUCKETS + at])) / 2
            total += math.log(p if bit else 1 - p)
        assert math.isclose(got[t], total, rel_tol=1e-4)


def test_mixing_learns():
    random.seed(6)
    rng = np.random.default_rng(6)
    symbols = np.repeat(rng.integers(0, 20, 4000) * 2, 2)
    symbols[1::2] += 1  # every even word is followed by its odd one
    mixer = M.Mixer.empty((M.Code.of_counts([1] * 41), M.Code.of_counts([1] * 257)), M.bits_for(8000, 41))
    run = lambda s: M.word_run(s, np.zeros(len(s), np.int64), np.array([len(s)]), 40)
    learned, fresh = run(symbols[:6000]), run(symbols[6000:])
    slots, _, _, bit = mixer.slots(learned)
    both = np.zeros(2 * len(mixer.counts), np.int64)
    np.add.at(both, (2 * slots + bit).ravel(), 1)
    mixer.counts = M.slot_of(both[0::2], both[1::2])
    before = mixer.log_prob(fresh).sum()
    seen = np.zeros((2, mixer.last.size))
    for _ in range(3):
        for part in learned.batches(256):
            mixer.learn(part, 0.02, seen)
    mixer.last = ((seen[1] + M.PRIOR * mixer.last) / (seen[0] + M.PRIOR)).astype(np.float32)
    after = mixer.log_prob(fresh)
    assert after.sum() > before
    assert after[1::2].mean() > -0.1 and -3.5 < after[::2].mean() < -2.9


def test_slots_keep_the_share_of_ones():
    zeros, ones = np.array([0, 3, 255, 256, 10**6, 5]), np.array([0, 0, 255, 1, 10**9, 10**6])
    got = M.slot_of(zeros, ones)
    assert (got % 256).tolist() == [0, 3, 255, 255, 1, 1]
    assert (got // 256).tolist() == [0, 0, 255, 1, 255, 255]


def test_score_equals_codes_letters_and_counts(spark, rows):
    """Rows without coded words: the score by the operator against its parts added up."""
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.score for r in M.scores(df, kind_col=None).collect()}
    docs = df.select("doc_id", "text", F.lit(None).cast("string").alias("kind"))
    docs, kinds = M.with_kind(docs)
    words = M.vocabulary(docs, kinds)
    count = {bytes(r.word): r.c for r in words.collect()}
    n, v = sum(count.values()), len(count)
    told, codes = M.frequent(words, n, v, [n])
    training = M.dealt(docs, 1)
    mixer = M.Mixer.empty(codes, M.bits_for(n, v))
    mixer.counts = M.slot_counts(training, told, mixer)
    mixer.weights, mixer.last = M.refined(training, told, mixer)
    rare = {w: c for w, c in count.items() if w not in told.symbols}
    rare_n = sum(rare.values())
    assert rare_n == told.escaped
    for i, text in rows:
        one = M.Passage.of_texts([text.encode()], told)
        total = mixer.log_prob(one.words)[one.each].sum() / math.log(10)
        letters = mixer.log_prob(one.letters) / math.log(10)
        ends = np.cumsum(one.letter_sizes)
        for place, which in zip(one.places.tolist(), one.which.tolist(), strict=True):
            spelled = letters[ends[which] - one.letter_sizes[which] : ends[which]].sum()
            share = max(rare.get(one.flat[place], 0) - 0.5, 0) / rare_n
            total += math.log10(share + 10**spelled * 0.5 * len(rare) / rare_n)
        assert math.isclose(got[i], total, rel_tol=1e-5)


def test_edge_rows(spark):
    table = [(None, "a b"), (1, None), (2, ""), (3, "Word " * 50_000), (4, "x" * 100_000), (4, "y"), (4, "y")]
    df = spark.createDataFrame(table, "doc_id long, text string").withColumns(
        {"score": F.lit("x"), "lang": F.when(F.col("doc_id") > 2, "en")}
    )
    got = sorted((r.doc_id or 0, r.n_tokens, r.bits_per_byte is None) for r in M.scores(df).collect())
    assert got == [
        (0, 3, False), (1, 1, True), (2, 1, True), (3, 50_001, False), (4, 2, False), (4, 2, False), (4, 2, False),
    ]
    assert M.scores(df.limit(0)).count() == 0


def test_kinds_of_texts_raise_the_score(spark):
    random.seed(12)
    own = {k: [f"{k}{c}{d}" for c in "abcdefgh" for d in "uvwxyz"] for k in "pq"}
    rows = [
        (i, " ".join(random.choices(own["pq"[i % 2]], k=40)), "pq"[i % 2] if i % 3 else None)
        for i in range(300)
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    total = {}
    for name in ("lang", None):
        found = M.scores(df, kind_col=name).filter("held_out").agg(F.sum("score"), F.sum("base_score"))
        total[name] = found.first()
    assert total["lang"][0] > total[None][0]
    assert total["lang"][0] > total["lang"][1]


def test_the_order_of_words_counts(spark):
    """Texts of the same words in their usual order score higher than out of order."""
    random.seed(3)
    names = [f"w{i}" for i in range(40)]
    text = lambda: " ".join(n for i in random.choices(range(0, 38, 2), k=25) for n in names[i : i + 2])
    held = [i for i in range(1000) if M.fold(i) == M.HELD_OUT]
    rows = [(i, text()) for i in range(400) if i not in held]
    usual = text()
    mixed = usual.split()
    random.shuffle(mixed)
    df = spark.createDataFrame([*rows, (held[0], usual), (held[1], " ".join(mixed))], "doc_id long, text string")
    got = {r.doc_id: r for r in M.scores(df, kind_col=None).collect()}
    a, b = got[held[0]], got[held[1]]
    assert math.isclose(a.base_score, b.base_score, rel_tol=1e-9)
    assert a.score > b.score + 10
    assert a.score > a.base_score + 10


def test_segments_of_counts_come_back():
    counts = np.random.default_rng(1).integers(0, 2**32, M.SEGMENT).astype(np.uint32)
    counts[:60_000] %= 3
    assert np.array_equal(M.unpressed(M.pressed(counts)), counts)


def test_repeated_symbols_are_held_once():
    symbols = np.array([1, 2, 3, 1, 2, 3, 1, 2])
    whole = M.word_run(symbols, np.zeros(8, np.int64), np.array([8]), 40)
    run, which = whole.distinct()
    assert run.times.sum() == 8 and len(run.symbols) == 5  # (.., 1), (1, 2) at the start, then three turns
    assert np.array_equal(run.symbols[which], symbols)
    assert np.array_equal(run.contexts[:, which], whole.contexts)
