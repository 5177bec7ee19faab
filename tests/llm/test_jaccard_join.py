from __future__ import annotations

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fareloom.llm import jaccard_join as J
from fareloom.llm.components import connected_components
from fareloom.llm.jaccard_join import Rule, WordHashes, jaccard_components, one_of_each, shingles


def word_sets(text, size):
    words = (text or "").lower().split()
    if not words:
        return frozenset()
    if len(words) < size:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def brute(rows, rule):
    sets = [word_sets(t, rule.words) for _, t in rows]
    group = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and rule.den * len(a & b) >= rule.num * len(a | b) and group[i] != group[j]:
                old, new = max(group[i], group[j]), min(group[i], group[j])
                group = [new if g == old else g for g in group]
    least = {}
    for (i, _), g in zip(rows, group):
        least[g] = min(i, least.get(g, i))
    return sorted((i, len(s), least[g]) for (i, _), s, g in zip(rows, sets, group))


def near_copies(seed, groups=12, upto=120):
    random.seed(seed)
    words = [f"w{i}" for i in range(3000)]
    shared = random.choices(words, k=20)
    rows = []
    for _ in range(groups):
        base = random.choices(words, k=random.randrange(1, upto))
        if random.random() < 0.4:
            base += shared
        rows.append(list(base))
        for _ in range(random.randrange(8)):
            copy = list(random.choice(rows[-8:]))
            for _ in range(random.randrange(1 + len(copy) // 25)):
                at = random.randrange(len(copy))
                copy[at : at + random.randrange(2)] = random.choices(words, k=random.randrange(3))
            rows.append(copy)
    random.shuffle(rows)
    return [(i, " ".join(r)) for i, r in enumerate(rows)]


@pytest.mark.parametrize("rule", [Rule(), Rule(5, 80, 100), Rule(1, 60, 100)])
def test_equals_brute_force(spark, monkeypatch, rule):
    monkeypatch.setattr(J, "BLOCK", 3)
    monkeypatch.setattr(J, "NEAREST", 1)
    rows = near_copies(rule.words, 30)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted(map(tuple, jaccard_components(df, rule).collect())) == brute(rows, rule)


@pytest.mark.parametrize("rule", [Rule(), Rule(5, 80, 100)])
def test_linked_sets_share_a_signature(rule):
    rng = np.random.default_rng(9)
    for size in [*range(1, 60), 100, 333, 1000, 4000]:
        for _ in range(4):
            a = rng.integers(0, 1 << 63, size).astype(np.uint64)
            # The most different set that still links, by loss, gain and exchange.
            for gain in (0.0, 0.5, 1.0):
                b, spent = set(a.tolist()), 0
                for x in a.tolist():
                    spent += 1
                    trial = set(b)
                    if rng.random() < gain:
                        trial.add(int(rng.integers(0, 1 << 63)))
                    else:
                        trial.discard(x)
                    same = len(trial & set(a.tolist()))
                    if not trial or not rule.link(same, size, len(trial)):
                        break
                    b = trial
                c = np.array(sorted(b), np.uint64)
                for common in (np.zeros(0, np.uint64), np.sort(a)[::3]):
                    own = [J.signatures(x, rule, common) for x in (np.sort(a), c)]
                    assert len(np.intersect1d(*own)), (size, len(b))


def test_signatures_of_the_same_sets_count_once(spark):
    """Pairs that shared many signatures were looked at under each of them: in the pipeline
    the join took 2.39 GB of disk on 0.51 GB and was stopped."""
    rows = [(1, list(range(50))), (2, list(range(60))), (2, list(range(60))), (3, [55, 99])]
    signed = spark.createDataFrame(rows, "key long, signatures array<long>").repartition(3)
    got = [(r.s, r.key, r.before) for r in J.sharing(signed).collect()]
    assert len({s for s, _, _ in got}) == 2
    assert sorted((k, b or 0) for _, k, b in got) == [(1, 0), (2, 0), (2, 1), (3, 2)]


def test_signatures_leave_the_disk_when_members_are_known(spark, tmp_path, monkeypatch):
    """They stayed beside the members, as did the shuffle that brought these together."""
    numbers = itertools.count()
    place = lambda _, label: f"{tmp_path}/{label}-{next(numbers)}"
    monkeypatch.setattr("fareloom.llm.common.scratch_path", place)
    df = spark.createDataFrame(near_copies(3, 9), "doc_id long, text string")
    J.linked_sets(df, Rule())
    (left,) = tmp_path.glob("signed*")
    assert spark.read.parquet(str(left)).columns == ["doc_id", "text_hash", "n", "key"]


def test_bitmaps_never_refute_a_link():
    rng = np.random.default_rng(4)
    for size in [*range(1, 40), 63, 64, 65, 500, 5000]:
        a = rng.integers(0, 1 << 63, size).astype(np.uint64)
        b = np.concatenate([a[rng.random(size) > 0.1], rng.integers(0, 1 << 63, size // 8).astype(np.uint64)])
        x, y = J.bitmap(a), J.bitmap(b)
        width = min(len(x), len(y))
        apart = int(np.bitwise_count(J.folded(x, width) ^ J.folded(y, width)).sum())
        assert apart <= len(np.setxor1d(a, b))


def test_chain_whose_ends_do_not_link(spark):
    """Every set links with its neighbours in the chain alone: one long component, and sets
    beside it that share passages but link with none."""
    words = [f"w{i}" for i in range(700)]
    rows = [(i, " ".join(words[3 * i : 3 * i + 100])) for i in range(150)]
    rows += [(500 + i, " ".join(words[40 * i : 40 * i + 50] + [f"x{i}y{k}" for k in range(60)])) for i in range(9)]
    rule = Rule(3, 80, 100)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted(map(tuple, jaccard_components(df, rule).collect()))
    assert got == brute(rows, rule)
    assert len({r[2] for r in got if r[0] < 500}) == 1


def test_common_tokens_are_shared_by_different_sizes(spark):
    line = "one line that many texts of any size hold"
    rows = [(i, " ".join([f"a{i}x{k}" for k in range(5 + 9 * i)] + [line])) for i in range(12)]
    rows += [(20 + i, " ".join(f"copy{k}" for k in range(30)) + f" end{i}") for i in range(9)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("text_hash", F.xxhash64("text"))
    got = J.common_tokens(df, Rule(3, 80, 100))
    assert set(got.tolist()) == set(shingles(line, 3, WordHashes()).tolist())


def test_edge_rows(spark):
    rows = [(7, None), (8, ""), (9, " \n"), (5, "One two"), (3, "one  TWO"), (4, "one"), (None, "one two")]
    rows += [(20, "long text " * 60_000), (21, "long text " * 60_000), (21, "long text " * 60_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_shingles", F.lit("x"))
    got = sorted(((r.doc_id or 0, r.n_shingles, r.component_id) for r in jaccard_components(df).collect()))
    assert got == [
        (0, 1, 3), (3, 1, 3), (4, 1, 4), (5, 1, 3), (7, 0, 7), (8, 0, 8), (9, 0, 9),
        (20, 2, 20), (21, 2, 20), (21, 2, 20),
    ]
    assert jaccard_components(df.limit(0)).count() == 0
    single = one_of_each(df, Rule(5, 80, 100))
    assert single.columns == df.columns
    assert sorted(r.doc_id for r in single.collect()) == [3, 4, 7, 8, 9, 20]
    twins = df.filter("doc_id = 4").withColumn("n_shingles", F.explode(F.array(*map(F.lit, "pqrst"))))
    kept = {one_of_each(twins.repartition(n, "n_shingles"), Rule(5, 80, 100)).first() for n in (1, 4)}
    assert len(kept) == 1


def test_shingles_of_short_texts():
    h = WordHashes()
    assert len(shingles("a b c d", 3, h)) == 2
    assert len(shingles("a b", 3, h)) == 1
    assert shingles("a b", 3, h) != shingles("a", 3, h)
    assert len(shingles(None, 3, h)) == 0


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(0, i) for i in range(1, 50)] + [(7, 8), (70, 70)]
    random.seed(1)
    random.shuffle(edges)
    df = spark.createDataFrame([random.sample(e, 2) for e in edges], "a long, b long")
    got = dict(map(tuple, connected_components(df).collect()))
    assert got == {**{i: 0 for i in range(50)}, **{i: 100 for i in range(100, 161)}}
    assert connected_components(df.limit(0)).count() == 0
