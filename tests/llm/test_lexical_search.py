from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from fareloom.llm import lexical_search
from fareloom.llm.lexical_search import ranked_search, terms_of

RUN = re.compile("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+")


def terms(text):
    return RUN.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def brute(rows, items, k=10):
    bags = [(d, Counter(terms(t))) for d, t in rows]
    bags = [(d, b) for d, b in bags if b]
    size = len(bags)
    total = sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item_id, text in set(items):
        found = []
        for doc_id, bag in bags:
            m = 25 + (75 * sum(bag.values()) * size) // total
            score = 0
            for t in terms(text):
                if t in bag:
                    w = math.floor(1000 * math.log((2 * size + 2) / (2 * df[t] + 1)))
                    score += w * ((10**9 * bag[t]) // (1000 * bag[t] + 8 * m))
            if score > 0 and doc_id is not None:
                found.append((-score, doc_id))
        out += [(item_id, r, d, -s) for r, (s, d) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=repr)


def result(spark, rows, items, parts=4, k=10):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    docs = docs.withColumn("score", F.lit("x")).withColumn("rank", F.lit("y"))
    asked = spark.createDataFrame(items, "item_id long, text string").withColumn("n", F.lit(1))
    return sorted(map(tuple, ranked_search(docs, asked, k).collect()), key=repr)


def corpus(seed, n, kinds):
    random.seed(seed)
    words = ["".join(random.choices("abcdé9", k=4)) for _ in range(kinds)]
    weights = [1 / (i + 1) for i in range(kinds)]
    rows = [(i, " ".join(random.choices(words, weights, k=random.randrange(1, 60)))) for i in range(n)]
    return words, rows


def test_terms():
    random.seed(1)
    pool = [chr(i) for i in range(128)] + ["é", "É", "\x85", " ", "日", "😀", "\xa0"]
    for _ in range(200):
        text = "".join(random.choices(pool, k=60))
        assert [t.decode() for t in terms_of(text)] == terms(text)


@pytest.mark.parametrize("cells, group", [(2_000_000, 8_000_000), (40, 300)])
def test_equals_brute_force(spark, monkeypatch, cells, group):
    """Many copies and many ties; small blocks and groups give the same."""
    monkeypatch.setattr(lexical_search, "CELLS", cells)
    monkeypatch.setattr(lexical_search, "GROUP_BYTES", group)
    words, rows = corpus(2, 250, 80)
    rows += [(1000 - i, rows[3][1].upper()) for i in range(150)]  # one class, a third of all
    rows += [(2000 + i, words[5] + " " + words[6]) for i in range(30)]
    items = [(i, " ".join(random.choices(words, k=random.randrange(1, 9)))) for i in range(9)]
    items += [(50, rows[3][1]), (51, words[5]), (52, f"{words[5]} {words[5]} unheard")]
    assert result(spark, rows, items) == brute(rows, items)


def test_edge_rows(spark):
    rows = [(1, None), (2, ""), (3, "!? \n"), (4, "Alpha beta"), (4, "Alpha beta"), (5, "alpha " * 50_000)]
    rows += [(None, "alpha beta gamma"), (6, "delta"), (7, "delta")]
    items = [(1, "ALPHA"), (1, "ALPHA"), (1, "beta"), (2, None), (3, ""), (4, "..."), (None, "delta")]
    assert result(spark, rows, items) == brute(rows, items)
    assert result(spark, rows, items, k=2) == brute(rows, items, 2)
    assert result(spark, [], items) == []
    assert result(spark, rows, []) == []
    assert result(spark, [(1, "..")], items) == []


def test_equal_bags_are_scored_once(spark):
    """Copies, and texts that differ only in words that no item holds."""
    from fareloom.llm.lexical_search import Items, bag_classes, local_bags

    rows = [(i, f"one two other{i}") for i in range(40)] + [(100 + i, "two two one x") for i in range(9)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    bags = local_bags(df, Items.of([(0, "one two")]).vocabulary, 10)
    classes = bag_classes(bags, 49, 156, 10).collect()
    assert sorted((list(r.tfs), r.ids) for r in classes) == [
        ([1, 1], list(range(10))), ([1, 2], list(range(100, 109))),
    ]


def test_hash_collisions_do_not_merge_classes(spark, monkeypatch):
    monkeypatch.setattr(lexical_search.F, "xxhash64", lambda *c: F.lit(7).cast("long"))
    words, rows = corpus(4, 60, 20)
    items = [(i, " ".join(words[i : i + 3])) for i in range(5)]
    assert result(spark, rows, items) == brute(rows, items)


def test_long_rows_of_ties_go_by_id(spark):
    rows = [(i, "same text") for i in range(300, 0, -1)]
    got = result(spark, [*rows, (999, "text other")], [(7, "same")], parts=7)
    assert [r[2] for r in got if r[1] <= 3] and sorted(r[2] for r in got) == list(range(1, 11))
    assert defaultdict(int, {r[1]: r[2] for r in got}) == {i: i for i in range(1, 11)}
