from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from fareloom.llm import spelling
from fareloom.llm.spelling import chunk_counts, spelling_variants

RUN = re.compile("[A-Za-zÀ-ÿ]+")
COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def lower(text):
    return "".join(c.lower() if c.isascii() else c for c in text)


def brute_counts(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in RUN.findall(text or ""):
            word = lower(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if h % 97 == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1 :]
            if len(word) >= 5:
                counts[word] += 1
    return counts


def one_apart(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) + 1 == len(b) and any(a == b[:i] + b[i + 1 :] for i in range(len(b)))


def brute(rows):
    n = {w: c for w, c in brute_counts(rows).items() if c >= 3}
    form, near = {}, {}
    for w in n:
        near[w] = [x for x in n if one_apart(w, x)]
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out)


def result(spark, rows, parts=3):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    df = df.withColumn("word", F.lit("x")).withColumn("n", F.lit(1))
    return sorted(tuple(r[c] for c in COLUMNS) for r in spelling_variants(df).collect())


def test_counts_equal_brute_force():
    random.seed(6)
    letters = "abEZéÀÿ×÷"
    rows = []
    for i in range(400):
        runs = ["".join(random.choices(letters, k=random.choice([1, 3, 5, 6, 9, 70]))) for _ in range(20)]
        rows.append((random.choice([i, None, -i]), random.choice([" ", "1", "ß-", "Ā", "Ł", "\n"]).join(runs)))
    rows += [(1, None), (2, ""), (3, "a" * 5000), (4, "naïve naïve ÉTÉ été")]
    got = chunk_counts([d for d, _ in rows], [t for _, t in rows])
    assert got == brute_counts(rows)


@pytest.mark.parametrize("letters, size", [("ab", (5, 9)), ("abcé", (5, 12)), ("aa", (5, 30))])
def test_equals_brute_force(spark, letters, size):
    """Few letters: many neighbours, equal letters in a row, deep nodes and chains."""
    random.seed(len(letters) + size[1])
    kinds = ["".join(random.choices(letters, k=random.randrange(*size))) for _ in range(160)]
    for word in kinds[:60]:
        at = random.randrange(len(word))
        kinds.append(word[:at] + random.choice(["", "zz"[:1], word[at] * 2]) + word[at + 1 :])
    rows = []
    for i in range(120):
        words = random.choices(kinds, weights=[1 + 30 * (k % 17 == 0) for k in range(len(kinds))], k=25)
        rows.append((i, ", ".join(w.upper() if i % 2 else w for w in words)))
    assert result(spark, rows) == brute(rows)


def test_many_words_around_one_pair_of_nodes(spark):
    """All letters at one place: one group, and long words that share all but that."""
    long = "abcdefghij" * 30
    kinds = [f"wor{c}der" for c in "abcdefghijklmnopqrstuvwxyzàáâãäåæçèéêëìíîïðñòóôõö×øùúûüýþÿ"]
    kinds += [f"{long}{c}{long}" for c in "abc"] + [long + long]
    rows = [(i, " ".join(kinds + kinds[: i % 7])) for i in range(9)]
    assert result(spark, rows) == brute(rows)


def test_edge_rows(spark):
    rows = [(None, "window windov"), (None, "window windov"), (1, None), (2, ""), (3, "WINDOW windov x")]
    rows += [(4, "window " * 20_000), (4, "window " * 20_000)]
    assert result(spark, rows) == brute(rows)
    assert result(spark, []) == []
    assert result(spark, [(1, "few words here")]) == []


def test_nodes_do_not_clash_between_tasks(spark, monkeypatch):
    """Deep nodes of different tasks have different numbers."""
    df = spark.createDataFrame([(i, 5, f"{c}bcdefghijk") for i, c in enumerate("abcdefghijklmnop")], "id long, n long, word string")
    rows = spelling.with_nodes(df.repartition(8)).collect()
    deep = [x for r in rows for x in r.pre if x < 0]
    assert len(deep) == len(set(deep)) > 0
    shared = [r.suf[4] for r in rows]
    assert len(set(shared)) == 1
