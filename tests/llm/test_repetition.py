from __future__ import annotations

import random
import re
from collections import Counter

from pyspark.sql import functions as F

from fareloom.llm.repetition import DUPLICATED, TOP_NGRAM, measure, repetition_coverage


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    sizes = [len(w) for w in words]
    grams = {
        n: [tuple(words[i : i + n]) for i in range(len(words) - n + 1)] for n in range(2, 11)
    }
    times = Counter(grams[3])
    inside = {i + k for i, g in enumerate(grams[3]) if times[g] > 1 for k in range(3)}
    found = {}
    for n in TOP_NGRAM:
        kinds = Counter(grams[n])
        most = max(kinds.values(), default=0)
        found[n] = max(
            (most * sum(map(len, g)) for g, c in kinds.items() if c == most > 1), default=0
        )
    for n in DUPLICATED:
        seen, spots = set(), set()
        for i, g in enumerate(grams[n]):
            if g in seen:
                spots.update(range(i, i + n))
            seen.add(g)
        found[n] = sum(sizes[i] for i in spots)
    lines = [x for x in text.split("\n") if x.strip(" \t\n\v\f\r")]
    return len(words), sum(sizes), len(lines) - len(set(lines)), len(inside), found


def test_measure_equals_brute_force():
    random.seed(5)
    for _ in range(200):
        kinds = random.choice([2, 5, 30])
        text = ""
        for _ in range(random.randrange(120)):
            text += "é" * random.randrange(3) + "w" + str(random.randrange(kinds))
            text += random.choice([" ", " ", "\n", "\t\n", " "])
        n, chars, _, lines, repeats, _, _, _, *rest = measure(text)
        assert (n, chars, lines, repeats, dict(zip([*TOP_NGRAM, *DUPLICATED], rest))) == brute(text)


def test_repeated_text_goes_and_prose_stays():
    random.seed(1)
    prose = " ".join("".join(random.choices("abcdefgh", k=6)) for _ in range(200))
    assert measure(prose)[6]
    assert not measure(" ".join(["buy now"] * 100))[6]
    assert not measure("\n".join([prose[:300]] * 3 + [prose[300:600]]))[6]
    assert measure("a b")[5:7] == (True, False)


def test_edge_rows(spark):
    rows = [(None, "a b"), (1, None), (2, ""), (3, "x " * 300_000), (3, "x " * 300_000), (4, " \n\t")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_words", F.lit("mine"))
    got = sorted(
        (r.doc_id or 0, r.n_words, r.n_repeat_words, r.kept) for r in repetition_coverage(df).collect()
    )
    assert got == [
        (0, 2, 0, False),
        (1, 0, 0, False),
        (2, 0, 0, False),
        (3, 300_000, 300_000, False),
        (3, 300_000, 300_000, False),
        (4, 0, 0, False),
    ]
    assert repetition_coverage(df.limit(0)).count() == 0
