"""Spelling variants against plain edit tests of all pairs."""

import itertools
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cosecha.llm import spelling


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(counts, ratio=10):
    near = {w: [] for w in counts}
    for a, b in itertools.combinations(counts, 2):
        if one_edit(a, b):
            near[a].append(b)
            near[b].append(a)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        form[w] = best if best and counts[best] >= ratio * counts[w] else None

    def root(w):
        return root(form[w]) if form[w] else w

    return sorted((w, form[w], root(w), n, len(near[w]), counts.get(form[w])) for w, n in counts.items())


def result(spark, counts, **options):
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = spelling.variants(df, **options).select("word", "form", "root", "n", "n_near", "form_n").collect()
    return sorted((tuple(r) for r in got), key=lambda r: r[0])


@pytest.mark.parametrize(("letters", "block"), [("ab", 8192), ("abÀÿ", 8192), ("ab", 5)])
def test_all_pairs(spark, monkeypatch, letters, block):
    """Dense vocabularies: every kind of edit at every place, and buckets dealt to blocks."""
    monkeypatch.setattr(spelling, "BLOCK", block)
    monkeypatch.setattr(spelling.near_words, "__defaults__", (block,))
    rng = np.random.default_rng(len(letters))
    counts = {"".join(rng.choice(list(letters), rng.integers(7, 11))): int(10 ** rng.uniform(0.4, 5)) for _ in range(300)}
    assert result(spark, counts) == plain(counts)


def test_long_and_lone_words(spark):
    counts = {"x" * 3000: 50, "x" * 2999: 2, "x" * 1500 + "y" + "x" * 1499: 3, "seventy": 2, "seventh": 20, "sevent": 9, "seventhly": 4}
    counts.pop("sevent")
    assert result(spark, counts) == plain(counts)


def test_words(spark, documents):
    rng = np.random.default_rng(5)
    runs = ["Aguacate", "aguacate", "ÑANDÚES", "ñandúes", "straße", "Straßenbahn", "×÷×÷×÷×", "tomates", "sixabc", "漢字abcdefgh漢", "a1234567", "seventy-seven", "x" * 40]
    rows = [(int(i), " ".join(rng.choice(runs, 60))) for i in range(200)] + [(7, None), (None, "Aguacate aguacates"), (None, ""), (7, "aguacate")]
    want = Counter()
    import re

    for i, t in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = w.translate({c: c + 32 for c in range(65, 91)})
            h = zlib.crc32(f"{'null' if i is None else i}:{w}".encode())
            want[w[: h % len(w)] + w[h % len(w) + 1 :] if h % 31 == 0 else w] += 1
    want = {w: n for w, n in want.items() if len(w) >= 7 and n >= 2}
    df = documents(rows).withColumns({"word": F.lit(1), "n": F.lit("x")})
    counts = {r["word"]: r["n"] for r in spelling.words(df).collect()}
    assert counts == want
    assert result(spark, counts) == plain(counts)


def test_empty(spark, documents):
    assert spelling.variants(spelling.words(documents([]))).count() == 0
    assert spelling.variants(spelling.words(documents([(1, "once there were different syllables")]))).count() == 0
