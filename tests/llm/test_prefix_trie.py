"""The trie of conversation prefixes against a plain dictionary of prefixes."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest

from cosecha.llm import prefix_trie

TURNS = "conv_id long, turn long, role string, text string"


def plain(rows, every=100, most=6):
    """Nodes of the trie of the rebuilt conversations, one prefix at a time."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append((turn is not None, turn or 0, role, hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest(), text))
    own = {c: [(t[2], t[4]) for t in sorted(ts)] for c, ts in own.items()}
    convs = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % most
        head = own.get(c - c % every, [])
        convs[c] = tuple(head[:h] + ts[h:])
    members = defaultdict(list)
    for c, ts in convs.items():
        for d in range(len(ts) + 1):
            members[ts[:d]].append(c)
    children = defaultdict(set)
    for p in members:
        if p:
            children[p[:-1]].add(p)

    def walk(p):
        below = [walk(x) for x in children[p]]
        n = len(members[p])
        leaves = sum(x[0] for x in below) or 1
        saved = sum(x[1] for x in below) + ((n - 1) * len(p[-1][1]) if p else 0)
        ends = ",".join(map(str, sorted(c for c in members[p] if convs[c] == p)))
        out.append((min(members[p]), len(p), min(members[p[:-1]]) if p else None, n, len(children[p]), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
        return leaves, saved

    out = []
    if convs:
        walk(())
    return sorted(out, key=str)


def found(spark, rows, **extra):
    df = spark.createDataFrame(rows, TURNS)
    for name in extra:
        from pyspark.sql import functions as F

        df = df.withColumn(name, F.lit(extra[name]))
    return sorted((tuple(r) for r in prefix_trie.trie(prefix_trie.rebuilt(prefix_trie.sequences(df))).collect()), key=str)


def many(seed, convs=260):
    """Conversations of a few different turns: shared prefixes, copies, some long, some that others go on from."""
    rng, rows = np.random.default_rng(seed), []
    for c in range(convs):
        n = int(rng.integers(1, 7)) if c % 50 else 60
        for t in range(n):
            rows.append((c, t, "user" if t % 2 else "assistant", "x" * int(rng.integers(0, 3))))
    return rows


@pytest.mark.parametrize("bits", [2, 5, 12])
def test_against_plain_trie(spark, monkeypatch, bits):
    monkeypatch.setattr(prefix_trie, "BLOCK_BITS", bits)
    rows = many(bits)
    assert found(spark, rows, key=1, turns="t", ends=0) == plain(rows)


def test_odd_rows(spark):
    rows = [
        (1, None, "user", "a"), (1, 0, None, "b"), (1, 0, "user", None), (1, 0, "user", None), (2, 5, "user", "a"), (2, 5, "", ""), (None, 1, "user", "lost"),
        (-7, 1, "user", "é漢🙂"), (100, 0, "user", "head"), (100, 1, "user", "next"), (101, 0, "user", "own"), (150, 0, "user", "own"), (5, -1, "user", "w " * 40_000), (9_223_372_036_854_775_807, 0, "", ""),
    ]
    assert found(spark, rows) == plain(rows)
    assert found(spark, []) == []


def test_conversations_left_without_turns(spark):
    """A head that is absent gives nothing for the first turns that are taken away."""
    rows = [(c, 0, "user", f"only {c % 3}") for c in range(1, 60)]
    got = found(spark, rows)
    assert got == plain(rows)
    root = next(r for r in got if r[1] == 0)
    assert root[3] == 59 and root[7] != hashlib.sha256().hexdigest()


def test_one_sequence_and_a_chain(spark):
    assert found(spark, [(c, 0, "user", "same") for c in range(0, 900, 100)]) == plain([(c, 0, "user", "same") for c in range(0, 900, 100)])
    chain = [(100 * c, t, "user", "next") for c in range(30) for t in range(c + 1)]
    assert found(spark, chain) == plain(chain)
