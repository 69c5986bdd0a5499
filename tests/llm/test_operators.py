"""The operators on small tables: brute force, round trips, and the defined results of odd input."""

import collections
import gzip
import hashlib
import html
import io
import itertools
import os
import re
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cosecha.llm import decontamination, embedding_links, html_text, language_id, mixing, near_duplicates, passages, quality, token_files, warc
from cosecha.llm.work import components, saved

ODD = [(1, None), (2, ""), (3, " \t\n"), (None, "some words with no id at all"), (4, "short"), (4, "short"), (5, "ünï ©ode … 漢字 words here"), (6, "long " * 3000)]


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))


def shingles(text, k=5):
    w = words(text)
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def text_of(rng, n):
    return " ".join(f"w{x}" for x in rng.integers(0, 5000, n))


def edited(rng, text, n):
    w = text.split()
    for i in rng.integers(0, len(w), n):
        w[i] = f"e{rng.integers(1 << 30)}"
    return " ".join(w)


def roots(nodes, edges):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = np.random.default_rng(1)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (170, 2))] + [(i, i + 1) for i in range(1000, 1060)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = roots({x for e in edges for x in e}, edges)
    assert all(got.get(n, n) == r for n, r in want.items()) and len(got) >= len({n for n in want if want[n] != n})


# 1


def test_warc_round_trip_and_revisits(spark):
    rows = [(1, "http://a/ b", "<p>é</p>"), (2, None, "<p>é</p>"), (3, "u", None), (4, "u", ""), (5, "u", "x" * 300_000), (5, "u", "x" * 300_000), (None, "u", "<p>é</p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"key": F.lit(1), "leader": F.lit(2)})
    got = sorted(warc.read_archives(warc.write_archives(pages)).collect(), key=lambda r: (r["page_id"] is None, r["page_id"] or 0))
    assert [(r["page_id"], r["record_type"], r["refers_to"], r["payload_bytes"]) for r in got] == [(1, "revisit", 2, 9), (2, "response", None, 9), (3, "revisit", 4, 0), (4, "response", None, 0), (5, "response", None, 300_000), (5, "response", None, 300_000), (None, "revisit", 2, 9)]
    assert bytes(got[1]["payload"]).decode() == "<p>é</p>" and got[0]["payload"] is None and got[0]["url"] == "http://a/%20b"
    assert warc.read_archives(warc.write_archives(pages.limit(0))).count() == 0


def test_warc_reader_rejects_damage():
    good = warc.record(1, "u", b"payload", None)
    assert len(list(warc.read_records(io.BytesIO(good * 3)))) == 3
    plain = gzip.decompress(good)
    for bad in (good[:-9], gzip.compress(plain.replace(b"payload", b"paxload")), gzip.compress(plain + plain), gzip.compress(plain[:-4]), b"not gzip", gzip.compress(b"HTTP/1.1 200\r\n\r\n")):
        with pytest.raises(warc.WarcError):
            list(warc.read_records(io.BytesIO(bad)))


def test_warc_of_other_writers(spark, tmp_path):
    def member(kind, block, content, **more):
        fields = {"WARC-Type": kind, "WARC-Record-ID": f"<urn:uuid:{kind}>", "WARC-Date": "2020-01-01T00:00:00Z", "Content-Type": content, "Content-Length": len(block)} | more
        return gzip.compress(b"WARC/1.0\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields.items()).encode() + b"\r\n" + block + b"\r\n\r\n")

    http = "application/http; msgtype=response"
    body = b"chunked body \r\n" * 9000
    chunked = b"".join(b"%x;x=1\r\n%s\r\n" % (len(body[i : i + 777]), body[i : i + 777]) for i in range(0, len(body), 777)) + b"0\r\n\r\n"
    plain = warc.digest(hashlib.sha1(b"hello"))
    archive = member("warcinfo", b"software: x\r\n", "application/warc-fields") + member("request", b"GET / HTTP/1.1\r\nHost: a\r\n\r\n", "application/http; msgtype=request")
    archive += member("response", b"HTTP/1.1 200 OK\r\n\r\nhello", http, **{"WARC-Target-URI": "http://a/", "WARC-Payload-Digest": f"sha1:{plain}"})
    archive += member("response", b"HTTP/1.1 200 OK\r\nTransfer-Encoding:\r\n chunked\r\n\r\n" + chunked, http, **{"WARC-Payload-Digest": f"sha256:{hashlib.sha256(body).hexdigest()}"})
    archive += member("metadata", b"fetchTimeMs: 3", "application/warc-fields", **{"WARC-Block-Digest": "xxh3:1", "WARC-Concurrent-To": "<urn:uuid:response>"}) + member("response", b"HTTP/1.1 204 No", http)
    (tmp_path / "other.warc.gz").write_bytes(archive)
    got = warc.read_archives(spark.createDataFrame([(f"file://{tmp_path}/other.warc.gz",)], "uri string")).collect()
    assert [(r["record_type"], r["payload_bytes"]) for r in got] == [("warcinfo", 13), ("request", 0), ("response", 5), ("response", len(body)), ("metadata", 14), ("response", 0)]
    assert bytes(got[3]["payload"]) == body and got[2]["payload_digest"] == plain and got[2]["url"] == "http://a/" and got[0]["record_id"] == "<urn:uuid:warcinfo>"
    assert all(r["page_id"] is None and r["refers_to"] is None for r in got)
    for bad in (member("response", b"HTTP/1.1 200 OK\r\nContent-Length: 9\r\n\r\nhello", http), member("resource", b"abc", "text/plain", **{"WARC-Payload-Digest": "md5:00"})):
        with pytest.raises(warc.WarcError):
            list(warc.read_records(io.BytesIO(bad)))


# 2


def test_decontamination_against_brute_force(spark, documents):
    rng = np.random.default_rng(2)
    items = [(i, text_of(rng, n)) for i, n in enumerate((15, 20, 30, 45, 59, 3))] + [(90, None), (91, "")]
    docs = [(100 + i, text_of(rng, 60)) for i in range(20)]
    docs += [(200 + i, f"{text_of(rng, 30)} {t} {text_of(rng, 9)}") for i, t in items[:5]]
    docs += [(300 + i, f"{text_of(rng, 30)} {edited(rng, t, 1)}") for i, t in items[:5]]
    docs += [(400, items[5][1]), (401, f"more {items[5][1]}"), (402, items[3][1].upper())]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("n", F.lit(1))
    got = {(r["doc_id"], r["item_id"]) for r in decontamination.matches(documents(docs + ODD), bench).collect()}
    want = set()
    for (d, text), (i, item) in itertools.product(docs + ODD, items):
        w, v = words((text or "").lower()), words((item or "").lower())
        n = len(v)
        if not n:
            continue
        for s in range(len(w) - n + 1):
            a, b = shingles(" ".join(w[s : s + n])), shingles(" ".join(v))
            if len(a & b) >= 0.8 * len(a | b):
                want.add((d, i))
    assert got == want and len(want) >= 7
    kept = {r["doc_id"] for r in decontamination.without_leaks(documents(docs + ODD), bench).collect()}
    assert kept == {d for d, _ in docs + ODD} - {d for d, _ in want}
    assert decontamination.matches(documents([]), bench).count() == 0 and decontamination.matches(documents(docs), bench.limit(0)).count() == 0


def test_shingles_are_counted(spark):
    rng = np.random.default_rng(23)
    rows = [(i, [int(x) for x in rng.integers(-3, 3, n)]) for i, n in enumerate((1, 2, 7, 40, 300))] + [(9, [5] * 50), (10, list(range(60)))]
    table = spark.createDataFrame(rows, "i long, s array<long>")
    got = {r["i"]: r["c"] for r in table.select("i", decontamination._counted(F.col("s")).alias("c")).collect()}
    for (i, x), (j, y) in itertools.product(rows, rows):
        want = sum(min(x.count(v), y.count(v)) for v in set(x))
        assert len(set(got[i])) == len(x) and len(set(got[i]) & set(got[j])) == want


@pytest.mark.parametrize("bounds", [{}, {"SET_BYTES": 0, "INDEX_ROWS": 0, "ITEM_SHINGLES": 0, "PLACES": 0}])
def test_decontamination_of_long_and_repeated_items(spark, documents, monkeypatch, bounds):
    """Items of thousands of words, of one repeated word, and two of one id; with and without broadcasts."""
    for name, value in bounds.items():
        monkeypatch.setattr(decontamination, name, value)
    rng = np.random.default_rng(24)
    long, other = text_of(rng, 4000), text_of(rng, 25)
    items = [(1, long), (2, "again " * 30), (3, other), (3, text_of(rng, 26)), (None, text_of(rng, 24))]
    docs = [(10, f"{text_of(rng, 50)} {edited(rng, long, 60)} {text_of(rng, 50)}"), (11, "again " * 30), (12, f"x {'again ' * 28} {text_of(rng, 9)}"), (13, "again " * 20)]
    docs += [(14, f"{text_of(rng, 9)} {items[3][1]}"), (15, f"{other} {items[4][1]}"), (16, text_of(rng, 6000)), (17, edited(rng, long, 1500))]
    found = decontamination.matches(documents(docs), spark.createDataFrame(items, "item_id long, text string")).collect()
    got = {(r["doc_id"], r["item_id"]): r for r in found}
    assert set(got) == {(10, 1), (11, 2), (12, 2), (14, 3), (15, 3), (15, None)} and len(found) == 6
    a, b = docs[0][1].split()[50:4050], long.split()
    shared = sum(a[i : i + 5] == b[i : i + 5] for i in range(3996))
    assert got[10, 1]["start"] == 50 and got[10, 1]["similarity"] == pytest.approx(shared / (2 * 3996 - shared))
    assert got[11, 2]["similarity"] == 1 and got[12, 2]["similarity"] == pytest.approx(24 / 28) and got[15, None]["start"] == 25


def test_decontamination_looks_at_all_windows(spark, documents):
    """Items cut at a text's ends, of halves in another order, and beyond the radius, against brute force; the best window, first of equals."""
    rng = np.random.default_rng(31)
    items = [(i, text_of(rng, n)) for i, n in enumerate((20, 40, 49, 76, 202, 13))] + [(10, " ".join(f"v{x}" for x in rng.integers(0, 3, 60)))]
    docs = []
    for i, t in items[:5]:
        w, n = t.split(), len(t.split())
        k = (n - 4) // 9
        docs += [(100 + i, f"x {' '.join(w[:-1])}"), (200 + i, " ".join([*w[1:], "y"])), (300 + i, f"{text_of(rng, 5)} {' '.join(w[n // 2 :] + w[: n // 2])} {text_of(rng, 5)}")]
        docs += [(1000 * (i + 1) + j, f"{text_of(rng, 7)} {' '.join(w[: n - k])} {' '.join(f'z{rng.integers(9)}' for _ in range(k))} {text_of(rng, 3)}") for j in range(12)]
    docs += [(50, f"{items[6][1]} {items[6][1]}"), (51, " ".join(f"v{x}" for x in rng.integers(0, 3, 300))), (None, items[1][1])]
    found = decontamination.matches(documents(docs), spark.createDataFrame(items, "item_id long, text string")).collect()
    want = {}
    for (d, text), (i, item) in itertools.product(docs, items):
        a, b = (collections.Counter(), collections.Counter())
        w, v = words(text), words(item)
        b.update(tuple(v[k : k + 5]) for k in range(len(v) - 4))
        for s in range(len(w) - len(v) + 1):
            a = collections.Counter(tuple(w[k : k + 5]) for k in range(s, s + len(v) - 4))
            both = (a & b).total()
            if both >= 0.8 * (2 * (len(v) - 4) - both) - 1e-9 and both > want.get((d, i), (0, 0))[0]:
                want[d, i] = (both, s)
    assert {(r["doc_id"], r["item_id"]): r["start"] for r in found} == {k: s for k, (_, s) in want.items()}
    assert len(found) == len(want) and {(101, 1), (201, 1), (304, 4), (50, 10)} <= set(want) and len(want) > 60
    for r in found:
        m = r["n_words"] - 4
        assert r["similarity"] == pytest.approx(want[r["doc_id"], r["item_id"]][0] / (2 * m - want[r["doc_id"], r["item_id"]][0]))


# 3


def test_embedding_links_against_brute_force(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(60, 64))
    x = np.concatenate([base, base[:20] + rng.normal(size=(20, 64)) * 0.2, base[:10] + rng.normal(size=(10, 64)) * 0.35, np.repeat(base[:1], 4, 0)])
    data = [(i, v.tolist()) for i, v in enumerate(x)]
    odd = [(500, None), (501, [0.0] * 64), (502, [1.0, None]), (503, [float("nan")] * 64), (504, [float("inf")] * 64), (505, []), (506, [1.0, 2.0]), (507, [2.0, 4.0]), (None, [1.0, 2.0])]
    df = spark.createDataFrame(data + odd, "vec_id long, embedding array<double>").withColumns({"label": F.lit(1), "rep": F.lit(1), "id": F.lit(1)})
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embedding_links.linked(df).collect()}
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    close = unit @ unit.T >= 0.95
    edges = [(i, j) for i, j in itertools.combinations(range(len(x)), 2) if close[i, j]] + [(506, 507)]
    root = roots([i for i, _ in data + odd if i is not None], edges)
    assert len(edges) > 25
    for i, r in root.items():
        assert got[i] == (sum(i in e for e in edges), r, i == r)
    assert got[None] == (0, None, True)
    assert embedding_links.linked(df.limit(0)).count() == 0


@pytest.mark.parametrize(("width", "few", "lone", "block"), [(1, 100, 16_000, 8000), (1, 100, 10, 20), (6, 100, 10, 5), (3, 1, 10, 30)])
def test_embedding_links_in_cells_and_blocks(monkeypatch, width, few, lone, block):
    for name, value in {"LEAST_WIDTH": width, "FEW": few, "LONE": lone, "BLOCK": block}.items():
        monkeypatch.setattr(embedding_links, name, value)
    embedding_links.plan.cache_clear()
    rng = np.random.default_rng(31)
    base = rng.normal(size=(70, 24))
    x = np.concatenate([base + rng.normal(size=base.shape) * s for s in (0, 0.05, 0.15, 0.22)] + [base[:1] + rng.normal(size=(60, 24)) * 0.1])
    n_classes = len(x)
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    edges = np.argwhere(np.triu(unit @ unit.T >= 0.95, 1))
    p = embedding_links.Plan(24, 0.95, n_classes)
    assert p.least > 0
    steps = p.steps(unit)
    count = embedding_links.collisions(p, steps, steps)
    assert (count[tuple(edges.T)] >= p.least).all()
    _check_tasks(embedding_links, x, n_classes, {tuple(e) for e in edges.tolist()})
    embedding_links.plan.cache_clear()


def _check_tasks(module, x, n, want):
    """The operator's tasks, run in this process on cells cut to blocks, find these links."""
    ids = np.arange(len(x)) * 7919 % 100_003
    table = pa.table({"id": ids, "rep": np.arange(len(x)), "mult": np.ones(len(x), np.int64), "embedding": pa.array(x.tolist(), pa.list_(pa.float64()))})
    rows = pa.Table.from_batches(list(module._cells(0.95, n, False)(iter(table.to_batches())))).to_pylist()
    members = {}
    for r in rows:
        members.setdefault(r["cell"], []).append(r)
    seen = []
    for cell, own in members.items():
        blocks = -(-len(own) // module.BLOCK) if len(own) > module.LONE else 1
        for low in range(blocks):
            for high in range(low, blocks):
                unit = [r | {"low": low, "high": high, "block": r["id"] % blocks} for r in own if r["id"] % blocks in (low, high)]
                if unit:
                    seen.append(pa.Table.from_pylist(unit).combine_chunks().to_batches()[0])
    pairs, total = set(), 0
    for batch in seen:
        out = pa.Table.from_batches(list(module._links(0.95, n, "f8")(iter([batch]))), pa.schema([("id", pa.int64()), ("rep", pa.int64()), ("links", pa.int64()), ("other", pa.int64())])).to_pylist()
        total += sum(r["links"] for r in out)
        pairs |= {(r["rep"], r["other"]) for r in out if r["other"] is not None}
    assert total == 2 * len(want)
    assert roots(range(len(x)), pairs) == roots(range(len(x)), want)


# 4


def test_near_duplicates_against_brute_force(spark, documents):
    rng = np.random.default_rng(4)
    base = [text_of(rng, 300) for _ in range(15)]
    docs = [(i, t) for i, t in enumerate(base)] + [(100 + 20 * i + k, edited(rng, base[i], k)) for i in range(8) for k in range(1, 7)] + [(900, base[3].upper()), (901, base[3])]
    docs += [(1000 + i, t) for i, (_, t) in enumerate(ODD)]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in near_duplicates.near_duplicates(documents(docs), 85).collect()}
    sets = {d: shingles(t) for d, t in docs}
    edges = [(a, b) for a, b in itertools.combinations(sets, 2) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    root = roots(sets, edges)
    assert got == {d: (len(s), root[d], d == root[d]) for d, s in sets.items()} and len(edges) > 20
    odd = near_duplicates.near_duplicates(documents(ODD)).collect()
    assert len(odd) == len(ODD) and [r["kept"] for r in odd if r["doc_id"] is None] == [True]
    kept = near_duplicates.one_of_each(documents(docs), 85)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(d for d in root if root[d] == d) and kept.columns == documents([]).columns
    assert near_duplicates.near_duplicates(documents([])).count() == 0


def test_one_of_each_loses_no_text(spark):
    rows = [(1, "alpha beta gamma delta epsilon zeta", 7), (1, "one two three four five six", 7), (2, "p q r s t u v", 7), (1, "one two three four five six", 7), (1, "one two three four five six", 8)]
    rows += [(None, "p q r s t u v", 1), (None, "other words stand here once more", 2), (None, None, 3), (None, None, 3), (3, None, 1), (3, "", 1), (4, "one two three four five six", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, near_key long").withColumns({"near_node": F.lit(5), "near_row": F.lit("x"), "near_gone": F.lit(0), "near_twin": F.lit(0)})
    got = near_duplicates.one_of_each(docs)
    assert got.columns == docs.columns
    found = sorted((r["text"] or "", str(r["doc_id"])) for r in got.collect())
    assert found == sorted([(rows[0][1], "1"), (rows[1][1], "4"), ("p q r s t u v", "2"), ("other words stand here once more", "None"), ("", "None"), ("", "3"), ("", "3")])
    again = near_duplicates.one_of_each(docs.orderBy(F.rand(3)))
    assert sorted(map(str, again.collect())) == sorted(map(str, got.collect()))
    with pytest.raises(ValueError, match="room"):
        near_duplicates.one_of_each(spark.createDataFrame([(-(1 << 63), "a", 1), ((1 << 63) - 1, "b", 1)], "doc_id long, text string, x int"))
    high = spark.createDataFrame([((1 << 63) - 1, "a", 1), ((1 << 63) - 1, "b", 1)], "doc_id long, text string, x int")
    assert near_duplicates.one_of_each(high).count() == 2


CLASHES = "quality_score quality_text near_key mix_copy mix_key mix_own_key mix_copies bad_id bad_key text_key label place source_key d_id".split()


def test_stages_with_clashing_names_and_odd_rows(spark, tmp_path):
    import corpus_pipeline

    rng = np.random.default_rng(20)
    item = text_of(rng, 20)
    rows = [*ODD, (7, item), (8, f"{text_of(rng, 30)} {item}"), (9, text_of(rng, 40)), (9, text_of(rng, 40)), (10, "same text in two rows for once"), (10, "same text in two rows for once")]
    docs = spark.createDataFrame([(d, t, "en", None if d == 9 else "s", len(t or "")) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.withColumns({c: F.lit(i) for i, c in enumerate(CLASHES)})
    sf = str(tmp_path)
    spark.createDataFrame([(90, item), (91, None), (92, "")], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    spark.createDataFrame([(9, 1, 0), (None, 1, 0), (7, None, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    for start in (docs, docs.limit(0)):
        now = start
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, now, sf)
            assert out.columns == docs.columns, name
            path = str(tmp_path / f"{name}-{start is docs}")
            out.write.parquet(path)
            now = spark.read.parquet(path)
            if start is docs and now.count():
                assert now.select(*CLASHES).distinct().collect() == [tuple(range(len(CLASHES)))]
            if start is docs and name == "decontamination":
                left = {r["doc_id"] for r in now.collect()}
                assert {7, 8}.isdisjoint(left) and {1, 2, 3, 4, 5, 6, 9, 10} <= left
                assert now.where("doc_id = 9").count() == 2 and now.where("doc_id = 10").count() == 1
        assert corpus_pipeline.STAGES[-1][1](spark, now, sf).count() == now.count()


def test_blocks_of_a_large_bucket(spark, documents, monkeypatch):
    monkeypatch.setattr(near_duplicates, "BLOCK", 3)
    rng = np.random.default_rng(5)
    base = text_of(rng, 200)
    docs = [(i, edited(rng, base, 6)) for i in range(40)]
    got = {r["doc_id"]: r["component_id"] for r in near_duplicates.near_duplicates(documents(docs), 70).collect()}
    sets = {d: shingles(t) for d, t in docs}
    assert got == roots(sets, [(a, b) for a, b in itertools.combinations(sets, 2) if 100 * len(sets[a] & sets[b]) >= 70 * len(sets[a] | sets[b])])


def test_full_sets_only_where_registers_do_not_settle(spark, documents, monkeypatch):
    """Near copies are settled without full sets; a family about the threshold needs them, and blocks bounded in bytes lose no link."""
    monkeypatch.setattr(near_duplicates, "BLOCK", 10)
    monkeypatch.setattr(near_duplicates, "BLOCK_BYTES", 8000)
    seen = {}

    def kept(df, name):
        seen[name] = saved(df, name)
        return seen[name]

    monkeypatch.setattr(near_duplicates, "saved", kept)
    rng = np.random.default_rng(6)
    near, far = text_of(rng, 400), text_of(rng, 400)
    docs = [(i, edited(rng, near, 2)) for i in range(60)] + [(100 + i, edited(rng, far, 4)) for i in range(40)]
    got = {r["doc_id"]: r["component_id"] for r in near_duplicates.near_duplicates(documents(docs), 85).collect()}
    sets = {d: shingles(t) for d, t in docs}
    assert got == roots(sets, [(a, b) for a, b in itertools.combinations(sets, 2) if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])])
    assert len({got[i] for i in range(60)}) == 1 and len(set(got.values())) > 2
    left = {r["class_id"] for r in seen["unsettled"].collect()}
    assert left and left <= set(range(100, 140))


def test_registers_merge_and_estimate():
    rng = np.random.default_rng(6)
    a, b = rng.integers(0, 1 << 63, 3000, dtype=np.uint64), rng.integers(0, 1 << 63, 1000, dtype=np.uint64)
    x, y = np.concatenate([a[:2000], b[:500]]), a
    regs = near_duplicates.registers(np.concatenate([x, y, x, y]), np.array([0, len(x), len(x) + len(y), 2 * (len(x) + len(y))]))
    assert (np.maximum(regs[0], regs[1]) == regs[2]).all()
    more, less = (regs[:1] > regs[1:2]).sum(1), (regs[:1] < regs[1:2]).sum(1)
    assert near_duplicates.likeliest(more, less, np.array([2500.0]), np.array([3000.0]))[0] == pytest.approx(2000 / 3500, abs=0.08)


# 5


def test_quality_learns_and_scores_odd_texts(spark, documents):
    rng = np.random.default_rng(7)
    good = [(i, " ".join("".join(rng.choice(list("aeioulmnrst"), rng.integers(2, 9))) for _ in range(60)) + ".") for i in range(200)]
    bad = [(i, " ".join(f"w{x}$$$" for x in rng.integers(0, 99, 60))) for i in range(200, 400)]
    labels = spark.createDataFrame([(i, int(i < 200), 0) for i in range(400)] + [(None, 1, 0), (9999, None, 0)], "doc_id long, quality int, toxic int")
    docs = documents(good + bad + [(1000 + i, t) for i, (_, t) in enumerate(ODD)] + [(None, "x")])
    model = quality.train(docs, labels)
    got = quality.scored(docs, model)
    assert got.columns == [*docs.columns, "quality_score"]
    held = {i for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 0}
    score = {r["doc_id"]: r["quality_score"] for r in got.collect()}
    assert np.mean([(score[i] >= 0.3) == (i < 200) for i in held]) >= 0.97
    assert all(0 <= s <= 1 for s in score.values()) and len(score) == 400 + len(ODD) + 1
    assert {r["quality_score"] for r in quality.scored(documents([(1, "a b"), (2, None)]), quality.train(docs, labels.limit(0))).collect()} == {0.5}
    # about 480 bytes of words a text
    few = quality.train(docs, labels, most=80 * 480)
    score = {r["doc_id"]: r["quality_score"] for r in quality.scored(docs, few).collect()}
    assert np.mean([(score[i] >= 0.3) == (i < 200) for i in held]) >= 0.9 and not np.array_equal(few.weights, model.weights)
    assert not quality.train(docs, labels, most=100).weights.any()


def test_quality_query_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    got = {r["doc_id"]: r for r in quality.op5(spark, sf).collect()}
    docs = {r["doc_id"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id").collect()}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert set(got) == docs
    for doc, r in got.items():
        assert r["held_out"] == (zlib.crc32(str(doc).encode()) % 5 == 0) and r["predicted"] == int(r["score"] >= 0.3) and 0 <= r["score"] <= 1
    held = [d for d in labels if d in got and got[d]["held_out"] and labels[d] is not None]
    assert len(held) > 20 and np.mean([got[d]["predicted"] == labels[d] for d in held]) > 0.9
    good = [got[d]["score"] for d in held if labels[d]]
    bad = [got[d]["score"] for d in held if not labels[d]]
    assert np.mean([g > b for g in good for b in bad]) > 0.97


def test_factorisation_identity():
    rng = np.random.default_rng(8)
    n = quality.BUCKETS + quality.N_STATISTICS * quality.BINS
    m = quality.Machine(0.3, rng.normal(size=n), rng.normal(size=(n, quality.FACTORS)), np.sort(rng.random((quality.N_STATISTICS, quality.BINS - 1))))
    f, x = np.array([3, 70, 900]), np.array([0.5, 1.5, -2.0])
    pairs = sum(m.factors[f[i]] @ m.factors[f[j]] * x[i] * x[j] for i, j in itertools.combinations(range(3), 2))
    assert m.raw(f, x, np.zeros(3, int), 1)[0][0] == pytest.approx(0.3 + m.weights[f] @ x + pairs)


# 6


@pytest.mark.parametrize("ids", [[], [0], [5] * 200, [2**60 - 1, 2**60, 2**63, 1], list(range(3000)), [1, 2**15] * 700])
def test_simple8b_round_trip(ids):
    x = np.array(ids, np.uint64)
    packed, blocks, raw = token_files.pack(x)
    assert (token_files.unpack(packed, raw) == x).all()
    for b in range(len(blocks) - 1):  # a block decodes alone
        part = token_files.unpack(packed[int(blocks[b]) : int(blocks[b + 1])], raw)
        assert (part == x[b * token_files.BLOCK_IDS : (b + 1) * token_files.BLOCK_IDS]).all()


TRICKY = ["Don't stop—it's 3.14, ok?!", "<|endoftext|> x<|endoftext|>y <|EndOfText|>", "ΑΣ ΣΑΣ ὈΔΥΣΣΕΎΣ", "éa ́x İstanbul ß", "a.b,c;d'e\"f", "x y z", "漢字かな交じり文 emoji 🙂🙂", "\x00\x1c control", "'s 've's", "foo.̸bar ≮"]


def test_token_files_against_the_tokenizer(spark, documents):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path(token_files.TOKENIZER))
    rows = [(10 + i, s) for i, s in enumerate(TRICKY)] + [(100 + i, s) for i, (_, s) in enumerate(ODD)] + [(None, "null id"), (7, None)]
    got = token_files.tokens(documents(rows)).collect()
    start = 0
    by_id = {r["doc_id"]: r for r in got}
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array(t.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        r = by_id[doc]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), zlib.crc32(ids.tobytes())), text
        start += len(ids)
    assert token_files.tokens(documents([])).count() == 0
    least = token_files.tokens(documents([(-(1 << 63), "a"), (None, "b")])).collect()
    assert {(r["doc_id"], r["start"] > 0) for r in least} == {(None, False), (-(1 << 63), True)}
    same = token_files.tokens(documents([(1, "b"), (1, "a c"), (1, "b")])).collect()
    assert sorted(r["start"] for r in same) in ([0, 2, 4], [0, 2, 5], [0, 3, 5])


def test_other_tokenizers_encode_whole_texts():
    import glob

    import public_tokenizers
    from tokenizers import Tokenizer

    tried = 0
    for path in sorted(glob.glob(os.path.dirname(public_tokenizers.path(token_files.TOKENIZER)) + "/*.json")):
        try:
            t = Tokenizer.from_file(path)
        except Exception:  # noqa: BLE001, S112  a file of another kind
            continue
        tried += 1
        ids, offsets = token_files.WordEncoder(path).encode(pa.array([*TRICKY, None]), 9)
        for i, text in enumerate([*TRICKY, ""]):
            assert ids[offsets[i] : offsets[i + 1]].tolist() == [*t.encode(text, add_special_tokens=False).ids, 9]
    assert tried


# 7

PAGE = """<html><head><title>no</title><style>p{}</style></head><body><header><p>Site name</p></header><nav><ul><li><a href=/>Home</a></li></ul></nav>
<div class="cookie-notice"><p>We use cookies.</p></div><article><h1>Title &amp; more</h1><p>First <b>bold</b>
 text.<p>Second &eacute; 1 &lt; 2.</p><div class="ad">Buy this.</div><p>Third.<br>Line.</p></article>
<section class="comments"><p>Nice one!</p></section><form><label>Mail</label></form><aside><p>More</p></aside><script>var x="</p>";</script><footer>&copy; me</footer></body></html>"""


def test_main_text(spark):
    want = "Title & more First bold text. Second é 1 < 2. Third. Line."
    rows = [(1, "u", PAGE), (2, None, None), (3, "u", ""), (4, "u", "<p>a < b</p><article><p>kept"), (None, "u", PAGE), (5, "u", "<!-- <p>x</p>")]
    got = html_text.extracted(spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))).collect()
    by_id = {r["page_id"]: r for r in got}
    assert by_id[1]["text"] == by_id[None]["text"] == want and by_id[1]["n_chars"] == len(want)
    assert by_id[2]["text"] == by_id[3]["text"] == by_id[5]["text"] == "" and by_id[4]["text"].endswith("kept")


def plain_article(page):
    """The article by pattern alone, as the driver's pages mark it."""
    inner = re.search(r"(?is)<article\b[^>]*>(.*?)</article>", page)
    if not inner:
        return ""
    inner = re.sub(r"(?is)<!--.*?-->|<(script|style|form|aside|nav|footer|header)\b.*?</\1>|<div class=\"ad\">.*?</div>", " ", inner[1])
    inner = re.sub(r"(?i)</?(?:b|i|em|strong|a|span|u|code|small)\b[^>]*>", "", inner)
    return " ".join(html.unescape(re.sub(r"<[^>]*>", " ", inner)).split())


def test_html_query_against_articles(spark):
    sf = "/root/testdata/sf0.01"
    got = {r["page_id"]: r for r in html_text.op7(spark, sf).collect()}
    rows = spark.read.parquet(f"{sf}/pages.parquet").collect()
    assert len(got) == len(rows)
    for r in rows:
        own = got[r["page_id"]]
        assert (own["url"], own["text"], own["n_chars"]) == (r["url"], plain_article(r["html"] or ""), len(own["text"]))


def test_odd_pages_in_linear_time():
    field = html_text.trained()
    for part in ("<a ", "<div>x", "<div>x</p>", "<svg>x", "<!x", "<li>x<div>", "<ul><li>x", "<p \"x", "&#1", "<td>x<div>", "<object>x "):
        took = []
        for n in (20_000, 80_000):
            start = time.process_time()
            field.text(part * n)
            took.append(time.process_time() - start)
        assert took[1] < 9 * took[0] + 0.5, (part, took)
    for tag in ("svg", "object", "iframe", "template", "noscript"):
        assert field.text(f"<article><p>one</p><{tag}><p>two</p></article>") == "one two"
    assert html_text.Blocks("<p>&#" + "0" * 9000 + "65; &#x" + "0" * 9000 + "41; &#" + "9" * 9000 + "; &#0; &#65;</p>").texts == ["A A \ufffd \ufffd A"]


def test_labelled_pages_held_out():
    import random

    from cosecha.llm.html_pages import labelled_page

    rng, field, right, total = random.Random(4242), html_text.trained(), 0, 0
    for _ in range(60):
        markup, labels = "", []
        parts = labelled_page(rng)
        for main, part in parts:
            markup += part
            labels += [bool(main)] * (len(html_text.Blocks(markup).texts) - len(labels))
        found = field.decode(html_text.Blocks(markup))
        right += sum(a == b for a, b in zip(found, labels, strict=False))
        total += len(labels)
    assert right / total > 0.97


def test_viterbi_is_the_best_path():
    field = html_text.Field()
    field.steps, field.start = np.array([[0.3, -0.9], [-0.2, 0.7]]), -0.4
    page = html_text.Blocks("<p>a</p><p>b</p><p>c</p><p>d</p>")
    scores = [0.5, -0.1, 0.2, -0.6]
    field.emissions = lambda _: scores

    def value(path):
        return path[0] * field.start + sum(s for s, on in zip(scores, path, strict=True) if on) + sum(field.steps[a, b] for a, b in itertools.pairwise(path))

    assert [int(x) for x in field.decode(page)] == list(max(itertools.product((0, 1), repeat=4), key=value))


# 8


def test_language_by_compression(spark, documents):
    rng = np.random.default_rng(9)
    parts = {"aa": ["tra", "lo", "mi", "sen"], "bb": ["kw", "ush", "erg", "olt"], "cc": ["éa", "ñi", "óu", "çe"]}
    make = lambda lang: " ".join("".join(rng.choice(parts[lang], 3)) for _ in range(40))
    rows = [(i, make(lang), lang, "s") for i, lang in enumerate(rng.choice(list(parts), 150).tolist())]
    docs = documents(rows + [(900, None, "aa", "s"), (901, "123 ...", "aa", "s"), (902, make("bb").upper(), None, "s"), (None, make("cc"), "aa", "s"), (903, "", None, None)])
    got = {r["doc_id"]: r for r in language_id.identified(docs, language_id.learn(docs)).collect()}
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 == 2]
    assert np.mean([got[r[0]]["lang_pred"] == r[2] for r in held]) > 0.97 and all(got[r[0]]["held_out"] for r in held)
    assert [got[i]["lang_pred"] for i in (900, 901, 902, None, 903)] == ["und", "und", "bb", "cc", "und"]
    assert all(0 <= r["score"] <= 1 for r in got.values())
    strict = language_id.identified(docs, language_id.learn(docs), reject=0.99)
    assert strict.where("lang_pred <> 'und'").count() == 0
    assert language_id.identified(docs, language_id.learn(docs.limit(0))).where("lang_pred <> 'und'").count() == 0


def test_language_query_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    got = {r["doc_id"]: r for r in language_id.op8(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang").collect()
    assert set(got) == {r["doc_id"] for r in docs}
    known = {r["lang"] for r in docs if r["lang"]}
    for r in docs:
        own = got[r["doc_id"]]
        assert own["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= own["score"] <= 1
        assert own["lang_pred"] in known if any(c.isalpha() for c in r["text"] or "") else own["lang_pred"] == "und"
    held = [r for r in docs if got[r["doc_id"]]["held_out"] and r["lang"] and got[r["doc_id"]]["lang_pred"] != "und"]
    assert np.mean([got[r["doc_id"]]["lang_pred"] == r["lang"] for r in held]) > 0.98


def test_every_language_is_learned(spark, documents):
    rows = [(i, f"letra{'abcdefghij'[i % 10]} " * 30, f"l{i // 3:03d}", "s") for i in range(750)]
    assert {lang for lang, _ in language_id.learn(documents(rows))} == {f"l{i // 3:03d}" for i in range(750) if zlib.crc32(str(i).encode()) % 4 != 2}


def test_dictionaries_are_bounded_in_bytes(documents):
    """A text that begins within the bound is taken whole, and those behind it are not."""
    rows = [(i, f"{'abcdefgh'[i % 8]} " * 20_000, "x" if i % 2 else "y", "s") for i in range(60)]
    whole, cut = (dict(language_id.learn(documents(rows), dictionary_bytes=n)) for n in (1 << 30, 50_000))
    assert all(len(cut[k]) <= 90_000 < len(whole[k]) and len(cut[k]) > 50_000 and whole[k].startswith(cut[k]) for k in "xy")


def plain_sizes(dictionary, text):
    """Bytes that a text takes, by the plain compressor, frame by frame."""
    import zstandard

    d = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    c = zstandard.ZstdCompressor(level=language_id.LEVEL, dict_data=d, write_checksum=False, write_content_size=False, write_dict_id=False)
    data = re.sub(r"[^\W\d_]+", lambda m: m[0], " ".join(re.findall(r"[^\W\d_]+", text.lower()))).encode()
    return sum(len(c.compress(data[i : i + language_id.FRAME_BYTES])) for i in range(0, len(data), language_id.FRAME_BYTES))


def test_languages_by_the_plain_compressor(spark):
    """Twenty texts: the language whose dictionary gives the fewest bytes, by a compressor of its own for each."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    learned = language_id.learn(docs)
    some = [r for r in docs.orderBy("doc_id").collect() if r["text"] and len(r["text"]) > 200][:20]
    got = {r["doc_id"]: r["lang_pred"] for r in language_id.identified(docs, learned).collect()}
    for r in some:
        sizes = [plain_sizes(d, r["text"]) for _, d in learned]
        near = [name for (name, _), n in zip(learned, sizes, strict=True) if n <= min(sizes) + 2]  # blanks at the ends
        assert got[r["doc_id"]] in near


# 9


def test_passages_against_brute_force(spark, documents):
    rng = np.random.default_rng(10)
    p, q = text_of(rng, 70), text_of(rng, 40)
    docs = [(i, text_of(rng, 150)) for i in range(20)]
    docs += [(30 + i, f"{text_of(rng, 60)} {p} {text_of(rng, 50)}") for i in range(4)] + [(40 + i, f"{text_of(rng, 60)} {q} {text_of(rng, 50)}") for i in range(4)]
    fuzzy = p.split()
    fuzzy[20] = "other"
    fuzzy[45:45] = ["two", "more"]
    docs += [(50, f"{text_of(rng, 30)} {' '.join(fuzzy)} end"), (60, docs[3][1]), (61, "la " * 80), (62, "x " + "la " * 70)]
    got = passages.repeated_passages(documents(docs + ODD)).collect()
    pairs = {(r["doc_id"], r["ref_doc_id"]) for r in got}
    assert {d for d, _ in pairs} == {31, 32, 33, 50, 60, 62} and len(pairs) == 6
    assert {(31, 30), (60, 3), (62, 61)} <= pairs and all(r in range(30, d) for d, r in pairs if d in (32, 33)) and (50, 30) in {(d, min(r, 30)) for d, r in pairs}
    exact = next(r for r in got if r["doc_id"] == 31)
    assert (exact["start"], exact["end"], exact["ref_start"], exact["identity"]) == (60, 130, 60, 1.0)
    near = next(r for r in got if r["doc_id"] == 50)
    assert (near["start"], near["end"]) == (30, 102) and near["identity"] == pytest.approx(69 / 72)
    assert passages.repeated_passages(documents([])).count() == 0


def test_chains_against_all_chains():
    rng = np.random.default_rng(11)
    for _ in range(40):
        m = sorted(set(map(tuple, rng.integers(0, 60, (rng.integers(1, 9), 2)).tolist())))
        x, y = np.array(m).T

        def worth(path):
            total = passages.SEED_WORDS * len(path)
            return total - sum(passages.GAP_COST * (x[b] - x[a] + y[b] - y[a]) for a, b in itertools.pairwise(path))

        best = max(worth(c) for n in range(1, len(m) + 1) for c in itertools.combinations(range(len(m)), n) if all(x[a] < x[b] and y[a] < y[b] for a, b in itertools.pairwise(c)))
        found = passages.chains(x, y)
        assert worth(found[0].tolist()) == pytest.approx(best)
        assert sorted(i for c in found for i in c.tolist()) == list(range(len(m)))


def test_passages_on_both_sides_of_a_long_gap(spark, documents):
    rng = np.random.default_rng(13)
    p, q, long_p, long_q = (text_of(rng, n) for n in (60, 60, 200, 200))
    docs = [(1, f"{p} {text_of(rng, 80)} {q}"), (2, f"{p} {text_of(rng, 80)} {q}"), (3, f"{p} {text_of(rng, 40)} {q}")]
    docs += [(4, f"{long_p} {text_of(rng, 300)} {long_q}"), (5, f"{long_p} {text_of(rng, 310)} {long_q}")]
    got = passages.repeated_passages(documents(docs)).collect()
    found = sorted((r["doc_id"], r["ref_doc_id"], r["start"], r["end"], r["ref_start"], r["ref_end"]) for r in got)
    assert found == [(2, 1, 0, 60, 0, 60), (2, 1, 140, 200, 140, 200), (3, 1, 0, 60, 0, 60), (3, 1, 100, 160, 140, 200), (5, 4, 0, 200, 0, 200), (5, 4, 510, 710, 500, 700)]


@pytest.mark.parametrize("line", [4, 8, 12, 16, 20])
def test_passages_that_repeat_a_line(spark, documents, line):
    rng = np.random.default_rng(16)
    docs = []
    for i in range(10):
        p = " ".join([text_of(rng, line)] * 40).split()[:80]
        docs += [(2 * i, f"{text_of(rng, 60)} {' '.join(p)} {text_of(rng, 50)}"), (2 * i + 1, f"{text_of(rng, 40)} {' '.join(p)} {text_of(rng, 50)}")]
    got = passages.repeated_passages(documents(docs)).collect()
    assert sorted((r["doc_id"], r["ref_doc_id"], r["start"], r["end"], r["ref_start"]) for r in got) == [(2 * i + 1, 2 * i, 40, 120, 60) for i in range(10)]


def test_passages_of_lines_that_others_have_first(spark, documents):
    rng = np.random.default_rng(17)
    docs, want = [], set()
    for i in range(0, 200, 10):
        lines = [text_of(rng, n) for n in (17, 16, 17)]
        docs += [(i + k, f"{text_of(rng, 60)} {x} {text_of(rng, 50)}") for k, x in enumerate(lines)]
        docs += [(i + k, f"{text_of(rng, 60)} {' '.join(lines)} {text_of(rng, 50)}") for k in (5, 9)]
        want.add((i + 9, i + 5, 60, 110))
    got = {(r["doc_id"], r["ref_doc_id"], r["start"], r["end"]) for r in passages.repeated_passages(documents(docs)).collect()}
    assert got == want


@pytest.mark.parametrize("between", [1, 5])
def test_passages_behind_documents_that_repeat_their_lines(spark, documents, between):
    """Documents with every line of a passage, three times each and apart, do not stand between two that have the passage."""
    rng = np.random.default_rng(between)
    docs, want = [], set()
    for i in range(0, 10 * (between + 2), between + 2):
        lines = [text_of(rng, 10) for _ in range(6)]
        docs += [(i + k, f"{text_of(rng, 60)} {' '.join(lines)} {text_of(rng, 50)}") for k in (0, between + 1)]
        for k in range(1, between + 1):
            docs.append((i + k, " ".join(f"{text_of(rng, 30)} {x}" for _ in range(3) for x in rng.permutation(lines))))
        want.add((i + between + 1, i, 60, 120))
    got = {(r["doc_id"], r["ref_doc_id"], r["start"], r["end"]) for r in passages.repeated_passages(documents(docs)).collect()}
    assert got == want


@pytest.mark.parametrize("between", [4, 12])
def test_passages_behind_documents_that_share_their_long_seeds(spark, documents, between):
    """Documents with each run of forty words of a passage, but not its fifty, do not stand between two that have it."""
    rng = np.random.default_rng(40 + between)
    docs, want = [], set()
    for i in range(0, 10 * (between + 2), between + 2):
        p = text_of(rng, 50).split()
        docs += [(i + k, f"{text_of(rng, 60)} {' '.join(p)} {text_of(rng, 50)}") for k in (0, between + 1)]
        docs += [(i + k, f"{text_of(rng, 20)} {' '.join(p[:40])} {text_of(rng, 90)} {' '.join(p[10:])} {text_of(rng, 20)}") for k in range(1, between + 1)]
        want.add((i + between + 1, i, 60, 110))
    got = {(r["doc_id"], r["ref_doc_id"], r["start"], r["end"]) for r in passages.repeated_passages(documents(docs)).collect()}
    assert want <= got


@pytest.mark.parametrize("between", [8, 60])
def test_edited_passages_behind_documents_that_have_their_lines(spark, documents, between):
    """Documents with every line of a passage, apart, do not stand between two that have it with words replaced all over."""
    rng = np.random.default_rng(70 + between)
    docs, want = [], set()
    for i in range(0, 6 * (between + 2), between + 2):
        lines = [text_of(rng, 12) for _ in range(6)]
        edited = " ".join(lines).split()
        edited[5::12] = text_of(rng, 6).split()
        docs += [(i, f"{text_of(rng, 60)} {' '.join(lines)} {text_of(rng, 50)}"), (i + between + 1, f"{text_of(rng, 60)} {' '.join(edited)} {text_of(rng, 50)}")]
        for k in range(1, between + 1):
            docs.append((i + k, " ".join(f"{text_of(rng, 30)} {x}" for x in rng.permutation(lines))))
        want.add((i + between + 1, i))
    got = passages.repeated_passages(documents(docs)).collect()
    assert {(r["doc_id"], r["ref_doc_id"]) for r in got} == want
    assert all(r["start"] <= 65 and r["end"] >= 120 and r["identity"] >= 0.85 for r in got)


def runs_of(text, n):
    w = words(text)
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}


def test_documents_with_exact_runs_against_brute_force(spark, documents):
    """Every document that has a run of 50 words of an earlier one is found, on the driver's documents of sf0.001 and sf0.01."""
    for sf in ("sf0.001", "sf0.01"):
        table = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
        rows = table.select("doc_id", "text").orderBy("doc_id").collect()
        seen, want = set(), set()
        for doc, text in rows:
            own = runs_of(text, 50)
            if not own.isdisjoint(seen):
                want.add(doc)
            seen |= own
        got = passages.op9(spark, f"/root/testdata/{sf}").collect()
        assert want <= {r["doc_id"] for r in got} and len(want) > 5
        texts = {doc: words(text) for doc, text in rows}
        for r in got:  # every passage is one: long enough, and with so many equal words
            a, b = texts[r["doc_id"]][r["start"] : r["end"]], texts[r["ref_doc_id"]][r["ref_start"] : r["ref_end"]]
            assert min(len(a), len(b)) >= 50 and r["ref_doc_id"] < r["doc_id"] and r["identity"] >= 0.8
            assert a == b or r["identity"] < 1


@pytest.mark.parametrize(("size", "share"), [(60, 0.1), (60, 0.15), (100, 0.1), (100, 0.15), (100, 0.2)])
def test_recall_of_edited_passages(spark, documents, size, share):
    rng = np.random.default_rng(size)
    docs, near = [], set()
    for i in range(300):
        p = text_of(rng, size).split()
        hit = rng.random(size) < share
        q = [f"e{rng.integers(1 << 30)}" if h else w for w, h in zip(p, hit, strict=True)]
        docs += [(2 * i, f"{text_of(rng, 60)} {' '.join(p)} {text_of(rng, 50)}"), (2 * i + 1, f"{text_of(rng, 40)} {' '.join(q)} {text_of(rng, 50)}")]
        if hit[np.flatnonzero(~hit)[0] : np.flatnonzero(~hit)[-1] + 1].mean() <= 0.2:
            near.add(2 * i + 1)
    got = {r["doc_id"] for r in passages.repeated_passages(documents(docs)).collect()}
    print(size, share, len(got & near) / len(near))
    assert len(got & near) >= 0.9 * len(near)


def test_stretches_against_all_stretches():
    rng = np.random.default_rng(14)
    for _ in range(300):
        runs = [(n, n, n) if i % 2 else (n, n + int(rng.integers(0, 9)), int(rng.integers(0, n))) for i, n in enumerate(rng.integers(1, 20, 12).tolist())]
        steps = np.array(runs)
        fits = {(i, j) for i in range(12) for j in range(i + 1, 13) if (w := steps[i:j].sum(axis=0))[:2].min() >= 30 and w[2] >= 0.8 * w[:2].max() and ((i % 2 and not j % 2) or (i, j) == (0, 12))}
        found = list(passages._longest(steps, 30, 0.8))
        assert set(found) <= fits and bool(found) == bool(fits)
        assert all(any(i < b and a < j for a, b in found) for i, j in fits)
        assert not found or found[0] == (0, 12) or steps[slice(*found[0]), 2].sum() == max(steps[i:j, 2].sum() for i, j in fits)


def test_common_subsequence():
    rng = np.random.default_rng(15)
    for _ in range(50):
        a, b = (rng.integers(0, 6, rng.integers(0, 30)).astype(np.uint64) for _ in "ab")
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, j in itertools.product(range(len(a)), range(len(b))):
            table[i + 1, j + 1] = table[i, j] + 1 if a[i] == b[j] else max(table[i, j + 1], table[i + 1, j])
        assert passages._common(a, b) == table[-1, -1]


# 10


def test_water_filling(spark, documents):
    rng = np.random.default_rng(12)
    sizes = {"a": 10, "b": 300, "c": 50, "d": 5, None: 200}
    rows = [(1000 * k + i, text_of(rng, int(rng.integers(1, 9))), "en", s) for k, (s, n) in enumerate(sizes.items()) for i in range(n)]
    rows += [(90_000, None, "en", "a"), (90_001, "", "en", "zero"), (None, "one two", None, "c"), (5, "again again", "en", "a"), (5, "again again", "en", "a")]
    got = mixing.mixed(documents(rows)).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r["source_key"], []).append(r)
        assert r["taken"] <= 3 * r["size"]
    weights = dict(zip(["sa", "sb", "sc", "sd", "szero", "~"], [5, 2, 1, 5, 2, 1], strict=True))
    size = {s: sum(r["size"] for r in rs) for s, rs in by.items()}
    want, left, open_ = {}, float(sum(size.values())), set(size)
    while True:
        share = {s: left * weights[s] / sum(weights[o] for o in open_) for s in open_}
        full = {s for s in open_ if share[s] > 3 * size[s]}
        if not full:
            want |= share
            break
        want |= {s: 3.0 * size[s] for s in full}
        left -= sum(3.0 * size[s] for s in full)
        open_ -= full
    for s, rs in by.items():
        assert rs[0]["target"] == pytest.approx(want[s]) and rs[0]["source_size"] == size[s]
        assert abs(sum(r["taken"] for r in rs) - want[s]) <= 9
    again = {(r["doc_id"], r["text_key"]): r["taken"] for r in mixing.mixed(documents(rows[::-1])).collect()}
    assert again == {(r["doc_id"], r["text_key"]): r["taken"] for r in got}
    with pytest.MonkeyPatch.context() as m:  # the number of buckets changes nothing
        m.setattr(mixing, "BUCKETS", 2)
        m.setattr(mixing, "BUCKET_ROWS", 3)
        assert again == {(r["doc_id"], r["text_key"]): r["taken"] for r in mixing.mixed(documents(rows)).collect()}
    mix = mixing.repeated(documents(rows))
    assert mix.columns == documents([]).columns and mix.count() == sum(r["copies"] for r in got)
    assert mixing.mixed(documents([])).count() == 0 and mixing.repeated(documents([])).count() == 0
