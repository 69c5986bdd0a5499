"""The pipeline stage by stage against plain Python, and the queries with SQL against DuckDB."""

import os
import zlib

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from cosecha.llm import queries

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_stages(spark, tmp_path):
    import public_tokenizers
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    at = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        if name != "tokens":
            assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / name))
        docs = at[name] = spark.read.parquet(str(tmp_path / name))
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r["doc_id"] for r in at["quality"].select("doc_id").collect()}
    assert np.mean([(d in kept) == bool(q) for d, q in labels.items()]) > 0.95
    texts = [r["text"] for r in at["near_duplicates"].collect()]
    sets = []
    for t in texts:
        w = t.lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} or {tuple(w)})
    assert all(len(a & b) < 0.8 * len(a | b) for i, a in enumerate(sets) for b in sets[:i])
    items = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = {r["doc_id"] for r in at["decontamination"].collect()}
    for r in at["near_duplicates"].collect():
        assert (r["doc_id"] in clean) == (not any(i in r["text"] for i in items))
    assert at["mixing"].count() > 0 and {r["doc_id"] for r in at["mixing"].collect()} <= clean
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = sorted((r["doc_id"], zlib.crc32(np.array(t.encode(r["text"], add_special_tokens=False).ids + [1], "<u4").tobytes())) for r in at["mixing"].collect())
    assert sorted((r["doc_id"], r["ids_crc32"]) for r in at["tokens"].collect()) == want
    assert corpus_pipeline.run(spark, SF).count() == len(want)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_against_duckdb(spark, name):
    c = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        c.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    got = queries.QUERIES[name](spark, SF)
    names = sorted(got.columns)
    want = c.sql(queries.ORACLE_SQL[name]).df()
    mine = got.toPandas()
    text = lambda d: sorted(map(tuple, d[names].astype(object).where(d[names].notna(), None).map(lambda v: f"{v:.4f}" if isinstance(v, float | int) and not isinstance(v, bool) else str(v)).to_numpy().tolist()))
    assert text(mine) == text(want)
