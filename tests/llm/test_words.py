"""The word kernel against plain Python."""

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from cosecha.llm import words as W

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aAbB é\t\n.,\x1c", max_size=40)), max_size=8)


def split(text):
    return [w.translate({c: c + 32 for c in range(65, 91)}) for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]


@settings(max_examples=60, deadline=None)
@given(TEXTS)
def test_words_and_shingles(texts):
    column = pa.array(texts, pa.string())
    hashes, bounds, *_ = W.word_hashes(column)
    known = {}
    for i, text in enumerate(texts):
        mine = hashes[bounds[i] : bounds[i + 1]].tolist()
        assert len(mine) == len(split(text))
        for w, h in zip(split(text), mine, strict=True):
            assert known.setdefault(w, h) == h
    assert len(set(known.values())) == len(known)
    sets, at = W.shingle_sets(column, 5)
    for i, text in enumerate(texts):
        words = split(text)
        want = {tuple(words[k : k + 5]) for k in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()
        assert at[i + 1] - at[i] == len(want)


def test_slices_and_offsets_do_not_matter(monkeypatch):
    texts = pa.array(["skip", "one two three four five six", None, "", "x" * 50 + " y", "one two three four five six"])
    whole = W.word_hashes(texts.slice(1))[0]
    monkeypatch.setattr(W, "SLICE_BYTES", 7)
    assert (W.word_hashes(texts.slice(1))[0] == whole).all()
    sets, at = W.shingle_sets(texts, 5)
    assert (sets[at[1] : at[2]] == sets[at[5] : at[6]]).all()


def test_pieces_cover_all_rows():
    batch = pa.RecordBatch.from_pydict({"text": ["a" * 10, None, "b" * 100, "", "c"]})
    parts = list(W.pieces(batch, "text", 20))
    assert pa.Table.from_batches(parts).to_pydict() == batch.to_pydict() and len(parts) == 3
    assert np.array_equal(W.mix(np.arange(5, dtype=np.uint64)), W.mix(np.arange(5, dtype=np.uint64)))
