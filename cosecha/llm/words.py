"""Words and word shingles of whole Arrow batches, as 64-bit hashes, in numpy.

A word is a run of bytes other than blank and ``\\t \\n \\v \\f \\r``; A-Z count as a-z.  All functions take
the texts of one Arrow batch at once and work on its byte buffer in slices of a few MB, so memory follows the
slice and the number of words, never the number of texts, and there is no Python code per word or per text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
SLICE_BYTES = 1 << 20  # bytes of text hashed at once; a longer word widens its slice

_rng = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)
_FOLDED = _BYTE.copy()
_FOLDED[65:91] = _BYTE[97:123]
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_P = 0x9E3779B97F4A7C15 | 1
_P_INV = pow(_P, -1, 1 << 64)
_ROLL = (_rng.integers(1, 1 << 63, 64, dtype=np.uint64) * U64(2)) + U64(1)

_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on uint64, so that every output bit depends on every input bit."""
    x = x ^ (x >> U64(33))
    x = x * U64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> U64(33))
    x = x * U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U64(33))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for i, base in enumerate((_P, _P_INV)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _powers[i] = np.cumprod(steps)
    return _powers[0], _powers[1]


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary array; a null counts as an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    column = column.cast(pa.large_binary())
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_spans(data: np.ndarray, offsets: np.ndarray, cuts: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Byte starts and ends of all words; no word crosses a text's end.

    ``cuts``: two tables of bytes; words are also cut where a byte of the one meets one of the other.
    """
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = ~_SPACE[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    cut = np.unique(offsets[(offsets > 0) & (offsets < n)])
    first[cut] = inside[cut]
    last[cut - 1] = inside[cut - 1]
    if cuts is not None:
        a, b = cuts[0][data], cuts[1][data]
        edge = (a[:-1] & b[1:]) | (b[:-1] & a[1:])
        first[1:] |= edge
        last[:-1] |= edge
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def word_hashes(column: pa.Array, fold: bool = True, cuts: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, word offsets per text, byte starts, byte ends, bytes) of all words of a batch of texts.

    ``fold``: A-Z count as a-z.
    """
    values = _FOLDED if fold else _BYTE
    data, offsets = text_buffer(column)
    starts, ends = word_spans(data, offsets, cuts)
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        base = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, base + SLICE_BYTES, "right")))
        size = int(ends[j - 1] - base)
        pow_, inv = _power_tables(size + 1)
        total = np.zeros(size + 1, np.uint64)
        np.cumsum(values[data[base : base + size]] * pow_[:size], out=total[1:])
        s, e = starts[i:j] - base, ends[i:j] - base
        out[i:j] = mix((total[e] - total[s]) * inv[s] + (e - s).astype(np.uint64))
        i = j
    return out, np.searchsorted(starts, offsets), starts, ends, data


def shingle_hashes(words: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, text numbers) of all runs of ``width`` words; a shorter text gives its whole sequence as one."""
    counts = np.diff(bounds)
    n = len(words)
    text = np.repeat(np.arange(len(counts)), counts)
    if n >= width:
        rolled = np.zeros(n - width + 1, np.uint64)
        for k in range(width):
            rolled += words[k : n - width + 1 + k] * _ROLL[k]
        keep = text[: n - width + 1] == text[width - 1 :]
        hashes, owner = mix(rolled[keep]), text[: n - width + 1][keep]
    else:
        hashes, owner = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    short = np.flatnonzero((counts > 0) & (counts < width))
    if len(short):
        extra = np.zeros(len(short), np.uint64)
        for k in range(width - 1):
            there = counts[short] > k
            extra[there] += words[bounds[short[there]] + k] * _ROLL[k]
        extra = mix(extra + counts[short].astype(np.uint64) * U64(0xA0761D6478BD642F))
        hashes, owner = np.concatenate([hashes, extra]), np.concatenate([owner, short])
        order = np.argsort(owner, kind="stable")
        hashes, owner = hashes[order], owner[order]
    return hashes, owner


def shingle_sets(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingle hashes of each text, one after the other; offsets per text)."""
    words, bounds, *_ = word_hashes(column)
    hashes, owner = shingle_hashes(words, bounds, width)
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    keep = np.ones(len(hashes), bool)
    keep[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    hashes, owner = hashes[keep], owner[keep]
    return hashes, np.searchsorted(owner, np.arange(len(column) + 1))


def pieces(batch: pa.RecordBatch, column: str, size: int = 2 * SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cuts a batch so that each part has at most ``size`` bytes of text or one row."""
    data = batch.column(column)
    if not len(batch):
        return
    lengths = np.nan_to_num(pc.binary_length(data).to_numpy(zero_copy_only=False).astype(float))
    total, start = 0.0, 0
    for i, n in enumerate(lengths):
        if i > start and total + n > size:
            yield batch.slice(start, i - start)
            total, start = 0.0, i
        total += n
    yield batch.slice(start)
