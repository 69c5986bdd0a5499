"""Token ids of documents in files of Simple-8b words, and their reader.

A 64-bit word holds a selector in its upper four bits and, in the other 60, as many ids of equal width as the selector
says, the first in the lowest bits; the selector is the one that packs the most of the next ids.  Selector 0 is the
escape: its payload is the place of one id of 60 bits or more in the file's table of raw ids.  Words never cross a
block of 1,024 ids, and the file has each block's first word, so any block decodes alone and all of them at once.

File, little-endian: magic, seven counts (documents, those of them without doc_id, which come first, ids, blocks, words,
raw ids, ids per block; 64 bits each), doc_ids (int64), document offsets into the ids, block offsets into the words, words, raw ids.

Texts are encoded by the given ``tokenizers`` file without special tokens; an end id closes each document.  Where its
rules are those of NORMALIZERS and SPLIT, which never reach across blanks, each distinct piece of a batch is encoded
once, and kept for later batches up to a bound; with other rules whole texts are encoded.

Defined results: a null text is an empty one, which has the end id only; rows are in ascending order of doc_id, null
first, and rows with one doc_id in the order of a hash of their texts; an empty table gives no file and no row.
"""

from __future__ import annotations

import io
import itertools
import json
import os
import unicodedata
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cosecha.llm import words as W
from cosecha.llm.work import folder, saved

# The selectors of Simple-8b, as (ids, bits of each)
SELECTORS = ((1, 64), (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60))
_COUNT = np.array([c for c, _ in SELECTORS])
MAGIC = b"S8BTOK02"
BLOCK_IDS = 1024
FILE_IDS = 1 << 22  # a file is closed after so many ids
CACHED_WORDS = 3 << 19
END_ID = 1
TOKENIZER = "word_bpe_49k.json"
# Rules of a tokenizer that pieces of words can be encoded with
NORMALIZERS = ["NFC", "Replace", "Lowercase"]
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, first word of each block and their number, raw ids) of uint64 ids; all blocks advance in step."""
    n = len(ids)
    blocks = -(-n // BLOCK_IDS)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(1, np.uint64), np.zeros(0, np.uint64)
    # of a float the exponent is the number of bits; those that round up to the next are far beyond the ids in use
    bits = np.frexp(ids.astype(np.float64))[1].astype(np.int8)
    padded = np.full(blocks * BLOCK_IDS, 127, np.int8)
    padded[:n] = bits
    width = np.full((blocks, BLOCK_IDS + 60), 127, np.int8)
    width[:, :BLOCK_IDS] = padded.reshape(blocks, BLOCK_IDS)
    flat = width.ravel()
    best = np.where(flat > 60, 0, 14).astype(np.int8)
    most, have = flat, 1
    for s in range(13, 0, -1):  # windows grow from 2 ids to 60
        count, fit = SELECTORS[s]
        while have < count:
            step = min(have, count - have)
            wider = most.copy()
            np.maximum(most[:-step], most[step:], out=wider[:-step])
            wider[-step:] = 127
            most, have = wider, have + step
        best[most <= fit] = s
    row = BLOCK_IDS + 60
    counts = np.array([c for c, _ in SELECTORS], np.int64)
    ends = np.arange(blocks) * row + np.minimum(BLOCK_IDS, n - BLOCK_IDS * np.arange(blocks))
    at, lane = np.arange(blocks) * row, np.arange(blocks)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    while len(lane):
        selector = best[at]
        found.append((lane, at, selector))
        at = at + counts[selector]
        on = at < ends[lane]
        if not on.all():
            lane, at = lane[on], at[on]
    in_block = np.zeros(blocks, np.int64)
    for lane, _, _ in found:
        in_block[lane] += 1
    firsts = np.concatenate([[0], np.cumsum(in_block)])
    selector, start = np.empty(firsts[-1], np.int8), np.empty(firsts[-1], np.int64)
    for step, (lane, at, chosen) in enumerate(found):
        spot = firsts[lane] + step
        selector[spot] = chosen
        start[spot] = at - 60 * lane
    out = selector.astype(np.uint64) << np.uint64(60)
    for s in range(1, 15):
        own = np.flatnonzero(selector == s)
        if len(own):
            packed, first = out[own], start[own]
            for k in range(SELECTORS[s][0]):
                packed |= ids[first + k] << np.uint64(k * SELECTORS[s][1])
            out[own] = packed
    escaped = np.flatnonzero(selector == 0)
    out[escaped] = np.arange(len(escaped), dtype=np.uint64)
    return out, firsts.astype(np.uint64), ids[start[escaped]]


def unpack(words: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """The ids of consecutive words."""
    selector = (words >> np.uint64(60)).astype(np.int64)
    if (selector >= len(SELECTORS)).any():
        raise ValueError("no such selector")
    counts = _COUNT[selector]
    ends = np.cumsum(counts)
    out = np.zeros(ends[-1] if len(ends) else 0, np.uint64)
    for s in range(1, 15):
        own = np.flatnonzero(selector == s)
        count, bits = SELECTORS[s]
        for k in range(count if len(own) else 0):
            out[ends[own] - count + k] = (words[own] >> np.uint64(k * bits)) & np.uint64((1 << bits) - 1)
    own = np.flatnonzero(selector == 0)
    out[ends[own] - 1] = raw[(words[own] & np.uint64((1 << 60) - 1)).astype(np.int64)]
    return out


#: What byte-level models read for each byte: printable Latin-1 as it is, the others from U+0100 on.
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_CHARS = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _PRINTED)}

_LETTERS, _SIGNS = np.zeros(256, bool), np.zeros(256, bool)
_LETTERS[[*range(65, 91), *range(97, 123)]] = True
_SIGNS[list(b"!\"#$%&()*+,-./:;=?@[\\]^_`{}~")] = True


class WordEncoder:
    """Encodes texts piece by piece with a ``tokenizers`` file; the ids of recent pieces are kept.

    Pieces are words, cut further between an ASCII letter and one of most ASCII signs: the tokenizer cuts there too.
    A piece of letters only, in composed form, is what its rules hand to the model as one; it goes there directly.
    All other pieces go through the whole tokenizer.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        rules = json.loads(self.tokenizer.to_str())
        split, *more = (rules["pre_tokenizer"] or {}).get("pretokenizers", [{}])
        self.by_pieces = [x["type"] for x in (rules["normalizer"] or {}).get("normalizers", [])] == NORMALIZERS and split.get("pattern") == {"Regex": SPLIT}
        self.by_pieces &= split.get("behavior") == "Removed" and [(x["type"], x["add_prefix_space"], x["use_regex"]) for x in more] == [("ByteLevel", False, False)]
        self.model = self.tokenizer.model
        self.clear()

    def clear(self) -> None:
        self.keys, self.starts, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def piece(self, text: str) -> list[int]:
        if text.isalpha():
            if text.isascii():
                return [t.id for t in self.model.tokenize(text.lower())]
            lower = text.lower()
            # the lower case of a capital sigma depends on its place; that of some letters ends in a mark
            if "\u03a3" not in text and lower.isalpha() and unicodedata.is_normalized("NFC", text):
                return [t.id for t in self.model.tokenize(lower.encode().decode("latin-1").translate(_BYTE_CHARS))]
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, each closed by ``end_id``; offsets per text)."""
        if not self.by_pieces:
            ids = [[*self.tokenizer.encode(text or "", add_special_tokens=False).ids, end_id] for text in texts.to_pylist()]
            return np.fromiter(itertools.chain.from_iterable(ids), np.uint32), np.concatenate([[0], np.cumsum([len(x) for x in ids], dtype=np.int64)])
        hashes, bounds, starts, ends, data = W.word_hashes(texts, fold=False, cuts=(_LETTERS, _SIGNS))
        keys, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.keys) > CACHED_WORDS:
            self.clear()
        at = np.searchsorted(self.keys, keys)
        new = np.ones(len(keys), bool)
        inside = at < len(self.keys)
        new[inside] = self.keys[at[inside]] != keys[inside]
        if new.any():
            raw = data.tobytes()
            own = first[new]
            ids = [self.piece(raw[s:e].decode()) for s, e in zip(starts[own].tolist(), ends[own].tolist(), strict=True)]
            counts = np.fromiter(map(len, ids), np.int64, len(ids))
            begin = len(self.ids) + np.cumsum(counts) - counts
            self.ids = np.concatenate([self.ids, np.fromiter(itertools.chain.from_iterable(ids), np.uint32, int(counts.sum()))])
            self.keys, self.starts, self.counts = (np.insert(old, at[new], more) for old, more in ((self.keys, keys[new]), (self.starts, begin), (self.counts, counts)))
            at = np.searchsorted(self.keys, keys)
        begin, counts = self.starts[at][inverse], self.counts[at][inverse]
        total = np.zeros(len(counts) + 1, np.int64)
        np.cumsum(counts, out=total[1:])
        offsets = total[bounds] + np.arange(len(bounds))
        out = np.full(offsets[-1], end_id, np.uint32)
        spot = np.ones(len(out), bool)
        spot[offsets[1:] - 1] = False
        out[spot] = self.ids[np.repeat(begin - total[:-1], counts) + np.arange(total[-1])]
        return out, offsets


@lru_cache(2)
def encoder(path: str) -> WordEncoder:
    """One for all tasks of a worker process."""
    return WordEncoder(path)


def _file(uri: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(uri)


def write_file(uri: str, doc_ids: np.ndarray, offsets: np.ndarray, ids: np.ndarray, without_id: int = 0) -> None:
    words, blocks, raw = pack(ids.astype(np.uint64))
    fs, path = _file(uri)
    fs.create_dir(os.path.dirname(path), recursive=True)
    with fs.open_output_stream(path) as out:
        out.write(MAGIC + np.array([len(doc_ids), without_id, len(ids), len(blocks) - 1, len(words), len(raw), BLOCK_IDS], "<u8").tobytes())
        for x, kind in ((doc_ids, "<i8"), (offsets, "<u8"), (blocks, "<u8"), (words, "<u8"), (raw, "<u8")):
            out.write(x.astype(kind).tobytes())


def read_file(uri: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(doc_ids, document offsets, ids, number of documents without doc_id)."""
    fs, path = _file(uri)
    with fs.open_input_stream(path) as file:
        data = io.BytesIO(file.read())
    if data.read(8) != MAGIC:
        raise ValueError(f"{uri} is no token file")
    docs, without_id, n, blocks, words, raw, _ = np.frombuffer(data.read(56), "<u8").astype(np.int64)
    take = lambda count, kind: np.frombuffer(data.read(8 * int(count)), kind)
    doc_ids, offsets, firsts, packed, raw = take(docs, "<i8"), take(docs + 1, "<u8"), take(blocks + 1, "<u8"), take(words, "<u8"), take(raw, "<u8")
    ids = unpack(packed, raw)
    if len(ids) != n or int(firsts[-1]) != len(packed):
        raise ValueError(f"{uri} is damaged")
    return doc_ids, offsets.astype(np.int64), ids, int(without_id)


def _writer(base: str, tokenizer: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, attempt = TaskContext.get().partitionId(), uuid.uuid4().hex
        number = 0
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray, int]] = []

        def close() -> pa.RecordBatch:
            nonlocal number
            doc_ids = np.concatenate([h[0] for h in held])
            lengths = np.concatenate([h[1] for h in held])
            ids = np.concatenate([h[2] for h in held])
            without_id = sum(h[3] for h in held)
            held.clear()
            uri = f"{base}/part-{part:06d}-{number:04d}-{attempt}.s8b"
            write_file(uri, doc_ids, np.concatenate([[0], np.cumsum(lengths)]), ids, without_id)
            number += 1
            return pa.RecordBatch.from_pydict({"part": [part], "number": [number], "uri": [uri], "n_docs": [len(doc_ids)], "n_ids": [len(ids)]})

        for batch in batches:
            for piece in W.pieces(batch, "text"):
                ids, offsets = encoder(tokenizer).encode(piece.column("text"), end_id)
                held.append((piece.column("doc_id").fill_null(0).to_numpy(), np.diff(offsets), ids, piece.column("doc_id").null_count))
                if sum(len(h[2]) for h in held) >= FILE_IDS:
                    yield close()
        if held:
            yield close()

    return run


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for uri, start in zip(batch.column("uri").to_pylist(), batch.column("start").to_pylist(), strict=True):
            doc_ids, offsets, ids, without_id = read_file(uri)
            data = memoryview(ids.astype("<u4").tobytes())
            sums = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            columns = [pa.array(doc_ids, mask=np.arange(len(doc_ids)) < without_id), pa.array(start + offsets[:-1]), pa.array(np.diff(offsets)), pa.array(sums, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids_crc32"])


def write_tokens(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Writes the token files and returns their list (part, number, uri, n_docs, n_ids, start), ordered by the first two.

    Documents are sorted across partitions by doc_id, so files in order hold ids in order.  A repeated task writes
    files of its own; the list has those of the task that succeeded.
    """
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    tie = F.xxhash64("text")
    ordered = own.repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie)
    files = saved(ordered.mapInArrow(_writer(folder(docs.sparkSession, "tokens"), tokenizer, end_id), "part long, number long, uri string, n_docs long, n_ids long"), "token-files")
    # one row per file
    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read_tokens(files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document in the files; ``start`` counts the ids before it."""
    files = saved(files, "token-starts")
    tasks = max(1, min(files.count(), 10_000))
    return files.select("uri", "start").repartition(tasks, "uri").mapInArrow(_reader, "doc_id long, start long, n_tokens long, ids_crc32 long")


def tokens(docs: DataFrame, tokenizer: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Writes the files of ``docs``, reads them back and returns a digest of each document."""
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path(TOKENIZER)
    return read_tokens(write_tokens(docs, tokenizer, end_id))


def op6(spark, sf_dir: str) -> DataFrame:
    """One row per document, from the files: place, number and checksum of its ids."""
    return tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"))
