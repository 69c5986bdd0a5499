"""Language identification by compression: the language whose text, as a zstandard dictionary, helps most.

For each language a raw-content dictionary is put together from whole documents of that language, at most ``SAMPLE``,
those whose ids hash lowest.  A text is compressed with every
dictionary; the language of the smallest result is predicted.  Its score is the share of bytes that it saves against
the runner-up, scaled so that ``FULL_MARGIN`` and more is 1; a margin below ``reject`` makes the prediction ``und``.

Compressed are the lower-cased letters of the whole text, in frames of FRAME_BYTES, so that the dictionary and not the
text before tells most and memory is bounded.  Equal sizes fall to the language with more training documents, then to the lesser name.

Defined results: null texts and texts without a letter give ``und`` and score 0; without training rows all are
``und``; rows with equal texts get equal results; rows with a null doc_id are predicted but never learned from; an
empty table gives an empty result; extra columns do not matter.  Every language that a training row has is learned;
the dictionaries go to all tasks, so their size follows the number of languages.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cosecha.llm import words as W

SAMPLE = 48  # documents a language that are learned from
DICTIONARY_BYTES = 4 << 20  # of texts that a language's dictionary is made of
LEVEL = 6
FRAME_BYTES = 2048
FULL_MARGIN = 0.25
FOLDS, HELD_OUT = 4, 2
UNKNOWN = "und"

_LETTER = regex.compile(r"\p{L}")
_NO_LETTERS = regex.compile(r"[^\p{L}]+")


def letters(text: str) -> bytes:
    """What is compressed: lower-cased letters, with one blank for whatever stands between them."""
    return _NO_LETTERS.sub(" ", text.lower()).encode()


def fold(doc_id: str):
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS


def _letters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = pa.array([letters(text or "") for text in batch.column("text").to_pylist()], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("place"), out], names=["lang", "place", "letters"])


def learn(docs: DataFrame, sample: int = SAMPLE, dictionary_bytes: int = DICTIONARY_BYTES) -> list[tuple[str, bytes]]:
    """(language, dictionary) by falling number of documents; reads only text, lang and the fold of doc_id.

    A dictionary has ``sample`` documents at most, and of those the ones that begin within its first ``dictionary_bytes``
    bytes: so it holds no more than these and one text.
    """
    rows = docs.where("lang is not null and doc_id is not null").where(fold("doc_id") != HELD_OUT).select("doc_id", "lang")
    counts = rows.groupBy("lang").count()
    # of a frequent language only ids with low hashes are ranked, about eight times as many as are needed
    place = F.shiftrightunsigned(F.xxhash64("doc_id"), 1)
    near = rows.join(F.broadcast(counts), "lang").withColumn("place", place)  # one row for each language
    near = near.where(F.col("place") / float(1 << 63) <= 8.0 * sample / F.col("count")).select("doc_id", "lang", "place", "count").distinct()
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("place", "doc_id"))
    chosen = near.withColumn("rank", rank).where(F.col("rank") <= sample)
    chosen = chosen.select(F.col("doc_id").alias("chosen_id"), F.col("lang").alias("chosen_lang"), "place", "count")
    # at most ``sample`` rows of each language
    texts = docs.select("doc_id", "lang", "text").join(F.broadcast(chosen), (F.col("doc_id") == F.col("chosen_id")) & (F.col("lang") == F.col("chosen_lang")))
    # and no more bytes than a dictionary is to have: texts that begin within them, whole
    order = Window.partitionBy("lang").orderBy("place", "chosen_id").rowsBetween(Window.unboundedPreceding, -1)
    begin = F.coalesce(F.sum(F.octet_length("text")).over(order), F.lit(0))
    texts = texts.withColumn("begin", begin).where(F.col("begin") < dictionary_bytes)
    found = texts.select("lang", "place", "text").mapInArrow(_letters, "lang string, place long, letters binary").toArrow().to_pylist()
    number = {r["chosen_lang"]: r["count"] for r in chosen.select("chosen_lang", "count").distinct().collect()}
    parts: dict[str, list[bytes]] = {}
    for r in sorted(found, key=lambda r: (r["place"], r["letters"])):
        parts.setdefault(r["lang"], []).append(r["letters"])
    return [(lang, b"\n".join(parts[lang])) for lang in sorted(parts, key=lambda x: (-number[x], x)) if any(parts[lang])]


class Predictor:
    def __init__(self, dictionaries: list[tuple[str, bytes]], reject: float = 0.0):
        self.names = [name for name, _ in dictionaries]
        self.reject = reject
        self.compressors = []
        for _, data in dictionaries:
            d = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=LEVEL)
            self.compressors.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_checksum=False, write_content_size=False, write_dict_id=False))

    def sizes(self, text: str) -> list[int]:
        data = letters(text)
        total = [0] * len(self.names)
        for start in range(0, len(data), FRAME_BYTES):
            frame = data[start : start + FRAME_BYTES]
            total = [t + len(c.compress(frame)) for t, c in zip(total, self.compressors, strict=True)]
        return total

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.names or not _LETTER.search(text):
            return UNKNOWN, 0.0
        sizes = self.sizes(text)
        best = min(range(len(sizes)), key=sizes.__getitem__)
        if len(sizes) == 1:
            return self.names[0], 1.0
        second = min(s for i, s in enumerate(sizes) if i != best)
        margin = (second - sizes[best]) / second
        return (self.names[best] if margin >= self.reject else UNKNOWN), min(1.0, margin / FULL_MARGIN)


def identified(docs: DataFrame, dictionaries: list[tuple[str, bytes]], reject: float = 0.0) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predictor = Predictor(dictionaries, reject)
        for batch in batches:
            for part in W.pieces(batch, "text"):
                found = [predictor.predict(text) for text in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), pa.array([x[0] for x in found], pa.string()), pa.array(np.array([x[1] for x in found], float))], names=["doc_id", "held_out", "lang_pred", "score"])

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (fold("doc_id") == HELD_OUT).alias("held_out"), "text")
    return own.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def op8(spark, sf_dir: str) -> DataFrame:
    """One row per document: fold, language and score; every text with a letter gets a language."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return identified(docs, learn(docs))
