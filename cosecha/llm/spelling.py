"""Spelling variants: words that one letter parts, and the common form that each leads to.

A word is near another if one inserted, deleted or replaced code point leads from one to the other.

1. Counting: runs of letters, counted within a task before the shuffle.
2. Sharing out: one edit leaves the first or the last half of a word as it is.  With m the shorter of two near words'
   lengths, their first or last (m - 1) // 2 code points are equal, so both are in the bucket of that m, end and half.
   Buckets of more than ``BLOCK`` words are dealt to pairs of blocks.
3. Bit-sliced index: in a bucket, the rest of the words (from the shared half outwards) is indexed by place and letter, each
   with a bitset over the words that have the letter there.  A query runs over its own letters with three bitsets:
   words without an error so far, with one replaced, and with one inserted, whose bits come from the next place.  Python's
   integers are the bitsets: one operation serves all words of the bucket.
4. Forms: of its near words a word keeps the count and the most frequent one.  Roots come by doubling along the forms.

Defined results: a null text has no runs; a null doc_id is written as "null"; equal rows count each; A-Z count as a-z, no
other letters are folded; other columns do not matter; an empty table, or one without repeated words, gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cosecha.llm.work import saved, sorted_runs

RUN = "[a-zÀ-ÿ]"
LEAST_LENGTH, LEAST_COUNT = 7, 2
NOISE = 31  # one in so many (document, run) loses a letter
RATIO = 10  # how often as frequent as the word its form is
BLOCK = 8_192  # words of a bucket that are compared at once
HELD = 200_000  # different words that a task holds before it passes their counts on

_FOLD = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def _counted(least: int, noise: int):
    run = re.compile(f"{RUN}{{{least},}}")

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                if not text.is_valid:
                    continue
                start = zlib.crc32(f"{doc_id.as_py() if doc_id.is_valid else 'null'}:".encode())
                for w, k in Counter(run.findall(text.as_buffer().to_pybytes().translate(_FOLD).decode())).items():
                    if noise and not (h := zlib.crc32(w.encode(), start)) % noise:
                        at = h % len(w)
                        w = w[:at] + w[at + 1 :]
                        if len(w) < least:
                            continue
                    counts[w] += k
                if len(counts) >= HELD:
                    yield _rows(counts)
                    counts.clear()
        if counts:
            yield _rows(counts)

    return go


def _rows(counts: Counter[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "n"])


def words(docs: DataFrame, least: int = LEAST_LENGTH, count: int = LEAST_COUNT, noise: int = NOISE) -> DataFrame:
    """(word, n): runs of letters of whole texts, of ``least`` code points and ``count`` occurrences at least.

    With ``noise``, a run loses the code point h modulo its length if ``noise`` divides h, the crc32 of doc_id:run.
    """
    found = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text").mapInArrow(_counted(least, noise), "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= count)


def _bits(x: int) -> Iterator[int]:
    while x:
        low = x & -x
        yield low.bit_length() - 1
        x ^= low


def _near(rests: list[str], short: int) -> Iterator[tuple[int, int, bool]]:
    """(i, j, inserted): pairs one edit apart; rests of ``short`` code points, or one more, of words that agree elsewhere."""
    index: list[dict[str, int]] = [{} for _ in range(short + 2)]
    equal = longer = 0
    for i, w in enumerate(rests):
        bit = 1 << i
        if len(w) == short:
            equal |= bit
        else:
            longer |= bit
        for place, letter in zip(index, w, strict=False):
            place[letter] = place.get(letter, 0) | bit
    for i in _bits(equal):
        same, replaced, inserted = equal | longer, 0, 0
        for here, behind, letter in zip(index, index[1:], rests[i], strict=False):
            bits = here.get(letter, 0)
            inserted = (inserted | same) & behind.get(letter, 0)
            going = same & bits
            replaced = (replaced & bits) | (same ^ going)
            same = going
        for j in _bits((replaced & equal) >> i + 1):
            yield i, i + 1 + j, False
        for j in _bits((inserted | same) & longer):
            yield i, j, True


def _near_in_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, other, n): all near words within each bucket, or between two blocks of it, with the other's frequency."""
    names = ["word", "other", "n"]
    out: tuple[list, list, list] = ([], [], [])
    for table, starts in sorted_runs(batches, ["bucket", "low", "high"]):
        columns = {c: table.column(c).to_pylist() for c in ("key", "low", "high", "block", "word", "n")}
        for s, e in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
            if e - s < 2:
                continue
            groups: dict[str, list[int]] = {}  # a bucket's number is a hash: keys tell buckets apart
            for i in range(s, e):
                groups.setdefault(columns["key"][i], []).append(i)
            across = columns["low"][s] != columns["high"][s]
            for key, rows in groups.items():
                m, side = int(key.split(":", 1)[0][1:]), key[0]
                half = (m - 1) // 2
                ws = [columns["word"][i] for i in rows]
                rests = [w[half:] for w in ws] if side == "a" else [w[: len(w) - half][::-1] for w in ws]
                for i, j, _ in _near(rests, m - half):
                    x, y = rows[i], rows[j]
                    if across and columns["block"][x] == columns["block"][y] or side == "z" and ws[i][:half] == ws[j][:half]:
                        continue  # met elsewhere
                    for p, q in ((x, y), (y, x)):
                        for column, value in zip(out, (columns["word"][p], columns["word"][q], columns["n"][q]), strict=True):
                            column.append(value)
            if len(out[0]) > 50_000:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in out], names=names)
                out = ([], [], [])
    if out[0]:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in out], names=names)


def near_words(vocabulary: DataFrame, block: int = BLOCK) -> DataFrame:
    """(word, other, n): every near pair of (word, n), either way round, with the other's n."""
    size = F.length("word")
    least = vocabulary.select("word", "n", F.explode(F.array(size, size - 1)).alias("m"))
    half = F.floor((F.col("m") - 1) / 2).cast("int")
    first, last = F.substring(F.col("word"), F.lit(1), half), F.right("word", half)
    name = lambda side, part: F.concat(F.lit(side), F.col("m").cast("string"), F.lit(":"), part)
    entries = least.where("m > 2").select("word", "n", F.explode(F.array(name("a", first), name("z", last))).alias("key"))
    entries = saved(entries.select(F.xxhash64("key").alias("bucket"), "key", "word", "n"), "spelling-entries")
    sizes = entries.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    blocks = F.ceil(F.col("members") / block).cast("int")
    dealt = entries.join(sizes, "bucket").withColumn("block", F.pmod(F.xxhash64("word"), blocks).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    dealt = dealt.select("bucket", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "key", "word", "n")
    return dealt.repartition("bucket", "low", "high").sortWithinPartitions("bucket", "low", "high").mapInArrow(_near_in_buckets, "word string, other string, n long")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): the last form along the way, by doubling; forms are ever more frequent, so no way is long."""
    now = saved(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        now = saved(now.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        if now.where("moved").isEmpty():
            return now.drop("moved")
        now = now.drop("moved")


def variants(vocabulary: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every word of (word, n).

    ``form`` is the near word of the largest n, the first in code-point order of equals, if it is ``ratio`` times as
    frequent as the word; ``root`` the last of the forms' forms, or the word itself.
    """
    vocabulary = saved(vocabulary, "spelling-words")
    best = F.min(F.struct((-F.col("n")).alias("neg"), F.col("other").alias("other"))).alias("best")
    near = near_words(vocabulary).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
    out = vocabulary.join(near, "word", "left")
    formed = -F.col("best.neg") >= ratio * F.col("n")
    out = out.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(formed, F.col("best.other")).alias("form"), F.when(formed, -F.col("best.neg")).alias("form_n"))
    out = saved(out, "spelling-forms")
    roots = _roots(out.where("form is not null").select("word", "form"))
    return out.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))


def op13(spark, sf_dir: str) -> DataFrame:
    """One row per word of the documents: its near words, form and root."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return variants(words(docs)).select("word", "form", "root", "n", "n_near", "form_n")


OP13_SQL = """
WITH RECURSIVE r AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), 'null') AS doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS w
  FROM documents),
x AS (SELECT w, hex(encode(doc_id || ':' || w)) AS bytes, count(*) AS k FROM r WHERE length(w) >= 7 GROUP BY doc_id, w),
h AS (
  SELECT w, k, xor(list_reduce(
           list_concat([4294967295], flatten([[CAST('0x' || bytes[2 * i - 1:2 * i] AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1] FOR i IN range(1, length(bytes) // 2 + 1)])),
           lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) ELSE xor(a >> 1, 3988292384 * (a & 1)) END), 4294967295) AS h
  FROM x),
v AS (
  SELECT word, CAST(sum(k) AS BIGINT) AS n
  FROM (SELECT k, CASE WHEN h % 31 = 0 THEN w[:h % length(w)] || w[h % length(w) + 2:] ELSE w END AS word FROM h)
  WHERE length(word) >= 7 GROUP BY 1 HAVING sum(k) >= 2),
c AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v),
d AS (SELECT word, n, i, word[:i - 1] AS p, word[i + 1:] AS s FROM c),
q AS (
  SELECT a.word, b.word AS other, b.n FROM d a JOIN d b ON a.p = b.p AND a.s = b.s AND a.i = b.i AND a.word <> b.word
  UNION SELECT d.word, v.word, v.n FROM d JOIN v ON v.word = p || s
  UNION SELECT v.word, d.word, d.n FROM d JOIN v ON v.word = p || s),
b AS (SELECT word, count(*) AS n_near, max(n) AS top FROM q GROUP BY 1),
f AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN top >= 10 * v.n THEN (SELECT min(other) FROM q WHERE q.word = v.word AND q.n = top) END AS form,
         CASE WHEN top >= 10 * v.n THEN top END AS form_n
  FROM v LEFT JOIN b USING (word)),
z AS (SELECT word, word AS root FROM f UNION SELECT z.word, f.form FROM z JOIN f ON f.word = z.root WHERE f.form IS NOT NULL),
l AS (SELECT z.word, z.root FROM z JOIN f ON f.word = z.root WHERE f.form IS NULL)
SELECT f.word, form, root, n, n_near, form_n FROM f JOIN l USING (word)
"""
