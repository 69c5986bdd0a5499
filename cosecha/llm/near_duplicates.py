"""Near-duplicate documents by SetSketch registers.

A document's set is its distinct shingles of five words (``cosecha.llm.words``); two documents link if their Jaccard
similarity is at least ``share`` percent, checked on the full sets with exact integers.

1. Documents with the same set are one class, found by a 128-bit digest of the set; its smallest doc_id stands for it.
2. Registers: for each of 512 hash functions the minimum over the set, as an exponential variate, is kept as its
   logarithm to the base 1.1, cut to 0..254: exponentially spaced, truncated minima.  The registers of a union are the
   maxima of the registers, so sketches merge.
3. Bands: 64 bands of 8 registers.  At a similarity of 0.85 a pair shares none with a probability of 2e-9, at 0.8 of
   8e-6.
4. Star round: each class of a bucket is compared with the bucket's smallest.  Then, only in buckets whose other
   classes are still in different components, all classes of different components are compared by their registers, in
   blocks of about 1,000, inside tasks; forests leave a task, pairs do not, and of all forests each class keeps one pair,
   which step 6 decides.  Where classes of different components, by the estimate, may still link, their full sets go
   to blocks that are bounded in bytes too, and the links are found there.  No pair that shares a bucket goes unseen
   unless it is already connected, and groups are never expanded to all their pairs.
5. Estimate, in all rounds: the similarity that is likeliest jointly for the numbers of registers that are larger,
   equal and smaller, given both set sizes.  A pair goes on to step 6 unless it is 4.5 standard errors too low.
6. Verification: exact sizes of intersection and union of the full sets.

Defined results: null, empty and blank texts have empty sets and link with nothing; rows with one doc_id are one node,
linked by any of its texts; rows with a null doc_id get a null component and are kept; an empty table gives an empty
result; extra columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cosecha.llm import words as W
from cosecha.llm.work import components, fresh, saved, small, sorted_runs

WIDTH = 5
SHARE = 80  # percent
REGISTERS = 512
BANDS = 64
BASE = 1.1
BLOCK = 1000  # classes of one bucket that a task compares with each other
BLOCK_BYTES = 32 << 20  # of full sets in such a block, on average
SMALL_IDS = 500_000  # ids that may be broadcast

_seeds = np.random.Generator(np.random.PCG64(77)).integers(1, 1 << 63, REGISTERS // 64 + BANDS, dtype=np.uint64)
_odd = np.random.Generator(np.random.PCG64(78)).integers(0, 1 << 31, 64, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def registers(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Registers (uint8) of sets of 64-bit hashes that lie one after the other."""
    low = np.full((len(bounds) - 1, REGISTERS), 0xFFFFFFFF, np.uint32)
    for g in range(REGISTERS // 64):
        x = (W.mix(hashes + _seeds[g]) >> np.uint64(32)).astype(np.uint32)
        own = slice(64 * g, 64 * g + 64)
        for i in range(len(bounds) - 1):
            for k in range(bounds[i], bounds[i + 1], 1024):  # a part that stays in the cache
                part = x[k : min(k + 1024, bounds[i + 1]), None] * _odd
                np.minimum(low[i, own], part.min(axis=0), out=low[i, own])
    h = -np.log1p(-(low.astype(np.float64) + 0.5) / 2.0**32)
    return np.clip(np.floor(24 - np.log(h) / np.log(BASE)), 0, 254).astype(np.uint8)


def band_keys(regs: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band; equal keys mean equal registers."""
    lanes = np.ascontiguousarray(regs).view(np.uint64)
    return W.mix(W.mix(lanes + _seeds[-BANDS:]) ^ np.arange(BANDS, dtype=np.uint64)).view(np.int64)


def likeliest(more: np.ndarray, less: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity, given in how many registers a is larger or smaller and the set sizes."""
    u = (size_a / (size_a + size_b))[:, None]
    v = 1 - u
    j = np.linspace(0, 1, 201)[None, :] * np.minimum(u / v, v / u)
    p = lambda x: -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)
    above, below = p(u - v * j), p(v - u * j)
    same = REGISTERS - more - less
    score = more[:, None] * np.log(above + 1e-12) + less[:, None] * np.log(below + 1e-12) + same[:, None] * np.log(np.maximum(1 - above - below, 1e-12))
    return j[np.arange(len(j)), score.argmax(axis=1)] if len(j) == len(score) else np.take_along_axis(np.broadcast_to(j, score.shape), score.argmax(axis=1)[:, None], 1)[:, 0]


def _least_estimate(share: int) -> float:
    t = share / 100
    return t - 4.5 * np.sqrt(t * (1 - t) / REGISTERS)


def _plausible(ra: np.ndarray, rb: np.ndarray, na: np.ndarray, nb: np.ndarray, share: int) -> np.ndarray:
    fits = 100 * np.minimum(na, nb) >= share * np.maximum(na, nb)
    more, less = (ra > rb).sum(axis=1), (ra < rb).sum(axis=1)
    fits &= REGISTERS - more - less >= (_least_estimate(share) - 0.05) * REGISTERS
    at = np.flatnonzero(fits)
    for k in range(0, len(at), 4096):
        part = at[k : k + 4096]
        fits[part] = likeliest(more[part], less[part], na[part].astype(float), nb[part].astype(float)) >= _least_estimate(share)
    return fits


def _regs(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    data, _ = W.text_buffer(column)
    return data.reshape(-1, REGISTERS)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in W.pieces(batch, "text"):
            sets, bounds = W.shingle_sets(part.column("text"), WIDTH)
            total = np.zeros(len(sets) + 1, np.uint64)
            np.cumsum(sets, out=total[1:])
            other = np.zeros(len(sets) + 1, np.uint64)
            np.cumsum(W.mix(sets ^ _seeds[0]), out=other[1:])
            regs = registers(sets, bounds)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array(np.diff(bounds)),
                    pa.array((total[bounds[1:]] - total[bounds[:-1]]).view(np.int64)),
                    pa.array((other[bounds[1:]] - other[bounds[:-1]]).view(np.int64)),
                    pa.array([r.tobytes() for r in regs], pa.binary()),
                ],
                names=["doc_id", "n_shingles", "digest_a", "digest_b", "regs"],
            )


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if len(batch):
            keys = band_keys(_regs(batch.column("regs")))
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(np.repeat(batch.column("class_id").to_numpy(), BANDS))], names=["bucket", "class_id"])


def _estimate(share: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                keep = _plausible(_regs(batch.column("regs_a")), _regs(batch.column("regs_b")), batch.column("n_a").to_numpy(), batch.column("n_b").to_numpy(), share)
                yield batch.select(["a", "b"]).filter(pa.array(keep))

    return run


def _sets(texts: pa.ChunkedArray) -> list[np.ndarray]:
    """The shingle set of every text."""
    out: list[np.ndarray] = []
    for batch in pa.table({"text": texts}).to_batches():
        for part in W.pieces(batch, "text"):
            sets, at = W.shingle_sets(part.column("text"), WIDTH)
            out += [sets[s:e].copy() for s, e in zip(at[:-1], at[1:], strict=True)]
    return out


def _written_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in W.pieces(batch, "text"):
            sets = [x.tobytes() for x in _sets(pa.chunked_array([part.column("text")]))]
            yield pa.RecordBatch.from_arrays([part.column("class_id"), pa.array(sets, pa.binary())], names=["class_id", "shingles"])


def _linked(x: np.ndarray, y: np.ndarray, share: int) -> bool:
    """Whether two sorted sets have the similarity, in exact integers."""
    if not len(x) or not len(y):
        return False
    spot = np.minimum(np.searchsorted(y, x), len(y) - 1)
    both = int((y[spot] == x).sum())
    return 100 * both >= share * (len(x) + len(y) - both)


def _met(share: int, table: pa.Table, starts: np.ndarray, comp: np.ndarray) -> Iterator[tuple[np.ndarray, int, np.ndarray]]:
    """(components of the run, i, the later rows of the run that the estimate keeps for row i).

    Rows of one component are left out; whoever takes a pair may join its components in the first array before it asks
    for the next.  A pair that shares many buckets comes in the first of them only.
    """
    bucket, n, block, low, high = (table.column(c).to_numpy() for c in ("bucket", "n", "block", "low", "high"))
    regs = _regs(table.column("regs"))
    for s, e in zip(starts[:-1], starts[1:], strict=True):
        lanes = np.ascontiguousarray(regs[s:e]).view(np.uint64)
        keys = band_keys(regs[s:e])
        for i in range(s, e):
            if low[s] != high[s] and block[i] != low[s]:
                continue
            rest = np.arange(i + 1, e) if low[s] == high[s] else s + np.flatnonzero(block[s:e] == high[s])
            rest = rest[comp[rest] != comp[i]]
            if len(rest):
                # a pair that shares many buckets is compared in the first
                first = (lanes[rest - s] == lanes[i - s]).argmax(axis=1)
                rest = rest[keys[i - s][first] == bucket[s]]
            if len(rest):
                one = np.broadcast_to(regs[i], (len(rest), REGISTERS))
                rest = rest[_plausible(one, regs[rest], np.broadcast_to(n[i], len(rest)), n[rest], share)]
            if len(rest):
                yield comp[s:e], i, rest


RUN = ["bucket", "low", "high"]


def _joined(share: int, exact: bool):
    """A forest over the components of each run: of pairs that the estimate keeps, or, if ``exact``, of links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in sorted_runs(batches, RUN):
            ids, comp = table.column("class_id").to_numpy(), table.column("comp").to_numpy().copy()
            sets = table.column("shingles") if exact else None
            set_of = lambda i: np.frombuffer(sets[i].as_buffer(), np.uint64)  # noqa: B023, E731
            found: list[tuple[int, int]] = []
            for own, i, rest in _met(share, table, starts, comp):
                for j in rest.tolist():
                    if comp[i] != comp[j] and (not exact or _linked(set_of(i), set_of(j), share)):
                        found.append((min(ids[i], ids[j]), max(ids[i], ids[j])))
                        own[own == comp[j]] = comp[i]
            if found:
                a, b = np.array(found, np.int64).T
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return run


def _unsettled(share: int):
    """The rows that the estimate keeps for a row of another component in their run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in sorted_runs(batches, RUN):
            some = np.zeros(len(table), bool)
            for _, i, rest in _met(share, table, starts, table.column("comp").to_numpy()):
                some[i] = some[rest] = True
            if some.any():
                yield from table.select(["bucket", "class_id"]).filter(pa.array(some)).combine_chunks().to_batches()

    return run


def _verify(share: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.pieces(batch, "text_a"):
                keep = [_linked(x, y, share) for x, y in zip(_sets(pa.chunked_array([part.column("text_a")])), _sets(pa.chunked_array([part.column("text_b")])), strict=True)]
                yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


PAIR = "a long, b long"


def _texts(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(class_id, text) of the documents with these ids."""
    ids = saved(ids.distinct(), "near-ids")
    return saved(docs.join(small(ids, SMALL_IDS), docs["doc_id"] == ids["id"], "left_semi").select(F.col("doc_id").alias("class_id"), "text"), "near-texts")


def _verified(pairs: DataFrame, docs: DataFrame, share: int) -> DataFrame:
    """The pairs of doc_ids that link by their full sets."""
    pairs = saved(pairs.distinct(), "near-pairs")
    texts = _texts(docs, pairs.select(F.col("a").alias("id")).union(pairs.select("b")))
    joined = pairs.join(texts.select(F.col("class_id").alias("a"), F.col("text").alias("text_a")), "a").join(texts.select(F.col("class_id").alias("b"), F.col("text").alias("text_b")), "b")
    return saved(joined.select("a", "b", "text_a", "text_b").mapInArrow(_verify(share), PAIR).distinct(), "near-links")


def near_duplicates(docs: DataFrame, share: int = SHARE) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``: classes, links and components as above."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sketches = saved(own.mapInArrow(_sketch, "doc_id long, n_shingles long, digest_a long, digest_b long, regs binary"), "sketches")
    digest = ["n_shingles", "digest_a", "digest_b"]
    full = sketches.where("n_shingles > 0 and doc_id is not null")
    classes = full.groupBy(*digest).agg(F.min("doc_id").alias("class_id"), F.min_by("regs", "doc_id").alias("regs"))
    classes = saved(classes.select(*digest, "class_id", "regs"), "classes")
    regs = classes.select(F.col("class_id"), F.col("n_shingles").alias("n"), "regs")

    bands = regs.select("class_id", "regs").mapInArrow(_bands, "bucket long, class_id long")
    leaders = bands.groupBy("bucket").agg(F.min("class_id").alias("leader"), F.count(F.lit(1)).alias("members")).where("members > 1")
    hits = saved(bands.join(leaders, "bucket").where("class_id <> leader"), "hits")

    def with_registers(pairs: DataFrame) -> DataFrame:
        a = regs.select(F.col("class_id").alias("a"), F.col("n").alias("n_a"), F.col("regs").alias("regs_a"))
        b = regs.select(F.col("class_id").alias("b"), F.col("n").alias("n_b"), F.col("regs").alias("regs_b"))
        return pairs.join(a, "a").join(b, "b").select("a", "b", "n_a", "n_b", "regs_a", "regs_b")

    star = hits.select(F.col("leader").alias("a"), F.col("class_id").alias("b")).distinct()
    links = _verified(with_registers(star).mapInArrow(_estimate(share), PAIR), own, share)

    def split(rows: DataFrame, known: DataFrame) -> DataFrame:
        """Rows (bucket, class_id, n) with their components, of buckets that hold several."""
        rest = rows.select("bucket", "class_id", "n").join(known.select(F.col("node").alias("class_id"), "root"), "class_id", "left")
        rest = saved(rest.select("bucket", "class_id", "n", F.coalesce("root", "class_id").alias("comp")), "rest")
        held = rest.groupBy("bucket").agg(F.count(F.lit(1)).alias("members"), F.sum("n").alias("volume"), F.min("comp").alias("low_comp"), F.max("comp").alias("high_comp"))
        return rest.join(held.where("low_comp <> high_comp").drop("low_comp", "high_comp"), "bucket")

    def dealt(rows: DataFrame, blocks: Column) -> DataFrame:
        """Each row with its registers, once for every pair of blocks that its own is one of."""
        rest = rows.withColumn("blocks", F.greatest(F.lit(1), F.ceil(blocks)).cast("long")).withColumn("block", F.pmod(F.xxhash64("class_id"), F.col("blocks")))
        rest = rest.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        return rest.select("bucket", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "class_id", "n", "comp").join(regs.select("class_id", "regs"), "class_id")

    def runs(rows: DataFrame) -> DataFrame:
        return rows.repartition(*RUN).sortWithinPartitions(*RUN, "class_id")

    by_count = F.col("members") / BLOCK
    hits = hits.join(regs.select("class_id", "n"), "class_id")
    # by registers alone: of the pairs that would join components one for each class, the others wait for its outcome
    forest = runs(dealt(split(hits, components(links)), by_count)).mapInArrow(_joined(share, exact=False), PAIR)
    forest = saved(forest.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), "forest")
    if not forest.isEmpty():
        links = links.union(_verified(forest, own, share))
        known = saved(components(links), "known")
        # full sets go only where a pair that the estimate keeps is still in two components
        left = runs(dealt(split(hits, known), by_count)).mapInArrow(_unsettled(share), "bucket long, class_id long").distinct()
        left = saved(left.join(regs.select("class_id", "n"), "class_id"), "unsettled")
        if not left.isEmpty():
            rest = saved(dealt(split(left, known), F.greatest(by_count, F.col("volume") * 8 / BLOCK_BYTES)), "blocks")
            sets = _texts(own, rest.select(F.col("class_id").alias("id"))).mapInArrow(_written_sets, "class_id long, shingles binary")
            links = links.union(saved(runs(rest.join(sets, "class_id")).mapInArrow(_joined(share, exact=True), PAIR), "more-links"))

    # documents of a class are linked to its smallest id; a doc_id with several texts joins their classes
    copies = full.join(classes.select(*digest, "class_id"), digest).where("doc_id <> class_id").select(F.col("class_id").alias("a"), F.col("doc_id").alias("b"))
    linked = components(links.union(copies))
    out = sketches.select("doc_id", "n_shingles").join(linked.select(F.col("node").alias("doc_id"), "root"), "doc_id", "left")
    out = out.withColumn("component_id", F.coalesce("root", "doc_id"))
    return out.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def one_of_each(docs: DataFrame, share: int = SHARE) -> DataFrame:
    """``docs`` with one document of each component, the first by doc_id, and all that link with nothing.

    Rows whose doc_id is null or comes more than once are documents of their own, told apart by all their columns and
    taken after the others; equal rows count once.  All columns stay, whatever their names.
    """
    node, whole, twin, gone_id = fresh(docs, "near_node", "near_row", "near_twin", "near_gone")
    twins = docs.groupBy(F.col("doc_id").alias(twin)).count().where(F.col("count") > 1).select(twin).where(f"`{twin}` is not null")
    twins = saved(twins, "near-twins")
    some = small(twins, SMALL_IDS)
    plain = docs.where("doc_id is not null").join(some, F.col("doc_id") == F.col(twin), "left_anti")
    odd = docs.join(some, F.col("doc_id") == F.col(twin), "left_semi").union(docs.where("doc_id is null"))
    odd = odd.withColumn(whole, F.md5(F.to_json(F.struct(*[F.col(f"`{c}`") for c in docs.columns])))).dropDuplicates([whole])
    odd = odd.repartitionByRange("doc_id", whole).sortWithinPartitions("doc_id", whole)
    # numbers in this order, behind all ids, or before them where there is no room
    odd = saved(odd.withColumn(node, F.monotonically_increasing_id()).drop(whole), "near-odd")
    ends = docs.agg(F.min("doc_id").cast("long").alias("low"), F.max("doc_id").cast("long").alias("high")).first()
    room = 1 << 62
    behind = ends.high is None or ends.high < room
    if not behind and ends.low <= -room:
        raise ValueError("ids from one end of the 64-bit integers to the other leave no room for rows that share an id")
    shift = max((ends.high or 0) + 1, 0) if behind else -2 * room
    rows = plain.withColumn(node, F.col("doc_id").cast("long")).union(odd.withColumn(node, F.col(node) + F.lit(shift)))
    found = near_duplicates(rows.select(F.col(node).alias("doc_id"), "text"), share)
    gone = saved(found.where("not kept").select(F.col("doc_id").alias(gone_id)).distinct(), "near-gone")
    left = rows.join(small(gone, SMALL_IDS), F.col(node) == F.col(gone_id), "left_anti")
    return left.select(*[F.col(f"`{c}`") for c in docs.columns])


def op4(spark, sf_dir: str) -> DataFrame:
    """One row per document: set size, component and whether it stays, at 85 percent."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), share=85)


OP4_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
l AS (SELECT doc_id, list_distinct(CASE WHEN len(w) >= 5 THEN [array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)] WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM d),
s AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM l),
p AS (SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
e AS (SELECT a, b FROM p UNION ALL SELECT b, a FROM p),
r AS (SELECT DISTINCT a AS node, a AS other FROM e UNION SELECT r.node, e.b FROM r JOIN e ON r.other = e.a)
SELECT l.doc_id, CAST(len(s) AS BIGINT) AS n_shingles, coalesce(root, l.doc_id) AS component_id, coalesce(root, l.doc_id) = l.doc_id AS kept
FROM l LEFT JOIN (SELECT node, min(other) AS root FROM r GROUP BY 1) ON node = l.doc_id
"""
