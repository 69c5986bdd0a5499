"""Near-duplicate embeddings by collision counting on one-dimensional projections.

Vectors of length d are projected on d orthonormal directions.  Two vectors collide on a direction if their projections
differ by at most the half window; a pair that collides on at least ``least`` directions is verified, and links if its
cosine in double precision is ``cosine`` or more.

Calibration: the squares of a pair's d differences sum to the square of its distance, whatever the data.  With a half
window of twice the root mean square for a pair right at the threshold, fewer than d / 4 of them can exceed it, so a
pair at the threshold or above collides on more than 3 d / 4 directions.  No such pair is missed by the count.
Of two random vectors in 64 dimensions about 35 % of the directions collide, and fewer than one pair in 1e9 reaches 49.

Work is dealt by cells: in each of ``tables`` tables, ``width`` other directions are cut into ranges at random places,
and vectors in the same ranges meet.  The width grows with the logarithm of the number of vectors, so that cells keep
their size, and the tables are as many as keep the chance that a pair at the threshold meets in none below 1e-5: 20
tables below 70,000 vectors of 64 components, 33 for a million, 84 for a thousand million.  A pair counts in its first table.

Members of a large cell are dealt to blocks, and each pair of blocks is one unit of work: both are sorted by the first
direction, and every window of the one is a slice of the other.  Links are summed and joined to a forest slice by slice, so
what a task holds and what leaves it is as large as its rows, never as its pairs.  Equal vectors are one class with a
multiplicity from the start.

Defined results: null, zero, empty vectors and those with null or non-finite components have no links and their own
id as component; vectors of different lengths do not link; rows with one vec_id are one node but have the links of
their own vector; rows with a null vec_id are invalid; an empty table gives an empty result; ``label`` and other
columns do not matter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cosecha.llm.work import components, saved, small, sorted_runs
from cosecha.llm.words import mix

COSINE = 0.95
LEAST_WIDTH, FEW = 6, 100  # directions of a table, at least; so many vectors are expected in a cell otherwise
RANGE = 6.3  # of a direction, times the root mean square difference of a pair at the threshold
LONE = 16_000  # members of a cell that one unit takes
BLOCK = 8_000  # members of a block of a larger cell
BIG_CELLS = 500_000  # cells of several blocks that may be broadcast
STEPS = 16_000  # projections are counted in so many steps from 0 to 1
SLICE = 32


class Plan:
    """Directions, windows, counts and cells for vectors of one length."""

    def __init__(self, dim: int, cosine: float, vectors: int):
        self.distance = math.sqrt(max(0.0, 2 - 2 * cosine))
        typical = self.distance / math.sqrt(dim)
        self.window = min(self.distance, 2 * typical) + 1e-6
        self.least = dim - max(0, math.ceil((self.distance / self.window) ** 2) - 1)
        rng = np.random.Generator(np.random.PCG64(dim))
        frame = lambda: np.linalg.qr(rng.normal(size=(dim, dim)))[0]
        self.frame, self.cell = frame(), RANGE * typical + 1e-6
        self.width = max(LEAST_WIDTH, math.ceil(math.log(max(1.0, vectors / FEW)) / math.log(3)))
        # tables are added until random pairs at the threshold, with ranges cut at random, are missed by as few
        pairs = rng.normal(size=(2000, dim))
        pairs *= self.distance / np.linalg.norm(pairs, axis=1, keepdims=True)
        spare, groups, miss = frame(), [], np.ones(len(pairs))
        while miss.mean() > 1e-5:
            while spare.shape[1] < self.width:
                spare = np.concatenate([spare, frame()], axis=1)
            groups.append(spare[:, : self.width])
            spare = spare[:, self.width :]
            miss *= 1 - np.prod(np.maximum(0, 1 - np.abs(pairs @ groups[-1]) / self.cell), axis=1)
        self.tables = len(groups)
        self.directions = np.concatenate(groups, axis=1)
        self.shifts = rng.random(self.tables * self.width) * self.cell

    def cells(self, unit: np.ndarray) -> np.ndarray:
        """A key for each vector's cell in each table; summed in one order, so that every task finds the same to the last bit."""
        out = np.empty((len(unit), self.tables), np.uint64)
        for k in range(0, len(unit), 64):
            own = np.floor(((unit[k : k + 64, :, None] * self.directions).sum(axis=1) + self.shifts) / self.cell).astype(np.int64).astype(np.uint64)
            own = own.reshape(-1, self.tables, self.width)
            key = np.tile(np.arange(self.tables, dtype=np.uint64) + np.uint64(1000 * unit.shape[1]), (len(own), 1))
            for c in range(self.width):
                key = mix(key ^ own[:, :, c])
            out[k : k + 64] = key
        return out

    def steps(self, unit: np.ndarray) -> np.ndarray:
        """Projections on all directions, in steps: a row for each direction."""
        return np.ascontiguousarray(np.floor(unit @ self.frame * STEPS).astype(np.int16).T).view(np.uint16)


def collisions(p: Plan, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """On how many directions each of the vectors ``a`` collides with each of ``b``, both given in steps."""
    reach = np.uint16(math.ceil(p.window * STEPS) + 1)
    count = np.zeros((a.shape[1], b.shape[1]), np.uint8 if len(a) < 256 else np.uint16)
    apart, hit = np.empty(count.shape, np.uint16), np.empty(count.shape, bool)
    for own, other in zip(a + reach, b, strict=True):
        np.subtract(own[:, None], other[None, :], out=apart)
        np.less_equal(apart, 2 * reach, out=hit)
        count += hit
    return count


@lru_cache(64)
def plan(dim: int, cosine: float, vectors: int) -> Plan:
    return Plan(dim, cosine, vectors)


_CELLS = "cell long, table_no int, id long, rep long, mult long, vec binary"


def _normed(raw: np.ndarray) -> np.ndarray:
    x = raw.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _vectors(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, rows, vectors as they are) for each length in a batch."""
    column = batch.column("embedding")
    lengths = np.diff(column.offsets.to_numpy())
    for dim in np.unique(lengths):
        rows = np.flatnonzero(lengths == dim)
        yield int(dim), rows, column.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _cells(cosine: float, vectors: int, light: bool):
    """The cells of each vector; ``light``: their keys only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, len(whole), 1000):
                batch = whole.slice(start, 1000)
                for dim, rows, raw in _vectors(batch):
                    p = plan(dim, cosine, vectors)
                    keys = pa.array(p.cells(_normed(raw)).ravel().view(np.int64))
                    if light:
                        yield pa.RecordBatch.from_arrays([keys], names=["cell"])
                        continue
                    at = pa.array(np.repeat(np.arange(len(rows)), p.tables))
                    table = pa.array(np.tile(np.arange(p.tables, dtype=np.int32), len(rows)))
                    own = [batch.column(c).take(pa.array(rows)).take(at) for c in ("id", "rep", "mult")]
                    vecs = pa.array([x.tobytes() for x in raw], pa.binary()).take(at)
                    yield pa.RecordBatch.from_arrays([keys, table, *own, vecs], names=["cell", "table_no", "id", "rep", "mult", "vec"])

    return run


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least node that is reachable from each, over the edges (a, b)."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == before).all():
            return label


def _links(cosine: float, vectors: int, dtype: str):
    """Sums of links (id, rep, links) and edges (id, rep, other) of a forest."""

    def meet(p: Plan, t: int, unit, mult, left, right) -> tuple[np.ndarray, np.ndarray]:
        """(sums of links, least node reached) of the vectors of a unit, over the pairs of ``left`` and ``right``."""
        steps, first = p.steps(unit), unit @ p.frame[:, 0]
        same = left is right
        left, right = (x[np.argsort(first[x], kind="stable")] for x in (left, right))
        ranked = first[right]
        sums, label, place = np.zeros(len(unit), np.int64), np.arange(len(unit)), np.empty(len(unit), np.int64)
        place[right] = np.arange(len(right))
        cells, known = np.zeros((len(unit), p.tables), np.uint64), np.zeros(len(unit), bool)
        for k in range(0, len(left), SLICE):
            own = left[k : k + SLICE]
            lo = np.searchsorted(ranked, first[own[0]] - p.distance - 1e-6)
            hi = np.searchsorted(ranked, first[own[-1]] + p.distance + 1e-6, "right")
            near = right[max(lo, k) if same else lo : hi]
            if not len(near):
                continue
            i, j = np.nonzero(collisions(p, steps[:, own], steps[:, near]) >= p.least)
            a, b = own[i], near[j]
            for part in range(0, len(a), 1 << 15):
                x, y = a[part : part + (1 << 15)], b[part : part + (1 << 15)]
                ok = np.einsum("ij,ij->i", unit[x], unit[y]) >= cosine
                if same:
                    ok &= place[x] < place[y]
                x, y = x[ok], y[ok]
                new = np.unique(np.concatenate([x, y]))
                new = new[~known[new]]
                cells[new], known[new] = p.cells(unit[new]), True
                ok = (cells[x] == cells[y]).argmax(axis=1) == t  # they meet in this table for the first time
                x, y = x[ok], y[ok]
                sums += np.bincount(x, mult[y], len(unit)).astype(np.int64) + np.bincount(y, mult[x], len(unit)).astype(np.int64)
                x, y = label[x], label[y]
                new = np.flatnonzero(x != y)
                if len(new):
                    label = _forest(len(unit), x[new], y[new])[label]
        return sums, label

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in sorted_runs(batches, ["cell", "low", "high"]):
            block, low, high, ids, reps, mults, tables = (table.column(c).to_numpy() for c in ("block", "low", "high", "id", "rep", "mult", "table_no"))
            raw = [np.frombuffer(x, dtype) for x in table.column("vec").to_pylist()]
            for s, e in zip(starts[:-1], starts[1:], strict=True):
                kinds = {(int(tables[i]), len(raw[i])) for i in range(s, e)}
                for t, dim in kinds:
                    rows = np.array([i for i in range(s, e) if tables[i] == t and len(raw[i]) == dim])
                    left = np.flatnonzero(block[rows] == low[s])
                    right = left if low[s] == high[s] else np.flatnonzero(block[rows] == high[s])
                    if not len(left) or not len(right):
                        continue
                    own, rep, mult = ids[rows], reps[rows], mults[rows]
                    unit = _normed(np.stack([raw[i] for i in rows]))
                    sums, label = meet(plan(dim, cosine, vectors), t, unit, mult, left, right)
                    has, tied = np.flatnonzero(sums), np.flatnonzero(label != np.arange(len(rows)))
                    nothing = pa.nulls(len(has), pa.int64())
                    yield pa.RecordBatch.from_arrays([pa.array(own[has]), pa.array(rep[has]), pa.array(sums[has]), nothing], names=["id", "rep", "links", "other"])
                    yield pa.RecordBatch.from_arrays([pa.array(own[tied]), pa.array(rep[tied]), pa.array(np.zeros(len(tied), np.int64)), pa.array(rep[label[tied]])], names=["id", "rep", "links", "other"])

    return run


def linked(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of ``vectors`` (vec_id, embedding)."""
    x = F.col("embedding")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    sound = F.col("vec_id").isNotNull() & x.isNotNull() & ~bad & F.exists(x, lambda v: v != 0)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x if dict(vectors.dtypes)["embedding"] == "array<float>" else x.cast("array<double>").alias("embedding"))
    # -0.0 is 0.0; two hashes of 64 bits, the first of which is the class's id
    plain = F.transform(x, lambda v: F.when(v == 0, F.lit(0.0)).otherwise(v.cast("double")))
    rows = rows.withColumn("sound", F.coalesce(sound, F.lit(False)))
    rows = rows.withColumn("id", F.when(F.col("sound"), F.xxhash64(plain))).withColumn("check", F.when(F.col("sound"), F.xxhash64(F.lit(7), plain)))
    classes = rows.where("sound").groupBy("id", "check").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("mult"), F.any_value("embedding").alias("embedding"))
    classes = saved(classes, "vectors")
    n = classes.count()
    dtype = "f4" if dict(vectors.dtypes)["embedding"] == "array<float>" else "f8"

    parts = max(8, n // 2000)
    spread = classes.select("id", "rep", "mult", "embedding").repartition(min(parts, 4000))
    counts = spread.mapInArrow(_cells(cosine, n, True), "cell long").groupBy("cell").agg(F.count(F.lit(1)).alias("members"))
    big = saved(counts.where(F.col("members") > LONE), "big-cells")
    meets = spread.mapInArrow(_cells(cosine, n, False), _CELLS).join(small(big, BIG_CELLS), "cell", "left")
    blocks = F.coalesce(F.ceil(F.col("members") / BLOCK), F.lit(1)).cast("int")
    meets = meets.withColumn("block", (F.shiftrightunsigned(F.xxhash64("id"), 1) % blocks).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    meets = meets.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})
    keys = ["cell", "low", "high"]
    meets = meets.select(*keys, "block", "id", "rep", "mult", "table_no", "vec").repartition(*keys).sortWithinPartitions(*keys)
    found = saved(meets.mapInArrow(_links(cosine, n, dtype), "id long, rep long, links long, other long"), "embedding-links")

    sums = found.where("other is null").groupBy("id", "rep").agg(F.sum("links").alias("links"))
    members = rows.where("sound").join(classes.select("id", "check", "rep", "mult"), ["id", "check"]).select("vec_id", "id", "check", "rep", "mult")
    edges = found.where("other is not null").select(F.col("rep").alias("a"), F.col("other").alias("b"))
    roots = components(edges.union(members.where("vec_id <> rep").select("vec_id", "rep")), "embedding-components")
    told = classes.select("id", "check", "rep", "mult").join(sums, ["id", "rep"], "left").join(roots, F.col("node") == F.col("rep"), "left")
    told = told.select("id", "check", (F.col("mult") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("root", "rep").alias("component_id"))
    good = rows.where("sound").select("vec_id", "id", "check").join(told, ["id", "check"]).select("vec_id", "n_links", "component_id")
    out = good.union(rows.where("not sound").select("vec_id", F.lit(0).cast("long"), F.col("vec_id")))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op3(spark, sf_dir: str) -> DataFrame:
    """One row per vector: its links, its component and whether it stays."""
    return linked(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


OP3_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
p AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id < b.vec_id AND len(a.x) = len(b.x) AND list_cosine_similarity(a.x, b.x) >= 0.95),
e AS (SELECT a, b FROM p UNION ALL SELECT b, a FROM p),
r AS (SELECT DISTINCT a AS node, a AS other FROM e UNION SELECT r.node, e.b FROM r JOIN e ON r.other = e.a)
SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(root, vec_id) AS component_id, coalesce(root, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN (SELECT node, min(other) AS root FROM r GROUP BY 1) c ON c.node = vec_id LEFT JOIN (SELECT a, count(*) AS n FROM e GROUP BY 1) k ON k.a = vec_id
"""
