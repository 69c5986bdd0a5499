"""The trie of conversation prefixes, by union-find over the common prefixes of sorted neighbours.

Each conversation is a sequence of turns; a turn is (role, text).  A node is a distinct sequence of a conversation's
first turns; its members are the conversations that start with it.

1. A turn becomes a 16-byte digest and the length of its text; texts are not shuffled further.  Conversations of equal
   sequences become one class: its members' ids stream through a hash in order, and are never held together.
2. Classes are sorted by their digests, so neighbours share the longest prefixes (LCP) of all.  The LCPs are taken in one
   pass over the sorted rows; those between partitions come from a table of one row a partition.
3. Blocks of sorted classes become forests: union-find over a block's edges in descending LCP; each merge of two
   components makes a branching node, or joins the one that is at that depth already.
4. Nodes on the path of a block's first class down to the LCP with the block before, or of its last down to the LCP with
   the block behind, may be in several blocks.  Only they are contracted to (key, sums) and merged by key; the LCPs tell
   which block counts a node, a child or a leaf that several see, so that sums over subtrees add up.

A block holds 2 ** ``BLOCK_BITS`` classes, so memory follows the longest conversations, at 20 bytes a turn, not their number or
the size of a group of copies.  A conversation's digests are one row.

Defined results: null role or text is empty; turns with equal numbers, and those without, are ordered by role and then by
the digest of role and text; a null conv_id names no conversation, its rows are left out; other columns do not matter; an
empty table gives no nodes, not even a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cosecha.llm.work import saved, small, sorted_runs

DIGEST = 16  # bytes of a turn's digest
BLOCK_BITS = 12  # classes in a block, as a power of two
EDGES = 100_000  # partitions of sorted classes, and shared nodes, that may be broadcast
NONE = hashlib.sha256().hexdigest()

NODE = {
    "conv_id": "long", "depth": "long", "parent_conv_id": "long", "n_convs": "long", "n_children": "long", "n_leaves": "long", "saved_tokens": "long",
    "ends": "string", "own": "binary", "above": "binary",
}


def sequences(turns: DataFrame) -> DataFrame:
    """(conv_id, turns): the turns in order, each as the hexadecimal digest of role and text and the code points of text."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    turn = F.struct(F.col("turn").isNotNull().alias("numbered"), F.coalesce("turn", F.lit(0)).alias("turn"), role.alias("role"), digest.alias("d"), F.length(text).cast("long").alias("len"))
    rows = turns.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("t"))
    grouped = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("t"))
    return grouped.select("conv_id", F.transform("t", lambda t: F.struct(t["d"].alias("d"), t["len"].alias("len"))).alias("turns"))


def rebuilt(own: DataFrame, every: int = 100, most: int = 6) -> DataFrame:
    """Conversations whose first turns are those of the first conversation of their hundred.

    The first h turns of conversation c - c % ``every`` (all if it has fewer, none if it is absent) take the place of the
    first h of conversation c; h is the unsigned crc32 of c in decimal, modulo ``most``.
    """
    head = (F.col("conv_id") - F.col("conv_id") % every).alias("head")
    heads = own.where(F.col("conv_id") % every == 0).select(F.col("conv_id").alias("head"), F.slice("turns", 1, most - 1).alias("first"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    joined = own.select("*", head, h.alias("h")).join(heads, "head", "left")
    first = F.slice(F.coalesce("first", F.slice("turns", 1, 0)), F.lit(1), F.col("h"))
    behind = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))
    return joined.select("conv_id", F.concat(first, behind).alias("turns"))


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Classes from rows sorted by class and id; of a class's ids only a hash is kept."""
    now, first, count, state = None, 0, 0, None
    out: list[tuple[int, int, str]] = []

    def rows() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names=["class_id", "members", "ends"])

    for batch in batches:
        keys, ids = batch.column("key").to_pylist(), batch.column("conv_id").to_numpy()
        cuts = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
        for s, e in zip(cuts[:-1], cuts[1:], strict=True):
            if s == e:
                continue
            if keys[s] != now:
                if state is not None:
                    out.append((first, count, state.hexdigest()))
                now, first, count, state = keys[s], int(ids[s]), 0, hashlib.sha256()
            state.update((("," if count else "") + ",".join(map(str, ids[s:e].tolist()))).encode())
            count += e - s
        if len(out) >= 10_000:
            yield rows()
            out = []
    if state is not None:
        out.append((first, count, state.hexdigest()))
        yield rows()


def _lcp(a: bytes, b: bytes) -> int:
    """Digests that two sequences have in common at their start."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n // DIGEST
    low, high = 0, n // DIGEST  # a[: low * DIGEST] is shared, a[: high * DIGEST] is not
    while high - low > 1:
        mid = (low + high) // 2
        if a[low * DIGEST : mid * DIGEST] == b[low * DIGEST : mid * DIGEST]:
            low = mid
        else:
            high = mid
    return low


def _with_lcps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds (before, behind), the LCPs with the neighbours, to sorted rows; null at the ends of the partition."""
    held: pa.RecordBatch | None = None  # the last row so far
    before: int | None = None
    for batch in batches:
        if not len(batch):
            continue
        rows = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks()
        keys = rows.column("key").to_pylist()
        shared = [_lcp(x, y) for x, y in zip(keys[:-1], keys[1:], strict=True)]
        held = rows.slice(len(rows) - 1).to_batches()[0]
        if shared:
            yield from _spread(rows.slice(0, len(rows) - 1), [before, *shared[:-1]], shared)
            before = shared[-1]
    if held is not None:
        yield from _spread(pa.Table.from_batches([held]), [before], [None])


def _spread(rows: pa.Table, before: list, behind: list) -> Iterator[pa.RecordBatch]:
    yield from rows.append_column("before", pa.array(before, pa.int64())).append_column("behind", pa.array(behind, pa.int64())).to_batches()


def _between(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """LCP of a partition's first class with the last of the partition before; -1 where there is none."""
    for batch in batches:
        shared = [-1 if x is None else _lcp(x, y) for x, y in zip(batch.column("last_before").to_pylist(), batch.column("first").to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("part"), pa.array(shared, pa.int64())], names=["part", "shared"])


def _path_keys(key: bytes, depth: int) -> list[bytes]:
    """Digests that name the prefixes of 0, 1, ... ``depth`` turns."""
    state, out = hashlib.sha256(), []
    for d in range(depth + 1):
        if d:
            state.update(key[(d - 1) * DIGEST : d * DIGEST])
        out.append(state.copy().digest())
    return out


class _Forest:
    """Union-find over the LCP edges of sorted classes; a component's top is the node of its whole prefix."""

    def __init__(self, depths: np.ndarray, members: np.ndarray, ids: np.ndarray) -> None:
        m = len(depths)
        self.depth, self.n, self.low = depths.tolist(), members.tolist(), ids.tolist()
        self.first, self.last = list(range(m)), list(range(m))  # classes below a node
        self.up = [-1] * m
        self.root = list(range(m))  # of union-find, over classes
        self.top = list(range(m))  # node by root

    def find(self, i: int) -> int:
        root = self.root
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    def add(self, depth: int, child: int) -> int:
        """A new node above ``child``."""
        node = len(self.depth)
        for column, value in ((self.depth, depth), (self.n, self.n[child]), (self.low, self.low[child]), (self.first, self.first[child]), (self.last, self.last[child]), (self.up, -1)):
            column.append(value)
        self.up[child] = node
        return node

    def merge(self, depth: int, i: int) -> None:
        """Joins the components of classes i - 1 and i, which share ``depth`` turns; equal depths from left to right."""
        a, b = self.find(i - 1), self.find(i)
        left, right = self.top[a], self.top[b]
        node = left if self.depth[left] == depth else self.add(depth, left)
        self.up[right] = node
        self.n[node] += self.n[right]
        self.low[node] = min(self.low[node], self.low[right])
        self.last[node] = self.last[right]
        # the later class hangs below the earlier: halving paths keeps finds short
        self.root[b] = a
        self.top[a] = node


def _forest(keys: list[bytes], lens: list[np.ndarray], members: np.ndarray, ids: np.ndarray, ends: list[str], before: np.ndarray, behind: np.ndarray) -> pa.RecordBatch:
    """All nodes of a block of sorted classes, with sums over what this block counts of their subtrees."""
    m = len(keys)
    left, right = int(before[0]), int(behind[-1])  # -1: nothing before, nothing behind
    depths = np.array([len(k) // DIGEST for k in keys], np.int64)
    forest = _Forest(depths, members, ids)
    for i in (np.argsort(-before[1:], kind="stable") + 1).tolist():
        forest.merge(int(before[i]), i)
    top = forest.top[forest.find(0)]
    if forest.depth[top]:
        forest.add(0, top)

    size = len(forest.depth)
    total = [0] * size  # saved tokens of a node's children's subtrees, as this block counts them
    leaves = [0] * size
    children = [0] * size
    for i in range(m):
        leaves[i] = int(behind[i] < depths[i])  # the next class does not go on from here
    left_keys = _path_keys(keys[0], left)
    right_keys = _path_keys(keys[-1], right)
    columns: list[list[np.ndarray]] = [[] for _ in range(6)]
    texts: list[tuple[int, str]] = []
    owns: list[tuple[int, bytes]] = []
    aboves: list[tuple[int, bytes]] = []
    at = 0

    def shared(node: int, depth: int) -> bytes | None:
        """The key of a prefix that other blocks may see too."""
        if depth <= left and forest.first[node] == 0:
            return left_keys[depth]
        return right_keys[depth] if depth <= right and forest.last[node] == m - 1 else None

    deepest_first = sorted(range(size), key=lambda x: -forest.depth[x])
    for v in deepest_first:
        deep, up = forest.depth[v], forest.up[v]
        high = forest.depth[up] if up >= 0 else -1
        count = deep - high
        # the nodes of the way down from the parent, deepest first: all have the same members
        d = np.arange(deep, high, -1)
        tokens = np.zeros(count, np.int64)
        own = lens[forest.first[v]]
        if deep:
            low = max(high, 0)
            tokens[: deep - low] = own[low:deep][::-1]
        # a prefix that the block before has too is counted there once
        once = np.ones(count, np.int64)
        if forest.first[v] == 0 and left >= 0:
            once[d <= left] = 0
        sums = total[v] + np.cumsum((forest.n[v] - once) * tokens)
        kids = np.ones(count, np.int64)
        kids[0] = children[v]
        kids[1:] = once[:-1]
        columns[0].append(np.full(count, forest.low[v]))
        columns[1].append(d)
        columns[2].append(np.full(count, forest.n[v]))
        columns[3].append(kids)
        columns[4].append(np.full(count, leaves[v]))
        columns[5].append(sums)
        if v < m:
            texts.append((at, ends[v]))
        # few prefixes are shared: those of the two ways down the sides
        if (forest.first[v] == 0 and high < left) or (forest.last[v] == m - 1 and high < right):
            for k, depth in enumerate(d.tolist()):
                if (key := shared(v, depth)) is not None:
                    owns.append((at + k, key))
                if k + 1 < count and (key := shared(v, depth - 1)) is not None:
                    aboves.append((at + k, key))
        if up >= 0:
            if (key := shared(up, high)) is not None:
                aboves.append((at + count - 1, key))
            total[up] += int(sums[-1])
            leaves[up] += leaves[v]
            children[up] += int(once[-1])
        at += count

    low, depth, n, kids, leaf, sums = (np.concatenate(c).astype(np.int64) for c in columns)
    # the deepest of a way has the parent node's least member above its last
    parents = low.copy()
    spot = 0
    for v, block in zip(deepest_first, columns[0], strict=True):
        spot += len(block)
        parents[spot - 1] = forest.low[forest.up[v]] if forest.up[v] >= 0 else 0
    is_root = depth == 0

    def sparse(pairs: list[tuple[int, object]], kind: pa.DataType) -> pa.Array:
        values: list[object] = [None] * at
        for k, x in pairs:
            values[k] = x
        return pa.array(values, kind)

    return pa.RecordBatch.from_arrays(
        [pa.array(low), pa.array(depth), pa.array(parents, mask=is_root), pa.array(n), pa.array(kids), pa.array(leaf), pa.array(sums), sparse(texts, pa.string()), sparse(owns, pa.binary()), sparse(aboves, pa.binary())],
        names=list(NODE),
    )


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table, starts in sorted_runs(batches, ["block"]):
        for s, e in zip(starts[:-1], starts[1:], strict=True):
            run = table.slice(s, e - s)
            whole = {c: run.column(c).combine_chunks() for c in ("members", "class_id", "before", "behind")}
            numbers = [x.to_numpy(zero_copy_only=False) for x in whole.values()]
            lens = [np.array(x, np.int64) for x in run.column("lens").to_pylist()]
            yield _forest(run.column("key").to_pylist(), lens, numbers[0], numbers[1], run.column("ends").to_pylist(), numbers[2], numbers[3])


def trie(conversations: DataFrame) -> DataFrame:
    """One row per node of the trie of (conv_id, turns), as ``sequences`` gives them.

    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256), where conv_id is the
    node's least member, leaves are the childless nodes below, and saved_tokens are the code points that a cache of
    prefixes would not read again: over the subtree, one less than the members, times the length of the last text.
    """
    key = F.unhex(F.array_join(F.transform("turns", lambda t: t["d"]), ""))
    seqs = saved(conversations.select("conv_id", key.alias("key"), F.transform("turns", lambda t: t["len"]).alias("lens")), "conversations")
    # equal sequences are one class
    ids = seqs.select(F.md5("key").alias("key"), "conv_id").repartition("key").sortWithinPartitions("key", "conv_id")
    classes = ids.mapInArrow(_members, "class_id long, members long, ends string")
    classes = classes.join(seqs.withColumnRenamed("conv_id", "class_id"), "class_id")
    order = classes.repartitionByRange("key").sortWithinPartitions("key")
    numbered = order.select("class_id", "members", "ends", "key", "lens", F.monotonically_increasing_id().alias("place"))
    kept = saved(numbered.mapInArrow(_with_lcps, "class_id long, members long, ends string, key binary, lens array<bigint>, place long, before long, behind long"), "sorted")

    # LCPs across partitions: a row for each of them
    kept = kept.withColumn("part", F.shiftright("place", 33))
    ends = kept.where("before is null or behind is null").groupBy("part").agg(F.min("key").alias("first"), F.max("key").alias("last"))
    ends = ends.withColumn("last_before", F.lag("last").over(Window.orderBy("part"))).select("part", "first", "last_before")
    gaps = saved(ends.mapInArrow(_between, "part long, shared long"), "gaps")
    gaps = gaps.withColumn("after", F.lead("shared", 1, -1).over(Window.orderBy("part")))
    joined = kept.join(small(gaps, EDGES), "part")
    joined = joined.withColumn("before", F.coalesce("before", "shared")).withColumn("behind", F.coalesce("behind", "after")).withColumn("block", F.shiftright("place", BLOCK_BITS))
    joined = joined.select("block", "place", "class_id", "members", "ends", "key", "lens", "before", "behind")
    nodes = saved(joined.repartition("block").sortWithinPartitions("block", "place").drop("place").mapInArrow(_blocks, ", ".join(f"{c} {kind}" for c, kind in NODE.items())), "nodes")

    # what several blocks see is merged by key
    sums = ("n_convs", "n_children", "n_leaves", "saved_tokens")
    merged = nodes.where("own is not null").groupBy("own").agg(
        F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"), *[F.sum(c).alias(c) for c in sums], F.max("ends").alias("ends"), F.max("above").alias("above")
    )
    merged = saved(merged, "merged-nodes")
    parents = small(merged.select(F.col("own").alias("above"), F.col("conv_id").alias("from_above")), EDGES)
    out = ["conv_id", "depth", "parent_conv_id", *sums, "ends"]
    inner = nodes.where("own is null")
    below = inner.where("above is not null").drop("parent_conv_id").join(parents, "above").withColumnRenamed("from_above", "parent_conv_id")
    tops = merged.join(parents, "above", "left").withColumnRenamed("from_above", "parent_conv_id")
    every = inner.where("above is null").select(*out).union(below.select(*out)).union(tops.select(*out))
    return every.withColumn("ends", F.coalesce("ends", F.lit(NONE))).withColumnRenamed("ends", "ends_sha256")


def op11(spark, sf_dir: str) -> DataFrame:
    """One row per node of the trie of the rebuilt conversations."""
    return trie(rebuilt(sequences(spark.read.parquet(f"{sf_dir}/conversations.parquet"))))


OP11_SQL = """
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (
  SELECT conv_id, (CAST(xor(list_reduce(
           list_concat([4294967295], flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: [ord(x), -1, -1, -1, -1, -1, -1, -1, -1]))),
           lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) ELSE xor(a >> 1, 3988292384 * (a & 1)) END), 4294967295) AS BIGINT)) % 6 AS h
  FROM (SELECT DISTINCT CAST(conv_id AS BIGINT) AS conv_id FROM t)),
r AS (
  SELECT c.conv_id, pos, role, text FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 100 AND pos <= h
  UNION ALL SELECT c.conv_id, pos, role, text FROM c JOIN t USING (conv_id) WHERE pos > h),
q AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY pos) AS depth, role, text FROM r),
p AS (
  SELECT conv_id, depth, length(text) AS len,
         md5(string_agg(md5(length(role) || ':' || role || text), '') OVER (PARTITION BY conv_id ORDER BY depth ROWS UNBOUNDED PRECEDING)) AS node FROM q
  UNION ALL SELECT conv_id, 0, 0, '' FROM c),
z AS (SELECT conv_id, max(depth) AS turns FROM p GROUP BY 1),
n AS (
  SELECT node, depth, any_value(len) AS len, min(conv_id) AS conv_id, count(*) AS n_convs,
         coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE depth = turns), '') AS ends
  FROM p JOIN z USING (conv_id) GROUP BY 1, 2),
e AS (SELECT DISTINCT a.node AS parent, b.node FROM p a JOIN p b ON a.conv_id = b.conv_id AND b.depth = a.depth + 1),
k AS (SELECT parent AS node, count(*) AS n_children FROM e GROUP BY 1),
s AS (SELECT DISTINCT a.node AS over, b.node FROM p a JOIN p b ON a.conv_id = b.conv_id AND b.depth >= a.depth),
u AS (
  SELECT over AS node, count(*) FILTER (WHERE n_children IS NULL) AS n_leaves, CAST(sum((n.n_convs - 1) * n.len) AS BIGINT) AS saved_tokens
  FROM s JOIN n USING (node) LEFT JOIN k USING (node) GROUP BY 1)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, o.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children, n_leaves, saved_tokens, sha256(n.ends) AS ends_sha256
FROM n JOIN u USING (node) LEFT JOIN k USING (node) LEFT JOIN e ON e.node = n.node LEFT JOIN n o ON o.node = e.parent
"""
