"""What the operators share: tables written to the cluster's shared folder, size checks, sorted runs, components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_fallback: list[str] = []


def folder(spark: SparkSession, name: str) -> str:
    """A new folder under ``spark.checkpoint.dir``; where that is unset, under a temporary folder, but only in local mode."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        if not _fallback:
            _fallback.append(f"file://{tempfile.mkdtemp(prefix='cosecha-')}")
        base = _fallback[0]
    return f"{base.rstrip('/')}/cosecha/{name}-{uuid.uuid4().hex}"


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names like ``names`` that no column of ``df`` has, in whatever case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def saved(df: DataFrame, name: str) -> DataFrame:
    """Writes a table to the shared folder and reads it: the lineage ends there, and a lost executor loses nothing."""
    path = folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, most: int) -> DataFrame:
    """``df``, marked for broadcast only if it is counted to have at most ``most`` rows; else Spark shuffles."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def sorted_runs(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Of batches sorted by integer keys: tables of whole runs of equal keys, with the offsets of their runs."""
    rest: pa.Table | None = None
    for batch in batches:
        if not len(batch):
            continue
        table = pa.Table.from_batches([batch])
        if rest is not None:
            table = pa.concat_tables([rest, table]).combine_chunks()
        new = np.zeros(len(table), bool)
        new[0] = True
        for key in keys:
            values = table.column(key).to_numpy()
            new[1:] |= values[1:] != values[:-1]
        starts = np.flatnonzero(new)
        rest = table.slice(starts[-1])
        if len(starts) > 1:
            yield table.slice(0, starts[-1]), starts
    if rest is not None:
        yield rest, np.array([0, len(rest)])


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) of the undirected edges (a, b): the smallest node that is reachable; isolated nodes are absent.

    Alternates large-star and small-star steps.  A hub's rows meet only in joins, which Spark can split, and in
    minima, which it takes before the shuffle.  Each round's edges go to the shared folder.
    """
    e = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    e = saved(e, name)
    def least(pairs: DataFrame) -> DataFrame:
        """The least v of each u; grouped by ~u, as only a join of two fresh exchanges lets Spark split a hub's rows."""
        return pairs.groupBy(F.bitwise_not("u").alias("k")).agg(F.min("v").alias("m")).select(F.bitwise_not("k").alias("u"), "m")

    seen = None
    while True:
        now = e.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if seen == now or now.n == 0:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(e.select("v", "v").distinct())
        seen = now
        both = e.union(e.select("v", "u"))
        low = least(both).select("u", F.least("m", "u").alias("m"))
        star = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = least(star)
        e = saved(star.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low).distinct(), name)
