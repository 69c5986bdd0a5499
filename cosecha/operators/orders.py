"""Total orders and row numbers without a window over everything."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cosecha.sources import files

PARTS = 100_000  # partitions whose counts may be broadcast


def numbered(df: DataFrame, order: Sequence[Column], name: str = "numero", within: Sequence[str] = ()) -> DataFrame:
    """``df`` with the place of each row in ``order``, from 1; with ``within`` the place inside its group.

    Rows are dealt by ranges of the order and sorted in each; a row's number is its place there plus the rows of the
    ranges before, one count for each range.  Groups come first in the order, so a place inside one is the number less
    those before its first row.  The order should be total: of equals the place is any of theirs.
    """
    keys = [F.col(c).asc_nulls_first() for c in within]
    sorted_ = df.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order).withColumn("__place", F.monotonically_increasing_id())
    placed = files.saved(sorted_, "ordered").withColumn("__part", F.shiftright("__place", 33))
    counts = placed.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = files.small(files.saved(counts.select("__part", before.alias("__before")), "offsets"), PARTS)  # a row for each range
    out = placed.join(offsets, "__part").withColumn(name, F.col("__before") + F.col("__place").bitwiseAND(F.lit((1 << 33) - 1)) + 1)
    out = out.drop("__part", "__place", "__before")
    if within:
        first = out.groupBy(*[F.col(c).alias(f"__{c}") for c in within]).agg(F.min(name).alias("__first"))
        same = F.lit(True)
        for c in within:
            same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
        out = out.join(first, same).withColumn(name, F.col(name) - F.col("__first") + 1)
    return out.select(*df.columns, name)
