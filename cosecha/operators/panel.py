"""Panels: dense calendars, bounded fills, lags and trailing statistics, all over one partition and order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec


def densify(df: DataFrame, keys: Sequence[str], date: str) -> DataFrame:
    """A row for every day from a key's first to its last; values of new days are null."""
    span = df.groupBy(*keys).agg(F.min(date).alias("__lo"), F.max(date).alias("__hi"))
    days = span.select(*keys, F.explode(F.sequence("__lo", "__hi")).alias(date))
    return days.join(df, [*keys, date], "left")


def order(keys: Sequence[str], *by: str) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(*by)


def filled(c: str, w: WindowSpec, limit: int) -> Column:
    """The last known value, at most ``limit`` rows old."""
    return F.last(c, ignorenulls=True).over(w.rowsBetween(-limit, 0))


def trailing(f, c: str, w: WindowSpec, rows: int, at_least: int) -> Column:
    """``f`` over the ``rows`` before the current one, null below ``at_least`` known values."""
    frame = w.rowsBetween(-rows, -1)
    return F.when(F.count(c).over(frame) >= at_least, f(c).over(frame))


def lags(df: DataFrame, c: str, w: WindowSpec, steps: Sequence[int], name: str) -> DataFrame:
    return df.withColumns({f"{name}_{k}": F.lag(c, k).over(w) for k in steps})


def leads(df: DataFrame, c: str, w: WindowSpec, steps: Sequence[int], name: str) -> DataFrame:
    return df.withColumns({f"{name}{k}": F.lead(c, k).over(w) for k in steps})


def robust_z(df: DataFrame, keys: Sequence[str], c: str) -> DataFrame:
    """0.6745 (x - median) / scale by key: the scale is the median absolute deviation, or the deviation if that is 0.

    Medians are aggregates over the different values of a key with their counts, joined back; a null key is no group.
    ``df`` is read twice, so it should be a table.
    """
    counts = df.groupBy(*keys, F.col(c).alias("__x")).agg(F.count(F.lit(1)).alias("__n"))
    std = F.stddev_samp(c).alias("__std")
    middle = counts.groupBy(*keys).agg(F.percentile("__x", F.lit(0.5), F.col("__n")).alias("__median"))
    distance = counts.join(middle, list(keys)).select(*keys, F.abs(F.col("__x") - F.col("__median")).alias("__d"), "__n", "__median")
    spread = distance.groupBy(*keys).agg(F.percentile("__d", F.lit(0.5), F.col("__n")).alias("__mad"), F.first("__median").alias("__median"))
    near = df.join(df.groupBy(*keys).agg(std).join(spread, list(keys)), list(keys))
    scale = F.when(F.col("__mad") > 0, F.col("__mad")).otherwise(F.nullif("__std", F.lit(0.0)))
    return near.withColumn("robust_z", F.try_divide(0.6745 * (F.col(c) - F.col("__median")), scale)).drop("__median", "__std", "__mad")


def trim_trailing_zeros(months: Sequence[str]) -> list[Column]:
    """Columns of a year without the zeros after the last positive month; rows without a positive month stay."""
    last = F.array_max(F.array(*[F.when(F.col(m) > 0, F.lit(i)) for i, m in enumerate(months)]))
    return [F.when(F.col(m).isNotNull() & ~((F.lit(i) > last) & (F.col(m) == 0)) | last.isNull(), F.col(m)).alias(m) for i, m in enumerate(months)]
