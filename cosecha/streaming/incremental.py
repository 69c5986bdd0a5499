"""Streams: calendar buckets with a watermark, and idempotent upserts of dated batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cosecha.functions import dates
from cosecha.operators import rows


def by_decena(events: DataFrame, late: str | None = "10 days") -> DataFrame:
    """Events (ts, event_type, value) summed up by kind and decena.

    A decena has no fixed length, so its last day is a key beside a one-day event-time window, which lets the watermark
    close state; decenas follow from the days.  For a batch ``late`` is None.
    """
    day = F.col("ts").cast("timestamp")
    own = events.withColumn("ts", day)
    if late is not None:
        own = own.withWatermark("ts", late)
    d = F.col("dia.start").cast("date")
    daily = own.groupBy(F.window("ts", "1 day").alias("dia"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("suma"), F.min("value").alias("minimo"), F.max("value").alias("maximo"))
    daily = daily.select("event_type", d.alias("fecha"), dates.decena_end(F.year(d), F.month(d), dates.decena_of(d)).alias("decena"), "n", "suma", "minimo", "maximo")
    if late is not None:
        return daily
    return decenas(daily)


def decenas(daily: DataFrame) -> DataFrame:
    return daily.groupBy("event_type", "decena").agg(F.sum("n").alias("n"), F.sum("suma").alias("suma"), F.min("minimo").alias("minimo"), F.max("maximo").alias("maximo"), F.count(F.lit(1)).alias("dias"))


def new_periods(incoming: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of periods that are not there yet."""
    return incoming.join(known.select(*keys).distinct(), list(keys), "left_anti")


def upsert_stream(stream: DataFrame, path: str, keys: Sequence[str], checkpoint: str, period: str, newest: str | None = None) -> StreamingQuery:
    """Keeps a Parquet table, partitioned by the key ``period``, up to date: a batch's rows replace those with their keys.

    Only the periods that a batch has are read and written anew.  A batch's new partitions are written beside the table
    first, so a batch that is repeated after a failure finds them, and writing them again gives the same table.
    Of a batch's rows with equal keys the one with the greatest ``newest`` stays, of equals the one with the greatest values.
    """
    spark: SparkSession = stream.sparkSession
    if period not in keys:
        raise ValueError("the period must be one of the keys")

    def merge(batch: DataFrame, number: int) -> None:
        own = [c for c in batch.columns if c not in keys]
        new = rows.best(batch, keys, [F.col(c).desc_nulls_last() for c in sorted(own, key=lambda c: c != newest)])
        touched = [r[0] for r in new.select(period).distinct().collect()]  # periods of one batch
        if not touched:
            return
        try:
            old = spark.read.schema(batch.schema).parquet(path)
            new = rows.upsert(old.where(F.col(period).isin([t for t in touched if t is not None]) | (F.col(period).isNull() & F.lit(None in touched))), new, keys)
        except AnalysisException as e:  # the first batch makes the table
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
        beside = f"{path}-batch"
        new.write.mode("overwrite").parquet(beside)
        spark.read.schema(new.schema).parquet(beside).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(period).parquet(path)

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
