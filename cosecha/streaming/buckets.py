"""Calendar buckets of varying length in a stream: a decena or a week comes out once, when the watermark has passed its end."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from cosecha.functions import dates

#: The last day of a bucket, by kind.
ENDS = {
    "decena": lambda d: dates.decena_end(F.year(d), F.month(d), dates.decena_of(d)),
    "semana": lambda d: F.date_add(dates.week_start(d), 6),
}
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
SUMS = "event_type string, fin date, n long, suma double, minimo double, maximo double"


def bucketed(events: DataFrame, kind: str) -> DataFrame:
    """The buckets of a batch of events (ts, event_type, value): what the stream gives once all of them are closed."""
    d = F.col("ts").cast("date")
    return events.where("ts is not null").groupBy("event_type", ENDS[kind](d).alias("fin")).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("suma"), F.min("value").alias("minimo"), F.max("value").alias("maximo"))


class _Sums(StatefulProcessor):
    """Sums of one kind of event and bucket, which go when its timer fires."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.sums = handle.getValueState("sums", "n long, suma double, minimo double, maximo double")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = not self.sums.exists()
        n, total, low, high = (0, None, None, None) if new else self.sums.get()
        for part in rows:
            n += len(part)
            values = part["value"].dropna()
            if len(values):
                total = (total or 0.0) + float(values.sum())
                low = min(x for x in (low, float(values.min())) if x is not None)
                high = max(x for x in (high, float(values.max())) if x is not None)
        self.sums.update((n, total, low, high))
        if new:
            after = dt.datetime.combine(key[1], dt.time(), dt.UTC) + dt.timedelta(days=1)
            self.handle.registerTimer(int(after.timestamp() * 1000))
        yield pd.DataFrame()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        row = self.sums.get()
        self.sums.clear()
        yield pd.DataFrame([(*key, *row)], columns=["event_type", "fin", "n", "suma", "minimo", "maximo"])

    def close(self) -> None:
        pass


def streamed(events: DataFrame, kind: str, late: str = "10 days") -> DataFrame:
    """A stream of closed buckets of a stream of events (ts, event_type, value), each once.

    Rows later than ``late`` are dropped, as Spark drops them; a bucket's state is gone when it has come out.  Buckets are
    those of UTC days, so the session's time zone must be UTC.  The session needs the state store ``STORE``.
    """
    own = events.select(F.col("ts").cast("timestamp").alias("ts"), "event_type", F.col("value").cast("double").alias("value")).where("ts is not null")
    own = own.withWatermark("ts", late).withColumn("fin", ENDS[kind](F.col("ts").cast("date")))
    return own.groupBy("event_type", "fin").transformWithStateInPandas(_Sums(), StructType.fromDDL(SUMS), "append", "EventTime")


def run_to(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Runs a stream over all that has arrived, and appends what comes out to a Parquet table."""
    conf, key = stream.sparkSession.conf, "spark.sql.streaming.stateStore.providerClass"
    before = conf.get(key, None)
    conf.set(key, STORE)
    try:
        query = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    finally:
        conf.unset(key) if before is None else conf.set(key, before)
    query.awaitTermination()
