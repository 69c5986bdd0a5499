"""Reservoir catalogue and calendar of decenas: what was seen when, which periods are missing, run summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cosecha.functions import dates


def catalogue(dams: DataFrame) -> DataFrame:
    """Per reservoir: periods seen, the first and the last, and the latest name of its state."""
    ordinal = F.col("anio") * 1000 + F.col("mes") * 10 + F.col("decena")
    return dams.groupBy("presa").agg(F.count_distinct(ordinal).alias("periodos"), F.min(ordinal).alias("primero"), F.max(ordinal).alias("ultimo"), F.max_by("estado", ordinal).alias("estado"))


def snapshot(dams: DataFrame) -> DataFrame:
    """What a snapshot adds to a catalogue: per reservoir and stretch of decenas a bitmap of those seen, and the latest
    state's name (ultimo, estado).  Repeats set the same bit."""
    i = dates.decena_index(F.col("anio"), F.col("mes"), F.col("decena")).cast("bigint")
    own = dams.select("presa", "estado", i.alias("i")).where("i is not null")
    return own.groupBy("presa", F.bitmap_bucket_number("i").alias("tramo")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("i")).alias("vistas"), F.min("i").alias("primero"), F.max("i").alias("ultimo"), F.max_by("estado", F.struct("i", "estado")).alias("estado"))


def merged(snapshots: DataFrame) -> DataFrame:
    """One table of snapshots from several: bitmaps are joined by OR, so old snapshots need not be read again."""
    return snapshots.groupBy("presa", "tramo").agg(F.bitmap_or_agg("vistas").alias("vistas"), F.min("primero").alias("primero"), F.max("ultimo").alias("ultimo"), F.max_by("estado", F.struct("ultimo", "estado")).alias("estado"))


def of_snapshots(snapshots: DataFrame) -> DataFrame:
    """The catalogue of merged snapshots, as ``catalogue`` makes it of all their rows."""
    year, month, decena = dates.of_decena_index(F.col("i"))
    ordinal = (year * 1000 + month * 10 + decena).cast("int")
    out = snapshots.groupBy("presa").agg(F.sum(F.bitmap_count("vistas")).alias("periodos"), F.min("primero").alias("p"), F.max("ultimo").alias("u"), F.max_by("estado", F.struct("ultimo", "estado")).alias("estado"))
    for c, name in (("p", "primero"), ("u", "ultimo")):
        out = out.withColumn("i", F.col(c)).withColumn(name, ordinal)
    return out.select("presa", "periodos", "primero", "ultimo", "estado")


def periods(spark: SparkSession, first: tuple[int, int, int], last: tuple[int, int, int]) -> DataFrame:
    """(anio, mes, decena, fecha) of every decena from ``first`` to ``last``."""
    index = lambda p: (p[0] * 12 + p[1] - 1) * 3 + p[2] - 1
    out = spark.range(index(first), index(last) + 1).select(F.col("id").cast("int").alias("i"))
    year, month, decena = dates.of_decena_index(F.col("i"))
    return out.select(year.alias("anio"), month.alias("mes"), decena.alias("decena")).withColumn("fecha", dates.decena_end(F.col("anio"), F.col("mes"), F.col("decena")))


def missing(dams: DataFrame) -> DataFrame:
    """Per reservoir the decenas between its first and last that have no row."""
    i = dates.decena_index(F.col("anio"), F.col("mes"), F.col("decena"))
    span = dams.groupBy("presa").agg(F.min(i).alias("lo"), F.max(i).alias("hi"))
    all_ = span.select("presa", F.explode(F.sequence("lo", "hi")).alias("i"))
    left = all_.join(dams.select("presa", i.alias("i")), ["presa", "i"], "left_anti")
    year, month, decena = dates.of_decena_index(F.col("i"))
    return left.select("presa", year.alias("anio"), month.alias("mes"), decena.alias("decena"))


def run_summary(runs: DataFrame) -> DataFrame:
    """Per group: attempts, successes, failures and a status."""
    out = runs.groupBy("grupo").agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("estado") == "ok").alias("bien"), F.count_if(F.col("estado") == "error").alias("mal"))
    status = F.when((F.col("bien") == 0) & (F.col("mal") == 0), "skipped").when(F.col("mal") == 0, "success").when(F.col("bien") == 0, "failed").otherwise("partial")
    return out.withColumn("resultado", status)
