"""Runs in stages with published versions to fall back on, and backfills that skip the years that are there."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cosecha.sources import files

STATUS = "orden int, etapa string, estado string, detalle string"


@dataclass(frozen=True)
class Stage:
    """``run`` makes the stage's table of the tables before it, or None if there is nothing new.

    ``stale``: if it fails, the last published version stands in.
    """

    name: str
    run: Callable[[Mapping[str, DataFrame]], DataFrame | None]
    stale: bool = False


def refresh(spark: SparkSession, root: str, stages: Sequence[Stage], version: str) -> DataFrame:
    """Runs the stages in order and publishes each table as ``version``; returns their status (orden, etapa, estado, detalle).

    A stage is ``updated``, ``skipped_existing`` (nothing new; the rest does not run), ``stale_fallback`` (failed, with
    the last version in its place), ``error`` (the rest does not run) or ``not_run``.  Whatever a stage raises is its
    status, so the caller learns of it here.
    """
    done: dict[str, DataFrame] = {}
    told: list[tuple[int, str, str, str | None]] = []
    open_ = True
    for i, stage in enumerate(stages):
        if not open_:
            told.append((i, stage.name, "not_run", None))
            continue
        path = f"{root}/{stage.name}"
        try:
            table = stage.run(done)
            if table is not None:
                files.publish(table, path, version)
        except Exception as e:  # noqa: BLE001  any failure of a stage is a status
            try:
                if not stage.stale:
                    raise e
                done[stage.name] = files.published(spark, path)
                told.append((i, stage.name, "stale_fallback", str(e)[:500]))
            except Exception:  # noqa: BLE001  no version to fall back on
                open_ = False
                told.append((i, stage.name, "error", str(e)[:500]))
            continue
        if table is None:
            open_ = False
            told.append((i, stage.name, "skipped_existing", None))
        else:
            done[stage.name] = files.published(spark, path)
            told.append((i, stage.name, "updated", None))
    return spark.createDataFrame(told, STATUS)


def backfill(source: DataFrame, path: str, years: Sequence[int], year: str = "anio", bad: str = "false", force: bool = False) -> DataFrame:
    """Adds the asked years of ``source`` to a table partitioned by year, but for those it has, unless ``force``.

    Returns (anio, estado, filas, errores) for each year asked: ``skipped_existing``, ``success``, or
    ``partial_with_errors`` where rows satisfy ``bad``; a year without rows is ``no_rows``.  A repeated run after a
    failure replaces the partitions of its years.
    """
    spark = source.sparkSession
    try:
        there = {r[0] for r in spark.read.parquet(path).select(year).distinct().collect()}  # years
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        there = set()
    wanted = [y for y in years if force or y not in there]
    if wanted:
        own = source.where(F.col(year).isin(*wanted))
        own.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(year).parquet(path)
    asked = F.broadcast(spark.createDataFrame([(int(y), y in there and not force) for y in years], f"{year} int, __there boolean"))
    table = spark.read.schema(source.schema).parquet(path)
    counts = table.where(F.col(year).isin(*years)).groupBy(year).agg(F.count(F.lit(1)).alias("filas"), F.count_if(F.expr(bad)).alias("errores"))
    status = F.when(F.col("__there"), "skipped_existing").when(F.coalesce("filas", F.lit(0)) == 0, "no_rows").when(F.col("errores") > 0, "partial_with_errors").otherwise("success")
    return counts.join(asked, year, "right").select(year, status.alias("estado"), F.coalesce("filas", F.lit(0)).alias("filas"), F.coalesce("errores", F.lit(0)).alias("errores"))
