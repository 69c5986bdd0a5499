"""Sowing and harvest history: months from wide to long, one value per month, both kinds side by side."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cosecha.operators import panel, rows

MONTHS = tuple(f"m{i:02d}" for i in range(1, 13))
KINDS = ("SIEMBRA", "COSECHA")


def months_long(wide: DataFrame) -> DataFrame:
    """(tipo, cultivo, estado, anio, prioridad, mes, valor), zeros after a row's last positive month left out."""
    keys = ["tipo", "cultivo", "estado", "anio", "prioridad"]
    trimmed = wide.select(*keys, *panel.trim_trailing_zeros(MONTHS))
    return trimmed.unpivot(keys, list(MONTHS), "mes", "valor").withColumn("mes", F.substring("mes", 2, 2).cast("int")).dropna(subset=["valor"])


def side_by_side(long: DataFrame) -> DataFrame:
    """Per (crop, state, year, month) sown and harvested area: of several rows that of the least priority number."""
    one = rows.best(long, ["tipo", "cultivo", "estado", "anio", "mes"], [F.col("prioridad"), F.col("valor").desc()])
    return one.groupBy("cultivo", "estado", "anio", "mes").pivot("tipo", list(KINDS)).agg(F.first("valor"))


def numbered(df: DataFrame) -> DataFrame:
    """With row numbers from 1 in each (crop, year)."""
    return df.withColumn("renglon", F.row_number().over(Window.partitionBy("cultivo", "anio").orderBy("estado", "mes")))
