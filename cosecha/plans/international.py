"""International price proxies: records matched to products, converted to pesos as of their day, and diagnosed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cosecha.functions import dates, numbers
from cosecha.operators import asof, panel
from cosecha.sources import files

METRICS = ("valor", "cambio_1", "cambio_3", "z")


def matched(records: DataFrame, config: DataFrame) -> DataFrame:
    """Records with the proxies that name their source and series; a series of usda_ams need only be part of the text."""
    return asof.contains_join(records, config, "fuente", "serie", "termino", F.lower(F.col("fuente")) != "usda_ams")


def in_pesos(prices: DataFrame, fx: DataFrame) -> DataFrame:
    """USD prices with the last exchange rate at or before their day; pesos stay as they are.  Prices go to a scratch table, as they are read twice."""
    out = asof.asof_series(files.saved(prices, "proxy-prices"), fx.withColumnRenamed("fecha", "fecha_fx"), ("fecha", "fecha_fx"))
    return out.withColumn("valor", F.when(F.upper("moneda") == "MXN", F.col("precio")).otherwise(F.col("precio") * F.col("tasa")))


def diagnosed(values: DataFrame, keys: Sequence[str] = ("producto", "proxy")) -> DataFrame:
    """Change on one and three periods, and z-score against the twelve before, of which four must be known."""
    w = panel.order(keys, "fecha")
    out = values.withColumns({f"cambio_{k}": numbers.change(F.col("valor"), F.lag("valor", k).over(w)) for k in (1, 3)})
    mean, std = panel.trailing(F.avg, "valor", w, 12, 4), panel.trailing(F.stddev_samp, "valor", w, 12, 4)
    return out.withColumn("z", F.try_divide(F.col("valor") - mean, F.nullif(std, F.lit(0.0))))


def available(values: DataFrame, frequency: str = "frecuencia") -> DataFrame:
    return values.withColumn("disponible", dates.available_on(F.col("fecha"), F.col(frequency)))


def eligible(values: DataFrame) -> DataFrame:
    return values.where(F.lower("uso") == "feature")


def pivoted(values: DataFrame, proxies: Sequence[str]) -> DataFrame:
    """Per (product, day of availability) one column for each proxy and metric: the last known of that day."""
    last = [F.max_by(m, F.when(F.col(m).isNotNull(), F.col("fecha"))).alias(m) for m in METRICS]
    return values.groupBy("producto", "disponible").pivot("proxy", list(proxies)).agg(*last)


def on_prices(price: DataFrame, wide: DataFrame) -> DataFrame:
    """Prices with the last proxies that were available, by product; prices go to a scratch table, as they are read twice."""
    return asof.asof_join(files.saved(price, "prices"), wide.withColumnRenamed("producto", "cultivo"), ("fecha", "disponible"), ["cultivo"])


def coverage(days: DataFrame, values: DataFrame) -> DataFrame:
    """Per product and day how many proxies are available, and the last date that one became so."""
    return asof.known_by(days, values, "producto", "fecha", "disponible", "proxy")


def proxy_map(values: DataFrame) -> DataFrame:
    """The distinct proxies of each product with their use and frequency."""
    return values.select("producto", "proxy", "uso", "frecuencia").distinct()
