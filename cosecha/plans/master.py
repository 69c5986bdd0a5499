"""Linked comparison tables: daily wholesale and retail, monthly progress, annual close, long and wide, coverage."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cosecha.functions import numbers
from cosecha.operators import rows

KEYS = ["fecha", "cultivo"]


def wholesale_daily(wholesale: DataFrame) -> DataFrame:
    """Statistics by day and product; a null product is a group."""
    return wholesale.groupBy(*KEYS).agg(F.avg("precio").alias("media"), F.median("precio").alias("mediana"), F.min("precio").alias("minimo"), F.max("precio").alias("maximo"), F.count("precio").alias("n"), F.min("origen").alias("origen"))


# What sources may tell beside their numbers, and what the panel calls it
RETAIL_MORE = {"pagina": "source_page", "producto_crudo": "product_raw", "inferido": "product_inferred", "unidad": "unit_label"}
PROGRESS_MORE = {"nombre_cultivo": "avance_crop_name", "etiqueta_cultivo": "avance_crop_label_raw", "etiqueta_corte": "avance_report_cutoff_label", "unidad": "unit_label"}
ANNUAL_MORE = {"nombre_cultivo": "cierre_crop_name", "etiqueta_cultivo": "cierre_crop_label_raw"}


def _more(df: DataFrame, names: Mapping[str, str]) -> list[str]:
    return [c for c in names if c in df.columns]


def retail_daily(retail: DataFrame) -> DataFrame:
    """The cheapest record of each (day, product, source), with what its price is per.

    Where records tell their page, raw and inferred product or unit, the cheapest one's stay; their queries are joined.
    """
    own = retail.withColumns({"comparable": F.coalesce("precio_kg", "precio_unidad"), "base": F.when(F.col("precio_kg").isNotNull(), "por_kg").otherwise("por_unidad")}).where("comparable is not null")
    more = _more(retail, RETAIL_MORE)
    asked = [F.array_join(F.array_sort(F.collect_set("consulta")), " | ").alias("consultas")] if "consulta" in retail.columns else []
    out = own.groupBy(*KEYS, "fuente").agg(F.min(F.struct("comparable", "base", *more)).alias("m"), F.count(F.lit(1)).alias("registros"), *asked)
    return out.select(*KEYS, "fuente", *[F.col(f"m.{c}").alias(c) for c in ("comparable", "base", *more)], "registros", *(["consultas"] if asked else []))


def annual_prices(records: DataFrame) -> DataFrame:
    """Production-weighted price by (year, product, unit) of rows with a positive production."""
    good = records.where("anio is not null and cultivo is not null and precio is not null and produccion > 0")
    return good.groupBy("anio", "cultivo", "unidad").agg(F.try_divide(F.sum(F.col("precio") * F.col("produccion")), F.sum("produccion")).alias("precio"), F.count(F.lit(1)).alias("filas"), F.sum("produccion").alias("produccion"), *[F.min(c).alias(c) for c in _more(records, ANNUAL_MORE)])


def main_unit(annual: DataFrame) -> DataFrame:
    """For each (year, product) the unit with the most production, then rows, then the first by name."""
    return rows.best(annual, ["anio", "cultivo"], [F.col("produccion").desc(), F.col("filas").desc(), F.col("unidad")])


def monthly(progress: DataFrame) -> DataFrame:
    """National totals by (product, year, month), yield by harvested area and shares of the sown."""
    own = progress.where("cultivo is not null and anio is not null and mes is not null")
    out = own.groupBy("cultivo", "anio", "mes").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("sembrada", "cosechada", "siniestrada")], F.coalesce(F.sum("acumulada"), F.lit(0.0)).alias("produccion"), F.count("estado").alias("filas"), F.max("corte").alias("corte"), *[F.min(c).alias(c) for c in _more(progress, PROGRESS_MORE)])
    harvested, sown = (F.when(F.col(c) > 0, F.col(c)) for c in ("cosechada", "sembrada"))
    return out.withColumns({"rendimiento": F.try_divide("produccion", harvested), "cosecha_siembra": F.try_divide("cosechada", sown), "siniestro": F.try_divide("siniestrada", sown), "clave": F.format_string("%04d-%02d", "anio", "mes")})


def keys(frames: Sequence[DataFrame]) -> DataFrame:
    """All (day, product) of the frames, with year and month."""
    out = frames[0].select(*KEYS)
    for f in frames[1:]:
        out = out.union(f.select(*KEYS))
    return out.distinct().withColumns({"anio": F.year("fecha"), "mes": F.month("fecha")})


def wide(whole: DataFrame, retail: DataFrame, month: DataFrame, annual: DataFrame, sources: Sequence[str] = ("uno", "dos")) -> DataFrame:
    """Every (day, product) with what each source says of it; null products match null products."""
    out = keys([whole, retail])
    shops = retail.groupBy(*KEYS).agg(*[F.max(F.when(F.col("fuente") == s, F.col("comparable"))).alias(f"precio_{s}") for s in sources])

    def add(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
        r = right.withColumnsRenamed({k: f"__{k}" for k in on})
        same = F.lit(True)
        for k in on:
            same = same & F.col(k).eqNullSafe(F.col(f"__{k}"))
        return left.join(r, same, "left").drop(*[f"__{k}" for k in on])

    out = add(out, whole.select(*KEYS, F.col("mediana").alias("mayoreo")), KEYS)
    out = add(out, shops, KEYS)
    out = add(out, month.select("cultivo", "anio", "mes", F.col("produccion").alias("produccion_mes"), "rendimiento"), ["cultivo", "anio", "mes"])
    return add(out, main_unit(annual).select("cultivo", "anio", F.col("precio").alias("precio_anual")), ["cultivo", "anio"])


def long(whole: DataFrame, retail: DataFrame, month: DataFrame, annual: DataFrame) -> DataFrame:
    """The sources below each other in common columns."""
    none = lambda kind: F.lit(None).cast(kind)
    a = whole.select("fecha", "cultivo", F.lit("mayoreo").alias("tabla"), F.lit("mediana").alias("medida"), F.col("mediana").alias("valor"), F.col("n").alias("filas"))
    b = retail.select("fecha", "cultivo", F.lit("menudeo").alias("tabla"), F.concat(F.col("fuente"), F.lit("_"), F.col("base")).alias("medida"), F.col("comparable").alias("valor"), F.col("registros").alias("filas"))
    c = month.select(F.col("corte").alias("fecha"), "cultivo", F.lit("avance").alias("tabla"), F.lit("produccion").alias("medida"), F.col("produccion").cast("double").alias("valor"), "filas")
    d = annual.select(none("date").alias("fecha"), "cultivo", F.lit("cierre").alias("tabla"), F.col("unidad").alias("medida"), F.col("precio").alias("valor"), "filas")
    return a.unionByName(b).unionByName(c).unionByName(d)


# The columns of the long panel, and the names of its sources and of what their prices are
PANEL = {
    "run_date": "date", "canonical_product": "string", "source": "string", "comparison_price_mxn": "double", "price_basis": "string", "raw_price_mxn": "double", "unit_label": "string",
    "source_page": "string", "product_raw": "string", "product_inferred": "string", "search_terms_used": "string", "source_record_count": "long",
    "sniim_daily_mean_mxn": "double", "sniim_daily_median_mxn": "double", "sniim_daily_min_mxn": "double", "sniim_daily_max_mxn": "double",
    "avance_total_superficie_sembrada_ha": "double", "avance_total_superficie_cosechada_ha": "double", "avance_total_superficie_siniestrada_ha": "double", "avance_total_produccion": "double",
    "avance_yield_weighted_udm_ha": "double", "avance_rows_used": "long", "avance_crop_name": "string", "avance_crop_label_raw": "string", "avance_report_cutoff_label": "string", "avance_cutoff_date": "date",
    "cierre_annual_weighted_pmr_mxn_udm": "double", "cierre_rows_used": "long", "cierre_total_produccion": "double", "cierre_crop_name": "string", "cierre_crop_label_raw": "string",
}
WHOLESALE_BASIS, PROGRESS_BASIS, ANNUAL_BASIS = "precio_frecuente_mean", "contexto_mensual_avance_agricola", "pmr_mxn_udm_weighted_by_produccion"


def _padded(df: DataFrame, values: Mapping[str, Column | str]) -> DataFrame:
    """The panel's columns: those given, the others null."""
    own = {k: F.col(v) if isinstance(v, str) else v for k, v in values.items()}
    return df.select(*[own.get(c, F.lit(None)).cast(kind).alias(c) for c, kind in PANEL.items()])


def panel(whole: DataFrame, retail: DataFrame, month: DataFrame, annual: DataFrame) -> DataFrame:
    """Wholesale, retailers, progress and annual close below each other in the panel's 31 columns.

    A month stands on its report's day, else on its first; a year's price on each day that wholesale or a retailer has.
    """
    own = {"run_date": "fecha", "canonical_product": "cultivo"}
    a = _padded(whole, own | {
        "source": F.lit("sniim"), "comparison_price_mxn": "media", "price_basis": F.lit(WHOLESALE_BASIS), "raw_price_mxn": "media", "unit_label": F.lit("kg_calculado"), "source_record_count": "n",
        "sniim_daily_mean_mxn": "media", "sniim_daily_median_mxn": "mediana", "sniim_daily_min_mxn": "minimo", "sniim_daily_max_mxn": "maximo",
    })
    more = lambda df, names: {names[c]: c for c in _more(df, names)}
    b = _padded(retail, own | more(retail, RETAIL_MORE) | ({"search_terms_used": "consultas"} if "consultas" in retail.columns else {}) | {"source": "fuente", "comparison_price_mxn": "comparable", "price_basis": "base", "raw_price_mxn": "comparable", "source_record_count": "registros"})
    first = F.try_to_date(F.format_string("%04d-%02d-01", "anio", "mes"))
    c = _padded(month, own | more(month, PROGRESS_MORE) | {
        "run_date": F.coalesce("corte", first), "source": F.lit("avance_agricola"), "price_basis": F.lit(PROGRESS_BASIS), "source_record_count": "filas",
        "avance_total_superficie_sembrada_ha": "sembrada", "avance_total_superficie_cosechada_ha": "cosechada", "avance_total_superficie_siniestrada_ha": "siniestrada",
        "avance_total_produccion": "produccion", "avance_yield_weighted_udm_ha": "rendimiento", "avance_rows_used": "filas", "avance_cutoff_date": "corte",
    })
    year = main_unit(annual).where("precio is not null").select("anio", "cultivo", "unidad", "precio", "filas", "produccion", *_more(annual, ANNUAL_MORE))
    d = _padded(keys([whole, retail]).join(year, ["anio", "cultivo"]), own | more(year, ANNUAL_MORE) | {
        "source": F.lit("cierre_agricola"), "comparison_price_mxn": "precio", "price_basis": F.lit(ANNUAL_BASIS), "raw_price_mxn": "precio", "unit_label": "unidad", "source_record_count": "filas",
        "cierre_annual_weighted_pmr_mxn_udm": "precio", "cierre_rows_used": "filas", "cierre_total_produccion": "produccion",
    })
    return a.unionByName(b).unionByName(c).unionByName(d)


def coverage(wide_: DataFrame, sources: Sequence[str], optional: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Which sources each row has, how many, how many are missing, and their share.

    An ``optional`` source, given with its table, counts only if the table has rows.
    """
    optional = optional or {}
    out = wide_.withColumns({f"hay_{s}": F.col(s).isNotNull() for s in sources})
    total = F.lit(len(sources) - len(optional))
    for s, table in optional.items():
        out = out.crossJoin(F.broadcast(table.agg((F.count(F.lit(1)) > 0).alias(f"__{s}"))))  # one row
        total = total + F.col(f"__{s}").cast("int")
    counted = [F.col(f"hay_{s}") & F.col(f"__{s}") if s in optional else F.col(f"hay_{s}") for s in sources]
    n = sum((c.cast("int") for c in counted), F.lit(0))
    return out.withColumn("fuentes", n).withColumns({"faltan": total - n, "cobertura": n / total}).drop(*[f"__{s}" for s in optional])


def coverage_by_month(covered: DataFrame, sources: Sequence[str]) -> DataFrame:
    """Per product and month: days, and the share of them that each source has."""
    return covered.groupBy("cultivo", F.trunc("fecha", "month").alias("mes")).agg(F.count_distinct("fecha").alias("dias"), *[F.avg(F.col(f"hay_{s}").cast("int")).alias(f"parte_{s}") for s in sources])


def months_without(priced: DataFrame, context: DataFrame, date: str) -> DataFrame:
    """(cultivo, mes) with prices, but without a row of the context in that month."""
    month = lambda c: F.trunc(c, "month").alias("mes")
    return priced.select("cultivo", month("fecha")).distinct().join(context.select("cultivo", month(date)).distinct(), ["cultivo", "mes"], "left_anti")


def gaps(wide_: DataFrame, source: str) -> DataFrame:
    """Per product and month the mean of retail less wholesale, its days, and the step to the month before."""
    from pyspark.sql.window import Window

    both = wide_.where(F.col(source).isNotNull() & F.col("mayoreo").isNotNull())
    out = both.groupBy("cultivo", F.trunc("fecha", "month").alias("mes")).agg(F.avg(F.col(source) - F.col("mayoreo")).alias("brecha"), F.count(F.lit(1)).alias("dias"), F.avg(numbers.ratio(F.col(source), F.col("mayoreo")) * 100 - 100).alias("brecha_pct"))
    return out.withColumn("paso", F.col("brecha") - F.lag("brecha").over(Window.partitionBy("cultivo").orderBy("mes")))


def tables(wholesale: DataFrame, retail: DataFrame, progress: DataFrame, annual_records: DataFrame) -> Mapping[str, DataFrame]:
    """The linked tables by name."""
    whole, shops, month, annual = wholesale_daily(wholesale), retail_daily(retail), monthly(progress), annual_prices(annual_records)
    w = wide(whole, shops, month, annual)
    sources = ["mayoreo", "precio_uno", "precio_dos", "produccion_mes", "precio_anual"]
    covered = coverage(w, sources, {"precio_anual": annual})
    return {
        "wholesale_daily": whole, "retail_daily": shops, "progress_monthly": month, "annual_prices": annual, "annual_main_unit": main_unit(annual),
        "keys": keys([whole, shops]), "wide": w, "long": long(whole, shops, month, annual), "panel": panel(whole, shops, month, annual), "coverage": covered, "coverage_monthly": coverage_by_month(covered, sources),
    }
