"""Crop production: references of former years, progress features, baseline forecasts, scenarios, summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cosecha.functions import numbers
from cosecha.operators import rows
from cosecha.plans import models
from cosecha.sources import files

KEYS = ["cultivo", "estado"]


def calendar_references(annual: DataFrame) -> DataFrame:
    """For each closed year: the year before, and mean and deviation of the five calendar years before."""
    w = Window.partitionBy(*KEYS).orderBy("anio")
    one, five = w.rangeBetween(-1, -1), w.rangeBetween(-5, -1)
    return annual.select(*KEYS, "anio", F.max("produccion").over(one).alias("anterior"), F.max("rendimiento").over(one).alias("rend_anterior"), F.avg("produccion").over(five).alias("media_5"), F.stddev_samp("produccion").over(five).alias("desv_5"))


def available_references(progress: DataFrame, annual: DataFrame) -> DataFrame:
    """For each year under way: the year before, and mean and deviation of the last five closed years before it."""
    asked = progress.dropna(subset=[*KEYS, "anio"]).select(*KEYS, "anio").distinct()
    past = annual.select(*KEYS, F.col("anio").alias("pasado"), "produccion", "rendimiento")
    both = asked.join(past, KEYS, "left").where("pasado is null or pasado < anio")
    rank = F.row_number().over(Window.partitionBy(*KEYS, "anio").orderBy(F.col("pasado").desc()))
    both = both.withColumn("rank", rank).where("rank <= 5")
    before = F.col("pasado") == F.col("anio") - 1
    found = both.groupBy(*KEYS, "anio").agg(F.max(F.when(before, F.col("produccion"))).alias("anterior"), F.max(F.when(before, F.col("rendimiento"))).alias("rend_anterior"), F.avg("produccion").alias("media_5"), F.stddev_samp("produccion").alias("desv_5"))
    return asked.join(found, [*KEYS, "anio"], "left")


def features(progress: DataFrame, annual: DataFrame) -> DataFrame:
    """Progress with references, the year's close as target, and shares of the sown area."""
    sown = F.when(F.col("sembrada") > 0, F.col("sembrada"))
    out = progress.join(available_references(progress, annual), [*KEYS, "anio"], "left")
    out = out.join(annual.select(*KEYS, "anio", F.col("produccion").alias("final"), F.col("rendimiento").alias("rend_final")), [*KEYS, "anio"], "left")
    return out.withColumns({"avance": F.try_divide(F.col("cosechada"), sown), "siniestro": F.try_divide(F.col("siniestrada"), sown), "vs_anterior": numbers.ratio(F.col("acumulada"), F.col("anterior"))})


def baseline() -> Column:
    """The first known of the year before, the five-year mean and what is harvested, and never less than that."""
    return F.greatest(F.coalesce("anterior", "media_5", "acumulada"), "acumulada")


def forecast(feature: DataFrame, fallback_std: float | None = None) -> DataFrame:
    """The last cut of each year: baseline forecast with interval, chances of a shortfall, scenarios and level.

    Half the interval is 1.2816 deviations: of the five years, else ``fallback_std``, else 15 percent of the forecast.
    """
    out = rows.latest(feature, [*KEYS, "anio"], "corte").withColumn("pronostico", baseline())
    std = F.coalesce("desv_5", F.lit(fallback_std).cast("double"), F.abs("pronostico") * 0.15)
    return assessed(out.withColumns({"p10": F.col("pronostico") - 1.2816 * std, "p90": F.col("pronostico") + 1.2816 * std}))


def assessed(out: DataFrame) -> DataFrame:
    """Chances of a shortfall, scenarios, reference and level of rows with pronostico, p10 and p90."""
    out = out.withColumns({f"caida_{s}": numbers.shortfall(F.col("anterior"), s / 100, F.col("pronostico"), F.col("p10"), F.col("p90")) for s in (10, 15, 20)})
    reference = F.coalesce("anterior", "media_5")
    kind = F.when(F.col("anterior").isNotNull(), "anio_anterior").when(F.col("media_5").isNotNull(), "promedio_5_anios").otherwise("sin_referencia")
    out = out.withColumns({"seco": F.col("pronostico") * 0.92, "sequia": F.col("pronostico") * 0.85, "referencia": reference, "tipo_referencia": kind})
    return out.withColumns({"cambio_abs": F.col("pronostico") - F.col("referencia"), "cambio_pct": numbers.change(F.col("pronostico"), F.col("referencia")), "nivel": numbers.alert_level(F.coalesce("caida_10", F.lit(0.0)))})


#: What boosted trees learn the year's production from.
NUMERIC = ("sembrada", "cosechada", "siniestrada", "acumulada", "rendimiento", "avance", "siniestro", "mes", "anterior", "media_5", "rend_anterior", "agua", "promedio", "bajo_40")
TREES, BASE = models.Candidate("arboles"), "base_historica"
LEAST_ROWS, LEAST_YEARS = 100, 2


def labelled(feature: DataFrame) -> DataFrame:
    """Cuts whose year is closed, as the one horizon that there is, with objetivo and prueba."""
    own = feature.where("final is not null").withColumns({"horizonte": F.lit(0), "objetivo": F.col("final").cast("double"), BASE: baseline().cast("double")})
    return models.marked(own, "corte")


def residual_std(target: DataFrame) -> DataFrame:
    """One row (n, mae, desviacion): the baseline on the test part, and the deviation of its residuals."""
    miss = F.col("objetivo") - F.col(BASE)
    return target.where("prueba").agg(F.count(miss).alias("n"), F.avg(F.abs(miss)).alias("mae"), F.stddev_pop(miss).alias("desviacion"))


def nowcast(feature: DataFrame, forced: str | None = None, folder: str | None = None, **options) -> DataFrame:
    """Forecasts of the last cut of each year with ``metodo`` and ``motivo``.

    Trees are fitted if there are LEAST_ROWS labelled cuts of LEAST_YEARS years, and forecast if they beat the baseline
    on the test part, or are ``forced``; their interval is that of their residuals.  Else it is the baseline's.
    """
    if forced not in (None, BASE, TREES.name):
        raise ValueError(f"no such method: {forced}; there are {BASE}, {TREES.name}")
    facts = feature.where("final is not null").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("anio").alias("years")).first()
    if facts["n"] < LEAST_ROWS or facts["years"] < LEAST_YEARS:
        if forced == TREES.name:
            raise ValueError(f"trees need {LEAST_ROWS} labelled rows of {LEAST_YEARS} years")
        return forecast(feature).withColumns({"metodo": F.lit(BASE), "motivo": F.lit("forzado" if forced else "pocas_filas")})
    numeric = [c for c in NUMERIC if c in feature.columns]
    target = files.saved(labelled(feature), "labelled")
    newest = rows.latest(feature, [*KEYS, "anio"], "corte").withColumns({"horizonte": F.lit(0), BASE: baseline().cast("double")})
    result = models.trained(target, newest, {BASE: F.col(BASE)}, [TREES], numeric, KEYS, [*KEYS, "corte"], fallback=BASE, forced=forced, folder=folder, top=30, **options)
    chosen = result.choice.first()  # one row
    method, reason = (chosen["metodo"], chosen["motivo"]) if chosen else (BASE, "pocas_filas")
    if method == BASE:
        out = forecast(feature, residual_std(target).first()["desviacion"])
    else:
        out = result.newest.withColumn("pronostico", F.col(TREES.name)).crossJoin(F.broadcast(result.band.drop("horizonte")))  # one row
        out = assessed(out.withColumns({"p10": F.col("pronostico") + F.col("r10"), "p90": F.col("pronostico") + F.col("r90")}))
    return out.withColumns({"metodo": F.lit(method), "motivo": F.lit(reason)})


def summary(cast: DataFrame) -> DataFrame:
    """Totals by crop and by state in one pass; sums of nothing stay null."""
    sets = cast.groupingSets([["cultivo"], ["estado"]], "cultivo", "estado")
    return sets.agg(F.sum("pronostico").alias("pronostico"), F.sum("referencia").alias("referencia"), F.max("caida_10").alias("caida_10"), F.count_if(F.col("nivel").isin("alto", "critico")).alias("riesgos")).withColumn("cambio_pct", numbers.change(F.col("pronostico"), F.col("referencia")))


def risk_matrix(cast: DataFrame, crops: Sequence[str]) -> DataFrame:
    """The largest chance of a shortfall, states by crops."""
    return cast.groupBy("estado").pivot("cultivo", list(crops)).agg(F.max("caida_10"))


def top_risks(cast: DataFrame, n: int = 20) -> DataFrame:
    """The largest chances of a shortfall, of equals the largest falls; both as they are shown, so that the noise of sums
    orders nothing."""
    order = [numbers.rounded(F.col("caida_10")).desc_nulls_last(), numbers.rounded(F.col("cambio_pct")).asc_nulls_last()]
    return cast.orderBy(*order, "cultivo", "estado", "anio").limit(n)


def top_volume(cast: DataFrame, volume: str = "pronostico", n: int = 20) -> DataFrame:
    """The largest volumes."""
    return cast.orderBy(F.col(volume).desc_nulls_last(), "cultivo", "estado", "anio").limit(n)


def top_entities(progress: DataFrame, n: int = 10) -> DataFrame:
    """The states that lead each crop's production at its last cutoff."""
    last = progress.groupBy("cultivo").agg(F.max("corte").alias("corte"))
    return rows.best(progress.join(last, ["cultivo", "corte"]), ["cultivo"], [F.col("acumulada").desc_nulls_last(), F.col("estado")], n)
