"""Reservoirs by decena: features, climate, state and national roll-ups, alerts."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cosecha.functions import dates, numbers
from cosecha.operators import asof, panel, rows
from cosecha.plans import models
from cosecha.sources import files


def climate_decenas(weather: DataFrame) -> DataFrame:
    """Daily weather summed up by place and decena, dated by the decena's end."""
    d = F.col("fecha")
    out = weather.dropna(subset=["presa", "fecha"]).groupBy("presa", F.year(d).alias("anio"), F.month(d).alias("mes"), dates.decena_of(d).alias("decena")).agg(
        F.sum("lluvia").alias("lluvia"), F.avg("temperatura").alias("temperatura"), F.max("temperatura").alias("maxima"), F.min("temperatura").alias("minima"), F.sum("evaporacion").alias("evaporacion"), F.count_distinct("fecha").alias("dias")
    )
    return out.withColumn("fecha", dates.decena_end(F.col("anio"), F.col("mes"), F.col("decena")))


def features(dams: DataFrame, climate: DataFrame | None = None, horizons: Sequence[int] = (3, 6, 9)) -> DataFrame:
    """Lags, changes, trailing statistics, cycles and targets by reservoir, in rows that exist; gaps do not count."""
    w = panel.order(["presa"], "fecha")
    out = panel.lags(dams, "pct", w, (1, 2, 3, 6, 12, 36), "lag")
    out = out.withColumns({"media_3": panel.trailing(F.avg, "pct", w, 3, 1), "media_6": panel.trailing(F.avg, "pct", w, 6, 2), "desv_6": panel.trailing(F.stddev_samp, "pct", w, 6, 3)})
    out = panel.leads(panel.leads(out, "pct", w, horizons, "objetivo_"), "hm3", w, horizons, "hm3_")
    pct = F.col("pct")
    sine, cosine = dates.cyclic(F.col("mes"), 12.0)
    out = out.withColumn("decena_anual", dates.decena_of_year(F.col("mes"), F.col("decena")))
    sine_d, cosine_d = dates.cyclic(F.col("decena_anual"), 36.0)
    out = out.withColumns({f"cambio_{k}": pct - F.col(f"lag_{k}") for k in (1, 3, 6)} | {f"delta_{h}": F.col(f"objetivo_{h}") - pct for h in horizons})
    out = out.withColumns({"brecha_3": pct - F.col("media_3"), "brecha_6": pct - F.col("media_6"), "tendencia_3": F.col("cambio_3") / 3, "tendencia_6": F.col("cambio_6") / 6, "anual": pct - F.col("lag_36"), "mes_seno": sine, "mes_coseno": cosine, "decena_seno": sine_d, "decena_coseno": cosine_d})
    if climate is None:
        return out
    own = climate.select("presa", "fecha", "lluvia", "temperatura", "evaporacion").dropDuplicates(["presa", "fecha"])
    out = out.join(own, ["presa", "fecha"], "left").withColumn("balance", F.col("lluvia") - F.col("evaporacion"))
    return out.withColumns({"lluvia_lag_1": F.lag("lluvia").over(w)} | {f"{c}_3": panel.trailing(F.sum, c, w, 3, 1) for c in ("lluvia", "evaporacion", "balance")})


def states(dams: DataFrame) -> DataFrame:
    """Per state and decena: means, sums, reservoirs under each mark, and the storage weighted by capacity."""
    own = dams.dropna(subset=["estado", "fecha"]).withColumn("peso", F.when(F.col("namo") > 0, F.col("namo")).otherwise(F.col("name")))
    out = own.groupBy("estado", "fecha").agg(
        F.avg("pct").alias("promedio"), F.coalesce(F.sum("hm3"), F.lit(0.0)).alias("hm3"), F.coalesce(F.sum("peso"), F.lit(0.0)).alias("capacidad"), F.coalesce(F.sum(F.col("pct") * F.col("peso")), F.lit(0.0)).alias("__w"),
        F.count_distinct("presa").alias("presas"), *[F.count_if(F.col("pct") < t).alias(f"bajo_{t}") for t in (40, 25, 15)],
    )
    return out.withColumn("ponderado", numbers.ratio(F.col("__w"), F.col("capacidad"))).drop("__w")


def national(state: DataFrame) -> DataFrame:
    """Per decena the states' storage, weighted by capacity, at least 1 each."""
    weight = F.greatest(F.coalesce("capacidad", F.lit(1.0)), F.lit(1.0))
    return state.groupBy("fecha").agg((F.sum(F.col("ponderado") * weight) / F.sum(weight)).alias("agua"))


def on_prices(price: DataFrame, nation: DataFrame, days: int = 45) -> DataFrame:
    """Prices with the last national storage of at most ``days`` before; prices go to a scratch table, as they are read twice."""
    return asof.asof_series(files.saved(price, "prices"), nation.withColumnRenamed("fecha", "fecha_agua"), ("fecha", "fecha_agua"), days)


def seasonal_change(train: DataFrame, rows: DataFrame, delta: str) -> DataFrame:
    """``rows`` with pct plus the median change of their decena of the year, or of all where it has none."""
    by = train.dropna(subset=[delta]).groupBy("decena_anual").agg(F.median(delta).alias("__d"))
    default = train.agg(F.coalesce(F.median(delta), F.lit(0.0)).alias("__all"))
    out = rows.join(F.broadcast(by), "decena_anual", "left").crossJoin(F.broadcast(default))  # 36 rows and one
    return out.withColumn("estacional", F.col("pct") + F.coalesce("__d", "__all")).drop("__d", "__all")


def alerts(last: DataFrame, horizons: Sequence[int] = (3, 6, 9), spread: float = 8.0) -> DataFrame:
    """A row per reservoir and horizon: forecast, interval, chances to be under each mark, level, and the first horizon
    that is under it.  ``last`` has pct and one forecast per horizon, f_<h>; ``spread`` is half the interval."""
    out = last.withColumn("h", F.explode(F.array(*[F.struct(F.lit(h * 10).alias("dias"), F.col(f"f_{h}").alias("f")) for h in horizons]))).select("presa", "estado", "fecha", "pct", F.col("h.dias").alias("horizonte"), F.col("h.f").alias("pronostico"))
    out = out.withColumns({"p10": F.col("pronostico") - spread, "p90": F.col("pronostico") + spread})
    out = out.withColumns({f"prob_{t}": numbers.below(F.lit(float(t)), F.col("pronostico"), F.col("p10"), F.col("p90")) for t in (40, 25, 15)})
    out = out.withColumn("nivel", numbers.water_level(F.col("pronostico"), F.col("prob_40"), F.col("prob_25"), F.col("prob_15")))
    dam = Window.partitionBy("presa")
    return out.withColumns({f"dias_bajo_{t}": F.min(F.when((F.col("pronostico") < t) | (F.col(f"prob_{t}") >= 0.5), F.col("horizonte"))).over(dam) for t in (40, 25, 15)})


HORIZONS = (3, 6, 9)
LEAST_ROWS = 200
NEWEST_DAYS = 45

#: What boosted trees learn reservoirs from.
NUMERIC = (
    "pct", "hm3", "name", "namo", "mes", "decena", "decena_anual", "mes_seno", "mes_coseno", "decena_seno", "decena_coseno", *(f"lag_{k}" for k in (1, 2, 3, 6, 12, 36)), "cambio_1", "cambio_3", "cambio_6",
    "media_3", "media_6", "desv_6", "brecha_3", "brecha_6", "tendencia_3", "tendencia_6", "anual", "lluvia", "temperatura", "evaporacion", "balance", "lluvia_lag_1", "lluvia_3", "evaporacion_3", "balance_3",
)
TREES = (models.Candidate("arboles_nivel"), models.Candidate("arboles_delta", "delta", "pct"))


def methods() -> dict[str, Column]:
    """The simple methods: this decena, the same of the year before, the mean of three, and the season's usual change."""
    return {"decena_anterior": F.col("pct"), "misma_decena_anio_anterior": F.coalesce("lag_36", "pct"), "promedio_3_decenas": F.coalesce("media_3", "pct"), "delta_estacional_mediana": F.col("estacional")}


def targets(feature: DataFrame, horizons: Sequence[int] = HORIZONS, keep: Sequence[str] = ()) -> DataFrame:
    """Rows with a target and a change for each horizon, whether they are after its cutoff, and the seasonal forecast by
    the changes before it."""
    names = ["presa", "fecha", *dict.fromkeys(["pct", "lag_1", "lag_36", "media_3", "decena_anual", *keep])]
    each = F.explode(F.array(*[F.struct(F.lit(h).alias("horizonte"), F.col(f"objetivo_{h}").alias("objetivo"), F.col(f"delta_{h}").alias("delta")) for h in horizons])).alias("x")
    long = feature.select(*names, each).select(*names, "x.*").dropna(subset=["objetivo", "delta", "pct", "lag_1"])
    long = models.marked(long, "fecha")
    return seasonal(long.where(~F.col("prueba")), long)


def seasonal(train: DataFrame, rows_: DataFrame) -> DataFrame:
    """``rows_`` with ``estacional``: pct plus the median change of their horizon's decena of the year, or of all decenas.

    Changes are counted before the medians, so a task holds distinct changes and no rows.
    """
    counts = train.dropna(subset=["delta"]).groupBy("horizonte", "decena_anual", "delta").agg(F.count(F.lit(1)).alias("n"))
    middle = F.percentile("delta", F.lit(0.5), F.col("n"))
    by = counts.groupBy("horizonte", "decena_anual").agg(middle.alias("m_decena"))
    all_ = counts.groupBy("horizonte", "delta").agg(F.sum("n").alias("n")).groupBy("horizonte").agg(middle.alias("m_todas"))
    out = rows_.join(F.broadcast(by), ["horizonte", "decena_anual"], "left").join(F.broadcast(all_), "horizonte", "left")  # 37 rows a horizon
    return out.withColumn("estacional", F.col("pct") + F.coalesce("m_decena", "m_todas", F.lit(0.0))).drop("m_decena", "m_todas")


def newest(feature: DataFrame, days: int = NEWEST_DAYS) -> DataFrame:
    """The last row of each reservoir that is within ``days`` of the newest of all."""
    since = feature.agg(F.date_sub(F.max("fecha"), days).alias("since"))
    return rows.latest(feature, ["presa"], "fecha").crossJoin(F.broadcast(since)).where("fecha >= since").drop("since")  # one row


def horizon_alerts(last: DataFrame, choice: DataFrame, band: DataFrame, told: Sequence[models.Candidate] = ()) -> DataFrame:
    """Alerts of each reservoir for each horizon by its method; ``last`` has horizonte and the columns of all methods."""
    each = choice.select("horizonte", "metodo", "motivo").join(band, "horizonte")  # a row for each horizon
    f = F.col("pronostico")
    out = last.join(F.broadcast(each), "horizonte").withColumn("pronostico", models.named(methods() | {c.name: F.col(c.name) for c in told}))
    out = out.where("pronostico is not null").withColumns({"p10": f + F.col("r10"), "p90": f + F.col("r90"), "dias": F.col("horizonte") * 10, "cambio_puntos": f - F.col("pct"), "cambio_pct": numbers.change(f, F.col("pct"))})
    out = out.withColumns({f"prob_{t}": numbers.below(F.lit(float(t)), f, F.col("p10"), F.col("p90")) for t in (40, 25, 15)} | {"hm3_pronostico": volume(f, F.col("namo")), "persistencia": F.col("metodo") == "decena_anterior"})
    out = out.withColumn("nivel", numbers.water_level(f, F.col("prob_40"), F.col("prob_25"), F.col("prob_15")))
    dam = Window.partitionBy("presa")  # a row for each horizon
    return out.withColumns({f"dias_bajo_{t}": F.min(F.when((F.col("pronostico") < t) | (F.col(f"prob_{t}") >= 0.5), F.col("dias"))).over(dam) for t in (40, 25, 15)})


def by_horizon(target: DataFrame, last: DataFrame, horizons: Sequence[int] = HORIZONS) -> DataFrame:
    """The last rows once for each horizon, with the season's usual change of all that is known."""
    each = last.withColumn("horizonte", F.explode(F.array(*map(F.lit, horizons))))
    return seasonal(target, each)


def train(feature: DataFrame, horizons: Sequence[int] = HORIZONS, forced: str | None = None, least: int = LEAST_ROWS, folder: str | None = None, **options) -> models.Trained:
    """Trees of the level and of the change as methods of each horizon beside the simple ones."""
    numeric = [c for c in NUMERIC if c in feature.columns]
    target = targets(feature, horizons, keep=[*numeric, "estado"])
    last = by_horizon(target, newest(feature), horizons)
    return models.trained(target, last, methods(), TREES, numeric, ["estado"], ["presa", "fecha"], fallback="decena_anterior", forced=forced, least=least, folder=folder, **options)


def summary(alert: DataFrame) -> DataFrame:
    """Per horizon: reservoirs, critical, high or critical, mean forecast and mean absolute change, commonest level."""
    return alert.groupBy("horizonte").agg(
        F.count_distinct("presa").alias("presas"), F.count_if(F.col("nivel") == "critico").alias("criticas"), F.count_if(F.col("nivel").isin("critico", "alto")).alias("altas"), F.avg("pronostico").alias("pronostico"), F.avg(F.abs(F.col("pronostico") - F.col("pct"))).alias("cambio"), F.mode("nivel", True).alias("nivel_comun")
    )


def load_window(history: DataFrame, end, start=None, existing: DataFrame | None = None, lookback_days: int = 40) -> tuple:
    """(first, last) day of a climate load: from ``start``, or the first day of the reservoirs' history; with what is there
    already from some days before its end, but not before that history.  A window that is empty is an error."""
    earliest = history.agg(F.min(F.col("fecha").cast("date"))).first()[0]
    if earliest is None:
        raise ValueError("there is no history of reservoirs to take the window from")
    if end < earliest:
        raise ValueError(f"the window ends on {end}, before the history begins on {earliest}")
    first = start or earliest
    if existing is not None and (newest := existing.agg(F.max(F.col("fecha").cast("date"))).first()[0]) is not None:
        first = max(first, newest - timedelta(days=lookback_days), earliest)
    if first > end:
        raise ValueError(f"the window is empty: {first} is after {end}")
    return first, end


def new_window(existing: DataFrame, requested, lookback_days: int = 40) -> DataFrame:
    """One row (desde): where an incremental load begins, some days before what is there, not before ``requested``."""
    last = existing.agg(F.max("fecha").alias("ultima"))
    return last.select(F.greatest(F.lit(requested).cast("date"), F.coalesce(F.date_sub("ultima", lookback_days), F.lit(requested).cast("date"))).alias("desde"))


def volume(percent: Column, capacity: Column) -> Column:
    """Stored volume from the percentage of a capacity."""
    return percent * capacity / 100
