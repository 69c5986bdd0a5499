"""Wholesale and retail prices: spreads, daily panel, features, weekly comparison, anomalies, alerts.

Wholesale has (fecha, cultivo, mercado, origen, precio, precio_minimo, precio_maximo), retail (fecha, cultivo, fuente,
precio_kg, precio_unidad).  Rows with a null key belong to no group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cosecha.functions import dates, numbers
from cosecha.operators import panel, rows
from cosecha.plans import models, trees
from cosecha.sources import files

SOURCES = ("uno", "dos")
HORIZONS = (7, 14, 28)


def spreads(wholesale: DataFrame, retail: DataFrame, sources: Sequence[str] = SOURCES) -> DataFrame:
    """Daily national median of wholesale against each retailer's median; days of either side."""
    out = wholesale.dropna(subset=["fecha", "cultivo"]).groupBy("fecha", "cultivo").agg(F.median("precio").alias("mayoreo"))
    price = F.coalesce("precio_kg", "precio_unidad")
    shops = retail.dropna(subset=["fecha", "cultivo"]).withColumn("precio", price).where("precio is not null")
    shops = shops.groupBy("fecha", "cultivo").agg(*[F.median(F.when(F.col("fuente") == s, F.col("precio"))).alias(f"precio_{s}") for s in sources])
    out = out.join(shops, ["fecha", "cultivo"], "full")
    return out.withColumns({f"spread_{s}": numbers.change(F.col(f"precio_{s}"), F.col("mayoreo")) for s in sources})


def daily_panel(wholesale: DataFrame, limit: int = 3) -> DataFrame:
    """Every day of each (crop, market): prices are carried at most ``limit`` days, counts of empty days are 0.

    The days' medians go to a scratch table, as the calendar is made from them too.
    """
    keys = ["cultivo", "mercado"]
    daily = wholesale.dropna(subset=["fecha", *keys]).groupBy("fecha", *keys).agg(F.median("precio").alias("precio"), F.min("precio_minimo").alias("minimo"), F.max("precio_maximo").alias("maximo"), F.count(F.lit(1)).alias("n"))
    daily = files.saved(daily, "daily")
    w = panel.order(keys, "fecha")
    out = panel.densify(daily, keys, "fecha").withColumns({c: panel.filled(c, w, limit) for c in ("precio", "minimo", "maximo")})
    return out.withColumn("n", F.coalesce("n", F.lit(0)))


def features(wholesale: DataFrame, spread: DataFrame | None = None, horizons: Sequence[int] = (7, 14, 28)) -> DataFrame:
    """Lags, trailing means and deviations without the current day, calendar, and targets of the coming days."""
    out = daily_panel(wholesale)
    w = panel.order(["cultivo", "mercado"], "fecha")
    out = panel.lags(out, "precio", w, (1, 2, 7, 14, 28), "lag")
    out = out.withColumns({f"media_{n}": panel.trailing(F.avg, "precio", w, n, max(2, n // 3)) for n in (7, 14, 28)} | {"vol_7": panel.trailing(F.stddev_samp, "precio", w, 7, 3), "vol_28": panel.trailing(F.stddev_samp, "precio", w, 28, 7)})
    out = panel.leads(out, "precio", w, horizons, "objetivo_")
    sine, cosine = dates.cyclic(F.dayofyear("fecha"), 365.25)
    out = out.withColumns({"cambio_1": numbers.change(F.col("precio"), F.col("lag_1")), "cambio_7": numbers.change(F.col("precio"), F.col("lag_7")), "dia_semana": F.weekday("fecha"), "mes": F.month("fecha"), "seno": sine, "coseno": cosine})
    for h in horizons:
        rise = numbers.change(F.col(f"objetivo_{h}"), F.col("precio"))
        out = out.withColumns({f"alza_{s}_{h}": (rise >= s / 100).cast("int") for s in (10, 15)})
    return out if spread is None else out.join(spread, ["fecha", "cultivo"], "left")


def weekly(wholesale: DataFrame, spread: DataFrame, sources: Sequence[str] = SOURCES) -> DataFrame:
    """Per crop and week: medians over days of medians over markets, against the retailers and the week before."""
    w = wholesale.dropna(subset=["fecha", "cultivo", "mercado"])
    market = w.groupBy("cultivo", "fecha", "mercado").agg(F.median("precio").alias("p"))
    day = market.groupBy("cultivo", "fecha").agg(F.median("p").alias("p"), F.min("p").alias("lo"), F.max("p").alias("hi"), F.count("p").alias("mercados"))
    shops = spread.select("fecha", "cultivo", *[f"precio_{s}" for s in sources])  # one row per day and crop
    out = day.join(shops, ["fecha", "cultivo"], "left").groupBy("cultivo", dates.week_start(F.col("fecha")).alias("semana")).agg(
        F.median("p").alias("mediana"), F.median("lo").alias("minimo"), F.median("hi").alias("maximo"), F.max("mercados").alias("mercados"), *[F.median(f"precio_{s}").alias(f"precio_{s}") for s in sources], F.count(F.lit(1)).alias("dias")
    )
    before = Window.partitionBy("cultivo").orderBy("semana")
    out = out.withColumn("cambio", numbers.change(F.col("mediana"), F.lag("mediana").over(before)))
    for s in sources:
        p = F.col(f"precio_{s}")
        out = out.withColumns({f"cambio_{s}": numbers.change(p, F.lag(p).over(before)), f"spread_{s}": numbers.change(p, F.col("mediana")), f"hay_{s}": p.isNotNull()})
    return out


def recent_weeks(week: DataFrame, n: int = 16) -> DataFrame:
    return rows.best(week, ["cultivo"], [F.col("semana").desc()], n)


def anomalies(spread: DataFrame, sources: Sequence[str] = SOURCES) -> DataFrame:
    """Each retailer's spreads with their robust z within the crop."""
    long = spread.unpivot(["fecha", "cultivo"], [f"spread_{s}" for s in sources], "fuente", "spread").dropna(subset=["spread"])
    long = files.saved(long, "spreads")
    return panel.robust_z(long.withColumn("fuente", F.substring("fuente", 8, 99)), ["cultivo", "fuente"], "spread")


def main_origins(wholesale: DataFrame, days: int = 30) -> DataFrame:
    """The most frequent origin of each crop and market in the last days; of equals the first by name."""
    since = wholesale.agg(F.date_sub(F.max("fecha"), days).alias("since"))
    recent = wholesale.crossJoin(F.broadcast(since)).where("fecha >= since")  # one row
    counts = recent.dropna(subset=["cultivo", "mercado", "origen"]).groupBy("cultivo", "mercado", "origen").agg(F.count(F.lit(1)).alias("n"))
    return rows.best(counts, ["cultivo", "mercado"], [F.col("n").desc(), F.col("origen")])


def latest_prices(feature: DataFrame, days: int = 7) -> DataFrame:
    """The last complete row of each series that is within ``days`` of the newest."""
    newest = feature.agg(F.date_sub(F.max("fecha"), days).alias("since"))
    last = rows.latest(feature.dropna(subset=["precio", "lag_7"]), ["cultivo", "mercado"], "fecha")
    return last.crossJoin(F.broadcast(newest)).where("fecha >= since").drop("since")  # one row


def alerts(last: DataFrame, forecast: str, residuals: DataFrame, origins: DataFrame) -> DataFrame:
    """Interval, chances of a rise, level and action for the forecast in a column; residuals is one row (p10, p90)."""
    return alerted(last.crossJoin(F.broadcast(residuals)).withColumn("pronostico", F.col(forecast)), origins)


def alerted(out: DataFrame, origins: DataFrame) -> DataFrame:
    """Interval, chances of a rise, level and action of rows with precio, pronostico and residuals r10 and r90."""
    now, f = F.col("precio"), F.col("pronostico")
    out = out.withColumns({"p10": f + F.col("r10"), "p90": f + F.col("r90"), "cambio_esperado": numbers.change(f, now)})
    out = out.withColumns({f"prob_{s}": 1 - numbers.below(now * (1 + s / 100), F.col("pronostico"), F.col("p10"), F.col("p90")) for s in (10, 15)})
    out = out.withColumns({"nivel": numbers.alert_level(F.col("prob_10")), "accion": numbers.purchase_action(F.col("prob_10"), F.col("cambio_esperado"))})
    return out.join(origins.select("cultivo", "mercado", F.col("origen").alias("origen_principal")), ["cultivo", "mercado"], "left")


METHODS = {"persistencia": "precio", "estacional_7": "lag_7", "media_28": "media_28"}
LEAST_ROWS = 300


def _methods() -> dict[str, Column]:
    return {m: F.col(c) for m, c in METHODS.items()}


def by_method(metodo: str = "metodo") -> Column:
    """The forecast of the method that a column names."""
    return models.named(_methods(), metodo)


def targets(feature: DataFrame, horizons: Sequence[int] = HORIZONS, share: float = models.SHARE, keep: Sequence[str] = ()) -> DataFrame:
    """Rows with a target for each horizon (horizonte, objetivo), and whether they are after its cutoff (prueba)."""
    names = ["cultivo", "mercado", "fecha", *dict.fromkeys([*METHODS.values(), *keep])]
    each = F.explode(F.array(*[F.struct(F.lit(h).alias("horizonte"), F.col(f"objetivo_{h}").alias("objetivo")) for h in horizons])).alias("x")
    long = feature.select(*names, each).select(*names, "x.*")
    return models.marked(long.dropna(subset=["objetivo", "lag_7"]), "fecha", share)


def chosen(target: DataFrame, forced: str | None = None, least: int = LEAST_ROWS) -> DataFrame:
    """One row for each horizon: its method by the test part; persistence below ``least`` training rows."""
    return models.chosen(target, _methods(), "persistencia", forced, least)


def bands(target: DataFrame, choice: DataFrame) -> DataFrame:
    """(horizonte, r10, r90): quantiles of the chosen method's residuals on the test part."""
    return models.bands(target, choice, _methods())


#: What boosted trees learn prices from.
NUMERIC = (
    "precio", *(f"lag_{k}" for k in (1, 2, 7, 14, 28)), *(f"media_{n}" for n in (7, 14, 28)), "vol_7", "vol_28", "cambio_1", "cambio_7", "dia_semana", "mes", "seno", "coseno",
    *(f"precio_{s}" for s in SOURCES), *(f"spread_{s}" for s in SOURCES), "agua",
)
TREES = models.Candidate("arboles")


def train(feature: DataFrame, horizons: Sequence[int] = HORIZONS, forced: str | None = None, least: int = LEAST_ROWS, more: Sequence[str] = (), folder: str | None = None, **options) -> models.Trained:
    """Trees as a method of each horizon beside the simple ones; ``more``: further columns of numbers, such as proxies.

    Columns that the features lack are left out.  ``forced`` may name any method.
    """
    numeric = [c for c in (*NUMERIC, *more) if c in feature.columns]
    target = targets(feature, horizons, keep=numeric)
    each = F.explode(F.array(*map(F.lit, horizons))).alias("horizonte")
    newest = latest_prices(feature).select("cultivo", "mercado", "fecha", *dict.fromkeys([*METHODS.values(), *numeric]), each)
    keys = ["cultivo", "mercado"]
    return models.trained(target, newest, _methods(), [TREES], numeric, keys, [*keys, "fecha"], fallback="persistencia", forced=forced, least=least, folder=folder, **options)


def rise_chances(feature: DataFrame, horizon: int = HORIZONS[0], rise: int = 10, **options) -> DataFrame:
    """Rows after the cutoff with their label and the chance of a rise of so many percent, by boosted trees of classes."""
    numeric = [c for c in NUMERIC if c in feature.columns]
    label, keys = f"alza_{rise}_{horizon}", ["cultivo", "mercado"]
    own = feature.dropna(subset=[label, "lag_7"]).select(F.lit(horizon).alias("horizonte"), *keys, "fecha", label, *numeric)
    own = files.saved(models.marked(own, "fecha"), "rises")
    found = trees.boosted(own, [trees.Fit("alza", horizon, label, classes=True)], numeric, keys, [*keys, "fecha"], least=LEAST_ROWS, **options)
    tested = own.where("prueba")
    return trees.predicted(tested, {m.fit.group: m for m in found.values()}, "probabilidad").select(*keys, "fecha", F.col(label).alias("alza"), "probabilidad")


def trained_alerts(result: models.Trained, origins: DataFrame) -> DataFrame:
    """Alerts of each series for each horizon by the method that its training chose."""
    each = result.choice.select("horizonte", "metodo", "motivo").join(result.band, "horizonte")  # a row for each horizon
    forecast = models.named(_methods() | {TREES.name: F.col(TREES.name)})
    out = result.newest.join(F.broadcast(each), "horizonte").withColumn("pronostico", forecast)
    return alerted(out.where("pronostico is not null"), origins).withColumn("persistencia", F.col("metodo") == "persistencia")


def horizon_alerts(last: DataFrame, choice: DataFrame, band: DataFrame, origins: DataFrame) -> DataFrame:
    """Alerts of each series for each horizon, by the horizon's method and residuals."""
    each = choice.select("horizonte", "metodo").join(band, "horizonte")  # a row for each horizon
    out = last.crossJoin(F.broadcast(each)).withColumn("pronostico", by_method())
    return alerted(out.where("pronostico is not null"), origins)


def horizon_summary(alert: DataFrame) -> DataFrame:
    return alert.groupBy("horizonte").agg(F.count(F.lit(1)).alias("alertas"), F.count_if(F.col("nivel") == "critico").alias("criticas"), F.max("prob_10").alias("maxima"))


def top_alerts(alert: DataFrame, n: int = 12) -> DataFrame:
    """The likeliest rises of each horizon."""
    return rows.best(alert, ["horizonte"], [F.col("prob_10").desc_nulls_last(), F.col("cultivo"), F.col("mercado")], n)


def top_overall(alert: DataFrame, n: int = 15) -> DataFrame:
    """The likeliest rises of all horizons."""
    return alert.orderBy(F.col("prob_10").desc_nulls_last(), "horizonte", "cultivo", "mercado").limit(n)


def default_crop(alert: DataFrame, compared: DataFrame) -> DataFrame:
    """One row: the compared crop with the likeliest rise at the longest horizon, else the first compared one by name."""
    names = compared.where("cultivo is not null").select("cultivo").distinct()
    far = alert.join(F.broadcast(alert.agg(F.max("horizonte").alias("horizonte"))), "horizonte").join(names, "cultivo", "left_semi")
    likely = far.groupBy("cultivo").agg(F.max("prob_10").alias("prob")).agg(F.min_by("cultivo", F.struct(-F.coalesce("prob", F.lit(-1.0)), "cultivo")).alias("a"))
    return likely.crossJoin(F.broadcast(names.agg(F.min("cultivo").alias("b")))).select(F.coalesce("a", "b").alias("cultivo"))  # one row each
