"""All analyses in order, each published as tables: master, water, production, prices."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cosecha.functions import dates, text
from cosecha.operators import rows
from cosecha.plans import international, master, prices, production, water
from cosecha.sources import files
from cosecha.sources.files import write_tables


def product_context(cast: DataFrame) -> DataFrame:
    """Per crop the production forecast and the largest chance of a shortfall, to stand beside prices."""
    return cast.groupBy("cultivo").agg(F.sum("pronostico").alias("produccion_pronosticada"), F.max("caida_10").alias("caida_10"))


def cards(week: DataFrame) -> DataFrame:
    """The newest week of each crop as a JSON text."""
    last = rows.latest(week, ["cultivo"], "semana")
    return last.select("cultivo", F.to_json(F.struct("semana", "mediana", "cambio", "mercados")).alias("tarjeta"))


def report(week: DataFrame, alert: DataFrame | None = None) -> DataFrame:
    """One row (reporte): the JSON of the weekly report, with the crop that is shown first and, by crop, its label, its
    newest week, nine formatted cards and the row itself.  One entry for each crop."""
    last = rows.latest(week.where("cultivo is not null"), ["cultivo"], "semana")
    cards_ = F.struct(
        text.money(F.col("mediana")).alias("precio_mercados"), *[text.money(F.col(f"precio_{s}")).alias(f"precio_{s}") for s in prices.SOURCES],
        text.percent(F.col("cambio")).alias("cambio_mercados"), *[text.percent(F.col(f"cambio_{s}")).alias(f"cambio_{s}") for s in prices.SOURCES],
        *[text.percent(F.col(f"spread_{s}")).alias(f"spread_{s}") for s in prices.SOURCES], text.whole(F.col("mercados").cast("double")).alias("mercados_cubiertos"),
    )
    own = F.struct("cultivo", text.display(F.col("cultivo")).alias("etiqueta"), dates.week_label(F.col("semana")).alias("semana"), cards_.alias("tarjetas"), F.struct(*week.columns).alias("ultima"))
    by_crop = last.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("cultivo", own)))).alias("cultivos"))
    first = prices.default_crop(alert, week) if alert is not None else week.agg(F.min("cultivo").alias("cultivo"))
    both = first.select(F.col("cultivo").alias("por_omision")).crossJoin(F.broadcast(by_crop))  # one row each
    return both.select(F.to_json(F.struct("por_omision", "cultivos"), {"ignoreNullFields": "false"}).alias("reporte"))


def analyses(
    wholesale: DataFrame, retail: DataFrame, dams: DataFrame, weather: DataFrame, progress: DataFrame, annual: DataFrame, annual_records: DataFrame,
    proxies: DataFrame | None = None, folder: str | None = None, **learner,
) -> Mapping[str, DataFrame]:
    """Every analysis by table name: master tables, water, production, prices.

    Forecasts are those of the method that each horizon's back-test chose, boosted trees among them; ``learner`` are the
    trees' options.  Prices carry national water, production and, if given, the proxies known on their day.  With a
    ``folder`` the last models are saved there.
    """
    at = lambda name: f"{folder}/{name}" if folder else None
    climate = water.climate_decenas(weather)
    dam, state = water.features(dams, climate), files.saved(water.states(dams), "states")
    trained_water = water.train(dam, folder=at("agua"), **learner)
    dam_alerts = water.horizon_alerts(trained_water.newest, trained_water.choice, trained_water.band, water.TREES)
    cast = files.saved(production.nowcast(production.features(progress, annual), folder=at("produccion"), **learner), "nowcast")
    spread = files.saved(prices.spreads(wholesale, retail), "spreads")
    price = water.on_prices(prices.features(wholesale, spread), water.national(state)).join(product_context(cast), "cultivo", "left")
    more = ["produccion_pronosticada", "caida_10"]
    if proxies is not None:
        price = international.on_prices(price, proxies)
        more += [c for c, kind in proxies.dtypes if kind in ("double", "float")]
    price = files.saved(price, "price-features")
    trained_prices = prices.train(price, more=more, folder=at("precios"), **learner)
    price_alerts = files.saved(prices.trained_alerts(trained_prices, prices.main_origins(wholesale)), "price-alerts")
    week = files.saved(prices.weekly(wholesale, spread), "weeks")
    return {
        **{f"master_{k}": v for k, v in master.tables(wholesale, retail, progress, annual_records).items()},
        "water_climate": climate, "water_features": dam, "water_states": state, "water_methods": trained_water.choice, "water_alerts": dam_alerts,
        "production_forecast": cast, "production_summary": production.summary(cast), "production_top_risks": production.top_risks(cast), "production_top_volume": production.top_volume(cast),
        "price_features": price, "price_spreads": spread, "price_anomalies": prices.anomalies(spread), "price_weeks": week, "price_report": report(week, price_alerts),
        "price_methods": trained_prices.choice, "price_alerts": price_alerts, "price_horizons": prices.horizon_summary(price_alerts), "price_top": prices.top_overall(price_alerts),
        **{f"{name}_importances": r.importances for name, r in (("water", trained_water), ("price", trained_prices)) if r.importances is not None},
    }


def publish(tables: Mapping[str, DataFrame], root: str) -> None:
    write_tables(tables, root)
