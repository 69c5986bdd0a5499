"""The registered queries of this library over the driver's tables, each with the DuckDB SQL it must agree with.

Floating results are rounded half up by floor on both sides, as the engines' own round() differ at decimal halves.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cosecha.functions import dates, numbers, text
from cosecha.operators import asof, panel, rows
from cosecha.plans import catalog, history, international, master, models, pages, prices, production, retail, run, water
from cosecha.sources import files, records
from cosecha.sources.driver import Tables, with_tables
from cosecha.streaming import incremental

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f: Callable[[Tables], DataFrame]):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def shown(df: DataFrame) -> DataFrame:
    """Doubles rounded, integers as bigint."""
    return df.select(*[numbers.rounded(F.col(c)).alias(c) if t == "double" else F.col(c).cast("bigint").alias(c) if t in ("int", "smallint", "tinyint") else F.col(c) for c, t in df.dtypes])


def R(x: str, name: str | None = None) -> str:
    return f"floor(({x}) * CAST(10000 AS DOUBLE) + CAST(0.500001 AS DOUBLE)) / CAST(10000 AS DOUBLE) AS {name or x}"


def Rs(*names: str) -> str:
    return ", ".join(R(n) for n in names)


def I(*names: str) -> str:  # noqa: E743
    return ", ".join(f"CAST({n} AS BIGINT) AS {n}" for n in names)


# Prices

SPREADS = """m AS (SELECT fecha, cultivo, median(precio) AS mayoreo FROM w GROUP BY ALL),
s AS (SELECT fecha, cultivo, median(CASE WHEN fuente = 'uno' THEN coalesce(precio_kg, precio_unidad) END) AS precio_uno, median(CASE WHEN fuente = 'dos' THEN coalesce(precio_kg, precio_unidad) END) AS precio_dos FROM r WHERE coalesce(precio_kg, precio_unidad) IS NOT NULL GROUP BY ALL),
sp AS (SELECT fecha, cultivo, mayoreo, precio_uno, precio_dos, precio_uno / nullif(mayoreo, 0) - 1 AS spread_uno, precio_dos / nullif(mayoreo, 0) - 1 AS spread_dos FROM m FULL JOIN s USING (fecha, cultivo))"""


def _sql(names: str, parts: str, final: str) -> str:
    """Canonical tables, further tables and the query over them."""
    return with_tables(names, "").rstrip() + ", " + parts + " " + final


@query(_sql("wr", SPREADS, f"SELECT fecha, cultivo, {Rs('mayoreo', 'precio_uno', 'precio_dos', 'spread_uno', 'spread_dos')} FROM sp"))
def retail_spreads(t: Tables) -> DataFrame:
    return shown(prices.spreads(t.wholesale(), t.retail()))


WEEKLY = """k AS (SELECT cultivo, fecha, mercado, median(precio) AS p FROM w GROUP BY ALL),
g AS (SELECT cultivo, fecha, median(p) AS p, min(p) AS lo, max(p) AS hi, count(p) AS mercados FROM k GROUP BY ALL),
z AS (SELECT g.cultivo, CAST(date_trunc('week', g.fecha) AS DATE) AS semana, median(p) AS mediana, median(lo) AS minimo, median(hi) AS maximo, max(mercados) AS mercados, median(precio_uno) AS precio_uno, median(precio_dos) AS precio_dos, count(*) AS dias FROM g LEFT JOIN sp ON g.fecha = sp.fecha AND g.cultivo = sp.cultivo GROUP BY ALL),
wk AS (SELECT *, mediana / nullif(lag(mediana) OVER v, 0) - 1 AS cambio, precio_uno / nullif(lag(precio_uno) OVER v, 0) - 1 AS cambio_uno, precio_uno / nullif(mediana, 0) - 1 AS spread_uno, precio_uno IS NOT NULL AS hay_uno, precio_dos / nullif(lag(precio_dos) OVER v, 0) - 1 AS cambio_dos, precio_dos / nullif(mediana, 0) - 1 AS spread_dos, precio_dos IS NOT NULL AS hay_dos FROM z WINDOW v AS (PARTITION BY cultivo ORDER BY semana))"""
WEEK_COLUMNS = f"cultivo, semana, mercados, dias, hay_uno, hay_dos, {Rs('mediana', 'minimo', 'maximo', 'precio_uno', 'precio_dos', 'cambio', 'cambio_uno', 'spread_uno', 'cambio_dos', 'spread_dos')}"


@query(_sql("wr", SPREADS + ", " + WEEKLY, f"SELECT {WEEK_COLUMNS} FROM wk"))
def weekly_comparison(t: Tables) -> DataFrame:
    w = t.wholesale()
    return shown(prices.weekly(w, prices.spreads(w, t.retail())))


@query(_sql("wr", SPREADS + ", " + WEEKLY, f"SELECT {WEEK_COLUMNS} FROM wk QUALIFY row_number() OVER (PARTITION BY cultivo ORDER BY semana DESC) <= 16"))
def recent_weeks(t: Tables) -> DataFrame:
    w = t.wholesale()
    return shown(prices.recent_weeks(prices.weekly(w, prices.spreads(w, t.retail()))))


PANEL = """q AS (SELECT fecha, cultivo, mercado, median(precio) AS precio, min(precio_minimo) AS minimo, max(precio_maximo) AS maximo, count(*) AS n FROM w GROUP BY ALL),
dd AS (SELECT cultivo, mercado, CAST(unnest(generate_series(min(fecha), max(fecha), INTERVAL 1 DAY)) AS DATE) AS fecha FROM q GROUP BY cultivo, mercado),
pn AS (SELECT cultivo, mercado, fecha, last_value(precio IGNORE NULLS) OVER v AS precio, last_value(minimo IGNORE NULLS) OVER v AS minimo, last_value(maximo IGNORE NULLS) OVER v AS maximo, coalesce(n, 0) AS n FROM dd LEFT JOIN q USING (cultivo, mercado, fecha) WINDOW v AS (PARTITION BY cultivo, mercado ORDER BY fecha ROWS BETWEEN 3 PRECEDING AND CURRENT ROW))"""


@query(_sql("w", PANEL, f"SELECT cultivo, mercado, fecha, n, {Rs('precio', 'minimo', 'maximo')} FROM pn"))
def daily_panel(t: Tables) -> DataFrame:
    return shown(prices.daily_panel(t.wholesale()))


def _trail(f: str, n: int, least: int) -> str:
    frame = f"(PARTITION BY cultivo, mercado ORDER BY fecha ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
    return f"CASE WHEN count(precio) OVER {frame} >= {least} THEN {f}(precio) OVER {frame} END"


FEATURES = (
    PANEL
    + ", fe AS (SELECT *, "
    + ", ".join(f"lag(precio, {k}) OVER v AS lag_{k}" for k in (1, 2, 7, 14, 28))
    + ", "
    + ", ".join(f"{_trail('avg', n, m)} AS media_{n}" for n, m in ((7, 2), (14, 4), (28, 9)))
    + f", {_trail('stddev_samp', 7, 3)} AS vol_7, {_trail('stddev_samp', 28, 7)} AS vol_28, "
    + ", ".join(f"lead(precio, {h}) OVER v AS objetivo_{h}" for h in (7, 14, 28))
    + ", isodow(fecha) - 1 AS dia_semana, month(fecha) AS mes, sin(2 * pi() * dayofyear(fecha) / 365.25) AS seno, cos(2 * pi() * dayofyear(fecha) / 365.25) AS coseno FROM pn WINDOW v AS (PARTITION BY cultivo, mercado ORDER BY fecha)), "
    + "fx AS (SELECT *, precio / nullif(lag_1, 0) - 1 AS cambio_1, precio / nullif(lag_7, 0) - 1 AS cambio_7 FROM fe)"
)
FEATURE_NAMES = [*(f"lag_{k}" for k in (1, 2, 7, 14, 28)), "media_7", "media_14", "media_28", "vol_7", "vol_28", "objetivo_7", "objetivo_14", "objetivo_28", "cambio_1", "cambio_7", "seno", "coseno"]
RISES = ", ".join(f"CAST(CAST(objetivo_{h} / nullif(precio, 0) - 1 >= {s / 100} AS INTEGER) AS BIGINT) AS alza_{s}_{h}" for h in (7, 14, 28) for s in (10, 15))


@query(_sql("w", FEATURES, f"SELECT cultivo, mercado, fecha, n, {I('dia_semana', 'mes')}, {RISES}, {Rs('precio', 'minimo', 'maximo', *FEATURE_NAMES)} FROM fx"))
def price_features(t: Tables) -> DataFrame:
    return shown(prices.features(t.wholesale()))


@query(
    _sql(
        "wr",
        SPREADS
        + """, lo AS (SELECT fecha, cultivo, 'uno' AS fuente, spread_uno AS spread FROM sp UNION ALL SELECT fecha, cultivo, 'dos', spread_dos FROM sp),
k1 AS (SELECT cultivo, fuente, median(spread) AS med, stddev_samp(spread) AS sd FROM lo WHERE spread IS NOT NULL GROUP BY ALL),
k2 AS (SELECT cultivo, fuente, median(abs(spread - med)) AS mad FROM lo JOIN k1 USING (cultivo, fuente) WHERE spread IS NOT NULL GROUP BY ALL)""",
        f"SELECT cultivo, fuente, fecha, {Rs('spread')}, {R('0.6745 * (spread - med) / CASE WHEN mad > 0 THEN mad ELSE nullif(sd, 0) END', 'robust_z')} FROM lo JOIN k1 USING (cultivo, fuente) JOIN k2 USING (cultivo, fuente) WHERE spread IS NOT NULL",
    )
)
def spread_anomalies(t: Tables) -> DataFrame:
    return shown(prices.anomalies(prices.spreads(t.wholesale(), t.retail())))


ORIGINS = "oc AS (SELECT cultivo, mercado, origen, count(*) AS n FROM w WHERE fecha >= (SELECT max(fecha) FROM w) - 30 GROUP BY ALL), og AS (SELECT * FROM oc QUALIFY row_number() OVER (PARTITION BY cultivo, mercado ORDER BY n DESC, origen) = 1)"


@query(_sql("w", ORIGINS, "SELECT * FROM og"))
def main_origins(t: Tables) -> DataFrame:
    return prices.main_origins(t.wholesale())


LAST = "la AS (SELECT * FROM fx WHERE precio IS NOT NULL AND lag_7 IS NOT NULL QUALIFY row_number() OVER (PARTITION BY cultivo, mercado ORDER BY fecha DESC) = 1), lp AS (SELECT * FROM la WHERE fecha >= (SELECT max(fecha) FROM fx) - 7)"


@query(_sql("w", FEATURES + ", " + LAST, f"SELECT cultivo, mercado, fecha, {Rs('precio', 'lag_7')} FROM lp"))
def latest_prices(t: Tables) -> DataFrame:
    return shown(prices.latest_prices(prices.features(t.wholesale())).select("cultivo", "mercado", "fecha", "precio", "lag_7"))


TEST = "tr AS (SELECT * FROM fx WHERE objetivo_7 IS NOT NULL AND lag_7 IS NOT NULL), dy AS (SELECT fecha, row_number() OVER (ORDER BY fecha) - 1 AS i, count(*) OVER () AS n FROM (SELECT DISTINCT fecha FROM tr)), cu AS (SELECT fecha FROM dy WHERE i = least(n - 1, greatest(1, CAST(floor(n * 0.8) AS BIGINT))) AND n >= 5), te AS (SELECT * FROM tr WHERE fecha >= (SELECT fecha FROM cu))"
METHODS = "mt AS (SELECT 'persistencia' AS metodo, objetivo_7 AS a, precio AS p FROM te UNION ALL SELECT 'estacional_7', objetivo_7, lag_7 FROM te UNION ALL SELECT 'media_28', objetivo_7, media_28 FROM te)"


def _back_test(t: Tables) -> tuple[DataFrame, DataFrame]:
    f = prices.features(t.wholesale())
    return f, models.split(f.dropna(subset=["objetivo_7", "lag_7"]), "fecha")[1]


def _price_metrics(test: DataFrame) -> DataFrame:
    return models.metrics(test, "objetivo_7", {"persistencia": F.col("precio"), "estacional_7": F.col("lag_7"), "media_28": F.col("media_28")})


METRIC = "avg(abs(a - p)) AS mae, sqrt(avg((a - p) * (a - p))) AS rmse, avg(abs(a - p) / nullif(abs(a), 0)) AS mape"


@query(_sql("w", ", ".join([FEATURES, TEST, METHODS]), f"SELECT metodo, n, {Rs('mae', 'rmse', 'mape')} FROM (SELECT metodo, count(*) AS n, {METRIC} FROM mt WHERE a IS NOT NULL AND p IS NOT NULL GROUP BY metodo)"))
def price_back_test(t: Tables) -> DataFrame:
    return shown(_price_metrics(_back_test(t)[1]))


@query(_sql("w", ", ".join([FEATURES, TEST, METHODS]), f"SELECT metodo, n, {Rs('mae', 'rmse', 'mape')}, FALSE AS forzado FROM (SELECT metodo, count(*) AS n, {METRIC} FROM mt WHERE a IS NOT NULL AND p IS NOT NULL GROUP BY metodo) ORDER BY mae, metodo LIMIT 1"))
def price_method(t: Tables) -> DataFrame:
    return shown(models.choose(_price_metrics(_back_test(t)[1])))


def _erf(z: str) -> str:
    """The distribution function in SQL, by the same polynomial."""
    x = f"(abs({z}) / sqrt(CAST(2 AS DOUBLE)))"
    k = f"(1.0 / (1.0 + 0.3275911 * {x}))"
    e = f"(1.0 - ((((1.061405429 * {k} - 1.453152027) * {k} + 1.421413741) * {k} - 0.284496736) * {k} + 0.254829592) * {k} * exp(-{x} * {x}))"
    return f"CASE WHEN {z} >= 0 THEN 0.5 * (1.0 + {e}) ELSE 0.5 * (1.0 - {e}) END"


def _below(threshold: str, middle: str = "pronostico", p10: str = "p10", p90: str = "p90") -> str:
    return _erf(f"((({threshold}) - {middle}) / greatest(({p90} - {p10}) / 2.563, 1e-6))")


LEVEL = "CASE WHEN {0} <= 0.25 THEN 'bajo' WHEN {0} <= 0.5 THEN 'medio' WHEN {0} <= 0.75 THEN 'alto' WHEN {0} <= 1 THEN 'critico' END"


@query(
    _sql(
        "w",
        ", ".join([FEATURES, TEST, LAST, ORIGINS])
        + f""", rb AS (SELECT quantile_cont(objetivo_7 - precio, 0.1) AS r10, quantile_cont(objetivo_7 - precio, 0.9) AS r90 FROM te),
al AS (SELECT lp.*, precio AS pronostico, precio + r10 AS p10, precio + r90 AS p90, precio / nullif(precio, 0) - 1 AS cambio_esperado FROM lp, rb),
a2 AS (SELECT *, 1 - ({_below('precio * 1.1')}) AS prob_10, 1 - ({_below('precio * 1.15')}) AS prob_15 FROM al)""",
        f"SELECT a2.cultivo, a2.mercado, fecha, {Rs('precio', 'pronostico', 'p10', 'p90', 'prob_10', 'prob_15')}, {LEVEL.format('prob_10')} AS nivel, CASE WHEN prob_10 >= 0.7 OR cambio_esperado >= 0.15 THEN 'Adelantar compras y diversificar origen.' WHEN prob_10 >= 0.45 OR cambio_esperado >= 0.08 THEN 'Solicitar cotizaciones alternas y monitorear diariamente.' ELSE 'Mantener compra normal y revisar en el siguiente corte.' END AS accion, origen AS origen_principal FROM a2 LEFT JOIN og ON a2.cultivo = og.cultivo AND a2.mercado = og.mercado",
    )
)
def price_alerts(t: Tables) -> DataFrame:
    f, test = (files.saved(x, "price-features") for x in _back_test(t))  # read several times
    band = models.residual_band(test, "objetivo_7", F.col("precio"))
    out = prices.alerts(prices.latest_prices(f), "precio", band, prices.main_origins(t.wholesale()))
    return shown(out.select("cultivo", "mercado", "fecha", "precio", "pronostico", "p10", "p90", "prob_10", "prob_15", "nivel", "accion", "origen_principal"))


# Water


def _dam(f: str, n: int, least: int, c: str = "pct") -> str:
    frame = f"(PARTITION BY presa ORDER BY fecha ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
    return f"CASE WHEN count({c}) OVER {frame} >= {least} THEN {f}({c}) OVER {frame} END"


DAMS = (
    "df AS (SELECT *, (mes - 1) * 3 + decena AS decena_anual, "
    + ", ".join(f"lag(pct, {k}) OVER v AS lag_{k}" for k in (1, 2, 3, 6, 12, 36))
    + f", {_dam('avg', 3, 1)} AS media_3, {_dam('avg', 6, 2)} AS media_6, {_dam('stddev_samp', 6, 3)} AS desv_6, "
    + ", ".join(f"lead(pct, {h}) OVER v AS objetivo_{h}, lead(hm3, {h}) OVER v AS hm3_{h}, lead(pct, {h}) OVER v - pct AS delta_{h}" for h in (3, 6, 9))
    + " FROM d WINDOW v AS (PARTITION BY presa ORDER BY fecha))"
)
DAM_NAMES = ["pct", *(f"lag_{k}" for k in (1, 2, 3, 6, 12, 36)), "media_3", "media_6", "desv_6", *(f"{c}_{h}" for h in (3, 6, 9) for c in ("objetivo", "hm3", "delta"))]


@query(_sql("d", DAMS, f"SELECT presa, fecha, {I('decena_anual')}, {Rs(*DAM_NAMES)}, {R('pct - lag_3', 'cambio_3')}, {R('pct - media_6', 'brecha_6')}, {R('(pct - lag_6) / 6', 'tendencia_6')}, {R('pct - lag_36', 'anual')}, {R('sin(2 * pi() * mes / 12)', 'mes_seno')}, {R('cos(2 * pi() * decena_anual / 36)', 'decena_coseno')} FROM df"))
def dam_features(t: Tables) -> DataFrame:
    return shown(water.features(t.dams()).select("presa", "fecha", "decena_anual", *DAM_NAMES, "cambio_3", "brecha_6", "tendencia_6", "anual", "mes_seno", "decena_coseno"))


CLIMATE = "ca AS (SELECT presa, CAST(year(fecha) AS INTEGER) AS anio, CAST(month(fecha) AS INTEGER) AS mes, CAST(least(ceil(day(fecha) / 10), 3) AS INTEGER) AS decena, sum(lluvia) AS lluvia, avg(temperatura) AS temperatura, max(temperatura) AS maxima, min(temperatura) AS minima, sum(evaporacion) AS evaporacion, count(DISTINCT fecha) AS dias FROM c GROUP BY ALL), cl AS (SELECT *, CASE decena WHEN 1 THEN make_date(anio, mes, 10) WHEN 2 THEN make_date(anio, mes, 20) ELSE last_day(make_date(anio, mes, 1)) END AS fecha FROM ca)"


@query(_sql("c", CLIMATE, f"SELECT presa, fecha, dias, {I('anio', 'mes', 'decena')}, {Rs('lluvia', 'temperatura', 'maxima', 'minima', 'evaporacion')} FROM cl"))
def climate_decenas(t: Tables) -> DataFrame:
    return shown(water.climate_decenas(t.weather()))


@query(
    _sql(
        "dc",
        CLIMATE + ", dj AS (SELECT d.presa, d.fecha, lluvia, temperatura, evaporacion, lluvia - evaporacion AS balance FROM d LEFT JOIN cl ON d.presa = cl.presa AND d.fecha = cl.fecha)",
        f"SELECT presa, fecha, {Rs('lluvia', 'temperatura', 'evaporacion', 'balance')}, {R('lag(lluvia) OVER (PARTITION BY presa ORDER BY fecha)', 'lluvia_lag_1')}, {', '.join(R(_dam('sum', 3, 1, c), c + '_3') for c in ('lluvia', 'evaporacion', 'balance'))} FROM dj",
    )
)
def dam_climate(t: Tables) -> DataFrame:
    out = water.features(t.dams(), water.climate_decenas(t.weather()))
    return shown(out.select("presa", "fecha", "lluvia", "temperatura", "evaporacion", "balance", "lluvia_lag_1", "lluvia_3", "evaporacion_3", "balance_3"))


STATES = "st AS (SELECT estado, fecha, avg(pct) AS promedio, sum(hm3) AS hm3, sum(peso) AS capacidad, count(DISTINCT presa) AS presas, count(*) FILTER (pct < 40) AS bajo_40, count(*) FILTER (pct < 25) AS bajo_25, count(*) FILTER (pct < 15) AS bajo_15, sum(pct * peso) / nullif(sum(peso), 0) AS ponderado FROM (SELECT *, CASE WHEN namo > 0 THEN namo ELSE name END AS peso FROM d) GROUP BY estado, fecha)"


@query(_sql("d", STATES, f"SELECT estado, fecha, presas, bajo_40, bajo_25, bajo_15, {Rs('promedio', 'hm3', 'capacidad', 'ponderado')} FROM st"))
def state_water(t: Tables) -> DataFrame:
    return shown(water.states(t.dams()))


NATION = STATES + ", na AS (SELECT fecha, sum(ponderado * greatest(coalesce(capacidad, 1), 1)) / sum(greatest(coalesce(capacidad, 1), 1)) AS agua FROM st GROUP BY fecha)"


@query(_sql("d", NATION, f"SELECT fecha, {Rs('agua')} FROM na"))
def national_water(t: Tables) -> DataFrame:
    return shown(water.national(water.states(t.dams())))


@query(_sql("wd", "q AS (SELECT fecha, cultivo, median(precio) AS precio FROM w GROUP BY ALL), " + NATION + ", n2 AS (SELECT * FROM na)", f"SELECT q.fecha, cultivo, {Rs('precio')}, CASE WHEN q.fecha - n2.fecha <= 45 THEN n2.fecha END AS fecha_agua, {R('CASE WHEN q.fecha - n2.fecha <= 45 THEN agua END', 'agua')} FROM q ASOF LEFT JOIN n2 ON q.fecha >= n2.fecha"))
def prices_with_water(t: Tables) -> DataFrame:
    price = t.wholesale().groupBy("fecha", "cultivo").agg(F.median("precio").alias("precio"))
    nation = water.national(water.states(t.dams()))
    return shown(water.on_prices(price, nation))


@query(_sql("ad", STATES, f"SELECT cultivo, a.estado, corte, CASE WHEN corte - st.fecha <= 45 THEN st.fecha END AS fecha, {R('CASE WHEN corte - st.fecha <= 45 THEN ponderado END', 'ponderado')} FROM a ASOF LEFT JOIN st ON a.estado = st.estado AND a.corte >= st.fecha"))
def progress_with_water(t: Tables) -> DataFrame:
    state = water.states(t.dams()).select("estado", "fecha", "ponderado")
    return shown(asof.asof_join(t.progress().select("cultivo", "estado", "corte"), state, ("corte", "fecha"), ["estado"], 45))


@query(
    _sql(
        "d",
        DAMS + ", dl AS (SELECT * FROM df QUALIFY row_number() OVER (PARTITION BY presa ORDER BY fecha DESC) = 1), sd AS (SELECT decena_anual, median(delta_3) AS m FROM df WHERE delta_3 IS NOT NULL GROUP BY 1)",
        f"SELECT presa, fecha, {Rs('pct')}, {R('pct + coalesce(m, (SELECT coalesce(median(delta_3), 0) FROM df))', 'estacional')} FROM dl LEFT JOIN sd USING (decena_anual)",
    )
)
def seasonal_water(t: Tables) -> DataFrame:
    f = water.features(t.dams())
    return shown(water.seasonal_change(f, rows.latest(f, ["presa"], "fecha"), "delta_3").select("presa", "fecha", "pct", "estacional"))


def _water_alerts(t: Tables) -> DataFrame:
    last = rows.latest(water.features(t.dams()), ["presa"], "fecha")
    return water.alerts(last.withColumns({"f_3": F.col("media_3"), "f_6": F.col("media_6"), "f_9": F.col("lag_36")}))


W_ALERTS = (
    DAMS
    + f""", dl AS (SELECT * FROM df QUALIFY row_number() OVER (PARTITION BY presa ORDER BY fecha DESC) = 1),
u AS (SELECT presa, estado, fecha, pct, 30 AS horizonte, media_3 AS pronostico FROM dl UNION ALL SELECT presa, estado, fecha, pct, 60, media_6 FROM dl UNION ALL SELECT presa, estado, fecha, pct, 90, lag_36 FROM dl),
u1 AS (SELECT *, pronostico - 8 AS p10, pronostico + 8 AS p90 FROM u),
u2 AS (SELECT *, {_below('40.0')} AS prob_40, {_below('25.0')} AS prob_25, {_below('15.0')} AS prob_15 FROM u1),
u3 AS (SELECT *, CASE WHEN pronostico < 15 OR prob_15 >= 0.5 THEN 'critico' WHEN pronostico < 25 OR prob_25 >= 0.5 THEN 'alto' WHEN pronostico < 40 OR prob_40 >= 0.5 THEN 'medio' ELSE 'bajo' END AS nivel,"""
    + ", ".join(f"min(CASE WHEN pronostico < {k} OR prob_{k} >= 0.5 THEN horizonte END) OVER (PARTITION BY presa) AS dias_bajo_{k}" for k in (40, 25, 15))
    + " FROM u2)"
)


@query(_sql("d", W_ALERTS, f"SELECT presa, estado, fecha, nivel, {I('horizonte', 'dias_bajo_40', 'dias_bajo_25', 'dias_bajo_15')}, {Rs('pct', 'pronostico', 'p10', 'p90', 'prob_40', 'prob_25', 'prob_15')} FROM u3"))
def water_alerts(t: Tables) -> DataFrame:
    return shown(_water_alerts(t))


@query(_sql("d", W_ALERTS, f"SELECT CAST(horizonte AS BIGINT) AS horizonte, count(DISTINCT presa) AS presas, count(*) FILTER (nivel = 'critico') AS criticas, count(*) FILTER (nivel IN ('critico', 'alto')) AS altas, {R('avg(pronostico)', 'pronostico')}, {R('avg(abs(pronostico - pct))', 'cambio')} FROM u3 GROUP BY horizonte"))
def water_summary(t: Tables) -> DataFrame:
    return shown(water.summary(_water_alerts(t)).drop("nivel_comun"))


# Production

CAL = "cr AS (SELECT cultivo, estado, anio, max(produccion) OVER o AS anterior, max(rendimiento) OVER o AS rend_anterior, avg(produccion) OVER f AS media_5, stddev_samp(produccion) OVER f AS desv_5 FROM y WINDOW o AS (PARTITION BY cultivo, estado ORDER BY anio RANGE BETWEEN 1 PRECEDING AND 1 PRECEDING), f AS (PARTITION BY cultivo, estado ORDER BY anio RANGE BETWEEN 5 PRECEDING AND 1 PRECEDING))"


@query(_sql("ay", CAL, f"SELECT cultivo, estado, {I('anio')}, {Rs('anterior', 'rend_anterior', 'media_5', 'desv_5')} FROM cr"))
def calendar_references(t: Tables) -> DataFrame:
    return shown(production.calendar_references(t.annual()))


REFS = """k AS (SELECT DISTINCT cultivo, estado, anio FROM a), h AS (SELECT k.*, y.anio AS pasado, produccion, rendimiento, row_number() OVER (PARTITION BY k.cultivo, k.estado, k.anio ORDER BY y.anio DESC) AS rk FROM k JOIN y ON k.cultivo = y.cultivo AND k.estado = y.estado AND y.anio < k.anio),
rf AS (SELECT cultivo, estado, anio, max(produccion) FILTER (pasado = anio - 1) AS anterior, max(rendimiento) FILTER (pasado = anio - 1) AS rend_anterior, avg(produccion) AS media_5, stddev_samp(produccion) AS desv_5 FROM h WHERE rk <= 5 GROUP BY ALL),
pf AS (SELECT a.*, anterior, rend_anterior, media_5, desv_5, y.produccion AS final, y.rendimiento AS rend_final, cosechada / nullif(sembrada, 0) AS avance, siniestrada / nullif(sembrada, 0) AS siniestro, acumulada / nullif(anterior, 0) AS vs_anterior FROM a LEFT JOIN rf ON a.cultivo = rf.cultivo AND a.estado = rf.estado AND a.anio = rf.anio LEFT JOIN y ON a.cultivo = y.cultivo AND a.estado = y.estado AND a.anio = y.anio)"""


def _production(t: Tables) -> DataFrame:
    """Features of production; the progress, a row for each crop, state and month, is made once and read four times."""
    progress = files.saved(t.progress(), "progress")
    return production.features(progress, t.annual(progress))


@query(_sql("ay", REFS, f"SELECT cultivo, estado, corte, {I('anio', 'mes', 'sembrada', 'cosechada', 'siniestrada')}, {Rs('prod_mes', 'acumulada', 'anterior', 'rend_anterior', 'media_5', 'desv_5', 'final', 'rend_final', 'avance', 'siniestro', 'vs_anterior')} FROM pf"))
def production_features(t: Tables) -> DataFrame:
    return shown(_production(t))


CAST = (
    REFS
    + f""", pl AS (SELECT *, greatest(coalesce(anterior, media_5, acumulada), acumulada) AS pronostico FROM pf QUALIFY row_number() OVER (PARTITION BY cultivo, estado, anio ORDER BY corte DESC) = 1),
p1 AS (SELECT *, pronostico - 1.2816 * coalesce(desv_5, abs(pronostico) * 0.15) AS p10, pronostico + 1.2816 * coalesce(desv_5, abs(pronostico) * 0.15) AS p90 FROM pl),
p2 AS (SELECT *, """
    + ", ".join(f"CASE WHEN anterior IS NOT NULL THEN {_below(f'anterior * {1 - s / 100}')} END AS caida_{s}" for s in (10, 15, 20))
    + """, pronostico * 0.92 AS seco, pronostico * 0.85 AS sequia, coalesce(anterior, media_5) AS referencia, CASE WHEN anterior IS NOT NULL THEN 'anio_anterior' WHEN media_5 IS NOT NULL THEN 'promedio_5_anios' ELSE 'sin_referencia' END AS tipo_referencia FROM p1),
p3 AS (SELECT *, pronostico - referencia AS cambio_abs, pronostico / nullif(referencia, 0) - 1 AS cambio_pct, """
    + LEVEL.format("coalesce(caida_10, 0)")
    + " AS nivel FROM p2)"
)
CAST_NAMES = ["pronostico", "p10", "p90", "caida_10", "caida_15", "caida_20", "seco", "sequia", "referencia", "cambio_abs", "cambio_pct"]


@query(_sql("ay", CAST, f"SELECT cultivo, estado, tipo_referencia, nivel, {I('anio')}, {Rs(*CAST_NAMES)} FROM p3"))
def production_forecast(t: Tables) -> DataFrame:
    return shown(production.forecast(_production(t)).select("cultivo", "estado", "tipo_referencia", "nivel", "anio", *CAST_NAMES))


@query(_sql("ay", CAST, f"SELECT cultivo, estado, riesgos, {Rs('pronostico', 'referencia', 'caida_10')}, {R('pronostico / nullif(referencia, 0) - 1', 'cambio_pct')} FROM (SELECT cultivo, estado, sum(pronostico) AS pronostico, sum(referencia) AS referencia, max(caida_10) AS caida_10, count(*) FILTER (nivel IN ('alto', 'critico')) AS riesgos FROM p3 GROUP BY GROUPING SETS ((cultivo), (estado)))"))
def production_summary(t: Tables) -> DataFrame:
    return shown(production.summary(production.forecast(_production(t))))


CROPS = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")


@query(_sql("ay", CAST, "SELECT estado, " + ", ".join(R(f"max(caida_10) FILTER (cultivo = '{c}')", c) for c in CROPS) + " FROM p3 GROUP BY estado"))
def risk_matrix(t: Tables) -> DataFrame:
    return shown(production.risk_matrix(production.forecast(_production(t)), CROPS))


# International


def _records(t: Tables) -> DataFrame:
    o = t.raw("orders")
    return o.select(F.col("o_orderdate").cast("date").alias("fecha"), F.when(F.col("o_custkey") % 2 == 0, "usda_ams").otherwise("fred").alias("fuente"), F.lower("o_orderpriority").alias("serie"), (F.col("o_totalprice") / 1000).alias("precio"), F.when(F.col("o_orderstatus") == "F", "MXN").otherwise("USD").alias("moneda"))


RECORDS = "rc AS (SELECT CAST(o_orderdate AS DATE) AS fecha, CASE WHEN o_custkey % 2 = 0 THEN 'usda_ams' ELSE 'fred' END AS fuente, lower(o_orderpriority) AS serie, o_totalprice / 1000 AS precio, CASE WHEN o_orderstatus = 'F' THEN 'MXN' ELSE 'USD' END AS moneda FROM orders)"
# Proxies over the driver's order priorities: (product, proxy, source, term, use, frequency)
PROXIES = [("tomate_rojo", "p_urgent", "fred", "1-urgent", "feature", "mensual"), ("tomate_rojo", "p_low", "usda_ams", "low", "feature", "diaria"), ("papa", "p_low", "usda_ams", "low", "feature", "diaria"), ("papa", "p_high", "usda_ams", "high", "diagnostico_only", "diaria"), ("limon", "p_urgent", "fred", "urgent", "feature", "mensual")]


def _config(t: Tables) -> DataFrame:
    return t.spark.createDataFrame(PROXIES, "producto string, proxy string, fuente string, termino string, uso string, frecuencia string")


CONFIG = "pc(producto, proxy, fuente, termino, uso, frecuencia) AS (VALUES " + ", ".join(str(p) for p in PROXIES) + ")"


@query(_sql("w", RECORDS + ", " + CONFIG, f"SELECT producto, proxy, fecha, rc.fuente, serie, uso, frecuencia, moneda, {Rs('precio')} FROM rc JOIN pc ON rc.fuente = pc.fuente AND CASE WHEN rc.fuente = 'usda_ams' THEN contains(serie, termino) ELSE serie = termino END"))
def matched_proxies(t: Tables) -> DataFrame:
    return shown(international.matched(_records(t), F.broadcast(_config(t))).select("producto", "proxy", "fecha", "fuente", "serie", "uso", "frecuencia", "moneda", "precio"))


def _values(t: Tables) -> DataFrame:
    records = international.matched(_records(t), F.broadcast(_config(t))).groupBy("producto", "proxy", "uso", "frecuencia", "moneda", "fecha").agg(F.median("precio").alias("precio"))
    fx = t.raw("orders").select(F.col("o_orderdate").cast("date").alias("fecha"), "o_custkey").groupBy("fecha").agg((15 + F.max("o_custkey") % 7 / 2).alias("tasa"))
    day = international.in_pesos(records, fx).groupBy("producto", "proxy", "uso", "frecuencia", "fecha").agg(F.avg("valor").alias("valor"))
    return international.available(international.diagnosed(day))


VALUES = (
    RECORDS
    + ", "
    + CONFIG
    + """, ma AS (SELECT producto, proxy, uso, frecuencia, moneda, fecha, median(precio) AS precio FROM rc JOIN pc ON rc.fuente = pc.fuente AND CASE WHEN rc.fuente = 'usda_ams' THEN contains(serie, termino) ELSE serie = termino END GROUP BY ALL),
fxr AS (SELECT CAST(o_orderdate AS DATE) AS fecha, 15 + max(o_custkey) % 7 / 2 AS tasa FROM orders GROUP BY 1),
mx AS (SELECT ma.*, CASE WHEN moneda = 'MXN' THEN precio ELSE precio * tasa END AS valor FROM ma ASOF LEFT JOIN fxr ON ma.fecha >= fxr.fecha),
dv AS (SELECT producto, proxy, uso, frecuencia, fecha, avg(valor) AS valor FROM mx GROUP BY ALL),
dz AS (SELECT *, valor / nullif(lag(valor, 1) OVER v, 0) - 1 AS cambio_1, valor / nullif(lag(valor, 3) OVER v, 0) - 1 AS cambio_3, CASE WHEN count(valor) OVER b >= 4 THEN avg(valor) OVER b END AS m12, CASE WHEN count(valor) OVER b >= 4 THEN stddev_samp(valor) OVER b END AS s12 FROM dv WINDOW v AS (PARTITION BY producto, proxy ORDER BY fecha), b AS (PARTITION BY producto, proxy ORDER BY fecha ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING)),
va AS (SELECT *, (valor - m12) / nullif(s12, 0) AS z, CASE WHEN frecuencia LIKE 'mens%' THEN last_day(fecha) + 7 ELSE fecha END AS disponible FROM dz)"""
)


@query(_sql("w", VALUES, f"SELECT producto, proxy, uso, frecuencia, fecha, disponible, {Rs('valor', 'cambio_1', 'cambio_3', 'z')} FROM va"))
def proxy_features(t: Tables) -> DataFrame:
    return shown(_values(t))


PROXY_IDS = ("p_high", "p_low", "p_urgent")
PIVOT = "SELECT producto, disponible, " + ", ".join(f"max_by({m}, fecha) FILTER ({m} IS NOT NULL AND proxy = '{p}') AS {p}_{m}" for p in PROXY_IDS for m in ("valor", "cambio_1", "cambio_3", "z")) + " FROM va WHERE uso = 'feature' GROUP BY ALL"


@query(
    _sql(
        "w",
        VALUES + f", wi AS ({PIVOT}), q AS (SELECT fecha, cultivo, median(precio) AS precio FROM w GROUP BY ALL)",
        f"SELECT q.fecha, q.cultivo, disponible, {Rs('precio', 'p_high_valor', 'p_low_z')} FROM q ASOF LEFT JOIN wi ON q.cultivo = wi.producto AND q.fecha >= wi.disponible",
    )
)
def prices_with_proxies(t: Tables) -> DataFrame:
    """Prices with the international proxies of their crop that were available by the day."""
    price = t.wholesale().groupBy("fecha", "cultivo").agg(F.median("precio").alias("precio"))
    wide = international.pivoted(international.eligible(_values(t)), PROXY_IDS)
    return shown(international.on_prices(price, wide).select("fecha", "cultivo", "disponible", "precio", "p_high_valor", "p_low_z"))


@query(_sql("w", VALUES, "SELECT producto, disponible, " + ", ".join(R(f"max_by({m}, fecha) FILTER ({m} IS NOT NULL AND proxy = '{p}')", f"{p}_{m}") for p in PROXY_IDS for m in ("valor", "cambio_1", "cambio_3", "z")) + " FROM va WHERE uso = 'feature' GROUP BY ALL"))
def proxy_pivot(t: Tables) -> DataFrame:
    return shown(international.pivoted(international.eligible(_values(t)), PROXY_IDS))


@query(_sql("w", VALUES + ", dy AS (SELECT DISTINCT producto, fecha FROM va)", "SELECT dy.producto, dy.fecha, count(DISTINCT proxy) AS items_known, max(disponible) AS last_known FROM dy LEFT JOIN va ON dy.producto = va.producto AND va.disponible <= dy.fecha GROUP BY ALL"))
def proxy_coverage(t: Tables) -> DataFrame:
    v = _values(t)
    return international.coverage(v.select("producto", "fecha").distinct(), v)


# Master tables


@query(_sql("w", "x AS (SELECT 1)", f"SELECT fecha, cultivo, n, origen, {Rs('media', 'mediana', 'minimo', 'maximo')} FROM (SELECT fecha, cultivo, count(precio) AS n, min(origen) AS origen, avg(precio) AS media, median(precio) AS mediana, min(precio) AS minimo, max(precio) AS maximo FROM w GROUP BY fecha, cultivo)"))
def wholesale_daily(t: Tables) -> DataFrame:
    return shown(master.wholesale_daily(t.wholesale()))


RETAIL = "rd AS (SELECT fecha, cultivo, fuente, min(coalesce(precio_kg, precio_unidad)) AS comparable, arg_min(CASE WHEN precio_kg IS NOT NULL THEN 'por_kg' ELSE 'por_unidad' END, (coalesce(precio_kg, precio_unidad), CASE WHEN precio_kg IS NOT NULL THEN 'por_kg' ELSE 'por_unidad' END)) AS base, count(*) AS registros FROM r WHERE coalesce(precio_kg, precio_unidad) IS NOT NULL GROUP BY fecha, cultivo, fuente)"


@query(_sql("r", RETAIL, f"SELECT fecha, cultivo, fuente, base, registros, {Rs('comparable')} FROM rd"))
def retail_daily(t: Tables) -> DataFrame:
    return shown(master.retail_daily(t.retail()))


def _annual_records(t: Tables) -> DataFrame:
    line, part = t.raw("lineitem"), t.raw("part")
    return line.join(part, F.col("l_partkey") == F.col("p_partkey")).select(F.year("l_shipdate").alias("anio"), F.col("p_type").alias("cultivo"), F.col("l_linestatus").alias("unidad"), (F.col("l_extendedprice") / F.col("l_quantity")).alias("precio"), (F.col("l_quantity") - 10).alias("produccion"))


ANNUAL = "an AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS anio, p_type AS cultivo, l_linestatus AS unidad, sum(l_extendedprice / l_quantity * (l_quantity - 10)) / sum(l_quantity - 10) AS precio, count(*) AS filas, sum(l_quantity - 10) AS produccion FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_quantity - 10 > 0 GROUP BY ALL), mu AS (SELECT * FROM an QUALIFY row_number() OVER (PARTITION BY anio, cultivo ORDER BY produccion DESC, filas DESC, unidad) = 1)"


@query(_sql("w", ANNUAL, f"SELECT cultivo, unidad, filas, {I('anio')}, {Rs('precio', 'produccion')} FROM an"))
def annual_prices(t: Tables) -> DataFrame:
    return shown(master.annual_prices(_annual_records(t)))


@query(_sql("w", ANNUAL, f"SELECT cultivo, unidad, filas, {I('anio')}, {Rs('precio', 'produccion')} FROM mu"))
def annual_main_unit(t: Tables) -> DataFrame:
    return shown(master.main_unit(master.annual_prices(_annual_records(t))))


MONTHLY = "mo AS (SELECT cultivo, anio, mes, sum(sembrada) AS sembrada, sum(cosechada) AS cosechada, sum(siniestrada) AS siniestrada, sum(acumulada) AS produccion, count(estado) AS filas, max(corte) AS corte, sum(acumulada) / nullif(sum(cosechada), 0) AS rendimiento, sum(cosechada) / nullif(sum(sembrada), 0) AS cosecha_siembra, sum(siniestrada) / nullif(sum(sembrada), 0) AS siniestro, format('{:04d}-{:02d}', anio, mes) AS clave FROM a GROUP BY cultivo, anio, mes)"


@query(_sql("a", MONTHLY, f"SELECT cultivo, corte, clave, filas, {I('anio', 'mes', 'sembrada', 'cosechada', 'siniestrada')}, {Rs('produccion', 'rendimiento', 'cosecha_siembra', 'siniestro')} FROM mo"))
def progress_monthly(t: Tables) -> DataFrame:
    return shown(master.monthly(t.progress()))


WIDE = (
    ", ".join([RETAIL, ANNUAL, MONTHLY])
    + """, wd AS (SELECT fecha, cultivo, median(precio) AS mayoreo, count(precio) AS n FROM w GROUP BY ALL),
ky AS (SELECT DISTINCT fecha, cultivo, CAST(year(fecha) AS INTEGER) AS anio, CAST(month(fecha) AS INTEGER) AS mes FROM (SELECT fecha, cultivo FROM wd UNION SELECT fecha, cultivo FROM rd)),
wi AS (SELECT ky.*, mayoreo, u.comparable AS precio_uno, v.comparable AS precio_dos, mo.produccion AS produccion_mes, mo.rendimiento AS rendimiento, mu.precio AS precio_anual FROM ky LEFT JOIN wd ON ky.fecha = wd.fecha AND ky.cultivo = wd.cultivo LEFT JOIN rd u ON ky.fecha = u.fecha AND ky.cultivo = u.cultivo AND u.fuente = 'uno' LEFT JOIN rd v ON ky.fecha = v.fecha AND ky.cultivo = v.cultivo AND v.fuente = 'dos' LEFT JOIN mo ON ky.cultivo = mo.cultivo AND ky.anio = mo.anio AND ky.mes = mo.mes LEFT JOIN mu ON ky.cultivo = mu.cultivo AND ky.anio = mu.anio)"""
)
SOURCES = ("mayoreo", "precio_uno", "precio_dos", "produccion_mes", "precio_anual")


def _master(t: Tables) -> dict[str, DataFrame]:
    return dict(master.tables(t.wholesale(), t.retail(), t.progress(), _annual_records(t)))


@query(_sql("wra", WIDE, f"SELECT fecha, cultivo, {I('anio', 'mes')}, {Rs('mayoreo', 'precio_uno', 'precio_dos', 'produccion_mes', 'rendimiento', 'precio_anual')} FROM wi"))
def master_wide(t: Tables) -> DataFrame:
    return shown(_master(t)["wide"])


@query(_sql("wra", WIDE, f"SELECT fecha, cultivo, 'mayoreo' AS tabla, 'mediana' AS medida, {R('mayoreo', 'valor')}, n AS filas FROM wd UNION ALL SELECT fecha, cultivo, 'menudeo', fuente || '_' || base, {R('comparable', 'valor')}, registros FROM rd UNION ALL SELECT corte, cultivo, 'avance', 'produccion', {R('produccion', 'valor')}, filas FROM mo UNION ALL SELECT NULL, cultivo, 'cierre', unidad, {R('precio', 'valor')}, filas FROM an"))
def master_long(t: Tables) -> DataFrame:
    return shown(_master(t)["long"])


COVER = WIDE + ", co AS (SELECT *, " + ", ".join(f"{s} IS NOT NULL AS hay_{s}" for s in SOURCES) + ", " + " + ".join(f"CAST({s} IS NOT NULL AS INTEGER)" for s in SOURCES) + " AS fuentes FROM wi)"


@query(_sql("wra", COVER, f"SELECT fecha, cultivo, {I('fuentes')}, {R('fuentes / 5', 'cobertura')}, {', '.join('hay_' + s for s in SOURCES)} FROM co"))
def coverage(t: Tables) -> DataFrame:
    return shown(_master(t)["coverage"].select("fecha", "cultivo", "fuentes", "cobertura", *[f"hay_{s}" for s in SOURCES]))


@query(_sql("wra", COVER, "SELECT cultivo, CAST(date_trunc('month', fecha) AS DATE) AS mes, count(DISTINCT fecha) AS dias, " + ", ".join(R(f"avg(CAST(hay_{s} AS INTEGER))", f"parte_{s}") for s in SOURCES) + " FROM co GROUP BY ALL"))
def coverage_monthly(t: Tables) -> DataFrame:
    return shown(_master(t)["coverage_monthly"])


@query(_sql("wra", WIDE + ", gp AS (SELECT cultivo, CAST(date_trunc('month', fecha) AS DATE) AS mes, avg(precio_uno - mayoreo) AS brecha, count(*) AS dias, avg(precio_uno / nullif(mayoreo, 0) * 100 - 100) AS brecha_pct FROM wi WHERE precio_uno IS NOT NULL AND mayoreo IS NOT NULL GROUP BY ALL)", f"SELECT cultivo, mes, dias, {Rs('brecha', 'brecha_pct')}, {R('brecha - lag(brecha) OVER (PARTITION BY cultivo ORDER BY mes)', 'paso')} FROM gp"))
def monthly_gaps(t: Tables) -> DataFrame:
    return shown(master.gaps(_master(t)["wide"], "precio_uno"))


# Catalogue, history, pages, text, events


@query(_sql("d", "x AS (SELECT 1)", "SELECT presa, count(DISTINCT anio * 1000 + mes * 10 + decena) AS periodos, CAST(min(anio * 1000 + mes * 10 + decena) AS BIGINT) AS primero, CAST(max(anio * 1000 + mes * 10 + decena) AS BIGINT) AS ultimo, max_by(estado, anio * 1000 + mes * 10 + decena) AS estado FROM d GROUP BY presa"))
def dam_catalogue(t: Tables) -> DataFrame:
    return shown(catalog.catalogue(t.dams()))


@query(_sql("d", "ix AS (SELECT presa, (anio * 12 + mes - 1) * 3 + decena - 1 AS i FROM d), al AS (SELECT presa, unnest(generate_series(min(i), max(i))) AS i FROM ix GROUP BY presa)", "SELECT presa, CAST(i // 36 AS BIGINT) AS anio, CAST(i // 3 % 12 + 1 AS BIGINT) AS mes, CAST(i % 3 + 1 AS BIGINT) AS decena FROM al ANTI JOIN ix USING (presa, i)"))
def missing_decenas(t: Tables) -> DataFrame:
    return shown(catalog.missing(t.dams()))


def _history(t: Tables) -> DataFrame:
    line, part = t.raw("lineitem"), t.raw("part")
    month = F.month("l_shipdate")
    own = line.join(part, F.col("l_partkey") == F.col("p_partkey")).select(F.when(F.col("l_returnflag") == "A", "SIEMBRA").otherwise("COSECHA").alias("tipo"), F.col("p_type").alias("cultivo"), F.col("p_brand").alias("estado"), F.year("l_shipdate").alias("anio"), F.col("l_linenumber").alias("prioridad"), month.alias("mes"), "l_quantity", "l_linestatus")
    value = lambda i: F.coalesce(F.sum(F.when((F.col("mes") == i) & (F.col("l_linestatus") == "F"), F.col("l_quantity"))), F.lit(0.0)).alias(f"m{i:02d}")
    return own.groupBy("tipo", "cultivo", "estado", "anio", "prioridad").agg(*[value(i) for i in range(1, 13)])


HISTORY = (
    "hw AS (SELECT CASE WHEN l_returnflag = 'A' THEN 'SIEMBRA' ELSE 'COSECHA' END AS tipo, p_type AS cultivo, p_brand AS estado, CAST(year(l_shipdate) AS INTEGER) AS anio, l_linenumber AS prioridad, "
    + ", ".join(f"coalesce(sum(l_quantity) FILTER (month(l_shipdate) = {i} AND l_linestatus = 'F'), 0) AS m{i:02d}" for i in range(1, 13))
    + " FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL), hu AS (UNPIVOT hw ON "
    + ", ".join(f"m{i:02d}" for i in range(1, 13))
    + " INTO NAME mm VALUE valor), hl AS (SELECT *, CAST(substr(mm, 2, 2) AS INTEGER) AS mes, max(CASE WHEN valor > 0 THEN CAST(substr(mm, 2, 2) AS INTEGER) END) OVER (PARTITION BY tipo, cultivo, estado, anio, prioridad) AS ult FROM hu), hk AS (SELECT * FROM hl WHERE ult IS NULL OR NOT (mes > ult AND valor = 0)), ho AS (SELECT * FROM hk QUALIFY row_number() OVER (PARTITION BY tipo, cultivo, estado, anio, mes ORDER BY prioridad, valor DESC) = 1)"
)


@query(_sql("w", HISTORY, f"SELECT cultivo, estado, {I('anio', 'mes')}, CAST(row_number() OVER (PARTITION BY cultivo, anio ORDER BY estado, mes) AS BIGINT) AS renglon, {R('siembra', 'SIEMBRA')}, {R('cosecha', 'COSECHA')} FROM (SELECT cultivo, estado, anio, mes, max(valor) FILTER (tipo = 'SIEMBRA') AS siembra, max(valor) FILTER (tipo = 'COSECHA') AS cosecha FROM ho GROUP BY ALL)"))
def planting_history(t: Tables) -> DataFrame:
    return shown(history.numbered(history.side_by_side(history.months_long(_history(t)))))


@query("SELECT page_id, CASE WHEN html IS NULL OR trim(html) = '' THEN 'vacia' WHEN regexp_matches(lower(html), 'captcha|access denied|robot check') THEN 'bloqueada' WHEN regexp_matches(lower(html), 'sin registros|no se encontraron|no records') THEN 'sin_registros' ELSE 'contenido' END AS clase, regexp_extract(url, '^https?://([^/?#]+)', 1) AS sitio FROM pages")
def page_classes(t: Tables) -> DataFrame:
    return pages.classified(t.raw("pages")).drop("titulo", "producto")


def _offer_pages(t: Tables) -> DataFrame:
    item = F.struct(F.when(F.col("p_size") % 5 == 0, "Ad").otherwise("Product").alias("type"), F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_brand").alias("brand"), F.col("p_retailprice").alias("price"), (F.col("p_retailprice") + F.col("p_size") - 20).alias("priceMax"), F.lit("kg").alias("unit"))
    body = t.raw("part").groupBy(F.floor(F.col("p_partkey") / 40).cast("bigint").alias("page_id")).agg(F.to_json(F.struct(F.struct(F.collect_list(item).alias("items")).alias("props"))).alias("json"))
    return body.select("page_id", F.concat(F.lit('<html><script id="data" type="application/json">'), "json", F.lit("</script></html>")).alias("html"))


OFFERS = "pt AS (SELECT p_partkey // 40 AS page_id, p_partkey AS id, p_name AS nombre, p_brand AS marca, p_retailprice AS precio, CASE WHEN p_size > 20 THEN p_retailprice + p_size - 20 END AS antes, 'kg' AS unidad, replace(lower(p_name), ' ', '_') AS clave, p_size > 20 AS promocion FROM part WHERE p_size % 5 <> 0)"


@query(f"WITH {OFFERS} SELECT page_id, id, nombre, marca, unidad, clave, promocion, {Rs('precio', 'antes')} FROM pt")
def retail_offers(t: Tables) -> DataFrame:
    return shown(pages.offers(_offer_pages(t)).drop("cultivo"))


@query(f"WITH {OFFERS} SELECT page_id, id, nombre, marca, unidad, clave, promocion, {Rs('precio', 'antes')} FROM pt QUALIFY row_number() OVER (PARTITION BY clave ORDER BY promocion DESC, precio, id) = 1")
def best_offers(t: Tables) -> DataFrame:
    return shown(pages.best_offers(pages.offers(_offer_pages(t)).drop("cultivo")))


@query("SELECT c_custkey, 'customer_' || substr(c_name, 10) AS clave, lower(c_mktsegment) AS segmento, c_mktsegment IN ('BUILDING') AS activo, CAST(substr(c_name, 10) AS DOUBLE) AS numero FROM customer")
def customer_slugs(t: Tables) -> DataFrame:
    c = t.raw("customer")
    return c.select("c_custkey", text.slug(F.col("c_name")).alias("clave"), text.slug(F.col("c_mktsegment")).alias("segmento"), text.truthy(F.when(F.col("c_mktsegment") == "BUILDING", " Si ").otherwise("no")).alias("activo"), text.number(F.substring("c_name", 10, 20)).alias("numero"))


@query(
    """WITH n AS (SELECT s_suppkey, lower(replace(s_name, '#', '_')) AS k, CAST(s_nationkey AS VARCHAR) AS w FROM supplier),
a AS (SELECT DISTINCT CASE WHEN s_suppkey % 3 = 0 THEN k WHEN s_suppkey % 3 = 1 THEN substr(k, 12, 7) ELSE substr(k, 15) END AS q, CASE WHEN s_suppkey % 2 = 0 THEN w END AS w FROM n),
h AS (SELECT q, a.w, count(DISTINCT CASE WHEN n.k = q THEN (n.k, n.w) END) AS e, count(DISTINCT CASE WHEN contains(n.k, q) THEN (n.k, n.w) END) AS c, min(CASE WHEN n.k = q THEN n.k END) AS ek, min(CASE WHEN contains(n.k, q) THEN n.k END) AS ck
 FROM a LEFT JOIN n ON a.w IS NULL OR a.w = n.w GROUP BY ALL)
SELECT q, w, CASE WHEN e = 1 OR (e = 0 AND c = 1) THEN coalesce(ek, ck) END AS match, CASE WHEN e = 1 OR (e = 0 AND c = 1) THEN 'found' WHEN e > 1 OR c > 1 THEN 'ambiguous' ELSE 'missing' END AS status FROM h"""
)
def resolved_names(t: Tables) -> DataFrame:
    """Parts of suppliers' names, some with their nation, against the table of all suppliers."""
    n = t.raw("supplier").select("s_suppkey", F.lower(F.replace("s_name", F.lit("#"), F.lit("_"))).alias("k"), F.col("s_nationkey").cast("string").alias("w"))
    part = F.when(F.col("s_suppkey") % 3 == 0, F.col("k")).when(F.col("s_suppkey") % 3 == 1, F.substring("k", 12, 7)).otherwise(F.substring("k", 15, 99))
    asked = n.select(part.alias("q"), F.when(F.col("s_suppkey") % 2 == 0, F.col("w")).alias("w")).distinct()
    return asof.resolve_names(asked, n, "q", "k", "w")


@query(f"SELECT event_type, CASE WHEN day(ts) <= 10 THEN make_date(year(ts), month(ts), 10) WHEN day(ts) <= 20 THEN make_date(year(ts), month(ts), 20) ELSE last_day(CAST(ts AS DATE)) END AS decena, count(*) AS n, count(DISTINCT CAST(ts AS DATE)) AS dias, {R('sum(value)', 'suma')}, {R('min(value)', 'minimo')}, {R('max(value)', 'maximo')} FROM events GROUP BY ALL")
def event_decenas(t: Tables) -> DataFrame:
    return shown(incremental.by_decena(t.raw("events"), None))


@query("SELECT user_id, CAST(ts AS DATE) AS fecha, max_by(event_type, event_id) AS ultimo, CAST(max_by(CAST(regexp_extract(props, '\"k\": *(\\d+)', 1) AS INTEGER), event_id) AS BIGINT) AS k, count(*) AS n FROM events GROUP BY ALL")
def latest_events(t: Tables) -> DataFrame:
    e = t.raw("events").withColumn("fecha", F.col("ts").cast("date")).withColumn("k", F.get_json_object("props", "$.k").try_cast("int"))
    return shown(e.groupBy("user_id", "fecha").agg(F.max_by("event_type", "event_id").alias("ultimo"), F.max_by("k", "event_id").alias("k"), F.count(F.lit(1)).alias("n")))


UP_KEYS = ["presa", "fecha"]


@query(_sql("c", CLIMATE + ", nw AS (SELECT presa, fecha, lluvia + 1 AS lluvia FROM cl WHERE anio >= 1998 UNION ALL SELECT presa + 1000, fecha, lluvia FROM cl WHERE anio = 1995), ol AS (SELECT presa, fecha, lluvia FROM cl)", f"SELECT presa, fecha, {Rs('lluvia')} FROM (SELECT * FROM ol ANTI JOIN nw USING (presa, fecha) UNION ALL SELECT * FROM nw)"))
def climate_upsert(t: Tables) -> DataFrame:
    old = water.climate_decenas(t.weather())
    new = old.where("anio >= 1998").select("presa", "fecha", (F.col("lluvia") + 1).alias("lluvia")).union(old.where("anio = 1995").select(F.col("presa") + 1000, "fecha", "lluvia"))
    return shown(rows.upsert(old.select("presa", "fecha", "lluvia"), new, UP_KEYS))


@query("SELECT CASE WHEN l_quantity >= 5 AND l_discount < 0.1 THEN 'buena' ELSE 'mala' END AS clase, count(*) AS n, count(*) FILTER (l_quantity < 5) AS poca, count(*) FILTER (NOT l_discount < 0.1) AS rebajada FROM lineitem GROUP BY ALL")
def checked_rows(t: Tables) -> DataFrame:
    good, bad = rows.checked(t.raw("lineitem").select("l_orderkey", "l_quantity", "l_discount"), {"poca": F.col("l_quantity") >= 5, "rebajada": F.col("l_discount") < 0.1})
    both = good.select(F.lit("buena").alias("clase"), F.array().cast("array<string>").alias("errors")).union(bad.select(F.lit("mala"), "errors"))
    return both.groupBy("clase").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.array_contains("errors", "poca")).alias("poca"), F.count_if(F.array_contains("errors", "rebajada")).alias("rebajada"))


def _weather_payloads(t: Tables) -> DataFrame:
    """One payload per place, of maps from day to value; every ninth day of one parameter is missing."""
    day = t.weather().groupBy("presa", "fecha").agg(F.max("lluvia").alias("lluvia"), F.max("temperatura").alias("temperatura")).withColumn("dia", F.date_format("fecha", "yyyyMMdd"))
    rain = F.when(F.dayofmonth("fecha") % 9 == 0, F.lit(-999.0)).otherwise(F.col("lluvia"))
    maps = day.groupBy("presa").agg(F.map_from_entries(F.collect_list(F.struct("dia", rain))).alias("a"), F.map_from_entries(F.collect_list(F.when(F.dayofmonth("fecha") != 1, F.struct("dia", "temperatura")))).alias("b"))
    return maps.select("presa", F.to_json(F.struct(F.struct(F.struct(F.col("a").alias("PRECTOTCORR"), F.col("b").alias("T2M")).alias("parameter")).alias("properties"))).alias("json"))


@query(_sql("c", "x AS (SELECT presa, fecha, max(lluvia) AS lluvia, max(temperatura) AS temperatura FROM c GROUP BY ALL)", f"SELECT presa, fecha, {R('CASE WHEN day(fecha) % 9 <> 0 THEN lluvia END', 'lluvia')}, {R('CASE WHEN day(fecha) <> 1 THEN temperatura END', 'temperatura')} FROM x"))
def weather_rows(t: Tables) -> DataFrame:
    return shown(records.weather_rows(_weather_payloads(t)).select("presa", "fecha", "lluvia", "temperatura"))


def _dam_payloads(t: Tables) -> DataFrame:
    text_of = lambda c: F.col(c).cast("string")
    r = F.struct(F.concat(F.lit(" "), text_of("presa"), F.lit("&nbsp;")).alias("CveCONAGUAPresa"), F.col("estado").alias("nombreEstado"), text_of("anio").alias("anio"), text_of("mes").alias("cveMes"), text_of("decena").alias("cveDecena"), text_of("pct").alias("porcAlmacen"), F.when(F.col("hm3") > 50, text_of("hm3")).otherwise("-").alias("Almacenamiento"), F.format_number("name", 2).alias("NAME"))
    return t.dams().groupBy("anio", "mes", "decena", F.floor(F.col("presa") / 100)).agg(F.to_json(F.collect_list(r)).alias("json")).select("anio", "mes", "decena", "json")


@query(_sql("d", "x AS (SELECT 1)", f"SELECT CAST(presa AS VARCHAR) AS presa, estado, fecha, {I('anio', 'mes', 'decena')}, {R('pct')}, {R('CASE WHEN hm3 > 50 THEN hm3 END', 'hm3')} FROM d"))
def dam_records(t: Tables) -> DataFrame:
    return shown(records.dam_records(_dam_payloads(t)).select("presa", "estado", "fecha", "anio", "mes", "decena", "pct", "hm3"))


@query(_sql("d", "x AS (SELECT presa, fecha, pct, hm3, (mes % 4 = 0) AS sin_hora, decena FROM d UNION ALL SELECT presa, fecha, pct + 1, hm3, FALSE, decena + 1 FROM d WHERE mes % 2 = 0)", f"SELECT presa, fecha, {Rs('pct', 'hm3')} FROM x WHERE pct IS NOT NULL QUALIFY row_number() OVER (PARTITION BY presa, fecha ORDER BY sin_hora DESC, decena DESC) = 1"))
def dam_history(t: Tables) -> DataFrame:
    d = t.dams().select("presa", "fecha", "mes", "decena", "pct", "hm3")
    at = lambda c: F.timestamp_seconds(c)
    first = d.withColumn("extraido", F.when(F.col("mes") % 4 != 0, at(F.col("decena"))))
    second = d.where("mes % 2 = 0").withColumns({"pct": F.col("pct") + 1, "extraido": at(F.col("decena") + 1)})
    return shown(records.dam_history([first, second]).select("presa", "fecha", "pct", "hm3"))


@query(_sql("d", "x AS (SELECT 1)", "SELECT count(*) AS filas, count(DISTINCT presa) AS ids, count(*) FILTER (pct > 60) AS errores, min(fecha) AS desde, max(fecha) AS hasta FROM d"))
def dam_profile(t: Tables) -> DataFrame:
    return records.profile(t.dams(), "presa", "fecha", F.col("pct") > 60)


@query(_sql("ay", CAST, f"SELECT cultivo, {R('sum(pronostico)', 'produccion_pronosticada')}, {R('max(caida_10)', 'caida_10')} FROM p3 GROUP BY cultivo"))
def product_context(t: Tables) -> DataFrame:
    return shown(run.product_context(production.forecast(_production(t))))


@query(_sql("ay", CAST, f"SELECT cultivo, estado, {I('anio')}, {Rs('pronostico', 'caida_10', 'cambio_pct')} FROM p3 ORDER BY caida_10 DESC NULLS LAST, cambio_pct ASC NULLS LAST, cultivo, estado, anio LIMIT 20"))
def top_risks(t: Tables) -> DataFrame:
    return shown(production.top_risks(production.forecast(_production(t))).select("cultivo", "estado", "anio", "pronostico", "caida_10", "cambio_pct"))


TITLES = "CASE p_size % 4 WHEN 0 THEN ' por kg' WHEN 1 THEN ' 500 g' WHEN 2 THEN '' ELSE ' en malla' END"
NESTED = f"""pt AS (SELECT *, p_name || {TITLES} AS nombre, p_size % 5 = 0 AS pesado, p_size % 3 = 0 AS articulo FROM part),
nd AS (SELECT p_partkey AS page_id, nombre, p_brand AS marca,
 CASE WHEN p_size % 7 <> 0 OR p_size % 4 = 0 THEN CAST(p_retailprice AS DOUBLE) ELSE p_retailprice * 0.15 END AS precio,
 CASE WHEN p_size % 7 <> 0 AND p_retailprice + (p_size - 25) > p_retailprice THEN p_retailprice + (p_size - 25) END AS antes,
 CASE WHEN NOT articulo THEN CASE p_size % 4 WHEN 0 THEN 'kg' WHEN 1 THEN 'g_pack' WHEN 3 THEN 'malla' END
      WHEN p_size % 11 = 0 THEN 'pza' WHEN pesado THEN 'kg' WHEN p_size % 4 = 3 THEN 'malla' WHEN p_size % 4 = 1 THEN 'g_pack' END AS unidad,
 CASE WHEN NOT articulo THEN TRUE ELSE pesado OR p_size % 4 = 3 OR p_size % 6 = 0 END AS fresco,
 CASE WHEN articulo THEN CASE WHEN pesado THEN 'EACH_WEIGHT' ELSE 'EACH' END END AS venta, CASE WHEN articulo AND p_size % 11 = 0 THEN '$ 3.00 / PZA' END AS linea,
 CASE WHEN articulo THEN CASE WHEN p_size % 6 = 0 THEN 'Frutas y Verduras' ELSE 'Despensa' END END AS categoria, CASE WHEN p_size % 7 <> 0 THEN p_retailprice + (p_size - 25) END AS alto FROM pt),
ni AS (SELECT * FROM nd QUALIFY row_number() OVER (PARTITION BY page_id, lower(nombre) ORDER BY precio, nombre, marca NULLS LAST, venta NULLS LAST, linea NULLS LAST, categoria NULLS LAST, alto NULLS LAST) = 1),
ko AS (SELECT *, CASE WHEN unidad = 'kg' THEN precio WHEN nombre LIKE '% 500 g' THEN precio / 0.5 END AS precio_kg FROM ni)"""


def _nested_offers(t: Tables) -> DataFrame:
    """Pages with nested JSON of all the kinds of offers there are: plain, aggregate and of sellers."""
    p, low = F.col("p_size"), F.col("p_retailprice")
    high = low + (p - 25)  # one sum: of a size of 25 the price itself
    title = F.concat("p_name", F.element_at(F.array(*map(F.lit, (" por kg", " 500 g", "", " en malla"))), p % 4 + 1))
    aggregate = F.to_json(F.struct(F.lit("AggregateOffer").alias("@type"), (low * 0.15).alias("lowPrice"), low.alias("highPrice")))
    plain = F.to_json(F.struct(F.concat(F.lit("$"), low.cast("string")).alias("price"), high.alias("highPrice")))
    seller = F.to_json(F.array(F.struct(F.array(F.struct(F.struct(low.alias("Price"), high.alias("ListPrice")).alias("commertialOffer"))).alias("sellers"))))
    offer = F.when(p % 7 == 0, F.concat(F.lit('"offers": '), aggregate)).when(p % 7 == 1, F.concat(F.lit('"items": '), seller)).otherwise(F.concat(F.lit('"offers": '), plain))
    line = F.struct(F.when(p % 11 == 0, "$ 3.00 / PZA").alias("linePrice"))
    path = F.struct(F.array(F.struct(F.when(p % 6 == 0, "Frutas y Verduras").otherwise("Despensa").alias("name"))).alias("path"))
    item = F.to_json(F.struct(F.when(p % 5 == 0, "EACH_WEIGHT").otherwise("EACH").alias("salesUnitType"), path.alias("category"), line.alias("priceInfo")))
    own = F.to_json(F.struct(title.alias("productName"), F.struct(F.col("p_brand").alias("name")).alias("brand")))
    node = F.concat(F.regexp_replace(own, r"\}$", ", "), offer, F.when(p % 3 == 0, F.concat(F.lit(", "), F.substring(item, 2, 1 << 20))).otherwise("}"))
    html = F.concat(F.lit('<script type="application/ld+json">{"list": [{"x": '), node, F.lit(', "name": "no price"}]}</script>'))
    return retail.offers(retail.product_nodes(t.raw("part").select(F.col("p_partkey").alias("page_id"), html.alias("html"))))


@query(f"WITH {NESTED} SELECT page_id, nombre, marca, unidad, antes IS NOT NULL AS promocion, fresco, {Rs('precio', 'antes', 'precio_kg')} FROM ko")
def nested_offers(t: Tables) -> DataFrame:
    return shown(_nested_offers(t).select("page_id", "nombre", "marca", "unidad", "promocion", "fresco", "precio", "antes", "precio_kg"))


@query(
    f"""WITH {NESTED}, cr AS (SELECT *, CAST(page_id % 7 AS VARCHAR) AS cultivo, CASE WHEN page_id % 2 = 0 THEN 'fresco' ELSE 'otro' END AS consulta FROM ko)
SELECT cultivo, page_id, nombre, unidad, {Rs('precio', 'precio_kg')} FROM cr QUALIFY row_number() OVER (PARTITION BY cultivo ORDER BY fresco DESC,
 CASE WHEN unidad = 'kg' THEN 0 WHEN precio_kg IS NOT NULL THEN 1 ELSE 2 END, antes IS NOT NULL DESC, CASE WHEN cultivo IN ('1', '2') AND consulta <> 'fresco' THEN 1 ELSE 0 END, coalesce(precio_kg, precio), nombre, page_id) = 1"""
)
def ranked_offers(t: Tables) -> DataFrame:
    """The offer of each crop that ranks first; two crops have preferred terms."""
    found = _nested_offers(t).withColumns({"cultivo": (F.col("page_id") % 7).cast("string"), "consulta": F.when(F.col("page_id") % 2 == 0, "fresco").otherwise("otro")})
    preferred = t.spark.createDataFrame([("1", "Fresco"), ("2", "fresco")], "cultivo string, termino string")
    return shown(retail.best_per_crop(found, preferred).select("cultivo", "page_id", "nombre", "unidad", "precio", "precio_kg"))


from cosecha import job_queries, row_queries, upkeep_queries  # noqa: E402, F401  registers its queries
