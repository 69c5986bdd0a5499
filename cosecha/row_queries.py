"""Registered queries of horizons, readers, sinks, names and texts over the driver's tables, with their DuckDB SQL."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cosecha.functions import dates, text
from cosecha.operators import rows
from cosecha.plans import international, prices, production, water
from cosecha.queries import FEATURES, LAST, LEVEL, METRIC, ORIGINS, VALUES, WEEKLY, SPREADS, I, R, Rs, _below, _sql, _values, query, shown
from cosecha.sources import files, records
from cosecha.sources.driver import Tables
from cosecha.streaming import incremental

# Forecasts by horizon

BY_METHOD = "CASE {0} WHEN 'persistencia' THEN precio WHEN 'estacional_7' THEN lag_7 WHEN 'media_28' THEN media_28 END"
HORIZONS = f"""t0 AS (SELECT * FROM (SELECT h AS horizonte, cultivo, mercado, fecha, precio, lag_7, media_28, CASE h WHEN 7 THEN objetivo_7 WHEN 14 THEN objetivo_14 ELSE objetivo_28 END AS a
 FROM fx, (VALUES (7), (14), (28)) v(h)) WHERE a IS NOT NULL AND lag_7 IS NOT NULL),
hd AS (SELECT horizonte, fecha, row_number() OVER (PARTITION BY horizonte ORDER BY fecha) - 1 AS i, count(*) OVER (PARTITION BY horizonte) AS n FROM (SELECT DISTINCT horizonte, fecha FROM t0)),
cc AS (SELECT horizonte, fecha AS corte FROM hd WHERE i = least(n - 1, greatest(1, CAST(floor(n * 0.8) AS BIGINT))) AND n >= 5),
t1 AS (SELECT t0.*, fecha >= corte AS prueba FROM t0 JOIN cc USING (horizonte)),
sz AS (SELECT horizonte, count(*) FILTER (NOT prueba) AS filas FROM t1 GROUP BY 1),
mm AS (SELECT horizonte, metodo, a, {BY_METHOD.format("metodo")} AS p FROM t1, (VALUES ('persistencia'), ('estacional_7'), ('media_28')) v(metodo) WHERE prueba),
me AS (SELECT horizonte, metodo, count(*) AS n, {METRIC} FROM mm WHERE p IS NOT NULL GROUP BY ALL),
ch AS (SELECT me.*, filas, CASE WHEN filas < 300 THEN 'pocas_filas' ELSE 'menor_mae' END AS motivo FROM me JOIN sz USING (horizonte)
 QUALIFY row_number() OVER (PARTITION BY horizonte ORDER BY CASE WHEN filas < 300 AND metodo <> 'persistencia' THEN 1 ELSE 0 END, mae, metodo) = 1)"""
HORIZON_ALERTS = f"""bb AS (SELECT horizonte, quantile_cont(c, 0.1) AS r10, quantile_cont(c, 0.9) AS r90
 FROM (SELECT t1.horizonte, a - {BY_METHOD.format("metodo")} AS c FROM t1 JOIN ch ON t1.horizonte = ch.horizonte WHERE prueba) WHERE c IS NOT NULL GROUP BY 1),
hl AS (SELECT lp.*, ch.horizonte, ch.metodo, {BY_METHOD.format("ch.metodo")} AS pronostico, r10, r90 FROM lp, ch JOIN bb ON ch.horizonte = bb.horizonte),
hm AS (SELECT *, pronostico + r10 AS p10, pronostico + r90 AS p90 FROM hl WHERE pronostico IS NOT NULL),
hc AS (SELECT *, 1 - ({_below("precio * 1.1")}) AS prob_10 FROM hm),
ha AS (SELECT *, {LEVEL.format("prob_10")} AS nivel FROM hc)"""
ALL_HORIZONS = ", ".join([FEATURES, HORIZONS, LAST, HORIZON_ALERTS])


@query(_sql("w", ", ".join([FEATURES, HORIZONS]), f"SELECT {I('horizonte')}, metodo, n, filas, motivo, {Rs('mae', 'rmse', 'mape')} FROM ch"))
def price_methods(t: Tables) -> DataFrame:
    """The method of each horizon, by a back-test of its own."""
    return shown(prices.chosen(prices.targets(prices.features(t.wholesale()))))


def _alerts(t: Tables) -> DataFrame:
    # each is read several times
    f = files.saved(prices.features(t.wholesale()), "price-features")
    target = files.saved(prices.targets(f), "price-targets")
    choice = files.saved(prices.chosen(target), "price-choice")
    return prices.horizon_alerts(prices.latest_prices(f), choice, prices.bands(target, choice), prices.main_origins(t.wholesale()))


@query(_sql("w", ", ".join([ALL_HORIZONS, ORIGINS]), f"SELECT ha.cultivo, ha.mercado, {I('horizonte')}, metodo, nivel, origen AS origen_principal, {Rs('precio', 'pronostico', 'p10', 'p90', 'prob_10')} FROM ha LEFT JOIN og ON ha.cultivo = og.cultivo AND ha.mercado = og.mercado"))
def horizon_alerts(t: Tables) -> DataFrame:
    return shown(_alerts(t).select("cultivo", "mercado", "horizonte", "metodo", "nivel", "origen_principal", "precio", "pronostico", "p10", "p90", "prob_10"))


@query(_sql("w", ALL_HORIZONS, f"SELECT {I('horizonte')}, count(*) AS alertas, count(*) FILTER (nivel = 'critico') AS criticas, {R('max(prob_10)', 'maxima')} FROM ha GROUP BY 1"))
def horizon_summary(t: Tables) -> DataFrame:
    return shown(prices.horizon_summary(_alerts(t)))


@query(_sql("w", ALL_HORIZONS, f"SELECT {I('horizonte')}, cultivo, mercado, {Rs('prob_10')} FROM ha QUALIFY row_number() OVER (PARTITION BY horizonte ORDER BY ha.prob_10 DESC NULLS LAST, cultivo, mercado) <= 12"))
def top_alerts(t: Tables) -> DataFrame:
    return shown(prices.top_alerts(_alerts(t)).select("horizonte", "cultivo", "mercado", "prob_10"))


@query(
    _sql(
        "wr",
        ", ".join([ALL_HORIZONS, SPREADS, WEEKLY]),
        "SELECT coalesce((SELECT cultivo FROM ha WHERE horizonte = (SELECT max(horizonte) FROM ha) AND cultivo IN (SELECT cultivo FROM wk) ORDER BY prob_10 DESC NULLS LAST, cultivo LIMIT 1), (SELECT min(cultivo) FROM wk)) AS cultivo",
    )
)
def default_crop(t: Tables) -> DataFrame:
    return prices.default_crop(_alerts(t), prices.weekly(t.wholesale(), prices.spreads(t.wholesale(), t.retail())))


# Choices of rows


@query(_sql("a", "x AS (SELECT *, max(corte) OVER (PARTITION BY cultivo) AS ultimo FROM a)", f"SELECT cultivo, estado, corte, {Rs('acumulada')} FROM x WHERE corte = ultimo QUALIFY row_number() OVER (PARTITION BY cultivo ORDER BY x.acumulada DESC NULLS LAST, estado) <= 10"))
def top_entities(t: Tables) -> DataFrame:
    return shown(production.top_entities(t.progress()).select("cultivo", "estado", "corte", "acumulada"))


@query(_sql("d", "x AS (SELECT 1)", f"SELECT presa, fecha, {R('pct * name / 100', 'hm3')} FROM d WHERE estado = 'NATION_3'"))
def dams_of_state(t: Tables) -> DataFrame:
    """Reservoirs of one state, whatever its accents, with the volume that their percentage means."""
    d = t.dams().where(text.of_state(F.col("estado"), "Nátion 3"))
    return shown(d.select("presa", "fecha", water.volume(F.col("pct"), F.col("name")).alias("hm3")))


@query("SELECT s_suppkey AS presa, n_name AS estado FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE n_name = 'NATION_3' ORDER BY 1 LIMIT 5")
def first_places(t: Tables) -> DataFrame:
    """The first five places of a state: the limit is the feature."""
    s = t.raw("supplier").join(t.raw("nation"), F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_suppkey").alias("presa"), F.col("n_name").alias("estado"))
    return files.places(s, "nátion 3", 5)


@query(_sql("w", VALUES, "SELECT DISTINCT producto, proxy, uso, frecuencia FROM va"))
def proxy_map(t: Tables) -> DataFrame:
    return international.proxy_map(_values(t))


@query("SELECT o_orderkey, CAST(o_orderdate AS DATE) AS fecha FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1995-02-01' AND DATE '1996-06-30'")
def orders_between(t: Tables) -> DataFrame:
    o = t.raw("orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("fecha"))
    return rows.between(o, "fecha", dt.date(1995, 2, 1), dt.date(1996, 6, 30))


@query("SELECT l_orderkey, l_linenumber, CAST(year(l_shipdate) AS BIGINT) AS anio FROM lineitem WHERE year(l_shipdate) NOT IN (SELECT DISTINCT year(o_orderdate) FROM orders WHERE o_orderdate < DATE '1997-01-01')")
def new_years(t: Tables) -> DataFrame:
    """Rows of the years that another table does not have yet."""
    own = t.raw("lineitem").select("l_orderkey", "l_linenumber", F.year("l_shipdate").alias("anio"))
    known = t.raw("orders").where("o_orderdate < date '1997-01-01'").select(F.year("o_orderdate").alias("anio"))
    return shown(incremental.new_periods(own, known, ["anio"]))


# Labels and dates


@query(
    """SELECT p_partkey, upper(p_type[1]) || lower(p_type[2:]) AS cultivo, CASE p_size % 3 WHEN 0 THEN 'Anio anterior' WHEN 1 THEN 'Promedio 5 anios' ELSE 'Sin referencia' END AS referencia,
CASE p_size % 3 WHEN 0 THEN 'Estado de México' WHEN 1 THEN '' ELSE 'San Luis Potosi' END AS estado FROM part"""
)
def labels(t: Tables) -> DataFrame:
    kind, state = (F.element_at(F.array(*map(F.lit, x)), F.col("p_size") % 3 + 1) for x in (("anio_anterior", "promedio_5_anios", "otro"), ("MÉXICO", "Estados", " san luis POTOSI ")))
    names = text.display_state(state, {"mexico": "Estado de México"}, ("estados", "total"))
    return t.raw("part").select("p_partkey", text.display(F.replace("p_type", F.lit(" "), F.lit("_"))).alias("cultivo"), text.reference_label(kind).alias("referencia"), names.alias("estado"))


@query("SELECT page_id, CASE page_id % 4 WHEN 0 THEN url WHEN 1 THEN 'https://tienda.mx/p/' || page_id WHEN 2 THEN url ELSE 'https://tienda.mx/frutas' END AS pagina FROM pages WHERE url LIKE 'http%'")
def source_pages(t: Tables) -> DataFrame:
    p, k = t.raw("pages").where(F.col("url").startswith("http")), F.col("page_id") % 4
    first = F.when(k == 0, F.col("url")).when(k == 1, F.concat(F.lit("/p/"), "page_id")).when(k == 2, "no address").otherwise("")
    return p.select("page_id", text.source_page([first, F.when(k == 2, F.col("url"))], "https://tienda.mx", "https://tienda.mx/frutas").alias("pagina"))


@query(
    """SELECT o_orderkey, strftime(date_trunc('week', o_orderdate), '%d/%m/%Y') || ' a ' || strftime(date_trunc('week', o_orderdate) + INTERVAL 6 DAY, '%d/%m/%Y') AS semana,
CAST(CAST(o_orderdate AS DATE) - 1 AS DATE) AS consulta, CAST(o_orderdate AS DATE) AS larga, CAST(date_trunc('month', o_orderdate) AS DATE) AS mes FROM orders"""
)
def written_dates(t: Tables) -> DataFrame:
    """Labels of weeks, the day that a run asks for, and dates as they are written in reports and tables."""
    d = F.col("o_orderdate").cast("date")
    months = F.element_at(F.array(*map(F.lit, text.MONTHS)), F.month(d))
    long = F.concat(F.lit("Corte al "), F.day(d), F.lit(" de "), F.initcap(months), F.lit(" del "), F.year(d))
    return t.raw("orders").select("o_orderkey", dates.week_label(dates.week_start(d)).alias("semana"), dates.query_date(d).alias("consulta"), dates.long_date(long).alias("larga"), dates.month_code(F.date_format(d, "yyyy'M'MM")).alias("mes"))


# Texts


@query(
    """WITH x AS (SELECT *, p_size % 4 AS k FROM part) SELECT p_partkey, CASE k WHEN 0 THEN 'tomate_rojo' WHEN 1 THEN 'chile_verde' WHEN 2 THEN replace(lower(p_type), ' ', '_') END AS producto,
'Piña & ' || p_name AS limpio, 'añejo ' || p_brand AS reparado, k = 1 AS palabra, CASE WHEN k = 0 THEN [] ELSE ['uno', p_brand] END AS terminos, 'kg' AS unidad, 'Precio ' || p_brand AS rotulo,
CAST(CASE k WHEN 0 THEN p_size / 10 WHEN 1 THEN p_size / 1000 END AS DOUBLE) AS peso, CASE WHEN k <> 3 THEN CAST(p_size * 1000 + 0.5 AS DOUBLE) END AS precio, CASE WHEN k = 0 THEN 'kg' WHEN k = 1 THEN 'pza' END AS por,
p_brand AS campo, CASE WHEN k = 3 THEN 's/d' ELSE '$' || p_size || '.25/kg' END AS dinero, CASE WHEN k = 3 THEN 's/d' ELSE '+' || p_size || '.0%' END AS cambio, CASE WHEN k = 3 THEN 's/d' ELSE CAST(p_size AS VARCHAR) END AS entero FROM x"""
)
def text_values(t: Tables) -> DataFrame:
    """What the text functions make of products, titles, prices, labels and pages."""
    p, k = F.col("p_size"), F.col("p_size") % 4
    pick = lambda *x: F.element_at(F.array(*[c if not isinstance(c, str) else F.lit(c) for c in x]), k + 1)
    price, unit = text.price_and_unit(F.when(k != 3, F.concat(F.lit("Ahora $ "), F.format_number(p * 1000 + 0.5, 2), pick(" / KG", "/pza", "", ""))))
    page = F.concat(F.lit("<table><tr><td>Mercado:</td><td> "), "p_brand", F.lit(" </td></tr></table>"))
    known = F.when(k != 3, p)
    return t.raw("part").select(
        "p_partkey", text.product_or_null(pick(" Tomate ", "Chile Jalapeño", F.col("p_type"), "...")).alias("producto"), text.decoded(F.concat(F.lit("  Pi&ntilde;a&nbsp;&amp; "), "p_name")).alias("limpio"),
        text.repaired(F.concat(F.lit("aÃ±ejo "), "p_brand")).alias("reparado"), text.has_word(text.spaced(pick("papaya", "La Papa blanca", "papas", "")), "papa").alias("palabra"),
        text.terms(F.when(k == 0, " | ").otherwise(F.concat(F.lit("uno| | "), "p_brand"))).alias("terminos"), text.unit_of_label(F.concat(F.lit("Precio (usd) "), "p_brand", F.lit(" ( kg )"))).alias("unidad"),
        text.label_without_unit(F.concat(F.lit("Precio "), "p_brand", F.lit(" (kg)"))).alias("rotulo"),
        text.weight_kg(pick(F.concat(F.lit("Bolsa "), (p / 10).cast("string"), F.lit(" kg")), F.concat(F.lit("Bolsa "), p.cast("string"), F.lit("g")), "Bolsa", "")).alias("peso"),
        price.alias("precio"), unit.alias("por"), text.header_value(page, "Mercado").alias("campo"), text.money(known + 0.25).alias("dinero"), text.percent(known / 100).alias("cambio"), text.whole(known.cast("double")).alias("entero"),
    )


@query("SELECT p_partkey, CAST(2001 + p_size % 20 AS BIGINT) AS anio, CAST(1 + p_size % 12 AS BIGINT) AS mes, replace(lower(p_type), ' ', '_') AS producto FROM part")
def file_names(t: Tables) -> DataFrame:
    """Product, year and month that the name of a file tells."""
    month = F.element_at(F.array(*map(F.lit, text.MONTHS)), F.col("p_size") % 12 + 1)
    name = F.concat(text.slug(F.col("p_type")), F.lit("_"), 2001 + F.col("p_size") % 20, F.lit("_"), month, F.lit(".csv"))
    return shown(t.raw("part").select("p_partkey", text.year_of_name(name).alias("anio"), text.month_of_name(name).alias("mes"), text.product_of_name(name).alias("producto")))


# Readers and sinks

SLUG = "replace(lower(cultivo), ' ', '_')"


@query(_sql("w", "x AS (SELECT 1)", f"SELECT DISTINCT fecha, {SLUG} AS cultivo_canonico, mercado, origen, {R('precio', 'precio_frecuente')} FROM w"))
def wholesale_files(t: Tables) -> DataFrame:
    """Wholesale prices written as CSV files of dated folders, scanned and normalised; repeated rows count once."""
    root = files.scratch(t.spark, "wholesale")
    w = t.wholesale().select(F.col("cultivo").alias("Producto canonico"), F.col("mercado").alias("Destino"), F.col("origen").alias("Origen"), F.col("precio").cast("string").alias("Precio Frec"), F.date_format("fecha", "dd/MM/yyyy").alias("Fecha"))
    w.write.option("header", True).csv(f"{root}/runs/2026-01-01/sniim")
    found = files.wholesale_history(files.scan(t.spark, f"{root}/runs", "*.csv"))
    return shown(found.select("fecha", "cultivo_canonico", "mercado", "origen", "precio_frecuente")).distinct()


@query(_sql("r", "x AS (SELECT 1)", f"SELECT fecha, {SLUG} AS cultivo_canonico, {R('median(coalesce(precio_kg, precio_unidad))', 'precio_uno')} FROM r WHERE fuente = 'uno' AND coalesce(precio_kg, precio_unidad) IS NOT NULL GROUP BY ALL"))
def retail_files(t: Tables) -> DataFrame:
    """A retailer's prices in JSON files of dated folders, as medians by day and product."""
    root = files.scratch(t.spark, "retail")
    r = t.retail().where("fuente = 'uno'").select(F.col("fecha").cast("string").alias("run_date"), F.col("cultivo").alias("canonical_product"), F.col("precio_kg").alias("precio_estimado_por_kg_mxn"), F.col("precio_unidad").alias("precio_mxn"))
    r.write.json(f"{root}/2026-01-01/tienda")
    return shown(files.retail_daily(files.scan(t.spark, root, "*.json", "json"), "uno"))


@query(f"SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS fecha, l_returnflag AS serie, {R('sum(l_quantity)', 'precio_original')} FROM lineitem GROUP BY ALL")
def wide_series(t: Tables) -> DataFrame:
    """A table of months by series, as prices of commodities come, made long."""
    wide = t.raw("lineitem").groupBy(F.date_format("l_shipdate", "yyyy'M'MM").alias("Mes")).pivot("l_returnflag", ["A", "N", "R"]).agg(F.format_number(F.sum("l_quantity"), 2))
    return shown(files.wide_series(wide.fillna("…"), "Mes"))


@query(f"SELECT CAST(o_orderdate AS DATE) AS fecha, {R('max(o_totalprice) / 10000', 'tipo_cambio_mxn_usd')} FROM orders GROUP BY 1 HAVING count(*) % 2 = 1")
def exchange_rates(t: Tables) -> DataFrame:
    """A daily rate with '.' on the days that have none."""
    day = t.raw("orders").groupBy(F.col("o_orderdate").cast("date").cast("string").alias("observation_date")).agg(F.when(F.count(F.lit(1)) % 2 == 1, (F.max("o_totalprice") / 10000).cast("string")).otherwise(".").alias("DEXMXUS"))
    return shown(files.fx_rates(day))


@query(f"SELECT CAST(l_shipdate AS DATE) AS fecha, l_linestatus AS serie, {R('CASE WHEN l_linenumber = 1 THEN l_quantity ELSE (l_quantity + l_tax) / 2 END', 'precio_original')}, l_returnflag AS unidad FROM lineitem")
def middle_prices(t: Tables) -> DataFrame:
    """The price of a market report, else the middle of its low and its high."""
    own = t.raw("lineitem").select(F.date_format("l_shipdate", "yyyy-MM-dd").alias("Report Date"), F.col("l_linestatus").alias("Commodity"), F.when(F.col("l_linenumber") == 1, F.col("l_quantity")).alias("Price"), F.col("l_quantity").alias("Low Price"), F.col("l_tax").alias("High Price"), F.col("l_returnflag").alias("Unit"))
    return shown(files.mid_prices(own))


@query(_sql("c", "x AS (SELECT 1)", f"SELECT fecha, CAST(presa AS VARCHAR) AS presa, {Rs('lluvia', 'temperatura')} FROM c"))
def climate_headers(t: Tables) -> DataFrame:
    """Weather with English headers, as a table of climate."""
    own = t.weather().select(F.col("fecha").cast("string").alias("Date"), F.col("presa").alias("ID"), F.col("lluvia").alias("Precipitation (mm)"), F.col("temperatura").alias("temperature_c"))
    return shown(files.climate_table(own).select("fecha", "presa", "lluvia", "temperatura"))


@query(_sql("a", "x AS (SELECT 1)", f"SELECT {SLUG} AS cultivo, estado, CAST(anio AS BIGINT) AS anio, CAST(mes AS BIGINT) AS mes, corte, {R('acumulada')} FROM a"))
def progress_files(t: Tables) -> DataFrame:
    """Progress of two files by other headers: the last file wins, and the year and crop may come from its name."""
    a = t.progress().select(F.col("cultivo").alias("Producto canónico"), F.col("estado").alias("Entidad"), F.col("anio").alias("query_year"), F.col("mes").alias("Query Month"), "acumulada", F.lit("avance_2.csv").alias("source_file"))
    old = a.withColumns({"acumulada": F.lit(-1.0), "source_file": F.lit("avance_1.csv")})
    return shown(records.progress_history(old.union(a)).select("cultivo", "estado", "anio", "mes", "corte", "acumulada"))


@query(_sql("ay", "x AS (SELECT 1)", f"SELECT {SLUG} AS cultivo, estado, CAST(anio AS BIGINT) AS anio, {Rs('produccion', 'rendimiento')} FROM y WHERE anio BETWEEN 2000 AND 2099 OR anio % 2 = 0"))
def annual_files(t: Tables) -> DataFrame:
    """Annual closes whose odd years stand in the names of their files only."""
    y = t.annual().select(F.when(F.col("anio") % 2 == 0, F.col("cultivo")).alias("cultivo"), "estado", F.when(F.col("anio") % 2 == 0, F.col("anio")).alias("anio"), "produccion", "rendimiento", F.concat(text.slug(F.col("cultivo")), F.lit("_"), "anio", F.lit(".csv")).alias("source_file"))
    return shown(records.annual_history(y).select("cultivo", "estado", "anio", "produccion", "rendimiento"))


@query("SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'propio' WHEN 1 THEN 'trigo' ELSE 'maiz' END AS cultivo FROM customer")
def crops_by_name(t: Tables) -> DataFrame:
    """A crop of its own, else by the name, else by the label without its unit."""
    k = F.col("c_custkey") % 3
    c = t.raw("customer").select("c_custkey", F.when(k == 0, "propio").alias("cultivo"), F.when(k == 1, "Trigo Grano").alias("nombre"), F.when(k == 2, "Maíz grano (t)").alias("etiqueta"), F.lit("x.csv").alias("source_file"))
    names = t.spark.createDataFrame([("trigo grano", "trigo"), ("Maiz Grano", "maiz")], "nombre string, cultivo string")
    return records.resolved_crops(c, names, "nombre", "etiqueta").select("c_custkey", "cultivo")


@query(f"SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, {R('CASE WHEN l_linenumber % 4 <> 0 THEN l_quantity * 1000 END', 'mucho')}, CASE WHEN l_linenumber = 1 THEN '5' ELSE 'x' END AS poco FROM lineitem")
def number_columns(t: Tables) -> DataFrame:
    """Columns of texts that become numbers if most of their cells are some."""
    n = F.col("l_linenumber")
    own = t.raw("lineitem").select("l_orderkey", "l_linenumber", F.when(n % 4 == 0, "-").otherwise(F.format_number(F.col("l_quantity") * 1000, 2)).alias("mucho"), F.when(n == 1, "5").otherwise("x").alias("poco"))
    return shown(records.numbers_if_most(own, ["mucho", "poco"]))


@query(
    """SELECT replace(lower(p_name), ' ', '_') AS producto_canonico, CASE WHEN p_size % 4 = 0 THEN 'fresco' WHEN p_size % 4 = 1 THEN 'del mapa' ELSE lower(p_name) END AS consulta
FROM (SELECT p_name, min(p_size) AS p_size FROM part GROUP BY 1) WHERE p_size % 3 <> 0"""
)
def work_items(t: Tables) -> DataFrame:
    """What to ask for each active product: its own column, the map, or its name."""
    config = t.raw("part").groupBy("p_name").agg(F.min("p_size").alias("s")).select(F.col("p_name").alias("producto_canonico"), F.when(F.col("s") % 3 == 0, "no").otherwise(" Si ").alias("activo"), F.when(F.col("s") % 4 == 0, "fresco").otherwise(" ").alias("busqueda"), "s")
    own = config.where("s % 4 in (0, 1)").select(text.slug(F.col("producto_canonico")).alias("producto_canonico"), F.lit("del mapa").alias("propio"))
    return records.work_list(config, own, "busqueda")


@query("SELECT CASE WHEN p_size BETWEEN 1 AND 12 AND p_size % 4 <> 0 THEN 'buena' ELSE 'mala' END AS clase, count(*) AS n FROM part WHERE p_partkey % 2 = 0 GROUP BY 1")
def dam_requests(t: Tables) -> DataFrame:
    """Good and bad rows of a table of requests; those that are not active are neither."""
    p = F.col("p_size")
    asked = t.raw("part").select(F.lit("2020").alias("anio"), p.cast("string").alias("mes"), (p % 4).alias("decena"), F.when(F.col("p_partkey") % 2 == 0, "1").otherwise("0").alias("activo"))
    good, bad = records.query_config(asked)
    return good.select(F.lit("buena").alias("clase")).union(bad.select(F.lit("mala"))).groupBy("clase").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT 'region' AS tabla, count(*) AS filas, CAST(NULL AS DATE) AS desde FROM region UNION ALL SELECT 'orders', count(*), min(CAST(o_orderdate AS DATE)) FROM orders UNION ALL SELECT 'publicada', count(*), NULL FROM supplier UNION ALL SELECT 'historia', count(DISTINCT (o_custkey % 5, year(o_orderdate))), NULL FROM orders UNION ALL SELECT 'csv', count(*), NULL FROM part")
def written_tables(t: Tables) -> DataFrame:
    """Rows read back from each of the sinks: a folder of tables, a table with its facts, a published version, a history
    by crop and year, and a CSV export."""
    root, spark = files.scratch(t.spark, "sinks"), t.spark
    files.write_tables({"region": t.raw("region")}, root)
    orders = t.raw("orders").withColumn("fecha", F.col("o_orderdate").cast("date"))
    info = files.write_table(orders, f"{root}/orders", "fecha", ["o_custkey"])
    for version in ("1", "2"):
        files.publish(t.raw("nation" if version == "1" else "supplier"), f"{root}/published", version)
    files.write_history(orders.select((F.col("o_custkey") % 5).alias("cultivo"), F.year("fecha").alias("anio")).distinct().withColumn("x", F.lit(1)), f"{root}/history")
    files.export_csv(t.raw("part").select("p_partkey", F.col("p_type").alias("cultivo_canonico")), f"{root}/csv")
    exported = spark.read.option("header", True).csv(f"{root}/csv")
    counts = [("region", spark.read.parquet(f"{root}/region")), ("publicada", files.published(spark, f"{root}/published")), ("historia", spark.read.parquet(f"{root}/history")), ("csv", exported.where("Cultivo is not null"))]
    out = info.select(F.lit("orders").alias("tabla"), "filas", F.col("fecha_min").cast("date").alias("desde"))
    for name, df in counts:
        out = out.union(df.agg(F.count(F.lit(1))).select(F.lit(name), "*", F.lit(None).cast("date")))
    return out
