"""Registered queries of trainings, panels, reports, series and jobs over the driver's tables, with their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cosecha.plans import master, models, pages, prices, production, trees, water
from cosecha.queries import ANNUAL, DAMS, METRIC, REFS, WIDE, I, R, Rs, _annual_records, _below, _production, _sql, query, shown
from cosecha.sources import files, records
from cosecha.sources.driver import Tables
from cosecha.streaming import refresh

# Reservoirs by horizon

WATER_METHODS = ("decena_anterior", "misma_decena_anio_anterior", "promedio_3_decenas", "delta_estacional_mediana")
BY_METHOD = "CASE {0} WHEN 'decena_anterior' THEN pct WHEN 'misma_decena_anio_anterior' THEN coalesce(lag_36, pct) WHEN 'promedio_3_decenas' THEN coalesce(media_3, pct) ELSE estacional END"
WATER_HORIZONS = (
    DAMS
    + f""", t0 AS (SELECT * FROM (SELECT h AS horizonte, df.*, CASE h WHEN 3 THEN objetivo_3 WHEN 6 THEN objetivo_6 ELSE objetivo_9 END AS a, CASE h WHEN 3 THEN delta_3 WHEN 6 THEN delta_6 ELSE delta_9 END AS delta
 FROM df, (VALUES (3), (6), (9)) v(h)) WHERE a IS NOT NULL AND delta IS NOT NULL AND pct IS NOT NULL AND lag_1 IS NOT NULL),
hd AS (SELECT horizonte, fecha, row_number() OVER (PARTITION BY horizonte ORDER BY fecha) - 1 AS i, count(*) OVER (PARTITION BY horizonte) AS n FROM (SELECT DISTINCT horizonte, fecha FROM t0)),
cc AS (SELECT horizonte, fecha AS corte FROM hd WHERE i = least(n - 1, greatest(1, CAST(floor(n * 0.8) AS BIGINT))) AND n >= 5),
t1 AS (SELECT t0.*, fecha >= corte AS prueba FROM t0 JOIN cc USING (horizonte)),
s1 AS (SELECT horizonte, decena_anual, median(delta) AS md FROM t1 WHERE NOT prueba GROUP BY ALL), s2 AS (SELECT horizonte, median(delta) AS mt FROM t1 WHERE NOT prueba GROUP BY ALL),
t2 AS (SELECT t1.*, pct + coalesce(md, mt, 0) AS estacional FROM t1 LEFT JOIN s1 USING (horizonte, decena_anual) LEFT JOIN s2 USING (horizonte)),
sz AS (SELECT horizonte, count(*) FILTER (NOT prueba) AS filas FROM t2 GROUP BY 1),
mm AS (SELECT horizonte, metodo, a, {BY_METHOD.format("metodo")} AS p FROM t2, (VALUES {", ".join(f"('{m}')" for m in WATER_METHODS)}) v(metodo) WHERE prueba),
me AS (SELECT horizonte, metodo, count(*) AS n, {METRIC} FROM mm WHERE p IS NOT NULL GROUP BY ALL),
ch AS (SELECT me.*, filas, CASE WHEN filas < 200 THEN 'pocas_filas' ELSE 'menor_mae' END AS motivo FROM me JOIN sz USING (horizonte)
 QUALIFY row_number() OVER (PARTITION BY horizonte ORDER BY CASE WHEN filas < 200 AND metodo <> 'decena_anterior' THEN 1 ELSE 0 END, mae, metodo) = 1)"""
)
WATER_ALERTS = f"""bb AS (SELECT horizonte, quantile_cont(c, 0.1) AS r10, quantile_cont(c, 0.9) AS r90
 FROM (SELECT t2.horizonte, a - {BY_METHOD.format("metodo")} AS c FROM t2 JOIN ch ON t2.horizonte = ch.horizonte WHERE prueba) WHERE c IS NOT NULL GROUP BY 1),
dl AS (SELECT * FROM df QUALIFY row_number() OVER (PARTITION BY presa ORDER BY fecha DESC) = 1), dn AS (SELECT * FROM dl WHERE fecha >= (SELECT max(fecha) FROM df) - 45),
z1 AS (SELECT horizonte, decena_anual, median(delta) AS md FROM t1 GROUP BY ALL), z2 AS (SELECT horizonte, median(delta) AS mt FROM t1 GROUP BY ALL),
n1 AS (SELECT dn.*, ch.horizonte, ch.metodo, r10, r90, pct + coalesce(md, mt, 0) AS estacional FROM dn, ch JOIN bb ON ch.horizonte = bb.horizonte LEFT JOIN z1 ON z1.horizonte = ch.horizonte AND z1.decena_anual = dn.decena_anual LEFT JOIN z2 ON z2.horizonte = ch.horizonte),
n2 AS (SELECT *, {BY_METHOD.format("metodo")} AS pronostico FROM n1), n3 AS (SELECT *, pronostico + r10 AS p10, pronostico + r90 AS p90 FROM n2 WHERE pronostico IS NOT NULL),
n4 AS (SELECT *, {_below("40.0")} AS prob_40, {_below("25.0")} AS prob_25, {_below("15.0")} AS prob_15 FROM n3)"""


@query(_sql("d", WATER_HORIZONS, f"SELECT {I('horizonte')}, metodo, n, filas, motivo, {Rs('mae', 'rmse', 'mape')} FROM ch"))
def water_methods(t: Tables) -> DataFrame:
    """The method of each horizon of reservoirs, by a back-test of its own."""
    return shown(water.models.chosen(water.targets(water.features(t.dams())), water.methods(), "decena_anterior", least=water.LEAST_ROWS))


@query(
    _sql(
        "d",
        ", ".join([WATER_HORIZONS, WATER_ALERTS]),
        f"""SELECT presa, estado, {I('horizonte')}, metodo, CASE WHEN pronostico < 15 OR prob_15 >= 0.5 THEN 'critico' WHEN pronostico < 25 OR prob_25 >= 0.5 THEN 'alto' WHEN pronostico < 40 OR prob_40 >= 0.5 THEN 'medio' ELSE 'bajo' END AS nivel,
{Rs('pct', 'pronostico', 'p10', 'p90', 'prob_40')}, {R('pronostico * namo / 100', 'hm3_pronostico')} FROM n4""",
    )
)
def water_horizon_alerts(t: Tables) -> DataFrame:
    f = files.saved(water.features(t.dams()), "dam-features")
    target = files.saved(water.targets(f), "dam-targets")
    choice = water.models.chosen(target, water.methods(), "decena_anterior", least=water.LEAST_ROWS)
    band = water.models.bands(target, choice, water.methods())
    out = water.horizon_alerts(water.by_horizon(target, water.newest(f)), choice, band)
    return shown(out.select("presa", "estado", "horizonte", "metodo", "nivel", "pct", "pronostico", "p10", "p90", "prob_40", "hm3_pronostico"))


# Production

LABELLED = """q0 AS (SELECT final AS a, greatest(coalesce(anterior, media_5, acumulada), acumulada) AS p, corte FROM pf WHERE final IS NOT NULL),
qd AS (SELECT corte, row_number() OVER (ORDER BY corte) - 1 AS i, count(*) OVER () AS n FROM (SELECT DISTINCT corte FROM q0)),
qt AS (SELECT * FROM q0 WHERE corte >= (SELECT corte FROM qd WHERE i = least(n - 1, greatest(1, CAST(floor(n * 0.8) AS BIGINT))) AND n >= 5))"""


@query(_sql("ay", ", ".join([REFS, LABELLED]), f"SELECT count(*) AS n, {R('avg(abs(a - p))', 'mae')}, {R('stddev_pop(a - p)', 'desviacion')} FROM qt"))
def production_residuals(t: Tables) -> DataFrame:
    """How far the baseline of production is off on the test part."""
    return shown(production.residual_std(production.labelled(_production(t))))


# Boosted trees; SQL has the search of a split, but not the trees

TREES = {"trees": 10, "rate": 0.3}  # of the registered trainings: the operators' own are 180 at 0.05


def _told(result: models.Trained, names: list[str]) -> DataFrame:
    """n, mae, rmse and mape by horizon and method of a training's back-test, and whether the method was chosen."""
    by = models.metrics(result.tested.where("prueba"), "objetivo", {m: F.col(c) for m, c in names}, ["horizonte"])
    picked = result.choice.select("horizonte", F.col("metodo").alias("elegido"), "motivo")
    return by.join(F.broadcast(picked), "horizonte").withColumn("elegido", F.col("metodo") == F.col("elegido"))  # a row for each horizon


@query()
def boosted_prices(t: Tables) -> DataFrame:
    """The back-test of boosted trees among the methods of prices, for all horizons."""
    w = t.wholesale()
    result = prices.train(prices.features(w, prices.spreads(w, t.retail())), **TREES)
    return shown(_told(result, [*prices.METHODS.items(), ("arboles", "arboles")]))


@query()
def boosted_water(t: Tables) -> DataFrame:
    """The back-test of trees of the level and of the change among the methods of reservoirs, for all horizons."""
    result = water.train(water.features(t.dams(), water.climate_decenas(t.weather())), **TREES)
    return shown(_told(result, [("decena_anterior", "pct"), ("delta_estacional_mediana", "estacional"), *((c.name, c.name) for c in water.TREES)]))


@query()
def trained_production(t: Tables) -> DataFrame:
    """Forecasts by trees or the baseline, whichever wins."""
    out = production.nowcast(_production(t), **TREES)
    return shown(out.select("cultivo", "estado", "anio", "metodo", "motivo", "nivel", "pronostico", "p10", "p90", "caida_10"))


SPLIT_FEATURES = ("l_quantity", "l_discount", "l_tax")


@query(
    """WITH b AS (SELECT l_returnflag AS modelo, l_extendedprice AS y, CAST(l_quantity AS INT) AS l_quantity, CAST(floor(l_discount * 100 + 0.5) AS INT) AS l_discount, CAST(floor(l_tax * 100 + 0.5) AS INT) AS l_tax FROM lineitem),
m AS (SELECT modelo, avg(y) AS base FROM b GROUP BY 1),
h AS (SELECT modelo, columna, corte, sum(base - y) AS g, count(*) AS n FROM (UNPIVOT (SELECT b.modelo, y, base, l_quantity, l_discount, l_tax FROM b JOIN m USING (modelo)) ON l_quantity, l_discount, l_tax INTO NAME columna VALUE corte) GROUP BY ALL),
c AS (SELECT *, sum(g) OVER o AS gl, sum(n) OVER o AS nl, sum(g) OVER a AS ga, sum(n) OVER a AS na FROM h WINDOW o AS (PARTITION BY modelo, columna ORDER BY corte), a AS (PARTITION BY modelo, columna)),
s AS (SELECT *, gl * gl / (nl + 1) + (ga - gl) * (ga - gl) / (na - nl + 1) - ga * ga / (na + 1) AS ganancia FROM c WHERE nl >= 1 AND na - nl >= 1)
SELECT modelo, columna, CAST(corte AS BIGINT) AS corte, """
    + R("ganancia / 1e9", "ganancia")
    + " FROM s QUALIFY row_number() OVER (PARTITION BY modelo, columna ORDER BY ganancia DESC, corte) = 1"
)
def best_splits(t: Tables) -> DataFrame:
    """One level of the trees' split search: of each model and column the best cut of the root, by sums of gradients."""
    own = t.raw("lineitem").select(
        F.col("l_returnflag").alias("modelo"), F.col("l_extendedprice").cast("double").alias("objetivo"), F.col("l_quantity").cast("int").alias("l_quantity"),
        *[F.floor(F.col(c) * 100 + 0.5).cast("int").alias(c) for c in ("l_discount", "l_tax")],
    )
    return shown(trees.root_splits(own, ["modelo"], "objetivo", SPLIT_FEATURES).select("modelo", "columna", "corte", (F.col("ganancia") / 1e9).alias("ganancia")))


# Panels

NOTHING = {c: f"CAST(NULL AS {({'string': 'VARCHAR', 'long': 'BIGINT'}).get(kind, kind.upper())})" for c, kind in master.PANEL.items()}


def _panel_part(table: str, **own: str) -> str:
    kinds = {c: "DOUBLE" for c, kind in master.PANEL.items() if kind == "double"}
    return "SELECT " + ", ".join(f"{f'CAST({own[c]} AS {kinds[c]})' if c in own and c in kinds else own.get(c, nothing)} AS {c}" for c, nothing in NOTHING.items()) + f" FROM {table}"


PANEL_PARTS = " UNION ALL ".join(
    [
        _panel_part("pw", run_date="fecha", canonical_product="cultivo", source="'sniim'", comparison_price_mxn="media", price_basis="'precio_frecuente_mean'", raw_price_mxn="media", unit_label="'kg_calculado'", source_record_count="n", sniim_daily_mean_mxn="media", sniim_daily_median_mxn="mediana", sniim_daily_min_mxn="minimo", sniim_daily_max_mxn="maximo"),
        _panel_part("rd", run_date="fecha", canonical_product="cultivo", source="fuente", comparison_price_mxn="comparable", price_basis="base", raw_price_mxn="comparable", source_record_count="registros"),
        _panel_part("mo", run_date="corte", canonical_product="cultivo", source="'avance_agricola'", price_basis="'contexto_mensual_avance_agricola'", source_record_count="filas", avance_total_superficie_sembrada_ha="sembrada", avance_total_superficie_cosechada_ha="cosechada", avance_total_superficie_siniestrada_ha="siniestrada", avance_total_produccion="produccion", avance_yield_weighted_udm_ha="rendimiento", avance_rows_used="filas", avance_cutoff_date="corte"),
        _panel_part("ky JOIN mu ON ky.anio = mu.anio AND ky.cultivo = mu.cultivo WHERE mu.precio IS NOT NULL", run_date="ky.fecha", canonical_product="ky.cultivo", source="'cierre_agricola'", comparison_price_mxn="mu.precio", price_basis="'pmr_mxn_udm_weighted_by_produccion'", raw_price_mxn="mu.precio", unit_label="mu.unidad", source_record_count="mu.filas", cierre_annual_weighted_pmr_mxn_udm="mu.precio", cierre_rows_used="mu.filas", cierre_total_produccion="mu.produccion"),
    ]
)
PANEL_COLUMNS = ", ".join(R(c) if kind == "double" else c for c, kind in master.PANEL.items())


@query(_sql("wra", WIDE + f", pw AS (SELECT fecha, cultivo, avg(precio) AS media, median(precio) AS mediana, min(precio) AS minimo, max(precio) AS maximo, count(precio) AS n FROM w GROUP BY ALL), pn AS ({PANEL_PARTS})", f"SELECT {PANEL_COLUMNS} FROM pn"))
def master_panel(t: Tables) -> DataFrame:
    """All sources below each other in the 31 columns of the long panel."""
    return shown(master.panel(master.wholesale_daily(t.wholesale()), master.retail_daily(t.retail()), master.monthly(t.progress()), master.annual_prices(_annual_records(t))))


# Reports and series


@query(
    """WITH x AS (SELECT *, count(*) FILTER (l_returnflag = 'R') OVER (PARTITION BY l_orderkey) AS bad FROM lineitem)
SELECT l_orderkey AS page_id, 'entidad' AS nombre, 'E' || l_linenumber AS valor, CAST(NULL AS DOUBLE) AS numero FROM x
UNION ALL SELECT l_orderkey, 'superficie_sembrada_ha', CAST(CAST(floor(l_quantity) AS BIGINT) AS VARCHAR), floor(l_quantity) FROM x
UNION ALL SELECT l_orderkey, 'superficie_cosechada_ha', CAST(l_linenumber AS VARCHAR), CAST(l_linenumber AS DOUBLE) FROM x
UNION ALL SELECT l_orderkey, 'produccion', CASE WHEN l_returnflag = 'R' THEN 's/d' ELSE '1,00' || l_linenumber END, CASE WHEN bad = 0 THEN CAST(1000 + l_linenumber AS DOUBLE) END FROM x"""
)
def report_tables(t: Tables) -> DataFrame:
    """The report of each order, a page with two tables and a header of two lines, as typed cells."""
    line = F.concat(
        F.lit("<tr><td>E"), "l_linenumber", F.lit("</td><td>"), F.floor("l_quantity"), F.lit("</td><td>"), "l_linenumber", F.lit("</td><td>"),
        F.when(F.col("l_returnflag") == "R", "s/d").otherwise(F.concat(F.lit("1,00"), "l_linenumber")), F.lit("</td></tr>"),
    )
    head = '<table><tr><td>aviso</td></tr></table><table><thead><tr><th rowspan="2">Entidad</th><th colspan="2">Superficie (ha)</th><th rowspan=2>Producción</th></tr><tr><th>Sembrada</th><th>Cosechada</th></tr></thead>'
    page = t.raw("lineitem").groupBy(F.col("l_orderkey").alias("page_id")).agg(F.concat(F.lit(head), F.array_join(F.collect_list(line), ""), F.lit("</table>")).alias("html"))  # a few lines an order
    out = pages.numeric_columns(pages.report_table(pages.tables(page), ("entidad", "produccion")))
    return shown(out.select("page_id", F.col("column").alias("nombre"), F.col("value").alias("valor"), F.col("number").alias("numero")))


@query(f"SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS fecha, 'Serie ' || l_returnflag AS serie, CASE l_returnflag WHEN 'A' THEN '$/kg' WHEN 'N' THEN '$/mt' ELSE '' END AS unidad_origen, {R('sum(l_quantity)', 'precio_original')} FROM lineitem GROUP BY ALL")
def month_sheets(t: Tables) -> DataFrame:
    """A sheet with names in its fifth line, units in its sixth and months below."""
    root = files.scratch(t.spark, "sheet")
    months = t.raw("lineitem").groupBy(F.date_format("l_shipdate", "yyyy'M'MM").alias("mes")).pivot("l_returnflag", ["A", "N", "R"]).agg(F.sum("l_quantity"))
    body = months.select(F.lit(9).alias("n"), F.concat_ws(",", "mes", *[F.coalesce(F.concat(F.lit('"'), F.format_number(c, 2), F.lit('"')), F.lit("…")) for c in "ANR"]).alias("value"))
    head = ["Precios", "(mensual)", "nota", "nota", ",Serie A,Serie N,Serie R", ",$/kg,$/mt,"]
    lines = t.spark.createDataFrame(list(enumerate(head)), "n int, value string").union(body)
    lines.orderBy("n", "value").coalesce(1).select("value").write.text(root)  # a row for each month
    return shown(files.headed_series(files.sheets(t.spark, root, "*.txt")).drop("source_file"))


@query(f"SELECT CAST(l_shipdate AS DATE) AS fecha, l_linestatus AS serie, {R('l_quantity', 'precio_original')} FROM lineitem")
def long_series(t: Tables) -> DataFrame:
    """A long table of series, found by its headers."""
    return shown(files.commodity_series(t.raw("lineitem").select(F.date_format("l_shipdate", "yyyy-MM-dd").alias("Time Period"), F.col("l_linestatus").alias("Commodity"), F.col("l_quantity").cast("string").alias("OBS_VALUE"))))


@query(
    """WITH x AS (SELECT p_partkey, p_size AS s, 2000 + p_size % 20 AS anio FROM part WHERE p_partkey % 7 <> 0)
SELECT p_partkey AS consulta, CASE s % 4 WHEN 0 THEN 'serie_presa' WHEN 1 THEN 'presas_estado' ELSE 'presas_periodo' END AS tipo,
CAST(CASE WHEN s % 4 = 0 THEN greatest(anio - 9, 1999) END AS BIGINT) AS desde, CAST(anio + CASE WHEN s % 4 = 3 THEN 2 ELSE 0 END AS BIGINT) AS hasta, CAST(CASE WHEN s % 4 = 3 THEN anio + 2 END AS BIGINT) AS hasta_periodo
FROM x WHERE s % 13 <> 0 AND NOT (s % 4 IN (0, 1) AND s % 5 = 0)"""
)
def dam_request_ranges(t: Tables) -> DataFrame:
    """The good rows of a table of reservoir queries, with the years that they cover."""
    s = F.col("p_size")
    year, k = 2000 + s % 20, s % 4
    name = F.when(s % 5 == 0, " ").otherwise("x")
    asked = t.raw("part").select(
        F.when(F.col("p_partkey") % 7 == 0, "no").otherwise("si").alias("Activo"), F.col("p_partkey").cast("string").alias("query_name"), F.element_at(F.array(*map(F.lit, ("SERIE_PRESA", "presas_estado", "presas_periodo", "presas_periodo"))), k + 1).alias("tipo_consulta"),
        F.when(k == 0, name).alias("id_conagua"), F.when(k == 1, name).alias("Estado"), year.alias("anio"), (s % 13).alias("mes"), F.lit("3").alias("decena"), F.when(k == 3, year + 2).alias("anio_final"),
    )
    good, _ = records.request_ranges(asked)
    return shown(good.select(F.col("consulta").cast("long").alias("consulta"), F.col("tipo_consulta").alias("tipo"), "desde", "hasta", "hasta_periodo"))


# Jobs


@query(f"SELECT CASE WHEN o_orderkey % 2 = 0 THEN DATE '2026-01-01' ELSE DATE '2026-01-02' END AS folder_date, count(*) AS n, {R('sum(o_totalprice)', 'total')} FROM orders GROUP BY 1")
def arriving_files(t: Tables) -> DataFrame:
    """Files of dated folders, read by a stream as they arrive: one folder before its first run, one before its second."""
    root, spark = files.scratch(t.spark, "arriving"), t.spark
    for day in (1, 2):
        t.raw("orders").where(F.col("o_orderkey") % 2 == day - 1).select("o_orderkey", "o_totalprice").write.option("header", True).csv(f"{root}/runs/2026-01-0{day}")
        stream = files.arriving(spark, f"{root}/runs", "o_orderkey long, o_totalprice double", "*.csv").select("folder_date", "o_totalprice")
        stream.writeStream.format("parquet").option("path", f"{root}/table").option("checkpointLocation", f"{root}/check").trigger(availableNow=True).start().awaitTermination()
    return shown(spark.read.parquet(f"{root}/table").groupBy("folder_date").agg(F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("total")))


@query(_sql("dc", "x AS (SELECT 1)", "SELECT 'presas' AS etapa, 'updated' AS estado, (SELECT count(*) FROM d) AS filas UNION ALL SELECT 'clima', 'stale_fallback', (SELECT count(DISTINCT (presa, year(fecha), month(fecha), least(ceil(day(fecha) / 10), 3))) FROM c) UNION ALL SELECT 'riesgo', 'updated', (SELECT count(*) FROM d)"))
def refreshed(t: Tables) -> DataFrame:
    """A second staged run whose climate fails: the first run's climate stands in."""
    root = files.scratch(t.spark, "refresh")

    def climate(done):
        if failing:
            raise ValueError("no weather today")
        return water.climate_decenas(t.weather())

    stages = [refresh.Stage("presas", lambda done: t.dams()), refresh.Stage("clima", climate, stale=True), refresh.Stage("riesgo", lambda done: water.features(done["presas"], done["clima"]).select("presa", "fecha", "pct", "balance"))]
    for version, failing in (("1", False), ("2", True)):
        status = refresh.refresh(t.spark, root, stages, version)
    counts = None
    for stage in stages:
        one = files.published(t.spark, f"{root}/{stage.name}").agg(F.count(F.lit(1)).alias("filas")).select(F.lit(stage.name).alias("etapa"), "filas")
        counts = one if counts is None else counts.union(one)
    return status.join(counts, "etapa").select("etapa", "estado", "filas")


@query("SELECT CAST(v.anio AS BIGINT) AS anio, CASE WHEN v.anio < 1997 THEN 'skipped_existing' WHEN count(o_orderkey) = 0 THEN 'no_rows' WHEN count(*) FILTER (o_orderpriority LIKE '1%') > 0 THEN 'partial_with_errors' ELSE 'success' END AS estado, count(o_orderkey) AS filas FROM (VALUES (1995), (1996), (1997), (1998), (2050)) v(anio) LEFT JOIN orders ON year(o_orderdate) = v.anio GROUP BY v.anio")
def backfilled(t: Tables) -> DataFrame:
    """A second backfill by year: years that the first one brought are left as they are."""
    root = files.scratch(t.spark, "backfill")
    o = t.raw("orders").select("o_orderkey", "o_orderpriority", F.year("o_orderdate").alias("anio"))
    refresh.backfill(o, root, [1995, 1996])
    return shown(refresh.backfill(o, root, [1995, 1996, 1997, 1998, 2050], bad="o_orderpriority like '1%'").drop("errores"))
