"""Registered queries of orders, catalogues kept up, failures, streams, reports and readers, with their DuckDB SQL."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cosecha.functions import dates, text
from cosecha.operators import orders, rows
from cosecha.plans import catalog, international, master, pages, prices, production, retail, run, water
from cosecha.queries import (
    CAST, CLIMATE, FEATURES, NATION, NESTED, PIVOT, PROXY_IDS, SPREADS, VALUES, WEEKLY, I, R, Rs, _annual_records, _history, _nested_offers, _production, _sql, _values, query, shown,
)
from cosecha.row_queries import ALL_HORIZONS, _alerts
from cosecha.sources import files, records
from cosecha.sources.driver import Tables
from cosecha.streaming import buckets

# Total orders


@query("SELECT o_orderkey, CAST(o_orderdate AS DATE) AS fecha, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS numero FROM orders")
def numbered_orders(t: Tables) -> DataFrame:
    """The place of each row in a total order, without a window over all rows."""
    o = t.raw("orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("fecha"))
    return orders.numbered(o, [F.col("fecha"), F.col("o_orderkey")])


@query("SELECT l_suppkey % 5 AS cultivo, CAST(year(l_shipdate) AS BIGINT) AS anio, l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_suppkey % 5, year(l_shipdate) ORDER BY l_orderkey, l_linenumber) AS renglon FROM lineitem")
def numbered_history(t: Tables) -> DataFrame:
    """Row numbers from 1 in each file of a crop and year; one crop and year may have most of the rows."""
    own = t.raw("lineitem").select((F.col("l_suppkey") % 5).alias("cultivo"), F.year("l_shipdate").alias("anio"), "l_orderkey", "l_linenumber")
    return shown(orders.numbered(own, [F.col("l_orderkey"), F.col("l_linenumber")], "renglon", ["cultivo", "anio"]))


@query(_sql("wr", SPREADS + ", " + """lo AS (SELECT fecha, cultivo, 'uno' AS fuente, spread_uno AS spread FROM sp UNION ALL SELECT fecha, cultivo, 'dos', spread_dos FROM sp),
k1 AS (SELECT cultivo, fuente, median(spread) AS med, stddev_samp(spread) AS sd FROM lo WHERE spread IS NOT NULL GROUP BY ALL),
k2 AS (SELECT cultivo, fuente, median(abs(spread - med)) AS mad FROM lo JOIN k1 USING (cultivo, fuente) WHERE spread IS NOT NULL GROUP BY ALL),
zz AS (SELECT cultivo, fuente, fecha, 0.6745 * (spread - med) / CASE WHEN mad > 0 THEN mad ELSE nullif(sd, 0) END AS z FROM lo JOIN k1 USING (cultivo, fuente) JOIN k2 USING (cultivo, fuente) WHERE spread IS NOT NULL)""",
    "SELECT cultivo, fuente, fecha, row_number() OVER (ORDER BY floor(abs(z) * 1e9) DESC NULLS LAST, cultivo, fuente, fecha) AS puesto FROM zz"))
def ranked_anomalies(t: Tables) -> DataFrame:
    """Spread anomalies by their score, the largest first."""
    found = prices.anomalies(prices.spreads(t.wholesale(), t.retail()))
    order = [F.floor(F.abs("robust_z") * 1e9).desc_nulls_last(), F.col("cultivo"), F.col("fuente"), F.col("fecha")]
    return shown(orders.numbered(found, order, "puesto").select("cultivo", "fuente", "fecha", "puesto"))


@query(_sql("a", "x AS (SELECT *, row_number() OVER (PARTITION BY cultivo, estado, anio ORDER BY corte DESC) AS k FROM a)", f"SELECT cultivo, estado, {I('anio')}, {Rs('acumulada')} FROM x WHERE k = 1 ORDER BY x.acumulada DESC NULLS LAST, cultivo, estado, x.anio LIMIT 20"))
def top_volume(t: Tables) -> DataFrame:
    """The twenty largest productions at their last cut: the limit is the feature."""
    last = rows.latest(t.progress(), [*production.KEYS, "anio"], "corte")
    return shown(production.top_volume(last, "acumulada").select("cultivo", "estado", "anio", "acumulada"))


# A catalogue that is kept up


@query(_sql("d", "x AS (SELECT 1)", "SELECT presa, count(DISTINCT anio * 1000 + mes * 10 + decena) AS periodos, CAST(min(anio * 1000 + mes * 10 + decena) AS BIGINT) AS primero, CAST(max(anio * 1000 + mes * 10 + decena) AS BIGINT) AS ultimo, max_by(estado, anio * 1000 + mes * 10 + decena) AS estado FROM d GROUP BY presa"))
def kept_catalogue(t: Tables) -> DataFrame:
    """The catalogue after four snapshots that overlap, each merged into the ones before by its bitmaps."""
    d, kept = t.dams(), None
    for years in ((1992, 1994), (1994, 1996), (1996, 1997), (1997, 9999)):
        new = catalog.snapshot(d.where(F.col("anio").between(*years)))
        kept = files.saved(new if kept is None else catalog.merged(kept.union(new)), "snapshots")
    return shown(catalog.of_snapshots(kept))


@query("SELECT CASE WHEN o_orderkey % 3 = 0 THEN 'a' ELSE 'b' END AS grupo, CAST(count(*) AS BIGINT) AS total, count(*) FILTER (o_orderstatus = 'F') AS bien, count(*) FILTER (o_orderstatus = 'O') AS mal, CASE WHEN count(*) FILTER (o_orderstatus = 'O') = 0 THEN 'success' WHEN count(*) FILTER (o_orderstatus = 'F') = 0 THEN 'failed' ELSE 'partial' END AS resultado FROM orders GROUP BY 1")
def run_summaries(t: Tables) -> DataFrame:
    state = F.when(F.col("o_orderstatus") == "F", "ok").when(F.col("o_orderstatus") == "O", "error").otherwise("omitida")
    return catalog.run_summary(t.raw("orders").select(F.when(F.col("o_orderkey") % 3 == 0, "a").otherwise("b").alias("grupo"), state.alias("estado")))


# Sinks, facts and failures


@query(_sql("d", "x AS (SELECT 1)", "SELECT count(*) AS filas, count(*) FILTER (pct > 60) AS errores, min(fecha) AS fecha_min, max(fecha) AS fecha_max, count(DISTINCT estado) AS distintos_estado FROM d"))
def dam_facts(t: Tables) -> DataFrame:
    """The profile of a table from the facts that were observed while its two parts were written."""
    root, d = files.scratch(t.spark, "parts"), t.dams()
    for name, part in (("a", d.where("anio < 1995")), ("b", d.where("anio >= 1995 or anio is null"))):
        files.write_table(part, f"{root}/{name}", "fecha", ["estado"], errors=F.col("pct") > 60)
    return files.table_facts(t.spark, [f"{root}/a", f"{root}/b"])


@query("""SELECT 'buena' AS clase, NULL AS error, count(*) AS n, CAST(sum(o_custkey) AS BIGINT) AS suma FROM orders WHERE o_orderkey % 7 <> 0
UNION ALL SELECT 'mala', 'registro', count(*), NULL FROM orders WHERE o_orderkey % 7 = 0 HAVING count(*) > 0
UNION ALL SELECT 'mala', 'codificacion', 1, NULL UNION ALL SELECT 'mala', 'vacio', 1, NULL""")
def file_failures(t: Tables) -> DataFrame:
    """Good rows and errors of a folder with cut lines, a file in another encoding and an empty one."""
    root = files.scratch(t.spark, "failing")
    o = t.raw("orders")
    whole = F.concat_ws(",", "o_orderkey", "o_custkey", F.date_format("o_orderdate", "yyyy-MM-dd"))
    line = F.when(F.col("o_orderkey") % 7 == 0, F.concat("o_orderkey", F.lit(",x"))).otherwise(whole)
    o.select(line.alias("value"), (F.col("o_orderkey") % 2).alias("parte")).write.partitionBy("parte").text(f"{root}/lines")  # an empty task writes no file then
    t.spark.range(0, 1, 1, 1).select(F.lit("9,").alias("value"), F.unhex(F.lit("F1")).alias("b")).select(F.concat(F.col("value").cast("binary"), "b").cast("string").alias("value")).write.text(f"{root}/latin")
    t.spark.range(0, 0, 1, 1).select(F.lit("").alias("value")).coalesce(1).write.text(f"{root}/empty")
    good, bad = files.read_lines(t.spark, root, "o_orderkey long, o_custkey long, fecha date", "*.txt")
    out = good.agg(F.count(F.lit(1)).alias("n"), F.sum("o_custkey").alias("suma")).select(F.lit("buena").alias("clase"), F.lit(None).cast("string").alias("error"), "n", "suma")
    return out.union(bad.groupBy("error").agg(F.count(F.lit(1)).alias("n")).select(F.lit("mala"), "error", "n", F.lit(None).cast("bigint")))


@query("SELECT CASE WHEN l_quantity >= 5 THEN 'data' ELSE 'errors' END AS tabla, count(*) AS n, '2026-05-01' AS run_date, 'uno' AS source FROM lineitem GROUP BY 1 UNION ALL SELECT 'metadata', count(*), '2026-05-01', 'uno' FROM region")
def source_runs(t: Tables) -> DataFrame:
    """Data, errors and metadata of a run, written twice, read back by run and source."""
    root = files.scratch(t.spark, "runs")
    good, bad = rows.checked(t.raw("lineitem").select("l_orderkey", "l_quantity"), {"poca": F.col("l_quantity") >= 5})
    for _ in range(2):
        records.write_run(good, bad, t.raw("region"), root, "2026-05-01", "uno")
    read = [t.spark.read.parquet(f"{root}/{n}").groupBy(F.col("run_date").cast("string").alias("run_date"), "source").agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("tabla"), "n", "run_date", "source") for n in ("data", "errors", "metadata")]
    return files.union(read)


# Streams

CLOSED = """e AS (SELECT event_type, CAST(ts AS DATE) AS dia, value, {0} AS fin, ts FROM events),
g AS (SELECT event_type, fin, count(*) AS n, sum(value) AS suma, min(value) AS minimo, max(value) AS maximo FROM e GROUP BY ALL)"""
DECENA = "CASE WHEN day(ts) <= 10 THEN make_date(year(ts), month(ts), 10) WHEN day(ts) <= 20 THEN make_date(year(ts), month(ts), 20) ELSE last_day(CAST(ts AS DATE)) END"
WEEK = "CAST(date_trunc('week', ts) AS DATE) + 6"


def _closed(kind: str, t: Tables) -> DataFrame:
    """Closed buckets of the events as they arrive, in a stream over the table's folder."""
    spark, root = t.spark, files.scratch(t.spark, f"stream-{kind}")
    e = t.raw("events").select("ts", "event_type", "value")
    e.write.parquet(f"{root}/in")
    stream = spark.readStream.schema(e.schema).parquet(f"{root}/in")
    buckets.run_to(buckets.streamed(stream, kind), f"{root}/out", f"{root}/checkpoint")
    return shown(spark.read.schema(buckets.SUMS).parquet(f"{root}/out"))


def _closed_sql(fin: str) -> str:
    return f"WITH {CLOSED.format(fin)} SELECT event_type, fin, n, {Rs('suma', 'minimo', 'maximo')} FROM g WHERE CAST(fin + 1 AS TIMESTAMP) <= (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 10 DAY FROM events)"


@query(_closed_sql(DECENA))
def streamed_decenas(t: Tables) -> DataFrame:
    return _closed("decena", t)


@query(_closed_sql(WEEK))
def streamed_weeks(t: Tables) -> DataFrame:
    return _closed("semana", t)


# Reports

CARDS = """lw AS (SELECT * FROM wk QUALIFY row_number() OVER (PARTITION BY cultivo ORDER BY semana DESC) = 1),
kc AS (SELECT cultivo, upper(cultivo[1]) || lower(replace(cultivo, '_', ' ')[2:]) AS etiqueta, strftime(semana, '%d/%m/%Y') || ' a ' || strftime(semana + 6, '%d/%m/%Y') AS semana,
coalesce('$' || format('{:,.2f}', mediana) || '/kg', 's/d') AS precio_mercados, coalesce('$' || format('{:,.2f}', precio_uno) || '/kg', 's/d') AS precio_uno, coalesce('$' || format('{:,.2f}', precio_dos) || '/kg', 's/d') AS precio_dos,
coalesce(printf('%+.1f%%', cambio * 100), 's/d') AS cambio_mercados, coalesce(printf('%+.1f%%', cambio_uno * 100), 's/d') AS cambio_uno, coalesce(printf('%+.1f%%', cambio_dos * 100), 's/d') AS cambio_dos,
coalesce(printf('%+.1f%%', spread_uno * 100), 's/d') AS spread_uno, coalesce(printf('%+.1f%%', spread_dos * 100), 's/d') AS spread_dos, coalesce(CAST(mercados AS VARCHAR), 's/d') AS mercados_cubiertos FROM lw)"""
CARD_NAMES = ("precio_mercados", "precio_uno", "precio_dos", "cambio_mercados", "cambio_uno", "cambio_dos", "spread_uno", "spread_dos", "mercados_cubiertos")


@query(_sql("wr", SPREADS + ", " + WEEKLY + ", " + CARDS, "SELECT * FROM kc"))
def weekly_cards(t: Tables) -> DataFrame:
    """The nine cards of each crop's newest week, read back from the report's JSON."""
    w = t.wholesale()
    payload = run.report(prices.weekly(w, prices.spreads(w, t.retail())))
    kinds = f"struct<cultivo:string,etiqueta:string,semana:string,tarjetas:struct<{','.join(f'{c}:string' for c in CARD_NAMES)}>>"
    one = payload.select(F.explode(F.from_json("reporte", f"struct<por_omision:string,cultivos:map<string,{kinds}>>")["cultivos"]).alias("k", "v"))
    return one.select("v.cultivo", "v.etiqueta", "v.semana", "v.tarjetas.*")


@query(_sql("wra", "x AS (SELECT 1)", "SELECT cultivo, mes FROM (SELECT DISTINCT cultivo, CAST(date_trunc('month', fecha) AS DATE) AS mes FROM w WHERE precio IS NOT NULL) EXCEPT SELECT cultivo, CAST(date_trunc('month', corte) AS DATE) FROM a WHERE cultivo <> 'ECONOMY'"))
def months_without_context(t: Tables) -> DataFrame:
    """Months of a crop with prices, but without a report of its progress."""
    priced = t.wholesale().where("precio is not null").select("cultivo", "fecha")
    return master.months_without(priced, t.progress().where("cultivo <> 'ECONOMY'"), "corte")


# Windows, periods and work


@query(_sql("cd", CLIMATE, "SELECT greatest(DATE '1994-03-01', greatest((SELECT max(fecha) FROM cl) - 40, (SELECT min(fecha) FROM d))) AS desde, DATE '2003-12-31' AS hasta"))
def climate_window(t: Tables) -> DataFrame:
    """From where to where climate is to be loaded on top of what there is."""
    first, last = water.load_window(t.dams(), dt.date(2003, 12, 31), dt.date(1994, 3, 1), water.climate_decenas(t.weather()))
    return t.spark.range(1).select(F.lit(first).alias("desde"), F.lit(last).alias("hasta"))


@query("SELECT o_orderkey, CAST(year(o_orderdate) AS BIGINT) AS anio, CAST(month(o_orderdate) AS BIGINT) AS mes, CAST(least(ceil(day(o_orderdate) / 10), 3) AS BIGINT) AS decena FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-02-11' AND DATE '1996-02-20'")
def orders_of_period(t: Tables) -> DataFrame:
    """The rows of the decena that a date asks for."""
    year, month, decena = dates.target_period(dt.date(1996, 2, 14))
    d = F.col("o_orderdate").cast("date")
    own = t.raw("orders").select("o_orderkey", F.year(d).alias("anio"), F.month(d).alias("mes"), dates.decena_of(d).alias("decena"))
    return shown(own.where((F.col("anio") == year) & (F.col("mes") == month) & (F.col("decena") == decena)))


@query("""SELECT fuente, count(*) AS n, CAST(sum(floor(precio * 100 + 0.5)) AS BIGINT) AS centavos FROM (
SELECT CASE o_orderkey % 4 WHEN 0 THEN 'world_bank' WHEN 1 THEN 'fred' WHEN 2 THEN 'imf' ELSE 'usda_ams' END AS fuente, o_totalprice AS precio FROM orders WHERE o_orderkey % 5 <> 0 AND o_orderkey % 11 <> 0) GROUP BY 1""")
def public_prices(t: Tables) -> DataFrame:
    """Four sources below each other, with texts for dates and prices, without the rows that lack one."""
    k = F.col("o_orderkey")
    o = t.raw("orders").select(
        k, F.when(k % 5 == 0, "no date").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("fecha"), F.when(k % 11 == 0, F.lit("n/a")).otherwise(F.col("o_totalprice").cast("decimal(18,2)").cast("string")).alias("precio_original"), F.lit("x").alias("serie")
    )
    parts = {name: o.where(k % 4 == i).drop("o_orderkey", *(["extra"] if i else [])) for i, name in enumerate(("world_bank", "fred", "imf", "usda_ams"))}
    found = files.public_prices(parts)
    return found.groupBy("fuente").agg(F.count(F.lit(1)).alias("n"), F.sum(F.floor(F.col("precio_original") * 100 + 0.5)).cast("bigint").alias("centavos"))


@query("SELECT p_partkey, CAST(CASE WHEN p_size % 5 = 0 THEN 0 ELSE -1 END AS BIGINT) AS origen, 2 AS precios_por, CASE WHEN p_size % 2 = 0 THEN 2 ELSE 0 END AS terminos FROM part WHERE p_size % 3 <> 0")
def configured_products(t: Tables) -> DataFrame:
    """Active products with the defaults of their ids and their search terms."""
    s = F.col("p_size")
    table = t.raw("part").select(
        "p_partkey", F.col("p_name").alias("producto_canonico"), F.when(s % 3 == 0, "no").otherwise("si").alias("activo"), F.when(s % 5 == 0, "0").otherwise("-").alias("sniim_id_origen"),
        F.when(s % 2 == 0, "uno | dos").otherwise(" | ").alias("terminos_busqueda_walmart"),
    )
    out = records.product_config(table)
    return shown(out.select("p_partkey", F.col("sniim_id_origen").alias("origen"), F.col("sniim_id_precios_por").alias("precios_por"), F.size("terminos_busqueda_walmart").alias("terminos")))


@query("SELECT tipo, CAST(anio AS BIGINT) AS anio, count(*) AS n FROM (SELECT CASE WHEN l_returnflag = 'A' THEN 'SIEMBRA' ELSE 'COSECHA' END AS tipo, CAST(year(l_shipdate) AS INTEGER) AS anio, p_type, p_brand, l_linenumber FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_brand <> (SELECT min(p_brand) FROM part) AND p_type <> 'ECONOMY' GROUP BY ALL) WHERE anio IN (1995, 1996) GROUP BY ALL")
def planting_files(t: Tables) -> DataFrame:
    """Rows of two years with known crops, without headers that pose as states."""
    first = t.raw("part").agg(F.min("p_brand").alias("b"))
    h = _history(t).crossJoin(F.broadcast(first))  # one row
    own = h.select("tipo", F.lower("cultivo").alias("cultivo"), F.when(F.col("estado") == F.col("b"), " Estados").otherwise(F.col("estado")).alias("estados"), F.col("anio").cast("string").alias("anio"))
    crops = {c: c for c in ("promo", "standard", "small", "medium", "large")}
    return shown(records.planting_history(own, [1995, 1996], crops).groupBy("tipo", "anio").agg(F.count(F.lit(1)).alias("n")))


@query("SELECT o_orderkey FROM orders WHERE o_orderkey % 6 NOT IN (0, 1)")
def rows_without_markers(t: Tables) -> DataFrame:
    """Rows without those that only name a category, or are blank."""
    k = F.col("o_orderkey") % 6
    cell = lambda other: F.when(k == 0, "Frutas").when(k == 1, " ").when(k == 2, "Frutas" if other else "x").otherwise(F.col("o_orderstatus"))
    own = t.raw("orders").select("o_orderkey", cell(True).alias("a"), cell(False).alias("b"))
    return rows.without_markers(own, ["a", "b"], ["Frutas", "Hortalizas"]).select("o_orderkey")


@query("SELECT CAST(p_size % 4 AS BIGINT) AS tabla, count(*) AS n FROM part WHERE p_size % 4 = 2 GROUP BY 1")
def aliased_table(t: Tables) -> DataFrame:
    """The table among several whose name is an alias."""
    root, p = files.scratch(t.spark, "tables"), t.raw("part").select("p_partkey", (F.col("p_size") % 4).alias("tabla"))
    names = ["Hoja 1", "Otra", "Productos Activos", "Notas"]
    for i, name in enumerate(names):
        p.where(F.col("tabla") == i).write.parquet(f"{root}/{name}")
    return shown(records.dataset(t.spark, root, names, ["catalogo", "productos_activos"]).groupBy("tabla").agg(F.count(F.lit(1)).alias("n")))


@query("SELECT CAST(o_custkey % 3 AS BIGINT) AS producto, CAST(year(o_orderdate) AS BIGINT) AS anio, count(*) AS n FROM orders GROUP BY ALL")
def latest_exports(t: Tables) -> DataFrame:
    """Of the files of one product and year the rows of the newest only: an older export of half the rows lies beside it."""
    root = files.scratch(t.spark, "exports")
    o = t.raw("orders").select((F.col("o_custkey") % 3).cast("string").alias("producto"), F.year("o_orderdate").cast("string").alias("anio"), "o_orderkey")
    o.where("o_orderkey % 2 = 0").coalesce(1).write.option("header", True).csv(f"{root}/2026-01-01")
    o.coalesce(1).write.option("header", True).csv(f"{root}/2026-01-02")
    scanned = files.scan(t.spark, root, "*.csv")
    newest = files.latest_exports(scanned, F.col("producto"), F.col("anio"), F.lit(1))
    return newest.groupBy(F.col("producto").cast("bigint").alias("producto"), F.col("anio").cast("bigint").alias("anio")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, CASE WHEN l_linenumber % 3 <> 1 THEN CASE l_linenumber % 3 WHEN 0 THEN floor(l_quantity / 1000 * 10000 + 0.500001) / 10000 ELSE l_quantity END END AS kg, l_linenumber % 2 = 0 AS papa_suelta FROM lineitem")
def title_weights(t: Tables) -> DataFrame:
    """Weights in titles by both forms that count, and a crop by the rules that look inside words."""
    n, q = F.col("l_linenumber"), F.col("l_quantity").cast("int").cast("string")
    title = F.concat(F.when(n % 2 == 0, "Papaya ").otherwise("Melón "), F.when(n % 3 == 0, F.concat(q, F.lit(" GRS"))).when(n % 3 == 1, F.concat(q, F.lit(" kilos"))).otherwise(F.concat(q, F.lit(" kg"))))
    own = t.raw("lineitem").select("l_orderkey", "l_linenumber", text.weight_kg(title).alias("kg"), F.coalesce(text.crop(title, text.CROP_PARTS) == "papa", F.lit(False)).alias("papa_suelta"))
    return shown(own)


@query("""SELECT p_partkey, 'Piñ' || chr(241) || '… & ' || p_name || ' <' || p_size || '>' AS limpio, 'a &amp; b' AS una_vez, 'añejo ' || p_brand || ' €' AS reparado, 'Año ' || p_brand AS sano FROM part""")
def decoded_texts(t: Tables) -> DataFrame:
    """References of all kinds, resolved once, and texts whose bytes were read in the wrong encoding."""
    refs = F.concat(F.lit(" Pi&ntilde;&#241;&hellip; &amp; "), "p_name", F.lit(" &lt;"), "p_size", F.lit("&#x3E; "))
    wrong = F.concat(F.lit("aÃ±ejo "), "p_brand", F.lit(" â‚¬"))
    return t.raw("part").select("p_partkey", text.decoded(refs).alias("limpio"), text.decoded(F.lit("a &amp;amp; b")).alias("una_vez"), text.repaired(wrong).alias("reparado"), text.repaired(F.concat(F.lit("Año "), "p_brand")).alias("sano"))


# Offers, pages and provenance


@query(f"""WITH {NESTED} SELECT page_id, 'https://tienda.mx/frutas' AS pagina, 'q' || page_id % 4 AS consulta, nombre AS producto_crudo, 'c' || page_id % 3 AS producto, CAST(NULL AS VARCHAR) AS inferido, unidad, antes IS NOT NULL AS promocion, fresco, {Rs('precio', 'antes', 'precio_kg')} FROM ko""")
def offer_records(t: Tables) -> DataFrame:
    """Offers with what their pages were fetched for."""
    found = _nested_offers(t).withColumn("cultivo", F.lit(None).cast("string"))
    asked = t.raw("part").select(F.col("p_partkey").alias("page_id"), F.concat(F.lit("c"), F.col("p_partkey") % 3).alias("cultivo_pedido"), F.concat(F.lit("q"), F.col("p_partkey") % 4).alias("consulta"))
    out = retail.records(found, asked, "https://tienda.mx", "https://tienda.mx/frutas")
    return shown(out.select("page_id", "pagina", "consulta", "producto_crudo", "producto", "inferido", "unidad", "promocion", "fresco", "precio", "antes", "precio_kg"))


@query(f"""WITH {NESTED}, rk AS (SELECT page_id % 3 AS producto, nombre, fresco, precio, precio_kg, page_id FROM ko)
SELECT CAST(producto AS BIGINT) AS producto, page_id, {R('precio')} FROM rk QUALIFY row_number() OVER (PARTITION BY producto, lower(nombre), rk.precio ORDER BY fresco DESC, precio_kg ASC NULLS LAST, page_id) = 1""")
def unique_offers(t: Tables) -> DataFrame:
    """One of the offers with one product, name and price."""
    own = _nested_offers(t).select("page_id", (F.col("page_id") % 3).alias("producto"), F.col("nombre").alias("producto_crudo"), "fresco", "precio", "precio_kg")
    return shown(retail.unique_offers(own).select("producto", "page_id", "precio"))


@query("SELECT p_partkey AS page_id, CASE p_size % 5 WHEN 0 THEN 'bloqueada' WHEN 1 THEN 'sin_registros' ELSE 'contenido' END AS clase, CASE WHEN p_size % 5 IN (2, 3) THEN p_name END AS producto FROM part")
def report_pages(t: Tables) -> DataFrame:
    """Blocked pages, pages without records, and the product of report pages of both forms."""
    k, name = F.col("p_size") % 5, F.col("p_name")
    labelled = F.concat(F.lit('<table><tr><td>Producto</td><td>Calidad</td></tr><tr><td class="DatTAB2">&nbsp;&nbsp;<b>'), name, F.lit("</b></td></tr></table>"))
    below = F.concat(F.lit("<table><tr><th>Fecha</th></tr><tr><th> Producto </th><th>x</th></tr><tr><td> </td><td>"), name, F.lit("</td></tr></table>"))
    html = F.when(k == 0, "<p>Verifica tu identidad</p><p>di que no eres un robot</p>").when(k == 1, "<p>No existen registros</p>").when(k == 2, labelled).when(k == 3, below).otherwise("<p>x</p>")
    return pages.classified(t.raw("part").select(F.col("p_partkey").alias("page_id"), html.alias("html"), F.lit("https://a.mx/x").alias("url"))).select("page_id", "clase", "producto")


@query(_sql("ra", "x AS (SELECT 1)", """SELECT 'menudeo' AS tabla, CAST(count(*) AS BIGINT) AS filas, CAST(count(source_page) AS BIGINT) AS paginas, min(source_page) AS primera, min(terminos) AS terminos FROM (
SELECT fecha, cultivo, fuente, min('https://tienda.mx/' || cultivo) AS source_page, CASE WHEN count(DISTINCT fecha % 2) = 1 THEN 'x' END AS nada, string_agg(DISTINCT 'q' || fuente, ' | ') AS terminos FROM (SELECT cultivo, fuente, fecha - DATE '1990-01-01' AS fecha FROM r) GROUP BY ALL)
UNION ALL SELECT 'avance', count(DISTINCT (cultivo, anio, mes)), count(DISTINCT (cultivo, anio, mes)), 'ton', min('Corte ' || anio) FROM a"""))
def panel_provenance(t: Tables) -> DataFrame:
    """What the long panel keeps of pages, queries, labels and units."""
    shops = t.retail().withColumns({"pagina": F.concat(F.lit("https://tienda.mx/"), "cultivo"), "consulta": F.concat(F.lit("q"), "fuente")})
    month = t.progress().withColumns({"etiqueta_corte": F.concat(F.lit("Corte "), "anio"), "unidad": F.lit("ton"), "nombre_cultivo": F.initcap(F.lower("cultivo"))})
    long = master.panel(master.wholesale_daily(t.wholesale()), master.retail_daily(shops), master.monthly(month), master.annual_prices(_annual_records(t)))
    count = lambda c: F.count(c).alias("paginas")
    a = long.where("source in ('uno', 'dos')").agg(F.count(F.lit(1)).alias("filas"), count("source_page"), F.min("source_page").alias("primera"), F.min("search_terms_used").alias("terminos"))
    b = long.where("source = 'avance_agricola'").agg(F.count(F.lit(1)).alias("filas"), count("avance_crop_name"), F.min("unit_label").alias("primera"), F.min("avance_report_cutoff_label").alias("terminos"))
    return a.select(F.lit("menudeo").alias("tabla"), "*").union(b.select(F.lit("avance"), "*"))


# Prices with all that is known on their day


@query(
    _sql(
        "wrday",
        ", ".join([FEATURES, SPREADS, NATION, CAST.removeprefix(", "), VALUES, f"wi AS ({PIVOT})"])
        + """, c1 AS (SELECT cultivo, sum(pronostico) AS produccion, max(caida_10) AS caida FROM p3 GROUP BY 1),
f1 AS (SELECT fx.*, spread_uno, spread_dos FROM fx LEFT JOIN sp USING (fecha, cultivo)),
f2 AS (SELECT f1.*, CASE WHEN f1.fecha - na.fecha <= 45 THEN agua END AS agua FROM f1 ASOF LEFT JOIN na ON f1.fecha >= na.fecha),
f3 AS (SELECT f2.*, produccion, caida FROM f2 LEFT JOIN c1 USING (cultivo))""",
        f"SELECT f3.cultivo, mercado, f3.fecha, disponible, {Rs('precio', 'lag_7', 'spread_uno', 'agua', 'produccion', 'caida', 'p_low_z')} FROM f3 ASOF LEFT JOIN wi ON f3.cultivo = wi.producto AND f3.fecha >= wi.disponible",
    )
)
def price_context(t: Tables) -> DataFrame:
    """The features of prices with spreads, water, production and proxies, as the trainer gets them."""
    w = t.wholesale()
    price = prices.features(w, prices.spreads(w, t.retail()))
    price = water.on_prices(price, water.national(water.states(t.dams())))
    price = price.join(run.product_context(production.forecast(_production(t))), "cultivo", "left")
    price = international.on_prices(price, international.pivoted(international.eligible(_values(t)), PROXY_IDS))
    return shown(price.select("cultivo", "mercado", "fecha", "disponible", "precio", "lag_7", "spread_uno", "agua", F.col("produccion_pronosticada").alias("produccion"), F.col("caida_10").alias("caida"), "p_low_z"))


@query(_sql("w", ALL_HORIZONS, f"SELECT {I('horizonte')}, cultivo, mercado, {Rs('prob_10')} FROM ha ORDER BY ha.prob_10 DESC NULLS LAST, ha.horizonte, cultivo, mercado LIMIT 15"))
def top_alerts_overall(t: Tables) -> DataFrame:
    """The fifteen likeliest rises of all horizons: the limit is the feature."""
    return shown(prices.top_overall(_alerts(t)).select("horizonte", "cultivo", "mercado", "prob_10"))
