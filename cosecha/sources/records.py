"""Typed records of the sources: reservoirs, crop reports, configuration tables, weather and portal payloads."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cosecha.functions import dates, text
from cosecha.operators import rows

# Fields of the reservoir portal and their names here
DAM_FIELDS = {
    "CveCONAGUAPresa": "presa", "nombreOficial": "nombre_oficial", "nombreComun": "nombre_presa", "nombreEstado": "estado", "nombreMpio": "municipio", "nombreUso": "uso_principal",
    "DRiego": "distrito_riego", "LinkPresa": "enlace", "X": "longitud", "Y": "latitud", "anio": "anio", "cveMes": "mes", "cveDecena": "decena", "porcAlmacen": "pct",
    "Almacenamiento": "hm3", "NAME": "name", "NAMO": "namo",
}
DAM_TYPES = {"longitud": "double", "latitud": "double", "anio": "int", "mes": "int", "decena": "int", "pct": "double", "hm3": "double", "name": "double", "namo": "double"}

# Parameters of the daily weather service
WEATHER = {"PRECTOTCORR": "lluvia", "T2M": "temperatura", "T2M_MAX": "maxima", "T2M_MIN": "minima", "EVPTRNS": "evaporacion"}
MISSING = -999.0


def dam_records(payloads: DataFrame, column: str = "json") -> DataFrame:
    """Rows of the portal's JSON records, all of whose fields are texts."""
    schema = ", ".join(f"`{k}` string" for k in DAM_FIELDS)
    r = payloads.select(F.explode(F.from_json(column, f"array<struct<{schema.replace(' string', ': string')}>>")).alias("r"))
    # the decoder is a large expression: all texts of a record go through one, not through one each
    texts = [k for k, n in DAM_FIELDS.items() if n not in DAM_TYPES]
    r = r.select("r", F.transform(F.transform(F.array(*[F.col(f"r.`{k}`") for k in texts]), text.decoded), text.blank_to_null).alias("t"))
    out = r.select(*[text.number(F.col(f"r.`{k}`")).try_cast(DAM_TYPES[n]).alias(n) if n in DAM_TYPES else F.get("t", F.lit(texts.index(k))).alias(n) for k, n in DAM_FIELDS.items()])
    return out.withColumn("fecha", dates.decena_end(F.col("anio"), F.col("mes"), F.col("decena")))


def dam_history(frames: Sequence[DataFrame]) -> DataFrame:
    """One row per reservoir and decena from snapshots and backfills: the row without an extraction time, else the
    latest, wins; rows without id, date or percentage go."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    if "extraido" not in out.columns:
        out = out.withColumn("extraido", F.lit(None).cast("timestamp"))
    out = out.dropna(subset=["presa", "fecha", "pct"])
    return rows.best(out, ["presa", "fecha"], [F.col("extraido").desc_nulls_first(), F.col("pct").desc(), F.col("hm3").desc_nulls_last()])


def weather_rows(payloads: DataFrame, column: str = "json") -> DataFrame:
    """(presa, fecha, lluvia, temperatura, maxima, minima, evaporacion) from payloads of maps of days per parameter;
    days of any parameter count, and the service's mark for missing is null."""
    series = F.from_json(column, "struct<properties: struct<parameter: map<string, map<string, double>>>>")["properties"]["parameter"]
    own = payloads.select("presa", series.alias("m"))
    days = F.array_distinct(F.flatten(F.transform(F.map_values("m"), lambda x: F.map_keys(x))))
    long = own.select("presa", "m", F.explode(days).alias("day"))
    value = lambda p: F.nullif(F.try_element_at(F.try_element_at("m", F.lit(p)), F.col("day")), F.lit(MISSING))
    return long.select("presa", F.try_to_date("day", "yyyyMMdd").alias("fecha"), *[value(p).alias(n) for p, n in WEATHER.items()]).where("fecha is not null")


PROGRESS_ALIASES = {"cultivo": ["cultivo_canonico", "producto_canonico", "avance_crop_name"], "estado": ["entidad"], "anio": ["query_year"], "mes": ["mes_corte", "query_month"], "sembrada": ["superficie_sembrada_ha"], "cosechada": ["superficie_cosechada_ha"], "siniestrada": ["superficie_siniestrada_ha"], "acumulada": ["produccion_acumulada", "produccion"]}
ANNUAL_ALIASES = {"cultivo": ["cultivo_canonico", "producto_canonico", "cierre_crop_name"], "estado": ["entidad"], "anio": ["query_year"], "produccion": ["produccion_final"], "rendimiento": ["rendimiento_final"]}


def _crop_of(c: Column) -> Column:
    """The crop in a row, else in its file's name."""
    return F.coalesce(text.product_or_null(c), F.nullif(text.product_of_name(F.col("source_file")), F.lit("")))


def progress_history(scanned: DataFrame) -> DataFrame:
    """Monthly progress of scanned files, dated by the month's end; the last file wins."""
    types = {"cultivo": "string", "estado": "string", "anio": "int", "mes": "int", "sembrada": "double", "cosechada": "double", "siniestrada": "double", "acumulada": "double", "source_file": "string"}
    out = rows.conform(scanned, PROGRESS_ALIASES, types).withColumn("cultivo", _crop_of(F.col("cultivo")))
    out = out.withColumn("corte", F.last_day(F.try_to_date(F.format_string("%04d-%02d-01", "anio", "mes")))).dropna(subset=["cultivo", "estado", "corte"])
    return rows.best(out, ["cultivo", "estado", "anio", "mes"], [F.col("source_file").desc(), F.col("acumulada").desc_nulls_last(), F.col("sembrada").desc_nulls_last()])


def annual_history(scanned: DataFrame) -> DataFrame:
    """Annual close of scanned files, the year from the row or the file's name; the last file wins."""
    types = {"cultivo": "string", "estado": "string", "anio": "int", "produccion": "double", "rendimiento": "double", "source_file": "string"}
    out = rows.conform(scanned, ANNUAL_ALIASES, types).withColumn("cultivo", _crop_of(F.col("cultivo")))
    out = out.withColumn("anio", F.coalesce("anio", text.year_of_name(F.col("source_file")))).dropna(subset=["cultivo", "estado", "anio"])
    return rows.best(out, ["cultivo", "estado", "anio"], [F.col("source_file").desc(), F.col("produccion").desc_nulls_last()])


def resolved_crops(records: DataFrame, names: DataFrame, name: str, label: str) -> DataFrame:
    """``records`` with the crop of their own, else of their name, else of their label without its unit; ``names`` is a
    table of settings (nombre, cultivo)."""
    lookup = lambda key: F.broadcast(names.select(text.slug(F.col("nombre")).alias(key), F.col("cultivo").alias(f"{key}_crop")).dropDuplicates([key]))
    out = records.withColumns({"__a": text.slug(F.col(name)), "__b": text.slug(text.label_without_unit(F.col(label)))})
    out = out.join(lookup("__a"), "__a", "left").join(lookup("__b"), "__b", "left")
    return out.withColumn("cultivo", F.coalesce("cultivo", "__a_crop", "__b_crop", text.product_of_name(F.col("source_file")))).drop("__a", "__b", "__a_crop", "__b_crop")


def numbers_if_most(df: DataFrame, columns: Sequence[str], share: float = 0.6) -> DataFrame:
    """Columns become numbers if at least ``share`` of their filled cells are; decided in one pass over the table."""
    cell = lambda c: F.nullif(text.blank_to_null(F.col(c)), F.lit("-"))
    found = df.agg(*[F.avg(F.when(cell(c).isNotNull(), text.number(cell(c)).isNotNull().cast("int"))).alias(c) for c in columns]).first()
    return df.withColumns({c: text.number(cell(c)) for c in columns if found[c] is not None and found[c] >= share})


def planting_history(scanned: DataFrame, years: Sequence[int], crops: Mapping[str, str]) -> DataFrame:
    """Sowing and harvest rows of the given years with mapped crops; header rows that pose as states go."""
    missing = {"tipo", "cultivo", "estados", "anio"} - set(scanned.columns)
    if missing:
        raise ValueError(f"missing columns: {sorted(missing)}")
    spark = scanned.sparkSession
    names = F.broadcast(spark.createDataFrame(list(crops.items()), "clave string, canonico string"))
    months = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
    out = scanned.withColumn("clave", text.slug(F.col("cultivo"))).join(names, "clave")
    out = out.where(F.col("anio").try_cast("int").isin(*years) & ~text.slug(F.col("estados")).isin("estados", "estado", "total", "nacional", ""))
    value = lambda c: F.col(c).try_cast("double") if c in scanned.columns else F.lit(None).cast("double")
    return out.select(F.upper(F.trim("tipo")).alias("tipo"), F.col("canonico").alias("cultivo"), F.initcap(F.lower(F.trim("estados"))).alias("estado"), F.col("anio").try_cast("int").alias("anio"), *[value(c).alias(f"m{i:02d}") for i, c in enumerate(months, 1)])


CONFIG_FLAGS = ("activo", "walmart_habilitado", "chedraui_habilitado", "sniim_habilitado", "cierre_agricola_habilitado", "avance_agricola_habilitado")
CONFIG_IDS = {"sniim_id_producto": None, "sniim_id_origen": -1, "sniim_id_destino": -1, "sniim_id_precios_por": 2}


def product_config(table: DataFrame) -> DataFrame:
    """Active products with their flags, search terms as lists and ids with defaults."""
    flags = {c: text.truthy(F.col(c)) if c in table.columns else F.lit(c == "activo") for c in CONFIG_FLAGS}
    terms = {c: text.terms(F.coalesce(c, F.lit(""))) for c in ("terminos_busqueda_walmart", "terminos_busqueda_chedraui") if c in table.columns}
    ids = {c: F.coalesce(F.col(c).try_cast("int"), F.lit(d)) if c in table.columns else F.lit(d).cast("int") for c, d in CONFIG_IDS.items()}
    return table.withColumns({"producto_canonico": text.product_or_null(F.col("producto_canonico"))} | flags | terms | ids).where("activo and producto_canonico is not null")


def query_config(table: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good and bad rows of a table of reservoir queries (anio, mes, decena, activo)."""
    own = table.where(text.truthy(F.col("activo")))
    rules = {"anio": F.col("anio").try_cast("int").between(1990, 2100), "mes": F.col("mes").try_cast("int").between(1, 12), "decena": F.col("decena").try_cast("int").between(1, 3)}
    return rows.checked(own, rules)


# Kinds of reservoir queries, the first year that there is, and the headers of their table
REQUEST_KINDS = ("presas_periodo", "presas_estado", "serie_presa")
FIRST_YEAR, SERIES_YEARS = 1999, 9
REQUEST_ALIASES = {
    "activo": ["active"], "consulta": ["query_name", "nombre_consulta"], "tipo_consulta": ["query_type"], "id_conagua": [], "nombre_oficial": ["dam_name"], "estado": ["state"], "anio": ["year"], "mes": ["month"],
    "decena": ["day_block"], "anio_inicial": ["start_year"], "anio_final": ["end_year"],
}


def request_ranges(table: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows of a table of reservoir queries with the years that they cover (desde, hasta), and bad rows with errors.

    A series of one reservoir needs its id or name and covers ten years unless it says where it begins; a state needs its
    name; a period may go on to a last year (hasta_periodo).  Rows that are not active are in neither.
    """
    years = ("anio", "mes", "decena", "anio_inicial", "anio_final")
    own = rows.conform(table, REQUEST_ALIASES, {c: "int" if c in years else "string" for c in REQUEST_ALIASES})
    kind = F.lower(F.trim("tipo_consulta"))
    own = own.where(text.truthy(F.col("activo"))).withColumns({c: text.blank_to_null(F.col(c)) for c in ("consulta", "id_conagua", "nombre_oficial", "estado")} | {"tipo_consulta": kind, "hasta": F.coalesce("anio_final", "anio")})
    series = F.col("tipo_consulta") == "serie_presa"
    own = own.withColumns({
        "desde": F.when(series & F.col("anio_inicial").isNull(), F.greatest(F.col("hasta") - SERIES_YEARS, F.lit(FIRST_YEAR))).otherwise(F.col("anio_inicial")),
        "hasta_periodo": F.when(F.col("tipo_consulta") == "presas_periodo", F.col("anio_final")),
    })
    rules = {
        "tipo_consulta": F.col("tipo_consulta").isin(*REQUEST_KINDS), "anio": F.col("anio").isNotNull(), "mes": F.col("mes").between(1, 12), "decena": F.col("decena").between(1, 3),
        "anio_final": F.col("hasta_periodo").isNull() | (F.col("hasta_periodo") >= F.col("anio")), "presa": ~series | F.col("id_conagua").isNotNull() | F.col("nombre_oficial").isNotNull(),
        "estado": (F.col("tipo_consulta") != "presas_estado") | F.col("estado").isNotNull(), "anio_inicial": F.col("desde").isNull() | (F.col("desde") <= F.col("hasta")),
    }
    return rows.checked(own, rules)


PROXY_COLUMNS = ("activo", "producto_canonico", "proxy_id", "fuente", "serie", "tipo_proxy", "uso_modelo", "frecuencia", "moneda", "unidad_origen")
# Market reports by product (key, word of the report, strength), the exchange rate and its products, and monthly series
REPORT_PROXIES = (
    ("Aguacate", "aguacate", "avocado", "fuerte"), ("Tomate rojo", "tomate_rojo", "tomato", "fuerte"), ("Limón", "limon", "lime", "fuerte"), ("Mango", "mango", "mango", "fuerte"),
    ("Chile verde", "chile_verde", "pepper", "medio"), ("Cebolla", "cebolla", "onion", "medio"), ("Papa", "papa", "potato", "medio"), ("Zanahoria", "zanahoria", "carrot", "medio"),
)
RATE_PRODUCTS = ("Aguacate", "Tomate rojo", "Limón", "Mango", "Chile verde", "Cebolla", "Papa", "Zanahoria", "Plátano", "Elote")
MONTHLY_PROXIES = (("Elote", "world_bank_maize", "Maize", "medio", "$/mt"), ("Plátano", "world_bank_banana_us", "Banana, US", "medio", "$/kg"), ("Limón", "world_bank_orange", "Orange", "debil", "$/kg"))


def default_proxies(spark: SparkSession) -> DataFrame:
    """The proxies of international prices that hold where nothing is configured."""
    out = [(True, p, f"usda_ams_{k}", "usda_ams", word, kind, "feature", "diaria", "USD", "segun_reporte_usda") for p, k, word, kind in REPORT_PROXIES]
    out += [(True, p, "fx_usdmxn", "fred", "DEXMXUS", "fx", "feature", "diaria", "MXN", "MXN por USD") for p in RATE_PRODUCTS]
    out += [(True, p, key, "world_bank", series, kind, "diagnostico_only", "mensual", "USD", unit) for p, key, series, kind, unit in MONTHLY_PROXIES]
    return spark.createDataFrame(out, "activo boolean, " + ", ".join(f"{c} string" for c in PROXY_COLUMNS[1:]))


def proxy_config(spark: SparkSession, table: DataFrame | None = None) -> DataFrame:
    """The configured proxies in their columns, or the defaults where there is no table or all of it is blank."""
    if table is None:
        return default_proxies(spark)
    own = rows.conform(table, {}, {c: "string" for c in PROXY_COLUMNS})
    own = own.dropna(how="all").withColumn("activo", text.truthy(F.col("activo")))
    return default_proxies(spark) if own.isEmpty() else own


def work_list(config: DataFrame, overrides: Mapping[str, str] | DataFrame, column: str) -> DataFrame:
    """(producto_canonico, consulta): what to ask for each active product; the column of the configuration, else the
    map, else the product itself with blanks.  The map may be a table (producto_canonico, propio)."""
    spark = config.sparkSession
    m = overrides if isinstance(overrides, DataFrame) else F.broadcast(spark.createDataFrame(list(overrides.items()), "producto_canonico string, propio string"))
    out = product_config(config).join(m, "producto_canonico", "left")
    return out.select("producto_canonico", F.coalesce(text.blank_to_null(F.col(column)), "propio", F.replace("producto_canonico", F.lit("_"), F.lit(" "))).alias("consulta"))


def dataset(spark: SparkSession, root: str, names: Sequence[str], aliases: Sequence[str]) -> DataFrame:
    """The dataset among the folders ``names`` of ``root`` whose slug is an alias, in the order of the aliases, else the
    first folder."""
    import re

    key = lambda n: re.sub("[^a-z0-9]+", "_", n.lower()).strip("_")
    by_key = {key(n): n for n in reversed(names)}
    chosen = next((by_key[key(a)] for a in aliases if key(a) in by_key), names[0])
    return spark.read.parquet(f"{root}/{chosen}")


def profile(df: DataFrame, identity: str, date: str, error: Column) -> DataFrame:
    """One row: rows, distinct ids, rows with errors, first and last date."""
    return df.agg(F.count(F.lit(1)).alias("filas"), F.count_distinct(identity).alias("ids"), F.count_if(error).alias("errores"), F.min(date).alias("desde"), F.max(date).alias("hasta"))


def write_run(good: DataFrame, bad: DataFrame, meta: DataFrame, root: str, run_date: str, source: str) -> None:
    """Data, errors and metadata of a run of a source; repeating the run replaces its own partitions only."""
    for name, df in (("data", good), ("errors", bad), ("metadata", meta)):
        out = df.withColumns({"run_date": F.lit(run_date), "source": F.lit(source)})
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_date", "source").parquet(f"{root}/{name}")
