"""Scans of folder trees of dated files, and the sinks.

Files are CSV, JSON or Parquet; every reader keeps the file's path, folder date and modification time as columns, so
what a name tells is a column expression and Spark prunes and distributes the rest.
"""

from __future__ import annotations

import fnmatch
import tempfile
import uuid
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cosecha.functions import dates, text
from cosecha.operators import rows

META = ("source_file", "folder_date", "modified_at")


def scan(spark: SparkSession, root: str, glob: str = "*", fmt: str = "csv", **options) -> DataFrame:
    """All files under ``root`` whose names fit, as text columns, with META; unreadable files are skipped."""
    reader = spark.read.format(fmt).option("recursiveFileLookup", True).option("pathGlobFilter", glob).option("ignoreCorruptFiles", True)
    if fmt == "csv":
        reader = reader.option("header", True).option("encoding", options.pop("encoding", "UTF-8"))
    df = reader.options(**options).load(root)
    return _with_meta(df)


def _with_meta(df: DataFrame) -> DataFrame:
    """Adds META; lock files that office programs leave beside a file go."""
    path = F.col("_metadata.file_path")
    out = df.select(
        "*",
        F.col("_metadata.file_name").alias("source_file"),
        F.try_to_date(F.nullif(F.regexp_extract(path, r"/(\d{4}-\d{2}-\d{2})/", 1), F.lit("")), "yyyy-MM-dd").alias("folder_date"),
        F.col("_metadata.file_modification_time").alias("modified_at"),
    )
    return out.where(~F.regexp_like("source_file", F.lit(r"^(~|%7E)\$")))


def arriving(spark: SparkSession, root: str, schema: str, glob: str = "*", fmt: str = "csv") -> DataFrame:
    """A stream of the files that arrive in dated folders under ``root``, with META; each file is read once."""
    reader = spark.readStream.format(fmt).schema(schema).option("recursiveFileLookup", True).option("pathGlobFilter", glob)
    return _with_meta((reader.option("header", True) if fmt == "csv" else reader).load(root))


def union(frames: Sequence[DataFrame]) -> DataFrame:
    """By name; columns that a frame lacks are null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


PUBLIC = {"fecha": "string", "serie": "string", "precio_original": "string", "moneda": "string", "unidad": "string"}


def public_prices(sources: Mapping[str, DataFrame]) -> DataFrame:
    """The records of public sources below each other, by the name of each: dates and prices from whatever texts, without
    rows that lack a date, a series or a price.  Columns that a source lacks are null."""
    parts = [rows.conform(df, {}, PUBLIC).withColumn("fuente", F.lit(name)) for name, df in sources.items()]
    out = union(parts).withColumns({"fecha": dates.any_date(F.col("fecha")), "precio_original": text.number(F.col("precio_original"))})
    return out.dropna(subset=["fecha", "serie", "precio_original"])


WHOLESALE_ALIASES: Mapping[str, Sequence[str]] = {"fecha": ["fecha_consulta"], "cultivo_canonico": ["producto_canonico", "canonical_product"], "mercado": ["destino"], "origen": ["origen"], "precio_frecuente": ["precio_frec"], "precio_minimo": ["precio_min"], "precio_maximo": ["precio_max"]}
WHOLESALE = {"fecha": "string", "cultivo_canonico": "string", "mercado": "string", "origen": "string", "precio_frecuente": "double", "precio_minimo": "double", "precio_maximo": "double"}


def wholesale_history(files: DataFrame) -> DataFrame:
    """Typed wholesale prices of scanned files: dates day first, else ISO, else the folder's; rows without a product,
    price or date go; of equal (date, product, market, origin, price) rows the one of the last file stays."""
    out = rows.conform(files, WHOLESALE_ALIASES, WHOLESALE | {"folder_date": "date", "source_file": "string"})
    out = out.withColumn("fecha", F.coalesce(dates.any_date(F.col("fecha")), "folder_date"))
    out = out.withColumns({"cultivo_canonico": text.product_or_null(F.col("cultivo_canonico")), "mercado": F.coalesce("mercado", F.lit("sin_mercado")), "origen": F.coalesce("origen", F.lit("sin_origen"))})
    out = out.dropna(subset=["fecha", "cultivo_canonico", "precio_frecuente"])
    return rows.best(out, ["fecha", "cultivo_canonico", "mercado", "origen", "precio_frecuente"], [F.col("source_file").desc(), F.col("precio_minimo").asc_nulls_last(), F.col("precio_maximo").asc_nulls_last()])


def retail_daily(files: DataFrame, source: str) -> DataFrame:
    """Median price of a retailer by day and product: per kilogram, else per unit."""
    own = rows.conform(files, {"fecha": ["fecha_corrida", "run_date"], "producto": ["producto_canonico", "canonical_product"]}, {"fecha": "string", "producto": "string", "precio_estimado_por_kg_mxn": "double", "precio_mxn": "double", "folder_date": "date"})
    own = own.select(F.coalesce(dates.any_date(F.col("fecha")), "folder_date").alias("fecha"), text.product_or_null(F.col("producto")).alias("cultivo_canonico"), F.coalesce("precio_estimado_por_kg_mxn", "precio_mxn").alias("precio"))
    return own.dropna().groupBy("fecha", "cultivo_canonico").agg(F.median("precio").alias(f"precio_{source}"))


def latest_exports(files: DataFrame, product: Column, year: Column, month: Column) -> DataFrame:
    """Rows of the newest file for each (product, year, month) that the columns tell."""
    keyed = files.withColumns({"__p": product, "__y": year, "__m": month})
    newest = keyed.groupBy("__p", "__y", "__m").agg(F.max_by("source_file", F.struct("modified_at", "source_file")).alias("source_file"))
    return keyed.join(newest, ["__p", "__y", "__m", "source_file"], "left_semi").drop("__p", "__y", "__m")


def wide_series(files: DataFrame, date: str, units: Mapping[str, str] | None = None) -> DataFrame:
    """(fecha, serie, precio_original) of a table with a column of months such as 2026M01 and one column per series."""
    series = [c for c in files.columns if c not in (date, *META)]
    long = files.select(date, *[F.col(f"`{c}`").cast("string").alias(c) for c in series]).unpivot([date], series, "serie", "precio")
    day = F.coalesce(dates.month_code(F.col(date)), dates.any_date(F.col(date)))
    return long.select(day.alias("fecha"), "serie", text.number(F.nullif(F.trim("precio"), F.lit("…"))).alias("precio_original")).dropna()


def sheets(spark: SparkSession, root: str, glob: str = "*.csv") -> DataFrame:
    """(source_file, line, cells) of small CSV files whose first lines are no plain header; one file is one row first.

    Cells may be quoted, but lines end where they end.
    """
    whole = spark.read.text(root, wholetext=True, recursiveFileLookup=True, pathGlobFilter=glob)
    lines = whole.select(F.col("_metadata.file_name").alias("source_file"), F.posexplode(F.split("value", "\r?\n")).alias("line", "text"))
    cells = F.transform(F.split("text", ',(?=(?:[^"]*"[^"]*")*[^"]*$)'), lambda c: F.replace(F.regexp_replace(F.trim(c), '^"|"$', ""), F.lit('""'), F.lit('"')))
    return lines.where(F.trim("text") != "").select("source_file", "line", cells.alias("cells"))


def headed_series(sheet: DataFrame, names_at: int = 4, units_at: int = 5) -> DataFrame:
    """(source_file, fecha, serie, precio_original, unidad_origen) of sheets with a line of names, a line of units and
    then a line for each month; columns without a name go, as do cells that are no numbers."""
    cells = sheet.select("source_file", "line", F.col("cells")[0].alias("mes"), F.posexplode("cells").alias("at", "cell")).where("at > 0")
    head = cells.where(F.col("line").isin(names_at, units_at)).groupBy("source_file", "at").agg(F.max(F.when(F.col("line") == names_at, F.trim("cell"))).alias("serie"), F.coalesce(F.max(F.when(F.col("line") == units_at, F.trim("cell"))), F.lit("")).alias("unidad_origen"))
    day = F.coalesce(dates.month_code(F.trim("mes")), dates.any_date(F.trim("mes")))
    body = cells.where(F.col("line") > max(names_at, units_at)).join(head.where("serie <> ''"), ["source_file", "at"])
    return body.select("source_file", day.alias("fecha"), "serie", text.number(F.col("cell")).alias("precio_original"), "unidad_origen").dropna(subset=["fecha", "precio_original"])


# Headers of a long table of series
LONG_SERIES = {
    "fecha": ["date", "period", "time_period", "observation_date"], "serie": ["commodity", "series", "name", "producto", "indicator"], "precio_original": ["value", "precio", "price", "obs_value", "valor"],
}


def commodity_series(table: DataFrame) -> DataFrame:
    """(fecha, serie, precio_original) of a table that has a column for each of them, whatever their headers, else of a
    table of days by series, whose first column is the day."""
    own = {rows.header_key(c) for c in table.columns}
    if not all(own & {name, *aliases} for name, aliases in LONG_SERIES.items()):
        return wide_series(table, table.columns[0])
    out = rows.conform(table, LONG_SERIES, {c: "string" for c in LONG_SERIES})
    day = F.coalesce(dates.month_code(F.col("fecha")), dates.any_date(F.col("fecha")))
    return out.select(day.alias("fecha"), F.trim("serie").alias("serie"), text.number(F.col("precio_original")).alias("precio_original")).dropna()


def fx_rates(files: DataFrame) -> DataFrame:
    """(fecha, tipo_cambio_mxn_usd) of a daily file with '.' for missing days."""
    own = rows.conform(files, {"fecha": ["observation_date", "date"], "tipo_cambio_mxn_usd": ["dexmxus", "value"]}, {"fecha": "date", "tipo_cambio_mxn_usd": "double"})
    return own.dropna()


def mid_prices(files: DataFrame) -> DataFrame:
    """(fecha, serie, precio_original, unidad): the price, else the middle of low and high."""
    own = rows.conform(files, {"fecha": ["date", "report_date"], "serie": ["commodity"], "precio": ["price"], "bajo": ["low_price"], "alto": ["high_price"], "unidad": ["unit"]}, {"fecha": "string", "serie": "string", "precio": "double", "bajo": "double", "alto": "double", "unidad": "string"})
    return own.select(dates.any_date(F.col("fecha")).alias("fecha"), "serie", F.coalesce("precio", (F.col("bajo") + F.col("alto")) / 2).alias("precio_original"), "unidad").dropna(subset=["fecha", "serie", "precio_original"])


SKETCH = 15  # logarithm of the registers of a sketch: different values are told to about half a percent


def _facts(date: str | None, distinct: Sequence[str], errors: Column | None) -> dict[str, Column]:
    out = {"filas": F.count(F.lit(1)), "errores": F.count_if(F.lit(False) if errors is None else F.coalesce(errors, F.lit(False)))}
    if date:
        out |= {"fecha_min": F.min(date), "fecha_max": F.max(date)}
    return out | {f"boceto_{c}": F.hll_sketch_agg(F.col(c).cast("string"), F.lit(SKETCH)) for c in distinct}


def write_table(df: DataFrame, path: str, date: str | None = None, distinct: Sequence[str] = (), partition_by: Sequence[str] = (), errors: Column | None = None) -> DataFrame:
    """Writes Parquet and, beside it, one row that describes it; returns that row.

    Counts, dates and sketches of different values are observed while the rows are written: one pass, and nothing is read
    again.  Sketches are kept, so the rows of several parts make the whole's (``merged_facts``).
    """
    seen = Observation()
    facts = _facts(date, distinct, errors)
    df.observe(seen, *[c.alias(k) for k, c in facts.items()]).write.mode("overwrite").partitionBy(*partition_by).parquet(f"{path}/data")
    spark, got = df.sparkSession, seen.get
    schema = df.agg(*[c.alias(k) for k, c in facts.items()]).schema
    row = spark.createDataFrame([tuple(got[k] for k in facts)], schema)
    row.coalesce(1).write.mode("overwrite").parquet(f"{path}/metadata")
    return merged_facts(spark.read.parquet(f"{path}/metadata"))


def merged_facts(parts: DataFrame) -> DataFrame:
    """One row of the facts of a table from those of its parts: rows, errors, dates, and different values by their sketches."""
    ends = {"filas": F.sum, "errores": F.sum, "fecha_min": F.min, "fecha_max": F.max}
    told = [F.hll_sketch_estimate(F.hll_union_agg(c)).alias(f"distintos_{c[7:]}") for c in parts.columns if c.startswith("boceto_")]
    return parts.agg(*[f(c).alias(c) for c, f in ends.items() if c in parts.columns], *told)


def table_facts(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """The facts of all the tables that ``write_table`` wrote to ``paths``, as one table's; their rows are not read."""
    return merged_facts(union([spark.read.parquet(f"{p}/metadata") for p in paths]))


def read_lines(spark: SparkSession, root: str, schema: str, glob: str = "*.csv") -> tuple[DataFrame, DataFrame]:
    """(rows, errors) of all CSV files under ``root`` that begin with the header of ``schema``; a record is one line.

    Errors are rows (archivo, linea, error): a file without a byte ("vacio"), a line whose bytes are no UTF-8
    ("codificacion"), one that does not fit the schema, such as the last of a file that was cut ("registro").  Files are
    split like any text; empty ones come from the listing.
    """
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob)
    names = [f.name for f in StructType.fromDDL(schema)]
    line = F.col("value")
    lines = reader.text(root).select(F.col("_metadata.file_name").alias("archivo"), F.rtrim(line).alias("value"))
    lines = lines.where((line != ",".join(names)) & (line != "")).withColumn("utf8", F.is_valid_utf8(line))
    parsed = F.from_csv(F.when(F.col("utf8"), line), f"{schema}, __malo string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__malo"})
    lines = lines.withColumn("r", parsed)
    fits = F.col("utf8") & F.col("r.__malo").isNull()
    good = lines.where(fits).select(*[F.col(f"r.{c}").alias(c) for c in names], "archivo")
    bad = lines.where(~fits).select("archivo", F.make_valid_utf8(line).alias("linea"), F.when(~F.col("utf8"), "codificacion").otherwise("registro").alias("error"))
    empty = spark.createDataFrame([(name, None, "vacio") for name in _empty_files(spark, root, glob)], "archivo string, linea string, error string")
    return good, bad.union(empty)


def _empty_files(spark: SparkSession, root: str, glob: str) -> list[str]:
    """Names of files without a byte, which Spark's readers leave out; a listing, as the readers make one."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    listed, out = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).listFiles(path, True), []
    while listed.hasNext():
        f = listed.next()
        if not f.getLen() and fnmatch.fnmatch(f.getPath().getName(), glob) and f.getPath().getName()[0] not in "_.":
            out.append(f.getPath().getName())
    return sorted(out)


def write_tables(tables: Mapping[str, DataFrame], root: str) -> None:
    """One Parquet folder per table."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{root}/{name}")


def publish(df: DataFrame, root: str, version: str) -> None:
    """Writes a new version, then a new, higher numbered pointer to it; no file that readers use is ever replaced."""
    spark = df.sparkSession
    df.write.mode("errorifexists").parquet(f"{root}/version={version}")
    pointer = spark.createDataFrame([(_pointed(spark, root)[0] + 1, version)], "number long, version string")
    pointer.coalesce(1).write.mode("append").json(f"{root}-current")


def _pointed(spark: SparkSession, root: str) -> tuple[int, str | None]:
    """The highest pointer; (0, None) before the first."""
    try:
        top = spark.read.schema("number long, version string").json(f"{root}-current").agg(F.max(F.struct("number", "version")).alias("p")).first()["p"]
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        top = None
    return (top["number"], top["version"]) if top else (0, None)


def published(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/version={_pointed(spark, root)[1]}")


def write_history(df: DataFrame, path: str) -> None:
    """One folder per (cultivo, anio)."""
    df.write.mode("overwrite").partitionBy("cultivo", "anio").parquet(path)


EXPORT_NAMES = {"fecha": "Fecha", "cultivo_canonico": "Cultivo", "mercado": "Mercado", "origen": "Origen", "precio_frecuente": "Precio frecuente", "precio_minimo": "Precio minimo", "precio_maximo": "Precio maximo", "estado": "Estado"}


def export_csv(df: DataFrame, path: str, names: Mapping[str, str] = EXPORT_NAMES) -> None:
    """CSV with headers for readers."""
    df.withColumnsRenamed(dict(names)).write.mode("overwrite").option("header", True).csv(path)


# English headers of climate tables
CLIMATE_ALIASES = {
    "fecha": ["date"], "presa": ["id", "id_conagua"], "lluvia": ["precipitation_mm", "precipitacion_mm"], "temperatura": ["temperature_c", "temperatura_c"], "maxima": ["temperature_max_c", "temperatura_max_c"],
    "minima": ["temperature_min_c", "temperatura_min_c"], "evaporacion": ["evapotranspiration_mm", "evapotranspiracion_mm"], "indice_sequia": ["drought_index"],
}


def climate_table(table: DataFrame) -> DataFrame:
    """Daily climate with Spanish or English headers; days that are no dates are null, ids are texts."""
    types = {c: "double" for c in CLIMATE_ALIASES} | {"fecha": "string", "presa": "string"}
    return rows.conform(table, CLIMATE_ALIASES, types).withColumn("fecha", dates.any_date(F.col("fecha")))


def places(table: DataFrame, state: str | None = None, limit: int | None = None, order: str = "presa") -> DataFrame:
    """The places to fetch: of one state, if asked for, and the first so many by id, if a limit is set."""
    own = table.where(text.of_state(F.col("estado"), state))
    return own if limit is None else own.orderBy(order).limit(limit)


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder under ``spark.checkpoint.dir``; where that is unset, under a temporary folder, but only in local mode."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = f"file://{tempfile.mkdtemp(prefix='cosecha-')}"
    return f"{base.rstrip('/')}/cosecha/{name}-{uuid.uuid4().hex}"


def small(df: DataFrame, most: int) -> DataFrame:
    """``df``, marked for broadcast only if it is counted to have at most ``most`` rows."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def saved(df: DataFrame, name: str) -> DataFrame:
    """Writes a table to a new scratch folder and reads it: what follows does not compute it again."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
