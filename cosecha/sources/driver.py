"""Canonical tables derived from the driver's star schema: the inputs of the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cosecha.functions import dates, numbers


class Tables:
    """The canonical tables over one folder of driver tables; each is a lazy DataFrame."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def wholesale(self) -> DataFrame:
        line, part, supplier, nation, region = map(self.raw, ("lineitem", "part", "supplier", "nation", "region"))
        market = supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).join(region, F.col("n_regionkey") == F.col("r_regionkey")).select("s_suppkey", "r_name")
        price = F.col("l_extendedprice") / F.col("l_quantity")
        out = line.join(part.select("p_partkey", "p_type", "p_brand"), F.col("l_partkey") == F.col("p_partkey")).join(market, F.col("l_suppkey") == F.col("s_suppkey"))
        return out.select(F.col("l_shipdate").cast("date").alias("fecha"), F.col("p_type").alias("cultivo"), F.col("r_name").alias("mercado"), F.col("p_brand").alias("origen"), price.alias("precio"), (price * (1 - F.col("l_discount"))).alias("precio_minimo"), (price * (1 + F.col("l_tax"))).alias("precio_maximo"))

    def retail(self) -> DataFrame:
        line, orders, part = map(self.raw, ("lineitem", "orders", "part"))
        out = line.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(part.select("p_partkey", "p_type", "p_retailprice"), F.col("l_partkey") == F.col("p_partkey"))
        per_kg = F.when(F.col("l_returnflag") != "R", F.col("l_extendedprice") / F.col("l_quantity") * 1.1)
        return out.select(F.col("o_orderdate").cast("date").alias("fecha"), F.col("p_type").alias("cultivo"), F.when(F.col("l_linenumber") % 2 == 0, "uno").otherwise("dos").alias("fuente"), per_kg.alias("precio_kg"), F.col("p_retailprice").alias("precio_unidad"))

    def dams(self) -> DataFrame:
        """One row per reservoir and decena."""
        line, supplier, nation = map(self.raw, ("lineitem", "supplier", "nation"))
        d = F.col("l_shipdate").cast("date")
        out = line.select("l_suppkey", "l_discount", "l_quantity", F.year(d).alias("anio"), F.month(d).alias("mes"), dates.decena_of(d).alias("decena"))
        out = out.groupBy("l_suppkey", "anio", "mes", "decena").agg(numbers.rounded(1000 * F.avg("l_discount")).alias("pct"), F.sum("l_quantity").alias("hm3"))
        names = supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", F.col("n_name").alias("estado"), F.col("s_acctbal").alias("namo"), (F.abs("s_acctbal") + 1).alias("name"))
        return out.join(names, F.col("l_suppkey") == F.col("s_suppkey")).select(F.col("l_suppkey").alias("presa"), "estado", "anio", "mes", "decena", dates.decena_end(F.col("anio"), F.col("mes"), F.col("decena")).alias("fecha"), "pct", "hm3", "namo", "name")

    def weather(self) -> DataFrame:
        """Daily weather of 100 places."""
        o = self.raw("orders")
        p = F.col("o_totalprice")
        return o.select((F.col("o_custkey") % 100).alias("presa"), F.col("o_orderdate").cast("date").alias("fecha"), (p / 10000).alias("lluvia"), (p / 20000).alias("evaporacion"), (p / 15000).alias("temperatura"))

    def progress(self) -> DataFrame:
        """Monthly progress of a crop in a state: running sums within the year."""
        from pyspark.sql.window import Window

        line, part, supplier, nation = map(self.raw, ("lineitem", "part", "supplier", "nation"))
        d = F.col("l_shipdate").cast("date")
        out = line.join(part, F.col("l_partkey") == F.col("p_partkey")).join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        out = out.groupBy(F.col("p_type").alias("cultivo"), F.col("n_name").alias("estado"), F.year(d).alias("anio"), F.month(d).alias("mes")).agg(
            F.sum("l_quantity").alias("prod_mes"), F.count(F.lit(1)).alias("sembrada"), F.count_if(F.col("l_returnflag") != "R").alias("cosechada"), F.count_if(F.col("l_returnflag") == "A").alias("siniestrada")
        )
        run = Window.partitionBy("cultivo", "estado", "anio").orderBy("mes")
        return out.withColumn("acumulada", F.sum("prod_mes").over(run)).withColumn("corte", F.last_day(F.try_to_date(F.format_string("%04d-%02d-01", "anio", "mes"))))

    def annual(self, progress: DataFrame | None = None) -> DataFrame:
        """Annual close of a crop in a state; ``progress``: the monthly progress, where it is at hand."""
        progress = self.progress() if progress is None else progress
        return progress.groupBy("cultivo", "estado", "anio").agg(F.sum("prod_mes").alias("produccion"), F.try_divide(F.sum("prod_mes"), F.sum("cosechada")).alias("rendimiento"))


#: The same tables for DuckDB.
SQL = {
    "w": "SELECT CAST(l_shipdate AS DATE) AS fecha, p_type AS cultivo, r_name AS mercado, p_brand AS origen, l_extendedprice / l_quantity AS precio, l_extendedprice / l_quantity * (1 - l_discount) AS precio_minimo, l_extendedprice / l_quantity * (1 + l_tax) AS precio_maximo FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey",
    "r": "SELECT CAST(o_orderdate AS DATE) AS fecha, p_type AS cultivo, CASE WHEN l_linenumber % 2 = 0 THEN 'uno' ELSE 'dos' END AS fuente, CASE WHEN l_returnflag <> 'R' THEN l_extendedprice / l_quantity * 1.1 END AS precio_kg, p_retailprice AS precio_unidad FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey",
    "d": "SELECT l_suppkey AS presa, n_name AS estado, anio, mes, decena, CASE decena WHEN 1 THEN make_date(anio, mes, 10) WHEN 2 THEN make_date(anio, mes, 20) ELSE last_day(make_date(anio, mes, 1)) END AS fecha, pct, hm3, s_acctbal AS namo, abs(s_acctbal) + 1 AS name FROM (SELECT l_suppkey, CAST(year(l_shipdate) AS INTEGER) AS anio, CAST(month(l_shipdate) AS INTEGER) AS mes, CAST(least(ceil(day(l_shipdate) / 10), 3) AS INTEGER) AS decena, floor(1000 * avg(l_discount) * CAST(10000 AS DOUBLE) + CAST(0.500001 AS DOUBLE)) / CAST(10000 AS DOUBLE) AS pct, sum(l_quantity) AS hm3 FROM lineitem GROUP BY ALL) JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey",
    "c": "SELECT o_custkey % 100 AS presa, CAST(o_orderdate AS DATE) AS fecha, o_totalprice / 10000 AS lluvia, o_totalprice / 20000 AS evaporacion, o_totalprice / 15000 AS temperatura FROM orders",
    "a": "SELECT *, sum(prod_mes) OVER (PARTITION BY cultivo, estado, anio ORDER BY mes) AS acumulada, last_day(make_date(anio, mes, 1)) AS corte FROM (SELECT p_type AS cultivo, n_name AS estado, CAST(year(l_shipdate) AS INTEGER) AS anio, CAST(month(l_shipdate) AS INTEGER) AS mes, sum(l_quantity) AS prod_mes, count(*) AS sembrada, count(*) FILTER (l_returnflag <> 'R') AS cosechada, count(*) FILTER (l_returnflag = 'A') AS siniestrada FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY ALL)",
    "y": "SELECT cultivo, estado, anio, sum(prod_mes) AS produccion, sum(prod_mes) / nullif(sum(cosechada), 0) AS rendimiento FROM a GROUP BY ALL",
}


def with_tables(names: str, query: str) -> str:
    """SQL with the canonical tables of these letters in front."""
    return "WITH " + ", ".join(f"{n} AS ({SQL[n]})" for n in names) + " " + query
