"""Choosing forecasts by a temporal back-test, and gradient-boosted trees as one of the candidates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cosecha.functions import numbers
from cosecha.operators import quantiles, rows
from cosecha.plans import trees
from cosecha.sources import files

SHARE = 0.8


def cutoff(df: DataFrame, date: str, share: float = SHARE) -> DataFrame:
    """One row with the date that separates training from test: 80 percent of the distinct dates lie before it."""
    days = df.where(F.col(date).isNotNull()).select(date).distinct()
    order = Window.orderBy(date)  # one row per date
    ranked = days.withColumn("__i", F.row_number().over(order) - 1).withColumn("__n", F.count(F.lit(1)).over(Window.partitionBy()))
    at = F.least(F.col("__n") - 1, F.greatest(F.lit(1), F.floor(F.col("__n") * share)))
    return ranked.where((F.col("__i") == at) & (F.col("__n") >= 5)).select(F.col(date).alias("cutoff"))


def split(df: DataFrame, date: str, purge_days: int = 0) -> tuple[DataFrame, DataFrame]:
    """(rows before the cutoff less ``purge_days``, rows from it on)."""
    both = df.crossJoin(F.broadcast(cutoff(df, date)))  # one row
    return both.where(F.col(date) < F.date_sub("cutoff", purge_days)).drop("cutoff"), both.where(F.col(date) >= F.col("cutoff")).drop("cutoff")


def metrics(test: DataFrame, actual: str, methods: Mapping[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """(metodo, n, mae, rmse, mape) of each method on the rows where it has a value; zero actuals count in no mape."""
    long = test.select(*by, F.col(actual).alias("a"), F.explode(F.array(*[F.struct(F.lit(m).alias("metodo"), c.cast("double").alias("p")) for m, c in methods.items()])).alias("m"))
    long = long.select(*by, "a", "m.metodo", "m.p").dropna(subset=["a", "p"])
    miss = F.abs(F.col("a") - F.col("p"))
    return long.groupBy(*by, "metodo").agg(F.count(F.lit(1)).alias("n"), F.avg(miss).alias("mae"), F.sqrt(F.avg(miss * miss)).alias("rmse"), F.avg(numbers.ratio(miss, F.abs("a"))).alias("mape"))


def choose(metric: DataFrame, forced: str | None = None) -> DataFrame:
    """One row: the method with the least mae, of equals the first by name; a forced one carries its trace."""
    if forced is not None:
        return metric.where(F.col("metodo") == forced).withColumn("forzado", F.lit(True))
    return metric.agg(F.min_by(F.struct("metodo", "n", "mae", "rmse", "mape"), F.struct("mae", "metodo")).alias("m")).select("m.*").withColumn("forzado", F.lit(False))


def residual_band(test: DataFrame, actual: str, forecast: Column) -> DataFrame:
    """One row (r10, r90): quantiles of actual less forecast."""
    found = quantiles.exact_quantiles(test.select((F.col(actual) - forecast).alias("resto")), [], "resto", (0.1, 0.9))
    return found.select(F.col("q1").alias("r10"), F.col("q2").alias("r90"))


# Forecasts by horizon: rows with horizonte, objetivo and prueba (whether they lie after the horizon's cutoff)


def marked(long: DataFrame, date: str, share: float = SHARE) -> DataFrame:
    """Adds ``prueba``; horizons of fewer than five days have no cutoff, and their rows go."""
    days = long.select("horizonte", date).distinct()  # one row for each horizon and date
    ranked = days.withColumn("i", F.row_number().over(Window.partitionBy("horizonte").orderBy(date)) - 1).withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("horizonte")))
    at = F.least(F.col("n") - 1, F.greatest(F.lit(1), F.floor(F.col("n") * share)))
    cut = ranked.where((F.col("i") == at) & (F.col("n") >= 5)).select("horizonte", F.col(date).alias("__cut"))
    return long.join(F.broadcast(cut), "horizonte").withColumn("prueba", F.col(date) >= F.col("__cut")).drop("__cut")  # a row for each horizon


def named(methods: Mapping[str, Column], metodo: str = "metodo") -> Column:
    """The forecast of the method that a column names."""
    out = F.lit(None).cast("double")
    for name, column in methods.items():
        out = F.when(F.col(metodo) == name, column).otherwise(out)
    return out


def chosen(target: DataFrame, methods: Mapping[str, Column], fallback: str, forced: str | None = None, least: int = 1) -> DataFrame:
    """One row for each horizon: the method with the least mae on the test part, of equals the first by name.

    Below ``least`` training rows it is ``fallback``; a ``forced`` method is taken as it is; ``motivo`` tells which.
    """
    if forced is not None and forced not in methods:
        raise ValueError(f"no such method: {forced}; there are {', '.join(methods)}")
    one = F.explode(F.array(*[F.struct(F.lit(m).alias("metodo"), c.alias("p")) for m, c in methods.items()])).alias("m")
    long = target.select("horizonte", "prueba", "objetivo", one).select("horizonte", "prueba", "objetivo", "m.*").dropna(subset=["p"])
    miss, test = F.abs(F.col("objetivo") - F.col("p")), F.col("prueba")
    told = long.groupBy("horizonte", "metodo").agg(
        F.count_if(test).alias("n"), F.avg(F.when(test, miss)).alias("mae"), F.sqrt(F.avg(F.when(test, miss * miss))).alias("rmse"),
        F.avg(F.when(test, numbers.ratio(miss, F.abs("objetivo")))).alias("mape"),
    )
    told = told.where("n > 0").join(target.groupBy("horizonte").agg(F.count_if(~test).alias("filas")), "horizonte")
    few = F.col("filas") < least
    reason = F.lit("forzado") if forced else F.when(few, "pocas_filas").otherwise("menor_mae")
    first = F.col("metodo") != forced if forced else few & (F.col("metodo") != fallback)
    return rows.best(told.withColumn("motivo", reason), ["horizonte"], [first.cast("int"), F.col("mae"), F.col("metodo")])


def bands(target: DataFrame, choice: DataFrame, methods: Mapping[str, Column]) -> DataFrame:
    """(horizonte, r10, r90): quantiles of the chosen method's residuals on the test part."""
    whole = target.where("prueba").join(F.broadcast(choice.select("horizonte", "metodo")), "horizonte")  # a row for each horizon
    found = quantiles.exact_quantiles(whole.select("horizonte", (F.col("objetivo") - named(methods)).alias("resto")), ["horizonte"], "resto", (0.1, 0.9))
    return found.select("horizonte", F.col("q1").alias("r10"), F.col("q2").alias("r90"))


@dataclass(frozen=True)
class Candidate:
    """Boosted trees as a method: its name, the column that they learn, and the one that is added to what they say."""

    name: str
    label: str = "objetivo"
    shift: str | None = None


@dataclass(frozen=True)
class Trained:
    """What a training gives: the choice of each horizon, (horizonte, r10, r90), the newest rows with the columns of all
    methods, (horizonte, metodo, variable, importancia) of the last models, None if there is none, and the back-tested rows."""

    choice: DataFrame
    band: DataFrame
    newest: DataFrame
    importances: DataFrame | None
    tested: DataFrame


def trained(
    target: DataFrame, newest: DataFrame, methods: Mapping[str, Column], candidates: Sequence[Candidate], numeric: Sequence[str], categories: Sequence[str], row: Sequence[str], *,
    fallback: str, forced: str | None = None, least: int = 1, folder: str | None = None, top: int = 20, **options,
) -> Trained:
    """Back-tests the methods and candidates of each horizon, and forecasts ``newest`` (with its horizonte) by the best.

    Each candidate is fitted twice for each horizon, on the rows before the cutoff to be judged and on all rows to
    forecast; all these models grow together.  ``row``: the columns that tell rows apart.  With a ``folder`` the last
    models are saved there.
    """
    spark = target.sparkSession
    target = files.saved(target, "targets")
    horizons = sorted(r["horizonte"] for r in target.select("horizonte").distinct().collect())  # a row for each horizon
    fits = [trees.Fit(f"{c.name}_{h}_{'final' if last else 'prueba'}", h, c.label, last) for c in candidates for h in horizons for last in (False, True)]
    known = trees.boosted(target, fits, numeric, categories, row, least=least, **options)

    def of(c: Candidate, last: bool) -> dict[int, trees.Model]:
        return {m.fit.group: m for m in known.values() if m.fit.name.startswith(f"{c.name}_{m.fit.group}_") and m.fit.last == last}

    tested, ahead = target, newest
    for c in candidates:
        tested, ahead = trees.predicted(tested, of(c, False), c.name, c.shift), trees.predicted(ahead, of(c, True), c.name, c.shift)
    tested = files.saved(tested, "forecasts")
    every = dict(methods) | {c.name: F.col(c.name) for c in candidates}
    choice = files.saved(chosen(tested, every, fallback, forced, least), "choice")
    told = [(m.fit.group, c.name, variable, share) for c in candidates for m in of(c, True).values() for variable, share in m.importances(top)]
    if folder and known:
        trees.write_models([m for m in known.values() if m.fit.last], folder, spark)
    shown = spark.createDataFrame(told, "horizonte int, metodo string, variable string, importancia double") if told else None
    return Trained(choice, files.saved(bands(tested, choice, every), "bands"), ahead, shown, tested)
