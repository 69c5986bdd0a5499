"""Choosing rows: first, last, best and latest by key, upserts, and the split of good and bad rows."""

from __future__ import annotations

import datetime
import re
import unicodedata
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def best(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows of each key in a total order."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rank", rank).where(F.col("__rank") <= n).drop("__rank")


def latest(df: DataFrame, keys: Sequence[str], date: str, *tie: Column) -> DataFrame:
    return best(df, keys, [F.col(date).desc_nulls_last(), *tie])


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of both, those of ``new`` in place of old ones with their keys."""
    kept = old.join(new.select(*keys).distinct(), list(keys), "left_anti")
    return kept.unionByName(new, allowMissingColumns=True)


def checked(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(good rows, bad rows with the names of the rules they break)."""
    broken = F.filter(F.array(*[F.when(~F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in rules.items()]), lambda x: x.isNotNull())
    all_ = df.withColumn("errors", broken)
    return all_.where(F.size("errors") == 0).drop("errors"), all_.where(F.size("errors") > 0)


def without_markers(df: DataFrame, columns: Sequence[str], markers: Sequence[str]) -> DataFrame:
    """Without rows whose cells are all one text of ``markers``, or all blank."""
    cells = F.array_distinct(F.filter(F.array(*[F.trim(F.col(c).cast("string")) for c in columns]), lambda x: x.isNotNull() & (x != "")))
    marker = (F.size(cells) == 1) & F.array_contains(F.array(*map(F.lit, markers)), cells[0])
    return df.where((F.size(cells) > 0) & ~F.coalesce(marker, F.lit(False)))


def header_key(name: str) -> str:
    """A header without accents, in lower case, with one underscore between words."""
    letters = unicodedata.normalize("NFKD", name.strip())
    return re.sub("[^a-z0-9]+", "_", "".join(x for x in letters if not unicodedata.combining(x)).casefold()).strip("_")


def conform(df: DataFrame, aliases: Mapping[str, Sequence[str]], types: Mapping[str, str]) -> DataFrame:
    """Canonical columns from whatever headers a source has.

    Each column is the first known value of the headers whose slug is among its aliases, left to right; a column that
    no header gives is null; texts that do not fit a type are null, and so is NaN.
    """
    out = []
    for name, kind in types.items():
        own = [name, *aliases.get(name, ())]
        found = [F.col(f"`{c}`") for c in df.columns if header_key(c) in own]
        value = F.coalesce(*[c.try_cast(kind) for c in found]) if found else F.lit(None).cast(kind)
        out.append((F.nanvl(value, F.lit(None).cast("double")) if kind == "double" and found else value).alias(name))
    return df.select(*out)


def between(df: DataFrame, date: str, since: datetime.date | None = None, until: datetime.date | None = None) -> DataFrame:
    """Rows from a day to a day, both included; no bound where none is given."""
    if since is not None:
        df = df.where(F.col(date) >= F.lit(since))
    return df if until is None else df.where(F.col(date) <= F.lit(until))
