"""Which texts hold which terms, by an inverted index of grams: no text is compared with all terms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GRAM = 3


def _grams(c: str, width: int) -> Column:
    """The different runs of ``width`` characters."""
    starts = F.sequence(F.lit(1), F.greatest(F.length(c) - (width - 1), F.lit(1)))
    runs = F.transform(starts, lambda i: F.substring(F.col(c), i, F.lit(width)))
    return F.array_distinct(F.filter(runs, lambda g: F.length(g) == width))


def held_in(terms: DataFrame, texts: DataFrame, gram: int = GRAM) -> DataFrame:
    """(grupo, termino, texto): every term of (grupo, termino) with each text of (grupo, texto) that holds it.

    A term stands in the index under its rarest run of ``gram`` characters (the whole term if it is shorter), counted over
    the different texts of its group; a text meets the terms whose run it has, and the pair is verified.  A term with a run
    that no text has is dropped before the texts are met.  Null and empty terms are in no text.
    """
    term = terms.where("grupo is not null and termino <> ''").select("grupo", "termino").distinct()
    text = texts.where("grupo is not null and texto is not null").select("grupo", "texto").distinct()
    width = F.least(F.length("termino"), F.lit(gram))
    runs_of_width = F.element_at(F.array(*[_grams("termino", k) for k in range(1, gram + 1)]), width)
    wanted = term.select("grupo", "termino", F.explode(runs_of_width).alias("gram"))
    asked = wanted.select("grupo", "gram").distinct()
    runs = text.select("grupo", "texto", F.explode(F.array_distinct(F.flatten(F.array(*[_grams("texto", k) for k in range(1, gram + 1)])))).alias("gram"))
    runs = runs.join(asked, ["grupo", "gram"], "left_semi")
    counts = runs.groupBy("grupo", "gram").agg(F.count(F.lit(1)).alias("n"))
    common = wanted.join(counts, ["grupo", "gram"], "left").groupBy("grupo", "termino")
    rarest = common.agg(F.min_by("gram", F.struct("n", "gram")).alias("gram"), F.count_if(F.col("n").isNull()).alias("missing")).where("missing = 0").drop("missing")
    return runs.join(rarest, ["grupo", "gram"]).where(F.contains("texto", "termino")).select("grupo", "termino", "texto")
