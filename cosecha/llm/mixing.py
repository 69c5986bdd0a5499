"""Mixing sources to target weights by capped water-filling, in DataFrame functions only.

Defined results: a null or empty text has size 0 and is taken 0 words; a null source is a source of its own, ranked
last; an empty table gives an empty result; rows with a repeated id are told apart by their text, and equal rows are
taken alike; other columns of the input do not matter.  Ties in the order of sampling fall to the text's digest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cosecha.llm.work import fresh, saved

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
BUCKETS, BUCKET_ROWS = 512, 20_000  # hash buckets, at least; more where they would have more rows


def water_fill(sources: DataFrame, max_epochs: int) -> DataFrame:
    """Adds ``target`` to (weight, source_size): shares of all sizes by weight, at most ``max_epochs`` times a source.

    The sources that fill up first are those with the least size per weight, so the level at which the rest share
    what is left follows from running sums in that order.  One row per source meets in one task.
    """
    order = Window.orderBy(F.col("source_size") / F.col("weight"), "rank")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = sources.withColumns(
        {
            "total": F.sum("source_size").over(whole),
            "left_weight": F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0)),
            "full": F.lit(max_epochs) * F.coalesce(F.sum("source_size").over(before), F.lit(0)),
        }
    )
    # the level if this source and all after it were below their limits
    s = s.withColumn("level", F.try_divide((F.col("total") - F.col("full")).cast("double"), F.col("left_weight")))
    s = s.withColumn("open", F.col("level") * F.col("weight") <= F.lit(max_epochs) * F.col("source_size"))
    level = F.min(F.when(F.col("open"), F.struct(F.col("source_size") / F.col("weight"), "rank", "level"))).over(whole)["level"]
    limit = (F.lit(max_epochs) * F.col("source_size")).cast("double")
    return s.withColumn("target", F.coalesce(F.least(limit, level * F.col("weight")), limit)).drop("total", "left_weight", "full", "level", "open")


def _source_key():
    return F.coalesce(F.concat(F.lit("s"), "source"), F.lit("~"))


def _row_key(seed: int):
    """Places a row in the seeded order; equal rows are in one place."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), _source_key(), F.md5(F.coalesce("text", F.lit("")))))


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = 17) -> DataFrame:
    """(doc_id, text_key, size, source_key, source_size, target, copies, taken) for every row of ``docs``.

    A source that is to be read target / size = w + f times gives every document w whole times, and once more those
    that come first in a seeded random order of its documents, while the middle of the document is within f of all
    words.  Running sums go over hash buckets first, then inside one bucket, so no task sees a whole source.
    """
    d = docs.select(
        "doc_id",
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        _source_key().alias("source_key"),
        _row_key(seed).alias("text_key"),
    )
    d = saved(d, "mix")
    buckets = max(BUCKETS, 1 << (d.count() // BUCKET_ROWS).bit_length())
    place = F.conv(F.substring("text_key", 1, 8), 16, 10).cast("long") * buckets / (1 << 32)
    d = d.withColumn("bucket", F.floor(place).cast("int"))
    binned = d.groupBy("source_key", "bucket").agg(F.sum("size").alias("bucket_size"))
    sources = binned.groupBy("source_key").agg(F.sum("bucket_size").alias("source_size"))
    ranked = sources.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source_key") == "~", "source_key")) - 1)
    ranked = ranked.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), F.col("rank") % len(weights) + 1))
    ranked = water_fill(ranked, max_epochs)
    ranked = ranked.withColumn("whole", F.floor(F.coalesce(F.try_divide("target", "source_size"), F.lit(0.0))).cast("long"))
    ranked = ranked.withColumn("extra", F.col("target") - F.col("whole") * F.col("source_size"))
    by_bucket = Window.partitionBy("source_key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bins = binned.withColumn("before", F.coalesce(F.sum("bucket_size").over(by_bucket), F.lit(0))).join(ranked, "source_key")
    # a row for each bucket of each source
    joined = d.join(bins.select("source_key", "bucket", "before", "source_size", "target", "whole", "extra"), ["source_key", "bucket"])
    inside = Window.partitionBy("source_key", "bucket").orderBy("text_key").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    middle = F.col("before") + F.sum("size").over(inside) - F.col("size") / 2.0
    return joined.withColumn("copies", F.col("whole") + (middle < F.col("extra")).cast("long")).select(
        "doc_id", "text_key", "size", "source_key", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken")
    )


def op10(spark, sf_dir: str) -> DataFrame:
    """One row per document: how many words the mix takes of it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mixed(docs).select("doc_id", "size", "source_size", "target", "taken")


def repeated(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = 17) -> DataFrame:
    """The mix itself: each row of ``docs``, with its columns, as often as the mix takes it."""
    own, key, copies, copy = fresh(docs, "mix_own_key", "mix_key", "mix_copies", "mix_copy")
    keep = mixed(docs, weights, max_epochs, seed).where("copies > 0").select(F.col("text_key").alias(key), F.col("copies").alias(copies)).distinct()
    out = docs.withColumn(own, _row_key(seed)).join(keep, F.col(own) == F.col(key))
    out = out.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copies).cast("int"))))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


OP10_SQL = """
WITH d AS (
  SELECT doc_id, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size,
         coalesce('s' || source, '~') AS source_key,
         md5(concat_ws(':', '17', coalesce(CAST(doc_id AS VARCHAR), 'null'), coalesce('s' || source, '~'), md5(coalesce(text, '')))) AS text_key
  FROM documents),
s AS (SELECT source_key, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY 1),
r AS (SELECT *, row_number() OVER (ORDER BY source_key = '~', source_key) - 1 AS rank FROM s),
w AS (SELECT *, CASE rank % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM r),
f AS (
  SELECT *, CAST((sum(source_size) OVER ()) - coalesce(3 * (sum(source_size) OVER b), 0) AS DOUBLE)
            / ((sum(weight) OVER ()) - coalesce(sum(weight) OVER b, 0)) AS level
  FROM w WINDOW b AS (ORDER BY source_size / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT level FROM f WHERE level * weight <= 3 * source_size ORDER BY source_size / weight, rank LIMIT 1),
t AS (SELECT f.*, coalesce(least(CAST(3 * source_size AS DOUBLE), (SELECT level FROM l) * weight), CAST(3 * source_size AS DOUBLE)) AS target FROM f),
x AS (SELECT *, CAST(floor(coalesce(target / nullif(source_size, 0), 0)) AS BIGINT) AS whole FROM t)
SELECT doc_id, size, source_size, target,
       size * (whole + CASE WHEN (sum(size) OVER (PARTITION BY source_key ORDER BY text_key)) - size / 2.0 < target - whole * source_size THEN 1 ELSE 0 END) AS taken
FROM d JOIN x USING (source_key)
"""
