"""As-of, range and substring joins without nested loops."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cosecha.operators import terms


BUCKET_DAYS = 64


def _bucket(t: str, days: int) -> Column:
    """Number of the stretch of ``days`` that holds a date or a timestamp."""
    return F.floor(F.unix_micros(F.col(t).cast("timestamp")) / (days * 86_400_000_000))


def asof_join(left: DataFrame, right: DataFrame, on: tuple[str, str], by: Sequence[str], tolerance_days: int | None = None, bucket_days: int = BUCKET_DAYS) -> DataFrame:
    """Each left row with the last right row of its ``by`` keys at or before its time, if it is not too old.

    Time is cut into buckets.  The last right row of each key and bucket is carried to the later buckets of the key, a
    row for each; inside a bucket the times that the left side asks for and the right rows are filled in order.  So the
    rows follow the input, however far its dates reach, and a key with all rows is spread over its buckets.  Left rows
    themselves meet their answer in an equality of keys and time, which Spark can split.

    Two dates are compared as dates, else both are timestamps.  Right columns other than the keys keep their names; of
    right rows with one key and time the one with the greatest values stays.  Null keys and null times match nothing.
    """
    at, right_at = on
    kinds = {dict(left.dtypes)[at], dict(right.dtypes)[right_at]}
    kind = "date" if kinds == {"date"} else "timestamp"
    values = [c for c in right.columns if c not in by and c != right_at]
    keys = [f"__k{i}" for i in range(len(by))]

    def timed(df: DataFrame, t: str) -> DataFrame:
        own = df.select(*[F.col(c).alias(k) for c, k in zip(by, keys, strict=True)], F.col(t).cast(kind).alias("__t"), *([F.col(c) for c in values] if df is right else []))
        return own.dropna(subset=[*keys, "__t"])

    held = F.struct(F.col("__t").alias("at"), *[F.col(c).alias(f"v{i}") for i, c in enumerate(values)])
    known = timed(right, right_at).groupBy(*keys, "__t").agg(F.max(held).alias("__row"))
    asked = timed(left, at).distinct()
    both = known.unionByName(asked, allowMissingColumns=True).withColumn("__bucket", _bucket("__t", bucket_days))
    # a row for each key and bucket: the last known row of the buckets before
    ends = both.groupBy(*keys, "__bucket").agg(F.max("__row").alias("__last"))
    carried = F.last("__last", ignorenulls=True).over(Window.partitionBy(*keys).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1))
    starts = ends.select(*keys, "__bucket", carried.alias("__row")).where("__row is not null").withColumn("__t", F.lit(None).cast(kind))
    inside = Window.partitionBy(*keys, "__bucket").orderBy("__t", F.col("__row").isNull()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = both.unionByName(starts).withColumn("__found", F.last("__row", ignorenulls=True).over(inside))
    found = filled.where("__row is null and __found is not null").select(*keys, "__t", "__found")
    if tolerance_days is not None:
        oldest = F.date_sub("__t", tolerance_days) if kind == "date" else F.col("__t") - F.make_dt_interval(F.lit(tolerance_days))
        found = found.where(F.col("__found.at") >= oldest)
    new = [c for c in [right_at, *values] if c not in left.columns]
    places = {right_at: "at"} | {c: f"v{i}" for i, c in enumerate(values)}
    found = found.select(*keys, "__t", *[F.col("__found")[places[c]].alias(c) for c in new])
    same = F.col(at).cast(kind) == F.col("__t")
    for c, k in zip(by, keys, strict=True):
        same = same & (left[c] == F.col(k))
    return left.join(found, same, "left").select(*[left[c] for c in left.columns], *new)


def asof_series(left: DataFrame, series: DataFrame, on: tuple[str, str], tolerance_days: int | None = None) -> DataFrame:
    """As-of join without a key to one series of dates, small by nature."""
    return asof_join(left, series, on, (), tolerance_days)


def known_by(days: DataFrame, records: DataFrame, by: str, day: str, known: str, item: str) -> DataFrame:
    """For each (by, day): how many items are known at or before the day, and the last date that is.

    An item counts from its first date on, so a range join becomes a running sum over the days of a key.
    """
    first = records.groupBy(by, item).agg(F.min(known).alias(known))
    new = first.groupBy(by, known).agg(F.count(F.lit(1)).alias("__new")).select(by, F.col(known).alias(day), "__new", F.lit(0).alias("__side"), F.lit(None).cast("date").alias("__date"))
    dates = records.select(by, F.col(known).alias(day), F.lit(0).alias("__new"), F.lit(0).alias("__side"), F.col(known).alias("__date")).distinct()
    asked = days.select(by, day, F.lit(0).alias("__new"), F.lit(1).alias("__side"), F.lit(None).cast("date").alias("__date"))
    order = Window.partitionBy(by).orderBy(day, "__side").rowsBetween(Window.unboundedPreceding, 0)
    both = new.unionByName(dates).unionByName(asked)
    both = both.withColumn("items_known", F.sum("__new").over(order)).withColumn("last_known", F.max("__date").over(order))
    return both.where("__side = 1").select(by, day, F.col("items_known").cast("long").alias("items_known"), "last_known")


def contains_join(records: DataFrame, config: DataFrame, source: str, text: str, term: str, whole: Column) -> DataFrame:
    """Records with the configuration rows of their source whose term is their text or, unless ``whole``, inside it.

    Whole texts meet their terms in an equality, the others through an index of the terms' rarest runs.
    """
    c = config.select(F.lower(F.col(source)).alias("__s"), F.lower(F.col(term)).alias("__n"), *[F.col(x) for x in config.columns if x != source and x != term], F.col(term).alias("__term"))
    c = c.where("__n <> ''")
    r = records.withColumns({"__t": F.lower(F.col(text)), "__g": F.lower(F.col(source)), "__w": whole})
    held = terms.held_in(c.select(F.col("__s").alias("grupo"), F.col("__n").alias("termino")), r.where("not __w").select(F.col("__g").alias("grupo"), F.col("__t").alias("texto")))
    inside = held.select(F.col("grupo").alias("__g"), F.col("texto").alias("__t"), F.col("termino").alias("__n"))
    pairs = r.where("__w").withColumn("__n", F.col("__t")).unionByName(r.where("not __w").join(inside, ["__g", "__t"]))
    kept = [F.col(x) for x in config.columns if x != source and x != term]
    return pairs.join(c, (F.col("__g") == F.col("__s")) & (pairs["__n"] == c["__n"])).select(*[pairs[x] for x in records.columns], *kept, F.col("__term"))


def resolve_names(asked: DataFrame, catalogue: DataFrame, asked_key: str, key: str, within: str | None = None) -> DataFrame:
    """Each asked slug with its match: the entry that equals it, else the one entry that holds it in any place; status
    found, ambiguous or missing.

    ``within``: a column of both sides, such as the state; where the asked row has one, only its entries are tried.
    Slugs meet the entries through an index of their rarest runs.  A null or empty slug is missing.
    """
    place = lambda df: F.col(within) if within else F.lit(None).cast("string")
    entries = catalogue.where(F.col(key).isNotNull()).select(F.col(key).alias("k"), place(catalogue).alias("w")).distinct()
    wanted = asked.select(F.col(asked_key).alias("q"), F.nullif(place(asked), F.lit("")).alias("here")).distinct()
    one = F.lit(1).alias("grupo")
    pairs = terms.held_in(wanted.select(one, F.col("q").alias("termino")), entries.select(one, F.col("k").alias("texto")))
    tried = wanted.join(pairs.select(F.col("termino").alias("q"), F.col("texto").alias("k")), "q").join(entries, "k").where("here is null or w = here")
    same = F.col("k") == F.col("q")
    counts = tried.groupBy("q", "here").agg(F.count_if(same).alias("equal"), F.count(F.lit(1)).alias("holding"), F.min("k").alias("k"))
    counts = counts.select(F.col("q").alias("__q"), F.col("here").alias("__here"), F.when(F.col("equal") > 0, F.col("equal")).otherwise(F.col("holding")).alias("n"), F.when(F.col("equal") > 0, F.col("q")).otherwise(F.col("k")).alias("one"))
    out = asked.join(counts, (F.col(asked_key) == F.col("__q")) & F.nullif(place(asked), F.lit("")).eqNullSafe(F.col("__here")), "left")
    status = F.when(F.col("n") == 1, "found").when(F.col("n") > 1, "ambiguous").otherwise("missing")
    return out.select(*[asked[c] for c in (asked_key, *([within] if within else []))], F.when(F.col("n") == 1, F.col("one")).alias("match"), status.alias("status"))
