"""Secret scans that link the parts of a credential, in DataFrame functions only.

Strong parts count by themselves: values assigned to a secret's name, access identifiers, long hexadecimal runs.  Weak
ones are everywhere, and are reported only beside what they would be used with:

* an identifier (``user = ...``, ``client_id: ...``) needs a secret in reach,
* a loose secret (``key: ...``, or a bare run of mixed letters and digits) needs an identifier or an access identifier,
* an endpoint (a URL, ``host = ...``) needs both.

In reach: in the same scope, which blank lines end, and with starts at most ``REACH`` code points apart.  A part that
overlaps a stronger one is none.

1. One pass over the texts finds the parts of each kind.  Positions are running sums over the pieces between matches and
   the matches, in blocks of the square root of their number.  Texts are not shuffled.
2. Only texts with an identifier and a secret of some kind, and a weak part among them, go on, each different text once.
3. Parts of a text are sorted, which gives scopes and overlaps.
4. Interval join: the interval in reach of a weak part meets bins as wide as the reach; a bin holds the first and last
   start of each role, which decides exactly whether one is in reach, so pairs are never listed.

Defined results: a null text is empty; equal texts have equal spans, whatever their ids; a row without a doc_id and rows
that share one are rows of their own; other columns do not matter; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cosecha.llm.work import saved

KINDS = ("assign", "access", "hex", "endpoint", "identifier", "loose")
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
ENDPOINT = r"""(?i)(?:(?:https?|ftps?|sftp|ssh|git|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|rediss?|amqps?|s3)://[^\x20\x09-\x0D"'<>]+|(?:host(?:name)?|endpoint|server|base_?url)["']?\x20*[:=]\x20*["']?[A-Za-z0-9._:/-]{4,})"""
IDENTIFIER = r"""(?i)(?:user(?:name)?|login|account|client_?id|key_?id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9._@+-]{3,}"""
LOOSE = r"""(?:(?i:pass|pwd|key|auth|credentials?|signature)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{6,}|[A-Za-z0-9+/]{20,}=*)"""
NAMED = r"[:=]"  # a loose secret with a name; one without must mix letters of either case and digits
BLANK = r"\n[\x20\x09\x0D]*\n"
LEAST = 6  # characters of an assigned value
REACH = 300
SCOPE_END = -1  # rank of what ends a scope; ranks of parts are places in KINDS


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is computed once."""
    return F.transform(F.array(value), then)[0]


def _spans(text: Column, pattern: str, rank: int, kept: Column | None = None) -> Column:
    """[(start, rank, end)] of the leftmost matches that do not overlap, in code points; ``kept`` says of each if it counts."""

    def placed(pairs: Column) -> Column:
        # pairs: (code points before a match since the last one, those of the match)
        def at(width: Column) -> Column:
            length = lambda a, p: a + p["gap"] + p["own"]
            zero = F.lit(0).cast("long")
            blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(pairs) - 1) / width).cast("int")), lambda j: F.aggregate(F.slice(pairs, j * width + 1, width), zero, length))

            def within(sums: Column) -> Column:
                bases = F.transform(sums, lambda _, j: F.aggregate(F.slice(sums, F.lit(1), j), zero, lambda a, b: a + b))

                def spans(base: Column) -> Column:
                    def span(p: Column, i: Column) -> Column:
                        block = F.floor(i / width).cast("int")
                        start = F.get(base, block) + F.aggregate(F.slice(pairs, block * width + 1, i - block * width), zero, length) + p["gap"]
                        return _let(start, lambda s: F.struct(s.alias("start"), F.lit(rank).alias("rank"), (s + p["own"]).alias("end"), p["kept"].alias("kept")))

                    return F.transform(pairs, span)

                return _let(bases, spans)

            return _let(blocks, within)

        return _let(F.ceil(F.sqrt(F.size(pairs))).cast("int"), at)

    def found(matches: Column) -> Column:
        pieces = F.split(text, pattern, -1)
        joined = F.zip_with(matches, pieces, lambda m, p: F.struct(F.length(p).cast("long").alias("gap"), F.length(m).cast("long").alias("own"), m.alias("m")))
        pairs = F.filter(joined, lambda x: x["own"].isNotNull())
        keep = F.transform(matches, lambda m: F.lit(True)) if kept is None else kept
        pairs = F.zip_with(pairs, keep, lambda p, k: F.struct(p["gap"].alias("gap"), p["own"].alias("own"), k.alias("kept")))
        spans = F.filter(_let(pairs, placed), lambda s: s["kept"])
        return F.when(F.size(matches) > 0, F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"))))

    return F.coalesce(_let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), found), _none())


def _none() -> Column:
    return F.array().cast("array<struct<start:bigint,rank:int,end:bigint>>")


def _has(spans: Column | str) -> Column:
    return F.size(spans) > 0


def _written(spans: Column) -> Column:
    """kind:start:end of sorted spans, comma-joined."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["rank"]), s["start"], s["end"])), ",")


def _parts(docs: DataFrame) -> DataFrame:
    """(doc_id, key, base, parts) of each row: the strong spans in order, and those of all kinds where they may be linked."""
    text = F.coalesce("text", F.lit(""))
    named = text.contains(":") | text.contains("=")
    when = lambda c, spans: F.when(c, spans).otherwise(_none())
    values = F.transform(F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2)), lambda v: F.length(v) >= LEAST)
    strong = F.concat(when(named, _spans(text, ASSIGN, 0, values)), when(text.contains("AKIA"), _spans(text, ACCESS, 1)), _spans(text, HEX, 2))
    identifiers = when(named, _spans(text, IDENTIFIER, 4))
    mixed = F.transform(F.regexp_extract_all(text, F.lit(LOOSE), F.lit(0)), lambda m: m.rlike(NAMED) | (m.rlike("[A-Z]") & m.rlike("[a-z]") & m.rlike("[0-9]")))

    def linked(known: Column) -> Column:
        """Of texts with an identifier of either kind, the rest."""
        named_some = F.exists(known, lambda s: s["rank"].isin(1, 4))
        return F.when(named_some, F.concat(known, _spans(text, LOOSE, 5, mixed), _spans(text, ENDPOINT, 3)))

    def useful(parts: Column) -> Column:
        secret, weak = F.exists(parts, lambda s: s["rank"].isin(0, 2, 5)), F.exists(parts, lambda s: s["rank"] > 2)
        return F.when(secret & weak, F.concat(parts, _spans(text, BLANK, SCOPE_END)))

    d = docs.select("doc_id", F.array_sort(strong).alias("base"), identifiers.alias("weak"), text.alias("text"))
    parts = _let(_let(F.concat("base", "weak"), linked), useful)
    return d.select("doc_id", F.md5("text").alias("key"), "base", parts.alias("parts"))


def _reported(parts: DataFrame, reach: int) -> DataFrame:
    """(key, start, rank, end) of the weak parts of (key, parts) whose complements are in reach."""
    rows = parts.select("key", F.explode("parts").alias("p")).select("key", "p.start", "p.rank", "p.end")
    up = Window.partitionBy("key").orderBy("start", "rank", "end").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    down = Window.partitionBy("key").orderBy(F.desc("start"), F.desc("rank"), F.desc("end")).rowsBetween(Window.unboundedPreceding, -1)
    rank = F.col("rank")

    def overlaps(stronger: Column) -> Column:
        before, after = F.max(F.when(stronger, F.col("end"))).over(up), F.min(F.when(stronger, F.col("start"))).over(down)
        return F.coalesce(before > F.col("start"), F.lit(False)) | F.coalesce(after < F.col("end"), F.lit(False))

    rows = rows.withColumns({"scope": F.sum((rank == SCOPE_END).cast("int")).over(up), "strong": overlaps(rank.between(0, 2)), "named": overlaps(rank.between(0, 4))})
    rows = rows.where((rank >= 0) & ((rank <= 2) | (rank < 5) & ~F.col("strong") | (rank == 5) & ~F.col("named")))
    rows = rows.select("key", "scope", F.floor(F.col("start") / reach).alias("bin"), "start", "rank", "end")
    rows = saved(rows, "parts")

    ends = {}
    for role, ranks in (("identifier", (1, 4)), ("secret", (0, 2, 5))):
        of = F.when(rank.isin(*ranks), F.col("start"))
        ends |= {f"first_{role}": F.min(of), f"last_{role}": F.max(of)}
    bins = rows.where(rank != 3).groupBy("key", "scope", "bin").agg(*[v.alias(k) for k, v in ends.items()])
    weak = rows.where(rank > 2).withColumn("near", F.explode(F.array(F.col("bin") - 1, F.col("bin"), F.col("bin") + 1)))
    met = weak.drop("bin").join(bins.withColumnRenamed("bin", "near"), ["key", "scope", "near"])

    def in_reach(role: str) -> Column:
        # a bin is as wide as the reach, so its end that is nearer to the part decides
        low, high = F.col("start") - reach, F.col("start") + reach
        return F.coalesce(F.col(f"first_{role}").between(low, high) | F.col(f"last_{role}").between(low, high), F.lit(False))

    found = met.groupBy("key", "start", "rank", "end").agg(F.max(in_reach("identifier")).alias("identifier"), F.max(in_reach("secret")).alias("secret"))
    return found.where(F.when(rank == 3, F.col("identifier") & F.col("secret")).when(rank == 4, F.col("secret")).otherwise(F.col("identifier"))).select("key", "start", "rank", "end")


def secrets(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """(doc_id, base, spans) of every row: the strong spans, and all; arrays of (start, rank, end), rank a place in KINDS."""
    found = saved(_parts(docs), "secrets")
    texts = found.where("parts is not null").groupBy("key").agg(F.any_value("parts").alias("parts"))
    added = _reported(texts, reach).groupBy("key").agg(F.collect_list(F.struct("start", "rank", "end")).alias("added"))
    joined = found.drop("parts").join(added, "key", "left")
    return joined.select("doc_id", "base", F.array_sort(F.concat("base", F.coalesce("added", _none()))).alias("spans"))


def op12(spark, sf_dir: str) -> DataFrame:
    """One row per document: strong spans by kind, their digest, and all spans."""
    found = secrets(spark.read.parquet(f"{sf_dir}/documents.parquet"))

    def count(rank: int) -> Column:
        return F.size(F.filter("base", lambda s: s["rank"] == rank)).cast("long").alias(f"n_{KINDS[rank]}")

    counts = [count(r) for r in range(3)]
    return found.select("doc_id", *counts, F.sha2(_written(F.col("base")), 256).alias("base_sha256"), _written(F.col("spans")).alias("spans"))


def _sql_spans(rank: int, pattern: str, kept: str = "true") -> str:
    p = "'" + pattern.replace("'", "''") + "'"
    return f"""
  SELECT row_id, start, {rank} AS rank, start + length(m) AS stop FROM (
    SELECT row_id, m, v, i, CAST(sum(length(g) + coalesce(length(m), 0)) OVER (PARTITION BY row_id ORDER BY i) AS BIGINT) - coalesce(length(m), 0) AS start FROM (
      SELECT row_id, unnest(string_split_regex(text, {p})) AS g, unnest(list_concat(regexp_extract_all(text, {p}), [NULL])) AS m,
             unnest(list_concat(regexp_extract_all(text, {p}, {2 if rank == 0 else 0}), [NULL])) AS v, generate_subscripts(string_split_regex(text, {p}), 1) AS i
      FROM d WHERE regexp_matches(text, {p})))
  WHERE m IS NOT NULL AND {kept}"""


OP12_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS text FROM documents),
b AS ({_sql_spans(0, ASSIGN, "length(v) >= 6")}
  UNION ALL {_sql_spans(1, ACCESS)}
  UNION ALL {_sql_spans(2, HEX)}),
w AS ({_sql_spans(3, ENDPOINT)}
  UNION ALL {_sql_spans(4, IDENTIFIER)}
  UNION ALL {_sql_spans(5, LOOSE, f"(regexp_matches(m, '{NAMED}') OR regexp_matches(m, '[A-Z]') AND regexp_matches(m, '[a-z]') AND regexp_matches(m, '[0-9]'))")}),
e AS ({_sql_spans(-1, BLANK)}),
o AS (
  SELECT * FROM w WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.row_id = w.row_id AND b.start < w.stop AND w.start < b.stop)
  AND NOT (w.rank = 5 AND EXISTS (SELECT 1 FROM w x WHERE x.rank < 5 AND x.row_id = w.row_id AND x.start < w.stop AND w.start < x.stop))),
s AS (SELECT x.*, (SELECT count(*) FROM e WHERE e.row_id = x.row_id AND e.start <= x.start) AS scope FROM (SELECT * FROM b UNION ALL SELECT * FROM o) x),
l AS (
  SELECT x.row_id, x.start, x.rank, x.stop, bool_or(y.rank IN (1, 4)) AS identifier, bool_or(y.rank IN (0, 2, 5)) AS secret
  FROM s x JOIN s y ON x.row_id = y.row_id AND x.scope = y.scope AND abs(x.start - y.start) <= {REACH} WHERE x.rank > 2 GROUP BY 1, 2, 3, 4),
a AS (
  SELECT row_id, start, rank, stop FROM b UNION ALL
  SELECT row_id, start, rank, stop FROM l WHERE CASE rank WHEN 3 THEN identifier AND secret WHEN 4 THEN secret ELSE identifier END),
t AS (SELECT *, {list(KINDS)}[rank + 1] || ':' || start || ':' || stop AS span FROM a),
g AS (
  SELECT row_id, count(*) FILTER (WHERE rank = 0) AS n_assign, count(*) FILTER (WHERE rank = 1) AS n_access, count(*) FILTER (WHERE rank = 2) AS n_hex,
         string_agg(span, ',' ORDER BY start, rank) FILTER (WHERE rank < 3) AS base, string_agg(span, ',' ORDER BY start, rank) AS spans
  FROM t GROUP BY 1)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (row_id)
"""
