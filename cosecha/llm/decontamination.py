"""Benchmark decontamination with SimHash windows, in DataFrame functions only.

Texts are lower-cased and cut at blanks, tabs and line ends into words.  A run of five words is a shingle; a shorter
item is one shingle as a whole, and so is each run of as many words in a document.  A window of a document and an item of as many words match if the weighted Jaccard
similarity of their shingles, each weighing as often as it occurs, is ``similarity`` or more.

1. Shared shingles: every place of a text where one of its shingles is one of an item's.
2. Windows: as long as the item, laid where a shingle of the text is one of the item's, aligned to it.  The window slides
   one way or the other with every shared shingle, and each different place counts once.
3. Fingerprints: 64-bit SimHash of the window's words.  Its eight bytes are the blocks of a multi-index: an item stands
   in the index under each byte and its eight neighbours at one bit, so every item within a distance of
   2 * 8 - 1 = 15 bits meets the window in some block.  Each window and item that met within the radius is verified by
   its exact similarity; a text and item that are found equal are settled, if no other order of the item's words has
   the same shingles.
4. All others are counted exactly, at every place: no radius and no alignment decides.  A window that matches lacks so
   few of its item's shingles that it has one of the item's rarest ones; texts that have one are compared with the item.
   A shared shingle that an item holds c times counts for the windows that hold it but not its c-th place before, a
   range of starts; how many ranges hold a start is the number of shingles that its window and the item share.

Defined results: null and empty texts and items match nothing; a null item_id or doc_id is carried as such; repeated
rows count once for each (doc_id, text); an empty benchmark or corpus gives no rows; other columns do not matter.
An item below five words matches every place of its words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cosecha.llm.work import fresh, saved, small

WIDTH = 5
SIMILARITY = 0.8
RADIUS = 15
ITEM_SHINGLES = 1_000_000  # rows of three numbers that may be broadcast; more are shuffled
INDEX_ROWS = 500_000  # rows of five numbers that may be broadcast
SET_BYTES = 32 << 20  # of the items' shingles that may be broadcast
PLACES = 500_000  # rows of an id and a digest that may be broadcast
SPACE = r"[\x20\x09-\x0D]+"


def _words(text: str) -> Column:
    return F.filter(F.split(F.lower(F.col(text)), SPACE), lambda w: w != "")


def _runs(h: Column, width: int) -> Column:
    """Hashes of all runs of ``width`` word hashes, in order."""
    return F.transform(F.slice(h, F.lit(1), F.greatest(F.size(h) - (width - 1), F.lit(0))), lambda x, i: F.xxhash64(x, *[F.get(h, i + k) for k in range(1, width)]))


def _shingles(h: Column) -> Column:
    """Hashes of all runs of WIDTH word hashes, in order; of the whole, if it is shorter."""
    short = F.element_at(F.array(*[_runs(h, k) for k in range(1, WIDTH)]), F.greatest(F.size(h), F.lit(1)))
    return F.when(F.size(h) >= WIDTH, _runs(h, WIDTH)).otherwise(short)


def _simhash(h: Column) -> Column:
    """Bit b is set if it is set in more than half of the word hashes; each word counts as often as it occurs."""
    votes = lambda b: F.size(F.filter(h, lambda x: x.bitwiseAND(F.lit(1 << b if b < 63 else -(1 << 63))) != 0))
    bits = [F.when(votes(b) * 2 > F.size(h), F.lit(1 << b if b < 63 else -(1 << 63))).otherwise(F.lit(0).cast("bigint")) for b in range(64)]
    out = bits[0]
    for x in bits[1:]:
        out = out.bitwiseOR(x)
    return out


def _counted(s: Column) -> Column:
    """A multiset as a set: of equal shingles the k-th is told apart by k.  Linear once sorted."""
    once = lambda value, use: F.get(F.transform(F.array(value), use), F.lit(0))  # noqa: E731  value is evaluated once, not in each step

    def numbered(o: Column) -> Column:
        begins = F.filter(F.sequence(F.lit(0), F.size(o) - 1), lambda i: ~F.get(o, i).eqNullSafe(F.get(o, i - 1)))
        run = lambda x, length: F.transform(F.sequence(F.lit(1), length), lambda k: F.xxhash64(x, k))
        return once(begins, lambda b: F.flatten(F.transform(b, lambda p, j: run(F.get(o, p), F.coalesce(F.get(b, j + 1), F.size(o)) - p))))

    return once(F.sort_array(s), numbered)


def _light(sets: DataFrame) -> DataFrame:
    """``sets``, marked for broadcast only if its arrays are counted to be small in bytes."""
    weight = sets.agg(F.sum(F.size("item_set").cast("long") * 8 + 40)).first()[0] or 0
    return F.broadcast(sets) if weight <= SET_BYTES else sets


def _byte(f: Column, block: int) -> Column:
    return F.shiftright(f, 8 * block).bitwiseAND(F.lit(255)).cast("int")


def matches(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """(doc_id, text_key, item_id, start, n_words, similarity): for each text and item the best window, first of equals.

    ``start`` counts words from 0.  ``text_key`` is the digest that tells texts with one doc_id apart.
    """
    if not 0 <= radius <= 15:
        raise ValueError("eight blocks with one free bit guarantee a radius of 15 at most")
    items = benchmark.select("item_id", F.transform(_words("text"), lambda w: F.xxhash64(w)).alias("h")).where("size(h) > 0").distinct()
    key = F.xxhash64("item_id", "h").alias("item_key")
    items = saved(items.select("item_id", key, F.size("h").alias("n"), _shingles(F.col("h")).alias("s"), _simhash(F.col("h")).alias("f"), "h"), "items")
    sets = saved(items.select("item_id", "item_key", _counted(F.col("s")).alias("item_set")), "item-sets")
    offsets = saved(items.select("n", F.least("n", F.lit(WIDTH)).alias("width"), F.posexplode("s").alias("offset", "s")).distinct(), "item-shingles")
    known = small(saved(offsets.select("width", "s").distinct(), "known-shingles"), ITEM_SHINGLES)

    d = docs.where("text is not null").select("doc_id", F.md5("text").alias("text_key"), F.transform(_words("text"), lambda w: F.xxhash64(w)).alias("h"))
    # items below WIDTH words are one run of their own width: four widths at most
    short = sorted(r["n"] for r in items.where(F.col("n") < WIDTH).select("n").distinct().collect())
    shared = None
    for width in (*short, WIDTH):
        seeds = d.select("doc_id", "text_key", F.size("h").alias("length"), F.posexplode(_runs(F.col("h"), width)).alias("pos", "s")).join(known.where(F.col("width") == width), "s")
        shared = seeds if shared is None else shared.unionByName(seeds)
    shared = saved(shared.distinct(), "shared-shingles")
    windows = shared.join(small(offsets, ITEM_SHINGLES), ["width", "s"]).select("doc_id", "text_key", "length", (F.col("pos") - F.col("offset")).alias("start"), "n")
    windows = saved(windows.where("start >= 0 and start + n <= length").drop("length").distinct(), "windows")

    places = windows.select("doc_id", "text_key").distinct()
    # the words of the texts with windows, once more from the input: carried along, they would be copied to every shingle
    near = docs.where("text is not null").withColumn("text_key", F.md5("text")).select(F.col("doc_id").alias("d_id"), F.col("text_key").alias("d_key"), "text")
    near = near.join(small(places, PLACES), F.col("d_id").eqNullSafe(F.col("doc_id")) & (F.col("d_key") == F.col("text_key")), "left_semi").distinct()
    near = near.select("d_id", "d_key", F.transform(_words("text"), lambda w: F.xxhash64(w)).alias("h"))
    laid = windows.join(near, F.col("d_id").eqNullSafe(F.col("doc_id")) & (F.col("d_key") == F.col("text_key")))
    laid = laid.select("doc_id", "text_key", "start", "n", F.slice("h", F.col("start") + 1, F.col("n")).alias("h"))
    laid = saved(laid.select("doc_id", "text_key", "start", "n", _shingles(F.col("h")).alias("s"), _simhash(F.col("h")).alias("f")), "fingerprints")

    blocks = F.array(*[F.struct(F.lit(b).alias("block"), _byte(F.col("f"), b).alias("key")) for b in range(8)])
    flips = F.array(*map(F.lit, [0, *(1 << i for i in range(8))]))
    index = items.select("item_key", "n", F.col("f").alias("item_f"), F.explode(blocks).alias("b"))
    index = index.select("item_key", "n", "item_f", F.col("b.block").alias("block"), F.col("b.key").alias("own")).withColumn("flip", F.explode(flips))
    index = index.select("item_key", "n", "item_f", "block", F.col("own").bitwiseXOR(F.col("flip")).alias("key"))
    probe = laid.withColumn("b", F.explode(blocks)).select("doc_id", "text_key", "start", "n", "f", "s", F.col("b.block").alias("block"), F.col("b.key").alias("key"))
    met = probe.join(small(index, INDEX_ROWS), ["n", "block", "key"])
    met = met.where(F.bit_count(F.col("f").bitwiseXOR(F.col("item_f"))) <= radius)
    # a pair that meets in many blocks is verified in the first
    first = lambda b: F.bit_count(_byte(F.col("f"), b).bitwiseXOR(_byte(F.col("item_f"), b))) <= 1
    earlier = F.lit(False)
    for b in range(7):
        earlier = earlier | ((F.col("block") > b) & first(b))
    # only what met needs the shingles of its item
    met = met.where(~earlier).select("doc_id", "text_key", "start", "n", "s", "item_key").join(_light(sets), "item_key")
    both = F.size(F.array_intersect(_counted(F.col("s")), F.col("item_set")))
    met = met.withColumn("both", both).withColumn("similarity", F.col("both") / (F.size("s") + F.size("item_set") - F.col("both"))).where(F.col("similarity") >= similarity)
    # without a run of WIDTH - 1 words twice, the item's words are the only ones with its shingles
    plain = items.where(F.size(F.array_distinct(_runs(F.col("h"), WIDTH - 1))) == F.greatest(F.col("n") - (WIDTH - 2), F.lit(0))).select("item_key")
    met = saved(met.select("doc_id", "text_key", "item_key", "item_id", "start", "n", "similarity"), "verified")
    settled = met.where("similarity = 1").join(plain, "item_key", "left_semi").select("doc_id", "text_key", "item_key").distinct()
    met = met.select("doc_id", "text_key", "item_id", "start", "n", "similarity").union(_counted_windows(shared, items, settled, similarity))
    best = met.groupBy("doc_id", "text_key", "item_id").agg(F.max(F.struct("similarity", (-F.col("start")).alias("neg"), "n")).alias("best"))
    return best.select("doc_id", "text_key", "item_id", (-F.col("best.neg")).alias("start"), F.col("best.n").alias("n_words"), F.col("best.similarity").alias("similarity"))


def _counted_windows(shared: DataFrame, items: DataFrame, settled: DataFrame, similarity: float) -> DataFrame:
    """(doc_id, text_key, item_id, start, n, similarity): the best window, first of equals, of each text and item but the
    settled ones, out of all windows, from the places of their ``shared`` shingles."""
    own = items.select("item_key", F.least("n", F.lit(WIDTH)).alias("width"), F.size("s").alias("m"), F.explode("s").alias("s"))
    own = own.groupBy("item_key", "width", "m", "s").agg(F.count(F.lit(1)).cast("int").alias("c"))
    seen = shared.groupBy("width", "s").agg(F.count(F.lit(1)).alias("seen"))
    own = saved(own.join(seen, ["width", "s"], "left").fillna(0, ["seen"]), "item-counts")
    # a matching window may lack m * (1 - similarity) / (1 + similarity) of the item's shingles, so not all of one more
    rarest = Window.partitionBy("item_key").orderBy("seen", "s").rowsBetween(Window.unboundedPreceding, -1)
    lacks = F.floor(F.col("m") * ((1 - similarity) / (1 + similarity)) + 1e-9)
    rare = own.withColumn("before", F.coalesce(F.sum("c").over(rarest), F.lit(0))).where((F.col("before") <= lacks) & (F.col("seen") > 0)).select("item_key", "width", "s")
    doc = F.struct("doc_id", "text_key").alias("doc")  # one key, equal also where doc_id is null
    shared = shared.select(doc, "width", "s", "length", "pos")
    pairs = shared.join(small(rare, ITEM_SHINGLES), ["width", "s"]).select("doc", "item_key").distinct()
    pairs = pairs.join(settled.select(doc, "item_key"), ["doc", "item_key"], "left_anti")
    met = pairs.join(small(own.drop("seen"), ITEM_SHINGLES), "item_key").join(shared, ["doc", "width", "s"])
    # a text's places of one shingle
    at = met.groupBy("doc", "item_key", "width", "m", "s", "c", "length").agg(F.sort_array(F.collect_list("pos")).alias("at"))
    spans = at.select("doc", "item_key", "m", "width", "length", "c", "at", F.posexplode("at").alias("k", "pos"))
    low = F.greatest(F.col("pos") - F.col("m") + 1, F.coalesce(F.get("at", F.col("k") - F.col("c")) + 1, F.lit(0)), F.lit(0))
    high = F.least("pos", F.col("length") - (F.col("m") + F.col("width") - 1))
    spans = spans.select("doc", "item_key", "m", low.alias("low"), high.alias("high")).where("low <= high")
    steps = spans.select("doc", "item_key", "m", F.explode(F.array(F.struct(F.col("low").alias("start"), F.lit(1).alias("step")), F.struct((F.col("high") + 1).alias("start"), F.lit(-1).alias("step")))).alias("x"))
    steps = steps.groupBy("doc", "item_key", "m", "x.start").agg(F.sum("x.step").alias("step"))
    both = F.sum("step").over(Window.partitionBy("doc", "item_key", "m").orderBy("start"))
    steps = steps.withColumn("similarity", both / (2 * F.col("m") - both)).where(F.col("similarity") >= similarity)
    best = steps.groupBy("doc", "item_key").agg(F.max(F.struct("similarity", (-F.col("start")).alias("neg"))).alias("best"))
    return best.join(items.select("item_key", "item_id", "n"), "item_key").select("doc.doc_id", "doc.text_key", "item_id", (-F.col("best.neg")).alias("start"), "n", F.col("best.similarity").alias("similarity"))


def without_leaks(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the rows whose text holds a benchmark item; all other rows and all columns stay as they are."""
    doc, key = fresh(docs, "bad_id", "bad_key")
    bad = saved(matches(docs, benchmark, **options).select(F.col("doc_id").alias(doc), F.col("text_key").alias(key)).distinct(), "leaks")
    hit = F.col("doc_id").eqNullSafe(F.col(doc)) & (F.md5("text") == F.col(key))
    return docs.join(small(bad, PLACES), hit, "left_anti")


def op2(spark, sf_dir: str) -> DataFrame:
    """(doc_id, item_id, start, n_words, similarity): the benchmark items that each document holds."""
    docs, items = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return matches(docs, items).drop("text_key")
