"""Benchmark decontamination: SimHash over windows as long as a benchmark item.

All of it is DataFrame work. A document's windows of an item's length are taken at every start from which the
weights of the item's shingles in the window reach the least similarity's share of the item's own: no window
that is similar enough has less, so none is lost. Each different window gets a 64-bit SimHash of its weighted shingles. Fingerprints within a radius agree in
one of radius + 1 blocks of their bits, so an equality join on blocks finds all of them; these candidates
are verified by the exact weighted Jaccard similarity of their shingles.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqframe.operators.shaping import computed_once
from seqframe.llm.names import under_plain_names
from seqframe.session import broadcast_if_small, written

#: Words of a shingle, least similarity, and bits in which two fingerprints may differ.
SHINGLE, SIMILARITY, RADIUS = 5, 0.8, 16
#: So many item shingles are tested inside the scan; a larger benchmark is met by a join.
INLINE = 50_000
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _words(text: str) -> Column:
    return F.coalesce(F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def _shingles(words: str, n: int) -> Column:
    """Hashes of all runs of n words, in order; empty for fewer words."""
    at = F.when(F.size(words) >= n, F.sequence(F.lit(1), F.size(words) - (n - 1))).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.xxhash64(F.slice(words, i, n)))


def _fingerprints(rows: DataFrame, key: str) -> DataFrame:
    """(key, fp) of (key, shingle, weight): bit k is set where the weights of shingles with bit k prevail."""
    bits = [F.sum(F.when(F.shiftright("shingle", k).bitwiseAND(F.lit(1)) == 1, F.col("weight")).otherwise(-F.col("weight"))).alias(f"b{k}") for k in range(64)]
    sums = rows.groupBy(key).agg(*bits)
    one = lambda k: F.when(F.col(f"b{k}") > 0, F.lit(1 << k if k < 63 else -(1 << 63)).cast("long")).otherwise(F.lit(0).cast("long"))
    return sums.select(key, reduce(lambda a, b: a.bitwiseOR(b), map(one, range(64))).alias("fp"))


def _blocks(radius: int) -> Column:
    """The fingerprint cut into radius + 1 runs of bits, each with its number."""
    edges = [64 * k // (radius + 1) for k in range(radius + 2)]
    return F.explode(F.array(*(F.struct(F.lit(k).alias("block"), F.shiftrightunsigned("fp", low).bitwiseAND(F.lit((1 << (high - low)) - 1)).alias("value")) for k, (low, high) in enumerate(zip(edges, edges[1:], strict=False)))))


def contaminations(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", n: int = SHINGLE, similarity: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """(id_col, item_col, start, words, similarity): items found in documents, at their best place (action).

    A document holds an item if a window of as many words has a weighted Jaccard similarity of n-word shingles
    of ``similarity`` or more. Words are runs of letters and digits, lower-cased; start counts words from 0.
    Items of fewer than n words are one shingle; null, empty and wordless texts hold and are nothing. A
    shingle weighs the logarithm of its rarity among the different items, whatever the documents; one of no
    item weighs as one of a single item.
    Equal rows give one row; an item met twice in a document gives its best place, the first of ties.
    """
    items = items.select(F.col(item_col).alias("item"), _words(item_text_col).alias("w")).withColumn("m", F.size("w")).filter("m > 0").dropDuplicates(["item", "w"])
    items = items.withColumn("k", F.least(F.lit(n), "m"))
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    sizes = [r.k for r in items.select("k").distinct().orderBy("k").collect()]  # n values at most
    found = [_of_size(docs, items.filter(F.col("k") == k), k, similarity, radius) for k in sizes]
    if not found:
        found = [_of_size(docs, items, n, similarity, radius)]
    out = reduce(DataFrame.union, found).groupBy("id", "item").agg(F.max(F.struct("similarity", (-F.col("start")).alias("back"), F.col("m").alias("words"))).alias("best"))
    return out.select(F.col("id").alias(id_col), F.col("item").alias(item_col), (-F.col("best.back")).cast("long").alias("start"), F.col("best.words").cast("long").alias("words"), F.col("best.similarity").alias("similarity"))


def _of_size(docs: DataFrame, items: DataFrame, k: int, similarity: float, radius: int) -> DataFrame:
    items = written(items.select("item", "m", _shingles("w", k).alias("s")).withColumn("own", F.xxhash64("item", "s")))
    places = items.select("own", "m", F.explode(F.array_distinct("s")).alias("shingle"))
    total = float(items.select("s").distinct().count())
    known = [r.shingle for r in places.select("shingle").distinct().limit(INLINE + 1).collect()]

    hashed = computed_once(docs, ["id", F.xxhash64("id", "text").alias("row")], w=_words("text"))
    hashed = computed_once(hashed, ["id", "row"], s=_shingles("w", k))
    if len(known) <= INLINE:
        hits = hashed.filter(F.exists("s", lambda x: x.isin(known)))
    else:
        rows = hashed.select("row", F.explode("s").alias("shingle")).join(places.select("shingle").distinct(), "shingle", "left_semi")
        hits = hashed.join(rows.select("row").distinct(), "row", "left_semi")
    hits = written(hits)

    met = hits.select("row", F.posexplode("s").alias("at", "shingle")).join(broadcast_if_small(places.select("shingle").distinct()), "shingle", "left_semi")
    share = items.select("s").distinct().select(F.explode(F.array_distinct("s")).alias("shingle")).groupBy("shingle").agg(F.count("*").alias("df"))
    weights = broadcast_if_small(written(share.select("shingle", F.log1p(F.lit(total) / F.col("df")).alias("weight"))))

    def weighed(rows: DataFrame) -> DataFrame:
        return rows.join(weights, "shingle", "left").withColumn("weight", F.coalesce("weight", F.log1p(F.lit(total))))

    # A shingle at place p counts for starts p - (m - k) to p: the sum changes at these ends only.
    heavy = written(weighed(places).withColumn("least", similarity * F.sum("weight").over(Window.partitionBy("own")) - 1e-6))
    shared = met.join(broadcast_if_small(heavy), "shingle")
    enough = shared.groupBy("row", "own").agg(F.sum("weight").alias("sum"), F.any_value("least").alias("least")).filter("sum >= least").select("row", "own")
    shared = shared.join(enough, ["row", "own"], "left_semi")
    ends = shared.select("row", "own", "m", "least", F.explode(F.array(F.struct((F.col("at") - (F.col("m") - k)).alias("p"), F.col("weight").alias("d")), F.struct((F.col("at") + 1).alias("p"), (-F.col("weight")).alias("d")))).alias("e"))
    ends = ends.groupBy("row", "own", "m", "least", "e.p").agg(F.sum("e.d").alias("d"))
    order = Window.partitionBy("row", "own").orderBy("p")
    runs = ends.select("row", "m", "least", F.greatest("p", F.lit(0)).alias("low"), (F.lead("p").over(order) - 1).alias("high"), F.sum("d").over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("sum"))
    starts = runs.filter("sum >= least and low <= high").select("row", "m", F.explode(F.sequence("low", "high")).alias("start"))
    spans = starts.groupBy("row", "m").agg(F.collect_set("start").alias("starts"))
    windows = hits.select("id", "row", "s").join(spans, "row").select("id", "m", F.explode(F.transform("starts", lambda a: F.struct(a.alias("start"), F.slice("s", a + 1, F.col("m") - (k - 1)).alias("win")))).alias("x"))
    windows = written(windows.select("id", "m", "x.start", "x.win", F.xxhash64("x.win", "m").alias("key")).filter(F.size("win") > 0))

    different = windows.groupBy("key").agg(F.any_value("m").alias("m"), F.any_value("win").alias("win"))
    rows = written(weighed(different.select("key", "m", F.explode(F.array_distinct("win")).alias("shingle"))))
    own = written(weighed(items.select(F.col("own").alias("key"), "item", "m", F.explode(F.array_distinct("s")).alias("shingle"))))
    size = lambda side: side.groupBy("key", "m").agg(F.sum("weight").alias("sum"))
    cut = lambda side: _fingerprints(side, "key").join(size(side), "key").withColumn("b", _blocks(radius)).select("key", "m", "fp", "sum", "b.*")
    x = cut(rows).select("m", "block", "value", F.col("key").alias("key"), F.col("fp").alias("fp_x"), F.col("sum").alias("sum_x"))
    y = cut(own).select("m", "block", "value", F.col("key").alias("own"), F.col("fp").alias("fp_y"), F.col("sum").alias("sum_y"))
    pairs = x.join(y, ["m", "block", "value"]).filter(F.bit_count(F.col("fp_x").bitwiseXOR(F.col("fp_y"))) <= radius)
    pairs = pairs.select("key", "own", "sum_x", "sum_y").distinct()
    both = pairs.join(rows.select("key", "shingle", "weight"), "key").join(own.select(F.col("key").alias("own"), "item", "shingle"), ["own", "shingle"])
    both = both.groupBy("key", "own", "item", "sum_x", "sum_y").agg(F.sum("weight").alias("common"))
    alike = both.withColumn("similarity", F.col("common") / (F.col("sum_x") + F.col("sum_y") - F.col("common"))).filter(F.col("similarity") >= similarity - 1e-9)
    return windows.select("id", "m", "start", "key").join(alike.select("key", "item", "similarity"), "key").select("id", "item", "start", "m", "similarity")


def without_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the rows that hold an item (action). All columns are kept; equal or null ids do not matter."""
    return under_plain_names(docs, lambda d, i, t: _without_contaminated(d, items, i, t, **options), id_col, text_col)


def _without_contaminated(docs: DataFrame, items: DataFrame, id_col: str, text_col: str, **options) -> DataFrame:
    named = docs.withColumn("_row", F.xxhash64(F.col(id_col).isNull(), id_col, text_col))
    bad = contaminations(named.select("_row", text_col), items, "_row", text_col, **options).select(F.col("_row").alias("_bad")).distinct()
    return named.join(written(bad), F.col("_row") == F.col("_bad"), "left_anti").drop("_row")
