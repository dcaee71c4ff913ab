"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Documents of a source are dealt by a hash into blocks of about a thousand. A source's target is a number
of whole passes over it and a rest; the rest takes blocks in a permuted order, and of the block at the
border documents in a permuted order. That gives each source an exact number of block draws. A binary tree
over the output shards splits these quotas: at each node the draws that go left are one draw from the
multivariate hypergeometric distribution, so every shard gets an exact share of an exact total. The draws
of a source are numbered in permuted order and each shard takes a disjoint run of them; rows are then
shuffled inside their shard. Everything follows from the seed and the rows, so reruns agree.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seqframe.llm.names import under_plain_names
from seqframe.session import broadcast_if_small, written

WORD = r"[^\x20\x09-\x0D]+"
BLOCK_DOCS = 1024
#: Words of a shard, about; and the least number of shards.
SHARD_WORDS, SHARDS = 4 << 20, 16
SEED = 20240601


def word_count(text) -> F.Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, passes: float = 2.0) -> DataFrame:
    """(source, size, docs, target): one row per source, null a source of its own.

    Sources by code point, null last, have the weights in turn. Targets share ``share`` of all sizes by weight
    and stop at ``passes`` times the source's size; the excess is shared again until none is above. That is
    one level: each target is the smaller of its limit and weight times the level.
    """
    sources = sized.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("docs"))
    at = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (at % len(weights) + 1).cast("int"))
    sources = sources.withColumn("weight", weight).withColumn("limit", passes * F.col("size"))
    order = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").isNull(), "source")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    sources = sources.withColumn("total", share * F.sum("size").over(every))
    sources = sources.withColumn("level", (F.col("total") - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    # The level holds from the first source, in this order, whose limit it does not reach.
    sources = sources.withColumn("level", F.max(F.when(F.col("level") * F.col("weight") <= F.col("limit"), F.col("level"))).over(every))
    return sources.select("source", "size", "docs", F.least("limit", F.coalesce(F.col("level") * F.col("weight"), F.col("limit"))).alias("target"))


def _split(seed: int):
    """Split each node's quotas between the two halves of its shards."""

    def run(frames):
        for frame in frames:
            rows = []
            for low, high, sources, quotas in zip(frame.low.tolist(), frame.high.tolist(), frame.sources, frame.quotas, strict=True):
                if high - low == 1:
                    rows.append((low, high, sources, quotas))
                    continue
                quotas = np.asarray(quotas, np.int64)
                middle, total = (low + high) // 2, int(quotas.sum())
                ends = [total * at // (high - low) for at in (0, middle - low)]
                draw = np.random.Generator(np.random.PCG64([seed, low, high]))
                left = draw.multivariate_hypergeometric(quotas, ends[1], method="marginals") if total else quotas
                rows += [(low, middle, sources, left.tolist()), (middle, high, sources, (quotas - left).tolist())]
            yield pd.DataFrame(rows, columns=["low", "high", "sources", "quotas"])

    return run


def shard_quotas(draws: DataFrame, shards: int, seed: int = SEED) -> DataFrame:
    """(shard, source_key, quota) from (source_key, draws), one row per source: the splitting tree."""
    node = draws.groupBy().agg(F.sort_array(F.collect_list(F.struct("source_key", "draws"))).alias("q")).select(F.lit(0).alias("low"), F.lit(shards).alias("high"), F.col("q.source_key").alias("sources"), F.col("q.draws").alias("quotas"))
    for level in range(max(shards - 1, 0).bit_length()):
        if level == 10:  # a thousand nodes by now: the rest of the tree grows in parallel
            node = node.repartition("low")
        node = node.mapInPandas(_split(seed), "low int, high int, sources array<string>, quotas array<long>")
    pairs = node.select(F.col("low").alias("shard"), F.explode(F.arrays_zip("sources", "quotas")).alias("p"))
    return pairs.select("shard", F.col("p.sources").alias("source_key"), F.col("p.quotas").alias("quota")).filter("quota > 0")


def keyed(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """``docs`` with _h, a hash of id and text, and _source_key, which tells null from any name."""
    text, source = F.col(text_col).cast("string"), F.col(source_col).cast("string")
    return docs.withColumns({"_h": F.xxhash64(F.coalesce(F.col(id_col).cast("string"), F.lit("")), text), "_source_key": F.when(source.isNull(), "").otherwise(F.concat(F.lit("="), source))})


def repeated(rows: DataFrame) -> DataFrame:
    return rows.groupBy("_h").agg(F.count("*").alias("_n")).filter("_n > 1").select(F.col("_h").alias("_h_"))


def numbered(rows: DataFrame, again: DataFrame) -> DataFrame:
    """``rows`` with _row, a name for each row; only rows in ``again``, which occur repeatedly, are numbered."""
    same = F.col("_h") == F.col("_h_")
    many = rows.join(again, same, "left_semi").withColumn("_copy", F.row_number().over(Window.partitionBy("_h").orderBy("_source_key")))
    return rows.join(again, same, "left_anti").withColumn("_copy", F.lit(1)).unionByName(many).withColumn("_row", F.xxhash64("_h", "_copy")).drop("_copy")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, passes: float = 2.0, shards: int | None = None, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """(sized, draws) (action).

    sized: one row per input row with row, id, source, size, source_size, target.
    draws: one row per time that the mix takes a row, with row, shard and place (its order in the shard).
    Null and empty texts have size 0; null is a source of its own; equal rows are drawn one by one. ``row``
    names a row by its id, a hash of its text and a number among equal ones.
    """
    sized = keyed(docs, id_col, text_col, source_col).select("_h", F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), "_source_key", word_count(F.col(text_col).cast("string")).alias("size"))
    sized = written(sized)
    sized = numbered(sized, written(repeated(sized))).drop("_h").withColumnsRenamed({"_row": "row", "_source_key": "source_key"})

    sources = written(source_targets(sized, weights, share, passes)).withColumn("source_key", F.when(F.col("source").isNull(), "").otherwise(F.concat(F.lit("="), "source")))
    plan = sources.select("source_key", F.col("size").alias("source_size"), "target", F.greatest(F.lit(1), F.ceil(F.col("docs") / BLOCK_DOCS)).alias("blocks"), F.floor(F.when(F.col("size") > 0, F.col("target") / F.col("size")).otherwise(0)).alias("whole"))
    plan = plan.withColumn("rest", F.greatest(F.col("target") - F.col("whole") * F.col("source_size"), F.lit(0.0)))
    sized = sized.join(broadcast_if_small(plan), "source_key").withColumn("block", F.pmod(F.xxhash64("row", F.lit(seed)), F.col("blocks")))
    sized = written(sized)

    # Permuted blocks of the rest, each with the words before it; the one at the border takes some of its rows.
    blocks = sized.groupBy("source_key", "block", "rest", "whole", "blocks").agg(F.sum("size").alias("words"))
    permuted = Window.partitionBy("source_key").orderBy(F.xxhash64("block", F.lit(seed + 1)), "block")
    blocks = blocks.withColumn("rank", F.row_number().over(permuted) - 1).withColumn("before", F.coalesce(F.sum("words").over(permuted.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    blocks = written(blocks.withColumn("some", F.col("before") < F.col("rest")))
    drawn = blocks.groupBy("source_key").agg((F.max("whole") * F.count("*") + F.sum(F.col("some").cast("long"))).alias("draws"))
    if shards is None:
        shards = max(SHARDS, int((sources.agg(F.sum("target")).first()[0] or 0) // SHARD_WORDS))
    quotas = shard_quotas(drawn, shards, seed)
    runs = quotas.withColumn("end", F.sum("quota").over(Window.partitionBy("source_key").orderBy("shard")))
    taken = runs.select("source_key", "shard", F.explode(F.sequence(F.col("end") - F.col("quota"), F.col("end") - 1)).alias("draw"))

    # Draw k of a source: block of rank k in the first pass, and so on; the rest comes last.
    present = blocks.withColumn("present", F.count("*").over(Window.partitionBy("source_key")))
    every = present.select("source_key", "block", "before", "rest", F.explode(F.sequence(F.lit(0), F.when(F.col("some"), F.col("whole")).otherwise(F.col("whole") - 1).cast("int"))).alias("pass"), "whole", "present", "rank", "some").filter("pass >= 0 and (pass < whole or some)")
    order = every.select("source_key", "block", (F.col("pass") == F.col("whole")).alias("partly"), (F.col("rest") - F.col("before")).alias("quota_left"), (F.col("pass") * F.col("present") + F.col("rank")).alias("draw"))
    dealt = written(order.join(taken, ["source_key", "draw"]))

    rows = sized.select("source_key", "block", "row", "size").join(dealt, ["source_key", "block"])
    within = Window.partitionBy("source_key", "block").orderBy(F.xxhash64("row", F.lit(seed + 2)), "row")
    whole, partly = rows.filter("not partly"), rows.filter("partly")
    # Rows while they fit, then the one other row, if any, that comes nearest to what is missing.
    block = Window.partitionBy("source_key", "block")
    partly = partly.withColumn("through", F.sum("size").over(within)).withColumn("fits", F.col("through") <= F.col("quota_left"))
    partly = partly.withColumn("missing", F.col("quota_left") - F.coalesce(F.max(F.when(F.col("fits"), F.col("through"))).over(block), F.lit(0)))
    partly = partly.withColumn("best", F.min(F.when(~F.col("fits"), F.struct(F.abs(F.col("size") - F.col("missing")).alias("off"), "row"))).over(block))
    partly = partly.filter(F.col("fits") | ((F.col("row") == F.col("best.row")) & (F.col("best.off") < F.col("missing"))))
    draws = whole.select("row", "shard", "draw").union(partly.select("row", "shard", "draw"))
    draws = draws.withColumn("place", F.xxhash64("row", "draw", F.lit(seed + 3)))
    return sized.select("row", "id", "source", "size", "source_size", "target"), draws.select("row", "shard", "draw", "place")


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, with mix_shard, each shard shuffled (action).

    Columns are kept, in their order; mix_shard is the last, and a column of that name is replaced.
    """
    docs = docs.drop("mix_shard")
    return under_plain_names(docs, lambda d, i, t, s: _mixed_documents(d, i, t, s, **options), id_col, text_col, source_col)


def _mixed_documents(docs: DataFrame, id_col: str, text_col: str, source_col: str, **options) -> DataFrame:
    _, draws = mix(docs, id_col, text_col, source_col, **options)
    rows = keyed(docs, id_col, text_col, source_col)
    rows = numbered(rows, written(repeated(rows.select("_h"))))
    draws = draws.select(F.col("row").alias("_drawn"), F.col("shard").alias("_shard"), F.col("place").alias("_place"))
    out = rows.join(draws, F.col("_row") == F.col("_drawn")).repartition("_shard").sortWithinPartitions("_shard", "_place")
    return out.select(*docs.columns, F.col("_shard").alias("mix_shard"))


def mix_report(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """One row per input row: ``id_col``, size, source_size, target, taken (words, repeats counted)."""
    sized, draws = mix(docs, id_col, **options)
    times = draws.groupBy("row").agg(F.count("*").alias("times"))
    out = sized.join(times, "row", "left")
    return out.select(F.col("id").alias(id_col), "size", "source_size", "target", (F.col("size") * F.coalesce("times", F.lit(0))).alias("taken"), F.coalesce("times", F.lit(0)).alias("times"))
