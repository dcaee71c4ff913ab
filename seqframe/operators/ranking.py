"""Exact positions and ranks over any amount of data, and the caps built on them.

A window function ranks a group inside one task, which fails when one group holds a third of the
rows. Here the keys are range-sorted on (group, order), so a large group spans many partitions, and
written once; the position of a row is then the offset of its partition plus its index in it, and
its rank is its position minus the first position of its group. Only key columns travel.
"""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqframe.session import broadcast_if_small, written

_INDEX_BITS = 33  # monotonically_increasing_id: partition number above, row index below


def ordinals(df: DataFrame, order: Sequence[str], name: str = "ord") -> DataFrame:
    """Add the dense 0-based position of every row under a total order (action: one sorted write)."""
    return dense(written(in_order(df, order)), name)


def in_order(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Rows range-sorted, with their partition and index in ``_at``; ``dense`` reads it once they are written."""
    ordered = df.repartitionByRange(*[F.col(c) for c in order]).sortWithinPartitions(*order)
    return ordered.withColumn("_at", F.monotonically_increasing_id())


def dense(sorted_rows: DataFrame, name: str) -> DataFrame:
    """Turn partition-and-index ids into dense positions. One offset row per partition, which is broadcast: the rows stay where they are."""
    part = F.shiftright("_at", _INDEX_BITS)
    sizes = sorted_rows.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    index = F.col("_at").bitwiseAND(F.lit((1 << _INDEX_BITS) - 1))
    return (
        sorted_rows.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + index)
        .drop("_part", "_offset", "_at")
    )


def rank_in_group(
    df: DataFrame, group: Sequence[str], order: Sequence[str], name: str = "rank"
) -> DataFrame:
    """0-based rank of every row within its group (action: one sorted write).

    The first position of a group is a map-side combined minimum. Few groups are broadcast, so the rows of a
    large one are not brought together; where groups are many, AQE splits a large one.
    """
    placed = ordinals(df, [*group, *order], "_pos")
    starts = placed.groupBy(*group).agg(F.min("_pos").alias("_start"))
    # Null is a group like any other.
    starts = written(starts.select(*[F.col(c).alias(f"_of_{c}") for c in group], "_start"))
    return (
        placed.join(broadcast_if_small(starts), _same(group, "_of_"))
        .withColumn(name, F.col("_pos") - F.col("_start"))
        .select(*[c for c in placed.columns if c != "_pos"], name)
    )


def _same(columns: Sequence[str], prefix: str) -> Column:
    """Equal in every column, null equal to null."""
    return reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"{prefix}{c}")) for c in columns])


def repeat_counter(df: DataFrame, key: str, order: Sequence[str], name: str = "repeat") -> DataFrame:
    """How many earlier rows carry the same content key (action: the keys are written
    once, the repeated ones once more, sorted).

    Only rows whose key repeats are ranked; every other row is its key's first. Where repeats are
    few, their ranks are broadcast to the rows and the payload is not shuffled. Rows of nothing but keys and order
    columns are ranked as they are, and nothing is joined back to them.
    """
    if set(df.columns) <= {key, *order}:
        return rank_in_group(df, [key], order, name).select(*df.columns, name)
    keys = written(df.select(key, *order))
    repeated = duplicate_keys(keys, key).select(key)
    rows = keys.join(repeated.select(F.col(key).alias("_of_key")), F.col(key).eqNullSafe(F.col("_of_key")), "left_semi")
    later = rank_in_group(rows, [key], order, "_rank").filter(F.col("_rank") > 0)
    later = later.select(*[F.col(c).alias(f"_of_{c}") for c in order], "_rank")
    joined = df.join(later, _same(order, "_of_"), "left")
    return joined.select(*df.columns, F.coalesce("_rank", F.lit(0)).alias(name))


def first_rows(df: DataFrame, order: Sequence[str], n: int, top_k: int = 100_000) -> DataFrame:
    """The first ``n`` rows in order.

    A small ``n`` is a top-k, held once per task. Beyond ``top_k`` rows the cut is made on exact
    positions instead, so no task ever merges them all.
    """
    if n <= top_k:
        return df.orderBy(*order).limit(n)
    return ordinals(df, order, "_pos").filter(F.col("_pos") < n).drop("_pos")


def capped(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows of a table with wide rows (action): the cut is made on the order columns
    alone, which no two rows share, and the rows are then picked by them."""
    chosen = written(first_rows(df.select(*order), order, n))
    chosen = chosen.select(*[F.col(c).alias(f"_of_{c}") for c in order])
    return df.join(broadcast_if_small(chosen), _same(order, "_of_"), "left_semi")


def first_of_each(
    df: DataFrame, group: Sequence[str], order: Sequence[str], n: int, name: str = "rank"
) -> DataFrame:
    """The first ``n`` rows of each group under an order, with their 0-based rank.

    For a small ``n`` (Spark's own bound for limits on ranks) every task keeps its first ``n`` rows of a group before
    anything moves, so a group of any size sends ``n`` rows a task; nothing is sorted as a whole. Beyond that bound, which
    would let a task merge too many, ranks come from exact positions (action).
    """
    bound = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if n <= bound:
        at = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
        return df.withColumn(name, at).filter(F.col(name) <= n).withColumn(name, F.col(name).cast("bigint") - 1)
    return rank_in_group(df, group, order, name).filter(F.col(name) < n)


def round_robin_cap(members: DataFrame, n: int) -> DataFrame:
    """Walk the classes in turn and take the next unseen member, until ``n`` are taken.

    ``members`` is ``(class, id)``. A member's turn is its least (depth, class), where depth is its
    rank among the sorted members of the class. Returns ``(id, depth, class)``. A class with n members has n turns
    before depth n, so no chosen turn lies deeper and only the first n members of each class are ranked.
    """
    ranked = first_of_each(members.select("class", "id").distinct(), ["class"], ["id"], n, "depth")
    turns = ranked.groupBy("id").agg(F.min(F.struct("depth", "class")).alias("turn"))
    return first_rows(turns.select("id", "turn.depth", "turn.class"), ["depth", "class"], n)


def balanced_cap(df: DataFrame, label: str, key: str, n: int) -> DataFrame:
    """Alternate between the classes, each in key order, until ``n`` keys are taken.

    Returns ``(key, label, rank)`` of the chosen rows; no class can give more than ``n``.
    """
    ranked = first_of_each(df.select(label, key), [label], [key], n)
    return first_rows(ranked.select(key, label, "rank"), ["rank", label], n)


def block_starts(total: int, n_blocks: int) -> list[int]:
    """Evenly spaced starts ``i * total / (n_blocks + 1)``, rounded half to even, for i = 1..n."""
    return [round(Fraction(i * total, n_blocks + 1)) for i in range(1, n_blocks + 1)]


def strided_blocks(
    df: DataFrame,
    order: Sequence[str] | None,
    n_blocks: int,
    block_rows: int,
    max_rows: int,
    ordinal: str | None = None,
) -> DataFrame:
    """Rows of evenly spaced blocks, at most ``max_rows`` in block order (action).

    With ``ordinal`` the rows already carry dense positions and nothing is sorted: the blocks are a
    filter. Otherwise positions come from ``order``, columns without nulls that no two rows share.
    Adds ``block`` (1-based), ``block_start`` and
    ``position``. Blocks that overlap repeat the shared rows, as reading each block would.
    """
    if ordinal is None:
        keys = list(order or [])
        positions = ordinals(df.select(*keys), keys, "position")
        chosen = _in_blocks(positions, n_blocks, block_rows, max_rows)
        if set(df.columns) == set(keys):
            return chosen
        # Only keys were sorted; the other columns join the few chosen rows.
        return df.join(broadcast_if_small(chosen), keys)
    return _in_blocks(df.withColumnRenamed(ordinal, "position"), n_blocks, block_rows, max_rows)


def _in_blocks(df: DataFrame, n_blocks: int, block_rows: int, max_rows: int) -> DataFrame:
    total = df.count()
    blocks, taken = [], 0
    for number, start in enumerate(block_starts(total, n_blocks), 1):
        size = max(min(block_rows, total - start, max_rows - taken), 0)
        if size:
            blocks.append((number, start, start + size))
            taken += size
    if not blocks:
        raise ValueError(f"no block of {block_rows} rows holds a row; {total} rows were found")
    spec = F.array(
        *[
            F.struct(F.lit(b).alias("block"), F.lit(s).alias("block_start"), F.lit(e).alias("block_end"))
            for b, s, e in blocks
        ]
    )
    inside = F.filter(
        spec,
        lambda b: (F.col("position") >= b["block_start"]) & (F.col("position") < b["block_end"]),
    )
    return df.select("*", F.inline(inside)).drop("block_end")


def block_provenance(sampled: DataFrame) -> DataFrame:
    return sampled.groupBy("block", "block_start").agg(F.count(F.lit(1)).alias("rows"))


def last_of_each(df: DataFrame, key: str, at: str) -> DataFrame:
    """Of the rows of a key the one with the greatest ``at``, which no two rows share; null is a key like any other.

    Only keys and positions are grouped, and only repeated keys go on: where they are few they are broadcast, so wide rows
    are neither shuffled nor sorted. ``df`` must give the same positions when it is read twice, as a file does.
    """
    lasts = df.groupBy(F.col(key).alias("_key")).agg(F.max(at).alias("_last"), F.count(F.lit(1)).alias("_n"))
    repeated = written(lasts.filter("_n > 1").drop("_n"))
    joined = df.join(broadcast_if_small(repeated), F.col(key).eqNullSafe(F.col("_key")), "left")
    return joined.filter(F.col("_last").isNull() | (F.col(at) == F.col("_last"))).drop("_key", "_last")


def duplicate_keys(df: DataFrame, key: str = "sample_id") -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def duplicate_summary(df: DataFrame, key: str = "sample_id", examples: int = 5) -> DataFrame:
    """One row: how many keys repeat and the first few of them."""
    dupes = duplicate_keys(df, key).select(F.col(key).cast("string").alias("k"))
    counted = dupes.agg(F.count(F.lit(1)).alias("n"), F.lit(None).cast("string").alias("k"))
    shown = dupes.orderBy("k").limit(examples).select(F.lit(None).cast("bigint").alias("n"), "k")
    return counted.unionByName(shown).agg(
        F.max("n").alias("n_duplicated"),
        F.array_join(F.sort_array(F.collect_list("k")), ", ").alias("examples"),
    )


def keyed_sample(df: DataFrame, key: str, k: int, seed: int = 0) -> DataFrame:
    """A repeatable sample of ``k`` rows: the smallest seeded hashes, so layout does not matter."""
    return (
        df.withColumn("_h", F.sha2(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")), 256))
        .orderBy("_h", key)
        .limit(k)
        .drop("_h")
    )
