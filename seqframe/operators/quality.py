"""Measurements over an encoded table and the differences between two tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqframe.functions import digests as D
from seqframe.functions.tokens import row_text_of
from seqframe.model import KEY, MAX_TOKEN, PAD_TOKEN


def row_facts(table: DataFrame, key: str = KEY) -> DataFrame:
    """Per-row token facts of the narrow table. Narrow: no shuffle.

    The array is read once into padded text; trailing padding, emptiness and the decoded letters
    are then string work. ``decoded`` means nothing where ``in_range`` or ``well_padded`` is false.
    """
    text, width = F.col("_row"), F.size("tokens")
    typed = table.select(
        "*",
        row_text_of(F.col("tokens")).alias("_row"),
        F.array_min("tokens").cast("int").alias("token_min"),
        F.array_max("tokens").cast("int").alias("token_max"),
    )
    # A null cell leaves no character; only below -64 does an integer leave none either.
    no_cell = F.when(F.col("token_min") >= -64, F.length(text) < width).otherwise(
        F.exists("tokens", lambda t: t.isNull())
    )
    return (
        typed.select(
            "*",
            width.alias("width"),
            (F.col("tokens").isNull() | F.coalesce(no_cell, F.lit(True))).alias("has_non_integer"),
            F.expr(f"token_min >= {PAD_TOKEN} AND token_max <= {MAX_TOKEN}").alias("in_range"),
            (~text.rlike("@[^@]")).alias("well_padded"),
            F.replace(text, F.lit("@"), F.lit("")).alias("decoded"),
        )
        .withColumn("residues", F.length("decoded"))
        .withColumn("padding", F.col("width") - F.col("residues"))
    )


def token_cell(facts_in_range: Column, row_text: Column, tokens: Column | None = None) -> Column:
    """Digest text of a row's tokens: its padded letters, or its numbers when one has no letter."""
    if tokens is None:
        return row_text
    numbers = F.array_join(tokens.cast("array<string>"), ",", "null")
    return F.when(F.coalesce(facts_in_range, F.lit(False)), row_text).otherwise(numbers)


def table_body_digest(table: DataFrame, tokens: Column) -> Column:
    """Digest of what a table row says, wherever it stands: key, targets and the token text."""
    return D.row_digest(D.cell_text(table, KEY), D.cell_text(table, "target"), tokens)


def table_row_digest(table: DataFrame, tokens: Column) -> Column:
    """Digest of one table row in its place."""
    return D.row_digest(D.cell_text(table, "ord"), table_body_digest(table, tokens))


def table_digest(table: DataFrame) -> DataFrame:
    """``(n_rows, content_digest)`` of a narrow table, as a manifest declares it."""
    facts = row_facts(table)
    cell = token_cell(F.col("in_range") & ~F.col("has_non_integer"), F.col("_row"), F.col("tokens"))
    return facts.select(table_row_digest(table, cell).alias("_d")).agg(
        F.count(F.lit(1)).alias("n_rows"), D.combined_digest("_d").alias("content_digest")
    )


def token_range(facts: DataFrame) -> DataFrame:
    return facts.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min("token_min").alias("token_min"),
        F.max("token_max").alias("token_max"),
        F.count_if(~F.col("in_range")).alias("rows_out_of_range"),
    )


def padding_invariant(facts: DataFrame) -> DataFrame:
    """Padding cells, rows with a 0 before a letter, and rows of padding only."""
    return facts.agg(
        F.coalesce(F.sum("padding"), F.lit(0)).alias("padding_cells"),
        F.count_if(~F.col("well_padded")).alias("rows_with_inner_padding"),
        F.count_if(F.col("residues") == 0).alias("empty_rows"),
    )


def duplicate_sequences(df: DataFrame, seq: str = "sequence") -> DataFrame:
    """``(sequence_digest, n_rows)`` of sequences occurring more than once.

    Groups on the digest, so the shuffle carries 64 characters per distinct sequence and map-side
    counts, whatever the length or the number of copies.
    """
    return (
        df.groupBy(F.sha2(F.col(seq), 256).alias("sequence_digest"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .filter(F.col("n_rows") > 1)
    )


def sequence_groups(df: DataFrame, seq: str, label: str) -> DataFrame:
    """``(sequence_digest, n_rows, n_labels)``: rows and distinct label vectors per sequence.

    Counted in two steps, first per sequence and label, so copies are combined before each shuffle.
    """
    pairs = df.groupBy(
        F.sha2(F.col(seq), 256).alias("sequence_digest"),
        F.array_join(F.col(label).cast("array<string>"), ",").alias("_label"),
    ).agg(F.count(F.lit(1)).alias("_n"))
    return pairs.groupBy("sequence_digest").agg(
        F.sum("_n").alias("n_rows"), F.count(F.lit(1)).alias("n_labels")
    )


def label_conflicts(df: DataFrame, seq: str = "sequence", label: str = "label") -> DataFrame:
    return sequence_groups(df, seq, label).filter(F.col("n_labels") > 1)


def class_counts(df: DataFrame, label: str = "target") -> DataFrame:
    """``(target_index, value, n)`` over every target column."""
    return (
        df.select(F.posexplode(label).alias("target_index", "value"))
        .groupBy("target_index", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def class_balance(counts: DataFrame) -> DataFrame:
    """Distinct classes and least/most common ratio per target, null ratio for a single class."""
    ratio = F.bround(F.min("n") / F.max("n"), 4)
    return counts.groupBy("target_index").agg(
        F.count(F.lit(1)).alias("n_distinct_classes"),
        F.when(F.count(F.lit(1)) > 1, ratio).alias("class_balance_min_over_max"),
    )


def all_zero_targets(counts: DataFrame) -> DataFrame:
    return (
        counts.groupBy("target_index")
        .agg(F.max(F.abs(F.col("value"))).alias("_top"))
        .filter(F.col("_top") == 0)
        .select("target_index")
    )


def undocumented_labels(counts: DataFrame, semantics: DataFrame) -> DataFrame:
    observed = counts.select("value").distinct()
    return observed.join(semantics.select("value"), "value", "left_anti")


def ordered_digest(
    df: DataFrame, order: Sequence[str], cols: Sequence[str], by: Sequence[str] = ()
) -> DataFrame:
    """``(n_rows, content_digest)`` binding every value to its row's place in the order."""
    row = D.row_digest(*[D.cell_text(df, c) for c in [*order, *cols]])
    return (
        df.select(*by, row.alias("_d"))
        .groupBy(*by)
        .agg(F.count(F.lit(1)).alias("n_rows"), D.combined_digest("_d").alias("content_digest"))
    )


def ordered_target_digest(long: DataFrame, order: Sequence[str] = ("ord",)) -> DataFrame:
    """One digest per target column of the long form, binding keys, values and order."""
    return ordered_digest(long, order, [KEY, "target"], by=["target_index"])


def key_order_differences(table: DataFrame, samples: DataFrame, order: str = "ord") -> DataFrame:
    """Places at which the table and its sidecar do not name the same key."""
    left = table.select(order, F.col(KEY).alias("table_key"))
    right = samples.select(order, F.col(KEY).alias("sidecar_key"))
    both = left.join(right, order, "full_outer")
    return both.filter(~F.col("table_key").eqNullSafe(F.col("sidecar_key")))


def roundtrip_mismatches(facts: DataFrame, samples: DataFrame, digest: str = "sha2-256") -> DataFrame:
    """Rows whose decoded letters do not have the digest recorded for their key.

    Both sides are first reduced to one row per key and digest (the sidecar's last entry for a
    repeated key counts), so a key repeated many times cannot multiply in the join.
    """
    last = F.max_by("slice_digest", "ord") if "ord" in samples.columns else F.max("slice_digest")
    recorded = samples.groupBy(KEY).agg(last.alias("recorded"))
    found = facts.groupBy(KEY, D.text_digest(F.col("decoded"), digest).alias("found")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )
    joined = found.join(recorded, KEY, "left")
    return joined.filter(~F.col("found").eqNullSafe(F.col("recorded")))


def run_differences(a: DataFrame, b: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(sample_id, in_first, in_second)`` of rows that are not the same in two runs.

    Compares one digest per row, so a wide row costs no more shuffle than a narrow one.
    """

    def rows(df: DataFrame, side: int) -> DataFrame:
        digest = D.row_digest(*[D.cell_text(df, c) for c in cols])
        return df.select(KEY, digest.alias("_d"), F.lit(1 - side).alias("_a"), F.lit(side).alias("_b"))

    both = rows(a, 0).unionByName(rows(b, 1))
    return (
        both.groupBy(KEY, "_d")
        .agg(F.sum("_a").alias("in_first"), F.sum("_b").alias("in_second"))
        .filter(F.col("in_first") != F.col("in_second"))
        .select(KEY, "in_first", "in_second")
    )


def compare_runs(a: DataFrame, b: DataFrame, order: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """One check row: do two runs of one configuration hold the same table?"""
    sides = ordered_digest(a, order, cols).withColumn("side", F.lit("first")).unionByName(
        ordered_digest(b, order, cols).withColumn("side", F.lit("second"))
    )

    def of(side: str) -> Column:
        return F.max(F.when(F.col("side") == side, F.col("content_digest")))

    return sides.agg(
        F.lit("rerunning_with_the_same_config_is_byte_identical").alias("name"),
        (of("first") == of("second")).alias("passed"),
        F.concat(F.lit("first="), F.left(of("first"), F.lit(16)), F.lit(" second="), F.left(of("second"), F.lit(16))).alias("detail"),
    )
