"""Fit cleaned sequences into rows of one fixed width."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqframe.functions import tokens as T
from seqframe.functions.digests import text_digest
from seqframe.model import (
    KEY,
    LengthPolicy,
    check_stride,
    check_window_cap,
    position_columns,
    target_columns,
)

PLACED = (
    "parent_sample_id",
    "window_index",
    "windows_dropped",
    "window_start",
    "window_end",
    "residues_in_row",
    "padding_cells",
    "residues_removed_by_truncation",
    "residues_dropped_by_window_cap",
    "slice",
)


def encode(df: DataFrame, col: str = "sequence") -> DataFrame:
    return df.withColumn("tokens", T.encode(F.col(col)))


def decode(df: DataFrame, col: str = "tokens") -> DataFrame:
    return df.withColumn("decoded", T.decode(F.col(col)))


def pad_or_truncate(df: DataFrame, width: int, col: str = "sequence") -> DataFrame:
    """Exactly one row per sequence; what does not fit is cut and counted."""
    if width <= 0:
        raise ValueError(f"width must be positive, got {width}")
    text = T.checked_letters(F.col(col))
    length = F.length(F.col(col))
    kept = F.least(length, F.lit(width))
    zero = F.lit(0)
    return df.select(
        *[c for c in df.columns if c != col],
        F.col(KEY).alias("parent_sample_id"),
        zero.alias("window_index"),
        zero.alias("windows_dropped"),
        F.lit(1).alias("window_start"),
        kept.alias("window_end"),
        kept.alias("residues_in_row"),
        (F.lit(width) - kept).alias("padding_cells"),
        (length - kept).alias("residues_removed_by_truncation"),
        zero.alias("residues_dropped_by_window_cap"),
        F.left(text, F.lit(width)).alias("slice"),
    )


def window(
    df: DataFrame, width: int, stride: int, cap: int | None = None, col: str = "sequence"
) -> DataFrame:
    """One row per window of a sequence, the last one padded and none a mere suffix.

    Windows are cut from the bytes of the text: cleaned text is ASCII, so a byte offset is a letter
    offset and a cut costs its own width however long the sequence is. Only the kept windows are
    generated.
    """
    if width <= 0:
        raise ValueError(f"width must be positive, got {width}")
    check_stride(width, stride)
    check_window_cap(cap)
    n_windows = T.window_count(F.col("_length"), width, stride)
    kept = n_windows if cap is None else F.least(n_windows, F.lit(cap))
    rest = [c for c in df.columns if c not in (col, KEY)]
    counted = (
        df.withColumn("_length", F.length(F.col(col)))
        .withColumn("_bytes", T.checked_letters(F.col(col)).cast("binary"))
        .withColumn("_windows", n_windows)
        .withColumn("_kept", kept)
    )
    exploded = counted.select(
        *rest,
        F.col(KEY).alias("parent_sample_id"),
        "_length",
        "_windows",
        "_kept",
        "_bytes",
        F.explode(F.sequence(F.lit(0), F.col("_kept") - 1)).alias("window_index"),
    )
    cut = exploded.select(
        *rest,
        "parent_sample_id",
        "_length",
        "_windows",
        "_kept",
        "window_index",
        (F.col("window_index") * stride).alias("_offset"),
        F.substring(F.col("_bytes"), F.col("window_index") * stride + 1, F.lit(width))
        .cast("string")
        .alias("slice"),
    )
    size = F.length("slice")
    end = F.col("_offset") + size
    last = F.col("window_index") == F.col("_kept") - 1
    capped = F.col("_windows") > F.col("_kept")
    return cut.select(
        *rest,
        T.window_id(F.col("parent_sample_id"), F.col("window_index"), F.col("_kept")).alias(KEY),
        "parent_sample_id",
        "window_index",
        F.when(last, F.col("_windows") - F.col("_kept")).otherwise(0).alias("windows_dropped"),
        (F.col("_offset") + 1).alias("window_start"),
        end.alias("window_end"),
        size.alias("residues_in_row"),
        (F.lit(width) - size).alias("padding_cells"),
        F.lit(0).alias("residues_removed_by_truncation"),
        F.when(last & capped, F.greatest(F.col("_length") - end, F.lit(0)))
        .otherwise(0)
        .alias("residues_dropped_by_window_cap"),
        "slice",
    )


def place(
    df: DataFrame,
    width: int,
    policy: LengthPolicy = LengthPolicy.PAD_OR_TRUNCATE,
    stride: int | None = None,
    cap: int | None = None,
    *,
    digest: str = "sha2-256",
    col: str = "sequence",
) -> DataFrame:
    """Placement columns, the slice's digest and the row's tokens, one row per window.

    The digest is of the cleaned slice itself, never of decoded tokens, so the round-trip check
    compares two independent values.
    """
    if LengthPolicy(policy) is LengthPolicy.WINDOW:
        placed = window(df, width, width if stride is None else stride, cap, col)
    else:
        placed = pad_or_truncate(df, width, col)
    return placed.withColumn("slice_digest", text_digest(F.col("slice"), digest)).withColumn(
        "tokens", T.tokens_of(T.pad_text(F.col("slice"), width))
    )


def conversion_totals(placed: DataFrame) -> DataFrame:
    def total(name: str):
        return F.coalesce(F.sum(name), F.lit(0)).alias(name)

    return placed.agg(
        F.count(F.lit(1)).alias("n_rows"),
        total("windows_dropped"),
        total("residues_dropped_by_window_cap"),
        total("residues_removed_by_truncation"),
        total("residues_in_row"),
        total("padding_cells"),
    )


def widen(df: DataFrame, width: int, n_targets: int, keep: Sequence[str] = ()) -> DataFrame:
    """Key, targets, positions as columns. Sink-time only: narrower forms keep code generation."""
    # As text: a thousand columns are one parse instead of thousands of calls.
    return df.selectExpr(
        *keep,
        KEY,
        *[f"target[{i}] AS {n}" for i, n in enumerate(target_columns(n_targets))],
        *[f"tokens[{i}] AS {n}" for i, n in enumerate(position_columns(width))],
    )


def narrow(wide: DataFrame, width: int, n_targets: int, keep: Sequence[str] = ()) -> DataFrame:
    """The array form of a wide table; a cell that is not an exact integer becomes null."""

    def integers(names: list[str]) -> Column:
        return F.expr(f"try_cast(array({', '.join(names)}) AS ARRAY<INT>)")

    return wide.select(
        *keep,
        KEY,
        integers(target_columns(n_targets)).alias("target"),
        integers(position_columns(width)).alias("tokens"),
    )


def length_summary(df: DataFrame, col: str = "sequence") -> DataFrame:
    """Count, shortest, longest and upper median, exact.

    Rows are first reduced to one count per distinct length, so the running sum sees at most as
    many rows as there are lengths.
    """
    from pyspark.sql import Window

    by_length = df.groupBy(F.length(F.col(col)).alias("len")).agg(F.count(F.lit(1)).alias("n"))
    upto = Window.orderBy("len").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = by_length.select(
        "len", "n", F.sum("n").over(upto).alias("upto"), F.sum("n").over(whole).alias("total")
    )
    middle = F.floor(F.col("total") / 2)
    holds_middle = (F.col("upto") > middle) & (F.col("upto") - F.col("n") <= middle)
    return ranked.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_records"),
        F.coalesce(F.min("len"), F.lit(0)).alias("min_length"),
        F.coalesce(F.max("len"), F.lit(0)).alias("max_length"),
        F.coalesce(F.max(F.when(holds_middle, F.col("len"))), F.lit(0)).alias("median_length"),
    )
