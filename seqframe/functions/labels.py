"""Expressions that build or check label vectors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def label_vector(members: Column, classes: Sequence[str]) -> Column:
    """0/1 vector over ``classes`` in sorted order."""
    vocabulary = F.array(*[F.lit(c) for c in sorted(classes)])
    return F.transform(vocabulary, lambda c: F.array_contains(members, c).cast("int"))


def pooled_class_flag(value: Column, pooled: str) -> Column:
    return (value == F.lit(pooled)).cast("int")


def one_hot_ok(cells: Column) -> Column:
    """Exactly one 1.0 and nothing else adding up to more."""
    total = F.aggregate(cells, F.lit(0.0), lambda acc, c: acc + F.coalesce(c, F.lit(0.0)))
    return F.coalesce((F.array_max(cells) == 1.0) & (total == 1.0), F.lit(False))


def one_hot_class(cells: Column, classes: Sequence[str]) -> Column:
    vocabulary = F.array(*[F.lit(c) for c in classes])
    return F.element_at(vocabulary, F.array_position(cells, 1.0).cast("int"))


def checked_label(label: Column, n_targets: int, key: Column) -> Column:
    """The label, or an error: a missing or short label is never defaulted."""
    missing = F.raise_error(F.concat(F.lit("no label for "), key)).cast("array<int>")
    width = F.raise_error(F.concat(F.lit("wrong label width for "), key)).cast("array<int>")
    return F.when(label.isNull(), missing).when(F.size(label) != n_targets, width).otherwise(label)
