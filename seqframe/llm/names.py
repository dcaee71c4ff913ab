"""Working columns beside a user's own, whatever these are called."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame


def under_plain_names(docs: DataFrame, work: Callable[..., DataFrame], *columns: str) -> DataFrame:
    """``work(docs, *columns)`` with all columns of ``docs`` renamed to c0, c1, … and named as before in the result.

    ``work`` keeps them all, in their order and first; what it adds keeps its name.
    """
    plain = {c: f"c{k}" for k, c in enumerate(docs.columns)}
    out = work(docs.toDF(*plain.values()), *(plain[c] for c in columns))
    return out.toDF(*docs.columns, *out.columns[len(plain):])
