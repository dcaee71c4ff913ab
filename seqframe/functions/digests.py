"""Digests of slices, rows and whole tables.

A table digest is a sum, not a chain: every row is hashed with SHA-256 (its order columns
included, so moving a row changes its hash), the hash is cut into ten 24-bit lanes and the lanes
are added up. Sums combine on the map side, so no row is shuffled or sorted and no task ever holds
a group; they are exact in a BIGINT up to 2**39 rows. The final digest is the SHA-256 of the row
count and the ten sums.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, StringType

#: How a table digest is made, as a projection block names it.
ALGORITHM = "sha2-256 of 24-bit lane sums over row digests"
LANES = 10
LANE_HEX = 6


def text_digest(text: Column, algorithm: str = "sha2-256") -> Column:
    if algorithm == "sha2-256":
        return F.sha2(text, 256)
    if algorithm == "blake2b-256":
        return _blake2b(text)
    raise ValueError(f"unknown digest {algorithm!r}")


@F.pandas_udf(StringType())
def _blake2b(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    from hashlib import blake2b

    for texts in batches:
        yield texts.map(lambda t: None if t is None else blake2b(t.encode(), digest_size=32).hexdigest())


def cell_text(df: DataFrame, name: str) -> Column:
    """One spelling per value; null stays null, which ``row_digest`` marks."""
    kind = df.schema[name].dataType.typeName()
    value = F.col(name)
    if kind == "array" and isinstance(df.schema[name].dataType.elementType, IntegralType):
        return F.array_join(value.cast("array<string>"), ",", "null")
    if kind in ("array", "struct", "map"):
        return F.to_json(value)
    return value.cast("string")


def row_digest(*cells: Column) -> Column:
    """SHA-256 of the cells, each behind its length, null as a lone hyphen: no two rows spell alike."""
    spelled = [F.coalesce(F.concat(F.length(c).cast("string"), F.lit(":"), c), F.lit("-")) for c in cells]
    return F.sha2(F.concat(*spelled), 256)


def packed(digest: Column) -> Column:
    """A digest as its 32 bytes: half of its hex text, in tables that are written or shuffled."""
    return F.unhex(digest)


def unpacked(digest: str | Column) -> Column:
    """``packed`` undone."""
    return F.lower(F.hex(digest))


def combined_digest(name: str, is_packed: bool = False) -> Column:
    """Aggregate expression: one digest for all the row digests (column ``name``) of a group or table.

    Two lanes are read from the text at a time.
    """
    sums = []
    for i in range(0, LANES, 2):
        size = LANE_HEX // 2 if is_packed else LANE_HEX
        cut = f"substring({name}, {1 + size * i}, {2 * size})"
        both = f"cast(conv({f'hex({cut})' if is_packed else cut}, 16, 10) AS BIGINT)"
        bits = 4 * LANE_HEX
        sums += [f"coalesce(sum(shiftright({both}, {bits})), 0)", f"coalesce(sum({both} & {(1 << bits) - 1}), 0)"]
    cells = ", ".join(f"cast({c} AS STRING)" for c in [f"count({name})", *sums])
    return F.expr(f"sha2(concat_ws(',', {cells}), 256)")


def content_key(*cells: Column) -> Column:
    """Twelve hex digits naming a row by its content, never by its position."""
    return F.substring(row_digest(*cells), 1, 12)
