"""How computed columns meet the optimizer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(df: DataFrame, kept: Sequence[str | Column], **columns: Column) -> DataFrame:
    """``select`` whose computed columns are not copied into a filter above it.

    Catalyst pushes a filter below a projection by substituting the projection's expressions, so a
    regular expression over a whole text would run once for the filter and again for the column. A
    one-element generator is not looked through, keeps generated code, and moves no data. Use it
    where a costly column is also filtered on.
    """
    values = F.struct(*[value.alias(name) for name, value in columns.items()])
    return df.select(*kept, F.inline(F.array(values)))
