"""A filter of hashes of a bounded size: says yes to every hash that it holds and seldom to others."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqframe.llm.words import U

#: Where in a hash the three bits of its word come from, and the most words of a filter, 8 MB.
BITS = (57, 50, 43)
WORDS = 1 << 20


def sieve(hashes: DataFrame, column: str) -> np.ndarray:
    """The words of a filter with about ten bits for each row, up to the bound; beyond it says yes more often (action)."""
    size = int(min(WORDS, max(1, hashes.count() // 6)))
    one = F.expr(" | ".join(f"shiftleft(1L, cast(shiftright({column}, {k}) & 63 as int))" for k in BITS))
    found = hashes.groupBy(F.pmod(column, F.lit(size)).alias("at")).agg(F.bit_or(one).alias("bits")).toPandas()
    words = np.zeros(size, np.int64)
    words[found["at"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64)
    return words


def passes(words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which of the hashes (signed) the filter may hold."""
    need = np.zeros(len(hashes), U)
    for k in BITS:
        need |= U(1) << ((hashes >> k) & 63).astype(U)
    return (words[hashes % len(words)].view(U) & need) == need
