"""Bytes of each text in runs of many words that stand in another document as well.

A window of words has an anchor, the least hash of its short word grams, which only its content decides. Windows whose
anchor no other document has are left out by a bounded filter; the rest are compared by a hash of all their words.
Copies of a text count as documents of their own and are looked at once in a task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seqframe.llm.batches import batches_of
from seqframe.llm.sieve import passes, sieve
from seqframe.llm.words import BASE, Hasher, U, blocks, mixed, powers, shingles, signed, words
from seqframe.session import written

#: Words of a window, and of the grams that may be its anchor: long ones seldom meet by chance.
WORDS, GRAM = 51, 16
#: Texts that a task remembers.
SEEN = 1_000_000


class _Windows:
    """Hashes of all windows of a block's rows, and their anchors."""

    def __init__(self, n: int):
        self.n, self.hasher, self.down = n, Hasher(lower=False), np.ones(1, U)
        self.gram = max(1, min(GRAM, n // 2))

    def of(self, block) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(row, anchor, first byte, end byte) of every window; ``hashes`` are made by ``named``."""
        w = words(block)
        self.hashes = self.hasher.ranges(block.data, w.starts, w.ends)
        first = np.arange(max(len(self.hashes) - self.n + 1, 0))
        ends = np.repeat(w.rows[1:], np.diff(w.rows))
        first = first[first + self.n <= ends[first]]
        if not len(first):
            return (np.zeros(0, np.int64),) * 4
        grams, _ = shingles(self.hashes, np.array([0, len(self.hashes)]), self.gram)
        width = self.n - self.gram + 1
        padded = np.full(-(-len(grams) // width) * width, ~U(0), U)
        padded[: len(grams)] = grams
        table = padded.reshape(-1, width)
        ahead, behind = np.minimum.accumulate(table, axis=1).reshape(-1), np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].reshape(-1)
        self.first = first
        anchor = np.minimum(behind[first], ahead[first + width - 1])
        return np.searchsorted(w.rows, first, "right") - 1, signed(anchor), w.starts[first] - block.edges[np.searchsorted(w.rows, first, "right") - 1], w.ends[first + self.n - 1] - block.edges[np.searchsorted(w.rows, first, "right") - 1]

    def named(self, at: np.ndarray) -> np.ndarray:
        """A hash of all words of the windows ``at``."""
        if len(self.down) < len(self.hashes) + 1:
            size = max(2 * len(self.hashes), 1 << 18)
            self.up, self.down = powers(BASE, size), powers(pow(BASE, -1, 1 << 64), size)
        sums = np.zeros(len(self.hashes) + 1, U)
        np.cumsum(self.hashes * self.up[: len(self.hashes)], out=sums[1:])
        first = self.first[at]
        return signed(mixed((sums[first + self.n] - sums[first]) * self.down[first]))


def _fresh(column, seen: set) -> np.ndarray:
    """Which rows hold a text that the task has not met."""
    if len(seen) > SEEN:
        seen.clear()
    out = []
    for t in column.to_pylist():
        out.append(t not in seen)
        seen.add(t)
    return np.array(out, bool)


def _anchors(n: int):
    def run(batches):
        windows, seen = _Windows(n), set()
        for batch in batches:
            batch = batch.filter(pa.array(_fresh(batch.column(0), seen)))
            names = batch.column(0).to_numpy()
            for block in blocks(batch.column(1)):
                row, anchor, _, _ = windows.of(block)
                new = np.append(True, (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1]))[: len(row)]
                yield pa.record_batch({"anchor": anchor[new], "text": names[block.first + row[new]]})

    return run


def _kept(n: int, wanted):
    def run(batches):
        windows, seen, filter_ = _Windows(n), set(), wanted.value
        for batch in batches:
            batch = batch.filter(pa.array(_fresh(batch.column(0), seen)))
            names = batch.column(0).to_numpy()
            for block in blocks(batch.column(1)):
                row, anchor, begin, end = windows.of(block)
                at = np.flatnonzero(passes(filter_, anchor)) if len(row) else row
                if len(at):
                    yield pa.record_batch({"window": windows.named(at), "text": names[block.first + row[at]], "begin": begin[at], "end": end[at]})

    return run


def shared_bytes(rows: DataFrame, n: int = WORDS) -> DataFrame:
    """(name, shared, copied) of texts that share ``n`` words in a row with another document (action).

    ``rows`` has ``row``, a name of the document, and ``text``; name is the xxhash64 of a text. shared counts the bytes of
    such runs that other texts have; copied tells that several documents have this text, so that all of it is
    shared. Texts that share nothing, null and empty ones and those of fewer words have no row, unless copied.
    """
    named, copies, runs = _runs(rows, n)
    sums = runs.groupBy(F.col("text").alias("name")).agg(F.sum(F.col("end") - F.col("from")).alias("shared"))
    return written(sums.join(copies, "name", "full"))


def shared_spans(rows: DataFrame, n: int = WORDS) -> DataFrame:
    """(row, begin, end): runs of bytes that ``n`` words in a row cover which other texts have as well (action).

    ``rows`` as in ``shared_bytes``; copies of a text do not count as other texts here.
    """
    named, _, runs = _runs(rows, n)
    return named.select("row", "name").distinct().join(runs, F.col("name") == F.col("text")).select("row", F.col("from").alias("begin"), "end")


def _runs(rows: DataFrame, n: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(named, copies, runs): runs are (text, from, end), disjoint, one for each window that others have."""
    spark = rows.sparkSession
    named = rows.select("row", F.xxhash64("text").alias("name"), "text").filter("text is not null")
    copies = named.groupBy("name").agg((F.min("row") != F.max("row")).alias("copied")).filter("copied")
    with batches_of(spark, 2000):
        found = named.select("name", "text").mapInArrow(_anchors(n), "anchor long, text long").groupBy("anchor").agg(F.min("text").alias("a"), F.max("text").alias("b"))
        wanted = spark.sparkContext.broadcast(sieve(written(found.filter("a != b").select("anchor")), "anchor"))
        windows = written(named.select("name", "text").mapInArrow(_kept(n, wanted), "window long, text long, begin long, end long"))
    twice = windows.groupBy("window").agg(F.min("text").alias("a"), F.max("text").alias("b")).filter("a != b").select("window")
    shared = windows.join(twice, "window", "left_semi").select("text", "begin", "end")
    # A window that several tasks told of covers nothing anew.
    before = F.lag("end").over(Window.partitionBy("text").orderBy("begin", "end"))
    return named, copies, shared.withColumn("from", F.greatest("begin", F.coalesce(before, F.lit(0)))).select("text", "from", "end")
