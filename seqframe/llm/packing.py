"""Packing examples into training sequences: vector bin packing by the dot-product heuristic.

Each example has three demands: tokens, one segment, and tokens that bear loss. A sequence has a limit for
each. Sequences are filled one after the other from a window of waiting examples: of those that still fit,
the one whose demands point most in the direction of what is left (weighted dot product) comes next. Where
cutting is allowed, the rest of a sequence takes the beginning of one more example. Every partition packs its
own rows as they stream by, so nothing is shuffled, a lost task is done again alone, and a task holds one
Arrow batch and one window.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqframe.llm.token_ids import definition_of, ids_of

#: Examples that wait in a task at a time.
WINDOW = 2048
#: An example is not cut to fill fewer free tokens than these.
LEAST_PIECE = 16
_INDEX_BITS = 33  # of a sequence's number: partition above, count within it below


@dataclass(frozen=True)
class Limits:
    """What one sequence holds at most."""

    tokens: int = 4096
    segments: int = 1024
    loss: int = 4096


class Waiting:
    """Examples that have no place yet, as columns; ``demand`` is (tokens, 1, tokens with loss) of what is left."""

    def __init__(self, limits: Limits):
        self.limits = np.array([limits.tokens, limits.segments, limits.loss], np.float64)
        self.examples: list[tuple[int, np.ndarray, int]] = []  # row, ids, ids before the first with loss
        self.start = np.zeros(0, np.int64)
        self.demand = np.zeros((3, 0))
        self.new: list[tuple[tuple[int, np.ndarray, int], int]] = []

    def __len__(self) -> int:
        return len(self.examples) + len(self.new)

    def add(self, row: int, ids: np.ndarray, silent: int, start: int) -> None:
        self.new.append(((row, ids, silent), start))

    def ready(self) -> None:
        """Move what came in to the columns."""
        if self.new:
            self.examples += [e for e, _ in self.new]
            start = np.array([s for _, s in self.new], np.int64)
            size, silent = (np.array([f(e) for e, _ in self.new], np.int64) for f in (lambda e: len(e[1]), lambda e: e[2]))
            self.start = np.concatenate([self.start, start])
            self.demand = np.concatenate([self.demand, np.stack([size - start, np.ones(len(size)), size - np.maximum(start, silent)])], axis=1)
            self.new = []

    def best(self, left: np.ndarray, weights: np.ndarray, fits: bool) -> int:
        """The example that fits (or, where a cut is sought, has more tokens than are left) and points most along ``left``; -1 if none."""
        ok = (self.demand <= left[:, None]).all(axis=0) if fits else self.demand[0] > 0
        if not ok.any():
            return -1
        along = (weights * left / self.limits**2) @ self.demand
        return int(np.argmax(np.where(ok, along, -1.0)))

    def take(self, at: int, tokens: int) -> tuple[int, int, int, np.ndarray, int]:
        """(row, start, tokens with loss, ids, all tokens) of the next ``tokens`` ids of an example."""
        row, ids, silent = self.examples[at]
        start = int(self.start[at])
        loss = max(0, start + tokens - max(start, silent))
        self.start[at] += tokens
        self.demand[:, at] -= (tokens, 0, loss)
        if not self.demand[0, at]:
            self.demand[1, at] = 1e18  # gone; removed with the others at the end of a round
        return row, start, loss, ids[start : start + tokens], len(ids)

    def clean(self) -> None:
        kept = np.flatnonzero(self.demand[0] > 0)
        self.examples = [self.examples[k] for k in kept.tolist()]
        self.start, self.demand = self.start[kept], self.demand[:, kept]


def _prefix(left: np.ndarray, start: int, size: int, silent: int) -> int:
    """How many ids from ``start`` on fit into what is left."""
    return int(min(size - start, left[0], max(silent - start, 0) + left[2]))


def _sequences(waiting: Waiting, stay: int, cut: bool) -> Iterator[list[tuple[int, int, int, np.ndarray, int]]]:
    """Fill sequences until ``stay`` examples at most still wait; each is a list of pieces in their order."""
    waiting.ready()
    demand = waiting.demand.sum(axis=1)
    weights = demand / np.maximum((demand / waiting.limits).sum(), 1e-300) / waiting.limits  # shares of all demand
    count = len(waiting.examples)
    while count > stay:
        pieces, left = [], waiting.limits.copy()
        while (at := waiting.best(left, weights, True)) >= 0:
            tokens = int(waiting.demand[0, at])
            pieces.append(waiting.take(at, tokens))
            left -= (tokens, 1, pieces[-1][2])
            count -= 1
        while cut and left[1] >= 1 and left[0] >= LEAST_PIECE and count:
            at = waiting.best(left, weights, False)
            tokens = _prefix(left, int(waiting.start[at]), len(waiting.examples[at][1]), waiting.examples[at][2]) if at >= 0 else 0
            if tokens < LEAST_PIECE:
                break
            pieces.append(waiting.take(at, tokens))
            left -= (tokens, 1, pieces[-1][2])
        yield pieces
    waiting.clean()


def _by_powers(pieces: list, free: int, cut: bool) -> list[list]:
    """One sequence; or, where much would be padded, sequences of powers of two that need no padding."""
    if free < LEAST_PIECE or not cut:
        return [pieces]
    total, out, queue = sum(len(p[3]) for p in pieces), [], list(pieces)[::-1]
    for bit in range(total.bit_length() - 1, -1, -1):
        room = total & (1 << bit)
        if room:
            out.append([])
        while room:
            row, start, loss, ids, size = queue.pop()
            n = min(room, len(ids))
            if n < len(ids):  # loss falls on the last ids of a piece
                after = min(loss, len(ids) - n)
                queue.append((row, start + n, after, ids[n:], size))
                ids, loss = ids[:n], loss - after
            out[-1].append((row, start, loss, ids, size))
            room -= n
    return out


def _texts(definition: str, batch: pa.RecordBatch, end: int) -> Iterator[tuple[np.ndarray, int]]:
    """(ids with the end, ids of the prompt) of every row of (id, prompt, text)."""
    known, close = ids_of(definition), np.array([end], np.uint32)

    def column(k):
        for ids, edges in known.blocks(batch.column(k)):
            for r in range(len(edges) - 1):
                yield ids[edges[r] : edges[r + 1]]

    for prompt, text in zip(column(1), column(2), strict=True):
        yield np.concatenate([prompt, text, close]), len(prompt)


def _packer(definition, limits: Limits, end: int, cut: bool, window: int, with_ids: bool, id_type: pa.DataType):
    def run(batches):
        waiting, names, number = Waiting(limits), [], TaskContext.get().partitionId() << _INDEX_BITS
        rows: list[tuple] = []

        def placed(sequences):
            nonlocal number
            for pieces in sequences:
                for each in _by_powers(pieces, limits.tokens - sum(len(p[3]) for p in pieces), cut):
                    offset = 0
                    for row, start, loss, ids, size in each:
                        rows.append((row, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), loss, size, number, offset, ids if with_ids else None))
                        offset += len(ids)
                    number += 1

        def out():
            """The placed pieces; names of rows that nothing waits for are forgotten."""
            nonlocal rows, names
            columns = list(zip(*rows, strict=True)) if rows else [()] * 9
            kept = {row: k for k, row in enumerate(sorted({e[0] for e in waiting.examples} | {e[0] for e, _ in waiting.new}))}
            arrays = [pa.array([names[r] for r in columns[0]], id_type), *(pa.array(c, pa.int64()) for c in columns[1:8])]
            if with_ids:
                arrays.append(pa.array([None if c is None else c.astype(np.int32) for c in columns[8]], pa.list_(pa.int32())))
            names = [names[row] for row in kept]
            waiting.examples = [(kept[row], ids, silent) for row, ids, silent in waiting.examples]
            waiting.new = [((kept[e[0]], e[1], e[2]), start) for e, start in waiting.new]
            rows = []
            return pa.record_batch(arrays, ["id", "start", "length", "crc", "loss", "size", "sequence", "offset", "ids"][: len(arrays)])

        whole = np.array([limits.tokens, limits.segments, limits.loss], np.float64)
        for batch in batches:
            for name, (ids, silent) in zip(batch.column(0).to_pylist(), _texts(definition.value, batch, end), strict=True):
                row, start = len(names), 0
                names.append(name)
                # What no sequence holds is cut; a part that fills one is placed at once.
                while (n := _prefix(whole, start, len(ids), silent)) < len(ids) - start:
                    part = (row, start, max(0, start + n - max(start, silent)), ids[start : start + n], len(ids))
                    placed([[part]])
                    start += n
                waiting.add(row, ids, silent, start)
                if len(waiting) >= window:
                    placed(_sequences(waiting, window // 2, cut))
                if len(rows) >= 8 * window:
                    yield out()
            yield out()
        placed(_sequences(waiting, 0, cut))
        yield out()

    return run


def packed(
    examples: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    prompt_col: str | None = None,
    limits: Limits = Limits(),
    end: int = 2,
    cut: bool = True,
    window: int = WINDOW,
    with_ids: bool = True,
) -> DataFrame:
    """One row per piece: ``id_col``, start, length, ids_crc32, loss_tokens, doc_tokens, sequence_id, offset and,
    unless ``with_ids`` is false, ids.

    An example is the ids of its prompt (if any), its text and ``end``; ids of a prompt bear no loss. ``tokenizer``
    is the path of the definition on the driver, whose text is sent to the workers. Examples that one sequence
    cannot hold are always cut; others only with ``cut``. Then, where more than a few tokens of a sequence stay free
    (at the end of a partition, or when another limit is met), it is split into sequences of powers of two as well.

    Null and empty texts are the end alone. Every row is an example of its own, whatever its id; null ids stay.
    Very long texts are cut into full sequences as they come. An empty table gives no rows. Which examples share a
    sequence depends on how rows lie in partitions; each id lies in exactly one piece however they lie.
    """
    if min(limits.tokens, limits.segments, limits.loss) < 1:
        raise ValueError("every limit must be positive")
    kind = examples.schema[id_col].dataType
    from pyspark.sql.pandas.types import to_arrow_type

    prompt = F.lit(None) if prompt_col is None else F.col(prompt_col)
    rows = examples.select(F.col(id_col).alias("id"), prompt.cast("string").alias("prompt"), F.col(text_col).cast("string").alias("text"))
    definition = examples.sparkSession.sparkContext.broadcast(definition_of(tokenizer))
    schema = f"id {kind.simpleString()}, start long, length long, crc long, loss long, size long, sequence long, offset long" + ", ids array<int>" * with_ids
    out = rows.mapInArrow(_packer(definition, limits, end, cut, window, with_ids, to_arrow_type(kind)), schema)
    names = {"id": id_col, "crc": "ids_crc32", "loss": "loss_tokens", "size": "doc_tokens", "sequence": "sequence_id"}
    return out.withColumnsRenamed(names)
