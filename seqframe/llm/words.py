"""Words, shingles and hashes of a column of texts, with numpy over the bytes of an Arrow batch.

A block is a run of rows whose UTF-8 bytes lie one after the other. Nothing here loops over words:
a word's hash is a difference of running sums, so the work is a few passes over the bytes. Hashes
have 64 bits; equal hashes are taken as equal words and shingles.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

U = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1  # odd, so that it has an inverse modulo 2**64
BLOCK = 1 << 20


class Block(NamedTuple):
    """Rows ``first`` to ``first + rows`` of a batch; row i has bytes ``edges[i]:edges[i + 1]``."""

    first: int
    rows: int
    data: np.ndarray
    edges: np.ndarray


def blocks(column, size: int = BLOCK) -> Iterator[Block]:
    """Cut a text column into blocks of about ``size`` bytes (one row at least); null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    n = len(column)
    edges = np.frombuffer(column.buffers()[1], np.int64, n + 1, column.offset * 8) if n else np.zeros(1, np.int64)
    raw = column.buffers()[2] if n else None
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(edges, edges[at] + size, "right")) - 1)
        yield Block(at, to - at, data[edges[at] : edges[to]], edges[at : to + 1] - edges[at])
        at = to


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


#: `[^\x20\x09-\x0D]+`
SPACED = ~byte_class((0x20, 0x20), (0x09, 0x0D))
#: `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` in a lower-cased text
ALNUM = byte_class((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))


def byte_values(lower: bool) -> np.ndarray:
    """A random number for each byte value; with ``lower`` A-Z have the numbers of a-z."""
    values = np.random.RandomState(20240601).randint(1, 2**63 - 1, 256, dtype=np.int64).astype(U)
    if lower:
        values[65:91] = values[97:123]
    return values


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n + 1, U(base), U)
    out[0] = 1
    return np.cumprod(out, dtype=U)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of each number (the finishing step of a public 64-bit hash)."""
    x = x ^ (x >> U(33))
    x = x * U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> U(33))
    x = x * U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U(33))


class Hasher:
    """Hashes of byte ranges of a block; keeps its powers from block to block."""

    def __init__(self, lower: bool):
        self.values, self.size = byte_values(lower), 0

    def ranges(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if len(data) > self.size or not self.size:
            self.size = max(len(data), BLOCK)
            self.up, self.down = powers(BASE, self.size), powers(pow(BASE, -1, 1 << 64), self.size)
        sums = np.zeros(len(data) + 1, U)
        np.cumsum(self.values[data] * self.up[: len(data)], out=sums[1:])
        return mixed((sums[ends] - sums[starts]) * self.down[starts] + (ends - starts).astype(U) * U(0x632BE59BD9B4E019))


class Words(NamedTuple):
    """Words of a block: byte starts and ends, and for each row the first word's number (and the end)."""

    starts: np.ndarray
    ends: np.ndarray
    rows: np.ndarray

    def row_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.rows) - 1), np.diff(self.rows))


def runs(flags: np.ndarray, edges: np.ndarray) -> Words:
    """Maximal runs of set flags; none crosses a row's edge."""
    inner = edges[:-1][edges[:-1] < edges[-1]]  # rows that are empty at the end start nowhere
    before, after = np.zeros(len(flags), bool), np.zeros(len(flags), bool)
    before[1:], after[:-1] = flags[:-1], flags[1:]
    before[inner] = False
    after[inner[inner > 0] - 1] = False
    starts = np.flatnonzero(flags & ~before)
    return Words(starts, np.flatnonzero(flags & ~after) + 1, np.searchsorted(starts, edges))


def words(block: Block, kind: np.ndarray = SPACED) -> Words:
    return runs(kind[block.data], block.edges)


def shingles(hashes: np.ndarray, rows: np.ndarray, n: int, short: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of n words, row after row, and each row's first shingle (and the end).

    With ``short`` a row of fewer words has its whole sequence as one shingle.
    """
    counts = np.diff(rows)
    full = np.maximum(counts - n + 1, 0)
    few = (counts > 0) & (full == 0) if short else np.zeros(len(counts), bool)
    out_rows = np.zeros(len(rows), np.int64)
    np.cumsum(full + few, out=out_rows[1:])
    sums = np.zeros(max(len(hashes) - n + 1, 0), U)
    for k in range(n):
        sums = sums + hashes[k : len(sums) + k] * U(2 * (0x5851F42D4C957F2D >> k) + 1)
    at = np.repeat(rows[:-1] - out_rows[:-1], full + few) + np.arange(out_rows[-1])
    out = mixed(sums[np.minimum(at, len(sums) - 1)]) if len(sums) else np.zeros(out_rows[-1], U)
    for r in np.flatnonzero(few):
        total = np.array([counts[r]]).astype(U)
        for k, h in enumerate(hashes[rows[r] : rows[r + 1]]):
            total = total + mixed(np.array([h], U) + U(k + 1))
        out[out_rows[r]] = mixed(total)[0]
    return out, out_rows


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def unsigned(x: np.ndarray) -> np.ndarray:
    return x.view(U)


def list_array(values: np.ndarray, rows: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(rows.astype(np.int32)), pa.array(values))


def binaries(items: list[bytes]) -> pa.Array:
    return pa.array(items, pa.binary())
