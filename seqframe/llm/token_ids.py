"""Token ids of whole texts, found by hash instead of encoded again.

The tokenizer's pattern never matches across white space, nor across the place where a letter meets an ASCII
character that is none. A text is cut at such places into pieces; a piece's ids do not depend on what stands
around it. Each worker keeps the ids of the pieces that it has met, in arrays sorted by hash, so a block of
text costs a few numpy passes and only new pieces reach the tokenizer.
"""

from __future__ import annotations

import json
import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from seqframe.llm.words import SPACED, U, Block, Hasher, Words, blocks, byte_class, words

LETTER = byte_class((0x41, 0x5A), (0x61, 0x7A))
#: ASCII characters that are neither letters nor white space.
OTHER = byte_class((0x21, 0x40), (0x5B, 0x60), (0x7B, 0x7E))
#: Second bytes of the letters behind 0xC3 (all but the two signs among them).
LATIN = byte_class((0x80, 0x96), (0x98, 0xB6), (0xB8, 0xBF))
#: A worker forgets its pieces beyond so many.
PIECES = 1_000_000


def per_worker(key: object, make: Callable[[], object]) -> object:
    """A value made once per Python process, whatever the number of tasks that run there."""
    kept = sys.modules.setdefault("_seqframe_worker", types.ModuleType("_seqframe_worker")).__dict__
    if key not in kept:
        kept[key] = make()
    return kept[key]


def definition_of(path: str) -> str:
    with open(path, encoding="utf-8") as file:
        return file.read()


class Encoder:
    """The library's ids of single strings, without begin, end, padding or truncation."""

    def __init__(self, definition: str):
        from tokenizers import Tokenizer

        parts = json.loads(definition)
        steps = (parts.get("pre_tokenizer") or {}).get("pretokenizers", [{}])
        lowered = any(n.get("type") == "Lowercase" for n in (parts.get("normalizer") or {}).get("normalizers", []))
        #: Whether ids of pieces are those of the text: lower case, and white space falls out when words are split off.
        self.in_pieces = lowered and steps[0].get("type") == "Split" and steps[0].get("behavior") == "Removed" and bool(steps[0].get("invert"))

        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]

    def __call__(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


class Pieces:
    """Ids by hash. ``keys`` is sorted; entry i has ids ``pool[starts[i]:starts[i] + sizes[i]]``."""

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.keys, self.starts, self.sizes = np.zeros(0, U), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pool, self.used = np.zeros(1 << 16, np.uint32), 0

    def missing(self, hashes: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        return np.flatnonzero(self.keys[at] != hashes) if len(self.keys) else np.arange(len(hashes))

    def add(self, hashes: np.ndarray, ids: list[list[int]]) -> None:
        """``hashes`` are sorted and new."""
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        ends = self.used + np.cumsum(sizes)
        while ends[-1] > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        self.pool[self.used : ends[-1]] = np.fromiter((i for each in ids for i in each), np.uint32, ends[-1] - self.used)
        self.used, at = int(ends[-1]), np.searchsorted(self.keys, hashes)
        self.keys, self.starts, self.sizes = np.insert(self.keys, at, hashes), np.insert(self.starts, at, ends - sizes), np.insert(self.sizes, at, sizes)


def pieces(block: Block) -> Words:
    """Words cut again where a letter is followed by an ASCII character that is none."""
    found, data = words(block, SPACED), block.data
    letter = LETTER[data]
    letter[1:] |= (data[:-1] == 0xC3) & LATIN[data[1:]]
    cuts = np.flatnonzero(letter[:-1] & OTHER[data[1:]]) + 1
    cuts = cuts[~np.isin(cuts, found.starts, assume_unique=True)]
    starts, ends = np.sort(np.concatenate([found.starts, cuts])), np.sort(np.concatenate([found.ends, cuts]))
    return Words(starts, ends, np.searchsorted(starts, block.edges))


def gathered(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indexes of the runs ``starts[i]:starts[i] + sizes[i]``, one after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


class Ids:
    """Ids of the texts of Arrow columns, block by block."""

    def __init__(self, definition: str, pieces_kept: int = PIECES):
        self.encode, self.known, self.hasher, self.bound = Encoder(definition), Pieces(), Hasher(lower=True), pieces_kept

    def blocks(self, column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(ids, edges) of consecutive rows: row i of them has ``ids[edges[i]:edges[i + 1]]``; null is empty."""
        whole = np.full(len(column), not self.encode.in_pieces)
        for special in self.encode.specials:
            whole |= np.asarray(pc.fill_null(pc.match_substring(column, special), False))
        # Ids of special strings need the text as it stands.
        alone = dict(zip(np.flatnonzero(whole).tolist(), self.encode([t or "" for t in column.filter(pa.array(whole)).to_pylist()]), strict=True)) if whole.any() else {}
        plain = pc.if_else(pa.array(whole), pa.scalar("", column.type), column) if alone else column
        for block in blocks(plain):
            ids, edges = self._block(block)
            rows = [r for r in range(block.first, block.first + block.rows) if r in alone] if alone else []
            if rows:
                lists = [np.array(alone[r + block.first], np.uint32) if r + block.first in alone else ids[edges[r] : edges[r + 1]] for r in range(block.rows)]
                ids, edges = np.concatenate(lists), np.concatenate([[0], np.cumsum([len(x) for x in lists])])
            yield ids, edges

    def _block(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        found = pieces(block)
        if not len(found.starts):
            return np.zeros(0, np.uint32), np.zeros(block.rows + 1, np.int64)
        hashes, first, which = np.unique(self.hasher.ranges(block.data, found.starts, found.ends), return_index=True, return_inverse=True)
        if len(self.known.keys) > self.bound:
            self.known.clear()
        new = self.known.missing(hashes)
        if len(new):
            raw = block.data.tobytes()
            self.known.add(hashes[new], self.encode([raw[a:b].decode() for a, b in zip(found.starts[first[new]].tolist(), found.ends[first[new]].tolist(), strict=True)]))
        at = np.searchsorted(self.known.keys, hashes)[which]
        sizes = self.known.sizes[at]
        edges = np.concatenate([[0], np.cumsum(sizes)])[found.rows]
        return self.known.pool[gathered(self.known.starts[at], sizes)], edges


def ids_of(definition: str, bound: int = PIECES) -> Ids:
    """This worker's pieces of one tokenizer; they outlive a task."""
    return per_worker(("ids", hash(definition), bound), lambda: Ids(definition, bound))
