"""Token counts by a two-tier lookup on the map side.

A merge never crosses a pre-token, and a text is cut where pre-tokens must end: before white space, and where a letter
meets an ASCII character that is none. The pieces, white space in front, are looked up by hash. First tier: token counts
of pieces that are frequent in a sample of the corpus, in one compact table (sorted hashes and counts) sent to every
worker. Second tier: what that table misses is encoded once and kept in the worker's bounded cache, which
outlives a task. No piece is shuffled; no result depends on what the table holds.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqframe.llm.token_ids import LATIN, LETTER, OTHER, Encoder, definition_of, per_worker
from seqframe.llm.words import SPACED, U, Block, Hasher, Words, blocks, byte_class, signed, unsigned, words

#: Entries of the table, and documents that it is chosen from (every 64th by hash of the text, so many at most).
FREQUENT, SAMPLE, SAMPLE_OF = 50_000, 4_000, 64
#: Entries of a worker's cache; beyond them it starts anew.
CACHE = 1_000_000
#: First two bytes, and the third ones where they matter, of white space beyond ASCII.
WIDE_SPACES = ((0xC2, 0x85, None), (0xC2, 0xA0, None), (0xE1, 0x9A, (0x80, 0x80)), (0xE1, 0xA0, (0x8E, 0x8E)), (0xE2, 0x80, (0x80, 0x8A)), (0xE2, 0x80, (0xA8, 0xAF)), (0xE2, 0x81, (0x9F, 0x9F)), (0xE3, 0x80, (0x80, 0x80)))
SEPARATORS = byte_class((0x1C, 0x1F))


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def in_pieces(definition: str) -> bool:
    """Whether tokens of pieces add up: byte-level, by its own pattern, nothing normalised and no space put in front."""
    parts = json.loads(definition)
    first = parts.get("pre_tokenizer") or {}
    return parts.get("normalizer") is None and first.get("type") == "ByteLevel" and not first.get("add_prefix_space") and first.get("use_regex", True)


def pieces(block: Block) -> Words:
    """White space with the word behind it, cut again behind letters; what is left at a row's end is a piece as well."""
    found, data = words(block, SPACED), block.data
    letter = LETTER[data]
    letter[1:] |= (data[:-1] == 0xC3) & LATIN[data[1:]]
    cuts = np.flatnonzero(letter[:-1] & OTHER[data[1:]]) + 1
    full = block.edges[:-1][block.edges[:-1] < block.edges[1:]]
    # Every piece but a row's first starts where the one before ends, and a row's last one ends with it.
    starts = np.unique(np.concatenate([full, cuts, found.ends[found.ends < len(data)]]))
    ends = np.append(starts[1:], len(data)) if len(starts) else starts
    return Words(starts, ends, np.searchsorted(starts, block.edges))


def wide_spaces(block: Block) -> np.ndarray:
    """Rows with white space beyond ASCII, which may run on across the place of a cut."""
    data = block.data
    hit = SEPARATORS[data]
    high = np.flatnonzero((data[:-1] == 0xC2) | ((data[:-1] >= 0xE1) & (data[:-1] <= 0xE3)))
    for a, b, third in WIDE_SPACES if len(high) else ():
        at = high[(data[high] == a) & (data[high + 1] == b)]
        if third:
            at = at[at + 2 < len(data)]
            at = at[(data[at + 2] >= third[0]) & (data[at + 2] <= third[1])]
        hit[at] = True
    sums = np.concatenate([[0], np.cumsum(hit)])
    return sums[block.edges[1:]] > sums[block.edges[:-1]]


class Counts:
    """Token counts by hash, in sorted arrays."""

    def __init__(self, keys: np.ndarray, sizes: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.sizes = keys[order], sizes[order].astype(np.int32)

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(found, counts)."""
        if not len(self.keys):
            return np.zeros(len(hashes), bool), np.zeros(len(hashes), np.int32)
        at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        return self.keys[at] == hashes, self.sizes[at]

    def add(self, hashes: np.ndarray, sizes: np.ndarray) -> None:
        at = np.searchsorted(self.keys, hashes)
        self.keys, self.sizes = np.insert(self.keys, at, hashes), np.insert(self.sizes, at, sizes)


class Lookup:
    """A worker's second tier: encoder, cache and hasher of one tokenizer."""

    def __init__(self, definition: str):
        self.encode, self.hasher, self.piecewise = Encoder(definition), Hasher(lower=False), in_pieces(definition)
        self.cache = Counts(np.zeros(0, U), np.zeros(0, np.int32))

    def lengths(self, texts: list[str]) -> np.ndarray:
        return np.array([len(e) for e in self.encode.tokenizer.encode_batch_fast(texts, add_special_tokens=False)], np.int64)

    def distinct(self, block: Block) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray]:
        found = pieces(block)
        return found, *np.unique(self.hasher.ranges(block.data, found.starts, found.ends), return_index=True, return_inverse=True)

    def texts(self, block: Block, found: Words, first: np.ndarray) -> list[str]:
        raw = block.data.tobytes()
        return [raw[a:b].decode() for a, b in zip(found.starts[first].tolist(), found.ends[first].tolist(), strict=True)]

    def counts(self, block: Block, table: Counts) -> np.ndarray:
        """Tokens of each row of a block."""
        found, hashes, first, which = self.distinct(block)
        if not len(hashes):
            return np.zeros(block.rows, np.int64)
        known, sizes = table.find(hashes)
        missed = np.flatnonzero(~known)
        if len(missed):
            if len(self.cache.keys) > CACHE:
                self.cache = Counts(np.zeros(0, U), np.zeros(0, np.int32))
            here = self.cache.find(hashes[missed])[0]
            new = missed[~here]
            if len(new):
                self.cache.add(hashes[new], self.lengths(self.texts(block, found, first[new])))
            sizes[missed] = self.cache.find(hashes[missed])[1]
        sums = np.concatenate([[0], np.cumsum(sizes[which], dtype=np.int64)])
        return sums[found.rows[1:]] - sums[found.rows[:-1]]


def lookup_of(definition: str) -> Lookup:
    return per_worker(("counts", hash(definition)), lambda: Lookup(definition))


def _whole(column, lookup: Lookup) -> np.ndarray:
    """Texts that hold a special string, or all if pieces do not add up."""
    whole = np.full(len(column), not lookup.piecewise)
    for special in lookup.encode.specials:
        whole |= np.asarray(pc.fill_null(pc.match_substring(column, special), False))
    return whole


def _frequent(definition):
    """(hash, n, tokens) of the most frequent pieces of all rows of a part."""

    def run(batches):
        lookup, keys, totals, sizes = lookup_of(definition.value), np.zeros(0, U), np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            for block in blocks(batch.column(0)):
                found, hashes, first, which = lookup.distinct(block)
                if len(hashes):
                    n = np.bincount(which)
                    lengths = lookup.lengths(lookup.texts(block, found, first)) if lookup.piecewise else np.zeros(len(hashes), np.int64)
                    every, at = np.unique(np.concatenate([keys, hashes]), return_inverse=True)
                    added, kept = np.zeros(len(every), np.int64), np.zeros(len(every), np.int64)
                    np.add.at(added, at, np.concatenate([totals, n]))
                    kept[at] = np.concatenate([sizes, lengths])
                    top = np.sort(np.argsort(-added, kind="stable")[: 4 * FREQUENT])
                    keys, totals, sizes = every[top], added[top], kept[top]
        top = np.argsort(-totals, kind="stable")[: FREQUENT if lookup.piecewise else 0]
        yield pa.record_batch({"hash": signed(keys[top]), "tokens": sizes[top]})

    return run


def _counts(definition, table):
    def run(batches):
        lookup, (keys, sizes) = lookup_of(definition.value), table.value
        known = Counts(keys, sizes)
        for batch in batches:
            column = batch.column(1)
            whole, totals = _whole(column, lookup), np.zeros(batch.num_rows, np.int64)
            for block in blocks(pc.if_else(pa.array(whole), pa.scalar("", column.type), column) if whole.any() else column):
                wide = wide_spaces(block)
                whole[block.first : block.first + block.rows] |= wide
                totals[block.first : block.first + block.rows] = lookup.counts(block, known)
            if whole.any():
                totals[whole] = lookup.lengths([t or "" for t in column.filter(pa.array(whole)).to_pylist()])
            yield pa.record_batch([batch.column(0), batch.column(2), pa.array(totals)], ["id", "bytes", "tokens"])

    return run


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = 1024, tokenizer: str | None = None) -> DataFrame:
    """One row per input row: ``id_col``, n_bytes, n_tokens, over_limit (action: chooses the table).

    ``tokenizer`` is the path of a definition on the driver, whose text is sent to the workers. Counts are those of the
    library without begin or end tokens; special strings inside a text are one token each. Null and empty texts have no
    bytes and no tokens. Repeated rows and ids are counted each; very long texts are read in whole. The table is chosen from
    a bounded sample of texts: what it holds changes cost, never counts.
    """
    context = docs.sparkSession.sparkContext
    shared = context.broadcast(definition_of(tokenizer or default_tokenizer()))
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    sample = docs.select("text").filter(F.pmod(F.xxhash64("text"), F.lit(SAMPLE_OF)) == 0).limit(SAMPLE).coalesce(1)
    frequent = sample.mapInArrow(_frequent(shared), "hash long, tokens long").toPandas()
    table = context.broadcast((unsigned(frequent["hash"].to_numpy(np.int64)), frequent["tokens"].to_numpy(np.int64)))
    kind = docs.schema["id"].dataType.simpleString()
    out = docs.select("id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("bytes")).mapInArrow(_counts(shared, table), f"id {kind}, bytes long, tokens long")
    return out.select(F.col("id").alias(id_col), F.col("bytes").alias("n_bytes"), F.col("tokens").alias("n_tokens"), (F.col("tokens") > limit).alias("over_limit"))
