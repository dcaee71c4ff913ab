"""Quality rules: a logistic regression on hashed word and character n-grams, with calibrated scores.

The regression learns from labelled rows (a bounded sample); its scores become probabilities by a
logistic curve fitted on rows that it has not seen. Texts are scored in Arrow batches: an n-gram's weight
is looked up by its hash, so a text costs a few passes over its bytes. Fixed thresholds decide.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqframe.llm.words import SPACED, Block, Hasher, U, blocks, byte_class, byte_values, mixed, runs, shingles, words

#: log2 of the number of hashed features.
BITS = 16
#: Labelled rows that the regression is fitted on at most; beyond that, those with the smallest hash of their id.
SAMPLE = 4_000
#: Characters (bytes) in a character n-gram.
CHARS = 3
#: Features are shares times this, so that steps of the fit are of a like size.
SCALE = 30.0
THRESHOLD = 0.5
#: The symbols that the base rules count.
SYMBOLS = "#*$%&|<>"


def features(block: Block, hasher: Hasher, bits: int = BITS) -> list[tuple[np.ndarray, np.ndarray]]:
    """Families of hashed n-grams: (feature numbers, first of each row and the end)."""
    values, shift = byte_values(lower=False), U(64 - bits)
    data, edges = block.data, block.edges
    grams = np.zeros(max(len(data) - CHARS + 1, 0), U)
    for k in range(CHARS):
        grams = grams * U(0x5851F42D4C957F2D) + values[data[k : len(grams) + k]]
    inside = np.ones(len(grams), bool)
    for back in range(1, CHARS):  # grams that would cross into the next row
        at = edges[1:-1] - back
        inside[at[(at >= 0) & (at < len(grams))]] = False
    kept = np.concatenate([[0], np.cumsum(inside)])
    chars = (mixed(grams[inside]) >> shift).astype(np.int32)
    w = words(block)
    hashes = hasher.ranges(data, w.starts, w.ends)
    pairs, pair_rows = shingles(hashes, w.rows, 2, short=False)
    families = [(chars, kept[np.minimum(edges, len(grams))])]
    for h, rows in ((hashes, w.rows), (pairs, pair_rows)):
        families.append(((mixed(h + U(7)) >> shift).astype(np.int32), rows))
    return families


def per_row(values: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Sums of the values of each row."""
    if values.dtype.kind == "f":  # each row on its own, so that no sum depends on the rows before
        out, full = np.zeros(len(rows) - 1, values.dtype), np.flatnonzero(np.diff(rows))
        if len(full):
            out[full] = np.add.reduceat(values, rows[:-1][full])
        return out
    sums = np.concatenate([np.zeros(1, np.int64), np.cumsum(values)])
    return sums[rows[1:]] - sums[rows[:-1]]


def _vectors(batches):
    """Each labelled text as its distinct features and their shares within each family."""
    hasher = Hasher(lower=False)
    for batch in batches:
        at, share = [], []
        for block in blocks(batch.column(1)):
            families = features(block, hasher)
            for r in range(block.rows):
                parts = []
                for k, (numbers, rows) in enumerate(families):
                    mine = numbers[rows[r] : rows[r + 1]]
                    found, n = np.unique(mine, return_counts=True)
                    parts.append((found + (k << BITS), n / max(len(mine), 1)))
                at.append(np.concatenate([p[0] for p in parts]).astype(np.int32).tobytes())
                share.append(np.concatenate([p[1] for p in parts]).astype(np.float32).tobytes())
        yield pa.record_batch([batch.column(0), pa.array(at, pa.binary()), pa.array(share, pa.binary())], ["label", "at", "share"])


def fit(rows: list, rounds: int = 120, rate: float = 1.0, decay: float = 1e-6) -> tuple[np.ndarray, float, float]:
    """Weights, and slope and offset of the calibration. rows: (label, features, shares).

    Classes have equal weight, and steps are those of an adaptive gradient. Every fifth row is kept for the
    calibration.
    """
    size = 3 << BITS
    y = np.array([r[0] for r in rows], np.float64)
    at = [np.frombuffer(r[1], np.int32) for r in rows]
    lengths = np.array([len(a) for a in at])
    row, at = np.repeat(np.arange(len(rows)), lengths), np.concatenate([*at, np.zeros(0, np.int32)])
    share = np.concatenate([*(np.frombuffer(r[2], np.float32) for r in rows), np.zeros(0, np.float32)])
    x = SCALE * share.astype(np.float64)
    held = np.arange(len(rows)) % 5 == 4 if len(rows) >= 25 else np.zeros(len(rows), bool)
    learn = ~held
    balance = np.where(y > 0, 0.5 / max(y[learn].sum(), 1), 0.5 / max((1 - y)[learn].sum(), 1)) * learn
    w, b, past, past_b = np.zeros(size), 0.0, np.full(size, 1e-8), 1e-8
    for _ in range(rounds):
        z = np.bincount(row, x * w[at], len(rows)) + b
        g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) * balance
        down, down_b = np.bincount(at, x * g[row], size) + decay * w, g.sum()
        past, past_b = past + down**2, past_b + down_b**2
        w, b = w - rate * 0.3 * down / np.sqrt(past), b - rate * 0.3 * down_b / np.sqrt(past_b)
    z = np.bincount(row, x * w[at], len(rows)) + b
    check = held if held.any() else learn
    s = z[check]
    t = np.where(y[check] > 0, (y[check].sum() + 1) / (y[check].sum() + 2), 1 / ((1 - y[check]).sum() + 2))
    slope, offset = 1.0, 0.0
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(slope * s + offset, -30, 30)))
        v = np.maximum(p * (1 - p), 1e-6)
        grad = np.array([((p - t) * s).sum() + 1e-3 * (slope - 1), (p - t).sum()])
        hess = np.array([[(v * s * s).sum() + 1e-3, (v * s).sum()], [(v * s).sum(), v.sum() + 1e-6]])
        move = np.clip(np.linalg.solve(hess, grad), -1, 1)
        slope, offset = slope - move[0], offset - move[1]
    return np.append(w, b).astype(np.float32), float(slope), float(offset)


def _scored(model):
    symbol = byte_class(*((ord(c), ord(c)) for c in SYMBOLS))
    line = ~byte_class((10, 10))

    def base(block: Block, hasher: Hasher) -> list[np.ndarray]:
        data, w = block.data, words(block)
        first = (data & 0xC0) != 0x80  # one byte of each code point
        count = lambda flags: per_row(flags.astype(np.int64), block.edges)
        lines = runs(line[data], block.edges)
        filled = np.searchsorted(w.starts, lines.ends) > np.searchsorted(w.starts, lines.starts)
        keys, owner = hasher.ranges(data, lines.starts, lines.ends)[filled], lines.row_of()[filled]
        twice = len_distinct(keys, owner, block.rows)
        grams, rows = shingles(hasher.ranges(data, w.starts, w.ends), w.rows, 5, short=False)
        of = np.repeat(np.arange(block.rows), np.diff(rows))
        key = mixed(grams + of.astype(U) * U(0x9E3779B97F4A7C15))
        order = np.argsort(key)
        same = key[order][1:] == key[order][:-1]
        again = np.zeros(len(key), bool)
        again[order[1:][same]] = again[order[:-1][same]] = True
        cover = np.zeros(len(w.starts) + 6, np.int64)  # windows lie over five words from their own place on
        at = (np.arange(len(key)) + np.repeat(w.rows[:-1] - rows[:-1], np.diff(rows)))[again]
        np.add.at(cover, at, 1)
        np.add.at(cover, at + 5, -1)
        covered = (np.cumsum(cover)[: len(w.starts)] > 0).astype(np.int64)
        return [np.diff(w.rows), count(first & SPACED[data]), count(symbol[data]), np.bincount(owner, minlength=block.rows) - twice, per_row(covered, w.rows)]

    def run(batches):
        weights, slope, offset = model.value
        hasher, tables = Hasher(lower=False), weights[:-1].reshape(3, -1)
        for batch in batches:
            columns = [[] for _ in range(6)]
            for block in blocks(batch.column(1)):
                z = np.full(block.rows, weights[-1], np.float64)
                for r, (numbers, rows) in enumerate(features(block, hasher)):
                    z += share_score(numbers, rows, tables[r])
                for column, new in zip(columns, [*base(block, hasher), 1 / (1 + np.exp(-np.clip(slope * z + offset, -30, 30)))], strict=True):
                    column.append(new)
            kinds = [np.int64] * 5 + [np.float64]
            yield pa.record_batch([batch.column(0), *(pa.array(np.concatenate([np.zeros(0, k), *c]).astype(k)) for c, k in zip(columns, kinds, strict=True))], ["id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "score"])

    return run


def len_distinct(keys: np.ndarray, owner: np.ndarray, rows: int) -> np.ndarray:
    """How many different keys each row has."""
    order = np.lexsort((keys, owner))
    k, o = keys[order], owner[order]
    new = np.append(True, (k[1:] != k[:-1]) | (o[1:] != o[:-1]))[: len(k)]
    return np.bincount(o[new], minlength=rows)


def share_score(numbers: np.ndarray, rows: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Sum over a row's n-grams of the weight, as a share of their number."""
    return SCALE * per_row(table[numbers].astype(np.float64), rows) / np.maximum(np.diff(rows), 1)


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE) -> DataFrame:
    """One row per input row: ``id_col``, the base counts and ``score``, the calibrated probability of label 1 (action: fits).

    Labels other than 0 and 1 are not used; an id with several labels has the largest. Without labels of both
    classes every score is that of the empty model. Of the texts of a labelled id the least is learnt from. Equal scores of
    equal texts do not depend on where rows lie. Null and empty texts have counts of 0.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    labels = labels.filter(F.col(label_col).isin(0, 1)).groupBy(F.col(id_col).alias("id_")).agg(F.max(label_col).cast("double").alias("label"))
    chosen = labels.filter("id_ is not null").orderBy(F.xxhash64("id_"), "id_").limit(sample)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = texts.join(F.broadcast(chosen), F.col("id") == F.col("id_")).filter("text is not null")
    # One text of an id, so that no more than the sample comes to the driver.
    rows = rows.groupBy("id").agg(F.max("label").alias("label"), F.min("text").alias("text"))
    vectors = rows.select("label", "text", "id").mapInArrow(_keyed_vectors, f"label double, at binary, share binary, id {kind}")
    found = sorted(vectors.toLocalIterator(), key=lambda r: (str(r.id), r.at))[:sample]
    both = {r.label for r in found} == {0.0, 1.0}
    model = fit(found) if both else (np.zeros((3 << BITS) + 1, np.float32), 1.0, 0.0)
    scored = texts.mapInArrow(_scored(docs.sparkSession.sparkContext.broadcast(model)), f"id {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, score double")
    return scored.withColumnRenamed("id", id_col)


def _keyed_vectors(batches):
    for batch in batches:
        for out in _vectors([batch.select(["label", "text"])]):
            yield pa.record_batch([*out.columns, batch.column(2)], ["label", "at", "share", "id"])


def quality_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", threshold: float = THRESHOLD, **options) -> DataFrame:
    """``quality_scores`` with base_failed (few words, or too many in repeated windows) and kept."""
    scored = quality_scores(docs, labels, id_col, **options)
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return scored.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold))
