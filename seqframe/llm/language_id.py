"""Language identification with string kernels, Nystroem landmarks and kernel ridge regression.

A text is the set of byte n-grams (one to three bytes, in one blended spectrum) that it holds. The kernel of
two texts is the number of n-grams present in both over the root of the product of their own numbers.
Landmarks are labelled texts; a text's kernel values with them, whitened by the landmarks' own kernel, are
its coordinates, and a ridge regression of one column per language against the rest is fitted on those. A
batch is scored by two matrix products: presence times landmarks, then kernel times coefficients.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seqframe.llm.words import U, blocks, byte_values, mixed
from seqframe.session import broadcast_if_small, written

#: Lengths of n-grams (each one byte more than the last), and log2 of the number of hashed ones for each length.
LENGTHS, BITS = (1, 2, 3), 12
#: Labelled texts of each language that are fitted on at most, those with the smallest hash; and landmarks among them.
SAMPLE, LANDMARKS = 400, 32
#: The same over all languages. Where these are many each has fewer, four texts and one landmark at least; none is left out.
ALL_SAMPLES, ALL_LANDMARKS = 12_800, 1_024
RIDGE = 1e-2
#: Texts whose presences a task holds at a time, 49 kilobytes each, beside as much again while they are made.
HELD = 200
NONE = "und"


def presence(column) -> np.ndarray:
    """One row of 0 and 1 for each text: which hashed n-grams it holds. A-Z count as a-z."""
    values, shift, width = byte_values(lower=True), U(64 - BITS), 1 << BITS
    parts = []
    for block in blocks(column):
        out = np.zeros((block.rows, len(LENGTHS) * width), np.float32)
        flat, row = out.reshape(-1), np.repeat(np.arange(block.rows) * out.shape[1], np.diff(block.edges))
        gram, ends = np.zeros(len(block.data), U), np.repeat(block.edges[1:], np.diff(block.edges))
        for k, n in enumerate(LENGTHS):
            gram = gram[: max(len(block.data) - n + 1, 0)] * U(0x5851F42D4C957F2D) + values[block.data[n - 1 :]]
            here = np.arange(n, len(gram) + n) <= ends[: len(gram)]
            flat[row[: len(gram)][here] + k * width + (mixed(gram[here]) >> shift).astype(np.int64)] = 1
        parts.append(out)
    return np.concatenate(parts) if parts else np.zeros((0, len(LENGTHS) * width), np.float32)


def lettered(text: str | None) -> bool:
    return any(map(str.isalpha, text or ""))


def kernel(x: np.ndarray, landmarks: np.ndarray) -> np.ndarray:
    size = lambda m: np.sqrt(np.maximum(m.sum(1), 1))
    return (x @ landmarks.T) / size(x)[:, None] / size(landmarks)[None, :]


def fit(bits: np.ndarray, names: list[str]) -> tuple[np.ndarray, np.ndarray, list[str], float]:
    """Landmarks, coefficients of each language, languages, sharpness of the score; ``bits`` are packed presences."""
    languages, which, counts = np.unique(np.array(names, object).astype(str), return_inverse=True, return_counts=True)
    unpacked = lambda rows: np.unpackbits(rows, axis=1).astype(np.float32)
    per = max(1, min(LANDMARKS, ALL_LANDMARKS // len(languages)))
    landmarks = unpacked(bits[np.concatenate([np.flatnonzero(which == k)[:per] for k in range(len(languages))])])
    values, vectors = np.linalg.eigh(kernel(landmarks, landmarks).astype(np.float64))
    keep = values > 1e-6 * values.max()
    white = vectors[:, keep] / np.sqrt(values[keep])
    weight = len(names) / (len(languages) * counts[which])
    gram = np.zeros((white.shape[1] + 1,) * 2)
    right = np.zeros((white.shape[1] + 1, len(languages)))
    for at in range(0, len(bits), 500):
        part = slice(at, at + 500)
        ones = np.column_stack([kernel(unpacked(bits[part]), landmarks) @ white, np.ones(len(bits[part]))])
        target = np.where(which[part, None] == np.arange(len(languages)), 1.0, -1.0)
        gram += ones.T @ (ones * weight[part, None])
        right += ones.T @ (target * weight[part, None])
    gram += RIDGE * np.diag([*[1.0] * white.shape[1], 0.0])
    solved = np.linalg.solve(gram + 1e-9 * np.eye(len(gram)), right)
    return landmarks, np.vstack([white @ solved[:-1], solved[-1:]]).astype(np.float32), languages.tolist(), 4.0


def decide(x: np.ndarray, model) -> tuple[np.ndarray, np.ndarray]:
    """Number of the best language and its share of the softened margins, for each text."""
    landmarks, solved, _, sharp = model
    margins = kernel(x, landmarks) @ solved[:-1] + solved[-1]
    soft = np.exp(sharp * (margins - margins.max(1, keepdims=True)))
    return margins.argmax(1), (soft.max(1) / soft.sum(1)).astype(np.float64)


def _predicted(model):
    def run(batches):
        fitted = model.value
        for whole in batches:
            for at in range(0, max(whole.num_rows, 1), HELD):
                batch = whole.slice(at, HELD)
                if fitted is None:
                    best, score, languages = np.zeros(batch.num_rows, int), np.zeros(batch.num_rows), [NONE]
                else:
                    best, score = decide(presence(batch.column(1)), fitted)
                    languages = fitted[2]
                named = [lettered(t) for t in batch.column(1).to_pylist()]
                yield pa.record_batch([batch.column(0), pa.array([languages[b] if n else NONE for b, n in zip(best, named, strict=True)], pa.string()), pa.array(np.where(named, score, 0.0))], ["id", "lang_pred", "score"])

    return run


def trained(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"):
    """A model from the rows of ``docs`` with a text and a language, or None (action).

    Every language is learnt, however many there are; copies of a text count once. Equal margins go to the language
    that comes first by its name.
    """
    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    rows = rows.filter("lang is not null and text is not null and length(trim(text)) > 0")
    languages = rows.agg(F.count_distinct("lang")).first()[0]
    if not languages:
        return None
    # The sample: in each language the least hashes of its different texts; a task keeps no more of a language than are
    # chosen, only hashes move, and texts come by a join.
    per = max(4, min(SAMPLE, ALL_SAMPLES // languages))
    keys = rows.select("lang", F.xxhash64("text").alias("key")).distinct()
    chosen = keys.withColumn("at", F.row_number().over(Window.partitionBy("lang").orderBy("key"))).filter(F.col("at") <= per)
    chosen = written(chosen.select(F.col("lang").alias("lang_"), F.col("key").alias("key_")))
    found = rows.withColumn("key", F.xxhash64("text")).join(broadcast_if_small(chosen), (F.col("key") == F.col("key_")) & (F.col("lang") == F.col("lang_")))
    vectors = found.select("key", "lang", "text").mapInArrow(_bits, "key long, lang string, bits binary").groupBy("key", "lang").agg(F.any_value("bits").alias("bits"))
    sample = sorted((r.key, r.lang, bytes(r.bits)) for r in vectors.toLocalIterator())
    return fit(np.stack([np.frombuffer(bits, np.uint8) for _, _, bits in sample]), [lang for _, lang, _ in sample])


def _bits(batches):
    for batch in (whole.slice(at, HELD) for whole in batches for at in range(0, whole.num_rows, HELD)):
        packed = np.packbits(presence(batch.column(2)).astype(np.uint8), axis=1)
        yield pa.record_batch([batch.column(0), batch.column(1), pa.array([p.tobytes() for p in packed], pa.binary())], ["key", "lang", "bits"])


def predict(docs: DataFrame, model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id_col``, lang_pred, score (0 to 1).

    Texts that are null or have no letter are ``und`` with score 0, as are all texts if the model is None.
    Equal texts get equal results. Only the text is an input of a prediction.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_predicted(docs.sparkSession.sparkContext.broadcast(model)), f"id {kind}, lang_pred string, score double").withColumnRenamed("id", id_col)


def _recognised(model, at: int, least: float):
    def run(batches):
        predicted = _predicted(model)
        for batch in batches:
            texts = pa.record_batch([pa.array(range(batch.num_rows)), batch.column(at)], ["id", "text"])
            for part in predicted([texts]):
                keep = pc.and_(pc.not_equal(part.column(1), NONE), pc.greater_equal(part.column(2), least))
                first = part.column(0)[0].as_py() if part.num_rows else 0
                yield batch.slice(first, part.num_rows).filter(keep)

    return run


def recognised(docs: DataFrame, model, text_col: str = "text", least: float = 0.3) -> DataFrame:
    """The rows of ``docs``, all columns, whose text has a language with a score of ``least`` or more."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.mapInArrow(_recognised(shared, docs.columns.index(text_col), least), docs.schema)


def held_out(id_col: str, of: int, rest: int) -> F.Column:
    """Rows that no model learns from: by the CRC-32 of the id as text; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % of == rest, F.lit(False))


def language_id(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``predict`` with a model learnt from the rows that are not held out, and held_out (action)."""
    model = trained(docs.filter(~held_out(id_col, 4, 2)), id_col, text_col, lang_col)
    out = predict(docs, model, id_col, text_col)
    return out.select(id_col, held_out(id_col, 4, 2).alias("held_out"), "lang_pred", "score")
