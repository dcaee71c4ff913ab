"""Language-model scores from a log-frequency Bloom filter, and exact unigram scores beside them.

Texts are read once, into chunks of some million tokens: the hashes of a chunk's different tokens and the place of each
token among them. A chunk sends each of its different unigrams and bigrams, with its count in the training documents,
to the bucket of its hash. The bucket adds the counts up. A count c is kept as its level 1 + floor(log2 c); an n-gram of
level q is entered in the bucket's segment of the filter q times, with each level up to its own. A reader probes levels
upwards until one is missing, which gives the quantised count. The bucket answers each chunk with the levels that the
filter tells of the chunk's n-grams, in their order, and with the exact counts of its unigrams; the chunk puts them in
their places. So each n-gram of a chunk travels once, whatever the size of the filter, and no part of it is sent to all.

Probabilities interpolate the bigram's share of its first word with the smoothed unigram. The filter takes a fixed
number of bits for each entry, so it grows with the corpus, and nothing is left out.
"""

from __future__ import annotations

import os
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqframe.llm.batches import batches_of
from seqframe.llm.language_id import held_out
from seqframe.llm.words import Hasher, U, blocks, mixed, words
from seqframe.session import written

#: The hash of the token that ends each document; it also stands before the first word.
END = U(0x0E4D0E4D0E4D0E4D)
#: Bits of the filter for each entry, and bytes of token hashes that a task gathers for a chunk before it sends them on.
ENTRY_BITS, SENT_BYTES = 12, 8 << 20
#: Bits of a filter word that are set for an entry come from these places of its hash.
PROBES = (58, 52, 46, 40)
#: Weight of the bigram's share.
SHARE = 0.7
#: Bytes of text for each bucket, and buckets or chunks that a task is handed at a time: each holds megabytes.
BUCKET_BYTES, ROWS_AT_A_TIME = 4 << 20, 8


def _tokens(column, hasher: Hasher):
    """For each block: its first row, tokens with an end after each row, and where rows begin."""
    for block in blocks(column):
        w = words(block)
        hashes = hasher.ranges(block.data, w.starts, w.ends)
        rows = w.rows + np.arange(block.rows + 1)
        out = np.full(rows[-1], END, U)
        out[np.arange(len(hashes)) + w.row_of()] = hashes
        yield block.first, block.rows, out, rows


def bigrams(before: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    return mixed(before * U(0x9E3779B97F4A7C15) + tokens + U(1))


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return (mixed(hashes + U(99)) % U(buckets)).astype(np.int64)


def _chunks(batches):
    """(chunk, ids, learns, wanted, sizes, hashes, places): the rows of a chunk and its tokens."""
    hasher, held, size = Hasher(lower=True), [], 0

    def chunk() -> pa.RecordBatch:
        hashes, places = np.unique(np.concatenate([tokens for _, tokens, _ in held]), return_inverse=True)
        columns = [pa.concat_arrays([rows.column(c) for rows, _, _ in held]) for c in range(3)]
        sizes = pa.array(np.concatenate([n for _, _, n in held]).astype(np.int32))
        lists = [pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), c) for c in (*columns, sizes)]
        name = pa.array(np.frombuffer(os.urandom(8), np.int64))  # only to tell the written rows apart
        packed = zlib.compress(places.astype(np.uint32).tobytes(), 1)
        return pa.record_batch([name, *lists, pa.array([hashes.tobytes()], pa.binary()), pa.array([packed], pa.binary())], ["chunk", "ids", "learns", "wanted", "sizes", "hashes", "places"])

    for batch in batches:
        own = batch.select([0, 2, 3])
        for first, n, tokens, rows in _tokens(batch.column(1), hasher):
            held.append((own.slice(first, n), tokens, np.diff(rows)))
            size += tokens.nbytes
            if size > SENT_BYTES:
                yield chunk()
                held, size = [], 0
    if held:
        yield chunk()


def _grams(hashes: bytes, places: bytes, sizes: np.ndarray):
    """(hashes, places) of the different tokens and of the different bigrams of a chunk, and where its rows begin."""
    one, at = np.frombuffer(hashes, U), np.frombuffer(zlib.decompress(places), np.uint32).astype(np.int64)
    edges = np.append(0, np.cumsum(sizes))
    end = int(np.searchsorted(one, END))  # every row has its end
    before = np.append(end, at[:-1])
    before[edges[:-1]] = end
    pairs, place = np.unique(before * len(one) + at, return_inverse=True)
    return (one, at), (bigrams(one[pairs // len(one)], one[pairs % len(one)]), place), edges


def _asked(buckets: int):
    """(bucket, chunk, order, hashes, counts): a row for each bucket with n-grams of a chunk; held-out ones count 0."""

    def run(batches):
        for batch in batches:
            for name, learns, sizes, hashes, places in zip(*(batch.column(c) for c in ("chunk", "learns", "sizes", "hashes", "places")), strict=True):
                sizes = sizes.values.to_numpy()
                learnt = np.repeat(learns.values.to_numpy(zero_copy_only=False).astype(bool), sizes)
                for order, (grams, place) in enumerate(_grams(hashes.as_py(), places.as_py(), sizes)[:2], 1):
                    counts = np.bincount(place[learnt], minlength=len(grams)).astype(np.uint32)
                    bucket = bucket_of(grams, buckets)
                    at = np.argsort(bucket, kind="stable")
                    edges = np.searchsorted(bucket[at], np.arange(buckets + 1))
                    full = np.flatnonzero(np.diff(edges))
                    packed = [pa.array([part[edges[b] : edges[b + 1]].tobytes() for b in full], pa.binary()) for part in (grams[at], counts[at])]
                    yield pa.record_batch([pa.array(full.astype(np.int32)), pa.array([name.as_py()] * len(full), pa.int64()), pa.array([order] * len(full), pa.int32()), *packed], ["bucket", "chunk", "order", "hashes", "counts"])

    return run


def _answered(rows: pa.Table) -> pa.Table:
    """(bucket, chunk, order, levels, counts, total, different): what one bucket tells each chunk of its n-grams.

    Counts are those of unigrams; the sums over all the bucket's unigrams stand in one row.
    """
    bucket, orders = rows.column("bucket")[0].as_py(), rows.column("order").to_numpy()
    raw = [[np.frombuffer(b, kind) for b in rows.column(c).to_pylist()] for c, kind in (("hashes", U), ("counts", np.uint32))]
    grams = {}
    for order in (1, 2):
        own = np.flatnonzero(orders == order)
        every, n = (np.concatenate([np.zeros(0, kind), *(part[r] for r in own)]) for part, kind in zip(raw, (U, np.uint32), strict=True))
        hashes, place = np.unique(every, return_inverse=True)
        grams[order] = own, hashes, place, np.bincount(place, n, len(hashes)).astype(np.int64)
    learnt = [(hashes[n > 0], n[n > 0]) for _, hashes, _, n in grams.values()]
    size = int(sum(level_of(n).sum() for _, n in learnt)) * ENTRY_BITS // 64 + 1
    batch = pa.record_batch([pa.array([bucket] * 2, pa.int32()), *(pa.array([part[k].tobytes() for part in learnt], pa.binary()) for k in (0, 1))], ["bucket", "hashes", "counts"])
    segment = np.zeros(size, U)
    for part in _segments(size)([batch]):
        segment |= np.frombuffer(part.column("words")[0].as_py(), U)
    filter_ = LogFrequencyFilter(segment, 1)
    levels, counts = [b""] * len(orders), [b""] * len(orders)
    for order, (own, hashes, place, n) in grams.items():
        told, at = filter_.levels(hashes)[place], np.append(0, np.cumsum([len(raw[0][r]) for r in own])).astype(np.int64)
        for k, r in enumerate(own):
            levels[r] = told[at[k] : at[k + 1]].tobytes()
            counts[r] = n[place[at[k] : at[k + 1]]].tobytes() if order == 1 else b""
    once = np.arange(len(orders)) == 0
    sums = [pa.array(np.where(once, x, 0).astype(np.int64)) for x in (learnt[0][1].sum(), len(learnt[0][1]))]
    return pa.table([*(rows.column(c) for c in ("bucket", "chunk", "order")), pa.array(levels, pa.binary()), pa.array(counts, pa.binary()), *sums], ["bucket", "chunk", "order", "levels", "counts", "total", "different"])


def level_of(counts: np.ndarray) -> np.ndarray:
    return np.floor(np.log2(np.maximum(counts, 1))).astype(np.int64) + 1


def _need(h: np.ndarray) -> np.ndarray:
    need = np.zeros(len(h), U)
    for k in PROBES:
        need |= U(1) << ((h >> U(k)) & U(63))
    return need


def _segments(size: int):
    """The part of the filter that belongs to each bucket, ``size`` words long."""

    def run(batches):
        for batch in batches:
            for bucket, raw, counted in zip(*(batch.column(c).to_pylist() for c in ("bucket", "hashes", "counts")), strict=True):
                hashes, level = np.frombuffer(raw, U), level_of(np.frombuffer(counted, np.int64))
                segment = np.zeros(size, U)
                for k in range(1, int(level.max(initial=0)) + 1):
                    h = mixed(hashes[level >= k] + U(k * 1_000_003))
                    np.bitwise_or.at(segment, (h % U(size)).astype(np.int64), _need(h))
                yield pa.record_batch([pa.array([bucket], pa.int32()), pa.array([segment.tobytes()], pa.binary())], ["bucket", "words"])

    return run


class LogFrequencyFilter:
    """Quantised counts of n-grams by repeated probes; holds the segments of ``buckets`` from ``first`` on."""

    def __init__(self, words_: np.ndarray, buckets: int, first: int = 0, last: int | None = None):
        self.words, self.buckets, self.first = words_, buckets, first
        self.last = buckets if last is None else last
        self.size = len(words_) // max(self.last - first, 1)

    def levels(self, hashes: np.ndarray) -> np.ndarray:
        """0 for an n-gram that is not there, or of another segment."""
        out = np.zeros(len(hashes), np.uint8)
        bucket = bucket_of(hashes, self.buckets)
        left, k = np.flatnonzero((bucket >= self.first) & (bucket < self.last)), 1
        base = (bucket - self.first) * self.size
        while len(left):
            h = mixed(hashes[left] + U(k * 1_000_003))
            need = _need(h)
            left = left[(self.words[base[left] + (h % U(self.size)).astype(np.int64)] & need) == need]
            out[left], k = k, k + 1
        return out


def middle(level: np.ndarray) -> np.ndarray:
    """The middle of the counts that have a level; 0 where the first probe misses."""
    return np.where(level > 0, (3.0 * 2.0 ** (level.astype(np.float64) - 1) - 1) / 2, 0.0)


def _log_sums(one: np.ndarray, two: np.ndarray, end: int, rows: np.ndarray, scale: float) -> np.ndarray:
    """The score of each row from the levels of its tokens, of its bigrams and of the end."""
    smooth = middle(one)
    before = np.append(0.0, smooth[:-1])[: len(smooth)]
    before[rows[:-1]] = middle(np.array([end]))[0]
    share = np.minimum(np.where(before > 0, middle(two) / np.maximum(before, 1), 0.0), 1.0)
    return np.add.reduceat(np.log10(SHARE * share + (1 - SHARE) * (smooth + 0.5) / scale), rows[:-1])  # every row has its end


def _scored(buckets: int, scale: float):
    """(id, n_tokens, n_known, base, score) of a chunk's wanted rows, from what the buckets told of its n-grams."""

    def run(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        sizes, wanted = chunk.column("sizes").combine_chunks().values.to_numpy(), chunk.column("wanted").combine_chunks().values
        grams = _grams(chunk.column("hashes")[0].as_py(), chunk.column("places")[0].as_py(), sizes)
        edges = grams[2]
        answers = answers.sort_by("bucket")
        orders = answers.column("order").to_numpy()

        def of_tokens(order: int, column: str, kind) -> np.ndarray:
            """What was told of each token's n-gram: answers stand by bucket."""
            hashes, place = grams[order - 1]
            parts = answers.column(column).to_pylist()
            out = np.zeros(len(hashes), kind)
            out[np.argsort(bucket_of(hashes, buckets), kind="stable")] = np.frombuffer(b"".join(parts[r] for r in np.flatnonzero(orders == order)), kind)
            return out[place]

        told = of_tokens(1, "levels", np.uint8), of_tokens(2, "levels", np.uint8)
        end = int(told[0][edges[1] - 1])  # a row's last token is its end
        score = _log_sums(*told, end, edges, scale)
        exact = of_tokens(1, "counts", np.int64)
        sums = lambda v: np.add.reduceat(v, edges[:-1])  # noqa: E731  every row has its end
        columns = [sizes.astype(np.int64), sums((exact > 0).astype(np.int64)), sums(np.log10(exact + 0.5)), score]
        out = pa.table([chunk.column("ids").combine_chunks().values, *map(pa.array, columns)], ["id", "n_tokens", "n_known", "base", "score"])
        return out.filter(wanted)

    return run


def _scores(rows: DataFrame) -> DataFrame:
    """(id, n_tokens, n_known, train_tokens, base_score, score) of the wanted ``rows`` (id, text, learns, wanted) (action)."""
    spark = rows.sparkSession
    kind = rows.schema["id"].dataType.simpleString()
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()[0]
    buckets = int(max(64, size // BUCKET_BYTES))
    with batches_of(spark, 2000):
        schema = f"chunk long, ids array<{kind}>, learns array<boolean>, wanted array<boolean>, sizes array<int>, hashes binary, places binary"
        chunks = written(rows.select("id", "text", "learns", "wanted").mapInArrow(_chunks, schema), "zstd")
    with batches_of(spark, ROWS_AT_A_TIME):
        asked = chunks.select("chunk", "learns", "sizes", "hashes", "places").mapInArrow(_asked(buckets), "bucket int, chunk long, order int, hashes binary, counts binary")
        schema = "bucket int, chunk long, order int, levels binary, counts binary, total long, different long"
        answers = written(asked.groupBy("bucket").applyInArrow(_answered, schema), "zstd")
    total, vocabulary = answers.agg(F.coalesce(F.sum("total"), F.lit(0)), F.coalesce(F.sum("different"), F.lit(0))).first()
    scale = total + 0.5 * (vocabulary + 1)
    told = answers.select("chunk", "bucket", "order", "levels", "counts").groupBy("chunk")
    own = chunks.drop("learns").groupBy("chunk")
    out = own.cogroup(told).applyInArrow(_scored(buckets, scale), f"id {kind}, n_tokens long, n_known long, base double, score double")
    base = F.col("base") - F.col("n_tokens") * F.log10(F.lit(scale))
    return out.select("id", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), base.alias("base_score"), "score")


def score_documents(docs: DataFrame, train: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``id_col``, n_tokens, n_known, train_tokens, base_score, score (action).

    Tokens are runs of anything but ASCII white space, with A-Z lower-cased, then one end for each document.
    base_score is the exact unigram score with half a count added; score the model's log10 probability. Null and
    empty texts have their end alone. Without training documents all tokens are unknown and N and V are 0.
    """
    text = F.col(text_col).cast("string").alias("text")
    asked = docs.select(F.col(id_col).alias("id"), text, F.lit(False).alias("learns"), F.lit(True).alias("wanted"))
    learnt = train.select(F.lit(None).cast(docs.schema[id_col].dataType).alias("id"), text, F.lit(True).alias("learns"), F.lit(False).alias("wanted"))
    return _scores(asked.union(learnt)).withColumnRenamed("id", id_col)


def scored_corpus(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``score_documents`` of all rows with a model of those that are not held out, and held_out (action)."""
    text = F.col(text_col).cast("string").alias("text")
    rows = docs.select(F.col(id_col).alias("id"), text, (~held_out(id_col, 5, 1)).alias("learns"), F.lit(True).alias("wanted"))
    out = _scores(rows).withColumnRenamed("id", id_col)
    return out.select(id_col, held_out(id_col, 5, 1).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
