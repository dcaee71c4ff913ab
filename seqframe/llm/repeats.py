"""Long repeated strings, found by sorting suffixes shard by shard in external memory.

As in external induced sorting, the text is first reduced to content-defined phrases, the reduced text is
sorted, and the order of all other suffixes is induced from it. Only the first ``length`` bytes of a suffix
count, which allows shards that need nothing of each other:

* Every window of ``length`` bytes has an anchor, its least hashed gram, at a place that only its content
  decides. Windows with anchors that occur once cannot repeat and are left out.
* The windows of one anchor at like distances share a core. Core and distance name a shard; a suffix tuple
  has its core, the bytes before it and the bytes after it that some of its windows reach.
* Tuples are sorted by core and following bytes. That is Spark's external sort, whose runs lie on disk
  and are merged by a priority queue, so a shard may be far larger than memory.
* In this order each tuple carries its common prefix with the one before. Stepping a window back by one
  byte, its order is induced from the last by the pair of byte and former class, and the common prefixes
  tell how far the following bytes agree. Windows equal in both repeat.
* A shard is induced in the memory of one task, so a core in more than ``HOT`` places, with whatever around it, is not
  one: its tuples are taken apart into their windows, which are counted by content over all tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqframe.llm.batches import batches_of
from seqframe.llm.names import under_plain_names
from seqframe.llm.shared_passages import WORDS, shared_bytes, shared_spans
from seqframe.llm.sieve import passes, sieve
from seqframe.llm.words import Hasher, U, blocks, mixed, signed
from seqframe.session import broadcast_if_small, leaving_result, written

LENGTH = 400
#: Bytes of a gram, and windows of one anchor that share a core.
GRAM, STEP = 32, 64
#: Bytes of a long text that are read at a time.
PIECE = 1 << 21
#: Places of a core up to which one task induces its shard, in some 50 MB.
HOT = 1 << 16


def _pieces(column, length: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, offset in it, bytes, row edges); a long row comes in pieces that overlap by a window less a byte."""
    for block in blocks(column):
        if block.rows == 1 and len(block.data) > PIECE:
            for at in range(0, len(block.data) - length + 1, PIECE):
                part = block.data[at : at + PIECE + length - 1]
                yield block.first, at, part, np.array([0, len(part)])
        else:
            yield block.first, 0, block.data, block.edges


def _anchored(data: np.ndarray, edges: np.ndarray, hasher: Hasher, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all windows that lie in one row, and the place of each one's anchor."""
    if len(data) < length:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.arange(len(data) - GRAM + 1)
    keys = (mixed(hasher.ranges(data, at, at + GRAM)) & ~U(0xFFFFFF)) | at.astype(U)
    width = length - GRAM + 1
    padded = np.full(-(-len(keys) // width) * width, ~U(0), U)
    padded[: len(keys)] = keys
    table = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(table, axis=1).reshape(-1)
    behind = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    starts = np.arange(len(data) - length + 1)
    least = np.minimum(behind[starts], ahead[starts + width - 1])
    inside = starts + length <= np.repeat(edges[1:], np.diff(edges))[: len(starts)]
    return starts[inside], (least[inside] & U(0xFFFFFF)).astype(np.int64)


def _anchors(length: int):
    def run(batches):
        hasher = Hasher(lower=False)
        for batch in batches:
            for _, _, data, edges in _pieces(batch.column(0), length):
                _, at = _anchored(data, edges, hasher, length)
                own = at[np.append(True, at[1:] != at[:-1])] if len(at) else at
                yield pa.record_batch({"anchor": signed(hasher.ranges(data, own, own + GRAM))})

    return run


def _tuples(length: int, repeated):
    """(row, begin, core, same, low, high, left, right): windows low to high of a shard, from byte ``begin`` on.

    low and high count the windows of a full core from its last start backwards; same is a hash of all bytes
    that the windows cover.
    """

    def run(batches):
        hasher, wanted = Hasher(lower=False), repeated.value
        for batch in batches:
            for first, base, data, edges in _pieces(batch.column(1), length):
                starts, at = _anchored(data, edges, hasher, length)
                if not len(starts):
                    continue
                change = np.append(True, at[1:] != at[:-1])
                own = at[change]
                keep = passes(wanted, signed(hasher.ranges(data, own, own + GRAM)))[np.cumsum(change) - 1]
                starts, at = starts[keep], at[keep]
                if not len(starts):
                    continue
                shard = (at - starts) // STEP
                new = np.append(True, (at[1:] != at[:-1]) | (shard[1:] != shard[:-1]) | (np.diff(starts) != 1))
                low_s = starts[new]  # the first start of each run
                high_s = starts[np.append(np.flatnonzero(new)[1:] - 1, len(starts) - 1)]
                at, shard = at[new], shard[new]
                core_at, core_to = at - shard * STEP, at - shard * STEP - (STEP - 1) + length
                core = hasher.ranges(data, core_at, core_to) + mixed(shard.astype(U) + U(1))
                low, high = core_at - high_s, core_at - low_s
                same = hasher.ranges(data, low_s, high_s + length) + mixed((low * STEP + high).astype(U))
                row = np.searchsorted(edges, low_s, "right") - 1
                raw = data.tobytes()
                left = [raw[a:b] for a, b in zip(low_s.tolist(), core_at.tolist(), strict=True)]
                right = [raw[a:b] for a, b in zip(core_to.tolist(), (high_s + length).tolist(), strict=True)]
                yield pa.record_batch(
                    [batch.column(0).take(pa.array(first + row)), pa.array(low_s - edges[row] + base), pa.array(signed(core)), pa.array(signed(same)), pa.array(low.astype(np.int16)), pa.array(high.astype(np.int16)), pa.array(left, pa.binary()), pa.array(right, pa.binary())],
                    ["row", "begin", "core", "same", "low", "high", "left", "right"],
                )

    return run


def _matrix(items: list[bytes], width: int, backwards: bool) -> np.ndarray:
    """One row of numbers for each byte string, -1 beyond its end; backwards from the last byte."""
    out = np.full((len(items), width), -1, np.int16)
    for r, item in enumerate(items):
        if item:
            values = np.frombuffer(item, np.uint8)
            out[r, : len(values)] = values[::-1] if backwards else values
    return out


def _counted(keys: np.ndarray) -> np.ndarray:
    """Which keys occur twice or more."""
    order = np.argsort(keys, kind="stable")
    equal = keys[order][1:] == keys[order][:-1]
    out = np.zeros(len(keys), bool)
    out[order[1:][equal]] = out[order[:-1][equal]] = True
    return out


def induced(core: np.ndarray, low: np.ndarray, high: np.ndarray, left: list[bytes], right: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """For each tuple the nearest and farthest of its windows that another tuple of its shard has; -1 without any.

    Tuples come sorted by core and following bytes. A window is numbered by how many bytes lie before the core.
    """
    before, after = _matrix(left, STEP - 1, True), _matrix(right, STEP - 1, False)
    differ = after[1:] != after[:-1]
    common = np.where(differ.any(1), differ.argmax(1), STEP - 1)
    common = np.append(-1, np.where(core[1:] == core[:-1], common, -1))  # common prefix with the tuple before
    near, far = np.full(len(core), -1), np.full(len(core), -1)
    cls = np.cumsum(np.append(True, core[1:] != core[:-1]))
    for k in range(STEP):
        if k:
            _, cls = np.unique(cls * 512 + before[:, k - 1] + 1, return_inverse=True)
        follows = np.cumsum(common < STEP - 1 - k)  # equal where the following bytes agree far enough
        own = (low <= k) & (k <= high)
        at = np.flatnonzero(own)
        again = at[_counted(cls[at].astype(np.int64) * (len(core) + 1) + follows[at])]
        near[again[near[again] < 0]] = k
        far[again] = k
    return near, far


def _repeats(batches):
    """Tuples sorted by core to (core, same, near, far), the windows of each that repeat."""

    def solved(rows: pa.Table) -> pa.RecordBatch:
        core, low, high, copies = (rows.column(n).to_numpy() for n in ("core", "low", "high", "copies"))
        several = _counted(core)
        near, far = np.where(copies > 1, low, -1).astype(np.int64), np.where(copies > 1, high, -1).astype(np.int64)
        if several.any():
            some = rows.filter(pa.array(several))
            n, f = induced(core[several], low[several], high[several], some.column("left").to_pylist(), some.column("right").to_pylist())
            alone = copies[several] <= 1
            near[np.flatnonzero(several)[alone]], far[np.flatnonzero(several)[alone]] = n[alone], f[alone]
        out = pa.table({"core": rows.column("core"), "same": rows.column("same"), "near": near, "far": far}).filter(pa.array(near >= 0))
        return out.combine_chunks()

    held: list[pa.Table] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        core = batch.column("core").to_numpy()
        cut = int(np.flatnonzero(core != core[-1])[-1]) + 1 if (core != core[-1]).any() else 0
        if cut or (held and held[-1].column("core")[-1].as_py() != core[0]):
            yield from solved(pa.concat_tables([*held, pa.Table.from_batches([batch.slice(0, cut)])])).to_batches()
            held = []
        held.append(pa.Table.from_batches([batch.slice(cut)]))
    if held:
        yield from solved(pa.concat_tables(held)).to_batches()


def _different(tuples: DataFrame) -> DataFrame:
    """Equal tuples of a core as one, with their number."""
    return tuples.groupBy("core", "same").agg(F.count("*").alias("copies"), *(F.any_value(c).alias(c) for c in ("low", "high", "left", "right")))


def _compared(tuples: DataFrame, several: DataFrame) -> DataFrame:
    """Equal tuples of the cores in ``several`` as one; all of a core lie in one partition."""
    placed = tuples.select("core", "same", "low", "high", "left", "right").repartition("core")
    return _different(placed.join(several.select("core"), "core", "left_semi"))


def _counted_windows(tuples: DataFrame) -> DataFrame:
    """(core, same, near, far) of tuples whose cores have too many places for one task: windows are counted by their bytes."""
    each = _different(tuples).withColumn("k", F.explode(F.sequence(F.col("low").cast("int"), F.col("high").cast("int"))))
    before = F.substr("left", F.col("high") - F.col("k") + 1, F.col("k"))
    after = F.substr("right", F.lit(1), F.lit(STEP - 1) - F.col("k"))
    each = written(each.select("core", "same", "copies", "k", F.xxhash64("core", "k", before, after).alias("window")), "zstd")
    again = each.groupBy("window").agg(F.sum("copies").alias("n")).filter("n > 1")
    return each.join(again, "window", "left_semi").groupBy("core", "same").agg(F.min("k").cast("long").alias("near"), F.max("k").cast("long").alias("far"))


def repeated_spans(docs: DataFrame, text_col: str = "text", length: int = LENGTH, hot: int = HOT) -> DataFrame:
    """(row, spans): for each text with bytes that repeat, the runs of bytes to remove (action).

    ``docs`` has a long ``row`` that names a row by its content. spans is an array of different (begin, end) in UTF-8
    bytes, which may overlap. Cores in more than ``hot`` places are no shards of one task; results are the same.
    """
    spark = docs.sparkSession
    docs = docs.select("row", F.col(text_col).cast("string").alias("text")).filter(F.octet_length("text") >= length)
    with batches_of(spark, 2000):
        anchors = written(docs.select("text").mapInArrow(_anchors(length), "anchor long").groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1").select("anchor"))
        wanted = spark.sparkContext.broadcast(sieve(anchors, "anchor"))
        schema = "row long, begin long, core long, same long, low short, high short, left binary, right binary"
        tuples = written(docs.mapInArrow(_tuples(length, wanted), schema), "zstd")
    several = written(tuples.groupBy("core").agg(F.count("*").alias("n")).filter("n > 1"))
    frequent = several.filter(F.col("n") > hot).select("core")
    usual = tuples
    if not frequent.isEmpty():
        frequent = broadcast_if_small(frequent)
        usual = tuples.join(frequent, "core", "left_anti")
    # A tuple's bytes are shuffled once, by core, and only those of cores that occur again; all that follows finds them in their place.
    parts = _compared(usual, several.filter(F.col("n") <= hot))
    ordered = parts.sortWithinPartitions("core", "right").select("core", "same", "copies", "low", "high", "left", "right")
    found = written(ordered.mapInArrow(_repeats, "core long, same long, near long, far long"))
    if usual is not tuples:
        found = found.unionByName(written(_counted_windows(tuples.join(frequent, "core", "left_semi"))))
    # Window k of a tuple starts high - k bytes after its begin.
    spans = tuples.select("row", "begin", "core", "same", "high").join(found, ["core", "same"])
    span = F.struct((F.col("begin") + F.col("high") - F.col("far")).alias("begin"), (F.col("begin") + F.col("high") - F.col("near") + length).alias("end"))
    return written(spans.groupBy("row").agg(F.collect_set(span).alias("spans")))


def _row(id_col: str, text_col: str):
    return F.xxhash64(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.col(text_col).cast("string"))


def _without(raw: bytes, spans: list[dict]) -> bytes:
    at, kept = 0, []
    for s in spans:
        kept.append(raw[at : s["begin"]])
        at = s["end"]
    return b"".join([*kept, raw[at:]])


def _merged(spans: list[dict]) -> list[dict]:
    out: list[dict] = []
    for s in sorted(spans, key=lambda s: s["begin"]):
        if out and s["begin"] <= out[-1]["end"]:
            out[-1]["end"] = max(out[-1]["end"], s["end"])
        else:
            out.append(dict(s))
    return out


def _digests(words: int):
    def run(batches):
        for batch in batches:
            texts = [t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()]
            removed, runs, hashes, spans_of = [], [], [], []
            for raw, spans in zip(texts, batch.column(2).to_pylist(), strict=True):
                spans = _merged(spans or [])
                removed.append(sum(s["end"] - s["begin"] for s in spans))
                runs.append(len(spans))
                hashes.append(hashlib.sha256(_without(raw, spans)).hexdigest())
                spans_of.append(len(raw.strip()) if len(raw.split()) >= words else 0)  # from the first word to the last
            arrays = [pa.array(c, pa.int64()) for c in (list(map(len, texts)), removed, runs)]
            yield pa.record_batch([batch.column(0), *arrays, pa.array(hashes), batch.column(3), pa.array(spans_of, pa.int64())], ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "name", "span"])

    return run


def repeat_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, words: int = WORDS) -> DataFrame:
    """One row per input row: ``id_col``, n_bytes, n_removed, n_spans, kept_sha256, n_shared (action).

    A byte is removed if a string of ``length`` bytes covers it that starts elsewhere as well, in any text. n_shared
    counts the bytes in runs of ``words`` words or more that stand in another document, whatever their length in bytes.
    Null texts are empty; shorter texts stay whole. Equal rows repeat each other, but are one document to n_shared.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), _row(id_col, text_col).alias("row"))
    shared = shared_bytes(rows.select("row", "text"), words)
    spans = repeated_spans(rows, length=length)
    joined = rows.join(spans, "row", "left").select("id", "text", "spans")
    out = joined.withColumn("name", F.xxhash64("text")).mapInArrow(_digests(words), f"id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, name long, span long")
    out = out.join(shared, "name", "left")
    n_shared = F.when(F.col("copied"), F.col("span")).otherwise(F.coalesce("shared", F.lit(0)))
    return out.select(F.col("id").alias(id_col), "n_bytes", "n_removed", "n_spans", "kept_sha256", n_shared.alias("n_shared"))


def _cut(at: int):
    """Texts without their spans; of a character that a span cuts no part stays."""

    def run(batches):
        for batch in batches:
            texts, spans = batch.column(at).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()
            texts = [_without(t.encode(), _merged(s)).decode("utf-8", "ignore") if s else t for t, s in zip(texts, spans, strict=True)]
            columns = batch.columns[:-1]
            columns[at] = pa.array(texts, pa.string())
            yield pa.record_batch(columns, batch.schema.names[:-1])

    return run


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, words: int | None = None) -> DataFrame:
    """``docs`` with repeated strings cut from the text (action). All other columns and rows stay.

    With ``words`` runs of so many words that other texts have are cut as well, however few bytes they are.

    Of a character that lies on the edge of a run only whole characters are kept. A text that is all
    repeated becomes empty; null stays null.
    """
    return under_plain_names(docs, lambda d, i, t: _without_repeats(d, i, t, length, words), id_col, text_col)


def _without_repeats(docs: DataFrame, id_col: str, text_col: str, length: int, words: int | None) -> DataFrame:
    rows = docs.withColumn("_row", _row(id_col, text_col))
    named = rows.select(F.col("_row").alias("row"), F.col(text_col).cast("string").alias("text"))

    def both() -> DataFrame:
        more = shared_spans(named, words).groupBy("row").agg(F.collect_list(F.struct("begin", "end")).alias("spans"))
        return written(spans.union(more).groupBy("row").agg(F.flatten(F.collect_list("spans")).alias("spans")))

    # Tuples and windows outweigh the texts: they go before the texts meet their spans.
    spans = leaving_result(docs.sparkSession, lambda: repeated_spans(named, length=length))
    if words:
        spans = leaving_result(docs.sparkSession, both)
    spans = spans.select(F.col("row").alias("_row"), F.col("spans").alias("_spans"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return rows.join(spans, "_row", "left").select(*docs.columns, "_spans").mapInArrow(_cut(docs.columns.index(text_col)), kinds)
