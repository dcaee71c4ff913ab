"""Hard-negative mining: inner-product search with coordinate pruning over length buckets.

Rows are dealt into buckets by length. A bucket holds, for every coordinate, its rows sorted by that coordinate
of their directions. A row reaches a score with an anchor only if the angle between them is small enough, and
then each coordinate of its direction lies in a range that follows from that angle and the anchor's own coordinate.
For the anchor's largest coordinates these ranges cut runs out of the sorted lists; the runs are intersected and
only rows in all of them are verified by their exact product. A bucket too short for a score is skipped.

Two searches run over the same buckets: the best rows of the anchor's label, then, between bounds that the
scores found set, the best rows of other labels. Anchors go in groups against chunks of buckets, so a task holds one group
and one chunk; thresholds rise from bucket to bucket; the best few of each task are merged by anchor.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from seqframe.llm.whitening import matrix
from seqframe.session import written

#: Scaled entries are held within this.
BOUND = float(1 << 40)
#: Rows of a bucket, buckets of a chunk, anchors of a group.
BUCKET, CHUNK, GROUP = 2048, 8, 4096
#: Coordinates of an anchor whose ranges are looked up, and the share of a bucket that a range must leave out to be used.
FOCUS, LEFT_OUT = 4, 0.1
#: Scores held in a task at a time.
CELLS = 4 << 20
NONE = np.iinfo(np.int64).min


def integral(table: DataFrame, id_col: str, label_col: str, vector_col: str, scale: float) -> DataFrame:
    """(id, label, x, length): usable rows with x the floored scaled entries (action: finds the dimension)."""
    finite = F.forall(vector_col, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = table.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.col(vector_col).isNotNull() & finite)
    longest = rows.agg(F.max(F.size(vector_col))).first()[0] or 0
    x = F.transform(F.col(vector_col), lambda c: F.floor(F.greatest(F.lit(-BOUND), F.least(F.lit(BOUND), c.cast("double") * scale))))
    x = F.when(F.size(vector_col) < longest, F.concat(x, F.array_repeat(F.lit(0).cast("long"), F.lit(longest) - F.size(vector_col)))).otherwise(x)
    label = F.col(label_col).cast("long") if isinstance(table.schema[label_col].dataType, IntegralType) else F.xxhash64(label_col)
    rows = rows.select(F.col(id_col).cast("long").alias("id"), label.alias("label"), x.alias("x"))
    return rows.withColumn("length", F.sqrt(F.aggregate("x", F.lit(0.0), lambda s, c: s + c.cast("double") * c.cast("double"))))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products of the rows of a and b, held within a long."""
    most = a.shape[1] * int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0))
    if most < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if most < 1 << 63:
        return a @ b.T
    return np.clip(a.astype(object) @ b.astype(object).T, -(2**63 - 1), 2**63 - 1).astype(np.int64)


def directions(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.linalg.norm(x.astype(np.float64), axis=1)
    return x / np.where(lengths > 0, lengths, 1.0)[:, None], lengths


def _buckets(size: int):
    """Rows sorted by falling length, packed: vectors in the least integer type, and the order of each coordinate."""

    def run(batches):
        part, number, held = TaskContext.get().partitionId() << 33, 0, None

        def bucket(t):
            nonlocal number
            x = matrix(t.column("x").combine_chunks()) if len(t.column("x").combine_chunks().flatten()) else np.zeros((t.num_rows, 0), np.int64)
            most = int(np.abs(x).max(initial=0))
            kind = "<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<i8"
            unit, lengths = directions(x)
            order = np.argsort(unit, axis=0, kind="stable").T.astype("<i4")
            cells = [[part + number], [float(lengths.max())], [x.shape[1]], [kind], [x.astype(kind).tobytes()], [order.tobytes()], *([t.column(c).to_numpy().astype("<i8").tobytes()] for c in ("id", "label"))]
            number += 1
            return pa.record_batch([pa.array(c) for c in cells], ["bucket", "longest", "d", "kind", "x", "orders", "ids", "labels"])

        for batch in batches:
            t = pa.Table.from_batches([batch])
            held = t if held is None else pa.concat_tables([held, t])
            while held.num_rows >= size:
                yield bucket(held.slice(0, size))
                held = held.slice(size)
        if held is not None and held.num_rows:
            yield bucket(held)

    return run


def length_buckets(rows: DataFrame, size: int = BUCKET) -> DataFrame:
    """One row per bucket of at most ``size`` rows of like length."""
    salted = rows.withColumn("salt", F.xxhash64("id", "x"))
    sorted_rows = salted.repartitionByRange(F.desc("length"), "salt").sortWithinPartitions(F.desc("length"), "salt").select("id", "label", "x")
    return sorted_rows.mapInArrow(_buckets(size), "bucket long, longest double, d long, kind string, x binary, orders binary, ids binary, labels binary")


class Bucket:
    """A bucket unpacked: sorted coordinate lists beside vectors, ids and labels."""

    def __init__(self, row: dict):
        d = row["d"]
        self.ids, self.labels = (np.frombuffer(row[c], "<i8") for c in ("ids", "labels"))
        self.x = np.frombuffer(row["x"], row["kind"]).reshape(len(self.ids), d).astype(np.int64)
        self.order = np.frombuffer(row["orders"], "<i4").reshape(d, len(self.ids))
        self.sorted = np.take_along_axis(directions(self.x)[0].T, self.order, axis=1)
        self.longest = row["longest"]


class Anchors:
    """A group of anchors with their focus coordinates."""

    def __init__(self, x: np.ndarray, labels: np.ndarray, ids: np.ndarray):
        self.x, self.labels, self.ids = x, labels, ids
        unit, self.lengths = directions(x)
        self.focus = np.argsort(-np.abs(unit), axis=1, kind="stable")[:, :FOCUS]
        self.angle = np.arccos(np.clip(np.take_along_axis(unit, self.focus, axis=1), -1, 1))

    def candidates(self, bucket: Bucket, least: np.ndarray) -> tuple[np.ndarray, list[tuple[int, np.ndarray]], int]:
        """Anchors that need the whole bucket, (anchor, rows) of those whose ranges leave rows out, and rows left out.

        ``least``: the score that a row must reach, per anchor; NONE where any will do.
        """
        n, reach = len(bucket.ids), self.lengths * bucket.longest
        share = np.where(reach > 0, least / np.where(reach > 0, reach, 1.0), np.where(least > 0, 2.0, 0.0))
        alive = share <= 1 + 1e-9
        bounded = alive & (share > 0)
        beta = np.arccos(np.clip(share, 0, 1))[:, None]
        low = np.cos(np.minimum(np.pi, self.angle + beta)) - 1e-9
        high = np.cos(np.maximum(0.0, self.angle - beta)) + 1e-9
        first, last = np.zeros(self.focus.shape, np.int64), np.full(self.focus.shape, n)
        for f in np.unique(self.focus[bounded]).tolist():
            at = np.nonzero((self.focus == f) & bounded[:, None])
            first[at] = np.searchsorted(bucket.sorted[f], low[at], "left")
            last[at] = np.searchsorted(bucket.sorted[f], high[at], "right")
        useful = last - first < (1 - LEFT_OUT) * n
        some, left_out = [], int((~alive).sum()) * n
        for a in np.flatnonzero(alive & useful.any(axis=1)).tolist():
            inside = None
            for k in np.flatnonzero(useful[a]).tolist():
                run = np.zeros(n, bool)
                run[bucket.order[self.focus[a, k], first[a, k] : last[a, k]]] = True
                inside = run if inside is None else inside & run
            rows = np.flatnonzero(inside)
            left_out += n - len(rows)
            some.append((a, rows))
        return np.flatnonzero(alive & ~useful.any(axis=1)), some, left_out


class Best:
    """The ``k`` best (score, id) of every slot: higher scores, then smaller ids."""

    def __init__(self, slots: int, k: int, floor: np.ndarray):
        self.k, self.floor = k, floor.copy()
        self.slot, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))

    def add(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(slot):
            return
        slot, score, ids = (np.concatenate([a, b]) for a, b in ((self.slot, slot), (self.score, score), (self.id, ids)))
        order = np.lexsort((ids, -score, slot))
        slot, score, ids = slot[order], score[order], ids[order]
        rank = np.arange(len(slot)) - np.searchsorted(slot, slot)
        kept = rank < self.k
        full = rank == self.k - 1
        self.floor[slot[full]] = np.maximum(self.floor[slot[full]], score[full])
        self.slot, self.score, self.id = slot[kept], score[kept], ids[kept]


def _hits(anchors: Anchors, bucket: Bucket, least: np.ndarray, same: bool):
    """(anchor, row, score) arrays of rows that may count: right label, another id, score of at least ``least``."""
    whole, some, _ = anchors.candidates(bucket, least)
    step = max(1, CELLS // max(1, len(bucket.ids)))
    labels = np.unique(anchors.labels[whole]).tolist() if same else [None]
    for label in labels:
        mine = whole if label is None else whole[anchors.labels[whole] == label]
        rows = np.arange(len(bucket.ids)) if label is None else np.flatnonzero(bucket.labels == label)
        for at in range(0, len(mine) if len(rows) else 0, step):
            a = mine[at : at + step]
            scores = products(anchors.x[a], bucket.x[rows])
            i, j = np.nonzero(scores >= least[a][:, None])
            yield a[i], rows[j], scores[i, j]
    for a, rows in some:
        rows = rows[(bucket.labels[rows] == anchors.labels[a]) == same]
        if len(rows):
            scores = products(anchors.x[a : a + 1], bucket.x[rows])[0]
            ok = scores >= least[a]
            yield np.full(int(ok.sum()), a), rows[ok], scores[ok]


def _group(table: pa.Table) -> Anchors:
    return Anchors(matrix(table.column("x").combine_chunks()) if len(table.column("x").combine_chunks().flatten()) else np.zeros((table.num_rows, 0), np.int64), *(table.column(c).to_numpy() for c in ("label", "id")))


def _unpacked(table: pa.Table):
    for k in np.argsort(-table.column("longest").to_numpy(), kind="stable").tolist():
        yield Bucket(table.slice(k, 1).to_pylist()[0])


def _positives(k: int):
    def run(_, buckets: pa.Table, anchors: pa.Table) -> pa.Table:
        group = _group(anchors)
        best = Best(len(group.ids), k, np.full(len(group.ids), NONE))
        for bucket in _unpacked(buckets):
            for a, rows, scores in _hits(group, bucket, best.floor, True):
                other = bucket.ids[rows] != group.ids[a]
                best.add(a[other], scores[other], bucket.ids[rows[other]])
        return pa.table({"name": anchors.column("name").take(pa.array(best.slot)), "anchor_id": pa.array(group.ids[best.slot]), "other_id": pa.array(best.id), "score": pa.array(best.score)})

    return run


def _negatives(k: int, low: tuple[int, int], high: tuple[int, int]):
    def run(_, buckets: pa.Table, anchors: pa.Table) -> pa.Table:
        group, scores = _group(anchors), anchors.column("scores").to_pylist()
        width = max(map(len, scores))
        # Slot a * width + j: the anchor's j-th positive. Without one, a range that nothing meets.
        ceiling = np.full(len(scores) * width, NONE)
        floor = np.full(len(scores) * width, np.iinfo(np.int64).max)
        for a, each in enumerate(scores):
            for j, s in enumerate(each):
                floor[a * width + j], ceiling[a * width + j] = -((-s * low[0]) // low[1]), s * high[0] // high[1]
        floor[floor > ceiling] = np.iinfo(np.int64).max
        best = Best(len(floor), k, floor)
        for bucket in _unpacked(buckets):
            for a, rows, got in _hits(group, bucket, best.floor.reshape(-1, width).min(axis=1), False):
                other = bucket.labels[rows] != group.labels[a]
                a, rows, got = a[other], rows[other], got[other]
                slots = (a[:, None] * width + np.arange(width)).ravel()
                got, rows = np.repeat(got, width), np.repeat(rows, width)
                ok = (got >= best.floor[slots]) & (got <= ceiling[slots])
                best.add(slots[ok], got[ok], bucket.ids[rows[ok]])
        return pa.table({"name": anchors.column("name").take(pa.array(best.slot // width)), "place": pa.array((best.slot % width + 1).astype(np.int32)), "other_id": pa.array(best.id), "score": pa.array(best.score)})

    return run


def _search(buckets: DataFrame, anchors: DataFrame, chunks: int, run: Callable, schema: str) -> DataFrame:
    """Every group of anchors against every chunk of buckets; groups are as many as the anchors fill."""
    groups = max(1, math.ceil(anchors.count() / GROUP))
    left = buckets.withColumns({"chunk": F.pmod(F.xxhash64("bucket"), F.lit(chunks)).cast("int"), "part": F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))})
    right = anchors.withColumns({"part": F.pmod("name", F.lit(groups)).cast("int"), "chunk": F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))})

    def both(key, a, b):
        return run(key, a, b) if a.num_rows and b.num_rows else run_empty

    run_empty = pa.table({f.split()[0]: pa.array([], {"long": pa.int64(), "int": pa.int32()}[f.split()[1]]) for f in schema.split(", ")})
    return left.groupBy("part", "chunk").cogroup(right.groupBy("part", "chunk")).applyInArrow(both, schema)


def hard_negatives(
    table: DataFrame,
    anchor: Column,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "embedding",
    positives: int = 5,
    negatives: int = 3,
    scale: float = 256,
    low: tuple[int, int] = (50, 100),
    high: tuple[int, int] = (95, 100),
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score (action: buckets and positives are written).

    Anchors are the rows that meet ``anchor``, a condition on ``id_col``. For each anchor and each of its first ``positives``
    rows of its own label, the first ``negatives`` rows of other labels whose score lies between ``low`` and ``high``
    (fractions) of the positive's. Scores are inner products of the floored scaled entries; higher ones come first,
    ties by smaller id. Rows with a null id, a null label, or a null vector, entry or non-finite entry take no part.
    Missing entries of shorter vectors count as 0; scaled entries are held within 2**40 of 0 and scores within a long.

    A repeated row is a row of its own as positive and negative, and one anchor. A row with the anchor's id is never its
    positive. Rows that share an id but differ are anchors of their own with the same anchor_id. Anchors without
    a positive, positives without a negative and empty tables give no row.
    """
    rows = integral(table, id_col, label_col, vector_col, scale)
    buckets = written(length_buckets(rows))
    chunks = max(1, math.ceil(buckets.count() / CHUNK))
    chosen = integral(table.filter(anchor), id_col, label_col, vector_col, scale)
    width = buckets.agg(F.max("d")).first()[0] or 0
    chosen = chosen.withColumn("x", F.concat("x", F.array_repeat(F.lit(0).cast("long"), F.lit(int(width)) - F.size("x"))))
    chosen = written(chosen.select("id", "label", "x").distinct().withColumn("name", F.xxhash64("id", "label", "x")))

    def first(found: DataFrame, keys: list[str], k: int) -> DataFrame:
        order = Window.partitionBy(*keys).orderBy(F.desc("score"), "other_id")
        return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)

    near = _search(buckets, chosen, chunks, _positives(positives), "name long, anchor_id long, other_id long, score long")
    near = written(first(near, ["name"], positives))
    scores = near.groupBy("name").agg(F.transform(F.sort_array(F.collect_list(F.struct("rank", "score"))), lambda s: s["score"]).alias("scores"))
    far = _search(buckets, chosen.join(scores, "name"), chunks, _negatives(negatives, low, high), "name long, place int, other_id long, score long")
    far = first(far, ["name", "place"], negatives)
    far = far.select("name", "place", F.col("other_id").alias("negative_id"), F.col("score").alias("negative_score"), F.col("rank").cast("int").alias("rank"))
    near = near.select("name", "anchor_id", F.col("rank").alias("place"), F.col("other_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return near.join(far, ["name", "place"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
