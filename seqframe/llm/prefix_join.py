"""N-gram Jaccard join: a grouped prefix join that ends in classes of linked documents.

Two documents link when the share of their common n-word shingles is at least num/den. In one order
of all shingles, a pair that links has a common shingle among the first few of each (the prefix), at
places that leave enough shingles behind them. The order puts shingles that are common in the corpus
last. Prefix entries that no other document has are dropped; documents that then have one size and
one prefix are a group. Pairs of groups are found over common prefix entries and filtered by size and
place, then expanded to their members and verified on the whole sets. As the result is classes, each
member is first verified against one central document, and only pairs that this leaves in different
classes are expanded: every pair that may link is verified or already in one class.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqframe.llm.batches import batches_of
from seqframe.llm.components import connected_components
from seqframe.llm.names import under_plain_names
from seqframe.llm.sieve import passes, sieve
from seqframe.llm.words import Hasher, U, binaries, blocks, list_array, mixed, shingles, signed, unsigned, words
from seqframe.session import written

#: A shingle is counted as common when some part of the scan has it in this share of its documents, three at least.
COMMON, COMMON_LEAST = 1 / 2000, 3
#: Nodes that a task remembers, to leave out copies early.
SEEN = 1_000_000
#: Shingles of such a part, and how many are held before they are folded into counts: a few MB.
PART, FOLD = 5_000_000, 250_000
#: So many of the commonest are sent to the workers, 1 MB of hashes. The rest keep the plain order; no result depends on it.
COMMON_KEPT = 1 << 17


def _sets(column, n: int, hasher: Hasher) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of each row."""
    for block in blocks(column):
        w = words(block)
        hashes, rows = shingles(hasher.ranges(block.data, w.starts, w.ends), w.rows, n)
        for r in range(block.rows):
            part = np.sort(hashes[rows[r] : rows[r + 1]])
            yield block.first + r, part[np.append(True, part[1:] != part[:-1])] if len(part) > 1 else part


def _common(n: int):
    """Partial document counts of the shingles that are common in a part of the scan."""

    def run(batches):
        hasher = Hasher(lower=True)
        token, docs = np.zeros(0, U), np.zeros(0, np.int32)  # counts of the part so far
        held, size, sets, seen = [], 0, 0, 0

        def fold():
            nonlocal token, docs, held, size
            fresh = np.concatenate(held) if held else np.zeros(0, U)
            held, size = [], 0
            fresh.sort()
            first = np.flatnonzero(np.append(True, fresh[1:] != fresh[:-1])) if len(fresh) else np.zeros(0, np.int64)
            counts, fresh = np.diff(np.append(first, len(fresh))).astype(np.int32), fresh[first]
            at = np.searchsorted(token, fresh)
            old = token[np.minimum(at, len(token) - 1)] == fresh if len(token) else np.zeros(len(fresh), bool)
            docs[at[old]] += counts[old]
            token, docs = np.insert(token, at[~old], fresh[~old]), np.insert(docs, at[~old], counts[~old])

        def found():
            keep = docs >= max(COMMON_LEAST, COMMON * sets)
            return pa.record_batch({"token": signed(token[keep]), "docs": docs[keep].astype(np.int64)})

        for batch in batches:
            for _, one in _sets(batch.column(0), n, hasher):
                held.append(one)
                size, sets, seen = size + len(one), sets + 1, seen + len(one)
                if size > FOLD:
                    fold()
                if seen > PART:
                    fold()
                    yield found()
                    token, docs, sets, seen = token[:0], docs[:0], 0, 0
        if sets:
            fold()
            yield found()

    return run


def _node(one: np.ndarray) -> np.int64:
    """A hash of a whole set, -1 for an empty one."""
    return np.bitwise_xor.reduce(mixed(one + U(len(one)))).astype(np.int64) if len(one) else np.int64(-1)


def _prefixes(n: int, num: int, den: int, common):
    """(id, size, node, prefix). Of the copies that a task meets only the first has a prefix."""

    def run(batches):
        hasher, seen = Hasher(lower=True), set()
        by_hash, rank = common.value
        for batch in batches:
            nodes, sizes, parts = [], [], []
            if len(seen) > SEEN:
                seen = set()
            for _, one in _sets(batch.column(1), n, hasher):
                sizes.append(len(one))
                nodes.append(_node(one))
                if nodes[-1] in seen:
                    parts.append(one[:0])
                    continue
                seen.add(nodes[-1])
                late = np.zeros(len(one), np.int64)
                if len(by_hash) and len(one):
                    at = np.minimum(np.searchsorted(by_hash, one), len(by_hash) - 1)
                    late = np.where(by_hash[at] == one, rank[at] + 1, 0)
                parts.append(one[np.argsort(late, kind="stable")][: len(one) - -(-num * len(one) // den) + 1] if len(one) else one)
            ends = np.cumsum([0, *map(len, parts)])
            yield pa.record_batch([batch.column(0), pa.array(sizes, pa.int32()), pa.array(np.array(nodes, np.int64)), list_array(signed(np.concatenate([np.zeros(0, U), *parts])), ends)], ["id", "size", "node", "prefix"])

    return run


def _packed(one: np.ndarray) -> bytes:
    """The upper 40 bits of sorted hashes: two sets of a thousand agree by chance about once in a million pairs."""
    return (one >> U(32)).astype(np.uint32).tobytes() + ((one >> U(24)) & U(255)).astype(np.uint8).tobytes()


def _profile(one: np.ndarray) -> bytes:
    """How many hashes of a set begin with each bit pattern; about one byte for a hash, or nothing if a count is too large."""
    bits = max(6, int(len(one)).bit_length())
    counts = np.bincount((one >> U(64 - bits)).astype(np.int64), minlength=1 << bits)
    return counts.astype(np.uint8).tobytes() if counts.max() < 256 else b""


def _wanted_only(n: int, wanted, name: str, make):
    """(node, ``name``) of the documents whose node may be wanted: ``make`` of their sets."""

    def run(batches):
        hasher, filter_, seen = Hasher(lower=True), wanted.value, set()
        for batch in batches:
            if len(seen) > SEEN:
                seen = set()
            nodes, made = [], []
            for _, one in _sets(batch.column(0), n, hasher):
                node = _node(one)
                if len(one) and node not in seen and passes(filter_, np.array([node]))[0]:
                    seen.add(node)
                    nodes.append(node)
                    made.append(make(one))
            yield pa.record_batch([pa.array(np.array(nodes, np.int64)), binaries(made)], ["node", name])

    return run


def _possible(num: int, den: int):
    """Pairs whose profiles allow enough common shingles; no pair that links is lost."""

    def bound(p: bytes, q: bytes) -> int | None:
        if not p or not q:
            return None
        x, y = np.frombuffer(p, np.uint8), np.frombuffer(q, np.uint8)
        while len(x) != len(y):
            if len(x) > len(y):
                x = x.reshape(-1, 2).sum(1)
            else:
                y = y.reshape(-1, 2).sum(1)
        sizes, both = int(x.sum()) + int(y.sum()), int(np.minimum(x, y).sum())
        return den * both - num * (sizes - both)

    def run(batches):
        for batch in batches:
            keep = [(v := bound(p.as_py(), q.as_py())) is None or v >= 0 for p, q in zip(batch.column(2), batch.column(3), strict=True)]
            yield pa.record_batch([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _verified(num: int, den: int):
    def unpacked(raw: bytes) -> np.ndarray:
        k = len(raw) // 5
        return (np.frombuffer(raw, np.uint32, k).astype(np.int64) << 8) | np.frombuffer(raw, np.uint8, k, 4 * k)

    def run(batches):
        for batch in batches:
            keep, last, y = [], None, None
            for b, p, q in zip(batch.column(1).to_pylist(), batch.column(2), batch.column(3), strict=True):
                if b != last:  # rows come sorted by the second document
                    last, y = b, unpacked(q.as_py())
                x = unpacked(p.as_py())
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(den * both >= num * (len(x) + len(y) - both))
            yield pa.record_batch([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _may_link(num: int, den: int, x: str, y: str) -> Column:
    """Sizes are near enough, and the places of a common entry leave enough shingles behind them."""
    sx, sy, px, py = F.col(f"size_{x}"), F.col(f"size_{y}"), F.col(f"place_{x}"), F.col(f"place_{y}")
    needed = F.lit(num) * (sx + sy)
    left = F.least(sx - px, sy - py) * F.lit(num + den)
    return (F.least(sx, sy) * F.lit(den) >= F.greatest(sx, sy) * F.lit(num)) & (left >= needed)


def near_duplicate_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """One row per input row: ``id_col``, n_shingles, component_id (action).

    component_id is the smallest id that is reachable by links. Words are runs of anything but ASCII
    white space, with A-Z lower-cased; shorter texts are one shingle; null and empty texts have none
    and link with nothing (their class is their own id). Rows with equal ids are rows of their own;
    null ids are the smallest only where a class has no other. Other columns are ignored.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    id_type = docs.schema["id"].dataType.simpleString()
    common = docs.select("text").mapInArrow(_common(n), "token long, docs long").groupBy("token").agg(F.sum("docs").alias("docs"))
    with batches_of(spark, 2000):
        common = common.orderBy(F.desc("docs"), "token").limit(COMMON_KEPT).toPandas().sort_values(["docs", "token"])
    hashes, rank = unsigned(common["token"].to_numpy(np.int64)), np.arange(len(common))
    order = np.argsort(hashes)
    shared = spark.sparkContext.broadcast((hashes[order], rank[order]))

    with batches_of(spark, 2000):
        rows = written(docs.mapInArrow(_prefixes(n, num, den, shared), f"id {id_type}, size int, node long, prefix array<long>"))
    entries = rows.select("node", "size", F.posexplode("prefix").alias("place", "token")).repartition("token").dropDuplicates(["token", "node"])
    entries = entries.withColumn("k", F.count("*").over(Window.partitionBy("token"))).filter("k > 1").drop("k")
    entries = written(entries)

    # A group: documents of one size that have the same entries at the same places.
    grouped = entries.groupBy("node", "size").agg(F.bit_xor(F.xxhash64("token", "place")).alias("x"), F.count("*").alias("k"))
    member = written(grouped.select("node", F.xxhash64("size", "x", "k").alias("group")))
    lead = member.groupBy("group").agg(F.min("node").alias("node"))
    of_groups = written(entries.join(lead, "node").select("token", "place", "size", "group", F.col("node").alias("lead")))

    def told(nodes: DataFrame, name: str, make) -> DataFrame:
        """(node, ``name``) of the sets of ``nodes``: another scan, but no shuffle of texts."""
        wanted = spark.sparkContext.broadcast(sieve(nodes, "node"))
        found = docs.select("text").mapInArrow(_wanted_only(n, wanted, name, make), f"node long, {name} binary")
        with batches_of(spark, 1000):  # copies have one set
            return written(found.groupBy("node").agg(F.any_value(name).alias(name)))

    def verified(pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) that link: profiles first, whole sets only for the pairs that these leave."""
        with batches_of(spark, 1000):
            left = written(_carrying(pairs, profiles, "profile").mapInArrow(_possible(num, den), "a long, b long"))
        ends = left.select(F.col("a").alias("node")).union(left.select("b")).distinct()
        sets = told(ends, "set", _packed)
        with batches_of(spark, 1000):
            return written(_carrying(left, sets, "set").mapInArrow(_verified(num, den), "a long, b long"))

    profiles = told(member.select("node"), "profile", _profile)

    # First round: each member against the lead of the group that comes first in most of its entries.
    hub = of_groups.groupBy("token").agg(F.min(F.struct("place", "lead", "size", "group")).alias("h"))
    near = of_groups.join(hub, "token").select("group", F.col("place").alias("place_x"), F.col("size").alias("size_x"), F.col("h.place").alias("place_y"), F.col("h.size").alias("size_y"), F.col("h.lead").alias("hub"))
    near = near.filter(_may_link(num, den, "x", "y")).groupBy("group", "hub").agg(F.count("*").alias("k"))
    near = near.groupBy("group").agg(F.max(F.struct("k", "hub")).alias("h")).select("group", F.col("h.hub").alias("b"))
    first = member.join(near, "group").select(F.col("node").alias("a"), "b").filter("a != b")
    links = verified(first)
    classes = written(connected_components(links))

    # Second round: pairs of groups with all their members in one class are done; the rest are expanded.
    state = written(member.join(classes, "node", "left").select("node", "group", F.coalesce("component", "node").alias("component")))
    spread = state.groupBy("group").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("members"))
    left = of_groups.join(spread, "group")
    x, y = (left.select("token", *(F.col(c).alias(f"{c}_{s}") for c in ("place", "size", "group", "low", "high"))) for s in "xy")
    done = (F.col("low_x") == F.col("high_x")) & (F.col("low_y") == F.col("high_y")) & (F.col("low_x") == F.col("low_y"))
    pairs = x.join(y, "token").filter("group_x < group_y").filter(~done & _may_link(num, den, "x", "y")).select("group_x", "group_y").distinct()
    own = spread.filter("low != high").select(F.col("group").alias("group_x"), F.col("group").alias("group_y"))
    pairs = written(pairs.union(own))
    mx, my = (state.select(F.col("group").alias(f"group_{s}"), F.col("node").alias(n_), F.col("component").alias(f"component_{s}")) for s, n_ in (("x", "a"), ("y", "b")))
    rest = pairs.join(mx, "group_x").join(my, "group_y").filter("component_x != component_y and (group_x != group_y or a < b)").select("a", "b")
    links = links.union(verified(rest))
    classes = written(connected_components(links))

    whole = rows.select("id", "size", "node").join(classes, "node", "left").select("id", "size", F.when(F.col("size") > 0, F.coalesce("component", "node")).alias("class"))
    least = whole.filter("class is not null").groupBy("class").agg(F.min("id").alias("least")).withColumnRenamed("class", "class_")
    out = whole.join(least, F.col("class") == F.col("class_"), "left")
    return out.select(F.col("id").alias(id_col), F.col("size").cast("long").alias("n_shingles"), F.coalesce("least", "id").alias("component_id"))


def _carrying(pairs: DataFrame, sets: DataFrame, column: str) -> DataFrame:
    """The pairs with ``column`` of both ends."""
    for end in "ab":
        pairs = pairs.join(sets.select(F.col("node").alias(end), F.col(column).alias(f"{column}_{end}")), end)
    return pairs.select("a", "b", f"{column}_a", f"{column}_b")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with exactly one row of each class: that of the smallest id, null last (action).

    All columns are kept. Rows are told apart by all their columns: of rows with equal ids that with the least
    hash stays, of equal rows one. Rows without shingles are in no class with another and stay, repeated or not.
    """
    return under_plain_names(docs, lambda d, i, t: _one_of_each(d, i, t, **options), id_col, text_col)


def _one_of_each(docs: DataFrame, id_col: str, text_col: str, **options) -> DataFrame:
    every = [*docs.columns, *(F.col(c).isNull() for c in docs.columns)]  # a hash passes over nulls
    named = docs.withColumn("_row", F.xxhash64(*every))
    name = F.struct(F.col(id_col).isNull().alias("no_id"), F.col(id_col).alias("id"), F.col("_row").alias("row"))
    classes = near_duplicate_classes(named.select(name.alias("name"), text_col), "name", text_col, **options)
    keep = classes.filter("component_id = name").groupBy(F.col("name.row").alias("_row"), F.col("name.id").alias("_id")).agg(((F.count("*") > 1) & (F.max("n_shingles") > 0)).alias("_again"))
    keep = written(keep)
    same = (F.col("a._row") == F.col("b._row")) & F.col(f"a.{id_col}").eqNullSafe(F.col("b._id"))
    kept = lambda which: named.alias("a").join(keep.filter(which).alias("b"), same, "left_semi")
    return kept("not _again").union(kept("_again").dropDuplicates(["_row", id_col])).drop("_row")
