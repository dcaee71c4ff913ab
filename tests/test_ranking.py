import random

import pytest

from seqframe.operators import ranking as R


def test_ordinals_are_dense_whatever_the_layout(spark):
    values = list(range(500))
    random.Random(1).shuffle(values)
    df = spark.createDataFrame([(v,) for v in values], "v INT").repartition(7)
    got = R.ordinals(df, ["v"]).collect()
    assert sorted((r.v, r.ord) for r in got) == [(v, v) for v in range(500)]


def test_rank_in_a_group_that_holds_most_rows(spark):
    rows = [("hot", i) for i in range(900)] + [(f"g{i % 50}", i) for i in range(100)]
    random.Random(2).shuffle(rows)
    got = R.rank_in_group(spark.createDataFrame(rows, "g STRING, o INT").repartition(5), ["g"], ["o"]).collect()
    want, seen = {}, {}
    for g, o in sorted(rows):
        want[g, o] = seen.get(g, 0)
        seen[g] = want[g, o] + 1
    assert {(r.g, r.o): r["rank"] for r in got} == want


def test_a_hot_group_is_ranked_by_several_partitions(spark):
    """The sorted write of one group spreads over partitions instead of sitting in one."""
    df = spark.createDataFrame([("hot", i) for i in range(20000)], "g STRING, o INT")
    ordered = df.repartitionByRange(4, "g", "o")
    sizes = ordered.rdd.glom().map(len).collect()
    assert len([s for s in sizes if s]) == 4 and max(sizes) < 20000 / 2


def brute_round_robin(members, limit):
    classes = sorted({c for c, _ in members})
    buckets = {c: sorted({i for k, i in members if k == c}) for c in classes}
    chosen, seen, depth = [], set(), 0
    while len(chosen) < limit and any(depth < len(b) for b in buckets.values()):
        for c in classes:
            if depth < len(buckets[c]) and buckets[c][depth] not in seen and len(chosen) < limit:
                seen.add(buckets[c][depth])
                chosen.append(buckets[c][depth])
        depth += 1
    return chosen


@pytest.mark.parametrize("limit", [1, 20, 10_000])
def test_round_robin_cap_equals_brute_force_in_order(spark, limit):
    rng = random.Random(limit)
    members = [(f"c{rng.choice([0, 0, 0, 0, 1, 2, 3])}", f"id{rng.randrange(200):03d}") for _ in range(400)]
    got = R.round_robin_cap(spark.createDataFrame(members, "class STRING, id STRING"), limit)
    assert [r.id for r in got.orderBy("depth", "class").collect()] == brute_round_robin(members, limit)


def test_every_class_survives_a_cap_of_one_each(spark):
    members = [(f"c{k}", f"id{k}{i}") for k in range(10) for i in range(20)]
    got = R.round_robin_cap(spark.createDataFrame(members, "class STRING, id STRING"), 10).collect()
    assert {r["class"] for r in got} == {f"c{k}" for k in range(10)}


def test_balanced_cap_alternates(spark):
    df = spark.createDataFrame([(f"a{i:02d}", 0) for i in range(30)] + [(f"b{i:02d}", 1) for i in range(3)], "k STRING, y INT")
    got = R.balanced_cap(df, "y", "k", 8).orderBy("rank", "y").collect()
    assert [r.k for r in got] == ["a00", "b00", "a01", "b01", "a02", "b02", "a03", "a04"]


def test_first_rows_is_the_same_both_ways(spark):
    df = spark.range(1000).withColumnRenamed("id", "v").repartition(6)
    small = [r.v for r in R.first_rows(df, ["v"], 40).collect()]
    large = sorted(r.v for r in R.first_rows(df, ["v"], 40, top_k=10).collect())
    assert small == large == list(range(40))


def test_block_starts_round_half_to_even():
    assert R.block_starts(9, 1) == [4]  # 4.5
    assert R.block_starts(7, 1) == [4]  # 3.5
    assert R.block_starts(90, 8) == [10, 20, 30, 40, 50, 60, 70, 80]


def test_strided_blocks_stop_at_the_row_limit_and_repeat_overlaps(spark):
    df = spark.range(90).withColumnRenamed("id", "n")
    got = R.strided_blocks(df, ["n"], 8, 4, 10)
    assert [r.n for r in got.orderBy("block", "position").collect()] == [10, 11, 12, 13, 20, 21, 22, 23, 30, 31]
    assert {(r.block, r.rows) for r in R.block_provenance(got).collect()} == {(1, 4), (2, 4), (3, 2)}
    overlapping = R.strided_blocks(spark.range(9).withColumnRenamed("id", "ord"), None, 2, 5, 100, ordinal="ord")
    assert sorted(r.position for r in overlapping.collect()) == [3, 4, 5, 6, 6, 7, 7, 8]
    with pytest.raises(ValueError):
        R.strided_blocks(df.limit(0), ["n"], 2, 5, 10)


def test_duplicate_keys_keep_text_keys_apart(spark):
    df = spark.createDataFrame([("1",), ("001",), ("1",), ("b",), ("b",)], "sample_id STRING")
    assert {(r.sample_id, r.n) for r in R.duplicate_keys(df).collect()} == {("1", 2), ("b", 2)}
    assert R.duplicate_summary(df).first() == (2, "1, b")
    assert R.duplicate_summary(df.distinct()).first() == (0, "")


def test_keyed_sample_ignores_layout(spark):
    df = spark.range(300)
    a = {r.id for r in R.keyed_sample(df, "id", 25, seed=3).collect()}
    assert a == {r.id for r in R.keyed_sample(df.repartition(9), "id", 25, seed=3).collect()}
    assert len(a) == 25 and a != {r.id for r in R.keyed_sample(df, "id", 25, seed=4).collect()}


@pytest.mark.parametrize("n", [3, 2000])
def test_first_of_each_equals_brute_force(spark, n):
    rng = random.Random(n)
    rows = [(rng.choice([None, "a", "a", "a", "b"]), rng.randrange(10**9)) for _ in range(3000)]
    got = R.first_of_each(spark.createDataFrame(rows, "g STRING, v BIGINT"), ["g"], ["v"], n)
    want = {(g, v, k) for g in (None, "a", "b") for k, v in enumerate(sorted(v for h, v in rows if h == g)[:n])}
    assert {(r.g, r.v, r["rank"]) for r in got.collect()} == want


def test_small_caps_sort_nothing_as_a_whole(spark):
    members = spark.createDataFrame([("a", "x"), ("b", "y")], "class STRING, id STRING")
    for df in (R.round_robin_cap(members, 500), R.balanced_cap(members, "class", "id", 500)):
        text = df._jdf.queryExecution().executedPlan().toString()
        assert "WindowGroupLimit" in text and "rangepartitioning" not in text


def test_last_of_each_key(spark):
    rows = [("a", 1, "x"), (None, 2, "y"), ("a", 5, "z"), (None, 3, "u"), ("b", 4, "v"), ("a", 0, "w")]
    got = R.last_of_each(spark.createDataFrame(rows, "k STRING, at INT, wide STRING"), "k", "at")
    assert sorted((r.at, r.wide) for r in got.collect()) == [(3, "u"), (4, "v"), (5, "z")]
