import random
from collections import Counter

import pytest

from seqframe.llm.components import _step, connected_components
from seqframe.llm.prefix_join import near_duplicate_classes, one_of_each
from tests.llm.conftest import ODD, prose, spaced


def brute(rows, n, num, den):
    """Sizes and classes by comparing all pairs."""
    sets = []
    for _, text in rows:
        w = spaced(text)
        sets.append(frozenset(tuple(w[k : k + n]) for k in range(len(w) - n + 1)) or (frozenset([tuple(w)]) if w else frozenset()))
    top = list(range(len(rows)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and den * both >= num * (len(sets[a]) + len(sets[b]) - both):
                top[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return Counter((i, len(s), least.get(find(k), i)) for k, ((i, _), s) in enumerate(zip(rows, sets, strict=True)))


def edited(seed):
    """Groups of copies with random edits, and texts that share a long passage."""
    rng, rows = random.Random(seed), []
    passage = prose(seed + 1000, 60)
    for g in range(6):
        words = prose(seed * 10 + g, rng.choice([12, 80, 150])).split()
        for _ in range(rng.randrange(1, 14)):
            copy = list(words)
            for _ in range(rng.randrange(0, 5)):
                copy[rng.randrange(len(copy))] = f"e{rng.randrange(1000)}"
            rows.append(" ".join(copy))
    rows += [prose(seed * 100 + k, 80) + " " + passage for k in range(20)]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("n,num,den", [(3, 90, 100), (5, 80, 100)])
def test_classes_equal_all_pairs(docs, n, num, den):
    rows = edited(n)
    got = near_duplicate_classes(docs(*rows), n=n, num=num, den=den)
    assert Counter(map(tuple, got.collect())) == brute(rows, n, num, den)


def test_odd_rows(odd):
    got = near_duplicate_classes(odd, n=3, num=90, den=100)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert Counter(map(tuple, got.collect())) == brute(ODD, 3, 90, 100)


def test_empty_table(none):
    assert near_duplicate_classes(none).collect() == []
    assert one_of_each(none).columns == none.columns


def test_one_of_each_keeps_the_smallest_id(docs):
    a, b = prose(1), prose(2)
    kept = one_of_each(docs((5, a), (3, a), (9, b), (7, a + " more"), (1, None), (2, "")))
    assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == [1, 2, 3, 9]


def test_components_of_a_chain_and_a_star(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(1, 30)] + [(7, 7), (None, 3)]
    got = dict(map(tuple, connected_components(spark.createDataFrame(links, "a BIGINT, b BIGINT")).collect()))
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 130), 100)}


def test_a_step_names_its_links_four_times_at_most(spark, tmp_path, capsys):
    """Plans, which the driver holds and prints again at each stage's end, must not double with each join."""
    spark.createDataFrame([(2, 1), (3, 2)], "u BIGINT, v BIGINT").write.parquet(f"{tmp_path}/links")
    _step(spark.read.parquet(f"{tmp_path}/links")).explain()
    assert 1 <= capsys.readouterr().out.count("FileScan") <= 4
