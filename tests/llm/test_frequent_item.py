"""Edited copies of a benchmark item are found however many documents hold it, and wherever its parts lie."""

import random

from seqframe.llm.decontamination import contaminations
from tests.llm.conftest import prose


def alike(text, item):
    """The best Jaccard similarity of five-word shingles over all windows."""
    cut = lambda w: {tuple(w[k : k + 5]) for k in range(len(w) - 4)}
    w, own = text.split(), cut(item.split())
    n = len(item.split())
    return max(len(own & (x := cut(w[a : a + n]))) / len(own | x) for a in range(max(len(w) - n, 0) + 1))


def test_edits_of_a_frequent_item(docs, spark):
    item, rng = prose(960, 60, 10**6), random.Random(4)
    edited = []
    for k in range(200):
        w = item.split()
        w[rng.randrange(2, 58)] = "changed"
        if k % 2:
            w.insert(rng.choice((2, 3, 57)), "new")
        edited.append(" ".join([*prose(k, 20).split(), *w, *prose(k + 500, 20).split()]))
    halves = " ".join([*item.split()[30:], *item.split()[:30]])  # 52 of 60 shingles
    rows = [*enumerate(edited), (900, prose(3) + " " + halves), *((1000 + k, prose(k, 10) + " " + item) for k in range(300)), *((2000 + k, prose(k, 10)) for k in range(300))]
    table = spark.createDataFrame([(0, item), (1, prose(961, 60, 10**6))], "item_id BIGINT, text STRING")
    got = {r.doc_id: r for r in contaminations(docs(*rows), table).collect()}
    want = {i for i, t in rows if alike(t, item) >= 0.8}
    assert len(want) > 400 and set(got) <= want
    near = {i for i in want if i < 1000}
    print("recall at 0.8-0.9:", len(near & set(got)), "of", len(near))
    assert len(near & set(got)) >= 0.97 * len(near) and want - near <= set(got)
    assert 900 in got and got[900].start == 200
    assert all(abs(got[i].similarity - alike(t, item)) < 1e-9 for i, t in rows[:20] if i in got)
