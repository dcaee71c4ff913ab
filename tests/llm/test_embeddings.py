"""Hard negatives and whitening against brute force over numpy."""

from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from seqframe.llm import hard_negatives as H
from seqframe.llm.queries import NEGATIVES_SQL, op11_hard_negatives
from seqframe.llm.whitening import fit, integral, transformed, whitened

SCHEMA = "vec_id BIGINT, label INT, embedding ARRAY<DOUBLE>, x INT, id STRING, name STRING, length INT, part INT, chunk INT, z INT, k INT"
NAN, INF = float("nan"), float("inf")


@pytest.fixture(scope="session")
def table(spark):
    """Vectors in a table with other columns of clashing names."""

    def make(rows):
        return spark.createDataFrame([(i, label, None if v is None else [None if c is None else float(c) for c in v], 1, "i", "n", 2, 3, 4, 5, 6) for i, label, v in rows], SCHEMA)

    return make


def cloud(n, d=8, seed=0, labels=3, scale=1.0):
    rng = np.random.default_rng(seed)
    return [(i, int(rng.integers(labels)), (rng.standard_normal(d) * scale * rng.exponential()).tolist()) for i in range(n)]


BAD = [(900, 1, None), (950, 1, [1.0, None]), (1000, 0, [NAN] * 8), (1050, 0, [1.0] * 7 + [-INF]), (1100, None, [1.0] * 8), (None, 1, [1.0] * 8)]


def mined(rows, step=5):
    """Counter of result rows; vectors are filled up with zeros."""
    good = [(i, label, v) for i, label, v in rows if i is not None and label is not None and v is not None and all(c is not None and np.isfinite(c) for c in v)]
    d = max((len(v) for _, _, v in good), default=0)
    xs = [[int(np.floor(min(max(256 * c, -(2.0**40)), 2.0**40))) for c in v] + [0] * (d - len(v)) for _, _, v in good]
    out, seen = Counter(), set()
    for (a, label, _), x in zip(good, xs, strict=True):
        if a % step or (a, label, tuple(x)) in seen:
            continue
        seen.add((a, label, tuple(x)))
        scored = sorted((-sum(p * q for p, q in zip(x, y, strict=True)), i, other) for (i, other, _), y in zip(good, xs, strict=True))
        for s, p, _ in [t for t in scored if t[2] == label and t[1] != a][:5]:
            found = [t for t in scored if t[2] != label and -50 * s <= -100 * t[0] <= -95 * s][:3]
            for rank, (t, n, _) in enumerate(found, 1):
                out[a, p, rank, n, -s, -t] += 1
    return out


def test_hard_negatives_equal_brute_force(table, monkeypatch):
    monkeypatch.setattr(H, "BUCKET", 16)
    rows = cloud(160) + BAD
    got = Counter(map(tuple, H.hard_negatives(table(rows), F.col("vec_id") % 5 == 0).collect()))
    assert got == mined(rows) and len(got) > 100


def test_hard_negatives_ties_repeats_and_odd_vectors(table):
    rows = [(i, i % 2, [1.0, 0.0, 0.5]) for i in range(40)] + [(5, 1, [1.0, 0.0, 0.5])] * 3 + [(10, 1, [3.0, 1.0, 0.0]), (60, 0, [0.0] * 3), (65, 1, []), (70, 1, [2.0]), (75, 0, [0.9, 0.1])]
    rows += [(80 + k, k % 2, [1e30 * (1 - 0.4 * (k % 2)), 0.0, 1e9]) for k in range(8)]
    rows += [(100 + k, k % 2, [1.0 + 0.1 * k, 0.2 * k, 0.0]) for k in range(10)]
    assert Counter(map(tuple, H.hard_negatives(table(rows), F.col("vec_id") % 5 == 0).collect())) == mined(rows)


def test_hard_negatives_of_little(table):
    every = F.col("vec_id") % 5 == 0
    for rows in ([], BAD, [(5, 0, [1.0, 2.0])], [(5, 0, []), (10, 0, []), (11, 1, [])], [(1, 0, [1.0]), (2, 1, [1.0])]):
        assert H.hard_negatives(table(rows), every).collect() == [(5, 10, 1, 11, 0, 0), (10, 5, 1, 11, 0, 0)] * (rows[0][2] == [] if rows and rows[0][2] is not None else 0)


def test_groups_and_chunks_do_not_matter(table, monkeypatch):
    rows = cloud(120, seed=3)
    monkeypatch.setattr(H, "GROUP", 4)
    monkeypatch.setattr(H, "CHUNK", 1)
    assert Counter(map(tuple, H.hard_negatives(table(rows), F.col("vec_id") % 5 == 0).collect())) == mined(rows)


def test_ranges_leave_rows_out_and_lose_none():
    """Vectors near a few axes: the focus coordinate's range cuts most rows off; every row that reaches the score stays."""
    rng = np.random.default_rng(1)
    x = np.floor(256 * (np.eye(8)[rng.integers(8, size=600)] + 0.1 * rng.standard_normal((600, 8)))).astype(np.int64)
    unit, lengths = H.directions(x)
    order = np.argsort(unit, axis=0, kind="stable").T.astype("<i4")
    row = {"ids": np.arange(600).tobytes(), "labels": np.zeros(600, np.int64).tobytes(), "x": x.tobytes(), "kind": "<i8", "orders": order.tobytes(), "longest": float(lengths.max()), "d": 8}
    bucket, group = H.Bucket(row), H.Anchors(x[:50], np.zeros(50, np.int64), np.arange(50))
    scores = x[:50] @ x.T
    least = np.sort(scores, axis=1)[:, -6]
    whole, some, out = group.candidates(bucket, least)
    held = {a: set(rows.tolist()) for a, rows in some}
    for a in range(50):
        if a not in whole:
            assert set(np.flatnonzero(scores[a] >= least[a]).tolist()) <= held.get(a, set())
    assert out > 0.5 * scores.size
    whole, some, out = group.candidates(bucket, np.full(50, 10**12))
    assert not len(whole) and not some and out == scores.size


def test_query_equals_its_twin(spark):
    sf = "/root/testdata/sf0.001"
    want = duckdb.sql(NEGATIVES_SQL.replace("from embeddings", f"from '{sf}/embeddings.parquet'")).fetchall()
    assert Counter(map(tuple, op11_hard_negatives(spark, sf).collect())) == Counter(want) and want


def whitening_of(rows, k=16):
    """(distinct x, n, S, eigenvalues, vectors) in numpy."""
    good = [v for _, _, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    d = max(map(len, good))
    x = np.array([[int(np.floor(min(max(64 * c, -(2.0**40)), 2.0**40))) + 10**6 for c in v] + [10**6] * (d - len(v)) for v in good], object)
    fitted = np.array(sorted(set(map(tuple, x.tolist()))), object)
    n, sums = len(fitted), fitted.sum(axis=0)
    centred = np.array([[float(v * n - s) / n for v, s in zip(r, sums, strict=True)] for r in fitted.tolist()])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    return x, n, sums, values[::-1][:k], vectors[:, ::-1][:, :k], values.sum()


def check_whitening(table, rows):
    got = whitened(table(rows)).collect()
    x, n, sums, values, vectors, trace = whitening_of(rows)
    kept = [i for i, _, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    live = values > 1e-12 * values[0]
    assert Counter((r.vec_id, r.component) for r in got) == Counter((i, k + 1) for i in kept for k in range(len(values)))
    by = {}
    for r in got:
        by.setdefault((r.vec_id, r.component), r)
    for i, row in zip(kept, x.tolist(), strict=True):
        off = [n * v - s for v, s in zip(row, sums, strict=True)]
        want = np.abs(np.array([o / n for o in off], float) @ vectors)
        total = sum(o * o for o in off)
        for k in range(len(values)):
            r = by[i, k + 1]
            if kept.count(i) == 1:
                assert r.deviation == (total if total < 2**63 else None)
                if live[k]:
                    assert abs(abs(r.whitened) - want[k] / np.sqrt(values[k])) < 1e-9
            assert (r.whitened is not None) == live[k] and r.n == n
            assert abs(r.explained - values[k] / trace) < 1e-9 if trace else r.explained == 0
            assert r.identity_error <= 1e-6
    return got


def test_whitening_equals_brute_force(table):
    rng = np.random.default_rng(5)
    mix = rng.standard_normal((40, 40)) * np.linspace(3, 1, 40)
    rows = [(i, 0, v) for i, v in enumerate((rng.standard_normal((400, 40)) @ mix).tolist())]
    rows += [(1000 + i, 0, rows[3][2]) for i in range(50)] + [(7, 0, rows[9][2])] + BAD
    rows = [r for r in rows if r[0] not in (None, 1100)]
    got = check_whitening(table, rows)
    assert max(r.residual for r in got) < 1e-12


def test_whitening_of_odd_vectors(table):
    check_whitening(table, cloud(30, d=3))
    check_whitening(table, [(i, 0, [i * 1.0, 2.0 * i, 0.0, 1.0]) for i in range(20)] + [(50, 0, [3.0]), (None, 0, [1.0, 1.0, 1.0, 1.0])])
    check_whitening(table, [(1, 0, [1.0, 2.0]), (2, 0, [1.0, 2.0])])
    check_whitening(table, [(1, 0, [1e30, -1e30]), (2, 0, [0.0, 1.0]), (3, 0, [5.0, 5.0])])


def test_whitening_of_nothing(table):
    names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error", "residual"]
    for rows in ([], [(1, 0, None), (2, 0, [NAN])], [(1, 0, []), (2, 0, [])]):
        out = whitened(table(rows))
        assert out.columns == names and out.collect() == []


def test_close_spectrum_is_certified(table):
    """Eigenvalues one part in a thousand apart across the border of what is wanted."""
    rng = np.random.default_rng(9)
    scale = np.sqrt(1 + 0.001 * np.arange(64))
    rows = [(i, 0, v) for i, v in enumerate((10 * rng.standard_normal((300, 64)) * scale).tolist())]
    vectors = integral(table(rows))
    model = fit(vectors)
    x, n, sums, values, axes, trace = whitening_of(rows)
    assert model.residual <= 1e-10 and np.allclose(model.values, values, rtol=1e-10) and np.allclose(np.abs(np.sum(model.vectors * axes, axis=0)), 1, atol=1e-9)
    assert transformed(vectors, model).count() == 300
