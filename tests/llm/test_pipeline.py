"""The whole pipeline over odd, repeated and planted rows, against plain Python."""

import random
import re
from collections import Counter

import pytest

import corpus_pipeline
from tests.llm.conftest import SPACE

SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"
POOLS = {"en": "the of and with house river stone light under garden winter", "de": "der und mit haus strom stein licht unter garten winterzeit schnee"}


def prose(lang, seed, n=120):
    rng = random.Random(f"{lang}{seed}")
    return " ".join(rng.choice(POOLS[lang].split()) + rng.choice(["", "", "a", "en", "ly"]) + str(rng.randrange(30)) for _ in range(n))


def rows():
    out = [(k, prose(lang, k), lang, f"s{k % 3}") for k, lang in enumerate(["en", "de"] * 25)]
    passage, item = prose("en", "shared", 70), prose("en", "item", 40)
    out += [(100, out[0][1], "en", "s0"), (101, out[0][1] + " tail", "en", "s1"), (3, prose("de", 300), "de", "s0"), (3, prose("de", 300), "de", "s0")]
    out += [(110 + k, prose("en", 400 + k, 60) + " " + passage + " " + prose("en", 500 + k, 60), "en", "s2") for k in range(3)]
    out += [(120, prose("en", 600, 50) + " " + item + " " + prose("en", 601, 50), "en", "s0"), (None, prose("de", 700), "de", None)]
    out += [(130, None, "en", "s0"), (131, "", None, "s0"), (132, " \n\t", "en", "s0"), (133, "12 34 !!", "en", "s0")]
    return out, passage, item


def shingles(text):
    w = re.findall(SPACE, text.lower())
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or {tuple(w)}


def expected(table, passage, item):
    """(id, text) of the rows that all stages but the mix keep."""
    left = [(i, t) for i, t, _, _ in table if t and any(map(str.isalpha, t))]
    kept, seen = [], []
    for i, t in sorted(left, key=lambda r: (r[0] is None, r[0] or 0)):
        own = shingles(t)
        if not any(len(own & s) >= 0.8 * len(own | s) for s in seen):
            kept.append((i, t))
        seen.append(own)
    strings = Counter(t[k : k + 256] for _, t in kept for k in range(len(t) - 255))
    assert any(strings[passage[k : k + 256]] > 1 for k in range(len(passage) - 255))
    cut = []
    for i, t in kept:  # ASCII, so bytes are characters
        gone = {j for k in range(len(t) - 255) if strings[t[k : k + 256]] > 1 for j in range(k, k + 256)}
        cut.append((i, "".join(c for j, c in enumerate(t) if j not in gone)))
    return {(i, t) for i, t in cut if item not in t}


@pytest.fixture
def folder(spark, tmp_path):
    def make(table, item):
        spark.createDataFrame([(*r, len(r[1] or "")) for r in table], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
        spark.createDataFrame([(1, item)], "item_id BIGINT, text STRING").write.parquet(str(tmp_path / "benchmark.parquet"))
        return str(tmp_path)

    return make


def test_run_equals_plain_python(spark, folder):
    table, passage, item = rows()
    got = corpus_pipeline.run(spark, folder(table, item)).collect()
    want = expected(table, passage, item)
    found = {(r.doc_id, r.text) for r in got}
    assert found <= want
    whole = Counter()
    for r in got:
        whole[r.source] += len(r.text.split())
    sizes, of = Counter(), {i: s for i, _, _, s in table}
    for i, t in want:
        sizes[of[i]] += len(t.split())
    # Sources whose target is twice their size keep every row.
    full = {s for s in sizes if whole[s] >= 1.9 * sizes[s]}
    assert full and {r for r in found if of[r[0]] in full} == {(i, t) for i, t in want if of[i] in full}
    times = Counter((r.doc_id, r.text) for r in got)
    assert max(times.values()) <= 2, whole
    assert all(r.n_chars == len(r.text) for r in got) and got[0].asDict().keys() >= {"doc_id", "text", "lang", "source", "n_chars", "mix_shard"}


def test_an_empty_table(spark, folder):
    assert corpus_pipeline.run(spark, folder([], "some item of a benchmark with a few words")).collect() == []
