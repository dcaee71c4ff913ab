"""Mixing, language identification, decontamination, URL filters and the pipeline."""

import re
from collections import Counter

import pytest

from seqframe.llm.decontamination import contaminations, without_contaminated
from seqframe.llm.language_id import language_id, recognised, trained
from seqframe.llm.mixing import mix, mix_report, mixed_documents, shard_quotas
from seqframe.llm.url_filters import filter_urls
from seqframe.session import written
from tests.llm.conftest import ODD, prose

SF = "/root/testdata/sf0.01"


def targets(sizes):
    """Targets by sharing the excess round after round."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    left, open_, out = 1.5 * sum(sizes.values()), set(names), {}
    while open_:
        unit = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if unit * weight[s] > 2 * sizes[s]}
        if not over:
            return out | {s: unit * weight[s] for s in open_}
        for s in over:
            out[s] = 2.0 * sizes[s]
            left -= out[s]
        open_ -= over
    return out


def sourced():
    rows = []
    for s, n in ((None, 40), ("a", 300), ("b", 25), ("é", 30), ("", 12), ("z", 60)):
        rows += [(len(rows) + k, prose(k, 5 + 7 * k % 60), "en", s) for k in range(n)]
    return [*rows, *rows[:3], (9_000, None, "en", "a"), (None, "one two", "en", "b")]


def test_mix_meets_targets(docs):
    df = docs(*sourced())
    got = mix_report(df).collect()
    sizes = Counter()
    for _, text, _, source in sourced():
        sizes[source] += len((text or "").split())
    want = targets(sizes)
    names = Counter({s: 0 for s in sizes})
    by_source = {i: s for i, _, _, s in sourced()}
    for r in got:
        assert r.source_size == sizes[by_source[r.doc_id]] and r.target == pytest.approx(want[by_source[r.doc_id]])
        assert 0 <= r.taken <= 2 * r["size"]
        names[by_source[r.doc_id]] += r.taken
    for s in sizes:
        assert abs(names[s] - want[s]) <= 40, s
    assert Counter(map(tuple, got)) == Counter(map(tuple, mix_report(df).collect()))


def test_mixed_rows_are_the_report(docs):
    df = docs(*sourced())
    words = lambda r: len((r.text or "").split())
    taken = Counter()
    for r in mixed_documents(df).collect():
        taken[r.doc_id, r.source] += words(r)
    report = Counter()
    by = {i: s for i, _, _, s in sourced()}
    for r in mix_report(df).collect():
        report[r.doc_id, by[r.doc_id]] += r.taken
    assert +taken == +report


def test_splitting_tree_is_exact(spark):
    draws = spark.createDataFrame([("=a", 100), ("=b", 37), ("", 5)], "source_key STRING, draws BIGINT")
    rows = shard_quotas(draws, 6, 1).collect()
    by_source, by_shard = Counter(), Counter()
    for r in rows:
        by_source[r.source_key] += r.quota
        by_shard[r.shard] += r.quota
    assert by_source == {"=a": 100, "=b": 37, "": 5}
    assert max(by_shard.values()) - min(by_shard.values()) <= 1


def test_mix_of_odd_and_empty_tables(odd, none):
    assert mix_report(odd).count() == len(ODD)
    assert mix_report(none).collect() == [] and mixed_documents(none).collect() == []
    sized, draws = mix(odd)
    assert draws.join(sized, "row", "left_anti").count() == 0


def test_language_id_held_out(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    rows = language_id(df).join(df.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.98 * len(rows) > 100


def test_language_id_odd_rows(docs, none):
    rows = [*((*r, "en", "s") for r in ODD), *((100 + k, "le été où ça " * (k + 1), "fr", "s") for k in range(8)), (300, "xyz", None, None)]
    got = language_id(docs(*rows)).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    assert {r.doc_id for r in got if r.lang_pred == "und"} == {1, 2, 3, 12}
    assert all(0 <= r.score <= 1 and r.lang_pred in ("en", "fr", "und") for r in got)
    assert language_id(none).collect() == []
    assert {r.lang_pred for r in language_id(docs((1, "abc", None, "s"), (2, None, "en", "s"))).collect()} == {"und"}


def test_recognised_keeps_columns(docs):
    df = docs(*((k, prose(k, 40), "en", "s") for k in range(10)), (20, "12 34", "en", "s"), (21, None, "en", "s"))
    kept = recognised(df, trained(df))
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == list(range(10))


@pytest.fixture(scope="module")
def items(spark):
    texts = [prose(900 + k, 30, 10**6) for k in range(5)]
    rows = [*enumerate(texts), (10, "only three words"), (11, None), (12, ""), (13, prose(903, 30, 10**6)), (None, prose(950, 20, 10**6))]
    return texts, spark.createDataFrame(rows, "item_id BIGINT, text STRING")


def test_contaminations(docs, items):
    texts, table = items
    near = texts[1].split()
    near[0], near[-1] = "other", "words"
    rows = [
        (1, prose(1) + " " + texts[0].upper() + ". " + prose(2)),
        (2, " ".join(near)),
        (3, texts[2][: len(texts[2]) // 2]),
        (4, "see ONLY, three words!"),
        (5, "only three"),
        (6, texts[3] + " " + prose(3) + " " + texts[3]),
        *ODD,
    ]
    got = {(r.doc_id, r.item_id): (r.start, round(r.similarity, 3)) for r in contaminations(docs(*[(i if i is None or i < 7 or k < 6 else i + 100, t) for k, (i, t) in enumerate(rows)]), table).collect()}
    assert set(got) == {(1, 0), (2, 1), (4, 10), (6, 3), (6, 13)}
    assert got[1, 0] == (200, 1.0) and got[6, 3] == (0, 1.0) and got[4, 10] == (1, 1.0) and 0.8 <= got[2, 1][1] < 1


def test_contaminated_documents_go(docs, items, none, spark):
    texts, table = items
    df = docs((1, texts[0]), (2, prose(5)), (3, None), (None, texts[1]), (None, prose(7)))
    assert sorted(str(r.doc_id) for r in without_contaminated(df, table).collect()) in (["2", "3"], ["2", "3", "None"])
    assert contaminations(none, table).collect() == []
    empty = spark.createDataFrame([], "item_id BIGINT, text STRING")
    assert without_contaminated(df, empty).count() == 5


RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def test_url_rules(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://WWW.Example.ORG/es/x?y", "https://example.org/en/12#t", "https://notexample.org/es/", "http://a.com/de/", "http://a.com", "http://com/fr/x", "x://a.net:80/p?://b.org/", "http://org", "http://org?x", "http://a.org\n/es"]
    pages = spark.createDataFrame([(k, u, None, 1, "x") for k, u in enumerate([*urls, *urls[4:6]])], "page_id BIGINT, url STRING, html STRING, host INT, rule STRING")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in filter_urls(pages, RULES).collect()}
    for k, u in enumerate([*urls, *urls[4:6]]):
        host = path = ""
        if u and "://" in u:
            m = re.match(r"([^/?#]*)([^?#]*)", u.split("://", 1)[1], re.S)
            host, path = m[1].lower(), m[2]
        fits = [(len(h + p), h + p, v) for h, p, v in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        assert got[k][:3] == (host, path, max(fits)[1] if fits else None), u
        assert got[k][3] == (max(fits)[2] if fits else "allow")


def test_links_carry_trust_and_distrust(spark):
    page = lambda *to: "".join(f'<a href="http://{t}/">' for t in to)
    pages = [
        (1, "http://good.org/", page("friend.net", "blog.net")),
        (2, "http://bad.com/de/", page("friend.net")),
        (3, "http://farm.net/", page("bad.com", "bad.com")),
        (4, "http://friend.net/", page("blog.net")),
        (5, "http://ring.net/", page("farm.net")),
        (6, "http://alone.net/", None),
    ]
    got = {r.page_id: r for r in filter_urls(spark.createDataFrame(pages, "page_id BIGINT, url STRING, html STRING"), RULES).collect()}
    assert [got[k].verdict for k in (1, 2, 3, 4, 5, 6)] == ["allow", "block", "block", "allow", "block", "allow"]
    assert got[4].trust > 0 == got[4].distrust and got[3].distrust > got[5].distrust > 0
    empty = spark.createDataFrame([], "page_id BIGINT, url STRING, html STRING")
    assert filter_urls(empty, RULES).collect() == []


def test_scores_equal_power_iteration(spark):
    """Two graphs of links and owners at once, against dense matrices until nothing moves."""
    import random

    import numpy as np
    from pyspark.sql import functions as F

    from seqframe.llm.url_filters import owner_edges, propagated, shares

    rng = random.Random(2)
    hosts = [f"{a}{b}.site{b}.{c}" for a in ("www.", "", "m.x.") for b in range(6) for c in ("com", "org")]
    owners = {tuple(r) for r in owner_edges(spark.createDataFrame([(h,) for h in hosts], "host STRING")).collect()}
    up = {h: h.split(".", 1)[1] for h in [".".join(h.split(".")[k:]) for h in hosts for k in range(4)] if h.count(".") >= 2}
    assert owners == {e for h, p in up.items() for e in ((h, p), (p, h))}
    links = {(a, b): rng.randrange(1, 5) for a, b in ((rng.choice(hosts), rng.choice(hosts)) for _ in range(60)) if a != b}
    rows = [(a, b, n, "link") for (a, b), n in links.items()] + [(a, b, 1, "owner") for a, b in owners]
    edges = spark.createDataFrame(rows, "src STRING, dst STRING, n LONG, kind STRING")
    back = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "n", "kind")
    both = shares(edges).withColumn("graph", F.lit("f")).unionByName(shares(back).withColumn("graph", F.lit("b")))
    seeds = [("f", hosts[0]), ("f", hosts[5]), ("b", hosts[7])]
    got = {(r.graph, r.host): r.score for r in propagated(both, spark.createDataFrame(seeds, "graph STRING, host STRING"), tolerance=1e-4).collect()}
    names = sorted({x for e in rows for x in e[:2]})
    at = {h: k for k, h in enumerate(names)}
    for graph in "fb":
        m = {k: np.zeros((len(names),) * 2) for k in ("link", "owner")}
        for a, b, n, kind in rows:
            a, b = (a, b) if graph == "f" else (b, a)
            m[kind][at[a], at[b]] += n
        have = {k: (v.sum(1) > 0) * w for k, v, w in (("link", m["link"], 0.8), ("owner", m["owner"], 0.2))}
        walk = sum(m[k] / np.maximum(m[k].sum(1), 1)[:, None] * (have[k] / np.maximum(have["link"] + have["owner"], 1e-9))[:, None] for k in m)
        start = np.array([sum(s == (graph, h) for s in seeds) for h in names], float)
        start /= start.sum()
        score = start
        for _ in range(400):
            score = 0.85 * score @ walk + 0.15 * start
        assert sum(abs(got.get((graph, h), 0.0) - score[k]) for k, h in enumerate(names)) < 1e-3


def test_owners_carry_scores_without_links(spark):
    pages = [(1, "http://a.bad.com/de/", None), (2, "http://b.bad.com/", None), (3, "http://x.good.org/", None), (4, "http://good.net/", None)]
    got = {r.page_id: r for r in filter_urls(spark.createDataFrame(pages, "page_id BIGINT, url STRING, html STRING"), RULES).collect()}
    assert got[2].distrust > 0 == got[2].trust and got[2].verdict == "block" and got[4].verdict == "allow"


def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("doc_id < 150 or text is null")
    for name, stage in corpus_pipeline.STAGES:
        before, columns = docs.count(), docs.columns
        docs = written(stage(spark, docs, SF))
        assert docs.columns[: len(columns)] == columns, name
        assert name == "mixing" or (docs.columns == columns and 0 < docs.count() <= before)


def test_classes_equal_their_twin(spark):
    import duckdb

    from seqframe.llm.queries import ORACLES, QUERIES

    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"create view {t} as select * from '/root/testdata/sf0.001/{t}.parquet'")
    for name, sql in ORACLES.items():
        got = QUERIES[name](spark, "/root/testdata/sf0.001")
        cursor = con.execute(sql)
        assert got.columns == [d[0] for d in cursor.description]
        assert sorted(map(tuple, got.collect())) == sorted(cursor.fetchall())


def test_every_language_is_learnt(docs):
    """Seventy languages, each with an alphabet of its own words, a frequent one among them."""
    import random

    def text(lang, seed):
        rng = random.Random(1_000 * lang + seed)
        pool = random.Random(lang)
        words_ = ["".join(pool.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(5)) for _ in range(12)]
        return " ".join(rng.choice(words_) for _ in range(60))

    rows = [(lang * 100 + k, text(lang, k), f"l{lang:02d}", "web") for lang in range(70) for k in range(12 if lang else 90)]
    got = language_id(docs(*rows)).collect()
    names = {i: lang for i, _, lang, _ in rows}
    held = [r for r in got if r.held_out]
    assert {r.lang_pred for r in got} == set(names.values())
    assert sum(r.lang_pred == names[r.doc_id] for r in held) >= 0.95 * len(held) > 100


def test_copies_of_a_labelled_text_count_once(docs):
    model = trained(docs(*[(1, "un deux trois", "fr", "web")] * 500, (2, "one two three", "en", "web")))
    assert model is not None and model[2] == ["en", "fr"]
