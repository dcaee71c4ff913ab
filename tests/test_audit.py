import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seqframe.functions.digests import ALGORITHM
from seqframe.plans import audit as A

CHECKS = (
    "primary_key_column_exists", "primary_key_non_null", "primary_key_unique",
    "all_position_columns_integer", "labels_only_documented_values",
)


def profile(path, source="s1", projection=None, **changes):
    base = {
        "path": path, "source_key": source, "profile": "full", "source": source, "source_url": "u", "licence": "open",
        "target_description": "what it is, in full", "n_semantics": 2, "encoding_mode": "letter", "cipher": "A=1 .. Z=26",
        "padding_token": 0, "header": ["sample_id", "target", "position_1", "position_2"], "target_columns": ["target"],
        "feature_columns": ["position_1", "position_2"], "config_hash": "cfg", "n_samples": 2, "samples_n_rows": 2,
        "samples_content_hash": "side", "target_hash": None, "projection": projection,
    }
    return base | changes


def block(index, n=2, **changes):
    names, slugs, hashes = ([f"{p}{i}" for i in range(n)] for p in ("N ", "n", "h"))
    base = {
        "original_target_index": index, "original_target_count": n, "original_target_name": f"N {index}", "original_target_slug": f"n{index}",
        "source_target_names": names, "source_target_slugs": slugs, "source_target_hashes": hashes,
        "source_target_hash_algorithm": ALGORITHM, "source_row_count": 2,
    }
    return base | changes


def projected(index, n=2, **changes):
    own = {k: changes.pop(k) for k in list(changes) if k in block(0)}
    return profile(f"t__n{index}", projection=block(index, n, **own), target_hash=f"h{index}") | changes


@pytest.fixture
def make(spark):
    schema = T._parse_datatype_string(A.PROFILE_SCHEMA)

    def profiles(*rows):
        ordered = [tuple(r[f] if f != "projection" or r[f] is None else tuple(r[f][g.name] for g in schema["projection"].dataType.fields) for f in schema.fieldNames()) for r in rows]
        return spark.createDataFrame(ordered, schema)

    return profiles


def checks(spark, *paths, failing=()):
    rows = [(p, n, (p, n) not in failing) for p in paths for n in CHECKS]
    return spark.createDataFrame(rows, "path STRING, name STRING, passed BOOLEAN")


def declared(spark, *rows):
    return spark.createDataFrame(
        [(k, ready, k, "u", "open", "what it is") for k, ready in rows],
        "source_key STRING, ready BOOLEAN, source STRING, source_url STRING, licence STRING, target_description STRING",
    )


def failures(spark, made, failing=()):
    found = A.per_table_findings(checks(spark, "t", failing=failing), made, declared(spark, ("s1", True)))
    return {r.requirement for r in found.collect() if not r.passed}


def test_a_sound_table_meets_every_requirement(spark, make):
    assert failures(spark, make(profile("t"))) == set()


@pytest.mark.parametrize(
    "changes, broken",
    [
        ({"target_columns": ["target_0", "target_1"]}, {2, 3}),
        ({"feature_columns": ["position_2", "position_1"]}, {3}),
        ({"feature_columns": ["position_1", "extra"], "header": ["sample_id", "target", "position_1", "extra"]}, {3}),
        ({"cipher": "A=0"}, {4}),
        ({"padding_token": None}, {4}),
        ({"encoding_mode": "codon"}, {4}),
        ({"licence": "closed"}, {5}),
        ({"source_url": None}, {5}),
        ({"target_description": "something else"}, {5}),
        ({"n_semantics": 0}, {5}),
    ],
)
def test_a_manifest_that_breaks_a_requirement(spark, make, changes, broken):
    assert failures(spark, make(profile("t", **changes))) == {A.REQUIREMENTS[i] for i in broken}


@pytest.mark.parametrize(
    "name, broken",
    [("primary_key_unique", {0, 1}), ("all_position_columns_integer", {0, 3}), ("labels_only_documented_values", {0, 5})],
)
def test_a_failed_check_breaks_its_requirements(spark, make, name, broken):
    assert failures(spark, make(profile("t")), failing={("t", name)}) == {A.REQUIREMENTS[i] for i in broken}


def test_checks_that_never_ran_are_not_passed(spark, make):
    found = A.per_table_findings(checks(spark, "other"), make(profile("t")), declared(spark, ("s1", True)))
    assert sum(not r.passed for r in found.collect()) == 4


def test_rollup_counts_and_shows_one_failure(spark, make):
    both = make(profile("a"), profile("b", cipher="x"), profile("c", cipher="y"))
    found = A.per_table_findings(checks(spark, "a", "b", "c"), both, declared(spark, ("s1", True)))
    rolled = {r.requirement: r for r in A.requirement_rollup(found).collect()}
    bad = rolled[A.REQUIREMENTS[4]]
    assert (bad.status, bad.n_tables, bad.n_failed) == ("FAIL", 3, 2) and bad.failures.startswith("b: ") and bad.failures.count("; ") == 1
    assert rolled[A.REQUIREMENTS[0]].status == "PASS" and rolled[A.REQUIREMENTS[0]].failures is None


def test_provenance_field_by_field(spark, make):
    row = A.provenance_check(make(profile("t", licence="x")), declared(spark, ("s1", True))).first()
    assert (row.source_ok, row.url_ok, row.licence_ok, row.description_ok, row.semantics_ok) == (True, True, False, True, True)


def test_inventory(spark):
    schema = "path STRING, content_hash STRING"
    want = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3"), ("d", "4"), ("d", "4"), ("../x", "5"), ("C:/y", "6"), ("/z", "7"), (r"..\w", "8")], schema)
    found = spark.createDataFrame([("a", "1"), ("b", "9"), ("d", "4"), ("e", "5")], schema)
    got = {r.path: r.status for r in A.inventory_reconcile(want, found).collect()}
    assert got == {
        "a": "ok", "b": "hash_differs", "c": "missing", "d": "repeated", "e": "unexpected",
        "../x": "unsafe_path", "C:/y": "unsafe_path", "/z": "unsafe_path", r"..\w": "unsafe_path",
    }


def run_record(spark, **changes):
    base = {"complete": True, "profile": "full", "target_layout": "single", "config_hash": "cfg", "enabled": ["a", "b"], "converted": ["a"], "gated": ["b"], "n_tables": 1}
    schema = "complete BOOLEAN, profile STRING, target_layout STRING, config_hash STRING, enabled ARRAY<STRING>, converted ARRAY<STRING>, gated ARRAY<STRING>, n_tables INT"
    return spark.createDataFrame([tuple((base | changes).values())], schema)


@pytest.mark.parametrize(
    "changes, word",
    [
        ({}, ""), ({"complete": False}, "incomplete"), ({"profile": "demo"}, "profile"), ({"target_layout": "native"}, "layout"),
        ({"config_hash": None}, "config"), ({"enabled": ["a"]}, "enabled"), ({"converted": ["a", "b"]}, "both"), ({"gated": []}, "partition"),
    ],
)
def test_run_record(spark, changes, word):
    same = spark.createDataFrame([("a", "ok")], "path STRING, status STRING")
    row = A.inventory_requirement(run_record(spark, **changes), same, profile="full", config_hash="cfg", enabled=["a", "b"]).first()
    assert row.status == ("FAIL" if word else "PASS") and word in row.detail


def test_run_record_sees_tables_that_differ_and_its_own_absence(spark):
    args = {"profile": "full", "config_hash": "cfg", "enabled": ["a", "b"]}
    bad = spark.createDataFrame([("a", "ok"), ("b", "missing"), ("c", "missing")], "path STRING, status STRING")
    row = A.inventory_requirement(run_record(spark), bad, **args).first()
    assert row.status == "FAIL" and row.detail == "2 table(s) missing"
    none = A.inventory_requirement(run_record(spark).limit(0), bad.limit(0), **args).first()
    assert (none.status, none.detail) == ("FAIL", "no run record")


def test_source_partition(spark):
    key = "source_key STRING"
    got = A.source_partition(
        spark.createDataFrame([("a",), ("b",), ("c",)], key), spark.createDataFrame([("a",), ("b",), ("x",)], key), spark.createDataFrame([("b",)], key)
    )
    assert {tuple(r) for r in got.collect()} == {("b", "both converted and gated"), ("c", "neither converted nor gated"), ("x", "not enabled")}


def cover(make, *rows, config="cfg"):
    row = A.projection_coverage(make(*rows), config).first()
    return row.status, row.detail


def test_projections_that_cover_their_source(make):
    assert cover(make, projected(0), projected(1)) == ("PASS", "every index present and bound")


@pytest.mark.parametrize(
    "rows, word",
    [
        (lambda: [projected(0)], "missing"),
        (lambda: [projected(0), projected(0, path="x__n0")], "more than once"),
        (lambda: [projected(0), projected(1, original_target_index=2)], "out of range"),
        (lambda: [projected(0), projected(1, original_target_count=0)], "not positive"),
        (lambda: [projected(0), projected(1, 3)], "counts differ"),
        (lambda: [projected(0), projected(1, source_target_names=["N 0"])], "names"),
        (lambda: [projected(0), projected(1, source_target_slugs=["n0", ""])], "slugs"),
        (lambda: [projected(0), projected(1, source_target_hashes=None)], "hashes"),
        (lambda: [projected(0), projected(1, source_row_count=0)], "row count"),
        (lambda: [projected(0), projected(1, source_target_hash_algorithm="md5")], "algorithm"),
        (lambda: [projected(0), projected(1, original_target_name="N 0")], "name and index"),
        (lambda: [projected(0), projected(1, original_target_slug="n0")], "slug and index"),
        (lambda: [projected(0), projected(1, path="t__other")], "path and slug"),
        (lambda: [projected(0), projected(1, target_hash="h0")], "target hash"),
        (lambda: [projected(0), projected(1, n_samples=3)], "row counts differ"),
        (lambda: [projected(0), projected(1, samples_content_hash="x")], "one contract"),
        (lambda: [projected(0), projected(1, config_hash="old")], "config hash"),
        (lambda: [projected(0), profile("t__n1")], "block is missing"),
    ],
)
def test_projections_that_do_not(make, rows, word):
    status, detail = cover(make, *rows())
    assert status == "FAIL" and word in detail


def test_index_coverage(spark):
    df = spark.createDataFrame([("a", 0, 3), ("a", 2, 3), ("a", 2, 3), ("a", 7, 3), ("b", 0, 1)], "s STRING, i INT, n INT")
    assert {tuple(r) for r in A.index_coverage(df, "s", "i", "n").collect()} == {("a", 1, "missing"), ("a", 2, "duplicate"), ("a", 7, "unexpected")}


def test_index_coverage_of_odd_rows_sorts_them_once(spark, monkeypatch):
    rows = [("a", 0, 6), ("a", 1, 3), ("a", 4, 3), ("a", 4, 3), ("a", 9, 3), ("a", -1, 3), ("a", None, 3), (None, 1, 2), (None, 1, 2), ("c", 5, 0), ("d", 2, None), ("e", 7, 3), *(("f", i, 300) for i in range(299, 0, -2))]
    want = {(s, i, "missing") for s, n in (("a", 6), (None, 2), ("e", 3), ("f", 300)) for i in range(n) if not any(r[:2] == (s, i) for r in rows)}
    want |= {("a", 4, "duplicate"), ("a", 9, "unexpected"), ("a", -1, "unexpected"), ("a", None, "unexpected"), (None, 1, "duplicate"), ("c", 5, "unexpected"), ("d", 2, "unexpected"), ("e", 7, "unexpected")}
    sorts, real = [], type(spark.range(1)).repartitionByRange
    monkeypatch.setattr(type(spark.range(1)), "repartitionByRange", lambda self, *a: sorts.append(a) or real(self, *a))
    got = [tuple(r) for r in A.index_coverage(spark.createDataFrame(rows, "s STRING, i INT, n INT"), "s", "i", "n").collect()]
    assert len(got) == len(want) and set(got) == want
    assert len(sorts) == 1


def test_source_coverage(spark, make):
    sources = declared(spark, ("native", True), ("cut", True), ("mixed", True), ("absent", True), ("gated", False), ("stale", False))
    rows = make(
        profile("n", "native"), projected(0, source_key="cut"), projected(1, source_key="cut"),
        profile("m", "mixed"), projected(0, source_key="mixed"), profile("old", "stale"),
    )
    got = {r.source_key: (r.status, r.n_tables) for r in A.source_coverage(sources, rows).collect()}
    assert got == {
        "native": ("PASS", 1), "cut": ("PASS", 2), "mixed": ("FAIL", 2), "absent": ("FAIL", 0),
        "gated": ("BLOCKED_EXTERNAL", 0), "stale": ("BLOCKED_EXTERNAL", 1),
    }


def test_the_report_and_its_status(spark, make):
    sources = declared(spark, ("s1", True), ("gated", False))
    report = A.audit(checks(spark, "t"), make(profile("t")), sources)
    assert {r.status for r in report.filter("ordinal <= 6").collect()} == {"PASS"}
    assert A.overall_status(report).first() == ("INCOMPLETE", 8)
    assert {(r.status, r.n) for r in A.status_counts(report).collect()} == {("PASS", 7), ("BLOCKED_EXTERNAL", 1)}
    sound = A.audit(checks(spark, "t"), make(profile("t")), sources.filter("ready"))
    assert A.overall_status(sound).first().overall_status == "PASS"


@pytest.mark.parametrize("ready, status", [(True, "FAIL"), (False, "BLOCKED_EXTERNAL")])
def test_a_report_without_tables(spark, make, ready, status):
    report = A.audit(checks(spark, "t"), make(profile("t")).limit(0), declared(spark, ("s1", ready)))
    rows = report.collect()
    assert len(rows) == 7 and {r.status for r in rows} == {status}


def test_tables_of_undeclared_sources_do_not_count(spark, make):
    report = A.audit(checks(spark, "t", "u"), make(profile("t"), profile("u", "other", cipher="x")), declared(spark, ("s1", True)))
    assert A.overall_status(report).first().overall_status == "PASS"
    assert report.filter(F.col("requirement").contains("other")).count() == 0


def test_gaps_equal_brute_force(spark):
    import random

    rng = random.Random(4)
    counts = {s: n for s, n in (("a", 60), ("b", 1), ("c", 0), (None, 25), ("all", 5), ("big", 10**9))}
    rows = [(s, rng.randrange(-2, min(n, 60) + 3), n) for s, n in counts.items() for _ in range(25)] + [("all", i, 5) for i in range(5)] + [("a", None, 60)]
    got = {tuple(r) for r in A.index_gaps(spark.createDataFrame(rows, "s STRING, i INT, n INT"), "s", "i", "n").collect()}
    want = set()
    for s, n in counts.items():
        seen = sorted({i for t, i, _ in rows if t == s and i is not None and 0 <= i < n})
        edges = [-1, *seen, n]
        want |= {(s, a + 1, b - 1) for a, b in zip(edges[:-1], edges[1:], strict=True) if b - a > 1}
    assert got == want
