"""Datasets written side by side, then validated and audited from their files."""

import json

import pytest
from pyspark.sql import functions as F

from seqframe.model import Alphabet, Dataset, Options
from seqframe.plans import audit as A
from seqframe.plans import folder as O
from seqframe.plans import validate as V
from seqframe.plans.convert import convert, run_inventory, write_dataset, write_projected
from tests.test_convert import ROWS, dataset

TWO = [("a", "ACGTAC", [0, 1]), ('q"u,o', "GGG", [1, 0]), ("line\nbreak", "TTTTTTTTTT", [1, 1]), (" sp ", "AC", [0, 0])]
DECLARED = "source_key STRING, ready BOOLEAN, source STRING, source_url STRING, licence STRING, target_description STRING"


@pytest.fixture
def root(spark, tmp_path):
    """A native dataset and both targets of another."""
    full = {"config_hash": "cfg", "extra": {"profile": "full"}}
    write_dataset(convert(dataset(spark, ROWS), Options(width=6)), str(tmp_path / "one_full"), **full)
    many = dataset(spark, TWO, n_targets=2, names=("First!", "Second"))
    many = Dataset(df=many.df, name="many", alphabet=Alphabet.DNA_NUCLEOTIDE, semantics=many.semantics, n_targets=2, target_names=many.target_names)
    write_projected(convert(many, Options(width=8)), str(tmp_path / "many_full"), **full)
    return tmp_path


def failed(spark, root):
    return {(r.path.rsplit(f"{root.name}/", 1)[-1], r.name) for r in O.validate_folder(spark, str(root)).filter("not passed").collect()}


def audited(spark, root, *keys, **more):
    declared = spark.createDataFrame([(k, True, k, "", "", "") for k in keys or ("t", "many")], DECLARED)
    declared = declared.withColumn("source", F.when(F.col("source_key") == "t", "t").otherwise(F.col("source")))
    return O.audit_folder(spark, str(root), declared, profile="full", config_hash="cfg", **more)


def edit(folder, change):
    """Rewrite the lines of CSV part files in place."""
    for part in folder.rglob("part-*.csv"):
        part.write_text("".join(change(line) for line in part.read_text().splitlines(keepends=True)))
    for crc in folder.rglob(".*.crc"):
        crc.unlink()


def test_a_sound_folder_passes(spark, root):
    assert failed(spark, root) == set()
    counts = {r.path.rsplit("/", 1)[-1]: r["count"] for r in O.validate_folder(spark, str(root)).groupBy("path").count().collect()}
    assert counts == {"one_full": 26, "slug=first": 26, "slug=second": 26}
    for name in ("one_full", "many_full/slug=first", "many_full/slug=second"):
        assert not V.validate_dataset(spark, f"{root}/{name}").filter("not passed").collect()
    assert {(r.status, r.detail) for r in A.projection_coverage(O.folder_facts(spark, str(root))[2].filter("projection is not null"), "cfg").collect()} == {("PASS", "every index present and bound")}


def test_the_audit_reads_what_was_written(spark, root):
    paths = [f"{root}/{n}" for n in ("one_full", "many_full/slug=first", "many_full/slug=second")]
    record = dict(complete=True, profile="full", target_layout="single", config_hash="cfg", enabled=["t", "many"], converted=["t", "many"], gated=[])
    run, children = run_inventory(spark, paths, **record)
    assert sorted(r.path for r in children.collect()) == sorted(paths)
    more = {"run": run, "children": children, "enabled": ["t", "many"]}
    report = audited(spark, root, **more)
    assert {r.status for r in report.collect()} == {"PASS"} and report.count() == 9
    assert A.overall_status(report).first().overall_status == "PASS"
    # A swapped pair of cells is seen by the inventory and by the table's own requirement, and by nothing else.
    edit(root / "one_full" / "table", lambda line: line.replace("001,0,1,3,", "001,0,3,1,"))
    bad = {r.ordinal: r.detail for r in audited(spark, root, **more).filter("status = 'FAIL'").collect()}
    assert set(bad) == {0, 1} and "hash_differs" in bad[0]
    assert failed(spark, root) == {("one_full", n) for n in ("content_hash_matches_the_table_on_disk", "sampled_rows_decode_back_to_their_source_sequence")}


def test_a_changed_target_breaks_the_projection(spark, root):
    edit(root / "many_full" / "table" / "slug=second", lambda line: line.replace("a,1,", "a,0,", 1) if line.startswith("a,") else line)
    report = {r.requirement: (r.status, r.detail) for r in audited(spark, root).collect()}
    assert report["source coverage: many"] == ("FAIL", "target hash differs") and report["source coverage: t"][0] == "PASS"


@pytest.mark.parametrize(
    "change, names",
    [
        (lambda line: line.replace("position_2", "position_9"), {"sidecar_present_and_matches_header"}),
        (lambda line: line.replace("s2,1,", "s2,x,"), {"all_target_columns_integer", "label_dependent_checks_skipped", "content_hash_matches_the_table_on_disk"}),
        (lambda line: line.replace("s2,1,1,", "s2,1,99,"), {"tokens_within_configured_range", "remaining_checks_skipped"}),
        (lambda line: "" if line.startswith("s2") else line, {"sidecar_counts_match_manifest", "samples_sidecar_sample_ids_match_table_order", "content_hash_matches_the_table_on_disk", "sampled_rows_decode_back_to_their_source_sequence"}),
        (lambda line: line.replace("s2,", "s3,"), {"primary_key_unique", "samples_sidecar_sample_ids_match_table_order", "content_hash_matches_the_table_on_disk", "sampled_rows_decode_back_to_their_source_sequence"}),
    ],
)
def test_damage_to_a_table(spark, root, change, names):
    edit(root / "one_full" / "table", change)
    assert failed(spark, root) == {("one_full", n) for n in names}


def test_damage_to_width_names_the_rows(spark, root):
    edit(root / "one_full" / "table", lambda line: line.rstrip("\n") + ",4\n" if line.startswith("s2") else line.rstrip("\n").rsplit(",", 1)[0] + "\n" if line.startswith("s4") else line)
    assert {(r.sample_id, r.width, r.declared) for r in O.damaged_rows(spark, str(root)).collect()} == {("s2", 7, 6), ("s4", 5, 6)}
    assert {("one_full", "loads"), ("one_full", "every_row_has_the_same_width")} <= failed(spark, root)


def test_damage_to_a_sidecar(spark, root):
    edit(root / "one_full" / "samples", lambda line: line.replace("s3,", "s2,", 1))
    names = {n for _, n in failed(spark, root)}
    assert names == {
        "samples_sidecar_content_hash_matches", "samples_sidecar_sample_ids_unique", "samples_sidecar_sample_ids_match_table_order",
        "sampled_rows_decode_back_to_their_source_sequence",
    }


def test_manifests_that_are_none_of_ours(spark, root):
    for name, text in (("torn", "{"), ("other", json.dumps({"format": "x"})), ("blank", "")):
        (root / name / "manifest").mkdir(parents=True)
        (root / name / "manifest" / "part-0.txt").write_text(text)
    assert failed(spark, root) == {("torn", "loads"), ("other", "loads")}
    assert {r.status for r in audited(spark, root).collect()} == {"PASS"}


def test_a_manifest_without_a_table(spark, root):
    (root / "bare" / "manifest").mkdir(parents=True)
    text = next((root / "one_full" / "manifest").glob("part-*")).read_text()
    (root / "bare" / "manifest" / "part-0.txt").write_text(text)
    assert ("bare", "loads") in failed(spark, root)
    assert {r.ordinal for r in audited(spark, root).filter("status = 'FAIL'").collect()} >= {1, 2}


def test_an_empty_folder(spark, tmp_path):
    report = audited(spark, tmp_path, "t").collect()
    assert len(report) == 7 and {r.status for r in report} == {"FAIL"}
    assert O.validate_folder(spark, str(tmp_path)).collect() == []


def test_projecting_needs_several_named_targets(spark, tmp_path):
    with pytest.raises(ValueError):
        write_projected(convert(dataset(spark, ROWS), Options(width=4)), str(tmp_path / "x"))
