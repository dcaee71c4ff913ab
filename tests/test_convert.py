import json

import pytest
from pyspark.sql import functions as F

from seqframe.model import Alphabet, Dataset, LengthPolicy, Options
from seqframe.operators import linking as K
from seqframe.operators import quality as Q
from seqframe.operators.projection import select_target
from seqframe.plans import validate as V
from seqframe.plans.convert import convert, run_inventory, write_dataset, write_run_inventory
from seqframe.plans.projection import project_targets, projection_contract, source_contract
from seqframe.sources import tables as W


def dataset(spark, rows, n_targets=1, names=(), **kw):
    df = spark.createDataFrame(
        [(i, k, s, y) for i, (k, s, y) in enumerate(rows)],
        "ord BIGINT, sample_id STRING, sequence STRING, label ARRAY<INT>",
    ).select("*", F.lit("t").alias("source"), F.struct((F.col("ord") * 2).alias("twice"), F.lit('q"u,o').alias("note")).alias("metadata"))
    semantics = spark.createDataFrame([(0, "no"), (1, "yes")], "value INT, meaning STRING")
    return Dataset(df=df, name="t", alphabet=Alphabet.DNA_NUCLEOTIDE, semantics=semantics, n_targets=n_targets, target_names=names, **kw)


ROWS = [("001", "ACGT", [0]), ("s2", "ACGTAC", [1]), ("s3", "TTTT", [0]), ("s4", "GGGGCC", [1])]


def test_one_row_from_text_to_tokens(spark):
    c = convert(dataset(spark, [("s", "acgt nnrt\n", [1])]), Options(width=12))
    assert c.table.first().tokens == [1, 3, 7, 20, 14, 14, 18, 20, 0, 0, 0, 0]
    s = c.samples.first()
    assert (s.original_length, s.window_start, s.window_end, s.residues_in_row, s.padding_cells, s.twice) == (8, 1, 8, 8, 4, 0)


def test_quarantine_comes_before_the_label_is_looked_at(spark):
    c = convert(dataset(spark, [("bad", "AC1", None), ("ok", "AC", [1])]), Options(width=4))
    assert [r.sample_id for r in c.table.collect()] == ["ok"]
    assert [r.sample_id for r in c.quarantine.collect()] == ["bad"]


@pytest.mark.parametrize("label", [None, [], [0, 1]])
def test_a_missing_or_wrong_label_is_an_error(spark, label):
    with pytest.raises(Exception, match="label"):
        convert(dataset(spark, [("ok", "AC", label)]), Options(width=4)).table.collect()


def test_windows_of_one_parent_stay_together_and_totals_add_up(spark):
    opts = Options(width=8, policy=LengthPolicy.WINDOW, stride=8, max_windows_per_sample=3)
    c = convert(dataset(spark, [("a", "ACGT" * 20, [0]), ("b", "ACG", [1])]), opts)
    t = c.totals.first()
    assert (t.n_rows, t.windows_dropped, t.residues_dropped_by_window_cap) == (4, 7, 56)
    split = c.samples.select("parent_sample_id", F.when(F.col("parent_sample_id") == "a", 0).otherwise(1).alias("side"))
    assert K.group_straddle(split, "parent_sample_id", "side").count() == 0


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
@pytest.mark.parametrize("policy", list(LengthPolicy))
def test_a_written_dataset_reads_back_and_validates(spark, tmp_path, fmt, policy):
    path = str(tmp_path / "d")
    opts = Options(width=5, policy=policy, stride=3)
    payload = write_dataset(convert(dataset(spark, [*ROWS, ("bad", "A1", [0])]), opts), path, fmt=fmt)
    checks = V.validate_dataset(spark, path).orderBy("ordinal").collect()
    assert [c.name for c in checks if not c.passed] == [] and len(checks) == 26
    m = payload["manifest"]
    assert m["cleaning"]["quarantined"] == 1 and m["cleaning"]["seen"] == 5
    table, samples, _, _ = W.read_dataset(spark, path)
    ids = [r.sample_id for r in table.orderBy("ord").collect()]
    assert ids[0].startswith("001") and ids == [r.sample_id for r in samples.orderBy("ord").collect()]
    assert samples.orderBy("ord").first().note == 'q"u,o'
    if fmt == "csv":
        assert [tuple(r) for r in W.dataset_shape(spark, path).collect()] == [(7, m["n_samples"])]
        assert W.read_key_as_text(spark, path, "target").columns == ["sample_id", "target"]


def test_two_runs_write_the_same_table(spark, tmp_path):
    a = write_dataset(convert(dataset(spark, ROWS), Options(width=5)), str(tmp_path / "a"))
    shuffled = dataset(spark, ROWS)
    again = Dataset(**{**shuffled.__dict__, "df": shuffled.df.repartition(3)})
    b = write_dataset(convert(again, Options(width=5)), str(tmp_path / "b"))
    for key in ("content_hash", "samples_content_hash"):
        assert a["manifest"][key] == b["manifest"][key]
    cols = ["sample_id", "target", "tokens"]
    ta, tb = (W.read_dataset(spark, str(tmp_path / n))[0] for n in "ab")
    assert V.Q.compare_runs(ta, tb, ["ord"], cols).first().passed
    changed = tb.withColumn("target", F.when(F.col("sample_id") == "s3", F.array(F.lit(1))).otherwise(F.col("target")))
    assert not Q.compare_runs(ta, changed, ["ord"], cols).first().passed
    assert {(r.sample_id, r.in_first, r.in_second) for r in Q.run_differences(ta, changed, cols).collect()} == {("s3", 1, 0), ("s3", 0, 1)}
    swapped = tb.withColumn("ord", F.lit(3) - F.col("ord"))
    assert not Q.compare_runs(ta, swapped, ["ord"], cols).first().passed


@pytest.mark.parametrize(
    "rows, match",
    [
        ([], "no rows"),
        ([("a", "AC", [0]), ("a", "GG", [1])], "more than once"),
        ([("a", "AC", [7])], "undocumented"),
        ([("a", "AC", [None])], "null_targets"),
    ],
)
def test_a_bad_table_is_not_written(spark, tmp_path, rows, match):
    path = tmp_path / "d"
    with pytest.raises(ValueError, match=match):
        write_dataset(convert(dataset(spark, rows), Options(width=4)), str(path))
    with pytest.raises(W.NotADatasetError):
        W.read_dataset(spark, str(path))


@pytest.mark.parametrize("kind", ["array<double>", "array<boolean>", "array<string>"])
def test_targets_must_be_exact_integers(spark, kind):
    df = convert(dataset(spark, ROWS), Options(width=4)).table.withColumn("target", F.array(F.lit(1).cast(kind[6:-1])))
    with pytest.raises(TypeError, match="integers"):
        W.refuse_bad_table(df, 4, 1, None)


def test_foreign_future_and_mismatched_manifests_are_refused(spark, tmp_path):
    path = str(tmp_path / "d")
    payload = write_dataset(convert(dataset(spark, ROWS), Options(width=4)), path)

    def rewrite(**changes):
        W.write_manifest(spark, json.loads(json.dumps(payload)) | changes, f"{path}/manifest", mode="overwrite")

    rewrite(format="other")
    with pytest.raises(W.NotADatasetError, match="other"):
        W.read_dataset(spark, path)
    rewrite(version=2)
    with pytest.raises(ValueError, match="version"):
        W.read_dataset(spark, path)
    rewrite(columns=payload["columns"] | {"feature_columns": ["position_1"]})
    with pytest.raises(ValueError, match="header"):
        W.read_dataset(spark, path)


def test_per_target_tables(spark, tmp_path):
    rows = [("a", "ACGT", [0, 1, 1]), ("b", "GG", [1, 0, 1])]
    ds = dataset(spark, rows, n_targets=3, names=("Alpha One", "beta", "g!"))
    long = project_targets(ds)
    assert {(r.slug, r.sample_id, r.target) for r in long.collect()} == {
        ("alpha_one", "a", 0), ("alpha_one", "b", 1), ("beta", "a", 1), ("beta", "b", 0), ("g", "a", 1), ("g", "b", 1)
    }
    contract = projection_contract(long)
    one = source_contract(contract).first()
    assert one.slugs == ["alpha_one", "beta", "g"] and one.row_count == 2 and len(set(one.hashes)) == 3
    W.write_per_target(convert(ds, Options(width=4)).table, ds.target_names, str(tmp_path / "p"), 4)
    back = spark.read.parquet(str(tmp_path / "p" / "slug=beta"))
    assert back.columns == ["sample_id", "target", "position_1", "position_2", "position_3", "position_4"]
    assert {(r.sample_id, r.target) for r in back.collect()} == {("a", 1), ("b", 0)}


@pytest.mark.parametrize("names", [("a", "A "), ("a", "!!"), ("a",)])
def test_unusable_target_names_are_refused(spark, names):
    with pytest.raises(ValueError):
        project_targets(dataset(spark, [("a", "AC", [0, 1])], n_targets=2, names=names))


def test_a_target_digest_binds_keys_values_and_order(spark):
    def digests(rows):
        ds = dataset(spark, rows, n_targets=2, names=("x", "y"))
        return {r.target_index: r.content_digest for r in projection_contract(project_targets(ds)).collect()}

    base = digests([("a", "A", [0, 1]), ("b", "A", [1, 1])])
    assert digests([("b", "A", [1, 1]), ("a", "A", [0, 1])])[1] != base[1]
    changed = digests([("a", "A", [0, 1]), ("b", "A", [1, 0])])
    assert changed[0] == base[0] and changed[1] != base[1]


def test_one_target_of_many(spark):
    ds = dataset(spark, [("a", "AC", [0, 1])], n_targets=2)
    assert select_target(ds.df, 1).first().label == [1]


def test_checks_are_kept_as_a_table_and_as_json(spark, tmp_path):
    c = convert(dataset(spark, ROWS), Options(width=4))
    W.write_checks(V.validate_table(c.table, c.samples, c.profile, c.dataset.semantics), str(tmp_path / "c"))
    assert spark.read.parquet(str(tmp_path / "c" / "table")).count() == 26
    assert spark.read.json(str(tmp_path / "c" / "json")).filter("passed").count() == 26


def test_a_csv_row_of_another_width_is_seen(spark, tmp_path):
    path = str(tmp_path / "d")
    write_dataset(convert(dataset(spark, ROWS), Options(width=4)), path)
    (tmp_path / "d" / "table" / "zz.csv").write_text('sample_id,target,position_1,position_2,position_3,position_4\n\n"a,b",1,2,3\n')
    assert {tuple(r) for r in W.dataset_shape(spark, path).collect()} == {(6, 4), (4, 1)}
    checks = {c.name: c.passed for c in V.validate_dataset(spark, path).collect()}
    assert not checks["all_position_columns_integer"] and not checks["sidecar_counts_match_manifest"]


def test_run_inventory(spark, tmp_path):
    path = str(tmp_path / "d")
    payload = write_dataset(convert(dataset(spark, ROWS), Options(width=4)), path)
    run, children = run_inventory(
        spark, [path], complete=True, profile="full", target_layout="single", config_hash="c", enabled=["t"], converted=["t"], gated=[]
    )
    write_run_inventory(run, children, str(tmp_path / "run"))
    back = spark.read.json(str(tmp_path / "run" / "generated_tables")).first()
    assert (back.path, back.content_hash) == (path, payload["manifest"]["content_hash"])
    assert spark.read.json(str(tmp_path / "run" / "run")).first().complete


def test_a_damaged_row_fails_the_load(spark, tmp_path):
    """A cell too many in one row of the table on disk."""
    rows = [(k, f"s{k}", "ACGT" * (k + 1), [k % 2], "t", ("x",)) for k in range(6)]
    df = spark.createDataFrame(
        rows, "ord BIGINT, sample_id STRING, sequence STRING, label ARRAY<INT>, source STRING, metadata STRUCT<note: STRING>"
    )
    semantics = spark.createDataFrame([(0, "no"), (1, "yes")], "value INT, meaning STRING")
    path = str(tmp_path / "d")
    write_dataset(convert(Dataset(df=df, name="d", alphabet=Alphabet.DNA_NUCLEOTIDE, semantics=semantics), Options(width=8)), path)
    assert not V.validate_dataset(spark, path).filter("not passed").collect()
    for part in (tmp_path / "d" / "table").glob("part-*.csv"):
        lines = part.read_text().splitlines()
        part.write_text("\n".join(line + ",5" if line.startswith("s3,") else line for line in lines) + "\n")
    for crc in (tmp_path / "d" / "table").glob(".*.crc"):
        crc.unlink()
    failed = {r.name for r in V.validate_dataset(spark, path).filter("not passed").collect()}
    assert {"loads", "every_row_has_the_same_width", "content_hash_matches_the_table_on_disk"} <= failed
