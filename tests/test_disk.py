"""What a job needs on disk goes with it, and what it writes is small."""

import time

import pytest
from pyspark.sql import functions as F

from seqframe import session
from seqframe.model import Alphabet, Dataset, Options
from seqframe.plans import folder as O
from seqframe.plans import validate as V
from seqframe.plans.convert import convert, write_dataset, write_projected
from seqframe.sources import tables as W


@pytest.fixture
def shared(tmp_path, monkeypatch):
    from seqframe.operators import ranking
    from seqframe.plans import convert as made

    at = tmp_path / "shared"
    at.mkdir()
    monkeypatch.setattr(session, "shared_dir", lambda spark: str(at))
    assert ranking.written is made.written is session.written
    return at


def dataset(spark, targets=1, n=3000):
    rows = spark.range(n).select(
        F.col("id").alias("ord"), F.concat(F.lit("k,"), F.col("id").cast("string")).alias("sample_id"),
        F.left(F.translate(F.sha2(F.col("id").cast("string"), 256), "0123456789abcdef", "ACGTACGTACGTACGT"), (F.col("id") % 64 + 1).cast("int")).alias("sequence"),
        F.array(*[(F.col("id") % (i + 2) % 2).cast("int") for i in range(targets)]).alias("label"), F.lit("s").alias("source"),
    )
    semantics = spark.createDataFrame([(0, "odd"), (1, "even")], "value INT, meaning STRING")
    return Dataset(df=rows, name="d", alphabet=Alphabet.DNA_NUCLEOTIDE, semantics=semantics, n_targets=targets, target_names=tuple(f"t{i}" for i in range(targets)) if targets > 1 else ())


def test_a_written_dataset_leaves_no_intermediate_rows(spark, shared, tmp_path):
    write_dataset(convert(dataset(spark), Options(width=64)), f"{tmp_path}/a")
    assert not list(shared.iterdir())
    manifests = write_projected(convert(dataset(spark, 2), Options(width=64)), f"{tmp_path}/b")
    assert len(list(shared.iterdir())) == 1 and manifests.count() == 2
    made = convert(dataset(spark), Options(width=64)).cleaned_once()  # who made the rows keeps them
    write_dataset(made, f"{tmp_path}/c")
    assert made.table.count() == 3000


def test_facts_of_a_folder_leave_no_rows(spark, shared, tmp_path):
    write_dataset(convert(dataset(spark), Options(width=64)), f"{tmp_path}/root/a")
    checks = O.validate_folder(spark, f"{tmp_path}/root")
    left = [spark.read.parquet(str(p)) for p in shared.iterdir()]
    assert left and all(df.count() < 100 for df in left)
    assert not checks.filter("not passed").collect()


def test_rows_that_wait_for_their_digests_hold_none(spark):
    table = spark.createDataFrame(
        [(0, "a", [1], [1, 3, 0]), (1, None, [0], [1, 0, 3]), (2, "c", None, [27, 1, 0]), (3, "d", [1, None], [1, None, 300]), (4, "e", [1], None)],
        "ord BIGINT, sample_id STRING, target ARRAY<INT>, tokens ARRAY<INT>",
    )
    rows = V.condensed(table)
    assert "binary" not in dict(rows.dtypes).values()
    assert "sha2" not in rows._jdf.queryExecution().optimizedPlan().toString().lower()
    once, lazy = V.measured_once(table).collect(), V.measured(table).collect()
    assert sorted(map(str, once)) == sorted(map(str, lazy))


def test_shuffle_files_go_when_their_job_ends(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    n_files = lambda: disk.getAllFiles().size()
    before = n_files()
    session.written(spark.range(10_000).repartition(7, "id"))
    until = time.time() + 10
    while n_files() > before and time.time() < until:
        time.sleep(0.2)
    assert n_files() <= before
    assert spark.conf.get(session.SHUFFLES_GO) == "false"


def test_a_compressed_dataset_reads_as_the_plain_one(spark, tmp_path):
    made = convert(dataset(spark), Options(width=64)).cleaned_once()
    size = {}
    for name, codec in (("plain", None), ("packed", "gzip")):
        path = f"{tmp_path}/root/{name}"
        manifest = write_dataset(made, path, compression=codec)["manifest"]
        size[name] = sum(p.stat().st_size for part in ("table", "samples") for p in (tmp_path / "root" / name / part).iterdir())
        size[f"{name} hash"] = manifest["content_hash"], manifest["samples_content_hash"]
        assert not V.validate_dataset(spark, path).filter("not passed").collect()
    assert size["plain hash"] == size["packed hash"] and size["packed"] < size["plain"] / 2
    assert not O.validate_folder(spark, f"{tmp_path}/root").filter("not passed").collect()
    assert W.dataset_shape(spark, f"{tmp_path}/root/packed").collect() == W.dataset_shape(spark, f"{tmp_path}/root/plain").collect()


def test_files_that_one_task_reads_are_bounded(spark):
    df = spark.range(10)
    assert W.file_count(df, 10 * W.WHOLE_CELLS // 64, 64) >= 10 > W.file_count(df, 10 * W.WHOLE_CELLS // 64)


def test_damaged_folders_hold_datasets_and_nothing_else(spark, shared, monkeypatch):
    from workload import queries
    from workload.inputs import Inputs

    monkeypatch.setattr(queries, "shared_dir", session.shared_dir)
    root = queries.damaged_folder(Inputs(spark, "/root/testdata/sf0.001"))
    assert [str(p) for p in shared.iterdir()] == [root]
    for part in ("good/table", "good/samples", "bad/table"):
        files = [p for p in shared.glob(f"*/{part}/part-*") if p.stat().st_size]
        assert files and all(p.suffix == ".gz" for p in files)


def test_dataset_files_keep_the_rows_of_their_checks_alone(spark, shared, monkeypatch):
    from workload import queries
    from workload.inputs import Inputs

    monkeypatch.setattr(queries, "shared_dir", session.shared_dir)
    checks = queries.dataset_files(Inputs(spark, "/root/testdata/sf0.001"))
    tables = [spark.read.parquet(str(p)) for p in shared.iterdir() if not (p / "table").exists()]
    assert len([t for t in tables if t.count() > 100]) == 1
    assert not [t for t in tables if "tokens" in t.columns or "slice" in t.columns]
    assert all(p.suffix == ".gz" for p in shared.glob("*/table/part-*"))
    assert checks.filter("passed").count() == checks.count()
