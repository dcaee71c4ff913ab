"""A stage of the pipeline leaves no intermediate table to those that follow."""

from pathlib import Path

import pytest

import corpus_pipeline
from seqframe.session import leaving_result, shared_dir, written
from tests.llm.conftest import prose


def tables(spark):
    return set(Path(shared_dir(spark).removeprefix("file:")).glob("seqframe-*"))


def test_a_stage_leaves_only_what_its_result_reads(spark, docs, tmp_path):
    shared = prose(1, 80)
    table = docs(*((k, f"{prose(20 + k, 70)} {shared} {prose(60 + k, 70)}", "en", "web") for k in range(9)))
    spark.createDataFrame([(1, prose(99, 30))], "item_id BIGINT, text STRING").write.parquet(str(tmp_path / "benchmark.parquet"))
    for name, stage in corpus_pipeline.STAGES:
        before = tables(spark)
        out = stage(spark, table, str(tmp_path))
        left = tables(spark) - before
        assert all(any(p.name in f for f in out.inputFiles()) for p in left), name
        n = out.count()
        assert n == 9 or name == "mixing", name


def test_results_are_handed_on_and_failures_leave_their_tables(spark):
    made = []

    def inner():
        made.extend(written(spark.range(k)) for k in (2, 3))
        return made[1]

    before = tables(spark)
    out = leaving_result(spark, lambda: leaving_result(spark, inner).filter("id > 0"))
    assert out.count() == 2 and len(tables(spark) - before) == 1
    # The table that the inner one handed on goes with the outer one, whose result does not read it.
    leaving_result(spark, lambda: leaving_result(spark, inner) and spark.range(1))
    assert len(tables(spark) - before) == 1

    def failing():
        written(spark.range(1))
        raise ValueError

    with pytest.raises(ValueError):
        leaving_result(spark, failing)
    assert len(tables(spark) - before) == 2
