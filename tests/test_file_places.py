"""Paths are taken apart once per file block, whatever the number of rows."""

from pyspark.sql import functions as F

from seqframe.plans import folder as O
from seqframe.sources import readers as S


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_rows_of_files_carry_no_path_work(spark, tmp_path):
    for i, v in ((10, "c"), (2, "b"), (1, "a")):
        (tmp_path / f"part-{i}").write_text(f"{v}0\n{v}1\n")
    df = S.with_file_ordinal(spark.read.text(str(tmp_path)).select(S.file_position().alias("_at"), "value"))
    assert "regexp" not in plan(df)
    assert [r.value for r in df.orderBy("ord").collect()] == ["a0", "a1", "b0", "b1", "c0", "c1"]


def test_lines_below_a_folder_carry_no_path_work(spark, tmp_path):
    for name, i, v in (("one", 10, "c"), ("one", 2, "b"), ("a b%", 1, "a")):
        (tmp_path / name / "table").mkdir(parents=True, exist_ok=True)
        (tmp_path / name / "table" / f"part-{i}").write_text(f"h\n{v}0\n{v}1\n")
    df = O.placed_lines(spark, str(tmp_path), "table")
    assert "regexp" not in plan(df) and "decode" not in plan(df)
    got = {(r.path.rpartition("/")[2], r.ord, r.value) for r in df.filter(~F.col("header")).collect()}
    assert got == {("a b%", 0, "a0"), ("a b%", 1, "a1"), ("one", 0, "b0"), ("one", 1, "b1"), ("one", 2, "c0"), ("one", 3, "c1")}


def test_evidence_documents_in_lines_keep_their_calls_apart(spark, tmp_path):
    for f in range(2):
        lines = [
            f'{{"features": [{{"id": "1", "name": "{f}{i}", "sequence": "A"}}], '
            f'"detections": [{{"alterations": [{{"derivedFeature": "1", "engineered": "x#c{f}{i}"}}]}}]}}'
            for i in range(20)
        ]
        (tmp_path / f"part-{f}.json").write_text("\n".join(lines) + "\n")
    docs = S.read_evidence_json(spark, str(tmp_path), multi_line=False)
    both = S.evidence_features(docs).join(S.evidence_calls(docs), ["file", "id"]).select("name", "call").collect()
    assert sorted((r.name, r.call) for r in both) == sorted((f"{f}{i}", f"c{f}{i}") for f in range(2) for i in range(20))


def test_evidence_queries_write_few_files(spark, tmp_path, monkeypatch):
    from workload import queries
    from workload.inputs import Inputs

    monkeypatch.setattr(queries, "folder", lambda x: str(tmp_path / "evidence"))
    docs = queries.evidence_documents(Inputs(spark, "/root/testdata/sf0.001"))
    assert docs.count() == 200
    assert len(list((tmp_path / "evidence").glob("part-*"))) < 20


def test_digests_are_written_as_bytes(spark, tmp_path):
    from seqframe.functions import digests as D
    from seqframe.plans import validate as V

    rows = spark.range(500).select(F.sha2(F.col("id").cast("string"), 256).alias("d"))
    both = rows.select("d", D.packed(F.col("d")).alias("p")).agg(
        D.combined_digest("d").alias("text"), D.combined_digest("p", True).alias("bytes"), F.count_if(D.unpacked("p") != F.col("d")).alias("n")
    ).first()
    lanes = [sum(int(r.d[6 * i : 6 * i + 6], 16) for r in rows.collect()) for i in range(10)]
    want = spark.range(1).select(F.sha2(F.lit(",".join(map(str, [500, *lanes]))), 256).alias("h")).first().h
    assert both.text == both.bytes == want and both.n == 0

    table = spark.createDataFrame([(0, "a", [1], [1, 0])], "ord BIGINT, sample_id STRING, target ARRAY<INT>, tokens ARRAY<INT>")
    kinds = dict(V.measured(table).dtypes)
    assert {kinds[c] for c in ("sequence_digest", "_content", "_order", "_slice", "_target")} == {"binary"}


def test_a_conversion_is_cleaned_once(spark, records):
    from seqframe.model import Alphabet, Dataset, Options
    from seqframe.plans.convert import convert

    rows = records(("a", "ACGT")).select("*", F.array(F.lit(1)).alias("label"), F.lit("s").alias("source"))
    semantics = spark.createDataFrame([(1, "one")], "value INT, meaning STRING")
    made = convert(Dataset(df=rows, name="d", alphabet=Alphabet.DNA_NUCLEOTIDE, semantics=semantics), Options(width=8)).cleaned_once()
    assert made.cleaned_once() is made


def test_converted_rows_are_written_small(spark, records, tmp_path, monkeypatch):
    from seqframe import session
    from seqframe.model import Alphabet, Dataset, Options
    from seqframe.plans.convert import convert

    monkeypatch.setattr(session, "shared_dir", lambda spark: str(tmp_path))
    rows = records(("a", "ACGT")).select("*", F.array(F.lit(1)).alias("label"), F.lit("s").alias("source"))
    convert(Dataset(df=rows, name="d", alphabet=Alphabet.DNA_NUCLEOTIDE, semantics=None), Options(width=8)).cleaned_once()
    files = list(tmp_path.glob("seqframe-*/part-*"))
    assert files and all(".zstd." in f.name or ".zst." in f.name for f in files)


def test_ranks_do_not_bring_a_group_together(spark):
    from seqframe.operators import ranking as R

    rows = spark.range(1000).select((F.col("id") % 3).alias("g"), F.col("id").alias("o"))
    ranked = R.rank_in_group(rows, ["g"], ["o"])
    text = ranked._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(g" not in text and "SortMergeJoin" not in text and "ShuffledHashJoin" not in text
    assert {(r.g, r.o, r["rank"]) for r in ranked.collect()} == {(i % 3, i, i // 3) for i in range(1000)}
