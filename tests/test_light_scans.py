"""Scans that need few cells of a row take no others apart, and a piece costs its own width."""

from pyspark.sql import functions as F

from seqframe.model import Alphabet, Dataset, Options
from seqframe.plans import folder as O
from seqframe.plans.convert import convert, write_dataset
from seqframe.sources import tables as W
from workload.inputs import Inputs


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def scans(df):
    return df._jdf.queryExecution().executedPlan().toString().count("FileScan csv")


def dataset(spark, path, keys=("a", "b,\n", 'c"')):
    rows = spark.createDataFrame([(i, k, "ACGT"[: i + 1], [i % 2], "s") for i, k in enumerate(keys)], "ord BIGINT, sample_id STRING, sequence STRING, label ARRAY<INT>, source STRING")
    semantics = spark.createDataFrame([(0, "odd"), (1, "even")], "value INT, meaning STRING")
    write_dataset(convert(Dataset(df=rows, name="d", alphabet=Alphabet.DNA_NUCLEOTIDE, semantics=semantics), Options(width=4)), path)
    return path


def test_pieces_are_cut_from_bytes(spark, tmp_path):
    texts = {1: "ac gt" * 200, 2: None, 3: "12 34", 4: "", 5: "A" * 64, 6: "é" * 70 + "b" * 65}
    spark.createDataFrame([(i, t, "en", "web", 0) for i, t in texts.items()], "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG").write.parquet(f"{tmp_path}/documents.parquet")
    pieces = Inputs(spark, str(tmp_path)).pieces
    assert "as binary" in plan(pieces)
    table = str.maketrans("BDEFHIJKLMOPQRSUVWXYZ", "CTAGCTAGCTAGCTNRYSWKM")
    want = set()
    for i, t in texts.items():
        b = None if t is None else "".join(c for c in t if c.isascii() and c.isalpha()).upper().translate(table)
        want |= {(i * 10**6 + k, None if b is None else b[64 * k : 64 * k + 64]) for k in range(max(1, -(-len(b or "") // 64)))}
    assert {(r.ord, r.b) for r in pieces.collect()} == want


def test_keys_are_read_in_one_pruned_scan(spark, tmp_path):
    df = W.read_key_as_text(spark, dataset(spark, f"{tmp_path}/d"), "target")
    assert scans(df) == 1 and "Join" not in plan(df) and "pos_" not in df._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, df.collect())) == [("a", "0"), ("b,\n", "1"), ('c"', "0")]


def test_rows_are_placed_from_a_scan_that_parses_none(spark, tmp_path, monkeypatch):
    seen = []
    real = W.with_file_ordinal
    monkeypatch.setattr(W, "with_file_ordinal", lambda df, **more: seen.append(more.get("places")) or real(df, **more))
    _, wide = W.read_wide(spark, dataset(spark, f"{tmp_path}/d"))
    assert seen[0] is not None and "ReadSchema: struct<>" in seen[0]._jdf.queryExecution().executedPlan().toString()
    assert [(r.ord, r.sample_id) for r in wide.orderBy("ord").collect()] == [(0, "a"), (1, "b,\n"), (2, 'c"')]


def test_damaged_rows_are_told_by_their_commas(spark, tmp_path):
    dataset(spark, f"{tmp_path}/d")
    table = f"{tmp_path}/d/table"
    lines = spark.read.text(table).filter("value not like 'sample_id%'").select(F.when(F.startswith("value", F.lit("a")), F.concat("value", F.lit(",5"))).when(F.contains("value", F.lit("c")), F.lit('"c""",1')).otherwise(F.col("value")).alias("value"))
    kept = [r.value for r in lines.collect()]
    head = spark.read.text(table).filter("value like 'sample_id%'").first().value
    spark.createDataFrame([("\n".join([head, *kept]),)], "value STRING").coalesce(1).write.mode("overwrite").text(table)
    df = O.damaged_rows(spark, str(tmp_path))
    assert "split(" not in plan(df)
    assert sorted((r.sample_id, r.width, r.declared) for r in df.collect()) == [("a", 5, 4), ('c"', 0, 4)]
