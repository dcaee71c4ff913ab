import json

import pytest
from pyspark.sql import functions as F

from seqframe.operators import linking as K
from seqframe.sources import readers as S


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(path)


PAIR_HEADER = "protein,organism,GeneID,description,natural_dna,finetune_dna\n"


def test_pair_csv_keeps_order_and_marks_malformed_rows(spark, tmp_path):
    path = put(tmp_path / "p.csv", "﻿" + PAIR_HEADER + 'MK,"E, coli",1,d,ATG,ATC\nbroken,row\nMK,o,2,,AAA,CCC\nM,o,3,"line\nbreak",A,C\n')
    df = S.read_pair_csv(spark, path)
    assert S.count_malformed(df).first() == (1, 3)
    got = S.well_formed(df).orderBy("ord").collect()
    assert [r.GeneID for r in got] == ["1", "2", "3"]
    assert got[0].organism == "E, coli" and got[1].description == "" and got[2].description == "line\nbreak"


def test_pair_csv_refuses_a_missing_column_and_an_unknown_generator(spark, tmp_path):
    path = put(tmp_path / "p.csv", "protein,organism,GeneID,natural_dna\nM,o,1,A\n")
    with pytest.raises(ValueError, match="finetune_dna"):
        S.read_pair_csv(spark, path)
    with pytest.raises(ValueError, match="generated column"):
        S.read_pair_csv(spark, path, "other_dna")


def reference_fasta(text):
    sequences, junk, current, buffer = {}, [], None, []
    import re

    for raw in [*text.split("\n"), ">"]:
        line = raw.strip()
        if not line:
            continue
        if line.startswith(">"):
            if current is not None:
                sequences[current] = "".join(buffer)
            current, buffer = line[1:].strip(), []
        elif re.match(S.NUCLEOTIDE_LINE, line):
            buffer.append(line)
        else:
            if current is not None:
                sequences[current] = "".join(buffer)
            junk.append(line[:120])
            current, buffer = None, []
    return sequences, junk


FASTA = (
    ">a first\nACGT\nacgt\n\n>b\nTTTT\nIF99_ORPHAN_HEADER_FLANK1\nCGCG\nmore junk!\n>c\r\nAA\r\nCC\r\n"
    "  > indented\nGGG\n>b\nAAAA\n>empty\n>>double\nTT\n"
)


@pytest.mark.parametrize("text", [FASTA, "junk before\nACGT\n" + FASTA, "\n\n" + FASTA, "ACGT\n", ">only"])
def test_fasta_equals_a_line_by_line_reading(spark, tmp_path, text):
    sequences, junk = S.read_fasta(spark, put(tmp_path / "x.fa", text))
    want, want_junk = reference_fasta(text)
    if text == "ACGT\n":
        want = {}
    assert {r.element: r.sequence for r in sequences.collect()} == want
    assert sorted(r.line for r in junk.collect()) == sorted(want_junk)


def test_fasta_split_over_many_tasks_and_files(spark, tmp_path):
    text = "".join(f">n{i}\n{'ACGT' * (i % 30)}\n{'!bad' if i % 9 == 4 else 'TT'}\nGG\n" for i in range(600))
    put(tmp_path / "fa" / "one.fa", text)
    put(tmp_path / "fa" / "two.fa", "no header\n>n5\nCCCC\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        sequences, junk = S.read_fasta(spark, str(tmp_path / "fa"))
        got = {r.element: r.sequence for r in sequences.collect()}
        bad = sorted(r.line for r in junk.collect())
        assert S._fasta_records(spark, str(tmp_path / "fa")).rdd.getNumPartitions() > 4
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    one, one_junk = reference_fasta(text)
    want = one | {"n5": "CCCC"}
    assert got == want and bad == sorted([*one_junk, "no header"])


def test_file_ordinals_follow_the_files_over_many_splits(spark, tmp_path):
    put(tmp_path / "d" / "a.csv", "v\n" + "".join(f"{i}\n" for i in range(3000)))
    put(tmp_path / "d" / "b.csv", "v\n" + "".join(f"{i}\n" for i in range(3000, 3500)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        df = S.read_csv_text(spark, str(tmp_path / "d"), multi_line=False)
        got = S.with_file_ordinal(df.select(S.file_position().alias("_at"), "v")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert sorted((int(r.v), r.ord) for r in got) == [(i, i) for i in range(3500)]


def test_link_csv_refuses_other_columns(spark, tmp_path):
    good = put(tmp_path / "l.csv", "Sample_ID,Master_Sample_ID,IF_Element\ns1,m,e1\ns2,m,e1\n")
    assert S.read_link_csv(spark, good).count() == 2
    with pytest.raises(ValueError, match="Sample_ID"):
        S.read_link_csv(spark, put(tmp_path / "bad.csv", "a,b\n1,2\n"))


def test_evidence_json(spark, tmp_path):
    doc = {
        "features": [
            {"id": "f1", "name": "n", "sequence": "ACGT", "role": "promoter", "sourceStart": 3},
            {"id": "f2", "sequence": "GG"},
            {"id": "f3", "role": "CDS"},
        ],
        "detections": [
            {
                "agent": "a", "sample": "Y1", "engineered": "http://x#natural",
                "contigs": [{"regions": [{"feature": "f1", "engineered": "http://x#engineered"}, {"feature": "f9"}]}, {}],
                "alterations": [{"derivedFeature": "f1", "engineered": "http://x#natural"}],
            },
            {"sample": "Y1"},
            {"sample": "", "contigs": None},
        ],
    }
    put(tmp_path / "e" / "one.json", json.dumps(doc))
    put(tmp_path / "e" / "two.json", json.dumps({"features": []}))
    documents = S.read_evidence_json(spark, str(tmp_path / "e"))
    features = S.evidence_features(documents)
    assert {(r.file, r.id, r.sourceStart) for r in features.collect()} == {("one.json", "f1", "3"), ("one.json", "f2", None)}
    calls = S.evidence_calls(documents)
    assert sorted((r.id, r.call) for r in calls.collect()) == [("f1", "engineered"), ("f1", "natural")]
    assert K.resolve_calls(calls, ["file", "id"], "call").first().call == "CONFLICT"
    assert S.evidence_detections(documents).count() == 3


def test_membership_lists(spark, tmp_path):
    put(tmp_path / "m" / "Toxin_v1.0_10.txt", "P12345\n\n Q67890 \nP12345\n")
    put(tmp_path / "m" / "Adhesion_v2.txt", "P12345\n")
    path = str(tmp_path / "m" / "*.txt")
    members = S.read_membership_lists(spark, path)
    assert {(r["class"], r.n) for r in K.members_per_class(members).collect()} == {("Toxin", 3), ("Adhesion", 1)}
    assert S.require_membership_lists(spark, path, 2).count() == 4
    with pytest.raises(ValueError, match="2 of 32 classes"):
        S.require_membership_lists(spark, path)
    put(tmp_path / "m" / "Html_v1.txt", "P12345\n<html>try later</html>\n")
    put(tmp_path / "m" / "Void_v1.txt", "\n \n")
    problems = {r.file: r.problem for r in S.membership_list_problems(spark, path).collect()}
    assert problems == {"Html_v1.txt": "<html>try later</html>", "Void_v1.txt": "<empty file>"}
    with pytest.raises(ValueError, match="Html_v1"):
        S.require_membership_lists(spark, path, 2)


def test_sequence_dictionary_takes_the_last_entry(spark, tmp_path):
    path = put(tmp_path / "d.tsv", "A\tMK\nno tab\nB\tMM\tX\nA\tMKK\n")
    assert {r.id: r.sequence for r in S.read_sequence_dict(spark, path).collect()} == {"A": "MKK", "B": "MM\tX"}


def test_values_and_one_hot_labels(spark, tmp_path):
    values = put(tmp_path / "v.csv", "sequence_id,sequence,species_human,other,growth_x\ns2,ACGT,1.0,q,0\ns1,GG,0.0,q,1\n")
    df = S.read_values_csv(spark, values)
    assert df.columns == ["sequence_id", "sequence", "species_human", "growth_x", "ord"]
    assert [r.sequence_id for r in df.orderBy("ord").collect()] == ["s2", "s1"]
    labels = put(tmp_path / "l.csv", "sequence_id,labB,labA\ns1,1.0,0.0\ns2,0.0,1.0\n")
    assert S.label_vocabulary(spark, labels) == ["labB", "labA"]
    one_hot = S.read_one_hot(spark, labels)
    assert {(r.sequence_id, r["class"]) for r in K.collapse_one_hot(one_hot, "sequence_id").collect()} == {("s1", "labB"), ("s2", "labA")}


@pytest.mark.parametrize("row", ["0.0,0.0", "1.0,1.0", "0.5,0.5", "2.0,-1.0", ",1.0x"])
def test_a_row_that_is_not_one_hot_is_refused(spark, tmp_path, row):
    one_hot = S.read_one_hot(spark, put(tmp_path / "l.csv", f"id,a,b\nbad,{row}\n"))
    assert [r.id for r in K.one_hot_violations(one_hot, "id").collect()] == ["bad"]
    with pytest.raises(Exception, match="not one-hot"):
        K.collapse_one_hot(one_hot, "id").collect()


def test_only_the_wanted_columns_are_scanned(spark, tmp_path):
    path = put(tmp_path / "v.csv", "sequence_id,sequence,species_human,other\ns,A,1,q\n")
    df = S.read_values_csv(spark, path).select("sequence_id", F.length("sequence"))
    assert "other" not in df._jdf.queryExecution().executedPlan().toString()
