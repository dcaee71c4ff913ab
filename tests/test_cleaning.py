import pytest
from pyspark.sql import functions as F

from seqframe.functions import letters as L
from seqframe.model import Alphabet
from seqframe.operators import cleaning as C

DNA, PROTEIN = Alphabet.DNA_NUCLEOTIDE, Alphabet.AMINO_ACID


def one(df):
    return df.first()


def test_white_space_and_case_are_changed_and_counted(records):
    cleaned = C.clean_sequence(records(("a", "acgt nnrt\n"), ("b", "ACGT"), ("c", "AC\x0b\x0cGT\t\r")), DNA)
    got = {r.sample_id: r for r in cleaned.collect()}
    assert got["a"].sequence == "ACGTNNRT" and got["a"].original_length == 8
    assert got["c"].sequence == "ACGT"
    report = one(C.cleaning_report(cleaned))
    assert (report.seen, report.uppercased, report.whitespace_stripped, report.quarantined) == (3, 1, 2, 0)


def test_an_invalid_character_is_quarantined_and_named(records):
    cleaned = C.clean_sequence(records(("a", "AC1GT!1")), DNA)
    row = one(C.quarantine_table(cleaned))
    assert row.reason == "invalid_characters" and "! 1" in row.detail


def test_u_is_refused_for_dna_unless_asked_for(records):
    refused = one(C.clean_sequence(records(("a", "ACGU")), DNA))
    assert refused.reason == "invalid_characters" and "rna_to_dna" in refused.detail
    cleaned = C.clean_sequence(records(("a", "ACGU"), ("b", "ACGT")), DNA, rna_to_dna=True)
    assert [r.sequence for r in cleaned.orderBy("ord").collect()] == ["ACGT", "ACGT"]
    assert one(C.cleaning_report(cleaned)).u_to_t_converted == 1


def test_rna_to_dna_is_an_error_for_proteins(records):
    with pytest.raises(ValueError, match="selenocysteine"):
        C.clean_sequence(records(("a", "MKU")), PROTEIN, rna_to_dna=True)


def test_terminators_go_only_from_the_end_of_a_protein(records):
    cleaned = C.clean_sequence(records(("a", "MKV*"), ("b", "MKV_*_"), ("c", "MK*V"), ("d", "*")), PROTEIN)
    got = {r.sample_id: r for r in cleaned.collect()}
    assert got["a"].sequence == got["b"].sequence == "MKV"
    assert got["c"].reason == "invalid_characters"
    assert got["d"].reason == "empty_after_cleaning"
    assert one(C.cleaning_report(cleaned)).terminator_stripped == 3
    assert one(C.clean_sequence(records(("a", "ACGT*")), DNA)).reason == "invalid_characters"


def test_nothing_left_and_null_are_empty(records, spark):
    cleaned = C.clean_sequence(records(("a", "  \n"), ("b", ""), ("c", None)), DNA)
    assert {r.reason for r in cleaned.collect()} == {"empty_after_cleaning"}
    assert one(C.quarantine_reasons(cleaned)).n == 3


def test_unicode_upper_casing_can_add_letters(records):
    assert one(C.clean_sequence(records(("a", "aß")), PROTEIN)).sequence == "ASS"


def test_ambiguity_letters_are_kept_and_counted_only_in_clean_rows(records):
    cleaned = C.clean_sequence(records(("a", "ANNR"), ("b", "NN1")), DNA)
    assert {r.letter: r.n for r in C.ambiguity_profile(cleaned, DNA).collect()} == {"N": 2, "R": 1}


def test_every_letter_is_legal_in_a_protein(records):
    assert one(C.clean_sequence(records(("a", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")), PROTEIN)).reason is None


def test_a_protein_that_looks_like_dna_is_counted_not_refused(records):
    cleaned = C.clean_sequence(records(("a", "ACGTN"), ("b", "ACGTM")), PROTEIN)
    assert one(C.cleaning_report(cleaned)).protein_sequences_using_only_nucleotide_letters == 1
    assert C.split_quarantine(cleaned)[0].count() == 2


def test_text_helpers(spark):
    df = spark.createDataFrame([("http://x#y#engineered", "f1.json", "Secreted Effector!", ["b", "a"])], "u STRING, f STRING, n STRING, s ARRAY<STRING>")
    row = df.select(
        L.uri_fragment(F.col("u")).alias("u"),
        L.compose_id(F.col("f"), F.lit("7")).alias("f"),
        L.slugify(F.col("n")).alias("n"),
        L.pipe_join(F.col("s"), 1).alias("s"),
        L.trim_all(F.lit("  AC \t")).alias("t"),
    ).first()
    assert row == ("engineered", "f1::7", "secreted_effector", "a", "AC")
