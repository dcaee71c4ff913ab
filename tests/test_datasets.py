import random

import pytest
from pyspark.sql import functions as F

from seqframe.operators import linking as K
from seqframe.operators import quality as Q
from seqframe.plans import datasets as D


def pairs(spark, rows):
    return spark.createDataFrame(
        [(i, *r) for i, r in enumerate(rows)],
        "ord BIGINT, protein STRING, organism STRING, GeneID STRING, description STRING, natural_dna STRING, finetune_dna STRING",
    )


def test_pairs_alternate_and_repeats_are_numbered(spark):
    row = ("MK", "E", "1", "d" * 200, "ATG", "ATC")
    ds = D.pairs_dataset(pairs(spark, [row, ("M", "E", "2", "", " AAA ", "CCC"), row, row, ("M", "E", "3", "", "", "A"), ("M", "E", "4", "", "AA", "A")]))
    got = ds.df.orderBy("ord").collect()
    assert [r.label for r in got] == [[0], [1]] * 4
    ids = [r.metadata.pair_id for r in got[::2]]
    assert ids[2] == f"{ids[0]}_1" and ids[3] == f"{ids[0]}_2" and ids[1] not in ids[2]
    assert [r.sample_id for r in got[:2]] == [f"{ids[0]}__natural", f"{ids[0]}__finetune"]
    assert got[0].metadata.description == "d" * 200 and got[2].sequence == "AAA"
    assert ds.stats["pair_drops"].first() == (1, 1, 4)


def test_a_pair_id_does_not_depend_on_what_else_was_sampled(spark):
    rows = [("M", "E", str(i), "", "ATG" * (i + 1), "ATC" * (i + 1)) for i in range(6)]
    whole = {r.sample_id for r in D.pairs_dataset(pairs(spark, rows)).df.collect()}
    part = {r.sample_id for r in D.pairs_dataset(pairs(spark, rows[3:])).df.collect()}
    capped = D.pairs_dataset(pairs(spark, rows), max_pairs=2).df
    assert part < whole and capped.count() == 4
    both = D.pairs_dataset(pairs(spark, rows)).df.unionByName(D.pairs_dataset(pairs(spark, rows[3:])).df).dropDuplicates(["sample_id"])
    assert both.count() == len(whole)


def test_membership_is_positive_only_and_unresolved_members_are_counted(spark):
    members = spark.createDataFrame([("b", "P1"), ("a", "P1"), ("a", "P2"), ("a", "P2"), ("b", "P3")], "class STRING, id STRING")
    sequences = spark.createDataFrame([("P1", "MK"), ("P2", "MM"), ("P9", "MV")], "id STRING, sequence STRING")
    ds = D.membership_dataset(members, sequences, ["b", "a", "c"])
    assert {r.sample_id: r.label for r in ds.df.collect()} == {"P1": [1, 1, 0], "P2": [1, 0, 0]}
    assert ds.target_names == ("a", "b", "c") and ds.n_targets == 3
    assert [r.id for r in ds.stats["unresolved"].collect()] == ["P3"]
    assert {r["class"]: r.n for r in ds.stats["lines_per_class"].collect()} == {"a": 3, "b": 2}
    assert {r["class"]: r.n for r in ds.stats["positives_per_class"].collect()} == {"a": 2, "b": 1, "c": 0}
    capped = D.membership_dataset(members, sequences, ["a", "b"], max_records=1)
    assert [r.sample_id for r in capped.df.collect()] == ["P1"]


NAMES = {
    "LBNL_IF00015_AmpR_861bp_plasmid.element_Staphylococcus.aureus": (1, "plasmid.element", "Staphylococcus aureus"),
    "LBNL_IF00016_geneX_20bp_insertion_Homo.sapiens": (1, "insertion", "Homo sapiens"),
    "LBNL_IF00017_geneY_10bp_deletion_Pseudomonas.putida": (0, "deletion", "Pseudomonas putida"),
    "LBNL_IF00017_geneY_10bp_deletion_Pseudomonas.putida_flank2": (0, "deletion", "Pseudomonas putida"),
    "LBNL_IF00018_geneZ_10bp_inversion_Genus.sp": (None, "inversion", "Genus sp"),
    "LBNL_IF00018_geneZ_10bp_inversion_Genus.sp_flank1": (0, "inversion", "Genus sp"),
    "LBNL_IF00019_geneZ_10bp_insertion.site_Genus.sp_FLANK1": (None, "insertion.site", "Genus sp"),
    "LBNL_IF00265_voz1_9bp_607-615delACGACCTCC_DDLQE29-33EE_deletion_Oryza.sativa": (0, "deletion", "Oryza sativa"),
    "LBNL_IF00020_lacZalpha_168bp_CDSpartial_Insertion_synthetic": (1, "insertion", ""),
    "LBNL_IF00021_thing_5bp": (None, "unparsed", ""),
    "no_length_token_Here": (None, "unparsed", "Here"),
}


def test_event_labels_follow_the_ordered_rule(spark):
    df = spark.createDataFrame([(n, "ACGTACGTAC") for n in NAMES], "element STRING, sequence STRING")
    got = {r.element: (r.event_label, r.element_type, r.origin_organism) for r in K.event_labels(K.parse_elements(df)).collect()}
    assert got == {n: (v[0], v[1], "" if n.endswith("_5bp") else v[2]) for n, v in NAMES.items()}


def test_event_dataset_counts_what_it_excludes(spark):
    elements = spark.createDataFrame([(n, "ACGTACGTAC") for n in NAMES], "element STRING, sequence STRING")
    first = next(iter(NAMES))
    links = spark.createDataFrame([(first, f"S{i:02d}") for i in range(12)] + [(first, "S00"), ("ghost", "S1")], "element STRING, sample STRING")
    ds = D.event_signature_dataset(elements, links)
    assert {r.element_type: r.n for r in ds.stats["excluded_types"].collect()} == {"inversion": 1, "insertion.site": 1, "unparsed": 2}
    row = ds.df.filter(F.col("sample_id") == first).first()
    assert row.metadata.n_samples_containing == 12
    assert row.metadata.samples_containing == "|".join(f"S{i:02d}" for i in range(8))
    assert row.metadata.if_element_number == "IF00015"
    assert ds.stats["without_link"].count() == 6
    assert [r.element for r in ds.stats["links_without_sequence"].collect()] == ["ghost"]
    wrong = {r.element for r in ds.stats["length_disagreements"].collect()}
    assert "LBNL_IF00016_geneX_20bp_insertion_Homo.sapiens" in wrong
    assert not any("flank" in n.lower() or "geneY_10bp" in n for n in wrong)
    both = D.event_signature_dataset(elements, links, max_records=2)
    assert {r.label[0] for r in both.df.collect()} == {0, 1}


def test_an_insertion_and_its_flank_share_a_group_on_opposite_sides(spark):
    rows = [("L_IF00016_A_8bp_insertion_G.s", "ACGTACGT"), ("L_IF00016_A_8bp_insertion_G.s_flank1", "TT")]
    labelled = K.event_labels(K.parse_elements(spark.createDataFrame(rows, "element STRING, sequence STRING")))
    assert K.group_straddle(labelled, "element_number", "event_label").first() == ("IF00016", 2)


def brute_baseline(zeros, ones):
    if not zeros or not ones:
        return 0.0
    best = max((sum(x >= t for x in ones) + sum(x < t for x in zeros)) / (len(zeros) + len(ones)) for t in {*zeros, *ones})
    return round(best, 4)


@pytest.mark.parametrize("seed", range(4))
def test_length_baseline_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    zeros = [rng.randrange(1, 30) for _ in range(40)]
    ones = [rng.randrange(10, 60) for _ in range(0 if seed == 3 else 30)]
    rows = [(n, 0) for n in zeros] + [(n, 1) for n in ones]
    got = K.length_baseline(spark.createDataFrame(rows, "len INT, y INT"), "len", "y").first()[0]
    assert got == brute_baseline(zeros, ones)


def evidence(spark):
    features = spark.createDataFrame(
        [
            ("a.json", "f1", "n", "ACGT", "promoter", "src", "3", "9", "x#inline"),
            ("a.json", "f2", None, "GGGG", "CDS", None, None, None, None),
            ("b.json", "f1", "n", "TTTT", "terminator", None, None, None, None),
            ("b.json", "f4", "n", "TTTT", "", None, None, None, None),
            ("b.json", "f5", "n", "CCCC", None, None, None, None, None),
        ],
        "file STRING, id STRING, name STRING, sequence STRING, role STRING, source STRING, sourceStart STRING, sourceEnd STRING, sourceOrientation STRING",
    )
    calls = spark.createDataFrame(
        [("a.json", "f1", "engineered"), ("a.json", "f1", "natural"), ("b.json", "f5", "engineered"), ("b.json", "zz", "natural")],
        "file STRING, id STRING, call STRING",
    )
    detections = spark.createDataFrame([("Y1", "natural"), ("Y1", None), ("", "engineered"), ("Y2", "natural")], "sample STRING, call STRING")
    return features, calls, detections


def test_roles_are_numbered_before_the_cap(spark):
    features, calls, detections = evidence(spark)
    whole = {r.sample_id: r.label for r in D.evidence_roles_dataset(features, calls).df.collect()}
    assert whole == {"a::f1": [1], "a::f2": [0], "b::f1": [2]}
    capped = D.evidence_roles_dataset(features, calls, max_records=2)
    assert {r.sample_id: r.label for r in capped.df.collect()} == {"a::f1": [1], "a::f2": [0]}
    assert capped.semantics.count() == 3


def test_calls_are_carried_resolved_and_counted_but_never_the_label(spark):
    ds = D.evidence_roles_dataset(*evidence(spark))
    got = {r.sample_id: r.metadata for r in ds.df.collect()}
    assert got["a::f1"].call_not_ground_truth == "CONFLICT" and got["a::f2"].call_not_ground_truth == ""
    assert got["a::f1"].source_orientation == "inline" and got["a::f2"].feature_name == ""
    census = {r.measure: r.n for r in ds.stats["census"].collect()}
    assert census == {"features_with_sequence": 5, "total_bp": 20, "detections": 4, "distinct_samples": 2, "features_linkable_to_a_call": 2}
    assert {r.call: r.n for r in ds.stats["call_distribution"].collect()} == {"CONFLICT": 1, "engineered": 1}
    assert {r.call: r.n for r in ds.stats["detection_calls"].collect()} == {"natural": 2, "engineered": 1}
    assert ds.stats["rows_with_a_call"].first().n == 1


def attribution(spark, n=6):
    values = spark.createDataFrame([(i, f"s{i}", "ACGT", float(i % 2)) for i in range(n)], "ord BIGINT, sequence_id STRING, sequence STRING, species_x DOUBLE")
    one_hot = spark.createDataFrame([(f"s{i}", float(i % 3 == 0), float(i % 3 == 1), float(i % 3 == 2)) for i in range(n - 1)], "sequence_id STRING, labC DOUBLE, labA DOUBLE, pool DOUBLE")
    return values, one_hot


def test_attribution_classes_come_from_the_header(spark):
    values, one_hot = attribution(spark)
    ds = D.attribution_dataset(values, one_hot, pooled="pool")
    got = {r.sample_id: (r.label[0], r.metadata.lab_id, r.metadata.is_pooled_unknown_lab) for r in ds.df.collect()}
    assert got == {"s0": (1, "labC", 0), "s1": (0, "labA", 0), "s2": (2, "pool", 1), "s3": (1, "labC", 0), "s4": (0, "labA", 0)}
    capped = D.attribution_dataset(values, one_hot, max_records=1)
    assert [(r.sample_id, r.label) for r in capped.df.collect()] == [("s0", [1])]
    assert "natural" not in " ".join(r.meaning for r in ds.semantics.collect())


def test_attribution_refuses_duplicate_ids(spark):
    values, one_hot = attribution(spark)
    with pytest.raises(ValueError, match="repeat"):
        D.attribution_dataset(values.unionByName(values.limit(1)), one_hot)


def test_class_index_does_not_depend_on_row_order(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("a",), (None,)], "v STRING")
    want = {"a": 0, "b": 1, "c": 2}
    for shuffled in (df, df.orderBy(F.col("v").desc()), df.repartition(3)):
        assert {r.v: r["index"] for r in K.class_index(shuffled, "v").collect()} == want
    assert [r.v for r in K.labels_outside_vocabulary(df.na.drop(), K.class_index(df, "v").filter("v <> 'c'"), "v").collect()] == ["c"]


def test_tallies_skip_nulls(spark):
    df = spark.createDataFrame([("x", 1), ("x", None), (None, 2)], "a STRING, b INT")
    assert {tuple(r) for r in K.sample_tallies(df, ["a", "b"]).collect()} == {("a", "x", 2), ("b", "1", 1), ("b", "2", 1)}


def test_duplicates_and_conflicts(spark):
    df = spark.createDataFrame([("A", [0]), ("A", [1]), ("A", [1]), ("B", [0]), ("C", [1]), ("C", [1])], "sequence STRING, label ARRAY<INT>")
    assert sorted(r.n_rows for r in Q.duplicate_sequences(df).collect()) == [2, 3]
    conflict = Q.label_conflicts(df).collect()
    assert [(r.n_rows, r.n_labels) for r in conflict] == [(3, 2)]


def test_a_union_of_extracts_has_each_key_once(spark):
    a = spark.createDataFrame([("1", "x"), ("2", "y"), (None, "n")], "sample_id STRING, sequence STRING")
    b = spark.createDataFrame([("2", "y"), ("3", "z"), ("3", "z"), ("4", "w"), (None, "m"), (None, "m")], "sample_id STRING, sequence STRING")
    got = [tuple(r) for r in K.union_extracts(a, b).collect()]
    assert sorted(got, key=str) == sorted([("1", "x"), ("2", "y"), ("3", "z"), ("4", "w"), (None, "n"), (None, "m"), (None, "m")], key=str)
    assert K.union_extracts(a.limit(0), b.limit(0)).collect() == []
