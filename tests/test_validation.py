"""Break one thing in a sound table and see exactly the check that should notice it."""

import pytest
from pyspark.sql import functions as F

from seqframe.model import Options
from seqframe.operators import quality as Q
from seqframe.plans import validate as V
from seqframe.plans.convert import convert
from tests.test_convert import ROWS, dataset


@pytest.fixture(scope="module")
def sound(spark):
    c = convert(dataset(spark, ROWS), Options(width=8))
    return {"table": c.table.cache(), "samples": c.samples.cache(), "profile": c.profile.cache(), "semantics": c.dataset.semantics}


def failed(parts, **changes):
    checks = V.validate_table(**(parts | changes)).collect()
    names = [c.name for c in checks]
    assert len(names) == len(set(names)) and [c.ordinal for c in sorted(checks, key=lambda c: c.ordinal)]
    return {c.name for c in checks if not c.passed}


def cell(index, value, row="s2"):
    """The table with one token of one row replaced."""
    spoiled = F.transform("tokens", lambda t, i: F.when(i == index, F.lit(value)).otherwise(t.cast("int")))
    return lambda t: t.withColumn("tokens", F.when(F.col("sample_id") == row, spoiled).otherwise(F.col("tokens").cast("array<int>")))


HASH = "content_hash_matches_the_table_on_disk"
DECODE = "sampled_rows_decode_back_to_their_source_sequence"
ORDER = "samples_sidecar_sample_ids_match_table_order"


def test_a_sound_table_passes_everything(sound):
    assert failed(sound) == set()
    row = V.summary(V.validate_table(**sound)).first()
    assert (row.ok, row.n_checks, row.n_failed) == (True, 26, 0)


@pytest.mark.parametrize(
    "index, value, names",
    [
        (1, 0, {"padding_only_ever_trails_the_sequence", "remaining_checks_skipped"}),
        (0, 27, {"tokens_within_configured_range", "remaining_checks_skipped"}),
        (0, -1, {"tokens_within_configured_range", "remaining_checks_skipped"}),
        (7, None, {"all_position_columns_integer", "remaining_checks_skipped"}),
        (0, 5, {HASH, DECODE}),
    ],
)
def test_a_spoiled_cell(sound, index, value, names):
    assert failed(sound, table=sound["table"].transform(cell(index, value))) == names


def test_an_empty_row(sound):
    blank = F.when(F.col("sample_id") == "s2", F.array_repeat(F.lit(0), 8)).otherwise(F.col("tokens").cast("array<int>"))
    assert failed(sound, table=sound["table"].withColumn("tokens", blank)) == {"no_row_is_silently_empty", HASH, DECODE}


def test_an_off_by_one_shift_cannot_hide_behind_its_own_decode(sound):
    """Tokens shifted by one decode cleanly; only the digest of the source slice tells."""
    shifted = sound["table"].withColumn("tokens", F.concat(F.slice("tokens", 2, 7), F.array(F.lit(0).cast("tinyint"))))
    assert failed(sound, table=shifted) == {HASH, DECODE}
    assert Q.roundtrip_mismatches(Q.row_facts(shifted), sound["samples"]).count() == 4


def test_duplicate_and_null_keys(sound):
    twice = sound["table"].withColumn("sample_id", F.when(F.col("sample_id") == "s3", "s2").otherwise(F.col("sample_id")))
    assert {"primary_key_unique", ORDER} <= failed(sound, table=twice)
    null = sound["table"].withColumn("sample_id", F.when(F.col("sample_id") != "s3", F.col("sample_id")))
    assert {"primary_key_non_null", "primary_key_unique"} <= failed(sound, table=null)


def test_a_reordered_sidecar(sound):
    swapped = sound["samples"].withColumn("ord", F.lit(3) - F.col("ord"))
    got = failed(sound, samples=swapped)
    assert got == {ORDER, "samples_sidecar_content_hash_matches"}
    assert Q.key_order_differences(sound["table"], swapped).count() == 4


def test_a_sidecar_with_a_missing_or_repeated_row(sound):
    short = failed(sound, samples=sound["samples"].filter("sample_id <> 's4'"))
    assert "samples_sidecar_row_count_matches_manifest" in short and ORDER in short and DECODE in short
    repeated = sound["samples"].unionByName(sound["samples"].filter("sample_id = 's4'"))
    assert "samples_sidecar_sample_ids_unique" in failed(sound, samples=repeated)


def test_a_tampered_digest(sound):
    side = sound["samples"].withColumn("slice_digest", F.when(F.col("sample_id") == "s2", F.lit("0" * 64)).otherwise(F.col("slice_digest")))
    assert failed(sound, samples=side) == {DECODE, "samples_sidecar_content_hash_matches"}
    bad = Q.roundtrip_mismatches(Q.row_facts(sound["table"]), side).first()
    assert bad.sample_id == "s2" and bad.recorded == "0" * 64


def test_counts_and_widths(sound):
    assert "sidecar_counts_match_manifest" in failed(sound, profile=sound["profile"].withColumn("n_samples", F.lit(9).cast("bigint")))
    ragged = sound["table"].withColumn("tokens", F.when(F.col("sample_id") == "s2", F.slice("tokens", 1, 7)).otherwise(F.col("tokens")))
    assert "every_row_has_the_same_width" in failed(sound, table=ragged)
    narrow = sound["table"].withColumn("tokens", F.slice("tokens", 1, 7))
    got = failed(sound, table=narrow)
    assert "all_position_columns_present" in got
    emitted = {c.name for c in V.validate_table(**(sound | {"table": narrow})).collect()}
    assert "tokens_within_configured_range" not in emitted


def test_no_profile_stops_the_rest(sound):
    checks = V.validate_table(**(sound | {"profile": sound["profile"].limit(0)})).orderBy("ordinal").collect()
    assert [(c.name, c.passed) for c in checks] == [("loads", True), ("sidecar_present_and_matches_header", False)]


@pytest.mark.parametrize(
    "target, names",
    [
        ("array(0)", {"every_target_column_carries_at_least_one_positive", "a_single_target_column_has_at_least_two_classes", HASH}),
        ("array(1)", {"a_single_target_column_has_at_least_two_classes", HASH}),
        ("array(cast(5 * ord AS INT))", {"labels_only_documented_values", HASH}),
        ("array(cast(NULL AS INT))", {"all_target_columns_integer", "label_dependent_checks_skipped", HASH}),
        ("array(0, 1)", {"sidecar_counts_match_manifest", "target_columns_exist", "all_target_columns_integer", "label_dependent_checks_skipped", HASH}),
    ],
)
def test_spoiled_targets(sound, target, names):
    assert failed(sound, table=sound["table"].withColumn("target", F.expr(target))) == names


def test_semantics_that_document_nothing(sound):
    got = failed(sound, semantics=sound["semantics"].limit(0))
    assert got == {"labels_only_documented_values", "label_dependent_checks_skipped"}
    names = {c.name for c in V.validate_table(**(sound | {"semantics": None})).collect()}
    assert "labels_only_documented_values" not in names


def test_balance_and_counts(spark):
    df = spark.createDataFrame([([0],), ([1],), ([1],), ([1],)], "target ARRAY<INT>")
    counts = Q.class_counts(df)
    assert {(r.value, r.n) for r in counts.collect()} == {(0, 1), (1, 3)}
    assert Q.class_balance(counts).first()[1:] == (2, 0.3333)
    assert Q.class_balance(counts.filter("value = 1")).first()[1:] == (1, None)


def test_stats(sound):
    row = V.table_stats(sound["table"]).first()
    assert (row.row_count, row.column_count, row.padding_cells) == (4, 10, 12)


@pytest.mark.parametrize("n", [1, 17])
def test_layout_does_not_matter(sound, n):
    assert failed(sound, table=sound["table"].repartition(n), samples=sound["samples"].repartition(n)) == set()
