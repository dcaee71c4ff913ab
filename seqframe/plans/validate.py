"""Every data-quality check over one encoded table, its sidecar and its declared profile.

Every row is decoded once, into a narrow written row of facts and digests. From those come one aggregation
(digests of the table, its key order and its decoded slices among it) and one grouping each for key uniqueness,
repeated sequences and class counts, each reading its own columns. The measurements are melted into
``(fact, num, text)`` rows, gathered into one row, and the check rows are expressions over that row; nothing
is collected. With ``by`` all of this is done for many tables at once (see ``plans/folder.py``).

Digests settle the comparisons with the sidecar without a join: equal sums over (order, key) mean
equal keys in equal order, equal sums over (key, slice digest) mean every row decodes to the slice
recorded for its key. ``key_order_differences`` and ``roundtrip_mismatches`` list what differs.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqframe.functions import digests as D
from seqframe.model import KEY, MAX_TOKEN, PAD_TOKEN
from seqframe.operators import quality as Q
from seqframe.session import written

# The names of the checks, in the order in which they are reported.
CHECK_NAMES = (
    "loads",
    "sidecar_present_and_matches_header",
    "sidecar_counts_match_manifest",
    "primary_key_column_exists",
    "primary_key_non_null",
    "primary_key_unique",
    "samples_sidecar_content_hash_matches",
    "samples_sidecar_row_count_matches_manifest",
    "samples_sidecar_sample_ids_unique",
    "samples_sidecar_sample_ids_match_table_order",
    "target_columns_exist",
    "all_target_columns_integer",
    "labels_only_documented_values",
    "label_dependent_checks_skipped",
    "all_position_columns_present",
    "all_position_columns_integer",
    "every_row_has_the_same_width",
    "tokens_within_configured_range",
    "padding_only_ever_trails_the_sequence",
    "remaining_checks_skipped",
    "no_row_is_silently_empty",
    "zero_is_reserved_for_padding",
    "duplicate_sequences_reported",
    "conflicting_labels_on_identical_sequences_reported",
    "every_target_column_carries_at_least_one_positive",
    "a_single_target_column_has_at_least_two_classes",
    "content_hash_matches_the_table_on_disk",
    "sampled_rows_decode_back_to_their_source_sequence",
)

_NUMBERS = (
    "n_profiles", "n_samples", "n_features", "n_targets", "samples_n_rows",
    "n_rows", "null_keys", "distinct_keys", "width_min", "width_max", "non_integer_rows", "token_min",
    "token_max", "padding_cells", "inner_padding", "empty_rows", "targets_min", "targets_max",
    "non_integer_targets", "sidecar_rows", "sidecar_distinct_keys", "repeated_sequences",
    "rows_of_repeated", "conflicts", "documented", "undocumented", "all_zero_targets", "classes_of_first",
)
_TEXTS = (
    "content_hash", "samples_content_hash", "table_digest", "key_order", "decoded_digest",
    "sidecar_digest", "sidecar_key_order", "slice_digest_sum", "target_digest",
)


def condensed(table: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One narrow row per table row: its letters and what they tell. Rows are decoded here and nowhere else.

    Digests do not compress and letters do, so ``digested`` makes them from what is written.
    """
    rows = Q.row_facts(table)
    numbers = Q.token_cell(F.col("in_range") & ~F.col("has_non_integer"), F.lit(None).cast("string"), F.col("tokens"))
    return rows.select(
        *by, "ord", KEY, "target", "_row", numbers.alias("_numbers"),
        "width", "has_non_integer", "token_min", "token_max", "padding", "well_padded", "residues",
        F.coalesce(F.size("target"), F.lit(0)).alias("n_of_target"),
        F.coalesce(F.exists("target", lambda v: v.isNull()), F.lit(True)).alias("bad_target"),
    )


def digested(rows: DataFrame, slice_digest: str = "sha2-256", by: Sequence[str] = ()) -> DataFrame:
    """``condensed`` rows with their digests."""
    key, order, target = D.cell_text(rows, KEY), D.cell_text(rows, "ord"), D.cell_text(rows, "target")
    decoded = F.replace("_row", F.lit("@"), F.lit(""))
    letters = F.col("_letters") if slice_digest == "sha2-256" else D.text_digest(decoded, slice_digest)
    return rows.withColumn("_letters", F.sha2(decoded, 256)).select(
        *by, KEY, "target", target.alias("label_text"), D.packed(F.col("_letters")).alias("sequence_digest"),
        "width", "has_non_integer", "token_min", "token_max", "padding", "well_padded", "residues", "n_of_target", "bad_target",
        D.packed(Q.table_row_digest(rows, F.coalesce("_numbers", "_row"))).alias("_content"),
        D.packed(D.row_digest(order, key)).alias("_order"),
        D.packed(D.row_digest(key, letters)).alias("_slice"),
        D.packed(D.row_digest(order, key, target)).alias("_target"),
    )


def measured(table: DataFrame, slice_digest: str = "sha2-256", by: Sequence[str] = ()) -> DataFrame:
    """One row per table row: its facts and digests."""
    return digested(condensed(table, by), slice_digest, by)


def measured_once(table: DataFrame, slice_digest: str = "sha2-256", by: Sequence[str] = ()) -> DataFrame:
    """The same from written ``condensed`` rows (action)."""
    return digested(written(condensed(table, by), "zstd"), slice_digest, by)


def measured_facts(rows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Totals of ``measured`` rows, one row per table."""
    zero = F.lit(0)
    return rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col(KEY).isNull()).alias("null_keys"),
        F.min("width").alias("width_min"),
        F.max("width").alias("width_max"),
        F.count_if("has_non_integer").alias("non_integer_rows"),
        F.min("token_min").alias("token_min"),
        F.max("token_max").alias("token_max"),
        F.coalesce(F.sum("padding"), zero).alias("padding_cells"),
        F.count_if(~F.col("well_padded")).alias("inner_padding"),
        F.count_if(F.col("residues") == 0).alias("empty_rows"),
        F.min("n_of_target").alias("targets_min"),
        F.max("n_of_target").alias("targets_max"),
        F.count_if("bad_target").alias("non_integer_targets"),
        D.combined_digest("_content", True).alias("table_digest"),
        D.combined_digest("_order", True).alias("key_order"),
        D.combined_digest("_slice", True).alias("decoded_digest"),
        D.combined_digest("_target", True).alias("target_digest"),
    )


def table_facts(table: DataFrame, slice_digest: str = "sha2-256") -> DataFrame:
    """One row: everything a single pass over the table can tell."""
    return measured_facts(measured(table, slice_digest))


def sidecar_facts(samples: DataFrame, cells: Column | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Totals of a sidecar, one row per table; ``cells`` digests a row's cells where they are not columns."""
    if cells is None:
        cells = D.row_digest(*[D.cell_text(samples, c) for c in samples.columns if c not in ("ord", *by)])
    key, order = D.cell_text(samples, KEY), D.cell_text(samples, "ord")
    marked = samples.select(
        *by,
        D.row_digest(order, cells).alias("_content"),
        D.row_digest(order, key).alias("_order"),
        D.row_digest(key, D.cell_text(samples, "slice_digest")).alias("_slice"),
    )
    return marked.groupBy(*by).agg(
        F.count(F.lit(1)).alias("sidecar_rows"),
        D.combined_digest("_content").alias("sidecar_digest"),
        D.combined_digest("_order").alias("sidecar_key_order"),
        D.combined_digest("_slice").alias("slice_digest_sum"),
    )


def melted(one_row: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``(fact, num, text)``: one row per column of a DataFrame of one row (per table)."""
    cells = []
    for f in [f for f in one_row.schema.fields if f.name not in by]:
        text = f.dataType.typeName() == "string"
        num, word = ("NULL", f.name) if text else (f.name, "NULL")
        cells.append(
            f"named_struct('fact', '{f.name}', 'num', cast({num} AS BIGINT), 'text', cast({word} AS STRING))"
        )
    return one_row.select(*by, F.expr(f"inline(array({', '.join(cells)}))"))


def gathered(long: DataFrame, numbers: Sequence[str], texts: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """One row (per table) again: a column per fact, null for one that was not measured."""
    return long.groupBy(*by).agg(
        *[F.expr(f"max(CASE WHEN fact = '{n}' THEN num END) AS {n}") for n in numbers],
        *[F.expr(f"max(CASE WHEN fact = '{n}' THEN text END) AS {n}") for n in texts],
    )


def label_facts(table: DataFrame, semantics: DataFrame | None, by: Sequence[str] = ()) -> DataFrame:
    """Values per target column, reduced to counts before anything is joined."""
    values = table.select(*by, F.posexplode("target").alias("target_index", "value")).filter(F.col("value").isNotNull())
    counts = values.groupBy(*by, "target_index", "value").agg(F.count(F.lit(1)).alias("n"))
    if semantics is None:
        known = counts.withColumn("known", F.lit(True))
    else:
        named = semantics.select(*by, "value", F.lit(True).alias("known")).distinct()
        known = counts.join(named, [*by, "value"], "left")
    per_target = known.groupBy(*by, "target_index").agg(
        F.max(F.abs("value")).alias("top"),
        F.count(F.lit(1)).alias("classes"),
        F.count_if(F.col("known").isNull()).alias("unknown"),
    )
    return per_target.groupBy(*by).agg(
        F.count_if(F.col("top") == 0).alias("all_zero_targets"),
        F.max(F.when(F.col("target_index") == 0, F.col("classes"))).alias("classes_of_first"),
        F.coalesce(F.sum("unknown"), F.lit(0)).alias("undocumented"),
    )


def distinct_keys(rows: DataFrame, name: str, by: Sequence[str] = ()) -> DataFrame:
    return rows.groupBy(*by, KEY).agg(F.lit(1)).groupBy(*by).agg(F.count(KEY).alias(name))


def repeat_facts(rows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Repeated sequences and their labels from ``measured`` rows, counted in two steps."""
    pairs = rows.groupBy(*by, "sequence_digest", "label_text").agg(F.count(F.lit(1)).alias("_n"))
    groups = pairs.groupBy(*by, "sequence_digest").agg(F.sum("_n").alias("n_rows"), F.count(F.lit(1)).alias("n_labels"))
    return groups.groupBy(*by).agg(
        F.count_if(F.col("n_rows") > 1).alias("repeated_sequences"),
        F.coalesce(F.sum(F.when(F.col("n_rows") > 1, F.col("n_rows"))), F.lit(0)).alias("rows_of_repeated"),
        F.count_if(F.col("n_labels") > 1).alias("conflicts"),
    )


DECLARED = ("n_samples", "n_features", "n_targets", "samples_n_rows", "content_hash", "samples_content_hash")


def facts(
    rows: DataFrame,
    samples: DataFrame,
    profile: DataFrame,
    semantics: DataFrame | None,
    cells: Column | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """All measurements in one row (per table) from written ``measured`` rows: each part reads the columns it needs."""
    return facts_of(table_parts(rows, profile, semantics, by).unionByName(sidecar_parts(samples, cells, by)), by)


def table_parts(rows: DataFrame, profile: DataFrame, semantics: DataFrame | None, by: Sequence[str] = ()) -> DataFrame:
    """``melted`` measurements of the table and what was declared."""
    count = F.count(F.lit(1))
    parts = [
        profile.groupBy(*by).agg(count.alias("n_profiles"), *[F.max(c).alias(c) for c in DECLARED]),
        measured_facts(rows, by),
        distinct_keys(rows, "distinct_keys", by),
        repeat_facts(rows, by),
        label_facts(rows, semantics, by),
    ]
    if semantics is not None:
        parts.append(semantics.groupBy(*by).agg(count.alias("documented")))
    return reduce(DataFrame.unionByName, [melted(p, by) for p in parts])


def sidecar_parts(samples: DataFrame, cells: Column | None = None, by: Sequence[str] = ()) -> DataFrame:
    """``melted`` measurements of the sidecar."""
    keys = distinct_keys(samples, "sidecar_distinct_keys", by)
    return melted(sidecar_facts(samples, cells, by), by).unionByName(melted(keys, by))


def facts_of(parts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return gathered(parts, _NUMBERS, _TEXTS, by)


# Premises of the checks, over the gathered facts.
PROFILE = "n_profiles = 1"
TARGETS_EXIST = "targets_min = n_targets AND targets_max = n_targets"
TARGETS_INT = f"{TARGETS_EXIST} AND non_integer_targets = 0"
FEATURES = "width_max >= n_features"
CELLS_INT = "non_integer_rows = 0"
IN_RANGE = f"token_min >= {PAD_TOKEN} AND token_max <= {MAX_TOKEN}"
TRAILING = "inner_padding = 0"
SAME_WIDTH = "width_min = width_max AND width_max = n_features"


def _check_spec(has_semantics: bool) -> dict[str, tuple[str, str, str]]:
    """Name to (emitted when, passes when, detail); a detail is words and ``{facts}``."""
    semantics = "documented > 0" if has_semantics else "true"
    usable = f"{TARGETS_INT} AND {semantics}"
    cells = f"{PROFILE} AND {FEATURES}"
    integer = f"{cells} AND {CELLS_INT}"
    ranged = f"{integer} AND {IN_RANGE}"
    decodable = f"{ranged} AND {TRAILING}"
    judged = f"{decodable} AND {usable}"
    documented = f"{PROFILE} AND {str(has_semantics).lower()} AND (({usable}) OR NOT ({semantics}))"
    counts = "n_rows = n_samples AND width_max = n_features AND targets_max = n_targets"
    return {
        "loads": ("true", "n_rows > 0 AND coalesce(width_max <= n_features, true)", "rows {n_rows}"),
        "sidecar_present_and_matches_header": ("true", PROFILE, "manifests {n_profiles}"),
        "sidecar_counts_match_manifest": (
            PROFILE,
            counts,
            "rows {n_rows} of {n_samples}, features {width_max} of {n_features}, targets {targets_max} of {n_targets}",
        ),
        "primary_key_column_exists": (PROFILE, "true", KEY),
        "primary_key_non_null": (PROFILE, "null_keys = 0", "null keys {null_keys}"),
        "primary_key_unique": (PROFILE, "n_rows = distinct_keys", "rows {n_rows}, keys {distinct_keys}"),
        "samples_sidecar_content_hash_matches": (
            PROFILE,
            "sidecar_digest = samples_content_hash",
            "found {sidecar_digest}, declared {samples_content_hash}",
        ),
        "samples_sidecar_row_count_matches_manifest": (
            PROFILE,
            "sidecar_rows = samples_n_rows AND samples_n_rows = n_samples",
            "rows {sidecar_rows}, declared {samples_n_rows}",
        ),
        "samples_sidecar_sample_ids_unique": (
            PROFILE,
            "sidecar_rows > 0 AND sidecar_rows = sidecar_distinct_keys",
            "rows {sidecar_rows}, keys {sidecar_distinct_keys}",
        ),
        "samples_sidecar_sample_ids_match_table_order": (
            PROFILE,
            "key_order = sidecar_key_order",
            "table keys {n_rows}, sidecar keys {sidecar_rows}",
        ),
        "target_columns_exist": (PROFILE, TARGETS_EXIST, "targets {targets_min}..{targets_max} of {n_targets}"),
        "all_target_columns_integer": (PROFILE, TARGETS_INT, "rows with another value {non_integer_targets}"),
        "labels_only_documented_values": (
            documented,
            f"{semantics} AND undocumented = 0",
            "documented {documented}, undocumented {undocumented}",
        ),
        "label_dependent_checks_skipped": (
            f"{PROFILE} AND NOT coalesce({usable}, false)",
            "false",
            "targets or their semantics are unusable",
        ),
        "all_position_columns_present": (PROFILE, FEATURES, "widest row {width_max} of {n_features}"),
        "all_position_columns_integer": (cells, CELLS_INT, "rows with another value {non_integer_rows}"),
        "every_row_has_the_same_width": (integer, SAME_WIDTH, "widths {width_min}..{width_max}"),
        "tokens_within_configured_range": (integer, IN_RANGE, "tokens {token_min}..{token_max}"),
        "padding_only_ever_trails_the_sequence": (ranged, TRAILING, "rows with inner padding {inner_padding}"),
        "remaining_checks_skipped": (
            f"{cells} AND NOT coalesce({decodable}, false)",
            "false",
            "a cell is no integer, out of range, or padding does not only trail",
        ),
        "no_row_is_silently_empty": (decodable, "empty_rows = 0", "empty rows {empty_rows}"),
        "zero_is_reserved_for_padding": (decodable, "true", "padding cells {padding_cells}"),
        "duplicate_sequences_reported": (
            decodable,
            "true",
            "repeated sequences {repeated_sequences}, rows {rows_of_repeated}",
        ),
        "conflicting_labels_on_identical_sequences_reported": (
            judged,
            "true",
            "sequences with several labels {conflicts}",
        ),
        "every_target_column_carries_at_least_one_positive": (
            judged,
            "all_zero_targets = 0",
            "all-zero targets {all_zero_targets}",
        ),
        "a_single_target_column_has_at_least_two_classes": (
            f"{judged} AND n_targets = 1",
            "classes_of_first >= 2",
            "classes {classes_of_first}",
        ),
        "content_hash_matches_the_table_on_disk": (
            decodable,
            "table_digest = content_hash",
            "found {table_digest}, declared {content_hash}",
        ),
        "sampled_rows_decode_back_to_their_source_sequence": (
            decodable,
            "decoded_digest = slice_digest_sum",
            "every row compared",
        ),
    }


def _detail(template: str) -> str:
    """SQL text of a detail: words and facts in turn."""
    parts = re.split(r"\{(\w+)\}", template)
    cells = [
        f"coalesce(left(cast({p} AS STRING), 16), 'none')" if i % 2 else f"'{p}'" for i, p in enumerate(parts)
    ]
    return f"concat({', '.join(cells)})"


def checks_from_facts(one_row: DataFrame, has_semantics: bool = True, by: Sequence[str] = ()) -> DataFrame:
    """``(ordinal, name, passed, detail)`` (per table); a check whose premise failed is left out and said so."""
    spec = _check_spec(has_semantics)
    rows = [
        f"named_struct('ordinal', {i}, 'name', '{name}', 'passed', coalesce({passed}, false), "
        f"'detail', {_detail(detail)}, 'emitted', coalesce({emitted}, false))"
        for i, name in enumerate(CHECK_NAMES)
        for emitted, passed, detail in [spec[name]]
    ]
    listed = one_row.select(*by, F.expr(f"inline(array({', '.join(rows)}))"))
    return listed.filter("emitted").drop("emitted")


def validate_table(
    table: DataFrame,
    samples: DataFrame,
    profile: DataFrame,
    semantics: DataFrame | None = None,
    slice_digest: str = "sha2-256",
) -> DataFrame:
    """Check rows of one table (action: every row is decoded once and its facts are written).

    ``table`` is ``(ord, sample_id, target ARRAY, tokens ARRAY)`` with null for a cell that is no
    integer; ``samples`` has ``ord, sample_id, slice_digest``; ``profile`` is the one declared row.
    """
    rows = measured_once(table, slice_digest)
    return checks_from_facts(facts(rows, samples, profile, semantics), semantics is not None)


def summary(checks: DataFrame) -> DataFrame:
    failed = F.count_if(~F.col("passed"))
    return checks.agg((failed == 0).alias("ok"), F.count(F.lit(1)).alias("n_checks"), failed.alias("n_failed"))


def table_stats(table: DataFrame) -> DataFrame:
    """Row and column counts, padding and digest of a table; class counts are ``class_counts``."""
    f = table_facts(table)
    return f.select(
        F.col("n_rows").alias("row_count"),
        (F.lit(1) + F.col("targets_max") + F.col("width_max")).alias("column_count"),
        "padding_cells",
        F.col("table_digest").alias("content_hash"),
    )


def validate_dataset(spark, path: str) -> DataFrame:
    """Check rows of a written dataset, ``(table, ordinal, name, passed, detail)``."""
    from seqframe.sources.tables import read_dataset

    table, samples, profile, semantics = read_dataset(spark, path, once=False)
    algorithm = profile.first().slice_digest_algorithm
    return validate_table(table, samples, profile, semantics, algorithm).select(F.lit(path).alias("table"), "*")
