"""Membership, calls, links, pairs and one-hot labels: the joins and groupings behind the labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqframe.functions import elements as E
from seqframe.functions import labels as B
from seqframe.functions.digests import cell_text, row_digest
from seqframe.functions.digests import content_key as key_of
from seqframe.functions.letters import trim_all
from seqframe.operators.ranking import ordinals
from seqframe.operators.shaping import computed_once
from seqframe.session import broadcast_if_small, written

# Fixed value: what a feature with two different calls carries.
CONFLICT = "CONFLICT"


# ---- membership -------------------------------------------------------------------------------


def members_per_class(members: DataFrame) -> DataFrame:
    """List lines per class; a repeated line counts again."""
    return members.groupBy("class").agg(F.count(F.lit(1)).alias("n"))


def classes_per_member(members: DataFrame) -> DataFrame:
    """``(id, classes)``: the sorted set of a member's classes, never more than there are classes."""
    return members.groupBy("id").agg(F.sort_array(F.collect_set("class")).alias("classes"))


def membership_matrix(members: DataFrame, classes: Sequence[str]) -> DataFrame:
    return classes_per_member(members).withColumn("label", B.label_vector(F.col("classes"), classes))


def resolved_members(members: DataFrame, sequences: DataFrame) -> DataFrame:
    """Members joined to their non-empty sequence (both sides hold an id once)."""
    return members.join(sequences.filter(F.length("sequence") > 0), "id")


def unresolved_members(members: DataFrame, sequences: DataFrame) -> DataFrame:
    return members.join(sequences.select("id"), "id", "left_anti")


def positives_per_class(df: DataFrame, classes: Sequence[str], label: str = "label") -> DataFrame:
    """Positives of every class in one pass, classes without any included."""
    sums = df.agg(
        *[F.coalesce(F.sum(F.col(label)[i]), F.lit(0)).alias(f"c{i}") for i in range(len(classes))]
    )
    rows = [F.struct(F.lit(c).alias("class"), F.col(f"c{i}").alias("n")) for i, c in enumerate(classes)]
    return sums.select(F.inline(F.array(*rows)))


# ---- class vocabularies -----------------------------------------------------------------------


def class_index(df: DataFrame, col: str) -> DataFrame:
    """``(col, index)``: distinct values in sorted order, numbered from 0 (action)."""
    distinct = df.filter(F.col(col).isNotNull()).select(col).distinct()
    return ordinals(distinct, [col], "index").withColumn("index", F.col("index").cast("int"))


def with_class_index(df: DataFrame, index: DataFrame, col: str) -> DataFrame:
    return df.join(broadcast_if_small(index), col)


def labels_outside_vocabulary(df: DataFrame, vocabulary: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct().join(vocabulary.select(col).distinct(), col, "left_anti")


# ---- one-hot labels ---------------------------------------------------------------------------


def collapse_one_hot(df: DataFrame, id_col: str, *, refuse: bool = True) -> DataFrame:
    """``(id, class)`` of a wide one-hot table.

    A row without exactly one 1.0 is an error, raised by the task that meets it; with
    ``refuse=False`` such a row gets a null class instead, so that all of them can be listed.
    """
    classes = [c for c in df.columns if c != id_col]
    cells = F.array(*[F.col(f"`{c}`").cast("double") for c in classes])
    narrow = df.select(id_col, cells.alias("_cells"))
    found = B.one_hot_class(F.col("_cells"), classes)
    problem = F.raise_error(F.concat(F.lit("not one-hot: "), F.col(id_col).cast("string")))
    bad = problem if refuse else F.lit(None).cast("string")
    return narrow.select(id_col, F.when(B.one_hot_ok(F.col("_cells")), found).otherwise(bad).alias("class"))


def one_hot_violations(df: DataFrame, id_col: str) -> DataFrame:
    return collapse_one_hot(df, id_col, refuse=False).filter(F.col("class").isNull()).select(id_col)


# ---- calls ------------------------------------------------------------------------------------


def resolve_calls(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """One call per key: the value all agree on, else ``CONFLICT``. Min and max, no collected set."""
    known = df.filter(F.col(value).isNotNull())
    lo, hi = F.min(value), F.max(value)
    return known.groupBy(*keys).agg(F.when(lo == hi, lo).otherwise(CONFLICT).alias("call"))


def linkable_calls(calls: DataFrame, features: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Calls that reach a feature carrying a sequence."""
    return calls.join(features.select(*keys).distinct(), list(keys), "left_semi")


# ---- event elements ---------------------------------------------------------------------------


def parse_elements(df: DataFrame, name: str = "element") -> DataFrame:
    c = F.col(name)
    return computed_once(
        df,
        df.columns,
        element_type=E.element_type(c),
        is_flank=E.is_flank(c),
        origin_organism=E.origin_organism(c),
        declared_length=E.declared_length(c),
        element_number=E.element_number(c),
    )


def event_labels(parsed: DataFrame) -> DataFrame:
    kind, flank = F.col("element_type"), F.col("is_flank")
    return parsed.select(
        "*",
        E.event_label(kind, flank).alias("event_label"),
        E.label_basis(kind, flank).alias("label_basis"),
    )


def excluded_types(labelled: DataFrame) -> DataFrame:
    return (
        labelled.filter(F.col("event_label").isNull())
        .groupBy("element_type")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("reason", E.exclusion_reason(F.col("element_type")))
    )


def declared_length_check(parsed: DataFrame, name: str = "element", seq: str = "sequence") -> DataFrame:
    """Elements whose name states another length than their sequence has; flanks are not judged."""
    return parsed.filter(
        ~F.col("is_flank") & (F.col("declared_length") != F.length(F.col(seq)))
    ).select(name, "declared_length", F.length(F.col(seq)).alias("sequence_length"))


def samples_per_element(links: DataFrame, shown: int = 8) -> DataFrame:
    """``(element, n_samples, samples)``: distinct samples counted, the first few listed.

    The list is cut on the map side before the shuffle, so an element linked to a third of all
    samples brings at most ``shown`` rows per task.
    """
    pairs = links.select("element", "sample").distinct()
    counts = pairs.groupBy("element").agg(F.count(F.lit(1)).alias("n_samples"))
    first = Window.partitionBy("element").orderBy("sample")
    listed = (
        pairs.withColumn("_rn", F.row_number().over(first))
        .filter(F.col("_rn") <= shown)
        .groupBy("element")
        .agg(F.array_join(F.sort_array(F.collect_list("sample")), "|").alias("samples"))
    )
    return counts.join(listed, "element")


def link_elements(elements: DataFrame, links: DataFrame, shown: int = 8) -> DataFrame:
    grouped = samples_per_element(links, shown)
    return elements.join(grouped, "element", "left").na.fill({"n_samples": 0, "samples": ""})


def unlinked_elements(elements: DataFrame, links: DataFrame) -> DataFrame:
    return elements.join(links.select("element").distinct(), "element", "left_anti").select("element")


def links_without_element(links: DataFrame, elements: DataFrame, shown: int | None = None) -> DataFrame:
    missing = links.select("element").distinct().join(elements.select("element"), "element", "left_anti")
    return missing if shown is None else missing.orderBy("element").limit(shown)


# ---- matched pairs ----------------------------------------------------------------------------


def pair_status(df: DataFrame, natural: str, generated: str) -> DataFrame:
    """Trim both members and add ``pair_drop``: missing, unequal length, or null for a good pair."""
    def member(name: str) -> Column:
        return trim_all(F.coalesce(F.col(name), F.lit("")))

    kept = [c for c in df.columns if c not in (natural, generated)]
    both = computed_once(df, kept, **{natural: member(natural), generated: member(generated)})
    a, b = F.length(F.col(natural)), F.length(F.col(generated))
    return both.withColumn(
        "pair_drop",
        F.when((a == 0) | (b == 0), F.lit("missing_sequence")).when(a != b, F.lit("length_mismatch")),
    )


def pair_drops(status: DataFrame) -> DataFrame:
    return status.agg(
        F.count_if(F.col("pair_drop") == "missing_sequence").alias("dropped_missing"),
        F.count_if(F.col("pair_drop") == "length_mismatch").alias("dropped_length_mismatch"),
        F.count_if(F.col("pair_drop").isNull()).alias("kept"),
    )


def content_key(df: DataFrame, cols: Sequence[str], name: str = "content_key") -> DataFrame:
    return df.withColumn(name, key_of(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols]))


def explode_pairs(df: DataFrame, natural: str, generated: str) -> DataFrame:
    """Two rows per pair: ``(member, label, sequence)`` natural 0 and generated 1."""

    def side(name: str, label: int, col: str) -> Column:
        return F.struct(
            F.lit(name).alias("member"), F.lit(label).alias("member_label"), F.col(col).alias("sequence")
        )

    shared = [c for c in df.columns if c not in (natural, generated)]
    sides = F.array(
        side("natural", 0, natural), side(generated.removesuffix("_dna"), 1, generated)
    )
    return df.select(*shared, F.inline(sides))


def union_extracts(a: DataFrame, b: DataFrame, key: str = "sample_id") -> DataFrame:
    """Two extracts of one source without their shared rows (action: finds keys that the second repeats).

    Of a key in both, the first extract's row stays, of one that the second repeats one of its rows; equal keys mean
    equal rows, and ``extract_conflicts`` lists those that do not. Only keys are aggregated, and only rows of repeated
    keys meet. Rows without a key all stay, as do the rows of the first extract.
    """
    held = a.select(F.col(key).alias("_held")).distinct()
    new = b.join(held, F.col(key) == F.col("_held"), "left_anti")
    again = new.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("_again")).agg(F.count(F.lit(1)).alias("_n"))
    again = broadcast_if_small(written(again.filter("_n > 1").select("_again")))
    same = F.col(key) == F.col("_again")
    once = new.join(again, same, "left_anti").unionByName(new.join(again, same, "left_semi").dropDuplicates([key]))
    return a.unionByName(once, allowMissingColumns=True)


def extract_conflicts(a: DataFrame, b: DataFrame, cols: Sequence[str], key: str = "sample_id") -> DataFrame:
    """Keys that name different content in the two extracts."""
    rows = a.select(key, *cols).unionByName(b.select(key, *cols))
    digest = row_digest(*[cell_text(rows, c) for c in cols])
    return (
        rows.groupBy(key)
        .agg(F.min(digest).alias("_lo"), F.max(digest).alias("_hi"))
        .filter(F.col("_lo") != F.col("_hi"))
        .select(key)
    )


# ---- small reports ----------------------------------------------------------------------------


def sample_tallies(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(attribute, value, n)`` for several attributes in one shuffle; nulls are not counted."""
    long = df.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(c).alias("attribute"), F.col(c).cast("string").alias("value"))
                    for c in columns
                ]
            )
        )
    )
    return long.filter(F.col("value").isNotNull()).groupBy("attribute", "value").agg(F.count(F.lit(1)).alias("n"))


def length_baseline(df: DataFrame, length: str, label: str) -> DataFrame:
    """Best accuracy of one length threshold (1 at or above it), 0.0 when a class is empty.

    Rows are reduced to two counts per distinct length; the running sums see only those.
    """
    by_length = df.groupBy(F.col(length).alias("len")).agg(
        F.count_if(F.col(label) == 1).alias("ones"), F.count_if(F.col(label) == 0).alias("zeros")
    )
    below = Window.orderBy("len").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    scored = by_length.select(
        F.sum("ones").over(whole).alias("all_ones"),
        F.sum("zeros").over(whole).alias("all_zeros"),
        (
            F.sum("ones").over(whole)
            - F.coalesce(F.sum("ones").over(below), F.lit(0))
            + F.coalesce(F.sum("zeros").over(below), F.lit(0))
        ).alias("right"),
    )
    best = F.bround(F.max("right") / F.max(F.col("all_ones") + F.col("all_zeros")), 4)
    both = (F.max("all_ones") > 0) & (F.max("all_zeros") > 0)
    return scored.agg(F.when(both, best).otherwise(0.0).alias("length_only_baseline_accuracy"))


def group_straddle(df: DataFrame, group: str, side: str) -> DataFrame:
    """Groups with rows on more than one side of a split."""
    return (
        df.groupBy(group)
        .agg(F.min(side).alias("_lo"), F.max(side).alias("_hi"), F.count(F.lit(1)).alias("n_rows"))
        .filter(F.col("_lo") != F.col("_hi"))
        .select(group, "n_rows")
    )


def rows_per_group(df: DataFrame, group: str) -> DataFrame:
    return df.groupBy(group).agg(F.count(F.lit(1)).alias("n_rows"))
