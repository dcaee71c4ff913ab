"""The five labelled sources as lazy datasets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seqframe.functions import labels as B
from seqframe.functions import letters as L
from seqframe.model import KEY, Alphabet, Dataset, require_columns
from seqframe.operators import linking as K
from seqframe.operators import ranking as R
from seqframe.session import broadcast_if_small


def _meaning(spark: SparkSession, pairs: Mapping[int, str]) -> DataFrame:
    return spark.createDataFrame(sorted(pairs.items()), "value INT, meaning STRING")


def _cap(df: DataFrame, order: Sequence[str], n: int | None) -> DataFrame:
    return df if n is None else R.capped(df, order, n)


def pairs_dataset(
    rows: DataFrame, generated: str = "finetune_dna", max_pairs: int | None = None, name: str = "matched_pairs"
) -> Dataset:
    """Matched pairs: natural 0, generated 1, two rows per source row.

    ``rows`` is ``(ord, protein, organism, GeneID, description, natural_dna, <generated>)``. Pair ids
    come from the content of the row; a repeated content gets a counter in source order.
    """
    require_columns(rows, "ord", "protein", "organism", "GeneID", "natural_dna", generated)
    if "description" not in rows.columns:
        rows = rows.withColumn("description", F.lit(""))
    status = K.pair_status(_cap(rows, ["ord"], max_pairs), "natural_dna", generated)
    kept = status.filter(F.col("pair_drop").isNull()).drop("pair_drop")
    keyed = K.content_key(kept, ["organism", "GeneID", "description", "natural_dna"])
    numbered = R.repeat_counter(keyed, "content_key", ["ord"])
    suffix = F.when(F.col("repeat") == 0, "").otherwise(F.concat(F.lit("_"), F.col("repeat").cast("string")))
    named = numbered.withColumn("pair_id", F.concat(F.lit("ct_"), F.col("content_key"), suffix))
    members = K.explode_pairs(named, "natural_dna", generated)
    metadata = F.struct(
        "pair_id",
        "member",
        "organism",
        F.col("GeneID").alias("gene_id"),
        F.length("protein").alias("protein_length"),
        "description",
    )
    df = members.select(
        F.concat_ws("__", "pair_id", "member").alias(KEY),
        "sequence",
        F.array("member_label").alias("label"),
        F.lit(name).alias("source"),
        metadata.alias("metadata"),
        F.struct(F.col("ord").alias("row"), F.col("member_label").alias("member")).alias("ord"),
    )
    return Dataset(
        df=df,
        name=name,
        alphabet=Alphabet.DNA_NUCLEOTIDE,
        semantics=_meaning(rows.sparkSession, {0: "natural sequence", 1: f"generated sequence ({generated})"}),
        target_description="0 natural, 1 the generator's version of the same protein",
        stats={"pair_drops": K.pair_drops(status)},
    )


def membership_dataset(
    members: DataFrame,
    sequences: DataFrame,
    classes: Sequence[str],
    max_records: int | None = None,
    alphabet: Alphabet = Alphabet.AMINO_ACID,
    name: str = "membership",
) -> Dataset:
    """Multi-label set over every class, positive-only: 0 means not listed, not a verified negative.

    ``members`` is ``(class, id)`` list lines and ``sequences`` is ``(id, sequence)`` with unique ids.
    A cap walks the classes in turn so that none drops out.
    """
    ordered = sorted(classes)
    sets = K.classes_per_member(members)
    if max_records is None:
        wanted = sets.withColumn("ord", F.struct(F.lit(0).cast("bigint").alias("depth"), F.col("id").alias("turn")))
    else:
        chosen = R.round_robin_cap(members, max_records)
        turn = F.struct(F.col("depth"), F.col("class").alias("turn"))
        wanted = sets.join(chosen.select("id", turn.alias("ord")), "id")
    found = K.resolved_members(wanted, sequences)
    df = found.select(
        F.col("id").alias(KEY),
        "sequence",
        B.label_vector(F.col("classes"), ordered).alias("label"),
        F.lit(name).alias("source"),
        F.struct(
            F.col("id").alias("accession"),
            L.pipe_join(F.col("classes")).alias("classes"),
            F.size("classes").alias("n_classes"),
        ).alias("metadata"),
        "ord",
    )
    missing = K.unresolved_members(wanted.select("id"), sequences)
    return Dataset(
        df=df,
        name=name,
        alphabet=alphabet,
        semantics=_meaning(members.sparkSession, {0: "not listed for this class", 1: "listed for this class"}),
        n_targets=len(ordered),
        target_names=tuple(ordered),
        target_description="one 0/1 target per class, positive-only",
        stats={
            "lines_per_class": K.members_per_class(members),
            "positives_per_class": K.positives_per_class(df, ordered),
            "unresolved": missing,
        },
    )


def event_signature_dataset(
    sequences: DataFrame, links: DataFrame, max_records: int | None = None, name: str = "event_signatures"
) -> Dataset:
    """Introduced 1 against removed or flanking 0; other event types are excluded and counted.

    ``sequences`` is ``(element, sequence)``, ``links`` is ``(element, sample)``.
    """
    parsed = K.parse_elements(sequences.select("element", "sequence"))
    labelled = K.event_labels(parsed)
    usable = labelled.filter(F.col("event_label").isNotNull())
    if max_records is not None:
        chosen = R.balanced_cap(usable, "event_label", "element", max_records)
        usable = usable.join(broadcast_if_small(chosen.select("element", "rank")), "element")
        order: Column = F.struct("rank", "event_label")
    else:
        order = F.struct(F.col("element").alias("rank"), "event_label")
    linked = K.link_elements(usable, links)
    df = linked.select(
        F.col("element").alias(KEY),
        "sequence",
        F.array("event_label").alias("label"),
        F.lit(name).alias("source"),
        F.struct(
            F.col("element").alias("if_element"),
            "element_type",
            F.col("is_flank").cast("int").alias("is_flank"),
            "label_basis",
            F.col("origin_organism").alias("element_origin_organism"),
            F.col("n_samples").alias("n_samples_containing"),
            F.col("samples").alias("samples_containing"),
            F.col("element_number").alias("if_element_number"),
        ).alias("metadata"),
        order.alias("ord"),
    )
    spark = sequences.sparkSession
    return Dataset(
        df=df,
        name=name,
        alphabet=Alphabet.DNA_NUCLEOTIDE,
        semantics=_meaning(
            spark,
            {0: "context not introduced by the recorded event", 1: "introduced by the recorded event"},
        ),
        target_description="relative to one recorded event; says nothing about where a sequence began",
        stats={
            "excluded_types": K.excluded_types(labelled),
            "class_counts": usable.groupBy("event_label").agg(F.count(F.lit(1)).alias("n")),
            "length_baseline": K.length_baseline(
                usable.select(F.length("sequence").alias("len"), "event_label"), "len", "event_label"
            ),
            "without_link": K.unlinked_elements(usable, links),
            "length_disagreements": K.declared_length_check(parsed),
            "links_without_sequence": K.links_without_element(links, sequences),
        },
    )


def evidence_roles_dataset(
    features: DataFrame,
    calls: DataFrame,
    detections: DataFrame | None = None,
    max_records: int | None = None,
    name: str = "part_roles",
) -> Dataset:
    """Part role of every annotated feature. Calls are carried for audit and are never the label.

    ``features`` is ``(file, id, name, sequence, role, source, sourceStart, sourceEnd,
    sourceOrientation)``, ``calls`` is ``(file, id, call)``. Classes are numbered over all features,
    before any cap.
    """
    roled = features.filter(F.coalesce(F.col("role"), F.lit("")) != "")
    classes = K.class_index(roled, "role")
    resolved = K.resolve_calls(calls, ["file", "id"], "call")
    picked = _cap(roled, ["file", "id"], max_records)
    joined = K.with_class_index(picked, classes, "role").join(resolved, ["file", "id"], "left")
    blank = F.lit("")
    df = joined.select(
        L.compose_id(F.col("file"), F.col("id")).alias(KEY),
        "sequence",
        F.array("index").alias("label"),
        F.lit(name).alias("source"),
        F.struct(
            F.coalesce("name", blank).alias("feature_name"),
            F.col("role").alias("part_role"),
            F.coalesce("source", blank).alias("sequence_source"),
            F.coalesce("sourceStart", blank).alias("source_start"),
            F.coalesce("sourceEnd", blank).alias("source_end"),
            L.uri_fragment(F.coalesce("sourceOrientation", blank)).alias("source_orientation"),
            F.coalesce("call", blank).alias("call_not_ground_truth"),
        ).alias("metadata"),
        F.struct("file", "id").alias("ord"),
    )
    stats = {
        "class_map": classes,
        "calls": resolved,
        "call_distribution": call_distribution(resolved, features),
        "rows_with_a_call": K.linkable_calls(resolved, roled, ["file", "id"]).agg(F.count(F.lit(1)).alias("n")),
    }
    if detections is not None:
        stats["census"] = evidence_census(features, resolved, detections)
        stats["detection_calls"] = detection_calls(detections)
    return Dataset(
        df=df,
        name=name,
        alphabet=Alphabet.DNA_NUCLEOTIDE,
        semantics=classes.select(
            F.col("index").alias("value"), F.concat(F.col("role"), F.lit(": kind of part")).alias("meaning")
        ),
        target_description="annotated part role; not a statement of origin",
        stats=stats,
    )


def call_distribution(resolved: DataFrame, features: DataFrame) -> DataFrame:
    """Calls that reach a sequence, by value."""
    return (
        K.linkable_calls(resolved, features, ["file", "id"]).groupBy("call").agg(F.count(F.lit(1)).alias("n"))
    )


def detection_calls(detections: DataFrame) -> DataFrame:
    return detections.filter(F.col("call").isNotNull()).groupBy("call").agg(F.count(F.lit(1)).alias("n"))


def evidence_census(features: DataFrame, resolved: DataFrame, detections: DataFrame) -> DataFrame:
    """``(measure, n)`` over the whole corpus."""
    per_feature = features.agg(
        F.count(F.lit(1)).alias("features_with_sequence"),
        F.coalesce(F.sum(F.length("sequence").cast("bigint")), F.lit(0)).alias("total_bp"),
    )
    per_detection = detections.agg(
        F.count(F.lit(1)).alias("detections"),
        F.count_distinct(F.when(F.col("sample") != "", F.col("sample"))).alias("distinct_samples"),
    )
    linked = K.linkable_calls(resolved, features, ["file", "id"]).agg(
        F.count(F.lit(1)).alias("features_linkable_to_a_call")
    )
    return _melt(per_feature).unionByName(_melt(per_detection)).unionByName(_melt(linked))


def _melt(one_row: DataFrame) -> DataFrame:
    cells = [F.struct(F.lit(c).alias("measure"), F.col(c).cast("bigint").alias("n")) for c in one_row.columns]
    return one_row.select(F.inline(F.array(*cells)))


def attribution_dataset(
    values: DataFrame,
    one_hot: DataFrame,
    pooled: str | None = None,
    max_records: int | None = None,
    name: str = "attribution",
) -> Dataset:
    """Which class a sequence is attributed to, from a one-hot label table.

    ``values`` is ``(ord, sequence_id, sequence, …)``; the other columns go to the sidecar. The class
    vocabulary is the header of ``one_hot``, whatever the cap. Duplicate ids are refused (action).
    """
    repeated = R.duplicate_summary(values, "sequence_id").first()
    if repeated.n_duplicated:
        raise ValueError(f"{repeated.n_duplicated} sequence_id value(s) repeat, e.g. {repeated.examples}")
    id_col = one_hot.columns[0]
    vocabulary = sorted(c for c in one_hot.columns if c != id_col)
    spark = values.sparkSession
    classes = spark.createDataFrame(list(enumerate(vocabulary)), "index INT, class STRING")
    collapsed = K.collapse_one_hot(one_hot, id_col).withColumnRenamed(id_col, "sequence_id")
    picked = _cap(values, ["ord"], max_records)
    joined = picked.join(collapsed, "sequence_id").join(broadcast_if_small(classes), "class")
    extra = [c for c in values.columns if c not in ("ord", "sequence_id", "sequence")]
    flag = B.pooled_class_flag(F.col("class"), pooled) if pooled else F.lit(0)
    df = joined.select(
        F.col("sequence_id").alias(KEY),
        "sequence",
        F.array("index").alias("label"),
        F.lit(name).alias("source"),
        F.struct(
            F.col("class").alias("lab_id"),
            flag.alias("is_pooled_unknown_lab"),
            *[F.col(f"`{c}`") for c in extra],
        ).alias("metadata"),
        "ord",
    )
    pooled_note = F.when(F.col("class") == F.lit(pooled or ""), F.lit(": pooled, class unknown")).otherwise("")
    return Dataset(
        df=df,
        name=name,
        alphabet=Alphabet.DNA_NUCLEOTIDE,
        semantics=classes.select(F.col("index").alias("value"), F.concat("class", pooled_note).alias("meaning")),
        target_description="class of origin; every class is an origin, none means natural",
        stats={"class_map": classes, "collapsed": collapsed},
    )
