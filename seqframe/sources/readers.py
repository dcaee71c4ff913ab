"""Readers for the five source shapes. Every reader is a scan plus expressions; none collects."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seqframe.functions.letters import uri_fragment
from seqframe.model import require_columns
from seqframe.operators.ranking import last_of_each
from seqframe.session import broadcast_if_small, written

MALFORMED = "_malformed"
SPLITS = 100_000  # file blocks or files whose one row each may be broadcast, paths of some 20 MB

# What a nucleotide line of a FASTA file and a line of a membership list look like,
# the columns each source must have, and the prefixes of the value columns.
NUCLEOTIDE_LINE = "(?i)^[ACGTNRYSWKMBDHV]+$"
MEMBER_LINE = "^[A-Z0-9][A-Z0-9-]{3,}$"
PAIR_COLUMNS = ("protein", "organism", "GeneID", "natural_dna")
GENERATED_COLUMNS = ("finetune_dna", "base_dna")
LINK_COLUMNS = ("Sample_ID", "IF_Element")
VALUE_PREFIXES = ("bacterial_resistance_", "copy_number_", "growth_", "selectable_markers_", "species_")
MEMBERSHIP_CLASSES = 32


# ---- source order -----------------------------------------------------------------------------


def file_position() -> Column:
    """``(path, block, row)``: where a row stands; ``path_order`` of the path puts files in their order."""
    return F.struct(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )


def path_order(path: Column) -> Column:
    """What to sort paths by: a number in a name counts as a number, so part-2 comes before part-10.

    Otherwise names come in their order. It costs more than a row of a file does: apply it to files and blocks.
    """
    return F.regexp_replace(F.regexp_replace(path, r"(\d+)", "00000000000000000000$1"), r"0*(\d{20})(?!\d)", "$1")


def with_file_ordinal(df: DataFrame, at: str = "_at", name: str = "ord", places: DataFrame | None = None) -> DataFrame:
    """Replace a ``file_position`` column by the dense 0-based row number over all files (action: one
    pass over the row numbers).

    ``places`` may give the same positions from a cheaper scan of the same files, one that need not take the rows apart.

    No sort: each file block adds its row count to the blocks after it, and a row adds its index in
    its block. The running sum sees one row per block, and so does the broadcast, if they are few
    enough.
    """
    keys = ["_path", "_block"]
    parts = [F.col(f"{at}.{c}").alias(f"_{c}") for c in ("path", "block", "row")]
    marked = df.select("*", *parts).drop(at)
    sizes = (marked if places is None else places.select(*parts)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
    before = Window.orderBy("_order", *keys).rowsBetween(Window.unboundedPreceding, -1)
    ordered = sizes.withColumn("_order", path_order(F.col("_path")))
    offsets = ordered.select(*keys, "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    return (
        marked.join(broadcast_if_small(written(offsets), SPLITS), keys)
        .withColumn(name, F.col("_offset") + F.col("_row") - F.col("_first"))
        .drop(*keys, "_row", "_first", "_offset")
    )


# ---- CSV --------------------------------------------------------------------------------------


def read_csv_text(
    spark: SparkSession, path: str, *, multi_line: bool = True, mark_malformed: bool = False, **more: Any
) -> DataFrame:
    """A header CSV with every cell as text; with ``mark_malformed`` wrong-width rows are kept and marked.

    ``multi_line`` reads quoted line breaks but makes a file one task; switch it off for large files
    known to hold one record per line.
    """
    options = {"header": True, "escape": '"', "multiLine": multi_line, "enforceSchema": False} | more
    plain = spark.read.options(**options).csv(path)
    if not mark_malformed:
        return plain
    schema = T.StructType([*plain.schema.fields, T.StructField(MALFORMED, T.StringType())])
    reader = spark.read.options(
        **options, mode="PERMISSIVE", columnNameOfCorruptRecord=MALFORMED, columnPruning=False
    )
    # Spark refuses a scan of the malformed column alone, so the mark also reads (none of) the first.
    nothing = F.left(F.coalesce(F.col(f"`{plain.columns[0]}`"), F.lit("")), F.lit(0))
    return reader.schema(schema).csv(path).withColumn(MALFORMED, F.concat(MALFORMED, nothing))


def count_malformed(df: DataFrame) -> DataFrame:
    """How many rows of a marked CSV had another field count than the header."""
    return df.agg(
        F.count_if(F.col(MALFORMED).isNotNull()).alias("malformed"),
        F.count_if(F.col(MALFORMED).isNull()).alias("well_formed"),
    )


def read_pair_csv(
    spark: SparkSession, path: str, generated: str = "finetune_dna", *, multi_line: bool = True
) -> DataFrame:
    """Matched pairs, one per row, malformed rows marked for counting. Adds ``ord``."""
    if generated not in GENERATED_COLUMNS:
        raise ValueError(f"generated column must be one of {GENERATED_COLUMNS}, got {generated!r}")
    df = read_csv_text(spark, path, multi_line=multi_line, mark_malformed=True)
    require_columns(df, *PAIR_COLUMNS, generated)
    if "description" not in df.columns:
        df = df.withColumn("description", F.lit(""))
    wanted = [*PAIR_COLUMNS, "description", generated, MALFORMED]
    return with_file_ordinal(df.select(file_position().alias("_at"), *wanted)).na.fill(
        "", [c for c in wanted if c != MALFORMED]
    )


def well_formed(df: DataFrame) -> DataFrame:
    return df.filter(F.col(MALFORMED).isNull()).drop(MALFORMED)


def read_link_csv(spark: SparkSession, path: str, *, multi_line: bool = True) -> DataFrame:
    df = require_columns(read_csv_text(spark, path, multi_line=multi_line), *LINK_COLUMNS)
    return df.select(F.col("IF_Element").alias("element"), F.col("Sample_ID").alias("sample"))


def read_values_csv(
    spark: SparkSession, path: str, prefixes: Sequence[str] = VALUE_PREFIXES, *, multi_line: bool = False
) -> DataFrame:
    """Id, sequence and the value columns; other columns are pruned from the scan."""
    df = require_columns(read_csv_text(spark, path, multi_line=multi_line), "sequence_id", "sequence")
    values = [c for c in df.columns if c.startswith(tuple(prefixes))]
    picked = df.select(file_position().alias("_at"), "sequence_id", "sequence", *[F.col(f"`{c}`") for c in values])
    return with_file_ordinal(picked)


def label_vocabulary(spark: SparkSession, path: str) -> list[str]:
    """The class names: every header column but the first. Reads no row."""
    return spark.read.option("header", True).csv(path).columns[1:]


def read_one_hot(spark: SparkSession, path: str) -> DataFrame:
    header = spark.read.option("header", True).csv(path).columns
    fields = [T.StructField(header[0], T.StringType())]
    fields += [T.StructField(c, T.DoubleType()) for c in header[1:]]
    return spark.read.options(header=True, enforceSchema=False).schema(T.StructType(fields)).csv(path)


# ---- FASTA ------------------------------------------------------------------------------------


def _fasta_records(spark: SparkSession, path: str) -> DataFrame:
    """``(at, pos, headed, lines)``, one row per record.

    The reader splits at the marker, so a large file stays splittable. Only the first record of a
    file can lack a header; which record that is takes one light pass over the row numbers (action).
    """
    raw = spark.read.option("lineSep", "\n>").text(path).select(file_position().alias("at"), "value")
    opening = (
        raw.filter(F.col("at.block") == 0)
        .groupBy(F.col("at.path").alias("path"))
        .agg(F.min("at.row").alias("first_row"))
    )
    opens = (F.col("at.block") == 0) & (F.col("at.row") == F.col("first_row"))
    files = broadcast_if_small(written(opening), SPLITS)
    known = raw.withColumn("path", F.col("at.path")).join(files, "path", "left")
    # An indented marker is a header too; the reader's separator cannot see it.
    pieces = known.select(
        "at",
        F.coalesce(opens, F.lit(False)).alias("opens"),
        F.posexplode(F.split("value", r"\n[ \t\r\x0B\f]*>")).alias("pos", "text"),
    )
    lines = F.filter(F.transform(F.split("text", "\n"), _strip), lambda x: x != "")
    marked = pieces.withColumn("opens", F.col("opens") & (F.col("pos") == 0)).withColumn("lines", lines)
    own_marker = F.startswith(F.get("lines", F.lit(0)), F.lit(">"))
    return marked.select(
        "at",
        "pos",
        (~F.col("opens") | F.coalesce(own_marker, F.lit(False))).alias("headed"),
        F.col("opens").alias("opens"),
        "lines",
    )


def _strip(text: Column) -> Column:
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def read_fasta(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """``(element, sequence)`` and the quarantined lines.

    A line that is neither a header nor nucleotides ends its record; it is quarantined and what
    follows it up to the next header belongs to nothing. Of a repeated header the last record counts.
    """
    records = _fasta_records(spark, path)
    first = F.coalesce(F.get("lines", F.lit(0)), F.lit(""))
    name = F.when(F.col("opens"), _strip(F.regexp_replace(first, "^>", ""))).otherwise(first)
    body = F.when(F.col("headed"), F.slice("lines", 2, F.greatest(F.size("lines"), F.lit(1)))).otherwise(F.col("lines"))
    marked = records.select("at", "pos", "headed", name.alias("element"), body.alias("body")).withColumn(
        "first_bad",
        F.array_position(F.transform("body", lambda x: x.rlike(NUCLEOTIDE_LINE)), False).cast("int"),
    )
    good = F.when(F.col("first_bad") > 0, F.slice("body", F.lit(1), F.col("first_bad") - 1)).otherwise(F.col("body"))
    sequences = (
        marked.filter("headed")
        .select("element", F.array_join(good, "").alias("sequence"), F.struct(path_order(F.col("at.path")).alias("order"), "at", "pos").alias("at"))
    )
    sequences = last_of_each(sequences, "element", "at").drop("at")
    junk = marked.select(F.explode(F.filter("body", lambda x: ~x.rlike(NUCLEOTIDE_LINE))).alias("line"))
    return sequences, junk.select("line")


# ---- nested evidence --------------------------------------------------------------------------

EVIDENCE_SCHEMA = """
features ARRAY<STRUCT<id: STRING, name: STRING, sequence: STRING, role: STRING, source: STRING,
  sourceStart: STRING, sourceEnd: STRING, sourceOrientation: STRING>>,
detections ARRAY<STRUCT<agent: STRING, sample: STRING, engineered: STRING,
  contigs: ARRAY<STRUCT<source: STRING,
    regions: ARRAY<STRUCT<start: STRING, `end`: STRING, feature: STRING, engineered: STRING>>>>,
  alterations: ARRAY<STRUCT<derivedFeature: STRING, engineered: STRING>>>>
"""


def read_evidence_json(spark: SparkSession, path: str, *, multi_line: bool = True) -> DataFrame:
    """Nested documents; ``file`` names the document and is part of every key.

    One document per file, named by the file; without ``multi_line`` one per line, named by its file and place and
    written once (action), so that every reader meets the same name. A file for each document costs a scan far more than
    its bytes: keep many documents in lines.
    """
    found = spark.read.schema(EVIDENCE_SCHEMA).option("multiLine", multi_line).json(path)
    name = F.col("_metadata.file_name")
    if multi_line:
        return found.select(name.alias("file"), "features", "detections")
    place = F.monotonically_increasing_id().cast("string")
    return written(found.select(F.concat_ws("#", name, place).alias("file"), "features", "detections"))


def evidence_features(documents: DataFrame) -> DataFrame:
    """Features that carry a sequence."""
    return documents.select("file", F.inline("features")).filter(F.col("sequence").isNotNull())


def evidence_detections(documents: DataFrame) -> DataFrame:
    flat = documents.select("file", F.explode("detections").alias("d"))
    return flat.select("file", F.col("d.sample").alias("sample"), uri_fragment(F.col("d.engineered")).alias("call"))


def evidence_calls(documents: DataFrame) -> DataFrame:
    """``(file, id, call)``: every call made on a region's or an alteration's feature."""
    d = documents.select("file", F.explode("detections").alias("d"))
    empty = F.array().cast("array<struct<feature:string,call:string>>")
    regions = F.flatten(
        F.transform(
            F.col("d.contigs"),
            lambda c: F.coalesce(
                F.transform(
                    c["regions"],
                    lambda r: F.struct(r["feature"].alias("feature"), r["engineered"].alias("call")),
                ),
                empty,
            ),
        )
    )
    altered = F.transform(
        F.col("d.alterations"),
        lambda a: F.struct(a["derivedFeature"].alias("feature"), a["engineered"].alias("call")),
    )
    both = F.concat(F.coalesce(regions, empty), F.coalesce(altered, empty))
    return (
        d.select("file", F.inline(both))
        .filter(F.col("feature").isNotNull() & F.col("call").isNotNull())
        .select("file", F.col("feature").alias("id"), uri_fragment(F.col("call")).alias("call"))
    )


# ---- membership lists -------------------------------------------------------------------------


def _list_name() -> tuple[Column, Column]:
    """``(class, file)``: the folder ``class=<name>`` that a list lies in, or else the file name before ``_v``."""
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    folder, file = F.regexp_extract(path, "/class=([^/]*)/[^/]*$", 1), F.col("_metadata.file_name")
    name = F.when(folder != "", folder).otherwise(F.substring_index(file, "_v", 1))
    return name, F.when(folder != "", folder).otherwise(file)


def read_membership_lists(spark: SparkSession, path: str) -> DataFrame:
    """``(class, id, file)``: one file per class, or one folder ``class=<name>``, one id per line."""
    name, file = _list_name()
    lines = spark.read.option("recursiveFileLookup", True).text(path)
    rows = lines.select(name.alias("class"), F.trim(F.col("value")).alias("id"), file.alias("file"))
    return rows.filter(F.col("id") != "")


def membership_list_problems(spark: SparkSession, path: str) -> DataFrame:
    """``(file, problem)`` of lists that are empty or hold a line that is no member id."""
    lines = read_membership_lists(spark, path)
    seen = lines.groupBy("file").agg(
        F.min(F.when(~F.col("id").rlike(MEMBER_LINE), F.col("id"))).alias("offender")
    )
    # The content is not read; a file's name is enough.
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    files = files.select(_list_name()[1].alias("file")).distinct()
    return (
        files.join(seen.withColumn("seen", F.lit(True)), "file", "left")
        .select("file", F.when(F.col("seen").isNull(), F.lit("<empty file>")).otherwise(F.col("offender")).alias("problem"))
        .filter(F.col("problem").isNotNull())
    )


def require_membership_lists(spark: SparkSession, path: str, classes: int = MEMBERSHIP_CLASSES) -> DataFrame:
    """The lists, refused when one is malformed or fewer than ``classes`` are there (action)."""
    problems = membership_list_problems(spark, path).orderBy("file").take(1)
    if problems:
        raise ValueError(f"{problems[0].file} is not a membership list: it holds {problems[0].problem!r}")
    members = read_membership_lists(spark, path)
    return require_class_count(members, classes)


def require_class_count(members: DataFrame, classes: int = MEMBERSHIP_CLASSES) -> DataFrame:
    found = members.agg(F.count_distinct("class").alias("n")).first().n
    if found < classes:
        raise ValueError(f"{found} of {classes} classes: a missing one would look like a column of zeros")
    return members


def read_sequence_dict(spark: SparkSession, path: str) -> DataFrame:
    """``id<TAB>sequence`` lines; lines without a tab are skipped, the last entry of an id counts."""
    lines = spark.read.text(path).select("value", file_position().alias("at")).filter(F.contains("value", F.lit("\t")))
    pair = F.split("value", "\t", 2)
    entries = lines.select(pair[0].alias("id"), pair[1].alias("sequence"), F.struct(path_order(F.col("at.path")).alias("order"), "at").alias("at"))
    return last_of_each(entries, "id", "at").drop("at")
