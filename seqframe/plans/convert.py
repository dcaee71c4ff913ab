"""Clean, encode, place and write: the one path every dataset takes."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, replace
from datetime import UTC, datetime
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqframe.functions import digests as D
from seqframe.functions.labels import checked_label
from seqframe.functions.tokens import pad_text, tokens_of
from seqframe.model import (
    CIPHER,
    ENCODING_MODE,
    KEY,
    PAD_TOKEN,
    SIDECAR_COLUMNS,
    TABLE_FORMAT,
    TABLE_VERSION,
    Dataset,
    LengthPolicy,
    Options,
)
from seqframe.operators import cleaning, placement
from seqframe.operators import quality as Q
from seqframe.operators.projection import target_slugs
from seqframe.operators.ranking import dense, in_order
from seqframe.session import freeing_shuffles, leaving_result, scratch, written
from seqframe.sources import tables

TABLE_COLUMNS = ("ord", KEY, "target", "tokens")


@dataclass(frozen=True)
class Converted:
    """Lazy results of one conversion; ``rows`` holds the table and its sidecar side by side."""

    dataset: Dataset
    options: Options
    cleaned: DataFrame
    rows: DataFrame
    is_cleaned_once: bool = False

    def materialized(self) -> Converted:
        """The same with its rows written once to the shared folder (action)."""
        return replace(self, rows=written(self.rows, "zstd"))

    def cleaned_once(self) -> Converted:
        """The same with its source read and cleaned once, then its rows placed and written in order (action, the first time).

        Tokens are made when the slices are in order, and digests by who reads the rows: letters compress, digests do not.
        ``_at`` is a row's place.
        """
        if self.is_cleaned_once:
            return self
        cleaned, opts = written(self.cleaned, "zstd"), self.options
        placed = in_order(_placed(self.dataset, opts, cleaned).drop("slice_digest", "tokens"), ["ord"])
        rows = written(placed.withColumn("tokens", tokens_of(pad_text(F.col("slice"), opts.width))), "zstd")
        digest = D.text_digest(F.col("slice"), opts.digest)
        return replace(self, cleaned=cleaned, rows=rows.withColumn("slice_digest", digest), is_cleaned_once=True)

    @property
    def table(self) -> DataFrame:
        return self.rows.select(*TABLE_COLUMNS)

    @property
    def samples(self) -> DataFrame:
        return samples_of(self.rows, self.dataset.metadata_fields)

    @property
    def quarantine(self) -> DataFrame:
        return cleaning.quarantine_table(self.cleaned)

    @property
    def report(self) -> DataFrame:
        return cleaning.cleaning_report(self.cleaned)

    @property
    def ambiguity(self) -> DataFrame:
        return cleaning.ambiguity_profile(self.cleaned, self.dataset.alphabet)

    @property
    def totals(self) -> DataFrame:
        return placement.conversion_totals(self.rows)

    @property
    def profile(self) -> DataFrame:
        """What a manifest would declare about the two tables, from one pass over ``rows``."""
        samples = self.samples
        # From the slice, not the tokens: what the encoder should have written, not what it wrote.
        row = Q.table_row_digest(self.table, pad_text(F.col("slice"), self.options.width))
        place, *cells = [_nested(samples, self.rows, c) for c in samples.columns]
        side = D.row_digest(place, D.row_digest(*cells))
        hashed = self.rows.select(row.alias("_t"), side.alias("_s"))
        n = F.count(F.lit(1))
        return hashed.agg(
            n.alias("n_samples"),
            F.lit(self.options.width).cast("bigint").alias("n_features"),
            F.lit(self.dataset.n_targets).cast("bigint").alias("n_targets"),
            n.alias("samples_n_rows"),
            D.combined_digest("_t").alias("content_hash"),
            D.combined_digest("_s").alias("samples_content_hash"),
            F.lit(self.options.digest).alias("slice_digest_algorithm"),
        )


def _nested(samples: DataFrame, rows: DataFrame, name: str) -> Column:
    """A sidecar cell's digest text, read from ``rows`` where it may sit inside ``metadata``."""
    if name in rows.columns:
        return D.cell_text(rows, name)
    flat = F.col(f"metadata.`{name}`")
    kind = samples.schema[name].dataType.typeName()
    return F.array_join(flat.cast("array<string>"), ",", "null") if kind == "array" else flat.cast("string")


def samples_of(rows: DataFrame, metadata_fields: list[str]) -> DataFrame:
    return rows.select("ord", *SIDECAR_COLUMNS, *[F.col(f"metadata.`{f}`").alias(f) for f in metadata_fields])


def convert(dataset: Dataset, options: Options = Options()) -> Converted:
    """Lazy and narrow from source to placed rows: no shuffle before the sink.

    Quarantine is decided before the label is looked at, so an unlabelled unusable sequence is
    quarantined and only an unlabelled usable one is an error.
    """
    cleaned = cleaning.clean_sequence(dataset.df, dataset.alphabet, rna_to_dna=dataset.rna_to_dna)
    return Converted(dataset, options, cleaned, _placed(dataset, options, cleaned))


def _placed(dataset: Dataset, options: Options, cleaned: DataFrame) -> DataFrame:
    label = checked_label(F.col("label"), dataset.n_targets, F.col(KEY).cast("string"))
    carried = ["source"] + (["metadata"] if "metadata" in cleaned.columns else [])
    ready = cleaned.filter(F.col("reason").isNull()).select(
        KEY, *[c for c in dataset.order if c != KEY], *carried, "original_length", label.alias("target"), "sequence"
    )
    # Windowing renames the key, so order by the parent's key where the key is the order.
    placed = placement.place(
        ready,
        options.width,
        options.policy,
        options.stride,
        options.max_windows_per_sample,
        digest=options.digest,
    )
    order = ["parent_sample_id" if c == KEY else c for c in dataset.order]
    return placed.withColumn("ord", _place(order, options))


def _place(order: list[str], options: Options) -> Column:
    if options.policy is LengthPolicy.PAD_OR_TRUNCATE and len(order) == 1:
        return F.col(order[0])
    return F.struct(*order, "window_index")


def write_dataset(
    converted: Converted,
    path: str,
    *,
    fmt: str = "csv",
    config_hash: str = "",
    extra: Mapping[str, Any] | None = None,
    compression: str | None = None,
) -> dict[str, Any]:
    """Guard, write, digest what was written, and write the manifest last (action).

    The source is cleaned and its rows are placed once, into the shared folder; every later step reads
    the columns it needs from there, and they go when the dataset is written. ``compression`` names the codec of a
    CSV's files, none by default; the readers tell it from the file's name.
    """
    ds, opts = converted.dataset, converted.options
    spark = ds.df.sparkSession
    with scratch(spark), freeing_shuffles(spark):
        converted = converted.cleaned_once()
        table, samples = converted.table, converted.samples
        n_rows = tables.refuse_bad_table(table, opts.width, ds.n_targets, ds.semantics)

        parts = tables.file_count(table, n_rows, opts.width if compression else None)
        tables.write_wide_table(table, f"{path}/table", opts.width, ds.n_targets, fmt=fmt, parts=parts, compression=compression)
        tables.write_samples(samples, f"{path}/samples", fmt=fmt, parts=parts, compression=compression)
        converted.quarantine.write.parquet(f"{path}/quarantine")
        _write_semantics(ds, path)

        payload = {
            "format": TABLE_FORMAT,
            "version": TABLE_VERSION,
            "columns": tables.columns_block(opts.width, ds.n_targets),
            "manifest": _manifest(converted, fmt, config_hash, extra) | {"n_samples": n_rows},
        }
        payload["manifest"] |= _digests(converted, fmt)
        tables.write_manifest(spark, payload, f"{path}/manifest")
    return payload


def _write_semantics(ds: Dataset, path: str) -> None:
    semantics = ds.semantics
    if semantics is None:
        semantics = ds.df.sparkSession.createDataFrame([], "value INT, meaning STRING")
    semantics.select(F.col("value").cast("int"), "meaning").write.parquet(f"{path}/semantics")


def _side_digest(rows: DataFrame, names: list[str], fmt: str) -> DataFrame:
    """``rows`` with ``_side``, the digest of a sidecar row's cells as they stand on disk."""
    flat = rows.select("*", *[_source(rows, c).alias(f"_c_{c}") for c in names])
    cells = [tables.csv_text(f"_c_{c}") if fmt == "csv" else D.cell_text(flat, f"_c_{c}") for c in names]
    return flat.withColumn("_side", D.row_digest(*cells)).drop(*[f"_c_{c}" for c in names])


def _digests(converted: Converted, fmt: str) -> dict[str, Any]:
    """Digests of the table and the sidecar as they should stand on disk, in one pass: written rows know their place."""
    rows = dense(converted.rows, "_place")
    body = Q.table_body_digest(rows, pad_text(F.col("slice"), converted.options.width))
    names = [c for c in converted.samples.columns if c != "ord"]
    flat = _side_digest(rows.withColumn("_body", body), names, fmt)
    place = F.col("_place").cast("string")
    both = flat.select(D.row_digest(place, F.col("_body")).alias("_d"), D.row_digest(place, F.col("_side")).alias("_s"))
    found = both.agg(D.combined_digest("_d").alias("d"), D.combined_digest("_s").alias("s"), F.count(F.lit(1)).alias("n")).first()
    return {"content_hash": found.d, "samples_content_hash": found.s, "samples_n_rows": found.n}


def _source(rows: DataFrame, name: str) -> Column:
    return F.col(f"`{name}`") if name in rows.columns else F.col(f"metadata.`{name}`")


def _manifest(
    converted: Converted, fmt: str, config_hash: str, extra: Mapping[str, Any] | None
) -> dict[str, Any]:
    ds, opts = converted.dataset, converted.options
    windowed = opts.policy is LengthPolicy.WINDOW
    totals = converted.totals.first().asDict()
    counted = cleaning.full_report(converted.cleaned, ds.alphabet).first().asDict()
    letters = {k: v for k, v in counted.items() if k.startswith("ambiguity_")}
    return {
        "source": ds.name,
        "source_url": ds.source_url,
        "licence": ds.licence,
        "target_description": ds.target_description,
        "target_names": list(ds.target_names),
        "semantics_table": "semantics",
        "alphabet": ds.alphabet.value,
        "encoding_mode": ENCODING_MODE,
        "encoding": {"cipher": CIPHER, "padding_token": PAD_TOKEN, "reversible": True},
        "window": {
            "policy": opts.policy.value,
            "length": opts.width,
            "stride": opts.stride if windowed else None,
            "max_windows_per_sample": opts.max_windows_per_sample,
            "windows_dropped_by_cap": totals["windows_dropped"],
            "residues_dropped_by_cap": totals["residues_dropped_by_window_cap"],
            "residues_removed_by_truncation": totals["residues_removed_by_truncation"],
        },
        "cleaning": {k: v for k, v in counted.items() if k not in letters}
        | {"ambiguity_counts": {k.removeprefix("ambiguity_"): n for k, n in letters.items() if n}},
        "n_features": opts.width,
        "n_targets": ds.n_targets,
        "slice_digest_algorithm": opts.digest,
        "table_format": fmt,
        "config_hash": config_hash,
        "generated_at": datetime.now(UTC).isoformat(),
        **(dict(extra) if extra else {}),
    }


def write_projected(
    converted: Converted,
    path: str,
    *,
    fmt: str = "csv",
    config_hash: str = "",
    extra: Mapping[str, Any] | None = None,
    compression: str | None = None,
) -> DataFrame:
    """Write one single-target dataset per target under ``path`` (action); returns ``(slug, manifest)`` rows.

    Three writes fan out to all targets: tables, sidecars and manifests, each a folder per slug. The digests of all
    targets are added up in one pass over digests that were given their place once, so there is no job per target.
    Each manifest has the projection block that binds it to the others. ``compression`` is that of ``write_dataset``.
    """
    spark = converted.dataset.df.sparkSession
    with freeing_shuffles(spark):
        return leaving_result(spark, lambda: _projected_files(converted, path, fmt, config_hash, extra, compression))


def _projected_files(converted: Converted, path: str, fmt: str, config_hash: str, extra: Mapping[str, Any] | None, compression: str | None) -> DataFrame:
    ds, opts = converted.dataset, converted.options
    if ds.n_targets < 2 or len(ds.target_names) != ds.n_targets:
        raise ValueError(f"projecting needs several targets with a name each, got {ds.n_targets} and {len(ds.target_names)}")
    spark = ds.df.sparkSession
    slugs = target_slugs(spark, ds.target_names)
    converted = converted.cleaned_once()
    table, samples = converted.table, converted.samples
    n_rows = tables.refuse_bad_table(table, opts.width, ds.n_targets, ds.semantics)

    parts = tables.file_count(table, n_rows, opts.width if compression else None)
    tables.write_per_target(table, ds.target_names, f"{path}/table", opts.width, fmt=fmt, parts=parts, compression=compression)
    tables.write_samples_per_target(samples, slugs, f"{path}/samples", fmt=fmt, parts=parts, compression=compression)
    converted.quarantine.write.parquet(f"{path}/quarantine")
    _write_semantics(ds, path)

    block = _projection_blocks(converted, slugs, fmt, n_rows)
    common = _manifest(converted, fmt, config_hash, extra) | {"n_samples": n_rows, "n_targets": 1, "target_names": []}
    head = {"format": TABLE_FORMAT, "version": TABLE_VERSION, "columns": tables.columns_block(opts.width, 1)}
    before = f'{tables.manifest_text(head)[:-1]}, "manifest": {tables.manifest_text(common)[:-1]}, '
    fields = ("content_hash", "samples_content_hash", "samples_n_rows", "target_projection")
    text = F.concat(F.lit(before), F.substring(F.to_json(F.struct(*fields)), 2, 1 << 30), F.lit("}"))
    manifests = written(block.select("slug", text.alias("value")))
    manifests.write.partitionBy("slug").text(f"{path}/manifest")
    return manifests.withColumnRenamed("value", "manifest")


def _projection_blocks(converted: Converted, slugs: list[str], fmt: str, n_rows: int) -> DataFrame:
    """One row per target: its digests and its projection block."""
    rows, ds = converted.rows, converted.dataset
    tokens = pad_text(F.col("slice"), converted.options.width)
    names = [c for c in converted.samples.columns if c != "ord"]
    placed = _side_digest(dense(rows.withColumn("_tokens", tokens), "_place"), names, fmt)
    place, key = F.col("_place").cast("string"), D.cell_text(rows, KEY)
    long = placed.select(KEY, "_tokens", place.alias("_place"), D.row_digest(place, F.col("_side")).alias("_s"), F.posexplode("target").alias("i", "value"))
    value = F.col("value").cast("string")
    hashed = long.select(
        "i", "_s",
        D.row_digest(F.col("_place"), D.row_digest(key, value, F.col("_tokens"))).alias("_d"),
        D.row_digest(F.col("_place"), key, value).alias("_t"),
    )
    per = hashed.groupBy("i").agg(
        D.combined_digest("_d").alias("content_hash"),
        D.combined_digest("_s").alias("samples_content_hash"),
        D.combined_digest("_t").alias("target_hash"),
        F.count(F.lit(1)).alias("samples_n_rows"),
    )
    # One row per target, and on each the hashes of all.
    every = F.collect_list(F.struct("i", "target_hash")).over(Window.partitionBy(F.lit(0)))
    per = per.withColumn("hashes", F.transform(F.sort_array(every), lambda t: t["target_hash"]))
    listed = [F.array(*[F.lit(v) for v in values]) for values in (ds.target_names, slugs)]
    projection = F.struct(
        F.col("i").alias("original_target_index"),
        listed[0][F.col("i")].alias("original_target_name"),
        listed[1][F.col("i")].alias("original_target_slug"),
        F.lit(ds.n_targets).alias("original_target_count"),
        listed[0].alias("source_target_names"),
        listed[1].alias("source_target_slugs"),
        F.col("hashes").alias("source_target_hashes"),
        F.lit(D.ALGORITHM).alias("source_target_hash_algorithm"),
        F.lit(n_rows).cast("bigint").alias("source_row_count"),
    )
    return per.withColumn("target_projection", projection).withColumn("slug", listed[1][F.col("i")])


def run_inventory(
    spark,
    table_paths: list[str],
    *,
    complete: bool,
    profile: str,
    target_layout: str,
    config_hash: str,
    enabled: list[str],
    converted: list[str],
    gated: list[str],
) -> tuple[DataFrame, DataFrame]:
    """``(run, tables)``: one row describing a run, and the content hash of each dataset it made.

    All manifests are read in one scan.
    """
    given = spark.createDataFrame([(p,) for p in sorted(table_paths)], "path STRING").withColumn("_place", tables.bare_path(F.col("path")))
    if table_paths:
        found = tables.scanned_manifests(spark, [tables.part_of(p, "manifest") for p in sorted(table_paths)])
        hashed = found.select(tables.bare_path(F.col("path")).alias("_place"), F.get_json_object("value", "$.manifest.content_hash").alias("content_hash"))
        children = given.join(hashed, "_place").select("path", "content_hash")
    else:
        children = given.select("path", F.lit(None).cast("string").alias("content_hash"))
    run = spark.createDataFrame(
        [(complete, profile, target_layout, config_hash, enabled, converted, gated, len(table_paths))],
        "complete BOOLEAN, profile STRING, target_layout STRING, config_hash STRING, "
        "enabled ARRAY<STRING>, converted ARRAY<STRING>, gated ARRAY<STRING>, n_tables INT",
    )
    return run, children


def write_run_inventory(run: DataFrame, children: DataFrame, path: str) -> None:
    """Replace a run's record; the run row is written after the tables it counts."""
    children.write.mode("overwrite").json(f"{path}/generated_tables")
    run.write.mode("overwrite").json(f"{path}/run")
