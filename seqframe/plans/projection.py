"""Single-target views of a multi-target dataset, and what binds them together."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqframe.model import Dataset
from seqframe.operators.projection import project_targets as project
from seqframe.operators.quality import ordered_target_digest


def project_targets(dataset: Dataset) -> DataFrame:
    if dataset.n_targets > 1 and len(dataset.target_names) != dataset.n_targets:
        raise ValueError(f"{dataset.n_targets} targets need as many names, got {len(dataset.target_names)}")
    names = dataset.target_names if dataset.n_targets > 1 else ("target",)
    return project(dataset.df, names, keep=dataset.order)


def projection_contract(projected: DataFrame, order: tuple[str, ...] = ("ord",)) -> DataFrame:
    """``(target_index, target_name, slug, n_rows, content_digest)``: one row per target."""
    names = projected.select("target_index", "target_name", "slug").distinct()
    return ordered_target_digest(projected, order).join(names, "target_index")


def source_contract(contract: DataFrame) -> DataFrame:
    """The lists every projection of one source must share, in one row (one entry per target)."""
    ordered = F.sort_array(F.collect_list(F.struct("target_index", "target_name", "slug", "content_digest")))
    one = contract.agg(F.count(F.lit(1)).alias("target_count"), F.max("n_rows").alias("row_count"), ordered.alias("t"))
    return one.select(
        "target_count",
        "row_count",
        F.col("t.target_name").alias("names"),
        F.col("t.slug").alias("slugs"),
        F.col("t.content_digest").alias("hashes"),
    )
