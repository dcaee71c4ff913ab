"""One contract over many tables, from check rows and manifests that already exist.

Inputs are tables, not files: nothing is validated twice. ``checks`` is ``(path, name, passed)``;
``profiles`` has one row per table (see ``PROFILE_SCHEMA``); ``declared`` has one row per source:
``source_key, ready, source, source_url, licence, target_description``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from seqframe.functions import digests as D
from seqframe.model import CIPHER, ENCODING_MODE
from seqframe.operators.ranking import first_of_each, ordinals
from seqframe.session import written

PASS, FAIL = "PASS", "FAIL"
BLOCKED, UNSUPPORTED = "BLOCKED_EXTERNAL", "UNSUPPORTED_BY_SOURCE"

PROFILE_SCHEMA = """
path STRING, source_key STRING, profile STRING, source STRING, source_url STRING, licence STRING,
target_description STRING, n_semantics INT, encoding_mode STRING, cipher STRING, padding_token INT,
header ARRAY<STRING>, target_columns ARRAY<STRING>, feature_columns ARRAY<STRING>,
config_hash STRING, n_samples BIGINT, samples_n_rows BIGINT, samples_content_hash STRING,
target_hash STRING,
projection STRUCT<original_target_index: INT, original_target_count: INT, original_target_name: STRING,
  original_target_slug: STRING, source_target_names: ARRAY<STRING>, source_target_slugs: ARRAY<STRING>,
  source_target_hashes: ARRAY<STRING>, source_target_hash_algorithm: STRING, source_row_count: BIGINT>
"""

REQUIREMENTS = (
    "table loads and validates",
    "sample_id is present, non-null and unique",
    "exactly one target column",
    "features are position columns in declared order and integer",
    "encoding is the letter cipher with padding 0",
    "label provenance matches the declaration",
)


# ---- per table --------------------------------------------------------------------------------


def check_evidence(checks: DataFrame) -> DataFrame:
    """Per table: how many checks ran and failed, and the few results the contract names."""

    def all_passed(*names: str) -> Column:
        ok = F.count_distinct(F.when(F.col("name").isin(*names) & F.col("passed"), F.col("name")))
        bad = F.count_if(F.col("name").isin(*names) & ~F.col("passed"))
        return (ok == len(names)) & (bad == 0)

    return checks.groupBy("path").agg(
        F.count(F.lit(1)).alias("n_checks"),
        F.count_if(~F.col("passed")).alias("n_failed"),
        all_passed("primary_key_column_exists", "primary_key_non_null", "primary_key_unique").alias("key_ok"),
        all_passed("all_position_columns_integer").alias("integer_ok"),
        all_passed("labels_only_documented_values").alias("documented_ok"),
    )


def per_table_findings(checks: DataFrame, profiles: DataFrame, declared: DataFrame) -> DataFrame:
    """``(path, source_key, requirement, passed, detail)``: six findings per table."""
    d = declared.select(
        "source_key",
        *[F.col(c).alias(f"want_{c}") for c in ("source", "source_url", "licence", "target_description")],
    )
    joined = profiles.join(check_evidence(checks), "path", "left").join(d, "source_key", "left")
    c = F.col
    n_targets = F.size("target_columns")
    tail = F.slice("header", F.lit(2) + n_targets, F.greatest(F.size("header"), F.lit(1)))
    in_order = tail == c("feature_columns")
    named = F.forall("feature_columns", lambda n: n.startswith("position_"))
    same = [
        c("source").eqNullSafe(c("want_source")),
        c("source_url").eqNullSafe(c("want_source_url")),
        c("licence").eqNullSafe(c("want_licence")),
        c("target_description").startswith(c("want_target_description")),
        c("n_semantics") > 0,
        c("documented_ok"),
    ]
    labels = ("source", "source_url", "licence", "target_description", "label semantics", "documented values")
    problems = F.array_compact(
        F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(n)) for ok, n in zip(same, labels, strict=True)])
    )
    findings = [
        (c("n_failed") == 0, _words("checks ", c("n_checks"), ", failed ", c("n_failed"))),
        (c("key_ok"), F.lit("primary key checks")),
        (n_targets == 1, _words("target columns ", n_targets)),
        (named & in_order & c("integer_ok"), _words("named ", named, ", in order ", in_order, ", integer ", c("integer_ok"))),
        (
            (c("encoding_mode") == ENCODING_MODE) & (c("cipher") == CIPHER) & (c("padding_token") == 0),
            _words("mode ", c("encoding_mode"), ", cipher ", c("cipher"), ", padding ", c("padding_token")),
        ),
        (F.size(problems) == 0, _words("differs: ", F.array_join(problems, ", "))),
    ]
    rows = [
        F.struct(
            F.lit(r).alias("requirement"),
            F.coalesce(ok, F.lit(False)).alias("passed"),
            detail.alias("detail"),
        )
        for r, (ok, detail) in zip(REQUIREMENTS, findings, strict=True)
    ]
    return joined.select("path", "source_key", F.inline(F.array(*rows)))


def _words(*parts: str | Column) -> Column:
    return F.concat(
        *[F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("none")) for p in parts]
    )


def requirement_rollup(findings: DataFrame, examples: int = 3) -> DataFrame:
    """``(requirement, status, n_tables, n_failed, failures)`` over all tables.

    ``failures`` names the first few failing tables; no more are kept per requirement.
    """
    failed = ~F.col("passed")
    totals = findings.groupBy("requirement").agg(
        F.when(F.count_if(failed) > 0, FAIL).otherwise(PASS).alias("status"),
        F.count(F.lit(1)).alias("n_tables"),
        F.count_if(failed).alias("n_failed"),
    )
    shown = first_of_each(findings.filter(failed), ["requirement"], ["path", "detail"], examples, "_rank")
    named = F.struct("_rank", F.concat_ws(": ", "path", "detail").alias("name"))
    listed = shown.groupBy(F.col("requirement").alias("_of")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(named)), lambda s: s["name"]), "; ").alias("failures")
    )
    return totals.join(listed, F.col("requirement") == F.col("_of"), "left").drop("_of")


def provenance_check(profiles: DataFrame, declared: DataFrame) -> DataFrame:
    """Recorded against declared provenance, field by field, per table."""
    d = declared.select(
        "source_key",
        *[F.col(c).alias(f"want_{c}") for c in ("source", "source_url", "licence", "target_description")],
    )
    j = profiles.join(d, "source_key", "left")
    no = F.lit(False)
    return j.select(
        "path",
        "source_key",
        F.col("source").eqNullSafe(F.col("want_source")).alias("source_ok"),
        F.col("source_url").eqNullSafe(F.col("want_source_url")).alias("url_ok"),
        F.col("licence").eqNullSafe(F.col("want_licence")).alias("licence_ok"),
        F.coalesce(F.col("target_description").startswith(F.col("want_target_description")), no).alias("description_ok"),
        (F.coalesce(F.col("n_semantics"), F.lit(0)) > 0).alias("semantics_ok"),
    )


# ---- run inventory ----------------------------------------------------------------------------


def safe_relative(path: Column) -> Column:
    """No absolute path, drive, share or parent step, whatever the platform."""
    return ~(path.rlike(r"^([/\\]|[A-Za-z]:)") | path.rlike(r"(^|[/\\])\.\.([/\\]|$)"))


def inventory_reconcile(expected: DataFrame, found: DataFrame) -> DataFrame:
    """``(path, status)``: ok, missing, unexpected, hash_differs, repeated or unsafe_path."""
    e = expected.groupBy("path").agg(
        F.max("content_hash").alias("want"), F.count(F.lit(1)).alias("n_expected")
    )
    g = found.groupBy("path").agg(F.max("content_hash").alias("got"), F.count(F.lit(1)).alias("n_found"))
    return e.join(g, "path", "full_outer").select(
        "path",
        F.when(~safe_relative(F.col("path")), "unsafe_path")
        .when(F.col("n_found").isNull(), "missing")
        .when(F.col("n_expected").isNull(), "unexpected")
        .when((F.col("n_expected") > 1) | (F.col("n_found") > 1), "repeated")
        .when(~F.col("want").eqNullSafe(F.col("got")), "hash_differs")
        .otherwise("ok")
        .alias("status"),
    )


def inventory_requirement(
    run: DataFrame,
    reconciled: DataFrame,
    *,
    profile: str,
    config_hash: str,
    enabled: list[str],
    target_layout: str = "single",
) -> DataFrame:
    """The one requirement row on a run's record: is it complete, current and equal to what is there?"""
    want = F.sort_array(F.array(*[F.lit(s) for s in enabled]).cast("array<string>"))
    both = F.array_intersect("converted", "gated")
    either = F.sort_array(F.array_distinct(F.concat("converted", "gated")))
    tests = [
        (F.col("complete"), "incomplete"),
        (F.col("profile") == profile, "profile differs"),
        (F.col("target_layout") == target_layout, "target layout differs"),
        (F.col("config_hash") == config_hash, "config differs"),
        (F.sort_array("enabled") == want, "enabled sources differ"),
        (F.size(both) == 0, "a source is both converted and gated"),
        (either == want, "converted and gated do not partition the enabled sources"),
    ]
    problems = F.array_compact(
        F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for ok, name in tests])
    )
    of_run = run.select(F.explode(F.concat(problems, F.array(F.lit("")))).alias("problem"))
    of_tables = (
        reconciled.filter(F.col("status") != "ok")
        .groupBy("status")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.concat_ws(" ", F.col("n").cast("string"), F.lit("table(s)"), F.col("status")).alias("problem"))
    )
    # A blank row per run record tells a sound record from an absent one.
    everything = of_run.unionByName(of_tables)
    problems_found = F.count_if(F.col("problem") != "")
    records = F.count_if(F.col("problem") == "")
    return everything.agg(
        F.lit("run inventory is complete and current").alias("requirement"),
        F.when((records == 1) & (problems_found == 0), PASS).otherwise(FAIL).alias("status"),
        F.when(records == 0, F.lit("no run record"))
        .otherwise(F.array_join(F.sort_array(F.collect_set(F.when(F.col("problem") != "", F.col("problem")))), "; "))
        .alias("detail"),
    )


def source_partition(enabled: DataFrame, converted: DataFrame, gated: DataFrame) -> DataFrame:
    """``(source_key, problem)``: converted and gated must be disjoint and together be the enabled."""
    enabled, converted, gated = enabled.distinct(), converted.distinct(), gated.distinct()
    both = converted.intersect(gated).select("source_key", F.lit("both converted and gated").alias("problem"))
    either = converted.union(gated).distinct()
    lost = enabled.exceptAll(either).select("source_key", F.lit("neither converted nor gated").alias("problem"))
    extra = either.exceptAll(enabled).select("source_key", F.lit("not enabled").alias("problem"))
    return both.unionByName(lost).unionByName(extra)


# ---- projections ------------------------------------------------------------------------------


def index_gaps(df: DataFrame, source: str, index: str, count: str) -> DataFrame:
    """``(source, first, last)``: every run of indexes missing from 0…count-1 (action).

    Gaps lie between islands, runs of consecutive indexes: within one, index less rank stays the same. Only what
    is listed is sorted, over many partitions whatever a source holds; a source that claims a billion indexes
    costs what it lists.
    """
    wanted = written(df.groupBy(F.col(source).alias("_s")).agg(F.max(count).alias("_count")))
    return _gaps(df.select(source, F.col(index).cast("bigint").alias("_i")).filter("_i >= 0").distinct(), wanted, source)


def _gaps(listed: DataFrame, wanted: DataFrame, source: str) -> DataFrame:
    """``index_gaps`` of different ``(source, _i)``, none negative, against written ``(_s, _count)`` (action).

    Places in the order of all rows do as well as ranks within a source: they too grow by one along an island, and
    the island before ends one place earlier. So rows are sorted once, and only islands meet their source's count.
    """
    of_source = F.col(source).eqNullSafe(F.col("_s"))
    placed = ordinals(listed, [source, "_i"], "_place")
    islands = placed.groupBy(source, (F.col("_i") - F.col("_place")).alias("_lost")).agg(
        F.min("_i").alias("_first"), F.max("_i").alias("_last"), F.min("_place").alias("_from"), F.max("_place").alias("_to")
    )
    islands = islands.join(wanted, of_source).filter("_first < _count")
    islands = written(islands.select(source, "_first", F.least(F.col("_last"), F.col("_count").cast("bigint") - 1).alias("_last"), "_from", "_to"))
    # The end of the island before; a source's first gap begins at 0, its last one ends with the count.
    ends = islands.select(F.col(source).alias("_t"), (F.col("_to") + 1).alias("_from"), (F.col("_last") + 1).alias("first"))
    last = islands.groupBy(F.col(source).alias("_u")).agg(F.max("_last").alias("_end"))
    between = islands.alias("i").join(ends.alias("e"), F.col(f"i.{source}").eqNullSafe(F.col("e._t")) & (F.col("i._from") == F.col("e._from")), "left")
    between = between.select(F.col(f"i.{source}").alias(source), F.coalesce("e.first", F.lit(0)).alias("first"), (F.col("i._first") - 1).alias("last"))
    after = wanted.join(last, F.col("_s").eqNullSafe(F.col("_u")), "left").select(
        F.col("_s").alias(source), F.coalesce(F.col("_end") + 1, F.lit(0)).alias("first"), (F.col("_count") - 1).cast("bigint").alias("last")
    )
    return between.unionByName(after).filter("first <= last")


def index_coverage(df: DataFrame, source: str, index: str, count: str) -> DataFrame:
    """``(source, index, problem)``: indexes missing from, outside of or repeated in 0…count-1 (action).

    One row per missing index; ``index_gaps`` has one per run of them. Rows are grouped once; only indexes that
    repeat, or that the counts beside them do not hold, meet their source's count.
    """
    kind = df.schema[index].dataType
    seen = written(df.groupBy(source, index).agg(F.count(F.lit(1)).alias("_n"), F.max(count).alias("_held")))
    wanted = written(seen.groupBy(F.col(source).alias("_s")).agg(F.max("_held").alias("_count")))
    listed = seen.select(source, F.col(index).cast("bigint").alias("_i")).filter("_i >= 0")
    gaps = _gaps(listed if isinstance(kind, IntegralType) else listed.distinct(), wanted, source)
    missing = gaps.select(source, F.explode(F.sequence(F.col("first").cast(kind), F.col("last").cast(kind))).alias(index), F.lit("missing").alias("problem"))
    below = lambda c: F.coalesce((F.col(index) >= 0) & (F.col(index) < F.col(c)), F.lit(False))
    doubtful = seen.filter(~below("_held") | (F.col("_n") > 1)).join(wanted, F.col(source).eqNullSafe(F.col("_s")))
    wrong = doubtful.select(source, index, F.when(~below("_count"), "unexpected").when(F.col("_n") > 1, "duplicate").alias("problem"))
    return missing.unionByName(wrong.filter(F.col("problem").isNotNull()))


def projection_shape_problem(p: str = "projection") -> Column:
    """What is wrong with one table's projection block, null when it is well formed."""
    c = lambda n: F.col(f"{p}.{n}")
    n = c("original_target_count")

    def listed(name: str) -> Column:
        return (F.size(c(name)) == n) & F.forall(c(name), lambda v: v.isNotNull() & (v != ""))

    no = F.lit(False)
    return (
        F.when(F.col(p).isNull(), "projection block is missing")
        .when(~F.coalesce(n > 0, no), "target count is not positive")
        .when(~F.coalesce((c("original_target_index") >= 0) & (c("original_target_index") < n), no), "index is out of range")
        .when(~F.coalesce(listed("source_target_names"), no), "names are not one per target")
        .when(~F.coalesce(listed("source_target_slugs"), no), "slugs are not one per target")
        .when(~F.coalesce(listed("source_target_hashes"), no), "hashes are not one per target")
        .when(~c("source_target_hash_algorithm").eqNullSafe(F.lit(D.ALGORITHM)), "hash algorithm is another")
        .when(~F.coalesce(c("source_row_count") > 0, no), "row count is not positive")
        .when(c("original_target_name").isNull() | c("original_target_slug").isNull(), "name or slug is missing")
    )


def projection_mapping_problem(config_hash: str | None = None, p: str = "projection") -> Column:
    """What one well-formed projection says that its own contract contradicts."""
    c = lambda n: F.col(f"{p}.{n}")
    i = c("original_target_index")
    config = F.lit(False) if config_hash is None else ~F.col("config_hash").eqNullSafe(F.lit(config_hash))
    rows = c("source_row_count")
    return (
        F.when(c("original_target_name") != F.get(c("source_target_names"), i), "name and index differ")
        .when(c("original_target_slug") != F.get(c("source_target_slugs"), i), "slug and index differ")
        .when(~_path_names(c("original_target_slug")), "path and slug differ")
        .when(config, "config hash differs")
        .when(~(F.col("samples_n_rows").eqNullSafe(rows) & F.col("n_samples").eqNullSafe(rows)), "row counts differ")
        .when(~F.col("target_hash").eqNullSafe(F.get(c("source_target_hashes"), i)), "target hash differs")
    )


def _path_names(slug: Column) -> Column:
    """A projected table is called ``…__<slug>`` or lies in ``slug=<slug>``."""
    path = F.col("path")
    return F.endswith(path, F.concat(F.lit("__"), slug)) | F.endswith(path, F.concat(F.lit("slug="), slug))


def projection_coverage(profiles: DataFrame, config_hash: str | None = None) -> DataFrame:
    """``(source_key, status, detail, n_tables)``: do the projected tables cover their source once?"""
    p = F.col("projection")
    # All tables of a source must name the same lists, counts and sidecar.
    contract = F.sha2(
        F.to_json(
            F.struct(
                p["source_target_names"], p["source_target_slugs"], p["source_target_hashes"],
                p["source_row_count"], "config_hash", "samples_content_hash", "samples_n_rows",
            )
        ),
        256,
    )
    marked = profiles.select(
        "source_key",
        "path",
        projection_shape_problem().alias("shape"),
        projection_mapping_problem(config_hash).alias("mapping"),
        p["original_target_index"].alias("i"),
        p["original_target_count"].alias("n"),
        contract.alias("contract"),
    )
    # Indexes in range and all distinct, as many as declared: exactly 0…n-1, without listing them.
    per_source = marked.groupBy("source_key").agg(
        F.count(F.lit(1)).alias("n_tables"),
        F.min("shape").alias("shape"),
        F.count_distinct("n").alias("counts"),
        F.max("n").alias("n"),
        F.count_distinct("i").alias("indexes"),
        F.count_distinct("contract").alias("contracts"),
        F.min("mapping").alias("mapping"),
    )
    detail = (
        F.when(F.col("shape").isNotNull(), F.col("shape"))
        .when(F.col("counts") != 1, "target counts differ between tables")
        .when(F.col("indexes") < F.col("n_tables"), "an index occurs more than once")
        .when(F.col("indexes") != F.col("n"), "an index is missing")
        .when(F.col("mapping").isNotNull(), F.col("mapping"))
        .when(F.col("contracts") != 1, "the tables do not share one contract")
    )
    return per_source.select(
        "source_key",
        F.when(detail.isNull(), PASS).otherwise(FAIL).alias("status"),
        F.coalesce(detail, F.lit("every index present and bound")).alias("detail"),
        "n_tables",
    )


# ---- sources ----------------------------------------------------------------------------------


def source_coverage(declared: DataFrame, profiles: DataFrame, config_hash: str | None = None) -> DataFrame:
    """``(source_key, status, detail, n_tables)`` of every enabled source.

    Ready without a table fails, not ready is blocked, native and projected tables together fail, and
    projected tables must cover their source.
    """
    counts = profiles.groupBy("source_key").agg(
        F.count_if(F.col("projection").isNull()).alias("native"),
        F.count_if(F.col("projection").isNotNull()).alias("projected"),
    )
    cover = projection_coverage(profiles.filter(F.col("projection").isNotNull()), config_hash).select(
        "source_key", F.col("status").alias("cover"), F.col("detail").alias("cover_detail")
    )
    j = declared.select("source_key", "ready").join(counts, "source_key", "left").join(cover, "source_key", "left")
    native, projected = F.coalesce("native", F.lit(0)), F.coalesce("projected", F.lit(0))
    n = native + projected
    ready = F.coalesce("ready", F.lit(False))
    return j.select(
        "source_key",
        F.when(~ready, BLOCKED)
        .when(n == 0, FAIL)
        .when((native > 0) & (projected > 0), FAIL)
        .when(native > 0, PASS)
        .otherwise(F.col("cover"))
        .alias("status"),
        F.when(~ready & (n > 0), "not ready; what exists is stale and does not count")
        .when(~ready, "not ready")
        .when(n == 0, "ready but no table exists")
        .when((native > 0) & (projected > 0), "native and projected tables are mixed")
        .when(native > 0, "native table present")
        .otherwise(F.col("cover_detail"))
        .alias("detail"),
        n.alias("n_tables"),
    )


# ---- the report -------------------------------------------------------------------------------


def audit(
    checks: DataFrame,
    profiles: DataFrame,
    declared: DataFrame,
    inventory: DataFrame | None = None,
    config_hash: str | None = None,
) -> DataFrame:
    """``(ordinal, requirement, status, detail)``: inventory, table requirements, source coverage.

    Only tables of declared sources count. With no table at all every table requirement fails if a
    ready source lacks output and is blocked otherwise.
    """
    profiles = profiles.join(declared.select("source_key"), "source_key", "left_semi")
    coverage = source_coverage(declared, profiles, config_hash)
    rolled = requirement_rollup(per_table_findings(checks, profiles, declared))
    listed = F.array(
        *[F.struct(F.lit(i + 1).alias("ordinal"), F.lit(r).alias("requirement")) for i, r in enumerate(REQUIREMENTS)]
    )
    ready_missing = F.count_if((F.col("status") == FAIL) & (F.col("n_tables") == 0))
    names = coverage.agg(F.when(ready_missing > 0, FAIL).otherwise(BLOCKED).alias("empty")).select(
        "empty", F.inline(listed)
    )
    tables = (
        names.join(rolled, "requirement", "left")
        .select(
            "ordinal",
            "requirement",
            F.coalesce("status", "empty").alias("status"),
            F.when(F.col("n_tables").isNull(), "0 tables checked")
            .otherwise(
                _words("tables ", F.col("n_tables"), ", failed ", F.col("n_failed"), F.coalesce(F.concat(F.lit("; "), F.col("failures")), F.lit("")))
            )
            .alias("detail"),
        )
    )
    sources = coverage.select(
        F.lit(len(REQUIREMENTS) + 1).alias("ordinal"),
        F.concat(F.lit("source coverage: "), F.col("source_key").cast("string")).alias("requirement"),
        "status",
        "detail",
    )
    parts = [tables, sources]
    if inventory is not None:
        parts.insert(0, inventory.select(F.lit(0).alias("ordinal"), "requirement", "status", "detail"))
    return reduce(DataFrame.unionByName, parts)


def status_counts(report: DataFrame) -> DataFrame:
    return report.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def overall_status(report: DataFrame) -> DataFrame:
    """FAIL if anything failed, PASS if everything passed, INCOMPLETE otherwise."""
    return report.agg(
        F.when(F.bool_or(F.col("status") == FAIL), FAIL)
        .when(F.bool_and(F.col("status") == PASS), PASS)
        .otherwise("INCOMPLETE")
        .alias("overall_status"),
        F.count(F.lit(1)).alias("n_requirements"),
    )
