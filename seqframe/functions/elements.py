"""Expressions that read an event-signature name such as ``L_IF00015_geneX_861bp_insertion_Genus.sp``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Operation types whose sequence the event introduced (class 1), removed (class 0),
# and types that name a place without saying where the sequence came from (excluded).
INTRODUCED_TYPES = ("insertion", "compound.insertion", "plasmid.element", "plasmid")
REMOVED_TYPES = ("deletion", "compound.deletion")
UNSUPPORTED_TYPES = ("insertion.site",)

FLANK_PATTERN = "(?i)_flank[0-9]$"


def is_flank(name: Column) -> Column:
    return name.rlike(FLANK_PATTERN)


def without_flank(name: Column) -> Column:
    return F.regexp_replace(name, FLANK_PATTERN, "")


def element_type(name: Column) -> Column:
    """First known type after the ``<n>bp`` token, else the token right after it."""
    known = INTRODUCED_TYPES + REMOVED_TYPES + UNSUPPORTED_TYPES
    parts = F.split(F.lower(without_flank(name)), "_")
    at = F.array_position(F.transform(parts, lambda p: p.rlike("^[0-9]+bp$")), True)
    tail = F.slice(parts, at.cast("int") + 1, F.size(parts))
    hit = F.get(F.filter(tail, lambda t: t.isin(*known)), F.lit(0))
    found = F.coalesce(hit, F.get(tail, F.lit(0)), F.lit("unparsed"))
    return F.when(at > 0, found).otherwise("unparsed")


def event_label(kind: Column, flank: Column) -> Column:
    """1 introduced, 0 flank or removed, null when the type supports neither class."""
    return (
        F.when(kind.isin(*UNSUPPORTED_TYPES), F.lit(None).cast("int"))
        .when(flank | kind.isin(*REMOVED_TYPES), F.lit(0))
        .when(kind.isin(*INTRODUCED_TYPES), F.lit(1))
    )


def label_basis(kind: Column, flank: Column) -> Column:
    return (
        F.when(kind.isin(*UNSUPPORTED_TYPES), F.lit(None).cast("string"))
        .when(flank, F.lit("flank: context beside the recorded event"))
        .when(kind.isin(*INTRODUCED_TYPES), F.concat(kind, F.lit(": introduced by the recorded event")))
        .when(kind.isin(*REMOVED_TYPES), F.concat(kind, F.lit(": removed by the recorded event")))
    )


def exclusion_reason(kind: Column) -> Column:
    return F.when(
        kind.isin(*UNSUPPORTED_TYPES), F.lit("names a locus, not where the sequence came from")
    ).otherwise("the type places the sequence in neither class")


def origin_organism(name: Column) -> Column:
    tail = F.element_at(F.split(without_flank(name), "_"), -1)
    return F.when(tail.rlike(r"^\p{Lu}"), F.replace(tail, F.lit("."), F.lit(" "))).otherwise("")


def declared_length(name: Column) -> Column:
    """Length stated inside the name, null when it states none."""
    inner = F.regexp_extract(name, "(?i)_([0-9]+)bp_", 1)
    last = F.regexp_extract(name, "(?i)_([0-9]+)bp$", 1)
    digits = F.when(inner != "", inner).when(last != "", last)
    return digits.cast("bigint")


def element_number(name: Column) -> Column:
    """The ``IF#####`` number an element shares with its flanks; the split group key."""
    return F.nullif(F.regexp_extract(name, "(?i)(IF[0-9]+)", 1), F.lit(""))
