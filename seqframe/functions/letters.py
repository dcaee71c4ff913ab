"""Scalar expressions over raw and cleaned sequence text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from seqframe.model import Alphabet

# The six characters removed anywhere, the two terminators removed at the end of a
# protein, and the letters a protein shares with a nucleotide sequence.
WHITESPACE_CLASS = r"[ \t\r\n\x0B\f]+"
TERMINATORS = "*_"
NUCLEOTIDE_LOOKALIKE = "ACGTN"


def strip_whitespace(text: Column) -> Column:
    return F.regexp_replace(text, WHITESPACE_CLASS, "")


def uppercase(text: Column) -> Column:
    return F.upper(text)


def strip_terminator(text: Column) -> Column:
    return F.rtrim(text, F.lit(TERMINATORS))


def rna_to_dna(text: Column) -> Column:
    return F.replace(text, F.lit("U"), F.lit("T"))


def has_invalid(text: Column, alphabet: Alphabet) -> Column:
    return text.rlike(f"[^{alphabet.allowed}]")


def invalid_characters(text: Column, alphabet: Alphabet) -> Column:
    """Sorted distinct characters the alphabet does not allow."""
    rest = F.regexp_replace(text, f"[{alphabet.allowed}]+", "")
    chars = F.sort_array(F.array_distinct(F.split(rest, "")))
    return F.when(F.length(rest) > 0, chars).otherwise(F.array().cast("array<string>"))


def letter_count(text: Column, letter: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(letter), F.lit("")))


def looks_like_nucleotide(text: Column) -> Column:
    return text.rlike(f"^[{NUCLEOTIDE_LOOKALIKE}]+$")


def uri_fragment(text: Column) -> Column:
    """What follows the last ``#``, or the whole text when there is none."""
    return F.substring_index(text, "#", -1)


def clip_text(text: Column, size: int = 120) -> Column:
    return F.substring(text, 1, size)


def strip_suffix(text: Column, suffix: str) -> Column:
    ends = F.endswith(text, F.lit(suffix))
    return F.when(ends, F.left(text, F.length(text) - len(suffix))).otherwise(text)


def compose_id(file: Column, member: Column) -> Column:
    """``<file without .json>::<member id>``."""
    return F.concat_ws("::", strip_suffix(file, ".json"), member)


def pipe_join(values: Column, limit: int | None = None) -> Column:
    """Sorted members joined with ``|``, at most ``limit`` of them shown."""
    ordered = F.sort_array(values)
    return F.array_join(ordered if limit is None else F.slice(ordered, 1, limit), "|")


def trim_all(text: Column) -> Column:
    """Strip any white space at both ends (``trim`` alone strips only blanks)."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def slugify(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "_"), F.lit("_"))
