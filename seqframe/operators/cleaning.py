"""Clean or quarantine sequences, with every change counted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqframe.functions import letters as L
from seqframe.model import Alphabet
from seqframe.operators.shaping import computed_once

# The two quarantine reasons.
EMPTY = "empty_after_cleaning"
INVALID = "invalid_characters"


def clean_sequence(
    df: DataFrame, alphabet: Alphabet, *, rna_to_dna: bool = False, col: str = "sequence"
) -> DataFrame:
    """Replace ``col`` by its cleaned text and add what happened to it.

    Adds ``original_length, reason, detail`` and five flags. ``reason`` is null for a sequence
    that passed. The order of the steps is white space, case, terminator, emptiness, U to T,
    alphabet. Narrow: no shuffle.
    """
    alphabet = Alphabet(alphabet)
    protein = alphabet is Alphabet.AMINO_ACID
    if rna_to_dna and protein:
        raise ValueError("U is selenocysteine in a protein, so rna_to_dna is only for nucleotides")

    no = F.lit(False)
    raw = F.coalesce(F.col(col), F.lit(""))
    out = df.withColumn("_raw", raw).withColumn("_bare", L.strip_whitespace(F.col("_raw")))
    out = out.withColumn("_upper", L.uppercase(F.col("_bare")))
    out = out.withColumn("_ended", L.strip_terminator(F.col("_upper")) if protein else F.col("_upper"))
    out = out.withColumn("_text", L.rna_to_dna(F.col("_ended")) if rna_to_dna else F.col("_ended"))
    text = F.col("_text")
    out = out.withColumn(
        "reason",
        F.when(F.length(text) == 0, F.lit(EMPTY)).when(L.has_invalid(text, alphabet), F.lit(INVALID)),
    )
    bad = L.invalid_characters(F.col(col), alphabet)
    hint = F.lit("")
    if not protein:
        hint = F.when(
            F.array_contains(bad, "U"), F.lit("; U needs rna_to_dna or another alphabet")
        ).otherwise("")
    invalid_detail = F.concat(
        F.lit("not valid for "), F.lit(f"{alphabet.value}: "), F.array_join(bad, " "), hint
    )
    passed = F.col("reason").isNull()
    once = computed_once(
        out,
        [c for c in df.columns if c != col],
        **{col: text},
        original_length=F.length(text),
        reason=F.col("reason"),
        whitespace_stripped=F.col("_bare") != F.col("_raw"),
        uppercased=F.col("_upper") != F.col("_bare"),
        terminator_stripped=(F.col("_ended") != F.col("_upper")) if protein else no,
        u_to_t_converted=(F.col("_text") != F.col("_ended")) if rna_to_dna else no,
        nucleotide_lookalike=(passed & L.looks_like_nucleotide(text)) if protein else no,
    )
    return once.withColumn(
        "detail",
        F.when(F.col("reason") == EMPTY, F.lit("nothing is left once white space is removed")).when(
            F.col("reason") == INVALID, invalid_detail
        ),
    )


def split_quarantine(cleaned: DataFrame) -> tuple[DataFrame, DataFrame]:
    return (
        cleaned.filter(F.col("reason").isNull()).drop("reason", "detail"),
        quarantine_table(cleaned),
    )


def quarantine_table(cleaned: DataFrame, key: str = "sample_id") -> DataFrame:
    return cleaned.filter(F.col("reason").isNotNull()).select(key, "reason", "detail")


def cleaning_report(cleaned: DataFrame) -> DataFrame:
    """The scalar counters of one source in one row, from one pass."""
    return cleaned.agg(*_counters())


def full_report(cleaned: DataFrame, alphabet: Alphabet, col: str = "sequence") -> DataFrame:
    """The counters and, as ``ambiguity_<letter>``, the kept ambiguity letters, from one pass."""
    return cleaned.agg(*_counters(), *_ambiguity_sums(Alphabet(alphabet), col, "ambiguity_"))


def _counters() -> list[Column]:
    flag = F.count_if
    return [
        F.count(F.lit(1)).alias("seen"),
        flag("uppercased").alias("uppercased"),
        flag("whitespace_stripped").alias("whitespace_stripped"),
        flag("terminator_stripped").alias("terminator_stripped"),
        flag("u_to_t_converted").alias("u_to_t_converted"),
        flag(F.col("reason").isNotNull()).alias("quarantined"),
        flag(F.col("reason") == EMPTY).alias("quarantined_empty"),
        flag(F.col("reason") == INVALID).alias("quarantined_invalid"),
        flag("nucleotide_lookalike").alias("protein_sequences_using_only_nucleotide_letters"),
    ]


def _ambiguity_sums(alphabet: Alphabet, col: str, prefix: str = "") -> list[Column]:
    """One sum per ambiguity letter over the rows that passed."""
    kept = F.when(F.col("reason").isNull(), F.col(col))
    return [
        F.coalesce(F.sum(L.letter_count(kept, c)), F.lit(0)).alias(f"{prefix}{c}")
        for c in sorted(alphabet.ambiguity)
    ]


def quarantine_reasons(cleaned: DataFrame) -> DataFrame:
    return (
        cleaned.filter(F.col("reason").isNotNull()).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
    )


def ambiguity_profile(cleaned: DataFrame, alphabet: Alphabet, col: str = "sequence") -> DataFrame:
    """``(letter, n)`` of the ambiguity letters kept in clean sequences: one sum per letter."""
    codes = sorted(Alphabet(alphabet).ambiguity)
    sums = cleaned.agg(*_ambiguity_sums(Alphabet(alphabet), col))
    long = sums.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("letter"), F.col(c).alias("n")) for c in codes]))
    )
    return long.filter(F.col("n") > 0)
