"""Shared names, options and the two containers every plan passes around."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from enum import StrEnum

from pyspark.sql import DataFrame


class Alphabet(StrEnum):
    """Which letters a sequence may use. The token of a letter never depends on it."""

    DNA_NUCLEOTIDE = "dna_nucleotide"
    AMINO_ACID = "amino_acid"

    @property
    def canonical(self) -> str:
        return CANONICAL_LETTERS[self]

    @property
    def ambiguity(self) -> str:
        return AMBIGUITY_LETTERS[self]

    @property
    def allowed(self) -> str:
        return self.canonical + self.ambiguity


class LengthPolicy(StrEnum):
    PAD_OR_TRUNCATE = "pad_or_truncate"
    WINDOW = "window"


# Letter sets of the two alphabets, the padding token and the letter cipher.
CANONICAL_LETTERS = {
    Alphabet.DNA_NUCLEOTIDE: "ACGT",
    Alphabet.AMINO_ACID: "ACDEFGHIKLMNPQRSTVWY",
}
AMBIGUITY_LETTERS = {
    Alphabet.DNA_NUCLEOTIDE: "RYSWKMBDHVN",
    Alphabet.AMINO_ACID: "BZXJUO",
}
PAD_TOKEN = 0
MAX_TOKEN = 26
CIPHER = "A=1 .. Z=26"
ENCODING_MODE = "letter"

KEY = "sample_id"
TABLE_FORMAT = "seqframe-table"
TABLE_VERSION = 1

# Columns every samples sidecar starts with, whatever the source.
SIDECAR_COLUMNS = (
    "sample_id",
    "parent_sample_id",
    "source",
    "original_length",
    "window_start",
    "window_end",
    "residues_in_row",
    "padding_cells",
    "residues_removed_by_truncation",
    "residues_dropped_by_window_cap",
    "slice_digest",
)


@dataclass(frozen=True)
class Options:
    """How sequences become fixed-width rows."""

    width: int = 1000
    policy: LengthPolicy = LengthPolicy.PAD_OR_TRUNCATE
    stride: int = 1000
    max_windows_per_sample: int | None = None
    digest: str = "sha2-256"

    def __post_init__(self) -> None:
        object.__setattr__(self, "policy", LengthPolicy(self.policy))
        if self.width <= 0:
            raise ValueError(f"width must be positive, got {self.width}")
        if self.policy is LengthPolicy.WINDOW:
            check_stride(self.width, self.stride)
        check_window_cap(self.max_windows_per_sample)


def check_stride(width: int, stride: int) -> None:
    if stride <= 0:
        raise ValueError(f"stride must be positive, got {stride}")
    if stride > width:
        raise ValueError(
            f"stride {stride} is wider than the window {width}: the residues between two "
            "windows would be in no row and no counter would say so"
        )


def check_window_cap(cap: int | None) -> None:
    if cap is None:
        return
    if type(cap) is not int:
        raise TypeError(f"the window cap must be None or an int, got {cap!r}")
    if cap <= 0:
        raise ValueError(f"the window cap must be greater than zero, got {cap}")


@dataclass(frozen=True)
class Dataset:
    """A labelled source as one lazy DataFrame.

    ``df`` holds ``sample_id, sequence, label ARRAY<INT>, source, metadata STRUCT`` and the
    ``order`` columns that carry emission order. ``semantics`` is ``(value INT, meaning STRING)``.
    ``stats`` holds lazy side tables (what was dropped, excluded, counted on the way).
    """

    df: DataFrame
    name: str
    alphabet: Alphabet
    semantics: DataFrame | None
    n_targets: int = 1
    target_names: tuple[str, ...] = ()
    order: tuple[str, ...] = ("ord",)
    rna_to_dna: bool = False
    source_url: str = ""
    licence: str = ""
    target_description: str = ""
    stats: Mapping[str, DataFrame] = field(default_factory=dict)

    @property
    def metadata_fields(self) -> list[str]:
        kind = self.df.schema["metadata"].dataType if "metadata" in self.df.columns else None
        return [] if kind is None else kind.fieldNames()


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    """Refuse a source that lacks a required column instead of guessing a schema."""
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"missing column(s) {missing}; the source has {df.columns}")
    return df


def position_columns(count: int) -> list[str]:
    """One-based feature names, zero-padded so that a name sort keeps their order."""
    digits = len(str(count))
    return [f"position_{i:0{digits}d}" for i in range(1, count + 1)]


def target_columns(count: int) -> list[str]:
    """``target`` for one target, else zero-based and zero-padded ``target_00 ...``."""
    if count < 1:
        raise ValueError("a table needs at least one target column")
    if count == 1:
        return ["target"]
    digits = len(str(count - 1))
    return [f"target_{i:0{digits}d}" for i in range(count)]


def table_header(n_features: int, n_targets: int) -> list[str]:
    return [KEY, *target_columns(n_targets), *position_columns(n_features)]
