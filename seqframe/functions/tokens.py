"""Letters to tokens and back, fixed-width placement and windows.

A padded row is first text, with ``@`` standing for padding: ``@`` is the character just before
``A``, so one rule (code point minus 64) turns every cell into its token, 0 included. Text keeps
cutting and padding in generated code; the array is built once, at the end.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PAD_CHAR = "@"
CODE_BASE = 64


def tokens_of(row_text: Column) -> Column:
    """Tokens of text over ``@A-Z``; the caller has already checked the letters."""
    cells = F.transform(F.split(row_text, ""), lambda c: (F.ascii(c) - CODE_BASE).cast("tinyint"))
    return F.when(F.length(row_text) > 0, cells).otherwise(F.array().cast("array<tinyint>"))


def checked_letters(text: Column) -> Column:
    """The text itself, or an error naming it when a character has no token."""
    problem = F.concat(F.lit("a character outside A-Z has no token: "), F.substring(text, 1, 60))
    return F.when(text.rlike("[^A-Z]"), F.raise_error(problem)).otherwise(text)


def encode(text: Column) -> Column:
    return tokens_of(checked_letters(text))


def row_text_of(tokens: Column) -> Column:
    """Tokens back to padded text; meaningful only for tokens 0..26."""
    return F.array_join(F.transform(tokens, lambda t: F.char(t.cast("int") + CODE_BASE)), "")


def decode(tokens: Column) -> Column:
    """Tokens to letters without padding; any token outside 0..26 is an error."""
    foreign = (F.array_min(tokens) < 0) | (F.array_max(tokens) > 26)
    problem = F.concat(F.lit("a token is outside 0..26: "), F.array_max(tokens).cast("string"))
    text = F.replace(row_text_of(tokens), F.lit(PAD_CHAR), F.lit(""))
    return F.when(F.coalesce(foreign, F.lit(False)), F.raise_error(problem)).otherwise(text)


def pad_text(text: Column, width: int) -> Column:
    return F.rpad(text, width, PAD_CHAR)


def window_count(length: Column, width: int, stride: int) -> Column:
    """How many windows until one reaches the end; a short or empty sequence gives one."""
    steps = F.floor((length - width + stride - 1) / F.lit(stride)).cast("int")
    return F.when(length <= width, F.lit(1)).otherwise(steps + 1)


def window_id(parent: Column, index: Column, kept: Column) -> Column:
    """``parent__w00``: at least two digits, more when the kept windows need them."""
    digits = F.greatest(F.lit(2), F.length((kept - 1).cast("string")))
    return F.concat(parent, F.lit("__w"), F.lpad(index.cast("string"), digits, F.lit("0")))
