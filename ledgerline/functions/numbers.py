"""Parsing numbers out of text that carries symbols, separators and stray marks."""

from __future__ import annotations

import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline.functions.text import strip

# All decimal digits of all scripts and their ASCII values, by rule.
_OTHER_DIGITS = "".join(
    chr(i) for i in range(128, sys.maxunicode + 1) if unicodedata.category(chr(i)) == "Nd"
)
_THEIR_VALUES = "".join(str(unicodedata.digit(d)) for d in _OTHER_DIGITS)

# try_cast of other text costs an exception per row, so casts are guarded by these.
_WHOLE_NUMBER = "^-?[0-9]{1,18}$"
_NUMBER = r"^-?([0-9]+\.?[0-9]*|\.[0-9]+)$"
_NUMBER_LITERAL = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def _kept(c: Column, marks: str) -> Column:
    """The digits (as ASCII) and ``marks`` of a text. Only text that is not
    ASCII has its digits looked up."""
    ascii_digits = F.when(F.length(c) == F.octet_length(c), c).otherwise(
        F.translate(c, _OTHER_DIGITS, _THEIR_VALUES)
    )
    return F.regexp_replace(ascii_digits, f"[^0-9{marks}]", "")


def _literal_or(c: Column, target: str, from_text: Column) -> Column:
    """A number literal as such, also where it is too wide (NULL); else the text."""
    s = strip(c)
    return F.when(s.rlike(_NUMBER_LITERAL), s.try_cast(target)).otherwise(from_text)


def clean_int(c: Column, on_bad: str = "raise", plain_numbers: bool = False) -> Column:
    """Whole number from text: everything but digits and ``-`` is dropped.

    NULL and text without digits give 0. ``12.5`` as text gives 125; with
    ``plain_numbers`` a text that *is* a number literal is read as that number
    and truncated instead, which is what a loader that types cells does.
    ``on_bad`` says what a remainder such as ``1-2`` does: ``raise``, ``null``
    (so a NOT NULL rule catches it) or ``zero``.

    Clean text takes the cast alone; the regexp only sees the rest.
    """
    digits = F.regexp_replace(_kept(c, r"\-"), "^$", "0")
    if on_bad == "raise":
        from_text = digits.cast("bigint")
    elif on_bad == "null":
        from_text = digits.try_cast("bigint")
    elif on_bad == "zero":
        from_text = F.coalesce(digits.try_cast("bigint"), F.lit(0).cast("bigint"))
    else:
        raise ValueError(f"on_bad must be raise, null or zero, not {on_bad!r}")
    if plain_numbers:
        from_text = _literal_or(c, "decimal(38,6)", from_text.cast("decimal(38,6)")).try_cast(
            "bigint"
        )
    return (
        F.when(c.isNull(), F.lit(0).cast("bigint"))
        .when(c.rlike(_WHOLE_NUMBER), c.try_cast("bigint"))
        .otherwise(from_text)
    )


def int_from_number(c: Column) -> Column:
    """Truncate a numeric column; NULL and NaN give 0."""
    as_double = c.cast("double")
    return F.when(c.isNull() | F.isnan(as_double), F.lit(0)).otherwise(
        F.when(~F.isnan(as_double), c).cast("bigint")
    ).cast("bigint")


def clean_float(c: Column, plain_numbers: bool = False) -> Column:
    """Double from text; NULL, no digits and unparsable remainders give 0.0."""
    kept = _kept(c, r".\-")
    number = F.when(kept.rlike(_NUMBER), kept.try_cast("double")).otherwise(F.lit(0.0))
    if plain_numbers:
        number = _literal_or(c, "double", number)
    return F.coalesce(number, F.lit(0.0))


def clean_decimal(
    c: Column, precision: int = 18, scale: int = 4, plain_numbers: bool = False
) -> Column:
    """Like :func:`clean_float` but exact. A number too wide for the target is
    NULL, not 0, so that a NOT NULL rule can catch it."""
    target = f"decimal({precision},{scale})"
    zero = F.lit(0).cast(target)
    kept = _kept(c, r".\-")
    number = F.when(kept.rlike(_NUMBER), kept.try_cast(target)).otherwise(zero)
    if plain_numbers:
        number = _literal_or(c, target, number)
    return F.when(c.isNull(), zero).otherwise(number)


def parse_grouped(c: Column, target: str = "double") -> Column:
    """``1,234.5`` -> 1234.5; other text is an error, NULL stays NULL."""
    return strip(F.translate(c, ",", "")).cast(target)
