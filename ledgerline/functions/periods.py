"""Quarters, years and months, as text and as dates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline.functions.text import strip

# Further spellings of a month accepted by parse_month, tried in this order.
MONTH_FORMATS = ("yyyy/MM/dd", "yyyy/MM", "MMM-yyyy", "MMM yyyy")


def normalize_quarter(c: Column) -> Column:
    """``Q1-2019`` and ``4th Qtr 2020`` become ``YYYY-Q#``; other text is only trimmed."""
    s = strip(c)
    s = F.regexp_replace(s, r"(?U)^Q([1-4])-(\d{4})$", "$2-Q$1")
    return F.regexp_replace(s, r"(?U)^(\d)th\s+Qtr\s+(\d{4})$", "$2-Q$1")


def find_year(c: Column) -> Column:
    """First free-standing four-digit number in the text, else NULL.

    All three quarter spellings hold exactly one such number, so they need no
    case of their own.
    """
    found = F.regexp_extract(c, r"(?U)\b(\d{4})\b", 1)
    return F.nullif(found, F.lit("")).try_cast("int")


def quarter_year(c: Column) -> Column:
    """Year of a ``YYYY-Q#`` text; NULL where the text does not start with one."""
    return F.substring(c, 1, 4).try_cast("int")


def in_quarters_of(c: Column, year: int) -> Column:
    """Prefix test, which Parquet can check against its statistics."""
    return c.startswith(f"{year:04d}")


def in_year(c: Column, year: int) -> Column:
    """Half-open range of a date or timestamp. Unlike ``year(c) = y`` it reaches
    the scan: the text bounds take the type of the column."""
    return (c >= F.lit(f"{year:04d}-01-01")) & (c < F.lit(f"{year + 1:04d}-01-01"))


def parse_month(c: Column, formats: Sequence[str] = MONTH_FORMATS) -> Column:
    """Date of a month or day. ISO spellings, with or without a day and a time,
    are a plain cast; the formats are only tried on what that leaves."""
    s = strip(c)
    iso = F.when(F.length(s) >= len("yyyy-MM"), s.try_cast("date"))
    return F.coalesce(iso, *[F.try_to_date(s, f) for f in formats])


def month_text(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM")


def quarter_text(c: Column) -> Column:
    """``YYYY-Q#`` of a date or timestamp."""
    return F.concat(F.year(c).cast("string"), F.lit("-Q"), F.quarter(c).cast("string"))
