"""Exact ratios, rounding, banding and flags.

Ratios are divided as DECIMAL so that ``round`` is half-away-from-zero on the
true quotient; report columns are then cast to DOUBLE.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Amounts as reports carry them.
EXACT = "decimal(24,4)"
# What is divided where both numbers are exactly that; others are divided as they are.
FINE = "decimal(24,12)"
# Sums of large values over a join.
WIDE = "decimal(34,12)"
# Quotients: exact to 12 decimals, or to the 6 or more that Spark keeps for wide operands.
QUOTIENT = "decimal(38,12)"
# Values a mean is taken of; larger ones are added up as DOUBLE.
VALUE = "decimal(16,10)"
MEAN = "decimal(38,16)"


def exact(c: Column) -> Column:
    return c.cast(EXACT)


def _operand(c: Column) -> Column:
    """Whole numbers as DECIMAL of their digits; DECIMAL and DOUBLE as they are."""
    return F.coalesce(c, F.lit(None).cast("decimal(1,0)"))


def _is_fine(c: Column) -> Column:
    """Whether FINE holds the number without bending it, but for the last bits of a DOUBLE."""
    fine = c.try_cast(FINE)
    same = (fine == c.try_cast("decimal(38,26)")) & ((fine == 0) == (c == 0))
    value = c.cast("double")
    near = F.typeof(c).isin("double", "float") & (F.abs(value - fine.cast("double")) <= F.abs(value) * 1e-14)
    return fine.isNotNull() & (same | near)


def _quotient(a: Column, b: Column, factor: int = 1) -> Column:
    """``factor`` x a / b, NULL only where a or b is NULL or b is 0.

    Numbers that FINE holds are divided as such. Others keep the precision and scale of
    their own types, so no number is rounded to 0 or found too large. A quotient of more
    than 26 digits before the point is an error.
    """
    a, b = _operand(a), _operand(b)
    fine = (a.try_cast(FINE) * F.lit(factor)).try_cast(FINE) / F.nullif(b.try_cast(FINE), F.lit(0).cast(FINE))
    own = a / F.nullif(b, F.lit(0))
    fits = _is_fine(a) & _is_fine(b) & fine.isNotNull()
    return F.when(fits, fine.cast(QUOTIENT)).otherwise(own.cast(QUOTIENT) * F.lit(factor)).cast(QUOTIENT)


def divide_or_null(a: Column, b: Column) -> Column:
    """Exact quotient, NULL where the divisor is 0; numbers of any size and scale."""
    return _quotient(a, b)


def divide_or(a: Column, b: Column, default: float = 0) -> Column:
    """Exact quotient, ``default`` where the divisor is 0 or anything is missing."""
    return F.coalesce(divide_or_null(a, b), F.lit(default).cast("decimal(20,10)"))


def mean_of_sums(total: Column, count: Column) -> Column:
    """Mean from a sum and a count that were aggregated (in steps) before."""
    return _quotient(total, count)


def mean(value: Column) -> Column:
    """Aggregate: the exact mean of a group, or the mean as DOUBLE carries it where a
    value or a sum has too many digits for that."""
    fine = value.try_cast(VALUE)
    whole = F.count(fine) == F.count(value)
    return F.coalesce(
        F.when(whole, mean_of_sums(F.try_sum(fine), F.count(fine)).try_cast(MEAN)),
        F.avg(value.cast("double")).try_cast(MEAN),
    )


def rounded(c: Column, digits: int) -> Column:
    """Round a DECIMAL half away from zero and hand it out as DOUBLE."""
    return F.round(c, digits).cast("double")


def ratio(a: Column, b: Column, digits: int) -> Column:
    return rounded(divide_or_null(a, b), digits)


def percent(a: Column, b: Column, digits: int = 2) -> Column:
    """``a / b`` in percent; scaled before dividing where that fits."""
    return rounded(_quotient(a, b, 100), digits)


def percent_change(now: Column, before: Column, digits: int = 2) -> Column:
    return percent(_operand(now) - _operand(before), before, digits)


def row_mean(*columns: Column) -> Column:
    """Mean of several columns of one row; NULL if any is NULL."""
    kind = "decimal(34,16)"
    total = columns[0].cast(kind)
    for c in columns[1:]:
        total = (total + c.cast(kind)).cast(kind)
    return (total / F.lit(len(columns))).cast(kind)


def weighted_score(terms: Sequence[tuple[Column, str]]) -> Column:
    """Sum of column x weight; weights are decimal texts so they stay exact."""
    score = None
    for c, weight in terms:
        term = c.cast("decimal(20,8)") * F.lit(weight).cast("decimal(16,12)")
        score = term if score is None else score + term
    return score


def band(c: Column, cuts: Mapping[str, float | str], otherwise: str) -> Column:
    """Label of the first cut that ``c`` reaches; give the cuts from high to low."""
    label = None
    for name, cut in cuts.items():
        reached = c >= F.lit(str(cut)).cast(FINE)
        label = F.when(reached, name) if label is None else label.when(reached, name)
    return label.otherwise(otherwise)


def yes_no(condition: Column) -> Column:
    return F.when(condition, "Yes").otherwise("No")
