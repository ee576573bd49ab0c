"""Currency codes and conversion to the reporting currency."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline.functions.text import remap, strip

# Units of the reporting currency (INR) per unit of each code.
INR_RATES = {"INR": 1, "IN RUPEES": 1, "USD": 80, "EUR": 85}

# Codes that are another name of a standard one.
CURRENCY_ALIASES = {"IN RUPEES": "INR"}

CRORE = 10_000_000
LAKH = 100_000


def currency_code(c: Column, aliases: Mapping[str, str] = CURRENCY_ALIASES) -> Column:
    return remap(F.upper(strip(c)), aliases)


def exchange_rate(currency: Column, rates: Mapping[str, int | str] = INR_RATES) -> Column:
    """Rate of a code, 1 for codes that are unknown or missing. Rates that are not whole
    are given as decimal texts, so that money stays exact."""
    whole = all(isinstance(r, int) for r in rates.values())

    def rate(r: int | str) -> Column:
        return F.lit(r) if whole else F.lit(str(r)).cast("decimal(18,6)")

    pairs = [x for code, r in rates.items() for x in (F.lit(code), rate(r))]
    return F.coalesce(F.create_map(*pairs)[F.upper(strip(currency))], rate(1))


def to_base_currency(
    amount: Column, currency: Column, rates: Mapping[str, int | str] = INR_RATES
) -> Column:
    return amount * exchange_rate(currency, rates)
