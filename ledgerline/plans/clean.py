"""Raw table -> cleaned table, and the rules a cleaned table has to keep."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.money import currency_code, to_base_currency
from ledgerline.functions.numbers import clean_decimal, clean_int
from ledgerline.functions.periods import normalize_quarter, parse_month
from ledgerline.functions.text import (
    STATE_NAMES,
    blank_to_null,
    key_from_code,
    remap,
    state_name,
    strip,
    title_case,
)
from ledgerline.operators import quality as q
from ledgerline.operators.consolidate import consolidate, keep_first
from ledgerline.sources.raw import ORDINAL

PRINT_KEYS = ("edition_id", "city_id", "language", "state", "month")
REVENUE_KEYS = ("edition_id", "city_id", "ad_category_id", "quarter")
TIERS = ("Tier 1", "Tier 2", "Tier 3")


# Raw exports come from loaders that type each cell, so a text that is a number
# literal counts as that number. What still cannot be read becomes NULL and is
# then caught by a NOT NULL rule.
def _count(c: Column) -> Column:
    return clean_int(c, on_bad="null", plain_numbers=True)


def _amount(c: Column, precision: int = 18, scale: int = 4) -> Column:
    return clean_decimal(c, precision, scale, plain_numbers=True)


def dim_city(raw: DataFrame) -> DataFrame:
    return raw.select(
        "city_id",
        title_case(strip(F.col("city"))).alias("city"),
        state_name(F.col("state")).alias("state"),
        strip(F.col("tier")).alias("tier"),
    )


def dim_ad_category(raw: DataFrame) -> DataFrame:
    texts = ["standard_ad_category", "category_group", "example_brands"]
    return raw.select("ad_category_id", *[strip(F.col(c)).alias(c) for c in texts])


def fact_print_sales(raw: DataFrame, order: Sequence[str] = ORDINAL) -> DataFrame:
    """The column ``Copies Sold`` holds the printed run; what was sold is the net
    circulation. Of rows with equal keys the first in ``order`` is kept."""
    copies = ["Copies Sold", "copies_returned", "Net_Circulation"]
    rows = raw.select(
        strip(F.col("edition_ID")).alias("edition_id"),
        strip(F.col("City_ID")).alias("city_id"),
        title_case(strip(F.col("Language"))).alias("language"),
        title_case(strip(F.col("State"))).alias("state"),
        parse_month(F.col("Month")).alias("month"),
        *copies,
        *order,
    )
    # A step of its own, as the lookup reads the column twice.
    rows = rows.withColumn("state", remap(F.col("state"), STATE_NAMES))
    # Only the rows that stay have their numbers parsed.
    net = _count(F.col("Net_Circulation"))
    return keep_first(rows, PRINT_KEYS, order).withColumn("net_circulation", net).select(
        *PRINT_KEYS,
        F.col("net_circulation").alias("copies_sold"),
        _count(F.col("Copies Sold")).alias("copies_printed"),
        _count(F.col("copies_returned")).alias("copies_returned"),
        "net_circulation",
        *order,
    )


def ad_revenue_rows(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Cleaned revenue rows before duplicates are merged."""
    edition = strip(F.col("edition_id"))
    amount = _amount(F.col("ad_revenue"))
    currency = currency_code(F.col("currency"))
    return raw.select(
        edition.alias("edition_id"),
        key_from_code(edition).alias("city_id"),
        strip(F.col("ad_category")).alias("ad_category_id"),
        normalize_quarter(F.col("quarter")).alias("quarter"),
        currency.alias("currency"),
        amount.alias("raw_ad_revenue"),
        to_base_currency(amount, currency).cast("decimal(18,4)").alias("ad_revenue_in_inr"),
        blank_to_null(strip(F.col("comments"))).alias("comments"),
        *keep,
    )


def fact_ad_revenue(
    raw: DataFrame, order: Sequence[str] = ORDINAL, chunk: Sequence[Column] | None = None
) -> DataFrame:
    """One row per edition, category and quarter, in INR.

    ``raw_ad_revenue`` adds up amounts of different currencies; it is kept for
    tracing back and is no amount of money. Comments are joined in file order,
    first within each file split.
    """
    if chunk is None:
        chunk = [F.col(c) for c in ORDINAL[:2]] if tuple(order) == ORDINAL else []
    merged = consolidate(
        ad_revenue_rows(raw, order),
        REVENUE_KEYS,
        ["raw_ad_revenue", "ad_revenue_in_inr"],
        "comments",
        order,
        chunk,
    )
    return merged.select(
        *REVENUE_KEYS,
        "raw_ad_revenue",
        F.lit("INR").alias("currency"),
        "ad_revenue_in_inr",
        "comments",
    )


def fact_city_readiness(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    rates = ["literacy_rate", "smartphone_penetration", "internet_penetration"]
    return raw.select(
        strip(F.col("city_id")).alias("city_id"),
        normalize_quarter(F.col("quarter")).alias("quarter"),
        *[_amount(F.col(c), 18, 10).alias(c) for c in rates],
        *keep,
    )


def fact_digital_pilot(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    bounce = (_amount(F.col("avg_bounce_rate")) / 100).cast("decimal(9,6)")
    return raw.select(
        strip(F.col("platform")).alias("platform"),
        strip(F.col("launch_month")).alias("launch_month"),
        strip(F.col("ad_category_id")).alias("ad_category_id"),
        _amount(F.col("dev_cost")).alias("dev_cost"),
        _amount(F.col("marketing_cost")).alias("marketing_cost"),
        _count(F.col("users_reached")).alias("users_reached"),
        _count(F.col("downloads_or_accesses")).alias("downloads_or_accesses"),
        bounce.alias("avg_bounce_rate"),
        strip(F.col("cumulative_feedback_from_customers")).alias(
            "cumulative_feedback_from_customers"
        ),
        strip(F.col("city_id")).alias("city_id"),
        *keep,
    )


# --- rules -------------------------------------------------------------------


def _lengths(limits: Mapping[str, int]) -> list[q.Rule]:
    return [q.max_length(c, n) for c, n in limits.items()]


def dim_city_rules() -> list[q.Rule]:
    return [
        q.unique("city_id"),
        *q.not_null("city_id", "city", "state", "tier"),
        q.one_of("tier", TIERS),
        *_lengths({"city_id": 10, "city": 50, "state": 50, "tier": 10}),
    ]


def dim_ad_category_rules() -> list[q.Rule]:
    return [
        q.unique("ad_category_id"),
        *q.not_null("ad_category_id", "standard_ad_category", "category_group"),
        *_lengths(
            {
                "ad_category_id": 10,
                "standard_ad_category": 50,
                "category_group": 50,
                "example_brands": 255,
            }
        ),
    ]


def fact_ad_revenue_rules(cities: DataFrame, categories: DataFrame) -> list[q.Rule]:
    return [
        *q.not_null(*REVENUE_KEYS, "raw_ad_revenue", "currency", "ad_revenue_in_inr"),
        q.references(["city_id"], cities),
        q.references(["ad_category_id"], categories),
        *_lengths(
            {"edition_id": 10, "city_id": 10, "ad_category_id": 10, "quarter": 10, "currency": 20}
        ),
    ]


def fact_city_readiness_rules(cities: DataFrame) -> list[q.Rule]:
    rates = ["literacy_rate", "smartphone_penetration", "internet_penetration"]
    return [
        *q.not_null("city_id", "quarter", *rates),
        q.references(["city_id"], cities),
        *[q.in_range(c, 0, 100) for c in rates],
        *_lengths({"city_id": 10, "quarter": 10}),
    ]


def fact_digital_pilot_rules(cities: DataFrame, categories: DataFrame) -> list[q.Rule]:
    return [
        *q.not_null(
            "platform",
            "launch_month",
            "ad_category_id",
            "dev_cost",
            "marketing_cost",
            "users_reached",
            "downloads_or_accesses",
            "city_id",
        ),
        q.references(["city_id"], cities),
        q.references(["ad_category_id"], categories),
        *q.not_negative("users_reached", "downloads_or_accesses"),
        q.in_range("avg_bounce_rate", 0, 1),
        *_lengths({"platform": 50, "launch_month": 10, "ad_category_id": 10, "city_id": 10}),
    ]


def fact_print_sales_rules(cities: DataFrame) -> list[q.Rule]:
    copies = ["copies_sold", "copies_printed", "copies_returned", "net_circulation"]
    return [
        *q.not_null(*PRINT_KEYS, *copies),
        q.references(["city_id"], cities),
        *q.not_negative(*copies),
        q.holds(
            "net_circulation = copies_printed - copies_returned",
            F.col("net_circulation") == F.col("copies_printed") - F.col("copies_returned"),
        ),
        *_lengths({"edition_id": 10, "city_id": 10, "language": 50, "state": 50}),
    ]


CLEANERS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "dim_city": dim_city,
    "dim_ad_category": dim_ad_category,
    "fact_print_sales": fact_print_sales,
    "fact_ad_revenue": fact_ad_revenue,
    "fact_city_readiness": fact_city_readiness,
    "fact_digital_pilot": fact_digital_pilot,
}
