"""Profiles of the raw revenue table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.catalog import analogue as a
from ledgerline.catalog.analogue import with_ctes
from ledgerline.catalog.base import Tables, entry
from ledgerline.catalog.cleaning import _RATE, _YEAR, _money
from ledgerline.functions import money, numbers, periods
from ledgerline.operators import profile

_AMOUNT = _money("ad_revenue")


def _amount():
    return numbers.clean_decimal(F.col("ad_revenue"))


# The scripts these two come from only strip commas, so they see what that makes a number.
_GROUPED = "replace(trim(ad_revenue), ',', '')"
_READABLE = r"^\s*[0-9][0-9,]*(\.[0-9]+)?\s*$"


def _grouped_rows(t: Tables) -> DataFrame:
    return a.raw_ad_revenue(t).where(F.col("ad_revenue").rlike(_READABLE))


def _grouped_amount():
    return numbers.parse_grouped(F.col("ad_revenue"), "decimal(18,4)")


def _grouped_sql(sql: str) -> str:
    """The same query on the readable rows with the parsed amount."""
    return sql.replace(_AMOUNT, f"({_GROUPED})::DECIMAL(18,4)").replace(
        "FROM raw_ad_revenue", f"FROM (SELECT * FROM raw_ad_revenue WHERE regexp_matches(ad_revenue, '{_READABLE}'))"
    )


def _year():
    return periods.find_year(F.col("quarter"))


@entry("pr1_dump_dimension", with_ctes("SELECT * FROM dim_ad_category", "dim_ad_category"))
def pr1(t: Tables) -> DataFrame:
    return a.dim_ad_category(t)


@entry(
    "pr2_comments",
    with_ctes(
        """SELECT comments, count(*)::BIGINT AS n FROM raw_ad_revenue
           WHERE comments IS NOT NULL GROUP BY 1""",
        "raw_ad_revenue",
    ),
)
def pr2(t: Tables) -> DataFrame:
    rows = a.raw_ad_revenue(t).withColumn("one", F.lit(1))
    return profile.sums_by_key(rows, ["comments"], "one", "n")


@entry(
    "pr3_missing_years",
    with_ctes(
        f"""SELECT count(*)::BIGINT AS total_rows,
                   count(*) FILTER (({_YEAR}) IS NULL)::BIGINT AS null_year
            FROM raw_ad_revenue""",
        "raw_ad_revenue",
    ),
)
def pr3(t: Tables) -> DataFrame:
    return profile.null_counts(a.raw_ad_revenue(t).withColumn("year", _year()), ["year"])


def _share_sql(amount: str, name: str, total: str) -> str:
    return with_ctes(
        f"""WITH sums AS (SELECT {_YEAR} AS year, ad_category, sum({amount}) AS v
                          FROM raw_ad_revenue GROUP BY 1, 2)
            SELECT year, ad_category, v::DOUBLE AS {name},
                   (sum(v) OVER (PARTITION BY year))::DOUBLE AS {total},
                   v::DOUBLE / (sum(v) OVER (PARTITION BY year))::DOUBLE * 100 AS pct
            FROM sums WHERE year IS NOT NULL""",
        "raw_ad_revenue",
    )


@entry("pr4_converted_share", _share_sql(f"{_AMOUNT} * ({_RATE})", "revenue_inr", "total_revenue"))
def pr4(t: Tables) -> DataFrame:
    converted = money.to_base_currency(_amount(), F.col("currency"))
    return profile.raw_share(
        a.raw_ad_revenue(t),
        {"year": _year(), "revenue_inr": converted},
        "year",
        "ad_category",
        "revenue_inr",
        "total_revenue",
    )


def _sums_sql(key: str) -> str:
    return with_ctes(
        f"""SELECT {key}, sum({_AMOUNT})::DOUBLE AS ad_revenue FROM raw_ad_revenue
            WHERE {key} IS NOT NULL GROUP BY 1""",
        "raw_ad_revenue",
    )


@entry("pr5_sums_by_category", _sums_sql("ad_category"))
def pr5_category(t: Tables) -> DataFrame:
    rows = a.raw_ad_revenue(t).withColumn("amount", _amount())
    return profile.sums_by_key(rows, ["ad_category"], "amount", "ad_revenue")


@entry("pr5_sums_by_currency", _sums_sql("currency"))
def pr5_currency(t: Tables) -> DataFrame:
    rows = a.raw_ad_revenue(t).withColumn("amount", _amount())
    return profile.sums_by_key(rows, ["currency"], "amount", "ad_revenue")


@entry("pr6_unconverted_share", _grouped_sql(_share_sql(_AMOUNT, "revenue_clean", "total_revenue")))
def pr6(t: Tables) -> DataFrame:
    return profile.raw_share(
        _grouped_rows(t),
        {"year": _year(), "revenue_clean": _grouped_amount()},
        "year",
        "ad_category",
        "revenue_clean",
        "total_revenue",
    )


@entry(
    "pr7_sums_by_year_category_currency",
    _grouped_sql(with_ctes(
        f"""SELECT * FROM (SELECT {_YEAR} AS year, ad_category, currency,
                                  sum({_AMOUNT})::DOUBLE AS ad_revenue
                           FROM raw_ad_revenue GROUP BY 1, 2, 3)
            WHERE year IS NOT NULL AND currency IS NOT NULL""",
        "raw_ad_revenue",
    )),
)
def pr7(t: Tables) -> DataFrame:
    rows = _grouped_rows(t).withColumns({"year": _year(), "amount": _grouped_amount()})
    return profile.sums_by_key(rows, ["year", "ad_category", "currency"], "amount", "ad_revenue")
