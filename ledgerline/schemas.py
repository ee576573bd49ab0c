"""Table layouts of the raw and the cleaned layer."""

from __future__ import annotations

from pyspark.sql.types import StructType

RAW_COLUMNS = {
    "dim_city": ["city_id", "city", "state", "tier"],
    "dim_ad_category": [
        "ad_category_id", "standard_ad_category", "category_group", "example_brands",
    ],
    "fact_ad_revenue": [
        "edition_id", "ad_category", "quarter", "ad_revenue", "currency", "comments",
    ],
    "fact_city_readiness": [
        "index", "city_id", "quarter",
        "literacy_rate", "smartphone_penetration", "internet_penetration",
    ],
    "fact_digital_pilot": [
        "index", "platform", "launch_month", "ad_category_id", "dev_cost", "marketing_cost",
        "users_reached", "downloads_or_accesses", "avg_bounce_rate",
        "cumulative_feedback_from_customers", "city_id",
    ],
    "fact_print_sales": [
        "edition_ID", "City_ID", "Language", "State", "Month",
        "Copies Sold", "copies_returned", "Net_Circulation",
    ],
}

# Tables with free text, whose quoted fields may hold line breaks.
MULTI_LINE_TABLES = frozenset({"fact_digital_pilot"})

_MONEY = "DECIMAL(18,4)"
_RATE = "DECIMAL(18,10)"

_CLEANED_DDL = {
    "dim_city": "city_id STRING, city STRING, state STRING, tier STRING",
    "dim_ad_category": (
        "ad_category_id STRING, standard_ad_category STRING, "
        "category_group STRING, example_brands STRING"
    ),
    "fact_ad_revenue": (
        "id BIGINT, edition_id STRING, city_id STRING, ad_category_id STRING, quarter STRING, "
        f"raw_ad_revenue {_MONEY}, currency STRING, ad_revenue_in_inr {_MONEY}, comments STRING"
    ),
    "fact_city_readiness": (
        f"id BIGINT, city_id STRING, quarter STRING, literacy_rate {_RATE}, "
        f"smartphone_penetration {_RATE}, internet_penetration {_RATE}"
    ),
    "fact_digital_pilot": (
        "id BIGINT, platform STRING, launch_month STRING, ad_category_id STRING, "
        f"dev_cost {_MONEY}, marketing_cost {_MONEY}, users_reached INT, "
        "downloads_or_accesses INT, avg_bounce_rate DECIMAL(9,6), "
        "cumulative_feedback_from_customers STRING, city_id STRING"
    ),
    "fact_print_sales": (
        "id BIGINT, edition_id STRING, city_id STRING, language STRING, state STRING, "
        "month DATE, copies_sold INT, copies_printed INT, copies_returned INT, "
        "net_circulation INT"
    ),
}

TABLES = tuple(_CLEANED_DDL)


def raw_schema(table: str) -> StructType:
    return StructType.fromDDL(", ".join(f"`{c}` STRING" for c in RAW_COLUMNS[table]))


def cleaned_schema(table: str) -> StructType:
    return StructType.fromDDL(_CLEANED_DDL[table])
