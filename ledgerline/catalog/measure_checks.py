"""The measures, each under a grouping of its own, and the dashboard groupings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.catalog.analogue import star, with_ctes
from ledgerline.catalog.base import Tables, entry
from ledgerline.catalog.report_checks import PRIORITIES_SQL
from ledgerline.functions.arithmetic import percent, rounded
from ledgerline.operators.measures import evaluate, evaluate_groupings
from ledgerline.operators.period import date_dimension
from ledgerline.operators.share import with_group_total
from ledgerline.plans import reports

_YEAR = "left(quarter, 4)::BIGINT"


def _ratios(df: DataFrame, names: Sequence[str], digits: int = 4) -> DataFrame:
    return df.withColumns({n: rounded(F.col(n), digits) for n in names})


def _print(key: str, measure: str, value: str, by: str, by_sql: str, ratio: bool = False) -> None:
    _single(key, measure, value, by, by_sql, "print_sales", ratio)


def _single(
    key: str, measure: str, value: str, by: str, by_sql: str, fact: str, ratio: bool
) -> None:
    join = " JOIN dim_city USING (city_id)" if by in ("city", "tier") else ""
    if by in ("standard_ad_category", "category_group"):
        join = " JOIN dim_ad_category USING (ad_category_id)"
    shown = f"round({value}, 4)" if ratio else value
    sql = with_ctes(
        f"SELECT {by_sql} AS {by}, {shown} AS {measure} FROM {fact}{join} GROUP BY 1",
        fact,
        "dim_city",
        "dim_ad_category",
    )

    @entry(key, sql)
    def build(t: Tables) -> DataFrame:
        result = evaluate(star(t), [measure], [by])
        return _ratios(result, [measure]) if ratio else result


_YEAR_OF_MONTH = "year(month)::BIGINT"
_print("m1_total_copies_printed", "total_copies_printed", "sum(copies_printed)::BIGINT", "year", _YEAR_OF_MONTH)
_print("m2_total_copies_sold", "total_copies_sold", "sum(copies_sold)::BIGINT", "tier", "tier")
_print("m3_total_copies_returned", "total_copies_returned", "sum(copies_returned)::BIGINT", "city", "city")
_print("m4_total_net_circulation", "total_net_circulation", "sum(net_circulation)::BIGINT", "language", "language")
_print(
    "m5_print_return_waste_rate", "print_return_waste_rate",
    "coalesce(sum(copies_returned) / nullif(sum(copies_printed), 0), 0)", "year", _YEAR_OF_MONTH, True,
)
_print(
    "m6_print_efficiency", "print_efficiency",
    "coalesce(sum(net_circulation) / nullif(sum(copies_printed), 0), 0)", "city", "city", True,
)
_single(
    "m7_total_ad_revenue", "total_ad_revenue", "sum(ad_revenue_in_inr)::DOUBLE",
    "category_group", "category_group", "ad_revenue", False,
)


@entry(
    "m8_ad_revenue_per_circulated_copy",
    with_ctes(
        f"""SELECT year, round(coalesce(revenue::DOUBLE / nullif(net, 0), 0), 4)
                       AS ad_revenue_per_circulated_copy
            FROM (SELECT {_YEAR} AS year, sum(ad_revenue_in_inr) AS revenue
                  FROM ad_revenue GROUP BY 1)
            FULL JOIN (SELECT year(month)::BIGINT AS year, sum(net_circulation) AS net
                       FROM print_sales GROUP BY 1) USING (year)""",
        "ad_revenue",
        "print_sales",
    ),
)
def m8(t: Tables) -> DataFrame:
    name = "ad_revenue_per_circulated_copy"
    return _ratios(evaluate(star(t), [name], ["year"]), [name])


_single(
    "m9_avg_smartphone_penetration", "avg_smartphone_penetration", "avg(smartphone_penetration)",
    "year", _YEAR, "readiness", True,
)
_single(
    "m10_avg_internet_penetration", "avg_internet_penetration", "avg(internet_penetration)",
    "tier", "tier", "readiness", True,
)
_single(
    "m11_composite_digital_readiness", "composite_digital_readiness",
    "avg((literacy_rate + smartphone_penetration + internet_penetration) / 3)",
    "city", "city", "readiness", True,
)
_single(
    "m12_total_dev_cost", "total_dev_cost", "sum(dev_cost)::DOUBLE",
    "platform", "platform", "pilot", False,
)
_single(
    "m13_total_marketing_cost", "total_marketing_cost", "sum(marketing_cost)::DOUBLE",
    "standard_ad_category", "standard_ad_category", "pilot", False,
)
_single(
    "m14_total_downloads", "total_downloads", "sum(downloads_or_accesses)::BIGINT",
    "city", "city", "pilot", False,
)
_single(
    "m15_digital_pilot_engagement_rate", "digital_pilot_engagement_rate",
    "coalesce(sum(downloads_or_accesses) / nullif(sum(users_reached), 0), 0)",
    "city", "city", "pilot", True,
)
_single(
    "m16_avg_bounce_rate", "avg_bounce_rate", "avg(avg_bounce_rate)",
    "platform", "platform", "pilot", True,
)


@entry(
    "g0_overview_cards",
    with_ctes(
        """SELECT (SELECT sum(net_circulation)::BIGINT FROM print_sales) AS total_net_circulation,
                  (SELECT sum(ad_revenue_in_inr)::DOUBLE FROM ad_revenue) AS total_ad_revenue,
                  (SELECT round(sum(net_circulation) / sum(copies_printed), 4) FROM print_sales)
                      AS print_efficiency,
                  (SELECT round(avg((literacy_rate + smartphone_penetration
                                     + internet_penetration) / 3), 4) FROM readiness)
                      AS composite_digital_readiness""",
        "print_sales",
        "ad_revenue",
        "readiness",
    ),
)
def g0(t: Tables) -> DataFrame:
    names = [
        "total_net_circulation", "total_ad_revenue", "print_efficiency",
        "composite_digital_readiness",
    ]
    return _ratios(evaluate(star(t), names), names[2:])


@entry(
    "g1_revenue_by_tier",
    with_ctes(
        """SELECT tier, sum(ad_revenue_in_inr)::DOUBLE AS total_ad_revenue
           FROM ad_revenue JOIN dim_city USING (city_id) GROUP BY 1""",
        "ad_revenue",
        "dim_city",
    ),
)
def g1(t: Tables) -> DataFrame:
    return evaluate(star(t), ["total_ad_revenue"], ["tier"])


@entry(
    "g2_waste_rate_by_city",
    with_ctes(
        """SELECT city, round(sum(copies_returned) / sum(copies_printed), 4)
                      AS print_return_waste_rate
           FROM print_sales JOIN dim_city USING (city_id) GROUP BY 1""",
        "print_sales",
        "dim_city",
    ),
)
def g2(t: Tables) -> DataFrame:
    name = "print_return_waste_rate"
    return _ratios(evaluate(star(t), [name], ["city"]), [name])


@entry(
    "g3_city_language_matrix",
    with_ctes(
        """SELECT city, language, sum(copies_printed)::BIGINT AS total_copies_printed,
                  sum(copies_returned)::BIGINT AS total_copies_returned,
                  sum(net_circulation)::BIGINT AS total_net_circulation,
                  round(sum(net_circulation) / sum(copies_printed), 4) AS print_efficiency
           FROM print_sales JOIN dim_city USING (city_id) GROUP BY 1, 2""",
        "print_sales",
        "dim_city",
    ),
)
def g3(t: Tables) -> DataFrame:
    names = [
        "total_copies_printed", "total_copies_returned", "total_net_circulation",
        "print_efficiency",
    ]
    return _ratios(evaluate(star(t), names, ["city", "language"]), names[3:])


@entry(
    "g4_revenue_share_by_category",
    with_ctes(
        """SELECT standard_ad_category, total::DOUBLE AS total_ad_revenue,
                  round(100 * total::DOUBLE / (sum(total) OVER ())::DOUBLE, 2) AS share_pct
           FROM (SELECT standard_ad_category, sum(ad_revenue_in_inr) AS total
                 FROM ad_revenue JOIN dim_ad_category USING (ad_category_id) GROUP BY 1)""",
        "ad_revenue",
        "dim_ad_category",
    ),
)
def g4(t: Tables) -> DataFrame:
    totals = evaluate(star(t), ["total_ad_revenue"], ["standard_ad_category"])
    shared = with_group_total(totals, [], "total_ad_revenue", "_all")
    pct = percent(F.col("total_ad_revenue"), F.col("_all"))
    return shared.withColumn("share_pct", pct).drop("_all")


@entry(
    "g5_revenue_and_roi_by_year",
    with_ctes(
        f"""SELECT year, revenue::DOUBLE AS total_ad_revenue,
                   round(coalesce(revenue::DOUBLE / net, 0), 4) AS ad_revenue_per_circulated_copy
            FROM (SELECT {_YEAR} AS year, sum(ad_revenue_in_inr) AS revenue
                  FROM ad_revenue GROUP BY 1)
            FULL JOIN (SELECT year(month)::BIGINT AS year, sum(net_circulation) AS net
                       FROM print_sales GROUP BY 1) USING (year)""",
        "ad_revenue",
        "print_sales",
    ),
)
def g5(t: Tables) -> DataFrame:
    names = ["total_ad_revenue", "ad_revenue_per_circulated_copy"]
    return _ratios(evaluate(star(t), names, ["year"]), names[1:])


@entry(
    "g6_readiness_and_downloads_by_city",
    with_ctes(
        """SELECT city, round(readiness, 4) AS composite_digital_readiness,
                  downloads AS total_downloads
           FROM (SELECT city, avg((literacy_rate + smartphone_penetration
                                   + internet_penetration) / 3) AS readiness
                 FROM readiness JOIN dim_city USING (city_id) GROUP BY 1)
           FULL JOIN (SELECT city, sum(downloads_or_accesses)::BIGINT AS downloads
                      FROM pilot JOIN dim_city USING (city_id) GROUP BY 1) USING (city)""",
        "readiness",
        "pilot",
        "dim_city",
    ),
)
def g6(t: Tables) -> DataFrame:
    names = ["composite_digital_readiness", "total_downloads"]
    return _ratios(evaluate(star(t), names, ["city"]), names[:1])


#: What a dashboard shows, from one scan of each fact.
DASHBOARD = {
    "overall": ([], ["total_net_circulation", "total_ad_revenue"]),
    "tier": (["tier"], ["total_ad_revenue"]),
    "city": (["city"], ["print_return_waste_rate", "total_downloads"]),
    "city and language": (["city", "language"], ["total_copies_printed", "total_net_circulation"]),
    "category": (["standard_ad_category"], ["total_ad_revenue"]),
    "year": (["year"], ["total_ad_revenue", "total_net_circulation"]),
}


@entry(
    "g9_dashboard_groupings",
    with_ctes(
        f"""SELECT * FROM (WITH
            net AS (SELECT *, year(month)::BIGINT AS year FROM print_sales LEFT JOIN dim_city USING (city_id)),
            ads AS (SELECT *, {_YEAR} AS year FROM ad_revenue LEFT JOIN dim_city USING (city_id)),
            by_name AS (
              SELECT 'overall' AS grouped_by, sum(net_circulation)::BIGINT AS total_net_circulation,
                     (SELECT sum(ad_revenue_in_inr)::DOUBLE FROM ads) AS total_ad_revenue FROM net
              UNION ALL BY NAME
              SELECT 'tier' AS grouped_by, tier, sum(ad_revenue_in_inr)::DOUBLE AS total_ad_revenue
              FROM ads WHERE city IS NOT NULL GROUP BY tier
              UNION ALL BY NAME
              SELECT 'city' AS grouped_by, city, coalesce(rate, 0.0) AS print_return_waste_rate, total_downloads
              FROM (SELECT city, round(sum(copies_returned) / sum(copies_printed), 4) AS rate
                    FROM net WHERE city IS NOT NULL GROUP BY city)
              FULL JOIN (SELECT city, sum(downloads_or_accesses)::BIGINT AS total_downloads
                         FROM pilot JOIN dim_city USING (city_id) GROUP BY city) USING (city)
              UNION ALL BY NAME
              SELECT 'city and language' AS grouped_by, city, language, sum(copies_printed)::BIGINT AS total_copies_printed,
                     sum(net_circulation)::BIGINT AS total_net_circulation
              FROM net WHERE city IS NOT NULL GROUP BY city, language
              UNION ALL BY NAME
              SELECT 'category' AS grouped_by, standard_ad_category, sum(ad_revenue_in_inr)::DOUBLE AS total_ad_revenue
              FROM ad_revenue JOIN dim_ad_category USING (ad_category_id) GROUP BY standard_ad_category
              UNION ALL BY NAME
              SELECT 'year' AS grouped_by, year, total_ad_revenue, total_net_circulation
              FROM (SELECT year, sum(ad_revenue_in_inr)::DOUBLE AS total_ad_revenue FROM ads GROUP BY year)
              FULL JOIN (SELECT year, sum(net_circulation)::BIGINT AS total_net_circulation FROM net GROUP BY year)
                   USING (year))
            SELECT * FROM by_name)""",
        "print_sales",
        "ad_revenue",
        "pilot",
        "dim_city",
        "dim_ad_category",
    ),
)
def g9(t: Tables) -> DataFrame:
    name = "print_return_waste_rate"
    return _ratios(evaluate_groupings(star(t), DASHBOARD), [name])


@entry("g7_relaunch_scorecard", PRIORITIES_SQL)
def g7(t: Tables) -> DataFrame:
    return reports.relaunch_priorities(star(t))


@entry(
    "g8_date_dimension",
    """SELECT strftime(d, '%Y-%m-%d') AS date, year(d)::BIGINT AS year,
              quarter(d)::BIGINT AS quarter, month(d)::BIGINT AS month
       FROM (SELECT unnest(generate_series(
                 (SELECT date_trunc('year', min(l_shipdate)) FROM lineitem),
                 (SELECT date_trunc('year', max(l_shipdate)) + INTERVAL 1 YEAR - INTERVAL 1 DAY
                  FROM lineitem), INTERVAL 1 DAY)) AS d)""",
)
def g8(t: Tables) -> DataFrame:
    return date_dimension(t.lineitem, "l_shipdate")


@entry(
    "g9_revenue_and_circulation_by_quarter",
    with_ctes(
        """WITH p AS (SELECT year(month) || '-Q' || quarter(month) AS quarter, sum(net_circulation) AS net
                      FROM print_sales GROUP BY 1),
                a AS (SELECT quarter, sum(ad_revenue_in_inr) AS revenue FROM ad_revenue GROUP BY 1)
           SELECT coalesce(p.quarter, a.quarter) AS quarter, revenue::DOUBLE AS total_ad_revenue,
                  net::BIGINT AS total_net_circulation FROM p FULL JOIN a ON p.quarter = a.quarter""",
        "print_sales",
        "ad_revenue",
    ),
)
def g9(t: Tables) -> DataFrame:
    """Figures of facts with a date and with a quarter, side by side."""
    return evaluate(star(t), ["total_ad_revenue", "total_net_circulation"], ["quarter"])


@entry(
    "g10_copies_by_calendar_month",
    with_ctes(
        """SELECT year(month)::BIGINT AS year, month(month)::BIGINT AS month, sum(copies_sold)::BIGINT AS copies
           FROM print_sales GROUP BY 1, 2""",
        "print_sales",
    ),
)
def g10(t: Tables) -> DataFrame:
    """The date dimension as a grouping: a fact's days looked up in the calendar."""
    sales = star(t).print_sales
    days = sales.groupBy(F.col("month").alias("date")).agg(F.sum("copies_sold").alias("copies"))
    calendar = date_dimension(sales, "month")
    return days.join(calendar, "date").groupBy("year", "month").agg(F.sum("copies").alias("copies"))
