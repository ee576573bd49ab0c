"""All reports on the test star schema. Years and thresholds fit its data."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ledgerline.catalog.analogue import star, with_ctes
from ledgerline.catalog.base import Tables, entry
from ledgerline.plans import reports

_YEAR = "left(quarter, 4)::BIGINT"
_CITY_YEAR = f"""
    ads AS (SELECT city_id, {_YEAR} AS year, sum(ad_revenue_in_inr) AS revenue
            FROM ad_revenue GROUP BY 1, 2),
    prints AS (SELECT city_id, year(month)::BIGINT AS year, sum(copies_printed)::BIGINT AS printed,
                      sum(copies_sold)::BIGINT AS sold, sum(net_circulation)::BIGINT AS net
               FROM print_sales GROUP BY 1, 2)"""
_CATEGORY = f"""
    per_category AS (SELECT {_YEAR} AS year, standard_ad_category AS category_name,
                            sum(ad_revenue_in_inr) AS revenue
                     FROM ad_revenue JOIN dim_ad_category USING (ad_category_id) GROUP BY 1, 2)"""
_SCORE = "(smartphone_penetration + internet_penetration + literacy_rate) / 3"


@entry(
    "br1_largest_monthly_drops",
    with_ctes(
        """WITH steps AS (
             SELECT city_id, month, edition_id, net_circulation,
                    lag(net_circulation) OVER (PARTITION BY city_id ORDER BY month, edition_id)
                        AS before
             FROM print_sales)
           SELECT city AS city_name, strftime(month, '%Y-%m') AS month,
                  before AS previous_month_circulation, net_circulation,
                  before - net_circulation AS circulation_drop
           FROM steps JOIN dim_city USING (city_id)
           WHERE net_circulation < before
           ORDER BY before - net_circulation DESC, city_id, steps.month, edition_id LIMIT 3""",
        "print_sales",
        "dim_city",
    ),
)
def br1(t: Tables) -> DataFrame:
    return reports.largest_monthly_drops(star(t), k=3, row_order=("month", "edition_id"))


@entry(
    "br1_largest_monthly_total_drops",
    with_ctes(
        """WITH monthly AS (SELECT city_id, month, sum(net_circulation)::BIGINT AS net
                            FROM print_sales GROUP BY 1, 2),
                steps AS (SELECT *, lag(net) OVER (PARTITION BY city_id ORDER BY month) AS before
                          FROM monthly)
           SELECT city AS city_name, strftime(month, '%Y-%m') AS month,
                  before AS previous_month_circulation, net AS net_circulation,
                  before - net AS circulation_drop
           FROM steps JOIN dim_city USING (city_id)
           WHERE net < before ORDER BY before - net DESC, city_id, month LIMIT 10""",
        "print_sales",
        "dim_city",
    ),
)
def br1_totals(t: Tables) -> DataFrame:
    return reports.largest_monthly_total_drops(star(t), k=10)


_BR2 = with_ctes(
    f"""WITH {_CATEGORY}
        SELECT year, category_name, revenue::DOUBLE AS category_revenue,
               total::DOUBLE AS total_revenue_year,
               round(revenue::DOUBLE / total::DOUBLE * 100, 2) AS pct_of_year_total
        FROM per_category
        JOIN (SELECT {_YEAR} AS year, sum(ad_revenue_in_inr) AS total FROM ad_revenue GROUP BY 1)
             USING (year)""",
    "ad_revenue",
    "dim_ad_category",
)


@entry("br2_category_concentration", _BR2)
def br2(t: Tables) -> DataFrame:
    return reports.category_concentration(star(t))


@entry("br2_category_above_share", f"SELECT * FROM ({_BR2}) WHERE pct_of_year_total > 21")
def br2_above(t: Tables) -> DataFrame:
    return reports.category_concentration(star(t), min_share=0.21)


@entry(
    "br3_print_efficiency_leaderboard",
    with_ctes(
        f"""WITH {_CITY_YEAR},
             scored AS (SELECT city AS city_name, sum(printed)::BIGINT AS copies_printed_2000,
                               sum(net)::BIGINT AS net_circulation_2000,
                               round(sum(net) / nullif(sum(printed), 0), 4) AS efficiency_ratio
                        FROM prints JOIN dim_city USING (city_id) WHERE year = 2000 GROUP BY 1)
            SELECT *, (dense_rank() OVER (ORDER BY efficiency_ratio DESC))::BIGINT
                          AS efficiency_rank_2000
            FROM scored ORDER BY efficiency_ratio DESC, city_name LIMIT 5""",
        "print_sales",
        "ad_revenue",
        "dim_city",
    ),
)
def br3(t: Tables) -> DataFrame:
    return reports.print_efficiency_leaderboard(star(t, 2000), year=2000)


@entry(
    "br4_internet_readiness_growth",
    with_ctes(
        """SELECT city AS city_name, round(q1.rate, 2) AS internet_rate_q1_1997,
                  round(q4.rate, 2) AS internet_rate_q4_1997,
                  round(q4.rate - q1.rate, 2) AS delta_internet_rate
           FROM (SELECT city_id, avg(internet_penetration) AS rate FROM readiness
                 WHERE quarter = '1997-Q1' GROUP BY 1) q1
           JOIN (SELECT city_id, avg(internet_penetration) AS rate FROM readiness
                 WHERE quarter = '1997-Q4' GROUP BY 1) q4 USING (city_id)
           JOIN dim_city USING (city_id)""",
        "readiness",
        "dim_city",
    ),
)
def br4(t: Tables) -> DataFrame:
    return reports.internet_readiness_growth(star(t, 1997), "1997-Q1", "1997-Q4")


@entry(
    "br5_multi_year_decline",
    with_ctes(
        f"""WITH {_CITY_YEAR},
             steps AS (SELECT city AS city_name, year, net, revenue,
                              lag(net) OVER (PARTITION BY city ORDER BY year) AS net_before,
                              lag(revenue) OVER (PARTITION BY city ORDER BY year) AS revenue_before
                       FROM ads JOIN prints USING (city_id, year) JOIN dim_city USING (city_id)),
             status AS (SELECT city_name, count(*) FILTER (net < net_before) = 3 AS p,
                               count(*) FILTER (revenue < revenue_before) = 3 AS r
                        FROM steps GROUP BY 1)
            SELECT city_name, year, net AS yearly_net_circulation,
                   revenue::DOUBLE AS yearly_ad_revenue,
                   CASE WHEN p THEN 'Yes' ELSE 'No' END AS is_declining_print,
                   CASE WHEN r THEN 'Yes' ELSE 'No' END AS is_declining_ad_revenue,
                   CASE WHEN p AND r THEN 'Yes' ELSE 'No' END AS is_declining_both
            FROM steps JOIN status USING (city_name)""",
        "print_sales",
        "ad_revenue",
        "dim_city",
    ),
)
def br5(t: Tables) -> DataFrame:
    return reports.multi_year_decline(star(t), transitions=3)


@entry(
    "br6_readiness_engagement_outlier",
    with_ctes(
        f"""WITH joined AS (
              SELECT city AS city_name, readiness_score_1997, engagement_metric_1997
              FROM (SELECT city_id, round(avg({_SCORE}), 2) AS readiness_score_1997
                    FROM readiness WHERE quarter LIKE '1997%' GROUP BY 1)
              JOIN (SELECT city_id, round(sum(downloads_or_accesses) / sum(users_reached), 2)
                           AS engagement_metric_1997 FROM pilot GROUP BY 1) USING (city_id)
              JOIN dim_city USING (city_id)),
            ranked AS (SELECT *, (dense_rank() OVER (ORDER BY readiness_score_1997 DESC))::BIGINT
                                     AS readiness_rank_desc,
                              (dense_rank() OVER (ORDER BY engagement_metric_1997))::BIGINT
                                     AS engagement_rank_asc FROM joined)
            SELECT *, CASE WHEN readiness_rank_desc <= 1 AND engagement_rank_asc <= 3 THEN 'Yes'
                           ELSE 'No' END AS is_outlier FROM ranked""",
        "readiness",
        "pilot",
        "dim_city",
    ),
)
def br6(t: Tables) -> DataFrame:
    return reports.readiness_engagement_outlier(star(t, 1997), year=1997)


@entry(
    "q1_circulation_trend",
    with_ctes(
        """WITH yearly AS (SELECT year(month)::BIGINT AS year,
                                  sum(copies_printed)::BIGINT AS total_copies_printed,
                                  sum(copies_sold)::BIGINT AS total_copies_sold,
                                  sum(net_circulation)::BIGINT AS total_net_circulation
                           FROM print_sales GROUP BY 1)
           SELECT *, round((total_copies_printed - lag(total_copies_printed) OVER w)
                           / lag(total_copies_printed) OVER w * 100, 2) AS pct_change_printed,
                  round((total_copies_sold - lag(total_copies_sold) OVER w)
                        / lag(total_copies_sold) OVER w * 100, 2) AS pct_change_sold,
                  round((total_net_circulation - lag(total_net_circulation) OVER w)
                        / lag(total_net_circulation) OVER w * 100, 2) AS pct_change_net
           FROM yearly WINDOW w AS (ORDER BY year)""",
        "print_sales",
    ),
)
def q1(t: Tables) -> DataFrame:
    return reports.circulation_trend(star(t))


@entry(
    "q2_top_cities",
    with_ctes(
        f"""WITH {_CITY_YEAR}
            SELECT city AS city_name, printed AS copies_printed_2000, sold AS copies_sold_2000,
                   net AS net_circulation_2000, round(net / printed * 100, 2)
                       AS print_efficiency_pct,
                   round(net / sum(net) OVER () * 100, 2) AS circulation_contribution_pct,
                   CASE WHEN net / printed >= 0.95 THEN 'Highly Profitable'
                        WHEN net / printed >= 0.90 THEN 'Profitable'
                        WHEN net / printed >= 0.80 THEN 'Moderate'
                        ELSE 'Needs Attention' END AS profitability_status
            FROM prints JOIN dim_city USING (city_id) WHERE year = 2000""",
        "print_sales",
        "ad_revenue",
        "dim_city",
    ),
)
def q2(t: Tables) -> DataFrame:
    return reports.top_cities(star(t, 2000), year=2000)


@entry(
    "q3_print_waste",
    with_ctes(
        f"""WITH {_CITY_YEAR}
            SELECT city AS city_name, year, printed AS total_copies_printed,
                   net AS total_net_circulation, printed - net AS print_waste,
                   round((printed - net) / nullif(printed, 0) * 100, 2) AS print_waste_pct
            FROM prints JOIN dim_city USING (city_id)""",
        "print_sales",
        "ad_revenue",
        "dim_city",
    ),
)
def q3(t: Tables) -> DataFrame:
    return reports.print_waste(star(t))


@entry(
    "q4_revenue_by_category",
    with_ctes(
        f"""WITH {_CATEGORY}
            SELECT year, category_name, revenue::DOUBLE AS total_ad_revenue FROM per_category""",
        "ad_revenue",
        "dim_ad_category",
    ),
)
def q4(t: Tables) -> DataFrame:
    return reports.revenue_by_category(star(t))


@entry(
    "q5_revenue_vs_circulation",
    with_ctes(
        f"""WITH {_CITY_YEAR}
            SELECT city AS city_name, year, round(revenue::DOUBLE / 10000000, 2)
                       AS total_ad_revenue_cr, net AS total_net_circulation,
                   round(revenue::DOUBLE / nullif(net, 0), 2) AS revenue_per_copy
            FROM ads JOIN prints USING (city_id, year) JOIN dim_city USING (city_id)""",
        "print_sales",
        "ad_revenue",
        "dim_city",
    ),
)
def q5(t: Tables) -> DataFrame:
    return reports.revenue_vs_circulation(star(t))


@entry(
    "q6_readiness_vs_pilot",
    with_ctes(
        f"""SELECT city_name, round(score, 2) AS readiness_score,
                   round(engagement, 2) AS engagement_rate,
                   CASE WHEN score >= 36 AND engagement < 40 THEN 'High Readiness - Low Engagement'
                        WHEN score >= 36 AND engagement >= 40
                        THEN 'High Readiness - High Engagement'
                        ELSE 'Needs Improvement' END AS city_status
            FROM (SELECT city AS city_name, {_SCORE} AS score,
                         avg(downloads_or_accesses / users_reached * 100) AS engagement
                  FROM readiness JOIN pilot USING (city_id) JOIN dim_city USING (city_id)
                  GROUP BY city, smartphone_penetration, internet_penetration, literacy_rate)""",
        "readiness",
        "pilot",
        "dim_city",
    ),
)
def q6(t: Tables) -> DataFrame:
    return reports.readiness_vs_pilot(star(t), ready_at="36", engaged_at="40")


@entry(
    "q7_revenue_per_copy",
    with_ctes(
        f"""WITH {_CITY_YEAR}
            SELECT city AS city_name, year, revenue::DOUBLE AS total_ad_revenue,
                   net AS total_net_circulation,
                   round(revenue::DOUBLE / nullif(net, 0), 2) AS revenue_per_copy
            FROM ads JOIN prints USING (city_id, year) JOIN dim_city USING (city_id)""",
        "print_sales",
        "ad_revenue",
        "dim_city",
    ),
)
def q7(t: Tables) -> DataFrame:
    return reports.revenue_per_copy(star(t))


PRIORITIES_SQL = with_ctes(
    f"""WITH inputs AS (
          SELECT city AS city_name, readiness_score, engagement_rate, print_decline_pct
          FROM dim_city
          JOIN (SELECT city_id, round(avg({_SCORE}), 2) AS readiness_score
                FROM readiness GROUP BY 1) USING (city_id)
          JOIN (SELECT city_id, round(avg(downloads_or_accesses / users_reached * 100), 2)
                       AS engagement_rate FROM pilot GROUP BY 1) USING (city_id)
          JOIN (SELECT city_id, round((sum(copies_printed) - sum(net_circulation)) * 100
                       / sum(copies_printed), 2) AS print_decline_pct
                FROM print_sales GROUP BY 1) USING (city_id)),
        scored AS (
          SELECT *, round(readiness_score::DECIMAL(9,2) * 0.4
                          + (100 - engagement_rate::DECIMAL(9,2)) * 0.3
                          + print_decline_pct::DECIMAL(9,2) * 0.3, 2)::DOUBLE AS priority_score
          FROM inputs)
        SELECT *, (dense_rank() OVER (ORDER BY priority_score DESC))::BIGINT AS priority_rank
        FROM scored""",
    "readiness",
    "pilot",
    "print_sales",
    "dim_city",
)


@entry("q8_relaunch_priorities", PRIORITIES_SQL)
def q8(t: Tables) -> DataFrame:
    return reports.relaunch_priorities(star(t))


@entry(
    "x1_city_category_concentration",
    with_ctes(
        f"""WITH sums AS (SELECT {_YEAR} AS year, city AS city_name,
                                 standard_ad_category AS category_name,
                                 sum(ad_revenue_in_inr) AS revenue
                          FROM ad_revenue JOIN dim_city USING (city_id)
                               JOIN dim_ad_category USING (ad_category_id) GROUP BY 1, 2, 3),
                 totals AS (SELECT *, sum(revenue) OVER (PARTITION BY year, city_name) AS total
                            FROM sums)
            SELECT year, city_name, category_name, revenue::DOUBLE AS category_revenue,
                   total::DOUBLE AS total_revenue_year,
                   round(revenue::DOUBLE / total::DOUBLE * 100, 2) AS pct_of_year_total
            FROM totals WHERE revenue::DOUBLE / total::DOUBLE > 0.25""",
        "ad_revenue",
        "dim_city",
        "dim_ad_category",
    ),
)
def x1(t: Tables) -> DataFrame:
    return reports.city_category_concentration(star(t), min_share=0.25)


@entry(
    "c1_chart_circulation",
    with_ctes(
        """SELECT year(month)::BIGINT AS year, sum(copies_printed)::BIGINT AS copies_printed,
                  sum(net_circulation)::BIGINT AS net_circulation,
                  sum(copies_printed)::DOUBLE / 100000 AS copies_printed_lakh,
                  sum(net_circulation)::DOUBLE / 100000 AS net_circulation_lakh
           FROM print_sales GROUP BY 1""",
        "print_sales",
    ),
)
def c1(t: Tables) -> DataFrame:
    return reports.chart_circulation(star(t))


@entry(
    "c2_chart_category_share",
    with_ctes(
        f"""WITH {_CATEGORY}
            SELECT category_name, revenue::DOUBLE AS ad_revenue,
                   round(100 * revenue::DOUBLE / (sum(revenue) OVER ())::DOUBLE, 1) AS share_pct
            FROM per_category WHERE year = 2000""",
        "ad_revenue",
        "dim_ad_category",
    ),
)
def c2(t: Tables) -> DataFrame:
    return reports.chart_category_share(star(t, 2000), year=2000)


@entry(
    "c3_chart_roi",
    with_ctes(
        f"""WITH {_CITY_YEAR},
             roi AS (SELECT city AS city_name, year::VARCHAR AS Year,
                            round(revenue::DOUBLE / net, 2) AS Revenue_Per_Copy
                     FROM ads JOIN prints USING (city_id, year) JOIN dim_city USING (city_id)
                     WHERE year IN (1995, 2000))
            SELECT * FROM roi QUALIFY count(*) OVER (PARTITION BY city_name) = 2""",
        "print_sales",
        "ad_revenue",
        "dim_city",
    ),
)
def c3(t: Tables) -> DataFrame:
    return reports.chart_roi(star(t), 1995, 2000)


@entry("c4_chart_priorities", f"SELECT city_name, priority_score FROM ({PRIORITIES_SQL})")
def c4(t: Tables) -> DataFrame:
    t.layers.replace(reports.relaunch_priorities(star(t)), "analytics", "primary_analysis_q8")
    return reports.chart_priorities(t.layers.read("analytics", "primary_analysis_q8"))
