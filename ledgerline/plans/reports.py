"""The recurring reports. Each takes the star schema and returns a DataFrame.

Facts are summed per dimension key before they meet a dimension, so what is
joined, ranked and sorted is one row per city / category and period. Joins
carry no broadcast hints: Spark broadcasts a dimension when its size allows.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.arithmetic import (
    band,
    divide_or_null,
    exact,
    mean,
    mean_of_sums,
    percent,
    ratio,
    rounded,
    row_mean,
    weighted_score,
    yes_no,
)
from ledgerline.functions.money import CRORE, LAKH
from ledgerline.functions.periods import in_quarters_of, in_year, month_text, quarter_year
from ledgerline.operators.crossfact import fan_out_mean, sums_by, sums_by_member
from ledgerline.operators.period import (
    change_from_previous,
    largest_drops,
    steady_decline,
    two_period_means,
    yearly_change,
)
from ledgerline.operators.rank import leaderboard, with_dense_rank, with_dense_ranks
from ledgerline.operators.reshape import relabel, unpivot
from ledgerline.operators.share import above_share, with_group_total
from ledgerline.plans.star import Star

# The labels of bands and states that reports show.
PROFITABILITY_CUTS = {"Highly Profitable": "0.95", "Profitable": "0.90", "Moderate": "0.80"}
PRIORITY_WEIGHTS = {"readiness": "0.4", "disengagement": "0.3", "decline": "0.3"}


def _readiness() -> Column:
    return row_mean(
        F.col("smartphone_penetration"), F.col("internet_penetration"), F.col("literacy_rate")
    )


def _engagement_pct() -> Column:
    return divide_or_null(F.col("downloads_or_accesses"), F.col("users_reached")) * 100


def _by_city(
    star: Star, fact: DataFrame, keys: Mapping[str, Column], sums: Mapping[str, str]
) -> DataFrame:
    per_city = sums_by_member(fact, star.dim_city, "city_id", "city", keys, sums)
    return per_city.withColumnRenamed("city", "city_name")


def _print_year() -> Column:
    return F.year("month")


def _money(name: str) -> Column:
    return F.col(name).cast("double").alias(name)


# --- business requests -------------------------------------------------------


def largest_monthly_drops(
    star: Star,
    k: int = 3,
    row_order: Sequence[str] = ("month", "edition_id", "language", "state"),
) -> DataFrame:
    """BR1: sharpest falls of net circulation from one row of a city to the next.

    ``row_order`` must order the rows of a city completely; with one row per
    city and month the first column alone decides.
    """
    rows = star.print_sales.select("city_id", *row_order, "net_circulation")
    drops = largest_drops(rows, ["city_id"], row_order, "net_circulation", k)
    named = drops.join(star.dim_city.select("city_id", "city"), "city_id")
    return named.select(
        F.col("city").alias("city_name"),
        month_text(F.col("month")).alias("month"),
        F.col("prev_net_circulation").cast("bigint").alias("previous_month_circulation"),
        F.col("net_circulation").cast("bigint").alias("net_circulation"),
        F.col("drop").cast("bigint").alias("circulation_drop"),
    ).orderBy(F.desc("circulation_drop"), "city_name", "month")


def largest_monthly_total_drops(star: Star, k: int = 3) -> DataFrame:
    """BR1 on monthly totals per city instead of detail rows."""
    monthly = sums_by(
        star.print_sales,
        {"city_id": F.col("city_id"), "month": F.col("month")},
        {"net_circulation": "net_circulation"},
    )
    before, now = F.col("prev_net_circulation"), F.col("net_circulation")
    drops = change_from_previous(monthly, ["city_id"], "month", ["net_circulation"])
    drops = (
        drops.where(before.isNotNull() & (now < before))
        .withColumn("drop", before - now)
        .orderBy(F.desc("drop"), "city_id", "month")
        .limit(k)
    )
    return (
        drops.join(star.dim_city.select("city_id", "city"), "city_id")
        .select(
            F.col("city").alias("city_name"),
            month_text(F.col("month")).alias("month"),
            before.alias("previous_month_circulation"),
            now.alias("net_circulation"),
            F.col("drop").alias("circulation_drop"),
        )
        .orderBy(F.desc("circulation_drop"), "city_name", "month")
    )


def category_concentration(star: Star, min_share: float | None = None) -> DataFrame:
    """BR2: share of each ad category in the revenue of its year."""
    per_key = sums_by(
        star.ad_revenue,
        {"year": quarter_year(F.col("quarter")), "ad_category_id": F.col("ad_category_id")},
        {"category_revenue": "ad_revenue_in_inr"},
    )
    # The year's total counts all revenue, also of categories the dimension lacks.
    with_total = with_group_total(per_key, ["year"], "category_revenue", "total_revenue_year")
    shares = (
        with_total.join(
            star.dim_ad_category.select("ad_category_id", "standard_ad_category"), "ad_category_id"
        )
        .groupBy("year", F.col("standard_ad_category").alias("category_name"))
        .agg(
            F.sum("category_revenue").alias("category_revenue"),
            F.max("total_revenue_year").alias("total_revenue_year"),
        )
    )
    if min_share is not None:
        shares = shares.where(above_share("category_revenue", "total_revenue_year", min_share))
    return shares.select(
        "year",
        "category_name",
        _money("category_revenue"),
        _money("total_revenue_year"),
        percent(F.col("category_revenue"), F.col("total_revenue_year")).alias("pct_of_year_total"),
    ).orderBy("year", F.desc("pct_of_year_total"), "category_name")


def print_efficiency_leaderboard(star: Star, year: int = 2024, k: int = 5) -> DataFrame:
    """BR3: cities by net circulation / copies printed in a year, ranked on 4 digits."""
    printed, net, rank = (f"{n}_{year}" for n in ("copies_printed", "net_circulation", "efficiency_rank"))
    totals = _by_city(
        star,
        star.print_sales.where(in_year(F.col("month"), year)),
        {},
        {printed: "copies_printed", net: "net_circulation"},
    )
    scored = totals.withColumn("efficiency_ratio", ratio(F.col(net), F.col(printed), 4))
    return leaderboard(scored, "efficiency_ratio", rank, k, ["city_name"]).orderBy(
        rank, "city_name"
    )


def internet_readiness_growth(
    star: Star, first: str = "2021-Q1", second: str = "2021-Q4"
) -> DataFrame:
    """BR4: mean internet penetration of two quarters and the change between them."""
    name = lambda q: f"internet_rate_q{q[-1]}_{q[:4]}"
    rate = F.col("internet_penetration")
    rows = star.readiness.where(F.col("quarter").isin(first, second)).withColumn(
        "_one", F.when(rate.isNotNull(), 1)
    )
    per_city = _by_city(
        star,
        rows,
        {"quarter": F.col("quarter")},
        {"total": "internet_penetration", "n": "_one"},
    )
    pair = two_period_means(
        per_city, ["city_name"], "quarter", F.col("total"), F.col("n"), first, second
    )
    a, b = F.col("first_mean"), F.col("second_mean")
    return pair.select(
        "city_name",
        rounded(a, 2).alias(name(first)),
        rounded(b, 2).alias(name(second)),
        rounded(b - a, 2).alias("delta_internet_rate"),
    ).orderBy(F.desc_nulls_first("delta_internet_rate"), "city_name")


def multi_year_decline(star: Star, transitions: int = 5) -> DataFrame:
    """BR5: yearly print and ad figures per city, flagged where they fell every year."""
    prints = _by_city(
        star, star.print_sales, {"year": _print_year()}, {"yearly_net_circulation": "net_circulation"}
    )
    ads = _by_city(
        star,
        star.ad_revenue,
        {"year": quarter_year(F.col("quarter"))},
        {"yearly_ad_revenue": "ad_revenue_in_inr"},
    )
    flagged = steady_decline(
        prints.join(ads, ["city_name", "year"]),
        ["city_name"],
        "year",
        {
            "yearly_net_circulation": "is_declining_print",
            "yearly_ad_revenue": "is_declining_ad_revenue",
        },
        "is_declining_both",
        transitions,
    )
    return flagged.withColumn("yearly_ad_revenue", F.col("yearly_ad_revenue").cast("double")).orderBy(
        "city_name", "year"
    )


def readiness_engagement_outlier(
    star: Star, year: int = 2021, top: int = 1, bottom: int = 3
) -> DataFrame:
    """BR6: cities with the best readiness but an engagement among the lowest.

    The pilot has no date filter. Ranks use the rounded figures.
    """
    readiness, engagement = f"readiness_score_{year}", f"engagement_metric_{year}"
    per_city = (
        star.readiness.where(in_quarters_of(F.col("quarter"), year))
        .select("city_id", _readiness().alias("score"))
        .groupBy("city_id")
        .agg(rounded(mean_of_sums(F.sum("score"), F.count("score")), 2).alias(readiness))
    )
    engaged = star.pilot.groupBy("city_id").agg(
        ratio(F.sum("downloads_or_accesses"), F.sum("users_reached"), 2).alias(engagement)
    )
    joined = per_city.join(engaged, "city_id").join(
        star.dim_city.select("city_id", F.col("city").alias("city_name")), "city_id"
    )
    ranked = with_dense_ranks(
        joined.select("city_name", readiness, engagement),
        {"readiness_rank_desc": (readiness, True), "engagement_rank_asc": (engagement, False)},
    )
    outlier = (F.col("readiness_rank_desc") <= top) & (F.col("engagement_rank_asc") <= bottom)
    return ranked.withColumn("is_outlier", yes_no(outlier)).orderBy(
        "readiness_rank_desc", "engagement_rank_asc", "city_name"
    )


# --- primary analysis --------------------------------------------------------


def circulation_trend(star: Star) -> DataFrame:
    """Q1: yearly totals and their change over the year before in percent."""
    totals = sums_by(
        star.print_sales,
        {"year": _print_year()},
        {
            "total_copies_printed": "copies_printed",
            "total_copies_sold": "copies_sold",
            "total_net_circulation": "net_circulation",
        },
    )
    return yearly_change(
        totals,
        "year",
        {
            "total_copies_printed": "pct_change_printed",
            "total_copies_sold": "pct_change_sold",
            "total_net_circulation": "pct_change_net",
        },
    ).orderBy("year")


def top_cities(star: Star, year: int = 2024) -> DataFrame:
    """Q2: a year's figures per city, share of all circulation and profitability band."""
    printed, sold, net = (f"{n}_{year}" for n in ("copies_printed", "copies_sold", "net_circulation"))
    totals = _by_city(
        star,
        star.print_sales.where(in_year(F.col("month"), year)),
        {},
        {printed: "copies_printed", sold: "copies_sold", net: "net_circulation"},
    )
    shared = with_group_total(totals, [], net, "_all")
    efficiency = divide_or_null(F.col(net), F.col(printed))
    return shared.select(
        "city_name",
        printed,
        sold,
        net,
        percent(F.col(net), F.col(printed)).alias("print_efficiency_pct"),
        percent(F.col(net), F.col("_all")).alias("circulation_contribution_pct"),
        band(efficiency, PROFITABILITY_CUTS, "Needs Attention").alias("profitability_status"),
    ).orderBy(F.desc_nulls_first(net), "city_name")


def print_waste(star: Star) -> DataFrame:
    """Q3: copies printed but not circulated per city and year."""
    totals = _by_city(
        star,
        star.print_sales,
        {"year": _print_year()},
        {"total_copies_printed": "copies_printed", "total_net_circulation": "net_circulation"},
    )
    waste = F.col("total_copies_printed") - F.col("total_net_circulation")
    return totals.select(
        "city_name",
        "year",
        "total_copies_printed",
        "total_net_circulation",
        waste.alias("print_waste"),
        percent(waste, F.col("total_copies_printed")).alias("print_waste_pct"),
    ).orderBy("city_name", "year")


def revenue_by_category(star: Star) -> DataFrame:
    """Q4: ad revenue per category and year."""
    totals = sums_by_member(
        star.ad_revenue,
        star.dim_ad_category,
        "ad_category_id",
        "standard_ad_category",
        {"year": quarter_year(F.col("quarter"))},
        {"total_ad_revenue": "ad_revenue_in_inr"},
    )
    return totals.select(
        "year", F.col("standard_ad_category").alias("category_name"), _money("total_ad_revenue")
    ).orderBy("year", F.desc_nulls_first("total_ad_revenue"), "category_name")


def revenue_vs_circulation(star: Star) -> DataFrame:
    """Q5: ad revenue in crore next to circulation, per city name and year."""
    ads = _by_city(
        star,
        star.ad_revenue,
        {"year": quarter_year(F.col("quarter"))},
        {"revenue": "ad_revenue_in_inr"},
    )
    prints = _by_city(
        star, star.print_sales, {"year": _print_year()}, {"total_net_circulation": "net_circulation"}
    )
    revenue, net = F.col("revenue"), F.col("total_net_circulation")
    return (
        ads.join(prints, ["city_name", "year"])
        .orderBy("year", revenue.desc_nulls_first(), "city_name")
        .select(
            "city_name",
            "year",
            rounded(exact(revenue) / F.lit(CRORE), 2).alias("total_ad_revenue_cr"),
            net,
            ratio(revenue, net, 2).alias("revenue_per_copy"),
        )
    )


def readiness_vs_pilot(
    star: Star, ready_at: str = "75", engaged_at: str = "3"
) -> DataFrame:
    """Q6: readiness of each city and quarter next to the city's pilot engagement."""
    rates = ["smartphone_penetration", "internet_penetration", "literacy_rate"]
    combined = fan_out_mean(
        star.readiness,
        star.pilot,
        "city_id",
        ["city_name", *rates],
        _engagement_pct(),
        "engagement",
        labels=star.dim_city.select("city_id", F.col("city").alias("city_name")),
    )
    score, engagement = F.col("score"), F.col("engagement")
    is_ready = score >= F.lit(ready_at).cast("decimal(24,12)")
    is_engaged = engagement >= F.lit(engaged_at).cast("decimal(24,12)")
    status = (
        F.when(is_ready & ~is_engaged, "High Readiness - Low Engagement")
        .when(is_ready & is_engaged, "High Readiness - High Engagement")
        .otherwise("Needs Improvement")
    )
    return (
        combined.withColumn("score", _readiness())
        .select(
            "city_name",
            rounded(score, 2).alias("readiness_score"),
            rounded(engagement, 2).alias("engagement_rate"),
            status.alias("city_status"),
        )
        .orderBy(
            F.desc_nulls_first("readiness_score"), F.asc_nulls_last("engagement_rate"), "city_name"
        )
    )


def _city_year_revenue(star: Star, years: Sequence[int] = ()) -> DataFrame:
    """city_id, year, total_ad_revenue, total_net_circulation - one inner join.

    ``years``: only these, by tests that reach the scans of both facts.
    """
    ad_revenue, print_sales = star.ad_revenue, star.print_sales
    if years:
        ad_revenue = ad_revenue.where(reduce(or_, [in_quarters_of(F.col("quarter"), y) for y in years]))
        print_sales = print_sales.where(reduce(or_, [in_year(F.col("month"), y) for y in years]))
    ads = sums_by(
        ad_revenue,
        {"city_id": F.col("city_id"), "year": quarter_year(F.col("quarter"))},
        {"total_ad_revenue": "ad_revenue_in_inr"},
    )
    prints = sums_by(
        print_sales,
        {"city_id": F.col("city_id"), "year": _print_year()},
        {"total_net_circulation": "net_circulation"},
    )
    return ads.join(prints, ["city_id", "year"])


def revenue_per_copy(star: Star) -> DataFrame:
    """Q7: ad revenue per circulated copy per city and year."""
    joined = _city_year_revenue(star).join(star.dim_city.select("city_id", "city"), "city_id")
    return joined.select(
        F.col("city").alias("city_name"),
        "year",
        _money("total_ad_revenue"),
        "total_net_circulation",
        ratio(F.col("total_ad_revenue"), F.col("total_net_circulation"), 2).alias(
            "revenue_per_copy"
        ),
    ).orderBy("city_name", "year")


def relaunch_priorities(star: Star, weights: Mapping[str, str] = PRIORITY_WEIGHTS) -> DataFrame:
    """Q8: weighted score of readiness, missing engagement and print waste.

    The score is built from the rounded inputs that are shown next to it.
    """
    readiness = (
        star.readiness.select("city_id", _readiness().alias("score"))
        .groupBy("city_id")
        .agg(F.round(mean_of_sums(F.sum("score"), F.count("score")), 2).alias("readiness_score"))
    )
    engagement = (
        star.pilot.select("city_id", _engagement_pct().alias("rate"))
        .groupBy("city_id")
        .agg(F.round(mean(F.col("rate")), 2).alias("engagement_rate"))
    )
    printed, net = exact(F.sum("copies_printed")), exact(F.sum("net_circulation"))
    decline = star.print_sales.groupBy("city_id").agg(
        F.round(divide_or_null((printed - net) * 100, printed), 2).alias("print_decline_pct")
    )
    score = weighted_score(
        [
            (F.col("readiness_score"), weights["readiness"]),
            (F.lit(100) - F.col("engagement_rate"), weights["disengagement"]),
            (F.col("print_decline_pct"), weights["decline"]),
        ]
    )
    scored = (
        star.dim_city.select("city_id", F.col("city").alias("city_name"))
        .join(readiness, "city_id")
        .join(engagement, "city_id")
        .join(decline, "city_id")
        .withColumn("priority_score", F.round(score, 2))
    )
    shown = scored.select(
        "city_name",
        *[
            _money(c)
            for c in ("readiness_score", "engagement_rate", "print_decline_pct", "priority_score")
        ],
    )
    return with_dense_rank(shown, "priority_rank", "priority_score").orderBy(F.desc_nulls_first("priority_score"), "city_name")


# --- further tables ----------------------------------------------------------


def city_category_concentration(star: Star, min_share: float = 0.5) -> DataFrame:
    """X1: categories with more than ``min_share`` of a city's revenue in a year."""
    per_key = sums_by(
        star.ad_revenue,
        {
            "year": quarter_year(F.col("quarter")),
            "city_id": F.col("city_id"),
            "ad_category_id": F.col("ad_category_id"),
        },
        {"category_revenue": "ad_revenue_in_inr"},
    )
    per_city = (
        per_key.join(star.dim_city.select("city_id", F.col("city").alias("city_name")), "city_id")
        .groupBy("year", "city_name", "ad_category_id")
        .agg(F.sum("category_revenue").alias("category_revenue"))
    )
    with_total = with_group_total(
        per_city, ["year", "city_name"], "category_revenue", "total_revenue_year"
    )
    named = (
        with_total.join(
            star.dim_ad_category.select("ad_category_id", "standard_ad_category"), "ad_category_id"
        )
        .groupBy("year", "city_name", F.col("standard_ad_category").alias("category_name"))
        .agg(
            F.sum("category_revenue").alias("category_revenue"),
            F.max("total_revenue_year").alias("total_revenue_year"),
        )
    )
    return (
        named.where(above_share("category_revenue", "total_revenue_year", min_share))
        .select(
            "year",
            "city_name",
            "category_name",
            _money("category_revenue"),
            _money("total_revenue_year"),
            percent(F.col("category_revenue"), F.col("total_revenue_year")).alias(
                "pct_of_year_total"
            ),
        )
        .orderBy("year", F.desc("pct_of_year_total"), "city_name", "category_name")
    )


def chart_circulation(star: Star) -> DataFrame:
    """C1: yearly copies printed and net circulation, also in lakh."""
    totals = sums_by(
        star.print_sales,
        {"year": _print_year()},
        {"copies_printed": "copies_printed", "net_circulation": "net_circulation"},
    )
    lakh = lambda c: (F.col(c).cast("double") / LAKH).alias(f"{c}_lakh")
    return totals.select("*", lakh("copies_printed"), lakh("net_circulation")).orderBy("year")


def chart_category_share(star: Star, year: int = 2024) -> DataFrame:
    """C2: ad revenue per category in one year and its share, to one digit."""
    totals = sums_by_member(
        star.ad_revenue.where(in_quarters_of(F.col("quarter"), year)),
        star.dim_ad_category,
        "ad_category_id",
        "standard_ad_category",
        {},
        {"ad_revenue": "ad_revenue_in_inr"},
    )
    shared = with_group_total(totals, [], "ad_revenue", "_all")
    return shared.select(
        F.col("standard_ad_category").alias("category_name"),
        _money("ad_revenue"),
        percent(F.col("ad_revenue"), F.col("_all"), 1).alias("share_pct"),
    ).orderBy(F.desc_nulls_first("ad_revenue"), "category_name")


def roi_two_years(star: Star, first: int = 2019, second: int = 2024) -> DataFrame:
    """Revenue per copy of two years side by side, for cities that have both."""
    at = lambda year, c: F.sum(F.when(F.col("year") == year, F.col(c)))
    roi = lambda year: ratio(
        at(year, "total_ad_revenue"), at(year, "total_net_circulation"), 2
    )
    years = _city_year_revenue(star, (first, second)).where(F.col("year").isin(first, second))
    per_city = (
        years.groupBy("city_id")
        .agg(
            roi(first).alias(f"roi_{first}"),
            roi(second).alias(f"roi_{second}"),
            F.count(F.lit(1)).alias("_years"),
        )
        .where("_years = 2")
    )
    return per_city.join(star.dim_city.select("city_id", "city"), "city_id").select(
        F.col("city").alias("city_name"), f"roi_{first}", f"roi_{second}"
    )


def chart_roi(star: Star, first: int = 2019, second: int = 2024) -> DataFrame:
    """C3: the two years under one another, labelled by year."""
    wide = roi_two_years(star, first, second).withColumn("_latest", F.col(f"roi_{second}"))
    columns = {f"roi_{y}": str(y) for y in (first, second)}
    long = unpivot(wide, ["city_name", "_latest"], list(columns), "Year", "Revenue_Per_Copy")
    return (
        long.withColumn("Year", relabel(F.col("Year"), columns))
        .orderBy(F.desc_nulls_first("_latest"), "city_name", "Year")
        .drop("_latest")
    )


def chart_priorities(priorities: DataFrame) -> DataFrame:
    """C4: the priority list, read back from the stored report."""
    return priorities.select("city_name", "priority_score").orderBy(
        F.desc_nulls_first("priority_score"), "city_name"
    )


REPORTS: dict[str, Callable[[Star], DataFrame]] = {
    "business_request_1": largest_monthly_drops,
    "business_request_2": category_concentration,
    "business_request_3": print_efficiency_leaderboard,
    "business_request_4": internet_readiness_growth,
    "business_request_5": multi_year_decline,
    "business_request_6": readiness_engagement_outlier,
    "primary_analysis_q1": circulation_trend,
    "primary_analysis_q2": top_cities,
    "primary_analysis_q3": print_waste,
    "primary_analysis_q4": revenue_by_category,
    "primary_analysis_q5": revenue_vs_circulation,
    "primary_analysis_q6": readiness_vs_pilot,
    "primary_analysis_q7": revenue_per_copy,
    "primary_analysis_q8": relaunch_priorities,
}
