"""Predicates, joins, aggregates, windows, top-k and reshaping on the test tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.catalog import analogue as a
from ledgerline.catalog.analogue import with_ctes
from ledgerline.catalog.base import Tables, entry
from ledgerline.functions import arithmetic as ar
from ledgerline.functions import periods
from ledgerline.functions.text import has_text
from ledgerline.operators import crossfact, period, profile, rank, reshape, share
from ledgerline.operators import quality as q
from ledgerline.operators.ordered import lag_in_order

_PRICE = "o_totalprice::DECIMAL(18,2)"


def _price():
    return F.col("o_totalprice").cast("decimal(18,2)")


def _by_nation(t: Tables, *keys, years: Sequence[int] = ()) -> DataFrame:
    """Order value per customer nation: nation_id, keys, amount."""
    orders = t.orders.where(_in_years("o_orderdate", *years)) if years else t.orders
    joined = orders.join(
        t.customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey")
    )
    return joined.groupBy("c_nationkey", *keys).agg(F.sum(_price()).alias("amount"))


_BY_NATION_YEAR = f"""
    SELECT c_nationkey::BIGINT AS c_nationkey, year(o_orderdate)::BIGINT AS year,
           sum({_PRICE}) AS amount
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2"""


def _in_years(column: str, *years: int) -> Column:
    return reduce(or_, [periods.in_year(F.col(column), y) for y in years])


def _by_nation_year(t: Tables, *years: int) -> DataFrame:
    return _by_nation(t, F.year("o_orderdate").alias("year"), years=years)


# --- filters -------------------------------------------------------------------


@entry(
    "r2_year_filter",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders
       WHERE year(o_orderdate) = 2000""",
)
def year_filter(t: Tables) -> DataFrame:
    rows = t.orders.where(periods.in_year(F.col("o_orderdate"), 2000))
    return rows.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))


@entry(
    "r3_in_list",
    "SELECT event_id, event_type FROM events WHERE event_type IN ('click', 'purchase')",
)
def in_list(t: Tables) -> DataFrame:
    return t.events.where(F.col("event_type").isin("click", "purchase")).select(
        "event_id", "event_type"
    )


@entry("r4_prefix", "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority LIKE '1%'")
def prefix(t: Tables) -> DataFrame:
    return t.orders.where(F.col("o_orderpriority").startswith("1")).select(
        "o_orderkey", "o_orderpriority"
    )


@entry(
    "r5_not_null_and_less",
    with_ctes(
        """SELECT o_orderkey, currency, comments FROM raw_ad_revenue
           WHERE comments IS NOT NULL AND comments < currency""",
        "raw_ad_revenue",
    ),
)
def not_null_and_less(t: Tables) -> DataFrame:
    c = F.col("comments")
    rows = a.raw_ad_revenue(t).where(c.isNotNull() & (c < F.col("currency")))
    return rows.select("o_orderkey", "currency", "comments")


@entry(
    "r6_ratio_threshold",
    """SELECT l_orderkey, sum(l_quantity)::BIGINT AS quantity,
              sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END)::BIGINT AS returned
       FROM lineitem GROUP BY 1 HAVING returned / quantity > 0.5""",
)
def ratio_threshold(t: Tables) -> DataFrame:
    copies = F.col("l_quantity").cast("int")
    sums = t.lineitem.groupBy("l_orderkey").agg(
        F.sum(copies).alias("quantity"),
        F.sum(F.when(F.col("l_returnflag") == "R", copies).otherwise(0)).alias("returned"),
    )
    return sums.where(share.above_share("returned", "quantity", 0.5))


@entry(
    "r7_has_text",
    with_ctes(
        """SELECT o_orderkey, comments FROM raw_ad_revenue
           WHERE comments IS NOT NULL AND trim(comments) <> ''""",
        "raw_ad_revenue",
    ),
)
def with_text(t: Tables) -> DataFrame:
    return a.raw_ad_revenue(t).where(has_text(F.col("comments"))).select("o_orderkey", "comments")


@entry(
    "r8_head_sample",
    with_ctes(
        """SELECT o_orderkey, ad_category, quarter, ad_revenue, currency, comments
           FROM raw_ad_revenue WHERE trim(comments) <> '' ORDER BY o_orderkey LIMIT 20""",
        "raw_ad_revenue",
    ),
)
def head_sample(t: Tables) -> DataFrame:
    show = ["o_orderkey", "ad_category", "quarter", "ad_revenue", "currency", "comments"]
    return profile.sample_with_text(a.raw_ad_revenue(t), "comments", show, ["o_orderkey"])


@entry(
    "r9_named_intermediate",
    f"""WITH yearly AS ({_BY_NATION_YEAR}), best AS
             (SELECT c_nationkey, max(amount) AS amount FROM yearly GROUP BY 1)
        SELECT c_nationkey, year, amount::DOUBLE AS amount
        FROM yearly JOIN best USING (c_nationkey, amount)""",
)
def named_intermediate(t: Tables) -> DataFrame:
    yearly = _by_nation_year(t)
    best = F.max("amount").over(Window.partitionBy("c_nationkey"))
    return yearly.withColumn("best", best).where("amount = best").drop("best")


@entry(
    "r10_constant_and_rename",
    "SELECT 'INR' AS currency, c_mktsegment AS segment, c_custkey AS id FROM customer",
)
def constant_and_rename(t: Tables) -> DataFrame:
    renamed = t.customer.withColumnsRenamed({"c_mktsegment": "segment", "c_custkey": "id"})
    return renamed.withColumn("currency", F.lit("INR")).select("currency", "segment", "id")


# --- joins -----------------------------------------------------------------------


@entry(
    "j1_fact_city",
    with_ctes(
        """SELECT edition_id, city, state, tier, strftime(month, '%Y-%m-%d') AS month,
                  net_circulation FROM print_sales JOIN dim_city USING (city_id)""",
        "print_sales",
        "dim_city",
    ),
)
def fact_city(t: Tables) -> DataFrame:
    return a.print_sales(t).join(a.dim_city(t), "city_id").select(
        "edition_id", "city", "state", "tier", "month", "net_circulation"
    )


@entry(
    "j2_fact_category",
    with_ctes(
        """SELECT edition_id, quarter, standard_ad_category, category_group,
                  ad_revenue_in_inr::DOUBLE AS ad_revenue_in_inr
           FROM ad_revenue JOIN dim_ad_category USING (ad_category_id)""",
        "ad_revenue",
        "dim_ad_category",
    ),
)
def fact_category(t: Tables) -> DataFrame:
    return a.ad_revenue(t).join(a.dim_ad_category(t), "ad_category_id").select(
        "edition_id", "quarter", "standard_ad_category", "category_group", "ad_revenue_in_inr"
    )


@entry(
    "j3_aggregate_join",
    f"""SELECT c_nationkey, year, amount::DOUBLE AS amount, copies
        FROM ({_BY_NATION_YEAR}) JOIN
             (SELECT s_nationkey::BIGINT AS c_nationkey, year(l_shipdate)::BIGINT AS year,
                     sum(l_quantity)::BIGINT AS copies
              FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2)
             USING (c_nationkey, year)""",
)
def aggregate_join(t: Tables, *years: int) -> DataFrame:
    """``years``: only these, by a test that reaches both scans."""
    lines = t.lineitem.where(_in_years("l_shipdate", *years)) if years else t.lineitem
    shipped = (
        lines.select(
            "l_suppkey", F.year("l_shipdate").alias("year"), F.col("l_quantity").cast("int").alias("n")
        )
        .groupBy("l_suppkey", "year")
        .agg(F.sum("n").alias("n"))
        .join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy(F.col("s_nationkey").alias("c_nationkey"), "year")
        .agg(F.sum("n").alias("copies"))
    )
    return _by_nation_year(t, *years).join(shipped, ["c_nationkey", "year"])


@entry(
    "j4_share_of_total",
    f"""SELECT c_nationkey, year, amount::DOUBLE AS amount,
               (sum(amount) OVER (PARTITION BY year))::DOUBLE AS total,
               round(100 * amount::DOUBLE / (sum(amount) OVER (PARTITION BY year))::DOUBLE, 2)
                   AS pct
        FROM ({_BY_NATION_YEAR})""",
)
def share_of_total(t: Tables) -> DataFrame:
    return share.share_of_group(
        _by_nation_year(t), ["year"], ["c_nationkey"], "amount", "total", "pct"
    )


@entry(
    "j5_two_period_pivot",
    f"""SELECT x.c_nationkey, round((x.amount / x.n)::DOUBLE, 2) AS mean_1995,
               round((y.amount / y.n)::DOUBLE, 2) AS mean_2000
        FROM (SELECT c_nationkey::BIGINT AS c_nationkey, year(o_orderdate) AS year,
                     sum({_PRICE}) AS amount, count(*) AS n
              FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2) x
        JOIN (SELECT c_nationkey::BIGINT AS c_nationkey, year(o_orderdate) AS year,
                     sum({_PRICE}) AS amount, count(*) AS n
              FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2) y
             ON x.c_nationkey = y.c_nationkey AND x.year = 1995 AND y.year = 2000""",
)
def two_period_pivot(t: Tables) -> DataFrame:
    orders = t.orders.where(_in_years("o_orderdate", 1995, 2000))
    rows = orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "c_nationkey", F.year("o_orderdate").alias("year"), _price().alias("amount")
    )
    pair = period.two_period_means(
        rows, ["c_nationkey"], "year", F.col("amount"), F.lit(1), 1995, 2000
    )
    return pair.select(
        "c_nationkey",
        ar.rounded(F.col("first_mean"), 2).alias("mean_1995"),
        ar.rounded(F.col("second_mean"), 2).alias("mean_2000"),
    )


@entry(
    "j6_four_way_periods",
    """WITH o AS (SELECT c_nationkey AS k, year(o_orderdate) AS y, sum(o_totalprice::DECIMAL(18,2)) AS v
                  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2),
            l AS (SELECT s_nationkey AS k, year(l_shipdate) AS y, sum(l_quantity::BIGINT) AS v
                  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2)
       SELECT n_name, round(o1.v::DOUBLE / l1.v, 2) AS ratio_1995,
              round(o2.v::DOUBLE / l2.v, 2) AS ratio_2000
       FROM nation JOIN o o1 ON o1.k = n_nationkey AND o1.y = 1995
                   JOIN l l1 ON l1.k = n_nationkey AND l1.y = 1995
                   JOIN o o2 ON o2.k = n_nationkey AND o2.y = 2000
                   JOIN l l2 ON l2.k = n_nationkey AND l2.y = 2000""",
)
def four_way_periods(t: Tables) -> DataFrame:
    at = lambda y, c: F.sum(F.when(F.col("year") == y, F.col(c)))
    both = aggregate_join(t, 1995, 2000).where(F.col("year").isin(1995, 2000))
    wide = (
        both.groupBy("c_nationkey")
        .agg(
            ar.ratio(at(1995, "amount"), at(1995, "copies"), 2).alias("ratio_1995"),
            ar.ratio(at(2000, "amount"), at(2000, "copies"), 2).alias("ratio_2000"),
            F.count(F.lit(1)).alias("years"),
        )
        .where("years = 2")
    )
    return wide.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "n_name", "ratio_1995", "ratio_2000"
    )


_RATES = ["smartphone_penetration", "internet_penetration", "literacy_rate"]


@entry(
    "j7_fan_out",
    with_ctes(
        f"""SELECT city_id, quarter, {', '.join(_RATES)},
                   round(avg(100 * downloads_or_accesses / users_reached), 2) AS engagement
            FROM readiness JOIN pilot USING (city_id) GROUP BY ALL""",
        "readiness",
        "pilot",
    ),
)
def fan_out(t: Tables) -> DataFrame:
    rate = ar.divide_or_null(F.col("downloads_or_accesses"), F.col("users_reached")) * 100
    keyed = a.readiness(t).withColumn("city", F.col("city_id"))
    mean = crossfact.fan_out_mean(
        keyed, a.pilot(t), "city_id", ["city", "quarter", *_RATES], rate, "engagement"
    )
    return mean.withColumnRenamed("city", "city_id").withColumn(
        "engagement", ar.rounded(F.col("engagement"), 2)
    )


@entry(
    "j7_fan_out_rows",
    with_ctes(
        """SELECT city_id, quarter, literacy_rate, platform, launch_month, users_reached, downloads_or_accesses
           FROM readiness JOIN pilot USING (city_id)""",
        "readiness",
        "pilot",
    ),
)
def fan_out_rows(t: Tables) -> DataFrame:
    """The rows themselves, cut into cells of a thousand pairs."""
    readiness = a.readiness(t).select("city_id", "quarter", "literacy_rate")
    pilot = a.pilot(t).select("city_id", "platform", "launch_month", "users_reached", "downloads_or_accesses")
    return crossfact.fan_out_rows(readiness, pilot, "city_id", pairs=1024)


@entry(
    "j8_star_of_aggregates",
    """SELECT n_name, customers, balance, suppliers, orders
       FROM nation
       JOIN (SELECT c_nationkey, count(*)::BIGINT AS customers,
                    sum(c_acctbal::DECIMAL(18,2))::DOUBLE AS balance FROM customer GROUP BY 1)
            ON c_nationkey = n_nationkey
       JOIN (SELECT s_nationkey, count(*)::BIGINT AS suppliers FROM supplier GROUP BY 1)
            ON s_nationkey = n_nationkey
       JOIN (SELECT c_nationkey AS k, count(*)::BIGINT AS orders
             FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1) ON k = n_nationkey""",
)
def star_of_aggregates(t: Tables) -> DataFrame:
    customers = t.customer.groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(
        F.count(F.lit(1)).alias("customers"),
        F.sum(F.col("c_acctbal").cast("decimal(18,2)")).alias("balance"),
    )
    suppliers = t.supplier.groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(
        F.count(F.lit(1)).alias("suppliers")
    )
    orders = (
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy(F.col("c_nationkey").alias("n_nationkey"))
        .agg(F.count(F.lit(1)).alias("orders"))
    )
    joined = t.nation.join(customers, "n_nationkey").join(suppliers, "n_nationkey")
    return joined.join(orders, "n_nationkey").select(
        "n_name", "customers", "balance", "suppliers", "orders"
    )


@entry(
    "j9_rows_with_entity_status",
    f"""WITH yearly AS ({_BY_NATION_YEAR})
        SELECT y.c_nationkey, y.year, y.amount::DOUBLE AS amount, s.status
        FROM yearly y JOIN (SELECT c_nationkey, CASE WHEN sum(amount) > 100000000 THEN 'large'
                                   ELSE 'small' END AS status FROM yearly GROUP BY 1) s
             ON y.c_nationkey = s.c_nationkey""",
)
def rows_with_entity_status(t: Tables) -> DataFrame:
    total = F.sum("amount").over(Window.partitionBy("c_nationkey"))
    status = F.when(total > 100000000, "large").otherwise("small")
    return _by_nation_year(t).withColumn("status", status)


@entry(
    "j10_orphans",
    """SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey FROM lineitem
       WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 10)""",
)
def orphans(t: Tables) -> DataFrame:
    sold = t.part.where("p_size > 10")
    rule = q.references(["l_partkey"], sold, ["p_partkey"])
    return q.orphans(t.lineitem, rule).select("l_orderkey", "l_linenumber", "l_partkey")


# --- aggregates --------------------------------------------------------------------


@entry(
    "a1_sum_by_keys",
    """SELECT l_returnflag, l_linestatus, year(l_shipdate)::BIGINT AS year,
              sum(l_quantity)::BIGINT AS quantity,
              sum(l_extendedprice::DECIMAL(18,2))::DOUBLE AS price
       FROM lineitem GROUP BY 1, 2, 3""",
)
def sum_by_keys(t: Tables) -> DataFrame:
    return t.lineitem.groupBy(
        "l_returnflag", "l_linestatus", F.year("l_shipdate").alias("year")
    ).agg(
        F.sum(F.col("l_quantity").cast("int")).alias("quantity"),
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("price"),
    )


@entry(
    "a2_sum_dropping_null_keys",
    with_ctes(
        """SELECT currency, count(*)::BIGINT AS n FROM raw_ad_revenue
           WHERE currency IS NOT NULL GROUP BY 1""",
        "raw_ad_revenue",
    ),
)
def sum_dropping_null_keys(t: Tables) -> DataFrame:
    rows = a.raw_ad_revenue(t).withColumn("one", F.lit(1))
    return profile.sums_by_key(rows, ["currency"], "one", "n")


@entry(
    "a3_avg",
    f"""SELECT o_orderpriority, round(avg({_PRICE}), 2) AS mean_price FROM orders GROUP BY 1""",
)
def avg(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_orderpriority").agg(ar.rounded(F.avg(_price()), 2).alias("mean_price"))


@entry(
    "a4_ratio_of_sums",
    """SELECT l_suppkey, round(sum(l_discount::DECIMAL(9,2)) / nullif(sum(l_tax::DECIMAL(9,2)), 0), 4)
              AS ratio FROM lineitem GROUP BY 1""",
)
def ratio_of_sums(t: Tables) -> DataFrame:
    of = lambda c: F.sum(F.col(c).cast("decimal(9,2)"))
    return t.lineitem.groupBy("l_suppkey").agg(
        ar.ratio(of("l_discount"), of("l_tax"), 4).alias("ratio")
    )


@entry(
    "a5_mean_of_ratios",
    """SELECT l_suppkey, round(avg(l_discount / nullif(l_tax, 0) * 100), 2) AS mean_pct
       FROM lineitem GROUP BY 1""",
)
def mean_of_ratios(t: Tables) -> DataFrame:
    pct = ar.divide_or_null(F.col("l_discount"), F.col("l_tax")) * 100
    return t.lineitem.groupBy("l_suppkey").agg(ar.rounded(ar.mean(pct), 2).alias("mean_pct"))


@entry(
    "a6_flag_count",
    f"""WITH steps AS (SELECT *, CASE WHEN amount < lag(amount) OVER
                                  (PARTITION BY c_nationkey ORDER BY year) THEN 1 ELSE 0 END AS fell
                       FROM ({_BY_NATION_YEAR}))
        SELECT c_nationkey, sum(fell)::BIGINT AS falls,
               CASE WHEN sum(fell) = 3 THEN 'Yes' ELSE 'No' END AS fell_three_times
        FROM steps GROUP BY 1""",
)
def flag_count(t: Tables) -> DataFrame:
    steps = period.change_from_previous(_by_nation_year(t), ["c_nationkey"], "year", ["amount"])
    fell = F.when(F.col("amount") < F.col("prev_amount"), 1).otherwise(0)
    return (
        steps.groupBy("c_nationkey")
        .agg(F.sum(fell).alias("falls"))
        .withColumn("fell_three_times", ar.yes_no(F.col("falls") == 3))
    )


@entry(
    "a8_grand_total",
    """SELECT count(*)::BIGINT AS lines, sum(l_quantity)::BIGINT AS quantity,
              sum(l_extendedprice::DECIMAL(18,2))::DOUBLE AS price FROM lineitem""",
)
def grand_total(t: Tables) -> DataFrame:
    return t.lineitem.agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum(F.col("l_quantity").cast("int")).alias("quantity"),
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("price"),
    )


@entry(
    "a9_distinct_values",
    with_ctes("SELECT DISTINCT comments FROM raw_ad_revenue", "raw_ad_revenue"),
)
def distinct_values(t: Tables) -> DataFrame:
    return profile.distinct_values(a.raw_ad_revenue(t), "comments")


@entry(
    "a10_null_and_row_counts",
    with_ctes(
        """SELECT count(*)::BIGINT AS total_rows,
                  (count(*) - count(ad_revenue))::BIGINT AS null_ad_revenue,
                  (count(*) - count(currency))::BIGINT AS null_currency,
                  (count(*) - count(comments))::BIGINT AS null_comments
           FROM raw_ad_revenue""",
        "raw_ad_revenue",
    ),
)
def null_and_row_counts(t: Tables) -> DataFrame:
    return profile.null_counts(a.raw_ad_revenue(t), ["ad_revenue", "currency", "comments"])


# --- windows -----------------------------------------------------------------------


@entry(
    "w1_lag_detail_rows",
    """SELECT event_id, user_id, event_type,
              lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev_event_type
       FROM events""",
)
def lag_detail_rows(t: Tables) -> DataFrame:
    """A user may have any number of events, so the order is cut into days."""
    rows = t.events.select("user_id", "ts", "event_id", "event_type")
    day = F.col("ts").cast("date")
    return lag_in_order(rows, ["user_id"], ["ts", "event_id"], ["event_type"], cut=day).drop("ts")


@entry(
    "w2_lag_per_entity_year",
    f"""SELECT c_nationkey, year, amount::DOUBLE AS amount,
               (lag(amount) OVER (PARTITION BY c_nationkey ORDER BY year))::DOUBLE AS prev_amount,
               CASE WHEN amount < lag(amount) OVER (PARTITION BY c_nationkey ORDER BY year)
                    THEN 1 ELSE 0 END::BIGINT AS fell
        FROM ({_BY_NATION_YEAR})""",
)
def lag_per_entity_year(t: Tables) -> DataFrame:
    steps = period.change_from_previous(_by_nation_year(t), ["c_nationkey"], "year", ["amount"])
    fell = F.when(F.col("amount") < F.col("prev_amount"), 1).otherwise(0)
    return steps.withColumn("fell", fell)


@entry(
    "w3_lag_global_years",
    f"""SELECT year, orders, amount::DOUBLE AS amount,
               round(100.0 * (orders - lag(orders) OVER (ORDER BY year))
                     / lag(orders) OVER (ORDER BY year), 2) AS pct_orders,
               round(100 * ((amount - lag(amount) OVER (ORDER BY year))::DOUBLE
                     / (lag(amount) OVER (ORDER BY year))::DOUBLE), 2) AS pct_amount
        FROM (SELECT year(o_orderdate)::BIGINT AS year, count(*)::BIGINT AS orders,
                     sum({_PRICE}) AS amount FROM orders GROUP BY 1)""",
)
def lag_global_years(t: Tables) -> DataFrame:
    totals = t.orders.groupBy(F.year("o_orderdate").alias("year")).agg(
        F.count(F.lit(1)).alias("orders"), F.sum(_price()).alias("amount")
    )
    return period.yearly_change(totals, "year", {"orders": "pct_orders", "amount": "pct_amount"})


_SCORES = """
    SELECT c_nationkey::BIGINT AS c_nationkey, round(avg(c_acctbal::DECIMAL(18,2)), 0) AS score
    FROM customer GROUP BY 1"""


def _scores(t: Tables) -> DataFrame:
    score = ar.rounded(F.avg(F.col("c_acctbal").cast("decimal(18,2)")), 0)
    return t.customer.groupBy("c_nationkey").agg(score.alias("score"))


@entry(
    "w4_dense_rank_desc",
    f"""SELECT *, (dense_rank() OVER (ORDER BY score DESC))::BIGINT AS place FROM ({_SCORES})""",
)
def dense_rank_desc(t: Tables) -> DataFrame:
    return rank.with_dense_rank(_scores(t), "place", "score")


@entry(
    "w5_dense_rank_asc",
    f"""SELECT *, (dense_rank() OVER (ORDER BY score ASC))::BIGINT AS place FROM ({_SCORES})""",
)
def dense_rank_asc(t: Tables) -> DataFrame:
    return rank.with_dense_rank(_scores(t), "place", "score", descending=False)


@entry(
    "w6_share_of_grand_total",
    f"""SELECT o_orderpriority, amount::DOUBLE AS amount,
               round(100 * amount::DOUBLE / (sum(amount) OVER ())::DOUBLE, 2) AS pct
        FROM (SELECT o_orderpriority, sum({_PRICE}) AS amount FROM orders GROUP BY 1)""",
)
def share_of_grand_total(t: Tables) -> DataFrame:
    sums = t.orders.groupBy("o_orderpriority").agg(F.sum(_price()).alias("amount"))
    shared = share.with_group_total(sums, [], "amount", "total")
    return shared.select(
        "o_orderpriority", "amount", ar.percent(F.col("amount"), F.col("total")).alias("pct")
    )


@entry(
    "w7_rank_predicates",
    f"""SELECT *, CASE WHEN best <= 5 AND fewest <= 10 THEN 'Yes' ELSE 'No' END AS picked
        FROM (SELECT c_nationkey, score, n, (dense_rank() OVER (ORDER BY score DESC))::BIGINT AS best,
                     (dense_rank() OVER (ORDER BY n))::BIGINT AS fewest
              FROM ({_SCORES}) JOIN (SELECT c_nationkey::BIGINT AS c_nationkey,
                                            count(*)::BIGINT AS n FROM customer GROUP BY 1)
                   USING (c_nationkey))""",
)
def rank_predicates(t: Tables) -> DataFrame:
    score = ar.rounded(F.avg(F.col("c_acctbal").cast("decimal(18,2)")), 0)
    rows = t.customer.groupBy("c_nationkey").agg(
        score.alias("score"), F.count(F.lit(1)).alias("n")
    )
    ranked = rank.with_dense_ranks(rows, {"best": ("score", True), "fewest": ("n", False)})
    return ranked.withColumn(
        "picked", ar.yes_no((F.col("best") <= 5) & (F.col("fewest") <= 10))
    )


# --- sort, top-k, reshape --------------------------------------------------------------


@entry("t1_sort", f"SELECT c_nationkey, year, amount::DOUBLE AS amount FROM ({_BY_NATION_YEAR})")
def sort(t: Tables) -> DataFrame:
    return _by_nation_year(t).orderBy("year", F.desc("amount"), "c_nationkey")


@entry(
    "t2_top_k",
    f"""SELECT o_orderkey, {_PRICE}::DOUBLE AS price FROM orders
        ORDER BY o_totalprice DESC, o_orderkey LIMIT 25""",
)
def top_k(t: Tables) -> DataFrame:
    best = rank.top_rows(t.orders, [F.desc("o_totalprice"), F.asc("o_orderkey")], 25)
    return best.select("o_orderkey", _price().alias("price"))


_RETURNS = {"R": "returned", "A": "accepted", "N": "open"}
_PIVOTED = """
    SELECT l_suppkey,
           sum(CASE WHEN l_returnflag = 'R' THEN l_quantity::BIGINT END)::BIGINT AS returned,
           sum(CASE WHEN l_returnflag = 'A' THEN l_quantity::BIGINT END)::BIGINT AS accepted,
           sum(CASE WHEN l_returnflag = 'N' THEN l_quantity::BIGINT END)::BIGINT AS open
    FROM lineitem GROUP BY 1"""


def _pivoted(t: Tables) -> DataFrame:
    rows = t.lineitem.withColumn("copies", F.col("l_quantity").cast("int"))
    return reshape.pivot_sum(rows, ["l_suppkey"], "l_returnflag", "copies", _RETURNS)


@entry(
    "t3_unpivot",
    " UNION ALL ".join(
        f"SELECT l_suppkey, '{n}' AS state, {n} AS copies FROM ({_PIVOTED})"
        for n in _RETURNS.values()
    ),
)
def unpivot(t: Tables) -> DataFrame:
    return reshape.unpivot(_pivoted(t), ["l_suppkey"], list(_RETURNS.values()), "state", "copies")


@entry("t4_pivot", _PIVOTED)
def pivot(t: Tables) -> DataFrame:
    return _pivoted(t)
