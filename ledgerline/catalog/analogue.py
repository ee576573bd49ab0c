"""The star schema and its raw tables, derived from the test tables.

    city      nation (state: region)          category  customer market segment
    edition   supplier / city                 print     lineitem per supplier and month
    revenue   orders by customer city         readiness shares of orders per city, quarter
    pilot     events by user city

Raw tables are the same facts written the messy way. Every definition exists
twice: as DataFrame code and, for the check, as an SQL common table expression
in ``CTES``.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.catalog.base import Tables
from ledgerline.functions.arithmetic import divide_or_null
from ledgerline.functions.money import to_base_currency
from ledgerline.functions.periods import in_year, month_text, quarter_text
from ledgerline.functions.text import title_case


def _two_digits(c: Column) -> Column:
    return F.lpad(c.cast("string"), 2, "0")


def _city_id(nation: str) -> Column:
    return F.concat(F.lit("C0"), _two_digits(F.col(nation) + 1))


def _category_id() -> Column:
    return F.concat(F.lit("A"), F.substring("c_mktsegment", 1, 3))


def _within(df: DataFrame, ts: str, year: int | None) -> DataFrame:
    return df if year is None else df.where(in_year(F.col(ts), year))


# --- dimensions ----------------------------------------------------------------


def dim_city(t: Tables) -> DataFrame:
    return t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        _city_id("n_nationkey").alias("city_id"),
        title_case(F.translate("n_name", "_", " ")).alias("city"),
        title_case(F.col("r_name")).alias("state"),
        F.concat(F.lit("Tier "), (F.col("n_nationkey") % 3 + 1).cast("string")).alias("tier"),
    )


def dim_ad_category(t: Tables) -> DataFrame:
    return (
        t.customer.select("c_mktsegment")
        .distinct()
        .select(
            _category_id().alias("ad_category_id"),
            title_case(F.col("c_mktsegment")).alias("standard_ad_category"),
            F.when(F.length("c_mktsegment") > 8, "Long").otherwise("Short").alias("category_group"),
            F.lower("c_mktsegment").alias("example_brands"),
        )
    )


# --- cleaned facts -------------------------------------------------------------


def print_sales(t: Tables, year: int | None = None) -> DataFrame:
    """One row per supplier and month; summed before the supplier is looked up."""
    copies = F.col("l_quantity").cast("int")
    monthly = (
        _within(t.lineitem, "l_shipdate", year)
        .select(
            "l_suppkey",
            F.trunc("l_shipdate", "MM").alias("month"),
            copies.alias("copies"),
            F.when(F.col("l_returnflag") == "R", copies).otherwise(0).alias("returned"),
        )
        .groupBy("l_suppkey", "month")
        .agg(F.sum("copies").alias("copies_printed"), F.sum("returned").alias("copies_returned"))
    )
    net = F.col("copies_printed") - F.col("copies_returned")
    return monthly.join(
        t.supplier.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey")
    ).select(
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("edition_id"),
        _city_id("s_nationkey").alias("city_id"),
        F.when(F.col("l_suppkey") % 2 == 0, "Hindi").otherwise("English").alias("language"),
        "month",
        net.alias("copies_sold"),
        "copies_printed",
        "copies_returned",
        net.alias("net_circulation"),
    )


def _orders_with_customer(t: Tables, year: int | None = None) -> DataFrame:
    """A skewed customer is split by the adaptive skew join; only sums follow."""
    return _within(t.orders, "o_orderdate", year).join(
        t.customer.select("c_custkey", "c_nationkey", "c_mktsegment"),
        F.col("o_custkey") == F.col("c_custkey"),
    )


def _currency() -> Column:
    return (
        F.when(F.col("o_orderkey") % 4 == 0, "USD")
        .when(F.col("o_orderkey") % 4 == 1, "EUR")
        .when(F.col("o_orderkey") % 4 == 2, "INR")
        .otherwise("IN RUPEES")
    )


def ad_revenue(t: Tables, year: int | None = None) -> DataFrame:
    amount = F.col("o_totalprice").cast("decimal(18,2)")
    rows = _orders_with_customer(t, year).select(
        F.concat(F.lit("ED10"), _two_digits(F.col("c_nationkey") + 1)).alias("edition_id"),
        _city_id("c_nationkey").alias("city_id"),
        _category_id().alias("ad_category_id"),
        quarter_text(F.col("o_orderdate")).alias("quarter"),
        amount.alias("amount"),
        to_base_currency(amount, _currency()).alias("in_inr"),
    )
    return rows.groupBy("edition_id", "city_id", "ad_category_id", "quarter").agg(
        F.sum("amount").alias("raw_ad_revenue"), F.sum("in_inr").alias("ad_revenue_in_inr")
    )


def readiness(t: Tables, year: int | None = None) -> DataFrame:
    def share(condition: Column) -> Column:
        pct = F.round(divide_or_null(F.count_if(condition) * 100, F.count(F.lit(1))), 2)
        return pct.cast("decimal(9,4)")

    status = F.col("o_orderstatus")
    return (
        _orders_with_customer(t, year)
        .groupBy(
            _city_id("c_nationkey").alias("city_id"),
            quarter_text(F.col("o_orderdate")).alias("quarter"),
        )
        .agg(
            share(status == "F").alias("literacy_rate"),
            share(status == "O").alias("smartphone_penetration"),
            share(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).alias(
                "internet_penetration"
            ),
        )
    )


PILOT_CATEGORIES = ("AAUT", "ABUI", "AFUR", "AHOU", "AMAC")


def pilot(t: Tables) -> DataFrame:
    accessed = F.col("event_type").isin("click", "purchase")
    value = F.col("value").cast("decimal(18,2)")
    user = F.col("user_id")
    category = F.element_at(
        F.array(*[F.lit(c) for c in PILOT_CATEGORIES]),
        (F.floor(user / 25) % len(PILOT_CATEGORIES) + 1).cast("int"),
    )
    errors = F.count_if(F.col("event_type") == "error")
    return (
        t.events.groupBy(
            F.concat(F.lit("Platform "), (F.col("event_id") % 4).cast("string")).alias("platform"),
            month_text(F.col("ts")).alias("launch_month"),
            category.alias("ad_category_id"),
            F.concat(F.lit("C0"), _two_digits(user % 25 + 1)).alias("city_id"),
        )
        .agg(
            F.sum(value).cast("decimal(18,4)").alias("dev_cost"),
            F.sum(F.when(F.col("event_type") == "signup", value).otherwise(0))
            .cast("decimal(18,4)")
            .alias("marketing_cost"),
            F.count(F.lit(1)).alias("users_reached"),
            F.count_if(accessed).alias("downloads_or_accesses"),
            F.round(divide_or_null(errors, F.count(F.lit(1))), 4)
            .cast("decimal(9,6)")
            .alias("avg_bounce_rate"),
        )
    )


class LazyStar:
    """The star schema with tables made when a report asks for them.

    ``year`` limits print, revenue and readiness already at the scan.
    """

    def __init__(self, t: Tables, year: int | None = None) -> None:
        self._t = t
        self._year = year

    @cached_property
    def dim_city(self) -> DataFrame:
        return dim_city(self._t)

    @cached_property
    def dim_ad_category(self) -> DataFrame:
        return dim_ad_category(self._t)

    @cached_property
    def print_sales(self) -> DataFrame:
        return print_sales(self._t, self._year)

    @cached_property
    def ad_revenue(self) -> DataFrame:
        return ad_revenue(self._t, self._year)

    @cached_property
    def readiness(self) -> DataFrame:
        return readiness(self._t, self._year)

    @cached_property
    def pilot(self) -> DataFrame:
        return pilot(self._t)


star = LazyStar


# --- raw tables ----------------------------------------------------------------


def _pick(key: Column, cases: dict[int, Column], modulus: int, otherwise: Column) -> Column:
    chosen = otherwise
    for remainder, value in reversed(cases.items()):
        chosen = F.when(key % modulus == remainder, value).otherwise(chosen)
    return chosen


def raw_dim_city(t: Tables) -> DataFrame:
    key = F.col("n_nationkey")
    return t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        _city_id("n_nationkey").alias("city_id"),
        F.concat(F.lit(" "), F.col("n_name"), F.lit("\t")).alias("city"),
        _pick(
            key,
            {0: F.lit("UTTAR PRADESH"), 1: F.lit("Uttar-Pradesh"), 2: F.lit("madhya_pradesh ")},
            4,
            F.col("r_name"),
        ).alias("state"),
        F.concat(F.lit(" Tier "), (key % 3 + 1).cast("string")).alias("tier"),
    )


def raw_dim_ad_category(t: Tables) -> DataFrame:
    return (
        t.customer.select("c_mktsegment")
        .distinct()
        .select(
            _category_id().alias("ad_category_id"),
            F.concat(F.lit(" "), F.col("c_mktsegment"), F.lit(" ")).alias("standard_ad_category"),
            F.concat(F.lower("c_mktsegment"), F.lit("\n")).alias("category_group"),
            F.concat(F.lit("\u00a0"), F.col("c_mktsegment")).alias("example_brands"),
        )
    )


def raw_ad_revenue(t: Tables) -> DataFrame:
    """Orders as a messy revenue file; ``o_orderkey`` stands for the file order."""
    key = F.col("o_orderkey")
    price = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    amount = _pick(
        key,
        {
            0: F.concat(F.lit("₹"), price),
            1: F.concat(F.lit(" "), price, F.lit(" ")),
            3: F.concat(
                F.substr(price, F.lit(1), F.length(price) - 6), F.lit(","), F.right(price, F.lit(6))
            ),
            4: F.concat(F.lit("Rs "), price),
        },
        6,
        price,
    )
    amount = F.when(key % 97 == 0, "n/a").when(key % 103 == 0, F.concat(price, F.lit("/-"))).otherwise(
        amount
    )
    amount = F.when(key % 101 != 0, amount)
    year, quarter = (f(F.col("o_orderdate")).cast("string") for f in (F.year, F.quarter))
    spelled = _pick(
        key,
        {
            0: F.concat(year, F.lit("-Q"), quarter),
            1: F.concat(F.lit(" Q"), quarter, F.lit("-"), year),
        },
        3,
        F.concat(quarter, F.lit("th Qtr "), year),
    )
    spelled = (
        F.when(key % 211 == 0, "unknown")
        .when(key % 89 == 0, F.concat(F.lit("H2 "), year))
        .otherwise(spelled)
    )
    currency = F.when(key % 5 == 0, F.concat(F.lower(_currency()), F.lit(" "))).otherwise(_currency())
    currency = F.when(key % 113 == 0, "GBP").otherwise(currency)
    comment = _pick(
        key,
        {
            0: F.concat(F.lit("note "), key.cast("string")),
            1: F.lit("nan"),
            2: F.lit("  "),
            3: F.concat(F.lit(" client "), F.col("o_custkey").cast("string"), F.lit(" ")),
        },
        50,
        F.lit(None).cast("string"),
    )
    edition = F.concat(F.lit("ED10"), _two_digits(F.col("c_nationkey") + 1))
    return _orders_with_customer(t).select(
        key,
        F.when(key % 7 == 0, F.concat(edition, F.lit(" "))).otherwise(edition).alias("edition_id"),
        F.when(key % 11 == 0, F.concat(_category_id(), F.lit("\t")))
        .otherwise(_category_id())
        .alias("ad_category"),
        spelled.alias("quarter"),
        amount.alias("ad_revenue"),
        F.when(key % 127 != 0, currency).alias("currency"),
        comment.alias("comments"),
    )


# A complete order of the rows, in place of a position in a file.
PRINT_ORDER = (
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
    "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
)


def raw_print_sales(t: Tables) -> DataFrame:
    line, copies = F.col("l_linenumber"), F.col("l_quantity").cast("int")
    returned = F.when(F.col("l_returnflag") == "R", F.floor(copies / 4)).otherwise(0)
    language = F.when(F.col("l_suppkey") % 2 == 0, "hindi").otherwise("english")
    state = _pick(
        F.col("s_nationkey"),
        {
            0: F.when(line % 2 == 0, "Uttar-Pradesh").otherwise("uttar pradesh"),
            1: F.when(line % 2 == 0, "Madhya_Pradesh").otherwise("MADHYA PRADESH"),
            2: F.when(line % 2 == 0, "Delhi ").otherwise("DELHI"),
        },
        4,
        F.lit("gujarat"),
    )
    return t.lineitem.join(
        t.supplier.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey")
    ).select(
        F.concat(F.lit(" S"), F.col("l_suppkey").cast("string")).alias("edition_ID"),
        F.concat(_city_id("s_nationkey"), F.lit(" ")).alias("City_ID"),
        F.when(line % 3 == 0, F.upper(language)).otherwise(language).alias("Language"),
        state.alias("State"),
        F.date_format("l_shipdate", "yyyy-MM").alias("Month"),
        F.when(line % 2 == 0, F.concat(F.lit("₹"), copies.cast("string")))
        .otherwise(copies.cast("string"))
        .alias("Copies Sold"),
        returned.cast("string").alias("copies_returned"),
        (copies - returned).cast("string").alias("Net_Circulation"),
        *PRINT_ORDER,
    )


def raw_readiness(t: Tables) -> DataFrame:
    q = F.col("quarter")
    spelled = F.concat(F.substring(q, 6, 2), F.lit("-"), F.substring(q, 1, 4))
    return readiness(t).select(
        F.concat(F.lit(" "), F.col("city_id")).alias("city_id"),
        F.when(F.col("literacy_rate") > 33, spelled).otherwise(q).alias("quarter"),
        *[
            F.concat(F.col(c).cast("decimal(9,2)").cast("string"), F.lit("%")).alias(c)
            for c in ("literacy_rate", "smartphone_penetration", "internet_penetration")
        ],
    )


def raw_pilot(t: Tables) -> DataFrame:
    money = lambda c: F.concat(F.lit("₹ "), F.col(c).cast("decimal(18,2)").cast("string"))
    return pilot(t).select(
        F.concat(F.col("platform"), F.lit("\n")).alias("platform"),
        "launch_month",
        F.concat(F.lit(" "), F.col("ad_category_id")).alias("ad_category_id"),
        money("dev_cost").alias("dev_cost"),
        money("marketing_cost").alias("marketing_cost"),
        F.concat(F.lit("~"), F.col("users_reached").cast("string")).alias("users_reached"),
        F.col("downloads_or_accesses").cast("string").alias("downloads_or_accesses"),
        (F.col("avg_bounce_rate") * 100).cast("decimal(9,2)").cast("string").alias("avg_bounce_rate"),
        F.concat(F.lit(" works for "), F.col("city_id"), F.lit(",\nmostly ")).alias(
            "cumulative_feedback_from_customers"
        ),
        "city_id",
    )


# --- the same in SQL -------------------------------------------------------------

_SQL_TITLE = (
    "array_to_string([upper(w[1]) || w[2:] "
    "FOR w IN regexp_extract_all(lower({0}), '([a-z]+|[^a-z]+)')], '')"
)


def sql_title(x: str) -> str:
    return _SQL_TITLE.format(x)


def _sql_city(nation: str) -> str:
    return f"'C0' || lpad(({nation} + 1)::VARCHAR, 2, '0')"


_SQL_QUARTER = "year(o_orderdate)::VARCHAR || '-Q' || quarter(o_orderdate)::VARCHAR"
_SQL_CURRENCY = (
    "CASE o_orderkey % 4 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' WHEN 2 THEN 'INR' "
    "ELSE 'IN RUPEES' END"
)
_SQL_RATE = "CASE o_orderkey % 4 WHEN 0 THEN 80 WHEN 1 THEN 85 ELSE 1 END"
_SQL_PRICE = "o_totalprice::DECIMAL(18,2)::VARCHAR"

CTES = {
    "dim_city": f"""
        SELECT {_sql_city('n_nationkey')} AS city_id,
               {sql_title("replace(n_name, '_', ' ')")} AS city,
               {sql_title('r_name')} AS state,
               'Tier ' || (n_nationkey % 3 + 1)::VARCHAR AS tier
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "dim_ad_category": f"""
        SELECT DISTINCT 'A' || substr(c_mktsegment, 1, 3) AS ad_category_id,
               {sql_title('c_mktsegment')} AS standard_ad_category,
               CASE WHEN length(c_mktsegment) > 8 THEN 'Long' ELSE 'Short' END AS category_group,
               lower(c_mktsegment) AS example_brands
        FROM customer""",
    "print_sales": f"""
        SELECT 'S' || l_suppkey::VARCHAR AS edition_id, {_sql_city('s_nationkey')} AS city_id,
               CASE WHEN l_suppkey % 2 = 0 THEN 'Hindi' ELSE 'English' END AS language,
               date_trunc('month', l_shipdate)::DATE AS month,
               sum(l_quantity::BIGINT)::BIGINT AS copies_printed,
               sum(CASE WHEN l_returnflag = 'R' THEN l_quantity::BIGINT ELSE 0 END)::BIGINT
                   AS copies_returned,
               sum(CASE WHEN l_returnflag = 'R' THEN 0 ELSE l_quantity::BIGINT END)::BIGINT
                   AS net_circulation,
               sum(CASE WHEN l_returnflag = 'R' THEN 0 ELSE l_quantity::BIGINT END)::BIGINT
                   AS copies_sold
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
        GROUP BY l_suppkey, s_nationkey, date_trunc('month', l_shipdate)""",
    "ad_revenue": f"""
        SELECT 'ED10' || lpad((c_nationkey + 1)::VARCHAR, 2, '0') AS edition_id,
               {_sql_city('c_nationkey')} AS city_id,
               'A' || substr(c_mktsegment, 1, 3) AS ad_category_id,
               {_SQL_QUARTER} AS quarter,
               sum(o_totalprice::DECIMAL(18,2)) AS raw_ad_revenue,
               sum(o_totalprice::DECIMAL(18,2) * ({_SQL_RATE})) AS ad_revenue_in_inr
        FROM orders JOIN customer ON o_custkey = c_custkey
        GROUP BY 1, 2, 3, 4""",
    "readiness": f"""
        SELECT {_sql_city('c_nationkey')} AS city_id, {_SQL_QUARTER} AS quarter,
               round(100 * count(*) FILTER (o_orderstatus = 'F') / count(*)::DOUBLE, 2)
                   AS literacy_rate,
               round(100 * count(*) FILTER (o_orderstatus = 'O') / count(*)::DOUBLE, 2)
                   AS smartphone_penetration,
               round(100 * count(*) FILTER (o_orderpriority IN ('1-URGENT', '2-HIGH'))
                     / count(*)::DOUBLE, 2) AS internet_penetration
        FROM orders JOIN customer ON o_custkey = c_custkey
        GROUP BY 1, 2""",
    "pilot": """
        SELECT 'Platform ' || (event_id % 4)::VARCHAR AS platform,
               strftime(ts, '%Y-%m') AS launch_month,
               (['AAUT', 'ABUI', 'AFUR', 'AHOU', 'AMAC'])[(user_id // 25) % 5 + 1]
                   AS ad_category_id,
               'C0' || lpad((user_id % 25 + 1)::VARCHAR, 2, '0') AS city_id,
               sum(value::DECIMAL(18,2)) AS dev_cost,
               sum(CASE WHEN event_type = 'signup' THEN value::DECIMAL(18,2) ELSE 0 END)
                   AS marketing_cost,
               count(*) AS users_reached,
               count(*) FILTER (event_type IN ('click', 'purchase')) AS downloads_or_accesses,
               round(count(*) FILTER (event_type = 'error') / count(*)::DOUBLE, 4)
                   AS avg_bounce_rate
        FROM events
        GROUP BY 1, 2, 3, 4""",
    "raw_dim_city": f"""
        SELECT {_sql_city('n_nationkey')} AS city_id, ' ' || n_name || chr(9) AS city,
               CASE n_nationkey % 4 WHEN 0 THEN 'UTTAR PRADESH' WHEN 1 THEN 'Uttar-Pradesh'
                    WHEN 2 THEN 'madhya_pradesh ' ELSE r_name END AS state,
               ' Tier ' || (n_nationkey % 3 + 1)::VARCHAR AS tier
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "raw_dim_ad_category": """
        SELECT DISTINCT 'A' || substr(c_mktsegment, 1, 3) AS ad_category_id,
               ' ' || c_mktsegment || ' ' AS standard_ad_category,
               lower(c_mktsegment) || chr(10) AS category_group,
               chr(160) || c_mktsegment AS example_brands
        FROM customer""",
    "raw_ad_revenue": f"""
        SELECT o_orderkey,
               'ED10' || lpad((c_nationkey + 1)::VARCHAR, 2, '0')
                   || CASE WHEN o_orderkey % 7 = 0 THEN ' ' ELSE '' END AS edition_id,
               'A' || substr(c_mktsegment, 1, 3)
                   || CASE WHEN o_orderkey % 11 = 0 THEN chr(9) ELSE '' END AS ad_category,
               CASE WHEN o_orderkey % 211 = 0 THEN 'unknown'
                    WHEN o_orderkey % 89 = 0 THEN 'H2 ' || year(o_orderdate)::VARCHAR
                    WHEN o_orderkey % 3 = 0 THEN {_SQL_QUARTER}
                    WHEN o_orderkey % 3 = 1 THEN ' Q' || quarter(o_orderdate)::VARCHAR || '-'
                         || year(o_orderdate)::VARCHAR
                    ELSE quarter(o_orderdate)::VARCHAR || 'th Qtr '
                         || year(o_orderdate)::VARCHAR END AS quarter,
               CASE WHEN o_orderkey % 101 = 0 THEN NULL
                    WHEN o_orderkey % 97 = 0 THEN 'n/a'
                    WHEN o_orderkey % 103 = 0 THEN {_SQL_PRICE} || '/-'
                    WHEN o_orderkey % 6 = 0 THEN '₹' || {_SQL_PRICE}
                    WHEN o_orderkey % 6 = 1 THEN ' ' || {_SQL_PRICE} || ' '
                    WHEN o_orderkey % 6 = 3 THEN left({_SQL_PRICE}, length({_SQL_PRICE}) - 6)
                         || ',' || right({_SQL_PRICE}, 6)
                    WHEN o_orderkey % 6 = 4 THEN 'Rs ' || {_SQL_PRICE}
                    ELSE {_SQL_PRICE} END AS ad_revenue,
               CASE WHEN o_orderkey % 127 = 0 THEN NULL
                    WHEN o_orderkey % 113 = 0 THEN 'GBP'
                    WHEN o_orderkey % 5 = 0 THEN lower({_SQL_CURRENCY}) || ' '
                    ELSE {_SQL_CURRENCY} END AS currency,
               CASE o_orderkey % 50 WHEN 0 THEN 'note ' || o_orderkey::VARCHAR WHEN 1 THEN 'nan'
                    WHEN 2 THEN '  ' WHEN 3 THEN ' client ' || o_custkey::VARCHAR || ' ' END
                   AS comments
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "raw_print_sales": f"""
        SELECT ' S' || l_suppkey::VARCHAR AS "edition_ID",
               {_sql_city('s_nationkey')} || ' ' AS "City_ID",
               CASE WHEN l_linenumber % 3 = 0 THEN upper(language) ELSE language END AS "Language",
               CASE WHEN s_nationkey % 4 = 0 THEN
                         CASE WHEN l_linenumber % 2 = 0 THEN 'Uttar-Pradesh' ELSE 'uttar pradesh' END
                    WHEN s_nationkey % 4 = 1 THEN
                         CASE WHEN l_linenumber % 2 = 0 THEN 'Madhya_Pradesh'
                              ELSE 'MADHYA PRADESH' END
                    WHEN s_nationkey % 4 = 2 THEN
                         CASE WHEN l_linenumber % 2 = 0 THEN 'Delhi ' ELSE 'DELHI' END
                    ELSE 'gujarat' END AS "State",
               strftime(l_shipdate, '%Y-%m') AS "Month",
               CASE WHEN l_linenumber % 2 = 0 THEN '₹' ELSE '' END
                   || l_quantity::BIGINT::VARCHAR AS "Copies Sold",
               returned::VARCHAR AS copies_returned,
               (l_quantity::BIGINT - returned)::VARCHAR AS "Net_Circulation",
               {', '.join(PRINT_ORDER)}
        FROM (SELECT *, CASE WHEN l_suppkey % 2 = 0 THEN 'hindi' ELSE 'english' END AS language,
                     CASE WHEN l_returnflag = 'R' THEN l_quantity::BIGINT // 4 ELSE 0 END
                         AS returned
              FROM lineitem) JOIN supplier ON l_suppkey = s_suppkey""",
}


def with_ctes(body: str, *names: str) -> str:
    """``body`` with the named definitions in front."""
    definitions = ", ".join(f"{n} AS ({CTES[n]})" for n in names)
    head, found, rest = body.lstrip().partition("WITH ")
    if not head and found:
        return f"WITH {definitions}, {rest}"
    return f"WITH {definitions} {body}"
