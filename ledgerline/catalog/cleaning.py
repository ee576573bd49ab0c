"""Scalar cleaners on messy renderings of the test tables, and the table cleaners."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.catalog import analogue as a
from ledgerline.catalog.analogue import sql_title, with_ctes
from ledgerline.catalog.base import Tables, entry
from ledgerline.functions import arithmetic as ar
from ledgerline.functions import money, numbers, periods, text
from ledgerline.operators.consolidate import add_increment, consolidate, keep_first, keep_stored
from ledgerline.operators.reshape import relabel
from ledgerline.plans import clean

# Trims what str.strip() trims, as far as the renderings use it.
_BLANKS = "chr(32) || chr(9) || chr(10) || chr(13) || chr(160)"


def _trim(x: str) -> str:
    return f"trim({x}, {_BLANKS})"


def _ints(x: str) -> str:
    kept = f"regexp_replace({x}, '[^0-9-]', '', 'g')"
    return f"coalesce(try_cast(nullif({kept}, '') AS BIGINT), 0)"


def _floats(x: str) -> str:
    kept = f"regexp_replace({x}, '[^0-9.-]', '', 'g')"
    return f"coalesce(try_cast(nullif({kept}, '') AS DOUBLE), 0)"


def _money(x: str) -> str:
    kept = f"regexp_replace({x}, '[^0-9.-]', '', 'g')"
    return f"coalesce(try_cast(nullif({kept}, '') AS DECIMAL(18,4)), 0)"


def _quarter(x: str) -> str:
    t = _trim(x)
    return f"""CASE
        WHEN regexp_matches({t}, '^Q[1-4]-[0-9]{{4}}$') THEN right({t}, 4) || '-' || left({t}, 2)
        WHEN regexp_matches({t}, '^[0-9]th\\s+Qtr\\s+[0-9]{{4}}$')
            THEN right({t}, 4) || '-Q' || left({t}, 1)
        ELSE {t} END"""


_YEAR = "try_cast(nullif(regexp_extract(quarter, '\\b([0-9]{4})\\b', 1), '') AS BIGINT)"
_CODE = f"upper({_trim('currency')})"
_RATE = f"CASE {_CODE} WHEN 'USD' THEN 80 WHEN 'EUR' THEN 85 ELSE 1 END"
_NOTE = f"CASE WHEN {_trim('comments')} NOT IN ('nan', '', 'None') THEN {_trim('comments')} END"
_CITY = f"'C0' || substr({_trim('edition_id')}, 5)"
_STATE = (
    "CASE {0} WHEN 'Uttar-Pradesh' THEN 'Uttar Pradesh' "
    "WHEN 'Madhya_Pradesh' THEN 'Madhya Pradesh' ELSE {0} END"
)


def _state(x: str) -> str:
    return _STATE.format(sql_title(_trim(x)))


def _revenue(columns: str) -> str:
    return with_ctes(f"SELECT o_orderkey, {columns} FROM raw_ad_revenue", "raw_ad_revenue")


# --- functions -----------------------------------------------------------------


@entry("f1_clean_int", _revenue(f"ad_revenue, {_ints('ad_revenue')} AS cleaned"))
def clean_int(t: Tables) -> DataFrame:
    c = F.col("ad_revenue")
    return a.raw_ad_revenue(t).select(
        "o_orderkey", c, numbers.clean_int(c, on_bad="zero").alias("cleaned")
    )


@entry("f2_clean_float", _revenue(f"ad_revenue, {_floats('ad_revenue')}::DOUBLE AS cleaned"))
def clean_float(t: Tables) -> DataFrame:
    c = F.col("ad_revenue")
    return a.raw_ad_revenue(t).select("o_orderkey", c, numbers.clean_float(c).alias("cleaned"))


@entry(
    "f3_parse_grouped",
    """SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber,
              l_extendedprice::DECIMAL(18,2)::DOUBLE AS price FROM lineitem""",
)
def parse_grouped(t: Tables) -> DataFrame:
    grouped = F.concat(F.lit(" "), F.format_number(F.col("l_extendedprice"), 2))
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", numbers.parse_grouped(grouped).alias("price")
    )


@entry("f4_normalize_quarter", _revenue(f"{_quarter('quarter')} AS quarter"))
def normalize_quarter(t: Tables) -> DataFrame:
    return a.raw_ad_revenue(t).select(
        "o_orderkey", periods.normalize_quarter(F.col("quarter")).alias("quarter")
    )


@entry("f5_find_year", _revenue(f"{_YEAR} AS year"))
def find_year(t: Tables) -> DataFrame:
    return a.raw_ad_revenue(t).select("o_orderkey", periods.find_year(F.col("quarter")).alias("year"))


@entry(
    "f6_to_base_currency",
    _revenue(f"({_money('ad_revenue')} * ({_RATE}))::DOUBLE AS in_inr"),
)
def to_base_currency(t: Tables) -> DataFrame:
    amount = numbers.clean_decimal(F.col("ad_revenue"))
    return a.raw_ad_revenue(t).select(
        "o_orderkey", money.to_base_currency(amount, F.col("currency")).alias("in_inr")
    )


@entry(
    "f7_currency_code",
    _revenue(f"CASE {_CODE} WHEN 'IN RUPEES' THEN 'INR' ELSE {_CODE} END AS currency"),
)
def currency_code(t: Tables) -> DataFrame:
    return a.raw_ad_revenue(t).select(
        "o_orderkey", money.currency_code(F.col("currency")).alias("currency")
    )


@entry("f8_strip", _revenue(f"{_trim('edition_id')} AS edition_id, {_trim('ad_category')} AS ad_category"))
def strip(t: Tables) -> DataFrame:
    return a.raw_ad_revenue(t).select(
        "o_orderkey", *[text.strip(F.col(c)).alias(c) for c in ("edition_id", "ad_category")]
    )


@entry(
    "f9_title_case",
    f"""SELECT p_partkey, {sql_title("replace(p_name, ' ', '-') || '_' || p_type || ' ' || p_brand")}
        AS title FROM part""",
)
def title_case(t: Tables) -> DataFrame:
    joined = F.concat(
        F.translate("p_name", " ", "-"), F.lit("_"), F.col("p_type"), F.lit(" "), F.col("p_brand")
    )
    return t.part.select("p_partkey", text.title_case(joined).alias("title"))


@entry(
    "f10_remap",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'filled' WHEN 'O' THEN 'open'
              ELSE o_orderstatus END AS status FROM orders""",
)
def remap(t: Tables) -> DataFrame:
    status = text.remap(F.col("o_orderstatus"), {"F": "filled", "O": "open"})
    return t.orders.select("o_orderkey", status.alias("status"))


@entry("f11_key_from_code", _revenue(f"{_CITY} AS city_id"))
def key_from_code(t: Tables) -> DataFrame:
    edition = text.strip(F.col("edition_id"))
    return a.raw_ad_revenue(t).select("o_orderkey", text.key_from_code(edition).alias("city_id"))


@entry(
    "f12_parse_month",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 2 THEN NULL
              ELSE strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') END AS month
       FROM orders""",
)
def parse_month(t: Tables) -> DataFrame:
    key, date = F.col("o_orderkey"), F.col("o_orderdate")
    spelled = (
        F.when(key % 3 == 0, F.date_format(date, "yyyy-MM"))
        .when(key % 3 == 1, F.date_format(date, "MMM-yyyy"))
        .otherwise("soon")
    )
    return t.orders.select("o_orderkey", periods.parse_month(spelled).alias("month"))


@entry(
    "f13_percent_to_ratio",
    """SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber,
              (l_discount::DECIMAL(9,2) * 100 / 100)::DECIMAL(9,4)::DOUBLE AS ratio
       FROM lineitem""",
)
def percent_to_ratio(t: Tables) -> DataFrame:
    pct = F.concat((F.col("l_discount") * 100).cast("decimal(9,2)").cast("string"), F.lit(" %"))
    ratio = (numbers.clean_decimal(pct) / 100).cast("decimal(9,4)")
    return t.lineitem.select("l_orderkey", "l_linenumber", ratio.alias("ratio"))


@entry("f14_blank_to_null", _revenue(f"{_NOTE} AS comments"))
def blank_to_null(t: Tables) -> DataFrame:
    note = text.blank_to_null(text.strip(F.col("comments")))
    return a.raw_ad_revenue(t).select("o_orderkey", note.alias("comments"))


@entry("f15_year_of_date", "SELECT o_orderkey, year(o_orderdate)::BIGINT AS year FROM orders")
def year_of_date(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", F.year("o_orderdate").alias("year"))


@entry(
    "f16_year_of_quarter",
    _revenue(f"try_cast(left({_quarter('quarter')}, 4) AS BIGINT) AS year"),
)
def year_of_quarter(t: Tables) -> DataFrame:
    year = periods.quarter_year(periods.normalize_quarter(F.col("quarter")))
    return a.raw_ad_revenue(t).select("o_orderkey", year.alias("year"))


@entry("f17_month_text", "SELECT event_id, strftime(ts, '%Y-%m') AS month FROM events")
def month_text(t: Tables) -> DataFrame:
    return t.events.select("event_id", periods.month_text(F.col("ts")).alias("month"))


@entry(
    "f18_round_half_up",
    """SELECT o_orderkey,
              (floor(o_totalprice::DECIMAL(18,2) * 10 + 0.5) / 10)::DECIMAL(18,1)::DOUBLE AS one_digit,
              floor(o_totalprice::DECIMAL(18,2) + 0.5)::DOUBLE AS whole
       FROM orders""",
)
def round_half_up(t: Tables) -> DataFrame:
    price = F.col("o_totalprice").cast("decimal(18,2)")
    return t.orders.select(
        "o_orderkey",
        ar.rounded(price, 1).alias("one_digit"),
        ar.rounded(price, 0).alias("whole"),
    )


_RETURNED = "sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END)"
_ACCEPTED = "sum(CASE WHEN l_returnflag = 'A' THEN l_quantity ELSE 0 END)"


def _flag_sums(t: Tables) -> DataFrame:
    q = F.col("l_quantity").cast("int")
    of = lambda flag: F.sum(F.when(F.col("l_returnflag") == flag, q).otherwise(0))
    return t.lineitem.groupBy("l_orderkey").agg(of("R").alias("r"), of("A").alias("a"))


@entry(
    "f19_divide_or_null",
    f"""SELECT l_orderkey, round({_RETURNED} / nullif({_ACCEPTED}, 0), 4) AS r_per_a
        FROM lineitem GROUP BY 1""",
)
def divide_or_null(t: Tables) -> DataFrame:
    return _flag_sums(t).select(
        "l_orderkey", ar.ratio(F.col("r"), F.col("a"), 4).alias("r_per_a")
    )


@entry(
    "f20_divide_or_default",
    f"""SELECT l_orderkey, coalesce(round({_RETURNED} / nullif({_ACCEPTED}, 0), 4), 0) AS r_per_a
        FROM lineitem GROUP BY 1""",
)
def divide_or_default(t: Tables) -> DataFrame:
    return _flag_sums(t).select(
        "l_orderkey", ar.rounded(ar.divide_or(F.col("r"), F.col("a")), 4).alias("r_per_a")
    )


@entry(
    "f21_numeric_cast",
    """SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_quantity::BIGINT AS quantity,
              l_extendedprice::DECIMAL(18,2)::DOUBLE AS price FROM lineitem""",
)
def numeric_cast(t: Tables) -> DataFrame:
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        numbers.int_from_number(F.col("l_quantity")).alias("quantity"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("price"),
    )


@entry(
    "f22_unit_scaling",
    """SELECT c_nationkey::BIGINT AS c_nationkey,
              round(sum(o_totalprice::DECIMAL(18,2))::DOUBLE / 10000000, 2) AS crore,
              round(sum(o_totalprice::DECIMAL(18,2))::DOUBLE / 100000, 2) AS lakh
       FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1""",
)
def unit_scaling(t: Tables) -> DataFrame:
    total = ar.exact(F.col("total"))
    return (
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_nationkey")
        .agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("total"))
        .select(
            "c_nationkey",
            ar.rounded(total / F.lit(money.CRORE), 2).alias("crore"),
            ar.rounded(total / F.lit(money.LAKH), 2).alias("lakh"),
        )
    )


@entry(
    "f23_band",
    """SELECT c_custkey, CASE WHEN c_acctbal >= 7500 THEN 'rich' WHEN c_acctbal >= 2500.5 THEN 'fair'
              WHEN c_acctbal >= 0 THEN 'low' ELSE 'debt' END AS band FROM customer""",
)
def band(t: Tables) -> DataFrame:
    cuts = {"rich": "7500", "fair": "2500.5", "low": "0"}
    balance = F.col("c_acctbal").cast("decimal(18,2)")
    return t.customer.select("c_custkey", ar.band(balance, cuts, "debt").alias("band"))


@entry(
    "f24_relabel",
    """SELECT o_orderkey, CASE quarter(o_orderdate) WHEN 1 THEN 'Q1' WHEN 4 THEN 'Q4' END AS label
       FROM orders""",
)
def relabel_quarter(t: Tables) -> DataFrame:
    label = relabel(F.quarter("o_orderdate").cast("string"), {"1": "Q1", "4": "Q4"})
    return t.orders.select("o_orderkey", label.alias("label"))


@entry(
    "f25_two_condition_status",
    with_ctes(
        """SELECT city_id, CASE WHEN ready >= 33 AND engaged < 0.4 THEN 'ready, idle'
                  WHEN ready >= 33 AND engaged >= 0.4 THEN 'ready, active' ELSE 'not ready' END
                  AS status
           FROM (SELECT city_id, max(literacy_rate) AS ready FROM readiness GROUP BY 1)
           JOIN (SELECT city_id, sum(downloads_or_accesses) / sum(users_reached) AS engaged
                 FROM pilot GROUP BY 1) USING (city_id)""",
        "readiness",
        "pilot",
    ),
)
def two_condition_status(t: Tables) -> DataFrame:
    ready = a.readiness(t).groupBy("city_id").agg(F.max("literacy_rate").alias("ready"))
    engaged = (
        a.pilot(t)
        .groupBy("city_id")
        .agg(ar.divide_or_null(F.sum("downloads_or_accesses"), F.sum("users_reached")).alias("rate"))
    )
    is_ready, active = F.col("ready") >= 33, F.col("rate") >= F.lit("0.4").cast("decimal(9,4)")
    status = F.when(is_ready & ~active, "ready, idle").when(is_ready & active, "ready, active")
    return ready.join(engaged, "city_id").select(
        "city_id", status.otherwise("not ready").alias("status")
    )


@entry(
    "f26_yes_no",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' AND o_totalprice > 100000 THEN 'Yes'
              ELSE 'No' END AS is_large_filled FROM orders""",
)
def yes_no(t: Tables) -> DataFrame:
    large = (F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 100000)
    return t.orders.select("o_orderkey", ar.yes_no(large).alias("is_large_filled"))


@entry(
    "f27_row_mean",
    with_ctes(
        """SELECT city_id, quarter,
                  round((literacy_rate + smartphone_penetration + internet_penetration) / 3, 4)
                      AS readiness FROM readiness""",
        "readiness",
    ),
)
def row_mean(t: Tables) -> DataFrame:
    rates = [F.col(c) for c in ("literacy_rate", "smartphone_penetration", "internet_penetration")]
    return a.readiness(t).select(
        "city_id", "quarter", ar.rounded(ar.row_mean(*rates), 4).alias("readiness")
    )


@entry(
    "f28_weighted_score",
    with_ctes(
        """SELECT city_id, quarter,
                  round(literacy_rate::DECIMAL(9,2) * 0.4
                        + (100 - smartphone_penetration::DECIMAL(9,2)) * 0.3
                        + internet_penetration::DECIMAL(9,2) * 0.3, 3)::DOUBLE AS score
           FROM readiness""",
        "readiness",
    ),
)
def weighted_score(t: Tables) -> DataFrame:
    score = ar.weighted_score(
        [
            (F.col("literacy_rate"), "0.4"),
            (F.lit(100) - F.col("smartphone_penetration"), "0.3"),
            (F.col("internet_penetration"), "0.3"),
        ]
    )
    return a.readiness(t).select("city_id", "quarter", ar.rounded(score, 3).alias("score"))


# --- duplicates ----------------------------------------------------------------

_KEYS = (
    f"SELECT o_orderkey, {_trim('edition_id')} AS edition_id, {_CITY} AS city_id, "
    f"{_trim('ad_category')} AS ad_category_id, {_quarter('quarter')} AS quarter, "
    f"{_money('ad_revenue')} AS amount, {_money('ad_revenue')} * ({_RATE}) AS in_inr, "
    f"{_NOTE} AS note FROM raw_ad_revenue"
)
_E4 = with_ctes(
    f"""WITH cleaned AS ({_KEYS})
        SELECT edition_id, city_id, ad_category_id, quarter,
               sum(amount)::DOUBLE AS raw_ad_revenue, 'INR' AS currency,
               sum(in_inr)::DOUBLE AS ad_revenue_in_inr,
               string_agg(note, '; ' ORDER BY o_orderkey) AS comments
        FROM cleaned GROUP BY 1, 2, 3, 4""",
    "raw_ad_revenue",
)


_CONSOLIDATED = """SELECT o_custkey, year(o_orderdate)::BIGINT AS year,
              sum(o_totalprice::DECIMAL(18,2))::DOUBLE AS amount, count(*)::BIGINT AS orders,
              string_agg(CASE WHEN o_orderpriority LIKE '1%' THEN o_orderkey::VARCHAR END, '; '
                         ORDER BY o_orderkey) AS urgent_orders
       FROM orders GROUP BY 1, 2"""


def _noted_orders(t: Tables) -> DataFrame:
    key = F.col("o_orderkey")
    return t.orders.select(
        "o_custkey",
        F.year("o_orderdate").alias("year"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("amount"),
        F.lit(1).alias("orders"),
        F.when(F.col("o_orderpriority") == "1-URGENT", key.cast("string")).alias("urgent_orders"),
        key,
    )


@entry("a7_consolidate", _CONSOLIDATED)
def consolidate_orders(t: Tables) -> DataFrame:
    # Runs of neighbouring order keys are joined first, then the runs.
    return consolidate(
        _noted_orders(t), ["o_custkey", "year"], ["amount", "orders"], "urgent_orders", ["o_orderkey"],
        [F.floor(F.col("o_orderkey") / 4096)],
    )


@entry("a7_merge_increment", _CONSOLIDATED)
def merge_orders(t: Tables) -> DataFrame:
    """The orders in three loads, each merged into the buckets of the customers it has."""
    keys, sums, note = ["o_custkey", "year"], ["amount", "orders"], "urgent_orders"
    rows = _noted_orders(t)
    last = rows.agg(F.max("o_orderkey")).first()[0] or 0
    cuts = [0, last // 2, last - last // 50, last + 1]
    for low, high in zip(cuts, cuts[1:]):
        new = rows.where(F.col("o_orderkey").between(low, high - 1))
        new = consolidate(new, keys, sums, note, ["o_orderkey"], [F.floor(F.col("o_orderkey") / 4096)])
        new = new.withColumns({"amount": F.col("amount").cast("decimal(38,2)"), "orders": F.col("orders").cast("bigint")})
        with t.layers.change() as change:
            bucket = F.pmod(F.hash("o_custkey"), F.lit(16))
            change.merge(new, "cleaned", "orders", bucket, add_increment(keys, sums, note), load=f"to-{high}")
    return t.layers.read("cleaned", "orders")


@entry(
    "a11_keep_first",
    f"""SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey, l_suppkey, l_quantity,
               l_extendedprice
        FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                           ORDER BY {', '.join(a.PRINT_ORDER)}) AS nth
              FROM lineitem) WHERE nth = 1""",
)
def keep_first_line(t: Tables) -> DataFrame:
    first = keep_first(t.lineitem, ["l_orderkey", "l_linenumber"], a.PRINT_ORDER)
    return first.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"
    )


@entry(
    "a11_merge_increment",
    f"""SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey, l_suppkey, l_quantity,
               l_extendedprice
        FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                           ORDER BY l_suppkey % 3 = 0, {', '.join(a.PRINT_ORDER)}) AS nth
              FROM lineitem) WHERE nth = 1""",
)
def merge_first_lines(t: Tables) -> DataFrame:
    """What is stored stays; the second load only adds the keys that are new."""
    late = F.col("l_suppkey") % 3 == 0
    keys = ["l_orderkey", "l_linenumber"]
    for name, rows in (("early", ~late), ("late", late)):
        new = keep_first(t.lineitem.where(rows), keys, a.PRINT_ORDER)
        with t.layers.change() as change:
            bucket = F.pmod(F.hash(*keys), F.lit(16))
            change.merge(new, "cleaned", "lines", bucket, keep_stored(keys, a.PRINT_ORDER), load=name)
    return t.layers.read("cleaned", "lines").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"
    )


# --- whole tables ----------------------------------------------------------------


@entry(
    "e1_dim_city",
    with_ctes(
        f"""SELECT city_id, {sql_title(_trim('city'))} AS city, {_state('state')} AS state,
                   {_trim('tier')} AS tier FROM raw_dim_city""",
        "raw_dim_city",
    ),
)
def e1(t: Tables) -> DataFrame:
    return clean.dim_city(a.raw_dim_city(t))


@entry(
    "e2_dim_ad_category",
    with_ctes(
        f"""SELECT ad_category_id, {_trim('standard_ad_category')} AS standard_ad_category,
                   {_trim('category_group')} AS category_group,
                   {_trim('example_brands')} AS example_brands FROM raw_dim_ad_category""",
        "raw_dim_ad_category",
    ),
)
def e2(t: Tables) -> DataFrame:
    return clean.dim_ad_category(a.raw_dim_ad_category(t))


@entry(
    "e3_fact_print_sales",
    with_ctes(
        f"""WITH cleaned AS (
              SELECT {_trim('"edition_ID"')} AS edition_id, {_trim('"City_ID"')} AS city_id,
                     {sql_title(_trim('"Language"'))} AS language, {_state('"State"')} AS state,
                     "Month" || '-01' AS month, {_ints('"Net_Circulation"')} AS copies_sold,
                     {_ints('"Copies Sold"')} AS copies_printed,
                     {_ints('copies_returned')} AS copies_returned,
                     {_ints('"Net_Circulation"')} AS net_circulation, {', '.join(a.PRINT_ORDER)}
              FROM raw_print_sales)
            SELECT edition_id, city_id, language, state, month, copies_sold, copies_printed,
                   copies_returned, net_circulation
            FROM (SELECT *, row_number() OVER (
                         PARTITION BY edition_id, city_id, language, state, month
                         ORDER BY {', '.join(a.PRINT_ORDER)}) AS nth FROM cleaned)
            WHERE nth = 1""",
        "raw_print_sales",
    ),
)
def e3(t: Tables) -> DataFrame:
    cleaned = clean.fact_print_sales(a.raw_print_sales(t), a.PRINT_ORDER)
    return cleaned.drop(*a.PRINT_ORDER)


@entry("e4_fact_ad_revenue", _E4)
def e4(t: Tables) -> DataFrame:
    raw = a.raw_ad_revenue(t)
    return clean.fact_ad_revenue(raw, ["o_orderkey"], [F.floor(F.col("o_orderkey") / 4096)])


@entry(
    "e5_fact_city_readiness",
    with_ctes(
        """SELECT city_id, quarter, literacy_rate, smartphone_penetration, internet_penetration
           FROM readiness""",
        "readiness",
    ),
)
def e5(t: Tables) -> DataFrame:
    return clean.fact_city_readiness(a.raw_readiness(t))


@entry(
    "e6_fact_digital_pilot",
    with_ctes(
        """SELECT platform, launch_month, ad_category_id, dev_cost::DOUBLE AS dev_cost,
                  marketing_cost::DOUBLE AS marketing_cost, users_reached::BIGINT AS users_reached,
                  downloads_or_accesses::BIGINT AS downloads_or_accesses, avg_bounce_rate,
                  'works for ' || city_id || ',' || chr(10) || 'mostly'
                      AS cumulative_feedback_from_customers, city_id
           FROM pilot""",
        "pilot",
    ),
)
def e6(t: Tables) -> DataFrame:
    return clean.fact_digital_pilot(a.raw_pilot(t))
