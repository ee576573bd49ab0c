"""Quality rules with the violations that the test tables and renderings hold."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.catalog import analogue as a
from ledgerline.catalog.analogue import with_ctes
from ledgerline.catalog.base import Tables, entry
from ledgerline.operators import quality as q


@entry(
    "d1_unique",
    """SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, count(*)::BIGINT AS copies
       FROM lineitem GROUP BY ALL HAVING count(*) > 1""",
)
def d1(t: Tables) -> DataFrame:
    return q.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


def _counts(rules: Sequence[tuple[str, str]], table: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS rule, count(*)::BIGINT AS violations FROM {table} WHERE {bad}"
        for name, bad in rules
    )


@entry(
    "d2_not_null",
    with_ctes(
        _counts(
            [(f"{c} not null", f"{c} IS NULL") for c in ("ad_revenue", "currency", "comments")],
            "raw_ad_revenue",
        ),
        "raw_ad_revenue",
    ),
)
def d2(t: Tables) -> DataFrame:
    return q.count_violations(
        a.raw_ad_revenue(t), q.not_null("ad_revenue", "currency", "comments")
    )


@entry("d3_domain", _counts([("o_orderstatus in domain", "o_orderstatus NOT IN ('F', 'O')")], "orders"))
def d3(t: Tables) -> DataFrame:
    return q.count_violations(t.orders, [q.one_of("o_orderstatus", ["F", "O"])])


@entry(
    "d4_range",
    _counts(
        [
            ("l_quantity in [5, 45]", "l_quantity NOT BETWEEN 5 AND 45"),
            ("l_discount in [0, 0.05]", "l_discount NOT BETWEEN 0 AND 0.05"),
        ],
        "lineitem",
    ),
)
def d4(t: Tables) -> DataFrame:
    return q.count_violations(
        t.lineitem, [q.in_range("l_quantity", 5, 45), q.in_range("l_discount", 0, 0.05)]
    )


@entry("d5_not_negative", _counts([("c_acctbal >= 0", "c_acctbal < 0")], "customer"))
def d5(t: Tables) -> DataFrame:
    return q.count_violations(t.customer, q.not_negative("c_acctbal"))


@entry(
    "d6_cross_column",
    _counts([("tax at most discount", "l_tax > l_discount")], "lineitem"),
)
def d6(t: Tables) -> DataFrame:
    rule = q.holds("tax at most discount", F.col("l_tax") <= F.col("l_discount"))
    return q.count_violations(t.lineitem, [rule])


@entry(
    "d7_foreign_key",
    """SELECT 'o_custkey references parent' AS rule, count(*)::BIGINT AS violations FROM orders
       WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 1000)""",
)
def d7(t: Tables) -> DataFrame:
    parent = t.customer.where("c_acctbal > 1000")
    return q.count_violations(t.orders, [q.references(["o_custkey"], parent, ["c_custkey"])])


@entry("d8_max_length", _counts([("p_name length <= 10", "length(p_name) > 10")], "part"))
def d8(t: Tables) -> DataFrame:
    return q.count_violations(t.part, [q.max_length("p_name", 10)])


_RULE_SQL = """
    SELECT l.*, array_to_string(list_filter([
             CASE WHEN c.n > 1 THEN 'l_orderkey, l_linenumber unique' END,
             CASE WHEN l_quantity < 5 THEN 'l_quantity at least 5' END,
             CASE WHEN p.p_partkey IS NULL THEN 'l_partkey references parent' END],
             lambda x: x IS NOT NULL), ' | ') AS broken
    FROM lineitem l
    JOIN (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2) c
         USING (l_orderkey, l_linenumber)
    LEFT JOIN (SELECT p_partkey FROM part WHERE p_size > 10) p ON l_partkey = p_partkey"""


def _split(t: Tables) -> tuple[DataFrame, DataFrame]:
    rules = [
        q.unique("l_orderkey", "l_linenumber"),
        q.holds("l_quantity at least 5", F.col("l_quantity") >= 5),
        q.references(["l_partkey"], t.part.where("p_size > 10"), ["p_partkey"]),
    ]
    return q.split(t.lineitem, rules)


@entry(
    "d9_rows_kept",
    f"""SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey
        FROM ({_RULE_SQL}) WHERE broken = ''""",
)
def rows_kept(t: Tables) -> DataFrame:
    return _split(t)[0].select("l_orderkey", "l_linenumber", "l_partkey")


@entry(
    "d9_rows_quarantined",
    f"""SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey, broken
        FROM ({_RULE_SQL}) WHERE broken <> ''""",
)
def rows_quarantined(t: Tables) -> DataFrame:
    return _split(t)[1].select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.array_join("violations", " | ").alias("broken"),
    )
