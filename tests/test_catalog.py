"""Every catalog entry against its SQL, and the shape of the plans."""

from __future__ import annotations

import os
import re

import oracle
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from ledgerline.catalog.registry import ENTRIES

FOLDER = os.environ.get("CATALOG_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = oracle.connect(FOLDER)
    yield con
    con.close()


# Too few rows in the smallest tables for the thresholds of these.
MAY_BE_EMPTY: set[str] = set()


@pytest.mark.parametrize("key", list(ENTRIES))
def test_same_result_as_sql(spark, duck, key):
    df = ENTRIES[key](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|Python|Pandas", plan)
    if ENTRIES[key].sql is not None:
        found = oracle.differences(df, duck, ENTRIES[key].sql)
        assert not found or (found == "no rows" and key in MAY_BE_EMPTY)


def test_entry_points(spark):
    assert set(oracle_sql()) <= set(queries()) >= set(ENTRIES)
    assert entry(spark).count() > 0


def _plan(spark, key):
    df = ENTRIES[key](spark, FOLDER)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "key, column",
    [
        ("br3_print_efficiency_leaderboard", "l_shipdate"),
        ("q2_top_cities", "l_shipdate"),
        ("c2_chart_category_share", "o_orderdate"),
        ("r2_year_filter", "o_orderdate"),
    ],
)
def test_year_filter_reaches_the_scan(spark, key, column):
    pushed = re.findall(r"PushedFilters: \[([^\]]*)\]", _plan(spark, key))
    assert any(f"GreaterThanOrEqual({column}" in p and f"LessThan({column}" in p for p in pushed)


def test_scan_reads_only_needed_columns(spark):
    plan = _plan(spark, "q1_circulation_trend")
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    lineitem = next(s for s in schemas if "l_quantity" in s)
    assert {c.split(":")[0] for c in lineitem.split(",")} == {
        "l_suppkey", "l_quantity", "l_returnflag", "l_shipdate",
    }


def test_reports_do_not_carry_comments(spark):
    assert "listagg" not in _plan(spark, "br2_category_concentration")


# Column and whether it descends; NULL counts as the greatest.
ROW_ORDER = {
    "t1_sort": [("year", False), ("amount", True), ("c_nationkey", False)],
    "br2_category_concentration": [("year", False), ("pct_of_year_total", True), ("category_name", False)],
    "br6_readiness_engagement_outlier": [("readiness_rank_desc", False), ("engagement_rank_asc", False), ("city_name", False)],
    "br5_multi_year_decline": [("city_name", False), ("year", False)],
    "q1_circulation_trend": [("year", False)],
    "q3_print_waste": [("city_name", False), ("year", False)],
    "q4_revenue_by_category": [("year", False), ("total_ad_revenue", True), ("category_name", False)],
    "q6_readiness_vs_pilot": [("readiness_score", True), ("engagement_rate", False), ("city_name", False)],
    "q7_revenue_per_copy": [("city_name", False), ("year", False)],
    "q8_relaunch_priorities": [("priority_score", True), ("city_name", False)],
}


@pytest.mark.parametrize("key", ROW_ORDER)
def test_rows_come_in_their_order(spark, key):
    rows = ENTRIES[key](spark, FOLDER).collect()

    def behind(a, b):
        for column, descending in ROW_ORDER[key]:
            x, y = ((r[column] is None, r[column] if r[column] is not None else 0) for r in (a, b))
            if x != y:
                return (x > y) != descending
        return False

    assert len(rows) > 1 and not any(behind(a, b) for a, b in zip(rows, rows[1:]))
