"""The cleaners and reports against tables that were published before, cell by cell and row by row.

GOLDEN_RAW and GOLDEN_CLEANED name folders with <table>.csv before and after cleaning,
GOLDEN_REPORT a text with the fourteen report tables in their order, as | a | b | lines.
"""

from __future__ import annotations

import csv
import datetime as dt
import os
from decimal import Decimal
from types import SimpleNamespace

import pytest

from ledgerline import schemas
from ledgerline.plans import clean, reports
from ledgerline.sources.raw import ORDINAL, read_raw

RAW, CLEANED, REPORT = (os.environ.get(f"GOLDEN_{n}") for n in ("RAW", "CLEANED", "REPORT"))
TABLES = ("fact_ad_revenue", "fact_city_readiness", "fact_digital_pilot")

pytestmark = pytest.mark.skipif(not (RAW and CLEANED and REPORT), reason="no published tables are given")

# The members of the dimensions, by their ids.
CITIES = "Lucknow Delhi Bhopal Patna Jaipur Mumbai Ranchi Kanpur Ahmedabad Varanasi".split()
CATEGORIES = ("Government", "FMCG", "Real Estate", "Automobile")


def _same(found: object, published: str) -> bool:
    """Numbers are published with six digits."""
    if published in ("", "nan", "None"):
        return found is None
    if isinstance(found, (int, float, Decimal)):
        value = float(published)
        return abs(float(found) - value) <= max(1e-9, 1.1e-5 * abs(value))
    if isinstance(found, dt.date):
        return found.isoformat() == published
    return found == published.strip()


@pytest.fixture(scope="module")
def cleaned(spark):
    made = {}
    for table in TABLES:
        raw = read_raw(spark, f"{RAW}/{table}.csv", table)
        rows = clean.fact_ad_revenue(raw) if table == "fact_ad_revenue" else clean.CLEANERS[table](raw)
        rows = rows.drop(*ORDINAL)
        made[table] = spark.createDataFrame(rows.collect(), rows.schema)
    return made


@pytest.mark.parametrize("table", TABLES)
def test_cleaned_rows(cleaned, table):
    with open(f"{CLEANED}/{table}.csv", newline="", encoding="utf-8") as f:
        published = list(csv.DictReader(f))
    columns = [c for c in schemas.cleaned_schema(table).names if c != "id"]
    assert set(columns) == set(published[0])
    rows = cleaned[table].select(*columns).collect()
    keys = {"fact_ad_revenue": clean.REVENUE_KEYS, "fact_city_readiness": ["city_id", "quarter"],
            "fact_digital_pilot": ["city_id", "launch_month", "platform"]}[table]
    order = lambda r: [str(r[k] or "").strip() for k in keys if k in columns]
    assert len(rows) == len(published)
    for found, line in zip(sorted(rows, key=order), sorted(published, key=order)):
        assert all(_same(found[c], line[c]) for c in columns), (found, line)


def _published() -> list[list[dict]]:
    tables, header = [], None
    with open(REPORT, encoding="utf-8") as f:
        for line in f:
            cells = [c.strip() for c in line.strip().strip("|").split("|")]
            if not line.startswith("|"):
                header = None
            elif header is None:
                header = cells
                tables.append([])
            elif not set(line) <= set("|:- \n"):
                tables[-1].append(dict(zip(header, cells)))
    return tables


@pytest.fixture(scope="module")
def star(spark, cleaned):
    ids = {c: f"C{i:03d}" for i, c in enumerate(CITIES, 1)}
    yearly = _published()[8]  # copies printed and net circulation per city and year
    prints = [
        (None, ids[r["city_name"]], None, None, dt.date(int(r["year"]), 1, 1), int(r["total_net_circulation"]),
         int(r["total_copies_printed"]), int(r["print_waste"]), int(r["total_net_circulation"]))
        for r in yearly
    ]
    names = [f for f in schemas.cleaned_schema("fact_print_sales") if f.name != "id"]
    return SimpleNamespace(
        dim_city=spark.createDataFrame([(i, c, None, None) for c, i in ids.items()], schemas.cleaned_schema("dim_city")),
        dim_ad_category=spark.createDataFrame(
            [(f"A{i:03d}", c, None, None) for i, c in enumerate(CATEGORIES, 1)], schemas.cleaned_schema("dim_ad_category")),
        print_sales=spark.createDataFrame(prints, type(schemas.cleaned_schema("dim_city"))(names)),
        ad_revenue=cleaned["fact_ad_revenue"],
        readiness=cleaned["fact_city_readiness"],
        pilot=cleaned["fact_digital_pilot"],
    )


#: The first one needs monthly figures, which are not published.
@pytest.mark.parametrize("number, name", list(enumerate(reports.REPORTS))[1:])
def test_report(star, number, name):
    published = _published()[number]
    found = reports.REPORTS[name](star).collect()
    assert list(found[0].asDict()) == list(published[0]) and len(found) == len(published)
    # also in this order
    for row, line in zip(found, published):
        assert all(_same(row[c], line[c]) for c in line), (row, line)
