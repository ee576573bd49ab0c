"""The whole job on small messy exports, written by the test."""

from __future__ import annotations

import csv
import datetime as dt
from decimal import Decimal

import pytest

from ledgerline import schemas
from ledgerline.plans import clean, job
from ledgerline.sources.layers import Layers, export_csv
from ledgerline.sources.raw import ORDINAL, read_csv, read_raw

# Copies printed and net circulation per city, 2023 and 2024.
PRINT_FIGURES = """
Ahmedabad 2024 2896757 2746691
Bhopal    2024 2565086 2418567
Delhi     2024 3478045 3252010
Jaipur    2024 4361397 4128641
Kanpur    2024 3443849 3250179
Lucknow   2024 1866824 1763256
Mumbai    2024 3775800 3569229
Patna     2024 2379688 2252819
Ranchi    2024 2200753 2092062
Varanasi  2024 4357583 4123611
"""
# Five best cities by net circulation / copies printed.
BEST_FIVE = [
    ("Ranchi", 2200753, 2092062, 0.9506, 1),
    ("Ahmedabad", 2896757, 2746691, 0.9482, 2),
    ("Patna", 2379688, 2252819, 0.9467, 3),
    ("Jaipur", 4361397, 4128641, 0.9466, 4),
    ("Varanasi", 4357583, 4123611, 0.9463, 5),
]
# Efficiency, share of all circulation, band.
SHARES = {
    "Jaipur": (94.66, 13.95, "Profitable"),
    "Ranchi": (95.06, 7.07, "Highly Profitable"),
    "Lucknow": (94.45, 5.96, "Profitable"),
}


def write(folder, table, rows, header=None):
    with open(folder / f"{table}.csv", "w", newline="", encoding="utf-8") as f:
        out = csv.writer(f)
        out.writerow(header or schemas.RAW_COLUMNS[table])
        out.writerows(rows)


@pytest.fixture
def raw_dir(tmp_path):
    folder = tmp_path / "exports"
    folder.mkdir()
    figures = [line.split() for line in PRINT_FIGURES.split("\n") if line]
    ids = {city: f"C{i:03d}" for i, (city, *_) in enumerate(figures, 1)}
    write(folder, "dim_city", [[ids[c], f" {c.upper()}", "UTTAR-PRADESH", "Tier 1 "] for c in ids])
    write(folder, "dim_ad_category", [["A001", " Government ", "Public", ""], ["A002", "FMCG", "B", "x"]])
    prints = []
    for city, year, printed, net in figures:
        row = [f"ED1{ids[city][1:]}", ids[city], "hindi", "Uttar-Pradesh", f"{year}-01"]
        prints.append([*row, f"₹{printed}", str(int(printed) - int(net)), net])
        # the same key once more, spelled differently: the first row counts
        prints.append([f" {row[0]}", row[1], "HINDI", "uttar pradesh", f"{year}-01-01", "9", "0", "9"])
    write(folder, "fact_print_sales", prints)
    write(
        folder,
        "fact_ad_revenue",
        [
            ["ED1001", "A001", "2024-Q1", "3709860", "INR", ""],
            ["ED1001", "A001", "Q1-2024", "₹100.5", "IN RUPEES", "second"],
            ["ED1001 ", "A001", "2024-Q1", "10", "usd ", "nan"],
            ["ED1001", "A001", "2024-Q1", "10", "EUR", "fourth"],
            ["ED1002", "A002", "4th Qtr 2024", "7", "INR", "None"],
        ],
    )
    write(
        folder,
        "fact_city_readiness",
        [[i, c, q, "80.5", "70", rate] for i, (c, q, rate) in enumerate(
            [("C001", "2021-Q1", "50"), ("C001", "Q4-2021", "52.25"), ("C002", "2021-Q1", "40%")]
        )],
        header=["", *schemas.RAW_COLUMNS["fact_city_readiness"][1:]],
    )
    write(
        folder,
        "fact_digital_pilot",
        [
            [0, "Push", "2021-01", "A001", "₹10", "5", "200", "50", "52.55",
             'Slow, "very" slow.\nPeople left.', "C001"],
            [1, "Push", "2021-02", "A002", "1e3", "", "100", "10", "", "", "C002"],
        ],
        header=["", *schemas.RAW_COLUMNS["fact_digital_pilot"][1:]],
    )
    return folder


def test_all_layers(spark, raw_dir, tmp_path):
    root = str(tmp_path / "layers")
    counts = job.run(spark, str(raw_dir), root, export_dir=str(tmp_path / "out"))
    layers = Layers(spark, root)
    assert counts["raw"]["fact_print_sales"] == 20
    assert counts["cleaned"] == {
        "dim_city": 10, "dim_ad_category": 2, "fact_ad_revenue": 2, "fact_city_readiness": 3,
        "fact_digital_pilot": 2, "fact_print_sales": 10,
    }
    for table in schemas.TABLES:
        assert layers.read("cleaned", table).schema == schemas.cleaned_schema(table)

    cities = layers.read("cleaned", "dim_city").collect()
    assert {r.state for r in cities} == {"Uttar Pradesh"} and {r.tier for r in cities} == {"Tier 1"}
    assert {r.city for r in cities} >= {"Ahmedabad", "Varanasi"}

    revenue = layers.read("cleaned", "fact_ad_revenue").orderBy("id").collect()
    assert tuple(revenue[0]) == (
        1, "ED1001", "C001", "A001", "2024-Q1", Decimal("3709980.5000"), "INR",
        Decimal("3711610.5000"), "second; fourth",
    )
    assert tuple(revenue[1])[1:] == (
        "ED1002", "C002", "A002", "2024-Q4", Decimal(7), "INR", Decimal(7), None,
    )

    pilot = layers.read("cleaned", "fact_digital_pilot").orderBy("id").collect()
    assert pilot[0].cumulative_feedback_from_customers == 'Slow, "very" slow.\nPeople left.'
    assert pilot[0].avg_bounce_rate == Decimal("0.5255")
    assert (pilot[1].dev_cost, pilot[1].marketing_cost) == (Decimal(1000), Decimal(0))
    assert pilot[1].cumulative_feedback_from_customers is None

    best = layers.read("analytics", "business_request_3").collect()
    assert sorted(map(tuple, best), key=lambda r: r[4]) == BEST_FIVE
    shares = {r.city_name: tuple(r)[4:] for r in layers.read("analytics", "primary_analysis_q2").collect()}
    assert {c: shares[c] for c in SHARES} == SHARES
    growth = layers.read("analytics", "business_request_4").collect()
    assert [tuple(r) for r in growth] == [("Ahmedabad", 50.0, 52.25, 2.25)]

    again = read_csv(
        spark, str(tmp_path / "out" / "fact_digital_pilot"),
        schemas.cleaned_schema("fact_digital_pilot").names, multi_line=True,
    )
    assert again.where("id = 1").first().cumulative_feedback_from_customers == (
        pilot[0].cumulative_feedback_from_customers
    )

    # Loading again replaces everything and adds nothing.
    paths = {t: f"{raw_dir}/{t}.csv" for t in schemas.TABLES}
    assert job.load_raw(layers, paths) == counts["raw"]
    assert {t: layers.read("raw", t).count() for t in paths} == counts["raw"]


def test_bad_rows_stop_the_job_or_go_to_quarantine(spark, raw_dir, tmp_path):
    with open(raw_dir / "fact_city_readiness.csv", "a", encoding="utf-8") as f:
        f.write("3,C001,2021-Q2,180,70,50\n4,C999,2021-Q2,80,70,50\n5,,2021-Q2,80,70,50\n")
    paths = {t: f"{raw_dir}/{t}.csv" for t in schemas.TABLES}
    layers = Layers(spark, str(tmp_path / "strict"))
    with pytest.raises(job.RuleViolation, match="fact_city_readiness: 3 rows"):
        job.load_cleaned(layers, paths)
    # nothing was put in place, and nothing is left behind
    assert not (tmp_path / "strict" / "cleaned").exists()
    assert not list((tmp_path / "strict" / "_staging").glob("*"))
    layers = Layers(spark, str(tmp_path / "lenient"))
    counts = job.load_cleaned(layers, paths, on_violation="quarantine")
    assert counts["fact_city_readiness"] == 3
    rejected = layers.read("quarantine", "fact_city_readiness").collect()
    assert {r.city_id: tuple(r.violations) for r in rejected} == {
        "C001": ("literacy_rate in [0, 100]",),
        "C999": ("city_id references parent",),
        None: ("city_id not null",),
    }
    with pytest.raises(ValueError):
        job.load_cleaned(layers, paths, on_violation="ignore")


def test_tables_can_be_queried_by_layer_name(spark, raw_dir, tmp_path):
    layers = Layers(spark, str(tmp_path / "sql"))
    job.load_cleaned(layers, {t: f"{raw_dir}/{t}.csv" for t in schemas.TABLES})
    layers.register("cleaned", schemas.TABLES)
    total = spark.sql(
        "SELECT sum(p.net_circulation) AS n FROM cleaned.fact_print_sales p "
        "JOIN cleaned.dim_city c ON p.city_id = c.city_id"
    ).first()
    assert total.n == sum(int(line.split()[3]) for line in PRINT_FIGURES.split("\n") if line)


def test_raw_reader_keeps_text_and_file_order(spark, tmp_path):
    folder = tmp_path / "parts"
    folder.mkdir()
    for part in ("b", "a"):
        with open(folder / f"{part}.csv", "w", encoding="utf-8") as f:
            f.write("x,y\n" + "".join(f"00{i},{part}\n" for i in range(3)) + "NA,\n")
    df = read_csv(spark, str(folder), ["id", "part"], ordinal=True)
    rows = df.orderBy(*ORDINAL).collect()
    assert [(r.id, r.part) for r in rows] == [
        ("000", "a"), ("001", "a"), ("002", "a"), (None, None),
        ("000", "b"), ("001", "b"), ("002", "b"), (None, None),
    ]


def test_parquet_export_is_read_by_position_in_row_order(spark, raw_dir, tmp_path):
    csv_path = f"{raw_dir}/fact_print_sales.csv"
    folder = str(tmp_path / "fact_print_sales.parquet")
    raw = read_raw(spark, csv_path, "fact_print_sales")
    letters = raw.drop(*ORDINAL).coalesce(1).toDF(*"abcdefgh")
    letters.withColumn("f", letters.f).write.parquet(folder)
    from_parquet = read_raw(spark, folder, "fact_print_sales")
    assert from_parquet.columns == raw.columns
    found = clean.fact_print_sales(from_parquet).drop(*ORDINAL).collect()
    assert sorted(found) == sorted(clean.fact_print_sales(raw).drop(*ORDINAL).collect())
    with pytest.raises(ValueError, match="8 columns, expected 4"):
        read_raw(spark, folder, "dim_city")


def test_row_with_too_many_fields_is_an_error(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("x,y\n1,2\n1,2,3\n", encoding="utf-8")
    with pytest.raises(Exception, match="Malformed"):
        read_csv(spark, str(path), ["x", "y"]).collect()


def test_embedded_line_breaks_do_not_make_rows(spark, raw_dir):
    raw = read_raw(spark, f"{raw_dir}/fact_digital_pilot.csv", "fact_digital_pilot")
    assert raw.count() == 2


def test_csv_keeps_quotes_blanks_and_line_breaks(spark, tmp_path):
    values = ['say "hi"', " padded ", "two\nlines", "a,b", "", None, 'end"', "back\\slash"]
    df = spark.createDataFrame([(str(i), v) for i, v in enumerate(values)], "i STRING, v STRING")
    folder = str(tmp_path / "csv")
    assert export_csv(df, folder) == len(values)
    back = read_csv(spark, folder, ["i", "v"], multi_line=True, missing=())
    # An empty field is a missing one, quoted or not.
    assert [r.v for r in back.orderBy("i").collect()] == [v or None for v in values]


def test_first_spelling_of_a_duplicate_print_row_is_kept(spark, raw_dir):
    raw = read_raw(spark, f"{raw_dir}/fact_print_sales.csv", "fact_print_sales")
    rows = clean.fact_print_sales(raw).collect()
    assert len(rows) == 10 and all(r.copies_printed > 9 for r in rows)
    assert {(r.language, r.state, r.month) for r in rows} == {
        ("Hindi", "Uttar Pradesh", dt.date(2024, 1, 1))
    }
