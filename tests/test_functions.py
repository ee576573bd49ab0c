from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerline.functions import arithmetic as ar
from ledgerline.functions import money, numbers, periods, text


def apply(spark, values, build, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i INT, x {kind}")
    rows = df.select("i", build(F.col("x")).alias("y")).orderBy("i").collect()
    return [r.y for r in rows]


def test_strip_takes_all_unicode_white_space(spark):
    values = [" a ", "\ta\n", " a ", "a b", "", None]
    assert apply(spark, values, text.strip) == ["a", "a", "a", "a b", "", None]


@pytest.mark.parametrize(
    "value",
    [
        "uttar-pradesh", "MADHYA_PRADESH", "they're here", "a1b c\td", "new  delhi",
        "éCOLE ñandú", "", "x", "o'neil-smith/jones", "दिल्लीa b",
    ],
)
def test_title_case_equals_python(spark, value):
    assert apply(spark, [value], text.title_case) == [value.title()]


def test_state_names(spark):
    values = ["Uttar-Pradesh", "Uttar pradesh", "UTTAR PRADESH ", "Madhya_Pradesh", "gujarat", None]
    assert apply(spark, values, text.state_name) == [
        "Uttar Pradesh", "Uttar Pradesh", "Uttar Pradesh", "Madhya Pradesh", "Gujarat", None,
    ]


def test_remap_without_mapping_is_identity(spark):
    assert apply(spark, ["a", None], lambda c: text.remap(c, {})) == ["a", None]


def test_blank_to_null_is_exact(spark):
    values = ["nan", "", "None", "NAN", "none", "ok", None]
    assert apply(spark, values, text.blank_to_null) == [None, None, None, "NAN", "none", "ok", None]


def test_key_from_code(spark):
    values = ["ED1005", "ED1010", "ED1", "ED100234", None]
    assert apply(spark, values, text.key_from_code) == ["C005", "C010", "ED1", "C00234", None]


def test_clean_int(spark):
    values = ["₹216680", "2,16,680", None, "abc", "-5", "12.5", "", "  42 ", "१२३", "007"]
    assert apply(spark, values, numbers.clean_int) == [
        216680, 216680, 0, 0, -5, 125, 0, 42, 123, 7,
    ]


def test_clean_int_of_malformed_text(spark):
    values = ["-", "1-2", "5-"]
    null = apply(spark, values, lambda c: numbers.clean_int(c, on_bad="null"))
    zero = apply(spark, values, lambda c: numbers.clean_int(c, on_bad="zero"))
    assert null == [None] * 3 and zero == [0] * 3
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        apply(spark, ["1-2"], numbers.clean_int)
    with pytest.raises(ValueError):
        numbers.clean_int(F.col("x"), on_bad="ignore")


def test_clean_int_of_number_literals(spark):
    values = ["12.9", "1e3", " 12.5 ", "-0.5", "₹12.5", "1e40", "9" * 25]
    plain = lambda c: numbers.clean_int(c, on_bad="null", plain_numbers=True)
    assert apply(spark, values, plain) == [12, 1000, 12, 0, 125, None, None]


def test_int_from_number(spark):
    values = [12.9, -12.9, None, float("nan"), 3.0]
    assert apply(spark, values, numbers.int_from_number, "double") == [12, -12, 0, 0, 3]


def test_clean_float(spark):
    values = ["22613.69", "₹1,234.5", None, "1.2.3", "-", ".5", "5.", "-.5", "12-", "1e3", "x"]
    assert apply(spark, values, numbers.clean_float) == [
        22613.69, 1234.5, 0.0, 0.0, 0.0, 0.5, 5.0, -0.5, 0.0, 13.0, 0.0,
    ]
    typed = lambda c: numbers.clean_float(c, plain_numbers=True)
    assert apply(spark, ["1e3", "₹1e3"], typed) == [1000.0, 13.0]


def test_clean_decimal_is_exact_and_never_zero_for_too_wide(spark):
    values = ["0.1", "₹1,234.56785", None, "n/a", "1" * 20, "99999999999999.9999"]
    assert apply(spark, values, numbers.clean_decimal) == [
        Decimal("0.1000"), Decimal("1234.5679"), Decimal(0), Decimal(0), None,
        Decimal("99999999999999.9999"),
    ]


def test_parse_grouped(spark):
    assert apply(spark, [" 1,234.5 ", "7", None], numbers.parse_grouped) == [1234.5, 7.0, None]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        apply(spark, ["₹7"], numbers.parse_grouped)


def test_normalize_quarter(spark):
    values = ["2023-Q2", "Q1-2019", "4th Qtr 2020", "3rd Qtr 2020", " Q4-2021 ", "Q5-2021", "x", None]
    assert apply(spark, values, periods.normalize_quarter) == [
        "2023-Q2", "2019-Q1", "2020-Q4", "3rd Qtr 2020", "2021-Q4", "Q5-2021", "x", None,
    ]


def test_years(spark):
    values = ["Q1-2019", "4th Qtr 2020", "3rd Qtr 2021", "2022", "20223", "in a year", None]
    assert apply(spark, values, periods.find_year) == [2019, 2020, 2021, 2022, None, None, None]
    assert apply(spark, ["2023-Q2", "Q1-2019", None], periods.quarter_year) == [2023, None, None]


def test_parse_month(spark):
    day = dt.date(2023, 5, 1)
    values = ["2023-05", "2023-05-01", "2023-05-01 00:00:00", "2023/05", "May-2023", "May 2023"]
    assert apply(spark, values, periods.parse_month) == [day] * 6
    assert apply(spark, ["soon", None, "2023"], periods.parse_month) == [None] * 3


def test_in_year_is_half_open(spark):
    days = [dt.date(2023, 12, 31), dt.date(2024, 1, 1), dt.date(2024, 12, 31), dt.date(2025, 1, 1)]
    found = apply(spark, days, lambda c: periods.in_year(c, 2024), "date")
    assert found == [False, True, True, False]


def test_currencies(spark):
    values = ["usd ", "EUR", "In Rupees", "XYZ", None]
    inr = apply(spark, values, lambda c: money.to_base_currency(F.lit(10), c))
    assert inr == [800, 850, 10, 10, 10]
    assert apply(spark, values, money.currency_code) == ["USD", "EUR", "INR", "XYZ", None]


def test_rounding_is_half_away_from_zero_on_the_exact_quotient(spark):
    df = spark.createDataFrame(
        [(1005, 1000), (-1005, 1000), (1, 8), (2, 3), (5, 0), (None, 3)], "a BIGINT, b BIGINT"
    )
    a, b = F.col("a"), F.col("b")
    rows = df.select(
        ar.ratio(a, b, 2).alias("r"),
        ar.percent(a, b).alias("p"),
        ar.rounded(ar.divide_or(a, b), 3).alias("d"),
    ).collect()
    assert [r.r for r in rows] == [1.01, -1.01, 0.13, 0.67, None, None]
    assert [r.p for r in rows] == [100.5, -100.5, 12.5, 66.67, None, None]
    assert [r.d for r in rows] == [1.005, -1.005, 0.125, 0.667, 0.0, 0.0]


def test_band_takes_the_first_cut_reached(spark):
    cuts = {"high": "0.95", "middle": "0.90"}
    values = [Decimal("0.95"), Decimal("0.9499"), Decimal("0.9"), Decimal("0.1"), None]
    found = apply(spark, values, lambda c: ar.band(c, cuts, "rest"), "decimal(9,4)")
    assert found == ["high", "middle", "middle", "rest", "rest"]


def test_row_mean_and_weighted_score(spark):
    df = spark.createDataFrame([(Decimal("1.1"), Decimal("2.2"), Decimal("4.0"))], "a decimal(9,4), b decimal(9,4), c decimal(9,4)")
    row = df.select(
        ar.rounded(ar.row_mean(F.col("a"), F.col("b"), F.col("c")), 6).alias("mean"),
        ar.rounded(ar.weighted_score([(F.col("a"), "0.4"), (F.col("c"), "0.6")]), 4).alias("score"),
    ).first()
    assert row.mean == 2.433333 and row.score == 2.84


def test_large_and_fine_numbers_are_not_bent(spark):
    rows = [(2e5, 1.0, 0.00002, 0.00006, 2e8, 1e13, 4e13)]
    df = spark.createDataFrame(rows, "users_in DOUBLE, users DOUBLE, a DOUBLE, b DOUBLE, big DOUBLE, x DOUBLE, y DOUBLE")
    row = df.select(
        ar.ratio(F.col("a"), F.col("b"), 4).alias("fine"),
        ar.ratio(F.col("x"), F.col("y"), 4).alias("large"),
        ar.rounded(ar.row_mean(F.col("big"), F.col("big")), 2).alias("mean"),
        ar.percent(F.col("users_in"), F.col("users")).alias("pct"),
        ar.percent_change(F.col("b"), F.col("a")).alias("change"),
    ).first()
    assert tuple(row) == (0.3333, 0.25, 2e8, 2e7, 200.0)
    means = df.select(ar.rounded(ar.mean(F.col("big")), 2).alias("m"), ar.rounded(ar.mean(F.col("a")), 6).alias("f")).first()
    assert tuple(means) == (2e8, 0.00002)


def test_numbers_of_unlike_size_and_scale_are_divided(spark):
    """No NULL that the data did not have, and no number rounded to 0."""
    cases = [  # a, its type, b, its type, quotient to 6 decimals
        ("1000000000000.00004", "decimal(18,5)", "0.00003", "decimal(5,5)", "33333333333333334.666667"),
        ("10000000000000000000000000", "decimal(38,0)", "100000000000000000000", "decimal(38,0)", "100000"),
        ("1", "decimal(38,0)", "0.0000000000000000000001", "decimal(38,38)", "10000000000000000000000"),
        ("0.0000000000000000000003", "decimal(38,30)", "0.0000000000000000000002", "decimal(38,30)", "1.5"),
        ("1234567890123456789012345.789", "decimal(38,3)", "3", "int", "411522630041152263004115.263"),
        ("9223372036854775807", "bigint", "0.5", "decimal(2,1)", "18446744073709551614"),
        ("2", "tinyint", "3", "smallint", "0.666667"),
        ("-7", "decimal(38,10)", "2", "decimal(38,10)", "-3.5"),
        ("0", "decimal(38,38)", "4", "decimal(38,0)", "0"),
        ("5", "int", "0", "decimal(38,20)", None),
    ]
    for a, kind_a, b, kind_b, expected in cases:
        x, y = F.lit(a).cast(kind_a), F.lit(b).cast(kind_b)
        df = spark.range(1).select(x.alias("x"), y.alias("y"))
        quotient = F.round(ar.divide_or_null(F.col("x"), F.col("y")), 6)
        assert df.select(quotient).first()[0] == (None if expected is None else Decimal(expected)), (a, b)
        if expected is not None and abs(Decimal(expected)) < 10**20:
            percent = df.select(ar.percent(F.col("x"), F.col("y"), 4)).first()[0]
            assert percent == pytest.approx(float(Decimal(a) / Decimal(b)) * 100, abs=6e-5, rel=1e-12)
    huge = spark.range(1).select(F.lit("10000000000000000000000000").cast("decimal(38,0)").alias("x"), F.lit(4).alias("n"))
    assert huge.select(ar.mean_of_sums(F.col("x"), F.col("n")).alias("m")).first().m == Decimal(10**25) / 4 == Decimal("2.5e24")


def test_quotients_beyond_any_type_are_an_error(spark):
    df = spark.range(1).select(F.lit("1e37").cast("decimal(38,0)").alias("x"), F.lit("1e-30").cast("decimal(38,38)").alias("y"))
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE|out of range|cannot be represented"):
        df.select(ar.divide_or_null(F.col("x"), F.col("y"))).collect()


def test_mean_over_a_join_of_large_values_and_counts(spark):
    from ledgerline.operators.crossfact import fan_out_mean
    from ledgerline.operators.share import above_share

    left = spark.createDataFrame([("k", "g"), ("k", "g"), ("m", "g")], "key STRING, grp STRING")
    right = spark.createDataFrame([("k", 2e6), ("k", 4e6), ("m", 1.5), ("m", None)], "key STRING, v DOUBLE")
    found = fan_out_mean(left, right, "key", ["grp"], F.col("v"), "mean").first()
    assert abs(float(found["mean"]) - (2 * 6e6 + 1.5) / 5) < 1e-3
    shares = spark.createDataFrame([(1, 3), (2, 5)], "a INT, t INT").where(above_share("a", "t", 1 / 3)).collect()
    assert [tuple(r) for r in shares] == [(2, 5)]
