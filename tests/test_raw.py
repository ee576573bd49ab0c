"""Reading messy CSV: records over several lines in many ranges, lines that do not fit."""

from __future__ import annotations

import csv
import random

import pytest
from pyspark.sql import functions as F

from ledgerline.sources import records
from ledgerline.sources.raw import ORDINAL, read_csv, read_csv_rejects


@pytest.fixture
def small_ranges(spark):
    """Ranges of a few bytes, so that most records are divided."""
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)

    def use(size):
        spark.conf.set(key, str(size))

    yield use
    spark.conf.set(key, before)


def _one_task(spark, path, columns):
    schema = ", ".join(f"`{c}` STRING" for c in columns)
    return spark.read.schema(schema).csv(path, header=True, multiLine=True, quote='"', escape='"', mode="FAILFAST")


def _text(draw):
    alphabet = ["a", "b", " ", ",", '"', "\n", "\r\n", "\n\n", "ü", "", '""', '",', ',"\n']
    return "".join(draw.choices(alphabet, k=draw.randint(0, 12)))


@pytest.mark.parametrize("size, rows", [(7, 6), (60, 25), (1000, 60)])
def test_records_of_many_ranges_are_those_of_one_task(spark, tmp_path, small_ranges, size, rows):
    draw = random.Random(size)
    folder = tmp_path / "csv"
    folder.mkdir()
    expected = []
    for name in "abc":
        with open(folder / f"{name}.csv", "w", newline="", encoding="utf-8") as f:
            out = csv.writer(f, lineterminator=draw.choice(["\n", "\r\n"]))
            out.writerow(["id", "long\nheader" if name == "b" else "text", "end"])
            for i in range(rows):
                row = [f"{name}{i}", _text(draw), _text(draw)]
                if draw.random() < 0.1:
                    row[1] = "x" * 90 + "\n" * draw.randint(0, 30) + "y"
                out.writerow(row)
                expected.append(row)
    small_ranges(size)
    df = read_csv(spark, str(folder), ["id", "text", "end"], multi_line=True, missing=(), ordinal=True)
    got = {r.id: (r.text, r.end) for r in df.collect()}
    assert got == {i: (a or None, b or None) for i, a, b in expected}
    # which drops some carriage returns within fields and leaves some at the ends of lines
    plain = lambda t: (t or "").replace("\r", "") or None
    one = _one_task(spark, str(folder), ["id", "text", "end"]).collect()
    assert {i: (plain(a), plain(b)) for i, (a, b) in got.items()} == {r.id: (plain(r.text), plain(r.end)) for r in one}
    # file order survives
    assert [r.id for r in df.orderBy(*ORDINAL).select("id").collect()] == [i for i, *_ in expected]


def test_a_large_file_is_many_tasks(spark, tmp_path, small_ranges):
    path = tmp_path / "t.csv"
    path.write_text("x,y\n" + "".join(f'{i},"a\n{i}"\n' for i in range(2000)), encoding="utf-8")
    small_ranges(4096)
    df = read_csv(spark, str(path), ["x", "y"], multi_line=True)
    assert df.rdd.getNumPartitions() >= 4
    assert df.count() == 2000 and df.where("y <> concat('a\n', x)").isEmpty()


def test_stray_quotes_do_not_open_fields(spark, tmp_path, small_ranges):
    path = tmp_path / "t.csv"
    lines = ['5" pipe,"say ""hi""', 'and more"', 'a"b"c,d', '"x"y,z', '"open,', ',"" closed",""']
    path.write_text("x,y\n" + "\n".join(lines) + "\n", encoding="utf-8")
    expected = [tuple(r) for r in _one_task(spark, str(path), ["x", "y"]).collect()]
    for size in (3, 11, 1000):
        small_ranges(size)
        df = read_csv(spark, str(path), ["x", "y"], multi_line=True, missing=(), ordinal=True)
        assert [tuple(r) for r in df.orderBy(*ORDINAL).select("x", "y").collect()] == expected


def test_states_of_ranges_are_put_together(spark):
    draw = random.Random(1)
    rows, expected = [], set()
    for file in "abc":
        inside = False
        for split in range(60):
            outside, within = draw.choice([(False, True), (True, False), (False, False), (True, True)])
            if inside:
                expected.add((file, split))
            rows.append((file, split, outside, within))
            inside = within if inside else outside
    draw.shuffle(rows)
    df = spark.createDataFrame(rows, "_file string, _split long, from_outside boolean, from_inside boolean")
    assert {tuple(r) for r in records.begins_inside(df).collect()} == expected


@pytest.mark.parametrize("multi_line", [False, True])
def test_every_line_is_kept_once(spark, tmp_path, multi_line):
    path = tmp_path / "t.csv"
    lines = {
        "1,x,y": 3, "2,x": 2, "3": 1, '4,"a,b",c': 3, "5,x,y,SURPLUS,MORE": 5, '6,"a, ""b""",c,"d,e"': 4, ",,,": 4, "7,,": 3,
    }
    path.write_text("a,b,c\n" + "".join(f"{t}\n" for t in lines), encoding="utf-8")
    columns = ["a", "b", "c"]
    good = read_csv(spark, str(path), columns, multi_line=multi_line, strict=False)
    assert sorted(tuple(r) for r in good.collect()) == [
        ("1", "x", "y"), ("2", "x", None), ("3", None, None), ("4", "a,b", "c"), ("7", None, None),
    ]
    # also where a query asks for some of the columns, or none
    assert good.select("a").count() == good.count() == 5 and sorted(r.a for r in good.select("a").collect()) == list("12347")
    bad = read_csv_rejects(spark, str(path), columns, multi_line=multi_line)
    assert {r.text: r.fields for r in bad.collect()} == {t: n for t, n in lines.items() if n > 3}
    assert bad.count() + good.count() == len(lines)
    assert bad.where(F.col("_file").endswith("t.csv") & F.col("_row").isNotNull()).count() == 3
    with pytest.raises(Exception, match="(?i)malformed"):
        read_csv(spark, str(path), columns, multi_line=multi_line).select("a").collect()


def test_a_quote_that_is_never_closed(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('a,b\n1,x\n2,"open\n3,y\n', encoding="utf-8")
    bad = read_csv_rejects(spark, str(path), ["a", "b"], multi_line=True).collect()
    good = read_csv(spark, str(path), ["a", "b"], multi_line=True, strict=False).collect()
    assert {r.a for r in good} | {r.text[0] for r in bad} == {"1", "2"} and len(good) + len(bad) == 2
