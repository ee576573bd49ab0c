"""Operators against plain Python on small data that has one very frequent key."""

from __future__ import annotations

import csv
import datetime as dt
import hashlib
import io
import random
import re
from collections import defaultdict
from decimal import Decimal
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import consolidate as co
from ledgerline.operators import crossfact, measures, ordered, period, profile, rank, reshape, share
from ledgerline.operators import quality as q
from ledgerline.sources.layers import export_csv_in_order, part_hashes


@pytest.fixture(scope="module")
def skewed():
    """(entity, day, seq, value): a third of the rows belong to one entity."""
    rnd = random.Random(7)
    rows = []
    for seq in range(3000):
        entity = "hot" if seq % 3 == 0 else f"e{rnd.randrange(40)}"
        rows.append((entity, rnd.randrange(50), seq, rnd.choice([None, rnd.randrange(1000)])))
    rnd.shuffle(rows)
    return rows


SCHEMA = "entity STRING, day INT, seq INT, value INT"


def expected_lag(rows):
    before, result = {}, {}
    for entity, day, seq, value in sorted(rows, key=lambda r: (r[1], r[2])):
        result[seq] = before.get(entity)
        before[entity] = value
    return result


def test_lag_crosses_ranges(many_ranges, skewed):
    df = many_ranges.createDataFrame(skewed, SCHEMA).repartition(6)
    lagged = ordered.lag_in_order(df, ["entity"], ["day", "seq"], ["value"])
    assert lagged.columns == ["entity", "day", "seq", "value", "prev_value"]
    found = {r.seq: r.prev_value for r in lagged.collect()}
    assert found == expected_lag(skewed)


def test_order_of_a_frequent_entity_is_cut(spark, skewed):
    df = spark.createDataFrame(skewed, SCHEMA)
    jobs = spark.sparkContext.statusTracker()
    before = set(jobs.getJobIdsForGroup())
    for cut in (F.lit(0), F.col("day"), F.floor(F.col("day") / 10)):
        lagged = ordered.lag_in_order(df, ["entity"], ["day", "seq"], ["value"], cut=cut)
        numbered = ordered.number_rows(df, ["day", "seq"], cuts=[cut, F.col("day")])
        plan = lagged._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"hashpartitioning\(_run", plan)
        assert set(jobs.getJobIdsForGroup()) == before  # nothing has run yet
        assert {r.seq: r.prev_value for r in lagged.collect()} == expected_lag(skewed)
        in_order = sorted(skewed, key=lambda r: r[1:3])
        assert {r.id: r.seq for r in numbered.collect()} == {i: r[2] for i, r in enumerate(in_order, 1)}
        before = set(jobs.getJobIdsForGroup())


def test_lag_of_null_entity(spark):
    rows = [(None, 1, 1, 10), (None, 2, 2, 20), ("a", 1, 3, 5)]
    df = spark.createDataFrame(rows, SCHEMA)
    lagged = ordered.lag_in_order(df, ["entity"], ["day"], ["value"])
    assert {r.seq: r.prev_value for r in lagged.collect()} == {1: None, 2: 10, 3: None}


def test_number_rows(many_ranges, skewed):
    df = many_ranges.createDataFrame(skewed, SCHEMA)
    numbered = ordered.number_rows(df, ["entity", "day", "seq"]).collect()
    in_order = sorted(skewed, key=lambda r: r[:3])
    assert {r.id: (r.entity, r.seq) for r in numbered} == {
        i: (r[0], r[2]) for i, r in enumerate(in_order, 1)
    }


def test_number_rows_of_nothing(spark):
    assert ordered.number_rows(spark.createDataFrame([], SCHEMA), ["seq"]).count() == 0


def test_largest_drops(many_ranges, skewed):
    df = many_ranges.createDataFrame(skewed, SCHEMA)
    found = period.largest_drops(df, ["entity"], ["day", "seq"], "value", 5).collect()
    lag = expected_lag(skewed)
    drops = sorted(
        (
            (-(lag[s] - v), e, d, s)
            for e, d, s, v in skewed
            if v is not None and lag[s] is not None and v < lag[s]
        )
    )[:5]
    assert [(-r["drop"], r.entity, r.day, r.seq) for r in found] == drops


def test_keep_first(spark, skewed):
    df = spark.createDataFrame(skewed, SCHEMA).repartition(5)
    kept = co.keep_first(df, ["entity", "day"], ["seq"])
    first = {}
    for e, d, s, v in sorted(skewed, key=lambda r: r[2]):
        first.setdefault((e, d), (s, v))
    assert kept.columns == df.columns
    assert {(r.entity, r.day): (r.seq, r.value) for r in kept.collect()} == first


def test_keep_first_limits_rows_before_the_shuffle(spark, skewed):
    df = spark.createDataFrame(skewed, SCHEMA)
    plan = co.keep_first(df, ["entity"], ["seq"])._jdf.queryExecution().executedPlan().toString()
    exchange = plan.index("Exchange")
    assert "WindowGroupLimit" in plan[exchange:] and "Partial" in plan[exchange:]


@pytest.mark.parametrize("chunked", [False, True])
def test_consolidate(spark, skewed, chunked):
    rows = [(e, d % 3, s, v, f" n{s}" if s % 4 == 0 else (" " if s % 4 == 1 else None)) for e, d, s, v in skewed]
    df = spark.createDataFrame(rows, "entity STRING, day INT, seq INT, value INT, note STRING")
    chunk = [F.floor(F.col("seq") / 100)] if chunked else []
    merged = co.consolidate(df, ["entity", "day"], ["value"], "note", ["seq"], chunk)
    sums, notes = defaultdict(list), defaultdict(list)
    for e, d, s, v, n in sorted(rows, key=lambda r: r[2]):
        if v is not None:
            sums[e, d].append(v)
        sums[e, d]
        if n and n.strip():
            notes[e, d].append(n)
    expected = {
        k: (sum(v) if v else None, "; ".join(notes[k]) if k in notes else None)
        for k, v in sums.items()
    }
    assert {(r.entity, r.day): (r.value, r.note) for r in merged.collect()} == expected


def test_consolidate_merges_null_keys(spark):
    rows = [(None, 1, "a", 1), (None, 2, "b", 2), ("k", 4, None, 3)]
    df = spark.createDataFrame(rows, "k STRING, v INT, note STRING, o INT")
    found = co.consolidate(df, ["k"], ["v"], "note", ["o"]).collect()
    assert {tuple(r) for r in found} == {(None, 3, "a; b"), ("k", 4, None)}


def test_consolidate_shuffles_each_side_once(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).selectExpr("id % 3 AS k", "id AS v", "'x' AS note", "id AS o").write.parquet(path)
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        merged = co.consolidate(spark.read.parquet(path), ["k"], ["v"], "note", ["o"])
        plan = merged._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(key, before)
    assert "SortMergeJoin" in plan and plan.count("Exchange") == 2


def test_consolidate_without_reading_notes_scans_once(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).selectExpr("id % 3 AS k", "id AS v", "'x' AS note", "id AS o").write.parquet(path)
    merged = co.consolidate(spark.read.parquet(path), ["k"], ["v"], "note", ["o"])
    plan = merged.select("k", "v")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and plan.count("Relation") == 1


def test_quote_in_separator(spark):
    df = spark.createDataFrame([("k", 1, "a"), ("k", 2, "b")], "k STRING, o INT, note STRING")
    assert co.joined_notes(df, ["k"], "note", ["o"], separator=" '\\ ").first().note == "a '\\ b"


def test_fan_out_mean_equals_the_join(spark):
    rnd = random.Random(3)
    left = [(rnd.choice("abc"), rnd.choice("xy"), rnd.randrange(2)) for _ in range(60)]
    right = [(rnd.choice("abcd"), rnd.choice([None, rnd.randrange(90)])) for _ in range(70)]
    ldf = spark.createDataFrame(left, "k STRING, name STRING, rate INT")
    rdf = spark.createDataFrame(right, "k STRING, v INT")
    found = crossfact.fan_out_mean(ldf, rdf, "k", ["name", "rate"], F.col("v"), "mean").collect()
    pairs = defaultdict(list)
    for k, n, r in left:
        for k2, v in right:
            if k == k2 and v is not None:
                pairs[n, r].append(v)
    assert {(r.name, r.rate): round(float(r.mean), 8) for r in found} == {
        g: round(sum(v) / len(v), 8) for g, v in pairs.items()
    }


def test_sums_by_member_merges_equal_labels(spark):
    fact = spark.createDataFrame([("c1", 1), ("c2", 2), ("c3", 4), ("c9", 8)], "id STRING, v INT")
    dim = spark.createDataFrame([("c1", "A"), ("c2", "A"), ("c3", "B")], "id STRING, label STRING")
    found = crossfact.sums_by_member(fact, dim, "id", "label", {}, {"total": "v"}).collect()
    assert {r.label: r.total for r in found} == {"A": 3, "B": 4}


def test_steady_decline(spark):
    rows = [("falls", y, 10 - y, 20 - y) for y in range(4)] + [("mixed", y, 10 - y, y) for y in range(4)]
    df = spark.createDataFrame(rows, "k STRING, y INT, a INT, b INT")
    found = period.steady_decline(df, ["k"], "y", {"a": "fa", "b": "fb"}, "both", transitions=3)
    assert {(r.k, r.fa, r.fb, r.both) for r in found.collect()} == {
        ("falls", "Yes", "Yes", "Yes"), ("mixed", "Yes", "No", "No"),
    }
    assert found.columns == ["k", "y", "a", "b", "fa", "fb", "both"]


def test_two_period_means_needs_both_periods(spark):
    rows = [("a", 1, 10), ("a", 1, 20), ("a", 2, 7), ("b", 1, 5), ("c", 2, 5), ("d", 3, 1)]
    df = spark.createDataFrame(rows, "k STRING, p INT, v INT")
    found = period.two_period_means(df, ["k"], "p", F.col("v"), F.lit(1), 1, 2).collect()
    assert [(r.k, float(r.first_mean), float(r.second_mean)) for r in found] == [("a", 15.0, 7.0)]


def test_yearly_change(spark):
    df = spark.createDataFrame([(2020, 100), (2021, 95), (2022, 0), (2023, 5)], "year INT, n INT")
    found = period.yearly_change(df, "year", {"n": "pct"}).orderBy("year").collect()
    assert [r.pct for r in found] == [None, -5.0, -100.0, None]


def test_date_dimension_covers_whole_years(spark):
    days = [(dt.date(2023, 11, 30),), (dt.date(2024, 2, 1),), (None,)]
    found = period.date_dimension(spark.createDataFrame(days, "d DATE"), "d")
    assert found.count() == 365 + 366
    row = found.where("date = '2024-02-29'").first()
    assert (row.year, row.quarter, row.month) == (2024, 1, 2)
    assert period.date_dimension(spark.createDataFrame([], "d DATE"), "d").count() == 0


def test_leaderboard_ranks_ties_densely(spark):
    rows = [("a", 5), ("b", 5), ("c", 4), ("d", 4), ("e", 3), ("f", 9)]
    df = spark.createDataFrame(rows, "k STRING, score INT")
    top = rank.leaderboard(df, "score", "place", 4, ["k"]).collect()
    assert sorted((r.place, r.k) for r in top) == [(1, "f"), (2, "a"), (2, "b"), (3, "c")]


def test_share_threshold_is_strict_and_unrounded(spark):
    rows = [("g", "a", 5000), ("g", "b", 5000), ("h", "a", 500001), ("h", "b", 499999)]
    df = spark.createDataFrame(rows, "g STRING, p STRING, v BIGINT")
    found = share.share_of_group(df, ["g"], ["p"], "v", "total", "pct", min_share=0.5).collect()
    assert [(r.g, r.p, r.total, r.pct) for r in found] == [("h", "a", 1000000, 50.0)]


def test_pivot_and_unpivot(spark):
    df = spark.createDataFrame([("k", "x", 1), ("k", "x", 2), ("k", "z", 9)], "k STRING, c STRING, v INT")
    wide = reshape.pivot_sum(df, ["k"], "c", "v", {"x": "ex", "y": "why"})
    assert wide.collect() == [("k", 3, None)]
    long = reshape.unpivot(wide, ["k"], ["ex", "why"], "name", "v").collect()
    assert {(r.name, r.v) for r in long} == {("ex", 3), ("why", None)}


def test_raw_share_counts_rows_without_part_in_the_total(spark):
    rows = [("2020", "a", 1), ("2020", None, 3), (None, "a", 9), ("2021", "a", 2)]
    df = spark.createDataFrame(rows, "y STRING, part STRING, v INT")
    found = profile.raw_share(df, {"year": F.col("y").cast("int")}, "year", "part", "v", "total")
    assert {(r.year, r.part, r.v, r.total, r.pct) for r in found.collect()} == {
        (2020, "a", 1, 4, 25.0), (2021, "a", 2, 2, 100.0),
    }


# --- quality -----------------------------------------------------------------------


@pytest.fixture
def rules_and_rows(spark):
    rows = [(1, "a", 5), (1, "b", 5), (2, None, -1), (3, "toolong", None), (4, "zz", 3), (5, "a", 3)]
    df = spark.createDataFrame(rows, "id INT, k STRING, v INT")
    parent = spark.createDataFrame([("a",), ("a",), ("b",), ("toolong",)], "key STRING")
    rules = [
        q.unique("id"),
        *q.not_null("k"),
        *q.not_negative("v"),
        q.max_length("k", 3),
        q.references(["k"], parent, ["key"]),
        q.holds("v below 5", F.col("v") < 5),
    ]
    return rules, df


def test_count_violations(rules_and_rows):
    rules, df = rules_and_rows
    found = {r.rule: r.violations for r in q.count_violations(df, rules).collect()}
    assert found == {
        "id unique": 1, "k not null": 1, "v >= 0": 1, "k length <= 3": 1,
        "k references parent": 1, "v below 5": 2,
    }


def test_count_violations_of_an_empty_table(spark, rules_and_rows):
    rules, df = rules_and_rows
    found = q.count_violations(df.where("id < 0"), rules).collect()
    assert {r.violations for r in found} == {0} and len(found) == 6


def test_split_keeps_every_row_once(rules_and_rows):
    rules, df = rules_and_rows
    good, bad = q.split(df, rules)
    assert [tuple(r) for r in good.collect()] == [(5, "a", 3)]
    assert good.columns == df.columns
    found = {(r.id, r.k): set(r.violations) for r in bad.collect()}
    assert found == {
        (1, "a"): {"id unique", "v below 5"},
        (1, "b"): {"id unique", "v below 5"},
        (2, None): {"k not null", "v >= 0"},
        (3, "toolong"): {"k length <= 3"},
        (4, "zz"): {"k references parent"},
    }


def test_reference_of_another_type(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "id INT")
    parent = spark.createDataFrame([(1,), (2**40,)], "key BIGINT")
    good, bad = q.split(df, [q.references(["id"], parent, ["key"])])
    assert {r.id for r in good.collect()} == {1, None} and bad.first().id == 2


def test_skewed_key_is_split_in_the_rule_join(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        rows = spark.range(0, 60000, 1, 8).selectExpr(
            "IF(id % 3 = 0, 7, id % 1000) AS key", "md5(cast(id AS STRING)) AS payload"
        )
        parent = spark.range(900).withColumnRenamed("id", "key")
        marked = q.mark_violations(rows, [q.references(["key"], parent)])
        assert sum(len(r.violations) for r in marked.collect()) == 4000
        plan = marked._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert "skew=true" in plan


# --- measures ----------------------------------------------------------------------


@pytest.fixture
def tiny_star(spark):
    city = spark.createDataFrame(
        [("c1", "A", "s", "Tier 1"), ("c2", "B", "s", "Tier 1")],
        "city_id STRING, city STRING, state STRING, tier STRING",
    )
    prints = spark.createDataFrame(
        [
            ("c1", "Hindi", dt.date(2023, 1, 1), 10, 4, 6, 6),
            ("c2", "Hindi", dt.date(2023, 2, 1), 30, 0, 30, 30),
            ("c1", "English", dt.date(2024, 2, 1), 0, 0, 0, 0),
        ],
        "city_id STRING, language STRING, month DATE, copies_printed INT, copies_returned INT, "
        "copies_sold INT, net_circulation INT",
    ).withColumn("edition_id", F.lit("e"))
    ads = spark.createDataFrame(
        [("c1", "a1", "2023-Q1", 72), ("c1", "a1", "2025-Q1", 8)],
        "city_id STRING, ad_category_id STRING, quarter STRING, ad_revenue_in_inr INT",
    )
    return SimpleNamespace(dim_city=city, print_sales=prints, ad_revenue=ads)


def test_measures_of_two_facts_keep_years_of_either(tiny_star):
    names = ["total_ad_revenue", "print_efficiency", "ad_revenue_per_circulated_copy"]
    found = measures.evaluate(tiny_star, names, ["year"]).collect()
    assert {(r.year, r.total_ad_revenue, float(r[2]), float(r[3])) for r in found} == {
        (2023, 72, 0.9, 2.0), (2024, None, 0.0, 0.0), (2025, 8, 0.0, 0.0),
    }


def test_measures_by_dimension_and_fact_column(tiny_star):
    found = measures.evaluate(tiny_star, ["total_copies_printed"], ["tier", "language"]).collect()
    assert {tuple(r) for r in found} == {("Tier 1", "Hindi", 40), ("Tier 1", "English", 0)}
    assert measures.evaluate(tiny_star, ["total_copies_printed"]).collect() == [(40,)]


def test_measure_cannot_be_grouped_by_a_foreign_column(tiny_star):
    with pytest.raises(ValueError, match="print_sales cannot be grouped by platform"):
        measures.evaluate(tiny_star, ["total_copies_sold"], ["platform"])
    found = measures.evaluate(tiny_star, ["total_ad_revenue", "total_net_circulation"], ["quarter"]).collect()
    assert {tuple(r) for r in found} == {("2023-Q1", 72, 36), ("2024-Q1", None, 0), ("2025-Q1", 8, None)}


def test_ranks_over_ranges_of_scores(spark):
    """All scores distinct, a third of the rows on one score, NULLs, both directions."""
    draw = random.Random(7)
    scores = [None, 0.5, *(draw.uniform(-9, 9) for _ in range(300)), *[0.25] * 150]
    df = spark.createDataFrame([(i, s, None if s is None else i % 40) for i, s in enumerate(scores)], "k INT, s DOUBLE, n INT")
    asked = {"down": ("s", True), "up": ("s", False), "few": ("n", True), "many": ("n", False)}
    for ranges, small in ((2, 0), (64, 0), (64, 1 << 16)):
        rows = rank.with_dense_ranks(df, asked, ranges, small).collect()
        assert len(rows) == len(scores)
        for name, (score, descending) in asked.items():
            value = lambda r: float("inf") if r[score] is None else r[score]
            places = {v: i for i, v in enumerate(sorted({value(r) for r in rows}, reverse=descending), 1)}
            assert all(r[name] == places[value(r)] for r in rows), name
    assert rank.with_dense_rank(df.where("k < 0"), "p", "s").collect() == []
    with pytest.raises(ValueError):
        rank.with_dense_ranks(df, asked, 100)


def test_ranks_gather_scores_in_no_value_and_no_task(spark):
    df = spark.range(1000).select("id", (F.col("id") % 997).alias("s"))
    plan = rank.with_dense_ranks(df, {"p": ("s", True)}, in_one_task=999)._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_set" not in plan and "collect_list" not in plan and "array_position" not in plan
    # every window is over a range, or over the rows that ranges have
    partitions = re.findall(r"windowspecdefinition\(([a-z]+)#\d+, ([a-z]+)?", plan)
    assert partitions and all(first == "which" for first, _ in partitions)
    few = rank.with_dense_ranks(df, {"p": ("s", True)}, in_one_task=1000)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in few


def test_fan_out_rows_of_hot_keys(spark):
    left = spark.createDataFrame([("hot" if i % 3 == 0 else f"k{i % 50}", i) for i in range(900)] + [(None, -1)], "key STRING, a INT")
    right = spark.createDataFrame([("hot" if i % 3 == 0 else f"k{i % 50}", i) for i in range(600)] + [(None, -1)], "key STRING, b INT")
    expected = left.join(right, "key")
    for pairs in (4, 100, 1 << 20):
        found = crossfact.fan_out_rows(left, right, "key", pairs)
        assert found.columns == expected.columns
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, expected.collect()))
    # 60,000 pairs of one key: how many share a cell
    lefts, rights = (
        df.groupBy("key", "_line", "_column").count() for df in crossfact.fan_out_cells(left, right, "key", 400)
    )
    both = lefts.withColumnRenamed("count", "n").join(rights, ["key", "_line", "_column"])
    cells = [r["n"] * r["count"] for r in both.collect()]
    assert sum(cells) == expected.count() and max(cells) <= 4 * 400 and len(cells) >= 150


def test_only_possible_orphans_are_moved(spark):
    parent = spark.range(500).select(F.col("id").alias("p"), (F.col("id") % 7).cast("string").alias("q"))
    rule = q.references(["k", "m"], parent, ["p", "q"])
    valid = spark.range(5000).select("id", (F.col("id") % 500).alias("k"), (F.col("id") % 500 % 7).cast("string").alias("m"))
    assert q.possible_orphans(valid, rule).count() == 0 == q.orphans(valid, rule).count()
    assert q.count_violations(valid, [rule]).first().violations == 0
    changed = F.when(F.col("id").isin(3, 17), F.lit("x")).when(F.col("id") == 18, F.lit(None)).otherwise(F.col("m"))
    some = valid.withColumn("m", changed).union(valid.where("id < 2").withColumn("k", F.lit(9999).cast("bigint")))
    assert sorted(r.id for r in q.orphans(some, rule).collect()) == [0, 1, 3, 17]
    assert 4 <= q.possible_orphans(some, rule).count() <= 40
    assert q.count_violations(some, [rule]).first().violations == 4
    # more keys than the filter has bits: everything passes it, and the result is the same
    all_bad = spark.range(70000).select("id", (F.col("id") + 10**6).alias("k"), F.lit("x").alias("m"))
    assert q.orphans(all_bad, rule).count() == 70000


def test_ordered_export_is_one_file_in_parts(spark, tmp_path):
    draw = random.Random(2)
    rows = [(i, draw.choice(['a,"b"', "two\nlines", " x ", "", None, "é"]), draw.random()) for i in range(400)]
    draw.shuffle(rows)
    df = spark.createDataFrame(rows, 'id INT, `te,xt` STRING, v DOUBLE').repartition(5)
    folder = tmp_path / "csv"
    assert export_csv_in_order(df, str(folder), ["id"]) == 400
    parts = sorted(p for p in folder.iterdir() if p.suffix == ".csv")
    assert parts[0].name == "_header.csv"
    whole = io.StringIO()
    out = csv.writer(whole, lineterminator="\n")
    out.writerow(["id", "te,xt", "v"])
    out.writerows(sorted((i, t or "", v) for i, t, v in rows))
    text = b"".join(p.read_bytes() for p in parts).decode()
    # a blank at an edge is quoted by one writer only
    assert list(csv.reader(io.StringIO(text))) == list(csv.reader(io.StringIO(whole.getvalue())))
    hashes = {r.part: (r.bytes, r.sha256) for r in part_hashes(spark, str(folder)).collect()}
    assert hashes == {p.name: (p.stat().st_size, hashlib.sha256(p.read_bytes()).hexdigest()) for p in parts[1:]}


def test_groupings_of_one_scan_equal_those_of_their_own(spark, tmp_path):
    draw = random.Random(3)
    cities, categories = [f"C{i}" for i in range(6)], ["A1", "A2", "A9"]
    ads = [(draw.choice(cities), draw.choice(categories), f"20{draw.randint(19, 21)}-Q{draw.randint(1, 4)}", draw.randint(1, 9)) for _ in range(300)]
    prints = [(draw.choice([*cities, None]), draw.choice(["x", None]), dt.date(draw.randint(2019, 2021), 1, 1), draw.randint(5, 9), 1, 4) for _ in range(300)]
    given = {
        "ad_revenue": (ads, "city_id STRING, ad_category_id STRING, quarter STRING, ad_revenue_in_inr DECIMAL(18,4)"),
        "print_sales": (prints, "city_id STRING, language STRING, month DATE, copies_printed INT, copies_returned INT, net_circulation INT"),
        "dim_city": ([(c, c.lower(), "s", f"t{i % 2}") for i, c in enumerate(cities[:5])], "city_id STRING, city STRING, state STRING, tier STRING"),
        "dim_ad_category": ([("A1", "one", "g"), ("A2", "two", "g")], "ad_category_id STRING, standard_ad_category STRING, category_group STRING"),
    }
    star = SimpleNamespace()
    for name, (rows, ddl) in given.items():
        rows = [(*r[:3], Decimal(r[3])) for r in rows] if name == "ad_revenue" else rows
        spark.createDataFrame(rows, ddl).write.parquet(str(tmp_path / name))
        setattr(star, name, spark.read.parquet(str(tmp_path / name)))
    groupings = {
        "all": ([], ["total_ad_revenue", "total_net_circulation"]),
        "tier": (["tier"], ["total_ad_revenue", "ad_revenue_per_circulated_copy"]),
        "where": (["city", "language"], ["total_copies_printed", "print_efficiency"]),
        "id": (["city_id"], ["total_copies_printed", "total_ad_revenue"]),
        "what": (["year", "category_group", "standard_ad_category"], ["total_ad_revenue"]),
        "when": (["quarter"], ["total_ad_revenue", "total_net_circulation"]),
    }
    together = measures.evaluate_groupings(star, groupings)
    plan = together._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert len(re.findall(r"FileScan parquet|Scan parquet", plan)) <= 5  # two facts, dimensions of each
    for name, (by, names) in groupings.items():
        alone = measures.evaluate(star, names, by)
        found = together.where(F.col("grouped_by") == name).select(*by, *names)
        key = lambda r: [str(x) for x in r]
        assert sorted(map(tuple, found.collect()), key=key) == sorted(map(tuple, alone.collect()), key=key), name
    with pytest.raises(ValueError, match="cannot be grouped"):
        measures.evaluate_groupings(star, {"x": (["ad_category_id"], ["total_net_circulation"])})
