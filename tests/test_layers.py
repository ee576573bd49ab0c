"""Versions of the layers: whole or not at all, loads that go on, merges that leave files alone."""

from __future__ import annotations

import os
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerline import schemas
from ledgerline.operators.consolidate import add_increment, keep_stored
from ledgerline.plans import job
from ledgerline.sources import layers as module
from ledgerline.sources.layers import Conflict, Layers

TYPED = "id BIGINT, k INT, v STRING"


@pytest.fixture
def store(spark, tmp_path):
    return Layers(spark, str(tmp_path / "layers"))


def _df(spark, rows, ddl="k INT, v STRING"):
    return spark.createDataFrame(rows, ddl)


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def _files(folder):
    return {os.path.join(d, f) for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet")}


def test_changes_are_seen_together_and_pinned_readers_keep_theirs(spark, store):
    assert store.versions() == [] and store.tables("cleaned") == []
    with pytest.raises(ValueError, match="no table"):
        store.read("cleaned", "a")
    with store.change() as change:
        change.replace(_df(spark, [(1, "x")]), "cleaned", "a")
        change.rebuild("cleaned", {"b": StructType.fromDDL(TYPED)})
        assert _rows(change.read("cleaned", "a")) == [(1, "x")]
        assert store.versions() == []
    first = store.pinned()
    assert store.versions() == [1] and store.tables("cleaned") == ["a", "b"]
    assert store.read("cleaned", "b").count() == 0 and store.read("cleaned", "b").columns == ["id", "k", "v"]
    store.replace(_df(spark, [(2, "y")]), "cleaned", "a")
    store.append(_df(spark, [(3, None)]), "cleaned", "a", StructType.fromDDL("k BIGINT, v STRING"))
    assert _rows(store.read("cleaned", "a")) == [(2, "y"), (3, None)] and _rows(first.read("cleaned", "a")) == [(1, "x")]
    with pytest.raises(ValueError, match="pinned"), first.change():
        pass
    store.remove_unused(keep=1)
    assert store.versions() == [3] and _rows(store.read("cleaned", "a")) == [(2, "y"), (3, None)]
    with pytest.raises(ValueError, match="no version 1"):
        first.read("cleaned", "a")


def test_nothing_is_seen_of_a_change_that_fails(spark, store, tmp_path):
    store.replace(_df(spark, [(1, "x")]), "cleaned", "a")
    before = _files(tmp_path)
    with pytest.raises(RuntimeError, match="stop"), store.change() as change:
        change.replace(_df(spark, [(2, "y")]), "cleaned", "a")
        change.scratch(_df(spark, [(2, "y")]), "s")
        raise RuntimeError("stop")
    assert _rows(store.read("cleaned", "a")) == [(1, "x")] and _files(tmp_path) == before


def test_two_changes_at_once_do_not_lose_each_other(spark, store):
    with pytest.raises(Conflict), store.change() as one:
        one.append(_df(spark, [(1, "x")]), "cleaned", "a", StructType.fromDDL("k INT, v STRING"))
        store.append(_df(spark, [(2, "y")]), "cleaned", "a", StructType.fromDDL("k INT, v STRING"))
    assert _rows(store.read("cleaned", "a")) == [(2, "y")]


def test_a_version_that_was_not_written_whole_does_not_count(spark, store, tmp_path):
    store.replace(_df(spark, [(1, "x")]), "cleaned", "a")
    path = tmp_path / "layers" / "_versions" / "000000000002.json"
    path.write_text('{"version": 2, "tables": {"cleaned/a": {"sch')
    assert _rows(store.read("cleaned", "a")) == [(1, "x")]
    with pytest.raises(Conflict, match="remove_unfinished"):
        store.replace(_df(spark, [(2, "y")]), "cleaned", "a")
    store.remove_unfinished()
    store.replace(_df(spark, [(2, "y")]), "cleaned", "a")
    assert _rows(store.read("cleaned", "a")) == [(2, "y")]


def test_job_killed_at_any_step_leaves_the_tables_of_one_version(spark, tmp_path, monkeypatch):
    """Two dimension tables and the raw layer, stopped before each write in turn."""
    exports = tmp_path / "exports"
    exports.mkdir()

    def export(city):
        (exports / "dim_city.csv").write_text(f"city_id,city,state,tier\nC001,{city},Bihar,Tier 1\n", encoding="utf-8")
        (exports / "dim_ad_category.csv").write_text(
            f"ad_category_id,standard_ad_category,category_group,example_brands\nA001,{city},g,b\n", encoding="utf-8")

    paths = {t: str(exports / f"{t}.csv") for t in ("dim_city", "dim_ad_category")}
    store = Layers(spark, str(tmp_path / "layers"))
    export("Patna")
    job.load_cleaned(store, paths)
    export("Ranchi")
    real, left = module.Change._write, 0

    def write(self, *args):
        nonlocal left
        if not left:
            raise KeyboardInterrupt
        left -= 1
        return real(self, *args)

    monkeypatch.setattr(module.Change, "_write", write)
    for steps in range(20):
        left = steps
        try:
            job.load_cleaned(store, paths)
            break
        except KeyboardInterrupt:
            for layer in ("raw", "cleaned"):
                assert [store.read(layer, t).first()[1] for t in paths] == ["Patna"] * 2
    assert steps == 6  # two raw, and for each table what was checked and what is kept
    assert [store.read("cleaned", t).first()[1] for t in paths] == ["Ranchi"] * 2


def test_ids_go_on_and_loads_can_be_repeated(spark, store):
    schema = StructType.fromDDL(TYPED)
    loads = {"monday": [(5, "a"), (1, "b"), (3, "c")], "tuesday": [(2, "d"), (9, "e")], "wednesday": []}
    counted = []
    for name in ("monday", "tuesday", "tuesday", "wednesday", "monday"):
        with store.change() as change:
            counted.append(change.append_numbered(_df(spark, loads[name]), "cleaned", "a", schema, ["k"], load=name))
    assert counted == [3, 2, 2, 0, 3]
    assert _rows(store.read("cleaned", "a")) == [(1, 1, "b"), (2, 3, "c"), (3, 5, "a"), (4, 2, "d"), (5, 9, "e")]
    # a lost load leaves no ids behind, and removed rows do not free theirs
    with pytest.raises(RuntimeError), store.change() as change:
        change.append_numbered(_df(spark, [(7, "f")]), "cleaned", "a", schema, ["k"], load="thursday")
        raise RuntimeError
    store.replace(store.read("cleaned", "a").where("id < 3"), "cleaned", "a")
    with store.change() as change:
        change.append_numbered(_df(spark, [(7, "f")]), "cleaned", "a", schema, ["k"], load="thursday")
    assert [r[0] for r in _rows(store.read("cleaned", "a"))] == [1, 2, 6]


def _day(day, keys):
    return [(k, day * 100 + i, i * 1.5, f"note {day}.{i}" if i % 3 == 0 else None) for i, k in enumerate(keys)]


def test_increments_equal_a_rebuild_and_leave_other_files_alone(spark, store, tmp_path):
    ddl = "k STRING, at INT, amount DECIMAL(10,2), note STRING"
    days = [
        _day(1, ["a", "b", "a", "c", None, "d", "e", "f", None]), _day(2, ["b", "x", "b", "x", None]), _day(3, ["c"]), [],
    ]
    days = [[(k, at, Decimal(str(x)), n) for k, at, x, n in d] for d in days]
    bucket = F.pmod(F.hash("k"), F.lit(16))
    sums = add_increment(["k"], ["amount"], "note", ["at"])
    first = keep_stored(["k"], ["at"])
    empty = _df(spark, [], ddl)
    kept = []
    for name, rows in zip(("one", "two", "three", "none", "two"), [*days, days[1]]):
        before = {p: os.stat(p).st_mtime_ns for p in _files(tmp_path)}
        with store.change() as change:
            new = _df(spark, rows, ddl)
            hit = change.merge(sums(empty, new).select("k", "amount", "note"), "cleaned", "sums", bucket,
                               add_increment(["k"], ["amount"], "note"), load=name)
            change.merge(first(empty, new), "cleaned", "first", bucket, first, load=name)
        # the stored files of buckets that were not hit are still the ones in use
        named = {f.path for f in store.stored("cleaned", "sums").folders}
        kept.append((len(hit), len(named)))
        assert all(os.stat(p).st_mtime_ns == t for p, t in before.items())
        store.remove_unused(keep=1)
    assert kept[0][0] == kept[0][1] > 1 and kept[1][0] < kept[1][1] and kept[2][0] == 1 and kept[3][0] == kept[4][0] == 0
    everything = _df(spark, [r for d in days for r in d], ddl)
    assert _rows_none(store.read("cleaned", "sums")) == _rows_none(sums(empty, everything).select("k", "amount", "note"))
    assert _rows_none(store.read("cleaned", "first")) == _rows_none(first(empty, everything))


def _rows_none(df):
    return Counter(tuple(r) for r in df.collect())


def test_lines_that_do_not_fit_go_to_quarantine(spark, tmp_path):
    path = tmp_path / "dim_city.csv"
    path.write_text(
        "city_id,city,state,tier\nC001,Patna,Bihar,Tier 1\nC002,Gaya,Bihar,Tier 2,SURPLUS,MORE\nC003,Ara,Bihar\n", encoding="utf-8")
    store = Layers(spark, str(tmp_path / "layers"))
    with pytest.raises(Exception, match="(?i)malformed"):
        job.load_raw(store, {"dim_city": str(path)})
    assert store.versions() == []
    assert job.load_raw(store, {"dim_city": str(path)}, strict=False) == {"dim_city": 2}
    assert sorted(r.city_id for r in store.read("raw", "dim_city").collect()) == ["C001", "C003"]
    (line,) = store.read("quarantine", "dim_city_lines").collect()
    assert (line.text, line.fields) == ("C002,Gaya,Bihar,Tier 2,SURPLUS,MORE", 6) and line._file.endswith("dim_city.csv")
    assert set(store.read("raw", "dim_city").columns) > set(schemas.RAW_COLUMNS["dim_city"])
