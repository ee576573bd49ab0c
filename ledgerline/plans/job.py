"""The batch job: raw exports -> raw layer -> cleaned layer -> analytics layer."""

from __future__ import annotations

import argparse
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerline import schemas
from ledgerline.operators import quality as q
from ledgerline.operators.ordered import number_rows
from ledgerline.plans import clean, reports
from ledgerline.plans.star import StoredStar
from ledgerline.session import build_session
from ledgerline.sources.layers import Change, Layers, export_csv
from ledgerline.sources.raw import ORDINAL, ORDINAL_FIELDS, read_raw, read_raw_rejects, without_missing

VIOLATIONS = "violations"


class RuleViolation(RuntimeError):
    """A cleaned table broke its rules and the job was told to stop on that."""


@contextmanager
def _change(layers: Layers | Change) -> Iterator[Change]:
    """The change that is under way, or one of its own."""
    if isinstance(layers, Change):
        yield layers
    else:
        with layers.change() as change:
            yield change


def load_raw(layers: Layers | Change, paths: Mapping[str, str], strict: bool = True) -> dict[str, int]:
    """Copy the raw exports into the raw layer, all columns as the texts they are, and
    where each row stood. Lines that do not fit the columns are an error if ``strict``, else
    they go to the table ``<table>_lines`` of the quarantine layer, whole."""
    counts = {}
    with _change(layers) as change:
        for table, path in paths.items():
            spark = change.layers.spark
            schema = StructType([*schemas.raw_schema(table), *ORDINAL_FIELDS])
            change.rebuild("raw", {table: schema})
            rows = read_raw(spark, path, table, missing=(), strict=strict)
            counts[table] = change.append(rows, "raw", table, schema)
            rejects = None if strict else read_raw_rejects(spark, path, table)
            if rejects is not None:
                change.replace(rejects, "quarantine", f"{table}_lines")
    return counts


def _cleaned(raw: DataFrame, table: str) -> tuple[DataFrame, tuple[str, ...]]:
    """The cleaned rows and the order that their ids and files follow.

    The period comes first, so that files hold neighbouring periods and a
    report on one year skips the others by their statistics.
    """
    if table == "fact_print_sales":
        return clean.fact_print_sales(raw), ("month", *ORDINAL)
    if table == "fact_ad_revenue":
        return clean.fact_ad_revenue(raw), ("quarter", *clean.REVENUE_KEYS[:3])
    if table == "fact_city_readiness":
        return clean.fact_city_readiness(raw, ORDINAL), ("quarter", *ORDINAL)
    if table == "fact_digital_pilot":
        return clean.fact_digital_pilot(raw, ORDINAL), ("launch_month", *ORDINAL)
    return clean.CLEANERS[table](raw), ()


def _rules(change: Change, table: str) -> list[q.Rule]:
    if table == "dim_city":
        return clean.dim_city_rules()
    if table == "dim_ad_category":
        return clean.dim_ad_category_rules()
    cities = change.read("cleaned", "dim_city")
    if table == "fact_print_sales":
        return clean.fact_print_sales_rules(cities)
    if table == "fact_city_readiness":
        return clean.fact_city_readiness_rules(cities)
    categories = change.read("cleaned", "dim_ad_category")
    if table == "fact_ad_revenue":
        return clean.fact_ad_revenue_rules(cities, categories)
    return clean.fact_digital_pilot_rules(cities, categories)


def _cuts(order: tuple[str, ...]) -> list[Column]:
    """The period, then the file split or the first key in it."""
    inner = ORDINAL[:2] if order[-1] == ORDINAL[-1] else order[1:2]
    return [F.col(order[0]), F.struct(*inner)]


def load_cleaned(
    layers: Layers | Change, paths: Mapping[str, str], on_violation: str = "fail"
) -> dict[str, int]:
    """Clean, check and store every table; dimensions come first.

    Exports that this change has not brought into the raw layer yet are loaded first; the
    cleaners read that layer. With ``on_violation="quarantine"`` rows that break a rule go
    to the ``quarantine`` layer with the names of the rules, and lines that do not fit go
    there as they are; ``fail`` stops instead and leaves the tables of the last run.
    """
    if on_violation not in ("fail", "quarantine"):
        raise ValueError(f"on_violation must be fail or quarantine, not {on_violation!r}")
    tables = [t for t in schemas.TABLES if t in paths]
    counts = {}
    with _change(layers) as change:
        missing = {t: paths[t] for t in tables if not change.has_written("raw", t)}
        load_raw(change, missing, strict=on_violation == "fail")
        for table in tables:
            rows, order = _cleaned(without_missing(change.read("raw", table)), table)
            marked = q.mark_violations(rows, _rules(change, table), VIOLATIONS)
            # Ids are given to all rows, so rejected ones leave a gap, as in a sequence.
            numbered = number_rows(marked, order, cuts=_cuts(order)) if order else marked
            # Parsed, merged, checked and written once; what follows reads that.
            checked = change.scratch(numbered, table)
            bad = checked.where(F.size(VIOLATIONS) > 0).drop("id", *ORDINAL)
            if on_violation == "fail":
                rejected = bad.count()
                if rejected:
                    change.layers.replace(bad, "quarantine", table)
                    raise RuleViolation(f"{table}: {rejected} rows break rules")
            else:
                change.replace(bad, "quarantine", table)
            good = checked.where(F.size(VIOLATIONS) == 0)
            if order:
                good = good.repartitionByRange(*order).sortWithinPartitions(*order)
            schema = schemas.cleaned_schema(table)
            change.rebuild("cleaned", {table: schema})
            counts[table] = change.append(good, "cleaned", table, schema)
    return counts


def load_analytics(layers: Layers | Change) -> dict[str, int]:
    """Run all reports on the cleaned layer and store each as a table."""
    counts = {}
    with _change(layers) as change:
        star = StoredStar.from_layer(change)
        for name, report in reports.REPORTS.items():
            counts[name] = change.replace(report(star), "analytics", name)
        charts = {
            "city_category_concentration": reports.city_category_concentration(star),
            "chart_circulation": reports.chart_circulation(star),
            "chart_category_share": reports.chart_category_share(star),
            "chart_roi": reports.chart_roi(star),
            "chart_priorities": reports.chart_priorities(
                change.read("analytics", "primary_analysis_q8")
            ),
        }
        for name, table in charts.items():
            counts[name] = change.replace(table, "analytics", name)
    return counts


def run(
    spark: SparkSession,
    raw_dir: str,
    root: str,
    on_violation: str = "fail",
    export_dir: str | None = None,
    paths: Mapping[str, str] | None = None,
) -> dict[str, dict[str, int]]:
    """Build all layers and return the row counts.

    A table is read from ``raw_dir/<table>.csv`` (a file or a folder of files)
    unless ``paths`` names another place, which may be Parquet. All layers become visible
    together as one version; a job that is lost leaves the version before.
    """
    layers = Layers(spark, root)
    base = raw_dir.rstrip("/")
    paths = {t: f"{base}/{t}.csv" for t in schemas.TABLES} | dict(paths or {})
    with layers.change() as change:
        counts = {
            "raw": load_raw(change, paths, strict=on_violation == "fail"),
            "cleaned": load_cleaned(change, paths, on_violation),
            "analytics": load_analytics(change),
        }
    if export_dir:
        for table in schemas.TABLES:
            export_csv(layers.read("cleaned", table), f"{export_dir.rstrip('/')}/{table}")
    return counts


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--raw", required=True, help="folder with <table>.csv exports")
    parser.add_argument("--out", required=True, help="folder for the table layers")
    parser.add_argument("--on-violation", choices=["fail", "quarantine"], default="fail")
    parser.add_argument("--export", help="folder for CSV copies of the cleaned tables")
    args = parser.parse_args()
    counts = run(build_session(), args.raw, args.out, args.on_violation, args.export)
    for layer, tables in counts.items():
        for table, rows in tables.items():
            print(f"{layer}.{table}: {rows} rows")


if __name__ == "__main__":
    main()
