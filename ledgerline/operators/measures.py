"""Named measures that can be computed under any grouping of the star schema."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.arithmetic import divide_or, mean_of_sums, row_mean
from ledgerline.functions.periods import quarter_text, quarter_year

PRINT, ADS, READY, PILOT = "print_sales", "ad_revenue", "readiness", "pilot"


@dataclass(frozen=True)
class Measure:
    """``parts``: sums over one fact each; ``result`` combines them by name.

    Keeping to sums makes every measure mergeable: it can be computed per
    dimension key first and rolled up after the join.
    """

    parts: Mapping[str, tuple[str, Column]]
    result: Column


def _sum(fact: str, column: str) -> Measure:
    part = f"sum_{column}"
    return Measure({part: (fact, F.col(column))}, F.col(part))


def _mean(fact: str, name: str, value: Column) -> Measure:
    total, count = f"total_{name}", f"count_{name}"
    return Measure(
        {total: (fact, value), count: (fact, F.when(value.isNotNull(), 1))},
        mean_of_sums(F.col(total), F.col(count)),
    )


def _quotient(a: tuple[str, str], b: tuple[str, str]) -> Measure:
    (fact_a, col_a), (fact_b, col_b) = a, b
    parts = {f"sum_{col_a}": (fact_a, F.col(col_a)), f"sum_{col_b}": (fact_b, F.col(col_b))}
    return Measure(parts, divide_or(F.col(f"sum_{col_a}"), F.col(f"sum_{col_b}")))


def _mean_of(fact: str, column: str) -> Measure:
    return _mean(fact, column, F.col(column))


def _readiness() -> Measure:
    rates = ("literacy_rate", "smartphone_penetration", "internet_penetration")
    return _mean(READY, "readiness", row_mean(*[F.col(c) for c in rates]))


# Columns need a running session, so a measure is made when it is asked for.
MEASURES: dict[str, Callable[[], Measure]] = {
    "total_copies_printed": lambda: _sum(PRINT, "copies_printed"),
    "total_copies_sold": lambda: _sum(PRINT, "copies_sold"),
    "total_copies_returned": lambda: _sum(PRINT, "copies_returned"),
    "total_net_circulation": lambda: _sum(PRINT, "net_circulation"),
    "print_return_waste_rate": lambda: _quotient(
        (PRINT, "copies_returned"), (PRINT, "copies_printed")
    ),
    "print_efficiency": lambda: _quotient((PRINT, "net_circulation"), (PRINT, "copies_printed")),
    "total_ad_revenue": lambda: _sum(ADS, "ad_revenue_in_inr"),
    "ad_revenue_per_circulated_copy": lambda: _quotient(
        (ADS, "ad_revenue_in_inr"), (PRINT, "net_circulation")
    ),
    "avg_smartphone_penetration": lambda: _mean_of(READY, "smartphone_penetration"),
    "avg_internet_penetration": lambda: _mean_of(READY, "internet_penetration"),
    "composite_digital_readiness": _readiness,
    "total_dev_cost": lambda: _sum(PILOT, "dev_cost"),
    "total_marketing_cost": lambda: _sum(PILOT, "marketing_cost"),
    "total_downloads": lambda: _sum(PILOT, "downloads_or_accesses"),
    "digital_pilot_engagement_rate": lambda: _quotient(
        (PILOT, "downloads_or_accesses"), (PILOT, "users_reached")
    ),
    "avg_bounce_rate": lambda: _mean_of(PILOT, "avg_bounce_rate"),
}

_CITY_COLUMNS = ("city_id", "city", "state", "tier")
_CATEGORY_COLUMNS = ("ad_category_id", "standard_ad_category", "category_group")


def _own_groupings(fact: str) -> dict[str, Column]:
    """Grouping columns that a fact has itself, without a dimension."""
    if fact == PRINT:
        return {
            "year": F.year("month"),
            "quarter": quarter_text(F.col("month")),
            "month": F.col("month"),
            "language": F.col("language"),
            "edition_id": F.col("edition_id"),
        }
    if fact == PILOT:
        return {
            "year": quarter_year(F.col("launch_month")),
            "launch_month": F.col("launch_month"),
            "platform": F.col("platform"),
        }
    return {"year": quarter_year(F.col("quarter")), "quarter": F.col("quarter")}


def evaluate(
    star,
    names: Sequence[str],
    by: Sequence[str] = (),
    registry: Mapping[str, Callable[[], Measure]] = MEASURES,
) -> DataFrame:
    """One row per combination of ``by`` with the named measures as columns.

    ``star`` has the facts and dimensions as attributes. Each fact is scanned
    and shuffled once, whatever the number of measures. Facts are put under one
    another and added up, so a combination found in one fact only is kept.
    """
    measures = {n: registry[n]() for n in names}
    parts: dict[str, tuple[str, Column]] = {}
    for m in measures.values():
        parts.update(m.parts)
    per_fact = [
        _fact_sums(star, fact, by, {p: c for p, (f, c) in parts.items() if f == fact})
        for fact in dict.fromkeys(f for f, _ in parts.values())
    ]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), per_fact)
    combined = stacked.groupBy(*by).agg(*[F.sum(p).alias(p) for p in parts])
    return combined.select(*by, *[m.result.alias(n) for n, m in measures.items()])


Groupings = Mapping[str, tuple[Sequence[str], Sequence[str]]]


def evaluate_groupings(
    star, groupings: Groupings, registry: Mapping[str, Callable[[], Measure]] = MEASURES
) -> DataFrame:
    """Several groupings at once: name -> (columns to group by, measures).

    One row per group: ``grouped_by`` (the name), all columns (NULL where a grouping lacks
    them) and all measures (NULL where it does not ask for them), each as :func:`evaluate`
    has it. Each fact is scanned once and summed by all columns that are asked of it; the
    groupings are made of these sums, which are put under one another once per grouping.
    """
    asked = {m for _, names in groupings.values() for m in names}
    measures = {m: registry[m]() for m in sorted(asked)}
    facts = dict.fromkeys(f for m in measures.values() for f, _ in m.parts.values())
    stacked = reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True),
        [_fact_groupings(star, fact, groupings, measures) for fact in facts],
    )
    columns = list(dict.fromkeys(c for by, _ in groupings.values() for c in by))
    parts = [p for p in stacked.columns if p != "grouped_by" and p not in columns]
    combined = stacked.groupBy("grouped_by", *columns).agg(*[F.sum(p).alias(p) for p in parts])

    def shown(name: str) -> Column:
        where = [g for g, (_, names) in groupings.items() if name in names]
        return F.when(F.col("grouped_by").isin(*where), measures[name].result).alias(name)

    return combined.select("grouped_by", *columns, *[shown(m) for m in measures])


def _fact_groupings(
    star, fact: str, groupings: Groupings, measures: Mapping[str, Measure]
) -> DataFrame:
    """grouped_by, columns and sums of the groupings that ask for something of the fact."""
    parts = {p: c for m in measures.values() for p, (f, c) in m.parts.items() if f == fact}
    own = _own_groupings(fact)
    wanted = {
        g: list(by) for g, (by, names) in groupings.items()
        if any(f == fact for n in names for f, _ in measures[n].parts.values())
    }
    keys: dict[str, Column] = {}
    dims: dict[str, tuple[DataFrame, list[str]]] = {}
    needs: dict[str, list[str]] = {g: [] for g in wanted}
    for g, by in wanted.items():
        for b in by:
            if b in own:
                keys[b] = own[b]
                continue
            if b in _CITY_COLUMNS:
                key, dim = "city_id", star.dim_city
            elif b in _CATEGORY_COLUMNS and fact in (ADS, PILOT):
                key, dim = "ad_category_id", star.dim_ad_category
            else:
                raise ValueError(f"{fact} cannot be grouped by {b}")
            keys[key] = F.col(key)
            if b != key:
                found = dims.setdefault(key, (dim, []))[1]
                if b not in found:
                    found.append(b)
                needs[g].append(key)
    rows = getattr(star, fact).select(
        *[c.alias(k) for k, c in keys.items()], *[c.alias(p) for p, c in parts.items()]
    )
    sums = rows.groupBy(*keys).agg(*[F.sum(p).alias(p) for p in parts])
    for key, (dim, columns) in dims.items():
        # a grouping by a dimension leaves out what the dimension lacks, others do not
        sums = sums.join(dim.select(key, *columns, F.lit(True).alias(f"_in_{key}")), key, "left")
    columns = list(dict.fromkeys(b for by in wanted.values() for b in by))

    def one(g: str) -> Column:
        known = reduce(lambda a, b: a & b, [F.col(f"_in_{k}").isNotNull() for k in needs[g]], F.lit(True))
        values = [
            (F.col(c) if c in wanted[g] else F.lit(None).cast(sums.schema[c].dataType)).alias(c) for c in columns
        ]
        return F.when(known, F.struct(F.lit(g).alias("grouped_by"), *values))

    each = F.explode(F.array_compact(F.array(*[one(g) for g in wanted]))).alias("_g")
    expanded = sums.select(each, *parts).select("_g.*", *parts)
    return expanded.groupBy("grouped_by", *columns).agg(*[F.sum(p).alias(p) for p in parts])


def _fact_sums(star, fact: str, by: Sequence[str], parts: Mapping[str, Column]) -> DataFrame:
    rows: DataFrame = getattr(star, fact)
    own = _own_groupings(fact)
    keys: dict[str, Column] = {}
    dims: dict[str, DataFrame] = {}
    for b in by:
        if b in own:
            keys[b] = own[b]
        elif b in _CITY_COLUMNS:
            keys["city_id"] = F.col("city_id")
            dims["city_id"] = star.dim_city
        elif b in _CATEGORY_COLUMNS and fact in (ADS, PILOT):
            keys["ad_category_id"] = F.col("ad_category_id")
            dims["ad_category_id"] = star.dim_ad_category
        else:
            raise ValueError(f"{fact} cannot be grouped by {b}")
    sums = rows.select(
        *[c.alias(k) for k, c in keys.items()],
        *[c.alias(p) for p, c in parts.items()],
    )
    sums = sums.groupBy(*keys).agg(*[F.sum(p).alias(p) for p in parts])
    for key, dim in dims.items():
        wanted = [b for b in by if b in dim.columns and b not in keys]
        if wanted:
            sums = sums.join(dim.select(key, *wanted), key)
    return sums.groupBy(*by).agg(*[F.sum(p).alias(p) for p in parts])
