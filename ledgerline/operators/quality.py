"""Declarative data-quality rules: count violations, or split off the bad rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Bits of the filter of keys without a parent, those of one bitmap of Spark.
FILTER_BITS = 32768


@dataclass(frozen=True)
class RowRule:
    """A rule on one row. As in a CHECK constraint, an unknown (NULL) outcome passes."""

    name: str
    violated: Column


@dataclass(frozen=True)
class UniqueRule:
    name: str
    columns: tuple[str, ...]


@dataclass(frozen=True)
class ReferenceRule:
    """Non-NULL ``columns`` must occur as ``target`` in another table."""

    name: str
    columns: tuple[str, ...]
    parent: DataFrame
    target: tuple[str, ...]


Rule = RowRule | UniqueRule | ReferenceRule


def not_null(*columns: str) -> list[RowRule]:
    return [RowRule(f"{c} not null", F.col(c).isNull()) for c in columns]


def one_of(column: str, values: Sequence[str]) -> RowRule:
    return RowRule(f"{column} in domain", ~F.col(column).isin(*values))


def in_range(column: str, low: float, high: float) -> RowRule:
    return RowRule(f"{column} in [{low}, {high}]", ~F.col(column).between(low, high))


def not_negative(*columns: str) -> list[RowRule]:
    return [RowRule(f"{c} >= 0", F.col(c) < 0) for c in columns]


def max_length(column: str, length: int) -> RowRule:
    return RowRule(f"{column} length <= {length}", F.length(F.col(column)) > length)


def holds(name: str, condition: Column) -> RowRule:
    return RowRule(name, ~condition)


def unique(*columns: str) -> UniqueRule:
    return UniqueRule(f"{', '.join(columns)} unique", columns)


def references(
    columns: Sequence[str], parent: DataFrame, target: Sequence[str] | None = None
) -> ReferenceRule:
    return ReferenceRule(
        f"{', '.join(columns)} references parent",
        tuple(columns),
        parent,
        tuple(target or columns),
    )


def duplicate_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def _orphan_keys(df: DataFrame, rule: ReferenceRule) -> DataFrame:
    """Complete keys without a parent row, as k0, k1, ..., and how many rows have them.
    Tasks send each of their keys once, so a frequent key or a valid fact moves little."""
    keys = [F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(rule.columns)]
    known = df.dropna(subset=list(rule.columns)).select(*keys).groupBy(*[f"k{i}" for i in range(len(keys))])
    known = known.agg(F.count(F.lit(1)).alias("rows"))
    on = [known[f"k{i}"] == rule.parent[t] for i, t in enumerate(rule.target)]
    return known.join(rule.parent, on, "left_anti")


def _place(columns: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in columns]), F.lit(FILTER_BITS))


def possible_orphans(df: DataFrame, rule: ReferenceRule) -> DataFrame:
    """The rows whose key shares a hash with a key that has no parent row: all orphans and
    few others. The filter is one value of 4 KB, however many rows and keys there are."""
    names = [f"k{i}" for i in range(len(rule.columns))]
    places = _orphan_keys(df, rule).select(_place(names).alias("place"))
    marks = places.agg(F.bitmap_construct_agg(F.col("place"))).scalar()
    place = _place(rule.columns)
    byte = F.conv(F.hex(F.substring(marks, F.shiftright(place, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return df.dropna(subset=list(rule.columns)).where(F.getbit(byte, (place % 8).cast("int")) == 1)


def orphans(df: DataFrame, rule: ReferenceRule) -> DataFrame:
    """Rows whose complete key has no parent row.

    Keys are held against the parent first, each once per task. Only rows that may have one
    of the keys without a parent are then joined with those keys.
    """
    bad = _orphan_keys(df, rule)
    rows = possible_orphans(df, rule)
    on = [rows[c] == bad[f"k{i}"] for i, c in enumerate(rule.columns)]
    return rows.join(bad, on, "left_semi")


def count_violations(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(rule, violations) for every rule; all row rules share one pass."""
    results = []
    row_rules = [r for r in rules if isinstance(r, RowRule)]
    if row_rules:
        totals = df.agg(
            *[
                F.coalesce(F.sum(F.when(r.violated, 1).otherwise(0)), F.lit(0)).alias(f"r{i}")
                for i, r in enumerate(row_rules)
            ]
        )
        pairs = F.array(
            *[
                F.struct(F.lit(r.name).alias("rule"), F.col(f"r{i}").alias("violations"))
                for i, r in enumerate(row_rules)
            ]
        )
        results.append(totals.select(F.inline(pairs)))
    for rule in rules:
        if isinstance(rule, UniqueRule):
            bad = duplicate_keys(df, rule.columns)
        elif isinstance(rule, ReferenceRule):
            rows = F.coalesce(F.sum("rows"), F.lit(0)).alias("violations")
            results.append(_orphan_keys(df, rule).agg(rows).select(F.lit(rule.name).alias("rule"), "violations"))
            continue
        else:
            continue
        results.append(
            bad.agg(F.count(F.lit(1)).alias("violations")).select(
                F.lit(rule.name).alias("rule"), "violations"
            )
        )
    return reduce(DataFrame.unionByName, results)


def _key(columns: Sequence[str], like: DataFrame, names: Sequence[str]) -> Column:
    """The columns as one struct, typed as ``names`` are in ``like``."""
    kinds = [like.schema[n].dataType for n in names]
    fields = [F.col(f"`{c}`").try_cast(k) for c, k in zip(columns, kinds)]
    return F.struct(*[f.alias(f"k{i}") for i, f in enumerate(fields)])


def mark_violations(df: DataFrame, rules: Sequence[Rule], name: str = "violations") -> DataFrame:
    """Add an array with the names of the rules each row breaks.

    Keys are joined as structs. Fields that are NULL then match each other, and
    the distinct keys are shuffled for the join rather than left as they were
    grouped, which is what lets adaptive execution split a skewed key.
    """
    marked = df
    flags: list[tuple[str, Column]] = []
    helpers: list[str] = []
    for i, rule in enumerate(rules):
        if isinstance(rule, RowRule):
            flags.append((rule.name, rule.violated))
            continue
        flag, key = f"_rule{i}", f"_key{i}"
        helpers.append(flag)
        found = F.col(flag).isNotNull()
        if isinstance(rule, UniqueRule):
            known, columns = duplicate_keys(df, rule.columns), rule.columns
            flags.append((rule.name, found))
        else:
            known, columns = rule.parent.select(*rule.target).distinct(), rule.target
            complete = reduce(Column.__and__, [F.col(c).isNotNull() for c in rule.columns])
            flags.append((rule.name, complete & ~found))
        known = known.select(
            _key(columns, df, rule.columns).alias(key), F.lit(True).alias(flag)
        )
        own = _key(rule.columns, df, rule.columns)
        marked = marked.join(known, own == F.col(key), "left").drop(key)
    broken = F.array_compact(F.array(*[F.when(bad, F.lit(rule)) for rule, bad in flags]))
    return marked.withColumn(name, broken).drop(*helpers)


def split(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """(rows that keep every rule, rows that do not with the rules they break)."""
    marked = mark_violations(df, rules)
    good = marked.where(F.size("violations") == 0).drop("violations")
    return good, marked.where(F.size("violations") > 0)
