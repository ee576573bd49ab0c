"""Change over time: drops, year-over-year, steady decline, two-period deltas."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.arithmetic import mean_of_sums, percent_change, yes_no
from ledgerline.operators.ordered import lag_in_order


def change_from_previous(
    df: DataFrame, entity: Sequence[str], period: str, values: Sequence[str]
) -> DataFrame:
    """Add ``prev_<value>`` from the entity's previous period.

    For input that is already one row per entity and period: a window then
    holds no more rows than there are periods.
    """
    w = Window.partitionBy(*entity).orderBy(period)
    return df.withColumns({f"prev_{v}": F.lag(v).over(w) for v in values})


def largest_drops(
    df: DataFrame,
    entity: Sequence[str],
    order: Sequence[str],
    value: str,
    k: int = 3,
    tie_break: Sequence[str] | None = None,
) -> DataFrame:
    """The ``k`` largest falls of ``value`` from one row to the next of an entity.

    Works on detail rows: ``order`` must order an entity's rows completely, and
    an entity may have any number of them.
    """
    lagged = lag_in_order(df, entity, order, [value])
    drop = F.col(f"prev_{value}") - F.col(value)
    ties = [F.col(c) for c in (tie_break or [*entity, *order])]
    return (
        lagged.where(F.col(f"prev_{value}").isNotNull() & (F.col(value) < F.col(f"prev_{value}")))
        .withColumn("drop", drop)
        .orderBy(F.desc("drop"), *ties)
        .limit(k)
    )


def yearly_change(totals: DataFrame, year: str, measures: Mapping[str, str]) -> DataFrame:
    """Add percentage changes over one row per year; ``measures``: column -> new name.

    The window has no partition, so it runs in one task, on one row per year.
    """
    w = Window.orderBy(year)
    return totals.select(
        "*", *[percent_change(F.col(c), F.lag(c).over(w)).alias(n) for c, n in measures.items()]
    )


def steady_decline(
    df: DataFrame,
    entity: Sequence[str],
    period: str,
    measures: Mapping[str, str],
    both: str,
    transitions: int = 5,
) -> DataFrame:
    """Flag entities whose measures fell in exactly ``transitions`` steps.

    ``measures``: column -> flag name; ``both`` is the flag for all of them.
    Input is one row per entity and period. The flags come from a second window
    over the same partitions, so the rows are shuffled once for everything.
    """
    steps = Window.partitionBy(*entity).orderBy(period)
    whole = Window.partitionBy(*entity)
    fell = df.withColumns(
        {f"_{c}": F.when(F.col(c) < F.lag(c).over(steps), 1).otherwise(0) for c in measures}
    )
    flagged = fell.withColumns(
        {n: yes_no(F.sum(f"_{c}").over(whole) == transitions) for c, n in measures.items()}
    )
    all_fell = None
    for n in measures.values():
        fell_always = F.col(n) == "Yes"
        all_fell = fell_always if all_fell is None else all_fell & fell_always
    return flagged.withColumn(both, yes_no(all_fell)).drop(*[f"_{c}" for c in measures])


def two_period_means(
    df: DataFrame,
    keys: Sequence[str],
    period: str,
    total: Column,
    count: Column,
    first: object,
    second: object,
) -> DataFrame:
    """Means of two periods side by side, in one pass instead of a self-join.

    Takes sums and counts, so detail rows and partial sums both work. Keys that
    lack one of the periods are left out, as in an inner self-join.
    """
    at = lambda p, c: F.when(F.col(period) == p, c)
    mean = lambda p: mean_of_sums(F.sum(at(p, total)), F.sum(at(p, count)))
    return (
        df.where(F.col(period).isin(first, second))
        .groupBy(*keys)
        .agg(
            mean(first).alias("first_mean"),
            mean(second).alias("second_mean"),
            F.bool_or(F.col(period) == first).alias("_first"),
            F.bool_or(F.col(period) == second).alias("_second"),
        )
        .where("_first and _second")
        .drop("_first", "_second")
    )


def date_dimension(df: DataFrame, column: str) -> DataFrame:
    """One row per day of all calendar years between the first and last date."""
    bounds = df.agg(F.min(column).alias("lo"), F.max(column).alias("hi")).select(
        F.make_date(F.year("lo"), F.lit(1), F.lit(1)).alias("lo"),
        F.make_date(F.year("hi"), F.lit(12), F.lit(31)).alias("hi"),
    )
    days = bounds.where(F.col("lo").isNotNull()).select(
        F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("date")
    )
    return days.select(
        "date",
        F.year("date").alias("year"),
        F.quarter("date").alias("quarter"),
        F.month("date").alias("month"),
    )
