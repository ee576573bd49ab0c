"""Row numbers and LAG over a total order, without a single-task window.

A window over a whole table, or over one entity that holds a third of it, runs in one
task. Here the order is cut by an expression that grows with it, such as the day of a
time or a range of a key. Rows are ordered within their cut, and one summary row per cut
(and entity) carries what crosses its borders. Nothing is written and nothing is sampled:
the plan is as lazy, and its result as fixed, as any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CUT = "_cut"


def _keys(order: Sequence[str]) -> list[Column]:
    return [F.col(f"`{c}`").asc_nulls_first() for c in order]


def number_rows(
    df: DataFrame, order: Sequence[str], name: str = "id", cuts: Sequence[Column] = ()
) -> DataFrame:
    """Add 1..n in ``order`` (which should be unique).

    ``cuts``: the order is cut by the first, what lies between by the second, and so on;
    none may fall while ``order`` grows. Without any it is the first column of the order.
    A task orders the rows of an innermost cut; another the cuts within one of the level
    above, as a row each.
    """
    cuts = list(cuts) or [F.col(f"`{order[0]}`")]
    names = [f"_cut{i}" for i in range(len(cuts))]
    rows = df.withColumns(dict(zip(names, cuts)))
    number = F.row_number().over(Window.partitionBy(*names).orderBy(*_keys(order)))
    rows = rows.withColumns({"_nth": number, "_of": F.struct(*names)})
    for depth in range(len(names), 0, -1):
        outer, last = names[: depth - 1], names[depth - 1]
        before = (
            Window.partitionBy(*outer).orderBy(F.col(last).asc_nulls_first())
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        starts = rows.groupBy(*names[:depth]).agg(F.count(F.lit(1)).alias("_rows")).select(
            F.struct(*names[:depth]).alias("_at"), F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias(f"_before{depth}")
        )
        rows = rows.withColumn("_of", F.struct(*names[:depth])).join(starts, F.col("_of") == F.col("_at")).drop("_at")
    total = F.col("_nth")
    for depth in range(1, len(names) + 1):
        total = total + F.col(f"_before{depth}")
    return rows.select(total.cast("bigint").alias(name), *df.columns)


def lag_in_order(
    df: DataFrame,
    entity: Sequence[str],
    order: Sequence[str],
    values: Sequence[str],
    cut: Column | None = None,
) -> DataFrame:
    """Add ``prev_<value>``: the value of the entity's previous row in ``order``.

    ``entity + order`` should be unique, otherwise the order among equals is open.
    ``cut`` must not fall while ``order`` grows; without one it is the first column of
    the order. A task orders an entity's rows of one cut, and a row for each of its cuts.
    """
    # The entity and the cut as one column, which also joins NULL entities.
    cut = F.col(f"`{order[0]}`") if cut is None else cut
    rows = df.withColumn(CUT, cut).withColumn("_run", F.struct(*entity, CUT))
    in_run = Window.partitionBy("_run").orderBy(*_keys(order))
    place = F.struct(*[F.col(f"`{c}`") for c in order])
    lasts = rows.groupBy("_run").agg(*[F.max_by(v, place).alias(f"_last_{v}") for v in values])
    over_runs = Window.partitionBy(*[F.col(f"_run.`{k}`") for k in entity]).orderBy(
        F.col(f"_run.{CUT}").asc_nulls_first()
    )
    carried = lasts.select(
        F.col("_run").alias("_of"), *[F.lag(f"_last_{v}").over(over_runs).alias(f"_carry_{v}") for v in values]
    )
    inside = rows.withColumns(
        {
            "_nth": F.row_number().over(in_run),
            **{f"_lag_{v}": F.lag(v).over(in_run) for v in values},
        }
    )
    previous = [
        F.when(F.col("_nth") == 1, F.col(f"_carry_{v}"))
        .otherwise(F.col(f"_lag_{v}"))
        .alias(f"prev_{v}")
        for v in values
    ]
    return inside.join(carried, F.col("_run") == F.col("_of"), "left").select(*df.columns, *previous)
