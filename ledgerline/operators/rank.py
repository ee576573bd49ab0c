"""Leaderboards and ranks over aggregated rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.session import written_once

#: Ranges into which distinct scores are cut; a power of two, for the search among them.
RANGES = 64
#: Rows that one task orders at most; more are ranked by ranges.
IN_ONE_TASK = 1 << 16


def with_dense_rank(df: DataFrame, name: str, score: str, descending: bool = True) -> DataFrame:
    """Add the DENSE_RANK of ``score`` over all rows; see :func:`with_dense_ranks`."""
    return with_dense_ranks(df, {name: (score, descending)})


def with_dense_ranks(
    df: DataFrame, ranks: Mapping[str, tuple[str, bool]], ranges: int = RANGES, in_one_task: int = IN_ONE_TASK
) -> DataFrame:
    """Add a DENSE_RANK over all rows for each name: (score, descending).

    NULL counts as the greatest score: it ranks first if descending, else last. Scores are
    numbers, dates or times.

    The rows, as a rule one per member of a dimension, are computed and written once and
    counted. Up to ``in_one_task`` of them are ordered by one task; otherwise neither one
    task nor one value holds all scores. Then the distinct scores of all ranks are found in
    one pass, approximate quantiles of them cut them into ranges, a task numbers those of a
    range, and a row per range tells how many lie below it. Rows find the rank of their
    score by a join, which adaptive execution broadcasts where there are few scores and
    splits where many rows share one.
    """
    if ranges & (ranges - 1) or ranges < 2:
        raise ValueError(f"ranges must be a power of two, not {ranges}")
    rows, count = written_once(df, "ranked")
    if count <= in_one_task:
        places = {
            name: F.dense_rank().over(Window.orderBy(F.desc_nulls_first(score) if descending else F.asc_nulls_last(score)))
            for name, (score, descending) in ranks.items()
        }
        return rows.withColumns(places)
    kinds: dict[str, list[str]] = {}
    for name, (score, _) in ranks.items():
        kinds.setdefault(rows.schema[score].dataType.simpleString(), []).append(name)
    ranked = rows
    for number, names in enumerate(kinds.values()):
        places = _places(rows, [ranks[n][0] for n in names], ranges)
        for which, name in enumerate(names):
            score, descending = ranks[name]
            found = f"_found{number}_{which}"
            own = places.where(F.col("which") == which).select(
                F.col("score").alias(found), F.col("falling" if descending else "rising").alias(name)
            )
            on = ranked[score].eqNullSafe(F.col(found))
            ranked = ranked.join(own, on, "left").drop(found)
    return ranked.select(*df.columns, *ranks)


def _places(df: DataFrame, scores: Sequence[str], ranges: int) -> DataFrame:
    """which, score, and its rank from the least (``rising``) and greatest (``falling``)."""
    each = F.array(*[F.struct(F.lit(i).alias("which"), F.col(f"`{s}`").alias("score")) for i, s in enumerate(scores)])
    distinct = df.select(F.inline(each)).distinct()
    # a row per rank that is asked for
    steps = ", ".join(str(i / ranges) for i in range(1, ranges))
    quantiles = F.expr(f"percentile_approx(score, array({steps}), {100 * ranges})")
    borders = distinct.groupBy("which").agg(quantiles.alias("borders"))
    ranged = distinct.join(F.broadcast(borders), "which").select(
        "which", "score", _range(F.col("score"), F.col("borders"), ranges).alias("range")
    )
    nth = F.row_number().over(Window.partitionBy("which", "range").orderBy("score"))
    numbered = ranged.withColumn("nth", nth)
    # at most one row per rank and range, from here on
    along = Window.partitionBy("which")
    before = along.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ends = numbered.groupBy("which", "range").agg(F.max("nth").alias("n")).select(
        "which", "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"), F.sum("n").over(along).alias("all")
    )
    rising = (F.col("nth") + F.col("before")).cast("int")
    return numbered.join(F.broadcast(ends), ["which", "range"]).select(
        "which", "score", rising.alias("rising"), (F.col("all").cast("int") + 1 - rising).alias("falling")
    )


def _range(score: Column, borders: Column, ranges: int) -> Column:
    """How many of the ascending borders the score reaches, by halving; NULL is beyond."""
    halves = ", ".join(str(ranges >> k) for k in range(1, ranges.bit_length()))

    def further(at: Column, step: Column) -> Column:
        reached = F.get(borders, at + step - 1) <= score
        return at + F.when(reached, step).otherwise(F.lit(0))

    found = F.aggregate(F.expr(f"array({halves})"), F.lit(0), further)
    return F.when(score.isNull(), F.lit(ranges)).otherwise(found)


def leaderboard(
    df: DataFrame, score: str, rank_name: str, k: int, tie_break: Sequence[str]
) -> DataFrame:
    """The ``k`` best rows with their DENSE_RANK.

    A rank only depends on the rows above, so the top-k is taken first (each
    task keeps k rows) and ranked afterwards. NULL scores rank first, as in an
    SQL descending sort.
    """
    best = F.col(score).desc_nulls_first()
    top = df.orderBy(best, *tie_break).limit(k)
    # k rows
    return top.withColumn(rank_name, F.dense_rank().over(Window.orderBy(best)))


def top_rows(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    return df.orderBy(*order).limit(k)
