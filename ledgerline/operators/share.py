"""Shares of a group total or of the grand total."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.arithmetic import divide_or_null, percent


def with_group_total(df: DataFrame, group: Sequence[str], amount: str, name: str) -> DataFrame:
    """Add the total of ``amount`` per group (of everything for no group).

    Meant for aggregated input - one row per part - where a group is small. The
    grand total is a scalar of its own, so that no task holds all parts.
    """
    if not group:
        return df.withColumn(name, df.agg(F.sum(amount)).scalar())
    return df.withColumn(name, F.sum(amount).over(Window.partitionBy(*group)))


def share_of_group(
    df: DataFrame,
    group: Sequence[str],
    part: Sequence[str],
    amount: str,
    total_name: str,
    pct_name: str,
    min_share: float | None = None,
) -> DataFrame:
    """Sum ``amount`` per group and part and its percentage of the group.

    One shuffle of partial sums; the total is a window over them instead of a
    second scan joined back. ``min_share`` keeps shares strictly above it.
    """
    sums = df.groupBy(*group, *part).agg(F.sum(amount).alias(amount))
    shared = with_group_total(sums, group, amount, total_name)
    if min_share is not None:
        shared = shared.where(above_share(amount, total_name, min_share))
    return shared.withColumn(pct_name, percent(F.col(amount), F.col(total_name)))


def above_share(amount: str, total: str, share: float):
    return divide_or_null(F.col(amount), F.col(total)) > F.lit(str(share)).cast("decimal(24,18)")
