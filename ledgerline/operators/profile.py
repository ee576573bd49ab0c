"""Looking at raw tables before cleaning them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.text import has_text
from ledgerline.operators.share import with_group_total


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def sample_with_text(
    df: DataFrame, column: str, show: Sequence[str], order: Sequence[str], n: int = 20
) -> DataFrame:
    """The first ``n`` rows, in order, whose ``column`` says something."""
    return df.where(has_text(F.col(column))).orderBy(*order).limit(n).select(*show)


def null_counts(df: DataFrame, columns: Sequence[str], rows: str = "total_rows") -> DataFrame:
    """Number of rows and of NULLs per column, in one pass."""
    return df.agg(
        F.count(F.lit(1)).alias(rows), *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns]
    )


def sums_by_key(df: DataFrame, keys: Sequence[str], amount: str, name: str) -> DataFrame:
    """SUM per key; rows with a missing key belong to no group.

    Groups with a missing key are told by a count and dropped at the end. A
    filter on the keys would be pushed to the scan and there parse raw text
    a second time.
    """
    known = [F.count(k).alias(f"_{k}") for k in keys]
    sums = df.groupBy(*keys).agg(F.sum(amount).alias(name), *known)
    return _with_known(sums, keys)


def _with_known(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    flags = [f"_{k}" for k in keys]
    return df.where(" and ".join(f"`{f}` > 0" for f in flags)).drop(*flags)


def raw_share(
    df: DataFrame, derived: Mapping[str, Column], group: str, part: str, amount: str, total: str
) -> DataFrame:
    """Unrounded percentage of the group total, on columns derived from raw text.

    Rows without a part count in the total of their group but are not shown.
    """
    sums = (
        df.select(*_needed(derived, [group, part, amount]))
        .groupBy(group, part)
        .agg(
            F.sum(amount).alias(amount),
            F.count(group).alias(f"_{group}"),
            F.count(part).alias(f"_{part}"),
        )
    )
    shares = _with_known(with_group_total(sums, [group], amount, total), [group, part])
    pct = F.col(amount).cast("double") / F.col(total).cast("double") * 100
    return shares.withColumn("pct", pct)


def _needed(derived: Mapping[str, Column], names: Sequence[str]) -> list[Column]:
    return [derived[n].alias(n) if n in derived else F.col(n) for n in names]
