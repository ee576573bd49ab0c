"""Long to wide and wide to long."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unpivot(
    df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str, value: str
) -> DataFrame:
    return df.unpivot(list(ids), list(values), name, value)


def relabel(c: Column, labels: Mapping[str, str]) -> Column:
    """Label per code, NULL for codes without one."""
    pairs = [F.lit(x) for kv in labels.items() for x in kv]
    return F.create_map(*pairs)[c]


def pivot_sum(
    df: DataFrame, keys: Sequence[str], column: str, amount: str, names: Mapping[object, str]
) -> DataFrame:
    """SUM of ``amount`` per key with one output column per listed value.

    The values are given, so no pass over the data is spent on finding them.
    """
    summed = df.where(F.col(column).isin(*names)).groupBy(*keys)
    wide = summed.pivot(column, list(names)).agg(F.sum(amount))
    return wide.select(*keys, *[F.col(f"`{v}`").alias(n) for v, n in names.items()])
