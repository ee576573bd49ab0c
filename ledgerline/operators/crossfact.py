"""Combining facts of different grain: aggregate each first, then join."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.arithmetic import MEAN, VALUE, WIDE


def sums_by(
    fact: DataFrame, keys: Mapping[str, Column] | Sequence[str], sums: Mapping[str, str]
) -> DataFrame:
    """SUM per key; ``sums``: output name -> column. Keys may be expressions."""
    if isinstance(keys, Mapping):
        fact = fact.select(
            *[c.alias(n) for n, c in keys.items()],
            *[F.col(c).alias(f"_in_{n}") for n, c in sums.items()],
        )
        return fact.groupBy(*keys).agg(*[F.sum(f"_in_{n}").alias(n) for n in sums])
    return fact.groupBy(*keys).agg(*[F.sum(c).alias(n) for n, c in sums.items()])


def sums_by_member(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    label: str,
    keys: Mapping[str, Column],
    sums: Mapping[str, str],
) -> DataFrame:
    """SUM per dimension label and further keys.

    The fact is summed per dimension *key* before the join. Only those few rows
    meet the dimension, and a key with a third of the fact is combined inside
    the map tasks. Labels shared by several members are merged by the second sum.
    """
    per_key = sums_by(fact, {key: F.col(key), **keys}, sums)
    joined = per_key.join(dim.select(key, label), key)
    return joined.groupBy(label, *keys).agg(*[F.sum(n).alias(n) for n in sums])


def fan_out_mean(
    left: DataFrame,
    right: DataFrame,
    key: str,
    group: Sequence[str],
    value: Column,
    name: str,
    labels: DataFrame | None = None,
) -> DataFrame:
    """AVG(``value`` of right) per ``group`` of left over left JOIN right ON key.

    The join would pair every left row with every right row of a key. Instead
    each side is reduced first - left rows counted per key and group, values
    summed and counted per key - and the mean is sum(n * s) / sum(n * c).
    That equals the mean over all pairs, also when a group spans keys.
    ``labels`` (one row per key) supplies group columns that left lacks.
    """
    # Exact as long as the digits suffice, next to it the same as DOUBLE carries it.
    fine = value.try_cast(VALUE)
    own = [c for c in group if c in left.columns]
    lefts = left.groupBy(key, *own).agg(F.count(F.lit(1)).alias("_n"))
    rights = right.groupBy(key).agg(
        F.when(F.count(fine) == F.count(value), F.try_sum(fine).try_cast("decimal(26,10)")).alias("_s"),
        F.sum(value.cast("double")).alias("_d"),
        F.count(value).alias("_c"),
    )
    paired = lefts.join(rights, key)
    if labels is not None:
        paired = paired.join(labels, key)
    n = F.col("_n").try_cast("decimal(11,0)")
    part = F.try_multiply(n, F.col("_s"))
    pairs = F.sum(F.col("_n").cast("decimal(19,0)") * F.col("_c"))
    # a key without any value adds nothing, so it may lack its sum
    whole = F.bool_and(part.isNotNull() | (F.col("_c") == 0))
    mean = F.coalesce(
        F.when(whole, (F.try_sum(part).try_cast(WIDE) / F.nullif(pairs, F.lit(0).cast("decimal(19,0)"))).try_cast(MEAN)),
        (F.sum(F.col("_n") * F.col("_d")) / F.nullif(pairs.cast("double"), F.lit(0.0))).try_cast(MEAN),
    )
    return paired.groupBy(*group).agg(mean.alias(name))


def fan_out_rows(left: DataFrame, right: DataFrame, key: str, pairs: int = 1 << 20) -> DataFrame:
    """The rows of left JOIN right ON key, with about ``pairs`` of them to a task at most.

    A key with many rows on both sides makes the product of their numbers. Counts of both
    sides tell how large a grid the pairs of each such key are cut into: a row lies in one
    line (or column) of it, by a hash of its values, and goes to every cell of that line.
    Keys below the limit are joined as they are. Rows without a key pair with none, equal
    rows share a line. Other columns must have different names.
    """
    lefts, rights = fan_out_cells(left, right, key, pairs)
    return lefts.join(rights, [key, "_line", "_column"]).drop("_line", "_column")


def fan_out_cells(left: DataFrame, right: DataFrame, key: str, pairs: int) -> tuple[DataFrame, DataFrame]:
    """Both sides with the cells (_line, _column) of their keys' grids that each row goes to."""
    side = int(pairs**0.5)
    sizes = [
        df.groupBy(key).agg(F.count(F.lit(1)).alias(name)) for df, name in ((left, "_nl"), (right, "_nr"))
    ]
    lines = F.ceil(F.col("_nl") * F.least("_nr", F.lit(side)) / F.lit(side * side))
    columns = F.ceil(F.col("_nr") * F.least("_nl", F.lit(side)) / F.lit(side * side))
    grid = (
        sizes[0].join(sizes[1], key)
        .select(key, lines.alias("_lines"), columns.alias("_columns"))
        .where((F.col("_lines") > 1) | (F.col("_columns") > 1))
    )

    def dealt(df: DataFrame, own: str, other: str, line: str, cell: str) -> DataFrame:
        place = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.coalesce(own, F.lit(1)))
        every = F.sequence(F.lit(0).cast("bigint"), F.coalesce(other, F.lit(1)) - 1)
        marked = df.where(F.col(key).isNotNull()).join(grid, key, "left")
        return marked.select(*[F.col(f"`{c}`") for c in df.columns], place.alias(line), F.explode(every).alias(cell))

    return dealt(left, "_lines", "_columns", "_line", "_column"), dealt(right, "_columns", "_lines", "_column", "_line")
