"""Order-stable dedupe and consolidation of duplicate keys."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.text import has_text


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the first in ``order``. NULL keys count as equal.

    Spark limits each task to one candidate per key before the shuffle, so a
    key with very many copies reaches its reducer as one row per task.
    """
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_nth", nth).where("_nth = 1").drop("_nth")


def joined_notes(
    df: DataFrame,
    keys: Sequence[str],
    note: str,
    order: Sequence[str],
    chunk: Sequence[Column] = (),
    separator: str = "; ",
) -> DataFrame:
    """Per key the non-blank notes joined in ``order``.

    ``chunk`` are expressions that never decrease along ``order``. With them,
    notes are first joined per chunk and then chunk after chunk, so no task
    sorts all notes of a frequent key.
    """
    noted = df.where(has_text(F.col(note)))
    names = [f"_chunk{i}" for i in range(len(chunk))]
    if names:
        noted = noted.withColumns(dict(zip(names, chunk)))
        noted = noted.groupBy(*keys, *names).agg(_listagg(note, separator, order).alias(note))
        order = names
    return noted.groupBy(*keys).agg(_listagg(note, separator, order).alias(note))


def note_rows(df: DataFrame, keys: Sequence[str], note: str, order: Sequence[str]) -> DataFrame:
    """The non-blank notes as rows (keys, order, note): the form for keys with more notes
    than one value should hold. Nothing is gathered, and ``order`` tells their places."""
    return df.where(has_text(F.col(note))).select(*keys, *order, note)


def _listagg(value: str, separator: str, order: Sequence[str]) -> Column:
    by = ", ".join(f"`{c}`" for c in order)
    quoted = separator.replace("\\", "\\\\").replace("'", "\\'")
    return F.expr(f"listagg(`{value}`, '{quoted}') WITHIN GROUP (ORDER BY {by})")


def consolidate(
    df: DataFrame,
    keys: Sequence[str],
    sums: Sequence[str],
    note: str | None = None,
    order: Sequence[str] = (),
    chunk: Sequence[Column] = (),
    separator: str = "; ",
) -> DataFrame:
    """Merge duplicate keys: amounts are summed, non-blank notes joined in order.

    The sums stay a plain hash aggregate; notes are usually sparse and are
    joined on afterwards. Both sides are grouped by the keys as one struct.
    Structs with NULL fields are equal, so keys with NULLs find each other,
    both sides are already partitioned for the join, and where nobody reads
    the notes the optimizer drops it.
    """
    if note is None:
        return df.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])
    keyed = df.withColumn("_key", F.struct(*keys))
    totals = keyed.groupBy("_key").agg(*[F.sum(c).alias(c) for c in sums])
    notes = joined_notes(keyed, ["_key"], note, order, chunk, separator)
    return totals.join(notes, "_key", "left").select(
        *[F.col(f"_key.`{k}`").alias(k) for k in keys], *sums, note
    )


Combine = Callable[[DataFrame, DataFrame], DataFrame]


def keep_stored(keys: Sequence[str], order: Sequence[str]) -> Combine:
    """Stored rows and, of each key they lack, the first new one in ``order``: what
    :func:`keep_first` gives on all loads together. NULL keys count as equal."""

    def combine(stored: DataFrame, new: DataFrame) -> DataFrame:
        first = keep_first(new, keys, order).withColumn("_key", F.struct(*keys))
        known = stored.select(F.struct(*keys).alias("_known"))
        added = first.join(known, F.col("_key") == F.col("_known"), "left_anti").drop("_key")
        return stored.unionByName(added)

    return combine


def add_increment(
    keys: Sequence[str],
    sums: Sequence[str],
    note: str | None = None,
    order: Sequence[str] = (),
    chunk: Sequence[Column] = (),
    separator: str = "; ",
) -> Combine:
    """Stored rows with the sums of the new ones added and their notes put behind: what
    :func:`consolidate` gives on all loads together, where later loads come later in order.
    Without ``order`` the new rows are one per key already."""

    def combine(stored: DataFrame, new: DataFrame) -> DataFrame:
        given = consolidate(new, keys, sums, note, order, chunk, separator) if order or note is None else new
        named = [F.struct(*keys).alias("_key"), *[F.col(f"`{s}`") for s in sums], *([F.col(f"`{note}`")] if note else [])]
        one, other = stored.select(*named), given.select(*named)
        both = one.alias("o").join(other.alias("n"), F.col("o._key") == F.col("n._key"), "full")
        key = F.coalesce("o._key", "n._key")

        def total(name: str) -> Column:
            old, added = F.col(f"o.`{name}`"), F.col(f"n.`{name}`")
            summed = F.coalesce(old + added, old, added)
            return summed.cast(stored.schema[name].dataType).alias(name)

        joined = [F.nullif(F.concat_ws(separator, f"o.`{note}`", f"n.`{note}`"), F.lit("")).alias(note)] if note else []
        return both.select(key.alias("_key"), *[total(s) for s in sums], *joined).select(
            *[F.col(f"_key.`{k}`").alias(k) for k in keys], *sums, *([note] if note else [])
        )

    return combine
