"""CSV records with line breaks in quoted fields, out of files that are read in ranges.

Spark reads a text file in ranges of bytes, line by line, and a range may begin in the
middle of a quoted field. Whether it does depends on everything before it, so a first scan
finds what each range does to either state it may begin in: outside or inside a field. The
effects of the ranges of a file are put together in order, one row per range, which tells
the true state each begins in. A second scan then cuts every range into records. The lines
with which a range goes on with the record of an earlier one are put behind it.

This is the only place of the analytics that runs Python on rows, in Arrow batches: the
state of a line depends on the line before it, which no expression sees.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A record, or a part of one: ``head`` is the first part of a record that the range does
#: not end, ``tail`` what a range adds to an earlier one's.
WHOLE, HEAD, TAIL = 0, 1, 2


def inside_after(line: str, inside: bool, separator: str = ",") -> bool:
    """Whether a quoted field is open after the line, if one was (``inside``) before it.

    A quote opens a field only at its beginning, is doubled within, and closes it
    otherwise; after that everything up to the next separator belongs to the field.
    """
    at = 0
    while True:
        if inside:
            quote = line.find('"', at)
            if quote < 0:
                return True
            if line.startswith('"', quote + 1):
                at = quote + 2
                continue
            inside, at = False, quote + 1
        elif line.startswith('"', at):
            inside, at = True, at + 1
            continue
        at = line.find(separator, at) + 1
        if not at:
            return False


def _lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Lines without their ``\\n``, in the order of each range."""
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.option("lineSep", "\n").text(paths).select(
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_split"), "value"
    )


def _by_range(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, list[str]]]:
    """Lines that follow each other in a range; a range may come in several lists."""
    for batch in batches:
        files, splits = batch.column("_file"), batch.column("_split").to_pylist()
        lines = batch.column("value").to_pylist()
        start = 0
        for end in range(1, len(lines) + 1):
            if end == len(lines) or splits[end] != splits[start] or files[end] != files[start]:
                yield files[start].as_py(), splits[start], lines[start:end]
                start = end


def _effects(lines: DataFrame) -> DataFrame:
    """_file, _split, and the states after the range: ``from_outside``, ``from_inside``."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, outside, inside = None, False, True
        for file, split, part in _by_range(batches):
            if (file, split) != current:
                if current:
                    yield _effect(*current, outside, inside)
                current, outside, inside = (file, split), False, True
            for line in part:
                if '"' in line:
                    outside, inside = inside_after(line, outside), inside_after(line, inside)
        if current:
            yield _effect(*current, outside, inside)

    return lines.mapInArrow(scan, "_file string, _split long, from_outside boolean, from_inside boolean")


def _effect(file: str, split: int, outside: bool, inside: bool) -> pa.RecordBatch:
    columns = [pa.array([file]), pa.array([split], pa.int64()), pa.array([outside]), pa.array([inside])]
    return pa.record_batch(columns, names=["_file", "_split", "from_outside", "from_inside"])


def begins_inside(effects: DataFrame) -> DataFrame:
    """_file, _split of the ranges that begin inside a field.

    A range that ends in the same state from either one forgets what was before it; the
    others keep or swap the state. So the state is that of the last forgetful range, swapped
    as often as there were swapping ones since. A row per range, in one task per file.
    """
    along = Window.partitionBy("_file").orderBy("_split")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    forgets = F.col("from_outside") == F.col("from_inside")
    swaps = F.sum(F.when(F.col("from_outside") & ~F.col("from_inside"), 1).otherwise(0))
    marked = effects.withColumn("swaps", swaps.over(along.rowsBetween(Window.unboundedPreceding, 0)))
    known = F.last(F.when(forgets, F.struct("from_outside", "swaps")), ignorenulls=True).over(before)
    marked = marked.withColumns({"known": known, "swapped": F.coalesce(F.lag("swaps").over(along), F.lit(0))})
    since = F.col("swapped") - F.coalesce("known.swaps", F.lit(0))
    at_known = F.coalesce("known.from_outside", F.lit(False)).cast("int")
    return marked.where((at_known + since) % 2 == 1).select("_file", "_split")


def _parts(lines: DataFrame, inside: frozenset[tuple[str, int]], header: bool) -> DataFrame:
    """_file, _split, _row (number of the first line in its range), kind, record."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, is_open, kind, held, first, row = None, False, WHOLE, [], 0, 0
        skipped = False

        def finished(kind: int) -> list[tuple]:
            nonlocal skipped
            if header and current[1] == 0 and not skipped and kind != TAIL:
                skipped = True
                # the rest of a header that the range does not end is dropped with it
                return [(*current, -1, HEAD, None)] if kind == HEAD else []
            record = "\n".join(held)
            if kind == WHOLE and not record.strip("\r"):
                return []  # a blank line is no record
            return [(*current, first, kind, record)]

        for file, split, part in _by_range(batches):
            out: list[tuple] = []
            if (file, split) != current:
                if current and held:
                    out += finished(TAIL if kind == TAIL else HEAD if is_open else WHOLE)
                current, row, skipped = (file, split), 0, False
                is_open = current in inside
                kind, held = (TAIL if is_open else WHOLE), []
            for line in part:
                if not held:
                    first = row
                held.append(line)
                if '"' in line:
                    is_open = inside_after(line, is_open)
                if not is_open:
                    out += finished(kind)
                    kind, held = WHOLE, []
                row += 1
            yield _records(out)
        if current and held:
            yield _records(finished(TAIL if kind == TAIL else HEAD if is_open else WHOLE))

    return lines.mapInArrow(cut, "_file string, _split long, _row long, kind int, record string")


def _records(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * 5
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string()]
    names = ["_file", "_split", "_row", "kind", "record"]
    return pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)


def read_records(spark: SparkSession, path: str | Sequence[str], header: bool = True) -> DataFrame:
    """_file, _split, _row, record: the text of each record, line breaks included, and
    where it begins (range of the file, line in the range).

    Runs the first scan at once. What comes to the driver are the ranges that begin inside
    a field: at most one entry per range of the files, all of which the driver plans anyway.
    Without any, the second scan is the only other one; else the parts of divided records
    are read once more, and only they are shuffled. ``header``: the first record of each
    file is left out. A blank line outside of a field is no record.
    """
    lines = _lines(spark, path)
    inside = frozenset((r._file, r._split) for r in begins_inside(_effects(lines)).toLocalIterator())
    parts = _parts(lines, inside, header)
    columns = ["_file", "_split", "_row", "record"]
    if not inside:
        # a field that the file does not end makes its last record
        return parts.where("record IS NOT NULL").select(*columns)
    whole = parts.where(F.col("kind") == WHOLE).select(*columns)
    pieces = parts.where(F.col("kind") != WHOLE)
    along = Window.partitionBy("_file").orderBy("_split", "_row")
    begun = F.sum(F.when(F.col("kind") == HEAD, 1).otherwise(0)).over(along.rowsBetween(Window.unboundedPreceding, 0))
    texts = F.array_sort(F.collect_list(F.struct("_split", "_row", "record")))
    joined = pieces.withColumn("nth", begun).groupBy("_file", "nth").agg(texts.alias("texts")).where("texts[0].record IS NOT NULL")
    divided = joined.select(
        "_file", F.col("texts")[0]["_split"].alias("_split"), F.col("texts")[0]["_row"].alias("_row"),
        F.array_join(F.col("texts.record"), "\n").alias("record"),
    )
    return whole.unionByName(divided)
