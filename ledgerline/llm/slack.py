"""Packing of documents into windows with as little slack as possible.

Documents are cut at whole windows; what is left of each is shorter than one. Lengths are
packed, not documents: a histogram has fewer rows than a window has ids. Window after
window takes the largest length that is left and, of the others, the multiset that comes
closest to the capacity. The reachable sums are the bits of a number; walking back through
the steps that reached them gives how often each length is used. A window is repeated as
often as there are pieces for it. Where the closest sum leaves slack, a piece is cut to
fill it. The last ids, too few for a window, go into windows of powers of two, which need
no padding either.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.llm.common import cut, table, text_or_empty
from ledgerline.llm.encoding import encoder, slices
from ledgerline.llm.registry import query

CAPACITY = 1024
END_ID = 0


def least_slack(counts: dict[int, int], room: int) -> dict[int, int]:
    """How often to use each length, at most so often as there are pieces of it, for the
    sum that is closest to ``room`` without exceeding it; large lengths are preferred."""
    every = (1 << (room + 1)) - 1
    sums = 1
    steps: list[tuple[int, int]] = []
    for length in sorted((n for n, c in counts.items() if c and n <= room), reverse=True):
        for _ in range(min(counts[length], room // length)):
            reached = (sums | sums << length) & every
            if reached == sums:
                break
            steps.append((length, sums))
            sums = reached
        if sums >> room:
            break
    left = sums.bit_length() - 1
    used: dict[int, int] = {}
    for length, before in reversed(steps):
        if not before >> left & 1:
            used[length] = used.get(length, 0) + 1
            left -= length
    return used


@dataclass
class SlackPlan:
    """Where the pieces of a histogram go. A slot says of ``count`` pieces of a length,
    numbered from ``first``: their ids from ``start`` on, ``size`` of them, lie at
    ``offset`` of the windows from ``window`` on, one in each."""

    counts: dict[int, int]
    capacity: int = CAPACITY
    windows: int = 0
    #: (length, first, start, size, window, offset, count)
    slots: list[tuple[int, ...]] = field(default_factory=list)

    def __post_init__(self) -> None:
        self.left = {n: c for n, c in self.counts.items() if c}
        # by what is left of them: runs of pieces as [length, first, start, count]
        self.runs: dict[int, list[list[int]]] = {n: [[n, 0, 0, c]] for n, c in self.left.items()}
        total = sum(n * c for n, c in self.left.items())
        for _ in self._filled(self.capacity):
            pass
        rest = total % self.capacity
        for size in (1 << k for k in range(rest.bit_length() - 1, -1, -1)):
            if rest & size:
                next(self._filled(size, 1))

    def _filled(self, room: int, most: int | None = None) -> Iterator[int]:
        """Fill windows of ``room`` ids as long as there are enough for one."""
        total = sum(n * c for n, c in self.left.items())
        while total >= room:
            used: dict[int, int] = {}
            lead = max(self.left)
            if lead <= room:
                self.left[lead] -= 1
                used = least_slack(self.left, room - lead)
                self.left[lead] += 1
                used[lead] = used.get(lead, 0) + 1
            slack = room - sum(n * k for n, k in used.items())
            parted = 0
            if slack:
                # all that is left is longer; the longest leaves most to choose from
                parted = max(n for n, c in self.left.items() if c > used.get(n, 0))
            needed = used | ({parted: used.get(parted, 0) + 1} if parted else {})
            times = min(self.left[n] // k for n, k in needed.items())
            times = min(times, total // room, most or times)
            offset = 0
            for length in sorted(used, reverse=True):
                for _ in range(used[length]):
                    self._take(length, length, times, offset)
                    offset += length
            if parted:
                self._take(parted, slack, times, offset)
            self.windows += times
            total -= times * room
            yield times

    def _take(self, length: int, size: int, times: int, offset: int) -> None:
        """Put the first ``size`` ids of ``times`` pieces of a length into the new windows;
        what is behind them stays to be packed."""
        window = self.windows
        while times:
            run = self.runs[length][-1]
            origin, first, start, there = run
            n = min(times, there)
            self.slots.append((origin, first, start, size, window, offset, n))
            if size < length:
                self.runs.setdefault(length - size, []).append([origin, first, start + size, n])
                self.left[length - size] = self.left.get(length - size, 0) + n
            run[1] += n
            run[3] -= n
            if not run[3]:
                self.runs[length].pop()
            self.left[length] -= n
            window += n
            times -= n
        if not self.left[length]:
            del self.left[length], self.runs[length]


def _pieces(
    docs: DataFrame, tokenizer: str, spaces_dropped: bool, end_id: int, capacity: int
) -> DataFrame:
    """doc_id, doc_tokens, start, length, ids_crc32, ids: whole windows of each document,
    without their ids, and what is left of it."""
    schema = "doc_id long, doc_tokens long, start long, length long, ids_crc32 long, ids binary"
    types = [*[pa.int64()] * 5, pa.binary()]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_text = encoder(tokenizer, spaces_dropped).encode
        end = end_id.to_bytes(4, "little")
        for rows in slices(batches):
            out = []
            for doc_id, text in rows:
                ids = encode_text(text) + end
                for at in range(0, len(ids), 4 * capacity):
                    part = ids[at : at + 4 * capacity]
                    n = len(part) // 4
                    out.append((doc_id, len(ids) // 4, at // 4, n, zlib.crc32(part), part if n < capacity else None))
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), types)], names=_FIELDS)

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return chosen.mapInArrow(encode, schema)


_FIELDS = ["doc_id", "doc_tokens", "start", "length", "ids_crc32", "ids"]
_RESULT = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def _with_numbers(pieces: DataFrame, buckets: int) -> DataFrame:
    """Add the number of each piece among those of its length. A length is spread over
    ``buckets``, so a frequent one meets in no task; their counts are one narrow row each."""
    placed = pieces.withColumn("bucket", F.pmod(F.xxhash64("row"), F.lit(buckets)).cast("int"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("length", "bucket").count().select(
        "length", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before")
    )
    within = Window.partitionBy("length", "bucket").orderBy("row")
    numbered = placed.withColumn("nth", F.row_number().over(within)).join(starts, ["length", "bucket"])
    return numbered.withColumn("number", F.col("nth") + F.col("before") - 1).drop("nth", "before", "bucket")


def _place(numbered: DataFrame, plan: SlackPlan) -> DataFrame:
    """A row per part of a piece: from where in the piece, how long, in which window."""
    slots = np.array(sorted(plan.slots), dtype=np.int64).reshape(-1, 7)
    origins = np.unique(slots[:, 0]).tolist()
    by_length = {n: slots[slots[:, 0] == n] for n in origins}
    kept = ["row", "doc_id", "doc_tokens", "start", "length", "ids_crc32"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column("length").to_numpy()
            numbers = batch.column("number").to_numpy()
            for length in np.unique(lengths).tolist():
                at = np.nonzero(lengths == length)[0]
                own = by_length[length]
                # the slots of a length that begin alike cover the same numbers
                for start in np.unique(own[:, 2]).tolist():
                    part = own[own[:, 2] == start]
                    slot = np.searchsorted(part[:, 1], numbers[at], side="right") - 1
                    hit = (slot >= 0) & (numbers[at] < part[slot, 1] + part[slot, 6])
                    rows, chosen = pa.array(at[hit]), part[slot[hit]]
                    columns = [batch.column(c).take(rows) for c in kept]
                    window = chosen[:, 4] + numbers[at][hit] - chosen[:, 1]
                    columns += [pa.array(x) for x in (chosen[:, 2], chosen[:, 3], window, chosen[:, 5])]
                    yield pa.record_batch(columns, names=[*kept, "from", "size", "sequence_id", "offset"])

    fields = ", ".join(f"{c} long" for c in (*kept, "`from`", "size", "sequence_id", "offset"))
    return numbered.select(*kept, "number").mapInArrow(place, fields)


def _checksums(parts: DataFrame) -> DataFrame:
    """The checksums of parts of pieces, from the pieces' ids."""

    def checksum(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch.column("ids"), batch.column("from").to_pylist(), batch.column("size").to_pylist())
            crcs = [zlib.crc32(ids.as_py()[4 * a : 4 * (a + n)]) for ids, a, n in rows]
            columns = [pa.array(crcs, pa.int64()) if c == "ids_crc32" else batch.column(c) for c in _RESULT]
            yield pa.record_batch(columns, names=_RESULT)

    given = parts.select(
        "doc_id", "doc_tokens", (F.col("start") + F.col("from")).alias("start"), F.col("size").alias("length"),
        "ids_crc32", "sequence_id", "offset", "from", "size", "ids",
    )
    return given.mapInArrow(checksum, ", ".join(f"{c} long" for c in _RESULT))


def pack_with_least_slack(
    docs: DataFrame, tokenizer: str, spaces_dropped: bool = False, end_id: int = END_ID, capacity: int = CAPACITY
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``capacity`` is a power of two. All sequences have that many ids but for at most one
    of each smaller power of two, so nothing is padded. A null or empty text is the end id
    alone. Rows with the same or a null id are documents of their own; an empty table gives
    no rows; further columns are not read. Texts are encoded once. What is shuffled is one
    narrow row per document; ids are only read again for pieces that the plan cuts.
    """
    if capacity & (capacity - 1) or capacity < 1:
        raise ValueError(f"capacity must be a power of two, not {capacity}")
    pieces = cut(
        _pieces(docs, tokenizer, spaces_dropped, end_id, capacity).withColumn("row", F.monotonically_increasing_id()),
        "pieces",
    )
    short = pieces.where(F.col("length") < capacity)
    # fewer than ``capacity`` rows
    counts = {r.length: r["count"] for r in short.groupBy("length").count().collect()}
    plan = SlackPlan(counts, capacity)
    whole = pieces.where(F.col("length") == capacity).select(
        *_RESULT[:5], (-1 - F.col("row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    narrow = short.select("row", "doc_id", "doc_tokens", "start", "length", "ids_crc32")
    numbered = _with_numbers(narrow, 1 + int(sum(counts.values()) ** 0.5))
    placed = cut(_place(numbered, plan), "placed")
    uncut = placed.where("size = length").select(*_RESULT)
    divided = cut(placed.where("size < length"), "divided")
    found = _checksums(divided.join(short.select("row", "ids"), "row"))
    return whole.unionByName(uncut).unionByName(found)


@query("op13_slack_packing")
def op13_slack_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack_with_least_slack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
