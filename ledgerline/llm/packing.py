"""Packing of documents into few sequences of bounded length, by linear grouping.

Lengths, not documents, are packed: a histogram has one row per length, so at most
``capacity`` rows however large the corpus is. Large lengths are grouped, a group's
lengths are rounded up to its largest, and configurations of the few rounded sizes are
chosen one after the other, each as full as the open demand allows and used as often as
it can be. Actual lengths then take the places of the rounded ones, and small documents
go into the tightest gaps. The plan lists runs of equal sequences; every piece finds its
place in it by its length and its number among the pieces of that length.
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
from ledgerline.llm.encoding import MAX_WORDS, encoder, slices
from ledgerline.llm.registry import query

CAPACITY = 4096
END_ID = 1
#: Plans that are made, of which the one with the fewest sequences is used: lengths over
#: capacity / part are large, and so many pieces of them make a group on average.
PLANS = ((4, 16), (4, 12), (4, 8), (4, 4), (8, 8), (8, 4))
MOST_GROUPS = 1024


def pieces_of(
    docs: DataFrame, tokenizer: str, spaces_dropped: bool, end_id: int = END_ID, capacity: int = CAPACITY,
    keep_ids: bool = False, words: int = MAX_WORDS,
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids): texts as ids with the end id,
    cut after every ``capacity`` ids."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_text = encoder(tokenizer, spaces_dropped, words).encode
        end = end_id.to_bytes(4, "little")
        for rows in slices(batches):
            out = []
            for doc_id, text in rows:
                ids = encode_text(text) + end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    out.append((doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part), part))
            columns = list(zip(*out))[: 6 if keep_ids else 5]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: 6 if keep_ids else 5]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * keep_ids
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return chosen.mapInArrow(encode, schema)


@dataclass
class Plan:
    """Slots: ``count`` pieces of a length, numbered from ``first``, lie at ``offset`` of
    the sequences from ``sequence`` on, one in each."""

    capacity: int
    sequences: int = 0
    length: list[int] = field(default_factory=list)
    first: list[int] = field(default_factory=list)
    sequence: list[int] = field(default_factory=list)
    offset: list[int] = field(default_factory=list)
    taken: dict[int, int] = field(default_factory=dict)

    def new(self, count: int) -> int:
        self.sequences += count
        return self.sequences - count

    def put(self, length: int, count: int, sequence: int, offset: int) -> None:
        self.length.append(length)
        self.first.append(self.taken.get(length, 0))
        self.sequence.append(sequence)
        self.offset.append(offset)
        self.taken[length] = self.taken.get(length, 0) + count

    def arrays(self) -> tuple[np.ndarray, ...]:
        order = np.lexsort((self.first, self.length))
        return tuple(
            np.asarray(x, dtype=np.int64)[order] for x in (self.length, self.first, self.sequence, self.offset)
        )


def linear_groups(counts: dict[int, int], groups: int) -> list[list[list[int]]]:
    """Lengths from the largest down, cut into groups of equal cardinality; each group is
    a list of [length, count], and its first length is the size it is rounded up to."""
    share = -(-sum(counts.values()) // groups)
    found: list[list[list[int]]] = [[]]
    room = share
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            if not room:
                found.append([])
                room = share
            n = min(left, room)
            found[-1].append([length, n])
            left -= n
            room -= n
    return [g for g in found if g]


def fullest(sizes: list[int], demand: list[int], capacity: int) -> list[int]:
    """How often each size (descending) is used: one of the largest in demand, and with
    it what fills the rest best. Reachable sums are the bits of a number."""
    lead = next(i for i, d in enumerate(demand) if d)
    rest = capacity - sizes[lead]
    mask = (1 << (rest + 1)) - 1
    steps = []
    sums = 1
    for i, size in enumerate(sizes):
        for _ in range(min(demand[i] - (i == lead), rest // size)):
            steps.append((i, sums))
            after = (sums | (sums << size)) & mask
            if after == sums:
                break
            sums = after
    use = [0] * len(sizes)
    use[lead] = 1
    left = sums.bit_length() - 1
    for i, before in reversed(steps):
        if not before >> left & 1:
            use[i] += 1
            left -= sizes[i]
    return use


def best_plan(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    plans = (plan_lengths(counts, capacity, part, groups_of(counts, capacity, part, each)) for part, each in PLANS)
    return min(plans, key=lambda p: p.sequences)


def groups_of(counts: dict[int, int], capacity: int, small_part: int, each: int) -> int:
    """Groups of ``each`` large pieces or more."""
    large = sum(c for n, c in counts.items() if capacity // small_part < n < capacity)
    return max(1, min(MOST_GROUPS, large // each))


def plan_lengths(counts: dict[int, int], capacity: int, small_part: int, groups: int) -> Plan:
    """A plan for so many pieces of each length (1 to capacity)."""
    plan = Plan(capacity)
    if counts.get(capacity):
        plan.put(capacity, counts[capacity], plan.new(counts[capacity]), 0)
    gaps: dict[int, list[tuple[int, int, int]]] = {}  # by what is left: sequence, count, fill
    left_mask = 0

    def open_run(sequence: int, count: int, fill: int) -> None:
        nonlocal left_mask
        if fill < capacity:
            gaps.setdefault(capacity - fill, []).append((sequence, count, fill))
            left_mask |= 1 << (capacity - fill)

    limit = capacity // small_part
    large = linear_groups({n: c for n, c in counts.items() if limit < n < capacity and c}, groups)
    sizes = [g[0][0] for g in large]
    demand = [sum(c for _, c in g) for g in large]
    while any(demand):
        use = fullest(sizes, demand, capacity)
        times = min(d // u for d, u in zip(demand, use) if u)
        runs = [(plan.new(times), times, 0)]
        for i, u in enumerate(use):
            demand[i] -= u * times
            for _ in range(u):
                runs = [r for run in runs for r in _substitute(plan, large[i], run)]
        for run in runs:
            open_run(*run)

    for length in range(min(limit, capacity - 1), 0, -1):
        count = counts.get(length, 0)
        while count:
            fitting = left_mask >> length
            if not fitting:
                runs_needed = -(-count // (capacity // length))
                open_run(plan.new(runs_needed), runs_needed, 0)
                continue
            left = length + (fitting & -fitting).bit_length() - 1
            sequence, n, fill = gaps[left].pop()
            if not gaps[left]:
                left_mask &= ~(1 << left)
            each = min(left // length, count)
            used = min(n, count // each)
            for k in range(each):
                plan.put(length, used, sequence, fill + k * length)
            count -= each * used
            open_run(sequence, used, fill + each * length)
            if used < n:
                open_run(sequence + used, n - used, fill)
    return plan


def _substitute(plan: Plan, group: list[list[int]], run: tuple[int, int, int]) -> Iterator[tuple[int, int, int]]:
    """One actual length of the group for each sequence of the run."""
    sequence, count, fill = run
    while count:
        length, there = group[0]
        n = min(count, there)
        plan.put(length, n, sequence, fill)
        yield sequence, n, fill + length
        sequence += n
        count -= n
        group[0][1] -= n
        if not group[0][1]:
            group.pop(0)


def pack(
    docs: DataFrame, tokenizer: str, spaces_dropped: bool = True, end_id: int = END_ID, capacity: int = CAPACITY,
    keep_ids: bool = False, words: int = MAX_WORDS,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset
    (and ids, little-endian unsigned 32-bit).

    A null or empty text is the end id alone; only texts of more than ``capacity`` ids
    are cut. Rows with the same or a null id are packed each for itself. An empty table
    gives no rows. ``words``: how many a Python worker remembers the ids of, which costs
    about 200 bytes each. Texts are encoded once; what is shuffled is one narrow row per piece,
    by its length and a bucket of its id, so that a frequent length meets in no task.
    """
    pieces = cut(pieces_of(docs, tokenizer, spaces_dropped, end_id, capacity, keep_ids, words), "pieces")
    # at most ``capacity`` rows
    counts = {r.length: r["count"] for r in pieces.groupBy("length").count().collect()}
    plan = best_plan(counts, capacity)
    buckets = max(1, int(sum(counts.values()) ** 0.5))
    placed = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)).cast("int"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("length", "bucket").count()
        .select("length", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    )
    within = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "start", "ids_crc32")
    numbered = placed.withColumn("number", F.row_number().over(within)).join(starts, ["length", "bucket"])
    kept = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if keep_ids else [])]
    numbered = numbered.select(*kept, (F.col("number") + F.col("before") - 1).alias("number"))
    slots = plan.arrays()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, firsts, sequences, offsets = slots
        # both parts of the key are non-negative, and numbers stay below 2^48
        keys = (lengths << 48) + firsts
        for batch in batches:
            length = batch.column("length").to_numpy()
            number = batch.column("number").to_numpy()
            at = np.searchsorted(keys, (length << 48) + number, side="right") - 1
            columns = [batch.column(c) for c in kept]
            columns += [pa.array(sequences[at] + number - firsts[at]), pa.array(offsets[at])]
            yield pa.record_batch(columns, names=[*kept, "sequence_id", "offset"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in numbered.schema if f.name in kept)
    return numbered.mapInArrow(place, f"{fields}, sequence_id long, offset long")


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, length and ids of whole sequences, from pieces packed with their ids.
    A sequence has ``capacity`` ids at most."""
    parts = F.array_sort(F.collect_list(F.struct("offset", F.hex("ids").alias("ids"))))
    return packed.groupBy("sequence_id").agg(
        F.sum("length").alias("length"), F.unhex(F.array_join(parts["ids"], "")).alias("ids")
    )


@query("op3_best_fit_packing")
def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
