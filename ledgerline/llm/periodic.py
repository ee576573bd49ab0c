"""Runs of words that repeat with a period, from Lyndon roots.

A run is a longest stretch of words with a period of at most half its length. In one of
the two orders of the words, the longest Lyndon word at some place of the run is its root,
as long as the period. So the Lyndon words at all places are found in both orders, by the
grouping phase of Baier's suffix sorter alone, and each is extended to both sides as far
as the words one root apart are equal. A root whose extensions reach its own length again
is a run.

Every word of a run of at least ``min_length`` words lies in a gram of half that length
that its document holds twice, one period apart. Only stretches of such words, which no
run leaves, are grouped.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import table
from ledgerline.llm.registry import query

MIN_LENGTH = 12
#: Texts that are searched together, in bytes; a longer one is searched alone.
TOGETHER = 4_000_000
#: Fingerprints are taken modulo this prime, below 2^32.
PRIME = 4_294_967_291
MIX = np.uint64(0x9E3779B97F4A7C15)

Run = tuple[int, int, int]
Prepare = Callable[[int | None, list[bytes]], list[bytes]]


def lyndon_lengths(letters: list[int], descending: bool = False) -> list[int]:
    """Length of the longest Lyndon word at each place, the end being the smallest letter.

    Places are grouped by a common beginning, at first their letter, and groups taken from
    the greatest down. A place in a group that is taken is final: its beginning is its
    Lyndon word. The next open place to the left begins with a smaller group, and the word
    continues it: by as many repetitions as there are places that have it as their next
    open one. Those continued alike leave their group for one directly above it.
    """
    n = len(letters)
    by_letter: dict[int, list[int]] = defaultdict(list)
    for place, letter in enumerate(letters):
        by_letter[letter].append(place)
    members = [by_letter[letter] for letter in sorted(by_letter, reverse=descending)]
    sizes = [1] * len(members)
    below = list(range(-1, len(members) - 1))
    above = [*range(1, len(members)), -1]
    group = [0] * n
    for g, places in enumerate(members):
        for place in places:
            group[place] = g
    # the open places as a chain; its last entry stands for both of its ends
    left, right = [*range(-1, n - 1), n - 1], [*range(1, n + 1), 0]
    lengths = [0] * n
    g = len(members) - 1
    while g >= 0:
        size = sizes[g]
        continued: dict[int, int] = {}
        for place in members[g]:
            if group[place] != g:
                continue
            lengths[place] = size
            before, after = left[place], right[place]
            right[before] = after
            left[after] = before
            if before >= 0:
                continued[before] = continued.get(before, 0) + 1
        if len(continued) > 1:
            # more repetitions are greater; among equals the places stay ascending
            continued = dict(sorted(continued.items(), key=lambda item: -item[1]))
        made: dict[tuple[int, int], int] = {}
        for place, times in continued.items():
            old = group[place]
            new = made.get((old, times))
            if new is None:
                new = made[old, times] = len(sizes)
                sizes.append(sizes[old] + times * size)
                members.append([])
                over = above[old]
                below.append(old)
                above.append(over)
                below[over] = above[old] = new
            members[new].append(place)
            group[place] = new
        g = below[g]
    return lengths


class _Fingerprints:
    """Equality of stretches of ``codes`` by fingerprints: equal ones always agree."""

    def __init__(self, codes: np.ndarray, base: int) -> None:
        n = len(codes)
        self.powers = np.ones(n + 1, dtype=np.uint64)
        have = 1
        while have <= n:
            part = self.powers[have : 2 * have]
            part[:] = self.powers[: len(part)] * np.uint64(pow(base, have, PRIME)) % np.uint64(PRIME)
            have *= 2
        terms = codes.astype(np.uint64) % np.uint64(PRIME) * self.powers[:n] % np.uint64(PRIME)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms) % np.uint64(PRIME)])

    def same(self, a: np.ndarray, b: np.ndarray, length: int) -> np.ndarray:
        """Whether ``length`` codes from a equal those from b, which is behind a."""
        prime = np.uint64(PRIME)
        first = (self.sums[a + length] + prime - self.sums[a]) % prime
        second = (self.sums[b + length] + prime - self.sums[b]) % prime
        return first * self.powers[b - a] % prime == second

    def common(self, a: np.ndarray, b: np.ndarray, forward: bool) -> np.ndarray:
        """How many codes from a on (or before it) equal those from b on (or before it)."""
        n = len(self.sums) - 1
        room = n - b if forward else a
        found = np.zeros(len(a), dtype=np.int64)
        step = 1 << int(room.max(initial=0)).bit_length()
        while step:
            may = np.nonzero(found + step <= room)[0]
            offset = found[may] if forward else -found[may] - step
            more = may[self.same(a[may] + offset, b[may] + offset, step)]
            found[more] += step
            step >>= 1
        return found


def _extended(codes: np.ndarray, roots: np.ndarray, lengths: np.ndarray, min_length: int, base: int) -> np.ndarray | None:
    """The runs of the roots as rows (start, length, period), or None where a fingerprint
    took unequal stretches for equal ones."""
    ends = roots + lengths
    inside = ends < len(codes)
    roots, lengths, ends = roots[inside], lengths[inside], ends[inside]
    touching = codes[roots] == codes[ends]
    touching[roots > 0] |= codes[roots[roots > 0] - 1] == codes[ends[roots > 0] - 1]
    roots, lengths, ends = roots[touching], lengths[touching], ends[touching]
    prints = _Fingerprints(codes, base)
    after, before = prints.common(roots, ends, True), prints.common(roots, ends, False)
    whole = before + lengths + after
    run = (whole >= 2 * lengths) & (whole >= min_length)
    rows = np.unique(np.stack([roots - before, whole, lengths], axis=1)[run], axis=0)
    for start, length, period in rows.tolist():
        end = start + length
        if not np.array_equal(codes[start : end - period], codes[start + period : end]):
            return None
        if start and codes[start - 1] == codes[start - 1 + period] or end < len(codes) and codes[end] == codes[end - period]:
            return None
    return rows


def _stretches(codes: np.ndarray, owner: np.ndarray, ends: np.ndarray, min_length: int) -> list[tuple[int, int]]:
    """Longest stretches of words in grams that their document holds more than once. Grams
    are compared by hashes, which may only make stretches longer."""
    gram = -(-min_length // 2)
    n = len(codes) - gram + 1
    if n <= 0:
        return []
    mixed = (codes.astype(np.uint64) + np.uint64(1)) * MIX
    mixed ^= mixed >> np.uint64(29)
    names = owner[:n].astype(np.uint64) * MIX
    for i in range(gram):
        names = names * np.uint64(0x100000001B3) + mixed[i : i + n]
    whole = np.nonzero(ends[owner[:n]] >= np.arange(n) + gram)[0]
    order = whole[np.argsort(names[whole])]
    equal = names[order][1:] == names[order][:-1]
    repeated = np.zeros(len(order), dtype=bool)
    repeated[1:] |= equal
    repeated[:-1] |= equal
    edge = np.zeros(len(codes) + 1, dtype=np.int64)
    edge[order[repeated]] += 1
    edge[order[repeated] + gram] -= 1
    covered = np.cumsum(edge[:-1]) > 0
    first = covered.copy()
    first[1:] &= ~covered[:-1] | (owner[1:] != owner[:-1])
    last = covered.copy()
    last[:-1] &= ~covered[1:] | (owner[1:] != owner[:-1])
    pairs = zip(np.nonzero(first)[0].tolist(), (np.nonzero(last)[0] + 1).tolist())
    return [(a, b) for a, b in pairs if b - a >= min_length]


def find_runs(documents: list[list[bytes]], min_length: int = MIN_LENGTH) -> list[list[Run]]:
    """For each document its runs of at least ``min_length`` words as (start, length,
    period), by start and then period."""
    names: dict[bytes, int] = defaultdict()
    names.default_factory = names.__len__
    codes = np.fromiter(map(names.__getitem__, chain.from_iterable(documents)), dtype=np.int64)
    sizes = np.array([len(d) for d in documents], dtype=np.int64)
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(documents)), sizes)
    found: list[list[Run]] = [[] for _ in documents]
    stretches = _stretches(codes, owner, ends, min_length)
    if not stretches:
        return found
    parts, places, lengths, shifts, at = [], [], [], [], 0
    for k, (a, b) in enumerate(stretches):
        words = codes[a:b].tolist()
        # a code of its own after each stretch: nothing extends across
        parts += [codes[a:b], [len(names) + k]]
        for descending in (False, True):
            places.append(np.arange(at, at + b - a))
            lengths.append(lyndon_lengths(words, descending))
        shifts.append(at)
        at += b - a + 1
    joined = np.concatenate(parts).astype(np.int64) + 1
    roots, sizes_of_roots = np.concatenate(places), np.concatenate(lengths).astype(np.int64)
    rows, base = None, 1_000_003
    while rows is None:
        rows = _extended(joined, roots, sizes_of_roots, min_length, base)
        base += 1_000_000
    which = np.searchsorted(np.array(shifts), rows[:, 0], side="right") - 1
    for k, (start, length, period) in zip(which.tolist(), rows.tolist()):
        place = stretches[k][0] + start - shifts[k]
        document = int(owner[place])
        found[document].append((place - int(ends[document] - sizes[document]), length, period))
    return [sorted(runs, key=lambda r: (r[0], r[2])) for runs in found]


def collapsed_words(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words without those that a run holds after its first period."""
    if not runs:
        return words
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    return [words[i] for i in np.nonzero(np.cumsum(edge[:-1]) == 0)[0].tolist()]


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[bytes]]]:
    ids: list = []
    texts: list[bytes] = []
    size = 0
    for batch in batches:
        for doc_id, text in zip(batch.column(0), batch.column(1).cast(pa.binary())):
            ids.append(doc_id.as_py())
            texts.append(text.as_py() or b"")
            size += len(texts[-1])
            if size >= TOGETHER:
                yield ids, texts
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def periodic_runs(
    docs: DataFrame, key: str = "doc_id", min_length: int = MIN_LENGTH, prepare: Prepare | None = None
) -> DataFrame:
    """One row per document: the key, ``runs`` (array of start, length and period, in
    words from 0, by start and period) and ``collapsed``: the words, joined by one blank,
    without those that a run holds after its first period.

    Words are what stands between ASCII white space. ``prepare`` changes the words of a
    row before they are searched. A null or empty text has no runs and an empty text left;
    rows with the same or a null key are documents of their own; an empty table gives no
    rows; further columns are not read. A document is searched where it lies: nothing is
    shuffled, and memory follows the longest document.
    """
    schema = f"{key} long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    run = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in _together(batches):
            words = [t.split() for t in texts]
            if prepare:
                words = [prepare(i, w) for i, w in zip(ids, words)]
            runs = find_runs(words, min_length)
            left = [b" ".join(collapsed_words(w, r)).decode() for w, r in zip(words, runs)]
            as_rows = [[dict(zip(("start", "length", "period"), r)) for r in found] for found in runs]
            columns = [pa.array(ids, pa.int64()), pa.array(as_rows, run), pa.array(left, pa.string())]
            yield pa.record_batch(columns, names=[key, "runs", "collapsed"])

    return docs.select(F.col(f"`{key}`").cast("long").alias(key), F.col("text").cast("string")).mapInArrow(search, schema)


def made_periodic(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words of a document as the query has them: in one of ten, by its id, those
    from some place on repeat."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    first = g % n
    period = 1 + (n - first) // (3 + g % 8)
    unit = words[first : first + period]
    times = -(-(n - first) // period)
    return words[:first] + (unit * times)[: n - first]


@query("op11_periodic_runs")
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(table(spark, sf_dir, "documents"), prepare=made_periodic)
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("s"), r["period"].alias("p"))))
    lines = F.transform(
        "runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    )
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.s").alias("start"),
        (-F.col("best.l")).alias("length"),
        F.col("best.p").alias("period"),
        F.expr("(-1000 * best.l) div best.p").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"),
    )
