"""Removal of long repeated byte strings by a sparse enhanced suffix array.

A string of ``length`` bytes that starts anywhere else too holds, at the same place in
both, an anchor: the gram with the least hash among its grams. So only suffixes that
start at anchors are compared. Anchors with the same gram are a group, and occurrences
whose whole surroundings agree are one class of it. A group's classes are sorted by what
follows the anchor; a scan with a stack over the common prefixes of neighbours visits
every interval of the prefix tree, and in each the occurrences are compared by what comes
before them. The left extension two occurrences share and the interval's depth make a
repeat, which is reported for all occurrences that have it.

A group with very many classes is never gathered. For it, ranges of window starts are
halved by counting hashes: a range is dropped if the bytes that all its windows share
occur once, and settled if all the bytes it covers occur elsewhere too.

Passages of so many words are found in the same way in the texts' words, each written as
a checksum of fixed width.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import brief_shuffles, bucketed, cut, table, text_or_empty
from ledgerline.llm.encoding import give_back, slices
from ledgerline.llm.registry import query

LENGTH = 400
GRAM = 128
#: Words from which on a repeated passage goes.
PASSAGE_WORDS = 51
#: Classes up to which a group is gathered: a share of all classes, between two bounds.
SHARE, FEWEST, MOST = 512, 256, 4096
#: Occurrences from which on a class is common, and common classes at most.
COMMON, MOST_COMMON = 256, 4096
#: Texts are searched for anchors in overlapping segments of so many bytes.
SEGMENT = 1 << 20
#: Bytes a word is written as, and words of a gram.
WORD_BYTES, WORD_GRAM = 4, 16
#: Parts a range of window starts is cut into, level by level, and then into single ones.
PARTS = (3, 7)

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_PLACE = np.uint64(SEGMENT - 1)


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A number for each byte; powers of an odd number and of its inverse modulo 2^64."""
    numbers = np.random.default_rng(3).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    base = 0x9E3779B97F4A7C15
    both = []
    for factor in (base, pow(base, -1, 1 << 64)):
        powers = np.full(SEGMENT + 1, factor, np.uint64)
        powers[0] = 1
        both.append(np.cumprod(powers))
    return numbers, *both


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def anchors(raw: bytes, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the anchors of all windows of ``length`` bytes, and their grams' hashes.
    Of equal hashes in a window the first counts, so equal windows have equal anchors."""
    numbers, powers, inverses = _powers()
    width = length - gram + 1
    places, names = [], []
    for at in range(0, max(1, len(raw) - length + 1), SEGMENT - length + 1):
        data = np.frombuffer(raw, np.uint8, min(SEGMENT, len(raw) - at), at)
        if len(data) < length:
            break
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(numbers[data] * powers[: len(data)], out=sums[1:])
        hashes = _mix((sums[gram:] - sums[:-gram]) * inverses[: len(data) - gram + 1])
        n = len(hashes)
        ranked = (hashes & ~_PLACE) | np.arange(n, dtype=np.uint64)
        rows = np.append(ranked, np.full(-n % width, np.iinfo(np.uint64).max, np.uint64)).reshape(-1, width)
        ahead = np.minimum.accumulate(rows, axis=1).ravel()
        back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
        least = np.minimum(back[: n - width + 1], ahead[width - 1 : n]) & _PLACE
        found = least[np.append(True, least[1:] != least[:-1])].astype(np.int64)
        places.append(found + at)
        names.append(hashes[found])
    if not places:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    found, first = np.unique(np.concatenate(places), return_index=True)
    return found, np.concatenate(names)[first]


def common_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    differ = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (differ.bit_length() + 7) // 8


def common_suffix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if not n:
        return 0
    differ = int.from_bytes(a[-n:], "little") ^ int.from_bytes(b[-n:], "little")
    return n - (differ.bit_length() + 7) // 8


def intervals(depths: list[int]) -> Iterator[tuple[int, int, int]]:
    """(depth, first, last) of every interval of the prefix tree of a sorted list, where
    ``depths[i]`` is what entries i and i + 1 have in common. Deeper ones come first."""
    stack: list[tuple[int, int]] = []
    for i, depth in enumerate([*depths, -1]):
        first = i
        while stack and stack[-1][0] > depth:
            inner, first = stack.pop()
            yield inner, first, i
        if depth >= 0 and (not stack or stack[-1][0] < depth):
            stack.append((depth, first))


def extents(before: list[bytes], after: list[bytes], length: int) -> list[tuple[int, int]]:
    """For each occurrence, how far to the left and to the right of its anchor strings of
    ``length`` bytes reach that it shares with another one; (0, 0) if there are none."""
    found = [(0, 0)] * len(after)
    order = sorted(range(len(after)), key=after.__getitem__)
    depths = [common_prefix(after[a], after[b]) for a, b in zip(order, order[1:])]
    leftwards = None
    for depth, first, last in intervals(depths):
        members = order[first : last + 1]
        if len(members) > 2:
            if leftwards is None:
                by_left = sorted(range(len(before)), key=lambda i: before[i][::-1])
                leftwards = {i: rank for rank, i in enumerate(by_left)}
            members.sort(key=leftwards.__getitem__)
        shared = [common_suffix(before[a], before[b]) for a, b in zip(members, members[1:])]
        for k, i in enumerate(members):
            left = max(shared[k - 1] if k else 0, shared[k] if k < len(shared) else 0)
            if left + depth >= length:
                found[i] = (max(found[i][0], left), max(found[i][1], depth))
    return found


def _named(raw: bytes, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the anchors, names of their grams and of their surroundings."""
    places, names = anchors(raw, length, gram)
    around = [
        xxhash.xxh3_64_intdigest(raw[max(0, p + gram - length) : p + length], min(p, length - gram))
        for p in places.tolist()
    ]
    return places, names.view(np.int64), np.array(around, np.uint64).view(np.int64)


def _anchored(docs: DataFrame, carry: list[str], length: int, gram: int, keep: bool) -> DataFrame:
    """A row per document: its bytes, compressed, and its anchors (place, name of the gram,
    name of the surroundings)."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressor = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                out = []
                for text in part.column("__text").to_pylist():
                    raw = text.encode("utf-8", "surrogatepass")
                    found = _named(raw, length, gram)
                    packed = compressor.compress(raw) if keep or len(found[0]) else None
                    out.append((len(raw), hashlib.sha256(raw).hexdigest(), packed, *found))
                columns = [pa.array(c, t) for c, t in zip(zip(*out), types)]
                kept = [part.column(c) for c in ["__row", *carried]]
                yield pa.record_batch([*kept, *columns], names=["__row", *carried, *names_])
        give_back()

    names_ = ["__size", "__sha", "__packed", "__place", "__name", "__around"]
    longs = pa.list_(pa.int64())
    types = [pa.int64(), pa.string(), pa.binary(), longs, longs, longs]
    carried = [f"__c{i}" for i in range(len(carry))]
    chosen = docs.select(
        F.monotonically_increasing_id().alias("__row"), text_or_empty().alias("__text"),
        *[F.col(f"`{c}`").alias(n) for c, n in zip(carry, carried)],
    )
    kinds = ["long", "string", "binary", "array<long>", "array<long>", "array<long>"]
    schema = "__row long, " + "".join(f"{n} {chosen.schema[n].dataType.simpleString()}, " for n in carried)
    return chosen.mapInArrow(find, schema + ", ".join(f"{n} {k}" for n, k in zip(names_, kinds)))


def _in_words(stored: DataFrame, words: int) -> DataFrame:
    """The stored texts as checksums of their words, with the anchors of all windows of so
    many words; texts with fewer are left out."""
    length, gram = words * WORD_BYTES, min(WORD_GRAM, words - 1) * WORD_BYTES

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressor, decompressor = zstandard.ZstdCompressor(level=3), zstandard.ZstdDecompressor()
        for part in slices(batches):
            out = []
            for row, packed in part:
                sums = list(map(zlib.crc32, decompressor.decompress(packed).split()))
                if len(sums) >= words:
                    raw = np.array(sums, "<u4").tobytes()
                    out.append((row, len(raw), compressor.compress(raw), *_named(raw, length, gram)))
            if out:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    names = ["__row", "__size", "__packed", "__place", "__name", "__around"]
    longs = pa.list_(pa.int64())
    types = [pa.int64(), pa.int64(), pa.binary(), longs, longs, longs]
    return stored.select("__row", "__packed").where("__packed IS NOT NULL").mapInArrow(
        find, "__row long, __size long, __packed binary, __place array<long>, __name array<long>, __around array<long>"
    )


def _surroundings(stored: DataFrame, wanted: DataFrame, length: int, gram: int) -> DataFrame:
    """name, row, place, single, before, after of the wanted classes (row, name, around,
    single), each at its representative."""

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decompressor = zstandard.ZstdDecompressor()
        for part in slices(batches, 64):
            out = []
            for row, packed, places, names, around, asked in part:
                raw = decompressor.decompress(packed)
                at = dict(zip(zip(names, around), places))
                for x in asked:
                    p = at[x["name"], x["around"]]
                    out.append((x["name"], row, p, x["single"], raw[max(0, p + gram - length) : p], raw[p : p + length]))
            if out:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), types)], names=columns)

    columns = ["name", "row", "place", "single", "before", "after"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.binary()]
    lists = wanted.groupBy(F.col("row").alias("__row")).agg(F.collect_list(F.struct("name", "around", "single")).alias("asked"))
    return stored.select("__row", "__packed", "__place", "__name", "__around").join(lists, "__row").mapInArrow(
        fetch, "name long, row long, place long, single boolean, before binary, after binary"
    )


def _gathered(around: DataFrame, length: int) -> DataFrame:
    """Repeats (row, start, end) of single classes in groups that fit in memory."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[tuple] = []

        def repeats() -> Iterator[tuple[int, int, int]]:
            if len(group) > 1:
                reach = extents([g[4] for g in group], [g[5] for g in group], length)
                for (_, row, place, single, _, _), (left, right) in zip(group, reach):
                    if single and right:
                        yield row, place - left, place + right

        out: list[tuple] = []
        for part in slices(batches, 1024):
            for x in part:
                if group and group[0][0] != x[0]:
                    out.extend(repeats())
                    group = []
                group.append(x)
            if len(out) > 4096:
                yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*out)], names=["row", "start", "end"])
                out = []
        out.extend(repeats())
        if out:
            yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*out)], names=["row", "start", "end"])

    tasks = int(around.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return around.repartition(tasks, "name").sortWithinPartitions("name").mapInArrow(
        scan, "row long, start long, end long"
    )


def split(lo: int, hi: int, parts: int) -> list[tuple[int, int]]:
    """The range from lo to hi in so many parts, or as many as it has numbers."""
    n = hi - lo + 1
    parts = min(parts, n)
    edges = [lo + n * i // parts for i in range(parts + 1)]
    return [(x, y - 1) for x, y in zip(edges, edges[1:])]


def _keys(asked: DataFrame, length: int, parts: int) -> DataFrame:
    """For every part of the asked ranges of window starts (counted leftwards from the
    anchor): the hash of the bytes all its windows share, and of the bytes they cover."""

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 128):
            out = []
            for name, row, place, single, before, after, ranges in part:
                whole, p = before + after, len(before)
                for r in ranges:
                    for lo, hi in split(r["lo"], r["hi"], parts):
                        if max(lo, length - len(after)) > min(hi, p):
                            continue  # no window of the range lies in the text
                        seed = (name ^ (lo * 1024 + hi)) & 0xFFFFFFFFFFFFFFFF
                        core = xxhash.xxh3_64_intdigest(whole[max(0, p - lo) : p - hi + length], seed)
                        inside = hi <= p and length - lo <= len(after)
                        cover = xxhash.xxh3_64_intdigest(whole[p - hi : p - lo + length], ~seed) if inside else None
                        out.append((row, place, single, lo, hi, core, cover))
            if out:
                columns = list(zip(*out))
                signed = [[v if v is None or v < 1 << 63 else v - (1 << 64) for v in c] for c in columns[5:]]
                yield pa.record_batch(
                    [pa.array(c, t) for c, t in zip([*columns[:5], *signed], types)], names=names
                )

    names = ["row", "place", "single", "lo", "hi", "core", "cover"]
    types = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
    schema = "row long, place long, single boolean, lo long, hi long, core long, cover long"
    columns = ["name", "row", "place", "single", "before", "after", "ranges"]
    return asked.select(*columns).mapInArrow(hashes, schema)


def _counted(around: DataFrame, length: int, gram: int) -> DataFrame:
    """Repeats (row, start, end) of single classes of groups of any size."""
    asked = around.withColumn(
        "ranges", F.array(F.struct(F.lit(0).cast("long").alias("lo"), F.lit(length - gram).cast("long").alias("hi")))
    )
    settled: list[DataFrame] = []
    for parts in (*PARTS, length):
        made = cut(_keys(asked, length, parts), "keys")
        cores = cut(made.groupBy("core").agg(F.count("*").alias("n")).where("n > 1").select("core"), "cores")
        covers = cut(
            made.where("cover IS NOT NULL").groupBy(F.col("cover").alias("known")).agg(F.count("*").alias("n"))
            .where("n > 1").select("known"), "covers")
        alive = made.join(cores, "core").join(covers, made["cover"] == covers["known"], "left")
        alive = cut(alive.drop("core").withColumn("all", F.col("known").isNotNull()).drop("known"), "alive")
        settled.append(alive.where("all AND single").select("row", "place", "lo", "hi"))
        # what is settled stays as a partner, one occurrence for all that agree
        one = alive.where("all").groupBy("cover").agg(F.min(F.struct("row", "place", "lo", "hi")).alias("o")).select("o.*")
        going_on = alive.where("NOT all").select("row", "place", "lo", "hi").union(one).where("lo < hi")
        lists = going_on.groupBy(F.col("row").alias("r"), F.col("place").alias("p")).agg(
            F.collect_list(F.struct("lo", "hi")).alias("ranges")
        )
        asked = around.join(lists, (around["row"] == F.col("r")) & (around["place"] == F.col("p")))
    spans = settled[0]
    for more in settled[1:]:
        spans = spans.union(more)
    return spans.groupBy("row", "place").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).select(
        "row",
        F.greatest(F.col("place") - F.col("hi"), F.lit(0)).alias("start"),
        (F.col("place") - F.col("lo") + length).alias("end"),
    )


def _common(stored: DataFrame, classes: list[tuple[int, int]], length: int, gram: int) -> DataFrame:
    """Repeats (row, start, end) at the anchors of these classes (name, around), those of a
    text that overlap as one."""

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, some = set(classes), np.unique([name for name, _ in classes])
        for batch in batches:
            counts = np.diff(batch.column("__place").offsets.to_numpy())
            place, name, around = (batch.column(c).flatten().to_numpy() for c in ("__place", "__name", "__around"))
            near = np.flatnonzero(np.isin(name, some))
            hit = near[[x in wanted for x in zip(name[near].tolist(), around[near].tolist())]] if len(near) else near
            if not len(hit):
                continue
            of = np.repeat(np.arange(batch.num_rows), counts)[hit]
            starts = np.maximum(place[hit] - (length - gram), 0)
            ends = np.minimum(place[hit] + length, batch.column("__size").to_numpy()[of])
            # by two words at least, so that in words too nothing lies between them
            opens = np.append(True, (of[1:] != of[:-1]) | (starts[1:] + 2 * WORD_BYTES > ends[:-1]))
            closes = np.append(opens[1:], True)
            columns = [batch.column("__row").to_numpy()[of[opens]], starts[opens], ends[closes]]
            yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], names=["row", "start", "end"])
        give_back()

    return stored.select("__row", "__size", "__place", "__name", "__around").mapInArrow(
        look_up, "row long, start long, end long"
    )


def _spans(stored: DataFrame, length: int, gram: int) -> DataFrame:
    """Repeats (row, start, end), overlapping ones among them."""
    each = stored.select(
        F.col("__row").alias("row"), F.col("__size").alias("size"),
        F.explode(F.arrays_zip("__place", "__name", "__around")).alias("a"),
    ).select("row", "size", F.col("a.__place").alias("place"), F.col("a.__name").alias("name"),
             F.col("a.__around").alias("around"))
    classes = each.groupBy("name", "around").agg(F.count("*").alias("n"), F.min("row").alias("row"))
    # what stands alone in its group and occurs once is no repeat
    groups = classes.groupBy("name").agg(F.count("*").alias("classes"), F.max("n").alias("most"))
    groups = cut(groups.where("classes > 1 OR most > 1"), "groups")
    found = cut(classes.join(groups, "name").select("name", "around", "n", "row", "classes"), "classes")
    several = found.where("n > 1")
    # the most common ones are looked up in each text; a passage that every text has would
    # be a row for each of its anchors in each text
    often = several.where(F.col("n") >= COMMON).orderBy(F.desc("n")).limit(MOST_COMMON).select("name", "around", "n").collect()
    bound = often[-1].n + 1 if len(often) == MOST_COMMON else COMMON
    known = [(r.name, r.around) for r in often if r.n >= bound]
    several = several.where(F.col("n") < bound).select("name", "around")
    whole = each.join(several, ["name", "around"]).select(
        "row",
        F.greatest(F.col("place") - (length - gram), F.lit(0)).alias("start"),
        F.least(F.col("place") + length, "size").alias("end"),
    )
    if known:
        whole = whole.union(_common(stored, known, length, gram))
    compared = found.where("classes > 1")
    limit = min(MOST, max(FEWEST, compared.count() // SHARE))
    wanted = compared.select("row", "name", "around", (F.col("n") == 1).alias("single"), "classes")
    small = _gathered(_surroundings(stored, wanted.where(F.col("classes") <= limit), length, gram), length)
    spans = whole.union(small)
    large = wanted.where(F.col("classes") > limit)
    if not large.isEmpty():
        spans = spans.union(_counted(cut(_surroundings(stored, large, length, gram), "large"), length, gram))
    return spans.where(F.col("end") - F.col("start") >= length)


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs that the spans cover, in order."""
    runs: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if runs and start <= runs[-1][1]:
            if end > runs[-1][1]:
                runs[-1] = (runs[-1][0], end)
        else:
            runs.append((start, end))
    return runs


def word_edges(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where each word starts and ends; words are what ``raw.split()`` gives."""
    data = np.frombuffer(raw, np.uint8)
    inside = np.concatenate(([False], (data != 32) & ((data < 9) | (data > 13)), [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[::2], edges[1::2]


def whole_characters(raw: bytes, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The runs without the parts of characters at their ends, so that text stays text."""
    found = []
    for start, end in runs:
        while start < end and raw[start] & 0xC0 == 0x80:
            start += 1
        while end > start and end < len(raw) and raw[end] & 0xC0 == 0x80:
            end -= 1
        if start < end:
            found.append((start, end))
    return found


def without_repeats(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, carry: tuple[str, ...] = ("doc_id",),
    keep_text: bool = False, words: int | None = None, text_words: int | None = None,
) -> DataFrame:
    """One row per input row: the carried columns, n_bytes, n_removed, n_spans,
    kept_sha256, spans (start, end of the maximal removed runs) and, with ``keep_text``,
    kept_text, from which only whole characters are removed.

    Removed is each byte covered by a string of ``length`` bytes that also starts anywhere
    else in the table, in the same text too; strings are judged on the input. A null text
    is empty; texts shorter than ``length`` keep everything; rows with the same id are
    texts of their own, so repeated rows lose everything. An empty table gives no rows.
    With ``words``, passages of so many words that also start elsewhere go too, from the
    first word's start to the last one's end, whatever white space is between the words.
    With ``text_words`` all this stays as it is without ``words``, and there is a column
    text more: what is left when passages of so many words go too, whole characters only.

    The texts are moved once, compressed, and written dealt by row; then a narrow row per
    anchor, and the surroundings of one occurrence of each class in groups of several.
    """
    if length <= gram:
        raise ValueError("a gram must be shorter than the strings looked for")
    if words is not None and text_words is not None:
        raise ValueError("words are either for all columns or for the text only")
    least = text_words if words is None else words
    stored = bucketed(_anchored(docs, list(carry), length, gram, keep_text or least is not None), "__row")
    spans = _spans(stored, length, gram).withColumn("by_word", F.lit(False))
    if least is not None:
        # narrow rows are written, so that no two shuffles of texts are there at a time
        spans = cut(spans, "spans")
        coded = bucketed(_in_words(stored, least), "__row", move=False)
        passages = _spans(coded, least * WORD_BYTES, min(WORD_GRAM, least - 1) * WORD_BYTES)
        spans = spans.union(cut(passages.select(
            "row", F.ceil(F.col("start") / WORD_BYTES).alias("start"), F.floor(F.col("end") / WORD_BYTES).alias("end"),
            F.lit(True).alias("by_word")), "passages"))
    lists = spans.distinct().groupBy(F.col("row").alias("__row")).agg(
        F.collect_list(F.struct("start", "end", "by_word")).alias("__spans")
    )
    carried = [f"__c{i}" for i in range(len(carry))]

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decompressor = zstandard.ZstdDecompressor()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                out = []
                for size, sha, packed, spans in zip(*[part.column(c).to_pylist() for c in own]):
                    texts = []
                    raw = decompressor.decompress(packed) if spans or with_text else b""
                    found = [(x["start"], x["end"]) for x in spans or [] if not x["by_word"]]
                    passages = merged([(x["start"], x["end"]) for x in spans or [] if x["by_word"]])
                    both = found = merged(found)
                    if passages and found != [(0, size)]:  # else nothing is left to look at
                        starts, ends = word_edges(raw)
                        both = merged(found + [(int(starts[x]), int(ends[y - 1])) for x, y in passages])
                    runs = found if words is None else both
                    if runs:
                        sha = hashlib.sha256(_kept(raw, runs)).hexdigest()
                    if keep_text:
                        texts.append(_kept(raw, whole_characters(raw, runs)).decode("utf-8", "surrogatepass"))
                    if text_words is not None:
                        same = keep_text and both == runs
                        left = texts[0] if same else _kept(raw, whole_characters(raw, both)).decode("utf-8", "surrogatepass")
                        texts.append(left)
                    removed = sum(y - x for x, y in runs)
                    out.append((size, removed, len(runs), sha, [{"start": x, "end": y} for x, y in runs], *texts))
                columns = [pa.array(c, t) for c, t in zip(zip(*out), types)]
                kept = [part.column(c) for c in carried]
                yield pa.record_batch([*kept, *columns], names=[*carried, *names])
        give_back()

    own = ["__size", "__sha", "__packed", "__spans"]
    with_text = ["kept_text"] * keep_text + ["text"] * (text_words is not None)
    names = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", *with_text]
    run = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(run), *[pa.string()] * len(with_text)]
    schema = "".join(f"{c} {stored.schema[c].dataType.simpleString()}, " for c in carried)
    schema += "n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start: long, end: long>>"
    schema += "".join(f", {n} string" for n in with_text)
    done = stored.select("__row", *carried, *own[:3]).join(lists, "__row", "left").select(*carried, *own)
    result = done.mapInArrow(remove, schema)
    return result.select(*[F.col(c).alias(n) for c, n in zip(carried, carry)], *names)


def _kept(raw: bytes, runs: list[tuple[int, int]]) -> bytes:
    edges = [0, *(e for run in runs for e in run), len(raw)]
    return b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2]))


@query("op1_repeat_removal")
def op1_repeat_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    with brief_shuffles(spark):
        made = without_repeats(docs, keep_text=True, text_words=PASSAGE_WORDS)
    return made.drop("spans")
