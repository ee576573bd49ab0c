"""Near-duplicate documents by min-max hashing of word shingles.

Every permutation of the shingles' hashes gives two values of the signature, the least
and the greatest, so half as many permutations are evaluated. Bands of the signature name
buckets; links are confirmed on full sets of shingles. Equal sets are one node from the
start. Within a bucket, members are first compared with the smallest one. Buckets that
then still have members of several components are compared member by member, in tiles of
bounded size that return connecting links only. So no pair that meets in a bucket is
given up unless both are known to be connected, and no table of all pairs is made.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.llm.common import bucketed, cut, table, text_or_empty
from ledgerline.llm.encoding import give_back, slices
from ledgerline.llm.graph import components
from ledgerline.llm.registry import query

#: Rows of a band, each the least or the greatest value of a permutation, and bands. Two
#: sets with a similarity of 0.8 meet in no bucket with probability 5e-6.
ROWS = 6
BANDS = 40
#: Members of a bucket in one block; blocks are compared two by two.
BLOCK = 1024
#: Hashes of words kept by a Python worker.
MAX_WORDS = 400_000

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_LEFT, _RIGHT = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= MAX_WORDS:
            self.clear()
        value = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 64:
            self[word] = value
        return value


_HASHES = _Hashes()


def _word_hashes() -> _Hashes:
    return _HASHES


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers in which every bit depends on every other."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str, size: int) -> np.ndarray:
    """Sorted hashes of the distinct shingles of a text, lower-cased in A-Z; with fewer
    words than a shingle has, the whole sequence is one."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(_word_hashes().__getitem__, words), np.uint64, len(words))
    k = min(size, len(words))
    n = len(words) - k + 1
    joined = _mix(hashes[:n] + np.uint64(k))
    for i in range(1, k):
        joined = _mix(joined * _LEFT + hashes[i : i + n] * _RIGHT)
    return np.unique(joined)


def _permutations(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Fixed by the seed: signatures of different jobs can be compared."""
    draw = np.random.default_rng(20_240_613)
    odd = draw.integers(0, 1 << 63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return odd[:, None], draw.integers(0, 1 << 63, count, dtype=np.uint64)[:, None]


def min_max_bands(shingles: np.ndarray, factors: np.ndarray, masks: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit name for each band; the two values of a permutation are in one band."""
    least = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    greatest = np.zeros(len(factors), np.uint64)
    for at in range(0, len(shingles), 4096):
        values = (shingles[at : at + 4096] ^ masks) * factors
        np.minimum(least, values.min(axis=1), out=least)
        np.maximum(greatest, values.max(axis=1), out=greatest)
    signature = np.stack([least, greatest], axis=1).reshape(-1, rows)
    names = _mix(np.arange(len(signature), dtype=np.uint64) + np.uint64(1))
    for i in range(rows):
        names = _mix(names * _LEFT + signature[:, i])
    return names


def signatures(docs: DataFrame, shingle: int, rows: int, bands: int, carry: tuple[str, ...] = ()) -> DataFrame:
    """row, doc_id, n_shingles, set_key (equal for equal sets, null for empty ones),
    bands, the text, compressed, and the carried columns as __c0, __c1 and so on."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors, masks = _permutations(rows * bands // 2)
        compressor = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                out = []
                for row, doc_id, text in zip(*[part.column(c).to_pylist() for c in ("row", "doc_id", "text")]):
                    found = shingle_set(text, shingle)
                    n = len(found)
                    key = xxhash.xxh3_128_digest(found.tobytes()) if n else None
                    names = min_max_bands(found, factors, masks, rows).view(np.int64) if n else None
                    out.append((row, doc_id, n, key, names, compressor.compress(text.encode("utf-8", "surrogatepass"))))
                columns = [pa.array(c, t) for c, t in zip(zip(*out), types)]
                yield pa.record_batch([*columns, *[part.column(c) for c in carried]], names=[*names_, *carried])
        give_back()

    names_ = ["row", "doc_id", "n_shingles", "set_key", "bands", "packed"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.binary()]
    carried = [f"__c{i}" for i in range(len(carry))]
    chosen = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
        text_or_empty().alias("text"), *[F.col(f"`{c}`").alias(n) for c, n in zip(carry, carried)],
    )
    schema = "row long, doc_id long, n_shingles long, set_key binary, bands array<long>, packed binary"
    return chosen.mapInArrow(
        sign, schema + "".join(f", {n} {chosen.schema[n].dataType.simpleString()}" for n in carried)
    )


def _sets(texts: DataFrame, shingle: int) -> DataFrame:
    """(node, bands, packed) to (node, bands, shingles)."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decompressor = zstandard.ZstdDecompressor()
        for part in slices(batches):
            nodes, bands, texts_ = zip(*part)
            found = [
                shingle_set(decompressor.decompress(packed).decode("utf-8", "surrogatepass"), shingle).view(np.int64)
                for packed in texts_
            ]
            longs = pa.list_(pa.int64())
            yield pa.record_batch(
                [pa.array(nodes, pa.int64()), pa.array(bands, longs), pa.array(found, longs)],
                names=["node", "bands", "shingles"],
            )

    return texts.mapInArrow(unpack, "node long, bands array<long>, shingles array<long>")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of the pairs (a, b) those with 100 * intersection >= percent * union. ``sets`` are
    dealt by node and stay where they are; those of the first nodes are written for
    themselves, so that a node with many pairs is split."""
    chosen = pairs.select(F.col("a").alias("node")).distinct()
    first = cut(
        sets.join(chosen, "node", "left_semi").select(F.col("node").alias("a"), F.col("shingles").alias("of_a")), "firsts"
    )
    second = sets.select(F.col("node").alias("b"), F.col("shingles").alias("of_b"))
    common = F.size(F.array_intersect("of_a", "of_b"))
    return (
        pairs.join(first, "a").join(second, "b")
        .select("a", "b", common.alias("common"), (F.size("of_a") + F.size("of_b") - common).alias("either"))
        .where(F.col("common") * 100 >= F.col("either") * percent)
        .select("a", "b")
    )


def _open_pairs(tile: pa.Table, roots: np.ndarray, percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """Places of rows of one bucket, or two blocks of it, each with those of later rows that
    it may be linked with: nothing connects them in ``roots``, which may change meanwhile,
    and this is the first bucket that both share."""
    sizes, blocks = tile.column("n").to_numpy(), tile.column("block").to_numpy()
    bands = tile.column("bands").combine_chunks().flatten().to_numpy().reshape(tile.num_rows, -1)
    own = int(np.argmax(bands[0] == tile.column("name")[0].as_py()))
    apart = tile.column("lo")[0].as_py() != tile.column("hi")[0].as_py()
    for i in range(tile.num_rows - 1):
        later = slice(i + 1, None)
        open_ones = (roots[later] != roots[i]) & (
            np.minimum(sizes[later], sizes[i]) * 100 >= np.maximum(sizes[later], sizes[i]) * percent
        )
        if apart:
            open_ones &= blocks[later] != blocks[i]
        others = np.nonzero(open_ones)[0] + i + 1
        if not len(others):
            continue
        others = others[np.argmax(bands[others] == bands[i], axis=1) == own]
        if len(others):
            yield i, others


def _tile_open(tile: pa.Table, percent: int) -> pa.Table:
    """The rows of a tile that have an open pair there; the others need no sets."""
    wanted = np.zeros(tile.num_rows, bool)
    for i, others in _open_pairs(tile, tile.column("root").to_numpy(), percent):
        wanted[i] = True
        wanted[others] = True
    return tile.filter(pa.array(wanted)).drop_columns(["bands"])


def _tile_links(tile: pa.Table, percent: int) -> Iterator[tuple[int, int]]:
    """Links that connect what the rows of a tile can connect. A pair is compared in the
    first bucket it shares, and only if nothing connects it yet."""
    nodes, roots = tile.column("node").to_numpy(), tile.column("root").to_numpy().copy()
    sizes = tile.column("n").to_numpy()
    bits = None
    for i, others in _open_pairs(tile, roots, percent):
        if bits is None:
            bits = _bit_rows(tile.column("shingles").combine_chunks(), len(nodes))
        common = np.bitwise_count(bits[others] & bits[i]).sum(axis=1, dtype=np.int64)
        linked = others[common * 100 >= (sizes[others] + sizes[i] - common) * percent]
        for j in linked.tolist():
            if roots[j] != roots[i]:
                yield int(nodes[i]), int(nodes[j])
                roots[roots == roots[j]] = roots[i]


def _bit_rows(sets: pa.ListArray, rows: int) -> np.ndarray:
    """A row of bits for each set, a bit for each shingle that two sets have."""
    values = sets.flatten().to_numpy()
    of = np.repeat(np.arange(rows), np.diff(sets.offsets.to_numpy()))
    known, at, counts = np.unique(values, return_inverse=True, return_counts=True)
    place = np.cumsum(counts > 1) - 1
    shared = (counts > 1)[at]
    width = -(-max(1, int(place[-1]) + 1) // 64) if len(known) else 1
    bits = np.zeros((rows, width * 64), bool)
    bits[of[shared], place[at[shared]]] = True
    return np.packbits(bits, axis=1).view(np.uint64)


def links_of(buckets: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that connect what the buckets (name, node, n) can connect."""
    # first every member with the smallest one: for equal-sized families that is all
    centres = cut(buckets.groupBy("name").agg(F.min(F.struct("node", "n")).alias("c")), "centres")
    pairs = (
        buckets.join(centres, "name").where("node <> c.node")
        # a set that is too small for the other cannot reach the similarity
        .where(F.least("n", "c.n") * 100 >= F.greatest("n", "c.n") * percent)
        .select(F.col("c.node").alias("a"), F.col("node").alias("b")).distinct()
    )
    links = cut(_confirmed(cut(pairs, "pairs"), sets, percent), "links")
    roots = components(links).withColumnRenamed("node", "of")
    labelled = cut(
        buckets.join(roots, buckets["node"] == roots["of"], "left")
        .select("name", "node", "n", F.coalesce("root", "node").alias("root")),
        "labelled",
    )
    # then what is in a bucket with members of other components; in a bucket of two the
    # only pair has been compared
    several = cut(
        labelled.groupBy("name")
        .agg(F.min("root").alias("x"), F.max("root").alias("y"), F.count("*").alias("m"))
        .where("x <> y AND m > 2").select("name", F.ceil(F.col("m") / BLOCK).cast("int").alias("blocks")),
        "several",
    )
    block = F.pmod(F.xxhash64("node", "name"), F.col("blocks")).cast("int")
    tiles = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda other: F.struct(F.least(other, F.col("block")).alias("lo"), F.greatest(other, F.col("block")).alias("hi")),
    )
    rows = (
        labelled.join(several, "name").withColumn("block", block)
        .withColumn("tile", F.explode(tiles)).select("name", "node", "n", "root", "block", "tile.lo", "tile.hi")
    )
    rows = cut(rows, "open")

    def unsettled(tile: pa.Table) -> pa.Table:
        return _tile_open(tile, percent)

    # bands are narrow beside sets, and tell which rows have a pair to compare at all
    judged = rows.join(sets.select("node", "bands"), "node").select(*rows.columns, "bands")
    compared = cut(judged.groupBy("name", "lo", "hi").applyInArrow(unsettled, rows.schema), "compared")
    # a set is looked up once for all tiles of its node
    places = F.collect_list(F.struct(*[c for c in rows.columns if c != "node"])).alias("places")
    compared = (
        compared.groupBy("node").agg(places).join(sets, "node")
        .select("node", "bands", "shingles", F.explode("places").alias("place")).select("node", "place.*", "bands", "shingles")
    )

    def compare(tile: pa.Table) -> pa.Table:
        found = list(zip(*_tile_links(tile, percent))) or [(), ()]
        return pa.table({"a": pa.array(found[0], pa.int64()), "b": pa.array(found[1], pa.int64())})

    more = compared.groupBy("name", "lo", "hi").applyInArrow(compare, "a long, b long")
    return cut(links.union(more), "all_links")


def _grouped(signed: DataFrame, shingle: int, percent: int) -> DataFrame:
    """A row per distinct set of the signed rows: set_key, smallest (id), first (row of the
    smallest id) and root, which is one for sets that links connect."""
    classes = cut(
        signed.where("n_shingles > 0").groupBy("set_key").agg(
            F.min("row").alias("node"), F.min("doc_id").alias("smallest"),
            F.min(F.struct("doc_id", "row")).alias("first"), F.count("*").alias("times")),
        "classes",
    )
    # the copies are fewer than the sets, so it is they that are looked up
    repeated = cut(classes.where("times > 1").select("set_key", "node"), "repeated")
    copies = cut(signed.select("row", "set_key").join(repeated, "set_key").where("row <> node").select("row"), "copies")
    nodes = signed.where("n_shingles > 0").select("row", "n_shingles", "bands").join(copies, "row", "left_anti")
    banded = nodes.select(F.col("row").alias("node"), F.col("n_shingles").alias("n"), F.explode("bands").alias("name"))
    members = F.count("*").over(Window.partitionBy("name"))
    buckets = cut(banded.withColumn("members", members).where("members > 1").drop("members"), "buckets")
    inside = cut(buckets.select(F.col("node").alias("row")).distinct(), "members")
    texts = signed.select("row", "bands", "packed").join(inside, "row").select(F.col("row").alias("node"), "bands", "packed")
    sets = bucketed(texts, "node", lambda dealt: _sets(dealt, shingle))
    roots = components(links_of(buckets, sets, percent)).withColumnRenamed("node", "of")
    return cut(
        classes.join(roots, classes["node"] == roots["of"], "left")
        .select("set_key", "smallest", "first", F.coalesce("root", "node").alias("root")),
        "grouped",
    )


def near_duplicates(
    docs: DataFrame, shingle: int = 5, percent: int = 80, rows: int = ROWS, bands: int = BANDS
) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id (smallest id that links
    reach), kept (it is that id).

    A null text, or one without words, has no shingles and is linked with nothing. Equal
    sets are linked. Rows with the same id are compared each for itself. A null id is
    never a component's id unless it has no other, and then it is kept. An empty table
    gives no rows.

    Shuffled are one narrow row per band of each distinct set, the compressed texts of
    sets that share a bucket, and the sets of pairs whose bands leave them to be compared.
    """
    signed = cut(signatures(docs, shingle, rows, bands), "signatures")
    grouped = _grouped(signed, shingle, percent)
    ids = cut(grouped.groupBy("root").agg(F.min("smallest").alias("component_id")), "ids")
    named = cut(grouped.join(ids, "root").select("set_key", "component_id"), "named")
    return (
        signed.select("doc_id", "n_shingles", "set_key").join(named, "set_key", "left")
        .select("doc_id", "n_shingles",
                F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


def first_documents(
    docs: DataFrame, shingle: int = 5, percent: int = 80, rows: int = ROWS, bands: int = BANDS
) -> DataFrame:
    """The rows of ``docs`` as they are, of near-duplicates only the one with the smallest
    id; of equal ids one. Rows whose text has no words all stay.

    The texts are moved once, compressed, and written dealt by row: they are neither moved
    to be compared nor to be chosen.
    """
    others = [c for c in docs.columns if c != "text"]
    null = F.col("text").isNull()
    named = docs.select("doc_id", "text", *[F.col(f"`{c}`").alias(f"__in{i}") for i, c in enumerate(others)], null.alias("__null"))
    carry = (*[f"__in{i}" for i in range(len(others))], "__null")
    signed = bucketed(signatures(named, shingle, rows, bands, carry), "row")
    groups = _grouped(signed, shingle, percent).groupBy("root").agg(F.min("first").alias("first"))
    chosen = groups.select("first.row").union(signed.where("n_shingles = 0").select("row"))
    carried = [f"__c{i}" for i in range(len(carry))]
    kept = signed.select("row", "packed", *carried).join(cut(chosen, "first"), "row", "left_semi")

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decompressor = zstandard.ZstdDecompressor()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                both = zip(part.column("packed").to_pylist(), part.column(carried[-1]).to_pylist())
                texts = [None if is_null else decompressor.decompress(packed) for packed, is_null in both]
                columns = [part.column(c) for c in carried[:-1]]
                yield pa.record_batch([*columns, pa.array(texts, pa.string())], names=[*carried[:-1], "text"])
        give_back()

    schema = "".join(f"{c} {signed.schema[c].dataType.simpleString()}, " for c in carried[:-1]) + "text string"
    own = {o: F.col(c).alias(o) for o, c in zip(others, carried)} | {"text": F.col("text")}
    return kept.drop("row").mapInArrow(unpack, schema).select(*[own[c] for c in docs.columns])


@query("op2_minhash_near_dup")
def op2_minhash_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=2)
