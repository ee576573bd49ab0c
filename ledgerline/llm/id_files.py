"""Token ids in files: one frame per document, all with one zstandard dictionary.

A dataset of the format has three tables. ``dictionary`` holds the shared dictionary and
its hash. ``shards`` holds the shards in ascending order of document ids: each a binary
block of a head, an index of offsets, and the documents' frames, each compressed for
itself, so that a short document is read without its neighbours. ``ranges`` tells, for
each of the ordered runs of shards, how many ids all earlier runs hold. Spark writes the
tables, so they can be kept wherever Spark can write, and a repeated task writes nothing
twice.

A shard, little-endian: magic ``LLID``, width of an id in bytes (2 or 4), documents n,
first 16 bytes of the dictionary's SHA-256, start of its first document in the run; then
n ids of documents, n counts of ids, n + 1 offsets (64 bits each), the validity of the
ids (a byte each), and the frames.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.llm.common import cut, new_path, table, text_or_empty
from ledgerline.llm.encoding import encoder, slices, together
from ledgerline.llm.registry import query

END_ID = 0
#: Documents the dictionary is trained on, those with the smallest hashes, and the ids of
#: a document up to which it takes part.
SAMPLE = 1000
SAMPLE_IDS = 8192
DICTIONARY_BYTES = 64 * 1024
LEVEL = 3
#: A shard is closed at so many bytes of frames.
SHARD_BYTES = 4 << 20

_HEAD = "<4sIQ16sQ"
_HEAD_BYTES = struct.calcsize(_HEAD)


def _serialized(ids: bytes, width: int) -> bytes:
    return ids if width == 4 else np.frombuffer(ids, "<u4").astype("<u2").tobytes()


def train(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary from serialized id arrays; too few or too uniform samples are used as
    they are, and no samples make an empty dictionary."""
    samples = [s for s in samples if s]
    try:
        return zstandard.train_dictionary(min(size, max(256, sum(map(len, samples)) // 4)), samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(samples)[-size:]


def _dictionary(data: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(data) if data else None


def write(
    docs: DataFrame, path: str, tokenizer: str, spaces_dropped: bool = False, end_id: int = END_ID, width: int = 2,
    id_column: str = "doc_id", text_column: str = "text",
) -> None:
    """Encode whole texts, append the end id, and write them in ascending order of ids.

    A null or empty text is the end id alone. Null ids come first; rows with the same id
    stand next to each other, ordered by their ids' checksum. Texts are encoded once and
    shuffled once, compressed, into ranges of document ids; a range that one id fills
    alone stays one task. ``width``: bytes of an id, 2 or 4; an error if the tokenizer has
    ids that do not fit.
    """
    spark = docs.sparkSession
    known = encoder(tokenizer, spaces_dropped).tokenizer.get_vocab(with_added_tokens=True)
    if max([end_id, *known.values()]) >= 1 << 8 * width:
        raise ValueError(f"ids of this tokenizer do not fit a width of {width} bytes")
    chosen = docs.select(
        F.col(f"`{id_column}`").cast("long").alias("doc_id"), text_or_empty(text_column).alias("text")
    )
    # SAMPLE rows, chosen by their ids alone, so that no task sends texts that are not used
    ids = chosen.select("doc_id").where("doc_id IS NOT NULL").orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    sampled = F.col("doc_id").isin([r.doc_id for r in ids.collect()])
    short = F.length("text") <= 8 * SAMPLE_IDS
    rows = chosen.where(sampled & short).select("doc_id", "text").limit(SAMPLE).collect()
    rows.sort(key=lambda r: (r.doc_id, r.text))
    encode = encoder(tokenizer, spaces_dropped).encode
    samples = [_serialized(encode(r.text), width) for r in rows]
    shared = train([s for s in samples if len(s) <= width * SAMPLE_IDS])
    digest = hashlib.sha256(shared).digest()

    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_all = encoder(tokenizer, spaces_dropped).encode_all
        end = end_id.to_bytes(4, "little")
        compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(shared), write_dict_id=False)
        for part in together(batches, "text"):
            doc_ids, texts = (part.column(c).to_pylist() for c in ("doc_id", "text"))
            out = []
            for doc_id, ids in zip(doc_ids, encode_all(texts)):
                ids += end
                out.append((doc_id, len(ids) // 4, zlib.crc32(ids), compressor.compress(_serialized(ids, width))))
            columns = list(zip(*out))
            types = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.record_batch(
                [pa.array(c, t) for c, t in zip(columns, types)], names=["doc_id", "n", "crc", "frame"]
            )

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_docs: list[tuple] = []
        size = start = number = run = 0

        def close() -> pa.RecordBatch:
            nonlocal open_docs, size, start, number
            n = len(open_docs)
            counts = np.array([d[1] for d in open_docs], "<i8")
            block = b"".join([
                struct.pack(_HEAD, b"LLID", width, n, digest[:16], start),
                np.array([d[0] or 0 for d in open_docs], "<i8").tobytes(),
                counts.tobytes(),
                np.cumsum([0, *(len(d[2]) for d in open_docs)]).astype("<i8").tobytes(),
                bytes(d[0] is not None for d in open_docs),
                *(d[2] for d in open_docs),
            ])
            known = [d[0] for d in open_docs if d[0] is not None]
            words = int(counts.sum())
            row = pa.record_batch(
                [pa.array([run], pa.int32()), pa.array([number], pa.int64()), pa.array([words], pa.int64()),
                 pa.array(known[:1] or [None], pa.int64()), pa.array(known[-1:] or [None], pa.int64()),
                 pa.array([block], pa.binary())],
                names=["run", "shard", "n_ids", "first_id", "last_id", "block"],
            )
            open_docs, size, start, number = [], 0, start + words, number + 1
            return row

        for part in slices(batches):
            for run, doc_id, n, frame in part:
                open_docs.append((doc_id, n, frame))
                size += len(frame)
                if size >= SHARD_BYTES:
                    yield close()
        if open_docs:
            yield close()

    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # dealing by range looks at the ids first, so without a written table all texts would
    # be encoded twice
    framed = cut(chosen.mapInArrow(frames, "doc_id long, n long, crc long, frame binary"), "frames")
    ordered = (
        framed.repartitionByRange(tasks, "doc_id")
        .sortWithinPartitions("doc_id", "crc", "n")
        .select(F.spark_partition_id().alias("run"), "doc_id", "n", "frame")
        .mapInArrow(shards, "run int, shard long, n_ids long, first_id long, last_id long, block binary")
    )
    ordered.write.option("compression", "none").parquet(f"{path}/shards")
    before = Window.orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    # a row per task of the writing job
    runs = spark.read.parquet(f"{path}/shards").groupBy("run").agg(F.sum("n_ids").alias("n_ids"))
    runs.select("run", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("before")).write.parquet(f"{path}/ranges")
    known = spark.createDataFrame([(digest.hex(), bytearray(shared))], "sha256 string, dictionary binary")
    known.coalesce(1).write.parquet(f"{path}/dictionary")


def parse(block: bytes) -> tuple[int, bytes, int, list, np.ndarray, np.ndarray, int]:
    """Width, dictionary hash, start, ids of documents, counts, offsets, start of frames."""
    magic, width, n, digest, start = struct.unpack_from(_HEAD, block)
    if magic != b"LLID":
        raise ValueError("not a shard of ids")
    at = _HEAD_BYTES
    doc_ids = np.frombuffer(block, "<i8", n, at)
    counts = np.frombuffer(block, "<i8", n, at + 8 * n)
    offsets = np.frombuffer(block, "<i8", n + 1, at + 16 * n)
    valid = block[at + 24 * n + 8 : at + 25 * n + 8]
    named = [d if v else None for d, v in zip(doc_ids.tolist(), valid)]
    return width, digest, start, named, counts, offsets, at + 25 * n + 8


def read(spark: SparkSession, path: str, only: list[int] | None = None, keep_ids: bool = True) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32 and, if kept,
    ids (little-endian unsigned 32-bit). ``only``: these documents; shards without any of
    them are not read, and of the others only the frames asked for are decompressed."""
    known = spark.read.parquet(f"{path}/dictionary").first()
    shared, digest = bytes(known.dictionary), bytes.fromhex(known.sha256)[:16]
    wanted = None if only is None else frozenset(only)
    stored = spark.read.parquet(f"{path}/shards")
    if only is not None:
        inside = F.lit(False)
        for doc_id in only:
            inside = inside | ((F.col("first_id") <= doc_id) & (F.col("last_id") >= doc_id))
        stored = stored.where(inside)
    names = ["doc_id", "start", "n_tokens", "ids_crc32", "ids"][: 5 if keep_ids else 4]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decompressor = zstandard.ZstdDecompressor(dict_data=_dictionary(shared))
        for (before, block), in slices(batches, 1):
            width, made_with, start, doc_ids, counts, offsets, at = parse(block)
            if made_with != digest:
                raise ValueError("the shard was written with another dictionary")
            starts = before + start + np.cumsum(counts) - counts
            out = []
            for k, doc_id in enumerate(doc_ids):
                if wanted is not None and doc_id not in wanted:
                    continue
                ids = decompressor.decompress(block[at + offsets[k] : at + offsets[k + 1]])
                if width == 2:
                    ids = np.frombuffer(ids, "<u2").astype("<u4").tobytes()
                out.append((doc_id, int(starts[k]), len(ids) // 4, zlib.crc32(ids), ids))
            for i in range(0, len(out), 1000):
                columns = list(zip(*out[i : i + 1000]))[: len(names)]
                yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    ranges = spark.read.parquet(f"{path}/ranges")
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * keep_ids
    # a row per task of the writing job on the right, so Spark may broadcast it
    return stored.join(ranges, "run").select("before", "block").mapInArrow(unpack, schema)


@query("op5_id_files")
def op5_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = new_path(spark, "ids")
    write(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return read(spark, path, keep_ids=False)
