"""Quality classifier: kernel ridge regression on document statistics.

Random Fourier features approximate a Gaussian kernel over standardised statistics of
whole texts. Every partition adds up its part of the normal equations, apart for each
fold, so that leaving a fold out is a subtraction. Scores of left-out rows fit a monotone
calibration.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import cut, table, text_or_empty
from ledgerline.llm.encoding import give_back, slices
from ledgerline.llm.registry import query

FEATURES = 384
#: Weight of the penalty, as a share of the number of rows.
PENALTY = 1e-4
#: Scores are counted in so many bins for the calibration.
BINS = 256
THRESHOLD = 0.7
#: Rows whose crc32(doc_id) has this remainder modulo ``FOLDS`` are never learnt from.
FOLDS, HELD_OUT = 4, 2
#: Sums that one task adds up.
ADDED = 32
SEED = 11

_LINES = re.compile(rb"[^\n]+")
_KINDS = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "digit": b"0123456789",
    "blank": b" ",
    "line end": b"\n\r",
    "other space": b"\t\x0b\x0c",
    "stop": b".",
    "comma": b",;:",
    "shout": b"!?",
    "quote": b"'\"`",
    "bracket": b"()[]{}<>",
    "sign": b"#$%&*+=/\\^~_|@-",
}
_KIND_OF = np.full(256, len(_KINDS), np.int64)  # all other bytes are one kind more
for _number, _bytes in enumerate(_KINDS.values()):
    _KIND_OF[list(_bytes)] = _number
_KIND_OF[:32][_KIND_OF[:32] == len(_KINDS)] = len(_KINDS) + 1  # control characters


def statistics(text: str) -> np.ndarray:
    """Statistics of a whole text; an empty one has zeros only."""
    raw = text.encode("utf-8", "surrogatepass")
    found = np.zeros(STATISTICS)
    if not raw:
        return found
    data = np.frombuffer(raw, np.uint8)
    kinds = np.bincount(_KIND_OF[data], minlength=len(_KINDS) + 2)
    shares = kinds / len(data)
    words = raw.split()
    lines = _LINES.findall(raw)
    n = len(words)
    counts = Counter(words)
    lengths = np.fromiter(map(len, words), np.int64, n) if n else np.zeros(1)
    often = max(counts.values(), default=0)
    again = sum(a == b for a, b in zip(words, words[1:]))
    pairs = len(set(zip(words, words[1:])))
    signs = np.isin(data, np.frombuffer(_KINDS["sign"] + _KINDS["shout"], np.uint8))
    doubled = int((signs[1:] & signs[:-1] & (data[1:] == data[:-1])).sum())
    upper = sum(map(bytes.isupper, counts))
    alpha = sum(map(bytes.isalpha, counts))
    d = max(1, len(counts))
    found[:] = [
        *np.sqrt(shares),
        np.log1p(len(data)), np.log1p(n), np.log1p(len(lines)),
        np.log1p(lengths.mean()), np.log1p(lengths.std()), np.log1p(lengths.max()),
        len(counts) / max(1, n), often / max(1, n), again / max(1, n), pairs / max(1, n - 1),
        np.log1p(doubled), doubled / len(data), upper / d, alpha / d,
        len(set(lines)) / max(1, len(lines)), np.log1p(len(data) / max(1, len(lines))),
        sum(c for c in counts.values() if c > 1) / max(1, n),
    ]
    return found


STATISTICS = len(_KINDS) + 2 + 17


def described(docs: DataFrame) -> DataFrame:
    """doc_id and statistics of every row."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            ids, texts = zip(*part)
            values = [statistics(t) for t in texts]
            yield pa.record_batch(
                [pa.array(ids, pa.int64()), pa.array(values, pa.list_(pa.float64()))], names=["doc_id", "statistics"]
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(
        describe, "doc_id long, statistics array<double>"
    )


def remainder(doc_id: Column) -> Column:
    """A null id counts as an empty text."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.pmod(F.crc32(text.cast("binary")), F.lit(FOLDS)).cast("int")


class Model:
    """Feature map, weights by the fold left out (and of all), and the calibration."""

    def __init__(self, mean: np.ndarray, deviation: np.ndarray) -> None:
        draw = np.random.default_rng(SEED)
        self.mean, self.scale = mean, np.where(deviation > 1e-9, deviation, 1.0)
        self.directions = draw.normal(size=(STATISTICS, FEATURES)) / np.sqrt(STATISTICS)
        self.phases = draw.uniform(0, 2 * np.pi, FEATURES)
        self.weights: dict[int, np.ndarray] = {}
        self.edges = np.array([0.0, 1.0])
        self.levels = np.array([0.5, 0.5])

    def features(self, values: np.ndarray) -> np.ndarray:
        standard = np.clip((values - self.mean) / self.scale, -8, 8)
        waves = np.sqrt(2 / FEATURES) * np.cos(standard @ self.directions + self.phases)
        return np.hstack([waves, np.ones((len(values), 1))])

    def raw(self, values: np.ndarray, fold: int) -> np.ndarray:
        return self.features(values) @ self.weights[fold]

    def score(self, values: np.ndarray) -> np.ndarray:
        """Calibrated, and within a level of the calibration still in order."""
        raw = self.raw(values, HELD_OUT)
        order = np.clip((raw + 1) / 3, 0, 1)
        return np.clip(0.999 * np.interp(raw, self.edges, self.levels) + 0.001 * order, 0, 1)


def _matrix(batch: pa.RecordBatch, column: str) -> np.ndarray:
    return np.array(batch.column(column).to_pylist(), dtype=float).reshape(-1, STATISTICS)


def _sums(fold: int, part: int, sums: np.ndarray, n: int) -> pa.RecordBatch:
    columns = [pa.array([fold], pa.int32()), pa.array([part], pa.int32()), pa.array([sums.tobytes()], pa.binary()), pa.array([n], pa.int64())]
    return pa.record_batch(columns, names=["fold", "part", "sums", "n"])


def normal_equations(rows: DataFrame, model: Model) -> dict[int, tuple[np.ndarray, np.ndarray, int]]:
    """By fold: the products of the features with themselves and with the label, and the
    number of rows. A partition adds up its rows, then tasks the sums of ``ADDED`` others,
    in as many levels as it takes."""
    size = FEATURES + 1

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {f: [np.zeros((size, size)), np.zeros(size), 0] for f in range(FOLDS) if f != HELD_OUT}
        part = 0
        for batch in batches:
            folds = batch.column("fold").to_numpy()
            labels = batch.column("label").to_numpy()
            part = batch.column("part")[0].as_py() if batch.num_rows else part
            for f, own in sums.items():
                for at in range(0, batch.num_rows, 4096):
                    some = batch.slice(at, 4096)
                    here = folds[at : at + 4096] == f
                    if here.any():
                        z = model.features(_matrix(some, "statistics")[here])
                        own[0] += z.T @ z
                        own[1] += z.T @ labels[at : at + 4096][here]
                        own[2] += int(here.sum())
        for f, (products, target, n) in sums.items():
            if n:
                yield _sums(f, part, np.vstack([products, target]), n)

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # sorted: one sum at a time, in a fixed order
        key, whole, n = None, np.zeros((size + 1) * size), 0
        for batch in batches:
            for group, fold, sums, count in zip(*[batch.column(c).to_pylist() for c in ("group", "fold", "sums", "n")]):
                if key is not None and key != (fold, group):
                    yield _sums(*key, whole, n)
                    whole, n = np.zeros((size + 1) * size), 0
                key = (fold, group)
                whole += np.frombuffer(sums)
                n += count
        if key is not None:
            yield _sums(*key, whole, n)

    schema = "fold int, part int, sums binary, n long"
    parts = rows.withColumn("part", F.spark_partition_id()).mapInArrow(add_up, schema)
    groups = rows.rdd.getNumPartitions()
    while groups > 1:
        # a task adds up the sums of so many others, level by level
        groups = -(-groups // ADDED)
        marked = parts.withColumn("group", F.floor(F.col("part") / ADDED).cast("int"))
        dealt = marked.repartition(groups, "group").sortWithinPartitions("fold", "group", "part")
        parts = dealt.select("group", "fold", "sums", "n").mapInArrow(total, schema)
    # at most one row per fold
    added = parts.collect()
    found: dict[int, tuple[np.ndarray, np.ndarray, int]] = {}
    for r in sorted(added, key=lambda r: (r.fold, r.part)):
        sums = np.frombuffer(r.sums).reshape(size + 1, size)
        before = found.get(r.fold, (np.zeros((size, size)), np.zeros(size), 0))
        found[r.fold] = (before[0] + sums[:size], before[1] + sums[size], before[2] + r.n)
    return found


def pool_adjacent(means: list[float], counts: list[float]) -> list[float]:
    """The non-decreasing values nearest to the means."""
    blocks: list[list[float]] = []
    for m, c in zip(means, counts):
        blocks.append([m, c, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            m2, c2, k2 = blocks.pop()
            m1, c1, k1 = blocks.pop()
            blocks.append([(m1 * c1 + m2 * c2) / (c1 + c2), c1 + c2, k1 + k2])
    return [m for m, _, k in blocks for _ in range(int(k))]


def fit(rows: DataFrame) -> Model:
    """``rows``: a written table of fold, label and statistics, held-out rows left out."""
    each = [F.col("statistics")[i] for i in range(STATISTICS)]
    moments = rows.agg(*[F.avg(c) for c in each], *[F.stddev_pop(c) for c in each], F.avg("label")).first()
    if moments[-1] is None:  # nothing to learn from
        model = Model(np.zeros(STATISTICS), np.ones(STATISTICS))
        model.weights = {HELD_OUT: np.zeros(FEATURES + 1)}
        return model
    model = Model(np.array(moments[:STATISTICS]), np.array(moments[STATISTICS:-1]))
    parts = normal_equations(rows, model)
    for left_out in range(FOLDS):
        used = [p for f, p in parts.items() if f != left_out] or list(parts.values())
        n = sum(p[2] for p in used)
        products = sum(p[0] for p in used) + PENALTY * n * np.eye(FEATURES + 1)
        model.weights[left_out] = np.linalg.solve(products, sum(p[1] for p in used))

    def left_out_scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            folds, values = batch.column("fold").to_numpy(), _matrix(batch, "statistics")
            raw = np.zeros(len(folds))
            for f in set(folds.tolist()):
                raw[folds == f] = model.raw(values[folds == f], f)
            bins = np.clip(((raw + 0.5) / 2 * BINS).astype(int), 0, BINS - 1)
            yield pa.record_batch([pa.array(bins, pa.int32()), pa.array(raw), batch.column("label")],
                                  names=["bin", "raw", "label"])

    # at most BINS rows
    bins = sorted(
        rows.mapInArrow(left_out_scores, "bin int, raw double, label double").groupBy("bin")
        .agg(F.count("*").alias("n"), F.avg("label").alias("label"), F.avg("raw").alias("raw")).collect(),
        key=lambda r: r.bin,
    )
    model.edges = np.array([r.raw for r in bins])
    model.levels = np.array(pool_adjacent([r.label for r in bins], [r.n for r in bins]))
    return model


def learn(stats: DataFrame, labels: DataFrame) -> Model:
    """``stats``: a written table of doc_id and statistics."""
    fold = remainder(F.col("doc_id"))
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("double").alias("label"))
    marked = marked.where(fold != HELD_OUT).where(F.col("label").isin(0.0, 1.0)).dropDuplicates()
    return fit(cut(stats.join(marked, "doc_id").select(fold.alias("fold"), "label", "statistics"), "labelled"))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per input row: doc_id, held_out, score (0 to 1), predicted.

    Learns from rows of ``labels`` (doc_id, quality) with a quality of 0 or 1 whose
    document is there and not held out; further columns of ``docs`` are not looked at. A
    null text counts as an empty one. Repeated rows are scored alike, and learnt from once
    each. Without labels every score is about 0.5. An empty table gives no rows.

    The driver gets sums of a fixed size. Statistics are written once, a narrow row per
    document; only those with labels are shuffled.
    """
    stats = cut(described(docs), "statistics")
    model = learn(stats, labels)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                some = batch.slice(at, 4096)
                scores = model.score(_matrix(some, "statistics"))
                yield pa.record_batch([some.column("doc_id"), pa.array(scores)], names=["doc_id", "score"])

    return stats.mapInArrow(score, "doc_id long, score double").select(
        "doc_id", (remainder(F.col("doc_id")) == HELD_OUT).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def good_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, as they are, whose text scores ``threshold`` or more; see
    ``classify``. The statistics are computed again, so that texts are not written."""
    model = learn(cut(described(docs), "statistics"), labels)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                values = np.stack([statistics(t or "") for t in some.column("text").to_pylist()])
                yield some.filter(pa.array(model.score(values) >= threshold))
        give_back()

    return docs.mapInArrow(keep, docs.schema)


@query("op4_quality")
def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
