"""Mixing sources to target weights by fitting subset sums on a histogram of lengths.

Documents of one source and length are alike for the budget, so the choice is made on
their counts. A source's target is made of whole passes over all its documents and a
rest. Of the rest, every length gives its share, then one more document of as many
lengths as fit; a bounded knapsack over the counts that are left closes what remains.
Where that does not meet the target, as with few documents, documents may be repeated
more unevenly. Which documents of a length are taken follows from a seeded hash of their ids.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.llm.common import cut, table, text_or_empty
from ledgerline.llm.registry import query

#: Weights of the sources in their order, repeating.
WEIGHTS = (5.0, 2.0, 1.0)
#: No source and no document is taken more often than this.
MOST = 3
SEED = 17
#: Largest budget in words that the knapsack closes, where it holds four of the longest
#: documents; a larger one if its sums take at most so many bytes, as with few documents.
KNAPSACK = 1 << 15
SUMS_BYTES = 1 << 26
#: Largest budget that the knapsack closes at all: its table takes four bytes a word.
MOST_SUMS = 1 << 25
#: Budget from which on the longest documents are offered first.
LARGE = 1 << 22
#: Documents of one source and length that are ordered in one group.
BUCKET = 256


def word_count(name: str = "text") -> Column:
    words = F.split(text_or_empty(name), r"[\x20\x09-\x0D]+")
    return F.size(F.array_remove(words, "")).cast("long")


def targets(sizes: dict[str | None, int], weights: tuple[float, ...] = WEIGHTS, most: int = MOST) -> dict:
    """Words wanted of each source: all words by weight, at most ``most`` times the
    source's own; the excess goes to the others by weight until none is above."""
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    found = dict.fromkeys(order, 0.0)
    open_ones = list(order)
    left = float(sum(sizes.values()))
    while open_ones:
        whole = sum(weight[s] for s in open_ones)
        share = {s: left * weight[s] / whole for s in open_ones}
        over = [s for s in open_ones if share[s] > most * sizes[s]]
        for s in over or open_ones:
            found[s] = float(most * sizes[s]) if over else share[s]
        if not over:
            break
        left -= sum(found[s] for s in over)
        open_ones = [s for s in open_ones if s not in over]
    return found


def fit_lengths(lengths: list[int], counts: list[int], budget: int, knapsack: int = KNAPSACK) -> list[int]:
    """How many documents of each length make up ``budget`` words, or as near below it as
    can be. Lengths are positive and differ. The result is the nearest for budgets up to
    ``knapsack``, to four of the longest documents or to what few lengths allow, but not
    beyond ``MOST_SUMS``; for larger ones it misses by less than the shortest length that
    is left, as a rule by nothing."""
    total = sum(n * c for n, c in zip(lengths, counts))
    if budget >= total:
        return list(counts)
    knapsack = min(max(knapsack, 4 * max(lengths)), MOST_SUMS)
    if budget <= knapsack or (
        budget <= MOST_SUMS and budget // 8 * sum(c.bit_length() for c in counts) <= SUMS_BYTES
    ):
        return subset_sum(lengths, counts, budget)
    use = [c * max(0, budget - knapsack // 2) // total for c in counts]
    left = budget - sum(n * u for n, u in zip(lengths, use))
    order = sorted(range(len(lengths)), key=lambda i: -lengths[i])
    # one more of each length, then as many as there are; half the knapsack stays open
    for most in (1, total):
        for i in order:
            more = min(most, counts[i] - use[i], max(0, left - knapsack // 2) // lengths[i])
            use[i] += more
            left -= more * lengths[i]
    rest = [c - u for c, u in zip(counts, use)]
    return [u + a for u, a in zip(use, subset_sum(lengths, rest, left))]


def fit_target(
    lengths: list[int], counts: list[int], target: int, most: int, knapsack: int = KNAPSACK
) -> tuple[int, list[int]]:
    """Whole passes, and how many documents of each length are taken besides, so that no
    document is taken more than ``most`` times: the first try that meets the target, or
    the nearest."""
    total = sum(n * c for n, c in zip(lengths, counts))
    passes = min(most, target // total) if total else 0
    tries = [(passes, 1)] + [(p, most - p) for p in range(passes, -1, -1)]
    best: tuple[int, int, list[int]] | None = None
    for base, copies in tries:
        left = target - base * total
        more = fit_lengths(lengths, [c * min(copies, most - base) for c in counts], left, knapsack)
        miss = left - sum(n * m for n, m in zip(lengths, more))
        if best is None or miss < best[0]:
            best = (miss, base, more)
        if miss <= 0:
            break
    return best[1], best[2]


def subset_sum(lengths: list[int], counts: list[int], budget: int) -> list[int]:
    """Counts whose sum is as near below ``budget`` as can be. Reachable sums are the bits
    of a number; a length is offered in powers of two, so that any count can be made. Of
    each sum only the step is kept that reached it first: what is left without that step
    was reachable before it. Short lengths come first, which takes more documents; where
    the budget is large, long ones, which reach it in fewer steps."""
    unit = math.gcd(*lengths) or 1
    lengths, budget = [n // unit for n in lengths], budget // unit
    first = np.zeros(budget + 1, dtype=np.int32)
    mask = (1 << (budget + 1)) - 1
    sums, steps = 1, []
    for i in sorted(range(len(lengths)), key=lambda i: lengths[i], reverse=budget > LARGE):
        free, k = min(counts[i], budget // lengths[i]), 1
        while free > 0 and not sums >> budget & 1:
            k = min(k, free)
            fresh = (sums << lengths[i] * k) & mask & ~sums
            if fresh:
                steps.append((i, k))
                data = np.frombuffer(fresh.to_bytes(budget // 8 + 1, "little"), np.uint8)
                where = np.flatnonzero(data)
                bits = np.unpackbits(data[where], bitorder="little").reshape(-1, 8)
                rows, places = np.nonzero(bits)
                first[where[rows] * 8 + places] = len(steps)
                sums |= fresh
            free -= k
            k *= 2
        if sums >> budget & 1:
            break
    add = [0] * len(lengths)
    left = sums.bit_length() - 1
    while left:
        i, k = steps[first[left] - 1]
        add[i] += k
        left -= k * lengths[i]
    return add


def mix(
    docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST, seed: int = SEED,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """One row per document: doc_id, source, size (words), source_size, target (of its
    source), times (how often the mix takes it), taken (words of it in the mix), and the
    carried columns.

    A null text has no words; documents without words are taken once. A null source is a source of its own, the last one.
    Rows with the same id are documents of their own; where id and size agree, it does
    not matter which of them is taken. An empty table gives no rows.

    The driver sees a row per source; a task sees the lengths of a source, not its
    documents. Documents are ordered in buckets of about ``BUCKET`` by source, length and
    hash, so that no source and no length meets in one task.
    """
    spark = docs.sparkSession
    measured = cut(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
            word_count().alias("size"), *[F.col(f"`{c}`").alias(c) for c in carry],
        ),
        "sizes",
    )
    histogram = measured.groupBy("source", "size").agg(F.count("*").alias("n"))
    own = {r.source: r.words for r in histogram.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("words")).collect()}
    wanted = targets(own, weights, most)
    rows = []
    for source, words in own.items():
        rows.append((source, words, wanted[source], min(round(wanted[source]), most * words)))
    budgets = spark.createDataFrame(rows, "b_source string, source_size long, target double, goal long")

    def choose(key: tuple, lengths: pd.DataFrame) -> pd.DataFrame:
        some = lengths[lengths["size"] > 0].sort_values("size")
        base, more = fit_target(some["size"].tolist(), some["n"].tolist(), int(lengths["goal"].iloc[0]), most)
        return some[["source", "size", "n"]].assign(base=base, more=more)

    chosen = (
        histogram.join(budgets, F.col("source").eqNullSafe(F.col("b_source")))
        .select("source", "size", "n", "goal")
        .groupBy("source").applyInPandas(choose, "source string, size long, n long, base int, more long")
    )
    chosen = cut(chosen, "lengths").withColumnsRenamed({"source": "c_source", "size": "c_size"})
    bucket = F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.ceil(F.coalesce("n", F.lit(1)) / BUCKET)).cast("long")
    dealt = (
        measured.join(chosen, F.col("source").eqNullSafe(F.col("c_source")) & (F.col("size") == F.col("c_size")), "left")
        .select("doc_id", "source", "size", F.coalesce("n", F.lit(1)).alias("n"),
                F.coalesce("base", F.lit(1)).alias("base"), F.coalesce("more", F.lit(0)).alias("more"),
                bucket.alias("bucket"), *carry)
    )
    key = ["source", "size", "bucket"]
    running = Window.partitionBy("source", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = dealt.groupBy(*key).count().select(
        *[F.col(k).alias(f"k_{k}") for k in key], F.coalesce(F.sum("count").over(running), F.lit(0)).alias("before")
    )
    same = F.col("source").eqNullSafe(F.col("k_source")) & (F.col("size") == F.col("k_size")) & (F.col("bucket") == F.col("k_bucket"))
    within = Window.partitionBy(*key).orderBy(F.xxhash64(F.lit(seed + 1), F.col("doc_id")), "doc_id")
    ranked = dealt.withColumn("rank", F.row_number().over(within)).join(counts, same)
    extra = F.floor(F.col("more") / F.col("n")) + (F.col("rank") + F.col("before") <= F.col("more") % F.col("n")).cast("int")
    times = (F.col("base") + extra).cast("int")
    return (
        ranked.join(budgets, F.col("source").eqNullSafe(F.col("b_source")))
        .select("doc_id", "source", "size", "source_size", "target", times.alias("times"),
                (times * F.col("size")).cast("long").alias("taken"), *carry)
    )


@query("op9_mixing")
def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))
