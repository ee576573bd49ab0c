"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept. All
but the last return the columns of ``documents``; rows with equal or null ids are rows of
their own throughout, and an empty table passes through every stage.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import common
from ledgerline.llm.common import cut, free_name, numbered, table
from ledgerline.llm.mixing import mix
from ledgerline.llm.near_dup import first_documents
from ledgerline.llm.packing import pack
from ledgerline.llm.quality import good_documents
from ledgerline.llm.registry import find_package
from ledgerline.llm.repeats import PASSAGE_WORDS, without_repeats

#: Rows that Python workers are given at a time, at most; long documents fill memory.
BATCH_ROWS = 1000
#: Words whose ids the packing remembers, in a worker that earlier stages have filled.
WORDS = 200_000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _stage(build: Stage) -> Stage:
    """A stage keeps no intermediate table of the stages before it: their results have
    been written when it begins. Batches for Python are made smaller for the session, as
    the stage's result is computed when it is written."""

    @wraps(build)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        find_package(spark)
        spark.conf.set(_BATCH, str(min(BATCH_ROWS, int(spark.conf.get(_BATCH)))))
        with common.stage(spark, docs):
            made = build(spark, docs, sf_dir)
        return made.select("*")  # a query of its own, whose shuffle files stay while it is used

    return run


@_stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the classifier rejects go."""
    return good_documents(docs, table(spark, sf_dir, "labels"))


@_stage
def near_dup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one with the smallest id.
    Five-word shingles, a similarity of 0.8 or more; texts without words are no group."""
    return first_documents(docs, shingle=5, percent=80)


@_stage
def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of over 50 words, and strings of 400 bytes or more, that also start
    elsewhere go, whole characters only; a document that consists of them stays as an
    empty one."""
    others = [c for c in docs.columns if c not in ("text", "n_chars")]
    aliases = tuple(f"__in{i}" for i in range(len(others)))
    named = docs.select("text", *[F.col(f"`{c}`").alias(a) for c, a in zip(others, aliases)])
    left = without_repeats(named, carry=aliases, keep_text=True, words=PASSAGE_WORDS)
    own = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("long")}
    own |= {c: F.col(a) for c, a in zip(others, aliases)}
    return left.select(*[own[c].alias(c) for c in docs.columns])


@_stage
def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each source near its target; a document the mix takes twice is two rows."""
    row, copies, copy = (free_name(docs, n) for n in ("__row", "__times", "__time"))
    rows = numbered(docs, row)
    times = mix(rows, carry=(row,)).where("times > 0").select(row, F.col("times").alias(copies))
    taken = rows.join(cut(times, "times"), row)
    each = taken.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copies))))
    return each.select(*docs.columns)


@_stage
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece, with its place in a sequence of at most 4096 ids."""
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"), words=WORDS)


STAGES = [
    ("quality", quality),
    ("near_dup", near_dup),
    ("repeats", repeats),
    ("mixing", mixing),
    ("packing", packing),
]

#: SQL cannot express the classifier, the signatures or the plan of the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        made = stage(spark, docs, sf_dir)
        path = common.new_path(spark, name)
        made.write.parquet(path)
        docs = spark.read.schema(made.schema).parquet(path)
        common.remove(spark, before)
        before = [path]
    return STAGES[-1][1](spark, docs, sf_dir)
