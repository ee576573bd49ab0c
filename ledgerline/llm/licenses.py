"""Licence scan by diagonal voting.

All rolling word pairs of a text are joined to the places of the same pair in the
templates. Every hit votes for a diagonal, the word of the text at which the template
would start. A diagonal that has all votes of its template is an exact place. The votes of
a diagonal and those a few words further are taken together, so that a passage with a few
words put in, left out or changed is found as well. Such a span is verified: only hits
count that follow one another in the text as they do in the template, so scattered pairs
or those of a reversed passage are none. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.llm.common import table, text_or_empty
from ledgerline.llm.registry import query

# The phrases that count as places, and their labels.
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

# Passages of well-known licences, and the labels they give.
PASSAGES = {
    "licensed under the apache license version 2 0 the license you may not use this file except in"
    " compliance with the license": "apache",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and"
    " associated documentation files": "mit",
    "redistribution and use in source and binary forms with or without modification are permitted"
    " provided that the following conditions are met": "bsd",
    "this source code form is subject to the terms of the mozilla public license": "mpl",
    "this work is licensed under a creative commons attribution": "creative-commons",
}

#: Word pairs of templates that are broadcast at most: some ten megabytes.
BROADCAST = 100_000
#: Everything but digits, lower-case letters and what is not ASCII parts words.
WORD_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(text, _UPPER, _UPPER.lower()), WORD_BREAK), "")


def _in_order(hits: Column) -> Column:
    """How many hits (place, at; by place) follow one another in the template and in the
    text: each counts if it lies behind the last that counted, in both."""
    none = F.struct(F.lit(-1).alias("place"), F.lit(-1).alias("at"), F.lit(0).alias("n"))

    def count(last: Column, hit: Column) -> Column:
        behind = (hit["place"] > last["place"]) & (hit["at"] > last["at"])
        return F.when(behind, F.struct(hit["place"].alias("place"), hit["at"].alias("at"), (last["n"] + 1).alias("n"))).otherwise(last)

    return F.aggregate(hits, none, count, lambda last: last["n"])


def _pairs(words: Column) -> Column:
    """Every word with its follower, and at the end an empty pair, which stands for the
    text itself, so that texts without a hit are kept."""
    followers = F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0)))
    both = F.zip_with(words, followers, lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    return F.concat(
        F.filter(both, lambda p: p["b"].isNotNull()),
        F.array(F.struct(F.lit("").alias("a"), F.lit("").alias("b"))),
    )


def template_pairs(spark: SparkSession, phrases: dict[str, str], passages: dict[str, str]) -> DataFrame:
    """One row per word pair of a template: some hundred rows, whatever the input."""
    rows = [(-1, 0, 1, "", "", "", False)]
    for number, (text, label) in enumerate([*phrases.items(), *passages.items()]):
        words = text.split()
        rows += [
            (number, i, len(words) - 1, a, b, label, number < len(phrases))
            for i, (a, b) in enumerate(zip(words, words[1:]))
        ]
    schema = "template int, place int, grams int, a string, b string, label string, exact boolean"
    return spark.createDataFrame(rows, schema).withColumn("gram", F.xxhash64("a", "b"))


def _pairs_of(templates: DataFrame, first: int) -> DataFrame:
    """Word pairs of a table of templates, numbered from ``first`` on by their texts."""
    listed = templates.select(
        words_of(F.col("text")).alias("words"), "label", F.col("exact").cast("boolean").alias("exact")
    ).where("size(words) > 1").distinct()
    numbered = listed.withColumn("template", (F.row_number().over(Window.orderBy("words", "label", "exact")) + first - 1).cast("int"))
    both = numbered.select("*", F.posexplode(F.slice("words", 1, F.size("words") - 1)).alias("place", "a"))
    return both.select(
        "template", "place", (F.size("words") - 1).alias("grams"), "a", F.col("words")[F.col("place") + 1].alias("b"), "label", "exact",
    ).withColumn("gram", F.xxhash64("a", "b"))


def scan(
    docs: DataFrame,
    phrases: dict[str, str] = PHRASES,
    passages: dict[str, str] = PASSAGES,
    drift: int = 3,
    min_share: float = 0.8,
    id_column: str = "doc_id",
    text_column: str = "text",
    templates: DataFrame | None = None,
) -> DataFrame:
    """One row per input row: id, n_words, n_base, first_word, last_word, base_labels,
    labels, score, and spans (label, first and last word, share of the pairs found).

    ``phrases`` (two words at least) count only where all words stand one after the
    other; a passage gives its label where ``min_share`` of its pairs follow one another
    on diagonals that all lie within ``drift`` words. ``templates`` (text, label, exact)
    are used besides; they must hold a word pair each. ``score`` is the largest share of any
    template. A null or empty text has no words, no places, empty labels and score 0;
    rows with the same id are scanned each for itself; the id may be null.

    Up to ``BROADCAST`` word pairs of templates are broadcast, more are joined as Spark
    sees fit. Of the texts only hits are shuffled, by the row they come from.
    """
    if any(len(t.split()) < 2 for t in [*phrases, *passages]):
        raise ValueError("a template needs two words at least")
    spark = docs.sparkSession
    grams = (
        docs.select(
            F.col(f"`{id_column}`").alias("id"),
            F.monotonically_increasing_id().alias("row"),
            words_of(text_or_empty(text_column)).alias("words"),
        )
        .select(
            "id",
            "row",
            F.size("words").alias("n_words"),
            F.posexplode(_pairs(F.col("words"))).alias("at", "pair"),
        )
        .select("id", "row", "n_words", "at", "pair.a", "pair.b", F.xxhash64("pair.a", "pair.b").alias("gram"))
    )
    known = template_pairs(spark, phrases, passages)
    if templates is not None:
        known = known.unionByName(_pairs_of(templates, known.agg(F.max("template")).first()[0] + 1))
    if templates is None or known.count() <= BROADCAST:
        known = F.broadcast(known)
    hits = (
        grams.alias("g")
        .join(known.alias("t"), F.expr("g.gram = t.gram AND g.a = t.a AND g.b = t.b"))
        .select("id", "row", "n_words", "template", "label", "exact", "grams", "place",
                F.when(F.col("template") >= 0, F.col("at") - F.col("place")).alias("diagonal"))
        .repartition("row")
    )
    text = ["row", "id", "n_words"]
    votes = hits.groupBy(*text, "template", "label", "exact", "grams", "diagonal").agg(
        F.collect_set("place").alias("places")
    )
    # A diagonal that misses a vote for a phrase is no place, so it is never merged; the
    # others are taken with those of at most ``drift`` words more.
    alone = F.col("exact") | F.col("diagonal").isNull()
    starts = F.when(alone, F.array("diagonal")).otherwise(F.sequence(F.col("diagonal") - drift, F.col("diagonal")))
    merged = (
        votes.withColumn("start", F.explode(starts))
        .groupBy(*text, "template", "label", "exact", "grams", "start")
        .agg(
            F.array_sort(F.flatten(F.collect_list(F.transform(
                "places", lambda p: F.struct(p.alias("place"), (F.col("diagonal") + p).alias("at")))))).alias("hits"),
            F.min("diagonal").alias("least"),
        )
        .where("template < 0 OR least = start")
        .withColumn("found", _in_order(F.col("hits")))
        .withColumn("share", F.when(F.col("template") >= 0, F.col("found") / F.col("grams")).otherwise(0.0))
        .withColumn("first", F.array_min(F.col("hits.at")))
        .withColumn("last", F.array_max(F.col("hits.at")) + 1)
    )
    base = F.col("exact") & (F.col("found") == F.col("grams"))
    sure = base | (~F.col("exact") & (F.col("template") >= 0) & (F.col("share") >= min_share))

    def joined(condition: Column) -> Column:
        return F.array_join(F.array_sort(F.collect_set(F.when(condition, F.col("label")))), ",")

    # of the diagonals around a place, the one with the largest share is its span
    near = Window.partitionBy("row", "template").orderBy("start").rangeBetween(-drift, drift)
    best = F.max(F.struct("share", (-F.col("start")).alias("start"))).over(near)["start"] == -F.col("start")
    merged = merged.withColumn("best", best)
    span = F.struct("label", "first", "last", "share")
    return merged.groupBy(*text).agg(
        F.sum(base.cast("long")).alias("n_base"),
        F.min(F.when(base, F.col("start"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("start"))).cast("long").alias("last_word"),
        joined(base).alias("base_labels"),
        joined(sure).alias("labels"),
        F.max("share").alias("score"),
        F.array_sort(F.collect_list(F.when(sure & F.col("best"), span))).alias("spans"),
    ).select(
        F.col("id").alias(id_column), F.col("n_words").cast("long").alias("n_words"), "n_base",
        "first_word", "last_word", "base_labels", "labels", "score", "spans",
    )


def _sql() -> str:
    """The same figures from one row per word and one per template pair."""
    rows = []
    for number, (text, label) in enumerate([*PHRASES.items(), *PASSAGES.items()]):
        words = text.split()
        rows += [
            f"({number}, {i}, {len(words) - 1}, '{a}', '{b}', '{label}', {number < len(PHRASES)})"
            for i, (a, b) in enumerate(zip(words, words[1:]))
        ]
    lower = f"translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}')"
    return rf"""
WITH t(template, place, grams, a, b, label, exact) AS (VALUES {", ".join(rows)}),
d AS (SELECT doc_id, regexp_extract_all({lower}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
w AS (SELECT doc_id, unnest(words) AS a, unnest(range(len(words))) AS seat FROM d),
p AS (SELECT doc_id, seat, a, lead(a) OVER (PARTITION BY doc_id ORDER BY seat) AS b FROM w),
v AS (SELECT doc_id, template, label, exact, grams, seat - place AS diagonal, list(DISTINCT place) AS places
      FROM p JOIN t USING (a, b) GROUP BY ALL),
e AS (SELECT * EXCLUDE (places), unnest(CASE WHEN exact THEN [diagonal] ELSE range(diagonal - 3, diagonal + 1) END) AS start,
      list_transform(places, lambda p: {{'place': p, 'at': diagonal + p, 'n': 0}}) AS hits FROM v),
c AS (SELECT doc_id, template, label, exact, grams, start,
      list_prepend({{'place': -1, 'at': -1::BIGINT, 'n': 0}}, list_sort(flatten(list(hits)))) AS hits
      FROM e GROUP BY ALL HAVING min(diagonal) = start),
m AS (SELECT *, list_reduce(hits, lambda s, h: CASE WHEN h.place > s.place AND h.at > s.at
      THEN {{'place': h.place, 'at': h.at, 'n': s.n + 1}} ELSE s END).n AS found FROM c),
r AS (SELECT *, found / grams AS share, exact AND found = grams AS base,
      (exact AND found = grams) OR (NOT exact AND found / grams >= 0.8) AS sure FROM m),
g AS (SELECT doc_id, count(*) FILTER (base) AS n_base, min(start) FILTER (base) AS first_word,
      max(start) FILTER (base) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
      string_agg(DISTINCT label, ',' ORDER BY label) FILTER (sure) AS labels, max(share) AS score FROM r GROUP BY doc_id)
SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, CAST(first_word AS BIGINT) AS first_word,
       CAST(last_word AS BIGINT) AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       coalesce(score, 0.0) AS score
FROM d LEFT JOIN g USING (doc_id)"""


@query("op8_license_scan", _sql())
def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents")).drop("spans")
