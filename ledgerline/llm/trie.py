"""The trie of common beginnings of conversations, by halving its depth.

A range of depths is cut in the middle. Conversations that agree up to the middle share a
node there, which names the beginning; below it they are a trie of their own. The upper
half and all lower halves are then built in the same way, all at once, so a trie of depth
d takes about log d rounds and not d. A beginning is compared by one digest for the whole
half: digests of neighbouring stretches are put together in the same number of rounds.
The name of a node is the smallest id of the conversations that share it. Totals go the
other way: from the narrowest ranges on, those of the lower tries are grafted on the nodes
of the upper one that lie above them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.llm.common import cut, table
from ledgerline.llm.registry import query

#: Turns by whose value the order within a conversation is cut, as a power of two.
TURNS = 12
#: Ids that are joined to one text before they are hashed, as a power of two.
IDS = 12


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, position (from 1), role, text: by turn (null first), then role and text,
    where null is empty. Rows without a conv_id are in no conversation.

    A task orders the turns of one conversation that lie in one stretch of turn numbers;
    a row for each such stretch carries how many turns stand before it.
    """
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")],
    )
    rows = rows.withColumn("of", F.struct("conv_id", F.shiftright("turn", TURNS).alias("stretch")))
    within = Window.partitionBy("of").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    along = (
        Window.partitionBy("at.conv_id").orderBy(F.col("at.stretch").asc_nulls_first())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    before = rows.groupBy(F.col("of").alias("at")).agg(F.count(F.lit(1)).alias("n")).select(
        "at", F.coalesce(F.sum("n").over(along), F.lit(0)).alias("before")
    )
    placed = rows.withColumn("nth", F.row_number().over(within)).join(before, F.col("of") == F.col("at"))
    return placed.select("conv_id", (F.col("nth") + F.col("before")).alias("position"), "role", "text")


def _digest(*parts: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*parts), 256))


def _long(name: str) -> Column:
    return F.col(name).cast("long").alias(name)


def prefix_trie(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row per node of the trie.

    ``turns``: conv_id, position (1 to the conversation's length), role, text, none of them
    null. ``conversations``: all distinct conv_id, also those without turns. The result:
    conv_id (the smallest of the node's members), depth (0 for the root), parent_conv_id
    (null for the root), n_convs, n_children, n_leaves (childless nodes in its subtree, which
    it is part of), saved_tokens (over the subtree, members but one times the characters of
    a node's last text) and ends_sha256 (of the ids of the conversations that end there, in
    order, comma-joined). No conversations give no rows.
    """
    own = cut(
        turns.select(
            "conv_id", _long("position"), F.length("text").cast("long").alias("chars"),
            _digest(F.length("role").cast("string"), F.lit(":"), "role", "text").alias("digest"),
        ),
        "turns",
    )
    lengths = own.groupBy("conv_id").agg(F.max("position").alias("length"))
    convs = cut(
        conversations.select("conv_id").join(lengths, "conv_id", "left")
        .select("conv_id", F.coalesce("length", F.lit(0)).alias("length")),
        "conversations",
    )
    deepest, first = convs.agg(F.max("length"), F.min("conv_id")).first()
    rounds = (deepest or 0).bit_length()
    names = cut(_names(own, convs, rounds, first), "names")
    nodes = cut(_nodes(own, names), "nodes")
    totals = _grafted(nodes, names, rounds)
    ends = _ends(convs, names)
    return (
        nodes.join(totals, ["depth", "name"]).join(ends, ["depth", "name"], "left")
        .select(
            F.col("name").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children",
            "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
        )
    )


def _names(turns: DataFrame, convs: DataFrame, rounds: int, first: int | None) -> DataFrame:
    """conv_id, depth, name: the node in which each conversation is at each depth."""
    # digests of stretches of 1, 2, 4, ... turns that begin at a multiple of their length
    stretches = [turns.select("conv_id", (F.col("position") - 1).alias("place"), "digest")]
    for _ in range(1, rounds):
        pairs = stretches[-1].groupBy("conv_id", F.shiftright("place", 1).alias("place")).agg(
            F.min_by("digest", "place").alias("one"), F.max_by("digest", "place").alias("other"), F.count("*").alias("n")
        )
        stretches.append(cut(pairs.where("n = 2").select("conv_id", "place", _digest("one", "other").alias("digest")), "stretches"))
    named = [convs.select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit(first).cast("long").alias("name"))]
    for level in range(rounds - 1, -1, -1):
        half = 1 << level
        above = reduce(DataFrame.unionByName, named).withColumn("place", F.shiftright("depth", level))
        halves = above.join(stretches[level], ["conv_id", "place"]).select(
            "conv_id", F.struct((F.col("depth") + half).alias("depth"), "name", "digest").alias("beginning")
        )
        halves = cut(halves, "halves")
        shared = halves.groupBy(F.col("beginning").alias("same")).agg(F.min("conv_id").alias("name"))
        middle = halves.join(shared, F.col("beginning") == F.col("same")).select("conv_id", "beginning.depth", "name")
        named.append(cut(middle, "middle"))
    return reduce(DataFrame.unionByName, named)


def _nodes(turns: DataFrame, names: DataFrame) -> DataFrame:
    """depth, name, parent, n_convs, n_children and chars of the last text."""
    sizes = names.groupBy("depth", "name").agg(F.count("*").alias("n_convs"))
    owners = names.where("conv_id = name").select("depth", "name")
    above = names.select((F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("name"), F.col("name").alias("parent"))
    last = turns.select(F.col("position").alias("depth"), F.col("conv_id").alias("name"), "chars")
    found = cut(
        owners.join(above, ["depth", "name"], "left").join(last, ["depth", "name"], "left").join(sizes, ["depth", "name"]),
        "found",
    )
    children = found.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("parent").alias("name")).agg(
        F.count("*").alias("n_children")
    )
    return found.join(children, ["depth", "name"], "left").select(
        "depth", "name", "parent", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"),
        F.coalesce("chars", F.lit(0)).alias("chars"),
    )


def _grafted(nodes: DataFrame, names: DataFrame, rounds: int) -> DataFrame:
    """depth, name, n_leaves, saved_tokens over each node's subtree: at first of the node
    alone, then within ranges of depths twice as long from round to round."""
    totals = nodes.select(
        "depth", "name", "parent", (F.col("n_children") == 0).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens"),
    )
    for level in range(rounds):
        half = 1 << level
        # roots of the lower tries, summed on the node above them, which stands for all
        # nodes of the upper trie on its path
        lower = totals.where(F.col("depth") % (2 * half) == half).groupBy(
            (F.col("depth") - 1).alias("at"), F.col("parent").alias("conv_id")
        ).agg(F.sum("n_leaves").alias("more_leaves"), F.sum("saved_tokens").alias("more_saved"))
        path = names.select("conv_id", "depth", F.col("name"), F.shiftright("depth", level).alias("range"))
        upper = (
            lower.withColumn("range", F.shiftright("at", level)).join(path, ["conv_id", "range"]).where("depth <= at")
            .groupBy("depth", "name").agg(F.sum("more_leaves").alias("more_leaves"), F.sum("more_saved").alias("more_saved"))
        )
        totals = cut(
            totals.join(upper, ["depth", "name"], "left").select(
                "depth", "name", "parent",
                (F.col("n_leaves") + F.coalesce("more_leaves", F.lit(0))).alias("n_leaves"),
                (F.col("saved_tokens") + F.coalesce("more_saved", F.lit(0))).alias("saved_tokens"),
            ),
            "totals",
        )
    return totals.drop("parent")


def _ends(convs: DataFrame, names: DataFrame) -> DataFrame:
    """depth, name, ends_sha256 of nodes in which conversations end.

    Ids in a range of ``2 ** IDS`` are joined to a text in parallel. A checksum must see
    its texts in order, so those of one node are read by one task, one after the other.
    """
    ending = convs.withColumnRenamed("length", "depth").join(names, ["conv_id", "depth"])
    texts = ending.groupBy("depth", "name", F.shiftright("conv_id", IDS).alias("nth")).agg(
        F.array_join(F.array_sort(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids")
    )
    ordered = texts.repartition("depth", "name").sortWithinPartitions("depth", "name", "nth")

    def hash_in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            done = []
            for depth, name, ids in zip(*[batch.column(c).to_pylist() for c in ("depth", "name", "ids")]):
                if (depth, name) != node:
                    if state is not None:
                        done.append((*node, state.hexdigest()))
                    node, state = (depth, name), hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield _hashes(done)
        if state is not None:
            yield _hashes([(*node, state.hexdigest())])

    return ordered.select("depth", "name", "ids").mapInArrow(hash_in_order, "depth long, name long, ends_sha256 string")


def _hashes(rows: list[tuple[int, int, str]]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [(), (), ()]
    kinds = [pa.int64(), pa.int64(), pa.string()]
    return pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds)], names=["depth", "name", "ends_sha256"])


def rebuilt(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """The conversations of the query: the first turns of the one whose id is the hundred
    below stand in place of as many of a conversation's own."""
    given = conversations.select(
        "conv_id", (F.col("conv_id") - F.col("conv_id") % 100).alias("base"),
        (F.crc32(F.col("conv_id").cast("string")) % 6).alias("given"),
    )
    # at most five turns of a conversation, for at most a hundred others
    bases = turns.where("conv_id % 100 = 0 AND position <= 5").withColumnRenamed("conv_id", "base")
    begins = given.join(bases, "base").where("position <= given").select("conv_id", "position", "role", "text")
    there = bases.groupBy("base").agg(F.max("position").alias("there"))
    shift = given.join(there, "base", "left").select(
        "conv_id", "given", F.least("given", F.coalesce("there", F.lit(0))).alias("kept")
    )
    follows = turns.join(shift, "conv_id").where("position > given").select(
        "conv_id", (F.col("position") - F.col("given") + F.col("kept")).alias("position"), "role", "text"
    )
    return begins.unionByName(follows)


#: h is the checksum of the id's decimal text, one shift of its register at a time.
_SQL = """
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce("text", '') AS body,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce("text", '')) AS p
  FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT conv_id, list(struct_pack(role := role, body := body) ORDER BY p) AS turns FROM turns GROUP BY conv_id
), steps AS (
  SELECT conv_id, turns, list_prepend(4294967295::BIGINT, flatten(list_transform(
    range(1, length(conv_id::VARCHAR) + 1),
    lambda i: list_prepend(ord(substr(conv_id::VARCHAR, i::INT, 1))::BIGINT, list_transform(range(0, 8), lambda k: (-1)::BIGINT))
  ))) AS todo FROM own
), given AS (
  SELECT conv_id, turns, xor(4294967295::BIGINT, list_reduce(todo, lambda c, s:
    CASE WHEN s >= 0 THEN xor(c, s) WHEN c % 2 = 1 THEN xor(c // 2, 3988292384::BIGINT) ELSE c // 2 END)) % 6 AS h
  FROM steps
), rebuilt AS (
  SELECT g.conv_id,
    list_concat(CASE WHEN b.conv_id IS NULL THEN [] ELSE list_slice(b.turns, 1, g.h) END, list_slice(g.turns, g.h + 1, len(g.turns))) AS turns
  FROM given g LEFT JOIN own b ON b.conv_id = g.conv_id - g.conv_id % 100
), depths AS (
  SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS depth FROM rebuilt
), beginnings AS (
  SELECT conv_id, depth, len(turns) = depth AS ends, list_slice(turns, 1, depth) AS beginning FROM depths
), nodes AS (
  SELECT depth, beginning, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256,
    CASE WHEN depth > 0 THEN (count(*) - 1) * length(list_extract(beginning, depth).body) ELSE 0 END AS saved
  FROM beginnings GROUP BY depth, beginning
), children AS (
  SELECT depth - 1 AS depth, list_slice(beginning, 1, depth - 1) AS beginning, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1, 2
), own_totals AS (
  SELECT n.*, coalesce(c.n, 0) AS n_children FROM nodes n LEFT JOIN children c USING (depth, beginning)
), above AS (
  SELECT unnest(range(0, depth + 1)) AS level, beginning, saved, n_children FROM own_totals
), totals AS (
  SELECT level AS depth, list_slice(beginning, 1, level) AS beginning, sum(saved) AS saved_tokens, sum((n_children = 0)::INT) AS n_leaves
  FROM above GROUP BY 1, 2
)
SELECT n.conv_id::BIGINT AS conv_id, n.depth::BIGINT AS depth, p.conv_id::BIGINT AS parent_conv_id, n.n_convs::BIGINT AS n_convs,
  n.n_children::BIGINT AS n_children, t.n_leaves::BIGINT AS n_leaves, t.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM own_totals n JOIN totals t ON t.depth = n.depth AND t.beginning = n.beginning
LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.beginning = list_slice(n.beginning, 1, n.depth - 1)
"""


@query("op12_prefix_trie", _SQL)
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = cut(numbered_turns(table(spark, sf_dir, "conversations")), "given")
    convs = cut(turns.select("conv_id").distinct(), "ids")
    return prefix_trie(rebuilt(turns, convs), convs)
