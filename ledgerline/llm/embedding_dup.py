"""Near-duplicate vectors by product quantisation.

Vectors are put into inverted lists by their nearest coarse centre and kept as codes of
their residuals, one code per subspace. A vector probes every list that can hold another
within the wanted distance, table look-ups give its distances to the codes, and a code
passes if the distance is within what its own quantisation error can hide. So neither
lists nor codes lose a link; passing pairs are decided by their exact cosine.

Lists whose centres are near each other are a cell. What probes any list of a cell is sent
to it once, so vectors without structure are moved once per cell and not once per list.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import cut, table
from ledgerline.llm.graph import components
from ledgerline.llm.registry import query
from ledgerline.llm.vectors import chosen, cosines, matrix, unit, usable

COSINE = 0.9
#: Distinct vectors the centres and the codes are fitted on, those with least hashes.
SAMPLE = 16_384
MOST_LISTS = 1024
#: Groups of lists that vectors are sent to.
CELLS = 16
SUBSPACES = 8
CODES = 256
#: Members and probing vectors of a cell in one tile; in large tables this share of all, up
#: to so many components.
BLOCK, BLOCK_SHARE, COMPONENTS = 4096, 16, 1 << 22
#: Those of a tile that are compared at a time.
SLICE = 512
ROUNDS = 8


def nearest_centres(rows: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    squares = np.square(rows).sum(1)[:, None] - 2 * rows @ centres.T + np.square(centres).sum(1)
    return np.argmin(squares, axis=1), np.maximum(squares, 0)


def centres_of(rows: np.ndarray, count: int, seed: int) -> np.ndarray:
    """Lloyd's rounds from rows drawn with a seed; a centre without rows stays."""
    draw = np.random.default_rng(seed)
    centres = rows[draw.permutation(len(rows))[: min(count, len(rows))]].copy()
    for _ in range(ROUNDS):
        own = np.concatenate([nearest_centres(rows[i : i + 4096], centres)[0] for i in range(0, len(rows), 4096)])
        sums = np.zeros_like(centres)
        np.add.at(sums, own, rows)
        sizes = np.bincount(own, minlength=len(centres))
        centres[sizes > 0] = sums[sizes > 0] / sizes[sizes > 0, None]
    return centres


class Index:
    """Coarse centres and the codes of residuals in each subspace."""

    def __init__(self, sample: np.ndarray, lists: int, subspaces: int = SUBSPACES, codes: int = CODES) -> None:
        self.width = -(-sample.shape[1] // subspaces)
        self.subspaces = subspaces
        centres = centres_of(sample, lists, 5)
        cells, _ = nearest_centres(centres, centres_of(centres, CELLS, 6))
        # lists of a cell stand next to each other
        order = np.argsort(cells, kind="stable")
        self.centres, self.cells = centres[order], cells[order]
        self.apart = np.sqrt(nearest_centres(self.centres, self.centres)[1])
        own, _ = nearest_centres(sample, self.centres)
        residuals = self.parted(sample - self.centres[own])
        self.books = np.stack([centres_of(residuals[:, s], codes, 7 + s) for s in range(subspaces)])

    def parted(self, rows: np.ndarray) -> np.ndarray:
        short = self.width * self.subspaces - rows.shape[1]
        return np.pad(rows, ((0, 0), (0, short))).reshape(len(rows), self.subspaces, self.width)

    def encode(self, residuals: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Codes, what they stand for, and how far each vector is from it."""
        parts = self.parted(residuals)
        codes = np.stack([nearest_centres(parts[:, s], self.books[s])[0] for s in range(self.subspaces)], axis=1)
        stood_for = np.stack([self.books[s][codes[:, s]] for s in range(self.subspaces)], axis=1)
        lost = np.sqrt(np.square(parts - stood_for).sum(axis=(1, 2)))
        return codes, stood_for.reshape(len(codes), -1)[:, : residuals.shape[1]], lost

    def probed(self, rows: np.ndarray, own: np.ndarray, distance: float, lists: np.ndarray) -> np.ndarray:
        """Which of the lists come as near as ``distance``: a list's vectors lie behind the
        plane halfway between its centre and the vector's own. Of two lists, the vectors of
        the first probe the second, so that a pair is met once."""
        squares = nearest_centres(rows, self.centres[lists])[1]
        gap = squares - np.square(rows - self.centres[own]).sum(1)[:, None]
        return (gap <= 2 * self.apart[own][:, lists] * distance + 1e-9) & (own[:, None] <= lists)

    def tables(self, rows: np.ndarray) -> np.ndarray:
        """Products of the rows with every code, by subspace and code."""
        return np.matmul(self.books, self.parted(rows).transpose(1, 2, 0))


class Forest:
    """Trees over the nodes 0 to n - 1; links that connect two of them are told."""

    def __init__(self, n: int) -> None:
        self.root = np.arange(n)

    def connect(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which of the links join trees, so many that all are joined."""
        used = []
        at = np.arange(len(a))
        while True:
            x, y = self.root[a[at]], self.root[b[at]]
            apart = x != y
            at, x, y = at[apart], x[apart], y[apart]
            if not len(at):
                return np.concatenate(used) if used else at
            # each tree is hung below one with a smaller root
            upper, first = np.unique(np.maximum(x, y), return_index=True)
            self.root[upper] = np.minimum(x, y)[first]
            used.append(at[first])
            while True:
                above = self.root[self.root]
                if np.array_equal(above, self.root):
                    break
                self.root = above


def are_linked(members: tuple, probers: tuple, m_at: np.ndarray, p_at: np.ndarray, cosine: float) -> np.ndarray:
    """Whether pairs of (rows, units) have the cosine. Where many are asked for, a matrix
    product decides all but those at the cosine."""
    (m_rows, m_units), (p_rows, p_units) = members, probers
    linked = np.zeros(len(m_at), bool)
    asked = np.arange(len(m_at))
    if len(m_at) * 16 > len(m_rows) * len(p_rows):
        products = (m_units @ p_units.T)[m_at, p_at]
        linked = products > cosine
        asked = np.nonzero(np.abs(products - cosine) <= 1e-9)[0]
    for part in range(0, len(asked), 1 << 15):
        some = asked[part : part + (1 << 15)]
        linked[some] = cosines(p_rows[p_at[some]], m_rows[m_at[some]]) >= cosine
    return linked


def tile_links(index: Index, members: tuple, probers: tuple, cosine: float) -> Iterator[tuple[int, int | None, int]]:
    """(a, null, links of a) and (a, b, 0) for links that connect what the tile connects.
    Members and probers are ids, counts, rows, lists; the members are of one cell."""
    # by list, so that slices probe alike
    m_ids, m_counts, m_rows, m_lists = (x[np.argsort(members[3], kind="stable")] for x in members)
    p_ids, p_counts, p_rows, p_lists = (x[np.argsort(probers[3], kind="stable")] for x in probers)
    m_units, p_units = unit(m_rows), unit(p_rows)
    distance = float(np.sqrt(2 - 2 * cosine))
    lists = np.unique(m_lists)
    list_of = np.searchsorted(lists, m_lists)
    codes, stood_for, lost = index.encode(m_units - index.centres[m_lists])
    # |x - c - q|^2 is |x - c|^2, what depends on the code q alone, and products of x with
    # it; single precision is within what is added to the distance
    by_code = np.square(stood_for).sum(1) + 2 * (stood_for * index.centres[m_lists]).sum(1)
    least = (by_code - np.square(distance + lost + 1e-5)).astype(np.float32)[:, None] / 2
    nodes, of = np.unique(np.concatenate([m_ids, p_ids]), return_inverse=True)
    m_of, p_of = of[: len(m_ids)], of[len(m_ids) :]
    totals = np.zeros(len(nodes), np.int64)
    forest = Forest(len(nodes))
    for p in (slice(at, at + SLICE) for at in range(0, len(p_ids), SLICE)):
        probed = index.probed(p_units[p], p_lists[p], distance, lists).T
        if not probed.any():
            continue
        tables = index.tables(p_units[p]).astype(np.float32)
        squares = nearest_centres(index.centres[lists], p_units[p])[1] / 2
        squares = np.where(probed, squares, np.inf).astype(np.float32)
        for m in (slice(at, at + SLICE) for at in range(0, len(m_ids), SLICE)):
            if not probed[list_of[m][0] : list_of[m][-1] + 1].any():
                continue
            products = tables[0][codes[m, 0]]
            for s in range(1, index.subspaces):
                products += tables[s][codes[m, s]]
            products -= squares[list_of[m]]
            # in a list, the smaller id probes
            m_at, p_at = np.nonzero(products >= least[m])
            once = (p_lists[p][p_at] < m_lists[m][m_at]) | (p_ids[p][p_at] < m_ids[m][m_at])
            m_at, p_at = m_at[once], p_at[once]
            linked = are_linked((m_rows[m], m_units[m]), (p_rows[p], p_units[p]), m_at, p_at, cosine)
            m_at, p_at = m_at[linked] + m.start, p_at[linked] + p.start
            np.add.at(totals, p_of[p_at], m_counts[m_at])
            np.add.at(totals, m_of[m_at], p_counts[p_at])
            for i in forest.connect(p_of[p_at], m_of[m_at]):
                yield int(p_ids[p_at[i]]), int(m_ids[m_at[i]]), 0
    for i in np.nonzero(totals)[0]:
        yield int(nodes[i]), None, int(totals[i])


def near_duplicate_vectors(
    vectors: DataFrame, cosine: float = COSINE, id_column: str = "vec_id", vector_column: str = "embedding"
) -> DataFrame:
    """One row per input row: id, n_links (other rows at a cosine of ``cosine`` or more),
    component_id (smallest id that links reach, its own included), kept (it is that id).
    All links are found.

    Null, empty and zero vectors and such with null or not finite components link with
    nothing. Equal vectors are linked and are one node of the search; rows with equal ids
    are rows of their own, and a null id is a component's only if it has no other. All
    usable vectors need one length. An empty table gives no rows.

    The index is fitted on ``SAMPLE`` distinct vectors at most and holds every one. A
    cell's members and those that probe it meet in tiles of ``BLOCK`` times ``BLOCK``, so
    a large cell is many tasks. A tile returns counts and links that connect, never all
    of its pairs. On vectors without structure nearly every list can hold a link, and the
    comparisons of codes grow with the square of the rows.
    """
    spark = vectors.sparkSession
    rows = chosen(vectors, id_column, vector_column)
    classes = cut(
        rows.where(usable(F.col("vector"))).groupBy("vector").agg(F.min("id").alias("smallest"), F.count("*").alias("n"))
        .select("vector", "smallest", "n", F.monotonically_increasing_id().alias("node")),
        "classes",
    )
    total = classes.count()
    linked = spark.createDataFrame([], "a long, b long, links long")
    if total:
        linked = cut(_search(classes, total, cosine), "found")
    counts = linked.where("b IS NULL").groupBy("a").agg(F.sum("links").alias("links"))
    roots = components(linked.where("b IS NOT NULL").select("a", "b")).withColumnRenamed("node", "of")
    grouped = cut(
        classes.join(roots, classes["node"] == roots["of"], "left").join(counts, classes["node"] == counts["a"], "left")
        .select("vector", "smallest", F.coalesce("root", "node").alias("root"),
                (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")),
        "grouped",
    )
    ids = cut(grouped.groupBy("root").agg(F.min("smallest").alias("component")), "ids")
    named = cut(grouped.join(ids, "root").select(F.col("vector").alias("of_vector"), "n_links", "component"), "named")
    result = rows.join(named, rows["vector"] == named["of_vector"], "left").select(
        "id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("of_vector").isNotNull(), F.col("component")).otherwise(F.col("id")).alias("component_id"),
    )
    return result.withColumn("kept", F.col("id").eqNullSafe(F.col("component_id"))).withColumnRenamed("id", id_column)


def _search(classes: DataFrame, total: int, cosine: float) -> DataFrame:
    sample = classes.orderBy(F.xxhash64("vector")).limit(SAMPLE).select("vector").toArrow()
    lists = int(max(1, min(MOST_LISTS, total**0.5)))
    units = unit(matrix(sample.column("vector")))
    index = Index(units, lists)
    rows = max(1, min(max(BLOCK, total // BLOCK_SHARE), COMPONENTS // units.shape[1]))
    distance = float(np.sqrt(2 - 2 * cosine))
    kind = classes.schema["vector"].dataType.simpleString()
    every_list = np.arange(len(index.centres))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                units = unit(matrix(part.column("vector")))
                own, _ = nearest_centres(units, index.centres)
                probes = index.probed(units, own, distance, every_list)
                yield pa.record_batch(
                    [part.column("node"), part.column("n"), part.column("vector"), pa.array(own, pa.int32()),
                     pa.array(index.cells[own], pa.int32()),
                     pa.array([np.unique(index.cells[p]) for p in probes], pa.list_(pa.int32()))],
                    names=["node", "n", "vector", "list", "cell", "probes"],
                )

    placed = cut(
        classes.select("node", "n", "vector").mapInArrow(
            assign, f"node long, n long, vector {kind}, list int, cell int, probes array<int>"),
        "placed",
    )
    probing = placed.select("node", "n", "vector", "list", F.explode("probes").alias("cell"))
    # at most CELLS rows
    sizes = placed.groupBy("cell").agg(F.ceil(F.count("*") / rows).cast("int").alias("member_blocks")).join(
        probing.groupBy("cell").agg(F.ceil(F.count("*") / rows).cast("int").alias("probe_blocks")), "cell"
    )
    sizes = F.broadcast(cut(sizes, "sizes"))

    def dealt(df: DataFrame, own: str, other: str) -> DataFrame:
        block = F.pmod(F.xxhash64("node"), F.col(f"{own}_blocks")).cast("int")
        every = F.explode(F.sequence(F.lit(0), F.col(f"{other}_blocks") - 1))
        # both sides come from one table, so all columns get names of their own
        kept = [F.col(c).alias(c) for c in ("cell", "list", "node", "n", "vector")]
        return df.join(sizes, "cell").select(*kept, block.alias(own), every.alias(other))

    members = dealt(placed.select("cell", "list", "node", "n", "vector"), "member", "probe")
    probers = dealt(probing, "probe", "member")
    key = ["cell", "member", "probe"]

    def tile(m: pa.Table, p: pa.Table) -> pa.Table:
        found = []
        if m.num_rows and p.num_rows:
            sides = [(t.column("node").to_numpy(), t.column("n").to_numpy(), matrix(t.column("vector")),
                      t.column("list").to_numpy()) for t in (m, p)]
            found = list(tile_links(index, *sides, cosine))
        columns = list(zip(*found)) or [(), (), ()]
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("a", "b", "links"), columns)})

    return members.groupBy(*key).cogroup(probers.groupBy(*key)).applyInArrow(tile, "a long, b long, links long")


@query("op6_embedding_near_dup")
def op6_embedding_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_vectors(table(spark, sf_dir, "embeddings"))
