"""What the operators of this package share: tables, intermediate tables, row keys."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Folders of intermediate tables by the application that made them.
_MADE: dict[str, list[str]] = {}
#: Those among them that stages of a pipeline left behind, and catalog tables by folder.
_LEFT: dict[str, list[str]] = {}
_TABLES: dict[str, str] = {}
#: Spark's setting by which shuffle files go when the query that made them has ended.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, which driver and executors share;
    where it is unset (tests, a single machine), one below the warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_intermediate"
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A new folder for an intermediate table; ``release`` removes it, at the latest
    when the driver's process ends."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    made = _MADE.setdefault(spark.sparkContext.applicationId, [])
    if not made:
        atexit.register(release, spark)
    made.append(path)
    return path


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write once and read back: what follows neither recomputes ``df`` nor depends on
    the executors that computed it."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores before it as keep it apart from the columns."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def numbered(docs: DataFrame, name: str = "__row") -> DataFrame:
    """The rows, written once and dealt by a number for each in ``name``, which is none of
    their columns: unlike an id it is never null and never repeated."""
    if free_name(docs, name) != name:
        raise ValueError(f"there is a column {name} already")
    return bucketed(docs.withColumn(name, F.monotonically_increasing_id()), name)


def bucketed(
    df: DataFrame, key: str, then: Callable[[DataFrame], DataFrame] | None = None, move: bool = True
) -> DataFrame:
    """Write ``df`` once, dealt by ``key``, so that later joins do not move it again.
    ``then`` is applied to the rows after they are dealt; it keeps the key. Rows of a table
    that is dealt by the key already need not ``move``; each task then writes what it has."""
    spark = df.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = new_path(spark, "bucketed")
    name = path.rsplit("/", 1)[-1].replace("-", "_")
    dealt = df.repartition(tasks, key) if move else df
    rows = then(dealt) if then else dealt
    rows.write.bucketBy(tasks, key).option("path", path).format("parquet").saveAsTable(name)
    _TABLES[path] = name
    return spark.table(name)


def release(spark: SparkSession) -> None:
    """Remove the intermediate tables made so far. Results must have been written."""
    context = spark.sparkContext
    if context._jsc is None:  # stopped
        return
    _LEFT.pop(context.applicationId, None)
    remove(spark, _MADE.pop(context.applicationId, []))


def remove(spark: SparkSession, paths: list[str]) -> None:
    """Remove these intermediate tables."""
    context = spark.sparkContext
    known = _MADE.get(context.applicationId, [])
    for path in paths:
        if path in _TABLES:
            spark.sql(f"DROP TABLE IF EXISTS `{_TABLES.pop(path)}`")
        place = context._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)
        if path in known:
            known.remove(path)


@contextmanager
def brief_shuffles(spark: SparkSession) -> Iterator[None]:
    """Nothing that is shuffled for an intermediate table is needed once the table is
    there, so in here shuffle files go with the query that made them."""
    before = spark.conf.get(_CLEANUP, None)  # None where only Spark's default holds
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


@contextmanager
def stage(spark: SparkSession, docs: DataFrame) -> Iterator[None]:
    """Around a stage of a pipeline, whose result is written before the next one begins:
    what earlier stages left behind goes, unless ``docs`` reads it, and shuffle files go
    with their query."""
    app = spark.sparkContext.applicationId
    left = _LEFT.pop(app, [])
    if left:
        files = docs.inputFiles()
        used = [p for p in left if any(f"/{p.rsplit('/', 1)[-1]}/" in f for f in files)]
        remove(spark, [p for p in left if p not in used])
        left = used
    before = set(_MADE.get(app, []))
    try:
        with brief_shuffles(spark):
            yield
    finally:
        _LEFT[app] = left + [p for p in _MADE.get(app, []) if p not in before]


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))
