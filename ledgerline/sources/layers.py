"""Table layers (raw / cleaned / analytics) under one root, in versions.

Rows lie in Parquet folders that are written once and never changed, moved or renamed. A
version is a small file that names the folders of every table. A change writes its folders
first and becomes visible with one new version, so readers see all of it or nothing,
wherever a job is lost. A version counts once it can be read whole; until then the one
before it holds.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ledgerline.operators.ordered import number_rows

LAYERS = ("raw", "cleaned", "analytics")
BUCKET = "_bucket"


class Conflict(RuntimeError):
    """Another change became the next version first."""


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns of ``schema``, in order and cast; a value that does not fit is an error."""
    return df.select(
        *[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields]
    )


@dataclass(frozen=True)
class Folder:
    """Rows of a table: where they lie below the root, how many, and in which bucket."""

    path: str
    rows: int
    bucket: int | None = None


@dataclass(frozen=True)
class Stored:
    """A table as a version has it; ids up to ``last_id`` have been given, and ``loads``
    are the named loads it has, with their rows."""

    schema: StructType
    folders: tuple[Folder, ...] = ()
    last_id: int = 0
    loads: Mapping[str, int] = field(default_factory=dict)

    def as_json(self) -> dict:
        return {
            "schema": self.schema.jsonValue(),
            "folders": [vars(f) for f in self.folders],
            "last_id": self.last_id,
            "loads": dict(self.loads),
        }

    @staticmethod
    def of_json(value: dict) -> Stored:
        folders = tuple(Folder(**f) for f in value["folders"])
        return Stored(StructType.fromJson(value["schema"]), folders, value["last_id"], value["loads"])


Tables = dict[str, Stored]


def _nullable(schema: StructType) -> StructType:
    return StructType([StructField(f.name, f.dataType) for f in schema])


@dataclass(frozen=True)
class Layers:
    """The newest version of the layers, or the one in ``version``."""

    spark: SparkSession
    root: str
    version: int | None = None

    # --- versions ---

    def versions(self) -> list[int]:
        """The versions there are, ascending, also ones that are not whole."""
        folder = self._place(self._versions())
        files = self._files(folder)
        if not files.exists(folder):
            return []
        names = [s.getPath().getName() for s in files.listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def pinned(self, version: int | None = None) -> Layers:
        """These layers at one version, by default the newest, whatever is changed later."""
        return replace(self, version=version if version is not None else self._newest()[0])

    def _newest(self) -> tuple[int, Tables]:
        numbers = [self.version] if self.version is not None else reversed(self.versions())
        for number in numbers:
            if number == 0:
                break
            tables = self._load(number)
            if tables is not None:
                return number, tables
            if self.version is not None:
                raise ValueError(f"{self.root} has no version {number}")
        return 0, {}

    def _load(self, number: int) -> Tables | None:
        place = self._place(f"{self._versions()}/{number:012d}.json")
        files = self._files(place)
        if not files.exists(place):
            return None
        stream = files.open(place)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        try:
            return {name: Stored.of_json(t) for name, t in json.loads(text)["tables"].items()}
        except ValueError:  # not whole
            return None

    def _store(self, number: int, tables: Tables) -> None:
        place = self._place(f"{self._versions()}/{number:012d}.json")
        text = json.dumps({"version": number, "tables": {n: t.as_json() for n, t in tables.items()}})
        files = self._files(place)
        files.mkdirs(place.getParent())
        try:
            stream = files.create(place, False)
        except Exception as e:
            raise Conflict(
                f"version {number} of {self.root} was or is being written by another change; if its job "
                "was lost while writing it, remove_unfinished() lets others go on"
            ) from e
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    # --- tables ---

    def tables(self, layer: str) -> list[str]:
        return sorted(n.split("/", 1)[1] for n in self._newest()[1] if n.startswith(f"{layer}/"))

    def stored(self, layer: str, table: str) -> Stored:
        found = self._newest()[1].get(f"{layer}/{table}")
        if found is None:
            raise ValueError(f"{self.root} has no table {layer}.{table}")
        return found

    def read(self, layer: str, table: str) -> DataFrame:
        return self._read(self.stored(layer, table))

    def _read(self, stored: Stored, folders: Sequence[Folder] | None = None) -> DataFrame:
        folders = stored.folders if folders is None else folders
        if not folders:
            return conform(self.spark.createDataFrame([], stored.schema), stored.schema)
        paths = [f"{self.root.rstrip('/')}/{f.path}" for f in folders]
        return self.spark.read.schema(stored.schema).parquet(*paths)

    @contextmanager
    def change(self) -> Iterator[Change]:
        """Several writes that become visible together, as one version; none after an error."""
        if self.version is not None:
            raise ValueError("a pinned version cannot be changed")
        number, tables = self._newest()
        change = Change(self, number, dict(tables))
        try:
            yield change
            change.commit()
        except BaseException:
            change.discard()
            raise

    def append(
        self, df: DataFrame, layer: str, table: str, schema: StructType, load: str | None = None
    ) -> int:
        """Add rows to a typed table and return how many, counted while writing."""
        with self.change() as change:
            return change.append(df, layer, table, schema, load)

    def replace(
        self, df: DataFrame, layer: str, table: str, partition_by: Sequence[str] = ()
    ) -> int:
        with self.change() as change:
            return change.replace(df, layer, table, partition_by)

    def rebuild(self, layer: str, tables: Mapping[str, StructType]) -> None:
        """Put empty typed tables in place of whatever the layer held."""
        with self.change() as change:
            change.rebuild(layer, tables)

    def register(self, layer: str, tables: Sequence[str]) -> None:
        """Make the tables of this version usable from SQL as ``layer.table``."""
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{layer}`")
        for table in tables:
            stored = self.stored(layer, table)
            columns = [f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in stored.schema]
            nulls = [f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in stored.schema]
            parts = [
                f"SELECT {', '.join(columns)} FROM parquet.`{self.root.rstrip('/')}/{f.path}`" for f in stored.folders if f.rows
            ]
            body = " UNION ALL ".join(parts) or f"SELECT {', '.join(nulls)} WHERE false"
            self.spark.sql(f"CREATE OR REPLACE VIEW `{layer}`.`{table}` AS {body}")

    # --- files ---

    def remove_unfinished(self) -> None:
        """Remove versions that a lost job left unfinished. No change may be under way."""
        for number in self.versions():
            if self._load(number) is None:
                self._delete(f"{self._versions()}/{number:012d}.json")

    def remove_unused(self, keep: int = 2) -> None:
        """Remove versions but the newest ``keep``, and folders that none of them names.
        No change may be under way, and no reader may use an older version."""
        numbers = self.versions()
        kept = [n for n in numbers if self._load(n) is not None][-keep:]
        named = {f.path for n in kept for t in (self._load(n) or {}).values() for f in t.folders}
        for number in numbers:
            if number not in kept:
                self._delete(f"{self._versions()}/{number:012d}.json")
        data = self._place(f"{self.root.rstrip('/')}/_data")
        files = self._files(data)
        base = files.makeQualified(self._place(self.root)).toString().rstrip("/") + "/"
        level = [data] if files.exists(data) else []
        for _ in range(3):  # layer, table, write
            level = [s.getPath() for place in level for s in files.listStatus(place) if s.isDirectory()]
        for place in level:
            path = files.makeQualified(place).toString()[len(base) :]
            if path in named:
                continue
            parts = [s.getPath() for s in files.listStatus(place) if s.getPath().getName().startswith(f"{BUCKET}=")]
            used = [p for p in parts if f"{path}/{p.getName()}" in named]
            for unused in [p for p in parts if p not in used] if used else [place]:
                files.delete(unused, True)

    def remove(self) -> None:
        """Remove the layers with everything in them."""
        self._delete(self.root)

    def _versions(self) -> str:
        return f"{self.root.rstrip('/')}/_versions"

    def _delete(self, path: str) -> None:
        place = self._place(path)
        self._files(place).delete(place, True)

    def _place(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _files(self, place):
        return place.getFileSystem(self.spark._jsc.hadoopConfiguration())


@dataclass
class Change:
    """Writes on top of a version, seen by its own reads only until they are committed."""

    layers: Layers
    base: int
    state: Tables
    written: list[str] = field(default_factory=list)
    touched: set[str] = field(default_factory=set)

    def read(self, layer: str, table: str) -> DataFrame:
        return self.layers._read(self.stored(layer, table))

    def stored(self, layer: str, table: str) -> Stored:
        found = self.state.get(f"{layer}/{table}")
        if found is None:
            raise ValueError(f"{self.layers.root} has no table {layer}.{table}")
        return found

    def has_written(self, layer: str, table: str) -> bool:
        return f"{layer}/{table}" in self.touched

    def _write(self, df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> Folder:
        path = f"_data/{name}/{uuid.uuid4().hex}"
        self.written.append(path)
        counted, audit = _counted(df)
        counted.write.partitionBy(*partition_by).parquet(f"{self.layers.root.rstrip('/')}/{path}")
        return Folder(path, audit.get["rows"])

    def _set(self, name: str, stored: Stored) -> None:
        self.state[name] = stored
        self.touched.add(name)

    def scratch(self, df: DataFrame, name: str) -> DataFrame:
        """Write once and read back; the files go with the change."""
        folder = self._write(df, f"_scratch/{name}")
        return self.layers._read(Stored(df.schema, (folder,)))

    def append(
        self, df: DataFrame, layer: str, table: str, schema: StructType, load: str | None = None
    ) -> int:
        """Add rows to a typed table. A ``load`` that the table has already adds nothing, so
        it can be repeated after a failure; its rows are counted as they were."""
        name = f"{layer}/{table}"
        schema = _nullable(schema)
        stored = self.state.get(name, Stored(schema))
        if load in stored.loads:
            return stored.loads[load]
        folder = self._write(conform(df, schema), name)
        loads = dict(stored.loads) | ({load: folder.rows} if load is not None else {})
        self._set(name, replace(stored, schema=schema, folders=(*stored.folders, folder), loads=loads))
        return folder.rows

    def append_numbered(
        self,
        df: DataFrame,
        layer: str,
        table: str,
        schema: StructType,
        order: Sequence[str],
        cuts: Sequence[Column] = (),
        load: str | None = None,
        id_name: str = "id",
    ) -> int:
        """Add rows with ids that go on after the last one given, in ``order``. No id is
        given twice; those of rows that were removed later are not used again."""
        before = self.state.get(f"{layer}/{table}", Stored(schema))
        if load in before.loads:
            return before.loads[load]
        numbered = number_rows(df, order, id_name, cuts)
        numbered = numbered.withColumn(id_name, F.col(id_name) + before.last_id)
        rows = self.append(numbered, layer, table, schema, load)
        after = self.stored(layer, table)
        self._set(f"{layer}/{table}", replace(after, last_id=before.last_id + rows))
        return rows

    def replace(
        self, df: DataFrame, layer: str, table: str, partition_by: Sequence[str] = ()
    ) -> int:
        name = f"{layer}/{table}"
        folder = self._write(df, name, partition_by)
        inner = [f for f in df.schema if f.name not in partition_by]
        schema = StructType([*inner, *[df.schema[c] for c in partition_by]])
        last = self.state[name].last_id if name in self.state else 0
        self._set(name, Stored(_nullable(schema), (folder,), last))
        return folder.rows

    def rebuild(self, layer: str, tables: Mapping[str, StructType]) -> None:
        for table, schema in tables.items():
            self._set(f"{layer}/{table}", Stored(_nullable(schema)))

    def merge(
        self,
        df: DataFrame,
        layer: str,
        table: str,
        bucket: Column,
        combine: Callable[[DataFrame, DataFrame], DataFrame],
        load: str | None = None,
    ) -> list[int]:
        """Merge rows into a table and return the buckets that were written again.

        ``bucket`` tells from a row's key in which bucket (a number) it lies; only buckets
        with new rows are read and written, the files of the others stay. ``combine`` makes
        the rows of these buckets from the stored and the new ones. A table that does not
        exist yet has no stored rows. A ``load`` that was merged before changes nothing.
        """
        name = f"{layer}/{table}"
        stored = self.state.get(name, Stored(_nullable(df.schema)))
        if load in stored.loads:
            return []
        fresh = self.scratch(df.withColumn(BUCKET, bucket.cast("int")), f"{table}-increment")
        # at most one entry per bucket, here and below
        hit = sorted(r[0] for r in fresh.select(BUCKET).distinct().collect())
        old = [f for f in stored.folders if f.bucket in hit]
        merged = combine(self.layers._read(stored, old), fresh.drop(BUCKET)).select(*stored.schema.names)
        # a bucket's rows in few files: small ones share a task, a large one is split
        dealt = merged.withColumn(BUCKET, bucket.cast("int")).hint("rebalance", BUCKET)
        folder = self._write(dealt, name, [BUCKET])
        path = f"{self.layers.root.rstrip('/')}/{folder.path}"
        counts = self.layers.spark.read.parquet(path).groupBy(BUCKET).count() if folder.rows else None
        rows = {r[0]: r[1] for r in counts.collect()} if counts else {}
        made = [Folder(f"{folder.path}/{BUCKET}={b}", n, b) for b, n in sorted(rows.items())]
        kept = [f for f in stored.folders if f.bucket not in hit]
        loads = dict(stored.loads) | ({load: folder.rows} if load is not None else {})
        self._set(name, replace(stored, folders=(*kept, *made), loads=loads))
        return hit

    def commit(self) -> None:
        """Make everything visible as the next version."""
        if self.touched:
            self.layers._store(self.base + 1, self.state)
            self.touched = set()
        self._remove([p for p in self.written if p.startswith("_data/_scratch/")])

    def discard(self) -> None:
        self._remove(self.written)

    def _remove(self, paths: Sequence[str]) -> None:
        for path in paths:
            self.layers._delete(f"{self.layers.root.rstrip('/')}/{path}")


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    audit = Observation()
    return df.observe(audit, F.count(F.lit(1)).alias("rows")), audit


def export_csv(df: DataFrame, folder: str) -> int:
    """Write CSV part files that :func:`read_csv` takes back, with an audit count."""
    counted, audit = _counted(df)
    (
        counted.write.mode("overwrite")
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(folder)
    )
    return audit.get["rows"]


def export_csv_in_order(df: DataFrame, folder: str, order: Sequence[str]) -> int:
    """Write CSV whose parts, one after the other, are the rows in ``order`` (which should
    be unique): ``_header.csv``, then the numbered part files without headers. Each task
    sorts a range of the order. :func:`read_csv` takes the folder back with ``header=False``,
    and :func:`part_hashes` tells what each part holds."""
    keys = [F.col(f"`{c}`").asc_nulls_first() for c in order]
    # counted behind the shuffle: finding the ranges reads the rows once more
    counted, audit = _counted(df.repartitionByRange(*keys).sortWithinPartitions(*keys))
    options = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    counted.write.mode("overwrite").options(emptyValue="", **options).csv(folder)
    names = [n if not set(n) & set(',"\r\n') else '"' + n.replace('"', '""') + '"' for n in df.columns]
    spark = df.sparkSession
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/_header.csv")
    stream = place.getFileSystem(spark._jsc.hadoopConfiguration()).create(place, True)
    try:
        stream.write(bytearray((",".join(names) + "\n").encode()))
    finally:
        stream.close()
    return audit.get["rows"]


def part_hashes(spark: SparkSession, folder: str) -> DataFrame:
    """part, bytes, sha256 of the part files of an export, to be ordered by ``part``."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    return files.select(
        F.element_at(F.split("path", "/"), -1).alias("part"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256")
    )


def export_parquet(df: DataFrame, folder: str) -> int:
    counted, audit = _counted(df)
    counted.write.mode("overwrite").parquet(folder)
    return audit.get["rows"]
