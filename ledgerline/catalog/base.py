"""Registry of checked queries and the output types both engines agree on."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property, lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.session import new_shared_path
from ledgerline.sources.layers import Layers


@lru_cache(maxsize=None)
def _schema(application: str, path: str, spark: SparkSession) -> T.StructType:
    """Reading footers costs a job, so it is done once per table and session."""
    return spark.read.parquet(path).schema


class Tables:
    """The test tables of one folder, read on first use."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        path = f"{self.folder}/{name}.parquet"
        schema = _schema(self.spark.sparkContext.applicationId, path, self.spark)
        df = self.spark.read.schema(schema).parquet(path)
        setattr(self, name, df)
        return df

    def scratch(self, name: str) -> str:
        """A new folder that all executors can reach."""
        return new_shared_path(self.spark, name)

    @cached_property
    def layers(self) -> Layers:
        return Layers(self.spark, self.scratch("layers"))


Query = Callable[[Tables], DataFrame]


@dataclass(frozen=True)
class Entry:
    build: Query
    sql: str | None

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        return plain_types(self.build(Tables(spark, folder)))


ENTRIES: dict[str, Entry] = {}


def entry(key: str, sql: str | None) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        if key in ENTRIES:
            raise ValueError(f"{key} is registered twice")
        ENTRIES[key] = Entry(build, sql)
        return build

    return register


def plain_types(df: DataFrame) -> DataFrame:
    """Integers as BIGINT, decimals as DOUBLE, dates as text."""
    return df.select(*[_plain(f).alias(f.name) for f in df.schema.fields])


def _plain(field: T.StructField) -> Column:
    c = F.col(f"`{field.name}`")
    kind = field.dataType
    if isinstance(kind, (T.IntegerType, T.ShortType, T.ByteType)):
        return c.cast("bigint")
    if isinstance(kind, (T.DecimalType, T.FloatType)):
        return c.cast("double")
    if isinstance(kind, T.DateType):
        return F.date_format(c, "yyyy-MM-dd")
    return c
