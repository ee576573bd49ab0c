"""Session defaults and the folder that driver and executors share."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Set unless the session was started with something else.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even where that costs one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def build_session(app_name: str = "ledgerline", **settings: str) -> SparkSession:
    """A session with the given settings; what neither they nor spark-submit
    set is taken from ``DEFAULTS``."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    started_with = spark.sparkContext.getConf()
    for key, value in DEFAULTS.items():
        if started_with.get(key) is None:
            spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """A folder every executor can reach: the one in ``spark.checkpoint.dir``, else the
    session's own warehouse, unless that is on the driver's machine and others work too."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.conf.get("spark.sql.warehouse.dir")
        if not spark.sparkContext.master.startswith("local") and folder.startswith(("file:", "/")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors reach")
    return folder.rstrip("/")


def new_shared_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


#: Intermediate tables by the application that made them.
_MADE: dict[str, list[str]] = {}


def written_once(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """The rows, written to the shared folder and read back, and how many there are: what
    follows neither computes them again nor depends on the executors that did. The table
    goes when the driver ends."""
    spark = df.sparkSession
    path = new_shared_path(spark, name)
    made = _MADE.setdefault(spark.sparkContext.applicationId, [])
    if not made:
        atexit.register(_remove, spark)
    made.append(path)
    counted = Observation()
    df.observe(counted, F.count(F.lit(1)).alias("rows")).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), counted.get["rows"]


def _remove(spark: SparkSession) -> None:
    context = spark.sparkContext
    if context._jsc is None:  # stopped
        return
    for path in _MADE.pop(context.applicationId, []):
        place = context._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)
