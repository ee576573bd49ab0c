"""Readers for raw exports: everything is text, every row knows where it came from."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ledgerline import schemas
from ledgerline.sources.records import read_records

# Field texts that a typed loader takes for "missing".
MISSING_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
)

# File, position of the split in the file, running number within the task:
# ordering by the three is file order.
ORDINAL = ("_file", "_split", "_row")
ORDINAL_FIELDS = (
    StructField("_file", StringType()), StructField("_split", LongType()), StructField("_row", LongType())
)
# The whole text of a line that does not fit the columns.
MALFORMED = "_malformed"


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    columns: Sequence[str],
    *,
    header: bool = True,
    multi_line: bool = False,
    missing: Sequence[str] = MISSING_TEXTS,
    ordinal: bool = False,
    strict: bool = True,
) -> DataFrame:
    """Read CSV with an explicit all-text schema, matched to the file by position.

    No inference pass and no loss: ``0012`` and ``3709860`` stay what they are,
    and a blank header cell gets the name given here. ``multi_line`` allows line
    breaks in quoted fields; such files are read in ranges like others, after a scan
    that finds where the records begin. Empty fields and the texts in ``missing`` are NULL.
    A line with too few or too many fields is an error if ``strict``. Else one with too
    few is padded with NULL, and any other is left out: :func:`read_csv_rejects` has it.
    """
    lines = _read_lines(spark, path, columns, header, multi_line, "FAILFAST" if strict else "PERMISSIVE")
    if not strict:
        lines = lines.where(~_is_rejected(columns))
    return lines.select(*[_null_if_missing(c, missing) for c in columns], *(ORDINAL if ordinal else ()))


def read_csv_rejects(
    spark: SparkSession,
    path: str | Sequence[str],
    columns: Sequence[str],
    *,
    header: bool = True,
    multi_line: bool = False,
) -> DataFrame:
    """The lines that :func:`read_csv` leaves out unless it is strict, with more fields
    than columns or with an open quote: ``text`` as it is in the file, how many ``fields``
    it has (NULL for an open quote) and where it stands."""
    lines = _read_lines(spark, path, columns, header, multi_line, "PERMISSIVE").where(_is_rejected(columns))
    return lines.select(F.col(MALFORMED).alias("text"), _field_count().alias("fields"), *ORDINAL)


def _read_lines(
    spark: SparkSession, path: str | Sequence[str], columns: Sequence[str], header: bool, multi_line: bool, mode: str
) -> DataFrame:
    """The columns, the whole text of lines that do not fit them, and the ordinal."""
    schema = StructType([StructField(c, StringType()) for c in [*columns, MALFORMED]])
    options = {
        "quote": '"', "escape": '"', "mode": mode, "columnNameOfCorruptRecord": MALFORMED, "maxCharsPerColumn": "-1",
    }
    names = [F.col(f"`{c}`") for c in columns]
    if multi_line:
        records = read_records(spark, path, header)
        ddl = ", ".join(f"`{c}` STRING" for c in schema.names)
        parsed = F.from_csv(F.regexp_replace("record", r"\r\z", ""), ddl, options | {"multiLine": "true"})
        return records.select(parsed.alias("fields"), *ORDINAL).select("fields.*", *ORDINAL)
    # Without pruning, a line is held against all columns, whichever are asked for.
    df = spark.read.schema(schema).options(header=header, columnPruning=False, **options)
    df = df.csv(list(path) if not isinstance(path, str) else path)
    return df.select(
        *names,
        F.col(MALFORMED),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_split"),
        F.monotonically_increasing_id().alias("_row"),
    )


def _field_count() -> Column:
    """Fields of the text in ``MALFORMED``; NULL if a quote is left open."""
    text = F.regexp_replace(F.col(MALFORMED), r'(^|,)"[^"]*+(?:""[^"]*+)*+"(?=,|\r?\z)', "$1")
    commas = F.length(text) - F.length(F.replace(text, F.lit(","), F.lit("")))
    return F.when(~text.rlike('(^|,)"'), commas + 1)


def _is_rejected(columns: Sequence[str]) -> Column:
    fields = _field_count()
    # always true; Spark refuses queries that ask for nothing but the text
    read = F.length(F.concat_ws("", F.col(f"`{columns[0]}`"))) >= 0
    return F.col(MALFORMED).isNotNull() & (fields.isNull() | (fields > len(columns))) & read


def without_missing(raw: DataFrame, missing: Sequence[str] = MISSING_TEXTS) -> DataFrame:
    """A raw table as the cleaners take it: the texts for "missing" are NULL."""
    return raw.select(*[F.col(c) if c in ORDINAL else _null_if_missing(c, missing) for c in raw.columns])


def _null_if_missing(name: str, missing: Sequence[str]) -> Column:
    c = F.col(f"`{name}`")
    return F.when(~c.isin(*missing), c).alias(name) if missing else c


def read_raw(
    spark: SparkSession,
    path: str,
    table: str,
    ordinal: bool = True,
    missing: Sequence[str] = MISSING_TEXTS,
    strict: bool = True,
) -> DataFrame:
    """One of the known raw tables, from CSV or from a Parquet export."""
    columns = schemas.RAW_COLUMNS[table]
    if _is_parquet(path):
        return read_export(spark, path, columns, ordinal)
    return read_csv(
        spark,
        path,
        columns,
        multi_line=table in schemas.MULTI_LINE_TABLES,
        missing=missing,
        ordinal=ordinal,
        strict=strict,
    )


def read_raw_rejects(spark: SparkSession, path: str, table: str) -> DataFrame | None:
    """What :func:`read_raw` leaves out of a CSV export unless it is strict."""
    if _is_parquet(path):
        return None
    multi_line = table in schemas.MULTI_LINE_TABLES
    return read_csv_rejects(spark, path, schemas.RAW_COLUMNS[table], multi_line=multi_line)


def _is_parquet(path: str) -> bool:
    return path.rstrip("/").endswith(".parquet")


def read_export(
    spark: SparkSession, path: str, columns: Sequence[str], ordinal: bool = False
) -> DataFrame:
    """A workbook sheet that was exported to Parquet, taken in as text.

    Columns are matched by position, as for CSV.
    """
    df = spark.read.parquet(path)
    if len(df.columns) != len(columns):
        raise ValueError(f"{path} has {len(df.columns)} columns, expected {len(columns)}")
    selected = [
        F.col(f"`{have}`").cast("string").alias(want) for have, want in zip(df.columns, columns)
    ]
    if ordinal:
        selected += [
            F.col("_metadata.file_path").alias("_file"),
            F.lit(0).cast("bigint").alias("_split"),
            F.col("_metadata.row_index").alias("_row"),
        ]
    return df.select(*selected)
