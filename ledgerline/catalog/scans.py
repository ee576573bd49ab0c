"""Sources, sinks and layers: tables go out and come back whole."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerline.catalog.analogue import PRINT_ORDER, dim_city, star, with_ctes
from ledgerline.catalog.base import Tables, entry
from ledgerline.operators.ordered import number_rows
from ledgerline.plans import reports
from ledgerline.sources.layers import conform, export_csv, export_csv_in_order, export_parquet
from ledgerline.sources.raw import ORDINAL, read_csv, read_csv_rejects, read_export

_ORDER_COLUMNS = [
    "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority",
]
_ORDERS_AS_TEXT = """
    SELECT o_orderkey::VARCHAR AS o_orderkey, o_custkey::VARCHAR AS o_custkey, o_orderstatus,
           o_totalprice::DECIMAL(18,2)::VARCHAR AS o_totalprice,
           strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority
    FROM orders"""


def _orders_out(t: Tables) -> DataFrame:
    return t.orders.select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        F.col("o_totalprice").cast("decimal(18,2)").alias("o_totalprice"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"),
        "o_orderpriority",
    )


@entry("s1_csv_scan", _ORDERS_AS_TEXT)
def csv_scan(t: Tables) -> DataFrame:
    folder = t.scratch("orders-csv")
    export_csv(_orders_out(t), folder)
    return read_csv(t.spark, folder, _ORDER_COLUMNS)


#: Parts whose size is a multiple of ten have two fields too many, a few others one too few.
_PART_LINE = """p_partkey || ',' || p_name || ',' || p_size ||
    CASE WHEN p_size % 10 = 0 THEN ',"a, b",more' WHEN p_size % 10 = 1 THEN '' ELSE ',' || p_type END"""


@entry(
    "s1_rejected_lines",
    f"""SELECT p_partkey::VARCHAR AS p_partkey, {_PART_LINE} AS line, 5::BIGINT AS fields
        FROM part WHERE p_size % 10 = 0
        UNION ALL
        SELECT p_partkey::VARCHAR, p_name || CASE WHEN p_size % 10 = 1 THEN '' ELSE p_type END, NULL
        FROM part WHERE p_size % 10 <> 0""",
)
def rejected_lines(t: Tables) -> DataFrame:
    """Every line once: as a row, or whole among those that do not fit."""
    folder = t.scratch("part-lines")
    t.part.select(F.expr(_PART_LINE).alias("line")).write.text(folder)
    columns = ["p_partkey", "p_name", "p_size", "p_type"]
    good = read_csv(t.spark, folder, columns, header=False, missing=(), strict=False)
    bad = read_csv_rejects(t.spark, folder, columns, header=False)
    rows = good.select(
        "p_partkey", F.concat("p_name", F.coalesce("p_type", F.lit(""))).alias("line"), F.lit(None).cast("bigint").alias("fields")
    )
    return bad.select(
        F.substring_index("text", ",", 1).alias("p_partkey"), F.col("text").alias("line"), F.col("fields").cast("bigint")
    ).unionByName(rows)


@entry(
    "s2_csv_multi_line",
    """SELECT doc_id::VARCHAR AS doc_id, lang, md5(text) AS text_md5,
              length(text)::BIGINT AS text_length,
              (length(text) - length(replace(text, chr(10), '')))::BIGINT AS line_breaks
       FROM documents""",
)
def csv_multi_line(t: Tables) -> DataFrame:
    folder = t.scratch("documents-csv")
    export_csv(t.documents.select("doc_id", "lang", "text"), folder)
    back = read_csv(t.spark, folder, ["doc_id", "lang", "text"], multi_line=True, missing=())
    text = F.col("text")
    return back.select(
        "doc_id",
        "lang",
        F.md5(text).alias("text_md5"),
        F.length(text).alias("text_length"),
        (F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit("")))).alias("line_breaks"),
    )


@entry(
    "s3_exported_sheet",
    """SELECT p_partkey::VARCHAR AS p_partkey, p_name, p_brand, p_type, p_size::VARCHAR AS p_size
       FROM part""",
)
def exported_sheet(t: Tables) -> DataFrame:
    folder = t.scratch("part-export")
    columns = ["p_partkey", "p_name", "p_brand", "p_type", "p_size"]
    export_parquet(t.part.select(*columns), folder)
    return read_export(t.spark, folder, columns)


@entry(
    "s4_positional_rename",
    """SELECT c_custkey::VARCHAR AS index, c_name AS name, c_mktsegment AS segment
       FROM customer""",
)
def positional_rename(t: Tables) -> DataFrame:
    folder = t.scratch("customer-csv")
    blank_header = t.customer.select("c_custkey", "c_name", "c_mktsegment").toDF(" ", "n", "s")
    export_csv(blank_header, folder)
    return read_csv(t.spark, folder, ["index", "name", "segment"])



def _customer_schema() -> StructType:
    return StructType.fromDDL(
        "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DECIMAL(18,2), "
        "c_mktsegment STRING"
    )


_CUSTOMER_SQL = """
    SELECT c_custkey::BIGINT AS c_custkey, c_name, c_nationkey::BIGINT AS c_nationkey,
           c_acctbal::DECIMAL(18,2)::DOUBLE AS c_acctbal, c_mktsegment
    FROM customer"""


@entry("s5_layer_scan", "SELECT p_partkey, p_name, p_brand FROM part")
def layer_scan(t: Tables) -> DataFrame:
    t.layers.replace(t.part, "cleaned", "part")
    return t.layers.read("cleaned", "part").select("p_partkey", "p_name", "p_brand")


@entry(
    "s6_read_back_derived",
    with_ctes(
        """SELECT city AS city_name, year(month)::BIGINT AS year,
                  sum(net_circulation)::BIGINT AS total_net_circulation
           FROM print_sales JOIN dim_city USING (city_id) GROUP BY 1, 2""",
        "print_sales",
        "dim_city",
    ),
)
def read_back_derived(t: Tables) -> DataFrame:
    t.layers.replace(reports.print_waste(star(t)), "analytics", "primary_analysis_q3")
    stored = t.layers.read("analytics", "primary_analysis_q3")
    return stored.select("city_name", "year", "total_net_circulation")


@entry("k1_append_typed", f"{_CUSTOMER_SQL} UNION ALL {_CUSTOMER_SQL}")
def append_typed(t: Tables) -> DataFrame:
    for _ in range(2):
        t.layers.append(t.customer, "cleaned", "customer", _customer_schema())
    return t.layers.read("cleaned", "customer")


@entry("k1_repeated_load", _CUSTOMER_SQL)
def repeated_load(t: Tables) -> DataFrame:
    """Two loads, the second of them twice."""
    half = F.col("c_custkey") % 2
    for name, rows in ((0, half == 0), (1, half == 1), (1, half == 1)):
        t.layers.append(t.customer.where(rows), "cleaned", "customer", _customer_schema(), load=f"half-{name}")
    return t.layers.read("cleaned", "customer")


@entry(
    "k2_replace_result",
    """SELECT l_returnflag, count(*)::BIGINT AS n, sum(l_quantity)::BIGINT AS copies
       FROM lineitem GROUP BY 1""",
)
def replace_result(t: Tables) -> DataFrame:
    first = t.orders.groupBy("o_orderstatus").count()
    second = t.lineitem.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_quantity").cast("bigint").alias("copies")
    )
    for result in (first, second):
        t.layers.replace(result, "analytics", "by_flag")
    return t.layers.read("analytics", "by_flag")


@entry("k3_csv_export", _CUSTOMER_SQL)
def csv_export(t: Tables) -> DataFrame:
    folder = t.scratch("customer-csv")
    export_csv(t.customer, folder)
    return conform(read_csv(t.spark, folder, _customer_schema().names), _customer_schema())


@entry(
    "k3_ordered_csv_export",
    f"""SELECT row_number() OVER (ORDER BY o_orderdate, lpad(o_orderkey, 12, '0'))::BIGINT AS line, o_orderkey, o_custkey
        FROM ({_ORDERS_AS_TEXT})""",
)
def ordered_csv_export(t: Tables) -> DataFrame:
    """The lines of all parts are numbered as they stand in the files."""
    folder = t.scratch("orders-in-order")
    export_csv_in_order(_orders_out(t).withColumn("key", F.lpad("o_orderkey", 12, "0")), folder, ["o_orderdate", "key"])
    back = read_csv(t.spark, folder, [*_ORDER_COLUMNS, "key"], header=False, ordinal=True)
    placed = number_rows(back, ORDINAL, "line", [F.struct("_file", "_split")])
    return placed.select("line", "o_orderkey", "o_custkey")


@entry(
    "k4_parquet_export",
    """SELECT s_suppkey, s_name, s_nationkey::BIGINT AS s_nationkey, s_acctbal FROM supplier""",
)
def parquet_export(t: Tables) -> DataFrame:
    folder = t.scratch("supplier-export")
    export_parquet(t.supplier, folder)
    return t.spark.read.parquet(folder)


@entry("k5_layer_rebuild", _CUSTOMER_SQL)
def layer_rebuild(t: Tables) -> DataFrame:
    """Running the load twice leaves one copy, because the layer is rebuilt first."""
    for _ in range(2):
        t.layers.rebuild("cleaned", {"customer": _customer_schema()})
        t.layers.append(t.customer, "cleaned", "customer", _customer_schema())
    return t.layers.read("cleaned", "customer")


_AUDITED = ("region", "nation", "customer", "supplier", "part", "orders")


@entry(
    "k6_load_audit",
    " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, count(*)::BIGINT AS loaded_rows FROM {n}" for n in _AUDITED
    ),
)
def load_audit(t: Tables) -> DataFrame:
    """Counts are observed while the tables are written, without another scan."""
    counts = [(n, t.layers.replace(getattr(t, n), "raw", n)) for n in _AUDITED]
    return t.spark.createDataFrame(counts, "table_name STRING, loaded_rows BIGINT")


@entry(
    "k7_surrogate_id",
    f"""SELECT row_number() OVER (ORDER BY {', '.join(PRINT_ORDER)})::BIGINT AS id,
               l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey, l_extendedprice
        FROM lineitem""",
)
def surrogate_id(t: Tables) -> DataFrame:
    rows = t.lineitem.select(*PRINT_ORDER)
    # a range of keys is ordered in one task
    numbered = number_rows(rows, PRINT_ORDER, cuts=[F.shiftright("l_orderkey", 12)])
    return numbered.select("id", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")


@entry(
    "k7_ids_over_loads",
    """SELECT row_number() OVER (ORDER BY o_orderdate >= DATE '1998-01-01', o_orderkey)::BIGINT AS id,
              o_orderkey, o_custkey FROM orders""",
)
def ids_over_loads(t: Tables) -> DataFrame:
    """The second load, which is repeated, goes on with the ids of the first."""
    schema = StructType.fromDDL("id BIGINT, o_orderkey BIGINT, o_custkey BIGINT")
    late = F.col("o_orderdate") >= F.lit("1998-01-01").cast("date")
    for name, rows in (("early", ~late), ("late", late), ("late", late)):
        with t.layers.change() as change:
            change.append_numbered(
                t.orders.where(rows).select("o_orderkey", "o_custkey"), "cleaned", "orders", schema,
                ["o_orderkey"], [F.shiftright("o_orderkey", 12)], load=name,
            )
    return t.layers.read("cleaned", "orders")


@entry(
    "r1_project",
    with_ctes(
        """SELECT city_id, city AS city_name, city || ', ' || state AS label, tier,
                  length(city)::BIGINT AS city_length FROM dim_city""",
        "dim_city",
    ),
)
def project(t: Tables) -> DataFrame:
    return dim_city(t).select(
        "city_id",
        F.col("city").alias("city_name"),
        F.concat_ws(", ", "city", "state").alias("label"),
        "tier",
        F.length("city").alias("city_length"),
    )
