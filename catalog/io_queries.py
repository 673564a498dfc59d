"""Round trips through files in the shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog import panels as P
from catalog.registry import query
from catalog.sql import sql
from panelkit.session import scratch_folder, shared_folder
from panelkit.sources import csv, tables

LONG, TEXT, DOUBLE = T.LongType(), T.StringType(), T.DoubleType()


def fresh(spark, label: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def schema(**fields) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


@query("csv_scan", "select c_custkey, c_name, c_acctbal, nullif(c_mktsegment, 'BUILDING') as c_mktsegment from customer")
def csv_scan(spark, sf):
    """A header CSV folder read with a schema; a token becomes NULL."""
    path = fresh(spark, "csv")
    P.table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment").write.option("header", True).csv(path)
    return csv.read_csv_table(spark, path, schema(c_custkey=LONG, c_name=TEXT, c_acctbal=DOUBLE, c_mktsegment=TEXT),
                              null_tokens=("", "BUILDING"))


@query("csv_title_skip", "select c_custkey as customer_key, replace(c_mktsegment, 'A', 'Á') as market_segment, c_acctbal as balance_pct from customer")
def csv_title_skip(spark, sf):
    """Latin-1 files that each start with a title line and a header line.

    Every file is one bucket of customers, written by its own task in order:
    title, header, rows.
    """
    path, files = fresh(spark, "title"), int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = P.table(spark, sf, "customer").select(
        F.pmod(F.hash("c_custkey"), F.lit(files)).alias("file"), F.lit(2).alias("line"),
        F.col("c_custkey").cast("string").alias("a"), F.replace("c_mktsegment", F.lit("A"), F.lit("Á")).alias("b"),
        F.col("c_acctbal").cast("string").alias("c"))
    top = [(0, "Table 1: customers, é", None, None), (1, "Customer key", "Market/segment", "Balance (%)")]
    heads = spark.createDataFrame(top, "line int, a string, b string, c string").withColumn(
        "file", F.explode(F.sequence(F.lit(0), F.lit(files - 1))))
    rows.unionByName(heads).repartition("file").sortWithinPartitions("file", "line").drop("line").write.partitionBy(
        "file").option("encoding", "ISO-8859-1").csv(path)
    raw = csv.read_csv_table(spark, f"{path}/*", skip_rows=1, encoding="ISO-8859-1")
    return raw.select(F.col("customer_key").try_cast("bigint").alias("customer_key"), "market_segment",
                      F.col("balance_pct").try_cast("double").alias("balance_pct"))


@query("csv_missing", "select cast(count(*) as bigint) as n_rows, cast(0 as bigint) as missing_rows from region")
def csv_missing(spark, sf):
    """A missing source counts as empty."""
    gone = csv.read_csv_table(spark, fresh(spark, "none"), schema(a=TEXT))
    return P.table(spark, sf, "region").agg(
        F.count(F.lit(1)).alias("n_rows"), gone.select(F.count(F.lit(1))).scalar().alias("missing_rows"))


@query("table_roundtrip", sql("select period, category, stratum, n, cents from p4"))
def table_roundtrip(spark, sf):
    """A table written by period and read back; the second write replaces the first."""
    path, df = fresh(spark, "table"), P.p4(spark, sf)
    tables.write_table(df, path, partition_by=["period"])
    tables.write_table(df, path, partition_by=["period"])
    return tables.read_table(spark, path).select("period", "category", "stratum", "n", "cents")


@query("export_table", sql("""
select entity as "Entity", period::bigint as "Year", cents as "Revenue (cents)", n_rows as "Lines" from p1
"""))
def export_table(spark, sf):
    """A sorted CSV with display headers."""
    path = fresh(spark, "export")
    tables.export_csv(P.p1(spark, sf), path, {"entity": "Entity", "period": "Year", "cents": "Revenue (cents)", "n_rows": "Lines"},
                      sort=["entity", "period"])
    names = {"Entity": TEXT, "Year": LONG, "Revenue (cents)": LONG, "Lines": LONG}
    return csv.read_csv_table(spark, path, schema(**names))


@query("bucketed_join", """
select o_orderpriority, count(*) as n_orders, sum(n_lines)::bigint as n_lines, sum(cents)::bigint as cents
from orders join (select l_orderkey, count(*) as n_lines, sum(cast(round(l_extendedprice * 100) as bigint)) as cents from lineitem group by 1)
     on l_orderkey = o_orderkey
group by 1
""")
def bucketed_join(spark, sf):
    """Lines summed per order and joined with orders; both tables are kept in buckets of orders, so neither is shuffled again."""
    mark = uuid.uuid4().hex
    lines = P.table(spark, sf, "lineitem").select("l_orderkey", F.floor(F.col("l_extendedprice") * 100 + 0.5).alias("cents"))
    lines = tables.write_bucketed(lines, f"lines_{mark}", f"{scratch_folder(spark)}/lines-{mark}", ["l_orderkey"], 8)
    orders = tables.write_bucketed(P.table(spark, sf, "orders").select("o_orderkey", "o_orderpriority"), f"orders_{mark}",
                                   f"{scratch_folder(spark)}/orders-{mark}", ["o_orderkey"], 8)
    per_order = lines.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n_lines"), F.sum("cents").alias("cents"))
    joined = orders.join(per_order, F.col("o_orderkey") == F.col("l_orderkey"))
    return joined.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n_orders"), F.sum("n_lines").alias("n_lines"), F.sum("cents").alias("cents"))
