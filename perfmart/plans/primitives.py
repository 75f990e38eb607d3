"""Single-operator queries on the driver's TPC-H-like tables, each with its
DuckDB oracle.  They exercise the generic operators the report is built from
(sources, projections, filters, joins, aggregates, set operations) on whole
tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perfmart.operators import publish, relational, reshape
from perfmart.sources.envelope import flatten, wrap
from perfmart.sources.files import parquet_roundtrip
from perfmart.sources.standins import table, transco_csv
from perfmart.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _dec_sum(c: str):
    return F.sum(F.col(c).cast("decimal(18,2)")).cast("double")


# -- sources -----------------------------------------------------------------

@query("scan_staging", "SELECT o_orderkey, o_custkey, cast(o_orderdate AS DATE) AS o_orderdate, "
                       "o_orderpriority FROM orders")
def scan_staging(spark, sf):
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("o_orderdate"),
                    "o_orderpriority")


@query("scan_reference", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier "
                         "WHERE s_acctbal > 0")
def scan_reference(spark, sf):
    env = wrap(table(spark, sf, "supplier"), ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"])
    return flatten(env.where(F.col("data.s_acctbal") > 0))


@query("csv_lookup", "SELECT 'IA ' || n_name || ' Sector' AS name, n_name AS \"IA Sector\" FROM nation")
def csv_lookup(spark, sf):
    return transco_csv(spark, sf)


@query("parquet_roundtrip", "SELECT * FROM customer")
def parquet_roundtrip_q(spark, sf):
    return parquet_roundtrip(table(spark, sf, "customer"))


@query("replace_slice", """
WITH m AS (SELECT o_orderkey, o_custkey, o_totalprice,
             cast(date_trunc('month', o_orderdate) AS DATE) AS date FROM orders),
     latest AS (SELECT max(date) AS d FROM m)
SELECT o_orderkey, o_custkey,
       CASE WHEN date = (SELECT d FROM latest) THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice,
       date
FROM m""")
def replace_slice(spark, sf):
    """Publish every month, then re-publish the latest month twice with new
    values: only that partition changes, and publishing is idempotent."""
    o = table(spark, sf, "orders")
    src = o.select("o_orderkey", "o_custkey", "o_totalprice",
                   F.to_date(F.date_trunc("month", "o_orderdate")).alias("date"))
    target = scratch_path(spark, "published")
    publish.publish_slice(src, target)
    latest = src.agg(F.max("date").alias("__d"))
    fresh = (src.join(F.broadcast(latest), F.col("date") == F.col("__d")).drop("__d")
                .withColumn("o_totalprice", F.col("o_totalprice") * 2))
    publish.publish_slice(fresh, target)
    publish.publish_slice(fresh, target)
    return publish.read_published(spark, target).select("o_orderkey", "o_custkey", "o_totalprice", "date")


@query("append_once", """
SELECT o_orderkey, o_custkey, o_totalprice, cast(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders""")
def append_once(spark, sf):
    """S6 on shared files: every order is appended in two slices, one of them
    twice, the second time dealt out otherwise; one copy is left."""
    from perfmart.sources import ledger

    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice",
                                          F.to_date(F.date_trunc("month", "o_orderdate")).alias("month"))
    target = scratch_path(spark, "appended")
    early = F.col("month") < F.lit("1995-01-01").cast("date")
    for rows, name in ((o.where(early), "early"), (o.where(~early), "late"), (o.where(early).repartition(5, "o_custkey"), "early")):
        ledger.append_once(rows, target, name)
    return ledger.read_appended(spark, target, o.schema)


# -- projections ---------------------------------------------------------------

@query("project_drop", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def project_drop(spark, sf):
    return table(spark, sf, "customer").drop("c_nationkey", "c_mktsegment")


@query("project_literal", "SELECT c_custkey, 'IA SECTOR' AS label, 1 AS flag, "
                          "CAST(NULL AS VARCHAR) AS missing FROM customer")
def project_literal(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey", F.lit("IA SECTOR").alias("label"), F.lit(1).alias("flag"),
        F.lit(None).cast("string").alias("missing"))


# -- filters -------------------------------------------------------------------

@query("filter_compare", "SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem "
                         "WHERE l_quantity = 10 AND l_returnflag <> 'R'")
def filter_compare(spark, sf):
    li = table(spark, sf, "lineitem")
    return (li.where((F.col("l_quantity") == 10) & (F.col("l_returnflag") != "R"))
              .select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag"))


@query("filter_nulls", """
SELECT o_orderkey, nullif(o_orderpriority, '5-LOW') AS priority,
       nullif(o_orderpriority, '5-LOW') IS NULL AS low
FROM orders WHERE nullif(o_orderstatus, 'P') IS NOT NULL""")
def filter_nulls(spark, sf):
    o = table(spark, sf, "orders")
    pr = F.nullif(F.col("o_orderpriority"), F.lit("5-LOW"))
    return (o.where(F.nullif(F.col("o_orderstatus"), F.lit("P")).isNotNull())
             .select("o_orderkey", pr.alias("priority"), pr.isNull().alias("low")))


@query("filter_like", """
SELECT p_partkey, p_name, p_type FROM part
WHERE p_name LIKE 'red%' OR p_name LIKE '%bolt' OR p_name LIKE '%in%' OR p_type LIKE 'SMALL'""")
def filter_like(spark, sf):
    p = table(spark, sf, "part")
    return (p.where(F.col("p_name").like("red%") | F.col("p_name").like("%bolt")
                    | F.col("p_name").like("%in%") | F.col("p_type").like("SMALL"))
             .select("p_partkey", "p_name", "p_type"))


@query("filter_not_like", """
SELECT p_partkey, nullif(p_name, 'red bolt') AS p_name FROM part
WHERE nullif(p_name, 'red bolt') NOT LIKE '%ring%'""")
def filter_not_like(spark, sf):
    p = table(spark, sf, "part")
    name = F.nullif(F.col("p_name"), F.lit("red bolt"))
    return p.select("p_partkey", name.alias("p_name")).where(~F.col("p_name").like("%ring%"))


@query("filter_compound", """
SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders
WHERE (o_orderpriority LIKE '1%' AND o_orderstatus = 'F')
   OR (NOT o_orderstatus = 'O' AND o_totalprice > 300000)""")
def filter_compound(spark, sf):
    o = table(spark, sf, "orders")
    cond = ((F.col("o_orderpriority").like("1%") & (F.col("o_orderstatus") == "F"))
            | (~(F.col("o_orderstatus") == "O") & (F.col("o_totalprice") > 300000)))
    return o.where(cond).select("o_orderkey", "o_orderstatus", "o_orderpriority")


@query("recode_cascade", """
SELECT o_orderkey,
  CASE WHEN o_orderpriority LIKE '1%' THEN 'urgent'
       WHEN o_orderpriority LIKE '2%' THEN CASE WHEN o_orderstatus = 'F' THEN 'high-done' ELSE 'high' END
       WHEN o_orderstatus = 'O' THEN 'open'
       ELSE o_orderpriority END AS label
FROM orders""")
def recode_cascade(spark, sf):
    o = table(spark, sf, "orders")
    pr, st = F.col("o_orderpriority"), F.col("o_orderstatus")
    label = (F.when(pr.like("1%"), "urgent")
              .when(pr.like("2%"), F.when(st == "F", "high-done").otherwise("high"))
              .when(st == "O", "open").otherwise(pr))
    return o.select("o_orderkey", label.alias("label"))


# -- aggregates ----------------------------------------------------------------

@query("group_sum", """
SELECT l_returnflag, l_linestatus,
  cast(sum(cast(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS sum_qty,
  cast(sum(cast(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS sum_price,
  count(*) AS n
FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def group_sum(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.groupBy("l_returnflag", "l_linestatus").agg(
        _dec_sum("l_quantity").alias("sum_qty"), _dec_sum("l_extendedprice").alias("sum_price"),
        F.count(F.lit(1)).alias("n"))


@query("distinct_rows", "SELECT DISTINCT o_orderpriority, o_orderstatus FROM orders")
def distinct_rows(spark, sf):
    return table(spark, sf, "orders").select("o_orderpriority", "o_orderstatus").distinct()


@query("distinct_values", "SELECT DISTINCT c_mktsegment FROM customer")
def distinct_values(spark, sf):
    return relational.distinct_values(table(spark, sf, "customer"), "c_mktsegment")


@query("row_count", "SELECT count(*) AS n FROM lineitem")
def row_count(spark, sf):
    return table(spark, sf, "lineitem").agg(F.count(F.lit(1)).alias("n"))


_LI_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
            "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


@query("dedup_subset", """
SELECT * FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY
  l_partkey ASC NULLS FIRST, l_suppkey ASC NULLS FIRST, l_quantity ASC NULLS FIRST,
  l_extendedprice ASC NULLS FIRST, l_discount ASC NULLS FIRST, l_tax ASC NULLS FIRST,
  l_returnflag ASC NULLS FIRST, l_linestatus ASC NULLS FIRST, l_shipdate ASC NULLS FIRST) = 1""")
def dedup_subset(spark, sf):
    return relational.dedup_on(table(spark, sf, "lineitem").select(*_LI_COLS),
                               ["l_orderkey", "l_linenumber"])


# -- joins -------------------------------------------------------------------

@query("join_left_multi", """
WITH s AS (SELECT l_orderkey, l_linestatus, count(*) AS lines,
             cast(sum(cast(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS qty
           FROM lineitem GROUP BY l_orderkey, l_linestatus)
SELECT o.o_orderkey, o.o_orderstatus, s.lines, s.qty
FROM orders o LEFT JOIN s ON o.o_orderkey = s.l_orderkey AND o.o_orderstatus = s.l_linestatus""")
def join_left_multi(spark, sf):
    li = table(spark, sf, "lineitem")
    s = (li.groupBy(F.col("l_orderkey").alias("o_orderkey"), F.col("l_linestatus").alias("o_orderstatus"))
           .agg(F.count(F.lit(1)).alias("lines"), _dec_sum("l_quantity").alias("qty")))
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return o.join(s, ["o_orderkey", "o_orderstatus"], "left")


@query("semi_join", """
SELECT c_custkey, c_mktsegment FROM customer c
WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderpriority = '1-URGENT')""")
def semi_join(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    urgent = (table(spark, sf, "orders").where(F.col("o_orderpriority") == "1-URGENT")
              .select(F.col("o_custkey").alias("c_custkey")))
    return relational.semi_join(c, urgent, "c_custkey")


@query("anti_join_using", """
SELECT c_custkey, nullif(c_nationkey, 3) AS nk FROM customer c
WHERE NOT EXISTS (SELECT 1 FROM supplier s WHERE nullif(s.s_nationkey, 5) = nullif(c.c_nationkey, 3))""")
def anti_join_using(spark, sf):
    """Null keys on both sides: a null never matches, so those rows stay."""
    c = table(spark, sf, "customer").select("c_custkey", F.nullif("c_nationkey", F.lit(3)).alias("nk"))
    s = table(spark, sf, "supplier").select(F.nullif("s_nationkey", F.lit(5)).alias("nk"))
    return relational.anti_join(c, s, "nk")


# -- set operations ----------------------------------------------------------

@query("union_positional", """
SELECT c_nationkey AS nationkey, 'customer' AS side FROM customer
UNION ALL SELECT s_nationkey, 'supplier' FROM supplier""")
def union_positional(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_nationkey").alias("nationkey"), F.lit("customer").alias("side"))
    s = table(spark, sf, "supplier").select("s_nationkey", F.lit("supplier"))
    return relational.union_all([c, s], by_name=False)


@query("union_distinct", """
SELECT c_nationkey AS nationkey FROM customer UNION SELECT s_nationkey FROM supplier""")
def union_distinct(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_nationkey").alias("nationkey"))
    s = table(spark, sf, "supplier").select(F.col("s_nationkey").alias("nationkey"))
    return relational.union_all([c, s]).distinct()


# -- scalar functions ------------------------------------------------------

@query("initcap_label", """
SELECT o_orderkey, array_to_string(list_transform(string_split(lower(o_orderpriority), ' '),
  lambda w: upper(w[1]) || w[2:]), ' ') AS label FROM orders""")
def initcap_label(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", F.initcap("o_orderpriority").alias("label"))


@query("conditional_explode", """
SELECT p_partkey, p_brand AS label FROM part
UNION ALL SELECT p_partkey, p_type FROM part WHERE p_name LIKE 'red%'""")
def conditional_explode(spark, sf):
    p = table(spark, sf, "part")
    labels = F.when(F.col("p_name").like("red%"), F.array("p_brand", "p_type")) \
              .otherwise(F.array("p_brand"))
    return p.select("p_partkey", F.explode(labels).alias("label"))


@query("unpivot_measures", """
SELECT l_orderkey, l_linenumber, 'quantity' AS measure, l_quantity AS value FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, 'price', l_extendedprice FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, 'discount', l_discount FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, 'tax', l_tax FROM lineitem""")
def unpivot_measures(spark, sf):
    li = table(spark, sf, "lineitem")
    return reshape.unpivot_columns(li, ["l_orderkey", "l_linenumber"],
                                   [("l_quantity", "quantity"), ("l_extendedprice", "price"),
                                    ("l_discount", "discount"), ("l_tax", "tax")],
                                   "measure", "value")
