"""The tables of the test data as invoice lines and dimensions; the SQL says the same for the oracle."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = datetime.date(2001, 9, 1)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = lambda n: table(spark, sf_dir, n)
    df = t("lineitem").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    df = df.join(t("part").select("p_partkey", "p_name", "p_retailprice"), F.col("l_partkey") == F.col("p_partkey"))
    df = df.join(t("supplier").select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
    value = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    day = F.col("o_orderdate").cast("date")
    return df.select(
        F.col("l_orderkey").alias("doc_entry"), F.col("l_linenumber").alias("line_num"), day.alias("doc_date"), F.year(day).alias("year"), F.month(day).alias("month"),
        F.col("o_custkey").alias("card_code"), F.concat(F.lit("Customer#"), F.col("o_custkey").cast("string")).alias("card_name"), F.col("l_suppkey").alias("sales_person_code"), F.col("l_partkey").alias("item_code"),
        F.col("p_name").alias("item_description"), F.col("s_nationkey").alias("warehouse_code"), F.col("l_quantity").alias("quantity"), (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
        (F.col("l_discount") * 100).alias("discount_percent"), value.alias("line_total"), (value - F.col("p_retailprice") * F.col("l_quantity") * 0.7).alias("gross_profit"),
        F.col("l_linestatus").alias("line_status"), F.col("o_orderstatus").alias("doc_status"), F.when(F.col("l_returnflag") == "R", "tYES").otherwise("tNO").alias("cancelled"),
        F.col("o_totalprice").alias("doc_total"),
    )


def quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines(spark, sf_dir)


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines(spark, sf_dir).where(F.col("doc_status") == "F")


def sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("sales_person_code"), F.col("s_name").alias("sales_person_name"))


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("item_code"), F.col("p_name").alias("item_name"), F.col("p_size").alias("item_group_code"), F.col("p_brand").alias("brand"), F.when(F.col("p_partkey") % 10 == 0, "tNO").otherwise("tYES").alias("valid"))


def groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(F.col("p_size").alias("item_group_code"), F.concat(F.lit("Group "), F.col("p_size").cast("string")).alias("group_name")).distinct()


def partners(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("card_code"), F.col("c_mktsegment").alias("tipo_cliente"), F.col("c_nationkey").alias("grupo_cliente"), F.col("c_acctbal").alias("saldo_conta_corrente"))


def moves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stock movements: cancelled lines are issues."""
    sign = F.when(F.col("cancelled") == "tYES", -1).otherwise(1)
    return lines(spark, sf_dir).withColumns({"quantity": F.col("quantity") * sign, "line_total": F.col("line_total") * sign})


SQL = """
inv AS (SELECT l_orderkey AS doc_entry, l_linenumber AS line_num, CAST(o_orderdate AS DATE) AS doc_date, year(o_orderdate)::INT AS year, month(o_orderdate)::INT AS month,
  o_custkey AS card_code, 'Customer#' || o_custkey AS card_name, l_suppkey AS sales_person_code, l_partkey AS item_code, p_name AS item_description, s_nationkey AS warehouse_code,
  l_quantity AS quantity, l_extendedprice / l_quantity AS unit_price, l_discount * 100 AS discount_percent, l_extendedprice * (1 - l_discount) AS line_total,
  l_extendedprice * (1 - l_discount) - p_retailprice * l_quantity * 0.7::DOUBLE AS gross_profit, l_linestatus AS line_status, o_orderstatus AS doc_status,
  CASE WHEN l_returnflag = 'R' THEN 'tYES' ELSE 'tNO' END AS cancelled, o_totalprice AS doc_total
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey),
live AS (SELECT * FROM inv WHERE cancelled <> 'tYES'),
ped AS (SELECT * FROM inv WHERE doc_status = 'F'),
sellers AS (SELECT s_suppkey AS sales_person_code, s_name AS sales_person_name FROM supplier),
items AS (SELECT p_partkey AS item_code, p_name AS item_name, p_size AS item_group_code, p_brand AS brand, CASE WHEN p_partkey % 10 = 0 THEN 'tNO' ELSE 'tYES' END AS valid FROM part),
grp AS (SELECT DISTINCT p_size AS item_group_code, 'Group ' || p_size AS group_name FROM part),
partners AS (SELECT c_custkey AS card_code, c_mktsegment AS tipo_cliente, c_nationkey AS grupo_cliente, c_acctbal AS saldo_conta_corrente FROM customer),
moves AS (SELECT * EXCLUDE (quantity, line_total), quantity * CASE WHEN cancelled = 'tYES' THEN -1 ELSE 1 END AS quantity, line_total * CASE WHEN cancelled = 'tYES' THEN -1 ELSE 1 END AS line_total FROM inv)
"""
