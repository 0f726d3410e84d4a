"""Cleaning, keys, versions, joins and set operations over the test tables."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from sluice.operators import clean, relational, snapshot
from sluice.plans import adapter as a
from sluice.plans.catalog import Catalog
from sluice.schemas import Entity

C = Catalog(a.SQL)
plain = lambda sql: C.query(sql, common=False)

_TEXTS = """SELECT c_custkey, substr(c_name, length(c_name) - 8) AS id_text, c_name AS bad_text, CASE WHEN c_custkey % 3 = 0 THEN '2001-13-01' WHEN c_custkey % 3 = 1 THEN '1995-01-02T00:00:00Z' ELSE '1999-12-31' END AS day_text FROM customer"""


@plain(f"""SELECT c_custkey::INT AS key, TRY_CAST(id_text AS INT) AS id, TRY_CAST(bad_text AS INT) AS bad, TRY_CAST(substr(day_text, 1, 10) AS DATE) AS day, NULL::DOUBLE AS absent FROM ({_TEXTS})""")
def prj1_typed_projection(s, d):
    a.table(s, d, "customer").createOrReplaceTempView("_prj1_customer")
    df = s.sql(_TEXTS.replace("FROM customer", "FROM _prj1_customer"))
    fields = [("c_custkey", "key", "int"), ("id_text", "id", "int"), ("bad_text", "bad", "int"), ("day_text", "day", "date"), ("nothing", "absent", "double")]
    return df.select(*clean.typed(df, fields))


@plain(r"""SELECT c_custkey, trim(regexp_replace(c_name || chr(13) || chr(10) || chr(10) || c_mktsegment || '  ', '[\r\n]+', ' ', 'g')) AS note FROM customer""")
def prj2_clean_strings(s, d):
    df = a.table(s, d, "customer").select("c_custkey", F.concat("c_name", F.lit("\r\n\n"), "c_mktsegment", F.lit("  ")).alias("note"))
    return clean.clean_strings(df)


_KEYS = "CASE WHEN c_custkey % 5 = 0 THEN NULL WHEN c_custkey % 7 = 0 THEN -c_custkey ELSE c_custkey END"


@plain(f"SELECT * FROM (SELECT {_KEYS} AS k, c_name FROM customer) WHERE k >= 0")
def prj3_valid_keys(s, d):
    return clean.valid_keys(a.table(s, d, "customer").select(F.expr(_KEYS).alias("k"), "c_name"), ["k"])


_ORDER = "l_shipdate l_extendedprice l_partkey l_suppkey l_quantity l_discount l_tax l_returnflag l_linestatus".split()


@plain(f"""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {', '.join(f'{c} DESC' for c in _ORDER)}) AS rn FROM lineitem) WHERE rn = 1""")
def prj4_deduplicate(s, d):
    return clean.latest(a.table(s, d, "lineitem"), ["l_orderkey", "l_linenumber"], _ORDER)


@plain("SELECT l_orderkey, l_linenumber, sha256(l_orderkey || '||' || l_linenumber) AS sk, count(*) AS n FROM lineitem GROUP BY ALL")
def prj6_surrogate_key(s, d):
    return a.table(s, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("n")).withColumn("sk", clean.surrogate_key(["l_orderkey", "l_linenumber"]))


@plain("SELECT o_orderkey, year(o_orderdate)::INT AS year, month(o_orderdate)::INT AS month, day(o_orderdate)::INT AS day FROM orders")
def prj7_date_partitions(s, d):
    return a.table(s, d, "orders").withColumns(clean.date_partitions("o_orderdate")).select("o_orderkey", "year", "month", "day")


_TAX = "CASE c_custkey % 3 WHEN 0 THEN 'T' || c_custkey WHEN 1 THEN '' END"


@plain(f"""SELECT c_custkey, CASE WHEN length(trim(t)) > 0 THEN sha256(c_name) ELSE c_name END AS phone1, CASE WHEN length(trim(t)) > 0 THEN sha256(t) ELSE t END AS federal_tax_id, c_mktsegment AS email FROM (SELECT *, {_TAX} AS t FROM customer)""")
def prj9_mask_partners(s, d):
    df = a.table(s, d, "customer").select("c_custkey", F.col("c_name").alias("phone1"), F.expr(_TAX).alias("federal_tax_id"), F.col("c_mktsegment").alias("email"))
    return clean.mask_partners(df, ["phone1", "federal_tax_id"])


def _documents(s, d):
    """Orders as nested documents: every seventh without lines, every fifth without expenses."""
    lines = a.table(s, d, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.struct(F.col("l_linenumber").alias("LineNum"), F.col("l_partkey").cast("string").alias("ItemCode"), F.col("l_quantity").alias("Quantity"))).alias("l"), F.collect_list(F.struct(F.when(F.col("l_linenumber") % 2 == 0, F.col("l_quantity")).alias("LineTotal"))).alias("e"))
    docs = a.table(s, d, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return docs.select(F.col("o_orderkey").alias("DocEntry"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("DocDate"), F.when(F.col("o_orderkey") % 7 != 0, F.col("l")).alias("DocumentLines"), F.when(F.col("o_orderkey") % 5 != 0, F.col("e")).alias("DocumentAdditionalExpenses"))


_NESTED = Entity("nested", ("doc_entry", "line_num"), [("DocEntry", "doc_entry", "int"), ("DocDate", "doc_date", "date")], [("LineNum", "line_num", "int"), ("ItemCode", "item_code", "string"), ("Quantity", "quantity", "double")])


@plain("""WITH e AS (SELECT l_orderkey, sum(CASE WHEN l_linenumber % 2 = 0 THEN l_quantity ELSE 0 END) AS total FROM lineitem GROUP BY 1)
SELECT o_orderkey::INT AS doc_entry, o_orderdate::DATE AS doc_date, l_linenumber AS line_num, l_partkey::VARCHAR AS item_code, l_quantity AS quantity, CASE WHEN o_orderkey % 5 <> 0 THEN e.total ELSE 0 END AS document_additional_expenses
FROM orders JOIN lineitem l ON o_orderkey = l.l_orderkey JOIN e ON e.l_orderkey = o_orderkey WHERE o_orderkey % 7 <> 0""")
def prj10_prj11_flatten_documents(s, d):
    return clean.flatten(_documents(s, d), _NESTED)


@C.query("SELECT doc_entry, line_num, item_code, quantity, line_total FROM inv JOIN items USING (item_code) WHERE doc_status = 'F' AND cancelled = 'tNO' AND line_total > 0 AND quantity > 0 AND valid = 'tYES'")
def prj15_forecast_population(s, d):
    sellable = a.items(s, d).where(F.col("valid") == "tYES").select("item_code")
    df = a.lines(s, d).where((F.col("doc_status") == "F") & (F.col("cancelled") == "tNO") & (F.col("line_total") > 0) & (F.col("quantity") > 0))
    return df.join(sellable, "item_code", "left_semi").select("doc_entry", "line_num", "item_code", "quantity", "line_total")


@plain("SELECT o_orderkey, o_orderdate, o_totalprice FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1997-07-01' ORDER BY o_orderdate, o_orderkey LIMIT 500")
def src12_dataset_window(s, d):
    """A dataset of a period in a total order; the bounds reach the scan."""
    df = a.table(s, d, "orders").where((F.col("o_orderdate") >= "1996-01-01") & (F.col("o_orderdate") < "1997-07-01"))
    return df.select("o_orderkey", "o_orderdate", "o_totalprice").orderBy("o_orderdate", "o_orderkey").limit(500)


@plain("SELECT * FROM customer WHERE c_custkey % 3 <> 0 AND c_custkey % 2 <> 0 UNION ALL SELECT * REPLACE (c_acctbal + 1 AS c_acctbal) FROM customer WHERE c_custkey % 2 = 0")
def snk3_upsert(s, d):
    t = a.table(s, d, "customer")
    return snapshot.upserted(t.where("c_custkey % 3 <> 0"), t.where("c_custkey % 2 = 0").withColumn("c_acctbal", F.col("c_acctbal") + 1), ["c_custkey"])


_T1, _T2 = datetime.datetime(2001, 1, 1), datetime.datetime(2001, 2, 1)


@plain("""WITH one AS (SELECT c_custkey, c_name, c_nationkey FROM customer WHERE c_custkey % 10 <> 9),
two AS (SELECT c_custkey, c_name, CASE WHEN c_custkey % 7 = 0 THEN c_nationkey + 1 ELSE c_nationkey END AS c_nationkey FROM customer WHERE c_custkey % 11 <> 0)
SELECT one.*, TIMESTAMP '2001-01-01' AS valid_from, CASE WHEN two.c_nationkey <> one.c_nationkey THEN TIMESTAMP '2001-02-01' END AS valid_to, coalesce(two.c_nationkey = one.c_nationkey, true) AS is_current FROM one LEFT JOIN two USING (c_custkey)
UNION ALL SELECT two.*, TIMESTAMP '2001-02-01', NULL, true FROM two LEFT JOIN one USING (c_custkey) WHERE one.c_custkey IS NULL OR one.c_nationkey <> two.c_nationkey""")
def scd2_two_loads(s, d):
    t = a.table(s, d, "customer").select("c_custkey", "c_name", "c_nationkey")
    first = snapshot.scd2(None, t.where("c_custkey % 10 <> 9"), ["c_custkey"], _T1)
    second = t.where("c_custkey % 11 <> 0").withColumn("c_nationkey", F.when(F.col("c_custkey") % 7 == 0, F.col("c_nationkey") + 1).otherwise(F.col("c_nationkey")))
    out = snapshot.scd2(first, second, ["c_custkey"], _T2)
    return out.select("c_custkey", "c_name", "c_nationkey", F.col("_valid_from").alias("valid_from"), F.col("_valid_to").alias("valid_to"), F.col("_is_current").alias("is_current"))


@plain("SELECT DISTINCT l_partkey * 2 AS key FROM lineitem WHERE l_partkey * 2 NOT IN (SELECT p_partkey FROM part)")
def jn14_orphans(s, d):
    return relational.orphans(a.table(s, d, "lineitem").select((F.col("l_partkey") * 2).alias("k")), a.table(s, d, "part"), "k", "p_partkey")


@C.query("""SELECT year, month, sales_person_code, detail, summary FROM (SELECT year, month, sales_person_code, sum(line_total::DECIMAL(18,4))::DOUBLE AS detail, (sum(line_total::DECIMAL(18,4)) + CASE WHEN max(sales_person_code) % 10 = 0 THEN 1 ELSE 0 END)::DOUBLE AS summary FROM inv GROUP BY ALL) WHERE abs(detail - summary) > 0.01""")
def jn15_reconciliation(s, d):
    keys = ["year", "month", "sales_person_code"]
    summary = a.lines(s, d).groupBy(*keys).agg((F.sum(F.col("line_total").cast("decimal(18,4)")) + F.when(F.col("sales_person_code") % 10 == 0, 1).otherwise(0)).cast("double").alias("v"))
    return relational.reconciled(a.lines(s, d), summary, keys, "line_total", "v", 0.01)


@plain("""SELECT event_type, count_a, count_b, abs(coalesce(count_a, 0) - coalesce(count_b, 0)) AS difference FROM (SELECT event_type, count(*) AS count_a FROM events WHERE event_id % 2 = 0 GROUP BY 1) x FULL JOIN (SELECT event_type, count(*) AS count_b FROM events WHERE value > 480 GROUP BY 1) y USING (event_type)""")
def jn18_row_counts(s, d):
    e = a.table(s, d, "events")
    return relational.row_counts(e.where("event_id % 2 = 0"), e.where("value > 480"), ["event_type"])


@plain("SELECT s_suppkey, s_nationkey, n_name, r_name FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey")
def jn3_left_star(s, d):
    t = lambda n: a.table(s, d, n)
    return t("supplier").join(t("nation"), F.col("s_nationkey") == F.col("n_nationkey"), "left").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"), "left").select("s_suppkey", "s_nationkey", "n_name", "r_name")


@plain("""WITH x AS (SELECT c_nationkey AS k, c_mktsegment AS v FROM customer WHERE c_custkey % 2 = 0), y AS (SELECT c_nationkey AS k, c_mktsegment AS v FROM customer WHERE c_custkey % 3 = 0)
SELECT *, 'a_minus_b' AS which_diff FROM (SELECT * FROM x EXCEPT SELECT * FROM y) UNION ALL SELECT *, 'b_minus_a' FROM (SELECT * FROM y EXCEPT SELECT * FROM x)""")
def so3_equality(s, d):
    t = a.table(s, d, "customer").select("c_custkey", F.col("c_nationkey").alias("k"), F.col("c_mktsegment").alias("v"))
    return relational.differences(t.where("c_custkey % 2 = 0").drop("c_custkey"), t.where("c_custkey % 3 = 0").drop("c_custkey"))


@plain("""WITH x AS (SELECT c_nationkey AS value, count(*) AS n FROM customer GROUP BY 1), y AS (SELECT s_nationkey AS value, count(*) AS n FROM supplier GROUP BY 1)
SELECT *, 'a_minus_b' AS which_diff FROM (SELECT * FROM x EXCEPT SELECT * FROM y) UNION ALL SELECT *, 'b_minus_a' FROM (SELECT * FROM y EXCEPT SELECT * FROM x)""")
def so4_cardinality(s, d):
    return relational.cardinality_differences(a.table(s, d, "customer"), "c_nationkey", a.table(s, d, "supplier"), "s_nationkey")


@plain("SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, NULL::DOUBLE AS balance, 'customer' AS _source FROM customer UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal, 'supplier' FROM supplier")
def so6_union_relations(s, d):
    c = a.table(s, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    p = a.table(s, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    return relational.union_relations({"customer": c, "supplier": p})


@plain("""WITH f AS (SELECT o_custkey AS k FROM orders WHERE o_orderkey % 2 = 0), i AS (SELECT o_custkey AS k FROM orders WHERE o_orderkey % 3 = 0), u AS (SELECT k, sum(f) AS f, sum(i) AS i FROM (SELECT k, 1 AS f, 0 AS i FROM f UNION ALL SELECT k, 0, 1 FROM i) GROUP BY k)
SELECT sum(f)::BIGINT AS full_rows, count(*) FILTER (WHERE f > 0) AS full_unique, sum(i)::BIGINT AS incremental_rows, count(*) FILTER (WHERE i > 0) AS incremental_unique, count(*) FILTER (WHERE f = 0 AND i > 0) AS new_keys, count(*) FILTER (WHERE f > 0 AND i > 0) AS updated_keys, count(*) AS total_unique, (sum(f + i) - count(*))::BIGINT AS duplicates_removed FROM u""")
def ag14_key_audit(s, d):
    o = a.table(s, d, "orders")
    return relational.key_audit(o.where("o_orderkey % 2 = 0"), o.where("o_orderkey % 3 = 0"), "o_custkey")


@C.query("SELECT item_code, sum(line_total::DECIMAL(18,4))::DOUBLE AS total FROM inv GROUP BY 1 ORDER BY total DESC, item_code LIMIT 15")
def st4_top_items(s, d):
    return relational.top_groups(a.lines(s, d), ["item_code"], "line_total", 15)


@plain("SELECT event_id, event_type FROM events WHERE event_type IN (SELECT event_type FROM events GROUP BY 1 ORDER BY count(*) DESC, event_type LIMIT 3)")
def st5_rows_of_top_categories(s, d):
    return relational.rows_of_top_values(a.table(s, d, "events").select("event_id", "event_type"), "event_type", 3)


@plain("SELECT c_custkey FROM customer WHERE c_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_suppkey % 4 = 0)")
def vh9_not_in(s, d):
    return relational.not_in(a.table(s, d, "customer").select("c_custkey", "c_nationkey"), "c_nationkey", a.table(s, d, "supplier").where("s_suppkey % 4 = 0"), "s_nationkey").select("c_custkey")


@plain("SELECT o_orderkey FROM orders WHERE (o_custkey, o_orderstatus) IN (SELECT c_custkey, 'F' FROM customer WHERE c_acctbal < 0)")
def vh8_two_key_semi(s, d):
    bad = a.table(s, d, "customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"), F.lit("F").alias("o_orderstatus"))
    return a.table(s, d, "orders").join(bad, ["o_custkey", "o_orderstatus"], "left_semi").select("o_orderkey")


@plain("SELECT user_id, sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END)::BIGINT AS click, sum(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END)::BIGINT AS view, sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END)::BIGINT AS purchase FROM events GROUP BY user_id")
def fn_pivot(s, d):
    return relational.pivoted(a.table(s, d, "events"), ["user_id"], "event_type", ["click", "view", "purchase"], F.lit(1))


@plain("SELECT p_partkey, u.field_name, u.value FROM part, LATERAL (VALUES ('p_brand', p_brand), ('p_type', p_type), ('p_size', p_size::VARCHAR)) u(field_name, value)")
def fn_unpivot(s, d):
    return relational.unpivoted(a.table(s, d, "part"), ["p_partkey"], ["p_brand", "p_type", "p_size"])


@plain("SELECT * FROM (VALUES ('c_new', 'column_added', NULL, 'string'), ('c_acctbal', 'type_changed', 'double', 'decimal(10,2)'), ('c_mktsegment', 'column_removed', 'string', NULL)) t(name, change, old_type, new_type)")
def jn22_schema_changes(s, d):
    t = a.table(s, d, "customer")
    now = t.drop("c_mktsegment").withColumn("c_new", F.lit("x")).withColumn("c_acctbal", F.col("c_acctbal").cast("decimal(10,2)")).withColumnRenamed("c_name", "C_NAME")
    listed = lambda df: s.createDataFrame(df.dtypes, "column_name string, data_type string")
    return relational.column_changes(listed(t), listed(now))


@plain("SELECT c_custkey, c_name, 'x' AS c_name_x FROM customer")
def vh5_columns_except(s, d):
    t = a.table(s, d, "customer")
    keep = [c for c in t.columns if c not in ("c_nationkey", "c_acctbal", "c_mktsegment")]
    return t.select(*keep, F.lit("x").alias("c_name_x"))


@plain("SELECT c_custkey, nullif(CASE WHEN c_custkey % 2 = 0 THEN '' ELSE c_mktsegment END, '') AS segment FROM customer")
def vh6_nullcheck(s, d):
    return a.table(s, d, "customer").select("c_custkey", F.nullif(F.when(F.col("c_custkey") % 2 == 0, "").otherwise(F.col("c_mktsegment")), F.lit("")).alias("segment"))


queries, oracle_sql = C.queries, C.oracle_sql
