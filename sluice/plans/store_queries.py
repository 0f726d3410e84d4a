"""Sources, sinks, whole-lake checks and run audits: what goes through files does so in the shared folder."""

from __future__ import annotations

import datetime
import tempfile
import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from sluice.operators import clean, quality, runs
from sluice.operators.snapshot import SnapshotTable
from sluice.plans import adapter as a
from sluice.plans import forecast, lake_checks, marts
from sluice.plans.catalog import Catalog
from sluice.plans.silver_queries import _NESTED, _documents
from sluice.sources import bronze

C = Catalog(a.SQL)
query = C.query
plain = lambda sql: C.query(sql, common=False)


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that all executors share; a local one only where none is set."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir() or tempfile.mkdtemp(prefix="sluice-")
    return f"{root.rstrip('/')}/sluice/{name}-{uuid.uuid4().hex}"


def _put(docs, path: str) -> None:
    """JSON arrays, one file for each group of about 500 documents."""
    groups = max(4, docs.count() // 500)
    arrays = docs.groupBy(F.pmod(F.xxhash64("DocEntry"), F.lit(groups)).alias("g")).agg(F.to_json(F.collect_list(F.struct(*docs.columns))).alias("value"))
    arrays.select("value").write.option("maxRecordsPerFile", 1).text(path)


@plain("""WITH e AS (SELECT l_orderkey, sum(CASE WHEN l_linenumber % 2 = 0 THEN l_quantity ELSE 0 END) AS total FROM lineitem GROUP BY 1),
r AS (SELECT o_orderkey, o_orderdate::DATE AS d, l.*, row_number() OVER (PARTITION BY o_orderkey, l_linenumber ORDER BY 1) AS rn, count(*) OVER (PARTITION BY o_orderkey, l_linenumber) AS c, e.total FROM orders JOIN lineitem l ON o_orderkey = l.l_orderkey JOIN e ON e.l_orderkey = o_orderkey WHERE o_orderkey % 7 <> 0)
SELECT o_orderkey::INT AS doc_entry, l_linenumber AS line_num, CASE WHEN o_orderkey % 3 = 0 THEN d + 1 ELSE d END AS doc_date, (CASE WHEN o_orderkey % 5 <> 0 THEN total ELSE 0 END) AS document_additional_expenses, year(CASE WHEN o_orderkey % 3 = 0 THEN d + 1 ELSE d END)::INT AS year, count(*) AS n FROM r WHERE rn = 1 GROUP BY ALL""")
def src3_bronze_to_silver(s, d):
    """Documents written as full and incremental JSON, read as one, made Silver: a later version wins. Of lines whose key
    repeats inside a document one stays; the columns shown are the document's, so they are the same whichever it is."""
    docs, root = _documents(s, d), scratch(s, "bronze")
    _put(docs, f"{root}/full/year=2024/month=01/day=01")
    later = docs.where("DocEntry % 3 = 0").withColumn("DocDate", F.date_format(F.date_add(F.to_date("DocDate"), 1), "yyyy-MM-dd"))
    _put(later, f"{root}/incremental/year=2024/month=01/day=02")
    read = bronze.read(s, root, "all", schema=_NESTED.source_schema)
    out = clean.silver(read, _NESTED, F.lit(datetime.datetime(2024, 1, 3)))
    return out.groupBy("doc_entry", "line_num", "doc_date", "document_additional_expenses", "year").agg(F.count("*").alias("n"))


@plain("SELECT c_custkey, c_name, CASE WHEN c_custkey % 2 = 0 THEN c_nationkey + 100 ELSE c_nationkey END AS c_nationkey, CASE WHEN c_custkey % 2 = 0 THEN 'new' END AS note FROM customer WHERE c_custkey % 3 <> 0 OR c_custkey % 2 = 0")
def snk1_snapshot_merge(s, d):
    """A table that is made, merged into with one more column, rolled back and forth, and read."""
    t = SnapshotTable(s, scratch(s, "table"), ["c_nationkey"])
    c = a.table(s, d, "customer").select("c_custkey", "c_name", "c_nationkey")
    t.upsert(c.where("c_custkey % 3 <> 0"), ["c_custkey"])
    t.upsert(c.where("c_custkey % 2 = 0").withColumns({"c_nationkey": F.col("c_nationkey") + 100, "note": F.lit("new")}), ["c_custkey"])
    t.rollback(1)
    t.rollback(2)
    return t.read().select("c_custkey", "c_name", "c_nationkey", "note")


@plain("SELECT s_suppkey, s_name FROM supplier WHERE s_suppkey % 2 <> 0 UNION ALL SELECT s_suppkey, 'again' FROM supplier WHERE s_suppkey % 2 = 0")
def vh12_delete_insert(s, d):
    t = SnapshotTable(s, scratch(s, "table"))
    rows = a.table(s, d, "supplier").select("s_suppkey", "s_name")
    t.write(rows.unionByName(s.createDataFrame([(None, "no key")], "s_suppkey long, s_name string")))
    t.delete_insert(rows.where("s_suppkey % 2 = 0").withColumn("s_name", F.lit("again")), ["s_suppkey"])
    return t.read()


@plain("SELECT o_orderkey, o_custkey FROM orders")
def snk7_json_chunks(s, d):
    path = scratch(s, "chunks")
    bronze.write_chunks(a.table(s, d, "orders").select("o_orderkey", "o_custkey"), path, 1000)
    return s.read.schema("o_orderkey long, o_custkey long").json(path)


def _silver_tables(s, d) -> dict:
    """The lake's tables from the test data, with a few planted faults."""
    lines = a.lines(s, d).withColumns({"_silver_loaded_at": F.lit(datetime.datetime(2024, 1, 1)), "line_status": F.when(F.col("line_status") == "O", "bost_Open").otherwise("bost_Close"), "vat_sum": F.col("doc_total") * 0.1})
    history = lambda df: df.withColumns({"_is_current": F.lit(True), "_row_hash": F.lit("h")})
    partners = history(a.partners(s, d)).where("card_code % 50 <> 0")
    items = history(a.items(s, d)).withColumnRenamed("item_group_code", "items_group_code")
    sellers = history(a.sellers(s, d)).withColumnRenamed("sales_person_code", "sales_employee_code")
    groups = a.groups(s, d).withColumnRenamed("item_group_code", "number").where("number <> 13")
    return {"invoices": lines, "orders": lines.where("doc_status = 'F'"), "quotations": lines, "inventory_gen_entries": lines, "business_partners": partners, "items": items, "sales_persons": sellers, "item_groups": groups}


_DUP = "(SELECT count(*) FROM (SELECT 1 FROM {t} GROUP BY doc_entry, line_num HAVING count(*) > 1))"
_HEAD = "(SELECT count(*) FROM (SELECT doc_entry, h, sum(line_total::DECIMAL(18,4))::DOUBLE AS l FROM (SELECT *, {h} AS h FROM inv) GROUP BY 1, 2) WHERE h > 0 AND abs(l - h) > h * 0.05 AND l <= h * 5)"


@query(f"""SELECT check_name, failures FROM (VALUES ('unique_invoices_pk', {_DUP.format(t='inv')}), ('unique_orders_pk', {_DUP.format(t='ped')}), ('unique_quotations_pk', {_DUP.format(t='inv')}), ('unique_inventory_gen_entries_pk', {_DUP.format(t='inv')}),
('scd2_one_current_business_partners', 0), ('scd2_one_current_items', 0), ('scd2_one_current_sales_persons', 0), ('scd2_hash_present', 0), ('scd2_duplicate_hash', 0), ('invoices_partner_known', (SELECT count(*) FROM inv WHERE card_code % 50 = 0)), ('orders_partner_known', (SELECT count(*) FROM ped WHERE card_code % 50 = 0)),
('invoices_item_known', 0), ('orders_item_known', 0), ('item_group_known', (SELECT count(*) FROM items WHERE item_group_code = 13)), ('future_invoices', (SELECT count(*) FROM inv WHERE doc_date > DATE '2001-01-01')), ('future_orders', (SELECT count(*) FROM ped WHERE doc_date > DATE '2001-01-01')), ('future_quotations', (SELECT count(*) FROM inv WHERE doc_date > DATE '2001-01-02')),
('freshness', 0), ('least_rows', 1), ('valid_partitions', (SELECT count(*) FROM (SELECT DISTINCT year, month FROM inv WHERE year < 2000))), ('seller_invoices', 0), ('seller_orders', 0), ('seller_quotations', 0), ('invoice_line_total', (SELECT count(*) FROM inv WHERE line_total < 0)), ('quotation_line_total', 0),
('open_quantity', (SELECT count(*) FROM ped WHERE line_status = 'O' AND quantity <= 0)), ('header_total', {_HEAD.format(h='doc_total')}), ('header_total_and_taxes', {_HEAD.format(h='doc_total - doc_total * 0.1::DOUBLE')})) t(check_name, failures)""")
def dq_silver_checks(s, d):
    t = _silver_tables(s, d)
    least = {"invoices": 1, "orders": 1, "quotations": 1, "business_partners": 10**9}
    checks = lake_checks.silver(t, datetime.date(2001, 1, 1), datetime.datetime(2024, 1, 2), least)
    return quality.run(s, checks).select(F.col("check").alias("check_name"), "failures")


@query(f"""SELECT check_name, failures FROM (VALUES ('credit_decision', 0), ('credit_score', 0), ('stock_not_negative', 0), ('stock_net', 0), ('stock_value', 0), ('conversion_coherent', 0), ('conversion_not_negative', 0),
('margin_range', (SELECT count(*) FROM (SELECT 1 FROM inv GROUP BY year, month, sales_person_code HAVING round(sum(gross_profit::DECIMAL(18,4))::DOUBLE / sum(line_total::DECIMAL(18,4))::DOUBLE * 100, 2) NOT BETWEEN -100 AND 100))), ('valid_partitions', (SELECT count(*) FROM (SELECT DISTINCT year, month FROM inv WHERE year < 2000))),
('rank_begins_at_one', 0), ('revenue_monthly', 0), ('revenue_sellers', 0), ('detail_equals_monthly', 0), ('detail_pk', {_DUP.format(t='inv')})) t(check_name, failures)""")
def dq_gold_checks(s, d):
    from sluice.functions import credit
    from sluice.plans.function_queries import credit_texts

    x = a.lines(s, d)
    t = {
        "analise_credito": credit_texts(s, d).select(credit.parse(F.col("free_text")).alias("f")).select("f.*"),
        "movimentacao_estoque": marts.stock_movement(a.moves(s, d), a.items(s, d), a.groups(s, d)),
        "taxa_conversao": marts.conversion_rate(a.quotes(s, d), a.orders(s, d), a.sellers(s, d)),
        "ranking_vendedores": marts.seller_ranking(x, a.sellers(s, d)),
        "faturamento_mensal": marts.monthly_revenue(x),
        "vendas_detalhada": marts.sales_detail(x, a.sellers(s, d), a.items(s, d), a.groups(s, d)),
    }
    return quality.run(s, lake_checks.gold(t)).select(F.col("check").alias("check_name"), "failures")


def _runs(s, d):
    """Events as runs of models."""
    e = a.table(s, d, "events")
    return e.select(F.col("event_type").alias("model"), F.col("event_id").alias("run_id"), F.col("ts").alias("generated_at"), F.when(F.col("value") > 480, "error").when(F.col("value") > 400, "warn").otherwise("pass").alias("status"))


@plain("SELECT event_type AS model, max(ts) AS generated_at FROM events GROUP BY 1")
def vh14_latest_runs(s, d):
    return runs.latest(_runs(s, d)).select("model", "generated_at")


@plain("SELECT user_id, min(ts) AS started_at, max(ts) AS completed_at, datediff('second', date_trunc('second', min(ts)), date_trunc('second', max(ts))) AS seconds FROM events GROUP BY 1")
def vh15_job_durations(s, d):
    e = a.table(s, d, "events").select("user_id", F.col("ts").alias("started_at"), F.col("ts").alias("completed_at"))
    out = runs.job_durations(e, ["user_id"])
    return out.withColumn("seconds", F.timestamp_diff("SECOND", F.date_trunc("second", "started_at"), F.date_trunc("second", "completed_at")))


@plain("SELECT count(*) AS checks, count(*) FILTER (WHERE value <= 480) AS passed, round(count(*) FILTER (WHERE value <= 480) * 100.0 / count(*), 1) AS percent FROM events WHERE date_trunc('day', ts) = (SELECT max(date_trunc('day', ts)) FROM events)")
def ag20_success_rate(s, d):
    r = _runs(s, d).withColumn("created_at", F.date_trunc("day", "generated_at"))
    return runs.success_rate(r)


@plain("SELECT event_type AS value, count(*) AS n FROM events WHERE value > 100 GROUP BY 1 ORDER BY n DESC, value LIMIT 4")
def vh1_column_values(s, d):
    return a.table(s, d, "events").where("value > 100").groupBy(F.col("event_type").alias("value")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "value").limit(4)


@plain("SELECT event_type AS monitor, min(date_trunc('day', ts)) AS first_bucket, max(date_trunc('day', ts) + INTERVAL 1 DAY) AS last_bucket FROM events GROUP BY 1")
def vh17_monitor_span(s, d):
    e = a.table(s, d, "events").select(F.col("event_type").alias("monitor"), F.date_trunc("day", "ts").alias("bucket_start")).withColumn("bucket_end", F.col("bucket_start") + F.expr("INTERVAL 1 DAY"))
    return runs.monitor_span(e, ["monitor"])


@plain("SELECT p_partkey, round((p_size - m) / s, 4) AS p_size, round((p_retailprice - m2) / s2, 4) AS p_retailprice FROM part, (SELECT avg(p_size) AS m, stddev_samp(p_size) AS s, avg(p_retailprice) AS m2, stddev_samp(p_retailprice) AS s2 FROM part WHERE p_partkey % 2 = 0)")
def ml4_zscore(s, d):
    p = a.table(s, d, "part").select("p_partkey", F.col("p_size").cast("double").alias("p_size"), "p_retailprice")
    z = forecast.ZScore(["p_size", "p_retailprice"]).fit(p.where("p_partkey % 2 = 0")).transform(p)
    return z.select("p_partkey", *[F.round(F.col(c).cast("decimal(24,6)"), 4).cast("double").alias(c) for c in ("p_size", "p_retailprice")])


@plain("SELECT event_id, TRY_CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events WHERE json_valid(props)")
def ud3_json_schema(s, d):
    """Records whose JSON follows the schema."""
    parsed = F.from_json("props", "k BIGINT, _corrupt_record STRING", {"mode": "PERMISSIVE"})
    return a.table(s, d, "events").select("event_id", parsed.alias("j")).where(F.col("j._corrupt_record").isNull()).select("event_id", F.col("j.k").alias("k"))


@plain("SELECT 'orders' AS \"table\", count(*) AS total FROM orders UNION ALL SELECT 'part', count(*) FROM part")
def so2_union_of_counts(s, d):
    return quality.at_least_rows({n: a.table(s, d, n) for n in ("orders", "part")}, {"orders": 10**9, "part": 10**9})


@plain("SELECT DISTINCT c_nationkey, c_mktsegment FROM customer")
def so5_distinct(s, d):
    return a.table(s, d, "customer").select("c_nationkey", "c_mktsegment").distinct()


@plain("SELECT k, in_full, in_incremental FROM (SELECT o_custkey AS k, bool_or(o_orderkey % 2 = 0) AS in_full, bool_or(o_orderkey % 3 = 0) AS in_incremental FROM orders GROUP BY 1) WHERE in_full AND in_incremental")
def so7_key_intersection(s, d):
    o = a.table(s, d, "orders")
    both = o.where("o_orderkey % 2 = 0").select(F.col("o_custkey").alias("k")).intersect(o.where("o_orderkey % 3 = 0").select("o_custkey"))
    return both.withColumns({"in_full": F.lit(True), "in_incremental": F.lit(True)})


@plain("SELECT count(*) AS in_range FROM events WHERE ts BETWEEN (SELECT min(ts) FROM events WHERE event_type = 'purchase') AND (SELECT max(ts) FROM events WHERE event_type = 'purchase')")
def vh10_scalar_bounds(s, d):
    e = a.table(s, d, "events")
    b = e.where("event_type = 'purchase'").agg(F.min("ts").alias("low"), F.max("ts").alias("high"))
    return e.crossJoin(F.broadcast(b)).where("ts BETWEEN low AND high").agg(F.count("*").alias("in_range"))  # one row


@plain("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_quantity > 49 ORDER BY l_orderkey, l_linenumber, l_partkey LIMIT 20")
def st3_failing_sample(s, d):
    return a.table(s, d, "lineitem").where("l_quantity > 49").orderBy("l_orderkey", "l_linenumber", "l_partkey").limit(20).select("l_orderkey", "l_linenumber")


@plain("SELECT k.p_partkey, k.p_brand FROM (SELECT p_brand, max(p_partkey) AS p_partkey FROM part GROUP BY 1) k")
def jn23_dedup_by_join(s, d):
    p = a.table(s, d, "part").select("p_brand", "p_partkey")
    return clean.latest_by_rank(p, ["p_brand"], [F.desc("p_partkey")]).select("p_partkey", "p_brand")


@plain("SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL")
def vh7_group_by_all(s, d):
    a.table(s, d, "orders").createOrReplaceTempView("_vh7_orders")
    return s.sql("SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM _vh7_orders GROUP BY ALL")


@query("SELECT cancelled, count(*) AS n FROM (SELECT CASE WHEN item_code % 9 = 0 THEN NULL ELSE cancelled END AS cancelled FROM inv) WHERE cancelled <> 'tYES' GROUP BY 1")
def prj16_not_cancelled(s, d):
    x = a.lines(s, d).withColumn("cancelled", F.when(F.col("item_code") % 9 != 0, F.col("cancelled")))
    return marts._live(x).groupBy("cancelled").agg(F.count("*").alias("n"))


queries, oracle_sql = C.queries, C.oracle_sql
