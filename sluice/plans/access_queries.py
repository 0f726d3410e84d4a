"""Reading and writing by slices, catalog helpers, target panels, and the chained features of the forecast."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from sluice.operators import relational, runs, series
from sluice.operators.snapshot import SnapshotTable
from sluice.plans import adapter as a
from sluice.plans import eda, forecast
from sluice.plans.catalog import Catalog
from sluice.plans.series_queries import _W, KEYS, full, r
from sluice.plans.series_queries import C as SERIES
from sluice.plans.silver_queries import _NESTED, _documents
from sluice.plans.store_queries import _put, scratch
from sluice.sources import bronze

C = Catalog(a.SQL)
S = Catalog(SERIES.common)
query = C.query
plain = lambda sql: C.query(sql, common=False)


@plain("SELECT o_orderkey::INT AS doc_entry, o_orderdate::DATE AS doc_date FROM orders")
def src1_full_load(s, d):
    """Documents of the full load only, whatever increments lie beside it."""
    docs, root = _documents(s, d), scratch(s, "bronze")
    _put(docs, f"{root}/full/year=2024/month=01/day=01")
    _put(docs.withColumn("DocDate", F.lit("1990-01-01")), f"{root}/incremental/year=2024/month=01/day=02")
    return bronze.read(s, root, "full", schema=_NESTED.source_schema).select(F.col("DocEntry").cast("int").alias("doc_entry"), F.to_date("DocDate").alias("doc_date"))


@plain("SELECT o_orderkey::INT AS doc_entry FROM orders WHERE o_orderkey % 3 = 0")
def src2_incremental_load(s, d):
    """The increment of one day among several."""
    docs, root = _documents(s, d), scratch(s, "bronze")
    for day in (2, 3):
        _put(docs.where(F.col("DocEntry") % day == 0), f"{root}/incremental/year=2024/month=01/day={day:02d}")
    return bronze.read(s, root, "incremental", datetime.date(2024, 1, 3), schema=_NESTED.source_schema).select(F.col("DocEntry").cast("int").alias("doc_entry"))


@plain("SELECT n_nationkey, n_name FROM nation UNION ALL SELECT n_nationkey + 100, n_name FROM nation UNION ALL SELECT 900, 'one'")
def src11_any_json(s, d):
    """Files that hold JSON lines, an array and one object, read by one reader."""
    n, path = a.table(s, d, "nation").select(F.col("n_nationkey").cast("long").alias("n_nationkey"), "n_name"), scratch(s, "any")
    n.coalesce(1).write.json(f"{path}/lines")
    n.withColumn("n_nationkey", F.col("n_nationkey") + 100).agg(F.to_json(F.collect_list(F.struct("n_nationkey", "n_name"))).alias("value")).write.text(f"{path}/array")  # 25 rows
    s.sql("""SELECT '{"n_nationkey": 900, "n_name": "one"}' AS value""").write.text(f"{path}/object")
    schema = n.schema
    return bronze.read_any(s, f"{path}/*/*", schema)


@query("SELECT doc_entry, line_num, doc_date FROM inv WHERE year IN (1995, 1996, 1997) AND NOT (year = 1996 AND month > 6)")
def src13_by_months(s, d):
    """Months read as slices, each from its own partitions, and put together."""
    path = scratch(s, "months")
    a.lines(s, d).select("doc_entry", "line_num", "doc_date", "year", "month").repartition("year", "month").write.partitionBy("year", "month").parquet(path)
    months = [(y, m) for y in (1995, 1996, 1997) for m in range(1, 13) if not (y == 1996 and m > 6)]
    return bronze.read_months(s, path, months).select("doc_entry", "line_num", "doc_date")


@query("SELECT doc_entry, line_num, doc_date FROM inv WHERE doc_date >= DATE '2000-12-31' - 90")
def src14_last_days(s, d):
    return bronze.last_days(a.lines(s, d), "doc_date", datetime.date(2000, 12, 31), 90).select("doc_entry", "line_num", "doc_date")


@plain("SELECT c_custkey, c_nationkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS place FROM customer")
def st2_sorted_write(s, d):
    """Rows with their place in the file that they were written to, one file a partition in the order of the key."""
    t = SnapshotTable(s, scratch(s, "sorted"), ["c_nationkey"])
    t.write(a.table(s, d, "customer").select("c_custkey", "c_nationkey"), sort_by=["c_custkey"])
    return t.read().select("c_custkey", "c_nationkey", (F.col("_metadata.row_index") + 1).alias("place"))


@plain("SELECT c_custkey, c_nationkey FROM customer")
def snk11_compacted(s, d):
    """A table written in many small files, rewritten in few: the rows stay."""
    t = SnapshotTable(s, scratch(s, "compacted"), ["c_nationkey"])
    t.write(a.table(s, d, "customer").select("c_custkey", "c_nationkey"), files=4)
    t.compact(1 << 20)
    return t.read()


@plain("SELECT 3::BIGINT AS version, 'overwrite' AS operation, (SELECT count(*) FROM region) AS n UNION ALL SELECT 4, 'upsert', (SELECT count(*) FROM region)")
def snk12_history_after_expiry(s, d):
    """What is left of a table's versions after old ones expire."""
    t = SnapshotTable(s, scratch(s, "history"))
    rows = a.table(s, d, "region").select("r_regionkey", "r_name")
    for n in (1, 2, 3):
        t.write(rows, at=datetime.datetime(2024, 1, n))
    t.upsert(rows.where("r_regionkey = 1"), ["r_regionkey"], at=datetime.datetime(2024, 1, 4))
    t.expire(datetime.datetime(2024, 1, 3), keep=1)
    t.remove_orphans()
    out = None
    for h in t.history():
        one = t.read(h["version"]).agg(F.count("*").alias("n")).select(F.lit(h["version"]).cast("long").alias("version"), F.lit(h["operation"]).alias("operation"), "n")
        out = one if out is None else out.unionByName(one)
    return out


@plain("SELECT 'F' AS found, 'none' AS missing")
def vh2_first_or_default(s, d):
    o = a.table(s, d, "orders")
    one = relational.first_or(o.where("o_orderstatus = 'F'").select("o_orderstatus"), "none").toDF("found")
    return one.crossJoin(relational.first_or(o.where("o_orderstatus = 'nothing'").select("o_orderstatus"), "none").toDF("missing"))  # one row each


@plain("SELECT string_agg(n_name, ',' ORDER BY n_name) AS names, sum(n_nationkey)::BIGINT AS total FROM nation")
def vh3_columns_as_dict(s, d):
    """A small result as lists by column name, used to make another."""
    columns = relational.as_dict(a.table(s, d, "nation").select("n_name", "n_nationkey").orderBy("n_name"), most=1000)
    return s.createDataFrame([(",".join(columns["n_name"]), sum(columns["n_nationkey"]))], "names string, total long")


@plain("SELECT * FROM (VALUES ('_vh4_customer'), ('_vh4_part')) t(name)")
def vh4_relations_by_pattern(s, d):
    for name in ("customer", "part", "orders", "part_old"):
        a.table(s, d, name.split("_")[0]).createOrReplaceTempView(f"_vh4_{name}")
    return relational.relations(s, r"\_vh4\_%", exclude=[r"%\_old", r"\_VH4\_orders"])


@plain("SELECT n_nationkey, n_name FROM nation")
def vh13_insert_rows(s, d):
    """Rows of the driver appended to a table, so many at a time."""
    path = scratch(s, "inserted")
    rows = [tuple(x) for x in a.table(s, d, "nation").select("n_nationkey", "n_name").limit(10_000).collect()]  # few by nature
    relational.insert_rows(s, path, iter(rows), "n_nationkey long, n_name string", chunk=10)
    return s.read.parquet(path)


@query("""WITH w AS (SELECT date_trunc('week', doc_date)::DATE AS p, sum(line_total::DECIMAL(18,4))::DOUBLE AS total FROM inv GROUP BY 1),
g AS (SELECT warehouse_code, sum(line_total::DECIMAL(18,4)) AS t FROM inv GROUP BY 1 ORDER BY t DESC, warehouse_code LIMIT 5)
SELECT 'week' AS panel, p AS period, NULL AS "key", total FROM w UNION ALL SELECT 'warehouse_code', date_trunc('month', doc_date)::DATE, warehouse_code::VARCHAR, sum(line_total::DECIMAL(18,4))::DOUBLE FROM inv JOIN g USING (warehouse_code) GROUP BY ALL""")
def ed7_target_panels(s, d):
    return eda.target_panels(a.lines(s, d), "doc_date", "line_total", ["warehouse_code"], 5)


@S.query(f"""SELECT brand, date, month(date)::INT AS month, round(coalesce(lag(quantity, 7) OVER ({_W}), 0), 4) AS quantity_lag_7, round(coalesce(avg(quantity) OVER ({_W} ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING), 0), 4) AS quantity_mean_7,
round(coalesce(lag(price, 7) OVER ({_W}), 0), 4) AS price_lag_7, coalesce((rn - max(CASE WHEN quantity > 0 THEN rn END) OVER ({_W} ROWS UNBOUNDED PRECEDING))::INT, 999) AS days_since_last_sale FROM (SELECT *, row_number() OVER ({_W}) AS rn FROM ser)""")
def ml1_feature_chain(s, d):
    """Every family of features in one chain."""
    out = forecast.feature_chain(full(s, d), KEYS)
    return out.select("brand", "date", F.month("date").alias("month"), r("quantity_lag_7").alias("quantity_lag_7"), r("quantity_mean_7").alias("quantity_mean_7"), r("price_lag_7").alias("price_lag_7"), "days_since_last_sale")


@S.query("SELECT brand, date, CASE WHEN date < DATE '1999-01-01' THEN 'train' WHEN date < DATE '2000-06-01' THEN 'validation' ELSE 'test' END AS part FROM ser")
def ml6_date_split(s, d):
    return forecast.date_split(full(s, d), datetime.date(1999, 1, 1), datetime.date(2000, 6, 1)).select("brand", "date", "part")


@S.query("SELECT brand, date, quantity FROM ser WHERE date >= DATE '2000-06-01'")
def snk15_written_splits(s, d):
    """The test split, read back from where it was written."""
    root = scratch(s, "splits")
    forecast.write_splits(forecast.date_split(full(s, d), datetime.date(1999, 1, 1), datetime.date(2000, 6, 1)), root)
    return s.read.parquet(f"{root}/test").select("brand", "date", "quantity")


@S.query("SELECT brand, date, quantity, DATE '2001-01-01' AS data_prediction FROM ser WHERE date BETWEEN DATE '2001-01-01' AND DATE '2001-03-31'")
def snk14_written_forecast(s, d):
    """A forecast of all series from 2001 on, written by day; the first quarter's partitions, read back."""
    path = scratch(s, "forecast")
    forecast.write_forecast(full(s, d).where(F.col("date") >= "2001-01-01").select("brand", "date", "quantity"), path, datetime.date(2001, 1, 1))
    return s.read.parquet(path).where("year = 2001 and month <= 3").select("brand", "date", "quantity", "data_prediction")


@plain("SELECT event_type AS monitor, event_id, abs(value - 250) / 100 >= 1.5 AS is_anomaly_1_5, abs(value - 250) / 100 >= 2.0 AS is_anomaly_2_0 FROM events")
def vh16_sensitivity(s, d):
    e = a.table(s, d, "events").select(F.col("event_type").alias("monitor"), "event_id", ((F.col("value") - 250) / 100).alias("z"))
    return runs.sensitivity(e, (1.5, 2.0)).drop("z")


queries, oracle_sql = lambda: C.queries() | S.queries(), lambda: C.oracle_sql() | S.oracle_sql()
