"""Exploratory aggregates and window extensions over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from sluice.operators import relational
from sluice.plans import adapter as a
from sluice.plans import eda
from sluice.plans.catalog import Catalog
from sluice.plans.series_queries import r

C = Catalog(a.SQL)
query = C.query
plain = lambda sql: C.query(sql, common=False)


@plain("SELECT 'a' AS \"column\", count(*) FILTER (WHERE c_custkey % 3 <> 0) AS nulls, round(count(*) FILTER (WHERE c_custkey % 3 <> 0) * 100.0 / count(*), 4) AS percent FROM customer UNION ALL SELECT 'b', 0, 0")
def ed1_null_shares(s, d):
    df = a.table(s, d, "customer").select(F.when(F.col("c_custkey") % 3 == 0, 1).alias("a"), F.col("c_name").alias("b"))
    return eda.null_shares(df).withColumn("percent", r("percent"))


@query("SELECT CASE WHEN quantity < 0 THEN 0 WHEN quantity >= 50 THEN 11 ELSE floor(quantity / 5)::BIGINT + 1 END AS bucket, count(*) AS n, round(sum(quantity::DECIMAL(18,4))::DOUBLE / count(*), 4) AS mean FROM inv GROUP BY 1")
def ed2_histogram(s, d):
    return eda.histogram(a.lines(s, d), "quantity", 10, 0.0, 50.0).withColumn("mean", r("mean"))


@query("SELECT warehouse_code, min(quantity) AS low, quantile_cont(quantity, 0.25) AS q1, quantile_cont(quantity, 0.5) AS median, quantile_cont(quantity, 0.75) AS q3, max(quantity) AS high, count(*) AS n FROM inv GROUP BY 1")
def ed3_box(s, d):
    return eda.box(a.lines(s, d), "quantity", ["warehouse_code"])


def _resample(period: str, label: str = "p") -> str:
    step = {"week": "7 DAYS", "month": "1 MONTH"}[period]
    return f"""SELECT ({label})::DATE AS period, coalesce(t, 0) AS total FROM (SELECT unnest(generate_series(min(p), max(p), INTERVAL {step}))::DATE AS p FROM x) LEFT JOIN x USING (p)"""


@query("WITH x AS (SELECT date_trunc('week', doc_date)::DATE AS p, sum(line_total::DECIMAL(18,4))::DOUBLE AS t FROM inv GROUP BY 1) " + _resample("week", "p + 6"))
def ed4_resample_weekly(s, d):
    return eda.resample(a.lines(s, d), "doc_date", "line_total", "week")


@query("WITH x AS (SELECT date_trunc('month', doc_date)::DATE AS p, sum(line_total::DECIMAL(18,4))::DOUBLE AS t FROM inv GROUP BY 1) " + _resample("month"))
def ed4_resample_monthly(s, d):
    return eda.resample(a.lines(s, d), "doc_date", "line_total", "month")


@query("SELECT date_trunc('year', doc_date)::DATE AS period, round(sum(quantity::DECIMAL(18,4))::DOUBLE / count(*), 4) AS quantity, round(sum(line_total::DECIMAL(18,4))::DOUBLE / count(*), 4) AS line_total FROM inv GROUP BY 1")
def ed5_yearly_means(s, d):
    return eda.by_period(a.lines(s, d), "doc_date", "year", ["quantity", "line_total"]).select("period", r("quantity").alias("quantity"), r("line_total").alias("line_total"))


@query("SELECT date_trunc('month', doc_date)::DATE AS period, warehouse_code, count(*) AS n FROM inv WHERE warehouse_code IN (SELECT warehouse_code FROM inv GROUP BY 1 ORDER BY count(*) DESC, warehouse_code LIMIT 5) GROUP BY ALL")
def ed5_category_counts(s, d):
    return eda.category_counts(a.lines(s, d), "doc_date", "month", "warehouse_code")


@query("SELECT (isodow(doc_date) - 1)::INT AS weekday, round(sum(line_total::DECIMAL(18,4))::DOUBLE / count(*), 4) AS mean FROM inv GROUP BY 1")
def ed6_weekday_seasonality(s, d):
    return eda.seasonality(a.lines(s, d), "doc_date", "line_total", "weekday").withColumn("mean", r("mean"))


@query("SELECT year(doc_date)::INT AS year, quarter(doc_date)::INT AS quarter, sum(line_total::DECIMAL(18,4))::DOUBLE AS total FROM inv GROUP BY ALL")
def ed6_quarter_totals(s, d):
    return eda.seasonality(a.lines(s, d), "doc_date", "line_total", "quarter")


@query("SELECT x.a, x.b, round(x.c, 4) AS correlation FROM (SELECT corr(quantity, line_total) AS c1, corr(quantity, unit_price) AS c2, corr(line_total, unit_price) AS c3 FROM inv), LATERAL (VALUES ('quantity', 'line_total', c1), ('quantity', 'unit_price', c2), ('line_total', 'unit_price', c3)) x(a, b, c)")
def ed8_correlations(s, d):
    return eda.correlations(a.lines(s, d), ["quantity", "line_total", "unit_price"]).withColumn("correlation", r("correlation"))


@query("SELECT sales_person_name, warehouse_code, sum(line_total::DECIMAL(18,4))::DOUBLE AS total FROM inv JOIN sellers USING (sales_person_code) GROUP BY ALL ORDER BY total DESC, sales_person_name, warehouse_code LIMIT 10")
def ed9_top_sellers(s, d):
    return relational.top_groups(a.lines(s, d).join(a.sellers(s, d), "sales_person_code"), ["sales_person_name", "warehouse_code"], "line_total", 10)


@query("SELECT count(*) AS rows, min(doc_date) AS first_day, max(doc_date) AS last_day, count(DISTINCT item_code) AS distinct_item_code, count(DISTINCT card_code) AS distinct_card_code, sum(quantity::DECIMAL(18,4))::DOUBLE AS total_quantity, sum(line_total::DECIMAL(18,4))::DOUBLE AS total_line_total FROM inv")
def ed10_summary(s, d):
    return eda.summary(a.lines(s, d), "doc_date", ["item_code", "card_code"], ["quantity", "line_total"])


@plain("SELECT r_name, n_name, sum(c_acctbal::DECIMAL(18,4))::DOUBLE AS balance, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ROLLUP (r_name, n_name)")
def ext_rollup(s, d):
    t = lambda n: a.table(s, d, n)
    df = t("customer").join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return df.rollup("r_name", "n_name").agg(F.sum(F.col("c_acctbal").cast("decimal(18,4)")).cast("double").alias("balance"), F.count("*").alias("n"))


@plain("""SELECT user_id, session_no, min(ts) AS first_ts, max(ts) AS last_ts, count(*) AS n FROM (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)::BIGINT AS session_no
FROM (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) <= INTERVAL 6 HOURS THEN 0 ELSE 1 END AS new FROM events)) GROUP BY ALL""")
def ext_sessions(s, d):
    from pyspark.sql import Window as W

    w = W.partitionBy("user_id").orderBy("ts", "event_id")
    new = F.when(F.col("ts") - F.lag("ts").over(w) <= F.expr("INTERVAL 6 HOURS"), 0).otherwise(1)
    df = a.table(s, d, "events").withColumn("new", new).withColumn("session_no", F.sum("new").over(w.rowsBetween(W.unboundedPreceding, 0)))
    return df.groupBy("user_id", "session_no").agg(F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), F.count("*").alias("n"))


queries, oracle_sql = C.queries, C.oracle_sql
