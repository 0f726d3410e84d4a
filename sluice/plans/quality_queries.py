"""Expectations, checks, generic tests and anomaly monitors over the test tables."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from sluice.operators import anomaly, quality
from sluice.operators.quality import Expectation
from sluice.plans import adapter as a
from sluice.plans.catalog import Catalog

C = Catalog(a.SQL)
plain = lambda sql: C.query(sql, common=False)
NOW = datetime.datetime(2024, 1, 30)

EXPECTATIONS = [
    Expectation("not_null", ("o_orderkey",)),
    Expectation("unique", ("o_orderkey",)),
    Expectation("compound_unique", ("o_custkey", "o_orderstatus")),
    Expectation("in_set", ("o_orderstatus",), ("P", "O")),
    Expectation("between", ("o_totalprice",), (0.0, 200000.0)),
]


@plain("""WITH t AS (SELECT count(*) AS n, count(o_orderkey) AS a, count(DISTINCT o_orderkey) AS b, count(DISTINCT (o_custkey, o_orderstatus)) AS c, count(*) FILTER (WHERE o_orderstatus IN ('P', 'O')) AS d, count(*) FILTER (WHERE o_totalprice BETWEEN 0 AND 200000) AS e FROM orders)
SELECT 'orders' AS "table", kind, columns, round(v * 100.0 / n, 4) AS passed_percent, CASE WHEN kind LIKE '%unique' THEN CASE WHEN v < n THEN 'FAIL' ELSE 'PASS' END WHEN v * 100.0 / n < 99 THEN CASE WHEN kind = 'not_null' THEN 'FAIL' ELSE 'WARN' END ELSE 'PASS' END AS status
FROM t, LATERAL (VALUES ('not_null', 'o_orderkey', a), ('unique', 'o_orderkey', b), ('compound_unique', 'o_custkey,o_orderstatus', c), ('in_set', 'o_orderstatus', d), ('between', 'o_totalprice', e)) x(kind, columns, v)""")
def dq_expectations(s, d):
    return quality.expect(a.table(s, d, "orders"), "orders", EXPECTATIONS)


@plain("SELECT l_orderkey, l_linenumber, count(*) AS n_records FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def ag15_duplicate_keys(s, d):
    return quality.unique(a.table(s, d, "lineitem"), "l_orderkey", "l_linenumber")


@plain("SELECT max(ts) AS most_recent FROM events HAVING max(ts) IS NULL OR datediff('hour', max(ts), TIMESTAMP '2024-01-30') > -24")
def ag16_freshness(s, d):
    return quality.recency(a.table(s, d, "events"), "ts", NOW, -24)


@C.query("SELECT round(avg(CASE WHEN gross_profit < 0 THEN 100.0 ELSE 0.0 END), 4) AS percent FROM inv HAVING round(avg(CASE WHEN gross_profit < 0 THEN 100.0 ELSE 0.0 END), 4) > 5")
def ag17_share_above(s, d):
    return quality.share_above(a.lines(s, d), F.col("gross_profit") < 0, 5.0).select(F.round(F.col("percent").cast("decimal(24,6)"), 4).cast("double").alias("percent"))


@C.query("SELECT doc_entry, doc_total, sum(line_total::DECIMAL(18,4))::DOUBLE AS lines FROM inv GROUP BY ALL HAVING doc_total > 0 AND abs(sum(line_total::DECIMAL(18,4))::DOUBLE - doc_total) > doc_total * 0.05 AND sum(line_total::DECIMAL(18,4))::DOUBLE <= doc_total * 5")
def ag18_header_reconciliation(s, d):
    return quality.header_reconciliation(a.lines(s, d), "doc_entry", "doc_total", "line_total")


@C.query("SELECT round(100.0 * count(*) FILTER (WHERE abs(lines - doc_total) <= doc_total * 0.5) / count(*), 2) AS reconciled_percent FROM (SELECT doc_entry, doc_total, sum(line_total::DECIMAL(18,4))::DOUBLE AS lines FROM inv GROUP BY ALL)")
def ag19_reconciled_share(s, d):
    docs = a.lines(s, d).groupBy("doc_entry", "doc_total").agg(F.sum(F.col("line_total").cast("decimal(18,4)")).cast("double").alias("lines"))
    ok = F.count_if(F.abs(F.col("lines") - F.col("doc_total")) <= F.col("doc_total") * 0.5)
    return docs.agg(F.round((ok * 100.0 / F.count("*")).cast("decimal(24,6)"), 2).cast("double").alias("reconciled_percent"))


@plain("SELECT (sum(DISTINCT o_custkey) - sum(o_custkey))::BIGINT AS divergence FROM orders")
def ag21_sum_distinct(s, d):
    return a.table(s, d, "orders").agg((F.sum_distinct("o_custkey") - F.sum("o_custkey")).alias("divergence"))


@C.query("""SELECT * FROM (VALUES ('duplicate_keys', (SELECT count(*) FROM (SELECT 1 FROM inv GROUP BY doc_entry, line_num HAVING count(*) > 1))), ('future_dates', (SELECT count(*) FROM inv WHERE doc_date > DATE '2001-07-01')), ('seller_below_minus_one', 0), ('negative_line_total', (SELECT count(*) FROM inv WHERE line_total < 0)),
('open_quantity', (SELECT count(*) FROM inv WHERE line_status = 'O' AND quantity <= 0)), ('orphan_items', 0), ('margin_range', (SELECT count(*) FROM inv WHERE gross_profit / line_total * 100 NOT BETWEEN -100 AND 100))) t(check_name, failures)""")
def dq_singular_checks(s, d):
    x = a.lines(s, d)
    checks = {
        "duplicate_keys": lambda: quality.unique(x, "doc_entry", "line_num"),
        "future_dates": lambda: quality.future_dates(x, "doc_date", datetime.date(2001, 7, 1)),
        "seller_below_minus_one": lambda: quality.accepted_range(x, "sales_person_code", low=-1),
        "negative_line_total": lambda: quality.accepted_range(x, "line_total", low=0),
        "open_quantity": lambda: quality.accepted_range(x.where("line_status = 'O'"), "quantity", low=0, inclusive=False),
        "orphan_items": lambda: quality.relationships(x, "item_code", a.items(s, d), "item_code"),
        "margin_range": lambda: quality.expression_is_true(x, "gross_profit / line_total * 100 BETWEEN -100 AND 100"),
    }
    return quality.run(s, checks).select(F.col("check").alias("check_name"), "failures")


@plain("""WITH cs AS (SELECT * FROM (SELECT c_nationkey AS n, count(*) AS c FROM customer GROUP BY 1) FULL JOIN (SELECT s_nationkey AS n, count(*) AS s FROM supplier GROUP BY 1) USING (n))
SELECT * FROM (VALUES ('accepted_values', (SELECT count(*) FROM orders WHERE o_orderstatus NOT IN ('F', 'O'))), ('not_accepted_values', (SELECT count(*) FROM orders WHERE o_orderstatus IN ('P'))), ('at_least_one', 0), ('not_constant', (SELECT count(*) FROM (SELECT 1 FROM nation GROUP BY n_regionkey HAVING count(DISTINCT n_regionkey) = 1))),
('not_empty_string', 0), ('not_null', 0), ('not_null_proportion', 1), ('relationships_where', (SELECT count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) AND o_orderstatus = 'F')), ('sequential_values', (SELECT count(*) FROM (SELECT o_orderkey, lag(o_orderkey) OVER (ORDER BY o_orderkey) AS p FROM orders) WHERE o_orderkey <> p + 1)),
('equal_rowcount', (SELECT count(*) FROM cs WHERE c IS DISTINCT FROM s)), ('fewer_rows_than', (SELECT count(*) FROM cs WHERE coalesce(s, 0) >= coalesce(c, 0))), ('ranges', 1)) t(test, failures)""")
def dq_generic_tests(s, d):
    o, c = a.table(s, d, "orders"), a.table(s, d, "customer")
    ranges = s.createDataFrame([(1, 1, 3), (1, 3, 5), (1, 4, None), (2, 1, 2)], "g int, a int, b int")
    half = c.withColumn("h", F.when(F.col("c_custkey") % 2 == 0, 1))
    tests = {
        "accepted_values": quality.accepted_values(o, "o_orderstatus", ["F", "O"]),
        "not_accepted_values": quality.not_accepted_values(o, "o_orderstatus", ["P"]),
        "at_least_one": quality.at_least_one(o, "o_custkey"),
        "not_constant": quality.not_constant(a.table(s, d, "nation"), "n_regionkey", ["n_regionkey"]),
        "not_empty_string": quality.not_empty_string(c, "c_name"),
        "not_null": quality.not_null(o, "o_custkey"),
        "not_null_proportion": quality.not_null_proportion(half, "h", 0.9),
        "relationships_where": quality.relationships(o, "o_custkey", c, "c_custkey", "o_orderstatus = 'F'", "c_acctbal > 0"),
        "sequential_values": quality.sequential_values(o, "o_orderkey"),
        "equal_rowcount": quality.equal_rowcount(c.select(F.col("c_nationkey").alias("n")), a.table(s, d, "supplier").select(F.col("s_nationkey").alias("n")), ["n"]),
        "fewer_rows_than": quality.fewer_rows_than(a.table(s, d, "supplier").select(F.col("s_nationkey").alias("n")), c.select(F.col("c_nationkey").alias("n")), ["n"]),
        "ranges": quality.mutually_exclusive_ranges(ranges, "a", "b", ["g"], gaps="not_allowed"),
    }
    return quality.run(s, {k: (lambda v=v: v) for k, v in tests.items()}).select(F.col("check").alias("test"), "failures")


_DAYS = "WITH b AS (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-29', INTERVAL 1 DAY)) AS bucket_start), "


@plain(_DAYS + """v AS (SELECT bucket_start, count(event_id)::DOUBLE AS metric_value FROM b LEFT JOIN (SELECT * FROM events WHERE event_type = 'purchase' AND day(ts) <> 10) e ON date_trunc('day', ts) = bucket_start GROUP BY 1),
t AS (SELECT *, avg(metric_value) OVER w AS training_avg, stddev_samp(metric_value) OVER w AS training_stddev, count(*) OVER w AS n FROM v WINDOW w AS (ORDER BY bucket_start ROWS UNBOUNDED PRECEDING))
SELECT bucket_start, metric_value, n AS training_size, round(CASE WHEN training_stddev IS NULL THEN NULL WHEN training_stddev = 0 THEN 0 ELSE (metric_value - training_avg) / training_stddev END, 4) AS z, coalesce(n >= 7 AND training_stddev > 0 AND abs(metric_value - training_avg) / training_stddev > 3, false) AS is_anomalous FROM t""")
def an1_volume_anomalies(s, d):
    e = a.table(s, d, "events").where("event_type = 'purchase' and dayofmonth(ts) <> 10")
    volume = anomaly.volume(e, "ts", datetime.datetime(2024, 1, 1), datetime.datetime(2024, 1, 30))
    out = anomaly.scores(volume, "bucket_start")
    return out.select("bucket_start", "metric_value", "training_size", F.round(F.col("z").cast("decimal(24,6)"), 4).cast("double").alias("z"), "is_anomalous")


@plain(_DAYS + """u AS (SELECT DISTINCT ts FROM events WHERE event_type = 'purchase'), l AS (SELECT ts, date_trunc('day', ts) AS bucket_start, coalesce(epoch_us(ts) - epoch_us(lag(ts) OVER (ORDER BY ts)), 0) / 1e6 AS gap FROM u)
SELECT b.bucket_start, max(gap)::DOUBLE AS metric_value FROM b JOIN l USING (bucket_start) GROUP BY 1""")
def an2_freshness_gaps(s, d):
    e = a.table(s, d, "events").where("event_type = 'purchase'")
    return anomaly.freshness(e, "ts", datetime.datetime(2024, 1, 1), datetime.datetime(2024, 1, 30))


@plain("""SELECT c_mktsegment AS dimension_value, count(*)::DOUBLE AS row_count, round(100.0 * count(*) FILTER (WHERE c_acctbal IS NULL) / count(*), 3) AS null_percent, count(*) FILTER (WHERE c_nationkey IS NULL OR c_nationkey = 0)::DOUBLE AS zero_count, min(c_acctbal) AS minimum, max(c_acctbal) AS maximum, round(sum(c_acctbal::DECIMAL(18,4))::DOUBLE / count(*), 4) AS average, round(stddev_samp(c_acctbal), 4) AS deviation,
min(length(c_name))::DOUBLE AS min_length, max(length(c_name))::DOUBLE AS max_length, count(*) FILTER (WHERE trim(coalesce(c_name, '')) = '')::DOUBLE AS missing_count FROM customer GROUP BY 1""")
def ag26_column_monitors(s, d):
    df = a.table(s, d, "customer")
    n, r = anomaly.numeric_monitors("c_acctbal"), lambda c, k: F.round(c.cast("decimal(24,6)"), k).cast("double")
    t = anomaly.string_monitors("c_name")
    return df.groupBy(F.col("c_mktsegment").alias("dimension_value")).agg(F.count("*").cast("double").alias("row_count"), n["null_percent"].alias("null_percent"), anomaly.numeric_monitors("c_nationkey")["zero_count"].alias("zero_count"), n["min"].alias("minimum"), n["max"].alias("maximum"), r(n["average"], 4).alias("average"), r(n["standard_deviation"], 4).alias("deviation"), t["min_length"].alias("min_length"), t["max_length"].alias("max_length"), t["missing_count"].alias("missing_count"))


@plain(_DAYS + """e AS (SELECT event_type, date_trunc('day', ts) AS bucket_start, count(*) AS n FROM events GROUP BY 1, 2), f AS (SELECT event_type, min(bucket_start) AS first FROM e GROUP BY 1)
SELECT event_type AS dimension_value, b.bucket_start, coalesce(n, 0)::DOUBLE AS metric_value FROM f JOIN b ON b.bucket_start >= first LEFT JOIN e USING (event_type, bucket_start)""")
def an3_dimension_volume(s, d):
    e = a.table(s, d, "events")
    return anomaly.dimension_volume(e, "ts", "event_type", datetime.datetime(2024, 1, 1), datetime.datetime(2024, 1, 30))


queries, oracle_sql = C.queries, C.oracle_sql
