"""Daily series, their features, splits, encoders and error measures over the test tables."""

from __future__ import annotations

import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from sluice.operators import series
from sluice.plans import adapter as a
from sluice.plans import forecast
from sluice.plans.catalog import Catalog

KEYS = ["brand"]
_SERIES = """, raw AS (SELECT doc_date AS date, brand, sum(quantity::DECIMAL(18,4))::DOUBLE AS quantity, sum(line_total::DECIMAL(18,4))::DOUBLE AS value, sum(gross_profit::DECIMAL(18,4))::DOUBLE AS profit, sum((unit_price * quantity)::DECIMAL(24,6))::DOUBLE / sum(quantity::DECIMAL(18,4))::DOUBLE AS price,
  count(DISTINCT card_code) AS customers, count(*) AS sales FROM inv JOIN items USING (item_code) GROUP BY ALL),
ser AS (SELECT g.brand, g.date, coalesce(raw.quantity, 0) AS quantity, coalesce(raw.value, 0) AS value, last_value(raw.price IGNORE NULLS) OVER (PARTITION BY g.brand ORDER BY g.date ROWS UNBOUNDED PRECEDING) AS price
  FROM (SELECT brand, unnest(generate_series(min(date), max(date), INTERVAL 1 DAY))::DATE AS date FROM raw GROUP BY brand) g LEFT JOIN raw USING (brand, date))"""
C = Catalog(a.SQL + _SERIES)
query = C.query


def raw(s, d):
    lines = a.lines(s, d).join(a.items(s, d).select("item_code", "brand"), "item_code")
    return series.daily(lines, KEYS)


def full(s, d):
    return series.filled(raw(s, d), KEYS).select("brand", "date", "quantity", "value", "price")


def r(c: str | Column, digits: int = 4) -> Column:
    return F.round((F.col(c) if isinstance(c, str) else c).cast("decimal(24,6)"), digits).cast("double")


def _rounded(df, skip=("brand", "date", "quantity", "value", "price")):
    return df.select("brand", "date", *[r(c).alias(c) for c in df.columns if c not in skip])


@query("SELECT * FROM raw")
def ag13_daily_series(s, d):
    return raw(s, d).select("date", "brand", "quantity", "value", "profit", "price", "customers", "sales")


@query("SELECT * FROM ser")
def ml2_filled_calendar(s, d):
    return full(s, d)


_W = "PARTITION BY brand ORDER BY date"


@query("SELECT brand, date, " + ", ".join(f"round(coalesce(lag({c}, {n}) OVER ({_W}), 0), 4) AS {c}_lag_{n}" for c in ("quantity", "value") for n in series.LAGS) + " FROM ser")
def wn5_lags(s, d):
    return _rounded(series.lags(full(s, d), KEYS))


def _roll(n: int) -> str:
    w = f"OVER ({_W} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
    f = {"mean": "avg(quantity)", "sum": "sum(quantity)", "min": "min(quantity)", "max": "max(quantity)", "std": "stddev_samp(quantity)", "q95": "quantile_cont(quantity, 0.95)", "nonzero": "count(CASE WHEN quantity > 0 THEN 1 END)"}
    return ", ".join(f"round(coalesce({x} {w}, 0), 4) AS quantity_{k}_{n}" for k, x in f.items())


@query(f"SELECT brand, date, {_roll(7)}, {_roll(14)}, {_roll(30)} FROM ser")
def wn6_rolling(s, d):
    return _rounded(series.rolling(full(s, d), KEYS))


@query(f"""SELECT brand, date, {', '.join(f"round(coalesce(list_reduce(p, lambda y, x: (1 - 2.0::DOUBLE / {n + 1}) * y + 2.0::DOUBLE / {n + 1} * x), 0), 3) AS quantity_ewm_{n}" for n in series.WINDOWS)}
FROM (SELECT brand, date, list(quantity) OVER ({_W} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p FROM ser)""")
def wn7_ewm(s, d):
    out = series.ewm(full(s, d), KEYS)
    return out.select("brand", "date", *[r(f"quantity_ewm_{n}", 3).alias(f"quantity_ewm_{n}") for n in series.WINDOWS])


@query(f"SELECT brand, date, coalesce((rn - max(CASE WHEN quantity > 0 THEN rn END) OVER ({_W} ROWS UNBOUNDED PRECEDING))::INT, 999) AS days_since_last_sale FROM (SELECT *, row_number() OVER ({_W}) AS rn FROM ser)")
def wn8_since_last_sale(s, d):
    return series.since_last_sale(full(s, d), KEYS).select("brand", "date", "days_since_last_sale")


@query(f"SELECT brand, date, CASE WHEN p IS NULL OR len(p) = 0 THEN 30 ELSE (len(p) - list_position(p, list_max(p)) + 1)::INT END AS days_since_peak FROM (SELECT brand, date, list(quantity) OVER ({_W} ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING) AS p FROM ser)")
def wn9_since_peak(s, d):
    return series.since_peak(full(s, d), KEYS).select("brand", "date", "days_since_peak")


def _lag(c: str, n: int) -> str:
    return f"lag({c}, {n}) OVER ({_W})"


_PRICE = [f"round(coalesce({_lag('price', n)}, 0), 4) AS price_lag_{n}" for n in (1, 7, 30)]
_PRICE += [f"round(coalesce({f}(price) OVER ({_W} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING), 0), 2) AS price_{k}_{n}" for n in series.WINDOWS for k, f in (("mean", "avg"), ("std", "stddev_samp"))]
_PRICE += [x for n in (1, 7) for x in (f"round(coalesce({_lag('price', 1)} - {_lag('price', n + 1)}, 0), 4) AS price_diff_{n}", f"round(coalesce({_lag('price', 1)} / nullif({_lag('price', n + 1)}, 0) - 1, 0), 4) AS price_pct_{n}")]


@query(f"SELECT brand, date, {', '.join(_PRICE)} FROM ser")
def wn10_price_features(s, d):
    df = series.price_features(full(s, d), KEYS)
    return df.select("brand", "date", *[r(c, 2 if "_mean_" in c or "_std_" in c else 4).alias(c) for c in df.columns if c.startswith("price_")])


_TREND = [f"round(coalesce({_lag('quantity', 1)} / nullif({_lag('quantity', 2)}, 0) - 1, 0), 4) AS quantity_pct_1", f"round(coalesce({_lag('quantity', 7)} / nullif({_lag('quantity', 8)}, 0) - 1, 0), 4) AS quantity_pct_7"]
_TREND += [f"round(coalesce({_lag('quantity', 1)} - {_lag('quantity', n)}, 0), 4) AS quantity_diff_{k}" for k, n in ((1, 2), (7, 8))]


@query(f"SELECT brand, date, {', '.join(_TREND)} FROM ser")
def wn11_trends(s, d):
    return _rounded(series.trends(full(s, d), KEYS))


@query("SELECT brand, date, price FROM ser")
def wn12_forward_fill(s, d):
    return full(s, d).select("brand", "date", "price")


@query("SELECT brand, max(date) AS date, arg_max(price, date) AS price, arg_max(CASE WHEN quantity > 40 THEN quantity END, CASE WHEN quantity > 40 THEN date END) AS quantity FROM ser GROUP BY brand")
def wn13_newest(s, d):
    return series.newest(full(s, d).withColumn("quantity", F.when(F.col("quantity") > 40, F.col("quantity"))), KEYS, ["price", "quantity"])


@query(f"SELECT brand, date, round(avg(value) OVER ({_W} ROWS BETWEEN 29 PRECEDING AND CURRENT ROW), 2) AS average FROM ser")
def wn14_moving_average(s, d):
    df = full(s, d)
    return df.select("brand", "date", r(series.moving_average(df, KEYS, "value", 30), 2).alias("average"))


@query("SELECT item_code, quantity, line_num, doc_entry FROM (SELECT *, count(*) OVER w AS n, avg(quantity) OVER w AS m, stddev_samp(quantity) OVER w AS s FROM inv WINDOW w AS (PARTITION BY item_code)) WHERE n >= 10 AND quantity <= m + 1.5 * s")
def prj17_drop_outliers(s, d):
    return series.drop_outliers(a.lines(s, d), "item_code", sigmas=1.5).select("item_code", "quantity", "line_num", "doc_entry")


@query("SELECT brand, date, 0 AS nothing FROM ser")
def prj19_align(s, d):
    return forecast.align(full(s, d), ["brand", "date", "nothing"])


@query("SELECT item_code, brand, coalesce(code, -1)::INT AS brand_code FROM items LEFT JOIN (SELECT brand, row_number() OVER (ORDER BY brand) - 1 AS code FROM (SELECT DISTINCT brand FROM items WHERE item_code % 3 = 0)) USING (brand)")
def ml3_category_codes(s, d):
    items = a.items(s, d)
    return forecast.CategoryEncoder("brand").fit(items.where("item_code % 3 = 0")).transform(items).select("item_code", "brand", F.col("brand_code").cast("int").alias("brand_code"))


@query("SELECT brand, date, CASE WHEN rn <= floor(n * 0.7) THEN 'train' WHEN rn <= floor(n * (0.7 + 0.15)) THEN 'validation' ELSE 'test' END AS part FROM (SELECT *, row_number() OVER (ORDER BY date, brand) AS rn, count(*) OVER () AS n FROM ser)")
def ml5_positional_split(s, d):
    return forecast.positional_split(full(s, d).select("brand", "date"), ["date", "brand"])


#: A naive forecast, so that error measures have something to measure: the value of a week before.
_NAIVE = f"SELECT brand, date, quantity, lag(quantity, 7) OVER ({_W}) AS predicted FROM ser"


def _naive(s, d):
    return series.lags(full(s, d), KEYS, ["quantity"], [7]).withColumn("predicted", F.lag("quantity", 7).over(series._by(KEYS))).where("predicted is not null")


@query(f"SELECT brand, round(avg(abs(quantity - predicted)), 4) AS mae, round(sqrt(avg((quantity - predicted) * (quantity - predicted))), 4) AS rmse, round(avg(CASE WHEN quantity <> 0 THEN abs((quantity - predicted) / quantity) END) * 100, 4) AS mape, count(*) AS n FROM ({_NAIVE}) WHERE predicted IS NOT NULL GROUP BY brand")
def ag24_error_measures(s, d):
    return forecast.metrics(_naive(s, d), "quantity", "predicted", KEYS).select("brand", r("mae").alias("mae"), r("rmse").alias("rmse"), r("mape").alias("mape"), "n")


@query(f"SELECT round(avg(predicted), 4) AS mean, round(stddev_samp(predicted), 4) AS deviation, round(quantile_cont(predicted, 0.05), 4) AS p5, round(quantile_cont(predicted, 0.95), 4) AS p95 FROM ({_NAIVE}) WHERE predicted IS NOT NULL")
def ag22_forecast_interval(s, d):
    return forecast.interval(_naive(s, d)).select(*[r(c).alias(c) for c in ("mean", "deviation", "p5", "p95")])


@query(f"SELECT round(f, 4) AS forecast_mean, round(h, 4) AS history_mean, round((f - h) / h * 100, 4) AS variation_percent FROM (SELECT avg(predicted) FILTER (WHERE date >= DATE '2001-01-01') AS f, avg(predicted) FILTER (WHERE date < DATE '2001-01-01') AS h FROM ({_NAIVE}) WHERE predicted IS NOT NULL)")
def ag23_forecast_against_history(s, d):
    df = _naive(s, d)
    return forecast.against_history(df.where(F.col("date") >= "2001-01-01"), df.where(F.col("date") < "2001-01-01"), "predicted").select(r("forecast_mean").alias("forecast_mean"), r("history_mean").alias("history_mean"), r("variation_percent").alias("variation_percent"))


@query(f"SELECT date_trunc('week', date)::DATE AS week, round(avg(abs(quantity - predicted)), 4) AS mae, sum(quantity) AS actual, sum(predicted) AS predicted FROM ({_NAIVE}) WHERE predicted IS NOT NULL GROUP BY 1")
def ml14_weekly_error(s, d):
    return forecast.weekly_error(_naive(s, d), "quantity", "predicted").withColumn("mae", r("mae"))


@query(None)
def ml8_gbt_forecast(s, d):
    """Trains both targets' gradient-boosted trees on days before 2001 and predicts the last months of every series."""
    cutoff = datetime.date(2001, 1, 1)
    df = forecast.features(full(s, d), KEYS)
    columns = forecast.feature_columns(df)
    out = df.where(F.col("date") >= F.lit(cutoff))
    for target in ("quantity", "value"):
        out = forecast.predict(forecast.train(df.where(F.col("date") < F.lit(cutoff)), target, columns, maxIter=5, maxDepth=4), out, f"predicted_{target}")
    return out.select("brand", "date", "quantity", "predicted_quantity", "value", "predicted_value")


queries, oracle_sql = C.queries, C.oracle_sql
