import datetime
import math

import pytest
from pyspark.sql import functions as F

from sluice.functions import credit
from sluice.operators import aggregates, anomaly, quality, relational, series
from sluice.plans import forecast, marts


@pytest.mark.parametrize("values", [[5.0], [3.0, 3.0], [1.0, 2.0, 2.0, None, 5.0, 1e9, -4.0, None, 0.0, 2.0]])
def test_percent_rank_equals_the_window(spark, values):
    from pyspark.sql import Window

    df = spark.createDataFrame(list(enumerate(values)), "id int, v double")
    got = {r.id: r.p for r in aggregates.percent_rank(df, "v", "p").collect()}
    want = {r.id: r.p for r in df.withColumn("p", F.percent_rank().over(Window.orderBy(F.desc_nulls_last("v")))).collect()}
    assert got == pytest.approx(want)


def test_rounding_is_decimal(spark):
    assert spark.sql("SELECT 2.675D AS a").select(aggregates.rounded(F.col("a"), 2)).first()[0] == 2.68


def test_ranking_ties_and_zero_revenue(spark):
    cols = "doc_entry int, year int, month int, sales_person_code int, card_code int, item_code int, quantity double, line_total double, gross_profit double"
    lines = spark.createDataFrame([(1, 2024, 1, 1, 1, 1, 1.0, 5.0, 1.0), (2, 2024, 1, 2, 1, 1, 1.0, 5.0, 1.0), (3, 2024, 1, 3, 1, 1, 1.0, 0.0, 1.0), (4, 2024, 1, -1, 1, 1, 1.0, 9.0, 1.0), (5, 2024, 1, None, 1, 1, 1.0, 1.0, 1.0)], cols)
    sellers = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "sales_person_code int, sales_person_name string")
    got = {r.cod_vendedor: (r.ranking, r.nome_vendedor, r.pct_margem_bruta) for r in marts.seller_ranking(lines, sellers).collect()}
    assert got == {-1: (1, None, 11.11), 1: (2, "a", 20.0), 2: (2, "b", 20.0), None: (3, None, 100.0), 3: (4, "c", None)}


def test_activity_bounds(spark):
    as_of = datetime.date(2024, 12, 31)
    rows = [(d, as_of - datetime.timedelta(days=d)) for d in (30, 31, 90, 91, 180, 181)]
    cols = "card_code int, doc_date date, doc_entry int, item_code int, sales_person_code int, line_total double, gross_profit double, cancelled string"
    lines = spark.createDataFrame([(d, day, d, 1, 1, 1.0, 1.0, "tNO") for d, day in rows] + [(1, as_of, 1, 1, 1, 9.0, 1.0, None)], cols)
    partners = spark.createDataFrame([], "card_code int, tipo string")
    got = {r.cod_cliente: r.segmento_atividade for r in marts.customer_profile(lines, partners, as_of).collect()}
    assert got == {30: "ativo", 31: "em_risco", 90: "em_risco", 91: "inativo_recente", 180: "inativo_recente", 181: "inativo_cronico"}


def test_conversion_without_orders(spark):
    q = spark.createDataFrame([(1, 2024, 1, 1, 1, "x", 2.0, 3.0)], "doc_entry int, year int, month int, sales_person_code int, item_code int, item_description string, line_total double, quantity double")
    s = spark.createDataFrame([(1, "a")], "sales_person_code int, sales_person_name string")
    out = marts.conversion_rate(q, None, s)
    assert out.first().taxa_conversao == 0 and "valor_pedidos" not in out.columns


def test_stock_signs(spark):
    m = spark.createDataFrame([(1, 5.0, 50.0), (2, -3.0, -30.0), (3, 0.0, 7.0), (4, None, 9.0)], "doc_entry int, quantity double, line_total double").selectExpr("*", "2024 AS year", "1 AS month", "1 AS item_code", "1 AS warehouse_code", "1.0D AS unit_price", "DATE '2024-01-01' AS doc_date")
    items = spark.createDataFrame([(1, "a", 1)], "item_code int, item_name string, item_group_code int")
    r = marts.stock_movement(m, items, spark.createDataFrame([(1, "g")], "item_group_code int, group_name string")).first()
    assert (r.qtd_entrada, r.qtd_saida, r.valor_entrada, r.valor_saida, r.saldo_qtd, r.qtd_linhas) == (5, 3, 50, 30, 2, 4)


TEXT = "SCORE: 1\nSCORE: Default\nPRÁTICA DO MERCADO: À vista\nRISCO DE CREDITO: muito alto\nEM ABERTO: R$ 1.234,56 EM ABERTO: R$ 12\nRESTRIÇÕES: 2 PROTESTOS R$ 300,00 • outro\nCND: não emitida • 3 Sócios\nLIMITE ZERADO à vista"


def _credit(spark, text, analysts=()):
    return spark.createDataFrame([(text,)], "t string").select(credit.parse(F.col("t"), analysts).alias("r")).first().r


def test_credit_text(spark):
    r = _credit(spark, TEXT)
    assert (r.score_credito, r.score_is_default, r.pratica_mercado, r.apenas_vista, r.risco_credito) == (None, True, "à vista", True, "muito alto")
    assert (r.valor_em_aberto, r.tem_restricoes, r.qtd_protestos, r.valor_protestos, r.cnd_status, r.qtd_socios, r.decisao_final) == (12.0, True, 2, 300.0, "nao_emitida", 3, "limite_zerado")
    assert _credit(spark, None).asDict() == _credit(spark, "").asDict() and _credit(spark, "").decisao_final is None
    a = _credit(spark, "Beltrana - 01/02/2024 Fulano 03/04/2024", ["Fulano", "Beltrana"])
    assert (a.ultimo_analista, a.ultima_analise_data) == ("Fulano", "03/04/2024")


def test_not_in_with_nulls(spark):
    a = spark.createDataFrame([(1,), (2,), (None,)], "x int")
    for other, want in (([(2,), (None,)], []), ([(2,)], [1]), ([], [None, 1, 2])):
        b = spark.createDataFrame(other, "y int")
        assert sorted((r.x for r in relational.not_in(a, "x", b, "y").collect()), key=str) == sorted(want, key=str)


def test_key_audit(spark):
    k = lambda *x: spark.createDataFrame([(i,) for i in x], "k int")
    r = relational.key_audit(k(1, 2, 3, 3), k(3, 4), "k").first()
    assert (r.full_unique, r.new_keys, r.updated_keys, r.total_unique, r.duplicates_removed) == (3, 1, 1, 4, 2)


def test_null_rules_of_checks(spark):
    df = spark.createDataFrame([(1, "a"), (None, None), (5, "")], "x int, s string")
    assert quality.accepted_range(df, "x", 0, 3).count() == 1
    assert quality.accepted_values(df, "s", ["a", ""]).count() == 0
    assert quality.expression_is_true(df, "x < 3").count() == 1
    now = datetime.datetime(2024, 1, 2)
    empty = spark.createDataFrame([], "t timestamp")
    assert quality.recency(empty, "t", now, 1).count() == 1
    assert quality.at_least_rows({"a": df, "b": df}, {"a": 3, "b": 4}).collect()[0].table == "b"
    assert quality.expect(df.limit(0), "e", [quality.Expectation("not_null", ("x",))]).first().status == "EMPTY"
    assert not quality.gate(quality.expect(df, "e", [quality.Expectation("not_null", ("x",))]))
    parts = spark.createDataFrame([(1999, 1), (2024, 13), (2024, 2)], "year int, month int")
    assert quality.valid_partitions(parts).count() == 2


def test_anomalies(spark):
    d0 = datetime.datetime(2024, 1, 1)
    flat = [(d0 + datetime.timedelta(days=i), 5.0) for i in range(14)]
    df = spark.createDataFrame(flat + [(d0 + datetime.timedelta(days=14), 500.0)], "bucket_start timestamp, metric_value double")
    rows = anomaly.scores(df, "bucket_start").orderBy("bucket_start").collect()
    assert rows[0].z is None and rows[5].z == 0.0 and rows[14].is_anomalous and not rows[13].is_anomalous
    assert not anomaly.scores(df, "bucket_start", direction="drop").orderBy(F.desc("bucket_start")).first().is_anomalous
    assert anomaly.buckets(spark, d0, d0 + datetime.timedelta(hours=60)).count() == 2


def _sales(spark, days=120):
    d0 = datetime.date(2023, 11, 1)
    rows = [(b, d0 + datetime.timedelta(days=i), float((i * 7 + len(b)) % 11), 10.0 + i % 5) for b in ("x", "yy") for i in range(days) if i % 9]
    return spark.createDataFrame(rows, "brand string, date date, quantity double, value double").withColumn("price", F.col("value"))


def test_features_equal_pandas(spark):
    import pandas as pd

    df = series.filled(_sales(spark), ["brand"])
    got = series.ewm(series.rolling(series.lags(df, ["brand"]), ["brand"]), ["brand"]).toPandas().sort_values(["brand", "date"])
    for _, g in got.groupby("brand"):
        q = g.quantity.reset_index(drop=True)
        past = q.shift(1)
        for n in (7, 30):
            r = past.rolling(n, min_periods=1)
            for name, want in (("mean", r.mean()), ("max", r.max()), ("std", past.rolling(n, min_periods=2).std()), ("q95", r.quantile(0.95))):
                assert (g[f"quantity_{name}_{n}"].reset_index(drop=True) - want.fillna(0)).abs().max() < 1e-9
            assert (g[f"quantity_ewm_{n}"].reset_index(drop=True) - q.ewm(span=n, adjust=False).mean().shift(1).fillna(0)).abs().max() < 1e-9
        assert g.quantity_lag_90.iloc[-1] == q.iloc[-91]
    assert isinstance(got, pd.DataFrame)


def test_calendar_gaps_are_filled(spark):
    df = spark.createDataFrame([("a", datetime.date(2024, 2, 28), 1.0, 1.0, 3.0), ("a", datetime.date(2024, 3, 2), 2.0, 2.0, None), (None, datetime.date(2024, 1, 1), 1.0, 1.0, 1.0)], "brand string, date date, quantity double, value double, price double")
    rows = series.filled(df.dropna(subset=["brand"]), ["brand"]).orderBy("date").collect()
    assert [(str(r.date), r.quantity, r.price) for r in rows] == [("2024-02-28", 1, 3), ("2024-02-29", 0, 3), ("2024-03-01", 0, 3), ("2024-03-02", 2, 3)]


def test_forecast_end_to_end(spark):
    df = series.filled(_sales(spark, 150), ["brand"]).select("brand", "date", "quantity", "value")
    rows = forecast.features(df, ["brand"]).cache()
    columns = forecast.feature_columns(rows)
    assert "value" not in columns and "quantity" not in columns
    fitted = {t: forecast.train(rows, t, columns, maxIter=2, maxDepth=2) for t in ("quantity", "value")}
    assert forecast.importance(fitted["quantity"], columns)[0][1] > 0
    ahead = forecast.recursive(fitted, df, ["brand"], columns, 2)
    assert ahead.count() == 4 and ahead.agg(F.min("quantity")).first()[0] >= 0
    point, tried = forecast.search(rows, "quantity", columns, {"maxIter": [1, 2]}, n=1)
    assert len(tried) == 2 and point["maxIter"] in (1, 2)
    assert forecast.overfit(1, 3) == "overfit" and forecast.overfit(1, 1.1) == "good" and math.isfinite(tried[0][1])


def test_encoder(spark):
    e = forecast.CategoryEncoder("c").fit(spark.createDataFrame([("b",), ("a",), (None,)], "c string"))
    got = {r.c: r.c_code for r in e.transform(spark.createDataFrame([("a",), ("b",), ("z",), (None,)], "c string")).collect()}
    assert got == {"a": 0, "b": 1, "z": -1, None: -1}
    assert e.inverse(spark.createDataFrame([(1,)], "k int"), "k").first().c_value == "b"


def test_streaming_upsert_is_idempotent(spark, tmp_path):
    from sluice.operators.snapshot import SnapshotTable
    from sluice.streaming import incremental

    src = tmp_path / "in"
    src.mkdir()
    (src / "1.json").write_text('[{"k": 1, "v": "a"}, {"k": 2, "v": "b"}]')
    t = SnapshotTable(spark, str(tmp_path / "t"))
    schema = spark.createDataFrame([], "k int, v string").schema
    for i in (1, 2):
        rows = incremental.json_stream(spark, str(src), schema)
        incremental.upsert_stream(rows, t, ["k"], str(tmp_path / "cp")).awaitTermination()
        (src / "2.json").write_text('[{"k": 2, "v": "B"}, {"k": 3, "v": "c"}]')
        assert t.read().count() == (2 if i == 1 else 3)
    assert sorted(r.v for r in t.read().collect()) == ["B", "a", "c"]
