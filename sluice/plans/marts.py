"""Business marts as functions of DataFrames.

``lines`` are invoice lines of snake_case columns: doc_entry, line_num, doc_date, year, month, card_code, card_name,
sales_person_code, item_code, item_description, warehouse_code, quantity, unit_price, discount_percent, line_total,
gross_profit, cancelled. Every date-dependent mart takes ``as_of``, so results can be made again. Facts are read once
per mart: windows of 30 and 90 days are conditional aggregates, not further scans.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sluice.operators.aggregates import abc, mean, percent_rank, rounded, share, total


def _live(lines: DataFrame) -> DataFrame:
    """Lines that are not cancelled; an unknown state does not count."""
    return lines.where(F.col("cancelled") != "tYES")


def _age(as_of: datetime.date, c: str = "doc_date") -> Column:
    return F.datediff(F.lit(as_of), F.col(c))


def _distinct(**columns: str) -> list[Column]:
    return [F.countDistinct(c).alias(out) for out, c in columns.items()]


def sales_detail(lines: DataFrame, sellers: DataFrame, items: DataFrame, groups: DataFrame) -> DataFrame:
    """One row per invoice line with the names of its seller, item and group (null where unknown)."""
    named = lines.join(sellers.select("sales_person_code", F.col("sales_person_name").alias("nome_vendedor")), "sales_person_code", "left")
    named = named.join(items.select("item_code", "item_group_code", "brand"), "item_code", "left").join(groups, "item_group_code", "left")
    return named.select(
        F.col("doc_entry").alias("num_doc"), F.col("line_num").alias("num_linha"), F.col("doc_date").alias("data_nota"),
        F.col("year").alias("ano"), F.col("month").alias("mes"), F.dayofmonth("doc_date").alias("dia"), F.col("card_code").alias("cod_cliente"),
        F.col("sales_person_code").alias("cod_vendedor"), "nome_vendedor", F.col("item_code").alias("cod_item"), F.col("item_description").alias("desc_item"),
        F.col("quantity").alias("quantidade"), F.col("unit_price").alias("preco_unitario"), F.col("line_total").alias("valor_linha"), F.col("gross_profit").alias("lucro_bruto"),
        F.col("discount_percent").alias("pct_desconto"), F.col("warehouse_code").alias("cod_filial"), F.col("line_status").alias("status_linha"),
        F.col("item_group_code").alias("cod_grupo_item"), F.col("group_name").alias("nome_grupo_item"), F.col("brand").alias("marca"),
    )


def monthly_revenue(lines: DataFrame) -> DataFrame:
    keys = {"year": "ano", "month": "mes", "sales_person_code": "cod_vendedor", "card_code": "cod_cliente", "card_name": "nome_cliente", "item_code": "cod_item", "item_description": "desc_item", "warehouse_code": "cod_filial"}
    return lines.groupBy(*[F.col(c).alias(out) for c, out in keys.items()]).agg(
        total("line_total").alias("receita_total"), total("quantity").alias("qtd_itens"), *_distinct(qtd_notas="doc_entry"),
        mean("unit_price").alias("preco_medio"), mean("discount_percent").alias("pct_desconto_medio"), total("gross_profit").alias("lucro_bruto"),
        F.min("doc_date").alias("primeira_venda_periodo"), F.max("doc_date").alias("ultima_venda_periodo"),
    )


def quote_measures(quotes: DataFrame) -> DataFrame:
    return quotes.groupBy("year", "month", "sales_person_code", "item_code", "item_description").agg(*_distinct(total_cotacoes="doc_entry"), total("line_total").alias("valor_cotacoes"), total("quantity").alias("qtd_cotada"))


def order_measures(orders: DataFrame) -> DataFrame:
    keys = F.year("doc_date").alias("year"), F.month("doc_date").alias("month"), "sales_person_code", "item_code"
    return orders.groupBy(*keys).agg(*_distinct(total_pedidos="doc_entry"), total("line_total").alias("valor_pedidos"), total("quantity").alias("qtd_pedida"))


def conversion_rate(quotes: DataFrame, orders: DataFrame | None, sellers: DataFrame) -> DataFrame:
    """Orders per quote by month, seller and item. Without orders their value and quantity are not there."""
    df = quote_measures(quotes)
    if orders is not None:
        df = df.join(order_measures(orders), ["year", "month", "sales_person_code", "item_code"], "left")
        df = df.withColumn("total_pedidos", F.coalesce("total_pedidos", F.lit(0)))
    else:
        df = df.withColumn("total_pedidos", F.lit(0).cast("long"))
    df = df.withColumn("taxa_conversao", share(F.col("total_pedidos"), F.col("total_cotacoes"), 4, 1))
    df = df.join(sellers.select("sales_person_code", F.col("sales_person_name").alias("nome_vendedor")), "sales_person_code", "left")
    return df.withColumnsRenamed({"year": "ano", "month": "mes", "sales_person_code": "cod_vendedor", "item_code": "cod_item", "item_description": "desc_item"})


def seller_ranking(lines: DataFrame, sellers: DataFrame) -> DataFrame:
    perf = lines.groupBy("year", "month", "sales_person_code").agg(
        total("line_total").alias("receita_faturada"), total("gross_profit").alias("lucro_bruto"),
        *_distinct(qtd_notas="doc_entry", qtd_clientes="card_code", mix_produtos="item_code"),
        total("quantity").alias("qtd_itens_vendidos"), mean("line_total").alias("ticket_medio_linha"),
    )
    place = F.dense_rank().over(W.partitionBy("year", "month").orderBy(F.desc("receita_faturada")))
    perf = perf.withColumn("pct_margem_bruta", share(F.col("lucro_bruto"), F.col("receita_faturada"), empty=None)).withColumn("ranking", place)
    named = perf.join(sellers.select("sales_person_code", F.col("sales_person_name").alias("nome_vendedor")), "sales_person_code", "left")
    return named.withColumnsRenamed({"year": "ano", "month": "mes", "sales_person_code": "cod_vendedor"})


def product_sales(lines: DataFrame, items: DataFrame, groups: DataFrame) -> DataFrame:
    sold = lines.groupBy("year", "month", "item_code").agg(
        total("line_total").alias("receita"), total("quantity").alias("quantidade"), total("gross_profit").alias("lucro_bruto"),
        *_distinct(qtd_notas="doc_entry", qtd_clientes="card_code", qtd_vendedores="sales_person_code"), mean("unit_price").alias("preco_medio"),
    )
    named = sold.join(items.select("item_code", "item_name", "item_group_code"), "item_code", "left").join(groups, "item_group_code", "left")
    return named.withColumnsRenamed({"year": "ano", "month": "mes", "item_code": "cod_item", "item_name": "nome_item", "item_group_code": "cod_grupo_item", "group_name": "nome_grupo_item"})


def _activity(days: Column, names: tuple[str, str, str, str]) -> Column:
    return F.when(days <= 30, names[0]).when(days <= 90, names[1]).when(days <= 180, names[2]).otherwise(names[3])


def customer_measures(lines: DataFrame, as_of: datetime.date) -> DataFrame:
    """Recency, frequency and value of each customer."""
    return _live(lines).groupBy("card_code").agg(
        F.max("doc_date").alias("data_ultima_compra"), F.min("doc_date").alias("data_primeira_compra"), F.datediff(F.lit(as_of), F.max("doc_date")).alias("recencia_dias"),
        *_distinct(total_notas="doc_entry"), F.countDistinct(F.date_format("doc_date", "yyyy-MM")).alias("meses_ativos"), F.count("*").alias("total_linhas"),
        rounded(total("line_total"), 2).alias("valor_total_compras"), mean("line_total").alias("ticket_medio_linha"), rounded(total("gross_profit"), 2).alias("lucro_bruto_total"),
        *_distinct(diversidade_itens="item_code", vendedores_atenderam="sales_person_code"),
    )


def customer_profile(lines: DataFrame, partners: DataFrame, as_of: datetime.date) -> DataFrame:
    """RFV profile with ABC class by percentile of customers (rounded to 4 digits first)."""
    rfv = percent_rank(customer_measures(lines, as_of), "valor_total_compras", "pct_rank_receita")
    rfv = rfv.withColumn("pct_rank_receita", rounded(F.col("pct_rank_receita"), 4))
    months = F.round(F.months_between(F.lit(as_of), "data_primeira_compra"), 0).cast("int")
    rfv = rfv.select(
        "*", abc(F.col("pct_rank_receita")).alias("classificacao_abc"), share(F.col("lucro_bruto_total"), F.col("valor_total_compras")).alias("pct_margem_media"),
        months.alias("meses_desde_primeira_compra"), _activity(F.col("recencia_dias"), ("ativo", "em_risco", "inativo_recente", "inativo_cronico")).alias("segmento_atividade"),
    )
    m, n = F.col("meses_desde_primeira_compra"), F.col("total_notas")
    rfv = rfv.withColumn("frequencia_mensal", F.when(m > 0, rounded(F.try_divide(n, m), 2)).otherwise(n.cast("double")))
    return rfv.join(partners, "card_code", "left").withColumnRenamed("card_code", "cod_cliente")


def product_catalogue(lines: DataFrame, items: DataFrame, groups: DataFrame, as_of: datetime.date) -> DataFrame:
    """One row per item: sales of all time and of the last 30 and 90 days, status and ABC class."""
    age = _age(as_of)
    sold = _live(lines).groupBy("item_code").agg(
        total("line_total").alias("receita_total"), total("quantity").alias("qtd_total_vendida"), mean("unit_price").alias("preco_medio_praticado"),
        F.min("unit_price").alias("preco_minimo"), F.max("unit_price").alias("preco_maximo"), *_distinct(qtd_clientes_compraram="card_code", qtd_notas="doc_entry"),
        F.max("doc_date").alias("data_ultima_venda"), F.min("doc_date").alias("data_primeira_venda"), F.datediff(F.lit(as_of), F.max("doc_date")).alias("dias_sem_venda"),
        *[total(c, age <= d).alias(f"{out}_{d}d") for d in (30, 90) for out, c in (("receita", "line_total"), ("qtd", "quantity"))],
        *[F.max(age <= d).alias(f"_sold_{d}") for d in (30, 90)],
    )
    df = items.join(sold, "item_code", "left").join(groups, "item_group_code", "left")
    days = F.col("dias_sem_venda")
    status = F.when(F.col("valid") == "tYES", F.when(days.isNull(), "sem_venda").otherwise(_activity(days, ("ativo", "lento", "encalhado", "obsoleto")))).otherwise("inativo_cadastro")
    df = percent_rank(df, "receita_total", "_rank")
    df = df.select("*", F.col("receita_30d").isNotNull().alias("vendeu_30d"), F.col("receita_90d").isNotNull().alias("vendeu_90d"), status.alias("status_produto"), F.when(F.col("receita_total").isNull(), "sem_venda").otherwise(abc(F.col("_rank"))).alias("classificacao_abc_produto"))
    return df.drop("_rank", "_sold_30", "_sold_90").withColumnsRenamed({"item_code": "cod_item", "item_name": "nome_item", "item_group_code": "cod_grupo", "group_name": "nome_grupo", "brand": "marca"})


def seller_coverage(lines: DataFrame, sellers: DataFrame, as_of: datetime.date) -> DataFrame:
    """One row per seller; a customer may count as active and as inactive (it bought before and after the bound)."""
    age = _age(as_of)
    perf = _live(lines).groupBy("sales_person_code").agg(
        rounded(total("line_total"), 2).alias("receita_total"), rounded(total("gross_profit"), 2).alias("lucro_bruto_total"),
        *_distinct(total_notas="doc_entry", total_clientes="card_code", mix_produtos="item_code"), mean("line_total").alias("ticket_medio_linha"),
        F.max("doc_date").alias("data_ultima_venda"), F.min("doc_date").alias("data_primeira_venda"), F.countDistinct(F.date_format("doc_date", "yyyy-MM")).alias("meses_ativos"),
        F.countDistinct(F.when(age <= 90, F.col("card_code"))).alias("clientes_ativos_90d"), F.countDistinct(F.when(age > 90, F.col("card_code"))).alias("clientes_inativos_90d"),
    )
    customers, revenue = F.col("total_clientes"), F.col("receita_total")
    out = perf.select(
        "*", share(F.col("clientes_ativos_90d"), customers).alias("pct_carteira_ativa"), share(F.col("lucro_bruto_total"), revenue).alias("pct_margem"),
        share(revenue, customers, 2, 1).alias("receita_por_cliente"),
    )
    return out.join(sellers.withColumnRenamed("sales_person_name", "nome_vendedor"), "sales_person_code", "left").withColumnRenamed("sales_person_code", "cod_vendedor")


def _pair_measures(docs: DataFrame, names: tuple[str, ...]) -> DataFrame:
    n, value, line, mix, last, first = names
    return docs.groupBy("card_code", "sales_person_code").agg(*_distinct(**{n: "doc_entry", mix: "item_code"}), rounded(total("line_total"), 2).alias(value), mean("line_total").alias(line), F.max("doc_date").alias(last), F.min("doc_date").alias(first))


QUOTE_NAMES = ("total_cotacoes", "valor_total_cotacoes", "valor_medio_linha_cotacao", "diversidade_itens_cotados", "data_ultima_cotacao", "data_primeira_cotacao")
ORDER_NAMES = ("total_pedidos", "valor_total_pedidos", "valor_medio_linha_pedido", "diversidade_itens_pedidos", "data_ultimo_pedido", "data_primeiro_pedido")


def conversion_features(quotes: DataFrame, orders: DataFrame, partners: DataFrame, sellers: DataFrame, as_of: datetime.date) -> DataFrame:
    """Features of each customer and seller for predicting conversion."""
    df = _pair_measures(quotes, QUOTE_NAMES).join(_pair_measures(orders, ORDER_NAMES), ["card_code", "sales_person_code"], "left")
    df = df.withColumn("total_pedidos", F.coalesce("total_pedidos", F.lit(0)))
    df = df.select(
        "*", share(F.col("total_pedidos"), F.col("total_cotacoes"), 4, 1).alias("taxa_conversao"), F.datediff("data_ultimo_pedido", "data_primeira_cotacao").alias("dias_ciclo_venda"),
        _age(as_of, "data_ultima_cotacao").alias("recencia_ultima_cotacao_dias"), _age(as_of, "data_ultimo_pedido").alias("recencia_ultimo_pedido_dias"),
    )
    df = df.join(partners, "card_code", "left").join(sellers.withColumnRenamed("sales_person_name", "nome_vendedor"), "sales_person_code", "left")
    return df.withColumnsRenamed({"card_code": "cod_cliente", "sales_person_code": "cod_vendedor"})


def stock_movement(moves: DataFrame, items: DataFrame, groups: DataFrame) -> DataFrame:
    """Receipts and issues by month, item and warehouse; the sign of a quantity tells which."""
    q, v = F.col("quantity"), F.col("line_total")
    part = lambda where, x: total(F.when(where, x).otherwise(F.lit(0)))
    df = moves.groupBy("year", "month", "item_code", "warehouse_code").agg(
        part(q > 0, q).alias("qtd_entrada"), part(q < 0, F.abs(q)).alias("qtd_saida"), part(q > 0, v).alias("valor_entrada"), part(q < 0, F.abs(v)).alias("valor_saida"),
        total("quantity").alias("saldo_qtd"), total("line_total").alias("saldo_valor"), *_distinct(qtd_documentos="doc_entry"), F.count("*").alias("qtd_linhas"),
        mean("unit_price").alias("preco_medio_unitario"), F.min("doc_date").alias("primeira_movimentacao"), F.max("doc_date").alias("ultima_movimentacao"),
    )
    df = df.join(items.select("item_code", "item_name", "item_group_code"), "item_code", "left").join(groups, "item_group_code", "left")
    return df.withColumnsRenamed({"year": "ano", "month": "mes", "item_code": "cod_item", "item_name": "nome_item", "item_group_code": "cod_grupo_item", "group_name": "nome_grupo_item", "warehouse_code": "cod_deposito"})


def pareto(lines: DataFrame) -> DataFrame:
    """An extension: ABC by cumulative share of revenue, by month (80 % A, 95 % B)."""
    sold = lines.groupBy("year", "month", "item_code").agg(F.sum(F.col("line_total").cast("decimal(18,4)")).alias("_r"))
    w = W.partitionBy("year", "month")
    running = F.sum("_r").over(w.orderBy(F.desc("_r"), "item_code").rowsBetween(W.unboundedPreceding, 0))
    df = sold.withColumn("share", rounded(running.cast("double") / F.sum("_r").over(w).cast("double"), 6))
    return df.select("year", "month", "item_code", F.col("_r").cast("double").alias("revenue"), "share", F.when(F.col("share") <= 0.8, "A").when(F.col("share") <= 0.95, "B").otherwise("C").alias("class"))
