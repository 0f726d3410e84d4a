"""Queries of the marts over the test tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sluice.plans import adapter as a
from sluice.plans import marts
from sluice.plans.sqltext import decimal_rounds

_D = f"DATE '{a.AS_OF}'"


def _sum(c: str, where: str = "") -> str:
    return f"CAST(sum(CAST({c} AS DECIMAL(18,4))){' FILTER (WHERE ' + where + ')' if where else ''} AS DOUBLE)"


def _mean(c: str, digits: int = 2) -> str:
    return f"round({_sum(c)} / count({c}), {digits})"


def ag1_faturamento_mensal(s: SparkSession, d: str) -> DataFrame:
    return marts.monthly_revenue(a.lines(s, d))


def ag2_cotacoes_medidas(s: SparkSession, d: str) -> DataFrame:
    return marts.quote_measures(a.quotes(s, d))


def ag3_pedidos_medidas(s: SparkSession, d: str) -> DataFrame:
    return marts.order_measures(a.orders(s, d))


def ag4_taxa_conversao(s: SparkSession, d: str) -> DataFrame:
    return marts.conversion_rate(a.quotes(s, d), a.orders(s, d), a.sellers(s, d))


def ag5_ranking_vendedores(s: SparkSession, d: str) -> DataFrame:
    return marts.seller_ranking(a.lines(s, d), a.sellers(s, d))


def ag6_vendas_por_produto(s: SparkSession, d: str) -> DataFrame:
    return marts.product_sales(a.lines(s, d), a.items(s, d), a.groups(s, d))


def ag7_medidas_cliente(s: SparkSession, d: str) -> DataFrame:
    return marts.customer_measures(a.lines(s, d), a.AS_OF)


def ag8_perfil_cliente(s: SparkSession, d: str) -> DataFrame:
    return marts.customer_profile(a.lines(s, d), a.partners(s, d), a.AS_OF)


def ag9_catalogo_produtos(s: SparkSession, d: str) -> DataFrame:
    return marts.product_catalogue(a.lines(s, d), a.items(s, d), a.groups(s, d), a.AS_OF)


def ag10_cobertura_vendedor(s: SparkSession, d: str) -> DataFrame:
    return marts.seller_coverage(a.lines(s, d), a.sellers(s, d), a.AS_OF)


def ag11_features_conversao(s: SparkSession, d: str) -> DataFrame:
    return marts.conversion_features(a.quotes(s, d), a.orders(s, d), a.partners(s, d), a.sellers(s, d), a.AS_OF)


def ag12_movimentacao_estoque(s: SparkSession, d: str) -> DataFrame:
    return marts.stock_movement(a.moves(s, d), a.items(s, d), a.groups(s, d))


def jn1_vendas_detalhada(s: SparkSession, d: str) -> DataFrame:
    return marts.sales_detail(a.lines(s, d), a.sellers(s, d), a.items(s, d), a.groups(s, d))


def ext_pareto_mensal(s: SparkSession, d: str) -> DataFrame:
    return marts.pareto(a.lines(s, d))


_QUOTES = f"""c AS (SELECT year, month, sales_person_code, item_code, item_description, count(DISTINCT doc_entry) AS total_cotacoes, {_sum('line_total')} AS valor_cotacoes, {_sum('quantity')} AS qtd_cotada FROM inv GROUP BY ALL)"""
_ORDERS = f"""p AS (SELECT year, month, sales_person_code, item_code, count(DISTINCT doc_entry) AS total_pedidos, {_sum('line_total')} AS valor_pedidos, {_sum('quantity')} AS qtd_pedida FROM ped GROUP BY ALL)"""
_CUSTOMER = f"""r AS (SELECT card_code, max(doc_date) AS data_ultima_compra, min(doc_date) AS data_primeira_compra, ({_D} - max(doc_date))::INT AS recencia_dias,
  count(DISTINCT doc_entry) AS total_notas, count(DISTINCT strftime(doc_date, '%Y-%m')) AS meses_ativos, count(*) AS total_linhas, round({_sum('line_total')}, 2) AS valor_total_compras,
  {_mean('line_total')} AS ticket_medio_linha, round({_sum('gross_profit')}, 2) AS lucro_bruto_total, count(DISTINCT item_code) AS diversidade_itens, count(DISTINCT sales_person_code) AS vendedores_atenderam
  FROM live GROUP BY card_code)"""
_PART = "sum(CAST(CASE WHEN {w} THEN {x} ELSE 0 END AS DECIMAL(18,4)))::DOUBLE"
#: Months between a date and the as-of date, as Spark counts them: whole months if both are the same day or both last days, else days by 31.
_MONTHS = f"""(datediff('month', x, {_D}) + CASE WHEN day(x) = day({_D}) OR (x = last_day(x) AND {_D} = last_day({_D})) THEN 0 ELSE (day({_D}) - day(x)) / 31.0 END)"""


def _activity(days: str, names: list[str]) -> str:
    return f"CASE WHEN {days} <= 30 THEN '{names[0]}' WHEN {days} <= 90 THEN '{names[1]}' WHEN {days} <= 180 THEN '{names[2]}' ELSE '{names[3]}' END"


def _pairs(name: str, source: str, n) -> str:
    return f"""{name} AS (SELECT card_code, sales_person_code, count(DISTINCT doc_entry) AS {n[0]}, round({_sum('line_total')}, 2) AS {n[1]}, {_mean('line_total')} AS {n[2]}, count(DISTINCT item_code) AS {n[3]}, max(doc_date) AS {n[4]}, min(doc_date) AS {n[5]} FROM {source} GROUP BY ALL)"""


_SQL = {
    "ag1_faturamento_mensal": f"""SELECT year AS ano, month AS mes, sales_person_code AS cod_vendedor, card_code AS cod_cliente, card_name AS nome_cliente, item_code AS cod_item, item_description AS desc_item, warehouse_code AS cod_filial,
  {_sum('line_total')} AS receita_total, {_sum('quantity')} AS qtd_itens, count(DISTINCT doc_entry) AS qtd_notas, {_mean('unit_price')} AS preco_medio, {_mean('discount_percent')} AS pct_desconto_medio,
  {_sum('gross_profit')} AS lucro_bruto, min(doc_date) AS primeira_venda_periodo, max(doc_date) AS ultima_venda_periodo FROM inv GROUP BY ALL""",
    "ag2_cotacoes_medidas": (_QUOTES, "SELECT * FROM c"),
    "ag3_pedidos_medidas": (_ORDERS, "SELECT * FROM p"),
    "ag4_taxa_conversao": (_QUOTES + ", " + _ORDERS, """SELECT c.year AS ano, c.month AS mes, c.sales_person_code AS cod_vendedor, c.item_code AS cod_item, c.item_description AS desc_item, total_cotacoes, valor_cotacoes, qtd_cotada,
  coalesce(total_pedidos, 0) AS total_pedidos, valor_pedidos, qtd_pedida, CASE WHEN total_cotacoes > 0 THEN round(coalesce(total_pedidos, 0) / total_cotacoes, 4) ELSE 0 END AS taxa_conversao, sales_person_name AS nome_vendedor
  FROM c LEFT JOIN p USING (year, month, sales_person_code, item_code) LEFT JOIN sellers USING (sales_person_code)"""),
    "ag5_ranking_vendedores": f"""SELECT * EXCLUDE (r), dense_rank() OVER (PARTITION BY ano, mes ORDER BY receita_faturada DESC)::INT AS ranking FROM (
  SELECT 1 AS r, year AS ano, month AS mes, sales_person_code AS cod_vendedor, any_value(sales_person_name) AS nome_vendedor, {_sum('line_total')} AS receita_faturada, {_sum('gross_profit')} AS lucro_bruto, count(DISTINCT doc_entry) AS qtd_notas,
  count(DISTINCT card_code) AS qtd_clientes, count(DISTINCT item_code) AS mix_produtos, {_sum('quantity')} AS qtd_itens_vendidos, {_mean('line_total')} AS ticket_medio_linha,
  round({_sum('gross_profit')} / nullif({_sum('line_total')}, 0) * 100, 2) AS pct_margem_bruta FROM inv LEFT JOIN sellers USING (sales_person_code) GROUP BY ano, mes, cod_vendedor)""",
    "ag6_vendas_por_produto": f"""SELECT year AS ano, month AS mes, item_code AS cod_item, any_value(item_name) AS nome_item, any_value(item_group_code) AS cod_grupo_item, any_value(group_name) AS nome_grupo_item, {_sum('line_total')} AS receita,
  {_sum('quantity')} AS quantidade, {_sum('gross_profit')} AS lucro_bruto, count(DISTINCT doc_entry) AS qtd_notas, count(DISTINCT card_code) AS qtd_clientes, count(DISTINCT sales_person_code) AS qtd_vendedores, {_mean('unit_price')} AS preco_medio
  FROM inv LEFT JOIN items USING (item_code) LEFT JOIN grp USING (item_group_code) GROUP BY year, month, item_code""",
    "ag7_medidas_cliente": (_CUSTOMER, "SELECT * FROM r"),
    "ag8_perfil_cliente": (_CUSTOMER + f""", k AS (SELECT *, round(percent_rank() OVER (ORDER BY valor_total_compras DESC NULLS LAST), 4) AS pct_rank_receita, data_primeira_compra AS x FROM r),
  m AS (SELECT * EXCLUDE (x), CASE WHEN pct_rank_receita <= 0.2 THEN 'A' WHEN pct_rank_receita <= 0.5 THEN 'B' ELSE 'C' END AS classificacao_abc,
    CASE WHEN valor_total_compras > 0 THEN round(lucro_bruto_total / valor_total_compras * 100, 2) ELSE 0 END AS pct_margem_media, round({_MONTHS}, 0)::INT AS meses_desde_primeira_compra,
    {_activity('recencia_dias', ['ativo', 'em_risco', 'inativo_recente', 'inativo_cronico'])} AS segmento_atividade FROM k)""",
  """SELECT m.* RENAME (card_code AS cod_cliente), CASE WHEN meses_desde_primeira_compra > 0 THEN round(total_notas / meses_desde_primeira_compra, 2) ELSE total_notas::DOUBLE END AS frequencia_mensal,
  tipo_cliente, grupo_cliente, saldo_conta_corrente FROM m LEFT JOIN partners USING (card_code)"""),
    "ag9_catalogo_produtos": (f"""v AS (SELECT item_code, {_sum('line_total')} AS receita_total, {_sum('quantity')} AS qtd_total_vendida, {_mean('unit_price')} AS preco_medio_praticado, min(unit_price) AS preco_minimo, max(unit_price) AS preco_maximo,
  count(DISTINCT card_code) AS qtd_clientes_compraram, count(DISTINCT doc_entry) AS qtd_notas, max(doc_date) AS data_ultima_venda, min(doc_date) AS data_primeira_venda, ({_D} - max(doc_date))::INT AS dias_sem_venda,
  {', '.join(f"{_sum(c, f'{_D} - doc_date <= {n}')} AS {o}_{n}d" for n in (30, 90) for o, c in (('receita', 'line_total'), ('qtd', 'quantity')))} FROM live GROUP BY item_code),
  j AS (SELECT *, percent_rank() OVER (ORDER BY receita_total DESC NULLS LAST) AS pr FROM items LEFT JOIN v USING (item_code) LEFT JOIN grp USING (item_group_code))""",
  f"""SELECT j.* EXCLUDE (pr) RENAME (item_code AS cod_item, item_name AS nome_item, item_group_code AS cod_grupo, group_name AS nome_grupo, brand AS marca), receita_30d IS NOT NULL AS vendeu_30d, receita_90d IS NOT NULL AS vendeu_90d,
  CASE WHEN valid = 'tYES' THEN CASE WHEN dias_sem_venda IS NULL THEN 'sem_venda' ELSE {_activity('dias_sem_venda', ['ativo', 'lento', 'encalhado', 'obsoleto'])} END ELSE 'inativo_cadastro' END AS status_produto,
  CASE WHEN receita_total IS NULL THEN 'sem_venda' WHEN pr <= 0.2 THEN 'A' WHEN pr <= 0.5 THEN 'B' ELSE 'C' END AS classificacao_abc_produto FROM j"""),
    "ag10_cobertura_vendedor": (f"""p AS (SELECT sales_person_code, round({_sum('line_total')}, 2) AS receita_total, round({_sum('gross_profit')}, 2) AS lucro_bruto_total, count(DISTINCT doc_entry) AS total_notas, count(DISTINCT card_code) AS total_clientes,
  count(DISTINCT item_code) AS mix_produtos, {_mean('line_total')} AS ticket_medio_linha, max(doc_date) AS data_ultima_venda, min(doc_date) AS data_primeira_venda, count(DISTINCT strftime(doc_date, '%Y-%m')) AS meses_ativos,
  count(DISTINCT card_code) FILTER (WHERE {_D} - doc_date <= 90) AS clientes_ativos_90d, count(DISTINCT card_code) FILTER (WHERE {_D} - doc_date > 90) AS clientes_inativos_90d FROM live GROUP BY sales_person_code)""",
  """SELECT p.* RENAME (sales_person_code AS cod_vendedor), sales_person_name AS nome_vendedor, CASE WHEN total_clientes > 0 THEN round(clientes_ativos_90d / total_clientes * 100, 2) ELSE 0 END AS pct_carteira_ativa,
  CASE WHEN receita_total > 0 THEN round(lucro_bruto_total / receita_total * 100, 2) ELSE 0 END AS pct_margem, CASE WHEN total_clientes > 0 THEN round(receita_total / total_clientes, 2) ELSE 0 END AS receita_por_cliente
  FROM p LEFT JOIN sellers USING (sales_person_code)"""),
    "ag11_features_conversao": (_pairs("c", "inv", marts.QUOTE_NAMES) + ", " + _pairs("p", "ped", marts.ORDER_NAMES), f"""SELECT c.* RENAME (card_code AS cod_cliente, sales_person_code AS cod_vendedor), coalesce(total_pedidos, 0) AS total_pedidos, p.* EXCLUDE (card_code, sales_person_code, total_pedidos),
  CASE WHEN total_cotacoes > 0 THEN round(coalesce(total_pedidos, 0) / total_cotacoes, 4) ELSE 0 END AS taxa_conversao, (data_ultimo_pedido - data_primeira_cotacao)::INT AS dias_ciclo_venda,
  ({_D} - data_ultima_cotacao)::INT AS recencia_ultima_cotacao_dias, ({_D} - data_ultimo_pedido)::INT AS recencia_ultimo_pedido_dias, tipo_cliente, grupo_cliente, saldo_conta_corrente, sales_person_name AS nome_vendedor
  FROM c LEFT JOIN p ON c.card_code = p.card_code AND c.sales_person_code = p.sales_person_code LEFT JOIN partners ON partners.card_code = c.card_code LEFT JOIN sellers ON sellers.sales_person_code = c.sales_person_code"""),
    "ag12_movimentacao_estoque": f"""SELECT year AS ano, month AS mes, item_code AS cod_item, any_value(item_name) AS nome_item, any_value(item_group_code) AS cod_grupo_item, any_value(group_name) AS nome_grupo_item, warehouse_code AS cod_deposito,
  {_PART.format(w='quantity > 0', x='quantity')} AS qtd_entrada, {_PART.format(w='quantity < 0', x='abs(quantity)')} AS qtd_saida, {_PART.format(w='quantity > 0', x='line_total')} AS valor_entrada, {_PART.format(w='quantity < 0', x='abs(line_total)')} AS valor_saida,
  {_sum('quantity')} AS saldo_qtd, {_sum('line_total')} AS saldo_valor, count(DISTINCT doc_entry) AS qtd_documentos, count(*) AS qtd_linhas, {_mean('unit_price')} AS preco_medio_unitario, min(doc_date) AS primeira_movimentacao, max(doc_date) AS ultima_movimentacao
  FROM moves LEFT JOIN items USING (item_code) LEFT JOIN grp USING (item_group_code) GROUP BY year, month, item_code, warehouse_code""",
    "jn1_vendas_detalhada": """SELECT doc_entry AS num_doc, line_num AS num_linha, doc_date AS data_nota, year AS ano, month AS mes, day(doc_date)::INT AS dia, card_code AS cod_cliente, sales_person_code AS cod_vendedor, sales_person_name AS nome_vendedor,
  item_code AS cod_item, item_description AS desc_item, quantity AS quantidade, unit_price AS preco_unitario, line_total AS valor_linha, gross_profit AS lucro_bruto, discount_percent AS pct_desconto, warehouse_code AS cod_filial, line_status AS status_linha,
  item_group_code AS cod_grupo_item, group_name AS nome_grupo_item, brand AS marca FROM inv LEFT JOIN sellers USING (sales_person_code) LEFT JOIN items USING (item_code) LEFT JOIN grp USING (item_group_code)""",
    "ext_pareto_mensal": """SELECT year, month, item_code, r::DOUBLE AS revenue, share, CASE WHEN share <= 0.8 THEN 'A' WHEN share <= 0.95 THEN 'B' ELSE 'C' END AS class FROM (
  SELECT year, month, item_code, r, round((sum(r) OVER (PARTITION BY year, month ORDER BY r DESC, item_code ROWS UNBOUNDED PRECEDING))::DOUBLE / (sum(r) OVER (PARTITION BY year, month))::DOUBLE, 6) AS share FROM (
  SELECT year, month, item_code, sum(CAST(line_total AS DECIMAL(18,4))) AS r FROM inv GROUP BY ALL))""",
}


def queries() -> dict:
    return {n: globals()[n] for n in _SQL}


def oracle_sql() -> dict[str, str]:
    out = {}
    for name, q in _SQL.items():
        parts, select = q if isinstance(q, tuple) else ("", q)
        out[name] = decimal_rounds(f"WITH {a.SQL}{', ' + parts if parts else ''} {select}")
    return out
