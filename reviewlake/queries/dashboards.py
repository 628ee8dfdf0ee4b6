"""Statistics, dashboard queries, windows, paging and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewlake.session import checkpointed, scratch_path

from reviewlake.functions import rules
from reviewlake.functions.jsonio import json_extract
from reviewlake.operators import analytics as an
from reviewlake.operators import gold
from reviewlake.operators.bronze import normalize_landing, to_bronze
from reviewlake.operators.silver import dashboard_filter, drill_down, to_silver
from reviewlake.queries import query
from reviewlake.queries.fixtures import (
    AS_OF, DAY, LANDED_SQL, bronze, hits_sql, landing_documents, on_bronze, on_silver, silver, sql_text,
    table, with_ctes, SILVER_SQL,
)
from reviewlake.queries.gold import ALERTS_SQL, KPIS_SQL, NPS_SQL
from reviewlake.sources.catalog import run_sql


def kpis(spark, sf_dir):
    return gold.agency_performance_kpis(silver(spark, sf_dir), AS_OF)


def on_kpis(body):
    return with_ctes(SILVER_SQL + f", kpis AS ({KPIS_SQL})", body)


def on_nps(body):
    return with_ctes(SILVER_SQL + f", nps AS ({NPS_SQL})", body)


def on_alerts(body):
    return with_ctes(SILVER_SQL + f", alerts AS ({ALERTS_SQL})", body)


def round2(expr: str) -> str:
    return f"CAST(round(CAST({expr} AS DECIMAL(28,10)), 2) AS DOUBLE)"


def pct(part: str, total: str) -> str:
    return f"(CAST({part} AS DOUBLE) * 100.0::DOUBLE / CAST({total} AS DOUBLE))"


@query("run_stats", on_bronze("""
  SELECT count(*) AS total_reviews, count(DISTINCT place_id) AS agencias_unicas,
    count(DISTINCT bairro_pesquisado) AS bairros_unicos FROM bronze
"""))
def _(spark, sf_dir):
    return an.run_stats(bronze(spark, sf_dir))


@query("sentiment_counts", on_silver(
    "SELECT sentimento, count(*) AS total FROM silver GROUP BY sentimento"))
def _(spark, sf_dir):
    return an.sentiment_counts(silver(spark, sf_dir))


@query("pii_counts", on_silver("SELECT tem_pii, count(*) AS total FROM silver GROUP BY tem_pii"))
def _(spark, sf_dir):
    return an.pii_counts(silver(spark, sf_dir))


@query("unique_branch_metrics", on_silver("""
  , one AS (SELECT *, row_number() OVER (PARTITION BY place_id ORDER BY data_coleta, l_orderkey,
      l_linenumber, rating_review) AS rn FROM silver)
  SELECT count(*) AS total_agencias, CAST(sum(total_avaliacoes) AS BIGINT) AS total_reviews,
    (SELECT count(*) FROM silver) AS total_registros,
    (SELECT count(*) FROM silver) - count(*) AS duplicatas_detectadas
  FROM one WHERE rn = 1
"""))
def _(spark, sf_dir):
    rows = silver(spark, sf_dir).withColumnRenamed("total_avaliacoes", "user_ratings_total")
    return an.unique_branch_metrics(rows, ["data_coleta", "data_review", "rating_review"])


@query("nlp_metrics", on_silver(f"""
  SELECT count(*) AS total_processados, count(*) FILTER (sentimento = 'positivo') AS positivos,
    count(*) FILTER (sentimento = 'negativo') AS negativos,
    count(*) FILTER (sentimento = 'neutro') AS neutros,
    {round2(pct("count(*) FILTER (tem_pii)", "count(*)"))} AS taxa_deteccao_pii
  FROM silver
"""))
def _(spark, sf_dir):
    m = an.nlp_metrics(silver(spark, sf_dir))
    spread = F.col("distribuicao_sentimentos")
    return m.select(
        "total_processados",
        *[F.try_element_at(spread, F.lit(s)).alias(s + "s") for s in rules.SENTIMENTS],
        "taxa_deteccao_pii")


@query("sentiment_share", on_silver(f"""
  SELECT sentimento, count(*) AS total,
    {round2(pct("count(*)", "sum(count(*)) OVER ()"))} AS percentual
  FROM silver GROUP BY sentimento ORDER BY total DESC, sentimento
"""))
def _(spark, sf_dir):
    return an.sentiment_share(silver(spark, sf_dir))


@query("date_consistency", on_bronze("""
  SELECT count(*) AS total_registros,
    count(CASE WHEN bronze_ingestion_date >= TRY_CAST(data_coleta AS TIMESTAMP) THEN 1 END) AS datas_consistentes,
    count(CASE WHEN bronze_ingestion_date < TRY_CAST(data_coleta AS TIMESTAMP) THEN 1 END) AS datas_inconsistentes
  FROM bronze
"""))
def _(spark, sf_dir):
    return an.date_consistency(bronze(spark, sf_dir))


@query("pii_anomalies", on_silver(f"""
  SELECT nome_agencia, bairro, count(*) AS total_avaliacoes,
    count(*) FILTER (tem_pii) AS registros_com_pii,
    {round2(pct("count(*) FILTER (tem_pii)", "count(*)"))} AS perc_pii
  FROM silver GROUP BY nome_agencia, bairro
  HAVING count(*) >= 10 AND {round2(pct("count(*) FILTER (tem_pii)", "count(*)"))} > 20
"""))
def _(spark, sf_dir):
    return an.pii_anomalies(silver(spark, sf_dir))


@query("bairro_kpis", on_silver(f"""
  SELECT bairro, count(DISTINCT place_id) AS total_agencias, count(*) AS total_avaliacoes,
    {round2("CAST(sum(CAST(rating_agencia AS DECIMAL(25,6))) AS DOUBLE) / count(*)")} AS rating_medio,
    {round2(pct("count(*) FILTER (sentimento = 'positivo')", "count(*)"))} AS perc_sentimento_positivo
  FROM silver GROUP BY bairro
"""))
def _(spark, sf_dir):
    return an.bairro_kpis(silver(spark, sf_dir))


@query("layer_summary", on_silver(f"""
  SELECT 'Bronze' AS camada, count(*) AS total_registros, count(DISTINCT place_id) AS agencias_unicas,
    strftime(min(bronze_ingestion_date), '%Y-%m-%d %H:%M:%S') AS primeira_ingestao,
    strftime(max(bronze_ingestion_date), '%Y-%m-%d %H:%M:%S') AS ultima_ingestao FROM bronze
  UNION ALL
  SELECT 'Silver', count(*), count(DISTINCT place_id),
    strftime(min(silver_processing_timestamp), '%Y-%m-%d %H:%M:%S'),
    strftime(max(silver_processing_timestamp), '%Y-%m-%d %H:%M:%S') FROM silver
"""))
def _(spark, sf_dir):
    return an.layer_summary(bronze(spark, sf_dir), silver(spark, sf_dir))


@query("privacy_kpis", on_silver("""
  SELECT place_id, nome_agencia, count(*) AS total_reviews, avg(rating_review) AS avg_rating,
    count(*) FILTER (sentimento = 'positivo') AS positive_reviews
  FROM silver GROUP BY place_id, nome_agencia HAVING count(*) >= 5
"""))
def _(spark, sf_dir):
    return an.privacy_kpis(silver(spark, sf_dir))


@query("masking_status", on_silver("""
  SELECT count(*) AS total_records, count(review_autor) AS authors_present,
    count(CASE WHEN texto_anonimizado LIKE '%[%_ANONIMIZADO]%' OR texto_anonimizado LIKE '%[%_MASCARADO]%'
      THEN 1 END) AS masked_texts
  FROM silver
"""))
def _(spark, sf_dir):
    return an.masking_status(silver(spark, sf_dir))


@query("rating_sentiment_matrix", on_silver(
    "SELECT rating_review, sentimento, count(*) AS total FROM silver GROUP BY ALL"))
def _(spark, sf_dir):
    return an.rating_sentiment_matrix(silver(spark, sf_dir))


@query("rating_sentiment_corr", on_silver("""
  , s AS (SELECT rating_review AS x,
      CASE sentimento WHEN 'positivo' THEN 1 WHEN 'negativo' THEN -1 ELSE 0 END AS y FROM silver),
  t AS (SELECT count(*)::DOUBLE AS n, sum(x)::DOUBLE AS sx, sum(y)::DOUBLE AS sy,
      sum(x * x)::DOUBLE AS sxx, sum(y * y)::DOUBLE AS syy, sum(x * y)::DOUBLE AS sxy FROM s)
  SELECT CAST(n AS BIGINT) AS total,
    (n * sxy - sx * sy) / (sqrt(n * sxx - sx * sx) * sqrt(n * syy - sy * sy)) AS correlacao
  FROM t
"""))
def _(spark, sf_dir):
    return an.rating_sentiment_corr(silver(spark, sf_dir))


# --- dashboards over Gold ----------------------------------------------------

@query("executive_overview", on_kpis(f"""
  SELECT count(DISTINCT place_id) AS total_agencias,
    CAST(sum(CAST(rating_medio AS DECIMAL(28,12))) AS DOUBLE) / count(*) AS nps_geral,
    CAST(sum(total_reviews) AS BIGINT) AS avaliacoes_totais,
    {round2(pct("sum(reviews_positivos)", "sum(total_reviews)"))} AS perc_positivos,
    {round2(pct("sum(reviews_negativos)", "sum(total_reviews)"))} AS perc_negativos
  FROM kpis WHERE CAST(gold_timestamp AS TIMESTAMP) >= DATE '{DAY}' - INTERVAL 30 DAY
"""))
def _(spark, sf_dir):
    return an.executive_overview(kpis(spark, sf_dir), AS_OF)


@query("bairro_status", on_kpis("""
  , b AS (SELECT bairro, count(DISTINCT place_id) AS agencias_no_bairro,
      CAST(sum(CAST(rating_medio AS DECIMAL(28,12))) AS DOUBLE) / count(*) AS rating_medio_bairro,
      CAST(sum(total_reviews) AS BIGINT) AS total_avaliacoes_bairro FROM kpis GROUP BY bairro)
  SELECT *, CASE WHEN rating_medio_bairro >= 4.0 THEN 'Excelente' WHEN rating_medio_bairro >= 3.5 THEN 'Bom'
    WHEN rating_medio_bairro >= 3.0 THEN 'Regular' ELSE 'Crítico' END AS status_bairro
  FROM b
"""))
def _(spark, sf_dir):
    return an.bairro_status(kpis(spark, sf_dir))


@query("sentiment_timeline", on_silver(f"""
  SELECT strftime(date_trunc('month', CAST(data_coleta AS DATE)), '%Y-%m-%d') AS mes, sentimento,
    count(*) AS total_reviews, avg(rating_review) AS rating_medio, count(*) AS total_por_sentimento
  FROM silver WHERE CAST(data_coleta AS DATE) >= DATE '{DAY}' - INTERVAL 12 MONTH
  GROUP BY ALL
"""))
def _(spark, sf_dir):
    return an.sentiment_timeline(silver(spark, sf_dir), AS_OF)


@query("since_30_days", on_silver(f"""
  SELECT place_id, data_coleta, count(*) AS total FROM silver
  WHERE CAST(data_coleta AS DATE) >= DATE '2001-09-30' - INTERVAL 30 DAY GROUP BY ALL
"""))
def _(spark, sf_dir):
    recent = an.since(silver(spark, sf_dir), "data_coleta", "30 days", "2001-09-30")
    return recent.groupBy("place_id", "data_coleta").agg(F.count(F.lit(1)).alias("total"))


RISK_LEVELS_SQL = """
  SELECT place_id, nome_agencia, total_reviews_negativas AS total_ocorrencias,
    CASE WHEN total_reviews_negativas > 10 THEN 'ALTO' WHEN total_reviews_negativas > 5 THEN 'MEDIO'
      ELSE 'BAIXO' END AS nivel_risco
  FROM alerts WHERE total_reviews_negativas > 0
"""


@query("risk_levels", on_alerts(RISK_LEVELS_SQL))
def _(spark, sf_dir):
    return an.risk_levels(gold.risk_alerts(silver(spark, sf_dir), AS_OF))


@query("critical_alerts", on_alerts(f"""
  SELECT count(*) FILTER (nivel_risco = 'ALTO') AS alertas_criticos,
    count(*) FILTER (nivel_risco = 'MEDIO') AS alertas_medios,
    count(*) FILTER (nivel_risco = 'BAIXO') AS alertas_baixos
  FROM ({RISK_LEVELS_SQL})
"""))
def _(spark, sf_dir):
    return an.critical_alerts(gold.risk_alerts(silver(spark, sf_dir), AS_OF))


NPS_SCORE = pct("promotores - detratores", "total_avaliacoes")


@query("nps_score", on_nps(f"SELECT *, {NPS_SCORE} AS nps_score FROM nps"))
def _(spark, sf_dir):
    return an.nps_score(gold.nps_ranking(silver(spark, sf_dir), AS_OF))


@query("nps_overall", on_nps(f"""
  SELECT CAST(sum(total_avaliacoes) AS BIGINT) AS total_avaliacoes,
    {pct("(sum(promotores) - sum(detratores))", "sum(total_avaliacoes)")} AS nps_geral FROM nps
"""))
def _(spark, sf_dir):
    return an.nps_overall(gold.nps_ranking(silver(spark, sf_dir), AS_OF))


@query("rank_agencies", on_nps(f"""
  SELECT CAST(row_number() OVER (ORDER BY {NPS_SCORE} DESC, rating_medio DESC, place_id) AS INT) AS posicao,
    place_id, nome_agencia, {NPS_SCORE} AS nps_score, rating_medio, total_avaliacoes
  FROM nps ORDER BY posicao LIMIT 5
"""))
def _(spark, sf_dir):
    return an.rank_agencies(gold.nps_ranking(silver(spark, sf_dir), AS_OF), 5)


@query("benchmark_vs_region", on_kpis("""
  , r AS (SELECT bairro, count(*) AS agencias_no_bairro,
      CAST(sum(CAST(rating_medio AS DECIMAL(28,12))) AS DOUBLE) / count(*) AS rating_medio_bairro
      FROM kpis GROUP BY bairro)
  SELECT place_id, nome_agencia, bairro, rating_medio, rating_medio_bairro, agencias_no_bairro,
    rating_medio - rating_medio_bairro AS diferenca
  FROM kpis JOIN r USING (bairro)
"""))
def _(spark, sf_dir):
    return an.benchmark_vs_region(kpis(spark, sf_dir))


@query("drill_down", on_silver("""
  SELECT place_id, data_coleta, rating_review, texto_review, sentimento FROM silver
  WHERE place_id = 'ChIJ00000007'
"""))
def _(spark, sf_dir):
    return drill_down(silver(spark, sf_dir), "ChIJ00000007").select(
        "place_id", "data_coleta", "rating_review", "texto_review", "sentimento")


@query("dashboard_filter", on_silver("""
  SELECT bairro, sentimento, count(*) AS total FROM silver
  WHERE data_coleta >= '1998-01-01' AND data_coleta <= '1999-12-31'
    AND bairro IN ('NATION_1', 'NATION_2', 'NATION_3') AND sentimento IN ('positivo', 'negativo')
  GROUP BY ALL
"""))
def _(spark, sf_dir):
    chosen = dashboard_filter(
        silver(spark, sf_dir), "1998-01-01", "1999-12-31", ["NATION_1", "NATION_2", "NATION_3"],
        ["positivo", "negativo"])
    return chosen.groupBy("bairro", "sentimento").agg(F.count(F.lit(1)).alias("total"))


@query("dashboard_filter_landed", with_ctes(LANDED_SQL, """
  SELECT bairro_pesquisado AS bairro, data_coleta, count(*) AS total FROM landed
  WHERE place_id IS NOT NULL AND has_review AND trim(coalesce(review_text, '')) <> '' AND data_coleta <> 'ontem'
    AND left(data_coleta, 10) BETWEEN '1998-06-10' AND '1998-07-10' GROUP BY ALL
"""))
def _(spark, sf_dir):
    """Collection dates with a time: the last day counts whole."""
    rows = to_bronze(normalize_landing(landing_documents(spark, sf_dir), AS_OF), AS_OF)
    chosen = dashboard_filter(to_silver(rows, AS_OF), "1998-06-10", "1998-07-10")
    return chosen.groupBy("bairro", "data_coleta").agg(F.count(F.lit(1)).alias("total"))


# --- documented, richer tables -----------------------------------------------

TENTHS = "(" + " + ".join(
    f"{weight} * {hits_sql('texto_review', words)}" for _, weight, words in rules.RISK_CATEGORIES) + ")"
SCORED_POS = hits_sql("texto_review", rules.SCORED_POSITIVE_TERMS)
SCORED_NEG = hits_sql("texto_review", rules.SCORED_NEGATIVE_TERMS)
SCORE_TENTHS = (
    f"CASE WHEN length(trim(texto_review)) >= 3 AND {SCORED_POS} <> {SCORED_NEG} "
    f"THEN least(9, 5 + greatest({SCORED_POS}, {SCORED_NEG})) ELSE 5 END")


@query("agency_kpis_full", on_silver(f"""
  SELECT place_id, nome_agencia AS agencia_name, bairro, avg(rating_review) AS rating_medio_agencia,
    count(*) AS total_avaliacoes, count(*) FILTER (sentimento = 'positivo') AS avaliacoes_positivas,
    count(*) FILTER (sentimento = 'negativo') AS avaliacoes_negativas,
    {pct("count(*) FILTER (sentimento = 'positivo')", "count(*)")} AS percentual_positivas,
    count(*) FILTER ({TENTHS} > 0) AS riscos_reputacionais,
    {pct("(count(*) FILTER (rating_review >= 4) - count(*) FILTER (rating_review < 3))", "count(*)")} AS nps_score,
    '{AS_OF}' AS data_calculo
  FROM silver GROUP BY place_id, nome_agencia, bairro
"""))
def _(spark, sf_dir):
    return an.agency_kpis_full(silver(spark, sf_dir), AS_OF)


@query("monthly_trend", on_silver(f"""
  , m AS (SELECT strftime(CAST(data_coleta AS DATE), '%Y-%m') AS ano_mes,
      sum({SCORE_TENTHS})::DOUBLE / (count(*) * 10)::DOUBLE AS sentimento_medio_score,
      count(*) AS total_avaliacoes_mes,
      {pct("count(*) FILTER (sentimento = 'positivo')", "count(*)")} AS percentual_positivas,
      {pct("count(*) FILTER (sentimento = 'negativo')", "count(*)")} AS percentual_negativas,
      avg(rating_review) AS rating_medio_mes FROM silver GROUP BY ano_mes),
  l AS (SELECT *, lag(sentimento_medio_score) OVER (ORDER BY ano_mes) AS antes FROM m)
  SELECT * EXCLUDE (antes), CASE WHEN sentimento_medio_score > antes THEN 'subindo'
    WHEN sentimento_medio_score < antes THEN 'caindo' ELSE 'estável' END AS tendencia_sentimento
  FROM l
"""))
def _(spark, sf_dir):
    return an.monthly_trend(silver(spark, sf_dir))


_WORDS = ", ".join(
    f"({sql_text(name)}, {weight}, {sql_text(word)})"
    for name, weight, words in rules.RISK_CATEGORIES for word in words)


@query("risk_alerts_full", on_silver(f"""
  , words(tipo_risco, peso, palavra) AS (VALUES {_WORDS}),
  hits AS (SELECT place_id, nome_agencia, data_review, l_orderkey, l_linenumber, rating_review,
      row_number() OVER () AS rid, texto_review FROM silver),
  m AS (SELECT h.*, w.* FROM hits h JOIN words w ON contains(lower(h.texto_review), w.palavra)),
  g AS (SELECT place_id, nome_agencia, tipo_risco, count(DISTINCT rid) AS total_ocorrencias,
      max(data_review) AS ultima, string_agg(DISTINCT palavra, ',' ORDER BY palavra) AS palavras_chave,
      sum(peso) AS decimos FROM m GROUP BY ALL)
  SELECT place_id, nome_agencia AS agencia_name, tipo_risco,
    CASE WHEN decimos >= 20 THEN 'ALTO' WHEN decimos >= 10 THEN 'MEDIO' ELSE 'BAIXO' END AS nivel_criticidade,
    total_ocorrencias, strftime(to_timestamp(ultima) AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS ultima_ocorrencia,
    palavras_chave, decimos >= 20 AS requer_acao_imediata
  FROM g
"""))
def _(spark, sf_dir):
    return an.risk_alerts_full(silver(spark, sf_dir))


_CATS = {name: hits_sql("texto_review", words) for name, _, words in rules.RISK_CATEGORIES}
_CAT_COUNTS = ", ".join(f"count(*) FILTER ({h} > 0) AS c_{n}" for n, h in _CATS.items())
_CAT_ROWS = " UNION ALL ".join(
    f"SELECT place_id, nome_agencia, bairro, data_referencia, '{n}' AS c, c_{n} AS k FROM d WHERE c_{n} > 0"
    for n in _CATS)


@query("agency_kpis_daily", on_silver(f"""
  , d AS (SELECT place_id, nome_agencia, bairro, data_coleta AS data_referencia,
      max(total_avaliacoes) AS total_avaliacoes, count(*) AS avaliacoes_periodo,
      avg(rating_review) AS rating_medio,
      {pct("count(*) FILTER (sentimento = 'positivo')", "count(*)")} AS sentimento_positivo_pct,
      {pct("count(*) FILTER (sentimento = 'negativo')", "count(*)")} AS sentimento_negativo_pct,
      {pct("count(*) FILTER (sentimento = 'neutro')", "count(*)")} AS sentimento_neutro_pct,
      count(*) FILTER ({TENTHS} >= 20) AS avaliacoes_risco_alto, {_CAT_COUNTS}
    FROM silver GROUP BY place_id, nome_agencia, bairro, data_coleta),
  u AS (SELECT *, row_number() OVER (PARTITION BY place_id, nome_agencia, bairro, data_referencia
      ORDER BY k DESC, c) AS rn FROM ({_CAT_ROWS})),
  p AS (SELECT place_id, nome_agencia, bairro, data_referencia, string_agg(c, ',' ORDER BY rn) AS principais
    FROM u WHERE rn <= 3 GROUP BY ALL)
  SELECT d.* EXCLUDE ({", ".join("c_" + n for n in _CATS)}), coalesce(p.principais, '') AS principais_problemas
  FROM d LEFT JOIN p USING (place_id, nome_agencia, bairro, data_referencia)
"""))
def _(spark, sf_dir):
    return an.agency_kpis_daily(silver(spark, sf_dir))


@query("sentiment_trend", on_silver(f"""
  , d AS (SELECT bairro, CAST(data_coleta AS DATE) AS dia, sentimento, count(*) AS total_avaliacoes,
      avg(rating_review) AS rating_medio,
      sum({SCORE_TENTHS})::DOUBLE / (count(*) * 10)::DOUBLE AS score_sentimento_medio
    FROM silver GROUP BY ALL),
  w AS (SELECT *, sum(total_avaliacoes) OVER w7 AS s7, count(total_avaliacoes) OVER w7 AS n7,
      sum(total_avaliacoes) OVER w30 AS s30, count(total_avaliacoes) OVER w30 AS n30
    FROM d WINDOW w7 AS (PARTITION BY bairro, sentimento ORDER BY dia RANGE BETWEEN INTERVAL 7 DAY PRECEDING
        AND INTERVAL 1 DAY PRECEDING),
      w30 AS (PARTITION BY bairro, sentimento ORDER BY dia RANGE BETWEEN INTERVAL 30 DAY PRECEDING
        AND INTERVAL 1 DAY PRECEDING))
  SELECT bairro, strftime(dia, '%Y-%m-%d') AS data_referencia, sentimento, total_avaliacoes, rating_medio,
    score_sentimento_medio, total_avaliacoes::DOUBLE - s7::DOUBLE / nullif(n7, 0)::DOUBLE AS variacao_7d,
    total_avaliacoes::DOUBLE - s30::DOUBLE / nullif(n30, 0)::DOUBLE AS variacao_30d
  FROM w
"""))
def _(spark, sf_dir):
    return an.sentiment_trend(silver(spark, sf_dir))


RUN_LOG_SQL = """
  run_log AS (SELECT event_type AS task, CASE WHEN event_id % 9 = 0 THEN 'failed' ELSE 'success' END AS status,
    ts AS started, value * 60 AS seconds, 100 - user_id % 7 AS valid_rows, 100 AS total_rows FROM events)
"""


@query("sla_metrics", with_ctes(RUN_LOG_SQL, f"""
  , g AS (SELECT task, count(*) AS execucoes, count(*) FILTER (status <> 'success') AS falhas,
      {pct("count(*) FILTER (status = 'success')", "count(*)")} AS taxa_sucesso,
      CAST(sum(CAST(seconds AS DECIMAL(25,6))) AS DOUBLE) / count(*) AS latencia_media_s,
      sum(valid_rows)::DOUBLE / sum(total_rows)::DOUBLE AS qualidade
    FROM run_log WHERE started >= TIMESTAMP '2024-01-20 00:00:00' - INTERVAL 15 DAY GROUP BY task)
  SELECT *, falhas > 3 AS alerta_falhas, qualidade < 0.95 AS alerta_qualidade,
    latencia_media_s > 2700 AS alerta_latencia
  FROM g
"""))
def _(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    log = e.select(
        F.col("event_type").alias("task"),
        F.when(F.col("event_id") % 9 == 0, F.lit("failed")).otherwise(F.lit("success")).alias("status"),
        F.col("ts").cast("timestamp").alias("started"), (F.col("value") * 60).alias("seconds"),
        (100 - F.col("user_id") % 7).alias("valid_rows"), F.lit(100).alias("total_rows"))
    return an.sla_metrics(log, "2024-01-20 00:00:00", days=15)


# --- windows, paging, sets ---------------------------------------------------

@query("nav_functions", with_ctes("""
  e AS (SELECT event_id, event_type, ts, CASE WHEN event_id % 3 <> 0 THEN value END AS v FROM events)
""", """
  SELECT event_id, event_type, first_value(v IGNORE NULLS) OVER a AS first_value,
    last_value(v IGNORE NULLS) OVER a AS last_value,
    nth_value(v, 2 IGNORE NULLS) OVER a AS nth_value,
    lead(v IGNORE NULLS) OVER o AS lead_value, lag(v IGNORE NULLS) OVER o AS lag_value
  FROM e WINDOW o AS (PARTITION BY event_type ORDER BY ts, event_id),
    a AS (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
"""))
def _(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(
        "event_id", "event_type", "ts",
        F.when(F.col("event_id") % 3 != 0, F.col("value")).alias("v"))
    return an.nav_functions(
        e, ["event_type"], ["ts", "event_id"], "v").drop("ts", "v")


@query("page_far", """
  SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem ORDER BY l_orderkey, l_linenumber LIMIT 40
  OFFSET (SELECT count(*) * 9 // 10 FROM lineitem)
""")
def _(spark, sf_dir):
    """A page far from the start of rows stored for paging."""
    rows, path = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity"), scratch_path(spark, "pages")
    an.write_pages(rows, ["l_orderkey", "l_linenumber"], path)
    return an.read_page(spark, path, rows.count() * 9 // 10, 40)


@query("dedup_first", """
  WITH r AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, text) AS rn FROM conversations)
  SELECT conv_id, turn, role, text FROM r WHERE rn = 1
""")
def _(spark, sf_dir):
    return an.dedup_first(table(spark, sf_dir, "conversations"), "conv_id", ["turn", "text"])


@query("ordered_top_branches", on_silver("""
  SELECT place_id, count(*) AS total FROM silver GROUP BY place_id ORDER BY total DESC, place_id
"""))
def _(spark, sf_dir):
    counts = silver(spark, sf_dir).groupBy("place_id").agg(F.count(F.lit(1)).alias("total"))
    return an.ordered(counts, [F.desc("total"), "place_id"])


@query("sample_rows", on_silver("""
  SELECT nome_agencia, bairro, rating_review, sentimento, tem_pii FROM silver
  ORDER BY md5(concat_ws(chr(31), nome_agencia, bairro, CAST(rating_review AS VARCHAR), sentimento,
    CAST(tem_pii AS VARCHAR))) LIMIT 5
"""))
def _(spark, sf_dir):
    return an.sample_rows(
        silver(spark, sf_dir).select("nome_agencia", "bairro", "rating_review", "sentimento", "tem_pii"), 5)


@query("sample_rows_known", "SELECT CAST(5 AS BIGINT) AS linhas, CAST(5 AS BIGINT) AS conhecidas")
def _(spark, sf_dir):
    columns = ["nome_agencia", "bairro", "rating_review", "sentimento", "tem_pii"]
    rows = silver(spark, sf_dir).select(*columns)
    known = an.known_rows(checkpointed(an.sample_rows(rows, 5)), rows)
    return known.agg(F.count(F.lit(1)).alias("linhas"), F.count("_known").alias("conhecidas"))


@query("page", """
  SELECT conv_id, turn, role, text FROM conversations ORDER BY conv_id, turn, role, text LIMIT 50 OFFSET 100
""")
def _(spark, sf_dir):
    return an.page(table(spark, sf_dir, "conversations"), ["conv_id", "turn", "role", "text"], 100, 50)


@query("distinct_keys", on_silver("SELECT DISTINCT place_id FROM silver"))
def _(spark, sf_dir):
    return an.distinct_keys(silver(spark, sf_dir), "place_id")


@query("json_extract", """
  SELECT event_type, json_extract_string(props, '$.k') AS k, count(*) AS total FROM events GROUP BY ALL
""")
def _(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_type", json_extract(F.col("props"), "$.k").alias("k")
    ).groupBy("event_type", "k").agg(F.count(F.lit(1)).alias("total"))


@query("try_cast", """
  SELECT TRY_CAST(json_extract_string(props, '$.k') AS INT) AS k_int,
    TRY_CAST(event_type AS INT) AS tipo_int, count(*) AS total FROM events GROUP BY ALL
""")
def _(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        json_extract(F.col("props"), "$.k").try_cast("int").alias("k_int"),
        F.col("event_type").try_cast("int").alias("tipo_int"),
    ).groupBy("k_int", "tipo_int").agg(F.count(F.lit(1)).alias("total"))


@query("run_sql_parameters", """
  SELECT user_id, count(*) AS total FROM events WHERE event_type = 'click' AND value > 5.0 GROUP BY user_id
""")
def _(spark, sf_dir):
    return run_sql(
        spark,
        "SELECT user_id, count(*) AS total FROM parquet.`%s` "
        "WHERE event_type = :tipo AND value > :minimo GROUP BY user_id" % f"{sf_dir}/events.parquet",
        {"tipo": "click", "minimo": 5.0})
