"""Gold tables and the statistics computed straight from Bronze and Silver."""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewlake.operators import gold
from reviewlake.queries import query
from reviewlake.queries.fixtures import AS_OF, STAMP, on_silver, silver

KPIS_SQL = f"""
  SELECT place_id, nome_agencia, bairro, count(*) AS total_reviews, avg(rating_review) AS rating_medio,
    count(*) FILTER (sentimento = 'positivo') AS reviews_positivos,
    count(*) FILTER (sentimento = 'negativo') AS reviews_negativos,
    count(*) FILTER (sentimento = 'neutro') AS reviews_neutros,
    count(*) FILTER (tem_pii) AS reviews_com_pii, {STAMP}
  FROM silver GROUP BY place_id, nome_agencia, bairro
"""
ALERTS_SQL = f"""
  SELECT place_id, nome_agencia, count(*) AS total_reviews_negativas, {STAMP}
  FROM silver WHERE sentimento = 'negativo' GROUP BY place_id, nome_agencia
"""
NPS_SQL = f"""
  SELECT place_id, nome_agencia, count(*) AS total_avaliacoes,
    count(*) FILTER (rating_review >= 4) AS promotores,
    count(*) FILTER (rating_review IS NULL OR rating_review < 3) AS detratores,
    avg(rating_review) AS rating_medio, {STAMP}
  FROM silver GROUP BY place_id, nome_agencia
"""


@query("agency_performance_kpis", on_silver(KPIS_SQL))
def _(spark, sf_dir):
    return gold.agency_performance_kpis(silver(spark, sf_dir), AS_OF)


def written(name):
    """A Gold table as the flow stores it, read back."""
    def build(spark, sf_dir):
        from reviewlake.plans.medallion import silver_to_gold
        from reviewlake.session import scratch_path
        from reviewlake.sources import layers

        root = scratch_path(spark, "lake")
        layers.write_layer(silver(spark, sf_dir), root, "silver")
        silver_to_gold(spark, root, AS_OF)
        return layers.read_layer(spark, root, name)

    return build


query("written_agency_performance_kpis", on_silver(KPIS_SQL))(written("agency_performance_kpis"))
query("written_risk_alerts", on_silver(ALERTS_SQL))(written("risk_alerts"))


@query("temporal_sentiment_analysis", on_silver(f"""
  SELECT bairro, CAST(month(CAST(data_coleta AS DATE)) AS INT) AS mes, count(*) AS total_reviews,
    count(*) FILTER (sentimento = 'positivo') AS positivos,
    count(*) FILTER (sentimento = 'negativo') AS negativos, {STAMP}
  FROM silver GROUP BY ALL
"""))
def _(spark, sf_dir):
    return gold.temporal_sentiment_analysis(silver(spark, sf_dir), AS_OF)


@query("risk_alerts", on_silver(ALERTS_SQL))
def _(spark, sf_dir):
    return gold.risk_alerts(silver(spark, sf_dir), AS_OF)


@query("risk_alerts_sentinel", on_silver(f"""
  SELECT coalesce(min(place_id), 'sem_alertas') AS place_id, coalesce(min(nome_agencia), 'Nenhum alerta')
    AS nome_agencia, count(*) AS total_reviews_negativas, {STAMP}
  FROM silver WHERE sentimento = 'negativo' AND sentimento <> 'negativo'
"""))
def _(spark, sf_dir):
    # Emptied rather than filtered, as in labelled_counts; without a label a review raises no alert.
    calm = silver(spark, sf_dir).withColumn("sentimento", F.nullif("sentimento", F.lit("negativo")))
    return gold.risk_alerts(calm, AS_OF)


@query("executive_dashboard", on_silver(f"""
  SELECT count(*) AS total_reviews, count(*) FILTER (sentimento = 'positivo') AS reviews_positivos,
    count(*) FILTER (sentimento = 'negativo') AS reviews_negativos,
    count(DISTINCT place_id) AS total_agencias, {STAMP}
  FROM silver
"""))
def _(spark, sf_dir):
    return gold.executive_dashboard(silver(spark, sf_dir), AS_OF)


@query("nps_ranking", on_silver(NPS_SQL))
def _(spark, sf_dir):
    return gold.nps_ranking(silver(spark, sf_dir), AS_OF)


@query("nps_ranking_rated_only", on_silver(f"""
  SELECT place_id, nome_agencia, count(*) AS total_avaliacoes,
    count(*) FILTER (rating_review >= 4) AS promotores,
    count(*) FILTER (rating_review < 3) AS detratores, avg(rating_review) AS rating_medio, {STAMP}
  FROM silver WHERE rating_review <> 0 GROUP BY place_id, nome_agencia
"""))
def _(spark, sf_dir):
    return gold.nps_ranking(silver(spark, sf_dir), AS_OF, zero_is_missing=True)


@query("business_metrics_summary", on_silver(f"""
  SELECT bairro, count(*) AS total_reviews, avg(rating_review) AS rating_medio,
    count(*) FILTER (sentimento = 'positivo') AS reviews_positivos, {STAMP}
  FROM silver GROUP BY bairro
"""))
def _(spark, sf_dir):
    return gold.business_metrics_summary(silver(spark, sf_dir), AS_OF)


@query("silver_rollup", on_silver("""
  SELECT place_id, nome_agencia, bairro, CAST(month(CAST(data_coleta AS DATE)) AS INT) AS mes,
    sentimento, tem_pii, rating_review, count(*) AS n_reviews
  FROM silver GROUP BY ALL
"""))
def _(spark, sf_dir):
    return gold.silver_rollup(silver(spark, sf_dir))


@query("agency_performance_kpis_from_rollup", on_silver(KPIS_SQL))
def _(spark, sf_dir):
    return gold.agency_performance_kpis(gold.silver_rollup(silver(spark, sf_dir)), AS_OF)


@query("nps_ranking_from_rollup", on_silver(NPS_SQL))
def _(spark, sf_dir):
    return gold.nps_ranking(gold.silver_rollup(silver(spark, sf_dir)), AS_OF)
