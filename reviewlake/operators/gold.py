"""The six Gold tables.

Each function takes Silver, or a ``silver_rollup`` of it: a rollup row stands
for ``n_reviews`` reviews, so one pass over Silver can feed every table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlake.functions.dates import as_of_timestamp, to_date_or_null
from reviewlake.functions.numeric import ratio

ROLLUP_KEYS = (
    "place_id", "nome_agencia", "bairro", "mes", "sentimento", "tem_pii", "rating_review",
)


def _month(df: DataFrame) -> Column:
    return F.col("mes") if "mes" in df.columns else F.month(to_date_or_null(F.col("data_coleta")))


def _is_rollup(df: DataFrame) -> bool:
    return "n_reviews" in df.columns


def _rows(df: DataFrame, condition: Column | None = None) -> Column:
    """How many reviews satisfy the condition."""
    if not _is_rollup(df):
        return F.count(F.lit(1)) if condition is None else F.count_if(condition)
    weight = F.col("n_reviews")
    if condition is not None:
        weight = F.when(condition, weight).otherwise(F.lit(0))
    return F.sum(weight)


def _mean_rating(df: DataFrame) -> Column:
    rating = F.col("rating_review")
    if not _is_rollup(df):
        return F.avg(rating)
    return ratio(F.sum(rating * F.col("n_reviews")),
                 F.sum(F.when(rating.isNotNull(), F.col("n_reviews"))))


def _sentiment(label: str) -> Column:
    return F.col("sentimento") == label


def silver_rollup(silver: DataFrame, more=()) -> DataFrame:
    """Review counts by everything the Gold tables group or count on, and by ``more``."""
    return (
        silver.withColumn("mes", _month(silver))
        .groupBy(*ROLLUP_KEYS, *more).agg(F.count(F.lit(1)).alias("n_reviews"))
    )


def merged_rollup(rollups: DataFrame) -> DataFrame:
    """One roll-up from those of several days: counts add up."""
    return rollups.groupBy(*ROLLUP_KEYS).agg(F.sum("n_reviews").alias("n_reviews"))


def agency_performance_kpis(silver: DataFrame, as_of: str | None = None) -> DataFrame:
    return silver.groupBy("place_id", "nome_agencia", "bairro").agg(
        _rows(silver).alias("total_reviews"),
        _mean_rating(silver).alias("rating_medio"),
        _rows(silver, _sentiment("positivo")).alias("reviews_positivos"),
        _rows(silver, _sentiment("negativo")).alias("reviews_negativos"),
        _rows(silver, _sentiment("neutro")).alias("reviews_neutros"),
        _rows(silver, F.col("tem_pii")).alias("reviews_com_pii"),
    ).withColumn("gold_timestamp", as_of_timestamp(as_of))


def temporal_sentiment_analysis(silver: DataFrame, as_of: str | None = None) -> DataFrame:
    """Per month of the year: the same month of different years is one group."""
    return silver.withColumn("mes", _month(silver)).groupBy("bairro", "mes").agg(
        _rows(silver).alias("total_reviews"),
        _rows(silver, _sentiment("positivo")).alias("positivos"),
        _rows(silver, _sentiment("negativo")).alias("negativos"),
    ).withColumn("gold_timestamp", as_of_timestamp(as_of))


def risk_alerts(silver: DataFrame, as_of: str | None = None) -> DataFrame:
    """Negative reviews per branch; one sentinel row when there are none.

    Negatives are counted rather than filtered: a filter on a computed label
    would be pushed down and evaluate the label twice. The sentinel reads the
    same shuffled counts as the alerts, so nothing is computed a second time.
    """
    negatives = F.col("total_reviews_negativas")
    alerts = silver.groupBy("place_id", "nome_agencia").agg(
        _rows(silver, _sentiment("negativo")).alias("total_reviews_negativas")
    ).filter(negatives > 0)
    sentinel = alerts.agg(F.count(F.lit(1)).alias("_found")).filter(F.col("_found") == 0).select(
        F.lit("sem_alertas").alias("place_id"), F.lit("Nenhum alerta").alias("nome_agencia"),
        F.lit(0).cast("bigint").alias("total_reviews_negativas"),
    )
    return alerts.unionByName(sentinel).withColumn("gold_timestamp", as_of_timestamp(as_of))


def executive_dashboard(silver: DataFrame, as_of: str | None = None) -> DataFrame:
    """One row; branches are pre-aggregated, so nothing is counted twice or scanned twice."""
    branches = silver.groupBy("place_id").agg(
        _rows(silver).alias("n"),
        _rows(silver, _sentiment("positivo")).alias("pos"),
        _rows(silver, _sentiment("negativo")).alias("neg"),
    )
    zero = F.lit(0).cast("bigint")
    return branches.agg(
        F.coalesce(F.sum("n"), zero).alias("total_reviews"),
        F.coalesce(F.sum("pos"), zero).alias("reviews_positivos"),
        F.coalesce(F.sum("neg"), zero).alias("reviews_negativos"),
        F.count(F.lit(1)).alias("total_agencias"),
    ).withColumn("gold_timestamp", as_of_timestamp(as_of))


def nps_category(rating: Column, zero_is_missing: bool = False) -> Column:
    """Promotor from 4, Neutro from 3, else Detrator, which takes in 0 and NULL.

    ``zero_is_missing`` leaves unrated reviews out of all three groups.
    """
    label = (
        F.when(rating >= 4, F.lit("Promotor")).when(rating >= 3, F.lit("Neutro"))
        .otherwise(F.lit("Detrator"))
    )
    return F.when(F.coalesce(rating, F.lit(0)) != 0, label) if zero_is_missing else label


def nps_ranking(silver: DataFrame, as_of: str | None = None,
                zero_is_missing: bool = False) -> DataFrame:
    rated = silver
    if zero_is_missing:
        rated = silver.filter(F.coalesce(F.col("rating_review"), F.lit(0)) != 0)
    category = nps_category(F.col("rating_review"))
    return rated.groupBy("place_id", "nome_agencia").agg(
        _rows(silver).alias("total_avaliacoes"),
        _rows(silver, category == "Promotor").alias("promotores"),
        _rows(silver, category == "Detrator").alias("detratores"),
        _mean_rating(silver).alias("rating_medio"),
    ).withColumn("gold_timestamp", as_of_timestamp(as_of))


def business_metrics_summary(silver: DataFrame, as_of: str | None = None) -> DataFrame:
    return silver.groupBy("bairro").agg(
        _rows(silver).alias("total_reviews"),
        _mean_rating(silver).alias("rating_medio"),
        _rows(silver, _sentiment("positivo")).alias("reviews_positivos"),
    ).withColumn("gold_timestamp", as_of_timestamp(as_of))


GOLD_TABLES = {
    "agency_performance_kpis": agency_performance_kpis,
    "temporal_sentiment_analysis": temporal_sentiment_analysis,
    "risk_alerts": risk_alerts,
    "executive_dashboard": executive_dashboard,
    "nps_ranking": nps_ranking,
    "business_metrics_summary": business_metrics_summary,
}
