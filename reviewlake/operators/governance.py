"""Retention, audit, lineage, classification and compliance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake import schemas
from reviewlake.functions import rules
from reviewlake.functions.dates import as_of_date, as_of_timestamp, interval
from reviewlake.functions.text import pseudonymize


def retention_action(layer: str, as_of: str | None, date: Column,
                     policy: dict = rules.RETENTION) -> Column:
    """``manter`` inside the retention period, the layer's action after it.

    A row whose date is unknown is kept.
    """
    days, action = policy[layer]
    expired = F.coalesce(date < as_of_date(as_of) - interval(f"{days} days"), F.lit(False))
    return F.when(expired, F.lit(action)).otherwise(F.lit("manter"))


def apply_retention(df: DataFrame, layer: str, as_of: str | None, date: Column,
                    salt: str | None = None, policy: dict = rules.RETENTION,
                    by: tuple = (), measures: tuple = ()) -> tuple[DataFrame, DataFrame]:
    """``(kept, expired)``. Nothing is deleted; what to do with ``expired`` is the caller's.

    Expired Silver rows come out with pseudonymous authors and masked text only; of
    expired Gold rows only aggregates remain: per year and ``by``, their number and
    the sums of ``measures``.
    """
    marked = df.withColumn("_acao", retention_action(layer, as_of, date, policy))
    kept = marked.filter("_acao = 'manter'").drop("_acao")
    expired = marked.filter("_acao <> 'manter'").drop("_acao")
    if policy[layer][1] == "anonimizar":
        if not salt:
            raise ValueError("anonymising expired rows needs a salt")
        expired = expired.withColumns({
            "review_autor": pseudonymize(F.col("review_autor"), salt),
            "texto_review": F.col("texto_anonimizado"),
        })
    if policy[layer][1] == "agregados":
        expired = expired.withColumn("ano", F.year(date)).groupBy("ano", *by).agg(
            F.count(F.lit(1)).alias("registros"), *[F.sum(m).alias(m) for m in measures])
    return kept, expired


def retention_summary(df: DataFrame, layer: str, as_of: str | None, date: Column) -> DataFrame:
    return df.groupBy(retention_action(layer, as_of, date).alias("acao")).agg(
        F.count(F.lit(1)).alias("total")
    )


def audit_row(spark: SparkSession, operation: str, table: str, metrics: dict,
              as_of: str | None = None, user: str = "system_automated") -> DataFrame:
    """One audit record; ``metrics`` come from an ``Observation`` on the write."""
    pii = int(metrics.get("pii_detected") or 0)
    values = (operation, table, int(metrics.get("records_affected") or 0), pii, pii > 0, user,
              "compliant")
    names = schemas.AUDIT.fieldNames()[1:]
    return spark.createDataFrame([values], schemas.AUDIT[1:]).select(
        as_of_timestamp(as_of).alias("timestamp"), *names)


def audit_summary(silver: DataFrame, operation: str, table: str, as_of: str | None) -> DataFrame:
    """The audit record computed from the data itself."""
    return silver.agg(
        F.count(F.lit(1)).alias("records_affected"),
        F.count_if(F.col("tem_pii")).alias("pii_detected"),
    ).select(
        as_of_timestamp(as_of).alias("timestamp"), F.lit(operation).alias("operation"),
        F.lit(table).alias("table_name"), "records_affected", "pii_detected",
        (F.col("pii_detected") > 0).alias("anonymization_applied"),
        F.lit("system_automated").alias("user"), F.lit("compliant").alias("compliance_status"),
    )


def lineage_row(spark: SparkSession, source: str, target: str, kind: str,
                as_of: str | None = None) -> DataFrame:
    """One lineage record, its id derived from what it says so that re-runs agree."""
    stamp = as_of_timestamp(as_of)
    return spark.range(1).select(
        F.sha2(F.concat_ws("|", F.lit(source), F.lit(target), F.lit(kind), stamp.cast("string")), 256)
        .alias("lineage_id"),
        F.lit(source).alias("source_table"), F.lit(target).alias("target_table"),
        F.lit(kind).alias("transformation_type"), stamp.alias("processing_date"),
        F.lit(True).alias("data_classification_maintained"),
        F.lit(True).alias("privacy_controls_applied"),
    )


def compliance_report(silver: DataFrame, as_of: str | None) -> DataFrame:
    now = as_of_timestamp(as_of)
    leaked = F.col("tem_pii") & (F.col("texto_anonimizado") == F.col("texto_review"))
    return silver.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(F.col("tem_pii")).alias("pii_records"),
        F.count_if(F.col("tem_pii") & ~leaked).alias("pii_records_anonymized"),
    ).select(
        F.date_format(now, "yyyy-MM").alias("period"), "total_records", "pii_records_anonymized",
        F.when(F.col("pii_records") == F.col("pii_records_anonymized"), F.lit("COMPLIANT"))
        .otherwise(F.lit("NON_COMPLIANT")).alias("compliance_status"),
        (now + interval("90 days")).alias("next_review_date"),
    )


def classify(df: DataFrame, table=rules.CLASSIFICATION) -> DataFrame:
    """Every column of a frame with its class, sensitivity and treatment."""
    known = {c: rest for c, *rest in table}
    rows = [(c, t, *known.get(c, ("Não classificado", None, None))) for c, t in df.dtypes]
    return df.sparkSession.createDataFrame(
        rows, "coluna string, tipo string, classe string, sensibilidade string, tratamento string")


def tag_columns(df: DataFrame, table=rules.CLASSIFICATION) -> DataFrame:
    """The same frame with the classification in its column metadata."""
    known = {c: {"classe": k, "sensibilidade": s, "tratamento": t} for c, k, s, t in table}
    for name in df.columns:
        if name in known:
            df = df.withMetadata(name, known[name])
    return df
