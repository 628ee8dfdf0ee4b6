"""Landing -> Bronze -> Silver -> alerts as streams, on the batch functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake import schemas
from reviewlake.operators.bronze import normalize_landing, review_id, to_bronze
from reviewlake.operators.silver import to_silver
from reviewlake.sources.landing import whole_documents

TOPICS = {
    "reviews": "google-maps-data",
    "sentiment": "sentiment-analysis",
    "alerts": "quality-alerts",
}


def landing_stream(spark: SparkSession, path: str, multiline: bool = True,
                   max_files: int | None = None) -> DataFrame:
    """Landed documents as they arrive; ``multiline`` as for ``read_landing``."""
    reader = spark.readStream.option("recursiveFileLookup", "true")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if multiline:
        return whole_documents(reader.text(path, wholetext=True), schemas.LANDING)
    return reader.schema(schemas.LANDING).json(path)


def stream_reviews(landing: DataFrame, as_of: str | None = None, key: str = "hash") -> DataFrame:
    return to_bronze(normalize_landing(landing, as_of), as_of, key)


def drop_replays(bronze: DataFrame, delay: str = "30 days") -> DataFrame:
    """Drop reviews that are delivered again within ``delay`` of their first arrival.

    An addition for at-least-once inputs; identity is the sha-256 review key, as
    the 32-bit one would drop distinct reviews. The watermark is on arrival, which
    only moves forward: no review is late, however old it says it is, and the
    state holds the keys of one ``delay``.
    """
    keyed = review_id(bronze, "sha256").withColumn("_arrival", F.current_timestamp())
    return (
        keyed.withWatermark("_arrival", delay)
        .dropDuplicatesWithinWatermark(["bronze_review_id"]).drop("_arrival")
    )


def stream_sentiment(bronze: DataFrame, as_of: str | None = None, **options) -> DataFrame:
    return to_silver(bronze, as_of, **options)


def quality_alerts(silver: DataFrame) -> DataFrame:
    """Rows that call for attention, with the reasons."""
    reasons = F.array_compact(F.array(
        F.when(F.col("data_quality_score") < 0.7, F.lit("qualidade_baixa")),
        F.when(F.col("tem_pii"), F.lit("pii_detectado")),
        F.when((F.col("sentimento") == "negativo") & (F.col("rating_review") <= 2),
               F.lit("avaliacao_critica")),
    ))
    return silver.select(
        "place_id", "bairro", "data_coleta", "sentimento", "data_quality_score",
        reasons.alias("motivos"),
    ).filter(F.size("motivos") > 0)


def drain(df: DataFrame, path: str, checkpoint: str, partition_by=(), fmt: str = "parquet"):
    """Process everything available into a file sink, exactly once, then stop."""
    writer = (
        df.writeStream.format(fmt).option("path", path).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    query = writer.start()
    query.awaitTermination()
    return query
