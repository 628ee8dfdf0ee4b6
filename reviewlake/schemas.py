"""Explicit schemas of every layer. Nothing is inferred from the data."""

from __future__ import annotations

from pyspark.sql import types as T

STRING, INT, BIGINT, DOUBLE = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()
BOOLEAN, TIMESTAMP, DATE = T.BooleanType(), T.TimestampType(), T.DateType()
STRINGS = T.ArrayType(STRING)


def _columns(**types: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, t) for name, t in types.items()])


REVIEW = _columns(
    author_name=STRING, rating=INT, text=STRING, time=BIGINT, relative_time_description=STRING,
)
REVIEW_4_TYPE = "array<struct<author_name:string,rating:int,text:string,time:bigint>>"

BRANCH = _columns(
    place_id=STRING, name=STRING, formatted_address=STRING, vicinity=STRING, rating=DOUBLE,
    user_ratings_total=INT, business_status=STRING, types=STRINGS,
    geometry=_columns(location=_columns(lat=DOUBLE, lng=DOUBLE)),
    reviews=T.ArrayType(REVIEW),
)

ENVELOPE = _columns(
    execution_metadata=_columns(
        run_id=STRING, execution_date=STRING, bairro=STRING,
        partition_info=_columns(year=INT, month=INT, day=INT),
        data_quality=_columns(total_agencias=INT, total_reviews=INT, completeness_score=DOUBLE),
        processing_info=_columns(
            timestamp_inicio=STRING, tempo_execucao_segundos=DOUBLE, quota_utilizada=INT),
    ),
    raw_data=_columns(agencias=T.ArrayType(BRANCH)),
    schema_version=STRING, created_at=STRING,
)
PARTITIONED_ENVELOPE = T.StructType(
    ENVELOPE.fields + _columns(year=INT, month=INT, day=INT, bairro=STRING).fields)
SIMPLE = T.StructType(
    BRANCH.fields + _columns(bairro=STRING, bairro_pesquisado=STRING, data_coleta=STRING).fields)
# One schema that reads both layouts, so that a folder may mix them.
LANDING = T.StructType(ENVELOPE.fields + SIMPLE.fields)

BRONZE = _columns(
    place_id=STRING, agencia_name=STRING, endereco_completo=STRING, latitude=DOUBLE,
    longitude=DOUBLE, agencia_rating=DOUBLE, total_avaliacoes=INT, bairro_pesquisado=STRING,
    data_coleta=STRING, data_coleta_timestamp=TIMESTAMP, bronze_ingestion_timestamp=TIMESTAMP,
    bronze_ingestion_date=DATE, data_quality_score=DOUBLE, source_system=STRING,
    author_name=STRING, review_rating=INT, review_text=STRING, review_time=BIGINT,
    bronze_review_id=STRING, partition_year=INT, partition_month=INT, partition_day=INT,
)

SILVER = _columns(
    place_id=STRING, nome_agencia=STRING, endereco_completo=STRING, latitude=DOUBLE,
    longitude=DOUBLE, rating_agencia=DOUBLE, total_avaliacoes=INT, bairro=STRING,
    data_coleta=STRING, review_autor=STRING, rating_review=INT, texto_review=STRING,
    data_review=BIGINT, sentimento=STRING, tem_pii=BOOLEAN, tipos_pii_detectados=STRINGS,
    texto_anonimizado=STRING, silver_processing_timestamp=TIMESTAMP, partition_year=INT,
    partition_month=INT, partition_day=INT, data_quality_score=DOUBLE,
)

# Review counts of one ingestion day by everything the Gold tables group or count on.
ROLLUP = _columns(
    place_id=STRING, nome_agencia=STRING, bairro=STRING, mes=INT, sentimento=STRING, tem_pii=BOOLEAN,
    rating_review=INT, n_reviews=BIGINT, partition_year=INT, partition_month=INT, partition_day=INT,
)

GOLD = {
    "agency_performance_kpis": _columns(
        place_id=STRING, nome_agencia=STRING, bairro=STRING, total_reviews=BIGINT,
        rating_medio=DOUBLE, reviews_positivos=BIGINT, reviews_negativos=BIGINT,
        reviews_neutros=BIGINT, reviews_com_pii=BIGINT, gold_timestamp=TIMESTAMP,
    ),
    "temporal_sentiment_analysis": _columns(
        bairro=STRING, mes=INT, total_reviews=BIGINT, positivos=BIGINT, negativos=BIGINT,
        gold_timestamp=TIMESTAMP,
    ),
    "risk_alerts": _columns(
        place_id=STRING, nome_agencia=STRING, total_reviews_negativas=BIGINT,
        gold_timestamp=TIMESTAMP,
    ),
    "executive_dashboard": _columns(
        total_reviews=BIGINT, reviews_positivos=BIGINT, reviews_negativos=BIGINT,
        total_agencias=BIGINT, gold_timestamp=TIMESTAMP,
    ),
    "nps_ranking": _columns(
        place_id=STRING, nome_agencia=STRING, total_avaliacoes=BIGINT, promotores=BIGINT,
        detratores=BIGINT, rating_medio=DOUBLE, gold_timestamp=TIMESTAMP,
    ),
    "business_metrics_summary": _columns(
        bairro=STRING, total_reviews=BIGINT, rating_medio=DOUBLE, reviews_positivos=BIGINT,
        gold_timestamp=TIMESTAMP,
    ),
}

PROGRESS = _columns(bairro=STRING, place_id=STRING, list_pos=INT)
CONSULTED = _columns(bairro=STRING, place_id=STRING, data_ultima_consulta=TIMESTAMP)
TOTALS = _columns(total_agencias_processadas=BIGINT, total_comentarios_coletados=BIGINT)
QUEUE_MESSAGE = _columns(
    bairro=STRING, timestamp=STRING, origem=STRING,
    progresso=_columns(
        bairro_atual_index=INT, total_bairros=INT, percentual_concluido=DOUBLE,
        bairros_restantes=INT),
    tentativas=INT,
)
REJECTED_MESSAGE = _columns(
    bairro=STRING, timestamp_rejeicao=STRING, motivo=STRING, tentativas=INT,
)
RUN_LOG = _columns(
    run_id=STRING, task=STRING, status=STRING, started=TIMESTAMP, seconds=DOUBLE,
    valid_rows=BIGINT, total_rows=BIGINT,
)
AUDIT = _columns(
    timestamp=TIMESTAMP, operation=STRING, table_name=STRING, records_affected=BIGINT,
    pii_detected=BIGINT, anonymization_applied=BOOLEAN, user=STRING, compliance_status=STRING,
)
