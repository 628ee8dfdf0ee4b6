"""Review-shaped views over the given tables, for Spark and as SQL text.

One review per ``lineitem`` row, one branch per ``supplier``, one neighbourhood
per ``nation``. All of it grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake.functions import rules
from reviewlake.operators.bronze import (
    add_audit, add_partitions, fill_defaults, review_id, valid_place,
)
from reviewlake.operators.silver import to_silver
from reviewlake.schemas import BRANCH, BRONZE

AS_OF = "2001-12-31 00:00:00"
DAY = "2001-12-31"

# Review texts, fixed.
PHRASES = (
    "Excelente atendimento, funcionários muito educados",
    "Péssimo, fila enorme e muito lento",
    "Não recomendo",
    "Fiquei insatisfeito",
    "Fiquei insatisfeito e o caixa é demorado",
    "Gerente mal educado e grosso",
    "Equipe incompetente",
    "Atendente atencioso e cordial",
    "Agência normal",
    "",
    None,
    "   ",
    "Meu CPF 123.456.789-00 foi exposto",
    "Ligue (11) 99999-9999",
    "Ligue 11999999999",
    "Contato: joao@email.com",
    "CPF 12345678900, email ana@x.com.br, tel 11 98888-7777",
    "Fraude! Clonaram meu cartão, foi golpe",
    "Cobrança indevida e taxa abusiva",
    "O sistema fora do ar",
    "Vou processar o banco, falei com advogado",
    "ÓTIMO! Recomendo",
    "O bombeiro estava lá",
    "ok",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def place_of(key: str) -> Column:
    return F.concat(F.lit("ChIJ"), F.lpad(F.col(key).cast("string"), 8, "0"))


def branches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per branch with the fields of a search result, gaps included."""
    s = F.col("s_suppkey")
    joined = table(spark, sf_dir, "supplier").join(
        table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    return joined.select(
        F.col("n_name").alias("bairro"), F.col("n_nationkey").alias("position"),
        s.cast("int").alias("list_pos"),
        F.when(s % 29 != 0, place_of("s_suppkey")).alias("place_id"),
        F.col("s_name").alias("name"),
        F.when(s % 13 != 0, F.concat(F.lit("Rua "), s.cast("string"))).alias("formatted_address"),
        F.when(s % 11 == 0, F.lit(5.5)).when(s % 7 == 0, F.lit(0.0))
        .otherwise((F.lit(10) + s % 41).cast("double") / 10.0).alias("rating"),
        ((s * 7) % 500).cast("int").alias("user_ratings_total"),
        F.lit("OPERATIONAL").alias("business_status"),
        F.when(s % 17 != 0, F.array(F.lit("bank"), F.lit("finance"))).alias("types"),
        F.when(s % 19 != 0, F.struct(F.struct(
            F.when(s % 5 == 0, F.lit(0.0)).otherwise(F.lit(-23.5)).alias("lat"),
            F.lit(-46.6).alias("lng")).alias("location"))).alias("geometry"),
        F.transform(
            F.sequence(F.lit(1), (s % 13).cast("int") + 1),
            lambda i: F.struct(
                F.concat(F.lit("Autor "), i.cast("string")).alias("author_name"),
                (i % 6).cast("int").alias("rating"),
                F.get(F.array(*[F.lit(p) for p in PHRASES]), ((s + i) % 24).cast("int")).alias("text"),
                (s * 1000 + i).cast("bigint").alias("time"),
                F.lit("há um mês").alias("relative_time_description"),
            ),
        ).alias("_reviews"),
        s.alias("s_suppkey"),
    ).withColumn("reviews", F.when(F.col("s_suppkey") % 6 != 0, F.col("_reviews"))).drop("_reviews")


BRANCHES_SQL = """
branches AS (
  SELECT n_name AS bairro, n_nationkey AS position, CAST(s_suppkey AS INT) AS list_pos,
    CASE WHEN s_suppkey % 29 <> 0 THEN 'ChIJ' || lpad(CAST(s_suppkey AS VARCHAR), 8, '0') END AS place_id,
    s_name AS name,
    CASE WHEN s_suppkey % 13 <> 0 THEN 'Rua ' || CAST(s_suppkey AS VARCHAR) END AS formatted_address,
    CASE WHEN s_suppkey % 11 = 0 THEN 5.5::DOUBLE WHEN s_suppkey % 7 = 0 THEN 0.0::DOUBLE
         ELSE (10 + s_suppkey % 41)::DOUBLE / 10.0::DOUBLE END AS rating,
    CAST((s_suppkey * 7) % 500 AS INT) AS user_ratings_total,
    s_suppkey % 17 <> 0 AS has_types,
    s_suppkey % 19 <> 0 AS has_geometry,
    CASE WHEN s_suppkey % 19 = 0 THEN NULL WHEN s_suppkey % 5 = 0 THEN 0.0 ELSE -23.5 END AS lat,
    CASE WHEN s_suppkey % 19 = 0 THEN NULL ELSE -46.6 END AS lng,
    CASE WHEN s_suppkey % 6 <> 0 THEN CAST(s_suppkey % 13 + 1 AS INT) ELSE 0 END AS n_reviews,
    s_suppkey
  FROM supplier JOIN nation ON s_nationkey = n_nationkey)
"""


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flat review view; a review's author is the customer of its order."""
    s = F.col("s_suppkey")
    rows = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "supplier"), F.col("l_suppkey") == s
    ).join(
        table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    ).join(
        table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    ).join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    day = F.col("l_shipdate").cast("date")
    phrase = ((F.col("l_orderkey") * 7 + F.col("l_linenumber")) % 24).cast("int")
    return rows.select(
        place_of("s_suppkey").alias("place_id"), F.col("s_name").alias("agencia_name"),
        F.when(s % 13 != 0, F.concat(F.lit("Rua "), s.cast("string"))).alias("endereco_completo"),
        F.when(s % 50 == 0, F.lit(95.0)).otherwise(F.lit(-23.5)).alias("latitude"),
        F.when(s % 50 == 0, F.lit(-200.0)).otherwise(F.lit(-46.6)).alias("longitude"),
        F.col("n_name").alias("bairro_pesquisado"),
        ((F.lit(10) + s % 41).cast("double") / 10.0).alias("agencia_rating"),
        ((s * 7) % 500).cast("int").alias("total_avaliacoes"),
        F.col("c_name").alias("author_name"),
        (F.col("l_quantity").cast("int") % 6).alias("review_rating"),
        F.get(F.array(*[F.lit(p) for p in PHRASES]), phrase).alias("review_text"),
        phrase.alias("phrase_id"),
        F.date_format(day, "yyyy-MM-dd").alias("data_coleta"),
        (F.unix_date(day).cast("bigint") * 86400).alias("review_time"),
        "l_orderkey", "l_linenumber", s.alias("s_suppkey"),
        F.col("n_nationkey").alias("position"),
    )


def sql_text(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


_PHRASE_ROWS = ", ".join(f"({i}, {sql_text(p)})" for i, p in enumerate(PHRASES))

REVIEWS_SQL = f"""
phrases(phrase_id, review_text) AS (VALUES {_PHRASE_ROWS}),
reviews AS (
  SELECT concat('ChIJ', lpad(CAST(s.s_suppkey AS VARCHAR), 8, '0')) AS place_id,
    s.s_name AS agencia_name,
    CASE WHEN s.s_suppkey % 13 <> 0 THEN 'Rua ' || CAST(s.s_suppkey AS VARCHAR) END AS endereco_completo,
    CASE WHEN s.s_suppkey % 50 = 0 THEN 95.0 ELSE -23.5 END::DOUBLE AS latitude,
    CASE WHEN s.s_suppkey % 50 = 0 THEN -200.0 ELSE -46.6 END::DOUBLE AS longitude,
    n.n_name AS bairro_pesquisado, n.n_nationkey AS position,
    (10 + s.s_suppkey % 41)::DOUBLE / 10.0::DOUBLE AS agencia_rating,
    CAST((s.s_suppkey * 7) % 500 AS INT) AS total_avaliacoes, c.c_name AS author_name,
    CAST(l.l_quantity AS INT) % 6 AS review_rating, p.phrase_id, p.review_text,
    strftime(l.l_shipdate, '%Y-%m-%d') AS data_coleta,
    CAST(date_diff('day', DATE '1970-01-01', CAST(l.l_shipdate AS DATE)) AS BIGINT) * 86400 AS review_time,
    l.l_orderkey, l.l_linenumber, s.s_suppkey
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey
  JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN phrases p ON CAST((l.l_orderkey * 7 + l.l_linenumber) % 24 AS INT) = p.phrase_id)
"""

BRONZE_SQL = REVIEWS_SQL + f""",
bronze AS (
  SELECT place_id, agencia_name, coalesce(endereco_completo, 'Endereço não informado') AS endereco_completo,
    latitude, longitude, agencia_rating, total_avaliacoes, bairro_pesquisado, data_coleta,
    CAST(NULL AS VARCHAR) AS data_coleta_timestamp,
    TIMESTAMP '{AS_OF}' AS bronze_ingestion_timestamp, DATE '{DAY}' AS bronze_ingestion_date,
    1.0::DOUBLE AS data_quality_score, 'google_maps_api' AS source_system,
    author_name, review_rating, coalesce(review_text, '') AS review_text, review_time,
    2001 AS partition_year, 12 AS partition_month, 31 AS partition_day,
    l_orderkey, l_linenumber, s_suppkey, position, phrase_id
  FROM reviews)
"""


def hits_sql(column: str, terms) -> str:
    """How many terms the lower-cased column contains."""
    return "(" + " + ".join(
        f"CASE WHEN contains(lower({column}), {sql_text(t)}) THEN 1 ELSE 0 END" for t in terms) + ")"


def label_sql(column: str) -> str:
    pos, neg = hits_sql(column, rules.POSITIVE_TERMS), hits_sql(column, rules.NEGATIVE_TERMS)
    return (f"CASE WHEN {pos} > {neg} THEN 'positivo' WHEN {neg} > {pos} THEN 'negativo' "
            "ELSE 'neutro' END")


def flag_sql(column: str, pattern: str) -> str:
    return f"regexp_matches({column}, {sql_text(pattern)})"


def anonymized_sql(column: str) -> str:
    result = column
    for _, pattern, token in rules.PII_RULES:
        result = (f"CASE WHEN {flag_sql(column, pattern)} THEN "
                  f"regexp_replace({result}, {sql_text(pattern)}, '{token}', 'g') ELSE {result} END")
    return result


def types_sql(column: str) -> str:
    parts = ", ".join(
        f"CASE WHEN {flag_sql(column, p)} THEN '{kind}' END" for kind, p, _ in rules.PII_RULES)
    return f"concat_ws(',', {parts})"


SILVER_SQL = BRONZE_SQL + f""",
silver AS (
  SELECT place_id, agencia_name AS nome_agencia, endereco_completo, latitude, longitude,
    agencia_rating AS rating_agencia, total_avaliacoes, bairro_pesquisado AS bairro, data_coleta,
    author_name AS review_autor, review_rating AS rating_review, review_text AS texto_review,
    review_time AS data_review, {label_sql('review_text')} AS sentimento,
    {types_sql('review_text')} <> '' AS tem_pii, {types_sql('review_text')} AS tipos_pii_detectados,
    {anonymized_sql('review_text')} AS texto_anonimizado,
    TIMESTAMP '{AS_OF}' AS silver_processing_timestamp,
    2001 AS partition_year, 12 AS partition_month, 31 AS partition_day,
    CASE WHEN length(review_text) > 10 THEN 1.0::DOUBLE ELSE 0.5::DOUBLE END AS data_quality_score,
    l_orderkey, l_linenumber, s_suppkey, position, phrase_id
  FROM bronze WHERE review_text IS NOT NULL AND trim(review_text) <> '')
"""

STAMP = f"'{AS_OF}' AS gold_timestamp"


def with_ctes(ctes: str, body: str) -> str:
    return f"WITH {ctes} {body}"


def on_branches(body: str) -> str:
    return with_ctes(BRANCHES_SQL, body)


def on_reviews(body: str) -> str:
    return with_ctes(REVIEWS_SQL, body)


def on_bronze(body: str) -> str:
    return with_ctes(BRONZE_SQL, body)


def on_silver(body: str) -> str:
    return with_ctes(SILVER_SQL, body)


def bronze_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze built from the review view by the Bronze operators, keys kept alongside."""
    named = reviews(spark, sf_dir).withColumnRenamed("agencia_name", "name")
    audited = add_audit(named, AS_OF).filter(valid_place()).withColumnRenamed("name", "agencia_name")
    filled = audited.withColumn(
        "endereco_completo",
        F.coalesce("endereco_completo", F.lit(rules.DEFAULTS["formatted_address"])))
    return add_partitions(review_id(fill_defaults(filled)), "bronze_ingestion_date")


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze_rows(spark, sf_dir).select(*BRONZE.fieldNames())


def silver(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return to_silver(bronze(spark, sf_dir), AS_OF, **options)


def landing_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelope documents over all reviews: one per branch, day and order slice.

    Branches inside a document are the reviews of one order line each; slicing by
    order keeps every document small, whatever the skew.
    """
    r = reviews(spark, sf_dir)
    review = F.struct(
        F.when(F.col("l_linenumber") % 5 != 0, F.col("author_name")).alias("author_name"),
        F.when(F.col("l_linenumber") % 6 != 0, F.col("review_rating")).alias("rating"),
        F.col("review_text").alias("text"), F.col("review_time").alias("time"),
        F.lit("há um mês").alias("relative_time_description"),
    )
    values = {
        "place_id": F.when(F.col("s_suppkey") % 29 != 0, F.col("place_id")),
        "name": F.col("agencia_name"), "formatted_address": F.col("endereco_completo"),
        "rating": F.when(F.col("s_suppkey") % 7 != 0, F.col("agencia_rating")),
        "user_ratings_total": F.col("total_avaliacoes"),
        "geometry": F.when(F.col("s_suppkey") % 19 != 0, F.struct(F.struct(
            F.col("latitude").alias("lat"), F.col("longitude").alias("lng")).alias("location"))),
        "reviews": F.when(F.col("l_linenumber") != 4, F.array(review)),
    }
    branch = F.struct(*[
        values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in BRANCH.fields])
    stamp = F.when(
        F.col("l_linenumber") % 3 == 0, F.lit("ontem")
    ).otherwise(F.concat("data_coleta", F.lit("T10:20:30.123456")))
    return r.select(
        F.struct(
            F.concat_ws("_", "l_orderkey", "l_linenumber").alias("run_id"),
            stamp.alias("execution_date"), F.col("bairro_pesquisado").alias("bairro"),
        ).alias("execution_metadata"),
        F.struct(F.array(branch).alias("agencias")).alias("raw_data"),
        F.lit("v1.0").alias("schema_version"), stamp.alias("created_at"),
    )


LANDED_SQL = REVIEWS_SQL + """,
landed AS (
  SELECT CASE WHEN l_linenumber % 3 = 0 THEN 'ontem' ELSE data_coleta || 'T10:20:30.123456' END AS data_coleta,
    bairro_pesquisado,
    CASE WHEN s_suppkey % 29 <> 0 THEN place_id END AS place_id,
    agencia_name AS name, endereco_completo AS formatted_address,
    CASE WHEN s_suppkey % 19 <> 0 THEN latitude ELSE 0.0 END AS latitude,
    CASE WHEN s_suppkey % 19 <> 0 THEN longitude ELSE 0.0 END AS longitude,
    CASE WHEN s_suppkey % 7 <> 0 THEN agencia_rating ELSE 0.0 END AS rating,
    total_avaliacoes, l_linenumber <> 4 AS has_review,
    CASE WHEN l_linenumber % 5 <> 0 THEN author_name END AS author_name,
    CASE WHEN l_linenumber % 6 <> 0 THEN review_rating END AS review_rating,
    review_text, review_time
  FROM reviews)
"""


def on_landed(body: str) -> str:
    return with_ctes(LANDED_SQL, body)
