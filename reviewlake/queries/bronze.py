"""Landing to Bronze to Silver, step by step."""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewlake.operators import bronze as br
from reviewlake.operators.silver import labelled_counts, silver_score, to_silver
from reviewlake.queries import query, rows_total
from reviewlake.queries.fixtures import (
    AS_OF, BRANCHES_SQL, DAY, LANDED_SQL, PHRASES, anonymized_sql, branches, bronze,
    label_sql, landing_documents, on_branches, on_bronze, on_landed, on_reviews, on_silver, reviews,
    silver, sql_text, table, types_sql, with_ctes,
)
from reviewlake.session import checkpointed, scratch_path
from reviewlake.plans import medallion
from reviewlake.sources import catalog, layers
from reviewlake.sources.landing import build_envelopes, read_landing, write_landing

@query("from_envelope", on_landed("""
  SELECT data_coleta, bairro_pesquisado, place_id, coalesce(name, 'Local Desconhecido') AS name,
    coalesce(formatted_address, 'Endereço não informado') AS formatted_address, latitude, longitude, rating,
    total_avaliacoes, CAST(has_review AS INT) AS reviews, count(*) AS total
  FROM landed GROUP BY ALL
"""))
def _(spark, sf_dir):
    shaped = br.from_envelope(landing_documents(spark, sf_dir)).withColumn("reviews", F.size("reviews"))
    return shaped.groupBy(*shaped.columns).agg(rows_total())


@query("fill_defaults", on_landed("""
  SELECT place_id, coalesce(formatted_address, 'Endereço não informado') AS formatted_address,
    coalesce(author_name, 'Anônimo') AS author_name, coalesce(review_rating, 0) AS review_rating,
    coalesce(review_text, '') AS review_text, count(*) AS total
  FROM landed GROUP BY ALL
"""))
def _(spark, sf_dir):
    r = reviews(spark, sf_dir)
    raw = r.select(
        F.when(F.col("s_suppkey") % 29 != 0, F.col("place_id")).alias("place_id"),
        F.col("endereco_completo").alias("formatted_address"),
        F.when(F.col("l_linenumber") % 5 != 0, F.col("author_name")).alias("author_name"),
        F.when(F.col("l_linenumber") % 6 != 0, F.col("review_rating")).alias("review_rating"),
        "review_text")
    filled = br.fill_defaults(raw)
    return filled.groupBy(*filled.columns).agg(rows_total())


BRONZE_FROM_LANDED = LANDED_SQL + f""",
flat AS (
  SELECT place_id, name AS agencia_name, formatted_address AS endereco_completo, latitude, longitude,
    rating AS agencia_rating, total_avaliacoes, bairro_pesquisado, data_coleta,
    CASE WHEN data_coleta = 'ontem' THEN NULL ELSE replace(left(data_coleta, 19), 'T', ' ') END AS data_coleta_timestamp,
    '{AS_OF}' AS bronze_ingestion_timestamp, '{DAY}' AS bronze_ingestion_date,
    CASE WHEN name IS NOT NULL AND bairro_pesquisado IS NOT NULL THEN 1.0::DOUBLE ELSE 0.5::DOUBLE END AS data_quality_score,
    'google_maps_api' AS source_system, coalesce(author_name, 'Anônimo') AS author_name,
    coalesce(review_rating, 0) AS review_rating, coalesce(review_text, '') AS review_text, review_time
  FROM landed WHERE place_id IS NOT NULL AND has_review)
"""


@query("explode_reviews", with_ctes(BRONZE_FROM_LANDED, "SELECT * FROM flat"))
def _(spark, sf_dir):
    audited = br.add_audit(br.from_envelope(landing_documents(spark, sf_dir)), AS_OF)
    return br.explode_reviews(audited.filter(br.valid_place()))


@query("to_bronze", with_ctes(BRONZE_FROM_LANDED, """
  SELECT *, place_id || '_' || sha256(author_name || chr(31) || review_text || chr(31)
      || CAST(review_time AS VARCHAR)) AS bronze_review_id,
    2001 AS partition_year, 12 AS partition_month, 31 AS partition_day FROM flat
"""))
def _(spark, sf_dir):
    agencias = br.normalize_landing(landing_documents(spark, sf_dir), AS_OF)
    return br.to_bronze(agencias, AS_OF, key="sha256")


@query("landing_to_silver", with_ctes(BRONZE_FROM_LANDED, f"""
  SELECT place_id, agencia_name AS nome_agencia, bairro_pesquisado AS bairro, data_coleta,
    author_name AS review_autor, review_rating AS rating_review, review_text AS texto_review,
    {label_sql('review_text')} AS sentimento, {types_sql('review_text')} AS tipos_pii_detectados,
    {anonymized_sql('review_text')} AS texto_anonimizado
  FROM flat WHERE trim(review_text) <> ''
"""))
def _(spark, sf_dir):
    rows = br.to_bronze(br.normalize_landing(landing_documents(spark, sf_dir), AS_OF), AS_OF)
    return to_silver(rows, AS_OF).select(
        "place_id", "nome_agencia", "bairro", "data_coleta", "review_autor", "rating_review",
        "texto_review", "sentimento", "tipos_pii_detectados", "texto_anonimizado")


@query("review_id_sha256", on_bronze("""
  SELECT place_id || '_' || sha256(author_name || chr(31) || review_text || chr(31)
      || CAST(review_time AS VARCHAR)) AS bronze_review_id, count(*) AS total
  FROM bronze GROUP BY ALL
"""))
def _(spark, sf_dir):
    keyed = br.review_id(bronze(spark, sf_dir), "sha256")
    return keyed.groupBy("bronze_review_id").agg(rows_total())


@query("review_id_hash")
def _(spark, sf_dir):
    return bronze(spark, sf_dir).select("place_id", "bronze_review_id")


@query("add_audit", on_reviews(f"""
  , r AS (SELECT CASE WHEN s_suppkey % 29 <> 0 THEN place_id END AS place_id, agencia_name AS name,
    bairro_pesquisado, CASE WHEN l_linenumber % 3 = 0 THEN 'ontem' ELSE data_coleta || 'T10:20:30.123456' END
      AS data_coleta FROM reviews)
  SELECT place_id, name, bairro_pesquisado, data_coleta, '{AS_OF}' AS bronze_ingestion_timestamp,
    '{DAY}' AS bronze_ingestion_date,
    CASE WHEN place_id IS NOT NULL THEN 1.0::DOUBLE ELSE 0.5::DOUBLE END AS data_quality_score,
    'google_maps_api' AS source_system,
    CASE WHEN data_coleta <> 'ontem' THEN replace(left(data_coleta, 19), 'T', ' ') END AS data_coleta_timestamp
  FROM r
"""))
def _(spark, sf_dir):
    stamp = F.when(F.col("l_linenumber") % 3 == 0, F.lit("ontem")).otherwise(
        F.concat("data_coleta", F.lit("T10:20:30.123456")))
    rows = reviews(spark, sf_dir).select(
        F.when(F.col("s_suppkey") % 29 != 0, F.col("place_id")).alias("place_id"),
        F.col("agencia_name").alias("name"), "bairro_pesquisado", stamp.alias("data_coleta"))
    return br.add_audit(rows, AS_OF)


@query("add_partitions", """
  SELECT CAST(year(l_shipdate) AS INT) AS partition_year, CAST(month(l_shipdate) AS INT) AS partition_month,
    CAST(day(l_shipdate) AS INT) AS partition_day, count(*) AS total FROM lineitem GROUP BY ALL
""")
def _(spark, sf_dir):
    days = table(spark, sf_dir, "lineitem").select(F.col("l_shipdate").cast("date").alias("dia"))
    return br.add_partitions(days, "dia").groupBy(
        "partition_year", "partition_month", "partition_day").agg(rows_total())


@query("to_silver", on_silver(f"""
  SELECT place_id, nome_agencia, endereco_completo, latitude, longitude, rating_agencia, total_avaliacoes,
    bairro, data_coleta, review_autor, rating_review, texto_review, data_review, sentimento, tem_pii,
    tipos_pii_detectados, texto_anonimizado, '{AS_OF}' AS silver_processing_timestamp, partition_year,
    partition_month, partition_day, data_quality_score
  FROM silver
"""))
def _(spark, sf_dir):
    return silver(spark, sf_dir)


@query("minimize", on_silver("""
  SELECT place_id, nome_agencia, rating_review, texto_anonimizado FROM silver
"""))
def _(spark, sf_dir):
    return br.minimize(
        silver(spark, sf_dir), ["place_id", "nome_agencia", "rating_review", "texto_anonimizado"])


@query("cap_reviews", on_branches("""
  SELECT list_pos, CAST(least(n_reviews, 10) AS INT) AS n, CASE WHEN n_reviews > 0 THEN 'Autor ' || least(n_reviews, 10)
    END AS ultimo FROM branches
"""))
def _(spark, sf_dir):
    capped = br.cap_reviews(branches(spark, sf_dir))
    return capped.select(
        "list_pos", F.coalesce(F.size("reviews"), F.lit(0)).alias("n"),
        F.try_element_at("reviews", F.lit(-1))["author_name"].alias("ultimo"))


@query("stamp_collection", on_branches(f"""
  SELECT list_pos, '2001-12-31T00:00:00.000000' AS timestamp_coleta, '{DAY}' AS data_coleta,
    'sequencial' AS tipo_execucao, n_reviews AS reviews_coletadas FROM branches
"""))
def _(spark, sf_dir):
    return br.stamp_collection(branches(spark, sf_dir), AS_OF).select(
        "list_pos", "timestamp_coleta", "data_coleta", "tipo_execucao", "reviews_coletadas")


@query("merge_details", on_branches("""
  SELECT place_id, CASE WHEN list_pos % 2 = 0 THEN 'Detalhe ' || list_pos ELSE name END AS name,
    CASE WHEN list_pos % 2 = 0 AND list_pos % 4 <> 0 THEN 4.5::DOUBLE ELSE rating END AS rating,
    CASE WHEN list_pos % 2 = 0 THEN '0800' END AS phone
  FROM branches WHERE place_id IS NOT NULL
"""))
def _(spark, sf_dir):
    search = branches(spark, sf_dir).filter(br.valid_place())
    details = search.filter("list_pos % 2 = 0").select(
        "place_id", F.concat(F.lit("Detalhe "), F.col("list_pos").cast("string")).alias("name"),
        F.when(F.col("list_pos") % 4 != 0, F.lit(4.5)).alias("rating"), F.lit("0800").alias("phone"))
    return br.merge_details(search.select("place_id", "name", "rating"), details)


@query("has_reviews", on_branches("""
  SELECT n_reviews > 0 AS com_reviews, place_id IS NOT NULL AS com_place, count(*) AS total
  FROM branches GROUP BY ALL
"""))
def _(spark, sf_dir):
    return branches(spark, sf_dir).groupBy(
        br.has_reviews().alias("com_reviews"), br.valid_place().alias("com_place")
    ).agg(rows_total())


@query("nonblank", on_reviews("""
  SELECT coalesce(trim(review_text) <> '', false) AS tem_texto, count(*) AS total FROM reviews GROUP BY ALL
"""))
def _(spark, sf_dir):
    return reviews(spark, sf_dir).groupBy(br.nonblank("review_text").alias("tem_texto")).agg(
        rows_total())


@query("sentiment_equality", on_silver("""
  SELECT place_id, count(*) AS total FROM silver WHERE sentimento = 'positivo' GROUP BY place_id
"""))
def _(spark, sf_dir):
    return labelled_counts(silver(spark, sf_dir), "positivo")


@query("silver_score", on_bronze("""
  SELECT CASE WHEN length(review_text) > 10 THEN 1.0::DOUBLE ELSE 0.5::DOUBLE END AS score, count(*) AS total
  FROM bronze GROUP BY ALL
"""))
def _(spark, sf_dir):
    return bronze(spark, sf_dir).groupBy(silver_score("review_text").alias("score")).agg(
        rows_total())


@query("bronze_score", on_landed("""
  SELECT CASE WHEN place_id IS NOT NULL AND name IS NOT NULL AND bairro_pesquisado IS NOT NULL
    THEN 1.0::DOUBLE ELSE 0.5::DOUBLE END AS score, count(*) AS total FROM landed GROUP BY ALL
"""))
def _(spark, sf_dir):
    return br.from_envelope(landing_documents(spark, sf_dir)).groupBy(
        br.bronze_score().alias("score")).agg(rows_total())


# --- files and catalog -------------------------------------------------------

@query("landing_roundtrip", on_branches("""
  SELECT bairro, place_id, name, coalesce(formatted_address, 'Endereço não informado') AS formatted_address,
    coalesce(lat, 0.0)::DOUBLE AS latitude,
    coalesce(lng, 0.0)::DOUBLE AS longitude, rating, user_ratings_total AS total_avaliacoes,
    CAST(n_reviews AS INT) AS n_reviews
  FROM branches
"""))
def _(spark, sf_dir):
    path = scratch_path(spark, "landing")
    write_landing(branches(spark, sf_dir), path, "exec", AS_OF)
    landed = read_landing(spark, path)
    return br.normalize_landing(landed, AS_OF).select(
        F.col("bairro_pesquisado").alias("bairro"), "place_id", "name", "formatted_address",
        "latitude", "longitude", "rating", "total_avaliacoes", F.size("reviews").alias("n_reviews"))


@query("landing_glob", on_branches("""
  SELECT bairro, count(*) AS total FROM branches GROUP BY bairro
"""))
def _(spark, sf_dir):
    path = scratch_path(spark, "landing")
    write_landing(branches(spark, sf_dir), path, "exec", AS_OF)
    landed = read_landing(spark, f"{path}/year=*/month=12/*/*/*.json")
    return br.normalize_landing(landed, AS_OF).groupBy(F.col("bairro_pesquisado").alias("bairro")).agg(rows_total())


LANDED_BRONZE_SQL = BRANCHES_SQL + f""",
r AS (SELECT b.*, CAST(i AS INT) AS i, p.texto
  FROM branches b, range(1, 14) t(i) JOIN (VALUES {", ".join(f"({i}, {sql_text(p)})" for i, p in enumerate(PHRASES))})
    p(phrase_id, texto) ON (b.s_suppkey + i) % 24 = p.phrase_id
  WHERE i <= b.n_reviews AND b.place_id IS NOT NULL),
landed_bronze AS (SELECT place_id, name AS agencia_name,
    coalesce(formatted_address, 'Endereço não informado') AS endereco_completo, coalesce(lat, 0.0)::DOUBLE AS latitude,
    coalesce(lng, 0.0)::DOUBLE AS longitude, rating AS agencia_rating, user_ratings_total AS total_avaliacoes,
    bairro AS bairro_pesquisado, list_pos, 'Autor ' || i AS author_name, i % 6 AS review_rating,
    coalesce(texto, '') AS review_text, s_suppkey * 1000 + i AS review_time FROM r)
"""
LANDED_COLUMNS = ("place_id", "agencia_name", "endereco_completo", "latitude", "longitude", "agencia_rating",
                  "total_avaliacoes", "bairro_pesquisado", "author_name", "review_rating", "review_text", "review_time")


@query("medallion_bronze", with_ctes(LANDED_BRONZE_SQL, """
  SELECT * EXCLUDE (list_pos), '2001-12-31T00:00:00.000000' AS data_coleta FROM landed_bronze
"""))
def _(spark, sf_dir):
    landing, lake = scratch_path(spark, "landing"), scratch_path(spark, "lake")
    write_landing(branches(spark, sf_dir), landing, "exec", AS_OF)
    medallion.run_medallion(spark, landing, lake, AS_OF)
    return layers.read_layer(spark, lake, "bronze").select(*LANDED_COLUMNS, "data_coleta")


@query("medallion_one_day", with_ctes(LANDED_BRONZE_SQL, """
  SELECT * EXCLUDE (list_pos) FROM landed_bronze WHERE list_pos % 2 = 1
"""))
def _(spark, sf_dir):
    """Two landed days, of which one is processed, twice."""
    landing, lake = scratch_path(spark, "landing"), scratch_path(spark, "lake")
    write_landing(branches(spark, sf_dir).where("list_pos % 2 = 0"), landing, "exec", "2001-12-30 00:00:00")
    write_landing(branches(spark, sf_dir).where("list_pos % 2 = 1"), landing, "exec", AS_OF)
    for _ in range(2):
        medallion.land_to_bronze(spark, landing, lake, AS_OF, day=DAY)
    return layers.read_layer(spark, lake, "bronze").select(*LANDED_COLUMNS)


DAYS = {"2001-12-30": "list_pos % 2 = 0", DAY: "list_pos % 2 = 1"}
DAY_KPIS_SQL = f"""
  SELECT place_id, agencia_name AS nome_agencia, bairro_pesquisado AS bairro, count(*) AS total_reviews,
    avg(review_rating) AS rating_medio,
    count(*) FILTER ({label_sql('review_text')} = 'positivo') AS reviews_positivos,
    count(*) FILTER ({label_sql('review_text')} = 'negativo') AS reviews_negativos,
    count(*) FILTER ({label_sql('review_text')} = 'neutro') AS reviews_neutros,
    count(*) FILTER ({types_sql('review_text')} <> '') AS reviews_com_pii
  FROM landed_bronze WHERE trim(review_text) <> ''"""


def run_days(spark, sf_dir):
    """Two days landed and run one after the other, the first of them twice with other documents."""
    landing, lake = scratch_path(spark, "landing"), scratch_path(spark, "lake")
    first, second = DAYS
    early = scratch_path(spark, "landing")
    write_landing(branches(spark, sf_dir), early, "early", f"{first} 01:00:00")
    medallion.run_day(spark, early, lake, first, f"{first} 01:00:00")
    for day, rows in DAYS.items():
        write_landing(branches(spark, sf_dir).where(rows), landing, "exec", f"{day} 02:00:00")
        medallion.run_day(spark, landing, lake, day, f"{day} 02:00:00")
    return lake


@query("medallion_two_days", with_ctes(LANDED_BRONZE_SQL, f"{DAY_KPIS_SQL} GROUP BY ALL"))
def _(spark, sf_dir):
    """Gold kept by days equals Gold of all documents at once."""
    lake = run_days(spark, sf_dir)
    return layers.read_layer(spark, lake, "agency_performance_kpis").drop("gold_timestamp")


@query("medallion_rollups", with_ctes(LANDED_BRONZE_SQL, """
  SELECT CAST(30 + list_pos % 2 AS INT) AS partition_day, count(*) AS silver, count(*) AS rollup,
    count(DISTINCT bairro_pesquisado) AS bairros
  FROM landed_bronze WHERE trim(review_text) <> '' GROUP BY 1
"""))
def _(spark, sf_dir):
    """What Silver and the stored roll-ups hold of each day."""
    lake = run_days(spark, sf_dir)
    kept = layers.read_layer(spark, lake, "silver").groupBy("partition_day").agg(
        rows_total().alias("silver"), F.count_distinct("bairro").alias("bairros"))
    summed = layers.read_layer(spark, lake, "rollup").groupBy("partition_day").agg(F.sum("n_reviews").alias("rollup"))
    return kept.join(summed, "partition_day")


def simple_documents(spark, sf_dir):
    return branches(spark, sf_dir).drop("position", "list_pos", "s_suppkey")


SIMPLE_SQL = """
  SELECT bairro, place_id, name, coalesce(formatted_address, 'Endereço não informado') AS formatted_address,
    rating, user_ratings_total AS total_avaliacoes, CAST(n_reviews AS INT) AS n_reviews FROM branches
"""


def landed_branches(landed):
    return br.normalize_landing(landed, AS_OF).select(
        F.col("bairro_pesquisado").alias("bairro"), "place_id", "name", "formatted_address", "rating",
        "total_avaliacoes", F.greatest(F.size(F.coalesce("reviews", F.array())), F.lit(0)).alias("n_reviews"))


@query("landing_simple", on_branches(SIMPLE_SQL))
def _(spark, sf_dir):
    path = scratch_path(spark, "landing")
    simple_documents(spark, sf_dir).write.json(path)
    return landed_branches(read_landing(spark, path, "simple"))


@query("landing_mixed", on_branches(f"{SIMPLE_SQL} UNION ALL {SIMPLE_SQL}"))
def _(spark, sf_dir):
    path = scratch_path(spark, "landing")
    simple_documents(spark, sf_dir).write.json(f"{path}/simples")
    write_landing(branches(spark, sf_dir), f"{path}/envelopes", "exec", AS_OF)
    return landed_branches(read_landing(spark, path))


@query("landing_split", on_branches(SIMPLE_SQL))
def _(spark, sf_dir):
    """Files of lines beside files of several documents over many lines each."""
    path = scratch_path(spark, "landing")
    rows = simple_documents(spark, sf_dir).withColumn("_odd", F.crc32(F.coalesce("place_id", F.lit("")).cast("binary")) % 2 == 1)
    rows.where("not _odd").drop("_odd").write.json(f"{path}/lines")
    many = rows.where("_odd").drop("_odd")
    many.select(F.to_json(F.struct(*many.columns), {"pretty": "true"}).alias("value")).write.text(f"{path}/pretty")
    return landed_branches(read_landing(spark, path, "simple"))


@query("audit_and_lineage", with_ctes(LANDED_BRONZE_SQL, """
  SELECT 'landing_to_bronze' AS operation, 'bronze' AS table_name, count(*) AS records_affected,
    1::BIGINT AS lineage_rows FROM landed_bronze
  UNION ALL SELECT 'bronze_to_silver', 'silver', count(*), 1 FROM landed_bronze WHERE trim(review_text) <> ''
"""))
def _(spark, sf_dir):
    landing, lake = scratch_path(spark, "landing"), scratch_path(spark, "lake")
    write_landing(branches(spark, sf_dir), landing, "exec", AS_OF)
    medallion.run_medallion(spark, landing, lake, AS_OF)
    audit, lineage = (spark.read.parquet(layers.layer_path(lake, f"governance/{n}")) for n in ("audit", "lineage"))
    target = lineage.groupBy(F.col("target_table").alias("table_name")).agg(F.count(F.lit(1)).alias("lineage_rows"))
    return audit.join(target, "table_name").select("operation", "table_name", "records_affected", "lineage_rows")


@query("catalog_tables", """
  SELECT unnest(['agency_performance_kpis', 'bronze_google_maps_reviews', 'business_metrics_summary',
    'executive_dashboard', 'nps_ranking', 'risk_alerts', 'silver_google_maps_reviews_enriched',
    'temporal_sentiment_analysis']) AS tabela
""")
def _(spark, sf_dir):
    import uuid

    landing, lake, db = scratch_path(spark, "landing"), scratch_path(spark, "lake"), f"rl_{uuid.uuid4().hex[:10]}"
    write_landing(branches(spark, sf_dir), landing, "exec", AS_OF)
    medallion.run_medallion(spark, landing, lake, AS_OF, db=db)
    names = [r["tableName"] for r in catalog.list_tables(spark, db).collect()]
    catalog.drop_database(spark, db)
    return spark.createDataFrame([(n,) for n in names], "tabela string")


@query("landing_partitions", on_branches("""
  SELECT 2001 AS part_year, 12 AS part_month, 31 AS part_day, lower(bairro) AS part_bairro,
    count(*) AS agencias, CAST(sum(n_reviews) AS BIGINT) AS total_reviews
  FROM branches GROUP BY bairro
"""))
def _(spark, sf_dir):
    path = scratch_path(spark, "landing")
    write_landing(branches(spark, sf_dir), path, "exec", AS_OF)
    docs = read_landing(spark, path, partitions=True)
    quality = "execution_metadata.data_quality"
    return docs.filter("part_year = 2001").groupBy(
        "part_year", "part_month", "part_day", "part_bairro"
    ).agg(
        F.sum(f"{quality}.total_agencias").alias("agencias"),
        F.sum(f"{quality}.total_reviews").alias("total_reviews"))


@query("build_envelopes", on_branches("""
  , p AS (SELECT *, CAST((name <> '') AS INT) + CAST(coalesce(place_id <> '', false) AS INT)
      + CAST(coalesce(formatted_address <> '', false) AS INT) + CAST(rating <> 0 AS INT) + least(n_reviews, 2) AS pts
    FROM branches)
  SELECT bairro, list_pos // 50 AS parte, CAST(count(*) AS INT) AS total_agencias,
    CAST(sum(n_reviews) AS INT) AS total_reviews, sum(pts)::DOUBLE / (count(*) * 6)::DOUBLE AS completeness_score
  FROM p GROUP BY bairro, list_pos // 50
"""))
def _(spark, sf_dir):
    docs = build_envelopes(branches(spark, sf_dir), "exec", AS_OF, F.expr("list_pos div 50"))
    meta = "execution_metadata"
    return docs.select(
        F.col(f"{meta}.bairro").alias("bairro"),
        F.element_at(F.split(f"{meta}.run_id", "_"), -1).cast("int").alias("parte"),
        f"{meta}.data_quality.total_agencias", f"{meta}.data_quality.total_reviews",
        f"{meta}.data_quality.completeness_score")


@query("layer_roundtrip", on_bronze("""
  SELECT partition_year, partition_month, partition_day, bairro_pesquisado, count(*) AS total,
    CAST(sum(review_rating) AS BIGINT) AS soma FROM bronze GROUP BY ALL
"""))
def _(spark, sf_dir):
    root = scratch_path(spark, "lake")
    layers.write_layer(bronze(spark, sf_dir), root, "bronze")
    return layers.read_layer(spark, root, "bronze").groupBy(
        "partition_year", "partition_month", "partition_day", "bairro_pesquisado"
    ).agg(rows_total(), F.sum("review_rating").alias("soma"))


@query("gold_tables_written", on_silver("""
  SELECT 'agency_performance_kpis' AS tabela, count(*) AS linhas FROM (SELECT DISTINCT place_id, nome_agencia, bairro FROM silver)
  UNION ALL SELECT 'temporal_sentiment_analysis', count(*) FROM (SELECT DISTINCT bairro, month(CAST(data_coleta AS DATE)) FROM silver)
  UNION ALL SELECT 'risk_alerts', count(*) FROM (SELECT DISTINCT place_id FROM silver WHERE sentimento = 'negativo')
  UNION ALL SELECT 'executive_dashboard', 1
  UNION ALL SELECT 'nps_ranking', count(DISTINCT place_id) FROM silver
  UNION ALL SELECT 'business_metrics_summary', count(DISTINCT bairro) FROM silver
"""))
def _(spark, sf_dir):
    from reviewlake.operators.analytics import gold_counts
    from reviewlake.operators.gold import GOLD_TABLES
    from reviewlake.plans.medallion import silver_to_gold

    root = scratch_path(spark, "lake")
    layers.write_layer(silver(spark, sf_dir), root, "silver")
    silver_to_gold(spark, root, AS_OF)
    return gold_counts(spark, root, list(GOLD_TABLES))


@query("schema_merge", on_silver("""
  SELECT nome_agencia, bairro, sentimento IS NULL AS antiga, count(*) AS total FROM (
    SELECT nome_agencia, bairro, sentimento FROM silver
    UNION ALL SELECT nome_agencia, bairro, NULL FROM silver WHERE rating_review = 5) GROUP BY ALL
"""))
def _(spark, sf_dir):
    root = scratch_path(spark, "merge")
    rows = silver(spark, sf_dir).select("nome_agencia", "bairro", "sentimento", "rating_review")
    old = rows.filter("rating_review = 5").select("nome_agencia", "bairro")
    layers.write_layer(old, root, "reviews", mode="append")
    layers.write_layer(rows.drop("rating_review"), root, "reviews", mode="append", merge_schema=True)
    merged = layers.read_layer(spark, root, "reviews", merge_schema=True)
    return merged.groupBy(
        "nome_agencia", "bairro", F.col("sentimento").isNull().alias("antiga")
    ).agg(rows_total())


@query("registered_table", on_silver("""
  SELECT bairro, count(*) AS total FROM silver GROUP BY bairro
"""))
def _(spark, sf_dir):
    import uuid

    root, db = scratch_path(spark, "lake"), f"rl_{uuid.uuid4().hex[:10]}"
    path = layers.write_layer(silver(spark, sf_dir), root, "silver")
    catalog.register_table(spark, db, catalog.TABLES["silver"], path)
    found = checkpointed(catalog.run_sql(
        spark, f"SELECT bairro, count(*) AS total FROM {db}.{catalog.TABLES['silver']} GROUP BY bairro"))
    catalog.drop_database(spark, db)
    return found
