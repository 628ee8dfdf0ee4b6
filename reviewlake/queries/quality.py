"""Data-quality queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewlake.operators import quality as q
from reviewlake.operators.silver import to_silver
from reviewlake.operators.bronze import normalize_landing
from reviewlake.queries import query
from reviewlake.session import scratch_path
from reviewlake.sources.landing import read_landing, unreadable, write_landing
from reviewlake.queries.dashboards import pct
from reviewlake.queries.fixtures import (
    AS_OF, BRANCHES_SQL, DAY, branches, bronze, bronze_rows, on_branches, on_bronze, on_silver, table,
    with_ctes,
)

CHECKED_SQL = BRANCHES_SQL + """,
checked AS (
  SELECT *, CAST(coalesce(place_id, '') = '' AS INT) + CAST(coalesce(name, '') = '' AS INT)
      + CAST(coalesce(formatted_address, '') = '' AS INT) + CAST(NOT has_geometry AS INT)
      + CAST(NOT has_types AS INT) AS faltas,
    rating <> 0 AS com_rating, rating <> 0 AND (rating < 1.0 OR rating > 5.0) AS rating_ruim,
    coalesce(lat, 0.0) = 0.0 OR coalesce(lng, 0.0) = 0.0 AS sem_coord
  FROM branches),
m AS (
  SELECT bairro, count(*) AS total_agencias, CAST(sum(n_reviews) AS BIGINT) AS total_reviews,
    count(*) FILTER (com_rating) AS agencias_com_rating, count(*) FILTER (sem_coord) AS agencias_sem_coordenadas,
    CAST(sum(faltas) AS BIGINT) AS campos_ausentes, count(*) FILTER (rating_ruim) AS ratings_invalidos
  FROM checked GROUP BY bairro),
s AS (
  SELECT *, agencias_com_rating::DOUBLE / total_agencias::DOUBLE * 100 AS percentual_com_rating,
    campos_ausentes + ratings_invalidos AS problemas_criticos,
    CAST(total_agencias < 1 AS BIGINT) + CAST(total_agencias > 50 AS BIGINT) AS problemas_menores FROM m),
b AS (
  SELECT *, 1.0::DOUBLE - problemas_criticos * 0.15::DOUBLE - problemas_menores * 0.05::DOUBLE
      + percentual_com_rating / 100 * 0.2::DOUBLE AS base,
    agencias_sem_coordenadas::DOUBLE / total_agencias::DOUBLE AS sem FROM s),
validated AS (
  SELECT * EXCLUDE (base, sem), greatest(0.0::DOUBLE, least(1.0::DOUBLE,
      CASE WHEN sem > 0.1 THEN base - sem * 0.3::DOUBLE ELSE base END)) AS score_qualidade FROM b),
v AS (SELECT *, score_qualidade >= 0.7 AS aprovado FROM validated)
"""


def on_validated(body):
    return with_ctes(CHECKED_SQL, body)


def validated(spark, sf_dir, **options):
    return q.validate_bairros(branches(spark, sf_dir), **options)


@query("completeness", on_branches("""
  SELECT bairro, count(*) AS total_agencias, CAST(sum(n_reviews) AS BIGINT) AS total_reviews,
    sum(CAST(name <> '' AS INT) + CAST(coalesce(place_id <> '', false) AS INT)
      + CAST(coalesce(formatted_address <> '', false) AS INT) + CAST(rating <> 0 AS INT)
      + least(n_reviews, 2))::DOUBLE / (count(*) * 6)::DOUBLE AS completeness_score
  FROM branches GROUP BY bairro
"""))
def _(spark, sf_dir):
    return q.completeness(branches(spark, sf_dir))


@query("validate_bairros", on_validated("""
  SELECT v.*, concat_ws(',', CASE WHEN percentual_com_rating < 50
      THEN 'Poucas agências com rating - verificar filtros de busca' END,
    CASE WHEN agencias_sem_coordenadas > total_agencias * 0.1
      THEN 'Muitas agências sem coordenadas - verificar geocoding' END) AS recomendacoes
  FROM v
"""))
def _(spark, sf_dir):
    return validated(spark, sf_dir)


@query("recommendations_extended", on_validated("""
  , r AS (SELECT bairro, score_qualidade, concat_ws(',', CASE WHEN percentual_com_rating < 30
      THEN 'Muito poucas agências com rating - verificar filtros de busca e tipos' WHEN percentual_com_rating < 50
      THEN 'Poucas agências com rating - considerar ajustar query de busca' END,
    CASE WHEN agencias_sem_coordenadas::DOUBLE / total_agencias > 0.1
      THEN 'Muitas agências sem coordenadas - verificar processo de geocoding' END,
    CASE WHEN total_agencias > 50
      THEN 'Muitas agências encontradas - refinar filtros para evitar resultados irrelevantes' END,
    CASE WHEN campos_ausentes > 0 THEN 'Campos obrigatórios ausentes - verificar mapeamento da API' END,
    CASE WHEN ratings_invalidos > 0 THEN 'Ratings inválidos detectados - verificar validação de dados' END) AS rec
    FROM v)
  SELECT bairro, CASE WHEN rec = '' AND score_qualidade < 0.8
    THEN 'Revisar processo de coleta para melhorar qualidade dos dados' ELSE rec END AS recomendacoes
  FROM r
"""))
def _(spark, sf_dir):
    return validated(spark, sf_dir, extended=True).select("bairro", "recomendacoes")


_FIELDS = (("place_id", "coalesce(place_id, '') = ''"), ("name", "coalesce(name, '') = ''"),
           ("formatted_address", "coalesce(formatted_address, '') = ''"),
           ("geometry", "NOT has_geometry"), ("types", "NOT has_types"))
_MISSING = " UNION ALL ".join(
    f"SELECT bairro, list_pos + 1 AS posicao, 'campo_ausente:{n}' AS tipo, 'critico' AS severidade, "
    f"'Agência ' || (list_pos + 1) || ': campo ''{n}'' ausente ou vazio' AS problema "
    f"FROM checked WHERE {bad}" for n, bad in _FIELDS)
PROBLEMS_SQL = f"""
  {_MISSING} UNION ALL SELECT bairro, list_pos + 1, 'rating_invalido', 'critico',
    'Agência ' || (list_pos + 1) || ': rating inválido (' || rating || ')' FROM checked WHERE rating_ruim
  UNION ALL SELECT bairro, 0, 'muitas_agencias', 'menor',
    'Muitas agências encontradas (' || total_agencias || '), verificar filtros' FROM v WHERE total_agencias > 50
"""


@query("problem_rows", on_validated(PROBLEMS_SQL))
def _(spark, sf_dir):
    b = branches(spark, sf_dir)
    return q.problem_rows(b, q.validate_bairros(b))


INTEGRITY_SQL = f"""
  , g AS (SELECT count(*) AS total_bairros, count(*) FILTER (aprovado) AS bairros_validos,
      count(*) FILTER (NOT aprovado) AS bairros_com_problemas, CAST(sum(total_agencias) AS BIGINT) AS total_agencias,
      CAST(sum(total_reviews) AS BIGINT) AS total_reviews,
      CAST(sum(CAST(score_qualidade AS DECIMAL(28,12))) AS DOUBLE) / count(*) AS score_medio_qualidade FROM v),
  h AS (SELECT *, bairros_validos::DOUBLE / total_bairros::DOUBLE AS percentual_bairros_validos,
      total_agencias::DOUBLE / total_bairros::DOUBLE AS media_agencias_por_bairro FROM g)
  SELECT *, CASE WHEN percentual_bairros_validos >= 0.9 THEN 'excelente' WHEN percentual_bairros_validos >= 0.7
    THEN 'bom' WHEN percentual_bairros_validos >= 0.5 THEN 'aceitavel' ELSE 'problematico' END AS status,
    '{DAY}' AS data
  FROM h
"""


@query("integrity_report", on_validated(INTEGRITY_SQL))
def _(spark, sf_dir):
    return q.integrity_report(validated(spark, sf_dir), AS_OF)


@query("integrity_report_failed", on_validated(INTEGRITY_SQL.replace("FROM v)", """FROM (
    SELECT aprovado, total_agencias, total_reviews, score_qualidade FROM v
    UNION ALL SELECT false, 0, 0, 0.0 FROM nation WHERE n_nationkey % 5 = 0))""", 1)))
def _(spark, sf_dir):
    """A landed day in which some documents cannot be read."""
    path = scratch_path(spark, "landing")
    write_landing(branches(spark, sf_dir), path, "exec", AS_OF)
    broken = table(spark, sf_dir, "nation").where("n_nationkey % 5 = 0").select(
        F.concat(F.lit('{"schema_version": "v1.0", "raw_data": {"agencias": ['), F.col("n_name")).alias("value"),
        F.lit(2001).alias("year"), F.lit("12").alias("month"), F.lit("31").alias("day"),
        F.lower("n_name").alias("bairro"))
    broken.write.mode("append").partitionBy("year", "month", "day", "bairro").text(path)
    landed = normalize_landing(read_landing(spark, path), AS_OF)
    assert landed.where("place_id is not null").count() > 0
    v = validated(spark, sf_dir)
    failed = q.failed_documents(unreadable(spark, path, partitions=True), v)
    return q.integrity_report(v.unionByName(failed), AS_OF)


@query("report_lines")
def _(spark, sf_dir):
    b = branches(spark, sf_dir)
    v = q.validate_bairros(b)
    lines = q.report_lines(q.integrity_report(v, AS_OF), v, q.problem_rows(b, v))
    return lines.orderBy("secao", "chave", "item", "linha")


@query("quality_gate", on_validated("SELECT bairro, score_qualidade FROM v"))
def _(spark, sf_dir):
    return q.quality_gate(validated(spark, sf_dir), 0.0).select("bairro", "score_qualidade")


@query("quality_gate_passed", on_validated("SELECT bairro, score_qualidade FROM v WHERE problemas_menores >= 0 AND aprovado"))
def _(spark, sf_dir):
    approved = validated(spark, sf_dir).filter("aprovado")
    return q.quality_gate(approved, 0.7).select("bairro", "score_qualidade")


@query("quality_gate_refused", on_validated("SELECT bairro, score_qualidade FROM v WHERE score_qualidade < 0.7"))
def _(spark, sf_dir):
    return q.gate_refusals(validated(spark, sf_dir), 0.7).select("bairro", "score_qualidade")


@query("validate_nlp", on_silver("""
  , s AS (SELECT CASE WHEN l_linenumber = 7 AND s_suppkey % 3 = 0 THEN NULL
      WHEN l_linenumber = 6 AND s_suppkey % 3 = 0 THEN 'misto' ELSE sentimento END AS sentimento,
    CASE WHEN l_linenumber <> 5 OR s_suppkey % 3 <> 0 THEN tem_pii END AS tem_pii FROM silver),
  c AS (SELECT count(*) FILTER (sentimento IS NULL) AS sentimento_nulo,
    count(*) FILTER (sentimento NOT IN ('positivo', 'negativo', 'neutro')) AS sentimento_invalido,
    count(*) FILTER (tem_pii IS NULL) AS tem_pii_nulo FROM s)
  SELECT *, concat_ws(',', CASE WHEN sentimento_nulo > 0
      THEN 'ERRO: ' || sentimento_nulo || ' registros com sentimento nulo' END,
    CASE WHEN sentimento_invalido > 0 THEN 'ERRO: ' || sentimento_invalido || ' sentimentos inválidos' END,
    CASE WHEN tem_pii_nulo > 0 THEN 'AVISO: ' || tem_pii_nulo || ' registros com tem_pii nulo' END) AS mensagens
  FROM c
"""))
def _(spark, sf_dir):
    from reviewlake.operators.silver import enrich
    from reviewlake.operators.bronze import nonblank

    rows = enrich(bronze_rows(spark, sf_dir).filter(nonblank("review_text")), "review_text")
    third, line = F.col("s_suppkey") % 3 == 0, F.col("l_linenumber")
    spoiled = rows.select(
        F.when((line == 7) & third, F.lit(None)).when((line == 6) & third, F.lit("misto"))
        .otherwise(F.col("sentimento")).alias("sentimento"),
        F.when((line != 5) | ~third, F.col("tem_pii")).alias("tem_pii"))
    return q.validate_nlp(spoiled)


def _violation_sql(source: str, checks: list[tuple[str, str, str]]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS coluna, '{rule}' AS regra, count(*) FILTER ({bad}) AS violacoes, count(*) AS total, "
        f"100.0::DOUBLE - {pct(f'count(*) FILTER ({bad})', 'count(*)')} AS percentual_ok FROM {source}"
        for c, rule, bad in checks)


@query("range_violations", on_bronze(_violation_sql("bronze", [
    ("review_rating", "range", "review_rating < 1 OR review_rating > 5"),
    ("latitude", "range", "latitude < -90 OR latitude > 90"),
    ("longitude", "range", "longitude < -180 OR longitude > 180"),
    ("total_avaliacoes", "range", "total_avaliacoes < 0"),
])))
def _(spark, sf_dir):
    return q.range_violations(bronze(spark, sf_dir))


_ODD_ROWS = """
  , odd AS (SELECT CASE WHEN s_suppkey % 10 = 3 THEN 'XX' || place_id ELSE place_id END AS place_id,
      CASE WHEN l_linenumber = 2 THEN 'hoje' WHEN l_linenumber = 3 THEN '2001-02-30' ELSE data_coleta END AS data_coleta,
      agencia_name, CASE WHEN l_linenumber <> 1 THEN bairro_pesquisado END AS bairro_pesquisado,
      'x' AS bronze_review_id, review_text, author_name FROM bronze)
"""


def _odd(spark, sf_dir):
    line = F.col("l_linenumber")
    return bronze_rows(spark, sf_dir).withColumns({
        "place_id": F.when(F.col("s_suppkey") % 10 == 3, F.concat(F.lit("XX"), "place_id"))
        .otherwise(F.col("place_id")),
        "data_coleta": F.when(line == 2, F.lit("hoje")).when(line == 3, F.lit("2001-02-30"))
        .otherwise(F.col("data_coleta")),
        "bairro_pesquisado": F.when(line != 1, F.col("bairro_pesquisado")),
    })


@query("format_violations", on_bronze(_ODD_ROWS + _violation_sql("odd", [
    ("place_id", "formato", "NOT regexp_matches(place_id, '^ChIJ[a-zA-Z0-9_-]+$')"),
    ("data_coleta", "data",
     r"NOT (regexp_matches(data_coleta, '^\d{4}-\d{2}-\d{2}$') AND TRY_CAST(data_coleta AS DATE) IS NOT NULL)"),
])))
def _(spark, sf_dir):
    return q.format_violations(_odd(spark, sf_dir))


@query("null_violations", on_bronze(_ODD_ROWS + _violation_sql("odd", [
    (c, "obrigatorio", f"{c} IS NULL")
    for c in ("place_id", "agencia_name", "bairro_pesquisado", "data_coleta", "bronze_review_id")
])))
def _(spark, sf_dir):
    return q.null_violations(_odd(spark, sf_dir))


@query("length_violations", on_bronze(_violation_sql("bronze", [
    ("review_text", "tamanho", "length(review_text) < 5 OR length(review_text) > 5000"),
    ("author_name", "tamanho", "length(author_name) < 2 OR length(author_name) > 100"),
])))
def _(spark, sf_dir):
    return q.length_violations(bronze(spark, sf_dir))


@query("length_violations_documents", _violation_sql("documents", [
    ("text", "tamanho", "length(text) < 5 OR length(text) > 5000")]))
def _(spark, sf_dir):
    return q.length_violations(table(spark, sf_dir, "documents"), (("text", 5, 5000),))


UNIQUE_SQL = """
  SELECT CAST(sum(n) AS BIGINT) AS total, count(*) AS chaves_distintas, count(*) FILTER (n > 1) AS chaves_repetidas,
    CAST(sum(n - 1) AS BIGINT) AS linhas_excedentes, count(*)::DOUBLE * 100.0::DOUBLE / sum(n)::DOUBLE AS percentual_unico
  FROM ({counts})
"""


@query("uniqueness_order_line", UNIQUE_SQL.format(
    counts="SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber"))
def _(spark, sf_dir):
    return q.uniqueness(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("uniqueness_review", on_bronze(UNIQUE_SQL.format(
    counts="SELECT count(*) AS n FROM bronze GROUP BY place_id, review_time, author_name")))
def _(spark, sf_dir):
    return q.uniqueness(bronze(spark, sf_dir), ["place_id", "review_time", "author_name"])


@query("uniqueness_suspects", on_bronze(UNIQUE_SQL.format(
    counts="SELECT count(*) AS n FROM bronze GROUP BY place_id, review_time, author_name")))
def _(spark, sf_dir):
    return q.uniqueness_by_suspects(bronze(spark, sf_dir), ["place_id", "review_time", "author_name"])


@query("duplicates_suspects", """
  SELECT user_id, event_type, CAST(value AS INT) AS v, count(*) AS ocorrencias FROM events
  GROUP BY ALL HAVING count(*) > 1
""")
def _(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("user_id", "event_type", F.rint("value").cast("int").alias("v"))
    return q.duplicates_by_suspects(rows, ["user_id", "event_type", "v"])


@query("duplicates_order_line", """
  SELECT l_orderkey, l_linenumber, count(*) AS ocorrencias FROM lineitem
  GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
""")
def _(spark, sf_dir):
    return q.duplicates(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("temporal_violations", on_bronze("""
  , t AS (SELECT review_time + CASE WHEN l_linenumber = 1 THEN 90000 ELSE 0 END AS review_time,
      CASE WHEN l_linenumber = 2 THEN '2002-05-01' WHEN l_linenumber = 3 THEN 'hoje' ELSE data_coleta END AS data_coleta,
      bronze_ingestion_date FROM bronze)
""" + _violation_sql("t", [
    ("review_time", "ordem_temporal",
     "make_timestamp(review_time * 1000000) > TRY_CAST(data_coleta AS TIMESTAMP)"),
    ("bronze_ingestion_date", "ordem_temporal",
     "bronze_ingestion_date < TRY_CAST(data_coleta AS TIMESTAMP)"),
])))
def _(spark, sf_dir):
    line = F.col("l_linenumber")
    rows = bronze_rows(spark, sf_dir).withColumns({
        "review_time": F.col("review_time") + F.when(line == 1, F.lit(90000)).otherwise(F.lit(0)),
        "data_coleta": F.when(line == 2, F.lit("2002-05-01")).when(line == 3, F.lit("hoje"))
        .otherwise(F.col("data_coleta")),
    })
    return q.temporal_violations(rows)


@query("evaluate_thresholds", on_bronze("""
  , m AS (SELECT 'range' AS metrica, count(*) FILTER (review_rating BETWEEN 1 AND 5)::DOUBLE * 100.0::DOUBLE
        / count(*)::DOUBLE AS percentual FROM bronze
    UNION ALL SELECT 'completude', count(review_text)::DOUBLE * 100.0::DOUBLE / count(*)::DOUBLE FROM bronze
    UNION ALL SELECT 'unicidade', count(*)::DOUBLE * 100.0::DOUBLE / sum(n)::DOUBLE FROM
      (SELECT count(*) AS n FROM bronze GROUP BY place_id, review_time, author_name)),
  l(metrica, minimo, inclui, acao) AS (VALUES ('completude', 95.0::DOUBLE, false, 'alerta'),
    ('unicidade', 100.0::DOUBLE, true, 'falha'), ('range', 98.0::DOUBLE, false, 'alerta')),
  j AS (SELECT metrica, percentual, minimo, acao,
      CASE WHEN inclui THEN percentual >= minimo ELSE percentual > minimo END AS aprovado FROM m JOIN l USING (metrica))
  SELECT metrica, percentual, minimo, aprovado, CASE WHEN aprovado THEN 'nenhuma' ELSE acao END AS acao FROM j
"""))
def _(spark, sf_dir):
    rows = bronze(spark, sf_dir)
    unique = q.uniqueness(rows, ["place_id", "review_time", "author_name"]).select(
        F.lit("unicidade").alias("metrica"), F.col("percentual_unico").alias("percentual"))
    shares = rows.agg(
        (F.count_if(F.col("review_rating").between(1, 5)).cast("double") * 100.0 / F.count(F.lit(1)).cast("double"))
        .alias("range"),
        (F.count("review_text").cast("double") * 100.0 / F.count(F.lit(1)).cast("double")).alias("completude"))
    long = shares.unpivot([], ["range", "completude"], "metrica", "percentual")
    return q.evaluate_thresholds(long.unionByName(unique))


@query("orphans_silver_in_bronze", on_silver("""
  , child AS (SELECT CASE WHEN s_suppkey % 10 = 3 THEN 'XX' || place_id ELSE place_id END AS place_id FROM silver)
  SELECT place_id, count(*) AS linhas FROM child
  WHERE place_id NOT IN (SELECT place_id FROM bronze) GROUP BY place_id
"""))
def _(spark, sf_dir):
    rows = bronze_rows(spark, sf_dir)
    child = to_silver(rows.withColumn(
        "place_id", F.when(F.col("s_suppkey") % 10 == 3, F.concat(F.lit("XX"), "place_id"))
        .otherwise(F.col("place_id"))), AS_OF)
    return q.orphans(child, rows, ["place_id"])


@query("orphans_labels_in_documents", """
  SELECT doc_id + 5 AS doc_id, count(*) AS linhas FROM labels
  WHERE doc_id + 5 NOT IN (SELECT doc_id FROM documents) GROUP BY ALL
""")
def _(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").withColumn("doc_id", F.col("doc_id") + 5)
    return q.orphans(labels, table(spark, sf_dir, "documents"), ["doc_id"])
