"""Incremental control and governance queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewlake import schemas
from reviewlake.operators import governance as gov
from reviewlake.operators import incremental as inc
from reviewlake.queries import query, rows_total
from reviewlake.queries.dashboards import pct, round2
from reviewlake.queries.fixtures import (
    AS_OF, BRANCHES_SQL, branches, bronze, on_bronze, on_silver, place_of, silver, table, with_ctes,
)
from reviewlake.session import scratch_path

# Branches of every neighbourhood; a third is consulted, and all of some neighbourhoods.
STATE_SQL = """
  dim AS (SELECT n_nationkey AS position, n_name AS bairro FROM nation),
  available AS (SELECT n_name AS bairro, 'ChIJ' || lpad(CAST(s_suppkey AS VARCHAR), 8, '0') AS place_id,
      CAST(s_suppkey AS INT) AS list_pos FROM supplier JOIN nation ON s_nationkey = n_nationkey
      WHERE n_nationkey % 8 <> 5),
  consulted AS (SELECT n_name AS bairro, 'ChIJ' || lpad(CAST(s_suppkey AS VARCHAR), 8, '0') AS place_id
      FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_suppkey % 3 = 0 OR n_nationkey % 4 = 0
        OR n_nationkey = 5),
  pend AS (SELECT * FROM available a WHERE NOT EXISTS (SELECT 1 FROM consulted c
      WHERE c.bairro = a.bairro AND c.place_id = a.place_id)),
  st AS (SELECT d.position, d.bairro,
      (SELECT count(*) FROM available a WHERE a.bairro = d.bairro) AS disponiveis,
      (SELECT count(*) FROM consulted c WHERE c.bairro = d.bairro) AS consultadas,
      (SELECT count(*) FROM pend p WHERE p.bairro = d.bairro) AS pendentes FROM dim d),
  status AS (SELECT *, (disponiveis = 0 AND consultadas = 0) OR pendentes > 0 AS tem_pendentes FROM st)
"""


def on_state(body):
    return with_ctes(STATE_SQL, body)


def dim(spark, sf_dir):
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("position"), F.col("n_name").alias("bairro"))


def _places(spark, sf_dir):
    return table(spark, sf_dir, "supplier").join(
        table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))


def available(spark, sf_dir):
    return _places(spark, sf_dir).filter("n_nationkey % 8 <> 5").select(
        F.col("n_name").alias("bairro"), place_of("s_suppkey").alias("place_id"),
        F.col("s_suppkey").cast("int").alias("list_pos"))


def consulted(spark, sf_dir):
    done = "s_suppkey % 3 = 0 OR n_nationkey % 4 = 0 OR n_nationkey = 5"
    return _places(spark, sf_dir).filter(done).select(
        F.col("n_name").alias("bairro"), place_of("s_suppkey").alias("place_id"),
        F.lit("2001-12-01 00:00:00").cast("timestamp").alias("data_ultima_consulta"))


def status(spark, sf_dir):
    return inc.has_pending(dim(spark, sf_dir), available(spark, sf_dir), consulted(spark, sf_dir))


@query("pending", on_state("SELECT * FROM pend"))
def _(spark, sf_dir):
    return inc.pending(available(spark, sf_dir), consulted(spark, sf_dir))


@query("next_batch", on_state("""
  , r AS (SELECT *, CAST(row_number() OVER (PARTITION BY bairro ORDER BY list_pos, place_id) AS INT) AS ordem FROM pend)
  SELECT * FROM r WHERE ordem <= 2
"""))
def _(spark, sf_dir):
    return inc.next_batch(inc.pending(available(spark, sf_dir), consulted(spark, sf_dir)))


@query("has_pending", on_state("SELECT * FROM status"))
def _(spark, sf_dir):
    return status(spark, sf_dir)


@query("next_bairro", on_state("""
  SELECT (SELECT bairro FROM status WHERE tem_pendentes AND position >= 4 ORDER BY position LIMIT 1) AS bairro,
    (SELECT min(position) FROM status WHERE tem_pendentes AND position >= 4) AS bairro_atual_index,
    (SELECT count(*) FROM status) AS total_bairros
"""))
def _(spark, sf_dir):
    return inc.next_bairro(status(spark, sf_dir), 4)


@query("update_available", on_state("""
  SELECT bairro, place_id, list_pos FROM available WHERE bairro NOT IN ('NATION_1', 'NATION_5')
  UNION ALL SELECT n_name, 'ChIJ' || lpad(CAST(s_suppkey AS VARCHAR), 8, '0'), CAST(s_suppkey + 1 AS INT)
    FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE n_nationkey IN (1, 5)
"""))
def _(spark, sf_dir):
    found = _places(spark, sf_dir).filter("n_nationkey IN (1, 5)").select(
        F.col("n_name").alias("bairro"), place_of("s_suppkey").alias("place_id"),
        (F.col("s_suppkey") + 1).cast("int").alias("list_pos"))
    return inc.update_available(available(spark, sf_dir), found)


@query("add_consulted", on_state(f"""
  , batch AS (SELECT n_name AS bairro, 'ChIJ' || lpad(CAST(s_suppkey AS VARCHAR), 8, '0') AS place_id
      FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_suppkey % 2 = 0),
  u AS (SELECT bairro, place_id, '2001-12-01 00:00:00' AS t FROM consulted
    UNION ALL SELECT bairro, place_id, '{AS_OF}' FROM batch)
  SELECT bairro, place_id, max(t) AS data_ultima_consulta FROM u GROUP BY ALL
"""))
def _(spark, sf_dir):
    batch = _places(spark, sf_dir).filter("s_suppkey % 2 = 0").select(
        F.col("n_name").alias("bairro"), place_of("s_suppkey").alias("place_id"))
    once = inc.add_consulted(consulted(spark, sf_dir), batch, AS_OF)
    return inc.add_consulted(once, batch, AS_OF)


def _totals(spark, sf_dir):
    """Counters that earlier runs would have left, taken from the review table."""
    return table(spark, sf_dir, "lineitem").agg(
        F.count_distinct("l_suppkey").alias("total_agencias_processadas"),
        F.count(F.lit(1)).alias("total_comentarios_coletados"))


@query("mark_consulted", with_ctes(BRANCHES_SQL, """
  SELECT (SELECT count(DISTINCT l_suppkey) FROM lineitem) + (SELECT count(*) FROM branches)
      AS total_agencias_processadas,
    CAST((SELECT count(*) FROM lineitem) + (SELECT sum(n_reviews) FROM branches) AS BIGINT)
      AS total_comentarios_coletados,
    (SELECT count(DISTINCT place_id) FROM branches WHERE place_id IS NOT NULL) AS consultadas
"""))
def _(spark, sf_dir):
    nobody = spark.createDataFrame([], schemas.CONSULTED)
    done, totals = inc.mark_consulted(
        nobody, _totals(spark, sf_dir), branches(spark, sf_dir), AS_OF)
    return inc.beside(totals, done.agg(F.count(F.lit(1)).alias("consultadas")))


@query("progress_stats", on_state(f"""
  , n AS (SELECT min(position) AS i, (SELECT count(*) FROM status) AS total FROM status
      WHERE tem_pendentes AND position >= 4)
  SELECT CAST(i AS INT) AS bairro_atual_index, CAST(total AS INT) AS total_bairros,
    {round2(pct("i", "total"))} AS percentual_concluido, CAST(total - i AS INT) AS bairros_restantes,
    (SELECT bairro FROM status WHERE position = i) AS bairro_atual,
    (SELECT count(DISTINCT l_suppkey) FROM lineitem) AS total_agencias_processadas,
    (SELECT count(*) FROM lineitem) AS total_comentarios_coletados
  FROM n
"""))
def _(spark, sf_dir):
    return inc.progress_stats(status(spark, sf_dir), _totals(spark, sf_dir), 4)


@query("state_roundtrip", on_state("""
  SELECT bairro, disponiveis, consultadas, pendentes FROM status
"""))
def _(spark, sf_dir):
    root = scratch_path(spark, "state")
    first = inc.init_progress(spark, dim(spark, sf_dir))
    inc.write_state(first, root, 1)
    inc.write_state({**first, "available": available(spark, sf_dir),
                     "consulted": consulted(spark, sf_dir)}, root, 2)
    _, state = inc.read_state(spark, root)
    return inc.has_pending(state["dim"], state["available"], state["consulted"]).select(
        "bairro", "disponiveis", "consultadas", "pendentes")


# Landed days: one folder per neighbourhood and ship date.
LANDED_SQL = """
  landed AS (SELECT DISTINCT year(l_shipdate) AS y, month(l_shipdate) AS m, day(l_shipdate) AS d, lower(n_name) AS slug
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey),
  today AS (SELECT slug FROM landed WHERE y = 1998 AND m = 7 AND d = 10)
"""


def landed(spark, sf_dir):
    day = F.col("l_shipdate").cast("date")
    rows = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey")
    ).join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    return rows.select(
        F.year(day).alias("part_year"), F.month(day).alias("part_month"),
        F.dayofmonth(day).alias("part_day"), F.lower("n_name").alias("part_bairro"))


@query("skip_processed", with_ctes(LANDED_SQL, """
  SELECT n_name AS bairro, n_nationkey AS position FROM nation
  WHERE replace(lower(n_name), ' ', '_') NOT IN (SELECT slug FROM today)
"""))
def _(spark, sf_dir):
    return inc.skip_processed(dim(spark, sf_dir), landed(spark, sf_dir), "1998-07-10")


@query("processed_on", with_ctes(LANDED_SQL, """
  SELECT upper(slug[1:1]) || replace(slug[2:], '_', ' ') AS bairro FROM today
"""))
def _(spark, sf_dir):
    return inc.processed_on(landed(spark, sf_dir), "1998-07-10")


@query("day_stats", with_ctes(LANDED_SQL, """
  SELECT '1998-07-10' AS data, count(*) AS bairros_processados_hoje,
    string_agg(upper(slug[1:1]) || replace(slug[2:], '_', ' '), ','
      ORDER BY upper(slug[1:1]) || replace(slug[2:], '_', ' ')) AS lista_bairros_processados
  FROM today
"""))
def _(spark, sf_dir):
    return inc.day_stats(landed(spark, sf_dir), "1998-07-10")


@query("run_metadata", with_ctes(BRANCHES_SQL, """
  SELECT 'exec_1' AS run_id, 'coleta' AS task, 'success' AS status, '2001-12-31 10:00:00' AS started,
    90.5::DOUBLE AS seconds, count(place_id) AS valid_rows, count(*) AS total_rows,
    CAST(sum(n_reviews) AS BIGINT) AS total_reviews, 12 AS quota_utilizada, '' AS erros
  FROM branches
"""))
def _(spark, sf_dir):
    return inc.run_metadata(
        branches(spark, sf_dir), "exec_1", "coleta", "2001-12-31 10:00:00", "2001-12-31 10:01:30.5",
        quota_inicial=3, quota_final=15)


# --- governance --------------------------------------------------------------

@query("retention_bronze", on_bronze("""
  SELECT CASE WHEN CAST(data_coleta AS DATE) < DATE '2001-12-31' - INTERVAL 90 DAY THEN 'excluir' ELSE 'manter' END AS acao,
    count(*) AS total FROM bronze GROUP BY ALL
"""))
def _(spark, sf_dir):
    return gov.retention_summary(
        bronze(spark, sf_dir), "bronze", AS_OF, F.col("data_coleta").try_cast("date"))


@query("retention_silver_expired", on_silver("""
  SELECT place_id, 'AUTOR_' || upper(left(sha256(trim(lower(review_autor)) || 'sal-de-teste'), 8)) AS review_autor,
    texto_anonimizado AS texto_review, data_coleta
  FROM silver WHERE CAST(data_coleta AS DATE) < DATE '2001-12-31' - INTERVAL 730 DAY
"""))
def _(spark, sf_dir):
    _, expired = gov.apply_retention(
        silver(spark, sf_dir), "silver", AS_OF, F.col("data_coleta").try_cast("date"),
        salt="sal-de-teste")
    return expired.select("place_id", "review_autor", "texto_review", "data_coleta")


@query("retention_gold_kept", """
  SELECT strftime(o_orderdate, '%Y') AS ano, count(*) AS total FROM orders
  WHERE CAST(o_orderdate AS DATE) >= DATE '2001-12-31' - INTERVAL 1825 DAY GROUP BY ALL
""")
def _(spark, sf_dir):
    kept, _ = gov.apply_retention(
        table(spark, sf_dir, "orders"), "gold", AS_OF, F.col("o_orderdate").cast("date"))
    return kept.groupBy(F.date_format("o_orderdate", "yyyy").alias("ano")).agg(rows_total())


@query("retention_gold_aggregates", """
  SELECT CAST(year(o_orderdate) AS INT) AS ano, o_orderstatus, count(*) AS registros,
    sum(CAST(o_totalprice AS DECIMAL(18,2)))::DOUBLE AS o_totalprice
  FROM orders WHERE CAST(o_orderdate AS DATE) < DATE '2001-12-31' - INTERVAL 1825 DAY GROUP BY ALL
""")
def _(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(18,2)"))
    _, expired = gov.apply_retention(
        orders, "gold", AS_OF, F.col("o_orderdate").cast("date"), by=("o_orderstatus",), measures=("o_totalprice",))
    return expired.withColumn("o_totalprice", F.col("o_totalprice").cast("double"))


@query("reset_progress", """
  SELECT n_name AS bairro, 0::BIGINT AS disponiveis, 0::BIGINT AS consultadas FROM nation
""")
def _(spark, sf_dir):
    root = scratch_path(spark, "state")
    first = inc.init_progress(spark, dim(spark, sf_dir))
    inc.write_state({**first, "available": available(spark, sf_dir), "consulted": consulted(spark, sf_dir)}, root, 1)
    inc.reset_progress(spark, root, dim(spark, sf_dir))
    _, state = inc.read_state(spark, root)
    return inc.has_pending(state["dim"], state["available"], state["consulted"]).select(
        "bairro", F.col("disponiveis").cast("long").alias("disponiveis"), F.col("consultadas").cast("long").alias("consultadas"))


@query("audit_summary", on_silver(f"""
  SELECT '{AS_OF}' AS timestamp, 'bronze_to_silver' AS operation, 'silver' AS table_name,
    count(*) AS records_affected, count(*) FILTER (tem_pii) AS pii_detected,
    count(*) FILTER (tem_pii) > 0 AS anonymization_applied, 'system_automated' AS user,
    'compliant' AS compliance_status
  FROM silver
"""))
def _(spark, sf_dir):
    return gov.audit_summary(silver(spark, sf_dir), "bronze_to_silver", "silver", AS_OF)


@query("compliance_report", on_silver("""
  SELECT '2001-12' AS period, count(*) AS total_records, count(*) FILTER (tem_pii AND texto_anonimizado <> texto_review)
      AS pii_records_anonymized,
    CASE WHEN count(*) FILTER (tem_pii AND texto_anonimizado = texto_review) = 0 THEN 'COMPLIANT'
      ELSE 'NON_COMPLIANT' END AS compliance_status, '2002-03-31 00:00:00' AS next_review_date
  FROM silver
"""))
def _(spark, sf_dir):
    return gov.compliance_report(silver(spark, sf_dir), AS_OF)
