"""Streaming queries: each drains a stream over the given tables into files and reads them back."""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewlake.operators.bronze import to_bronze, normalize_landing
from reviewlake.queries import query, rows_total
from reviewlake.queries.control import LANDED_SQL, landed
from reviewlake.queries.fixtures import (
    AS_OF, BRANCHES_SQL, anonymized_sql, branches, label_sql, table, types_sql, with_ctes,
)
from reviewlake.session import scratch_path
from reviewlake.sources.landing import write_landing
from reviewlake.streaming import queue as wq
from reviewlake.streaming import reviews as sr

def _messages(spark, sf_dir):
    """A folder of queue messages, one per event; every seventh names no neighbourhood."""
    e = table(spark, sf_dir, "events").join(
        table(spark, sf_dir, "nation"), F.col("user_id") % 25 == F.col("n_nationkey"))
    messages = e.select(
        F.when(F.col("event_id") % 7 != 0, F.col("n_name")).alias("bairro"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
        F.lit("sequencial").alias("origem"),
        F.struct(
            F.col("n_nationkey").alias("bairro_atual_index"), F.lit(25).alias("total_bairros"),
            (F.col("n_nationkey") * 4).cast("double").alias("percentual_concluido"),
            (25 - F.col("n_nationkey")).alias("bairros_restantes")).alias("progresso"),
        F.when(F.col("event_id") % 5 == 0, (F.col("event_id") % 4).cast("int")).alias("tentativas"),
    )
    path = scratch_path(spark, "queue")
    wq.to_queue(messages).write.text(path)
    return wq.queue_source(spark, path)


MESSAGES_SQL = """
  q AS (SELECT n_name AS bairro, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS timestamp, n_nationkey,
    CASE WHEN event_id % 5 = 0 THEN CAST(event_id % 4 AS INT) END AS tentativas
    FROM events JOIN nation ON user_id % 25 = n_nationkey WHERE event_id % 7 <> 0)
"""


def _drained(spark, df, name):
    path = scratch_path(spark, name)
    sr.drain(df, path, scratch_path(spark, f"{name}-checkpoint"))
    return spark.read.schema(df.schema).parquet(path)


@query("stream_queue", with_ctes(MESSAGES_SQL, """
  SELECT bairro, timestamp, CAST(n_nationkey * 4 AS DOUBLE) AS percentual, count(*) AS total FROM q GROUP BY ALL
"""))
def _(spark, sf_dir):
    out = _drained(spark, wq.stream_queue(_messages(spark, sf_dir)), "consumed")
    return out.groupBy(
        "bairro", "timestamp", F.col("progresso.percentual_concluido").alias("percentual")
    ).agg(rows_total())


@query("stream_skip_processed", with_ctes(f"{MESSAGES_SQL}, {LANDED_SQL}", """
  SELECT bairro, count(*) AS total FROM q WHERE lower(bairro) NOT IN (SELECT slug FROM today) GROUP BY bairro
"""))
def _(spark, sf_dir):
    queued = wq.stream_queue(_messages(spark, sf_dir))
    left = wq.skip_processed_stream(queued, landed(spark, sf_dir), "1998-07-10")
    return _drained(spark, left, "todo").groupBy("bairro").agg(rows_total())


@query("stream_requeue", with_ctes(MESSAGES_SQL, """
  SELECT bairro, '2001-12-31T00:00:00.000000' AS timestamp_rejeicao, 'quota' AS motivo,
    coalesce(tentativas, 0) + 1 AS tentativas, count(*) AS total
  FROM q WHERE coalesce(tentativas, 0) + 1 < 3 GROUP BY ALL
"""))
def _(spark, sf_dir):
    rejected = wq.requeue(wq.stream_queue(_messages(spark, sf_dir)), "quota", AS_OF)
    retry, _ = wq.split_dead_letters(rejected, 3)
    path = scratch_path(spark, "retry")
    wq.publish(retry, path, scratch_path(spark, "retry-checkpoint")).awaitTermination()
    back = spark.read.schema("value string").text(path).select(
        F.from_json("value", "bairro string, timestamp_rejeicao string, motivo string, tentativas int")
        .alias("m")).select("m.*")
    return back.groupBy(*back.columns).agg(rows_total())


@query("stream_dead_letters", with_ctes(MESSAGES_SQL, """
  SELECT bairro, '2001-12-31T00:00:00.000000' AS timestamp_rejeicao, 'quota' AS motivo,
    coalesce(tentativas, 0) + 1 AS tentativas, count(*) AS total
  FROM q WHERE coalesce(tentativas, 0) + 1 >= 3 GROUP BY ALL
"""))
def _(spark, sf_dir):
    rejected = wq.requeue(wq.stream_queue(_messages(spark, sf_dir)), "quota", AS_OF)
    path = scratch_path(spark, "rejected")
    retry, dead = wq.publish_rejected(rejected, path, scratch_path(spark, "rejected-checkpoint"), 3)
    retry.awaitTermination()
    dead.awaitTermination()
    back = spark.read.schema("value string").text(f"{path}/{wq.DEAD_LETTERS}").select(
        F.from_json("value", "bairro string, timestamp_rejeicao string, motivo string, tentativas int")
        .alias("m")).select("m.*")
    return back.groupBy(*back.columns).agg(rows_total())


@query("stream_publish_progress", with_ctes(MESSAGES_SQL, """
  SELECT bairro, n_nationkey AS bairro_atual_index, count(*) AS total FROM q GROUP BY ALL
"""))
def _(spark, sf_dir):
    queued = wq.stream_queue(_messages(spark, sf_dir)).select(
        F.col("bairro").alias("bairro_atual"), "progresso.*")
    announced = wq.progress_messages(queued, AS_OF)
    path = scratch_path(spark, "announced")
    wq.publish(announced, path, scratch_path(spark, "announced-checkpoint")).awaitTermination()
    from reviewlake.functions.jsonio import parse_message

    back = spark.read.schema("value string").text(path).select(parse_message(F.col("value")).alias("m"))
    return back.groupBy(
        F.col("m.bairro").alias("bairro"),
        F.col("m.progresso.bairro_atual_index").alias("bairro_atual_index")
    ).agg(rows_total())


def _landing_folder(spark, sf_dir):
    path = scratch_path(spark, "landing")
    write_landing(branches(spark, sf_dir), path, "exec", AS_OF)
    return path


def _stream_bronze(spark, sf_dir):
    landing = sr.landing_stream(spark, _landing_folder(spark, sf_dir))
    return sr.stream_reviews(landing, AS_OF, key="sha256")


def _phrases():
    from reviewlake.queries.fixtures import PHRASES, sql_text

    return ", ".join(f"({i}, {sql_text(p)})" for i, p in enumerate(PHRASES))


STREAMED_SQL = BRANCHES_SQL + f""",
phrases(phrase_id, texto) AS (VALUES {_phrases()}),
r AS (SELECT b.*, CAST(i AS INT) AS i, coalesce(p.texto, '') AS review_text
  FROM branches b, range(1, 14) t(i) JOIN phrases p ON (b.s_suppkey + i) % 24 = p.phrase_id
  WHERE i <= b.n_reviews AND b.place_id IS NOT NULL)
"""


@query("stream_reviews", with_ctes(STREAMED_SQL, """
  SELECT place_id, bairro AS bairro_pesquisado, 'Autor ' || i AS author_name, i % 6 AS review_rating, review_text,
    s_suppkey * 1000 + i AS review_time FROM r
"""))
def _(spark, sf_dir):
    return _drained(spark, _stream_bronze(spark, sf_dir), "bronze").select(
        "place_id", "bairro_pesquisado", "author_name", "review_rating", "review_text", "review_time")


@query("stream_sentiment", with_ctes(STREAMED_SQL, f"""
  SELECT place_id, review_text AS texto_review, {label_sql("review_text")} AS sentimento,
    {types_sql("review_text")} AS tipos_pii_detectados, {anonymized_sql("review_text")} AS texto_anonimizado,
    count(*) AS total
  FROM r WHERE trim(review_text) <> '' GROUP BY ALL
"""))
def _(spark, sf_dir):
    out = _drained(spark, sr.stream_sentiment(_stream_bronze(spark, sf_dir), AS_OF), "silver")
    keys = ["place_id", "texto_review", "sentimento", "tipos_pii_detectados", "texto_anonimizado"]
    return out.groupBy(*keys).agg(rows_total())


@query("stream_quality_alerts", with_ctes(STREAMED_SQL, f"""
  , s AS (SELECT place_id, bairro, {label_sql("review_text")} AS sentimento, i % 6 AS nota,
      {types_sql("review_text")} <> '' AS pii, length(review_text) > 10 AS longo
    FROM r WHERE trim(review_text) <> ''),
  a AS (SELECT *, concat_ws(',', CASE WHEN NOT longo THEN 'qualidade_baixa' END,
      CASE WHEN pii THEN 'pii_detectado' END,
      CASE WHEN sentimento = 'negativo' AND nota <= 2 THEN 'avaliacao_critica' END) AS motivos FROM s)
  SELECT place_id, bairro, sentimento, motivos, count(*) AS total FROM a WHERE motivos <> '' GROUP BY ALL
"""))
def _(spark, sf_dir):
    silver = sr.stream_sentiment(_stream_bronze(spark, sf_dir), AS_OF)
    out = _drained(spark, sr.quality_alerts(silver), "alerts")
    return out.groupBy("place_id", "bairro", "sentimento", "motivos").agg(rows_total())


@query("stream_drop_replays", with_ctes(STREAMED_SQL, """
  SELECT count(DISTINCT (place_id, i, review_text)) AS total FROM r
"""))
def _(spark, sf_dir):
    path = _landing_folder(spark, sf_dir)
    write_landing(branches(spark, sf_dir), path, "replay", AS_OF)
    bronze = sr.stream_reviews(sr.landing_stream(spark, path, max_files=10), AS_OF)
    return _drained(spark, sr.drop_replays(bronze), "once").agg(rows_total())


@query("stream_rows_in_batches", with_ctes(STREAMED_SQL, """
  SELECT place_id, 'Autor ' || i AS author_name, review_text, s_suppkey * 1000 + i AS review_time,
    count(*) AS total FROM r GROUP BY ALL
"""))
def _(spark, sf_dir):
    """Every review of several micro-batches once, replays dropped, some without a time."""
    path = _landing_folder(spark, sf_dir)
    write_landing(branches(spark, sf_dir), path, "replay", AS_OF)
    bronze = sr.stream_reviews(sr.landing_stream(spark, path, max_files=10), AS_OF)
    keys = ["place_id", "author_name", "review_text", "review_time"]
    return _drained(spark, sr.drop_replays(bronze), "once").groupBy(*keys).agg(rows_total())


@query("batch_equals_stream", with_ctes(STREAMED_SQL, "SELECT CAST(0 AS BIGINT) AS diferencas"))
def _(spark, sf_dir):
    from reviewlake.sources.landing import read_landing

    path = _landing_folder(spark, sf_dir)
    stream = _drained(spark, sr.stream_reviews(
        sr.landing_stream(spark, path), AS_OF), "bronze")
    batch = to_bronze(normalize_landing(read_landing(spark, path), AS_OF), AS_OF)
    columns = batch.columns

    def tagged(df, sign):
        return df.select(*columns, F.lit(sign).alias("_n"))

    # Multiset difference in one grouping: every row must cancel out.
    cancelled = tagged(batch, 1).unionByName(tagged(stream, -1)).groupBy(*columns).agg(
        F.sum("_n").alias("_n"))
    return cancelled.agg(F.coalesce(F.sum(F.abs("_n")), F.lit(0).cast("bigint")).alias("diferencas"))
