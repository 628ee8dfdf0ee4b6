"""The neighbourhood work queue as a stream of JSON messages."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from reviewlake.functions.dates import as_of_timestamp
from reviewlake.functions.jsonio import parse_message, to_message
from reviewlake.functions.text import slug
from reviewlake.operators.incremental import landed_on

TOPIC = "bairros_sp"


def queue_source(spark: SparkSession, path: str | None = None, kafka: dict | None = None,
                 max_files: int | None = None) -> DataFrame:
    """A stream of raw ``value`` strings from a folder of text files, or from Kafka.

    Kafka needs its connector on the classpath; options such as the bootstrap
    servers are passed through, and reading starts at the earliest offset.
    """
    if kafka is not None:
        options = {"subscribe": TOPIC, "startingOffsets": "earliest", **kafka}
        return spark.readStream.format("kafka").options(**options).load().select(
            F.col("value").cast("string").alias("value"))
    reader = spark.readStream.schema("value string").format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def stream_queue(messages: DataFrame) -> DataFrame:
    """Parse messages and drop those that name no neighbourhood."""
    parsed = messages.select(parse_message(F.col("value")).alias("m")).select("m.*")
    return parsed.filter(F.coalesce(F.col("bairro"), F.lit("")) != "")


def skip_processed_stream(queue: DataFrame, landed: DataFrame, as_of: str | None) -> DataFrame:
    """Stream-static anti join: drop neighbourhoods already landed that day."""
    done = landed_on(landed, as_of).withColumnRenamed("slug", "_slug")
    return queue.withColumn("_slug", slug(F.col("bairro"))).join(
        done, "_slug", "left_anti").drop("_slug")


def progress_messages(next_row: DataFrame, as_of: str | None) -> DataFrame:
    """The message that announces the neighbourhood to work on, from ``progress_stats``."""
    stamp = F.date_format(as_of_timestamp(as_of), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return next_row.select(
        F.col("bairro_atual").alias("bairro"), stamp.alias("timestamp"),
        F.lit("sequencial").alias("origem"),
        F.struct("bairro_atual_index", "total_bairros", "percentual_concluido",
                 "bairros_restantes").alias("progresso"),
    )


def to_queue(df: DataFrame) -> DataFrame:
    return to_message(df)


def requeue(queue: DataFrame, motivo: str, as_of: str | None) -> DataFrame:
    """Rejected messages, their attempt counter raised by one."""
    stamp = F.date_format(as_of_timestamp(as_of), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    tried = F.coalesce(F.col("tentativas"), F.lit(0)) if "tentativas" in queue.columns else F.lit(0)
    return queue.select(
        "bairro", stamp.alias("timestamp_rejeicao"), F.lit(motivo).alias("motivo"),
        (tried + 1).alias("tentativas"),
    )


def split_dead_letters(rejected: DataFrame, max_attempts: int = 3) -> tuple[DataFrame, DataFrame]:
    """``(retry, dead)``: what goes back to the queue and what has been tried enough."""
    spent = F.col("tentativas") >= max_attempts
    return rejected.filter(~spent), rejected.filter(spent)


DEAD_LETTERS = "mortas"


def publish_rejected(rejected: DataFrame, path: str, checkpoint: str, max_attempts: int = 3):
    """Start writing rejected messages: ``(retry, dead)`` queries into the folders ``fila`` and ``mortas``."""
    retry, dead = split_dead_letters(rejected, max_attempts)
    return tuple(publish(df, f"{path}/{name}", f"{checkpoint}/{name}")
                 for df, name in ((retry, "fila"), (dead, DEAD_LETTERS)))


#: What the retry state holds per neighbourhood, and what a step says of each message.
ATTEMPTS, VERDICT = "tentativas int", "bairro string, destino string, tentativas int"


def attempts(queue: DataFrame, rejected: Column, max_attempts: int = 3, forget: str = "30 days") -> DataFrame:
    """One verdict per neighbourhood and trigger: ``aceita``, ``fila`` (to be tried again) or ``mortas``.

    Attempts are counted in keyed state, whatever the messages say of them: a
    rejection counts one, acceptance or the last attempt ends the count, and so does
    ``forget`` without a message. Messages of one neighbourhood in one trigger are one attempt.
    """
    limit_ms = int(pd.Timedelta(forget).total_seconds() * 1000)

    def judge(key, parts, state):
        if state.hasTimedOut:
            state.remove()
            return
        bad = False
        for part in parts:
            bad = bad or bool(part["_bad"].any())
        tried = (state.get[0] if state.exists else 0) + 1
        where = "aceita" if not bad else DEAD_LETTERS if tried >= max_attempts else "fila"
        if where == "fila":
            state.update((tried,))
            state.setTimeoutDuration(limit_ms)
        elif state.exists:
            state.remove()
        yield pd.DataFrame({"bairro": [key[0]], "destino": [where], "tentativas": [tried]})

    flagged = queue.select("bairro", F.coalesce(rejected, F.lit(False)).alias("_bad"))
    return flagged.groupBy("bairro").applyInPandasWithState(
        judge, VERDICT, ATTEMPTS, "append", GroupStateTimeout.ProcessingTimeTimeout)


def retry_step(spark: SparkSession, root: str, rejected: Column, as_of: str | None, motivo: str = "rejeitada",
               max_attempts: int = 3, forget: str = "30 days"):
    """One trigger of the retry loop over the folders of ``root``; returns the query, drained.

    New messages come from ``entrada`` and, rejected before, from ``fila``; the step
    writes ``fila``, ``mortas`` and ``aceitas``. A batch that runs again after a
    failure replaces its own files, so nothing is queued twice.
    """
    messages = stream_queue(queue_source(spark, f"{root}/{{entrada,fila}}/*"))

    def deliver(batch: DataFrame, number: int) -> None:
        held = batch.persist()
        for name in ("aceita", "fila", DEAD_LETTERS):
            some = held.filter(F.col("destino") == name)
            if not some.isEmpty():
                folder = "aceitas" if name == "aceita" else name
                told = some.withColumn("tentativas", F.col("tentativas") - 1) if name != "aceita" else some
                told = requeue(told, motivo, as_of) if name != "aceita" else some.select("bairro")
                to_queue(told).write.mode("overwrite").text(f"{root}/{folder}/lote={number}")
        held.unpersist()

    query = (attempts(messages, rejected, max_attempts, forget).writeStream.foreachBatch(deliver)
             # One batch: with time-outs in state, a query that drains its source would never find an end.
             .option("checkpointLocation", f"{root}/_controle").trigger(once=True).start())
    query.awaitTermination()
    return query


def publish(df: DataFrame, path: str, checkpoint: str, kafka: dict | None = None):
    """Start writing messages to a folder of text files, or to Kafka, and stop when drained."""
    writer = to_queue(df).writeStream.option("checkpointLocation", checkpoint)
    if kafka is not None:
        writer = writer.format("kafka").options(**kafka)
    else:
        writer = writer.format("text").option("path", path)
    return writer.outputMode("append").trigger(availableNow=True).start()
