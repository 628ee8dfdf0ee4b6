"""Queue and review streams over small folders."""

import json

from pyspark.sql import functions as F

from reviewlake.streaming import queue as wq
from reviewlake.streaming import reviews as sr
from test_landing import AS_OF, branch, envelope, put, review


def drain(spark, df, tmp_path, name):
    out = str(tmp_path / name)
    sr.drain(df, out, str(tmp_path / f"{name}-checkpoint"))
    return spark.read.schema(df.schema).parquet(out)


def messages(folder, *docs):
    folder.mkdir(parents=True, exist_ok=True)
    for i, doc in enumerate(docs):
        text = doc if isinstance(doc, str) else json.dumps(doc, ensure_ascii=False)
        (folder / f"{len(list(folder.iterdir()))}-{i}.txt").write_text(text + "\n", encoding="utf-8")


def test_queue_drops_messages_without_a_neighbourhood(spark, tmp_path):
    messages(tmp_path / "q", {"bairro": "Moema"}, {"bairro": ""}, {"x": 1}, "not json", {"bairro": "Lapa"})
    out = drain(spark, wq.stream_queue(wq.queue_source(spark, str(tmp_path / "q"))), tmp_path, "out")
    assert sorted(r["bairro"] for r in out.collect()) == ["Lapa", "Moema"]


def test_queue_resumes_after_restart(spark, tmp_path):
    source = tmp_path / "q"
    messages(source, {"bairro": "Moema"})
    stream = lambda: wq.stream_queue(wq.queue_source(spark, str(source)))
    assert drain(spark, stream(), tmp_path, "out").count() == 1
    messages(source, {"bairro": "Lapa"})
    assert drain(spark, stream(), tmp_path, "out").count() == 2


def test_requeue_counts_attempts_and_dead_letters(spark):
    queue = spark.createDataFrame([("A", None), ("B", 1), ("C", 2)], "bairro string, tentativas int")
    retry, dead = wq.split_dead_letters(wq.requeue(queue, "quota", AS_OF), 3)
    assert {(r["bairro"], r["tentativas"]) for r in retry.collect()} == {("A", 1), ("B", 2)}
    assert [(r["bairro"], r["tentativas"], r["motivo"]) for r in dead.collect()] == [("C", 3, "quota")]
    again = wq.requeue(spark.createDataFrame([("A",)], "bairro string"), "x", AS_OF).first()
    assert again["tentativas"] == 1


def test_replayed_reviews_are_dropped_once(spark, tmp_path):
    doc = envelope("Moema", [branch("P1", reviews=[
        review(), review(), review(text="Outro texto ruim"), review(time=1640995201)])])
    put(tmp_path / "l", "a.json", doc)
    put(tmp_path / "l", "b.json", doc)
    bronze = sr.stream_reviews(sr.landing_stream(spark, str(tmp_path / "l")), AS_OF)
    assert drain(spark, bronze, tmp_path, "all").count() == 8
    once = sr.drop_replays(sr.stream_reviews(sr.landing_stream(spark, str(tmp_path / "l")), AS_OF))
    assert drain(spark, once, tmp_path, "once").count() == 3


def test_stream_alerts(spark, tmp_path):
    put(tmp_path / "l", "a.json", envelope("Moema", [branch("P1", reviews=[
        review(), review(text="ok"), review(text="Péssimo atendimento", rating=1),
        review(text="Excelente, ligue 11 98888-7777")])]))
    silver = sr.stream_sentiment(sr.stream_reviews(sr.landing_stream(spark, str(tmp_path / "l")), AS_OF), AS_OF)
    out = drain(spark, sr.quality_alerts(silver), tmp_path, "alerts")
    assert sorted(tuple(r["motivos"]) for r in out.collect()) == [
        ("avaliacao_critica",), ("pii_detectado",), ("qualidade_baixa",)]


def test_progress_message_shape(spark):
    row = spark.createDataFrame(
        [("Moema", 3, 52, 5.77, 49)], "bairro_atual string, bairro_atual_index int, total_bairros int, "
        "percentual_concluido double, bairros_restantes int")
    text = wq.to_queue(wq.progress_messages(row, AS_OF)).first()["value"]
    assert json.loads(text) == {
        "bairro": "Moema", "timestamp": "2025-07-02T12:00:00.000000", "origem": "sequencial",
        "progresso": {"bairro_atual_index": 3, "total_bairros": 52, "percentual_concluido": 5.77,
                      "bairros_restantes": 49}}
    parsed = spark.createDataFrame([(text,)], "value string").select(
        F.from_json("value", "bairro string").alias("m")).first()
    assert parsed["m"]["bairro"] == "Moema"


def test_old_and_timeless_reviews_are_no_replays(spark, tmp_path):
    now = 1640995200
    docs = [review(time=now), review(time=now + 100), review(time=now - 3 * 365 * 86400), review(text="Sem hora", time=None),
            review(time=now), review(text="Sem hora", time=None)]
    for i, one in enumerate(docs):
        put(tmp_path / "l", f"{i}.json", envelope("Moema", [branch("P1", reviews=[one])]))
    landing = sr.landing_stream(spark, str(tmp_path / "l"), max_files=1)
    out = drain(spark, sr.drop_replays(sr.stream_reviews(landing, AS_OF)), tmp_path, "once")
    assert sorted(r["review_time"] for r in out.collect()) == sorted([now, now + 100, now - 3 * 365 * 86400, 0])
