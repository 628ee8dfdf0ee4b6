"""Progress state, queue selection and governance."""

import pytest
from pyspark.sql import functions as F

from reviewlake import schemas
from reviewlake.functions import rules
from reviewlake.operators import governance as gov
from reviewlake.operators import incremental as inc

AS_OF = "2025-07-01 10:00:00"


@pytest.fixture
def state(spark):
    dim = spark.createDataFrame([(0, "A"), (1, "B"), (2, "C"), (3, "D")], "position int, bairro string")
    available = spark.createDataFrame(
        [("A", "a1", 0), ("A", "a2", 1), ("A", "a3", 2), ("B", "b1", 0)], schemas.PROGRESS)
    consulted = spark.createDataFrame([("A", "a1"), ("B", "b1"), ("C", "c1")], "bairro string, place_id string")
    consulted = consulted.withColumn("data_ultima_consulta", F.lit(None).cast("timestamp"))
    totals = spark.createDataFrame([(3, 30)], schemas.TOTALS)
    return {"dim": dim, "available": available, "consulted": consulted, "totals": totals}


def test_pending_rules(state):
    got = {r["bairro"]: r["tem_pendentes"] for r in inc.has_pending(
        state["dim"], state["available"], state["consulted"]).collect()}
    # Something left; all done; consulted without a list; never visited.
    assert got == {"A": True, "B": False, "C": False, "D": True}


def test_next_batch_follows_list_order(state):
    batch = inc.next_batch(inc.pending(state["available"], state["consulted"]), 2)
    assert [r["place_id"] for r in batch.orderBy("ordem").collect()] == ["a2", "a3"]


def test_next_bairro_and_stats(state):
    status = inc.has_pending(state["dim"], state["available"], state["consulted"])
    assert inc.next_bairro(status, 0).first()["bairro"] == "A"
    assert inc.next_bairro(status, 1).first()["bairro"] == "D"
    stats = inc.progress_stats(status, state["totals"], 1).first()
    assert (stats["bairro_atual_index"], stats["percentual_concluido"], stats["bairros_restantes"]) == (3, 75.0, 1)
    assert stats["total_comentarios_coletados"] == 30
    done = status.withColumn("tem_pendentes", F.lit(False))
    end = inc.progress_stats(done, state["totals"]).first()
    assert (end["bairro_atual"], end["bairro_atual_index"], end["bairros_restantes"]) == ("CONCLUÍDO", 4, 0)


def test_mark_is_idempotent_on_places(spark, state):
    batch = spark.createDataFrame(
        [("A", "a2", [1, 2]), ("A", None, [3])], "bairro string, place_id string, reviews array<int>")
    consulted, totals = inc.mark_consulted(state["consulted"], state["totals"], batch, AS_OF)
    again = inc.add_consulted(consulted, batch, AS_OF)
    assert sorted(consulted.collect()) == sorted(again.collect()) and again.count() == 4
    assert tuple(totals.first()) == (5, 33)


def test_update_available_replaces_one_list(spark, state):
    found = spark.createDataFrame([("A", "a9", 0), ("A", "", 1)], schemas.PROGRESS)
    got = {(r["bairro"], r["place_id"]) for r in inc.update_available(state["available"], found).collect()}
    assert got == {("A", "a9"), ("B", "b1")}


def test_versions_and_reset(spark, state, tmp_path):
    root = str(tmp_path / "state")
    inc.write_state(inc.init_progress(spark, state["dim"]), root, 1)
    inc.write_state(state, root, 2)
    version, current = inc.read_state(spark, root)
    assert version == 2 and current["available"].count() == 4
    # A version that was written but never recorded is not seen.
    state["available"].write.parquet(f"{root}/v00000003/available")
    assert inc.read_state(spark, root)[0] == 2
    inc.reset_progress(spark, root, state["dim"])
    version, current = inc.read_state(spark, root)
    assert version == 3 and current["available"].count() == 0


def test_dimension(spark):
    dim = inc.bairro_dimension(spark)
    assert dim.count() == len(rules.BAIRROS) == 52
    status = inc.has_pending(dim, *[inc.init_progress(spark)[k] for k in ("available", "consulted")])
    assert inc.next_bairro(status).first()["bairro"] == "Vila Madalena"


def test_skip_processed(spark):
    landed = spark.createDataFrame(
        [(2025, 7, 1, "vila_madalena"), (2025, 6, 30, "moema")],
        "part_year int, part_month int, part_day int, part_bairro string")
    queue = spark.createDataFrame([("Vila Madalena",), ("Moema",)], "bairro string")
    assert [r[0] for r in inc.skip_processed(queue, landed, AS_OF).collect()] == ["Moema"]
    assert [r[0] for r in inc.processed_on(landed, AS_OF).collect()] == ["Vila Madalena"]
    stats = inc.day_stats(landed, AS_OF).first()
    assert (stats["data"], stats["bairros_processados_hoje"]) == ("2025-07-01", 1)


def test_run_metadata(spark):
    rows = spark.createDataFrame([("p", [1, 2]), (None, None)], "place_id string, reviews array<int>")
    r = inc.run_metadata(rows, "r1", "coleta", "2025-07-01 10:00:00", "2025-07-01 10:00:30", 1, 4, ["x"]).first()
    assert (r["status"], r["seconds"], r["valid_rows"], r["total_rows"], r["total_reviews"]) == (
        "failed", 30.0, 1, 2, 2)
    assert r["quota_utilizada"] == 3 and r["erros"] == ["x"]


def test_retention_boundaries(spark):
    days = spark.createDataFrame(
        [("2025-04-02",), ("2025-04-01",), (None,)], "d string").withColumn("d", F.col("d").cast("date"))
    kept, expired = gov.apply_retention(days, "bronze", AS_OF, F.col("d"))
    assert kept.count() == 2 and [str(r[0]) for r in expired.collect()] == ["2025-04-01"]
    with pytest.raises(ValueError):
        gov.apply_retention(days, "silver", AS_OF, F.col("d"))


def test_audit_lineage_classification(spark):
    audit = gov.audit_row(spark, "op", "silver", {"records_affected": 5, "pii_detected": 1}, AS_OF)
    assert [f.name for f in audit.schema] == schemas.AUDIT.fieldNames()
    assert audit.first()["anonymization_applied"]
    a, b = (gov.lineage_row(spark, "bronze", "silver", "t", AS_OF).first() for _ in range(2))
    assert a == b and len(a["lineage_id"]) == 64
    df = spark.createDataFrame([("p", "a", 1)], "place_id string, author_name string, x int")
    classes = {r["coluna"]: r["classe"] for r in gov.classify(df).collect()}
    assert classes == {"place_id": "Não pessoal", "author_name": "Dado pessoal", "x": "Não classificado"}
    assert gov.tag_columns(df).schema["author_name"].metadata["sensibilidade"] == "Média"
