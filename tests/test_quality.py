"""Scores, validation, gates and reports on hand-made branches."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from reviewlake import schemas
from reviewlake.operators import quality as q

SCHEMA = "bairro string, list_pos int, " + ", ".join(
    f"{f.name} {f.dataType.simpleString()}" for f in schemas.BRANCH.fields)


def row(bairro, pos, place="P", rating=4.0, lat=-23.5, types=("bank",), reviews=1, address="Rua"):
    return (bairro, pos, place and f"{place}{pos}", "n", address, None, rating, 1, "OK",
            list(types) if types is not None else None,
            {"location": {"lat": lat, "lng": -46.6}} if lat is not None else None,
            [("a", 5, "t", 1, None)] * reviews)


@pytest.fixture(scope="module")
def branches(spark):
    rows = [row("Bom", i) for i in range(10)]
    rows += [row("Ruim", 0, rating=9.0), row("Ruim", 1, address="", types=()),
             row("Ruim", 2, place=None, rating=None, lat=0.0, reviews=0)]
    rows += [row("Cheio", i) for i in range(51)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def validated(spark, branches):
    expected = spark.createDataFrame([("Bom",), ("Ruim",), ("Cheio",), ("Vazio",)], "bairro string")
    return q.validate_bairros(branches, expected=expected).cache()


def test_scores(validated):
    got = {r["bairro"]: r for r in validated.collect()}
    assert got["Bom"]["score_qualidade"] == 1.0 and got["Bom"]["aprovado"]
    assert got["Bom"]["recomendacoes"] == []
    # Four critical problems, 2 of 3 rated, 1 of 3 without coordinates.
    expected = 1.0 - 4 * 0.15 + (2 / 3 * 100) / 100 * 0.2 - (1 / 3) * 0.3
    assert got["Ruim"]["score_qualidade"] == pytest.approx(expected)
    assert not got["Ruim"]["aprovado"] and got["Ruim"]["problemas_criticos"] == 4
    assert got["Ruim"]["recomendacoes"] == ["Muitas agências sem coordenadas - verificar geocoding"]
    assert got["Cheio"]["problemas_menores"] == 1 and got["Cheio"]["score_qualidade"] == 1.0
    assert got["Vazio"]["total_agencias"] == 0 and got["Vazio"]["problemas_menores"] == 1
    assert got["Vazio"]["score_qualidade"] == 0.95


def test_extended_recommendations(spark, branches):
    expected = spark.createDataFrame([("Ruim",), ("Vazio",), ("Cheio",)], "bairro string")
    got = {r["bairro"]: r["recomendacoes"] for r in q.validate_bairros(
        branches, expected=expected, extended=True).collect()}
    assert got["Ruim"] == [
        "Muitas agências sem coordenadas - verificar processo de geocoding",
        "Campos obrigatórios ausentes - verificar mapeamento da API",
        "Ratings inválidos detectados - verificar validação de dados"]
    assert got["Vazio"][1] == "Nenhuma agência encontrada - revisar query de busca e filtros"
    assert got["Cheio"] == [
        "Muitas agências encontradas - refinar filtros para evitar resultados irrelevantes"]


def test_problem_rows_are_whole(branches, validated):
    got = sorted((r["bairro"], r["posicao"], r["problema"])
                 for r in q.problem_rows(branches, validated).collect())
    assert got == sorted([
        ("Ruim", 1, "Agência 1: rating inválido (9.0)"),
        ("Ruim", 2, "Agência 2: campo 'formatted_address' ausente ou vazio"),
        ("Ruim", 2, "Agência 2: campo 'types' ausente ou vazio"),
        ("Ruim", 3, "Agência 3: campo 'place_id' ausente ou vazio"),
        ("Cheio", 0, "Muitas agências encontradas (51), verificar filtros"),
        ("Vazio", 0, "Menos de 1 agências encontradas"),
    ])


def test_integrity_and_report(branches, validated):
    report = q.integrity_report(validated, "2025-07-01")
    r = report.first()
    assert (r["total_bairros"], r["bairros_validos"], r["status"]) == (4, 3, "bom")
    assert r["total_agencias"] == 64 and r["total_reviews"] == 63
    lines = [x["linha"] for x in q.report_lines(
        report, validated, q.problem_rows(branches, validated)).orderBy("secao", "chave", "item").collect()]
    assert lines[0] == "=== RELATÓRIO DE QUALIDADE - 2025-07-01 ==="
    assert "  • Bairros válidos: 3 (75.0%)" in lines
    assert "     - Agência 1: rating inválido (9.0)" in lines
    assert not any("Cheio" in x for x in lines)


def test_report_without_data(validated, branches):
    none = validated.filter("false")
    report = q.integrity_report(none, "2025-07-01")
    assert report.first()["status"] == "sem_dados"
    lines = q.report_lines(report, none, q.problem_rows(branches.filter("false"), none)).collect()
    assert any("Nenhum dado encontrado" in x["linha"] for x in lines)


@pytest.mark.parametrize("share,status", [(10, "excelente"), (7, "bom"), (5, "aceitavel"), (4, "problematico")])
def test_status_ladder(spark, share, status):
    rows = [(f"b{i}", 1, 1, 1.0 if i < share else 0.0, i < share) for i in range(10)]
    df = spark.createDataFrame(rows, "bairro string, total_agencias long, total_reviews long, "
                                     "score_qualidade double, aprovado boolean")
    assert q.integrity_report(df, "2025-07-01").first()["status"] == status


def test_gate(validated):
    good = validated.filter("bairro = 'Bom'")
    assert q.quality_gate(good).count() == 1
    with pytest.raises(PySparkException, match="abaixo do limite"):
        q.quality_gate(validated).count()
    # Also when the score itself is not selected.
    with pytest.raises(PySparkException):
        q.quality_gate(validated).select("bairro").collect()


def test_completeness(branches):
    got = {r["bairro"]: r["completeness_score"] for r in q.completeness(branches).collect()}
    assert got["Bom"] == 5 / 6 and got["Ruim"] == (5 + 4 + 2) / 18


def test_thresholds(spark):
    metrics = spark.createDataFrame(
        [("completude", 95.0), ("unicidade", 100.0), ("range", 98.5), ("formato", 10.0), ("outra", 1.0)],
        "metrica string, percentual double")
    got = {r["metrica"]: r["acao"] for r in q.evaluate_thresholds(metrics).collect()}
    assert got == {"completude": "alerta", "unicidade": "nenhuma", "range": "nenhuma", "formato": "alerta"}


def test_violations_on_empty_input(spark):
    empty = spark.createDataFrame([], schemas.BRONZE)
    assert all(r["violacoes"] == 0 and r["percentual_ok"] == 100.0
               for r in q.range_violations(empty).collect())
    assert q.uniqueness(empty, ["place_id"]).first()["total"] == 0


def test_orphans(spark):
    child = spark.createDataFrame([("a",), ("a",), ("b",)], "k string")
    parent = spark.createDataFrame([("b",), ("b",)], "k string")
    assert [tuple(r) for r in q.orphans(child, parent, ["k"]).collect()] == [("a", 2)]


def test_temporal_order_with_processing_time(spark):
    df = spark.createDataFrame(
        [(0, "1970-01-01", "1970-01-02", "1970-01-02 00:00:00", "1970-01-01 00:00:00")],
        "review_time long, data_coleta string, d string, b string, s string").select(
        "review_time", "data_coleta", F.col("d").cast("date").alias("bronze_ingestion_date"),
        F.col("b").cast("timestamp").alias("bronze_ingestion_timestamp"),
        F.col("s").cast("timestamp").alias("silver_processing_timestamp"))
    got = {r["coluna"]: r["violacoes"] for r in q.temporal_violations(df).collect()}
    assert got == {"review_time": 0, "bronze_ingestion_date": 0, "silver_processing_timestamp": 1}
