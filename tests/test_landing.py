"""Landing documents in both layouts, Bronze, layers, catalog and the whole flow."""

import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from reviewlake import schemas
from reviewlake.operators import bronze as br
from reviewlake.operators.gold import GOLD_TABLES, silver_rollup
from reviewlake.operators.quality import schema_diff
from reviewlake.operators.silver import to_silver
from reviewlake.plans.medallion import run_medallion
from reviewlake.sources import catalog, landing as landing_source, layers
from reviewlake.sources.landing import read_landing, write_landing

AS_OF = "2025-07-02 12:00:00"


def review(**fields):
    return {"author_name": "Ana", "rating": 5, "text": "Excelente agência", "time": 1640995200, **fields}


def branch(place, **fields):
    return {
        "place_id": place, "name": f"Agência {place}", "formatted_address": "Rua A", "rating": 4,
        "user_ratings_total": 10, "types": ["bank"],
        "geometry": {"location": {"lat": -23.5, "lng": -46.6}}, "reviews": [review()], **fields,
    }


def envelope(bairro, branches, date="2025-07-01T10:00:00.123456"):
    return {
        "execution_metadata": {"run_id": "r", "execution_date": date, "bairro": bairro},
        "raw_data": {"agencias": branches}, "schema_version": "v1.0", "created_at": date,
    }


def put(folder, name, doc):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps(doc, ensure_ascii=False, indent=2), encoding="utf-8")


@pytest.fixture
def landing(tmp_path):
    base = tmp_path / "landing"
    day = "year=2025/month=07/day=01/bairro="
    put(base, f"{day}pinheiros/a.json", envelope("Pinheiros", [
        branch("P1"),
        branch("P2", reviews=[
            review(author_name=None, rating=None, text=None, time=None),
            review(text="Péssimo", relative_time_description="há um mês", extra=1)]),
        branch("P3", reviews=[]),
        {k: v for k, v in branch("P4").items() if k != "reviews"},
        branch(None), branch("P5", rating=None, geometry=None, user_ratings_total=None),
    ]))
    put(base, f"{day}água_branca/b.json", envelope("Água Branca", [branch("A1")], date="ontem"))
    put(base, f"{day}vazio/c.json", envelope("Vazio", []))
    return base


def test_envelope_to_bronze(spark, landing):
    rows = br.to_bronze(br.normalize_landing(
        read_landing(spark, str(landing), "envelope"), AS_OF), AS_OF)
    assert [f.name for f in rows.schema.fields] == schemas.BRONZE.fieldNames()
    assert {f.name: f.dataType for f in rows.schema} == {f.name: f.dataType for f in schemas.BRONZE}
    got = {(r["place_id"], r["author_name"]): r for r in rows.collect()}
    assert len(got) == 5 and {p for p, _ in got} == {"P1", "P2", "P5", "A1"}
    bare = got["P2", "Anônimo"]
    assert (bare["review_rating"], bare["review_text"], bare["review_time"]) == (0, "", 0)
    assert got["P1", "Ana"]["data_coleta_timestamp"].microsecond == 123456
    assert got["A1", "Ana"]["data_coleta_timestamp"] is None
    assert (got["P5", "Ana"]["agencia_rating"], got["P5", "Ana"]["latitude"]) == (0.0, 0.0)
    assert (got["P1", "Ana"]["partition_year"], got["P1", "Ana"]["partition_day"]) == (2025, 2)
    assert got["P1", "Ana"]["bronze_review_id"].startswith("P1_")


def test_hash_key_is_sparks_hash(spark, landing):
    rows = br.to_bronze(br.normalize_landing(read_landing(spark, str(landing)), AS_OF), AS_OF)
    key = F.concat("place_id", F.lit("_"), F.hash(F.concat(
        "author_name", "review_text", F.col("review_time").cast("string"))).cast("string"))
    assert rows.filter(key != F.col("bronze_review_id")).count() == 0


def test_mixed_layouts_in_one_scan(spark, landing):
    put(landing, "simple/s1.json", {**branch("S1"), "bairro": "Moema"})
    put(landing, "simple/s2.json", {
        "place_id": "S2", "bairro_pesquisado": "Saúde", "vicinity": "Perto", "reviews": [review()],
        "data_coleta": "2025-06-30"})
    put(landing, "simple/s3.json", {"place_id": "S3", "reviews": [review()]})
    rows = {r["place_id"]: r for r in br.to_bronze(
        br.normalize_landing(read_landing(spark, str(landing)), AS_OF), AS_OF).collect()}
    assert set(rows) == {"P1", "P2", "P5", "A1", "S1", "S2", "S3"}
    assert (rows["S1"]["bairro_pesquisado"], rows["S1"]["latitude"]) == ("Moema", -23.5)
    assert (rows["S2"]["bairro_pesquisado"], rows["S2"]["endereco_completo"]) == ("Saúde", "Perto")
    assert rows["S2"]["data_coleta"] == "2025-06-30"
    assert (rows["S3"]["bairro_pesquisado"], rows["S3"]["agencia_name"]) == ("centro", "Local Desconhecido")
    assert (rows["S3"]["data_coleta"], rows["S3"]["endereco_completo"]) == (
        "2025-07-02", "Endereço não informado")


def test_simple_layout_alone(spark, tmp_path):
    put(tmp_path, "s.json", {**branch("S1"), "bairro": "Moema"})
    rows = br.normalize_landing(read_landing(spark, str(tmp_path), "simple"), AS_OF)
    assert tuple(rows.columns) == br.BRANCH_COLUMNS
    assert rows.first()["bairro_pesquisado"] == "Moema"


def test_inferred_schema_is_accepted(spark, landing):
    inferred = spark.read.option("recursiveFileLookup", "true").option("multiLine", "true").json(
        str(landing / "year=2025/month=07/day=01/bairro=pinheiros"))
    assert br.to_bronze(br.normalize_landing(inferred, AS_OF), AS_OF).count() == 4


def test_partition_scan_prunes(spark, landing):
    docs = read_landing(spark, str(landing), partitions=True).filter("part_bairro = 'pinheiros'")
    assert [(r["part_year"], r["part_month"], r["part_day"]) for r in docs.collect()] == [(2025, 7, 1)]
    plan = docs._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part_bairro" in plan or "bairro" in plan.split("PartitionFilters")[1][:80]


def test_glob_scan(spark, landing):
    assert read_landing(spark, f"{landing}/*/*/*/*/*.json").count() == 3


def test_empty_bronze_has_the_schema(spark):
    assert br.empty_bronze(spark).schema == schemas.BRONZE
    none = br.normalize_landing(spark.createDataFrame([], schemas.ENVELOPE), AS_OF)
    assert br.to_bronze(none, AS_OF).count() == 0


def test_write_landing_bounds_documents(spark, tmp_path):
    rows = spark.range(0, 130, 1, 3).select(
        F.lit("Hot Bairro").alias("bairro"), F.concat(F.lit("P"), F.col("id").cast("string")).alias("place_id"),
        F.lit("n").alias("name"), F.lit(4.0).alias("rating"))
    write_landing(rows, str(tmp_path / "l"), "run", AS_OF, max_branches=10)
    docs = read_landing(spark, str(tmp_path / "l"), "envelope", multiline=False)
    quality = docs.select("execution_metadata.data_quality.*", F.size("raw_data.agencias").alias("n")).collect()
    assert max(q["n"] for q in quality) <= 10 and sum(q["total_agencias"] for q in quality) == 130
    assert all(q["completeness_score"] == 0.5 for q in quality)
    places = br.from_envelope(docs).select("place_id").distinct().count()
    assert places == 130
    assert (tmp_path / "l/year=2025/month=07/day=02/bairro=hot_bairro").is_dir()


def test_full_flow(spark, landing, tmp_path):
    root = str(tmp_path / "lake")
    metrics = run_medallion(spark, str(landing), root, AS_OF, db="fluxo")
    assert metrics["bronze"]["records_affected"] == 5
    assert metrics["silver"]["records_affected"] == 4
    tables = {r["tableName"] for r in catalog.list_tables(spark, "fluxo").collect()}
    assert tables == set(catalog.TABLES.values())
    total = catalog.run_sql(
        spark, "SELECT total_reviews FROM fluxo.executive_dashboard WHERE total_agencias > :n", {"n": 0})
    assert total.first()[0] == 4
    silver = layers.read_layer(spark, root, "silver")
    by_sentiment = dict(silver.groupBy("sentimento").count().collect())
    assert by_sentiment == {"positivo": 3, "negativo": 1}
    registered = spark.table("fluxo.silver_google_maps_reviews_enriched")
    assert registered.count() == 4
    audit = layers.read_layer(spark, root, "governance/audit").collect()
    assert {a["table_name"]: a["records_affected"] for a in audit} == {"bronze": 5, "silver": 4}
    assert layers.read_layer(spark, root, "governance/lineage").count() == 2
    # Running again replaces the layers and changes nothing.
    before = layers.read_layer(spark, root, "agency_performance_kpis").collect()
    run_medallion(spark, str(landing), root, AS_OF, db="fluxo")
    assert sorted(layers.read_layer(spark, root, "agency_performance_kpis").collect()) == sorted(before)
    catalog.drop_database(spark, "fluxo")
    assert not spark.catalog.databaseExists("fluxo")


def test_gold_from_silver_and_from_rollup(spark, landing):
    silver = to_silver(br.to_bronze(br.normalize_landing(
        read_landing(spark, str(landing)), AS_OF), AS_OF), AS_OF)
    rollup = silver_rollup(silver)
    for name, build in GOLD_TABLES.items():
        direct, summed = build(silver, AS_OF), build(rollup, AS_OF)
        assert sorted(map(str, direct.collect())) == sorted(map(str, summed.collect())), name
        declared = {f.name: f.dataType for f in schemas.GOLD[name]}
        assert {f.name: f.dataType for f in direct.schema} == declared, name


def test_dynamic_overwrite_keeps_other_partitions(spark, tmp_path):
    def bronze(bairro, n):
        return spark.createDataFrame([("P", bairro, 2025, 7, 1)] * n, "place_id string, "
                                     "bairro_pesquisado string, partition_year int, partition_month int, partition_day int")

    root = str(tmp_path)
    layers.write_layer(bronze("A", 2).unionByName(bronze("B", 3)), root, "bronze")
    layers.write_layer(bronze("A", 5), root, "bronze", dynamic=True)
    counts = dict(layers.read_layer(spark, root, "bronze").groupBy("bairro_pesquisado").count().collect())
    assert counts == {"A": 5, "B": 3}


def test_schema_diff(spark):
    df = spark.createDataFrame([("P", 1)], "place_id string, extra int").withColumn("latitude", F.lit("x"))
    verdicts = {r["coluna"]: r["situacao"] for r in schema_diff(df, schemas.BRONZE).collect()}
    assert verdicts["place_id"] == "ok" and verdicts["latitude"] == "tipo_diferente"
    assert verdicts["extra"] == "inesperada" and verdicts["review_text"] == "ausente"


def test_strict_privacy(spark, landing):
    bronze = br.to_bronze(br.normalize_landing(read_landing(spark, str(landing)), AS_OF), AS_OF)
    strict = to_silver(bronze, AS_OF, privacy="strict", salt="s", keep_review_id=True, with_risk=True)
    assert strict.filter(~F.col("review_autor").rlike("^AUTOR_")).count() == 0
    assert {"bronze_review_id", "risco_reputacional", "padroes_criticos"} <= set(strict.columns)
    with pytest.raises(ValueError):
        to_silver(bronze, AS_OF, privacy="strict")


def test_fractions_of_a_second_are_kept(spark):
    from reviewlake.functions.dates import parse_collection_timestamp

    texts = ["2025-07-01T10:20:30.1", "2025-07-01T10:20:30.123", "2025-07-01T10:20:30.123456", "2025-07-01", "ontem", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(
        F.unix_micros(parse_collection_timestamp(F.col("t"))).alias("u")).collect()
    assert [r["u"] and r["u"] % 10**6 for r in rows] == [100000, 123000, 123456, None, None, None]


def test_no_document_of_a_file_is_passed_over(spark, tmp_path):
    from reviewlake.sources.landing import unreadable

    one, two = envelope("Moema", [branch("P1")]), envelope("Lapa", [branch("P2")])
    lines = "\n".join(json.dumps(d, ensure_ascii=False) for d in (one, two))
    put(tmp_path / "l", "pretty.json", one)
    put(tmp_path / "l", "array.json", [one, two])
    (tmp_path / "l" / "lines.json").write_text(lines + "\n{broken\n", encoding="utf-8")
    landed = br.normalize_landing(read_landing(spark, str(tmp_path / "l"), "envelope"), AS_OF)
    assert sorted(r["place_id"] for r in landed.collect()) == ["P1", "P1", "P1", "P2", "P2"]
    assert [r["value"] for r in unreadable(spark, str(tmp_path / "l")).collect()] == ["{broken"]


def test_documents_are_cut_at_their_borders(spark, tmp_path):
    from reviewlake.sources.landing import unreadable

    docs = [envelope("Moema", [branch(f"P{n}", name='a } { "b" ] [')]) for n in range(9)]
    pretty = [json.dumps(d, ensure_ascii=False, indent=2) for d in docs]
    bare = [json.dumps(d, ensure_ascii=False) for d in docs]
    folder = tmp_path / "l"
    folder.mkdir()
    (folder / "two.json").write_text(pretty[0] + "\n\n" + pretty[1], encoding="utf-8")
    (folder / "mixed.json").write_text(pretty[2] + "\n" + bare[3] + "\n" + pretty[4], encoding="utf-8")
    (folder / "close.json").write_text(pretty[5] + pretty[6] + "\n", encoding="utf-8")
    (folder / "open.json").write_text(pretty[7][:-40] + "\n" + pretty[8] + "\n", encoding="utf-8")
    landed = br.normalize_landing(read_landing(spark, str(folder), "envelope"), AS_OF)
    assert sorted(r["place_id"] for r in landed.collect()) == ["P0", "P1", "P2", "P3", "P4", "P5", "P6", "P8"]
    broken = [r["value"] for r in unreadable(spark, str(folder)).collect()]
    assert broken == [pretty[7][:-40].rstrip("\n")] or broken == [pretty[7][:-40]]


def test_files_of_lines_are_read_in_splits(spark, tmp_path):
    folder = tmp_path / "l"
    folder.mkdir()
    docs = [json.dumps(envelope("Moema", [branch(f"P{n}")]), ensure_ascii=False) for n in range(400)]
    docs[7] = docs[7][:50]
    (folder / "lines.json").write_text("\n".join(docs), encoding="utf-8")
    put(folder, "pretty.json", envelope("Lapa", [branch("Q1")]))
    held = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        landed = read_landing(spark, str(folder), "envelope")
        tasks = landed.select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
        assert len(tasks) > 8 and max(r["count"] for r in tasks) < 60
        places = [r["place_id"] for r in br.normalize_landing(landed, AS_OF).collect()]
        assert sorted(places) == sorted([f"P{n}" for n in range(400) if n != 7] + ["Q1"])
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", held)


def test_documents_of_one_file_are_spread_over_tasks(spark, tmp_path):
    document = json.dumps({"agencias": [{"place_id": "p"}], "bairro": "b"}, indent=1)
    (tmp_path / "many.json").write_text("\n".join([document] * 400), encoding="utf-8")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        read = read_landing(spark, str(tmp_path), "simple")
        per_task = [r["count"] for r in read.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(per_task) == 400 and len(per_task) > 4


def test_cut_by_rows_equals_cut_of_whole_files(spark, tmp_path):
    rng = random.Random(7)
    bits = ["{", "}", "[", "]", "{ }", "]}", "}{", '"}{"', " {", ' "a": [', "x", "} [1] {", '{"a": 1}', "", "  ]", '"\\"{"']
    for i in range(60):
        text = "\n".join("".join(rng.choices(bits, k=rng.choice([1, 1, 2, 4]))) for _ in range(rng.randrange(1, 14)))
        (tmp_path / f"{i}.json").write_text(text, encoding="utf-8")
    got = Counter(r["value"] for r in landing_source._split_pieces(spark, str(tmp_path), False).collect())
    want = Counter(r["value"] for r in landing_source._pieces(spark.read.text(str(tmp_path), wholetext=True)).collect())
    assert got == want
