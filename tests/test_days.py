"""A lake kept by days: only the day at hand is read and replaced."""

import contextlib
import io

from pyspark.sql import functions as F

from reviewlake.operators import gold
from reviewlake.plans import medallion
from reviewlake.sources import layers
from reviewlake.sources.landing import write_landing

SCHEMA = ("bairro string, place_id string, name string, rating double, "
          "reviews array<struct<author_name:string,rating:int,text:string,time:bigint,"
          "relative_time_description:string>>")


def branches(spark, names):
    return spark.createDataFrame(
        [(bairro, f"{bairro}-{n}", f"Agência {n}", 4.0, [("Ana", n % 6, text, 100 + n, None)])
         for bairro, texts in names.items() for n, text in enumerate(texts)], SCHEMA)


def gold_rows(spark, root):
    return {name: sorted(map(str, layers.read_layer(spark, root, name).drop("gold_timestamp").collect()))
            for name in gold.GOLD_TABLES}


def test_days_equal_one_run_over_their_last_state(spark, tmp_path):
    landing, kept, whole = (f"file://{tmp_path}/{n}" for n in ("landing", "kept", "whole"))
    first = {"centro": ["ótimo atendimento", "péssimo"], "moema": ["bom"]}
    again = {"centro": ["ruim demais"], "lapa": ["excelente, meu e-mail é a@b.com"]}
    second = {"centro": ["regular", "bom"], "moema": ["horrível"]}
    for root, days in ((f"{landing}-1", [("2025-03-01", first)]),
                       (f"{landing}-2", [("2025-03-01", again), ("2025-03-02", second)])):
        for day, names in days:
            write_landing(branches(spark, names), root, "run", f"{day} 10:00:00")
    medallion.run_day(spark, f"{landing}-1", kept, "2025-03-01", "2025-03-01 11:00:00")
    for day in ("2025-03-01", "2025-03-02"):
        metrics = medallion.run_day(spark, f"{landing}-2", kept, day, f"{day} 11:00:00")
    assert metrics["silver"]["records_affected"] == 3
    medallion.run_medallion(spark, f"{landing}-2", whole, "2025-03-02 11:00:00")
    assert gold_rows(spark, kept) == gold_rows(spark, whole)
    # The neighbourhood that the first run of the day had is gone.
    bairros = layers.read_day(spark, kept, "silver", "2025-03-01").select("bairro").distinct().collect()
    assert {r["bairro"] for r in bairros} == {"centro", "lapa"}

    before = sorted(map(str, layers.read_layer(spark, kept, "rollup").collect()))
    medallion.rebuild_rollups(spark, kept)
    assert sorted(map(str, layers.read_layer(spark, kept, "rollup").collect())) == before


def test_a_run_scans_one_day(spark, tmp_path):
    root = f"file://{tmp_path}/lake"
    for day in ("2025-03-01", "2025-03-02", "2025-03-03"):
        rows = spark.range(50).select(F.col("id").cast("string").alias("place_id"), F.lit("centro").alias("bairro"))
        full = rows.select(*[F.col(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name)
                             for f in layers.SCHEMAS["silver"].fields])
        layers.write_day(full, root, "silver", day)
    one = layers.read_day(spark, root, "silver", "2025-03-02")
    assert one.count() == 50 and {r["partition_day"] for r in one.collect()} == {2}
    said = io.StringIO()
    with contextlib.redirect_stdout(said):
        one.explain("formatted")
    filters = [line for line in said.getvalue().splitlines() if line.startswith("PartitionFilters")]
    assert len(filters) == 1 and all(f"({c}#" in filters[0] for c in layers.DAY_COLUMNS)


def test_an_empty_day_clears_what_was_there(spark, tmp_path):
    landing, root = f"file://{tmp_path}/landing", f"file://{tmp_path}/lake"
    write_landing(branches(spark, {"centro": ["bom"]}), landing, "run", "2025-03-01 10:00:00")
    medallion.run_day(spark, landing, root, "2025-03-01", "2025-03-01 11:00:00")
    medallion.run_day(spark, landing, root, "2025-03-02", "2025-03-02 11:00:00")
    assert layers.read_layer(spark, root, "executive_dashboard").first()["total_reviews"] == 1
    layers.write_day(layers.read_day(spark, root, "silver", "2025-03-02").limit(0), root, "silver", "2025-03-01")
    assert layers.read_layer(spark, root, "silver").count() == 0
