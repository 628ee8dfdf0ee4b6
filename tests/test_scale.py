"""Paging, samples, suspects, sketches and the retry loop."""

import contextlib
import io
import json

from pyspark.sql import functions as F

from reviewlake.operators import analytics as an
from reviewlake.operators import quality as q
from reviewlake.streaming.queue import retry_step


def explained(df):
    said = io.StringIO()
    with contextlib.redirect_stdout(said):
        df.explain("formatted")
    return said.getvalue()


def test_pages(spark, tmp_path):
    path = f"file://{tmp_path}/pages"
    an.write_pages(spark.range(1000).select((F.col("id") * 7 % 1000).alias("k")), ["k"], path)
    for offset, limit in ((0, 5), (930, 40), (990, 50), (1000, 5), (3, 997)):
        rows = [r["k"] for r in an.read_page(spark, path, offset, limit).collect()]
        assert rows == list(range(1000))[offset:offset + limit]
    plan = explained(an.read_page(spark, path, 930, 40))
    assert "_range#" in [line for line in plan.splitlines() if line.startswith("PartitionFilters")][0]


def test_samples_do_not_depend_on_partitions(spark):
    df = spark.range(500).select("id", F.when(F.col("id") % 3 > 0, F.col("id") % 11).alias("v"))
    samples = {tuple(sorted(map(tuple, an.sample_rows(d, 20).collect()), key=str))
               for d in (df, df.repartition(7), df.coalesce(1))}
    assert len(samples) == 1 and len(next(iter(samples))) == 20


def test_suspects_give_the_plain_answer(spark, monkeypatch):
    rows = [(f"k{i % 37}" if i % 5 == 0 else f"u{i}", None if i % 50 == 1 else i % 2) for i in range(400)] + [(None, None)] * 3
    df = spark.createDataFrame(rows, "a string, b int")
    for bits in (25, 16):
        monkeypatch.setattr(q, "BITMAP_BITS", bits)
        assert sorted(map(str, q.duplicates_by_suspects(df, ["a", "b"]).collect())) == sorted(
            map(str, q.duplicates(df, ["a", "b"]).collect()))
        for some in (df, df.limit(0), df.filter("a like 'u%'")):
            assert q.uniqueness_by_suspects(some, ["a", "b"]).collect() == q.uniqueness(some, ["a", "b"]).collect()


def test_keys_of_unique_rows_are_not_shuffled(spark, tmp_path):
    spark.range(5000).select(F.concat(F.lit("a long key "), F.col("id").cast("string")).alias("k")).write.parquet(
        f"file://{tmp_path}/rows")
    df = spark.read.parquet(f"file://{tmp_path}/rows")
    assert q._suspects(df, ["k"])[1].count() == 0  # the rows whose keys would be shuffled
    assert q.duplicates_by_suspects(df, ["k"]).count() == 0
    assert q.uniqueness_by_suspects(df, ["k"]).first()["chaves_distintas"] == 5000


def test_sketches_merge_over_days(spark):
    silver = spark.range(60000).select(
        (F.col("id") % 20000).cast("string").alias("place_id"), (F.col("id") % 300).cast("string").alias("bairro"),
        F.lit(2025).alias("partition_year"), F.lit(3).alias("partition_month"),
        (F.col("id") % 5 + 1).cast("int").alias("partition_day"))
    sketches = an.daily_sketches(silver)
    assert sketches.count() == 5
    for some, rows in ((sketches, silver), (sketches.filter("partition_day < 3"), silver.filter("partition_day < 3"))):
        got = an.stats_from_sketches(some).first()
        want = an.run_stats(rows.withColumnRenamed("bairro", "bairro_pesquisado")).first()
        assert got["total_reviews"] == want["total_reviews"]
        for name in ("agencias_unicas", "bairros_unicos"):
            assert abs(got[name] - want[name]) <= 0.03 * want[name]
    assert tuple(an.stats_from_sketches(sketches.limit(0)).first()) == (0, 0, 0)


def test_rejected_three_times_ends_dead(spark, tmp_path):
    root = tmp_path / "laço"
    (root / "entrada" / "a").mkdir(parents=True)
    (root / "fila").mkdir()
    lines = [json.dumps({"bairro": b}, ensure_ascii=False) for b in ("Moema", "Sé", "Lapa")] + ["{broken", '{"bairro": ""}']
    (root / "entrada" / "a" / "m.json").write_text("\n".join(lines), encoding="utf-8")

    def found(name):
        rows = spark.read.json(f"{root}/{name}/*") if (root / name).exists() and list((root / name).glob("*/*.txt")) else None
        return sorted((r["bairro"], r["tentativas"]) if name != "aceitas" else r["bairro"] for r in rows.collect()) if rows else []

    retry_step(spark, str(root), F.col("bairro").isin("Moema", "Sé"), "2025-07-01 10:00:00")
    assert found("fila") == [("Moema", 1), ("Sé", 1)] and found("aceitas") == ["Lapa"]
    retry_step(spark, str(root), F.col("bairro") == "Moema", "2025-07-01 11:00:00")
    assert ("Moema", 2) in found("fila") and found("aceitas") == ["Lapa", "Sé"] and found("mortas") == []
    retry_step(spark, str(root), F.col("bairro") == "Moema", "2025-07-01 12:00:00")
    assert found("mortas") == [("Moema", 3)]
    retry_step(spark, str(root), F.lit(True), "2025-07-01 13:00:00")
    assert found("mortas") == [("Moema", 3)] and len(found("fila")) == 3
