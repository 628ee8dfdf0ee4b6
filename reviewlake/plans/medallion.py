"""The whole flow: landing -> Bronze -> Silver -> Gold -> catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from reviewlake.operators.bronze import normalize_landing, to_bronze
from reviewlake.operators.gold import GOLD_TABLES, merged_rollup, silver_rollup
from reviewlake.operators.governance import audit_row, lineage_row
from reviewlake.operators.silver import to_silver
from reviewlake.session import checkpointed
from reviewlake.sources.catalog import register_all
from reviewlake.sources.landing import read_landing
from reviewlake.sources.layers import DAY_COLUMNS, layer_path, read_day, read_layer, write_day, write_layer


def observed(df: DataFrame, name: str, **metrics) -> tuple[DataFrame, Observation]:
    """Metrics gathered while the frame is written, instead of by counting it again."""
    watch = Observation(name)
    exprs = [expr.alias(metric) for metric, expr in metrics.items()]
    return df.observe(watch, F.count(F.lit(1)).alias("records_affected"), *exprs), watch


def landed_documents(spark: SparkSession, landing: str, day: str | None = None,
                     multiline: bool = True) -> DataFrame:
    """All landed documents, or only the folders of one day."""
    if day is None:
        return read_landing(spark, landing, multiline=multiline)
    year, month, of_month = (int(part) for part in day[:10].split("-"))
    landed = read_landing(spark, landing, partitions=True, multiline=multiline)
    return landed.filter(
        (F.col("part_year") == year) & (F.col("part_month") == month) & (F.col("part_day") == of_month))


def land_to_bronze(spark: SparkSession, landing: str, root: str, as_of: str | None = None,
                   fmt: str = "parquet", key: str = "hash", dynamic: bool = False,
                   day: str | None = None, multiline: bool = True) -> dict:
    """Bronze from landing. With ``day`` only that day's folders are read, and only the
    Bronze partitions they fill are replaced, so that a day can be run again."""
    landed = landed_documents(spark, landing, day, multiline)
    bronze = to_bronze(normalize_landing(landed, as_of), as_of, key)
    watched, watch = observed(bronze, "bronze")
    write_layer(watched, root, "bronze", fmt, dynamic=dynamic or day is not None)
    return watch.get


def bronze_to_silver(spark: SparkSession, root: str, as_of: str | None = None,
                     fmt: str = "parquet", dynamic: bool = False, **options) -> dict:
    silver = to_silver(read_layer(spark, root, "bronze", fmt), as_of, **options)
    label = F.col("sentimento")
    watched, watch = observed(
        silver, "silver", pii_detected=F.count_if(F.col("tem_pii")),
        positivos=F.count_if(label == "positivo"), negativos=F.count_if(label == "negativo"),
        neutros=F.count_if(label == "neutro"),
    )
    write_layer(watched, root, "silver", fmt, dynamic=dynamic)
    return watch.get


def silver_to_gold(spark: SparkSession, root: str, as_of: str | None = None,
                   fmt: str = "parquet") -> None:
    """All Gold tables from one scan of Silver: they read a checkpointed rollup."""
    rollup_to_gold(silver_rollup(read_layer(spark, root, "silver", fmt)), root, as_of, fmt)


def rollup_to_gold(rollup: DataFrame, root: str, as_of: str | None = None, fmt: str = "parquet") -> None:
    held = checkpointed(rollup)
    for name, build in GOLD_TABLES.items():
        write_layer(build(held, as_of), root, name, fmt)


def record(spark: SparkSession, root: str, metrics: dict, as_of: str | None, fmt: str = "parquet") -> None:
    """Append the audit and lineage records of a run."""
    for layer, source in (("bronze", "landing"), ("silver", "bronze")):
        audit_row(spark, f"{source}_to_{layer}", layer, metrics[layer], as_of).write.mode(
            "append").format(fmt).save(layer_path(root, "governance/audit"))
        lineage_row(spark, source, layer, "transform", as_of).write.mode(
            "append").format(fmt).save(layer_path(root, "governance/lineage"))


def run_day(spark: SparkSession, landing: str, root: str, day: str, as_of: str | None = None,
            key: str = "hash", **options) -> dict:
    """One landed day through every layer, at the cost of that day.

    The day is one folder of Bronze, Silver and the roll-ups; a run replaces these
    three and reads nothing of other days but their roll-ups, whose counts are
    added up into Gold. Running a day again, also with other neighbourhoods than
    before, leaves what one run over its present documents would have left. A lake
    kept by days is kept in Parquet; ``rebuild_rollups`` takes over one that was not.
    """
    landed = landed_documents(spark, landing, day)
    write_day(to_bronze(normalize_landing(landed, as_of), as_of, key), root, "bronze", day)
    write_day(to_silver(read_day(spark, root, "bronze", day), as_of, **options), root, "silver", day)
    write_day(silver_rollup(read_day(spark, root, "silver", day)), root, "rollup", day)
    rollup_to_gold(merged_rollup(read_layer(spark, root, "rollup")), root, as_of)
    metrics = day_metrics(spark, root, day)
    record(spark, root, metrics, as_of)
    return metrics


def day_metrics(spark: SparkSession, root: str, day: str) -> dict:
    """What a run of the day has written: Bronze from file footers, Silver from the day's roll-up."""
    n = F.col("n_reviews")

    def reviews(condition=None):
        weight = n if condition is None else F.when(condition, n)
        return F.coalesce(F.sum(weight), F.lit(0))

    label = F.col("sentimento")
    silver = read_day(spark, root, "rollup", day).agg(
        reviews().alias("records_affected"), reviews(F.col("tem_pii")).alias("pii_detected"),
        *[reviews(label == name).alias(f"{name}s") for name in ("positivo", "negativo", "neutro")])
    return {"bronze": {"records_affected": read_day(spark, root, "bronze", day).count()},
            "silver": silver.first().asDict()}


def rebuild_rollups(spark: SparkSession, root: str) -> None:
    """The roll-ups of all days from the whole of Silver, in one pass."""
    silver = read_layer(spark, root, "silver")
    write_layer(silver_rollup(silver, DAY_COLUMNS), root, "rollup")


def run_medallion(spark: SparkSession, landing: str, root: str, as_of: str | None = None,
                  fmt: str = "parquet", db: str | None = None, key: str = "hash",
                  day: str | None = None, multiline: bool = True) -> dict:
    """Run every stage, append audit and lineage records, and register the tables."""
    metrics = {
        "bronze": land_to_bronze(spark, landing, root, as_of, fmt, key, day=day, multiline=multiline),
        "silver": bronze_to_silver(spark, root, as_of, fmt),
    }
    silver_to_gold(spark, root, as_of, fmt)
    record(spark, root, metrics, as_of, fmt)
    if db:
        register_all(spark, root, db, fmt)
    return metrics
