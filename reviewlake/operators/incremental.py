"""Which neighbourhoods and branches are still to be collected.

State is two tables: ``available(bairro, place_id, list_pos)`` and
``consulted(bairro, place_id, data_ultima_consulta)``, next to a one-row frame of
totals. Functions return the next state; ``write_state`` stores it as a new version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reviewlake import schemas
from reviewlake.functions import rules
from reviewlake.functions.dates import as_of_date, as_of_timestamp
from reviewlake.functions.numeric import percent, round_exact
from reviewlake.functions.text import slug, unslug

KEYS = ["bairro", "place_id"]


def bairro_dimension(spark: SparkSession, bairros=rules.BAIRROS) -> DataFrame:
    return spark.createDataFrame(list(enumerate(bairros)), "position int, bairro string")


def init_progress(spark: SparkSession, dim: DataFrame | None = None) -> dict[str, DataFrame]:
    """The empty starting state."""
    return {
        "dim": dim if dim is not None else bairro_dimension(spark),
        "available": spark.createDataFrame([], schemas.PROGRESS),
        "consulted": spark.createDataFrame([], schemas.CONSULTED),
        "totals": spark.createDataFrame([(0, 0)], schemas.TOTALS),
    }


# --- what is left ------------------------------------------------------------

def pending(available: DataFrame, consulted: DataFrame) -> DataFrame:
    """Available branches not consulted yet."""
    return available.join(consulted.select(*KEYS), KEYS, "left_anti")


def next_batch(pending_rows: DataFrame, n: int = 2) -> DataFrame:
    """The next ``n`` pending branches of each neighbourhood, in list order."""
    window = Window.partitionBy("bairro").orderBy("list_pos", "place_id")
    ranked = pending_rows.withColumn("ordem", F.row_number().over(window))
    return ranked.filter(F.col("ordem") <= n)


def has_pending(dim: DataFrame, available: DataFrame, consulted: DataFrame) -> DataFrame:
    """Per neighbourhood: counts, and whether anything is left to do.

    Never visited means pending; consulted without a list of available branches
    means done; otherwise pending while some available branch is not consulted.
    Both lists are combined in one shuffle on (bairro, place_id).
    """
    def tagged(df, a, c):
        return df.select(*KEYS, F.lit(a).alias("a"), F.lit(c).alias("c"))

    places = tagged(available, 1, 0).unionByName(tagged(consulted, 0, 1)).groupBy(*KEYS).agg(
        F.max("a").alias("a"), F.max("c").alias("c")
    )
    counts = places.groupBy("bairro").agg(
        F.sum("a").alias("disponiveis"), F.sum("c").alias("consultadas"),
        F.count_if((F.col("a") == 1) & (F.col("c") == 0)).alias("pendentes"),
    )
    filled = dim.join(counts, "bairro", "left").fillna(0, ["disponiveis", "consultadas", "pendentes"])
    first_visit = (F.col("disponiveis") == 0) & (F.col("consultadas") == 0)
    return filled.select(
        "position", "bairro", "disponiveis", "consultadas", "pendentes",
        (first_visit | (F.col("pendentes") > 0)).alias("tem_pendentes"),
    )


def next_bairro(status: DataFrame, current_index: int = 0) -> DataFrame:
    """The first neighbourhood from ``current_index`` on that has work left; one row.

    ``bairro`` is NULL and ``bairro_atual_index`` the list length when all are done.
    """
    open_ = F.col("tem_pendentes") & (F.col("position") >= current_index)
    return status.agg(
        F.min_by("bairro", F.when(open_, F.col("position"))).alias("bairro"),
        F.coalesce(F.min(F.when(open_, F.col("position"))), F.max("position") + 1)
        .alias("bairro_atual_index"),
        F.count(F.lit(1)).alias("total_bairros"),
    ).withColumn(
        "bairro", F.when(F.col("bairro_atual_index") < F.col("total_bairros"), F.col("bairro"))
    )


def beside(left: DataFrame, right: DataFrame) -> DataFrame:
    """Two one-row frames as one row, without a join."""
    both = left.unionByName(right, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns])


def progress_stats(status: DataFrame, totals: DataFrame, current_index: int = 0) -> DataFrame:
    """Index, totals, percentage done (2 decimals) and neighbourhoods left; one row."""
    index, n = F.col("bairro_atual_index"), F.col("total_bairros")
    return beside(next_bairro(status, current_index), totals).select(
        index.cast("int").alias("bairro_atual_index"), n.cast("int").alias("total_bairros"),
        F.coalesce(round_exact(percent(index, n)), F.lit(0.0)).alias("percentual_concluido"),
        (n - index).cast("int").alias("bairros_restantes"),
        F.coalesce("bairro", F.lit("CONCLUÍDO")).alias("bairro_atual"),
        "total_agencias_processadas", "total_comentarios_coletados",
    )


# --- state changes -----------------------------------------------------------

def update_available(available: DataFrame, found: DataFrame) -> DataFrame:
    """Replace the list of every neighbourhood that ``found`` has rows for."""
    fresh = found.filter(F.coalesce(F.col("place_id"), F.lit("")) != "").select(
        *schemas.PROGRESS.fieldNames())
    kept = available.join(found.select("bairro").distinct(), "bairro", "left_anti")
    return kept.select(*schemas.PROGRESS.fieldNames()).unionByName(fresh)


def add_consulted(consulted: DataFrame, batch: DataFrame, as_of: str | None) -> DataFrame:
    """Set union on (bairro, place_id); adding the same batch twice changes nothing."""
    stamp = as_of_timestamp(as_of).alias("data_ultima_consulta")
    fresh = batch.filter(F.coalesce(F.col("place_id"), F.lit("")) != "").select(*KEYS, stamp)
    return consulted.unionByName(fresh).groupBy(*KEYS).agg(
        F.max("data_ultima_consulta").alias("data_ultima_consulta")
    )


def mark_consulted(consulted: DataFrame, totals: DataFrame, batch: DataFrame,
                   as_of: str | None) -> tuple[DataFrame, DataFrame]:
    """The next ``(consulted, totals)`` after a batch of collected branches."""
    done = batch.agg(
        F.count(F.lit(1)).alias("total_agencias_processadas"),
        F.coalesce(F.sum(F.coalesce(F.size("reviews"), F.lit(0))), F.lit(0).cast("bigint"))
        .alias("total_comentarios_coletados"),
    )
    summed = totals.unionByName(done).agg(*[
        F.sum(c).alias(c) for c in schemas.TOTALS.fieldNames()
    ])
    return add_consulted(consulted, batch, as_of), summed


def write_state(state: dict[str, DataFrame], root: str, version: int) -> None:
    """Write a state as a new version, then record it as complete.

    A version counts once its row is in ``_versions``; readers of older versions
    are not disturbed, and a failed write leaves the last good one current.
    """
    for name, df in state.items():
        df.write.mode("overwrite").parquet(f"{root}/v{version:08d}/{name}")
    spark = next(iter(state.values())).sparkSession
    spark.createDataFrame([(version,)], "version int").write.mode("append").parquet(
        f"{root}/_versions.d")


def read_state(spark: SparkSession, root: str, names=("dim", "available", "consulted", "totals")):
    """``(version, state)`` of the last completed version."""
    version = spark.read.schema("version int").parquet(f"{root}/_versions.d").agg(
        F.max("version")).first()[0]
    return version, {n: spark.read.parquet(f"{root}/v{version:08d}/{n}") for n in names}


def reset_progress(spark: SparkSession, root: str, dim: DataFrame | None = None) -> None:
    """Start over: the initial state becomes the next version."""
    version, _ = read_state(spark, root)
    write_state(init_progress(spark, dim), root, version + 1)


# --- what was landed ---------------------------------------------------------

def _day(as_of: str | None):
    return as_of_date(as_of)


def landed_on(landed: DataFrame, as_of: str | None) -> DataFrame:
    """Distinct neighbourhood slugs landed on a day; prunes to that day's folders."""
    day = _day(as_of)
    return landed.filter(
        (F.col("part_year") == F.year(day)) & (F.col("part_month") == F.month(day))
        & (F.col("part_day") == F.dayofmonth(day))
    ).select(F.col("part_bairro").alias("slug")).distinct()


def skip_processed(queue: DataFrame, landed: DataFrame, as_of: str | None) -> DataFrame:
    """Queue rows whose neighbourhood has not been landed that day."""
    done = landed_on(landed, as_of)
    return queue.withColumn("_slug", slug(F.col("bairro"))).join(
        done.withColumnRenamed("slug", "_slug"), "_slug", "left_anti"
    ).drop("_slug")


def processed_on(landed: DataFrame, as_of: str | None) -> DataFrame:
    return landed_on(landed, as_of).select(unslug(F.col("slug")).alias("bairro")).distinct()


def day_stats(landed: DataFrame, as_of: str | None) -> DataFrame:
    """How many neighbourhoods were landed that day, and which.

    The list holds distinct names of the neighbourhood dimension, never data rows.
    """
    return processed_on(landed, as_of).agg(
        F.count(F.lit(1)).alias("bairros_processados_hoje"),
        F.sort_array(F.collect_list("bairro")).alias("lista_bairros_processados"),
    ).select(F.date_format(_day(as_of), "yyyy-MM-dd").alias("data"), "*")


def run_metadata(branches: DataFrame, run_id: str, task: str, started: str, finished: str,
                 quota_inicial: int = 0, quota_final: int = 0, erros=()) -> DataFrame:
    """The record of one collection run, ready to append to the run log."""
    stats = branches.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col("place_id").isNotNull()).alias("valid_rows"),
        F.coalesce(F.sum(F.coalesce(F.size("reviews"), F.lit(0))), F.lit(0).cast("bigint"))
        .alias("total_reviews"),
    )
    begin, end = F.lit(started).cast("timestamp"), F.lit(finished).cast("timestamp")
    return stats.select(
        F.lit(run_id).alias("run_id"), F.lit(task).alias("task"),
        F.lit("failed" if erros else "success").alias("status"), begin.alias("started"),
        (F.unix_micros(end) - F.unix_micros(begin)).cast("double").__truediv__(1e6).alias("seconds"),
        "valid_rows", "total_rows", "total_reviews",
        F.lit(quota_final - quota_inicial).alias("quota_utilizada"),
        F.array(*[F.lit(e) for e in erros]).cast("array<string>").alias("erros"),
    )
