"""Statistics and dashboard queries over Bronze, Silver and Gold.

Distinct counts group by the counted key first: that combines map-side and
spreads a hot group over many tasks, where several ``count(distinct)`` in one
aggregate would multiply every row before the shuffle.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reviewlake.functions import rules
from reviewlake.functions import text as txt
from reviewlake.functions.dates import (
    as_of_date, as_of_timestamp, interval, month_start, to_date_or_null, to_timestamp_or_null,
    year_month,
)
from reviewlake.functions.numeric import exact, mean_exact, percent, ratio, round_exact
from reviewlake.operators.gold import nps_category
from reviewlake.operators.silver import risk_counts, with_risk_counts
from reviewlake.session import checkpointed
from reviewlake.sources.layers import DAY_COLUMNS, read_layer


def _is(label: str) -> Column:
    return F.col("sentimento") == label


def _total() -> Column:
    return F.count(F.lit(1))


# --- run statistics ----------------------------------------------------------

def run_stats(bronze: DataFrame, approx: bool = False) -> DataFrame:
    """Rows, distinct branches and distinct neighbourhoods."""
    if approx:
        return bronze.agg(
            _total().alias("total_reviews"),
            F.approx_count_distinct("place_id").alias("agencias_unicas"),
            F.approx_count_distinct("bairro_pesquisado").alias("bairros_unicos"),
        )
    pairs = bronze.groupBy("place_id", "bairro_pesquisado").agg(_total().alias("n"))
    return pairs.agg(
        F.coalesce(F.sum("n"), F.lit(0).cast("bigint")).alias("total_reviews"),
        F.count_distinct("place_id").alias("agencias_unicas"),
        F.count_distinct("bairro_pesquisado").alias("bairros_unicos"),
    )


def daily_sketches(layer: DataFrame, days=DAY_COLUMNS) -> DataFrame:
    """Rows and distinct-count sketches per day of a layer, to be stored and merged over any period."""
    return layer.groupBy(*days).agg(
        _total().alias("total_reviews"),
        F.hll_sketch_agg("place_id", F.lit(14)).alias("agencias"),
        F.hll_sketch_agg("bairro", F.lit(14)).alias("bairros"),
    )


def stats_from_sketches(sketches: DataFrame) -> DataFrame:
    """The figures of ``run_stats`` for the days given; distinct counts are off by about 1 per cent."""
    return sketches.agg(
        F.coalesce(F.sum("total_reviews"), F.lit(0).cast("bigint")).alias("total_reviews"),
        F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("agencias")), F.lit(0).cast("bigint")).alias("agencias_unicas"),
        F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("bairros")), F.lit(0).cast("bigint")).alias("bairros_unicos"),
    )


def sentiment_counts(silver: DataFrame) -> DataFrame:
    return silver.groupBy("sentimento").agg(_total().alias("total"))


def pii_counts(silver: DataFrame) -> DataFrame:
    return silver.groupBy("tem_pii").agg(_total().alias("total"))


def gold_counts(spark: SparkSession, root: str, tables, fmt: str = "parquet") -> DataFrame:
    """Rows per Gold table as one frame; Parquet answers from file footers."""
    counts = [
        read_layer(spark, root, t, fmt).agg(_total().alias("linhas"))
        .select(F.lit(t).alias("tabela"), "linhas")
        for t in tables
    ]
    result = counts[0]
    for other in counts[1:]:
        result = result.unionByName(other)
    return result


def dedup_first(df: DataFrame, key, order) -> DataFrame:
    """The first row per key in an explicit order.

    ``row_number() <= 1`` lets Spark drop all but the first row of each key
    before the shuffle as well, so a hot key costs one row per task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).filter("_rn = 1").drop("_rn")


def unique_branch_metrics(df: DataFrame, order) -> DataFrame:
    """Branches counted once per place_id, by their first row in ``order``.

    Rows without a place_id count as duplicates. One shuffle: each branch comes
    down to its row count and the figure of its first row.
    """
    reviews = F.coalesce(F.col("user_ratings_total"), F.lit(0))
    per_place = df.groupBy("place_id").agg(
        _total().alias("n"), F.min_by(reviews, F.struct(*order)).alias("reviews"))
    valid = F.coalesce(F.col("place_id"), F.lit("")) != ""
    return per_place.agg(
        F.count_if(valid).alias("total_agencias"),
        F.coalesce(F.sum(F.when(valid, F.col("reviews"))), F.lit(0).cast("bigint"))
        .alias("total_reviews"),
        F.coalesce(F.sum("n"), F.lit(0).cast("bigint")).alias("total_registros"),
    ).withColumn("duplicatas_detectadas", F.col("total_registros") - F.col("total_agencias"))


# --- sentiment and personal data ---------------------------------------------

def nlp_metrics(silver: DataFrame) -> DataFrame:
    """Total, sentiment distribution as a map, and share of rows with personal data."""
    grouped = silver.groupBy("sentimento").agg(
        _total().alias("n"), F.count_if(F.col("tem_pii")).alias("pii")
    )
    # At most one entry per sentiment label.
    entries = F.collect_list(F.struct(F.coalesce("sentimento", F.lit("nulo")), "n"))
    return grouped.agg(
        F.coalesce(F.sum("n"), F.lit(0).cast("bigint")).alias("total_processados"),
        F.map_from_entries(entries).alias("distribuicao_sentimentos"),
        round_exact(percent(F.sum("pii"), F.sum("n"))).alias("taxa_deteccao_pii"),
    )


def sentiment_share(silver: DataFrame) -> DataFrame:
    counts = sentiment_counts(silver)
    # The window runs over one row per label.
    share = percent(F.col("total"), F.sum("total").over(Window.partitionBy()))
    return counts.withColumn("percentual", round_exact(share)).orderBy(
        F.desc("total"), "sentimento"
    )


def date_consistency(bronze: DataFrame) -> DataFrame:
    collected = to_timestamp_or_null(F.col("data_coleta"))
    ingested = F.col("bronze_ingestion_date").cast("timestamp")
    return bronze.agg(
        _total().alias("total_registros"),
        F.count_if(ingested >= collected).alias("datas_consistentes"),
        F.count_if(ingested < collected).alias("datas_inconsistentes"),
    )


def pii_anomalies(silver: DataFrame, min_n: int = 10, min_pct: float = 20) -> DataFrame:
    rate = percent(F.col("registros_com_pii"), F.col("total_avaliacoes"))
    return (
        silver.groupBy("nome_agencia", "bairro").agg(
            _total().alias("total_avaliacoes"),
            F.count_if(F.col("tem_pii")).alias("registros_com_pii"),
        )
        .withColumn("perc_pii", round_exact(rate))
        .filter((F.col("total_avaliacoes") >= min_n) & (F.col("perc_pii") > min_pct))
        .orderBy(F.desc("perc_pii"), "nome_agencia", "bairro")
    )


def bairro_kpis(silver: DataFrame) -> DataFrame:
    rating = exact(F.col("rating_agencia"))
    branches = silver.groupBy("bairro", "place_id").agg(
        _total().alias("n"), F.sum(rating).alias("rating_sum"), F.count(rating).alias("rating_n"),
        F.count_if(_is("positivo")).alias("pos"),
    )
    return branches.groupBy("bairro").agg(
        F.count("place_id").alias("total_agencias"),
        F.sum("n").alias("total_avaliacoes"),
        round_exact(ratio(F.sum("rating_sum"), F.sum("rating_n"))).alias("rating_medio"),
        round_exact(percent(F.sum("pos"), F.sum("n"))).alias("perc_sentimento_positivo"),
    ).orderBy(F.desc("total_avaliacoes"), "bairro")


def layer_summary(bronze: DataFrame, silver: DataFrame) -> DataFrame:
    def one(df, name, stamp):
        per_place = df.groupBy("place_id").agg(
            _total().alias("n"), F.min(stamp).alias("first"), F.max(stamp).alias("last")
        )
        return per_place.agg(
            F.coalesce(F.sum("n"), F.lit(0).cast("bigint")).alias("total_registros"),
            F.count("place_id").alias("agencias_unicas"),
            F.min("first").cast("timestamp").alias("primeira_ingestao"),
            F.max("last").cast("timestamp").alias("ultima_ingestao"),
        ).select(F.lit(name).alias("camada"), "*")

    return one(bronze, "Bronze", "bronze_ingestion_date").unionByName(
        one(silver, "Silver", "silver_processing_timestamp")
    )


def privacy_kpis(silver: DataFrame, k: int = 5) -> DataFrame:
    """Branch figures, published only from ``k`` reviews on."""
    return silver.groupBy("place_id", "nome_agencia").agg(
        _total().alias("total_reviews"),
        F.avg("rating_review").alias("avg_rating"),
        F.count_if(_is("positivo")).alias("positive_reviews"),
    ).filter(F.col("total_reviews") >= k)


def masking_status(silver: DataFrame) -> DataFrame:
    return silver.agg(
        _total().alias("total_records"),
        F.count("review_autor").alias("authors_present"),
        F.count_if(F.col("texto_anonimizado").rlike(r"\[[^\]]*_(ANONIMIZADO|MASCARADO)\]"))
        .alias("masked_texts"),
    )


def rating_sentiment_matrix(silver: DataFrame) -> DataFrame:
    return silver.groupBy("rating_review", "sentimento").agg(_total().alias("total"))


def rating_sentiment_corr(silver: DataFrame) -> DataFrame:
    """Pearson correlation of rating and sentiment (-1, 0, 1), from whole-number sums."""
    x = F.col("rating_review").cast("bigint")
    y = (
        F.when(_is("positivo"), F.lit(1)).when(_is("negativo"), F.lit(-1)).otherwise(F.lit(0))
    ).cast("bigint")
    sums = silver.filter(F.col("rating_review").isNotNull()).agg(
        _total().cast("double").alias("n"),
        F.sum(x).cast("double").alias("sx"), F.sum(y).cast("double").alias("sy"),
        F.sum(x * x).cast("double").alias("sxx"), F.sum(y * y).cast("double").alias("syy"),
        F.sum(x * y).cast("double").alias("sxy"),
    )
    covariance = F.col("n") * F.col("sxy") - F.col("sx") * F.col("sy")
    spread = F.sqrt(F.col("n") * F.col("sxx") - F.col("sx") * F.col("sx")) * F.sqrt(
        F.col("n") * F.col("syy") - F.col("sy") * F.col("sy")
    )
    return sums.select(
        F.col("n").cast("bigint").alias("total"), F.try_divide(covariance, spread).alias("correlacao")
    )


# --- dashboards over Gold ----------------------------------------------------

def since(df: DataFrame, column: str, period: str, as_of: str | None) -> DataFrame:
    """Rows of the trailing period, e.g. ``"30 days"`` or ``"12 months"``."""
    start = as_of_date(as_of) - interval(period)
    source = F.col(column)
    if dict(df.dtypes)[column] == "string":
        source = to_date_or_null(source)
    return df.filter(source >= start)


def executive_overview(kpis: DataFrame, as_of: str | None, period: str = "30 days") -> DataFrame:
    recent = since(kpis, "gold_timestamp", period, as_of)
    per_place = recent.groupBy("place_id").agg(
        F.sum(exact(F.col("rating_medio"), 12)).alias("rating_sum"),
        F.count("rating_medio").alias("rating_n"),
        F.sum("total_reviews").alias("n"),
        F.sum("reviews_positivos").alias("pos"), F.sum("reviews_negativos").alias("neg"),
    )
    return per_place.agg(
        F.count("place_id").alias("total_agencias"),
        ratio(F.sum("rating_sum"), F.sum("rating_n")).alias("nps_geral"),
        F.sum("n").alias("avaliacoes_totais"),
        round_exact(percent(F.sum("pos"), F.sum("n"))).alias("perc_positivos"),
        round_exact(percent(F.sum("neg"), F.sum("n"))).alias("perc_negativos"),
    )


def bairro_status(kpis: DataFrame) -> DataFrame:
    mean = F.col("rating_medio_bairro")
    per_place = kpis.groupBy("bairro", "place_id").agg(
        F.sum(exact(F.col("rating_medio"), 12)).alias("rating_sum"),
        F.count("rating_medio").alias("rating_n"), F.sum("total_reviews").alias("n"),
    )
    return per_place.groupBy("bairro").agg(
        F.count("place_id").alias("agencias_no_bairro"),
        ratio(F.sum("rating_sum"), F.sum("rating_n")).alias("rating_medio_bairro"),
        F.sum("n").alias("total_avaliacoes_bairro"),
    ).withColumn(
        "status_bairro",
        F.when(mean >= 4.0, F.lit("Excelente")).when(mean >= 3.5, F.lit("Bom"))
        .when(mean >= 3.0, F.lit("Regular")).otherwise(F.lit("Crítico")),
    ).orderBy(F.desc("rating_medio_bairro"), "bairro")


def sentiment_timeline(silver: DataFrame, as_of: str | None, period: str = "12 months") -> DataFrame:
    recent = since(silver, "data_coleta", period, as_of)
    return (
        recent.withColumn("mes", month_start(F.col("data_coleta")))
        .groupBy("mes", "sentimento").agg(
            _total().alias("total_reviews"),
            F.avg("rating_review").alias("rating_medio"),
            _total().alias("total_por_sentimento"),
        ).orderBy(F.desc("mes"), "sentimento")
    )


def risk_levels(alerts: DataFrame) -> DataFrame:
    n = F.col("total_reviews_negativas")
    return alerts.filter(n > 0).select(
        "place_id", "nome_agencia", n.alias("total_ocorrencias"),
        F.when(n > 10, F.lit("ALTO")).when(n > 5, F.lit("MEDIO")).otherwise(F.lit("BAIXO"))
        .alias("nivel_risco"),
    ).orderBy(F.desc("total_ocorrencias"), "place_id")


def critical_alerts(alerts: DataFrame) -> DataFrame:
    levels = risk_levels(alerts)
    return levels.agg(
        F.count_if(F.col("nivel_risco") == "ALTO").alias("alertas_criticos"),
        F.count_if(F.col("nivel_risco") == "MEDIO").alias("alertas_medios"),
        F.count_if(F.col("nivel_risco") == "BAIXO").alias("alertas_baixos"),
    )


def nps_score(nps: DataFrame) -> DataFrame:
    """Per-branch NPS: 100 * (promoters - detractors) / reviews."""
    score = percent(F.col("promotores") - F.col("detratores"), F.col("total_avaliacoes"))
    return nps.withColumn("nps_score", score)


def nps_overall(nps: DataFrame) -> DataFrame:
    return nps.agg(
        F.sum("total_avaliacoes").alias("total_avaliacoes"),
        percent(F.sum("promotores") - F.sum("detratores"), F.sum("total_avaliacoes"))
        .alias("nps_geral"),
    )


def rank_agencies(nps: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` best branches by NPS, ties broken by rating and place_id.

    The limit keeps ``k`` rows per task, so the numbering window sees ``k`` rows.
    """
    keys = [F.desc("nps_score"), F.desc("rating_medio"), F.asc("place_id"), F.asc("nome_agencia")]
    best = nps_score(nps).orderBy(*keys).limit(k)
    window = Window.partitionBy().orderBy(*keys)
    return best.withColumn("posicao", F.row_number().over(window)).select(
        "posicao", "place_id", "nome_agencia", "nps_score", "rating_medio", "total_avaliacoes"
    )


def benchmark_vs_region(kpis: DataFrame) -> DataFrame:
    """Each branch against the mean of its neighbourhood.

    An aggregate joined back, not a window: a window would gather every branch
    of a neighbourhood in one task.
    """
    region = kpis.groupBy("bairro").agg(
        mean_exact(F.col("rating_medio"), 12).alias("rating_medio_bairro"),
        _total().alias("agencias_no_bairro"),
    )
    return kpis.join(region, "bairro").select(
        "place_id", "nome_agencia", "bairro", "rating_medio", "rating_medio_bairro",
        "agencias_no_bairro",
        (F.col("rating_medio") - F.col("rating_medio_bairro")).alias("diferenca"),
    )


# --- documented, richer tables -----------------------------------------------

def agency_kpis_full(silver: DataFrame, as_of: str | None = None) -> DataFrame:
    promoter = nps_category(F.col("rating_review"))
    tenths = txt.weighted_tenths(risk_counts())
    return with_risk_counts(silver, "texto_review").groupBy("place_id", "nome_agencia", "bairro").agg(
        F.avg("rating_review").alias("rating_medio_agencia"),
        _total().alias("total_avaliacoes"),
        F.count_if(_is("positivo")).alias("avaliacoes_positivas"),
        F.count_if(_is("negativo")).alias("avaliacoes_negativas"),
        F.count_if(tenths > 0).alias("riscos_reputacionais"),
        F.count_if(promoter == "Promotor").alias("_pro"),
        F.count_if(promoter == "Detrator").alias("_det"),
    ).select(
        "place_id", F.col("nome_agencia").alias("agencia_name"), "bairro", "rating_medio_agencia",
        "total_avaliacoes", "avaliacoes_positivas", "avaliacoes_negativas",
        percent(F.col("avaliacoes_positivas"), F.col("total_avaliacoes"))
        .alias("percentual_positivas"),
        "riscos_reputacionais",
        percent(F.col("_pro") - F.col("_det"), F.col("total_avaliacoes")).alias("nps_score"),
        as_of_timestamp(as_of).alias("data_calculo"),
    )


def monthly_trend(silver: DataFrame) -> DataFrame:
    """Monthly sentiment figures and their direction against the month before."""
    dated = silver.withColumn("ano_mes", year_month(F.col("data_coleta"))).filter(F.col("ano_mes").isNotNull())
    scored = txt.with_sentiment_tenths(dated, "texto_review", "_tenths")
    monthly = scored.groupBy("ano_mes").agg(
        ratio(F.sum("_tenths"), _total() * 10).alias("sentimento_medio_score"),
        _total().alias("total_avaliacoes_mes"),
        percent(F.count_if(_is("positivo")), _total()).alias("percentual_positivas"),
        percent(F.count_if(_is("negativo")), _total()).alias("percentual_negativas"),
        F.avg("rating_review").alias("rating_medio_mes"),
    )
    # One row per calendar month is all this window ever sees.
    before = F.lag("sentimento_medio_score").over(Window.partitionBy().orderBy("ano_mes"))
    score = F.col("sentimento_medio_score")
    return monthly.withColumn("_before", before).withColumn(
        "tendencia_sentimento",
        F.when(score > F.col("_before"), F.lit("subindo"))
        .when(score < F.col("_before"), F.lit("caindo")).otherwise(F.lit("estável")),
    ).drop("_before")


def risk_alerts_full(silver: DataFrame) -> DataFrame:
    """One row per branch and risk category found in its reviews.

    Reviews are pre-aggregated per branch, category and keyword, so the keyword
    list is gathered from at most one row per keyword.
    """
    words = silver.withColumn("_pairs", txt.risk_keyword_pairs(F.col("texto_review")))
    weights = F.create_map(*[
        F.lit(v) for name, weight, _ in rules.RISK_CATEGORIES for v in (name, weight)
    ])
    # A review counts once per category, on its first keyword of that category.
    hits = words.select(
        "place_id", "nome_agencia", "data_review", F.posexplode("_pairs").alias("_pos", "_hit"),
        F.col("_pairs.tipo_risco").alias("_kinds"),
    ).select(
        "place_id", "nome_agencia", "data_review",
        F.col("_hit.tipo_risco").alias("tipo_risco"), F.col("_hit.palavra").alias("palavra"),
        (F.array_position("_kinds", F.col("_hit.tipo_risco")) == F.col("_pos") + 1).alias("_first"),
    )
    per_word = hits.groupBy("place_id", "nome_agencia", "tipo_risco", "palavra").agg(
        F.count_if(F.col("_first")).alias("reviews"), _total().alias("matches"),
        F.max("data_review").alias("last"),
    )
    tenths = F.sum("matches") * weights[F.col("tipo_risco")]
    return per_word.groupBy("place_id", "nome_agencia", "tipo_risco").agg(
        F.sum("reviews").alias("total_ocorrencias"),
        F.timestamp_seconds(F.max("last")).alias("ultima_ocorrencia"),
        F.array_join(F.array_sort(F.collect_set("palavra")), ",").alias("palavras_chave"),
        F.sum("matches").alias("_matches"),
    ).withColumn(
        "nivel_criticidade", txt.risk_level(F.col("_matches") * weights[F.col("tipo_risco")])
    ).select(
        "place_id", F.col("nome_agencia").alias("agencia_name"), "tipo_risco", "nivel_criticidade",
        "total_ocorrencias", "ultima_ocorrencia", "palavras_chave",
        (F.col("nivel_criticidade") == "ALTO").alias("requer_acao_imediata"),
    )


def agency_kpis_daily(silver: DataFrame, top: int = 3) -> DataFrame:
    """Daily branch figures with the most frequent risk categories of the day."""
    keys = ["place_id", "nome_agencia", "bairro", "data_referencia"]
    daily = with_risk_counts(silver, "texto_review").withColumn(
        "data_referencia", to_date_or_null(F.col("data_coleta")))
    counts = risk_counts()
    counted = daily.groupBy(*keys).agg(
        F.max("total_avaliacoes").alias("total_avaliacoes"),
        _total().alias("avaliacoes_periodo"),
        F.avg("rating_review").alias("rating_medio"),
        percent(F.count_if(_is("positivo")), _total()).alias("sentimento_positivo_pct"),
        percent(F.count_if(_is("negativo")), _total()).alias("sentimento_negativo_pct"),
        percent(F.count_if(_is("neutro")), _total()).alias("sentimento_neutro_pct"),
        F.count_if(txt.weighted_tenths(counts) >= 20).alias("avaliacoes_risco_alto"),
        *[F.count_if(n > 0).alias(f"_{c}") for c, n in counts.items()],
    )
    names = list(counts)
    # Five counters per group: ranked inside the row, no further shuffle.
    counters = F.array(*[
        F.when(F.col(f"_{c}") > 0, F.struct((-F.col(f"_{c}")).alias("n"), F.lit(c).alias("c")))
        for c in names
    ])
    ranked = F.slice(F.array_sort(F.array_compact(counters)), 1, top)
    return counted.withColumn("principais_problemas", ranked["c"]).drop(*[f"_{c}" for c in names])


def sentiment_trend(silver: DataFrame) -> DataFrame:
    """Daily review counts per neighbourhood and sentiment, against trailing means.

    ``variacao_7d`` / ``variacao_30d``: today's count minus the mean count of the
    days with reviews among the 7 / 30 before. Windows run over one row per day.
    """
    dated = silver.select(
        "bairro", "sentimento", "rating_review", "texto_review",
        to_date_or_null(F.col("data_coleta")).alias("data_referencia"),
    ).filter(F.col("data_referencia").isNotNull())
    daily = txt.with_sentiment_tenths(dated, "texto_review", "_s").groupBy("bairro", "data_referencia", "sentimento").agg(
        _total().alias("total_avaliacoes"),
        F.avg("rating_review").alias("rating_medio"),
        ratio(F.sum("_s"), _total() * 10).alias("score_sentimento_medio"),
    ).withColumn("_day", F.unix_date("data_referencia"))
    base = Window.partitionBy("bairro", "sentimento").orderBy("_day")

    def against(days):
        window = base.rangeBetween(-days, -1)
        n = F.col("total_avaliacoes")
        return n.cast("double") - ratio(F.sum(n).over(window), F.count(n).over(window))

    return daily.withColumns({"variacao_7d": against(7), "variacao_30d": against(30)}).drop("_day")


def sla_metrics(run_log: DataFrame, as_of: str | None, days: int = 1) -> DataFrame:
    """Success share, mean latency, valid-record share and their alarms per task."""
    recent = run_log.filter(
        F.col("started") >= as_of_timestamp(as_of) - interval(f"{days} days")
    )
    return recent.groupBy("task").agg(
        _total().alias("execucoes"),
        F.count_if(F.col("status") != "success").alias("falhas"),
        percent(F.count_if(F.col("status") == "success"), _total()).alias("taxa_sucesso"),
        mean_exact(F.col("seconds")).alias("latencia_media_s"),
        ratio(F.sum("valid_rows"), F.sum("total_rows")).alias("qualidade"),
    ).withColumns({
        "alerta_falhas": F.col("falhas") > 3,
        "alerta_qualidade": F.coalesce(F.col("qualidade") < 0.95, F.lit(False)),
        "alerta_latencia": F.coalesce(F.col("latencia_media_s") > 45 * 60, F.lit(False)),
    })


# --- windows, paging, sets ---------------------------------------------------

def nav_functions(df: DataFrame, keys, order, value: str, ignore_nulls: bool = True, nth: int = 2,
                  bucket_rows: int | None = None) -> DataFrame:
    """first / last / nth value over the whole key, and lead / lag, per row.

    Rows are dealt by ranges of key and order into as many buckets as shuffles have
    partitions, or into buckets of about ``bucket_rows``, so that no task has to
    sort a hot key whole: neighbours are looked up inside a bucket, and from a
    one-row-per-bucket summary across bucket borders. Both directions are growing frames: what lies ahead is what lies behind
    in the mirrored order, as a frame that shrinks is evaluated anew for every row.
    ``order`` must be total within a key. The dealt rows are checkpointed: a re-run
    of a lost task must not deal them anew.
    """
    keys, order = list(keys), list(order)
    if bucket_rows:
        buckets = max(1, -(-df.count() // bucket_rows))
    else:
        buckets = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = checkpointed(
        df.repartitionByRange(buckets, *keys, *order).withColumn("_bucket", F.spark_partition_id()))
    position = F.struct(*[F.col(c) for c in order])
    counted = F.col(value).isNotNull() if ignore_nulls else F.lit(True)
    boxed = F.when(counted, F.struct(F.col(value).alias("v")))
    # The smallest and largest position of a bucket carry its first and last value.
    at = F.when(counted, position)
    summary = rows.groupBy(*keys, "_bucket").agg(
        F.min_by(boxed, at).alias("_first"), F.max_by(boxed, at).alias("_last"),
    )

    def behind(window):
        return window.rowsBetween(Window.unboundedPreceding, -1)

    across = Window.partitionBy(*keys)
    whole = across.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    borders = summary.select(
        *keys, "_bucket",
        F.last_value("_last", True).over(behind(across.orderBy("_bucket"))).alias("_prev"),
        F.last_value("_first", True).over(behind(across.orderBy(F.desc("_bucket")))).alias("_next"),
        F.first_value("_first", True).over(whole).alias("_key_first"),
        F.last_value("_last", True).over(whole).alias("_key_last"),
    )
    # Ranked filters keep at most ``nth`` rows per key and task before the shuffle.
    ranking = Window.partitionBy(*keys).orderBy(*order)
    nth_rows = (
        rows.filter(counted).withColumn("_rn", F.row_number().over(ranking))
        .filter(F.col("_rn") <= nth).filter(F.col("_rn") == nth)
        .select(*keys, boxed.alias("_nth"))
    )
    local = Window.partitionBy(*keys, "_bucket")
    neighbours = rows.withColumns({
        "_lag": F.last_value(boxed, True).over(behind(local.orderBy(*order))),
        "_lead": F.last_value(boxed, True).over(behind(local.orderBy(*[F.desc(c) for c in order]))),
    })
    joined = neighbours.join(borders, [*keys, "_bucket"]).join(nth_rows, keys, "left")
    return joined.select(
        *df.columns,
        F.col("_key_first.v").alias("first_value"), F.col("_key_last.v").alias("last_value"),
        F.col("_nth.v").alias("nth_value"),
        F.coalesce("_lead", "_next")["v"].alias("lead_value"),
        F.coalesce("_lag", "_prev")["v"].alias("lag_value"),
    )


def ordered(df: DataFrame, keys) -> DataFrame:
    return df.orderBy(*keys)


def sample_rows(df: DataFrame, n: int) -> DataFrame:
    """The ``n`` rows with the smallest digests: the same sample however the rows are partitioned.

    Every task keeps ``n`` rows, and nothing is sorted whole.
    """
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in df.columns]
    return df.orderBy(F.md5(F.concat_ws("\u001f", *parts).cast("binary"))).limit(n)


def known_rows(few: DataFrame, rows: DataFrame) -> DataFrame:
    """A few rows, ``_known`` 1 where ``rows`` has them too, else NULL. NULL equals NULL.

    Plain equality would push a test for NULL on computed labels to the scan, too large a method for the JVM to
    compile; and only rows that are met are made distinct.
    """
    def same(left: str, right: str):
        return reduce(and_, [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in few.columns])

    met = rows.alias("r").join(F.broadcast(few.distinct()).alias("f"), same("r", "f"), "left_semi").distinct()
    return few.alias("f").join(met.withColumn("_known", F.lit(1)).alias("r"), same("f", "r"), "left").select("f.*", "_known")


def page(df: DataFrame, keys, offset: int, limit: int) -> DataFrame:
    return df.orderBy(*keys).offset(offset).limit(limit)


def write_pages(df: DataFrame, keys, path: str) -> None:
    """Store rows for ``read_page``: dealt by ranges of ``keys``, numbered within their range.

    ``keys`` must be total, or pages depend on how ties are dealt.
    """
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(ranges, *keys).sortWithinPartitions(*keys)
    at = F.monotonically_increasing_id()
    dealt.withColumns({"_at": at.bitwiseAND((1 << 33) - 1), "_range": F.shiftrightunsigned(at, 33)}).write.mode(
        "overwrite").partitionBy("_range").parquet(path)


def read_page(spark: SparkSession, path: str, offset: int, limit: int) -> DataFrame:
    """Rows ``offset`` to ``offset + limit`` of what ``write_pages`` stored, scanning only the ranges that hold them.

    The counts per range come from file footers, one row per range.
    """
    rows = spark.read.parquet(path)
    counts = dict(rows.groupBy("_range").agg(F.count(F.lit(1))).collect())
    before, wanted = 0, F.lit(False)
    for number in sorted(counts):
        first, last = max(0, offset - before), min(counts[number], offset + limit - before)
        if first < last:
            wanted = wanted | ((F.col("_range") == number) & (F.col("_at") >= first) & (F.col("_at") < last))
        before += counts[number]
    return rows.filter(wanted).orderBy("_range", "_at").drop("_range", "_at")


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    return df.select(key).distinct()
