"""Bronze -> Silver: sentiment, personal data and masked text per review."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlake import schemas
from reviewlake.functions import rules
from reviewlake.functions import text as txt
from reviewlake.functions.dates import as_of_date, as_of_timestamp, to_date_or_null
from reviewlake.operators.bronze import nonblank


def silver_score(text: str = "texto_review") -> Column:
    long_enough = F.col(text).isNotNull() & (F.length(text) > 10)
    return F.when(long_enough, F.lit(1.0)).otherwise(F.lit(0.5))


def enrich(df: DataFrame, text: str, mode: str = "substring") -> DataFrame:
    """Add sentimento, tem_pii, tipos_pii_detectados and texto_anonimizado.

    Done in successive projections whose columns the next uses more than once,
    so that Catalyst keeps them apart: every pattern test runs once per row, and
    the generated methods stay small enough for the JVM to compile.
    """
    source = F.col(text)
    flags = txt.pii_flags(source)
    rows = df.withColumns({
        "sentimento": txt.sentiment_label(source, mode=mode),
        **{f"_{kind}": flag for kind, flag in flags.items()},
    })
    seen = {kind: F.col(f"_{kind}") for kind in flags}
    masked = source
    for kind, pattern, token in rules.PII_RULES:
        step = F.when(seen[kind], txt.replace_all(masked, pattern, token)).otherwise(masked)
        rows = rows.withColumn(f"_masked_{kind}", step)
        masked = F.col(f"_masked_{kind}")
    return rows.select(
        *[c for c in df.columns if c != text], source,
        "sentimento",
        txt.any_flag(seen).alias("tem_pii"),
        txt.types_from_flags(seen).alias("tipos_pii_detectados"),
        masked.alias("texto_anonimizado"),
    )


def to_silver(bronze: DataFrame, as_of: str | None = None, keep_review_id: bool = False,
              privacy: str = "default", salt: str | None = None, with_risk: bool = False,
              mode: str = "substring") -> DataFrame:
    """The Silver projection.

    ``privacy="strict"`` replaces the author by a salted pseudonym and the review
    text by its masked form. ``with_risk`` adds the reputational-risk columns.
    """
    rows = enrich(bronze.filter(nonblank("review_text")), "review_text", mode)
    today = as_of_date(as_of)
    silver = rows.select(
        "place_id",
        F.col("agencia_name").alias("nome_agencia"),
        "endereco_completo", "latitude", "longitude",
        F.col("agencia_rating").alias("rating_agencia"),
        "total_avaliacoes",
        F.col("bairro_pesquisado").alias("bairro"),
        "data_coleta",
        F.col("author_name").alias("review_autor"),
        F.col("review_rating").alias("rating_review"),
        F.col("review_text").alias("texto_review"),
        F.col("review_time").alias("data_review"),
        "sentimento", "tem_pii", "tipos_pii_detectados", "texto_anonimizado",
        as_of_timestamp(as_of).alias("silver_processing_timestamp"),
        F.year(today).alias("partition_year"),
        F.month(today).alias("partition_month"),
        F.dayofmonth(today).alias("partition_day"),
        *(["bronze_review_id"] if keep_review_id else []),
    ).withColumn("data_quality_score", silver_score())
    if with_risk:
        silver = add_risk(silver, "texto_review")
    if privacy == "strict":
        if not salt:
            raise ValueError("privacy='strict' needs a salt")
        silver = silver.withColumns({
            "review_autor": txt.pseudonymize(F.col("review_autor"), salt),
            "texto_review": F.col("texto_anonimizado"),
        })
    elif privacy != "default":
        raise ValueError(f"unknown privacy mode {privacy!r}")
    order = schemas.SILVER.fieldNames()
    return silver.select(*order, *[c for c in silver.columns if c not in order])


def add_risk(df: DataFrame, text: str) -> DataFrame:
    """Add the reputational-risk columns; keywords are counted once per category."""
    counted = with_risk_counts(df, text)
    counts = risk_counts()
    joined = F.array_join(txt.risk_names(counts), ",")
    tenths = txt.weighted_tenths(counts)
    return counted.select(
        *df.columns,
        txt.risk_level(tenths).alias("risco_reputacional"),
        F.when(joined == "", F.lit("NENHUMA")).otherwise(joined).alias("categorias_risco"),
        (tenths.cast("double") / F.lit(10.0)).alias("risco_score"),
        txt.critical_patterns(F.col(text)).alias("padroes_criticos"),
    )


def with_risk_counts(df: DataFrame, text: str) -> DataFrame:
    """Keyword matches per risk category as columns ``_risk_<category>``."""
    lowered = df.withColumn("_lower", F.lower(F.col(text)))
    return lowered.withColumns({
        f"_risk_{name}": txt.count_in_lowered(F.col("_lower"), words)
        for name, _, words in rules.RISK_CATEGORIES
    }).drop("_lower")


def risk_counts() -> dict[str, Column]:
    return {name: F.col(f"_risk_{name}") for name, _, _ in rules.RISK_CATEGORIES}


def labelled_counts(silver: DataFrame, label: str, key: str = "place_id") -> DataFrame:
    """Reviews of one label per key (``total``), keys without any left out.

    Counted rather than filtered: a filter on the computed label is pushed down to the scan,
    where the text is lower-cased per term in a method too large for the JVM to compile.
    """
    return silver.groupBy(key).agg(F.count_if(F.col("sentimento") == label).alias("total")).filter("total > 0")


def drill_down(silver: DataFrame, place_id: str) -> DataFrame:
    """The individual reviews of one branch."""
    return silver.filter(F.col("place_id") == place_id)


def dashboard_filter(silver: DataFrame, start: str | None = None, end: str | None = None,
                     bairros=None, sentimentos=None) -> DataFrame:
    """Period, neighbourhood and sentiment filters; one left out does not filter."""
    # By date: a collection time may follow the day, and the last day counts whole.
    day = to_date_or_null(F.col("data_coleta"))
    if start:
        silver = silver.filter(day >= F.lit(start).cast("date"))
    if end:
        silver = silver.filter(day <= F.lit(end).cast("date"))
    if bairros:
        silver = silver.filter(F.col("bairro").isin(list(bairros)))
    if sentimentos:
        silver = silver.filter(F.col("sentimento").isin(list(sentimentos)))
    return silver
