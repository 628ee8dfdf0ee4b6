"""Landing -> Bronze: one row per review."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake import schemas
from reviewlake.functions import rules
from reviewlake.functions.dates import as_of_date, as_of_timestamp, parse_collection_timestamp

BRANCH_COLUMNS = (
    "data_coleta", "bairro_pesquisado", "place_id", "name", "formatted_address", "latitude",
    "longitude", "rating", "total_avaliacoes", "reviews",
)


# --- predicates --------------------------------------------------------------

def has_reviews(reviews: str = "reviews") -> Column:
    return F.col(reviews).isNotNull() & (F.size(reviews) > 0)


def valid_place(place: str = "place_id") -> Column:
    return F.col(place).isNotNull()


def nonblank(column: str) -> Column:
    """Not NULL and not only blanks; tabs and newlines count as text here."""
    return F.col(column).isNotNull() & (F.trim(column) != "")


# --- layout ------------------------------------------------------------------

def _plain_reviews(reviews: Column) -> Column:
    """Reviews reduced to the four kept fields, whatever else the JSON carried."""
    four = F.transform(reviews, lambda r: F.struct(
        r["author_name"].cast("string").alias("author_name"),
        r["rating"].cast("int").alias("rating"),
        r["text"].cast("string").alias("text"),
        r["time"].cast("bigint").alias("time"),
    ))
    return F.coalesce(four, F.array().cast(schemas.REVIEW_4_TYPE))


def _branch_projection(df: DataFrame, branch: str) -> DataFrame:
    def field(name):
        return F.col(f"{branch}.{name}")

    return df.select(
        "data_coleta", "bairro_pesquisado",
        field("place_id").alias("place_id"),
        *[F.coalesce(field(c), F.lit(rules.DEFAULTS[c])).alias(c) for c in ("name", "formatted_address")],
        F.coalesce(field("geometry.location.lat"), F.lit(rules.DEFAULTS["latitude"])).alias("latitude"),
        F.coalesce(field("geometry.location.lng"), F.lit(rules.DEFAULTS["longitude"])).alias("longitude"),
        F.coalesce(field("rating").cast("double"), F.lit(rules.DEFAULTS["rating"])).alias("rating"),
        F.coalesce(field("user_ratings_total").cast("int"),
                   F.lit(rules.DEFAULTS["total_avaliacoes"])).alias("total_avaliacoes"),
        _plain_reviews(field("reviews")).alias("reviews"),
    )


def landing_branches(df: DataFrame) -> DataFrame:
    """One row per landed branch of the envelope layout, fields as they came."""
    return df.select(
        F.col("execution_metadata.execution_date").alias("data_coleta"),
        F.col("execution_metadata.bairro").alias("bairro_pesquisado"),
        F.posexplode("raw_data.agencias").alias("list_pos", "agencia"),
    )


def from_envelope(df: DataFrame) -> DataFrame:
    return _branch_projection(landing_branches(df), "agencia")


def _simple_branch(df: DataFrame) -> Column:
    """The top-level fields of a simple document as one branch."""
    def pick(*names):
        found = [F.col(n) for n in names if n in df.columns]
        return F.coalesce(*found, F.lit(None)) if found else F.lit(None)

    values = {
        "place_id": pick("place_id"),
        "name": pick("name"),
        "formatted_address": pick("formatted_address", "vicinity"),
        "rating": pick("rating"),
        "user_ratings_total": pick("user_ratings_total"),
        "geometry": pick("geometry"),
        "reviews": pick("reviews"),
    }
    typed = [
        values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schemas.BRANCH.fields
    ]
    return F.struct(*typed)


def _simple_bairro(df: DataFrame) -> Column:
    names = [F.col(n) for n in ("bairro", "bairro_pesquisado") if n in df.columns]
    return F.coalesce(*names, F.lit(rules.DEFAULTS["bairro_pesquisado"]))


def _simple_date(df: DataFrame, as_of: str | None) -> Column:
    today = as_of_date(as_of).cast("string")
    return F.coalesce(F.col("data_coleta"), today) if "data_coleta" in df.columns else today


def from_simple(df: DataFrame, as_of: str | None = None) -> DataFrame:
    shaped = df.select(
        _simple_date(df, as_of).alias("data_coleta"),
        _simple_bairro(df).alias("bairro_pesquisado"),
        _simple_branch(df).alias("agencia"),
    )
    return _branch_projection(shaped, "agencia")


def normalize_landing(df: DataFrame, as_of: str | None = None) -> DataFrame:
    """Branches of either layout, or of a folder that mixes both, in one scan."""
    envelope, simple = "raw_data" in df.columns, "reviews" in df.columns
    if envelope and not simple:
        return from_envelope(df)
    if simple and not envelope:
        return from_simple(df, as_of)
    if not envelope:
        raise ValueError("neither 'reviews' nor 'raw_data' among the landed columns")
    wrapped = F.col("raw_data").isNotNull()
    branch_type = schemas.ENVELOPE["raw_data"].dataType["agencias"].dataType
    shaped = df.select(
        F.when(wrapped, F.col("execution_metadata.execution_date"))
        .otherwise(_simple_date(df, as_of)).alias("data_coleta"),
        F.when(wrapped, F.col("execution_metadata.bairro"))
        .otherwise(_simple_bairro(df)).alias("bairro_pesquisado"),
        F.explode(
            F.when(wrapped, F.col("raw_data.agencias").cast(branch_type))
            .otherwise(F.array(_simple_branch(df)).cast(branch_type))
        ).alias("agencia"),
    )
    return _branch_projection(shaped, "agencia")


def fill_defaults(df: DataFrame, defaults: dict = rules.DEFAULTS) -> DataFrame:
    """Replace NULL by the default of every column that has one."""
    types = dict(df.dtypes)
    return df.withColumns({
        name: F.coalesce(F.col(name), F.lit(value).cast(types[name]))
        for name, value in defaults.items() if name in types
    })


# --- collection --------------------------------------------------------------

def cap_reviews(df: DataFrame, n: int = 10) -> DataFrame:
    """Keep the first ``n`` reviews of each branch, the collector's own limit."""
    return df.withColumn("reviews", F.slice("reviews", 1, n))


def stamp_collection(df: DataFrame, as_of: str | None, kind: str = "sequencial") -> DataFrame:
    now = as_of_timestamp(as_of)
    return df.withColumns({
        "timestamp_coleta": F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
        "data_coleta": F.date_format(now, "yyyy-MM-dd"),
        "tipo_execucao": F.lit(kind),
        "reviews_coletadas": F.coalesce(F.size("reviews"), F.lit(0)),
    })


def merge_details(search: DataFrame, details: DataFrame, key: str = "place_id") -> DataFrame:
    """Search rows with their detail row on top: a detail value wins where present."""
    tagged = details.select(key, *[F.col(c).alias(f"_d_{c}") for c in details.columns if c != key])
    merged = search.join(tagged, key, "left")
    shared = [c for c in search.columns if c != key and c in details.columns]
    extra = [c for c in details.columns if c not in search.columns]
    kept = [
        F.coalesce(f"_d_{c}", c).alias(c) if c in shared else F.col(c) for c in search.columns
    ]
    return merged.select(*kept, *[F.col(f"_d_{c}").alias(c) for c in extra])


# --- rows --------------------------------------------------------------------

def bronze_score() -> Column:
    complete = (
        F.col("place_id").isNotNull() & F.col("name").isNotNull()
        & F.col("bairro_pesquisado").isNotNull()
    )
    return F.when(complete, F.lit(1.0)).otherwise(F.lit(0.5))


def add_audit(df: DataFrame, as_of: str | None) -> DataFrame:
    return df.withColumns({
        "bronze_ingestion_timestamp": as_of_timestamp(as_of),
        "bronze_ingestion_date": as_of_date(as_of),
        "data_quality_score": bronze_score(),
        "source_system": F.lit("google_maps_api"),
        "data_coleta_timestamp": parse_collection_timestamp(F.col("data_coleta")),
    })


def explode_reviews(df: DataFrame) -> DataFrame:
    """One row per review; a branch without reviews contributes none."""
    defaults = rules.DEFAULTS
    exploded = df.filter(has_reviews()).withColumn("review", F.explode("reviews"))
    return exploded.select(
        "place_id",
        F.col("name").alias("agencia_name"),
        F.col("formatted_address").alias("endereco_completo"),
        "latitude", "longitude",
        F.col("rating").alias("agencia_rating"),
        "total_avaliacoes", "bairro_pesquisado", "data_coleta", "data_coleta_timestamp",
        "bronze_ingestion_timestamp", "bronze_ingestion_date", "data_quality_score",
        "source_system",
        F.coalesce("review.author_name", F.lit(defaults["author_name"])).alias("author_name"),
        F.coalesce("review.rating", F.lit(defaults["review_rating"])).alias("review_rating"),
        F.coalesce("review.text", F.lit(defaults["review_text"])).alias("review_text"),
        F.coalesce("review.time", F.lit(defaults["review_time"]).cast("bigint")).alias("review_time"),
    )


def review_id(df: DataFrame, key: str = "hash") -> DataFrame:
    """Surrogate review key.

    ``hash`` is the compatible 32-bit key, which collides once a branch has many
    thousand reviews; ``sha256`` is the one to use at scale.
    """
    parts = [F.col("author_name"), F.col("review_text"), F.col("review_time").cast("string")]
    if key == "hash":
        digest = F.hash(F.concat(*parts)).cast("string")
    elif key == "sha256":
        digest = F.sha2(F.concat_ws("\u001f", *parts), 256)
    else:
        raise ValueError(f"unknown review key {key!r}")
    return df.withColumn("bronze_review_id", F.concat("place_id", F.lit("_"), digest))


def add_partitions(df: DataFrame, date_column: str) -> DataFrame:
    day = F.col(date_column)
    return df.withColumns({
        "partition_year": F.year(day),
        "partition_month": F.month(day),
        "partition_day": F.dayofmonth(day),
    })


def to_bronze(branches: DataFrame, as_of: str | None = None, key: str = "hash") -> DataFrame:
    audited = add_audit(branches, as_of).filter(valid_place())
    rows = review_id(explode_reviews(audited), key)
    return add_partitions(rows, "bronze_ingestion_date").select(*schemas.BRONZE.fieldNames())


def empty_bronze(spark: SparkSession) -> DataFrame:
    """A typed Bronze frame without rows."""
    return spark.createDataFrame([], schemas.BRONZE)


def minimize(df: DataFrame, allow) -> DataFrame:
    """Keep only declared fields; ``a.b`` keeps one nested field as ``a_b``."""
    return df.select(*[F.col(c).alias(c.replace(".", "_")) for c in allow])
