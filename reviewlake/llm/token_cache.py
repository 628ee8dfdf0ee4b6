"""Token counts through a digest cache.

The cache is a table of (tokenizer digest, content digest, count). Documents are
joined to it by the digests of their normalised content and of the tokenizer's
file; only distinct contents that it lacks are encoded, and their counts are
appended. A changed tokenizer file has another digest, so its counts never mix
with older ones.

Defined results: a null text counts as empty and has no tokens; ids may be null
or repeat, each row keeps its own result; an empty table gives an empty result;
columns other than id and text are never read. Contents that two concurrent
runs append twice count once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake.llm.common import body, named, slices, small_batches, stored
from reviewlake.llm.tokens import library_encoder
from reviewlake.session import scratch_path

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
LIMIT = 1024
CACHE_SCHEMA = "digest binary, n_tokens bigint, tokenizer string"


def file_digest(path: str) -> str:
    with open(path, "rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()


def cached_counts(spark: SparkSession, cache: str, tokenizer: str) -> DataFrame:
    """(digest, n_tokens) stored for a tokenizer digest; empty where nothing is stored yet."""
    try:
        rows = spark.read.schema(CACHE_SCHEMA).parquet(cache)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], CACHE_SCHEMA)
    return rows.where(F.col("tokenizer") == tokenizer).groupBy("digest").agg(F.min("n_tokens").alias("n_tokens"))


def fill_cache(docs: DataFrame, cache: str, text_col: str = "text", tokenizer: str = TOKENIZER) -> None:
    """Encodes the distinct contents that the cache lacks and appends their counts."""
    small_batches(docs)
    key = file_digest(tokenizer)
    text = body(text_col)
    content = docs.select(F.unhex(F.sha2(text, 256)).alias("digest"), text.alias("body"))
    known = cached_counts(docs.sparkSession, cache, key)
    misses = content.join(known, "digest", "left_anti").distinct()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = library_encoder(tokenizer)
        for batch in slices(batches):
            counts = [len(encode(t)) // 4 for t in batch["body"].to_pylist()]
            yield pa.record_batch({"digest": batch["digest"], "n_tokens": pa.array(counts, pa.int64())})

    (misses.mapInArrow(work, "digest binary, n_tokens bigint").withColumn("tokenizer", F.lit(key))
     .write.mode("append").partitionBy("tokenizer").parquet(cache))


def token_counts(docs: DataFrame, cache: str | None = None, id_col: str = "doc_id", text_col: str = "text",
                 tokenizer: str = TOKENIZER, limit: int = LIMIT) -> DataFrame:
    """Per document: id, n_bytes, n_tokens, over_limit. Without ``cache`` a new one is begun."""
    cache = cache or scratch_path(docs.sparkSession, "token-cache")
    fill_cache(docs, cache, text_col, tokenizer)
    # Stored, so that the join is one of two plain shuffles, whose hot side can be split.
    counts = stored(cached_counts(docs.sparkSession, cache, file_digest(tokenizer)), "token-counts")
    text = body(text_col)
    rows = docs.select(named(id_col).alias(id_col), F.octet_length(text).cast("long").alias("n_bytes"),
                       F.unhex(F.sha2(text, 256)).alias("_digest"))
    joined = rows.join(counts.withColumnRenamed("digest", "_digest"), "_digest", "left")
    return joined.select(named(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
