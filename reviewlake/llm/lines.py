"""Line deduplication by the spread of a line over distinct sites.

A line seen on many sites is boilerplate. Its sites are counted by a
HyperLogLog sketch per line hash; sketches are built per task and merged by the
aggregation. Lines whose estimate lies close to the limit get an exact count of
distinct sites; estimates further away than the sketch can err are decided by
the sketch. Boilerplate lines are then removed wherever they stand.

Everything is DataFrame operations. A line found on a third of all rows is one
sketch per task, and its removal is a join whose probing side can be split.

Defined results: a null text has no lines and comes back null; lines are
compared without blanks at their ends, shorter ones are never removed; a null
site is a site of its own; repeated rows and null ids each keep their own
result; an empty table gives an empty result; other columns are never read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlake.llm.common import named, stored

#: Distinct sites that make a line boilerplate, and the characters it needs.
MIN_SITES = 10
MIN_CHARS = 20
#: log2 of a sketch's registers; its relative standard error is 1.04 / sqrt(2**LG_K).
LG_K = 12
#: Standard errors around the limit within which lines are counted exactly.
ERRORS = 6


def hashed_lines(docs: DataFrame, site_col: str, text_col: str, min_chars: int) -> DataFrame:
    """(h, site): 128-bit hashes of a document's distinct lines that are long enough."""
    lines = F.array_distinct(F.transform(F.split(named(text_col), "\n"), lambda line: F.trim(line)))
    return (docs.select(F.coalesce(named(site_col).cast("string"), F.lit("")).alias("site"), F.explode(lines).alias("line"))
            .where(F.char_length("line") >= min_chars).select(F.unhex(F.md5("line")).alias("h"), "site"))


def boilerplate(docs: DataFrame, site_col: str = "source", text_col: str = "text",
                min_sites: int = MIN_SITES, min_chars: int = MIN_CHARS) -> DataFrame:
    """Stored hashes (h) of the lines found on ``min_sites`` distinct sites or more."""
    lines = hashed_lines(docs, site_col, text_col, min_chars)
    band = max(1.0, ERRORS * 1.04 / 2 ** (LG_K / 2) * min_sites)
    spread = (lines.groupBy("h").agg(F.hll_sketch_agg("site", F.lit(LG_K)).alias("sketch"))
              .select("h", F.hll_sketch_estimate("sketch").alias("sites")).where(F.col("sites") >= min_sites - band))
    spread = stored(spread, "line-spread")
    near = spread.where(F.col("sites") <= min_sites + band).select("h")
    exact = (lines.join(near, "h", "left_semi").distinct().groupBy("h").agg(F.count(F.lit(1)).alias("n"))
             .where(F.col("n") >= min_sites).select("h"))
    return stored(spread.where(F.col("sites") > min_sites + band).select("h").union(exact), "boilerplate")


def remove_boilerplate(docs: DataFrame, id_col: str = "doc_id", site_col: str = "source", text_col: str = "text",
                       min_sites: int = MIN_SITES, min_chars: int = MIN_CHARS) -> DataFrame:
    """Per document: id, n_lines, n_removed, clean_text."""
    common = boilerplate(docs, site_col, text_col, min_sites, min_chars)
    text_hash = F.xxhash64(named(text_col))
    # A line is named by its number and itself, so that array_except can work by hash.
    name = lambda i, line: F.concat(i.cast("string"), F.lit(":"), line)
    placed = (docs.select(named(id_col).alias("id"), text_hash.alias("text_hash"),
                          F.posexplode(F.split(named(text_col), "\n")).alias("pos", "line"))
              .where(F.char_length(F.trim("line")) >= min_chars))
    gone = (placed.withColumn("h", F.unhex(F.md5(F.trim("line")))).join(common, "h", "left_semi")
            .groupBy("id", "text_hash").agg(F.collect_set(name(F.col("pos"), F.col("line"))).alias("gone")))
    texts = docs.select(named(id_col).alias("id"), named(text_col).alias("body"), text_hash.alias("text_hash"))
    same = texts["id"].eqNullSafe(gone["id"]) & (texts["text_hash"] == gone["text_hash"])
    kept = F.array_except(F.transform(F.split("body", "\n"), lambda line, i: name(i, line)), F.col("gone"))
    bare = F.transform(kept, lambda s: s.substr(F.locate(":", s) + 1, F.char_length(s)))
    return texts.join(gone, same, "left").select(
        texts["id"].alias(id_col), F.coalesce(F.size(F.split("body", "\n")), F.lit(0)).cast("long").alias("n_lines"),
        F.size(F.coalesce("gone", F.array().cast("array<string>"))).cast("long").alias("n_removed"),
        F.when(F.col("gone").isNull(), F.col("body")).otherwise(F.array_join(bare, "\n")).alias("clean_text"))
