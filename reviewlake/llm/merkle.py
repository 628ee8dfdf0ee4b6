"""Merkle dataset manifest with nested-interval labels.

1. Every row becomes a leaf digest, computed where the row lies; only ids and
   digests are sorted. A range sort by (source, id) numbers the leaves: rows per
   range are counted, and a leaf's rank is its range's offset plus its place.
2. Nodes are labelled with the interval of leaf ranks they cover, ``[lo, hi)``.
   Runs of 16 become the nodes of the next level, one grouping per level and a
   sixteenth of the rows each time, until one node covers the whole tree.
3. From the top down, every node joins the node above that contains its
   interval, within buckets of the upper level's width, so a bucket holds one
   upper node and at most 16 lower ones. The interval difference within that
   parent gives the siblings. A node hands its path down, so a leaf gets the
   siblings of all levels without meeting every level itself.

The trees of the sources and the tree over their subroots are grown and
labelled by the same functions. No source is ever held by one task.

Defined results: a null in any hashed column is ``-``; null ids come first and
are never altered; rows that repeat an id are ordered by their leaf digests; a
lone document is subroot and root, its proof the digest of no siblings; an empty
table gives an empty result; columns other than the five are never read. Texts
of any length are hashed whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewlake.llm.common import named, shuffle_partitions, stored

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FAN = 16
#: One document in so many is altered.
ALTERED = 5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(*inputs: Column) -> Column:
    """H: the lowercase hex SHA-256 of the inputs one after another."""
    return F.sha2(F.concat(*inputs), 256)


def field(value: Column) -> Column:
    """``-`` for null, else the byte count, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digests(docs: DataFrame) -> DataFrame:
    """(doc_id, source, leaf, altered): ``altered`` is the leaf of a tampered row, else null."""
    hit = F.crc32(named("doc_id").cast("string").cast("binary")) % ALTERED == 0
    tampered = [F.translate(named(c), UPPER, LOWER) if c == "text" else named(c) for c in FIELDS]
    return docs.select(
        named("doc_id").alias("doc_id"), named("source").cast("string").alias("source"),
        digest(*[field(named(c)) for c in FIELDS]).alias("leaf"),
        F.when(hit, digest(*map(field, tampered))).alias("altered"))


def numbered(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """The rows with ``rank``, their place in the order from 0, and ``part``, the range that holds them."""
    ranges = shuffle_partitions(rows.sparkSession)
    by = [F.asc_nulls_first(c) for c in order]
    placed = stored(rows.repartitionByRange(ranges, *by).sortWithinPartitions(*by)
                    .withColumn("at", F.monotonically_increasing_id())
                    .withColumn("part", F.shiftrightunsigned("at", 33)), name)
    # One row per range: as many as there are partitions.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("part").agg(F.count(F.lit(1)).alias("rows")).select(
        "part", (F.coalesce(F.sum("rows").over(before), F.lit(0)) - F.shiftleft("part", 33)).alias("offset"))
    return (placed.join(F.broadcast(offsets), "part")
            .withColumn("rank", F.col("at") + F.col("offset")).drop("at", "offset"))


def height(n: int) -> int:
    """Levels of runs above ``n`` leaves; a lone leaf has a level of its own, so that every leaf is in a run."""
    levels, reach = 1, FAN
    while reach < n:
        levels, reach = levels + 1, reach * FAN
    return levels


def runs(nodes: DataFrame, width: int, extra: list[str]) -> DataFrame:
    """The nodes (base, n, lo, hi, digest) grouped into nodes of the next level.

    ``base`` and ``n`` are a tree's first leaf and number of leaves, ``width`` the leaves under a full new node.
    """
    kept = F.struct("lo", "hi", "digest", *extra)
    grouped = (nodes.groupBy("base", "n", F.floor((F.col("lo") - F.col("base")) / width).alias("place"))
               .agg(F.array_sort(F.collect_list(kept)).alias("children")))
    joined = F.array_join(F.transform("children", lambda c: c["digest"]), "")
    lone = (F.col("n") == 1)
    return grouped.select(
        "base", "n", F.col("children")[0]["lo"].alias("lo"),
        F.element_at("children", -1)["hi"].alias("hi"),
        F.when(lone, F.col("children")[0]["digest"]).otherwise(F.sha2(joined, 256)).alias("digest"), "children")


def grow(leaves: DataFrame, levels: int, name: str, extra: list[str]) -> list[DataFrame]:
    """The stored levels of all trees, lowest first. Level k ends the trees of at most 16**k leaves."""
    found = [stored(runs(leaves, FAN, extra), f"{name}-1")]
    for k in range(2, levels + 1):
        open_nodes = found[-1].where(F.col("n") > FAN ** (k - 1)).select("base", "n", "lo", "hi", "digest")
        found.append(stored(runs(open_nodes, FAN ** k, []), f"{name}-{k}"))
    return found


def roots(levels: list[DataFrame]) -> DataFrame:
    """(base, n, digest): the nodes that cover a whole tree, each at the level that ends it."""
    whole = [level.where(F.col("hi") - F.col("lo") == F.col("n")).where(F.col("n") > (FAN ** k if k else 0))
             .select("base", "n", "digest") for k, level in enumerate(levels)]
    result = whole[0]
    for other in whole[1:]:
        result = result.unionByName(other)
    return result


def siblings(children: Column, lo: Column) -> Column:
    """What the interval from ``lo`` leaves of its parent: the digests left and right of it."""
    def joined(part: Column) -> Column:
        return F.array_join(F.transform(part, lambda c: c["digest"]), "")

    return F.struct(joined(F.filter(children, lambda c: c["lo"] < lo)).alias("left"),
                    joined(F.filter(children, lambda c: c["lo"] > lo)).alias("right"))


def descend(levels: list[DataFrame], tops: DataFrame) -> DataFrame:
    """The lowest nodes with ``path``, the siblings of all nodes above, lowest first.

    ``tops`` has (base, path, ...) of every tree; its columns are handed down.
    """
    handed = [c for c in tops.columns if c != "base"]
    paths = None
    for k in range(len(levels), 0, -1):
        level = levels[k - 1]
        # A tree's last level takes what the tree has; the others what the containing node has.
        ended = level.where(F.col("n") <= FAN ** k).join(tops, "base")
        if paths is None:
            paths = ended
            continue
        width = FAN ** (k + 1)
        bucket = F.floor((F.col("lo") - F.col("base")) / width).alias("bucket")
        above = paths.select("base", bucket, F.col("lo").alias("from"), F.col("hi").alias("to"),
                             F.col("children").alias("among"), *handed)
        within = level.where(F.col("n") > FAN ** k).select("*", bucket).join(above, ["base", "bucket"]).where(
            "from <= lo and hi <= to")
        path = F.concat(F.array(siblings(F.col("among"), F.col("lo"))), F.col("path"))
        paths = ended.unionByName(within.select(
            *level.columns, *[path.alias(c) if c == "path" else F.col(c) for c in handed]))
    return paths


def leaf_paths(lowest: DataFrame) -> DataFrame:
    """One row per leaf: its own columns as ``c`` and the whole path."""
    own = F.when(F.col("n") == 1, F.expr("array()")).otherwise(F.array(siblings(F.col("children"), F.col("c.lo"))))
    return lowest.withColumn("c", F.explode("children")).withColumn(
        "path", F.concat(own, F.col("path")))


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, start, lambda held, p: digest(p["left"], held, p["right"]))


def manifest(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified."""
    ranked = numbered(leaf_digests(docs), ["source", "doc_id", "leaf"], "merkle-leaves")
    # At most a row per range and source of it: a hot source has a row per range.
    part_of = Window.partitionBy("source")
    parts = ranked.groupBy("part", "source").agg(F.min("rank").alias("first"), F.count(F.lit(1)).alias("rows")).select(
        F.col("part").alias("_part"), F.col("source").alias("_source"),
        F.min("first").over(part_of).alias("base"), F.sum("rows").over(part_of).alias("n"))
    parts = stored(parts, "merkle-sources")
    leaves = ranked.join(parts, (F.col("part") == F.col("_part")) & F.col("source").eqNullSafe(F.col("_source"))).select(
        "base", "n", F.col("rank").alias("lo"), (F.col("rank") + 1).alias("hi"), F.col("leaf").alias("digest"),
        "doc_id", "altered")
    largest = parts.agg(F.max("n")).first()[0] or 1
    levels = grow(leaves, height(largest), "merkle", ["doc_id", "altered"])

    # The tree over the subroots: sources in order, which is the order of their first leaves.
    subroots = numbered(roots(levels), ["base"], "merkle-subroots")
    count = subroots.count()
    top = grow(subroots.select(F.lit(0).cast("long").alias("base"), F.lit(count).cast("long").alias("n"),
                               F.col("rank").alias("lo"), (F.col("rank") + 1).alias("hi"), "digest",
                               F.col("base").alias("source_base")),
               height(count), "merkle-top", ["source_base"])
    nothing = F.expr("cast(array() as array<struct<left string, right string>>)")
    above = leaf_paths(descend(top, roots(top).select("base", F.col("digest").alias("root"), nothing.alias("path"))))
    tops = stored(above.select(F.col("c.source_base").alias("base"), F.col("c.digest").alias("subroot"), "root", "path"),
                  "merkle-tops")

    found = leaf_paths(descend(levels, tops)).select(
        "c.doc_id", F.col("c.digest").alias("leaf"), "subroot", "root",
        F.sha2(F.array_join(F.transform("path", lambda p: F.concat(p["left"], p["right"])), ""), 256).alias("proof_sha256"),
        folded(F.coalesce("c.altered", "c.digest"), F.col("path")).alias("folded_root"))
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))
