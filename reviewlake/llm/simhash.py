"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints at most ``2h`` bits apart have a common variant within ``h``
bits of both. So every distinct fingerprint emits all variants within ``h``
bits; rows of one variant are all within ``2h`` bits of each other, and a star
from the smallest of them joins what all their pairs would. The links are made
distinct and verified by counting bits.

Copies share a fingerprint and are folded before anything is emitted, and a
variant's rows are at most the fingerprints within ``h`` bits of it (65 for
h = 1), so no group grows with the data.

Defined results: a null, empty or blank text has no words, hence fingerprint
zero, and is linked like any other; texts of fewer words than a shingle hash
their whole word sequence; null ids lose against any other id; repeated rows
come back as often as they are; an empty table gives an empty result; other
columns are never read.

``drop_similar`` is the mode of a pipeline stage: texts are near copies if the
sets of their five-word shingles have a Jaccard similarity of 0.8. Candidates come
from ball hashing as above, on fingerprints of five-word shingles, and, as most
pairs at 0.8 differ in more bits than a ball can hold, from 24 bands of five
minimum hashes; a pair at 0.8 shares no band with probability 7e-5. Every
candidate link is verified on the texts' shingle hashes.

Candidates are taken in steps (balls and one band, five bands, all others), and texts
that are linked are contracted to components in between. In a step, every text of
a bucket whose component is not the bucket's first one meets the first one's
smallest text; a large group of copies is linked by its first bucket, and the
other bands find nothing left to compare. Texts that still share a bucket with
another component (many share a passage without being similar) are compared by
their shingles, rarest first: two texts of n and m shingles at 0.8 share at least
4 (n + m) / 9 of them, so they share one that stands early enough in both orders.
Those pairs of different components are all verified, at once and whatever their
buckets; no bucket is capped. Texts pair only if they share what is rare among
them, so a common passage pairs nothing while texts have a ninth of words of their own.
Before a pair is made, the parities of its texts' shingles in 1,024 cells are compared:
every cell that differs holds a shingle of one text alone, and two similar texts have
at most (n + m) / 9 of those. So texts that are nearly similar to one another make no
rows, and no similar pair is lost.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewlake.llm.common import body, named, slices, small_batches, sql_type, stored
from reviewlake.llm.components import connected_components
from reviewlake.llm.decontam import sent

SHINGLE = 3
SEED = 42
RADIUS = 2
#: Shingles whose hashes are held at once.
SLICE = 1 << 18


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint of a UTF-8 text; only A-Z are lower-cased, only ASCII blanks separate."""
    words = text.lower().split()
    if not words:
        return 0
    size = min(shingle, len(words))
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[: len(words) - size + 1].tolist()
    ends = ends[size - 1:].tolist()
    total = len(starts)
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, total, SLICE):
        hashes = np.array([digest(joined[a:b], SEED) for a, b in
                           zip(starts[at:at + SLICE], ends[at:at + SLICE])], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > total, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = SHINGLE) -> DataFrame:
    """(id, fp) with the fingerprint as a signed long, one row per document."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [fingerprint(t, shingle) for t in batch["body"].cast(pa.binary()).to_pylist()]
            yield pa.record_batch({"id": batch["id"], "fp": pa.array(np.array(found, np.uint64).view(np.int64))})

    small_batches(docs)
    return docs.select(named(id_col).alias("id"), body(text_col).alias("body")).mapInArrow(
        work, f"id {sql_type(docs, id_col)}, fp bigint")


def signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Verified links (a, b) that join all fingerprints within ``radius`` bits; ``distinct`` has fp."""
    if radius < 2 or radius % 2:
        raise ValueError("the radius must be even")
    flips = [signed(sum(1 << bit for bit in bits)) for n in range(radius // 2 + 1)
             for bits in itertools.combinations(range(64), n)]
    variants = distinct.select("fp", F.explode(F.array(*map(F.lit, flips))).alias("flip")).select(
        "fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("variant"))
    first = F.min("fp").over(Window.partitionBy("variant"))
    return (variants.select("fp", first.alias("a")).where("a != fp").select("a", F.col("fp").alias("b"))
            .distinct().where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius))


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row per document: id, fingerprint (16 hex digits), component_id."""
    prints = stored(fingerprints(docs, id_col, text_col, shingle), "simhash")
    distinct = stored(prints.groupBy("fp").agg(F.min("id").alias("first")), "simhash-distinct")
    roots = connected_components(links(distinct, radius))
    placed = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    placed = stored(placed, "simhash-roots")
    smallest = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    groups = placed.join(smallest, "root").select("fp", "component_id")
    return prints.join(groups, "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows whose id is the smallest of their component.

    Ids are taken to be unique, as they are after exact deduplication; a
    component without any id keeps its rows.
    """
    groups = near_groups(docs, id_col, text_col)
    gone = stored(groups.where(f"`{id_col}` != component_id or (`{id_col}` is null and component_id is not null)")
                  .select(F.col(f"`{id_col}`").alias("_gone"), "component_id"), "simhash-gone")
    return docs.join(gone.select("_gone").distinct(), named(id_col).eqNullSafe(F.col("_gone")), "left_anti")


#: The stage mode: words per shingle, least similarity, bands and minimum hashes per band.
STAGE_SHINGLE, SIMILARITY, BANDS, BAND_ROWS = 5, 0.8, 24, 5
#: Bands whose buckets are compared at once; band 0 are the balls.
STEPS = (range(0, 2), range(2, 7), range(7, BANDS + 1))
#: Longs that hold the parities of a text's shingles.
PARITIES = 16
#: Bytes of texts' hashes up to which they are sent to the pairs instead of shuffled.
HASH_BYTES = 4 << 20


def shingle_hashes(text: bytes, shingle: int = STAGE_SHINGLE) -> np.ndarray:
    """The distinct hashes of a text's shingles, ascending; a text of fewer words is one shingle."""
    words = text.lower().split()
    size = min(shingle, len(words))
    grams = {b" ".join(words[i:i + size]) for i in range(len(words) - size + 1)}
    return np.unique(np.fromiter((xxhash.xxh64_intdigest(g, SEED) for g in grams), np.uint64, len(grams)))


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def band_keys(hashes: np.ndarray, factors: np.ndarray) -> list[int]:
    """One key per band, from the smallest of the shingles' hashes under each permutation."""
    least = np.full(len(factors), ~np.uint64(0))
    for at in range(0, len(hashes), 1024):
        mixed = hashes[at:at + 1024, None] * factors
        np.minimum(least, (mixed ^ (mixed >> np.uint64(31))).min(axis=0), out=least)
    least = least.reshape(BANDS, BAND_ROWS)
    return [xxhash.xxh64_intdigest(row.tobytes(), band) - (1 << 63) for band, row in enumerate(least)]


def parities(hashes: np.ndarray) -> np.ndarray:
    """Whether the number of hashes in a cell is odd, a bit for each of the cells."""
    cells = np.bincount((hashes.view(np.uint64) % np.uint64(64 * PARITIES)).astype(np.int64), minlength=64 * PARITIES)
    return np.packbits((cells & 1).astype(np.uint8), bitorder="little").view(np.int64)


def majority(hashes: np.ndarray) -> int:
    """The fingerprint of a set of hashes."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), SLICE):
        bits = np.unpackbits(hashes[at:at + SLICE].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return signed(int.from_bytes(np.packbits(2 * ones > len(hashes), bitorder="little").tobytes(), "little"))


def sketches(texts: DataFrame) -> DataFrame:
    """Stored (node, first, n, fp, keys) of the distinct texts among (id, node, body)."""
    factors = np.random.default_rng(SEED).integers(0, 1 << 63, BANDS * BAND_ROWS, np.uint64) * np.uint64(2) + np.uint64(1)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            hashes = [shingle_hashes(t) for t in batch["body"].cast(pa.binary()).to_pylist()]
            yield pa.record_batch({
                "id": batch["id"], "node": batch["node"], "fp": pa.array([majority(h) for h in hashes], pa.int64()),
                "keys": pa.array([band_keys(h, factors) for h in hashes], pa.list_(pa.int64()))})

    small_batches(texts)
    found = texts.mapInArrow(work, f"id {sql_type(texts, 'id')}, node binary, fp bigint, keys array<bigint>")
    return stored(found.groupBy("node").agg(
        F.min("id").alias("first"), F.count(F.lit(1)).alias("n"), F.first("fp").alias("fp"),
        F.first("keys").alias("keys")), "similar-nodes")


def bucket_members(nodes: DataFrame) -> DataFrame:
    """Stored (band, key, node) of the buckets that hold more than one text."""
    roots = connected_components(links(nodes.select("fp").distinct()))
    ball = F.xxhash64(F.coalesce("root", "fp"))
    placed = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "node", F.posexplode(F.concat(F.array(ball), "keys")).alias("band", "key"))
    # Keys are hashed with their band.
    shared = placed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    return stored(placed.join(sent(stored(shared, "similar-buckets")), "key"), "similar-members")


def hashed(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, hashes) from a stored table: the shingle hashes of the wanted texts (node, n), each once."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [shingle_hashes(t).tobytes() for t in batch["body"].cast(pa.binary()).to_pylist()]
            yield pa.record_batch({"node": batch["node"], "n": batch["n"], "hashes": pa.array(found, pa.binary())})

    some = texts.select("node", "body").join(sent(wanted), "node").select("node", "n", "body")
    held = stored(some.mapInArrow(work, "node binary, n bigint, hashes binary"), "similar-hashes")
    # Only repeated texts have to be folded.
    return held.where("n = 1").select("node", "hashes").unionByName(
        held.where("n > 1").groupBy("node").agg(F.first("hashes").alias("hashes")))


def similar_pairs(pairs: DataFrame, hashes: DataFrame) -> DataFrame:
    """Stored links: the pairs (a, b) whose texts are similar."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            keep = [similarity(np.frombuffer(of_a, np.uint64), np.frombuffer(of_b, np.uint64)) >= SIMILARITY
                    for of_a, of_b in zip(batch["of_a"].to_pylist(), batch["of_b"].to_pylist())]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    # The hashes of the texts that pairs name go to the pairs if they are few; else pairs are shuffled to them.
    nodes = stored(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "similar-paired")
    few = sent(stored(hashes.join(sent(nodes), "node", "left_semi"), "similar-few"), HASH_BYTES)
    first = few.select(F.col("node").alias("a"), F.col("hashes").alias("of_a"))
    second = few.select(F.col("node").alias("b"), F.col("hashes").alias("of_b"))
    whole = pairs.join(first, "a").join(second, "b")
    return stored(whole.select("a", "b", "of_a", "of_b").mapInArrow(work, "a binary, b binary"), "similar-links")


def contracted(members: DataFrame, roots: DataFrame | None) -> DataFrame:
    """Stored (key, node, root) of the buckets that hold more than one component."""
    if roots is None:
        placed = members.select("key", "node", F.col("node").alias("root"))
    else:
        placed = stored(members.join(roots, "node", "left").select(
            "key", "node", F.coalesce("root", "node").alias("root")), "similar-placed")
    mixed = placed.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low != high")
    return stored(placed.join(stored(mixed.select("key"), "similar-mixed"), "key", "left_semi"), "similar-apart")


def to_first(apart: DataFrame) -> DataFrame:
    """Each bucket's texts against the smallest text of its first component."""
    first = apart.groupBy("key").agg(F.min(F.struct("root", "node")).alias("first"))
    return apart.join(first, "key").where("root != first.root").select("first.node", F.col("node").alias("other"))


def ordered_shingles(apart: DataFrame, hashes: DataFrame) -> DataFrame:
    """Stored (key, node, root, size, at): the shingles that a link of a text may rest on, ``at`` from the rarest one.

    Only shingles of several texts are rows; those of one text alone come before them and are counted.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 16):
            found = [np.frombuffer(h, np.int64) for h in batch["hashes"].to_pylist()]
            yield pa.record_batch({"key": pa.array(np.concatenate(found)),
                                   "text": pa.array(np.repeat(batch["text"].to_numpy(), list(map(len, found))))})

    placed = stored(apart.select("node", "root").distinct().withColumn("text", F.monotonically_increasing_id()), "similar-texts")
    given = hashes.join(sent(placed), "node")
    rows = given.select("text", "hashes").mapInArrow(work, "key bigint, text bigint")
    rows = rows.withColumn("texts", F.count(F.lit(1)).over(Window.partitionBy("key"))).where("texts > 1")
    text = Window.partitionBy("text")
    rows = rows.select("key", "text", F.count(F.lit(1)).over(text).alias("shared"),
                       F.row_number().over(text.orderBy("texts", "key")).alias("i"))
    sizes = stored(given.select("text", "node", "root", (F.octet_length("hashes") / 8).cast("long").alias("size")), "similar-sizes")
    # A partner has at least four fifths of the text's shingles, so both share at least that many.
    return stored(rows.join(sent(sizes), "text").withColumn("at", F.expr("size - shared + i - 1"))
                  .where("5 * (size - at) >= 4 * size").select("key", "node", "root", "size", "at"), "similar-early")


def with_parities(rows: DataFrame, hashes: DataFrame) -> DataFrame:
    """The rows (node, ...) with the parities of their texts' shingles as ``cells``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [parities(np.frombuffer(h, np.int64)) for h in batch["hashes"].to_pylist()]
            yield pa.record_batch({"node": batch["node"], "cells": pa.array(found, pa.list_(pa.int64()))})

    nodes = sent(stored(rows.select("node").distinct(), "similar-late"))
    some = hashes.join(nodes, "node", "left_semi").mapInArrow(work, "node binary, cells array<bigint>")
    return rows.join(sent(stored(some, "similar-parities")), "node")


def to_alike(apart: DataFrame, hashes: DataFrame) -> DataFrame:
    """The pairs of texts of different components whose first common shingle, and the number of shingles
    that only one of them can be seen to have, leave room for a similarity of 0.8."""
    rows = ordered_shingles(apart, hashes)
    # Of two texts, the shorter one's shingle is among its first ninth.
    parts = rows.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"), F.max(F.expr("9 * (size - at) >= 8 * size")).alias("first"))
    main = parts.groupBy("key").agg(F.max(F.struct("n", "root")).alias("main"), F.count(F.lit(1)).alias("parts"),
                                    F.max("first").alias("first")).where("parts > 1 and first")
    # The largest component of a shingle is never paired with itself.
    main = sent(stored(main.select("key", F.col("main.root").alias("main")), "similar-main"))
    rows = stored(with_parities(rows.join(main, "key"), hashes), "similar-meeting")
    small = rows.where("root != main").drop("main")
    other = rows.select("key", *(F.col(c).alias(f"other_{c}") for c in ("node", "root", "size", "at", "cells")))
    alone = sum(F.bit_count(F.col("cells")[i].bitwiseXOR(F.col("other_cells")[i])) for i in range(PARITIES))
    return small.join(other, (small["key"] == other["key"]) & F.expr(
        "root != other_root and 9 * least(size - at, other_size - other_at) >= 4 * (size + other_size)")
        & (9 * alone <= F.expr("size + other_size"))).select("node", F.col("other_node").alias("other"))


def similar_components(nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """(node, root) of the ``nodes`` that have near copies; ``texts`` has (node, body)."""
    members = bucket_members(nodes)
    wanted = members.select("node").distinct().join(nodes.select("node", "n"), "node")
    hashes = hashed(texts, stored(wanted, "similar-wanted"))
    found, roots, met = None, None, None
    steps = [(members.where(F.col("band").isin(list(bands))), to_first) for bands in STEPS]
    for some, against in [*steps, (members, functools.partial(to_alike, hashes=hashes))]:
        pairs = against(contracted(some, roots)).select(
            F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()
        pairs = stored(pairs if met is None else pairs.join(met, ["a", "b"], "left_anti"), "similar-pairs")
        met = pairs if met is None else met.unionByName(pairs)
        more = similar_pairs(pairs, hashes)
        if not more.isEmpty():
            found = more if found is None else found.unionByName(more)
            roots = stored(connected_components(found), "similar-roots")
    return roots


def drop_similar(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows whose id is the smallest of their component of similar texts; ids are as in ``drop_near_copies``."""
    node = F.unhex(F.md5(body(text_col).cast("binary")))
    rows = docs.select(named(id_col).alias("id"), node.alias("node"))
    texts = docs.select(named(id_col).alias("id"), node.alias("node"), body(text_col).alias("body"))
    nodes = sketches(texts)
    roots = similar_components(nodes, texts)
    placed = nodes.select("node", "first", "n")
    if roots is not None:
        placed = stored(placed.join(roots, "node", "left").select(
            "node", "first", "n", F.coalesce("root", "node").alias("root")), "similar-placed")
    else:
        placed = placed.withColumn("root", F.col("node"))
    smallest = placed.groupBy("root").agg(F.min("first").alias("component_id"), F.sum("n").alias("rows"))
    groups = placed.join(smallest.where("rows > 1"), "root").select("node", "component_id")
    gone = stored(rows.join(groups, "node").where("id != component_id or (id is null and component_id is not null)")
                  .select(F.col("id").alias("_gone"), F.col("node").alias("_node")).distinct(), "similar-gone")
    same = named(id_col).eqNullSafe(F.col("_gone")) & (node == F.col("_node"))
    return docs.join(sent(gone), same, "left_anti")
