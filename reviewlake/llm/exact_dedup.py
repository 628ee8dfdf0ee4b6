"""Exact deduplication by an exchange of Golomb-coded fingerprints.

1. Every partition cuts its rows into blocks. A block sorts its distinct
   fingerprints, deals them to owners by hash range and codes each owner's list
   as Golomb-Rice gaps. Only these lists travel.
2. An owner merges the lists of one hash range and answers each with a bitmap
   of the fingerprints that other lists hold too.
3. A block's suspects are the fingerprints whose bit is set or that repeat
   inside the block. Rows that the bitmaps clear are alone: they get their own
   id and size 1. Suspects' texts are grouped by the text itself, which checks
   them byte for byte and gives the id that stays and the size.

Suspected fingerprints, one per repeated text, are sent to the texts up to a
checked size, and then only suspects' texts are shuffled; beyond it the texts
are shuffled to the fingerprints. Rows find their group by fingerprint and
SHA-256, in the same two ways. A fingerprint travels once per block however
often it occurs, and grouping by text combines before the shuffle, so one group
holding a third of all rows is spread over all tasks.

Defined results: a null text equals the empty text; null ids lose against any
other id; of rows that repeat id and text, one stays; an empty table gives an
empty result; columns other than id and text are never read (``drop_copies``
returns them unchanged).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlake.llm.common import body, named, shuffle_partitions, small_batches, stored
from reviewlake.llm.decontam import sent

FINGERPRINT_BITS = 48
BLOCK_ROWS = 1 << 16


def rice_encode(values: np.ndarray, width: int) -> tuple[int, bytes]:
    """Ascending distinct values below ``2**width`` as the parameter k and the coded gaps.

    The quotients come first in unary, the k-bit remainders after them.
    """
    n = len(values)
    if not n:
        return 0, b""
    k = max(0, width - int(n).bit_length())
    gaps = np.diff(values.astype(np.int64), prepend=np.int64(0))
    quotients = gaps >> k
    ends = np.cumsum(quotients + 1)
    unary = np.zeros(int(ends[-1]), np.uint8)
    unary[ends - 1] = 1
    shifts = np.arange(k - 1, -1, -1, dtype=np.int64)
    rest = ((gaps[:, None] >> shifts) & 1).astype(np.uint8).ravel()
    return k, np.packbits(unary).tobytes() + np.packbits(rest).tobytes()


def rice_decode(code: bytes, n: int, k: int) -> np.ndarray:
    if not n:
        return np.empty(0, np.int64)
    rest_bytes = -(-n * k // 8)
    raw = np.frombuffer(code, np.uint8)
    unary = np.unpackbits(raw[: len(raw) - rest_bytes])
    quotients = np.diff(np.flatnonzero(unary)[:n], prepend=-1) - 1
    gaps = quotients.astype(np.int64) << k
    if k:
        bits = np.unpackbits(raw[len(raw) - rest_bytes:])[: n * k].reshape(n, k)
        gaps += bits.astype(np.int64) @ (np.int64(1) << np.arange(k - 1, -1, -1, dtype=np.int64))
    return np.cumsum(gaps)


def _block_rows(block: int, fps: np.ndarray, owner_bits: int) -> pa.RecordBatch:
    """One block as rows of (owner, coded distinct fingerprints, a bit for each that the block repeats)."""
    distinct, copies = np.unique(fps, return_counts=True)
    width = FINGERPRINT_BITS - owner_bits
    owners = distinct >> width
    cuts = np.flatnonzero(np.diff(owners, prepend=-1))
    stops = np.append(cuts[1:], len(distinct))
    coded = [rice_encode(distinct[a:b] & ((1 << width) - 1), width) for a, b in zip(cuts, stops)]
    count = len(cuts)
    return pa.record_batch({
        "sender": pa.array(np.full(count, TaskContext.get().partitionId(), np.int32)),
        "block": pa.array(np.full(count, block, np.int32)),
        "owner": pa.array(owners[cuts].astype(np.int32)),
        "n": pa.array((stops - cuts).astype(np.int32)),
        "k": pa.array([k for k, _ in coded], pa.int32()),
        "code": pa.array([c for _, c in coded], pa.binary()),
        "repeats": pa.array([np.packbits(copies[a:b] > 1).tobytes() for a, b in zip(cuts, stops)], pa.binary()),
    })


def row_keys(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Stored (uid, id, fp, sha): each row's number, id, fingerprint and SHA-256."""
    text = body(text_col)
    return stored(docs.select(
        F.monotonically_increasing_id().alias("uid"), named(id_col).alias("id"), fingerprint(text).alias("fp"),
        F.unhex(F.sha2(text, 256)).alias("sha")), "dedup-keys")


def fingerprint(text: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(text), 64 - FINGERPRINT_BITS)


def send_blocks(keys: DataFrame, owner_bits: int) -> DataFrame:
    """The stored blocks of every partition of ``keys``."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, block = [], 0, 0
        for batch in batches:
            fps = batch["fp"].to_numpy()
            while len(fps):
                held.append(fps[:BLOCK_ROWS - rows])
                fps = fps[len(held[-1]):]
                rows += len(held[-1])
                if rows == BLOCK_ROWS:
                    yield _block_rows(block, np.concatenate(held), owner_bits)
                    held, rows, block = [], 0, block + 1
        if rows:
            yield _block_rows(block, np.concatenate(held), owner_bits)

    schema = "sender int, block int, owner int, n int, k int, code binary, repeats binary"
    return stored(keys.select("fp").mapInArrow(send, schema), "dedup-blocks")


def duplicate_bitmaps(blocks: DataFrame) -> DataFrame:
    """Per list: a bit for each fingerprint that another block's list holds too."""

    def reply(group: pa.Table) -> pa.Table:
        counts = group["n"].to_numpy()
        lists = [rice_decode(c.as_py(), int(n), int(k))
                 for c, n, k in zip(group["code"], counts, group["k"].to_numpy())]
        _, where, times = np.unique(np.concatenate(lists), return_inverse=True, return_counts=True)
        shared = np.split((times > 1)[where], np.cumsum(counts)[:-1])
        return group.select(["sender", "block", "owner"]).append_column(
            "bitmap", pa.array([np.packbits(s).tobytes() for s in shared], pa.binary()))

    return (blocks.select("sender", "block", "owner", "n", "k", "code").groupBy("owner")
            .applyInArrow(reply, "sender int, block int, owner int, bitmap binary"))


def suspects(blocks: DataFrame, owner_bits: int) -> DataFrame:
    """Stored distinct fingerprints (fp) that more than one row has."""
    width = FINGERPRINT_BITS - owner_bits

    def bits(raw: bytes, n: int) -> np.ndarray:
        return np.unpackbits(np.frombuffer(raw, np.uint8))[:n].astype(bool)

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                hit = bits(row["bitmap"], row["n"]) | bits(row["repeats"], row["n"])
                if hit.any():
                    fps = rice_decode(row["code"], row["n"], row["k"])[hit]
                    yield pa.record_batch({"fp": pa.array(fps + (np.int64(row["owner"]) << width))})

    lists = blocks.join(duplicate_bitmaps(blocks), ["sender", "block", "owner"])
    return stored(lists.mapInArrow(pick, "fp bigint").distinct(), "dedup-suspects")


def text_groups(docs: DataFrame, few: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The suspects' texts, one row each: fp, sha, keep_id (the largest id), group_size."""
    texts = docs.select(named(id_col).alias("id"), body(text_col).alias("body"),
                        fingerprint(body(text_col)).alias("fp"))
    return (texts.join(sent(few), "fp", "left_semi").groupBy("body")
            .agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
            .select(fingerprint(F.col("body")).alias("fp"), F.unhex(F.sha2("body", 256)).alias("sha"),
                    "keep_id", "group_size"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256, uid (the row's number)."""
    small_batches(docs)
    owner_bits = min(24, (shuffle_partitions(docs.sparkSession) - 1).bit_length())
    keys = row_keys(docs, id_col, text_col)
    few = suspects(send_blocks(keys, owner_bits), owner_bits)
    # Of rows that repeat the id that stays, the one with the largest number is kept.
    last = (keys.join(sent(few), "fp", "left_semi").groupBy("fp", "sha")
            .agg(F.max(F.struct("id", "uid")).alias("last")).select("fp", "sha", F.col("last.uid").alias("keep_uid")))
    groups = stored(text_groups(docs, few, id_col, text_col).join(last, ["fp", "sha"]), "dedup-groups")
    alone = F.col("group_size").isNull()
    return keys.join(sent(groups), ["fp", "sha"], "left").select(
        F.col("id").alias(id_col),
        F.when(alone, F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (alone | (F.col("uid") == F.col("keep_uid"))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"), "uid")


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without exact copies; of equal texts the largest id stays.

    Rows that repeat id and text can differ in other columns: the one whose JSON form is largest stays,
    so columns need no order (maps have none).
    """
    found = (exact_groups(docs, id_col, text_col).where("group_size > 1")
             .groupBy(F.col(f"`{id_col}`").alias("_id"), F.unhex("text_sha256").alias("_sha"))
             .agg(F.max("kept").alias("_kept"), F.count(F.lit(1)).alias("_rows")))
    found = stored(found, "dedup-found")
    text_sha = F.unhex(F.sha2(body(text_col), 256))

    def joined(which, how):
        same = named(id_col).eqNullSafe(which["_id"]) & (text_sha == which["_sha"])
        return docs.join(which, same, how)

    rest = joined(sent(found.where("not _kept or _rows > 1")), "left_anti")
    repeated = joined(sent(found.where("_kept and _rows > 1")), "left_semi")
    one = (repeated.select(F.struct(*map(named, docs.columns)).alias("row"))
           .groupBy(F.col("row").getField(id_col).alias("_id"),
                    F.sha2(F.coalesce(F.col("row").getField(text_col), F.lit("")), 256).alias("_sha"))
           .agg(F.max_by("row", F.to_json("row")).alias("row")).select("row.*"))
    return rest.unionByName(one)
