"""Byte-level BPE encoding with overlapping chunks, and decoding.

Long texts are cut into chunks that overlap. Chunks are split into pre-tokens
in parallel; in the overlap of two neighbours, the first position at which
both begin a pre-token is where they resynchronise, since a match of the
pattern depends only on where it begins and on what follows. The text between
two such positions is then encoded piece by piece, again in parallel, and the
ids are put together in order. Decoding concatenates the raw bytes of the ids.

Where two chunks share no boundary (one run of letters longer than the
overlap) the whole text is one piece. Texts of one chunk are one piece.

Defined results: a null text counts as empty and has no ids; ids may be null
or repeat, each row keeps its own result; an empty table gives an empty
result; columns other than id and text are never read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewlake.llm.common import body, named, slices, small_batches, sql_type, stored
from reviewlake.llm.tokens import rank_encoder, read_ranks

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
#: Characters of a chunk, and how many more of the next one it repeats.
CHUNK = 1 << 16
OVERLAP = 1 << 10
#: Characters a match may need to see beyond its end (the longest contraction).
AHEAD = 4


def cut(docs: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """Stored chunks (uid, id, idx, at, last, part) of the given texts."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                text = batch["body"][i].as_py()
                starts = range(0, max(1, len(text) - overlap), chunk)
                for idx, at in enumerate(starts):
                    last = idx == len(starts) - 1
                    yield pa.record_batch({
                        "uid": batch["uid"].slice(i, 1), "id": batch["id"].slice(i, 1),
                        "idx": pa.array([idx], pa.int32()), "at": pa.array([at], pa.int64()),
                        "last": pa.array([last]),
                        "part": pa.array([text[at:] if last else text[at:at + chunk + overlap]])})

    kind = docs.schema["id"].dataType.simpleString()
    cut_up = docs.withColumn("uid", F.monotonically_increasing_id()).select("uid", "id", "body").mapInArrow(
        work, f"uid bigint, id {kind}, idx int, at bigint, last boolean, part string")
    return stored(cut_up.repartition("uid", "idx"), "bpe-chunks")


def boundaries(chunks: DataFrame, pattern: str, chunk: int, overlap: int) -> DataFrame:
    """Per chunk, the sure pre-token starts in its head and in its tail, as offsets in the text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        match = regex.compile(pattern)
        for batch in batches:
            heads, tails = [], []
            for at, last, part in zip(batch["at"].to_pylist(), batch["last"].to_pylist(),
                                      batch["part"].to_pylist()):
                head, tail = [], []
                for m in match.finditer(part):
                    b = m.start()
                    if b and part[b - 1].isspace():
                        continue
                    if b < overlap:
                        head.append(at + b)
                    if not last and chunk <= b <= len(part) - AHEAD:
                        tail.append(at + b)
                heads.append(head)
                tails.append(tail)
            yield pa.record_batch({"uid": batch["uid"], "idx": batch["idx"], "last": batch["last"],
                                   "head": pa.array(heads, pa.list_(pa.int64())),
                                   "tail": pa.array(tails, pa.list_(pa.int64()))})

    return chunks.select("uid", "idx", "at", "last", "part").mapInArrow(
        work, "uid bigint, idx int, last boolean, head array<bigint>, tail array<bigint>")


def stitched(chunks: DataFrame, pattern: str, chunk: int, overlap: int) -> DataFrame:
    """Pieces (uid, id, idx, piece) that, encoded one by one, give the ids of the texts."""
    order = Window.partitionBy("uid").orderBy("idx")
    meet = F.array_min(F.array_intersect("tail", F.lead("head").over(order)))
    spans = (boundaries(chunks, pattern, chunk, overlap)
             .select("uid", "idx", "last", meet.alias("stop"))
             .select("uid", "idx", "stop", F.lag("stop").over(order).alias("start"),
                     F.max(F.col("stop").isNull() & ~F.col("last")).over(Window.partitionBy("uid")).alias("apart")))
    spans = stored(spans, "bpe-spans")

    def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pieces = [part[(0 if start is None else start - at):(None if stop is None else stop - at)]
                      for at, start, stop, part in zip(*(batch[c].to_pylist()
                                                         for c in ("at", "start", "stop", "part")))]
            yield pa.record_batch({"uid": batch["uid"], "id": batch["id"], "idx": batch["idx"],
                                   "piece": pa.array(pieces, pa.string())})

    kind = chunks.schema["id"].dataType.simpleString()
    schema = f"uid bigint, id {kind}, idx int, piece string"
    placed = chunks.join(spans, ["uid", "idx"])
    parallel = placed.where("not apart").mapInArrow(slices, schema)
    whole = (placed.where("apart")
             .select("uid", "id", "idx", F.when(F.col("last"), F.col("part"))
                     .otherwise(F.substring("part", 1, chunk)).alias("part"))
             .groupBy("uid").agg(F.first("id").alias("id"), F.array_sort(F.collect_list(F.struct("idx", "part"))).alias("p"))
             .select("uid", "id", F.lit(0).alias("idx"), F.array_join("p.part", "").alias("piece")))
    return parallel.unionByName(whole)


Work = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def encoding(ranks: str, pattern: str, keep: tuple) -> Work:
    """``piece`` becomes its ids as little-endian unsigned 32-bit integers; the columns ``keep`` stay."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = rank_encoder(ranks, pattern)
        for batch in slices(batches):
            ids = [encode(t) for t in batch["piece"].to_pylist()]
            yield pa.record_batch({**{c: batch[c] for c in keep}, "ids": pa.array(ids, pa.binary())})

    return work


def decoding(ranks: str) -> Work:
    """Adds ``decoded``: the raw bytes of the ids, put together."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = {rank: token for token, rank in read_ranks(ranks).items()}.__getitem__
        for batch in slices(batches):
            decoded = [b"".join(map(table, np.frombuffer(ids, "<u4").tolist()))
                       for ids in batch["ids"].to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(decoded, pa.binary())],
                                             [*batch.schema.names, "decoded"])

    return work


def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The ids of a text's pieces, put together in order."""
    for batch in batches:
        whole = [b"".join(p["ids"] for p in row) for row in batch["p"].to_pylist()]
        yield pa.record_batch({"id": batch["id"], "ids": pa.array(whole, pa.binary())})


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks: str = RANKS,
           pattern: str = public_tokenizers.PATTERN, chunk: int = CHUNK, overlap: int = OVERLAP,
           decoded: bool = False) -> DataFrame:
    """(id, ids[, decoded]): the ids of every whole text, one row per document.

    With ``decoded`` the ids are also decoded, in the same Python worker.
    """
    small_batches(docs)
    texts = docs.select(named(id_col).alias("id"), body(text_col).alias("body"))
    kind = sql_type(docs, id_col)
    schema = f"id {kind}, ids binary" + ", decoded binary" * decoded
    back = decoding(ranks) if decoded else iter
    one_chunk = F.char_length("body") <= chunk + overlap
    encode_short, encode_piece = encoding(ranks, pattern, ("id",)), encoding(ranks, pattern, ("uid", "id", "idx"))
    short = (texts.where(one_chunk).withColumnRenamed("body", "piece")
             .mapInArrow(lambda batches: back(encode_short(batches)), schema))
    chunks = cut(texts.where(~one_chunk), chunk, overlap)
    pieces = stitched(chunks, pattern, chunk, overlap).mapInArrow(
        encode_piece, f"uid bigint, id {kind}, idx int, ids binary")
    long = (pieces.groupBy("uid").agg(F.first("id").alias("id"),
                                      F.array_sort(F.collect_list(F.struct("idx", "ids"))).alias("p"))
            .select("id", "p").mapInArrow(lambda batches: back(joined(batches)), schema))
    return short.unionByName(long)


def decode(encoded: DataFrame, ranks: str = RANKS) -> DataFrame:
    """Adds ``decoded`` to rows with ``ids``."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)
    return encoded.mapInArrow(decoding(ranks), f"{fields}, decoded binary")


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Per document: id, n_tokens, ids_sha256 and decoded_sha256 after the round trip."""
    return encode(docs, id_col, text_col, decoded=True, **options).select(
        F.col("id").alias(id_col), (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
