"""Token ids in files of interleaved static range asymmetric numeral systems (rANS).

One frequency table, counted over all documents, is shared by all blocks.
Blocks hold a fixed number of ids of consecutive documents and are coded
independently, each on many interleaved lanes. Within a block, checkpoints
hold the lanes' states, so that segments can be decoded in parallel; checksums
cover the ids and the record.

Files are written by Spark's text sink, one row per block and one byte between
blocks, so they appear only when the job commits. Documents are dealt to files
by ranges of their ids and sorted within, so file order is id order.

Record, little-endian: magic, length, file number, block number, number of
ids, documents, lanes, checkpoints; per document id, flags, ids in this block;
lane states per checkpoint with its place in the words; 32-bit words; checksum
of the ids; checksum of all before.

Defined results: a null text counts as empty and holds the end id only; null
ids sort first; rows that repeat an id stay apart, in a fixed order; an empty
table gives no blocks; ids are whole numbers; other columns are never read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reviewlake.llm.common import body, named, slices, small_batches, stored
from reviewlake.llm.tokens import library_encoder
from reviewlake.session import scratch_path

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
END_ID = 0
#: log2 of the table's total; states stay in [2**31, 2**63), words have 32 bits.
SCALE = 20
LOW = np.uint64(1 << 31)
LANES = 1024
#: Steps between checkpoints, ids of a block, ids of a file.
SEGMENT = 128
BLOCK_IDS = 1 << 18
FILE_IDS = 1 << 22
MAGIC = b"RNS1"
HEAD = struct.Struct("<4sIIIIIHHI")
DOC = struct.Struct("<qBI")
NULL_ID, OPENS, CLOSES = 1, 2, 4


class Table:
    """Frequencies of ids, scaled to a total of 2**SCALE; every id that occurs has at least one."""

    def __init__(self, ids: np.ndarray, counts: np.ndarray):
        ids, counts = np.asarray(ids, np.int64), np.asarray(counts, np.float64)
        if len(ids) > 1 << (SCALE - 1):
            raise ValueError("too many distinct ids for the table")
        total = 1 << SCALE
        scaled = np.maximum(1, np.floor(counts / max(counts.sum(), 1) * (total - len(ids)))).astype(np.int64)
        if len(ids):
            scaled[np.lexsort((ids, -counts))[0]] += total - scaled.sum()
        self.ids = ids.astype(np.uint32)
        self.freq = scaled.astype(np.uint64)
        self.start = np.concatenate([[0], np.cumsum(scaled)[:-1]]).astype(np.uint64) if len(ids) else self.freq
        self.slots = np.repeat(np.arange(len(ids), dtype=np.int32), scaled)

    def dump(self) -> bytes:
        return self.ids.astype("<u4").tobytes() + self.freq.astype("<u4").tobytes()

    @classmethod
    def load(cls, data: bytes) -> Table:
        both = np.frombuffer(data, "<u4").reshape(2, -1)
        table = cls.__new__(cls)
        table.ids, table.freq = both[0].copy(), both[1].astype(np.uint64)
        table.start = np.concatenate([[0], np.cumsum(table.freq)[:-1]]).astype(np.uint64)
        table.slots = np.repeat(np.arange(len(table.ids), dtype=np.int32), table.freq.astype(np.int64))
        return table


def encode_ids(ids: np.ndarray, table: Table) -> tuple[int, list[tuple[int, np.ndarray]], np.ndarray]:
    """(lanes, checkpoints, words); a checkpoint is (place in the words, lane states)."""
    lanes = int(min(LANES, max(1, len(ids) // 64)))
    steps = -(-len(ids) // lanes)
    padded = np.zeros(steps * lanes, np.int64)
    padded[:len(ids)] = np.searchsorted(table.ids, ids)
    ranks = padded.reshape(steps, lanes)
    state = np.full(lanes, LOW, np.uint64)
    shift, limit, thirty_two = np.uint64(SCALE), np.uint64(63 - SCALE), np.uint64(32)
    words, written, states = [], 0, {}
    for step in range(steps - 1, -1, -1):
        freq, start = table.freq[ranks[step]], table.start[ranks[step]]
        full = state >= (freq << limit)
        if full.any():
            out = state[full]
            words.append(out.astype(np.uint32))
            written += len(out)
            state[full] = out >> thirty_two
        quotient = state // freq
        state = (quotient << shift) + (state - quotient * freq) + start
        if step % SEGMENT == 0:
            states[step] = (written, state.copy())
    words = np.concatenate(words[::-1]) if words else np.empty(0, np.uint32)
    return lanes, [(written - at, s) for _, (at, s) in sorted(states.items())], words


def decode_segment(n: int, lanes: int, k: int, place: int, state: np.ndarray, words: np.ndarray, table: Table) -> np.ndarray:
    """The ids between checkpoint ``k`` and the next of a block of ``n`` ids."""
    steps = min(SEGMENT, -(-n // lanes) - k * SEGMENT)
    mask, shift, thirty_two = np.uint64((1 << SCALE) - 1), np.uint64(SCALE), np.uint64(32)
    ranks = np.empty((steps, lanes), np.int32)
    state = state.copy()
    for step in range(steps):
        slot = state & mask
        rank = table.slots[slot.astype(np.int64)]
        ranks[step] = rank
        state = table.freq[rank] * (state >> shift) + slot - table.start[rank]
        low = np.flatnonzero(state < LOW)
        if len(low):
            state[low] = (state[low] << thirty_two) | words[place:place + len(low)]
            place += len(low)
    return table.ids[ranks.ravel()[: n - k * SEGMENT * lanes]]


def pack_block(file_no: int, block_no: int, docs: list[tuple[int | None, int, int]], ids: np.ndarray, table: Table) -> bytes:
    lanes, points, words = encode_ids(ids, table)
    parts = [DOC.pack(0 if d is None else d, flags | (NULL_ID if d is None else 0), n) for d, flags, n in docs]
    for place, state in points:
        parts += [struct.pack("<I", place), state.astype("<u8").tobytes()]
    parts += [struct.pack("<I", len(words)), words.astype("<u4").tobytes(),
              struct.pack("<I", zlib.crc32(ids.astype("<u4").tobytes()))]
    tail = b"".join(parts)
    head = HEAD.pack(MAGIC, HEAD.size + len(tail) + 4, file_no, block_no, len(ids), len(docs), lanes, len(points), 0)
    return head + tail + struct.pack("<I", zlib.crc32(head + tail))


def record_length(data: memoryview, at: int) -> int:
    return HEAD.unpack_from(data, at)[1]


def unpack_block(data: memoryview, table: Table) -> tuple[int, int, list[tuple[int | None, int, int]], np.ndarray]:
    """(file number, block number, documents, ids); raises if a checksum differs."""
    magic, length, file_no, block_no, n, n_docs, lanes, n_points, _ = HEAD.unpack_from(data)
    if magic != MAGIC or len(data) < length or zlib.crc32(data[:length - 4]) != struct.unpack_from("<I", data, length - 4)[0]:
        raise ValueError("damaged block")
    at = HEAD.size
    docs = [(None if f & NULL_ID else d, f, c) for d, f, c in DOC.iter_unpack(data[at:at + n_docs * DOC.size])]
    at += n_docs * DOC.size
    points = []
    for _ in range(n_points):
        points.append((struct.unpack_from("<I", data, at)[0], np.frombuffer(data, "<u8", lanes, at + 4)))
        at += 4 + 8 * lanes
    words = np.frombuffer(data, "<u4", struct.unpack_from("<I", data, at)[0], at + 4).astype(np.uint64)
    ids = np.concatenate([decode_segment(n, lanes, k, place, state, words, table)
                          for k, (place, state) in enumerate(points)])
    if zlib.crc32(ids.astype("<u4").tobytes()) != struct.unpack_from("<I", data, length - 8)[0]:
        raise ValueError("ids differ from their checksum")
    return file_no, block_no, docs, ids


def squeezed(ids: bytes) -> bytes:
    """Ids of 32 bits for a shuffle: equal bytes side by side, then zstd."""
    planes = np.frombuffer(ids, np.uint8).reshape(-1, 4).T.tobytes()
    return zstandard.ZstdCompressor(level=1).compress(planes)


def unsqueezed(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return planes.reshape(4, -1).T.copy().view("<u4").ravel()


def tokenised(docs: DataFrame, id_col: str, text_col: str, tokenizer: str, end_id: int) -> DataFrame:
    """Stored (id, row, n, ids): the squeezed ids of every document with the end id."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = library_encoder(tokenizer), np.array([end_id], "<u4").tobytes()
        for batch in slices(batches):
            ids = [encode(t) + end for t in batch["body"].to_pylist()]
            yield pa.record_batch({"id": batch["id"], "row": batch["row"],
                                   "n": pa.array([len(i) // 4 for i in ids], pa.int64()),
                                   "ids": pa.array([squeezed(i) for i in ids], pa.binary())})

    texts = docs.select(named(id_col).cast("long").alias("id"), F.monotonically_increasing_id().alias("row"),
                        body(text_col).alias("body"))
    return stored(texts.mapInArrow(work, "id bigint, row bigint, n bigint, ids binary"), "token-ids")


def frequencies(tokens: DataFrame) -> Table:
    """The shared table, from counts over all documents; it has a row per distinct id of the vocabulary."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(0, np.int64)
        for batch in batches:
            for data in batch["ids"]:
                seen = np.bincount(unsqueezed(data.as_py()))
                if len(seen) > len(counts):
                    counts = np.pad(counts, (0, len(seen) - len(counts)))
                counts[:len(seen)] += seen
        used = np.flatnonzero(counts)
        yield pa.record_batch({"id": pa.array(used), "n": pa.array(counts[used])})

    rows = (tokens.select("ids").mapInArrow(work, "id bigint, n bigint").groupBy("id")
            .agg(F.sum("n").alias("n")).orderBy("id").limit((1 << (SCALE - 1)) + 1).collect())
    return Table([r["id"] for r in rows], [r["n"] for r in rows])


def write_ids(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
              tokenizer: str = TOKENIZER, end_id: int = END_ID, file_ids: int = FILE_IDS,
              block_ids: int = BLOCK_IDS) -> None:
    """Writes ``path/table`` and ``path/blocks``."""
    small_batches(docs)
    spark = docs.sparkSession
    tokens = tokenised(docs, id_col, text_col, tokenizer, end_id)
    table = frequencies(tokens)
    dumped = table.dump()
    total = tokens.agg(F.sum("n")).first()[0] or 0

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared, file_no, block_no = Table.load(dumped), TaskContext.get().partitionId(), 0
        docs, parts, held = [], [], 0
        for batch in batches:
            for doc_id, data in zip(batch["id"].to_pylist(), batch["ids"]):
                ids, at = unsqueezed(data.as_py()), 0
                while at < len(ids):
                    part = ids[at:at + block_ids - held]
                    docs.append((doc_id, (0 if at else OPENS) | (CLOSES if at + len(part) == len(ids) else 0), len(part)))
                    parts.append(part)
                    at, held = at + len(part), held + len(part)
                    if held == block_ids:
                        yield pa.record_batch({"record": pa.array(
                            [pack_block(file_no, block_no, docs, np.concatenate(parts), shared)], pa.binary())})
                        docs, parts, held, block_no = [], [], 0, block_no + 1
        if held:
            yield pa.record_batch({"record": pa.array(
                [pack_block(file_no, block_no, docs, np.concatenate(parts), shared)], pa.binary())})

    files = max(1, -(-total // file_ids))
    ordered = tokens.repartitionByRange(files, F.col("id").asc_nulls_first(), F.col("row")).sortWithinPartitions(
        F.col("id").asc_nulls_first(), "row").select("id", "ids")
    (ordered.mapInArrow(work, "record binary").select(F.col("record").cast("string"))
     .write.text(f"{path}/blocks", lineSep="\n"))
    spark.createDataFrame([(bytearray(dumped),)], "record binary").select(
        F.col("record").cast("string")).coalesce(1).write.text(f"{path}/table", lineSep="\n")


def read_documents(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """(file_no, at, id, n_tokens, ids_crc32[, ids]) of every document; ``at`` counts ids before it in its file."""
    load = lambda part: (spark.read.format("binaryFile").load(f"{path}/{part}").where("length > 0")
                         .select("content"))
    first = load("table").first()
    dumped = bytes(first["content"])[:-1] if first else b""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Table.load(dumped)
        for batch in batches:
            for content in batch["content"]:
                data, at, place, crc, n, kept = memoryview(content.as_buffer()), 0, 0, 0, 0, []
                while at < len(data):
                    file_no, _, docs, ids = unpack_block(data[at:], table)
                    at += record_length(data, at) + 1
                    out, low = [], 0
                    for doc_id, flags, count in docs:
                        piece = ids[low:low + count].astype("<u4").tobytes()
                        low += count
                        if flags & OPENS:
                            crc, n, kept = 0, 0, []
                        crc, n = zlib.crc32(piece, crc), n + count
                        if with_ids:
                            kept.append(piece)
                        if flags & CLOSES:
                            out.append((file_no, place, doc_id, n, crc, b"".join(kept)))
                            place += n
                    columns = list(zip(*out)) or [[]] * 6
                    kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
                    arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
                    names = ["file_no", "at", "id", "n_tokens", "ids_crc32", "ids"]
                    yield pa.RecordBatch.from_arrays(arrays[:5 + with_ids], names[:5 + with_ids])

    return load("blocks").mapInArrow(
        work, "file_no int, at bigint, id bigint, n_tokens bigint, ids_crc32 bigint" + ", ids binary" * with_ids)


def written_and_read(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Per document, from the files read back: id, start, n_tokens, ids_crc32."""
    path = scratch_path(docs.sparkSession, "rans")
    write_ids(docs, path, id_col, text_col, **options)
    rows = stored(read_documents(docs.sparkSession, path), "rans-rows")
    # One row per file: a running total over them is small.
    files = rows.groupBy("file_no").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)
    base = files.select("file_no", F.coalesce(F.sum("n").over(before), F.lit(0).cast("long")).alias("base"))
    return rows.join(base, "file_no").select(
        F.col("id").alias(id_col), (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")
