import os
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm.brute import awkward, no_rows
from tokenizers import Tokenizer

from reviewlake.llm import rans


def table_of(ids):
    return rans.Table(*np.unique(ids, return_counts=True))


@given(st.lists(st.integers(0, 60_000), min_size=1, max_size=400), st.integers(1, 40))
@settings(max_examples=30, deadline=None)
def test_codec_round_trip(values, times):
    ids = np.array(values * times, np.uint32)
    table = rans.Table.load(table_of(ids).dump())
    record = rans.pack_block(1, 2, [(7, rans.OPENS, len(ids))], ids, table)
    assert (rans.unpack_block(memoryview(record), table)[3] == ids).all()


def test_segments_decode_alone():
    rng = np.random.default_rng(1)
    ids = np.minimum(rng.zipf(1.3, 400_000), 50_000).astype(np.uint32)
    table = table_of(ids)
    lanes, points, words = rans.encode_ids(ids, table)
    assert len(points) > 2
    words = words.astype(np.uint64)
    for k in reversed(range(len(points))):
        part = rans.decode_segment(len(ids), lanes, k, *points[k], words, table)
        assert (part == ids[k * rans.SEGMENT * lanes:][:len(part)]).all()
    _, counts = np.unique(ids, return_counts=True)
    entropy = -(counts * np.log2(counts / len(ids))).sum() / 8
    assert 4 * len(words) < 1.02 * entropy + 8 * lanes


def test_damage_is_found():
    ids = np.arange(500, dtype=np.uint32)
    record = bytearray(rans.pack_block(0, 0, [(1, 6, 500)], ids, table_of(ids)))
    record[len(record) // 2] ^= 1
    with pytest.raises(ValueError):
        rans.unpack_block(memoryview(bytes(record)), table_of(ids))


def brute(rows):
    tokenizer = Tokenizer.from_file(rans.TOKENIZER)
    out, start = [], 0
    for doc_id, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [rans.END_ID]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_awkward_rows(spark):
    docs = awkward(spark).coalesce(1)
    rows = sorted(((r["doc_id"], r["text"]) for r in docs.collect()), key=lambda r: -1 if r[0] is None else r[0])
    for options in ({}, {"file_ids": 300, "block_ids": 100}):
        got = sorted((tuple(r) for r in rans.written_and_read(docs, **options).collect()), key=lambda r: r[1])
        assert got == brute(rows)
    assert rans.written_and_read(no_rows(docs)).count() == 0


def test_files_hold_the_ids(spark, tmp_path):
    docs = awkward(spark)
    rans.write_ids(docs, f"file://{tmp_path}/ids", file_ids=300, block_ids=100)
    got = {(r["id"], r["ids"] and bytes(r["ids"])) for r in rans.read_documents(spark, f"file://{tmp_path}/ids", True).collect()}
    tokenizer = Tokenizer.from_file(rans.TOKENIZER)
    want = {(r["doc_id"], np.array(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [0], "<u4").tobytes())
            for r in docs.collect()}
    assert got == want and len(os.listdir(tmp_path / "ids" / "blocks")) > 4
