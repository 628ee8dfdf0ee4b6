from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from llm.brute import awkward, no_rows, pairs, sha
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from reviewlake.llm import bpe, token_cache, tokens

JSON, RANKS = (public_tokenizers.path(f"byte_bpe_50k.{kind}") for kind in ("json", "tiktoken"))
LIBRARY = Tokenizer.from_file(JSON)
CODING = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=tokens.read_ranks(RANKS), special_tokens={})
BY_JSON, BY_RANKS = tokens.json_encoder(JSON), tokens.rank_encoder(RANKS, public_tokenizers.PATTERN)

PIECES = st.sampled_from([" ", "  ", "\n", "\t", " \n", "\r\n", "'s", "'re", "'", "don't", "word", "Wörter", "été", "12", "3.5",
                          "日本", " ", " ", "\x1c", "\x85", "!!", "...", "<|endoftext|>", "a", "é", "\U0001f600", "ǅ", "²"])


@given(st.lists(st.one_of(PIECES, st.text(max_size=4)), max_size=30).map("".join))
@settings(max_examples=400, deadline=None)
def test_words_give_the_ids_of_whole_texts(text):
    text = text.encode("utf-8", "ignore").decode()
    assert np.frombuffer(BY_JSON(text), "<u4").tolist() == LIBRARY.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(BY_RANKS(text), "<u4").tolist() == CODING.encode_ordinary(text)


def ids_of(text):
    return np.array(CODING.encode_ordinary(text or ""), "<u4").tobytes()


LONG = [(20, "word and 'twas don't " * 300), (21, "x" * 900 + " tail of it"), (22, " \n \t  " * 200 + "end"),
        (23, "a'rea're 'll\n\n" * 150), (24, "!" * 700 + "é" * 700), (None, "été à la plage, 1234 fois.\n" * 60)]


@pytest.mark.parametrize("chunk,overlap", [(64, 16), (100, 40), (1 << 16, 1 << 10)])
def test_stitched_chunks(spark, chunk, overlap):
    docs = awkward(spark, LONG)
    got = Counter(tuple(r) for r in bpe.digests(docs, chunk=chunk, overlap=overlap).collect())
    assert got == Counter((d, len(ids_of(t)) // 4, sha(ids_of(t)), sha((t or "").encode())) for d, t in pairs(docs))


def test_empty_table(spark):
    assert bpe.digests(no_rows(awkward(spark))).count() == 0
    assert token_cache.token_counts(no_rows(awkward(spark))).count() == 0


def test_cache_encodes_only_misses(spark, tmp_path):
    docs, cache = awkward(spark, LONG), f"file://{tmp_path}/cache"
    want = Counter((d, len((t or "").encode()), n := len(LIBRARY.encode(t or "", add_special_tokens=False).ids), n > 1024)
                   for d, t in pairs(docs))
    first = docs.where("doc_id < 9")
    assert token_cache.token_counts(first, cache).count() == first.count()
    before = spark.read.parquet(cache).count()
    assert before == len({t or "" for _, t in pairs(first)})
    assert Counter(tuple(r) for r in token_cache.token_counts(docs, cache).collect()) == want
    stored = spark.read.parquet(cache).count()
    assert stored == len({t or "" for _, t in pairs(docs)})
    token_cache.token_counts(docs, cache).count()
    assert spark.read.parquet(cache).count() == stored


def test_other_tokenizers_have_counts_of_their_own(spark, tmp_path):
    docs, cache = awkward(spark), f"file://{tmp_path}/cache"
    token_cache.fill_cache(docs, cache)
    model, lower = (public_tokenizers.path(n) for n in ("piece_bpe_32k.model", "word_bpe_49k.json"))
    pieces, words = SentencePieceProcessor(model_file=model), Tokenizer.from_file(lower)
    for path, count in ((model, lambda t: len(pieces.encode(t))), (lower, lambda t: len(words.encode(t, add_special_tokens=False).ids))):
        got = Counter((r["doc_id"], r["n_tokens"]) for r in token_cache.token_counts(docs, cache, tokenizer=path).collect())
        assert got == Counter((d, count(t or "")) for d, t in pairs(docs))
