import numpy as np
import public_tokenizers
import tiktoken
from llm import brute
from llm.brute import pairs, sha
from llm.test_simhash import kept_of_similar

import corpus_pipeline
from conftest import SF_DIR
from reviewlake.llm.common import table
from reviewlake.llm.tokens import read_ranks


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language_id", "exact_dedup", "simhash_near_dedup", "decontamination", "bpe_encoding"]


def test_rows_against_brute_force(spark):
    docs = [p for p in pairs(table(spark, SF_DIR, "documents")) if any(c.isalpha() for c in p[1] or "")]
    docs = brute.kept_exact(docs)
    kept = kept_of_similar(docs)
    docs = [p for p in docs if p[0] in kept]
    items = [(r["item_id"], r["text"]) for r in table(spark, SF_DIR, "benchmark").collect()]
    docs = [p for p, r in zip(docs, brute.contamination(docs, items)) if not r[5]]
    coding = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, special_tokens={},
                               mergeable_ranks=read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")))
    want = {}
    for d, t in docs:
        ids = np.array(coding.encode_ordinary(t), "<u4").tobytes()
        want[d] = (len(ids) // 4, ids, sha(ids), sha(t.encode()))
    got = corpus_pipeline.run(spark, SF_DIR).collect()
    assert {r["doc_id"]: (r["n_tokens"], bytes(r["ids"]), r["ids_sha256"], r["decoded_sha256"]) for r in got} == want
    assert len(got) == len(want)


def test_near_copies_of_similarity_80_go_in_the_stage(spark):
    words = [f"w{i}" for i in range(204)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:-20] + [f"v{i}" for i in range(20)])),
            (3, " ".join(words[:-40] + [f"u{i}" for i in range(40)]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["doc_id"] for r in corpus_pipeline.simhash_stage(spark, docs, SF_DIR).collect()} == {1, 3}


def test_unlabelled_documents_stay_if_they_have_a_letter(spark):
    rows = [(1, "plain words", None), (2, "12 34 !!", None), (3, None, None), (4, "日本", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {r["doc_id"] for r in corpus_pipeline.language_id(spark, docs, SF_DIR).collect()} == {1, 4}
